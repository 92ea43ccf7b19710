"""Conversation structure repair (13): Hirschberg's divide and conquer.

A conversation's rows are edited until the initials of its roles read
``(s?(ua)+)?``. The pattern has four states (start, after s, after u, after
a), so what a run of rows can do is a four by four matrix of least costs, with
the order of the audits that reach each state. A forward vector of four costs
from the first row and a backward one from the last meet mid-conversation; of
the states they meet in at the least total, the one with the least audit so far
is on the least audit of all, and both halves are solved alike. Memory is
linear in the rows.

Edits before a row belong to that row (inserts lead), so an audit up to a row
ends with that row's own letter, no such audit is the beginning of another, and
comparing two of them decides between everything that may follow.

The same matrices carry the work over tasks. Rows are range-partitioned by
(conversation, turn), so a conversation of any length fills many partitions. One
that lies inside a partition and is no longer than a segment is solved there. Of
the others every segment of bounded rows gives its matrix, every partition the
product of its segments'; the crossings between partitions are found first, then
those between segments, then those within each, and the text is hashed as a
stream.

Defined cases: a null conversation id is a conversation of its own and is
spelled as one space in the hash that chooses the damage, as is a null turn; a
null role or text is one space. Rows of one turn are ordered by role and
text, equal rows stay together; all rows equal to an earlier one are
duplicates. An empty role has no initial: keeping it adds nothing. An empty
table gives an empty result. Columns beside the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm.common import by_value, saved

by_value(__name__)

BLANKS = " \t\n\x0b\x0c\r"
ENDS = [".", "!", "?"]
SEGMENT_ROWS = 4096         # rows and characters after which a segment is closed
SEGMENT_CHARS = 1 << 22
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 60               # the cost of what cannot be

# States: 0 start, 1 after s, 2 after u, 3 after a. A user or assistant row leads on by:
_NEXT = (2, 2, 3, 2)
_KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (0, 1, 2, 3),
         "?": (None,) * 4}

Matrix = tuple[tuple[tuple[int, int], ...], ...]      # [from][to] = (cost, rank of the audit among those from there)


def _ranked(found: list[dict[int, tuple[int, str]]]) -> tuple[Matrix, tuple[dict[int, str], ...]]:
    """Matrix and audits of the cheapest edits found from each state to each."""
    matrix = []
    for way in found:
        order = {y: k for k, y in enumerate(sorted(way, key=lambda y: way[y][1]))}
        matrix.append(tuple((way[y][0], order[y]) if y in way else (FAR, 0) for y in range(4)))
    return tuple(matrix), tuple({y: a for y, (_, a) in way.items()} for way in found)


@lru_cache(maxsize=None)
def row_edits(initial: str, fault: str) -> tuple[Matrix, tuple[dict[int, str], ...]]:
    """What one row can do. ``fault``: ``x`` must be deleted, ``t`` is truncated, empty else."""
    found = []
    for x in range(4):
        way: dict[int, tuple[int, str]] = {x: (DELETE, "D")}
        inserts, at = "", x
        while fault != "x" and len(inserts) < 3:
            cost = INSERT * len(inserts) + (TRUNCATED if fault == "t" else 0)
            for y, price, letter in ((_KEEP[initial][at], 0, "K"), (_NEXT[at], REROLE, "R")):
                if y is not None:
                    way[y] = min(way.get(y, (FAR, "")), (cost + price, inserts + letter))
            inserts, at = inserts + "I", _NEXT[at]
        found.append(way)
    return _ranked(found)


@lru_cache(maxsize=None)
def end_edits() -> tuple[Matrix, tuple[dict[int, str], ...]]:
    """From each state to the pattern's end (as state 0), by inserts."""
    return _ranked([{0: (0, "")}, {0: (2 * INSERT, "II")}, {0: (INSERT, "I")}, {0: (0, "")}])


def repeated_edits(n: int) -> tuple[Matrix, tuple[dict[int, str], ...]]:
    """``n`` more copies of a row: all are deleted."""
    return _ranked([{x: (DELETE * n, "D" * n)} for x in range(4)])


def forward(matrices: Sequence[Matrix], start: int) -> list[tuple[int, int]]:
    """(least cost, rank of its least audit) of each state behind all of ``matrices``."""
    now = [(0, 0) if x == start else (FAR, 0) for x in range(4)]
    for m in matrices:
        best = [min((now[x][0] + m[x][y][0], now[x][1], m[x][y][1]) for x in range(4)) for y in range(4)]
        reach = sorted((b[1:], y) for y, b in enumerate(best) if b[0] < FAR)
        rank = {y: k for k, (_, y) in enumerate(reach)}
        now = [(best[y][0], rank[y]) if y in rank else (FAR, 0) for y in range(4)]
    return now


def backward(matrices: Sequence[Matrix], end: int) -> list[int]:
    """Least cost from each state before all of ``matrices`` to ``end``."""
    now = [0 if x == end else FAR for x in range(4)]
    for m in reversed(matrices):
        now = [min(m[x][y][0] + now[y] for y in range(4)) for x in range(4)]
    return now


def product(matrices: Sequence[Matrix]) -> Matrix:
    """The one matrix that does what ``matrices`` do one after the other."""
    return tuple(tuple(forward(matrices, x)) for x in range(4))


def hirschberg(matrices: Sequence[Matrix], start: int, end: int) -> list[tuple[int, int]]:
    """The states that the cheapest edits of least audit pass: (before, after) of each of ``matrices``."""
    if len(matrices) <= 1:
        return [(start, end)] * len(matrices)
    mid = len(matrices) // 2
    left, right = matrices[:mid], matrices[mid:]
    ahead, behind = forward(left, start), backward(right, end)
    cross = min(range(4), key=lambda x: (ahead[x][0] + behind[x], ahead[x][1]))
    return hirschberg(left, start, cross) + hirschberg(right, cross, end)


def _items(kinds: Sequence[tuple[str, str, int]]) -> list[tuple[Matrix, tuple[dict[int, str], ...]]]:
    """A row's edits, and those of its further copies, for each (initial, fault, copies)."""
    out = []
    for initial, fault, n in kinds:
        out.append(row_edits(initial, fault))
        if n > 1:
            out.append(repeated_edits(n - 1))
    return out


def _solve(kinds: Sequence[tuple[str, str, int]], start: int, end: int | None) -> tuple[int, list[tuple[str, int]]]:
    """(cost, [(audit, state before) of each row with its copies]); ``end`` None: to the pattern's end,
    whose inserts are the last element."""
    items = _items(kinds) + ([end_edits()] if end is None else [])
    matrices = [m for m, _ in items]
    states = hirschberg(matrices, start, 0 if end is None else end)
    cost = sum(m[x][y][0] for m, (x, y) in zip(matrices, states))
    audits = iter([(a[x][y], x) for (_, a), (x, y) in zip(items, states)])
    out = []
    for _, _, n in kinds:
        audit, x = next(audits)
        out.append((audit + (next(audits)[0] if n > 1 else ""), x))
    return cost, out + list(audits)


@lru_cache(maxsize=1 << 16)
def _solve_short(kinds: tuple, start: int, end: int | None):
    return _solve(kinds, start, end)


def solve(kinds: Sequence[tuple[str, str, int]], start: int = 0, end: int | None = None):
    """As ``_solve``; conversations of few rows are often alike and remembered."""
    return _solve_short(tuple(kinds), start, end) if len(kinds) <= 16 else _solve(kinds, start, end)


def repaired_lines(audit: str, state: int, role: str, text: str) -> list[str]:
    """The ``role:text`` lines that a row's edits leave."""
    out = []
    for letter in audit:
        if letter == "D":
            continue
        if letter == "K":
            out.append(f"{role}:{text}")
            continue                    # the row's last letter that matters
        given = "assistant" if state == 2 else "user"
        state = _NEXT[state]
        out.append(f"{given}:{text if letter == 'R' else ''}")
    return out


def spelled(c: str) -> Column:
    """A column as text; null is one space."""
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n (copies; 0: dropped) with the query's faults."""
    kind = F.crc32(F.concat(spelled("conv"), F.lit(":"), spelled("turn")).cast("binary")) % 20
    text = F.when(kind.isin(0, 1), F.lit("")).when(kind == 2, F.translate(spelled("text"), "".join(ENDS), "")).otherwise(spelled("text"))
    role = F.when(kind == 0, F.lit("")).when(kind == 4, F.lit("user")).otherwise(spelled("role"))
    n = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), n.cast("long").alias("n"))


def undamaged(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text, n as they are."""
    return rows.select("conv", "turn", spelled("role").alias("role"), spelled("text").alias("text"), F.lit(1).cast("long").alias("n"))


def marked(rows: DataFrame) -> DataFrame:
    """Equal rows as one with its copies; ``fault`` of the first copy: b blank, d duplicate, t truncated, empty else."""
    one = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("key", F.sha2("text", 256))
    again = (rows.where("n > 0").select("conv", "turn", "role", F.sha2("text", 256).alias("key")).groupBy("conv", "role", "key")
             .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"),
                  F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    on = (F.col("o.conv").eqNullSafe(F.col("a.conv")) & (F.col("o.role") == F.col("a.role")) & (F.col("o.key") == F.col("a.key")))
    core = F.rtrim("o.text", F.lit(BLANKS))
    fault = (F.when(core == "", "b").when(~F.col("o.turn").eqNullSafe(F.col("a.first.turn")) & F.col("a.first").isNotNull(), "d")
             .when(~F.right(core, F.lit(1)).isin(ENDS), "t").otherwise(""))
    return one.alias("o").join(again.alias("a"), on, "left").select("o.conv", "o.turn", "o.role", "o.text", "o.n", "o.key", fault.alias("fault"))


_STATS = "blank long, duplicate long, truncated long, illegal long, gap_min long, gap_max long, gap_n long, first string, last string"
_STAT_NAMES = [s.split()[0] for s in _STATS.split(", ")]


class _Stats:
    """Counts over consecutive rows."""

    def __init__(self) -> None:
        self.n = dict.fromkeys("bdt", 0)
        self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn: int | None, role: str, fault: str, copies: int) -> None:
        if fault:
            self.n[fault] += 1
        initial = role[:1]
        if copies > 1:
            self.n["b" if fault == "b" else "d"] += copies - 1
            self.illegal += copies - 1
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def row(self) -> list:
        return [self.n["b"], self.n["d"], self.n["t"], self.illegal, self.low, self.high, self.turns, self.first, self.last]


def _kind(role: str, fault: str, n: int) -> tuple[str, str, int]:
    initial = role[:1] if role[:1] in ("s", "u", "a", "") else "?"
    return initial, "x" if fault in ("b", "d") else fault, n


def _flat(m: Matrix) -> list[int]:
    return [v for row in m for pair in row for v in pair]


def _matrix(flat: Sequence[int]) -> Matrix:
    pairs = list(zip(flat[::2], flat[1::2]))
    return tuple(tuple(pairs[4 * x:4 * x + 4]) for x in range(4))


def _digest(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def _apply(kinds, rows, start, end) -> tuple[int, str, list[str]]:
    cost, edits = solve(kinds, start, end)
    lines = [line for (audit, x), (role, text) in zip(edits, rows) for line in repaired_lines(audit, x, role, text)]
    if end is None:
        lines += repaired_lines(edits[-1][0], edits[-1][1], "", "")
    return cost, "".join(a for a, _ in edits), lines


def _pass_rows(conv_type: str, segment_rows: int, segment_chars: int):
    """Task code over rows sorted by conversation and turn, and its schema. Rows out: ``w`` a solved conversation,
    ``p`` a partition's share of an open one, ``s`` a segment of that share."""
    schema = (f"conv {conv_type}, shape string, part int, seg int, {_STATS}, cost long, audit string, sha string, "
              "matrix array<long>, roles array<string>, texts array<string>, faults array<string>, copies array<long>")
    names = ["conv", "shape", "part", "seg", *_STAT_NAMES, "cost", "audit", "sha", "matrix", "roles", "texts", "faults", "copies"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fields = None
        out: list[tuple] = []
        held: list[tuple[str, str, str, int]] = []     # role, text, fault, copies of the open segment
        chars = seg = 0
        stats, products = _Stats(), []
        conv: object = None
        first = True                                   # the partition's first conversation may have begun before it
        begun = False

        def close_segment() -> None:
            nonlocal held, chars, seg
            m = product([m for m, _ in _items([_kind(r, f, n) for r, _, f, n in held])])
            products.append(m)
            out.append((conv, "s", part, seg, *[None] * 9, None, None, None, _flat(m), *map(list, zip(*held))))
            held, chars, seg = [], 0, seg + 1

        def close_conversation(last: bool) -> None:
            nonlocal held, chars, seg, stats, products, first
            if first or last or seg:
                if held:
                    close_segment()
                out.append((conv, "p", part, None, *stats.row(), None, None, None, _flat(product(products)), None, None, None, None))
            else:
                cost, audit, lines = _apply([_kind(r, f, n) for r, _, f, n in held], [(r, t) for r, t, _, _ in held], 0, None)
                out.append((conv, "w", part, None, *stats.row(), cost, audit, _digest(lines), *[None] * 5))
            held, chars, seg, stats, products, first = [], 0, 0, _Stats(), [], False

        def batch_of() -> pa.RecordBatch:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out), fields)]
            out.clear()
            return pa.record_batch(cols, names=names)

        for batch in batches:
            if fields is None:
                text, many = pa.string(), pa.list_(pa.int64())
                kinds = [batch.schema.field("conv").type, text, pa.int32(), pa.int32(), *[pa.int64()] * 7, text, text,
                         pa.int64(), text, text, many, *[pa.list_(text)] * 3, many]
                fields = [pa.field(n, t) for n, t in zip(names, kinds)]
            for c, turn, role, text_, fault, n in zip(*(batch.column(k).to_pylist() for k in ("conv", "turn", "role", "text", "fault", "n"))):
                if begun and c != conv:
                    close_conversation(False)
                conv, begun = c, True
                if not n:
                    continue                            # a dropped row only names its conversation
                stats.add(turn, role, fault, n)
                held.append((role, text_, fault, n))
                chars += len(text_)
                if len(held) >= segment_rows or chars >= segment_chars:
                    close_segment()
                    yield batch_of()
            if out:
                yield batch_of()
        if begun:
            close_conversation(True)
            yield batch_of()

    return work, schema


def _between_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each open conversation (its partitions' shares in order): counts, cost, and the states between shares."""
    for batch in batches:
        rows = []
        for shares in batch.column("shares").to_pylist():
            total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            low = high = last = None
            turns = 0
            for s in shares:
                for k in total:
                    total[k] += s[k]
                if s["first"] is not None:
                    total["illegal"] += last is not None and last + s["first"] not in ("su", "ua", "au")
                    last = s["last"]
                if s["gap_min"] is not None:
                    turns += s["gap_n"] - (s["gap_min"] == high)
                    low = s["gap_min"] if low is None else low
                    high = s["gap_max"]
            matrices = [_matrix(s["matrix"]) for s in shares] + [end_edits()[0]]
            states = hirschberg(matrices, 0, 0)
            cost = sum(m[x][y][0] for m, (x, y) in zip(matrices, states))
            rows.append((*total.values(), 0 if low is None else high - low + 1 - turns, cost,
                         [{"part": s["part"], "x": x, "y": y} for s, (x, y) in zip(shares, states)],
                         states[-1][0]))
        cols = list(zip(*rows)) or [()] * 8
        step = pa.list_(pa.struct([("part", pa.int32()), ("x", pa.int32()), ("y", pa.int32())]))
        yield pa.record_batch([batch.column("conv"), *(pa.array(c, pa.int64()) for c in cols[:6]), pa.array(cols[6], step),
                               pa.array(cols[7], pa.int32())],
                              names=["conv", "blank", "duplicate", "truncated", "illegal", "gaps", "cost", "steps", "end_state"])


def _between_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states between the segments of one share."""
    for batch in batches:
        steps = []
        for x, y, segs in zip(*(batch.column(k).to_pylist() for k in ("x", "y", "segs"))):
            states = hirschberg([_matrix(s["matrix"]) for s in segs], x, y)
            steps.append([{"seg": s["seg"], "x": a, "y": b} for s, (a, b) in zip(segs, states)])
        step = pa.list_(pa.struct([("seg", pa.int32()), ("x", pa.int32()), ("y", pa.int32())]))
        yield pa.record_batch([batch.column("conv"), batch.column("part"), pa.array(steps, step)], names=["conv", "part", "steps"])


def _within_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired lines of each segment between its two states."""
    for batch in batches:
        audits, pieces = [], []
        for x, y, roles, texts, faults, copies in zip(*(batch.column(k).to_pylist() for k in ("x", "y", "roles", "texts", "faults", "copies"))):
            _, audit, lines = _apply([_kind(*k) for k in zip(roles, faults, copies)], list(zip(roles, texts)), x, y)
            audits.append(audit)
            pieces.append("\n".join(lines) if lines else None)
        yield pa.record_batch([batch.column("conv"), batch.column("part"), batch.column("seg"), pa.array(audits, pa.string()),
                               pa.array(pieces, pa.string())], names=["conv", "part", "seg", "audit", "piece"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of each open conversation, from its pieces in order; the row with ``end_state`` is its last."""
    sha, audit, empty = hashlib.sha256(), [], True
    for batch in batches:
        done = []
        for i, (a, piece, end) in enumerate(zip(*(batch.column(k).to_pylist() for k in ("audit", "piece", "end_state")))):
            if end is not None:
                a = end_edits()[1][end][0]
                piece = "\n".join(repaired_lines(a, end, "", "")) or None
            audit.append(a)
            if piece is not None:
                sha.update((("" if empty else "\n") + piece).encode("utf-8", "surrogatepass"))
                empty = False
            if end is not None:
                done.append((i, "".join(audit), sha.hexdigest()))
                sha, audit, empty = hashlib.sha256(), [], True
        if done:
            at, audits, hashes = zip(*done)
            yield pa.record_batch([batch.column("conv").take(pa.array(at)), pa.array(audits), pa.array(hashes)], names=["conv", "audit", "sha"])


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``rows`` (conv, turn, role, text, n) as conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 of every conversation."""
    kind = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", "key"]
    sorted_ = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    work, schema = _pass_rows(kind, segment_rows, segment_chars)
    passed = saved(sorted_.select("conv", "turn", "role", "text", "fault", "n").mapInArrow(work, schema))
    gaps = F.coalesce(F.col("gap_max") - F.col("gap_min") + 1 - F.col("gap_n"), F.lit(0))
    whole = passed.where("shape = 'w'").select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
                                               "audit", F.col("sha").alias("repaired_sha256"))
    shares = (passed.where("shape = 'p'").groupBy("conv")
              .agg(F.sort_array(F.collect_list(F.struct("part", *_STAT_NAMES, "matrix"))).alias("shares")))     # one a partition at most
    top = saved(shares.mapInArrow(_between_parts, f"conv {kind}, blank long, duplicate long, truncated long, illegal long, gaps long, "
                                                  "cost long, steps array<struct<part:int,x:int,y:int>>, end_state int"))
    step = top.select("conv", F.explode("steps").alias("s")).select("conv", "s.*")
    segments = passed.where("shape = 's'")
    listed = segments.groupBy("conv", "part").agg(F.sort_array(F.collect_list(F.struct("seg", "matrix"))).alias("segs"))
    crossing = _joined(listed, step, ["conv", "part"]).mapInArrow(
        _between_segments, f"conv {kind}, part int, steps array<struct<seg:int,x:int,y:int>>")
    crossing = crossing.select("conv", "part", F.explode("steps").alias("s")).select("conv", "part", "s.*")
    pieces = _joined(segments.select("conv", "part", "seg", "roles", "texts", "faults", "copies"), crossing, ["conv", "part", "seg"]).mapInArrow(
        _within_segments, f"conv {kind}, part int, seg int, audit string, piece string")
    ends = top.select("conv", F.lit(2 ** 31 - 1).alias("part"), F.lit(0).alias("seg"), F.lit(None).cast("string").alias("audit"),
                      F.lit(None).cast("string").alias("piece"), "end_state")
    stream = pieces.withColumn("end_state", F.lit(None).cast("int")).unionByName(ends)
    hashed = (stream.repartition("conv").sortWithinPartitions("conv", "part", "seg")
              .mapInArrow(_hashed, f"conv {kind}, audit string, sha string"))
    open_ = _joined(top.drop("steps", "end_state"), hashed, ["conv"]).withColumnRenamed("sha", "repaired_sha256")
    return whole.unionByName(open_)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys``, null equal to null."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.alias("l").join(right.alias("r"), on).select("l.*", *(f"r.{c}" for c in right.columns if c not in keys))


def repair_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", damaged: bool = True, **settings) -> DataFrame:
    """The repair of every conversation, with the query's damage done first unless ``damaged`` is False."""
    rows = conversations.select(*(F.col(f"`{c}`").alias(a) for c, a in ((conv_col, "conv"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))))
    rows = rows.withColumn("turn", F.col("turn").cast("long"))
    return repair(damage(rows) if damaged else undamaged(rows), **settings).withColumnRenamed("conv", conv_col)
