"""Cross-tokenizer alignment (12): external spill counting.

Each text is encoded by a byte-level tokenizer (A) and by a sentence-piece one
(B); where a token of both ends is a border, and what lies between two borders
is a group. Every two tokens whose bytes overlap are linked, so the links of a
text are the pieces that the ends of both cut it into.

Links are counted by pair, over all documents, as an external sort does: a task
gathers links up to a bound, sorts them by (B, A, document) and spills them as a
zstd run, cut by the leading digit of the (scrambled) B id. Runs are rows of a
table in the shared folder, so a lost executor loses none. Of each digit the
runs, some dozens at a time, are merged by a heap, which counts each pair; the
counts of several such merges are merged again, until one is left. Its order is
by B first, so a B id's pairs are neighbours and its highest count shows where
they end. A second reading of the runs streams each pair's count back to the
documents that hold it.

Bounds: a task holds one run, or the keys of ``FAN_IN`` runs for one digit, or
one run's share of a digit beside that digit's counts. A pair that most documents
hold is spread over as many tasks as there are groups of runs.

Token bytes are compared with the text; where the quick way of encoding (a
word's tokens are found once) ever gave another spelling, the text goes to its
tokenizer whole.

Defined cases: texts that are null, empty or not spelled alike by both tokenizers
have no tokens and zeros; the strings of special tokens are plain text; repeated
rows count each, ids may repeat or be null; an empty table gives an empty
result; columns beside id and text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from seqrisk.llm import bytes_text as bt
from seqrisk.llm.common import by_value, saved
from seqrisk.llm.packing import _Encoder

by_value(__name__)

RUN_LINKS = 1 << 22         # links of a run
DIGIT_BITS = 6              # leading bits of the scrambled B id that cut runs
GROUPS = 16                 # tasks by digit
FAN_IN = 64                 # runs merged at once
LOCAL_BITS = 24             # documents of a run
HELD_DOCS = 1 << 21         # documents whose sums a task holds before it gives them out
_CHUNK = 1 << 20
_SCRAMBLE = 0x9E3779B1      # odd: a bijection of the ids
_SPACE = np.uint8(0x20)


class _Bytes:
    """Token bytes by id, and the comparison of tokens with a text."""

    def __init__(self, spelled: list[bytes]) -> None:
        self.size = np.array([len(s) for s in spelled], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def same(self, ids: np.ndarray, data: np.ndarray) -> bool:
        """Whether the tokens' bytes joined are ``data``."""
        size = self.size[ids]
        ends = np.cumsum(size)
        if (int(ends[-1]) if len(ends) else 0) != len(data):
            return False
        cut = 0
        while cut < len(ids):
            at = int(ends[cut - 1]) if cut else 0
            last = max(cut + 1, int(np.searchsorted(ends, at + _CHUNK, "right")))
            n = size[cut:last]
            ahead = np.cumsum(n) - n
            found = self.flat[np.repeat(self.begin[ids[cut:last]] - ahead, n) + np.arange(int(n.sum()))]
            if not np.array_equal(found, data[at:at + len(found)]):
                return False
            cut = last
        return True


class _SideA(_Encoder):
    """The byte-level tokenizer."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        back = {chr(c): b for b, c in self.letters.items()}
        n = self.tokenizer.get_vocab_size()
        words = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        self.bytes = _Bytes([bytes(back[c] for c in w) if all(c in back for c in w) else w.encode() for w in words])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


class _SideB(_Encoder):
    """The sentence-piece tokenizer. None of its pieces has a word's end and the
    next word's beginning in it, so words are encoded by themselves."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.by_words = not any("▁" in p.lstrip("▁") for p in pieces)
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes = _Bytes([bytes([int(byte.fullmatch(p)[1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                             for i, p in enumerate(pieces)])
        self.space = self.model.piece_to_id("▁")
        self._forget()

    def _merge(self, pieces: list[bytes]) -> tuple[list[int], np.ndarray]:
        found = [[self.space] if p == b" " else ids
                 for p, ids in zip(pieces, self.model.encode([p[1:].decode() for p in pieces], num_threads=1))]
        return [i for ids in found for i in ids], np.array([len(ids) for ids in found], np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        if not self.by_words:
            return [self.whole(data[a:b].tobytes().decode()) for a, b in zip(offsets, offsets[1:])]
        space = data == _SPACE
        start = space.copy()
        start[1:] &= ~space[:-1]
        border = offsets[:-1][offsets[:-1] < len(data)]
        start[border] = True
        starts = np.flatnonzero(start)
        ids, begin = self._plain_ids(data, starts, np.append(starts[1:], len(data)).astype(np.int64))
        cut = begin[np.searchsorted(starts, offsets)]
        return [ids[a:b] for a, b in zip(cut, cut[1:])]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:]), np.uint32)


def _ids(side: _SideA | _SideB, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray | None]:
    """Ids of each text; None where their bytes are not the text's."""
    out: list[np.ndarray | None] = []
    for i, ids in enumerate(side.encode(data, offsets)):
        text = data[offsets[i]:offsets[i + 1]]
        if not side.bytes.same(ids, text):
            ids = side.whole(text.tobytes().decode())
            ids = ids if side.bytes.same(ids, text) else None
        out.append(ids)
    return out


class _Decimal:
    """Ids as decimal text with a sign behind each, many at once."""

    def __init__(self, n: int) -> None:
        self.width = len(str(n)) + 1
        self.digits = np.zeros((n, self.width), np.uint8)
        self.size = np.zeros(n, np.int64)
        for i in range(n):
            s = str(i).encode()
            self.digits[i, :len(s)] = np.frombuffer(s, np.uint8)
            self.size[i] = len(s) + 1

    def text(self, ids: np.ndarray, signs: np.ndarray) -> tuple[bytes, np.ndarray]:
        rows, size = self.digits[ids], self.size[ids]
        rows[np.arange(len(ids)), size - 1] = signs
        return rows[np.arange(self.width) < size[:, None]].tobytes(), np.cumsum(size)


def align(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray):
    """Of tokens with their ends in bytes: token of A and of B of each link, the
    end of each link, and the ends at which groups end."""
    ends = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends), ends, np.intersect1d(a_end, b_end, assume_unique=True)


def group_hashes(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, borders: np.ndarray, doc_ends: np.ndarray,
                 decimal: _Decimal) -> list[str]:
    """Hash of each text's groups, written ``a1,a2|b1;a3|b2,b3``; ``doc_ends`` are the ends of texts in bytes."""
    a_group, b_group = np.searchsorted(borders, a_end), np.searchsorted(borders, b_end)
    n = len(a) + len(b)
    at_a = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
    at_b = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
    ids, signs = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    signs[at_a[np.searchsorted(a_end, borders)]] = ord("|")
    signs[at_b[np.searchsorted(b_end, borders)]] = ord(";")
    last = at_b[np.searchsorted(b_end, doc_ends)] + 1       # tokens up to each text's end
    out, sha, d = [], hashlib.sha256(), 0
    for c in range(0, n, _CHUNK):
        text, size = decimal.text(ids[c:c + _CHUNK], signs[c:c + _CHUNK])
        pos = 0
        while d < len(last) and last[d] <= c + _CHUNK:
            end = int(size[last[d] - c - 1])
            sha.update(text[pos:end - 1])
            out.append(sha.hexdigest())
            sha, pos, d = hashlib.sha256(), end, d + 1
        sha.update(text[pos:])
    return out


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as a zstd frame of their byte planes."""
    top = int(values.max()) if len(values) else 0
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)
    planes = values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T
    return bytes([np.dtype(kind).itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(frame: bytes) -> np.ndarray:
    size = frame[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(frame[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(f"<u{size}").ravel()


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


class _Spill:
    """Links of a task, given out as sorted runs."""

    def __init__(self, part: int, a_bits: int, b_bits: int, links: int) -> None:
        self.part, self.links, self.runs = part, links, 0
        self.a_bits, self.b_bits = np.uint64(a_bits), b_bits
        self.pairs: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.n = 0

    def add(self, a: np.ndarray, b: np.ndarray, uid: np.ndarray) -> None:
        side = b.astype(np.uint64) * np.uint64(_SCRAMBLE) & np.uint64((1 << self.b_bits) - 1)
        self.pairs.append(side << self.a_bits | a.astype(np.uint64))
        self.docs.append(uid)
        self.n += len(a)

    def ready(self, all_: bool) -> Iterator[tuple]:
        """(run, digit, first uid, pairs, totals, documents) of runs that are full, or of all."""
        while self.n >= self.links or (all_ and self.n):
            pairs, docs = np.concatenate(self.pairs), np.concatenate(self.docs)
            base = docs[0]
            cut = min(self.links, int(np.searchsorted(docs, base + (1 << LOCAL_BITS))))
            self.pairs, self.docs, self.n = [pairs[cut:]], [docs[cut:]], len(pairs) - min(cut, len(pairs))
            yield from self._run(pairs[:cut], docs[:cut], int(base))

    def _run(self, pairs: np.ndarray, docs: np.ndarray, base: int) -> Iterator[tuple]:
        key = pairs << np.uint64(LOCAL_BITS) | (docs - base).astype(np.uint64)
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        times = np.diff(np.append(first, len(key)))
        key = key[first]
        pair, doc = key >> np.uint64(LOCAL_BITS), (key & np.uint64((1 << LOCAL_BITS) - 1)).astype(np.uint32)
        own = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))        # where each pair's documents begin
        ends = np.append(own, len(pair))
        pair = pair[own]
        totals = np.add.reduceat(times, own)
        bits = max(0, int(self.a_bits) + self.b_bits - DIGIT_BITS)
        digit = (pair >> np.uint64(bits)).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, digit[1:] != digit[:-1]))
        run = (self.part << 32) + self.runs
        self.runs += 1
        for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(pair)]):
            rows = slice(ends[s], ends[e])
            held = [pack(ends[s + 1:e + 1] - ends[s:e]), pack(_steps(doc[rows])), pack(times[rows])]
            yield run, int(digit[s]), base, pack(_steps(pair[s:e])), pack(totals[s:e]), held


def _pass_documents(a_path: str, b_path: str, id_type: str, run_links: int):
    """Task code from (id, text with a space before it) to document rows and run rows, and its schema."""
    schema = (f"id {id_type}, uid long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "run long, digit int, base long, pairs binary, totals binary, docs array<binary>")
    names = [s.split()[0] for s in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        side_a, side_b = _SideA(a_path), _SideB(b_path)
        decimal = _Decimal(max(len(side_a.bytes.size), len(side_b.bytes.size)))
        spill = _Spill(part, (len(side_a.bytes.size) - 1).bit_length(), (len(side_b.bytes.size) - 1).bit_length(), run_links)
        uid = part << 40
        id_kind = None

        def runs(all_: bool) -> Iterator[pa.RecordBatch]:
            for rows in iter(lambda g=spill.ready(all_): list(itertools.islice(g, 16)), []):
                cols = list(zip(*rows))
                none = [pa.nulls(len(rows), t) for t in (id_kind, *[pa.int64()] * 5, pa.string())]
                yield pa.record_batch([*none, pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                       pa.array(cols[3], pa.binary()), pa.array(cols[4], pa.binary()), pa.array(cols[5], pa.list_(pa.binary()))], names=names)

        for batch in batches:
            id_kind = batch.column(0).type
            for first, n, data, offsets in bt.blocks(batch.column(1)):
                ids_a, ids_b = _ids(side_a, data, offsets), _ids(side_b, data, offsets)
                good = [i for i in range(n) if ids_a[i] is not None and ids_b[i] is not None and len(ids_a[i])]
                counts = np.zeros((4, n), np.int64)
                hashes = [""] * n
                if good:
                    a, b = np.concatenate([ids_a[i] for i in good]), np.concatenate([ids_b[i] for i in good])
                    a_end, b_end = np.cumsum(side_a.bytes.size[a]), np.cumsum(side_b.bytes.size[b])
                    doc_ends = np.cumsum([offsets[i + 1] - offsets[i] for i in good])
                    of_a, of_b, ends, borders = align(a, b, a_end, b_end)
                    for k, e in enumerate((a_end, b_end, borders, ends)):
                        counts[k, good] = np.diff(np.searchsorted(e, doc_ends, "right"), prepend=0)
                    for i, h in zip(good, group_hashes(a, b, a_end, b_end, borders, doc_ends, decimal)):
                        hashes[i] = h
                    spill.add(a[of_a], b[of_b], uid + np.array(good, np.int64)[np.searchsorted(doc_ends, ends)])
                none = [pa.nulls(n, t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.binary()))]
                yield pa.record_batch([batch.column(0).slice(first, n), pa.array(np.arange(uid, uid + n)), *(pa.array(c) for c in counts),
                                       pa.array(hashes, pa.string()), *none], names=names)
                uid += n
                yield from runs(False)
        if id_kind is not None:
            yield from runs(True)

    return work, schema


def _by(batches: Iterator[pa.RecordBatch], keys: list[str], others: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal ``keys``."""
    rows = (r for b in batches for r in zip(*(b.column(k).to_pylist() for k in [*keys, *others])))
    for key, some in itertools.groupby(rows, key=lambda r: r[:len(keys)]):
        yield key, (r[len(keys):] for r in some)


def merge_counts(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and their counts over sorted runs, by a k-way heap merge."""
    streams = [zip(np.cumsum(unpack(p).astype(np.uint64), dtype=np.uint64).tolist(), unpack(t).tolist()) for p, t in runs]
    pairs, counts, last = [], [], -1
    for pair, n in heapq.merge(*streams):
        if pair == last:
            counts[-1] += n
        else:
            pairs.append(pair)
            counts.append(n)
            last = pair
    return np.array(pairs, np.uint64), np.array(counts, np.int64)


def highest(pairs: np.ndarray, counts: np.ndarray, a_bits: int) -> np.ndarray:
    """Whether a pair's count is its B id's highest; pairs come by B first."""
    if not len(pairs):
        return np.zeros(0, bool)
    side = pairs >> np.uint64(a_bits)
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(pairs))))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (digit, salt), rows in _by(batches, ["digit", "salt"], ["pairs", "totals"]):
        pairs, counts = merge_counts(list(rows))
        yield pa.record_batch([pa.array([salt], pa.int64()), pa.array([digit], pa.int32()), pa.array([pack(_steps(pairs))], pa.binary()),
                               pa.array([pack(counts)], pa.binary())], names=["run", "digit", "pairs", "totals"])


def count_pairs(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """``runs`` (run, digit, pairs, totals) merged until each digit is one row."""
    while True:
        salts = max(1, -(-n_runs // fan_in))
        dealt = runs.select("digit", F.pmod(F.xxhash64("run"), F.lit(salts)).alias("salt"), "pairs", "totals")
        tasks = min(salts << DIGIT_BITS, max(64, runs.sparkSession.sparkContext.defaultParallelism * 8))
        runs = saved(dealt.repartition(tasks, "digit", "salt").sortWithinPartitions("digit", "salt")
                     .mapInArrow(_merge, "run long, digit int, pairs binary, totals binary"))
        if salts == 1:
            return runs
        n_runs = salts


def _pass_back(a_bits: int):
    """Task code from each digit's counts followed by its runs to sums per document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

        def sums() -> Iterator[pa.RecordBatch]:
            for base, best, total in held.values():
                at = np.flatnonzero(total)
                yield pa.record_batch([pa.array(at + base), pa.array(best[at]), pa.array(total[at])], names=["uid", "n_best", "count_sum"])
            held.clear()

        for _, rows in _by(batches, ["digit", "salt"], ["is_run", "run", "base", "pairs", "totals", "docs"]):
            pairs = counts = best = None
            for is_run, run, base, p, t, docs in rows:
                keys = np.cumsum(unpack(p).astype(np.uint64), dtype=np.uint64)
                if not is_run:
                    pairs, counts = keys, unpack(t).astype(np.int64)
                    best = highest(pairs, counts, a_bits)
                    continue
                n_docs = unpack(docs[0]).astype(np.int64)
                doc = np.cumsum(unpack(docs[1]).astype(np.uint32), dtype=np.uint32).astype(np.int64)
                times = unpack(docs[2]).astype(np.int64)
                at = np.repeat(np.searchsorted(pairs, keys), n_docs)
                if run not in held:
                    held[run] = (base, np.zeros(0, np.int64), np.zeros(0, np.int64))
                _, n_best, total = held[run]
                if len(total) <= doc.max():
                    more = np.zeros(int(doc.max()) + 1 - len(total), np.int64)
                    n_best, total = np.append(n_best, more), np.append(total, more)
                    held[run] = (base, n_best, total)
                np.add.at(n_best, doc, np.where(best[at], times, 0))
                np.add.at(total, doc, counts[at] * times)
                if sum(len(x[1]) for x in held.values()) > HELD_DOCS:
                    yield from sums()
        yield from sums()

    return work


def align_tokens(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                 run_links: int = RUN_LINKS, fan_in: int = FAN_IN) -> DataFrame:
    """n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = docs.sparkSession
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise("").alias("text"))
    work, schema = _pass_documents(a_path, b_path, rows.schema["id"].dataType.simpleString(), run_links)
    table = saved(rows.mapInArrow(work, schema))
    runs = table.where("run is not null")
    n_runs = runs.agg(F.countDistinct("run")).head()[0]
    counts = count_pairs(runs.select("run", "digit", "pairs", "totals"), n_runs, fan_in)
    salts = max(1, -(-n_runs // fan_in))
    a_bits = _a_bits(a_path)
    salt = F.pmod(F.xxhash64("run"), F.lit(salts)).alias("salt")
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    given = counts.select("digit", F.explode(F.sequence(zero, F.lit(salts - 1).cast("long"))).alias("salt"), F.lit(False).alias("is_run"),
                          none.alias("run"), none.alias("base"), "pairs", "totals", F.lit(None).cast("array<binary>").alias("docs"))
    back = given.unionByName(runs.select("digit", salt, F.lit(True).alias("is_run"), "run", "base", "pairs", F.lit(None).cast("binary").alias("totals"), "docs"))
    # digits of one task are neighbours, so that a document's sums leave a task once
    group = F.shiftright("digit", max(0, DIGIT_BITS - (GROUPS - 1).bit_length()))
    tasks = min(salts * GROUPS, max(GROUPS, spark.sparkContext.defaultParallelism * 32))
    sums = (back.repartition(tasks, "salt", group).sortWithinPartitions("salt", "digit", "is_run")
            .mapInArrow(_pass_back(a_bits), "uid long, n_best long, count_sum long")
            .groupBy("uid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return (table.where("uid is not null").join(sums, "uid", "left")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"))


def _a_bits(a_path: str) -> int:
    from tokenizers import Tokenizer
    return (Tokenizer.from_file(a_path).get_vocab_size() - 1).bit_length()
