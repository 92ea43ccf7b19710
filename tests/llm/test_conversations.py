"""Conversation repair (13): against enumeration of all edits, over any cut into segments and partitions."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from seqrisk.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        role = "user" if h == 4 else role
        out += [(conv, turn, role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        marks = BLANK.findall(text)
        out.append("b" if not marks else "d" if (role, text) in seen else "t" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, marks):
    """(cost, audit, lines) by enumeration, row after row, of all edits that the least cost found allows."""
    adds = [(k, "".join(p)) for k in range(3) for p in itertools.product("ua", repeat=k)]
    best = [10 ** 9, None, None]

    def go(i, cost, audit, roles, lines):
        if cost > best[0]:
            return
        for k, add in adds:
            c, a, r = cost + 5 * k, audit + "I" * k, roles + add
            ls = lines + [("user:" if x == "u" else "assistant:") for x in add]
            if i == len(rows):
                if re.fullmatch(r"(s?(ua)+)?", r) and (c, a) < (best[0], best[1] or "~"):
                    best[:] = [c, a, ls]
                continue
            _, _, role, text = rows[i]
            go(i + 1, c + 2, a + "D", r, ls)
            if marks[i] in "bd" and marks[i]:
                continue
            extra = 5 if marks[i] == "t" else 0
            go(i + 1, c + extra, a + "K", r + role[:1], ls + [f"{role}:{text}"])
            for to in ("user", "assistant"):
                go(i + 1, c + extra + 1, a + "R", r + to[0], ls + [f"{to}:{text}"])

    go(0, 0, "", "", [])
    return best


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        marks = faults(own)
        turns = [r[1] for r in own if r[1] is not None]
        cost, audit, lines = cheapest(own, marks)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("b"), marks.count("d"), marks.count("t"),
                     sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def conversations(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "no", "What?", " \t", "", None, "so it is.", "An end!\n", f"{rng.random()}."])
            rows.append((conv, None if rng.random() < 0.1 else turn * rng.choice([1, 1, 2]), role, text))
    return rows + [(None, None, None, None), (None, 3, "user", "null id."), (-1, 5, "user", "Hi."), (-1, 5, "user", "Hi.")]


def result(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_matches_enumeration(spark, seed):
    rows = conversations(seed)
    got = result(cr.repair_conversations(spark.createDataFrame(rows, SCHEMA)))
    want = expected(rows)
    assert got.keys() == want.keys()
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_cut_conversations_match_whole_ones(spark, no_coalescing):
    """Conversations far longer than a segment and than a partition give what one task gives."""
    rng = random.Random(7)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "no", "", f"{t}.", f"{t}"])) for t in range(900)]
    rows += [(2, t, "user", "same.") for t in range(300)] + [(3, 0, "user", "equal rows.")] * 200 + [(4, 0, "user", "Alone.")]
    df = spark.createDataFrame(rows, SCHEMA)
    cut = result(cr.repair_conversations(df, segment_rows=7))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        whole = result(cr.repair_conversations(df, segment_rows=10 ** 6))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert cut == whole and len(cut) == 4
    own = [r for r in damaged(rows) if r[0] == 2]
    assert cut[2][1:4] == (faults(own).count("b"), faults(own).count("d"), faults(own).count("t"))


def test_hirschberg_takes_the_least_audit_of_the_cheapest():
    rng = random.Random(3)
    for _ in range(120):
        kinds = [(rng.choice(["s", "u", "a", "?", ""]), rng.choice(["", "", "x", "t"]), rng.choice([1, 1, 1, 3])) for _ in range(rng.randint(0, 4))]
        full = [(i, f if k == 0 else "x") for i, f, n in kinds for k in range(n)]
        rows = [(0, 0, "?" if i == "?" else i, "") for i, _ in full]
        want = cheapest(rows, ["b" if f == "x" else f for _, f in full])
        cost, edits = cr._solve(kinds, 0, None)
        assert (cost, "".join(a for a, _ in edits)) == (want[0], want[1])


def test_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_conversations(empty).count() == 0
    assert cr.repair_conversations(empty).columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    rows = conversations(5, 20) + [(77, 0, "user", "word. " * 200_000), (77, 1, "assistant", "x" * 500_000 + ".")]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = result(cr.repair_conversations(df))
    extra = df
    for c in ("conv", "part", "seg", "n", "key", "fault", "text_", "cost", "first", "audit"):
        extra = extra.withColumn(c, F.lit("x"))
    assert result(cr.repair_conversations(extra)) == plain
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(cr.repair_conversations(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_undamaged_rows_stay(spark):
    rows = [(1, 0, "system", "Be good."), (1, 1, "user", "Why?"), (1, 2, "assistant", "So.")]
    got = cr.repair_conversations(spark.createDataFrame(rows, SCHEMA), damaged=False).collect()[0]
    assert (got["cost"], got["audit"]) == (0, "KKK")
    assert got["repaired_sha256"] == hashlib.sha256(b"system:Be good.\nuser:Why?\nassistant:So.").hexdigest()
