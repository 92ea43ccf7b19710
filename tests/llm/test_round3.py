"""Mended cases of earlier operators."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqrisk.llm import exact_dedup, langid, line_dedup, mixing, packing, quality
from tests.llm.helpers import clashing, empty, frame


def test_sources_come_near_their_targets(spark):
    """A source misses its target by less than one percent (two where it has some ten documents), or half its shortest document."""
    tiny, docs = (spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet") for sf in ("0.001", "0.01"))
    for table, share in ((tiny, 0.02), (docs, 0.01)):
        out = mixing.mix_sources(table)
        rows = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("short"),
                                         F.max("copies").alias("most")).collect()
        for r in rows:
            assert abs(r["taken"] - r["target"]) <= max(share * r["target"], r["short"] / 2 + 1), r
            assert r["most"] <= 2
    assert mixing.mix_sources(empty(spark)).count() == 0


LETTERS = {"ta": "தமிழ்நாடுகலை", "am": "ሰላምለሁሉበትክክል", "got": "\U00010330\U00010331\U00010332\U00010333\U00010334", "ka": "აბგდევზ", "en": "abcdefghij", "my": "ကခဂဃငစဆ"}


def test_all_scripts_are_learnt(spark):
    rng = random.Random(3)
    rows = [(100 * k + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(30)), lang, "s", 1)
            for k, (lang, letters) in enumerate(LETTERS.items()) for i in range(40)]
    model = langid.train(frame(spark, rows), F.col("doc_id") % 4 != 2)
    out = {r["id"]: r for r in langid.predict(frame(spark, rows), model).collect()}
    for i, _, lang, _, _ in rows:
        if i % 4 == 2:
            assert (out[i]["lang_pred"], out[i]["score"] > 0.9) == (lang, True)
    odd = langid.predict(frame(spark, [(1, "\U0001F600 \U0001F468", None, "s", 1), (2, "٣٤٥ १२३", None, "s", 1), (3, "ᚠᚢᚦ", None, "s", 1)]), model).collect()
    assert {r["id"]: (r["lang_pred"] == "und", r["score"]) for r in odd} == {1: (True, 0.0), 2: (True, 0.0), 3: (False, 0.0)}


def test_a_label_stands_for_one_text(spark):
    """Rows that share a labelled id give one row of the sample, whichever order they come in."""
    rows = [(1, f"text number {i} of many", None, None, 1) for i in range(500)] + [(i, "good words here" if i % 2 else "bad stuff there", None, None, 1) for i in range(2, 12)]
    labels = spark.createDataFrame([(1, 0)] + [(i, i % 2) for i in range(2, 12)], "doc_id long, grade int")
    one = quality.train(frame(spark, rows), labels)
    two = quality.train(frame(spark, rows[::-1]).repartition(5), labels)
    assert (one.weights == two.weights).all()


def test_short_lines_go_for_one_edit(spark):
    rows = [(1, "Read more >>\n1.\nintro a", None, None, 1), (2, "Read more >>>\n2.\nReed more >>\nintro b", None, None, 1), (3, "read more >\n1.\n\n\nnext!", None, None, 1), (4, "mext!\nother", None, None, 1)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, rows), min_chars=5).collect()}
    assert got == {1: "Read more >>\n1.\nintro a", 2: "2.", 3: "\n\nnext!", 4: "other"}


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def test_short_lines_match_brute_force(spark):
    rng = random.Random(8)
    words = ["alpha", "alphas", "page 1", "page 2", "page 12", "x", "ab", "abcd", "abcde", "zzzzzzzzzzzzzzzz", "zzzzzzzzzzzzzzz", "é\U0001F600abc"]
    rows = [(i, "\n".join("".join(c for c in rng.choice(words) if rng.random() > 0.07) for _ in range(6)), None, None, 1) for i in range(40)]
    norm = lambda x: x.strip(" ").lower()
    lines = [(r[0], k, norm(x)) for r in rows for k, x in enumerate(r[1].split("\n"))]
    want = {}
    for r in rows:
        kept = [x for k, x in enumerate(r[1].split("\n")) if not (norm(x) and any(
            (a, b) < (r[0], k) and (m == norm(x) or min(len(m), len(norm(x))) >= 5 and _one_edit(m, norm(x))) for a, b, m in lines))]
        want[r[0]] = "\n".join(kept)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame(spark, rows), min_chars=5).collect()}
    assert got == want


@pytest.mark.parametrize("few", [True, False])
def test_whole_texts_are_hashed_behind_the_join(spark, monkeypatch, few):
    monkeypatch.setattr(exact_dedup, "small", lambda df, *a: few)
    rows = [(i, t, None, None, 1) for i, t in enumerate(["a", "A", "b" * 100, "b" * 99 + "c", "B" * 100, None, "", "lone text"])] + [(None, "a", None, None, 1)]
    docs = clashing(frame(spark, rows))
    keys = exact_dedup._suspects(docs, "doc_id", "text", 64)
    plan = exact_dedup._keyed(docs.select("doc_id", "text"), keys, "text", 64)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2") < plan.index("Join") and "sha2" not in plan[plan.index("Join"):]
    hashed = exact_dedup._keyed(docs, keys, "text", 64).where("__sha is not null").select("doc_id").collect()
    assert sorted(str(r[0]) for r in hashed) == sorted(str(x) for x in (0, 1, None, 2, 3, 4, 5, 6))
    kept = exact_dedup.drop_duplicates(docs)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [1, 3, 4, 6, 7] and kept.columns == docs.columns
    marks = {(r["doc_id"], r["keep_id"], r["group_size"]) for r in exact_dedup.mark_duplicates(docs).collect()}
    assert {(0, 1, 3), (1, 1, 3), (None, 1, 3), (2, 4, 2), (4, 4, 2), (5, 6, 2), (7, 7, 1), (3, 3, 1)} <= marks


def test_sequence_numbers_are_exact(spark):
    """One number per (level, block, bin): sequences hold gapless offsets and at most their capacity."""
    rng = random.Random(2)
    pieces = spark.createDataFrame([(i, rng.choice([5, 17, 60, 100, 100, 33])) for i in range(3000)], "uid long, length long")
    placed = packing.pack(packing.saved(pieces), capacity=100, block=200).join(pieces, "uid").collect()
    held = {}
    for r in placed:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in held.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 100
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
    assert Counter(r["uid"] for r in placed) == Counter(range(3000))
