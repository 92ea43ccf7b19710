"""Distributed order statistics against plain Python."""

import random
import statistics

from pyspark.sql import functions as F

from seqrisk.operators.ranking import (exact_medians, global_rank, hash_order, ordered_ranges, running_last,
                                       running_sums)


def test_exact_medians_match_python(spark):
    rng = random.Random(1)
    rows = []
    for g in range(6):
        n = rng.randint(1, 60)
        for _ in range(n):
            rows.append((f"g{g}", rng.choice([None, rng.uniform(-5, 5), float(rng.randint(0, 4))]),
                         float(rng.randint(0, 3))))
    rows += [("allnull", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    got = {r.g: (r.a, r.b) for r in exact_medians(df, ["g"], ["a", "b"]).collect()}
    for g in {r[0] for r in rows}:
        va = [r[1] for r in rows if r[0] == g and r[1] is not None]
        vb = [r[2] for r in rows if r[0] == g]
        ea = statistics.median(va) if va else None
        ga = got.get(g, (None, None))[0]
        assert (ga is None and ea is None) or abs(ga - ea) < 1e-12
        assert abs(got[g][1] - statistics.median(vb)) < 1e-12
    glob = exact_medians(df, [], ["a"]).first()["a"]
    assert abs(glob - statistics.median([r[1] for r in rows if r[1] is not None])) < 1e-12


def test_one_group_with_nearly_all_rows_is_many_ranges(spark, no_coalescing):
    df = spark.range(0, 20_000).select(F.when(F.col("id") % 50 == 0, "small").otherwise("hot").alias("g"),
                                       (F.col("id") * 7919 % 20_011).cast("double").alias("x"))
    cut = ordered_ranges(df, ["g"], [F.col("x")])
    sizes = [r["count"] for r in cut.groupBy("g", "__rb").count().collect()]
    assert max(sizes) < 0.5 * 20_000                  # the hot group does not sit in one range
    got = {r.g: r.x for r in exact_medians(df, ["g"], ["x"]).collect()}
    for g in ("hot", "small"):
        assert got[g] == statistics.median([i * 7919 % 20_011 for i in range(20_000) if (i % 50 == 0) == (g == "small")])


def test_running_last_carries_over_ranges(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"),
                                     F.when(F.col("id") % 200 < 3, F.col("id")).alias("v"))
    out = running_last(df, ["t"], "v", "last", ["k"]).collect()
    for r in out:
        want = max((i for i in range(r.t + 1) if i % 3 == r.k and i % 200 < 3), default=None)
        assert r["last"] == want


def test_hash_order_tells_keys_apart(spark):
    rows = [("1", "23"), ("12", "3"), (None, "123"), ("", "123"), ("~", "123"), (None, None), ("1:a", None)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert len({r.h for r in df.select(hash_order(["a", "b"], 42).alias("h")).collect()}) == len(rows)
    assert df.select(hash_order(["a", "b"], 42).alias("h")).where("h is null").count() == 0


def test_running_sums_and_rank(spark):
    df = spark.range(0, 500).withColumn("w", (F.col("id") % 7).cast("long"))
    out = running_sums(df, [F.col("id")], {"cum": F.col("w")}).collect()
    acc, exp = 0, {}
    for i in range(500):
        acc += i % 7
        exp[i] = acc
    assert {r.id: r.cum for r in out} == exp
    r = global_rank(spark.range(0, 300).withColumnRenamed("id", "k"), ["k"], 42).collect()
    assert sorted(x["rank"] for x in r) == list(range(1, 301))
    import hashlib
    order = sorted(range(300), key=lambda k: hashlib.md5(f"{len(str(k))}:{k}|42".encode()).hexdigest())
    assert [x.k for x in sorted(r, key=lambda x: x["rank"])] == order


def test_two_level_path_with_extra_aggs(spark):
    from seqrisk.operators.enrich import fill_group_then_global_median
    rows = [("a", 1.0), ("a", None), ("a", 3.0), ("b", None), ("b", None), (None, 10.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, x double")
    extra = [F.count(F.lit(1)).alias("n")]
    r = exact_medians(df, [], ["x"], extra_aggs=extra).first()
    assert (r.x, r.n) == (3.0, 7)
    assert {(r.g, r.x) for r in exact_medians(df, ["g"], ["x"]).collect()} == {("a", 2.0), (None, 10.0)}
    assert {(r.g, r.x, r.n) for r in exact_medians(df, ["g"], ["x"], extra_aggs=extra).collect()} == {
        ("a", 2.0, 3), ("b", None, 2), (None, 10.0, 2)}
    # group fill: a -> 2.0; b stays null then takes the global median of the
    # filled column (1, 2, 3, 10) = 2.5; the null-group row only gets the global
    out = sorted((r.g or "", r.x) for r in fill_group_then_global_median(df, ["x"], "g").collect())
    assert out == [("", 2.5), ("", 10.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.5), ("b", 2.5)]


def test_medians_by_selection_of_awkward_values(spark, monkeypatch):
    """Every number of passes gives the same: values near together, far apart, infinite, signed zeros, weights, ties."""
    import random
    import statistics

    from seqrisk.operators import ranking as rk
    inf = float("inf")
    rng = random.Random(11)
    groups = {"near": [1.0 + i * 2 ** -52 for i in range(501)], "far": [10.0 ** rng.randint(-300, 300) * rng.choice([-1, 1]) for _ in range(400)],
              "inf": [inf, -inf, inf, 3.0, 3.5, -inf], "ends": [-inf, 1.0, 2.0, 3.0, inf], "zero": [0.0, -0.0, 0.0, 1e-320, 5e-324], "tie": [7.0] * 50 + [8.0] * 50,
              "one": [2.5], None: [float(rng.randint(0, 1000)) for _ in range(999)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("nan", float("nan")), ("nan", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    want = {g: statistics.median(vs) for g, vs in groups.items()}
    for last in (2_000_000, 20):
        monkeypatch.setattr(rk, "LAST_ROWS", last)
        got = {r.g: r.x for r in rk.exact_medians(df, ["g"], ["x"]).collect()}
        assert got == want
    long = spark.createDataFrame([("k", 1.0, 5), ("k", 2.0, 4), ("k", 9.0, 1)], "__k string, __v double, __w long")
    assert rk.medians_of_long(long, [], ["k"]).first()["k"] == 1.5
    assert rk.medians_of_long(long.limit(0), [], ["k"]).first()["k"] is None
