"""Boosted trees and their attribution (M3-M6, M8): against a plain numpy version and subset enumeration."""

import itertools
import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from seqrisk.config import FeatureRoles
from seqrisk.operators import attribution as at
from seqrisk.operators import boosting as bo

ROLES = FeatureRoles(categorical=["team"], numeric=["a", "b"], boolean=["wet"], interactions=[], include_interactions=False)
PLAIN = dict(rows=1.0, columns=1.0, rate=0.3)
SCHEMA = "id long, a double, b double, team string, wet boolean, y int"


def rows(n=240, seed=5, missing=0.1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b = float(rng.integers(0, 12)), float(rng.integers(0, 6))
        team, wet = ["red", "blue", "tan", None][rng.integers(0, 4)], bool(rng.integers(0, 2))
        y = int(rng.random() < 1 / (1 + math.exp(-(0.6 * (a - 5) + (2 if team == "red" else -1) * wet))))
        out.append((i, None if rng.random() < missing else a, b, team, wet, y))
    return out


def plain_fit(data, p, weight):
    """The same trees by loops over all (feature, cut) pairs: features team, a, b, wet in order."""
    x = {"a": [r[1] for r in data], "b": [r[2] for r in data], "wet": [float(r[4]) for r in data]}
    team = [r[3] or "unknown" for r in data]
    y = np.array([r[5] for r in data], float)
    w = np.where(y == 1, weight, 1.0)
    margin = np.zeros(len(y))
    trees = []

    def gain(gl, hl, gr, hr):
        return gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - (gl + gr) ** 2 / (hl + hr + p.l2)

    def grow(keep, depth, g, h):
        G, H = g[keep].sum(), h[keep].sum()
        node = {"value": -p.rate * G / (H + p.l2), "cover": H, "rows": keep}
        best = None
        if depth < p.depth:
            options = []
            for word in sorted(set(team)):
                options.append((("team", word, False), np.array([t != word for t in team])))
            for f in ("a", "b", "wet"):
                for cut in sorted({v for v in x[f] if v is not None}):
                    for missing_left in (False, True):
                        options.append(((f, cut, missing_left), np.array([missing_left if v is None else v < cut for v in x[f]])))
            for name, left in options:
                le, ri = keep & left, keep & ~left
                hl, hr = h[le].sum(), h[ri].sum()
                if hl < p.min_child or hr < p.min_child:
                    continue
                v = round(gain(g[le].sum(), hl, g[ri].sum(), hr), 9)
                if v > p.min_gain and (best is None or v > best[0]):
                    best = (v, name, le, ri)
        if best:
            node.update(split=best[1], gain=best[0], left=grow(best[2], depth + 1, g, h), right=grow(best[3], depth + 1, g, h))
        return node

    def values(node, out):
        if "split" in node:
            values(node["left"], out)
            values(node["right"], out)
        else:
            out[node["rows"]] = node["value"]

    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-margin))
        tree = grow(np.ones(len(y), bool), 0, w * (q - y), w * q * (1 - q))
        add = np.zeros(len(y))
        values(tree, add)
        margin += add
        trees.append(tree)
    return trees, margin


def same(model, tree, i, want):
    assert tree.value[i] == pytest.approx(want["value"], abs=1e-9) and tree.cover[i] == pytest.approx(want["cover"], abs=1e-9)
    assert (tree.feature[i] >= 0) == ("split" in want)
    if "split" in want:
        f, c = tree.feature[i], tree.cut[i]
        name, cut, missing_left = want["split"]
        assert (model.names[f], model.words[f][c] if model.categorical[f] else model.cuts[f][c - 1]) == (name, cut)
        assert tree.gain[i] == pytest.approx(want["gain"], abs=1e-8)
        same(model, tree, tree.left[i], want["left"])
        same(model, tree, tree.right[i], want["right"])


@pytest.fixture(scope="module")
def fitted(spark):
    data = rows()
    p = bo.BoostParams(trees=3, depth=3, **PLAIN)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return data, p, df, bo.fit_boosted(df, "y", ROLES, p, key=["id"], impute=False).models[0]


def test_splits_match_a_plain_version(fitted):
    data, p, _, model = fitted
    weight = sum(r[5] == 0 for r in data) / sum(r[5] == 1 for r in data)
    trees, _ = plain_fit(data, p, weight)
    for got, want in zip(model.trees, trees):
        same(model, got, 0, want)


def test_scores_match_the_plain_margins(spark, fitted, tmp_path):
    data, p, df, model = fitted
    weight = sum(r[5] == 0 for r in data) / sum(r[5] == 1 for r in data)
    _, margin = plain_fit(data, p, weight)
    got = {r["id"]: r["p"] for r in model.add_probability(df, "p").collect()}
    assert [got[i] for i in range(len(data))] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-9)
    model.save(spark, str(tmp_path / "m"))
    again = bo.load_boosted(spark, str(tmp_path / "m"))
    assert {r["id"]: r["p"] for r in again.add_probability(df, "p").collect()} == got
    odd = spark.createDataFrame([(1, None, float("nan"), "never seen", None, None)], SCHEMA)
    assert 0 < model.add_probability(odd.drop("b"), "p").first()["p"] < 1
    assert model.add_probability(odd.limit(0), "p").count() == 0


def test_attributions_match_subset_enumeration(fitted):
    data, _, df, model = fitted
    names = at.player_names(model)
    found = {}
    for r in at.attribute(df, model, ["id"]).collect():
        found.setdefault(r["id"], {})[r["feature"]] = r["attribution"]
    codes = {r[0]: c for r, c in zip(data, _codes(model, data).T)}
    who = at.players(model)

    def value(code, known):
        def go(t, i):
            if t.feature[i] < 0:
                return t.value[i]
            f, c = t.feature[i], t.cut[i]
            if (f, c if model.categorical[f] else -1) in known:
                left = code[f] != c if model.categorical[f] else (t.missing_left[i] if code[f] == 0 else code[f] <= c)
                return go(t, t.left[i] if left else t.right[i])
            le, ri = t.left[i], t.right[i]
            return (t.cover[le] * go(t, le) + t.cover[ri] * go(t, ri)) / (t.cover[le] + t.cover[ri])
        return sum(go(t, 0) for t in model.trees)

    d = len(who)
    for i in list(codes)[:12]:
        worth = {s: value(codes[i], set(s)) for k in range(d + 1) for s in itertools.combinations(who, k)}
        for p, name in zip(who, names):
            want = sum(math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d) *
                       (worth[tuple(sorted((*s, p)))] - w) for s, w in worth.items() if p not in s)
            assert found[i][name] == pytest.approx(want, abs=1e-9)
    sums = {r["id"]: (r["margin"], r["base"]) for r in at.margin(df, model, ["id"]).collect()}
    for i, parts in found.items():
        assert sum(parts.values()) + sums[i][1] == pytest.approx(sums[i][0], abs=1e-9)


def _codes(model, data):
    import pyarrow as pa
    cols = {"a": pa.array([r[1] for r in data]), "b": pa.array([r[2] for r in data]), "team": pa.array([r[3] or "unknown" for r in data]),
            "wet": pa.array([float(r[4]) for r in data])}
    return model.codes([cols[n] for n in model.names])


def test_folds_are_fitted_together(spark):
    """Each fold's scores are those of a model fitted alone on the other folds."""
    data = rows(160, 8, 0.0)
    df = spark.createDataFrame(data, SCHEMA)
    p = bo.BoostParams(trees=2, depth=2, **PLAIN)
    both = bo.fit_boosted(df, "y", ROLES, p, folds=3, key=["id"], impute=False)
    assert both.folds == [-1, 0, 1, 2]
    alone = bo.fit_boosted(df, "y", ROLES, p, key=["id"], impute=False).models[0]
    for a, b in zip(alone.trees, both.models[0].trees):
        assert (a.feature, a.cut, a.left) == (b.feature, b.cut, b.left) and a.value == pytest.approx(b.value)
    from seqrisk.operators.split import stratified_folds
    folded = stratified_folds(df, "y", ["id"], 3, bo.SEED).select("id", "fold").collect()
    fold = {r["id"]: r["fold"] for r in folded}
    weight = sum(r[5] == 0 for r in data) / sum(r[5] == 1 for r in data)
    scores = both.held_out_scores()
    for k in range(3):
        trees, _ = plain_fit([r for r in data if fold[r[0]] != k], p, weight)
        for got, want in zip(both.models[1 + k].trees, trees):
            same(both.models[1 + k], got, 0, want)
    auc = {r["fold"]: r for r in bo.fold_auc(scores).collect()}
    for k in range(3):
        s = [(r["y"], r["score"]) for r in scores.where(f"fold = {k}").collect()]
        pos, neg = [v for y, v in s if y], [v for y, v in s if not y]
        want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        assert (auc[k]["rows"], auc[k]["positives"]) == (len(s), len(pos)) and auc[k]["auc"] == pytest.approx(want)


def test_sampling_and_layout(spark):
    """Samples depend on the key alone: the same trees from any partitioning; margins written anew change nothing."""
    df = spark.createDataFrame(rows(200, 3), SCHEMA)
    p = bo.BoostParams(trees=4, depth=2, rows=0.7, columns=0.6, rate=0.3)
    one = bo.fit_boosted(df.coalesce(1), "y", ROLES, p, key=["id"]).models[0]
    old, bo.REWRITE = bo.REWRITE, 2
    try:
        two = bo.fit_boosted(df.repartition(5), "y", ROLES, p, key=["id"]).models[0]
    finally:
        bo.REWRITE = old
    for a, b in zip(one.trees, two.trees):
        assert (a.feature, a.cut) == (b.feature, b.cut) and a.value == pytest.approx(b.value)


def test_many_categories_and_odd_tables(spark):
    n = 3000
    df = spark.range(n).selectExpr("id", "cast(null as double) a", "cast(id % 3 as double) b", "concat('c', id % 1500) team", "null wet",
                                   "cast(id % 1500 < 40 as int) y")
    m = bo.fit_boosted(df, "y", ROLES, bo.BoostParams(trees=2, depth=2, min_child=0.1, **PLAIN), key=["id"]).models[0]
    assert set(m.words[0].values()) <= {f"c{i}" for i in range(1500)} and len(m.words[0]) <= 6
    one_class = df.withColumn("y", df.y * 0)
    m = bo.fit_boosted(one_class, "y", ROLES, bo.BoostParams(trees=1, depth=2, **PLAIN), key=["id"]).models[0]
    assert all(r["p"] < 0.5 for r in m.add_probability(one_class, "p").select("p").distinct().collect())
    with pytest.raises(ValueError):
        bo.fit_boosted(df.limit(0), "y", ROLES)
    with pytest.raises(ValueError):
        bo.fit_boosted(df.select("id", "y"), "y", ROLES)


def test_packed_rows_and_row_groups_stay_small(spark):
    """A task's rows are packed a few thousand to a table row, and its file has many row groups: no reader or writer holds all."""
    df = spark.range(0, 600_000, 1, 1).select("id", *[F.rand(i).alias(f"x{i}") for i in range(4)], (F.col("id") % 5 == 0).cast("int").alias("y"))
    roles = FeatureRoles(categorical=(), numeric=("x0", "x1", "x2", "x3"), boolean=(), include_interactions=False)
    fit = bo.fit_boosted(df, "y", roles, bo.BoostParams(trees=1, depth=1, rows=1.0, columns=1.0), key=["id"], impute=False)
    assert fit.blocks.agg(F.max("n"), F.sum("n")).first()[:] == (bo.STORED_ROWS, 600_000)
    groups = [g for f in fit.blocks.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file:")).metadata]
              for g in (m.row_group(i).total_byte_size for i in range(m.num_row_groups))]
    assert sum(groups) > 30e6 and max(groups) < 16e6


def test_categories_handed_over_in_pieces_give_the_same_trees(spark, monkeypatch):
    """Histograms of many categories come in ranges and pieces; the split is that of all of them together."""
    df = spark.range(0, 6000, 1, 3).select("id", (F.xxhash64("id") % 900).cast("string").alias("c"), (F.col("id") % 11).cast("double").alias("x"),
                                           ((F.xxhash64("id") % 900 == 7) | (F.col("id") % 11 > 8)).cast("int").alias("y"))
    roles = FeatureRoles(categorical=("c",), numeric=("x",), boolean=(), include_interactions=False)
    params = bo.BoostParams(trees=2, depth=3, rate=0.3, rows=1.0, columns=1.0, min_child=0.1)

    def nodes():
        fit = bo.fit_boosted(df, "y", roles, params, 2, key=["id"])
        scores = sorted((r.fold, r.y, round(r.score, 9)) for r in fit.held_out_scores().collect())
        return [(t.feature, t.cut, t.left, [round(v, 9) for v in t.value]) for m in fit.models for t in m.trees], scores

    whole = nodes()
    assert any(0 in feature for feature, *_ in whole[0]) and len(whole[1]) == 6000
    for name, value in (("STORED_ROWS", 64), ("BLOCK_ROWS", 300), ("HELD", 100), ("RANGE", 32)):
        monkeypatch.setattr(bo, name, value)
    assert nodes() == whole


@pytest.mark.parametrize("columns, folds", [(1.0, 2), (0.7, 0)])
def test_a_task_of_its_own_grows_the_same_trees(spark, monkeypatch, columns, folds):
    """Many trees on few rows are grown in one task per model, with the splits, values and held-out scores that levels of jobs give."""
    df = spark.createDataFrame(rows(600, 3), SCHEMA).repartition(3)
    roles = FeatureRoles(categorical=["team", "a"], numeric=["b", "a"], boolean=["wet"], interactions=[], include_interactions=False)
    params = bo.BoostParams(trees=4, depth=4, rate=0.3, rows=0.8, columns=columns)

    def fitted():
        fit = bo.fit_boosted(df, "y", roles, params, folds, key=["id"], impute=False)
        trees = [(t.feature, t.cut, t.missing_left, t.left, t.right) for m in fit.models for t in m.trees]
        numbers = [v for m in fit.models for t in m.trees for c in (t.value, t.cover, t.gain) for v in c]
        return trees, numbers, sorted((r.fold, r.y, round(r.score, 9)) for r in fit.held_out_scores().collect()), fit.models[0].to_json()

    monkeypatch.setattr(bo, "REWRITE", 2)
    monkeypatch.setattr(bo, "ONE_TASK_ROWS", 0)
    by_levels = fitted()
    monkeypatch.setattr(bo, "ONE_TASK_ROWS", 600)
    monkeypatch.setattr(bo, "_level", None)             # no job of a level
    alone = fitted()
    assert alone[0] == by_levels[0] and np.allclose(alone[1], by_levels[1]) and alone[2] == by_levels[2]
    assert len(alone[0]) == 4 * (1 + folds) and max(len(t[0]) for t in alone[0]) > 9 and bo.from_json(alone[3]).trees[3].left == alone[0][3][3]
