"""Exact additive attribution of boosted trees (M8).

The value of a set of features is the cover-weighted mean of the leaves that
agree with the row on that set (path-dependent expectation); attributions are
the Shapley values of that game. They are computed leaf by leaf: along a leaf's
path every feature has a share of covers (if unknown) and a match of the row (if
known); the weights of all subsets of the path are a polynomial that is built
once by extension and divided by each feature in turn. A split on a category is a
feature of its own, named ``column_category``, as its one-hot column would be.
Base plus attributions is the margin.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqrisk.operators.boosting import BoostedModel, Tree

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def players(model: BoostedModel) -> list[tuple[int, int]]:
    """(feature, category number or -1) of every feature that some tree splits on, in order."""
    return sorted({(f, c if model.categorical[f] else -1) for t in model.trees for f, c in zip(t.feature, t.cut) if f >= 0})


def player_names(model: BoostedModel) -> list[str]:
    return [model.names[f] if c < 0 else f"{model.names[f]}_{model.words[f][c]}" for f, c in players(model)]


def base_value(model: BoostedModel) -> float:
    """The margin when nothing is known: cover-weighted mean of the leaves."""
    def mean(t: Tree, node: int) -> float:
        if t.feature[node] < 0:
            return t.value[node]
        le, ri = t.left[node], t.right[node]
        return (t.cover[le] * mean(t, le) + t.cover[ri] * mean(t, ri)) / (t.cover[le] + t.cover[ri])
    return sum(mean(t, 0) for t in model.trees)


def leaf_paths(tree: Tree) -> Iterator[tuple[float, list[tuple[int, bool]]]]:
    """(value, [(node, whether the path goes left)]) of every leaf."""
    held: list[tuple[int, list[tuple[int, bool]]]] = [(0, [])]
    while held:
        node, path = held.pop()
        if tree.feature[node] < 0:
            yield tree.value[node], path
        else:
            held += [(tree.right[node], [*path, (node, False)]), (tree.left[node], [*path, (node, True)])]


def path_weights(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Per feature of a path (rows of ``one``: whether the data agree, by row of data), the sum over subsets of the
    others of their shares with Shapley's weights."""
    d, n = one.shape
    weights = np.zeros((d + 1, n))
    weights[0] = 1.0
    for k in range(d):                                  # extend the path by feature k
        for j in range(k, -1, -1):
            weights[j + 1] += one[k] * weights[j] * (j + 1) / (k + 2)
            weights[j] *= zero[k] * (k + 1 - j) / (k + 2)
    out = np.zeros((d, n))
    for i in range(d):                                  # take feature i out again and add up
        known = one[i] > 0
        ahead = weights[d].copy()
        total = np.zeros(n)
        for j in range(d - 1, -1, -1):
            with_ = ahead * (d + 1) / (j + 1)
            total += np.where(known, with_, weights[j] * (d + 1) / (zero[i] * (d - j)) if zero[i] > 0 else 0.0)
            ahead = np.where(known, weights[j] - with_ * zero[i] * (d - j) / (d + 1), ahead)
        out[i] = total
    return out


def attributions(model: BoostedModel, codes: np.ndarray) -> np.ndarray:
    """(players x rows) Shapley values of the margin."""
    index = {p: k for k, p in enumerate(players(model))}
    out = np.zeros((len(index), codes.shape[1]))
    for tree in model.trees:
        goes_left: dict[int, np.ndarray] = {}
        for node, f in enumerate(tree.feature):
            if f >= 0:
                code, cut = codes[f], tree.cut[node]
                goes_left[node] = code != cut if model.categorical[f] else np.where(code == 0, tree.missing_left[node], code <= cut)
        for value, path in leaf_paths(tree):
            share: dict[int, float] = {}
            match: dict[int, np.ndarray] = {}
            for node, left in path:
                f = tree.feature[node]
                k = index[f, tree.cut[node] if model.categorical[f] else -1]
                child = tree.left[node] if left else tree.right[node]
                both = tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
                share[k] = share.get(k, 1.0) * tree.cover[child] / both
                agrees = goes_left[node] if left else ~goes_left[node]
                match[k] = match[k] & agrees if k in match else agrees
            if share:
                zero, one = np.array(list(share.values())), np.stack([match[k] for k in share]).astype(float)
                out[list(share)] += (one - zero[:, None]) * path_weights(zero, one) * value
    return out


def attribute(df: DataFrame, model: BoostedModel, ids: Sequence[str] = ()) -> DataFrame:
    """M8: (ids..., feature, attribution) of every row and feature of the trees."""
    d, inputs = model.columns(df)
    ids = list(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = attributions(model, model.codes(b.columns[len(ids):])).T
            yield pa.record_batch([*b.columns[:len(ids)], pa.array(list(found), pa.list_(pa.float64()))], names=[*ids, "__a"])

    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in ids]
    names = F.array(*[F.lit(n) for n in player_names(model)]).cast("array<string>")
    flat = d.select(*ids, *inputs).mapInArrow(work, ", ".join([*kinds, "__a array<double>"]))
    return (flat.select(*ids, F.explode(F.arrays_zip(names.alias("feature"), F.col("__a").alias("attribution"))).alias("__z"))
            .select(*ids, "__z.feature", "__z.attribution"))


def margin(df: DataFrame, model: BoostedModel, ids: Sequence[str] = (), out: str = "margin") -> DataFrame:
    """(ids..., margin, base): the log odds that the attributions add up to."""
    p = model.add_probability(df, "__p").select(*ids, F.log(F.col("__p") / (1 - F.col("__p"))).alias(out))
    return p.withColumn("base", F.lit(base_value(model)))
