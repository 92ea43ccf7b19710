"""Second-order boosted trees on quantile histograms (M3-M6, M8).

Logistic loss; gains from gradients and hessians with an L2 term; numeric
splits at quantile cuts with a learnt direction for missing values; a category
splits off by itself, as its one-hot column would; rows and columns are sampled
per tree; classes are weighted (A6). All models of a cross-validation and the
one on all rows are grown together, so a level of all their trees is one job.

Rows are encoded once, into table rows of packed columns (bins, category
numbers, label, weight, fold, margins) in the shared folder. A level's job reads
them, walks the growing trees, and gives one histogram per (model, node,
feature) and task; these are added up by key, the best split of each feature is
found where its histogram is, and only one split per node comes to the driver.
Categories of any number stay out of it: their numbers come from a join with the
vocabulary, their histograms are sparse, and the model keeps the text of those
that it splits on. Every ``REWRITE`` trees the margins are written anew, so a
row walks a bounded number of trees in each job.

A task's memory does not grow with its rows: a table row packs ``STORED_ROWS`` of
them, row groups are small, packed columns go to Python as RDD rows (a few MB at a
time, where an Arrow batch takes 64), and sparse histograms leave the task in
pieces once they have ``HELD`` entries.

Hundreds of trees are thousands of levels, and on a small table a level's job is
all overhead. Up to ``ONE_TASK_ROWS`` rows a model of more than ``REWRITE`` trees is
grown in one task (the models side by side) by the same rules.

Equal gains (to 9 places) go to the first feature, then to the lowest cut.
"""

from __future__ import annotations

import itertools
import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from seqrisk.config import CV_FOLDS, GBT_PARAMS, SEED, FeatureRoles
from seqrisk.operators.features import UNKNOWN, add_interactions, feature_inputs, stats_table, vocab_table
from seqrisk.operators.split import stratified_folds
from seqrisk.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])      # executors need no copy of this library

BLOCK_ROWS = 1 << 16    # rows that are worked on at once
STORED_ROWS = 1 << 12   # rows packed into one table row
HELD = 1 << 20          # category entries of histograms that a task holds
RANGE = 1 << 15         # category numbers in one row of a histogram
ONE_TASK_ROWS = 1 << 17     # up to so many rows, a task grows a model of many trees by itself
REWRITE = 25            # trees between two writings of the margins
_NONE = -1


@dataclass(frozen=True)
class BoostParams:
    trees: int = GBT_PARAMS["maxIter"]
    depth: int = GBT_PARAMS["maxDepth"]
    rate: float = GBT_PARAMS["stepSize"]
    rows: float = GBT_PARAMS["subsamplingRate"]
    columns: float = float(GBT_PARAMS["featureSubsetStrategy"])
    seed: int = GBT_PARAMS["seed"]
    l2: float = 1.0
    min_child: float = 1.0      # least hessian sum of a child
    min_gain: float = 1e-6
    bins: int = 256


@dataclass
class Tree:
    """Nodes as columns; ``feature`` -1: a leaf. ``cut`` is a bin or a category's number."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for column, v in zip((self.feature, self.cut, self.missing_left, self.left, self.right, self.value, self.cover, self.gain),
                             (_NONE, 0, False, 0, 0, value, cover, 0.0)):
            column.append(v)
        return len(self.feature) - 1


def walk(tree: Tree, codes: np.ndarray, categorical: np.ndarray) -> np.ndarray:
    """The node where each column of ``codes`` (features x rows) ends."""
    n = codes.shape[1]
    at, row = np.zeros(n, np.int64), np.arange(n)
    feature, cut, missing, left, right = (np.array(c) for c in (tree.feature, tree.cut, tree.missing_left, tree.left, tree.right))
    while True:
        f = feature[at]
        live = f != _NONE
        if not live.any():
            return at
        f = np.where(live, f, 0)
        code = codes[f, row]
        to_left = np.where(categorical[f], code != cut[at], np.where(code == 0, missing[at], code <= cut[at]))
        at = np.where(live, np.where(to_left, left[at], right[at]), at)


def _chance(seed: int, *parts: np.ndarray | int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the parts alone."""
    u = np.uint64
    with np.errstate(over="ignore"):
        x = np.asarray(seed, np.int64).astype(u)
        for p in parts:
            x = (x ^ np.asarray(p, np.int64).astype(u)) * u(0x9E3779B97F4A7C15)
            x = (x ^ (x >> u(30))) * u(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> u(27))) * u(0x94D049BB133111EB)
            x = x ^ (x >> u(31))
    return (x >> u(11)).astype(np.float64) / float(1 << 53)


@dataclass
class _Block:
    """The unpacked columns of one table row."""
    row: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    codes: np.ndarray
    margins: np.ndarray

    @staticmethod
    def of(r: Row, models: int) -> "_Block":
        n = r["n"]
        return _Block(np.frombuffer(r["row"], np.int64), np.frombuffer(r["y"], np.float64), np.frombuffer(r["weight"], np.float64),
                      np.frombuffer(r["fold"], np.int32), np.frombuffer(r["codes"], np.int32).reshape(-1, n),
                      np.frombuffer(r["margins"], np.float64).reshape(models, n))

    @staticmethod
    def joined(blocks: Sequence["_Block"]) -> "_Block":
        return _Block(*(np.concatenate([getattr(b, k) for b in blocks], axis=-1) for k in ("row", "y", "weight", "fold", "codes", "margins")))

    def packed(self) -> Iterator[tuple]:
        """Table rows of ``STORED_ROWS`` rows each."""
        for i in range(0, len(self.y), STORED_ROWS):
            at = slice(i, i + STORED_ROWS)
            yield (len(self.y[at]), *(getattr(self, k)[..., at].tobytes() for k in ("row", "y", "weight", "fold", "codes", "margins")))


_BLOCK_SCHEMA = "n int, row binary, y binary, weight binary, fold binary, codes binary, margins binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK_SCHEMA.split(", ")]
# Parquet's writer looks at its size after 100 rows only, and its vectorized reader decodes up to 4096 rows of a row group at once:
# of packed rows that is all a task has.
_BLOCK_FILES = {"parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1",
                "parquet.block.size.row.check.max": "16", "parquet.page.size.row.check.max": "16", "parquet.enable.dictionary": "false"}


def _block_batch(blocks: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*blocks))
    return pa.record_batch([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=_BLOCK_NAMES)


def _blocks(rows: Iterator[Row], models: int) -> Iterator[_Block]:
    """Table rows joined to blocks of about ``BLOCK_ROWS`` rows."""
    held: list[_Block] = []
    for r in rows:
        held.append(_Block.of(r, models))
        if sum(len(b.y) for b in held) >= BLOCK_ROWS:
            yield _Block.joined(held)
            held.clear()
    if held:
        yield _Block.joined(held)


def _frame(rows: RDD, schema: str, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows, schema, verifySchema=False)


def split_gain(gl, hl, gr, hr, l2: float):
    """Loss reduction of a split."""
    return gl * gl / (hl + l2) + gr * gr / (hr + l2) - (gl + gr) ** 2 / (hl + hr + l2)


def best_numeric(g: np.ndarray, h: np.ndarray, p: BoostParams) -> tuple | None:
    """(gain, cut, missing left, GL, HL) over the bins of one feature (bin 0: missing)."""
    best = None
    gc, hc = np.cumsum(g[1:])[:-1], np.cumsum(h[1:])[:-1]
    for missing_left in (False, True):
        gl, hl = (gc + g[0], hc + h[0]) if missing_left else (gc, hc)
        gr, hr = g.sum() - gl, h.sum() - hl
        ok = (hl >= max(p.min_child, 1e-12)) & (hr >= max(p.min_child, 1e-12))
        if not ok.any():
            continue
        gain = np.where(ok, np.round(split_gain(gl, hl, gr, hr, p.l2), 9), -np.inf)
        k = int(np.argmax(gain))
        if best is None or gain[k] > best[0]:
            best = (float(gain[k]), k + 1, missing_left, float(gl[k]), float(hl[k]))
    return best


def best_category(codes: np.ndarray, g: np.ndarray, h: np.ndarray, p: BoostParams, allowed: np.ndarray) -> tuple | None:
    """(gain, category, False, GL, HL): one category goes right, all others left."""
    gl, hl = g.sum() - g, h.sum() - h
    ok = allowed & (codes >= 0) & (hl >= max(p.min_child, 1e-12)) & (h >= max(p.min_child, 1e-12))
    if not ok.any():
        return None
    gain = np.where(ok, np.round(split_gain(gl, hl, g, h, p.l2), 9), -np.inf)
    k = int(np.argmax(gain))                    # codes come in order, so the lowest of equal ones
    return float(gain[k]), int(codes[k]), False, float(gl[k]), float(hl[k])


def _histograms(models: list[int], done: list[list[Tree]], growing: list[Tree], active: list[list[int]], t: int, widths: list[int],
                categorical: np.ndarray, p: BoostParams):
    """Task code: blocks to histograms of the active nodes. ``models``: the fold that each leaves out, or -1;
    ``widths``: bins of numeric features, 0 for categorical ones. Of the latter a row has the numbers of one ``RANGE``, and a
    task that has more than ``HELD`` entries hands them over and begins anew (the next ``piece``)."""

    def work(rows: Iterator[Row]) -> Iterator[tuple]:
        dense: dict[tuple[int, int], np.ndarray] = {}
        sparse: dict[tuple[int, int, int], list] = {}
        part, piece, entries = TaskContext.get().partitionId(), 0, 0

        def handed_over() -> Iterator[tuple]:
            for (m, k, f), pieces in sparse.items():
                c, g, h = _added([np.concatenate(x) for x in zip(*pieces)])
                ends = np.flatnonzero(np.diff(c // RANGE)) + 1
                for lo, hi in zip([0, *ends], [*ends, len(c)]):
                    yield (m, active[m][k], f, int(c[lo] // RANGE), part, piece, c[lo:hi].tobytes(), g[lo:hi].tobytes(), h[lo:hi].tobytes())
            sparse.clear()

        for b in _blocks(rows, len(models)):
            drawn = _chance(p.seed, t, b.row) < p.rows if p.rows < 1 else np.ones(len(b.y), bool)
            for m, fold in enumerate(models):
                nodes = active[m]
                if not nodes:
                    continue
                use = np.flatnonzero(drawn & (b.fold != fold) if fold != _NONE else drawn)
                codes = b.codes[:, use]
                margin = b.margins[m, use]
                for tree in done[m]:
                    margin = margin + np.array(tree.value)[walk(tree, codes, categorical)]
                prob = 1 / (1 + np.exp(-margin))
                g, h = b.weight[use] * (prob - b.y[use]), b.weight[use] * np.maximum(prob * (1 - prob), 1e-16)
                place = np.full(len(growing[m].feature), _NONE)
                place[nodes] = np.arange(len(nodes))
                at = place[walk(growing[m], codes, categorical)]
                live = at != _NONE
                at, g, h, codes = at[live], g[live], h[live], codes[:, live]
                for f, width in enumerate(widths):
                    if width:
                        held = dense.setdefault((m, f), np.zeros((2, len(nodes) * width)))
                        key = at * width + codes[f]
                        held[0] += np.bincount(key, g, len(nodes) * width)
                        held[1] += np.bincount(key, h, len(nodes) * width)
                    else:
                        key, inverse = np.unique(at * (1 << 32) + codes[f], return_inverse=True)
                        found = np.bincount(inverse, g, len(key)), np.bincount(inverse, h, len(key))
                        for k in range(len(nodes)):
                            lo, hi = np.searchsorted(key, [k * (1 << 32) - 1, (k + 1) * (1 << 32) - 1])
                            if hi > lo:
                                sparse.setdefault((m, k, f), []).append((key[lo:hi] - k * (1 << 32), found[0][lo:hi], found[1][lo:hi]))
                                entries += hi - lo
            if entries > 2 * HELD:
                for key, pieces in sparse.items():
                    sparse[key] = [_added([np.concatenate(x) for x in zip(*pieces)])]
                entries = sum(len(pieces[0][0]) for pieces in sparse.values())
                if entries > HELD:
                    yield from handed_over()
                    piece, entries = piece + 1, 0
        for (m, f), held in dense.items():
            for k, node in enumerate(active[m]):
                cut = held[:, k * widths[f]:(k + 1) * widths[f]]
                if cut[1].any():
                    yield m, node, f, 0, part, 0, b"", cut[0].tobytes(), cut[1].tobytes()
        yield from handed_over()

    return work


def _added(piece: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, inverse = np.unique(piece[0].astype(np.int64), return_inverse=True)
    return codes, np.bincount(inverse, piece[1], len(codes)), np.bincount(inverse, piece[2], len(codes))


def _best_splits(t: int, widths: list[int], allowed: list[bool], p: BoostParams):
    """Task code: histograms sorted by (model, node, feature, range, part, piece) to each feature's best split and the node's
    totals. What a feature's categories add up to is held whole; the rows that are added are not."""

    def one_range(rows: Iterator[Row]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held: list = []
        for r in rows:
            held.append((np.frombuffer(r["codes"], np.int64), np.frombuffer(r["g"]), np.frombuffer(r["h"])))
            if sum(len(c) for c, *_ in held) > 8 * RANGE:
                held = [_added([np.concatenate(x) for x in zip(*held)])]
        return _added([np.concatenate(x) for x in zip(*held)])

    def work(rows: Iterator[Row]) -> Iterator[tuple]:
        for (m, node, f), some in itertools.groupby(rows, key=lambda r: (r["model"], r["node"], r["feature"])):
            if widths[f]:
                g = h = 0.0
                for r in some:
                    g, h = g + np.frombuffer(r["g"]), h + np.frombuffer(r["h"])
                found = best_numeric(g, h, p) if allowed[f] else None
            else:
                codes, g, h = (np.concatenate(x) for x in zip(*(one_range(own) for _, own in itertools.groupby(some, key=lambda r: r["range"]))))
                found = best_category(codes, g, h, p, _chance(p.seed, t, f, codes) < p.columns if p.columns < 1 else np.ones(len(codes), bool))
            gain, cut, missing, gl, hl = found or (-1.0, 0, False, 0.0, 0.0)
            yield m, node, f, gain, cut, missing, gl, hl, float(g.sum()), float(h.sum())

    return work


def _allowed(t: int, widths: list[int], p: BoostParams) -> list[bool]:
    """Which features a tree may split on; the categories of a feature are drawn one by one."""
    allowed = [bool(_chance(p.seed, t, f, _NONE) < p.columns) for f in range(len(widths))]
    return allowed if any(allowed) or not all(widths) else [True] * len(widths)


def _level(blocks: DataFrame, models: list[int], done: list[list[Tree]], growing: list[Tree], active: list[list[int]], t: int,
           widths: list[int], categorical: np.ndarray, p: BoostParams) -> list:
    """One row per active node: its best split and totals."""
    spark = blocks.sparkSession
    hist = _frame(blocks.rdd.mapPartitions(_histograms(models, done, growing, active, t, widths, categorical, p)),
                  "model int, node int, feature int, range int, part int, piece int, codes binary, g binary, h binary", spark)
    allowed = _allowed(t, widths, p)
    keys = ["model", "node", "feature"]
    dealt = hist.repartition(*keys).sortWithinPartitions(*keys, "range", "part", "piece")
    found = _frame(dealt.rdd.mapPartitions(_best_splits(t, widths, allowed, p)), "model long, node long, feature long, gain double, cut long, "
                                                                               "missing boolean, gl double, hl double, g double, h double", spark)
    order = F.struct(F.col("gain"), -F.col("feature"), -F.col("cut"))
    return (found.groupBy("model", "node")
            .agg(F.max_by(F.struct("feature", "gain", "cut", "missing", "gl", "hl", "g", "h"), order).alias("s")).collect())


def _weight(g: float, h: float, p: BoostParams) -> float:
    return -p.rate * g / (h + p.l2)


def _grow(blocks: DataFrame, models: list[int], done: list[list[Tree]], t: int, widths: list[int], categorical: np.ndarray,
          p: BoostParams) -> list[Tree]:
    """The next tree of every model."""
    growing = [Tree() for _ in models]
    active: list[list[int]] = [[tree.add(0.0, 0.0)] for tree in growing]
    for depth in range(max(p.depth, 1)):
        found = _level(blocks, models, done, growing, active, t, widths, categorical, p)
        active = [[] for _ in models]
        for r in sorted(found, key=lambda r: (r["model"], r["node"])):
            tree, node, s = growing[r["model"]], r["node"], r["s"]
            if depth == 0:
                tree.value[node], tree.cover[node] = _weight(s["g"], s["h"], p), s["h"]
            if s["gain"] <= p.min_gain or p.depth < 1:
                continue
            tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = s["feature"], s["cut"], s["missing"], s["gain"]
            tree.left[node] = tree.add(_weight(s["gl"], s["hl"], p), s["hl"])
            tree.right[node] = tree.add(_weight(s["g"] - s["gl"], s["h"] - s["hl"], p), s["h"] - s["hl"])
            active[r["model"]] += [tree.left[node], tree.right[node]]
        if not any(active):
            break
    return growing


def _with_margins(blocks: DataFrame, models: list[int], done: list[list[Tree]], categorical: np.ndarray) -> DataFrame:
    """The blocks with the trees ``done`` added to their margins, written anew."""
    def work(rows: Iterator[Row]) -> Iterator[tuple]:
        for b in _blocks(rows, len(models)):
            b.margins = np.stack([b.margins[m] + sum(np.array(t.value)[walk(t, b.codes, categorical)] for t in done[m]) for m in range(len(models))])
            yield from b.packed()

    return cut_lineage(_frame(blocks.rdd.mapPartitions(work), _BLOCK_SCHEMA, blocks.sparkSession), _BLOCK_FILES)


def _numeric_splits(at: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, numbers: list[int], widths: list[int],
                    p: BoostParams) -> tuple[np.ndarray, ...]:
    """``best_numeric`` of many nodes and of the features ``numbers``, and the best of these by node; ``at``: the node of each row."""
    count, width = len(numbers), max(widths[f] for f in numbers)
    key = (at * (count * width) + np.arange(count)[:, None] * width + codes[numbers]).ravel()
    gb, hb = (np.bincount(key, np.tile(x, count), nodes * count * width).reshape(nodes * count, width) for x in (g, h))
    all_g, all_h = gb.sum(axis=1, keepdims=True), hb.sum(axis=1, keepdims=True)
    gc, hc = np.cumsum(gb[:, 1:], axis=1)[:, :-1], np.cumsum(hb[:, 1:], axis=1)[:, :-1]
    cuts = np.tile([widths[f] - 2 for f in numbers], nodes)[:, None] > np.arange(width - 2)
    every, tried = np.arange(nodes * count), []
    for missing_left in (False, True):
        gl, hl = (gc + gb[:, :1], hc + hb[:, :1]) if missing_left else (gc, hc)
        ok = cuts & (hl >= max(p.min_child, 1e-12)) & (all_h - hl >= max(p.min_child, 1e-12))
        gain = np.where(ok, np.round(split_gain(gl, hl, all_g - gl, all_h - hl, p.l2), 9), -np.inf)
        k = np.argmax(gain, axis=1)
        tried.append((gain[every, k], k + 1, np.full(len(every), missing_left), gl[every, k], hl[every, k]))
    later = tried[1][0] > tried[0][0]
    found = [*(np.where(later, b, a) for a, b in zip(*tried)), all_g[:, 0], all_h[:, 0]]
    first = np.argmax(found[0].reshape(nodes, count), axis=1)
    return np.array(numbers)[first], *(x.reshape(nodes, count)[np.arange(nodes), first] for x in found)


def _category_splits(at: np.ndarray, codes: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, draw, p: BoostParams) -> tuple[np.ndarray, ...]:
    """``best_category`` of many nodes; ``at``: the node of each row, ``draw``: whether a category may be split off."""
    key, inverse = np.unique(at * (1 << 32) + codes, return_inverse=True)
    node = (key + 1) >> 32                      # an unknown category is -1
    code = key - (node << 32)
    cg, ch = np.bincount(inverse, g, len(key)), np.bincount(inverse, h, len(key))
    all_g, all_h = np.bincount(node, cg, nodes), np.bincount(node, ch, nodes)
    gl, hl = all_g[node] - cg, all_h[node] - ch
    ok = draw(code) & (code >= 0) & (hl >= max(p.min_child, 1e-12)) & (ch >= max(p.min_child, 1e-12))
    gain = np.where(ok, np.round(split_gain(gl, hl, cg, ch, p.l2), 9), -np.inf)
    top = np.maximum.reduceat(gain, np.searchsorted(node, np.arange(nodes)))
    best = np.flatnonzero(gain == top[node])
    best = best[np.searchsorted(node[best], np.arange(nodes))]      # the lowest category of equal ones
    return gain[best], code[best], np.zeros(nodes, bool), gl[best], hl[best], all_g, all_h


def _grow_alone(codes: np.ndarray, g: np.ndarray, h: np.ndarray, t: int, widths: list[int], categorical: np.ndarray, p: BoostParams) -> Tree:
    """``_grow`` for one model whose sampled rows are all at hand."""
    tree, allowed = Tree(), _allowed(t, widths, p)
    numbers = [f for f, width in enumerate(widths) if width > 2 and allowed[f]]
    active, at = [tree.add(0.0, 0.0)], np.zeros(codes.shape[1], np.int64)
    for depth in range(max(p.depth, 1)):
        if not len(at):
            break
        n = len(active)
        none = np.zeros(n)
        best = none.astype(int), none - np.inf, none.astype(int), none.astype(bool), none, none, np.bincount(at, g, n), np.bincount(at, h, n)
        tried = [_numeric_splits(at, codes, g, h, n, numbers, widths, p)] if numbers else []
        for f in range(len(widths)):
            if not widths[f]:
                draw = (lambda c, f=f: _chance(p.seed, t, f, c) < p.columns) if p.columns < 1 else (lambda c: np.ones(len(c), bool))
                tried.append((np.full(n, f), *_category_splits(at, codes[f], g, h, n, draw, p)))
        for found in tried:
            better = (found[1] > best[1]) | ((found[1] == best[1]) & (found[0] < best[0]))
            best = tuple(np.where(better, b, a) for a, b in zip(best, found))
        place = np.full((2, n), _NONE)           # of the left and right child among the next level's nodes
        following: list[int] = []
        for k, (f, gain, cut, missing, gl, hl, all_g, all_h) in enumerate(zip(*(x.tolist() for x in best))):
            node = active[k]
            if depth == 0:
                tree.value[node], tree.cover[node] = _weight(all_g, all_h, p), all_h
            if gain <= p.min_gain or p.depth < 1:
                continue
            tree.feature[node], tree.cut[node], tree.missing_left[node], tree.gain[node] = f, cut, missing, gain
            tree.left[node] = tree.add(_weight(gl, hl, p), hl)
            tree.right[node] = tree.add(_weight(all_g - gl, all_h - hl, p), all_h - hl)
            place[:, k] = len(following), len(following) + 1
            following += [tree.left[node], tree.right[node]]
        f, cut, missing = best[0][at], best[2][at], best[3][at]
        code = codes[f, np.arange(len(at))]
        left = np.where(categorical[f], code != cut, np.where(code == 0, missing, code <= cut))
        at = np.where(left, place[0][at], place[1][at])
        live = at != _NONE
        at, g, h, codes, active = at[live], g[live], h[live], codes[:, live], following
    return tree


def _grown_alone(blocks: DataFrame, models: list[int], widths: list[int], categorical: np.ndarray, p: BoostParams) -> list[list[Tree]]:
    """All trees of every model, a task for each model."""
    def work(rows: Iterator[tuple[int, Row]]) -> Iterator[tuple[int, list[dict]]]:
        of: dict[int, list] = {}
        for m, r in rows:
            of.setdefault(m, []).append(r)
        for m, own in of.items():
            b = _Block.joined([_Block.of(r, len(models)) for r in sorted(own, key=lambda r: bytes(r["row"]))])
            use = np.flatnonzero(b.fold != models[m]) if models[m] != _NONE else np.arange(len(b.y))
            row, y, weight, codes, margin = b.row[use], b.y[use], b.weight[use], b.codes[:, use], b.margins[m, use].copy()
            trees = []
            for t in range(p.trees):
                drawn = np.flatnonzero(_chance(p.seed, t, row) < p.rows) if p.rows < 1 else np.arange(len(row))
                prob = 1 / (1 + np.exp(-margin[drawn]))
                g, h = weight[drawn] * (prob - y[drawn]), weight[drawn] * np.maximum(prob * (1 - prob), 1e-16)
                tree = _grow_alone(codes[:, drawn], g, h, t, widths, categorical, p)
                margin += np.array(tree.value)[walk(tree, codes, categorical)]
                trees.append(asdict(tree))
            yield m, trees

    count = len(models)
    dealt = blocks.rdd.flatMap(lambda r: [(m, r) for m in range(count)]).partitionBy(count, int)
    grown = dict(dealt.mapPartitions(work).collect())
    return [[Tree(**t) for t in grown[m]] for m in range(count)]


@dataclass
class BoostedModel:
    """Fitted trees with the inputs they read. ``cuts``: thresholds of numeric features (x < cut goes left);
    ``words``: text of the category numbers that are split on."""
    names: list[str]
    categorical: list[bool]
    cuts: dict[int, list[float]]
    words: dict[int, dict[int, str]]
    fill: dict[str, float]
    interactions: list[tuple[str, str]]
    trees: list[Tree]
    params: dict
    indexed: bool = False       # categories come as whole numbers from 0, and none has a text

    def columns(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        """``df`` with its interactions, and the feature columns; one that ``df`` lacks is null."""
        d = add_interactions(df, [tuple(i) for i in self.interactions])
        return d, _inputs(d, self.names, self.categorical, self.fill, self.indexed)

    def codes(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """Bins and category numbers of Arrow feature columns."""
        return _encode(columns, self.categorical, self.cuts, {f: {w: c for c, w in words.items()} for f, words in self.words.items()})

    def margins(self, codes: np.ndarray) -> np.ndarray:
        flags = np.array(self.categorical, bool)
        out = np.zeros(codes.shape[1])
        for tree in self.trees:
            out += np.array(tree.value)[walk(tree, codes, flags)]
        return out

    def add_probability(self, df: DataFrame, out: str) -> DataFrame:
        """M6: ``df`` with the probability of class 1."""
        model = self

        @F.pandas_udf("double")
        def probability(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(1 / (1 + np.exp(-model.margins(model.codes([pa.Array.from_pandas(c) for c in columns])))))

        d, inputs = self.columns(df)
        return d.select(*[F.col(f"`{c}`") for c in df.columns], probability(*inputs).alias(out))

    def importance(self, spark: SparkSession) -> DataFrame:
        """Total gain of each feature, as a share of all."""
        gain = dict.fromkeys(self.names, 0.0)
        for tree in self.trees:
            for f, g in zip(tree.feature, tree.gain):
                if f != _NONE:
                    gain[self.names[f]] += g
        total = sum(gain.values()) or 1.0
        return spark.createDataFrame([(k, v / total) for k, v in gain.items()], "feature string, importance double")

    def node_table(self, spark: SparkSession) -> DataFrame:
        """One row per node: the model as a table. ``path``: its turns from the root, L and R."""
        def paths(tree: Tree) -> list[str]:
            out = [""] * len(tree.feature)
            for i, f in enumerate(tree.feature):        # children come behind their parent
                if f != _NONE:
                    out[tree.left[i]], out[tree.right[i]] = out[i] + "L", out[i] + "R"
            return out

        rows = [(t, i, path, self.names[f] if f != _NONE else None, self.cuts[f][c - 1] if f != _NONE and not self.categorical[f] else None,
                 self.words[f].get(c, str(c)) if f != _NONE and self.categorical[f] else None, bool(m), le if f != _NONE else None, ri if f != _NONE else None, v, h, g)
                for t, tree in enumerate(self.trees)
                for i, (path, f, c, m, le, ri, v, h, g) in enumerate(zip(paths(tree), tree.feature, tree.cut, tree.missing_left, tree.left, tree.right,
                                                                     tree.value, tree.cover, tree.gain))]
        return spark.createDataFrame(rows, "tree int, node int, path string, feature string, threshold double, category string, missing_left boolean, "
                                           "left int, right int, value double, cover double, gain double")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    def save(self, spark: SparkSession, path: str) -> None:
        """M5: everything as one file, written by one commit."""
        spark.createDataFrame([(self.to_json(),)], "model string").coalesce(1).write.mode("overwrite").text(path)


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    """M5: the model that ``save`` wrote."""
    return from_json(spark.read.text(path).first()[0])


def from_json(text: str) -> BoostedModel:
    d = json.loads(text)
    d["cuts"] = {int(k): v for k, v in d["cuts"].items()}
    d["words"] = {int(k): {int(c): w for c, w in v.items()} for k, v in d["words"].items()}
    d["trees"] = [Tree(**t) for t in d["trees"]]
    return BoostedModel(**d)


def _inputs(df: DataFrame, names: Sequence[str], categorical: Sequence[bool], fill: dict[str, float], indexed: bool = False) -> list[Column]:
    out = []
    for name, is_category in zip(names, categorical):
        if is_category and indexed:
            c = F.col(name).cast("int") if name in df.columns else F.lit(None).cast("int")
        elif is_category:
            c = F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN)) if name in df.columns else F.lit(UNKNOWN)
        else:
            c = F.col(name).cast("double") if name in df.columns else F.lit(None).cast("double")
            c = F.when(~F.isnan(c), c)
            if name in fill:
                c = F.coalesce(c, F.lit(float(fill[name])))
        out.append(c.alias(f"__f{len(out)}"))
    return out


def _encode(columns: Sequence[pa.Array], categorical: Sequence[bool], cuts: dict[int, list[float]], numbers: dict[int, dict[str, int]]) -> np.ndarray:
    n = len(columns[0])
    out = np.zeros((len(columns), n), np.int32)
    for f, column in enumerate(columns):
        if categorical[f]:
            if pa.types.is_integer(column.type):
                out[f] = column.fill_null(_NONE).to_numpy(zero_copy_only=False)
            elif pa.types.is_floating(column.type):          # whole numbers that pandas holds as floats beside nulls
                out[f] = np.nan_to_num(column.to_numpy(zero_copy_only=False), nan=_NONE)
            else:
                known = numbers.get(f, {})
                out[f] = [known.get(v, _NONE) for v in column.to_pylist()]
        else:
            x = column.cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[f] = np.where(np.isnan(x), 0, 1 + np.searchsorted(np.array(cuts[f], float), x, side="right"))
    return out


def _quantile_cuts(rows: DataFrame, numeric: list[int], bins: int) -> dict[int, list[float]]:
    """Different quantiles of each numeric feature, in one pass: (features x bins) numbers at most."""
    if not numeric:
        return {}
    at = F.array(*[F.lit(i / bins) for i in range(bins)], F.lit(1.0))
    got = rows.agg(*[F.percentile_approx(f"__f{f}", at, bins * 40).alias(f"q{f}") for f in numeric]).first()
    return {f: sorted(set(got[f"q{f}"] or [])) for f in numeric}


@dataclass
class BoostedFit:
    """What training leaves: the models (of all rows first, if asked for, then one per fold) and the encoded rows."""
    models: list[BoostedModel]
    folds: list[int]
    blocks: DataFrame

    def held_out_scores(self) -> DataFrame:
        """(fold, y, score): each row scored by the model that did not see its fold."""
        at = {fold: m for m, fold in enumerate(self.folds) if fold != _NONE}
        models = len(self.folds)

        def work(rows: Iterator[Row]) -> Iterator[tuple]:
            for r in rows:
                b = _Block.of(r, models)
                for fold, m in at.items():
                    own = b.fold == fold
                    yield fold, b.y[own].astype(np.int32).tolist(), (1 / (1 + np.exp(-b.margins[m, own]))).tolist()

        packed = _frame(self.blocks.rdd.mapPartitions(work), "fold int, y array<int>, score array<double>", self.blocks.sparkSession)
        return packed.select("fold", F.inline(F.arrays_zip("y", "score")))


def fit_boosted(train: DataFrame, label: str = "sc_next_lap", roles: FeatureRoles = FeatureRoles(), params: BoostParams = BoostParams(),
                folds: int = 0, whole: bool = True, key: Sequence[str] | None = None, weighted: bool = True, impute: bool = True,
                indexed: bool = False) -> BoostedFit:
    """M3 and M4: the model of all rows (``whole``) and, with ``folds``, one per stratified fold, in the same passes.

    Rows without a label are left out. ``weighted``: positives weigh negatives / positives (A6). ``impute``: numeric nulls
    take the training median (A7), else they are missing values with a learnt direction. ``key``: columns that tell rows
    apart; they seed the row sample and the folds. ``indexed``: the categorical columns hold whole numbers from 0 already,
    one per category. No rows with a label is an error, as is a table without any feature."""
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    cat, num, boo = feature_inputs(add_interactions(train, roles.interactions) if roles.include_interactions else train, roles)
    names, categorical = cat + num + boo, [True] * len(cat) + [False] * (len(num) + len(boo))
    if not names:
        raise ValueError("no feature column to train on")
    key = list(key) if key else [c for c, t in train.dtypes if not t.startswith(("array", "map", "struct"))]
    if folds:
        train = stratified_folds(train, label, key, folds, SEED)
    d = add_interactions(train, roles.interactions) if roles.include_interactions else train
    fold = F.col("fold").cast("int") if folds else F.lit(_NONE)
    raw = [F.col(label).cast("double").alias("__y"), fold.alias("__fold"), F.xxhash64(*key).alias("__row")]
    rows = cut_lineage(d.select(*raw, *_inputs(d, names, categorical, {}, indexed)))        # feeds the medians, cuts, vocabulary and blocks
    n0, n1 = rows.agg(F.count_if(F.col("__y") == 0), F.count_if(F.col("__y") == 1)).first()
    if not n0 + n1:
        raise ValueError("no row with a label to train on")
    fill: dict[str, float] = {}
    if impute and num:
        at = {f"__f{names.index(c)}": c for c in num}
        fill = {at[r["feature"]]: r["median"] for r in stats_table(rows, list(at)).collect() if r["median"] is not None}
    filled = rows.withColumns({f"__f{names.index(c)}": F.coalesce(F.col(f"__f{names.index(c)}"), F.lit(float(v))) for c, v in fill.items()}) if fill else rows
    numeric = [f for f, c in enumerate(categorical) if not c]
    cuts = _quantile_cuts(filled, numeric, params.bins)
    vocab = None
    if cat and not indexed:
        vocab = cut_lineage(vocab_table(rows, [f"__f{f}" for f in range(len(cat))]))
        for f in range(len(cat)):
            one = vocab.where(F.col("feature") == f"__f{f}").select(F.col("category").alias(f"__c{f}"), F.col("position").alias(f"__p{f}"))
            filled = filled.join(one, F.col(f"__f{f}") == F.col(f"__c{f}"), "left").drop(f"__c{f}")
    models = ([_NONE] if whole or not folds else []) + list(range(folds))
    weight = n0 / n1 if weighted and n0 and n1 else 1.0
    inputs = [F.col(f"__p{f}") if c and not indexed else F.col(f"__f{f}") for f, c in enumerate(categorical)]
    blocks = cut_lineage(filled.select("__y", "__fold", "__row", *inputs).mapInArrow(_into_blocks(categorical, cuts, weight, len(models)), _BLOCK_SCHEMA),
                         _BLOCK_FILES)
    flags = np.array(categorical, bool)
    widths = [0 if c else len(cuts[f]) + 2 for f, c in enumerate(categorical)]
    grown: list[list[Tree]] = [[] for _ in models]
    fresh: list[list[Tree]] = [[] for _ in models]
    alone = params.trees > REWRITE and n0 + n1 <= ONE_TASK_ROWS
    if alone:
        grown = _grown_alone(blocks, models, widths, flags, params)
        blocks = _with_margins(blocks, models, grown, flags)
    for t in range(0 if alone else params.trees):
        for m, tree in enumerate(_grow(blocks, models, fresh, t, widths, flags, params)):
            grown[m].append(tree)
            fresh[m].append(tree)
        if len(fresh[0]) == REWRITE or t + 1 == params.trees:
            blocks = _with_margins(blocks, models, fresh, flags)
            fresh = [[] for _ in models]
    words = _split_words(spark, vocab, grown, categorical) if not indexed else {f: {} for f, c in enumerate(categorical) if c}
    pairs = list(roles.interactions) if roles.include_interactions else []
    return BoostedFit([BoostedModel(names, categorical, cuts, words, fill, pairs, trees, asdict(params), indexed) for trees in grown], models, blocks)


def _into_blocks(categorical: Sequence[bool], cuts: dict[int, list[float]], weight: float, models: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Block] = []

        def joined() -> pa.RecordBatch:
            b = _Block.joined(held)
            held.clear()
            return _block_batch(list(b.packed()))

        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            held.append(_Block(batch.column(2).to_numpy(zero_copy_only=False), y, np.where(y == 1, weight, 1.0),
                               batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32),
                               _encode(batch.columns[3:], categorical, cuts, {}), np.zeros((models, len(y)))))
            if sum(len(h.y) for h in held) >= BLOCK_ROWS:
                yield joined()
        if held:
            yield joined()

    return work


def _split_words(spark: SparkSession, vocab: DataFrame | None, grown: list[list[Tree]], categorical: list[bool]) -> dict[int, dict[int, str]]:
    """Text of the categories that some tree splits on: as many as there are such splits at most."""
    used = sorted({(f, c) for trees in grown for t in trees for f, c in zip(t.feature, t.cut) if f != _NONE and categorical[f]})
    out: dict[int, dict[int, str]] = {f: {} for f, c in enumerate(categorical) if c}
    if used:
        asked = spark.createDataFrame([(f"__f{f}", c) for f, c in used], "feature string, position int")
        for r in vocab.join(F.broadcast(asked), ["feature", "position"]).collect():
            out[int(r["feature"][3:])][r["position"]] = r["category"]
    return out


def cross_validate_boosted(train: DataFrame, label: str = "sc_next_lap", key: Sequence[str] | None = None, k: int = CV_FOLDS,
                           roles: FeatureRoles = FeatureRoles(), params: BoostParams = BoostParams(), impute: bool = True) -> DataFrame:
    """M4 (+T4) in one pass: (fold, y, score) of every row, from the model that did not see it."""
    return cut_lineage(fit_boosted(train, label, roles, params, k, False, key, impute=impute).held_out_scores())


def fold_auc(scores: DataFrame) -> DataFrame:
    """(fold, rows, positives, auc) of all folds at once, ties counting half."""
    from seqrisk.operators.ranking import running_sums
    one = scores.groupBy("fold", "score").agg(F.sum((F.col("y") == 1).cast("long")).alias("pos"), F.sum((F.col("y") == 0).cast("long")).alias("neg"))
    run = running_sums(one, [F.col("score").desc()], {"tps": F.col("pos")}, ["fold"])
    area = F.sum(F.col("neg") * (F.col("tps") - F.col("pos") / 2.0))
    p, n = F.sum("pos"), F.sum("neg")
    return run.groupBy("fold").agg((p + n).alias("rows"), p.alias("positives"), F.when((p > 0) & (n > 0), area / (p.cast("double") * n)).alias("auc"))
