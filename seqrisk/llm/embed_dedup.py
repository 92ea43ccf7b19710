"""Embedding near-dedup (2): PCA-ordered tiled comparison.

Vectors are compared only when their labels (and lengths) are equal. Equal
vectors are one class with a count. Unit vectors are turned onto principal
axes, so that the leading coordinates carry most of a product. Coordinates
along the first axes put each class into a grid cell as wide as the largest
distance that the threshold allows: only tiles of the same or neighbouring
cells can hold a link. Cells are dealt by hash into tiles of about
``TILE_ROWS`` classes, and pairs of tiles are compared independently of each
other. Within a pair the leading coordinates are multiplied first; the rest
of a product is at most the product of the suffix norms, and a pair of vectors
is dropped as soon as its cosine cannot reach the threshold any more.

A pair of tiles returns, for each of its vectors with a link, the number of
vectors linked and the smallest node it reaches within the pair: the counts
stay exact and no list of all links is ever made. The axes come from a bounded
sample (``SAMPLE_ROWS``) and only decide the speed. Cosines within 1e-9 of the
threshold are computed again from the given components.

Defined cases: null labels, null ids, vectors that are null, empty, zero or
hold null, NaN or infinite components link with nothing and are kept; rows
that share an id are one vector if they are equal; an empty table gives an
empty result; columns beside id, vector and label are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from seqrisk.llm.common import by_value, saved
from seqrisk.llm.components import components

THRESHOLD = 0.93
TILE_ROWS = 1024
SAMPLE_ROWS = 10_000
AXES = 3
STEPS = (8, 24, 64, 256)     # leading coordinates after which products are bounded again
SLACK = 1e-9
by_value(__name__)


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)          # no overflow in the squares
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(classes: DataFrame, sample_rows: int) -> dict[int, np.ndarray]:
    """Axes per vector length, strongest first, from a sample of at most ``sample_rows``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moment: dict[int, np.ndarray] = {}
        for batch in batches:
            for v in batch.column(0):
                z = _unit(v.values.to_numpy(zero_copy_only=False), len(v))
                moment[len(v)] = moment.get(len(v), 0) + z.T @ z
        for dim, m in moment.items():
            axes = np.linalg.eigh(m)[1][:, ::-1]
            yield pa.record_batch([pa.array([dim], pa.int32()), pa.array([axes.ravel().tolist()], pa.list_(pa.float64()))], names=["dim", "axes"])

    sample = classes.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("vector").repartition(1)
    found = sample.mapInArrow(work, "dim int, axes array<double>").collect()   # one row per vector length in the sample
    return {r.dim: np.array(r.axes).reshape(r.dim, r.dim) for r in found}


def _turn(flat: np.ndarray, dim: int, axes: dict[int, np.ndarray]) -> np.ndarray:
    z = _unit(flat, dim)
    return z @ axes[dim] if dim in axes else z


def linked(za: np.ndarray, zb: np.ndarray, xa: np.ndarray, xb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs with cosine >= ``least``. z: turned unit vectors, x: unit vectors."""
    dim = za.shape[1]
    cuts = [0, *[s for s in STEPS if s < dim], dim]
    rest_a, rest_b = (np.sqrt(np.maximum(np.cumsum((z ** 2)[:, ::-1], axis=1)[:, ::-1], 0)) for z in (za, zb))
    product = za[:, :cuts[1]] @ zb[:, :cuts[1]].T
    i = j = None
    for at, end in zip(cuts[1:], cuts[2:]):
        if i is None:
            can = product + rest_a[:, at][:, None] * rest_b[:, at][None, :] >= least - SLACK
            if can.sum() * 4 > can.size:                   # most can still reach it: whole tiles are cheaper
                product = product + za[:, at:end] @ zb[:, at:end].T
                continue
            i, j = np.nonzero(can)
            product = product[i, j]
        else:
            can = product + rest_a[i, at] * rest_b[j, at] >= least - SLACK
            i, j, product = i[can], j[can], product[can]
        product = product + np.einsum("ij,ij->i", za[i, at:end], zb[j, at:end])
    if i is None:
        i, j = np.nonzero(product >= least - SLACK)
        product = product[i, j]
    near = np.abs(product - least) <= SLACK
    product[near] = np.einsum("ij,ij->i", xa[i[near]], xb[j[near]])
    yes = product >= least
    return i[yes], j[yes]


def _smallest(n: int, i: np.ndarray, j: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Smallest node that each of n vectors reaches over the pairs i, j."""
    root = node.copy()
    while True:
        low = np.minimum(root[i], root[j])
        now = root.copy()
        np.minimum.at(now, i, low)
        np.minimum.at(now, j, low)
        if (now == root).all():
            return root
        root = now


def _tiles(classes: DataFrame, axes: dict[int, np.ndarray], width: float, tile_rows: int) -> tuple[DataFrame, DataFrame]:
    """(tiles: tile, nodes, counts, vectors, dim; pairs: a, b with a <= b)."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(0):
                z = _turn(v.values.to_numpy(zero_copy_only=False), len(v), axes)[0, :AXES]
                found.append(np.floor(np.append(z, np.zeros(AXES - len(z))) / width).astype(np.int32).tolist())
            yield pa.record_batch([*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=["vector", "node", "n", "label", "cell"])

    rows = classes.select("vector", "node", "n", "label")
    schema = StructType([*rows.schema.fields, StructField("cell", ArrayType(IntegerType()))])
    placed = saved(rows.mapInArrow(cells, schema).withColumn("dim", F.size("vector")))
    cell = saved(placed.groupBy("label", "dim", "cell").agg(F.count("*").alias("rows"))
                 .withColumn("parts", F.ceil(F.col("rows") / tile_rows)))
    named = lambda part: F.xxhash64("label", "dim", "cell", part)
    sized = placed.join(cell.drop("rows"), ["label", "dim", "cell"])
    tiles = (sized.withColumn("tile", named(F.pmod(F.xxhash64("node"), F.col("parts"))))
             .groupBy("tile").agg(F.collect_list(F.struct("node", "n", "vector")).alias("v"), F.first("dim").alias("dim"))
             .select("tile", "dim", F.col("v.node").alias("nodes"), F.col("v.n").alias("counts"), F.flatten("v.vector").alias("values")))
    steps = F.array(*[F.lit(s) for s in (-1, 0, 1)])
    near = cell
    for k in range(AXES):
        near = near.withColumn(f"s{k}", F.explode(steps))
    near = near.select("label", "dim", "parts", F.col("cell").alias("own"),
                       F.array(*[(F.col("cell")[k] + F.col(f"s{k}")).cast("int") for k in range(AXES)]).alias("cell"))
    part = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    both = (near.join(cell.select("label", "dim", "cell", F.col("parts").alias("other")), ["label", "dim", "cell"])
            .withColumn("p", part("parts")).withColumn("q", part("other")))
    pairs = both.select(F.xxhash64("label", "dim", "own", "p").alias("a"), named(F.col("q")).alias("b")).where("a <= b")
    return saved(tiles), pairs


def compare_tiles(pairs: DataFrame, tiles: DataFrame, axes: dict[int, np.ndarray], least: float) -> DataFrame:
    """(node, links, root) of every vector with a link within a pair of tiles."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(c)[k] for c, n in enumerate(batch.schema.names)}
                dim = row["dim"].as_py()
                node, n, x, z = {}, {}, {}, {}
                for s in "ab":
                    node[s], n[s], flat = (row[f"{c}_{s}"].values.to_numpy(zero_copy_only=False) for c in ("nodes", "counts", "values"))
                    x[s], z[s] = _unit(flat, dim), _turn(flat, dim, axes)
                i, j = linked(z["a"], z["b"], x["a"], x["b"], least)
                if row["a"].as_py() == row["b"].as_py():
                    i, j = i[i < j], j[i < j]
                if not len(i):
                    continue
                ids, at = np.unique(np.concatenate([node["a"], node["b"]]), return_inverse=True)
                a, b = at[:len(node["a"])][i], at[len(node["a"]):][j]
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, a, n["b"][j])
                np.add.at(links, b, n["a"][i])
                root = _smallest(len(ids), a, b, ids)
                some = links > 0
                yield pa.record_batch([pa.array(ids[some]), pa.array(links[some]), pa.array(root[some])], names=["node", "links", "root"])

    side = lambda s: tiles.select(F.col("tile").alias(s), *([F.col("dim")] if s == "a" else []),
                                  *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "counts", "values")])
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.mapInArrow(work, "node long, links long, root long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 least: float = THRESHOLD, tile_rows: int = TILE_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, n_links, component_id, kept of every row."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          F.col(f"`{vector_col}`").alias("vector"))
    big = F.lit(float("inf"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big)
    usable = (F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)
              & ~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0))
    usable = F.coalesce(usable, F.lit(False))
    keyed = rows.where(usable).withColumns({"k1": F.xxhash64("label", "vector"), "k2": F.xxhash64(F.lit(2), "vector", "label")})
    once = keyed.groupBy("id", "label", "k1", "k2").agg(F.any_value("vector").alias("vector"))
    classes = saved(once.groupBy("k1", "k2", "label").agg(F.min("id").alias("node"), F.count("*").alias("n"), F.any_value("vector").alias("vector")))
    axes = principal_axes(classes, sample_rows)
    width = math.sqrt(2 * (1 - least)) + SLACK
    tiles, pairs = _tiles(classes, axes, width, tile_rows)
    spread = saved(pairs).repartition("a", "b")
    found = saved(compare_tiles(spread, tiles, axes, least))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reach = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (classes.select("k1", "k2", "node", "n").join(links, "node", "left").join(reach, "node", "left")
             .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    out = keyed.select("id", "k1", "k2").join(known, ["k1", "k2"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
