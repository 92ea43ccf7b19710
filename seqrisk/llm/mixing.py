"""Mixing sources to target weights (1): pivotal dependent rounding.

Each source has a target (weight share of a total, capped at a multiple of
its own size); each document of it asks for target / size copies. The whole
part is taken as it is. The fractional parts are rounded by the pivotal
method: two documents trade probability mass, weighted by their sizes, in a
random direction that keeps expectations, until one of them is 0 or 1; the
other goes on to the next document. So a source's words stay at its target up
to the one document that is left over, which tends to be a long one, as in a
trade the shorter document is settled. It is settled to the nearer side; what
is then missing or too much is made good by other documents: up to ``SWAPS``
times, some of about ``CANDIDATES`` documents of a source (chosen by hash; all of
a small source) change sides: any one of them, then, from long to short, those
that bring the source nearer to its target; of all first ones the best.

Distributed: a source's documents are dealt by hash into chunks of about
``CHUNK_ROWS`` rows, each chunk leaves one residual document, and the
residuals of a level are dealt again, until every source has one (a reduction
tree of log(rows) / log(CHUNK_ROWS) levels). A source with a third of all
rows only has more chunks; rows that repeat in full are counted and numbered,
and each is dealt by a hash of its own. Each level is written as a narrow table in the
shared folder. Randomness is a hash of seed, level and rows: reruns agree.

Defined cases: a null text has size 0; documents of size 0 are never taken;
a null source is a source of its own, last in order; equal rows are
exchangeable; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from seqrisk.llm.common import null_safe, saved, small

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_ROWS = 128
SWAPS, CANDIDATES = 4, 64
SEED = 20240


def text_size(text: Column) -> Column:
    """Number of words (runs without ASCII white space); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), total: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """source, source_size, n_rows -> with target. Sources by code point, null
    last, take the weights in turn. Water filling: with sources sorted by
    cap / weight, the capped ones are a prefix, and the first source whose
    share of the rest is below its cap fixes the share of all after it. The
    windows run over one row per source."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % n + 1)
    everything = W.partitionBy()
    t = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumns({
        "rest": F.sum("source_size").over(everything) * F.lit(float(total)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))})
    level = F.col("rest") / F.col("open")
    ratio = F.col("cap") / F.col("weight")
    t = t.withColumn("first", F.when(ratio >= level, F.struct(ratio, level.alias("level"))))
    t = t.withColumn("water", F.min("first").over(everything)["level"])
    t = t.withColumn("target", F.least("cap", F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))))
    return t.select("source", "source_size", "n_rows", "weight", "target")


# One trade between the document in hand (acc.d with probability acc.p) and the
# next one (x): moving one up by `up`, or down by `down`, moves the other the
# opposite way in proportion to the sizes. A hash decides the direction with
# odds down : up, so that expectations stay; the settled one goes to `out`.
_TRADE = """
aggregate(slice(xs, 2, size(xs) - 1),
  named_struct('d', xs[0], 'p', xs[0].p, 'out', cast(array() as array<struct<x:{item},up:int>>)),
  (acc, x) ->
    transform(transform(array(named_struct(
        'up', least(1D - acc.p, x.p * x.size / acc.d.size),
        'down', least(acc.p, (1D - x.p) * x.size / acc.d.size),
        'u', {uniform})),
      m -> if(m.u * (m.up + m.down) < m.down,
              named_struct('p', acc.p + m.up, 'q', x.p - m.up * acc.d.size / x.size),
              named_struct('p', acc.p - m.down, 'q', x.p + m.down * acc.d.size / x.size))),
      t -> if(t.p < {eps} or t.p > 1D - {eps},
              named_struct('d', x, 'p', t.q, 'out', array_append(acc.out, named_struct('x', acc.d, 'up', if(t.p > 0.5D, 1, 0)))),
              named_struct('d', acc.d, 'p', t.p, 'out', array_append(acc.out, named_struct('x', x, 'up', if(t.q > 0.5D, 1, 0))))))[0])
"""
_UNIFORM = "cast(xxhash64({key}) & 9007199254740991L as double) / 9007199254740992D"


def row_hash(id_col: str, text_col: str, source_col: str, seed: int) -> Column:
    """Decides the order and the random trades of a row; equal rows share it."""
    return F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{source_col}`"), F.col(f"`{text_col}`"))


def _numbered(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` (id, source, size, row_hash) with h: the row hash, for further
    copies of a row with their number. Copies are counted, and made in blocks."""
    counted = saved(rows.groupBy("id", "source", "size", "row_hash").agg(F.count("*").alias("m")))
    blocks = counted.where("m > 1").withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / block))))
    inside = F.sequence(F.col("block") * block, F.least(F.col("m"), (F.col("block") + 1) * block) - 1)
    more = blocks.repartition("row_hash", "block").withColumn("k", F.explode(inside))
    h = F.when(F.col("k") == 0, F.col("row_hash")).otherwise(F.xxhash64("row_hash", "k"))
    cols = ("id", "source", "size", "row_hash")
    return counted.where("m = 1").select(*cols, F.col("row_hash").alias("h")).unionByName(more.select(*cols, h.alias("h")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), total: float = 1.5, cap: float = 2.0,
                seed: int = SEED, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per document: id, row_hash, source, size, source_size, target,
    copies, taken (copies x size)."""
    rows = saved(_numbered(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
        text_size(F.col(f"`{text_col}`")).alias("size"),
        row_hash(id_col, text_col, source_col, seed).alias("row_hash")), chunk_rows))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.sum(F.expr("if(size > 0, 1L, 0L)")).alias("n_rows"))
    targets = saved(source_targets(sizes, weights, total, cap))
    t = F.broadcast(targets) if small(targets) else targets
    joined = rows.alias("r").join(t.alias("t"), null_safe("r", "t", ["source"])).select("r.*", "t.source_size", "t.n_rows", "t.target")
    ask = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ask + 1e-9)
    part = ask - whole
    asked = joined.withColumns({"whole": whole.cast("int"), "p": F.when(part < 1e-9, 0.0).otherwise(part)})
    asked = asked.withColumn("free", (F.col("p") > 0).cast("int"))
    fields = ["size", "h", "row_hash", "id", "source", "source_size", "target", "whole", "free", "p"]
    types = dict(asked.dtypes)
    item = "struct<" + ",".join(f"{f}:{types[f]}" for f in fields) + ">"
    done = [asked.where("p = 0").select(*fields, F.lit(0).alias("up"))]
    chunks = max(1, -(-(targets.agg(F.max("n_rows")).first()[0] or 0) // chunk_rows))
    now = asked.where("p > 0").withColumn("chunks", F.ceil(F.col("n_rows") / chunk_rows)).select(*fields, "chunks")
    level = 0
    while True:
        now = now.withColumn("chunk", F.pmod(F.xxhash64(F.lit(level), F.col("h")), F.col("chunks")))
        dealt = now.groupBy(F.col("source").alias("s"), "chunks", "chunk").agg(
            F.sort_array(F.collect_list(F.struct(*fields)), asc=False).alias("xs"))
        trade = _TRADE.format(item=item, eps="1e-9D", uniform=_UNIFORM.format(key=f"{seed}, {level}, acc.d.h, x.h"))
        traded = saved(dealt.select("chunks", F.expr(trade).alias("end")))
        done.append(traded.select(F.explode("end.out").alias("o")).select("o.x.*", "o.up"))
        left = traded.select("chunks", "end.d.*", F.col("end.p").alias("rest")).drop("p").withColumnRenamed("rest", "p")
        if chunks == 1:
            break
        chunks, level = -(-chunks // chunk_rows), level + 1
        now = left.withColumn("chunks", F.ceil(F.col("chunks") / chunk_rows)).select(*fields, "chunks")
    done.append(left.select(*fields, (F.col("p") >= 0.5).cast("int").alias("up")))
    out = done[0]
    for part_ in done[1:]:
        out = out.unionByName(part_)
    out = saved(_nearer(saved(out), small(targets)))
    copies = F.col("whole") + F.col("up")
    return out.select("id", "row_hash", "source", "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def _nearer(out: DataFrame, few: bool) -> DataFrame:
    """``out`` with single documents of each source changed from ``whole`` to ``whole`` + 1 copies or back, where that
    brings the source's words nearer to its target. Of a source, sums and about ``CANDIDATES`` documents are gathered."""
    wide = 1 << 40
    for _ in range(SWAPS):
        taken = F.sum((F.col("whole") + F.col("up")) * F.col("size"))
        able = (F.col("free") == 1) & (F.col("size") > 0)
        gap = out.groupBy(F.col("source").alias("s"), "target").agg(taken.alias("taken"), F.count_if(able).alias("n"))
        gap = gap.select("s", "n", (F.col("target") - F.col("taken")).alias("gap"))
        joined = out.where(able).join(F.broadcast(gap) if few else gap, F.col("source").eqNullSafe(F.col("s")))
        drawn = joined.where(F.pmod(F.xxhash64("h", F.lit(3)), F.lit(wide)) * F.col("n") < F.lit(CANDIDATES * wide).cast("double"))
        move = F.when(F.col("up") == 0, F.col("size")).otherwise(-F.col("size"))
        lists = drawn.groupBy("s", "gap").agg(F.sort_array(F.collect_list(F.struct("size", "h", move.alias("move"))), asc=False).alias("xs"))
        tried = F.expr("array_min(transform(xs, a -> transform(array(aggregate(xs, named_struct('gap', gap - a.move, 'swaps', array(a.h)), "
                       "(t, x) -> if(x.h <> a.h and abs(t.gap - x.move) < abs(t.gap), "
                       "named_struct('gap', t.gap - x.move, 'swaps', array_append(t.swaps, x.h)), t))), "
                       "t -> named_struct('miss', abs(t.gap), 'swaps', t.swaps))[0]))")
        best = saved(lists.withColumn("t", tried).where("t.miss < abs(gap) - 1e-9").select("s", F.explode("t.swaps").alias("swap")))
        if best.isEmpty():
            break
        marked = out.join(F.broadcast(best) if few else best, F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("swap")), "left")
        out = saved(marked.withColumn("up", F.when(F.col("swap").isNotNull(), 1 - F.col("up")).otherwise(F.col("up"))).drop("s", "swap"))
    return out


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: int = SEED, **settings) -> DataFrame:
    """``docs`` with each row as often as the mix takes it. Rows that repeat
    in full are exchangeable: one of them stands for all their copies."""
    mixed = mix_sources(docs, id_col, text_col, source_col, seed=seed, **settings)
    copies = saved(mixed.groupBy("id", "row_hash").agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
                   .where(F.col("__copies") > 0)
                   .select(F.col("id").alias("__id"), F.col("row_hash").alias("__hash"), "__copies", "__rows"))
    keyed = docs.withColumn("__h", row_hash(id_col, text_col, source_col, seed))
    joined = keyed.join(copies, (F.col("__h") == F.col("__hash")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")))
    once = joined.where("__rows = 1")
    repeated = joined.where("__rows > 1").dropDuplicates(["__h"])
    every = F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))).alias("__copy")
    cols = [f"`{c}`" for c in docs.columns]
    return once.unionByName(repeated).select(*cols, every).select(*cols)
