"""Distributed order statistics: running totals, last values, global ranks, exact medians.

A window with an ORDER BY but no PARTITION BY runs in one task, and so does a
window over one hot key; Spark's exact ``percentile`` keeps every distinct
value of a group in one in-memory map. The helpers here cut (key, order) into
ranges of about equal row counts (``repartitionByRange``: sampled cut points,
as many ranges as there are shuffle partitions), so a hot key gets many
ranges, work on each range in parallel, and carry one row per (key, range)
across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from seqrisk.session import cut_lineage

RANGE = "__rb"


def ordered_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``df`` with its range number in ``__rb``, written once: ranges follow
    (keys, order), rows equal in both share a range."""
    cut = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return cut_lineage(cut.withColumn(RANGE, F.spark_partition_id()))


def _carry(local: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-(key, range) offsets (columns __k_*, __k_rb) to the rows, null-safe."""
    on = F.col(RANGE) == F.col("__k_rb")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return local.join(offsets, on, "left")


def _key_names(keys: Sequence[str]) -> list[Column]:
    return [*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(RANGE).alias("__k_rb")]


def running_sums(df: DataFrame, order_cols: Sequence[Column], sums: dict,
                 partition_cols: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums in the order ``order_cols`` (Columns with
    asc / desc applied), within ``partition_cols``. ``sums`` maps output name
    -> Column to sum. Running sums inside each range, plus the totals of the
    key's earlier ranges."""
    pc = list(partition_cols)
    d = ordered_ranges(df, pc, order_cols)
    w = W.partitionBy(*pc, RANGE).orderBy(*order_cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = d.select("*", *[F.sum(c).over(w).alias(f"__l_{k}") for k, c in sums.items()])
    totals = d.groupBy(*pc, RANGE).agg(*[F.sum(c).alias(f"__t_{k}") for k, c in sums.items()])
    wo = W.partitionBy(*pc).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*_key_names(pc), *[F.coalesce(F.sum(f"__t_{k}").over(wo), F.lit(0)).alias(f"__o_{k}")
                                               for k in sums])
    out = _carry(local, offsets, pc)
    return out.select(*df.columns, *[(F.col(f"__l_{k}") + F.coalesce(F.col(f"__o_{k}"), F.lit(0))).alias(k)
                                     for k in sums])


def running_last(df: DataFrame, order_cols: Sequence[str], value: str, name: str,
                 partition_cols: Sequence[str]) -> DataFrame:
    """Add ``name``: the last non-null ``value`` up to and including each row in
    the (ascending) order of ``order_cols``, within ``partition_cols``."""
    pc = list(partition_cols)
    order = [F.col(c) for c in order_cols]
    d = ordered_ranges(df, pc, order)
    w = W.partitionBy(*pc, RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = d.withColumn("__l", F.last(value, ignorenulls=True).over(w))
    ends = d.where(F.col(value).isNotNull()).groupBy(*pc, RANGE).agg(
        F.max(F.struct(*order_cols, F.col(value).alias("__v")))["__v"].alias("__e"))
    ranges = d.select(*pc, RANGE).distinct().join(ends, [*pc, RANGE], "left")
    wo = W.partitionBy(*pc).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.select(*_key_names(pc), F.last("__e", ignorenulls=True).over(wo).alias("__o"))
    return _carry(local, offsets, pc).select(*df.columns, F.coalesce("__l", "__o").alias(name))


def key_text(cols: Sequence, seed) -> Column:
    """One text per key that tells null, empty and shifted values apart:
    length and value of each column, '~' for null, joined by '|', then the seed."""
    parts = []
    for c in cols:
        v = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("~")))
    return F.concat_ws("|", *parts, F.lit(str(seed)))


def hash_order(cols: Sequence, seed) -> Column:
    """A seeded pseudo-random order over key columns, the same in any engine with md5."""
    return F.md5(key_text(cols, seed))


def global_rank(df: DataFrame, cols: Sequence, seed, name: str = "rank",
                partition_cols: Sequence[str] = ()) -> DataFrame:
    """1-based position of each row in the seeded hash order of ``cols``
    (within ``partition_cols``); computed without a global window. Rows equal
    on ``cols`` get distinct, interchangeable positions: give a key that is
    unique where a row must keep its position."""
    d = df.withColumn("__hs", hash_order(cols, seed))
    return running_sums(d, [F.col("__hs")], {name: F.lit(1)}, partition_cols).drop("__hs")


def exact_medians(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str],
                  extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """Exact (interpolated) median of each value column per group, nulls and
    NaN ignored. Columns ``group_cols + value_cols`` (+ ``extra_aggs``,
    further aggregates over the same groups, which bring a row for every
    group); otherwise a group has a row if any of its columns has a value."""
    g = list(group_cols)
    med = medians_of_long(to_long(df, g, value_cols), g, value_cols)
    if not extra_aggs:
        return med
    extra = df.groupBy(*g).agg(*extra_aggs)
    if not g:       # both sides are one row: the medians ride along as one scalar subquery
        m = med.select(F.struct(*value_cols).alias("m")).scalar()
        return extra.withColumns({c: m.getField(c) for c in value_cols})
    keyed = med.withColumnsRenamed({c: f"__g_{c}" for c in g})
    on = F.lit(True)
    for c in g:
        on = on & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
    return extra.join(keyed, on, "left").drop(*[f"__g_{c}" for c in g])


def to_long(df: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """(group..., __k = column name, __v = value as double, __w = 1) for every
    non-null, non-NaN value."""
    g = list(group_cols)
    longs = [F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in value_cols]
    long = (df.select(*g, F.explode(F.array(*longs)).alias("__kv"))
            .select(*g, F.col("__kv.k").alias("__k"), F.col("__kv.v").alias("__v"), F.lit(1).cast("long").alias("__w")))
    return long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))


FINE = 4096            # buckets that a refinement cuts a range into
LAST_ROWS = 2_000_000  # values still asked for that are counted one by one


def _coarse(v: Column) -> Column:
    """A monotone bucket number: 32 per doubling of |v|, by sign."""
    return F.signum(v).cast("int") * F.floor(F.log2(1.0 + F.abs(v) * 1048576.0) * 32.0)


def _fine(v: Column, lo: Column, hi: Column) -> Column:
    """A monotone bucket number within [lo, hi]; both ends have their own (they may be infinite)."""
    part = F.nanvl((v - lo) / (hi - lo), F.lit(0.5))
    return F.when(v <= lo, 0).when(v >= hi, FINE + 1).otherwise(1 + F.floor(part * (FINE - 1)))


def _hold(hist: DataFrame, keys: Sequence[str], need: Column) -> DataFrame:
    """Of (keys, bucket, count, lo, hi) rows, the bucket of each key that holds its rank ``need``, and the rank in it."""
    w = W.partitionBy(*keys).orderBy("__d")
    before = F.sum("__c").over(w) - F.col("__c")
    kept = hist.withColumn("__b", before).where((F.col("__b") < need) & (need <= F.col("__b") + F.col("__c")))
    return kept.select(*keys, (need - F.col("__b")).alias("__need"), "__c", "__lo", "__hi")


def medians_of_long(long: DataFrame, group_cols: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Weighted exact medians over a long (group..., __k, __v, __w) frame:
    each row stands for ``__w`` copies of its value.

    Selection, without an order of the values: a pass counts values by bucket
    (map-side combined) and keeps the bucket that holds a middle rank; while
    more than ``LAST_ROWS`` values lie in kept buckets, the next pass counts them
    more finely, between each bucket's own least and greatest value; the rest are
    counted one by one. Kept buckets are a written table of two rows per (group,
    column) at most, so the join that finds what lies in them is a broadcast one
    where that table is small and a shuffled one beyond. Buckets per (group,
    column) are bounded, so a hot group is as much work for a task as any other.
    ``long`` is read once per pass: hand in a written table where it is dear to
    derive."""
    g = list(group_cols)
    gk = g + ["__k"]
    rk = [*gk, "__r"]
    stats = [F.sum("__w").alias("__c"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")]
    hist = long.groupBy(*gk, _coarse(F.col("__v")).alias("__d")).agg(*stats)
    n = F.sum("__c").over(W.partitionBy(*gk))
    asked = hist.withColumn("__n", F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1)).select("*", F.posexplode("__n").alias("__r", "__need"))
    held = cut_lineage(_hold(asked, rk, F.col("__need")))
    sure = []
    while True:
        sure.append(held.where(F.col("__lo") == F.col("__hi")).select(*rk, F.col("__lo").alias("__m")))
        open_ = held.where(F.col("__lo") < F.col("__hi"))
        left = open_.agg(F.sum("__c")).first()[0] or 0
        if not left:
            break
        targets = open_.drop("__c").withColumnsRenamed({c: f"__t{c}" for c in gk})
        on = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))
        for c in gk:
            on = on & F.col(c).eqNullSafe(F.col(f"__t{c}"))
        inside = long.join(targets, on)
        if left <= LAST_ROWS:
            hist = inside.groupBy(*rk, "__need", F.col("__v").alias("__d")).agg(*stats)
            sure.append(_hold(hist, rk, F.col("__need")).select(*rk, F.col("__lo").alias("__m")))
            break
        bucket = _fine(F.col("__v"), F.col("__lo"), F.col("__hi"))
        held = cut_lineage(_hold(inside.groupBy(*rk, "__need", bucket.alias("__d")).agg(*stats), rk, F.col("__need")))
    out = sure[0]
    for d in sure[1:]:
        out = out.unionByName(d)

    def med(c):
        at = lambda r: F.max(F.when((F.col("__k") == c) & (F.col("__r") == r), F.col("__m")))
        return ((at(0) + at(1)) / 2).alias(c)

    return out.groupBy(*g).agg(*[med(c) for c in value_cols])
