"""Deterministic splits and samples.

Membership follows a seeded md5 order of the group key (reproducible in any
engine), not a process-local random generator. Ranks come from
``global_rank`` (range-partitioned running counts), never from a window
without PARTITION BY.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqrisk.config import FALLBACK_FRACTIONS, HOLDOUT_YEARS, SEED, TEST_FRACTION
from seqrisk.functions.expr import year_of
from seqrisk.operators.ranking import global_rank, hash_order, running_sums
from seqrisk.session import cut_lineage


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct non-null keys."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys`` (semi join)."""
    return df.join(keys.select(key), key, "left_semi")


def not_in_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``keys`` (anti join)."""
    return df.join(keys.select(key), key, "left_anti")


def year_holdout(df: DataFrame, key: str = "RaceId", years: Sequence[int] = HOLDOUT_YEARS,
                 year: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(holdout, rest) by the year of the session key (P1) or a given
    year column."""
    y = year_of(key) if year is None else year
    hold = y.isin(list(years))
    return df.where(hold), df.where(~hold | y.isNull())


def _count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def split_by_group(df: DataFrame, key: str = "RaceId", test_frac: float = TEST_FRACTION,
                   years: Sequence[int] = HOLDOUT_YEARS, seed=SEED, year: Column | None = None
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, test, holdout). Holdout = the holdout years; of the other
    groups, the first floor(test_frac * n) in seeded hash order go to test,
    the rest to train. No group straddles two parts."""
    holdout, rest = year_holdout(df, key, years, year)
    keys = distinct_keys(rest, key)
    ranked = global_rank(keys, [key], seed)
    test_keys = ranked.where(F.col("rank") <= F.floor(_count(keys) * F.lit(float(test_frac))))
    return not_in_keys(rest, test_keys, key), in_keys(rest, test_keys, key), holdout


def label_parts(df: DataFrame, key: str = "RaceId", test_frac: float = TEST_FRACTION,
                years: Sequence[int] = HOLDOUT_YEARS, seed=SEED, year: Column | None = None, out: str = "part") -> DataFrame:
    """T2 as one frame: ``df`` with the part of each row. Only the distinct
    keys are ranked; their parts are joined back. A null key is in train."""
    y = year_of(key) if year is None else year
    held = F.coalesce(y.isin(list(years)), F.lit(False))
    keys = distinct_keys(df.where(~held), key)
    ranked = global_rank(keys, [key], seed)
    test = ranked.where(F.col("rank") <= F.floor(_count(keys) * F.lit(float(test_frac)))).select(F.col(key).alias("__key"), F.lit(True).alias("__test"))
    part = F.when(held, F.lit("holdout")).when(F.col("__test"), F.lit("test")).otherwise(F.lit("train"))
    return df.join(test, F.col(key) == F.col("__key"), "left").withColumn(out, part).drop("__key", "__test")


def split_labels(df: DataFrame, key: str, fractions: Sequence[float] = FALLBACK_FRACTIONS,
                 seed=SEED, by_rows: bool | None = None, names=("train", "test", "holdout"),
                 out: str = "split", row_key: Sequence[str] | None = None) -> DataFrame:
    """Label rows train / test / holdout by cutting the seeded hash order
    at floor(f1*n) and floor((f1+f2)*n). Whole groups by ``key`` (rows with a
    null key are one group), or single rows when there is at most one group
    (decided from the distinct-key count, one small job, unless ``by_rows`` is
    given). Rows are ordered by ``row_key``, a unique key, else by all columns."""
    keys = df.select(key).distinct()
    if by_rows is None:
        by_rows = keys.limit(2).count() <= 1
    c1, c2 = float(fractions[0]), round(float(fractions[0]) + float(fractions[1]), 12)
    if by_rows:
        plain = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
        ranked = global_rank(df, list(row_key or plain), seed, "__rank")
        n = _count(df)
        lab = _cut(F.col("__rank"), n, c1, c2, names)
        return ranked.withColumn(out, lab).drop("__rank")
    ranked = global_rank(keys, [key], seed, "__rank")
    n = _count(keys)
    lab = ranked.select(F.col(key).alias("__key"), _cut(F.col("__rank"), n, c1, c2, names).alias(out))
    return df.join(lab, F.col(key).eqNullSafe(F.col("__key"))).drop("__key")


def _cut(rank: Column, n: Column, c1: float, c2: float, names) -> Column:
    return (F.when(rank <= F.floor(n * F.lit(c1)), F.lit(names[0]))
            .when(rank <= F.floor(n * F.lit(c2)), F.lit(names[1]))
            .otherwise(F.lit(names[2])))


def fallback_split(df: DataFrame, key: str = "RaceId", fractions=FALLBACK_FRACTIONS, seed=SEED
                   ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """T3 as three frames."""
    lab = split_labels(df, key, fractions, seed)
    return tuple(lab.where(F.col("split") == n).drop("split") for n in ("train", "test", "holdout"))


def stratified_folds(df: DataFrame, label: str, key: Sequence[str], k: int = 5, seed=SEED,
                     out: str = "fold") -> DataFrame:
    """T4: fold = (position within the label class, in seeded hash order of
    ``key``, minus 1) mod k: classes are spread evenly over the folds. ``key``
    may hold nulls; make it unique, so that a recomputed row keeps its fold."""
    ranked = global_rank(df, list(key), seed, "__pos", partition_cols=[label])
    return ranked.withColumn(out, ((F.col("__pos") - 1) % F.lit(k)).cast("int")).drop("__pos")


def prefix_split(df: DataFrame, order: str, frac: float = 0.8, tie: Sequence[str] = ()
                 ) -> tuple[DataFrame, DataFrame]:
    """T5: the first floor(frac * n) rows by ``order``, ties by the columns
    ``tie`` (together unique), and the rest. Positions are written once, so
    head and tail are cuts of the same order."""
    ranked = cut_lineage(running_sums(df, [F.col(order), *[F.col(c) for c in tie]], {"__pos": F.lit(1)}))
    cut = F.floor(_count(ranked) * F.lit(float(frac)))
    head = ranked.where(F.col("__pos") <= cut).drop("__pos")
    tail = ranked.where(F.col("__pos") > cut).drop("__pos")
    return head, tail


def seeded_sample(df: DataFrame, n: int, key: Sequence[str], seed=SEED) -> DataFrame:
    """Exactly min(n, rows) rows, the first n in seeded hash order of
    ``key`` (a bounded top-n: per-partition top-n, then one merge of n rows
    per partition)."""
    return df.withColumn("__h", hash_order(key, seed)).orderBy("__h").limit(int(n)).drop("__h")
