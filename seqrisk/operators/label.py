"""Step labels: any-flag per step, onset of the next step, label counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def any_per_step(df: DataFrame, group: str, step: str, flag: str, out: str = "any_flag") -> DataFrame:
    """A3: one row per (group, step) with ``out`` = any(flag); null flags count
    as false. Partial aggregation happens map-side, so a hot group is
    combined before the shuffle."""
    return (df.where(F.col(group).isNotNull() & F.col(step).isNotNull())
            .groupBy(group, step)
            .agg(F.max(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))).alias(out)))


def onset_steps(steps: DataFrame, group: str, step: str, any_col: str = "any_flag") -> DataFrame:
    """A4 + J7 on the per-step table (group, step, any flag): the (group,
    step) keys labeled 1 -- step n+1 exists with the flag, step n has none, n
    is a whole number >= 1."""
    nxt = steps.select(F.col(group).alias("__g"), (F.col(step) - 1).alias("__s"), F.col(any_col).alias("__nxt"))
    return (steps.join(nxt, (F.col(group) == F.col("__g")) & (F.col(step) == F.col("__s")))
            .where(F.col("__nxt") & ~F.col(any_col) & (F.col(step) >= 1) & (F.col(step) == F.floor(F.col(step))))
            .select(F.col(group).alias("__lg"), F.col(step).alias("__ls"), F.lit(1).alias("__lab")))


def attach_labels(df: DataFrame, labels: DataFrame, group: str, step: str, out: str = "sc_next_lap") -> DataFrame:
    """Every row gets its step's label (1 from ``onset_steps``, else 0)."""
    j = df.join(labels, (F.col(group) == F.col("__lg")) & (F.col(step) == F.col("__ls")), "left")
    base = [c for c in df.columns if c != out]
    return j.select(*base, F.coalesce(F.col("__lab"), F.lit(0)).alias(out))


def onset_label(df: DataFrame, group: str, step: str, flag: str, out: str = "sc_next_lap") -> DataFrame:
    """A4 + J7: every row of step n gets 1 iff step n+1 of the same group
    exists and has the flag on some row, no row of step n has it, and n is a
    whole number >= 1; otherwise 0.

    Plan: the (group, step) aggregate joined to itself on step+1 (both sides
    are the small per-step table), then joined back to the rows on
    (group, step) -- a key that spreads a hot group over its steps.
    """
    steps = any_per_step(df, group, step, flag, "__cur")
    return attach_labels(df, onset_steps(steps, group, step, "__cur"), group, step, out)


def label_stats(df: DataFrame, label: str = "sc_next_lap") -> DataFrame:
    """A5: positives, total and percentage (0 when empty), one row."""
    return df.agg(F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("positives"),
                  F.count(F.lit(1)).alias("total")) \
        .withColumn("positive_pct",
                    F.when(F.col("total") > 0, F.lit(100.0) * F.col("positives") / F.col("total"))
                    .otherwise(F.lit(0.0)))
