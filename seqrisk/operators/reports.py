"""Report and profiling aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqrisk.operators.ranking import exact_medians


def race_rows(df: DataFrame, race_id: str, race: str = "RaceId", lap: str = "LapNumber") -> DataFrame:
    """P20 + T7: the rows of one race, ordered by lap (the filter reaches the
    Parquet scan; the sort only orders that race)."""
    return df.where(F.col(race) == F.lit(race_id)).orderBy(lap)


def lap_rows(rows: DataFrame, lap_number: int | None = None, lap: str = "LapNumber") -> DataFrame:
    """P20: the rows of one lap; of the lowest lap if no number is given."""
    if lap_number is None:
        return rows.where(F.col(lap) == rows.agg(F.min(lap).alias("m")).select("m").scalar())
    return rows.where(F.col(lap) == F.lit(lap_number))


def flagged_laps(rows: DataFrame, flag: str = "SafetyCar", lap: str = "LapNumber", by: Sequence[str] = ("RaceId",)) -> DataFrame:
    """P20: the laps (per race) with any row under the flag, and how many rows are; a null flag is none."""
    return (rows.where(F.coalesce(F.col(flag).cast("boolean"), F.lit(False)) & F.col(lap).isNotNull())
            .groupBy(*by, lap).agg(F.count(F.lit(1)).alias("rows")))


def lap_risk(scored: DataFrame, lap: str = "LapNumber", prob: str = "sc_probability",
             flag: str = "SafetyCar", threshold: str = "threshold", by: Sequence[str] = ()) -> DataFrame:
    """A9 + J6: per lap, mean probability and whether any row had the flag;
    one aggregation instead of two joined ones. The threshold is carried."""
    aggs = [F.avg(prob).alias(prob), F.max(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))).alias(flag)]
    if threshold in scored.columns:
        aggs.append(F.max(threshold).alias(threshold))
    return scored.groupBy(*by, lap).agg(*aggs)


def race_summary(df: DataFrame, race: str = "RaceId", lap: str = "LapNumber",
                 first_cols: Sequence[str] = ("TrackId", "Year", "TrackLength", "Corners"),
                 median_cols: Sequence[str] = ("AirTemp", "Humidity", "Rainfall")) -> DataFrame:
    """A10 per race: the attributes of its first lap row (lowest lap, then the
    lowest attribute tuple: deterministic), exact medians, min and max lap."""
    first_cols = [c for c in first_cols if c in df.columns]
    median_cols = [c for c in median_cols if c in df.columns]
    first = F.min(F.struct(F.col(lap).alias("__lap"), *[F.col(c) for c in first_cols]))
    base = df.groupBy(race).agg(first.alias("__f"), F.min(lap).alias("min_lap"), F.max(lap).alias("max_lap"))
    base = base.select(race, *[F.col(f"__f.{c}").alias(c) for c in first_cols], "min_lap", "max_lap")
    if median_cols:
        med = exact_medians(df, [race], median_cols)
        med = med.select(F.col(race).alias("__race"), *[F.col(c).alias(f"median_{c}") for c in median_cols])
        base = base.join(med, F.col(race).eqNullSafe(F.col("__race")), "left").drop("__race")     # the null race has medians too
    return base


def race_list(df: DataFrame, race: str = "RaceId") -> DataFrame:
    """Distinct races with a display name, newest key first."""
    return (df.select(race).where(F.col(race).isNotNull()).distinct()
            .withColumn("display_name", F.concat(F.lit("Race: "), F.col(race)))
            .orderBy(F.col(race).desc()))


def count_by(df: DataFrame, keys: Sequence[str], n: int | None = None, name: str = "rows") -> DataFrame:
    """A11 (+T8): rows per key combination, ordered by the keys; the first
    ``n`` when given (a top-n report)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)
    return out.limit(n) if n else out


def null_fraction(df: DataFrame, n: int | None = 10) -> DataFrame:
    """Share of nulls (and NaN) per column, largest first (ties by
    name), top ``n``. One aggregation pass, then an unpivot of one row."""
    def isnull(c):
        t = df.schema[c].dataType.typeName()
        col = F.col(f"`{c}`")
        return (col.isNull() | F.isnan(col)) if t in ("double", "float") else col.isNull()
    row = df.agg(*[F.avg(isnull(c).cast("double")).alias(c) for c in df.columns])
    long = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_fraction"))
                                         for c in df.columns])).alias("s")).select("s.*")
    out = long.orderBy(F.col("null_fraction").desc(), F.col("column"))
    return out.limit(n) if n else out


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Normalized value counts; nulls excluded from values and total."""
    nn = df.where(F.col(col).isNotNull())
    total = nn.select(F.count(F.lit(1))).scalar()
    return nn.groupBy(col).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) as one row."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def preview(df: DataFrame, order: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows in a given order (bounded top-n)."""
    return df.orderBy(*order).limit(n)
