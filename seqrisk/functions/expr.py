"""Scalar column expressions (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqrisk.config import REQUEST_FALLBACK_TRACK, REQUEST_FALLBACK_YEAR


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(key) -> Column:
    """The first ``_`` token of a session key as an int (ANSI cast: a
    malformed key fails the job, as the reference does)."""
    return F.split(_c(key), "_").getItem(0).cast("int")


def parse_race_id(key) -> Column:
    """struct(year, track) from ``YYYY_RR_Rest``: split into at most 3
    parts; a non-numeric year resets both fields to the fallbacks."""
    parts = F.split(_c(key), "_", 3)
    year = parts.getItem(0).try_cast("int")
    track = F.when(F.size(parts) > 2, parts.getItem(2)).otherwise(F.lit(REQUEST_FALLBACK_TRACK))
    ok = year.isNotNull()
    return F.struct(
        F.when(ok, year).otherwise(F.lit(REQUEST_FALLBACK_YEAR)).alias("year"),
        F.when(ok, track).otherwise(F.lit(REQUEST_FALLBACK_TRACK)).alias("track"),
    )


def parse_session_key(key) -> Column:
    """struct(year, round) as ints; null where a part is not numeric."""
    parts = F.split(_c(key), "_")
    return F.struct(parts.getItem(0).try_cast("int").alias("year"),
                    parts.getItem(1).try_cast("int").alias("round"))


def contains_flag(col, code: str = "4") -> Column:
    """1 if the status string contains ``code``; null counts as 0."""
    return F.coalesce(_c(col).cast("string").contains(code), F.lit(False)).cast("int")


def seconds(col, dtype: T.DataType | None = None) -> Column:
    """P5: a duration as double seconds. Pandas timedeltas land in Parquet as
    int64 nanoseconds; day-time intervals are converted exactly; doubles are
    taken as seconds already. Null stays null."""
    c = _c(col)
    if isinstance(dtype, T.DayTimeIntervalType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, epoch + c) / F.lit(1e6)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return c.cast("double") / F.lit(1e9)
    return c.cast("double")


def first_token(col, sep: str = "_") -> Column:
    """The first token, e.g. TrackId from EventName."""
    return F.split(_c(col), sep).getItem(0)


def bool_to_int(col) -> Column:
    """Boolean to 0/1 with null as 0."""
    return F.coalesce(_c(col).cast("int"), F.lit(0))


def normalize_name(col) -> Column:
    """Spaces become underscores."""
    return F.translate(_c(col), " ", "_")


def session_key(year, rnd, event, session_type) -> Column:
    """``{year}_{round:02d}_{event}_{type}``."""
    return F.format_string("%d_%02d_%s_%s", _c(year), _c(rnd), _c(event), _c(session_type))


def decide(prob, threshold) -> Column:
    """prediction = prob >= threshold, as 0/1; none for a null or NaN probability."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(~F.isnan(_c(prob)), (_c(prob) >= t).cast("int"))


def epoch_seconds(col) -> Column:
    """Seconds since 1970 for TIMESTAMP or TIMESTAMP_NTZ, timezone-free for NTZ."""
    return F.timestamp_diff("SECOND", _epoch(), _c(col))


def epoch_micros(col) -> Column:
    """Microseconds since 1970 (BIGINT); used to hand timestamps to oracles."""
    return F.timestamp_diff("MICROSECOND", _epoch(), _c(col))


def add_seconds(ts, secs) -> Column:
    """ts + secs (double), rounded to the microsecond."""
    return F.timestamp_add("MICROSECOND", F.round(_c(secs) * F.lit(1e6)).cast("long"), _c(ts))
