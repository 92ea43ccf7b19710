"""Cleaning, dimension lookup and median imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqrisk.config import (BOOLEAN_FILL_COLUMNS, CATEGORY_FILL_COLUMNS, DURATION_COLUMNS,
                            TRACK_DEFAULTS, TRACK_MEDIAN_COLUMNS, TRACKS, Roles)
from seqrisk.functions.expr import first_token, seconds
from seqrisk.operators.ranking import exact_medians, medians_of_long, to_long
from seqrisk.session import cut_lineage


def valid_laps(df: DataFrame, session_type: str = "SessionType", lap_time: str = "LapTime",
               is_accurate: str = "IsAccurate", keep_all: str = "Q", checked: str = "R") -> DataFrame:
    """Keep every ``keep_all`` row; keep ``checked`` rows with a lap time
    and IsAccurate true (null counts as false); drop other session types."""
    st = F.col(session_type)
    ok = (st == keep_all) | ((st == checked) & F.col(lap_time).isNotNull()
                             & F.coalesce(F.col(is_accurate), F.lit(False)))
    return df.where(ok)


def add_seconds_columns(df: DataFrame, cols: Sequence[str] = DURATION_COLUMNS) -> DataFrame:
    """P5: ``<col>_seconds`` for each duration column present."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({f"{c}_seconds": seconds(c, fields[c]) for c in cols if c in fields})


def only_session(df: DataFrame, session_type: str = "SessionType", value: str = "R") -> DataFrame:
    """Final filter on the session type (applied after imputation)."""
    return df.where(F.col(session_type) == value)


def lookup_contains(df: DataFrame, key: str, dim, attrs: Sequence[str] | None = None,
                    defaults: dict | None = None) -> DataFrame:
    """Case-insensitive *contains* lookup: a row matches every dimension
    key contained in ``df[key]``; the last matching dimension entry wins;
    unmatched rows keep an existing value, else get ``defaults``.

    ``dim`` is either a list of tuples (key, attr1, attr2, ...) -- a fixed,
    driver-side table, compiled into one CASE expression (no join) -- or a
    DataFrame (key column first, then an ``ord`` column, then attributes),
    resolved over the distinct keys of ``df`` by a substring equi-join and
    joined back.
    """
    defaults = dict(TRACK_DEFAULTS if defaults is None else defaults)
    k = F.lower(F.col(key))
    if isinstance(dim, (list, tuple)):
        attrs = list(attrs or TRACK_DEFAULTS)
        out = {}
        for i, a in enumerate(attrs):
            expr = None
            for row in dim:                     # later rows wrap earlier ones: last match wins
                cond = k.contains(F.lower(F.lit(row[0])))
                expr = F.when(cond, F.lit(row[i + 1])) if expr is None else \
                    F.when(cond, F.lit(row[i + 1])).otherwise(expr)
            out[a] = expr
        return _apply_lookup(df, out, defaults)
    # DataFrame dimension: "key contains dim key" becomes an equi-join. Each
    # distinct key is expanded into its substrings of exactly the dimension's
    # key lengths, which are then joined on
    # equality with the lower-cased dimension keys: exact, no theta join, no
    # size limit on the dimension (AQE picks broadcast or shuffle).
    dcols = dim.columns
    dkey, attrs = dcols[0], list(attrs or [c for c in dcols if c not in (dcols[0], "ord")])
    # the lengths are one array of at most as many numbers as the longest key has characters
    lengths = dim.where(F.length(dkey) > 0).agg(F.collect_set(F.length(dkey))).scalar()
    keys = df.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    lk = F.lower(F.col("__key"))
    sized = keys.select("__key", F.explode(lengths).alias("__n")).where(F.length(lk) >= F.col("__n"))
    starts = F.sequence(F.lit(1), F.length(lk) - F.col("__n") + 1)
    exploded = sized.select("__key", F.explode(F.array_distinct(
        F.transform(starts, lambda i: F.substring(lk, i, F.col("__n"))))).alias("__sub"))
    d = dim.select(F.lower(F.col(dkey)).alias("__sub"), "ord", *attrs)
    m = (exploded.join(d, "__sub")
         .groupBy("__key").agg(F.max_by(F.struct(*attrs), F.col("ord")).alias("__a")))
    j = df.join(m, F.col(key) == F.col("__key"), "left")
    return _apply_lookup(j, {a: F.col(f"__a.{a}") for a in attrs}, defaults).drop("__key", "__a")


def _apply_lookup(df: DataFrame, matched: dict, defaults: dict) -> DataFrame:
    cols = {}
    for a, m in matched.items():
        parts = [m]
        if a in df.columns:
            parts.append(F.col(a))
        if a in defaults:
            parts.append(F.lit(defaults[a]))
        cols[a] = F.coalesce(*parts) if len(parts) > 1 else m
    return df.withColumns(cols)


def add_track(df: DataFrame, event_name: str = "EventName", track: str = "TrackId",
              dim=None, defaults: dict | None = None) -> DataFrame:
    """P8 + J4: TrackId = first ``_`` token of the event name, then the track
    dimension by contains-match (defaults when nothing matches)."""
    d = df.withColumn(track, first_token(event_name))
    return lookup_contains(d, track, TRACKS if dim is None else dim, defaults=defaults)


def fill_constant(df: DataFrame, value, cols: Sequence[str]) -> DataFrame:
    """Fill nulls in the listed columns that exist."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in present}) if present else df


def fill_group_median(df: DataFrame, cols: Sequence[str], group: str, med: DataFrame | None = None
                      ) -> DataFrame:
    """A1: nulls (and NaN) get the exact median of the same group, computed
    over the frame's rows; a group without values stays null; rows with a
    null group key are left alone. The per-group medians (one row per group)
    are joined back; AQE broadcasts them when small."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    med = exact_medians(cut_lineage(df.select(group, *cols)), [group], cols) if med is None else med
    med = med.select(F.col(group).alias("__g"), *[F.col(c).alias(f"__m_{c}") for c in cols])
    j = df.join(med, F.col(group) == F.col("__g"), "left")
    filled = j.withColumns({c: F.coalesce(_nn(df, c), F.col(f"__m_{c}").cast(df.schema[c].dataType))
                            for c in cols})
    return filled.select(*df.columns)


def fill_group_then_global_median(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """A2: group median first, then the global median *of the filled column*;
    an all-null column stays null.

    The filled column's values are the original values plus, per group, its
    null count times its median, so the global median is computed from those
    weighted values: the group-filled rows are never materialized or
    recomputed. The group and the columns are written once, narrow, for all
    passes of the medians; the group medians and null counts too (one row per
    group)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    narrow = cut_lineage(df.select(group, *cols))
    nulls = [F.sum(F.when(_nn(df, c).isNull(), 1).otherwise(0)).alias(f"__z_{c}") for c in cols]
    med = cut_lineage(exact_medians(narrow, [group], cols, extra_aggs=nulls))
    fills = med.where(F.col(group).isNotNull()).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v"), F.col(f"__z_{c}").cast("long").alias("w"))
        for c in cols])).alias("s")).select(F.col("s.k").alias("__k"), F.col("s.v").alias("__v"),
                                            F.col("s.w").alias("__w"))
    fills = fills.where(F.col("__v").isNotNull() & (F.col("__w") > 0))
    glob = medians_of_long(to_long(narrow, [], cols).unionByName(fills), [], cols)
    glob = glob.select(F.struct(*cols).alias("m")).scalar()     # one scalar subquery, every column
    g1 = fill_group_median(df, cols, group, med.select(group, *cols))
    return g1.withColumns({c: F.coalesce(F.col(c), glob.getField(c).cast(df.schema[c].dataType))
                           for c in cols})


def _nn(df: DataFrame, c: str) -> Column:
    """The column with NaN read as missing (pandas treats both alike)."""
    col = F.col(c)
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return F.when(~F.isnan(col), col)
    return col


def clean(df: DataFrame, roles: Roles = Roles(), dim=None) -> DataFrame:
    """The cleaning stage, in the reference's order: validity filter, seconds
    columns, TrackId + track dimension, boolean fill, two-level medians over Q
    and R rows, category fill, then the R-only filter."""
    d = valid_laps(df, roles.session_type, roles.lap_time, roles.is_accurate)
    d = add_seconds_columns(d)
    d = add_track(d, roles.event_name, roles.track, dim)
    d = fill_constant(d, False, BOOLEAN_FILL_COLUMNS)
    d = fill_group_then_global_median(d, TRACK_MEDIAN_COLUMNS, roles.track)
    d = fill_constant(d, "Unknown", CATEGORY_FILL_COLUMNS)
    return only_session(d, roles.session_type, "R")
