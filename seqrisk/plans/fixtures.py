"""Fixture families built from the driver's tables (see FIXTURES.md part 2).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame, so a query
scans the columns that it needs and sees the tables as they are now; the oracle
SQL in ``seqrisk.plans.oracle`` defines the same views for DuckDB. Nulls, gaps
and malformed values are injected deterministically from row ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- F-A: events
def fa_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laps: race=user_id, driver=event_type, lap=row number per (race, driver)
    by (ts, event_id); every 11th event then dropped (lap gaps); start null for
    event_id%13=0; lap_time_s null for event_id%3=0."""
    from seqrisk.operators.ranking import running_sums
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click", "purchase"))
    # lap = row number per (user, type) by (ts, event_id), computed as a
    # range-partitioned running count so one busy user is not one task.
    numbered = running_sums(ev, [F.col("ts"), F.col("event_id")], {"lap": F.lit(1)},
                            partition_cols=["user_id", "event_type"])
    return (numbered.withColumn("lap", F.col("lap").cast("int"))
            .where(F.col("event_id") % 11 != 0)
            .select("event_id", F.col("user_id").alias("race"), F.col("event_type").alias("driver"),
                    "lap",
                    F.when(F.col("event_id") % 13 != 0, F.col("ts")).alias("start"),
                    F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("lap_time_s"),
                    "props"))


def fa_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes: error events; status = char (event_id%6)+1 of '124567'."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == "error")
            .select("event_id", F.col("user_id").alias("race"), F.col("ts").alias("time"),
                    F.substring(F.lit("124567"), (F.col("event_id") % 6 + 1).cast("int"), 1).alias("status")))


def fa_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather samples: signup events; air_temp null for event_id%5=0,
    humidity = props.k."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == "signup")
            .select("event_id", F.col("user_id").alias("race"), F.col("ts").alias("time"),
                    F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("air_temp"),
                    F.get_json_object("props", "$.k").cast("double").alias("humidity")))


def fa_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests from the F-A laps: race_id 'YYYY_RR_Ev<race>_<driver>'
    (malformed year for event_id%17=0, missing for %23=0), lap as text
    (non-numeric for %19=0, missing for %29=0), lap_data struct with TyreLife
    from props.k (null for %4=0)."""
    laps = fa_laps(spark, sf_dir)
    eid = F.col("event_id")
    rid = F.concat(F.lpad((F.col("race") % 100).cast("string"), 2, "0"), F.lit("_Ev"),
                   F.col("race").cast("string"), F.lit("_"), F.col("driver"))
    race_id = (F.when(eid % 23 == 0, F.lit(None).cast("string"))
               .when(eid % 17 == 0, F.concat(F.lit("Y"), F.lit("_"), rid))
               .otherwise(F.concat(F.lit("2024_"), rid)))
    lap = (F.when(eid % 29 == 0, F.lit(None).cast("string"))
           .when(eid % 19 == 0, F.concat(F.lit("L"), F.col("lap").cast("string")))
           .otherwise(F.col("lap").cast("string")))
    tyre = F.when(eid % 4 != 0, F.get_json_object("props", "$.k").cast("double"))
    return laps.select("event_id", race_id.alias("race_id"), lap.alias("lap"),
                       F.struct(F.col("driver").alias("Driver"), tyre.alias("TyreLife"),
                                F.when(eid % 2 == 0, F.lit("SOFT")).alias("Compound")).alias("lap_data"))


# ------------------------------------------------------------- F-B: lineitem
# Track dimension of the F-B fixture (key, TrackLength, TrackType, Corners);
# keys are matched case-insensitively by contains, the last match wins.
FB_TRACKS = [("COLD", 5.1, "Permanent", 12), ("ol", 4.0, "Street", 10),
             ("smal", 3.3, "Street", 19), ("HOT", 5.9, "Permanent", 18), ("New", 4.3, "Street", 14)]


def fb_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lap features from lineitem + part (see FIXTURES.md F-B)."""
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    ok = F.col("l_orderkey")
    return (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
            .select(
                "l_orderkey", "l_linenumber",
                F.concat(F.date_format("l_shipdate", "yyyy_MM"), F.lit("_R")).alias("RaceId"),
                F.year("l_shipdate").alias("Year"),
                F.dayofmonth("l_shipdate").alias("LapNumber"),
                F.col("l_suppkey").cast("string").alias("Driver"),
                (F.col("l_suppkey") % 5).cast("string").alias("Team"),
                F.when(ok % 9 != 0, F.col("l_returnflag")).alias("Compound"),
                F.translate("p_name", " ", "_").alias("EventName"),
                F.when(ok % 10 == 0, "Q").when(ok % 10 == 1, "FP").otherwise("R").alias("SessionType"),
                (F.col("l_linestatus") == "O").alias("IsAccurate"),
                F.when(F.col("l_partkey") % 7 != 0, F.col("l_extendedprice")).alias("LapTime"),
                F.when(ok % 7 != 0, F.col("l_quantity")).alias("TyreLife"),
                F.col("l_extendedprice").alias("SpeedST"),
                F.when(F.col("l_linenumber") != 3, F.col("l_tax") * 1000).alias("SpeedI1"),
                (F.col("l_discount") * 100).alias("TrackTemp"),
                F.col("l_linenumber").alias("Position"),
                (F.col("l_tax") * 100 + 20).alias("AirTemp"),
                F.when(F.col("l_discount") >= 0.09, 1.0).otherwise(0.0).alias("Rainfall"),
                (F.col("l_linenumber") == 1).alias("FreshTyre"),
                ((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 45)).alias("YellowFlag"),
                F.when(ok % 11 != 0, F.col("l_quantity") < 3).alias("VirtualSafetyCar"),
                ((F.col("l_quantity") == 50) & (F.col("l_returnflag") == "R")).alias("SafetyCar"),
            ))


# -------------------------------------------------------- F-C: scored labels
def fc_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y = quality, score = round(n_chars / (n_chars + 500), 3)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (lab.join(doc, "doc_id")
            .select("doc_id", F.col("quality").alias("y"),
                    F.round(F.col("n_chars") / (F.col("n_chars") + F.lit(500.0)), 3).alias("score")))


# ------------------------------------------------------ F-D: session catalog
def fd_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (year, month) of o_orderdate as event date (first of month)."""
    o = table(spark, sf_dir, "orders")
    return (o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("round"))
            .distinct()
            .withColumn("event_date", F.make_date("year", "round", F.lit(1)))
            .withColumn("event_name", F.concat(F.lit("Event "), F.col("round").cast("string"))))


def fd_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions already on disk: race sessions of months with month%3<>0."""
    s = fd_schedule(spark, sf_dir)
    return (s.where(F.col("round") % 3 != 0)
            .select("year", "round", F.lit("R").alias("session_type")))


# ------------------------------------------- F-M: motorsport-shaped, from events
# Raw session tables with the reference's column names, derived from F-A:
# races are users, the event name cycles through the track table's keys.
def _race_key(race) -> "F.Column":
    from seqrisk.config import TRACKS
    names = F.array(*[F.lit(t[0]) for t in TRACKS])
    track = F.element_at(names, (race % len(TRACKS) + 1).cast("int"))
    return F.format_string("%d_%02d_%s_R", (race % 5 + 2020).cast("int"), (race % 24 + 1).cast("int"), track), track


def fm_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = fa_laps(spark, sf_dir)
    key, track = _race_key(F.col("race"))
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("double")
    return a.select(
        key.alias("RaceId"), F.col("driver").alias("Driver"), F.col("lap").alias("LapNumber"),
        F.col("start").alias("LapStartTime"), F.col("lap_time_s").alias("LapTime"),
        F.when(eid % 7 == 0, "Q").otherwise("R").alias("SessionType"), (eid % 10 != 0).alias("IsAccurate"),
        track.alias("EventName"), F.when(eid % 4 != 0, k).alias("TyreLife"),
        (F.col("lap_time_s") * 10).alias("SpeedST"), (F.col("lap") % 20 + 1).alias("Position"),
        F.element_at(F.array(F.lit("SOFT"), F.lit("MEDIUM"), F.lit("HARD")), (eid % 3 + 1).cast("int")).alias("Compound"),
        F.concat(F.lit("Team"), F.col("driver")).alias("Team"), (F.col("lap") % 5 == 1).alias("FreshTyre"),
        (F.floor(F.col("lap") / 10) + 1).alias("Stint"), "event_id")


def fm_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fa_status(spark, sf_dir)
    key, _ = _race_key(F.col("race"))
    return s.select(key.alias("RaceId"), F.col("time").alias("Time"), F.col("status").alias("Status"))


def fm_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = fa_weather(spark, sf_dir)
    key, _ = _race_key(F.col("race"))
    eid = F.col("event_id")
    return w.select(key.alias("RaceId"), F.col("time").alias("Time"), F.col("air_temp").alias("AirTemp"),
                    F.col("humidity").alias("Humidity"), F.when(eid % 9 == 0, 1.0).otherwise(0.0).alias("Rainfall"),
                    (F.col("air_temp") + 10).alias("TrackTemp"), (eid % 30).cast("double").alias("WindSpeed"),
                    F.lit(1013.0).alias("Pressure"), (eid % 360).cast("double").alias("WindDirection"))
