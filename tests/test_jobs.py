"""X1-X5 end to end on small inputs."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from seqrisk.config import FeatureRoles
from seqrisk.plans import fixtures as fx
from seqrisk.plans.jobs import merge_sessions, profile_report, season_job, train_job, transform_job, tuned_threshold

R = "2023_01_Bahrain_R"


def t(h, m, s=0):
    return dt.datetime(2023, 3, 5, h, m, s)


def test_merge_and_label_of_own_rows(spark):
    laps = spark.createDataFrame(
        [(R, "x1", "T", 11, t(9, 0), 100.0, "R", True, "Monza", 3), (R, "x1", "T", 12, t(9, 2), 110.0, "R", True, "Monza", 2),
         (R, "x1", "T", 13, t(9, 4), None, "R", True, "Monza", 2), (R, "x1", "T", 14, t(9, 6), 95.0, "R", True, "Monza", 1)],
        "RaceId string, Driver string, Team string, LapNumber int, LapStartTime timestamp_ntz, LapTime double, "
        "SessionType string, IsAccurate boolean, EventName string, Position int")
    status = spark.createDataFrame([(R, t(9, 2, 30), "4"), (R, t(9, 5), "2")], "RaceId string, Time timestamp_ntz, Status string")
    weather = spark.createDataFrame([(R, t(9, 1), 17.0, 60.0, 0.0, 30.0), (R, t(9, 3), None, 61.0, 0.0, 31.0), (R, t(9, 5), 19.0, 62.0, 0.0, 32.0)],
                                    "RaceId string, Time timestamp_ntz, AirTemp double, Humidity double, Rainfall double, TrackTemp double")
    m = {r.LapNumber: r for r in merge_sessions(laps, status, weather).collect()}
    assert [m[i].SafetyCar for i in (11, 12, 13, 14)] == [False, True, False, False] and m[13].YellowFlag
    # lap 11 starts before any sample and lap 13's sample is null: both get the median of 17 and 19
    assert [m[i].AirTemp for i in (11, 12, 13, 14)] == [18.0, 17.0, 18.0, 19.0]
    full = {r.LapNumber: r for r in transform_job(spark, laps, status, weather, holdout_years=(2024,))["full"].collect()}
    assert sorted(full) == [11, 12, 14]                     # lap 13 has no lap time
    assert [full[i].sc_next_lap for i in (11, 12, 14)] == [1, 0, 0]
    assert full[11].TrackId == "Monza" and full[11].TrackLength == 5.793 and full[11].Corners == 11 and full[11].Year == 2023


def test_transform_and_train_on_tables(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    out = transform_job(spark, fx.fm_laps(spark, d), fx.fm_status(spark, d), fx.fm_weather(spark, d),
                        out_dir=str(tmp_path / "x1"))
    full, tr, te, ho = (out[k] for k in ("full", "train", "test", "holdout"))
    n = full.count()
    assert n > 0 and tr.count() + te.count() + ho.count() == n
    assert set(r.Year for r in ho.select("Year").distinct().collect()) <= {2024}
    assert not (set(r.RaceId for r in tr.select("RaceId").distinct().collect())
                & set(r.RaceId for r in te.select("RaceId").distinct().collect()))
    assert full.where(F.col("SessionType") != "R").count() == 0
    back = spark.read.parquet(str(tmp_path / "x1" / "full"))
    assert back.count() == n and "Year" in back.columns
    job = train_job(spark, tr, te, ho, FeatureRoles(), params={"maxIter": 2, "maxDepth": 2}, folds=2, cv_key=["event_id"],
                    model_dir=str(tmp_path / "model"), metrics_path=str(tmp_path / "metrics"), run_ts=1)
    train_job(spark, tr, te, ho, FeatureRoles(), params={"maxIter": 1, "maxDepth": 1}, folds=0, metrics_path=str(tmp_path / "metrics"), run_ts=2)
    table = spark.read.parquet(str(tmp_path / "metrics"))
    assert table.count() == 4
    last = table.where("run_ts = 2 and dataset = 'holdout'").first()
    assert spark.range(1).select(tuned_threshold(table).alias("t")).first().t == last.optimal_threshold
    assert 0 <= job["cv"].first().mean_auc <= 1
    rows = {r.dataset: r for r in job["metrics"].collect()}
    assert set(rows) == {"test", "holdout"}
    for r in rows.values():
        assert r.tp + r.fp + r.tn + r.fn > 0
    assert (tmp_path / "model" / "model").exists()


def test_season_and_profile(spark):
    laps = spark.createDataFrame([(2023, "A", "124"), (2023, "A", None), (2024, "B", "1")],
                                 "Year int, EventName string, TrackStatus string")
    s = season_job(laps)
    assert [r.SC for r in s.collect()] == [1, 0, 0]
    p = profile_report(s)
    assert {r.Season: r.rows for r in p["per_season"].collect()} == {2023: 2, 2024: 1}
    assert p["shape"].first().rows == 3
    with pytest.raises(ValueError):
        season_job(laps.withColumn("SessionType", F.lit("Q")))
    share = {r.SC: r.share for r in p["flag_share"].collect()}
    assert abs(share[1] - 1 / 3) < 1e-12


def test_boosted_job_finds_a_planted_signal(spark, tmp_path):
    """Sampled trees and folds in the same passes: fold and holdout AUC above a floor, recomputed from the written scores."""
    from seqrisk.config import FeatureRoles
    from seqrisk.operators.boosting import BoostParams, load_boosted
    from seqrisk.plans.jobs import boosted_job
    df = spark.range(1500).selectExpr("id", "cast(pmod(hash(id), 40) as double) LapNumber", "concat('t', pmod(hash(id, 1), 6)) Team",
                                      "cast(pmod(hash(id, 2), 100) < if(pmod(hash(id), 40) > 25, 80, 8) as int) y")
    roles = FeatureRoles(categorical=["Team"], numeric=["LapNumber"], boolean=[], interactions=[], include_interactions=False)
    path, scores = str(tmp_path / "m"), str(tmp_path / "s")
    job = boosted_job(spark, df.where("id < 1000"), df.where("id >= 1000"), "y", roles, BoostParams(trees=4, depth=3, rate=0.3), 5, ["id"], path, scores)
    folds = job["cv"].collect()
    assert len(folds) == 5 and sum(r["rows"] for r in folds) == 1000 and min(r["auc"] for r in folds) > 0.75
    rows = [(r["y"], r["score"]) for r in spark.read.parquet(scores).collect()]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert len(rows) == 500 and want > 0.75 and abs(job["metrics"].first()["auc"] - want) < 1e-9
    assert load_boosted(spark, path).trees == job["model"].trees


def test_the_training_query_grows_all_trees(spark, monkeypatch):
    """The query trains the model of the settings, in full, as do its five folds."""
    from seqrisk.config import GBT_PARAMS
    from seqrisk.operators import model
    from seqrisk.plans import jobs, queries
    fits = []

    def fit(*args, **settings):
        fits.append((args[3] if len(args) > 3 else settings["params"]))
        raise StopIteration("seen")

    monkeypatch.setattr(queries, "fm_transform", lambda spark, d: dict.fromkeys(("train", "test", "holdout")))
    monkeypatch.setattr(jobs, "train_classifier", fit)
    with pytest.raises(StopIteration):
        queries.q_train_job(spark, "none")
    p = model._boost_params(fits[0])
    assert (p.trees, p.depth) == (GBT_PARAMS["maxIter"], GBT_PARAMS["maxDepth"]) == (600, 6)
