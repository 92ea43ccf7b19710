"""Metrics ledger, raw request bodies, session catalogue, and rules for null and NaN scores."""

import json

import pytest
from pyspark.sql import functions as F

from seqrisk.operators.evaluation import calibration, confusion, latest_metric, metrics_row
from seqrisk.operators.ledger import commit_run, fingerprint, read_ledger, run_key, stored_threshold
from seqrisk.operators.reports import flagged_laps, lap_rows, race_summary
from seqrisk.operators.scoring import linear_scorer, parse_bodies, score_bodies
from seqrisk.plans.jobs import deployed_scores
from seqrisk.sources.files import pending_in_folder, session_catalog
from seqrisk.streaming.requests import score_body_stream


def test_repeated_run_leaves_one_row(spark, tmp_path):
    path = str(tmp_path / "ledger")
    with pytest.raises(FileNotFoundError):
        read_ledger(spark, path)
    s = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.6)], "y int, score double")
    key = run_key({"s": s}, {"a": 1})
    assert key == run_key({"s": s.repartition(3)}, {"a": 1}) != run_key({"s": s}, {"a": 2})
    assert run_key({"s": s.limit(3)}, {"a": 1}) != key and fingerprint(s.limit(0)) == "0:None:None"
    for _ in range(3):
        commit_run(metrics_row(s, dataset="holdout").unionByName(metrics_row(s, dataset="test")), path, key, 5)
    commit_run(metrics_row(s.where("score > 0.3"), dataset="holdout"), path, "0other", 5)
    got = read_ledger(spark, path)
    assert sorted((r["run_id"], r["dataset"]) for r in got.collect()) == sorted([(key, "holdout"), (key, "test"), ("0other", "holdout")])
    want = max((key, 0.75), ("0other", 0.5))[1]
    for parts in (1, 4):
        assert latest_metric(got.repartition(parts), "holdout", "auc", 0.1).first()["auc"] == pytest.approx(want)
    assert latest_metric(got, "none", "auc", 0.1).first()["auc"] == 0.1


def test_equal_run_times_do_not_depend_on_row_order(spark):
    rows = [(0, "holdout", 0.7), (0, "holdout", 0.9), (0, "holdout", 0.8)]
    for r in (rows, rows[::-1]):
        assert latest_metric(spark.createDataFrame(r, "run_ts int, dataset string, auc double").coalesce(1), "holdout", "auc", 0.1).first()["auc"] == 0.9


def test_null_and_nan_scores_count_nowhere(spark):
    s = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, float("nan")), (0, float("nan")), (1, None), (None, 0.9)], "y int, score double")
    assert confusion(s, 0.5).first().asDict() == {"tn": 1, "fp": 0, "fn": 0, "tp": 1}
    c = {r["bin"]: r for r in calibration(s.where("y is not null")).collect()}
    assert sorted(c) == [1, 8] and c[8]["prob_pred"] == 0.9 and c[8]["n"] == 1
    m = metrics_row(s).first()
    assert (m["tp"], m["fp"], m["tn"], m["fn"]) == (1, 0, 1, 0)


def test_null_race_keeps_its_medians(spark):
    df = spark.createDataFrame([(None, 1, 20.0), (None, 2, 30.0), ("a", 1, 5.0)], "RaceId string, LapNumber int, AirTemp double")
    got = {r["RaceId"]: r["median_AirTemp"] for r in race_summary(df, first_cols=(), median_cols=("AirTemp",)).collect()}
    assert got == {None: 25.0, "a": 5.0}


def test_lap_lookups(spark):
    df = spark.createDataFrame([("a", 2, True), ("a", 2, None), ("a", 3, False), ("a", None, True), ("b", 2, True)], "RaceId string, LapNumber int, SafetyCar boolean")
    assert lap_rows(df).count() == 3 and lap_rows(df, 3).count() == 1 and lap_rows(df, 9).count() == 0 and lap_rows(df.limit(0)).count() == 0
    assert {(r["RaceId"], r["LapNumber"], r["rows"]) for r in flagged_laps(df).collect()} == {("a", 2, 1), ("b", 2, 1)}


BODIES = [
    ('{"race_id": "2024_01_Monza_VER", "lap": 5, "lap_data": {"TyreLife": 7, "Driver": "VER", "FreshTyre": true, "unknown": [1]}}', None),
    ('{"race_id": "2024_01_Monza_VER", "lap": "12"}', None), ('{"race_id": "2024_01_Monza_VER", "lap": -5.9, "lap_data": null}', None),
    ('{"race_id": "x", "lap": true, "lap_data": {"TyreLife": null}}', None), ('{"race_id": "x", "lap": " 7 ", "lap_data": {}}', None),
    ('{"race_id": "x", "lap": "7.5"}', "invalid literal for int() with base 10: '7.5'"), ('{"race_id": "x", "lap": "abc"}', "invalid literal for int() with base 10: 'abc'"),
    ('{"race_id": "x"}', "Missing required parameters: race_id, lap"), ('{"race_id": null, "lap": 3}', "Missing required parameters: race_id, lap"),
    ('{"race_id": "x", "lap": null, "lap_data": 3}', "Missing required parameters: race_id, lap"), ("{}", "Missing required parameters: race_id, lap"),
    ("[1, 2]", "Missing required parameters: race_id, lap"), ("3", "Missing required parameters: race_id, lap"), ("null", "Missing required parameters: race_id, lap"),
    ('{"race_id": "x", "lap": 3', "The body is not JSON"), ("", "The body is not JSON"), (None, "The body is not JSON"), ("lap=3", "The body is not JSON"),
    ('{"race_id": "x", "lap": {"n": 3}}', "lap must be a number or text"), ('{"race_id": "x", "lap": [3]}', "lap must be a number or text"),
    ('{"race_id": "x", "lap": 3, "lap_data": "fast"}', "lap_data must be an object"), ('{"race_id": "x", "lap": 3, "lap_data": [1]}', "lap_data must be an object"),
    ('{"race_id": "x", "lap": 3, "lap_data": {"TyreLife": "worn"}}', "lap_data.TyreLife: not a number"),
    ('{"race_id": "x", "lap": 3, "lap_data": {"TyreLife": "7"}}', "lap_data.TyreLife: not a number"),
    ('{"race_id": "x", "lap": 3, "lap_data": {"FreshTyre": "yes", "TyreLife": {}}}', "lap_data.TyreLife: not a number"),
    ('{"race_id": "x", "lap": 3, "lap_data": {"FreshTyre": "yes"}}', "lap_data.FreshTyre: not true or false"),
    ('{"race_id": "x", "lap": 3, "lap_data": {"Driver": {"name": "VER"}}}', "lap_data.Driver: not text"),
]


def test_bodies_have_a_score_or_their_own_error(spark):
    df = spark.createDataFrame([(i, b) for i, (b, _) in enumerate(BODIES)], "id int, body string")
    got = {r["id"]: r for r in score_bodies(df, linear_scorer({"TyreLife": 0.1, "LapNumber": 0.0}, -1.0), keep=["id"]).collect()}
    for i, (body, message) in enumerate(BODIES):
        assert (got[i]["message"], got[i]["probability"] is None, got[i]["error"] is None) == (message, message is not None, message is None), body
    assert [got[i]["lap"] for i in range(5)] == [5, 12, -5, 1, 7]
    assert got[0]["probability"] == pytest.approx(1 / (1 + 2.718281828459045 ** 0.3))
    first = parse_bodies(df).orderBy("id").first()
    assert (first["lap_data"]["TyreLife"], first["lap_data"]["Driver"], first["lap_data"]["FreshTyre"]) == (7.0, "VER", True)
    assert score_bodies(df.limit(0), linear_scorer({}, 0.0), keep=["id"]).count() == 0


def test_body_stream_keeps_rejected_bodies(spark, tmp_path):
    src, out, dead, ck = (str(tmp_path / n) for n in ("in", "out", "dead", "ck"))
    lines = [b for b, _ in BODIES if b]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    score_body_stream(spark, src, linear_scorer({}, 0.0), out, dead, ck).awaitTermination()
    good = sum(m is None for b, m in BODIES if b)
    assert spark.read.parquet(out).count() == good
    lost = {r["raw"]: r["message"] for r in spark.read.parquet(dead).collect()}
    assert lost == {b: m for b, m in BODIES if b and m}
    (tmp_path / "in" / "b.txt").write_text(json.dumps({"race_id": "x", "lap": 1}) + "\n")
    score_body_stream(spark, src, linear_scorer({}, 0.0), out, dead, ck).awaitTermination()
    assert spark.read.parquet(out).count() == good + 1


def test_catalogue_of_a_folder(spark, tmp_path):
    one = spark.range(3).withColumn("x", F.lit(1))
    root = str(tmp_path / "raw")
    with pytest.raises(FileNotFoundError):
        session_catalog(spark, root)
    one.coalesce(1).write.parquet(f"{root}/2024_01_Bahrain_Grand_Prix_R_laps.parquet")
    one.repartition(2).write.parquet(f"{root}/deep/2024_02_Saudi_Q_laps.parquet")
    one.coalesce(1).write.parquet(f"{root}/2024_03_Monza_R_weather.parquet")
    one.coalesce(1).write.parquet(f"{root}/notes_laps.parquet")
    got = {(r["year"], r["round"], r["event"], r["session_type"]) for r in session_catalog(spark, root).collect()}
    assert got == {(2024, 1, "Bahrain_Grand_Prix", "R"), (2024, 2, "Saudi", "Q")}
    schedule = spark.sql("select 2024 year, stack(3, 1, 2, 9) round, date'2024-03-01' event_date")
    left = {(r["round"], r["session_type"]) for r in pending_in_folder(spark, schedule, root, "2024-06-01").collect()}
    assert left == {(1, "Q"), (2, "R"), (9, "Q"), (9, "R")}
    assert pending_in_folder(spark, schedule, root, "2020-01-01").count() == 0


def test_deployed_threshold_follows_the_ledger(spark, tmp_path):
    """0.5 without a ledger or a run of the data set; then the latest run's, for typed rows, bodies and each micro-batch."""
    path, source = str(tmp_path / "ledger"), tmp_path / "in"
    source.mkdir()
    scorer = linear_scorer({"TyreLife": 1.0}, -10.0)                 # 0.269 for a tyre life of 9
    text = json.dumps({"race_id": "2024_01_X_R", "lap": 3, "lap_data": {"TyreLife": 9}})
    typed = spark.createDataFrame([("2024_01_X_R", "3", (9,)), (None, "3", (9,))], "race_id string, lap string, lap_data struct<TyreLife:int>")
    bodies = spark.createDataFrame([(text,), ("{",)], "body string")

    def found():
        rows = deployed_scores(spark, typed, scorer, path).unionByName(deployed_scores(spark, bodies, scorer, path, body="body")).collect()
        assert [(r.probability, r.threshold, r.will_deploy_sc) for r in rows if r.error] == [(None, None, None)] * 2
        return {(r.threshold, r.will_deploy_sc) for r in rows if not r.error}

    def stream(n):
        (source / f"{n}.txt").write_text(text + "\n")
        score_body_stream(spark, str(source), scorer, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "check"),
                          metrics_path=path).awaitTermination(120)
        return sorted((r.threshold, r.will_deploy_sc) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert found() == {(0.5, False)} and stream(1) == [(0.5, False)]
    s = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.25), (0, 0.2)], "y int, score double")
    commit_run(metrics_row(s, dataset="test"), path, "a", 1)
    assert found() == {(0.5, False)}                                 # no run on the holdout yet
    commit_run(metrics_row(s, dataset="holdout"), path, "a", 1)
    assert found() == {(0.25, True)} and stream(2) == [(0.25, True), (0.5, False)]
    commit_run(metrics_row(s.withColumn("score", F.col("score") / 2 + 0.3), dataset="holdout"), path, "b", 2)
    assert found() == {(0.425, False)}
