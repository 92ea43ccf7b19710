"""P11, M1/M2, A6/M3-M6, P2/P16-P19/M7 on own rows."""

import math

import pytest
from pyspark.sql import functions as F

from seqrisk.config import INTERACTIONS, FeatureRoles
from seqrisk.functions.expr import parse_race_id
from seqrisk.operators.features import add_interactions, fit_features, one_hot_rows, transform_features, vocab_table
from seqrisk.operators.model import (ModelScorer, cross_validate, feature_importance, load_model, prepare, save_model, score,
                                     train_classifier)
from seqrisk.operators.scoring import linear_scorer, score_requests, validate_requests

# Own rows: a tie in every category count, a null in each kind of column, negative values.
SAMPLE = [
    ("k1", 7, "ann", "blue", "wet", 4.0, True, 9, 120, 12.5, 0.5, 2.0, 8, None, False),
    ("k1", 8, "bob", "blue", None, 10.0, None, 8, 90, -3.0, 0.0, 2.0, 8, True, True),
    ("k1", 9, "cid", "red", "dry", None, False, 7, 150, 0.0, 1.0, 2.0, 8, False, False),
    ("k2", 7, "ann", None, "wet", 6.0, True, 6, 110, 4.0, 0.25, 3.5, 5, False, None),
]
SAMPLE_SCHEMA = ("RaceId string, LapNumber int, Driver string, Team string, Compound string, TyreLife double, FreshTyre boolean, "
                 "Position int, SpeedST int, TrackTemp double, Rainfall double, TrackLength double, Corners int, YellowFlag boolean, "
                 "SafetyCar boolean")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(SAMPLE, SAMPLE_SCHEMA)


def test_interactions(sample):
    r = {(x.RaceId, x.LapNumber): x for x in add_interactions(sample, INTERACTIONS).collect()}
    assert r["k1", 7].TyreLife_TrackTemp_interaction == 50.0 and r["k1", 8].TyreLife_TrackTemp_interaction == -30.0
    assert r["k1", 9].TyreLife_TrackTemp_interaction is None                # null propagates
    assert r["k2", 7].TrackLength_SpeedST_interaction == 385.0 and r["k2", 7].Rainfall_Corners_interaction == 1.25


def test_feature_fit_transform(spark, sample):
    roles = FeatureRoles(categorical=("Compound",), numeric=("TyreLife", "SpeedST"), boolean=("FreshTyre",),
                         include_interactions=False)
    fp = fit_features(sample, roles)
    assert fp.categorical["Compound"] == ["dry", "unknown", "wet"]
    med, mean, std = fp.numeric["TyreLife"]                       # 4, 10, (6), 6
    assert med == 6.0 and abs(mean - 6.5) < 1e-12 and abs(std - math.sqrt(19 / 4)) < 1e-12  # population std
    new = spark.createDataFrame([("snow", None, 301, None, "x")],
                                "Compound string, TyreLife int, SpeedST int, FreshTyre boolean, RaceId string")
    r = transform_features(new, fp, roles).first()
    assert (r.Compound_dry, r.Compound_unknown, r.Compound_wet) == (0.0, 0.0, 0.0)        # unseen: zeros
    assert abs(r.TyreLife - (6.0 - 6.5) / math.sqrt(19 / 4)) < 1e-12                      # median imputed
    assert r.FreshTyre == 0.0 and r.RaceId == "x"                                         # passthrough


def test_vocabulary_of_any_size(spark):
    df = spark.range(0, 30_000).select(F.concat(F.lit("d"), (F.col("id") % 20_000).cast("string")).alias("Driver"), "id")
    v = vocab_table(df, ["Driver"])
    assert v.count() == 20_000
    first = {r.category: r.position for r in v.where("position < 3").collect()}
    assert first == {c: i for i, c in enumerate(sorted(f"d{i}" for i in range(20_000))[:3])}
    rows = one_hot_rows(df.where("id < 5").unionByName(spark.createDataFrame([("new", 99)], "Driver string, id long")), v, ["Driver"], ["id"])
    assert {r.id for r in rows.collect()} == set(range(5))


def test_model_encodes_many_categories(spark):
    df = spark.range(0, 3000).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("Driver"), (F.col("id") % 7).cast("double").alias("TyreLife"),
                                     (F.col("id") % 7 > 4).cast("int").alias("sc_next_lap"))
    roles = FeatureRoles(categorical=("Driver",), numeric=("TyreLife",), boolean=())
    model, fp = train_classifier(df, "sc_next_lap", roles, {"maxIter": 2, "maxDepth": 2})
    s = score(df.withColumn("Driver", F.lit("nobody")), model, fp, 0.5, roles)
    assert s.where(F.col("sc_prediction") != F.col("sc_next_lap")).count() == 0
    imp = {r.feature: r.importance for r in feature_importance(model, fp).collect()}
    assert len(imp) == 3001 and imp["TyreLife"] > 0.99


def test_requests_scored_by_a_trained_model(spark, sample, tmp_path):
    df = sample.withColumn("sc_next_lap", (F.col("LapNumber") == 9).cast("int"))
    df = df.unionByName(df).unionByName(df)
    roles = FeatureRoles(categorical=("Compound",), numeric=("TyreLife", "SpeedST"), boolean=("FreshTyre",))
    model, fp = train_classifier(df, "sc_next_lap", roles, {"maxIter": 2, "maxDepth": 2})
    rows = [(1, "2023_01_X", "3", ("wet", 4.0)), (2, None, "3", None), (3, "2023_01_X", "z", None), (4, "2023_01_X", "5", ("dry", None))]
    req = spark.createDataFrame(rows, "id int, race_id string, lap string, lap_data struct<Compound:string,TyreLife:double>")
    scorer = ModelScorer(model, fp, roles)
    out = {r.id: r for r in score_requests(req, scorer, 0.3, keep=["id"]).collect()}
    for i in (1, 4):
        assert 0 <= out[i].probability <= 1 and out[i].will_deploy_sc == (out[i].probability >= 0.3) and out[i].threshold == 0.3
    assert out[2].probability is None and out[3].error == "Invalid value"
    from seqrisk.streaming.requests import score_stream
    req.write.parquet(str(tmp_path / "in"))
    score_stream(spark, str(tmp_path / "in"), req.schema, scorer, str(tmp_path / "out"), str(tmp_path / "ck"), 0.3, keep=["id"]).awaitTermination()
    again = {r.id: r.probability for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert again == {i: r.probability for i, r in out.items()}


def test_train_score_persist(spark, sample, tmp_path):
    df = sample.withColumn("sc_next_lap", (F.col("LapNumber") == 9).cast("int"))
    df = df.unionByName(df).unionByName(df)
    roles = FeatureRoles(categorical=("Compound",), numeric=("TyreLife", "SpeedST", "Position"),
                         boolean=("FreshTyre", "YellowFlag"))
    model, fp = train_classifier(df, "sc_next_lap", roles, {"maxIter": 3, "maxDepth": 2})
    s = score(df, model, fp, 0.4, roles).collect()
    assert all(0.0 <= r.sc_probability <= 1.0 and r.sc_prediction == int(r.sc_probability >= 0.4) for r in s)
    save_model(model, fp, str(tmp_path / "m"))
    m2, fp2 = load_model(str(tmp_path / "m"))
    assert fp2.numeric == fp.numeric and fp2.categorical == fp.categorical
    s2 = score(df, m2, fp2, 0.4, roles).collect()
    assert [r.sc_probability for r in s] == [r.sc_probability for r in s2]


def test_parse_race_id(spark):
    df = spark.createDataFrame([("2023_05_Miami_Grand_Prix",), ("2023_05",), ("bad_05_x",), ("2022",)], "k string")
    got = [tuple(r.p) for r in df.select(parse_race_id("k").alias("p")).collect()]
    assert got == [(2023, "Miami_Grand_Prix"), (2023, "Unknown"), (2024, "Unknown"), (2022, "Unknown")]


def test_requests(spark):
    rows = [("2023_01_Bahrain", "3", (None, 20.0)), (None, "3", (None, None)), ("2023_01_X", None, None),
            ("2023_01_X", "x7", None)]
    df = spark.createDataFrame(rows, "race_id string, lap string, lap_data struct<Driver:string,TyreLife:double>")
    v = validate_requests(df).collect()
    assert [r.error for r in v] == [None, "Invalid request", "Invalid request", "Invalid value"]
    assert v[3].message == "invalid literal for int() with base 10: 'x7'"
    out = score_requests(df, linear_scorer({"TyreLife": 0.1, "TrackTemp": 0.0}, -1.0), 0.5).collect()
    ok = out[0]
    assert abs(ok.probability - 1 / (1 + math.exp(-(-1.0 + 0.1 * 20)))) < 1e-12
    assert ok.will_deploy_sc == (ok.probability >= 0.5) and ok.track == "Bahrain" and ok.lap == 3
    assert all(r.probability is None for r in out[1:])


def test_categories_are_split_off_without_a_column_each(spark):
    """20,000 categories, one of them positive: found by itself, without a vector as wide as the vocabulary."""
    n = 20_000
    df = spark.range(0, 2 * n).select(F.concat(F.lit("d"), F.lpad((F.col("id") % n).cast("string"), 5, "0")).alias("Driver"),
                                      (F.col("id") % 3).cast("double").alias("TyreLife"), (F.col("id") % n == 77).cast("int").alias("sc_next_lap"))
    roles = FeatureRoles(categorical=("Driver",), numeric=("TyreLife",), boolean=())
    model, fp = train_classifier(df, "sc_next_lap", roles, {"maxIter": 1, "maxDepth": 1, "featureSubsetStrategy": "all", "subsamplingRate": 1.0})
    assert not any("features" in s.transform(prepare(df, fp, roles, [])).columns for s in model.stages[:1])
    assert model.stages[-1].model.trees[0].cut[0] == 77
    p = {r.Driver: r.sc_probability for r in score(df.where("Driver < 'd00100'"), model, fp, 0.5, roles).collect()}
    assert p["d00077"] > 0.5 and all(v < 0.5 for k, v in p.items() if k != "d00077")
    imp = {r.feature: r.importance for r in feature_importance(model, fp).where("importance > 0").collect()}
    assert imp == {"Driver_d00077": 1.0}


def test_cross_validation_holds_each_row_out_once(spark):
    df = spark.range(0, 600).select("id", F.concat(F.lit("d"), (F.col("id") % 200).cast("string")).alias("Driver"),
                                    F.when(F.col("id") % 5 > 0, F.col("id") % 7).cast("double").alias("TyreLife"), (F.col("id") % 7 > 4).cast("int").alias("sc_next_lap"))
    roles = FeatureRoles(categorical=("Driver",), numeric=("TyreLife",), boolean=())
    got = {r.fold: r for r in cross_validate(df, "sc_next_lap", ["id"], 3, roles, {"maxIter": 2, "maxDepth": 2}).collect()}
    positives = sum(i % 7 > 4 for i in range(600))
    assert sorted(got) == [0, 1, 2] and sum(r.rows for r in got.values()) == 600 and sum(r.positives for r in got.values()) == positives
    assert all(r.auc > 0.7 for r in got.values())


def test_cross_validation_fits_folds_beside_each_other(spark, tmp_path, monkeypatch):
    """Two fits wait for each other, both write their scratch tables in the caller's scope, and each fold has its own rows."""
    import threading
    from seqrisk.operators import model
    from seqrisk.session import scratch_path, scratch_scope
    both, paths = threading.Barrier(2, timeout=60), []

    def fit(train, *settings):
        paths.append(scratch_path(spark, "seqrisk-tables", "x"))
        both.wait()
        return train_classifier(train, *settings)

    monkeypatch.setattr(model, "train_classifier", fit)
    df = spark.range(0, 200).select("id", F.lit("d").alias("Driver"), (F.col("id") % 7).cast("double").alias("TyreLife"), (F.col("id") % 7 > 4).cast("int").alias("sc_next_lap"))
    roles = FeatureRoles(categorical=("Driver",), numeric=("TyreLife",), boolean=())
    with scratch_scope(spark) as scope:
        got = {r.fold: r.rows for r in cross_validate(df, "sc_next_lap", ["id"], 2, roles, {"maxIter": 1, "maxDepth": 1}).collect()}
    assert len(paths) == 2 and all(scope in p for p in paths)
    assert sorted(got) == [0, 1] and sum(got.values()) == 200
