"""A trained model as one saved pipeline."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from seqrisk.config import FeatureRoles
from seqrisk.operators.model import score, train_classifier
from seqrisk.operators.scoring import score_requests
from seqrisk.operators.unit import UnitScorer, as_unit, load_unit, save_unit, score_unit

ROLES = FeatureRoles(categorical=("Compound",), numeric=("TyreLife", "Speed"), boolean=("Wet",), interactions=(("TyreLife", "Speed"),))


@pytest.fixture(scope="module")
def rows(spark):
    c = F.element_at(F.array(F.lit("SOFT"), F.lit("HARD"), F.lit(None)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(240).select("id", c.alias("Compound"), F.when(F.col("id") % 7 != 0, F.col("id") % 30).cast("double").alias("TyreLife"),
                                   (F.col("id") % 11 * 10.0).alias("Speed"), (F.col("id") % 2 == 0).alias("Wet"),
                                   (F.col("id") % 30 > 20).cast("int").alias("y"))


@pytest.fixture(scope="module")
def fitted(rows):
    return train_classifier(rows, "y", ROLES, {"maxIter": 3, "maxDepth": 3})


def probabilities(df, col="sc_probability"):
    return {r.id: r[col] for r in df.select("id", col).collect()}


def test_one_folder_scores_as_the_pair_does(rows, fitted, tmp_path):
    path = str(tmp_path / "m")
    save_unit(as_unit(*fitted, ROLES), path)
    assert os.listdir(tmp_path) == ["m"]
    unit = PipelineModel.load(path)
    assert probabilities(score_unit(rows, unit)) == probabilities(score(rows, *fitted, roles=ROLES))
    fp, roles = unit.stages[0].parts()
    assert fp == fitted[1] and roles == ROLES


def test_nulls_lacking_columns_new_categories_and_clashing_names(spark, rows, fitted):
    unit = as_unit(*fitted, ROLES)
    odd = rows.limit(4).withColumns({"Compound": F.lit("NEVER SEEN"), "TyreLife": F.lit(None).cast("double"), "Wet": F.lit(None).cast("boolean")})
    assert all(0 <= p <= 1 for p in probabilities(score_unit(odd, unit)).values())
    lacking = rows.drop("Wet", "Speed").limit(5)
    assert probabilities(score_unit(lacking, unit)) == probabilities(score(lacking, *fitted, roles=ROLES))
    clash = rows.withColumns({"features": F.lit("mine"), "probability": F.lit("mine"), "__f_Speed": F.lit("mine"), "a.b": F.lit(1)})
    got = score_unit(clash, unit)
    assert got.columns == [*clash.columns, "sc_probability"] and got.where("features = 'mine' and probability = 'mine' and __f_Speed = 'mine'").count() == 240
    assert probabilities(got) == probabilities(score_unit(rows, unit))
    assert score_unit(rows.where("false"), unit).count() == 0


def test_replaced_whole_or_not_at_all(rows, fitted, tmp_path):
    path = str(tmp_path / "m")
    unit = as_unit(*fitted, ROLES)
    save_unit(unit, path)
    with pytest.raises(FileExistsError):
        save_unit(unit, path)
    other = train_classifier(rows, "y", ROLES, {"maxIter": 1, "maxDepth": 1})
    save_unit(as_unit(*other, ROLES), path, overwrite=True)
    assert os.listdir(tmp_path) == ["m"] and load_unit(path).stages[-1].getNumTrees == 1

    class Broken(PipelineModel):
        def write(self):
            raise RuntimeError("lost while saving")
    with pytest.raises(RuntimeError):
        save_unit(Broken(unit.stages), path, overwrite=True)
    assert os.listdir(tmp_path) == ["m"] and load_unit(path).stages[-1].getNumTrees == 1
    with pytest.raises(Exception, match="(?i)not exist|No such"):
        load_unit(str(tmp_path / "none"))


def test_requests_are_scored_by_a_unit(spark, fitted):
    rows = [(1, "2023_01_X", "3", ("SOFT", 12.0)), (2, None, "3", ("SOFT", 1.0))]
    req = spark.createDataFrame(rows, "id long, race_id string, lap string, lap_data struct<Compound:string,TyreLife:double>")
    out = {r.id: r for r in score_requests(req, UnitScorer(as_unit(*fitted, ROLES)), 0.3, keep=["id"]).collect()}
    assert 0 <= out[1].probability <= 1 and out[1].will_deploy_sc == (out[1].probability >= 0.3) and out[2].probability is None
