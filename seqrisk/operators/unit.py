"""A trained model as one pipeline (M5, M6): raw columns in, probability out.

``FeatureStage`` is the feature engineering (interactions, category text, scaled
numbers, 0/1 booleans) as a pipeline stage that carries its fitted parameters,
so encoder, assembler and trees follow it in one ``PipelineModel``: one folder,
no side files, loaded with ``PipelineModel.load`` alone.

A save is staged beside its target and moved there by one rename: a reader sees
a whole model or none, and a job that dies leaves nothing under the target's
name. A model that is replaced is moved aside first and removed after the new
one is in place.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqrisk.config import FeatureRoles
from seqrisk.operators.features import FeatureParams
from seqrisk.operators.model import FEAT, prepare

MADE = ("features", "rawPrediction", "probability", "prediction")


class FeatureStage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the model's input columns (named with the prefix ``__f_``) to any
    frame; a feature column that the frame lacks counts as null. Columns of the
    frame that have the name of one it makes are replaced."""

    settings = Param(Params._dummy(), "settings", "fitted feature parameters and roles, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, settings: str = "{}") -> None:
        super().__init__()
        self._set(settings=settings)

    @staticmethod
    def of(fp: FeatureParams, roles: FeatureRoles) -> FeatureStage:
        return FeatureStage(settings=json.dumps({"params": asdict(fp), "roles": asdict(roles)}))

    def parts(self) -> tuple[FeatureParams, FeatureRoles]:
        d = json.loads(self.getOrDefault(self.settings))
        p, r = d["params"], d["roles"]
        p["numeric"] = {k: tuple(v) for k, v in p["numeric"].items()}
        pairs = tuple(tuple(x) for x in r.pop("interactions"))
        return FeatureParams(**p), FeatureRoles(**{k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}, interactions=pairs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fp, roles = self.parts()
        keep = [F.col(f"`{c}`") for c in dataset.columns if not c.startswith(FEAT)]
        return prepare(dataset, fp, roles, keep)


def as_unit(model: PipelineModel, fp: FeatureParams, roles: FeatureRoles = FeatureRoles()) -> PipelineModel:
    """The pair of ``train_classifier`` as one pipeline over raw columns."""
    return PipelineModel([FeatureStage.of(fp, roles), *model.stages])


def save_unit(unit: PipelineModel, path: str, overwrite: bool = False) -> None:
    """M5: one folder, moved into place whole. An existing target is an error
    unless ``overwrite``."""
    spark = SparkSession.getActiveSession()
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    tag = uuid.uuid4().hex[:12]
    staged, old = (jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{what}-{tag}") for what in ("staged", "old"))
    try:
        unit.write().save(staged.toString())
        if fs.exists(target) and not fs.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(staged, target):
            if fs.exists(old):
                fs.rename(old, target)
            raise OSError(f"cannot move the model to {path}")
        fs.delete(old, True)
    finally:
        fs.delete(staged, True)


def load_unit(path: str) -> PipelineModel:
    """M5: what ``save_unit`` wrote; a missing folder raises."""
    return PipelineModel.load(path)


def score_unit(df: DataFrame, unit: PipelineModel, out: str = "sc_probability") -> DataFrame:
    """M6: the input columns and the probability of class 1. Columns that share
    a name with one the pipeline makes are kept as they were."""
    taken = {c: f"__own_{i}" for i, c in enumerate(df.columns) if c in MADE or c.startswith(FEAT)}
    scored = unit.transform(df.withColumnsRenamed(taken))
    own = [F.col(f"`{taken.get(c, c)}`").alias(c) for c in df.columns if c != out]
    return scored.select(*own, vector_to_array(F.col("probability")).getItem(1).alias(out))


class UnitScorer:
    """A pipeline of this form as the scorer of ``score_requests``."""

    def __init__(self, unit: PipelineModel) -> None:
        self.unit = unit

    def add_probability(self, df: DataFrame, out: str) -> DataFrame:
        return score_unit(df, self.unit, out)
