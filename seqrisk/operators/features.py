"""Feature pipeline: interactions, fitted parameters, transform.

Fitted parameters are tables: ``stats_table`` (one row per numeric column) and
``vocab_table`` (one row per category, of any number). ``one_hot_rows`` encodes
sparsely by joining the vocabulary; the model's pipeline has its own indexers
and sparse encoders. The wide ``Col_category`` output of ``transform_features``
takes the vocabulary to the driver, one output column per category, and is for
columns with few of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqrisk.config import FeatureRoles
from seqrisk.functions.expr import bool_to_int
from seqrisk.operators.ranking import exact_medians, running_sums
from seqrisk.session import cut_lineage

UNKNOWN = "unknown"


def add_interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``{a}_{b}_interaction`` = a * b for each pair whose columns both
    exist; null propagates."""
    new = {f"{a}_{b}_interaction": F.col(a) * F.col(b) for a, b in pairs
           if a in df.columns and b in df.columns}
    return df.withColumns(new) if new else df


def interaction_names(df_columns: Sequence[str], pairs) -> list[str]:
    return [f"{a}_{b}_interaction" for a, b in pairs if a in df_columns and b in df_columns]


@dataclass
class FeatureParams:
    categorical: dict = field(default_factory=dict)   # col -> sorted categories (wide output)
    numeric: dict = field(default_factory=dict)       # col -> (median, mean, std)
    boolean: list = field(default_factory=list)
    inputs: list = field(default_factory=list)        # feature input columns
    indexed: list = field(default_factory=list)       # categorical columns that the model encodes

    def output_columns(self) -> list[str]:
        cols = [f"{c}_{v}" for c, vs in self.categorical.items() for v in vs]
        return cols + list(self.numeric) + list(self.boolean)


def feature_inputs(df: DataFrame, roles: FeatureRoles) -> tuple[list, list, list]:
    cat = [c for c in roles.categorical if c in df.columns]
    num = [c for c in roles.numeric if c in df.columns]
    if roles.include_interactions:
        num += interaction_names(df.columns, roles.interactions)
    boo = [c for c in roles.boolean if c in df.columns]
    return cat, num, boo


def _category(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))


def vocab_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, category, position): the distinct values per column after
    null -> 'unknown', numbered from 0 in order. One aggregation for all
    columns; positions are running counts over ranges of the categories."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _category(c).alias("category")) for c in cols]))
    seen = df.select(pairs.alias("p")).select("p.*").distinct()
    ranked = running_sums(seen, [F.col("category")], {"n": F.lit(1)}, ["feature"])
    return ranked.select("feature", "category", (F.col("n") - 1).cast("int").alias("position"))


def category_vocab(df: DataFrame, cols: Sequence[str]) -> dict:
    """A8 for the wide output: sorted categories per column, on the driver."""
    out = {c: [] for c in cols}
    if cols:
        for r in vocab_table(df, cols).orderBy("feature", "position").toLocalIterator():
            out[r["feature"]].append(r["category"])
    return out


def one_hot_rows(df: DataFrame, vocab: DataFrame, cols: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """M2, sparse: one row (ids..., feature, position) per row and column of
    ``df`` whose category the vocabulary knows; unseen ones have no row."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _category(c).alias("category")) for c in cols]))
    long = df.select(*ids, pairs.alias("p")).select(*ids, "p.*")
    return long.join(vocab, ["feature", "category"]).select(*ids, "feature", "position")


def stats_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, median, mean, std): exact median per column, then mean and
    population std of the median-imputed column (std 0 or undefined counts as
    1). The medians are one row and ride along as a scalar subquery; the columns
    are written once for all passes."""
    df = cut_lineage(df.select(*cols))
    med = exact_medians(df, [], cols).select(F.struct(*cols).alias("m")).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), med.getField(c)) for c in cols}
    row = df.agg(*[F.avg(filled[c]).alias(f"a_{c}") for c in cols], *[F.stddev_pop(filled[c]).alias(f"s_{c}") for c in cols])
    one = [F.struct(F.lit(c).alias("feature"), med.getField(c).alias("median"), F.col(f"a_{c}").alias("mean"),
                    F.coalesce(F.when(F.col(f"s_{c}") != 0, F.col(f"s_{c}")), F.lit(1.0)).alias("std")) for c in cols]
    return row.select(F.explode(F.array(*one)).alias("r")).select("r.*")


def fit_stats(df: DataFrame, cols: Sequence[str]) -> dict:
    """A7 as col -> (median, mean, std): one row per column."""
    if not cols:
        return {}
    found = {r["feature"]: (r["median"], r["mean"], r["std"]) for r in stats_table(df, cols).collect()}
    return {c: found[c] for c in cols}


def fit_features(train: DataFrame, roles: FeatureRoles = FeatureRoles(), wide: bool = True) -> FeatureParams:
    """M1 fit: parameters from the training frame only. ``wide`` gathers the
    vocabularies for ``Col_category`` columns; the model does without."""
    d = add_interactions(train, roles.interactions) if roles.include_interactions else train
    cat, num, boo = feature_inputs(d, roles)
    return FeatureParams(category_vocab(d, cat) if wide else {}, fit_stats(d, num), boo, cat + num + boo, [] if wide else cat)


def feature_exprs(params: FeatureParams, prefix: str = "") -> list[Column]:
    """M1 transform + M2 naming as expressions: one-hot ``Col_category``
    (unseen categories give all zeros), standardized numerics, 0/1 booleans."""
    out = []
    for c, vals in params.categorical.items():
        v = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
        out += [F.when(v == F.lit(x), 1.0).otherwise(0.0).alias(f"{prefix}{c}_{x}") for x in vals]
    for c, (med, mean, std) in params.numeric.items():
        x = F.coalesce(F.col(c).cast("double"), F.lit(med))
        out.append(((x - F.lit(mean)) / F.lit(std)).alias(f"{prefix}{c}"))
    out += [bool_to_int(c).cast("double").alias(f"{prefix}{c}") for c in params.boolean]
    return out


def transform_features(df: DataFrame, params: FeatureParams, roles: FeatureRoles = FeatureRoles(),
                       passthrough: bool = True) -> DataFrame:
    """M1 apply + P12: transformed features, then every other input column
    unchanged (columns consumed as features are not passed through)."""
    d = add_interactions(df, roles.interactions) if roles.include_interactions else df
    feats = feature_exprs(params)
    names = set(params.output_columns()) | set(params.inputs)
    rest = [c for c in df.columns if c not in names] if passthrough else []
    return d.select(*feats, *rest)
