"""URL filters (9): policy rules, else logistic regression on hashed n-grams.

``split_url`` cuts host and path. ``apply_rules`` finds the longest rule whose
host is the url's host or a parent domain and whose path is a prefix of the
url's path. Urls without a rule get the verdict of a logistic regression on
hashed character n-grams of host and path, fitted on a small labelled URL
table. Everything is DataFrame work and Spark ML; no Python on executors.

Defined cases: a null url, or one without ``://``, has empty host and path,
fits no rule and is judged by the model's empty feature vector (allowed, as
blocking needs evidence); of rules of equal length ``block`` wins, then the
smaller rule string; an empty rule table leaves all to the model; an empty
table gives an empty result; a labelled table with one class or none gives a
model that allows everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from seqrisk.llm.common import lower_ascii

# (verdict, host, path)
Rule = tuple[str, str, str]

FEATURES = 1 << 14
GRAMS = (3, 4, 5)
MAX_LABELLED = 4_000


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to / ? # or the end,
    A-Z lower-cased; path from there up to ? or #."""
    cut = F.instr(url, "://")
    rest = F.when(cut > 0, url.substr(cut + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark, rules: Sequence[Rule]) -> DataFrame:
    return spark.createDataFrame([(h + p, v, h, p) for v, h, p in rules],
                                 "rule string, rule_verdict string, rule_host string, rule_path string")


def apply_rules(urls: DataFrame, rules: DataFrame, key: str = "row") -> DataFrame:
    """(key, rule, rule_verdict) of the longest rule for each row of ``urls``
    (columns key, host, path) that any rule fits. Each host is expanded into
    its parent domains and met with the rules by equality, so the rule table
    may be of any size."""
    labels = F.split("host", r"\.")
    parents = urls.select(key, "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))).alias("rule_host"))
    hits = parents.where("rule_host <> ''").join(rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
    rank = F.struct(F.length("rule"), F.col("rule_verdict") == "block")
    best = F.struct(rank.alias("rank"), F.hash("rule").alias("h"), "rule", "rule_verdict")
    return hits.groupBy(key).agg(F.max(best).alias("b")).select(key, "b.rule", "b.rule_verdict")


def fixed_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) for a short rule list, as one expression without a join:
    rules sorted by length, the longest that fits first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, n: int, mark: str) -> Column:
    count = F.length(text) - F.lit(n - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))),
                                         lambda i: F.concat(F.lit(mark), F.substring(text, i, F.lit(n))))).otherwise(
        F.array().cast("array<string>"))


def url_grams(host: Column, path: Column) -> Column:
    """Character n-grams of the host (between marks at both ends) and of the path."""
    h = F.when(host == "", host).otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    return F.array_distinct(F.concat(*[_grams(h, n, "h") for n in GRAMS],
                                     *[_grams(path, n, "p") for n in GRAMS]))


def _featurise(df: DataFrame, features: int) -> DataFrame:
    tf = HashingTF(inputCol="__grams", outputCol="__features", numFeatures=features, binary=True)
    return tf.transform(df.withColumn("__grams", url_grams(F.col("host"), F.col("path"))))


def fit_urls(labelled: DataFrame, features: int = FEATURES, reg: float = 1e-3,
             max_rows: int = MAX_LABELLED) -> LogisticRegressionModel | None:
    """Fit on ``labelled`` (url, label 0 or 1). The table is meant to be small:
    at most ``max_rows`` different rows are used, those of the smallest url hash."""
    host, path = split_url(F.col("url"))
    bounded = (labelled.where("url is not null and label in (0, 1)").select("url", F.col("label").cast("double")).distinct()
               .orderBy(F.xxhash64("url"), "url", "label").limit(max_rows))
    train = _featurise(bounded.withColumns({"host": host, "path": path}), features).select("__features", "label")
    if train.select("label").distinct().count() < 2:
        return None
    return LogisticRegression(featuresCol="__features", labelCol="label", regParam=reg, maxIter=60,
                              probabilityCol="__p", rawPredictionCol="__raw", predictionCol="__pred").fit(train)


def judge_urls(pages: DataFrame, model: LogisticRegressionModel | None, rules: Sequence[Rule] | DataFrame = (),
               url_col: str = "url", features: int = FEATURES, threshold: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score (existing
    columns of those names are replaced)."""
    host, path = split_url(F.col(f"`{url_col}`"))
    made = ("host", "path", "rule", "verdict", "block_score")
    rows = pages.drop(*made).withColumns({"host": host, "path": path})
    if isinstance(rules, DataFrame):
        urls = rows.select("host", "path").distinct().withColumn("row", F.struct("host", "path"))
        best = apply_rules(urls, rules).select("row.host", "row.path", "rule", "rule_verdict")
        rows = rows.join(best, ["host", "path"], "left")
    else:
        rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
        rows = rows.withColumns({"rule": rule, "rule_verdict": verdict})
    if model is None:
        scored = rows.withColumn("block_score", F.lit(0.0))
    else:
        scored = model.transform(_featurise(rows, features)).withColumn(
            "block_score", F.when(F.size("__grams") == 0, F.lit(0.0)).otherwise(vector_to_array("__p")[1]))
    own = F.when(F.col("block_score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    cols = [c for c in pages.columns if c not in made]
    return scored.select(*[f"`{c}`" for c in cols], "host", "path", "rule",
                         F.coalesce("rule_verdict", own).alias("verdict"), "block_score")
