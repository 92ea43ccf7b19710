"""Model-quality aggregations (E1-E12) over a (label, score) frame.

Everything derives from one per-distinct-score table with inclusive running
counts in descending score order (``curve_counts``): the running counts come
from range-partitioned running sums, so no step sees all scores in one task.
AUC and average precision need no lag: the trapezoid for a score s is
neg_s * (tps_s - pos_s / 2) / (P * N), and the precision-recall step is
pos_s / P * precision_s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqrisk.config import AUC_GATE, CALIBRATION_BINS
from seqrisk.operators.ranking import running_sums

INF = float("inf")


def curve_counts(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, pos, neg, tps, fps, P, N) per distinct score that is neither
    null nor NaN; tps/fps count rows with score >= threshold. The per-score
    table is written once (by the running sums); P and N are its last totals."""
    s = F.col(score).cast("double")
    agg = (df.where(s.isNotNull() & ~F.isnan(s) & F.col(y).isNotNull())
           .groupBy(F.col(score).cast("double").alias("threshold"))
           .agg(F.sum(F.col(y).cast("long")).alias("pos"),
                F.sum((1 - F.col(y)).cast("long")).alias("neg")))
    cur = running_sums(agg, [F.col("threshold").desc()], {"tps": F.col("pos"), "fps": F.col("neg")})
    total = cur.agg(F.struct(F.max("tps").alias("P"), F.max("fps").alias("N")).alias("t")).scalar()
    return cur.withColumns({"P": total.getField("P"), "N": total.getField("N")})


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def roc_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr, tps, fps) for every distinct score plus the
    starting point (inf, 0, 0). Collinear points are kept."""
    c = curve_counts(df, y, score)
    pts = c.select("threshold", _ratio(F.col("fps"), F.col("N")).alias("fpr"),
                   _ratio(F.col("tps"), F.col("P")).alias("tpr"), "tps", "fps")
    start = _const_row(c, threshold=F.lit(INF), fpr=F.lit(0.0), tpr=F.lit(0.0),
                       tps=F.lit(0).cast("long"), fps=F.lit(0).cast("long"))
    return start.unionByName(pts)


def roc_auc(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Area under the ROC curve (trapezoids; ties count half); null when
    a class is missing."""
    c = curve_counts(df, y, score)
    return c.agg(_auc_expr().alias("auc"))


def _auc_expr() -> Column:
    return _ratio(F.sum(F.col("neg") * (F.col("tps") - F.col("pos") / 2.0)),
                  F.first("P").cast("double") * F.first("N"))


def _ap_expr() -> Column:
    prec = F.col("tps") / (F.col("tps") + F.col("fps"))
    return _ratio(F.sum(F.col("pos") * prec), F.first("P").cast("double"))


def pr_curve(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) for every distinct score, plus the
    end point (null, 1, 0). Recall is 1 everywhere when there are no
    positives."""
    c = curve_counts(df, y, score)
    pts = c.select("threshold",
                   F.coalesce(_ratio(F.col("tps"), F.col("tps") + F.col("fps")), F.lit(0.0)).alias("precision"),
                   F.coalesce(_ratio(F.col("tps"), F.col("P")), F.lit(1.0)).alias("recall"))
    end = _const_row(c, threshold=F.lit(None).cast("double"), precision=F.lit(1.0), recall=F.lit(0.0))
    return pts.unionByName(end)


def average_precision(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """Sum over thresholds of (R_n - R_{n-1}) * P_n (no interpolation)."""
    return curve_counts(df, y, score).agg(_ap_expr().alias("avg_precision"))


def _youden_struct(c: DataFrame) -> Column:
    """max_by over (J, threshold): the first (highest) threshold on ties; the
    start point (inf, J = 0) wins when no threshold beats it."""
    j = F.coalesce(_ratio(F.col("tps"), F.col("P")), F.lit(0.0)) - \
        F.coalesce(_ratio(F.col("fps"), F.col("N")), F.lit(0.0))
    best = F.max(F.struct(j.alias("j"), F.col("threshold").alias("t"), F.col("tps"), F.col("fps")))
    start = F.struct(F.lit(0.0).alias("j"), F.lit(INF).alias("t"), F.lit(0).cast("long").alias("tps"),
                     F.lit(0).cast("long").alias("fps"))
    return F.greatest(best, start)


def _const_row(df: DataFrame, **cols) -> DataFrame:
    """A one-row frame of literals (curve end points)."""
    return df.sparkSession.range(1).select(*[v.alias(k) for k, v in cols.items()])


def youden(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    """E5: threshold maximising tpr - fpr."""
    c = curve_counts(df, y, score)
    return c.agg(_youden_struct(c).alias("b")).select(F.col("b.t").alias("optimal_threshold"),
                                                      F.col("b.j").alias("youden_j"))


def confusion(df: DataFrame, threshold, y: str = "y", score: str = "score") -> DataFrame:
    """(tn, fp, fn, tp) with prediction = score >= threshold; a row whose
    score is null or NaN, or whose label is null, counts nowhere (as in the curves)."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    s = F.col(score).cast("double")
    pred = F.when(~F.isnan(s), s >= t)
    yy = F.col(y) == 1
    return df.agg(F.count_if(~yy & ~pred).alias("tn"), F.count_if(~yy & pred).alias("fp"),
                  F.count_if(yy & ~pred).alias("fn"), F.count_if(yy & pred).alias("tp"))


def rates(cm: DataFrame) -> DataFrame:
    """Sensitivity, specificity, precision, F1; 0 when a denominator is 0."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    sens = F.coalesce(_ratio(tp, tp + fn), F.lit(0.0))
    spec = F.coalesce(_ratio(tn, tn + fp), F.lit(0.0))
    prec = F.coalesce(_ratio(tp, tp + fp), F.lit(0.0))
    d = cm.withColumns({"sensitivity": sens, "specificity": spec, "precision": prec})
    f1 = F.coalesce(_ratio(2 * F.col("precision") * F.col("sensitivity"),
                           F.col("precision") + F.col("sensitivity")), F.lit(0.0))
    return d.withColumn("f1_score", f1)


def metrics_row(df: DataFrame, y: str = "y", score: str = "score", dataset: str = "eval") -> DataFrame:
    """One row (dataset, auc, avg_precision, optimal_threshold,
    sensitivity, specificity, precision, f1_score, tp, fp, tn, fn); the
    confusion counts at the Youden threshold are read off the same curve."""
    c = curve_counts(df, y, score)
    row = c.agg(_auc_expr().alias("auc"), _ap_expr().alias("avg_precision"),
                _youden_struct(c).alias("b"), F.first("P").alias("P"), F.first("N").alias("N"))
    cm = row.select(F.lit(dataset).alias("dataset"), "auc", "avg_precision",
                    F.col("b.t").alias("optimal_threshold"),
                    F.col("b.tps").alias("tp"), F.col("b.fps").alias("fp"),
                    (F.col("N") - F.col("b.fps")).alias("tn"), (F.col("P") - F.col("b.tps")).alias("fn"))
    return rates(cm)


def calibration(df: DataFrame, y: str = "y", score: str = "score", bins: int = CALIBRATION_BINS
                ) -> DataFrame:
    """Uniform bins over [0, 1], right-closed (lo, hi] with 0 in the
    first bin; per non-empty bin: mean score, positive fraction, count. Null and
    NaN scores are in no bin."""
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    p = F.col(score).cast("double")
    b = sum((F.when(p > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return (df.where(p.isNotNull() & ~F.isnan(p)).groupBy(b.alias("bin"))
            .agg(F.avg(p).alias("prob_pred"), F.avg(F.col(y).cast("double")).alias("prob_true"),
                 F.count(F.lit(1)).alias("n")))


def base_rate(df: DataFrame, y: str = "y") -> DataFrame:
    """Share of positives (the no-skill line)."""
    return df.agg(F.avg(F.col(y).cast("double")).alias("base_rate"))


def latest_metric(metrics: DataFrame, dataset: str, name: str, default: float,
                  run: str = "run_ts") -> DataFrame:
    """The value of ``name`` in the latest run for ``dataset``, or
    ``default`` when there is none. One row. Runs of the same time are ordered by
    their ``run_id`` where the table has one, then by the value, so the order of
    the rows never decides."""
    m = metrics.where(F.col("dataset") == dataset)
    order = F.struct(run, *(["run_id"] if "run_id" in metrics.columns else []), name)
    return m.agg(F.coalesce(F.max_by(F.col(name), order), F.lit(float(default))).alias(name))


def quality_gate(metrics: DataFrame, dataset: str = "holdout", name: str = "auc",
                 minimum: float = AUC_GATE, default: float | None = None, run: str = "run_ts") -> DataFrame:
    """(value, minimum, passed) for the latest run of ``dataset``."""
    v = latest_metric(metrics, dataset, name, default if default is not None else float("nan"), run)
    return v.select(F.col(name).alias("value"), F.lit(float(minimum)).alias("minimum"),
                    (F.col(name) >= F.lit(float(minimum))).alias("passed"))
