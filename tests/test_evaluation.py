"""E1-E12 against brute force."""

import math
import random

from pyspark.sql import functions as F

from seqrisk.operators import evaluation as E
from seqrisk.operators.model import balanced_weights, cv_summary


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def data(spark, n=300, seed=5):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "y int, score double")


def test_auc_ap_youden(spark):
    rows, df = data(spark)
    auc = E.roc_auc(df).first().auc
    assert abs(auc - brute_auc(rows)) < 1e-12
    mono = df.withColumn("score", F.col("score") * 3 + 1)
    assert abs(E.roc_auc(mono).first().auc - auc) < 1e-12
    # average precision = sum over distinct thresholds of (dR) * P
    P = sum(y for y, _ in rows)
    ap = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        dp = sum(1 for y, s in rows if s == t and y == 1)
        ap += dp / P * tp / (tp + fp)
    assert abs(E.average_precision(df).first().avg_precision - ap) < 1e-12
    best = max(((sum(1 for y, s in rows if s >= t and y == 1) / P -
                 sum(1 for y, s in rows if s >= t and y == 0) / (len(rows) - P)), t)
               for t in {s for _, s in rows})
    yd = E.youden(df).first()
    assert abs(yd.youden_j - best[0]) < 1e-12 and yd.optimal_threshold == best[1]
    m = E.metrics_row(df).first()
    cm = E.confusion(df, m.optimal_threshold).first()
    assert (m.tp, m.fp, m.tn, m.fn) == (cm.tp, cm.fp, cm.tn, cm.fn)
    roc = E.roc_curve(df).collect()
    assert len(roc) == len({s for _, s in rows}) + 1 and any(math.isinf(r.threshold) for r in roc)


def test_degenerate_cases(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, score double")
    assert E.roc_auc(df).first().auc is None
    assert math.isinf(E.youden(spark.createDataFrame([(0, 0.9), (1, 0.1)], "y int, score double"))
                      .first().optimal_threshold)
    r = E.rates(spark.createDataFrame([(0, 0, 5, 0)], "tp long, fp long, tn long, fn long")).first()
    assert (r.sensitivity, r.precision, r.f1_score, r.specificity) == (0.0, 0.0, 0.0, 1.0)


def test_calibration_bins(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (1, 0.1000001), (0, 0.3), (1, 1.0)], "y int, score double")
    got = {r.bin: r.n for r in E.calibration(df).collect()}
    assert got == {0: 2, 1: 1, 2: 1, 9: 1}


def test_class_weights_and_cv_mean(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (0,), (1,), (1,)], "y int")
    w = {r.y: r for r in balanced_weights(df, "y").collect()}
    assert w[1].scale_pos_weight == 2.0 and abs(w[0].weight - 0.75) < 1e-12 and abs(w[1].weight - 1.5) < 1e-12
    folds = spark.createDataFrame([(i, a) for i, a in enumerate([0.80, 0.85, 0.82, 0.79, 0.83])], "fold int, auc double")
    assert abs(cv_summary(folds).first().mean_auc - 0.818) < 1e-12


def test_metric_lookup_and_gate(spark):
    m = spark.createDataFrame([(1, "holdout", 0.7), (2, "holdout", 0.85), (3, "test", 0.1)],
                              "run_ts int, dataset string, auc double")
    assert E.latest_metric(m, "holdout", "auc", 0.81).first().auc == 0.85
    assert E.latest_metric(m, "none", "auc", 0.81).first().auc == 0.81
    assert E.quality_gate(m, "holdout").first().passed
