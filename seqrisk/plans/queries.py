"""Registered queries: one per operator family of the inventory.

Each takes (spark, sf_dir) and returns a DataFrame over the given tables;
column names match the oracle SQL in ``seqrisk.plans.oracle``. Doubles are
rounded to 6 places and timestamps handed over as epoch microseconds so the
two engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqrisk.config import API_DEFAULTS, INTERACTIONS, FeatureRoles, Roles
from seqrisk.functions.expr import (bool_to_int, contains_flag, decide, epoch_micros, normalize_name,
                                    parse_session_key, session_key)
from seqrisk.operators.reports import (count_by, flagged_laps, lap_risk, null_fraction, preview, race_list, race_rows,
                                       race_summary, shape, value_share)
from seqrisk.plans.jobs import (boosted_job, decided, deployed_scores, profile_report, race_report, report_rows, season_job, train_job,
                                transform_job, tuned_threshold)
from seqrisk.plans.scratch import scratch_dir
from seqrisk.sources.files import (file_manifest, load_dataframe, pending_in_folder, pending_sessions, read_session_files, read_sessions, tag_session,
                                   union_by_name, unreadable_files, write_session_files, write_sessions)
from seqrisk.streaming.requests import score_body_stream, score_stream
from seqrisk.operators.enrich import (add_seconds_columns, add_track, clean, fill_constant,
                                     fill_group_median, valid_laps)
from seqrisk.operators.features import (add_interactions, feature_inputs, fit_features, one_hot_rows,
                                        stats_table, transform_features, vocab_table)
from seqrisk.operators.scoring import linear_scorer, score_bodies, score_requests
from seqrisk.operators.evaluation import (average_precision, base_rate, calibration, confusion,
                                         latest_metric, metrics_row, pr_curve, quality_gate, rates,
                                         roc_auc, roc_curve, youden)
from seqrisk.operators.ledger import commit_run, read_ledger, run_key
from seqrisk.operators.label import attach_labels, label_stats, onset_label, onset_steps
from seqrisk.operators.model import (ModelScorer, balanced_weights, cross_validate, lap_attribution,
                                     linear_attribution, load_model, mean_abs_attribution, save_model, score,
                                     train_classifier)
from seqrisk.operators.unit import as_unit, load_unit, save_unit, score_unit
from seqrisk.operators.attribution import attribute, base_value
from seqrisk.operators.boosting import BoostParams, cross_validate_boosted, fit_boosted, fold_auc, load_boosted
from seqrisk.operators.split import (prefix_split, seeded_sample, split_by_group, split_labels,
                                     stratified_folds, year_holdout)
from seqrisk.operators.temporal import asof_join, flag_intervals, interval_end, interval_flag_table
from seqrisk.operators.timeline import TimelineRoles, step_features, store_timeline
from seqrisk.plans import fixtures as fx
from seqrisk.session import cut_lineage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

FLAG_COLS = ["YellowFlag", "SafetyCar", "RedFlag", "VirtualSafetyCar"]


def query(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ------------------------------------------------------------ temporal (F-A)
def fa_intervals(spark, d) -> DataFrame:
    return interval_end(fx.fa_laps(spark, d), "race", "driver", "lap", "start", "lap_time_s",
                        out="interval_end").drop("props")


def fa_flagged(spark, d) -> DataFrame:
    return flag_intervals(cut_lineage(fa_intervals(spark, d)), fx.fa_status(spark, d), "race", "driver", "lap",
                          "start", "interval_end", "race", "time", "status")


@query("interval_end")
def q_interval_end(spark, d):
    """J1 on F-A."""
    return fa_intervals(spark, d).select("event_id", "race", "driver", "lap",
                                         epoch_micros("interval_end").alias("end_us"))


@query("status_flags")
def q_status_flags(spark, d):
    """J2 on F-A."""
    return fa_flagged(spark, d).select("event_id", "race", "driver", "lap", *FLAG_COLS)


@query("interval_onset")
def q_interval_onset(spark, d):
    """Flagship: J1 + J2 + A3 + A4 on F-A: label each lap with whether a
    safety-car status starts in the next lap of the same race."""
    laps = cut_lineage(fa_intervals(spark, d))      # feeds the points, the steps and the rows
    # The narrow per-lap-key flag table feeds both the labels and the rows.
    table = cut_lineage(interval_flag_table(laps, fx.fa_status(spark, d), "race", "driver", "lap", "start",
                                            "interval_end", "race", "time", "status"))
    # Every step that has rows (a lap whose rows all lack a start has no
    # table entry but still counts as a step without the flag).
    flagged_steps = table.groupBy("race", "lap").agg(F.max("SafetyCar").alias("__f"))
    steps = (laps.where(F.col("race").isNotNull() & F.col("lap").isNotNull()).select("race", "lap").distinct()
             .join(flagged_steps, ["race", "lap"], "left")
             .select("race", "lap", F.coalesce(F.col("__f"), F.lit(False)).alias("__cur")))
    labels = onset_steps(steps, "race", "lap", "__cur")
    rows = laps.join(table, ["race", "driver", "lap"], "left")
    rows = rows.select(*laps.columns, *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in FLAG_COLS])
    lab = attach_labels(rows, labels, "race", "lap", "sc_next_lap")
    return lab.select("event_id", "race", "driver", "lap", *FLAG_COLS, "sc_next_lap")


@query("asof_weather")
def q_asof_weather(spark, d):
    """J3 on F-A: latest weather sample at or before each lap start."""
    j = asof_join(fx.fa_laps(spark, d), fx.fa_weather(spark, d).drop("event_id"),
                  "race", "start", "race", "time", ["air_temp", "humidity"])
    return j.select("event_id", "race", "driver", "lap", r6("air_temp").alias("air_temp"),
                    r6("humidity").alias("humidity"))


def fa_timeline(spark, d, **bounds):
    """F-A's laps, status changes and weather as a stored timeline."""
    roles = TimelineRoles("race", "driver", "lap", "start", "time", "status", "lap_time_s")
    return store_timeline(cut_lineage(fx.fa_laps(spark, d).drop("props")), fx.fa_status(spark, d), fx.fa_weather(spark, d), roles,
                          scratch_dir(spark, "timeline"), ["air_temp", "humidity"], **bounds)


@query("stored_timeline")
def q_stored_timeline(spark, d):
    """J1 + J2 + J3 + A3 + A4 on F-A from a table bucketed by race, without an exchange."""
    j = step_features(spark, fa_timeline(spark, d), label_flag="SafetyCar")
    return j.select("event_id", "race", "driver", "lap", epoch_micros("interval_end").alias("end_us"), *FLAG_COLS,
                    r6("air_temp").alias("air_temp"), r6("humidity").alias("humidity"), "sc_next_lap")


# ------------------------------------------------------- labels, splits (F-B)
@query("onset_label")
def q_onset_label(spark, d):
    """A3 + A4 + J7 on F-B: label by (RaceId, LapNumber) from SafetyCar."""
    lab = onset_label(fx.fb_laps(spark, d), "RaceId", "LapNumber", "SafetyCar", "sc_next_lap")
    return lab.select("l_orderkey", "l_linenumber", "RaceId", "LapNumber", "Driver", "sc_next_lap")


@query("label_stats")
def q_label_stats(spark, d):
    """A5 on the F-B onset labels."""
    lab = onset_label(fx.fb_laps(spark, d), "RaceId", "LapNumber", "SafetyCar", "sc_next_lap")
    return label_stats(lab, "sc_next_lap").select("positives", "total", r6("positive_pct").alias("positive_pct"))


def _parts(frames, key, names=("train", "test", "holdout")):
    out = None
    for name, f in zip(names, frames):
        g = f.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("part", F.lit(name))
        out = g if out is None else out.unionByName(g)
    return out


@query("year_holdout")
def q_year_holdout(spark, d):
    """P1 + T1 on F-B: holdout = races of 2001 by the year in the key."""
    hold, rest = year_holdout(fx.fb_laps(spark, d), "RaceId", [2001])
    return _parts([rest, hold], "RaceId", ("rest", "holdout"))


@query("group_split")
def q_group_split(spark, d):
    """T2 + J5 + U2 + U3 on F-B: whole races to train / test / holdout."""
    return _parts(split_by_group(fx.fb_laps(spark, d), "RaceId", 0.2, [2001], 42), "RaceId")


@query("fallback_split")
def q_fallback_split(spark, d):
    """T3 on F-B: 70/20/10 of races in seeded hash order."""
    lab = split_labels(fx.fb_laps(spark, d), "RaceId", (0.7, 0.2, 0.1), 42)
    return lab.groupBy("RaceId", F.col("split").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("fallback_split_nulls")
def q_fallback_split_nulls(spark, d):
    """T3 on F-B by Compound, which is null in some rows: the null group is a
    group, and the parts add up to all rows."""
    lab = split_labels(fx.fb_laps(spark, d), "Compound", (0.5, 0.25, 0.25), 42)
    return lab.groupBy("Compound", F.col("split").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("fallback_split_rows")
def q_fallback_split_rows(spark, d):
    """T3, row branch, on F-C: 70/20/10 of the rows in seeded hash order of a
    key with nulls."""
    s = fc_null_key(spark, d).withColumn("one", F.lit("only"))
    return split_labels(s, "one", (0.7, 0.2, 0.1), 42, row_key=["half", "doc_id"]).select("doc_id", F.col("split").alias("part"))


def fc_null_key(spark, d):
    return fx.fc_scores(spark, d).withColumn("half", F.when(F.col("doc_id") % 3 != 0, F.col("doc_id") % 7))


@query("stratified_folds_nulls")
def q_stratified_folds_nulls(spark, d):
    """T4 on F-C with a key column that is null in a third of the rows."""
    return stratified_folds(fc_null_key(spark, d), "y", ["half", "doc_id"], 5, 42).select("doc_id", "y", "fold")


@query("prefix_split_ties")
def q_prefix_split_ties(spark, d):
    """T5 on F-C by a column with ties, broken by doc_id."""
    head, tail = prefix_split(fx.fc_scores(spark, d).withColumn("o", F.col("doc_id") % 5), "o", 0.8, tie=["doc_id"])
    return head.select("doc_id", F.lit("train").alias("part")).unionByName(tail.select("doc_id", F.lit("test").alias("part")))


@query("stratified_folds")
def q_stratified_folds(spark, d):
    """T4 on F-C: 5 folds, stratified by y, seeded hash order of doc_id."""
    return stratified_folds(fx.fc_scores(spark, d), "y", ["doc_id"], 5, 42).select("doc_id", "y", "fold")


@query("prefix_split")
def q_prefix_split(spark, d):
    """T5 on F-C: the first 80% of rows by doc_id."""
    head, tail = prefix_split(fx.fc_scores(spark, d), "doc_id", 0.8)
    return head.select("doc_id", F.lit("train").alias("part")).unionByName(
        tail.select("doc_id", F.lit("test").alias("part")))


@query("seeded_sample")
def q_seeded_sample(spark, d):
    """T6 on F-A laps: exactly 500 rows in seeded hash order of event_id."""
    return seeded_sample(fx.fa_laps(spark, d), 500, ["event_id"], 42).select("event_id", "race", "lap")


# ------------------------------------------------------------ metrics (F-C)
def fc(spark, d):
    return fx.fc_scores(spark, d)


@query("class_weights")
def q_class_weights(spark, d):
    """A6 on F-C."""
    return balanced_weights(fc(spark, d), "y").select(
        "y", "n", r6("weight").alias("weight"), r6("scale_pos_weight").alias("scale_pos_weight"))


@query("roc_curve")
def q_roc_curve(spark, d):
    c = roc_curve(fc(spark, d))
    return c.select(r6("threshold").alias("threshold"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"),
                    "tps", "fps")


@query("roc_auc")
def q_roc_auc(spark, d):
    return roc_auc(fc(spark, d)).select(r6("auc").alias("auc"))


@query("pr_curve")
def q_pr_curve(spark, d):
    c = pr_curve(fc(spark, d))
    return c.select(r6("threshold").alias("threshold"), r6("precision").alias("precision"),
                    r6("recall").alias("recall"))


@query("avg_precision")
def q_avg_precision(spark, d):
    return average_precision(fc(spark, d)).select(r6("avg_precision").alias("avg_precision"))


@query("youden")
def q_youden(spark, d):
    return youden(fc(spark, d)).select(r6("optimal_threshold").alias("optimal_threshold"),
                                       r6("youden_j").alias("youden_j"))


@query("confusion")
def q_confusion(spark, d):
    """E6 + E7 at the Youden threshold."""
    s = fc(spark, d)
    t = youden(s).select("optimal_threshold").scalar()
    return rates(confusion(s, t)).select("tn", "fp", "fn", "tp", *[r6(c).alias(c) for c in
                                         ("sensitivity", "specificity", "precision", "f1_score")])


METRIC_COLS = ["auc", "avg_precision", "optimal_threshold", "sensitivity", "specificity", "precision",
               "f1_score"]


@query("metrics_row")
def q_metrics_row(spark, d):
    m = metrics_row(fc(spark, d), dataset="test")
    return m.select("dataset", *[r6(c).alias(c) for c in METRIC_COLS], "tp", "fp", "tn", "fn")


@query("calibration")
def q_calibration(spark, d):
    return calibration(fc(spark, d)).select("bin", r6("prob_pred").alias("prob_pred"),
                                            r6("prob_true").alias("prob_true"), "n")


@query("base_rate")
def q_base_rate(spark, d):
    return base_rate(fc(spark, d)).select(r6("base_rate").alias("base_rate"))


def _metrics_table(spark, d):
    """Metrics of two runs over all scored labels, the older one on a coarser score."""
    s = fc(spark, d)
    coarse = s.withColumn("score", F.round("score", 1))
    runs = [(1, "test", coarse), (1, "holdout", coarse), (2, "holdout", s)]
    out = None
    for run, name, part in runs:
        m = metrics_row(part, dataset=name).withColumn("run_ts", F.lit(run))
        out = m if out is None else out.unionByName(m)
    return out


@query("metric_lookup")
def q_metric_lookup(spark, d):
    """Latest holdout AUC / threshold, and the defaults for a dataset
    without runs."""
    m = _metrics_table(spark, d)
    rows = []
    for ds in ("holdout", "missing"):
        a = latest_metric(m, ds, "auc", 0.81)
        t = latest_metric(m, ds, "optimal_threshold", 0.5)
        rows.append(a.select(F.lit(ds).alias("dataset"), r6("auc").alias("auc"),
                             r6(t.select("optimal_threshold").scalar()).alias("optimal_threshold")))
    return rows[0].unionByName(rows[1])


@query("quality_gate")
def q_quality_gate(spark, d):
    """Latest holdout AUC against the 0.80 gate."""
    g = quality_gate(_metrics_table(spark, d), "holdout", "auc", 0.80)
    return g.select(r6("value").alias("value"), "minimum", "passed")


def _ledger(spark, d) -> str:
    """The folder of a ledger of two runs over all scored labels: an older one on a coarser score, and a newer one that
    was committed twice, as a retried job does."""
    s = fc(spark, d)
    path = scratch_dir(spark, "ledger")
    runs = [(1, "score to one place", s.withColumn("score", F.round("score", 1))), (2, "score", s), (2, "score", s)]
    for ts, what, rows in runs:
        commit_run(metrics_row(rows, dataset="holdout"), path, run_key({"scores": rows}, {"what": what}), ts)
    return path


def _two_runs(spark, d) -> DataFrame:
    return read_ledger(spark, _ledger(spark, d))


@query("metrics_ledger")
def q_metrics_ledger(spark, d):
    """The ledger's rows: one per run, in spite of the repeated commit."""
    m = _two_runs(spark, d)
    return m.select("run_ts", "dataset", *[r6(c).alias(c) for c in METRIC_COLS], "tp", "fp", "tn", "fn")


@query("ledger_lookup")
def q_ledger_lookup(spark, d):
    """E11 + E12 over all rows: AUC and threshold of the latest holdout run, its gate, and the defaults where there is no run."""
    m = _two_runs(spark, d)
    rows = []
    for ds in ("holdout", "missing"):
        t = latest_metric(m, ds, "optimal_threshold", 0.5)
        g = quality_gate(m, ds, "auc", 0.80, 0.81)
        rows.append(g.select(F.lit(ds).alias("dataset"), r6("value").alias("auc"), r6(t.select("optimal_threshold").scalar()).alias("optimal_threshold"),
                             "passed"))
    return rows[0].unionByName(rows[1])


# ------------------------------------------------- cleaning / enrich (F-B, F-A)
def fb_clean(spark, d) -> DataFrame:
    """Cleaned F-B (the full cleaning stage): the feature, model and report
    queries all start from it."""
    return clean(fx.fb_laps(spark, d), Roles(), dim=fx.FB_TRACKS)


@query("track_lookup")
def q_track_lookup(spark, d):
    """P8 + J4 on F-B: TrackId from EventName, contains-match against the
    fixture's track dimension (last match wins, defaults otherwise)."""
    t = add_track(fx.fb_laps(spark, d), "EventName", "TrackId", fx.FB_TRACKS)
    return t.select("l_orderkey", "l_linenumber", "EventName", "TrackId", r6("TrackLength").alias("TrackLength"),
                    "TrackType", "Corners")


@query("valid_laps")
def q_valid_laps(spark, d):
    """P6 + P5 on F-B (and P7 as a flag)."""
    v = add_seconds_columns(valid_laps(fx.fb_laps(spark, d)))
    return v.select("l_orderkey", "l_linenumber", "SessionType", r6("LapTime_seconds").alias("LapTime_seconds"),
                    (F.col("SessionType") == "R").alias("is_race"))


@query("two_level_fill")
def q_two_level_fill(spark, d):
    """A2 (inside the full cleaning stage) on F-B."""
    c = fb_clean(spark, d)
    return c.select("l_orderkey", "l_linenumber", "TrackId", r6("SpeedI1").alias("SpeedI1"),
                    r6("SpeedST").alias("SpeedST"), r6("TyreLife").alias("TyreLife"))


@query("null_defaults")
def q_null_defaults(spark, d):
    """P9 + P10 + P13 on F-B."""
    raw = fx.fb_laps(spark, d).withColumn("vsc_int", bool_to_int("VirtualSafetyCar"))
    f = fill_constant(fill_constant(raw, False, ["VirtualSafetyCar", "FreshTyre"]), "Unknown", ["Compound"])
    return f.select("l_orderkey", "l_linenumber", "Compound", "VirtualSafetyCar", "vsc_int")


@query("race_median_fill")
def q_race_median_fill(spark, d):
    """J3 then A1 on F-A: weather at lap start, nulls filled with the race median."""
    j = asof_join(fx.fa_laps(spark, d), fx.fa_weather(spark, d).drop("event_id"),
                  "race", "start", "race", "time", ["air_temp", "humidity"])
    f = fill_group_median(j, ["air_temp", "humidity"], "race")
    return f.select("event_id", "race", "lap", r6("air_temp").alias("air_temp"), r6("humidity").alias("humidity"))


# ------------------------------------------------------------ features (F-B)
FB_ROLES = FeatureRoles(categorical=("Driver", "Team", "Compound"),
                        numeric=("TrackLength", "Corners", "LapNumber", "Position", "TyreLife", "SpeedI1",
                                 "SpeedST", "AirTemp", "Rainfall", "TrackTemp"),
                        boolean=("FreshTyre", "VirtualSafetyCar", "YellowFlag"))
WIDE_ROLES = replace(FB_ROLES, categorical=("Team", "Compound"))      # one output column per category


def fb_train(spark, d):
    return fb_clean(spark, d).where(F.col("Year") < 2001)


def fb_parts(spark, d):
    """(train, holdout) of one cleaning stage, written once."""
    c = cut_lineage(fb_clean(spark, d))
    return c.where(F.col("Year") < 2001), c.where(F.col("Year") == 2001)


@query("interactions")
def q_interactions(spark, d):
    """P11 on cleaned F-B."""
    x = add_interactions(fb_clean(spark, d), INTERACTIONS)
    return x.select("l_orderkey", "l_linenumber",
                    *[r6(f"{a}_{b}_interaction").alias(f"{a}_{b}_interaction") for a, b in INTERACTIONS])


@query("fit_stats")
def q_fit_stats(spark, d):
    """Exact median, then mean and population std of the imputed column,
    per numeric feature, fitted on the training rows."""
    tr = add_interactions(fb_train(spark, d).select(*FB_ROLES.numeric), INTERACTIONS)
    _, num, _ = feature_inputs(tr, FB_ROLES)
    return stats_table(tr, num).select("feature", r6("median").alias("median"), r6("mean").alias("mean"), r6("std").alias("std"))


@query("vocab")
def q_vocab(spark, d):
    """Sorted categories (null -> 'unknown') of the training rows."""
    tr = fb_train(spark, d)
    return vocab_table(tr, list(FB_ROLES.categorical))


@query("one_hot_sparse")
def q_one_hot_sparse(spark, d):
    """M2, sparse, with Driver: the set positions of the holdout rows."""
    cols = list(FB_ROLES.categorical)
    train, holdout = fb_parts(spark, d)
    return one_hot_rows(holdout, vocab_table(train, cols), cols, ["l_orderkey", "l_linenumber"])


@query("scaled_features")
def q_scaled_features(spark, d):
    """M1: parameters fitted on train, applied to the holdout rows (numeric
    and boolean outputs)."""
    train, holdout = fb_parts(spark, d)
    fp = fit_features(train, FB_ROLES, wide=False)
    t = transform_features(holdout, fp, FB_ROLES)
    cols = list(fp.numeric) + list(fp.boolean)
    return t.select("l_orderkey", "l_linenumber", *[r6(c).alias(c) for c in cols])


@query("one_hot")
def q_one_hot(spark, d):
    """M2: one-hot columns named Col_category on the holdout rows."""
    train, holdout = fb_parts(spark, d)
    fp = fit_features(train, WIDE_ROLES)
    t = transform_features(holdout, fp, WIDE_ROLES)
    cols = [f"{c}_{v}" for c, vs in fp.categorical.items() for v in vs]
    return t.select("l_orderkey", "l_linenumber", *cols)


@query("passthrough")
def q_passthrough(spark, d):
    """The non-feature columns pass through the transform unchanged."""
    train, holdout = fb_parts(spark, d)
    fp = fit_features(train, WIDE_ROLES)
    t = transform_features(holdout, fp, WIDE_ROLES)
    keep = ["l_orderkey", "l_linenumber", "RaceId", "Driver", "EventName", "SessionType", "TrackId",
            "TrackType", "SafetyCar"]
    return t.select(*keep, r6("LapTime_seconds").alias("LapTime_seconds"))


# --------------------------------------------------------------- model (F-B)
LINEAR = {"TyreLife": 0.01, "TrackTemp": 0.05, "LapNumber": 0.02, "SpeedST": 0.00002, "Position": -0.1}
LINEAR_B0 = -2.0


@query("gbt_scores")
def q_gbt_scores(spark, d):
    """M3 + M6 (+A6): class-weighted GBT trained on train rows (few trees, as an
    argument), scoring the holdout. Returns each row's checks: a probability
    within 0 and 1, and a decision that follows from it and the threshold."""
    train, holdout = fb_parts(spark, d)
    tr = onset_label(train, "RaceId", "LapNumber", "SafetyCar")
    m, fp = train_classifier(tr, "sc_next_lap", FB_ROLES, {"maxIter": 5, "maxDepth": 3})
    return _checked(score(holdout, m, fp, 0.5, FB_ROLES), ["l_orderkey", "l_linenumber", "RaceId", "LapNumber"])


def _checked(s, ids, p="sc_probability", decision="sc_prediction"):
    ok = F.col(p).between(0.0, 1.0) & (F.col(decision).cast("int") == (F.col(p) >= F.col("threshold")).cast("int"))
    return s.select(*ids, ok.alias("consistent"))


@query("model_round_trip")
def q_model_round_trip(spark, d):
    """M5: a saved and reloaded model gives every holdout row the same score."""
    train, holdout = fb_parts(spark, d)
    tr = onset_label(train, "RaceId", "LapNumber", "SafetyCar")
    m, fp = train_classifier(tr, "sc_next_lap", FB_ROLES, {"maxIter": 3, "maxDepth": 3})
    path = scratch_dir(spark, "model")
    save_model(m, fp, path)
    m2, fp2 = load_model(path)
    one = score(holdout, m, fp, 0.5, FB_ROLES)
    both = score(one.drop("sc_prediction", "threshold").withColumnRenamed("sc_probability", "p1"), m2, fp2, 0.5, FB_ROLES)
    return both.select("l_orderkey", "l_linenumber", (F.col("p1") == F.col("sc_probability")).alias("same"))


@query("model_unit")
def q_model_unit(spark, d):
    """M5 + M6 as one pipeline: what its reloaded feature stage makes of the holdout rows, and
    whether its probability is that of the model that was saved."""
    train, holdout = fb_parts(spark, d)
    m, fp = train_classifier(onset_label(train, "RaceId", "LapNumber", "SafetyCar"), "sc_next_lap", FB_ROLES, {"maxIter": 3, "maxDepth": 3})
    path = scratch_dir(spark, "unit")
    save_unit(as_unit(m, fp, FB_ROLES), path)
    scored = score_unit(score(holdout, m, fp, 0.5, FB_ROLES).withColumnRenamed("sc_probability", "p1"), load_unit(path), "p2")
    made = load_unit(path).stages[0].transform(scored)
    return made.select("l_orderkey", "l_linenumber", *[r6(f"__f_{c}").alias(c) for c in [*fp.numeric, *fp.boolean]],
                       F.col("p1").eqNullSafe(F.col("p2")).alias("same"))


@query("model_requests")
def q_model_requests(spark, d):
    """M7 with a trained model: the F-A requests scored by a (model, parameters)
    pair at the tuned threshold that the metrics table holds (E11). Each valid
    request has a consistent score, each invalid one none."""
    out = fm_transform(spark, d)
    metrics = scratch_dir(spark, "metrics")
    job = train_job(spark, out["train"], out["test"], out["holdout"], FeatureRoles(), params={"maxIter": 3, "maxDepth": 3},
                    folds=0, metrics_path=metrics)
    t = tuned_threshold(load_dataframe(spark, metrics))
    r = score_requests(fx.fa_requests(spark, d), ModelScorer(job["model"], job["features"]), t, keep=["event_id"])
    ok = F.col("probability").between(0.0, 1.0) & (F.col("will_deploy_sc") == (F.col("probability") >= F.col("threshold")))
    return r.select("event_id", F.col("probability").isNotNull().alias("scored"), F.coalesce(ok, F.col("error").isNotNull()).alias("consistent"))


@query("cv_auc")
def q_cv_auc(spark, d):
    """M4 (+T4): 5-fold stratified CV of a GBT (few trees, as an argument): rows
    and positives of each fold, and whether its AUC is one."""
    tr = onset_label(fb_train(spark, d), "RaceId", "LapNumber", "SafetyCar")
    folds = cross_validate(tr, "sc_next_lap", ["l_orderkey", "l_linenumber", "Driver"], 5, FB_ROLES,
                           {"maxIter": 2, "maxDepth": 2})
    return folds.select("fold", "rows", "positives", F.coalesce(F.col("auc").between(0.0, 1.0), F.lit(True)).alias("auc_ok"))


BOOST_ROLES = FeatureRoles(categorical=("Driver", "Team", "Compound"),
                           numeric=("TrackLength", "Corners", "LapNumber", "Position", "TyreLife", "AirTemp", "Rainfall", "TrackTemp"),
                           boolean=("FreshTyre", "VirtualSafetyCar", "YellowFlag"), include_interactions=False)
ROW_KEY = ["l_orderkey", "l_linenumber", "Driver"]


def fb_labelled(spark, d):
    return onset_label(fb_train(spark, d), "RaceId", "LapNumber", "SafetyCar")


def one_tree(train, depth):
    """One unsampled tree, so that SQL can grow the same one."""
    return fit_boosted(train, "sc_next_lap", BOOST_ROLES, BoostParams(trees=1, depth=depth, rate=0.3, rows=1.0, columns=1.0), key=ROW_KEY).models[0]


@query("boosted_tree")
def q_boosted_tree(spark, d):
    """M3 (+A6): every node of a class-weighted tree of depth 2 over all training rows: split, gain, cover, value."""
    t = one_tree(fb_labelled(spark, d), 2).node_table(spark)
    return t.select("path", "feature", r6("threshold").alias("threshold"), "category", r6("gain").alias("gain"), r6("cover").alias("cover"),
                    r6("value").alias("value"))


@query("boosted_scores")
def q_boosted_scores(spark, d):
    """M3 + M5 + M6: that tree saved, loaded and applied to every holdout row."""
    train, holdout = fb_parts(spark, d)
    path = scratch_dir(spark, "boosted")
    one_tree(onset_label(train, "RaceId", "LapNumber", "SafetyCar"), 2).save(spark, path)
    s = decided(load_boosted(spark, path).add_probability(holdout, "sc_probability"), 0.5)
    return s.select("l_orderkey", "l_linenumber", r6("sc_probability").alias("sc_probability"), "sc_prediction")


@query("boosted_folds")
def q_boosted_folds(spark, d):
    """M4 (+T4): 5 folds grown in the same passes (one split each, so that SQL can follow): AUC of each from the scores
    of its held-out rows."""
    scores = cross_validate_boosted(fb_labelled(spark, d), "sc_next_lap", ROW_KEY, 5, BOOST_ROLES,
                                    BoostParams(trees=1, depth=1, rate=0.3, rows=1.0, columns=1.0))
    return fold_auc(scores).select("fold", "rows", "positives", r6("auc").alias("auc"))


@query("boosted_job")
def q_boosted_job(spark, d):
    """X2 with the library's own trees: the holdout's written scores and their metrics (one tree of depth 2, as an argument,
    so that SQL can grow it and recompute the metrics from its scores)."""
    train, holdout = fb_parts(spark, d)
    lab = lambda x: onset_label(x, "RaceId", "LapNumber", "SafetyCar")
    job = boosted_job(spark, lab(train), lab(holdout), "sc_next_lap", BOOST_ROLES, BoostParams(trees=1, depth=2, rate=0.3, rows=1.0, columns=1.0), 0, ROW_KEY)
    return job["metrics"].select("dataset", *[r6(c).alias(c) for c in METRIC_COLS], "tp", "fp", "tn", "fn")


@query("tree_attribution")
def q_tree_attribution(spark, d):
    """M8: exact attribution of a one-split tree for every holdout row, beside the margin that base and attribution give."""
    train, holdout = fb_parts(spark, d)
    model = one_tree(onset_label(train, "RaceId", "LapNumber", "SafetyCar"), 1)
    keys = ["l_orderkey", "l_linenumber"]
    a = attribute(holdout, model, keys)
    return a.select(*keys, "feature", r6("attribution").alias("attribution"), r6(F.col("attribution") + F.lit(base_value(model))).alias("margin"))


@query("race_attribution")
def q_race_attribution(spark, d):
    """X3 + M8 + P20: the report of race 1997_03_R under a boosted tree explains its lap 5, and lists the laps under a
    safety car."""
    c = cut_lineage(fb_clean(spark, d))
    model = one_tree(onset_label(c.where(F.col("Year") < 2001), "RaceId", "LapNumber", "SafetyCar"), 1)
    rep = race_report(spark, c, model, race_id="1997_03_R", lap=5, row_order=["l_orderkey", "l_linenumber", "Driver", "SpeedST"])
    return _long([report_rows("attribution", rep["attribution"], F.col("feature"), r6("attribution")),
                  report_rows("base", rep["margin"], F.col("LapNumber"), r6("base")),
                  report_rows("margin", rep["margin"], F.col("LapNumber"), r6("margin")),
                  report_rows("lap_risk", rep["lap_risk"], F.col("LapNumber"), r6("sc_probability")),
                  report_rows("flagged", flagged_laps(rep["rows"]), F.col("LapNumber"), F.col("rows"))])


@query("linear_attribution")
def q_linear_attribution(spark, d):
    """M8: additive contributions coef * (x - mean) of a fixed linear scorer,
    mean |contribution| per feature over all cleaned rows."""
    c = cut_lineage(fb_clean(spark, d).select(*LINEAR))
    a = mean_abs_attribution(linear_attribution(c, LINEAR, linear_means(c)))
    return a.select("feature", r6("mean_abs").alias("mean_abs"))


def linear_means(df) -> dict:
    return df.agg(*[F.avg(f).alias(f) for f in LINEAR]).first().asDict()


@query("lap_attribution")
def q_lap_attribution(spark, d):
    """M8 for one chosen lap: the first of race 1997_03_R."""
    c = cut_lineage(fb_clean(spark, d).select(*LINEAR, "RaceId", "l_orderkey", "l_linenumber", "Driver"))
    one = lap_attribution(race_rows(c, "1997_03_R"), LINEAR, ["LapNumber", "l_orderkey", "l_linenumber", "Driver", "SpeedST"], linear_means(c))
    return one.select("feature", r6("attribution").alias("attribution"))


# ------------------------------------------------------------- scoring (F-A)
REQ_COEFS = {"TyreLife": 0.01, "TrackTemp": 0.02, "LapNumber": 0.05,
             "TyreLife_TrackTemp_interaction": 0.001}


@query("score_requests")
def q_score_requests(spark, d):
    """P2 + P16 + P18 + P19 + M7: the F-A requests scored by a fixed
    logistic scorer; threshold 0.5."""
    r = score_requests(fx.fa_requests(spark, d), linear_scorer(REQ_COEFS, -3.0), 0.5, keep=["event_id"])
    return r.where(F.col("error").isNull()).select(
        "event_id", "race_id", "lap", "year", "track", r6("probability").alias("probability"), "threshold",
        "will_deploy_sc")


@query("deployed_requests")
def q_deployed_requests(spark, d):
    """M7 + E11 as deployed: the F-A requests scored at the threshold that the ledger's latest holdout run was tuned to."""
    r = deployed_scores(spark, fx.fa_requests(spark, d), linear_scorer(REQ_COEFS, -3.0), _ledger(spark, d), keep=["event_id"])
    return r.select("event_id", "race_id", "lap", "year", "track", r6("probability").alias("probability"), r6("threshold").alias("threshold"),
                    "will_deploy_sc", "error")


@query("request_errors")
def q_request_errors(spark, d):
    """The rejected requests with their error and message."""
    r = score_requests(fx.fa_requests(spark, d), linear_scorer(REQ_COEFS, -3.0), 0.5, keep=["event_id"])
    return r.where(F.col("error").isNotNull()).select("event_id", "race_id", "error", "message")


def fa_bodies(spark, d):
    """The F-A requests as raw JSON texts, some of them damaged (FIXTURES.md)."""
    eid, text = F.col("event_id"), F.to_json(F.struct("race_id", "lap", "lap_data"))
    worn = F.to_json(F.struct("race_id", "lap", F.struct(F.lit("worn").alias("TyreLife")).alias("lap_data")))
    fast = F.to_json(F.struct("race_id", "lap", F.lit("fast").alias("lap_data")))
    nested = F.to_json(F.struct("race_id", F.struct(F.lit(3).alias("n")).alias("lap"), "lap_data"))
    whole = F.to_json(F.struct("race_id", F.coalesce(F.col("lap").try_cast("int"), F.lit(0)).alias("lap"), "lap_data"))
    body = (F.when(eid % 31 == 0, F.expr("substring(b, 1, length(b) - 1)")).when(eid % 37 == 0, F.concat(F.lit("["), F.col("b"), F.lit("]")))
            .when(eid % 41 == 0, fast).when(eid % 43 == 0, worn).when(eid % 47 == 0, nested)
            .when((eid % 2 == 0) & F.col("lap").rlike("^[0-9]+$"), whole).otherwise(F.col("b")))
    return fx.fa_requests(spark, d).withColumn("b", text).select("event_id", body.alias("body"))


@query("request_bodies")
def q_request_bodies(spark, d):
    """M7 + P18 from raw bodies: each has a score or its own error."""
    r = score_bodies(fa_bodies(spark, d), linear_scorer(REQ_COEFS, -3.0), 0.5, keep=["event_id"])
    return r.select("event_id", "race_id", "lap", "year", "track", r6("probability").alias("probability"), "will_deploy_sc", "error", "message")


@query("body_stream")
def q_body_stream(spark, d):
    """M7 + P18 on a stream of raw bodies: scored requests, and rejected ones from the dead-letter folder."""
    src, out, dead, ck = (scratch_dir(spark, n) for n in ("bodies", "scored", "dead", "ck"))
    fa_bodies(spark, d).select("body").write.text(src)
    score_body_stream(spark, src, linear_scorer(REQ_COEFS, -3.0), out, dead, ck).awaitTermination()
    good = spark.read.parquet(out).groupBy("race_id", "lap").agg(F.count(F.lit(1)).alias("n"), r6(F.max("probability")).alias("probability"))
    bad = spark.read.parquet(dead).groupBy("error", "message").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None)
    return good.select("race_id", "lap", none.cast("string").alias("message"), "n", "probability").unionByName(
        bad.select(none.cast("string").alias("race_id"), none.cast("int").alias("lap"), "message", "n", none.cast("double").alias("probability")))


# ------------------------------------------------------------ reports (F-B)
def fb_scored(spark, d):
    c = fb_clean(spark, d)
    p = linear_scorer(LINEAR, LINEAR_B0)(c)
    return c.withColumns({"sc_probability": p, "sc_prediction": decide(p, 0.5), "threshold": F.lit(0.5)})


@query("lap_risk")
def q_lap_risk(spark, d):
    """A9 + J6: mean probability and any safety car per (race, lap)."""
    r = lap_risk(fb_scored(spark, d), "LapNumber", "sc_probability", "SafetyCar", "threshold", by=["RaceId"])
    return r.select("RaceId", "LapNumber", r6("sc_probability").alias("sc_probability"), "SafetyCar", "threshold")


@query("race_summary")
def q_race_summary(spark, d):
    """A10 per race of cleaned F-B."""
    s = race_summary(fb_clean(spark, d), median_cols=("AirTemp", "TrackTemp", "Rainfall"))
    return s.select("RaceId", "TrackId", "Year", r6("TrackLength").alias("TrackLength"), "Corners", "min_lap",
                    "max_lap", *[r6(f"median_{c}").alias(f"median_{c}") for c in ("AirTemp", "TrackTemp", "Rainfall")])


@query("race_list")
def q_race_list(spark, d):
    """Distinct races with display names."""
    return race_list(fb_clean(spark, d))


@query("race_rows")
def q_race_rows(spark, d):
    """P20 + T7: one race's rows by lap."""
    return race_rows(fb_clean(spark, d), "1997_03_R").select("l_orderkey", "l_linenumber", "LapNumber", "Driver")


@query("race_rows_parse")
def q_race_rows_parse(spark, d):
    """(year, round) from each race key."""
    k = fx.fb_laps(spark, d).select("RaceId").distinct()
    return k.select("RaceId", parse_session_key("RaceId").alias("p")).select("RaceId", "p.year", "p.round")


@query("rows_per_season")
def q_rows_per_season(spark, d):
    """Rows per season."""
    return count_by(fx.fb_laps(spark, d), ["Year"], name="laps")


@query("rows_per_event")
def q_rows_per_event(spark, d):
    """A11 + T8: rows per (season, event), first 20 by the keys."""
    return count_by(fx.fb_laps(spark, d), ["Year", "EventName"], 20, name="laps")


@query("null_fraction")
def q_null_fraction(spark, d):
    """Top 10 columns by share of nulls."""
    return null_fraction(fx.fb_laps(spark, d), 10).select("column", r6("null_fraction").alias("null_fraction"))


def fb_sc(spark, d):
    ok = F.col("l_orderkey")
    t = F.when(ok % 13 != 0, (ok % 1000).cast("string"))
    return fx.fb_laps(spark, d).withColumn("TrackStatus", t).withColumn("SC", contains_flag("TrackStatus", "4"))


@query("sc_flag")
def q_sc_flag(spark, d):
    """SC = status string contains '4' (null counts as 0)."""
    return fb_sc(spark, d).select("l_orderkey", "l_linenumber", "TrackStatus", "SC")


@query("value_share")
def q_value_share(spark, d):
    """Normalized value counts of the SC flag."""
    return value_share(fb_sc(spark, d), "SC").select("SC", "n", r6("share").alias("share"))


@query("shape")
def q_shape(spark, d):
    """Rows and columns."""
    return shape(fx.fb_laps(spark, d))


@query("preview")
def q_preview(spark, d):
    """A14 + T8: first 3 rows in key order."""
    cols = ["l_orderkey", "l_linenumber", "SpeedST", "RaceId"]
    return preview(fx.fb_laps(spark, d).select(*cols), cols, 3)


# ------------------------------------------------------- sessions (F-D, F-A)
@query("pending_sessions")
def q_pending_sessions(spark, d):
    """S9 + J8: past events x {Q, R} not yet in the catalog."""
    return pending_sessions(fx.fd_schedule(spark, d), fx.fd_catalog(spark, d), "1998-06-01")


@query("pending_in_folder")
def q_pending_in_folder(spark, d):
    """S9 + J8: past events x {Q, R} without a lap file; the catalogue is what lies in the folder."""
    root = scratch_dir(spark, "raw")
    name = F.concat_ws("_", F.col("year").cast("string"), F.lpad(F.col("round").cast("string"), 2, "0"), F.lit("Some_Event"), "session_type", F.lit("laps.parquet"))
    fx.fd_catalog(spark, d).withColumn("file", name).repartition("file").write.partitionBy("file").parquet(root)
    return pending_in_folder(spark, fx.fd_schedule(spark, d), root, "1998-06-01")


@query("session_key")
def q_session_key(spark, d):
    """P14 + P15: normalized event names in the session key format."""
    s = fx.fd_schedule(spark, d)
    return s.select("year", "round", session_key("year", "round", normalize_name("event_name"), F.lit("R"))
                    .alias("session_key"))


# --------------------------------------------------------- sources and sinks
LAP_CONTRACT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("race", T.LongType()),
                             T.StructField("driver", T.StringType()), T.StructField("lap", T.IntegerType()),
                             T.StructField("lap_time_s", T.DoubleType())])


def session_folder(spark, d) -> str:
    """F-A as flat session files, four sessions (race modulo 4) of three kinds:
    lap is BIGINT in one session and DOUBLE in another, lap_time_s lacks in a
    third, and one more session's laps file is no Parquet at all."""
    root = scratch_dir(spark, "flat")
    key = F.concat(F.lit("S"), (F.col("race") % 4).cast("string"))
    laps = fx.fa_laps(spark, d).select("event_id", "race", "driver", "lap", "lap_time_s")
    for i in range(4):
        own = key == f"S{i}"
        part = laps.where(own)
        part = part.withColumn("lap", F.col("lap").cast("bigint")) if i == 1 else part.withColumn("lap", F.col("lap").cast("double")) if i == 2 else part
        write_session_files({"laps": part.drop("lap_time_s") if i == 3 else part, "track_status": fx.fa_status(spark, d).where(own),
                             "weather": fx.fa_weather(spark, d).where(own)}, root, f"S{i}")
    spark.createDataFrame([("not a data file",)], "value string").coalesce(1).write.text(f"{root}/S9_laps.parquet")
    return root


@query("multi_file_scan")
def q_multi_file_scan(spark, d):
    """Flat ``<key>_laps.parquet`` files with drifting types, a lacking
    column and a damaged file, read under a contract; the key is the file name."""
    back = read_session_files(spark, session_folder(spark, d), "laps", contract=LAP_CONTRACT)
    return back.select("event_id", "RaceId", "race", "driver", "lap", r6("lap_time_s").alias("lap_time_s"))


@query("session_kinds")
def q_session_kinds(spark, d):
    """S2, S3, S6 and the report of damaged files: rows per kind and session;
    a kind that nobody wrote reads as empty."""
    root = session_folder(spark, d)
    out = None
    for kind, contract in (("laps", LAP_CONTRACT), ("track_status", None), ("weather", None), ("car_data", LAP_CONTRACT)):
        f = read_session_files(spark, root, kind, contract=contract, required=kind == "laps")
        f = f.groupBy("RaceId").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "RaceId", "n", F.lit(0).alias("unreadable"))
        out = f if out is None else out.unionByName(f)
    bad = unreadable_files(spark, root, "laps").select(F.lit("damaged").alias("kind"), "RaceId", F.lit(0).cast("long").alias("n"), F.lit(1).alias("unreadable"))
    return out.unionByName(bad)


@query("file_manifest")
def q_file_manifest(spark, d):
    """What the footers of the flat laps files say, every row group decoded: per session the
    rows, the columns, the stored type of lap, and whether its files are readable."""
    files = file_manifest(spark, session_folder(spark, d), "laps", verify=True)
    lap_type = F.filter("columns", lambda c: c["name"] == "lap")[0]["type"]
    return files.groupBy("RaceId").agg(F.sum("rows").alias("n"), F.max(F.size("columns")).cast("long").alias("n_columns"), F.max(lap_type).alias("lap_type"),
                                       F.min(F.col("readable").cast("int")).alias("readable"), F.max("error").alias("error"))


@query("verified_scan")
def q_verified_scan(spark, d):
    """The laps files that decode in full, each session's types cast to the contract."""
    back = read_session_files(spark, session_folder(spark, d), "laps", contract=LAP_CONTRACT, verify=True)
    return back.select("event_id", "RaceId", "race", "driver", "lap", r6("lap_time_s").alias("lap_time_s"))


@query("partitioned_scan")
def q_partitioned_scan(spark, d):
    """S5 / S6, native layout: F-A laps written one directory per race and read
    back with the race key from the directory names."""
    root = scratch_dir(spark, "sessions")
    write_sessions(fx.fa_laps(spark, d).select("race", "event_id", "driver", "lap", "lap_time_s"), root, "laps", ["race"])
    back = read_sessions(spark, root, "laps")
    return back.select("event_id", F.col("race").cast("long").alias("race"), "driver", "lap", r6("lap_time_s").alias("lap_time_s"))


@query("tagged_union")
def q_tagged_union(spark, d):
    """S6 + S7 + U1: per-driver frames tagged with session columns (one of
    them without lap_time_s and with lap as BIGINT), unioned by name under a
    contract; missing columns become null."""
    laps = fx.fa_laps(spark, d)
    frames = []
    for i, drv in enumerate(["view", "click", "purchase"]):
        f = laps.where(F.col("driver") == drv).select("event_id", "race", "driver", "lap", "lap_time_s")
        if drv == "purchase":
            f = f.drop("lap_time_s").withColumn("lap", F.col("lap").cast("long"))
        frames.append(tag_session(f, 2024, i + 1, f"Event {drv}", "R"))
    contract = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("race", T.LongType()),
                             T.StructField("driver", T.StringType()), T.StructField("lap", T.IntegerType()),
                             T.StructField("lap_time_s", T.DoubleType())])
    u = union_by_name(frames, contract)
    return u.select("event_id", "race", "driver", "lap", r6("lap_time_s").alias("lap_time_s"), "Year", "Round",
                    "EventName", "SessionType")


@query("stream_scores")
def q_stream_scores(spark, d):
    """M7 on Structured Streaming: the F-A requests land as files, a
    streaming query scores them into a Parquet sink (availableNow), and the
    sink is read back. Same rows as ``score_requests``."""
    src = scratch_dir(spark, "requests")
    reqs = fx.fa_requests(spark, d)
    reqs.write.mode("overwrite").parquet(src)
    out, ck = scratch_dir(spark, "scored"), scratch_dir(spark, "scored-ckpt")
    q = score_stream(spark, src, reqs.schema, linear_scorer(REQ_COEFS, -3.0), out, ck, 0.5, keep=["event_id"])
    q.awaitTermination()
    r = spark.read.parquet(out)
    return r.where(F.col("error").isNull()).select(
        "event_id", "race_id", "lap", "year", "track", r6("probability").alias("probability"), "threshold",
        "will_deploy_sc")


# ------------------------------------------------------ end-to-end jobs (F-M)
def fm_transform(spark, d, layout=None) -> dict:
    """X1 outputs on F-M."""
    return transform_job(spark, fx.fm_laps(spark, d), fx.fm_status(spark, d), fx.fm_weather(spark, d), layout=layout)


@query("transform_job")
def q_transform_job(spark, d):
    """X1 on the motorsport-shaped fixture: merged, cleaned, labeled rows
    with the train / test / holdout part of each."""
    return transformed(fm_transform(spark, d))


def transformed(out: dict) -> DataFrame:
    return out["full"].select(
        "event_id", "RaceId", "Driver", "LapNumber", "SafetyCar", "YellowFlag", "RedFlag", "VirtualSafetyCar",
        r6("AirTemp").alias("AirTemp"), "TrackId", r6("TrackLength").alias("TrackLength"), "Corners", "sc_next_lap", "Year", "part")


@query("stored_transform")
def q_stored_transform(spark, d):
    """X1 over a stored timeline."""
    return transformed(fm_transform(spark, d, scratch_dir(spark, "layout")))


@query("train_job")
def q_train_job(spark, d):
    """GBT trained on the X1 train part (all of its trees), metrics
    of test and holdout appended to a table and read back, the gate, 5-fold
    CV. As report rows: what the data fixes (rows, positives) by value, what
    the model decides by its checks (1 = holds)."""
    out = fm_transform(spark, d)
    job = train_job(spark, out["train"], out["test"], out["holdout"], FeatureRoles(),
                    folds=5, cv_key=["event_id"], metrics_path=scratch_dir(spark, "metrics"))
    m, auc = job["metrics"], F.coalesce(F.col("auc").between(0.0, 1.0), F.lit(True)).cast("int")
    gate = job["gate"].select((F.col("passed").eqNullSafe(F.col("value") >= F.col("minimum"))).cast("int").alias("ok"))
    cv = job["cv"].select((F.col("mean_auc").between(0.0, 1.0) & (F.col("std_auc") >= 0)).cast("int").alias("ok"))
    parts = [report_rows("rows", m, F.col("dataset"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")),
             report_rows("positives", m, F.col("dataset"), F.col("tp") + F.col("fn")),
             report_rows("auc_in_range", m, F.col("dataset"), auc),
             report_rows("gate", gate, F.lit("holdout"), F.col("ok")), report_rows("cv", cv, F.lit("train"), F.col("ok"))]
    return _long(parts)


def _long(parts):
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("race_report")
def q_race_report(spark, d):
    """Every section of the report on the newest race under a trained model
    (few trees, as an argument): races, rows, lap risk, summary, importances."""
    out = fm_transform(spark, d)
    model, fp = train_classifier(out["train"], "sc_next_lap", FeatureRoles(), {"maxIter": 2, "maxDepth": 2})
    rep = race_report(spark, out["full"], model, fp)
    risk, summary = rep["lap_risk"], rep["summary"]
    counts = rep["rows"].groupBy("LapNumber").agg(F.count(F.lit(1)).alias("n"))
    total = rep["importance"].agg(F.sum("importance").alias("s"))
    return _long([
        report_rows("races", rep["races"], F.col("RaceId"), None, F.col("display_name")),
        report_rows("rows", counts, F.col("LapNumber"), F.col("n")),
        report_rows("lap_risk", risk, F.col("LapNumber"), F.col("sc_probability").between(0.0, 1.0).cast("int"), F.col("SafetyCar")),
        report_rows("summary", summary, F.lit("laps"), F.col("max_lap") - F.col("min_lap")),
        report_rows("summary", summary, F.lit("TrackLength"), r6("TrackLength"), F.col("TrackId")),
        report_rows("summary", summary, F.lit("median_AirTemp"), r6("median_AirTemp")),
        report_rows("importance", total, F.lit("sum"), F.round("s", 6).isin(0.0, 1.0).cast("int"))])


@query("season_job")
def q_season_job(spark, d):
    """Race laps with SC flag from the status string and season tag,
    F-B, written as one dataset and read back."""
    s = season_job(fb_sc(spark, d).drop("SC"), scratch_dir(spark, "season"), "TrackStatus", "Year")
    return s.select("l_orderkey", "l_linenumber", "Season", "EventName", "SC")


@query("profile_report")
def q_profile_report(spark, d):
    """X4 over the season build: every section as report rows."""
    cols = ["l_orderkey", "l_linenumber", "SpeedST", "EventName", "TrackStatus", "Compound", "SessionType", "Year"]
    p = profile_report(season_job(fb_sc(spark, d).select(*cols), None, "TrackStatus", "Year"))
    return _long([
        report_rows("shape", p["shape"], F.lit("rows"), F.col("rows")), report_rows("shape", p["shape"], F.lit("columns"), F.col("columns")),
        report_rows("preview", p["preview"], F.concat_ws("_", "l_orderkey", "l_linenumber"), r6("SpeedST"), F.col("EventName")),
        report_rows("nulls", p["nulls"], F.col("column"), r6("null_fraction")),
        report_rows("per_season", p["per_season"], F.col("Season"), F.col("rows")),
        report_rows("per_event", p["per_event"], F.concat_ws(" ", "Season", "EventName"), F.col("rows")),
        report_rows("flag_share", p["flag_share"], F.col("SC"), r6("share"))])


API_COEFS = {"TyreLife": 0.01, "SpeedST": 0.001, "TrackLength": 0.1, "Corners": 0.01}


@query("api_requests")
def q_api_requests(spark, d):
    """P17 + P18 + P19: the service defaults profile (TrackLength 5.412,
    SpeedST 300, ...), fixed scorer over the fields that profile provides,
    threshold 0.5."""
    r = score_requests(fx.fa_requests(spark, d), linear_scorer(API_COEFS, -3.0), 0.5, defaults=API_DEFAULTS,
                       keep=["event_id"])
    return r.where(F.col("error").isNull()).select("event_id", "lap", r6("probability").alias("probability"),
                                                   "will_deploy_sc")
