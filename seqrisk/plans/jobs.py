"""End-to-end jobs (X1-X5), composed from the operators.

Each job is one lazy plan per stage; lineage is cut (reliable checkpoint in
the shared checkpoint directory) where a stage's output fans out to several
consumers, so nothing is recomputed and a lost executor only costs the
current stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqrisk.config import (AUC_GATE, CV_FOLDS, DEFAULT_THRESHOLD, HOLDOUT_YEARS, SEED, STATUS_FLAGS, TEST_FRACTION,
                            WEATHER_COLUMNS, WEATHER_MEDIAN_COLUMNS, FeatureRoles, Roles)
from seqrisk.functions.expr import contains_flag, decide, seconds, year_of
from seqrisk.operators.attribution import attribute, margin
from seqrisk.operators.boosting import BoostedModel, BoostParams, fit_boosted, fold_auc, load_boosted
from seqrisk.operators.enrich import clean, fill_group_median
from seqrisk.operators.evaluation import calibration, latest_metric, metrics_row, quality_gate, roc_curve
from seqrisk.operators.ledger import commit_run, read_ledger, run_key, stored_threshold
from seqrisk.operators.label import label_stats, onset_label
from seqrisk.operators.model import (cross_validate, cv_summary, feature_importance, save_model, score,
                                     train_classifier)
from seqrisk.operators.reports import (count_by, lap_risk, lap_rows, null_fraction, preview, race_list, race_rows,
                                       race_summary, shape, value_share)
from seqrisk.operators.scoring import score_bodies, score_requests
from seqrisk.operators.split import label_parts
from seqrisk.operators.temporal import asof_join, flag_intervals, interval_end
from seqrisk.operators.timeline import TimelineRoles, step_features, store_timeline
from seqrisk.plans.scratch import scratch_dir
from seqrisk.session import cut_lineage
from seqrisk.sources.files import load_dataframe, save_dataframe


def merge_sessions(laps: DataFrame, status: DataFrame, weather: DataFrame, roles: Roles = Roles(),
                   layout: str | None = None) -> DataFrame:
    """J1 + J2 + J3 + A1: flags from status changes inside each lap, weather
    at lap start, weather gaps filled with race medians. ``layout``: a new folder
    for a stored timeline, which J1 to J3 then read without a shuffle of their own."""
    r = roles
    lt = "__lap_s"
    d = laps.withColumn(lt, seconds(r.lap_time, laps.schema[r.lap_time].dataType)) \
        if r.lap_time in laps.columns else laps.withColumn(lt, F.lit(None).cast("double"))
    wcols = [c for c in WEATHER_COLUMNS if c in weather.columns]
    if layout:
        tl = store_timeline(d, status, weather, TimelineRoles(r.race, r.driver, r.lap, r.start, r.event_time, r.status, lt), layout, wcols)
        d = step_features(laps.sparkSession, tl, STATUS_FLAGS, [r.driver, r.lap], end="__end")
        return fill_group_median(d, WEATHER_MEDIAN_COLUMNS, r.race).drop(lt, "__end")
    d = cut_lineage(interval_end(d, r.race, r.driver, r.lap, r.start, lt, out="__end"))   # feeds points and rows
    d = flag_intervals(d, status, r.race, r.driver, r.lap, r.start, "__end", r.race, r.event_time, r.status,
                       STATUS_FLAGS)
    d = asof_join(d, weather, r.race, r.start, r.race, r.event_time, wcols,
                  require=[r.driver, r.lap])
    d = fill_group_median(d, WEATHER_MEDIAN_COLUMNS, r.race)
    return d.drop(lt, "__end")


def transform_job(spark: SparkSession, laps: DataFrame, status: DataFrame, weather: DataFrame,
                  out_dir: str | None = None, roles: Roles = Roles(), dim=None,
                  test_frac: float = TEST_FRACTION, holdout_years=HOLDOUT_YEARS, seed=SEED, layout: str | None = None) -> dict:
    """Merge (over a stored timeline in the folder ``layout`` if given), clean, label, split. The result is written once, with a
    ``part`` column, to ``out_dir``/full (partitioned by part and year) or a
    scratch table; train, test and holdout are reads of their partitions."""
    merged = cut_lineage(merge_sessions(laps, status, weather, roles, layout))
    cleaned = clean(merged, roles, dim)
    labeled = onset_label(cleaned, roles.race, roles.lap, roles.flag, roles.target)
    labeled = labeled.withColumn(roles.year, year_of(roles.race))
    labeled = label_parts(labeled, roles.race, test_frac, holdout_years, seed, year=F.col(roles.year))
    path = f"{out_dir}/full" if out_dir else scratch_dir(spark, "x1")
    save_dataframe(labeled, path, ["part", roles.year])
    full = load_dataframe(spark, path)
    out = {"full": full, **{k: full.where(F.col("part") == k).drop("part") for k in ("train", "test", "holdout")}}
    out["stats"] = label_stats(full, roles.target)
    return out


def train_job(spark: SparkSession, train: DataFrame, test: DataFrame, holdout: DataFrame,
              roles: FeatureRoles = FeatureRoles(), label: str = "sc_next_lap", params: dict | None = None,
              folds: int = CV_FOLDS, run_ts: int = 0, model_dir: str | None = None,
              cv_key: list[str] | None = None,
              metrics_path: str | None = None) -> dict:
    """Features fitted on train, class-weighted GBT, k-fold CV, metrics
    for test and holdout (one row each, committed to the ledger at
    ``metrics_path`` under a key derived from the inputs, so that a repeated job
    leaves one; the threshold lookup and the gate read it), model + feature
    parameters saved together when ``model_dir`` is given."""
    model, fp = train_classifier(train, label, roles, params)
    metrics = None
    for name, part in (("test", test), ("holdout", holdout)):
        s = score(part, model, fp, 0.5, roles)
        m = metrics_row(s, label, "sc_probability", name).withColumn("run_ts", F.lit(run_ts))
        metrics = m if metrics is None else metrics.unionByName(m)
    if metrics_path:
        settings = {"label": label, "params": params, "run_ts": run_ts, "roles": str(roles)}
        commit_run(metrics, metrics_path, run_key({"train": train, "test": test, "holdout": holdout}, settings), run_ts)
        metrics = read_ledger(spark, metrics_path)
    else:
        metrics = cut_lineage(metrics)
    out = {"model": model, "features": fp, "metrics": metrics,
           "gate": quality_gate(metrics, "holdout", "auc", AUC_GATE)}
    if folds and folds > 1:
        out["cv"] = cv_summary(cross_validate(train, label, cv_key, folds, roles, params))
    if model_dir:
        save_model(model, fp, model_dir)
    return out


def tuned_threshold(metrics: DataFrame, dataset: str = "holdout"):
    """The threshold of the latest run, 0.5 where there is none, as a scalar."""
    return latest_metric(metrics, dataset, "optimal_threshold", DEFAULT_THRESHOLD).select("optimal_threshold").scalar()


def deployed_scores(spark: SparkSession, requests: DataFrame, scorer, metrics_path: str, dataset: str = "holdout", body: str | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """M7 as it runs behind a deployed model: no threshold is handed in, the one
    that the ledger at ``metrics_path`` holds is used (0.5 without one). ``scorer``:
    a function, a ``ModelScorer``, a ``BoostedModel`` or the path of a saved one;
    ``body`` names a column of raw JSON bodies, else requests are typed rows."""
    scorer = load_boosted(spark, scorer) if isinstance(scorer, str) else scorer
    threshold = stored_threshold(spark, metrics_path, dataset)
    if body:
        return score_bodies(requests, scorer, threshold, body=body, keep=keep)
    return score_requests(requests, scorer, threshold, keep=keep)


def race_report(spark: SparkSession, df: DataFrame, model, fp=None, race_id: str | None = None,
                threshold=0.5, roles: FeatureRoles = FeatureRoles(), r: Roles = Roles(), lap: int | None = None,
                row_order: list[str] | None = None) -> dict:
    """Race list, one race's rows scored, lap risk, race summary and the
    model's feature importances. ``threshold``: a number or a scalar, such as
    the tuned one that ``tuned_threshold`` reads. A boosted model of the library's
    own also explains a chosen ``lap`` (the race's first one if none is given):
    ``attribution`` holds what each feature adds to the log odds of the lap's
    first row in ``row_order``, ``margin`` the log odds and their base."""
    races = race_list(df, r.race)
    if race_id is None:
        race_id = races.first()[r.race]
    rows = race_rows(df, race_id, r.race, r.lap)
    own = isinstance(model, BoostedModel)
    scored = decided(model.add_probability(rows, "sc_probability"), threshold) if own else score(rows, model, fp, threshold, roles)
    out = {"races": races, "rows": rows, "lap_risk": lap_risk(scored, r.lap, "sc_probability", r.flag),
           "summary": race_summary(rows, r.race, r.lap),
           "importance": model.importance(spark) if own else feature_importance(model, fp)}
    if own:
        chosen = lap_rows(rows, lap, r.lap).orderBy(*(row_order or [r.driver])).limit(1)
        out["attribution"] = attribute(chosen, model, [r.lap])
        out["margin"] = margin(chosen, model, [r.lap])
    return out


def decided(scored: DataFrame, threshold, prob: str = "sc_probability") -> DataFrame:
    """The 0/1 prediction at a number or scalar threshold, and the threshold used."""
    t = threshold if not isinstance(threshold, (int, float)) else F.lit(float(threshold))
    return scored.withColumns({"sc_prediction": decide(prob, t), "threshold": t.cast("double")})


def boosted_job(spark: SparkSession, train: DataFrame, holdout: DataFrame, label: str = "sc_next_lap", roles: FeatureRoles = FeatureRoles(),
                params: BoostParams = BoostParams(), folds: int = CV_FOLDS, key: list[str] | None = None, model_path: str | None = None,
                scores_path: str | None = None) -> dict:
    """X2 with the library's own boosted trees: the model and its folds from the same passes; AUC of each fold from its
    held-out scores; the holdout's scores, metrics, curve and calibration from one written table."""
    fit = fit_boosted(train, label, roles, params, folds, key=key)
    model = fit.models[0]
    scored = model.add_probability(holdout, "score").select(F.col(label).alias("y"), "score")
    path = scores_path or scratch_dir(spark, "scores")
    save_dataframe(scored, path)
    scored = load_dataframe(spark, path)
    if model_path:
        model.save(spark, model_path)
    return {"model": model, "cv": fold_auc(fit.held_out_scores()) if folds else None, "scores": scored,
            "metrics": metrics_row(scored, "y", "score", "holdout"), "roc": roc_curve(scored, "y", "score"),
            "calibration": calibration(scored, "y", "score")}


def profile_report(df: DataFrame, season: str = "Season", event: str = "EventName", flag: str = "SC") -> dict:
    """Shape, preview, null fractions, rows per season and event, flag share."""
    out = {"shape": shape(df), "preview": preview(df, df.columns[:3], 3), "nulls": null_fraction(df, 10)}
    if season in df.columns:
        out["per_season"] = count_by(df, [season])
        if event in df.columns:
            out["per_event"] = count_by(df, [season, event], 20)
    if flag in df.columns:
        out["flag_share"] = value_share(df, flag)
    return out


def season_job(laps: DataFrame, out_path: str | None = None, status_col: str = "TrackStatus",
               season_col: str = "Year", session_type: str = "SessionType") -> DataFrame:
    """Laps of race sessions (where the session type is known) with SC
    (status string contains '4'), Season and EventName; one Parquet dataset,
    read back when written. No rows is an error."""
    d = laps.where(F.col(session_type) == "R") if session_type in laps.columns else laps
    d = d.withColumn("SC", contains_flag(status_col, "4")).withColumn("Season", F.col(season_col))
    if d.isEmpty():
        raise ValueError("no race laps to build a season from")
    if out_path:
        save_dataframe(d, out_path)
        d = load_dataframe(laps.sparkSession, out_path)
    return d


def report_rows(section: str, df: DataFrame, item, value=None, text=None) -> DataFrame:
    """A section of a report as (section, item, value, text) rows."""
    null = F.lit(None)
    return df.select(F.lit(section).alias("section"), item.cast("string").alias("item"),
                     (null if value is None else value).cast("double").alias("value"),
                     (null if text is None else text).cast("string").alias("text"))
