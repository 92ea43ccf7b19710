"""DuckDB SQL oracles, one per registered query (same keys, same columns).

Fixture views are written once as CTE text and prefixed to each query.
"""

from __future__ import annotations

from seqrisk.config import TRACKS

# ------------------------------------------------------------------ F-A CTEs
FA_LAPS = """
fa_laps AS (
  SELECT event_id, race, driver, lap,
         CASE WHEN event_id % 13 <> 0 THEN ts END AS start,
         CASE WHEN event_id % 3 <> 0 THEN value END AS lap_time_s, props
  FROM (SELECT event_id, user_id AS race, event_type AS driver, ts, value, props,
               CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS INTEGER) AS lap
        FROM events WHERE event_type IN ('view', 'click', 'purchase')) q
  WHERE event_id % 11 <> 0)"""

FA_STATUS = """
fa_status AS (
  SELECT event_id, user_id AS race, ts AS time,
         substr('124567', CAST(event_id % 6 AS INTEGER) + 1, 1) AS status
  FROM events WHERE event_type = 'error')"""

FA_WEATHER = """
fa_weather AS (
  SELECT event_id, user_id AS race, ts AS time,
         CASE WHEN event_id % 5 <> 0 THEN value END AS air_temp,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity
  FROM events WHERE event_type = 'signup')"""

FA_IV = """
fa_nxt AS (
  SELECT race, driver, lap - 1 AS plap, min(start) AS next_start
  FROM fa_laps WHERE start IS NOT NULL GROUP BY race, driver, lap),
fa_iv AS (
  SELECT l.*, CASE WHEN l.start IS NOT NULL THEN coalesce(
           n.next_start,
           l.start + to_microseconds(CAST(round(l.lap_time_s * 1000000) AS BIGINT)),
           l.start + INTERVAL 120 SECOND) END AS interval_end
  FROM fa_laps l LEFT JOIN fa_nxt n ON l.race = n.race AND l.driver = n.driver AND l.lap = n.plap)"""

FA_FLAGS = """
fa_fl AS (
  SELECT i.race, i.driver, i.lap,
         bool_or(s.status = '2') AS YellowFlag, bool_or(s.status = '4') AS SafetyCar,
         bool_or(s.status = '5') AS RedFlag, bool_or(s.status = '6') AS VirtualSafetyCar
  FROM fa_iv i JOIN fa_status s
    ON s.race = i.race AND s.time >= i.start AND s.time < i.interval_end
  WHERE i.driver IS NOT NULL AND i.lap IS NOT NULL
  GROUP BY i.race, i.driver, i.lap),
fa_flagged AS (
  SELECT i.*, coalesce(f.YellowFlag, false) AS YellowFlag, coalesce(f.SafetyCar, false) AS SafetyCar,
         coalesce(f.RedFlag, false) AS RedFlag, coalesce(f.VirtualSafetyCar, false) AS VirtualSafetyCar
  FROM fa_iv i LEFT JOIN fa_fl f ON i.race = f.race AND i.driver = f.driver AND i.lap = f.lap)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def hash_key(*cols: str) -> str:
    """The seeded order key of the split operators."""
    texts = [f"CAST({c} AS VARCHAR)" for c in cols]
    parts = [f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '~')" for t in texts]
    return "md5(" + " || '|' || ".join(parts) + " || '|42')"


ORACLE: dict[str, str] = {}

ORACLE["interval_end"] = with_(FA_LAPS, FA_IV) + """
SELECT event_id, race, driver, lap, epoch_us(interval_end) AS end_us FROM fa_iv"""

ORACLE["status_flags"] = with_(FA_LAPS, FA_STATUS, FA_IV, FA_FLAGS) + """
SELECT event_id, race, driver, lap, YellowFlag, SafetyCar, RedFlag, VirtualSafetyCar FROM fa_flagged"""

ORACLE["interval_onset"] = with_(FA_LAPS, FA_STATUS, FA_IV, FA_FLAGS) + """,
st AS (SELECT race, lap, bool_or(SafetyCar) AS cur FROM fa_flagged
       WHERE race IS NOT NULL AND lap IS NOT NULL GROUP BY race, lap),
lab AS (SELECT a.race, a.lap FROM st a JOIN st b ON a.race = b.race AND b.lap = a.lap + 1
        WHERE b.cur AND NOT a.cur AND a.lap >= 1)
SELECT f.event_id, f.race, f.driver, f.lap, f.YellowFlag, f.SafetyCar, f.RedFlag, f.VirtualSafetyCar,
       CASE WHEN l.race IS NULL THEN 0 ELSE 1 END AS sc_next_lap
FROM fa_flagged f LEFT JOIN lab l ON f.race = l.race AND f.lap = l.lap"""

ORACLE["asof_weather"] = with_(FA_LAPS, FA_WEATHER) + """
SELECT l.event_id, l.race, l.driver, l.lap, round(w.air_temp, 6) AS air_temp,
       round(w.humidity, 6) AS humidity
FROM fa_laps l ASOF LEFT JOIN fa_weather w ON l.race = w.race AND l.start >= w.time"""

ORACLE["stored_timeline"] = with_(FA_LAPS, FA_STATUS, FA_WEATHER, FA_IV, FA_FLAGS) + """,
st AS (SELECT race, lap, bool_or(SafetyCar) AS cur FROM fa_flagged
       WHERE race IS NOT NULL AND lap IS NOT NULL GROUP BY race, lap),
lab AS (SELECT a.race, a.lap FROM st a JOIN st b ON a.race = b.race AND b.lap = a.lap + 1
        WHERE b.cur AND NOT a.cur AND a.lap >= 1)
SELECT f.event_id, f.race, f.driver, f.lap, epoch_us(f.interval_end) AS end_us, f.YellowFlag, f.SafetyCar, f.RedFlag, f.VirtualSafetyCar,
       round(w.air_temp, 6) AS air_temp, round(w.humidity, 6) AS humidity, CASE WHEN l.race IS NULL THEN 0 ELSE 1 END AS sc_next_lap
FROM fa_flagged f ASOF LEFT JOIN fa_weather w ON f.race = w.race AND f.start >= w.time
LEFT JOIN lab l ON f.race = l.race AND f.lap = l.lap"""

# ------------------------------------------------------------------ F-B CTEs
FB_LAPS = """
fb_laps AS (
  SELECT l_orderkey, l_linenumber,
         strftime(l_shipdate, '%Y_%m') || '_R' AS RaceId,
         CAST(year(l_shipdate) AS INTEGER) AS Year,
         CAST(day(l_shipdate) AS INTEGER) AS LapNumber,
         CAST(l_suppkey AS VARCHAR) AS Driver,
         CAST(l_suppkey % 5 AS VARCHAR) AS Team,
         CASE WHEN l_orderkey % 9 <> 0 THEN l_returnflag END AS Compound,
         replace(p_name, ' ', '_') AS EventName,
         CASE WHEN l_orderkey % 10 = 0 THEN 'Q' WHEN l_orderkey % 10 = 1 THEN 'FP' ELSE 'R' END AS SessionType,
         l_linestatus = 'O' AS IsAccurate,
         CASE WHEN l_partkey % 7 <> 0 THEN l_extendedprice END AS LapTime,
         CASE WHEN l_orderkey % 7 <> 0 THEN l_quantity END AS TyreLife,
         l_extendedprice AS SpeedST,
         CASE WHEN l_linenumber <> 3 THEN l_tax * 1000 END AS SpeedI1,
         l_discount * 100 AS TrackTemp,
         l_linenumber AS Position,
         l_tax * 100 + 20 AS AirTemp,
         CASE WHEN l_discount >= 0.09 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Rainfall,
         l_linenumber = 1 AS FreshTyre,
         (l_returnflag = 'A' AND l_quantity > 45) AS YellowFlag,
         CASE WHEN l_orderkey % 11 <> 0 THEN l_quantity < 3 END AS VirtualSafetyCar,
         (l_quantity = 50 AND l_returnflag = 'R') AS SafetyCar
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FB_ONSET = """
fb_st AS (SELECT RaceId, LapNumber, bool_or(coalesce(SafetyCar, false)) AS cur FROM fb_laps
          WHERE RaceId IS NOT NULL AND LapNumber IS NOT NULL GROUP BY RaceId, LapNumber),
fb_lab AS (SELECT a.RaceId, a.LapNumber FROM fb_st a JOIN fb_st b
           ON a.RaceId = b.RaceId AND b.LapNumber = a.LapNumber + 1
           WHERE b.cur AND NOT a.cur AND a.LapNumber >= 1),
fb_onset AS (SELECT f.*, CASE WHEN l.RaceId IS NULL THEN 0 ELSE 1 END AS sc_next_lap
             FROM fb_laps f LEFT JOIN fb_lab l ON f.RaceId = l.RaceId AND f.LapNumber = l.LapNumber)"""

ORACLE["onset_label"] = with_(FB_LAPS, FB_ONSET) + """
SELECT l_orderkey, l_linenumber, RaceId, LapNumber, Driver, sc_next_lap FROM fb_onset"""

ORACLE["label_stats"] = with_(FB_LAPS, FB_ONSET) + """
SELECT CAST(sum(sc_next_lap) AS BIGINT) AS positives, count(*) AS total,
       round(CASE WHEN count(*) > 0 THEN 100.0 * sum(sc_next_lap) / count(*) ELSE 0 END, 6) AS positive_pct
FROM fb_onset"""

ORACLE["year_holdout"] = with_(FB_LAPS) + """
SELECT RaceId, count(*) AS n_rows,
       CASE WHEN CAST(split_part(RaceId, '_', 1) AS INTEGER) = 2001 THEN 'holdout' ELSE 'rest' END AS part
FROM fb_laps GROUP BY RaceId"""

FB_RACES = """
fb_r AS (SELECT RaceId, CAST(split_part(RaceId, '_', 1) AS INTEGER) AS yr, count(*) AS n_rows
         FROM fb_laps GROUP BY RaceId)"""

ORACLE["group_split"] = with_(FB_LAPS, FB_RACES) + """,
k AS (SELECT RaceId, row_number() OVER (ORDER BY """ + hash_key("RaceId") + """) AS rk FROM fb_r WHERE yr <> 2001),
c AS (SELECT count(*) AS n FROM k)
SELECT r.RaceId, r.n_rows,
       CASE WHEN r.yr = 2001 THEN 'holdout' WHEN k.rk <= floor(c.n * 0.2) THEN 'test' ELSE 'train' END AS part
FROM fb_r r LEFT JOIN k ON r.RaceId = k.RaceId CROSS JOIN c"""

ORACLE["fallback_split"] = with_(FB_LAPS, FB_RACES) + """,
k AS (SELECT RaceId, n_rows, row_number() OVER (ORDER BY """ + hash_key("RaceId") + """) AS rk FROM fb_r),
c AS (SELECT count(*) AS n FROM k)
SELECT RaceId, n_rows,
       CASE WHEN rk <= floor(n * 0.7) THEN 'train' WHEN rk <= floor(n * 0.9) THEN 'test' ELSE 'holdout' END AS part
FROM k CROSS JOIN c"""

# ------------------------------------------------------------------ F-C CTEs
FC = """
fc AS (SELECT l.doc_id, l.quality AS y,
              round(d.n_chars / (d.n_chars + CAST(500 AS DOUBLE)), 3) AS score
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

ORACLE["stratified_folds"] = with_(FC) + """
SELECT doc_id, y,
       CAST((row_number() OVER (PARTITION BY y ORDER BY """ + hash_key("doc_id") + """) - 1) % 5 AS INTEGER) AS fold
FROM fc"""

ORACLE["prefix_split"] = with_(FC) + """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(0.8 * (SELECT count(*) FROM fc))
                    THEN 'train' ELSE 'test' END AS part
FROM fc"""

ORACLE["seeded_sample"] = with_(FA_LAPS) + """
SELECT event_id, race, lap FROM fa_laps ORDER BY """ + hash_key("event_id") + " LIMIT 500"

ORACLE["fallback_split_nulls"] = with_(FB_LAPS) + """,
g AS (SELECT Compound, count(*) AS n_rows FROM fb_laps GROUP BY Compound),
k AS (SELECT *, row_number() OVER (ORDER BY """ + hash_key("Compound") + """) AS rk, count(*) OVER () AS n FROM g)
SELECT Compound, n_rows,
       CASE WHEN rk <= floor(n * 0.5) THEN 'train' WHEN rk <= floor(n * 0.75) THEN 'test' ELSE 'holdout' END AS part
FROM k"""

FC_NULL = "fc_n AS (SELECT *, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 7 END AS half FROM fc)"

ORACLE["fallback_split_rows"] = with_(FC, FC_NULL) + """,
k AS (SELECT doc_id, row_number() OVER (ORDER BY """ + hash_key("half", "doc_id") + """) AS rk, count(*) OVER () AS n FROM fc_n)
SELECT doc_id, CASE WHEN rk <= floor(n * 0.7) THEN 'train' WHEN rk <= floor(n * 0.9) THEN 'test' ELSE 'holdout' END AS part
FROM k"""

ORACLE["stratified_folds_nulls"] = with_(FC, FC_NULL) + """
SELECT doc_id, y, CAST((row_number() OVER (PARTITION BY y ORDER BY """ + hash_key("half", "doc_id") + """) - 1) % 5 AS INTEGER) AS fold
FROM fc_n"""

ORACLE["prefix_split_ties"] = with_(FC) + """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id % 5, doc_id) <= floor(0.8 * (SELECT count(*) FROM fc))
                    THEN 'train' ELSE 'test' END AS part
FROM fc"""

ORACLE["class_weights"] = with_(FC) + """,
c AS (SELECT y, count(*) AS n FROM fc WHERE y IS NOT NULL GROUP BY y),
t AS (SELECT sum(n) AS t, count(*) AS k, sum(CASE WHEN y = 0 THEN n END) AS n0,
             sum(CASE WHEN y = 1 THEN n END) AS n1 FROM c)
SELECT y, n, round(t / (k * n), 6) AS weight, round(CAST(n0 AS DOUBLE) / n1, 6) AS scale_pos_weight
FROM c CROSS JOIN t"""


def curve(src: str, name: str = "cv") -> str:
    """Per distinct score: pos, neg, running tps / fps (descending), P, N."""
    return f"""
{name}_s AS (SELECT CAST(score AS DOUBLE) AS threshold, CAST(sum(y) AS BIGINT) AS pos,
                 CAST(sum(1 - y) AS BIGINT) AS neg
          FROM {src} WHERE score IS NOT NULL AND y IS NOT NULL GROUP BY 1),
{name}_t AS (SELECT CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N FROM {name}_s),
{name} AS (SELECT s.*, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tps,
                CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fps, t.P, t.N
         FROM {name}_s s CROSS JOIN {name}_t t)"""


def metrics_sql(name: str = "cv") -> str:
    """One row: auc, avg_precision, youden threshold, confusion at it."""
    return f"""
{name}_j AS (SELECT threshold, tps, fps,
                 coalesce(CASE WHEN P > 0 THEN tps / P END, 0) - coalesce(CASE WHEN N > 0 THEN fps / N END, 0) AS j
          FROM {name}),
{name}_b AS (SELECT * FROM {name}_j ORDER BY j DESC, threshold DESC LIMIT 1),
{name}_y AS (SELECT CASE WHEN j > 0 THEN threshold ELSE CAST('inf' AS DOUBLE) END AS t,
                 CASE WHEN j > 0 THEN j ELSE 0.0 END AS j,
                 CASE WHEN j > 0 THEN tps ELSE 0 END AS tp, CASE WHEN j > 0 THEN fps ELSE 0 END AS fp
          FROM {name}_b),
{name}_a AS (SELECT CASE WHEN max(P) > 0 AND max(N) > 0
                      THEN sum(neg * (tps - pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N)) END AS auc,
                 CASE WHEN max(P) > 0 THEN sum(pos * (tps / (tps + fps))) / CAST(max(P) AS DOUBLE) END
                   AS avg_precision, max(P) AS P, max(N) AS N
          FROM {name}),
{name}_m AS (SELECT a.auc, a.avg_precision, y.t AS optimal_threshold, y.j AS youden_j,
                 y.tp, y.fp, a.N - y.fp AS tn, a.P - y.tp AS fn
          FROM {name}_a a CROSS JOIN {name}_y y),
{name}_r AS (SELECT *,
                 coalesce(CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) END, 0) AS sensitivity,
                 coalesce(CASE WHEN tn + fp > 0 THEN tn / CAST(tn + fp AS DOUBLE) END, 0) AS specificity,
                 coalesce(CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) END, 0) AS precision
          FROM {name}_m),
{name}_row AS (SELECT *, coalesce(CASE WHEN precision + sensitivity > 0
                   THEN 2 * precision * sensitivity / (precision + sensitivity) END, 0) AS f1_score
          FROM {name}_r)"""


ORACLE["roc_curve"] = with_(FC, curve("fc")) + """
SELECT round(threshold, 6) AS threshold, round(fps / N, 6) AS fpr, round(tps / P, 6) AS tpr, tps, fps FROM cv
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0, 0, 0"""

ORACLE["roc_auc"] = with_(FC, curve("fc"), metrics_sql()) + "SELECT round(auc, 6) AS auc FROM cv_a"

ORACLE["pr_curve"] = with_(FC, curve("fc")) + """
SELECT round(threshold, 6) AS threshold, round(coalesce(CASE WHEN tps + fps > 0 THEN tps / (tps + fps) END, 0), 6)
         AS precision, round(coalesce(CASE WHEN P > 0 THEN tps / P END, 1), 6) AS recall FROM cv
UNION ALL SELECT NULL, 1.0, 0.0"""

ORACLE["avg_precision"] = with_(FC, curve("fc"), metrics_sql()) + \
    "SELECT round(avg_precision, 6) AS avg_precision FROM cv_a"

ORACLE["youden"] = with_(FC, curve("fc"), metrics_sql()) + """
SELECT round(optimal_threshold, 6) AS optimal_threshold, round(youden_j, 6) AS youden_j FROM cv_m"""

ORACLE["confusion"] = with_(FC, curve("fc"), metrics_sql()) + """,
cm AS (SELECT count_if(y = 0 AND score < t) AS tn, count_if(y = 0 AND score >= t) AS fp,
              count_if(y = 1 AND score < t) AS fn, count_if(y = 1 AND score >= t) AS tp
       FROM fc CROSS JOIN cv_y)
SELECT tn, fp, fn, tp,
       round(coalesce(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END, 0), 6) AS sensitivity,
       round(coalesce(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) END, 0), 6) AS specificity,
       round(coalesce(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END, 0), 6) AS precision,
       round(coalesce(CASE WHEN tp + fp > 0 AND tp + fn > 0
             THEN 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) END, 0), 6)
         AS f1_score
FROM cm"""

METRIC_SELECT = """round(auc, 6) AS auc, round(avg_precision, 6) AS avg_precision,
       round(optimal_threshold, 6) AS optimal_threshold, round(sensitivity, 6) AS sensitivity,
       round(specificity, 6) AS specificity, round(precision, 6) AS precision,
       round(f1_score, 6) AS f1_score, tp, fp, tn, fn"""

ORACLE["metrics_row"] = with_(FC, curve("fc"), metrics_sql()) + \
    f"SELECT 'test' AS dataset, {METRIC_SELECT} FROM cv_row"

ORACLE["calibration"] = with_(FC) + """
SELECT CAST((score > 0.1)::INT + (score > 0.2)::INT + (score > 0.30000000000000004)::INT + (score > 0.4)::INT
       + (score > 0.5)::INT + (score > 0.6000000000000001)::INT + (score > 0.7000000000000001)::INT
       + (score > 0.8)::INT + (score > 0.9)::INT AS INTEGER) AS bin,
       round(avg(score), 6) AS prob_pred, round(avg(CAST(y AS DOUBLE)), 6) AS prob_true, count(*) AS n
FROM fc WHERE score IS NOT NULL GROUP BY 1"""

ORACLE["base_rate"] = with_(FC) + "SELECT round(avg(CAST(y AS DOUBLE)), 6) AS base_rate FROM fc"

ORACLE["metric_lookup"] = with_(FC, curve("fc"), metrics_sql()) + """
SELECT 'holdout' AS dataset, round(auc, 6) AS auc, round(optimal_threshold, 6) AS optimal_threshold FROM cv_row
UNION ALL SELECT 'missing', 0.81, 0.5"""

ORACLE["quality_gate"] = with_(FC, curve("fc"), metrics_sql()) + """
SELECT round(auc, 6) AS value, 0.8 AS minimum, auc >= 0.8 AS passed FROM cv_row"""

# ---------------------------------------------------------- F-B cleaning CTEs
FB_DIM = """
fb_dim AS (SELECT * FROM (VALUES (0, 'COLD', CAST(5.1 AS DOUBLE), 'Permanent', 12),
                                 (1, 'ol', CAST(4.0 AS DOUBLE), 'Street', 10),
                                 (2, 'smal', CAST(3.3 AS DOUBLE), 'Street', 19),
                                 (3, 'HOT', CAST(5.9 AS DOUBLE), 'Permanent', 18),
                                 (4, 'New', CAST(4.3 AS DOUBLE), 'Street', 14))
           t(ord, k, TrackLength, TrackType, Corners))"""


def track_cte(src: str, out: str) -> str:
    """P8 + J4 over ``src``: TrackId, then the last contained dimension key."""
    return f"""
{out}_0 AS (SELECT *, split_part(EventName, '_', 1) AS TrackId FROM {src}),
{out}_m AS (SELECT t.TrackId, arg_max(d.TrackLength, d.ord) AS TrackLength,
                   arg_max(d.TrackType, d.ord) AS TrackType, arg_max(d.Corners, d.ord) AS Corners
            FROM (SELECT DISTINCT TrackId FROM {out}_0) t
            JOIN fb_dim d ON contains(lower(t.TrackId), lower(d.k)) GROUP BY t.TrackId),
{out} AS (SELECT f.*, coalesce(m.TrackLength, CAST(5.0 AS DOUBLE)) AS TrackLength,
                 coalesce(m.TrackType, 'Unknown') AS TrackType, CAST(coalesce(m.Corners, 15) AS INTEGER) AS Corners
          FROM {out}_0 f LEFT JOIN {out}_m m ON f.TrackId = m.TrackId)"""


FB_VALID = """
fb_valid AS (SELECT *, LapTime AS LapTime_seconds FROM fb_laps
             WHERE SessionType = 'Q' OR (SessionType = 'R' AND LapTime IS NOT NULL AND coalesce(IsAccurate, false)))"""

FB_CLEAN = FB_VALID + "," + FB_DIM + "," + track_cte("fb_valid", "fb_trk") + """,
fb_b AS (SELECT * REPLACE (coalesce(SafetyCar, false) AS SafetyCar, coalesce(VirtualSafetyCar, false) AS VirtualSafetyCar,
                           coalesce(YellowFlag, false) AS YellowFlag, coalesce(FreshTyre, false) AS FreshTyre)
         FROM fb_trk),
fb_m1 AS (SELECT TrackId, median(SpeedI1) AS m1, median(SpeedST) AS m2, median(TyreLife) AS m3
          FROM fb_b GROUP BY TrackId),
fb_g1 AS (SELECT b.* REPLACE (coalesce(b.SpeedI1, m.m1) AS SpeedI1, coalesce(b.SpeedST, m.m2) AS SpeedST,
                              coalesce(b.TyreLife, m.m3) AS TyreLife)
          FROM fb_b b LEFT JOIN fb_m1 m ON b.TrackId = m.TrackId),
fb_gm AS (SELECT median(SpeedI1) AS m1, median(SpeedST) AS m2, median(TyreLife) AS m3 FROM fb_g1),
fb_g2 AS (SELECT g.* REPLACE (coalesce(g.SpeedI1, gm.m1) AS SpeedI1, coalesce(g.SpeedST, gm.m2) AS SpeedST,
                              coalesce(g.TyreLife, gm.m3) AS TyreLife)
          FROM fb_g1 g CROSS JOIN fb_gm gm),
fb_clean AS (SELECT * REPLACE (coalesce(Compound, 'Unknown') AS Compound, coalesce(Driver, 'Unknown') AS Driver,
                               coalesce(Team, 'Unknown') AS Team)
             FROM fb_g2 WHERE SessionType = 'R')"""

ORACLE["track_lookup"] = with_(FB_LAPS, FB_DIM, track_cte("fb_laps", "fb_t")) + """
SELECT l_orderkey, l_linenumber, EventName, TrackId, round(TrackLength, 6) AS TrackLength, TrackType, Corners
FROM fb_t"""

ORACLE["valid_laps"] = with_(FB_LAPS, FB_VALID) + """
SELECT l_orderkey, l_linenumber, SessionType, round(LapTime_seconds, 6) AS LapTime_seconds,
       SessionType = 'R' AS is_race FROM fb_valid"""

ORACLE["two_level_fill"] = with_(FB_LAPS, FB_CLEAN) + """
SELECT l_orderkey, l_linenumber, TrackId, round(SpeedI1, 6) AS SpeedI1, round(SpeedST, 6) AS SpeedST,
       round(TyreLife, 6) AS TyreLife FROM fb_clean"""

ORACLE["null_defaults"] = with_(FB_LAPS) + """
SELECT l_orderkey, l_linenumber, coalesce(Compound, 'Unknown') AS Compound,
       coalesce(VirtualSafetyCar, false) AS VirtualSafetyCar,
       coalesce(CAST(VirtualSafetyCar AS INTEGER), 0) AS vsc_int FROM fb_laps"""

ORACLE["race_median_fill"] = with_(FA_LAPS, FA_WEATHER) + """,
j AS (SELECT l.event_id, l.race, l.lap, w.air_temp, w.humidity
      FROM fa_laps l ASOF LEFT JOIN fa_weather w ON l.race = w.race AND l.start >= w.time),
m AS (SELECT race, median(air_temp) AS ma, median(humidity) AS mh FROM j GROUP BY race)
SELECT j.event_id, j.race, j.lap, round(coalesce(j.air_temp, m.ma), 6) AS air_temp,
       round(coalesce(j.humidity, m.mh), 6) AS humidity
FROM j LEFT JOIN m ON j.race = m.race"""

FB_INTER = """
fb_x AS (SELECT *, TyreLife * TrackTemp AS TyreLife_TrackTemp_interaction,
                TrackLength * SpeedST AS TrackLength_SpeedST_interaction,
                Rainfall * Corners AS Rainfall_Corners_interaction FROM fb_clean),
fb_tr AS (SELECT * FROM fb_x WHERE Year < 2001),
fb_ho AS (SELECT * FROM fb_x WHERE Year = 2001)"""

ORACLE["interactions"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + """
SELECT l_orderkey, l_linenumber, round(TyreLife_TrackTemp_interaction, 6) AS TyreLife_TrackTemp_interaction,
       round(TrackLength_SpeedST_interaction, 6) AS TrackLength_SpeedST_interaction,
       round(Rainfall_Corners_interaction, 6) AS Rainfall_Corners_interaction FROM fb_x"""

FB_NUMERIC = ["TrackLength", "Corners", "LapNumber", "Position", "TyreLife", "SpeedI1", "SpeedST", "AirTemp",
              "Rainfall", "TrackTemp", "TyreLife_TrackTemp_interaction", "TrackLength_SpeedST_interaction",
              "Rainfall_Corners_interaction"]
FB_BOOLEAN = ["FreshTyre", "VirtualSafetyCar", "YellowFlag"]


def _stats_cte() -> str:
    parts = []
    for c in FB_NUMERIC:
        parts.append(f"""SELECT '{c}' AS feature, med AS median, avg(coalesce(CAST({c} AS DOUBLE), med)) AS mean,
         coalesce(nullif(stddev_pop(coalesce(CAST({c} AS DOUBLE), med)), 0), 1) AS std
  FROM fb_tr CROSS JOIN (SELECT median(CAST({c} AS DOUBLE)) AS med FROM fb_tr) q GROUP BY med""")
    return "fb_stats AS (" + "\n  UNION ALL ".join(parts) + ")"


ORACLE["fit_stats"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, _stats_cte()) + """
SELECT feature, round(median, 6) AS median, round(mean, 6) AS mean, round(std, 6) AS std FROM fb_stats"""

FB_VOCAB = "fb_vocab AS (" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, v AS category, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS position "
    f"FROM (SELECT DISTINCT coalesce({c}, 'unknown') AS v FROM fb_tr) q" for c in ("Driver", "Team", "Compound")) + ")"

ORACLE["vocab"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, FB_VOCAB) + "SELECT feature, category, position FROM fb_vocab"

ORACLE["one_hot_sparse"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, FB_VOCAB) + "\nUNION ALL ".join(
    f"SELECT h.l_orderkey, h.l_linenumber, v.feature, v.position FROM fb_ho h "
    f"JOIN fb_vocab v ON v.feature = '{c}' AND v.category = coalesce(h.{c}, 'unknown')" for c in ("Driver", "Team", "Compound"))

ORACLE["gbt_scores"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + """
SELECT l_orderkey, l_linenumber, RaceId, LapNumber, true AS consistent FROM fb_ho"""

ORACLE["model_round_trip"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + """
SELECT l_orderkey, l_linenumber, true AS same FROM fb_ho"""

ORACLE["cv_auc"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + """,
st AS (SELECT RaceId, LapNumber, bool_or(coalesce(SafetyCar, false)) AS cur FROM fb_tr
       WHERE RaceId IS NOT NULL AND LapNumber IS NOT NULL GROUP BY 1, 2),
lab AS (SELECT a.RaceId, a.LapNumber FROM st a JOIN st b ON a.RaceId = b.RaceId AND b.LapNumber = a.LapNumber + 1
        WHERE b.cur AND NOT a.cur AND a.LapNumber >= 1),
y AS (SELECT CASE WHEN l.RaceId IS NULL THEN 0 ELSE 1 END AS y FROM fb_tr t
      LEFT JOIN lab l ON t.RaceId = l.RaceId AND t.LapNumber = l.LapNumber),
f AS (SELECT y, (row_number() OVER (PARTITION BY y) - 1) % 5 AS fold FROM y)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, true AS auc_ok FROM f GROUP BY fold"""


def _scaled_select() -> str:
    cols = []
    for c in FB_NUMERIC:
        cols.append(f"round((coalesce(CAST(h.{c} AS DOUBLE), s_{c}.median) - s_{c}.mean) / s_{c}.std, 6) AS {c}")
    for c in FB_BOOLEAN:
        cols.append(f"CAST(coalesce(CAST(h.{c} AS INTEGER), 0) AS DOUBLE) AS {c}")
    joins = " ".join(f"CROSS JOIN (SELECT * FROM fb_stats WHERE feature = '{c}') s_{c}" for c in FB_NUMERIC)
    return "SELECT h.l_orderkey, h.l_linenumber, " + ", ".join(cols) + f" FROM fb_ho h {joins}"


ORACLE["scaled_features"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, _stats_cte()) + _scaled_select()

ORACLE["model_unit"] = ORACLE["scaled_features"].replace("SELECT h.l_orderkey,", "SELECT true AS same, h.l_orderkey,")

ONE_HOT = {"Team": ["0", "1", "2", "3", "4"], "Compound": ["A", "N", "R", "Unknown"]}

ORACLE["one_hot"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"CASE WHEN coalesce({c}, 'unknown') = '{v}' THEN 1.0 ELSE 0.0 END AS {c}_{v}"
    for c, vs in ONE_HOT.items() for v in vs) + " FROM fb_ho"

ORACLE["passthrough"] = with_(FB_LAPS, FB_CLEAN, FB_INTER) + """
SELECT l_orderkey, l_linenumber, RaceId, Driver, EventName, SessionType, TrackId, TrackType, SafetyCar,
       round(LapTime_seconds, 6) AS LapTime_seconds FROM fb_ho"""

LINEAR = {"TyreLife": 0.01, "TrackTemp": 0.05, "LapNumber": 0.02, "SpeedST": 0.00002, "Position": -0.1}

ORACLE["linear_attribution"] = with_(FB_LAPS, FB_CLEAN) + """,
mu AS (SELECT """ + ", ".join(f"avg({f}) AS {f}" for f in LINEAR) + """ FROM fb_clean)
""" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, round(avg(abs({w} * (CAST(s.{f} AS DOUBLE) - mu.{f}))), 6) AS mean_abs "
    f"FROM fb_clean s CROSS JOIN mu" for f, w in LINEAR.items())

ORACLE["lap_attribution"] = with_(FB_LAPS, FB_CLEAN) + """,
mu AS (SELECT """ + ", ".join(f"avg({f}) AS {f}" for f in LINEAR) + """ FROM fb_clean),
one AS (SELECT * FROM fb_clean WHERE RaceId = '1997_03_R'
        ORDER BY LapNumber, l_orderkey, l_linenumber, Driver, SpeedST LIMIT 1)
""" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, round({w} * (CAST(s.{f} AS DOUBLE) - mu.{f}), 6) AS attribution "
    f"FROM one s CROSS JOIN mu" for f, w in LINEAR.items())

FA_REQ = """
fa_req0 AS (SELECT *, lpad(CAST(race % 100 AS VARCHAR), 2, '0') || '_Ev' || CAST(race AS VARCHAR) || '_' || driver AS rid
            FROM fa_laps),
fa_req AS (
  SELECT event_id,
         CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'Y_' || rid ELSE '2024_' || rid END AS race_id,
         CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 'L' || CAST(lap AS VARCHAR)
              ELSE CAST(lap AS VARCHAR) END AS lap,
         CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS tyre
  FROM fa_req0),
fa_v AS (
  SELECT *, race_id IS NULL OR lap IS NULL AS missing, TRY_CAST(trim(lap) AS INTEGER) AS lap_i,
         TRY_CAST(split_part(race_id, '_', 1) AS INTEGER) AS y0,
         CASE WHEN regexp_matches(race_id, '^[^_]*_[^_]*_') THEN regexp_extract(race_id, '^[^_]*_[^_]*_(.*)$', 1)
              ELSE 'Unknown' END AS t0
  FROM fa_req),
fa_s AS (
  SELECT *, coalesce(CAST(tyre AS INTEGER), 10) AS TyreLife, 30 AS TrackTemp FROM fa_v
  WHERE NOT missing AND lap_i IS NOT NULL),
fa_p AS (
  SELECT *, 1.0 / (1.0 + exp(-(-3.0 + 0.01 * TyreLife + 0.02 * TrackTemp + 0.05 * lap_i
                                  + 0.001 * (TyreLife * TrackTemp)))) AS p FROM fa_s)"""

ORACLE["score_requests"] = with_(FA_LAPS, FA_REQ) + """
SELECT event_id, race_id, lap_i AS lap, CASE WHEN y0 IS NULL THEN 2024 ELSE y0 END AS year,
       CASE WHEN y0 IS NULL THEN 'Unknown' ELSE t0 END AS track, round(p, 6) AS probability,
       0.5 AS threshold, p >= 0.5 AS will_deploy_sc
FROM fa_p"""

ORACLE["request_errors"] = with_(FA_LAPS, FA_REQ) + """
SELECT event_id, race_id,
       CASE WHEN missing THEN 'Invalid request' ELSE 'Invalid value' END AS error,
       CASE WHEN missing THEN 'Missing required parameters: race_id, lap'
            ELSE 'invalid literal for int() with base 10: ''' || lap || '''' END AS message
FROM fa_v WHERE missing OR lap_i IS NULL"""

# ------------------------------------------------------------------ reports
SCORE_SQL = "1.0 / (1.0 + exp(-(-2.0 + " + " + ".join(f"({w}) * CAST({f} AS DOUBLE)" for f, w in LINEAR.items()) + ")))"

ORACLE["lap_risk"] = with_(FB_LAPS, FB_CLEAN) + f""",
sc AS (SELECT *, {SCORE_SQL} AS p FROM fb_clean)
SELECT RaceId, LapNumber, round(avg(p), 6) AS sc_probability, bool_or(coalesce(SafetyCar, false)) AS SafetyCar,
       0.5 AS threshold
FROM sc GROUP BY RaceId, LapNumber"""

ORACLE["race_summary"] = with_(FB_LAPS, FB_CLEAN) + """,
f AS (SELECT RaceId, TrackId, Year, TrackLength, Corners,
             row_number() OVER (PARTITION BY RaceId ORDER BY LapNumber, TrackId, Year, TrackLength, Corners) AS rn
      FROM fb_clean),
a AS (SELECT RaceId, min(LapNumber) AS min_lap, max(LapNumber) AS max_lap, median(AirTemp) AS m1,
             median(TrackTemp) AS m2, median(Rainfall) AS m3 FROM fb_clean GROUP BY RaceId)
SELECT a.RaceId, f.TrackId, f.Year, round(f.TrackLength, 6) AS TrackLength, f.Corners, a.min_lap, a.max_lap,
       round(a.m1, 6) AS median_AirTemp, round(a.m2, 6) AS median_TrackTemp, round(a.m3, 6) AS median_Rainfall
FROM a JOIN f ON a.RaceId = f.RaceId AND f.rn = 1"""

ORACLE["race_list"] = with_(FB_LAPS, FB_CLEAN) + """
SELECT DISTINCT RaceId, 'Race: ' || RaceId AS display_name FROM fb_clean WHERE RaceId IS NOT NULL"""

ORACLE["race_rows"] = with_(FB_LAPS, FB_CLEAN) + """
SELECT l_orderkey, l_linenumber, LapNumber, Driver FROM fb_clean WHERE RaceId = '1997_03_R'"""

ORACLE["race_rows_parse"] = with_(FB_LAPS) + """
SELECT DISTINCT RaceId, TRY_CAST(split_part(RaceId, '_', 1) AS INTEGER) AS year,
       TRY_CAST(split_part(RaceId, '_', 2) AS INTEGER) AS round FROM fb_laps"""

ORACLE["rows_per_season"] = with_(FB_LAPS) + "SELECT Year, count(*) AS laps FROM fb_laps GROUP BY Year"

ORACLE["rows_per_event"] = with_(FB_LAPS) + """
SELECT Year, EventName, count(*) AS laps FROM fb_laps GROUP BY Year, EventName ORDER BY Year, EventName LIMIT 20"""

FB_COLUMNS = ["l_orderkey", "l_linenumber", "RaceId", "Year", "LapNumber", "Driver", "Team", "Compound",
              "EventName", "SessionType", "IsAccurate", "LapTime", "TyreLife", "SpeedST", "SpeedI1", "TrackTemp",
              "Position", "AirTemp", "Rainfall", "FreshTyre", "YellowFlag", "VirtualSafetyCar", "SafetyCar"]

ORACLE["null_fraction"] = with_(FB_LAPS) + ",\nnf AS (" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_fraction FROM fb_laps"
    for c in FB_COLUMNS) + """)
SELECT "column", round(null_fraction, 6) AS null_fraction FROM nf ORDER BY null_fraction DESC, "column" LIMIT 10"""

FB_SC = """
fb_sc AS (SELECT *, CAST(coalesce(contains(TrackStatus, '4'), false) AS INTEGER) AS SC
          FROM (SELECT *, CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_orderkey % 1000 AS VARCHAR) END AS TrackStatus
                FROM fb_laps) q)"""

ORACLE["sc_flag"] = with_(FB_LAPS, FB_SC) + "SELECT l_orderkey, l_linenumber, TrackStatus, SC FROM fb_sc"

ORACLE["value_share"] = with_(FB_LAPS, FB_SC) + """
SELECT SC, count(*) AS n, round(count(*) / (SELECT count(*) FROM fb_sc WHERE SC IS NOT NULL), 6) AS share
FROM fb_sc WHERE SC IS NOT NULL GROUP BY SC"""

ORACLE["shape"] = with_(FB_LAPS) + f"SELECT count(*) AS rows, {len(FB_COLUMNS)} AS columns FROM fb_laps"

ORACLE["preview"] = with_(FB_LAPS) + """
SELECT l_orderkey, l_linenumber, SpeedST, RaceId FROM fb_laps ORDER BY l_orderkey, l_linenumber, SpeedST, RaceId LIMIT 3"""

# ------------------------------------------------------------- F-D sessions
FD = """
fd_s AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS round
         FROM orders),
fd_schedule AS (SELECT year, round, make_date(year, round, 1) AS event_date, 'Event ' || CAST(round AS VARCHAR) AS event_name
                FROM fd_s),
fd_catalog AS (SELECT year, round, 'R' AS session_type FROM fd_schedule WHERE round % 3 <> 0)"""

ORACLE["pending_sessions"] = with_(FD) + """
SELECT s.year, s.round, t.session_type
FROM fd_schedule s CROSS JOIN (VALUES ('Q'), ('R')) t(session_type)
WHERE s.event_date < DATE '1998-06-01'
  AND NOT EXISTS (SELECT 1 FROM fd_catalog c WHERE c.year = s.year AND c.round = s.round
                  AND c.session_type = t.session_type)"""

ORACLE["session_key"] = with_(FD) + """
SELECT year, round, printf('%d_%02d_%s_%s', year, round, replace(event_name, ' ', '_'), 'R') AS session_key
FROM fd_schedule"""

ORACLE["multi_file_scan"] = with_(FA_LAPS) + """
SELECT event_id, 'S' || (race % 4) AS RaceId, race, driver, lap,
       CASE WHEN race % 4 <> 3 THEN round(lap_time_s, 6) END AS lap_time_s FROM fa_laps"""

ORACLE["session_kinds"] = with_(FA_LAPS, FA_STATUS, FA_WEATHER) + """
SELECT 'laps' AS kind, 'S' || (race % 4) AS RaceId, count(*) AS n, 0 AS unreadable FROM fa_laps GROUP BY 2
UNION ALL SELECT 'track_status', 'S' || (race % 4), count(*), 0 FROM fa_status GROUP BY 2
UNION ALL SELECT 'weather', 'S' || (race % 4), count(*), 0 FROM fa_weather GROUP BY 2
UNION ALL SELECT 'damaged', 'S9', 0, 1"""

ORACLE["verified_scan"] = ORACLE["multi_file_scan"]

ORACLE["file_manifest"] = with_(FA_LAPS) + """
SELECT 'S' || (race % 4) AS RaceId, count(*) AS n, CASE WHEN race % 4 = 3 THEN 4 ELSE 5 END AS n_columns,
       CASE race % 4 WHEN 1 THEN 'int64' WHEN 2 THEN 'double' ELSE 'int32' END AS lap_type, 1 AS readable, CAST(NULL AS VARCHAR) AS error
FROM fa_laps GROUP BY 1, 3, 4
UNION ALL SELECT 'S9', NULL, NULL, NULL, 0, 'no Parquet footer'"""

ORACLE["partitioned_scan"] = with_(FA_LAPS) + """
SELECT event_id, race, driver, lap, round(lap_time_s, 6) AS lap_time_s FROM fa_laps"""

ORACLE["tagged_union"] = with_(FA_LAPS) + """
SELECT event_id, race, driver, lap, round(CASE WHEN driver = 'purchase' THEN NULL ELSE lap_time_s END, 6) AS lap_time_s,
       2024 AS Year, CASE driver WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS Round,
       'Event ' || driver AS EventName, 'R' AS SessionType
FROM fa_laps"""

ORACLE["stream_scores"] = ORACLE["score_requests"]

ORACLE["season_job"] = with_(FB_LAPS, FB_SC) + """
SELECT l_orderkey, l_linenumber, Year AS Season, EventName, SC FROM fb_sc WHERE SessionType = 'R'"""

PROFILE_COLUMNS = ["l_orderkey", "l_linenumber", "SpeedST", "EventName", "TrackStatus", "Compound", "SessionType", "Year", "SC", "Season"]

ORACLE["profile_report"] = with_(FB_LAPS, FB_SC) + """,
s AS (SELECT *, Year AS Season FROM fb_sc WHERE SessionType = 'R'),
nf AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS item, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS v FROM s" for c in PROFILE_COLUMNS) + """)
SELECT 'shape' AS section, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM s
UNION ALL SELECT 'shape', 'columns', """ + str(len(PROFILE_COLUMNS)) + """.0, NULL
UNION ALL (SELECT 'preview', l_orderkey || '_' || l_linenumber, round(SpeedST, 6), EventName FROM s ORDER BY l_orderkey, l_linenumber, SpeedST LIMIT 3)
UNION ALL (SELECT 'nulls', item, round(v, 6), NULL FROM nf ORDER BY v DESC, item LIMIT 10)
UNION ALL SELECT 'per_season', CAST(Season AS VARCHAR), count(*), NULL FROM s GROUP BY Season
UNION ALL (SELECT 'per_event', Season || ' ' || EventName, count(*), NULL FROM s GROUP BY Season, EventName ORDER BY Season, EventName LIMIT 20)
UNION ALL SELECT 'flag_share', CAST(SC AS VARCHAR), round(count(*) / (SELECT count(*) FROM s), 6), NULL FROM s GROUP BY SC"""

ORACLE["model_requests"] = with_(FA_LAPS, FA_REQ) + """
SELECT event_id, NOT missing AND lap_i IS NOT NULL AS scored, true AS consistent FROM fa_v"""

# ------------------------------------------------------------- F-M: end-to-end jobs
_NAMES = "[" + ", ".join(f"'{t[0]}'" for t in TRACKS) + "]"
_KEY = f"printf('%d_%02d_%s_R', CAST(race % 5 + 2020 AS INTEGER), CAST(race % 24 + 1 AS INTEGER), {_NAMES}[CAST(race % {len(TRACKS)} AS INTEGER) + 1])"
_DIM = ", ".join(f"({i}, '{k}', CAST({n} AS DOUBLE), {c})" for i, (k, n, _, c) in enumerate(TRACKS))

FM = f"""
fm_laps AS (
  SELECT event_id, {_KEY} AS RaceId, driver AS Driver, lap AS LapNumber, start, lap_time_s,
         CASE WHEN event_id % 7 = 0 THEN 'Q' ELSE 'R' END AS SessionType, event_id % 10 <> 0 AS IsAccurate,
         {_NAMES}[CAST(race % {len(TRACKS)} AS INTEGER) + 1] AS EventName
  FROM fa_laps),
fm_status AS (SELECT {_KEY} AS RaceId, time, status FROM fa_status),
fm_weather AS (
  SELECT RaceId, time, air_temp AS AirTemp FROM (
    SELECT {_KEY} AS RaceId, time, air_temp, row_number() OVER (
      PARTITION BY {_KEY}, time ORDER BY air_temp DESC NULLS LAST, humidity DESC NULLS LAST, event_id % 9 = 0 DESC,
      event_id % 360 DESC) AS rn FROM fa_weather) q WHERE rn = 1),
fm_next AS (SELECT RaceId, Driver, LapNumber - 1 AS lap, min(start) AS next_start FROM fm_laps
            WHERE start IS NOT NULL GROUP BY 1, 2, 3),
fm_iv AS (
  SELECT l.*, CASE WHEN l.start IS NOT NULL THEN coalesce(n.next_start,
           l.start + to_microseconds(CAST(round(l.lap_time_s * 1000000) AS BIGINT)), l.start + INTERVAL 120 SECOND) END AS stop
  FROM fm_laps l LEFT JOIN fm_next n ON l.RaceId = n.RaceId AND l.Driver = n.Driver AND l.LapNumber = n.lap),
fm_fl AS (
  SELECT i.RaceId, i.Driver, i.LapNumber, bool_or(s.status = '2') AS YellowFlag, bool_or(s.status = '4') AS SafetyCar,
         bool_or(s.status = '5') AS RedFlag, bool_or(s.status = '6') AS VirtualSafetyCar
  FROM fm_iv i JOIN fm_status s ON s.RaceId = i.RaceId AND s.time >= i.start AND s.time < i.stop GROUP BY 1, 2, 3),
fm_wx AS (SELECT i.*, w.AirTemp FROM fm_iv i ASOF LEFT JOIN fm_weather w ON i.RaceId = w.RaceId AND i.start >= w.time),
fm_med AS (SELECT RaceId, median(AirTemp) AS m FROM fm_wx GROUP BY RaceId),
fm_merged AS (
  SELECT x.* REPLACE (coalesce(x.AirTemp, m.m) AS AirTemp), coalesce(f.YellowFlag, false) AS YellowFlag,
         coalesce(f.SafetyCar, false) AS SafetyCar, coalesce(f.RedFlag, false) AS RedFlag,
         coalesce(f.VirtualSafetyCar, false) AS VirtualSafetyCar, split_part(x.EventName, '_', 1) AS TrackId
  FROM fm_wx x LEFT JOIN fm_med m ON x.RaceId = m.RaceId
  LEFT JOIN fm_fl f ON x.RaceId = f.RaceId AND x.Driver = f.Driver AND x.LapNumber = f.LapNumber),
fm_dim AS (SELECT * FROM (VALUES {_DIM}) t(ord, k, TrackLength, Corners)),
fm_trk AS (SELECT t.TrackId, arg_max(d.TrackLength, d.ord) AS TrackLength, arg_max(d.Corners, d.ord) AS Corners
           FROM (SELECT DISTINCT TrackId FROM fm_merged) t JOIN fm_dim d ON contains(lower(t.TrackId), lower(d.k)) GROUP BY 1),
fm_clean AS (
  SELECT m.*, coalesce(t.TrackLength, CAST(5.0 AS DOUBLE)) AS TrackLength, CAST(coalesce(t.Corners, 15) AS INTEGER) AS Corners,
         CAST(split_part(m.RaceId, '_', 1) AS INTEGER) AS Year
  FROM fm_merged m LEFT JOIN fm_trk t ON m.TrackId = t.TrackId
  WHERE SessionType = 'R' AND lap_time_s IS NOT NULL AND IsAccurate),
fm_st AS (SELECT RaceId, LapNumber, bool_or(SafetyCar) AS cur FROM fm_clean GROUP BY 1, 2),
fm_lab AS (SELECT a.RaceId, a.LapNumber FROM fm_st a JOIN fm_st b ON a.RaceId = b.RaceId AND b.LapNumber = a.LapNumber + 1
           WHERE b.cur AND NOT a.cur AND a.LapNumber >= 1),
fm_keys AS (SELECT RaceId, row_number() OVER (ORDER BY {hash_key("RaceId")}) AS rk, count(*) OVER () AS n
            FROM (SELECT DISTINCT RaceId FROM fm_clean WHERE Year <> 2024) q),
fm_full AS (
  SELECT c.*, CASE WHEN l.RaceId IS NULL THEN 0 ELSE 1 END AS sc_next_lap,
         CASE WHEN c.Year = 2024 THEN 'holdout' WHEN k.rk <= floor(k.n * 0.2) THEN 'test' ELSE 'train' END AS part
  FROM fm_clean c LEFT JOIN fm_lab l ON c.RaceId = l.RaceId AND c.LapNumber = l.LapNumber
  LEFT JOIN fm_keys k ON c.RaceId = k.RaceId)"""

FM_ALL = with_(FA_LAPS, FA_STATUS, FA_WEATHER, FM)

ORACLE["transform_job"] = FM_ALL + """
SELECT event_id, RaceId, Driver, LapNumber, SafetyCar, YellowFlag, RedFlag, VirtualSafetyCar, round(AirTemp, 6) AS AirTemp,
       TrackId, round(TrackLength, 6) AS TrackLength, Corners, sc_next_lap, Year, part FROM fm_full"""

ORACLE["stored_transform"] = ORACLE["transform_job"]

ORACLE["train_job"] = FM_ALL + """,
p AS (SELECT part, CAST(count(*) AS DOUBLE) AS n, CAST(sum(sc_next_lap) AS DOUBLE) AS pos FROM fm_full WHERE part <> 'train' GROUP BY part)
SELECT 'rows' AS section, part AS item, n AS value, CAST(NULL AS VARCHAR) AS text FROM p
UNION ALL SELECT 'positives', part, pos, NULL FROM p
UNION ALL SELECT 'auc_in_range', part, 1.0, NULL FROM p
UNION ALL SELECT 'gate', 'holdout', 1.0, NULL
UNION ALL SELECT 'cv', 'train', 1.0, NULL"""

ORACLE["race_report"] = FM_ALL + """,
r AS (SELECT * FROM fm_full WHERE RaceId = (SELECT max(RaceId) FROM fm_full))
SELECT 'races' AS section, RaceId AS item, CAST(NULL AS DOUBLE) AS value, 'Race: ' || RaceId AS text FROM (SELECT DISTINCT RaceId FROM fm_full) q
UNION ALL SELECT 'rows', CAST(LapNumber AS VARCHAR), count(*), NULL FROM r GROUP BY LapNumber
UNION ALL SELECT 'lap_risk', CAST(LapNumber AS VARCHAR), 1.0, CAST(bool_or(SafetyCar) AS VARCHAR) FROM r GROUP BY LapNumber
UNION ALL SELECT 'summary', 'laps', max(LapNumber) - min(LapNumber), NULL FROM r
UNION ALL SELECT 'summary', 'TrackLength', round(min(TrackLength), 6), min(TrackId) FROM r
UNION ALL SELECT 'summary', 'median_AirTemp', round(median(AirTemp), 6), NULL FROM r
UNION ALL SELECT 'importance', 'sum', 1.0, NULL"""

ORACLE["api_requests"] = with_(FA_LAPS, FA_REQ) + """
SELECT event_id, lap_i AS lap,
       round(1.0 / (1.0 + exp(-(-3.0 + 0.01 * coalesce(CAST(tyre AS INTEGER), 10) + 0.001 * 300.0 + 0.1 * 5.412
                                + 0.01 * 15))), 6) AS probability,
       1.0 / (1.0 + exp(-(-3.0 + 0.01 * coalesce(CAST(tyre AS INTEGER), 10) + 0.001 * 300.0 + 0.1 * 5.412
                          + 0.01 * 15))) >= 0.5 AS will_deploy_sc
FROM fa_v WHERE NOT missing AND lap_i IS NOT NULL"""

# ------------------------------------------------- boosted trees (F-B), grown in SQL
BOOST_CAT = ["Driver", "Team", "Compound"]
BOOST_NUM = ["TrackLength", "Corners", "LapNumber", "Position", "TyreLife", "AirTemp", "Rainfall", "TrackTemp"]
BOOST_BOOL = ["FreshTyre", "VirtualSafetyCar", "YellowFlag"]


def _boost_columns(src: str) -> str:
    """The features as the model reads them, numeric nulls filled with the training median."""
    cols = [f"coalesce(CAST({src}.{c} AS VARCHAR), 'unknown') AS x_{c}" for c in BOOST_CAT]
    cols += [f"coalesce(CAST({src}.{c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM fb_tr)) AS x_{c}" for c in BOOST_NUM]
    cols += [f"coalesce(CAST({src}.{c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM fb_tr)) AS x_{c}" for c in BOOST_BOOL]
    return ", ".join(cols)


BOOST_ROWS = """
bt_st AS (SELECT RaceId, LapNumber, bool_or(coalesce(SafetyCar, false)) AS cur FROM fb_tr
          WHERE RaceId IS NOT NULL AND LapNumber IS NOT NULL GROUP BY 1, 2),
bt_lab AS (SELECT a.RaceId, a.LapNumber FROM bt_st a JOIN bt_st b ON a.RaceId = b.RaceId AND b.LapNumber = a.LapNumber + 1
           WHERE b.cur AND NOT a.cur AND a.LapNumber >= 1),
bt_y AS (SELECT t.*, CASE WHEN l.RaceId IS NULL THEN 0 ELSE 1 END AS y FROM fb_tr t
         LEFT JOIN bt_lab l ON t.RaceId = l.RaceId AND t.LapNumber = l.LapNumber),
bt_n AS (SELECT count_if(y = 0) / CAST(count_if(y = 1) AS DOUBLE) AS w FROM bt_y),
bt AS (SELECT bt_y.l_orderkey, bt_y.l_linenumber, y, """ + _boost_columns("bt_y") + """,
              CAST((row_number() OVER (PARTITION BY y ORDER BY """ + hash_key("l_orderkey", "l_linenumber", "Driver") + """) - 1) % 5 AS INTEGER) AS fold,
              CASE WHEN y = 1 THEN -0.5 * w ELSE 0.5 END AS g, CASE WHEN y = 1 THEN 0.25 * w ELSE 0.25 END AS h
       FROM bt_y CROSS JOIN bt_n)"""


def best_split(name: str, src: str) -> str:
    """CTE with the best split of ``src``: every value of every numeric feature and every category is tried."""
    tried = []
    for i, c in enumerate(BOOST_CAT):
        tried.append(f"SELECT {i} AS i, '{c}' AS feature, CAST(NULL AS DOUBLE) AS threshold, x_{c} AS category, "
                     f"(SELECT sum(g) FROM {src}) - sum(g) AS gl, (SELECT sum(h) FROM {src}) - sum(h) AS hl FROM {src} GROUP BY x_{c}")
    for i, c in enumerate(BOOST_NUM + BOOST_BOOL, len(BOOST_CAT)):
        before = "OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        tried.append(f"SELECT {i}, '{c}', v, NULL, sum(g) {before}, sum(h) {before} "
                     f"FROM (SELECT x_{c} AS v, sum(g) AS g, sum(h) AS h FROM {src} GROUP BY 1) q")
    return f"""
{name}_t AS ({' UNION ALL '.join(tried)}),
{name}_a AS (SELECT sum(g) AS g, sum(h) AS h FROM {src}),
{name} AS (SELECT t.*, a.g, a.h, round(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1), 9) AS gain
           FROM {name}_t t CROSS JOIN {name}_a a WHERE hl >= 1 AND h - hl >= 1
           ORDER BY gain DESC, i, threshold, category LIMIT 1)"""


def goes_left(split: str, row: str) -> str:
    tests = [f"WHEN '{c}' THEN {row}.x_{c} <> {split}.category" for c in BOOST_CAT]
    tests += [f"WHEN '{c}' THEN {row}.x_{c} < {split}.threshold" for c in BOOST_NUM + BOOST_BOOL]
    return f"CASE {split}.feature {' '.join(tests)} END"


BOOST_DEPTH2 = ",".join([BOOST_ROWS, best_split("b0", "bt"),
                         f" btl AS (SELECT bt.* FROM bt CROSS JOIN b0 WHERE {goes_left('b0', 'bt')})",
                         f" btr AS (SELECT bt.* FROM bt CROSS JOIN b0 WHERE NOT {goes_left('b0', 'bt')})",
                         best_split("bl", "btl"), best_split("br", "btr")])
BOOST_HOLDOUT = f"bh AS (SELECT fb_ho.l_orderkey, fb_ho.l_linenumber, fb_ho.LapNumber, {_boost_columns('fb_ho')} FROM fb_ho)"


def _leaf(g: str, h: str) -> str:
    return f"-0.3 * ({g}) / ({h} + 1)"


def _node_row(path: str, split: str) -> str:
    return (f"SELECT '{path}' AS path, feature, round(threshold, 6) AS threshold, category, round(gain, 6) AS gain, round(h, 6) AS cover, "
            f"round({_leaf('g', 'h')}, 6) AS value FROM {split}")


def _leaf_rows(path: str, split: str) -> str:
    none = "CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), 0.0"
    return (f"SELECT '{path}L', {none}, round(hl, 6), round({_leaf('gl', 'hl')}, 6) FROM {split} UNION ALL "
            f"SELECT '{path}R', {none}, round(h - hl, 6), round({_leaf('g - gl', 'h - hl')}, 6) FROM {split}")


ORACLE["boosted_tree"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_DEPTH2) + "\nUNION ALL ".join(
    [_node_row("", "b0"), _node_row("L", "bl"), _node_row("R", "br"), _leaf_rows("L", "bl"), _leaf_rows("R", "br")])

ORACLE["boosted_scores"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_DEPTH2, BOOST_HOLDOUT, f"""
m AS (SELECT bh.l_orderkey, bh.l_linenumber,
             CASE WHEN {goes_left('b0', 'bh')}
                  THEN CASE WHEN {goes_left('bl', 'bh')} THEN {_leaf('bl.gl', 'bl.hl')} ELSE {_leaf('bl.g - bl.gl', 'bl.h - bl.hl')} END
                  ELSE CASE WHEN {goes_left('br', 'bh')} THEN {_leaf('br.gl', 'br.hl')} ELSE {_leaf('br.g - br.gl', 'br.h - br.hl')} END END AS z
      FROM bh CROSS JOIN b0 CROSS JOIN bl CROSS JOIN br)""") + """
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-z)), 6) AS sc_probability, CAST(1 / (1 + exp(-z)) >= 0.5 AS INTEGER) AS sc_prediction FROM m"""

_FOLDS = [f" f{k}_s AS (SELECT * FROM bt WHERE fold <> {k}),{best_split(f'f{k}', f'f{k}_s')}" for k in range(5)]
_FOLD_SCORES = "f_s AS (" + " UNION ALL ".join(
    f"SELECT fold, y, CASE WHEN {goes_left(f'f{k}', 'bt')} THEN {_leaf(f'f{k}.gl', f'f{k}.hl')} ELSE {_leaf(f'f{k}.g - f{k}.gl', f'f{k}.h - f{k}.hl')} END AS z "
    f"FROM bt CROSS JOIN f{k} WHERE fold = {k}" for k in range(5)) + ")"
ORACLE["boosted_folds"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_ROWS, *_FOLDS, _FOLD_SCORES, """
f_z AS (SELECT fold, z, sum(y) AS pos, sum(1 - y) AS neg FROM f_s GROUP BY 1, 2),
f_c AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY z DESC) AS tps FROM f_z)""") + """
SELECT fold, CAST(sum(pos + neg) AS BIGINT) AS rows, CAST(sum(pos) AS BIGINT) AS positives,
       round(sum(neg * (tps - pos / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)), 6) AS auc FROM f_c GROUP BY fold"""

_TREE_Z = f"""CASE WHEN {goes_left('b0', 'bj')}
                  THEN CASE WHEN {goes_left('bl', 'bj')} THEN {_leaf('bl.gl', 'bl.hl')} ELSE {_leaf('bl.g - bl.gl', 'bl.h - bl.hl')} END
                  ELSE CASE WHEN {goes_left('br', 'bj')} THEN {_leaf('br.gl', 'br.hl')} ELSE {_leaf('br.g - br.gl', 'br.h - br.hl')} END END"""
ORACLE["boosted_job"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_DEPTH2, f"""
bj_st AS (SELECT RaceId, LapNumber, bool_or(coalesce(SafetyCar, false)) AS cur FROM fb_ho
          WHERE RaceId IS NOT NULL AND LapNumber IS NOT NULL GROUP BY 1, 2),
bj_lab AS (SELECT a.RaceId, a.LapNumber FROM bj_st a JOIN bj_st b ON a.RaceId = b.RaceId AND b.LapNumber = a.LapNumber + 1
           WHERE b.cur AND NOT a.cur AND a.LapNumber >= 1),
bj AS (SELECT CASE WHEN l.RaceId IS NULL THEN 0 ELSE 1 END AS y, {_boost_columns('fb_ho')}
       FROM fb_ho LEFT JOIN bj_lab l ON fb_ho.RaceId = l.RaceId AND fb_ho.LapNumber = l.LapNumber),
bj_s AS (SELECT y, 1 / (1 + exp(-({_TREE_Z}))) AS score FROM bj CROSS JOIN b0 CROSS JOIN bl CROSS JOIN br)""",
                              curve("bj_s"), metrics_sql()) + f"SELECT 'holdout' AS dataset, {METRIC_SELECT} FROM cv_row"

BOOST_STUMP = BOOST_ROWS + "," + best_split("b0", "bt") + f""",
b0_v AS (SELECT *, {_leaf('gl', 'hl')} AS vl, {_leaf('g - gl', 'h - hl')} AS vr,
                feature || CASE WHEN category IS NULL THEN '' ELSE '_' || category END AS player FROM b0),
b0_b AS (SELECT *, (hl * vl + (h - hl) * vr) / h AS base FROM b0_v)"""

ORACLE["tree_attribution"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_STUMP, BOOST_HOLDOUT) + f"""
SELECT l_orderkey, l_linenumber, player AS feature, round(CASE WHEN {goes_left('b0_b', 'bh')} THEN vl ELSE vr END - base, 6) AS attribution,
       round(CASE WHEN {goes_left('b0_b', 'bh')} THEN vl ELSE vr END, 6) AS margin FROM bh CROSS JOIN b0_b"""

ORACLE["race_attribution"] = with_(FB_LAPS, FB_CLEAN, FB_INTER, BOOST_STUMP, f"""
br AS (SELECT fb_x.l_orderkey, fb_x.l_linenumber, fb_x.Driver, fb_x.SpeedST, fb_x.LapNumber, fb_x.SafetyCar, {_boost_columns('fb_x')} FROM fb_x WHERE RaceId = '1997_03_R'),
z AS (SELECT br.*, player, base, CASE WHEN {goes_left('b0_b', 'br')} THEN vl ELSE vr END AS z FROM br CROSS JOIN b0_b),
one AS (SELECT * FROM z WHERE LapNumber = 5 ORDER BY l_orderkey, l_linenumber, Driver, SpeedST LIMIT 1)""") + """
SELECT 'attribution' AS section, player AS item, round(z - base, 6) AS value, CAST(NULL AS VARCHAR) AS text FROM one
UNION ALL SELECT 'base', '5', round(base, 6), NULL FROM one UNION ALL SELECT 'margin', '5', round(z, 6), NULL FROM one
UNION ALL SELECT 'lap_risk', CAST(LapNumber AS VARCHAR), round(avg(1 / (1 + exp(-z))), 6), NULL FROM z GROUP BY LapNumber
UNION ALL SELECT 'flagged', CAST(LapNumber AS VARCHAR), CAST(count(*) AS DOUBLE), NULL FROM z WHERE coalesce(SafetyCar, false) GROUP BY LapNumber"""

# ------------------------------------------------- ledger, folders, raw bodies
FC_COARSE = "fc1 AS (SELECT doc_id, y, round(score, 1) AS score FROM fc)"
TWO_RUNS = with_(FC, FC_COARSE, curve("fc1", "c1"), metrics_sql("c1"), curve("fc", "c2"), metrics_sql("c2"))

ORACLE["metrics_ledger"] = TWO_RUNS + f"""
SELECT CAST(1 AS BIGINT) AS run_ts, 'holdout' AS dataset, {METRIC_SELECT} FROM c1_row
UNION ALL SELECT 2, 'holdout', {METRIC_SELECT} FROM c2_row"""

ORACLE["ledger_lookup"] = TWO_RUNS + """
SELECT 'holdout' AS dataset, round(auc, 6) AS auc, round(optimal_threshold, 6) AS optimal_threshold, auc >= 0.8 AS passed FROM c2_row
UNION ALL SELECT 'missing', 0.81, 0.5, true"""

ORACLE["deployed_requests"] = with_(FC, curve("fc", "c2"), metrics_sql("c2"), FA_LAPS, FA_REQ) + """,
scored AS (SELECT * FROM fa_p CROSS JOIN (SELECT optimal_threshold AS t FROM c2_row) q)
SELECT event_id, race_id, lap_i AS lap, CASE WHEN y0 IS NULL THEN 2024 ELSE y0 END AS year,
       CASE WHEN y0 IS NULL THEN 'Unknown' ELSE t0 END AS track, round(p, 6) AS probability,
       round(t, 6) AS threshold, p >= t AS will_deploy_sc, CAST(NULL AS VARCHAR) AS error FROM scored
UNION ALL SELECT event_id, race_id, CASE WHEN NOT missing THEN lap_i END, NULL, NULL, NULL, NULL, NULL,
       CASE WHEN missing THEN 'Invalid request' ELSE 'Invalid value' END FROM fa_v WHERE missing OR lap_i IS NULL"""

ORACLE["pending_in_folder"] = ORACLE["pending_sessions"]

FA_BODY = """
fa_b AS (SELECT *, CASE WHEN event_id % 31 = 0 THEN 'The body is not JSON'
                        WHEN event_id % 37 = 0 OR race_id IS NULL OR (lap IS NULL AND (event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 <> 0))
                        THEN 'Missing required parameters: race_id, lap'
                        WHEN event_id % 41 = 0 THEN 'lap_data must be an object' WHEN event_id % 43 = 0 THEN 'lap_data.TyreLife: not a number'
                        WHEN event_id % 47 = 0 THEN 'lap must be a number or text'
                        WHEN lap_i IS NULL THEN 'invalid literal for int() with base 10: \'\'' || lap || '\'\'' END AS message
         FROM fa_v),
fa_bp AS (SELECT *, 1.0 / (1.0 + exp(-(-3.0 + 0.01 * coalesce(CAST(tyre AS INTEGER), 10) + 0.02 * 30.0 + 0.05 * lap_i
                                       + 0.001 * (coalesce(CAST(tyre AS INTEGER), 10) * 30.0)))) AS p FROM fa_b)"""

ORACLE["request_bodies"] = with_(FA_LAPS, FA_REQ, FA_BODY) + """
SELECT event_id, CASE WHEN message IS NULL OR message LIKE 'Missing%' OR message LIKE 'invalid%' THEN CASE WHEN event_id % 37 <> 0 THEN race_id END END AS race_id,
       CASE WHEN message IS NULL THEN lap_i END AS lap, CASE WHEN message IS NULL THEN coalesce(y0, 2024) END AS year,
       CASE WHEN message IS NULL THEN CASE WHEN y0 IS NULL THEN 'Unknown' ELSE t0 END END AS track, CASE WHEN message IS NULL THEN round(p, 6) END AS probability,
       CASE WHEN message IS NULL THEN p >= 0.5 END AS will_deploy_sc,
       CASE WHEN message LIKE 'Missing%' OR message LIKE 'The body%' THEN 'Invalid request' WHEN message IS NOT NULL THEN 'Invalid value' END AS error, message
FROM fa_bp"""

ORACLE["body_stream"] = with_(FA_LAPS, FA_REQ, FA_BODY) + """
SELECT race_id, lap_i AS lap, CAST(NULL AS VARCHAR) AS message, count(*) AS n, round(max(p), 6) AS probability FROM fa_bp WHERE message IS NULL GROUP BY 1, 2
UNION ALL SELECT NULL, NULL, message, count(*), NULL FROM fa_bp WHERE message IS NOT NULL GROUP BY message"""
