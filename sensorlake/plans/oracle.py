"""ANSI SQL (DuckDB dialect) for each registered query: the independent
oracle the Spark plans are checked against. Views ``events`` etc. are the
driver's parquet tables. Names and conventions match ``plans.queries``."""

from __future__ import annotations

READINGS_RAW = """
SELECT event_id,
       CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_id % 103 = 0 THEN ' '
            WHEN event_id % 107 = 0 THEN ''
            ELSE concat('MANUFACTURING_0', CAST(user_id % 3 + 1 AS VARCHAR)) END AS sensor_id,
       CASE WHEN event_id % 109 = 0 THEN NULL ELSE ts END AS "timestamp",
       CASE WHEN event_id % 113 = 0 THEN NULL ELSE 298.0e0 + value END AS temperature,
       CASE WHEN event_id % 127 = 0 THEN NULL
            ELSE 28.0e0 + 0.55e0 * TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS humidity,
       CASE event_id % 3 WHEN 0 THEN 'csv' WHEN 1 THEN 'database' ELSE 'api' END AS source
FROM events
"""

READINGS_DUP = f"""
SELECT * FROM ({READINGS_RAW}) UNION ALL SELECT * FROM ({READINGS_RAW}) WHERE event_id % 20 = 0
"""

REASONS = """concat_ws(', ',
    CASE WHEN sensor_id IS NULL OR sensor_id = ' ' THEN 'Sensor ID is missing' END,
    CASE WHEN "timestamp" IS NULL THEN 'Timestamp is missing' END,
    CASE WHEN temperature IS NULL THEN 'Temperature is missing' END,
    CASE WHEN temperature IS NOT NULL AND (temperature < 300 OR temperature > 450)
         THEN 'Temperature is out of range' END,
    CASE WHEN humidity IS NULL THEN 'Humidity is missing' END,
    CASE WHEN humidity IS NOT NULL AND (humidity < 30 OR humidity > 80)
         THEN 'Humidity is out of range' END)"""


def _with(body: str, raw: str = READINGS_RAW) -> str:
    return f"""WITH raw AS ({raw}),
tagged AS (SELECT *, {REASONS} AS reasons FROM raw),
valid AS (SELECT event_id, sensor_id, "timestamp", temperature, humidity, source
          FROM tagged WHERE reasons = ''),
feat AS (
  SELECT *,
         temperature - lag(temperature) OVER w AS temperature_change,
         avg(temperature) OVER (PARTITION BY sensor_id
                                ORDER BY CAST(floor(epoch("timestamp")) AS BIGINT)
                                RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW) AS rolling_avg_temperature,
         lead(temperature, 12) OVER w AS target_temperature
  FROM valid
  WINDOW w AS (PARTITION BY sensor_id ORDER BY "timestamp", event_id)),
chrono AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id) AS row_num,
         count(*) OVER (PARTITION BY sensor_id) AS total_rows
  FROM feat WHERE target_temperature IS NOT NULL),
chrono_l AS (
  SELECT *, CASE WHEN row_num <= train_end THEN 'train'
                 WHEN row_num <= validation_end THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, CAST(floor(total_rows * CAST(0.70 AS DOUBLE)) AS BIGINT) AS train_end,
               CAST(floor(total_rows * CAST(0.85 AS DOUBLE)) AS BIGINT) AS validation_end FROM chrono)
  WHERE temperature_change IS NOT NULL),
refcur AS (
  SELECT *, CASE WHEN row_number <= CAST(floor(total_rows * CAST(0.80 AS DOUBLE)) AS BIGINT)
                 THEN 'reference' ELSE 'current' END AS slice
  FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", event_id) AS row_number,
               count(*) OVER () AS total_rows FROM valid))
{body}"""


FEATURE_COLS = """event_id, sensor_id, "timestamp", temperature, humidity, source,
       temperature_change, round(rolling_avg_temperature, 6) AS rolling_avg_temperature, target_temperature"""

DRIFT_LONG = """
SELECT column_name, statistic, round(reference_value, 6) AS reference_value,
       round(current_value, 6) AS current_value,
       round((current_value - reference_value) / NULLIF(reference_value, 0) * 100, 6) AS change_percent,
       CASE WHEN (current_value - reference_value) / NULLIF(reference_value, 0) IS NULL THEN 'UNKNOWN'
            WHEN abs((current_value - reference_value) / NULLIF(reference_value, 0) * 100) > 10.0 THEN 'DRIFT'
            ELSE 'OK' END AS status
FROM (
  SELECT 'temperature' AS column_name, 'mean' AS statistic,
         avg(temperature) FILTER (WHERE slice = 'reference') AS reference_value,
         avg(temperature) FILTER (WHERE slice = 'current') AS current_value FROM refcur
  UNION ALL
  SELECT 'temperature', 'stddev', stddev_samp(temperature) FILTER (WHERE slice = 'reference'),
         stddev_samp(temperature) FILTER (WHERE slice = 'current') FROM refcur
  UNION ALL
  SELECT 'humidity', 'mean', avg(humidity) FILTER (WHERE slice = 'reference'),
         avg(humidity) FILTER (WHERE slice = 'current') FROM refcur
  UNION ALL
  SELECT 'humidity', 'stddev', stddev_samp(humidity) FILTER (WHERE slice = 'reference'),
         stddev_samp(humidity) FILTER (WHERE slice = 'current') FROM refcur)
"""

PERSISTENCE_METRICS = """
SELECT round(avg((temperature - target_temperature) * (temperature - target_temperature)), 6) AS mse,
       round(avg(abs(temperature - target_temperature)), 6) AS mae,
       round(sqrt(avg((temperature - target_temperature) * (temperature - target_temperature))), 6) AS rmse,
       round(1 - avg((temperature - target_temperature) * (temperature - target_temperature))
                 / var_pop(target_temperature), 6) AS r2,
       CAST(count(*) AS BIGINT) AS n_rows
FROM chrono_l WHERE split = 'validation'
"""

FIRST_WINS = """
SELECT event_id, sensor_id, "timestamp", temperature, humidity, source FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp"
      ORDER BY CASE source WHEN 'csv' THEN 1 WHEN 'api' THEN 2 WHEN 'database' THEN 3 ELSE 4 END,
               event_id) AS rk
  FROM valid) WHERE rk = 1
"""

ORACLE: dict[str, str] = {
    "validate_reasons": _with("""SELECT event_id, reasons FROM tagged"""),
    "validate_valid": _with("""SELECT * FROM valid"""),
    "validate_invalid": _with("""SELECT * FROM tagged WHERE reasons <> ''"""),
    "validate_reason_counts": _with(
        """SELECT reasons, CAST(count(*) AS BIGINT) AS n_rows FROM tagged WHERE reasons <> '' GROUP BY reasons"""),
    "dq_summary": _with("""
SELECT CAST(count(*) AS BIGINT) AS total_rows,
       CAST(count(*) FILTER (WHERE reasons = '') AS BIGINT) AS valid_rows,
       CAST(count(*) FILTER (WHERE reasons <> '') AS BIGINT) AS invalid_rows,
       CAST(count(*) FILTER (WHERE sensor_id IS NULL OR sensor_id = ' ') AS BIGINT) AS missing_sensor_id,
       CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) AS missing_timestamp,
       CAST(count(*) FILTER (WHERE temperature IS NULL) AS BIGINT) AS missing_temperature,
       CAST(count(*) FILTER (WHERE temperature < 300 OR temperature > 450) AS BIGINT) AS temperature_out_of_range,
       CAST(count(*) FILTER (WHERE humidity IS NULL) AS BIGINT) AS missing_humidity,
       CAST(count(*) FILTER (WHERE humidity < 30 OR humidity > 80) AS BIGINT) AS humidity_out_of_range
FROM tagged"""),
    "sensor_counts": _with(
        """SELECT sensor_id, CAST(count(*) AS BIGINT) AS total_rows FROM valid GROUP BY sensor_id"""),
    "features_all": _with(f"""SELECT {FEATURE_COLS} FROM feat"""),
    "feat_change": _with("""SELECT event_id, sensor_id, "timestamp", temperature_change FROM feat"""),
    "feat_rolling": _with(
        """SELECT event_id, sensor_id, "timestamp", round(rolling_avg_temperature, 6) AS rolling_avg_temperature
FROM feat"""),
    "feat_target": _with("""SELECT event_id, sensor_id, "timestamp", target_temperature FROM feat"""),
    "split_chrono": _with("""
SELECT event_id, sensor_id, "timestamp", row_num, total_rows, train_end, validation_end, split
FROM chrono_l"""),
    "split_ref_current": _with("""SELECT event_id, "timestamp", row_number, total_rows, slice FROM refcur"""),
    "drift_stats": _with("""
SELECT slice, CAST(count(*) AS BIGINT) AS n_rows,
       round(avg(temperature), 6) AS temperature_mean, round(stddev_samp(temperature), 6) AS temperature_stddev,
       round(avg(humidity), 6) AS humidity_mean, round(stddev_samp(humidity), 6) AS humidity_stddev
FROM refcur GROUP BY slice"""),
    "drift_report": _with(DRIFT_LONG),
    "eval_metrics": _with(PERSISTENCE_METRICS),
    "quality_gate": _with(f"""
SELECT round(mae, 6) AS mae, 15.0e0 AS max_mae, mae <= 15.0 AS passed FROM (
  SELECT avg(abs(temperature - target_temperature)) AS mae FROM chrono_l WHERE split = 'validation')"""),
    "upsert_first_wins": _with(FIRST_WINS, raw=READINGS_DUP),
    "feature_store": _with("""
SELECT sensor_id, "timestamp", temperature, humidity, temperature_change,
       round(rolling_avg_temperature, 6) AS rolling_avg_temperature FROM feat"""),
    "feature_peek": _with("""
SELECT sensor_id, "timestamp", temperature, humidity, temperature_change,
       round(rolling_avg_temperature, 6) AS rolling_avg_temperature
FROM feat ORDER BY sensor_id, "timestamp" LIMIT 10"""),
}

_RAW_COLS = 'event_id, sensor_id, "timestamp", temperature, humidity, source'

ORACLE.update({
    "src_csv": _with("""SELECT event_id, 'MANUFACTURING_01' AS sensor_id, "timestamp", temperature, humidity,
       'csv' AS source FROM raw"""),
    "src_json": _with("""SELECT event_id, sensor_id, "timestamp", temperature, humidity, 'api' AS source FROM raw"""),
    "src_table": _with(
        """SELECT event_id, sensor_id, "timestamp", temperature, humidity, 'database' AS source FROM raw"""),
    "union_sources": _with("""SELECT event_id,
       CASE WHEN source = 'csv' THEN 'MANUFACTURING_01' ELSE sensor_id END AS sensor_id,
       "timestamp", temperature, humidity, source FROM raw"""),
    "incremental_table": _with(
        """SELECT event_id, sensor_id, "timestamp", temperature, humidity, source,
       humidity IS NULL AS is_faulty, CASE WHEN humidity IS NULL THEN 'missing_humidity' END AS fault_type,
       CASE WHEN event_id <= (SELECT max(event_id) // 2 FROM raw) THEN 1 ELSE 2 END AS pull FROM raw"""),
    "json_encode": _with(f"""SELECT {_RAW_COLS} FROM raw"""),
    "json_decode": _with(f"""SELECT {_RAW_COLS} FROM raw"""),
    "stream_valid": _with("""SELECT * FROM valid"""),
    "stream_invalid": _with(f"""SELECT {_RAW_COLS}, reasons FROM tagged WHERE reasons <> ''"""),
    "stream_dedup": _with("""SELECT DISTINCT * FROM valid""", raw=READINGS_DUP),
    "stream_csv_ingest": _with("""SELECT event_id, NULLIF(sensor_id, '') AS sensor_id, "timestamp", temperature,
       humidity, source, humidity IS NULL AS is_faulty, CASE WHEN humidity IS NULL THEN 'missing_humidity' END AS fault_type FROM raw"""),
})

CALIBRATE = """,
nums AS (SELECT event_id, temperature, humidity FROM raw WHERE temperature IS NOT NULL AND humidity IS NOT NULL),
d AS (SELECT *, temperature - lag(temperature) OVER (ORDER BY event_id) AS dt,
             humidity - lag(humidity) OVER (ORDER BY event_id) AS dh FROM nums),
m AS (SELECT count(*) AS n_rows, avg(temperature) AS temp_mean, stddev_pop(temperature) AS temp_std,
             min(temperature) AS temp_min, max(temperature) AS temp_max,
             avg(humidity) AS hum_mean, stddev_pop(humidity) AS hum_std,
             min(humidity) AS hum_min, max(humidity) AS hum_max,
             least(stddev_pop(dt), stddev_pop(temperature) * 0.1) AS ts,
             least(stddev_pop(dh), stddev_pop(humidity) * 0.1) AS hs,
             covar_pop(temperature, humidity) AS cov, var_pop(temperature) AS var_t FROM d)
SELECT CAST(n_rows AS BIGINT) AS n_rows, round(temp_mean, 6) AS temp_mean, round(temp_std, 6) AS temp_std,
       round(temp_min, 6) AS temp_min, round(temp_max, 6) AS temp_max, round(hum_mean, 6) AS hum_mean,
       round(hum_std, 6) AS hum_std, round(hum_min, 6) AS hum_min, round(hum_max, 6) AS hum_max,
       round(CASE WHEN ts IS NULL OR ts = 0 THEN 1.0 ELSE ts END, 6) AS temp_step,
       round(CASE WHEN hs IS NULL OR hs = 0 THEN 0.8 ELSE hs END, 6) AS hum_step,
       round(CASE WHEN var_t > 0 THEN greatest(-2.0, least(2.0, cov / var_t)) ELSE -0.5 END, 6) AS coupling,
       n_rows >= 3 AS enough_rows
FROM m"""


def _with_tail(tail: str, raw: str = READINGS_RAW) -> str:
    """Extra CTEs after the shared ones, then the final SELECT."""
    base = _with("", raw).rstrip()
    return base + tail


ORACLE.update({
    "calibrate": _with_tail(CALIBRATE),
    "feat_humidity_trend": _with("""
SELECT event_id, sensor_id, "timestamp",
       humidity - lag(humidity) OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id) AS humidity_trend
FROM valid"""),
    "eval_test_metrics": _with(PERSISTENCE_METRICS.replace("split = 'validation'", "split = 'test'")),
    "dashboard_summary": _with("""
SELECT a.*, l.latest_temperature, l.latest_humidity FROM (
  SELECT sensor_id, CAST(count(*) AS BIGINT) AS n_rows, min("timestamp") AS first_timestamp,
         max("timestamp") AS last_timestamp, round(avg(temperature), 6) AS avg_temperature,
         max(temperature) AS max_temperature, min(temperature) AS min_temperature,
         round(avg(humidity), 6) AS avg_humidity, max(humidity) AS max_humidity, min(humidity) AS min_humidity
  FROM valid GROUP BY sensor_id) a
JOIN (SELECT sensor_id, temperature AS latest_temperature, humidity AS latest_humidity FROM (
        SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY "timestamp" DESC, event_id DESC) AS rk
        FROM valid) WHERE rk = 1) l USING (sensor_id)"""),
    "dashboard_histogram": _with("""
SELECT sensor_id, column_name, bin, CAST(count(*) AS BIGINT) AS n_rows, min(lo + bin * w) AS bin_low FROM (
  SELECT sensor_id, 'temperature' AS column_name,
         least(greatest(CAST(floor((temperature - 300.0) / 10.0) AS BIGINT), 0), 14) AS bin,
         300.0e0 AS lo, 10.0e0 AS w FROM valid
  UNION ALL
  SELECT sensor_id, 'humidity', least(greatest(CAST(floor((humidity - 30.0) / 5.0) AS BIGINT), 0), 9),
         30.0e0, 5.0e0 FROM valid
  UNION ALL
  SELECT sensor_id, 'temperature_change',
         least(greatest(CAST(floor((temperature_change + 150.0) / 20.0) AS BIGINT), 0), 14),
         -150.0e0, 20.0e0 FROM feat WHERE temperature_change IS NOT NULL
  UNION ALL
  SELECT sensor_id, 'rolling_avg_temperature',
         least(greatest(CAST(floor((rolling_avg_temperature - 300.0) / 10.0) AS BIGINT), 0), 14),
         300.0e0, 10.0e0 FROM feat)
GROUP BY sensor_id, column_name, bin"""),
    "etl_quality": _with("""
SELECT total_rows, valid_rows, invalid_rows, duplicate_rows,
       round(valid_rows / total_rows, 6) AS valid_rate, round(invalid_rows / total_rows, 6) AS invalid_rate,
       round(duplicate_rows / valid_rows, 6) AS duplicate_rate, r.*,
       round(missing_sensor_id / total_rows, 6) AS missing_sensor_id_rate,
       round(missing_timestamp / total_rows, 6) AS missing_timestamp_rate,
       round(missing_temperature / total_rows, 6) AS missing_temperature_rate,
       round(temperature_out_of_range / total_rows, 6) AS temperature_out_of_range_rate,
       round(missing_humidity / total_rows, 6) AS missing_humidity_rate,
       round(humidity_out_of_range / total_rows, 6) AS humidity_out_of_range_rate
FROM (SELECT CAST(sum(n) AS BIGINT) AS total_rows,
             CAST(sum(CASE WHEN v THEN n ELSE 0 END) AS BIGINT) AS valid_rows,
             CAST(sum(CASE WHEN v THEN 0 ELSE n END) AS BIGINT) AS invalid_rows,
             CAST(sum(CASE WHEN v THEN n - 1 ELSE 0 END) AS BIGINT) AS duplicate_rows
      FROM (SELECT sensor_id, "timestamp", source, reasons = '' AS v, count(*) AS n
            FROM tagged GROUP BY sensor_id, "timestamp", source, reasons = '')) q,
     (SELECT CAST(count(*) FILTER (WHERE sensor_id IS NULL OR sensor_id = ' ') AS BIGINT) AS missing_sensor_id,
             CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) AS missing_timestamp,
             CAST(count(*) FILTER (WHERE temperature IS NULL) AS BIGINT) AS missing_temperature,
             CAST(count(*) FILTER (WHERE temperature < 300 OR temperature > 450) AS BIGINT)
               AS temperature_out_of_range,
             CAST(count(*) FILTER (WHERE humidity IS NULL) AS BIGINT) AS missing_humidity,
             CAST(count(*) FILTER (WHERE humidity < 30 OR humidity > 80) AS BIGINT) AS humidity_out_of_range
      FROM tagged) r""", raw=READINGS_DUP),
    "curated_layout": _with("""SELECT *, CAST("timestamp" AS DATE) AS event_date FROM valid"""),
    # a day's readings are far below the target size: one file
    "curated_compaction": _with("""SELECT *, CAST("timestamp" AS DATE) AS event_date, CAST(1 AS BIGINT) AS day_files FROM valid"""),
    "consumer_run": _with(f"""SELECT DISTINCT *, NULL AS reasons, 'valid' AS sink FROM valid
UNION ALL SELECT {_RAW_COLS}, reasons, 'invalid' FROM tagged WHERE reasons <> ''
UNION ALL SELECT {_RAW_COLS}, NULL, 'raw' FROM raw""", raw=READINGS_DUP),
    "preview": _with("""SELECT * FROM valid ORDER BY sensor_id, "timestamp", event_id LIMIT 20"""),
    "replay_raw": _with("""SELECT * FROM valid"""),
})

# Three steps of arrival; copies come a step later, held events in the last one.
# In the last step the watermark is 10 minutes before the newest event of the first.
_ARRIVED = """,
span AS (SELECT min(a) AS lo, (max(a) - min(a)) // 3 + 1 AS width FROM (
  SELECT epoch_us("timestamp") + CASE WHEN event_id % 7 = 0 THEN 300000000 ELSE 0 END AS a FROM raw)),
sent AS (SELECT *, 0 AS copy FROM valid UNION ALL SELECT *, 1 FROM valid WHERE event_id % 20 = 0),
stepped AS (
  SELECT sent.*, CASE WHEN event_id % 89 = 0 THEN 2 ELSE least(2, copy + CAST(floor(
           (epoch_us("timestamp") + CASE WHEN event_id % 7 = 0 THEN 300000000 ELSE 0 END - lo) / width) AS BIGINT))
         END AS step FROM sent, span),
arrived AS (
  SELECT *, step = 2 AND "timestamp" <= (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM stepped WHERE step = 0)
            AS late FROM stepped)
"""

ORACLE.update({
    "stream_late_quarantine": _with_tail(_ARRIVED + """
SELECT DISTINCT event_id, sensor_id, "timestamp", temperature, humidity, source, 'accepted' AS status
FROM arrived WHERE NOT late
UNION ALL
SELECT event_id, sensor_id, "timestamp", temperature, humidity, source, 'late' FROM arrived WHERE late"""),
    "late_rate": _with_tail(_ARRIVED + """
SELECT accepted_rows, late_rows, round(late_rows / (accepted_rows + late_rows), 6) AS late_rate
FROM (SELECT CAST(count(DISTINCT event_id) FILTER (WHERE NOT late) AS BIGINT) AS accepted_rows,
             CAST(count(*) FILTER (WHERE late) AS BIGINT) AS late_rows FROM arrived)"""),
    "stream_table": _with(
        """SELECT event_id, sensor_id, "timestamp", temperature, humidity, source,
       humidity IS NULL AS is_faulty, CASE WHEN humidity IS NULL THEN 'missing_humidity' END AS fault_type FROM raw"""),
})

ORACLE["summary_states"] = ORACLE["dashboard_summary"]
ORACLE["summary_histogram"] = f"""SELECT * FROM ({ORACLE['dashboard_histogram']}) WHERE column_name IN ('temperature', 'humidity')"""
ORACLE["backfill_dirty_days"] = ORACLE["features_all"]
ORACLE["stream_id_offsets"] = ORACLE["stream_table"]
ORACLE["stream_csv_tail"] = ORACLE["stream_csv_ingest"]
# the same arrivals with the invalid rows and their reasons
_ARRIVED_ALL = """,
span AS (SELECT min(a) AS lo, (max(a) - min(a)) // 3 + 1 AS width FROM (
  SELECT epoch_us("timestamp") + CASE WHEN event_id % 7 = 0 THEN 300000000 ELSE 0 END AS a FROM raw)),
sent AS (SELECT *, 0 AS copy FROM tagged UNION ALL SELECT *, 1 FROM tagged WHERE event_id % 20 = 0),
stepped AS (
  SELECT sent.*, reasons = '' AS ok, CASE WHEN {held} THEN 2 ELSE least(2, copy + coalesce(CAST(floor(
           (epoch_us("timestamp") + CASE WHEN event_id % 7 = 0 THEN 300000000 ELSE 0 END - lo) / width) AS BIGINT), 0))
         END AS step FROM sent, span)"""
_RULES = """CAST(count(*) FILTER (WHERE sensor_id IS NULL OR sensor_id = ' ') AS BIGINT) AS missing_sensor_id,
       CAST(count(*) FILTER (WHERE temperature < 300 OR temperature > 450) AS BIGINT) AS temperature_out_of_range"""
ORACLE["consumer_batches"] = _with_tail(_ARRIVED_ALL.format(held="event_id % 89 = 0") + f""",
arrived AS (SELECT *, ok AND step = 2 AND "timestamp" <=
              (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM stepped WHERE step = 0 AND ok) AS late FROM stepped),
first AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY step, copy) AS nth FROM arrived WHERE ok AND NOT late)
SELECT CAST(step AS BIGINT) AS batch_id, count(*) AS rows, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS valid_rows,
       CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS invalid_rows,
       CAST((SELECT count(*) FROM first f WHERE f.step = a.step AND nth = 1) AS BIGINT) AS accepted_rows,
       CAST(count(*) FILTER (WHERE late) AS BIGINT) AS late_rows,
       CAST(count(*) FILTER (WHERE ok AND NOT late) - (SELECT count(*) FROM first f WHERE f.step = a.step AND nth = 1)
            AS BIGINT) AS duplicate_rows, {_RULES}
FROM arrived a GROUP BY step""")
# a restarted native query drops what is behind the watermark of all earlier steps
ORACLE["stream_metrics"] = _with_tail(_ARRIVED_ALL.format(held="false") + """,
marks AS (SELECT s.step, (SELECT max("timestamp") - INTERVAL 10 MINUTE FROM stepped b WHERE b.ok AND b.step < s.step) AS mark
          FROM (SELECT DISTINCT step FROM stepped) s),
arrived AS (SELECT s.*, coalesce(ok AND "timestamp" <= mark, false) AS late FROM stepped s JOIN marks USING (step))
SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS valid_rows,
       CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS invalid_rows,
       CAST(count(*) FILTER (WHERE sensor_id IS NULL OR sensor_id = ' ') AS BIGINT) AS missing_sensor_id,
       CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) AS missing_timestamp,
       CAST(count(*) FILTER (WHERE temperature IS NULL) AS BIGINT) AS missing_temperature,
       CAST(count(*) FILTER (WHERE temperature < 300 OR temperature > 450) AS BIGINT) AS temperature_out_of_range,
       CAST(count(*) FILTER (WHERE humidity IS NULL) AS BIGINT) AS missing_humidity,
       CAST(count(*) FILTER (WHERE humidity < 30 OR humidity > 80) AS BIGINT) AS humidity_out_of_range,
       CAST(count(*) FILTER (WHERE late) AS BIGINT) AS late_rows,
       CAST(count(DISTINCT event_id) FILTER (WHERE ok AND NOT late) AS BIGINT) AS accepted_rows,
       CAST(count(*) FILTER (WHERE ok AND NOT late) - count(DISTINCT event_id) FILTER (WHERE ok AND NOT late) AS BIGINT)
         AS duplicate_rows
FROM arrived""")
ORACLE["stream_features"] = _with(f"""SELECT {FEATURE_COLS} FROM feat WHERE target_temperature IS NOT NULL""")


def _fault_sql(seed: int = 42, rate: float = 0.05) -> str:
    from ..operators.faults import _M, _MULT

    def draw(name: str) -> str:
        c = (seed * 7919 + list(_MULT).index(name) * 104729) % _M
        return f"((((event_id % {_M}) * {_MULT[name]} + {c}) % {_M}) / {_M}.0)"

    mag = draw("mag")
    return f"""
SELECT event_id,
  CASE WHEN fault_type = 'missing_sensor_id'
       THEN (CASE CAST(floor({draw('blank')} * 3) AS BIGINT) WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' ' END)
       ELSE sensor_id END AS sensor_id,
  CASE WHEN fault_type = 'missing_timestamp' THEN NULL ELSE "timestamp" END AS "timestamp",
  CASE WHEN fault_type = 'missing_temperature' THEN NULL
       WHEN fault_type = 'temperature_out_of_range' THEN
         CASE WHEN {draw('side')} < 0.5 THEN (30000 - (100 + floor({mag} * 2900))) / 100.0
              ELSE (45000 + (100 + floor({mag} * 2900))) / 100.0 END
       ELSE temperature END AS temperature,
  CASE WHEN fault_type = 'missing_humidity' THEN NULL
       WHEN fault_type = 'humidity_out_of_range' THEN
         CASE WHEN {draw('side')} < 0.5 THEN (3000 - (100 + floor({mag} * 900))) / 100.0
              ELSE (8000 + (100 + floor({mag} * 900))) / 100.0 END
       ELSE humidity END AS humidity,
  source, is_faulty, fault_type
FROM (SELECT *, {draw('rate')} < {rate} AS is_faulty,
             CASE WHEN {draw('rate')} < {rate} THEN
               ['missing_sensor_id', 'missing_timestamp', 'missing_temperature', 'missing_humidity',
                'temperature_out_of_range', 'humidity_out_of_range'][CAST(floor({draw('kind')} * 6) AS BIGINT) + 1]
             END AS fault_type
      FROM valid)"""


ORACLE["inject_faults"] = _with(_fault_sql())


# ------------------------------------------------------------------ model queries
# Least squares with an intercept: centre every column, make the features
# orthogonal one after the other (u1..u4), and read the weights off backwards.
_FIT = """,
tr AS MATERIALIZED (SELECT temperature AS a1, humidity AS a2, temperature_change AS a3,
                           rolling_avg_temperature AS a4, target_temperature AS y
                    FROM chrono_l WHERE split = 'train'),
mu AS MATERIALIZED (SELECT avg(a1) AS m1, avg(a2) AS m2, avg(a3) AS m3, avg(a4) AS m4, avg(y) AS my FROM tr),
s1 AS MATERIALIZED (SELECT a1 - m1 AS u1, a2 - m2 AS c2, a3 - m3 AS c3, a4 - m4 AS c4, y - my AS y FROM tr, mu),
s2 AS MATERIALIZED (SELECT *, c2 - u1 * (SELECT sum(c2 * u1) / sum(u1 * u1) FROM s1) AS u2 FROM s1),
s3 AS MATERIALIZED (SELECT *, c3 - u1 * (SELECT sum(c3 * u1) / sum(u1 * u1) FROM s2)
                              - u2 * (SELECT sum(c3 * u2) / sum(u2 * u2) FROM s2) AS u3 FROM s2),
s4 AS MATERIALIZED (SELECT *, c4 - u1 * (SELECT sum(c4 * u1) / sum(u1 * u1) FROM s3)
                              - u2 * (SELECT sum(c4 * u2) / sum(u2 * u2) FROM s3)
                              - u3 * (SELECT sum(c4 * u3) / sum(u3 * u3) FROM s3) AS u4 FROM s3),
w4 AS MATERIALIZED (SELECT sum(y * u4) / sum(u4 * u4) AS b4 FROM s4),
w3 AS MATERIALIZED (SELECT sum((y - b4 * c4) * u3) / sum(u3 * u3) AS b3 FROM s4, w4),
w2 AS MATERIALIZED (SELECT sum((y - b4 * c4 - b3 * c3) * u2) / sum(u2 * u2) AS b2 FROM s4, w4, w3),
w1 AS MATERIALIZED (SELECT sum((y - b4 * c4 - b3 * c3 - b2 * c2) * u1) / sum(u1 * u1) AS b1 FROM s4, w4, w3, w2),
model AS MATERIALIZED (SELECT b1, b2, b3, b4, my - b1 * m1 - b2 * m2 - b3 * m3 - b4 * m4 AS b0 FROM mu, w1, w2, w3, w4)
"""

_PREDICTED = "b0 + b1 * temperature + b2 * humidity + b3 * temperature_change + b4 * rolling_avg_temperature"
_SCORED = f"SELECT *, {_PREDICTED} AS prediction FROM feat, model WHERE temperature_change IS NOT NULL"
_ERRORS = f"SELECT *, {_PREDICTED} - target_temperature AS e FROM chrono_l, model"
_MEASURES = """round(avg(e * e), 6) AS {0}mse, round(avg(abs(e)), 6) AS {0}mae, round(sqrt(avg(e * e)), 6) AS {0}rmse,
       round(1 - avg(e * e) / var_pop(target_temperature), 6) AS {0}r2"""
# the reference slice with its own features
_ON_REFERENCE = f""",
on_ref AS (SELECT *, {_PREDICTED} - target_temperature AS e FROM (
  SELECT *, temperature - lag(temperature) OVER w AS temperature_change,
         avg(temperature) OVER (PARTITION BY sensor_id
                                ORDER BY CAST(floor(epoch("timestamp")) AS BIGINT)
                                RANGE BETWEEN 1800 PRECEDING AND CURRENT ROW) AS rolling_avg_temperature,
         lead(temperature, 12) OVER w AS target_temperature
  FROM refcur WHERE slice = 'reference'
  WINDOW w AS (PARTITION BY sensor_id ORDER BY "timestamp", event_id)), model
  WHERE temperature_change IS NOT NULL AND target_temperature IS NOT NULL)
"""

ORACLE.update({
    "train_linear": _with_tail(_FIT + """
SELECT unnest(['temperature', 'humidity', 'temperature_change', 'rolling_avg_temperature', 'intercept']) AS term,
       unnest([round(b1, 6), round(b2, 6), round(b3, 6), round(b4, 6), round(b0, 6)]) AS coefficient
FROM model"""),
    "predict_readings": _with_tail(_FIT + f"""
SELECT sensor_id, "timestamp", temperature, round(prediction, 4) AS prediction FROM ({_SCORED})"""),
    "predict_csv": _with_tail(_FIT + f"""
SELECT "timestamp", temperature, round(prediction, 4) AS prediction FROM ({_SCORED})"""),
    "prediction_store": _with_tail(_FIT + f"""
SELECT CAST(1 AS BIGINT) AS model_version, sensor_id, "timestamp", temperature, round(prediction, 4) AS prediction,
       event_id, source
FROM (SELECT *, row_number() OVER (PARTITION BY sensor_id, "timestamp"
        ORDER BY CASE source WHEN 'csv' THEN 1 WHEN 'api' THEN 2 WHEN 'database' THEN 3 ELSE 4 END, event_id) AS rk
      FROM ({_SCORED})) WHERE rk = 1"""),
    "model_registry": _with_tail(_FIT + f"""
SELECT 'training' AS run_name, 'sensor-forecast' AS model_name, 0.0e0 AS reg_param, 0.0e0 AS elastic_net_param,
       'temperature,humidity,temperature_change,rolling_avg_temperature' AS features, g.max_mae, v.*, t.*,
       validation_mae <= max_mae AS passed, validation_mae <= max_mae AS has_signature,
       CASE WHEN validation_mae <= max_mae THEN 1 + (max_mae > 15 AND validation_mae <= 15)::BIGINT END AS version,
       validation_mae <= max_mae AND max_mae > 15 AS is_champion
FROM (SELECT {_MEASURES.format('validation_')} FROM ({_ERRORS}) WHERE split = 'validation') v,
     (SELECT {_MEASURES.format('test_')} FROM ({_ERRORS}) WHERE split = 'test') t,
     (VALUES (15.0e0), (100.0e0)) g(max_mae)"""),
    "champion_eval": _with_tail(_FIT + _ON_REFERENCE + f"""
SELECT {_MEASURES.format('')}, CAST(count(*) AS BIGINT) AS n_rows FROM on_ref"""),
    "monitoring_run": _with_tail(_FIT + _ON_REFERENCE + f"""
SELECT 'model-monitoring' AS run_name, 'monitoring_mae' AS metric, round(avg(abs(e)), 6) AS value FROM on_ref
UNION ALL
SELECT 'model-monitoring', 'monitoring_rmse', round(sqrt(avg(e * e)), 6) FROM on_ref
UNION ALL
SELECT 'model-monitoring', concat(column_name, '_', statistic, '_change_percent'), change_percent
FROM ({DRIFT_LONG})"""),
    "dashboard_actual_predicted": _with_tail(_FIT + f"""
SELECT event_id, sensor_id, "timestamp", target_temperature AS actual, round(target_temperature + e, 4) AS predicted,
       round(e, 4) AS residual FROM ({_ERRORS}) WHERE split = 'test'"""),
})


# ------------------------------------------------------------------ hyperparameter search
# Coordinate descent on the correlations of the train rows, one round per step of
# the recursion: 600 are far more than these need.
_VARS = ["a1", "a2", "a3", "a4", "y"]
_CORR = ", ".join(f"covar_pop({x}, {y}) / (stddev_pop({x}) * stddev_pop({y})) AS r{i}{j}"
                  for i, x in enumerate(_VARS) for j, y in enumerate(_VARS) if i < j)


def _soft(j: int, weights: list[str]) -> str:
    """The j-th weight given the others."""
    pull = f"r{j}4" + "".join(f" - r{min(j, k)}{max(j, k)} * {w}" for k, w in enumerate(weights) if k != j)
    return f"sign({pull}) * greatest(abs({pull}) - lasso, 0) / (1 + ridge)"


def _round_of_descent() -> str:
    sql = "SELECT *, i + 1 AS ni FROM cd, mom, grid WHERE cd.g = grid.gid AND i < 600"
    for j in range(4):
        weights = [f"n{k}" if k < j else f"w{k}" for k in range(4)]
        sql = f"SELECT *, {_soft(j, weights)} AS n{j} FROM ({sql})"
    return f"SELECT g, ni, n0, n1, n2, n3 FROM ({sql})"


ORACLE["hyper_search"] = _with_tail(_FIT + f""",
mom AS MATERIALIZED (SELECT {_CORR}, {", ".join(f"stddev_pop({v}) AS sd{i}, avg({v}) AS mean{i}" for i, v in enumerate(_VARS))} FROM tr),
grid AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY reg, en) AS gid, reg, en, reg * en / sd4 AS lasso, reg * (1 - en) / sd4 AS ridge
  FROM (VALUES (0.0e0), (0.01e0), (0.1e0)) x(reg), (VALUES (0.0e0), (0.5e0)) z(en), mom),
cd AS (
  SELECT gid AS g, 0 AS i, 0.0e0 AS w0, 0.0e0 AS w1, 0.0e0 AS w2, 0.0e0 AS w3 FROM grid
  UNION ALL {_round_of_descent()}),
fits AS MATERIALIZED (
  SELECT reg, en, w0 * sd4 / sd0 AS b0, w1 * sd4 / sd1 AS b1, w2 * sd4 / sd2 AS b2, w3 * sd4 / sd3 AS b3,
         mean4 - w0 * sd4 / sd0 * mean0 - w1 * sd4 / sd1 * mean1 - w2 * sd4 / sd2 * mean2 - w3 * sd4 / sd3 * mean3 AS b
  FROM cd JOIN grid ON cd.g = grid.gid, mom WHERE i = 600)
SELECT reg AS reg_param, en AS elastic_net_param, round(avg(e * e), 6) AS mse, round(avg(abs(e)), 6) AS mae,
       round(sqrt(avg(e * e)), 6) AS rmse, round(1 - avg(e * e) / var_pop(target_temperature), 6) AS r2
FROM (SELECT reg, en, target_temperature, b + b0 * temperature + b1 * humidity + b2 * temperature_change
             + b3 * rolling_avg_temperature - target_temperature AS e FROM chrono_l, fits WHERE split = 'validation')
GROUP BY reg, en""").replace("WITH raw AS", "WITH RECURSIVE raw AS", 1)
