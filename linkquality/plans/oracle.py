"""DuckDB SQL twins of ``catalog.QUERIES`` (the correctness oracle).

Written against the driver's pre-registered views (events, lineitem, ...).
Each statement is plain SQL; the pieces below are CTE texts shared by
several statements.  Doubles are rounded to 6 places, as on the Spark side.
"""

from __future__ import annotations

from ..operators.stats import CORRELATION_COLUMNS
from ..schema import MEASURES
from .catalog import (BRUSH_REGIONS, BRUSH_X, BRUSH_Y, DENSITY_STEPS, DOWNSTREAM_EXTENT,
                      GAP_BANDWIDTH, GAP_STEPS, INGEST_STAMP_1, INGEST_STAMP_2, REGIONS,
                      LATER_IDS, REINGEST_MONTH, SCAN_YEAR, SESSION_YEARS, SOME_ADDRESSES, UPSTREAM_EXTENT, WHOLE, YEARS)
from .fixtures import (AUTUMN_WINDOW_START_UTC, EARLIER_AUTUMN_START_UTC, SPRING_WINDOW_START_LOCAL,
                       SQUEEZE)
from ..sources.adapters import M_EVENTS_SQL, M_LINEITEM_SQL

R = 6


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _r(expr: str) -> str:
    """Rounding that matches ``catalog.rounded`` bit for bit."""
    return f"(round(({expr}) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})"


def _round(cols) -> str:
    return ", ".join(f"{_r(c)} AS {c}" for c in cols)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


GEO = ["connection_municipality", "connection_regional_unit", "connection_periphery"]
CONTRACT = ["contract_download_mbps", "contract_upload_mbps"]
SILVER_DOUBLES = MEASURES + CONTRACT
SESSION_DOUBLES = ["avg_downstream", "avg_upstream", "avg_rtt", "avg_loss", "avg_jitter",
                   "prev_session_downstream", "prev_session_loss", "days_since_prev_session",
                   "speed_drop_pct"]
REGIONAL_DOUBLES = ["avg_downstream_mbps", "p50_downstream_mbps", "avg_upstream_mbps",
                    "avg_rtt_msec", "avg_loss_percentage", "avg_jitter_msec"]
STAIRCASE_DOUBLES = ["median_downstream_mbps", "median_loss_pct", "median_jitter_ms",
                     "median_rtt_ms"]


def silver_cte(name: str, src: str) -> str:
    names = ",\n  ".join(
        f"CASE WHEN {c} = 'NaN' OR {c} IS NULL THEN 'N/A' ELSE {c} END AS {c}" for c in GEO)
    return f"""{name} AS (
SELECT * EXCLUDE (client_ip, {", ".join(GEO)}),
  {names},
  CAST(measurement_time AS DATE) AS measurement_date,
  sha256(client_ip) AS user_id
FROM {src}
WHERE measurement_time IS NOT NULL AND measured_downstream_mbps >= 0)"""


def session_ctes(silver: str, timeout_min: int = 30, max_days: float = 14) -> list[str]:
    t = timeout_min * 60
    return [
        f"""fl AS (
SELECT *, CASE WHEN prev_t IS NULL
               OR floor(epoch(measurement_time)) - floor(epoch(prev_t)) > {t}
          THEN 1 ELSE 0 END AS is_new
FROM (SELECT *, lag(measurement_time) OVER (PARTITION BY user_id ORDER BY measurement_time)
             AS prev_t FROM {silver}))""",
        """nb AS (
SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY measurement_time) AS BIGINT)
          AS session_id FROM fl)""",
        """st AS (
SELECT user_id, session_id,
  min(measurement_time) AS session_start, max(measurement_time) AS session_end,
  count(measurement_id) AS test_count,
  avg(measured_downstream_mbps) AS avg_downstream, avg(measured_upstream_mbps) AS avg_upstream,
  avg(measured_rtt_msec) AS avg_rtt, avg(measured_loss_percentage) AS avg_loss,
  avg(measured_jitter_msec) AS avg_jitter,
  CAST(min(measurement_time) AS DATE) AS session_date
FROM nb GROUP BY user_id, session_id)""",
        """lg AS (
SELECT *, lag(session_end) OVER w AS prev_session_end,
  lag(avg_downstream) OVER w AS prev_session_downstream,
  lag(avg_loss) OVER w AS prev_session_loss
FROM st WINDOW w AS (PARTITION BY user_id ORDER BY session_start))""",
        f"""gp AS (
SELECT *, (floor(epoch(session_start)) - floor(epoch(prev_session_end))) / 86400.0
          AS days_since_prev_session FROM lg)""",
        f"""bl AS (
SELECT *, coalesce(days_since_prev_session <= {max_days}, false) AS has_valid_baseline FROM gp)""",
        """sessions AS (
SELECT *,
  CASE WHEN has_valid_baseline THEN
    (prev_session_downstream - avg_downstream) / nullif(prev_session_downstream, 0) * 100
  END AS speed_drop_pct,
  CASE WHEN test_count = 1 THEN '1. Single Test'
       WHEN test_count >= 2 AND test_count <= 3 THEN '2. Moderate (2-3)'
       WHEN test_count >= 4 THEN '3. High (4+)'
       ELSE 'Unknown' END AS behavior_bucket
FROM bl)""",
    ]


SESSION_COLS = ("user_id, session_id, session_start, session_end, test_count, "
                "session_date, prev_session_end, has_valid_baseline, behavior_bucket, "
                + _round(SESSION_DOUBLES))

EV = f"m_ev AS ({M_EVENTS_SQL})"
LI = f"m_li AS ({M_LINEITEM_SQL})"
SILVER_EV = silver_cte("silver_ev", "m_ev")
SILVER_LI = silver_cte("silver_li", "m_li")
SESSIONS = [EV, SILVER_EV] + session_ctes("silver_ev")

REGIONAL = f"""regional AS (
SELECT measurement_date, connection_periphery,
  count(measurement_id) AS total_tests,
  avg(measured_downstream_mbps) AS avg_downstream_mbps,
  quantile_disc(measured_downstream_mbps, 0.5) AS p50_downstream_mbps,
  avg(measured_upstream_mbps) AS avg_upstream_mbps,
  avg(measured_rtt_msec) AS avg_rtt_msec,
  avg(measured_loss_percentage) AS avg_loss_percentage,
  avg(measured_jitter_msec) AS avg_jitter_msec
FROM silver_li GROUP BY measurement_date, connection_periphery)"""
FR = f"""fr AS (
SELECT * FROM regional
WHERE connection_periphery IN ({_in(REGIONS)})
  AND measurement_date BETWEEN DATE '{YEARS[0]}-01-01' AND DATE '{YEARS[1]}-12-31')"""
REG = [LI, SILVER_LI, REGIONAL]
FREG = REG + [FR]

RETENTION = """retention AS (
SELECT session_date,
  CASE WHEN has_valid_baseline THEN 'Returning user' ELSE 'New/Transient user' END AS user_type,
  count(session_id) AS total_sessions
FROM sessions GROUP BY 1, 2)"""
STAIRCASE = """staircase AS (
SELECT session_date, behavior_bucket, count(session_id) AS total_sessions,
  quantile_disc(avg_downstream, 0.5) AS median_downstream_mbps,
  quantile_disc(avg_loss, 0.5) AS median_loss_pct,
  quantile_disc(avg_jitter, 0.5) AS median_jitter_ms,
  quantile_disc(avg_rtt, 0.5) AS median_rtt_ms
FROM sessions GROUP BY 1, 2)"""
SESSION_YEAR_FILTER = (f"session_date BETWEEN DATE '{SESSION_YEARS[0]}-01-01' "
                       f"AND DATE '{SESSION_YEARS[1]}-12-31'")

RAW_TEXT_FIELDS = {
    "measurement_time": "strftime(measurement_time, '%Y-%m-%d %H:%M:%S.%f')",
    "connection_postal_code": "CAST(CAST(connection_postal_code AS DOUBLE) AS VARCHAR)",
    "connection_municipality_id": "CAST(CAST(connection_municipality_id AS DOUBLE) AS VARCHAR)",
    "connection_regional_unit_id": "CAST(CAST(connection_regional_unit_id AS DOUBLE) AS VARCHAR)",
    "connection_periphery_id": "CAST(CAST(connection_periphery_id AS DOUBLE) AS VARCHAR)",
}
RAW_EV = "raw_ev AS (SELECT * REPLACE (" + ", ".join(
    f"{v} AS {k}" for k, v in RAW_TEXT_FIELDS.items()) + ") FROM m_ev)"

# Athens wall clock -> UTC wall clock, as the DuckDB time-zone functions see it.
def _athens_to_utc(c: str) -> str:
    return f"timezone('UTC', timezone('Europe/Athens', {c}))"


AUTUMN = f"""autumn AS (
SELECT measurement_id,
  TIMESTAMP '{AUTUMN_WINDOW_START_UTC}'
    + to_microseconds(CAST(floor((epoch_us(measurement_time)
        - (SELECT epoch_us(min(measurement_time)) FROM m_ev)) / {SQUEEZE}) AS BIGINT))
    AS measurement_time
FROM m_ev)"""


def _corr_sql() -> str:
    cols = list(CORRELATION_COLUMNS)

    def clean(name):
        s = (f"regexp_replace(replace('{name}', '_', ' '), "
             r"'\b(avg|mbps|msec|percentage|total)\b', '', 'gi')")
        s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
        return f"upper(substr({s}, 1, 1)) || lower(substr({s}, 2))"

    def val(c):
        return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"

    parts = []
    for a in cols:
        for b in cols:
            xa = f"CASE WHEN {val(b)} IS NOT NULL THEN {val(a)} END"
            xb = f"CASE WHEN {val(a)} IS NOT NULL THEN {val(b)} END"
            parts.append(
                f"SELECT {clean(a)} AS variable_1, {clean(b)} AS variable_2, "
                f"(round((covar_pop({xa}, {xb}) / nullif(stddev_pop({xa}) * stddev_pop({xb}), 0)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})"
                f" AS correlation FROM fr")
    return _with(*FREG) + "\nUNION ALL\n".join(parts)


def _density_sql(col: str, extent, steps: int) -> str:
    lo, hi = extent
    return _with(*FREG, f"""v AS (
SELECT connection_periphery, CAST({col} AS DOUBLE) AS x FROM fr
WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE)))""", """bw AS (
SELECT connection_periphery, count(*) AS n,
  1.06 * (CASE
    WHEN least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34) > 0
      THEN least(stddev_samp(x), (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / 1.34)
    WHEN stddev_samp(x) > 0 THEN stddev_samp(x)
    WHEN abs(quantile_cont(x, 0.25)) > 0 THEN abs(quantile_cont(x, 0.25))
    ELSE 1.0 END) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h
FROM v GROUP BY connection_periphery)""", f"""g AS (
SELECT range AS j,
  CASE WHEN range = {steps} THEN CAST({hi} AS DOUBLE)
       ELSE CAST({lo} AS DOUBLE) + (range / {steps}) * CAST({hi - lo} AS DOUBLE) END AS value
FROM range(0, {steps + 1}))""") + f"""
SELECT v.connection_periphery, {_r('g.value')} AS value,
  (round((sum(exp(-0.5 * ((g.value - v.x) / bw.h) * ((g.value - v.x) / bw.h)))
        / sqrt(2 * pi()) / bw.h / bw.n * bw.n) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS density
FROM v JOIN bw ON v.connection_periphery = bw.connection_periphery CROSS JOIN g
GROUP BY v.connection_periphery, g.j, g.value, bw.h, bw.n"""


def _gap_density_sql() -> str:
    return _with(*SESSIONS, """gaps AS (
SELECT CAST(floor(epoch(session_start)) - floor(epoch(prev_session_end)) AS DOUBLE) AS x
FROM sessions WHERE prev_session_end IS NOT NULL)""",
                 "q AS (SELECT quantile_cont(x, 0.8) AS hi FROM gaps)", f"""g AS (
SELECT range AS j,
  CASE WHEN range = {GAP_STEPS} THEN q.hi ELSE 0.0::DOUBLE + (range / {GAP_STEPS}) * q.hi END AS value
FROM range(0, {GAP_STEPS + 1}) CROSS JOIN q)""") + f"""
SELECT {_r('g.value')} AS value,
  (round((sum(exp(-0.5 * ((g.value - gaps.x) / {GAP_BANDWIDTH}) * ((g.value - gaps.x) / {GAP_BANDWIDTH})))
        / sqrt(2 * pi()) / {GAP_BANDWIDTH} / count(*)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS density
FROM gaps CROSS JOIN g GROUP BY g.j, g.value"""


def _bronze_sql(where: str, select: str, group: str = "") -> str:
    return _with(LI, """bronze AS (
SELECT *, CAST(year(measurement_time) AS INTEGER) AS year,
          CAST(month(measurement_time) AS INTEGER) AS month FROM m_li)""") + \
        f"SELECT {select} FROM bronze {where} {group}"


def _silver_li_keys() -> list[str]:
    return [LI, """m_li_k AS (
SELECT *, CAST(year(measurement_time) AS INTEGER) AS year,
          CAST(month(measurement_time) AS INTEGER) AS month FROM m_li)""",
            silver_cte("silver_lk", "m_li_k")]


_re_y, _re_m = (int(x) for x in REINGEST_MONTH.split("-"))

ORACLE_SQL: dict[str, str] = {
    "raw_json_roundtrip": _with(EV, RAW_EV)
    + f"SELECT * REPLACE ({_round(MEASURES + CONTRACT)}) FROM raw_ev",
    "bronze_typed": _with(EV, RAW_EV) + f"""SELECT * REPLACE ({_round(MEASURES + CONTRACT)})
FROM (SELECT r.* REPLACE ({_athens_to_utc('m.measurement_time')} AS measurement_time),
        TIMESTAMP '{INGEST_STAMP_1}' AS ingested_at,
        CAST(year(m.measurement_time) AS INTEGER) AS year,
        CAST(month(m.measurement_time) AS INTEGER) AS month
      FROM raw_ev r JOIN m_ev m ON r.measurement_id = m.measurement_id)""",
    "bronze_localized": _with(EV, AUTUMN) + "SELECT measurement_id, measurement_time FROM autumn",
    "bronze_offset_times": _with(EV, AUTUMN) + "SELECT measurement_id, measurement_time FROM autumn",
    "bronze_partition_overwrite": _bronze_sql(
        "", f"year, month, count(*) AS n_rows, CASE WHEN year = {_re_y} AND month = {_re_m} "
            f"THEN TIMESTAMP '{INGEST_STAMP_2}' ELSE TIMESTAMP '{INGEST_STAMP_1}' END AS ingested_at",
        "GROUP BY year, month"),
    "bronze_scan": _bronze_sql(f"WHERE year = {SCAN_YEAR}",
                               f"measurement_id, (round((measured_downstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS "
                               "measured_downstream_mbps, year, month"),
    "month_range": """SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  d AS first_day, last_day(d) AS last_day
FROM (SELECT CAST(gs AS DATE) AS d
      FROM (SELECT min(l_shipdate) AS s, max(l_shipdate) AS e FROM lineitem) b,
           generate_series(date_trunc('month', b.s), date_trunc('month', b.e), INTERVAL 1 MONTH) t(gs))""",
    "silver_clean": _with(EV, SILVER_EV) + f"SELECT * REPLACE ({_round(SILVER_DOUBLES)}) FROM silver_ev",
    "silver_write_read": _with(*_silver_li_keys())
    + f"SELECT * REPLACE ({_round(SILVER_DOUBLES)}) FROM silver_lk",
    "serve_silver_projection": _with(*_silver_li_keys())
    + f"SELECT {_round(['measured_downstream_mbps', 'measured_jitter_msec'])}, year FROM silver_lk",
    "sessions_flags": _with(*SESSIONS[:2], *session_ctes("silver_ev")[:2])
    + "SELECT user_id, measurement_id, measurement_time, session_id FROM nb",
    "session_stats": _with(*SESSIONS[:2], *session_ctes("silver_ev")[:3])
    + "SELECT user_id, session_id, session_start, session_end, test_count, session_date, "
    + _round(["avg_downstream", "avg_upstream", "avg_rtt", "avg_loss", "avg_jitter"]) + " FROM st",
    "sessions_enriched": _with(*SESSIONS) + f"SELECT {SESSION_COLS} FROM sessions",
    "sessions_enriched_window": _with(*SESSIONS) + f"SELECT {SESSION_COLS} FROM sessions",
    "sessions_short_decay": _with(EV, SILVER_EV, *session_ctes("silver_ev", 30, 0.1))
    + f"SELECT {SESSION_COLS} FROM sessions",
    "sessions_write_read": _with(*SESSIONS) + f"SELECT {SESSION_COLS} FROM sessions",
    "gold_regional_metrics": _with(*REG) + f"SELECT * REPLACE ({_round(REGIONAL_DOUBLES)}) FROM regional",
    "gold_user_retention": _with(*SESSIONS, RETENTION) + "SELECT * FROM retention",
    "gold_frustration_staircase": _with(*SESSIONS, STAIRCASE)
    + f"SELECT * REPLACE ({_round(STAIRCASE_DOUBLES)}) FROM staircase",
    "serve_regional": _with(*REG) + f"SELECT * REPLACE ({_round(REGIONAL_DOUBLES)}) FROM regional",
    "serve_filtered": _with(*FREG) + f"SELECT * REPLACE ({_round(REGIONAL_DOUBLES)}) FROM fr",
    "serve_filtered_sessions": _with(*SESSIONS, STAIRCASE)
    + f"SELECT * REPLACE ({_round(STAIRCASE_DOUBLES)}) FROM staircase WHERE {SESSION_YEAR_FILTER}",
    "serve_rolling_download": _with(*FREG) + f"""SELECT measurement_date, connection_periphery,
  (round((avg_downstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_downstream_mbps,
  (round((avg(avg_downstream_mbps) OVER (PARTITION BY connection_periphery ORDER BY measurement_date
        ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS rolling_mean FROM fr""",
    "serve_rolling_upload": _with(*FREG) + f"""SELECT measurement_date, connection_periphery,
  (round((avg_upstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_upstream_mbps,
  (round((avg(avg_upstream_mbps) OVER (PARTITION BY connection_periphery ORDER BY measurement_date
        ROWS BETWEEN 15 PRECEDING AND 15 FOLLOWING)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS rolling_mean FROM fr""",
    "serve_kpis": _with(*FREG) + f"""SELECT
  (round((sum(avg_downstream_mbps * CASE WHEN avg_downstream_mbps IS NOT NULL THEN total_tests END)
    / nullif(sum(CASE WHEN avg_downstream_mbps IS NOT NULL THEN total_tests END), 0)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})
    AS avg_downstream_mbps,
  (round((sum(avg_upstream_mbps * CASE WHEN avg_upstream_mbps IS NOT NULL THEN total_tests END)
    / nullif(sum(CASE WHEN avg_upstream_mbps IS NOT NULL THEN total_tests END), 0)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})
    AS avg_upstream_mbps,
  CAST(sum(total_tests) AS BIGINT) AS total_tests FROM fr""",
    "serve_regions": _with(*REG) + "SELECT DISTINCT connection_periphery FROM regional",
    "serve_year_bounds": _with(*REG) + """SELECT
  CAST(min(year(measurement_date)) AS INTEGER) AS min_year,
  CAST(max(year(measurement_date)) AS INTEGER) AS max_year,
  CAST(max(year(measurement_date)) - 4 AS INTEGER) AS default_start_year,
  CAST(max(year(measurement_date)) AS INTEGER) AS default_end_year FROM regional""",
    "serve_tests_volume": _with(*FREG) + """SELECT measurement_date, connection_periphery,
  CAST(sum(total_tests) AS BIGINT) AS total_tests FROM fr GROUP BY 1, 2""",
    "serve_staircase": _with(*SESSIONS, STAIRCASE) + f"""SELECT behavior_bucket,
  CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
  (round((avg(median_loss_pct)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS mean_median_loss_pct
FROM staircase WHERE {SESSION_YEAR_FILTER} GROUP BY 1""",
    "serve_retention": _with(*SESSIONS, RETENTION) + f"""SELECT user_type,
  CAST(sum(total_sessions) AS BIGINT) AS total_sessions,
  (round((sum(total_sessions) / sum(sum(total_sessions)) OVER ()) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS share
FROM retention WHERE {SESSION_YEAR_FILTER} GROUP BY 1""",
    "serve_session_histogram": _with(*SESSIONS)
    + "SELECT test_count, count(*) AS sessions FROM sessions GROUP BY 1",
    "serve_gap_quantile": _with(*SESSIONS) + f"""SELECT (round((quantile_cont(
  CAST(floor(epoch(session_start)) - floor(epoch(prev_session_end)) AS DOUBLE), 0.8)) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})
  AS gap_quantile FROM sessions""",
    "serve_brush_filter": _with(*FREG) + f"""SELECT measurement_date, connection_periphery,
  (round((avg_upstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_upstream_mbps,
  (round((avg_downstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_downstream_mbps FROM fr
WHERE avg_upstream_mbps BETWEEN {BRUSH_X[0]} AND {BRUSH_X[1]}
  AND avg_downstream_mbps BETWEEN {BRUSH_Y[0]} AND {BRUSH_Y[1]}
  AND connection_periphery IN ({_in(BRUSH_REGIONS)})""",
    "serve_scatter_clamped": _with(*FREG) + f"""SELECT measurement_date, connection_periphery,
  (round((CASE WHEN avg_rtt_msec IS NOT NULL THEN least(greatest(avg_rtt_msec, 0.0), 500.0) END) * (1 + pow(2, -40)) * 1e{R}) / 1e{R})
    AS rtt_clamped,
  (round((CASE WHEN avg_downstream_mbps IS NOT NULL
             THEN least(greatest(avg_downstream_mbps, 0.0), 500.0) END) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS downstream_clamped,
  (round((avg_jitter_msec) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_jitter_msec FROM fr""",
    "serve_scatter": _with(*FREG) + f"""SELECT (round((avg_upstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_upstream_mbps,
  (round((avg_downstream_mbps) * (1 + pow(2, -40)) * 1e{R}) / 1e{R}) AS avg_downstream_mbps, connection_periphery FROM fr""",
    "serve_correlation": _corr_sql(),
    "serve_density_upstream": _density_sql("avg_upstream_mbps", UPSTREAM_EXTENT, DENSITY_STEPS),
    "serve_density_downstream": _density_sql("avg_downstream_mbps", DOWNSTREAM_EXTENT,
                                             DENSITY_STEPS),
    "serve_density_gap": _gap_density_sql(),
}

# The lineitem landing after one month became unusable; its times are local.
_AFTER = [LI, f"""m_rest AS (
SELECT * REPLACE ({_athens_to_utc('measurement_time')} AS measurement_time),
  CAST(year(measurement_time) AS INTEGER) AS year, CAST(month(measurement_time) AS INTEGER) AS month
FROM m_li WHERE NOT (year(measurement_time) = {_re_y} AND month(measurement_time) = {_re_m}))""",
          silver_cte("silver_rest", "m_rest")]

# On a spring day local time is UTC+2 before 03:00 and UTC+3 from 04:00; the
# hour between them is the change itself, 01:00 UTC.
ORACLE_SQL |= {
    "bronze_two_autumns": _with(EV, AUTUMN.replace(AUTUMN_WINDOW_START_UTC, EARLIER_AUTUMN_START_UTC),
                                AUTUMN.replace("autumn AS", "later AS"))
    + "SELECT measurement_id, measurement_time FROM autumn UNION ALL "
    + f"SELECT measurement_id + {LATER_IDS}, measurement_time FROM later",
    "bronze_spring_gap": _with(EV, AUTUMN.replace(AUTUMN_WINDOW_START_UTC, SPRING_WINDOW_START_LOCAL))
    + """SELECT measurement_id, CASE
    WHEN measurement_time < TIMESTAMP '2026-03-29 03:00:00' THEN measurement_time - INTERVAL 2 HOUR
    WHEN measurement_time < TIMESTAMP '2026-03-29 04:00:00' THEN TIMESTAMP '2026-03-29 01:00:00'
    ELSE measurement_time - INTERVAL 3 HOUR END AS measurement_time FROM autumn""",
    "silver_write_read_days": ORACLE_SQL["silver_clean"],
    "silver_of_users": _with(*_silver_li_keys())
    + f"SELECT user_id, measurement_id, measurement_date, {_round(['measured_downstream_mbps'])} FROM silver_lk "
    + f"WHERE user_id IN ({', '.join(f'sha256({c!r})' for c in SOME_ADDRESSES)})",
    "sessions_write_read_days": ORACLE_SQL["sessions_write_read"],
    "gold_write_read": ORACLE_SQL["gold_regional_metrics"],
    "serve_density_brushed": ORACLE_SQL["serve_density_upstream"].replace(FR, f"""fr AS (
SELECT * FROM regional WHERE avg_upstream_mbps BETWEEN {BRUSH_X[0]} AND {BRUSH_X[1]}
  AND avg_downstream_mbps BETWEEN {BRUSH_Y[0]} AND {BRUSH_Y[1]}
  AND connection_periphery IN ({_in(BRUSH_REGIONS)}))"""),
    "serve_retention_years": _with(LI, SILVER_LI, *session_ctes("silver_li"), RETENTION)
    + f"""SELECT * FROM retention
WHERE session_date BETWEEN DATE '{YEARS[0]}-01-01' AND DATE '{YEARS[1]}-12-31'""",
    "serve_timestamps": _with(*REG) + """SELECT CAST(measurement_date AS TIMESTAMP) AS measurement_date,
  connection_periphery, total_tests FROM regional""",
    "default_month": """SELECT day, CAST(date_trunc('month', day - INTERVAL 1 MONTH) AS DATE) AS monthly,
  CAST(date_trunc('month', day) AS DATE) AS daily
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)""",
    "landing_month": _bronze_sql(f"WHERE year = {_re_y} AND month = {_re_m}",
                                 f"measurement_id, {_r('measured_downstream_mbps')} AS "
                                 "measured_downstream_mbps, year, month"),
    "ingest_empty_month": _bronze_sql("", f"year, month, count(*) AS n_rows, TIMESTAMP '{INGEST_STAMP_1}' "
                                          "AS ingested_at", "GROUP BY year, month"),
    "stream_ingest_many_files": _bronze_sql("", "year, month, count(*) AS n_rows", "GROUP BY year, month"),
    "stream_redelivery": _bronze_sql("", f"year, month, count(*) AS n_rows, {_r('sum(measured_downstream_mbps)')} "
                                         "AS sum_mbps", "GROUP BY year, month"),
    "stream_correction": _bronze_sql("", "year, month, count(*) AS n_rows, " + _r(
        f"sum(measured_downstream_mbps + CASE WHEN year = {_re_y} AND month = {_re_m} THEN 1000.0 ELSE 0.0 END)")
        + " AS sum_mbps", "GROUP BY year, month"),
    "refresh_full_replaces": _with(*_AFTER, *session_ctes("silver_rest"), RETENTION) + "SELECT * FROM retention",
    "refresh_incremental_equals_full": _with(*_AFTER, *session_ctes("silver_rest"), RETENTION)
    + "SELECT * FROM retention",
    "refresh_incremental_sessions": _with(*_AFTER, *session_ctes("silver_rest"))
    + f"SELECT {SESSION_COLS} FROM sessions",
    "refresh_empties_silver_month": _with(*_AFTER)
    + "SELECT year, month, count(*) AS n_rows FROM silver_rest GROUP BY 1, 2",
}
ORACLE_SQL |= {f"{name}_all": ORACLE_SQL[name].replace(FR, "fr AS (SELECT * FROM regional)")
               for name in WHOLE}
