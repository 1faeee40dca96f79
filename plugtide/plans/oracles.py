"""Reference SQL for the registered queries, as DuckDB text over the given tables.

The SQL goes operator by operator and table by table, with joins where the library uses windows and
the other way round, so that agreement means something. `statement` ends every query with the same
rendering of types that `catalog.shown` applies on the Spark side.
"""

from __future__ import annotations

from plugtide import config
from plugtide.operators import holidays
from plugtide.plans import fixture
from plugtide.plans.fixture import SETTINGS as S

# --- how columns are shown: text, whole number, double to six places, date, timestamp -------------

KINDS = {
    "s": [
        "evse_uid", "type", "location_name", "location_city", "country", "weekday", "month", "season", "city_type",
        "day_period", "daily_period_busyness_cat", "class", "feature", "model", "run", "metric", "part", "name",
        "threshold_kind",
    ],
    "d": ["first_active_day", "final_active_day", "last_session_pre_data", "session_date", "end_date", "holiday_date"],
    "t": ["started_at", "stopped_at", "last_energy_change_at"],
    "i": [
        "quarter", "year", "holiday_period", "station_charging_points", "population", "period_duration", "gap_days",
        "days_since_data_start", "weeks_since_data_start", "days_since_point_active", "weeks_since_point_active",
        "is_train", "season_encoded", "weekday_encoded", "month_encoded", "city_type_encoded", "day_period_encoded",
        "label", "prediction", "actual", "predicted", "rows", "support", "rank", "selected", "holiday_1d_shift",
        "weekday_enc_1d_shift", "session_duration", "weekday_x_holiday", "weekday_x_day_period",
        "weekday_x_holiday_1d_shift", "row_id", "draw", "fold", "positives", "features", "best", "tree", "node", "splits", "tp", "fp", "fn", "tn",
    ],
}
KIND = {name: kind for kind, names in KINDS.items() for name in names}


# Shares of a day are often exact ties at the sixth place, where the last bit of a sum would decide;
# both sides lift values a little before rounding.
NUDGE = 1e-9


def kind_of(column: str) -> str:
    return KIND.get(column, "f")


def rendered(column: str) -> str:
    return {
        "s": f"{column} AS {column}",
        "d": f"strftime({column}, '%Y-%m-%d') AS {column}",
        "t": f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {column}",
        "i": f"CAST({column} AS BIGINT) AS {column}",
        "f": f"round(CAST({column} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {column}",
    }[kind_of(column)]


# --- tables, one after the other ------------------------------------------------------------------

def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _position(column: str, order: list[str]) -> str:
    return f"(list_position([{', '.join(repr(v) for v in order)}], {column}) - 1)"


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def _names(column: str) -> str:
    return (
        f"dayname({column}) AS weekday, monthname({column}) AS month, quarter({column}) AS quarter, "
        f"{_case(f'monthname({column})', config.MONTH_TO_SEASON)} AS season, year({column}) AS year"
    )


def _seconds(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) / 1000000.0)"


def _category(compat: bool) -> str:
    upper = f"WHEN daily_period_busyness >= {config.BUSYNESS_UPPER} THEN NULL" if compat else ""
    return (
        f"CASE WHEN daily_period_busyness < 0 THEN NULL {upper} "
        f"WHEN daily_period_busyness >= 0.1 THEN 'Busy' ELSE 'Not Busy' END"
    )


POPULATION_BIN = (
    "CASE WHEN population < 0 THEN NULL WHEN population >= 1000000 THEN 'Metropolis' WHEN population >= 100000 THEN 'City' "
    "WHEN population >= 10000 THEN 'Town' ELSE 'Village' END"
)
LENGTH = "CASE day_period " + " ".join(f"WHEN '{n}' THEN {x}" for n, _, _, x in config.DAY_PERIODS) + " END"

def _operation_time(table: str) -> str:
    return f"""
SELECT g.*, date_diff('day', m.d0, session_date) AS days_since_data_start,
       CAST(floor(date_diff('day', m.d0, session_date) / 7.0) AS BIGINT) AS weeks_since_data_start,
       date_diff('day', first_active_day, session_date) AS days_since_point_active,
       CAST(floor(date_diff('day', first_active_day, session_date) / 7.0) AS BIGINT) AS weeks_since_point_active
FROM {table} g, (SELECT min(session_date) AS d0 FROM {table}) m"""


def _grid(tag: str, compat: bool) -> dict[str, str]:
    """Busyness, calendar grid and what is filled in, for one of the two rule sets."""
    end = "greatest(max(session_date), max(final_active_day))"
    if not compat:
        end = (
            "greatest(max(session_date), least(max(final_active_day), "
            f"CAST(DATE '{S.remove_after}' - INTERVAL 1 DAY AS DATE)))"
        )
    carry = []
    for c in config.CARRIED:
        if c == "period_duration" and not compat:
            carry.append(f"{LENGTH} AS period_duration")
            continue
        carry.append(
            f"coalesce(last_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({c} IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"
        )
    return {
        f"busy{tag}": f"SELECT *, {_category(compat)} AS daily_period_busyness_cat FROM measured",
        f"bounds{tag}": f"""
SELECT evse_uid,
       CASE WHEN min(first_active_day) < min(session_date)
            THEN CASE WHEN min(first_active_day) < DATE '{S.remove_before}' THEN DATE '{S.remove_before}'
                      ELSE min(first_active_day) END
            ELSE min(session_date) END AS d_from,
       {end} AS d_to
FROM agg GROUP BY evse_uid""",
        f"frame{tag}": f"""
SELECT evse_uid, session_date, day_period FROM (
  SELECT evse_uid, CAST(unnest(generate_series(d_from, d_to, INTERVAL 1 DAY)) AS DATE) AS session_date
  FROM bounds{tag}) days CROSS JOIN (SELECT DISTINCT day_period FROM agg) p""",
        f"carried{tag}": f"""
SELECT evse_uid, session_date, day_period, {', '.join(carry)},
       coalesce(usage_time, 0) AS usage_time, coalesce(daily_period_busyness, 0) AS daily_period_busyness,
       coalesce(daily_period_busyness_cat, 'Not Busy') AS daily_period_busyness_cat, avg_day_period_busyness AS apb
FROM frame{tag} LEFT JOIN busy{tag} USING (evse_uid, session_date, day_period)
WINDOW w AS (PARTITION BY evse_uid ORDER BY session_date, day_period)""",
        f"filled{tag}": f"""
SELECT c.* EXCLUDE (apb), CAST(c.session_date AS TIMESTAMP) AS started_at, {_names('c.session_date')},
       CASE WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country = c.country
                         AND abs(date_diff('day', h.holiday_date, c.session_date)) <= {S.holiday_radius_days})
            THEN 1 ELSE 0 END AS holiday_period,
       coalesce(date_diff('day', coalesce(
         last_value(CASE WHEN usage_time > 0 THEN session_date END IGNORE NULLS)
           OVER (PARTITION BY evse_uid ORDER BY session_date, day_period
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 5 PRECEDING),
         last_session_pre_data), session_date), 0) AS gap_days,
       max(apb) OVER (PARTITION BY evse_uid, day_period) AS avg_day_period_busyness
FROM carried{tag} c""",
        f"grid{tag}": _operation_time(f"filled{tag}"),
    }


def _iqr(frame: str) -> str:
    return f"(quantile_cont(daily_period_busyness, 0.75) OVER {frame} - quantile_cont(daily_period_busyness, 0.25) OVER {frame})"


PG = "PARTITION BY evse_uid, day_period ORDER BY session_date"


def _rolling(tag: str, compat: bool) -> dict[str, str]:
    """Rolling and cumulative measures of a grid, for one of the two rule sets."""
    day_means = ", ".join(
        f"coalesce(avg(daily_busyness) OVER (PARTITION BY evse_uid ORDER BY session_date "
        f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) AS daily_rolling_avg_{w}d" for w in (1, 7, 30)
    )
    period_means = ", ".join(
        f"coalesce(avg(daily_period_busyness) OVER ({PG} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) "
        f"AS daily_period_rolling_avg_{w}d" for w in (1, 7, 30)
    )
    shifted = f"""
SELECT * EXCLUDE (iqr7, iqr30),
       coalesce(lag(iqr7) OVER (ORDER BY evse_uid, day_period, session_date), 0) AS daily_period_rolling_IQR_7d,
       coalesce(lag(iqr30) OVER (ORDER BY evse_uid, day_period, session_date), 0) AS daily_period_rolling_IQR_30d
FROM spread{tag}"""
    return {
        f"day_use{tag}": f"""
SELECT *, {day_means} FROM (
  SELECT evse_uid, session_date, sum(usage_time) / 86400.0 AS daily_busyness FROM grid{tag} GROUP BY ALL)""",
        f"r5{tag}": f"SELECT g.*, d.* EXCLUDE (evse_uid, session_date) FROM grid{tag} g "
                    f"LEFT JOIN day_use{tag} d USING (evse_uid, session_date)",
        f"r6{tag}": f"SELECT *, {period_means} FROM r5{tag}",
        f"spread{tag}": "SELECT *, "
        + _iqr(f"({PG} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)") + " AS iqr7, "
        + _iqr(f"({PG} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)") + f" AS iqr30 FROM r6{tag}",
        f"r7{tag}": shifted if compat else _plain_spreads(f"r6{tag}"),
        f"r8{tag}": f"""
SELECT *, coalesce(lag(daily_period_busyness, 35) OVER (PARTITION BY evse_uid ORDER BY session_date, day_period), 0)
          AS past_week_same_period FROM r7{tag}""",
        **_cumulative("evse_uid", "daily_busyness", "", f"r8{tag}", f"r9{tag}", tag),
        **_cumulative("evse_uid, day_period", "daily_period_busyness", "period_", f"r9{tag}", f"features{tag}", tag),
    }


def _plain_spreads(source: str) -> str:
    return (
        "SELECT *, coalesce(" + _iqr(f"({PG} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")
        + ", 0) AS daily_period_rolling_IQR_7d, coalesce("
        + _iqr(f"({PG} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")
        + f", 0) AS daily_period_rolling_IQR_30d FROM {source}"
    )


def _cumulative(group: str, value: str, prefix: str, source: str, result: str, tag: str) -> dict[str, str]:
    tables, joins, columns = {}, "", ""
    for name, unit in (("weekly", "weeks_since_data_start"), ("daily", "days_since_data_start")):
        tables[f"{prefix}{name}{tag}"] = f"""
SELECT {group}, {unit}, coalesce(avg(m) OVER (PARTITION BY {group} ORDER BY {unit}
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS {prefix}{name}_cumulative_average
FROM (SELECT {group}, {unit}, avg({value}) AS m FROM {source} GROUP BY {group}, {unit})"""
        joins += f" LEFT JOIN {prefix}{name}{tag} USING ({group}, {unit})"
        columns += f", {prefix}{name}_cumulative_average"
    tables[result] = f"SELECT s.*{columns} FROM {source} s{joins}"
    return tables


def _rolled(tag: str, compat: bool) -> dict[str, str]:
    firsts = ", ".join(
        f"first({c} ORDER BY evse_uid) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in config.STATION_FIRSTS
    )
    means = ", ".join(f"avg({c}) AS {c}" for c in config.STATION_MEANS)
    return {f"rolled{tag}": f"""
SELECT *, {_category(compat)} AS daily_period_busyness_cat FROM (
  SELECT session_date, day_period, location_name, min(first_active_day) AS first_active_day, min(gap_days) AS gap_days,
         sum(usage_time) AS usage_time, {firsts}, {means}
  FROM features{tag} WHERE location_name IS NOT NULL GROUP BY session_date, day_period, location_name)"""}


def _prepared(features: str, group: str, tag: str) -> dict[str, str]:
    """Split, encodings, shifts, products and differences at one grain."""
    encoded = ", ".join(f"{_position(c, order)} AS {c}_encoded" for c, order in config.ORDINAL_ORDERS.items())
    lookups = "".join(
        f" LEFT JOIN (SELECT {c} AS value, (avg(daily_period_busyness) * count(*) + max(o.m) * {S.alpha}) "
        f"/ (count(*) + {S.alpha}) AS e FROM split{tag}, overall{tag} o WHERE is_train = 1 GROUP BY {c}) e{i} "
        f"ON s.{c} = e{i}.value"
        for i, c in enumerate(("location_city", group))
    )
    averages = {"daily_busyness_2d_shift": "daily_rolling_avg_1d", "daily_period_busyness_2d_shift": "daily_period_rolling_avg_1d"}
    shifted = ", ".join(
        f"coalesce(lag({c}) OVER (w ORDER BY session_date), (SELECT avg({c}) FROM ordinals{tag} x WHERE x.is_train = o.is_train)) AS {n}"
        for n, c in averages.items()
    )
    return {
        f"numbered{tag}": f"""
SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY session_date, day_period) AS rn,
          count(*) OVER (PARTITION BY {group}) AS n FROM {features} WHERE {group} IS NOT NULL""",
        f"split{tag}": f"SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(n * CAST({S.split_ratio} AS DOUBLE)) THEN 1 ELSE 0 END AS is_train FROM numbered{tag}",
        f"overall{tag}": f"SELECT avg(daily_period_busyness) AS m FROM split{tag} WHERE is_train = 1",
        f"targets{tag}": f"""
SELECT s.*, CASE WHEN is_train = 1 THEN e0.e ELSE coalesce(e0.e, o.m) END AS location_city_encoded,
       CASE WHEN is_train = 1 THEN e1.e ELSE coalesce(e1.e, o.m) END AS {group}_encoded
FROM split{tag} s {lookups} CROSS JOIN overall{tag} o""",
        f"ordinals{tag}": f"SELECT *, {encoded} FROM targets{tag}",
        f"shifts{tag}": f"""
SELECT *, coalesce(lag(holiday_period) OVER (w ORDER BY session_date),
                   arg_max(holiday_period, session_date) OVER (w), 0) AS holiday_1d_shift,
       coalesce(lag(weekday_encoded) OVER (w ORDER BY session_date), (weekday_encoded + 6) % 7) AS weekday_enc_1d_shift,
       {shifted}
FROM ordinals{tag} o WINDOW w AS (PARTITION BY is_train, {group}, day_period)""",
        f"crossed{tag}": f"""
SELECT *, weekday_encoded * holiday_period AS weekday_x_holiday,
       weekday_encoded * day_period_encoded AS weekday_x_day_period,
       weekday_enc_1d_shift * holiday_1d_shift AS weekday_x_holiday_1d_shift,
       daily_rolling_avg_1d - daily_busyness_2d_shift AS busyness_change,
       daily_period_rolling_avg_1d - daily_period_busyness_2d_shift AS period_busyness_change,
       {_position('daily_period_busyness_cat', config.BUSYNESS_ORDER)} AS label
FROM shifts{tag}""",
    }


def tables() -> dict[str, str]:
    firsts = ", ".join(
        f"first({c} ORDER BY started_at, {c}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in config.POINT_FIRSTS if c != 'gap_days'
    )
    periods = _values([(n, a, b, x) for n, a, b, x in config.DAY_PERIODS])
    before, after = f"TIMESTAMP '{S.remove_before}'", f"TIMESTAMP '{S.remove_after}'"
    chg = _seconds("started_at", "last_energy_change_at")
    return {
        "sessions": fixture.for_duckdb(fixture.SESSIONS_SQL),
        "charge_points": fixture.for_duckdb(fixture.POINTS_SQL),
        "holidays": fixture.for_duckdb(fixture.HOLIDAYS_SQL),
        "population": fixture.for_duckdb(fixture.POPULATION_SQL),
        "scores": fixture.for_duckdb(fixture.SCORES_SQL),
        "day_periods": f"SELECT * FROM (VALUES {periods}) AS p(day_period, start_s, end_s, period_duration)",
        # cleaning
        "typed": """
SELECT s.*, t.type FROM sessions s
LEFT JOIN (SELECT evse_uid, min(type) AS type FROM charge_points GROUP BY evse_uid) t USING (evse_uid)""",
        "c1": "SELECT DISTINCT * FROM typed",
        "c2": "SELECT * REPLACE (CASE WHEN last_energy_change_at < started_at THEN stopped_at ELSE last_energy_change_at END AS last_energy_change_at) FROM c1",
        "c3": "SELECT * REPLACE (coalesce(stopped_at, started_at + duration_seconds * INTERVAL '1' SECOND) AS stopped_at) FROM c2",
        "c4": "SELECT * REPLACE (coalesce(last_energy_change_at, stopped_at) AS last_energy_change_at) FROM c3",
        "c5": f"SELECT * REPLACE ({_seconds('started_at', 'stopped_at')} AS duration_seconds) FROM c4",
        "c6": f"SELECT * FROM c5 WHERE coalesce(NOT (year(started_at) < {S.oldest_year}), TRUE)",
        "c7": f"""
SELECT * FROM (
  SELECT *, CAST(min(started_at) OVER w AS DATE) AS first_active_day,
         CAST(max(started_at) OVER w AS DATE) AS final_active_day,
         CAST(coalesce(max(started_at) FILTER (WHERE started_at < {before}) OVER w, min(started_at) OVER w) AS DATE)
           AS last_session_pre_data
  FROM c6 WINDOW w AS (PARTITION BY evse_uid))
WHERE started_at >= {before} AND started_at < {after}""",
        "c8": f"SELECT * FROM c7 WHERE coalesce(NOT (duration_seconds < {S.min_session_s}), TRUE)",
        "c9": "SELECT * FROM c8 WHERE coalesce(NOT (energy_wh <= 0), TRUE)",
        "c10": f"SELECT * FROM c9 WHERE coalesce(NOT (duration_seconds > {S.max_session_s}), TRUE)",
        "idle": f"""
SELECT evse_uid FROM c10 GROUP BY evse_uid
HAVING sum(duration_seconds) / nullif({_seconds('min(started_at)', 'max(stopped_at)')}, 0) < {S.active_life}""",
        "c11": "SELECT * FROM c10 WHERE evse_uid NOT IN (SELECT evse_uid FROM idle)",
        "c12": f"SELECT * FROM c11 WHERE type = '{S.point_type}'",
        "c13": f"""
SELECT * FROM c12 WHERE evse_uid NOT IN (
  SELECT evse_uid FROM c12 GROUP BY evse_uid HAVING count(started_at) < {S.min_sessions})""",
        "c14": """
SELECT * EXCLUDE (next_start) REPLACE (
  CASE WHEN stopped_at > next_start THEN last_energy_change_at ELSE stopped_at END AS stopped_at)
FROM (SELECT *, lead(started_at) OVER (PARTITION BY evse_uid ORDER BY started_at NULLS FIRST,
        stopped_at NULLS FIRST, last_energy_change_at NULLS FIRST, energy_wh NULLS FIRST) AS next_start FROM c13)""",
        # features
        "f2": f"SELECT *, energy_wh / 1000.0 AS energy_kwh, {chg} AS session_charging_duration FROM c14",
        "f5": """
SELECT f2.*, l.station_avg_power, p.point_avg_power, l.station_charging_points FROM f2
LEFT JOIN (SELECT location_name, sum(energy_kwh) / nullif(sum(session_charging_duration) / 3600.0, 0) AS station_avg_power,
                  count(DISTINCT evse_uid) AS station_charging_points FROM f2 GROUP BY location_name) l USING (location_name)
LEFT JOIN (SELECT evse_uid, sum(energy_kwh) / nullif(sum(session_charging_duration) / 3600.0, 0) AS point_avg_power
           FROM f2 GROUP BY evse_uid) p USING (evse_uid)""",
        "f7": f"SELECT *, {_names('started_at')}, CAST(started_at AS DATE) AS session_date, CAST(stopped_at AS DATE) AS end_date FROM f5",
        "f8": f"""
SELECT *, CASE WHEN EXISTS (SELECT 1 FROM holidays h WHERE h.country = f7.country
  AND abs(date_diff('day', h.holiday_date, CAST(f7.started_at AS DATE))) <= {S.holiday_radius_days}) THEN 1 ELSE 0 END AS holiday_period
FROM f7""",
        "f9": """
SELECT f8.*, p.population FROM f8 LEFT JOIN population p USING (location_city, country)
WHERE f8.location_city IS NOT NULL AND f8.country IS NOT NULL""",
        "f10": f"""
SELECT *, {POPULATION_BIN} AS city_type
FROM (SELECT * REPLACE (CASE WHEN population IS NULL OR population = 0 THEN {config.UNKNOWN_POPULATION} ELSE population END AS population) FROM f9)""",
        "parts": """
SELECT *, session_date + n AS day, CASE WHEN n = 0 THEN started_at ELSE CAST(session_date + n AS TIMESTAMP) END AS a,
       CASE WHEN n = span THEN stopped_at ELSE CAST(session_date + n AS TIMESTAMP) + INTERVAL '86399' SECOND END AS b,
       date_diff('day', session_date + n, CAST(last_energy_change_at AS DATE)) AS k
FROM (SELECT *, CAST(unnest(range(0, span + 1)) AS INTEGER) AS n FROM (
        SELECT *, CAST(date_diff('day', session_date, end_date) AS INTEGER) AS span FROM f10) WHERE span >= 0)""",
        "part_seconds": f"""
SELECT *, CASE WHEN k > 0 THEN {_seconds('a', 'b')} + 1 WHEN k = 0 THEN {_seconds('a', 'last_energy_change_at')} ELSE 0 END AS part_s
FROM parts""",
        "f11": f"""
SELECT * EXCLUDE (span, n, day, a, b, k, part_s) REPLACE (
  CASE WHEN span = 0 THEN energy_wh WHEN k >= 0 THEN energy_wh * part_s / nullif(session_charging_duration, 0) ELSE 0 END AS energy_wh,
  CASE WHEN span = 0 THEN energy_kwh WHEN k >= 0 THEN energy_wh * part_s / nullif(session_charging_duration, 0) / 1000.0 ELSE 0 END AS energy_kwh,
  CASE WHEN span = 0 THEN session_charging_duration ELSE part_s END AS session_charging_duration,
  CASE WHEN span = 0 THEN last_energy_change_at WHEN k > 0 THEN b WHEN k = 0 THEN last_energy_change_at END AS last_energy_change_at,
  CASE WHEN span = 0 THEN started_at ELSE a END AS started_at,
  CASE WHEN span = 0 THEN stopped_at ELSE b END AS stopped_at,
  CASE WHEN span = 0 THEN weekday ELSE dayname(day) END AS weekday,
  CASE WHEN span = 0 THEN session_date ELSE day END AS session_date,
  CASE WHEN span = 0 THEN end_date ELSE day END AS end_date),
  CASE WHEN span > 0 THEN CAST(trunc({_seconds('a', 'b')} + CASE WHEN n = span THEN 0 ELSE 1 END) AS BIGINT) END AS session_duration
FROM part_seconds""",
        "f12": """
SELECT * EXCLUDE (x, y, start_s, end_s),
       (CASE WHEN started_at IS NULL OR stopped_at IS NULL THEN NULL WHEN x >= y THEN 0 ELSE (epoch_us(y) - epoch_us(x)) / 1000000.0 END)
       + CASE WHEN day_period = 'night' AND CAST(stopped_at AS TIME) = TIME '23:59:59' THEN 1 ELSE 0 END AS usage_time
FROM (SELECT *, greatest(started_at, date_trunc('day', started_at) + start_s * INTERVAL '1' SECOND) AS x,
             least(stopped_at, date_trunc('day', started_at) + end_s * INTERVAL '1' SECOND) AS y
      FROM f11 CROSS JOIN day_periods)""",
        "lives": f"SELECT evse_uid, {_seconds('min(started_at)', 'max(stopped_at)')} AS life, sum(usage_time) AS used FROM f12 GROUP BY evse_uid",
        "f13": f"""
SELECT f12.*, l.used / nullif(l.life, 0) AS avg_total_busyness,
       u.used / nullif(l.life * (({LENGTH}) / 86400.0), 0) AS avg_day_period_busyness
FROM f12 LEFT JOIN lives l USING (evse_uid)
LEFT JOIN (SELECT evse_uid, day_period, sum(usage_time) AS used FROM f12 GROUP BY evse_uid, day_period) u USING (evse_uid, day_period)""",
        # grid
        "agg": f"SELECT session_date, day_period, evse_uid, coalesce(sum(usage_time), 0) AS usage_time, {firsts} FROM f13 GROUP BY ALL",
        "operated": _operation_time("agg"),
        "measured": f"SELECT *, usage_time / ({LENGTH}) AS daily_period_busyness FROM agg",
        **_grid("", True),
        **_grid("_repaired", False),
        **_rolling("", True),
        **_rolling("_repaired", False),
        "r7_plain": _plain_spreads("r6"),
        **_rolled("", True),
        **_rolled("_repaired", False),
        **_prepared("features", "evse_uid", "_points"),
        **_prepared("rolled", "location_name", "_stations"),
        **_prepared("rolled_repaired", "location_name", "_stations_repaired"),
        # measures
        "predicted": "SELECT label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scores",
        "counts": """
SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM predicted""",
        "thresholds": """
SELECT t.score AS threshold, count(*) FILTER (WHERE s.label = 1) AS tp, count(*) FILTER (WHERE s.label = 0) AS fp,
       max(n.pos) AS pos, max(n.neg) AS neg
FROM (SELECT DISTINCT score FROM scores) t JOIN scores s ON s.score >= t.score,
     (SELECT count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scores) n
GROUP BY t.score""",
        "corners": """
SELECT * FROM (
  SELECT *, lead(tp) OVER w AS next_tp, lead(fp) OVER w AS next_fp, lag(tp) OVER w AS last_tp, lag(fp) OVER w AS last_fp
  FROM thresholds WINDOW w AS (ORDER BY threshold DESC))
WHERE next_tp IS NULL OR last_tp IS NULL OR next_tp - tp <> tp - last_tp OR next_fp - fp <> fp - last_fp""",
        "pr": """
SELECT threshold, tp / CAST(tp + fp AS DOUBLE) AS precision, tp / CAST(pos AS DOUBLE) AS recall FROM thresholds""",
        "f1s": "SELECT *, 2 * (precision * recall) / (precision + recall + 1e-10) AS f1 FROM pr",
        "tuned": """
SELECT b.threshold AS optimal_threshold, b.precision AS optimal_precision, b.recall AS optimal_recall, b.f1 AS optimal_f1,
       d.threshold AS default_threshold, d.precision AS default_precision, d.recall AS default_recall, d.f1 AS default_f1
FROM (SELECT * FROM f1s ORDER BY f1 DESC, threshold LIMIT 1) b,
     (SELECT * FROM f1s ORDER BY abs(threshold - 0.5), threshold LIMIT 1) d""",
        "tuned_counts": """
SELECT count(*) FILTER (WHERE label = 1 AND score >= t) AS tp, count(*) FILTER (WHERE label = 0 AND score >= t) AS fp,
       count(*) FILTER (WHERE label = 1 AND score < t) AS fn, count(*) FILTER (WHERE label = 0 AND score < t) AS tn
FROM scores, (SELECT optimal_threshold AS t FROM tuned)""",
    }


# Easter by the paschal full moon of the year's golden number, and weekdays counted day by day.
RULED_DAYS = {
    "ruled_years": f"""
SELECT DISTINCT year(CAST(started_at AS DATE) + CAST(d AS INTEGER)) AS y FROM sessions, (SELECT unnest([-{S.holiday_radius_days}, {S.holiday_radius_days}]) AS d)
WHERE started_at IS NOT NULL""",
    "ruled_moons": """
SELECT y, (19 * (y % 19) + y // 100 - (y // 100) // 4 - ((y // 100) - ((y // 100) + 8) // 25 + 1) // 3 + 15) % 30 AS m FROM ruled_years""",
    "ruled_easter": """
SELECT y, make_date(y, n // 31, n % 31 + 1) AS easter FROM (
  SELECT y, m + l - 7 * ((y % 19 + 11 * m + 22 * l) // 451) + 114 AS n FROM (
    SELECT y, m, (32 + 2 * ((y // 100) % 4) + 2 * ((y % 100) // 4) - m - (y % 100) % 4) % 7 AS l FROM ruled_moons))""",
    "ruled_rules": f"SELECT * FROM (VALUES {_values(holidays.RULES)}) r({', '.join(holidays.FIELDS)})",
    "ruled_month": """
SELECT y, CAST(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM ruled_years""",
    "ruled_counted": """
SELECT y, d, month(d) AS mo, isodow(d) AS wd, row_number() OVER (PARTITION BY y, month(d), isodow(d) ORDER BY d) AS nth,
       row_number() OVER (PARTITION BY y, month(d), isodow(d) ORDER BY d DESC) AS back FROM ruled_month""",
    "ruled_dates": """
SELECT r.*, d FROM ruled_rules r JOIN ruled_counted ON kind = 'weekday' AND mo = a AND wd = b AND CASE WHEN c > 0 THEN nth = c ELSE back = 1 END AND y BETWEEN since AND until
UNION ALL SELECT r.*, d FROM ruled_rules r JOIN ruled_month ON kind = 'fixed' AND month(d) = a AND day(d) = b AND y BETWEEN since AND until
UNION ALL SELECT r.*, easter + a FROM ruled_rules r JOIN ruled_easter ON kind = 'easter' AND y BETWEEN since AND until""",
    "ruled_days": """
SELECT country, d AS holiday_date FROM ruled_dates
UNION SELECT country, CAST(d + CASE isodow(d) WHEN 6 THEN saturday WHEN 7 THEN sunday ELSE 0 END AS DATE) FROM ruled_dates""",
}

MEASURES = """
SELECT (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS accuracy,
       coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS precision,
       coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS recall,
       coalesce(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0) AS f1 FROM {counts}"""

REPORT = """
SELECT class, precision, recall, f1, support FROM (
  SELECT 'Not Busy' AS class, tn / CAST(tn + fn AS DOUBLE) AS precision, tn / CAST(tn + fp AS DOUBLE) AS recall,
         2 * tn / CAST(2 * tn + fp + fn AS DOUBLE) AS f1, tn + fp AS support FROM counts
  UNION ALL SELECT 'Busy', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE),
         2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), tp + fn FROM counts)"""

RANKED = """
SELECT *, importance / sum(importance) OVER () AS normalized_importance,
       row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM importances"""


def statement(query: str, columns: list[str], extra: dict[str, str] | None = None) -> str:
    """`query`, with the tables it needs, and its columns rendered.

    Every table is materialised: several are read more than once.
    """
    available = {**tables(), **(extra or {})}
    needed: dict[str, None] = {}

    def add(text: str) -> None:
        words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in text).split())
        for name, body in available.items():
            if name in words and name not in needed and body is not text:
                add(body)
                needed[name] = None

    add(query)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({available[name].strip()})" for name in needed)
    shown = ", ".join(rendered(c) for c in columns)
    tables_first = f"WITH {ctes}\n" if needed else ""
    return f"{tables_first}SELECT {shown} FROM ({query.strip()}) AS result"


# --- evaluation tables ------------------------------------------------------------------------------

def _shown_counts(kind: str, counts: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT 'confusion_matrix' AS part, '{kind}' AS threshold_kind, '{cell}' AS name, NULL AS threshold, "
        f"{column} AS x, NULL AS y, NULL AS z FROM {counts}"
        for cell, column in (("0-0", "tn"), ("0-1", "fp"), ("1-0", "fn"), ("1-1", "tp"))
    )
    report = REPORT.replace("FROM counts", f"FROM {counts}")
    total, right = "CAST(tp + tn + fp + fn AS DOUBLE)", "(tp + tn)"
    return f"""{cells}
UNION ALL SELECT 'classification_report', '{kind}', class, NULL, precision, recall, f1 FROM ({report})
UNION ALL SELECT 'classification_report', '{kind}', 'accuracy', NULL, {right} / {total}, {right} / {total}, {right} / {total} FROM {counts}
UNION ALL SELECT 'classification_report', '{kind}', 'macro avg', NULL, avg(precision), avg(recall), avg(f1) FROM ({report})
UNION ALL SELECT 'classification_report', '{kind}', 'weighted avg', NULL, sum(precision * support) / sum(support),
  sum(recall * support) / sum(support), sum(f1 * support) / sum(support) FROM ({report})"""


EVALUATION = f"""
{_shown_counts('default', 'counts')}
UNION ALL {_shown_counts('optimal', 'tuned_counts')}
UNION ALL SELECT 'roc_curve', NULL, NULL, threshold, fp / CAST(neg AS DOUBLE), tp / CAST(pos AS DOUBLE), NULL FROM corners
UNION ALL SELECT 'roc_curve', NULL, NULL, NULL, 0, 0, NULL
UNION ALL SELECT 'pr_curve', NULL, NULL, threshold, precision, recall, NULL FROM pr
UNION ALL SELECT 'pr_curve', NULL, NULL, NULL, 1, 0, NULL
UNION ALL SELECT 'f1_by_threshold', NULL, NULL, threshold, precision, recall, f1 FROM f1s"""
