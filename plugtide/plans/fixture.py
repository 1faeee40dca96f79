"""The input tables of the pipeline as views on the given test tables.

The rules turn `events` into a session log with everything the repairs and filters look for: copies,
starts twenty years too old, missing and wrong times, idle points, overlaps, sessions over midnight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plugtide.config import Settings

SETTINGS = Settings(remove_before="2024-01-05", remove_after="2024-01-28", max_session_s=100000)

# {text} is the engine's string type.
SESSIONS_SQL = """
WITH e AS (
  SELECT event_id, user_id, event_type, ts AS st,
         CASE WHEN user_id % 10 = 9 THEN CAST(floor(round(value*100)*4/40) AS BIGINT)
              ELSE CAST(round(value*100) AS BIGINT)*4 END AS dur,
         CAST(round(value*100) AS BIGINT) AS v100 FROM events),
s AS (
  SELECT event_id, concat('P', lpad(CAST(user_id AS {text}),6,'0')) AS evse_uid,
    CASE WHEN event_id % 97 = 0 THEN st - INTERVAL '7300' DAY ELSE st END AS started_at,
    dur, event_type, v100, user_id FROM e),
t AS (
  SELECT evse_uid, started_at,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE started_at + dur * INTERVAL '1' SECOND END AS stopped_at,
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN started_at - INTERVAL '60' SECOND
         ELSE started_at + CAST(floor(dur*4/5) AS BIGINT) * INTERVAL '1' SECOND END AS last_energy_change_at,
    CASE WHEN event_type = 'error' THEN 0.0 ELSE CAST(v100*2 AS DOUBLE) END AS energy_wh,
    CASE WHEN event_id % 19 = 0 AND event_id % 17 <> 0 THEN dur + 7 ELSE dur END AS duration_seconds,
    concat('S', lpad(CAST(CAST(floor(user_id/3) AS BIGINT) AS {text}),6,'0')) AS location_name,
    concat('CITY', CAST(CAST(floor(user_id/3) AS BIGINT) % 25 AS {text})) AS location_city,
    'GB' AS country, event_id FROM s)
SELECT evse_uid, started_at, stopped_at, last_energy_change_at, energy_wh, duration_seconds,
       location_name, location_city, country FROM t
UNION ALL
SELECT evse_uid, started_at, stopped_at, last_energy_change_at, energy_wh, duration_seconds,
       location_name, location_city, country FROM t WHERE event_id % 50 = 0
"""
POINTS_SQL = """
SELECT DISTINCT concat('P', lpad(CAST(user_id AS {text}),6,'0')) AS evse_uid,
       CASE WHEN user_id % 7 = 0 THEN 'private' ELSE 'public' END AS type FROM events
"""
HOLIDAYS_SQL = """
SELECT * FROM (VALUES ('GB', DATE '2024-01-01'), ('GB', DATE '2024-01-15'), ('FR', DATE '2024-01-20'))
  AS h(country, holiday_date)
"""
POPULATION_SQL = """
SELECT concat('CITY', CAST(n_nationkey AS {text})) AS location_city, 'GB' AS country,
       CASE WHEN n_nationkey % 11 = 5 THEN NULL
            ELSE CAST(n_nationkey AS BIGINT)*n_nationkey*n_nationkey*1000 END AS population
FROM nation WHERE n_nationkey <> 22
"""
SCORES_SQL = """
SELECT event_id AS row_id, CASE WHEN event_type IN ('click','signup') THEN 1 ELSE 0 END AS label,
       round(value / (value + 200), 4) AS score FROM events
"""


def for_duckdb(sql: str) -> str:
    return sql.format(text="VARCHAR")


class Fixture:
    """The input tables at one scale, each a lazy DataFrame on the test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _view(self, table: str, sql: str) -> DataFrame:
        sql = sql.format(text="STRING")
        given = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return self.spark.sql(sql.replace(f"FROM {table}", f"FROM {{{table}}}"), **{table: given})

    @property
    def sessions(self) -> DataFrame:
        return self._view("events", SESSIONS_SQL)

    @property
    def points(self) -> DataFrame:
        return self._view("events", POINTS_SQL)

    @property
    def holidays(self) -> DataFrame:
        return self.spark.sql(HOLIDAYS_SQL)

    @property
    def population(self) -> DataFrame:
        return self._view("nation", POPULATION_SQL)

    @property
    def scores(self) -> DataFrame:
        return self._view("events", SCORES_SQL)
