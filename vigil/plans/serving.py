"""Serving queries over the marts, as named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.expressions import clock, list_text
from vigil.operators import serving
from vigil.plans import risk
from vigil.plans.sql import sql

DATE, CITY, EARLY, LATE = "2024-01-09", "ASIA", "20240109T000000Z", "20240110T000000Z"


def runs_of(date: F.Column, late: F.Column) -> F.Column:
    """The runs that have a row: the early one the first dates, the late one the last ones."""
    return F.explode(F.array_compact(F.array(F.when(date <= F.lit(DATE).cast("date"), EARLY), F.when((date >= F.lit(DATE).cast("date")) & late, LATE))))


def exposure_history(s: SparkSession, d: str) -> DataFrame:
    """Two runs; the late one is without every seventh member."""
    return risk.exposed(s, d).withColumn("run_id", runs_of(F.col("decision_date"), F.col("member_id") % 7 != 0))


def workload_history(s: SparkSession, d: str) -> DataFrame:
    """Two runs; the late one has a member at risk more."""
    rows = risk.worked(s, d).withColumn("run_id", runs_of(F.col("decision_date"), F.lit(True)))
    return rows.withColumn("at_risk_members", F.col("at_risk_members") + F.when(F.col("run_id") == LATE, 1).otherwise(0))


def dated(df: DataFrame) -> DataFrame:
    return df.withColumn("decision_date", F.col("decision_date").cast("string"))


def g6(s: SparkSession, d: str) -> DataFrame:
    rows = serving.affected_members(risk.exposed(s, d), DATE, severity="critical")
    return rows.select("member_id", "city_id", F.col("signal_name").alias("driver"), "severity", "priority_score", F.col("preferred_channel").alias("channel"), list_text(F.col("matched_conditions")).alias("conditions"),
                       list_text(F.col("metrics")).alias("metrics"), F.col("outreach_eligible").alias("reachable"), clock(F.col("window_start")).alias("window_start"), F.col("city_at_risk_members").alias("exposed_in_city"))


ON = f"decision_date = DATE '{DATE}'"
#: Rows of the date; a row per member of them; a row per member and some group; cities with a row in the summary.
DAY = f""", day AS (SELECT * FROM exposure WHERE {ON}), people AS (SELECT city_id, member_id, bool_or(outreach_eligible) AS e, max(priority_score) AS s FROM day GROUP BY ALL),
  burden AS (SELECT city_id, count(*) AS n, count(*) FILTER (WHERE e) AS r, count(*) FILTER (WHERE s >= 4) AS u FROM people GROUP BY city_id),
  pull AS (SELECT signal_name AS driver, sum(n) AS n, sum(r) AS r, count(*) AS cities, max(k) AS k FROM (SELECT signal_name, city_id, count(*) AS n, count(*) FILTER (WHERE e) AS r, max(k) AS k
    FROM (SELECT signal_name, city_id, member_id, bool_or(outreach_eligible) AS e, max(severity_rank) AS k FROM day GROUP BY ALL) GROUP BY ALL) GROUP BY driver)
"""
PLACES = f", places AS (SELECT city_id, count(*) AS total FROM members WHERE city_id IN (SELECT city_id FROM summary WHERE {ON}) AND city_id IN (SELECT city_id FROM cities) GROUP BY city_id)"
#: The runs of a row, by a list that is unnested.
RUNS = f"list_filter(['{EARLY}', '{LATE}'], lambda r: CASE r WHEN '{EARLY}' THEN decision_date <= DATE '{DATE}' ELSE decision_date >= DATE '{DATE}' AND {{0}} END)"
WORKED = f", worked AS (SELECT decision_date, city_id, total_members, contactable_members, run_id, at_risk_members + (run_id = '{LATE}')::INT AS exposed FROM (SELECT *, unnest({RUNS.format('true')}) AS run_id FROM workload))"
SHOWN_SQL = ", ".join(f"('{m}', '{label}', '{unit}')" for m, (label, unit) in serving.SHOWN.items())
USUAL = ", ".join(f"round(historical_{c}, 1) AS usual_{c}" for c in ("average", "p10", "p90", "p95", "minimum", "maximum"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "g1_available_dates": lambda s, d: dated(serving.available_dates(workload_history(s, d))),
    "g2_default_date": lambda s, d: dated(serving.default_date(serving.available_dates(workload_history(s, d)), "2031-01-01")),
    "g3_condition_ticker": lambda s, d: serving.ticker(risk.daily(s, d), risk.summary(s, d), DATE).withColumnRenamed("observed_persistence_hours", "hours"),
    "g4_executive_kpis": lambda s, d: serving.executive_kpis(risk.worked(s, d), DATE),
    "g5_relevant_metrics": lambda s, d: serving.relevant_metrics(risk.daily(s, d), risk.summary(s, d), DATE),
    "g6_affected_members": g6,
    "g7_outreach_readiness": lambda s, d: serving.outreach_readiness(risk.worked(s, d), DATE),
    "g8_risk_driver_impact": lambda s, d: serving.risk_driver_impact(risk.exposed(s, d), DATE),
    "g9_condition_workload": lambda s, d: serving.condition_workload(risk.exposed(s, d), DATE),
    "g10_channel_workload": lambda s, d: serving.channel_workload(risk.exposed(s, d), DATE),
    "g11_risk_lifecycle": lambda s, d: serving.risk_lifecycle(exposure_history(s, d), "2024-01-10"),
    "g12_risk_trend": lambda s, d: dated(serving.risk_trend(workload_history(s, d), CITY)),
    "g13_highlights": lambda s, d: serving.highlights(serving.outreach_readiness(risk.worked(s, d), DATE), serving.risk_driver_impact(risk.exposed(s, d), DATE)),
    "g14_latest_source_time": lambda s, d: risk.hours(s, d).agg(clock(F.max("observed_at")).alias("latest_source_time")),
    "g15_active_conditions": lambda s, d: serving.on_date(risk.daily(s, d), DATE).agg(F.count("*").alias("active_conditions")),
    "i1_replicated_exposure": lambda s, d: serving.replicated_exposure(risk.exposed(s, d), DATE, 20),
}
SQL: dict[str, str] = {
    "g1_available_dates": sql(WORKED + " SELECT decision_date::VARCHAR AS decision_date, max(run_id) AS latest_run_id FROM worked GROUP BY decision_date", "workload"),
    "g2_default_date": sql(WORKED + " SELECT decision_date::VARCHAR AS decision_date FROM worked ORDER BY worked.decision_date = DATE '2031-01-01' DESC, worked.decision_date DESC LIMIT 1", "workload"),
    "g3_condition_ticker": sql(f", warmth AS (SELECT city_id, round(minimum_value, 1) AS minimum_temperature, round(maximum_value, 1) AS maximum_temperature FROM summary WHERE {ON} AND metric = 'temperature_2m') SELECT d.city_id, signal_name, severity, predicate_explanation, hours, minimum_temperature, maximum_temperature FROM (FROM daily WHERE {ON}) d LEFT JOIN warmth w ON w.city_id = d.city_id", "daily", "summary"),
    "g4_executive_kpis": sql(DAY + PLACES + " SELECT *, round(100.0::DOUBLE * exposed / nullif(population, 0), 2) AS exposed_share FROM (SELECT sum(total)::BIGINT AS population, coalesce(sum(n), 0)::BIGINT AS exposed, coalesce(sum(r), 0)::BIGINT AS reachable, coalesce(sum(u), 0)::BIGINT AS urgent, count(n) AS cities_hit FROM places LEFT JOIN burden USING (city_id))", "exposure", "members", "summary", "cities"),
    "g5_relevant_metrics": sql(f", shown AS (SELECT * FROM (VALUES {SHOWN_SQL}) t(metric, label, unit)), named AS (SELECT DISTINCT city_id, unnest(string_split(metrics, '|')) AS metric FROM daily WHERE {ON}) SELECT city_id, coalesce(label, metric) AS metric, unit, round(minimum_value, 1) AS low, round(average_value, 1) AS mean, round(maximum_value, 1) AS high, {USUAL} FROM named JOIN (FROM summary WHERE {ON}) USING (city_id, metric) LEFT JOIN shown USING (metric)", "daily", "summary"),
    "g6_affected_members": sql(DAY + " SELECT * EXCLUDE (rule_id) FROM (SELECT member_id, day.city_id, signal_name AS driver, severity, priority_score, preferred_channel AS channel, matched_conditions AS conditions, metrics, outreach_eligible AS reachable, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, n AS exposed_in_city, rule_id FROM day JOIN burden ON burden.city_id = day.city_id WHERE severity = 'critical') ORDER BY priority_score DESC, exposed_in_city DESC, city_id, member_id, rule_id, window_start LIMIT 2000", "exposure"),
    "g7_outreach_readiness": sql(DAY + " SELECT city_id, n AS exposed, r AS reachable, n - r AS unreachable, round(100.0::DOUBLE * r / n, 1) AS reachable_share FROM burden", "exposure"),
    "g8_risk_driver_impact": sql(DAY + " SELECT driver, n::BIGINT AS exposed, r::BIGINT AS reachable, cities, k AS worst_rank FROM pull", "exposure"),
    "g9_condition_workload": sql(DAY + " SELECT condition, count(*) AS exposed, count(*) FILTER (WHERE e) AS reachable, count(*) FILTER (WHERE s >= 4) AS urgent FROM (SELECT condition, member_id, bool_or(outreach_eligible) AS e, max(priority_score) AS s FROM (SELECT *, unnest(string_split(matched_conditions, '|')) AS condition FROM day) GROUP BY ALL) GROUP BY condition", "exposure"),
    "g10_channel_workload": sql(DAY + " SELECT channel, count(*) AS reachable, count(*) FILTER (WHERE s >= 4) AS urgent FROM (SELECT preferred_channel AS channel, member_id, max(priority_score) FILTER (WHERE outreach_eligible) AS s FROM day GROUP BY ALL) WHERE s IS NOT NULL GROUP BY channel", "exposure"),
    "g11_risk_lifecycle": sql(f""", seen AS (SELECT *, dense_rank() OVER (PARTITION BY decision_date ORDER BY run_id DESC) AS age FROM (SELECT decision_date, member_id, city_id, rule_id, severity_rank AS k, unnest({RUNS.format('member_id % 7 <> 0')}) AS run_id FROM exposure)),
      near AS (SELECT *, CASE WHEN decision_date = DATE '2024-01-10' THEN 0 ELSE dense_rank() OVER (PARTITION BY decision_date = DATE '2024-01-10' ORDER BY decision_date DESC) END AS back FROM seen WHERE age = 1 AND decision_date <= DATE '2024-01-10'),
      ranks AS (SELECT member_id, list(k) FILTER (WHERE back = 0) AS a, list(k) FILTER (WHERE back = 1) AS b FROM near WHERE back < 2 GROUP BY member_id, city_id, rule_id)
      SELECT change, count(DISTINCT member_id) AS members FROM (SELECT member_id, unnest(CASE WHEN b IS NULL THEN ['new'] WHEN a IS NULL THEN ['resolved']
        ELSE list_distinct(flatten(list_transform(a, lambda x: list_transform(b, lambda y: CASE WHEN x > y THEN 'escalated' ELSE 'continuing' END)))) END) AS change FROM ranks) GROUP BY change""", "exposure"),
    "g12_risk_trend": sql(WORKED + f" SELECT decision_date::VARCHAR AS decision_date, max_by(exposed, run_id)::BIGINT AS exposed, round(100.0::DOUBLE * max_by(exposed, run_id) / nullif(max_by(total_members, run_id), 0), 2) AS exposed_share, max_by(contactable_members, run_id)::BIGINT AS reachable FROM worked WHERE city_id = '{CITY}' GROUP BY decision_date", "workload"),
    "g13_highlights": sql(DAY + " SELECT arg_min(city_id, (-n, city_id)) AS busiest_city, arg_min(city_id, (r - n, city_id)) AS widest_gap_city, (SELECT arg_min(driver, (-n, driver)) FROM pull) AS main_driver FROM burden", "exposure"),
    "g14_latest_source_time": sql("SELECT strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') AS latest_source_time FROM hours", "hours"),
    "g15_active_conditions": sql(f"SELECT count(*) AS active_conditions FROM daily WHERE {ON}", "daily"),
    "i1_replicated_exposure": sql(DAY + " SELECT city_id, severity, 20 * sum(n)::BIGINT AS rows, 20 * count(*) AS people, 20 * sum(e)::BIGINT AS reachable_rows FROM (SELECT city_id, severity, member_id, count(*) AS n, count(*) FILTER (WHERE outreach_eligible) AS e FROM day GROUP BY ALL) GROUP BY city_id, severity", "exposure"),
}
