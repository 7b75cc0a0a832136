"""The core pipeline over the given tables: one function per frame, and the queries of marts and snapshots."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.functions.expressions import clock, list_text
from vigil.operators import marts, rules, snapshots
from vigil.plans import catalog
from vigil.plans.catalog import AS_OF, DECISION_DATE, ZONE
from vigil.plans.sql import sql
from vigil.sources import adapters, storage

KEYS, TWO, FIVE = ("city_id", "observed_at"), ("m1", "m2"), adapters.MEASURES
NEWEST = ("extracted_at", *FIVE)


def cities(spark: SparkSession, d: str) -> DataFrame:
    """The cities that are published."""
    return adapters.table(spark, d, "region").select(F.col("r_name").alias("city_id")).filter("city_id <> 'EUROPE'")


def hours(spark: SparkSession, d: str) -> DataFrame:
    return marts.conditions(adapters.weather(spark, d), adapters.air_quality(spark, d), cities(spark, d), AS_OF)


def hourly_baselines(spark: SparkSession, d: str) -> DataFrame:
    values = marts.long_form(adapters.weather(spark, d), KEYS, ("apparent_temperature", "temperature_2m", "relative_humidity"))
    return marts.baselines(values, "observed_at")


def triggers(spark: SparkSession, d: str) -> DataFrame:
    ours = catalog.flagship_rules(spark, d)
    return marts.active_triggers(hours(spark, d), rules.definitions(ours), rules.predicates(ours), rules.severity_bands(ours), hourly_baselines(spark, d), DECISION_DATE, ZONE)


def daily(spark: SparkSession, d: str) -> DataFrame:
    return marts.conditions_daily(triggers(spark, d), ZONE)


def summary(spark: SparkSession, d: str) -> DataFrame:
    return marts.metrics_daily(hours(spark, d), hourly_baselines(spark, d), ZONE)


def exposure(spark: SparkSession, d: str) -> DataFrame:
    """Exposure to every rule on every day that it holds."""
    relevance = rules.condition_relevance(catalog.flagship_rules(spark, d), catalog.profiles(spark))
    return marts.member_exposure(adapters.members(spark, d), adapters.member_conditions(spark, d), marts.conditions_daily(triggered(spark, d), ZONE), relevance)


PUBLISHED: dict[tuple[str, str, str], tuple[str, str, StructType]] = {}


def published(spark: SparkSession, d: str, name: str, mart: Callable[[SparkSession, str], DataFrame], partitions: tuple[str, ...] = ("decision_date",)) -> DataFrame:
    """A mart, written to the shared folder at its first use in an application; dates are folders, so that a query of one date reads
    no other. It is written anew when the given tables have changed, or its folder is gone."""
    key, state = (spark.sparkContext.applicationId, d, name), storage.state(spark, d)
    if key not in PUBLISHED or PUBLISHED[key][0] != state or not storage.there(spark, PUBLISHED[key][1]):
        df, path = mart(spark, d), storage.fresh_folder(spark, name)
        storage.write(df, path, partitions)
        PUBLISHED[key] = state, path, df.schema
    _, path, schema = PUBLISHED[key]
    return storage.read(spark, path, schema).select(*schema.names)


#: Rows of exposure in a task, about.
ROWS = 500_000
SIZES: dict[tuple[str, str], tuple[int, int]] = {}


def matched(spark: SparkSession, d: str) -> DataFrame:
    relevance = rules.condition_relevance(catalog.flagship_rules(spark, d), catalog.profiles(spark))
    return marts.matched_members(adapters.members(spark, d), adapters.member_conditions(spark, d), relevance)


def factors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return published(spark, d, "matched", matched, ()), marts.conditions_daily(triggered(spark, d), ZONE)


def exposed(spark: SparkSession, d: str) -> DataFrame:
    """Exposure, whose two factors are published: members with the rules that matter to them, and triggers, of which the days are made.

    They are paired where they are read, so a query of one date pairs no other. Members are dealt over tasks before, by the
    number of rows that they become, and all rows of a member are in one task: what is counted by member shuffles none of them.
    """
    people, days = factors(spark, d)
    paths = tuple(PUBLISHED[spark.sparkContext.applicationId, d, name][1] for name in ("matched", "triggers"))
    if paths not in SIZES:
        counts = [df.groupBy(*marts.ON).agg(F.count("*").alias(n)) for df, n in ((people, "people"), (days, "days"))]
        n, rows = counts[0].join(counts[1], list(marts.ON), "right").agg(F.sum("days"), F.sum(F.col("people") * F.col("days"))).first()
        SIZES[paths] = n or 0, max(spark.sparkContext.defaultParallelism, -(-(rows or 0) // ROWS))
    n, parts = SIZES[paths]
    return marts.exposed_members(people.repartition(parts, "member_id"), days, n <= marts.BROADCAST_DAYS)


def triggered(spark: SparkSession, d: str) -> DataFrame:
    return published(spark, d, "triggers", triggers, ())


def worked(spark: SparkSession, d: str) -> DataFrame:
    return published(spark, d, "workload", workload)


def alerted(spark: SparkSession, d: str) -> DataFrame:
    return published(spark, d, "alerts", alerts)


def workload(spark: SparkSession, d: str) -> DataFrame:
    return marts.care_workload(exposed(spark, d), adapters.members(spark, d), summary(spark, d), cities(spark, d))


def queue(spark: SparkSession, d: str) -> DataFrame:
    return marts.outreach_queue(exposed(spark, d))


def alerts(spark: SparkSession, d: str) -> DataFrame:
    return marts.alerts_of_factors(*factors(spark, d))


def day(c: str = "decision_date") -> F.Column:
    return F.col(c).cast("string").alias(c)


def shown_triggers(t: DataFrame, *more: str) -> DataFrame:
    return t.select("rule_id", "city_id", "severity", "severity_rank", clock(F.col("window_start")).alias("window_start"), clock(F.col("window_end")).alias("window_end"),
                    F.col("observed_persistence_hours").alias("hours"), F.round("threshold_ratio", 6).alias("threshold_ratio"), "predicate_explanation", list_text(F.col("metrics")).alias("metrics"),
                    F.col("forecast_start_date").cast("string").alias("start_date"), "days_until_start", "action_timing", "trigger_explanation", *(F.col(c).cast("string").alias(c) for c in more))


TRIGGER_SQL = """SELECT rule_id, city_id, severity, severity_rank, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, hours,
    round(threshold_ratio, 6) AS threshold_ratio, predicate_explanation, metrics, start_date::VARCHAR AS start_date, days_until_start::INT AS days_until_start, action_timing, trigger_explanation"""


def e1(spark: SparkSession, d: str) -> DataFrame:
    return marts.baselines(marts.history_metrics(adapters.daily_history(spark, d)), "observed_date").withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


def e2(spark: SparkSession, d: str) -> DataFrame:
    found = hours(spark, d)
    return found.withColumn("observed_at", clock(F.col("observed_at")))


def streak_rows(spark: SparkSession, d: str) -> DataFrame:
    ours = catalog.flagship_rules(spark, d)
    evaluated = marts.predicate_evaluations(hours(spark, d), marts.applicable_predicates(rules.definitions(ours), rules.predicates(ours), hourly_baselines(spark, d)))
    return marts.streaks(marts.rule_evaluations(evaluated)).select("rule_id", "city_id", clock(F.col("observed_at")).alias("observed_at"), "is_breach", F.round("threshold_ratio", 6).alias("threshold_ratio"), "streak_group")


def e6(spark: SparkSession, d: str) -> DataFrame:
    return exposure(spark, d).select(day(), "member_id", "city_id", "age_band", "preferred_channel", "rule_id", "severity", clock(F.col("window_start")).alias("window_start"), list_text(F.col("matched_conditions")).alias("matched_conditions"),
                                     list_text(F.col("matched_relevance_levels")).alias("matched_relevance_levels"), "priority_score", "outreach_eligible", "outreach_ineligibility_reason")


E6_COLUMNS = """decision_date::VARCHAR AS decision_date, member_id, city_id, age_band, preferred_channel, rule_id, severity, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, matched_conditions, matched_relevance_levels, priority_score"""


def e8(spark: SparkSession, d: str) -> DataFrame:
    return queue(spark, d).select(day(), "member_id", "city_id", "age_band", "preferred_channel", "rule_id", "severity", clock(F.col("window_start")).alias("window_start"), list_text(F.col("matched_conditions")).alias("matched_conditions"),
                                  list_text(F.col("matched_relevance_levels")).alias("matched_relevance_levels"), "priority_score")


def e9(spark: SparkSession, d: str) -> DataFrame:
    return alerts(spark, d).select(day(), "rule_id", "city_id", "severity", clock(F.col("window_start")).alias("window_start"), F.col("observed_persistence_hours").alias("hours"), "action_timing", "trigger_explanation", "eligible_members", "high_priority_members")


def text_date(df: DataFrame) -> DataFrame:
    return df.withColumn("observed_at", F.col("observed_at").cast("string"))


def raw(spark: SparkSession, d: str, values: tuple = FIVE) -> DataFrame:
    return adapters.incoming_batch(spark, d).select(*KEYS, *values, "extracted_at")


def old(spark: SparkSession, d: str, values: tuple = FIVE) -> DataFrame:
    return adapters.previous_snapshot(spark, d).select(*KEYS, *values, "extracted_at")


def merged(spark: SparkSession, d: str, values: tuple) -> DataFrame:
    return text_date(snapshots.merge(raw(spark, d, values), old(spark, d, values), KEYS, values, ("extracted_at", *values), F.col("observed_at") >= F.lit("1997-01-01").cast("date")))


def metrics_sql(values: tuple) -> str:
    same = " AND ".join(f"l.{v} IS NOT DISTINCT FROM p.{v}" for v in values)
    newest = ", ".join(f"{v} DESC NULLS LAST" for v in ("extracted_at", *values))
    return sql(f"""SELECT count(*) FILTER (WHERE p.city_id IS NULL) AS inserted, count(*) FILTER (WHERE p.city_id IS NOT NULL AND NOT ({same})) AS updated, count(*) FILTER (WHERE p.city_id IS NOT NULL AND {same}) AS unchanged,
      (SELECT count(*) FROM incoming) - count(*) AS rejected FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city_id, observed_at ORDER BY {newest}) AS k FROM incoming) WHERE k = 1) l LEFT JOIN previous p USING (city_id, observed_at)""", "incoming", "previous")


def merge_sql(values: tuple) -> str:
    same = " AND ".join(f"l.{v} IS NOT DISTINCT FROM p.{v}" for v in values)
    columns, newest = ", ".join(values), ", ".join(f"{v} DESC NULLS LAST" for v in ("extracted_at", *values))
    return sql(f""", p AS (SELECT * FROM previous WHERE observed_at >= DATE '1997-01-01'),
      l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city_id, observed_at ORDER BY {newest}) AS k FROM incoming) WHERE k = 1),
      fresh AS (SELECT l.* FROM l LEFT JOIN p USING (city_id, observed_at) WHERE p.city_id IS NULL OR NOT ({same})),
      kept AS (SELECT p.* FROM p LEFT JOIN l USING (city_id, observed_at) WHERE l.city_id IS NULL OR ({same}))
      SELECT city_id, observed_at::VARCHAR AS observed_at, {columns}, extracted_at FROM fresh UNION ALL SELECT city_id, observed_at::VARCHAR, {columns}, extracted_at FROM kept""", "incoming", "previous")




def c7(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.content_hash(old(spark, d), ("extracted_at",), ("city_id",))


def c8(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.column_statistics(adapters.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"))


def c9(spark: SparkSession, d: str) -> DataFrame:
    """Columns of lineitem that the schema kept for its version lacks or has otherwise, with the rows concerned."""
    seen = adapters.table(spark, d, "lineitem")
    kept = seen.drop("l_tax").withColumn("l_quantity", F.col("l_quantity").cast("int"))
    a, b = snapshots.schema_rows(spark, kept.schema), snapshots.schema_rows(spark, seen.schema)
    odd = b.join(a, ["name", "type"], "left_anti").select("name", "type")
    return odd.crossJoin(seen.agg(F.count("*").alias("rows")))


C8_SQL = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value, count(*) AS rows FROM lineitem" for c in ("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "e3_active_triggers": lambda s, d: shown_triggers(triggers(s, d)),
    "e1_historical_baselines": e1,
    "e2_city_conditions": e2,
    "e3a_metric_values": lambda s, d: marts.long_form(hours(s, d), KEYS, marts.RULE_METRICS).withColumn("observed_at", clock(F.col("observed_at"))),
    "e3g_streaks": streak_rows,
    "e4_conditions_daily": lambda s, d: shown_triggers(daily(s, d), "decision_date"),
    "e5_metrics_daily": lambda s, d: summary(s, d).withColumn("decision_date", F.col("decision_date").cast("string")),
    "e6_member_exposure": e6,
    "e7_care_workload": lambda s, d: workload(s, d).withColumn("decision_date", F.col("decision_date").cast("string")),
    "e8_outreach_queue": e8,
    "e9_stakeholder_alerts": e9,
    "c1_latest_per_key": lambda s, d: text_date(snapshots.latest_per_key(raw(s, d), KEYS, NEWEST)),
    "c2_weather_change_metrics": lambda s, d: snapshots.change_metrics(raw(s, d), old(s, d), KEYS, FIVE, NEWEST),
    "c3_air_change_metrics": lambda s, d: snapshots.change_metrics(raw(s, d, TWO), old(s, d, TWO), KEYS, TWO, ("extracted_at", *TWO)),
    "c4_merge_weather": lambda s, d: merged(s, d, FIVE),
    "c5_merge_air": lambda s, d: merged(s, d, TWO),
    "c6_first_snapshot": lambda s, d: text_date(snapshots.first_snapshot(raw(s, d), KEYS, NEWEST)),
    "c7_content_hash": c7,
    "c8_column_statistics": c8,
    "c9_schema_changes": c9,
}
LATEST_SQL = "SELECT city_id, observed_at::VARCHAR AS observed_at, m1, m2, m3, m4, m5, extracted_at FROM latest"
SQL: dict[str, str] = {
    "e3_active_triggers": sql(TRIGGER_SQL + " FROM triggers", "triggers"),
    "e1_historical_baselines": sql("SELECT * REPLACE (first_date::VARCHAR AS first_date, last_date::VARCHAR AS last_date) FROM daily_baselines", "daily_baselines"),
    "e2_city_conditions": sql("SELECT * REPLACE (strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at) FROM hours", "hours"),
    "e3a_metric_values": sql("SELECT * REPLACE (strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at) FROM hours_long WHERE metric <> 'pm10'", "hours_long"),
    "e3g_streaks": sql("SELECT rule_id, city_id, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at, is_breach, round(threshold_ratio, 6) AS threshold_ratio, streak_group::BIGINT AS streak_group FROM streaks", "streaks"),
    "e4_conditions_daily": sql(TRIGGER_SQL + ", decision_date::VARCHAR AS decision_date FROM daily", "daily"),
    "e5_metrics_daily": sql("SELECT * REPLACE (decision_date::VARCHAR AS decision_date) FROM summary", "summary"),
    "e6_member_exposure": sql(f"SELECT {E6_COLUMNS}, outreach_eligible, outreach_ineligibility_reason FROM exposure", "exposure"),
    "e7_care_workload": sql("SELECT * REPLACE (decision_date::VARCHAR AS decision_date) FROM workload", "workload"),
    "e8_outreach_queue": sql(f"SELECT {E6_COLUMNS} FROM queue", "queue"),
    "e9_stakeholder_alerts": sql("SELECT decision_date::VARCHAR AS decision_date, rule_id, city_id, severity, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, hours, action_timing, trigger_explanation, eligible_members, high_priority_members FROM alerts", "alerts"),
    "c1_latest_per_key": sql(LATEST_SQL, "latest"),
    "c2_weather_change_metrics": metrics_sql(FIVE),
    "c3_air_change_metrics": metrics_sql(TWO),
    "c4_merge_weather": merge_sql(FIVE),
    "c5_merge_air": merge_sql(TWO),
    "c6_first_snapshot": sql(LATEST_SQL, "latest"),
    "c7_content_hash": sql(r"SELECT city_id, count(*) AS rows, sum(('0x' || substr(md5(concat_ws(chr(31), m1::VARCHAR, coalesce(m2::VARCHAR, '\N'), m3::VARCHAR, m4::VARCHAR, m5::VARCHAR, observed_at::VARCHAR)), 1, 15))::BIGINT)::HUGEINT::VARCHAR AS content_hash FROM previous GROUP BY city_id", "previous"),
    "c8_column_statistics": C8_SQL,
    "c9_schema_changes": "SELECT column_name AS name, lower(data_type) AS type, (SELECT count(*) FROM lineitem) AS rows FROM duckdb_columns() WHERE table_name = 'lineitem' AND column_name IN ('l_quantity', 'l_tax')",
}
