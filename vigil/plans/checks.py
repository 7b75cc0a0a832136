"""Validation and quality over the given tables, as named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.expressions import clock
from vigil.operators import marts, quality, rules, validation
from vigil.operators.validation import Range
from vigil.plans import catalog, risk
from vigil.plans.sql import sql
from vigil.sources import adapters
from vigil.sources.adapters import table

RANGES = (Range("l_quantity", 2, 49), Range("l_discount", 0.01, 0.09), Range("l_tax", 0, 0.07))
RECORD = ("l_orderkey", "l_linenumber")


def items(s: SparkSession, d: str) -> DataFrame:
    """lineitem as records of sources (return flags) and cities (line status), with every 97th quantity missing."""
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("city_id"),
                                          F.when(F.col("l_orderkey") % 97 != 0, F.col("l_quantity")).alias("l_quantity"), "l_discount", "l_tax")


def judged(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return validation.validated(items(s, d), [*validation.range_issues(RANGES), validation.warning_above("l_tax", "l_discount")])


def issues(s: SparkSession, d: str) -> DataFrame:
    return judged(s, d)[1]


def policy(s: SparkSession, d: str) -> DataFrame:
    """What each source must reach."""
    return table(s, d, "lineitem").select(F.col("l_returnflag").alias("source")).distinct().withColumns({"minimum_valid": F.lit(100), "minimum_ratio": F.when(F.col("source") == "A", 0.9).otherwise(0.5), "maximum_invalid": F.lit(1_000_000_000)})


def b10(s: SparkSession, d: str) -> DataFrame:
    received = items(s, d).groupBy("source", "city_id").agg(F.count("*").alias("received"))
    return validation.batch_acceptance(received, issues(s, d), policy(s, d), RECORD)


def b2(s: SparkSession, d: str) -> DataFrame:
    """Order dates as text: every fourth with Z, with an offset, without zone, or no time at all."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    k = F.col("o_orderkey") % 4
    shown = F.when(k == 0, F.concat(text, F.lit("Z"))).when(k == 1, F.concat(text, F.lit("+05:30"))).when(k == 2, text).otherwise(F.concat(F.lit("x"), text))
    utc = validation.text_time(shown)
    micros = F.unix_micros(utc)
    return table(s, d, "orders").select("o_orderkey", F.coalesce(F.floor(micros / 1_000_000), F.lit(-1)).alias("seconds"), utc.isNotNull().alias("accepted"))


def b4(s: SparkSession, d: str) -> DataFrame:
    days = adapters.daily_history(s, d).withColumn("precipitation", F.when(F.dayofmonth("observed_date") == 7, -999.0).otherwise(F.col("precipitation"))).withColumn("temperature_2m", F.when(F.dayofmonth("observed_date") != 9, F.col("temperature_2m")))
    found = validation.validated(days, [validation.sentinel_issue(("temperature_2m", "minimum_temperature_2m", "precipitation"), -999.0)])[1]
    return found.select("city_id", F.col("observed_date").cast("string").alias("observed_date"), "error_type")


def b5(s: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 10 == 0, "20241340").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    day = validation.date_key(text)
    return table(s, d, "orders").groupBy(F.coalesce(day.cast("string"), F.lit("invalid_date_key")).alias("date_key")).agg(F.count("*").alias("rows"))


def b6(s: SparkSession, d: str) -> DataFrame:
    days = adapters.daily_history(s, d).withColumn("temperature_range", F.when(F.dayofmonth("observed_date") == 3, F.col("temperature_range") + 1).otherwise(F.col("temperature_range")))
    days = days.withColumn("minimum_temperature_2m", F.when(F.dayofmonth("observed_date") == 5, F.col("temperature_2m") + 1).otherwise(F.col("minimum_temperature_2m")))
    found = validation.validated(days, validation.order_issues("minimum_temperature_2m", "temperature_2m", "temperature_range", 0.01))[1]
    return found.groupBy("city_id", "error_type").agg(F.count("*").alias("issues"))


def b8(s: SparkSession, d: str) -> DataFrame:
    """An order's lines as parallel arrays, some of them cut short or missing."""
    arrays = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("time"), F.collect_list("l_quantity").alias("value"))
    cut = F.when(F.col("l_orderkey") % 5 == 0, F.slice("value", 1, 1)).when(F.col("l_orderkey") % 11 != 0, F.col("value"))
    return validation.array_contract(arrays.withColumn("value", cut), ("time", "value")).select("l_orderkey", "n_time", "n_value", "accepted")


def b9(s: SparkSession, d: str) -> DataFrame:
    events = table(s, d, "events").select("user_id", "event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
    return validation.series_violations(events, "user_id", "event_id", "ts", 1, 3, allow_gaps=True)


def profile(s: SparkSession, d: str) -> DataFrame:
    return quality.source_profile(adapters.weather(s, d), "weather", risk.KEYS, "observed_at").unionByName(quality.source_profile(adapters.air_quality(s, d), "air", risk.KEYS, "observed_at"))


def shown_profile(df: DataFrame) -> DataFrame:
    return df.withColumn("latest", clock(F.col("latest")))


def reconciled(s: SparkSession, d: str) -> DataFrame:
    return quality.reconciliation(adapters.weather(s, d), adapters.air_quality(s, d), risk.cities(s, d), catalog.AS_OF)


def profiles(s: SparkSession, d: str) -> DataFrame:
    """Rows per region and order month, as profiles of runs."""
    orders = table(s, d, "orders").join(adapters.customers(s, d).select("c_custkey", "city_id"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.groupBy(F.col("city_id").alias("dataset"), F.date_format("o_orderdate", "yyyyMM").alias("run_id")).agg(F.count("*").cast("double").alias("value")).withColumn("metric", F.lit("rows"))


def runs(s: SparkSession, d: str) -> DataFrame:
    months = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("run_id")).distinct()
    return months.withColumn("status", F.when(F.substring("run_id", 5, 2) == "04", "failed").when(F.substring("run_id", 5, 2) == "05", "partial_success").otherwise("success"))


def anomalies(s: SparkSession, d: str) -> DataFrame:
    current = profiles(s, d).filter("run_id = '200003'").drop("run_id")
    return quality.row_anomalies(current, quality.profile_history(profiles(s, d), runs(s, d), "200003"), 3, 0.05, 0.15)


def sound(s: SparkSession, d: str) -> DataFrame:
    """The integrity of the marts as they are."""
    return quality.integrity(risk.exposed(s, d), risk.queue(s, d), risk.alerted(s, d), risk.triggered(s, d), risk.worked(s, d), risk.cities(s, d))


def breached(s: SparkSession, d: str) -> DataFrame:
    """The integrity of marts with a breach of each kind planted in them."""
    exposure, queue, day = risk.exposed(s, d), risk.queue(s, d), F.expr("INTERVAL 1 DAY")
    unasked = exposure.filter("NOT outreach_consent AND member_id % 17 = 1").select(*queue.columns)
    moved = queue.filter("member_id % 83 = 3").withColumn("window_start", F.col("window_start") + day)
    queued = queue.unionByName(unasked).unionByName(queue.filter("member_id % 89 = 2")).unionByName(moved)
    alerts = risk.alerted(s, d).filter("NOT (city_id = 'MIDDLE EAST' AND rule_id = 'R1')")
    alerts = alerts.withColumn("eligible_members", F.col("eligible_members") + F.when(F.col("decision_date") == F.lit("2024-01-09").cast("date"), 1).otherwise(0))
    triggers = risk.triggered(s, d).filter("NOT (city_id = 'AMERICA' AND rule_id = 'R4')")
    triggers = triggers.withColumn("window_end", F.when((F.col("city_id") == "ASIA") & (F.col("rule_id") == "R2"), F.col("window_start") - day).otherwise(F.col("window_end")))
    triggers = triggers.withColumn("persistence_hours", F.col("persistence_hours") + F.when(F.col("rule_id") == "R3", 100).otherwise(0))
    at_risk = F.col("at_risk_members")
    workload = risk.worked(s, d).withColumn("at_risk_members", F.when(F.col("decision_date") == F.lit("2024-01-11").cast("date"), F.col("total_members") + 5).when(F.col("decision_date") == F.lit("2024-01-10").cast("date"), at_risk + 1).otherwise(at_risk))
    return quality.integrity(exposure, queued, alerts, triggers, workload, risk.cities(s, d).filter("city_id <> 'AFRICA'"))


def gates(s: SparkSession, d: str) -> DataFrame:
    """Whether the sound and the breached marts may be published."""
    rows = [quality.integrity_results(df, {}).agg((~F.bool_or(F.col("status") == "fail")).alias("may_publish")).withColumn("marts", F.lit(n)) for n, df in (("sound", sound(s, d)), ("breached", breached(s, d)))]
    return rows[0].unionByName(rows[1])


def readiness(s: SparkSession, d: str) -> DataFrame:
    """Sources per region: the weather of EUROPE is missing, the air of ASIA old."""
    latest = adapters.weather(s, d).groupBy("city_id").agg(F.max("observed_at").alias("latest")).withColumn("source", F.lit("weather")).filter("city_id <> 'EUROPE'")
    air = adapters.air_quality(s, d).groupBy("city_id").agg(F.max("observed_at").alias("latest")).withColumn("source", F.lit("air"))
    air = air.withColumn("latest", F.when(F.col("city_id") == "ASIA", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("latest")))
    state = latest.unionByName(air).withColumn("status", F.lit("success"))
    expected = table(s, d, "region").select(F.col("r_name").alias("city_id"), F.explode(F.array(F.lit("weather"), F.lit("air"), F.lit("extra"))).alias("source"))
    return quality.city_readiness(expected, state, ("weather", "air"), "2024-01-20 00:00:00")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "b1_range_issues": lambda s, d: issues(s, d).select(*RECORD, "field_name", "error_type", "severity"),
    "b1_valid_rows": lambda s, d: judged(s, d)[0].groupBy("source", "city_id").agg(F.count("*").alias("valid_rows")),
    "b2_timestamps": b2,
    "b3_missing_values": lambda s, d: issues(s, d).filter("error_type = 'missing'").groupBy("source", "field_name").agg(F.count("*").alias("issues")),
    "b4_sentinels": b4,
    "b5_date_keys": b5,
    "b6_cross_field": b6,
    "b7_warnings": lambda s, d: issues(s, d).filter("severity = 'warning'").groupBy("source", "city_id").agg(F.count("*").alias("warnings")),
    "b8_array_contract": b8,
    "b9_series_contract": b9,
    "b10_batch_acceptance": b10,
    "b11_invalid_summary": lambda s, d: validation.invalid_summary(issues(s, d), RECORD),
    "f1_source_profile": lambda s, d: shown_profile(profile(s, d)),
    "f2_source_checks": lambda s, d: quality.source_checks(profile(s, d), 5, 600, "2024-01-30 12:00:00"),
    "f3_historical_profile": lambda s, d: quality.historical_profile(adapters.daily_history(s, d)).withColumn("latest", F.col("latest").cast("string")),
    "f4_historical_checks": lambda s, d: quality.historical_checks(quality.historical_profile(adapters.daily_history(s, d)), 5, 7, 0.9),
    "f5_reconciliation": reconciled,
    "f6_join_loss": lambda s, d: quality.join_loss(reconciled(s, d), 0.05, 0.2),
    "f8_row_anomalies": anomalies,
    "f9_profile_history": lambda s, d: quality.profile_history(profiles(s, d), runs(s, d), "200003").withColumn("average_value", F.round("average_value", 6)),
    "f10_integrity": lambda s, d: sound(s, d).withColumn("marts", F.lit("sound")).unionByName(breached(s, d).withColumn("marts", F.lit("breached"))),
    "f11_integrity_results": lambda s, d: quality.integrity_results(breached(s, d), {"invalid_windows": 1_000_000}),
    "f12_city_readiness": readiness,
    "f12_run_readiness": lambda s, d: quality.run_readiness(readiness(s, d), 2, 0.6, ["AFRICA"]),
    "f13_publication_cities": lambda s, d: quality.publication_cities(readiness(s, d)),
    "f14_gate": gates,
    "d1_definitions": lambda s, d: rules.definitions(catalog.part_rules(s, d)),
    "d2_predicates": lambda s, d: rules.predicates(catalog.part_rules(s, d)),
    "d3_condition_relevance": lambda s, d: rules.condition_relevance(catalog.part_rules(s, d), catalog.part_profiles(s, d)),
    "d4_severity_bands": lambda s, d: rules.severity_bands(catalog.part_rules(s, d)),
    "d5_catalog_mismatches": lambda s, d: rules.catalog_mismatches(catalog.part_rules(s, d), catalog.part_rules(s, d, 2)),
    "d5_merged_catalog": lambda s, d: rules.merged_catalog(catalog.part_rules(s, d).select("rule_id", "severity"), catalog.part_rules(s, d, 2).select("rule_id", F.when(F.col("persistence_hours") == 3, "retired").otherwise("approved").alias("status"))),
    "d6_semantic_violations": lambda s, d: rules.semantic_violations(catalog.part_rules(s, d)),
    "d7_reference_violations": lambda s, d: rules.reference_violations(catalog.part_rules(s, d), catalog.part_cities(s, d), catalog.part_profiles(s, d)),
}
ITEMS = "items AS (SELECT l_orderkey, l_linenumber, l_returnflag AS source, l_linestatus AS city_id, CASE WHEN l_orderkey % 97 <> 0 THEN l_quantity END AS l_quantity, l_discount, l_tax FROM lineitem)"
ISSUE_SQL = f"""WITH {ITEMS}, issues AS (
  SELECT *, 'l_quantity' AS field_name, 'missing' AS error_type, 'fatal' AS severity FROM items WHERE l_quantity IS NULL
  UNION ALL SELECT *, 'l_quantity', 'out_of_range', 'fatal' FROM items WHERE NOT l_quantity BETWEEN 2 AND 49
  UNION ALL SELECT *, 'l_discount', 'out_of_range', 'fatal' FROM items WHERE NOT l_discount BETWEEN 0.01::DOUBLE AND 0.09::DOUBLE
  UNION ALL SELECT *, 'l_tax', 'out_of_range', 'fatal' FROM items WHERE NOT l_tax BETWEEN 0 AND 0.07::DOUBLE
  UNION ALL SELECT *, 'l_tax', 'above_other', 'warning' FROM items WHERE l_tax > l_discount)
"""
PARTS_SQL = """WITH parts AS (SELECT *, p_partkey % 4 = 1 AS local FROM part WHERE p_partkey % 50 <> 1),
  rules AS (SELECT 'v1' AS ruleset_version, 'P' || p_partkey AS rule_id, list_transform(range(1, 2 + p_partkey % 3), lambda i: 'city' || (p_partkey * i) % 7) AS cities,
    list_transform(range(1, 3 + p_partkey % 3), lambda i: ((p_partkey + i * 4) % 13)::INT) AS months,
    list_transform(range(1, 2 + p_partkey % 2), lambda i: {'i': i, 'metric': 'm' || (p_size + i * ((p_partkey + 2) % 3)) % 4, 'operator': CASE WHEN (p_partkey + i) % 3 = 0 THEN '<=' ELSE '>=' END,
      'comparison': CASE WHEN local THEN 'baseline_percentile' ELSE 'absolute' END, 'threshold': CASE WHEN local AND p_partkey % 28 <> 1 THEN NULL ELSE ((floor(p_retailprice)::BIGINT + 3 * i) % 5 * 10)::DOUBLE END,
      'baseline_percentile': CASE WHEN local THEN 'p90' END, 'function': CASE p_partkey % 3 WHEN 1 THEN 'rolling_average' WHEN 2 THEN 'daily_max' ELSE 'instantaneous' END, 'window_hours': CASE WHEN p_partkey % 31 = 0 THEN 12 WHEN p_partkey % 3 = 1 AND p_partkey % 37 <> 0 THEN 24 END}) AS predicates, (1 + p_size % 6)::INT AS persistence_hours, (['low', 'medium', 'high', 'critical'])[p_partkey % 4 + 1] AS severity,
    p_type AS signal_name, p_brand AS signal_category, 'f' || p_partkey % 9 AS condition_profile, p_partkey FROM parts)
"""
RANKED = "CASE {0} WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 END"
BANDS_SQL = """(SELECT rule_id, severity AS s, persistence_hours AS h, 1.0::DOUBLE AS r FROM rules WHERE p_partkey % 3 = 0 UNION ALL SELECT rule_id, CASE WHEN p_partkey % 5 = 0 THEN 'high' ELSE 'low' END, 2, 1.0::DOUBLE FROM rules WHERE p_partkey % 3 <> 0
  UNION ALL SELECT rule_id, 'medium', 4, 1.5::DOUBLE FROM rules WHERE p_partkey % 3 <> 0)"""
PROFILE_SQL = sql("SELECT 'weather' AS dataset, count(*) AS rows, count(DISTINCT (city_id, observed_at)) AS distinct_keys, strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') AS latest FROM weather UNION ALL SELECT 'air', count(*), count(DISTINCT (city_id, observed_at)), strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') FROM air", "weather", "air")
PASS = "CASE WHEN {0} THEN 'pass' ELSE 'fail' END"
RECON = f"""(SELECT count(*) FILTER (WHERE w) AS weather_rows, count(*) FILTER (WHERE a) AS air_rows, count(*) FILTER (WHERE w AND a) AS matched, count(*) FILTER (WHERE w AND a IS NULL) AS weather_only, count(*) FILTER (WHERE a AND w IS NULL) AS air_only FROM
  (SELECT city_id, observed_at, true AS w FROM weather WHERE observed_at >= TIMESTAMP '{catalog.AS_OF}' AND city_id IN (SELECT city_id FROM cities)) FULL JOIN (SELECT city_id, observed_at, true AS a FROM air WHERE observed_at >= TIMESTAMP '{catalog.AS_OF}' AND city_id IN (SELECT city_id FROM cities)) USING (city_id, observed_at))"""
LEVEL = "CASE WHEN {0} > {2} THEN 'fail' WHEN {0} > {1} THEN 'warning' ELSE 'pass' END"
RUNS = """, p AS (SELECT city_id AS dataset, strftime(o_orderdate, '%Y%m') AS run_id, count(*)::DOUBLE AS value, 'rows' AS metric FROM orders JOIN customers ON o_custkey = c_custkey GROUP BY ALL),
  h AS (SELECT dataset, metric, avg(value) AS average_value, count(*) AS samples FROM p WHERE run_id <> '200003' AND substr(run_id, 5, 2) <> '04' GROUP BY ALL)
"""
READY = """, state AS (SELECT city_id, 'weather' AS source, max(observed_at) AS latest FROM weather WHERE city_id <> 'EUROPE' GROUP BY city_id UNION ALL SELECT city_id, 'air', CASE city_id WHEN 'ASIA' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE max(observed_at) END FROM air GROUP BY city_id),
  ready AS (SELECT r_name AS city_id, bool_and(coalesce(latest >= TIMESTAMP '2024-01-20 00:00:00', false)) AS complete FROM (SELECT r_name, unnest(['weather', 'air']) AS source FROM region) LEFT JOIN state ON city_id = r_name AND state.source = "unnest"."source" GROUP BY r_name)
""".replace('(SELECT r_name, unnest([\'weather\', \'air\']) AS source FROM region) LEFT JOIN state ON city_id = r_name AND state.source = "unnest"."source"', "(SELECT r_name, unnest(['weather', 'air']) AS source FROM region) e LEFT JOIN state s ON s.city_id = r_name AND s.source = e.source")
NINE = ("consent_leakage", "duplicate_member_triggers", "invalid_windows", "queue_without_trigger", "alert_mismatches", "unapproved_city_rows", "queue_without_exposure", "workload_mismatches", "at_risk_above_total")
#: What each check counts, over queue q, alerts a, triggers t, workload w and cities c.
COUNTS = """(SELECT count(*) FROM q WHERE NOT outreach_consent) AS consent_leakage,
  (SELECT count(*) FROM (SELECT 1 FROM q GROUP BY decision_date, member_id, rule_id, city_id, window_start HAVING count(*) > 1)) AS duplicate_member_triggers,
  (SELECT count(*) FROM t WHERE hours < persistence_hours OR window_end < window_start) AS invalid_windows,
  (SELECT count(*) FROM q WHERE (rule_id, city_id, window_start) NOT IN (SELECT (rule_id, city_id, window_start) FROM t)) AS queue_without_trigger,
  (SELECT count(*) FROM (SELECT sum(n) AS n, sum(h) AS h, count(*) AS k FROM (SELECT decision_date, rule_id, city_id, window_start, eligible_members AS n, high_priority_members AS h FROM a
     UNION ALL SELECT decision_date, rule_id, city_id, window_start, -count(DISTINCT member_id), -count(DISTINCT member_id) FILTER (WHERE priority_score >= 4) FROM q GROUP BY ALL) GROUP BY decision_date, rule_id, city_id, window_start) WHERE k < 2 OR n <> 0 OR h <> 0) AS alert_mismatches,
  (SELECT count(*) FILTER (WHERE city_id NOT IN (SELECT city_id FROM c)) FROM (SELECT city_id FROM t UNION ALL SELECT city_id FROM q UNION ALL SELECT city_id FROM a)) AS unapproved_city_rows,
  (SELECT count(*) FROM q WHERE (decision_date, rule_id, city_id, window_start, member_id) NOT IN (SELECT (decision_date, rule_id, city_id, window_start, member_id) FROM exposure)) AS queue_without_exposure,
  (SELECT count(*) FROM (SELECT sum(x) AS x, sum(y) AS y, sum(z) AS z FROM (SELECT decision_date, city_id, at_risk_members AS x, contactable_members AS y, high_priority_members AS z FROM w
     UNION ALL SELECT decision_date, city_id, -count(DISTINCT member_id), -count(DISTINCT member_id) FILTER (WHERE outreach_eligible), -count(DISTINCT member_id) FILTER (WHERE priority_score >= 4) FROM exposure GROUP BY ALL) GROUP BY decision_date, city_id) WHERE x <> 0 OR y <> 0 OR z <> 0) AS workload_mismatches,
  (SELECT count(*) FROM w WHERE at_risk_members > total_members) AS at_risk_above_total"""
INTEGRITY = f""", sound AS (WITH q AS (FROM queue), a AS (FROM alerts), t AS (FROM triggers), w AS (FROM workload), c AS (FROM cities) SELECT {COUNTS}),
  breached AS (WITH q AS (FROM queue UNION ALL FROM exposure WHERE NOT outreach_consent AND member_id % 17 = 1 UNION ALL FROM queue WHERE member_id % 89 = 2
      UNION ALL SELECT * REPLACE (window_start + INTERVAL 1 DAY AS window_start) FROM queue WHERE member_id % 83 = 3),
    a AS (SELECT * REPLACE (CASE decision_date WHEN DATE '2024-01-09' THEN eligible_members + 1 ELSE eligible_members END AS eligible_members) FROM alerts WHERE NOT (city_id = 'MIDDLE EAST' AND rule_id = 'R1')),
    t AS (SELECT * REPLACE (CASE WHEN city_id = 'ASIA' AND rule_id = 'R2' THEN window_start - INTERVAL 1 DAY ELSE window_end END AS window_end, CASE rule_id WHEN 'R3' THEN persistence_hours + 100 ELSE persistence_hours END AS persistence_hours)
      FROM triggers WHERE NOT (city_id = 'AMERICA' AND rule_id = 'R4')),
    w AS (SELECT * REPLACE (CASE decision_date WHEN DATE '2024-01-11' THEN total_members + 5 WHEN DATE '2024-01-10' THEN at_risk_members + 1 ELSE at_risk_members END AS at_risk_members) FROM workload),
    c AS (FROM cities WHERE city_id <> 'AFRICA') SELECT {COUNTS})
"""
MARTS = ("queue", "triggers", "alerts", "workload", "cities")
LIMITS = {c: 1_000_000 if c == "invalid_windows" else 0 for c in NINE}
LONG = " UNION ALL ".join(f"SELECT '{c}' AS \"check\", {c} AS actual, {m} AS maximum, {PASS.format(f'{c} <= {m}')} AS status FROM breached" for c, m in LIMITS.items())
SQL: dict[str, str] = {
    "b1_range_issues": ISSUE_SQL + "SELECT l_orderkey, l_linenumber, field_name, error_type, severity FROM issues",
    "b1_valid_rows": ISSUE_SQL + "SELECT source, city_id, count(*) AS valid_rows FROM items WHERE l_quantity BETWEEN 2 AND 49 AND l_discount BETWEEN 0.01::DOUBLE AND 0.09::DOUBLE AND l_tax BETWEEN 0 AND 0.07::DOUBLE GROUP BY ALL",
    "b2_timestamps": "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN -1 WHEN 1 THEN epoch(o_orderdate)::BIGINT - 19800 ELSE epoch(o_orderdate)::BIGINT END AS seconds, o_orderkey % 4 <> 3 AS accepted FROM orders",
    "b3_missing_values": ISSUE_SQL + "SELECT source, field_name, count(*) AS issues FROM issues WHERE error_type = 'missing' GROUP BY ALL",
    "b4_sentinels": sql("SELECT city_id, observed_date::VARCHAR AS observed_date, 'missing_source_value' AS error_type FROM history WHERE day(observed_date) IN (7, 9)", "history"),
    "b5_date_keys": "SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'invalid_date_key' ELSE o_orderdate::DATE::VARCHAR END AS date_key, count(*) AS rows FROM orders GROUP BY ALL",
    "b6_cross_field": sql("SELECT city_id, error_type, count(*) AS issues FROM (SELECT city_id, 'inconsistent_range' AS error_type FROM history WHERE day(observed_date) = 3 OR (day(observed_date) = 5 AND abs(temperature_range + 1) > 0.01) UNION ALL SELECT city_id, 'above_maximum' FROM history WHERE day(observed_date) = 5) GROUP BY ALL", "history"),
    "b7_warnings": ISSUE_SQL + "SELECT source, city_id, count(*) AS warnings FROM issues WHERE severity = 'warning' GROUP BY ALL",
    "b8_array_contract": "SELECT *, n_time = n_value AS accepted FROM (SELECT l_orderkey, count(*)::INT AS n_time, CASE WHEN l_orderkey % 5 = 0 THEN 1 WHEN l_orderkey % 11 <> 0 THEN count(*) ELSE -1 END::INT AS n_value FROM lineitem GROUP BY l_orderkey)",
    "b9_series_contract": """SELECT *, n >= 3 AND null_times + repeated_times + unordered + bad_gaps = 0 AS accepted FROM (SELECT user_id, count(*) AS n, count(*) - count(ts) AS null_times, count(ts) - count(DISTINCT ts) AS repeated_times, count(*) FILTER (WHERE g < 0) AS unordered, count(*) FILTER (WHERE g <= 0) AS bad_gaps
      FROM (SELECT user_id, t AS ts, (epoch(t) - epoch(lag(t) OVER (PARTITION BY user_id ORDER BY event_id))) / 3600 AS g FROM (SELECT user_id, event_id, date_trunc('hour', ts) AS t FROM events)) GROUP BY user_id)""",
    "b10_batch_acceptance": ISSUE_SQL + """SELECT source, city_id, received, received - invalid AS valid, invalid, round((received - invalid) / received, 4) AS valid_ratio, received - invalid >= 100 AND (received - invalid) / received >= CASE source WHEN 'A' THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS accepted
      FROM (SELECT source, city_id, count(*) AS received FROM items GROUP BY ALL) JOIN (SELECT source, city_id, count(DISTINCT (l_orderkey, l_linenumber)) AS invalid FROM issues WHERE severity = 'fatal' GROUP BY ALL) USING (source, city_id)""",
    "b11_invalid_summary": ISSUE_SQL + "SELECT source, severity, count(DISTINCT (l_orderkey, l_linenumber)) AS invalid_records FROM issues GROUP BY ALL",
    "f1_source_profile": PROFILE_SQL,
    "f2_source_checks": f"WITH pr AS ({PROFILE_SQL}) " + " UNION ALL ".join(f"SELECT dataset, '{n}' AS \"check\", {PASS.format(t)} AS status, {v}::VARCHAR AS details FROM pr" for n, t, v in (("non_empty", "rows > 0", "rows"), ("coverage", "rows >= 3000", "rows"), ("unique_key", "rows = distinct_keys", "(rows - distinct_keys)"), ("freshness", "latest >= '2024-01-30 12:00:00'", "latest"))),
    "f3_historical_profile": sql("SELECT 'history' AS dataset, count(*) AS rows, count(DISTINCT city_id) AS cities, count(DISTINCT year(observed_date)) AS years, max(observed_date)::VARCHAR AS latest FROM history", "history"),
    "f4_historical_checks": sql(f", pr AS (SELECT count(*) AS rows, count(DISTINCT city_id) AS cities, count(DISTINCT year(observed_date)) AS years FROM history) SELECT 'history' AS dataset, 'rows' AS \"check\", {PASS.format('rows >= 11497.5')} AS status, rows::VARCHAR AS details FROM pr UNION ALL SELECT 'history', 'cities', {PASS.format('cities >= 5')}, cities::VARCHAR FROM pr UNION ALL SELECT 'history', 'years', {PASS.format('years = 7')}, years::VARCHAR FROM pr", "history"),
    "f5_reconciliation": sql("SELECT * FROM " + RECON, "weather", "air", "cities"),
    "f6_join_loss": sql(f"SELECT 'join' AS dataset, \"check\", {LEVEL.format('v', '0.05', '0.2')} AS status, v::VARCHAR AS details FROM (SELECT 'weather_join_loss' AS \"check\", round(weather_only / weather_rows, 4) AS v FROM {RECON} UNION ALL SELECT 'air_join_loss', round(air_only / air_rows, 4) FROM {RECON})", "weather", "air", "cities"),
    "f8_row_anomalies": sql(RUNS + f"SELECT dataset, metric, round(abs(value - average_value) / average_value, 4) AS ratio, {LEVEL.format('round(abs(value - average_value) / average_value, 4)', '0.05', '0.15')} AS status, 'history' AS baseline FROM p JOIN h USING (dataset, metric) WHERE run_id = '200003'", "customers"),
    "f9_profile_history": sql(RUNS + "SELECT dataset, metric, round(average_value, 6) AS average_value, samples FROM h", "customers"),
    "f10_integrity": sql(INTEGRITY + "SELECT *, 'sound' AS marts FROM sound UNION ALL SELECT *, 'breached' FROM breached", *MARTS),
    "f11_integrity_results": sql(INTEGRITY + LONG, *MARTS),
    "f12_city_readiness": sql(READY + "SELECT * FROM ready", "weather", "air"),
    "f12_run_readiness": sql(READY + "SELECT count(*) AS cities, count(*) FILTER (WHERE complete) AS complete_cities, CASE WHEN bool_and(complete) THEN 'success' WHEN count(*) FILTER (WHERE complete) >= greatest(2, ceil(count(*) * 0.6)) AND bool_or(complete AND city_id = 'AFRICA') THEN 'partial_success' ELSE 'failed' END AS status FROM ready", "weather", "air"),
    "f13_publication_cities": sql(READY + "SELECT city_id FROM ready WHERE complete", "weather", "air"),
    "f14_gate": sql(INTEGRITY + " UNION ALL ".join(f"SELECT {' + '.join(NINE)} = 0 AS may_publish, '{n}' AS marts FROM {n}" for n in ("sound", "breached")), *MARTS),
    "d1_definitions": PARTS_SQL + "SELECT ruleset_version, rule_id, unnest(cities) AS city_id, month, len(predicates)::INT AS predicate_count, persistence_hours, severity, signal_name, signal_category FROM (SELECT *, unnest(months) AS month FROM rules)",
    "d2_predicates": PARTS_SQL + "SELECT ruleset_version, rule_id, p.i::INT AS predicate_index, p.metric, p.operator, p.comparison, p.threshold, p.baseline_percentile, p.function, p.window_hours FROM (SELECT ruleset_version, rule_id, unnest(predicates) AS p FROM rules)",
    "d3_condition_relevance": PARTS_SQL + ", f AS (SELECT 'f' || s_suppkey % 8 AS condition_profile, count(*) AS n FROM supplier GROUP BY 1) SELECT ruleset_version, rule_id, 'c1' AS condition, 'high' AS relevance FROM rules JOIN f USING (condition_profile) UNION ALL SELECT ruleset_version, rule_id, 'c' || n || 'x', 'low' FROM rules JOIN f USING (condition_profile)",
    "d4_severity_bands": PARTS_SQL + f"SELECT 'v1' AS ruleset_version, rule_id, s AS severity, h::INT AS minimum_persistence_hours, r AS minimum_threshold_ratio, {RANKED.format('s')} AS severity_rank FROM {BANDS_SQL}",
    "d5_catalog_mismatches": "SELECT 'P' || p_partkey AS rule_id, CASE p_partkey % 50 WHEN 1 THEN 'detection' ELSE 'governance' END AS missing_in FROM part WHERE p_partkey % 50 IN (1, 2)",
    "d5_merged_catalog": "SELECT 'P' || p_partkey AS rule_id, (['low', 'medium', 'high', 'critical'])[p_partkey % 4 + 1] AS severity, 'approved' AS status FROM part WHERE p_partkey % 50 NOT IN (1, 2) AND p_size % 6 <> 2",
    "d6_semantic_violations": PARTS_SQL + """SELECT rule_id, violation FROM (
      SELECT rule_id, 'repeated_cities' AS violation FROM rules WHERE len(list_distinct(cities)) < len(cities) UNION ALL SELECT rule_id, 'repeated_months' FROM rules WHERE len(list_distinct(months)) < len(months)
      UNION ALL SELECT rule_id, 'months_out_of_range' FROM rules WHERE len(list_filter(months, lambda m: m < 1 OR m > 12)) > 0
      UNION ALL SELECT rule_id, 'repeated_predicates' FROM rules WHERE len(list_distinct(list_transform(predicates, lambda p: concat_ws(' ', p.metric, p.operator, p.threshold)))) < len(predicates)
      UNION ALL SELECT rule_id, 'rolling_without_hours' FROM rules WHERE p_partkey % 3 = 1 AND p_partkey % 37 = 0 AND p_partkey % 31 <> 0 UNION ALL SELECT rule_id, 'hours_without_rolling' FROM rules WHERE p_partkey % 3 <> 1 AND p_partkey % 31 = 0
      UNION ALL SELECT rule_id, 'percentile_with_threshold' FROM rules WHERE len(list_filter(predicates, lambda p: p.comparison <> 'absolute' AND p.threshold IS NOT NULL)) > 0
      UNION ALL SELECT rule_id, 'severity_falls' FROM rules WHERE p_partkey % 3 <> 0 AND p_partkey % 5 = 0)""",
    "d7_reference_violations": PARTS_SQL + """, used AS (SELECT DISTINCT rule_id, unnest(cities) AS c FROM rules) SELECT rule_id, 'unknown_city' AS violation, c AS value FROM used WHERE c NOT IN (SELECT 'city' || n_nationkey % 6 FROM nation)
      UNION ALL SELECT rule_id, 'unknown_profile', condition_profile FROM rules WHERE condition_profile NOT IN (SELECT 'f' || s_suppkey % 8 FROM supplier)""",
}
