"""DuckDB SQL of the domain's frames, as named parts that queries put together."""

from __future__ import annotations

from vigil.plans.catalog import AS_OF, DECISION_DATE, FLAGSHIP, PROFILES

#: The decision zone's distance from UTC; it has no summer time.
LOCAL = "INTERVAL 330 MINUTE"
METRICS = (
    "apparent_temperature", "temperature_2m", "precipitation", "daily_precipitation_sum", "daily_min_temperature", "daily_max_temperature",
    "daily_temperature_range", "apparent_temperature_uplift", "relative_humidity", "wind_speed", "pm2_5", "pm2_5_rolling_24h", "pm10",
)


def text(value: object) -> str:
    return "NULL" if value is None else f"'{value}'" if isinstance(value, str) else f"{value}::DOUBLE" if isinstance(value, float) else str(value)


def values(rows: list[tuple], names: str) -> str:
    return "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows) + f") t({names})"


RANK = "CASE {0} WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 END"

#: name: (parts it needs, SQL)
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "customers": ((), "SELECT c.*, r_name AS city_id FROM customer c JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"),
    "obs": (("customers",), "SELECT city_id, date_trunc('hour', ts) AS observed_at, event_type, round(value * 100)::BIGINT AS cents, json_extract_string(props, '$.k')::BIGINT AS k FROM events JOIN customers ON user_id = c_custkey"),
    "weather": (("obs",), """SELECT city_id, observed_at, sum(cents)::DOUBLE / count(*) / 100.0::DOUBLE AS apparent_temperature, max(cents) / 100.0::DOUBLE AS temperature_2m,
        sum(cents)::DOUBLE / 100.0::DOUBLE AS precipitation, min(cents) / 100.0::DOUBLE AS relative_humidity, count(*)::DOUBLE AS wind_speed
        FROM obs WHERE event_type IN ('view', 'click', 'purchase', 'error') GROUP BY ALL"""),
    "air": (("obs",), "SELECT city_id, observed_at, sum(k)::DOUBLE / count(*) AS pm2_5, max(k)::DOUBLE AS pm10 FROM obs WHERE event_type IN ('signup', 'view', 'click') GROUP BY ALL"),
    "history": (("customers",), """SELECT city_id, o_orderdate::DATE AS observed_date, max(c) / 100.0::DOUBLE AS temperature_2m, min(c) / 100.0::DOUBLE AS minimum_temperature_2m,
        (max(c) - min(c)) / 100.0::DOUBLE AS temperature_range, sum(c)::DOUBLE / 100.0::DOUBLE AS precipitation
        FROM (SELECT *, round(o_totalprice * 100)::BIGINT AS c FROM orders JOIN customers ON o_custkey = c_custkey) GROUP BY ALL"""),
    "history_long": (("history",), """SELECT city_id, observed_date, unnest(['temperature_2m', 'daily_max_temperature', 'daily_min_temperature', 'daily_temperature_range', 'daily_precipitation_sum']) AS metric,
        unnest([temperature_2m, temperature_2m, minimum_temperature_2m, temperature_range, precipitation]) AS metric_value FROM history"""),
    "daily_baselines": (("history_long",), """SELECT city_id, month(observed_date)::INT AS month, metric, round(avg(metric_value), 8) AS average_value,
        round(quantile_cont(metric_value, 0.1), 6) AS p10_value, round(quantile_cont(metric_value, 0.9), 6) AS p90_value, round(quantile_cont(metric_value, 0.95), 6) AS p95_value,
        min(metric_value) AS minimum_value, max(metric_value) AS maximum_value, count(*) AS sample_count, count(DISTINCT year(observed_date)) AS historical_years,
        min(observed_date) AS first_date, max(observed_date) AS last_date FROM history_long GROUP BY ALL"""),
    "cities": ((), "SELECT r_name AS city_id FROM region WHERE r_name <> 'EUROPE'"),
    "hours": (("weather", "air", "cities"), f"""SELECT *, round(daily_max_temperature - daily_min_temperature, 6) AS daily_temperature_range FROM (
        SELECT w.*, a.pm2_5, a.pm10, round(apparent_temperature - temperature_2m, 6) AS apparent_temperature_uplift,
          round(sum(precipitation) OVER d, 6) AS daily_precipitation_sum, min(temperature_2m) OVER d AS daily_min_temperature, max(temperature_2m) OVER d AS daily_max_temperature,
          round(avg(pm2_5) OVER (PARTITION BY w.city_id ORDER BY w.observed_at RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW), 6) AS pm2_5_rolling_24h
        FROM weather w JOIN air a USING (city_id, observed_at) WHERE w.city_id IN (SELECT city_id FROM cities) AND w.observed_at >= TIMESTAMP '{AS_OF}'
        WINDOW d AS (PARTITION BY w.city_id, w.observed_at::DATE))"""),
    "hours_long": (("hours",), f"SELECT city_id, observed_at, unnest([{', '.join(repr(x) for x in METRICS)}]) AS metric, unnest([{', '.join(METRICS)}]) AS metric_value FROM hours"),
    "baselines": (("weather",), """SELECT city_id, month(observed_at)::INT AS month, metric, round(avg(v), 8) AS average_value, round(quantile_cont(v, 0.1), 6) AS p10_value, round(quantile_cont(v, 0.9), 6) AS p90_value,
        round(quantile_cont(v, 0.95), 6) AS p95_value, min(v) AS minimum_value, max(v) AS maximum_value FROM (
        SELECT city_id, observed_at, unnest(['apparent_temperature', 'temperature_2m', 'relative_humidity']) AS metric, unnest([apparent_temperature, temperature_2m, relative_humidity]) AS v FROM weather) GROUP BY ALL"""),
    "rules": ((), values([(i, n, h, s, f, len(p)) for i, n, h, s, f, p, _ in FLAGSHIP], "rule_id, signal_name, persistence_hours, severity, condition_profile, predicate_count")),
    "predicates": ((), values([(r[0], k + 1, *p) for r in FLAGSHIP for k, p in enumerate(r[5])], "rule_id, predicate_index, metric, operator, comparison, threshold, baseline_percentile")),
    "bands": ((), values([(r[0], *b) for r in FLAGSHIP for b in (r[6] or ((r[3], r[2], 1.0),))], "rule_id, severity, minimum_persistence_hours, minimum_threshold_ratio")),
    "relevance": (("rules",), "SELECT rule_id, condition, relevance FROM rules JOIN (" + values([(p, c, r) for p, m in PROFILES for c, r in m.items()], "condition_profile, condition, relevance") + ") USING (condition_profile)"),
    "evaluated": (("hours_long", "rules", "predicates", "baselines"), """SELECT *, CASE operator WHEN '>=' THEN metric_value >= t ELSE metric_value <= t END AS met,
          1 + (CASE operator WHEN '>=' THEN metric_value - t ELSE t - metric_value END) / greatest(abs(t), 1.0::DOUBLE) AS ratio,
          metric || ' ' || operator || ' ' || CASE comparison WHEN 'absolute' THEN '' ELSE 'local ' || baseline_percentile || ' ' END || round(t, 1)::VARCHAR AS explanation FROM (
        SELECT m.*, r.rule_id, r.signal_name, r.persistence_hours, r.predicate_count, p.predicate_index, p.operator, p.comparison, p.baseline_percentile,
          CASE p.comparison WHEN 'absolute' THEN p.threshold ELSE CASE p.baseline_percentile WHEN 'p10' THEN b.p10_value WHEN 'p90' THEN b.p90_value WHEN 'p95' THEN b.p95_value END END AS t
        FROM hours_long m JOIN predicates p USING (metric) JOIN rules r USING (rule_id)
        LEFT JOIN baselines b ON b.city_id = m.city_id AND b.month = month(m.observed_at) AND b.metric = m.metric
        WHERE p.comparison = 'absolute' OR b.city_id IS NOT NULL)"""),
    "rule_hours": (("evaluated",), """SELECT rule_id, city_id, signal_name, persistence_hours, predicate_count, observed_at, count(*) FILTER (WHERE met) = predicate_count AS is_breach, min(ratio) AS threshold_ratio,
          string_agg(explanation, ' AND ' ORDER BY predicate_index) AS predicate_explanation, string_agg(metric, '|' ORDER BY predicate_index) AS metrics
        FROM evaluated GROUP BY rule_id, city_id, signal_name, persistence_hours, predicate_count, observed_at HAVING count(*) = predicate_count"""),
    "streaks": (("rule_hours",), """SELECT *, sum(CASE WHEN is_breach AND observed_at - prev = INTERVAL 1 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY rule_id, city_id ORDER BY observed_at ROWS UNBOUNDED PRECEDING) AS streak_group FROM (
        SELECT *, lag(observed_at) OVER (PARTITION BY rule_id, city_id ORDER BY observed_at) AS prev FROM rule_hours)"""),
    "windows": (("rule_hours",), """SELECT rule_id, city_id, signal_name, persistence_hours, island AS streak_group, held[1].at AS window_start, held[-1].at AS window_end, len(held) AS hours,
          list_min(list_transform(held, lambda h: h.ratio)) AS threshold_ratio, held[1].told AS predicate_explanation, held[1].names AS metrics
        FROM (SELECT rule_id, city_id, signal_name, persistence_hours, island, list({'at': observed_at, 'ratio': threshold_ratio, 'told': predicate_explanation, 'names': metrics} ORDER BY observed_at) AS held
          FROM (SELECT *, observed_at - to_hours(row_number() OVER (PARTITION BY rule_id, city_id ORDER BY observed_at)) AS island FROM rule_hours WHERE is_breach) GROUP BY ALL)
        WHERE len(held) >= persistence_hours"""),
    "triggers": (("windows", "bands"), f"""SELECT *, (window_start + {LOCAL})::DATE AS start_date, date_diff('day', DATE '{DECISION_DATE}', (window_start + {LOCAL})::DATE) AS days_until_start,
          CASE WHEN (window_start + {LOCAL})::DATE <= DATE '{DECISION_DATE}' THEN 'today_action' ELSE 'upcoming_risk' END AS action_timing,
          signal_name || ': ' || predicate_explanation || ' for ' || hours || ' consecutive forecast hours in ' || city_id || '.' AS trigger_explanation FROM (
        SELECT w.*, b.severity, {RANK.format("b.severity")} AS severity_rank, row_number() OVER (PARTITION BY w.rule_id, w.city_id, w.streak_group ORDER BY {RANK.format("b.severity")} DESC) AS n
        FROM windows w JOIN bands b ON w.rule_id = b.rule_id AND w.hours >= b.minimum_persistence_hours AND w.threshold_ratio >= b.minimum_threshold_ratio) WHERE n = 1"""),
    "daily": (("triggers",), f"SELECT t.*, d::DATE AS decision_date FROM triggers t, unnest(generate_series(start_date::TIMESTAMP, ((window_end + {LOCAL})::DATE)::TIMESTAMP, INTERVAL 1 DAY)) u(d)"),
    "summary": (("hours_long", "baselines"), f"""SELECT d.*, b.average_value AS historical_average, p10_value AS historical_p10, p90_value AS historical_p90, p95_value AS historical_p95, b.minimum_value AS historical_minimum, b.maximum_value AS historical_maximum FROM (
        SELECT (observed_at + {LOCAL})::DATE AS decision_date, city_id, metric, min(metric_value) AS minimum_value, round(avg(metric_value), 8) AS average_value, max(metric_value) AS maximum_value FROM hours_long GROUP BY ALL) d
        LEFT JOIN baselines b ON b.city_id = d.city_id AND b.month = month(decision_date) AND b.metric = d.metric"""),
    "members": (("customers",), """SELECT c_custkey AS member_id, city_id, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '60+' WHEN c_mktsegment = 'HOUSEHOLD' THEN '40-59' ELSE '18-39' END AS age_band,
        (['app', 'sms', 'call'])[c_custkey % 3 + 1] AS preferred_channel, c_acctbal >= 0 AS outreach_consent FROM customers"""),
    "links": ((), "SELECT DISTINCT o_custkey AS member_id, o_orderpriority AS condition FROM orders"),
    "exposure": (("members", "links", "daily", "relevance"), f"""SELECT decision_date, member_id, m.city_id, age_band, preferred_channel, outreach_consent, rule_id, signal_name, severity, severity_rank, window_start, window_end, hours, action_timing, trigger_explanation, metrics,
          array_to_string(list_sort(list_distinct(list(condition))), '|') AS matched_conditions, array_to_string(list_sort(list_distinct(list(relevance))), '|') AS matched_relevance_levels,
          max({RANK.format("severity")} + CASE relevance WHEN 'high' THEN 2 WHEN 'medium' THEN 1 ELSE 0 END + CASE age_band WHEN '60+' THEN 1 ELSE 0 END) AS priority_score,
          outreach_consent AS outreach_eligible, CASE WHEN NOT outreach_consent THEN 'no_outreach_consent' END AS outreach_ineligibility_reason
        FROM members m JOIN links USING (member_id) JOIN daily f USING (city_id) JOIN relevance USING (rule_id, condition) GROUP BY ALL"""),
    "people": (("exposure",), "SELECT decision_date, city_id, member_id, bool_or(outreach_eligible) AS reachable, max(priority_score) AS top_score, max(severity_rank) AS top_rank, list_distinct(list(rule_id)) AS held FROM exposure GROUP BY ALL"),
    "heads": (("members", "cities"), "SELECT city_id, count(*) AS everyone FROM members SEMI JOIN cities USING (city_id) GROUP BY city_id"),
    "workload": (("people", "heads", "summary"), """SELECT decision_date, city_id, sum(one)::BIGINT AS at_risk_members, sum(reached)::BIGINT AS contactable_members, sum(urgent)::BIGINT AS high_priority_members,
          len(list_distinct(flatten(list(held)))) AS active_conditions, max(worst)::INT AS maximum_severity_rank, everyone AS total_members, round(100.0::DOUBLE * sum(one) / everyone, 2) AS at_risk_percentage
        FROM (SELECT decision_date, city_id, 1 AS one, reachable::INT AS reached, (top_score >= 4)::INT AS urgent, top_rank AS worst, held, false AS asked FROM people
          UNION ALL SELECT DISTINCT decision_date, city_id, 0, 0, 0, 0, []::VARCHAR[], true FROM summary) JOIN heads USING (city_id)
        GROUP BY decision_date, city_id, everyone HAVING bool_or(asked)"""),
    "queue": (("exposure",), "SELECT * FROM exposure WHERE outreach_eligible"),
    "alerts": (("queue",), """SELECT * EXCLUDE (member_id, top_score), count(*) AS eligible_members, sum((top_score >= 4)::INT)::BIGINT AS high_priority_members FROM (
        SELECT decision_date, rule_id, city_id, signal_name, severity, window_start, window_end, hours, action_timing, trigger_explanation, member_id, max(priority_score) AS top_score FROM queue GROUP BY ALL) GROUP BY ALL"""),
    "base": ((), """SELECT o_custkey AS city_id, o_orderdate::DATE AS observed_at, o_orderkey AS n, round(o_totalprice * 100)::BIGINT AS m1, CASE WHEN o_orderkey % 17 <> 0 THEN (round(o_totalprice * 100)::BIGINT % 1000)::DOUBLE END AS m2,
        round(o_totalprice * 100)::BIGINT % 97 AS m3, length(o_orderpriority) AS m4, o_orderkey % 5 AS m5 FROM orders"""),
    "previous": (("base",), "SELECT city_id, observed_at, r.m1, r.m2, r.m3, r.m4, r.m5, 1 AS extracted_at FROM (SELECT city_id, observed_at, max_by({'m1': m1, 'm2': m2, 'm3': m3, 'm4': m4, 'm5': m5}, n) AS r FROM base WHERE n % 11 <> 0 GROUP BY ALL)"),
    "incoming": (("base",), """SELECT city_id, observed_at, CASE WHEN n % 7 = 0 THEN m1 + 1 ELSE m1 END AS m1, m2, m3, m4, m5, 2 AS extracted_at FROM base WHERE n % 5 <> 0
        UNION ALL SELECT city_id, observed_at, CASE WHEN n % 7 = 0 THEN m1 + 1 ELSE m1 END, m2, m3 + 1, m4, m5, 3 FROM base WHERE n % 5 <> 0 AND n % 13 = 0"""),
    "latest": (("incoming",), "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY city_id, observed_at ORDER BY extracted_at DESC, m1 DESC NULLS LAST, m2 DESC NULLS LAST, m3 DESC NULLS LAST, m4 DESC NULLS LAST, m5 DESC NULLS LAST) AS k FROM incoming) WHERE k = 1"),
}


def sql(select: str, *names: str) -> str:
    """select with the parts that it names, and those that they need, before it."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in PARTS[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    # a select may begin with parts of its own, after a comma
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + ("" if select.startswith(",") else "\n") + select
