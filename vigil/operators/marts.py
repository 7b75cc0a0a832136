"""The core marts: baselines, conditions, triggers, daily facts, exposure, workload, queue, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.expressions import RELEVANCE_WEIGHT, local_date, rank_of, satisfied, share, threshold_ratio

#: The metrics that rules may name; the daily summary has one more.
RULE_METRICS = (
    "apparent_temperature", "temperature_2m", "precipitation", "daily_precipitation_sum", "daily_min_temperature", "daily_max_temperature",
    "daily_temperature_range", "apparent_temperature_uplift", "relative_humidity", "wind_speed", "pm2_5", "pm2_5_rolling_24h",
)
SUMMARY_METRICS = (*RULE_METRICS, "pm10")
#: Which column of the daily history stands for which metrics.
HISTORY_METRICS = {
    "temperature_2m": "temperature_2m", "daily_max_temperature": "temperature_2m", "daily_min_temperature": "minimum_temperature_2m",
    "daily_temperature_range": "temperature_range", "daily_precipitation_sum": "precipitation",
}


def long_form(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(ids, metric, metric_value); nulls are rows, too."""
    return df.unpivot(list(ids), list(metrics), "metric", "metric_value")


def history_metrics(history: DataFrame) -> DataFrame:
    """The daily history in long form, by metric name."""
    wide = history.select("city_id", "observed_date", *(F.col(c).alias(m) for m, c in HISTORY_METRICS.items()))
    return long_form(wide, ("city_id", "observed_date"), HISTORY_METRICS)


def baselines(values: DataFrame, when: str) -> DataFrame:
    """Per city, calendar month and metric: exact percentiles, mean, extremes, counts and dates; nulls do not count.

    Percentiles are rounded to six digits and means to eight, so that they do not depend on the order of summation.
    """
    known = values.filter(F.col("metric_value").isNotNull())
    found = known.groupBy("city_id", F.month(when).alias("month"), "metric").agg(
        F.avg("metric_value").alias("average_value"), F.percentile("metric_value", F.array(F.lit(0.1), F.lit(0.9), F.lit(0.95))).alias("p"),
        F.min("metric_value").alias("minimum_value"), F.max("metric_value").alias("maximum_value"), F.count("*").alias("sample_count"),
        F.count_distinct(F.year(when)).alias("historical_years"), F.to_date(F.min(when)).alias("first_date"), F.to_date(F.max(when)).alias("last_date"),
    )
    parts = [F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p10_value", "p90_value", "p95_value"))]
    return found.select("city_id", "month", "metric", F.round("average_value", 8).alias("average_value"), *parts, "minimum_value", "maximum_value", "sample_count", "historical_years", "first_date", "last_date")


#: Hours of a segment, whole days: series are worked on segment by segment, so that one city or rule is many tasks.
SEGMENT_HOURS = 24 * 128


def segment(at: Column, hours: int = SEGMENT_HOURS) -> Column:
    """The number of the time's segment, counted from 1970."""
    return F.floor(hours_since_1970(at) / hours)


def hours_since_1970(at: Column) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), at) / 3600


def with_halo(df: DataFrame, at: str, before: int, hours: int = SEGMENT_HOURS) -> DataFrame:
    """df with __segment, and each row of the last ``before`` hours of a segment once more as __halo of the next."""
    own = segment(F.col(at), hours)
    late = hours_since_1970(F.col(at)) - own * hours >= hours - before
    both = F.array(F.struct(own.alias("n"), F.lit(False).alias("halo")), F.when(late, F.struct((own + 1).alias("n"), F.lit(True).alias("halo"))))
    return df.withColumn("__s", F.explode(F.array_compact(both))).withColumns({"__segment": F.col("__s.n"), "__halo": F.col("__s.halo")}).drop("__s")


def conditions(weather: DataFrame, air: DataFrame, cities: DataFrame, as_of: str, segment_hours: int = SEGMENT_HOURS) -> DataFrame:
    """Hours from as_of on that both sources have, of published cities, with daily and rolling values.

    Daily values cover what is left of the first day. Sums and means are rounded to six digits. A city is
    dealt by segments of whole days, each with the last 23 hours before it for the rolling mean, and both kinds of windows
    stay in a segment: one shuffle.
    """
    if segment_hours % 24:
        raise ValueError("segments are whole days")
    joined = weather.join(air, ["city_id", "observed_at"]).join(cities.select("city_id"), "city_id", "left_semi")
    joined = with_halo(joined.filter(F.col("observed_at") >= F.lit(as_of).cast("timestamp_ntz")), "observed_at", 23, segment_hours)
    rolling = F.expr("round(avg(pm2_5) OVER (PARTITION BY city_id, __segment ORDER BY observed_at RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW), 6)")
    ours = joined.withColumn("pm2_5_rolling_24h", rolling).filter("NOT __halo")
    day = Window.partitionBy("city_id", "__segment", F.to_date("observed_at"))
    wide = ours.withColumns({
        "apparent_temperature_uplift": F.round(F.col("apparent_temperature") - F.col("temperature_2m"), 6),
        "daily_precipitation_sum": F.round(F.sum("precipitation").over(day), 6),
        "daily_min_temperature": F.min("temperature_2m").over(day),
        "daily_max_temperature": F.max("temperature_2m").over(day),
    })
    return wide.withColumn("daily_temperature_range", F.round(F.col("daily_max_temperature") - F.col("daily_min_temperature"), 6)).drop("__segment", "__halo")


def applicable_predicates(definitions: DataFrame, predicates: DataFrame, known: DataFrame) -> DataFrame:
    """Predicates of each rule, city and month with the threshold in force; those on a baseline that is missing are dropped."""
    ours = definitions.join(predicates, ["ruleset_version", "rule_id"])
    ours = ours.join(known.select("city_id", "month", "metric", "p10_value", "p90_value", "p95_value"), ["city_id", "month", "metric"], "left")
    local = F.when(F.col("baseline_percentile") == "p10", F.col("p10_value")).when(F.col("baseline_percentile") == "p90", F.col("p90_value")).when(F.col("baseline_percentile") == "p95", F.col("p95_value"))
    threshold = F.when(F.col("comparison") == "absolute", F.col("threshold")).otherwise(local)
    return ours.withColumn("effective_threshold", threshold).filter((F.col("comparison") == "absolute") | F.col("p90_value").isNotNull()).drop("threshold", "p10_value", "p90_value", "p95_value")


def predicate_evaluations(hours: DataFrame, applicable: DataFrame) -> DataFrame:
    """E3a, E3c-E3e: every predicate on every hour of its city and month. The catalog is small beside the hours; AQE broadcasts it when it is."""
    values = long_form(hours, ("city_id", "observed_at"), RULE_METRICS).withColumn("month", F.month("observed_at"))
    value, operator, threshold = F.col("metric_value"), F.col("operator"), F.col("effective_threshold")
    shown = F.round(threshold, 1).cast("string")
    text = F.concat_ws("", "metric", F.lit(" "), "operator", F.lit(" "), F.when(F.col("comparison") == "baseline_percentile", F.concat_ws("", F.lit("local "), "baseline_percentile", F.lit(" "), shown)).otherwise(shown))
    joined = values.join(applicable, ["city_id", "month", "metric"])
    return joined.withColumns({"met": satisfied(value, operator, threshold), "ratio": threshold_ratio(value, operator, threshold), "explanation": text})


RULE = ("ruleset_version", "rule_id", "city_id")


def rule_evaluations(evaluated: DataFrame) -> DataFrame:
    """E3f: a rule's hour is a breach if all its predicates hold; hours that lack a predicate are not evaluated."""
    parts = F.array_sort(F.collect_list(F.struct("predicate_index", "metric", "metric_value", "effective_threshold", "explanation")))
    found = evaluated.groupBy(*RULE, "signal_name", "signal_category", "persistence_hours", "predicate_count", "observed_at").agg(
        F.count("*").alias("n"), F.count_if("met").alias("n_met"), F.min("ratio").alias("threshold_ratio"), parts.alias("parts"))
    return found.filter("n = predicate_count").withColumn("is_breach", F.col("n_met") == F.col("predicate_count")).drop("n", "n_met")


def follows(before: Column, at: Column) -> Column:
    """Whether a time is in the hour after another; not if there is no other."""
    return F.coalesce(F.timestamp_diff("HOUR", F.date_trunc("hour", before), F.date_trunc("hour", at)) == 1, F.lit(False))


def streaks(evaluations: DataFrame, keys: Sequence[str] = RULE, segment_hours: int = SEGMENT_HOURS) -> DataFrame:
    """E3g: a new streak at every first row, non-breach, and row that does not follow its predecessor by one hour; streak_group counts them.

    Gaps and islands within segments first: each row's streak, counted from its segment's start. A row for each segment then
    tells whether its first row goes on with what the segment before ended with, and how many streaks there were before: the
    ends merge, and one hot rule and city is as many tasks as it has segments.
    """
    keys, here = list(keys), segment(F.col("observed_at"), segment_hours)
    by_time = Window.partitionBy(*keys, "__segment").orderBy("observed_at")
    before = F.lag("observed_at").over(by_time)
    # whether a segment's first row begins a streak is left open
    begins = (~(F.col("is_breach") & follows(before, F.col("observed_at"))) & before.isNotNull()).cast("int")
    local = evaluations.withColumn("__segment", here).withColumn("__begins", begins)
    local = local.withColumn("__local", F.sum("__begins").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__begins")
    ends = local.groupBy(*keys, "__segment").agg(F.min("observed_at").alias("first"), F.max("observed_at").alias("last"), F.min_by("is_breach", "observed_at").alias("opens"), F.max("__local").alias("n"))
    by_segment = Window.partitionBy(*keys).orderBy("__segment")  # a row for each segment
    joins = F.col("opens") & follows(F.lag("last").over(by_segment), F.col("first"))
    ends = ends.withColumn("own", (~joins).cast("int"))
    earlier = F.coalesce(F.sum(F.col("n") + F.col("own")).over(by_segment.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = ends.select(*keys, "__segment", (earlier + F.col("own")).alias("__shift"))
    return local.join(ends, [*keys, "__segment"]).withColumn("streak_group", F.col("__shift") + F.col("__local")).select(*evaluations.columns, "streak_group")


def persisted_windows(grouped: DataFrame) -> DataFrame:
    """E3h: streaks of breaches as long as the rule asks; what the first hour held stands for the window."""
    found = grouped.filter("is_breach").groupBy(*RULE, "signal_name", "signal_category", "predicate_count", "persistence_hours", "streak_group").agg(
        F.min("observed_at").alias("window_start"), F.max("observed_at").alias("window_end"), F.count("*").alias("observed_persistence_hours"),
        F.min("threshold_ratio").alias("threshold_ratio"), F.min_by("parts", "observed_at").alias("parts"))
    kept = found.filter(F.col("observed_persistence_hours") >= F.col("persistence_hours"))
    texts = F.array_join(F.transform("parts", lambda p: p["explanation"]), " AND ")
    return kept.withColumns({"metrics": F.transform("parts", lambda p: p["metric"]), "effective_thresholds": F.transform("parts", lambda p: p["effective_threshold"]), "predicate_explanation": texts}).drop("parts")


def with_severity(windows: DataFrame, bands: DataFrame) -> DataFrame:
    """E3i: the highest band that hours and ratio reach; windows that reach none are dropped."""
    ours = bands.select("ruleset_version", "rule_id", "severity", "severity_rank", "minimum_persistence_hours", "minimum_threshold_ratio")
    reached = windows.join(ours, ["ruleset_version", "rule_id"]).filter("observed_persistence_hours >= minimum_persistence_hours AND threshold_ratio >= minimum_threshold_ratio")
    first = Window.partitionBy(*RULE, "streak_group").orderBy(F.desc("severity_rank"), "severity")
    return reached.withColumn("__n", F.row_number().over(first)).filter("__n = 1").drop("__n", "minimum_persistence_hours", "minimum_threshold_ratio")


def active_triggers(hours: DataFrame, definitions: DataFrame, predicates: DataFrame, bands: DataFrame, known: DataFrame, decision_date: str, zone: str) -> DataFrame:
    """The windows in which rules hold, with severity, timing and a sentence."""
    windows = persisted_windows(streaks(rule_evaluations(predicate_evaluations(hours, applicable_predicates(definitions, predicates, known)))))
    start, decision = local_date(F.col("window_start"), zone), F.lit(decision_date).cast("date")
    sentence = F.concat_ws("", "signal_name", F.lit(": "), "predicate_explanation", F.lit(" for "), F.col("observed_persistence_hours").cast("string"), F.lit(" consecutive forecast hours in "), "city_id", F.lit("."))
    return with_severity(windows, bands).withColumns({
        "forecast_start_date": start, "days_until_start": F.datediff(start, decision),
        "action_timing": F.when(start <= decision, "today_action").otherwise("upcoming_risk"), "trigger_explanation": sentence,
    })


def conditions_daily(triggers: DataFrame, zone: str) -> DataFrame:
    """A row for each local date of a trigger, both ends included; a window that ends before it starts has none."""
    last = local_date(F.col("window_end"), zone)
    days = F.when(F.col("forecast_start_date") <= last, F.sequence(F.col("forecast_start_date"), last, F.expr("INTERVAL 1 DAY")))
    return triggers.withColumn("decision_date", F.explode(days))


def metrics_daily(hours: DataFrame, known: DataFrame, zone: str) -> DataFrame:
    """E5: the day's range of each metric beside the history of its month; aggregated before the join."""
    values = long_form(hours, ("city_id", "observed_at"), SUMMARY_METRICS).withColumn("decision_date", local_date(F.col("observed_at"), zone))
    days = values.groupBy("decision_date", "city_id", "metric").agg(F.min("metric_value").alias("minimum_value"), F.round(F.avg("metric_value"), 8).alias("average_value"), F.max("metric_value").alias("maximum_value"))
    history = known.select("city_id", "month", "metric", *(F.col(a).alias(b) for a, b in (("average_value", "historical_average"), ("p10_value", "historical_p10"), ("p90_value", "historical_p90"), ("p95_value", "historical_p95"), ("minimum_value", "historical_minimum"), ("maximum_value", "historical_maximum"))))
    return days.withColumn("month", F.month("decision_date")).join(history, ["city_id", "month", "metric"], "left").drop("month")


def own_priority(relevance: Column, age_band: Column) -> Column:
    """What a member adds to a trigger's severity: relevance 2 to 0, plus 1 for the oldest band."""
    weight = F.lit(0)
    for name, w in RELEVANCE_WEIGHT.items():
        weight = F.when(relevance == name, F.lit(w)).otherwise(weight)
    return weight + F.when(age_band == "60+", 1).otherwise(0)


def priority(severity: Column, own: Column) -> Column:
    """Severity 4 to 1, and what the member adds."""
    return F.coalesce(rank_of(severity), F.lit(1)) + own


#: Daily rows that are broadcast at most (some 300 bytes each); parts that a city and rule's members are dealt into beyond that.
BROADCAST_DAYS, SALTS = 100_000, 32
ON = ("city_id", "ruleset_version", "rule_id")


def matched_members(members: DataFrame, links: DataFrame, relevance: DataFrame) -> DataFrame:
    """A row for each member and rule with the member's conditions that the rule is relevant for, and what the member adds to priority as __own."""
    matched = links.join(relevance, "condition").groupBy("member_id", "ruleset_version", "rule_id").agg(
        F.array_sort(F.collect_set("condition")).alias("matched_conditions"), F.array_sort(F.collect_set("relevance")).alias("matched_relevance_levels"))
    best = F.when(F.array_contains("matched_relevance_levels", "high"), "high").when(F.array_contains("matched_relevance_levels", "medium"), "medium").otherwise("low")
    return members.join(matched, "member_id").withColumn("__own", own_priority(best, F.col("age_band")))


def exposed_members(people: DataFrame, daily: DataFrame, few: bool, salts: int = SALTS) -> DataFrame:
    """Members and rules paired with the daily rows of their cities and rules, which are broadcast where they are few."""
    if few:
        exposed = people.join(F.broadcast(daily), list(ON))
    else:
        salted = people.withColumn("__salt", F.pmod(F.xxhash64("member_id"), F.lit(salts)))
        copies = daily.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        exposed = salted.join(copies, [*ON, "__salt"]).drop("__salt")
    return exposed.withColumns({
        "priority_score": priority(F.col("severity"), F.col("__own")), "outreach_eligible": F.col("outreach_consent"),
        "outreach_ineligibility_reason": F.when(~F.col("outreach_consent"), "no_outreach_consent"),
    }).drop("__own")


def member_exposure(members: DataFrame, links: DataFrame, daily: DataFrame, relevance: DataFrame, most: int = BROADCAST_DAYS, salts: int = SALTS) -> DataFrame:
    """One row per date, member and trigger, with the member's conditions that the rule is relevant for.

    Members are paired with rules first, so each meets the daily rows of its city and its rules once, and not once per
    condition. Cities and rules are few and members many: the daily rows go to the members where they are no more than
    ``most`` in all; beyond, they are copied ``salts`` times and a city's members dealt over the copies.
    """
    return exposed_members(matched_members(members, links, relevance), daily, daily.count() <= most, salts)


def per_member(exposure: DataFrame) -> DataFrame:
    """Exposure by date, city and member: what counts of distinct members need, aggregated once."""
    return exposure.groupBy("decision_date", "city_id", "member_id").agg(
        F.max("outreach_eligible").alias("eligible"), F.max("priority_score").alias("score"), F.max("severity_rank").alias("rank"))


def care_workload(exposure: DataFrame, members: DataFrame, summary: DataFrame, cities: DataFrame) -> DataFrame:
    """Members at risk per date and city, for every date and city of the summary; cities without members vanish."""
    totals = members.join(cities.select("city_id"), "city_id", "left_semi").groupBy("city_id").agg(F.count_distinct("member_id").alias("total_members"))
    counted = per_member(exposure).groupBy("decision_date", "city_id").agg(
        F.count("*").alias("at_risk_members"), F.count_if("eligible").alias("contactable_members"), F.count_if(F.col("score") >= 4).alias("high_priority_members"), F.max("rank").alias("maximum_severity_rank"))
    active = exposure.select("decision_date", "city_id", "rule_id").distinct().groupBy("decision_date", "city_id").agg(F.count("*").alias("active_conditions"))
    names = ("at_risk_members", "contactable_members", "high_priority_members", "active_conditions", "maximum_severity_rank")
    spine = summary.select("decision_date", "city_id").distinct().join(totals, "city_id")
    wide = spine.join(counted, ["decision_date", "city_id"], "left").join(active, ["decision_date", "city_id"], "left").fillna(0, list(names))
    return wide.select("decision_date", "city_id", *names, "total_members", share(F.col("at_risk_members"), F.col("total_members"), 2).alias("at_risk_percentage"))


def outreach_queue(exposure: DataFrame) -> DataFrame:
    """The rows of members who consented."""
    return exposure.filter("outreach_eligible").drop("outreach_eligible", "outreach_ineligibility_reason")


TRIGGER = ("decision_date", "ruleset_version", "rule_id", "city_id", "signal_name", "severity", "window_start", "window_end", "observed_persistence_hours", "action_timing", "trigger_explanation")


def stakeholder_alerts(queue: DataFrame) -> DataFrame:
    """Members to contact per trigger and date."""
    ours = queue.groupBy(*TRIGGER, "member_id").agg(F.max("priority_score").alias("score"))
    return ours.groupBy(*TRIGGER).agg(F.count("*").alias("eligible_members"), F.count_if(F.col("score") >= 4).alias("high_priority_members"))


def alerts_of_factors(people: DataFrame, daily: DataFrame) -> DataFrame:
    """E9 from the factors of exposure: members who consented are counted by city, rule and what they add to priority, and the
    counts meet the daily rows, so that no row is made for a member and a day."""
    ours = people.filter("outreach_consent").groupBy(*ON, "member_id").agg(F.max("__own").alias("__own")).groupBy(*ON, "__own").agg(F.count("*").alias("n"))
    rows = ours.join(daily.select(*TRIGGER).distinct(), list(ON))
    return rows.groupBy(*TRIGGER).agg(F.sum("n").alias("eligible_members"), F.coalesce(F.sum(F.when(priority(F.col("severity"), F.col("__own")) >= 4, F.col("n"))), F.lit(0).cast("long")).alias("high_priority_members"))
