"""Serving queries: what dashboards read from the marts. A city or severity of None means all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.expressions import share

#: Label and unit of metrics; other metrics are shown by name.
SHOWN = {
    "apparent_temperature": ("Apparent Temperature", "°C"), "temperature_2m": ("Temperature", "°C"), "daily_max_temperature": ("Daily Maximum Temperature", "°C"),
    "daily_min_temperature": ("Daily Minimum Temperature", "°C"), "daily_temperature_range": ("Daily Temperature Range", "°C"), "apparent_temperature_uplift": ("Apparent Temperature Uplift", "°C"),
    "precipitation": ("precipitation", "mm"), "daily_precipitation_sum": ("Daily Precipitation", "mm"), "relative_humidity": ("Relative Humidity", "%"), "wind_speed": ("Wind Speed", "km/h"),
    "pm2_5": ("PM2.5", "µg/m³"), "pm10": ("PM10", "µg/m³"), "pm2_5_rolling_24h": ("PM2.5 Rolling 24h", "µg/m³"),
}


def on_date(df: DataFrame, date: str, city: str | None = None, severity: str | None = None) -> DataFrame:
    out = df.filter(F.col("decision_date") == F.lit(date).cast("date"))
    out = out if city is None else out.filter(F.col("city_id") == city)
    return out if severity is None else out.filter(F.col("severity") == severity)


def available_dates(history: DataFrame) -> DataFrame:
    """G1: each date with the newest run that has it."""
    return history.groupBy("decision_date").agg(F.max("run_id").alias("latest_run_id"))


def default_date(dates: DataFrame, today: str) -> DataFrame:
    """Today if there is data for it, else the newest date."""
    now = F.lit(today).cast("date")
    return dates.agg(F.coalesce(F.max(F.when(F.col("decision_date") == now, F.col("decision_date"))), F.max("decision_date")).alias("decision_date"))


def ticker(daily: DataFrame, summary: DataFrame, date: str, city: str | None = None) -> DataFrame:
    """The day's conditions with its range of temperature."""
    range_ = on_date(summary, date).filter("metric = 'temperature_2m'").select("city_id", F.round("minimum_value", 1).alias("minimum_temperature"), F.round("maximum_value", 1).alias("maximum_temperature"))
    return on_date(daily, date, city).select("city_id", "signal_name", "severity", "predicate_explanation", "observed_persistence_hours").join(range_, "city_id", "left")


def executive_kpis(workload: DataFrame, date: str, city: str | None = None) -> DataFrame:
    """Totals of a date."""
    return on_date(workload, date, city).agg(
        F.sum("total_members").alias("population"), F.sum("at_risk_members").alias("exposed"), share(F.sum("at_risk_members"), F.sum("total_members"), 2).alias("exposed_share"),
        F.sum("contactable_members").alias("reachable"), F.sum("high_priority_members").alias("urgent"), F.count_if(F.col("at_risk_members") > 0).alias("cities_hit"))


def relevant_metrics(daily: DataFrame, summary: DataFrame, date: str, city: str | None = None) -> DataFrame:
    """The metrics that the day's conditions use, with label, unit and rounded values."""
    used = on_date(daily, date, city).select("city_id", F.explode("metrics").alias("metric")).distinct()
    shown = F.create_map(*(x for m, (label, unit) in SHOWN.items() for x in (F.lit(m), F.struct(F.lit(label).alias("label"), F.lit(unit).alias("unit")))))[F.col("metric")]
    values = {"minimum_value": "low", "average_value": "mean", "maximum_value": "high"}
    values |= {f"historical_{c}": f"usual_{c}" for c in ("average", "p10", "p90", "p95", "minimum", "maximum")}
    rounded = [F.round(a, 1).alias(b) for a, b in values.items()]
    return on_date(summary, date).join(used, ["city_id", "metric"]).select("city_id", F.coalesce(shown["label"], F.col("metric")).alias("metric"), shown["unit"].alias("unit"), *rounded)


def affected_members(exposure: DataFrame, date: str, city: str | None = None, severity: str | None = None, limit: int = 2000) -> DataFrame:
    """A report of the rows with the highest priority; the city's burden counts all its members."""
    burden = on_date(exposure, date).select("city_id", "member_id").distinct().groupBy("city_id").agg(F.count("*").alias("city_at_risk_members"))
    rows = on_date(exposure, date, city, severity).join(burden, "city_id")
    return rows.orderBy(F.desc("priority_score"), F.desc("city_at_risk_members"), "city_id", "member_id", "rule_id", "window_start").limit(limit)


def outreach_readiness(workload: DataFrame, date: str) -> DataFrame:
    """Cities at risk with the gap between members at risk and those who may be contacted."""
    exposed, reachable = F.col("at_risk_members"), F.col("contactable_members")
    rows = on_date(workload, date).filter(exposed > 0)
    return rows.select("city_id", exposed.alias("exposed"), reachable.alias("reachable"), (exposed - reachable).alias("unreachable"), share(reachable, exposed, 1).alias("reachable_share"))


def by_group(rows: DataFrame, group: str) -> DataFrame:
    """Distinct members of a group: exposed, reachable, urgent; a row per member first. Cities and the highest rank go along."""
    ours = rows.groupBy(group, "city_id", "member_id").agg(F.max("outreach_eligible").alias("e"), F.max("priority_score").alias("s"), F.max("severity_rank").alias("r"))
    return ours.groupBy(group).agg(F.count("*").alias("exposed"), F.count_if("e").alias("reachable"), F.count_if(F.col("s") >= 4).alias("urgent"), F.size(F.collect_set("city_id")).alias("cities"), F.max("r").alias("worst_rank"))


def risk_driver_impact(exposure: DataFrame, date: str) -> DataFrame:
    """Members and cities per signal."""
    return by_group(on_date(exposure, date), "signal_name").withColumnRenamed("signal_name", "driver").drop("urgent")


def condition_workload(exposure: DataFrame, date: str) -> DataFrame:
    """Members per matched condition."""
    return by_group(on_date(exposure, date).withColumn("condition", F.explode("matched_conditions")), "condition").select("condition", "exposed", "reachable", "urgent")


def channel_workload(exposure: DataFrame, date: str) -> DataFrame:
    """Members to contact per channel."""
    return by_group(on_date(exposure, date).filter("outreach_eligible"), "preferred_channel").select(F.col("preferred_channel").alias("channel"), "reachable", "urgent")


def newest_runs(history: DataFrame) -> DataFrame:
    """The rows of the newest run of each date."""
    return history.join(history.groupBy("decision_date").agg(F.max("run_id").alias("run_id")), ["decision_date", "run_id"], "left_semi")


def risk_lifecycle(history: DataFrame, date: str) -> DataFrame:
    """Members by what their risk did since the date before: new, escalated, continuing or resolved.

    One aggregation gives the least and highest rank of a member's rule on either date. A member counts once for each
    thing that any of its windows did, beside any of the same rule's on the date before.
    """
    day = F.lit(date).cast("date")
    rows = newest_runs(history.filter(F.col("decision_date") <= day))
    last = rows.filter(F.col("decision_date") < day).agg(F.max("decision_date").alias("last"))
    now, rank = F.col("decision_date") == day, F.col("severity_rank")
    near = rows.join(F.broadcast(last), now | (F.col("decision_date") == F.col("last")))  # one row
    ends = {n: f(F.when(now if n[0] == "a" else ~now, rank)) for n, f in (("a_low", F.min), ("a_high", F.max), ("b_low", F.min), ("b_high", F.max))}
    key = near.groupBy("member_id", "city_id", "rule_id").agg(*(c.alias(n) for n, c in ends.items()))
    did = {"new": "b_low IS NULL", "resolved": "a_low IS NULL", "escalated": "a_high > b_low", "continuing": "a_low <= b_high"}
    changes = F.array_compact(F.array(*(F.when(F.expr(test), F.lit(name)) for name, test in did.items())))
    return key.select("member_id", F.explode(changes).alias("change")).distinct().groupBy("change").agg(F.count("*").alias("members"))


def risk_trend(history: DataFrame, city: str | None = None) -> DataFrame:
    """Totals per date over the newest runs."""
    rows = newest_runs(history) if city is None else newest_runs(history).filter(F.col("city_id") == city)
    return rows.groupBy("decision_date").agg(F.sum("at_risk_members").alias("exposed"), share(F.sum("at_risk_members"), F.sum("total_members"), 2).alias("exposed_share"), F.sum("contactable_members").alias("reachable"))


def highlights(readiness: DataFrame, drivers: DataFrame) -> DataFrame:
    """The city with most members at risk, the one with the largest gap, and the signal that reaches most; ties by name."""
    def top(name: str, *order: str) -> Column:
        return F.max_by(name, F.struct(*order))

    # a name orders ties by its place among all names: the smallest first
    def tied(df: DataFrame, name: str) -> DataFrame:
        return df.withColumn("tie", -F.row_number().over(Window.orderBy(name)))

    left = tied(readiness, "city_id").agg(top("city_id", "exposed", "tie").alias("busiest_city"), top("city_id", "unreachable", "tie").alias("widest_gap_city"))
    return left.crossJoin(tied(drivers, "driver").agg(top("driver", "exposed", "tie").alias("main_driver")))


def replicated_exposure(exposure: DataFrame, date: str, factor: int) -> DataFrame:
    """The date's exposure replicated factor times; each replica has members of its own.

    Rows are counted per member before they are replicated, so that distinct members of replicas need no shuffle of them.
    """
    copies = exposure.sparkSession.range(factor).select("id")
    ours = on_date(exposure, date).groupBy("city_id", "severity", "member_id").agg(F.count("*").alias("n"), F.count_if("outreach_eligible").alias("e"))
    return ours.crossJoin(F.broadcast(copies)).groupBy("city_id", "severity").agg(F.sum("n").alias("rows"), F.count("*").alias("people"), F.sum("e").alias("reachable_rows"))
