"""Data quality: source profiles and checks, reconciliation, anomalies, integrity of the marts, readiness, the gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.expressions import three_level
from vigil.sources.storage import fresh_folder, read, write


def source_profile(df: DataFrame, dataset: str, keys: Sequence[str], when: str) -> DataFrame:
    """rows, distinct natural keys, latest time."""
    return df.agg(F.lit(dataset).alias("dataset"), F.count("*").alias("rows"), F.count_distinct(*keys).alias("distinct_keys"), F.max(when).alias("latest"))


def status(ok: Column) -> Column:
    return F.when(ok, "pass").otherwise("fail")


def checks(df: DataFrame, tests: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(dataset, check, status, details): a row for each test (status, details) of each row."""
    rows = F.array(*(F.struct(F.lit(n).alias("check"), s.alias("status"), d.cast("string").alias("details")) for n, (s, d) in tests.items()))
    return df.select("dataset", F.explode(rows).alias("r")).select("dataset", "r.*")


def source_checks(profile: DataFrame, cities: int, least_per_city: int, oldest: str) -> DataFrame:
    """rows at all, rows for all cities, one row a key, and data as late as oldest."""
    rows = F.col("rows")
    return checks(profile, {
        "non_empty": (status(rows > 0), rows), "coverage": (status(rows >= cities * least_per_city), rows),
        "unique_key": (status(rows == F.col("distinct_keys")), rows - F.col("distinct_keys")),
        "freshness": (status(F.coalesce(F.col("latest") >= F.lit(oldest).cast("timestamp_ntz"), F.lit(False))), F.date_format("latest", "yyyy-MM-dd HH:mm:ss")),
    })


def historical_profile(history: DataFrame) -> DataFrame:
    """rows, cities, years, latest date."""
    return history.agg(F.lit("history").alias("dataset"), F.count("*").alias("rows"), F.count_distinct("city_id").alias("cities"), F.count_distinct(F.year("observed_date")).alias("years"), F.max("observed_date").alias("latest"))


def historical_checks(profile: DataFrame, cities: int, years: int, ratio: float) -> DataFrame:
    """rows for cities * 365 * years * ratio, all cities, exactly the years asked for."""
    return checks(profile, {
        "rows": (status(F.col("rows") >= F.lit(cities * 365 * years * ratio)), F.col("rows")),
        "cities": (status(F.col("cities") >= cities), F.col("cities")), "years": (status(F.col("years") == years), F.col("years")),
    })


def reconciliation(weather: DataFrame, air: DataFrame, cities: DataFrame, as_of: str) -> DataFrame:
    """future hours of published cities on either side, matched and not; one full outer join, keys being unique."""
    def side(df: DataFrame, name: str) -> DataFrame:
        ours = df.filter(F.col("observed_at") >= F.lit(as_of).cast("timestamp_ntz")).join(cities, "city_id", "left_semi")
        return ours.select("city_id", "observed_at", F.lit(True).alias(name))

    w, a = F.col("w").isNotNull(), F.col("a").isNotNull()
    return side(weather, "w").join(side(air, "a"), ["city_id", "observed_at"], "full_outer").agg(
        F.count_if(w).alias("weather_rows"), F.count_if(a).alias("air_rows"), F.count_if(w & a).alias("matched"), F.count_if(w & ~a).alias("weather_only"), F.count_if(a & ~w).alias("air_only"))


def join_loss(counts: DataFrame, warn: float, fail: float) -> DataFrame:
    """the share of each side that found no partner; an empty side lost all."""
    def loss(only: str, rows: str) -> Column:
        return F.coalesce(F.try_divide(F.col(only), F.col(rows)), F.lit(1.0))

    w, a = F.round(loss("weather_only", "weather_rows"), 4), F.round(loss("air_only", "air_rows"), 4)
    return checks(counts.withColumn("dataset", F.lit("join")), {"weather_join_loss": (three_level(w, warn, fail), w), "air_join_loss": (three_level(a, warn, fail), a)})


def profile_history(profiles: DataFrame, runs: DataFrame, run_id: str) -> DataFrame:
    """average and number of samples per dataset and metric over other successful runs."""
    ours = profiles.filter(F.col("run_id") != run_id).join(runs.filter(F.col("status").isin("success", "partial_success")), "run_id", "left_semi")
    return ours.groupBy("dataset", "metric").agg(F.avg("value").alias("average_value"), F.count("*").alias("samples"))


def row_anomalies(current: DataFrame, history: DataFrame, least: int, warn: float, fail: float) -> DataFrame:
    """How far a value is from the mean of earlier runs; with too few samples, or a mean of 0, it passes."""
    ratio = F.round(F.abs(F.col("value") - F.col("average_value")) / F.col("average_value"), 4)
    known = (F.coalesce("samples", F.lit(0)) >= least) & (F.coalesce("average_value", F.lit(0.0)) != 0)
    joined = current.join(history, ["dataset", "metric"], "left")
    return joined.select("dataset", "metric", F.when(known, ratio).alias("ratio"), F.when(known, three_level(ratio, warn, fail)).otherwise("pass").alias("status"), F.when(known, "history").otherwise("insufficient").alias("baseline"))


ALERT_KEY = ("decision_date", "rule_id", "city_id", "window_start")
MEMBER_KEY = (*ALERT_KEY, "member_id", "ruleset_version")
CHECKS = ("consent_leakage", "duplicate_member_triggers", "invalid_windows", "queue_without_trigger", "alert_mismatches", "unapproved_city_rows", "queue_without_exposure", "workload_mismatches", "at_risk_above_total")


def counted(df: DataFrame, **checks: Column) -> DataFrame:
    """(check, n) of each check: one aggregation of df."""
    sums = df.agg(*(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(c) for c, n in checks.items()))
    return sums.unpivot([], list(checks), "check", "n")


def integrity(exposure: DataFrame, queue: DataFrame, alerts: DataFrame, triggers: DataFrame, workload: DataFrame, cities: DataFrame) -> DataFrame:
    """one row of nine counts, all 0 for marts that agree with each other.

    Exposure and queue meet once, by member and trigger, and become a row for each date and trigger, which is written; what is
    asked of alerts, triggers and cities is asked of that small table. Exposure is aggregated once more, by member, for the workload.
    """
    whole = exposure.select(*MEMBER_KEY, F.lit(None).cast("int").alias("score"), F.lit(False).alias("unasked"), F.lit(1).alias("e"))
    asked = queue.select(*MEMBER_KEY, F.col("priority_score").alias("score"), (~F.col("outreach_consent")).alias("unasked"), F.lit(0).alias("e"))
    per_member = whole.unionByName(asked).groupBy(*MEMBER_KEY).agg(F.sum("e").alias("e"), F.sum(1 - F.col("e")).alias("q"), F.count_if("unasked").alias("unasked"), F.max("score").alias("score"))
    key = (*ALERT_KEY, "ruleset_version")
    per_trigger = per_member.groupBy(*key).agg(
        F.sum("q").alias("q"), F.sum("unasked").alias("unasked"), F.count_if(F.col("q") > 1).alias("again"), F.sum(F.when(F.col("e") == 0, F.col("q")).otherwise(0)).alias("alone"),
        F.count_if(F.col("q") > 0).alias("n"), F.count_if(F.col("score") >= 4).alias("h"))
    path = fresh_folder(exposure.sparkSession, "integrity")
    write(per_trigger, path)
    per_trigger = read(exposure.sparkSession, path, per_trigger.schema)
    queued = per_trigger.filter("q > 0")
    found = [counted(per_trigger, consent_leakage=F.col("unasked"), duplicate_member_triggers=F.col("again"), queue_without_exposure=F.col("alone"))]
    found.append(counted(queued.join(triggers, ["ruleset_version", "rule_id", "city_id", "window_start"], "left_anti"), queue_without_trigger=F.col("q")))
    on = [c for c in key if c in alerts.columns]
    again = queued.groupBy(*on).agg(F.sum("n").alias("n"), F.sum("h").alias("h"))
    pairs = alerts.select(*on, "eligible_members", "high_priority_members").join(again, on, "full_outer")
    agree = F.col("eligible_members").eqNullSafe(F.col("n")) & F.col("high_priority_members").eqNullSafe(F.col("h"))
    found.append(counted(pairs, alert_mismatches=(~agree).cast("int")))
    ours = exposure.groupBy("decision_date", "city_id", "member_id").agg(F.max("outreach_eligible").alias("e"), F.max("priority_score").alias("s"))
    ours = ours.groupBy("decision_date", "city_id").agg(F.count("*").alias("n"), F.count_if("e").alias("c"), F.count_if(F.col("s") >= 4).alias("h"))
    differ = " OR ".join(f"coalesce({a}, 0) <> coalesce({b}, 0)" for a, b in (("at_risk_members", "n"), ("contactable_members", "c"), ("high_priority_members", "h")))
    found.append(counted(workload.join(ours, ["decision_date", "city_id"], "full_outer"), workload_mismatches=F.expr(differ).cast("int"), at_risk_above_total=F.expr("at_risk_members > total_members").cast("int")))
    found.append(counted(triggers, invalid_windows=F.expr("observed_persistence_hours < persistence_hours OR window_end < window_start").cast("int")))
    rows = triggers.groupBy("city_id").count().unionByName(alerts.groupBy("city_id").count()).unionByName(queued.groupBy("city_id").agg(F.sum("q").alias("count")))
    found.append(counted(rows.join(cities, "city_id", "left_anti"), unapproved_city_rows=F.col("count")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.groupBy().pivot("check", list(CHECKS)).agg(F.first("n"))


def integrity_results(row: DataFrame, maxima: dict[str, int]) -> DataFrame:
    """(check, actual, maximum, status) from a row of counts; a count without a maximum may not exceed 0."""
    rows = F.array(*(F.struct(F.lit(c).alias("check"), F.col(c).alias("actual"), F.lit(maxima.get(c, 0)).alias("maximum")) for c in row.columns))
    return row.select(F.explode(rows).alias("r")).select("r.*").withColumn("status", status(F.col("actual") <= F.col("maximum")))


def city_readiness(expected: DataFrame, state: DataFrame, required: Sequence[str], fresh_after: str) -> DataFrame:
    """per city, whether each expected source that is required succeeded and is fresh. A success without a time counts as fresh."""
    asked = expected.filter(F.col("source").isin(*required))
    ok = (F.col("status") == "success") & F.coalesce(F.col("latest") >= F.lit(fresh_after).cast("timestamp_ntz"), F.lit(True))
    return asked.join(state, ["city_id", "source"], "left").groupBy("city_id").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("complete"))


def run_readiness(cities: DataFrame, least: int, ratio: float, mandatory: Sequence[str]) -> DataFrame:
    """success if all cities are complete; partial if enough are, and all mandatory ones; else failed."""
    n, done = F.count("*"), F.count_if("complete")
    missing = F.lit(len(mandatory)) - F.count_if(F.col("complete") & F.col("city_id").isin(*mandatory))
    enough = done >= F.greatest(F.lit(least), F.ceil(n * ratio))
    return cities.agg(n.alias("cities"), done.alias("complete_cities"), F.when((n > 0) & (done == n), "success").when(enough & (missing == 0), "partial_success").otherwise("failed").alias("status"))


def publication_cities(cities: DataFrame) -> DataFrame:
    """F13."""
    return cities.filter("complete").select("city_id")


def may_publish(results: DataFrame) -> bool:
    """no result failed. The pipeline's only collect, of one value."""
    return not results.agg(F.coalesce(F.bool_or(F.col("status") == "fail"), F.lit(False))).first()[0]
