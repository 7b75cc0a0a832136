"""Rule catalogs: compiled tables, merges and checks.

A catalog is a frame of rules: ruleset_version, rule_id, cities and months
(arrays), predicates and bands (arrays of structs; bands may be null),
persistence_hours, severity, signal_name, signal_category, condition_profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.expressions import rank_of

SCHEMA = """ruleset_version string, rule_id string, cities array<string>, months array<int>,
  predicates array<struct<metric:string,operator:string,comparison:string,threshold:double,baseline_percentile:string,function:string,window_hours:int>>,
  bands array<struct<severity:string,minimum_persistence_hours:int,minimum_threshold_ratio:double>>,
  persistence_hours int, severity string, signal_name string, signal_category string, condition_profile string"""
KEY = ("ruleset_version", "rule_id")


def definitions(rules: DataFrame) -> DataFrame:
    """One row per rule, city and month."""
    wide = rules.withColumn("city_id", F.explode("cities")).withColumn("month", F.explode("months"))
    return wide.select(*KEY, "city_id", "month", F.size("predicates").alias("predicate_count"), "persistence_hours", "severity", "signal_name", "signal_category")


def predicates(rules: DataFrame) -> DataFrame:
    """One row per predicate, counted from 1."""
    return rules.select(*KEY, F.posexplode("predicates").alias("i", "p")).select(*KEY, (F.col("i") + 1).alias("predicate_index"), "p.*")


def condition_relevance(rules: DataFrame, profiles: DataFrame) -> DataFrame:
    """D3: the relevance of each condition of the rule's profile; profiles is (condition_profile, relevance as a map)."""
    return rules.join(profiles, "condition_profile").select(*KEY, F.explode("relevance").alias("condition", "relevance"))


def severity_bands(rules: DataFrame) -> DataFrame:
    """The rule's bands; without any, its own severity at its persistence and ratio 1."""
    own = F.array(F.struct(F.col("severity").alias("severity"), F.col("persistence_hours").alias("minimum_persistence_hours"), F.lit(1.0).alias("minimum_threshold_ratio")))
    bands = F.when(F.size("bands") > 0, F.col("bands")).otherwise(own)
    return rules.select(*KEY, F.explode(bands).alias("b")).select(*KEY, "b.*").withColumn("severity_rank", rank_of(F.col("severity")))


def catalog_mismatches(detection: DataFrame, governance: DataFrame) -> DataFrame:
    """(rule_id, missing_in) of ids that only one side has."""
    both = detection.select("rule_id", F.lit(1).alias("d")).join(governance.select("rule_id", F.lit(1).alias("g")), "rule_id", "full_outer")
    return both.filter("d IS NULL OR g IS NULL").select("rule_id", F.when(F.col("d").isNull(), "detection").otherwise("governance").alias("missing_in"))


def merged_catalog(detection: DataFrame, governance: DataFrame) -> DataFrame:
    """Rules of both sides that are not retired."""
    return detection.join(governance, "rule_id").filter("status <> 'retired'")


def semantic_violations(rules: DataFrame) -> DataFrame:
    """(rule_id, violation): repeated cities, months or predicates, months out of range, thresholds that do not go
    with the comparison, and bands whose severity falls while both of their thresholds rise."""
    p, b = F.col("predicates"), F.coalesce("bands", F.array())
    falls = F.exists(b, lambda x: F.exists(b, lambda y: (y["minimum_persistence_hours"] >= x["minimum_persistence_hours"]) & (y["minimum_threshold_ratio"] >= x["minimum_threshold_ratio"]) & (rank_of(y["severity"]) < rank_of(x["severity"]))))
    tests = {
        "repeated_cities": F.size(F.array_distinct("cities")) < F.size("cities"),
        "repeated_months": F.size(F.array_distinct("months")) < F.size("months"),
        "months_out_of_range": F.exists("months", lambda m: (m < 1) | (m > 12)),
        "repeated_predicates": F.size(F.array_distinct(p)) < F.size(p),
        "absolute_without_threshold": F.exists(p, lambda x: (x["comparison"] == "absolute") & x["threshold"].isNull()),
        "rolling_without_hours": F.exists(p, lambda x: (x["function"] == "rolling_average") & x["window_hours"].isNull()),
        "hours_without_rolling": F.exists(p, lambda x: (x["function"] != "rolling_average") & x["window_hours"].isNotNull()),
        "percentile_with_threshold": F.exists(p, lambda x: (x["comparison"] == "baseline_percentile") & (x["threshold"].isNotNull() | x["baseline_percentile"].isNull())),
        "severity_falls": falls,
    }
    found = F.filter(F.array(*(F.when(t, F.lit(n)) for n, t in tests.items())), lambda x: x.isNotNull())
    return rules.select("rule_id", F.explode(found).alias("violation"))


def reference_violations(rules: DataFrame, cities: DataFrame, profiles: DataFrame) -> DataFrame:
    """(rule_id, violation, value): cities and profiles that are not known, and ids that occur more than once."""
    used = rules.select("rule_id", F.explode(F.array_distinct("cities")).alias("city_id"))
    unknown_city = used.join(cities, "city_id", "left_anti").select("rule_id", F.lit("unknown_city").alias("violation"), F.col("city_id").alias("value"))
    unknown_profile = rules.join(profiles.select("condition_profile"), "condition_profile", "left_anti").select("rule_id", F.lit("unknown_profile").alias("violation"), F.col("condition_profile").alias("value"))
    repeated = rules.groupBy("rule_id").agg(F.count("*").alias("n")).filter("n > 1").select("rule_id", F.lit("repeated_rule").alias("violation"), F.col("n").cast("string").alias("value"))
    return unknown_city.unionByName(unknown_profile).unionByName(repeated)
