"""The given tables as the domain's frames: entities, hourly and daily series, members, rules.

Entities ("cities") are the five regions; events located by their user's region
are the hourly sources; orders are the daily history; customers are members and
their orders' priorities the conditions they have; parts make a rule catalog.
Every number that is summed is a whole one until the last step, so that results
do not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kinds of events that each hourly source sees.
WEATHER_EVENTS = ("view", "click", "purchase", "error")
AIR_EVENTS = ("signup", "view", "click")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with its region as city_id. nation and region are fixed tables of 25 and 5 rows."""
    nation = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "customer").join(F.broadcast(nation.select("n_nationkey", F.col("r_name").alias("city_id"))), F.col("c_nationkey") == F.col("n_nationkey"))


def located_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(city_id, observed_at by the hour, event_type, cents, k)."""
    where = customers(spark, sf_dir).select("c_custkey", "city_id")
    events = table(spark, sf_dir, "events").join(where, F.col("user_id") == F.col("c_custkey"))
    return events.select(
        "city_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("observed_at"), "event_type",
        F.round(F.col("value") * 100).cast("long").alias("cents"), F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly source 1: five measures per city and hour."""
    seen = located_events(spark, sf_dir).filter(F.col("event_type").isin(*WEATHER_EVENTS))
    return seen.groupBy("city_id", "observed_at").agg(
        (F.sum("cents").cast("double") / F.count("*") / 100.0).alias("apparent_temperature"),
        (F.max("cents") / 100.0).alias("temperature_2m"),
        (F.sum("cents") / 100.0).alias("precipitation"),
        (F.min("cents") / 100.0).alias("relative_humidity"),
        F.count("*").cast("double").alias("wind_speed"),
    )


def air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly source 2: two measures per city and hour."""
    seen = located_events(spark, sf_dir).filter(F.col("event_type").isin(*AIR_EVENTS))
    return seen.groupBy("city_id", "observed_at").agg((F.sum("k").cast("double") / F.count("*")).alias("pm2_5"), F.max("k").cast("double").alias("pm10"))


def daily_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily extremes and sums per city, from orders."""
    orders = table(spark, sf_dir, "orders").join(customers(spark, sf_dir).select("c_custkey", "city_id"), F.col("o_custkey") == F.col("c_custkey"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    days = orders.groupBy("city_id", F.to_date("o_orderdate").alias("observed_date")).agg(F.max(cents).alias("hi"), F.min(cents).alias("lo"), F.sum(cents).alias("total"))
    return days.select(
        "city_id", "observed_date", (F.col("hi") / 100.0).alias("temperature_2m"), (F.col("lo") / 100.0).alias("minimum_temperature_2m"),
        ((F.col("hi") - F.col("lo")) / 100.0).alias("temperature_range"), (F.col("total") / 100.0).alias("precipitation"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).select(
        F.col("c_custkey").alias("member_id"), "city_id",
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "60+").when(F.col("c_mktsegment") == "HOUSEHOLD", "40-59").otherwise("18-39").alias("age_band"),
        F.element_at(F.array(F.lit("app"), F.lit("sms"), F.lit("call")), (F.col("c_custkey") % 3 + 1).cast("int")).alias("preferred_channel"),
        (F.col("c_acctbal") >= 0).alias("outreach_consent"),
    )


def member_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(member_id, condition): the distinct priorities of a customer's orders."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("member_id"), F.col("o_orderpriority").alias("condition")).distinct()


#: Measures of the snapshots below; the second source has the first two.
MEASURES = ("m1", "m2", "m3", "m4", "m5")


def snapshot_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: key (city_id, observed_at), five measures (some null), n to perturb by."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("city_id"), F.to_date("o_orderdate").alias("observed_at"), F.col("o_orderkey").alias("n"),
        cents.alias("m1"), F.when(F.col("o_orderkey") % 17 != 0, (cents % 1000).cast("double")).alias("m2"),
        (cents % 97).alias("m3"), F.length("o_orderpriority").cast("long").alias("m4"), (F.col("o_orderkey") % 5).alias("m5"),
    )


def previous_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was kept before: without every 11th row, one row a key."""
    base = snapshot_base(spark, sf_dir).filter("n % 11 <> 0")
    return base.groupBy("city_id", "observed_at").agg(F.max_by(F.struct(*MEASURES), "n").alias("m")).select("city_id", "observed_at", "m.*", F.lit(1).alias("extracted_at"))


def incoming_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What comes in: without every 5th row, every 7th changed, every 13th sent twice, the second time later and changed."""
    base = snapshot_base(spark, sf_dir).filter("n % 5 <> 0").withColumn("m1", F.when(F.col("n") % 7 == 0, F.col("m1") + 1).otherwise(F.col("m1")))
    first = base.withColumn("extracted_at", F.lit(2))
    again = base.filter("n % 13 = 0").withColumn("m3", F.col("m3") + 1).withColumn("extracted_at", F.lit(3))
    return first.unionByName(again).select("city_id", "observed_at", *MEASURES, "extracted_at")
