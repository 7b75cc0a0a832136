"""One hot rule, city or group is many tasks, with the results of the plain forms."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import marts

T0 = datetime.datetime(2030, 1, 1)
HOUR = datetime.timedelta(hours=1)


@pytest.fixture
def plain_shuffles(spark):
    """Partitions as they are dealt: none are put together at run time."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def largest_share(df):
    """Of all rows, those in the largest partition."""
    # all columns are asked for, so that no window is left out of the plan
    counts = [r.n for r in df.select(F.spark_partition_id().alias("p"), F.xxhash64(*df.columns).alias("h")).groupBy("p").agg(F.count("*").alias("n"), F.max("h")).collect()]
    return max(counts) / sum(counts)


def hours_of(rng, n, gaps):
    return [T0 + i * HOUR for i in range(n) if rng.random() > gaps]


def windowed_streaks(df):
    by_time = Window.partitionBy(*marts.RULE).orderBy("observed_at")
    gap = F.timestamp_diff("HOUR", F.date_trunc("hour", F.lag("observed_at").over(by_time)), F.date_trunc("hour", "observed_at"))
    new = (~F.col("is_breach") | F.coalesce(gap != 1, F.lit(True))).cast("int")
    return df.withColumn("n", new).withColumn("streak_group", F.sum("n").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("n")


@pytest.mark.parametrize(("seed", "segment"), [(1, 24), (2, 7), (3, 1), (4, marts.SEGMENT_HOURS)])
def test_streaks_by_segments_are_those_of_one_window(spark, plain_shuffles, seed, segment):
    rng = random.Random(seed)
    rows = [("v", r, c, t, rng.random() < p) for r, c, p, gaps in (("r1", "x", 0.9, 0.0), ("r1", "y", 0.5, 0.3), ("r2", "x", 1.0, 0.02), ("r2", "y", 0.0, 0.0)) for t in hours_of(rng, 400, gaps)]
    df = spark.createDataFrame(rows, "ruleset_version string, rule_id string, city_id string, observed_at timestamp_ntz, is_breach boolean")
    found = marts.streaks(df, segment_hours=segment)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, windowed_streaks(df).collect()))


def test_one_hot_rule_and_city_is_many_tasks(spark, plain_shuffles):
    df = spark.range(24 * 100).select(F.lit("v").alias("ruleset_version"), F.lit("r").alias("rule_id"), F.lit("x").alias("city_id"), (F.lit(T0) + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz").alias("observed_at"), (F.col("id") % 50 != 0).alias("is_breach"))
    found = marts.streaks(df, segment_hours=24)
    assert largest_share(found) < 0.5 and largest_share(windowed_streaks(df)) == 1
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, windowed_streaks(df).collect()))


@pytest.mark.parametrize("segment", [24, 48, marts.SEGMENT_HOURS])
def test_rolling_means_cross_segments(spark, plain_shuffles, segment):
    rng = random.Random(segment)
    rows = [(c, t, float(rng.randint(0, 40)), float(rng.randint(0, 99))) for c in "xy" for t in hours_of(rng, 300, 0.2)]
    df = spark.createDataFrame(rows, "city_id string, observed_at timestamp_ntz, t double, pm2_5 double")
    weather = df.select("city_id", "observed_at", F.col("t").alias("apparent_temperature"), (F.col("t") / 3).alias("temperature_2m"), F.col("t").alias("precipitation"), F.lit(1.0).alias("relative_humidity"), F.lit(1.0).alias("wind_speed"))
    found = marts.conditions(weather, df.select("city_id", "observed_at", "pm2_5", F.lit(1.0).alias("pm10")), df.select("city_id").distinct(), "2030-01-02 05:00:00", segment)
    kept = [r for r in rows if r[1] >= datetime.datetime(2030, 1, 2, 5)]
    wanted = {}
    for c, t, v, _ in kept:
        last = [p for c2, t2, _, p in kept if c2 == c and t - 23 * HOUR <= t2 <= t]
        day = [v2 for c2, t2, v2, _ in kept if c2 == c and t2.date() == t.date()]
        wanted[c, t] = (round(sum(last) / len(last), 6), round(sum(day), 6), min(day) / 3, max(day) / 3)
    assert {(r.city_id, r.observed_at): (r.pm2_5_rolling_24h, r.daily_precipitation_sum, r.daily_min_temperature, r.daily_max_temperature) for r in found.collect()} == wanted
    if segment == 24:
        assert largest_share(found.filter("city_id = 'x'")) < 0.7


def test_segments_are_whole_days(spark):
    with pytest.raises(ValueError, match="whole days"):
        marts.conditions(None, None, None, "", 25)


def exposure_frames(spark):
    members = spark.range(4000).select(F.col("id").alias("member_id"), F.when(F.col("id") % 50 == 0, "y").otherwise("x").alias("city_id"), F.lit("60+").alias("age_band"), F.lit("app").alias("preferred_channel"), (F.col("id") % 3 > 0).alias("outreach_consent"))
    links = members.select("member_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("condition"))
    daily = spark.range(6).select(F.lit("v").alias("ruleset_version"), F.lit("r").alias("rule_id"), F.when(F.col("id") == 5, "y").otherwise("x").alias("city_id"), F.lit("high").alias("severity"), F.col("id").alias("decision_date"))
    relevance = spark.createDataFrame([("v", "r", "a", "high"), ("v", "r", "b", "low"), ("v", "q", "a", "low")], "ruleset_version string, rule_id string, condition string, relevance string")
    return members, links, daily, relevance


def test_exposure_of_a_hot_city_is_many_tasks(spark, plain_shuffles):
    frames = exposure_frames(spark)
    lists, salted = marts.member_exposure(*frames), marts.member_exposure(*frames, most=0, salts=16)
    assert sorted(map(str, lists.collect())) == sorted(map(str, salted.select(*lists.columns).collect())) and lists.count() == 5 * 3920 + 80
    assert largest_share(lists) < 0.4 and largest_share(salted) < 0.5
    assert marts.member_exposure(frames[0], frames[1], frames[2].limit(0), frames[3]).count() == 0


def test_alerts_of_factors_are_those_of_the_queue(spark):
    members, links, daily, relevance = exposure_frames(spark)
    days = daily.withColumns({"window_start": F.col("decision_date"), "window_end": F.col("decision_date") + 1, "observed_persistence_hours": F.lit(3)})
    days = days.withColumns({c: F.lit(c) for c in ("signal_name", "action_timing", "trigger_explanation")})
    days = days.unionByName(days.withColumn("severity", F.lit("low"))).unionByName(days.filter("decision_date = 2"))
    relevance = relevance.filter("condition = 'b'")
    people = marts.matched_members(members.withColumn("age_band", F.when(F.col("member_id") % 2 == 0, "60+").otherwise("18-39")), links, relevance)
    wanted = marts.stakeholder_alerts(marts.outreach_queue(marts.exposed_members(people, days, True)))
    found = marts.alerts_of_factors(people, days)
    assert sorted(map(str, found.select(*wanted.columns).collect())) == sorted(map(str, wanted.collect())) and found.count() == 12
    assert {r.high_priority_members > 0 for r in found.collect()} == {True, False}


def test_counts_by_member_shuffle_no_rows_of_exposure(spark):
    from vigil.operators import quality
    from vigil.plans import risk

    d = "/root/testdata/sf0.001"
    exposure, queue = (df.select(*quality.MEMBER_KEY) for df in (risk.exposed(spark, d), risk.queue(spark, d)))
    counts = exposure.unionByName(queue).unionByName(queue.filter("member_id % 9 = 2")).groupBy(*quality.MEMBER_KEY).count()
    plan = counts._jdf.queryExecution().sparkPlan().toString() + counts._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(member_id" in plan and "hashpartitioning(decision_date" not in plan
    assert counts.count() == exposure.count()
