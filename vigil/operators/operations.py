"""Operational tables as append-only events, and what is read from them; retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_rows(events: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest event of each key, which replaces those before."""
    window = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return events.withColumn("__n", F.row_number().over(window)).filter("__n = 1").drop("__n")


def advanced_marks(successes: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """H3: previous and resulting mark of each successful key; a mark never goes back."""
    joined = successes.select(*keys, F.col("mark").alias("seen")).join(marks.select(*keys, F.col("mark").alias("previous_mark")), list(keys), "left")
    return joined.select(*keys, "previous_mark", F.greatest("seen", "previous_mark").alias("resulting_mark"), (F.col("previous_mark").isNull() | (F.col("seen") > F.col("previous_mark"))).alias("advanced"))


def of_run(rows: DataFrame, run_id: str) -> DataFrame:
    """H6: what was recorded of one run."""
    return rows.filter(F.col("run_id") == run_id)


def stages(events: DataFrame) -> DataFrame:
    """Per run and stage the last status, the first and last time, and the number of events."""
    return events.groupBy("run_id", F.col("source").alias("stage")).agg(
        F.max_by("status", F.struct("event_time", "event_id")).alias("status"), F.min("event_time").alias("started_at"), F.max("event_time").alias("ended_at"), F.count("*").alias("events"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """H8: the newest published snapshot; no row if none is."""
    return snapshots.filter("published").agg(F.max("snapshot_id").alias("snapshot_id")).filter("snapshot_id IS NOT NULL")


def replaced(kept: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Kept rows, those with the key of an incoming one replaced by it."""
    return kept.join(incoming.select(*keys).distinct(), list(keys), "left_anti").unionByName(incoming)


def latest_published_run(runs: DataFrame) -> DataFrame:
    """H4: the newest run that is published, with its status."""
    return runs.filter("published AND status IN ('success', 'partial_success')").orderBy(F.desc("run_id")).limit(1)


def of_latest_run(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """H5: the rows of the newest run."""
    return rows.join(F.broadcast(runs.agg(F.max("run_id").alias("run_id"))), "run_id", "left_semi")  # one row


def upstream(edges: DataFrame) -> DataFrame:
    """Distinct artifacts that each run's artifacts come from."""
    return edges.select("run_id", "upstream").distinct()


EDGE = ("upstream_id", "artifact_id", "kind")


def lineage(artifacts: DataFrame, runs: DataFrame) -> DataFrame:
    """(upstream_id, artifact_id, kind) between artifacts.

    artifacts has artifact_id, run_id, artifact_type, dataset_name, source, city_id
    and reused_from_run_id; runs has run_id and member_snapshot_id. reused_from: the
    same source and city of the run whose bytes an artifact shares; compacted_from:
    the city snapshots of its run and source; derived_from: for a processed dataset
    what run_upstream() has for its run.
    """
    named = artifacts.select(F.col("artifact_id").alias("upstream_id"), F.col("run_id").alias("reused_from_run_id"), "source", "city_id")
    reused = artifacts.filter("reused_from_run_id IS NOT NULL").join(named, ["reused_from_run_id", "source", "city_id"]).withColumn("kind", F.lit("reused_from"))
    cities = artifacts.filter("artifact_type = 'city_snapshot'").select(F.col("artifact_id").alias("upstream_id"), "run_id", "source")
    compacted = artifacts.filter("artifact_type = 'compacted_source_snapshot'").join(cities, ["run_id", "source"]).withColumn("kind", F.lit("compacted_from"))
    derived = artifacts.filter("artifact_type = 'processed_dataset'").join(run_upstream(artifacts, runs), "run_id").withColumn("kind", F.lit("derived_from"))
    return reused.select(*EDGE).unionByName(compacted.select(*EDGE)).unionByName(derived.select(*EDGE)).distinct()


def run_upstream(artifacts: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, upstream_id): the compacted sources of each run, and the reference snapshot that it names; a pair once."""
    compacted = artifacts.filter("artifact_type = 'compacted_source_snapshot'").select("run_id", F.col("artifact_id").alias("upstream_id"))
    reference = artifacts.filter("artifact_type = 'reference_snapshot'").select(F.col("dataset_name").alias("member_snapshot_id"), F.col("artifact_id").alias("upstream_id"))
    return compacted.unionByName(runs.join(reference, "member_snapshot_id").select("run_id", "upstream_id")).distinct()


def run_totals(state: DataFrame) -> DataFrame:
    """Sums per run; valid rows are those extracted less rejected ones that no failed source explains."""
    sums = state.groupBy("run_id").agg(F.sum("extracted").alias("extracted"), F.sum("inserted").alias("inserted"), F.sum("rejected").alias("rejected"), F.count_if(F.col("status") == "failed").alias("failed"))
    return sums.withColumn("valid", F.col("extracted") - F.greatest(F.lit(0), F.col("rejected") - F.col("failed")))


def life_cycle(events: DataFrame) -> DataFrame:
    """The last status of each run; it is published if that is a success of some kind."""
    last = events.groupBy("run_id").agg(F.max_by("status", F.struct("event_time", "event_id")).alias("status"), F.min("event_time").alias("started_at"), F.max("event_time").alias("ended_at"))
    return last.withColumn("published", F.col("status").isin("success", "partial_success"))


def beyond_newest(runs: DataFrame, keep: int) -> DataFrame:
    """All but the newest runs; the window runs over one row per run."""
    ids = runs.select("run_id").distinct()
    return ids.withColumn("__n", F.row_number().over(Window.orderBy(F.desc("run_id")))).filter(F.col("__n") > keep).select("run_id")


def older_than(runs: DataFrame, now: str, days: int) -> DataFrame:
    """Runs whose id tells a time more than days before now; ids that tell none are kept."""
    at = F.try_to_timestamp(F.col("run_id"), F.lit("yyyyMMdd'T'HHmmss'Z'"))
    return runs.filter(at < F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")).select("run_id")


def removable(snapshots: DataFrame, runs: DataFrame, keep: int) -> DataFrame:
    """Snapshots but the newest ones and those that published runs name."""
    named = runs.filter("published").select("snapshot_id").distinct()
    ids = snapshots.select("snapshot_id").distinct()
    old = ids.withColumn("__n", F.row_number().over(Window.orderBy(F.desc("snapshot_id")))).filter(F.col("__n") > keep).select("snapshot_id")
    return old.join(named, "snapshot_id", "left_anti")


def missing_history(cities: DataFrame, partitions: DataFrame) -> DataFrame:
    """Cities without a partition."""
    return cities.join(partitions.select("city_id").distinct(), "city_id", "left_anti")
