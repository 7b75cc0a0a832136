"""Reference data, operational tables, payloads and retention over the given tables, as named queries with their SQL."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.operators import operations, quality, reference, snapshots
from vigil.plans.sql import sql
from vigil.sources import adapters, payloads, stages, storage, versions
from vigil.sources.adapters import table

KEY = ["run_id", "source", "city_id"]
NOW, RUN = "2001-07-15 00:00:00", "199905"


def state_events(s: SparkSession, d: str) -> DataFrame:
    """Orders as state events of sources (priorities) and cities (regions) in runs (months)."""
    orders = table(s, d, "orders").join(adapters.customers(s, d).select("c_custkey", "city_id"), F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        F.date_format("o_orderdate", "yyyyMM").alias("run_id"), F.col("o_orderpriority").alias("source"), "city_id", F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("status"),
        F.to_date("o_orderdate").alias("event_time"), F.col("o_orderkey").alias("event_id"), F.round("o_totalprice").cast("long").alias("extracted"), (F.col("o_orderkey") % 100).alias("inserted"), (F.col("o_orderkey") % 3).alias("rejected"),
        (F.col("o_orderkey") % 1000).alias("mark"))


def state(s: SparkSession, d: str) -> DataFrame:
    return operations.latest_rows(state_events(s, d), KEY, ("event_time", "event_id"))


def run_life(s: SparkSession, d: str) -> DataFrame:
    return operations.life_cycle(state_events(s, d))


def marks(s: SparkSession, d: str) -> DataFrame:
    return operations.latest_rows(state_events(s, d).filter("status = 'success' AND run_id < '200001'"), ("source", "city_id"), ("event_time", "event_id"))


def incoming_members(s: SparkSession, d: str) -> DataFrame:
    """Customers without every 11th; every 7th has moved on."""
    moved = F.when(F.col("member_id") % 7 == 0, "ASIA").otherwise(F.col("city_id"))
    return adapters.members(s, d).filter("member_id % 11 <> 0").withColumn("city_id", moved).select("member_id", "city_id", "age_band")


def current_members(s: SparkSession, d: str) -> DataFrame:
    """Customers without every 13th; every 5th is inactive."""
    return adapters.members(s, d).filter("member_id % 13 <> 0").select("member_id", "city_id", "age_band", (F.col("member_id") % 5 != 0).alias("active"))


def members(s: SparkSession, d: str) -> DataFrame:
    return reference.reconciled(incoming_members(s, d), current_members(s, d), "member_id")


def old_links(s: SparkSession, d: str) -> DataFrame:
    return adapters.member_conditions(s, d).filter("NOT (member_id % 9 = 0 AND condition = '1-URGENT')")


def bad_links(s: SparkSession, d: str) -> DataFrame:
    links = table(s, d, "orders").select(F.col("o_custkey").alias("member_id"), F.col("o_orderpriority").alias("condition"))
    return links


def manifest(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    ours = adapters.members(s, d).select("member_id", "city_id", "age_band")
    now = snapshots.content_hash(ours, (), ("city_id",))
    recorded = snapshots.content_hash(ours.withColumn("age_band", F.when((F.col("city_id") == "ASIA") & (F.col("member_id") == 1), "60+").otherwise(F.col("age_band"))).filter("city_id <> 'EUROPE' OR member_id % 2 = 0"), (), ("city_id",))
    return now, recorded


def hourly_payload(s: SparkSession, d: str) -> DataFrame:
    """A user's events as one payload of parallel arrays, and back to rows."""
    rows = table(s, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("t"), "value", F.get_json_object("props", "$.k").cast("double").alias("k")))).alias("r"))
    body = payloads.to_text(F.col("r.t").alias("time"), F.col("r.value").alias("value"), F.col("r.k").alias("k"))
    return payloads.hourly_rows(rows.select("user_id", body.alias("body")), ("user_id",), "body", ("value", "k"))


def daily_payload(s: SparkSession, d: str) -> DataFrame:
    """A city's history as three maps of day to value, the last of which lacks some days, and back to rows."""
    days = adapters.daily_history(s, d).withColumn("day", F.date_format("observed_date", "yyyyMMdd"))
    maps = [F.map_from_entries(F.collect_list(F.when(keep, F.struct("day", c)))).alias(k) for k, c, keep in (
        ("hi", "temperature_2m", F.lit(True)), ("lo", "minimum_temperature_2m", F.lit(True)), ("sum", "precipitation", F.dayofmonth("observed_date") != 7))]
    body = days.groupBy("city_id", F.year("observed_date").alias("year")).agg(*maps).select("city_id", "year", payloads.to_text("hi", "lo", "sum").alias("body"))
    return payloads.daily_rows(body, ("city_id", "year"), "body", {"hi": "temperature_2m", "lo": "minimum_temperature_2m", "sum": "precipitation"}).select("city_id", "day", "temperature_2m", "minimum_temperature_2m", F.coalesce("precipitation", F.lit(-999.0)).alias("precipitation"))


def run_ids(s: SparkSession, d: str) -> DataFrame:
    """Order days as run ids; every 10th order's tells no time."""
    return table(s, d, "orders").select(F.when(F.col("o_orderkey") % 10 == 0, "latest").otherwise(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'")).alias("run_id")).distinct()


def snapshot_runs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("snapshot_id"), (F.col("o_orderkey") % 500 == 0).alias("published"))


def edges(s: SparkSession, d: str) -> DataFrame:
    return state_events(s, d).select("run_id", F.concat_ws("/", "source", "city_id").alias("upstream"))


def dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in names})


def results(s: SparkSession, d: str) -> DataFrame:
    """Per run, dataset (region) and check whether the state of its sources passes."""
    counts = state(s, d).groupBy("run_id", F.col("city_id").alias("dataset")).agg(F.count("*").alias("rows"), F.count_if(F.col("status") == "failed").alias("failed"), F.sum("rejected").alias("rejected"))
    tests = {"all_sources": (F.col("rows") >= 5, F.col("rows")), "no_failure": (F.col("failed") == 0, F.col("failed")), "few_rejected": (F.col("rejected") <= 5, F.col("rejected"))}
    return counts.select("run_id", F.explode(F.array(*(F.struct("dataset", F.lit(n).alias("check"), quality.status(ok).alias("status"), v.cast("string").alias("details")) for n, (ok, v) in tests.items()))).alias("r")).select("run_id", "r.*")


def replaced_state(s: SparkSession, d: str) -> DataFrame:
    """The state of two thirds of the events, replaced where the other third has the key, too."""
    parts = [operations.latest_rows(state_events(s, d).filter(f"event_id % 3 {test}"), KEY, ("event_time", "event_id")) for test in ("<> 0", "= 0")]
    return operations.replaced(*parts, KEY)


def lines(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def partitioned_files(s: SparkSession, d: str) -> DataFrame:
    """Lines written in folders of their flags, and a folder of one flag and all folders read again."""
    path, ours = storage.fresh_folder(s, "lines"), lines(s, d)
    storage.write(ours, path, ("l_returnflag",), refuse_empty=True)
    whole = storage.read(s, path, ours.schema).select(*ours.columns)
    one = storage.read(s, f"{path}/l_returnflag=R").withColumn("l_returnflag", F.lit("only R"))
    return whole.unionByName(one.select(*ours.columns))


def publications(s: SparkSession, d: str) -> str:
    """A folder with two published runs, one of them tried twice with other rows, one that failed, and one that died between its marts."""
    root, rows = storage.fresh_folder(s, "published"), lines(s, d).groupBy("l_returnflag").agg(F.count("*").alias("n"))
    for run_id, more, status in (("r1", 1, "success"), ("r2", 9, "partial_success"), ("r2", 2, "partial_success"), ("r3", 3, "failed"), ("r2", 7, "failed")):
        ours = rows.withColumn("n", F.col("n") + more)
        storage.publish({"counts": ours, "flags": ours.select("l_returnflag")}, root, run_id, status)
    with contextlib.suppress(PySparkException):
        storage.publish({"counts": rows, "flags": rows.withColumn("n", F.raise_error(F.lit("a mart that cannot be built")).cast("long"))}, root, "r1", "success")
    return root


def published_datasets(s: SparkSession, d: str) -> DataFrame:
    return storage.published_runs(s, publications(s, d)).select("run_id", "dataset", "rows", "status", "number")


def daily_facts(s: SparkSession, d: str) -> DataFrame:
    """A10: the facts of two runs, one after the other, as one history."""
    root, days = storage.fresh_folder(s, "history"), table(s, d, "orders").groupBy(F.to_date("o_orderdate").cast("string").alias("day")).agg(F.count("*").alias("n"))
    for run_id, test in (("r1", "n % 2 = 0"), ("r2", "n % 3 = 0")):
        storage.append_history({"facts": days.filter(test)}, root, run_id)
    return storage.read(s, f"{root}/facts", "day string, n long, run_id string")


def compacted_files(s: SparkSession, d: str) -> DataFrame:
    """Lines in many files, and in few that hold neighbouring keys."""
    path, ours = storage.fresh_folder(s, "many"), lines(s, d)
    storage.write(ours.repartition(16), path)
    storage.compact(s, path, f"{path}-few", ("l_orderkey", "l_linenumber"), 1_000_000)
    return storage.read(s, f"{path}-few", ours.schema)


BANDS = "member_id long, age_band string, city_id string"


def member_versions(s: SparkSession, d: str) -> str:
    """A folder with snapshots of customers by region. In the second all of ASIA have moved to AFRICA and some of EUROPE are
    older; the third is the second in another order; the fourth dies before its manifest is written."""
    root, ours = storage.fresh_folder(s, "members"), adapters.members(s, d).select("member_id", "age_band", "city_id")
    moved = ours.withColumns({"city_id": F.when(F.col("city_id") == "ASIA", "AFRICA").otherwise(F.col("city_id")), "age_band": F.when((F.col("city_id") == "EUROPE") & (F.col("member_id") % 2 == 0), "older").otherwise(F.col("age_band"))})
    for snapshot_id, df in (("m1", ours), ("m2", moved), ("m3", moved.orderBy(F.desc("member_id")))):
        versions.save(df, root, snapshot_id, "city_id")
    storage.write(ours.withColumn("age_band", F.lit("unseen")), f"{root}/data/folder=sleft", ("city_id",))
    return root


def rewritten_partitions(s: SparkSession, d: str) -> DataFrame:
    """The newest snapshot of member_versions(), and the first."""
    root, schema = member_versions(s, d), StructType.fromDDL(BANDS)
    both = [versions.load(s, root, schema, "city_id", i).withColumn("snapshot_id", F.lit(i or "newest")) for i in (None, "m1")]
    return both[0].unionByName(both[1])


def partition_actions(s: SparkSession, d: str) -> DataFrame:
    return versions.manifest(s, member_versions(s, d)).select("snapshot_id", F.col("partition").alias("city_id"), "action", "rows")


def reused_snapshots(s: SparkSession, d: str) -> DataFrame:
    """Orders by region, saved as they are, fetched anew with another time, and with a row more; then what the manifest
    tells against what is there."""
    root = storage.fresh_folder(s, "orders")
    orders = table(s, d, "orders").join(adapters.customers(s, d).select("c_custkey", "city_id"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderstatus", "city_id", F.lit(1).alias("extracted_at"))
    later = orders.withColumn("extracted_at", F.lit(2))
    more = later.unionByName(later.filter("city_id = 'ASIA'").agg(F.max("o_orderkey").alias("o_orderkey")).selectExpr("o_orderkey", "'Z' as o_orderstatus", "'ASIA' as city_id", "2 as extracted_at"))
    written = [(i, versions.save(df, root, i, "city_id", ("extracted_at",))) for i, df in (("o1", orders), ("o2", later), ("o3", more))]
    saves = s.createDataFrame(written, "snapshot_id string, written boolean")  # three rows
    counts = versions.manifest(s, root).groupBy("snapshot_id").agg(F.count_if(F.col("action") == "carried").alias("carried"), F.count_if(F.col("action") == "rebuilt").alias("rebuilt"), F.sum("rows").alias("rows"))
    wrong = versions.mismatches(s, root, orders.schema, "city_id", ("extracted_at",)).agg(F.count("*").alias("mismatches"))
    return saves.join(counts, "snapshot_id", "left").crossJoin(wrong)


def artifacts(s: SparkSession, d: str) -> DataFrame:
    """Orders as artifacts: a snapshot for each month, priority and region, compacted ones for each month and priority, processed
    datasets for each month and status; a month's snapshot is the month's before where both have as many orders."""
    orders = state_events(s, d)
    cities = orders.groupBy("run_id", "source", "city_id").agg(F.count("*").alias("n"))
    compacted = orders.groupBy("run_id", "source").agg(F.count("*").alias("n")).withColumn("city_id", F.lit("__all__"))
    before = Window.partitionBy("source", "city_id").orderBy("run_id")
    raw = cities.withColumn("artifact_type", F.lit("city_snapshot")).unionByName(compacted.withColumn("artifact_type", F.lit("compacted_source_snapshot")))
    raw = raw.withColumn("reused_from_run_id", F.when(F.lag("n").over(before) == F.col("n"), F.lag("run_id").over(before)))
    raw = raw.select(F.concat_ws(":", F.lit("raw"), "run_id", "source", "city_id").alias("artifact_id"), "run_id", "artifact_type", F.col("source").alias("dataset_name"), "source", "city_id", "reused_from_run_id")
    none = F.lit(None).cast("string")
    processed = orders.select("run_id", F.col("status").alias("dataset_name")).distinct().select(F.concat_ws(":", F.lit("processed"), "run_id", "dataset_name").alias("artifact_id"), "run_id", F.lit("processed_dataset").alias("artifact_type"), "dataset_name", none.alias("source"), none.alias("city_id"), none.alias("reused_from_run_id"))
    reference_ = orders.select(F.substring("run_id", 1, 4).alias("dataset_name")).distinct().filter("dataset_name <> '1999'").select(F.concat(F.lit("reference:"), "dataset_name").alias("artifact_id"), none.alias("run_id"), F.lit("reference_snapshot").alias("artifact_type"), "dataset_name", none.alias("source"), none.alias("city_id"), none.alias("reused_from_run_id"))
    return raw.unionByName(processed).unionByName(reference_)


def member_runs(s: SparkSession, d: str) -> DataFrame:
    """The runs, each with its year's member snapshot."""
    return state_events(s, d).select("run_id", F.substring("run_id", 1, 4).alias("member_snapshot_id")).distinct()


def observed_stages(s: SparkSession, d: str) -> DataFrame:
    """Three stages over lines and orders, of which the last fails and is tried again, to fail again."""
    root = storage.fresh_folder(s, "stages")
    log = f"{root}/log"
    clean = stages.run_stage(log, "r1", "clean", [lines(s, d)], lambda x: x.filter("l_quantity >= 10"), f"{root}/clean")
    orders = table(s, d, "orders").select("o_orderkey", "o_orderpriority")
    sums = stages.run_stage(log, "r1", "sums", [clean, orders], lambda x, y: x.join(y, x["l_orderkey"] == y["o_orderkey"]).groupBy("o_orderpriority", "l_returnflag").agg(F.sum("l_quantity").alias("quantity")), f"{root}/sums")
    known = stages.stage_metrics(s, log).filter("stage = 'sums'").first()["output_rows"]
    for _ in range(2):
        with contextlib.suppress(PySparkException):
            stages.run_stage(log, "r1", "report", [sums], lambda x: x.withColumn("quantity", F.raise_error(F.lit("no report today"))), f"{root}/report", known_rows=known)
    return stages.stage_metrics(s, log).select("run_id", "stage", "number", "status", "input_rows", "output_rows", (F.col("milliseconds") > 0).alias("timed"), F.contains("error", F.lit("no report today")).alias("told"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "a7_hourly_payload": hourly_payload,
    "a8_daily_payload": daily_payload,
    "a12_row_counts": lambda s, d: table(s, d, "lineitem").groupBy(F.col("l_returnflag").alias("dataset")).agg(F.count("*").alias("rows")),
    "a13_beyond_newest": lambda s, d: operations.beyond_newest(run_ids(s, d).filter("run_id <> 'latest'"), 5),
    "a14_older_than": lambda s, d: operations.older_than(run_ids(s, d), NOW, 90),
    "a15_removable_snapshots": lambda s, d: operations.removable(snapshot_runs(s, d), snapshot_runs(s, d), 10),
    "a17_missing_history": lambda s, d: operations.missing_history(adapters.members(s, d).select(F.col("member_id").alias("city_id")), table(s, d, "orders").filter("year(o_orderdate) = 2000").select(F.col("o_custkey").alias("city_id"))),
    "c10_member_actions": lambda s, d: reference.action_counts(members(s, d)),
    "c10_changed_cities": lambda s, d: reference.changed_cities(members(s, d)),
    "c11_condition_changes": lambda s, d: reference.condition_changes(adapters.member_conditions(s, d), old_links(s, d)),
    "c12_next_state": lambda s, d: reference.next_state(members(s, d), "member_id"),
    "c13_current_conditions": lambda s, d: reference.current_conditions(reference.next_state(members(s, d), "member_id"), adapters.member_conditions(s, d), "member_id"),
    "c14_reference_integrity": lambda s, d: reference.integrity_violations(incoming_members(s, d), bad_links(s, d)).groupBy("violation").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")),
    "c15_manifest_mismatches": lambda s, d: reference.manifest_mismatches(*manifest(s, d), "city_id"),
    "c16_version_id": lambda s, d: reference.version_id(table(s, d, "part").select("p_partkey", "p_size", "p_brand"), 12),
    "h1_source_state": lambda s, d: dates(state(s, d), "event_time"),
    "h2_high_water_marks": lambda s, d: marks(s, d).select("source", "city_id", "mark", F.col("event_time").cast("string").alias("event_time")),
    "h3_advanced_marks": lambda s, d: operations.advanced_marks(state(s, d).filter("status = 'success' AND run_id = '200001'"), marks(s, d), ("source", "city_id")),
    "h4_latest_published_run": lambda s, d: operations.latest_published_run(run_life(s, d)).select("run_id", "status"),
    "h5_latest_run_health": lambda s, d: operations.of_latest_run(state(s, d), run_life(s, d)).select("source", "city_id", "status"),
    "h7_failed_targets": lambda s, d: state(s, d).filter("run_id = '199905' AND status = 'failed'").select("source", "city_id"),
    "h8_protected_snapshots": lambda s, d: snapshot_runs(s, d).filter("published").select("snapshot_id").distinct(),
    "h9_latest_manifests": lambda s, d: dates(operations.latest_rows(state_events(s, d), ("source", "city_id"), ("event_time", "event_id")).select("source", "city_id", "run_id", "event_time"), "event_time"),
    "h10_upstream_artifacts": lambda s, d: operations.upstream(edges(s, d)),
    "h11_run_totals": lambda s, d: operations.run_totals(state(s, d)),
    "h6_run_readiness": lambda s, d: dates(operations.of_run(state(s, d), RUN).select("source", "city_id", "status", "extracted", "inserted", "rejected", "event_time"), "event_time"),
    "h6_run_results": lambda s, d: operations.of_run(results(s, d), RUN).drop("run_id"),
    "h6_run_stages": lambda s, d: dates(operations.of_run(operations.stages(state_events(s, d)), RUN).drop("run_id"), "started_at", "ended_at"),
    "h8_latest_member_snapshot": lambda s, d: operations.latest_snapshot(snapshot_runs(s, d)),
    "h12_stage_metrics": lambda s, d: operations.stages(state_events(s, d)).select("run_id", "stage", "status", "events", F.datediff("ended_at", "started_at").alias("days")),
    "h14_replaced_state": lambda s, d: replaced_state(s, d).select(*KEY, "event_id", "status", "extracted"),
    "a1_partitioned_files": partitioned_files,
    "a9_published_runs": lambda s, d: storage.published(s, publications(s, d), "counts"),
    "a9_published_datasets": published_datasets,
    "a16_partition_actions": partition_actions,
    "c7_reused_snapshots": reused_snapshots,
    "h10_lineage_edges": lambda s, d: operations.lineage(artifacts(s, d), member_runs(s, d)),
    "h10_run_upstream": lambda s, d: operations.run_upstream(artifacts(s, d), member_runs(s, d)),
    "h12_observed_stages": observed_stages,
    "a10_daily_history": daily_facts,
    "a11_compacted_files": compacted_files,
    "a16_rewritten_partitions": rewritten_partitions,
    "h13_latest_times": lambda s, d: state_events(s, d).groupBy("source", "city_id").agg(F.max("event_time").cast("string").alias("latest")),
    "h15_run_life_cycle": lambda s, d: dates(run_life(s, d), "started_at", "ended_at"),
}
EVENTS = """, ev AS (SELECT strftime(o_orderdate, '%Y%m') AS run_id, o_orderpriority AS source, city_id, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'success' END AS status, o_orderdate::DATE AS event_time, o_orderkey AS event_id,
    round(o_totalprice)::BIGINT AS extracted, o_orderkey % 100 AS inserted, o_orderkey % 3 AS rejected, o_orderkey % 1000 AS mark FROM orders JOIN customers ON o_custkey = c_custkey),
  st AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY run_id, source, city_id ORDER BY event_time DESC, event_id DESC) AS n FROM ev) WHERE n = 1),
  mk AS (SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY source, city_id ORDER BY event_time DESC, event_id DESC) AS n FROM ev WHERE status = 'success' AND run_id < '200001') WHERE n = 1),
  life AS (SELECT run_id, max_by(status, (event_time, event_id)) AS status, min(event_time) AS started_at, max(event_time) AS ended_at FROM ev GROUP BY run_id)
"""
STATE = """, inc AS (SELECT member_id, CASE WHEN member_id % 7 = 0 THEN 'ASIA' ELSE city_id END AS city_id, age_band FROM members WHERE member_id % 11 <> 0),
  cur AS (SELECT member_id, city_id, age_band, member_id % 5 <> 0 AS active FROM members WHERE member_id % 13 <> 0),
  act AS (SELECT member_id, i.city_id AS new_city, c.city_id AS old_city, coalesce(i.age_band, c.age_band) AS age_band, i.city_id IS NOT NULL AS active,
    CASE WHEN c.city_id IS NULL THEN 'inserted' WHEN i.city_id IS NULL THEN CASE WHEN c.active THEN 'deactivated' END WHEN i.city_id <> c.city_id OR i.age_band <> c.age_band OR NOT c.active THEN 'updated' ELSE 'unchanged' END AS action FROM inc i FULL JOIN cur c USING (member_id))
"""
RUN_IDS = "(SELECT DISTINCT CASE WHEN o_orderkey % 10 = 0 THEN 'latest' ELSE strftime(o_orderdate, '%Y%m%dT%H%M%SZ') END AS run_id FROM orders)"
ARTIFACTS = """, cnt AS (SELECT run_id, source, city_id, 'city_snapshot' AS kind, count(*) AS n FROM ev GROUP BY ALL UNION ALL SELECT run_id, source, '__all__', 'compacted_source_snapshot', count(*) FROM ev GROUP BY ALL),
  raw AS (SELECT *, 'raw:' || run_id || ':' || source || ':' || city_id AS id, lag(run_id) OVER w AS earlier, lag(n) OVER w = n AS reused FROM cnt WINDOW w AS (PARTITION BY source, city_id ORDER BY run_id)),
  up AS (SELECT run_id, id AS upstream_id FROM raw WHERE kind = 'compacted_source_snapshot' UNION SELECT run_id, 'reference:' || run_id[1:4] FROM ev WHERE run_id[1:4] <> '1999')
"""
GROWN = """, m2 AS (SELECT member_id, CASE WHEN city_id = 'EUROPE' AND member_id % 2 = 0 THEN 'older' ELSE age_band END AS age_band, CASE city_id WHEN 'ASIA' THEN 'AFRICA' ELSE city_id END AS city_id FROM members)
"""
SQL: dict[str, str] = {
    "a7_hourly_payload": "SELECT user_id, strftime(ts, '%Y-%m-%dT%H:%M') AS time, value, json_extract_string(props, '$.k')::DOUBLE AS k FROM events",
    "a8_daily_payload": sql("SELECT city_id, strftime(observed_date, '%Y%m%d') AS day, temperature_2m, minimum_temperature_2m, CASE WHEN day(observed_date) = 7 THEN -999.0::DOUBLE ELSE precipitation END AS precipitation FROM history", "history"),
    "a12_row_counts": "SELECT l_returnflag AS dataset, count(*) AS rows FROM lineitem GROUP BY 1",
    "a13_beyond_newest": f"SELECT run_id FROM {RUN_IDS} WHERE run_id <> 'latest' ORDER BY run_id DESC OFFSET 5",
    "a14_older_than": f"SELECT run_id FROM {RUN_IDS} WHERE try_strptime(run_id, '%Y%m%dT%H%M%SZ') < TIMESTAMP '{NOW}' - INTERVAL 90 DAY",
    "a15_removable_snapshots": "SELECT snapshot_id FROM (SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS snapshot_id FROM orders ORDER BY 1 DESC OFFSET 10) WHERE snapshot_id NOT IN (SELECT strftime(o_orderdate, '%Y%m%d') FROM orders WHERE o_orderkey % 500 = 0)",
    "a17_missing_history": "SELECT c_custkey AS city_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000)",
    "c10_member_actions": sql(STATE + "SELECT action, count(*) AS members FROM act WHERE action IS NOT NULL GROUP BY action", "members"),
    "c10_changed_cities": sql(STATE + "SELECT DISTINCT c AS city_id FROM (SELECT unnest([new_city, old_city]) AS c FROM act WHERE action IN ('inserted', 'updated', 'deactivated')) WHERE c IS NOT NULL", "members"),
    "c11_condition_changes": sql("SELECT DISTINCT member_id FROM links WHERE member_id % 9 = 0 AND condition = '1-URGENT'", "links"),
    "c12_next_state": sql(STATE + "SELECT member_id, coalesce(new_city, old_city) AS city_id, age_band, active FROM act", "members"),
    "c13_current_conditions": sql(STATE + "SELECT member_id, condition FROM links WHERE member_id IN (SELECT member_id FROM act WHERE active)", "members", "links"),
    "c14_reference_integrity": """WITH l AS (SELECT o_custkey AS member_id, o_orderpriority AS condition FROM orders) SELECT violation, count(*) AS n, count(DISTINCT member_id) AS ids FROM (
      SELECT 'orphan_link' AS violation, member_id FROM l WHERE member_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 11 <> 0) UNION ALL SELECT 'repeated_link', member_id FROM l GROUP BY member_id, condition HAVING count(*) > 1) GROUP BY violation""",
    "c15_manifest_mismatches": sql("SELECT DISTINCT city_id FROM members WHERE city_id = 'EUROPE' AND member_id % 2 <> 0 UNION SELECT city_id FROM members WHERE city_id = 'ASIA' AND member_id = 1 AND age_band <> '60+'", "members"),
    "c16_version_id": "SELECT substr(sha256(n || ':' || h), 1, 12) AS version_id FROM (SELECT count(*) AS n, sum(('0x' || substr(md5(concat_ws(chr(31), p_brand, p_partkey::VARCHAR, p_size::VARCHAR)), 1, 15))::BIGINT)::HUGEINT::VARCHAR AS h FROM part)",
    "h1_source_state": sql(EVENTS + "SELECT * REPLACE (event_time::VARCHAR AS event_time) FROM st", "customers"),
    "h2_high_water_marks": sql(EVENTS + "SELECT source, city_id, mark, event_time::VARCHAR AS event_time FROM mk", "customers"),
    "h3_advanced_marks": sql(EVENTS + "SELECT s.source, s.city_id, m.mark AS previous_mark, greatest(s.mark, m.mark) AS resulting_mark, m.mark IS NULL OR s.mark > m.mark AS advanced FROM st s LEFT JOIN mk m ON m.source = s.source AND m.city_id = s.city_id WHERE s.status = 'success' AND s.run_id = '200001'", "customers"),
    "h4_latest_published_run": sql(EVENTS + "SELECT run_id, status FROM life WHERE status = 'success' ORDER BY run_id DESC LIMIT 1", "customers"),
    "h5_latest_run_health": sql(EVENTS + "SELECT source, city_id, status FROM st WHERE run_id = (SELECT max(run_id) FROM ev)", "customers"),
    "h7_failed_targets": sql(EVENTS + "SELECT source, city_id FROM st WHERE run_id = '199905' AND status = 'failed'", "customers"),
    "h8_protected_snapshots": "SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS snapshot_id FROM orders WHERE o_orderkey % 500 = 0",
    "h9_latest_manifests": sql(EVENTS + "SELECT source, city_id, max_by(run_id, (event_time, event_id)) AS run_id, max(event_time)::VARCHAR AS event_time FROM ev GROUP BY source, city_id", "customers"),
    "h10_upstream_artifacts": sql(EVENTS + "SELECT DISTINCT run_id, source || '/' || city_id AS upstream FROM ev", "customers"),
    "h11_run_totals": sql(EVENTS + "SELECT *, extracted - greatest(0, rejected - failed) AS valid FROM (SELECT run_id, sum(extracted)::BIGINT AS extracted, sum(inserted)::BIGINT AS inserted, sum(rejected)::BIGINT AS rejected, count(*) FILTER (WHERE status = 'failed') AS failed FROM st GROUP BY run_id)", "customers"),
    "h6_run_readiness": sql(EVENTS + f"SELECT source, city_id, status, extracted, inserted, rejected, event_time::VARCHAR AS event_time FROM st WHERE run_id = '{RUN}'", "customers"),
    "h6_run_results": sql(EVENTS + f""", k AS (SELECT city_id AS dataset, count(*) AS n, count(*) FILTER (WHERE status = 'failed') AS f, sum(rejected)::BIGINT AS r FROM st WHERE run_id = '{RUN}' GROUP BY city_id)
      SELECT dataset, "check", CASE WHEN ok THEN 'pass' ELSE 'fail' END AS status, details FROM (SELECT dataset, 'all_sources' AS "check", n >= 5 AS ok, n::VARCHAR AS details FROM k UNION ALL SELECT dataset, 'no_failure', f = 0, f::VARCHAR FROM k UNION ALL SELECT dataset, 'few_rejected', r <= 5, r::VARCHAR FROM k)""", "customers"),
    "h6_run_stages": sql(EVENTS + f"SELECT source AS stage, max_by(status, (event_time, event_id)) AS status, min(event_time)::VARCHAR AS started_at, max(event_time)::VARCHAR AS ended_at, count(*) AS events FROM ev WHERE run_id = '{RUN}' GROUP BY source", "customers"),
    "h8_latest_member_snapshot": "SELECT strftime(max(o_orderdate), '%Y%m%d') AS snapshot_id FROM orders WHERE o_orderkey % 500 = 0",
    "h12_stage_metrics": sql(EVENTS + "SELECT run_id, source AS stage, max_by(status, (event_time, event_id)) AS status, count(*) AS events, date_diff('day', min(event_time), max(event_time))::INT AS days FROM ev GROUP BY run_id, source", "customers"),
    "h14_replaced_state": sql(EVENTS + "SELECT run_id, source, city_id, event_id, status, extracted FROM (SELECT *, row_number() OVER (PARTITION BY run_id, source, city_id ORDER BY event_id % 3 = 0 DESC, event_time DESC, event_id DESC) AS k FROM ev) WHERE k = 1", "customers"),
    "a1_partitioned_files": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, 'only R' FROM lineitem WHERE l_returnflag = 'R'",
    "a9_published_runs": "SELECT l_returnflag, n + k AS n, 'r' || k AS run_id FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1), (VALUES (1), (2)) t(k)",
    "a9_published_datasets": "SELECT run_id, dataset, (SELECT count(DISTINCT l_returnflag) FROM lineitem) AS rows, status, number FROM (VALUES ('r1', 'success', 1), ('r2', 'partial_success', 2)) t(run_id, status, number), (VALUES ('counts'), ('flags')) u(dataset)",
    "a16_partition_actions": sql(GROWN + """SELECT 'm1' AS snapshot_id, city_id, 'rebuilt' AS action, count(*) AS rows FROM members GROUP BY city_id UNION ALL SELECT 'm2', 'ASIA', 'removed', 0
      UNION ALL SELECT 'm2', city_id, CASE WHEN city_id IN ('AFRICA', 'EUROPE') THEN 'rebuilt' ELSE 'carried' END, count(*) FROM m2 GROUP BY city_id""", "members"),
    "c7_reused_snapshots": sql("""SELECT snapshot_id, snapshot_id <> 'o2' AS written, CASE snapshot_id WHEN 'o1' THEN 0 WHEN 'o3' THEN regions - 1 END AS carried, CASE snapshot_id WHEN 'o1' THEN regions WHEN 'o3' THEN 1 END AS rebuilt,
      CASE snapshot_id WHEN 'o1' THEN n WHEN 'o3' THEN n + 1 END AS rows, 0 AS mismatches FROM (SELECT count(*) AS n, count(DISTINCT city_id) AS regions FROM orders JOIN customers ON o_custkey = c_custkey), (VALUES ('o1'), ('o2'), ('o3')) t(snapshot_id)""", "customers"),
    "h10_lineage_edges": sql(EVENTS + ARTIFACTS + """SELECT 'raw:' || earlier || ':' || source || ':' || city_id AS upstream_id, id AS artifact_id, 'reused_from' AS kind FROM raw WHERE reused
      UNION ALL SELECT c.id, a.id, 'compacted_from' FROM raw a JOIN raw c USING (run_id, source) WHERE a.city_id = '__all__' AND c.city_id <> '__all__'
      UNION ALL SELECT upstream_id, 'processed:' || run_id || ':' || status, 'derived_from' FROM (SELECT DISTINCT run_id, status FROM ev) JOIN up USING (run_id)""", "customers"),
    "h10_run_upstream": sql(EVENTS + ARTIFACTS + "SELECT run_id, upstream_id FROM up", "customers"),
    "h12_observed_stages": """WITH k AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity >= 10) AS c FROM lineitem), g AS (SELECT count(DISTINCT (o_orderpriority, l_returnflag)) AS g FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 10)
      SELECT 'r1' AS run_id, 'clean' AS stage, 1 AS number, 'success' AS status, n AS input_rows, c AS output_rows, true AS timed, NULL AS told FROM k
      UNION ALL SELECT 'r1', 'sums', 1, 'success', c + (SELECT count(*) FROM orders), g, true, NULL FROM k, g UNION ALL SELECT 'r1', 'report', 2, 'failed', g, 0, true, true FROM g""",
    "a10_daily_history": "SELECT day, n, run_id FROM (SELECT o_orderdate::DATE::VARCHAR AS day, count(*) AS n FROM orders GROUP BY 1) JOIN (VALUES ('r1', 2), ('r2', 3)) t(run_id, k) ON n % k = 0",
    "a11_compacted_files": "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem",
    "a16_rewritten_partitions": sql(GROWN + "SELECT *, 'newest' AS snapshot_id FROM m2 UNION ALL SELECT member_id, age_band, city_id, 'm1' FROM members", "members"),
    "h13_latest_times": sql(EVENTS + "SELECT source, city_id, max(event_time)::VARCHAR AS latest FROM ev GROUP BY source, city_id", "customers"),
    "h15_run_life_cycle": sql(EVENTS + "SELECT run_id, status, started_at::VARCHAR AS started_at, ended_at::VARCHAR AS ended_at, status = 'success' AS published FROM life", "customers"),
}
