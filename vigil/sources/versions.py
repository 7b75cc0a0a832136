"""Snapshots as lists of partitions: what did not change is carried over, and a reader resolves the list.

A dataset's folder holds ``data``, with a folder for each save and in it one for
each partition, and ``manifest``, with a row for each snapshot and partition: the
save that wrote it, its rows and its hash. Files are never written over or
deleted, so a snapshot that is being read stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vigil.operators.reference import manifest_mismatches
from vigil.operators.snapshots import content_hash
from vigil.sources.storage import fresh_folder, read, there, write

#: number: snapshots of a dataset, from 1; removed partitions have a row, without a folder.
MANIFEST = "snapshot_id string, number int, partition string, folder string, rows long, content_hash string, action string"


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all snapshots; none before the first."""
    return read(spark, f"{root}/manifest", MANIFEST) if there(spark, f"{root}/manifest") else spark.createDataFrame([], MANIFEST)


def of_snapshot(spark: SparkSession, root: str, snapshot_id: str | None = None) -> DataFrame:
    """The rows of one snapshot, by default the newest; a snapshot saved again counts as it was saved last."""
    rows = manifest(spark, root)
    rows = rows.filter(F.col("snapshot_id") == snapshot_id) if snapshot_id else rows
    last = rows.agg(F.max("number").alias("number"))  # one row
    return rows.join(F.broadcast(last), "number", "left_semi")


def changes(df: DataFrame, root: str, partition: str, ignored: Sequence[str] = ()) -> DataFrame:
    """(partition, folder, rows, content_hash, action): what a save of df would do with each partition.

    carried: rows and hash are those of the newest snapshot; rebuilt: others, or
    new; removed: there are no rows any more. Columns that are ignored do not count.
    """
    now = content_hash(df, ignored, (partition,)).withColumnRenamed(partition, "partition").withColumn("partition", F.col("partition").cast("string"))
    before = of_snapshot(df.sparkSession, root).filter("action <> 'removed'").select("partition", "folder", F.col("rows").alias("old_rows"), F.col("content_hash").alias("old_hash"), F.lit(True).alias("known"))
    both = now.withColumn("now", F.lit(True)).alias("n").join(before.alias("b"), F.col("n.partition").eqNullSafe(F.col("b.partition")), "full_outer")
    same = (F.col("rows") == F.col("old_rows")) & (F.col("content_hash") == F.col("old_hash"))
    action = F.when(F.col("now").isNull(), "removed").when(F.col("known") & same, "carried").otherwise("rebuilt")
    return both.select(F.coalesce("n.partition", "b.partition").alias("partition"), F.when(action == "carried", F.col("folder")).alias("folder"), F.coalesce("rows", F.lit(0)).alias("rows"), "content_hash", action.alias("action"))


def save(df: DataFrame, root: str, snapshot_id: str, partition: str, ignored: Sequence[str] = ()) -> bool:
    """Df as the dataset's newest snapshot; whether anything was written.

    Partitions are hashed first. Those that differ from the newest snapshot are
    written, to a folder of this save; the manifest's rows come last and in one
    file, so a save that dies half-way is never seen. If nothing differs, nothing
    is written.
    """
    spark = df.sparkSession
    scratch = fresh_folder(spark, "changes")
    write(changes(df, root, partition, ignored), scratch)
    plan = read(spark, scratch, "partition string, folder string, rows long, content_hash string, action string")
    if plan.filter("action <> 'carried'").isEmpty():
        return False
    folder = f"s{uuid.uuid4().hex}"
    built = plan.filter("action = 'rebuilt'").select(F.col("partition").alias("__partition"))
    ours = df.join(built, F.col(partition).cast("string").eqNullSafe(F.col("__partition")), "left_semi")
    # large partitions are split over tasks, small ones share them
    write(ours.hint("rebalance", partition), f"{root}/data/folder={folder}", (partition,))
    number = manifest(spark, root).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    rows = plan.select(F.lit(snapshot_id).alias("snapshot_id"), F.lit(number).alias("number"), "partition", F.when(F.col("action") == "rebuilt", folder).otherwise(F.col("folder")).alias("folder"), "rows", "content_hash", "action")
    write(rows.coalesce(1), f"{root}/manifest", mode="append")  # a row for each partition
    return True


def load(spark: SparkSession, root: str, schema: StructType, partition: str, snapshot_id: str | None = None) -> DataFrame:
    """A snapshot's rows, by default the newest's; folders that its manifest does not name are not read."""
    named = of_snapshot(spark, root, snapshot_id).filter("action <> 'removed'").select(F.col("partition").alias("__partition"), F.col("folder").alias("__folder"))
    data = read(spark, f"{root}/data", StructType([*schema.fields, StructField("folder", StringType())]))
    return data.join(named, (F.col("folder") == F.col("__folder")) & F.col(partition).cast("string").eqNullSafe(F.col("__partition"))).select(*schema.names)


def mismatches(spark: SparkSession, root: str, schema: StructType, partition: str, ignored: Sequence[str] = ()) -> DataFrame:
    """Partitions of the newest snapshot whose rows are not those that its manifest tells."""
    kept = of_snapshot(spark, root).filter("action <> 'removed'").select(F.col("partition").alias(partition), "rows", "content_hash")
    return manifest_mismatches(content_hash(load(spark, root, schema, partition), ignored, (partition,)), kept, partition)
