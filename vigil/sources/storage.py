"""Writing and reading runs and snapshots as partitioned Parquet."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A1-A3: a file or a folder of files; folders named key=value become columns, typed by the schema where there is one."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def write(df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "error", refuse_empty: bool = False) -> None:
    """Zstd Parquet, partitioned by columns; an empty frame is an error where the caller says so."""
    if refuse_empty and df.isEmpty():
        raise ValueError(f"no rows for {path}")
    df.write.mode(mode).option("compression", "zstd").partitionBy(*partitions).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors share: spark.checkpoint.dir. Where it is unset, a temporary one on a single machine, else one in the warehouse."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not configured and sc.master.startswith("local"):
        configured = tempfile.mkdtemp(prefix="vigil-")
        sc.setCheckpointDir(configured)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/vigil"


def there(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def state(spark: SparkSession, folder: str) -> str:
    """What a folder of tables looks like: name, length and time of each file or folder in it. A table that is written again has other ones."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return "\n".join(sorted(f"{x.getPath().getName()} {x.getLen()} {x.getModificationTime()}" for x in found))


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: attempts of a run are numbered from 1; folder: where the attempt's marts are.
REGISTRY = "run_id string, number int, folder string, dataset string, rows long, status string"


def registered(spark: SparkSession, root: str) -> DataFrame:
    """All attempts to publish a run, a row for each mart; none before the first."""
    path = f"{root}/published_runs"
    return read(spark, path, REGISTRY) if there(spark, path) else spark.createDataFrame([], REGISTRY)


def publish(marts: dict[str, DataFrame], root: str, run_id: str, status: str) -> None:
    """The marts of a run to a folder of this attempt, then the registry's rows, one for each mart, in one file: that file is the commit.

    Nothing that readers may see is written over. Rows are counted as they are written.
    """
    spark, folder, rows = next(iter(marts.values())).sparkSession, f"a{uuid.uuid4().hex}", []
    for name, df in marts.items():
        seen = Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{root}/{name}/folder={folder}")
        rows.append((name, seen.get["rows"]))
    number = registered(spark, root).filter(F.col("run_id") == run_id).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    entries = [(run_id, number, folder, name, n, status) for name, n in rows]  # a row for each mart
    write(spark.createDataFrame(entries, REGISTRY).coalesce(1), f"{root}/published_runs", mode="append")


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """What is published: of each run and mart the newest attempt that succeeded, at least in part."""
    good = registered(spark, root).filter(F.col("status").isin("success", "partial_success"))
    newest = Window.partitionBy("run_id").orderBy(F.desc("number"))
    return good.withColumn("__n", F.dense_rank().over(newest)).filter("__n = 1").drop("__n")


def published(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """Rows of a mart with the run_id of each; folders of other attempts are not read."""
    runs = published_runs(spark, root).filter(F.col("dataset") == mart).select("run_id", "folder")
    return read(spark, f"{root}/{mart}").join(runs, "folder").drop("folder")


def append_history(facts: dict[str, DataFrame], root: str, run_id: str) -> None:
    """A10: the daily facts of a run to the history."""
    for name, df in facts.items():
        write(df.withColumn("run_id", F.lit(run_id)), f"{root}/{name}", ("run_id",), mode="append")


def compact(spark: SparkSession, source: str, target: str, keys: Sequence[str], rows_per_file: int) -> int:
    """Many files to few, sorted by keys within each; the number of rows, which stays the same."""
    df = read(spark, source)
    n = df.count()
    files = max(1, -(-n // rows_per_file))
    df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.option("compression", "zstd").parquet(target)
    if read(spark, target).count() != n:
        raise ValueError("rows changed on compaction")
    return n
