"""Rolling snapshots: newest row per key, change counts, merge, content hashes, column statistics, schema checks.

Keys are compared with equality (rows with a null in the key are never matched,
and are inserted), measures with null-safe equality. Each function does any source
by its column lists.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key, the largest by the columns of newest; list the measures there too, to settle ties."""
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in newest))
    return df.withColumn("__n", F.row_number().over(window)).filter("__n = 1").drop("__n")


def same_values(a: str, b: str, values: Sequence[str]) -> Column:
    out = F.lit(True)
    for v in values:
        out &= F.col(f"{a}.{v}").eqNullSafe(F.col(f"{b}.{v}"))
    return out


def classified(incoming: DataFrame, previous: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys, new, old, change): one full outer join for counts and merge alike; change is null where nothing came in."""
    rest = [c for c in previous.columns if c not in keys]
    new = incoming.select(*keys, F.struct(*rest).alias("new"))
    old = previous.select(*keys, F.struct(*rest).alias("old"))
    change = F.when(F.col("new").isNull(), F.lit(None)).when(F.col("old").isNull(), "inserted").when(same_values("new", "old", values), "unchanged").otherwise("updated")
    return new.join(old, list(keys), "full_outer").withColumn("change", change)


def change_metrics(raw: DataFrame, previous: DataFrame, keys: Sequence[str], values: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row of inserted, updated, unchanged and rejected (duplicates of a key) counts."""
    kinds = classified(latest_per_key(raw, keys, newest), previous, keys, values)
    counts = kinds.agg(*(F.count_if(F.col("change") == c).alias(c) for c in ("inserted", "updated", "unchanged")))
    received = raw.agg(F.count("*").alias("received"))
    return counts.crossJoin(received).select("inserted", "updated", "unchanged", (F.col("received") - F.col("inserted") - F.col("updated") - F.col("unchanged")).alias("rejected"))


def merge(raw: DataFrame, previous: DataFrame, keys: Sequence[str], values: Sequence[str], newest: Sequence[str], current: Column) -> DataFrame:
    """The new snapshot. Previous rows for which current does not hold are gone before anything is compared.

    An unchanged row stays as it was, with its old time of extraction; a changed or
    new one is the incoming row; a previous row that nothing came in for stays.
    """
    kinds = classified(latest_per_key(raw, keys, newest), previous.filter(current), keys, values)
    picked = F.when(F.col("change").isin("inserted", "updated"), F.col("new")).otherwise(F.col("old"))
    return kinds.withColumn("row", picked).select(*keys, "row.*")


def first_snapshot(raw: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Without a previous snapshot every deduplicated row is inserted."""
    return latest_per_key(raw, keys, newest)


def content_hash(df: DataFrame, ignored: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, rows, content_hash), the same in any order of rows: the sum of 15 hexadecimal digits of each row's md5."""
    columns = sorted(c for c in df.columns if c not in {*ignored, *by})
    text = F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns))
    digits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.sum(digits).cast("string").alias("content_hash"))


def column_statistics(df: DataFrame) -> DataFrame:
    """(column_name, null_count, min_value, max_value, rows), a row per column, from one aggregation."""
    aggregates = [F.count("*").alias("rows")]
    for c in df.columns:
        aggregates += [F.count_if(F.col(c).isNull()).alias(f"n:{c}"), F.min(c).cast("string").alias(f"a:{c}"), F.max(c).cast("string").alias(f"b:{c}")]
    rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"n:{c}").alias("null_count"), F.col(f"a:{c}").alias("min_value"), F.col(f"b:{c}").alias("max_value")) for c in df.columns))
    return df.agg(*aggregates).select("rows", F.explode(rows).alias("r")).select("r.*", "rows")


def schema_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in schema], "name string, type string, nullable boolean")


def schema_fingerprint(schema: StructType) -> str:
    import hashlib

    return hashlib.sha256(json.dumps(sorted((f.name, f.dataType.simpleString(), f.nullable) for f in schema)).encode()).hexdigest()


def check_schema(known: StructType, known_version: str, new: StructType, new_version: str) -> None:
    """A different fingerprint under the same version is an error."""
    if known_version == new_version and schema_fingerprint(known) != schema_fingerprint(new):
        raise ValueError(f"schema changed under version {new_version}")
