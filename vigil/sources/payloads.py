"""Payloads of JSON text to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hourly_rows(payloads: DataFrame, ids: Sequence[str], body: str, measures: Sequence[str]) -> DataFrame:
    """Parallel arrays (time and measures) to one row per time; shorter arrays give nulls at their end."""
    schema = f"time array<string>, {', '.join(f'{m} array<double>' for m in measures)}"
    parsed = payloads.withColumn("__p", F.from_json(body, schema))
    zipped = F.arrays_zip(*(F.col(f"__p.{c}").alias(c) for c in ("time", *measures)))
    return parsed.select(*ids, F.explode(zipped).alias("__r")).select(*ids, "__r.*")


def daily_rows(payloads: DataFrame, ids: Sequence[str], body: str, maps: dict[str, str]) -> DataFrame:
    """Maps of day to value, named by key, to one row per day of the first; days the others lack are null there."""
    parsed = payloads.withColumn("__p", F.from_json(body, f"struct<{', '.join(f'{k}: map<string,double>' for k in maps)}>"))
    first, *rest = maps
    rows = parsed.select(*ids, "__p", F.explode(f"__p.{first}").alias("day", maps[first]))
    return rows.select(*ids, "day", maps[first], *(F.try_element_at(F.col(f"__p.{k}"), F.col("day")).alias(maps[k]) for k in rest))


def to_text(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns))
