"""Validation of records, batches and series: issues in long form, valid rows, acceptance."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class Range(NamedTuple):
    """A required number and the values it may have."""

    field: str
    low: float
    high: float


def issue(failed: Column, field: str, kind: str, value: Column, severity: str = "fatal") -> Column:
    return F.when(failed, F.struct(F.lit(field).alias("field_name"), F.lit(kind).alias("error_type"), value.cast("string").alias("invalid_value"), F.lit(severity).alias("severity")))


def range_issues(ranges: Sequence[Range]) -> list[Column]:
    """One for a missing value, one for a value out of range, for each field."""
    out = []
    for r in ranges:
        value = F.col(r.field)
        out += [issue(value.isNull(), r.field, "missing", value), issue(~value.between(r.low, r.high), r.field, "out_of_range", value)]
    return out


def sentinel_issue(fields: Sequence[str], sentinel: float) -> Column:
    """One issue if any field is null or the sentinel."""
    bad = F.lit(False)
    for f in fields:
        bad = bad | F.coalesce(F.col(f) == sentinel, F.lit(True))
    return issue(bad, ",".join(fields), "missing_source_value", F.lit(None))


def text_time(text: Column) -> Column:
    """B2: ISO text with Z, an offset, or none (UTC) as UTC time; null if it is no time."""
    zoneless = text.rlike(r":[0-9]{2}(\.[0-9]+)?$") & ~text.rlike(r"[+-][0-9]{2}:[0-9]{2}$")
    return F.try_to_timestamp(F.when(zoneless, F.concat(text, F.lit("Z"))).when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.concat(text, F.lit("T00:00:00Z"))).otherwise(text))


def date_key(text: Column) -> Column:
    """yyyyMMdd as a date; null if it is none."""
    return F.when(text.rlike("^[0-9]{8}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))))


def order_issues(low: str, high: str, spread: str, tolerance: float) -> list[Column]:
    """Low above high; a spread that is not their difference."""
    return [issue(F.col(low) > F.col(high), low, "above_maximum", F.col(low)),
            issue(F.abs(F.col(spread) - (F.col(high) - F.col(low))) > tolerance, spread, "inconsistent_range", F.col(spread))]


def warning_above(field: str, other: str) -> Column:
    """A warning, which keeps the row."""
    return issue(F.col(field) > F.col(other), field, "above_other", F.col(field), "warning")


def validated(df: DataFrame, issues: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, issues in long form); rows with warnings alone are valid."""
    names = df.columns
    marked = df.withColumn("__issues", F.filter(F.array(*issues), lambda x: x.isNotNull()))
    valid = marked.filter(~F.exists("__issues", lambda x: x["severity"] == "fatal")).select(*names)
    return valid, marked.select(*names, F.explode("__issues").alias("__i")).select(*names, "__i.*")


def array_contract(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """The lengths of parallel arrays and whether they are there and equal; a missing array has length -1."""
    lengths = [F.coalesce(F.size(a), F.lit(-1)).alias(f"n_{a}") for a in arrays]
    out = df.select("*", *lengths)
    ok = F.lit(True)
    for a in arrays:
        ok = ok & (F.col(f"n_{a}") >= 0) & (F.col(f"n_{a}") == F.col(f"n_{arrays[0]}"))
    return out.withColumn("accepted", ok)


def series_violations(df: DataFrame, key: str, ordinal: str, ts: str, hours: int, least: int, allow_gaps: bool) -> DataFrame:
    """Per key, the number of rows, of null, repeated and unordered times, and of gaps that are not (a multiple of) hours."""
    window = Window.partitionBy(key).orderBy(ordinal)
    gap = F.round((F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(window).cast("timestamp"))) / 3.6e9)
    bad = (gap <= 0) | (gap % hours != 0) if allow_gaps else gap != hours
    rows = df.withColumn("__gap", gap).withColumn("__bad", F.coalesce(bad, F.lit(False)))
    out = rows.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col(ts).isNull()).alias("null_times"), (F.count(ts) - F.count_distinct(ts)).alias("repeated_times"),
                                F.count_if(F.col("__gap") < 0).alias("unordered"), F.count_if("__bad").alias("bad_gaps"))
    return out.withColumn("accepted", (F.col("n") >= least) & (F.col("null_times") + F.col("repeated_times") + F.col("unordered") + F.col("bad_gaps") == 0))


def batch_acceptance(received: DataFrame, issues: DataFrame, policy: DataFrame, record: Sequence[str]) -> DataFrame:
    """Per source and city, whether enough rows are valid, by number and share, and few enough records fail.

    received has (source, city_id, received); policy (source, minimum_valid, minimum_ratio, maximum_invalid).
    """
    bad = issues.filter("severity = 'fatal'").select("source", "city_id", *record).distinct().groupBy("source", "city_id").agg(F.count("*").alias("invalid"))
    rows = received.join(bad, ["source", "city_id"], "left").fillna(0, ["invalid"]).join(policy, "source")
    valid = F.col("received") - F.col("invalid")
    ratio = F.coalesce(F.try_divide(valid, F.col("received")), F.lit(0.0))
    accepted = (valid >= F.col("minimum_valid")) & (ratio >= F.col("minimum_ratio")) & (F.col("invalid") <= F.col("maximum_invalid"))
    return rows.select("source", "city_id", "received", valid.alias("valid"), "invalid", F.round(ratio, 4).alias("valid_ratio"), accepted.alias("accepted"))


def invalid_summary(issues: DataFrame, record: Sequence[str]) -> DataFrame:
    """Distinct records, not issues, by source and severity."""
    return issues.groupBy("source", "severity").agg(F.count_distinct(*record).alias("invalid_records"))
