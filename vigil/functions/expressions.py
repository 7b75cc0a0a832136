"""Column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The severity ranks and the weights of a priority score.
SEVERITY_RANK = {"low": 1, "medium": 2, "high": 3, "critical": 4}
RELEVANCE_WEIGHT = {"high": 2, "medium": 1}


def local_date(ts: Column, zone: str) -> Column:
    """The date of a UTC time (without zone) in a zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts))


def rank_of(severity: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, rank in SEVERITY_RANK.items():
        out = F.when(severity == name, F.lit(rank)).otherwise(out)
    return out


def share(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, null for a whole of 0."""
    return F.round(F.try_divide(100.0 * part, whole), digits)


def satisfied(value: Column, operator: Column, threshold: Column) -> Column:
    """Whether a measured value meets a predicate; null if the value or the threshold is."""
    return F.when(operator == ">=", value >= threshold).when(operator == "<=", value <= threshold).otherwise(F.lit(False))


def threshold_ratio(value: Column, operator: Column, threshold: Column) -> Column:
    """1 at the threshold, more beyond it in the predicate's direction, relative to the threshold's size."""
    over = F.when(operator == ">=", value - threshold).when(operator == "<=", threshold - value)
    return 1 + over / F.greatest(F.abs(threshold), F.lit(1.0))


def three_level(value: Column, warn: float, fail: float) -> Column:
    return F.when(value > fail, "fail").when(value > warn, "warning").otherwise("pass")


def clock(ts: Column) -> Column:
    """A time as text, for results that other engines are compared with."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def list_text(array: Column) -> Column:
    return F.array_join(array, "|")
