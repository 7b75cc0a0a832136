"""Mixing sources to target weights: sizes per source, repetition rates, whole copies and one seeded draw.

Sizes are summed per source, each source gets a target, and its documents are
emitted floor(rate) times with rate = target / size, plus one more copy where a
number drawn from a hash of the document's id is below the rest of the rate. The
draw depends on id and seed alone, so reruns and retried tasks agree.

Defined results: a null text has size 0; documents of size 0 get the copies that
their source's rate gives, and take no words; a null source is a source of its
own and comes last; a source of size 0 has target 0 and no copies; a null id
draws as the text ``null``; repeated rows are mixed each for itself, with the
same draw; columns beside doc_id, text and source are passed on untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.llm.common import stored, table, with_row

#: Up to so many sources the table of rates is broadcast (some 100 bytes each); beyond, the join shuffles.
BROADCAST_SOURCES = 10_000
WEIGHTS, SHARE, MOST, SEED = (5, 2, 1), 1.5, 2.0, "mix-1"


def size_of(text: Column) -> Column:
    """Words, as runs of characters other than space and 09-0D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) from the md5 of seed and id: 52 bits, the same in any engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_rates(sized: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size).

    Targets are proportional to the weights, dealt in order of source, and stop
    at most * size. The excess is shared anew by weight, which ends at one level
    for all that are not stopped: sorted by most * size / weight, the level is
    what is left for those not stopped yet, and the first that it does not
    exceed gives it. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_cap = Window.orderBy("cap", F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight.cast("double"))
    everything = Window.partitionBy()
    caps = sums.withColumn("cap", most * F.col("source_size") / F.col("weight"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(most * F.sum("source_size").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = caps.withColumn("level", left / open_weight)
    level = F.min(F.when(F.col("level") <= F.col("cap"), F.struct("cap", "level"))).over(everything)["level"]
    target = F.least(most * F.col("source_size"), F.coalesce(F.col("weight") * level, most * F.col("source_size")))
    return levels.select("source", "source_size", target.alias("target")).withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """docs with __size, __source_size, __target and __copies: how often the mix takes each document. Columns of these names are replaced."""
    sized = docs.drop("__source", "__source_size", "__target", "__rate", "__copies").withColumn("__size", size_of(F.col("text")))
    rates = stored(source_rates(sized.select("source", F.col("__size").alias("size")), weights, share, most))
    rates = rates.withColumnsRenamed({"source": "__source", "source_size": "__source_size", "target": "__target", "rate": "__rate"})
    rates = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    whole = F.floor("__rate")
    extra = (draw(F.col("doc_id"), seed) < F.col("__rate") - whole).cast("long")
    return sized.join(rates, F.col("source").eqNullSafe(F.col("__source"))).withColumn("__copies", whole + extra).drop("__source", "__rate")


def emitted(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as mix() says, columns as in docs."""
    mixed = mix(with_row(docs, "doc_id", "text", "source"), **options).filter(F.col("__copies") > 0)
    copies = mixed.select("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return copies.select(*(F.col("__row").getField(x).alias(x) for x in docs.columns))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"))


def mix_sql(docs: str) -> str:
    """The mix of the relation docs in DuckDB SQL, with copies."""
    return rf"""
    WITH sized AS (
      SELECT *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {docs}),
    sums AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight
      FROM sized GROUP BY source),
    caps AS (SELECT *, 2.0::DOUBLE * source_size / weight AS cap FROM sums),
    levels AS (
      SELECT *,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(2.0::DOUBLE * sum(source_size) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
      FROM caps
      WINDOW before AS (ORDER BY cap, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    rates AS (
      SELECT source, source_size,
        least(2.0::DOUBLE * source_size, coalesce(weight * first_level, 2.0::DOUBLE * source_size)) AS target
      FROM levels, (SELECT min_by(level, (cap, source IS NULL, source)) AS first_level FROM levels WHERE level <= cap)),
    drawn AS (
      SELECT s.*, r.source_size, r.target,
        CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0 END AS rate,
        ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
      FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source),
    mixed AS (
      SELECT *, floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT AS copies FROM drawn)"""


OP8_SQL = mix_sql("documents") + """
    SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"""
