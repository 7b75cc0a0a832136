"""Rule catalogs: the four rules of the flagship query, and the one that parts make."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.rules import SCHEMA
from vigil.sources.adapters import table

#: rule_id, signal, persistence, severity, profile, predicates (metric, operator, comparison, threshold, percentile), bands.
FLAGSHIP = (
    ("R1", "heat", 3, "medium", "P1", (("temperature_2m", ">=", "absolute", 60.0, None),), (("medium", 3, 1.0), ("critical", 5, 1.1))),
    ("R2", "local extreme", 1, "low", "P2", (("temperature_2m", ">=", "baseline_percentile", None, "p90"),), None),
    ("R3", "compound", 2, "high", "P1", (("apparent_temperature", ">=", "absolute", 30.0, None), ("pm2_5", ">=", "absolute", 40.0, None)), None),
    ("R4", "dry air", 2, "medium", "P2", (("relative_humidity", "<=", "absolute", 8.0, None),), (("low", 2, 1.0), ("high", 6, 1.2))),
)
VERSION, AS_OF, ZONE, DECISION_DATE = "v1", "2024-01-02 00:00:00", "Asia/Kolkata", "2024-01-10"
PROFILES = (("P1", {"1-URGENT": "high", "2-HIGH": "medium"}), ("P2", {"3-MEDIUM": "low", "1-URGENT": "medium"}))


def flagship_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship's rules, for every region and month."""
    rows = [(VERSION, i, list(range(1, 13)), [[*x, "instantaneous", None] for x in p], [list(x) for x in b] if b else None, h, s, n, "environmental_health_risk", f) for i, n, h, s, f, p, b in FLAGSHIP]
    names = [f.strip().split(" ")[0] for f in ("ruleset_version", "rule_id", "months", "predicates", "bands", "persistence_hours", "severity", "signal_name", "signal_category", "condition_profile")]
    schema = SCHEMA.replace("cities array<string>, ", "")
    rules = spark.createDataFrame([tuple(r) for r in rows], schema).select(*names)
    cities = table(spark, sf_dir, "region").agg(F.array_sort(F.collect_set("r_name")).alias("cities"))
    return rules.crossJoin(cities)  # five names


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROFILES), "condition_profile string, relevance map<string,string>")


def part_rules(spark: SparkSession, sf_dir: str, version: int = 1) -> DataFrame:
    """A catalog with a rule for each part; some break the catalog's checks. Version 2 differs in every 10th rule."""
    changed = "p_partkey % 10 = 0" if version == 2 else "false"
    part = table(spark, sf_dir, "part")
    return part.filter(f"NOT (p_partkey % 50 = {version})").selectExpr(
        f"'v{version}' as ruleset_version", "concat('P', cast(p_partkey as string)) as rule_id",
        f"transform(sequence(1, 1 + cast(p_partkey % 3 as int)), i -> concat('city', cast((p_partkey * i) % 7 as string))) || if({changed}, array('city6'), cast(array() as array<string>)) as cities",
        "transform(sequence(1, 2 + cast(p_partkey % 3 as int)), i -> cast((p_partkey + i * 4) % 13 as int)) as months",
        """transform(sequence(1, 1 + cast(p_partkey % 2 as int)), i -> named_struct(
             'metric', concat('m', cast((p_size + i * ((p_partkey + 2) % 3)) % 4 as string)), 'operator', if((p_partkey + i) % 3 = 0, '<=', '>='),
             'comparison', if(p_partkey % 4 = 1, 'baseline_percentile', 'absolute'),
             'threshold', if(p_partkey % 4 = 1 and p_partkey % 28 <> 1, cast(null as double), cast((cast(p_retailprice as long) + 3 * i) % 5 * 10 as double)),
             'baseline_percentile', if(p_partkey % 4 = 1, 'p90', cast(null as string)),
             'function', case p_partkey % 3 when 1 then 'rolling_average' when 2 then 'daily_max' else 'instantaneous' end,
             'window_hours', case when p_partkey % 31 = 0 then 12 when p_partkey % 3 = 1 and p_partkey % 37 <> 0 then 24 end)) as predicates""",
        f"""if(p_partkey % 3 = 0, cast(null as array<struct<severity:string,minimum_persistence_hours:int,minimum_threshold_ratio:double>>), array(
             named_struct('severity', if(p_partkey % 5 = 0, 'high', 'low'), 'minimum_persistence_hours', 2, 'minimum_threshold_ratio', cast(1.0 as double)),
             named_struct('severity', 'medium', 'minimum_persistence_hours', if({changed}, 6, 4), 'minimum_threshold_ratio', cast(1.5 as double)))) as bands""",
        "cast(1 + p_size % 6 as int) as persistence_hours", "element_at(array('low', 'medium', 'high', 'critical'), cast(p_partkey % 4 + 1 as int)) as severity",
        "p_type as signal_name", "p_brand as signal_category", "concat('f', cast(p_partkey % 9 as string)) as condition_profile",
    )


def part_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile for each of the first eight remainders of supplier keys; parts name nine."""
    return table(spark, sf_dir, "supplier").groupBy(F.concat(F.lit("f"), (F.col("s_suppkey") % 8).cast("string")).alias("condition_profile")).agg(
        F.count("*").alias("n")).select("condition_profile", F.create_map(F.lit("c1"), F.lit("high"), F.concat(F.lit("c"), F.col("n").cast("string"), F.lit("x")), F.lit("low")).alias("relevance"))


def part_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities that are known: those of nation keys modulo 6; parts name seven."""
    return table(spark, sf_dir, "nation").select(F.concat(F.lit("city"), (F.col("n_nationkey") % 6).cast("string")).alias("city_id")).distinct()
