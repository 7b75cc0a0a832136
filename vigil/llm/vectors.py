"""What the two vector searches share: usable vectors, queries against blocks of rows, and the best of all blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block that queries are held against in one task, about.
BLOCK = 4096
#: Queries of a block in one task, about.
QUERY_BLOCK = 2048


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, vector as doubles): rows with an id whose vector has components, none of them null or not finite."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return table.select("vec_id", vector.alias("vector")).filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & F.coalesce(fine, F.lit(False)))


def is_query(every: int) -> Column:
    return F.col("vec_id") % every == 0


def best(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from lists of (score, vec_id) per query and block; ties to the smaller vec_id."""
    rows = found.select("query_id", F.explode("found").alias("f")).select("query_id", "f.vec_id", "f.score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
