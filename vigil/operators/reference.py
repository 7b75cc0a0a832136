"""Reference data: reconciling members and their conditions, integrity, manifests, versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.operators.snapshots import content_hash


def row_hash(columns: Sequence[str]) -> Column:
    return F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns)), 256)


def reconciled(incoming: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """(key, new, old, action); current also has active. An absent row that is inactive already has no action."""
    columns = [c for c in incoming.columns if c != key]
    new = incoming.select(key, F.struct(*columns).alias("new"), row_hash(columns).alias("__new"))
    old = current.select(key, F.struct(*columns, "active").alias("old"), row_hash(columns).alias("__old"))
    action = (F.when(F.col("old").isNull(), "inserted").when(F.col("new").isNull(), F.when(F.col("old.active"), "deactivated"))
              .when((F.col("__new") != F.col("__old")) | ~F.col("old.active"), "updated").otherwise("unchanged"))
    return new.join(old, key, "full_outer").withColumn("action", action).drop("__new", "__old")


def action_counts(rows: DataFrame) -> DataFrame:
    """How many of each action."""
    return rows.filter("action IS NOT NULL").groupBy("action").agg(F.count("*").alias("members"))


def changed_cities(rows: DataFrame) -> DataFrame:
    """The cities that a change touches, where a row was and where it is."""
    touched = rows.filter("action IN ('inserted', 'updated', 'deactivated')")
    return touched.select(F.explode(F.array("new.city_id", "old.city_id")).alias("city_id")).filter("city_id IS NOT NULL").distinct()


def condition_changes(incoming: DataFrame, current: DataFrame) -> DataFrame:
    """C11: members whose sets of conditions differ."""
    def sets(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("member_id").agg(F.array_sort(F.collect_set("condition")).alias(name))

    both = sets(incoming, "new").join(sets(current, "old"), "member_id", "full_outer")
    return both.filter(~F.col("new").eqNullSafe(F.col("old"))).select("member_id")


def next_state(rows: DataFrame, key: str) -> DataFrame:
    """The state after reconciling: what came in is active, what did not is kept, inactive."""
    names = [f.name for f in rows.schema["old"].dataType if f.name != "active"]
    return rows.select(key, *(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in names), F.col("new").isNotNull().alias("active"))


def current_conditions(state: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """Links of active members."""
    return links.join(state.filter("active").select(key), key, "left_semi")


def integrity_violations(members: DataFrame, links: DataFrame) -> DataFrame:
    """C14: (violation, id): repeated or missing ids, links without a member, repeated links."""
    ident = F.col("member_id").cast("string").alias("id")
    repeated = members.groupBy("member_id").count().filter("count > 1").select(F.lit("repeated_id").alias("violation"), ident)
    empty = members.filter(F.coalesce(F.trim(F.col("member_id").cast("string")) == "", F.lit(True))).select(F.lit("empty_id").alias("violation"), ident)
    orphan = links.join(members, "member_id", "left_anti").select(F.lit("orphan_link").alias("violation"), ident)
    twice = links.groupBy("member_id", "condition").count().filter("count > 1").select(F.lit("repeated_link").alias("violation"), ident)
    return repeated.unionByName(empty).unionByName(orphan).unionByName(twice)


def manifest_mismatches(snapshot: DataFrame, manifest: DataFrame, partition: str) -> DataFrame:
    """Partitions whose rows or content hash are not those recorded, or that only one side has."""
    now = snapshot.select(F.col(partition).alias("__now"), F.col("rows").alias("rows_now"), F.col("content_hash").alias("hash_now"))
    both = now.join(manifest, F.col("__now").eqNullSafe(F.col(partition)), "full_outer")
    agree = F.col("rows_now").eqNullSafe(F.col("rows")) & F.col("hash_now").eqNullSafe(F.col("content_hash"))
    return both.filter(~agree).select(F.coalesce("__now", partition).alias(partition))


def version_id(df: DataFrame, length: int) -> DataFrame:
    """An id made from the content of a table, the same in any order of rows."""
    whole = F.concat_ws(":", F.col("rows").cast("string"), "content_hash")
    return content_hash(df, ()).select(F.substring(F.sha2(whole, 256), 1, length).alias("version_id"))
