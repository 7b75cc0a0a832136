"""Publication, snapshots of partitions, stages and lineage: what readers see when runs are tried again, die or write nothing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.operators import operations
from vigil.sources import stages, storage, versions

SCHEMA = StructType().add("k", "long").add("v", "string").add("city_id", "string")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(root):
    return {str(p): p.stat().st_mtime_ns for p in root.rglob("part-*")}


def test_publication_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "marts")
    storage.publish({"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("x")}, root, "007", "success")
    storage.write(spark.range(9).toDF("x"), f"{root}/a/folder=aleft")  # a run that never was registered
    assert {(r.x, r.run_id) for r in storage.published(spark, root, "a").collect()} == {(i, "007") for i in range(3)}


def test_a_run_tried_again_is_seen_whole_or_as_before(spark, tmp_path):
    root, seen = str(tmp_path / "marts"), lambda: [storage.published(spark, root, m).count() for m in "ab"]
    one = lambda n: spark.range(n).toDF("x")
    storage.publish({"a": one(3), "b": one(4)}, root, "r", "success")
    kept = files(tmp_path)
    with pytest.raises(PySparkException):
        storage.publish({"a": one(5), "b": one(6).withColumn("x", F.raise_error(F.lit("no")).cast("long"))}, root, "r", "success")
    assert seen() == [3, 4]
    storage.publish({"a": one(5), "b": one(6)}, root, "r", "failed")
    assert seen() == [3, 4]
    storage.publish({"a": one(7), "b": one(0)}, root, "r", "partial_success")
    assert seen() == [7, 0] and kept.items() <= files(tmp_path).items()
    assert {(r.dataset, r.rows, r.number) for r in storage.published_runs(spark, root).collect()} == {("a", 7, 3), ("b", 0, 3)}


ROWS = [(i, "a", c) for i, c in enumerate("xxyyz")]


def test_partitions_are_carried_rebuilt_and_removed(spark, tmp_path):
    root = str(tmp_path / "m")
    load = lambda i=None: sorted(tuple(r) for r in versions.load(spark, root, SCHEMA, "city_id", i).collect())
    assert versions.save(frame(spark, ROWS), root, "1", "city_id")
    kept = files(tmp_path)
    after = [(0, "a", "y"), (1, "b", "y"), *ROWS[2:4], (9, "n", None)]
    changed = [(0, "b", "x"), *ROWS[1:4], (9, "n", None)]
    assert versions.save(frame(spark, changed), root, "2", "city_id")
    assert load() == sorted(changed) if None not in {r[2] for r in changed} else sorted(map(str, load())) == sorted(map(str, changed))
    assert load("1") == sorted(ROWS) and kept.items() <= files(tmp_path).items()
    assert {(r.partition, r.action) for r in versions.of_snapshot(spark, root).collect()} == {("x", "rebuilt"), ("y", "carried"), ("z", "removed"), (None, "rebuilt")}
    assert versions.save(frame(spark, after), root, "3", "city_id")
    assert sorted(map(str, load())) == sorted(map(str, after))
    assert versions.mismatches(spark, root, SCHEMA, "city_id").count() == 0


def test_an_equal_snapshot_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "m")
    versions.save(frame(spark, ROWS), root, "1", "city_id", ("v",))
    kept = files(tmp_path)
    assert not versions.save(frame(spark, [(k, "other", c) for k, _, c in reversed(ROWS)]), root, "2", "city_id", ("v",))
    assert files(tmp_path) == kept
    assert versions.save(frame(spark, [*ROWS, ROWS[0]]), root, "3", "city_id", ("v",))  # a repeated row counts


def test_a_save_that_dies_is_not_seen_and_lost_files_are_told(spark, tmp_path):
    root = str(tmp_path / "m")
    versions.save(frame(spark, ROWS), root, "1", "city_id")
    bad = frame(spark, [(7, "c", "x")]).withColumn("v", F.when(F.col("k") > 0, F.raise_error(F.lit("no"))).otherwise("a"))
    with pytest.raises(PySparkException):
        versions.save(bad, root, "2", "city_id")
    storage.write(frame(spark, [(7, "c", "x")]), f"{root}/data/folder=sleft", ("city_id",))
    assert sorted(tuple(r) for r in versions.load(spark, root, SCHEMA, "city_id").collect()) == sorted(ROWS)
    for p in tmp_path.rglob("city_id=y/*.parquet"):
        p.unlink()
    assert [r.city_id for r in versions.mismatches(spark, root, SCHEMA, "city_id").collect()] == ["y"]


def test_stages_are_recorded_with_their_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    two = [spark.range(10), spark.range(5).toDF("other")]
    out = stages.run_stage(log, "r", "join", two, lambda a, b: a.join(b, a["id"] == b["other"]), str(tmp_path / "out"))
    assert out.count() == 5
    stages.run_stage(log, "r", "none", [spark.range(10)], lambda a: a.filter("id < 0"), str(tmp_path / "none"))
    with pytest.raises(PySparkException):
        stages.run_stage(log, "r", "bad", [out], lambda a: a.withColumn("id", F.raise_error(F.lit("told why"))), str(tmp_path / "bad"), known_rows=5)
    with pytest.raises(KeyError):
        stages.run_stage(log, "r", "worse", [out], lambda a: {}["x"], str(tmp_path / "worse"))
    found = {r.stage: r for r in stages.stage_metrics(spark, log).collect()}
    assert {s: (r.status, r.input_rows, r.output_rows) for s, r in found.items()} == {"join": ("success", 15, 5), "none": ("success", 10, 0), "bad": ("failed", 5, 0), "worse": ("failed", None, 0)}
    assert all(r.milliseconds >= 0 for r in found.values()) and "told why" in found["bad"].error
    stages.run_stage(log, "r", "bad", [out], lambda a: a, str(tmp_path / "good"))
    assert {(r.stage, r.number, r.status) for r in stages.stage_metrics(spark, log).collect()} >= {("bad", 2, "success")} and stages.stage_log(spark, log).count() == 5


def test_lineage_of_a_run(spark):
    columns = "artifact_id string, run_id string, artifact_type string, dataset_name string, source string, city_id string, reused_from_run_id string"
    rows = [("r1:s:x", "r1", "city_snapshot", "s", "s", "x", None), ("r2:s:x", "r2", "city_snapshot", "s", "s", "x", "r1"), ("r2:s:y", "r2", "city_snapshot", "s", "s", "y", None), ("r2:s", "r2", "compacted_source_snapshot", "s", "s", "__all__", "r0"),
            ("r2:mart", "r2", "processed_dataset", "mart", None, None, None), ("ref", None, "reference_snapshot", "m1", None, None, None), ("old", None, "reference_snapshot", "m0", None, None, None)]
    artifacts, runs = spark.createDataFrame(rows, columns), spark.createDataFrame([("r1", None), ("r2", "m1"), ("r2", "m1")], "run_id string, member_snapshot_id string")
    assert {tuple(r) for r in operations.lineage(artifacts, runs).collect()} == {
        ("r1:s:x", "r2:s:x", "reused_from"), ("r2:s:x", "r2:s", "compacted_from"), ("r2:s:y", "r2:s", "compacted_from"), ("r2:s", "r2:mart", "derived_from"), ("ref", "r2:mart", "derived_from")}
    assert sorted(tuple(r) for r in operations.run_upstream(artifacts, runs).collect()) == [("r2", "r2:s"), ("r2", "ref")]
    assert operations.lineage(artifacts.limit(0), runs).count() == 0


def test_marts_follow_their_tables(spark, tmp_path):
    from vigil.plans import risk

    d, calls = str(tmp_path), []

    def mart(s, folder):
        calls.append(folder)
        return storage.read(s, f"{folder}/t.parquet").withColumn("decision_date", F.lit("2030-01-01"))

    seen = lambda: risk.published(spark, d, "a_mart", mart).count()
    storage.write(spark.range(3), f"{d}/t.parquet")
    assert seen() == seen() == 3 and len(calls) == 1
    storage.write(spark.range(5), f"{d}/t.parquet", mode="overwrite")
    assert seen() == 5 and len(calls) == 2
    path = risk.PUBLISHED[spark.sparkContext.applicationId, d, "a_mart"][1]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    assert seen() == 5 and len(calls) == 3
