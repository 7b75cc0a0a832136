"""Small cases: the fixtures of the domain, and what the tables do not hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from vigil.operators import marts, operations, quality, reference, rules, serving, snapshots, validation
from vigil.plans import catalog
from vigil.sources import payloads, storage

HOUR = datetime.timedelta(hours=1)
T0 = datetime.datetime(2030, 6, 1, 0)
TRIGGER = "ruleset_version string, rule_id string, city_id string, signal_name string, signal_category string, persistence_hours int, predicate_count int, observed_at timestamp_ntz, is_breach boolean, threshold_ratio double, parts array<struct<predicate_index:int,metric:string,metric_value:double,effective_threshold:double,explanation:string>>"


def hourly(spark, temperatures, start=T0, city="x", skip=()):
    rows = [(city, start + i * HOUR, t, t, 0.0, 40.0, 1.0) for i, t in enumerate(temperatures) if i not in skip]
    weather = spark.createDataFrame(rows, "city_id string, observed_at timestamp_ntz, apparent_temperature double, temperature_2m double, precipitation double, relative_humidity double, wind_speed double")
    air = weather.select("city_id", "observed_at", F.lit(20.0).alias("pm2_5"), F.lit(30.0).alias("pm10"))
    cities = spark.createDataFrame([(city,)], "city_id string")
    return marts.conditions(weather, air, cities, "2030-01-01 00:00:00")


def rule(spark, predicates, hours, bands=None, months=tuple(range(1, 13))):
    row = ("v", "r", ["x"], list(months), [(*p, "instantaneous", None) for p in predicates], bands, hours, "medium", "signal", "category", "p")
    return spark.createDataFrame([row], rules.SCHEMA)


def triggers(spark, found, ours, known=None):
    known = known if known is not None else marts.baselines(marts.long_form(found, ("city_id", "observed_at"), ("temperature_2m",)), "observed_at").limit(0)
    return marts.active_triggers(found, rules.definitions(ours), rules.predicates(ours), rules.severity_bands(ours), known, "2030-05-31", "Asia/Kolkata").collect()


ABOVE_40 = [("temperature_2m", ">=", "absolute", 40.0, None)]


def test_compound_rule_on_percentile_takes_the_highest_band(spark):
    history = spark.createDataFrame([("x", datetime.date(2020 + y, 6, 1 + i), float(30 + i)) for y in range(5) for i in range(5)], "city_id string, observed_date date, metric_value double").withColumn("metric", F.lit("temperature_2m"))
    known = marts.baselines(history, "observed_date")
    ours = rule(spark, [("temperature_2m", ">=", "baseline_percentile", None, "p95"), ("relative_humidity", ">=", "absolute", 30.0, None)], 2, [("medium", 2, 1.0), ("critical", 3, 1.0)])
    found = triggers(spark, hourly(spark, [36.0, 36.0, 36.0]), ours, known)
    assert [(r.severity, r.observed_persistence_hours, r.action_timing, r.days_until_start) for r in found] == [("critical", 3, "upcoming_risk", 1)]
    assert found[0].metrics == ["temperature_2m", "relative_humidity"]


def test_missing_hour_breaks_a_streak(spark):
    assert not triggers(spark, hourly(spark, [41.0] * 5, skip={2}), rule(spark, ABOVE_40, 3))


def test_streak_crosses_a_month_end(spark):
    start = datetime.datetime(2030, 6, 30, 22)
    found = triggers(spark, hourly(spark, [41.0] * 4, start), rule(spark, ABOVE_40, 4))
    assert [r.observed_persistence_hours for r in found] == [4]


def test_no_matching_band_drops_the_window(spark):
    assert not triggers(spark, hourly(spark, [41.0] * 3), rule(spark, ABOVE_40, 2, [("high", 9, 1.0)]))


def test_null_measure_is_no_breach(spark):
    assert not triggers(spark, hourly(spark, [41.0, None, 41.0]), rule(spark, ABOVE_40, 2))


def test_expansion_covers_both_local_dates_and_guards_reversed_ones(spark):
    rows = [(datetime.datetime(2030, 6, 1, 17), datetime.datetime(2030, 6, 1, 20), datetime.date(2030, 6, 1)), (datetime.datetime(2030, 6, 1, 17), datetime.datetime(2030, 5, 20, 20), datetime.date(2030, 6, 1))]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, forecast_start_date date")
    assert sorted(r.decision_date.day for r in marts.conditions_daily(df, "Asia/Kolkata").collect()) == [1, 2]


def test_rolling_mean_of_one_point_and_published_cities(spark):
    found = hourly(spark, [30.0]).collect()
    assert [r.pm2_5_rolling_24h for r in found] == [20.0]


PREVIOUS = [("x", 0, 1.0, 1), ("x", 1, 2.0, 1), ("x", 2, 3.0, 1)]
INCOMING = [("x", 1, 2.0, 2), ("x", 2, 9.0, 2), ("x", 3, 4.0, 2)]
SCHEMA = "city_id string, observed_at int, v double, extracted_at int"


def merged(spark, incoming, previous):
    raw, old = spark.createDataFrame(incoming, SCHEMA), spark.createDataFrame(previous, SCHEMA)
    keys = ("city_id", "observed_at")
    return snapshots.merge(raw, old, keys, ("v",), ("extracted_at", "v"), F.lit(True)), snapshots.change_metrics(raw, old, keys, ("v",), ("extracted_at", "v")).first().asDict()


def test_merge_keeps_old_times_and_is_idempotent(spark):
    out, counts = merged(spark, INCOMING, PREVIOUS)
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1, "rejected": 0}
    rows = sorted(map(tuple, out.collect()))
    assert rows == [("x", 0, 1.0, 1), ("x", 1, 2.0, 1), ("x", 2, 9.0, 2), ("x", 3, 4.0, 2)]
    again, counts = merged(spark, INCOMING, rows)
    assert sorted(map(tuple, again.collect())) == rows and counts["unchanged"] == 3


def test_duplicates_are_rejected_nulls_compared_and_keys_without_value_inserted(spark):
    out, counts = merged(spark, [("x", 5, 1.0, 2), ("x", 5, 7.0, 3), ("y", 1, None, 2), (None, 1, 1.0, 2)], [("y", 1, None, 1)])
    assert counts == {"inserted": 2, "updated": 0, "unchanged": 1, "rejected": 1}
    assert ("x", 5, 7.0, 3) in set(map(tuple, out.collect())) and ("y", 1, None, 1) in set(map(tuple, out.collect()))


def test_schema_change_under_one_version_is_refused(spark):
    a, b = spark.range(1).schema, spark.range(1).withColumn("x", F.lit(1)).schema
    snapshots.check_schema(a, "1", a, "1")
    snapshots.check_schema(a, "1", b, "2")
    with pytest.raises(ValueError):
        snapshots.check_schema(a, "1", b, "1")


def test_content_hash_is_free_of_order_and_ignores_columns(spark):
    a = spark.createDataFrame(PREVIOUS, SCHEMA)
    b = spark.createDataFrame([(*r[:3], 5) for r in reversed(PREVIOUS)], SCHEMA)
    assert snapshots.content_hash(a, ("extracted_at",)).first() == snapshots.content_hash(b, ("extracted_at",)).first()


def test_readiness(spark):
    def status(complete):
        df = spark.createDataFrame([(f"c{i}", i < complete) for i in range(7)], "city_id string, complete boolean")
        return quality.run_readiness(df, 5, 0.5, ["c0"]).first().status

    assert [status(7), status(5), status(4)] == ["success", "partial_success", "failed"]


def test_anomaly_needs_samples(spark):
    current = spark.createDataFrame([("a", "rows", 160.0), ("b", "rows", 160.0)], "dataset string, metric string, value double")
    history = spark.createDataFrame([("a", "rows", 100.0, 3), ("b", "rows", 100.0, 2)], "dataset string, metric string, average_value double, samples int")
    found = {r.dataset: (r.ratio, r.status, r.baseline) for r in quality.row_anomalies(current, history, 3, 0.2, 0.5).collect()}
    assert found == {"a": (0.6, "fail", "history"), "b": (None, "pass", "insufficient")}


def test_gate(spark):
    results = quality.integrity_results(spark.createDataFrame([(1, 0)], "consent_leakage int, other int"), {})
    assert not quality.may_publish(results)
    assert quality.may_publish(results.filter("status = 'pass'"))


def test_batch_acceptance_by_ratio(spark):
    received = spark.createDataFrame([("s", "x", 2)], "source string, city_id string, received long")
    issues = spark.createDataFrame([("s", "x", 1, "fatal"), ("s", "x", 1, "fatal")], "source string, city_id string, id int, severity string")
    for ratio, accepted in ((0.5, True), (0.9, False)):
        policy = spark.createDataFrame([("s", 1, ratio, 5)], "source string, minimum_valid int, minimum_ratio double, maximum_invalid int")
        row = validation.batch_acceptance(received, issues, policy, ("id",)).first()
        assert (row.invalid, row.accepted) == (1, accepted)


def test_series_contract(spark):
    rows = [("a", 0, T0), ("a", 1, T0), ("b", 0, T0), ("b", 1, T0 + 2 * HOUR), ("c", 0, T0), ("c", 1, T0 + HOUR)]
    df = spark.createDataFrame(rows, "k string, i int, ts timestamp_ntz")
    assert {r.k: r.accepted for r in validation.series_violations(df, "k", "i", "ts", 1, 2, False).collect()} == {"a": False, "b": False, "c": True}
    assert {r.k: r.accepted for r in validation.series_violations(df, "k", "i", "ts", 1, 2, True).collect()}["b"]


def test_lifecycle_has_all_statuses(spark):
    rows = [("2030-01-01", "r1", 1, "x", "a", 1), ("2030-01-01", "r1", 2, "x", "a", 1), ("2030-01-01", "r1", 3, "x", "a", 1), ("2030-01-02", "r2", 1, "x", "a", 1), ("2030-01-02", "r2", 2, "x", "a", 3), ("2030-01-02", "r2", 4, "x", "a", 1), ("2030-01-02", "r1", 9, "x", "a", 1)]
    df = spark.createDataFrame(rows, "d string, run_id string, member_id int, city_id string, rule_id string, severity_rank int").withColumn("decision_date", F.to_date("d")).drop("d")
    assert {r.change: r.members for r in serving.risk_lifecycle(df, "2030-01-02").collect()} == {"new": 1, "escalated": 1, "continuing": 1, "resolved": 1}


def test_member_reconciliation(spark):
    new = spark.createDataFrame([(1, "y"), (2, "x"), (4, "x")], "member_id int, city_id string")
    old = spark.createDataFrame([(1, "x", True), (2, "x", True), (3, "z", True), (5, "x", False)], "member_id int, city_id string, active boolean")
    rows = reference.reconciled(new, old, "member_id")
    assert {r.action: r.members for r in reference.action_counts(rows).collect()} == {"updated": 1, "unchanged": 1, "inserted": 1, "deactivated": 1}
    assert {r.city_id for r in reference.changed_cities(rows).collect()} == {"x", "y", "z"}
    assert {r.member_id for r in reference.next_state(rows, "member_id").filter("active").collect()} == {1, 2, 4}


def test_retention_keeps_unparseable_and_named(spark):
    runs = spark.createDataFrame([("20200101T000000Z",), ("latest",), ("20300101T000000Z",)], "run_id string")
    assert [r.run_id for r in operations.older_than(runs, "2030-01-02 00:00:00", 90).collect()] == ["20200101T000000Z"]
    snaps = spark.createDataFrame([("a", True), ("b", False), ("c", False)], "snapshot_id string, published boolean")
    assert [r.snapshot_id for r in operations.removable(snaps, snaps, 1).collect()] == ["b"]


def test_storage(spark, tmp_path):
    with pytest.raises(ValueError):
        storage.write(spark.range(0), str(tmp_path / "empty"), refuse_empty=True)
    df = spark.createDataFrame([("x", 1), ("y", 2)], "city_id string, v int")
    path = str(tmp_path / "parts")
    storage.write(df, path, ("city_id",))
    assert storage.compact(spark, path, str(tmp_path / "few"), ("v",), 10) == 2
    storage.append_history({"f": df}, str(tmp_path / "h"), "r1")
    assert storage.read(spark, str(tmp_path / "h/f"), "city_id string, v int, run_id string").count() == 2


def test_payloads(spark):
    df = spark.createDataFrame([("x", '{"time": ["a", "b"], "m": [1.5]}'), ("y", "no json")], "id string, body string")
    assert sorted((r.id, r.time, r.m) for r in payloads.hourly_rows(df, ("id",), "body", ("m",)).filter("time = 'a'").collect()) == [("x", "a", 1.5)]
    assert payloads.hourly_rows(df, ("id",), "body", ("m",)).count() == 2


def test_empty_tables_give_empty_results(spark):
    empty = hourly(spark, [30.0]).limit(0)
    assert not triggers(spark, empty, rule(spark, ABOVE_40, 1))
    assert catalog.FLAGSHIP


def test_exposure_holds_every_rule_and_day(spark):
    from vigil.plans import risk
    from vigil.sources import adapters

    d = "/root/testdata/sf0.001"
    relevance = {(r.rule_id, r.condition): r.relevance for r in rules.condition_relevance(catalog.flagship_rules(spark, d), catalog.profiles(spark)).collect()}
    held = [(r.decision_date, r.city_id, r.rule_id, r.window_start, r.severity_rank) for r in risk.daily(spark, d).collect()]
    conditions, expected, at_risk = {}, {}, {}
    for r in adapters.member_conditions(spark, d).collect():
        conditions.setdefault(r.member_id, set()).add(r.condition)
    for m in adapters.members(spark, d).collect():
        for day, city, rule_id, start, rank in held:
            ours = [relevance[rule_id, c] for c in conditions.get(m.member_id, ()) if (rule_id, c) in relevance]
            if city == m.city_id and ours:
                weight = max({"high": 2, "medium": 1}.get(x, 0) for x in ours)
                expected[day, m.member_id, rule_id, start] = rank + weight + (m.age_band == "60+")
                at_risk.setdefault((day, city), set()).add(m.member_id)
    rows = risk.exposure(spark, d).collect()
    assert len(rows) == len(expected) and {(r.decision_date, r.member_id, r.rule_id, r.window_start): r.priority_score for r in rows} == expected
    assert {rule_id for *_, rule_id, _ in expected} - {"R1", "R4"} and len({day for day, *_ in expected}) > 3
    assert all(r.at_risk_members == len(at_risk.get((r.decision_date, r.city_id), ())) for r in risk.workload(spark, d).collect())


def test_reference_integrity_reads_every_order(spark):
    from vigil.plans import operations as plans

    d = "/root/testdata/sf0.001"
    ours = {r.member_id for r in plans.incoming_members(spark, d).collect()}
    links = [(r.o_custkey, r.o_orderpriority) for r in spark.read.parquet(f"{d}/orders.parquet").collect()]
    orphans, twice = [m for m, _ in links if m not in ours], [m for m, c in set(links) if links.count((m, c)) > 1]
    found = {r.violation: (r.n, r.ids) for r in plans.QUERIES["c14_reference_integrity"](spark, d).collect()}
    assert found == {"orphan_link": (len(orphans), len(set(orphans))), "repeated_link": (len(twice), len(set(twice)))}


def test_zoneless_text_is_utc_in_any_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",), ("2024-01-01T00:00:00Z",), ("2024-01-01T05:30:00+05:30",), ("2024-01-01",), ("x",), (None,)], "t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert [r[0] for r in df.select(F.unix_seconds(validation.text_time(F.col("t")))).collect()] == [1704067200] * 4 + [None] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_next_state_takes_nulls_that_came_in(spark):
    incoming = spark.createDataFrame([(1, None)], "member_id int, city_id string")
    current = spark.createDataFrame([(1, "x", True), (2, "y", True)], "member_id int, city_id string, active boolean")
    state = reference.next_state(reference.reconciled(incoming, current, "member_id"), "member_id")
    assert {(r.member_id, r.city_id, r.active) for r in state.collect()} == {(1, None, True), (2, "y", False)}


def test_empty_ids_are_violations(spark):
    members = spark.createDataFrame([("a",), ("",), (" ",), (None,)], "member_id string")
    links = spark.createDataFrame([("a", "c")], "member_id string, condition string")
    assert [r.violation for r in reference.integrity_violations(members, links).collect()] == ["empty_id"] * 3


def test_integrity_counts_each_breach(spark):
    window = "decision_date date, ruleset_version string, rule_id string, city_id string, window_start timestamp_ntz, member_id int, priority_score int, outreach_consent boolean, outreach_eligible boolean"
    day, start = datetime.date(2024, 1, 1), datetime.datetime(2024, 1, 1)
    exposure = spark.createDataFrame([(day, "v", "r", "x", start, 1, 4, True, True), (day, "v", "r", "x", start, 2, 1, False, False)], window)
    queue = exposure.unionByName(exposure.filter("member_id = 1")).unionByName(exposure.filter("member_id = 1").withColumn("rule_id", F.lit("other")))
    alerts = spark.createDataFrame([(day, "r", "x", start, 5, 1)], "decision_date date, rule_id string, city_id string, window_start timestamp_ntz, eligible_members int, high_priority_members int")
    triggers = spark.createDataFrame([("v", "r", "x", start, start, 1, 3)], "ruleset_version string, rule_id string, city_id string, window_start timestamp_ntz, window_end timestamp_ntz, observed_persistence_hours int, persistence_hours int")
    workload = spark.createDataFrame([(day, "x", 9, 1, 1, 3)], "decision_date date, city_id string, at_risk_members int, contactable_members int, high_priority_members int, total_members int")
    row = quality.integrity(exposure, queue, alerts, triggers, workload, spark.createDataFrame([("y",)], "city_id string")).first()
    assert tuple(row) == (1, 1, 1, 1, 2, 6, 1, 1, 1)
