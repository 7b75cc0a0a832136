"""Conflicts between rules and the impact of changes, against every pair of rules and against sets in plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import review, rules
from vigil.operators.review import Configuration

PROFILES = {"p": ("diabetes", "asthma"), "q": ("asthma",), "r": ("heart",)}


def predicate(metric="m", operator=">=", threshold=1.0, function="instantaneous", hours=None):
    return metric, operator, "absolute", threshold, None, function, hours


def catalog(spark, rows):
    """rows of (rule_id, predicates, cities, months, profile)."""
    return spark.createDataFrame([("v", i, list(c), list(m), list(p), None, 1, "low", "s", "k", f) for i, p, c, m, f in rows], rules.SCHEMA)


def cohorts(spark, profiles=None):
    return spark.createDataFrame([(p, {c: "high" for c in cs}) for p, cs in (profiles or PROFILES).items()], "condition_profile string, relevance map<string,string>")


def conflicts(spark, rows):
    return sorted((r.first_rule, r.second_rule, r.conflict, r.level, tuple(r.cities), tuple(r.months), tuple(r.conditions)) for r in review.rule_conflicts(catalog(spark, rows), cohorts(spark)).collect())


def every_pair(rows):
    found = []
    for k, (i, p, c, m, f) in enumerate(rows):
        for j, p2, c2, m2, f2 in rows[k + 1 :]:
            scope = [tuple(sorted(set(x) & set(y))) for x, y in ((c, c2), (m, m2), (PROFILES[f], PROFILES[f2]))]
            if not all(scope):
                continue
            one, two = set(p), set(p2)
            about = lambda s: {(x[0], x[1], x[2], x[5], x[6]) for x in s}
            kind = "duplicate_scope" if one == two else "nested" if one < two or two < one else "threshold_overlap" if about(one) == about(two) else None
            if kind:
                found.append((i, j, kind, "error" if kind == "duplicate_scope" else "warning", *scope))
    return sorted(found)


def test_profiles_conflict_by_shared_conditions(spark):
    one = [predicate()]
    assert [x[2] for x in conflicts(spark, [("a", one, "x", [1], "p"), ("b", one, "x", [1], "q")])] == ["duplicate_scope"]
    assert conflicts(spark, [("a", one, "x", [1], "q"), ("b", one, "x", [1], "r")]) == []


def test_thresholds_conflict_where_scopes_overlap(spark):
    found = conflicts(spark, [("a", [predicate()], "x", [1, 2], "p"), ("b", [predicate(threshold=2.0)], "xy", [2, 3], "p")])
    assert found == [("a", "b", "threshold_overlap", "warning", ("x",), (2,), ("asthma", "diabetes"))]


def test_aggregations_are_told_apart(spark):
    daily, rolling = predicate(function="daily_max"), predicate(threshold=9.0, function="rolling_average", hours=24)
    assert conflicts(spark, [("a", [predicate()], "x", [1], "p"), ("b", [daily], "x", [1], "p"), ("c", [rolling], "x", [1], "p")]) == []
    rows = [("a", [predicate(threshold=5.0), predicate(operator="<=", threshold=4.0, function="daily_max")], "x", [1], "p"), ("b", [predicate(threshold=5.0), predicate(operator="<=", threshold=4.0)], "x", [1], "p")]
    assert [(r.rule_id, r.function) for r in review.impossible_ranges(catalog(spark, rows)).collect()] == [("b", "instantaneous")]


@pytest.mark.parametrize("seed", [1, 2])
def test_conflicts_are_those_of_every_pair(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        few = [predicate(rng.choice("mn"), rng.choice((">=", "<=")), float(rng.randint(1, 2)), rng.choice(("instantaneous", "daily_max"))) for _ in range(rng.randint(1, 3))]
        rows.append((f"r{i:03}", few, rng.sample("uvwxyz", rng.randint(1, 3)), rng.sample(range(1, 13), rng.randint(1, 5)), rng.choice("pqr")))
    found = conflicts(spark, rows)
    assert found == every_pair(rows) and {x[2] for x in found} == {"duplicate_scope", "nested", "threshold_overlap"}


def test_rules_that_differ_in_their_ids_alone_are_compared_as_lists(spark):
    kinds = [([predicate()], "xy", [1, 2], "p"), ([predicate(threshold=2.0)], "x", [1], "q"), ([predicate(), predicate("n")], "y", [2], "p")]
    rows = [(f"r{i:03}", *kinds[i % 3]) for i in range(60)]
    rules, profiles = catalog(spark, rows), cohorts(spark)
    assert sorted(len(r.rules) for r in review.lists(review.scoped(rules, profiles), 7).collect()) == [6, 6, 6, *[7] * 6]
    assert review.lists(review.scoped(rules, profiles)).count() == 3
    for most in (1, 7, 1000):
        found = review.rule_conflicts(rules, profiles, most=most).collect()
        assert sorted((r.first_rule, r.second_rule, r.conflict, r.level, tuple(r.cities), tuple(r.months), tuple(r.conditions)) for r in found) == every_pair(rows)


def test_rules_of_unknown_profiles_and_empty_catalogs_have_no_conflicts(spark):
    assert conflicts(spark, [("a", [predicate()], "x", [1], "unknown"), ("b", [predicate()], "x", [1], "unknown")]) == []
    assert review.rule_conflicts(catalog(spark, []), cohorts(spark)).count() == 0


def configured(spark, rows, profiles=None, cities="xyz", enabled=None, weights=(), settings=None, least=1, mandatory="x"):
    one = lambda names: spark.createDataFrame([(c,) for c in names], "city_id string")
    return Configuration(catalog(spark, rows), cohorts(spark, profiles), one(cities).withColumn("enabled", F.lit(True)), spark.createDataFrame(list(weights), "city_id string, weight double"),
                         one(enabled) if enabled is not None else None, settings or {"member_count": 100}, least, one(mandatory))


def changes(old, new):
    return {(r.change, r.item) for r in review.changed_items(old, new).collect()}, review.change_impact(old, new).first().asDict()


RULES = [("a", [predicate()], "x", [1, 2], "p"), ("b", [predicate("n")], "y", [3], "q"), ("c", [predicate("k")], "z", [4], "r")]


def test_one_more_city_of_a_rule(spark):
    old = configured(spark, RULES)
    new = configured(spark, [("a", [predicate()], "xw", [1, 2], "p"), *RULES[1:]], cities="xyzw", weights=[("w", 3.0), ("x", 2.0)])
    found, row = changes(old, new)
    assert found == {("changed_rule", "a"), ("added_city", "w"), ("affected_city", "x"), ("affected_city", "w")}
    assert (row["rules_changed"], row["cities_added"], row["scopes_added"], row["scopes_removed"], row["links_added"], row["cities_affected"]) == (1, 1, 2, 0, 4, 2)
    assert row["estimated_members"] == 71 and not row["policy_changed"] and not row["settings_changed"]


def test_a_profile_that_changes_marks_its_rules(spark):
    old, new = configured(spark, RULES), configured(spark, RULES, {**PROFILES, "q": ("asthma", "heart")})
    found, row = changes(old, new)
    assert found == {("changed_rule", "b"), ("affected_city", "y")} and (row["links_added"], row["scopes_added"], row["bands_added"]) == (1, 0, 0)
    assert row["estimated_members"] == 33


def test_settings_affect_all_cities_and_policy_is_flagged(spark):
    old = configured(spark, RULES)
    new = configured(spark, RULES[:2], settings={"member_count": 200}, mandatory="y")
    found, row = changes(old, new)
    assert found == {("removed_rule", "c"), *(("affected_city", c) for c in "xyz")}
    assert row["settings_changed"] and row["policy_changed"] and row["estimated_members"] == 200 and row["rules_removed"] == row["bands_removed"] == row["scopes_removed"] == row["links_removed"] == 1


def test_nothing_changes_and_no_city_is_left(spark):
    old = configured(spark, RULES)
    found, row = changes(old, old)
    assert not found and not any(row.values())
    found, row = changes(old, configured(spark, [], cities="xyz", enabled=""))
    assert row["estimated_members"] == 0 and row["rules_removed"] == 3 and row["cities_removed"] == 3


def test_policy_names_what_is_not_there(spark):
    found = review.policy_violations(configured(spark, RULES, cities="xxyz", enabled="xyv", weights=[("u", 1.0), ("z", 2.0)], least=3, mandatory="xz")).collect()
    assert {(r.violation, r.value) for r in found} == {("repeated_city", "x"), ("unknown_enabled_city", "v"), ("unknown_weighted_city", "u"), ("unknown_mandatory_city", "z"), ("minimum_above_cities", "3 of 2")}
    assert review.policy_violations(configured(spark, RULES)).count() == 0
