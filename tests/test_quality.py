from datetime import datetime, timedelta

import pytest

from tests.conftest import rows
from tierweave.operators import quality as q
from tierweave.plans.suites import SUITES
from tierweave.plans.tables import SILVER, SPECS

SCHEMA = "id INT, name STRING, phone STRING, email STRING, amount DOUBLE, is_active BOOLEAN, updated_at TIMESTAMP"
NOW = datetime.now()
OLD = NOW - timedelta(days=5)
GOOD = [
    (1, "anna", "0123456789", None, 5.0, True, NOW),
    (2, "bert", None, "b@example.com", 6.0, True, NOW),
    (3, None, "0123456789", "c@example.com", None, True, OLD),
]
BAD = [
    (1, "al", None, None, -1.0, True, OLD),
    (1, "berta-and-more", "12", "nonsense", 0.0, True, OLD),
    (None, "odd", "0123456789", "c@example.com", 50.0, True, NOW),
]
EMAIL = r"^\S+@\S+$"


def cases():
    """Rule, violations among the bad rows, metric of the bad rows."""
    return [
        (q.complete("id")[0], 1, 2 / 3),
        (q.any_complete("phone", "email"), 1, 2 / 3),
        (q.unique("id"), 2, 0.0),
        (q.unique("id", "is_active"), 2, 1 / 3),
        (q.one_active("id"), 2, 0.0),
        (q.contained("name", ("anna", "bert", "odd")), 2, 1 / 3),
        (q.at_least("amount", 5), 2, -1.0),
        (q.above("amount", 4), 2, -1.0),
        (q.at_most("amount", 6), 1, 50.0),
        (q.min_length("name", 3), 1, 2.0),
        (q.max_length("name", 10), 1, 14.0),
        (q.positive("amount")[0], 2, 1 / 3),
        (q.non_negative("amount")[0], 1, 2 / 3),
        (q.matches("email format", "email", EMAIL), 1, 2 / 3),
        (q.satisfies("amount known", "amount > -1 OR amount IS NULL"), 1, 2 / 3),
        (q.satisfies("mostly", "amount >= 0 OR amount IS NULL", least=0.9), 1, 2 / 3),
        (q.fresh(), 2, 1 / 3),
    ]


def test_every_rule_passes_and_fails(spark):
    good, bad = spark.createDataFrame(GOOD, SCHEMA), spark.createDataFrame(BAD, SCHEMA)
    rules = [rule for rule, _, _ in cases()]
    passed = {r.rule: r for r in q.evaluate(good, rules).collect()}
    failed = {r.rule: r for r in q.evaluate(bad, rules).collect()}
    assert len(passed) == len(failed) == len(rules)
    for rule, violations, metric in cases():
        assert passed[rule.name].passed, rule.name
        line = failed[rule.name]
        assert (line.passed, line.violations, line.kind) == (False, violations, rule.kind), rule.name
        assert line.metric == pytest.approx(metric), rule.name


def test_null_outcome_fails_a_predicate_but_not_a_sign_rule(spark):
    df = spark.createDataFrame(GOOD, SCHEMA)
    report = q.evaluate(df, [q.satisfies("p", "amount > 0"), *q.positive("amount")])
    assert {r.rule: r.violations for r in report.collect()} == {"p": 1, "amount is positive": 0}


def test_share_threshold(spark):
    df = spark.range(100).selectExpr("id")
    report = q.evaluate(df, [q.satisfies("a", "id >= 2", least=0.98), q.satisfies("b", "id >= 3", least=0.98)])
    assert {r.rule: r.passed for r in report.collect()} == {"a": True, "b": False}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report = {r.rule: r.passed for r in q.evaluate(empty, [q.not_empty(), q.at_least("amount", 0), q.unique("id"), *q.complete("id")]).collect()}
    assert report == {"table is not empty": False, "min amount >= 0": False, "id is unique": True, "id is complete": True}


def test_row_rules_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(GOOD, SCHEMA).write.parquet(path)
    df = spark.read.schema(SCHEMA).parquet(path)
    row_rules = [rule for rule, _, _ in cases() if not rule.unique]
    plan = q.evaluate(df, row_rules)._jdf.queryExecution().executedPlan().toString()
    assert len(row_rules) > 10 and plan.count("FileScan") == 1


def test_two_table_rules(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    dim = spark.createDataFrame([(1,), (1,), (3,)], "id INT")
    assert rows(q.resolves(facts, dim, "k", "id"), "checked", "violations", "passed") == [(3, 1, False)]
    assert rows(q.resolves(facts.where("k = 1"), dim, "k", "id"), "passed") == [(True,)]
    both = q.resolves_each(facts.selectExpr("k", "CAST(NULL AS INT) AS none", "k + 1 AS next"), [("k", dim, "id"), ("none", dim, "id"), ("next", dim.where("false"), "id")])
    assert rows(both, "rule", "checked", "violations", "metric", "passed") == [("k resolves to id", 3, 1, 1 - 1 / 3, False), ("next resolves to id", 3, 3, 0.0, False), ("none resolves to id", 0, 0, 1.0, True)]
    assert rows(q.same_size(facts, dim), "checked", "violations", "metric", "passed") == [(4, 1, 3.0, False)]
    assert rows(q.same_size(dim, dim), "passed") == [(True,)]


def test_schema_differences(spark):
    ddl = SILVER["stations"]
    df = spark.createDataFrame([], ddl)
    assert q.schema_differences(df, ddl) == []
    other = df.selectExpr("sk_id", "string(id) AS id", "name", "city", "code", "1 AS extra")
    assert q.schema_differences(other, ddl) == [
        "extra: declared nothing, found int",
        "id: declared int, found string",
        "is_deleted: declared boolean, found nothing",
    ]


def test_gate_levels(spark):
    df = spark.createDataFrame(BAD, SCHEMA)
    warning = q.evaluate(df, [r.warn() for r in q.complete("id")])
    assert [r.passed for r in q.gate(warning)] == [False]
    with pytest.raises(q.QualityError, match="id is complete: 1 of 3"):
        q.gate(warning, strict=True)
    with pytest.raises(q.QualityError):
        q.gate(q.evaluate(df, q.complete("id")))


def test_suites_fit_their_tables(spark):
    """Every rule refers to declared columns only; 13 suites hold 198 rules."""
    sizes = {}
    for (layer, name), suite in SUITES.items():
        rules = suite()
        report = q.evaluate(spark.createDataFrame([], SPECS[layer, name].ddl), rules)
        assert report.columns == ["rule", "kind", "level", "checked", "violations", "metric", "passed"]
        assert len({r.name for r in rules}) == len(rules), name
        sizes[suite] = len(rules)
    assert len(sizes) == 13 and sum(sizes.values()) == 198
