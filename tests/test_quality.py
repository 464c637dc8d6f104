"""Each assertion kind against a table with known violations."""

from pyspark.sql import functions as F

from shelfwise.operators import quality as Q


def test_kinds(spark):
    t = spark.createDataFrame(
        [(1, "a", "x", 5.0), (1, "b", "y", -1.0), (None, "c", "bad", 101.0), (3, None, None, None)],
        "k int, name string, status string, pct double")
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    tables = {"t": t, "p": parent}
    checks = [Q.Check("t", "not_null", ("k",)), Q.Check("t", "unique", ("k",)),
              Q.Check("t", "unique_combination", ("k", "name")),
              Q.Check("t", "accepted_values", ("status",), values=("x", "y")),
              Q.Check("t", "accepted_range", ("pct",), min_value=0, max_value=100),
              Q.Check("t", "relationships", ("name",), to_table="p", to_field="name")]
    got = {r.check_name: r.n_violations for r in Q.summary(tables, checks).collect()}
    assert got == {"not_null": 1, "unique": 1, "unique_combination": 0, "accepted_values": 1,
                   "accepted_range": 2, "relationships": 1}
    # row-level forms agree with the summary
    for ch in checks:
        assert ch.violations(tables).count() == got[ch.kind]


def test_suite_has_51_checks():
    kinds = {}
    for ch in Q.SUITE:
        kinds[ch.kind] = kinds.get(ch.kind, 0) + 1
    assert kinds == {"not_null": 36, "unique": 4, "unique_combination": 2, "accepted_values": 3,
                     "accepted_range": 4, "relationships": 2}


def test_assert_clean_raises(spark):
    t = spark.createDataFrame([(None,)], "k int")
    try:
        Q.assert_clean({"t": t}, [Q.Check("t", "not_null", ("k",))])
    except AssertionError as e:
        assert "t.k not_null=1" in str(e)
    else:
        raise AssertionError("expected failure")


def test_row_level_checks_fold_into_one_aggregate(spark):
    t = spark.createDataFrame([(1, 2)], "a int, b int")
    s = Q.summary({"t": t}, [Q.Check("t", "not_null", ("a",)), Q.Check("t", "not_null", ("b",)),
                             Q.Check("t", "accepted_range", ("a",), min_value=0, max_value=1)])
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
