from collections import Counter

from retailmarts.operators import quality as Q
from tests.conftest import rows


def test_declared_checks():
    assert Counter(c.test for c in Q.CHECKS) == {"not_null": 31, "unique": 8, "accepted_values": 4}


def test_violations(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None), (None, "x"), (None, "zz")], "k string, v string")
    assert Q.null_rows(df, "k").count() == 2
    assert rows(Q.duplicate_keys(df, "k")) == [("a", 2)]
    assert rows(Q.unexpected_values(df, "v", ["x", "y"])) == [("zz", 1)]
    checks = [Q.Check("t", "k", "not_null"), Q.Check("t", "k", "unique"), Q.Check("t", "v", "accepted_values", ("x",))]
    findings = Q.report(Q.run_checks({"t": df}, checks))
    assert rows(findings) == [
        ("t", "k", "not_null", 2, "fail"), ("t", "k", "unique", 1, "fail"), ("t", "v", "accepted_values", 2, "fail")]
    good = spark.createDataFrame([("a", "x"), ("b", "x")], "k string, v string")
    assert {r.status for r in Q.report(Q.run_checks({"t": good}, checks)).collect()} == {"pass"}


def test_primary_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("", 1), (None, 1)], "k string, n bigint")
    assert rows(Q.primary_key_findings({"t": df}, {"t": ("k", "n")}).select("table_name", "null_keys",
                                                                           "duplicate_keys")) == [("t", 2, 1)]


def test_null_rates_and_prices(spark):
    df = spark.createDataFrame([(1.0,), (None,), (0.0,), (-1.0,)], "price double")
    assert rows(Q.null_rates(df, "price")) == [("price", 4, 1, 25.0)]
    assert Q.non_positive_prices(df).count() == 2
    assert rows(Q.null_rates(df.limit(0), "price")) == [("price", 0, 0, None)]
