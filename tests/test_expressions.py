import csv
import datetime
import io
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings as hsettings
from hypothesis import strategies as st

from retailmarts.functions import columns, once
from retailmarts.functions import exact as E
from retailmarts.functions import labels as L
from retailmarts.functions import text as X


def values(spark, column_type, inputs, **expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {column_type}")
    got = df.select("i", *columns(**expressions)).orderBy("i").collect()
    return [tuple(r)[1:] if len(expressions) > 1 else r[1] for r in got]


def test_strip_is_unicode_strip(spark):
    every = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    assert sorted(X.WHITESPACE) == sorted(every)
    inputs = [f"{c}a {c}b{c}" for c in every] + ["\ta \r", "", "   ", None]
    got = values(spark, "string", inputs, v=X.text(X.stripped("c")))
    assert got == [(v or "").strip() for v in inputs]


def test_numbers(spark):
    inputs = ["12", "-3", "+4", "1.5", "5d", "nan", "Infinity", "1e3", "1e400", "", None, ".5", "5.", "0x1A",
              "1_0", "9223372036854775808", "abc"]
    whole = [12, -3, 4] + [None] * 14
    real = [12.0, -3.0, 4.0, 1.5, None, None, None, 1000.0, None, None, None, 0.5, 5.0, None, None,
            9223372036854775808.0, None]
    got = values(spark, "string", inputs, w=X.to_bigint("c"), d=X.to_double("c"))
    assert [g[0] for g in got] == whole
    assert [g[1] for g in got] == real


def test_instants(spark):
    t = datetime.datetime
    inputs = {
        "2018-01-02 03:04:05": t(2018, 1, 2, 3, 4, 5),
        "2018-1-2 3:4:5": t(2018, 1, 2, 3, 4, 5),
        "2018-01-02 03:04:05.250": t(2018, 1, 2, 3, 4, 5, 250000),
        "2018-01-02 03:04:05 and more": t(2018, 1, 2, 3, 4, 5),
        "2018-02-30 10:00:00": None,
        "2018-13-01 10:00:00": None,
        "2018-01-02T03:04:05": None,
        "2018-01-02": None,
        "muito bom": None,
        "": None,
    }
    assert values(spark, "string", list(inputs), v=X.to_instant("c")) == list(inputs.values())


def test_delay_rounds_elapsed_days_down(spark):
    estimate = datetime.datetime(2018, 1, 10)
    second = datetime.timedelta(seconds=1)
    day = datetime.timedelta(days=1)
    arrivals = [estimate - second, estimate, estimate + day - second, estimate + day, estimate - day, None]
    df = spark.createDataFrame([(i, a, estimate) for i, a in enumerate(arrivals)],
                               "i int, d timestamp, e timestamp")
    got = df.select("i", *columns(v=L.delay_days("d", "e"))).orderBy("i").collect()
    assert [r.v for r in got] == [-1, 0, 0, 1, -1, None]


def test_labels(spark):
    kinds = ["credit_card", "boleto", "voucher", "debit_card", "not_defined", "", None]
    assert values(spark, "string", kinds, v=L.payment_label("c")) == [
        "Credit Card", "Boleto", "Voucher", "Debit Card", "not_defined", "", "Unknown"]
    assert values(spark, "double", [50000.0, 49999.99, 10000.0, 1000.0, 999.99, None], v=L.seller_tier("c")) == [
        "Platinum", "Gold", "Gold", "Silver", "Bronze", "Bronze"]
    assert values(spark, "double", [5.0, 5.1, 15.0, 25.0, 25.1, None], v=L.delivery_grade("c")) == [
        "Excellent", "Good", "Good", "Needs Improvement", "Poor", "Poor"]


def test_category_label_skips_blanks(spark):
    pairs = [("toys", "brinquedos"), ("", "brinquedos"), (None, "brinquedos"), ("", ""), (None, None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, e string, p string")
    got = df.select("i", *columns(v=L.category_label("e", "p"))).orderBy("i").collect()
    assert [r.v for r in got] == ["toys", "brinquedos", "brinquedos", "unknown", "unknown"]


def half_away(num, den, digits):
    if den == 0:
        return None
    exact = Decimal(num) / Decimal(den)
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0


def test_rounding_is_exact_and_away_from_zero(spark):
    rnd = random.Random(7)
    pairs = [(5, 1000), (-5, 1000), (25, 1000), (1, 8), (-1, 8), (0, 3), (3, 0), (1005, 1000)]
    pairs += [(rnd.randint(-10**12, 10**12), rnd.randint(1, 10**6)) for _ in range(500)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    got = df.select("i", *columns(m1=E.mean_1dp("a", "b"), m2=E.mean_2dp("a", "b"), p=E.percent("a", "b"),
                                  money=E.money("a"), mean=E.mean_money("a", "b"))).orderBy("i").collect()
    for r, (a, b) in zip(got, pairs):
        assert r.m1 == half_away(a, b, 1)
        assert r.m2 == half_away(a, b, 2)
        assert r.p == half_away(100 * a, b, 1)
        assert r.money == half_away(a, E.UNITS, 2)
        assert r["mean"] == half_away(a, b * E.UNITS, 2)


def test_money_units(spark):
    assert values(spark, "double", [0.1, 1.005, -2.5, 0.0, None, float("nan")], v=E.units("c")) == [
        1000, 10050, -25000, 0, None, None]


def test_sum_does_not_depend_on_order(spark):
    amounts = [0.1] * 1000 + [1e11] + [-1e11]
    for order in (amounts, amounts[::-1]):
        df = spark.createDataFrame([(a,) for a in order], "c double").repartition(3)
        assert df.agg(*columns(v=E.money(f"sum({E.units('c')})"))).head().v == 100.0


def python_fields(record):
    return next(csv.reader(io.StringIO(record), doublequote=True), [])


RECORDS = [
    "a,b,c", "a,,", ",,", 'a,"b,c",d', 'a,"b ""q"" c",d', 'a,5" screen,b', '"a"z,b', '"open,b,c', 'x, "y",z',
    '"",a', '""",""",b', 'a,"multi, comma, text",2018-01-01 00:00:00',
]


def test_csv_fields_known(spark):
    assert values(spark, "string", RECORDS, v=X.csv_fields("c")) == [python_fields(r) for r in RECORDS]


@hsettings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet='ab", ;', min_size=1, max_size=14), min_size=20, max_size=60))
def test_csv_fields_like_csv_module(spark, records):
    assert values(spark, "string", records, v=X.csv_fields("c")) == [python_fields(r) for r in records]


def test_csv_fields_of_a_long_record(spark):
    record = "x," + '"' + 'a""b,' * 50_000 + '"' + ",tail" + ",w" * 30_000
    got = spark.createDataFrame([(record,)], "c string").select(
        *columns(n=f"size({X.csv_fields('c')})", last=f"element_at({X.csv_fields('c')}, 3)")).head()
    assert (got.n, got["last"]) == (30_003, "tail")


def test_once_is_a_barrier(spark):
    df = spark.range(3).select("*", once(v="md5(string(id))")).where("v > 'a'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") == 1


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_with_and_without_ansi(spark, settings, ansi):
    settings(ansi__enabled=ansi)
    assert values(spark, "string", ["1.5", "x", "2"], v=X.to_bigint("c")) == [None, None, 2]
    assert values(spark, "bigint", [0, 1], v=E.percent("c", "c")) == [None, 100.0]
