import datetime

import pytest

from retailmarts.plans.load import build, landed, load_all, load_raw
from retailmarts.sources import layers, raw
from tests.conftest import rows

HEADER = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
LINES = [
    "a,1,credit_card,3,10.50",
    "b,1,boleto,1",                       # one field too few
    "c,1,boleto,1,5,extra",               # one too many
    '"d, ""x""",1,voucher,2,7',           # quoted comma and quotes
    " \te ,  2 , boleto ,1.5, 1e3 ",      # padding; 1.5 is no whole number
    "f,,,,",                              # blanks
    "g,x,boleto,2,5d",                    # garbage
    "",                                   # no record at all
]
GOOD = [
    ("a", 1, "credit_card", 3, 10.5),
    ('d, "x"', 1, "voucher", 2, 7.0),
    ("e", 2, "boleto", None, 1000.0),
    ("f", None, "", None, None),
    ("g", None, "boleto", 2, None),
]


def write(path, lines, header=HEADER):
    path.write_text(header + "\n".join(lines) + "\n")
    return str(path)


def test_file_scan(spark, tmp_path):
    path = write(tmp_path / "payments.csv", LINES)
    assert rows(raw.read_raw(spark, "payments", path)) == sorted(GOOD, key=repr)


def test_every_file_has_its_own_header(spark, tmp_path):
    for n in range(3):
        write(tmp_path / f"part{n}.csv", LINES)
    assert raw.read_raw(spark, "payments", str(tmp_path)).count() == 3 * len(GOOD)


def test_arity_is_checked_whatever_is_selected(spark, tmp_path):
    path = write(tmp_path / "payments.csv", LINES)
    assert rows(raw.read_raw(spark, "payments", path).select("order_id")) == sorted(
        [(g[0],) for g in GOOD], key=repr)
    assert raw.read_raw(spark, "payments", path).count() == len(GOOD)


def test_lines_parse_like_files(spark, tmp_path):
    lines = spark.createDataFrame([(x,) for x in LINES], "line string")
    assert rows(raw.parse(raw.scan_lines(lines, "payments"), "payments")) == sorted(GOOD, key=repr)


def test_rejects(spark, tmp_path):
    path = write(tmp_path / "payments.csv", [*LINES, "z" * 200])
    assert rows(raw.rejects(raw.scan(spark, "payments", path), "payments")) == [
        ("payments", "b,1,boleto,1"), ("payments", "c,1,boleto,1,5,extra"), ("payments", "z" * 80)]


def test_strict_load(spark, tmp_path):
    path = write(tmp_path / "payments.csv", LINES)
    report = raw.load_report(raw.check_load(raw.scan(spark, "payments", path), "payments"), "payments")
    # Bad: the surplus field, 1.5 and x as whole numbers; the short row and the blanks are fine.
    assert rows(report) == [("payments", 4, 3, 0, False)]
    root = str(tmp_path / "wh")
    with pytest.raises(raw.BadRecordBudgetExceeded):
        load_raw(spark, root, "payments", path)
    loaded = load_raw(spark, root, "payments", path, max_bad=3)
    assert rows(loaded.select("order_id", "payment_value")) == [
        ("a", 10.5), ("b", None), ('d, "x"', 7.0), ("f", None)]


def test_failed_load_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "wh")
    load_raw(spark, root, "payments", write(tmp_path / "good.csv", LINES[:1]))
    with pytest.raises(raw.BadRecordBudgetExceeded):
        load_raw(spark, root, "payments", write(tmp_path / "bad.csv", LINES))
    assert layers.read_table(spark, root, "raw", "payments").count() == 1
    load_raw(spark, root, "payments", write(tmp_path / "good.csv", LINES[:1]))
    assert layers.read_table(spark, root, "raw", "payments").count() == 1


def test_missing_required_key_is_bad(spark, tmp_path):
    path = write(tmp_path / "payments.csv", [",1,boleto,1,5"])
    checked = raw.check_load(raw.scan(spark, "payments", path), "payments")
    assert [r._bad for r in checked.collect()] == [True]


def test_quoted_line_breaks(spark, tmp_path):
    header = "review_id,order_id,review_score,review_comment_title,review_comment_message,created,answered\n"
    path = write(tmp_path / "reviews.csv", ['r1,o1,5,,"first\nsecond, third",d1,d2', "r2,o2,4,,ok,d1,d2"], header)
    got = rows(raw.check_load(raw.scan(spark, "reviews", path), "reviews"))
    assert got[0][4] == "first\nsecond, third"
    assert [g[-1] for g in got] == [False, False]
    report = raw.load_report(raw.check_load(raw.scan(spark, "reviews", path), "reviews"), "reviews")
    assert rows(report) == [("reviews", 2, 0, 500, True)]


ORDERS = [
    (f"o{m}{i}", "c", "delivered" if i % 2 else "shipped", datetime.datetime(2018, m, 1 + i)) + (None,) * 4
    for m in (1, 2, 3) for i in range(10)
]


def orders(spark):
    from retailmarts.sources.schemas import RAW

    return spark.createDataFrame(ORDERS, RAW["orders"].schema)


def test_month_partitions_are_pruned(spark, tmp_path):
    root = str(tmp_path)
    layers.write_clustered(orders(spark), root, "raw", "orders", ("order_status",), "order_purchase_timestamp")
    table = layers.read_table(spark, root, "raw", "orders")
    some = layers.between(table, "order_purchase_timestamp", "2018-01-05 00:00:00", "2018-02-03 00:00:00")
    assert some.count() == 6 + 3
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
    assert len(some.inputFiles()) >= 1
    assert {r.order_month for r in some.select("order_month").distinct().collect()} == {"2018-01", "2018-02"}


def test_overwrite_is_idempotent(spark, tmp_path):
    for _ in range(2):
        layers.write_table(orders(spark), str(tmp_path), "raw", "orders")
    assert layers.read_table(spark, str(tmp_path), "raw", "orders").count() == len(ORDERS)


def test_layers(spark):
    assert layers.layer_name(None) == "staging"
    assert layers.layer_name(" mart ") == "mart"
    published = layers.publish_table(orders(spark).select("order_id"), "mart", "some_orders")
    assert published.count() == len(ORDERS)
    assert spark.table("mart.some_orders").count() == len(ORDERS)
    assert layers.publish_view(orders(spark), "orders_view").count() == len(ORDERS)


def test_quoted_csv(spark, tmp_path):
    tricky = [('a "quoted", comma', "", None, "x", "ST")]
    df = spark.createDataFrame(tricky, "customer_id string, customer_unique_id string,"
                               " customer_zip_code_prefix string, customer_city string, customer_state string")
    path = layers.write_quoted_csv(df.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()
    assert text[1] == '"a ""quoted"", comma","","","x","ST"'
    assert rows(raw.read_raw(spark, "customers", path)) == [('a "quoted", comma', "", "", "x", "ST")]


FILES = {
    "orders": "o1,c1,delivered,2018-01-05 10:00:00,,,2018-01-09 00:00:00,2018-01-10 00:00:00",
    "order_items": "o1,1,p1,s1,2018-01-06 00:00:00,10.5,1.5",
    "payments": "o1,1,boleto,1,12",
    "reviews": 'r1,o1,5,,"good, really",2018-01-10 00:00:00,2018-01-11 00:00:00',
    "customers": "c1,u1,01000,city,SP",
    "products": "p1,brinquedos,1,1,1,1.0,1.0,1.0,1.0",
    "sellers": "s1,02000,city,RJ",
    "geolocation": "01000,-23.5,-46.6,city,SP",
    "category_translation": "brinquedos,toys",
}


@pytest.fixture
def landing(tmp_path):
    from retailmarts.sources.schemas import RAW

    (tmp_path / "in").mkdir()
    for table, line in FILES.items():
        write(tmp_path / "in" / f"{table}.csv", [line], ",".join(RAW[table].names) + "\n")
    return str(tmp_path / "in")


def test_load_all(spark, tmp_path, landing):
    counts = load_all(spark, str(tmp_path / "wh"), landing)
    assert rows(counts) == [(t, 1) for t in sorted(FILES)]
    assert layers.read_table(spark, str(tmp_path / "wh"), "raw", "orders").head().order_month == "2018-01"


def test_build_from_files(spark, tmp_path, landing):
    tables = build(spark, landed(spark, landing), str(tmp_path / "wh"))
    assert tables["stg_order_items"].head().category_display == "toys"
    assert tables["stg_geolocation"].head().zip_code_prefix == "01000"  # the leading zero stays
    seller = tables["mart_seller_performance"].head()
    assert (seller.seller_id, seller.total_gmv_brl, seller.top_category) == ("s1", 12.0, "toys")
    assert tables["mart_delivery_performance"].head().early_deliveries == 1
    assert tables["mart_geo_sales"].head().state_lat == -23.5


def test_command_line(spark, tmp_path, landing, capsys):
    from retailmarts.__main__ import main

    root = str(tmp_path / "wh")
    main(["load", landing, root])
    main(["build", landing, root])
    main(["check", root])
    main(["repair-reviews", f"{landing}/reviews.csv", str(tmp_path / "clean")])
    (tmp_path / "drop").mkdir()
    write(tmp_path / "drop" / "1.csv", [FILES["orders"]])
    main(["ingest", "orders", str(tmp_path / "drop"), root])
    assert spark.read.parquet(f"{root}/landed/orders").count() == 1
    shown = capsys.readouterr().out
    assert "category_translation" in shown and "not_null" in shown and "recovery_rate" in shown


def test_the_filter_of_oversize_amounts_does_not_convert_them_again(spark):
    lines = spark.createDataFrame(
        [(f"o,1,p,s,,{x},{y}",) for x, y in [
            ("99999999999999", "1"), ("100000000000000", "1"), ("1", " 1e14 "), ("-1e14", ""), ("1e400", "2"), ("nan", "3"),
            ("0000000000000000004", "x"), ("1e13", "1e-9"),
        ]], "line string",
    ).union(spark.createDataFrame([("o,1,p",), ("",)], "line string"))
    found = raw.parse(raw.scan_lines(lines, "order_items"), "order_items")
    assert found.columns == raw.RAW["order_items"].names
    assert sorted(map(str, ((r.price, r.freight_value) for r in found.collect()))) == sorted(map(str, [
        (99999999999999.0, 1.0), (None, 2.0), (None, 3.0), (4.0, None), (1e13, 1e-9),
    ]))
    filters = [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x]
    assert filters and not any("RLIKE" in x or "try_cast" in x.lower() for x in filters)
