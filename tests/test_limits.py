"""Records of any width, lossless ingestion, large amounts, row order, layout and shuffles."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from retailmarts.operators import rollups
from retailmarts.plans import enrich, load, staging
from retailmarts.session import shared_dir
from retailmarts.sources import layers, raw
from retailmarts.streaming import ingest
from tests.conftest import SF, rows

HEADER = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
GEO = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_a_very_wide_line_is_one_reject(spark, tmp_path):
    wide = "," * 25_000
    text = HEADER + f"a,1,boleto,1,10\n{wide}\nb,1,boleto,1,{'9' * 3}\n" + "x" * 300_000 + "\n"
    path = write(tmp_path / "p.csv", text)
    assert [r.order_id for r in raw.read_raw(spark, "payments", path).orderBy("order_id").collect()] == ["a", "b"]
    assert raw.rejects(raw.scan(spark, "payments", path), "payments").count() == 2
    landing = tmp_path / "landing"
    landing.mkdir()
    write(landing / "p.csv", text)
    ingest.ingest(spark, "payments", str(landing), str(tmp_path / "t"), str(tmp_path / "c"))
    assert ingest.current(spark, "payments", str(tmp_path / "t")).count() == 2


@pytest.mark.parametrize("filler", ["", ', "' + "," * 30_000 + '"'])
def test_text_after_a_quote_reads_the_same_at_any_size(spark, filler):
    line = f'a,1,"b"z{filler},1,2' if not filler else 'a,1,"b"z' + ',"' + "," * 30_000 + '",2'
    df = spark.createDataFrame([(line,)], "line string")
    assert raw.parse(raw.scan_lines(df, "payments"), "payments").first()["payment_type"] == "bz"


def ingested(spark, tmp_path, table, *files):
    landing = tmp_path / "landing"
    landing.mkdir()
    for n, text in enumerate(files):
        write(landing / f"{n}.csv", text)
    ingest.ingest(spark, table, str(landing), str(tmp_path / "t"), str(tmp_path / "c"))
    return rows(ingest.current(spark, table, str(tmp_path / "t")))


def test_no_row_is_lost_and_redelivery_settles(spark, tmp_path):
    body = ITEMS + "".join(f"o1,x{i},p,s,,1,{i}\n" for i in range(5)) + "".join(f",{i},p,s,,1,1\n" for i in range(4))
    body += "o2,1,p,s,,1,1\no2,1,p,s,,1,2\n"
    want = rows(raw.parse(raw.scan(spark, "order_items", write(tmp_path / "one.csv", body)), "order_items"))
    assert len(want) == 11
    assert ingested(spark, tmp_path, "order_items", body, body) == want


def test_a_table_without_a_key_keeps_its_rows(spark, tmp_path):
    body = GEO + "".join(f"{i % 3},{i % 5}.5,1,c,s\n" for i in range(50))
    want = rows(raw.parse(raw.scan(spark, "geolocation", write(tmp_path / "one.csv", body)), "geolocation"))
    assert ingested(spark, tmp_path, "geolocation", body, body) == want and len(want) == 50


def test_ingested_files_reach_a_build(spark, tmp_path):
    for table in ("orders", "customers"):
        landing = tmp_path / table
        landing.mkdir()
        lines = {
            "orders": "h\n" + "o1,c1,delivered,2018-01-05 00:00:00,,,,\n",
            "customers": "h\n" + "c1,u1,123,city,SP\n",
        }
        write(landing / "f.csv", lines[table])
        target = layers.table_path(str(tmp_path / "root"), "landed", table)
        ingest.ingest(spark, table, str(landing), target, target + "__progress")
    tables = load.ingested(spark, str(tmp_path / "root"))
    assert load.enriched_tables(tables)["orders_enriched"].first()["customer_state"] == "SP"


def test_totals_are_rounded_once(spark):
    prices = [(1.004996, 0.0, 1.0), (1.005, None, 1.01), (2.345678, 1.1, 3.45), (None, 1.0, None), (1e13, 0.01, 1e13 + 0.01)]
    rows_in = [("o", 1, "p", "s", None, p, f, "", "", "", "") for p, f, _ in prices]
    df = spark.createDataFrame(rows_in, (
        "order_id STRING, order_item_id BIGINT, product_id STRING, seller_id STRING, shipping_limit_date TIMESTAMP,"
        " price DOUBLE, freight_value DOUBLE, seller_state STRING, seller_city STRING, product_category_name STRING,"
        " product_category_name_english STRING"
    ))
    got = sorted(r["total_item_value"] for r in staging.stg_order_items(df).collect())
    assert got == sorted(t for _, _, t in prices if t is not None)
    # Sums beyond 9.2e14 keep their cents.
    many = df.where("price = 1e13").crossJoin(spark.range(1000))
    assert rollups.order_values(staging.stg_order_items(many)).first()["total_revenue"] == 1e16


@pytest.mark.parametrize("amount", ["1e15", "1e300", "1" + "0" * 14])
def test_oversize_amounts_are_rejected_visibly(spark, amount):
    df = spark.createDataFrame([(f"a,1,boleto,1,{amount}",), ("b,1,boleto,1,99999999999999.5",)], "line string")
    records = raw.scan_lines(df, "payments")
    assert [r.order_id for r in raw.parse(records, "payments").collect()] == ["b"]
    assert rows(raw.rejects(records, "payments")) == [("payments", f"a,1,boleto,1,{amount}")]


def test_coordinates_do_not_depend_on_row_order(spark):
    points = [("z", 0.1 * i + 1e-9 * (i % 7), -3.3 * i, "c", "s") for i in range(500)]
    schema = (
        "geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE, geolocation_lng DOUBLE, geolocation_city STRING,"
        " geolocation_state STRING"
    )
    df = spark.createDataFrame(points, schema)
    shuffled = df.orderBy(F.xxhash64("geolocation_lat")).repartition(7)
    assert rows(enrich.geolocation_deduped(df)) == rows(enrich.geolocation_deduped(shuffled))


def test_load_keeps_text_and_leaves_no_scratch(spark, tmp_path):
    import os

    path = write(tmp_path / "c.csv", "h\nc1, u1 ,123,,SP\nc2,u2,1,x,y,surplus\n")
    before = set(os.listdir(os.path.dirname(shared_dir(spark, "x")))) if os.path.isdir(
        os.path.dirname(shared_dir(spark, "x"))) else set()
    got = load.load_raw(spark, str(tmp_path / "root"), "customers", path, max_bad=1).collect()
    assert [(r["customer_unique_id"], r["customer_state"]) for r in got] == [(" u1 ", "SP")]
    assert layers.read_table(spark, str(tmp_path / "root"), "rejects", "customers").count() == 1
    folder = os.path.dirname(shared_dir(spark, "x"))
    assert not [x for x in set(os.listdir(folder)) - before if x.startswith("load-")]


def test_files_of_a_clustered_table_hold_ranges(spark, tmp_path, settings):
    settings(adaptive__coalescePartitions__enabled="false")
    df = spark.range(4000).selectExpr("string(id % 100) AS seller_id", "id")
    layers.write_clustered(df, str(tmp_path), "raw", "t", ("seller_id",))
    spans = layers.read_table(spark, str(tmp_path), "raw", "t").groupBy(F.input_file_name()).agg(
        F.min("seller_id").alias("lo"), F.max("seller_id").alias("hi")
    ).orderBy("lo").collect()
    assert len(spans) > 1 and all(a["hi"] <= b["lo"] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("name, exchanges", [("mart_order_kpis", 4), ("mart_geo_sales", 5), ("kpi_customer_ltv", 3)])
def test_shuffles(spark, tmp_path, settings, name, exchanges):
    """Hash shuffles over written tables when nothing is broadcast."""
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    stg = {}
    for model in ("stg_orders", "stg_order_items", "stg_payments", "stg_geolocation"):
        entry.queries()[model](spark, SF).write.parquet(str(tmp_path / model))
        stg[model] = spark.read.parquet(str(tmp_path / model))
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    from retailmarts.plans import kpis

    df = (
        kpis.customer_ltv(stg["stg_orders"], stg["stg_order_items"]) if name.startswith("kpi")
        else load.mart_models(stg)[name]
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= exchanges


@pytest.mark.parametrize("name, key", [
    ("mart_order_kpis", lambda r: (r["order_year"], r["order_month_num"])),
    ("mart_seller_performance", lambda r: -r["total_revenue_brl"]),
    ("mart_delivery_performance", lambda r: -r["late_pct"]),
    ("mart_geo_sales", lambda r: -r["total_gmv_brl"]),
    ("mart_payment_analysis", lambda r: (r["order_year"], r["order_month"], -r["total_orders"])),
    ("row_counts", lambda r: -r["row_count"]),
])
def test_row_order(spark, name, key):
    keys = [key(r) for r in entry.queries()[name](spark, SF).collect()]
    assert keys == sorted(keys)


def test_a_build_can_register_its_models(spark, tmp_path):
    built = load.build(spark, entry._raw(spark, SF), str(tmp_path / "b"), catalog=True)
    assert spark.table("mart.mart_geo_sales").count() == built["mart_geo_sales"].count()
    assert spark.table("stg_orders").count() == built["stg_orders"].count()
    spark.sql("DROP DATABASE mart CASCADE")


def test_every_review_file_needs_its_header(spark, tmp_path):
    from retailmarts.operators import review_repair

    folder = tmp_path / "reviews"
    folder.mkdir()
    write(folder / "a.csv", "a,b,c,d,e,f,g\nx\n")
    review_repair.check_header(spark, str(folder))
    write(folder / "b.csv", "a,b,c\n1,2,3,4,5,6,7\n")
    with pytest.raises(ValueError, match="b.csv"):
        review_repair.check_header(spark, str(folder))
