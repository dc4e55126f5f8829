"""Deliveries of several part files settle as wholes."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from retailmarts.streaming import ingest
from tests.conftest import SF, rows

GEO = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


def settled(spark, tmp_path, table, *deliveries):
    """Price or latitude of the current rows; a delivery is {file: lines}, "" for the landing folder itself."""
    landing, header = tmp_path / "land ing", GEO if table == "geolocation" else ITEMS
    for n, (folder, files) in enumerate(deliveries):
        (landing / folder).mkdir(parents=True, exist_ok=True)
        for name, lines in files.items():
            path = landing / folder / name
            path.write_text(header + "".join(f"{x}\n" for x in lines))
            os.utime(path, (1_600_000_000 + n, 1_600_000_000 + n))
        ingest.ingest(spark, table, str(landing), str(tmp_path / "t"), str(tmp_path / "c"))
    value = "geolocation_lat" if table == "geolocation" else "price"
    return sorted(r[value] for r in ingest.current(spark, table, str(tmp_path / "t")).collect())


def item(price, key="o,1"):
    return f"{key},p,s,,{price},1"


def test_rows_of_a_key_in_several_files_stay(spark, tmp_path):
    first = {"a.csv": [item(1), item(2)], "b.csv": [item(3), item(9, "x,1"), item(8, ",")]}
    assert settled(spark, tmp_path, "order_items", ("d1", first)) == [1, 2, 3, 8, 9]


def test_the_last_delivery_of_a_key_counts(spark, tmp_path):
    first = {"a.csv": [item(1), item(2)], "b.csv": [item(3), item(9, "x,1")]}
    second = {"a.csv": [item(1), item(2)], "b.csv": [item(4)]}  # one file as before, one new
    again = {"c.csv": [item(1), item(3), item(2), item(9, "x,1")]}  # the first, cut otherwise
    part = {"z.csv": second["b.csv"]}
    assert settled(spark, tmp_path, "order_items", ("d1", first), ("d2", second), ("", part)) == [1, 2, 4, 9]
    assert settled(spark, tmp_path / "b", "order_items", ("d1", first), ("", part), ("d2", second)) == [1, 2, 4, 9]
    assert settled(spark, tmp_path / "c", "order_items", ("d1", first), ("d2", again)) == [1, 2, 3, 9]


def test_a_table_without_a_key(spark, tmp_path):
    a, b = ["1,1,1,c,s", "1,1,1,c,s"], ["1,5,1,c,s"]
    first = {"a.csv": a, "a2.csv": a, "b.csv": b}  # equal part files of one delivery are all meant
    assert settled(spark, tmp_path, "geolocation", ("d1", first), ("d2", {"x.csv": a + b + a}), ("", {"y.csv": b})) == [
        1, 1, 1, 1, 5,
    ]


def test_queries_with_many_part_files(spark, monkeypatch):
    lines = entry.R.damaged_lines
    monkeypatch.setattr(entry.R, "damaged_lines", lambda *a: lines(*a).repartition(7, F.rand(1)))
    for name, table in (("stream_ingest_items", "order_items"), ("stream_ingest_geolocation", "geolocation")):
        want = entry.raw.parse(entry.raw.scan_lines(lines(spark, SF, table), table), table)
        assert rows(entry.queries()[name](spark, SF)) == rows(want)
