"""Marts kept up to date delivery by delivery give what a full build gives."""

import pytest

from retailmarts.plans import incremental, load
from retailmarts.sources import layers, snapshots
from retailmarts.sources.schemas import RAW
from retailmarts.sources.tables import Tables
from retailmarts.streaming import ingest
from tests.conftest import rows

TABLES = {
    "orders": [
        "o1,c1,delivered,2018-01-05 10:00:00,,,2018-01-09 00:00:00,2018-01-08 00:00:00",
        "o2,c2,delivered,2018-01-07 10:00:00,,,2018-01-08 00:00:00,2018-01-08 00:00:00",
        "o3,c3,shipped,2018-02-05 10:00:00,,,,2018-02-08 00:00:00",
        "o4,c4,delivered,2018-03-05 10:00:00,,,2018-03-18 00:00:00,2018-03-08 00:00:00",
        "o5,c1,delivered,,,,2018-03-18 00:00:00,2018-03-08 00:00:00",
        "o6,c9,delivered,2018-03-09 10:00:00,,,2018-03-10 00:00:00,2018-03-18 00:00:00",
    ],
    "order_items": [
        "o1,1,p1,s1,,10.5,1", "o1,2,p2,s1,,20,2", "o2,1,p1,s2,,30,3", "o3,1,p3,s1,,40,4", "o4,1,p2,s1,,50,5",
        "o4,2,p2,s2,,60,6", "o5,1,p1,s1,,70,7", "o7,1,p1,s1,,80,8", ",1,p1,s1,,90,9",
    ],
    "payments": ["o1,1,credit_card,3,31.5", "o1,2,voucher,1,2", "o2,1,boleto,1,33", "o4,1,credit_card,2,121", "o6,1,boleto,1,5"],
    "customers": ["c1,u1,100,x,SP", "c2,u2,101,y,RJ", "c3,u3,102,x,SP", "c4,u4,103,z,SP", "c9,u9,104,z,MG"],
    "products": [f"p{i},kind{i % 2},1,1,1,1,1,1,1" for i in (1, 2, 3)],
    "sellers": ["s1,200,x,SP", "s2,201,y,RJ"],
    "geolocation": ["100,-23.5,-46.6,x,SP", "101,-22.9,-43.2,y,RJ", "104,-19.9,-43.9,z,MG"],
    "category_translation": ["kind0,even", "kind1,odd"],
    "reviews": [],
}


def tables(spark, given):
    from retailmarts.sources import raw

    def made(t):
        lines = spark.createDataFrame([(x,) for x in given.get(t, [])], "line string")
        return raw.parse(raw.scan_lines(lines, t), t)

    return Tables({t: (lambda t=t: made(t)) for t in RAW})


def full(source):
    """Every mart by a full build."""
    built = load.mart_models(load.staging_models(load.enriched_tables(source)))
    return {name: rows(built[name]) for name in incremental.MARTS}


def told(marts):
    return {name: rows(mart) for name, mart in marts.items()}


def versions(spark, root, layer, table):
    return snapshots.snapshot(spark, layers.table_path(root, layer, table)).parts


def test_deliveries_equal_a_full_build(spark, tmp_path):
    """New orders, a corrected price, an order that moves to another month, items that wait for their order."""
    root = str(tmp_path)
    first = {**TABLES, "orders": TABLES["orders"][:2] + TABLES["orders"][3:4]}
    got = incremental.refresh(spark, root, tables(spark, first))
    assert told(got) == full(tables(spark, first))
    before = {n: versions(spark, root, "facts", n) for n in incremental.FACTS}
    second = {**TABLES, "orders": [
        TABLES["orders"][0], TABLES["orders"][1], *TABLES["orders"][2:], TABLES["orders"][0].replace("o1,", "o7,").replace("-01-05", "-02-05"),
    ]}
    second["orders"][3] = second["orders"][3].replace("2018-03-05", "2018-02-11")
    second["order_items"] = [x.replace("o4,1,p2,s1,,50", "o4,1,p2,s1,,51.25") for x in TABLES["order_items"]]
    changed = spark.createDataFrame([(f"o{i}",) for i in (3, 4, 5, 6, 7)] + [(None,)], "order_id string")
    got = incremental.refresh(spark, root, tables(spark, second), changed)
    assert told(got) == full(tables(spark, second))
    # January was neither read nor written again.
    for name in incremental.FACTS:
        after = versions(spark, root, "facts", name)
        assert after["home=2018-01"] == before[name]["home=2018-01"]
        assert after.get("home=2018-02") != before[name].get("home=2018-02")
    assert versions(spark, root, "partial", "mart_order_kpis")["home=2018-01"]


def test_a_refresh_that_died_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    incremental.refresh(spark, root, tables(spark, TABLES))
    moved = {**TABLES, "orders": [x.replace("2018-03-05", "2018-01-11") for x in TABLES["orders"]]}
    changed = spark.createDataFrame([("o4",)], "order_id string")
    with monkeypatch.context() as m:
        m.setattr(incremental, "_write_homes", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.refresh(spark, root, tables(spark, moved), changed)
    assert told(incremental.refresh(spark, root, tables(spark, moved), changed)) == full(tables(spark, moved))


def test_from_ingested_files(spark, tmp_path):
    """Files arrive; only what they changed is found, also through a customer and a product."""
    root = str(tmp_path / "root")

    def land(name, given):
        for table, lines in given.items():
            folder = tmp_path / "in" / table
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{name}.csv").write_text("h\n" + "".join(f"{x}\n" for x in lines))
            target = layers.table_path(root, "landed", table)
            ingest.ingest(spark, table, str(folder), target, f"{target}__progress", buckets=4)

    land("1", {t: lines for t, lines in TABLES.items() if t in ("orders", "order_items", "customers", "products", "sellers")})
    got = incremental.refresh_ingested(spark, root)
    now = {**TABLES, "payments": [], "geolocation": [], "category_translation": []}
    assert told(got) == full(tables(spark, now))
    more = {"customers": ["c2,u2,109,y,PR"], "products": ["p3,kind9,1,1,1,1,1,1,1"], "payments": TABLES["payments"][:3]}
    land("2", more)
    homes = snapshots.snapshot(spark, layers.table_path(root, "facts", "homes"))
    source = load.ingested(spark, root)
    changed = incremental.changed_orders(spark, root, homes.notes["since"], source)
    assert rows(changed.distinct()) == [("o1",), ("o2",), ("o3",)]
    before = versions(spark, root, "facts", "stg_orders")
    got = incremental.refresh_ingested(spark, root)
    now["customers"] = [TABLES["customers"][0], *more["customers"], *TABLES["customers"][2:]]
    now["products"] = [*TABLES["products"][:2], *more["products"]]
    now["payments"] = more["payments"]
    assert told(got) == full(tables(spark, now))
    assert versions(spark, root, "facts", "stg_orders")["home=2018-03"] == before["home=2018-03"]
    assert changed_nothing(spark, root)


def changed_nothing(spark, root):
    homes = snapshots.snapshot(spark, layers.table_path(root, "facts", "homes"))
    found = incremental.changed_orders(spark, root, homes.notes["since"], load.ingested(spark, root))
    return found.count() == 0


@pytest.mark.parametrize(("few", "changed"), [
    (1000, ["o4", "", "o7"]), (0, ["o1", "o8"]), (0, ["o1", "o2", "o3", "o4", "o5", "o6", "o7", "o8", ""]),
])
def test_few_and_many_changes(spark, tmp_path, monkeypatch, few, changed):
    """Orders with rows in several months or without one, repeated orders, blank ids, items of orders that have not come."""
    monkeypatch.setattr(incremental, "_FEW", few)
    line = "{},c1,delivered,{},,,2018-01-09 00:00:00,2018-01-08 00:00:00".format
    first = {**TABLES, "orders": [*TABLES["orders"], line("o8", "2018-04-01 00:00:00"), line("o8", ""), line("", "2018-01-01 00:00:00"), line("", "2018-02-01 00:00:00")]}
    first["order_items"] = [*TABLES["order_items"], "o8,1,p1,s1,,3,3", "o8,2,p2,s1,,4,4"]
    root = str(tmp_path)
    assert told(incremental.refresh(spark, root, tables(spark, first))) == full(tables(spark, first))

    def moved(x):
        return x.replace("2018-03-", "2018-05-").replace("2018-04-", "2018-02-").replace(",s1,", ",s2,").replace("boleto", "voucher")

    second = {t: [moved(x) if t in ("orders", "order_items", "payments") and x.split(",")[0] in changed else x for x in first[t]] for t in first}
    second["orders"] = [*second["orders"], *([line("o7", "2018-01-01 00:00:00"), line("o7", "2018-06-01 00:00:00")] if "o7" in changed else [])]
    second["order_items"] = [x for x in second["order_items"] if "o1" not in changed or x[:4] != "o1,2"]
    ids = spark.createDataFrame([(x,) for x in [*changed, *changed, None]], "order_id string")
    assert told(incremental.refresh(spark, root, tables(spark, second), ids)) == full(tables(spark, second))
    items = snapshots.read(spark, layers.table_path(root, "facts", "stg_order_items"))
    wanted = load.staging_models(load.enriched_tables(tables(spark, second)))["stg_order_items"]
    assert rows(items.drop("home").select(wanted.columns)) == rows(wanted)
    homes = dict(snapshots.read(spark, layers.table_path(root, "facts", "homes")).select("order_id", "home").collect())
    assert homes["o8"] == ("2018-02" if "o8" in changed else "2018-04") and homes["o5"] == "none" and homes[""] == "2018-01"
