"""The state of an ingested table: replays, buckets, late files."""

import os

import pytest

from retailmarts.sources import snapshots
from retailmarts.streaming import ingest
from tests.conftest import rows

ITEMS = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"


class Landing:
    """Files that land one after the other, and the state after each run."""

    def __init__(self, spark, path, table="order_items", buckets=8):
        self.spark, self.path, self.table, self.buckets = spark, path, table, buckets
        self.target = str(path / "t")
        (path / "in").mkdir(parents=True)

    def file(self, name, lines, when):
        path = self.path / "in" / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(ITEMS + "".join(f"{x}\n" for x in lines))
        os.utime(path, (1_600_000_000 + when, 1_600_000_000 + when))

    def run(self):
        ingest.ingest(self.spark, self.table, str(self.path / "in"), self.target, str(self.path / "c"), buckets=self.buckets)

    def state(self):
        return snapshots.snapshot(self.spark, f"{self.target}__state")

    def current(self):
        return rows(ingest.current(self.spark, self.table, self.target))

    def derived(self):
        """The same from the whole log, without the state."""
        table, arrived = self.table, ingest._arrived(self.spark, self.table, self.target)
        keyed, rest = ingest._counting(arrived, ingest._files(ingest._contents(arrived, table)), table)
        names = ingest.RAW[table].names
        return rows(ingest._latest(keyed, table).select(names).unionByName(rest.select(names)))


def line(key, price):
    return f"{key},1,p,s,,{price},1"


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_a_delivery_rewrites_its_buckets_only(landing):
    landing.file("a.csv", [line(f"o{i}", 1) for i in range(60)] + [line("", 7)], 0)
    landing.run()
    first = landing.state()
    assert len(first.parts) == 9 and first.notes["buckets"] == 8
    landing.file("b.csv", [line("o3", 2), line("", 8)], 1)
    landing.run()
    second = landing.state()
    changed = {p for p in first.parts if first.parts[p] != second.parts[p]}
    assert len(changed) == 2 and "key_bucket=-1" in changed
    assert len(second.parts["key_bucket=-1"]) == 2  # added to, not rewritten
    assert landing.current() == landing.derived()
    assert sorted(r[5] for r in landing.current()) == [1.0] * 59 + [2.0, 7.0, 8.0]


def test_a_replayed_batch_changes_nothing(spark, landing):
    landing.file("a.csv", [line("a", 1), line("b", 1), line("", 1)], 0)
    landing.run()
    before, current = landing.state(), landing.current()
    ingest.merge("order_items", landing.target, ingest._arrived(spark, "order_items", landing.target), before.notes["batch"])
    assert landing.state() == before and landing.current() == current


def test_a_batch_lost_before_its_commit_is_merged_once(spark, landing, monkeypatch):
    """The writer dies between the two snapshots; the batch comes again."""
    landing.file("a.csv", [line("a", 1), line("", 1)], 0)
    landing.run()
    landing.file("b.csv", [line("a", 2), line("", 2)], 1)
    write = snapshots.write

    def dies(df, path, *args, **more):
        if path.endswith("__state"):
            raise RuntimeError("lost")
        return write(df, path, *args, **more)

    with monkeypatch.context() as m:
        m.setattr(snapshots, "write", dies)
        with pytest.raises(Exception, match="lost"):
            landing.run()
    assert [r[5] for r in landing.current()] == [1.0, 1.0]
    landing.run()
    assert sorted(r[5] for r in landing.current()) == [1.0, 2.0, 2.0]
    assert landing.current() == landing.derived()


def test_late_files_settle_as_if_they_had_come_in_time(landing):
    landing.file("d2/a.csv", [line("a", 2), line("b", 2)], 5)
    landing.run()
    landing.file("d1/a.csv", [line("a", 1), line("c", 1)], 1)  # an older delivery
    landing.run()
    assert sorted((r[0], r[5]) for r in landing.current()) == [("a", 2.0), ("b", 2.0), ("c", 1.0)]
    landing.file("d3/a.csv", [line("a", 1), line("c", 1)], 7)  # d1 once more, so far
    landing.run()
    assert landing.current() == landing.derived()
    landing.file("d3/b.csv", [line("d", 3)], 8)  # now a delivery of its own
    landing.run()
    assert sorted((r[0], r[5]) for r in landing.current()) == [("a", 1.0), ("b", 2.0), ("c", 1.0), ("d", 3.0)]
    landing.file("d2/0.csv", [line("a", 9)], 0)  # d2 is older than it seemed
    landing.run()
    assert landing.current() == landing.derived()


def test_nothing_has_come(landing):
    landing.run()
    assert landing.state() is None
