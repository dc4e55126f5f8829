import corpus_pipeline
import __spark_entry__ as entry
from retailmarts.llm import language, mixing, neardup, packing, toxicity
from retailmarts.llm.common import Scratch, read
from tests.conftest import SF
from tests.llm.test_neardup import brute
from tests.llm.test_packing import check as check_packing


def test_stages_against_their_inputs(spark):
    """Each stage on all that its predecessor kept."""
    tables = Scratch(spark, "stages")
    steps = [read(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(tables.save(stage(spark, steps[-1], SF)))
    start, clean, told, single, mixed, packed = steps
    assert all(x.columns == start.columns for x in steps[1:5])
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    # toxicity: kept rows are unchanged; what is labelled clean stays (with seven toxic rows to learn from)
    assert set(rows(clean)) <= set(rows(start)) and clean.count() < start.count()
    labels = {r["doc_id"]: r["toxic"] for r in read(spark, SF, "labels").collect()}
    gone = {r["doc_id"] for r in start.collect()} - {r["doc_id"] for r in clean.collect()}
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * sum(v == 0 for v in labels.values())
    # language: all documents of the languages stay
    assert set(rows(told)) <= set(rows(clean)) and told.count() >= 0.99 * clean.count()
    # near duplicates: one of each group
    want = {c for _, n, c in brute([(r["doc_id"], r["text"]) for r in told.collect()], corpus_pipeline.SIMILAR) if n}
    assert {r["doc_id"] for r in single.collect()} == want
    # mixing: words near the targets
    plan = mixing.mix(single, tables).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    for r in plan:
        assert abs(r["sum(taken)"] - r["max(target)"]) <= max(16, 0.02 * r["max(target)"])
    words = sum(len(r["text"].split()) for r in mixed.collect())
    assert words == sum(r["sum(taken)"] for r in plan)
    # packing: exact round trip
    check_packing(packed.collect(), [(r["doc_id"], r["text"]) for r in mixed.collect()])


def test_registered():
    assert "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()
    assert [name for name in entry.queries() if name.startswith("op")] == sorted(
        (n for n in entry.queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0])
    )
    assert all((language, neardup, packing, toxicity))


def test_empty_input(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
