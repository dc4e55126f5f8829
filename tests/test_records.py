"""Records with quoted line breaks, found by many tasks a file."""

import random

import pytest
from pyspark.sql import functions as F

from retailmarts.operators import review_repair
from retailmarts.sources import raw, records
from retailmarts.sources.schemas import RAW
from tests.conftest import rows

NAMES = RAW["reviews"].names
HEADER = ",".join(NAMES) + "\n"


def plain(text, header=True):
    """The records of a file, character by character."""
    found, start, inside, fresh, at = [], 0, False, True, 0
    while at < len(text):
        c = text[at]
        if inside:
            if c == '"':
                if text[at + 1:at + 2] == '"':
                    at += 1
                else:
                    inside = False
            fresh = False
        elif c == '"' and fresh:
            inside, fresh = True, False
        elif c == ",":
            fresh = True
        elif c == "\n":
            found.append(text[start:at])
            start, fresh = at + 1, True
        else:
            fresh = False
        at += 1
    if start < len(text):  # the file's last line break ends it
        found.append(text[start:].removesuffix("\n"))
    return found[1:] if header else found


def split(spark, path, header=True):
    return sorted(r.line for r in records.records(records.file_lines(spark, str(path)), header).collect())


@pytest.mark.parametrize("seed, size", [(1, 9), (2, 20), (3, 60), (4, 10_000)])
def test_any_text_in_any_ranges(spark, settings, tmp_path, seed, size):
    settings(files__maxPartitionBytes=size, files__openCostInBytes=0)
    rng = random.Random(seed)
    texts = []
    for n in range(2):
        text = "".join(rng.choice('aé,,"\n\n""') for _ in range(150))
        (tmp_path / f"{n}.csv").write_text(text)
        texts.append(text)
    for header in (True, False):
        assert split(spark, tmp_path, header) == sorted(r for t in texts for r in plain(t, header))


def review(i, message):
    quoted = message.replace('"', '""')
    return f'r{i},o{i},{i % 5 + 1},"t, {i}","{quoted}",2018-01-01 00:00:00,2018-01-02 00:00:00\n'


def test_equals_the_reader_of_whole_files(spark, settings, tmp_path):
    """One file, many tasks: row by row what Spark's own multi-line reader gives."""
    rng = random.Random(1)
    messages = ["\n".join(rng.choice(["a, b", 'say "x"', "", '""', "c,\"d"]) for _ in range(rng.randint(1, 40))) + "." for _ in range(3000)]
    path = tmp_path / "reviews.csv"
    path.write_text(HEADER + "".join(review(i, m) for i, m in enumerate(messages)))
    schema = ", ".join(f"{n} string" for n in NAMES)
    whole = spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(str(path))
    want = rows(whole)
    assert len(want) == 3000
    settings(files__maxPartitionBytes=path.stat().st_size // 20)
    lines = records.file_lines(spark, str(path))
    assert lines.select(F.spark_partition_id()).distinct().count() >= 20
    got = raw.scan(spark, "reviews", str(path)).select(NAMES)
    assert rows(got) == want
    strict = raw.load_report(raw.check_load(raw.scan(spark, "reviews", str(path)), "reviews"), "reviews").first()
    assert (strict.row_count, strict.bad_records) == (3000, 0)
    assert review_repair.reviews_stats(review_repair.read_records(spark, str(path))).first().already_good == 3000


def test_line_ends_blank_lines_and_open_quotes(spark, settings, tmp_path):
    path = tmp_path / "r.csv"
    path.write_bytes(HEADER.encode() + b'a,"x\r\ny",1\r\n\r\nb,c"d\r\n\n"e')
    assert split(spark, path) == ["", "", '"e', 'a,"x\ny",1', 'b,c"d']
    path.write_bytes(HEADER.encode() + b'a,b\nc,"d\ne,f\ng')
    settings(files__maxPartitionBytes=8)
    assert split(spark, path) == ["a,b", 'c,"d\ne,f\ng']


def test_a_header_may_span_lines(spark, settings, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text('a,"b\nc"\nd,e\n')
    settings(files__maxPartitionBytes=3)
    assert split(spark, path) == ["d,e"]


def test_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text(HEADER)
    assert split(spark, tmp_path) == []
    assert raw.scan(spark, "reviews", str(tmp_path)).count() == 0


def test_any_table_may_have_line_breaks(spark, settings, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text('h,h,h,h\n1,2,"a\nb",X\n3,4,"c",Y\n')
    settings(files__maxPartitionBytes=5)
    got = raw.parse(raw.scan(spark, "sellers", str(path), multi_line=True), "sellers")
    assert rows(got) == [("1", "2", "a\nb", "X"), ("3", "4", "c", "Y")]
