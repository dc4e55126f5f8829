"""Every registered query returns exactly what its SQL says."""

import re

import pytest

import __spark_entry__ as entry
from compare import difference
from tests.conftest import SF


CORPUS = re.compile(r"op\d+_|pipeline$")  # tested with the optional subpackage
NAMES = [name for name in entry.queries() if not CORPUS.match(name)]


def test_every_query_has_its_sql():
    assert set(NAMES) == {name for name in entry.oracle_sql() if not CORPUS.match(name)}


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert difference(spark, SF, name) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
