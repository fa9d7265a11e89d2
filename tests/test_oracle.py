"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from tidemill.plans import REGISTRY

FOLDER = os.environ.get("TIDEMILL_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = dict(REGISTRY)
SQL = {name: q.sql for name, q in REGISTRY.items() if q.sql}


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_answer(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        df.collect()


@pytest.mark.parametrize("name", [
    n for n in sorted(QUERIES) if n.startswith(("win_", "udf_03", "srt_01", "dml_03", "dml_13_fold_history"))
])
def test_same_answer_in_small_sections(spark, con, small_sections, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
