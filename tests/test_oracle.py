"""Every registered query against its SQL counterpart."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import canonical, oracle  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(entry.ORACLES))
def test_query(spark, name):
    df = entry.queries()[name](spark, SF)
    cursor = oracle(SF).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want, got = canonical(columns, cursor.fetchall()), canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == want and len(got) > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
