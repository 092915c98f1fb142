"""Every registered query against its SQL, on the smallest shared tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from registry.oracles import ORACLES
from registry.queries import QUERIES
from tools.compare import connect, in_order, rows_by_name

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="shared tables are not here")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    result = connect(FOLDER).execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = result.fetchall()
    assert rows_by_name(df.columns, got) == rows_by_name(columns, want)
    assert in_order(name, df.columns, got) == in_order(name, columns, want)
    assert got
