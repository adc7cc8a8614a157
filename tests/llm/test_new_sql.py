"""The archive, vector code and run queries against their SQL, on two of the given sizes."""

import os

import pytest

from alignfold.llm import queries
from alignfold.plans.oracle import duck, rows_of


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", ["op11_warc", "op12_vector_codes", "op13_periodic_runs"])
def test_query_equals_its_sql(spark, sf_dir, name, size):
    sf_dir = os.path.join(os.path.dirname(sf_dir), size)
    cur = duck(sf_dir).execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(cols) and rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
