"""Every registered plan against its DuckDB SQL at sf0.01 (row count, columns, values)."""

import os

import pytest

from alignfold.plans.oracle import compare, duck
from alignfold.plans.registry import ORACLE, QUERIES, load_all

load_all()
SF = os.environ.get("ALIGNFOLD_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    if name not in ORACLE:
        assert r["spark_rows"] >= 0
        return
    assert r["cols_match"], r
    assert r["types_match"], r.get("type_diff")
    assert r["rows_match"], r
    assert r["values_match"], r.get("first_diff")


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["question", "answer"]
    assert set(E.oracle_sql()) <= set(E.queries())
