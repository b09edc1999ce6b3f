"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

from vesselflow.plans.oracle import oracle_sql  # noqa: E402
from vesselflow.plans.queries import queries  # noqa: E402

NAMES = sorted(queries())
SQL_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(E.queries())
    assert set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    sp = df.toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sp) > 0
        return
    rel = con.sql(sql)
    spark_types = {f.name: SQL_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    dk = con.execute(sql).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert len(sp) == len(dk)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 22
    assert "DCPA" in df.columns
