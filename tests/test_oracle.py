"""Every registered query against its DuckDB oracle on sf0.001, plus the
driver contract of ``__spark_entry__``."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from tools.oracle_check import canon, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["triangles"]
    assert df.first()["triangles"] == 7852


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def kind(column):
    """What a column holds: whole numbers, other numbers, truth values or text."""
    values = {type(v.item() if hasattr(v, "item") else v).__name__ for v in column if v is not None and v == v}
    return values or {"nothing"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(sdf) >= 1
        return
    ddf = con.execute(sql).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert {c: kind(sdf[c]) for c in sdf.columns} == {c: kind(ddf[c]) for c in sdf.columns}
    assert canon(sdf) == canon(ddf)
