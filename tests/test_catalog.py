"""Every catalog query against its independent DuckDB oracle (sf0.001)."""

import pytest

from fleetlens.plans.catalog import oracle_sql, queries
from tools.check_oracle import rows_of

SQL = oracle_sql()
NAMES = sorted(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf, duck, name):
    df = queries()[name](spark, sf)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(SQL[name])
    dc, dr = rows_of([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
    types = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    rel = duck.sql(SQL[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        assert types.get(f.dataType.simpleString()) == dtypes[f.name], f.name


@pytest.mark.parametrize("name", [n for n in NAMES if n not in SQL])
def test_rows_only_queries_run(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "engine_health_status" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
