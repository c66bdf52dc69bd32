"""Every registered query against its SQL twin on DuckDB (the reference semantics in SQL)."""
import pytest

import __spark_entry__ as E
from movegrid.plans import registry
from tests.conftest import SF_SMALL
from tools.oracle_check import canon, duck_connect

SQL = registry.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "boolean": "BOOLEAN", "float": "FLOAT", "binary": "BLOB"}


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_SMALL)
    s_rows, s_cols = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    d_rows, d_cols = canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    rel = duck.sql(SQL[name])
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert s_types == d_types
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


#: Numbers of a random forest, which no SQL can give; tests/test_model_values.py holds them against other computations.
FOREST = {"model_forest_report", "model_forest_scored", "model_forest_folds"}


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL) | FOREST


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["id", "distance_sum", "distance_mean"]
