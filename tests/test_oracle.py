"""Every registered query equals its DuckDB oracle on the smallest tables
(column names and types, rows, values rounded to 9 significant digits)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield c
    c.close()


def norm(v):
    if isinstance(v, float) and not math.isnan(v) and v != 0:
        return float(f"{v:.9g}")
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return float(v)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    ours_t = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs_t = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert ours_t == theirs_t
    cols = sorted(df.columns)
    idx = [rel.columns.index(c) for c in cols]
    ours = sorted((tuple(norm(r[c]) for c in cols) for r in df.select(*cols).collect()), key=repr)
    theirs = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert len(ours) == len(theirs)
    assert ours == theirs
