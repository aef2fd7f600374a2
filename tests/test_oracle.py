"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import SF_SMALL, digest, duck
from tidemark.plans.registry import QUERIES

# Every query of the warehouse has an oracle; of other registered queries those that SQL can express.
NAMES = sorted(set(QUERIES) | set(entry.oracle_sql()))

# Spark type -> DuckDB type of the same column.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle SQL"
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    d_types = dict(zip(d_cols, [str(t) for t in con.sql(sql).types]))
    for f in df.schema.fields:
        assert TYPES.get(f.dataType.simpleString()) == d_types[f.name], (f.name, f.dataType, d_types[f.name])
    assert len(rows) == len(d_rows)
    hs, ls = digest(df.columns, rows)
    hd, ld = digest(d_cols, d_rows)
    assert hs == hd, (sorted(set(ls) - set(ld))[:3], sorted(set(ld) - set(ls))[:3])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["day_hour_time", "buy_cnt"]
    assert df.count() > 0
