"""Every catalogue query with an oracle agrees with DuckDB at sf0.001
(the driver checks sf0.01 the same way); rows-only queries run."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "o_orderkey" in df.columns


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    b = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert Counter(a) == Counter(b)
    # column types agree too (Spark name → DuckDB name)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert TYPES.get(t, t) == duck_types[f.name], (f.name, t, duck_types[f.name])


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0
