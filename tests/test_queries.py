"""Every query against its SQL on the smallest test tables."""

import math
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__

ORACLE = __spark_entry__.oracle_sql()


def plain(value):
    if value is None:
        return "None"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.5g}"
    return str(value)


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        base.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return base


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, data, duck, name):
    frame = __spark_entry__.queries()[name](spark, data)
    columns = sorted(frame.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in frame.collect())
    if name in ORACLE:
        cursor = duck.execute(ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
        assert got == want


def test_entry(spark):
    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test tables")
    assert __spark_entry__.entry(spark).count() > 0
