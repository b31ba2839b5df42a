"""Every core query against its SQL, and the driver's contract."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from loomline.plans import catalog

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(plain(y) for y in x)
    return str(x)[:26] if hasattr(x, "isoformat") else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert got


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark, data):
    assert entry.entry(spark).limit(5).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_streamed_equals_batch(spark, data):
    a = QUERIES["throughput_streamed"](spark, data).collect()
    b = QUERIES["throughput_tumbling"](spark, data).select("started", "event_type", "n_events").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_split_is_disjoint_and_complete(spark, data):
    got = QUERIES["train_test_split"](spark, data)
    assert got.count() == got.select("doc_id").distinct().count() == 200
    assert {r["split"] for r in got.select("split").distinct().collect()} == {"train", "test"}
