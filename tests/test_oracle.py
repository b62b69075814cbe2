"""Every query that SQL can state equals DuckDB's answer on the same tables."""

import math

import pytest

from linkloom.plans import catalog


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return int(value) if isinstance(value, bool) is False and isinstance(value, int) else value


def rows(values, columns):
    return sorted(repr(tuple(plain(v) for v in r)) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_duckdb(name, spark, sf, duck):
    got = catalog.QUERIES[name](spark, sf)
    columns = sorted(got.columns)
    want = duck.sql(catalog.SQL[name])
    assert sorted(want.columns) == columns
    assert rows((tuple(r) for r in got.select(*columns).collect()), columns) == rows(duck.sql(f"select {', '.join(columns)} from ({catalog.SQL[name].strip()})").fetchall(), columns)


def test_partitions_do_not_matter(spark, sf):
    """The result must not follow from how rows are dealt out."""
    results = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, catalog.QUERIES["decision_max"](spark, sf).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert results[0] == results[1]
