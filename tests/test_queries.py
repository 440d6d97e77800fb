"""Every query with SQL must equal DuckDB's result on the smallest tables."""

import pytest
from check import compare

from cardloom.catalog import load

QUERIES = load()


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name].run(spark, sf)
    got = (df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(QUERIES[name].sql)
    assert compare(got, ([c[0] for c in cursor.description], cursor.fetchall())) == ""


def test_every_inventory_row_has_a_query():
    """All rows of the operator inventory, by section size."""
    sizes = {"A": 10, "B": 28, "C": 10, "D": 51, "E": 13, "F": 6, "G": 4, "H": 14, "J": 8}
    wanted = {f"{letter}{i}" for letter, n in sizes.items() for i in range(1, n + 1)} | {f"I{i}" for i in range(25)}
    wanted |= {f"D12{x}" for x in "abcd"}
    assert wanted - {row for q in QUERIES.values() for row in q.rows} == set()


def test_entry_points_agree():
    import __spark_entry__ as entry
    assert set(entry.oracle_sql()) <= set(entry.queries())
