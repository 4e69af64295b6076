import re

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.oracle import compare, connect, plain_row

SMALL = "/root/testdata/sf0.001"
QUERIES, EXPECTED = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_expected_sql_belongs_to_queries():
    assert set(EXPECTED) <= set(QUERIES)
    assert all(name.startswith("ml_") for name in set(registry.QUERIES) - set(registry.EXPECTED))


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, EXPECTED[name]) is None


#: Queries whose SQL ends in ORDER BY and LIMIT: there the order of the rows counts too.
ORDERED = sorted(n for n, sql in EXPECTED.items() if re.search(r"ORDER BY [^()]*LIMIT \d+( OFFSET \d+)?\s*$", sql))


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_order(spark, duck, name):
    result = duck.execute(EXPECTED[name])
    columns = sorted(c[0] for c in result.description)
    at = [next(i for i, c in enumerate(result.description) if c[0] == name) for name in columns]
    want = [plain_row(row[i] for i in at) for row in result.fetchall()]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == columns
    assert [plain_row(row) for row in got.select(*[f"`{c}`" for c in columns]).collect()] == want


def test_strongest_correlation_comes_first(spark):
    rows = QUERIES["label_correlations"](spark, SMALL).collect()
    sizes = [abs(r["corr_with_long_run_flag"]) for r in rows]
    assert len(rows) > 1 and sizes == sorted(sizes, reverse=True)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
