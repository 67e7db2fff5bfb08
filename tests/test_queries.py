import pytest

from harness.compare import canonical, connect
from harness.oracle import oracle_sql
from harness.queries import BUILDERS, REGISTRY
from tests.helpers import plan

EXPECTED = oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_expected_sql():
    assert set(EXPECTED) == set(REGISTRY) == set(BUILDERS)


@pytest.mark.parametrize("name", list(BUILDERS))
def test_query_matches_expected_sql(panel, duck, name):
    df = BUILDERS[name](panel)
    cursor = duck.execute(EXPECTED[name])
    columns = [d[0] for d in cursor.description]
    want = canonical(columns, cursor.fetchall())
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == want
    text = plan(df)
    assert "Python" not in text and "Cartesian" not in text


def test_entry(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.columns[0] == "county_fips" and 0 < df.count() <= 50
    queries, sql = set(driver.queries()), set(driver.oracle_sql())
    assert set(REGISTRY) <= sql <= queries
