import pytest

import __spark_entry__ as driver
from checks.compare import differences, duck
from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, con, name):
    found = QUERIES[name](spark, SF).cache()
    assert differences(found, con, ORACLE_SQL[name]) == ""
    assert found.count() > 0, "a comparison of nothing with nothing"
    found.unpersist()


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_the_data_tells_left_from_inner(con):
    count = lambda sql: con.execute(f"SELECT count(*), count(partner_id), count(product_name) FROM ({sql})").fetchone()
    lines = con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    rows, partners, products = count(driver.oracle_sql()["bi_ventas"])
    assert partners < rows < lines and products < rows
