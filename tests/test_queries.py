"""Every catalog query against its SQL, and the driver's contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from shelfmark.plans import queries as plans
from tests.compare import duck_rows, spark_rows


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_same_rows_as_sql(name, spark, sf_dir, duck):
    names, rows = spark_rows(driver.queries()[name](spark, sf_dir))
    expected_names, expected = duck_rows(duck, driver.oracle_sql()[name])
    assert names == expected_names
    assert rows == expected


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


def test_filters_reach_the_scan(spark, sf_dir, capsys):
    driver.queries()["facet_filter"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [In(p_brand" in plan
    assert "p_name" not in plan.split("ReadSchema")[1].split("\n")[0]
