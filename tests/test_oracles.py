"""Every core query with SQL gives the rows of that SQL; all others give rows, and the same ones twice."""

from __future__ import annotations

import pytest
from oracle import connect, difference

from tidewell.plans import catalogue

SLOW = {"relevance_train"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert difference(catalogue.QUERIES[name](spark, sf_dir), catalogue.ORACLES[name], con) == ""


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES) - SLOW))
def test_runs_alike_twice(spark, sf_dir, name):
    first, again = (sorted(map(str, catalogue.QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert first and first == again


def test_every_query_without_sql_is_tested_otherwise():
    # relevance_train, p5_found, dashboard_documents and country_classes have tests of their own.
    assert set(catalogue.QUERIES) - set(catalogue.ORACLES) == {"relevance_train", "p5_found", "dashboard_documents", "country_classes"}
