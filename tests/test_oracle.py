"""Every query against its SQL on DuckDB."""

from __future__ import annotations

from dataclasses import replace

import pytest
from oracle_check import compare, connect

from strandline.operators import quality
from strandline.plans.catalog import queries
from strandline.plans.oracle import oracle_sql

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tiny, con, name):
    assert compare(QUERIES[name](spark, tiny), con, SQL[name]) is None


@pytest.mark.parametrize("source, broken", [("customers", "EmailAddress IS NULL"), ("sales", "OrderQuantity < 0")])
def test_a_changed_rule_is_noticed(spark, tiny, con, monkeypatch, source, broken):
    """The SQL states the rules by itself."""
    rules = [*quality.RULES[source][:-1], replace(quality.RULES[source][-1], fails=broken)]
    monkeypatch.setitem(quality.RULES, source, tuple(rules))
    name = f"dq_report_{source}"
    assert compare(QUERIES[name](spark, tiny), con, SQL[name]) is not None
