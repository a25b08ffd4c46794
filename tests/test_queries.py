"""Every registered query against its reference SQL on the smallest tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from crmfunnel import verify
from crmfunnel.verify.compare import connect, difference

DATA = "/root/testdata/sf0.001"
QUERIES, SQL = verify.queries(), verify.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def test_blueprint_ids_are_covered():
    wanted = {f"{p}{i:02d}" for p, n in {"p": 38, "j": 19, "w": 12, "g": 8, "u": 1, "b": 12, "r": 12, "a": 6, "e": 13}.items()
              for i in range(1, n + 1)} | {f"c{i:02d}" for i in (1, 2, 4, 5, 6, 7, 8)}
    have = {re.match(r"[a-z]\d\d", k).group() for k in QUERIES if not k.startswith("m_")}
    assert wanted <= have
    assert len([k for k in QUERIES if k.startswith("m_")]) == 24
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["Source", "Leads", "Demos_SE", "Enrolls", "Total_Sale_Value"] and df.count() > 0


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, con, key):
    assert difference(QUERIES[key](spark, DATA), con, SQL[key]) is None
