"""Every registered query against its oracle SQL on the smallest data."""

from __future__ import annotations

import pytest

pytest.importorskip("duckdb")

from check import ROOT, compare, oracle_connection  # noqa: E402
from formflow.workload import ORACLE, QUERIES  # noqa: E402

SF = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, SF, QUERIES[name], ORACLE[name])
    assert problem is None, problem
