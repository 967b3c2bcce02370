"""The queries that SQL can express against that SQL, on the smallest tables."""

from __future__ import annotations

import pytest

pytest.importorskip("duckdb")

from check import ROOT, compare, oracle_connection  # noqa: E402
from formflow.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = f"{ROOT}/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    problem, _ = compare(spark, oracle_connection(SF), SF, QUERIES[name], ORACLE[name])
    assert problem is None, problem


def test_all_operators_are_registered():
    assert [q.split("_")[0] for q in QUERIES] and {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
