"""Specs as rows, gathered, merged and saved by Spark: as the lists of the driver, and nothing of them collected."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame

from formflow.model import ColumnSpec, TableSpec
from formflow.plans import evolve


def _tables(rand: random.Random, side: str) -> list[TableSpec]:
    out = {}
    for _ in range(40):
        columns = []
        for _ in range(rand.randrange(5)):
            asked = rand.choice([None, 1, 2, 3, 4])
            group = rand.choice([None, "g"]) if asked else None
            columns.append(ColumnSpec(f"c{rand.randrange(7)}", "text", asked, asked and "Text", asked and f"u{asked}", group, None, rand.random() < 0.2))
        name = f"{side}{rand.randrange(9)}" if rand.random() < 0.9 else None
        subject = f"s{rand.randrange(9)}" if rand.random() < 0.9 else None
        spec = TableSpec(name, rand.choice(["Person", "Encounter"]), subject, form_uuid=f"f{rand.randrange(3)}", columns=tuple(columns))
        out[spec.name, spec.identity] = spec
    return list(out.values())


def _told(rows: DataFrame) -> list[str]:
    return sorted(str(tuple(r)) for r in rows.collect())


@pytest.mark.parametrize("side", ["a", "b"])
def test_merge_of_rows_is_the_merge_of_lists(spark, monkeypatch, side):
    """Names and identities that are null, shared by several tables or on one side only; tables of no columns."""
    rand = random.Random(side)
    old, new = (evolve.spec_rows(spark, _tables(rand, s)) for s in ("a", side))
    lists = evolve.collected(old), evolve.collected(new)
    want = [_told(evolve.spec_rows(spark, evolve.merge_specs(*lists, member))) for member in (False, True)]
    kept = _told(evolve.spec_rows(spark, lists[0]))
    monkeypatch.setattr(evolve, "collected", None)
    with monkeypatch.context() as nothing:
        nothing.setattr(type(old), "collect", None)
        merged = [evolve.spec_rows(spark, evolve.merge_specs(old, new, member)) for member in (False, True)]
        gathered = evolve.specs_of(old)
    assert [_told(rows) for rows in merged] == want
    assert _told(gathered) == kept


def test_rows_go_through_the_store_without_the_driver(spark, store, monkeypatch):
    """Rows of one name and identity are one table, of the last row's form, its columns in order of their positions."""
    rows = [("t", "Person", "s", "f1", 7, "b", None), ("t", "Person", "s", "f2", 9, "c", True), ("t", "Person", "s", "f1", 3, "a", False), ("u", "User", None, None, 0, None, None)]
    frame = spark.createDataFrame(rows, "table_name string, type string, subject_type_uuid string, form_uuid string, position int, column_name string, voided boolean")
    frame = evolve.spec_rows(spark, []).unionByName(frame, allowMissingColumns=True)
    with monkeypatch.context() as nothing:
        nothing.setattr(type(frame), "collect", None)
        assert evolve.stored_specs(store).schema == frame.schema
        store.commit({evolve.SPEC_TABLE: evolve.save_specs(store, evolve.specs_of(frame))})
    got = [(r["table_name"], r["form_uuid"], r["position"], r["column_name"], r["voided"]) for r in evolve.stored_specs(store).collect()]
    assert sorted(got) == [("t", "f2", 0, "a", False), ("t", "f2", 1, "b", False), ("t", "f2", 2, "c", True), ("u", None, 0, None, None)]
    assert [(s.name, s.form_uuid, [c.name for c in s.columns]) for s in evolve.load_specs(store)] == [("t", "f2", ["a", "b", "c"]), ("u", None, [])]


def test_only_changes_meet_the_tables(spark):
    """Columns that stay as they are go into no second join of the diff."""
    spec = TableSpec("t", "Person", "s", columns=(ColumnSpec("a", "text"), ColumnSpec("b", "text")))
    rows = evolve.spec_rows(spark, [spec])
    told = evolve.diff_rows(rows, rows)
    assert told.collect() == []
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" :+-") for line in plan.splitlines() if "Join " in line or "Generate " in line]
    assert any(line.startswith("Generate") for line in joins)
    outer = next(i for i, line in enumerate(joins) if line.startswith("Generate"))
    assert joins[outer - 1].startswith("Join Inner") and joins[outer + 1].startswith("Join FullOuter"), joins
