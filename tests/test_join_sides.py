"""Sides of a join that grow with the forms and questions are dealt by key, and rows without a key meet nothing."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from formflow.plans import catalog

#: id, section, group, concept: without concept, without group, of concepts that are not there or there twice, in the repeatable group 6.
_ASKED = [(1, 0, None, 4), (2, 1, 1, 2), (3, 3, 1, None), (4, 0, None, None), (5, 2, 4, 1), (6, 4, None, 4), (7, 4, 6, 3), (8, 5, 99, 77), (9, 1, 5, None), (10, 5, None, 0), (11, None, None, 1)]
_GROUPS = 4  # every such concept is a group of questions


def _meta(spark):
    """Concepts, forms and sections are ranges, and nothing else is, so that a plan tells them apart."""
    concepts = spark.range(7).union(spark.range(2, 3))
    asked = spark.createDataFrame(_ASKED, "id long, form_element_group_id long, group_id long, concept_id long")
    types = {
        "subject_type": "select 1L id, 's' uuid, 'Person' type, true allow_middle_name",
        "operational_subject_type": "select 1L subject_type_id, 'Person' name",
        "program": "select 1L id, 'p' uuid",
        "operational_program": "select 1L program_id, 'P' name",
        "encounter_type": "select 1L id, 'e' uuid",
        "operational_encounter_type": "select 1L encounter_type_id, 'E' name",
        "non_applicable_form_element": "select 10L form_element_id",
    }
    meta = {name: spark.sql(sql) for name, sql in types.items()}
    mapped = [(f"m{n}", n, 1) for n in range(3)] + [("m3", None, 1), ("m4", 0, None), ("m5", 50, 1)]
    kind = F.when(F.col("id") % _GROUPS == 0, "QuestionGroup").otherwise("Coded")
    return meta | {
        "concept": concepts.select("id", F.format_string("c%d", "id").alias("uuid"), F.format_string("C%d", "id").alias("name"), kind.alias("data_type"), F.lit(False).alias("is_voided")),
        "form": spark.range(4).select("id", F.format_string("f%d", "id").alias("uuid"), F.lit("IndividualProfile").alias("form_type")),
        "form_element_group": spark.range(6).select("id", (F.col("id") % 3).alias("form_id"), F.lit(False).alias("is_voided")),
        "form_element": asked.select(
            "*", F.lit("MultiSelect").alias("type"), F.when(F.col("id") == 6, '[{"key":"repeatable","value":"true"}]').alias("key_values"), F.lit(False).alias("is_voided")
        ),
        "form_mapping": spark.createDataFrame(mapped, "uuid string, form_id long, subject_type_id long").selectExpr(
            "*", "cast(null as long) entity_id", "cast(null as long) observations_type_entity_id", "false is_voided"
        ),
    }


def _gathered(rows) -> list[str]:
    """The subplans that are gathered on the driver to be broadcast."""
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[ :+\-*(\d)]*", line)[0].split("-")[0]) for line in lines]
    out = []
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((m for m in range(n + 1, len(lines)) if depth[m] <= depth[n]), len(lines))
            out.append("\n".join(lines[n:end]))
    return out


@pytest.mark.parametrize("of", [catalog.form_specs, catalog.repeat_specs], ids=["rp1_table_summary", "repeats"])
def test_questions_and_forms_are_not_gathered(spark, of):
    tables = catalog.grouped_specs(of(_meta(spark)))
    gathered = _gathered(tables)
    assert gathered, "types of subjects are few"
    assert not [part for part in gathered if "Range (" in part]


def _concepts(key, groups):
    """The ids that a key meets, once for each time that they are there."""
    there = [c for c in [*range(7), 2] if key is not None and c == key and groups in (None, c % _GROUPS == 0)]
    return there or [None]


def test_rows_without_a_key_meet_nothing(spark):
    want, inside = [], []
    within = {n: (n == 6, concept) for n, _, _, concept in _ASKED}
    for mapping in range(3):
        for n, section, group, concept in _ASKED:
            if n == 10 or section is None or section % 3 != mapping:
                continue
            repeats, holder = within.get(group, (False, None))
            pairs = [(f"m{mapping}", q, h) for q in _concepts(concept, None if repeats else False) for h in _concepts(holder, True if repeats else None)]
            (inside if repeats else want).extend(pairs)
    meta = _meta(spark)
    told = [of(meta).select("mapping", "question.id", "holder.id").collect() for of in (catalog.form_specs, catalog.repeat_specs)]
    assert sorted(map(str, map(tuple, told[0]))) == sorted(map(str, want))
    assert sorted(map(str, map(tuple, told[1]))) == sorted(map(str, inside))
