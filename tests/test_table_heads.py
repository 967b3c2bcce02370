"""Tables named by Spark: as the plans of a run name them, and none collected."""

from __future__ import annotations

import pytest

from formflow.functions.naming import table_name, table_name_column
from formflow.operators import reports
from formflow.plans import catalog

_SCHEMA = """mapping string, form string, kind string, parent_kind string, subject struct<uuid:string,type:string,allow_middle_name:boolean,label:string>,
    program struct<uuid:string,name:string>, visit struct<uuid:string,name:string>, repeat struct<uuid:string,name:string>,
    question struct<id:bigint,uuid:string,name:string,voided:boolean,answer:string>, holder struct<id:bigint,uuid:string,name:string,voided:boolean,answer:string>"""
_LONG = "Überaus long name  of a thing, KK " * 4


def _rows(spark):
    out = []
    kinds = ["IndividualProfile", "Encounter", "ProgramEnrolment", "ProgramExit", "ProgramEncounterCancellation", "ManualProgramEnrolmentEligibility", "Location"]
    for n, kind in enumerate(kinds * 2):
        subject = (f"s{n}", "Person" if n else "User", True, _LONG if n > 6 else "Some One")
        for q in range(2):
            out.append((f"m{n}", f"f{n}", kind, None, subject, ("p", "My Pro\tgram"), ("v", _LONG), None, (q, f"q{q}", "Q", False, "Text"), None))
    for n, kind in enumerate(catalog.REPEAT_NAMING):
        out.append((f"r{n}", f"g{n}", "RepeatableQuestionGroup", kind, ("s", "Person", False, "Some"), ("p", "Pro"), ("v", "Visit"), (f"u{n}", "Group One"), (1, "q", "Q", False, "Text"), None))
    return spark.createDataFrame(out, _SCHEMA)


def test_tables_are_named_as_on_the_driver(spark, monkeypatch):
    rows = _rows(spark)
    fields = ("name", "type", "subject_type_uuid", "program_uuid", "encounter_type_uuid", "form_uuid", "repeat_uuid")
    specs = catalog.to_specs(rows)
    want = sorted(str(tuple(getattr(s, f) for f in fields)) for s in specs)
    with monkeypatch.context() as nothing:
        nothing.setattr(type(rows), "collect", None)
        heads = catalog.table_heads(rows)
        summary = reports.table_summary(spark, heads)
    assert sorted(str(tuple(r)) for r in heads.select(*fields).collect()) == want
    assert [tuple(r) for r in summary.collect()] == [tuple(r) for r in reports.table_summary(spark, specs).collect()]


def test_a_table_without_a_name_is_an_error(spark):
    rows = _rows(spark).selectExpr("* except (program)", "cast(null as struct<uuid:string,name:string>) as program").where("kind = 'ProgramExit'")
    with pytest.raises(Exception, match="no name"):
        reports.table_summary(spark, catalog.table_heads(rows.select(*_rows(spark).columns))).groupBy("type").count().collect()


def test_names_keep_what_python_keeps(spark):
    parts = [("A\x1cB\x85c　 d", "İx- y"), ("", " "), (_LONG, _LONG), ("a" * 40, "𝒳b" * 30)]
    got = spark.createDataFrame(parts, "a string, b string").coalesce(1)
    for kind, suffix in (("ProgramEnrolment", "EXIT"), ("Encounter", None), ("ProgramEligibility", "x")):
        names = got.select(table_name_column([got["a"], got["b"]], kind, suffix)).collect()
        assert [r[0] for r in names] == [table_name(p, kind, suffix) for p in parts]
