"""Shared pieces of the queries: table specs, windows, plain output types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formflow.model import TableSpec, answer_column, base_columns

START, END = "1995-07-01 00:00:00", "2001-05-01 00:00:00"
WINDOW = {"start": START, "end": END}


def in_window(alias: str) -> str:
    column = f"{alias}.last_modified_date_time"
    return f"{column} > timestamp '{START}' and {column} <= timestamp '{END}'"


ANSWERS = (
    answer_column("Amount", 1, "Numeric", "q-num"),
    answer_column("One", 2, "SingleSelect", "q-one"),
    answer_column("Many", 3, "MultiSelect", "q-many"),
    answer_column("Day", 4, "Date", "q-date"),
    answer_column("Time", 5, "Time", "q-time"),
    answer_column("Note", 6, "Text", "q-text"),
    answer_column("Other", 7, "Subject", "q-ref"),
    answer_column("Group Child 1", 9, "Text", "c1", "q-grp", "Group"),
    answer_column("Group Child 2", 10, "Numeric", "c2", "q-grp", "Group"),
    answer_column("Photo", 16, "Image", "q-photo"),
    answer_column("Image", 17, "ImageV2", "q-image"),
)
WARD = answer_column("Ward", 15, "Text", "q-sync", role="sync1")
OWN_WARD = answer_column("Ward", 15, "Text", "q-sync")
REASON = answer_column("Reason", 14, "Text", "q-why")
REPEAT_ANSWERS = (
    answer_column("Quantity", 12, "Numeric", "qty"),
    answer_column("Exchange", 13, "SingleSelect", "ex"),
    answer_column("Picture", 18, "Image", "pic", None, "Repeat"),
)


def spec(type_: str, subject: str | None = None, program: str | None = None, visit: str | None = None, answers=(), **how) -> TableSpec:
    base = () if type_ == "RepeatableQuestionGroup" else base_columns(type_)
    name = "_".join(x for x in (type_, subject, program, visit) if x).lower()
    return TableSpec(name, type_, subject, program, visit, how.pop("form", None), columns=base + tuple(answers), **how)


PERSON = spec("Person", "st-person", answers=(*ANSWERS, OWN_WARD))
INDIVIDUAL = spec("Individual", "st-individual", answers=ANSWERS)
HOUSEHOLD = spec("Household", "st-household", answers=ANSWERS)
GROUP = spec("Group", "st-group", answers=ANSWERS[:3])


def encounter_spec(kind: int = 2, subject: str = "st-person", type_: str = "Encounter", answers=(*ANSWERS, WARD), **how) -> TableSpec:
    return spec(type_, subject, None, f"et-{kind}", answers, **how)


def enrolment_spec(program: int = 2, subject: str = "st-person", type_: str = "ProgramEnrolment", answers=(*ANSWERS, WARD), **how) -> TableSpec:
    return spec(type_, subject, f"p-{program}", None, answers, **how)


def program_encounter_spec(
    kind: int = 3, program: int = 2, subject: str = "st-person", type_: str = "ProgramEncounter", answers=(*ANSWERS, WARD), **how
) -> TableSpec:
    return spec(type_, subject, f"p-{program}", f"et-{kind}", answers, **how)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and variants as JSON text, for comparing."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = F.round(column.cast("double"), 6).alias(f.name)
        elif isinstance(f.dataType, T.VariantType):
            column = F.to_json(column).alias(f.name)
        out.append(column)
    return df.select(*out)


# --- the same projections in oracle SQL ---------------------------------------


def js(doc: str, *path: str) -> str:
    return f"json_extract_string({doc}, '$" + "".join(f'."{p}"' for p in path) + "')"


def named(uuid: str) -> str:
    return f"case {uuid} when 'a0' then 'Alpha' when 'a1' then 'Beta' when 'a2' then 'Gamma' when 'a3' then 'Delta' end"


def answers_sql(doc: str = "e.observations") -> str:
    many = f"json_extract_string({doc}, '$.\"q-many\"[*]')"
    return f"""
       cast({js(doc, 'q-num')} as double) as "Amount", {named(js(doc, 'q-one'))} as "One",
       list_aggregate(list_filter(list_transform({many}, lambda x: {named('x')}), lambda x: x is not null), 'string_agg', ', ') as "Many",
       cast(cast(substr({js(doc, 'q-date')}, 1, 19) as timestamp) + interval '330' minute as date) as "Day",
       {js(doc, 'q-time')} || ':00' as "Time", {js(doc, 'q-text')} as "Note", {js(doc, 'q-ref')} as "Other",
       {js(doc, 'q-grp', 'c1')} as "Group Child 1", cast({js(doc, 'q-grp', 'c2')} as double) as "Group Child 2",
       {js(doc, 'q-photo')} as "Photo",
       '[{{"n":' || json_extract_string({doc}, '$."q-image"[0].n') || ',"uri":"' || json_extract_string({doc}, '$."q-image"[0].uri') || '"}}]' as "Image"
"""


def ward_sql(doc: str) -> str:
    return f"{js(doc, 'q-sync')} as \"Ward\""


def cols(alias: str, names) -> str:
    return ", ".join(f"{alias}.{n}" for n in names)
