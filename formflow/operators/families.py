"""Whole families of flat tables: the rows of many tables as one frame, each with its table's tag.

A tenant has hundreds of tables of four families, and reports and views read all tables
of a family, but only columns that they all have. From the sources a family is one scan:
every row is routed to its tables by the ids of its types. The routes are one row for
each table, so the join with them is a lookup; side tables carry ids only.

From stored tables a family is their union, each with its tag.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.model import SUBJECT_TYPES, TableSpec
from formflow.sources.tables import Context

#: Which table of its family a row is from, and that table's type.
TAG, KIND = "_table", "_kind"
TYPE_UUIDS = ("subject_type_uuid", "program_uuid", "encounter_type_uuid")
#: Source of each table type, the keys that decide a row's table, and what makes a row belong to it besides them.
SOURCES = {
    **{kind: ("individual", ("subject_type",), "true") for kind in SUBJECT_TYPES},
    "Encounter": ("encounter", ("subject_type", "encounter_type"), "true"),
    "IndividualEncounterCancellation": ("encounter", ("subject_type", "encounter_type"), "cancel_date_time is not null"),
    "ProgramEnrolment": ("program_enrolment", ("subject_type", "program"), "true"),
    "ProgramExit": ("program_enrolment", ("subject_type", "program"), "program_exit_date_time is not null"),
    "ProgramEncounter": ("program_encounter", ("subject_type", "program", "encounter_type"), "true"),
    "ProgramEncounterCancellation": ("program_encounter", ("subject_type", "program", "encounter_type"), "cancel_date_time is not null"),
}

#: A family: tables with their specs, or rows that are tagged already.
Family = Sequence[tuple[TableSpec, DataFrame]] | DataFrame


def union_tagged(tables: Sequence[tuple[TableSpec, DataFrame]]) -> DataFrame | None:
    """Tables of one family as one frame, with tag, type and type uuids; null if there are none."""
    parts = []
    for spec, df in tables:
        marks = {TAG: spec.name, KIND: spec.type} | {u: getattr(spec, u) for u in TYPE_UUIDS}
        parts.append(df.withColumns({name: F.lit(value).cast("string") for name, value in marks.items()}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def rows_of(family: Family) -> DataFrame | None:
    """A family's rows, tagged."""
    return family if isinstance(family, DataFrame) else union_tagged(family)


def routes(ctx: Context, specs: Sequence[TableSpec], keys: Sequence[str]) -> DataFrame:
    """One row for each table: the ids that lead to it, its tag, type and type uuids."""
    spark = ctx.table("subject_type").sparkSession
    fields = [TAG, KIND, *TYPE_UUIDS]
    rows = [(s.name, s.type, s.subject_type_uuid, s.program_uuid, s.encounter_type_uuid) for s in specs]
    out = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields))
    for key in keys:
        ids = ctx.table(key).select(F.col("uuid").alias(f"{key}_uuid"), F.col("id").alias(f"{key}_id"))
        out = out.join(ids, f"{key}_uuid")
    return out


def _typed(ctx: Context, source: str) -> DataFrame:
    """Changed rows of a source with the ids of their types."""
    rows = ctx.changed(source)
    if source == "individual":
        return rows
    people = ctx.table("individual").select(F.col("id").alias("_subject"), "subject_type_id")
    if source == "program_encounter":
        enrolled = ctx.table("program_enrolment").select(F.col("id").alias("program_enrolment_id"), F.col("individual_id").alias("_subject"), "program_id")
        return rows.join(enrolled.join(people, "_subject").drop("_subject"), "program_enrolment_id")
    return rows.join(people, rows["individual_id"] == people["_subject"]).drop("_subject")


def scan(ctx: Context, specs: Sequence[TableSpec]) -> DataFrame:
    """The changed rows of all tables of one family, in one scan of their source; without answers."""
    found = {SOURCES[s.type][:2] for s in specs}
    if len(found) != 1:
        raise ValueError(f"tables of one source are a family, not {sorted(x for x, _ in found)}")
    ((source, keys),) = found
    also = {s.type: SOURCES[s.type][2] for s in specs}
    rows = _typed(ctx, source).drop("observations", "cancel_observations", "program_exit_observations")
    rows = rows.join(routes(ctx, specs, keys), [f"{key}_id" for key in keys])
    fits = reduce(lambda a, b: a | b, [(F.col(KIND) == kind) & F.expr(condition) for kind, condition in also.items()])
    rows = rows.where(fits)
    if source == "individual":
        gender = ctx.table("gender").select(F.col("id").alias("gender_id"), F.col("name").alias("gender"))
        rows = rows.join(gender, "gender_id", "left")
    return rows


def scans(ctx: Context, specs: Sequence[TableSpec]) -> DataFrame:
    """As :func:`scan`, for tables of several sources: one scan of each."""
    by_source: dict[tuple, list[TableSpec]] = {}
    for spec in specs:
        by_source.setdefault(SOURCES[spec.type][:2], []).append(spec)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [scan(ctx, some) for some in by_source.values()])
