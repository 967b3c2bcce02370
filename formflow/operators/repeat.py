"""Repeatable question groups: one row per element of a JSON list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.functions.obs import obs_path, parse_obs, project_answers
from formflow.model import TableSpec
from formflow.operators.entities import answer_dictionary, of_subjects, type_ids
from formflow.sources.snapshots import PART, month_of
from formflow.sources.tables import Context

INDEX = "repeatable_question_group_index"
_TAIL = ("address_id", "is_voided", "organisation_id", "last_modified_date_time")


def explode_group(df: DataFrame, json_col: str, uuid: str) -> DataFrame:
    """One row per element of the list answer, with its 0-based index.

    No answer, an answer that is not a list, or an empty list gives no row; a
    list kept as text is read as one. The document becomes the element.
    """
    rest = [c for c in df.columns if c != json_col]
    answer = F.variant_get(F.col("_obs"), obs_path(uuid), "variant")
    in_text = F.try_parse_json(F.try_variant_get(answer, "$", "string"))
    elements = F.coalesce(
        F.try_variant_get(answer, "$", "array<variant>"), F.try_variant_get(in_text, "$", "array<variant>")
    )
    exploded = df.withColumn("_obs", parse_obs(df, json_col)).select(
        *rest, F.posexplode(elements).alias(INDEX, json_col)
    )
    return exploded.withColumn(INDEX, F.col(INDEX).cast("bigint"))


def _project(ctx: Context, spec: TableSpec, rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    keep = [*keys, *_TAIL, *([PART] if PART in rows.columns else [])]
    exploded = explode_group(rows.select(*keep, "observations"), "observations", spec.repeat_uuid)
    return project_answers(
        exploded, spec.answers, "observations", answer_dictionary(ctx, spec), [*keep, INDEX]
    )


def _of_kind(ctx: Context, spec: TableSpec, source: str) -> DataFrame:
    """Changed visits of the table's kind that are not cancelled."""
    kinds = type_ids(ctx, "encounter_type", spec.encounter_type_uuid, "encounter_type_id")
    return ctx.changed(source).where(F.col("cancel_date_time").isNull()).join(kinds, "encounter_type_id", "left_semi")


def _subjects(ctx: Context, spec: TableSpec) -> DataFrame:
    ids = type_ids(ctx, "subject_type", spec.subject_type_uuid, "subject_type_id")
    return ctx.changed("individual").join(ids, "subject_type_id", "left_semi")


def _enrolments(ctx: Context, spec: TableSpec) -> DataFrame:
    programs = type_ids(ctx, "program", spec.program_uuid, "program_id")
    return of_subjects(ctx, spec, "program_enrolment", ctx.changed("program_enrolment").join(programs, "program_id", "left_semi"))


def _program_visits(ctx: Context, spec: TableSpec) -> DataFrame:
    """The subject is the one of the enrolment."""
    rows = _of_kind(ctx, spec, "program_encounter").drop("individual_id")
    return of_subjects(ctx, spec, "program_encounter", rows).withColumnRenamed("enrolled_id", "individual_id")


# form of a repeat group: its rows, under which name their id is kept, and the ids kept besides
_PARENTS = {
    "IndividualProfile": (_subjects, "individual_id", ()),
    "Encounter": (lambda ctx, spec: of_subjects(ctx, spec, "encounter", _of_kind(ctx, spec, "encounter")), "encounter_id", ("individual_id",)),
    "ProgramEnrolment": (_enrolments, "program_enrolment_id", ("individual_id",)),
    "ProgramEncounter": (_program_visits, "program_encounter_id", ("individual_id", "program_enrolment_id")),
}


def repeat_group(ctx: Context, spec: TableSpec, by_month: bool = False) -> DataFrame:
    """The changed rows of a repeat-group table, by the form it hangs off.

    ``by_month`` adds the partition of each row: the month its parent was created in,
    so that a new list of a parent replaces the old one inside one month.
    """
    parents, key, others = _PARENTS[spec.parent_type]
    rows = parents(ctx, spec)
    if by_month:
        rows = rows.withColumn(PART, month_of(rows, "created_date_time"))
    return _project(ctx, spec, rows.withColumnRenamed("id", key), (*others, key))
