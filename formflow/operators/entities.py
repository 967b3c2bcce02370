"""Flattening source entities into per-form tables.

Each operator is one narrow scan of the changed source rows, joined to the
keys that decide which table a row belongs to, with one typed column per
question. Side tables are reduced to the ids that qualify before any join, so
a join only ever carries an id, and the few answers of the subject that are sync
attributes. A run that fills many tables places each source's rows once, by
:func:`place`; the tables then need no join with subjects at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.functions.obs import concept_map, obs_source, project_answers, subject_values
from formflow.model import ColumnSpec, TableSpec
from formflow.operators.maintain import keep_latest
from formflow.sources.tables import Context, in_window

# --- fixed values: columns carried over from each source ---------------------
SUBJECT_COLUMNS = (
    "id", "address_id", "uuid", "first_name", "last_name", "registration_date",
    "registration_location", "is_voided", "created_by_id", "last_modified_by_id",
    "created_date_time", "last_modified_date_time", "organisation_id", "legacy_id",
)
PERSON_COLUMNS = ("date_of_birth", "date_of_birth_verified")
VISIT_COLUMNS = (
    "individual_id", "id", "earliest_visit_date_time", "encounter_date_time", "uuid", "name",
    "address_id", "max_visit_date_time", "is_voided", "encounter_location", "cancel_date_time",
    "cancel_location", "created_by_id", "last_modified_by_id", "filled_by_id",
    "created_date_time", "last_modified_date_time", "organisation_id", "legacy_id",
)
PROGRAM_VISIT_COLUMNS = ("program_enrolment_id",) + VISIT_COLUMNS
ENROLMENT_COLUMNS = (
    "id", "individual_id", "uuid", "address_id", "enrolment_date_time", "enrolment_location",
    "is_voided", "program_exit_date_time", "exit_location", "created_by_id",
    "last_modified_by_id", "created_date_time", "last_modified_date_time", "organisation_id",
    "legacy_id",
)
ELIGIBILITY_COLUMNS = (
    "subject_id", "id", "program_id", "is_eligible", "uuid", "check_date", "is_voided",
    "created_by_id", "last_modified_by_id", "created_date_time", "last_modified_date_time",
    "organisation_id",
)
USER_COLUMNS = (
    "id", "uuid", "username", "organisation_id", "created_by_id", "last_modified_by_id",
    "created_date_time", "last_modified_date_time", "catchment_id", "email", "phone_number",
    "name", "is_voided",
)
TELEMETRY_COLUMNS = (
    "id", "uuid", "user_id", "organisation_id", "created_by_id", "last_modified_by_id",
    "created_date_time", "last_modified_date_time", "sync_status", "sync_start_time",
    "sync_end_time", "device_name", "android_version", "app_version", "device_info",
    "sync_source",
)
EDGE_COLUMNS = (
    "id", "uuid", "is_voided", "created_by_id", "last_modified_by_id", "created_date_time",
    "last_modified_date_time", "organisation_id",
)
USER_SUBJECT_COLUMNS = (
    "id", "uuid", "user_id", "first_name", "last_name", "address_id", "created_by_id",
    "last_modified_by_id", "created_date_time", "last_modified_date_time", "organisation_id",
    "is_voided",
)
# Which column of a source names the subject.
SUBJECT_KEYS = {"encounter": "individual_id", "program_enrolment": "individual_id", "subject_program_eligibility": "subject_id"}
HEAD_ROLE = "Head of household"
HEAD_COLUMN = "Head of household ID"
# --- end of fixed values ----------------------------------------------------

#: Type of a placed row's subject, and programme of a placed visit.
SUBJECT_TYPE, PROGRAM = "_subject_type_id", "_program_id"


def answer_dictionary(ctx: Context, spec: TableSpec) -> DataFrame:
    uuids = sorted({c.concept_uuid for c in spec.answers})
    return concept_map(ctx.table("concept"), ctx.table("concept_answer"), uuids)


def type_ids(ctx: Context, table: str, uuid: str, name: str) -> DataFrame:
    """Ids of a type, programme or visit kind by uuid, under column ``name``."""
    return ctx.table(table).where(F.col("uuid") == uuid).select(F.col("id").alias(name))


def sync_columns(specs: Iterable[TableSpec]) -> list[ColumnSpec]:
    return [c for s in specs for c in s.answers if c.is_sync_attribute]


def subject_keys(ctx: Context, columns: Sequence[ColumnSpec], key: str, type_uuid: str | None = None) -> DataFrame:
    """Of each subject (of one type) its id as ``key``, its type and its answers to the sync questions ``columns``."""
    people = ctx.table("individual")
    if type_uuid is not None:
        # a scalar subquery and not a join: the document is not carried through any
        ids = type_ids(ctx, "subject_type", type_uuid, "subject_type_id").agg(F.collect_set("subject_type_id"))
        people = people.where(F.array_contains(ids.scalar(), F.col("subject_type_id")))
    names = concept_map(ctx.table("concept"), ctx.table("concept_answer"), sorted({c.concept_uuid for c in columns}))
    return subject_values(people, list(columns), names, [F.col("id").alias(key), F.col("subject_type_id").alias(SUBJECT_TYPE)])


def enrolment_keys(ctx: Context, columns: Sequence[ColumnSpec], spec: TableSpec | None = None) -> DataFrame:
    """Of each enrolment (that a table's visits may belong to) its id, programme and subject, with the subject's key columns."""
    enrolled = ctx.table("program_enrolment").select(
        F.col("id").alias("program_enrolment_id"), F.col("individual_id").alias("enrolled_id"), F.col("program_id").alias(PROGRAM)
    )
    if spec is not None:
        enrolled = enrolled.join(type_ids(ctx, "program", spec.program_uuid, PROGRAM), PROGRAM, "left_semi")
    return enrolled.join(subject_keys(ctx, columns, "enrolled_id", spec and spec.subject_type_uuid), "enrolled_id")


def place(ctx: Context, source: str, rows: DataFrame, columns: Sequence[ColumnSpec], spec: TableSpec | None = None) -> DataFrame:
    """Rows of a source with their subject's type and sync answers (a visit's in a programme: also its programme).

    With ``spec`` only rows of subjects (and programmes) that fit the table.
    """
    if source == "program_encounter":
        return rows.join(enrolment_keys(ctx, columns, spec), "program_enrolment_id")
    key = SUBJECT_KEYS[source]
    return rows.join(subject_keys(ctx, columns, key, spec and spec.subject_type_uuid), key)


def of_subjects(ctx: Context, spec: TableSpec, source: str, rows: DataFrame) -> DataFrame:
    """The rows whose subject (and programme) fits the table; of rows that are placed already without a join with subjects."""
    if SUBJECT_TYPE not in rows.columns:
        return place(ctx, source, rows, sync_columns([spec]), spec)
    rows = rows.join(type_ids(ctx, "subject_type", spec.subject_type_uuid, SUBJECT_TYPE), SUBJECT_TYPE, "left_semi")
    if source == "program_encounter":
        rows = rows.join(type_ids(ctx, "program", spec.program_uuid, PROGRAM), PROGRAM, "left_semi")
    return rows


def _answers(ctx: Context, spec: TableSpec, rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return project_answers(
        rows,
        spec.answers,
        obs_source(spec),
        answer_dictionary(ctx, spec),
        list(keep),
    )


def flatten_individual(ctx: Context, spec: TableSpec) -> DataFrame:
    """Registration of an individual, household or group."""
    ids = type_ids(ctx, "subject_type", spec.subject_type_uuid, "subject_type_id")
    rows = ctx.changed("individual").join(ids, "subject_type_id", "left_semi")
    return _answers(ctx, spec, rows, SUBJECT_COLUMNS)


def flatten_person(ctx: Context, spec: TableSpec) -> DataFrame:
    """Registration of a person, with gender and, if in use, middle name."""
    ids = type_ids(ctx, "subject_type", spec.subject_type_uuid, "subject_type_id")
    gender = ctx.table("gender").select(F.col("id").alias("gender_id"), F.col("name").alias("gender"))
    rows = (
        ctx.changed("individual").join(ids, "subject_type_id", "left_semi").join(gender, "gender_id", "left")
    )
    extra = ("middle_name",) if spec.has("middle_name") else ()
    return _answers(ctx, spec, rows, SUBJECT_COLUMNS + ("gender",) + PERSON_COLUMNS + extra)


def _encounters(ctx: Context, spec: TableSpec, cancelled: bool) -> DataFrame:
    visits = ctx.changed("encounter")
    if cancelled:
        visits = visits.where(F.col("cancel_date_time").isNotNull())
    kinds = type_ids(ctx, "encounter_type", spec.encounter_type_uuid, "encounter_type_id")
    rows = of_subjects(ctx, spec, "encounter", visits.join(kinds, "encounter_type_id", "left_semi"))
    return _answers(ctx, spec, rows, VISIT_COLUMNS)


def flatten_encounter(ctx: Context, spec: TableSpec) -> DataFrame:
    """General visit."""
    return _encounters(ctx, spec, cancelled=False)


def flatten_encounter_cancel(ctx: Context, spec: TableSpec) -> DataFrame:
    """Cancelled general visit, with the answers of the cancellation form."""
    return _encounters(ctx, spec, cancelled=True)


def _enrolments(ctx: Context, spec: TableSpec, exited: bool) -> DataFrame:
    rows = ctx.changed("program_enrolment")
    if exited:
        rows = rows.where(F.col("program_exit_date_time").isNotNull())
    programs = type_ids(ctx, "program", spec.program_uuid, "program_id")
    rows = of_subjects(ctx, spec, "program_enrolment", rows.join(programs, "program_id", "left_semi"))
    return _answers(ctx, spec, rows, ENROLMENT_COLUMNS)


def flatten_enrolment(ctx: Context, spec: TableSpec) -> DataFrame:
    """Programme enrolment."""
    return _enrolments(ctx, spec, exited=False)


def flatten_exit(ctx: Context, spec: TableSpec) -> DataFrame:
    """Programme exit, with the answers of the exit form."""
    return _enrolments(ctx, spec, exited=True)


def _program_encounters(ctx: Context, spec: TableSpec, cancelled: bool) -> DataFrame:
    visits = ctx.changed("program_encounter")
    if cancelled:
        visits = visits.where(F.col("cancel_date_time").isNotNull())
    kinds = type_ids(ctx, "encounter_type", spec.encounter_type_uuid, "encounter_type_id")
    rows = of_subjects(ctx, spec, "program_encounter", visits.join(kinds, "encounter_type_id", "left_semi"))
    return _answers(ctx, spec, rows, PROGRAM_VISIT_COLUMNS)


def flatten_program_encounter(ctx: Context, spec: TableSpec) -> DataFrame:
    """Programme visit."""
    return _program_encounters(ctx, spec, cancelled=False)


def flatten_program_encounter_cancel(ctx: Context, spec: TableSpec) -> DataFrame:
    """Cancelled programme visit, with the answers of the cancellation form."""
    return _program_encounters(ctx, spec, cancelled=True)


def flatten_eligibility(ctx: Context, spec: TableSpec) -> DataFrame:
    """Manual programme eligibility. Not narrowed to a programme."""
    rows = of_subjects(ctx, spec, "subject_program_eligibility", ctx.changed("subject_program_eligibility"))
    return _answers(ctx, spec, rows, ELIGIBILITY_COLUMNS)


def _typed_subjects(ctx: Context, uuid: str, key: str, types: tuple[str, ...] | None = None) -> DataFrame:
    wanted = ctx.table("subject_type").where(F.col("uuid") == uuid)
    if types:
        wanted = wanted.where(F.col("type").isin(*types))
    wanted = wanted.select(F.col("id").alias(f"{key}_type_id"))
    return (
        ctx.table("individual")
        .select(F.col("id").alias(f"{key}_subject_id"), F.col("subject_type_id").alias(f"{key}_type_id"))
        .join(wanted, f"{key}_type_id", "left_semi")
    )


def _edges(ctx: Context, spec: TableSpec, edges: DataFrame, member_types: tuple[str, ...]) -> DataFrame:
    """Membership edges whose two ends and role fit the table."""
    roles = ctx.table("group_role").select(
        F.col("id").alias("group_role_id"),
        F.col("group_subject_type_id").alias("group_type_id"),
        F.col("member_subject_type_id").alias("member_type_id"),
        "role",
    )
    return (
        edges.join(_typed_subjects(ctx, spec.member_subject_type_uuid, "member", member_types), "member_subject_id")
        .join(_typed_subjects(ctx, spec.group_subject_type_uuid, "group"), "group_subject_id")
        .join(roles, ["group_role_id", "group_type_id", "member_type_id"])
    )


def group_members(ctx: Context, spec: TableSpec) -> DataFrame:
    """Edges from groups to their members."""
    edges = _edges(ctx, spec, ctx.changed("group_subject"), ("Person", "Individual"))
    return edges.select(*EDGE_COLUMNS, "group_subject_id", "member_subject_id", "role")


def _head_edges(ctx: Context) -> DataFrame:
    """Edges from households to their heads, voided ones too."""
    edges = ctx.table("group_subject")
    roles = ctx.table("group_role").select(F.col("id").alias("head_role_id"), F.col("role").alias("head_role"))
    return (
        edges.select(
            "group_subject_id",
            F.col("group_role_id").alias("head_role_id"),
            F.col("member_subject_id").alias(HEAD_COLUMN),
            F.col("last_modified_date_time").alias("head_modified"),
            in_window(edges, ctx.start, ctx.end).alias("head_changed"),
            F.col("is_voided").alias("head_voided"),
        )
        .join(roles, "head_role_id", "left")
        .where((F.col("head_role") == HEAD_ROLE) | F.col("head_role").isNull())
        .drop("head_role", "head_role_id")
    )


def household_members(ctx: Context, spec: TableSpec, retract: bool = False) -> DataFrame:
    """Edges from households to their members, with the head of household.

    The edge counts as changed when it or the head's edge changed. A
    household without a live head edge gives no rows; its stored rows are
    taken back by :func:`headless`. When a head changed more than once in one
    run, the newest row per (edge, head) stays.

    With ``retract`` an edge counts as changed, at that time, when any head's edge of
    its household did, a voided one too: its rows with a former head are replaced.
    """
    modified = "last_modified_date_time"
    all_edges = ctx.table("group_subject")
    heads = _head_edges(ctx)
    live = heads.where(~F.col("head_voided")).drop("head_voided")
    if retract:
        of_household = heads.groupBy("group_subject_id").agg(F.max("head_modified").alias("head_modified"), F.bool_or("head_changed").alias("head_changed"))
        live = live.drop("head_modified", "head_changed").join(of_household, "group_subject_id")
    edges = all_edges.withColumn("edge_changed", in_window(all_edges, ctx.start, ctx.end))
    rows = (
        _edges(ctx, spec, edges, ("Person",))
        .join(live, "group_subject_id")
        .where(F.col("edge_changed") | F.col("head_changed"))
        .withColumn(modified, F.greatest(modified, "head_modified"))
        .select(*EDGE_COLUMNS, "group_subject_id", "member_subject_id", "role", HEAD_COLUMN)
    )
    return keep_latest(rows, ["id", HEAD_COLUMN], modified)


def headless(ctx: Context) -> DataFrame:
    """Households with an edge that changed, and without a live head edge: (group_subject_id)."""
    edges = ctx.table("group_subject")
    heads = _head_edges(ctx).where(~F.col("head_voided"))
    touched = edges.where(in_window(edges, ctx.start, ctx.end)).select("group_subject_id").distinct()
    return touched.join(heads.select("group_subject_id"), "group_subject_id", "left_anti")


def copy_users(ctx: Context) -> DataFrame:
    return ctx.changed("users").select(*USER_COLUMNS)


def copy_telemetry(ctx: Context) -> DataFrame:
    """Sync telemetry; the target only grows."""
    return ctx.changed("sync_telemetry").select(*TELEMETRY_COLUMNS)


def user_subjects(ctx: Context, existing: DataFrame, spec: TableSpec | None = None, compat: bool = False) -> DataFrame:
    """Subjects linked to a user that the table does not hold yet.

    With ``compat`` the table's own subject type is not looked at.
    """
    subjects = ctx.table("individual")
    if spec is not None and not compat:
        ids = type_ids(ctx, "subject_type", spec.subject_type_uuid, "subject_type_id")
        subjects = subjects.join(ids, "subject_type_id", "left_semi")
    links = ctx.table("user_subject").select("user_id", F.col("subject_id").alias("id"))
    fresh = links.join(existing.select("user_id", "id"), ["user_id", "id"], "left_anti")
    return subjects.join(fresh, "id").select(*USER_SUBJECT_COLUMNS)


FLATTEN = {
    "Individual": flatten_individual,
    "Household": flatten_individual,
    "Group": flatten_individual,
    "Person": flatten_person,
    "Encounter": flatten_encounter,
    "IndividualEncounterCancellation": flatten_encounter_cancel,
    "ProgramEnrolment": flatten_enrolment,
    "ProgramExit": flatten_exit,
    "ProgramEncounter": flatten_program_encounter,
    "ProgramEncounterCancellation": flatten_program_encounter_cancel,
    "ManualProgramEnrolmentEligibility": flatten_eligibility,
    "GroupToMember": group_members,
    "HouseholdToMember": household_members,
}


def flatten(ctx: Context, spec: TableSpec) -> DataFrame:
    """The changed rows of one flat table."""
    return FLATTEN[spec.type](ctx, spec)
