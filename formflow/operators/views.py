"""Reporting views over families of flat tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formflow.functions.obs import ANSWER_SEPARATOR
from formflow.model import SUBJECT_TYPES, VISIT_TYPES, ColumnSpec, TableSpec, pick_tables
from formflow.operators.families import KIND, Family, rows_of

# --- fixed values -----------------------------------------------------------
SUBJECT_VIEW = (
    ("individual_id", "bigint"), ("individual_uuid", "string"), ("first_name", "string"),
    ("date_of_birth", "date"), ("last_name", "string"), ("gender", "string"),
    ("registration_date", "date"), ("created_date_time", "timestamp"),
    ("last_modified_date_time", "timestamp"), ("is_voided", "boolean"),
    ("subject_type_uuid", "string"), ("address_id", "bigint"),
    ("created_by_username", "string"), ("last_modified_by_username", "string"),
    ("subject_type", "string"),
)
ENROLMENT_VIEW = (
    ("enrolment_id", "bigint"), ("enrolment_uuid", "string"), ("program_uuid", "string"),
    ("individual_id", "bigint"), ("enrolment_date_time", "timestamp"),
    ("created_date_time", "timestamp"), ("last_modified_date_time", "timestamp"),
    ("is_voided", "boolean"), ("program_exit_date_time", "timestamp"), ("address_id", "bigint"),
    ("created_by_username", "string"), ("last_modified_by_username", "string"),
    ("program_name", "string"), ("individual_uuid", "string"), ("first_name", "string"),
    ("last_name", "string"),
)
VISITS_VIEW = (
    ("id", "bigint"), ("uuid", "string"), ("name", "string"), ("individual_id", "bigint"),
    ("encounter_type_uuid", "string"), ("encounter_date_time", "timestamp"),
    ("cancel_date_time", "timestamp"), ("is_voided", "boolean"),
    ("earliest_visit_date_time", "timestamp"), ("max_visit_date_time", "timestamp"),
    ("created_date_time", "timestamp"), ("last_modified_date_time", "timestamp"),
    ("address_id", "bigint"), ("created_by_username", "string"),
    ("last_modified_by_username", "string"), ("filled_by_username", "string"),
    ("individual_uuid", "string"), ("first_name", "string"), ("last_name", "string"),
    ("encounter_type_name", "string"),
)
# The spelling in which one column was first released.
COMPAT_NAMES = {"individual_uuid": "indvidual_uuid"}
# --- end of fixed values ----------------------------------------------------

def address_columns(types: DataFrame, org_ids: Iterable[int] | None = None) -> list[str]:
    """Names of the live address levels, which are columns of every view."""
    live = types.where(~F.col("is_voided"))
    if org_ids is not None:
        live = live.where(F.col("organisation_id").isin(sorted(org_ids)))
    return [r["name"] for r in live.select("name").distinct().orderBy("name").collect()]


def empty_view(spark: SparkSession, columns: Sequence[tuple[str, str]], levels: Sequence[str] = ()) -> DataFrame:
    """A view over no tables: all of its columns, no rows."""
    fields = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in columns]
    fields += [T.StructField(level, T.StringType()) for level in levels]
    return spark.createDataFrame([], T.StructType(fields))


def family(specs: Sequence[TableSpec], tables: dict[str, DataFrame], types: tuple[str, ...]) -> list[tuple[TableSpec, DataFrame]]:
    return [(s, tables[s.name]) for s in pick_tables(list(specs), types)]


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _usernames(rows: DataFrame, users: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Adds user names for the given id columns."""
    names = users.select(F.col("id").alias("_user"), F.col("username").alias("_username"))
    for key, out in roles.items():
        side = names.withColumnsRenamed({"_user": f"_{key}", "_username": out})
        rows = rows.join(side, F.col(key) == F.col(f"_{key}"), "left").drop(f"_{key}", key)
    return rows


def _address(rows: DataFrame, address: DataFrame, levels: Sequence[str]) -> DataFrame:
    side = address.select(F.col("id").alias("address_id"), *[F.col(f"`{c}`") for c in levels])
    return rows.join(side, "address_id")


def _named(types: DataFrame, key: str, out: str, org_ids: Iterable[int] | None) -> DataFrame:
    if org_ids is not None:
        types = types.where(F.col("organisation_id").isin(sorted(org_ids)))
    return types.select(F.col("uuid").alias(key), F.col("name").alias(out))


def subject_view(
    subjects: Family,
    users: DataFrame,
    subject_types: DataFrame,
    address: DataFrame,
    levels: Sequence[str],
    org_ids: Iterable[int] | None = None,
    compat: bool = False,
) -> DataFrame:
    """All live subjects with their type, address and user names."""

    rows = rows_of(subjects)
    if rows is None:
        out = empty_view(users.sparkSession, SUBJECT_VIEW, levels)
    else:
        person = F.col(KIND) == "Person"
        for name, kind in (("date_of_birth", "date"), ("gender", "string")):  # of persons only
            known = F.when(person, F.col(name)) if name in rows.columns else F.lit(None)
            rows = rows.withColumn(name, known.cast(kind))
        rows = rows.where(~F.col("is_voided")).select(
            F.col("id").alias("individual_id"),
            F.col("uuid").alias("individual_uuid"),
            "first_name",
            "date_of_birth",
            "last_name",
            "gender",
            "registration_date",
            "created_date_time",
            "last_modified_date_time",
            "is_voided",
            "subject_type_uuid",
            "address_id",
            "created_by_id",
            "last_modified_by_id",
        )
        rows = rows.join(_named(subject_types, "subject_type_uuid", "subject_type", org_ids), "subject_type_uuid")
        rows = _address(rows, address, levels)
        rows = _usernames(
            rows,
            users,
            {"created_by_id": "created_by_username", "last_modified_by_id": "last_modified_by_username"},
        )
        out = rows.select(*[c for c, _ in SUBJECT_VIEW], *[F.col(f"`{c}`") for c in levels])
    return out.withColumnsRenamed(COMPAT_NAMES) if compat else out


def enrolment_view(
    enrolments: Family,
    users: DataFrame,
    programs: DataFrame,
    individual: DataFrame,
    address: DataFrame,
    levels: Sequence[str],
    org_ids: Iterable[int] | None = None,
) -> DataFrame:
    """All live enrolments with programme, subject, address and user names."""
    rows = rows_of(enrolments)
    if rows is None:
        return empty_view(users.sparkSession, ENROLMENT_VIEW, levels)
    rows = rows.where(~F.col("is_voided")).select(
        F.col("id").alias("enrolment_id"),
        F.col("uuid").alias("enrolment_uuid"),
        "program_uuid",
        "individual_id",
        "enrolment_date_time",
        "created_date_time",
        "last_modified_date_time",
        "is_voided",
        "program_exit_date_time",
        "address_id",
        "created_by_id",
        "last_modified_by_id",
    )
    rows = rows.join(_named(programs, "program_uuid", "program_name", org_ids), "program_uuid")
    rows = rows.join(_people(individual), "individual_id")
    rows = _address(rows, address, levels)
    rows = _usernames(
        rows, users, {"created_by_id": "created_by_username", "last_modified_by_id": "last_modified_by_username"}
    )
    return rows.select(*[c for c, _ in ENROLMENT_VIEW], *[F.col(f"`{c}`") for c in levels])


def _people(individual: DataFrame) -> DataFrame:
    return individual.select(
        F.col("id").alias("individual_id"), F.col("uuid").alias("individual_uuid"), "first_name", "last_name"
    )


def _visits(
    visits: Family,
    users: DataFrame,
    individual: DataFrame,
    encounter_types: DataFrame,
    address: DataFrame,
    levels: Sequence[str],
    keep: Column,
) -> DataFrame:
    rows = rows_of(visits)
    if rows is None:
        return empty_view(users.sparkSession, VISITS_VIEW, levels)
    rows = rows.where(keep).select(
        "id",
        "uuid",
        "name",
        "individual_id",
        "encounter_type_uuid",
        "encounter_date_time",
        "cancel_date_time",
        "is_voided",
        "earliest_visit_date_time",
        "max_visit_date_time",
        "created_date_time",
        "last_modified_date_time",
        "address_id",
        "created_by_id",
        "last_modified_by_id",
        "filled_by_id",
    )
    rows = rows.join(_named(encounter_types, "encounter_type_uuid", "encounter_type_name", None), "encounter_type_uuid")
    rows = rows.join(_people(individual), "individual_id")
    rows = _address(rows, address, levels)
    rows = _usernames(
        rows,
        users,
        {
            "created_by_id": "created_by_username",
            "last_modified_by_id": "last_modified_by_username",
            "filled_by_id": "filled_by_username",
        },
    )
    return rows.select(*[c for c, _ in VISITS_VIEW], *[F.col(f"`{c}`") for c in levels])


def _day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def due_visits(visits, users, individual, encounter_types, address, levels, as_of: str) -> DataFrame:
    """Visits whose time has come and not passed.

    Done and cancelled visits are not excluded, and a cancelled visit shows
    once per table that holds it.
    """
    day = _day(as_of)
    keep = (F.col("earliest_visit_date_time") < day) & (day < F.col("max_visit_date_time")) & ~F.col("is_voided")
    return _visits(visits, users, individual, encounter_types, address, levels, keep)


def completed_visits(visits, users, individual, encounter_types, address, levels) -> DataFrame:
    """Visits made and not cancelled."""
    keep = F.col("encounter_date_time").isNotNull() & F.col("cancel_date_time").isNull() & ~F.col("is_voided")
    return _visits(visits, users, individual, encounter_types, address, levels, keep)


def overdue_visits(visits, users, individual, encounter_types, address, levels, as_of: str) -> DataFrame:
    """Visits past their last day, neither made nor cancelled."""
    keep = (
        (_day(as_of) > F.col("max_visit_date_time"))
        & F.col("encounter_date_time").isNull()
        & F.col("cancel_date_time").isNull()
        & ~F.col("is_voided")
    )
    return _visits(visits, users, individual, encounter_types, address, levels, keep)


def coded_view(df: DataFrame, columns: Sequence[ColumnSpec]) -> DataFrame:
    """One row per chosen answer of every multi-select column, in one scan."""
    picked = F.array(
        *[
            F.struct(
                F.lit(c.concept_id).cast("string").alias("concept_id"),
                F.lit(c.concept_uuid).alias("concept_uuid"),
                F.lit(c.name).alias("concept_name"),
                F.lit(c.parent_uuid or "").alias("parent_concept_uuid"),
                F.lit(c.parent_name or "").alias("parent_concept_name"),
                F.split(F.col(f"`{c.name}`"), ANSWER_SEPARATOR).alias("_answers"),
            )
            for c in columns
        ]
    )
    rows = df.where(~F.col("is_voided")).select("id", "is_voided", "last_modified_date_time", F.inline(picked))
    names = [c for c in rows.columns if c != "_answers"]
    return rows.select(*names, F.explode("_answers").alias("answer")).where(F.col("answer") != "")


def individual_address(
    individual: DataFrame, subject_types: DataFrame, gender: DataFrame, address: DataFrame
) -> DataFrame:
    """Subjects with type and gender names and all address columns."""
    types = subject_types.select(F.col("id").alias("subject_type_id"), F.col("name").alias("subject_type"))
    genders = gender.select(F.col("id").alias("gender_id"), F.col("name").alias("gender"))
    people = individual.select(
        F.col("id").alias("individual_id"),
        "subject_type_id",
        F.col("uuid").alias("individual_uuid"),
        "first_name",
        "last_name",
        "middle_name",
        "date_of_birth",
        "gender_id",
        F.col("registration_date").alias("individual_registration_date"),
        F.col("created_date_time").alias("individual_created_date_time"),
        F.col("last_modified_date_time").alias("individual_last_modified_date_time"),
        F.col("address_id").alias("_address_id"),
    )
    return (
        people.join(types, "subject_type_id")
        .join(genders, "gender_id", "left")
        .join(address, F.col("_address_id") == address["id"])
        .select(
            "individual_id",
            "subject_type",
            "individual_uuid",
            "first_name",
            "last_name",
            "middle_name",
            "date_of_birth",
            "gender",
            "individual_registration_date",
            "individual_created_date_time",
            "individual_last_modified_date_time",
            *[address[f"`{c}`"] for c in address.columns],
        )
    )


def enrolment_address(
    individual: DataFrame, enrolment: DataFrame, program: DataFrame, address: DataFrame
) -> DataFrame:
    """Enrolments of subjects that have an address, with programme names."""
    programs = program.select(F.col("id").alias("program_id"), F.col("name").alias("program_name"))
    placed = _people(individual.join(address.select(F.col("id").alias("address_id")), "address_id", "left_semi"))
    return (
        enrolment.select(
            F.col("id").alias("enrolment_id"),
            F.col("uuid").alias("enrolment_uuid"),
            "program_id",
            "individual_id",
            "enrolment_date_time",
            F.col("created_date_time").alias("enrolment_created_date_time"),
            F.col("last_modified_date_time").alias("enrolment_last_modified_date_time"),
        )
        .join(programs, "program_id")
        .join(placed, "individual_id")
        .select(
            "enrolment_id",
            "enrolment_uuid",
            "program_name",
            "individual_id",
            "individual_uuid",
            "first_name",
            "last_name",
            "enrolment_date_time",
            "enrolment_created_date_time",
            "enrolment_last_modified_date_time",
        )
    )


def subject_family(specs: Sequence[TableSpec], tables: dict[str, DataFrame]) -> list[tuple[TableSpec, DataFrame]]:
    return family(specs, tables, SUBJECT_TYPES)


def visit_family(specs: Sequence[TableSpec], tables: dict[str, DataFrame]) -> list[tuple[TableSpec, DataFrame]]:
    return family(specs, tables, VISIT_TYPES)
