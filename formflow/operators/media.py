"""Media answers as one row per file.

A table is read once for all of its media columns: the columns become an
array of (question, value), so the cost grows with the rows and not with the
number of media questions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.model import MEDIA_CONCEPTS, PARENT_KEY, SUBJECT_TYPES, ColumnSpec, TableSpec
from formflow.operators.maintain import keep_latest

# --- fixed values: the columns of the media table, in order ------------------
MEDIA_COLUMNS = (
    "entity_id", "uuid", "is_voided", "created_by_id", "last_modified_by_id", "created_date_time",
    "last_modified_date_time", "organisation_id", "address_id", "image_url",
    "sync_parameter_key1", "sync_parameter_value1", "sync_parameter_key2",
    "sync_parameter_value2", "subject_type_name", "encounter_type_name", "program_name",
    "concept_name", "subject_first_name", "subject_last_name", "subject_middle_name",
    "media_metadata", "question_group_concept_name", "repeatable_question_group_index",
)
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class MediaNames:
    """Names that are the same for every row of one source table."""

    subject_type: str | None = None
    encounter_type: str | None = None
    program: str | None = None
    # question uuid -> question name, for the media columns of the table
    concepts: dict[str, str] = field(default_factory=dict)
    # (question name, column of the table) of the two sync attributes
    sync1: tuple[str, str] | None = None
    sync2: tuple[str, str] | None = None


def subject_id_col(spec: TableSpec) -> str:
    """Which column of a table holds the subject's id."""
    if spec.type in SUBJECT_TYPES:
        return "id"
    return "subject_id" if spec.type == "ManualProgramEnrolmentEligibility" else "individual_id"


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _sync(pair: tuple[str, str] | None, side: str) -> tuple[Column, Column]:
    if pair is None:
        return _text(None), _text(None)
    return F.lit(pair[0]), F.col(f"{side}.`{pair[1]}`").cast("string")


def _subjects(subject: DataFrame) -> DataFrame:
    """The few subject columns a media row takes, under names of their own."""
    middle = F.col("middle_name") if "middle_name" in subject.columns else _text(None)
    audit = ("is_voided", "created_by_id", "last_modified_by_id", "created_date_time",
             "last_modified_date_time", "organisation_id", "address_id")
    return subject.select(
        F.col("id").alias("s_id"),
        F.col("first_name").alias("subject_first_name"),
        F.col("last_name").alias("subject_last_name"),
        middle.alias("subject_middle_name"),
        *[F.col(c).alias(f"s_{c}") if c in subject.columns else F.lit(None).alias(f"s_{c}") for c in audit],
    )


def _answered(
    entity: DataFrame, columns: Sequence[ColumnSpec], names: MediaNames, use_column_name: bool = False
) -> DataFrame:
    """One row per answered media question: _concept, _group, _value."""
    asked = F.array(
        *[
            F.struct(
                _text(c.name if use_column_name else names.concepts.get(c.concept_uuid, c.name)).alias("_concept"),
                _text(c.parent_name or "").alias("_group"),
                F.col(f"`{c.name}`").cast("string").alias("_value"),
            )
            for c in columns
        ]
    )
    media = {c.name for c in columns}
    rest = [F.col(f"`{c}`") for c in entity.columns if c not in media]
    return entity.select(*rest, F.inline(F.filter(asked, lambda q: q["_value"].isNotNull())))


def media_legacy(
    entity: DataFrame,
    subject: DataFrame,
    columns: Sequence[ColumnSpec],
    names: MediaNames,
    subject_id: str = "individual_id",
) -> DataFrame:
    """Plain media answers: a list of URLs, or one URL."""
    urls = F.when(F.col("_value").startswith("["), F.from_json("_value", "array<string>")).otherwise(
        F.array("_value")
    )
    rows = _answered(entity, columns, names).withColumn("image_url", F.explode(urls)).alias("e")
    rows = rows.join(_subjects(subject), F.col(f"e.{subject_id}") == F.col("s_id"))
    key1, value1 = _sync(names.sync1, "e")
    key2, value2 = _sync(names.sync2, "e")
    return rows.select(
        F.col("e.id").alias("entity_id"),
        *[F.col(f"e.{c}") for c in ("uuid", "is_voided", "created_by_id", "last_modified_by_id",
                                    "created_date_time", "last_modified_date_time",
                                    "organisation_id", "address_id", "image_url")],
        key1.alias("sync_parameter_key1"),
        value1.alias("sync_parameter_value1"),
        key2.alias("sync_parameter_key2"),
        value2.alias("sync_parameter_value2"),
        _text(names.subject_type).alias("subject_type_name"),
        _text(names.encounter_type).alias("encounter_type_name"),
        _text(names.program).alias("program_name"),
        F.col("_concept").alias("concept_name"),
        "subject_first_name",
        "subject_last_name",
        "subject_middle_name",
        _text(None).alias("media_metadata"),
        _text(None).alias("question_group_concept_name"),
        F.lit(None).cast("bigint").alias("repeatable_question_group_index"),
    )


def media_v3(
    entity: DataFrame,
    subject: DataFrame,
    columns: Sequence[ColumnSpec],
    names: MediaNames,
    subject_id: str = "individual_id",
) -> DataFrame:
    """Media answers with metadata: a list of URLs or ``{uri}`` objects.

    Anything that is not a list counts as the URL of one file. Audit users
    come from the subject; other audit columns fall back to it.
    """
    value = F.col("_value")
    single = F.array(F.parse_json(F.to_json(F.struct(value.alias("uri")))))
    files = F.when(value.startswith("["), F.from_json("_value", "array<variant>")).otherwise(single)
    rows = _answered(entity, columns, names).withColumn("_file", F.explode(files)).alias("e")
    rows = rows.join(_subjects(subject), F.col(f"e.{subject_id}") == F.col("s_id"))
    key1, value1 = _sync(names.sync1, "e")
    key2, value2 = _sync(names.sync2, "e")
    file = F.col("e._file")
    return rows.select(
        F.col("e.id").alias("entity_id"),
        F.col("e.uuid").alias("uuid"),
        F.coalesce("e.is_voided", "s_is_voided", F.lit(False)).alias("is_voided"),
        F.col("s_created_by_id").alias("created_by_id"),
        F.col("s_last_modified_by_id").alias("last_modified_by_id"),
        *[
            F.coalesce(f"e.{c}", f"s_{c}").alias(c)
            for c in ("created_date_time", "last_modified_date_time", "organisation_id", "address_id")
        ],
        F.coalesce(F.try_variant_get(file, "$.uri", "string"), F.variant_get(file, "$", "string")).alias("image_url"),
        key1.alias("sync_parameter_key1"),
        value1.alias("sync_parameter_value1"),
        key2.alias("sync_parameter_key2"),
        value2.alias("sync_parameter_value2"),
        _text(names.subject_type).alias("subject_type_name"),
        _text(names.encounter_type).alias("encounter_type_name"),
        _text(names.program).alias("program_name"),
        F.col("_concept").alias("concept_name"),
        "subject_first_name",
        "subject_last_name",
        "subject_middle_name",
        F.to_json(file).alias("media_metadata"),
        F.col("_group").alias("question_group_concept_name"),
        F.lit(-1).cast("bigint").alias("repeatable_question_group_index"),
    )


def media_repeat(
    group: DataFrame,
    parent: DataFrame,
    subject: DataFrame,
    columns: Sequence[ColumnSpec],
    names: MediaNames,
    parent_id: str,
    subject_id: str = "individual_id",
) -> DataFrame:
    """Media answers inside repeatable groups: escaped lists or http URLs.

    Identity and audit columns are those of the row the group hangs off, and
    the question is named by its column.
    """
    value = F.col("_value")
    plain = F.replace(F.replace(value, F.lit('\\"'), F.lit('"')), F.lit('"['), F.lit("["))
    urls = F.when(value.startswith("["), F.from_json(plain, "array<string>")).when(
        value.startswith("http"), F.array(value)
    )
    rows = (
        _answered(group, columns, names, use_column_name=True)
        .select(
            F.col(parent_id).alias("p_key"),
            F.col(subject_id).alias("s_key"),
            F.col("is_voided").alias("g_is_voided"),
            "repeatable_question_group_index",
            "_concept",
            "_group",
            F.explode(urls).alias("image_url"),
        )
    )
    audit = ("uuid", "created_by_id", "last_modified_by_id", "created_date_time",
             "last_modified_date_time", "organisation_id", "address_id")
    parents = parent.select(
        F.col("id").alias("entity_id"), *audit, F.col("is_voided").alias("p_is_voided")
    )
    return (
        rows.join(parents, F.col("p_key") == F.col("entity_id"))
        .join(_subjects(subject), F.col("s_key") == F.col("s_id"))
        .select(
            "entity_id",
            "uuid",
            F.coalesce("g_is_voided", "p_is_voided", F.lit(False)).alias("is_voided"),
            "created_by_id",
            "last_modified_by_id",
            "created_date_time",
            "last_modified_date_time",
            "organisation_id",
            "address_id",
            "image_url",
            *[_text(None).alias(f"sync_parameter_{part}{i}") for i in (1, 2) for part in ("key", "value")],
            _text(names.subject_type).alias("subject_type_name"),
            _text(names.encounter_type).alias("encounter_type_name"),
            _text(names.program).alias("program_name"),
            F.col("_concept").alias("concept_name"),
            "subject_first_name",
            "subject_last_name",
            _text(None).alias("subject_middle_name"),
            F.to_json(F.struct(F.col("image_url").alias("uri"))).alias("media_metadata"),
            F.col("_group").alias("question_group_concept_name"),
            F.col("repeatable_question_group_index").cast("bigint").alias("repeatable_question_group_index"),
        )
    )


@dataclass(frozen=True)
class MediaSource:
    """One flat table with media columns, its subjects and, for a repeat
    group, the table it hangs off."""

    spec: TableSpec
    rows: DataFrame
    subjects: DataFrame
    names: MediaNames
    parent: DataFrame | None = None


def media_of(source: MediaSource) -> list[DataFrame]:
    """Media rows of one table: at most one pass per answer form."""
    spec = source.spec
    columns = spec.of_concept_types(*MEDIA_CONCEPTS)
    key = subject_id_col(spec)
    if spec.repeat_uuid:
        parent_id = PARENT_KEY[spec.parent_type]
        return [media_repeat(source.rows, source.parent, source.subjects, columns, source.names, parent_id, key)] if columns else []
    legacy = [c for c in columns if c.concept_type != "ImageV2" and c.parent_uuid is None]
    modern = [c for c in columns if c not in legacy]
    out = []
    if legacy:
        out.append(media_legacy(source.rows, source.subjects, legacy, source.names, key))
    if modern:
        out.append(media_v3(source.rows, source.subjects, modern, source.names, key))
    return out


def media_id() -> Column:
    """A number that stays a file's own whatever run writes it: 60 bits of a hash of entity, question, place and file."""
    place = [F.coalesce("question_group_concept_name", F.lit("")), F.coalesce("repeatable_question_group_index", F.lit(-1)).cast("string")]
    text = F.concat_ws("|", F.col("entity_id").cast("string"), "concept_name", *place, "image_url")
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint").alias("id")


def build_media(sources: Sequence[MediaSource]) -> DataFrame | None:
    """All media rows of the given tables, with their ids; None if no table has media."""
    parts = [df for source in sources for df in media_of(source)]
    return reduce(lambda a, b: a.unionByName(b), parts).select(media_id(), "*") if parts else None


def dedupe_media(media: DataFrame) -> DataFrame:
    """The newest set of files per entity and question; ties stay."""
    keyed = media.withColumns(
        {
            "_g": F.coalesce("question_group_concept_name", F.lit("")),
            "_i": F.coalesce("repeatable_question_group_index", F.lit(-1)),
        }
    )
    return keep_latest(keyed, ["entity_id", "concept_name", "_g", "_i"], "last_modified_date_time", "rank").drop(
        "_g", "_i"
    )
