"""Answers in a JSON document as typed columns.

The document is parsed once per row into a VARIANT; every column is then a
lookup in the parsed value, so a form of several hundred questions still
costs one parse. All expressions stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from formflow.model import CODED_CONCEPTS, ColumnSpec, TableSpec

# --- fixed values -----------------------------------------------------------
ANSWER_ZONE = "Asia/Kolkata"
ANSWER_SEPARATOR = ", "
# Which JSON column of the source row feeds a table type.
OBS_SOURCE = {
    "ProgramExit": "program_exit_observations",
    "ProgramEncounterCancellation": "cancel_observations",
    "IndividualEncounterCancellation": "cancel_observations",
    "Address": "location_properties",
}
# --- end of fixed values ----------------------------------------------------

NUMERIC = "decimal(38,10)"


def obs_source(spec: TableSpec) -> str:
    return OBS_SOURCE.get(spec.type, "observations")


def obs_path(concept: str, parent: str | None = None) -> str:
    """Path of an answer, inside its question group if it has one."""
    keys = [parent, concept] if parent else [concept]
    return "$" + "".join(f'["{key}"]' for key in keys)


def parse_obs(df: DataFrame, json_col: str) -> Column:
    """The document as VARIANT. A column stored as one needs no parse."""
    column = F.col(json_col)
    return column if isinstance(df.schema[json_col].dataType, VariantType) else F.parse_json(column)


def obs_text(obs: Column, path: str) -> Column:
    """The answer as text; lists and objects as JSON text."""
    return F.variant_get(obs, path, "string")


def obs_ref(obs: Column, path: str) -> Column:
    """A reference to another subject, visit or location: its uuid."""
    return obs_text(obs, path)


def obs_numeric(obs: Column, path: str, strict: bool = True) -> Column:
    """Exact decimal. A bad value fails the run unless ``strict`` is off."""
    return F.variant_get(obs, path, NUMERIC) if strict else F.try_variant_get(obs, path, NUMERIC)


def _zoned(obs: Column, path: str, zone: str) -> Column:
    instant = obs_text(obs, path).cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(None, F.lit(zone), instant)


def obs_datetime(obs: Column, path: str, zone: str = ANSWER_ZONE) -> Column:
    """Wall-clock time in ``zone`` of an instant."""
    return _zoned(obs, path, zone)


def obs_date(obs: Column, path: str, zone: str = ANSWER_ZONE) -> Column:
    """Calendar date in ``zone`` of an instant."""
    return _zoned(obs, path, zone).cast("date")


def obs_time(obs: Column, path: str) -> Column:
    """Time of day as ``HH:mm:ss`` text."""
    text = obs_text(obs, path)
    dated = F.when(text.contains("-"), text).otherwise(F.concat(F.lit("1970-01-01 "), text))
    return F.date_format(dated.cast("timestamp_ntz"), "HH:mm:ss")


def obs_json(obs: Column, path: str) -> Column:
    """The answer as JSON, checked and written in one normal text form.

    A text answer has to hold JSON itself.
    """
    return F.to_json(F.parse_json(obs_text(obs, path)))


def coded(obs: Column, path: str, answer_map: Column) -> Column:
    """Names of the chosen answers, joined by a comma and a space.

    One uuid or a list of them; uuids the dictionary does not know drop out,
    and nothing known means null.
    """
    chosen = F.coalesce(
        F.try_variant_get(obs, path, "array<string>"),
        F.array(F.try_variant_get(obs, path, "string")),
    )
    names = F.filter(
        F.transform(F.filter(chosen, lambda x: x.isNotNull()), lambda x: F.try_element_at(answer_map, x)),
        lambda name: name.isNotNull(),
    )
    return F.nullif(F.array_join(names, ANSWER_SEPARATOR), F.lit(""))


def subject_value(spec: ColumnSpec) -> str:
    """Under which name a subject's answer to a sync question travels with its key."""
    return f"subject:{spec.parent_uuid or ''}/{spec.concept_uuid}/{spec.concept_type}"


def sync_attr(spec: ColumnSpec) -> Column:
    """A sync attribute is an answer of the subject, whatever the row is."""
    return F.col(f"`{subject_value(spec)}`").alias(spec.name)


def subject_values(
    subjects: DataFrame, columns: list[ColumnSpec], answers: DataFrame, keep: list[Column | str], strict: bool = True
) -> DataFrame:
    """``keep`` plus the subjects' answers to the sync questions, a few values each.

    They are taken out where the subject is read, so that a join carries them and not the document.
    """
    columns = list({subject_value(c): c for c in columns}.values())
    if not columns:
        return subjects.select(*keep)
    answer_map = F.lit(None)
    if any(c.concept_type in CODED_CONCEPTS for c in columns):
        subjects, answer_map = with_dictionary(subjects, answers), F.col("answer_map")
    subjects = subjects.withColumn("_obs", parse_obs(subjects, "observations"))
    return subjects.select(*keep, *[obs_col(c, F.col("_obs"), answer_map, strict).alias(subject_value(c)) for c in columns])


def obs_col(spec: ColumnSpec, obs: Column, answer_map: Column, strict: bool = True) -> Column:
    """The projection of one answer column out of a parsed document."""
    path = obs_path(spec.concept_uuid, spec.parent_uuid)
    kind = spec.concept_type
    if kind in CODED_CONCEPTS:
        out = coded(obs, path, answer_map)
    elif kind == "Date":
        out = obs_date(obs, path)
    elif kind == "DateTime":
        out = obs_datetime(obs, path)
    elif kind == "Time":
        out = obs_time(obs, path)
    elif kind == "Numeric":
        out = obs_numeric(obs, path, strict)
    elif kind in ("Subject", "Encounter", "Location"):
        out = obs_ref(obs, path)
    elif kind == "ImageV2":
        out = obs_json(obs, path)
    else:
        out = obs_text(obs, path)
    return out.alias(spec.name)


def concept_map(concept: DataFrame, concept_answer: DataFrame, uuids: list[str]) -> DataFrame:
    """One row, one map: uuid to name of every answer of the given questions.

    Bounded by the answers a single form offers. No answers at all still
    gives the one row, with an empty map.
    """
    return concept_map_of(concept, concept_answer, concept.where(F.col("uuid").isin(uuids)))


def concept_map_of(concept: DataFrame, concept_answer: DataFrame, questions: DataFrame) -> DataFrame:
    """As :func:`concept_map`, for questions given as rows."""
    question = questions.select(F.col("id").alias("concept_id"))
    answer = concept.select(F.col("id").alias("answer_concept_id"), "uuid", "name")
    pairs = (
        concept_answer.select("concept_id", "answer_concept_id")
        .join(question, "concept_id", "left_semi")
        .join(answer, "answer_concept_id")
        .groupBy("uuid")
        .agg(F.min("name").alias("name"))
    )
    return pairs.agg(F.map_from_entries(F.collect_list(F.struct("uuid", "name"))).alias("answer_map"))


def with_dictionary(df: DataFrame, answers: DataFrame) -> DataFrame:
    """Adds the map of :func:`concept_map` as column ``answer_map``.

    It is a scalar subquery: worked out once and carried as a constant,
    without a join.
    """
    return df.withColumn("answer_map", answers.select("answer_map").scalar())


def project_answers(
    df: DataFrame,
    columns: list[ColumnSpec] | tuple[ColumnSpec, ...],
    json_col: str,
    answers: DataFrame,
    keep: list[Column | str],
    strict: bool = True,
) -> DataFrame:
    """``keep`` plus one typed column per answer column of a table.

    Sync attributes are on the rows already, as :func:`subject_values` left them.
    """
    own = [c for c in columns if not c.is_sync_attribute]
    answer_map = F.lit(None)
    if any(c.concept_type in CODED_CONCEPTS for c in own):
        df, answer_map = with_dictionary(df, answers), F.col("answer_map")
    if own:
        df = df.withColumn("_obs", parse_obs(df, json_col))
    made = [sync_attr(c) if c.is_sync_attribute else obs_col(c, F.col("_obs"), answer_map, strict) for c in columns]
    return df.select(*keep, *made)
