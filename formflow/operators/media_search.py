"""Searching, counting and checking media."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.model import TEXT_SEARCH_CONCEPTS, TableSpec
from formflow.sources.tables import time_literal

# --- fixed values -----------------------------------------------------------
PAGE_SIZE = 10
DOWNLOAD_ROWS = 1000  # of a download, with compat
NOT_MEDIA = r"(?i)Adhoc|MobileDbBackup"
MEDIA_UUID = r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
THUMBNAIL = r"(?i)thumbnails"
THUMBNAIL_FOLDER = "thumbnails/"
SEARCH_COLUMNS = (
    "id", "uuid", "subject_first_name", "subject_last_name", "subject_middle_name", "is_voided",
    "created_by_id", "last_modified_by_id", "created_date_time", "last_modified_date_time",
    "organisation_id", "image_url", "sync_parameter_key1", "sync_parameter_key2",
    "sync_parameter_value1", "sync_parameter_value2", "subject_type_name",
    "encounter_type_name", "program_name", "concept_name", "address", "entity_id",
    "media_metadata", "question_group_concept_name", "repeatable_question_group_index",
)
MANIFEST_COLUMNS = (
    "composite_uuid", "subject_first_name", "subject_last_name", "subject_middle_name",
    "image_url", "concept_name", "subject_type_name", "program_name", "encounter_type_name",
    "sync_parameter_key1", "sync_parameter_key2", "sync_parameter_value1",
    "sync_parameter_value2", "address",
)
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class ConceptFilter:
    """Keep media whose entity answered a question of a form in some way."""

    form_uuid: str
    concept_uuid: str
    values: tuple[str, ...] = ()
    low: str | None = None
    high: str | None = None


@dataclass(frozen=True)
class MediaRequest:
    """What to search for. Empty parts do not filter."""

    from_date: str | None = None
    to_date: str | None = None
    subject_name: str | None = None
    subject_types: tuple[str, ...] = ()
    programs: tuple[str, ...] = ()
    encounter_types: tuple[str, ...] = ()
    concepts: tuple[str, ...] = ()
    # (question name, accepted values)
    sync_values: tuple[tuple[str, tuple[str, ...]], ...] = ()
    # (level name, ids); a level without ids accepts nothing
    addresses: tuple[tuple[str, tuple[int, ...]], ...] = ()
    concept_filters: tuple[ConceptFilter, ...] = field(default_factory=tuple)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _contains(column: str, token: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` stay wildcards."""
    return F.col(column).ilike(f"%{token}%")


def media_filter(media: DataFrame, req: MediaRequest) -> Column:
    """The request as one condition on media rows (addresses aside)."""
    parts: list[Column] = []
    if req.from_date:
        parts.append(F.col("created_date_time") >= time_literal(media, "created_date_time", req.from_date))
    if req.to_date:
        parts.append(F.col("created_date_time") <= time_literal(media, "created_date_time", req.to_date))
    for token in (req.subject_name or "").split(" "):
        if token:
            names = ("subject_first_name", "subject_middle_name", "subject_last_name")
            parts.append(_any([F.coalesce(_contains(n, token), F.lit(False)) for n in names]))
    for column, wanted in (
        ("subject_type_name", req.subject_types),
        ("program_name", req.programs),
        ("encounter_type_name", req.encounter_types),
        ("concept_name", req.concepts),
    ):
        if wanted:
            parts.append(F.col(column).isin(*wanted))
    if req.sync_values:
        slots = []
        for name, values in req.sync_values:
            for i in (1, 2):
                hit = (F.col(f"sync_parameter_key{i}") == name) & F.col(f"sync_parameter_value{i}").isin(*values)
                slots.append(F.coalesce(hit, F.lit(False)))
        parts.append(_any(slots))
    return _all(parts)


def live_media(media: DataFrame) -> DataFrame:
    return media.where(F.col("image_url").isNotNull() & ~F.col("is_voided"))


def check_levels(address: DataFrame, names: Sequence[str]) -> bool:
    """Every requested level is a column of the address table."""
    return all(name in address.columns for name in names)


def address_json(address: DataFrame, req: MediaRequest | None = None) -> DataFrame:
    """Addresses a request accepts, each as JSON under its id."""
    wanted = address
    if req is not None and req.addresses:
        if not check_levels(address, [level for level, _ in req.addresses]):
            raise ValueError("unknown address level in request")
        # a level without ids can match nothing
        levels = [F.col(f"`{level} id`").isin(*ids) for level, ids in req.addresses if ids]
        wanted = address.where(_any([F.coalesce(x, F.lit(False)) for x in levels]))
    whole = F.struct(*[F.col(f"`{c}`") for c in address.columns])
    return wanted.select(
        F.col("id").alias("address_id"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("address")
    )


def concept_joins(
    media: DataFrame,
    tables: Mapping[str, DataFrame],
    specs: Sequence[TableSpec],
    filters: Sequence[ConceptFilter],
) -> DataFrame:
    """Keep media whose entity passes every filter.

    Filters on one column of one table are merged, values united. An
    entity's id is unique in its table, so each filter is a semi join.
    """
    merged: dict[tuple[str, str], list] = {}
    for wanted in filters:
        for spec in specs:
            if spec.form_uuid != wanted.form_uuid:
                continue
            for column in spec.columns:
                if column.concept_uuid == wanted.concept_uuid:
                    merged.setdefault((spec.name, column.name), [column, []])[1].append(wanted)
    for (table, name), (column, parts) in sorted(merged.items(), key=lambda x: x[0]):
        values = list(dict.fromkeys(v for p in parts for v in p.values))
        rows = tables[table]
        cell = F.col(f"`{name}`")
        kind = rows.schema[name].dataType
        if column.concept_type in TEXT_SEARCH_CONCEPTS:
            condition = _all([cell.ilike(f"%{v}%") for v in values])
        elif values:
            condition = cell.isin(*[F.lit(v).cast(kind) for v in values])
        else:
            condition = cell.between(F.lit(parts[0].low).cast(kind), F.lit(parts[0].high).cast(kind))
        hits = rows.where(condition).select(F.col("id").alias("entity_id"))
        media = media.join(hits, "entity_id", "left_semi")
    return media


def matching_media(
    media: DataFrame,
    address: DataFrame,
    req: MediaRequest,
    tables: Mapping[str, DataFrame] | None = None,
    specs: Sequence[TableSpec] = (),
) -> DataFrame:
    """All media rows a request accepts, with their address as JSON."""
    live = live_media(media)
    rows = concept_joins(live.where(media_filter(live, req)), tables or {}, specs, req.concept_filters)
    return rows.join(address_json(address, req), "address_id")


def _newest_first() -> list[Column]:
    return [
        F.col("created_date_time").desc_nulls_first(),
        F.col("entity_id"),
        F.col("concept_name"),
        F.col("image_url"),
    ]


def search_media(
    media: DataFrame,
    address: DataFrame,
    req: MediaRequest,
    tables: Mapping[str, DataFrame] | None = None,
    specs: Sequence[TableSpec] = (),
    limit: int | None = PAGE_SIZE,
    offset: int = 0,
) -> DataFrame:
    """One page of a search, newest first; everything, in no order, without a limit."""
    rows = matching_media(media, address, req, tables, specs).select(*SEARCH_COLUMNS)
    if limit is None and not offset:
        return rows
    page = rows.orderBy(*_newest_first()).offset(offset)
    return page if limit is None else page.limit(limit)


def count_media(
    media: DataFrame,
    address: DataFrame,
    req: MediaRequest,
    tables: Mapping[str, DataFrame] | None = None,
    specs: Sequence[TableSpec] = (),
    compat: bool = False,
) -> DataFrame:
    """How many rows a search has.

    With ``compat`` the address is joined only when it is filtered on, so
    media without an address count too.
    """
    if compat and not req.addresses:
        live = live_media(media)
        rows = concept_joins(live.where(media_filter(live, req)), tables or {}, specs, req.concept_filters)
    else:
        rows = matching_media(media, address, req, tables, specs)
    return rows.agg(F.count(F.lit(1)).alias("total"))


def all_media(media: DataFrame, address: DataFrame) -> DataFrame:
    """Every live media row, without paging."""
    return matching_media(media, address, MediaRequest()).select(*SEARCH_COLUMNS)


def file_name(url: Column) -> Column:
    """What follows the last slash; nothing without a slash."""
    return F.when(url.contains("/"), F.substring_index(url, "/", -1))


def media_keys(df: DataFrame) -> DataFrame:
    """Adds image_uuid, composite_uuid and thumbnail_url."""
    url = F.col("image_url")
    name = file_name(url)
    stem = F.coalesce(F.substring_index(name, ".", 1), url)
    folder = F.when(url.contains("/"), F.expr("left(image_url, length(image_url) - length(substring_index(image_url, '/', -1)))"))
    return df.withColumns(
        {
            "image_uuid": stem,
            "composite_uuid": F.concat_ws("#", F.coalesce("uuid", F.lit("null")), stem),
            "thumbnail_url": F.concat(
                F.coalesce(folder, F.lit("")), F.lit(THUMBNAIL_FOLDER), F.coalesce(name, F.lit(""))
            ),
        }
    )


def download_manifest(
    media: DataFrame,
    address: DataFrame,
    req: MediaRequest,
    tables: Mapping[str, DataFrame] | None = None,
    specs: Sequence[TableSpec] = (),
    compat: bool = False,
) -> DataFrame:
    """What a download of a search fetches: all of it, or with ``compat`` the newest rows only."""
    limit = DOWNLOAD_ROWS if compat else None
    return media_keys(search_media(media, address, req, tables, specs, limit)).select(*MANIFEST_COLUMNS)


def stored_files(keys: DataFrame) -> DataFrame:
    """Per file name: stored as media, stored as thumbnail."""
    key = F.col("object_key")
    kept = keys.where(~key.rlike(NOT_MEDIA) & key.rlike(MEDIA_UUID))
    thumb = key.rlike(THUMBNAIL)
    return kept.groupBy(file_name(key).alias("_file")).agg(
        F.bool_or(~thumb).alias("_media"), F.bool_or(thumb).alias("_thumb")
    )


def media_analysis(media: DataFrame, keys: DataFrame, tenant_dir: str) -> DataFrame:
    """Per entity and image: is the URL valid, is the file stored, does it
    have a thumbnail, and is there more than one row for it.

    Copies of one image are reduced by map-side combine before anything is
    joined, and the storage side is reduced to file names the same way.
    """
    keyed = media_keys(media).withColumn("_newest", F.col("created_date_time").isNull())
    images = keyed.groupBy("composite_uuid").agg(
        F.max(F.struct("_newest", "created_date_time", "image_url", "uuid")).alias("_first"),
        F.count(F.lit(1)).alias("_copies"),
    )
    valid = F.col("_first.image_url").contains(tenant_dir)
    rows = images.select(
        F.col("_first.uuid").alias("uuid"),
        F.col("_first.image_url").alias("image_url"),
        valid.alias("is_valid_url"),
        # No file name starts with a slash: invalid URLs match nothing, and
        # do not meet as nulls in one shuffle partition either.
        F.when(valid, file_name(F.col("_first.image_url")))
        .otherwise(F.concat(F.lit("/"), "composite_uuid"))
        .alias("_file"),
        (F.col("_copies") > 1).alias("is_having_duplicates"),
    )
    return rows.join(stored_files(keys), "_file", "left").select(
        "uuid",
        "image_url",
        "is_valid_url",
        F.coalesce("_media", F.lit(False)).alias("is_present_in_storage"),
        F.coalesce("_thumb", F.lit(False)).alias("is_thumbnail_generated"),
        "is_having_duplicates",
    )
