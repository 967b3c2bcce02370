"""Media tables, search and storage checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.bindings import bound, with_bindings
from formflow.functions import obs  # noqa: F401
from formflow.model import ColumnSpec, TableSpec, answer_column
from formflow.operators import media, media_search
from formflow.operators.media_search import ConceptFilter, MediaRequest
from formflow.workload.flatten import ADDRESS_SQL, wide_address

QUERIES, ORACLE = {}, {}

PHOTO = answer_column("photo", 16, "Image", "q-photo")
IMAGE = answer_column("image", 17, "ImageV2", "q-image")
NAMES = media.MediaNames(
    subject_type="Person", encounter_type="Home Visit", concepts={"q-photo": "Photo", "q-image": "Image"},
    sync1=("Ward", "ward"),
)
FORM = TableSpec(
    "media_form", "Encounter", "st-person", None, "et-1", "form-1",
    columns=(PHOTO, IMAGE, ColumnSpec("ward", "text", 15, "Text", "q-sync"), ColumnSpec("individual_id", "integer", 20, "Numeric", "q-num")),
)
FORM_NAMES = ["media_form", "individual"]
_PLAIN = (
    "uuid", "last_modified_by_id", "created_date_time", "last_modified_date_time", "organisation_id", "address_id",
)


def _form(spark, sf_dir):
    return bound(spark, sf_dir, "media_form"), bound(spark, sf_dir, "individual")


def _legacy(spark, sf_dir):
    rows, people = _form(spark, sf_dir)
    return media.media_legacy(rows, people, [PHOTO], NAMES).select(*media.MEDIA_COLUMNS)


_LEGACY_SQL = """select e.id as entity_id, e.uuid, e.is_voided, e.created_by_id, e.last_modified_by_id, e.created_date_time,
       e.last_modified_date_time, e.organisation_id, e.address_id, u.url as image_url, 'Ward' as sync_parameter_key1, e.ward as sync_parameter_value1,
       cast(null as varchar) as sync_parameter_key2, cast(null as varchar) as sync_parameter_value2, 'Person' as subject_type_name,
       'Home Visit' as encounter_type_name, cast(null as varchar) as program_name, 'Photo' as concept_name, s.first_name as subject_first_name,
       s.last_name as subject_last_name, s.middle_name as subject_middle_name, cast(null as varchar) as media_metadata,
       cast(null as varchar) as question_group_concept_name, cast(null as bigint) as repeatable_question_group_index
  from (select *, unnest(case when photo like '[%' then json_extract_string(photo, '$[*]') else [photo] end) as url from media_form where photo is not null) u
  join media_form e on e.id = u.id join individual s on s.id = e.individual_id"""
QUERIES["me1_media_legacy"] = _legacy
ORACLE["me1_media_legacy"] = with_bindings(FORM_NAMES, _LEGACY_SQL)


def _v3(spark, sf_dir):
    rows, people = _form(spark, sf_dir)
    return media.media_v3(rows, people, [IMAGE], NAMES).select(*media.MEDIA_COLUMNS)


_V3_SQL = """select e.id as entity_id, e.uuid, coalesce(e.is_voided, s.is_voided, false) as is_voided, s.created_by_id, s.last_modified_by_id,
       e.created_date_time, e.last_modified_date_time, e.organisation_id, coalesce(e.address_id, s.address_id) as address_id,
       coalesce(json_extract_string(u.f, '$.uri'), json_extract_string(u.f, '$')) as image_url,
       'Ward' as sync_parameter_key1, e.ward as sync_parameter_value1,
       cast(null as varchar) as sync_parameter_key2, cast(null as varchar) as sync_parameter_value2, 'Person' as subject_type_name,
       'Home Visit' as encounter_type_name, cast(null as varchar) as program_name, 'Image' as concept_name, s.first_name as subject_first_name,
       s.last_name as subject_last_name, s.middle_name as subject_middle_name, cast(u.f as varchar) as media_metadata,
       '' as question_group_concept_name, cast(-1 as bigint) as repeatable_question_group_index
  from (select id, unnest(case when image like '[%' then json_extract(image, '$[*]') else [to_json({'uri': image})] end) as f from media_form where image is not null) u
  join media_form e on e.id = u.id join individual s on s.id = e.individual_id"""
QUERIES["me2_media_v3"] = _v3
ORACLE["me2_media_v3"] = with_bindings(FORM_NAMES, _V3_SQL)

_PICTURE = answer_column("pic", 18, "Image", "pic", None, "Repeat")
_REPEAT = TableSpec("repeat_form", "RepeatableQuestionGroup", "st-person", None, "et-1", repeat_uuid="q-rep", columns=(_PICTURE,))


def _group_rows(spark, sf_dir):
    """Answers inside a repeatable group, with an escaped list among them."""
    rows = bound(spark, sf_dir, "media_form")
    escaped = F.concat(F.lit('[\\"'), F.substring_index("photo", '"', 2).substr(F.lit(3), F.lit(500)), F.lit('\\"]'))
    pic = F.when(F.col("id") % 3 == 1, escaped).when(F.col("id") % 3 == 0, F.col("photo")).otherwise(F.lit("ftp://x"))
    return rows.select(
        "individual_id", F.col("id").alias("encounter_id"), "repeatable_question_group_index",
        F.when(F.col("id") % 4 == 0, F.lit(None).cast("boolean")).otherwise(F.col("is_voided")).alias("is_voided"), pic.alias("pic"),
    )


def _repeat(spark, sf_dir):
    rows, people = _form(spark, sf_dir)
    names = media.MediaNames("Person", "Home Visit")
    out = media.media_repeat(_group_rows(spark, sf_dir), rows, people, [_PICTURE], names, "encounter_id")
    return out.select(*media.MEDIA_COLUMNS)


_REPEAT_SQL = """select e.id as entity_id, e.uuid, coalesce(case when e.id % 4 <> 0 then e.is_voided end, e.is_voided, false) as is_voided,
       e.created_by_id, e.last_modified_by_id, e.created_date_time, e.last_modified_date_time, e.organisation_id, e.address_id,
       case e.id % 3 when 0 then e.photo else json_extract_string(e.photo, '$[0]') end as image_url,
       cast(null as varchar) as sync_parameter_key1, cast(null as varchar) as sync_parameter_value1,
       cast(null as varchar) as sync_parameter_key2, cast(null as varchar) as sync_parameter_value2, 'Person' as subject_type_name,
       'Home Visit' as encounter_type_name, cast(null as varchar) as program_name, 'pic' as concept_name, s.first_name as subject_first_name,
       s.last_name as subject_last_name, cast(null as varchar) as subject_middle_name,
       '{"uri":"' || case e.id % 3 when 0 then e.photo else json_extract_string(e.photo, '$[0]') end || '"}' as media_metadata,
       'Repeat' as question_group_concept_name, e.repeatable_question_group_index
  from media_form e join individual s on s.id = e.individual_id where e.id % 3 in (0, 1)"""
QUERIES["me3_media_repeat"] = _repeat
ORACLE["me3_media_repeat"] = with_bindings(FORM_NAMES, _REPEAT_SQL)


def built(spark, sf_dir):
    rows, people = _form(spark, sf_dir)
    sources = [
        media.MediaSource(FORM, rows, people, NAMES),
        media.MediaSource(_REPEAT, _group_rows(spark, sf_dir), people, media.MediaNames("Person", "Home Visit"), rows),
    ]
    return media.build_media(sources).select("id", *media.MEDIA_COLUMNS)


_ID_SQL = """cast('0x' || substr(md5(concat_ws('|', cast(entity_id as varchar), concept_name, coalesce(question_group_concept_name, ''),
       cast(coalesce(repeatable_question_group_index, -1) as varchar), image_url)), 1, 15) as bigint)"""
_BUILT_SQL = f"select {_ID_SQL} as id, * from ({_LEGACY_SQL} union all by name {_V3_SQL} union all by name {_REPEAT_SQL})"
QUERIES["me4_build_media"] = built
ORACLE["me4_build_media"] = with_bindings(FORM_NAMES, _BUILT_SQL)

# --- search -------------------------------------------------------------------------
SEARCH_NAMES = [*FORM_NAMES, "address_level"]
_ADDRESS_JSON = "cast(to_json(a) as varchar)"
_COLUMNS = ", ".join(_ADDRESS_JSON + " as address" if c == "address" else f"m.{c}" for c in media_search.SEARCH_COLUMNS)
_LIVE = "m.image_url is not null and not m.is_voided"


def _search_sql(where: str = "true", joins: str = "", tail: str = "", columns: str = _COLUMNS) -> str:
    return with_bindings(
        SEARCH_NAMES,
        f"""with media as ({_BUILT_SQL}), address as ({ADDRESS_SQL})
            select {columns} from media m join address a on a.id = m.address_id {joins} where {_LIVE} and ({where}) {tail}""",
    )


def _tables(spark, sf_dir):
    return {"media_form": bound(spark, sf_dir, "media_form")}


QUERIES["s8_all_media"] = lambda spark, sf_dir: media_search.all_media(built(spark, sf_dir), wide_address(spark, sf_dir))
ORACLE["s8_all_media"] = _search_sql()

REQUEST = MediaRequest(
    from_date="2024-01-01 06:00:00",
    to_date="2024-01-28 00:00:00",
    subject_name="customer 0",
    subject_types=("Person",),
    encounter_types=("Home Visit", "Other"),
    concepts=("Photo", "Image"),
    sync_values=(("Ward", ("ward 0", "ward 1")), ("None", ("x",))),
    addresses=(("Region", (1, 2, 3)), ("Nation", (104, 105)), ("Site", ())),
)
_REQUEST_SQL = """m.created_date_time >= timestamp '2024-01-01 06:00:00' and m.created_date_time <= timestamp '2024-01-28 00:00:00'
      and (m.subject_first_name ilike '%customer%' or m.subject_middle_name ilike '%customer%' or m.subject_last_name ilike '%customer%')
      and (m.subject_first_name ilike '%0%' or m.subject_middle_name ilike '%0%' or m.subject_last_name ilike '%0%')
      and m.subject_type_name in ('Person') and m.encounter_type_name in ('Home Visit', 'Other') and m.concept_name in ('Photo', 'Image')
      and m.sync_parameter_key1 = 'Ward' and m.sync_parameter_value1 in ('ward 0', 'ward 1')
      and (a."Region id" in (1, 2, 3) or a."Nation id" in (104, 105))"""
_ORDER = "order by m.created_date_time desc nulls first, m.entity_id, m.concept_name, m.image_url"


def _search(req, **page):
    def run(spark, sf_dir):
        return media_search.search_media(
            built(spark, sf_dir), wide_address(spark, sf_dir), req, _tables(spark, sf_dir), [FORM], **page
        )

    return run


QUERIES["me6_search_media"] = _search(REQUEST, limit=10, offset=5)
ORACLE["me6_search_media"] = _search_sql(_REQUEST_SQL, tail=f"{_ORDER} limit 10 offset 5")


def _count(req, compat=False):
    def run(spark, sf_dir):
        return media_search.count_media(
            built(spark, sf_dir), wide_address(spark, sf_dir), req, _tables(spark, sf_dir), [FORM], compat=compat
        )

    return run


QUERIES["me7_count_media"] = _count(REQUEST)
ORACLE["me7_count_media"] = _search_sql(_REQUEST_SQL, columns="count(*) as total")
QUERIES["me7_count_media_compat"] = _count(MediaRequest(concepts=("Photo", "Image")), compat=True)
ORACLE["me7_count_media_compat"] = with_bindings(
    FORM_NAMES, f"with media as ({_BUILT_SQL}) select count(*) as total from media m where {_LIVE} and m.concept_name in ('Photo', 'Image')"
)


def _filtered(spark, sf_dir):
    rows = media_search.matching_media(built(spark, sf_dir), wide_address(spark, sf_dir), REQUEST)
    return rows.select("entity_id", "concept_name", "image_url")


QUERIES["me8_media_filter"] = _filtered
ORACLE["me8_media_filter"] = _search_sql(_REQUEST_SQL, columns="m.entity_id, m.concept_name, m.image_url")

_FILTERS = (
    ConceptFilter("form-1", "q-sync", ("ward", "3")),
    ConceptFilter("form-1", "q-num", low="10", high="80"),
    ConceptFilter("form-2", "q-num", low="0", high="1"),
)


def _concepts(spark, sf_dir):
    req = MediaRequest(concept_filters=_FILTERS)
    rows = media_search.matching_media(built(spark, sf_dir), wide_address(spark, sf_dir), req, _tables(spark, sf_dir), [FORM])
    return rows.select("entity_id", "concept_name", "image_url")


QUERIES["me9_concept_filters"] = _concepts
ORACLE["me9_concept_filters"] = _search_sql(
    columns="m.entity_id, m.concept_name, m.image_url",
    joins="""join media_form t1 on t1.id = m.entity_id and t1.ward ilike '%ward%' and t1.ward ilike '%3%'
             join media_form t2 on t2.id = m.entity_id and t2.individual_id between 10 and 80""",
)
_EXACT = (ConceptFilter("form-1", "q-num", ("5", "6")), ConceptFilter("form-1", "q-num", ("6", "7")))
QUERIES["me9_concept_values"] = lambda spark, sf_dir: media_search.concept_joins(
    built(spark, sf_dir), _tables(spark, sf_dir), [FORM], _EXACT
).select("entity_id", "concept_name", "image_url")
ORACLE["me9_concept_values"] = with_bindings(
    FORM_NAMES,
    f"""with media as ({_BUILT_SQL}) select m.entity_id, m.concept_name, m.image_url from media m
        join media_form t on t.id = m.entity_id and t.individual_id in (5, 6, 7)""",
)


def _keys(spark, sf_dir):
    rows = bound(spark, sf_dir, "stored_media")
    return media_search.media_keys(rows).select("entity_id", "image_uuid", "composite_uuid", "thumbnail_url")


QUERIES["me11_media_keys"] = _keys
ORACLE["me11_media_keys"] = with_bindings(
    ["stored_media"],
    """select entity_id, regexp_extract(image_url, '/([^/.]*)[^/]*$', 1) as image_uuid,
              uuid || '#' || regexp_extract(image_url, '/([^/.]*)[^/]*$', 1) as composite_uuid,
              regexp_replace(image_url, '/([^/]*)$', '/thumbnails/\\1') as thumbnail_url from stored_media""",
)

_STEM = "case when contains(m.image_url, '/') then split_part(list_extract(string_split(m.image_url, '/'), -1), '.', 1) else m.image_url end"
_MANIFEST = ", ".join(
    f"m.uuid || '#' || {_STEM} as composite_uuid" if c == "composite_uuid" else (_ADDRESS_JSON + " as address" if c == "address" else f"m.{c}")
    for c in media_search.MANIFEST_COLUMNS
)
QUERIES["me12_download_manifest"] = lambda spark, sf_dir: media_search.download_manifest(
    built(spark, sf_dir), wide_address(spark, sf_dir), MediaRequest(subject_types=("Person",))
)
ORACLE["me12_download_manifest"] = _search_sql("m.subject_type_name = 'Person'", columns=_MANIFEST)
QUERIES["me12_download_manifest_compat"] = lambda spark, sf_dir: media_search.download_manifest(
    built(spark, sf_dir), wide_address(spark, sf_dir), MediaRequest(subject_types=("Person",)), compat=True
)
ORACLE["me12_download_manifest_compat"] = _search_sql("m.subject_type_name = 'Person'", columns=_MANIFEST, tail=f"{_ORDER} limit 1000")

QUERIES["me13_media_analysis"] = lambda spark, sf_dir: media_search.media_analysis(
    bound(spark, sf_dir, "stored_media").where(~F.col("is_voided")), bound(spark, sf_dir, "media_keys"), "/org/"
)
ORACLE["me13_media_analysis"] = with_bindings(
    ["stored_media", "media_keys"],
    """with k as (select object_key, '/' || list_extract(string_split(object_key, '/'), -1) as f, regexp_matches(lower(object_key), 'thumbnails') as thumb
              from media_keys where not regexp_matches(lower(object_key), 'adhoc|mobiledbbackup')
                and regexp_matches(object_key, '[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}')),
            m as (select *, uuid || '#' || regexp_extract(image_url, '/([^/.]*)[^/]*$', 1) as cu from stored_media where not is_voided),
            g as (select *, count(*) over (partition by cu) as n from m
                  qualify row_number() over (partition by cu order by created_date_time desc nulls first, image_url desc) = 1)
       select uuid, image_url, contains(image_url, '/org/') as is_valid_url,
              contains(image_url, '/org/') and exists (select 1 from k where not thumb and k.f = '/' || list_extract(string_split(image_url, '/'), -1)) as is_present_in_storage,
              contains(image_url, '/org/') and exists (select 1 from k where thumb and k.f = '/' || list_extract(string_split(image_url, '/'), -1)) as is_thumbnail_generated,
              n > 1 as is_having_duplicates from g""",
)
