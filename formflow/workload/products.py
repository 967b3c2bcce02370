"""What users read, through a store: views, reports, media search and analysis; saved specs; households that lose a head."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from formflow.bindings import Bound, bound, metadata, with_bindings
from formflow.operators import entities, families, reports
from formflow.operators.media_search import ConceptFilter, MediaRequest
from formflow.plans import catalog, products
from formflow.plans.evolve import SPEC_TABLE, save_specs, spec_rows, specs_of, stored_specs
from formflow.plans.sync import Run, sync_table
from formflow.sources.tables import EPOCH, Context
from formflow.workload.common import spec
from formflow.workload.flatten import ADDRESS_SQL, wide_address
from formflow.workload.media import _BUILT_SQL, _COLUMNS, _LIVE, FORM, SEARCH_NAMES, built
from formflow.workload.media import ORACLE as _MEDIA_ORACLE
from formflow.workload.metadata import _FORMS, _NAMES, _SPEC, FORM_SQL
from formflow.workload.metadata import _specs as spec_bodies
from formflow.workload.reports import END, START, _activity_sql
from formflow.workload.state import fresh_store
from formflow.workload.views import AS_OF, ENROLMENTS, LEVELS, SUBJECTS, VISITS

QUERIES, ORACLE = {}, {}

#: The families that a store holds, each written by one job.
FAMILIES = {"subjects": SUBJECTS, "enrolments": ENROLMENTS, "visits": VISITS}


def filled(spark, sf_dir):
    """A store with all tables of all families, their specs and the addresses, as one commit."""
    store = fresh_store(spark)
    ctx = Context(Bound(spark, sf_dir))
    written = {SPEC_TABLE: save_specs(store, [s for specs in FAMILIES.values() for s in specs])}
    for name, specs in FAMILIES.items():
        rows = families.scans(ctx, specs).drop(families.KIND, *families.TYPE_UUIDS)
        written |= store.write_family(rows, name, families.TAG, [s.name for s in specs])
    written["address"] = store.write(wide_address(spark, sf_dir), "address", sort_by=None)
    store.commit(written)
    return store


# --- views ---------------------------------------------------------------------------
_SHARED = ("created_by_username", "last_modified_by_username", "first_name", "last_name", *LEVELS)
_IDS = {
    products.SUBJECTS: ("individual_id", "individual_uuid", "subject_type"),
    products.ENROLMENTS: ("enrolment_id", "enrolment_uuid", "program_name"),
    **{name: ("id", "uuid", "encounter_type_name") for name in (products.DUE, products.COMPLETED, products.OVERDUE)},
}


def _views(spark, sf_dir):
    """All views published from the store, read back; one row for each row of each."""
    store = filled(spark, sf_dir)
    tables = Bound(spark, sf_dir)
    products.publish_views(store, tables, AS_OF)
    out = None
    for name, (key, uuid, kind) in _IDS.items():
        columns = [F.lit(name).alias("view"), F.col(key).alias("id"), F.col(uuid).alias("uuid"), F.col(kind).alias("kind"), *_SHARED]
        rows = store.read(name).select(*columns)
        out = rows if out is None else out.unionByName(rows)
    return out


_AT = f"timestamp '{AS_OF} 00:00:00'"
_WHEN = {
    products.DUE: f"v.earliest_visit_date_time < {_AT} and {_AT} < v.max_visit_date_time",
    products.COMPLETED: "v.encounter_date_time is not null and v.cancel_date_time is null",
    products.OVERDUE: f"{_AT} > v.max_visit_date_time and v.encounter_date_time is null and v.cancel_date_time is null",
}
QUERIES["v_store_views"] = _views
ORACLE["v_store_views"] = with_bindings(
    ["individual", "subject_type", "program", "encounter_type", "program_enrolment", "encounter", "program_encounter", "users", "address_level"],
    f"""with address as ({ADDRESS_SQL}), person as (select * from individual where subject_type_id < 5), both_kinds as (
            select e.*, e.individual_id as who from encounter e
            union all by name
            select e.* exclude (program_enrolment_id, tie_1, tie_2, tie_3), n.individual_id as who
            from program_encounter e join program_enrolment n on n.id = e.program_enrolment_id
        ), once as (select v.* from both_kinds v join individual i on i.id = v.who),
        twice as (select * from once union all select * from once where cancel_date_time is not null),
        found as (
            select '{products.SUBJECTS}' as view, i.id, i.uuid, t.name as kind, i.address_id, i.created_by_id, i.last_modified_by_id, i.first_name, i.last_name
            from person i join subject_type t on t.id = i.subject_type_id where not i.is_voided
            union all
            select '{products.ENROLMENTS}', e.id, e.uuid, p.name, e.address_id, e.created_by_id, e.last_modified_by_id, i.first_name, i.last_name
            from program_enrolment e join person i on i.id = e.individual_id join program p on p.id = e.program_id where not e.is_voided
            {' '.join(f'''union all
            select '{name}', v.id, v.uuid, t.name, v.address_id, v.created_by_id, v.last_modified_by_id, i.first_name, i.last_name
            from twice v join person i on i.id = v.individual_id join encounter_type t on t.id = v.encounter_type_id
            where not v.is_voided and {when}''' for name, when in _WHEN.items())}
        )
        select f.view, f.id, f.uuid, f.kind, cu.username as created_by_username, mu.username as last_modified_by_username, f.first_name,
            f.last_name, {', '.join(f'a."{c}"' for c in LEVELS)}
        from found f join address a on a.id = f.address_id left join users cu on cu.id = f.created_by_id left join users mu on mu.id = f.last_modified_by_id""",
)

# --- reports -------------------------------------------------------------------------
QUERIES["rp_store_activity"] = lambda spark, sf_dir: products.user_activity(
    filled(spark, sf_dir), bound(spark, sf_dir, "users"), start=START, end=END
)
ORACLE["rp_store_activity"] = _activity_sql("")


def _table_summary(spark, sf_dir):
    """Tables of the tenant by type, from the specs of its forms."""
    rows = reports.table_summary(spark, catalog.table_heads(catalog.form_specs(metadata(spark, sf_dir))))
    return rows.groupBy("type").agg(F.count("*").alias("tables"))


QUERIES["rp1_table_summary"] = _table_summary
ORACLE["rp1_table_summary"] = with_bindings(
    _NAMES,
    f"""{_FORMS} select case kind when 'IndividualProfile' then subject_kind else kind end as type, count(*) as tables from usage
        where kind in ('Encounter', 'ProgramEnrolment', 'ProgramEncounter') or (kind = 'IndividualProfile' and subject_kind <> 'User') group by 1""",
)


# --- saved specs ---------------------------------------------------------------------
def _saved_specs(spark, sf_dir):
    """Every table's spec after a way through a store."""
    store = fresh_store(spark)
    place = F.row_number().over(Window.partitionBy("table_name").orderBy("concept_id", "parent_uuid"))
    rows = spec_bodies(spark, sf_dir).withColumns({"position": place, "role": F.lit(None).cast("string")})
    store.commit({SPEC_TABLE: save_specs(store, specs_of(rows))})
    return spec_rows(spark, specs_of(stored_specs(store))).drop("position", "role")


QUERIES["s9_saved_specs"] = _saved_specs
ORACLE["s9_saved_specs"] = with_bindings(_NAMES, f"with r as ({FORM_SQL}) select distinct * from ({_SPEC.format('varchar', 'r')})")


# --- media ---------------------------------------------------------------------------
def _media_store(spark, sf_dir):
    store = fresh_store(spark)
    store.commit(
        {
            SPEC_TABLE: save_specs(store, [FORM]),
            FORM.name: store.write(bound(spark, sf_dir, "media_form"), FORM.name),
            products.MEDIA: store.write(built(spark, sf_dir), products.MEDIA),
            "address": store.write(wide_address(spark, sf_dir), "address", sort_by=None),
        }
    )
    return store


_WANTED = MediaRequest(concepts=("Photo", "Image"), concept_filters=(ConceptFilter("form-1", "q-num", low="10", high="80"),))
QUERIES["me_store_search"] = lambda spark, sf_dir: products.search_media(_media_store(spark, sf_dir), _WANTED, limit=None)
ORACLE["me_store_search"] = with_bindings(
    SEARCH_NAMES,
    f"""with media as ({_BUILT_SQL}), address as ({ADDRESS_SQL})
        select {_COLUMNS} from media m join address a on a.id = m.address_id
        where {_LIVE} and m.concept_name in ('Photo', 'Image') and m.entity_id in (select id from media_form where individual_id between 10 and 80)""",
)


def _analysis(spark, sf_dir):
    """The analysis of the stored media in two runs, the second after new files: read from the store."""
    store = fresh_store(spark)
    store.publish(bound(spark, sf_dir, "stored_media").where(~F.col("is_voided")), products.MEDIA)
    keys = bound(spark, sf_dir, "media_keys")
    products.run_media_analysis(store, keys.where(~F.col("object_key").endswith("7.jpg")), "/org/")
    return products.run_media_analysis(store, keys, "/org/")


QUERIES["me13_job"] = _analysis
ORACLE["me13_job"] = _MEDIA_ORACLE["me13_media_analysis"]

# --- households ----------------------------------------------------------------------
_HOUSEHOLDS = spec("HouseholdToMember", group_subject_type_uuid="st-household", member_subject_type_uuid="st-person")
_FIRST, _SECOND = "1994-01-01 00:00:00", "2003-01-01 00:00:00"
_TS = "last_modified_date_time"


def _edited_edges(spark, sf_dir):
    """Edges as they were, none voided; and after some edits: voided edges, heads among them, and other changes."""
    after = bound(spark, sf_dir, "group_subject")
    long_ago = F.lit("1990-01-01 00:00:00").cast(after.schema[_TS].dataType)
    before = after.withColumn("is_voided", F.lit(False)).withColumn(_TS, long_ago)
    edited = F.col("is_voided") | (F.col("id") % 5 == 0)
    return before, after.withColumn(_TS, F.when(edited, F.col(_TS)).otherwise(long_ago))


def _resync(spark, sf_dir):
    """Two runs of the household table with edits in between: members of former heads and of headless households are gone."""
    store = fresh_store(spark)
    tables = Bound(spark, sf_dir)
    last = EPOCH
    for edges, now in zip(_edited_edges(spark, sf_dir), (_FIRST, _SECOND), strict=True):
        known = {name: tables[name] for name in ("individual", "subject_type", "group_role")} | {"group_subject": edges}
        run = Run(store, known, "one", now, [_HOUSEHOLDS], {}, {}, {_HOUSEHOLDS.name: last}, store.manifest(), {})
        store.commit({_HOUSEHOLDS.name: sync_table(run, _HOUSEHOLDS)})
        last = now
    return store.read(_HOUSEHOLDS.name).select("id", "is_voided", _TS, "group_subject_id", "member_subject_id", "role", F.col(entities.HEAD_COLUMN).alias("head_id"))


QUERIES["e11_household_resync"] = _resync
ORACLE["e11_household_resync"] = with_bindings(
    ["group_subject", "group_role", "individual", "subject_type"],
    f"""with edges as (
            select * replace (case when is_voided or id % 5 = 0 then {_TS} else timestamp '1990-01-01 00:00:00' end as {_TS}) from group_subject
        ), heads as (
            select e.* from edges e left join group_role r on r.id = e.group_role_id where r.role = 'Head of household' or r.role is null
        ), newest as (select group_subject_id, max({_TS}) as changed from heads group by 1)
        select e.id, e.is_voided, greatest(e.{_TS}, n.changed) as {_TS}, e.group_subject_id, e.member_subject_id, r.role, h.member_subject_id as head_id
        from edges e join individual m on m.id = e.member_subject_id and m.subject_type_id = 1
        join individual g on g.id = e.group_subject_id and g.subject_type_id = 3
        join group_role r on r.id = e.group_role_id and r.member_subject_type_id = 1 and r.group_subject_type_id = 3
        join newest n on n.group_subject_id = g.id
        join (select distinct group_subject_id, member_subject_id from heads where not is_voided) h on h.group_subject_id = g.id""",
)
