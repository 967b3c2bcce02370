"""What users read, built from a store and its specs: views, reports, media search, media analysis.

The tables of a family come from the stored specs, so nothing is listed by hand. Plans
stay lazy until they are published; every publication is one commit.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.functions.naming import view_name
from formflow.model import SUBJECT_TYPES, TableSpec, pick_tables
from formflow.operators import families, media_search, reports, views
from formflow.operators.media_search import MediaRequest
from formflow.plans.evolve import load_specs
from formflow.sources.snapshots import PART, Store, lookup

SUBJECTS, ENROLMENTS, DUE, COMPLETED, OVERDUE = "subject_view", "enrolment_view", "due_visits_view", "completed_visits_view", "overdue_visits_view"
MEDIA, ANALYSIS = "media", "media_analysis"
#: Digests of what the analysis was made from, by bucket.
DIGESTS, ANALYSIS_BUCKETS = "_media_digests", 64
#: Families of the activity reports, by the types of their tables.
ACTIVITY = {
    "subjects": SUBJECT_TYPES,
    "encounters": ("Encounter",),
    "enrolments": ("ProgramEnrolment",),
    "program_encounters": ("ProgramEncounter",),
}


#: What views and reports read of the tables of a family.
COLUMNS = tuple(
    dict.fromkeys([*reports.REPORT_COLUMNS, "id", "uuid", "name", "first_name", "last_name", "date_of_birth", "gender", "individual_id",
                   "created_date_time", "last_modified_date_time", "program_exit_date_time", "address_id", "created_by_id", "filled_by_id"])
)


def family(store: Store, specs: Iterable[TableSpec], types: Iterable[str]) -> families.Family | None:
    """All stored tables of some types as one tagged frame, of the columns that views and reports read; None if there are none."""
    known = store.manifest()
    mine = {s.name: s for s in pick_tables(list(specs), tuple(types)) if s.name in known}
    if not mine:
        return None
    rows = store.load_family({name: known[name] for name in mine}, families.TAG, COLUMNS)
    if rows is None:  # written before pieces said their schema
        return families.union_tagged([(s, store.load(known[name])) for name, s in mine.items()])
    marks = [(s.name, s.type, *(getattr(s, u) for u in families.TYPE_UUIDS)) for s in mine.values()]
    fields = [families.TAG, families.KIND, *families.TYPE_UUIDS]
    return rows.join(lookup(store.spark, fields, marks), families.TAG)


def used_addresses(store: Store) -> DataFrame:
    """The addresses that rows of the views can have, staged. Where few are used their size is known before the
    joins are planned, and rows of the views are not shuffled by address."""
    specs = load_specs(store)
    address = store.read("address")
    found = [family(store, specs, types) for types in (SUBJECT_TYPES, ("ProgramEnrolment",), views.VISIT_TYPES)]
    ids = [families.rows_of(rows).select(F.col("address_id").alias("_used")).distinct() for rows in found if rows is not None]
    if not ids:
        return address
    used = reduce(lambda a, b: a.unionByName(b), ids)
    return store.stage(address.join(used, address["id"] == used["_used"], "left_semi"), "address")


def build_views(
    store: Store, tables: Mapping[str, DataFrame], as_of: str, org_ids: Iterable[int] | None = None, address: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All views of a store by name: subjects, enrolments, visits by state, and the coded view of each table.

    ``tables`` are the sources of names: users and the types of subjects, programmes, visits and
    addresses. A view over no tables has its columns and no rows. ``address``: the addresses to join, all that are
    stored if not given.
    """
    specs = load_specs(store)
    levels = views.address_columns(tables["address_level_type"], org_ids)
    address = store.read("address") if address is None else address
    users = tables["users"]
    subjects = family(store, specs, SUBJECT_TYPES)
    individual = None if subjects is None else subjects.select("id", "uuid", "first_name", "last_name")
    enrolments = family(store, specs, ("ProgramEnrolment",))
    visits = family(store, specs, views.VISIT_TYPES)
    spark = store.spark
    out = {}
    out[SUBJECTS] = (
        views.subject_view(subjects, users, tables["subject_type"], address, levels, org_ids)
        if subjects is not None
        else views.empty_view(spark, views.SUBJECT_VIEW, levels)
    )
    out[ENROLMENTS] = (
        views.enrolment_view(enrolments, users, tables["program"], individual, address, levels)
        if enrolments is not None and individual is not None
        else views.empty_view(spark, views.ENROLMENT_VIEW, levels)
    )
    if visits is not None and individual is not None:
        common = (visits, users, individual, tables["encounter_type"], address, levels)
        out |= {DUE: views.due_visits(*common, as_of), COMPLETED: views.completed_visits(*common), OVERDUE: views.overdue_visits(*common, as_of)}
    else:
        out |= {name: views.empty_view(spark, views.VISITS_VIEW, levels) for name in (DUE, COMPLETED, OVERDUE)}
    known = store.manifest()
    for spec in specs:
        many = [c for c in spec.columns if c.concept_type == "MultiSelect"]
        if many and spec.name in known:
            out[view_name(spec.name)] = views.coded_view(store.load(known[spec.name]), many)
    return out


def publish_views(store: Store, tables: Mapping[str, DataFrame], as_of: str, org_ids: Iterable[int] | None = None) -> list[str]:
    """Writes all views and makes them current in one commit; returns their names."""
    made = build_views(store, tables, as_of, org_ids, used_addresses(store))
    store.commit({name: store.write(df, name, sort_by=None) for name, df in made.items()})
    return sorted(made)


def _activity(store: Store) -> dict[str, reports.Tables]:
    specs = load_specs(store)
    return {name: _or_none(family(store, specs, types)) for name, types in ACTIVITY.items()}


def _or_none(rows: families.Family | None) -> reports.Tables:
    return [] if rows is None else rows


def user_activity(store: Store, users: DataFrame, **how) -> DataFrame:
    """The activity report over all stored tables of its families."""
    return reports.user_activity(_activity(store), users, **how)


def on_time_users(store: Store, users: DataFrame, **how) -> DataFrame:
    found = _activity(store)
    return reports.on_time_users(found["encounters"], found["program_encounters"], users, **how)


def most_cancelled(store: Store, users: DataFrame, **how) -> DataFrame:
    specs = load_specs(store)
    general = _or_none(family(store, specs, ("Encounter", "IndividualEncounterCancellation")))
    program = _or_none(family(store, specs, ("ProgramEncounter", "ProgramEncounterCancellation")))
    return reports.most_cancelled(general, program, users, **how)


def search_media(store: Store, request: MediaRequest, **how) -> DataFrame:
    """A media search whose answer filters are resolved from the stored specs and tables."""
    specs = load_specs(store)
    known = store.manifest()
    named = {s.name: store.load(known[s.name]) for s in specs if s.name in known}
    return media_search.search_media(store.read(MEDIA), store.read("address"), request, named, specs, **how)


def _bucket(name: Column) -> Column:
    """Which part of the analysis a file belongs to, by its name without an ending."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(F.substring_index(name, ".", 1)), F.lit(ANALYSIS_BUCKETS)).cast("string"))


def _inventory(media: DataFrame, keys: DataFrame, tenant_dir: str) -> dict[str, tuple]:
    """A digest of both inventories for each bucket: counts and sums of hashes, with map-side combine; ANALYSIS_BUCKETS rows."""
    sides = [
        media.select(PART, F.xxhash64(F.lit(tenant_dir), "uuid", "image_url", "created_date_time").alias("h")),
        keys.select(PART, F.xxhash64(F.lit(tenant_dir), F.lit("key"), "object_key").alias("h")),
    ]
    found = sides[0].unionByName(sides[1]).groupBy(PART).agg(F.count("*").alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("digest"))
    return {r[PART]: (r["n"], r["digest"]) for r in found.collect()}


def run_media_analysis(store: Store, keys: DataFrame, tenant_dir: str) -> DataFrame:
    """Checks all stored media against the files of the storage and publishes the result.

    Both inventories are read and digested by bucket of the file name; only buckets that differ from
    the last run's are joined and written again.
    """
    media = store.read(MEDIA)
    media = media.withColumn(PART, _bucket(F.coalesce(media_search.file_name(F.col("image_url")), F.col("image_url"), F.lit(""))))
    keys = keys.withColumn(PART, _bucket(F.coalesce(media_search.file_name(F.col("object_key")), F.lit(""))))
    now = _inventory(media, keys, tenant_dir)
    known = store.manifest()
    entry = known.get(ANALYSIS)
    before = {}
    if entry and DIGESTS in known and all(piece["parts"] is not None for piece in entry):
        before = {r["bucket"]: (r["n"], r["digest"]) for r in store.load(known[DIGESTS]).collect()}
    changed = sorted(b for b in now.keys() | before.keys() if now.get(b) != before.get(b))
    if changed or entry is None:
        some = F.col(PART).isin(changed)
        rows = media_search.media_analysis(media.where(some).drop(PART), keys.where(some).drop(PART), tenant_dir)
        rows = rows.withColumn(PART, _bucket(F.coalesce(media_search.file_name(F.col("image_url")), F.col("image_url"), F.lit(""))))
        digests = store.spark.createDataFrame([(b, *v) for b, v in now.items()], "bucket string, n long, digest string")
        written = store.write_months(rows, ANALYSIS, entry if before else None, changed, sort_by="uuid")
        store.commit({ANALYSIS: written, DIGESTS: store.write(digests, DIGESTS, sort_by=None)})
    return store.read(ANALYSIS)
