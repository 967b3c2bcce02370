"""One tenant's sync: specs, evolution, flattening, maintenance, publish.

Tables are independent plans and are submitted from a few threads, so a
cluster is kept busy by many small tables as well as by one large one; media
waits for the tables it reads. Nothing becomes visible before the single
commit at the end, which moves the watermarks as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.model import (
    APPROVAL_ENTITY, MEDIA_CONCEPTS, PARENT_KEY, SUBJECT_TYPES, TableSpec,
)
from formflow.operators import address, entities, maintain, media, repeat
from formflow.plans import catalog
from formflow.plans.derive import Config, run_derived
from formflow.plans.evolve import SPEC_TABLE, Change, conform, diff, evolve, load_specs, merge_specs, save_specs
from formflow.plans.merge import merge_months
from formflow.sources.snapshots import PART, Entry, Store
from formflow.sources.state import STATE_TABLE, advanced_state
from formflow.sources.tables import EPOCH, Context, delta, tenant_filter

TS = "last_modified_date_time"
#: The stored approval state, by hash bucket of the entity.
APPROVALS, APPROVAL_BUCKETS = "_approvals", 64
STATUS_COLUMNS = ("id", *maintain.STATUS_KEYS, "status_date_time", "status")
# source of a table type and the column that tells its tables apart
STAGED = {
    "encounter": "encounter_type_id",
    "program_encounter": "encounter_type_id",
    "program_enrolment": "program_id",
    "subject_program_eligibility": "program_id",
    "individual": "subject_type_id",
}
FED_BY = {
    "encounter": ("Encounter", "IndividualEncounterCancellation"),
    "program_encounter": ("ProgramEncounter", "ProgramEncounterCancellation"),
    "program_enrolment": ("ProgramEnrolment", "ProgramExit"),
    "subject_program_eligibility": ("ManualProgramEnrolmentEligibility",),
    "individual": SUBJECT_TYPES + ("IndividualProfile",),
}
CANCELS = {
    "IndividualEncounterCancellation": ("encounter", "cancel_date_time"),
    "ProgramEncounterCancellation": ("program_encounter", "cancel_date_time"),
    "ProgramExit": ("program_enrolment", "program_exit_date_time"),
}


class TenantTables(Mapping):
    """Source tables narrowed to a tenant's own rows where they name one."""

    def __init__(self, tables: Mapping[str, DataFrame], org_ids: Iterable[int] | None):
        self._tables, self._ids = tables, None if org_ids is None else sorted(org_ids)

    def __getitem__(self, name: str) -> DataFrame:
        df = self._tables[name]
        return df if self._ids is None or "organisation_id" not in df.columns else tenant_filter(df, self._ids)

    def __iter__(self):
        return iter(self._tables)

    def __len__(self):
        return len(self._tables)


@dataclass
class Run:
    """State of one run that its steps share."""

    store: Store
    tables: Mapping[str, DataFrame]
    tenant: str
    now: str
    specs: list[TableSpec]
    changes: dict[str, list[Change]]
    old_names: dict[str, str]
    last_sync: dict[str, str]
    before: dict
    done: dict[str, Entry]
    staged: dict[str, DataFrame] = field(default_factory=dict)
    staged_from: str = EPOCH
    statuses: DataFrame | None = None
    reviewed: DataFrame | None = None
    renames: list = field(default_factory=list)
    keep_headless: bool = False

    def context(self, spec: TableSpec) -> Context:
        """The table's window; a new table looks further back than the
        staged rows do and reads the sources."""
        start = self.last_sync.get(spec.name, EPOCH)
        tables = self.tables if start < self.staged_from else Staged(self.tables, self.staged)
        return Context(tables, start, self.now)

    def old_entry(self, spec: TableSpec) -> Entry | None:
        return self.before.get(self.old_names.get(spec.name, spec.name))

    def new_rows(self, name: str) -> DataFrame:
        return self.store.load(self.done[name])


def watermarks(store: Store, tenant: str) -> dict[str, str]:
    """Last sync time per table of a tenant. One row per table, so small."""
    if not store.exists(STATE_TABLE):
        return {}
    rows = store.read(STATE_TABLE).where(F.col("tenant") == tenant)
    return {r[0]: r[1] for r in rows.select("table_name", F.col("last_sync_time").cast("string")).collect()}


def stage_sources(run: Run) -> None:
    """Write each large source's changed rows once, by type, with what their subjects decide.

    A tenant has hundreds of tables and a handful of sources. Each source is joined with its
    subjects once, for their type and their answers to the sync questions; every table then
    reads its own type's folder, without a join with subjects.
    """
    seen = [t for t in run.last_sync.values() if t > EPOCH]
    run.staged_from = min(seen, default=EPOCH)
    for name, key in STAGED.items():
        users = [s for s in run.specs if s.type in FED_BY[name] or s.parent_type in FED_BY[name]]
        if not users or name not in run.tables:
            continue
        ctx = Context(run.tables, run.staged_from, run.now)
        changed = ctx.changed(name)
        if name != "individual":
            changed = entities.place(ctx, name, changed, entities.sync_columns(users))
        run.staged[name] = run.store.stage(changed, name, key)


def _bucket(df: DataFrame) -> DataFrame:
    """Rows of entities with the partition of the approval state that they belong to."""
    return df.withColumn(PART, F.concat(F.lit("b"), F.pmod(F.xxhash64(*maintain.STATUS_KEYS), F.lit(APPROVAL_BUCKETS)).cast("string")))


def stage_statuses(run: Run) -> None:
    """Each entity's latest approval status, kept from run to run: only the window's rows are folded in."""
    if "entity_approval_status" not in run.tables:
        return
    history, names = run.tables["entity_approval_status"], run.tables["approval_status"]
    store, entry = run.store, run.before.get(APPROVALS)
    window = delta(history, run.last_sync.get(APPROVALS, EPOCH), run.now, TS if TS in history.columns else "status_date_time")
    window = store.stage(window, "reviewed")
    run.reviewed = window.select(*maintain.STATUS_KEYS)
    buckets = sorted(r[0] for r in _bucket(run.reviewed).select(PART).distinct().collect())  # APPROVAL_BUCKETS at most
    if entry is None:
        fresh = _bucket(maintain.current_statuses(window, names))
        entry = store.write_months(fresh, APPROVALS, sort_by="entity_id")
    elif buckets:
        state = store.load(entry, with_part=True).where(F.col(PART).isin(buckets)).select(*STATUS_COLUMNS)
        folded = maintain.fold_statuses(state, window, history, names).select(*STATUS_COLUMNS)
        touched = run.reviewed.distinct()
        rows = state.join(touched, maintain.STATUS_KEYS, "left_anti").unionByName(folded)
        entry = store.write_months(_bucket(rows), APPROVALS, entry, buckets, sort_by="entity_id")
    run.done[APPROVALS] = entry
    run.statuses = store.load(entry).where(F.col("status").isNotNull()).select(*maintain.STATUS_KEYS, "status")


def collect_renames(run: Run) -> None:
    """The answer renames of the run, in the order made: edits of metadata, a handful."""
    if "answer_concept_migration" in run.tables:
        rows = Context(run.tables, run.staged_from, run.now).changed("answer_concept_migration").where(~F.col("is_voided"))
        columns = ["concept_id", "old_answer_concept_name", "new_answer_concept_name", F.col(TS).cast("string").alias("made")]
        run.renames = rows.orderBy(TS, "id").select(*columns).collect()


class Staged(Mapping):
    """Tables whose changed rows are staged; joins still see whole tables."""

    def __init__(self, tables: Mapping[str, DataFrame], staged: Mapping[str, DataFrame]):
        self._tables, self._staged = tables, staged

    def __getitem__(self, name: str) -> DataFrame:
        kind, _, source = name.partition("/")
        return self._staged[source] if kind == "changed" else self._tables[name]

    def __iter__(self):
        return iter(self._tables)

    def __len__(self):
        return len(self._tables)


def migrations(run: Run, spec: TableSpec) -> dict[str, list[tuple[str, str]]]:
    """Answer renames of the table's window per column, in the order made."""
    since = run.last_sync.get(spec.name, EPOCH)
    found: dict[str, list[tuple[str, str]]] = {}
    for column in spec.answers:
        pairs = [(r[1], r[2]) for r in run.renames if r[0] == column.concept_id and r["made"] > since]
        if pairs:
            found[column.name] = pairs
    return found


def _holds_old_name(spec: TableSpec, old: set[str], found: dict[str, list[tuple[str, str]]]) -> Column | None:
    """Stored rows that a rename changes; other months keep their files. ``old``: the stored columns."""
    types = {c.name: c.concept_type for c in spec.columns}
    parts = [
        maintain.holds_any(column, {first for first, _ in pairs}, types[column] == "MultiSelect")
        for column, pairs in found.items()
        if column in old
    ]
    return reduce(lambda a, b: a | b, parts) if parts else None


def renamed(df: DataFrame, spec: TableSpec, found: dict[str, list[tuple[str, str]]]) -> DataFrame:
    types = {c.name: c.concept_type for c in spec.columns}
    for column, pairs in found.items():
        rename = maintain.rename_multi if types[column] == "MultiSelect" else maintain.rename_single
        df = rename(df, column, pairs)
    return df


def fresh_rows(run: Run, spec: TableSpec) -> tuple[DataFrame, list[str], str]:
    """Changed rows of a table, the key they replace by, and how ties go."""
    ctx = run.context(spec)
    if spec.type == "RepeatableQuestionGroup":
        parent = PARENT_KEY[spec.parent_type]
        rows = repeat.repeat_group(ctx, spec, by_month=True)
        serial = F.xxhash64(F.lit(spec.name), parent, repeat.INDEX, TS)
        return rows.withColumn("id", serial), [parent], "rank"
    if spec.type == "HouseholdToMember":
        # all heads of the newest change of an id; those of older ones go
        return entities.household_members(ctx, spec, retract=not run.keep_headless), ["id"], "rank"
    if spec.type == "User":
        return entities.copy_users(ctx), ["id"], "row_number"
    return entities.flatten(ctx, spec), ["id"], "row_number"


def _touched(run: Run, spec: TableSpec, key: str) -> DataFrame | None:
    """Keys without a changed row of their own that this run may change."""
    parts = []
    if spec.type in CANCELS:
        source, _ = CANCELS[spec.type]
        parts.append(run.context(spec).changed(source).select("id"))
    if spec.type in APPROVAL_ENTITY and run.reviewed is not None:
        mine = run.reviewed.where(F.col("entity_type") == APPROVAL_ENTITY[spec.type])
        parts.append(mine.select(F.col("entity_id").alias(key)))
    if spec.type == "HouseholdToMember" and not run.keep_headless:
        edges = run.tables["group_subject"].select("id", "group_subject_id")
        parts.append(edges.join(entities.headless(run.context(spec)), "group_subject_id", "left_semi").select("id"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def sync_table(run: Run, spec: TableSpec) -> Entry:
    """One flat table brought up to date; returns its new pieces."""
    store = run.store
    fresh, keys, ties = fresh_rows(run, spec)
    placed = [PART] if PART in fresh.columns else []
    fresh = conform(fresh, spec, placed)
    entry = run.old_entry(spec)
    changes = run.changes.get(spec.name, [])
    renames = migrations(run, spec)
    if entry is not None or ties == "rank":
        fresh = store.stage(fresh, spec.name)  # read for its keys, its months and its rows

    def prepare(old: DataFrame) -> DataFrame:
        return conform(renamed(evolve(old, changes), spec, renames), spec, placed)

    def finish(rows: DataFrame) -> DataFrame:
        if spec.type in CANCELS:
            source, column = CANCELS[spec.type]
            primary = run.context(spec).changed(source)
            rows = maintain.delete_matching(rows, primary.where(F.col(column).isNull()), ["id"])
        if spec.type == "HouseholdToMember" and not run.keep_headless:
            rows = rows.join(entities.headless(run.context(spec)), "group_subject_id", "left_anti")
        if spec.type in APPROVAL_ENTITY and run.statuses is not None:
            rows = maintain.set_approval(rows, run.statuses, APPROVAL_ENTITY[spec.type])
        return conform(rows, spec, placed)

    if spec.has("created_date_time") or placed:
        dirty = _holds_old_name(spec, set(store.load(entry).columns), renames) if renames and entry else None
        return merge_months(
            store, spec.name, entry, fresh, keys, TS, ties, touched=_touched(run, spec, keys[0]),
            prepare=prepare, finish=finish, whole=bool(changes), dirty=dirty,
        )
    if entry is None:
        return store.write(finish(maintain.keep_latest(fresh, keys, TS, ties)), spec.name)
    return store.write(finish(maintain.upsert_latest(prepare(store.load(entry)), fresh, keys, TS, ties)), spec.name)


def sync_address(run: Run, spec: TableSpec) -> Entry:
    """The whole address table, from the whole tree: parents' changes reach
    unchanged children."""
    t = run.tables
    rows = address.address_rows(t["address_level"], t["address_level_type"], spec, t["concept"], t["concept_answer"])
    rows = address.propagate_parents(rows, t["address_level"], t["address_level_type"])
    return run.store.write(conform(rows, spec), spec.name)


def sync_telemetry(run: Run, spec: TableSpec) -> Entry:
    rows = entities.copy_telemetry(run.context(spec))
    return run.store.append(conform(rows, spec), spec.name, run.old_entry(spec))


def sync_user_subjects(run: Run, spec: TableSpec) -> Entry:
    entry = run.old_entry(spec)
    spark = run.store.spark
    known = run.store.load(entry) if entry else spark.createDataFrame([], "user_id bigint, id bigint")
    rows = entities.user_subjects(run.context(spec), known, spec)
    return run.store.append(conform(rows, spec), spec.name, entry)


def media_sources(run: Run, window: Context) -> list[media.MediaSource]:
    """Tables with media answers, their changed rows and named context."""
    names = {(r["kind"], r["uuid"]): r["name"] for r in _used_names(run).collect()}
    sync = {r["subject_type_uuid"]: r for r in catalog.sync_concepts(run.tables).collect()}
    subjects = {s.subject_type_uuid: s for s in run.specs if s.type in SUBJECT_TYPES}
    by_key = {(s.type, s.subject_type_uuid, s.program_uuid, s.encounter_type_uuid): s for s in run.specs}
    out = []
    for spec in run.specs:
        columns = spec.of_concept_types(*MEDIA_CONCEPTS)
        subject = subjects.get(spec.subject_type_uuid)
        if not columns or subject is None or spec.type == "Address":
            continue
        parent = None
        if spec.repeat_uuid:
            owner = by_key.get((spec.parent_type, spec.subject_type_uuid, spec.program_uuid, spec.encounter_type_uuid), subject)
            parent = run.new_rows(owner.name)

        def pair(i: int) -> tuple[str, str] | None:
            row = sync.get(spec.subject_type_uuid)
            uuid = row[f"concept{i}_uuid"] if row else None
            column = next((c for c in spec.columns if uuid and c.concept_uuid == uuid), None)
            return (row[f"concept{i}_name"], column.name) if column else None

        described = media.MediaNames(
            names.get(("subject_type", spec.subject_type_uuid)),
            names.get(("encounter_type", spec.encounter_type_uuid)),
            names.get(("program", spec.program_uuid)),
            {c.concept_uuid: names.get(("concept", c.concept_uuid), c.name) for c in columns},
            pair(1),
            pair(2),
        )
        rows = Context({"t": run.new_rows(spec.name)}, window.start, window.end).changed("t")
        out.append(media.MediaSource(spec, rows, run.new_rows(subject.name), described, parent))
    return out


def _used_names(run: Run) -> DataFrame:
    """Names of the types and media questions that the specs mention."""
    media_uuids = {c.concept_uuid for s in run.specs for c in s.of_concept_types(*MEDIA_CONCEPTS)}
    rows = catalog.type_names(run.tables)
    return rows.where((F.col("kind") != "concept") | F.col("uuid").isin(sorted(media_uuids)))


def sync_media(run: Run, spec: TableSpec) -> Entry | None:
    entry = run.old_entry(spec)
    sources = media_sources(run, run.context(spec))
    fresh = media.build_media(sources)
    if fresh is None:
        empty = run.store.spark.createDataFrame([], "id bigint")
        return entry or run.store.write(conform(empty, spec), spec.name)
    group, index = "question_group_concept_name", "repeatable_question_group_index"
    # read for the newest time of each key and for its rows, on the first load too
    fresh = run.store.stage(conform(fresh, spec), spec.name)

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({"_g": F.coalesce(group, F.lit("")), "_i": F.coalesce(index, F.lit(-1))})

    return merge_months(
        run.store, spec.name, entry, keyed(fresh), ["entity_id", "concept_name", "_g", "_i"], TS, "rank",
        prepare=lambda old: keyed(conform(old, spec)), finish=lambda rows: rows.drop("_g", "_i"),
        whole=bool(run.changes.get(spec.name)),
    )


def _step(spec: TableSpec) -> Callable[[Run, TableSpec], Entry] | None:
    if spec.is_user_subject:
        return sync_user_subjects
    return {
        "Address": sync_address, "SyncTelemetry": sync_telemetry, "Media": sync_media, "MediaAnalysis": None,
    }.get(spec.type, sync_table)


def sync_tenant(
    store: Store,
    tables: Mapping[str, DataFrame],
    tenant: str,
    now: str,
    org_ids: Iterable[int] | None = None,
    group_member: bool = False,
    threads: int = 4,
    stage: bool = True,
    derived: Config | None = None,
    keep_headless: bool = False,
) -> list[TableSpec]:
    """Bring all flat tables of a tenant up to ``now``, then the tables derived from them.

    The members of a tenant group are synced one after another into the
    group's store, each with its own ids and ``group_member`` set.

    Members of a household whose last head edge was voided leave the table; with
    ``keep_headless`` they stay, with the head they had.
    """
    mine = TenantTables(tables, org_ids)
    old = load_specs(store)
    wanted = catalog.derive_specs(mine)
    changes: dict[str, list[Change]] = {}
    old_names: dict[str, str] = {}
    for change in diff(store.spark, old, wanted, group_member) if old else []:
        if change.kind == "rename_table":
            old_names[change.new_name] = change.table
        elif change.kind != "create":
            changes.setdefault(change.table, []).append(change)
    specs = merge_specs(old, wanted, group_member)
    last = watermarks(store, tenant)
    last_sync = {s.name: last.get(old_names.get(s.name, s.name), EPOCH) for s in specs}
    last_sync[APPROVALS] = last.get(APPROVALS, EPOCH)
    run = Run(store, mine, tenant, now, specs, changes, old_names, last_sync, store.manifest(), {}, keep_headless=keep_headless)
    stage_statuses(run)
    if stage:
        stage_sources(run)
    collect_renames(run)

    waves: Sequence[list[TableSpec]] = (
        [s for s in specs if s.type not in ("Media", "MediaAnalysis")],
        [s for s in specs if s.type == "Media"],
    )
    with ThreadPoolExecutor(threads) as pool:
        for wave in waves:
            for spec, entry in zip(wave, pool.map(lambda s: _step(s)(run, s), wave)):
                run.done[spec.name] = entry
    synced = store.spark.createDataFrame(
        [(name, tenant, now) for name in (*(s.name for w in waves for s in w), APPROVALS)], "table_name string, tenant string, last_sync_time string"
    )
    withdrawn = {old_name: None for old_name in old_names.values() if old_name not in run.done}
    store.commit(
        {
            **withdrawn,
            **run.done,
            SPEC_TABLE: save_specs(store, specs),
            STATE_TABLE: store.write(advanced_state(store, synced), STATE_TABLE, sort_by=None),
        }
    )
    store.release_staged()
    if derived is not None:
        run_derived(store, derived, {s.name: store.read(s.name) for s in specs if store.exists(s.name)} | dict(mine), tenant, now)
    return specs
