"""Operators on small inputs, checked against brute force."""

from __future__ import annotations

import datetime
import shutil
import statistics

import pytest
from formflow.functions import naming, obs
from formflow.functions.quantiles import grouped_median
from formflow.model import ColumnSpec, TableSpec, answer_column, ordered, to_struct
from formflow.operators import address, growth, maintain, media, media_search, reports, views
from formflow.operators.media_search import MediaRequest
from formflow.plans import derive, evolve
from formflow.plans.evolve import Change
from formflow.plans.merge import merge_months
from formflow.sources import state, storage, tables
from formflow.sources.snapshots import FAN
from formflow.streaming.sync_stream import stream_sync
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- names -----------------------------------------------------------------------
def test_table_names():
    assert naming.table_name(["Person", "Nutrition Prog."], "ProgramEnrolment", "EXIT") == "person_nutrition_prog_exit"
    long = ["Pregnant woman of the block", "Maternal and child health programme", "Antenatal check-up visit at home"]
    assert naming.table_name(long, "ProgramEncounter", "CANCEL") == "pregna_cancel_matern_cancel_antenatal_checkup_v_cancel"
    assert len(naming.table_name(long, "ProgramEligibility")) > 63  # a kind without trims keeps its name


def test_column_names():
    assert naming.hash32("hello") == 99162322 and naming.hash32("polygenelubricants") == -2147483648
    assert naming.column_name('a "b"') == "a b"
    name = "x" * 70
    assert naming.column_name(name) == "x" * 49 + f" ({abs(naming.hash32(name))})"
    assert len(naming.column_name("é" * 60).encode()) <= 63
    assert naming.view_name("t" * 63) == "t" * 57 + "_coded"


def test_spec_order_and_parents():
    specs = [TableSpec("m", "Media"), TableSpec("e", "Encounter"), TableSpec("p", "Person")]
    assert [s.name for s in ordered(specs)] == ["p", "e", "m"]
    group = lambda p, e: TableSpec("r", "RepeatableQuestionGroup", "s", p, e, repeat_uuid="q").parent_type
    assert [group("p", "e"), group(None, "e"), group("p", None), group(None, None)] == [
        "ProgramEncounter", "Encounter", "ProgramEnrolment", "IndividualProfile"
    ]
    assert to_struct(TableSpec("t", "Person", columns=(ColumnSpec("n", "numeric"),))).simpleString() == "struct<n:decimal(38,10)>"


# --- answers -----------------------------------------------------------------------
def test_answers_of_odd_documents(spark):
    docs = [
        '{"n": "12.5", "c": "a1", "t": "2022-01-01T10:30:00", "g": {"k": null}}',
        '{"n": 12345678901234567890.0123456789, "c": ["zz", "a2", null, "a1"], "t": "23:59:59"}',
        '{"c": [], "t": null}',
        '{"c": ["zz"]}',
        None,
    ]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    names = F.create_map(F.lit("a1"), F.lit("One"), F.lit("a2"), F.lit("Two"))
    o = obs.parse_obs(df, "d")
    rows = df.select(
        "i", obs.obs_numeric(o, obs.obs_path("n")).cast("string").alias("n"), obs.coded(o, obs.obs_path("c"), names).alias("c"),
        obs.obs_time(o, obs.obs_path("t")).alias("t"), obs.obs_text(o, obs.obs_path("k", "g")).alias("g"),
    ).orderBy("i").collect()
    assert [r["n"] for r in rows] == ["12.5000000000", "12345678901234567890.0123456789", None, None, None]
    assert [r["c"] for r in rows] == ["One", "Two, One", None, None, None]
    assert [r["t"] for r in rows] == ["10:30:00", "23:59:59", None, None, None]
    assert rows[0]["g"] is None


def test_bad_number_fails_unless_lenient(spark):
    df = spark.createDataFrame([('{"n": "many"}',)], "d string")
    o = obs.parse_obs(df, "d")
    assert df.select(obs.obs_numeric(o, obs.obs_path("n"), strict=False)).first()[0] is None
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CAST_INVALID_INPUT|cannot be cast"):
        df.select(obs.obs_numeric(o, obs.obs_path("n"))).collect()


def test_dates_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([('{"d": "2022-04-04T18:30:00.000Z"}',)], "d string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            o = obs.parse_obs(df, "d")
            row = df.select(obs.obs_date(o, obs.obs_path("d")), obs.obs_datetime(o, obs.obs_path("d"))).first()
            assert row[0] == datetime.date(2022, 4, 5) and row[1] == datetime.datetime(2022, 4, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_concept_map_without_answers(spark):
    concept = spark.createDataFrame([(1, "q", "Q")], "id long, uuid string, name string")
    pairs = spark.createDataFrame([], "concept_id long, answer_concept_id long")
    assert obs.concept_map(concept, pairs, ["q"]).first()[0] == {}


# --- maintenance -----------------------------------------------------------------------
ROWS = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)), max_size=30)


def brute(rows, ties):
    out = []
    for key in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == key]
        top = None if any(r[1] is None for r in mine) else max(r[1] for r in mine)
        best = [r for r in mine if r[1] == top]
        out += best if ties == "rank" else [max(best, key=lambda r: r[2])]
    return sorted(map(str, out))


@SLOW
@given(rows=ROWS)
def test_keep_latest(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    for ties in ("row_number", "rank"):
        got = maintain.keep_latest(df, ["k"], "ts", ties, [F.col("v").desc()])
        assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, ties)


@SLOW
@given(old=ROWS, fresh=ROWS)
def test_upsert_equals_latest_of_everything(spark, old, fresh):
    frame = lambda rows: spark.createDataFrame(rows, "k int, ts int, v int")
    for ties in ("row_number", "rank"):
        how = (["k"], "ts", ties, [F.col("v").desc()])
        kept = maintain.keep_latest(frame(old), *how)
        merged = maintain.upsert_latest(kept, frame(fresh), *how)
        before = [tuple(r) for r in kept.collect()]
        assert sorted(str(tuple(r)) for r in merged.collect()) == brute(before + fresh, ties)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = maintain.keep_latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_update_from_takes_one_match_and_sets_nulls(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    source = spark.createDataFrame([(1, "x"), (1, "z"), (2, None)], "id int, v string")
    got = maintain.update_from(target, source, ["id"], ["v"], [F.col("v").desc()]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "z"), (2, None), (3, "c")]


def test_renames_compose_in_order(spark):
    steps = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")]
    assert maintain.compose_renames(steps) == {"a": "c", "b": "c", "y": "x"}
    df = spark.createDataFrame([("a, q, bb",), ("b",), (None,)], "m string")
    assert [r[0] for r in maintain.rename_multi(df, "m", steps).collect()] == ["c, q, bb", "c", None]


# --- median -----------------------------------------------------------------------
@SLOW
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(-50, 50))), max_size=40))
def test_grouped_median(spark, rows):
    df = spark.createDataFrame(rows, "g int, v long")
    got = {r["g"]: r["m"] for r in grouped_median(df, ["g"], "v", "m", bucket=7).collect()}
    want = {}
    for g in {g for g, v in rows if v is not None}:
        want[g] = statistics.median(v for k, v in rows if k == g and v is not None)
    assert got == want


def test_sync_spanning_weeks_backwards(spark):
    """A clock that ran backwards puts one sync into several weeks."""
    t = datetime.datetime
    rows = [(1, "manual", t(2024, 1, 20), t(2024, 1, 2)), (2, "manual", t(2024, 1, 3, 0, 0), t(2024, 1, 3, 0, 1))]
    df = spark.createDataFrame(rows, "id int, sync_source string, sync_start_time timestamp_ntz, sync_end_time timestamp_ntz")
    got = {r["start_date"]: r["median_sync_seconds"] for r in reports.median_sync(df, "2024-01-01", "2024-01-31").collect()}
    weeks = [datetime.date(2023, 10, 1) + datetime.timedelta(7 * i) for i in range(18)]
    want = {}
    for w in weeks:
        inside = [(b - a).total_seconds() for _, _, a, b in rows if a.date() >= w and b.date() <= w + datetime.timedelta(6)]
        want[w] = statistics.median(inside) if inside else 0.0
    assert got == want


# --- reports, views ---------------------------------------------------------------------
def test_date_filter_needs_both_ends():
    with pytest.raises(ValueError):
        reports.date_filter("c", "2024-01-01", None)


def test_table_summary_and_empty_views(spark):
    specs = [TableSpec("v", "Encounter"), TableSpec("a", "Person")]
    assert [tuple(r) for r in reports.table_summary(spark, specs).collect()] == [("v", "Encounter"), ("a", "Person")]
    users = spark.createDataFrame([], "id long, username string")
    empty = views.subject_view([], users, None, None, ["Village"])
    assert empty.columns == [c for c, _ in views.SUBJECT_VIEW] + ["Village"] and empty.count() == 0
    assert "indvidual_uuid" in views.subject_view([], users, None, None, [], compat=True).columns
    assert views.enrolment_view([], users, None, None, None, []).count() == 0
    assert views.due_visits([], users, None, None, None, [], "2024-01-01").count() == 0
    nobody = {name: [] for name in ("subjects", "encounters", "enrolments", "program_encounters")}
    assert reports.user_activity(nobody, spark.createDataFrame([], "id long, name string, username string, is_voided boolean, organisation_id long")).collect() == []
    assert reports.most_cancelled([], [], spark.createDataFrame([], "id long, name string, username string, is_voided boolean, organisation_id long")).collect() == []


def test_a_family_is_one_scan_of_each_source(spark):
    from formflow.bindings import context
    from formflow.operators import families
    from formflow.workload.views import PROGRAM_ENCOUNTERS, VISITS

    ctx = context(spark, "/root/testdata/sf0.001")
    rows = families.scan(ctx, PROGRAM_ENCOUNTERS)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    # 125 tables: visits with their dates, enrolments, subjects
    assert len(PROGRAM_ENCOUNTERS) == 125 and plan.count("] parquet") == 4, plan
    assert "observations" not in rows.columns
    with pytest.raises(ValueError, match="one source"):
        families.scan(ctx, VISITS)
    tags = {r[0] for r in rows.select(families.TAG).distinct().collect()}
    assert tags <= {s.name for s in PROGRAM_ENCOUNTERS} and len(tags) > 50


# --- media -----------------------------------------------------------------------
def test_media_keys_without_folder_or_extension(spark):
    df = spark.createDataFrame([("u", "a/b/c.d.jpg"), ("u", "noslash.jpg"), (None, "x/y")], "uuid string, image_url string")
    rows = media_search.media_keys(df).collect()
    assert [r["image_uuid"] for r in rows] == ["c", "noslash.jpg", "y"]
    assert [r["composite_uuid"] for r in rows] == ["u#c", "u#noslash.jpg", "null#y"]
    assert [r["thumbnail_url"] for r in rows] == ["a/b/thumbnails/c.d.jpg", "thumbnails/", "x/thumbnails/y"]


def test_address_filter_without_ids_accepts_nothing(spark):
    rows = spark.createDataFrame([(1, 5, "B")], "id long, `Block id` long, Block string")
    assert media_search.address_json(rows, MediaRequest(addresses=(("Block", ()),))).count() == 0
    assert media_search.address_json(rows, MediaRequest(addresses=(("Block", (5,)),))).count() == 1
    with pytest.raises(ValueError):
        media_search.address_json(rows, MediaRequest(addresses=(("Hamlet", (5,)),)))


def test_subject_column_of_media():
    assert [media.subject_id_col(TableSpec("t", k)) for k in ("Person", "Encounter", "ManualProgramEnrolmentEligibility")] == [
        "id", "individual_id", "subject_id"
    ]


def test_media_keys_by_listing(spark, tmp_path):
    (tmp_path / "org").mkdir()
    (tmp_path / "org" / "a.jpg").write_bytes(b"1")
    (tmp_path / "org" / "b.jpg").write_bytes(b"2")
    keys = storage.list_media_keys(spark, str(tmp_path / "org"))
    assert sorted(r[0].rsplit("/", 1)[1] for r in keys.collect()) == ["a.jpg", "b.jpg"]
    spark.createDataFrame([("org/a",), ("other/b",)], "key string").write.parquet(str(tmp_path / "inv"))
    assert [r[0] for r in storage.read_inventory(spark, str(tmp_path / "inv"), "key", "org/").collect()] == ["org/a"]


# --- address -----------------------------------------------------------------------
def test_level_types_in_a_cycle_are_refused(spark):
    types = spark.createDataFrame([(1, "A", 2, False), (2, "B", 1, False)], "id long, name string, parent_id long, is_voided boolean")
    with pytest.raises(ValueError, match="cycle"):
        address.level_chain(types)


# --- specs ---------------------------------------------------------------------------
SPEC = TableSpec(
    "t", "Person", "s", columns=(ColumnSpec("id", "integer"), answer_column("Q", 1, "Numeric", "q"), answer_column("P C", 2, "Text", "c", "p", "P")),
)


def test_specs_survive_the_store(store):
    plain = TableSpec("u", "User")
    store.commit({evolve.SPEC_TABLE: evolve.save_specs(store, [SPEC, plain])})
    assert sorted(evolve.load_specs(store), key=lambda s: s.name) == [SPEC, plain]


def test_diff_and_merge(spark):
    new = TableSpec("t2", "Person", "s", columns=(ColumnSpec("id", "text"), answer_column("Q2", 1, "Numeric", "q")))
    changes = evolve.diff(spark, [SPEC], [new])
    assert changes == [
        Change("rename_table", "t", None, "t2"),
        Change("void_column", "t2", "P C", "voided_P C"),
        Change("rename_column", "t2", "Q", "Q2"),
        Change("alter_type", "t2", "id", None, "text"),
    ]
    merged = evolve.merge_specs([SPEC], [new])[0]
    assert [(c.name, c.voided) for c in merged.columns] == [("id", False), ("Q2", False), ("voided_P C", True)]
    assert evolve.diff(spark, [merged], [new]) == []
    assert [c.kind for c in evolve.diff(spark, [SPEC], [new], group_member=True)] == ["rename_table", "rename_column", "alter_type"]


# --- store, state, stream ----------------------------------------------------------------
def test_commit_is_one_step_and_conflicts_are_told(spark, store):
    store.publish(spark.range(3), "a")
    entry = store.write(spark.range(5), "a")
    assert store.read("a").count() == 3
    store.commit({"a": entry, "b": entry})
    assert store.read("a").count() == store.read("b").count() == 5
    store.commit({"b": None})
    assert not store.exists("b")
    taken = store._versions
    store._versions = lambda: taken()[:-1]  # another run committed in between
    with pytest.raises(RuntimeError, match="another run"):
        store.commit({"a": None})


def test_append_compacts(spark, store):
    entry = None
    for i in range(FAN + 1):
        entry = store.append(spark.range(i, i + 1), "t", entry)
    assert len(entry) == 2 and store.load(entry).count() == FAN + 1
    again = store.append(spark.range(100, 101), "t", entry)
    assert again[:-1] == entry


def test_appended_rows_are_rewritten_logarithmically(spark, store, monkeypatch):
    """500 appends, of one row or of very many: sizes stand for rows here, nothing is written."""
    written = []

    def write(df, name, **how):
        written.append(df)
        return [{"folder": f"f{len(written)}", "parts": None, "rows": df}]

    monkeypatch.setattr(store, "write", write)
    monkeypatch.setattr(store, "load", lambda entry: sum(p["rows"] for p in entry))
    monkeypatch.setattr(store, "size", lambda piece: piece["rows"] * 1000)
    for first in (1, 10**9):
        entry, written[:] = store.append(first, "t"), []
        for _ in range(500):
            entry = store.append(1, "t", entry)
            assert len(entry) <= FAN * 4
        assert sum(p["rows"] for p in entry) == first + 500
        # each small row once when it comes and once for each size it passes; the large first piece never
        assert sum(written) <= 500 * 4 and (first == 1 or max(written) < first)


def test_vacuum_leaves_what_is_read(spark, store):
    first = store.write(spark.range(3), "t")
    store.commit({"t": first})
    for n in (4, 5, 6):
        store.commit({"t": store.write(spark.range(n), "t")})
    store.stage(spark.range(1), "s")
    assert store.vacuum() == []  # all too young
    gone = store.vacuum(grace_hours=-1)
    assert len(gone) == 3 and sum(g.startswith("_staged/") for g in gone) == 1
    assert store.read("t").count() == 6 and len(store._versions()) == 2
    store.stage(spark.range(1), "s")
    store.release_staged()
    assert store.vacuum(grace_hours=-1) == []


def test_statuses_are_folded(spark):
    """Every window folded into the state gives what the whole history gives, edits and voided rows included."""
    import random

    from formflow.operators import maintain

    rng, history, state = random.Random(4), {}, None
    names = spark.createDataFrame([(1, "Pending"), (2, "Approved"), (3, None)], "id long, status string")
    schema = "id long, entity_type string, entity_id long, status_date_time timestamp_ntz, approval_status_id long, is_voided boolean"
    for step in range(4):
        window = []
        for _ in range(25):
            old = rng.choice(list(history)) if history and rng.random() < 0.4 else None
            row = (
                old or len(history) + 1, history[old][1] if old else rng.choice(["Subject", "Encounter"]), history[old][2] if old else rng.randrange(9),
                datetime.datetime(2024, 1, 1 + rng.randrange(20)), rng.choice([1, 2, 2, 3, 9]), rng.random() < 0.3,
            )
            if row[0] in {w[0] for w in window}:
                continue
            history[row[0]] = row
            window.append(row)
        whole = spark.createDataFrame(list(history.values()), schema)
        window = spark.createDataFrame(window, schema)
        want = sorted(map(str, maintain.current_statuses(whole, names).select("entity_type", "entity_id", "id", "status").collect()))
        if state is None:
            state = maintain.current_statuses(window, names)
        else:
            folded = maintain.fold_statuses(state, window, whole, names)
            state = state.join(window.select(*maintain.STATUS_KEYS).distinct(), maintain.STATUS_KEYS, "left_anti").unionByName(folded)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert sorted(map(str, state.select("entity_type", "entity_id", "id", "status").collect())) == want, step


def test_watermarks_and_cutoffs(spark, store):
    wanted = spark.createDataFrame([("t", "a"), ("u", "a")], "table_name string, tenant string")
    assert {str(r["last_sync_time"]) for r in state.load_state(store, wanted).collect()} == {tables.EPOCH}
    for when in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"):
        state.advance_state(store, spark.createDataFrame([("t", "a", when)], "table_name string, tenant string, last_sync_time string"))
    got = {r["table_name"]: (str(r["last_sync_time"]), r["sync_status"]) for r in state.load_state(store, wanted).collect()}
    assert got == {"t": ("2024-02-01 00:00:00", "Success"), "u": (tables.EPOCH, "Running")}
    assert state.cutoff_get(store, "a") == tables.EPOCH
    state.cutoff_put(store, "a", "2024-01-01 00:00:00")
    state.cutoff_put(store, "b", "2024-03-01 00:00:00")
    assert state.cutoff_get(store, "a") == "2024-01-01 00:00:00"


def test_stream_merges_batches_and_ignores_replays(spark, store, tmp_path):
    folder = str(tmp_path / "in")
    for i, rows in enumerate([[(1, 1, "a"), (2, 1, "b")], [(1, 3, "c")], [(1, 2, "late"), (3, 1, "d")]]):
        spark.createDataFrame(rows, "id int, ts int, v string").coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema("id int, ts int, v string").option("maxFilesPerTrigger", 1).parquet(folder)
    stream_sync(source, store, "t", lambda b: b, ["id"], "ts")
    want = [(1, 3, "c"), (2, 1, "b"), (3, 1, "d")]
    assert sorted(tuple(r) for r in store.read("t").collect()) == want
    versions = len(store._versions())
    # same batches again under a lost checkpoint: nothing is applied twice
    shutil.rmtree(f"{store.root}/_checkpoint")
    stream_sync(source, store, "t", lambda b: b, ["id"], "ts")
    assert sorted(tuple(r) for r in store.read("t").collect()) == want and len(store._versions()) == versions


def test_month_merge_writes_what_it_touches(spark, store):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, ts int, made string, v string").withColumn("made", F.col("made").cast("timestamp"))
    merge = lambda entry, df, **how: merge_months(store, "t", entry, df, ["id"], "ts", created="made", **how)
    first = merge(None, rows((1, 1, "2024-01-01", "a"), (2, 1, "2024-02-01", "b"), (3, 1, None, "c")))
    assert first[0]["parts"] == ["m2024_01", "m2024_02", "none"]
    second = merge(first, rows((2, 2, "2024-02-01", "B"), (4, 1, "2024-03-01", "d"), (1, 0, "2024-01-01", "late")))
    assert [p["parts"] for p in second] == [["none"], ["m2024_01", "m2024_02", "m2024_03"]]
    assert sorted((r["id"], r["v"]) for r in store.load(second).collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    gone = spark.createDataFrame([(3,)], "id int")
    third = merge(second, rows().limit(0), touched=gone, finish=lambda df: df.where("id <> 3"))
    assert [p["parts"] for p in third] == [["m2024_01", "m2024_02", "m2024_03"]]
    assert merge(third, rows().limit(0)) == third


# --- derived -----------------------------------------------------------------------
def test_derived_run_moves_the_cutoff(spark, store):
    text = """{"ddl": [{"order": 1, "table": "r", "sql": "create"}],
               "dml": [{"order": 1, "table": "r", "sqls": [{"order": 1, "sourceTableName": "s", "insert-sql": "insert", "update-sqls": ["mark"]},
                                                         {"order": 0, "sourceTableName": "s", "insert-sql": "", "update-sqls": []}]}]}"""
    schema = spark.createDataFrame([], "id int, ts timestamp, mark string").schema
    steps = {
        "insert": "select id, ts from {s} where ts > cast(:previousCutoffDateTime as timestamp) and ts <= cast(:newCutoffDateTime as timestamp)",
        "mark": lambda t, prev, new: t["r"].withColumn("mark", F.coalesce("mark", F.lit(new[:7]))),
    }
    config = derive.load_config(text, steps, {"create": schema})
    rows = spark.createDataFrame([(1, "2024-01-15 00:00:00"), (2, "2024-02-15 00:00:00")], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    for now in ("2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"):
        derive.run_derived(store, config, {"s": rows}, "one", now)
    assert sorted((r["id"], r["mark"]) for r in store.read("r").collect()) == [(1, "2024-02"), (2, "2024-03")]
    commit, store.commit = store.commit, lambda changes: (_ for _ in ()).throw(RuntimeError("lost"))
    more = rows.unionByName(spark.createDataFrame([(3, "2024-04-15 00:00:00")], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp")))
    with pytest.raises(RuntimeError, match="lost"):
        derive.run_derived(store, config, {"s": more}, "one", "2024-05-01 00:00:00")
    store.commit = commit
    derive.run_derived(store, config, {"s": more}, "one", "2024-05-01 00:00:00")
    assert sorted(r["id"] for r in store.read("r").collect()) == [1, 2, 3]


def test_report_layouts(spark):
    assert len(growth.report_schema()) == 45
    assert growth.ensure_table(spark, growth.report_schema()).count() == 0


def test_tenant_filter_by_rows(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 10)], "id int, organisation_id long")
    members = spark.createDataFrame([(10,)], "organisation_id long")
    assert sorted(r["id"] for r in tables.tenant_filter(df, members).collect()) == [1, 3]
    assert [r["id"] for r in tables.tenant_filter(df, [20]).collect()] == [2]


# --- plans -----------------------------------------------------------------------------
def _nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _names(node):
    output = node.output()
    return [output.apply(i).name() for i in range(output.size())]


def _joins(df):
    plan = df._jdf.queryExecution().optimizedPlan()
    for node in _nodes(plan):
        if node.nodeName() == "Join":
            children = node.children()
            yield [_names(children.apply(i)) for i in range(children.size())]


@pytest.mark.parametrize("name", ["e3_encounter", "e4_encounter_cancel", "e5_enrolment", "e6_exit", "e7_program_encounter", "e8_program_encounter_cancel", "e9_eligibility", "o11_sync_attr"])
def test_a_subjects_document_is_in_no_join(spark, name):
    """Of the subject a join carries its key, its type and the answers that are sync attributes."""
    from formflow.workload import QUERIES

    found = list(_joins(QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert found
    for side in (names for pair in found for names in pair):
        assert "_obs" not in side
        assert "observations" not in side or not {"subject_type_id", "_subject_type_id"} & set(side), side


def test_placed_rows_need_no_subjects(spark, store):
    """Rows that a run has placed give the same table as the sources do, and join names of types only."""
    from formflow.bindings import Bound, context
    from formflow.operators import entities
    from formflow.plans.sync import Staged
    from formflow.sources.tables import Context
    from formflow.workload.common import encounter_spec, plain, program_encounter_spec

    sf = "/root/testdata/sf0.001"
    ctx = context(spark, sf)
    for spec, source in ((encounter_spec(), "encounter"), (program_encounter_spec(), "program_encounter")):
        rows = entities.place(ctx, source, ctx.changed(source), entities.sync_columns([spec]))
        ready = Context(Staged(Bound(spark, sf), {source: store.stage(rows, source, "encounter_type_id")}))
        table = entities.flatten(ready, spec)
        for left, right in _joins(table):
            assert len(right) == 1 and right[0] in ("_subject_type_id", "_program_id", "encounter_type_id")
        assert sorted(map(str, plain(table).collect())) == sorted(map(str, plain(entities.flatten(ctx, spec)).collect()))
        assert table.where("Ward is not null").count() > 0


def test_a_rename_leaves_months_without_the_old_name_alone(spark, store):
    rows = [(1, "Old", "2024-01-05"), (2, "Other", "2024-02-05"), (3, "A, Old", "2024-03-05"), (4, None, "2024-04-05")]
    table = spark.createDataFrame(rows, "id long, answer string, day string").select(
        "id", "answer", F.col("day").cast("timestamp").alias("created_date_time"), F.col("day").cast("timestamp").alias("last_modified_date_time")
    )
    first = store.write_months(table, "t")
    none = table.limit(0)
    for many, touched in ((False, {"m2024_01"}), (True, {"m2024_01", "m2024_03"})):
        rename = maintain.rename_multi if many else maintain.rename_single
        entry = merge_months(
            store, "t", first, none, ["id"], "last_modified_date_time",
            prepare=lambda old: rename(old, "answer", [("Old", "New")]), dirty=maintain.holds_any("answer", ["Old"], many),
        )
        kept = {p for e in entry if e["folder"] == first[0]["folder"] for p in e["parts"]}
        assert {p for e in entry for p in e["parts"]} - kept == touched
        found = {r.id: r.answer for r in store.load(entry).collect()}
        assert found == {1: "New", 2: "Other", 3: "A, New" if many else "A, Old", 4: None}
    assert merge_months(store, "t", first, none, ["id"], "last_modified_date_time") == first
