"""Views, reports, media search and media analysis from a store that a sync filled."""

from __future__ import annotations

import pytest
from clinic import NOW1, clinic, tables
from formflow.operators import media_search
from formflow.operators.media_search import MediaRequest
from formflow.plans import products
from formflow.plans.sync import sync_tenant
from formflow.sources import snapshots
from formflow.sources.snapshots import Store


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("products")))
    sources = tables(spark, clinic())
    sync_tenant(store, sources, "one", NOW1, [1], threads=8)
    return store, sources


def test_views_of_a_store(filled):
    store, sources = filled
    names = products.publish_views(store, sources, "2022-04-10", [1])
    assert {products.SUBJECTS, products.ENROLMENTS, products.DUE, products.COMPLETED, products.OVERDUE} <= set(names)
    subjects = {r["individual_id"] for r in store.read(products.SUBJECTS).collect()}
    assert subjects == {r["id"] for n in ("person", "house") for r in store.read(n).collect() if not r["is_voided"]}
    enrolled = {r["enrolment_id"] for r in store.read(products.ENROLMENTS).collect()}
    assert enrolled == {r["id"] for r in store.read("person_nutrition").collect() if not r["is_voided"]}
    chosen = sorted((r["id"], r["answer"]) for r in store.read("person_coded").collect())
    assert (1, "Delta") in chosen and (1, "Kappa") in chosen


def test_reports_search_and_analysis_of_a_store(spark, filled):
    store, sources = filled
    rows = products.user_activity(store, sources["users"]).collect()
    assert rows and all(r["total"] > 0 for r in rows)
    assert sum(r["registration_count"] for r in rows) == store.read("person").union(store.read("person")).count() // 2 + store.read("house").count()
    found = products.search_media(store, MediaRequest(subject_types=("Person",)), limit=None).collect()
    assert {r["image_url"] for r in found} == {r["image_url"] for r in store.read("media").collect()}
    keys = spark.createDataFrame([("org/one.jpg",)], "object_key string")
    out = products.run_media_analysis(store, keys, "m.example.com/org")
    assert store.read(products.ANALYSIS).count() == out.count() == len(found)


def test_media_analysis_reads_again_what_changed(spark, store):
    """A second run after a new file rewrites that file's bucket; a third without changes writes nothing."""
    name = lambda n: f"00000000-0000-4000-8000-{n:012d}.jpg"
    media = [(f"e{n}", f"http://m/org/{name(n)}", None, False) for n in range(200)] + [("e5", f"http://m/org/{name(5)}", None, False), ("x", "odd", None, False)]
    store.publish(spark.createDataFrame(media, "uuid string, image_url string, created_date_time timestamp, is_voided boolean"), products.MEDIA, sort_by=None)
    keys = [(f"org/{name(n)}",) for n in range(100)]
    frame = lambda rows: spark.createDataFrame(rows, "object_key string")
    whole = lambda rows: sorted(map(str, media_search.media_analysis(store.read(products.MEDIA), frame(rows), "/org/").collect()))
    got = products.run_media_analysis(store, frame(keys), "/org/")
    assert sorted(map(str, got.collect())) == whole(keys)
    first = {p: e["folder"] for e in store.manifest()[products.ANALYSIS] for p in e["parts"]}
    keys.append((f"org/thumbnails/{name(7)}",))
    got = products.run_media_analysis(store, frame(keys), "/org/")
    assert sorted(map(str, got.collect())) == whole(keys)
    second = {p: e["folder"] for e in store.manifest()[products.ANALYSIS] for p in e["parts"]}
    assert first.keys() == second.keys() and sum(first[p] != second[p] for p in first) == 1
    versions = store._versions()
    products.run_media_analysis(store, frame(keys), "/org/")
    assert store._versions() == versions
    got = products.run_media_analysis(store, frame([]), "/org/")
    assert sorted(map(str, got.collect())) == whole([])


def test_views_join_the_addresses_in_use(filled):
    store, _ = filled
    ids = {r["address_id"] for n in ("person", "house", "person_nutrition") for r in store.read(n).collect()}
    found = {r["id"] for r in products.used_addresses(store).collect()}
    known = {r["id"] for r in store.read("address").collect()}
    assert ids & known <= found <= known and found


def test_few_rows_have_a_known_size_and_few_tables_no_shuffle(spark, store, monkeypatch):
    few = snapshots.lookup(spark, ["a", "b"], [("x", None), ("y", "z")])
    assert sorted(map(tuple, few.collect())) == [("x", None), ("y", "z")]
    assert int(few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 10_000
    rows, hints = spark.createDataFrame([(1, "t"), (2, "u"), (3, "t")], "id long, _tag string"), []
    hint = type(rows).hint
    monkeypatch.setattr(type(rows), "hint", lambda df, name, *a: (hints.append(name), hint(df, name, *a))[1])
    for limit, used in ((2, []), (1, ["rebalance"])):
        monkeypatch.setattr(snapshots, "FEW_TABLES", limit)
        entries = store.write_family(rows, f"family{limit}", "_tag", ["t", "u"])
        assert {n: sorted(r.id for r in store.load(e).collect()) for n, e in entries.items()} == {"t": [1, 3], "u": [2]} and hints == used
