"""End to end: runs over the clinic with edits in between.

A run is some forty small jobs, so one story of four runs serves all tests.
"""

from __future__ import annotations

import datetime

import pytest
from clinic import EDIT2, EDIT3, NOW1, NOW2, NOW3, audit, clinic, find, tables
from formflow.plans.sync import sync_tenant
from formflow.sources.snapshots import Store

NOW4 = "2022-08-01 00:00:00"


def contents(store):
    out = {}
    for name in store.manifest():
        if not name.startswith("_"):
            df = store.read(name)
            out[name] = [r.asDict(recursive=True) for r in df.collect()]
    return out


def run(store, spark, data, now, **how):
    return sync_tenant(store, tables(spark, data), "one", now, [1], threads=8, **how)


def first_edits(data):
    """Edits between the first and the second run."""
    data["concept"].append(dict(id=40, uuid="c-new", name="New concept", data_type="Numeric", is_voided=False))
    data["form_element"].append(dict(id=40, form_element_group_id=6, concept_id=40, type="SingleSelect", is_voided=False))
    find(data["program_encounter"], id=1).update(
        observations='{"c-num": 73, "c-new": 58}', last_modified_date_time=EDIT2
    )
    find(data["individual"], id=1).update(
        observations=find(data["individual"], id=1)["observations"].split(', "c-rep"')[0] + ', "c-rep": [{"c-coin": 1, "c-place": "X"}]}',
        last_modified_date_time=EDIT2,
    )
    find(data["encounter"], id=1).update(
        observations='{"c-num": 9, "c-many": ["a-kappa"], "c-image": [{"uri": "http://m.example.com/org/x.png"}, {"uri": "http://m.example.com/org/y.png"}, "http://m.example.com/org/z.png"]}',
        last_modified_date_time=EDIT2,
    )
    find(data["encounter"], id=3).update(cancel_date_time=EDIT2, last_modified_date_time=EDIT2, cancel_observations='{"c-why": "rain"}')
    data["entity_approval_status"].append(
        dict(id=2, uuid="ea-2", entity_id=2, entity_type="Subject", approval_status_id=2, is_voided=False, status_date_time=EDIT2)
    )
    for i, role in ((1, 2), (2, 1)):  # the household has another head
        find(data["group_subject"], id=i).update(group_role_id=role, last_modified_date_time=EDIT2)
    find(data["address_level"], id=1).update(title="Capital", last_modified_date_time=EDIT2)


def second_edits(data):
    """Edits between the second and the third run."""
    find(data["concept"], uuid="c-photo")["name"] = "Portrait"
    find(data["operational_subject_type"], id=2)["name"] = "Home"
    find(data["form_element"], id=1)["is_voided"] = True
    data["concept"].append(dict(id=41, uuid="c-num2", name="Weight", data_type="Text", is_voided=False))
    data["form_element"].append(dict(id=41, form_element_group_id=1, concept_id=41, type="SingleSelect", is_voided=False))
    step = lambda i, c, old, new, t: dict(id=i, concept_id=c, old_answer_concept_name=old, new_answer_concept_name=new, is_voided=False, last_modified_date_time=t)
    data["answer_concept_migration"] += [
        step(1, 2, "Alpha", "first", EDIT3), step(2, 2, "first", "second", "2022-06-16 00:00:00"), step(3, 3, "Kappa", "kappa", EDIT3),
    ]
    find(data["encounter"], id=2).update(cancel_date_time=None, last_modified_date_time=EDIT3)
    find(data["program_enrolment"], id=2).update(program_exit_date_time=None, last_modified_date_time=EDIT3)


@pytest.fixture(scope="module")
def story(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("story")))
    data = clinic()
    for i in range(10, 14):  # visits of a later month
        data["encounter"].append({**data["encounter"][2], "id": i, "uuid": f"e-{i}", **audit(f"2022-04-{i} 00:00:00")})
    after, manifests = [], []
    for now, edit in ((NOW1, None), (NOW2, first_edits), (NOW3, second_edits), (NOW4, None)):
        if edit:
            edit(data)
        specs = run(store, spark, data, now, stage=now != NOW3)
        after.append(contents(store))
        manifests.append(store.manifest())
    return {"after": after, "manifests": manifests, "specs": specs, "data": data, "store": store}


def by_id(rows):
    return {r["id"]: r for r in rows}


def test_first_run_fills_every_table(story):
    t = story["after"][0]
    assert set(t) == {
        "person", "house", "worker", "person_visit", "person_visit_cancel", "person_nutrition", "person_nutrition_exit",
        "person_nutrition_weigh", "house_person", "address", "media", "sync_telemetry", "users", "person_wallet",
    }
    person = by_id(t["person"])
    assert set(person) == {1, 2}
    asha = person[1]
    assert asha["Weight"] == 12.25 and asha["Choice"] == "Alpha" and asha["Choices"] == "Delta, Kappa"
    assert asha["Day"] == datetime.date(2022, 4, 5) and asha["Clock"] == "10:30:00" and asha["Age"] == "P3Y9M"
    assert (asha["Parent Child 1"], asha["Parent Child 2"]) == ("value 1", "value 2")
    assert asha["gender"] == "Female" and asha["middle_name"] == "M" and asha["latest_approval_status"] == "Rejected"
    assert set(by_id(t["house"])) == {3}
    visits = by_id(t["person_visit"])
    assert {i: visits[i]["Ward"] for i in (1, 2, 3)} == {1: "Mill Lane", 2: "east", 3: "east"}
    assert [(r["id"], r["Reason"]) for r in t["person_visit_cancel"]] == [(2, "moved")]
    assert [(r["id"], r["Reason"]) for r in t["person_nutrition_exit"]] == [(2, "cured")]
    assert [(r["id"], r["Weight"]) for r in t["person_nutrition_weigh"]] == [(1, 8.5)]
    wallet = sorted((r["repeatable_question_group_index"], r["individual_id"], r["Barley"], r["Market"]) for r in t["person_wallet"])
    assert wallet == [(0, 1, 100, "North gate"), (1, 1, 7, "B")]
    assert sorted((r["id"], r["Head of household ID"]) for r in t["house_person"]) == [(1, 1), (2, 1)]
    assert [(r["user_id"], r["id"]) for r in t["worker"]] == [(1, 4)]
    assert len(t["users"]) == 2 and len(t["sync_telemetry"]) == 1


def test_media_names_and_sync_attribute(story):
    rows = sorted(story["after"][0]["media"], key=lambda r: r["image_url"])
    assert [(r["concept_name"], r["image_url"].rsplit("/", 1)[1]) for r in rows] == [("Picture", "a.png"), ("Picture", "b.png"), ("Photo", "one.jpg")]
    assert rows[0]["subject_type_name"] == "Person" and rows[0]["encounter_type_name"] == "Visit"
    assert (rows[0]["sync_parameter_key1"], rows[0]["sync_parameter_value1"]) == ("Ward", "Mill Lane")


def test_address_has_all_levels(story):
    places = by_id(story["after"][0]["address"])
    assert len(places) == 6
    assert [places[6][c] for c in ("Village", "Block", "District", "Village id", "Block id", "District id")] == ["V3", "B2", "D1", 6, 5, 1]
    assert places[2]["Village"] is None and places[2]["Terrain"] == "hill"


def test_edit_replaces_the_row_and_a_new_question_is_filled(story):
    rows = story["after"][1]["person_nutrition_weigh"]
    assert [(r["id"], r["Weight"], r["New concept"]) for r in rows] == [(1, 73, 58)]
    assert len(story["after"][1]["person_visit"]) == 7


def test_only_touched_months_are_rewritten(story):
    before, after = (m["person_visit"] for m in story["manifests"][:2])
    assert before[0]["parts"] == ["m2022_03", "m2022_04"]
    # visits 1 and 3 are of March; visit 2, of April, did not change
    assert (before[0]["folder"], ["m2022_04"]) in [(p["folder"], p["parts"]) for p in after]
    assert [p["parts"] for p in after if p["folder"] != before[0]["folder"]] == [["m2022_03"]]


def test_approval_moves_without_an_edit(story):
    people = by_id(story["after"][1]["person"])
    assert (people[1]["latest_approval_status"], people[2]["latest_approval_status"]) == ("Rejected", "Approved")


def test_cancel_and_uncancel(story):
    cancelled = [sorted((r["id"], r["Reason"]) for r in t["person_visit_cancel"]) for t in story["after"][1:3]]
    assert cancelled == [[(2, "moved"), (3, "rain")], [(3, "rain")]]
    assert [len(t["person_nutrition_exit"]) for t in story["after"][1:3]] == [1, 0]


def test_repeat_group_keeps_the_newest_generation(story):
    assert [(r["Barley"], r["Market"]) for r in story["after"][1]["person_wallet"]] == [(1, "X")]


def test_media_is_replaced_as_a_set(story):
    urls = sorted(r["image_url"].rsplit("/", 1)[1] for r in story["after"][1]["media"])
    assert urls == ["one.jpg", "x.png", "y.png", "z.png"]


def test_parent_rename_reaches_unchanged_addresses(story):
    assert {r["District"] for r in story["after"][1]["address"]} == {"Capital"}


def test_a_new_head_replaces_the_old_one(story):
    edges = [sorted((r["id"], r["Head of household ID"]) for r in t["house_person"]) for t in story["after"][:2]]
    assert edges == [[(1, 1), (2, 1)], [(1, 2), (2, 2)]]


def test_renames_of_question_and_type(story):
    t = story["after"][2]
    asha = by_id(t["person"])[1]
    assert asha["Portrait"].endswith("one.jpg") and "Photo" not in asha
    assert "house" not in t and set(by_id(t["home"])) == {3}


def test_replaced_question_keeps_its_data_as_voided(story):
    for t in story["after"][2:]:
        asha = by_id(t["person"])[1]
        assert asha["voided_Weight"] == 12.25 and asha["Weight"] is None


def test_answer_renames_reach_old_rows_in_order(story):
    asha = by_id(story["after"][2]["person"])[1]
    assert (asha["Choice"], asha["Choices"]) == ("second", "Delta, kappa")
    assert by_id(story["after"][2]["person_visit"])[1]["Choices"] == "kappa"


def test_a_run_without_edits_changes_nothing(story):
    assert [{k: sorted(map(str, v)) for k, v in t.items()} for t in story["after"][2:3]] == [
        {k: sorted(map(str, v)) for k, v in story["after"][3].items()}
    ]


def test_changed_data_type_of_a_question_fails(spark, story):
    data, store = story["data"], story["store"]
    find(data["concept"], uuid="c-date")["data_type"] = "Text"
    before = store.manifest()
    with pytest.raises(ValueError, match="data type"):
        run(store, spark, data, "2022-09-01 00:00:00")
    assert store.manifest() == before


def test_tenant_group_unites_its_members(spark, store):
    """Registration only: two members synced twice into one schema."""
    data = clinic()
    data["form_mapping"] = data["form_mapping"][:1]
    for table in ("subject_type", "program", "address_level_type"):
        for row in data[table]:
            row["organisation_id"] = None
    shared = {k: v.drop("organisation_id") if k in ("subject_type", "program", "address_level_type") else v for k, v in tables(spark, data).items()}
    for now, org in ((NOW1, 1), (NOW1, 2), (NOW2, 1)):
        sync_tenant(store, shared, f"org{org}", now, [org], group_member=True, threads=8, stage=False)
    assert {r["id"] for r in store.read("person").collect()} == {1, 2, 5}


def test_other_runs_leave_the_lists_of_other_months_alone(story):
    """A repeat table is kept by its parent's month: the first edit gives subject 1 a new list, the later runs change no list."""
    first, second, third = ([(p["folder"], p["parts"]) for p in m["person_wallet"]] for m in story["manifests"][:3])
    assert all(parts and all(x.startswith("m") for x in parts) for _, parts in first)
    assert second != first and third == second


def test_nothing_staged_is_left(story, spark):
    assert not any(name.startswith("_staged/") for name in story["store"].vacuum(grace_hours=0))


def test_derived_tables_follow_a_sync(spark, store):
    """Steps run after the commit over the window since the last cut-off, once for each sync."""
    from formflow.plans.derive import Config, Source, Table, Target
    from formflow.sources.state import cutoff_get
    from pyspark.sql import types as T

    people = """select id, first_name from {person}
        where last_modified_date_time > cast(:previousCutoffDateTime as timestamp) and last_modified_date_time <= cast(:newCutoffDateTime as timestamp)"""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("first_name", T.StringType())])
    config = Config([Table(1, "seen", schema)], [Target(1, "seen", [Source(1, "person", people)])])
    data = clinic()
    run(store, spark, data, NOW1, derived=config)
    assert sorted(r.id for r in store.read("seen").collect()) == [1, 2] and cutoff_get(store, "one") == NOW1
    find(data["individual"], id=2).update(first_name="Renamed", last_modified_date_time=EDIT2)
    run(store, spark, data, NOW2, derived=config)
    before = find(clinic()["individual"], id=2)["first_name"]
    assert sorted((r.id, r.first_name) for r in store.read("seen").collect())[1:] == sorted([(2, "Renamed"), (2, before)])
