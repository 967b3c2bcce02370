"""A small clinic: metadata and source rows of two tenants, edited in tests."""

from __future__ import annotations

from copy import deepcopy

SCHEMAS = {
    "subject_type": "id long, uuid string, name string, type string, organisation_id long, allow_middle_name boolean, sync_registration_concept_1 string, sync_registration_concept_2 string",
    "operational_subject_type": "id long, subject_type_id long, name string",
    "program": "id long, uuid string, name string, organisation_id long",
    "operational_program": "id long, program_id long, name string",
    "encounter_type": "id long, uuid string, name string",
    "operational_encounter_type": "id long, encounter_type_id long, name string",
    "gender": "id long, name string",
    "group_role": "id long, role string, group_subject_type_id long, member_subject_type_id long",
    "concept": "id long, uuid string, name string, data_type string, is_voided boolean",
    "concept_answer": "concept_id long, answer_concept_id long",
    "form": "id long, uuid string, form_type string, is_voided boolean",
    "form_element_group": "id long, form_id long, is_voided boolean",
    "form_element": "id long, form_element_group_id long, concept_id long, group_id long, type string, key_values string, is_voided boolean",
    "non_applicable_form_element": "form_element_id long",
    "decision_concept": "concept_id long, form_id long",
    "form_mapping": "id long, uuid string, form_id long, subject_type_id long, entity_id long, observations_type_entity_id long, is_voided boolean",
    "address_level_type": "id long, name string, parent_id long, is_voided boolean, organisation_id long",
    "address_level": "id long, uuid string, title string, type_id long, parent_id long, is_voided boolean, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, gps_coordinates struct<x:double,y:double>, location_properties string",
    "individual": "id long, uuid string, first_name string, middle_name string, last_name string, subject_type_id long, gender_id long, address_id long, registration_date date, date_of_birth date, date_of_birth_verified boolean, registration_location struct<x:double,y:double>, is_voided boolean, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, legacy_id string, observations string",
    "encounter": "id long, uuid string, name string, individual_id long, encounter_type_id long, address_id long, earliest_visit_date_time timestamp, max_visit_date_time timestamp, encounter_date_time timestamp, cancel_date_time timestamp, encounter_location struct<x:double,y:double>, cancel_location struct<x:double,y:double>, is_voided boolean, created_by_id long, last_modified_by_id long, filled_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, legacy_id string, observations string, cancel_observations string",
    "program_enrolment": "id long, uuid string, individual_id long, program_id long, address_id long, enrolment_date_time timestamp, program_exit_date_time timestamp, enrolment_location struct<x:double,y:double>, exit_location struct<x:double,y:double>, is_voided boolean, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, legacy_id string, observations string, program_exit_observations string",
    "program_encounter": "id long, uuid string, name string, program_enrolment_id long, individual_id long, encounter_type_id long, address_id long, earliest_visit_date_time timestamp, max_visit_date_time timestamp, encounter_date_time timestamp, cancel_date_time timestamp, encounter_location struct<x:double,y:double>, cancel_location struct<x:double,y:double>, is_voided boolean, created_by_id long, last_modified_by_id long, filled_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, legacy_id string, observations string, cancel_observations string",
    "subject_program_eligibility": "id long, uuid string, subject_id long, program_id long, is_eligible boolean, check_date timestamp, is_voided boolean, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long, observations string",
    "group_subject": "id long, uuid string, group_subject_id long, member_subject_id long, group_role_id long, is_voided boolean, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, organisation_id long",
    "users": "id long, uuid string, username string, name string, organisation_id long, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, catchment_id long, email string, phone_number string, is_voided boolean",
    "user_subject": "user_id long, subject_id long",
    "sync_telemetry": "id long, uuid string, user_id long, organisation_id long, created_by_id long, last_modified_by_id long, created_date_time timestamp, last_modified_date_time timestamp, sync_status string, sync_start_time timestamp, sync_end_time timestamp, device_name string, android_version string, app_version string, device_info string, sync_source string",
    "entity_approval_status": "id long, uuid string, entity_id long, entity_type string, approval_status_id long, is_voided boolean, status_date_time timestamp",
    "approval_status": "id long, status string",
    "answer_concept_migration": "id long, concept_id long, old_answer_concept_name string, new_answer_concept_name string, is_voided boolean, last_modified_date_time timestamp",
}

D1, D2, D3 = "2022-03-10 08:00:00", "2022-03-20 08:00:00", "2022-04-02 08:00:00"
NOW1, NOW2, NOW3 = "2022-05-01 00:00:00", "2022-06-01 00:00:00", "2022-07-01 00:00:00"
EDIT2, EDIT3 = "2022-05-15 00:00:00", "2022-06-15 00:00:00"


def _audit(when: str, org: int = 1) -> dict:
    return {
        "is_voided": False, "created_by_id": 1, "last_modified_by_id": 2, "created_date_time": when,
        "last_modified_date_time": when, "organisation_id": org,
    }


REGISTRATION = (
    '{"c-num": 12.25, "c-one": "a-alpha", "c-many": ["a-delta", "a-kappa"], "c-date": "2022-04-04T18:30:00.000Z",'
    ' "c-time": "10:30", "c-text": "Mill Lane", "c-dur": "P3Y9M", "c-grp": {"c-in1": "value 1", "c-in2": "value 2"},'
    ' "c-photo": "http://m.example.com/org/one.jpg", "c-rep": [{"c-coin": 100, "c-place": "North gate"}, {"c-coin": 7, "c-place": "B"}]}'
)

CLINIC = {
    "subject_type": [
        dict(id=1, uuid="st-person", name="Person", type="Person", organisation_id=1, allow_middle_name=True, sync_registration_concept_1="c-text"),
        dict(id=2, uuid="st-house", name="House", type="Household", organisation_id=1, allow_middle_name=False),
        dict(id=3, uuid="st-worker", name="Worker", type="User", organisation_id=1, allow_middle_name=False),
    ],
    "operational_subject_type": [dict(id=i, subject_type_id=i, name=n) for i, n in ((1, "Person"), (2, "House"), (3, "Worker"))],
    "program": [dict(id=1, uuid="p-nut", name="Nutrition", organisation_id=1)],
    "operational_program": [dict(id=1, program_id=1, name="Nutrition")],
    "encounter_type": [dict(id=1, uuid="et-visit", name="Visit"), dict(id=2, uuid="et-weigh", name="Weigh")],
    "operational_encounter_type": [dict(id=1, encounter_type_id=1, name="Visit"), dict(id=2, encounter_type_id=2, name="Weigh")],
    "gender": [dict(id=1, name="Female"), dict(id=2, name="Male")],
    "group_role": [
        dict(id=1, role="Head of household", group_subject_type_id=2, member_subject_type_id=1),
        dict(id=2, role="Member", group_subject_type_id=2, member_subject_type_id=1),
    ],
    "concept": [
        dict(id=i, uuid=u, name=n, data_type=t, is_voided=False)
        for i, (u, n, t) in enumerate(
            [
                ("c-num", "Weight", "Numeric"), ("c-one", "Choice", "Coded"), ("c-many", "Choices", "Coded"), ("c-date", "Day", "Date"),
                ("c-time", "Clock", "Time"), ("c-text", "Ward", "Text"), ("c-dur", "Age", "Duration"), ("c-grp", "Parent", "QuestionGroup"),
                ("c-in1", "Child 1", "Text"), ("c-in2", "Child 2", "Text"), ("c-photo", "Photo", "Image"), ("c-rep", "Wallet", "QuestionGroup"),
                ("c-coin", "Barley", "Numeric"), ("c-place", "Market", "Text"), ("c-why", "Reason", "Text"), ("c-image", "Picture", "ImageV2"),
                ("c-rule", "Risk", "Coded"), ("a-alpha", "Alpha", "NA"), ("a-delta", "Delta", "NA"), ("a-kappa", "Kappa", "NA"), ("c-terrain", "Terrain", "Text"),
            ],
            1,
        )
    ],
    "concept_answer": [dict(concept_id=2, answer_concept_id=18), dict(concept_id=3, answer_concept_id=19), dict(concept_id=3, answer_concept_id=20)],
    "form": [
        dict(id=1, uuid="f-reg", form_type="IndividualProfile", is_voided=False),
        dict(id=2, uuid="f-visit", form_type="Encounter", is_voided=False),
        dict(id=3, uuid="f-cancel", form_type="IndividualEncounterCancellation", is_voided=False),
        dict(id=4, uuid="f-enrol", form_type="ProgramEnrolment", is_voided=False),
        dict(id=5, uuid="f-exit", form_type="ProgramExit", is_voided=False),
        dict(id=6, uuid="f-weigh", form_type="ProgramEncounter", is_voided=False),
        dict(id=7, uuid="f-house", form_type="IndividualProfile", is_voided=False),
        dict(id=8, uuid="f-place", form_type="Location", is_voided=False),
    ],
    "form_element_group": [dict(id=i, form_id=i, is_voided=False) for i in range(1, 9)],
    "form_element": [
        dict(id=i, form_element_group_id=g, concept_id=c, group_id=p, type=t, key_values=k, is_voided=False)
        for i, (g, c, p, t, k) in enumerate(
            [
                (1, 1, None, "SingleSelect", None), (1, 2, None, "SingleSelect", None), (1, 3, None, "MultiSelect", None), (1, 4, None, "SingleSelect", None),
                (1, 5, None, "SingleSelect", None), (1, 6, None, "SingleSelect", None), (1, 7, None, "SingleSelect", None), (1, 8, None, "SingleSelect", None),
                (1, 9, 8, "SingleSelect", None), (1, 10, 8, "SingleSelect", None), (1, 11, None, "SingleSelect", None),
                (1, 12, None, "SingleSelect", '[{"key":"repeatable","value":true}]'), (1, 13, 12, "SingleSelect", None), (1, 14, 12, "SingleSelect", None),
                (2, 1, None, "SingleSelect", None), (2, 3, None, "MultiSelect", None), (2, 16, None, "SingleSelect", None), (3, 15, None, "SingleSelect", None),
                (4, 1, None, "SingleSelect", None), (5, 15, None, "SingleSelect", None), (6, 1, None, "SingleSelect", None), (8, 21, None, "SingleSelect", None),
            ],
            1,
        )
    ],
    "non_applicable_form_element": [],
    "decision_concept": [dict(concept_id=17, form_id=6)],
    "form_mapping": [
        dict(id=1, uuid="fm-1", form_id=1, subject_type_id=1, is_voided=False),
        dict(id=2, uuid="fm-2", form_id=2, subject_type_id=1, observations_type_entity_id=1, is_voided=False),
        dict(id=3, uuid="fm-3", form_id=3, subject_type_id=1, observations_type_entity_id=1, is_voided=False),
        dict(id=4, uuid="fm-4", form_id=4, subject_type_id=1, entity_id=1, is_voided=False),
        dict(id=5, uuid="fm-5", form_id=5, subject_type_id=1, entity_id=1, is_voided=False),
        dict(id=6, uuid="fm-6", form_id=6, subject_type_id=1, entity_id=1, observations_type_entity_id=2, is_voided=False),
        dict(id=7, uuid="fm-7", form_id=7, subject_type_id=2, is_voided=False),
    ],
    "address_level_type": [
        dict(id=1, name="District", is_voided=False, organisation_id=1),
        dict(id=2, name="Block", parent_id=1, is_voided=False, organisation_id=1),
        dict(id=3, name="Village", parent_id=2, is_voided=False, organisation_id=1),
    ],
    "address_level": [
        dict(id=i, uuid=f"ad-{i}", title=t, type_id=k, parent_id=p, location_properties='{"c-terrain": "hill"}', gps_coordinates=(1.0, 2.0), **_audit(D1))
        for i, t, k, p in ((1, "D1", 1, None), (2, "B1", 2, 1), (3, "V1", 3, 2), (4, "V2", 3, 2), (5, "B2", 2, 1), (6, "V3", 3, 5))
    ],
    "individual": [
        dict(id=1, uuid="i-1", first_name="Asha", middle_name="M", last_name="Rao", subject_type_id=1, gender_id=1, address_id=3, registration_date="2022-03-01",
             date_of_birth="1990-01-01", observations=REGISTRATION, **_audit(D1)),
        dict(id=2, uuid="i-2", first_name="Bela", last_name=None, subject_type_id=1, gender_id=2, address_id=4, registration_date="2022-03-02",
             date_of_birth="1991-01-01", observations='{"c-text": "east"}', **_audit(D2)),
        dict(id=3, uuid="i-3", first_name="House", last_name=None, subject_type_id=2, address_id=3, registration_date="2022-03-02", observations="{}", **_audit(D1)),
        dict(id=4, uuid="i-4", first_name="Chand", last_name="W", subject_type_id=3, address_id=3, registration_date="2022-03-02", observations="{}", **_audit(D1)),
        dict(id=5, uuid="i-5", first_name="Other", last_name="Tenant", subject_type_id=1, address_id=3, registration_date="2022-03-02",
             observations='{"c-text": "west"}', **_audit(D1, org=2)),
    ],
    "encounter": [
        dict(id=1, uuid="e-1", name="v1", individual_id=1, encounter_type_id=1, address_id=3, encounter_date_time=D2, earliest_visit_date_time=D1, max_visit_date_time=D3,
             observations='{"c-num": 3, "c-many": ["a-delta", "a-kappa"], "c-image": [{"uri": "http://m.example.com/org/a.png"}, {"uri": "http://m.example.com/org/b.png"}]}', **_audit(D2)),
        dict(id=2, uuid="e-2", name="v2", individual_id=2, encounter_type_id=1, address_id=4, cancel_date_time=D3, earliest_visit_date_time=D1, max_visit_date_time=D2,
             observations="{}", cancel_observations='{"c-why": "moved"}', **_audit(D3)),
        dict(id=3, uuid="e-3", name="v3", individual_id=2, encounter_type_id=1, address_id=4, earliest_visit_date_time=D1, max_visit_date_time=D2, observations="{}", **_audit(D1)),
    ],
    "program_enrolment": [
        dict(id=1, uuid="n-1", individual_id=1, program_id=1, address_id=3, enrolment_date_time=D1, observations='{"c-num": 5}', **_audit(D1)),
        dict(id=2, uuid="n-2", individual_id=2, program_id=1, address_id=4, enrolment_date_time=D1, program_exit_date_time=D3, observations='{"c-num": 6}',
             program_exit_observations='{"c-why": "cured"}', **_audit(D3)),
    ],
    "program_encounter": [
        dict(id=1, uuid="pe-1", name="w1", program_enrolment_id=1, individual_id=1, encounter_type_id=2, address_id=3, encounter_date_time=D2,
             observations='{"c-num": 8.5, "c-rule": "a-alpha"}', **_audit(D2)),
    ],
    "subject_program_eligibility": [],
    "group_subject": [
        dict(id=1, uuid="g-1", group_subject_id=3, member_subject_id=1, group_role_id=1, **_audit(D1)),
        dict(id=2, uuid="g-2", group_subject_id=3, member_subject_id=2, group_role_id=2, **_audit(D1)),
    ],
    "users": [dict(id=i, uuid=f"u-{i}", username=f"user{i}", **_audit(D1)) for i in (1, 2)],
    "user_subject": [dict(user_id=1, subject_id=4), dict(user_id=2, subject_id=1)],
    "sync_telemetry": [dict(id=1, uuid="t-1", user_id=1, sync_status="complete", sync_start_time=D1, sync_end_time=D2, **{k: v for k, v in _audit(D1).items() if k != "is_voided"})],
    "entity_approval_status": [dict(id=1, uuid="ea-1", entity_id=1, entity_type="Subject", approval_status_id=3, is_voided=False, status_date_time=D1)],
    "approval_status": [dict(id=1, status="Pending"), dict(id=2, status="Approved"), dict(id=3, status="Rejected")],
    "answer_concept_migration": [],
}


def clinic() -> dict[str, list[dict]]:
    return deepcopy(CLINIC)


def audit(when: str, org: int = 1) -> dict:
    return _audit(when, org)


def find(rows: list[dict], **match) -> dict:
    return next(r for r in rows if all(r[k] == v for k, v in match.items()))


def tables(spark, data: dict[str, list[dict]]) -> dict:
    """The clinic as DataFrames."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    out = {}
    for name, ddl in SCHEMAS.items():
        schema = T._parse_datatype_string(ddl)
        text = T.StructType(
            [T.StructField(f.name, T.StringType() if isinstance(f.dataType, (T.TimestampType, T.DateType)) else f.dataType) for f in schema]
        )
        rows = [{f.name: r.get(f.name) for f in text} for r in data[name]]
        for r in rows:  # points are given as pairs
            r.update({k: dict(zip("xy", v)) for k, v in r.items() if isinstance(v, tuple)})
        df = spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(text)))
        out[name] = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
    return out
