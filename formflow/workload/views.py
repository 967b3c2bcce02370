"""Reporting views over flat tables made by the flatten operators."""

from __future__ import annotations

from itertools import product

from formflow.bindings import Bound, bound, with_bindings
from formflow.functions import obs
from formflow.operators import families, views
from formflow.sources.tables import Context
from formflow.workload.common import (
    ANSWERS, encounter_spec, enrolment_spec, js, named, program_encounter_spec, spec,
)
from formflow.workload.flatten import ADDRESS_SQL, wide_address
from pyspark.sql import functions as F

QUERIES, ORACLE = {}, {}
LEVELS = ["Region", "Nation", "Site"]
_LEVEL_SQL = ', '.join(f'a."{c}"' for c in LEVELS)
AS_OF = "1998-06-01"


KINDS, PROGRAMS = range(1, 6), range(1, 6)
#: The subject types by id; those of users have no registration form.
TYPES = {1: "Person", 2: "Individual", 3: "Household", 4: "Group", 5: "User"}
SUBJECTS = [spec(kind, f"st-{kind.lower()}") for kind in TYPES.values() if kind != "User"]


def _each(make, *ids, **how):
    """A table for every subject type and every choice of the other types."""
    return [make(*chosen, subject=f"st-{kind.lower()}", answers=(), **how) for kind in TYPES.values() for chosen in product(*ids)]


ENCOUNTERS = _each(encounter_spec, KINDS)
ENROLMENTS = _each(enrolment_spec, PROGRAMS)
PROGRAM_ENCOUNTERS = _each(program_encounter_spec, KINDS, PROGRAMS)
VISITS = [
    *ENCOUNTERS,
    *_each(encounter_spec, KINDS, type_="IndividualEncounterCancellation"),
    *PROGRAM_ENCOUNTERS,
    *_each(program_encounter_spec, KINDS, PROGRAMS, type_="ProgramEncounterCancellation"),
]


def family_rows(spark, sf_dir, specs):
    """All rows of the tables of ``specs``, tagged; one scan of each source."""
    return families.scans(Context(Bound(spark, sf_dir)), specs)


def _subjects(spark, sf_dir):
    return views.subject_view(
        family_rows(spark, sf_dir, SUBJECTS), bound(spark, sf_dir, "users"), bound(spark, sf_dir, "subject_type"),
        wide_address(spark, sf_dir), LEVELS, org_ids=[1, 2],
    )


QUERIES["v1_subject_view"] = _subjects
ORACLE["v1_subject_view"] = with_bindings(
    ["individual", "subject_type", "users", "gender", "address_level"],
    f"""with address as ({ADDRESS_SQL})
        select i.id as individual_id, i.uuid as individual_uuid, i.first_name, case when st.type = 'Person' then i.date_of_birth end as date_of_birth,
               i.last_name, case when st.type = 'Person' then g.name end as gender, i.registration_date, i.created_date_time,
               i.last_modified_date_time, i.is_voided, st.uuid as subject_type_uuid, i.address_id, cu.username as created_by_username,
               mu.username as last_modified_by_username, st.name as subject_type, {_LEVEL_SQL}
        from individual i join subject_type st on st.id = i.subject_type_id left join gender g on g.id = i.gender_id
        left join users cu on cu.id = i.created_by_id left join users mu on mu.id = i.last_modified_by_id
        join address a on a.id = i.address_id
        where not i.is_voided and st.type in ('Person', 'Individual', 'Household', 'Group') and st.organisation_id in (1, 2)""",
)


def _enrolments(spark, sf_dir):
    return views.enrolment_view(
        family_rows(spark, sf_dir, ENROLMENTS), bound(spark, sf_dir, "users"), bound(spark, sf_dir, "program"),
        bound(spark, sf_dir, "individual"), wide_address(spark, sf_dir), LEVELS, org_ids=[1],
    )


QUERIES["v2_enrolment_view"] = _enrolments
ORACLE["v2_enrolment_view"] = with_bindings(
    ["program_enrolment", "individual", "subject_type", "program", "users", "address_level"],
    f"""with address as ({ADDRESS_SQL})
        select e.id as enrolment_id, e.uuid as enrolment_uuid, p.uuid as program_uuid, e.individual_id, e.enrolment_date_time,
               e.created_date_time, e.last_modified_date_time, e.is_voided, e.program_exit_date_time, e.address_id,
               cu.username as created_by_username, mu.username as last_modified_by_username, p.name as program_name,
               i.uuid as individual_uuid, i.first_name, i.last_name, {_LEVEL_SQL}
        from program_enrolment e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
        join program p on p.id = e.program_id left join users cu on cu.id = e.created_by_id left join users mu on mu.id = e.last_modified_by_id
        join address a on a.id = e.address_id
        where not e.is_voided and p.organisation_id in (1)""",
)

_VISIT_COLUMNS = "id, uuid, name, individual_id, encounter_type_id, encounter_date_time, cancel_date_time, is_voided, earliest_visit_date_time, max_visit_date_time, created_date_time, last_modified_date_time, address_id, created_by_id, last_modified_by_id, filled_by_id"
_COLUMNS = ", ".join("e." + c for c in _VISIT_COLUMNS.split(", "))
# a cancelled visit is in two tables: that of its kind and that of the cancellations
_VISIT_UNION = f"""
   select {_COLUMNS} from encounter e join individual i on i.id = e.individual_id
   union all
   select {_COLUMNS} from encounter e join individual i on i.id = e.individual_id where e.cancel_date_time is not null
   union all
   select {_COLUMNS} from program_encounter e join program_enrolment n on n.id = e.program_enrolment_id join individual i on i.id = n.individual_id
   union all
   select {_COLUMNS} from program_encounter e join program_enrolment n on n.id = e.program_enrolment_id join individual i on i.id = n.individual_id
   where e.cancel_date_time is not null
"""


def _visit_sql(where: str) -> str:
    return with_bindings(
        ["encounter", "program_encounter", "program_enrolment", "individual", "encounter_type", "users", "address_level"],
        f"""with address as ({ADDRESS_SQL}), visits as ({_VISIT_UNION})
            select v.id, v.uuid, v.name, v.individual_id, et.uuid as encounter_type_uuid, v.encounter_date_time, v.cancel_date_time, v.is_voided,
                   v.earliest_visit_date_time, v.max_visit_date_time, v.created_date_time, v.last_modified_date_time, v.address_id,
                   cu.username as created_by_username, mu.username as last_modified_by_username, fu.username as filled_by_username,
                   i.uuid as individual_uuid, i.first_name, i.last_name, et.name as encounter_type_name, {_LEVEL_SQL}
            from visits v join individual i on i.id = v.individual_id join encounter_type et on et.id = v.encounter_type_id
            join address a on a.id = v.address_id left join users cu on cu.id = v.created_by_id
            left join users mu on mu.id = v.last_modified_by_id left join users fu on fu.id = v.filled_by_id
            where not v.is_voided and {where}""",
    )


def _visits(fn, *more):
    def run(spark, sf_dir):
        t = lambda n: bound(spark, sf_dir, n)
        return fn(
            family_rows(spark, sf_dir, VISITS), t("users"), t("individual"), t("encounter_type"), wide_address(spark, sf_dir), LEVELS, *more
        )

    return run


QUERIES["v3_due_visits"] = _visits(views.due_visits, AS_OF)
ORACLE["v3_due_visits"] = _visit_sql(f"v.earliest_visit_date_time < timestamp '{AS_OF} 00:00:00' and timestamp '{AS_OF} 00:00:00' < v.max_visit_date_time")
QUERIES["v4_completed_visits"] = _visits(views.completed_visits)
ORACLE["v4_completed_visits"] = _visit_sql("v.encounter_date_time is not null and v.cancel_date_time is null")
QUERIES["v5_overdue_visits"] = _visits(views.overdue_visits, AS_OF)
ORACLE["v5_overdue_visits"] = _visit_sql(
    f"timestamp '{AS_OF} 00:00:00' > v.max_visit_date_time and v.encounter_date_time is null and v.cancel_date_time is null"
)


def _coded(spark, sf_dir):
    rows = bound(spark, sf_dir, "encounter")
    names = obs.concept_map(bound(spark, sf_dir, "concept"), bound(spark, sf_dir, "concept_answer"), ["q-one", "q-many"])
    flat = obs.project_answers(rows, ANSWERS[1:3], "observations", names, ["id", "is_voided", "last_modified_date_time"])
    return views.coded_view(flat, ANSWERS[1:3])


_MANY = f"""list_filter(list_transform(json_extract_string(observations, '$."q-many"[*]'), lambda x: {named('x')}), lambda x: x is not null)"""
QUERIES["v6_coded_view"] = _coded
ORACLE["v6_coded_view"] = with_bindings(
    ["encounter"],
    f"""select id, is_voided, last_modified_date_time, '2' as concept_id, 'q-one' as concept_uuid, 'One' as concept_name, '' as parent_concept_uuid,
               '' as parent_concept_name, answer from (select *, {named(js('observations', 'q-one'))} as answer from encounter)
        where not is_voided and answer is not null
        union all
        select id, is_voided, last_modified_date_time, '3', 'q-many', 'Many', '', '', unnest({_MANY}) from encounter where not is_voided""",
)


def _individual_address(spark, sf_dir):
    t = lambda n: bound(spark, sf_dir, n)
    address = wide_address(spark, sf_dir).withColumnsRenamed({"id": "address_id", "uuid": "address_uuid", "is_voided": "address_is_voided"})
    address = address.withColumn("id", F.col("address_id")).drop("address_id")
    return views.individual_address(t("individual"), t("subject_type"), t("gender"), address)


QUERIES["v7_individual_address"] = _individual_address
ORACLE["v7_individual_address"] = with_bindings(
    ["individual", "subject_type", "gender", "address_level"],
    f"""with address as ({ADDRESS_SQL})
        select i.id as individual_id, st.name as subject_type, i.uuid as individual_uuid, i.first_name, i.last_name, i.middle_name, i.date_of_birth,
               g.name as gender, i.registration_date as individual_registration_date, i.created_date_time as individual_created_date_time,
               i.last_modified_date_time as individual_last_modified_date_time, a."Region", a."Region id", a."Nation", a."Nation id", a."Site",
               a."Site id", a.id, a.uuid as address_uuid, a.is_voided as address_is_voided
        from individual i join subject_type st on st.id = i.subject_type_id join address a on a.id = i.address_id left join gender g on g.id = i.gender_id""",
)


def _enrolment_address(spark, sf_dir):
    t = lambda n: bound(spark, sf_dir, n)
    return views.enrolment_address(t("individual"), t("program_enrolment"), t("program"), wide_address(spark, sf_dir))


QUERIES["v8_enrolment_address"] = _enrolment_address
ORACLE["v8_enrolment_address"] = with_bindings(
    ["individual", "program_enrolment", "program", "address_level"],
    """select e.id as enrolment_id, e.uuid as enrolment_uuid, p.name as program_name, i.id as individual_id, i.uuid as individual_uuid,
              i.first_name, i.last_name, e.enrolment_date_time, e.created_date_time as enrolment_created_date_time,
              e.last_modified_date_time as enrolment_last_modified_date_time
       from individual i join program_enrolment e on e.individual_id = i.id join program p on p.id = e.program_id
       join address_level a on a.id = i.address_id""",
)
