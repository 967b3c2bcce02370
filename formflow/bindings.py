"""Source tables of the data model, bound to the driver's test tables.

The SQL is plain enough to run unchanged in Spark SQL and in an SQL oracle.
``$name`` stands for a test table: a Parquet path in Spark, a view elsewhere.
Everything that grows comes from a test table; only the few type names and
dictionary entries are literal rows.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

from formflow.sources.tables import Context

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_VISIT_JSON = """
       '{"q-num":' || cast($key % 100 as varchar(20)) || '.5,"q-one":"a' || cast($key % 5 as varchar(20))
         || '","q-many":["a1","a' || cast($key % 4 as varchar(20)) || '"],"q-date":"2022-04-04T18:30:00.000Z"'
         || ',"q-time":"0' || cast($key % 10 as varchar(20)) || ':15","q-text":"note ' || cast($key % 13 as varchar(20))
         || '","q-ref":"sub-' || cast($key % 50 as varchar(20)) || '","q-grp":{"c1":"v' || cast($key % 7 as varchar(20))
         || '","c2":' || cast($key % 9 as varchar(20)) || '}'
         || case $key % 5 when 0 then ''
                when 1 then ',"q-photo":"http://m.example.com/org/p' || cast($key as varchar(20)) || '.jpg"'
                when 2 then ',"q-photo":["http://m.example.com/org/p' || cast($key as varchar(20)) || '.jpg","http://m.example.com/org/s.jpg"]'
                else ',"q-photo":null' end
         || case $key % 3 when 0 then ''
                else ',"q-image":[{"uri":"http://m.example.com/org/i' || cast($key as varchar(20)) || '.png","n":' || cast($key % 3 as varchar(20)) || '}]' end
         || case $key % 4 when 0 then '' when 1 then ',"q-rep":[]'
                when 2 then ',"q-rep":[{"qty":' || cast($key % 50 as varchar(20)) || ',"ex":"a1","pic":"http://m.example.com/org/r' || cast($key as varchar(20)) || '.jpg"}]'
                else ',"q-rep":[{"qty":1,"ex":"a2"},{"qty":2,"ex":"a9","pic":"[' || chr(92) || '"http://m.example.com/org/r1.jpg' || chr(92) || '"]"}]' end || '}'
"""


def _visit_json(key: str) -> str:
    return _VISIT_JSON.replace("$key", key).strip()


BINDINGS = {
    # --- small fixed dictionaries --------------------------------------------
    "subject_type": """
select * from (values
  (1, 'st-person', 'Person', 'Person', 1, 'q-sync', cast(null as varchar(20)), true),
  (2, 'st-individual', 'Beneficiary', 'Individual', 1, cast(null as varchar(20)), 'q-one', false),
  (3, 'st-household', 'Household', 'Household', 2, cast(null as varchar(20)), cast(null as varchar(20)), false),
  (4, 'st-group', 'Self Help Group', 'Group', 3, cast(null as varchar(20)), cast(null as varchar(20)), false),
  (5, 'st-user', 'Field Worker', 'User', 1, cast(null as varchar(20)), cast(null as varchar(20)), false))
  as t(id, uuid, name, type, organisation_id, sync_registration_concept_1, sync_registration_concept_2, allow_middle_name)""",
    "program": """
select * from (values (1, 'p-1', 'Mother', 1), (2, 'p-2', 'Child', 1), (3, 'p-3', 'Elderly', 2), (4, 'p-4', 'Youth', 2), (5, 'p-5', 'Eye Care', 3))
  as t(id, uuid, name, organisation_id)""",
    "encounter_type": """
select * from (values (1, 'et-1', 'Home Visit'), (2, 'et-2', 'Clinic Visit'), (3, 'et-3', 'Growth'), (4, 'et-4', 'Vaccination'), (5, 'et-5', 'Referral'))
  as t(id, uuid, name)""",
    "gender": "select * from (values (1, 'Female'), (2, 'Male')) as t(id, name)",
    "group_role": """
select * from (values (1, 'Head of household', 3, 1), (2, 'Member', 3, 1), (3, 'Member', 3, 2), (4, 'Leader', 4, 1), (5, 'Member', 4, 1), (6, 'Member', 4, 2))
  as t(id, role, group_subject_type_id, member_subject_type_id)""",
    "concept": """
select * from (values (1, 'q-num', 'Amount', 'Numeric', false), (2, 'q-one', 'One', 'Coded', false), (3, 'q-many', 'Many', 'Coded', false),
  (4, 'q-date', 'Day', 'Date', false), (5, 'q-time', 'Time', 'Time', false), (6, 'q-text', 'Note', 'Text', false), (7, 'q-ref', 'Other', 'Subject', false),
  (8, 'q-grp', 'Group', 'QuestionGroup', false), (9, 'c1', 'Child 1', 'Text', false), (10, 'c2', 'Child 2', 'Numeric', false),
  (11, 'q-rep', 'Repeat', 'QuestionGroup', false), (12, 'qty', 'Quantity', 'Numeric', false), (13, 'ex', 'Exchange', 'Coded', false),
  (14, 'q-why', 'Reason', 'Text', false), (15, 'q-sync', 'Ward', 'Text', false), (16, 'q-photo', 'Photo', 'Image', false),
  (17, 'q-image', 'Image', 'ImageV2', false), (18, 'pic', 'Picture', 'Image', false), (19, 'q-loc', 'Terrain', 'Text', false),
  (20, 'a0', 'Alpha', 'NA', false), (21, 'a1', 'Beta', 'NA', false), (22, 'a2', 'Gamma', 'NA', false), (23, 'a3', 'Delta', 'NA', false))
  as t(id, uuid, name, data_type, is_voided)""",
    "concept_answer": """
select * from (values (2, 20), (2, 21), (2, 22), (2, 23), (3, 20), (3, 21), (3, 22), (3, 23), (13, 21), (13, 22))
  as t(concept_id, answer_concept_id)""",
    "approval_status": "select * from (values (1, 'Pending'), (2, 'Approved'), (3, 'Rejected')) as t(id, status)",
    "address_level_type": """
select * from (values (1, 'Region', cast(null as int), false, 1), (2, 'Nation', 1, false, 1), (3, 'Site', 2, false, 1), (4, 'Old', 1, true, 1))
  as t(id, name, parent_id, is_voided, organisation_id)""",
    # --- entities --------------------------------------------------------------
    "individual": f"""
select c.c_custkey as id, 'sub-' || cast(c.c_custkey as varchar(20)) as uuid, c.c_name as first_name,
       case when c.c_custkey % 6 = 0 then null else c.c_mktsegment end as last_name,
       case when c.c_custkey % 4 = 1 then 'M' || cast(c.c_custkey % 8 as varchar(20)) end as middle_name,
       cast(case when c.c_custkey % 20 = 0 then 3 when c.c_custkey % 20 = 10 then 4 when c.c_custkey % 7 = 3 then 5
                 when c.c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') then 1 else 2 end as bigint) as subject_type_id,
       cast(c.c_custkey % 3 + 1 as bigint) as gender_id,
       cast(c.c_nationkey + 100 as bigint) as address_id,
       cast(c.first_dt as date) as registration_date, cast(null as varchar(20)) as registration_location,
       cast(c.first_dt as date) as date_of_birth, c.c_custkey % 2 = 0 as date_of_birth_verified,
       c.c_custkey % 17 = 0 as is_voided, c.c_custkey % 8 as created_by_id, c.c_custkey % 10 as last_modified_by_id,
       cast(c.c_custkey % 3 + 1 as bigint) as organisation_id, 'l' || cast(c.c_custkey as varchar(20)) as legacy_id,
       c.first_dt as created_date_time, c.last_dt as last_modified_date_time,
       '{{"q-sync":"ward ' || cast(c.c_custkey % 11 as varchar(20)) || '",' || substr({_visit_json('c.c_custkey')}, 2) as observations
from (select c.*, coalesce(o.first_dt, cast('1995-01-01 00:00:00' as timestamp) + interval '1' day * cast(c.c_custkey % 1000 as int)) as first_dt,
             coalesce(o.last_dt, cast('1996-01-01 00:00:00' as timestamp) + interval '1' day * cast(c.c_custkey % 1000 as int)) as last_dt
      from $customer c left join (select o_custkey, min(o_orderdate) as first_dt, max(o_orderdate) as last_dt
                                  from $orders group by o_custkey) o on o.o_custkey = c.c_custkey) c""",
    "encounter": f"""
select o_orderkey as id, 'enc-' || cast(o_orderkey as varchar(20)) as uuid, 'Visit ' || cast(o_orderkey % 3 as varchar(20)) as name,
       o_custkey as individual_id, cast(substr(o_orderpriority, 1, 1) as bigint) as encounter_type_id,
       cast(o_orderkey % 25 + 100 as bigint) as address_id,
       case when o_orderkey % 3 = 0 then null else o_orderdate - interval '7' day end as earliest_visit_date_time,
       o_orderdate + interval '1' day * cast(case when o_orderkey % 10 < 3 then 1 else 7 end as int) as max_visit_date_time,
       case when o_orderstatus = 'F' then o_orderdate + interval '1' day * cast(o_orderkey % 15 as int) end as encounter_date_time,
       case when o_orderstatus = 'P' then o_orderdate + interval '3' day end as cancel_date_time,
       cast(null as varchar(20)) as encounter_location, cast(null as varchar(20)) as cancel_location,
       o_orderkey % 19 = 0 as is_voided, o_orderkey % 8 as created_by_id, o_orderkey % 10 as last_modified_by_id,
       case when o_orderkey % 4 = 0 then null else o_orderkey % 6 end as filled_by_id,
       o_orderdate as created_date_time, o_orderdate as last_modified_date_time,
       cast(o_orderkey % 3 + 1 as bigint) as organisation_id, cast(null as varchar(20)) as legacy_id,
       {_visit_json('o_orderkey')} as observations,
       '{{"q-why":"r' || cast(o_orderkey % 3 as varchar(20)) || '"}}' as cancel_observations
from $orders""",
    "program_enrolment": f"""
select o_orderkey as id, 'enr-' || cast(o_orderkey as varchar(20)) as uuid, o_custkey as individual_id,
       cast(substr(o_orderpriority, 1, 1) as bigint) as program_id, cast(o_orderkey % 25 + 100 as bigint) as address_id,
       case when o_orderkey % 26 = 0 then null else o_orderdate end as enrolment_date_time,
       case when o_orderstatus = 'F' then o_orderdate + interval '90' day end as program_exit_date_time,
       cast(null as varchar(20)) as enrolment_location, cast(null as varchar(20)) as exit_location,
       o_orderkey % 23 = 0 as is_voided, o_orderkey % 8 as created_by_id, o_orderkey % 10 as last_modified_by_id,
       o_orderdate as created_date_time, o_orderdate as last_modified_date_time,
       cast(o_orderkey % 3 + 1 as bigint) as organisation_id, cast(null as varchar(20)) as legacy_id,
       {_visit_json('o_orderkey')} as observations,
       '{{"q-why":"x' || cast(o_orderkey % 5 as varchar(20)) || '"}}' as program_exit_observations
from $orders""",
    "program_encounter": f"""
select l.l_orderkey * 10 + l.l_linenumber as id, 'pen-' || cast(l.l_orderkey * 10 + l.l_linenumber as varchar(20)) as uuid,
       'Check ' || cast(l.l_linenumber as varchar(20)) as name, l.l_orderkey as program_enrolment_id, o.o_custkey as individual_id,
       cast(l.l_suppkey % 5 + 1 as bigint) as encounter_type_id, cast(l.l_partkey % 25 + 100 as bigint) as address_id,
       case when l.l_partkey % 3 = 0 then null else l.l_shipdate - interval '4' day end as earliest_visit_date_time,
       l.l_shipdate + interval '1' day * cast(l.l_partkey % 5 - 2 - case when l.l_suppkey % 10 < 4 then 2 else 0 end as int) as max_visit_date_time,
       case when l.l_linestatus = 'F' or l.l_partkey % 4 = 0 then l.l_shipdate end as encounter_date_time,
       case when l.l_linestatus = 'O' and l.l_partkey % 9 = 0 then l.l_shipdate end as cancel_date_time,
       cast(null as varchar(20)) as encounter_location, cast(null as varchar(20)) as cancel_location,
       l.l_partkey % 29 = 0 as is_voided, l.l_suppkey % 8 as created_by_id, l.l_suppkey % 10 as last_modified_by_id,
       l.l_suppkey % 6 as filled_by_id, l.l_shipdate - interval '5' day as created_date_time,
       l.l_shipdate as last_modified_date_time, cast(l.l_suppkey % 3 + 1 as bigint) as organisation_id,
       cast(null as varchar(20)) as legacy_id, l.l_partkey as tie_1, l.l_suppkey as tie_2, l.l_extendedprice as tie_3,
       {_visit_json('l.l_partkey')} as observations,
       '{{"q-why":"c' || cast(l.l_partkey % 3 as varchar(20)) || '"}}' as cancel_observations
from $lineitem l join $orders o on o.o_orderkey = l.l_orderkey""",
    "subject_program_eligibility": f"""
select o_orderkey as id, 'elg-' || cast(o_orderkey as varchar(20)) as uuid, o_custkey as subject_id,
       cast(substr(o_orderpriority, 1, 1) as bigint) as program_id, o_orderstatus = 'O' as is_eligible,
       o_orderdate as check_date, o_orderkey % 19 = 0 as is_voided, o_orderkey % 8 as created_by_id,
       o_orderkey % 10 as last_modified_by_id, o_orderdate as created_date_time, o_orderdate as last_modified_date_time,
       cast(o_orderkey % 3 + 1 as bigint) as organisation_id, {_visit_json('o_orderkey')} as observations
from $orders""",
    "group_subject": """
select c.c_custkey as id, 'gs-' || cast(c.c_custkey as varchar(20)) as uuid, c.c_custkey - c.c_custkey % 10 as group_subject_id,
       c.c_custkey as member_subject_id,
       cast(case when c.c_custkey % 20 < 10 then case when c.c_custkey % 10 in (1, 2) then 1
                   when c.c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') then 2 else 3 end
                 else case when c.c_custkey % 10 = 1 then 4
                   when c.c_mktsegment in ('AUTOMOBILE', 'BUILDING', 'FURNITURE') then 5 else 6 end end as bigint) as group_role_id,
       c.c_custkey % 13 = 0 as is_voided, c.c_custkey % 8 as created_by_id, c.c_custkey % 10 as last_modified_by_id,
       c.first_dt as created_date_time, c.last_dt as last_modified_date_time,
       cast(c.c_custkey % 3 + 1 as bigint) as organisation_id
from (select c.*, coalesce(o.first_dt, cast('1995-01-01 00:00:00' as timestamp) + interval '1' day * cast(c.c_custkey % 1000 as int)) as first_dt,
             coalesce(o.last_dt, cast('1996-01-01 00:00:00' as timestamp) + interval '1' day * cast(c.c_custkey % 1000 as int)) as last_dt
      from $customer c left join (select o_custkey, min(o_orderdate) as first_dt, max(o_orderdate) as last_dt
                                  from $orders group by o_custkey) o on o.o_custkey = c.c_custkey) c
where c.c_custkey % 10 <> 0""",
    "users": """
select s_suppkey as id, 'usr-' || cast(s_suppkey as varchar(20)) as uuid,
       case when s_suppkey % 4 = 0 then null else s_name end as name,
       'u' || cast(s_suppkey as varchar(20)) as username,
       case when s_suppkey % 5 = 4 then null else s_suppkey % 7 = 6 end as is_voided,
       case when s_suppkey % 9 = 8 then null else cast(s_suppkey % 3 + 1 as bigint) end as organisation_id,
       cast(1 as bigint) as created_by_id, cast(1 as bigint) as last_modified_by_id,
       cast('1995-01-01 00:00:00' as timestamp) + interval '1' day * cast(s_suppkey % 1000 as int) as created_date_time,
       cast('1996-01-01 00:00:00' as timestamp) + interval '1' day * cast(s_suppkey % 1000 as int) as last_modified_date_time,
       cast(s_nationkey as bigint) as catchment_id, 'u' || cast(s_suppkey as varchar(20)) || '@example.com' as email,
       cast(null as varchar(20)) as phone_number
from $supplier""",
    "user_subject": """
select c_custkey % 10 as user_id, c_custkey as subject_id from $customer""",
    "sync_telemetry": """
select event_id as id, 'tel-' || cast(event_id as varchar(20)) as uuid, user_id % 10 as user_id,
       (user_id + 1) % 10 as last_modified_by_id, user_id % 10 as created_by_id,
       cast(user_id % 3 + 1 as bigint) as organisation_id,
       case when event_type = 'error' then 'incomplete' else 'complete' end as sync_status,
       ts as sync_start_time,
       case when event_id % 31 = 0 then null else ts + interval '1' second * cast(floor(value) as int) end as sync_end_time,
       'v' || cast(user_id % 5 as varchar(20)) as app_version, 'd' || cast(event_id % 7 as varchar(20)) as device_name,
       'a' || cast(event_id % 4 as varchar(20)) as android_version, props as device_info,
       case when event_id % 2 = 0 then 'manual' else 'automatic' end as sync_source,
       ts as created_date_time, ts as last_modified_date_time
from $events""",
    "entity_approval_status": """
select o_orderkey as id, case when o_orderkey % 2 = 0 then o_custkey else o_orderkey - o_orderkey % 8 end as entity_id,
       case when o_orderkey % 2 = 0 then 'Subject' else 'Encounter' end as entity_type, o_orderdate as status_date_time,
       cast(case o_orderstatus when 'F' then 2 when 'P' then 1 else 3 end as bigint) as approval_status_id,
       o_orderkey % 13 = 0 as is_voided
from $orders""",
    "address_level": """
select cast(r_regionkey + 1 as bigint) as id, 'adr-' || cast(r_regionkey + 1 as varchar(20)) as uuid, r_name as title,
       cast(1 as bigint) as type_id, cast(null as bigint) as parent_id, false as is_voided, cast(1 as bigint) as created_by_id,
       cast(1 as bigint) as last_modified_by_id, cast('1995-01-01 00:00:00' as timestamp) as created_date_time,
       cast('1995-01-01 00:00:00' as timestamp) as last_modified_date_time, cast(1 as bigint) as organisation_id,
       cast(null as varchar(20)) as gps_coordinates, '{"q-loc":"plain"}' as location_properties
from $region
union all
select cast(n_nationkey + 100 as bigint), 'adr-' || cast(n_nationkey + 100 as varchar(20)), n_name, cast(2 as bigint),
       cast(n_regionkey + 1 as bigint), n_nationkey % 9 = 8, cast(1 as bigint), cast(1 as bigint), cast('1995-02-01 00:00:00' as timestamp),
       cast('1995-02-01 00:00:00' as timestamp), cast(1 as bigint), cast(null as varchar(20)), '{"q-loc":"hill"}'
from $nation
union all
select cast(s_suppkey + 1000 as bigint), 'adr-' || cast(s_suppkey + 1000 as varchar(20)), s_name, cast(3 as bigint),
       cast(s_nationkey + 100 as bigint), s_suppkey % 9 = 8, cast(1 as bigint), cast(1 as bigint), cast('1995-03-01 00:00:00' as timestamp),
       cast('1995-03-01 00:00:00' as timestamp), cast(1 as bigint), cast(null as varchar(20)),
       '{"q-loc":"t' || cast(s_suppkey % 4 as varchar(20)) || '"}'
from $supplier""",
    # --- media ------------------------------------------------------------------
    "media_form": """
select page_id as id, 'ent-' || cast(page_id as varchar(20)) as uuid, page_id % 5 = 4 as is_voided,
       cast(1 as bigint) as created_by_id, page_id % 10 as last_modified_by_id,
       cast('2024-01-01 00:00:00' as timestamp) + interval '1' hour * cast(page_id % 700 as int) as created_date_time,
       cast('2024-02-01 00:00:00' as timestamp) + interval '1' hour * cast(page_id % 900 as int) as last_modified_date_time,
       cast(page_id % 3 + 1 as bigint) as organisation_id,
       case when page_id % 40 = 7 then null else cast(page_id % 25 + 100 as bigint) end as address_id,
       page_id % 100 as individual_id, 'ward ' || cast(page_id % 4 as varchar(20)) as ward,
       case page_id % 3 when 0 then url when 1 then '["' || url || '","' || url || '&n=2"]' end as photo,
       case page_id % 4 when 0 then '[{"uri":"' || url || '"},{"uri":"' || url || '&n=3"}]' when 1 then '["' || url || '"]'
            when 2 then url end as image,
       page_id % 6 as repeatable_question_group_index
from $pages""",
    "media_keys": """
select 'org/' || case when page_id % 6 = 1 then 'thumbnails/' when page_id % 50 = 2 then 'Adhoc/' else '' end || '00000000-0000-4000-8000-'
       || lpad(cast(page_id as varchar(20)), 12, '0') || '.jpg' as object_key
from $pages where page_id % 4 <> 0
union all
select 'org/thumbnails/00000000-0000-4000-8000-' || lpad(cast(page_id as varchar(20)), 12, '0') || '.jpg' from $pages where page_id % 4 = 1
union all
select 'org/notes' || cast(page_id as varchar(20)) || '.txt' from $pages where page_id % 20 = 3""",
    "stored_media": """
select 'ent-' || cast(page_id - page_id % 2 * case when page_id % 8 = 1 then 1 else 0 end as varchar(20)) as uuid, page_id as entity_id,
       page_id % 5 = 4 as is_voided, 'concept-' || cast(page_id % 3 as varchar(20)) as concept_name,
       case when page_id % 7 = 6 then 'http://elsewhere.example.com/x/' else 'http://m.example.com/org/' end || '00000000-0000-4000-8000-'
         || lpad(cast(page_id - page_id % 2 * case when page_id % 8 = 1 then 1 else 0 end as varchar(20)), 12, '0') || '.jpg' as image_url,
       cast('2024-01-01 00:00:00' as timestamp) + interval '1' hour * cast(page_id % 700 as int) as created_date_time,
       page_id % 25 + 100 as address_id
from $pages""",
    # --- form metadata, at the size of the catalogue tables ------------------------
    "m_concept": """
select p_partkey as id, 'mc-' || cast(p_partkey as varchar(20)) as uuid, p_brand || ' ' || cast(p_partkey % 40 as varchar(20)) as name,
       case p_size % 6 when 0 then 'Coded' when 1 then 'Numeric' when 2 then 'Text' when 3 then 'Date' when 4 then 'QuestionGroup' else 'ImageV2' end as data_type,
       p_partkey % 23 = 0 as is_voided
from $part""",
    "m_form": """
select s_suppkey as id, 'mf-' || cast(s_suppkey as varchar(20)) as uuid,
       case s_suppkey % 5 when 0 then 'IndividualProfile' when 1 then 'Encounter' when 2 then 'ProgramEnrolment' when 3 then 'ProgramEncounter'
            else 'Location' end as form_type,
       s_suppkey % 11 = 10 as is_voided
from $supplier""",
    "m_form_element_group": """
select s_suppkey * 2 as id, s_suppkey as form_id, false as is_voided from $supplier
union all
select s_suppkey * 2 + 1, s_suppkey, s_suppkey % 17 = 16 from $supplier""",
    "m_form_element": """
select e.l_suppkey * 1000000 + e.l_partkey as id, e.l_suppkey * 2 + e.l_partkey % 2 as form_element_group_id, e.l_partkey as concept_id,
       case when e.l_partkey % 3 = 0 and e.l_partkey <> g.first_part then e.l_suppkey * 1000000 + g.first_part end as group_id,
       case when e.l_partkey % 2 = 0 then 'SingleSelect' else 'MultiSelect' end as type,
       case e.l_partkey % 4 when 0 then '[{"key":"repeatable","value":true}]' when 1 then '[{"key":"repeatable","value":false}]'
            when 2 then '[{"key":"other","value":"true"}]' end as key_values,
       e.l_partkey % 19 = 0 as is_voided
from (select distinct l_suppkey, l_partkey from $lineitem) e
join (select l_suppkey, l_partkey % 8 as part_group, min(l_partkey) as first_part from $lineitem group by l_suppkey, l_partkey % 8) g
  on g.l_suppkey = e.l_suppkey and g.part_group = e.l_partkey % 8""",
    "m_non_applicable_form_element": """
select distinct l_suppkey * 1000000 + l_partkey as form_element_id from $lineitem where l_partkey % 29 = 0""",
    "m_decision_concept": """
select distinct l_partkey as concept_id, l_suppkey as form_id from $lineitem where l_partkey % 37 = 0""",
    "m_form_mapping": """
select s_suppkey as id, 'fm-' || cast(s_suppkey as varchar(20)) as uuid, s_suppkey as form_id, cast(s_suppkey % 7 % 5 + 1 as bigint) as subject_type_id,
       cast(case when s_suppkey % 5 in (2, 3) then s_suppkey % 4 + 2 end as bigint) as entity_id,
       cast(case when s_suppkey % 5 in (1, 3) then s_suppkey % 3 + 3 end as bigint) as observations_type_entity_id,
       s_suppkey % 13 = 12 as is_voided
from $supplier""",
    "m_subject_type": """
select t.id, t.uuid, t.name, t.type, t.allow_middle_name,
  (select 'mc-' || cast(min(l_partkey) as varchar(20)) from $lineitem where l_suppkey % 5 = 0) as sync_registration_concept_1,
  (select 'mc-' || cast(max(l_partkey) as varchar(20)) from $lineitem where l_suppkey % 5 = 0) as sync_registration_concept_2
from (values (1, 'st-person', 'Person', 'Person', true), (2, 'st-individual', 'Beneficiary', 'Individual', false),
  (3, 'st-household', 'Household', 'Household', false), (4, 'st-group', 'Self Help Group', 'Group', false), (5, 'st-user', 'Field Worker', 'User', false),
  (6, 'st-volunteer', 'Volunteer', 'User', false)) as t(id, uuid, name, type, allow_middle_name)""",
    "m_operational_subject_type": """
select * from (values (1, 'Person'), (2, 'Beneficiary'), (3, 'Household'), (4, 'Self Help Group'), (5, 'Field Worker'), (6, 'Volunteer')) as t(subject_type_id, name)""",
    "m_operational_program": "select * from (values (1, 2, 'Child'), (2, 3, 'Elderly'), (3, 4, 'Youth')) as t(id, program_id, name)",
    "m_operational_encounter_type": "select * from (values (1, 3, 'Growth'), (2, 4, 'Vaccination')) as t(id, encounter_type_id, name)",
}

# Where an operator expects a name that differs from the binding's.
METADATA = {
    "concept": "m_concept",
    "form": "m_form",
    "form_element_group": "m_form_element_group",
    "form_element": "m_form_element",
    "non_applicable_form_element": "m_non_applicable_form_element",
    "decision_concept": "m_decision_concept",
    "form_mapping": "m_form_mapping",
    "subject_type": "m_subject_type",
    "operational_subject_type": "m_operational_subject_type",
    "operational_program": "m_operational_program",
    "operational_encounter_type": "m_operational_encounter_type",
    "program": "program",
    "encounter_type": "encounter_type",
    "group_role": "group_role",
    "address_level_type": "address_level_type",
}


def spark_binding(name: str, root: str) -> str:
    tables = {t: f"parquet.`{root.rstrip('/')}/{t}.parquet`" for t in TEST_TABLES}
    return Template(BINDINGS[name]).substitute(tables)


def oracle_binding(name: str) -> str:
    return Template(BINDINGS[name]).substitute({t: t for t in TEST_TABLES})


def bound(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.sql(spark_binding(name, root))


class Bound(dict):
    """Bindings as a mapping from table name to DataFrame, made on demand."""

    def __init__(self, spark: SparkSession, root: str, names: dict[str, str] | None = None):
        super().__init__()
        self._spark, self._root, self._names = spark, root, names or {}

    def __missing__(self, name: str) -> DataFrame:
        self[name] = bound(self._spark, self._root, self._names.get(name, name))
        return self[name]


def context(spark: SparkSession, root: str, **how) -> Context:
    return Context(Bound(spark, root), **how)


def metadata(spark: SparkSession, root: str) -> Bound:
    return Bound(spark, root, METADATA)


def with_bindings(names: tuple[str, ...] | list[str], sql: str) -> str:
    """Oracle SQL with the named bindings as leading CTEs."""
    parts = [f"{name} as ({oracle_binding(name).strip()})" for name in names]
    sql = sql.strip()
    if sql[:5].lower() == "with ":
        return "with " + ",\n".join(parts) + ",\n" + sql[5:]
    return "with " + ",\n".join(parts) + "\n" + sql
