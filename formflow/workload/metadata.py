"""Spec derivation and evolution, over metadata bound to catalogue tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from formflow.bindings import bound, metadata, with_bindings
from formflow.plans import catalog, evolve
from formflow.plans.evolve import Change
from formflow.workload.state import fresh_store

QUERIES, ORACLE = {}, {}

_NAMES = [
    "m_form_mapping", "m_form", "m_subject_type", "m_operational_subject_type", "program", "m_operational_program", "encounter_type",
    "m_operational_encounter_type", "m_form_element_group", "m_form_element", "m_concept", "m_non_applicable_form_element",
]
_FORMS = """with usage as (
    select link.uuid as mapping, form.id as form_key, form.uuid as form_uuid, form.form_type as kind, subject.uuid as subject_uuid,
        subject.type as subject_kind, subject.allow_middle_name as middle, label.name as subject_label, plan.uuid as plan_uuid,
        plan_label.name as plan_name, visit.uuid as visit_uuid, visit_label.name as visit_name
    from m_form_mapping link, m_form form, m_subject_type subject, m_operational_subject_type label
    left join program plan on plan.id = link.entity_id
    left join m_operational_program plan_label on plan_label.program_id = plan.id
    left join encounter_type visit on visit.id = link.observations_type_entity_id
    left join m_operational_encounter_type visit_label on visit_label.encounter_type_id = visit.id
    where form.id = link.form_id and subject.id = link.subject_type_id and label.subject_type_id = subject.id and not link.is_voided
      and (plan.id is null) = (plan_label.id is null) and (visit.id is null) = (visit_label.id is null)
), live as (
    select *, coalesce(contains(key_values, '"repeatable","value":true'), false) as repeats from m_form_element where not is_voided
), questions as (
    select section.form_id as form_key, live.concept_id, live.type, holder.concept_id as holder_concept, holder.type as holder_type,
        coalesce(holder.repeats, false) as repeats
    from live join m_form_element_group section on section.id = live.form_element_group_id left join live holder on holder.id = live.group_id
    where not exists (select 1 from m_non_applicable_form_element off where off.form_element_id = live.id)
), has_questions as (
    select distinct section.form_id as form_key from live join m_form_element_group section on section.id = live.form_element_group_id
)"""


def _form_select(kind: str, parent_kind: str, holder_uuid: str, repeat: str) -> str:
    """Table rows with their structs spread out."""
    answer = "case {0}.data_type when 'Coded' then {1} else {0}.data_type end"
    columns = {
        "mapping": "u.mapping", "form": "u.form_uuid", "kind": kind, "parent_kind": parent_kind, "subject_uuid": "u.subject_uuid",
        "subject_type": "u.subject_kind", "subject_label": "u.subject_label", "subject_middle": "u.middle", "program_uuid": "u.plan_uuid",
        "program_name": "u.plan_name", "visit_uuid": "u.visit_uuid", "visit_name": "u.visit_name", "repeat_uuid": repeat,
        "question_id": "own.id", "question_uuid": "own.uuid", "question_name": "own.name", "question_voided": "own.is_voided",
        "question_answer": answer.format("own", "q.type"), "holder_id": "outer_one.id", "holder_uuid": holder_uuid,
        "holder_name": "outer_one.name", "holder_answer": answer.format("outer_one", "q.holder_type"),
    }
    return "select " + ", ".join(f"{value} as {name}" for name, value in columns.items())


def _spread(rows):
    columns = {"subject_middle": "subject.allow_middle_name"}
    columns |= {f"subject_{c}": f"subject.{c}" for c in ("uuid", "type", "label")} | {"repeat_uuid": "repeat.uuid"}
    columns |= {f"{side}_{c}": f"{side}.{c}" for side in ("program", "visit") for c in ("uuid", "name")}
    columns |= {f"question_{c}": f"question.{c}" for c in ("id", "uuid", "name", "voided", "answer")}
    columns |= {f"holder_{c}": f"holder.{c}" for c in ("id", "uuid", "name", "answer")}
    return rows.select("mapping", "form", "kind", "parent_kind", *(F.col(path).alias(name) for name, path in columns.items()))


_NO_TEXT = "cast(null as varchar)"
FORM_SQL = f"""{_FORMS}
{_form_select("u.kind", _NO_TEXT, "outer_one.uuid", _NO_TEXT)}
from usage u left join questions q using (form_key)
left join m_concept own on own.id = q.concept_id and own.data_type <> 'QuestionGroup'
left join m_concept outer_one on outer_one.id = q.holder_concept
where case when q.form_key is null then u.form_key not in (select form_key from has_questions) else not q.repeats end"""
QUERIES["m1_form_specs"] = lambda spark, sf_dir: _spread(catalog.form_specs(metadata(spark, sf_dir)))
# a live form of the data always has live elements, and an element group
# without any gives no row of its own here
ORACLE["m1_form_specs"] = with_bindings(_NAMES, FORM_SQL)

QUERIES["m2_repeat_specs"] = lambda spark, sf_dir: _spread(catalog.repeat_specs(metadata(spark, sf_dir)))
ORACLE["m2_repeat_specs"] = with_bindings(
    _NAMES,
    f"""{_FORMS}
{_form_select("'RepeatableQuestionGroup'", "u.kind", _NO_TEXT, "outer_one.uuid")}
from usage u join questions q using (form_key) left join m_concept own on own.id = q.concept_id
left join m_concept outer_one on outer_one.id = q.holder_concept and outer_one.data_type = 'QuestionGroup'
where q.repeats""",
)

QUERIES["m3_decision_cols"] = lambda spark, sf_dir: catalog.decision_cols(metadata(spark, sf_dir))
ORACLE["m3_decision_cols"] = with_bindings(
    ["m_decision_concept", "m_concept", "m_form"],
    """with decided as (
           select (select uuid from m_form where id = d.form_id) as form, unnest(list(d.concept_id)) as id from m_decision_concept d group by d.form_id
       )
       select form, id, uuid, name, is_voided as voided, if(data_type = 'Coded', 'MultiSelect', data_type) as answer
       from decided join m_concept using (id) where form is not null qualify id = min(id) over (partition by form, name)""",
)

#: Which subject types a live form registers, and each subject type under its operational name.
_REGISTERED = """registered as (
    select distinct subject_type_id as id, form_id from m_form_mapping
    where is_voided = false and form_id in (select id from m_form where form_type = 'IndividualProfile')
), kinds as (
    select id, uuid, type, label from m_subject_type
    join (select subject_type_id as id, name as label from m_operational_subject_type) using (id)
)"""

QUERIES["m4_sync_attr_cols"] = lambda spark, sf_dir: catalog.sync_attr_cols(metadata(spark, sf_dir))
ORACLE["m4_sync_attr_cols"] = with_bindings(
    ["m_form_mapping", "m_subject_type", "m_operational_subject_type", "m_form", "m_form_element_group", "m_form_element", "m_concept"],
    f"""with {_REGISTERED}, roles as (
           select id, unnest([{{'role': 'sync1', 'uuid': sync_registration_concept_1}}, {{'role': 'sync2', 'uuid': sync_registration_concept_2}}], recursive := true)
           from m_subject_type
       ), asked as (
           select form_id, concept_id, type from (select * from m_form_element where is_voided = false)
           join (select id as form_element_group_id, form_id from m_form_element_group where is_voided = false) using (form_element_group_id)
       )
       select role, q.id, q.uuid, q.name, first(q.is_voided) as voided, min(if(q.data_type = 'Coded', asked.type, q.data_type)) as answer
       from registered join roles using (id) join asked using (form_id) join m_concept q on q.id = asked.concept_id
       where q.uuid = roles.uuid group by role, q.id, q.uuid, q.name qualify q.id = min(q.id) over (partition by role, q.name)""",
)

QUERIES["m5_membership_specs"] = lambda spark, sf_dir: catalog.membership_specs(metadata(spark, sf_dir))
ORACLE["m5_membership_specs"] = with_bindings(
    ["m_form_mapping", "m_form", "m_subject_type", "m_operational_subject_type", "group_role"],
    f"""with {_REGISTERED}, pairs as (select distinct group_subject_type_id as whole, member_subject_type_id as part from group_role)
       select distinct if(g.type = 'Group', 'GroupToMember', 'HouseholdToMember') as kind, g.uuid as group_uuid, g.label as "group",
           m.uuid as member_uuid, m.label as member
       from pairs, kinds g, kinds m
       where g.id = whole and m.id = part and g.type in ('Group', 'Household') and whole in (select id from registered)""",
)

QUERIES["m6_address_spec"] = lambda spark, sf_dir: catalog.address_spec_rows(metadata(spark, sf_dir))
ORACLE["m6_address_spec"] = with_bindings(
    ["address_level_type", "m_form", "m_form_element_group", "m_form_element", "m_concept"],
    """with sections as (
           select id from m_form_element_group where form_id in (select id from m_form where form_type = 'Location' and is_voided = false)
       ), asked as (
           select distinct concept_id as id, type from m_form_element where is_voided = false and form_element_group_id in (select id from sections)
       )
       select distinct name, true as level, cast(null as bigint) as id, cast(null as varchar) as uuid, cast(null as varchar) as answer
       from address_level_type where is_voided = false
       union all
       select distinct name, false, id, uuid, if(data_type = 'Coded', asked.type, data_type) from m_concept join asked using (id)""",
)

QUERIES["m7_user_subject_specs"] = lambda spark, sf_dir: catalog.user_subject_specs(metadata(spark, sf_dir))
ORACLE["m7_user_subject_specs"] = with_bindings(
    ["m_form_mapping", "m_form", "m_subject_type", "m_operational_subject_type"],
    f"""with {_REGISTERED} select distinct uuid, label from kinds anti join registered using (id) where type = 'User'""",
)


def _grouped(spark, sf_dir):
    """The tables that ``to_specs`` makes its plans from."""
    rows = catalog.grouped_specs(catalog.form_specs(metadata(spark, sf_dir)))
    names = F.transform("questions", lambda q: F.concat_ws("|", q["title"], q["uuid"], q["holder_uuid"], q["answer"]))
    return rows.select(
        "mapping", "form", "kind", F.col("subject.uuid").alias("subject_uuid"), F.col("program.uuid").alias("program_uuid"),
        F.col("visit.uuid").alias("visit_uuid"), F.array_join(F.array_sort(names), ";").alias("columns"), F.size("questions").alias("column_count"),
    )


QUERIES["m8_grouped_specs"] = _grouped
ORACLE["m8_grouped_specs"] = with_bindings(
    _NAMES,
    f"""with r as ({FORM_SQL}), c as (select distinct mapping, form, kind, subject_uuid, program_uuid, visit_uuid, question_id, holder_id,
             case when question_id is not null then concat_ws('|', case when holder_name is not null then holder_name || ' ' || question_name
             else question_name end, question_uuid, holder_uuid, question_answer) end as col from r)
        select mapping, form, kind, subject_uuid, program_uuid, visit_uuid, coalesce(string_agg(col, ';' order by col), '') as columns,
            cast(count(col) as int) as column_count from c group by all""",
)


# --- diff: the specs of the data against an edited copy ---------------------------
_SPEC = """select 'T-' || mapping as table_name, case when kind = 'IndividualProfile' then 'Person' else kind end as type,
    mapping as subject_type_uuid, program_uuid, visit_uuid as encounter_type_uuid, form as form_uuid, cast(null as {0}) as group_subject_type_uuid,
    cast(null as {0}) as member_subject_type_uuid, cast(null as {0}) as repeat_uuid, question_name || ' ' || cast(question_id as {0}) as column_name,
    case question_answer when 'Numeric' then 'numeric' when 'Date' then 'date' when 'ImageV2' then 'jsonb' else 'text' end as column_type,
    question_id as concept_id, question_answer as concept_type, question_uuid as concept_uuid, holder_uuid as parent_uuid,
    holder_name as parent_name, question_voided as voided from {1} where question_id is not null"""


def _all_specs(spark, sf_dir):
    rows = _spread(catalog.form_specs(metadata(spark, sf_dir)))
    return spark.sql(_SPEC.format("string", "{rows}"), rows=rows)


def _specs(spark, sf_dir):
    return _all_specs(spark, sf_dir).distinct()


def _kept_specs(spark, sf_dir):
    """As ``_specs``, derived once and kept in the shared folder: for plans that read them several times.

    Rows of a table lie together, so that what is kept and what later plans shuffle is small.
    """
    rows = _all_specs(spark, sf_dir).repartition("subject_type_uuid").distinct()
    return fresh_store(spark).stage(rows.sortWithinPartitions("subject_type_uuid", "concept_id"), "specs")


def _edited(old):
    """Some tables and columns renamed, some questions gone, some tables new."""
    key = F.col("concept_id")
    return old.where(key % 11 != 0).select(
        F.when(F.substring("form_uuid", -1, 1) == "1", F.concat(F.lit("R-"), "table_name")).otherwise(F.col("table_name")).alias("table_name"),
        "type",
        F.when(F.substring("form_uuid", -1, 1) == "2", F.concat(F.lit("new-"), "subject_type_uuid")).otherwise(F.col("subject_type_uuid")).alias("subject_type_uuid"),
        *[c for c in old.columns if c not in ("table_name", "type", "subject_type_uuid", "column_name")],
        F.when(key % 7 == 0, F.concat("column_name", F.lit(" new"))).otherwise(F.col("column_name")).alias("column_name"),
    )


def _old(specs):
    """The stored side lacks some questions."""
    return specs.where(F.col("concept_id") % 13 != 0)


def _diff(spark, sf_dir):
    specs = _kept_specs(spark, sf_dir)
    return evolve.diff_rows(_old(specs), _edited(specs))


QUERIES["m9_spec_diff"] = _diff
ORACLE["m9_spec_diff"] = with_bindings(
    _NAMES,
    f"""with r as ({FORM_SQL}), s as (select distinct * from ({_SPEC.format('varchar', 'r')})), o as (select * from s where concept_id % 13 <> 0),
        n as (select * replace (case when right(form_uuid, 1) = '1' then 'R-' || table_name else table_name end as table_name,
                case when right(form_uuid, 1) = '2' then 'new-' || subject_type_uuid else subject_type_uuid end as subject_type_uuid,
                case when concept_id % 7 = 0 then column_name || ' new' else column_name end as column_name) from s where concept_id % 11 <> 0),
        ot as (select distinct type, subject_type_uuid, table_name from o), nt as (select distinct type, subject_type_uuid, table_name from n),
        t as (select ot.table_name as old_name, nt.table_name as new_name, nt.subject_type_uuid, nt.type from nt
              left join ot on ot.type = nt.type and ot.subject_type_uuid = nt.subject_type_uuid),
        both_t as (select * from t where old_name is not null)
        select case when old_name is null then 'create' else 'rename_table' end as kind, coalesce(old_name, new_name) as "table",
               cast(null as varchar) as "column", new_name, cast(null as varchar) as new_type from t where old_name is null or old_name <> new_name
        union all
        select 'void_column', b.new_name, o.column_name, 'voided_' || o.column_name, null from both_t b
          join o on o.type = b.type and o.subject_type_uuid = b.subject_type_uuid and not o.voided
          where not exists (select 1 from n where n.type = o.type and n.subject_type_uuid = o.subject_type_uuid and n.concept_uuid = o.concept_uuid
                            and n.parent_uuid is not distinct from o.parent_uuid)
        union all
        select 'rename_column', b.new_name, o.column_name, n.column_name, null from both_t b
          join o on o.type = b.type and o.subject_type_uuid = b.subject_type_uuid
          join n on n.type = o.type and n.subject_type_uuid = o.subject_type_uuid and n.concept_uuid = o.concept_uuid
               and n.parent_uuid is not distinct from o.parent_uuid where n.column_name <> o.column_name
        union all
        select 'add_column', b.new_name, n.column_name, null, n.column_type from both_t b join n on n.type = b.type and n.subject_type_uuid = b.subject_type_uuid
          where not exists (select 1 from o where o.type = n.type and o.subject_type_uuid = n.subject_type_uuid and n.concept_uuid = o.concept_uuid
                            and n.parent_uuid is not distinct from o.parent_uuid)""",
)

def _merged(spark, sf_dir):
    """The edited specs with the columns that only the stored ones have, per table."""
    specs = _kept_specs(spark, sf_dir)
    place = F.row_number().over(Window.partitionBy("table_name").orderBy("concept_id", "parent_uuid"))
    sides = [
        evolve.specs_of(rows.withColumns({"position": place, "role": F.lit(None).cast("string")})) for rows in (_old(specs), _edited(specs))
    ]
    rows = evolve.spec_rows(spark, evolve.merge_specs(*sides))
    counts = [F.count("column_name").alias("columns"), F.count_if("voided").alias("voided")]
    return rows.groupBy("type", "subject_type_uuid", "table_name").agg(*counts)


QUERIES["m11_merge_specs"] = _merged
ORACLE["m11_merge_specs"] = with_bindings(
    _NAMES,
    f"""with r as ({FORM_SQL}), s as (select distinct * from ({_SPEC.format('varchar', 'r')})), o as (select * from s where concept_id % 13 <> 0),
        n as (select * replace (case when right(form_uuid, 1) = '1' then 'R-' || table_name else table_name end as table_name,
                case when right(form_uuid, 1) = '2' then 'new-' || subject_type_uuid else subject_type_uuid end as subject_type_uuid) from s where concept_id % 11 <> 0),
        gone as (
            select o.type, o.subject_type_uuid, count(*) as n from o
            anti join n on n.type = o.type and n.subject_type_uuid = o.subject_type_uuid and n.concept_uuid = o.concept_uuid
                and n.parent_uuid is not distinct from o.parent_uuid
            group by all
        )
        select type, subject_type_uuid, table_name, count(*) + coalesce(max(gone.n), 0) as columns, count_if(voided) + coalesce(max(gone.n), 0) as voided
        from n left join gone using (type, subject_type_uuid) group by type, subject_type_uuid, table_name""",
)

_CHANGES = [
    Change("rename_column", "t", "name", "uuid"),
    Change("rename_column", "t", "uuid", "name"),
    Change("void_column", "t", "legacy_id", "voided_legacy_id"),
    Change("alter_type", "t", "address_id", None, "text"),
    Change("add_column", "t", "legacy_id", None, "numeric"),
]


def _evolve(spark, sf_dir):
    rows = bound(spark, sf_dir, "encounter").select("id", "uuid", "name", "legacy_id", "address_id")
    return evolve.evolve(rows, _CHANGES).withColumn("legacy_id", F.col("legacy_id").cast("double"))


QUERIES["m10_evolve"] = _evolve
ORACLE["m10_evolve"] = with_bindings(
    ["encounter"],
    """select id, uuid as name, name as uuid, legacy_id as voided_legacy_id, cast(address_id as varchar) as address_id, cast(null as double) as legacy_id
       from encounter""",
)

QUERIES["m12_spec_counts"] = lambda spark, sf_dir: catalog.spec_counts(_specs(spark, sf_dir).select("table_name", "type").distinct())
ORACLE["m12_spec_counts"] = with_bindings(
    _NAMES,
    f"""with r as ({FORM_SQL}), s as ({_SPEC.format('varchar', 'r')}) select type, count(distinct table_name) as tables from s group by type""",
)

QUERIES["m14_type_names"] = lambda spark, sf_dir: catalog.type_names(metadata(spark, sf_dir))
ORACLE["m14_type_names"] = with_bindings(
    ["m_subject_type", "program", "encounter_type", "m_concept"],
    """select 'subject_type' as kind, uuid, name from m_subject_type union all select 'program', uuid, name from program
       union all select 'encounter_type', uuid, name from encounter_type union all select 'concept', uuid, name from m_concept""",
)
QUERIES["m14_sync_concepts"] = lambda spark, sf_dir: catalog.sync_concepts(metadata(spark, sf_dir))
ORACLE["m14_sync_concepts"] = with_bindings(
    ["m_subject_type", "m_concept"],
    """select st.uuid as subject_type_uuid, st.sync_registration_concept_1 as concept1_uuid, c1.name as concept1_name,
              st.sync_registration_concept_2 as concept2_uuid, c2.name as concept2_name
       from m_subject_type st left join m_concept c1 on c1.uuid = st.sync_registration_concept_1
       left join m_concept c2 on c2.uuid = st.sync_registration_concept_2""",
)
