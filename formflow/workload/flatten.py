"""Observation, entity, repeat-group and address operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.bindings import bound, context, with_bindings
from formflow.functions import obs
from formflow.model import ColumnSpec, answer_column
from formflow.operators import address, entities, repeat
from formflow.workload.common import (
    ANSWERS, GROUP, HOUSEHOLD, INDIVIDUAL, PERSON, REASON, REPEAT_ANSWERS, WARD, WINDOW, answers_sql, cols,
    encounter_spec, enrolment_spec, in_window, js, named, plain, program_encounter_spec, spec, ward_sql,
)

QUERIES, ORACLE = {}, {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return add


# --- answers -------------------------------------------------------------------
def _obs(name: str, sql: str, build):
    """One observation operator over every general visit."""

    def run(spark, sf_dir):
        rows = bound(spark, sf_dir, "encounter")
        pairs = obs.concept_map(
            bound(spark, sf_dir, "concept"), bound(spark, sf_dir, "concept_answer"), ["q-one", "q-many"]
        )
        rows = obs.with_dictionary(rows.withColumn("_o", obs.parse_obs(rows, "observations")), pairs)
        return plain(rows.select("id", build(F.col("_o"), F.col("answer_map")).alias("answer")))

    QUERIES[name] = run
    ORACLE[name] = with_bindings(["encounter"], f"select e.id, {sql} as answer from encounter e")


_E = "e.observations"
_obs(
    "o1_coded_many",
    f"list_aggregate(list_filter(list_transform(json_extract_string({_E}, '$.\"q-many\"[*]'), lambda x: {named('x')}), lambda x: x is not null), 'string_agg', ', ')",
    lambda o, m: obs.coded(o, obs.obs_path("q-many"), m),
)
_obs("o1_coded_one", named(js(_E, "q-one")), lambda o, m: obs.coded(o, obs.obs_path("q-one"), m))
_obs(
    "o3_date",
    f"cast(cast(substr({js(_E, 'q-date')}, 1, 19) as timestamp) + interval '330' minute as date)",
    lambda o, m: obs.obs_date(o, obs.obs_path("q-date")),
)
_obs(
    "o4_datetime",
    f"cast(substr({js(_E, 'q-date')}, 1, 19) as timestamp) + interval '330' minute",
    lambda o, m: obs.obs_datetime(o, obs.obs_path("q-date")),
)
_obs("o5_time", f"{js(_E, 'q-time')} || ':00'", lambda o, m: obs.obs_time(o, obs.obs_path("q-time")))
_obs("o6_numeric", f"cast({js(_E, 'q-num')} as double)", lambda o, m: obs.obs_numeric(o, obs.obs_path("q-num")))
_obs("o7_ref", js(_E, "q-ref"), lambda o, m: obs.obs_ref(o, obs.obs_path("q-ref")))
_obs(
    "o8_json",
    f"'[{{\"n\":' || json_extract_string({_E}, '$.\"q-image\"[0].n') || ',\"uri\":\"' || json_extract_string({_E}, '$.\"q-image\"[0].uri') || '\"}}]'",
    lambda o, m: obs.obs_json(o, obs.obs_path("q-image")),
)
_obs("o9_text", js(_E, "q-text"), lambda o, m: obs.obs_text(o, obs.obs_path("q-text")))
_obs("o10_group_path", js(_E, "q-grp", "c1"), lambda o, m: obs.obs_text(o, obs.obs_path("c1", "q-grp")))


@query(
    "o2_concept_map",
    with_bindings(
        ["m_concept"],
        """select a.uuid as answer_uuid, min(a.name) as answer_name
           from (select distinct l_partkey as concept_id, (l_partkey * 7 + l_suppkey) % 150 as answer_concept_id from lineitem) ca
           join m_concept q on q.id = ca.concept_id join m_concept a on a.id = ca.answer_concept_id
           where q.data_type = 'Coded' and q.name like '%#1%' group by a.uuid""",
    ),
)
def _concept_map(spark, sf_dir):
    concept = bound(spark, sf_dir, "m_concept")
    pairs = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_partkey").alias("concept_id"), ((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 150).alias("answer_concept_id")
    ).distinct()
    # the questions of one form: a handful of names, as a plan would hold them
    coded = concept.where((F.col("data_type") == "Coded") & F.col("name").like("%#1%"))
    one = obs.concept_map_of(concept, pairs, coded)
    return one.select(F.explode("answer_map").alias("answer_uuid", "answer_name"))


@query(
    "o11_sync_attr",
    with_bindings(
        ["encounter", "individual"],
        f"select e.id, {js('i.observations', 'q-sync')} as ward from encounter e join individual i on i.id = e.individual_id",
    ),
)
def _sync_attr(spark, sf_dir):
    ctx = context(spark, sf_dir)
    rows = entities.place(ctx, "encounter", ctx.table("encounter").select("id", "individual_id"), [WARD])
    return rows.select("id", obs.sync_attr(WARD).alias("ward"))


# --- entities ------------------------------------------------------------------
def _flat(name: str, spec_, sql: str, *names: str):
    QUERIES[name] = lambda spark, sf_dir: plain(entities.flatten(context(spark, sf_dir, **WINDOW), spec_))
    ORACLE[name] = with_bindings(names, sql)


_flat(
    "e1_individual",
    INDIVIDUAL,
    f"""select {cols('e', entities.SUBJECT_COLUMNS)}, {answers_sql()}
        from individual e join subject_type st on st.id = e.subject_type_id
        where st.uuid = 'st-individual' and {in_window('e')}""",
    "individual", "subject_type",
)
_flat(
    "e1_household",
    HOUSEHOLD,
    f"""select {cols('e', entities.SUBJECT_COLUMNS)}, {answers_sql()}
        from individual e join subject_type st on st.id = e.subject_type_id
        where st.uuid = 'st-household' and {in_window('e')}""",
    "individual", "subject_type",
)
_flat(
    "e2_person",
    PERSON.with_columns(ColumnSpec("middle_name", "text")),
    f"""select {cols('e', entities.SUBJECT_COLUMNS)}, g.name as gender, e.date_of_birth, e.date_of_birth_verified, e.middle_name,
               {answers_sql()}, {ward_sql('e.observations')}
        from individual e join subject_type st on st.id = e.subject_type_id left join gender g on g.id = e.gender_id
        where st.uuid = 'st-person' and {in_window('e')}""",
    "individual", "subject_type", "gender",
)
_flat(
    "e3_encounter",
    encounter_spec(),
    f"""select {cols('e', entities.VISIT_COLUMNS)}, {answers_sql()}, {ward_sql('i.observations')}
        from encounter e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
        join encounter_type et on et.id = e.encounter_type_id
        where st.uuid = 'st-person' and et.uuid = 'et-2' and {in_window('e')}""",
    "encounter", "individual", "subject_type", "encounter_type",
)
_flat(
    "e4_encounter_cancel",
    encounter_spec(type_="IndividualEncounterCancellation", answers=(REASON, WARD)),
    f"""select {cols('e', entities.VISIT_COLUMNS)}, {js('e.cancel_observations', 'q-why')} as "Reason", {ward_sql('i.observations')}
        from encounter e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
        join encounter_type et on et.id = e.encounter_type_id
        where st.uuid = 'st-person' and et.uuid = 'et-2' and e.cancel_date_time is not null and {in_window('e')}""",
    "encounter", "individual", "subject_type", "encounter_type",
)
_flat(
    "e5_enrolment",
    enrolment_spec(),
    f"""select {cols('e', entities.ENROLMENT_COLUMNS)}, {answers_sql()}, {ward_sql('i.observations')}
        from program_enrolment e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
        join program p on p.id = e.program_id
        where st.uuid = 'st-person' and p.uuid = 'p-2' and {in_window('e')}""",
    "program_enrolment", "individual", "subject_type", "program",
)
_flat(
    "e6_exit",
    enrolment_spec(type_="ProgramExit", answers=(REASON, WARD)),
    f"""select {cols('e', entities.ENROLMENT_COLUMNS)}, {js('e.program_exit_observations', 'q-why')} as "Reason", {ward_sql('i.observations')}
        from program_enrolment e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
        join program p on p.id = e.program_id
        where st.uuid = 'st-person' and p.uuid = 'p-2' and e.program_exit_date_time is not null and {in_window('e')}""",
    "program_enrolment", "individual", "subject_type", "program",
)
_PROGRAM_VISIT = """from program_encounter e join program_enrolment n on n.id = e.program_enrolment_id
        join individual i on i.id = n.individual_id join subject_type st on st.id = i.subject_type_id
        join encounter_type et on et.id = e.encounter_type_id join program p on p.id = n.program_id
        where st.uuid = 'st-person' and et.uuid = 'et-3' and p.uuid = 'p-2'"""
_PROGRAM_NAMES = ("program_encounter", "program_enrolment", "individual", "subject_type", "encounter_type", "program")
_flat(
    "e7_program_encounter",
    program_encounter_spec(),
    f"""select {cols('e', entities.PROGRAM_VISIT_COLUMNS)}, {answers_sql()}, {ward_sql('i.observations')}
        {_PROGRAM_VISIT} and {in_window('e')}""",
    *_PROGRAM_NAMES,
)
_flat(
    "e8_program_encounter_cancel",
    program_encounter_spec(type_="ProgramEncounterCancellation", answers=(REASON, WARD)),
    f"""select {cols('e', entities.PROGRAM_VISIT_COLUMNS)}, {js('e.cancel_observations', 'q-why')} as "Reason", {ward_sql('i.observations')}
        {_PROGRAM_VISIT} and e.cancel_date_time is not null and {in_window('e')}""",
    *_PROGRAM_NAMES,
)
_flat(
    "e9_eligibility",
    spec("ManualProgramEnrolmentEligibility", "st-person", "p-2", answers=ANSWERS),
    f"""select {cols('e', entities.ELIGIBILITY_COLUMNS)}, {answers_sql()}
        from subject_program_eligibility e join individual i on i.id = e.subject_id join subject_type st on st.id = i.subject_type_id
        where st.uuid = 'st-person' and {in_window('e')}""",
    "subject_program_eligibility", "individual", "subject_type",
)
_EDGE_NAMES = ("group_subject", "group_role", "individual", "subject_type")
_flat(
    "e10_group_members",
    spec("GroupToMember", group_subject_type_uuid="st-group", member_subject_type_uuid="st-person"),
    f"""select {cols('gs', entities.EDGE_COLUMNS)}, g.id as group_subject_id, m.id as member_subject_id, r.role
        from group_subject gs join individual m on m.id = gs.member_subject_id join individual g on g.id = gs.group_subject_id
        join subject_type mt on mt.id = m.subject_type_id and mt.type in ('Person', 'Individual')
        join subject_type gt on gt.id = g.subject_type_id
        join group_role r on r.id = gs.group_role_id and r.member_subject_type_id = m.subject_type_id
             and r.group_subject_type_id = g.subject_type_id
        where mt.uuid = 'st-person' and gt.uuid = 'st-group' and {in_window('gs')}""",
    *_EDGE_NAMES,
)
_flat(
    "e11_household_members",
    spec("HouseholdToMember", group_subject_type_uuid="st-household", member_subject_type_uuid="st-person"),
    f"""select distinct {cols('gs', [c for c in entities.EDGE_COLUMNS if c != 'last_modified_date_time'])},
               greatest(gs.last_modified_date_time, h.last_modified_date_time) as last_modified_date_time,
               g.id as group_subject_id, m.id as member_subject_id, r.role, h.member_subject_id as "Head of household ID"
        from group_subject gs join individual m on m.id = gs.member_subject_id join individual g on g.id = gs.group_subject_id
        join subject_type mt on mt.id = m.subject_type_id and mt.type = 'Person'
        join subject_type gt on gt.id = g.subject_type_id
        join group_role r on r.id = gs.group_role_id and r.member_subject_type_id = m.subject_type_id
             and r.group_subject_type_id = g.subject_type_id
        join group_subject h on h.group_subject_id = g.id and not h.is_voided
        left join group_role hr on hr.id = h.group_role_id
        where mt.uuid = 'st-person' and gt.uuid = 'st-household' and (hr.role = 'Head of household' or hr.role is null)
          and (({in_window('gs')}) or ({in_window('h')}))""",
    *_EDGE_NAMES,
)


@query(
    "e12_users",
    with_bindings(["users"], f"select {cols('u', entities.USER_COLUMNS)} from users u where u.last_modified_date_time > timestamp '1995-07-01 00:00:00' and u.last_modified_date_time <= timestamp '1996-03-01 00:00:00'"),
)
def _users(spark, sf_dir):
    return entities.copy_users(context(spark, sf_dir, start="1995-07-01 00:00:00", end="1996-03-01 00:00:00"))


@query(
    "e13_telemetry",
    with_bindings(
        ["sync_telemetry"],
        f"""select {cols('t', entities.TELEMETRY_COLUMNS)} from sync_telemetry t
            where t.last_modified_date_time > timestamp '2024-01-05 00:00:00' and t.last_modified_date_time <= timestamp '2024-01-20 00:00:00'""",
    ),
)
def _telemetry(spark, sf_dir):
    return entities.copy_telemetry(context(spark, sf_dir, start="2024-01-05 00:00:00", end="2024-01-20 00:00:00"))


_USER_SUBJECTS = f"""select {', '.join('us.user_id' if c == 'user_id' else 'i.' + c for c in entities.USER_SUBJECT_COLUMNS)}
        from individual i join user_subject us on us.subject_id = i.id
        where not i.is_voided"""


def _user_subjects(compat):
    def run(spark, sf_dir):
        ctx = context(spark, sf_dir)
        # links of voided subjects are in the table already
        voided = ctx.table("individual").where("is_voided").select("id")
        links = ctx.table("user_subject").select("user_id", F.col("subject_id").alias("id"))
        existing = links.join(voided, "id", "left_semi")
        table = spec("UserSubject", "st-user")
        return entities.user_subjects(ctx, existing, table, compat)

    return run


QUERIES["e14_user_subjects"] = _user_subjects(False)
ORACLE["e14_user_subjects"] = with_bindings(["individual", "user_subject"], _USER_SUBJECTS + " and i.subject_type_id = 5")
QUERIES["e14_user_subjects_compat"] = _user_subjects(True)
ORACLE["e14_user_subjects_compat"] = with_bindings(["individual", "user_subject"], _USER_SUBJECTS)


# --- repeat groups -----------------------------------------------------------------
_TAIL = ("address_id", "is_voided", "organisation_id", "last_modified_date_time")
_ELEMENT = "json_extract(e.observations, '$.\"q-rep\"[' || cast(x.i as varchar) || ']')"


def _repeat_sql(keys: str, frm: str) -> str:
    doc = _ELEMENT
    return f"""select {keys}, {cols('e', _TAIL)}, x.i as repeatable_question_group_index,
           cast(json_extract_string({doc}, '$.qty') as double) as "Quantity",
           case json_extract_string({doc}, '$.ex') when 'a1' then 'Beta' when 'a2' then 'Gamma' end as "Exchange",
           json_extract_string({doc}, '$.pic') as "Picture"
        {frm} and {in_window('e')}
          and x.i < coalesce(json_array_length(e.observations, '$."q-rep"'), 0)"""


# no list in the data has more than two elements
_INDEX = "cross join (values (cast(0 as bigint)), (cast(1 as bigint)), (cast(2 as bigint))) as x(i)"
_REPEAT_SPEC = {"answers": REPEAT_ANSWERS, "repeat_uuid": "q-rep"}


def _rep(name, spec_, sql, *names):
    QUERIES[name] = lambda spark, sf_dir: plain(repeat.repeat_group(context(spark, sf_dir, **WINDOW), spec_))
    ORACLE[name] = with_bindings(names, sql)


_rep(
    "g1_repeat_subject",
    spec("RepeatableQuestionGroup", "st-person", **_REPEAT_SPEC),
    _repeat_sql("e.id as individual_id", f"from individual e join subject_type st on st.id = e.subject_type_id {_INDEX} where st.uuid = 'st-person'"),
    "individual", "subject_type",
)
_rep(
    "g2_repeat_encounter",
    spec("RepeatableQuestionGroup", "st-person", None, "et-2", **_REPEAT_SPEC),
    _repeat_sql(
        "e.individual_id, e.id as encounter_id",
        f"""from encounter e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
            join encounter_type et on et.id = e.encounter_type_id {_INDEX}
            where st.uuid = 'st-person' and et.uuid = 'et-2' and e.cancel_date_time is null""",
    ),
    "encounter", "individual", "subject_type", "encounter_type",
)
_rep(
    "g3_repeat_enrolment",
    spec("RepeatableQuestionGroup", "st-person", "p-2", **_REPEAT_SPEC),
    _repeat_sql(
        "e.individual_id, e.id as program_enrolment_id",
        f"""from program_enrolment e join individual i on i.id = e.individual_id join subject_type st on st.id = i.subject_type_id
            join program p on p.id = e.program_id {_INDEX} where st.uuid = 'st-person' and p.uuid = 'p-2'""",
    ),
    "program_enrolment", "individual", "subject_type", "program",
)
_rep(
    "g4_repeat_program_encounter",
    spec("RepeatableQuestionGroup", "st-person", "p-2", "et-3", **_REPEAT_SPEC),
    _repeat_sql(
        "n.individual_id, e.program_enrolment_id, e.id as program_encounter_id",
        _PROGRAM_VISIT.replace("where", f"{_INDEX} where") + " and e.cancel_date_time is null",
    ),
    *_PROGRAM_NAMES,
)


@query(
    "g5_explode_group",
    with_bindings(
        ["encounter"],
        f"""select e.id, x.i as repeatable_question_group_index, json_extract_string({_ELEMENT}, '$.qty') as qty
            from encounter e {_INDEX} where x.i < coalesce(json_array_length(e.observations, '$."q-rep"'), 0)""",
    ),
)
def _explode(spark, sf_dir):
    rows = bound(spark, sf_dir, "encounter").select("id", "observations")
    out = repeat.explode_group(rows, "observations", "q-rep")
    return out.select("id", "repeatable_question_group_index", F.variant_get("observations", "$.qty", "string").alias("qty"))


# --- addresses -----------------------------------------------------------------------
_ADDRESS = spec("Address", answers=(answer_column("Terrain", 19, "Text", "q-loc"),))
_OWN = ", ".join(
    f"""case when a.type_id = {i} then a.title end as "{n}", case when a.type_id = {i} then a.id end as "{n} id" """
    for i, n in ((1, "Region"), (2, "Nation"), (3, "Site"))
)


def _address(spark, sf_dir):
    t = lambda n: bound(spark, sf_dir, n)
    return address.address_rows(t("address_level"), t("address_level_type"), _ADDRESS, t("concept"), t("concept_answer"))


@query(
    "a1_address_rows",
    with_bindings(
        ["address_level"],
        f"select {_OWN}, {cols('a', address.ADDRESS_COLUMNS)}, {js('a.location_properties', 'q-loc')} as \"Terrain\" from address_level a",
    ),
)
def _address_rows(spark, sf_dir):
    return _address(spark, sf_dir)


ADDRESS_SQL = """select case when a.type_id = 3 then a.title end as "Site", case when a.type_id = 3 then a.id end as "Site id",
       case a.type_id when 3 then n.title when 2 then a.title end as "Nation", case a.type_id when 3 then n.id when 2 then a.id end as "Nation id",
       coalesce(r.title, case when n.id is null then a.title end) as "Region",
       coalesce(r.id, case when n.id is null then a.id end) as "Region id", a.id, a.uuid, a.is_voided
    from address_level a left join address_level n on n.id = a.parent_id
    left join address_level r on r.id = case a.type_id when 3 then n.parent_id when 2 then a.parent_id end"""


def wide_address(spark, sf_dir):
    t = lambda n: bound(spark, sf_dir, n)
    rows = address.address_rows(t("address_level"), t("address_level_type"))
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c in ("id", "uuid", "is_voided") or c.split(" ")[0] in ("Region", "Nation", "Site")])
    return address.propagate_parents(rows, t("address_level"), t("address_level_type"))


QUERIES["a2_propagate_parents"] = wide_address
ORACLE["a2_propagate_parents"] = with_bindings(["address_level"], ADDRESS_SQL)
QUERIES["e1_group"] = lambda spark, sf_dir: plain(entities.flatten(context(spark, sf_dir, **WINDOW), GROUP))
ORACLE["e1_group"] = with_bindings(
    ["individual", "subject_type"],
    f"""select {cols('e', entities.SUBJECT_COLUMNS)}, cast({js('e.observations', 'q-num')} as double) as "Amount",
               {named(js('e.observations', 'q-one'))} as "One",
               list_aggregate(list_filter(list_transform(json_extract_string(e.observations, '$."q-many"[*]'), lambda x: {named('x')}), lambda x: x is not null), 'string_agg', ', ') as "Many"
        from individual e join subject_type st on st.id = e.subject_type_id where st.uuid = 'st-group' and {in_window('e')}""",
)
