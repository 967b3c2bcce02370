"""Post-load maintenance of flat tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from formflow.bindings import bound, with_bindings
from formflow.operators import maintain
from formflow.operators.media import dedupe_media
from formflow.workload.common import js, named

QUERIES, ORACLE = {}, {}

_U1 = ("id", "program_enrolment_id", "last_modified_date_time", "tie_1", "tie_2", "tie_3", "is_voided")


def _versions(spark, sf_dir):
    return bound(spark, sf_dir, "program_encounter").select(*_U1)


def _keep_latest(spark, sf_dir):
    ties = [F.col(c).desc() for c in ("tie_1", "tie_2", "tie_3")]
    return maintain.keep_latest(_versions(spark, sf_dir), ["id"], "last_modified_date_time", tie_break=ties)


QUERIES["u1_keep_latest"] = _keep_latest
ORACLE["u1_keep_latest"] = with_bindings(
    ["program_encounter"],
    f"""select {', '.join(_U1)} from program_encounter
        qualify row_number() over (partition by id order by last_modified_date_time desc nulls first, tie_1 desc, tie_2 desc, tie_3 desc) = 1""",
)


def _upsert(spark, sf_dir):
    """A change merged into a table: same result as keeping the latest of all."""
    rows = _versions(spark, sf_dir)
    ties = [F.col(c).desc() for c in ("tie_1", "tie_2", "tie_3")]
    cut = "last_modified_date_time < '2001-01-01'"
    old = maintain.keep_latest(rows.where(cut), ["id"], "last_modified_date_time", tie_break=ties)
    fresh = rows.where(f"not ({cut})")
    return maintain.upsert_latest(old, fresh, ["id"], "last_modified_date_time", tie_break=ties)


QUERIES["u1_upsert_latest"] = _upsert
ORACLE["u1_upsert_latest"] = ORACLE["u1_keep_latest"]


def _generations(spark, sf_dir):
    """Repeat groups of two generations: voided rows came back later."""
    rows = bound(spark, sf_dir, "program_encounter").select(
        F.col("program_enrolment_id").alias("encounter_id"), F.col("tie_1").alias("element"), "last_modified_date_time", "is_voided"
    )
    again = rows.where("is_voided").withColumn("last_modified_date_time", F.expr("timestamp_ntz '2002-01-01 00:00:00'"))
    return rows.unionByName(again).drop("is_voided")


def _keep_generation(spark, sf_dir):
    return maintain.keep_latest(_generations(spark, sf_dir), ["encounter_id"], "last_modified_date_time", ties="rank")


QUERIES["u2_keep_generation"] = _keep_generation
ORACLE["u2_keep_generation"] = with_bindings(
    ["program_encounter"],
    """with g as (select program_enrolment_id as encounter_id, tie_1 as element, last_modified_date_time from program_encounter
                  union all select program_enrolment_id, tie_1, timestamp '2002-01-01 00:00:00' from program_encounter where is_voided)
       select * from g qualify rank() over (partition by encounter_id order by last_modified_date_time desc nulls first) = 1""",
)


def _dedupe_media(spark, sf_dir):
    rows = bound(spark, sf_dir, "media_form").select(
        (F.col("id") % 37).alias("entity_id"),
        F.concat(F.lit("concept-"), (F.col("id") % 2).cast("string")).alias("concept_name"),
        F.when(F.col("id") % 3 == 0, F.lit("")).alias("question_group_concept_name"),
        F.when(F.col("id") % 5 == 0, F.lit(-1)).alias("repeatable_question_group_index"),
        F.expr("case when id % 41 <> 0 then timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 6 as int)) end").alias(
            "last_modified_date_time"
        ),
        "uuid",
    )
    return dedupe_media(rows)


QUERIES["u3_dedupe_media"] = _dedupe_media
ORACLE["u3_dedupe_media"] = with_bindings(
    ["media_form"],
    """with m as (select id % 37 as entity_id, 'concept-' || cast(id % 2 as varchar) as concept_name,
                         case when id % 3 = 0 then '' end as question_group_concept_name,
                         case when id % 5 = 0 then -1 end as repeatable_question_group_index,
                         case when id % 41 <> 0 then timestamp '2024-01-01 00:00:00' + interval '1' day * cast(id % 6 as int) end as last_modified_date_time, uuid
                  from media_form)
       select * from m qualify rank() over (partition by entity_id, concept_name, coalesce(question_group_concept_name, ''),
                                            coalesce(repeatable_question_group_index, -1) order by last_modified_date_time desc nulls first) = 1""",
)


def _approval(kind: str, table: str):
    def run(spark, sf_dir):
        target = bound(spark, sf_dir, table).select(
            "id", "uuid", F.when(F.col("id") % 5 == 0, F.lit("Old")).alias("latest_approval_status")
        )
        return maintain.latest_approval(
            target, bound(spark, sf_dir, "entity_approval_status"), bound(spark, sf_dir, "approval_status"), kind
        )

    return run


for _kind, _table in (("Subject", "individual"), ("Encounter", "encounter")):
    QUERIES[f"u4_approval_{_kind.lower()}"] = _approval(_kind, _table)
    ORACLE[f"u4_approval_{_kind.lower()}"] = with_bindings(
        [_table, "entity_approval_status", "approval_status"],
        f"""select t.id, t.uuid, coalesce(a.status, case when t.id % 5 = 0 then 'Old' end) as latest_approval_status
            from {_table} t left join (
              select e.entity_id, s.status from entity_approval_status e join approval_status s on s.id = e.approval_status_id
              where not e.is_voided and e.entity_type = '{_kind}'
              qualify row_number() over (partition by e.entity_id order by e.status_date_time desc nulls first, e.id desc) = 1) a on a.entity_id = t.id""",
    )

_MIGRATIONS = [("Alpha", "A1"), ("Beta", "beta"), ("A1", "alpha"), ("Gamma", "Beta")]
_RENAMED = "case {0} when 'Alpha' then 'alpha' when 'Beta' then 'beta' when 'Gamma' then 'Beta' else {0} end"


def _decoded(spark, sf_dir):
    from formflow.functions import obs

    rows = bound(spark, sf_dir, "encounter").select("id", "observations")
    names = obs.concept_map(bound(spark, sf_dir, "concept"), bound(spark, sf_dir, "concept_answer"), ["q-one", "q-many"])
    rows = obs.with_dictionary(rows.withColumn("o", obs.parse_obs(rows, "observations")), names)
    return rows.select(
        "id",
        obs.coded(F.col("o"), obs.obs_path("q-one"), F.col("answer_map")).alias("one"),
        obs.coded(F.col("o"), obs.obs_path("q-many"), F.col("answer_map")).alias("many"),
    )


QUERIES["u5_rename_single"] = lambda spark, sf_dir: maintain.rename_single(_decoded(spark, sf_dir), "one", _MIGRATIONS).select("id", "one")
ORACLE["u5_rename_single"] = with_bindings(
    ["encounter"],
    f"select id, {_RENAMED.format('one')} as one from (select id, {named(js('observations', 'q-one'))} as one from encounter)",
)
QUERIES["u6_rename_multi"] = lambda spark, sf_dir: maintain.rename_multi(_decoded(spark, sf_dir), "many", _MIGRATIONS).select("id", "many")
ORACLE["u6_rename_multi"] = with_bindings(
    ["encounter"],
    f"""select id, list_aggregate(list_transform(list_filter(list_transform(json_extract_string(observations, '$."q-many"[*]'), lambda x: {named('x')}),
               lambda x: x is not null), lambda y: {_RENAMED.format('y')}), 'string_agg', ', ') as many from encounter""",
)


def _uncancelled(spark, sf_dir):
    """A cancel table from a time when every visit had been cancelled."""
    visits = bound(spark, sf_dir, "encounter").select("id", "uuid", "cancel_date_time")
    return maintain.drop_uncancelled(visits, visits)


QUERIES["u7_drop_uncancelled"] = _uncancelled
ORACLE["u7_drop_uncancelled"] = with_bindings(
    ["encounter"], "select id, uuid, cancel_date_time from encounter where cancel_date_time is not null"
)


def _unexited(spark, sf_dir):
    """An exit table from a time when every enrolment had been exited."""
    rows = bound(spark, sf_dir, "program_enrolment").select("id", "uuid", "program_exit_date_time")
    return maintain.drop_unexited(rows, rows)


QUERIES["u8_drop_unexited"] = _unexited
ORACLE["u8_drop_unexited"] = with_bindings(
    ["program_enrolment"],
    "select id, uuid, program_exit_date_time from program_enrolment where program_exit_date_time is not null",
)


def _update_from(spark, sf_dir):
    """The largest payment of each order written onto its enrolment."""
    target = bound(spark, sf_dir, "program_enrolment").select("id", "uuid", F.lit(0.0).alias("paid"))
    source = bound(spark, sf_dir, "program_encounter").select(F.col("program_enrolment_id").alias("id"), F.col("tie_3").alias("paid"))
    return maintain.update_from(target, source, ["id"], ["paid"], [F.col("paid").desc()])


QUERIES["u0_update_from"] = _update_from
ORACLE["u0_update_from"] = with_bindings(
    ["program_enrolment", "program_encounter"],
    """select e.id, e.uuid, coalesce(s.paid, 0.0) as paid from program_enrolment e
       left join (select program_enrolment_id, max(tie_3) as paid from program_encounter group by program_enrolment_id) s
         on s.program_enrolment_id = e.id""",
)
