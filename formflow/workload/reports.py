"""User-activity and sync-health reports over flat tables."""

from __future__ import annotations

from formflow.bindings import bound, with_bindings
from formflow.operators import reports
from formflow.workload.views import ENCOUNTERS, ENROLMENTS, PROGRAM_ENCOUNTERS, SUBJECTS, family_rows

QUERIES, ORACLE = {}, {}

START, END = "1996-01-01", "2000-12-31"
USERS = list(range(0, 9))
TEL_START, TEL_END = "2024-01-01", "2024-01-31"


FAMILIES = {"subjects": SUBJECTS, "encounters": ENCOUNTERS, "enrolments": ENROLMENTS, "program_encounters": PROGRAM_ENCOUNTERS}


def _activity(compat):
    def run(spark, sf_dir):
        rows = {name: family_rows(spark, sf_dir, specs) for name, specs in FAMILIES.items()}
        return reports.user_activity(rows, bound(spark, sf_dir, "users"), START, END, compat=compat)

    return run


_LIVE_USERS = "(u.is_voided = false or u.is_voided is null) and u.organisation_id is not null"
_BETWEEN = f"between date '{START}' and date '{END}'"
_NAMES = ["individual", "encounter", "program_enrolment", "program_encounter", "users"]
# every row of the flat tables: (family, table within it, row)
_ROWS = """
   enc as (select struct_pack(s := i.subject_type_id, v := e.encounter_type_id, p := cast(null as bigint)) as t, e.*
           from encounter e join individual i on i.id = e.individual_id where not e.is_voided),
   penc as (select struct_pack(s := i.subject_type_id, v := e.encounter_type_id, p := n.program_id) as t, e.*
            from program_encounter e join program_enrolment n on n.id = e.program_enrolment_id
            join individual i on i.id = n.individual_id where not e.is_voided)"""
_COUNTS = f"""{_ROWS},
   c as (select 1 as f, struct_pack(s := subject_type_id, v := cast(null as bigint), p := cast(null as bigint)) as t, last_modified_by_id as u,
           count(*) as n from individual where subject_type_id < 5 and not is_voided and cast(registration_date as date) {_BETWEEN} group by all
         union all select 2, t, last_modified_by_id, count(*) from enc where cast(encounter_date_time as date) {_BETWEEN} group by all
         union all select 3, struct_pack(s := i.subject_type_id, v := cast(null as bigint), p := e.program_id), e.last_modified_by_id, count(*)
           from program_enrolment e join individual i on i.id = e.individual_id
           where not e.is_voided and cast(e.enrolment_date_time as date) {_BETWEEN} group by all
         union all select 4, t, last_modified_by_id, count(*) from penc where cast(encounter_date_time as date) {_BETWEEN} group by all)"""


def _activity_sql(distinct: str) -> str:
    total = " + ".join(f"coalesce(sum({distinct} n) filter (where f = {i}), 0)" for i in (1, 2, 3, 4))
    parts = ", ".join(
        f"cast(coalesce(sum({distinct} n) filter (where f = {i}), 0) as bigint) as {name}"
        for i, (_, name, _) in enumerate(reports.ACTIVITY, 1)
    )
    return with_bindings(
        _NAMES,
        f"""with {_COUNTS.strip()}
            select u.id, coalesce(u.name, u.username) as name, {parts}, cast({total} as bigint) as total
            from c join users u on u.id = c.u where {_LIVE_USERS}
            group by u.id, coalesce(u.name, u.username) order by total desc, u.id limit 10""",
    )


for _compat in (False, True):
    _suffix = "_compat" if _compat else ""
    QUERIES[f"rp2_user_activity{_suffix}"] = _activity(_compat)
    ORACLE[f"rp2_user_activity{_suffix}"] = _activity_sql("distinct" if _compat else "")




def _tel(fn, *args):
    return lambda spark, sf_dir: fn(bound(spark, sf_dir, "sync_telemetry"), bound(spark, sf_dir, "users"), *args)


_TEL = ["sync_telemetry", "users"]
QUERIES["rp3_sync_failures"] = _tel(reports.sync_failures, "2024-01-02", "2024-01-25", USERS)
ORACLE["rp3_sync_failures"] = with_bindings(
    _TEL,
    f"""select coalesce(u.name, u.username) as name, cast(count(*) as bigint) as count from sync_telemetry t join users u on u.id = t.user_id
        where t.sync_status = 'incomplete' and {_LIVE_USERS} and cast(t.sync_start_time as date) between date '2024-01-02' and date '2024-01-25'
          and u.id in ({', '.join(map(str, USERS))}) group by 1 order by 2 desc, 1 limit 10""",
)
_LAST = "(select * from sync_telemetry {} qualify row_number() over (partition by user_id order by sync_start_time desc nulls first, id desc) = 1)"
for _name, _column, _fn in (("rp4_app_versions", "app_version", reports.app_versions), ("rp5_device_models", "device_name", reports.device_models)):
    QUERIES[_name] = _tel(_fn)
    ORACLE[_name] = with_bindings(
        _TEL,
        f"""select l.{_column} as indicator, count(*) as count from users u join {_LAST.format('')} l on l.user_id = u.id
            where {_LIVE_USERS} group by 1""",
    )
QUERIES["rp6_user_details"] = _tel(reports.user_details)
ORACLE["rp6_user_details"] = with_bindings(
    _TEL,
    f"""select coalesce(u.name, u.username) as name, l.app_version, l.device_name as device_model, l.sync_start_time
        from users u join {_LAST.format("where sync_status = 'complete'")} l on l.user_id = u.id where {_LIVE_USERS} order by 1 desc nulls first""",
)
_SYNC = "android_version, app_version, device_name, sync_start_time, sync_end_time, sync_status, sync_source"


def _latest_sql(where: str) -> str:
    return with_bindings(
        _TEL,
        f"""select coalesce(u.name, u.username) as name, {', '.join('t.' + c for c in _SYNC.split(', '))}
            from sync_telemetry t join users u on u.id = t.last_modified_by_id where {_LIVE_USERS} and {where}
            order by t.sync_end_time desc nulls first, t.id desc limit 10""",
    )


QUERIES["rp7_latest_syncs"] = _tel(reports.latest_syncs, "2024-01-02", "2024-01-25")
ORACLE["rp7_latest_syncs"] = _latest_sql("cast(t.sync_end_time as date) between date '2024-01-02' and date '2024-01-25'")
QUERIES["rp7_latest_syncs_all"] = _tel(reports.latest_syncs)
ORACLE["rp7_latest_syncs_all"] = _latest_sql("true")

QUERIES["rp8_median_sync"] = lambda spark, sf_dir: reports.median_sync(bound(spark, sf_dir, "sync_telemetry"), TEL_START, TEL_END)
ORACLE["rp8_median_sync"] = with_bindings(
    ["sync_telemetry"],
    f"""with weeks as (select cast(d as date) as start_date, cast(d as date) + 6 as end_date
                       from (select unnest(generate_series(timestamp '{TEL_START} 00:00:00' - interval '3' month, timestamp '{TEL_END} 00:00:00', interval '7' day)) as d))
        select w.start_date, w.end_date,
               coalesce(percentile_cont(0.5) within group (order by epoch_us(t.sync_end_time) - epoch_us(t.sync_start_time)) / 1000000.0, 0.0) as median_sync_seconds
        from weeks w left join sync_telemetry t on cast(t.sync_start_time as date) >= w.start_date and cast(t.sync_end_time as date) <= w.end_date
             and t.sync_source = 'manual' group by 1, 2""",
)


def _on_time(compat, **share):
    def run(spark, sf_dir):
        return reports.on_time_users(
            family_rows(spark, sf_dir, ENCOUNTERS), family_rows(spark, sf_dir, PROGRAM_ENCOUNTERS), bound(spark, sf_dir, "users"),
            start=START, end=END, compat=compat, **share,
        )

    return run


def _visit_counts(distinct: str, measure: dict[str, str]) -> str:
    sums = ", ".join(
        f"coalesce(sum({distinct} {m}) filter (where f = {i}), 0) as {p}_{m}" for m in measure for i, p in ((2, "g"), (4, "p"))
    )
    counts = ", ".join(f"count(*) filter (where {cond}) as {m}" for m, cond in measure.items())
    return f"""{_ROWS},
      c as (select 2 as f, t, last_modified_by_id as u, {counts} from enc where cast(encounter_date_time as date) {_BETWEEN} group by t, last_modified_by_id
            union all select 4, t, last_modified_by_id, {counts} from penc where cast(encounter_date_time as date) {_BETWEEN} group by t, last_modified_by_id),
      v as (select coalesce(u.name, u.username) as indicator, {sums} from users u join c on c.u = u.id where {_LIVE_USERS} group by u.name, u.username)"""


def _on_time_sql(distinct: str, op: str) -> str:
    measure = {
        "on_time": "encounter_date_time <= max_visit_date_time",
        "scheduled": "encounter_date_time is not null and earliest_visit_date_time is not null",
    }
    return with_bindings(
        _NAMES,
        f"""with {_visit_counts(distinct, measure).strip()}
            select indicator, cast(g_on_time + p_on_time as bigint) as count from v where g_on_time + p_on_time > 0
              and cast(g_on_time + p_on_time as double) / nullif(g_scheduled + p_scheduled, 0) {op} 0.5""",
    )


for _compat in (False, True):
    _suffix = "_compat" if _compat else ""
    _d = "distinct" if _compat else ""
    QUERIES[f"rp9_champions{_suffix}"] = _on_time(_compat, lo=reports.ON_TIME_SHARE)
    ORACLE[f"rp9_champions{_suffix}"] = _on_time_sql(_d, ">=")
    QUERIES[f"rp10_non_performing{_suffix}"] = _on_time(_compat, hi=reports.ON_TIME_SHARE)
    ORACLE[f"rp10_non_performing{_suffix}"] = _on_time_sql(_d, "<=")


def _cancelled(compat):
    def run(spark, sf_dir):
        return reports.most_cancelled(
            family_rows(spark, sf_dir, ENCOUNTERS), family_rows(spark, sf_dir, PROGRAM_ENCOUNTERS), bound(spark, sf_dir, "users"), compat=compat
        )

    return run


for _compat in (False, True):
    _suffix = "_compat" if _compat else ""
    QUERIES[f"rp11_most_cancelled{_suffix}"] = _cancelled(_compat)
    ORACLE[f"rp11_most_cancelled{_suffix}"] = with_bindings(
        _NAMES,
        f"""with {_visit_counts('distinct' if _compat else '', {'cancelled': 'cancel_date_time is not null'}).strip().replace(f'where cast(encounter_date_time as date) {_BETWEEN}', '')}
            select indicator, cast(g_cancelled + p_cancelled as bigint) as count from v where g_cancelled + p_cancelled > 0 order by 2 desc, 1 limit 5""",
    )
