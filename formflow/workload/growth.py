"""The growth-monitoring report, step by step and as a whole run."""

from __future__ import annotations

from formflow.bindings import bound, with_bindings
from formflow.operators import growth
from formflow.plans.derive import Config, Source, Table, Target, growth_config, run_steps
from formflow.workload.common import plain
from formflow.workload.flatten import wide_address
from pyspark.sql import functions as F

QUERIES, ORACLE = {}, {}

PREV, NEW, AS_OF = "1997-01-01 00:00:00", "1998-06-01 00:00:00", "1998-06-01"

_FOLLOWUPS = """select l_orderkey * 10 + l_linenumber as id, l_orderkey as program_enrolment_id, o_custkey as individual_id,
   case when l_partkey % 17 = 0 then null else l_shipdate end as encounter_date_time, l_partkey % 29 = 0 as is_voided,
   l_shipdate - interval '5' day * cast(l_partkey % 80 as int) as created_date_time, l_shipdate as last_modified_date_time,
   case l_returnflag when 'R' then 'SAM' when 'A' then 'MAM' else case when l_partkey % 11 <> 0 then 'Normal' end end as weight_for_height,
   case l_suppkey % 3 when 0 then 'Severely Underweight' when 1 then 'Moderately Underweight' end as weight_for_age,
   case l_partkey % 4 when 0 then 'Stunted' when 1 then 'Severely stunted' when 2 then 'Normal' end as height_for_age,
   'GF-' || cast(l_linenumber % 2 + 1 as varchar(20)) as growth_faltering, l_quantity as height, l_discount as weight, l_linestatus as nutritional_status
   from {lineitem} join {orders} on o_orderkey = l_orderkey"""
_RENAME = {
    "weight_for_height": "Weight for Height Status", "weight_for_age": "Weight for age Status",
    "height_for_age": "Height for age Status", "growth_faltering": "Growth Faltering", "height": "Height", "weight": "Weight",
    "nutritional_status": "Nutritional Status",
}
FOLLOWUP_CTE = "f as (" + _FOLLOWUPS.format(lineitem="lineitem", orders="orders") + ")"


def followups(spark, sf_dir):
    sql = _FOLLOWUPS.format(lineitem=f"parquet.`{sf_dir}/lineitem.parquet`", orders=f"parquet.`{sf_dir}/orders.parquet`")
    return spark.sql(sql).withColumnsRenamed(_RENAME)


def subjects(spark, sf_dir):
    return bound(spark, sf_dir, "individual").withColumn("Mother's Name", F.col("middle_name"))


def enrolments(spark, sf_dir):
    return bound(spark, sf_dir, "program_enrolment")


def _sql(body: str, *names: str) -> str:
    body = body.strip()
    body = f"with {FOLLOWUP_CTE}, " + body[5:] if body.lower().startswith("with ") else f"with {FOLLOWUP_CTE} " + body
    return with_bindings(["individual", "program_enrolment", *names], body)


def _yes(cond: str) -> str:
    return f"case when {cond} then 'Yes' else 'No' end"


_SHOWN = (*growth.FLAGS, "Growth Falter Status (GF-1/GF-2)", "Height", "Weight", "Nutritional Status", growth.DAY, growth.KEY, "Program Exited")
_VALUES = f"""{_yes("f.weight_for_age = 'Severely Underweight'")} as "Severely Underweight", {_yes("f.weight_for_age = 'Moderately Underweight'")} as "Moderately Underweight",
   {_yes("f.weight_for_height = 'SAM'")} as "SAM", {_yes("f.weight_for_height = 'MAM'")} as "MAM", {_yes("f.height_for_age = 'Stunted'")} as "Moderately Stunted",
   {_yes("f.height_for_age = 'Severely stunted'")} as "Severely Stunted", f.growth_faltering as "Growth Falter Status (GF-1/GF-2)",
   round(cast(f.height as double), 6) as "Height", round(cast(f.weight as double), 6) as "Weight", f.nutritional_status as "Nutritional Status",
   cast(f.encounter_date_time as date) as "Date of Measurement", i.id as "Beneficiary ID", {_yes("e.program_exit_date_time is not null")} as "Program Exited" """
_FROM = """from individual i join program_enrolment e on e.individual_id = i.id and e.enrolment_date_time is not null and not i.is_voided
   {} join f on f.program_enrolment_id = e.id and f.encounter_date_time is not null and not f.is_voided and {}"""
_CREATED = f"f.created_date_time > timestamp '{PREV}' and f.created_date_time <= timestamp '{NEW}'"
_CHANGED = f"f.last_modified_date_time > timestamp '{PREV}' and f.last_modified_date_time <= timestamp '{NEW}'"
_OLDER = f"f.created_date_time < timestamp '{PREV}' and {_CHANGED}"


def _insert(compat):
    def run(spark, sf_dir):
        rows = growth.growth_insert(subjects(spark, sf_dir), enrolments(spark, sf_dir), followups(spark, sf_dir), PREV, NEW, compat)
        return plain(rows.select(*_SHOWN))

    return run


QUERIES["pe3_growth_insert"] = _insert(False)
ORACLE["pe3_growth_insert"] = _sql(f"select {_VALUES} {_FROM.format('', _CREATED)}")
QUERIES["pe3_growth_insert_compat"] = _insert(True)
ORACLE["pe3_growth_insert_compat"] = _sql(f"select {_VALUES} {_FROM.format('left', _CREATED)}")


def _before(spark, sf_dir):
    """The report as an earlier run left it."""
    return growth.growth_insert(subjects(spark, sf_dir), enrolments(spark, sf_dir), followups(spark, sf_dir), "1990-01-01 00:00:00", PREV)


# One follow-up per child and day, so that the update has a single match.
_ONE = "qualify count(*) over (partition by i.id, cast(f.encounter_date_time as date)) = 1"


def _single(rows):
    """Children measured once on a day; others would match several rows."""
    counts = rows.groupBy(growth.KEY, growth.DAY).count().where("count = 1").drop("count")
    return rows.join(counts, [growth.KEY, growth.DAY], "left_semi")


def _update(spark, sf_dir):
    s, e, f = subjects(spark, sf_dir), enrolments(spark, sf_dir), followups(spark, sf_dir)
    before = _single(_before(spark, sf_dir)).withColumn("Nutritional Status", F.lit("stale")).withColumn("SAM", F.lit("?"))
    return plain(growth.growth_update(before, s, e, f, PREV, NEW).select("Beneficiary ID", "Date of Measurement", "Program Exited", "SAM"))


_OLD_CREATED = f"f.created_date_time > timestamp '1990-01-01 00:00:00' and f.created_date_time <= timestamp '{PREV}'"
QUERIES["pe4_growth_update"] = _update
ORACLE["pe4_growth_update"] = _sql(
    f"""with b as (select {_VALUES} {_FROM.format('', _OLD_CREATED)} {_ONE}), c as (select {_VALUES} {_FROM.format('', _OLDER)})
        select b."Beneficiary ID", b."Date of Measurement", coalesce(c."Program Exited", b."Program Exited") as "Program Exited", coalesce(c."SAM", '?') as "SAM"
        from b left join c on c."Beneficiary ID" = b."Beneficiary ID" and c."Date of Measurement" = b."Date of Measurement" """
)

QUERIES["pe5_sam_mam"] = lambda spark, sf_dir: growth.sam_mam(followups(spark, sf_dir), PREV, NEW)
_MONTHS = ", ".join(
    _yes(
        f"coalesce(bool_and(f.weight_for_height = '{status}') filter (where f.encounter_date_time >= date '{AS_OF}' - interval '{m}' month), false)"
    )
    + f' as "{out}"'
    for status, names in growth.MONTH_FLAGS.items()
    for m, out in zip((1, 2, 3), names)
)
ORACLE["pe5_sam_mam"] = _sql(
    f"""select f.individual_id as "Beneficiary ID", {_MONTHS} from f where not f.is_voided and f.encounter_date_time >= date '{AS_OF}' - interval '3' month
        and f.encounter_date_time < timestamp '{NEW}' and {_CHANGED} group by f.individual_id"""
)

QUERIES["pe6_relapse"] = lambda spark, sf_dir: growth.relapse(
    subjects(spark, sf_dir), enrolments(spark, sf_dir), followups(spark, sf_dir), AS_OF, PREV, NEW
)
_TURN = f"date_trunc('month', timestamp '{AS_OF} 00:00:00') - interval '1' month"
ORACLE["pe6_relapse"] = _sql(
    f"""with ch as (select * from f where {_CHANGED})
        select distinct i.id as "Beneficiary ID", case when f.weight_for_height = 'SAM'
            and exists (select 1 from ch x where x.individual_id = f.individual_id and x.program_enrolment_id = f.program_enrolment_id
                        and x.weight_for_height = 'SAM' and x.encounter_date_time < {_TURN})
            and not exists (select 1 from ch x where x.individual_id = f.individual_id and x.program_enrolment_id = f.program_enrolment_id
                        and x.weight_for_height = 'SAM' and x.encounter_date_time >= {_TURN}) then 'Yes' else 'No' end as "Is it a relapse child (Yes/No)"
        from individual i join program_enrolment e on e.individual_id = i.id
        left join ch f on f.program_enrolment_id = e.id and f.encounter_date_time is not null and not f.is_voided"""
)


def _report(spark, sf_dir):
    """A report with one row per subject, to be filled in."""
    rows = bound(spark, sf_dir, "individual").select(F.col("id").alias(growth.KEY))
    return rows.select("*", *[F.lit(None).cast(t).alias(n) for n, t in growth.REPORT_COLUMNS if n != growth.KEY])


SUBJECT_WINDOW = ("2000-01-01 00:00:00", "2001-05-01 00:00:00")


def _subject_fields(spark, sf_dir):
    values = growth.subject_fields(subjects(spark, sf_dir), enrolments(spark, sf_dir), *SUBJECT_WINDOW)
    return growth.apply_fields(_report(spark, sf_dir), values).select(growth.KEY, *growth.SUBJECT_FIELDS)


QUERIES["pe7_subject_fields"] = _subject_fields
ORACLE["pe7_subject_fields"] = _sql(
    f"""with v as (select i.id, coalesce(i.first_name, '') || ' ' || coalesce(i.last_name, '') as n, i.date_of_birth as d, i.middle_name as m from individual i
             where not i.is_voided and i.last_modified_date_time > timestamp '{SUBJECT_WINDOW[0]}' and i.last_modified_date_time <= timestamp '{SUBJECT_WINDOW[1]}'
               and exists (select 1 from program_enrolment e where e.individual_id = i.id and e.enrolment_date_time is not null))
        select i.id as "Beneficiary ID", v.n as "Name of Child Benefeciaries", v.d as "Date of Birth", cast(null as varchar) as "Father's name",
               v.m as "Mother's Name" from individual i left join v on v.id = i.id"""
)


def _nrc(spark, sf_dir):
    admissions = bound(spark, sf_dir, "encounter").select(
        "individual_id", "is_voided", "last_modified_date_time",
        F.when(F.col("cancel_date_time").isNotNull(), "Admited").otherwise("Refused").alias("Admission Status"),
    )
    values = growth.nrc_status(admissions, PREV, NEW)
    return growth.apply_fields(_report(spark, sf_dir), values).select(growth.KEY, growth.NRC)


QUERIES["pe8_nrc_status"] = _nrc
ORACLE["pe8_nrc_status"] = _sql(
    f"""select i.id as "Beneficiary ID", v.s as "Was the child admitted to NRC before" from individual i left join
          (select individual_id, max(case when cancel_date_time is not null then 'Yes' else 'No' end) as s from encounter f
           where not is_voided and {_CHANGED} group by 1) v on v.individual_id = i.id""",
    "encounter",
)

_LEVELS = {"Site": "AWC", "Nation": "Sector", "Region": "Project/Block"}


def _village_address(spark, sf_dir):
    rows = wide_address(spark, sf_dir)
    return rows.select(
        "id", "uuid", "is_voided",
        F.col("Region").alias("Block"), F.col("Nation").alias("GP"), F.col("Site").alias("Village/Hamlet"),
        F.col("Region").alias("Project/Block"), F.col("Nation").alias("Sector"), F.col("Site").alias("AWC"),
    )


def _households(spark, sf_dir):
    return bound(spark, sf_dir, "individual").where("subject_type_id = 3").select(
        "id", "is_voided", F.concat(F.lit("adr-"), (F.col("id") % 10 + 1000).cast("string")).alias("AWC Name")
    )


_ADDRESS = """a as (select x.id, x.uuid, x.is_voided, case x.type_id when 3 then x.title end as site, case x.type_id when 3 then n.title when 2 then x.title end as nation,
     coalesce(r.title, case when n.id is null then x.title end) as region from address_level x left join address_level n on n.id = x.parent_id
     left join address_level r on r.id = case x.type_id when 3 then n.parent_id when 2 then x.parent_id end)"""


def _village(spark, sf_dir):
    values = growth.village_fields(
        subjects(spark, sf_dir), _village_address(spark, sf_dir), bound(spark, sf_dir, "group_subject"), _households(spark, sf_dir)
    )
    return growth.apply_fields(_report(spark, sf_dir), values).select(
        growth.KEY, *growth.VILLAGE_FIELDS, *growth.CENTRE_FIELDS, growth.HOUSEHOLD_FIELD
    )


QUERIES["pe9_village_fields"] = _village
ORACLE["pe9_village_fields"] = _sql(
    f"""with {_ADDRESS}, h as (select id, 'adr-' || cast(id % 10 + 1000 as varchar) as centre from individual where subject_type_id = 3 and not is_voided)
        select i.id as "Beneficiary ID", v.region as "Block", v.nation as "GP", v.site as "Village/Hamlet", c.region as "Project/Block",
               c.nation as "Sector", c.site as "AWC", h.id as "HH ID"
        from individual i left join a v on v.id = i.address_id and not v.is_voided
        left join group_subject g on g.member_subject_id = i.id and not g.is_voided left join h on h.id = g.group_subject_id
        left join a c on c.uuid = h.centre and not c.is_voided""",
    "address_level", "group_subject",
)


def _centre(spark, sf_dir):
    profiles = bound(spark, sf_dir, "individual").select("id", (F.col("address_id") + 900 + F.col("id") % 9).alias("address_id"))
    values = growth.centre_fields(profiles, _village_address(spark, sf_dir))
    return growth.apply_fields(_report(spark, sf_dir), values).select(growth.KEY, *growth.CENTRE_FIELDS)


QUERIES["pe10_centre_fields"] = _centre
ORACLE["pe10_centre_fields"] = _sql(
    f"""with {_ADDRESS} select i.id as "Beneficiary ID", c.region as "Project/Block", c.nation as "Sector", c.site as "AWC" from individual i
        left join a c on c.id = i.address_id + 900 + i.id % 9 and not c.is_voided""",
    "address_level",
)


def _run(spark, sf_dir):
    """A whole run of the configured steps over an empty report."""
    admissions = bound(spark, sf_dir, "encounter").select(
        "individual_id", "is_voided", "last_modified_date_time",
        F.when(F.col("cancel_date_time").isNotNull(), "Admited").otherwise("Refused").alias("Admission Status"),
    )
    tables = {
        "individual": subjects(spark, sf_dir), "individual_child": enrolments(spark, sf_dir),
        "individual_child_growth_monitoring": followups(spark, sf_dir), "individual_child_nrc_admission": admissions,
        "group_subject": bound(spark, sf_dir, "group_subject"), "household": _households(spark, sf_dir),
        "address": _village_address(spark, sf_dir),
    }
    config = growth_config(as_of=AS_OF)
    out = run_steps(spark, config, tables, PREV, NEW)
    report = out["individual_child_growth_monitoring_report"]
    return report.select(growth.KEY, growth.DAY, growth.MONTH_FLAGS["SAM"][2], growth.NRC, "GP", "HH ID")


QUERIES["pe1_growth_run"] = _run
ORACLE["pe1_growth_run"] = _sql(
    f"""with {_ADDRESS}, ins as (select {_VALUES} {_FROM.format('', _CREATED)}),
        m as (select f.individual_id, {_MONTHS} from f where not f.is_voided and f.encounter_date_time >= date '{AS_OF}' - interval '3' month
              and f.encounter_date_time < timestamp '{NEW}' and {_CHANGED} group by f.individual_id),
        n as (select individual_id, max(case when cancel_date_time is not null then 'Yes' else 'No' end) as s from encounter f
              where not is_voided and {_CHANGED} group by 1),
        h as (select id from individual where subject_type_id = 3 and not is_voided)
        select ins."Beneficiary ID", ins."Date of Measurement", m."{growth.MONTH_FLAGS['SAM'][2]}", n.s as "{growth.NRC}", v.nation as "GP", h.id as "HH ID"
        from ins join individual i on i.id = ins."Beneficiary ID" left join m on m.individual_id = i.id left join n on n.individual_id = i.id
        left join a v on v.id = i.address_id and not v.is_voided
        left join group_subject g on g.member_subject_id = i.id and not g.is_voided left join h on h.id = g.group_subject_id""",
    "encounter", "address_level", "group_subject",
)


def _sql_steps(spark, sf_dir):
    """Steps written as SQL with bound times and a parameter."""
    schema = "kind string, visits bigint"
    config = Config(
        [Table(1, "visit_counts", spark.createDataFrame([], schema).schema)],
        [
            Target(1, "visit_counts", [
                Source(
                    1, "encounter",
                    """select concat(:param1, cast(encounter_type_id as string)) as kind, count(*) as visits from {encounter}
                       where last_modified_date_time > cast(:previousCutoffDateTime as timestamp_ntz)
                         and last_modified_date_time <= cast(:newCutoffDateTime as timestamp_ntz) group by encounter_type_id""",
                    ["select kind, visits * 2 as visits from {visit_counts}"],
                    ["kind-"],
                )
            ])
        ],
    )
    return run_steps(spark, config, {"encounter": bound(spark, sf_dir, "encounter")}, PREV, NEW)["visit_counts"]


QUERIES["pe1_sql_steps"] = _sql_steps
ORACLE["pe1_sql_steps"] = with_bindings(
    ["encounter"],
    f"""select 'kind-' || cast(encounter_type_id as varchar) as kind, count(*) * 2 as visits from encounter f where {_CHANGED} group by encounter_type_id""",
)
