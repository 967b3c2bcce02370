"""The growth-monitoring report: a table derived from flat tables.

Each update is an operator that gives the new values by beneficiary; the
step runner (``plans.derive``) merges them into the report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formflow.operators.maintain import update_from
from formflow.sources.tables import in_window, time_literal

# --- fixed values: columns of the report and its sources ---------------------
REPORT_COLUMNS = (
    ("Project/Block", "string"), ("Block", "string"), ("Sector", "string"), ("GP", "string"),
    ("AWC", "string"), ("Village/Hamlet", "string"), ("HH ID", "bigint"),
    ("Beneficiary ID", "bigint"), ("Name of Child Benefeciaries", "string"),
    ("Date of Birth", "date"), ("Father's name", "string"), ("Mother's Name", "string"),
    ("Date of Measurement", "date"), ("Nutritional Status", "string"),
    ("Severely Underweight", "string"), ("Moderately Underweight", "string"), ("SAM", "string"),
    ("Was the Child SAM in the Last 1 month", "string"),
    ("Was the Child SAM in the Last 2 month", "string"),
    ("Was the Child SAM in the Last 3 Months", "string"),
    ("Is it a relapse child (Yes/No)", "string"), ("To be monitored by QRT", "string"),
    ("Was the child admitted to NRC before", "string"), ("MAM", "string"),
    ("Was the Child MAM in the Last 1 Month", "string"),
    ("Was the Child MAM in the Last 2 Months", "string"),
    ("Was the Child MAM in the Last 3 Months", "string"), ("Moderately Stunted", "string"),
    ("Severely Stunted", "string"), ("Growth Falter Status (GF-1/GF-2)", "string"),
    ("Height", "decimal(38,10)"), ("Weight", "decimal(38,10)"),
    ("Is the child going to PPK?", "string"), ("Is the child going to Creche?", "string"),
    ("Is the child being currently exclusively breastfed?", "string"),
    ("Is the child being currently breastfed?", "string"),
    ("Number of day attended AWC (last month)", "decimal(38,10)"),
    ("Is the child receiving egg from AWC", "string"),
    ("Is the child receiving THR from AWC", "string"),
    ("Did the child attended VHND last month", "string"),
    ("What is the treatment advise for the SAM/MAM/GF2 child?", "string"),
    ("Is the child enrolled in the CMAM program?", "string"),
    ("Is the child availing benefits (ATHR) under the CMAM program?", "string"),
    ("Did you receive additional THR (MSPY)?", "string"), ("Program Exited", "string"),
)
# report column: (follow-up column, value that means Yes)
FLAGS = {
    "Severely Underweight": ("Weight for age Status", "Severely Underweight"),
    "Moderately Underweight": ("Weight for age Status", "Moderately Underweight"),
    "SAM": ("Weight for Height Status", "SAM"),
    "MAM": ("Weight for Height Status", "MAM"),
    "Moderately Stunted": ("Height for age Status", "Stunted"),
    "Severely Stunted": ("Height for age Status", "Severely stunted"),
}
# report column: follow-up column it is copied from
COPIED = {
    "Growth Falter Status (GF-1/GF-2)": "Growth Faltering",
    "Height": "Height",
    "Weight": "Weight",
    "Nutritional Status": "Nutritional Status",
    "Date of Measurement": "encounter_date_time",
    "Is the child going to PPK?": "Is the child going to PPK?",
    "Is the child going to Creche?": "Is the child going to Creche?",
    "Is the child being currently exclusively breastfed?": "Is the child being currently exclusively breastfed?",
    "Is the child being currently breastfed?": "Is the child being currently breastfed?",
    "Number of day attended AWC (last month)": "Number of day attended AWC (last month)",
    "Is the child receiving egg from AWC": "Is the child receiving egg from AWC",
    "To be monitored by QRT": "To be monitored by QRT",
    "Is the child receiving THR from AWC": "Is the child receiving THR from AWC",
    "Did the child attended VHND last month": "Did the child attended VHND last month",
    "What is the treatment advise for the SAM/MAM/GF2 child?": "What is the treatment advise for the SAM/MAM/GF2 child?",
    "Is the child enrolled in the CMAM program?": "Is the child enrolled in the CMAM program?",
    "Is the child availing benefits (ATHR) under the CMAM program?": "Is the child availing benefits (ATHR) under the CMAM program?",
    "Did you receive additional THR (MSPY)?": "Did you receive additional THR (MSPY)?",
}
MONTH_FLAGS = {
    "SAM": (
        "Was the Child SAM in the Last 1 month",
        "Was the Child SAM in the Last 2 month",
        "Was the Child SAM in the Last 3 Months",
    ),
    "MAM": (
        "Was the Child MAM in the Last 1 Month",
        "Was the Child MAM in the Last 2 Months",
        "Was the Child MAM in the Last 3 Months",
    ),
}
RELAPSE = "Is it a relapse child (Yes/No)"
NRC = "Was the child admitted to NRC before"
NRC_ADMITTED = "Admited"
STATUS = "Weight for Height Status"
SUBJECT_FIELDS = ("Name of Child Benefeciaries", "Date of Birth", "Father's name", "Mother's Name")
VILLAGE_FIELDS = ("Block", "GP", "Village/Hamlet")
CENTRE_FIELDS = ("Project/Block", "Sector", "AWC")
HOUSEHOLD_FIELD = "HH ID"
CENTRE_UUID_COLUMN = "AWC Name"
# --- end of fixed values ----------------------------------------------------

KEY = "Beneficiary ID"
DAY = "Date of Measurement"


def report_schema(columns: Sequence[tuple[str, str]] = REPORT_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in columns])


def ensure_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table of a declared schema."""
    return spark.createDataFrame([], schema)


def _yes(condition: Column) -> Column:
    """Yes where true; false and unknown are No."""
    return F.when(condition, "Yes").otherwise("No")


def _col(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def _conform(df: DataFrame, columns: Sequence[tuple[str, str]]) -> DataFrame:
    return df.select(*[_col(df, n).cast(t).alias(n) for n, t in columns])


def _growth_rows(subjects: DataFrame, enrolments: DataFrame, followups: DataFrame, keep_unmatched: bool) -> DataFrame:
    """Report rows of the given follow-ups with subject and exit flag."""
    values = followups.select(
        F.col("program_enrolment_id").alias("_enrolment"),
        *[_yes(_col(followups, c) == v).alias(out) for out, (c, v) in FLAGS.items()],
        *[_col(followups, c).alias(out) for out, c in COPIED.items()],
    )
    live = subjects.where(~F.col("is_voided")).select(F.col("id").alias(KEY))
    enrolled = (
        enrolments.where(F.col("enrolment_date_time").isNotNull())
        .select(
            F.col("id").alias("_enrolment"),
            F.col("individual_id").alias(KEY),
            _yes(F.col("program_exit_date_time").isNotNull()).alias("Program Exited"),
        )
        .join(live, KEY)
    )
    rows = enrolled.join(values, "_enrolment", "left" if keep_unmatched else "inner")
    if keep_unmatched:
        rows = rows.withColumns({flag: F.coalesce(F.col(f"`{flag}`"), F.lit("No")) for flag in FLAGS})
    return rows.drop("_enrolment")


def _measured(followups: DataFrame) -> DataFrame:
    return followups.where(F.col("encounter_date_time").isNotNull() & ~F.col("is_voided"))


def growth_insert(
    subjects: DataFrame,
    enrolments: DataFrame,
    followups: DataFrame,
    prev: str,
    new: str,
    compat: bool = False,
) -> DataFrame:
    """Report rows of follow-ups created in ``(prev, new]``.

    With ``compat`` an enrolment without one gives an empty row, every run.
    """
    fresh = _measured(followups).where(in_window(followups, prev, new, "created_date_time"))
    return _conform(_growth_rows(subjects, enrolments, fresh, compat), REPORT_COLUMNS)


def growth_changes(
    subjects: DataFrame, enrolments: DataFrame, followups: DataFrame, prev: str, new: str
) -> DataFrame:
    """New values of follow-ups created before ``prev`` and changed since."""
    older = F.col("created_date_time") < time_literal(followups, "created_date_time", prev)
    changed = _measured(followups).where(older & in_window(followups, prev, new))
    return _conform(_growth_rows(subjects, enrolments, changed, False), REPORT_COLUMNS)


def growth_update(
    report: DataFrame, subjects: DataFrame, enrolments: DataFrame, followups: DataFrame, prev: str, new: str
) -> DataFrame:
    """The report with changed follow-ups rewritten, by child and day.

    A follow-up whose day was changed matches no row.
    """
    columns = [*FLAGS, *[c for c in COPIED if c != DAY], "Program Exited"]
    return update_from(report, growth_changes(subjects, enrolments, followups, prev, new), [KEY, DAY], columns)


def sam_mam(followups: DataFrame, prev: str, new: str) -> DataFrame:
    """Was every measurement of the last 1, 2, 3 months SAM (or MAM)?"""
    day = F.lit(new).cast("date")
    seen = F.col("encounter_date_time")
    since = {m: seen >= F.add_months(day, -m) for m in (1, 2, 3)}
    recent = followups.where(
        ~F.col("is_voided")
        & since[3]
        & (seen < time_literal(followups, "encounter_date_time", new))
        & in_window(followups, prev, new)
    )
    flags = [
        _yes(F.bool_and(F.when(since[m], F.col(f"`{STATUS}`") == status))).alias(out)
        for status, names in MONTH_FLAGS.items()
        for m, out in zip((1, 2, 3), names)
    ]
    return recent.groupBy(F.col("individual_id").alias(KEY)).agg(*flags)


def relapse(
    subjects: DataFrame, enrolments: DataFrame, followups: DataFrame, as_of: str, prev: str, new: str
) -> DataFrame:
    """SAM before last month, SAM in a changed follow-up, not SAM since.

    A subject whose follow-ups differ gets both answers. The earlier and the
    recent SAM visits are one grouped aggregate per subject and enrolment,
    joined back, and not a search per row.
    """
    turn = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -1)
    seen = F.col("encounter_date_time")
    pair = ["individual_id", "program_enrolment_id"]
    changed = followups.where(in_window(followups, prev, new))
    is_sam = F.coalesce(F.col(f"`{STATUS}`") == "SAM", F.lit(False))
    relapsed = (
        changed.where(is_sam)
        .groupBy(*pair)
        .agg(F.bool_or(seen < turn).alias("_before"), F.bool_or(seen >= turn).alias("_since"))
        .where(F.col("_before") & ~F.coalesce("_since", F.lit(False)))
        .select(*pair, F.lit(True).alias("_back"))
    )
    by_enrolment = (
        _measured(changed)
        .select(*pair, is_sam.alias("_sam"))
        .join(relapsed, pair, "left")
        .withColumn("_flag", F.col("_sam") & F.coalesce("_back", F.lit(False)))
        .groupBy(F.col("program_enrolment_id").alias("_enrolment"))
        .agg(F.array_sort(F.collect_set(_yes(F.col("_flag")))).alias("_answers"))
    )
    rows = (
        enrolments.select(F.col("id").alias("_enrolment"), F.col("individual_id").alias(KEY))
        .join(subjects.select(F.col("id").alias(KEY)), KEY, "left_semi")
        .join(by_enrolment, "_enrolment", "left")
    )
    answers = F.coalesce("_answers", F.array(F.lit("No")))
    return rows.select(KEY, F.explode(answers).alias(RELAPSE)).distinct()


def subject_fields(subjects: DataFrame, enrolments: DataFrame, prev: str, new: str) -> DataFrame:
    """Names and birth date of changed subjects that are enrolled."""
    enrolled = enrolments.where(F.col("enrolment_date_time").isNotNull()).select(F.col("individual_id").alias("id"))
    name = F.concat(F.coalesce("first_name", F.lit("")), F.lit(" "), F.coalesce("last_name", F.lit("")))
    return (
        subjects.where(~F.col("is_voided") & in_window(subjects, prev, new))
        .join(enrolled, "id", "left_semi")
        .select(
            F.col("id").alias(KEY),
            name.alias(SUBJECT_FIELDS[0]),
            _col(subjects, "date_of_birth").cast("date").alias(SUBJECT_FIELDS[1]),
            _col(subjects, "Father/Husband's name").cast("string").alias(SUBJECT_FIELDS[2]),
            _col(subjects, "Mother's Name").cast("string").alias(SUBJECT_FIELDS[3]),
        )
    )


def nrc_status(admissions: DataFrame, prev: str, new: str) -> DataFrame:
    """Was the child ever admitted, among changed admissions."""
    return (
        admissions.where(~F.col("is_voided") & in_window(admissions, prev, new))
        .groupBy(F.col("individual_id").alias(KEY))
        .agg(F.max(_yes(F.col("`Admission Status`") == NRC_ADMITTED)).alias(NRC))
    )


def village_fields(
    subjects: DataFrame, address: DataFrame, members: DataFrame, households: DataFrame
) -> DataFrame:
    """Village of the child, household, and centre of the household."""
    live = address.where(~F.col("is_voided"))
    village = live.select(F.col("id").alias("address_id"), *[F.col(f"`{c}`") for c in VILLAGE_FIELDS])
    centre = live.select(F.col("uuid").alias("_centre"), *[F.col(f"`{c}`") for c in CENTRE_FIELDS])
    edges = members.where(~F.col("is_voided")).select(
        F.col("member_subject_id").alias(KEY), F.col("group_subject_id").alias(HOUSEHOLD_FIELD)
    )
    homes = households.where(~F.col("is_voided")).select(
        F.col("id").alias(HOUSEHOLD_FIELD), F.col(f"`{CENTRE_UUID_COLUMN}`").alias("_centre"), F.lit(True).alias("_home")
    )
    housed = edges.join(homes, HOUSEHOLD_FIELD, "left").select(
        KEY, "_centre", F.when(F.col("_home"), F.col(HOUSEHOLD_FIELD)).alias(HOUSEHOLD_FIELD)
    )
    return (
        subjects.select(F.col("id").alias(KEY), "address_id")
        .join(village, "address_id", "left")
        .join(housed, KEY, "left")
        .join(centre, "_centre", "left")
        .select(KEY, *VILLAGE_FIELDS, *[F.col(f"`{c}`") for c in CENTRE_FIELDS], HOUSEHOLD_FIELD)
    )


def centre_fields(profiles: DataFrame, address: DataFrame) -> DataFrame:
    """Centre of a profile by its own address."""
    centre = address.where(~F.col("is_voided")).select(
        F.col("id").alias("address_id"), *[F.col(f"`{c}`") for c in CENTRE_FIELDS]
    )
    return (
        profiles.select(F.col("id").alias(KEY), "address_id")
        .join(centre, "address_id", "left")
        .select(KEY, *[F.col(f"`{c}`") for c in CENTRE_FIELDS])
    )


def apply_fields(report: DataFrame, values: DataFrame) -> DataFrame:
    """The report with the given columns set, by beneficiary.

    Where a beneficiary has several rows of values, the greatest is taken,
    so Yes wins over No and a value over none.
    """
    columns = [c for c in values.columns if c != KEY]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in columns]
    return update_from(report, values, [KEY], columns, order)
