"""User-activity and sync-health reports.

Rows are counted per user before anything is joined, so joins only see one
row per user whatever share of the rows one user has.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.functions.quantiles import grouped_median
from formflow.model import TableSpec
from formflow.operators.families import TAG
from formflow.operators.maintain import keep_latest

# --- fixed values -----------------------------------------------------------
TOP_USERS = 10
TOP_CANCELLING = 5
ON_TIME_SHARE = 0.5
SERIES_BACK_MONTHS = 3
WEEK_DAYS = 7
# --- end of fixed values ----------------------------------------------------

#: A family of flat tables: a list of them, or all their rows with their table's tag.
Tables = Sequence[DataFrame] | DataFrame
REPORT_COLUMNS = (
    "is_voided", "last_modified_by_id", "registration_date", "enrolment_date_time", "encounter_date_time",
    "earliest_visit_date_time", "max_visit_date_time", "cancel_date_time",
)


def date_filter(column: str, start: str | None, end: str | None) -> Column:
    """Date of ``column`` between both days; no dates, no filter."""
    if start is None and end is None:
        return F.lit(True)
    if start is None or end is None:
        raise ValueError("a date filter needs both a start and an end")
    return F.col(column).cast("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def user_filter(column: str, ids: Iterable[int] | None) -> Column:
    ids = sorted(ids or [])
    return F.col(column).isin(ids) if ids else F.lit(True)


def active_users(users: DataFrame, ids: Iterable[int] | None = None) -> DataFrame:
    """Users that are not voided and belong to a tenant."""
    live = ~F.coalesce("is_voided", F.lit(False)) & F.col("organisation_id").isNotNull()
    return users.where(live & user_filter("id", ids)).select(
        F.col("id").alias("user_id"), "name", "username", F.coalesce("name", "username").alias("shown")
    )


def table_summary(spark: SparkSession, specs: Sequence[TableSpec] | DataFrame) -> DataFrame:
    """Tables of a tenant by type; of specs, or of rows with a table's name and type."""
    if isinstance(specs, DataFrame):
        return specs.select("name", "type").orderBy("type", "name")
    rows = sorted(((s.name, s.type) for s in specs), key=lambda r: (r[1], r[0]))
    return spark.createDataFrame(rows, "name string, type string")


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows(family: Tables) -> DataFrame:
    """The rows of a family: tagged already, or of a list of tables, each tagged by its place."""
    if isinstance(family, DataFrame):
        return family
    needed = [c for c in REPORT_COLUMNS if c in family[0].columns]
    return _union([t.select(*needed).withColumn(TAG, F.lit(str(i))) for i, t in enumerate(family)])


def _per_user(family: Tables, measures: dict[str, Column], when: Column, compat: bool) -> DataFrame:
    """Sums of ``measures`` over live rows per last modifying user.

    ``compat`` adds each distinct per-table number only once, as a report
    does that sums distinct values after joining several tables' counts.
    """
    counted = _rows(family).where(~F.col("is_voided") & when).select(
        F.col("last_modified_by_id").alias("user_id"), TAG, *[c.cast("bigint").alias(n) for n, c in measures.items()]
    )
    keys = ["user_id", TAG] if compat else ["user_id"]
    return counted.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])


def _sum(name: str, compat: bool) -> Column:
    total = F.sum_distinct(F.col(name)) if compat else F.sum(name)
    return F.coalesce(total, F.lit(0))


# --- fixed values: measures per family, in output order ----------------------
ACTIVITY = (
    ("subjects", "registration_count", "registration_date"),
    ("encounters", "encounter_count", "encounter_date_time"),
    ("enrolments", "enrolment_count", "enrolment_date_time"),
    ("program_encounters", "program_encounter_count", "encounter_date_time"),
)
# --- end of fixed values ----------------------------------------------------


def user_activity(
    families: dict[str, Tables],
    users: DataFrame,
    start: str | None = None,
    end: str | None = None,
    ids: Iterable[int] | None = None,
    k: int = TOP_USERS,
    compat: bool = False,
) -> DataFrame:
    """The most active users: rows last modified, by family.

    All families are counted by one aggregate over their union.
    """
    names = [name for _, name, _ in ACTIVITY]
    parts = []
    for family, name, day in ACTIVITY:
        if not isinstance(families[family], DataFrame) and not families[family]:
            continue
        parts.append(
            _rows(families[family]).where(~F.col("is_voided") & date_filter(day, start, end)).select(
                F.col("last_modified_by_id").alias("user_id"),
                TAG,
                *[F.lit(1 if n == name else None).cast("bigint").alias(n) for n in names],
            )
        )
    rows = _union(parts) if parts else users.sparkSession.createDataFrame([], ", ".join(["user_id bigint", f"{TAG} string", *(f"{n} bigint" for n in names)]))
    if compat:
        rows = rows.groupBy("user_id", TAG).agg(*[F.sum(n).alias(n) for n in names])
    counts = rows.groupBy("user_id").agg(*[_sum(n, compat).alias(n) for n in names])
    total = reduce(lambda a, b: a + b, [F.col(n) for n in names])
    return (
        counts.join(active_users(users, ids), "user_id")
        .select(F.col("user_id").alias("id"), F.col("shown").alias("name"), *names, total.alias("total"))
        .where(F.col("total") > 0)
        .orderBy(F.col("total").desc(), "id")
        .limit(k)
    )


def sync_failures(
    telemetry: DataFrame,
    users: DataFrame,
    start: str | None = None,
    end: str | None = None,
    ids: Iterable[int] | None = None,
    k: int = TOP_USERS,
) -> DataFrame:
    """Users with the most incomplete syncs."""
    failed = telemetry.where((F.col("sync_status") == "incomplete") & date_filter("sync_start_time", start, end))
    counts = failed.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.join(active_users(users, ids), "user_id")
        .groupBy(F.col("shown").alias("name"))
        .agg(F.sum("n").alias("count"))
        .orderBy(F.col("count").desc(), "name")
        .limit(k)
    )


def _last_sync(telemetry: DataFrame, *columns: str) -> DataFrame:
    rows = telemetry.select("id", "user_id", "sync_start_time", *columns)
    return keep_latest(rows, ["user_id"], "sync_start_time", tie_break=[F.col("id").desc()])


def _distribution(telemetry: DataFrame, users: DataFrame, column: str, ids: Iterable[int] | None) -> DataFrame:
    return (
        _last_sync(telemetry, column)
        .join(active_users(users, ids), "user_id")
        .groupBy(F.col(column).alias("indicator"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def app_versions(telemetry: DataFrame, users: DataFrame, ids: Iterable[int] | None = None) -> DataFrame:
    """App versions in use, by each user's last sync."""
    return _distribution(telemetry, users, "app_version", ids)


def device_models(telemetry: DataFrame, users: DataFrame, ids: Iterable[int] | None = None) -> DataFrame:
    """Devices in use, by each user's last sync."""
    return _distribution(telemetry, users, "device_name", ids)


def user_details(telemetry: DataFrame, users: DataFrame, ids: Iterable[int] | None = None) -> DataFrame:
    """Each user's last complete sync, by name from Z to A."""
    done = telemetry.where(F.col("sync_status") == "complete")
    return (
        _last_sync(done, "app_version", "device_name")
        .join(active_users(users, ids), "user_id")
        .select(
            F.col("shown").alias("name"), "app_version", F.col("device_name").alias("device_model"), "sync_start_time"
        )
        .orderBy(F.col("name").desc_nulls_first())
    )


def latest_syncs(
    telemetry: DataFrame,
    users: DataFrame,
    start: str | None = None,
    end: str | None = None,
    ids: Iterable[int] | None = None,
    k: int = TOP_USERS,
) -> DataFrame:
    """The syncs that ended last; unfinished ones come first.

    Reads the source telemetry and its last modifying user. The users side
    is unique per id, so only the columns shown are carried to the top-k.
    """
    shown = (
        "android_version", "app_version", "device_name", "sync_start_time", "sync_end_time",
        "sync_status", "sync_source",
    )
    rows = telemetry.where(date_filter("sync_end_time", start, end)).select(
        "id", F.col("last_modified_by_id").alias("user_id"), *shown
    )
    return (
        rows.join(active_users(users, ids), "user_id")
        .orderBy(F.col("sync_end_time").desc_nulls_first(), F.col("id").desc())
        .limit(k)
        .select(F.col("shown").alias("name"), *shown)
    )


def week_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """7-day spans from three months before ``start`` up to ``end``."""
    first = F.add_months(F.lit(start).cast("date"), -SERIES_BACK_MONTHS)
    days = F.sequence(first, F.lit(end).cast("date"), F.expr(f"interval {WEEK_DAYS} days"))
    return spark.range(1).select(F.posexplode(days).alias("week", "start_date")).select(
        "week", "start_date", F.date_add("start_date", WEEK_DAYS - 1).alias("end_date")
    )


def median_sync(telemetry: DataFrame, start: str, end: str) -> DataFrame:
    """Median duration in seconds of manual syncs per week; 0 if none.

    A sync belongs to a week that starts no later and ends no earlier than
    it. Weeks are evenly spaced, so its weeks are a computed range of week
    numbers and the join is an equi-join.
    """
    spark = telemetry.sparkSession
    weeks = week_series(spark, start, end)
    first = F.add_months(F.lit(start).cast("date"), -SERIES_BACK_MONTHS)
    last = F.floor(F.datediff(F.lit(end).cast("date"), first) / WEEK_DAYS)
    begin, finish = F.col("sync_start_time"), F.col("sync_end_time")
    low = F.ceil((F.datediff(finish, first) - (WEEK_DAYS - 1)) / WEEK_DAYS)
    high = F.floor(F.datediff(begin, first) / WEEK_DAYS)
    low, high = F.greatest(low, F.lit(0)), F.least(high, last)
    micros = F.unix_micros(finish.cast("timestamp")) - F.unix_micros(begin.cast("timestamp"))
    spans = (
        telemetry.where((F.col("sync_source") == "manual") & begin.isNotNull() & finish.isNotNull())
        .select(low.alias("low"), high.alias("high"), micros.alias("micros"))
        .where(F.col("low") <= F.col("high"))
        .select(F.explode(F.sequence("low", "high")).alias("week"), "micros")
        .withColumn("week", F.col("week").cast("int"))
    )
    medians = grouped_median(spans, ["week"], "micros", "median")
    return weeks.join(medians, "week", "left").select(
        "start_date",
        "end_date",
        F.coalesce(F.col("median") / F.lit(1_000_000), F.lit(0.0)).cast("double").alias("median_sync_seconds"),
    )


def _visit_totals(
    encounters: Tables,
    program_encounters: Tables,
    users: DataFrame,
    measures: dict[str, Column],
    start: str | None,
    end: str | None,
    ids: Iterable[int] | None,
    compat: bool,
) -> DataFrame:
    """Measures of both visit families per user, general and programme apart."""
    when = date_filter("encounter_date_time", start, end)
    sides = {"g": encounters, "p": program_encounters}
    parts = []
    for side, family in sides.items():
        if not isinstance(family, DataFrame) and not family:
            continue
        counted = _per_user(family, measures, when, compat)
        own = [F.when(F.lit(side == s), F.col(m)).alias(f"{s}_{m}") for m in measures for s in sides]
        parts.append(counted.select("user_id", *own))
    columns = [f"{side}_{m}" for m in measures for side in sides]
    both = _union(parts) if parts else users.sparkSession.createDataFrame([], ", ".join(["user_id bigint", *(f"{c} bigint" for c in columns)]))
    return (
        both.join(active_users(users, ids), "user_id")
        .groupBy("name", "username")
        .agg(*[_sum(c, compat).alias(c) for c in columns])
        .select(
            F.coalesce("name", "username").alias("indicator"),
            *[(F.col(f"g_{m}") + F.col(f"p_{m}")).alias(m) for m in measures],
        )
    )


def on_time_users(
    encounters: Tables,
    program_encounters: Tables,
    users: DataFrame,
    lo: float | None = None,
    hi: float | None = None,
    start: str | None = None,
    end: str | None = None,
    ids: Iterable[int] | None = None,
    compat: bool = False,
) -> DataFrame:
    """Users by the share of scheduled visits made on time.

    ``lo`` finds the champions (share at least ``lo``), ``hi`` the others
    (share at most ``hi``). Users without scheduled visits are in neither.
    """
    done = F.col("encounter_date_time")
    measures = {
        "on_time": F.coalesce(done <= F.col("max_visit_date_time"), F.lit(False)),
        "scheduled": done.isNotNull() & F.col("earliest_visit_date_time").isNotNull(),
    }
    totals = _visit_totals(encounters, program_encounters, users, measures, start, end, ids, compat)
    share = F.col("on_time") / F.nullif(F.col("scheduled"), F.lit(0))
    keep = F.col("on_time") > 0
    if lo is not None:
        keep = keep & (share >= lo)
    if hi is not None:
        keep = keep & (share <= hi)
    return totals.where(keep).select("indicator", F.col("on_time").alias("count"))


def most_cancelled(
    encounters: Tables,
    program_encounters: Tables,
    users: DataFrame,
    start: str | None = None,
    end: str | None = None,
    ids: Iterable[int] | None = None,
    k: int = TOP_CANCELLING,
    compat: bool = False,
) -> DataFrame:
    """Users with the most cancelled visits."""
    measures = {"cancelled": F.col("cancel_date_time").isNotNull()}
    totals = _visit_totals(encounters, program_encounters, users, measures, start, end, ids, compat)
    return (
        totals.where(F.col("cancelled") > 0)
        .select("indicator", F.col("cancelled").alias("count"))
        .orderBy(F.col("count").desc(), "indicator")
        .limit(k)
    )


