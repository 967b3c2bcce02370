"""Sources, sinks and incremental state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from formflow.bindings import bound, context, with_bindings
from formflow.operators import entities
from formflow.session import shared_dir
from formflow.sources import state
from formflow.sources.snapshots import Store
from formflow.sources.tables import delta, read_source, tenant_filter
from formflow.streaming.sync_stream import stream_sync
from formflow.workload.common import WINDOW, encounter_spec, in_window, plain
from formflow.workload.flatten import ORACLE as FLAT_ORACLE

QUERIES, ORACLE = {}, {}


def fresh_store(spark) -> Store:
    return Store(spark, f"{shared_dir(spark)}/formflow-{uuid.uuid4().hex}")


QUERIES["s1_read_source"] = lambda spark, sf_dir: read_source(spark, sf_dir, "customer")
ORACLE["s1_read_source"] = "select * from customer"

_SHORT = ("id", "uuid", "individual_id", "organisation_id", "last_modified_date_time")
QUERIES["s2_tenant_filter"] = lambda spark, sf_dir: tenant_filter(bound(spark, sf_dir, "encounter"), [1, 3]).select(*_SHORT)
ORACLE["s2_tenant_filter"] = with_bindings(
    ["encounter"], f"select {', '.join(_SHORT)} from encounter where organisation_id in (1, 3)"
)


def _group(spark, sf_dir):
    """Members of a tenant group as rows: tenants with a voided user."""
    members = bound(spark, sf_dir, "users").where("is_voided").select("organisation_id")
    return tenant_filter(bound(spark, sf_dir, "encounter"), members).select(*_SHORT)


QUERIES["s2_tenant_group"] = _group
ORACLE["s2_tenant_group"] = with_bindings(
    ["encounter", "users"],
    f"select {', '.join(_SHORT)} from encounter where organisation_id in (select organisation_id from users where is_voided)",
)

QUERIES["s3_delta"] = lambda spark, sf_dir: delta(bound(spark, sf_dir, "encounter"), **WINDOW).select(*_SHORT)
ORACLE["s3_delta"] = with_bindings(["encounter"], f"select {', '.join(_SHORT)} from encounter e where {in_window('e')}")


def _watermarks(spark, sf_dir):
    """Watermarks per (visit kind, tenant) after a run over some of them."""
    store = fresh_store(spark)
    visits = bound(spark, sf_dir, "encounter").select(
        F.concat(F.lit("encounter_"), F.col("encounter_type_id").cast("string")).alias("table_name"),
        F.concat(F.lit("tenant_"), F.col("organisation_id").cast("string")).alias("tenant"),
        "last_modified_date_time",
    )
    done = visits.groupBy("table_name", "tenant").agg(F.max("last_modified_date_time").alias("last_sync_time"))
    early = visits.where("last_modified_date_time < '1998-01-01'")
    first = early.groupBy("table_name", "tenant").agg(F.max("last_modified_date_time").alias("last_sync_time"))
    state.advance_state(store, first.where("tenant <> 'tenant_3'"))
    state.advance_state(store, done.where("tenant = 'tenant_1'"))
    out = state.load_state(store, visits.select("table_name", "tenant").distinct())
    return out.withColumn("last_sync_time", F.col("last_sync_time").cast("timestamp_ntz"))


QUERIES["s4_watermark"] = _watermarks
ORACLE["s4_watermark"] = with_bindings(
    ["encounter"],
    """select 'encounter_' || cast(encounter_type_id as varchar) as table_name, 'tenant_' || cast(organisation_id as varchar) as tenant,
              case organisation_id when 1 then max(last_modified_date_time)
                when 2 then coalesce(max(last_modified_date_time) filter (where last_modified_date_time < timestamp '1998-01-01 00:00:00'), timestamp '1970-01-01 00:00:00')
                else timestamp '1970-01-01 00:00:00' end as last_sync_time,
              case organisation_id when 1 then 'Success' when 2 then
                case when count(*) filter (where last_modified_date_time < timestamp '1998-01-01 00:00:00') > 0 then 'Success' else 'Running' end
                else 'Running' end as sync_status
       from encounter group by encounter_type_id, organisation_id""",
)


def _publish(spark, sf_dir):
    """Two runs of one table: publish, then publish the merged change."""
    from formflow.operators.maintain import upsert_latest

    store = fresh_store(spark)
    table = encounter_spec()
    middle = "1998-01-01 00:00:00"
    first = entities.flatten(context(spark, sf_dir, start=WINDOW["start"], end=middle), table)
    store.publish(first, table.name)
    fresh = entities.flatten(context(spark, sf_dir, start=middle, end=WINDOW["end"]), table)
    merged = upsert_latest(store.read(table.name), fresh, ["id"], "last_modified_date_time")
    return plain(store.publish(merged, table.name))


QUERIES["s5_publish"] = _publish
ORACLE["s5_publish"] = FLAT_ORACLE["e3_encounter"]


def _cutoff(spark, sf_dir):
    """Rows of the second of two derived runs, by stored cut-offs."""
    store = fresh_store(spark)
    state.cutoff_put(store, "tenant_1", "1996-01-01 00:00:00")
    state.cutoff_put(store, "tenant_1", "1998-01-01 00:00:00")
    state.cutoff_put(store, "tenant_2", "1997-01-01 00:00:00")
    rows = bound(spark, sf_dir, "encounter")
    parts = [
        delta(rows, state.cutoff_get(store, f"tenant_{i}"), WINDOW["end"]).where(F.col("organisation_id") == i)
        for i in (1, 2, 3)
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).select(*_SHORT)


QUERIES["s7_cutoff"] = _cutoff
ORACLE["s7_cutoff"] = with_bindings(
    ["encounter"],
    f"""select {', '.join(_SHORT)} from encounter where last_modified_date_time <= timestamp '{WINDOW['end']}'
        and last_modified_date_time > case organisation_id when 1 then timestamp '1998-01-01 00:00:00'
            when 2 then timestamp '1997-01-01 00:00:00' else timestamp '1970-01-01 00:00:00' end""",
)


def _stream(spark, sf_dir):
    """Telemetry as a file stream, the latest sync per user and device kept."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    store = fresh_store(spark)

    def flatten(batch):
        return batch.select(
            F.col("user_id"), F.col("event_type").alias("device_name"), F.col("ts").alias("last_modified_date_time"),
            F.col("event_id").alias("id"), "value",
        )

    stream_sync(source, store, "telemetry_latest", flatten, ["user_id", "device_name"], "last_modified_date_time")
    return store.read("telemetry_latest")


QUERIES["x1_stream_sync"] = _stream
ORACLE["x1_stream_sync"] = """select user_id, event_type as device_name, ts as last_modified_date_time, event_id as id, value
    from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"""
