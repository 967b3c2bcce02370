"""Run state kept beside the tables: sync watermarks and derived cut-offs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.operators.maintain import upsert_latest
from formflow.sources.snapshots import Store
from formflow.sources.tables import EPOCH

STATE_TABLE = "_sync_state"
CUTOFF_TABLE = "_derived_cutoff"
STATE_SCHEMA = "table_name string, tenant string, last_sync_time timestamp, sync_status string"
CUTOFF_SCHEMA = "tenant string, cutoff timestamp"


def empty_state(store: Store) -> DataFrame:
    return store.spark.createDataFrame([], STATE_SCHEMA)


def load_state(store: Store, wanted: DataFrame) -> DataFrame:
    """Watermark for each wanted (table_name, tenant); the epoch if new."""
    known = store.read(STATE_TABLE) if store.exists(STATE_TABLE) else empty_state(store)
    return wanted.select("table_name", "tenant").join(known, ["table_name", "tenant"], "left").select(
        "table_name",
        "tenant",
        F.coalesce("last_sync_time", F.lit(EPOCH).cast("timestamp")).alias("last_sync_time"),
        F.coalesce("sync_status", F.lit("Running")).alias("sync_status"),
    )


def advanced_state(store: Store, done: DataFrame) -> DataFrame:
    """The state with ``done`` (table_name, tenant, last_sync_time) advanced."""
    known = store.read(STATE_TABLE) if store.exists(STATE_TABLE) else empty_state(store)
    fresh = done.select(
        "table_name",
        "tenant",
        F.col("last_sync_time").cast("timestamp").alias("last_sync_time"),
        F.lit("Success").alias("sync_status"),
    )
    return upsert_latest(known, fresh, ["table_name", "tenant"], "last_sync_time")


def advance_state(store: Store, done: DataFrame) -> DataFrame:
    return store.publish(advanced_state(store, done), STATE_TABLE, sort_by=None)


def cutoff_get(store: Store, tenant: str) -> str:
    """Cut-off of the last derived run; the epoch if there was none."""
    if not store.exists(CUTOFF_TABLE):
        return EPOCH
    row = store.read(CUTOFF_TABLE).where(F.col("tenant") == tenant).select(F.col("cutoff").cast("string")).first()
    return row[0] if row else EPOCH


def advanced_cutoff(store: Store, tenant: str, cutoff: str) -> DataFrame:
    """The cut-off table with the tenant's cut-off moved."""
    spark = store.spark
    known = store.read(CUTOFF_TABLE) if store.exists(CUTOFF_TABLE) else spark.createDataFrame([], CUTOFF_SCHEMA)
    fresh = spark.range(1).select(
        F.lit(tenant).alias("tenant"), F.lit(cutoff).cast("timestamp").alias("cutoff")
    )
    others = known.where(F.col("tenant") != tenant)
    return others.unionByName(fresh)


def cutoff_put(store: Store, tenant: str, cutoff: str) -> DataFrame:
    return store.publish(advanced_cutoff(store, tenant, cutoff), CUTOFF_TABLE, sort_by=None)
