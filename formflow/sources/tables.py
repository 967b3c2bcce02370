"""Reading source tables: scan, tenant filter, incremental window."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "1970-01-01 00:00:00"


def read_source(spark: SparkSession, root: str, name: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """One source table exported under ``root``."""
    return spark.read.format(fmt).options(**options).load(f"{root.rstrip('/')}/{name}.{fmt}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    id_bounds: tuple[int, int],
    partitions: int,
    predicate: str | None = None,
    **options: str,
) -> DataFrame:
    """One source table straight from the operational database.

    The scan is split into ``partitions`` id ranges so that many executors
    read at once; ``predicate`` (the incremental window) runs in the database.
    """
    source = f"(select * from {table} where {predicate}) t" if predicate else table
    lower, upper = id_bounds
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=source,
            partitionColumn="id",
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            fetchsize="10000",
            **options,
        )
        .load()
    )


def tenant_filter(df: DataFrame, org_ids: Iterable[int] | DataFrame, column: str = "organisation_id") -> DataFrame:
    """Rows of one tenant, or of the members of a tenant group.

    A list becomes a pushed-down ``IN``; member ids given as a DataFrame
    become a semi join.
    """
    if isinstance(org_ids, DataFrame):
        members = org_ids.select(F.col(org_ids.columns[0]).alias(column)).distinct()
        return df.join(members, column, "left_semi")
    return df.where(F.col(column).isin(sorted(org_ids)))


def time_literal(df: DataFrame, column: str, value: str | datetime) -> Column:
    """``value`` as a literal of the column's own timestamp type.

    A literal of another type would cast the column and keep the predicate
    from reaching the Parquet row groups.
    """
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else value
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit(text).cast(kind)
    return F.lit(text)


def delta(
    df: DataFrame,
    start: str | datetime,
    end: str | datetime,
    column: str = "last_modified_date_time",
) -> DataFrame:
    """Rows modified in ``(start, end]``."""
    return df.where(in_window(df, start, end, column))


def in_window(
    df: DataFrame,
    start: str | datetime,
    end: str | datetime,
    column: str = "last_modified_date_time",
) -> Column:
    return (F.col(column) > time_literal(df, column, start)) & (F.col(column) <= time_literal(df, column, end))


class Context:
    """What one run reads: sources, tenants and the window ``(start, end]``."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        start: str | datetime = EPOCH,
        end: str | datetime = "9999-12-31 00:00:00",
        org_ids: Iterable[int] | None = None,
    ):
        self._tables = tables
        self.start = start
        self.end = end
        self.org_ids = None if org_ids is None else sorted(org_ids)

    def table(self, name: str) -> DataFrame:
        """A source table, narrowed to the tenants where it names one."""
        df = self._tables[name]
        if self.org_ids is None or "organisation_id" not in df.columns:
            return df
        return tenant_filter(df, self.org_ids)

    def changed(self, name: str) -> DataFrame:
        """Rows changed in the window, from their staged copy if there is one."""
        staged = f"changed/{name}"
        rows = self._tables[staged] if staged in self._tables else self.table(name)
        return delta(rows, self.start, self.end)
