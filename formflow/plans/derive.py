"""Derived tables: ordered steps after a sync, driven by a small config."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from formflow.operators import growth
from formflow.operators.growth import ensure_table
from formflow.sources.snapshots import Store
from formflow.sources.state import CUTOFF_TABLE, advanced_cutoff, cutoff_get

# A step reads tables by name and gives the new version of its target.
StepFn = Callable[[Mapping[str, DataFrame], str, str], DataFrame]


@dataclass(frozen=True)
class Table:
    """A derived table to create if it is not there."""

    order: int
    name: str
    schema: T.StructType


@dataclass(frozen=True)
class Source:
    """Steps that follow from one source table: an insert, then updates."""

    order: int
    source: str
    insert: StepFn | str | None = None
    updates: Sequence[StepFn | str] = ()
    params: Sequence[str] = ()


@dataclass(frozen=True)
class Target:
    order: int
    table: str
    sources: Sequence[Source] = ()


@dataclass(frozen=True)
class Config:
    tables: Sequence[Table] = field(default_factory=tuple)
    targets: Sequence[Target] = field(default_factory=tuple)


def load_config(text: str, steps: Mapping[str, StepFn | str], schemas: Mapping[str, T.StructType]) -> Config:
    """A config written as JSON; step and schema names are looked up.

    Keys: ``ddl`` [order, table, sql], ``dml`` [order, table, sqls [order,
    sourceTableName, insert-sql, update-sqls, sql-params]].
    """
    doc = json.loads(text)
    tables = [Table(d["order"], d["table"], schemas[d["sql"]]) for d in doc.get("ddl") or []]
    targets = [
        Target(
            d["order"],
            d["table"],
            [
                Source(
                    s["order"],
                    s["sourceTableName"],
                    steps[s["insert-sql"]] if (s.get("insert-sql") or "").strip() else None,
                    [steps[u] for u in s.get("update-sqls") or []],
                    s.get("sql-params") or [],
                )
                for s in d.get("sqls") or []
            ],
        )
        for d in doc.get("dml") or []
    ]
    return Config(tables, targets)


def _run(
    spark: SparkSession, step: StepFn | str, tables: Mapping[str, DataFrame], prev: str, new: str, params: Sequence[str]
) -> DataFrame:
    if callable(step):
        return step(tables, prev, new)
    # A SQL step: tables are the {names} in it, times and parameters are bound.
    used = {n: df for n, df in tables.items() if "{" + n + "}" in step}
    args = {"previousCutoffDateTime": prev, "newCutoffDateTime": new}
    args |= {f"param{i + 1}": p for i, p in enumerate(params)}
    args = {k: v for k, v in args.items() if f":{k}" in step}
    return spark.sql(step, args=args, **used)


def run_steps(
    spark: SparkSession, config: Config, tables: Mapping[str, DataFrame], prev: str, new: str
) -> dict[str, DataFrame]:
    """The derived tables after all steps, as plans; nothing is written.

    An insert gives rows to append, an update the whole new table.
    """
    tables = dict(tables)
    for table in sorted(config.tables, key=lambda t: t.order):
        if table.name not in tables:
            tables[table.name] = ensure_table(spark, table.schema)
    for target in sorted(config.targets, key=lambda t: t.order):
        for source in sorted(target.sources, key=lambda s: s.order):
            if source.insert is not None:
                rows = _run(spark, source.insert, tables, prev, new, source.params)
                tables[target.table] = tables[target.table].unionByName(rows, allowMissingColumns=True)
            for update in source.updates:
                tables[target.table] = _run(spark, update, tables, prev, new, source.params)
    return {t.table: tables[t.table] for t in config.targets}


def run_derived(store: Store, config: Config, tables: Mapping[str, DataFrame], tenant: str, now: str) -> None:
    """Run all steps over ``(last cut-off, now]`` and publish the result.

    Tables and cut-off become current in one commit: a run that is lost before
    it is repeated over the same window, and one after it is not repeated.
    """
    prev = cutoff_get(store, tenant)
    known = dict(tables)
    for target in config.targets:
        if store.exists(target.table):
            known[target.table] = store.read(target.table)
    result = run_steps(store.spark, config, known, prev, now)
    written = {name: store.write(df, name, sort_by=None) for name, df in result.items()}
    written[CUTOFF_TABLE] = store.write(advanced_cutoff(store, tenant, now), CUTOFF_TABLE, sort_by=None)
    store.commit(written)


def growth_config(
    table: str = "individual_child_growth_monitoring_report",
    subjects: str = "individual",
    enrolments: str = "individual_child",
    followups: str = "individual_child_growth_monitoring",
    admissions: str = "individual_child_nrc_admission",
    members: str = "group_subject",
    households: str = "household",
    address: str = "address",
    as_of: str | None = None,
) -> Config:
    """The growth-monitoring report as ordered steps."""

    def report(tables):
        return tables[table]

    return Config(
        [Table(1, table, growth.report_schema())],
        [
            Target(
                1,
                table,
                [
                    Source(
                        1,
                        followups,
                        lambda t, p, n: growth.growth_insert(t[subjects], t[enrolments], t[followups], p, n),
                        [
                            lambda t, p, n: growth.growth_update(report(t), t[subjects], t[enrolments], t[followups], p, n),
                            lambda t, p, n: growth.apply_fields(report(t), growth.sam_mam(t[followups], p, n)),
                            lambda t, p, n: growth.apply_fields(
                                report(t),
                                growth.relapse(t[subjects], t[enrolments], t[followups], as_of or n[:10], p, n),
                            ),
                        ],
                    ),
                    Source(2, subjects, None, [
                        lambda t, p, n: growth.apply_fields(report(t), growth.subject_fields(t[subjects], t[enrolments], p, n)),
                    ]),
                    Source(3, admissions, None, [
                        lambda t, p, n: growth.apply_fields(report(t), growth.nrc_status(t[admissions], p, n)),
                    ]),
                    Source(4, "address_level", None, [
                        lambda t, p, n: growth.apply_fields(
                            report(t), growth.village_fields(t[subjects], t[address], t[members], t[households])
                        ),
                    ]),
                ],
            )
        ],
    )
