"""Comparing stored specs with newly derived ones, and evolving the data.

Specs are a list of :class:`TableSpec` where a plan is made for each table, or rows of
``SPEC_SCHEMA``, one per column, where there may be any number of tables: rows are gathered,
merged, saved and read by Spark and never come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from formflow.functions.naming import voided_name
from formflow.model import ColumnSpec, TableSpec, spark_type
from formflow.sources.snapshots import Entry, Store

SPEC_TABLE = "_specs"
# --- fixed values -----------------------------------------------------------
# In which order the changes of one table are made.
CHANGE_ORDER = ("create", "rename_table", "void_column", "rename_column", "alter_type", "add_column")
# --- end of fixed values ----------------------------------------------------

_TABLE_KEYS = (
    "type", "subject_type_uuid", "program_uuid", "encounter_type_uuid", "group_subject_type_uuid",
    "member_subject_type_uuid", "repeat_uuid",
)
SPEC_SCHEMA = (
    "table_name string, type string, subject_type_uuid string, program_uuid string, "
    "encounter_type_uuid string, form_uuid string, group_subject_type_uuid string, "
    "member_subject_type_uuid string, repeat_uuid string, position int, column_name string, "
    "column_type string, concept_id long, concept_type string, concept_uuid string, "
    "parent_uuid string, parent_name string, voided boolean, role string"
)
SPEC_COLUMNS = tuple(field.split()[0] for field in SPEC_SCHEMA.split(", "))


@dataclass(frozen=True)
class Change:
    """One step from the stored table to the wanted one."""

    kind: str
    table: str
    column: str | None = None
    new_name: str | None = None
    new_type: str | None = None


#: Specs of the tables of one run, or rows of any number of tables.
Specs = Sequence[TableSpec] | DataFrame


def spec_rows(spark: SparkSession, specs: Specs) -> DataFrame:
    """Specs as rows, one per column; a table without columns keeps one."""
    if isinstance(specs, DataFrame):
        return specs.select(*SPEC_COLUMNS)
    rows = []
    for spec in specs:
        table = asdict(spec)
        columns = table.pop("columns")
        head = [table.pop("name"), *[table[k] for k in (
            "type", "subject_type_uuid", "program_uuid", "encounter_type_uuid", "form_uuid",
            "group_subject_type_uuid", "member_subject_type_uuid", "repeat_uuid",
        )]]
        for i, c in enumerate(columns or [None]):
            tail = [None] * 9 if c is None else [
                c["name"], c["type"], c["concept_id"], c["concept_type"], c["concept_uuid"],
                c["parent_uuid"], c["parent_name"], c["voided"], c["role"],
            ]
            rows.append([*head, i, *tail])
    return spark.createDataFrame(rows, SPEC_SCHEMA)


def _tables(rows: DataFrame, *also: str) -> DataFrame:
    """Spec rows gathered by table (name and identity), and by the columns ``also``: places without gaps, one form for a table."""
    table = Window.partitionBy(*also, "table_name", *_TABLE_KEYS)
    order = table.orderBy("position", "column_name", "concept_id", "parent_uuid", "concept_uuid", "form_uuid")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = rows.withColumns(
        {
            "_before": F.count("column_name").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            "_all": F.count("column_name").over(whole),
            "_first": F.row_number().over(order) == 1,
            "form_uuid": F.last("form_uuid").over(whole),
        }
    )
    named = F.col("column_name").isNotNull()
    place = F.greatest(F.col("_before") - 1, F.lit(0)).cast("int")
    found = found.where(named | (F.col("_first") & (F.col("_all") == 0)))
    return found.withColumns({"position": place, "voided": F.when(named, F.coalesce("voided", F.lit(False)))}).drop("_before", "_first")


def specs_of(rows: DataFrame) -> DataFrame:
    """Spec rows in any order and place, by table: the columns of each in order of their positions.

    The rows of one name and identity are one table, whose form is its last row's.
    """
    return _tables(rows).select(*SPEC_COLUMNS)


def collected(rows: DataFrame) -> list[TableSpec]:
    """The inverse of :func:`spec_rows` on the driver, for the tables of one run."""
    tables: dict[tuple, list] = {}
    heads: dict[tuple, TableSpec] = {}
    for r in rows.orderBy("table_name", "position").collect():
        spec = TableSpec(
            r["table_name"], r["type"], r["subject_type_uuid"], r["program_uuid"], r["encounter_type_uuid"],
            r["form_uuid"], r["group_subject_type_uuid"], r["member_subject_type_uuid"], r["repeat_uuid"],
        )
        key = (spec.name, spec.identity)
        heads[key] = spec
        found = tables.setdefault(key, [])
        if r["column_name"] is not None:
            found.append(ColumnSpec(
                r["column_name"], r["column_type"], r["concept_id"], r["concept_type"], r["concept_uuid"],
                r["parent_uuid"], r["parent_name"], bool(r["voided"]), r["role"],
            ))
    return [replace(heads[k], columns=tuple(c)) for k, c in tables.items()]


def save_specs(store: Store, specs: Specs) -> Entry:
    """Write the specs as a snapshot; visible once its folder is committed."""
    return store.write(spec_rows(store.spark, specs), SPEC_TABLE, sort_by=None)


def stored_specs(store: Store) -> DataFrame:
    """The stored specs as rows; none if nothing is stored."""
    return store.read(SPEC_TABLE) if store.exists(SPEC_TABLE) else store.spark.createDataFrame([], SPEC_SCHEMA)


def load_specs(store: Store) -> list[TableSpec]:
    return collected(stored_specs(store)) if store.exists(SPEC_TABLE) else []


def _key(columns: Sequence[str]) -> Column:
    """Null-safe join key over nullable identity columns."""
    return F.concat_ws("\x01", *[F.coalesce(F.col(c), F.lit("\x00")) for c in columns])


def _column_key() -> Column:
    """Columns are the same by question and group, or by name if neither."""
    by_name = F.concat(F.lit("n\x01"), F.col("column_name"))
    by_question = F.concat_ws("\x01", F.lit("q"), F.coalesce("parent_uuid", F.lit("\x00")), F.col("concept_uuid"))
    return F.when(F.col("concept_uuid").isNull(), by_name).otherwise(by_question)


def diff_rows(old: DataFrame, new: DataFrame, group_member: bool = False) -> DataFrame:
    """What changed between two sets of spec rows, one row per change.

    Tables and columns meet in full outer joins on their uuids, so a new
    name is a rename. Nothing is dropped: a question that is gone renames
    its column to ``voided_<name>``, unless the tenant is part of a group.
    """
    tables = lambda df, p: (
        df.select(_key(_TABLE_KEYS).alias("tk"), F.col("table_name").alias(f"{p}_table"), F.col("type").alias(f"{p}_type")).distinct()
    )
    both = tables(old, "old").join(tables(new, "new"), "tk", "full")
    none = F.lit(None).cast("string")
    table_changes = both.where(F.col("new_table").isNotNull()).select(
        F.when(F.col("old_table").isNull(), "create")
        .when(F.col("old_table") != F.col("new_table"), "rename_table")
        .alias("kind"),
        F.coalesce("old_table", "new_table").alias("table"),
        none.alias("column"),
        F.col("new_table").alias("new_name"),
        none.alias("new_type"),
    ).where(F.col("kind").isNotNull())

    columns = lambda df, p: df.where(F.col("column_name").isNotNull()).select(
        _key(_TABLE_KEYS).alias("tk"),
        _column_key().alias("ck"),
        F.col("column_name").alias(f"{p}_name"),
        F.col("column_type").alias(f"{p}_type"),
        F.col("voided").alias(f"{p}_voided"),
        F.col("concept_uuid").alias(f"{p}_concept"),
    )
    kept = both.where(F.col("old_table").isNotNull() & F.col("new_table").isNotNull()).select("tk", F.col("new_table").alias("table"))
    met = columns(old, "old").join(columns(new, "new"), ["tk", "ck"], "full")
    gone = F.col("new_name").isNull() & ~F.coalesce("old_voided", F.lit(False))
    both_there = F.col("old_name").isNotNull() & F.col("new_name").isNotNull()
    retyped = both_there & (F.col("old_type") != F.col("new_type"))
    change = lambda kind, column, name, type_: F.struct(
        F.lit(kind).alias("kind"), column.alias("column"), name.alias("new_name"), type_.alias("new_type")
    )
    found = F.array_compact(
        F.array(
            F.when(
                gone & F.lit(not group_member),
                change("void_column", F.col("old_name"), F.concat(F.lit(voided_name("")), "old_name"), none),
            ),
            F.when(
                both_there & (F.col("old_name") != F.col("new_name")),
                change("rename_column", F.col("old_name"), F.col("new_name"), none),
            ),
            F.when(
                retyped & F.col("new_concept").isNull(),
                change("alter_type", F.col("new_name"), none, F.col("new_type")),
            ),
            F.when(
                retyped & F.col("new_concept").isNotNull(),
                change("forbidden_type", F.col("new_name"), F.col("old_type"), F.col("new_type")),
            ),
            F.when(F.col("old_name").isNull(), change("add_column", F.col("new_name"), none, F.col("new_type"))),
        )
    )
    # only what changed meets the tables, not every column
    column_changes = met.select("tk", F.explode(found).alias("c")).join(kept, "tk").select(
        "c.kind", "table", "c.column", "c.new_name", "c.new_type"
    )
    return table_changes.unionByName(column_changes)


def diff(spark: SparkSession, old: Sequence[TableSpec], new: Sequence[TableSpec], group_member: bool = False) -> list[Change]:
    """Ordered changes; raises where a question changed its data type."""
    rows = diff_rows(spec_rows(spark, old), spec_rows(spark, new), group_member).collect()
    changes = [Change(*[r[c] for c in ("kind", "table", "column", "new_name", "new_type")]) for r in rows]
    for c in changes:
        if c.kind == "forbidden_type":
            raise ValueError(f"data type of a question changed: {c.table}.{c.column} from {c.new_name} to {c.new_type}")
    return sorted(changes, key=lambda c: (c.table, CHANGE_ORDER.index(c.kind), c.column or ""))


def merge_specs(old: Specs, new: Specs, group_member: bool = False) -> Specs:
    """The new specs plus the voided columns that the data still has; both as lists or both as rows."""
    if isinstance(new, DataFrame):
        return specs_of(new) if group_member else _merged_rows(old, new)
    stored = {s.identity: s for s in old}
    return [s if group_member or s.identity not in stored else _with_voided(stored[s.identity], s) for s in new]


def _merged_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """As :func:`merge_specs`, of rows: both sides are dealt by identity once, and compared where they are.

    If several stored tables have one identity, the last by name counts.
    """
    sides = old.select(*SPEC_COLUMNS, F.lit(True).alias("_old")).unionByName(new.select(*SPEC_COLUMNS, F.lit(False).alias("_old")))
    rows = _tables(sides.repartition(*_TABLE_KEYS), "_old")
    whole = Window.partitionBy(*_TABLE_KEYS)
    head = F.struct("table_name", "form_uuid", F.col("_all").cast("int").alias("size"))
    rows = rows.withColumns(
        {
            "_stored": F.max(F.when(F.col("_old"), F.struct("table_name"))).over(whole),
            "_heads": F.collect_list(F.when(~F.col("_old") & (F.col("position") == 0), head)).over(whole),
        }
    )
    # each stored column beside the columns of each new table
    rows = rows.where(~F.col("_old") | F.col("column_name").isNotNull() & F.col("_stored.table_name").eqNullSafe(F.col("table_name")))
    rows = rows.withColumn("_head", F.explode(F.when(F.col("_old"), F.col("_heads")).otherwise(F.array(head))))
    rows = rows.withColumns({"_ck": _column_key(), "table_name": F.col("_head.table_name"), "form_uuid": F.col("_head.form_uuid")})
    table = Window.partitionBy(*_TABLE_KEYS, "table_name")
    column = Window.partitionBy(*_TABLE_KEYS, "table_name", "_ck")
    rows = rows.withColumn("_gone", F.min("_old").over(column) & F.col("column_name").isNotNull())
    order = table.orderBy("_old", "position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"_place": F.count_if("_gone").over(order).cast("int") - 1, "_any": F.max("_gone").over(table)})
    # a new table of no columns has those that are gone
    rows = rows.where(F.when(F.col("_old"), F.col("_gone")).otherwise(F.col("column_name").isNotNull() | ~F.col("_any")))
    out = {
        "column_name": F.when(F.col("_gone") & ~F.col("voided"), F.concat(F.lit(voided_name("")), "column_name")).otherwise(F.col("column_name")),
        "voided": F.col("_gone") | F.col("voided"),
        "position": F.when(F.col("_gone"), F.col("_head.size") + F.col("_place")).otherwise(F.col("position")),
    }
    return rows.withColumns(out).select(*SPEC_COLUMNS)


def _with_voided(old: TableSpec, new: TableSpec) -> TableSpec:
    key = lambda c: ("n", c.name) if c.concept_uuid is None else ("q", c.parent_uuid, c.concept_uuid)
    live = {key(c) for c in new.columns}
    gone = [c for c in old.columns if key(c) not in live]
    return new.with_columns(
        *[replace(c, name=c.name if c.voided else voided_name(c.name), voided=True) for c in gone]
    )


def evolve(df: DataFrame, changes: Sequence[Change]) -> DataFrame:
    """One table's data brought to its new columns, in one projection."""
    columns: dict[str, Column] = {c: F.col(f"`{c}`") for c in df.columns}
    for kind in CHANGE_ORDER[2:]:
        wanted = [c for c in changes if c.kind == kind]
        if kind in ("void_column", "rename_column"):
            # renames may swap names, so they are made all at once
            names = {c.column: c.new_name for c in wanted}
            columns = {names.get(name, name): value for name, value in columns.items()}
        for c in wanted:
            if kind == "alter_type" and c.column in columns:
                columns[c.column] = columns[c.column].cast(spark_type(c.new_type))
            elif kind == "add_column":
                columns.setdefault(c.column, F.lit(None).cast(spark_type(c.new_type)))
    return df.select(*[value.alias(name) for name, value in columns.items()])


def conform(df: DataFrame, spec: TableSpec, also: Sequence[str] = ()) -> DataFrame:
    """Rows in the columns and types of a spec, and the columns ``also``; missing columns are null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in spec.columns:
        wanted = spark_type(c.type)
        if c.name not in have:
            out.append(F.lit(None).cast(wanted).alias(c.name))
        elif have[c.name] == wanted:
            out.append(F.col(f"`{c.name}`"))
        else:
            out.append(F.col(f"`{c.name}`").cast(wanted).alias(c.name))
    return df.select(*out, *also)
