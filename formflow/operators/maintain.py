"""Changing tables that are made of immutable files.

Every mutation is a function from the old table to the new one. The old
table is large and the change is small, so the change is what gets shuffled
or broadcast: rows of untouched keys pass through an anti join only.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formflow.functions.obs import ANSWER_SEPARATOR


def _stable_order(df: DataFrame, skip: Sequence[str]) -> list[Column]:
    """A tie-break that a re-run of a lost task decides the same way."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in skip]
    return [F.xxhash64(*rest)] if rest else []


def _same(left: str, right: str, columns: Iterable[str]) -> Column:
    pairs = (F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns)
    return reduce(lambda a, b: a & b, pairs)


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: str = "row_number",
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """The newest rows per key; a null time is the newest.

    ``row_number`` keeps one row per key. Its filter is pushed below the
    shuffle as a per-task group limit, so a hot key sends one row per task.

    ``rank`` keeps every row of the newest time. It compares each row with
    the key's newest time, found by an aggregate with map-side combine, in a
    join that AQE can split when a key is hot; no group is gathered.
    """
    if ties == "row_number":
        order = [F.col(f"`{ts}`").desc_nulls_first()]
        order += list(tie_break) if tie_break is not None else _stable_order(df, [*keys, ts])
        window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
    if ties != "rank":
        raise ValueError(f"ties must be 'row_number' or 'rank', not {ties!r}")
    time = F.col(f"`{ts}`")
    top = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.when(F.bool_or(time.isNull()), F.lit(None)).otherwise(F.max(time)).alias(ts)
    )
    return df.alias("l").join(top.alias("r"), _same("l", "r", [*keys, ts]), "left_semi")


def upsert_latest(
    old: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: str = "row_number",
    tie_break: Sequence[Column] | None = None,
) -> DataFrame:
    """``old`` with the rows of ``fresh`` merged in, newest per key kept.

    ``old`` holds no outdated rows itself, so only keys that occur in
    ``fresh`` are compared. With a small change both joins broadcast its keys
    and the old table is never shuffled.
    """
    touched = fresh.select(*keys).distinct()
    hit = old.alias("l").join(touched.alias("r"), _same("l", "r", keys), "left_semi")
    rest = old.alias("l").join(touched.alias("r"), _same("l", "r", keys), "left_anti")
    merged = keep_latest(hit.unionByName(fresh, allowMissingColumns=True), keys, ts, ties, tie_break)
    return rest.unionByName(merged, allowMissingColumns=True)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[Column] = (),
) -> DataFrame:
    """``UPDATE target SET columns FROM source``; a match sets nulls too.

    Where several source rows match, the first in ``order`` is taken, then
    the first by a hash of the row, so the result does not depend on timing.
    """
    fresh = source.select(*[F.col(f"`{c}`") for c in [*keys, *columns]])
    rank = [*order, *_stable_order(fresh, keys)]
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*rank)
    picked = (
        fresh.withColumn("_rn", F.row_number().over(window))
        .where("_rn = 1")
        .select(
            *[F.col(f"`{k}`") for k in keys],
            *[F.col(f"`{c}`").alias(f"_new_{i}") for i, c in enumerate(columns)],
            F.lit(True).alias("_hit"),
        )
    )
    place = {c: i for i, c in enumerate(columns)}
    out = [
        F.when(F.col("_hit"), F.col(f"_new_{place[c]}")).otherwise(F.col(f"`{c}`")).alias(c)
        if c in place
        else F.col(f"`{c}`")
        for c in target.columns
    ]
    return target.join(picked, list(keys), "left").select(*out)


def delete_matching(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DELETE FROM target USING source`` on equal keys."""
    return target.join(source.select(*keys), list(keys), "left_anti")


def drop_uncancelled(cancel: DataFrame, primary: DataFrame) -> DataFrame:
    """Cancellations whose visit is no longer cancelled go."""
    return delete_matching(cancel, primary.where(F.col("cancel_date_time").isNull()), ["id"])


def drop_unexited(exits: DataFrame, enrolments: DataFrame) -> DataFrame:
    """Exits whose enrolment is no longer exited go."""
    return delete_matching(exits, enrolments.where(F.col("program_exit_date_time").isNull()), ["id"])


STATUS_KEYS = ["entity_type", "entity_id"]


def current_statuses(approvals: DataFrame, statuses: DataFrame) -> DataFrame:
    """The latest live approval status of every entity, with its id and time."""
    named = statuses.select(F.col("id").alias("approval_status_id"), "status")
    live = approvals.where(~F.col("is_voided")).join(named, "approval_status_id")
    return _newest_status(live.select("id", *STATUS_KEYS, "status_date_time", "status"))


def _newest_status(rows: DataFrame) -> DataFrame:
    return keep_latest(rows, STATUS_KEYS, "status_date_time", tie_break=[F.col("id").desc()])


def newest_statuses(approvals: DataFrame, statuses: DataFrame) -> DataFrame:
    """The latest live approval status of every entity, by entity type."""
    return current_statuses(approvals, statuses).where(F.col("status").isNotNull()).select(*STATUS_KEYS, "status")


def fold_statuses(state: DataFrame, window: DataFrame, history: DataFrame, statuses: DataFrame) -> DataFrame:
    """Newest statuses of the entities that ``window`` touches, from the stored ``state`` of :func:`current_statuses`.

    A status is newer or it is not, so the window's rows are folded into the state. Only where the
    window edits or voids the very row that is current, that entity is worked out from ``history``.
    An entity that is left without a status gives no row.
    """
    touched = window.select(*STATUS_KEYS).distinct()
    edited = state.join(window.select("id").distinct(), "id", "left_semi").select(*STATUS_KEYS)
    known = state.join(touched, STATUS_KEYS, "left_semi").join(edited, STATUS_KEYS, "left_anti")
    # rows whose id has been edited before it was current are in the window as they are now
    fresh = current_statuses(window.join(edited, STATUS_KEYS, "left_anti"), statuses)
    folded = _newest_status(known.unionByName(fresh.select(known.columns)))
    if edited.isEmpty():
        return folded
    again = current_statuses(history.join(edited, STATUS_KEYS, "left_semi"), statuses)
    return folded.unionByName(again)


def set_approval(target: DataFrame, newest: DataFrame, entity_type: str) -> DataFrame:
    """``target`` with the status of its entities; without one, as before."""
    column = "latest_approval_status"
    old = F.col(column) if column in target.columns else F.lit(None).cast("string")
    keep = [F.col(f"`{c}`") for c in target.columns if c != column]
    mine = newest.where(F.col("entity_type") == entity_type).select(
        F.col("entity_id").alias("id"), F.col("status").alias("_status")
    )
    return target.join(mine, "id", "left").select(*keep, F.coalesce("_status", old).alias(column))


def latest_approval(target: DataFrame, approvals: DataFrame, statuses: DataFrame, entity_type: str) -> DataFrame:
    """``target`` with ``latest_approval_status`` brought up to date."""
    mine = approvals.where(F.col("entity_type") == entity_type)
    return set_approval(target, newest_statuses(mine, statuses), entity_type)


def compose_renames(migrations: Sequence[tuple[str, str]]) -> dict[str, str]:
    """Ordered (old, new) answer names as one lookup from first to last name."""
    lookup: dict[str, str] = {}
    for old, new in migrations:
        lookup = {first: (new if last == old else last) for first, last in lookup.items()}
        lookup.setdefault(old, new)
    return {first: last for first, last in lookup.items() if first != last}


def _renamed(name: Column, lookup: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in lookup.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), name)


def rename_single(df: DataFrame, column: str, migrations: Sequence[tuple[str, str]]) -> DataFrame:
    """Answer renames, in order, on a single-select column."""
    lookup = compose_renames(migrations)
    if not lookup:
        return df
    return df.withColumn(column, _renamed(F.col(f"`{column}`"), lookup))


def holds_any(column: str, names: Iterable[str], many: bool) -> Column:
    """Whether an answer column holds one of the names, so that a rename would change the row."""
    names = sorted(names)
    if not many:
        return F.col(f"`{column}`").isin(names)
    return F.coalesce(F.arrays_overlap(F.split(F.col(f"`{column}`"), ANSWER_SEPARATOR), F.array(*map(F.lit, names))), F.lit(False))


def rename_multi(df: DataFrame, column: str, migrations: Sequence[tuple[str, str]]) -> DataFrame:
    """Answer renames, in order, on whole elements of a multi-select column."""
    lookup = compose_renames(migrations)
    if not lookup:
        return df
    parts = F.split(F.col(f"`{column}`"), ANSWER_SEPARATOR)
    return df.withColumn(
        column, F.array_join(F.transform(parts, lambda x: _renamed(x, lookup)), ANSWER_SEPARATOR)
    )
