"""Merging a change into a stored table, month by month."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from formflow.operators.maintain import keep_latest, upsert_latest
from formflow.sources.snapshots import PART, Entry, Store, month_of

Step = Callable[[DataFrame], DataFrame]


def _same(df: DataFrame) -> DataFrame:
    return df


def touched_months(old: DataFrame, keys: DataFrame, key: str, fresh: DataFrame, created: str) -> list[str]:
    """Months that hold a touched key now or get a row of the change.

    Only the key and the month of the old table are read. The answer is at
    most the months of the table's history, a few hundred words.
    """
    held = old.select(key, PART).join(keys, key, "left_semi").select(PART)
    new = fresh.select(F.col(PART) if PART in fresh.columns else month_of(fresh, created).alias(PART))
    return sorted(r[0] for r in held.unionAll(new).distinct().collect())


def merge_months(
    store: Store,
    name: str,
    entry: Entry | None,
    fresh: DataFrame,
    keys: Sequence[str],
    ts: str,
    ties: str = "row_number",
    created: str = "created_date_time",
    touched: DataFrame | None = None,
    prepare: Step = _same,
    finish: Step = _same,
    whole: bool = False,
    dirty: Column | None = None,
) -> Entry:
    """New pieces of a table after a change; other months stay as they are.

    A row's month is that of its ``created`` time, or its ``PART`` column where ``fresh``
    has one.

    ``touched`` are keys, under the name of the first key, whose stored rows
    may change although the change has no row for them; ``dirty`` tells stored rows
    that ``prepare`` would change, whose months are rewritten too. ``prepare`` brings
    stored rows to the wanted columns, ``finish`` is applied to the merged
    rows. ``whole`` rewrites all months.
    """
    if entry is None:
        return store.write_months(finish(keep_latest(fresh, keys, ts, ties)), name, created=created, sort_by=ts)
    old = store.load(entry, with_part=True)
    placed = PART in fresh.columns
    whole = whole or placed and any(piece["parts"] is None for piece in entry)  # written before it had months
    months = None
    if not whole:
        changed = fresh.select(keys[0])
        changed = (changed if touched is None else changed.unionByName(touched)).distinct()
        months = touched_months(old, changed, keys[0], fresh, created)
        if dirty is not None:
            found = old.where(dirty).select(PART).distinct().collect()
            months = sorted({*months, *(r[0] for r in found)})
        if not months:
            return entry
        old = old.where(F.col(PART).isin(months))
    merged = finish(upsert_latest(prepare(old if placed else old.drop(PART)), fresh, keys, ts, ties))
    return store.write_months(merged, name, None if whole else entry, months, created, ts)
