"""The sync as a stream: the checkpoint takes the place of watermarks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from formflow.operators.maintain import keep_latest, upsert_latest
from formflow.plans.merge import merge_months
from formflow.sources.snapshots import Store

APPLIED = "_stream_batches"


def stream_sync(
    source: DataFrame,
    store: Store,
    table: str,
    flatten: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    ts: str,
    ties: str = "row_number",
    created: str | None = None,
    trigger: dict | None = None,
    timeout: float | None = None,
) -> None:
    """Drain a streaming source into a flat table.

    Each micro-batch is flattened and merged by the same operators as a
    batch run. A batch that is replayed after a failure finds its number in
    the manifest, committed together with its table, and changes nothing.
    With ``created``, a time that never changes for a key, only the months
    that a batch touches are written.
    """

    def merge(batch: DataFrame, number: int) -> None:
        applied = store.manifest().get(f"{APPLIED}/{table}")
        if applied is not None and int(applied) >= number:
            return
        fresh = store.stage(flatten(batch), table)
        entry = store.manifest().get(table)
        if created is not None:
            new = merge_months(store, table, entry, fresh, keys, ts, ties, created)
        elif entry is None:
            new = store.write(keep_latest(fresh, keys, ts, ties), table, ts)
        else:
            new = store.write(upsert_latest(store.load(entry), fresh, keys, ts, ties), table, ts)
        store.commit({table: new, f"{APPLIED}/{table}": str(number)})

    query = (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", f"{store.root}/_checkpoint/{table}")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the source of {table} was not drained within {timeout} s; what was merged is committed")
