"""Shards along a Hilbert curve over metadata, so that files can be skipped by any of its dimensions.

Each dimension is cut into 2 ** BITS ranges of about equally many rows; a row's cell in
that grid has an index on the Hilbert curve. Rows are ordered by index, then by a hash,
and the order is cut into runs: of equal row counts, or of equal bytes. The bounds of
the ranges are quantiles: of numbers by an approximate aggregate, of strings by counting
their distinct values, which are dealt by range and added up in order.

The order is global, but no task sorts more than a share of it: the grid has a fixed
number of cells, a cell with more than ``PART_ROWS`` rows is cut by the hash into parts of
about so many, and the row counts of these parts, added up by cell, give each part's first
place. Rows are joined to it by the key that they are dealt by for their order anyway.

Defined results: a null text counts as empty; a null in a dimension is in its first
range; rows equal in all that is used here are in any order among themselves; an empty
table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, staged, text_of

BITS = 4
#: Rows of a part, which is what one task orders.
PART_ROWS = 5_000
#: Pieces in which the distinct values of a string dimension are ordered.
PIECES = 64
DIMENSIONS = ("source", "lang", "n_chars")


def hilbert_index(cell: str, dims: int, bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell, an array of ``dims`` integers of ``bits`` bits."""
    top = 1 << (bits - 1)
    turns = ", ".join(f"named_struct('q', {top >> s}, 'i', {i})" for s in range(bits - 1) for i in range(dims))
    # from the highest bit down: reflect or exchange the lower bits of the first axis and axis i
    turned = f"""aggregate(array({turns}), {cell}, (x, s) -> transform(x, (v, j) -> case
        when (x[s.i] & s.q) <> 0 then if(j = 0, v ^ (s.q - 1), v)
        when j = 0 or j = s.i then v ^ ((x[0] ^ x[s.i]) & (s.q - 1))
        else v end))""" if turns else cell
    # Gray code: each axis takes up those before it
    folded = f"transform(array({turned}), x -> transform(x, (v, j) -> aggregate(slice(x, 1, j + 1), 0, (a, b) -> a ^ b)))[0]"
    masks = ", ".join(str(top >> s) for s in range(bits - 1)) or "1"
    flipped = f"""transform(array({folded}), x -> transform(x, v -> v ^
        aggregate(array({masks}), 0, (t, q) -> if((x[{dims - 1}] & q) <> 0 and q > 1, t ^ (q - 1), t))))[0]"""
    places = ", ".join(f"named_struct('b', {b}, 'i', {i})" for b in reversed(range(bits)) for i in range(dims))
    return F.expr(
        f"transform(array({flipped}), x -> aggregate(array({places}), 0, (n, s) -> n * 2 + (shiftright(x[s.i], s.b) & 1)))[0]"
    )


def _text_bounds(df: DataFrame, name: str) -> list[str]:
    """The values of a string dimension at which its 2 ** BITS ranges end, by rows.

    Values are counted, dealt by range and added up piece by piece; PIECES sums and the bounds come to the driver.
    """
    counts = df.select(F.col(f"`{name}`").alias("value")).where("value is not null").groupBy("value").count()
    dealt = staged(counts.repartitionByRange(PIECES, "value").withColumn("piece", F.spark_partition_id()), "values")
    sums = dealt.groupBy("piece").agg(F.sum("count").alias("n")).orderBy("piece").collect()
    total, before, firsts = sum(r.n for r in sums), 0, []
    for r in sums:
        firsts.append((r.piece, before))
        before += r.n
    if not total:
        return []
    known = df.sparkSession.createDataFrame(firsts, "piece int, before long")
    inside = Window.partitionBy("piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    upto = dealt.withColumn("inside", F.sum("count").over(inside)).join(F.broadcast(known), "piece")  # PIECES rows
    upto = upto.select("value", "count", (F.col("before") + F.col("inside")).alias("upto"))
    steps = 1 << BITS
    # the values within which the rows pass a multiple of total / steps
    crossed = upto.where(F.expr(f"(upto * {steps}) div {total} > ((upto - count) * {steps}) div {total} and upto < {total}"))
    return [r.value for r in crossed.orderBy("value").select("value").collect()]


def _ranges(df: DataFrame, dims: Sequence[str]) -> list[Column]:
    """For each dimension the number of its range; the bounds are a fixed number."""
    steps = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    texts = {d for d in dims if dict(df.dtypes)[d] == "string"}
    numbers = [d for d in dims if d not in texts]
    value = {d: F.col(f"`{d}`") if d in texts else F.col(f"`{d}`").cast("double") for d in dims}
    found = df.agg(*(F.percentile_approx(value[d], steps, 2000).alias(f"d{i}") for i, d in enumerate(numbers))).first() if numbers else []
    bounds = {d: _text_bounds(df, d) for d in texts} | {d: found[i] or [] for i, d in enumerate(numbers)}
    out = []
    for d in dims:
        at = F.lit(0)
        for b in bounds[d]:
            at = at + F.coalesce((value[d] > F.lit(b)).cast("int"), F.lit(0))
        out.append(at)
    return out


def shards(
    docs: DataFrame, count: int, law: str = "rows", dims: Sequence[str] = DIMENSIONS, keep: list[str] | None = None, part_rows: int = PART_ROWS
) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with size, text_crc32, curve index, shard and slot.

    ``law``: ``rows`` (row counts at most one apart) or ``bytes`` (sizes as near as whole rows allow).
    """
    text = text_of("text")
    cell = F.array(*_ranges(docs, dims))
    key = F.xxhash64(*(F.col(f"`{c}`") for c in ("doc_id", *dims)))
    size = F.octet_length(text).cast("long") + 16

    counted = docs.select(cell.alias("cell")).groupBy("cell").count()
    total = counted.agg(F.sum("count")).first()[0] or 0
    # at most 2 ** (BITS * dims) rows, whatever the table
    cells = F.broadcast(
        counted.select(
            "cell",
            hilbert_index("cell", len(dims)).alias("curve"),
            F.ceil(F.col("count") / part_rows).alias("cuts"),
        )
    )
    rows = packed(docs, keep, cell=cell, key=key, size=size, text_crc32=F.crc32(text), doc_id=F.col("doc_id"))
    rows = rows.join(cells, "cell").withColumn("part", F.pmod("key", "cuts")).drop("cell", "cuts")
    narrow = docs.select(cell.alias("cell"), key.alias("key"), (size if law == "bytes" else F.lit(0)).cast("long").alias("size"))
    narrow = narrow.join(cells, "cell").withColumn("part", F.pmod("key", "cuts"))
    sums = narrow.groupBy("curve", "part").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    whole = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each cell, at most 2 ** (BITS * dims)
    of_cell = sums.groupBy("curve").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).select(
        "curve", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("cell_rank"), F.coalesce(F.sum("b").over(whole), F.lit(0)).alias("cell_bytes")
    )
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sums.select(
        "curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b")
    ).join(F.broadcast(of_cell), "curve")
    firsts = firsts.select("curve", "part", (F.col("cell_rank") + F.col("n")).alias("rank0"), (F.col("cell_bytes") + F.col("b")).alias("bytes0"))
    inside = Window.partitionBy("curve", "part").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = rows.join(firsts, ["curve", "part"]).withColumn("rank", F.col("rank0") + F.row_number().over(inside) - 1)
    if law == "rows":
        shard = F.expr(f"rank * {count} div {max(total, 1)}")
        slot = F.col("rank") - F.expr(f"(shard * {total} + {count - 1}) div {count}")
        placed = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
    else:
        weight = docs.agg(F.sum(size)).first()[0] or 1
        running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
        ranked = ranked.withColumn("shard", F.least(F.lit(count - 1), F.floor((F.col("bytes0") + running) * count / weight)).cast("int"))
        firsts_of = F.broadcast(ranked.groupBy("shard").agg(F.min("rank").alias("shard0")))  # one row a shard
        placed = ranked.join(firsts_of, "shard").withColumn("slot", (F.col("rank") - F.col("shard0")).cast("long"))
    return placed.select(ROW, "size", "text_crc32", "curve", "shard", "slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One file for each shard, rows by slot, below ``path/shard=...``."""
    out = placed.select(f"{ROW}.*", "shard", "slot").repartitionByRange("shard").sortWithinPartitions("shard", "slot")
    out.drop("slot").write.partitionBy("shard").parquet(path)
