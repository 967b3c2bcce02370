"""Publishing flat tables on plain files.

Parquet files are never changed in place. A table is a list of pieces, each a
folder written by one run, and one small manifest lists the pieces of every
table. A run writes new folders aside and commits one new manifest, so all of
its tables become visible at once or not at all, and a run that dies half-way
leaves only folders that nothing refers to.

Large tables are partitioned by the month a row was created in. A month lives
in exactly one piece; a run rewrites the months it touches and leaves the
folders of all other months alone.

A table that only grows is a list of pieces of different sizes. Pieces of like size
are written together once there are ``FAN`` of them, as digits carry in a counter, so a
row is rewritten a number of times that is logarithmic in the table's size.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

PART = "_month"
#: So many pieces of like size of an append-only table are written together; a size class spans as large a factor.
FAN = 8
#: Smaller pieces are all of one class.
LEAST_BYTES = 1 << 16
#: So many tables of a family are written by the tasks that made their rows; for more, rows are dealt by table first.
FEW_TABLES = 512
#: Folders that nothing refers to are left alone for so long, as a run in progress may yet commit them.
GRACE_HOURS = 24

# A piece is {"folder": path, "parts": [month, ...] or None for all of it, "schema": of its files}.
Entry = list[dict]


def month_of(df: DataFrame, column: str) -> Column:
    """The partition a row belongs to; the same in every session time zone."""
    time = F.col(column).cast("timestamp_ntz")
    if isinstance(df.schema[column].dataType, TimestampType):
        time = F.convert_timezone(None, F.lit("UTC"), time)
    return F.coalesce(F.date_format(time, "'m'yyyy_MM"), F.lit("none"))


def _stored_schema(df: DataFrame) -> dict:
    return df.schema.jsonValue()


def lookup(spark: SparkSession, names: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A few rows of strings as a table of known size. Of rows sent one by one Spark does not know how few they are, and shuffles the
    table that is joined with them."""
    columns = [pa.array([row[i] for row in rows], pa.string()) for i in range(len(names))]
    return spark.createDataFrame(pa.table(columns, names=list(names)))


class Store:
    """Tables and manifest of one tenant schema under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._staged: list[str] = []
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # manifest ---------------------------------------------------------------
    def _versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifest")
        if not self._fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json"))

    def manifest(self) -> dict:
        """Table name to pieces, and named values, as of the last commit."""
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else {}

    def _manifest(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.root}/_manifest/{number:012d}.json"))
        try:
            reader = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils
            return json.loads(reader.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, changes: dict) -> None:
        """Make ``changes`` current in one step; None withdraws a table.

        The new manifest is written aside and renamed to the next number. A
        rename onto a taken number fails, so of two writers one is told.
        """
        versions = self._versions()
        current = {k: v for k, v in {**self.manifest(), **changes}.items() if v is not None}
        number = versions[-1] + 1 if versions else 1
        aside = self._path(f"{self.root}/_manifest/_tmp-{uuid.uuid4().hex}")
        target = self._path(f"{self.root}/_manifest/{number:012d}.json")
        out = self._fs.create(aside)
        try:
            out.write(bytearray(json.dumps(current, sort_keys=True).encode()))
        finally:
            out.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            raise RuntimeError(f"manifest {number} was written by another run")

    # reading ----------------------------------------------------------------
    def exists(self, name: str) -> bool:
        return name in self.manifest()

    def read(self, name: str, with_part: bool = False) -> DataFrame:
        return self.load(self.manifest()[name], with_part)

    def load(self, entry: Entry, with_part: bool = False) -> DataFrame:
        """The rows of a table's pieces."""
        frames = []
        for piece in entry:
            reader = self.spark.read
            if piece.get("schema"):  # no file has to be opened to plan a read
                reader = reader.schema(StructType.fromJson(piece["schema"]))
            if piece["parts"] is None:
                df = reader.parquet(piece["folder"])
                frames.append(df.withColumn(PART, F.lit("none")) if with_part and PART not in df.columns else df)
            else:
                paths = [f"{piece['folder']}/{PART}={p}" for p in piece["parts"]]
                frames.append(reader.option("basePath", piece["folder"]).parquet(*paths))
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return df if with_part else df.drop(PART)

    def load_family(self, entries: dict[str, Entry], tag: str, columns: Sequence[str]) -> DataFrame | None:
        """The common columns of many tables as one scan, with each row's table name in column ``tag``.

        One relation over the folders of all tables, which Spark lists in parallel; the folder of a
        row's file tells its table. None if a piece does not say its schema.
        """
        paths, routes, fields = [], [], {}
        for name, entry in entries.items():
            for piece in entry:
                if not piece.get("schema"):
                    return None
                fields |= {f.name: f for f in StructType.fromJson(piece["schema"]) if f.name in columns and f.name not in fields}
                for path in [piece["folder"]] if piece["parts"] is None else [f"{piece['folder']}/{PART}={p}" for p in piece["parts"]]:
                    if path not in paths:  # the empty tables of a family share a folder
                        paths.append(path)
                        routes.append((path.rsplit("/v=", 1)[-1], name))
        rows = self.spark.read.schema(StructType([fields[c] for c in columns if c in fields])).parquet(*paths)
        place = F.regexp_extract(F.col("_metadata.file_path"), "/v=([^/]+(/[^/]+=[^/]+)?)/[^/]+$", 1)
        known = lookup(self.spark, ["_place", tag], routes)
        return rows.withColumn("_place", place).join(known, "_place").drop("_place")

    # writing ----------------------------------------------------------------
    def write(self, df: DataFrame, name: str, sort_by: str | None = "last_modified_date_time") -> Entry:
        """Write a whole table; not visible before it is committed.

        Rows are sorted inside each task by modified time, which gives row
        groups narrow time ranges for the next run's incremental scans.
        """
        folder = f"{self.root}/{name}/v={uuid.uuid4().hex}"
        if sort_by and sort_by in df.columns:
            df = df.sortWithinPartitions(sort_by)
        df.write.mode("errorifexists").parquet(folder)
        return [{"folder": folder, "parts": None, "schema": _stored_schema(df)}]

    def write_family(self, df: DataFrame, family: str, tag: str, names: Sequence[str]) -> dict[str, Entry]:
        """Write many tables of like columns in one job: the rows of each name in column ``tag`` become its table.

        A task writes a file for each table that it has rows of. Only where there are many tables are
        the whole rows shuffled once more, so that files do not become too many.
        """
        folder = f"{self.root}/{family}/v={uuid.uuid4().hex}"
        dealt = df if len(names) <= FEW_TABLES else df.hint("rebalance", F.col(tag))
        dealt.write.mode("errorifexists").partitionBy(tag).parquet(folder)
        rows = df.drop(tag)
        found = {s.getPath().getName() for s in self._fs.listStatus(self._path(folder))}
        out = {n: [{"folder": f"{folder}/{tag}={n}", "parts": None, "schema": _stored_schema(rows)}] for n in names if f"{tag}={n}" in found}
        empty = self.write(self.spark.createDataFrame([], rows.schema), f"{family}_empty", None) if len(out) < len(names) else None
        return {n: out.get(n, empty) for n in names}

    def write_months(
        self, df: DataFrame, name: str, old: Entry | None = None, touched: Sequence[str] | None = None,
        created: str = "created_date_time", sort_by: str = "last_modified_date_time",
    ) -> Entry:
        """Write the given months; pieces of ``old`` keep all other months.

        Rows are rebalanced by month first: a large month is split over
        tasks and files, small ones share a task.
        """
        folder = f"{self.root}/{name}/v={uuid.uuid4().hex}"
        rows = df if PART in df.columns else df.withColumn(PART, month_of(df, created))
        if sort_by not in rows.columns:
            sort_by = PART
        rows = rows.hint("rebalance", F.col(PART)).sortWithinPartitions(PART, sort_by)
        rows.write.mode("errorifexists").partitionBy(PART).parquet(folder)
        written = [
            s.getPath().getName().split("=", 1)[1]
            for s in self._fs.listStatus(self._path(folder))
            if s.getPath().getName().startswith(f"{PART}=")
        ]
        gone = set(touched or []) | set(written)
        kept = []
        for piece in old or []:
            # a piece without months is the empty table
            parts = [p for p in piece["parts"] or [] if p not in gone]
            if parts:
                kept.append(piece | {"parts": parts})
        if written:
            kept.append({"folder": folder, "parts": sorted(written), "schema": _stored_schema(df.drop(PART))})
        # a table without rows still has columns
        return kept or self.write(self.spark.createDataFrame([], df.schema), name, None)

    def size(self, piece: dict) -> int:
        """Bytes of a piece's files."""
        folders = [piece["folder"]] if piece["parts"] is None else [f"{piece['folder']}/{PART}={p}" for p in piece["parts"]]
        return sum(self._fs.getContentSummary(self._path(f)).getLength() for f in folders)

    def append(self, df: DataFrame, name: str, old: Entry | None = None, **how) -> Entry:
        """Add rows to a table that only grows.

        While some ``FAN`` pieces are of one size class they become one piece of the next;
        larger pieces are not read or written.
        """
        entry = [dict(piece) for piece in [*(old or []), *self.write(df, name, **how)]]
        for piece in entry:
            if "bytes" not in piece:
                piece["bytes"] = self.size(piece)
        while True:
            classes: dict[int, Entry] = {}
            for piece in entry:
                level = int(math.log(max(piece["bytes"], LEAST_BYTES) / LEAST_BYTES, FAN))
                classes.setdefault(level, []).append(piece)
            full = next((c for _, c in sorted(classes.items()) if len(c) >= FAN), None)
            if full is None:
                return entry
            (one,) = self.write(self.load(full), name, **how)
            # files of few rows shrink when written together: at least the sum's class, so that classes fill up
            one["bytes"] = max(self.size(one), sum(max(p["bytes"], LEAST_BYTES) for p in full))
            entry = [p for p in entry if p not in full] + [one]

    def stage(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """Write rows that several plans of this run read, and read them back.

        The folder is shared storage, so losing an executor costs a re-read.
        """
        folder = f"{self.root}/_staged/{uuid.uuid4().hex}/{name}"
        self._staged.append(folder)
        writer = df.write
        if partition_by:
            writer = df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by)
        writer.parquet(folder)
        return self.spark.read.schema(df.schema).parquet(folder)

    def release_staged(self) -> None:
        """Delete what this object has staged. Only once nothing that reads it is left to run."""
        while self._staged:
            self._fs.delete(self._path(self._staged.pop()).getParent(), True)

    def vacuum(self, keep: int = 2, grace_hours: float = GRACE_HOURS) -> list[str]:
        """Delete folders of pieces that none of the newest ``keep`` manifests lists, and older manifests; returns the folders.

        Folders younger than ``grace_hours`` stay: a run in progress may yet commit them, and a
        reader of an older manifest may still be at work.
        """
        versions = self._versions()
        used = set()
        for number in versions[-keep:]:
            for entry in self._manifest(number).values():
                used |= {piece["folder"].rsplit("/v=", 1)[-1].split("/")[0] for piece in entry if isinstance(piece, dict)} if isinstance(entry, list) else set()
        latest = time.time() * 1000 - grace_hours * 3_600_000
        gone = []
        for table in self._fs.listStatus(self._path(self.root)) if self._fs.exists(self._path(self.root)) else []:
            name = table.getPath().getName()
            if not table.isDirectory() or name == "_manifest":
                continue
            for folder in self._fs.listStatus(table.getPath()):
                found = folder.getPath().getName()
                unused = name == "_staged" or found.startswith("v=") and found[2:] not in used
                if unused and folder.getModificationTime() <= latest:
                    gone.append(f"{name}/{found}")
                    self._fs.delete(folder.getPath(), True)
        for number in versions[:-keep]:
            self._fs.delete(self._path(f"{self.root}/_manifest/{number:012d}.json"), False)
        return gone

    def publish(self, df: DataFrame, name: str, **how) -> DataFrame:
        """Write, commit and read back one table."""
        self.commit({name: self.write(df, name, **how)})
        return self.read(name)
