"""The cache tables on shared storage: Parquet base in key ranges, change log, commits, latest-wins view."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.operators.mutate import apply_changes, fold_changes
from recordtide.schemas import CACHE_TABLES, payload_columns

# The base is sorted by this column, so that readers of a key range skip row groups.
_CLUSTERED_BY = {"schedule_blocks": "schedule_id", "references": "spot"}

#: Rows of a base file at most.
ROWS_PER_FILE = 1_000_000
_LEAST = -(2**63)

_PENDING = "pending"

#: The index of references (``sources/references.py``), kept and committed like a table.
REFERENCES = "references"
_REFERENCES_SCHEMA = T.StructType(
    [
        T.StructField("spot", T.LongType()), T.StructField("target", T.StringType()), T.StructField("fk", T.LongType()),
        T.StructField("child", T.StringType()), T.StructField("id", T.LongType()), T.StructField("column", T.StringType()),
        T.StructField("cluster", T.LongType()),
    ]
)
_PENDING_SCHEMA = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("id", T.LongType()), T.StructField("batch_id", T.LongType())]
)
_COMMITS = T.StructType(
    [
        T.StructField("table", T.StringType()), T.StructField("attempt", T.StringType()), T.StructField("stamp", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
_COMPACTIONS = T.StructType(
    [T.StructField("table", T.StringType()), T.StructField("upto", T.LongType()), T.StructField("manifest", T.StringType())]
)
_MANIFEST = T.StructType(
    [
        T.StructField("path", T.StringType()), T.StructField("low", T.LongType()), T.StructField("high", T.LongType()),
        T.StructField("n_rows", T.LongType()),
    ]
)


def clustering_key(table: str) -> str:
    """The column by whose ranges the base of a table is laid out."""
    return _CLUSTERED_BY.get(table, "id")


def _schema(table: str) -> T.StructType:
    if table == REFERENCES:
        return _REFERENCES_SCHEMA
    return T.StructType([T.StructField(f.name, f.dataType) for f in CACHE_TABLES[table]])


def _log_schema(table: str) -> T.StructType:
    if table == _PENDING:
        return _PENDING_SCHEMA
    if table == REFERENCES:
        return T.StructType([*_REFERENCES_SCHEMA, T.StructField("batch_id", T.LongType())])
    return T.StructType(
        [*_schema(table), T.StructField("deleted", T.BooleanType()), T.StructField("batch_id", T.LongType())]
    )


def range_of(key: Column, lows: list[int]) -> Column:
    """Number of the key range that holds ``key``, given the ranges' least keys in order: a binary search.

    Keys below all of them belong to range 0, as do nulls. There is one range per base file or fewer.
    """
    if len(lows) < 2:
        return F.lit(0)
    bounds = F.lit(list(lows)).cast("array<bigint>")

    def halve(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"] + 1, 1)
        right = F.coalesce(F.get(bounds, middle) <= key, F.lit(False))
        return F.struct(F.when(right, middle).otherwise(span["low"]).alias("low"), F.when(right, span["high"]).otherwise(middle - 1).alias("high"))

    whole = F.struct(F.lit(0).alias("low"), F.lit(len(lows) - 1).alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(lows).bit_length())), whole, halve)["low"]


@dataclass(frozen=True)
class Snapshot:
    """The committed state of the cache at one moment. Later batches and compactions do not show in it."""

    cache: Cache
    upto: dict[str, int]
    bases: dict[str, list[T.Row]]
    logs: dict[str, list[tuple[int, str]]]

    def log(self, table: str) -> DataFrame:
        """Committed changes behind the base."""
        folder, schema = f"{self.cache.root}/log/{table}", _log_schema(table)
        return self.cache.read_files([f"{folder}/batch_id={n}/{attempt}" for n, attempt in self.logs[table]], schema, folder)

    def base(self, table: str) -> DataFrame:
        return self.cache.read_files([row["path"] for row in self.bases[table]], _schema(table))

    def near(self, table: str, keys: DataFrame) -> DataFrame:
        """The base rows of the files whose range may hold one of ``keys``, a written frame of values of the clustering key."""
        groups = _groups(self.bases[table])
        place = range_of(F.col(keys.columns[0]), [group[0]["low"] for group in groups])
        held = sorted(row["n"] for row in keys.select(place.alias("n")).distinct().collect()) if groups else []  # at most one per file
        return self.cache.read_files([file["path"] for n in held for file in groups[n]], _schema(table))

    def rows_of(self, table: str, keys: DataFrame) -> DataFrame:
        """Current rows of some ids, read from the base files near them and the log behind the base.

        ``keys`` is a written frame with ``id`` and, where the table is laid out by another column, that column as ``cluster``.
        A row is sure to be found if it has that value of the column or was changed since the last compaction.
        """
        ids = keys.select("id").distinct()
        stored = self.near(table, keys.select("cluster" if clustering_key(table) != "id" else "id")).join(ids, "id", "left_semi")
        changes = self.log(table).where(F.col("batch_id") > self.upto[table]).join(ids, "id", "left_semi")
        return apply_changes(stored, changes, "id", F.col("batch_id"), payload_columns(table))

    def scan(self, table: str) -> DataFrame:
        changes = self.log(table).where(F.col("batch_id") > self.upto[table])
        return apply_changes(self.base(table), changes, "id", F.col("batch_id"), payload_columns(table))


class Cache:
    """All cache tables under one root folder.

    A batch writes its changes to folders of its own, per table and attempt, and then one commit file that names them all.
    Readers go by commits: what is not committed does not exist for them, so the tables of a batch become visible together,
    and a batch that died half-way is invisible until its replay commits. Nothing is ever overwritten while it may be read.

    The base of a table is a list of files with key ranges, its manifest. A compaction rewrites the files whose ranges hold
    changed keys, and writes a new manifest that names the new files and the untouched old ones.
    """

    def __init__(self, spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows_per_file = rows_per_file
        self._staged: dict[int, list[tuple[str, str]]] = {}

    def _read(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read_files(self, paths: list[str], schema: T.StructType, base: str | None = None) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        return (reader.option("basePath", base) if base else reader).parquet(*paths)

    # --- Batches ---

    @contextmanager
    def transaction(self, batch_id: int) -> Iterator[None]:
        """What is written for ``batch_id`` inside becomes visible at the end, all at once, or never if an error ends it."""
        self._staged[batch_id] = []
        try:
            yield
            written = self._staged[batch_id]
        finally:
            del self._staged[batch_id]
        self._commit(batch_id, written)

    def _commit(self, batch_id: int, written: Iterable[tuple[str, str]]) -> None:
        """One file, which is there as a whole or not at all. A batch without changes is committed too."""
        rows = [(table, attempt, time.time_ns() // 1000, batch_id) for table, attempt in [*written, (None, "")]]
        self.spark.createDataFrame(rows, _COMMITS).coalesce(1).write.mode("append").partitionBy("batch_id").parquet(f"{self.root}/commits")

    def stage(self, table: str, rows: DataFrame, batch_id: int) -> None:
        attempt = uuid.uuid4().hex
        rows.write.parquet(f"{self.root}/log/{table}/batch_id={batch_id}/{attempt}")
        if batch_id in self._staged:
            self._staged[batch_id].append((table, attempt))
        else:
            self._commit(batch_id, [(table, attempt)])

    def write_changes(self, table: str, changes: DataFrame, batch_id: int) -> None:
        """Log the changes of one batch. ``changes`` has unique ids and a ``deleted`` flag.

        Outside a transaction they are committed at once. Writing a batch's changes again replaces them.
        """
        fields = [f for f in _log_schema(table) if f.name != "batch_id"]
        self.stage(table, changes.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]), batch_id)

    def write_pending(self, ids: DataFrame, batch_id: int) -> None:
        """Note the ``(table, id)`` of notified records that a batch did not find."""
        self.stage(_PENDING, ids.select("table", "id"), batch_id)

    def staged(self, batch_id: int) -> dict[str, DataFrame]:
        """Inside a transaction, the changes written so far, per table. Reads what was written and works nothing out again."""
        found = {}
        for table, attempt in self._staged[batch_id]:
            folder = f"{self.root}/log/{table}"
            found[table] = self.read_files([f"{folder}/batch_id={batch_id}/{attempt}"], _log_schema(table), folder)
        return found

    def changes_of(self, batch_id: int) -> dict[str, DataFrame]:
        """The committed changes of one batch, per table that it changed."""
        written = self.attempts(CACHE_TABLES, batch_id - 1, batch_id + 1)
        return {
            table: self.read_files([f"{self.root}/log/{table}/batch_id={n}/{attempt}" for n, attempt in entries], _log_schema(table), f"{self.root}/log/{table}")
            for table, entries in written.items()
            if entries
        }

    def committed(self, batch_id: int) -> bool:
        return not self._read(f"{self.root}/commits", _COMMITS).where(F.col("batch_id") == batch_id).isEmpty()

    # --- Reading ---

    def attempts(self, tables: Iterable[str], after: int, before: int | None) -> dict[str, list[tuple[int, str]]]:
        """Per table the committed ``(batch, attempt)``; of several attempts at one batch the one committed last."""
        noted = self._read(f"{self.root}/commits", _COMMITS).where(F.col("batch_id") > after).where(F.col("table").isin(*tables))
        if before is not None:
            noted = noted.where(F.col("batch_id") < before)
        last = noted.groupBy("table", "batch_id").agg(F.max_by("attempt", F.struct("stamp", "attempt")).alias("attempt"))
        found: dict[str, list[tuple[int, str]]] = {table: [] for table in tables}
        for row in last.orderBy("batch_id").collect():  # one per table and batch since the last compaction
            found[row["table"]].append((row["batch_id"], row["attempt"]))
        return found

    def pending(self, before: int | None = None) -> DataFrame:
        """The ``(table, id)`` still pending after the last batch, or after the last one before ``before``."""
        noted = self.attempts([_PENDING], -1, before)[_PENDING][-1:]
        folder = f"{self.root}/log/{_PENDING}"
        return self.read_files([f"{folder}/batch_id={n}/{attempt}" for n, attempt in noted], _PENDING_SCHEMA, folder).select("table", "id")

    def log(self, table: str) -> DataFrame:
        """All committed changes, compacted ones too."""
        return Snapshot(self, {}, {}, self.attempts([table], -1, None)).log(table)

    def snapshot(self, tables: Iterable[str] = tuple(CACHE_TABLES), before: int | None = None) -> Snapshot:
        """All ``tables`` at one committed state: the present one, or that before a batch."""
        tables = list(tables)
        # Only committed batches are compacted, so a base read first is never ahead of the commits read after it.
        done = self._read(f"{self.root}/compactions", _COMPACTIONS).where(F.col("table").isin(*tables))
        if before is not None:
            done = done.where(F.col("upto") < before)
        last = {r["table"]: r["last"] for r in done.groupBy("table").agg(F.max(F.struct("upto", "manifest")).alias("last")).collect()}
        upto = {table: last[table]["upto"] if table in last else -1 for table in tables}
        bases = {t: self._read(last[t]["manifest"], _MANIFEST).orderBy("low", "high").collect() if t in last else [] for t in tables}
        logs = self.attempts(tables, min(upto.values(), default=-1), before)
        return Snapshot(self, upto, bases, {table: [entry for entry in logs[table] if entry[0] > upto[table]] for table in tables})

    def scan(self, table: str, before: int | None = None) -> DataFrame:
        """Current rows of a table, or its rows before a batch. Only the log behind the base is read."""
        return self.snapshot([table], before).scan(table)

    def tables(self) -> dict[str, DataFrame]:
        """All tables of one snapshot."""
        now = self.snapshot()
        return {table: now.scan(table) for table in CACHE_TABLES}

    # --- Compaction ---

    def compact(self, table: str, whole: bool = False) -> int:
        """Fold the committed log into the base; readers switch to it once it is fully written.

        Only files whose key range holds a changed key, old or new, are read and written again, unless ``whole`` is set.
        """
        now = self.snapshot([table])
        if not now.logs[table]:
            return now.upto[table]
        upto, key = now.logs[table][-1][0], clustering_key(table)
        files, changes = now.bases[table], now.log(table)
        groups = _groups(files)
        lows = [group[0]["low"] for group in groups]
        if whole or not groups:
            touched, lows = set(range(len(groups))), []
        else:
            old = changes
            if key != "id":  # a change may name another key than the stored row, and a delete names none
                old = self.read_files([f["path"] for f in files], T.StructType([_schema(table)[name] for name in ("id", key)]))
                old = old.join(changes.select("id").distinct(), "id", "left_semi")
            keys = old.select(key).union(changes.where(~F.col("deleted")).select(key))
            touched = {row["range"] for row in keys.select(range_of(F.col(key), lows).alias("range")).distinct().collect()}  # at most one per file
        if files:
            stored = self.read_files([f["path"] for n in sorted(touched) for f in groups[n]], _schema(table))
            rows = apply_changes(stored, changes, "id", F.col("batch_id"), payload_columns(table))
        else:  # the rows may be laid out before they are folded, and then move once
            laid = changes.repartitionByRange("id") if key == "id" else changes
            rows = fold_changes(laid, "id", F.col("batch_id"), payload_columns(table)).where(~F.col("deleted")).select(*_schema(table).names)
        kept = [tuple(f) for n, group in enumerate(groups) if n not in touched for f in group]
        self.write_base(table, rows, upto, lows, kept, laid=not files and key == "id")
        return upto

    def write_base(
        self, table: str, rows: DataFrame, upto: int, lows: Iterable[int] = (), kept: Iterable[tuple] = (), laid: bool = False, unique: bool = False
    ) -> None:
        """Make ``rows`` and the ``kept`` files the base of a table as of batch ``upto``.

        Files do not reach over the borders ``lows`` of the old ranges, so that new ranges and kept ones stay apart. ``laid``
        says that rows lie in ranges of the key already; ``unique`` drops rows that are equal in all columns.
        """
        key, folder = clustering_key(table), f"{self.root}/base/{table}/{uuid.uuid4().hex}"
        if not laid:  # by id too, as rows of one key may be more than a task should have
            rows = rows.repartitionByRange(*dict.fromkeys((key, "id")))
        if unique:  # equal rows lie in one range, so this moves none
            rows = rows.distinct()
        ranged = rows.withColumn("_range", range_of(F.col(key), list(lows))).sortWithinPartitions("_range", key)
        ranged.write.partitionBy("_range").option("maxRecordsPerFile", self.rows_per_file).parquet(folder)
        place = F.coalesce(F.col(key), F.lit(_LEAST))  # rows without the key lie in the first range
        written = self._read(folder, _schema(table)).groupBy(F.col("_metadata.file_path").alias("file"))
        written = written.agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count("*").alias("n_rows"))
        path = F.concat(F.lit(f"{folder}/"), F.regexp_extract("file", "(_range=[^/]*/[^/]*)$", 1)).alias("path")
        written = written.select(path, "low", "high", "n_rows")
        manifest = f"{self.root}/base/{table}/manifest-{uuid.uuid4().hex}"
        self.spark.createDataFrame(list(kept), _MANIFEST).union(written).coalesce(1).write.parquet(manifest)
        mark = self.spark.createDataFrame([(table, upto, manifest)], _COMPACTIONS)
        mark.coalesce(1).write.mode("append").parquet(f"{self.root}/compactions")


def _groups(files: list[T.Row]) -> list[list[T.Row]]:
    """Files in order of keys; those that share a key at their border, as one key may fill several, are one group."""
    groups: list[list[T.Row]] = []
    for file in files:
        if groups and file["low"] <= max(f["high"] for f in groups[-1]):
            groups[-1].append(file)
        else:
            groups.append([file])
    return groups


def cache_scan(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Read any of the cache tables."""
    return Cache(spark, root).scan(table)
