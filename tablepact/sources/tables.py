"""Business tables: snapshots that each hold only what their batch changed.

======== ==================================================================
layout   a snapshot holds
======== ==================================================================
scd2     versions the batch closed and opened, split by ``is_current``
scd1     the batch's rows; the newest row of a key is the one that counts
whole    the whole table, for merges that rewrite history
======== ==================================================================

A snapshot is finished once its marker is written, which is the last thing done
and needs no setting. The marker records the layout, the keys and the schema of
the table so far, which of the snapshot's runs holds its rows, and the snapshot and
run it was merged onto. ``fold`` writes one snapshot that stands for all before it, so
readers list no more snapshots than came after the last fold.

Each attempt to write a snapshot is a run with a folder of its own, so nothing that a
reader may be on is overwritten. Of two batches that were opened on the same snapshot
one is finished; the other raises ``StaleBatch``, leaves nothing, and may be run again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    BinaryType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

from ..functions.casts import ref
from ..functions.frames import empty_frame
from ..operators.dedupe import any_null
from ..operators.merge import CURRENT, OPENED
from .writers import StaleBatch, _file_system, _snapshots_holding, evened, snapshot_path

LAYOUTS = ("scd2", "scd1", "whole")
MARKER = "_table.json"
FOLD = ".fold"
RUN = "__run"
#: Rows that a task of a fold sorts take about so many bytes in memory.
SORT_BYTES = 256 << 20

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class BrokenTable(RuntimeError):
    """The table's folder holds no finished snapshot, or one of another kind."""


class SchemaClash(ValueError):
    """A column of the batch has a type the table's column cannot become."""


def wider(stored: DataType, new: DataType) -> DataType | None:
    """The one of two types, or a third, that holds all values of both, if there is one."""
    if stored == new:
        return stored
    for a, b in ((stored, new), (new, stored)):
        if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
            return max(a, b, key=lambda t: _DIGITS[type(t)])
        if isinstance(a, (ByteType, ShortType, IntegerType, FloatType)) and isinstance(b, DoubleType):
            return b
        if isinstance(a, DateType) and isinstance(b, TimestampNTZType):
            return b
        if isinstance(a, _INTEGRAL) and isinstance(b, DecimalType):
            return b if b.precision - b.scale >= _DIGITS[type(a)] else None
    if isinstance(stored, DecimalType) and isinstance(new, DecimalType):
        scale = max(stored.scale, new.scale)
        whole = max(stored.precision - stored.scale, new.precision - new.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def united(stored: StructType, batch: StructType) -> StructType:
    """Stored columns, then new ones; each in a type that holds both sides' values."""
    fields = {f.name: f.dataType for f in stored.fields}
    for f in batch.fields:
        kind = wider(fields.get(f.name, f.dataType), f.dataType)
        if kind is None:
            raise SchemaClash(f"{f.name} is {fields[f.name].simpleString()}, not {f.dataType.simpleString()}")
        fields[f.name] = kind
    return StructType([StructField(n, t) for n, t in fields.items()])


@dataclass(frozen=True)
class Table:
    """A business table as one batch, or a reader, finds it."""

    spark: SparkSession
    root: str
    layout: str
    keys: tuple[str, ...]
    schema: StructType
    #: Finished snapshots that count: the last fold, or the first one, and those since.
    parts: tuple[str, ...]
    #: Columns of the table that the batch lacks.
    missing: tuple[str, ...] = ()
    #: The run that holds each part's rows.
    runs: Mapping[str, str] = field(default_factory=dict)
    #: The newest finished snapshot and its run, on which a batch's own is put.
    base: tuple[str, str] | None = None
    #: The run that an earlier try of the batch finished with.
    own: str | None = None

    def _read(self, parts: Sequence[str], sub: str = "") -> DataFrame:
        paths = [f"{snapshot_path(self.root, p)}/{RUN}={self.runs[p]}/{sub}".rstrip("/") for p in parts]
        if sub:
            there = _held(self.spark, f"{self.root.rstrip('/')}/snapshot=*/{RUN}=*/{sub}", 3)
            paths = [p for p in paths if tuple(p.split("/")[-3:]) in there]
        schema = self.schema
        if self.layout != "whole":
            schema = StructType([*schema.fields, StructField(OPENED, StringType())])
        if not paths:
            return empty_frame(self.spark, schema)
        read = self.spark.read.schema(schema).option("basePath", self.root).parquet(*paths)
        return read.select(*[ref(c) for c in schema.fieldNames()])

    def current(
        self,
        only: DataFrame | None = None,
        between: Mapping[str, tuple[Any, Any]] | None = None,
        keyed: bool = False,
    ) -> DataFrame:
        """Rows in force, with the snapshot that opened each in ``__opened``.

        With ``only``, a frame of key columns, rows of its keys (which are not NULL): open
        rows and closed versions are narrowed to them where they lie, before either moves.
        ``between`` gives the least and greatest value that key columns have there; files
        and row groups outside, of which a folded table has many, are not read.
        """
        if self.layout == "scd1":
            return self._newest()

        def wanted(rows: DataFrame) -> DataFrame:
            if only is None:
                return rows
            for name, (low, high) in (between or {}).items():
                kind = self.schema[name].dataType
                rows = rows.filter(ref(name).between(F.lit(low).cast(kind), F.lit(high).cast(kind)))
            return rows.join(only, list(self.keys), "left_semi").select(*map(ref, rows.columns))

        opened = wanted(self._read(self.parts, f"{CURRENT}=true"))
        # what the first part closed, it no longer lists as open
        if len(self.parts) < 2:
            return opened.filter(~any_null(self.keys)) if keyed else opened
        closed = self._read(self.parts[1:], f"{CURRENT}=false").select(*map(ref, [*self.keys, OPENED]))
        # a key has at most one closed version a batch; joined by key alone, the rows need
        # no other partitioning than a merge does
        gone = wanted(closed).groupBy(*map(ref, self.keys)).agg(F.collect_set(ref(OPENED)).alias("__gone"))
        keyed = opened.filter(~any_null(self.keys)).join(gone, list(self.keys), "left")
        still = keyed.filter(~F.coalesce(F.array_contains("__gone", ref(OPENED)), F.lit(False)))
        still = still.select(*map(ref, opened.columns))
        return still if keyed or only is not None else still.unionByName(opened.filter(any_null(self.keys)))

    def _newest(self) -> DataFrame:
        """The newest row of each key; the first part's rows move only if they lose."""
        base = self._read(self.parts[:1])
        if len(self.parts) < 2:
            return base
        later = self._read(self.parts[1:])
        names = [c for c in later.columns if c not in self.keys]
        row = F.max_by(F.struct(*map(ref, names)), ref(OPENED)).alias("row")
        newest = later.groupBy(*map(ref, self.keys)).agg(row)
        keys = [ref(k) for k in self.keys]
        newest = newest.select(*keys, *[F.col("row")[c].alias(c) for c in names]).select(*map(ref, base.columns))
        kept = base.join(newest.select(*keys), list(self.keys), "left_anti")
        return kept.select(*map(ref, base.columns)).unionByName(newest)

    def stored(self) -> DataFrame:
        """All rows with ``__opened``: those in force and, of a history, those closed."""
        if self.layout == "whole":
            return self._read(self.parts[-1:])
        if self.layout == "scd1":
            return self.current()
        return self.current().unionByName(self._read(self.parts, f"{CURRENT}=false"))

    def rows(self) -> DataFrame:
        return self.stored().drop(OPENED)

    def fitted(self, batch: DataFrame, snapshot: str) -> DataFrame:
        """Batch rows in the table's columns and types; columns it lacks are NULL."""
        have = set(batch.columns)
        columns = [
            (ref(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
            if f.name in have or f.name in self.missing
        ]
        fitted = batch.select(*columns)
        return fitted if self.layout == "whole" else fitted.withColumn(OPENED, F.lit(snapshot))

    def write(self, rows: DataFrame, snapshot: str, files: int | None = None) -> str:
        """Write a run of a snapshot, then the marker that finishes it.

        Raises ``StaleBatch`` if the table is no longer as it was opened. A run that is
        refused, or fails, is deleted, and readers never saw it. Files are of even size, or, if their number
        is given, clustered by key.
        """
        run = uuid.uuid4().hex
        target = f"{snapshot_path(self.root, snapshot)}/{RUN}={run}"
        writer = self._grouped(rows, files).write
        if self.layout == "scd2":
            writer = writer.partitionBy(CURRENT)
        try:
            writer.parquet(target)
            self._finish(snapshot, run)
        except Exception:
            path, fs = _file_system(self.spark, target)
            fs.delete(path, True)
            folder = path.getParent()
            if fs.exists(folder) and not fs.listStatus(folder):
                fs.delete(folder, False)
            raise
        return target

    def _grouped(self, rows: DataFrame, files: int | None) -> DataFrame:
        if self.layout == "whole":
            return rows
        by = [CURRENT] if self.layout == "scd2" else []
        if files is None:
            return evened(rows, *by)
        by = [ref(c) for c in [*by, *self.keys]]
        return rows.repartitionByRange(files, *by).sortWithinPartitions(*by)

    def _finish(self, snapshot: str, run: str) -> None:
        """Put the marker, unless something else was finished since the table was opened."""
        self._verify(snapshot)
        path, fs = _file_system(self.spark, f"{snapshot_path(self.root, snapshot)}/{MARKER}")
        before = _marker(self.spark, self.root, snapshot)
        if before is not None:
            if before["run"] != self.own:
                raise StaleBatch(f"another run of {snapshot} was finished meanwhile")
            fs.delete(path, False)
        marker = {
            "layout": self.layout, "keys": list(self.keys), "schema": self.schema.jsonValue(),
            "run": run, "base": self.base,
        }
        _create(path, fs, marker, f"another run of {snapshot} was finished meanwhile")
        try:
            self._verify(snapshot)  # once more: two batches may have looked at the same time
        except StaleBatch:
            fs.delete(path, False)
            if before is not None:
                _create(path, fs, before, f"{snapshot} was finished again")
            raise

    def _verify(self, snapshot: str) -> None:
        others = [s for s in finished(self.spark, self.root) if s != snapshot]
        if snapshot.endswith(FOLD):  # later batches may be there, but its own parts must be as they were
            newest = self.base[0]
        else:
            newest = others[-1] if others else None
        marker = _marker(self.spark, self.root, newest) if newest else None
        if self.base is None:
            same = newest is None
        elif newest == self.base[0] + FOLD:
            same = marker is not None and marker["base"] == list(self.base)
        else:
            same = newest == self.base[0] and marker is not None and marker["run"] == self.base[1]
        if not same:
            base = self.base[0] if self.base else "an empty table"
            raise StaleBatch(f"{snapshot} was opened on {base}, but {newest} is finished now")


def _create(path, fs, marker: dict, taken: str) -> None:
    """Write a marker where none is."""
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            raise StaleBatch(taken) from e
        raise
    stream.write(bytearray(json.dumps(marker).encode()))
    stream.close()


def _marker(spark: SparkSession, root: str, snapshot: str) -> dict | None:
    """What a finished snapshot's marker says."""
    path, fs = _file_system(spark, f"{snapshot_path(root, snapshot)}/{MARKER}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return json.loads(text) if text else None  # a marker that is just being written is none yet


def finished(spark: SparkSession, root: str) -> list[str]:
    """Ids of finished snapshots, oldest first."""
    return _snapshots_holding(spark, root, MARKER)


def _held(spark: SparkSession, pattern: str, depth: int) -> set[tuple[str, ...]]:
    """The last names of the paths that match."""
    path, fs = _file_system(spark, pattern)
    return {tuple(s.getPath().toString().split("/")[-depth:]) for s in fs.globStatus(path) or []}


def _started(spark: SparkSession, root: str) -> list[str]:
    pattern, fs = _file_system(spark, f"{root.rstrip('/')}/snapshot=*")
    return sorted(s.getPath().getName().partition("=")[2] for s in fs.globStatus(pattern) or [])


def _as_of(spark: SparkSession, root: str, done: Sequence[str]) -> Table:
    folds = [i for i, s in enumerate(done) if s.endswith(FOLD)]
    parts = tuple(done[folds[-1] if folds else 0 :])
    markers = {p: _marker(spark, root, p) for p in parts}
    parts = tuple(p for p in parts if markers[p])
    if not parts:
        raise BrokenTable(f"{root}: the table is being changed")
    newest = markers[parts[-1]]
    schema, runs = StructType.fromJson(newest["schema"]), {p: markers[p]["run"] for p in parts}
    base = (parts[-1], newest["run"])
    return Table(spark, root, newest["layout"], tuple(newest["keys"]), schema, parts, (), runs, base)


def open_table(
    spark: SparkSession, root: str, layout: str, keys: Sequence[str], snapshot: str, batch: StructType
) -> Table:
    """The table a batch is merged into, checked before anything is written.

    It is the table as of the newest snapshot before the batch's own id, so that a
    retry starts from the same base again. Raises ``StaleBatch`` if a newer or
    folded one exists, ``BrokenTable`` if there are snapshots but none is finished
    or the table is of another kind, ``SchemaClash`` if types don't fit.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout={layout!r}")
    done = finished(spark, root)
    if done and done[-1] > snapshot:
        raise StaleBatch(f"snapshot {done[-1]} is newer than {snapshot}")
    earlier = [s for s in done if s < snapshot]
    before = _marker(spark, root, snapshot)
    own = before["run"] if before else None
    if not earlier:
        others = [s for s in _started(spark, root) if s != snapshot]
        if others:
            raise BrokenTable(f"{root} has snapshots but no finished one: {others}")
        return Table(spark, root, layout, tuple(keys), united(StructType(), batch), (), own=own)
    table = _as_of(spark, root, earlier)
    if table.layout != layout or list(table.keys) != list(keys):
        raise BrokenTable(
            f"{root} is a {table.layout} table with keys {list(table.keys)}, not {layout} with {list(keys)}"
        )
    schema = united(table.schema, batch)
    missing = tuple(n for n in table.schema.fieldNames() if n not in batch.fieldNames())
    return replace(table, schema=schema, missing=missing, own=own)


def read_table(spark: SparkSession, root: str) -> Table | None:
    """The table as of its newest finished snapshot; None before the first."""
    done = finished(spark, root)
    return _as_of(spark, root, done) if done else None


def _bytes_in_memory(rows: DataFrame) -> int:
    """About what rows take while they are sorted: 8 bytes a column, beside them what has no fixed width.

    Nested values are reckoned by their text, generously. Only columns without a fixed width are read.
    """
    wide = [F.lit(32 + 8 * len(rows.columns))]
    for f in rows.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            wide.append(8 + F.coalesce(F.octet_length(ref(f.name)), F.lit(0)))
        elif isinstance(f.dataType, DecimalType):
            wide.append(F.lit(16))
        elif isinstance(f.dataType, VariantType) or not isinstance(f.dataType, AtomicType):
            wide.append(8 + 4 * F.coalesce(F.octet_length(ref(f.name).cast("string")), F.lit(0)))
    return rows.agg(F.sum(reduce(add, wide).cast("long"))).first()[0] or 0


def fold(spark: SparkSession, root: str, file_bytes: int | None = None) -> str | None:
    """Write one snapshot that stands for all there are; None if there is nothing to fold.

    The table reads the same before and after. The newest batch cannot be retried
    afterwards; a batch that was opened before may still be finished after. Rows are
    dealt into files of about ``file_bytes`` (the session's bytes of a read task, if not
    given) by ranges of the key and sorted by it, so that the files' own statistics tell
    readers of some keys which to skip. Range bounds come from a sample that Spark takes.
    Rows that compress well make smaller files, as each is sorted by one task: about
    ``SORT_BYTES`` in memory, which a pass over the columns without a fixed width reckons.
    """
    table = read_table(spark, root)
    if table is None or table.layout == "whole" or len(table.parts) < 2:
        return None
    stored = 0
    for part in table.parts:
        path, fs = _file_system(spark, f"{snapshot_path(root, part)}/{RUN}={table.runs[part]}")
        stored += fs.getContentSummary(path).getLength()
    if file_bytes is None:
        file_bytes = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    snapshot = table.parts[-1] + FOLD
    held = _bytes_in_memory(table._read(table.parts))
    files = max(1, math.ceil(stored / file_bytes), math.ceil(held / SORT_BYTES))
    table.write(table.stored(), snapshot, files=files)
    return snapshot


def retire(spark: SparkSession, root: str) -> list[str]:
    """Delete the snapshots that no longer count: those before the last fold.

    Whole tables keep their newest snapshot. Of snapshots that stay, but for the newest,
    which may be retried just now, runs that an earlier try left go too. Readers that started earlier may still be on them, so
    leave them time.
    """
    table = read_table(spark, root)
    if table is None:
        return []
    first = table.parts[-1 if table.layout == "whole" else 0]
    gone = [s for s in finished(spark, root) if s < first]
    for snapshot in gone:
        path, fs = _file_system(spark, snapshot_path(root, snapshot))
        fs.delete(path, True)
    for snapshot, run in _held(spark, f"{root.rstrip('/')}/snapshot=*/{RUN}=*", 2):
        name = snapshot.partition("=")[2]
        if name in table.parts[:-1] and run != f"{RUN}={table.runs[name]}":
            path, fs = _file_system(spark, f"{snapshot_path(root, name)}/{run}")
            fs.delete(path, True)
    return gone
