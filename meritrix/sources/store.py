"""Stored tables on plain Parquet: partitions shared by snapshots, one pointer file.

A table is a folder. Every write puts its files into a new folder ``snapshot=N`` of it,
laid out by the partition columns, and then a pointer file that holds the schema
and tells, for each partition, which snapshots its rows are in. So a merge writes the
partitions it touches and nothing else, an append writes its own rows, frames that
were opened before still find their files, and a job that dies half-way has changed
nothing. All reads take names and types from the pointer, never from folder names.

One writer at a time: a second one that commits meanwhile is an error. What no
pointer names any more goes with ``prune``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meritrix.operators.clustering import clustered
from meritrix.operators.merge import new_rows, null_key_rows, one_per_key, upsert
from meritrix.operators.windows import any_row
from meritrix.schemas import BUCKET_KEYS, LAYOUT, ROWS_PER_BUCKET
from meritrix.session import scratch

#: Folder name of a NULL partition value, fixed by the file format.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
#: Strings that a folder name could not tell from NULL (the empty one among them) get
#: one more mark at their end in folder names.
MARK, UNCLEAR = "~", f"^({NULL_PARTITION})?~*$"
#: Partition column for hash buckets of the key, and the one for snapshots.
BUCKET, SNAPSHOT = "key_bucket", "snapshot"
POINTERS = "_pointers"
#: Keys of a batch that are listed in the filter on the target, so that Parquet's
#: Bloom filters and statistics skip row groups; a larger batch is joined only.
LISTED_KEYS = 200
#: Folders of one partition after which appends write it anew as one.
MOST_FOLDERS = 32
#: Columns that say when a row was loaded and not what it holds.
LOAD_COLUMNS = ("ingestion_timestamp", "loaded_at")


def laid_out(df: DataFrame, partition_by, sort_by) -> DataFrame:
    """One partition value per task as far as sizes allow, sorted inside.

    REBALANCE lets adaptive execution split a value that holds a large share of
    the rows and merge small ones by their real sizes. Unlike a range
    repartition it does not run the input an extra time to sample it.
    """
    if not (partition_by or sort_by):
        return df
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)


class _Files:
    """The file system that a path lives on."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.at = spark, spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.at(path))

    def matching(self, pattern: str) -> list[str]:
        """Paths that a glob pattern matches, in one round trip."""
        found = self.fs.globStatus(self.at(pattern))
        if not found:
            return []
        paths = self.spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
        return self.spark._jvm.scala.collection.mutable.ArraySeq.make(paths).mkString("\n").split("\n")

    def delete(self, path: str) -> None:
        self.fs.delete(self.at(path), True)

    def text(self, path: str) -> str:
        stream = self.fs.open(self.at(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Makes a file that appears whole or not at all; false if there is one."""
        draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.exists(path) and self.fs.rename(self.at(draft), self.at(path)):
            return True
        self.delete(draft)
        return False


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a table: a pointer, or files that something else wrote.
    What a job left that died before its first pointer is none."""
    files = _Files(spark, path)
    return bool(files.matching(f"{path}/{POINTERS}/[0-9]*")) or (
        files.exists(path) and not files.matching(f"{path}/{SNAPSHOT}=*"))


@dataclass(frozen=True)
class Pointer:
    """One version of a table. ``parts`` maps the folder of each partition, relative
    to a snapshot, to the snapshots that hold its rows; 0 stands for files that were
    there before the table had pointers. ``written`` counts the folders of a snapshot.
    ``derived`` names the versions of other tables that this content is derived from."""

    number: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    parts: dict[str, tuple[int, ...]] = field(default_factory=dict)
    written: dict[int, int] = field(default_factory=dict)
    derived: dict[str, int] = field(default_factory=dict)

    @property
    def folders_by(self) -> tuple[str, ...]:
        return (*self.partition_by, BUCKET) if self.buckets else self.partition_by

    def to_json(self) -> str:
        return json.dumps({
            "schema": self.schema.jsonValue(), "partition_by": self.partition_by, "sort_by": self.sort_by,
            "bucket_by": self.bucket_by, "buckets": self.buckets, "parts": self.parts, "written": self.written,
            "derived": self.derived})

    @staticmethod
    def from_json(number: int, text: str) -> "Pointer":
        d = json.loads(text)
        return Pointer(number, T.StructType.fromJson(d["schema"]), tuple(d["partition_by"]), tuple(d["sort_by"]),
                       tuple(d["bucket_by"]), d["buckets"], {k: tuple(v) for k, v in d["parts"].items()},
                       {int(k): v for k, v in d["written"].items()}, d.get("derived", {}))


def _encoded(column: Column) -> Column:
    return F.when(column.rlike(UNCLEAR), F.concat(column, F.lit(MARK))).otherwise(column)


def _decoded(column: Column) -> Column:
    return F.when(column.rlike(UNCLEAR), F.regexp_replace(column, f"{MARK}$", "")).otherwise(column)


def _same(columns: Iterable[str], other: str = "_{}") -> Column:
    """Null-safe equality of columns with their renamed twins."""
    return reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{other.format(c)}`")) for c in columns])


class StoredTable:
    """A table in a folder; ``pointer`` is the version that this object reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, self.path)
        newest = max(self._pointers(), default=None)
        self.pointer = self._adopted() if newest is None else self._load(newest)

    # -- versions ----------------------------------------------------------

    def _pointers(self) -> list[int]:
        return [int(p.rsplit("/", 1)[1]) for p in self.files.matching(f"{self.path}/{POINTERS}/[0-9]*")]

    def _load(self, number: int) -> Pointer:
        return Pointer.from_json(number, self.files.text(f"{self.path}/{POINTERS}/{number:06d}"))

    def _adopted(self) -> Pointer:
        """A folder of Parquet files that something else wrote. The type of a partition
        column is taken over only if it gives every folder name back as it is; ``06``
        is no number."""
        if not exists(self.spark, self.path):
            raise LookupError(f"no table at {self.path}")
        found = self.spark.read.parquet(self.path)
        names, depth = [], 0
        while True:
            deeper = self.files.matching(f"{self.path}/" + "/".join(["*=*"] * (depth + 1)))
            deeper = [d for d in deeper if not any(n[0] in "_." for n in d.rsplit("/", depth + 1)[1:])]
            if not deeper:
                break
            names, depth = deeper, depth + 1
        parts = [_relative(n, depth) for n in names] or [""]
        layouts = {tuple(column for column, _ in _values(p)) for p in parts}
        if len(layouts) != 1:
            raise ValueError(f"{self.path} mixes layouts: {sorted(layouts)}")
        columns = layouts.pop()
        schema = T.StructType([f if f.name not in columns or _gives_back(f.dataType, [dict(_values(p))[f.name] for p in parts])
                               else T.StructField(f.name, T.StringType()) for f in found.schema.fields])
        return Pointer(0, schema, columns, parts={p: (0,) for p in parts}, written={0: len(parts)})

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, *, partition_by=(), sort_by=(),
               bucket_by=(), buckets: int = 0, commit: bool = True) -> "StoredTable":
        """An empty table that can be read at once, or, without ``commit``, from its first
        write on. With ``buckets``, rows are also laid out by a hash of their key
        ``bucket_by``, so that a batch finds its keys in few of them; their files
        have Bloom filters on the key."""
        clash = {BUCKET, SNAPSHOT} & set(schema.names)
        if clash or (buckets and not bucket_by) or not {*partition_by, *bucket_by} <= set(schema.names):
            raise ValueError(f"columns of the layout: {sorted(clash) or [*partition_by, *bucket_by]}")
        self = cls.__new__(cls)
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, self.path)
        if self._pointers():
            raise ValueError(f"there is a table at {path}")
        self.pointer = Pointer(0, _nullable(schema), tuple(partition_by), tuple(sort_by), tuple(bucket_by), buckets)
        if commit:
            self._commit(self.pointer)
        return self

    def _next(self) -> int:
        """A number that neither a pointer nor a folder, a dead job's included, has."""
        taken = [int(p.rsplit("=", 1)[1]) for p in self.files.matching(f"{self.path}/{SNAPSHOT}=[0-9]*")]
        return max([*taken, *self._pointers(), 0]) + 1

    def _commit(self, new: Pointer, number: int | None = None) -> None:
        number = number or self._next()
        if max(self._pointers(), default=0) != self.pointer.number or not self.files.put(
                f"{self.path}/{POINTERS}/{number:06d}", new.to_json()):
            raise RuntimeError(f"another writer has changed {self.path} meanwhile")
        self.pointer = replace(new, number=number)

    # -- reading -----------------------------------------------------------

    def _roots(self, parts: dict[str, tuple[int, ...]]) -> tuple[list[str], list[str]]:
        """Folders to read: those from before the pointers, and those of snapshots; a
        snapshot of which every folder counts is read from its top."""
        by_snapshot: dict[int, list[str]] = {}
        for part, numbers in parts.items():
            for n in numbers:
                by_snapshot.setdefault(n, []).append(part)
        before, later = [], []
        for n, found in sorted(by_snapshot.items()):
            top = f"{self.path}/{SNAPSHOT}={n:06d}" if n else self.path
            folders = [top] if n and len(found) == self.pointer.written[n] else [f"{top}/{p}" if p else top for p in found]
            (later if n else before).extend(folders)
        if before == [self.path]:  # a flat folder: its own files, not those of the snapshots in it
            before = self.files.matching(f"{self.path}/[!_.]*.parquet")
        return before, later

    def _frame(self, parts: dict[str, tuple[int, ...]]) -> DataFrame:
        """The rows of some partitions, with the bucket if there are any."""
        p = self.pointer
        fields = [*p.schema.fields, *([T.StructField(BUCKET, T.IntegerType())] if p.buckets else [])]
        names = [f.name for f in fields]
        clear = {c: _decoded(F.col(f"`{c}`")) for c in p.partition_by if isinstance(p.schema[c].dataType, T.StringType)}
        before, later = self._roots(parts)
        frames = []
        for roots, decode in ((before, {}), (later, clear)):
            if roots:
                read = self.spark.read.schema(T.StructType(fields)).option("basePath", self.path).parquet(*roots)
                frames.append(read.select(*(decode[c].alias(c) if c in decode else f"`{c}`" for c in names)))
        if not frames:  # the limit tells the optimizer that there are no rows, so that joins with them go
            return self.spark.createDataFrame([], T.StructType(fields)).limit(0)
        return reduce(DataFrame.unionByName, frames)

    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of this version (of the given partitions only)."""
        chosen = self.pointer.parts if parts is None else {p: self.pointer.parts[p] for p in parts}
        return self._frame(chosen).select(*(f"`{c}`" for c in self.pointer.schema.names))

    def partitions(self) -> DataFrame:
        """(part, the typed partition columns[, bucket]): one row per folder."""
        p = self.pointer
        texts = [(part, *(None if v == NULL_PARTITION else v for _, v in _values(part)), 0 in numbers)
                 for part, numbers in p.parts.items()]
        kinds = [T.StructField(c, T.StringType()) for c in p.folders_by]
        frame = self.spark.createDataFrame(texts, T.StructType([
            T.StructField("part", T.StringType()), *kinds, T.StructField("before", T.BooleanType())]))
        columns = []
        for c in p.folders_by:
            kind = T.IntegerType() if c == BUCKET else p.schema[c].dataType
            text = F.col(f"`{c}`")
            columns.append((F.when(F.col("before"), text).otherwise(_decoded(text)) if isinstance(kind, T.StringType)
                            else text.cast(kind)).alias(c))
        return frame.select("part", *columns)

    def parts_of(self, values: DataFrame) -> list[str]:
        """Folders of the partitions that the rows of ``values`` (some of the partition
        columns) belong to: one row per folder on each side."""
        named = values.distinct().withColumnsRenamed({c: f"_{c}" for c in values.columns})
        found = self.partitions().join(F.broadcast(named), _same(values.columns), "left_semi")
        return [r.part for r in found.select("part").collect()]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in self.pointer.bucket_by)), F.lit(self.pointer.buckets)).cast("int")

    def candidates(self, batch: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
        """The rows among which the batch's keys can be (bucket included), and the folders
        they are in: with buckets on the key only those that the batch hits, and for a
        small batch only row groups that can hold one of its keys."""
        p = self.pointer
        parts = list(p.parts)
        if p.buckets and set(p.bucket_by) <= set(keys):
            typed = batch.select(*(F.col(f"`{c}`").cast(p.schema[c].dataType).alias(c) for c in p.bucket_by))
            parts = self.parts_of(typed.select(self._bucket().alias(BUCKET)))
        rows = self._frame({part: p.parts[part] for part in parts})
        listed = batch.select(keys[0]).distinct().limit(LISTED_KEYS + 1).collect()
        if len(listed) <= LISTED_KEYS:
            rows = rows.filter(reduce(Column.__or__, [F.col(f"`{keys[0]}`") == F.lit(r[0]) for r in listed], F.lit(False)))
        return rows, parts

    def changes_since(self, number: int) -> DataFrame:
        """The rows that came (sign 1) and went (sign -1) since a version, which must
        not have been pruned. Only folders that the two versions do not share are read, so
        a row of a rewritten partition may go and come again as it was."""
        then, now = self._load(number), self.pointer
        fields = T.StructType([*now.schema.fields, T.StructField("sign", T.IntegerType())])
        frames = []
        for old, new, sign in ((then, now, 1), (now, then, -1)):
            parts = {p: tuple(n for n in ns if n not in old.parts.get(p, ())) for p, ns in new.parts.items()}
            parts = {p: ns for p, ns in parts.items() if ns}
            if parts:
                reader = self._at(replace(new, schema=now.schema))
                frames.append(reader._frame(parts).select(
                    *(f"`{c}`" for c in now.schema.names), F.lit(sign).alias("sign")))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], fields)

    def has_version(self, number: int) -> bool:
        return number in self._pointers()

    def _at(self, pointer: Pointer) -> "StoredTable":
        """The same folder, read by another pointer."""
        other = StoredTable.__new__(StoredTable)
        other.spark, other.path, other.files, other.pointer = self.spark, self.path, self.files, pointer
        return other

    # -- writing -----------------------------------------------------------

    def _conformed(self, df: DataFrame) -> DataFrame:
        """The table's columns and types: missing columns are NULL, others an error, and
        so is a type that the table's cannot hold."""
        schema, have = self.pointer.schema, {f.name: f.dataType for f in df.schema.fields}
        strange = [c for c in have if c not in schema.names]
        drifted = [c for c in have if c in schema.names and not _fits(have[c], schema[c].dataType)]
        if strange or drifted:
            raise ValueError(f"{self.path} has no columns {strange}, and other types for {drifted}")
        return df.select(*((F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                           for f in schema.fields))

    def _write(self, df: DataFrame, number: int, layout: bool = True) -> list[str]:
        """Puts rows into a snapshot folder, by the table's layout or as they lie; the
        partitions that have some."""
        p = self.pointer
        rows = self._conformed(df)
        if p.buckets:
            rows = rows.withColumn(BUCKET, self._bucket())
        for c in p.partition_by:
            if isinstance(p.schema[c].dataType, T.StringType):
                rows = rows.withColumn(c, _encoded(F.col(f"`{c}`")))
        top = f"{self.path}/{SNAPSHOT}={number:06d}"
        rows = laid_out(rows, p.folders_by, p.sort_by) if layout else rows
        writer = rows.write.partitionBy(*p.folders_by)
        for c in p.bucket_by if p.buckets else ():
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(top)
        if not p.folders_by:
            return [""]
        found = self.files.matching(f"{top}/" + "/".join(f"{c}=*" for c in p.folders_by))
        return [_relative(f, len(p.folders_by)) for f in found]

    def _put(self, df: DataFrame, gone: Iterable[str], derived: dict[str, int] | None = None, layout: bool = True) -> None:
        """One commit: the rows come, the partitions ``gone`` go."""
        number = self._next()
        found = self._write(df, number, layout)
        parts = {p: n for p, n in self.pointer.parts.items() if p not in set(gone)}
        for part in found:
            parts[part] = (*parts.get(part, ()), number)
        used = {n for numbers in parts.values() for n in numbers}
        written = {n: c for n, c in {**self.pointer.written, number: len(found)}.items() if n in used}
        self._commit(replace(self.pointer, parts=parts, written=written, derived=derived or self.pointer.derived), number)

    def rows_in(self, parts: Iterable[str] | None = None) -> int:
        """Rows, from the files' footers."""
        return self.read(parts).count()

    def append(self, df: DataFrame) -> None:
        self._put(df, ())
        crowded = [p for p, n in self.pointer.parts.items() if len(n) > MOST_FOLDERS]
        if crowded:
            self.compact(crowded)

    def overwrite(self, df: DataFrame, derived: dict[str, int] | None = None) -> None:
        """New content, whose columns may differ from those before."""
        at = self.pointer
        self.pointer = replace(at, schema=_nullable(df.schema))
        try:
            self._put(df, at.parts, derived)
        except BaseException:
            self.pointer = at
            raise

    def compact(self, parts: Iterable[str]) -> None:
        """Writes partitions that many appends went to anew, each as one folder."""
        parts = list(parts)
        self._put(self.read(parts), parts)

    def cluster(self, columns: list[str], files: int) -> None:
        """Writes the table anew in Z order of two or three columns, in about ``files``
        files, so that filters on any of them skip files and row groups; the usual layout
        suits its first column only. Partition columns belong in front of the others
        where each of these files should stay in few partitions."""
        p = self.pointer
        self._put(clustered(self.read(), [*columns], files), p.parts, layout=False)

    def replace(self, df: DataFrame, touched: Iterable[str] | None = None) -> dict[str, int]:
        """``df`` is the new content of the partitions that it has rows of, and of the
        ``touched`` ones. The others keep their files."""
        number = self._next()
        found = self._write(df, number)
        gone = set(found) | set(touched or ())
        before = self.rows_in([p for p in self.pointer.parts if p in gone])
        parts = {p: n for p, n in self.pointer.parts.items() if p not in gone} | {p: (number,) for p in found}
        used = {n for numbers in parts.values() for n in numbers}
        written = {n: c for n, c in {**self.pointer.written, number: len(found)}.items() if n in used}
        self._commit(replace(self.pointer, parts=parts, written=written), number)
        return {"written": self.rows_in(found), "replaced": before}

    def append_new(self, src: DataFrame, keys, order=None, rejects: str | None = None,
                   load_columns=LOAD_COLUMNS, lasting: bool = False) -> dict[str, int]:
        """Insert-if-absent; see the function of this name."""
        keys = list(keys)
        with scratch(self.spark) as keep:
            rows = src if lasting else keep(src)
            counted = keep(_counted(rows, keys))
            lost = null_key_rows(counted, keys).agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            if lost:
                if rejects is None:
                    raise ValueError(f"{lost} rows without a key and no table for rejects")
                _append_rejects(self.spark, rejects, null_key_rows(rows, keys), load_columns)
            batch = counted.dropna(subset=keys)
            target, _ = self.candidates(batch, keys)
            new = keep(new_rows(target, batch, keys, unique=True))  # keys only
            inserted = new.count()
            if inserted:
                self.append(_best_of(rows, new, keys, order))
            return {"inserted": inserted, "skipped": batch.count() - inserted, "rejected": lost}

    def upsert(self, src: DataFrame, keys, order=None, merge=upsert, derived: dict[str, int] | None = None,
               lasting: bool = False) -> dict[str, int]:
        """Merges a batch. Partitions that hold its keys now are written anew; rows
        that are new go beside those that their partitions have. ``merge`` is a function of
        (target, source, keys, unique=True). Returns the counts of the merge, from one
        join of the keys. ``lasting``: see the function ``append_new``."""
        keys, p = list(keys), self.pointer
        with scratch(self.spark) as keep:
            rows = src if lasting else keep(src)
            counted = keep(_counted(rows.dropna(subset=keys), keys))
            batch = _best_of(rows, counted, keys, order, every=True)
            batch = rows.dropna(subset=keys) if batch is None else keep(batch)
            target, parts = self.candidates(counted, keys)
            hit = target.join(counted.select(*keys), keys, "left_semi")
            held = keep(hit.groupBy(*p.folders_by).agg(F.count(F.lit(1)).alias("_n")))  # a row per folder
            updated = held.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            if p.folders_by:
                parts = self.parts_of(held.select(*p.folders_by))
            counts = {"inserted": counted.count() - updated, "updated": updated, "unchanged": self.rows_in(parts) - updated}
            self._put(merge(self.read(parts), batch, keys, unique=True), parts, derived)
        return counts

    def delete(self, condition: Column) -> dict[str, int]:
        """Drops the rows that match; only partitions that hold some are written anew."""
        gone, p = F.coalesce(condition, F.lit(False)), self.pointer
        with scratch(self.spark) as keep:
            hit = self._frame(p.parts).filter(gone)
            per_part = keep(hit.groupBy(*p.folders_by).agg(F.count(F.lit(1)).alias("_n")))
            deleted = per_part.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
            if not deleted:
                return {"deleted": 0, "rewritten": 0}
            parts = self.parts_of(per_part.select(*p.folders_by)) if p.folders_by else list(p.parts)
            kept = self.read(parts).filter(~gone)
            self._put(kept, parts)
            return {"deleted": deleted, "rewritten": len(parts)}

    def add_columns(self, schema: T.StructType) -> list[str]:
        """New columns at the end, NULL in the rows that are there; no file is touched.
        A column of another type is an error. Returns the names of the new ones."""
        have = self.pointer.schema
        other = [f.name for f in schema.fields if f.name in have.names and have[f.name].dataType != f.dataType]
        if other or {BUCKET, SNAPSHOT} & set(schema.names):
            raise ValueError(f"{self.path} has other types for {other}")
        new = [f for f in _nullable(schema).fields if f.name not in have.names]
        if new:
            self._commit(replace(self.pointer, schema=T.StructType([*have.fields, *new])))
        return [f.name for f in new]

    def prune(self, keep: int = 2) -> None:
        """Keeps the newest ``keep`` versions: older pointers go, and the folders of
        older snapshots that no kept pointer names, dead jobs' included."""
        numbers = sorted(self._pointers())
        if not numbers:
            return
        kept = [self._load(n) for n in numbers[-keep:]]
        for n in numbers[:-keep]:
            self.files.delete(f"{self.path}/{POINTERS}/{n:06d}")
        used = {(n, part) for p in kept for part, ns in p.parts.items() for n in ns}
        for top in self.files.matching(f"{self.path}/{SNAPSHOT}=[0-9]*"):
            n = int(top.rsplit("=", 1)[1])
            if n >= kept[0].number:
                continue
            mine = {part for m, part in used if m == n}
            if not mine:
                self.files.delete(top)
            elif "" not in mine:
                depth = next(iter(mine)).count("/") + 1
                for f in self.files.matching(f"{top}/" + "/".join(["*=*"] * depth)):
                    if _relative(f, depth) not in mine:
                        self.files.delete(f)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def _relative(folder: str, depth: int) -> str:
    """The last ``depth`` names of a path."""
    return "/".join(folder.rsplit("/", depth)[1:]) if depth else ""


def _values(part: str) -> list[tuple[str, str]]:
    """(column, value as text) of a partition folder."""
    return [tuple(map(unquote, name.split("=", 1))) for name in part.split("/") if name]


def _gives_back(kind: T.DataType, texts: list[str]) -> bool:
    """Whether values of a type are written as exactly these folder names."""
    texts = [t for t in texts if t != NULL_PARTITION]
    try:
        if isinstance(kind, T.IntegralType):
            return all(str(int(t)) == t for t in texts)
        if isinstance(kind, T.DateType):
            return all(date.fromisoformat(t).isoformat() == t for t in texts)
    except ValueError:
        return False
    return isinstance(kind, T.StringType)


_WIDTHS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _fits(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of a type is one of the other, too."""
    if given.simpleString() == wanted.simpleString() or isinstance(given, T.NullType):
        return True
    kinds = type(given), type(wanted)
    if all(k in _WIDTHS for k in kinds):
        return _WIDTHS.index(kinds[0]) <= _WIDTHS.index(kinds[1])
    return kinds in ((T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType), (T.ShortType, T.DoubleType))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a stored table."""
    return StoredTable(spark, path).read()


def write_layout(df: DataFrame, path: str, name: str, buckets: int = 0) -> StoredTable:
    """Stores a frame as a new table in the layout of the table ``name``."""
    partition_by, sort_by = LAYOUT.get(name, ([], []))
    table = StoredTable.create(df.sparkSession, path, df.schema, partition_by=partition_by, sort_by=sort_by,
                               bucket_by=BUCKET_KEYS.get(name, ()) if buckets else (), buckets=buckets, commit=False)
    table.append(df)
    return table


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns that a stored table is partitioned by."""
    return list(StoredTable(spark, path).pointer.partition_by)


def append_new(spark: SparkSession, path: str, src: DataFrame, keys, order=None, rejects: str | None = None,
               load_columns=LOAD_COLUMNS, lasting: bool = False) -> dict[str, int]:
    """Insert-if-absent on a stored table: only new rows are written. Running the same
    source again finds its keys present and writes nothing. Returns the counts of
    inserted and skipped keys, and of rows without a key.

    Rows with a NULL key part go to the table ``rejects``, one per distinct content
    with the number of its ``copies``; only the named ``load_columns`` do not count
    as content. Without such a table they are an error: a landing loses nothing.

    The batch is stored first: its plan (a stream's, say) has no known size,
    but its files do, and that lets the planner broadcast its keys. ``lasting`` tells that
    it reads stored files and gives the same rows each time, so that it needs no copy.
    Whole rows are read once more, those of new keys; all else is done on the keys.
    """
    return StoredTable(spark, path).append_new(src, keys, order, rejects, load_columns, lasting)


def _counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct keys with the number of their rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _best_of(rows: DataFrame, counted: DataFrame, keys: list[str], order=None, every: bool = False) -> DataFrame | None:
    """One row for each counted key. Only the rows of keys that occur more than once are
    ranked, as whole rows; the others pass as they are. None if the keys
    are ``every`` one of the rows and none occurs twice: then nothing is to be done."""
    repeated = counted.where("_n > 1").select(*keys)
    if repeated.isEmpty():
        return None if every else rows.join(counted.select(*keys), keys, "left_semi").select(*rows.columns)
    single = counted.where("_n = 1").select(*keys)
    best = one_per_key(rows.join(repeated, keys, "left_semi").select(*rows.columns), keys, order or [any_row(rows)])
    return rows.join(single, keys, "left_semi").select(*rows.columns).unionByName(best)


def _append_rejects(spark: SparkSession, path: str, rows: DataFrame, load_columns) -> None:
    """A landing that is tried again brings the same rows again, so a content counts
    as often as in the landing that has most of it."""
    content = [c for c in rows.columns if c not in load_columns]
    digest = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    named = rows.withColumn("content_sha256", digest)
    copies = named.groupBy("content_sha256").agg(F.count(F.lit(1)).alias("copies"))
    counted = one_per_key(named, ["content_sha256"]).join(copies, "content_sha256").select(*named.columns, "copies")
    table = StoredTable(spark, path) if exists(spark, path) else StoredTable.create(spark, path, counted.schema, commit=False)
    if "copies" not in table.pointer.schema.names:
        table.add_columns(T.StructType([T.StructField("copies", T.LongType())]))

    def most(target: DataFrame, source: DataFrame, keys, unique: bool) -> DataFrame:
        held = target.select("content_sha256", F.coalesce("copies", F.lit(1)).alias("held"))
        raised = source.join(held, "content_sha256", "left").withColumn("copies", F.greatest("copies", "held")).drop("held")
        return upsert(target, raised, keys, unique=True)

    table.upsert(counted, ["content_sha256"], merge=most)


def replace_partitions(df: DataFrame, path: str, partition_by, touched: DataFrame | None = None) -> dict[str, int]:
    """Overwrite just the partitions that ``df`` contains, and drop those of
    ``touched`` (rows of partition values) that it does not. The content may be derived
    from the table itself. Returns the rows written and those they replace."""
    table = StoredTable(df.sparkSession, path)
    if list(partition_by) != list(table.pointer.partition_by):
        raise ValueError(f"{path} is partitioned by {table.pointer.partition_by}")
    return table.replace(df, [] if touched is None else table.parts_of(touched.select(*partition_by)))


def delete_partitions(spark: SparkSession, path: str, condition) -> dict[str, int]:
    """Drop the rows that match ``condition``; only partitions that hold such rows are
    rewritten. Returns the rows deleted and the partitions rewritten."""
    return StoredTable(spark, path).delete(condition)


def upsert_stored(spark: SparkSession, path: str, src: DataFrame, keys, order=None, merge=upsert) -> dict[str, int]:
    """Merge a batch into a stored table; partitions that hold none of its keys keep
    their files. Returns the counts of the merge within the rewritten partitions."""
    return StoredTable(spark, path).upsert(src, keys, order, merge)


class SnapshotStore:
    """Named tables under one root. A reader keeps the version it opened."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return exists(self.spark, f"{self._path(name)}/{POINTERS}")

    def table(self, name: str) -> StoredTable:
        if not self.exists(name):
            raise LookupError(f"no table {name} under {self.root}")
        return StoredTable(self.spark, self._path(name))

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def write(self, name: str, df: DataFrame, buckets: int | None = None) -> DataFrame:
        """New content. Tables with a key for buckets have as many as asked for, or
        else as the rows before the write call for."""
        if not self.exists(name):
            table = write_layout(df, self._path(name), name, buckets or 0)
            return table.read()
        table = self.table(name)
        if name in BUCKET_KEYS:
            n = table.rows_in() // ROWS_PER_BUCKET if buckets is None else buckets
            table.pointer = replace(table.pointer, bucket_by=tuple(BUCKET_KEYS[name]) if n else (), buckets=n)
        table.overwrite(df)
        return table.read()

    def merge(self, name: str, batch: DataFrame, keys, order=None, lasting: bool = False) -> dict[str, int]:
        """Upsert: only partitions that hold keys of the batch are rewritten."""
        return self.table(name).upsert(batch, keys, order, lasting=lasting)

    def prune(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, and what failed writes left."""
        self.table(name).prune(keep)
