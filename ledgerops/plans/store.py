"""Tables published as numbered versions: a manifest of parts, put in place only if absent.

A version lists, for every table, the folders and files that hold it. A run is computed
from one version and published as the next. New rows become one more part. Rows that are
changed or deleted are rewritten file by file: only files that hold such rows are written
anew. The manifest comes last, by one rename that fails where the version is there
already, so of two runs from one version one is published and the other is told."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerops.functions.columns import add_missing
from ledgerops.operators import usage
from ledgerops.plans.generate import Changes, Edit
from ledgerops.sources.schemas import SCHEMAS
from ledgerops.sources.tables import wall_clock

_LISTED = "table_name string, part int, path string, bytes long, layout string"
FAN = 4  # parts of about one size that compaction makes one of
SMALLEST = 1 << 20  # parts up to these bytes are of one size
FILE_BYTES = 256 << 20

# tables whose parts hold additions to rows; reading adds them up
MERGED: dict[str, Callable[[DataFrame], DataFrame]] = {"object_reference": usage.merge_usage}


class Conflict(RuntimeError):
    """Another run was published from the same version first."""


@dataclass(frozen=True)
class Part:
    """A folder or a single file of a table, its size and its columns (a schema as JSON), so
    that reading has to look into no file for them."""

    path: str
    bytes: int
    layout: str


class Files:
    """The few file operations that need no DataFrame, on any store that Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _store(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        store = self._store(folder)
        if not store.exists(self._path(folder)):
            return []
        return [status.getPath().getName() for status in store.listStatus(self._path(folder))]

    def bytes(self, path: str) -> int:
        return self._store(path).getContentSummary(self._path(path)).getLength()

    def move_if_absent(self, source: str, target: str) -> bool:
        """Rename a folder unless the target is there. The store has to do that in one
        step, as HDFS and a POSIX file system do."""
        store = self._store(target)
        store.mkdirs(self._path(target).getParent())
        if store.getUri().getScheme() == "file":
            try:
                os.rename(_local(source), _local(target))
            except OSError:
                if not store.exists(self._path(target)):
                    raise
                return False
            return True
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        none = self._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        where = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(target).toUri(), self._conf)
        try:
            where.rename(self._path(source), self._path(target), none)
        except Exception:
            if not store.exists(self._path(target)):
                raise
            return False
        return True


class Snapshot(Mapping[str, DataFrame]):
    """The tables of one version, each read from its parts when asked for."""

    def __init__(self, spark: SparkSession, version: int, parts: Mapping[str, list[Part]]):
        self.spark, self.version, self.parts = spark, version, parts

    def rows(self, name: str, parts: Iterable[Part] | None = None, file: bool = False) -> DataFrame:
        """The table's stored rows, or those of some parts; `file` adds `_file`."""
        layouts: dict[str, list[str]] = {}
        for part in self.parts[name] if parts is None else parts:
            layouts.setdefault(part.layout, []).append(part.path)
        frames = []
        for layout, paths in layouts.items():  # one scan for all parts of one layout
            found = self.spark.read.schema(StructType.fromJson(json.loads(layout))).parquet(*paths)
            if file:
                found = found.select("*", F.col("_metadata.file_path").alias("_file"))
            frames.append(wall_clock(found))
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return add_missing(united, SCHEMAS.get(name, {}))

    def __getitem__(self, name: str) -> DataFrame:
        found = self.rows(name)
        return MERGED[name](found) if name in MERGED else found

    def __iter__(self) -> Iterator[str]:
        return iter(self.parts)

    def __len__(self) -> int:
        return len(self.parts)


class Store:
    """Versions under one folder: `versions` has a manifest each, `data` the parts that
    runs wrote. Nothing is ever changed in place or deleted."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _manifest(self, version: int) -> str:
        return f"{self.root}/versions/{version:012d}"

    def latest(self) -> Snapshot | None:
        found = [int(name) for name in self.files.names(f"{self.root}/versions") if name.isdigit()]
        return self.version(max(found)) if found else None

    def version(self, number: int) -> Snapshot:
        listed = self.spark.read.schema(_LISTED).parquet(self._manifest(number))
        parts: dict[str, list[Part]] = {}
        for row in listed.orderBy("table_name", "part").collect():
            parts.setdefault(row.table_name, []).append(Part(row.path, row.bytes, row.layout))
        return Snapshot(self.spark, number, parts)

    def create(self, tables: Mapping[str, str | DataFrame]) -> Snapshot:
        """Version 0: folders that are there already, or frames to be written."""
        run = self._run()
        parts = {
            name: [self._found(found) if isinstance(found, str) else self._written(found, f"{run}/{name}")]
            for name, found in tables.items()
        }
        return self._publish(0, parts)

    def commit(self, base: Snapshot, changes: Changes) -> Snapshot:
        """Publish a run that was computed from `base` as the version after it.

        For each table the most sparing form that the run gives is used: additions that
        are merged on reading, an edit of the files concerned, or a whole new table.
        Conflict is raised if the version after `base` is there, before anything is
        written if it is there by then; the run's data then stay unread, and the run is
        to be computed again from the latest version."""
        self._expect_next(base)
        run = self._run()
        parts = {name: list(found) for name, found in base.parts.items()}
        for name in {**changes.replaced, **changes.edits, **changes.deltas}:
            if name in changes.deltas:
                parts.setdefault(name, []).append(self._written(changes.deltas[name], f"{run}/{name}/delta"))
            elif name in changes.edits:
                parts[name] = self._edited(base, name, changes.edits[name], f"{run}/{name}/edited")
            else:
                parts[name] = [self._written(changes.replaced[name], f"{run}/{name}/whole")]
        for name, frame in [*changes.inserted.items(), *changes.added.items()]:
            parts.setdefault(name, []).append(self._written(frame, f"{run}/{name}/added"))
        return self._publish(base.version + 1, parts)

    def compact(self, base: Snapshot) -> Snapshot:
        """Publish a version with the same rows in fewer parts. Parts fall into tiers by
        size; FAN parts of one tier become one of a higher tier, so a table of n bytes
        keeps some FAN log(n) parts and every row is rewritten some log(n) times."""
        self._expect_next(base)
        run = self._run()
        parts = {name: list(found) for name, found in base.parts.items()}
        for name, found in parts.items():
            for step in range(64):
                tiers: dict[int, list[Part]] = {}
                for part in found:
                    tiers.setdefault(_tier(part.bytes), []).append(part)
                full = [tier for tier, members in tiers.items() if len(members) >= FAN]
                if not full:
                    break
                gone = tiers[min(full)]
                rows = base.rows(name, gone)
                rows = MERGED[name](rows) if name in MERGED else rows
                files = max(1, -(-sum(part.bytes for part in gone) // FILE_BYTES))
                merged = self._written(rows.coalesce(files), f"{run}/{name}/compact{step}")
                if _tier(merged.bytes) <= min(full):  # it compressed well; count it as grown
                    merged = replace(merged, bytes=SMALLEST * FAN ** min(full) + 1)
                found = [*(part for part in found if part not in gone), merged]
            parts[name] = found
        return self._publish(base.version + 1, parts)

    def _edited(self, base: Snapshot, name: str, edit: Edit, folder: str) -> list[Part]:
        """The files that hold rows concerned are found first, from the columns that tell
        so; then only these are read whole and written anew."""
        concerned = edit.touched(base.rows(name, file=True)).select("_file").distinct()
        touched = {_plain(row._file) for row in concerned.collect()}
        if not touched:
            return base.parts[name]
        kept: list[Part] = []
        anew: list[Part] = []
        for part in base.parts[name]:
            held = files_under(self.spark, part)
            if touched.isdisjoint(held):
                kept.append(part)
            else:
                files = [Part(path, self.files.bytes(path), part.layout) for path in held]
                kept += [file for file in files if file.path not in touched]
                anew += [file for file in files if file.path in touched]
        return [*kept, self._written(edit.rewritten(base.rows(name, anew)), folder)]

    def _run(self) -> str:
        return f"{self.root}/data/{uuid.uuid4().hex}"

    def _found(self, path: str) -> Part:
        return Part(path, self.files.bytes(path), self.spark.read.parquet(path).schema.json())

    def _written(self, frame: DataFrame, path: str) -> Part:
        frame.write.parquet(path)
        return Part(path, self.files.bytes(path), frame.schema.json())

    def _expect_next(self, base: Snapshot) -> None:
        if self.files.names(self._manifest(base.version + 1)):
            raise Conflict(f"version {base.version + 1} was published by another run")

    def _publish(self, version: int, parts: Mapping[str, list[Part]]) -> Snapshot:
        listed = [(name, i, part.path, part.bytes, part.layout) for name, found in parts.items() for i, part in enumerate(found)]
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        self.spark.createDataFrame(listed, _LISTED).coalesce(1).write.parquet(staged)
        if not self.files.move_if_absent(staged, self._manifest(version)):
            raise Conflict(f"version {version} was published by another run")
        return Snapshot(self.spark, version, dict(parts))


def _plain(uri: str) -> str:
    """A file's place as reading takes it: Spark gives it as an escaped URI."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def _local(path: str) -> str:
    return urlparse(path).path if path.startswith("file:") else path


def files_under(spark: SparkSession, part: Part) -> list[str]:
    found = spark.read.schema(StructType.fromJson(json.loads(part.layout))).parquet(part.path)
    return [_plain(uri) for uri in found.inputFiles()]


def _tier(size: int) -> int:
    tier = 0
    while size > SMALLEST * FAN**tier:
        tier += 1
    return tier
