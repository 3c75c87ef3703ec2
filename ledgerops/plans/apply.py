"""Write change sets beside the tables they change, and publish them all at once."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ledgerops.functions.columns import add_missing
from ledgerops.plans.generate import Changes
from ledgerops.sources.schemas import SCHEMAS
from ledgerops.sources.tables import wall_clock

Paths = dict[str, list[str]]
MANIFEST = "manifest"
_LISTED = "table_name string, part int, path string"


def write_changes(
    spark: SparkSession, changes: Changes, current: Mapping[str, list[str]], run_folder: str
) -> Paths:
    """Write one run under `run_folder`, which must not exist yet, and return the paths
    that hold each table from now on.

    Nothing that is there already is touched, so every change set can be computed
    while it is written, once. A replaced table gets a folder of its own, rows to add
    one more part. The manifest of all paths is one file and comes last: a run that
    fails before it has changed nothing, and can be done again into another folder."""
    paths: Paths = {name: list(parts) for name, parts in current.items()}
    for name, frame in changes.replaced.items():
        paths[name] = [f"{run_folder}/{name}/whole"]
        frame.write.parquet(paths[name][0])
    for name, frame in changes.added.items():
        part = f"{run_folder}/{name}/added"
        frame.write.parquet(part)
        paths[name] = [*paths.get(name, []), part]
    listed = [(name, i, path) for name, parts in paths.items() for i, path in enumerate(parts)]
    spark.createDataFrame(listed, _LISTED).coalesce(1).write.parquet(f"{run_folder}/{MANIFEST}")
    return paths


def published(spark: SparkSession, run_folder: str) -> Paths | None:
    """The paths a run published, or None where it did not come to its end."""
    try:
        listed = spark.read.schema(_LISTED).parquet(f"{run_folder}/{MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    paths: Paths = {}
    for row in listed.orderBy("table_name", F.col("part")).collect():
        paths.setdefault(row.table_name, []).append(row.path)
    return paths or None


class PublishedTables(Mapping[str, DataFrame]):
    """The tables that a list of paths holds, each the union of its parts."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, list[str]]):
        self.spark, self.paths = spark, paths

    def __getitem__(self, name: str) -> DataFrame:
        parts = [wall_clock(self.spark.read.parquet(path)) for path in self.paths[name]]
        united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return add_missing(united, SCHEMAS.get(name, {}))

    def __iter__(self) -> Iterator[str]:
        return iter(self.paths)

    def __len__(self) -> int:
        return len(self.paths)


def next_version(current: DataFrame, changes: Changes, name: str) -> DataFrame:
    """The table as it is after the run, as a DataFrame."""
    frame = changes.replaced.get(name, current)
    if name in changes.added:
        frame = frame.unionByName(changes.added[name], allowMissingColumns=True)
    return frame
