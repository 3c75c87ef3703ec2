"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # small map tasks: what they sort or sum up before a shuffle stays in memory
    "spark.sql.files.maxPartitionBytes": "32MB",
    # equal keys of a collation have equal hashes, which `join_spread` relies on
    "spark.sql.legacy.collationAwareHashFunctions": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the jobs rely on."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def name_local_folder(spark: SparkSession) -> SparkSession:
    """For entry points and tests: give a session on one machine a folder of its own if
    it names none. A session on a cluster is left alone and has to name a shared one."""
    one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if one_machine and not _named(spark):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgerops-"))
    return spark


def _named(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors share."""
    folder = _named(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@dataclass(frozen=True)
class Dealt:
    """A frame that is dealt to so many partitions by the column `by`. It is written in
    `slices` one after the other, so that the disk holds the shuffle files of one."""

    frame: DataFrame
    by: str
    buckets: int
    slices: int = 1


def keep(frame: DataFrame | Dealt, name: str) -> DataFrame:
    """Write the frame as a table to the shared folder and read it back.

    Later steps then read the same rows from storage, whatever executors are
    lost, and fetch only the columns they use. The shuffle files of the write go as
    soon as it is done, so that steps do not add up on disk. The table of a dealt frame
    says how it lies, and what groups or joins by that column reads it so."""
    with _set(_session(frame), SHUFFLE_CLEANUP, "true"):
        return _keep_dealt(frame, name) if isinstance(frame, Dealt) else _keep(frame, name)


def keep_in_place(frame: DataFrame, name: str) -> DataFrame:
    """`keep` for a join of frames that lie by one of its keys: they are joined where they
    lie, and are not moved to lie by all keys. Rows of one such key meet in one task."""
    with in_place(frame.sparkSession):
        return keep(frame, name)


def in_place(spark: SparkSession) -> AbstractContextManager[None]:
    """Joins that are run meanwhile leave a side that lies by some of their keys there."""
    return _set(spark, ALL_KEYS, "false")


def _session(frame: DataFrame | Dealt) -> SparkSession:
    return (frame.frame if isinstance(frame, Dealt) else frame).sparkSession


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session option for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _keep_dealt(dealt: Dealt, name: str) -> DataFrame:
    spark = dealt.frame.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    number = F.pmod(F.xxhash64(dealt.by), F.lit(dealt.slices))
    for i in range(dealt.slices):
        frame = dealt.frame if dealt.slices == 1 else dealt.frame.where(number == i)
        (
            frame.write.format("parquet").option("compression", "zstd").bucketBy(dealt.buckets, dealt.by).mode("append")
            .option("path", f"{shared_folder(spark)}/ledgerops/{table}").saveAsTable(table)
        )
    return spark.table(table)


def _keep(frame: DataFrame, name: str) -> DataFrame:
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/ledgerops/{uuid.uuid4().hex}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
