"""Session settings, table reads and lineage cuts shared by the text operators."""

from __future__ import annotations

import sys
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerops
from ledgerops.session import keep, tune

ROWS_PER_BATCH = 512
SPACE = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime options of the text operators: short Arrow batches, since one text may be
    long, and the package itself on the executors."""
    tune(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def _ship(spark: SparkSession) -> None:
    """Let Spark hand the package's sources to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(ledgerops.__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="ledgerops-")) / "ledgerops.zip"
    with zipfile.ZipFile(path, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back (`keep`)."""
    return keep(frame, name)


def text_of(column: str = "text") -> Column:
    """A missing text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ENTRY_BYTES = 120  # a dictionary slot and two object references, generously


class Recent:
    """A memo of at most `most` bytes: the newer half of what was put or asked for lately.
    Sizes are those of keys and values as Python objects, plus ENTRY_BYTES."""

    def __init__(self, most: int) -> None:
        self.most = most // 2
        self.held = 0
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value

    def put(self, key, value) -> None:
        size = sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
        if self.held + size > self.most:
            self.old, self.new, self.held = self.new, {}, 0
        self.new[key] = value
        self.held += size
