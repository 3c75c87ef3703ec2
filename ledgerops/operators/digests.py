"""Two stores compared by digests of key buckets: only buckets that differ are looked at.

A bucket is a range of the key's hash. Its digest does not depend on the order of rows:
their number, and the sum and the exclusive or of their hashes. Both stores are read once,
and of each no more than one row per bucket and task leaves the reading tasks. Buckets
whose digests agree hold the same rows (but for a collision of two 64-bit sums) and take no
part in any join. Summing is done level by level: the fine buckets first, then the coarse
ones that they make up, so that stores which agree are told so by few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COARSE, FINE = 256, 256  # coarse buckets, and fine ones in each


def bucket(key: str) -> Column:
    """The fine bucket of a key; a missing key has one too."""
    return F.pmod(F.xxhash64(F.lit("bucket"), F.col(key)), F.lit(COARSE * FINE))


def digests(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """(bucket, rows, total, mixed) over the key and what else is to agree."""
    # a null leaves a hash as it is, so which columns are null is hashed with them
    nulls = [F.col(name).isNull() for name in (key, *columns)]
    mark = F.xxhash64(key, *columns, *nulls)
    return rows.groupBy(bucket(key).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(mark.cast("decimal(20,0)")).alias("total"),
        F.bit_xor(mark).alias("mixed"),
    )


def coarse(fine: DataFrame) -> DataFrame:
    return fine.groupBy(F.floor(F.col("bucket") / FINE).alias("bucket")).agg(
        F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed")
    )


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.select(F.col("bucket"), *[F.col(name).alias(f"_{name}") for name in ("rows", "total", "mixed")])
    same = F.lit(True)
    for name in ("rows", "total", "mixed"):
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    return left.join(other, "bucket", "full_outer").where(~same).select("bucket")


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(bucket) of the fine buckets whose digests differ, at most COARSE * FINE rows. The
    coarse ones are compared first; fine ones only within those that differ."""
    wide = _differing(coarse(left), coarse(right)).withColumnRenamed("bucket", "_wide")

    def near(fine: DataFrame) -> DataFrame:
        return fine.join(F.broadcast(wide), F.floor(F.col("bucket") / FINE) == F.col("_wide"), "left_semi")

    return _differing(near(left), near(right))


def inside(rows: DataFrame, key: str, buckets: DataFrame) -> DataFrame:
    """The rows in these buckets. The list is broadcast: COARSE * FINE numbers at most."""
    return rows.join(F.broadcast(buckets.select(F.col("bucket").alias("_bucket"))), bucket(key) == F.col("_bucket"), "left_semi")
