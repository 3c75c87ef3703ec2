"""Joins that one key dominates are split at run time, with the same rows as before."""

from datetime import datetime
from decimal import Decimal

import pytest
from compare import plan
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.operators import costing

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def tiny_partitions(spark):
    before = {name: spark.conf.get(name, None) for name in SMALL_PARTITIONS}
    for name, value in SMALL_PARTITIONS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def hot(spark, rows=60_000):
    """Half of the rows share one key."""
    n = F.col("id")
    return spark.range(0, rows, 1, 8).select(
        F.when(n % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (n % 500).cast("string"))).alias("k"),
        n.alias("row"),
        F.sha2(n.cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_grouped_side_does_not_hide_the_hot_key(tiny_partitions, how):
    spark = tiny_partitions
    left = hot(spark)
    right = left.groupBy("k").agg(F.max("row").alias("top"))
    joined = join_spread(left, right, ["k"], how)
    assert joined.count() == left.count()
    rows = joined.collect()
    assert len(rows) == 60_000 and all(r.top is not None for r in rows)
    assert "skew=true" in plan(joined)
    plainly = left.join(right, "k", how)
    plainly.collect()
    assert "skew=true" not in plan(plainly)


def test_lines_of_one_item_are_costed_in_several_tasks(tiny_partitions):
    spark = tiny_partitions
    day = datetime(2024, 5, 1)
    lines = hot(spark).select(
        F.col("payload").alias("ref_id"),
        F.col("k").alias("inventory_item_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit("S").alias("stock_id"),
        F.lit(day).cast("timestamp_ntz").alias("ref_date"),
        F.lit("U").alias("unit_id"),
        F.lit(Decimal(2)).cast("decimal(21,6)").alias("quantity"),
        F.lit(0).cast("decimal(21,6)").alias("unit_price"),
        F.lit(0).cast("decimal(21,6)").alias("amount"),
    )
    points = costing.issue_points(lines)
    held = points.select(
        "*",
        F.lit(Decimal(10)).cast("decimal(38,6)").alias("closing_quantity"),
        F.lit(Decimal(50)).cast("decimal(38,6)").alias("closing_amount"),
    )
    rates = spark.createDataFrame(
        [("hot", "U", Decimal(2)), ("hot", "U", Decimal(1))],
        "inventory_item_id string, unit_id string, convert_rate decimal(21,6)",
    )
    costed = costing.cost_lines(lines, held, rates)
    got = {(r.inventory_item_id == "hot", r.unit_price) for r in costed.collect()}
    assert got == {(True, Decimal(10)), (False, Decimal(5))}
    assert plan(costed).count("skew=true") >= 1
