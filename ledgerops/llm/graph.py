"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored

MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another one; root is the smallest
    node it reaches. Rows with a null end, loops and repeated links change nothing;
    an empty input gives an empty result.

    Every round writes the links to the shared folder. A round replaces links by
    links to the smallest neighbour, so a hub never gathers its neighbours in one
    task: minima are combined before the shuffle and the join is splittable."""
    links = stored(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    for _ in range(MOST_ROUNDS):
        if _is_star_forest(links):
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        links = stored(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _is_star_forest(links: DataFrame) -> bool:
    ends = links.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    roots = links.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("root"))
    seen = ends.unionByName(roots).groupBy("n").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return seen.where(F.col("up") + F.col("root") > 1).isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where(F.col("v") > F.col("u"))
    return join_spread(larger, least, ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        join_spread(links, least, ["u"], "inner")
        .where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
