"""Mixing sources to target weights: a splitting tree deals block quotas to shards.

Everything here is DataFrame expressions. A source's documents fall into blocks by a
hash; a draw is one pass of one block. The draws of all sources are split among the
output shards by a binary tree: at every node the left half gets a multivariate
hypergeometric share of each source's draws. Leaves then take disjoint runs of each
source's draws in a random order, and every shard is shuffled by itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import SPACE, stored, text_of

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
WORDS_PER_BLOCK = 65_536
LEVELS = 6  # 64 shards
SEED = 20_240_607


def _uniform(*parts: Column) -> Column:
    """A number from 0 to below 1 that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) * F.lit(2.0**-53)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """`sources` (source, source_size) plus `target`. Weights repeat over the sources in
    code-point order, null last, and share the sum of all sizes. A target stops at
    `most` times its source's size and the excess goes to the others by weight.

    With sources in order of size over weight, those that stop come first; the first
    one that does not gives the level of all the rest. One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy()
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    weighed = (
        sources.withColumn("_weight", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    )
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = weighed.withColumn("_level", left / weight)
    free = F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", F.col("source").isNull(), "source", "_level"))
    first = F.min(free).over(every)["_level"]
    return (
        level.withColumn("target", F.coalesce(F.least("_cap", first * F.col("_weight")), F.col("_cap")))
        .select(*sources.columns, "target")
    )


def _walk(steps: Column, ratio, goal: Column) -> Column:
    """Adds up weights from the mode's 1 on, each the one before times `ratio`; where the
    sum first exceeds `goal`, `found` is that number of steps."""
    start = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(-1).cast("bigint").alias("found"))

    def step(state: Column, j: Column) -> Column:
        total = state["sum"] + state["w"]
        return F.struct(
            (state["w"] * ratio(j)).alias("w"),
            total.alias("sum"),
            F.when((state["found"] < 0) & (total > goal), j).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), steps), start, step)


def _let(value: Column, use) -> Column:
    """`use` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(pool: Column, good: Column, drawn: Column, uniform: Column) -> Column:
    """How many of `drawn` items, taken from `pool` with `good` of one kind, are of that
    kind: inversion outwards from the mode, over all values whose weight a double can
    tell from nothing."""
    one = F.lit(1).cast("bigint")
    low, high = F.greatest(F.lit(0).cast("bigint"), drawn + good - pool), F.least(drawn, good)
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1) * (good + 1) / (pool + 2))))
    share = good / F.greatest(pool, one)
    reach = F.ceil(F.sqrt(drawn * share * (1 - share)) * 12 + 40).cast("bigint")
    odds = F.struct(
        pool.alias("pool"), good.alias("good"), drawn.alias("drawn"), mode.alias("mode"), uniform.alias("u"),
        F.least(high - mode, reach).alias("ups"), F.least(mode - low, reach).alias("downs"),
    )

    def of(a: Column) -> Column:
        good, drawn, rest = a["good"], a["drawn"], a["pool"] - a["good"] - a["drawn"]

        def up(j: Column) -> Column:
            k = a["mode"] + j
            return (good - k) * (drawn - k) / ((k + 1) * F.greatest(one, rest + k + 1))

        def down(j: Column) -> Column:
            k = a["mode"] - j
            return k * (rest + k) / F.greatest(one, (good - k + 1) * (drawn - k + 1))

        def pick(sums: Column) -> Column:
            goal = a["u"] * (sums["above"] + sums["below"] - 1)
            rise = lambda g: a["mode"] + F.greatest(_walk(a["ups"], up, g)["found"], F.lit(0))
            fall = lambda g: a["mode"] - F.greatest(_walk(a["downs"], down, g)["found"], F.lit(0))
            return _let(
                goal, lambda g: F.when(g < sums["above"], _let(g, rise)).otherwise(_let(g - sums["above"] + 1, fall))
            )

        never = F.lit(float("inf"))
        both = F.struct(
            _walk(a["ups"], up, never)["sum"].alias("above"), _walk(a["downs"], down, never)["sum"].alias("below")
        )
        return _let(both, pick)

    return _let(odds, of)


def split_quotas(quotas: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(source, shard, first, last): the run of each source's draws, counted from 1, that
    every shard takes. `quotas` has (source, quota), one row per source."""
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "quota"))).alias("all"))
    nodes = nodes.select(F.lit(0).alias("node"), "all", F.transform("all", lambda x: x["quota"]).alias("quotas"))
    for level in range(levels):
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda a, x: a + x)
        odd = F.when(_uniform(F.lit(level), F.col("node"), F.lit("odd")) < 0.5, 1).otherwise(0)
        start = F.struct(
            total.alias("pool"), F.floor((total + odd) / 2).alias("drawn"), F.lit(0).alias("i"),
            F.array().cast("array<bigint>").alias("out"),
        )

        at = F.lit(level)

        def deal(state: Column, good: Column) -> Column:
            share = hypergeometric(state["pool"], good, state["drawn"], _uniform(at, F.col("node"), state["i"]))
            return _let(
                share,
                lambda k: F.struct(
                    (state["pool"] - good).alias("pool"), (state["drawn"] - k).alias("drawn"),
                    (state["i"] + 1).alias("i"), F.concat(state["out"], F.array(k)).alias("out"),
                ),
            )

        halves = nodes.withColumn("left", F.aggregate("quotas", start, deal)["out"]).select(
            "node", "all", "left", F.zip_with("quotas", "left", lambda a, b: a - b).alias("right")
        )
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.col("right").alias("quotas")),
        )
        nodes = halves.select("all", F.explode(both).alias("half")).select("half.node", "all", "half.quotas")
    one = F.arrays_zip(F.col("all").alias("of"), F.col("quotas").alias("n"))
    leaves = nodes.select(F.col("node").alias("shard"), F.explode(one).alias("x"))
    leaves = leaves.select(F.col("x.of.source").alias("source"), "shard", F.col("x.n").alias("n"))
    sofar = Window.partitionBy("source").orderBy("shard")
    return leaves.select(
        "source", "shard",
        (F.sum("n").over(sofar) - F.col("n") + 1).alias("first"), F.sum("n").over(sofar).alias("last"),
    )


class Mixture:
    """The tables of one mix of `docs` (doc_id, text, source).

    `rows`: one row per input row: doc_id, source, mark, size (words; null text: 0).
    `goals`: source, source_size, target, and the pass and block up to which it is read.
    `draws`: doc_id, source, mark, pass, shard, place, one row for every time that a
    document is taken; `place` orders a shard. Repeated rows count and are taken
    together. Rows with a null source form one source. A source without words has
    target 0 and gives nothing. Empty texts of a source ride along with its blocks.

    Whole passes take all blocks; the last pass takes blocks in order and, in the one
    that reaches the target, documents up to it, so that a source comes within half a
    document of its target. Any order depends on hashes alone: reruns agree."""

    def __init__(self, docs: DataFrame, levels: int = LEVELS, words_per_block: int = WORDS_PER_BLOCK) -> None:
        mark = F.xxhash64("doc_id", "source", "text")
        size = F.regexp_count(text_of(), F.lit(SPACE)).cast("bigint")
        self.rows = stored(docs.select("doc_id", "source", mark.alias("mark"), size.alias("size")), "sizes")
        units = self.rows.groupBy("doc_id", "source", "mark").agg(F.sum("size").alias("words"))
        sizes = self.rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        goals = targets(sizes)
        self.goals = stored(
            goals.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / words_per_block)).cast("bigint"))
            .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
            .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
            "goals",
        )
        key = _key("source")
        dealt = join_spread(
            units.withColumn("_s", key), self.goals.select(key.alias("_s"), "blocks"), ["_s"], "inner"
        ).withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "mark"), F.col("blocks"))).drop("blocks")
        dealt = stored(dealt, "blocks")

        earlier = Window.partitionBy("_s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = dealt.groupBy("_s", "block").agg(F.sum("words").alias("words"))
        blocks = blocks.withColumn("ahead", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        blocks = blocks.join(self.goals.select(key.alias("_s"), "whole", "rest"), "_s")
        partial = F.col("ahead") < F.col("rest")
        passes = F.when(partial, F.col("whole")).otherwise(F.col("whole") - 1)
        order = Window.partitionBy("_s").orderBy(F.xxhash64(F.lit(SEED), "pass", "block"), "pass", "block")
        drawn = (
            blocks.where(passes >= 0)
            .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), passes)))
            .withColumn("cut", F.when((F.col("pass") == F.col("whole")) & (F.col("ahead") + F.col("words") > F.col("rest")), F.col("rest") - F.col("ahead")))
            .withColumn("turn", F.row_number().over(order))
        )
        drawn = stored(drawn.select("_s", "block", "pass", "cut", "turn"), "turns")
        runs = split_quotas(drawn.groupBy(F.col("_s").alias("source")).agg(F.count(F.lit(1)).alias("quota")), levels)
        ends = runs.groupBy(F.col("source").alias("_s")).agg(F.array_sort(F.collect_list("last")).alias("ends"))
        sharded = join_spread(drawn, ends, ["_s"], "inner").withColumn(
            "shard", F.size(F.filter("ends", lambda x: x < F.col("turn")))
        ).drop("ends", "turn")
        whole = sharded.where("cut is null").drop("cut")
        cut = sharded.where("cut is not null")
        taken = join_spread(dealt, whole, ["_s", "block"], "inner").select("doc_id", "source", "mark", "pass", "shard")
        inside = Window.partitionBy("_s", "block", "pass").orderBy(F.xxhash64(F.lit(SEED + 1), "mark"), "doc_id")
        last = (
            dealt.join(cut, ["_s", "block"])
            .withColumn("_sofar", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("_sofar") - F.col("words") / 2 <= F.col("cut"))
            .select("doc_id", "source", "mark", "pass", "shard")
        )
        place = F.xxhash64(F.lit(SEED + 2), "mark", "pass")
        self.draws = stored(taken.unionByName(last).withColumn("place", place), "draws")


def _key(name: str) -> Column:
    """A source's name that is never null and keeps null apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of `docs`; `taken` is the
    number of its words in the mix, repeats counted."""
    mix = Mixture(docs)
    times = mix.draws.groupBy("mark", "doc_id").agg(F.count(F.lit(1)).alias("times"))
    times = times.select(F.col("mark").alias("_mark"), F.col("doc_id").alias("_doc"), "times")
    rows = mix.rows
    counted = rows.join(times, (rows["mark"] == times["_mark"]) & rows["doc_id"].eqNullSafe(times["_doc"]), "left")
    goals = mix.goals.select(_key("source").alias("_s"), "source_size", "target")
    return join_spread(counted.withColumn("_s", _key("source")), goals, ["_s"], "left").select(
        "doc_id", "size", "source_size", "target",
        (F.coalesce("times", F.lit(0)) * F.col("size")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of `docs` with all their columns, once for every time they
    are taken, plus mix_shard and mix_place, in order within each shard."""
    found = Mixture(docs).draws.select(
        F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"),
        F.col("shard").alias("mix_shard"), F.col("place").alias("mix_place"),
    )
    own = docs.drop("mix_shard", "mix_place").withColumn("__own", F.xxhash64("doc_id", "source", "text"))
    same = own["doc_id"].eqNullSafe(found["__doc"]) & (own["__own"] == found["__mark"])
    return own.join(found, same).drop("__doc", "__mark", "__own").repartition("mix_shard").sortWithinPartitions("mix_shard", "mix_place")
