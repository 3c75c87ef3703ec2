"""Approximate nearest neighbours: a permutation index with pivot inverted files."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerops.llm.common import stored

PIVOTS = 256
LISTED = 64  # nearest pivots that stand for a vector
SPREAD = 0.7  # cosine to a chosen pivot from which a candidate is passed over
RERANKED = 0.12  # share of a block that is compared exactly, if the audit finds no more is needed
LEAST_RERANKED = 1024  # and never fewer
ROWS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 1_024
AUDITED = 256  # queries that are compared with all rows
RECALL = 0.92  # of their neighbours, on average over the worse half of them


def sound(vector: str) -> Column:
    """Vectors that take part: no null, no missing or non-finite number, not all zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return (
        F.col(vector).isNotNull()
        & ~F.coalesce(F.exists(vector, bad), F.lit(True))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def permutations(vectors: np.ndarray, pivots: np.ndarray, listed: int) -> np.ndarray:
    """For each vector its nearest pivots, nearest first, by inner product."""
    near = vectors @ pivots.T
    part = np.argpartition(-near, listed - 1, axis=1)[:, :listed]
    values = np.take_along_axis(near, part, axis=1)
    return np.take_along_axis(part, np.lexsort((part, -values), axis=1), axis=1)


def spread(candidates: np.ndarray, count: int) -> np.ndarray:
    """`count` of the candidates in their order, those near a chosen one only where too
    few others are left, so that a large group of near copies takes few pivots."""
    norm = np.sqrt((candidates**2).sum(axis=1, keepdims=True))
    unit = candidates / norm
    chosen: list[int] = []
    for i in range(len(unit)):
        if len(chosen) == count:
            break
        if not chosen or (unit[chosen] @ unit[i]).max() < SPREAD:
            chosen.append(i)
    rest = np.setdiff1d(np.arange(len(unit)), chosen)
    return candidates[[*chosen, *rest.tolist()][:count]]


def inner(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed number by number."""
    total = np.zeros(len(vectors))
    for i in range(vectors.shape[1]):
        total += query[i] * vectors[:, i]
    return total


class Postings:
    """The inverted files of one block: for each pivot the vectors that list it."""

    def __init__(self, vectors: np.ndarray, pivots: np.ndarray, listed: int) -> None:
        lists = permutations(vectors, pivots, listed)
        ranks = np.tile(np.arange(listed), (len(vectors), 1)).ravel()
        rows = np.repeat(np.arange(len(vectors)), listed)
        order = np.argsort(lists.ravel(), kind="stable")
        self.rows, self.ranks = rows[order], ranks[order].astype(np.int32)
        self.edges = np.searchsorted(lists.ravel()[order], np.arange(len(pivots) + 1))
        self.size, self.listed = len(vectors), listed

    def closeness(self, listing: np.ndarray) -> np.ndarray:
        """Footrule distance with unlisted pivots at rank `listed`, turned about: a pivot
        on both lists brings `listed` less the worse of its two ranks, and the distance
        is a constant less twice the sum."""
        total = np.zeros(self.size, np.int64)
        for rank, pivot in enumerate(listing.tolist()):
            at = slice(self.edges[pivot], self.edges[pivot + 1])
            total[self.rows[at]] += self.listed - np.maximum(self.ranks[at], rank)
        return total


def searcher(pivots: np.ndarray, nearest: int, share: float) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    listed = min(LISTED, len(pivots))

    def search(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []
        if len(rows) and len(queries):
            rows = rows.sort_values("id", kind="stable")
            ids, vectors = rows["id"].to_numpy(), matrix(rows["vector"])
            postings = Postings(vectors, pivots, listed)
            looked = matrix(queries["vector"])
            most = max(LEAST_RERANKED, math.ceil(share * len(ids)))
            for query, vector, listing in zip(queries["id"].tolist(), looked, permutations(looked, pivots, listed)):
                # ties keep the order of ids, so equal vectors give their smallest ids
                order = postings.closeness(listing) * len(ids) - np.arange(len(ids))
                order[ids == query] = np.iinfo(np.int64).min
                pick = np.argpartition(-order, most - 1)[:most] if most < len(ids) else np.arange(len(ids))
                pick = np.sort(pick[ids[pick] != query])
                score = inner(vector, vectors[pick])
                best = np.argsort(-score, kind="stable")[:nearest]
                found.append((np.full(len(best), query), ids[pick[best]], score[best]))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [[], [], []]
        kinds = {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        return pd.DataFrame(dict(zip(kinds, columns))).astype(kinds)

    return search


def auditor(pivots: np.ndarray, nearest: int, queries: pd.DataFrame) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The `nearest` rows of a block to each query, by comparison with all, and the share
    of the block that has to be compared to find each of them."""
    listed = min(LISTED, len(pivots))
    least = LEAST_RERANKED

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        ids, vectors = rows["id"].to_numpy(), matrix(rows["vector"])
        postings = Postings(vectors, pivots, listed)
        looked, found = matrix(queries["vector"]), []
        for query, vector, listing in zip(queries["id"].tolist(), looked, permutations(looked, pivots, listed)):
            order = postings.closeness(listing) * len(ids) - np.arange(len(ids))
            order[ids == query] = np.iinfo(np.int64).min
            place = np.empty(len(ids), np.int64)
            place[np.argsort(-order, kind="stable")] = np.arange(1, len(ids) + 1)
            score = inner(vector, vectors)
            score[ids == query] = -np.inf
            best = np.argsort(-score, kind="stable")[:nearest]
            best = best[ids[best] != query]
            needed = np.where(place[best] <= least, 0.0, place[best] / len(ids))
            found.append((np.full(len(best), query), ids[best], score[best], needed))
        columns = [np.concatenate(x) for x in zip(*found)]
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score", "needed"], columns)))

    return look


def reranked(held: DataFrame, asked: DataFrame, pivots: np.ndarray, nearest: int) -> float:
    """The share of each block to compare, so that audited queries have RECALL."""
    queries = asked.orderBy(F.xxhash64(F.lit(1), "id"), "id").limit(AUDITED).select("id", "vector").toPandas()
    if queries.empty:
        return RERANKED
    look = auditor(pivots, nearest, queries)
    found = held.groupBy("block").applyInPandas(look, "query_id long, vec_id long, score double, needed double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).toPandas()
    share = RERANKED
    while share < 1 and len(best):
        hits = (best["needed"] <= share).groupby(best["query_id"]).mean().sort_values()
        if hits[: math.ceil(len(hits) / 2)].mean() >= RECALL:
            break
        share = min(1.0, share * 1.1)
    return share


def nearest_neighbours(
    vectors: DataFrame, queries: Column, nearest: int = 20, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets `queries` the `nearest`
    other rows with the largest inner product found, ties to the smaller id.

    PIVOTS vectors that stand apart, the first by a hash of their id, are pivots. Every vector is posted
    under its LISTED nearest pivots. Rows and queries are dealt into blocks and each
    pair of blocks is searched by itself: vectors are ranked by the footrule distance
    of their pivot lists and the first share of a block is compared exactly. That share
    is RERANKED, or larger where audited queries, compared with all rows, need more of
    it for RECALL on average over the worse half of them; at most it is the block.
    Blocks of up to LEAST_RERANKED rows are therefore searched exactly.

    Vectors that are null, all zero or hold missing or non-finite numbers take no part,
    nor do rows without id or of another length than most have. Equal ids are
    one vector: one of its rows counts. With fewer candidates all are returned. Other
    columns are ignored; an empty table gives no rows."""
    rows = stored(
        vectors.where(sound(vector) & F.col(vec_id).isNotNull())
        .select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asks"))
        .groupBy("id").agg(F.min("vector").alias("vector"), F.max("asks").alias("asks")),
        "vectors",
    )
    spark = rows.sparkSession
    widths = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    schema = "query_id long, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], schema).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    rows = rows.where(F.size("vector") == widths.width)
    first = rows.orderBy(F.xxhash64("id"), "id").limit(16 * PIVOTS).select("vector").toPandas()
    distinct = list(dict.fromkeys(tuple(v) for v in first["vector"]))
    pivots = spread(np.array(distinct), PIVOTS)
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    blocks, parts = math.ceil(total / ROWS_PER_BLOCK), max(1, math.ceil(asked / QUERIES_PER_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = rows.select("id", "vector", deal(blocks).alias("block"), each(parts).alias("part"))
    posed = rows.where("asks").select("id", "vector", deal(parts).alias("part"), each(blocks).alias("block"))
    tasks = min(blocks * parts, 4096)
    share = RERANKED
    if total > LEAST_RERANKED:
        share = reranked(rows.select("id", "vector", deal(blocks).alias("block")), rows.where("asks"), pivots, nearest)
    found = (
        held.repartition(tasks, "block", "part").groupBy("block", "part")
        .cogroup(posed.repartition(tasks, "block", "part").groupBy("block", "part"))
        .applyInPandas(searcher(pivots, nearest, share), schema)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")
