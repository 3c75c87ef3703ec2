"""Embedding near-dedup: NN-descent, then exact links within what it has joined."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.ann import sound
from ledgerops.llm.common import partitions, stored
from ledgerops.llm.graph import components

LIST = 8  # neighbours that a list holds at first
ORDERS = 6  # random orders from which the first lists come
AHEAD = 4  # rows behind a row in such an order that it is compared with
FAR_AHEAD = 32  # the same in the orders that a missed audit adds
LEAST_ROUNDS, MOST_ROUNDS = 2, 40
AUDITED, MOST_AUDITED = 512, 8_192  # vectors that are compared with all others
ENOUGH = 300  # audited vectors with LIST links or fewer
AUDITED_LINKS = 64  # of one vector
RECALL = 0.98  # of the audited links
ROWS_PER_BLOCK = 1_024
SEED = 11

_PAIRS = "a long, b long, cosine double"
_PAIRS_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cosine", pa.float64())])


def _vectors(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _pairs(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(cosine)], schema=_PAIRS_ARROW)


def first_pairs(rows: DataFrame, width: int, seed: int = SEED, ahead: int = AHEAD, least: float = -2.0) -> DataFrame:
    """Pairs of rows that stand near each other in random orders, with a cosine of
    `least` or more. An order sorts by the signs of random projections, most of them
    first, then by one projection; a hot vector is spread over its neighbours in the
    order, never gathered."""
    draw = np.random.default_rng(seed)
    planes = draw.normal(size=(ORDERS, 25, width))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column(1))
            for number in range(ORDERS):
                sides = vectors @ planes[number].T
                code = ((sides[:, :24] > 0) * (1 << np.arange(23, -1, -1))).sum(axis=1).astype(np.float64)
                spot = code + 0.5 + np.clip(sides[:, 24] / 10, -0.49, 0.49)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(vectors), number, np.int32)), pa.array(spot), batch.column(0), batch.column(1)],
                    ["number", "spot", "id", "vector"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = np.zeros(0, np.int64), None
        for batch in batches:
            own_ids, own = batch.column(2).to_numpy(), _vectors(batch.column(3))
            fresh = len(ids)
            ids = np.concatenate([ids, own_ids])
            vectors = own if vectors is None else np.concatenate([vectors, own])
            for gap in range(1, ahead + 1):
                ends = np.arange(max(gap, fresh), len(ids))
                if len(ends):
                    cosine = np.einsum("ij,ij->i", vectors[ends], vectors[ends - gap])
                    far = (ids[ends] != ids[ends - gap]) & (cosine >= least)
                    yield _pairs(ids[ends - gap][far], ids[ends][far], cosine[far])
            ids, vectors = ids[-ahead:], vectors[-ahead:]

    placed = rows.mapInArrow(place, "number int, spot double, id long, vector array<double>")
    tasks = partitions(rows.sparkSession)
    ordered = placed.repartitionByRange(tasks, "number", "spot", "id").sortWithinPartitions("number", "spot", "id")
    return ordered.mapInArrow(compare, _PAIRS)


def nearest_lists(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The best pairs of each row, as many as its list holds: (node, other, cosine)."""
    best = pairs.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    both = best.select(F.col("a").alias("node"), F.col("b").alias("other"), "cosine").unionByName(
        best.select(F.col("b").alias("node"), F.col("a").alias("other"), "cosine")
    )
    order = Window.partitionBy("node").orderBy(F.desc("cosine"), "other")
    sized = both.join(sizes, "node", "left").withColumn("size", F.coalesce("size", F.lit(LIST)))
    return sized.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= F.col("size")).select("node", "other", "cosine")


def neighbour_pairs(lists: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs of neighbours of one row, lists read in both directions. A neighbour keeps
    its LIST nearest among the others, and all beyond the threshold."""
    ends = lists.select("node", "other").unionByName(lists.select(F.col("other").alias("node"), F.col("node").alias("other")))
    around = join_spread(ends.distinct(), rows.select(F.col("id").alias("other"), "vector"), ["other"], "inner")
    tasks = partitions(rows.sparkSession)
    ordered = around.select("node", "other", "vector").repartition(tasks, "node").sortWithinPartitions("node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, vectors in _groups(batches):
            for at in range(0, len(ids), ROWS_PER_BLOCK):
                own = ids[at : at + ROWS_PER_BLOCK]
                near = vectors[at : at + ROWS_PER_BLOCK] @ vectors.T
                near[np.arange(len(own)), at + np.arange(len(own))] = -2
                keep = near >= threshold
                if len(ids) > LIST:
                    top = np.argpartition(-near, LIST - 1, axis=1)[:, :LIST]
                    np.put_along_axis(keep, top, True, axis=1)
                else:
                    keep[:] = True
                i, j = np.nonzero(keep & (near > -2))
                yield _pairs(own[i], ids[j], near[i, j])

    return ordered.mapInArrow(run, _PAIRS)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(key, ids, vectors) of runs with one key in rows (key, id, vector)."""
    key, ids, parts = None, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, own, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _vectors(batch.column(2))
        edges = np.flatnonzero(np.diff(keys)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
            if key is not None and keys[lo] != key:
                yield key, np.concatenate(ids), np.concatenate(parts)
                ids, parts = [], []
            key = int(keys[lo])
            ids.append(own[lo:hi])
            parts.append(vectors[lo:hi])
    if ids:
        yield key, np.concatenate(ids), np.concatenate(parts)


def audit_links(rows: DataFrame, threshold: float, audited: int) -> DataFrame:
    """(probe, few, a, b, cosine): links of the first `audited` rows by a hash of their
    id, by comparison with all; `few` marks rows with LIST links or fewer. Of more than
    AUDITED_LINKS links of one row as many are drawn."""
    some = rows.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(audited).toPandas()
    ids, probes = some["id"].to_numpy(), np.array(some["vector"].tolist())

    def thinned(place: np.ndarray, other: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mark = (other.astype(np.uint64) + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        order = np.lexsort((mark ^ (mark >> np.uint64(32)), place))
        ranked = place[order]
        keep = order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < AUDITED_LINKS]
        return place[keep], other[keep], cosine[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        links = np.zeros(len(ids), np.int64)
        for batch in batches:
            own = batch.column(0).to_numpy()
            near = _vectors(batch.column(1)) @ probes.T if len(own) else np.zeros((0, len(ids)))
            i, j = np.nonzero(near >= threshold)
            i, j = i[own[i] != ids[j]], j[own[i] != ids[j]]
            links += np.bincount(j, minlength=len(ids))
            fresh = (j, own[i], near[i, j])
            held = thinned(*(np.concatenate(x) for x in zip(held, fresh)))
        place, other, cosine = held
        first = np.diff(place, prepend=-1) != 0
        columns = [ids[place], other, cosine, np.where(first, links[place], 0)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["probe", "other", "cosine", "links"])

    found = rows.mapInArrow(run, "probe long, other long, cosine double, links long")
    each = Window.partitionBy("probe")
    drawn = found.withColumn("few", F.sum("links").over(each) <= LIST).withColumn(
        "turn", F.row_number().over(each.orderBy(F.xxhash64(F.lit(SEED), "other"), "other"))
    )
    return drawn.where(F.col("turn") <= AUDITED_LINKS).select(
        "probe", "few", F.least("probe", "other").alias("a"), F.greatest("probe", "other").alias("b"), "cosine"
    )


def audit(rows: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """Audited links, and how many vectors with few links are still wanted. The draw
    grows until it has ENOUGH of them, or all rows, or MOST_AUDITED."""
    total = rows.count()
    drawn, most = min(AUDITED, total), min(MOST_AUDITED, total)
    while True:
        truth = stored(audit_links(rows, threshold, drawn), "audit")
        held = truth.where("few").agg(F.count_distinct("probe")).first()[0]
        if held >= ENOUGH or drawn >= most:
            return truth, max(0, ENOUGH - held) if drawn < total else 0
        drawn = min(most, math.ceil(1.25 * drawn * ENOUGH / held)) if held else most


def planted(rows: DataFrame, width: int, threshold: float, number: int) -> tuple[list[int], DataFrame, DataFrame]:
    """Vectors made to stand just over the threshold from `number` rows of the table:
    their ids, which no row has, their rows and their links as audited ones."""
    spark, draw = rows.sparkSession, np.random.default_rng(SEED)
    some = rows.orderBy(F.xxhash64(F.lit(SEED + 1), "id"), "id").limit(number).toPandas()
    base = np.array(some["vector"].tolist())
    aside = draw.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    norm = np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = draw.uniform(threshold, (1 + threshold) / 2, size=(len(base), 1))
    made = cosine * base + np.sqrt(1 - cosine**2) * aside / norm
    ids = [0]
    while len(set(ids)) < len(base) or not rows.where(F.col("id").isin(ids)).isEmpty():
        ids = draw.integers(-(2**63), 2**63 - 1, len(base)).tolist()
    ghosts = spark.createDataFrame(list(zip(ids, made.tolist())), "id long, vector array<double>")
    near = (made * base).sum(axis=1).tolist()
    links = [(i, True, min(i, j), max(i, j), c) for i, j, c in zip(ids, some["id"].tolist(), near) if c >= threshold]
    return ids, ghosts, spark.createDataFrame(links, "probe long, few boolean, a long, b long, cosine double")


def recall(truth: DataFrame, pairs: DataFrame) -> float:
    """The share of its audited links that an audited vector has, on average over those
    with few links and over the others; the smaller of the two."""
    met = truth.join(pairs.select("a", "b", F.lit(1.0).alias("met")), ["a", "b"], "left")
    shares = met.groupBy("probe", "few").agg(F.avg(F.coalesce("met", F.lit(0.0))).alias("share"))
    return min([r.share for r in shares.groupBy("few").agg(F.avg("share").alias("share")).collect()], default=1.0)


def descend(rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """Pairs (a, b, cosine) of rows (id, vector of length one) at or over `threshold`.

    A round compares neighbours of neighbours and keeps each row's best. A list with
    nothing under the threshold left in it is saturated and doubles. Rounds end when
    one finds few new links and the audited vectors have RECALL of their links; while
    they do not, links from more random orders join in. Where vectors with few links
    are too rare to audit ENOUGH of them, planted ones take part and go at the end.
    A recall still missed after MOST_ROUNDS is an error."""
    truth, wanted = audit(rows, threshold)
    seen, ghosts = truth, []
    if wanted and threshold < 1:
        ghosts, more, links = planted(rows, width, threshold, wanted)
        rows = stored(rows.unionByName(more), "rows")
        truth = stored(truth.unionByName(links), "audit")
    pairs = stored(first_pairs(rows, width).groupBy("a", "b").agg(F.max("cosine").alias("cosine")), "pairs")
    sizes = rows.sparkSession.createDataFrame([], "node long, size int")
    known = -1
    for round_ in range(MOST_ROUNDS):
        lists = stored(nearest_lists(pairs, sizes), "lists")
        found = neighbour_pairs(lists, rows, threshold)
        links = pairs.where(F.col("cosine") >= threshold)
        kept = lists.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "cosine")
        every = found.unionByName(kept).unionByName(links)
        if round_ >= LEAST_ROUNDS and right < RECALL:
            every = every.unionByName(first_pairs(rows, width, SEED + round_, FAR_AHEAD, threshold))
        pairs = stored(every.groupBy("a", "b").agg(F.max("cosine").alias("cosine")), "pairs")
        state = pairs.agg(F.count_if(F.col("cosine") >= threshold)).first()[0]
        right = recall(truth, pairs)
        settled = state - known <= max(2, 0.001 * state)
        if round_ + 1 >= LEAST_ROUNDS and settled and right >= RECALL:
            break
        known = state
        full = lists.groupBy("node").agg(F.min("cosine").alias("worst"), F.count(F.lit(1)).alias("n"))
        sizes = stored(
            full.where(F.col("worst") >= threshold).select("node", (F.col("n") * 2).cast("int").alias("size")), "sizes"
        )
    if right < RECALL:
        raise RuntimeError(f"{right:.3f} of the audited links found in {MOST_ROUNDS} rounds, {RECALL} wanted")
    pairs = pairs.where((F.col("cosine") >= threshold) & ~F.col("a").isin(ghosts) & ~F.col("b").isin(ghosts))
    return pairs.unionByName(seen.select("a", "b", "cosine")).groupBy("a", "b").agg(F.max("cosine").alias("cosine"))


def count_links(members: DataFrame, threshold: float) -> DataFrame:
    """(id, links) from rows (root, id, copies, vector): how many rows of the same
    root lie at or over the threshold, copies counted.

    Lists that stay saturated are thereby enlarged to all of their component. Blocks of
    ROWS_PER_BLOCK rows are compared pair by pair, so no component meets in one task."""
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / ROWS_PER_BLOCK).cast("int")
    dealt = join_spread(members, sizes.select("root", parts.alias("parts")), ["root"], "inner").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    left = dealt.select("root", "part", every.alias("other"), "id", "copies", "vector", F.lit(True).alias("asks"))
    right = dealt.select("root", every.alias("part"), F.col("part").alias("other"), "id", "copies", "vector", F.lit(False).alias("asks"))
    tasks = partitions(members.sparkSession)
    met = left.unionByName(right).repartition(tasks, "root", "part", "other").sortWithinPartitions("root", "part", "other")
    kinds = pa.schema([("id", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ("root", "part", "other")):
            asks = table.column("asks").to_numpy(zero_copy_only=False)
            ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
            vectors = _vectors(table.column("vector").combine_chunks())
            near = vectors[asks] @ vectors[~asks].T >= threshold
            near &= ids[asks][:, None] != ids[~asks][None, :]
            yield pa.RecordBatch.from_arrays([pa.array(ids[asks]), pa.array(near @ copies[~asks])], schema=kinds)

    counted = met.select("root", "part", "other", "id", "copies", "vector", "asks").mapInArrow(run, "id long, links long")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables of neighbouring rows with equal keys."""
    last, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys], axis=1)
        edges = np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(columns)]):
            key = tuple(columns[lo].tolist())
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of `vectors`.

    Equal vectors are one row of the graph with a number of copies, so that thousands of
    copies cost as much as one. n_links counts the other rows, copies included, whose
    cosine is at or over `threshold` and that links found join; component_id is the
    smallest id reachable, kept marks the row that has it.

    Vectors that are null, all zero or hold missing or non-finite numbers link with
    nothing, nor do those of another length than most have, and rows without id; each
    is its own component (null for a missing id, and not kept). Equal ids count as one
    vector, one of its rows, and come back once for each row. Other columns are
    ignored; an empty table gives no rows."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("good", sound("vector") & F.col("id").isNotNull())
    good = rows.where("good").groupBy("id").agg(F.min("vector").alias("vector"))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    good = stored(good.select("id", F.transform("vector", lambda x: x / norm).alias("vector")), "unit")
    widths = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()
    everyone = rows.select("id")
    if widths is None:
        return everyone.select(
            F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
            F.col("id").isNotNull().alias("kept"),
        )
    good = good.where(F.size("vector") == widths.width)
    same = good.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).cast("long").alias("copies"))
    nodes = stored(same, "nodes")
    pairs = stored(descend(nodes.select("id", "vector"), widths.width, threshold), "links")
    roots = components(pairs)
    members = stored(
        nodes.join(roots, nodes["id"] == roots["node"]).select("root", "id", "copies", "vector"), "members"
    )
    links = count_links(members, threshold)
    named = nodes.join(links, "id", "left").join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    named = named.select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    own = join_spread(good, named, ["vector"], "inner").select("id", "n_links", "component_id")
    found = everyone.join(own, "id", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
