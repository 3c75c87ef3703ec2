"""SimHash near-dedup: fingerprints, blocks by the pigeonhole principle, Hamming check."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored, text_of
from ledgerops.llm.graph import components

SEED = 42
BITS = 64
CROWDED = 64  # fingerprints in a block from which midpoints are cheaper than pairs
_STEP = 255 * 64


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed 64-bit integer."""
    parts = text.lower().split()
    if not parts:
        return 0
    flat = b" ".join(parts)
    if len(parts) <= words:
        return int(np.uint64(xxhash.xxh64_intdigest(flat, SEED)).astype(np.int64))
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(parts) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(flat[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())), "<u8", len(starts)
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _STEP):
        bits = np.unpackbits(hashes[at : at + _STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # 255 rows add up within a byte
        sums = np.add.reduce(bits[:whole].reshape(-1, 255, BITS), axis=1, dtype=np.uint8)
        counts += sums.sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    value = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; texts without words get 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            marks = pa.array([fingerprint(t, words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), marks], ["doc_id", "fp"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id long, fp long")


def block_keys(fp: Column, distance: int) -> Column:
    """Of distance + 2 bit ranges two close fingerprints share at least two, so each
    pair of ranges gives a key."""
    edges = [round(i * BITS / (distance + 2)) for i in range(distance + 3)]
    masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    keys = []
    for number, (i, j) in enumerate(combinations(range(len(masks)), 2)):
        mask = masks[i] | masks[j]
        signed = mask - (1 << BITS) if mask >> 63 else mask
        keys.append(F.struct(F.lit(number).alias("no"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def near_links(marks: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between nodes of `marks` (node, fp; fp distinct) that connect all
    fingerprints at `distance` or fewer differing bits, directly or over others.

    Blocks of up to CROWDED fingerprints are joined and verified pair by pair. In a
    crowded block pairs would grow with its square; there every fingerprint posts
    all values within half the distance, and those that share such a value are
    linked to the smallest of them. Two fingerprints share one exactly if they are
    within the distance, and a value has as many posters as there are such values
    at most, so nothing is lost and no group is large."""
    if distance % 2:
        raise ValueError("the distance must be even: values midway are half of it away")
    keyed = stored(marks.select("node", "fp", F.explode(block_keys(F.col("fp"), distance)).alias("key")), "blocks")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    shared = join_spread(keyed, sizes, ["key"], "inner")
    sparse = shared.where(F.col("size") <= CROWDED).drop("size")
    other = sparse.select("key", F.col("node").alias("b"), F.col("fp").alias("other"))
    pairs = (
        sparse.join(other, "key")
        .where((F.col("node") < F.col("b")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance))
        .select(F.col("node").alias("a"), "b")
    )
    crowded = shared.where(F.col("size") > CROWDED).select("node", "fp").distinct()
    flips = [0]
    for reach in range(1, distance // 2 + 1):
        flips += [sum(1 << i for i in some) for some in combinations(range(BITS), reach)]
    signed = [x - (1 << BITS) if x >> 63 else x for x in flips]
    posted = crowded.select(
        "node", F.explode(F.transform(F.lit(signed).cast("array<bigint>"), lambda x: x.bitwiseXOR(F.col("fp")))).alias("mid")
    )
    met = posted.groupBy("mid").agg(F.collect_set("node").alias("nodes")).where(F.size("nodes") > 1)
    over = met.select(F.array_min("nodes").alias("a"), F.explode("nodes").alias("b")).where(F.col("a") != F.col("b"))
    return pairs.unionByName(over).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """(doc_id, fp, component_id) for every row of `docs` (doc_id, text).

    component_id is the smallest doc_id reachable over fingerprints that differ in
    `distance` bits or fewer. Null and empty texts have fingerprint 0, which links
    like any other. Repeated rows come back repeated. A null doc_id is never the
    smallest unless its whole component has none; then component_id is null. Other
    columns are ignored; an empty table gives no rows."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    roots = components(near_links(nodes.where("node is not null"), distance))
    named = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return join_spread(marked, named, ["fp"], "left").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """The rows of `docs`, columns unchanged, that lead their component: those with its
    smallest doc_id, and one of several equal ids. Rows without doc_id stay."""
    found = stored(near_duplicates(docs, words, distance), "components")
    lost = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    again = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    gone = lost.unionByName(again).distinct().select(F.col("doc_id").alias("__gone"))
    more = again.select(F.col("doc_id").alias("__gone"))
    alone = docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
    one = docs.join(more, docs["doc_id"] == more["__gone"], "left_semi").dropDuplicates(["doc_id"])
    return alone.unionByName(one)
