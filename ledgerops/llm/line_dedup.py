"""Line dedup: two Bloom filters pick suspects, an exact count decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored, text_of

SEGMENT_BITS = 20
LEAST_BITS, MOST_BITS = 20, 28
BITS_PER_LINE = 16


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased."""
    return line.strip().lower()


def _keys(text: bytes, shortest: int) -> dict[bytes, list[int]]:
    """Line numbers by key, for keys of at least `shortest` code points."""
    found: dict[bytes, list[int]] = {}
    for at, line in enumerate(text.split(b"\n")):
        key = line.strip().lower()
        if len(key) >= shortest and (shortest <= 1 or len(key.decode()) >= shortest):
            found.setdefault(key, []).append(at)
    return found


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two filter bits of each hash."""
    mask = np.uint64((1 << bits) - 1)
    return np.stack([hashes & mask, (hashes >> np.uint64(32)) & mask]).astype(np.int64)


def seen_twice(texts: DataFrame, bits: int, shortest: int) -> bytes:
    """Packed bits of the filter of keys seen in two documents or more.

    Every task gathers the distinct hashes of its documents' keys and sends, for
    each segment of the bit range, the places of keys it saw once and twice; one
    group per segment merges them. A key seen in any two documents has both its
    places in the merged filter. Its size is bounded by 2 ** MOST_BITS bits."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                keys = _keys(text, shortest)
                kept.append(np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys)))
                held += len(keys)
            if held > 2_000_000:
                yield from send(kept)
                kept, held = [], 0
        yield from send(kept)

    def send(kept: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not kept:
            return
        hashes, counts = np.unique(np.concatenate(kept), return_counts=True)
        once = np.unique(_places(hashes, bits))
        twice = np.unique(_places(hashes[counts > 1], bits))
        low = (1 << SEGMENT_BITS) - 1
        rows = []
        for segment in np.unique(once >> SEGMENT_BITS).tolist():
            cut = [
                (x[np.searchsorted(x, segment << SEGMENT_BITS) : np.searchsorted(x, (segment + 1) << SEGMENT_BITS)] & low)
                .astype("<u4").tobytes()
                for x in (once, twice)
            ]
            rows.append((segment, *cut))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))],
            ["segment", "once", "twice"],
        ) if rows else pa.RecordBatch.from_pylist([], pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, once, twice = None, None, None
        for batch in batches:
            for number, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if number != segment:
                    if segment is not None:
                        yield done(segment, twice)
                    segment = number
                    once, twice = (np.zeros(1 << SEGMENT_BITS, bool) for _ in range(2))
                places = np.frombuffer(a, "<u4")
                twice[places[once[places]]] = True
                twice[np.frombuffer(b, "<u4")] = True
                once[places] = True
        if segment is not None:
            yield done(segment, twice)

    def done(segment: int, twice: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"segment": segment, "twice": np.packbits(twice).tobytes()}], pa.schema([("segment", pa.int32()), ("twice", pa.binary())]))

    parts = texts.mapInArrow(gather, "segment int, once binary, twice binary")
    merged = (
        parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, twice binary")
    )
    size = (1 << SEGMENT_BITS) // 8
    packed = bytearray(max(1 << bits, 1 << SEGMENT_BITS) // 8)
    for row in merged.toLocalIterator():  # one row per segment of the bounded filter
        packed[row.segment * size : (row.segment + 1) * size] = row.twice
    return bytes(packed)


def filter_bits(lines: int) -> int:
    """BITS_PER_LINE bits a line, within the bounds. Beyond the upper one more lines
    are suspected and counted exactly; results stay the same."""
    return min(MOST_BITS, max(LEAST_BITS, int(lines * BITS_PER_LINE - 1).bit_length()))


def suspects(rows: DataFrame, filter_: bytes, bits: int, shortest: int) -> DataFrame:
    """(doc_id, mark, digest, lines) for every document and key whose places are both
    set; digest is the XXH3-128 of the key."""
    shared = rows.sparkSession.sparkContext.broadcast(filter_)
    schema = "doc_id long, mark long, digest binary, lines array<int>"
    kinds = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("digest", pa.binary()), ("lines", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            out: list[tuple] = []
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, mark, text in zip(ids, marks, batch.column(2).cast(pa.binary()).to_pylist()):
                keys = _keys(text, shortest)
                if not keys:
                    continue
                hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
                places = _places(hashes, bits)
                hit = ((packed[places >> 3] >> (7 - (places & 7))) & 1).all(axis=0)
                out += [
                    (doc, mark, xxhash.xxh3_128_digest(key), lines)
                    for (key, lines), suspect in zip(keys.items(), hit.tolist()) if suspect
                ]
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, kinds)], schema=kinds)

    return rows.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_docs: int = 10, shortest: int = 1, keep_first: bool = False) -> DataFrame:
    """`docs` with `text` freed of lines whose key stands in at least `min_docs` rows,
    plus n_lines (before) and n_dropped, which replace columns of these names. All
    other columns stay as they are.

    Lines end at \\n; a null or empty text is one empty line, and a null text comes
    back empty. Each row counts as one document, also a repeated one or one without
    doc_id; a key counts once a row. With `keep_first` one line of each such key
    stays: the first in the row with the smallest (doc_id, text hash); rows without
    doc_id come last. An empty table gives no rows."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), text_of().alias("text"))
    lines = docs.select(
        F.sum(F.length(text_of()) - F.length(F.replace(text_of(), F.lit("\n"), F.lit(""))) + 1)
    ).first()[0]
    bits = filter_bits(lines or 1)
    found = stored(suspects(rows, seen_twice(rows.select("text"), bits, shortest), bits, shortest), "suspects")
    counted = found.groupBy("digest").agg(
        F.count(F.lit(1)).alias("docs"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first"),
    ).where(F.col("docs") >= min_docs)
    hit = join_spread(found, counted, ["digest"], "inner")
    if keep_first:
        leads = (F.col("first.mark") == F.col("mark")) & F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
        hit = hit.withColumn("lines", F.when(leads, F.slice("lines", 2, F.size("lines"))).otherwise(F.col("lines")))
    drops = hit.groupBy("doc_id", "mark").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("_lines"))
    drops = drops.select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), F.col("_lines").alias("__lines"))
    keyed = docs.drop("n_lines", "n_dropped").withColumn("__own", F.xxhash64("doc_id", "text"))
    same = keyed["doc_id"].eqNullSafe(drops["__doc"]) & (keyed["__own"] == drops["__mark"])
    joined = keyed.join(drops, same, "left").withColumn("__new", _kept(text_of(), F.col("__lines")))
    return joined.select(
        *[F.col("__new.text").alias(c) if c == "text" else keyed[c] for c in keyed.columns if c != "__own"],
        "__new.n_lines",
        "__new.n_dropped",
    )


def _kept(text: Column, lines: Column) -> Column:
    @F.pandas_udf("text string, n_lines long, n_dropped long")
    def run(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        rows = []
        for value, gone in zip(texts, dropped):
            parts = value.split("\n")
            out = set() if gone is None else set(gone)
            kept = value if not out else "\n".join(p for i, p in enumerate(parts) if i not in out)
            rows.append((kept, len(parts), len(out)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return run(text, lines)
