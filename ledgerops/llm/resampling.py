"""Importance resampling towards a target: hashed n-grams from running CRCs.

A text is brought to its words with one space between them and scanned once; the running
CRC-32 at every byte is kept. The CRC of any n-gram follows from the two at its ends:
the earlier one, moved on by the n-gram's length, cancels against the later one. Moving
by n zero bytes is linear over GF(2); table lookups do it for powers of two.

The scan itself runs over lanes of one buffer side by side, and the lanes' starts are put
together by the same moves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored
from ledgerops.operators.numbering import number_rows

POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed
LANE_BITS = 10
LANE = 1 << LANE_BITS
BATCH_BYTES = 2_000_000
MOST_BUCKETS = 1 << 24  # bounds what is counted in a task and broadcast
_ONES = np.uint32(0xFFFFFFFF)
_LOW = np.uint32(255)

# A-Z in lower case; ASCII that is neither letter nor digit as a space; the rest as it is
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = table >> np.uint32(1) ^ np.where(table & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return table


_BYTE = _byte_table()


class Moves:
    """Moves of a CRC by zero bytes: for each power of two, four tables of 256."""

    def __init__(self) -> None:
        places = np.arange(256, dtype=np.uint32)[None] << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
        self.tables = [_BYTE[places & _LOW] ^ places >> np.uint32(8)]

    def by_power(self, values: np.ndarray, power: int) -> np.ndarray:
        while len(self.tables) <= power:
            self.tables.append(self._apply(self.tables[-1], self.tables[-1]))
        return self._apply(values, self.tables[power])

    @staticmethod
    def _apply(values: np.ndarray, table: np.ndarray) -> np.ndarray:
        found = table[0][values & _LOW]
        for i in range(1, 4):
            found ^= table[i][values >> np.uint32(8 * i) & _LOW]
        return found

    def by(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each value moved by its own number of bytes."""
        found = values.copy()
        for power in range(int(sizes.max(initial=0)).bit_length()):
            some = np.flatnonzero(sizes >> power & 1)
            found[some] = self.by_power(found[some], power)
        return found


_MOVES = Moves()


class Running:
    """Running CRCs of one buffer, scanned once."""

    def __init__(self, data: np.ndarray) -> None:
        lanes = len(data) // LANE + 1
        steps = np.zeros(lanes * LANE, np.uint8)
        steps[: len(data)] = data
        steps = np.ascontiguousarray(steps.reshape(lanes, LANE).T)
        self.at = np.zeros((LANE + 1, lanes), np.uint32)  # CRC of a lane's first bytes
        state = np.full(lanes, _ONES)
        for i, step in enumerate(steps):
            state = _BYTE[(state ^ step) & _LOW] ^ state >> np.uint32(8)
            np.bitwise_xor(state, _ONES, out=self.at[i + 1])
        starts = np.concatenate([np.zeros(1, np.uint32), self.at[LANE, :-1]])
        reach = 1
        while reach < lanes:  # all lanes before one: doubling the reach each time
            starts[reach:] ^= _MOVES.by_power(starts[:-reach], LANE_BITS + reach.bit_length() - 1)
            reach *= 2
        self.starts = starts

    def _whole(self, places: np.ndarray) -> np.ndarray:
        """CRC of everything before a place."""
        lane, inside = places >> LANE_BITS, places & (LANE - 1)
        return _MOVES.by(self.starts[lane], inside) ^ self.at[inside, lane]

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes from `starts` to before `ends`. Within a lane its own CRCs
        do, since what lies before the lane cancels too."""
        lane, inside = starts >> LANE_BITS, starts & (LANE - 1)
        first, last = self.at[inside, lane], self.at[np.minimum(ends - lane * LANE, LANE), lane]
        wide = np.flatnonzero(ends - lane * LANE > LANE)
        first[wide], last[wide] = self._whole(starts[wide]), self._whole(ends[wide])
        return last ^ _MOVES.by(first, ends - starts)


def words_of(text: str | None) -> bytes:
    """The text's words, A-Z in lower case, with one space between them."""
    return b" ".join((text or "").encode().translate(_PLAIN).split())


def parts_of(words: bytes, most: int, size: int = BATCH_BYTES) -> Iterator[tuple[bytes, int]]:
    """A long text in parts that overlap by `most` - 1 words; with each the number of its
    first words that belong to the part before."""
    at = own = lead = 0
    while len(words) - own > size:
        end = words.find(b" ", own + size)
        if end < 0:
            break
        yield words[at:end], lead
        at, own, lead = end + 1, end + 1, 0
        while lead < most - 1 and at > 1:
            at = words.rfind(b" ", 0, at - 1) + 1
            lead += 1
    yield words[at:], lead


def buckets_of(parts: list[tuple[bytes, int]], least: int, most: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the parts, part by part; how many each part has; and the
    numbers of words. An n-gram belongs to the part that holds its last word as its own."""
    data = np.frombuffer(b" ".join(part for part, _ in parts), np.uint8)
    sizes = np.array([len(part) for part, _ in parts], np.int64)
    solid = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    leads = np.array([lead for _, lead in parts], np.int64)
    place = np.arange(len(starts)) - np.repeat(first[:-1], counts)
    owner = np.repeat(np.arange(len(parts)), counts)
    own = place >= np.repeat(leads, counts)
    running = Running(data)
    found, owners = [], []
    for n in range(least, most + 1):
        last = np.flatnonzero(own & (place >= n - 1))
        found.append(running.between(starts[last - (n - 1)], ends[last]) % np.uint32(buckets))
        owners.append(owner[last])
    crcs, of = np.concatenate(found), np.concatenate(owners)
    if most > least:
        order = np.argsort(of, kind="stable")
        crcs, of = crcs[order], of[order]
    return crcs, np.bincount(of, minlength=len(parts)), counts - leads


_SCANNED = "doc_id long, mark long, n_words long, n_features long, buckets binary, counts array<long>"
_SCANNED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.binary()), ("counts", pa.list_(pa.int64())),
])


def _scan(docs: DataFrame, least: int, most: int, buckets: int) -> DataFrame:
    """A row per document with its features' buckets, and one per task with the counts of
    all buckets."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def table(ids: list, marks: list, parts: list[tuple[bytes, int]], rows: list[int], counts: np.ndarray) -> pa.RecordBatch:
        """`rows` tells the document of each part."""
        found, sizes, words = buckets_of(parts, least, most, buckets)
        counts += np.bincount(found, minlength=buckets)
        cuts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        packed = found.astype(kind)
        of: list[list[bytes]] = [[] for _ in ids]
        n_words, n_features = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for i, row in enumerate(rows):
            of[row].append(packed[cuts[i] : cuts[i + 1]].tobytes())
            n_words[row] += words[i]
            n_features[row] += sizes[i]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(n_words), pa.array(n_features),
            pa.array(map(b"".join, of), pa.binary()), pa.nulls(len(ids), pa.list_(pa.int64())),
        ], schema=_SCANNED_ARROW)

    def long_text(doc_id, mark, words: bytes, counts: np.ndarray) -> pa.RecordBatch:
        """One text part by part, so that only its buckets are held whole."""
        packed, n_words, n_features = [], 0, 0
        for part in parts_of(words, most):
            found, _, number = buckets_of([part], least, most, buckets)
            counts += np.bincount(found, minlength=buckets)
            packed.append(found.astype(kind).tobytes())
            n_words += int(number[0])
            n_features += len(found)
        row = {"doc_id": doc_id, "mark": mark, "n_words": n_words, "n_features": n_features, "buckets": b"".join(packed)}
        return pa.RecordBatch.from_pylist([row], _SCANNED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        ids, marks, parts, size = [], [], [], 0
        for batch in batches:
            for doc_id, mark, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = words_of(text.as_py())
                if len(words) > BATCH_BYTES:
                    yield long_text(doc_id, mark, words, counts)
                    continue
                ids.append(doc_id)
                marks.append(mark)
                parts.append((words, 0))
                size += len(words) + 1
                if size >= BATCH_BYTES:
                    yield table(ids, marks, parts, [*range(len(ids))], counts)
                    ids, marks, parts, size = [], [], [], 0
        if ids:
            yield table(ids, marks, parts, [*range(len(ids))], counts)
        yield pa.RecordBatch.from_pylist([{"counts": counts}], _SCANNED_ARROW)

    return docs.mapInArrow(run, _SCANNED)


def bucket_counts(scanned: DataFrame) -> DataFrame:
    """(bucket, n): tasks' counts added up."""
    each = scanned.where("counts is not null").select(F.posexplode("counts").alias("bucket", "n"))
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain): floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))), in doubles, for
    the counts s of the corpus and t of the target and their sums S and T."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(corpus.select("bucket", F.col("n").alias("s")), "bucket", "left")
    both = both.join(target.select("bucket", F.col("n").alias("t")), "bucket", "left")
    counts = stored(both.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("s", "t")]), "counts")
    all_s, all_t = counts.agg(F.sum("s"), F.sum("t")).first()
    ratio = ((F.col("t") + 1) * F.lit(all_s + buckets)) / ((F.col("s") + 1) * F.lit(all_t + buckets))
    return counts.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 8 hex digits of sha256(`seed:doc_id`)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def importance(
    docs: DataFrame, target: DataFrame, least: int = 1, most: int = 2, buckets: int = 10_000, seed: int = 2024,
    percent: int = 10, min_words: int = 20,
) -> DataFrame:
    """(doc_id, mark, n_words, n_features, weight, score, rank) for every row of `docs`
    (doc_id, text): how much its runs of `least` to `most` words are like `target` (text).

    A run's bucket is its CRC-32 modulo `buckets`; a document's weight is the sum of its
    runs' gains; its score adds Gumbel noise from `seed` and doc_id. Of the N rows with at
    least `min_words` words the floor(percent * N / 100) with the highest scores are drawn
    and ranked from 1, ties to smaller doc_ids, a null one last; all others have a null
    rank. `mark` is a hash of the row.

    Null and empty texts have no words, no features and weight 0; a null doc_id counts as
    an empty one in the noise. Repeated rows count as often as they come and are ranked
    apart. Other columns are hashed but not looked at; an empty table gives no rows, an
    empty target counts as one without words.

    Every text is scanned once; its buckets, two bytes a feature, are written to the shared
    folder. Counts and gains are one row per bucket, at most MOST_BUCKETS."""
    if not 1 <= least <= most or not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError("need 1 <= least <= most and 1 <= buckets <= MOST_BUCKETS")
    marked = docs.select("doc_id", mark(docs).alias("mark"), F.col("text").cast("string").alias("text"))
    scanned = stored(_scan(marked, least, most, buckets), "scanned")
    wanted = target.select(F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("mark"), F.col("text").cast("string").alias("text"))
    aims = bucket_counts(_scan(wanted, least, most, buckets))
    gain = np.zeros(buckets, np.int64)
    for row in gains(bucket_counts(scanned), aims, buckets).collect():
        gain[row.bucket] = row.gain
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(shared.value[np.frombuffer(x, kind)].sum()) for x in batch.column(4).to_pylist()]
            columns = [*(batch.column(i) for i in range(4)), pa.array(weights, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n_words", "n_features", "weight"])

    rows = scanned.where("counts is null").select("doc_id", "mark", "n_words", "n_features", "buckets")
    weighed = rows.mapInArrow(weigh, "doc_id long, mark long, n_words long, n_features long, weight long")
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    able = scored.where(F.col("n_words") >= min_words)
    drawn = able.agg(F.count(F.lit(1)).alias("n")).first()["n"] * percent // 100
    order = able.withColumn("_down", -F.col("score")).withColumn("_none", F.col("doc_id").isNull())
    ranked = number_rows(order, ["_down", "_none", "doc_id", "mark"], "ranked")
    rank = F.when(F.col("row_num") <= drawn, F.col("row_num")).cast("long")
    unable = scored.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*scored.columns, rank.alias("rank")).unionByName(unable)


def mark(docs: DataFrame) -> Column:
    return F.xxhash64(*docs.columns)


def resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of `docs` with all their columns, weight, score and rank (columns of
    these names are replaced); `how` as for `importance`."""
    docs = docs.drop("weight", "score", "rank")
    drawn = importance(docs, target, **how).where("rank is not null").select("mark", "weight", "score", "rank")
    own = docs.select(mark(docs).alias("mark"), F.struct(*docs.columns).alias("row"))
    once = own.join(drawn.select("mark").distinct(), "mark", "left_semi").groupBy("mark").agg(F.first("row").alias("row"))
    return join_spread(drawn, once, ["mark"], "inner").select("row.*", "weight", "score", "rank")
