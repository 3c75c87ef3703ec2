"""Who first holds a repeated stretch: the engine of the suffix and the substring dedup.

Documents are dealt into blocks by a hash of their id and text; a block is what one
Python call holds. A block turns its texts into units (bytes or words, 64-bit values) and
window hashes come from prefix sums, so a pass costs a few operations a unit.

Filter passes find windows that occur more than once: each block sends its distinct
window hashes, sorted and packed, one piece per hash range ("bucket"); a bucket is
sorted by itself and answers with one bit per hash. The first filter looks at sampled
windows, each later one at the longer windows that the one before lets through. Only
windows that pass all filters enter the last pass, in which a bucket finds the smallest
doc_id of every window and answers with one bit: a smaller one holds it elsewhere. When
a pass has nothing left to ask, the later ones are left out. A window that is very
frequent reaches its bucket once per block, never once per occurrence.

A row whose whole text stands in a row with a smaller doc_id holds nothing first and
loses every window it has, so it takes no part in the passes."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored, text_of

LAST_ID = np.iinfo(np.int64).max  # stands for a missing doc_id
TEXT_SEED = 42  # of xxhash64 in SQL
KEYS_PER_BUCKET = 4_000_000
BYTES_PER_BLOCK = 2_000_000
KEY_BITS, KEY_BYTES = 40, 5

_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_TABLE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse; kept and grown on demand."""
    held = _powers.get(base)
    if held is None or len(held[0]) < n:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(max(n, 1 << 16), b, np.uint64)
            x[0] = 1
            both.append(np.cumprod(x, dtype=np.uint64))
        held = _powers[base] = (both[0], both[1])
    return held


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A value for each byte, and the documents' bounds."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)
    return _TABLE[np.frombuffer(b"".join(texts), np.uint8)], bounds


_SPACES = np.zeros(256, bool)
_SPACES[[32, *range(9, 14)]] = True


def word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each white-space separated word, and the documents' bounds."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    solid = ~_SPACES[data]
    edge = np.diff(solid.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    values = _hashes(_prefix(_TABLE[data], 0), starts, ends - starts, 0)
    values = _mix(values + (ends - starts).astype(np.uint64) * np.uint64(_BASES[1]))
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    return values, np.searchsorted(starts, offsets).astype(np.int64)


def _prefix(units: np.ndarray, which: int) -> np.ndarray:
    sums = np.empty(len(units) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(units * _power(_BASES[which], len(units))[0][: len(units)], out=sums[1:], dtype=np.uint64)
    return sums


def _hashes(prefix: np.ndarray, at: np.ndarray, length: int | np.ndarray, which: int) -> np.ndarray:
    """64-bit hashes of the windows that start at `at`."""
    value = prefix[at + length]
    value -= prefix[at]
    value *= _power(_BASES[which], len(prefix))[1][at]
    return _mix(value)


@dataclass(frozen=True)
class Step:
    """Longer windows: `candidates` gives the starts at which windows of `length` units
    may repeat, from a flag per unit that tells which shorter windows do."""

    length: int
    candidates: Callable[[np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Scheme:
    """How windows are filtered. `sample` gives the starts at which windows of
    `filter_length` units are looked at; `steps` lead from there to the full windows, the
    last step's. Full windows are sorted in `ranges` ranges of their hash, one after the
    other, so that only one range lies on disk at a time."""

    filter_length: int
    units: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]
    sample: Callable[[np.ndarray], np.ndarray]
    steps: tuple[Step, ...]
    unit_bytes: float = 1.0
    rate: float = 1.0
    ranges: int = 1

    @property
    def length(self) -> int:
        return self.steps[-1].length


class Block:
    """One block's documents in order of doc_id, and what its passes have worked out."""

    def __init__(self, table: pa.Table, scheme: Scheme, answers: pa.Table) -> None:
        column = table.column("doc_id").combine_chunks()
        ids = column.fill_null(LAST_ID).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        texts = table.column("text").cast(pa.binary()).to_pylist()
        self.scheme, self.ids = scheme, ids[order]
        self.texts = [texts[i] for i in order]
        self.missing = column.is_null().to_numpy(zero_copy_only=False)[order]
        rows = zip(answers.column("kind").to_pylist(), answers.column("bits").to_pylist())
        late = [np.frombuffer(bits, "<i8") for kind, bits in rows if kind == COPIES]
        self.copies = self._copies(np.concatenate(late)) if late else np.zeros(len(ids), bool)
        self.units, self.bounds = scheme.units([b"" if c else t for t, c in zip(self.texts, self.copies.tolist())])
        self.prefix = _prefix(self.units, 0)
        self.owner = np.repeat(np.arange(len(self.texts), dtype=np.int32), np.diff(self.bounds))

    def _copies(self, late: np.ndarray) -> np.ndarray:
        """Rows that repeat an earlier text: `late` has their ids and text hashes by turns."""
        known = set(zip(late[::2].tolist(), late[1::2].tolist()))
        hashes = np.array([xxhash.xxh64_intdigest(t, TEXT_SEED) for t in self.texts], np.uint64).view(np.int64)
        return np.array([pair in known for pair in zip(self.ids.tolist(), hashes.tolist())])

    def sampled(self) -> Asked:
        """What the first filter asks about."""
        return Asked(self, self.scheme.sample(self.bounds), self.scheme.filter_length)

    def next(self, asked: Asked, bits: np.ndarray, step: Step) -> np.ndarray:
        """Starts of a step's windows, given the answers for what was asked before."""
        flags = np.zeros(len(self.units) + 1, bool)
        flags[asked.starts[asked.repeated(bits)]] = True
        found = step.candidates(flags, self.bounds)
        return found[found + step.length <= self.bounds[1:][self.owner[found]]]

    def windows(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct full windows: hash, second hash, smallest doc_id here; and for
        every start the place of its window among them."""
        hashes = _hashes(_prefix(self.units, 1), starts, self.scheme.length, 1)
        order = np.argsort(hashes)
        ranked = hashes[order]
        new = _changes(ranked)
        place = np.empty(len(starts), np.int64)
        place[order] = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        ids = self.ids[self.owner[starts[order]]]
        least = np.minimum.reduceat(ids, firsts) if len(firsts) else ids
        tags = _hashes(self.prefix, starts[order[firsts]], self.scheme.length, 0).astype("<u2")
        return ranked[firsts], tags, least, place

    def covered(self, starts: np.ndarray) -> np.ndarray:
        """A flag for every unit that a window from one of the distinct `starts` covers."""
        marks = np.zeros(len(self.units) + 1, np.int32)
        marks[starts] += 1
        marks[starts + self.scheme.length] -= 1
        return np.cumsum(marks)[: len(self.units)] > 0


class Asked:
    """The windows of one length that a block asks about, and their distinct hashes."""

    def __init__(self, block: Block, starts: np.ndarray, length: int) -> None:
        self.block, self.starts = block, starts
        self.hashes = _hashes(block.prefix, starts, length, 0)
        self.keys, self.again = _distinct(self.hashes)

    def repeated(self, bits: np.ndarray) -> np.ndarray:
        """Places of the windows that another document holds too: other blocks by `bits`,
        an answer for each key, this one by its own holders."""
        hit = _among(self.hashes, self.keys[bits])
        here = np.flatnonzero(_among(self.hashes, self.keys[self.again & ~bits]))
        order = here[np.argsort(self.hashes[here], kind="stable")]  # so documents ascend within a hash
        edges = np.append(np.flatnonzero(_changes(self.hashes[order])), len(order))
        holders = self.block.owner[self.starts[order]]
        several = holders[edges[:-1]] != holders[edges[1:] - 1]
        hit[order[np.repeat(several, np.diff(edges))]] = True
        return np.flatnonzero(hit)


def _changes(ranked: np.ndarray) -> np.ndarray:
    """Whether each value differs from the one before it."""
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    return new


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and whether each occurs more than once."""
    if not len(hashes):
        return hashes, np.zeros(0, bool)
    ranked = np.sort(hashes)
    new = np.flatnonzero(_changes(ranked))
    return ranked[new], np.diff(np.append(new, len(ranked))) > 1


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted `wanted`; a bit table answers most."""
    if not len(wanted) or not len(values):
        return np.zeros(len(values), bool)
    bits = min(24, max(10, int(len(wanted) * 16).bit_length()))
    shift = np.uint64(64 - bits)
    table = np.zeros(1 << bits, bool)
    table[(wanted >> shift).astype(np.int64)] = True
    maybe = np.flatnonzero(table[(values >> shift).astype(np.int64)])
    some = values[maybe]
    at = np.minimum(np.searchsorted(wanted, some), len(wanted) - 1)
    hit = np.zeros(len(values), bool)
    hit[maybe] = wanted[at] == some
    return hit


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes: buckets are equal hash ranges."""
    edges = [min((i << 64) // buckets, 2**64 - 1) for i in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]])


def _planes(values: np.ndarray) -> bytes:
    """Byte planes, so that equal high bytes lie together and compress."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _joined_bits(answers: pa.Table, kind: int, cuts: np.ndarray) -> np.ndarray:
    """The answers of all buckets, in order, as flags."""
    flags = np.zeros(int(cuts[-1]), bool)
    rows = zip(*(answers.column(c).to_pylist() for c in ("kind", "bucket", "bits")))
    for which, bucket, bits in rows:
        if which == kind:
            lo, hi = int(cuts[bucket]), int(cuts[bucket + 1])
            flags[lo:hi] = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
    return flags


OWNER, COPIES, FILTER = range(3)  # filters are FILTER, FILTER + 1, ... by level
_SENT = "kind int, bucket int, block long, keys binary, tags binary, ids binary"
_ANSWER = "kind int, bucket int, block long, bits binary"
_SENT_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("tags", pa.binary()), ("ids", pa.binary())])
_ANSWER_ARROW = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), ("bits", pa.binary())])


def _filter_bucket(sent: pa.Table) -> pa.Table:
    """Sort one bucket of the sample; a bit tells which keys other pieces hold too."""
    pieces = []
    for data in sent.column("keys").to_pylist():
        low = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
        low[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
        pieces.append(low.view("<u8").reshape(-1))
    ranked = np.sort(np.concatenate(pieces))
    tied = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    del ranked
    spread = tied << np.uint64(64 - KEY_BITS)
    bits = [np.packbits(_among(p << np.uint64(64 - KEY_BITS), spread)).tobytes() for p in pieces]
    return pa.table([sent.column("kind"), sent.column("bucket"), sent.column("block"), pa.array(bits, pa.binary())], schema=_ANSWER_ARROW)


def _owner_bucket(sent: pa.Table) -> pa.Table:
    """Sort one bucket of full windows; a bit tells which have a smaller holder elsewhere."""
    keys = [np.frombuffer(x, "<u8") for x in sent.column("keys").to_pylist()]
    sizes = [len(k) for k in keys]
    flat = np.concatenate(keys)
    tags = np.concatenate([np.frombuffer(x, "<u2") for x in sent.column("tags").to_pylist()])
    ids = np.concatenate([_from_planes(x, "<i8") for x in sent.column("ids").to_pylist()])
    order = np.lexsort((tags, flat)) if _tags_differ(flat, tags) else np.argsort(flat)
    ranked, marks = flat[order], tags[order]
    new = _changes(ranked) | _changes(marks)
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    late = np.empty(len(flat), bool)
    late[order] = ids[order] > least[np.cumsum(new) - 1]
    bits, at = [], 0
    for n in sizes:
        bits.append(np.packbits(late[at : at + n]).tobytes())
        at += n
    return pa.table([sent.column("kind"), sent.column("bucket"), sent.column("block"), pa.array(bits, pa.binary())], schema=_ANSWER_ARROW)


def _tags_differ(keys: np.ndarray, tags: np.ndarray) -> bool:
    order = np.argsort(keys)
    ranked, marks = keys[order], tags[order]
    return bool(((ranked[1:] == ranked[:-1]) & (marks[1:] != marks[:-1])).any())


def dedup(docs: DataFrame, scheme: Scheme, report: Callable[[Block, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """What `report` makes of each block and its removed units.

    A unit is removed if a window of `scheme.length` units covers it that also starts
    in a row with a smaller doc_id. Rows with equal doc_ids take nothing from each
    other; a missing doc_id counts as larger than any other."""
    rows = docs.select(
        "doc_id", text_of().alias("text"),
        F.xxhash64("doc_id", text_of()).alias("hash"),
    )
    total = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BYTES_PER_BLOCK))
    units = total / scheme.unit_bytes
    buckets = tuple(max(1, math.ceil(n / KEYS_PER_BUCKET)) for n in (units * scheme.rate, units))
    blocked = F.pmod("hash", F.lit(blocks)).alias("block")
    dealt = rows.select("doc_id", "text", blocked)

    def pieces(
        kind: int, block: int, cuts: np.ndarray, cut_out: Callable[[int, int], dict], part: int = 0, parts: int = 1
    ) -> pa.Table:
        ranges = [(i, int(cuts[i]), int(cuts[i + 1])) for i in _share(len(cuts) - 1, part, parts) if cuts[i + 1] > cuts[i]]
        return pa.Table.from_pylist(
            [{"kind": kind, "bucket": i, "block": block} | cut_out(lo, hi) for i, lo, hi in ranges], _SENT_ARROW
        )

    def ask_filter(key: tuple, table: pa.Table, answers: pa.Table, level: int) -> pa.Table:
        if not table.num_rows:
            return _SENT_ARROW.empty_table()
        keys = reached(Block(table, scheme, answers), answers, level).keys
        low = keys.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        return pieces(FILTER + level, key[0].as_py(), _cuts(keys, buckets[0]), lambda lo, hi: {"keys": low[lo:hi].tobytes()})

    def reached(block: Block, answers: pa.Table, level: int) -> Asked:
        """What the filter of a level asks about, after the answers to those before it."""
        asked = block.sampled()
        for done, step in enumerate(scheme.steps[:level]):
            asked = Asked(block, block.next(asked, told(asked, answers, done), step), step.length)
        return asked

    def told(asked: Asked, answers: pa.Table, level: int) -> np.ndarray:
        return _joined_bits(answers, FILTER + level, _cuts(asked.keys, buckets[0]))

    def suspected(block: Block, answers: pa.Table) -> np.ndarray:
        last = len(scheme.steps) - 1
        asked = reached(block, answers, last)
        return block.next(asked, told(asked, answers, last), scheme.steps[last])

    def ask_owner(key: tuple, table: pa.Table, answers: pa.Table, part: int) -> pa.Table:
        if not table.num_rows:
            return _SENT_ARROW.empty_table()
        block = Block(table, scheme, answers)
        hashes, tags, least, _ = block.windows(suspected(block, answers))
        return pieces(
            OWNER, key[0].as_py(), _cuts(hashes, buckets[1]),
            lambda lo, hi: {"keys": hashes[lo:hi].tobytes(), "tags": tags[lo:hi].tobytes(), "ids": _planes(least[lo:hi])},
            part, scheme.ranges,
        )

    def finish(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow.empty_table()
        block = Block(table, scheme, answers)
        starts = suspected(block, answers)
        hashes, _, least, place = block.windows(starts)
        elsewhere = _joined_bits(answers, OWNER, _cuts(hashes, buckets[1]))
        late = elsewhere[place] | (block.ids[block.owner[starts]] > least[place])
        return report(block, block.covered(starts[late]))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))
    copies = stored(_earlier_texts(rows.select("doc_id", "text", blocked)), "copies")

    def passed(known: DataFrame, ask: Callable, part: int, answer: Callable, name: str) -> DataFrame:
        asked = dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_with_part(ask, part), _SENT)
        return stored(asked.groupBy("bucket").applyInArrow(answer, _ANSWER), name)

    replies, left = copies, True
    for level in range(len(scheme.steps)):
        ties = passed(replies, ask_filter, level, _filter_bucket, f"ties{level}")
        replies, left = replies.unionByName(ties), not ties.isEmpty()
        if not left:
            break
    filtered = replies
    for part in range(scheme.ranges if left else 0):
        replies = replies.unionByName(passed(filtered, ask_owner, part, _owner_bucket, "holders"))
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finish, schema)


def _with_part(ask: Callable, part: int) -> Callable:
    return lambda key, table, answers: ask(key, table, answers, part)


def _share(count: int, part: int, parts: int) -> range:
    """The buckets of one range."""
    return range(count * part // parts, count * (part + 1) // parts)


def _earlier_texts(rows: DataFrame) -> DataFrame:
    """Answers that name, for each block, its rows whose text has a smaller doc_id too:
    ids and text hashes by turns. Texts are told apart by 128 bits of hash."""
    marked = rows.select(
        "block", F.coalesce("doc_id", F.lit(int(LAST_ID))).alias("id"),
        F.xxhash64("text").alias("mark"), F.xxhash64(F.lit(1), F.col("text")).alias("second"),
    )
    firsts = marked.groupBy("mark", "second").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    late = join_spread(marked, firsts.where("first < last"), ["mark", "second"], "inner").where("id > first")
    return late.groupBy("block").applyInArrow(_named, _ANSWER)


def _named(late: pa.Table) -> pa.Table:
    both = np.stack([late.column(c).to_numpy().astype("<i8") for c in ("id", "mark")], axis=1)
    row = {"kind": COPIES, "bucket": 0, "block": late.column("block")[0].as_py(), "bits": both.tobytes()}
    return pa.Table.from_pylist([row], _ANSWER_ARROW)
