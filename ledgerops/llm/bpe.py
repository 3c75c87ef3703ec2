"""Byte-level BPE: merges drawn from a rank queue with a bitmap hierarchy."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerops.llm.common import Recent, text_of

MEMO_BYTES = 32_000_000
LONGEST_KEPT = 64
LONG = 256  # bytes from which a pre-token is merged by itself
BYTES_AT_ONCE = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Ids of pre-tokens, merged by a rank queue.

    The queue holds positions by merge rank. Two levels of bitmaps tell which ranks
    have any: a bit per 64 ranks, then 64 bits for those; the first set bit, level by
    level, is the smallest rank. A rank's positions are a heap, since equal ranks
    merge from left to right. Short pre-tokens share one queue, so that a rank's
    bucket holds positions of many of them and is worked off as a whole. Results for
    them are kept, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.known = Recent(MEMO_BYTES)
        self.pairs = [ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self.bytes = np.array([ranks[bytes([a])] for a in range(256)], np.int64)
        self.barrier = max(ranks.values()) + 1
        splits = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        table = np.array(splits or np.zeros((0, 3)), np.int64)
        joined = table[:, 0] << 32 | table[:, 1]
        order = np.argsort(joined)
        self.joined, self.ranked = np.append(joined[order], 2**62), np.append(table[order, 2], -1)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token. Parts form a linked list over byte positions; queue
        entries whose pair has changed since are stale and skipped."""
        ranks, get = self.ranks, self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        after, before = [*range(1, n + 1), n], [*range(-1, n)]
        pair: list[int | None] = [None] * n  # rank of the part at a position with the next
        bits: dict[int, int] = {}
        held: dict[int, list[int]] = {}
        top = 0

        pairs, last = self.pairs, piece[0]
        for at in range(n - 1):
            code = piece[at + 1]
            rank = pairs[last << 8 | code]
            last = code
            if rank is not None:
                pair[at] = rank
                if rank in held:
                    held[rank].append(at)  # ascending, so still a heap
                else:
                    held[rank] = [at]
                    high = rank >> 6
                    bits[high] = bits.get(high, 0) | 1 << (rank & 63)
                    top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            low = bits[high]
            rank = high << 6 | (low & -low).bit_length() - 1
            places = held[rank]
            if len(places) > 1:
                at = heappop(places)
            else:
                at = places[0]
                del held[rank]
                low &= low - 1
                bits[high] = low
                if not low:
                    top &= top - 1
            if pair[at] != rank:
                continue
            gone = after[at]
            end = after[gone]
            pair[gone] = pair[at] = None
            after[at] = end
            before[end] = at
            left = before[at]
            for start, stop in ((left, end), (at, after[end])) if end < n else ((left, end),):
                if start >= 0:
                    rank = pair[start] = get(piece[start:stop])
                    if rank is not None:
                        if rank in held:
                            heappush(held[rank], start)
                        else:
                            held[rank] = [start]
                            high = rank >> 6
                            bits[high] = bits.get(high, 0) | 1 << (rank & 63)
                            top |= 1 << high
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : after[at]]])
            at = after[at]
        return ids

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, -1 where they do not join."""
        pairs = left << 32 | right
        at = self.joined.searchsorted(pairs)
        return np.where(self.joined[at] == pairs, self.ranked[at], -1)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of short pre-tokens, through one queue.

        The pieces lie one after the other with a barrier behind each. A step takes the
        bucket of the smallest rank and merges its leftmost valid position in every
        piece; further ones stay in the bucket, since a merge may give a smaller rank."""
        sizes = np.array([len(piece) for piece in pieces])
        data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        n = len(data)
        ends = np.cumsum(sizes + 1) - 1
        token = self.bytes[data]
        token[ends] = self.barrier
        piece = np.repeat(np.arange(len(pieces)), sizes + 1)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)
        alive[ends] = False
        pair = np.append(self.lookup(token[:-1], token[1:]), -1)

        order = np.argsort(pair, kind="stable")
        order = order[pair[order] >= 0]
        firsts = np.flatnonzero(np.diff(pair[order], prepend=-1))
        bits: dict[int, int] = {}
        held: dict[int, list] = {}
        top = 0
        for rank, places in zip(pair[order[firsts]].tolist(), np.split(order, firsts[1:])):
            held[rank] = places.tolist()
            high = rank >> 6
            bits[high] = bits.get(high, 0) | 1 << (rank & 63)
            top |= 1 << high
        while top:
            high = (top & -top).bit_length() - 1
            low = bits[high]
            rank = high << 6 | (low & -low).bit_length() - 1
            places = np.array(held.pop(rank))
            places = places[pair[places] == rank]
            if len(places) > 1:
                places.sort()
                owner = piece[places]
                first = np.ones(len(places), bool)
                first[1:] = owner[1:] != owner[:-1]
                if not first.all():
                    held[rank] = places[~first].tolist()
                    places = places[first]
            if rank not in held:
                low &= low - 1
                bits[high] = low
                if not low:
                    top &= top - 1
            if not len(places):
                continue
            gone = after[places]
            end = after[gone]
            after[places] = end
            before[end] = places
            pair[gone] = -1
            alive[gone] = False
            token[places] = rank
            left = before[places]
            left = left[left >= 0]  # the first piece has nothing before it
            starts = np.concatenate([left, places])
            found = self.lookup(token[starts], token[after[starts]])
            pair[starts] = found
            good = found >= 0
            for new, start in zip(found[good].tolist(), starts[good].tolist()):
                if new in held:
                    held[new].append(start)
                else:
                    held[new] = [start]
                    high = new >> 6
                    bits[high] = bits.get(high, 0) | 1 << (new & 63)
                    top |= 1 << high
        ids = token[alive].astype("<u4")
        counts = np.bincount(piece[alive], minlength=len(pieces))
        stops = (np.cumsum(counts) * 4).tolist()
        packed = ids.tobytes()
        return [packed[start:stop] for start, stop in zip([0, *stops], stops)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        known = {piece: self.known.get(piece) for piece in set().union(*split)}
        short = []
        for piece in [piece for piece, ids in known.items() if ids is None]:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                known[piece] = array("I", [rank]).tobytes()
            elif len(raw) >= LONG:
                known[piece] = array("I", self.merge(raw)).tobytes()
            else:
                short.append(piece)
        if short:
            known.update(zip(short, self.merge_many([piece.encode() for piece in short])))
        for piece in short:
            if len(piece) <= LONGEST_KEPT:
                self.known.put(piece, known[piece])
        return [b"".join(map(known.__getitem__, pieces)) for pieces in split]


class Decoder:
    """Bytes of ids, from one list of token bytes by id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


_coders: dict[tuple[str, str], tuple[Encoder, Decoder]] = {}


def _coder(path: str, pattern: str, ranks) -> tuple[Encoder, Decoder]:
    """One pair of tables for each Python worker; a memo in it is bounded by MEMO_BYTES."""
    found = _coders.get((path, pattern))
    if found is None:
        found = _coders[path, pattern] = Encoder(ranks.value, pattern), Decoder(ranks.value)
    return found


def _grouped(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of about `at_once` bytes; a longer text comes with what was before it."""
    ids: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= at_once:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) for every row of `docs` (doc_id, text): the text's token ids as
    little-endian unsigned 32-bit integers, each match of `pattern` by itself, no
    special tokens.

    The rank file is read once on the driver; its size is bounded by the vocabulary.
    Null and empty texts have no ids. Repeated rows come back repeated. Other columns
    are ignored; an empty table gives no rows."""
    return _coded(docs, path, pattern, False)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encode` plus `decoded`, the bytes of the ids, both in one pass of one worker."""
    return _coded(docs, path, pattern, True)


def _coded(docs: DataFrame, path: str, pattern: str, back: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))
    names = ["doc_id", "ids", "decoded"] if back else ["doc_id", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _coder(path, pattern, shared)
        for doc_ids, texts in _grouped(batches, BYTES_AT_ONCE):
            ids = encoder.encode(texts)
            columns = [pa.array(doc_ids, pa.int64()), pa.array(ids, pa.binary())]
            if back:
                columns.append(pa.array(map(decoder.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, ids binary" + (", decoded binary" if back else "")
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """`encoded` (doc_id, ids) plus `decoded`, the bytes of the ids; null ids give none."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            texts = [decoder.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
