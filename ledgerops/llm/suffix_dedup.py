"""Suffix-array dedup: repeated byte strings, by blockwise sorting over a difference cover."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerops.llm import repeats

# A difference cover of 21: every distance between two positions is the difference of
# two of these residues, so any two positions reach sampled ones by one common shift
# of 20 at most.
PERIOD = 21
COVER = (0, 1, 6, 8, 18)
RANGES = 3  # of suffix buckets, sorted one after the other to bound disk


def _cover_sample(length: int):
    """All sampled positions of each document, counted from its beginning, that are
    followed by the `length` - PERIOD + 1 bytes by which the sample is ranked."""
    deep = length - PERIOD + 1
    cover = np.array(COVER)

    def sample(bounds: np.ndarray) -> np.ndarray:
        out = []
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = hi - lo - deep + 1
            if n > 0:
                at = (np.arange(0, n, PERIOD)[:, None] + cover).ravel()
                out.append(lo + at[at < n])
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    return sample


def _near_ties(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Suffixes with a tied sample among their next PERIOD positions."""
    ties = np.concatenate([[0], np.cumsum(flags[:-1], dtype=np.int64)])
    n = len(flags) - 1
    ends = np.minimum(np.arange(n) + PERIOD, n)
    return np.flatnonzero(ties[ends] > ties[:n])


def dedup_substrings(docs: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every row of `docs` (doc_id, text).

    `spans` are the maximal runs [from, to) of bytes covered by a string of `length`
    bytes that also starts in a row with a smaller doc_id; overlapping strings count
    and strings are judged on the input. `kept` holds the other bytes. Texts count as
    UTF-8 bytes, null as empty; matches never cross rows.

    First the cover sample is ranked by `length` - 20 bytes, one bucket at a time. Two
    suffixes that agree on `length` bytes reach, by one shift of at most 20, sampled
    positions that tie there; suffixes without a tied sample in reach are unique and
    are not sorted. The others are sorted bucket by bucket on an image of their first
    `length` bytes, which brings equal ones together. Order is that of 64-bit hashes,
    not of letters: only equality is asked for. 80 bits of hash decide equality.

    Rows with equal doc_id, repeated rows among them, take nothing from each other; a
    missing doc_id counts as larger than all others and comes back null. Other columns
    are ignored. An empty table gives no rows."""
    if length <= PERIOD:
        raise ValueError(f"length must be over {PERIOD}")
    scheme = repeats.Scheme(
        length - PERIOD + 1, repeats.byte_units, _cover_sample(length), (repeats.Step(length, _near_ties),),
        rate=len(COVER) / PERIOD, ranges=RANGES,
    )
    schema = "doc_id long, n_bytes long, spans array<struct<from:long,to:long>>, kept binary"
    return repeats.dedup(docs, scheme, _report, schema)


def _report(block: repeats.Block, gone: np.ndarray) -> pa.Table:
    touched = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
    some = touched[block.bounds[1:]] > touched[block.bounds[:-1]]
    ranges = zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), some.tolist())
    spans, kept = [], []
    for (lo, hi, cut), copy, text in zip(ranges, block.copies.tolist(), block.texts):
        edges = [0, len(text)] if copy and len(text) >= block.scheme.length else []
        if cut:
            edges = np.flatnonzero(np.diff(gone[lo:hi].astype(np.int8), prepend=0, append=0)).tolist()
        spans.append([{"from": s, "to": e} for s, e in zip(edges[::2], edges[1::2])])
        ends = [0, *edges, len(text)]
        kept.append(b"".join(text[s:e] for s, e in zip(ends[::2], ends[1::2])) if edges else text)
    ids = pa.array(block.ids, pa.int64(), mask=block.missing)
    span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    sizes = pa.array([len(text) for text in block.texts], pa.int64())
    return pa.table([ids, sizes, pa.array(spans, span), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])
