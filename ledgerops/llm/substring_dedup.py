"""Substring dedup over words: repeated windows, found level by level at doubled lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerops.llm import repeats

SHORTEST = 8  # words of the first level at most


def _every_start(length: int):
    def sample(bounds: np.ndarray) -> np.ndarray:
        n = int(bounds[-1])
        fits = np.zeros(n + 1, np.int64)
        lo, hi = bounds[:-1], np.maximum(bounds[:-1], bounds[1:] - length + 1)
        np.add.at(fits, lo, 1)
        np.add.at(fits, hi, -1)
        return np.flatnonzero(np.cumsum(fits[:n]) > 0)

    return sample


def _both_halves(length: int, half: int):
    def candidates(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        n = len(flags) - 1
        shift = length - half
        return np.flatnonzero(flags[: max(0, n - shift)] & flags[shift:n]) if n > shift else np.zeros(0, np.int64)

    return candidates


def levels(words: int) -> list[int]:
    """Window lengths, the shortest first: each is half of the next, rounded up."""
    lengths = [words]
    while len(lengths) < 2 or lengths[0] > SHORTEST:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def dedup_windows(docs: DataFrame, words: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of `docs` (doc_id, text).

    A word is removed if a window of `words` words covers it whose sequence also starts
    in a row with a smaller doc_id; windows are judged on the input. `kept` holds the
    other words, joined by one space. Words are `[^\\x20\\x09-\\x0D]+`, unchanged; null
    and empty texts have none.

    Windows of a short length come first (7 words for 50). Where two that repeat, one at
    the beginning and one at the end, make up a window of twice the length (one word less
    where the length wanted asks for it), that is looked at next: 7, 13, 25, 50. Each level
    asks only about windows that the level before lets through, until the full length is
    reached or none is left; the full windows are compared for their holders.

    Rows with equal doc_id take nothing from each other; a missing doc_id counts as
    larger than all others and comes back null. Other columns are ignored. An empty
    table gives no rows."""
    if words < 2:
        raise ValueError("a window has two words at least")
    lengths = levels(words)
    steps = tuple(repeats.Step(long, _both_halves(long, short)) for short, long in zip(lengths, lengths[1:]))
    scheme = repeats.Scheme(lengths[0], repeats.word_units, _every_start(lengths[0]), steps, unit_bytes=5.0)
    return repeats.dedup(docs, scheme, _report, "doc_id long, n_words long, n_removed long, kept string")


def _report(block: repeats.Block, gone: np.ndarray) -> pa.Table:
    running = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
    cuts = (running[block.bounds[1:]] - running[block.bounds[:-1]]).tolist()
    counts, removed, kept = [], [], []
    for lo, hi, n, copy, text in zip(block.bounds[:-1].tolist(), block.bounds[1:].tolist(), cuts, block.copies.tolist(), block.texts):
        parts = text.split()
        counts.append(len(parts))
        if copy and len(parts) >= block.scheme.length:
            n, parts = len(parts), []
        elif n:
            parts = [parts[i] for i in np.flatnonzero(~gone[lo:hi]).tolist()]
        removed.append(n)
        kept.append(b" ".join(parts).decode())
    ids = pa.array(block.ids, pa.int64(), mask=block.missing)
    return pa.table(
        [ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
        ["doc_id", "n_words", "n_removed", "kept"],
    )
