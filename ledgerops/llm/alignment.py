"""Cross-tokenizer alignment: two token sequences of a text, merged in lockstep.

Texts are cut into lanes at spaces between letters, where both tokenizers end a token
whatever stands around. One state vector holds a pair of pointers for every lane of a
batch; each step emits the link that the pointers show, marks a cut where both tokens end
together, moves the pointer of whichever ends first, and drops lanes that are done.

Links are counted corpus-wide without a row per link: tasks write blocks of documents in
which a link is a place in the block's sorted dictionary of id pairs. Only the
dictionaries go through the shuffles of the count."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerops.llm.common import stored

LANE_CHARS = 2_000
BATCH_CHARS = 1_000_000
BLOCK_CHARS = 8_000_000
_SAFE = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")
SPACE_MARK = "▁"
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: printable Latin-1 as
    itself, the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return found | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _reached(token: bytes, rules: dict[tuple[bytes, bytes], int]) -> bool:
    """Whether the merge rules alone turn the token's bytes into the token."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 1:
        known = [(rules[pair], i) for i, pair in enumerate(zip(parts, parts[1:])) if pair in rules]
        if not known:
            return False
        _, at = min(known)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


def read_byte_bpe(path: str) -> dict[bytes, int]:
    """Token bytes to id, from a byte-level BPE file of the tokenizers library.

    Ids then serve as merge ranks. That gives what the file's merge rules give if ids
    ascend with the rules and every token comes out of its own bytes by the rules: two
    neighbours that join to a token, with neither end crossed before, are then a state on
    that token's own way, whose last step is its rule. Anything else is an error."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    of = byte_alphabet()
    ids = {bytes(of[c] for c in token): number for token, number in model["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    pairs = [tuple(bytes(of[c] for c in half) for half in merge) for merge in merges]
    made = [ids[a + b] for a, b in pairs]
    rules = {pair: i for i, pair in enumerate(pairs)}
    if made != sorted(made) or not all(_reached(token, rules) for token in ids):
        raise ValueError(f"ids of {path} cannot serve as merge ranks")
    return ids


@dataclass(frozen=True)
class Recipe:
    """What a worker needs to build both tokenizers; bounded by the vocabularies."""

    ranks: dict[bytes, int]
    pattern: str
    model: bytes
    name: str


class Pair:
    """Both tokenizers, with the bytes of every token.

    A gets a space and the text. B gets the text and adds the space itself. B's pieces
    never hold a space mark behind another character, and A's pattern starts a match at a
    space between two letters, so a text may be cut there."""

    def __init__(self, recipe: Recipe) -> None:
        self.a = tiktoken.Encoding("a", pat_str=recipe.pattern, mergeable_ranks=recipe.ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=recipe.model)
        self.bytes_a = [b""] * (max(recipe.ranks.values()) + 1)
        for token, number in recipe.ranks.items():
            self.bytes_a[number] = token
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in xs], np.int64) for xs in (self.bytes_a, self.bytes_b))
        self.names = [f"{i}{end}" for i in range(len(self.bytes_a)) for end in ",|"]
        self.names += [f"{i}{end}" for i in range(len(self.bytes_b)) for end in ",;"]
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        self.may_cut = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece) for piece in pieces)

    def _piece(self, number: int) -> bytes:
        if self.b.is_byte(number):
            return bytes([int(self.b.id_to_piece(number)[3:-1], 16)])
        if self.b.is_control(number) or self.b.is_unknown(number) or self.b.is_unused(number):
            return b""
        return self.b.id_to_piece(number).replace(SPACE_MARK, " ").encode()

    def lanes(self, text: str) -> Iterator[str]:
        """The text in parts of LANE_CHARS or more, without the spaces it is cut at."""
        at = 0
        while self.may_cut and len(text) - at > LANE_CHARS:
            cut = _SAFE.search(text, at + LANE_CHARS)
            if cut is None:
                break
            yield text[at : cut.start()]
            at = cut.end()
        yield text[at:]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stop_a: np.ndarray):
    """Links (places in `ends_a`, places in `ends_b`) and cut flags for both sides.

    Lane i has the tokens of A from first_a[i] to before stop_a[i], those of B from
    first_b[i] on; ends are byte offsets within a lane, and both sides end together."""
    at_a, at_b = first_a.copy(), first_b.copy()
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    links_a, links_b = [], []
    while len(at_a):
        links_a.append(at_a)
        links_b.append(at_b)
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        move_a, move_b = end_a <= end_b, end_b <= end_a
        both = move_a & move_b
        cut_a[at_a[both]] = True
        cut_b[at_b[both]] = True
        at_a, at_b = at_a + move_a, at_b + move_b
        live = at_a < stop_a
        if not live.all():
            at_a, at_b, stop_a = at_a[live], at_b[live], stop_a[live]
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *links_a]), np.concatenate([empty, *links_b]), cut_a, cut_b


def _bounds(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64))]).astype(np.int64)


def _ends(sizes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte offsets of token ends, from each lane's start."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    return total[1:] - np.repeat(total[bounds[:-1]], np.diff(bounds))


class Document:
    """What is known of one document while its lanes come in."""

    def __init__(self, doc_id: int | None) -> None:
        self.doc_id = doc_id
        self.exact = True
        self.counts = np.zeros(4, np.int64)  # tokens of A, of B, groups, links
        self.digest = None
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, counts, text: str, pairs: np.ndarray, times: np.ndarray) -> None:
        self.counts += counts
        if self.digest is None:
            self.digest = hashlib.sha256(text[:-1].encode())
        else:
            self.digest.update((";" + text[:-1]).encode())
        self.pairs.append(pairs)
        self.times.append(times)

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs, ascending, and how often each is linked."""
        if not self.exact or not self.pairs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.pairs) > 1:
            self._settle()
        return self.pairs[0], self.times[0]

    def _settle(self) -> None:
        pairs, where = np.unique(np.concatenate(self.pairs), return_inverse=True)
        times = np.bincount(where, weights=np.concatenate(self.times), minlength=len(pairs)).astype(np.int64)
        self.pairs, self.times = [pairs], [times]


class Aligner:
    """Aligns documents batch by batch. `shift` is the number of bits of an id of B in a
    pair of ids."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.shift = int(len(pair.bytes_b)).bit_length()

    def run(self, owners: list[Document], texts: list[str]) -> None:
        """Adds to each lane's document; lanes of one document follow one another."""
        pair = self.pair
        ids_a = [pair.a.encode_ordinary(" " + text) for text in texts]
        ids_b = pair.b.encode(texts, num_threads=1)
        for owner, text, a, b in zip(owners, texts, ids_a, ids_b):
            if owner.exact:
                whole = (" " + text).encode()
                owner.exact = b"".join(map(pair.bytes_a.__getitem__, a)) == whole == b"".join(map(pair.bytes_b.__getitem__, b))
        kept = [i for i, owner in enumerate(owners) if owner.exact]
        if not kept:
            return
        owners, ids_a, ids_b = ([xs[i] for i in kept] for xs in (owners, ids_a, ids_b))
        bounds_a, bounds_b = _bounds(map(len, ids_a)), _bounds(map(len, ids_b))
        flat_a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(bounds_a[-1]))
        flat_b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(bounds_b[-1]))
        del ids_a, ids_b
        links_a, links_b, cut_a, cut_b = lockstep(
            _ends(pair.size_a[flat_a], bounds_a), _ends(pair.size_b[flat_b], bounds_b),
            bounds_a[:-1], bounds_b[:-1], bounds_a[1:],
        )

        first = [i for i, owner in enumerate(owners) if i == 0 or owner is not owners[i - 1]]
        edges = np.array([*first, len(owners)])
        doc_a, doc_b = bounds_a[edges], bounds_b[edges]  # token bounds of each document
        groups = np.concatenate([[0], np.cumsum(cut_a)])[doc_a]

        # groups in order, A's tokens before B's: each token moves up by the other side's
        stops_a = np.concatenate([[0], np.flatnonzero(cut_a) + 1])
        stops_b = np.concatenate([[0], np.flatnonzero(cut_b) + 1])
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        named = np.empty(len(flat_a) + len(flat_b), np.int64)
        named[np.arange(len(flat_a)) + stops_b[group_a]] = flat_a * 2 + cut_a
        named[np.arange(len(flat_b)) + stops_a[group_b + 1]] = (flat_b + len(pair.bytes_a)) * 2 + cut_b

        owner_of_link = np.searchsorted(doc_a, links_a, side="right") - 1
        joined = flat_a[links_a] << self.shift | flat_b[links_b]
        bits = int(len(pair.bytes_a)).bit_length() + self.shift
        keys, times = np.unique(owner_of_link << bits | joined, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(first) + 1) << bits)
        links = np.bincount(owner_of_link, minlength=len(first))
        keys &= (1 << bits) - 1
        name = pair.names.__getitem__
        for i, lane in enumerate(first):
            span = slice(int(doc_a[i] + doc_b[i]), int(doc_a[i + 1] + doc_b[i + 1]))
            counts = (doc_a[i + 1] - doc_a[i], doc_b[i + 1] - doc_b[i], groups[i + 1] - groups[i], links[i])
            held = slice(int(cuts[i]), int(cuts[i + 1]))
            owners[lane].add(counts, "".join(map(name, named[span].tolist())), keys[held].copy(), times[held])


_BLOCK = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, places binary, times binary, pairs array<long>, holders array<int>"
_BLOCK_ARROW = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
    ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32())),
])


def _block(number: int, docs: list[Document]) -> pa.RecordBatch:
    """A row for each document, and one with the block's distinct pairs and how many of
    its documents hold each. Places in that dictionary are sent as steps."""
    linked = [doc.linked() for doc in docs]
    bounds = _bounds(len(pairs) for pairs, _ in linked)
    pairs, where = np.unique(np.concatenate([np.zeros(0, np.int64), *(p for p, _ in linked)]), return_inverse=True)
    rows = []
    for i, (doc, (_, times)) in enumerate(zip(docs, linked)):
        counts = doc.counts.tolist() if doc.exact and doc.digest else [0] * 4
        steps = np.diff(where[bounds[i] : bounds[i + 1]], prepend=0)
        rows.append(
            dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts))
            | {"block": number, "doc_id": doc.doc_id, "places": steps.astype("<u4").tobytes(), "times": times.astype("<u4").tobytes()}
            | {"groups_sha256": doc.digest.hexdigest() if doc.exact and doc.digest else ""}
        )
    if len(pairs):
        holders = np.bincount(where, minlength=len(pairs)).astype(np.int32)
        rows.append({"block": number, "pairs": pairs, "holders": holders})
    return pa.RecordBatch.from_pylist(rows, _BLOCK_ARROW)


_pairs: dict[str, Pair] = {}


def _aligner(recipe: Recipe) -> Aligner:
    """One pair of tokenizers for each Python worker."""
    if recipe.name not in _pairs:
        _pairs[recipe.name] = Pair(recipe)
    return Aligner(_pairs[recipe.name])


def _blocks(docs: DataFrame, recipe: Recipe) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(recipe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(shared.value)
        number = TaskContext.get().partitionId() << 32
        held: list[Document] = []
        owners: list[Document] = []
        lanes: list[str] = []
        size = total = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc, text = Document(doc_id), text.as_py()
                held.append(doc)
                for lane in aligner.pair.lanes(text) if text else ():
                    owners.append(doc)
                    lanes.append(lane)
                    size += len(lane)
                    if size >= BATCH_CHARS:
                        aligner.run(owners, lanes)
                        owners, lanes, size = [], [], 0
                        if len(doc.pairs) > 16:
                            doc._settle()
                total += len(text or "")
                if total >= BLOCK_CHARS:
                    aligner.run(owners, lanes)
                    yield _block(number, held)
                    owners, lanes, held, size, total = [], [], [], 0, 0
                    number += 1
        if lanes:
            aligner.run(owners, lanes)
        if held:
            yield _block(number, held)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, _BLOCK)


def _sums(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Per document of a block: links that are their A id's most frequent, and the sum of
    counts over its links. `answers` has count and best by place in the dictionary."""
    place = answers.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    count[place] = answers.column("count").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    sums, bests = [], []
    for steps, times in zip(docs.column("places").to_pylist(), docs.column("times").to_pylist()):
        at, often = np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.int64), np.frombuffer(times, "<u4").astype(np.int64)
        sums.append(int((count[at] * often).sum()))
        bests.append(int(often[best[at]].sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    return pa.table([found[name] if name in found else docs.column(name) for name in names], names)


def pair_counts(blocks: DataFrame, shift: int) -> DataFrame:
    """(pair, a, b, count, best) for every id pair that is linked anywhere: in how many
    documents, and whether no pair of its A id is in more."""
    counts = (
        blocks.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "holders")).alias("x"))
        .groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.holders").cast("long")).alias("count"))
        .withColumn("a", F.shiftright("pair", shift)).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << shift) - 1)))
    )
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


@dataclass(frozen=True)
class Alignment:
    """`documents`: one row per document (see `align`). `links`: (pair, a, b, count, best)
    for every linked pair of ids, counts over all documents."""

    documents: DataFrame
    links: DataFrame


def align(docs: DataFrame, path_a: str, path_b: str, pattern: str) -> Alignment:
    """Aligns the tokens of `docs` (doc_id, text) under a byte-level BPE (a file of the
    tokenizers library, which gets a space and the text) and a SentencePiece model.

    Token bytes: A's entry byte-level decoded; B's piece with its space mark as a space,
    byte pieces as that byte. Offsets at which tokens of both end cut them into groups;
    tokens whose byte ranges overlap are linked. A pair of ids counts once in every
    document that links it. `documents` has doc_id, n_a, n_b, n_groups, n_links, n_best
    (links whose count no other pair of their A id exceeds), count_sum and
    groups_sha256, the digest of `a1,a2|b1;...`.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte,
    have no tokens: zeros and ''. Each row is a document of its own, so repeated rows and
    equal or null ids count separately and come back as often. Other columns are ignored;
    an empty table gives no rows. A very long text is worked on in lanes, some MB at a
    time, as long as it has spaces between letters."""
    with open(path_b, "rb") as file:
        recipe = Recipe(read_byte_bpe(path_a), pattern, file.read(), f"{path_a} {path_b} {pattern}")
    blocks = stored(_blocks(docs, recipe), "aligned")
    pieces = sentencepiece.SentencePieceProcessor(model_proto=recipe.model).get_piece_size()
    shift = int(pieces).bit_length()
    links = stored(pair_counts(blocks, shift), "links")
    asked = blocks.where("pairs is not null").select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(links.select("pair", "count", "best"), "pair").select("of", "place", "count", "best")
    rows = blocks.where("places is not null").drop("pairs", "holders")
    found = rows.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_sums, _RESULT)
    return Alignment(found, links)
