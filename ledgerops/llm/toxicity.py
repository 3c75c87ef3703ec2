"""Toxicity: a convolutional text classifier over hashed words, trained in numpy."""

from __future__ import annotations

import copy
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerops.llm import repeats
from ledgerops.llm.common import stored, text_of

BUCKETS = 1 << 16
SIZE = 8  # numbers of an embedding
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
PREFIXES = (4, 6)  # bytes; a word's beginnings share embeddings with like words
PADS = max(WIDTHS)
LARGEST_SAMPLE = 3000  # labelled rows of each class in a sample
SHARD_ROWS = 16_000  # labelled rows that are learned from one after the other
SHARD_BYTES = 32_000_000  # and bytes of their texts, about
EPOCHS = 6
SLICE = 1_000_000  # bytes of a text that are looked at together
MOST_BYTES = 64_000_000  # of a sample's texts
LIMITS = np.arange(0.2, 0.96, 0.05).round(2).tolist()
FOLDS = 5
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
CALIBRATION_FOLD = 1


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows (word, and its beginnings) for each word, and the texts' bounds.
    Behind each text come PADS rows that point to the zero embedding."""
    data = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    solid = ~repeats._SPACES[data]
    edge = np.diff(solid.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = repeats._prefix(repeats._TABLE[data], 0)
    columns = []
    for number, most in enumerate((None, *PREFIXES)):
        sizes = ends - starts if most is None else np.minimum(ends - starts, most)
        marks = repeats._hashes(prefix, starts, sizes, 0) + (sizes + 131 * number).astype(np.uint64) * np.uint64(repeats._BASES[1])
        columns.append((repeats._mix(marks) >> np.uint64(40)).astype(np.int64) % BUCKETS)
    offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)])
    counts = np.diff(np.searchsorted(starts, offsets))
    bounds = np.concatenate([[0], np.cumsum(counts + PADS)])
    rows = np.full((int(bounds[-1]), len(columns)), BUCKETS, np.int32)
    at = np.arange(len(starts)) + np.repeat(np.arange(len(texts)) * PADS, counts)
    for i, column in enumerate(columns):
        rows[at, i] = column
    return rows, bounds


def _long_word(word: bytes) -> np.ndarray:
    """The embedding rows of one word, with no more than a slice of it unpacked."""
    total = 0
    for at in range(0, len(word), SLICE):
        part = _units(word[at : at + SLICE])
        total += int(repeats._prefix(part, 0)[-1]) * pow(repeats._BASES[0], at, 1 << 64)
    rows = features([word[: max(PREFIXES)]])[0][:1]
    mark = repeats._mix(np.array([total % (1 << 64)], np.uint64)) + np.uint64(len(word) * repeats._BASES[1] % (1 << 64))
    rows[0, 0] = int(repeats._mix(mark)[0] >> np.uint64(40)) % BUCKETS
    return rows


def _units(part: bytes) -> np.ndarray:
    return repeats._TABLE[np.frombuffer(part.lower(), np.uint8)]


def row_parts(text: bytes) -> Iterator[np.ndarray]:
    """The embedding rows of a text's words, slice by slice; a slice ends at a space, and
    a word longer than a slice comes by itself."""
    at = 0
    while at < len(text):
        part = text[at : at + SLICE]
        if at + SLICE < len(text):
            spaces = np.flatnonzero(repeats._SPACES[np.frombuffer(part, np.uint8)])
            if len(spaces):
                part = part[: int(spaces[-1]) + 1]
            else:
                end = _SPACE.search(text, at + SLICE)
                stop = end.start() if end else len(text)
                yield _long_word(text[at:stop])
                at = stop
                continue
        yield features([part])[0][:-PADS]
        at += len(part)


@dataclass
class Classifier:
    """Embeddings, filters by width, and a logistic layer over each filter's maximum."""

    words: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    limits: dict[str, float] = field(default_factory=dict)
    learned: bool = False

    @classmethod
    def new(cls, seed: int) -> Classifier:
        draw = np.random.default_rng(seed)
        words = draw.normal(0, 0.1, (BUCKETS + 1, SIZE)).astype(np.float32)
        words[BUCKETS] = 0
        filters = [draw.normal(0, 0.5 / np.sqrt(w), (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        return cls(words, filters, biases, draw.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)

    def convolve(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        values = self.words[rows[:, 0]]
        for i in range(1, rows.shape[1]):
            values += self.words[rows[:, i]]
        n = len(rows) - PADS + 1
        return values, [sum(values[j : j + n] @ kernel[j] for j in range(len(kernel))) for kernel in self.filters]

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """A number from 0 to 1 for each whole text, also for one without words."""
        pooled = [np.zeros((len(texts), FILTERS), np.float32) for _ in WIDTHS]
        at = 0
        while at < len(texts):
            if len(texts[at]) > SLICE:
                for pool, top in zip(pooled, self._pooled_in_parts(texts[at])):
                    pool[at] = top
                at += 1
                continue
            size, end = 0, at
            while end < len(texts) and size + len(texts[end]) <= SLICE:
                size += len(texts[end])
                end += 1
            rows, bounds = features(texts[at:end])
            _, maps = self.convolve(rows)
            cuts = np.stack([bounds[:-1], bounds[1:] - PADS + 1], axis=1).ravel()
            for pool, one in zip(pooled, maps):
                pool[at:end] = np.maximum.reduceat(one, cuts[:-1])[::2]
            at = end
        hidden = np.maximum(np.concatenate([p + b for p, b in zip(pooled, self.biases)], axis=1), 0)
        return 1 / (1 + np.exp(-(hidden.astype(np.float64) @ self.out + self.bias)))

    def _pooled_in_parts(self, text: bytes) -> list[np.ndarray]:
        """Each filter's maximum over a long text: windows that reach into the next slice
        are looked at with it, as its first PADS - 1 words are carried on."""
        tops = [np.full(FILTERS, -np.inf, np.float32) for _ in WIDTHS]
        rest = np.zeros((0, 1 + len(PREFIXES)), np.int32)
        ends = np.full((PADS, 1 + len(PREFIXES)), BUCKETS, np.int32)
        for part in chain(row_parts(text), (ends,)):
            rows = np.concatenate([rest, part])
            if len(rows) >= PADS:
                for top, one in zip(tops, self.convolve(rows)[1]):
                    np.maximum(top, one.max(axis=0), out=top)
            rest = rows[max(0, len(rows) - PADS + 1) :]
        return tops

    def start(self) -> dict[str, np.ndarray]:
        """Adagrad's sums of squares before the first step."""
        totals: dict[str, np.ndarray] = {"words": np.full(BUCKETS + 1, 1e-3, np.float32)}
        totals |= {f"{k}{i}": np.full_like(x, 1e-3) for k, xs in (("f", self.filters), ("b", self.biases)) for i, x in enumerate(xs)}
        return totals | {"out": np.full_like(self.out, 1e-3), "bias": np.full(1, 1e-3)}

    def numbers(self) -> list[np.ndarray]:
        """All that is learned, in a fixed order."""
        return [self.words, *self.filters, *self.biases, self.out]

    def _look_at(self, text: bytes) -> np.ndarray:
        """The rows of a text to learn from: of one longer than a slice, the windows that
        give each filter's maximum within a slice, slice by slice."""
        if len(text) <= SLICE:
            return features([text])[0]
        end = np.full((PADS, 1 + len(PREFIXES)), BUCKETS, np.int32)
        best: list = [[(-np.inf, end)] * FILTERS for _ in WIDTHS]
        for part in row_parts(text):
            rows = np.concatenate([part, end])
            for tops, one in zip(best, self.convolve(rows)[1]):
                for f, at in enumerate(one.argmax(axis=0)):
                    if one[at, f] > tops[f][0]:
                        tops[f] = (one[at, f], rows[at : at + PADS].copy())
        return np.concatenate([window for tops in best for _, window in tops] + [end])

    def train(
        self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, batch: int = 32, rate: float = 0.08, seed: int = 1,
        share: float | None = None, totals: dict[str, np.ndarray] | None = None,
    ) -> None:
        """Adagrad over small batches; only the windows that give a maximum learn. `share`
        is that of the label 1 among all rows, where these are only a part of them;
        `totals` are sums of squares to go on from, which are changed."""
        draw = np.random.default_rng(seed)
        parts = [self._look_at(t) for t in texts]
        totals = self.start() if totals is None else totals
        share = max(1e-6, labels.mean() if share is None else share)
        weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1e-6, 1 - share))
        for _ in range(epochs):
            order = draw.permutation(len(parts))
            for start in range(0, len(order), batch):
                chosen = order[start : start + batch]
                rows = np.concatenate([parts[i] for i in chosen])
                bounds = np.concatenate([[0], np.cumsum([len(parts[i]) for i in chosen])])
                values, maps = self.convolve(rows)
                tops = [
                    np.stack([lo + m[lo : hi - PADS + 1].argmax(axis=0) for lo, hi in zip(bounds[:-1], bounds[1:])]) for m in maps
                ]
                hidden = np.concatenate([m[t, np.arange(FILTERS)] + b for m, t, b in zip(maps, tops, self.biases)], axis=1)
                active = np.maximum(hidden, 0)
                score = 1 / (1 + np.exp(-np.clip(active @ self.out + self.bias, -30, 30)))
                error = ((score - labels[chosen]) * weight[chosen] / len(chosen)).astype(np.float32)
                back = error[:, None] * self.out * (hidden > 0)
                step = active.T @ error + 1e-5 * self.out
                totals["out"] += step**2
                self.out -= rate * step / np.sqrt(totals["out"])
                totals["bias"] += float(error.sum()) ** 2
                self.bias -= rate * float(error.sum()) / float(totals["bias"][0]) ** 0.5
                touched, moves = [], []
                for i, (kernel, top) in enumerate(zip(self.filters, tops)):
                    part = back[:, i * FILTERS : (i + 1) * FILTERS]
                    slope = np.zeros_like(kernel)
                    for j in range(len(kernel)):
                        near = values[top + j]  # text, filter, number
                        slope[j] = np.einsum("tf,tfs->sf", part, near)
                        touched.append(rows[top + j].reshape(-1, rows.shape[1]))
                        moves.append((part[:, :, None] * kernel[j].T[None]).reshape(-1, SIZE))
                    totals[f"f{i}"] += slope**2
                    kernel -= rate * slope / np.sqrt(totals[f"f{i}"])
                    lean = part.sum(axis=0)
                    totals[f"b{i}"] += lean**2
                    self.biases[i] -= rate * lean / np.sqrt(totals[f"b{i}"])
                where, move = np.concatenate(touched), np.concatenate(moves)
                places, inverse = np.unique(where.ravel(), return_inverse=True)
                slope = np.zeros((len(places), SIZE), np.float32)
                np.add.at(slope, inverse.ravel(), np.repeat(move, where.shape[1], axis=0))
                slope[places == BUCKETS] = 0
                totals["words"][places] += (slope**2).mean(axis=1)
                self.words[places] -= rate * slope / np.sqrt(totals["words"][places])[:, None]

    def calibrate(self, scores: np.ndarray, labels: np.ndarray, langs: list[str | None]) -> None:
        """For each language the limit with the best F1; of equals the nearest to 0.5."""
        names = np.array([lang or "" for lang in langs])
        for lang in sorted(set(names.tolist())):
            own, truth = scores[names == lang], labels[names == lang] > 0
            said = [own >= limit for limit in LIMITS]
            self.set_limit(lang, int(truth.sum()), int((~truth).sum()), [int(s.sum()) for s in said], [int((s & truth).sum()) for s in said])

    def set_limit(self, lang: str, true: int, false: int, said: list[int], right: list[int]) -> None:
        """The limit of a language from how many rows have label 1 and 0, and how many
        score at or over each of LIMITS, all and with label 1."""
        if true < 5 or false < 5:
            return
        best = (-1.0, 0.0, 0.5)
        for limit, n, hits in zip(LIMITS, said, right):
            f1 = 2 * hits / max(1, n + true)
            best = max(best, (round(float(f1), 6), -abs(limit - 0.5), limit))
        self.limits[lang] = best[2]


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _ids(labels: DataFrame) -> DataFrame:
    """Labelled ids outside fold 0, each once: doc_id, toxic, fold."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.select("doc_id", "toxic", fold(F.col("doc_id")).alias("fold")).where("fold != 0")


def _one_row(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The labelled texts (doc_id, toxic, fold, text, lang). An id has one row: of several
    the one with the smallest hash of its text."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.where("text is not null").select("doc_id", F.struct("text", lang.alias("lang")).alias("row"))
    order = F.struct(F.xxhash64("row.text"), F.octet_length("row.text"), F.coalesce("row.lang", F.lit("")))
    one = texts.join(ids, "doc_id").groupBy("doc_id", "toxic", "fold").agg(F.min_by("row", order).alias("row"))
    return one.select("doc_id", "toxic", "fold", "row.text", "row.lang")


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = LARGEST_SAMPLE, most_bytes: int = MOST_BYTES) -> pd.DataFrame:
    """Some labelled texts (doc_id, toxic, fold, text, lang) on the driver, to look at;
    nothing is learned from them alone (`train` takes all). Of each class the first `sample` ids by a hash, none from fold 0, and of those as many
    as have `most_bytes` / 2 bytes together. An id has one row: of several the one with
    the smallest hash of its text."""
    known, ids = _ids(labels), None
    for label in (0, 1):
        some = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        ids = some if ids is None else ids.unionByName(some)
    rows = stored(_one_row(docs, F.broadcast(ids)), "labelled")
    sizes = rows.select("doc_id", "toxic", F.octet_length("text").alias("size"), F.xxhash64("doc_id").alias("place")).toPandas()
    sizes = sizes.sort_values(["place", "doc_id"], kind="stable")
    held = sizes[sizes.groupby("toxic")["size"].cumsum() <= most_bytes // 2]
    wanted = docs.sparkSession.createDataFrame([(int(x),) for x in held["doc_id"]], "doc_id long")
    return rows.join(F.broadcast(wanted), "doc_id").toPandas().sort_values("doc_id", kind="stable")


def train(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Classifier:
    """A classifier from all labelled documents outside fold 0. Labels other than 0 and 1,
    and missing ids and texts are passed over. Without both classes nothing is learned:
    all texts then score alike, under 0.5, and none is rejected.

    The rows are dealt to shards by a hash of the id. In each epoch every shard learns
    from the model of the epoch before, and Spark takes the mean of the shards' models; a
    number of an embedding is the mean over the shards that moved it. The driver holds one
    model. Fold CALIBRATION_FOLD is kept from training; all its rows set the limits of the
    languages."""
    rows = stored(_one_row(docs, _ids(labels)), "labelled")
    model = Classifier.new(seed)
    aside = F.col("fold") == CALIBRATION_FOLD
    size = F.sum(F.octet_length("text")).alias("size")
    known = {r.toxic: r for r in rows.where(~aside).groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"), size).collect()}
    if len(known) < 2:
        model.out[:], model.bias = 0, -1.0
        return model
    total = sum(r.rows for r in known.values())
    shards = max(-(-total // SHARD_ROWS), -(-sum(r.size for r in known.values()) // SHARD_BYTES))
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(shards))
    dealt = rows.where(~aside).select("doc_id", "toxic", "text", place.alias("shard"))
    dealt = stored(dealt.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id"), "shards")
    totals = model.start()
    for epoch in range(EPOCHS):
        model, totals = _epoch(dealt, model, totals, known[1].rows / total, epoch)
    _calibrate(model, rows.where(aside))
    model.learned = True
    return model


CHUNK = 4096  # embedding rows that are averaged together


def _epoch(
    dealt: DataFrame, model: Classifier, totals: dict[str, np.ndarray], share: float, epoch: int
) -> tuple[Classifier, dict[str, np.ndarray]]:
    """The mean of what the shards learn in one pass over their rows, and of their sums of
    squares."""
    shared = dealt.sparkSession.sparkContext.broadcast((model, totals))

    def learn(group: pd.DataFrame) -> dict[int, np.ndarray]:
        one, sums = copy.deepcopy(shared.value)
        base, base_sums = shared.value
        texts = [t.encode() for t in group["text"]]
        one.train(texts, group["toxic"].to_numpy(np.float32), epochs=1, seed=1 + epoch, share=share, totals=sums)
        parts = {}
        for chunk in np.unique(np.flatnonzero(sums["words"] != base_sums["words"]) // CHUNK).tolist():
            own = slice(chunk * CHUNK, (chunk + 1) * CHUNK)
            more = sums["words"][own].astype(np.float64) - base_sums["words"][own]
            steps = one.words[own].astype(np.float64) - base.words[own]
            parts[chunk] = np.concatenate([more != 0, more, steps.ravel()])
        others = [*one.numbers()[1:], np.array([one.bias]), *[sums[k] for k in sums if k != "words"], np.ones(1)]
        parts[-1] = np.concatenate([x.ravel().astype(np.float64) for x in others])
        return parts

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        added: dict[int, np.ndarray] = {}
        for group in _shards(batches):
            for chunk, numbers in learn(group).items():
                added[chunk] = added.get(chunk, 0) + numbers
        if added:
            yield pd.DataFrame({"chunk": list(added), "numbers": [x.tolist() for x in added.values()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        added = np.sum([np.asarray(x) for x in group["numbers"]], axis=0)
        return pd.DataFrame({"chunk": group["chunk"][:1], "numbers": [added.tolist()]})

    layout = "chunk long, numbers array<double>"
    learned = dealt.mapInPandas(run, layout)
    found = learned.groupBy("chunk").applyInPandas(add, layout).collect()
    shared.unpersist()
    new, sums = copy.deepcopy((model, totals))
    for chunk, numbers in found:
        numbers = np.asarray(numbers)
        if chunk >= 0:
            own = slice(chunk * CHUNK, min((chunk + 1) * CHUNK, BUCKETS + 1))
            n = own.stop - own.start
            count = np.maximum(numbers[:n], 1)
            sums["words"][own] += (numbers[n : 2 * n] / count).astype(np.float32)
            new.words[own] += (numbers[2 * n :].reshape(n, SIZE) / count[:, None]).astype(np.float32)
            continue
        numbers, at = numbers[:-1] / numbers[-1], 0
        fields = [*new.numbers()[1:], None, *[sums[k] for k in sums if k != "words"]]
        for field in fields:
            if field is None:
                new.bias, at = float(numbers[at]), at + 1
                continue
            field[...] = numbers[at : at + field.size].reshape(field.shape)
            at += field.size
    return new, sums


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one shard after the other, from a table sorted by shard."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        for shard, part in batch.groupby("shard", sort=True):
            if held and held[0]["shard"].iloc[0] != shard:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def _calibrate(model: Classifier, rows: DataFrame) -> None:
    """The languages' limits from counts over all rows of the fold kept aside."""
    scored = rows.select("toxic", F.coalesce("lang", F.lit("")).alias("lang"), _scorer(rows, model)(text_of()).alias("score"))
    said = [F.count_if(F.col("score") >= limit).alias(f"said_{i}") for i, limit in enumerate(LIMITS)]
    right = [F.count_if((F.col("score") >= limit) & (F.col("toxic") == 1)).alias(f"right_{i}") for i, limit in enumerate(LIMITS)]
    true = F.count_if(F.col("toxic") == 1).alias("true")
    for r in scored.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"), true, *said, *right).orderBy("lang").collect():
        n = range(len(LIMITS))
        model.set_limit(r.lang, r.true, r.rows - r.true, [r[f"said_{i}"] for i in n], [r[f"right_{i}"] for i in n])


def _scorer(docs: DataFrame, model: Classifier) -> Callable[[Column], Column]:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores([t.encode() for t in texts]))

    return run


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """`docs` plus score (0 to 1), predicted (1 from 0.5 on) and rejected (from its
    language's limit on, 0.5 for other languages); columns of these names are replaced.

    A model that learned nothing rejects nothing. A score comes from the whole text alone. Null texts count as empty ones, which get
    the score of a text without words. Equal texts have equal scores; an empty table
    gives no rows."""
    run = _scorer(docs, model)
    limit = F.lit(0.5)
    if model.limits and "lang" in docs.columns:
        pairs = [F.lit(x) for pair in sorted(model.limits.items()) for x in pair]
        limit = F.coalesce(F.element_at(F.create_map(*pairs), F.coalesce("lang", F.lit(""))), limit)
    return (
        docs.drop("score", "predicted", "rejected")
        .withColumn("score", run(text_of()))
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .withColumn("rejected", (F.col("score") >= limit) & F.lit(model.learned))
    )
