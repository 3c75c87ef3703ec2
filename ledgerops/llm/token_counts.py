"""Token counts: pieces counted once per distinct pre-token, joined to frequencies."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ledgerops.llm.common import Recent, text_of

MARK = "▁"  # stands for a space in the model's pieces
_PRETOKENS = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
MEMO_BYTES = 24_000_000
LONGEST_KEPT = 64


def frequencies(text: str) -> Counter[str]:
    """How often the text holds each pre-token: a run of spaces with what follows it.

    The model puts a space in front of a text, writes spaces as MARK, and has no piece
    in which MARK follows another character; so no merge crosses a pre-token's ends."""
    return Counter(_PRETOKENS.findall(" " + text) if text else ())


class Pieces:
    """Numbers of pieces by pre-token, from the library."""

    def __init__(self, model: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in pieces):
            raise ValueError("pieces of this model reach over spaces")
        self.space = len(self.model.encode("\n ")) - len(self.model.encode("\n"))  # at a text's end

    def count(self, tokens: list[str]) -> list[int]:
        """The library adds the first space itself and gives nothing for an empty text."""
        sizes = self.model.encode([token[1:] for token in tokens], num_threads=1)
        return [len(found) if len(token) > 1 else self.space for token, found in zip(tokens, sizes)]


_counters: dict[int, tuple[Pieces, Recent]] = {}


def _counter(model: bytes) -> tuple[Pieces, Recent]:
    """One model and memo for each Python worker; the memo is bounded by MEMO_BYTES."""
    name = zlib.crc32(model)
    if name not in _counters:
        _counters[name] = Pieces(model), Recent(MEMO_BYTES)
    return _counters[name]


def count_tokens(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of `docs` (doc_id, text),
    with the SentencePiece BPE model at `path`.

    Every batch of documents makes its pre-token frequencies, asks the library once
    for each distinct pre-token that is not known yet, joins the numbers to the
    frequencies and sums; ids are never kept. Known numbers of short pre-tokens are held
    by each Python worker, up to MEMO_BYTES. There is no shuffle.

    The model is read once on the driver and is bounded by its vocabulary. Null and
    empty texts have no tokens. Repeated rows come back repeated. Other columns are
    ignored; an empty table gives no rows."""
    with open(path, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, known = _counter(shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [frequencies(text) for text in texts]
            numbers = {}
            for token in set().union(*found):
                number = known.get(token)
                numbers[token] = number
            new = [token for token, number in numbers.items() if number is None]
            for token, number in zip(new, pieces.count(new)):
                numbers[token] = number
                if len(token) <= LONGEST_KEPT:
                    known.put(token, number)
            totals = [sum(numbers[token] * times for token, times in one.items()) for one in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(text.encode()) for text in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([total > limit for total in totals], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
