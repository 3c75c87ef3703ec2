import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _lines string"


@pytest.fixture(scope="session")
def hard_texts():
    """Nulls, empties, ties, a long text, a hot line, overlapping copies, odd bytes."""
    draw = random.Random(3)
    words = [draw.choice("abcdefgh") * draw.randint(1, 3) + draw.choice(["é", "x", "Y", "中"]) for _ in range(4000)]
    base = " ".join(words[:120])
    texts = [
        None, "", " \t\n", "one", "one two", "one two three", "ONE two  three", "\n\n", "Hot line\n" + base,
        base, base, base + " tail", "head " + base, base[:200] + " " + base[100:], "a" * 400, "a" * 180, "ab" * 120,
        " ".join(words), " ".join(words[1000:1100]) + "\nHOT LINE ", "x " * 300, "中" * 90, "é" * 49 + "中" * 60,
    ]
    for i in range(30):
        at = draw.randint(0, 3000)
        part = words[at : at + draw.randint(0, 90)]
        if draw.random() < 0.5 and part:
            part[draw.randrange(len(part))] = "changed"
        texts.append(" ".join(part) + draw.choice(["", "\n hot line", "\nHot Line\t\nhot line", "\n"]))
    return [(i * 7 % 101, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_texts):
    rows = [(d, t, ["en", None, "de"][d % 3], [None, "b", "a", "zz"][d % 4], None, "clash") for d, t in hard_texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Repeated rows, equal ids with other texts, missing ids."""
    rows = [(1, "a b c d\nhot"), (1, "a b c d\nhot"), (None, "a b c d\nhot"), (None, None), (2, None), (2, "z y\nx"), (3, "")]
    rows = [(d, t, None, None if d == 3 else "s", None, "clash") for d, t in rows]
    return spark.createDataFrame(rows + rows[:1] * 12, DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
