"""The operators of this folder over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerops.llm import (
    alignment, ann, bpe, decontamination, embedding_dedup, line_dedup, mixing, resampling, simhash, substring_dedup, suffix_dedup, token_counts, toxicity,
)
from ledgerops.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_documents(spark, sf_dir, "source"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir), words=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(_documents(spark, sf_dir), length=50)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_windows(_documents(spark, sf_dir), words=50)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_documents(spark, sf_dir), min_docs=10, shortest=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, nearest=20)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    coded = bpe.round_trip(_documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf_dir), public_tokenizers.path(PIECES), limit=4096)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir, "lang")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "rejected")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)
    return alignment.align(_documents(spark, sf_dir), *paths, public_tokenizers.PATTERN).documents


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.importance(
        _documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), least=1, most=1, buckets=10_000, seed=2024,
        percent=10, min_words=20,
    )
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    run.__name__: run
    for run in (
        op1_mixing, op2_simhash, op3_suffix_dedup, op4_substring_dedup, op5_line_dedup, op6_nearest_neighbours,
        op7_embedding_dedup, op8_byte_bpe, op9_token_counts, op10_toxicity, op11_token_alignment, op12_importance_resampling,
        op13_decontamination,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_TOKENS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op13_decontamination": rf"""
        WITH docs AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
        items AS (SELECT DISTINCT item_id, w, least(10, len(w)) AS width FROM (SELECT item_id, {_TOKENS} AS w FROM benchmark) WHERE len(w) > 0),
        places AS (SELECT item_id, w, width, unnest(range(1, len(w) - width + 2)) AS place FROM items),
        wanted AS (SELECT DISTINCT item_id, width, array_to_string(w[place:place + width - 1], ' ') AS key FROM places),
        starts AS (SELECT doc_id, w, width, unnest(range(1, len(w) - width + 2)) AS place
                   FROM docs, (SELECT DISTINCT width FROM items) WHERE len(w) >= width),
        found AS (
          SELECT s.doc_id, s.place, s.width, k.item_id FROM starts s
          JOIN wanted k ON k.width = s.width AND k.key = array_to_string(s.w[s.place:s.place + s.width - 1], ' ')),
        hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(place, place + width)) AS pos FROM found) GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
               sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
        FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named i USING (doc_id)""",
    "op12_importance_resampling": rf"""
        WITH crcs AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
            lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS tab),
        words AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
        wanted AS (SELECT unnest({_TOKENS}) AS word FROM benchmark),
        each AS (SELECT doc_id, unnest(w) AS word FROM words),
        spelt AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM each UNION SELECT word FROM wanted)),
        hashed AS (
          SELECT word, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
                 lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
          FROM spelt, crcs),
        s AS (SELECT bucket, count(*) AS n FROM each JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS n FROM wanted JOIN hashed USING (word) GROUP BY bucket),
        sums AS (SELECT (SELECT count(*) FROM each)::DOUBLE AS s, (SELECT count(*) FROM wanted)::DOUBLE AS t),
        gains AS (
          SELECT b.bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (sums.s + 10000)) / ((coalesce(s.n, 0) + 1)::DOUBLE * (sums.t + 10000))))::BIGINT AS gain
          FROM (SELECT DISTINCT bucket FROM hashed) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
        weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM each JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
          SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                 coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
          FROM words d LEFT JOIN weights w USING (doc_id)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
                          count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
        FROM placed""",
    "op5_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
          FROM documents),
        keyed AS (
          SELECT doc_id, line, place,
                 translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM lines),
        frequent AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM keyed LEFT JOIN frequent f USING (key) GROUP BY doc_id""",
    "op4_substring_dedup": rf"""
        WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS place FROM words WHERE len(w) >= 50),
        windows AS (SELECT doc_id, place, sha256(array_to_string(w[place:place + 49], ' ')) AS key FROM starts),
        owners AS (SELECT key, min(doc_id) AS least FROM windows GROUP BY key),
        late AS (SELECT doc_id, place FROM windows JOIN owners USING (key) WHERE doc_id > least),
        gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS pos FROM late),
        each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words WHERE len(w) > 0),
        kept AS (
          SELECT e.doc_id, count(*) AS n_words, count(g.pos) AS n_removed,
                 string_agg(word, ' ' ORDER BY e.pos) FILTER (WHERE g.pos IS NULL) AS text
          FROM each e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id)
        SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(k.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
}
