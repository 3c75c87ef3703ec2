"""Benchmark decontamination by a positional inverted index; DataFrame expressions only.

The index holds a posting (term, document, position) for every training word that some
test item has too, sorted by term within each segment of documents. A test window is
looked up from its rarest terms: postings of a term at place k of an item, moved back by
k, name the alignments of that item with a document; alignments at which the two rarest
terms of some window meet are kept and checked against the postings of all its terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerops.functions.columns import join_spread
from ledgerops.llm.common import stored, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HEAD = ""  # the term of the posting that stands for the document itself
PLACES = 1 << 24  # of documents by mark, 64 to a row: at most 2**18 rows tell them
DOC = ["doc_id", "mark"]
ITEM = ["item_id", "item"]


def words_of(column: str = "text") -> Column:
    """A-Z in lower case, then runs of letters, digits and anything beyond ASCII."""
    return F.regexp_extract_all(F.translate(text_of(column), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of columns, nulls being equal."""
    found = F.lit(True)
    for name in columns:
        found = found & left[name].eqNullSafe(right[name])
    return found


@dataclass(frozen=True)
class Index:
    """`postings`: term, doc_id, mark, pos (from 1), n; a document's own posting has term
    HEAD, pos 0 and its number of words in n. `counts`: term, n, over all documents.
    `spots`: item_id, item, size, k (from 1), term: the items' words. `mark` and `item`
    are hashes that tell rows with equal ids apart."""

    postings: DataFrame
    counts: DataFrame
    spots: DataFrame


def build_index(docs: DataFrame, items: DataFrame) -> Index:
    """The index of `docs` (doc_id, text) over the words of `items` (item_id, text).

    Documents stay where they are: a task's postings are a segment of the index. The test
    words are joined to the training words; Spark broadcasts them only if their stored
    table is small enough for that. Repeated rows have equal postings, of which one
    counts in the end."""
    tests = items.select("item_id", words_of().alias("w")).where(F.size("w") > 0)
    tests = tests.select("item_id", F.xxhash64("item_id", "w").alias("item"), "w").distinct()
    spots = tests.select("item_id", "item", F.size("w").alias("size"), F.posexplode("w").alias("k", "term"))
    spots = stored(spots.withColumn("k", F.col("k") + 1), "spots")
    terms = stored(spots.select("term").union(docs.sparkSession.range(1).select(F.lit(HEAD))).distinct(), "terms")
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("mark"), words_of().alias("w"))
    each = rows.select("doc_id", "mark", F.size("w").alias("n"), F.posexplode(F.concat(F.array(F.lit(HEAD)), "w")).alias("pos", "term"))
    each = each.withColumn("n", F.when(F.col("pos") == 0, F.col("n")))
    known = each.join(terms, "term").select("term", *DOC, "pos", "n")
    postings = stored(known.sortWithinPartitions("term"), "postings")
    counts = postings.where(F.col("term") != HEAD).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return Index(postings, stored(counts, "counts"), spots)


def windows_of(index: Index, window: int) -> DataFrame:
    """(item_id, item, width, start, order) for every test window all of whose terms are
    in the index; `order` lists its places in the item, rarest term first."""
    ranked = index.spots.join(index.counts, "term", "left").groupBy(*ITEM, "size").agg(
        F.array_sort(F.collect_list(F.struct("k", F.coalesce("n", F.lit(0)).alias("n")))).alias("all")
    )
    width = F.least(F.lit(window), F.col("size"))
    each = ranked.select(*ITEM, width.alias("width"), "all", F.explode(F.sequence(F.lit(1), F.col("size") - width + 1)).alias("start"))
    order = F.array_sort(F.transform(F.slice("all", F.col("start"), F.col("width")), lambda x: F.struct(x["n"].alias("n"), x["k"].alias("k"))))
    each = each.select(*ITEM, "width", "start", order.alias("order")).where(F.col("order")[0]["n"] > 0)
    return each.withColumn("order", F.transform("order", lambda x: x["k"]))


def _alignments(index: Index, windows: DataFrame) -> DataFrame:
    """(doc_id, mark, item_id, item, size, shift): alignments at which the two rarest terms
    of some window meet. Word k of the item then is to be word k + shift of the document."""
    pairs = windows.select(*ITEM, F.col("order")[0].alias("lead"), F.get("order", F.lit(1)).alias("second")).distinct()
    pairs = pairs.withColumn("second", F.coalesce("second", "lead"))
    leads = pairs.groupBy(*ITEM).agg(F.collect_list(F.struct("lead", "second")).alias("pairs"))
    looked = pairs.select(*ITEM, F.col("lead").alias("k")).union(pairs.select(*ITEM, F.col("second").alias("k"))).distinct()
    spots = index.spots
    seeds = stored(spots.join(looked.withColumnRenamed("item_id", "_id"), ["item", "k"]).where(F.col("item_id").eqNullSafe(F.col("_id"))).drop("_id"), "seeds")
    found = join_spread(index.postings.where(F.col("term") != HEAD).select("term", *DOC, "pos"), seeds, ["term"], "inner")
    found = found.select(*DOC, "item", (F.col("pos") - F.col("k")).alias("shift"), "k")
    met = found.groupBy(*DOC, "item", "shift").agg(F.collect_set("k").alias("ks"))
    both = F.exists("pairs", lambda p: F.array_contains("ks", p["lead"]) & F.array_contains("ks", p["second"]))
    sizes = spots.groupBy(*ITEM).agg(F.first("size").alias("size")).withColumnRenamed("item_id", "_id")
    leads = leads.join(sizes, "item").where(F.col("item_id").eqNullSafe(F.col("_id"))).drop("_id")
    return met.join(leads, "item").where(both).select(*DOC, *ITEM, "size", "shift")


def _near(postings: DataFrame, aligned: DataFrame) -> DataFrame:
    """The postings of documents that have an alignment, and of the few whose marks fall
    on the same places. The places are a table of bounded size, so it is broadcast and
    the rest of the index stays where it lies."""
    place = F.pmod("mark", F.lit(PLACES))
    row, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    marked = aligned.select(row.alias("_row"), bit.alias("_bit")).distinct()
    bits = marked.groupBy("_row").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    near = postings.withColumn("_row", row).join(F.broadcast(bits), "_row")
    return near.where(F.getbit("_bits", bit) == 1).select(*postings.columns)


def phrases(index: Index, window: int = 10) -> DataFrame:
    """Exact matches: (doc_id, mark, item_id, item, item_from, doc_from, n_words), one row
    for each maximal run of words that a document and an item share at one alignment and
    that holds a window: `window` words, or a whole shorter item. Words count from 1."""
    aligned = stored(_alignments(index, windows_of(index, window)), "alignments")
    spots = index.spots.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), "k", "term")
    same = aligned["item_id"].eqNullSafe(spots["_id"]) & (aligned["item"] == spots["_item"])
    wanted = aligned.join(spots, same).select(*DOC, *ITEM, "size", "shift", "k", "term", (F.col("k") + F.col("shift")).alias("pos"))
    wanted = stored(wanted, "wanted")  # its size tells Spark whether the index has to move
    held = _near(index.postings.where(F.col("term") != HEAD).select("term", *DOC, "pos"), aligned)
    match = _same(wanted, held, [*DOC, "term", "pos"])
    hits = held.join(wanted, match).select(*[wanted[c] for c in (*DOC, *ITEM, "size", "shift", "k")]).distinct()
    alignment = [*DOC, *ITEM, "size", "shift"]
    island = F.col("k") - F.row_number().over(Window.partitionBy(*alignment).orderBy("k"))
    runs = hits.withColumn("_island", island).groupBy(*alignment, "_island").agg(F.min("k").alias("item_from"), F.count(F.lit(1)).alias("n_words"))
    return runs.where(F.col("n_words") >= F.least(F.lit(window), F.col("size"))).select(
        *DOC, *ITEM, "item_from", (F.col("item_from") + F.col("shift")).alias("doc_from"), F.col("n_words").cast("int").alias("n_words")
    )


def proximity(index: Index, window: int = 10, reach: int = 20) -> DataFrame:
    """Loose matches: (doc_id, mark, item_id, item, start, doc_from, doc_to), windows whose
    words, each as often as the window has it, stand in any order within `reach` words of
    the document; per window and occurrence of its rarest term the shortest such span,
    the leftmost of equals. Exact matches are among them."""
    windows = windows_of(index, window).withColumn("lead", F.col("order")[0])
    spots = index.spots.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), "k", "term")
    same = windows["item_id"].eqNullSafe(spots["_id"]) & (windows["item"] == spots["_item"])
    inside = F.col("k").between(F.col("start"), F.col("start") + F.col("width") - 1)
    needs = windows.join(spots, same).where(inside).groupBy(*ITEM, "start", "lead", "term").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("k") == F.col("lead")).alias("leads")
    )
    needs = stored(needs, "needs")
    held = index.postings.where(F.col("term") != HEAD).select("term", *DOC, "pos").distinct()
    block = F.floor(F.col("pos") / reach)
    anchors = join_spread(held, needs.where("leads").select(*ITEM, "start", "term"), ["term"], "inner")
    anchors = anchors.select(*DOC, *ITEM, "start", F.col("pos").alias("at"), F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    near = held.select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), "term", "pos", block.alias("_block"))
    close = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m")) & (F.col("block") == F.col("_block"))
    around = anchors.join(near, close & (F.abs(F.col("pos") - F.col("at")) < reach)).select(*DOC, *ITEM, "start", "at", "term", "pos")
    wanted = needs.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), F.col("start").alias("_start"), F.col("term").alias("_term"), "n")
    right = around["item_id"].eqNullSafe(wanted["_id"]) & (around["item"] == wanted["_item"]) & (around["start"] == wanted["_start"]) & (around["term"] == wanted["_term"])
    group = [*DOC, *ITEM, "start", "at"]
    lists = around.join(wanted, right).groupBy(*group, "term", "n").agg(F.array_sort(F.collect_set("pos")).alias("ps")).where(F.size("ps") >= F.col("n"))
    whole = lists.groupBy(*group).agg(F.collect_list(F.struct("n", "ps")).alias("lists"), F.count(F.lit(1)).alias("n_terms"))
    terms = needs.groupBy(*ITEM, "start").agg(F.count(F.lit(1)).alias("n_all"))
    terms = terms.select(F.col("item_id").alias("_id"), F.col("item").alias("_item"), F.col("start").alias("_start"), "n_all")
    right = whole["item_id"].eqNullSafe(terms["_id"]) & (whole["item"] == terms["_item"]) & (whole["start"] == terms["_start"])
    whole = whole.join(terms, right).where(F.col("n_terms") == F.col("n_all"))
    # from each possible first word: where the n-th posting of every term at or after it lies
    firsts = F.array_distinct(F.flatten(F.transform("lists", lambda x: x["ps"])))

    def last(first: Column) -> Column:
        ends = F.transform("lists", lambda x: F.get(F.filter(x["ps"], lambda p: p >= first), x["n"].cast("int") - 1))
        return F.when(F.exists(ends, F.isnull), F.lit(None).cast("int")).otherwise(F.greatest(F.array_max(ends), F.col("at")))

    spans = F.transform(firsts, lambda p: F.struct((last(p) - p).alias("more"), p.alias("doc_from")))
    spans = F.filter(spans, lambda s: s["more"].isNotNull() & (s["more"] < reach) & (s["doc_from"] <= F.col("at")))
    found = whole.select(*group, F.array_min(spans).alias("span")).where("span is not null")
    return found.select(*DOC, *ITEM, "start", F.col("span.doc_from").alias("doc_from"), (F.col("span.doc_from") + F.col("span.more")).alias("doc_to")).distinct()


def contaminated(index: Index, matches: DataFrame) -> DataFrame:
    """(doc_id, mark, n_words, n_hit, items) for every document: its words inside matches,
    and the ids of the items that match, as sorted texts."""
    ends = matches.select(*DOC, "item_id", "doc_from", (F.col("doc_from") + F.col("n_words") - 1).alias("doc_to"))
    before = Window.partitionBy(*DOC).orderBy("doc_from", "doc_to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("doc_to").over(before), F.lit(0)), F.col("doc_from") - 1)
    fresh = ends.withColumn("_new", F.greatest(F.lit(0), F.col("doc_to") - reached))
    hit = fresh.groupBy(*DOC).agg(
        F.sum("_new").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    hit = hit.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "n_hit", "items")
    heads = index.postings.where(F.col("term") == HEAD)
    same = heads["doc_id"].eqNullSafe(hit["_id"]) & (heads["mark"] == hit["_mark"])
    return heads.join(hit, same, "left").select(
        *DOC, F.col("n").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """`contaminated` for exact matches of `docs` (doc_id, text) with `items` (item_id,
    text): one row per row of `docs`.

    A window is `window` consecutive words of an item, or all words of a shorter one; a
    word inside any occurrence of a window is hit. Null and empty texts have no words;
    such an item matches nothing. Repeated rows come back as often. Rows with equal or
    null ids are told apart by a hash of their text. Words covered by an item without id
    are hit, but the item is not listed; items with equal ids count as one. Other columns
    are ignored; an empty table of documents gives no rows."""
    index = build_index(docs, items)
    return contaminated(index, phrases(index, window))
