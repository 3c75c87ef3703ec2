"""Sequence numbers over a whole table, voucher numbers and the number state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.functions.columns import conform, join_spread, stable_id
from ledgerops.session import keep
from ledgerops.sources.schemas import SCHEMAS

AS_WRITTEN, INTENDED = "as_written", "intended"
LARGEST_NUMBER = 2**64 - 1
_ROW_BITS = 33


def number_rows(frame: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add `row_num`, 1..n over the whole frame in the given order.

    The frame is range-partitioned on the full order key, so rows of one branch
    or one day spread over many tasks; each row gets its place within its
    partition, and the partitions' row counts give the offsets. The placed rows
    are written first, since ranges come from a sample and must not be drawn
    twice. The offset table holds one row per partition."""
    keys = [F.col(column).asc_nulls_first() for column in order]
    placed = keep(
        frame.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_place", _ROW_BITS)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_place").bitwiseAND(F.lit(2**_ROW_BITS - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_num", F.col("_offset") + inside + 1)
        .drop("_part", "_place", "_offset")
    )


def number_in_branch(numbered: DataFrame) -> DataFrame:
    """Turn numbers over the whole frame, led by branch, into numbers per branch."""
    keyed = numbered.withColumn("_key", F.coalesce(F.concat(F.lit("="), "branch_id"), F.lit("")))
    first = keyed.groupBy("_key").agg(F.min("row_num").alias("_first"))
    return (
        join_spread(keyed, first, ["_key"], "inner")
        .withColumn("row_num", F.col("row_num") - F.col("_first") + 1)
        .drop("_key", "_first")
    )


def with_number_state(
    numbered: DataFrame, state: DataFrame, options: DataFrame, category: int
) -> DataFrame:
    """Add the branch's number state and store code; a branch without state drops out."""
    states = state.where(F.col("category_ref_type_id") == category).select(
        "branch_id", "category_ref_type_id", "prefix", "length_of_value",
        "use_branch_prefix", "branch_prefix", "suffix", "value",
    )
    store = options.where(F.col("option_id") == codes.STORE_OPTION).select(
        "branch_id", F.col("option_value").alias("_store")
    )
    return numbered.join(states, "branch_id").join(store, "branch_id", "left")


def orders_without_state(
    targets: DataFrame, state: DataFrame, categories: tuple[int, ...]
) -> DataFrame:
    """How many target orders per branch and category stay without vouchers of that
    category for want of a number state."""
    states = state.where(F.col("category_ref_type_id").isin(*categories)).select(
        "branch_id", "category_ref_type_id"
    )
    needed = F.explode(F.array(*[F.lit(category) for category in categories]))
    return (
        targets.groupBy("branch_id")
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("category_ref_type_id", needed)
        .join(states.distinct(), ["branch_id", "category_ref_type_id"], "left_anti")
        .select("branch_id", "category_ref_type_id", "orders")
    )


def _next_value() -> Column:
    value = F.coalesce(F.col("value").cast("decimal(20,0)"), F.lit(0)) + F.col("row_num")
    return value.cast("string")


def voucher_number(mode: str = AS_WRITTEN) -> Column:
    """[store code-] prefix, then state value plus row number padded to the length. As
    written a longer number loses its last digits; as intended it keeps them all."""
    length = F.col("length_of_value")
    if mode == INTENDED:
        length = F.greatest(length, F.length(_next_value()))
    return F.concat(
        F.coalesce(F.concat("_store", F.lit("-")), F.lit("")),
        F.coalesce(F.col("prefix"), F.lit("")),
        F.lpad(_next_value(), length, F.lit("0")),
    )


def is_too_long() -> Column:
    """Whether a number has more digits than its length."""
    return F.length(_next_value()) > F.col("length_of_value")


def numbers_too_long(vouchers: DataFrame) -> DataFrame:
    """How many numbers per branch and category have more digits than their length: as
    written these are cut and may repeat."""
    return (
        vouchers.where(is_too_long())
        .groupBy("branch_id", "category_ref_type_id")
        .agg(F.count(F.lit(1)).alias("numbers"))
    )


def number_registry(vouchers: DataFrame, table: str, run_at: Column) -> DataFrame:
    """One registry row per voucher; `value` is the state before this run."""
    receipt = table == "ca_receipt"
    prefix = F.coalesce(F.col("prefix"), F.lit("")) if receipt else F.col("prefix")
    category = F.col("category_ref_type_id").cast("string")
    bar = F.lit("|")
    rows = vouchers.select(
        stable_id(F.lit("registry"), F.col("ref_id")).alias("refno_management_id"),
        F.concat("branch_id", bar, category, bar, "ref_no").alias("id"),
        F.concat(
            "branch_id", bar, category, bar, prefix, bar, F.col("length_of_value").cast("string")
        ).alias("state_key"),
        "branch_id",
        F.col("category_ref_type_id").alias("reftype_category"),
        F.col("ref_type").alias("reftype"),
        F.col("ref_no").alias("refno"),
        F.col("ref_id").alias("refid"),
        F.lit(table).alias("table_name"),
        "use_branch_prefix", "branch_prefix", "prefix", "suffix", "length_of_value", "value",
        F.lit(1).alias("auto_increment"),
        *authorship(receipt, run_at),
    )
    return conform(rows, SCHEMAS["refno_management"])


def authorship(receipt: bool, run_at: Column) -> list[Column]:
    """Who wrote a link or registry row: receipts name the author, issues the editor."""
    return [
        run_at.alias("created_date"),
        F.lit(codes.RECEIPT_AUTHOR if receipt else None).cast("string").alias("created_by"),
        run_at.alias("modified_date"),
        F.lit(None if receipt else codes.EDITOR).cast("string").alias("modified_by"),
    ]


def order_links(vouchers: DataFrame, receipt: bool, run_at: Column) -> DataFrame:
    """One voucher-to-order link per voucher."""
    rows = vouchers.select(
        stable_id(F.lit("link"), F.col("ref_id")).alias("reference_id"),
        F.col("ref_id").alias("ref_id1"),
        F.col("order_id").alias("ref_id2"),
        F.col("ref_type").alias("ref_type1"),
        F.col("order_ref_type").alias("ref_type2"),
        F.col("ref_no").alias("ref_no_finance1"),
        F.col("order_no").alias("ref_no_finance2"),
        F.col("ref_date").alias("ref_date1"),
        F.col("order_date").alias("ref_date2"),
        F.lit(0).alias("sort_order"),
        *authorship(receipt, run_at),
    )
    return conform(rows, SCHEMAS["voucher_reference"])


def highest_numbers(registry: DataFrame, categories: tuple[int, ...]) -> DataFrame:
    """Highest trailing number per branch and category over all registered numbers."""
    digits = F.ltrim(F.regexp_substr("refno", F.lit("[0-9]+$")), F.lit("0"))
    largest = F.lit(str(LARGEST_NUMBER)).cast("decimal(20,0)")
    # a number beyond 64 bits counts as the largest 64-bit number
    number = F.when(digits == "", F.lit(0)).otherwise(
        F.least(F.coalesce(digits.try_cast("decimal(20,0)"), largest), largest)
    )
    limited = F.when(digits.isNotNull(), number)
    return (
        registry.where(F.col("reftype_category").isin(*categories))
        .select("branch_id", "reftype_category", limited.cast("decimal(20,0)").alias("_number"))
        .where(F.col("_number").isNotNull())
        .groupBy("branch_id", "reftype_category")
        .agg(F.max("_number").alias("_highest"))
    )


def merge_highest(parts: DataFrame) -> DataFrame:
    """Highest numbers of several parts of a registry, brought together."""
    return parts.groupBy("branch_id", "reftype_category").agg(F.max("_highest").alias("_highest"))


def advance_state(
    state: DataFrame, registry: DataFrame | None, categories: tuple[int, ...],
    mode: str = AS_WRITTEN, highest: DataFrame | None = None,
) -> DataFrame:
    """Next version of the number state. As written, a branch without a registered
    number of the category loses its value; as intended it keeps it. `highest` may be
    given in place of the registry."""
    found = highest_numbers(registry, categories) if highest is None else highest
    highest = found.withColumnsRenamed(
        {"branch_id": "_branch", "reftype_category": "_category"}
    )
    joined = state.join(
        highest,
        (F.col("branch_id") == F.col("_branch"))
        & (F.col("category_ref_type_id") == F.col("_category")),
        "left",
    )
    moved = F.col("category_ref_type_id").isin(*categories)
    if mode == INTENDED:
        moved = moved & F.col("_highest").isNotNull()
    return conform(
        joined.withColumns(
            {
                name: F.when(moved, F.col("_highest")).otherwise(F.col(name).cast("decimal(20,0)"))
                for name in ("value", "max_value")
            }
        ),
        SCHEMAS["refno_state"],
    )

