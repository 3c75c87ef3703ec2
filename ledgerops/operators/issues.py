"""Stock-issue vouchers for finished orders: headers, lines and totals."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.functions.columns import MONEY, conform, null_of, stable_id
from ledgerops.operators.numbering import (
    AS_WRITTEN,
    INTENDED,
    number_in_branch,
    number_rows,
    voucher_number,
    with_number_state,
)
from ledgerops.sources.schemas import SCHEMAS
from ledgerops.sources.tables import through

ISSUE_ORDER = ["branch_id", "ref_date", "ref_no", "order_id"]
ORDER_COLUMNS = (
    "order_id", "ref_no", "ref_type", "ref_date", "branch_id", "customer_id", "customer_code",
    "customer_name", "channel_id", "stock_id",
)
EMPTY_LINE_COLUMNS = (
    "stock_location_id", "stock_location_name", "inward_ref_id", "inward_ref_detail_id",
    "drug_code", "production_date", "registration_no", "drug_unit_id", "drug_quantity",
    "drug_price", "drug_unit_name",
)


def number_issues(targets: DataFrame, mode: str = AS_WRITTEN) -> DataFrame:
    numbered = number_rows(targets.select(*ORDER_COLUMNS), ISSUE_ORDER, "issues")
    return number_in_branch(numbered) if mode == INTENDED else numbered


def issue_headers(
    numbered: DataFrame, state: DataFrame, options: DataFrame, mode: str = AS_WRITTEN
) -> DataFrame:
    """All facts of each stock issue; the written tables are projections of it."""
    facts = with_number_state(numbered, state, options, codes.ISSUE_CATEGORY)
    return facts.select(
        stable_id(F.lit("issue"), F.col("order_id"), F.col("row_num")).alias("ref_id"),
        F.lit(codes.STOCK_ISSUE).alias("ref_type"),
        voucher_number(mode).alias("ref_no"),
        "ref_date",
        "branch_id",
        F.lit(codes.ISSUE_EMPLOYEE).alias("employee_name"),
        F.concat(F.lit(codes.ISSUE_MEMO), "ref_no").alias("journal_memo"),
        F.col("customer_id").alias("account_object_id"),
        F.col("customer_code").alias("account_object_code"),
        F.col("customer_name").alias("account_object_name"),
        "channel_id",
        "stock_id",
        "order_id",
        F.col("ref_no").alias("order_no"),
        F.col("ref_date").alias("order_date"),
        F.col("ref_type").alias("order_ref_type"),
        "category_ref_type_id", "prefix", "length_of_value", "use_branch_prefix",
        "branch_prefix", "suffix", "value", "row_num",
    )


def issue_rows(headers: DataFrame, run_at: Column) -> DataFrame:
    """Header rows before costing; an order without a customer goes to the guest."""
    customer = F.col("account_object_id")
    guest = customer.isNull() | customer.isin("", codes.NO_ID)
    rows = headers.withColumns(
        {
            "account_object_id": F.when(guest, codes.GUEST_ID).otherwise(customer),
            "account_object_code": F.when(guest, codes.GUEST_CODE).otherwise(
                F.col("account_object_code")
            ),
            "account_object_name": F.when(guest, codes.GUEST_NAME).otherwise(
                F.col("account_object_name")
            ),
            "total_amount": F.lit(0),
            "payment_type": F.lit(0),
            "created_date": run_at,
            "modified_date": run_at,
            "modified_by": F.lit(codes.EDITOR),
            "object_type": F.lit(1),
        }
    )
    return conform(rows, SCHEMAS["outward"])


def issue_lines(
    headers: DataFrame, details: DataFrame, stock: DataFrame, items: DataFrame, run_at: Column
) -> DataFrame:
    """Lines before costing, with the issue date, the order id and the item's parent
    at hand. An issue from an unknown stock has no lines."""
    return _issue_lines(details.join(_heads(headers), "order_id"), stock, items, run_at)


def stored_issue_lines(headers: DataFrame, t: Mapping[str, DataFrame], run_at: Column) -> DataFrame:
    """`issue_lines` of the tables; where the order lines are a view, headers are joined
    below it."""
    heads = _heads(headers)
    details = through(t, "sa_order_detail", ["order_id"], lambda lines: lines.join(heads, "order_id"))
    return _issue_lines(details, t["stock"], t["inventory_item"], run_at)


def _heads(headers: DataFrame) -> DataFrame:
    return headers.select("order_id", "ref_id", "ref_date", "stock_id", "row_num")


def _issue_lines(details: DataFrame, stock: DataFrame, items: DataFrame, run_at: Column) -> DataFrame:
    sold = details.where(F.coalesce(F.col("is_return"), F.lit(0)) == 0).select(
        "order_id", "order_detail_id", "inventory_item_id", "sku_code", "inventory_item_name",
        "unit_id", "quantity", "unit_name", "sort_order", "lot_no", "expired_date",
        F.col("ref_detail_parent_id").alias("detail_parent_id"),
        "ref_id", "ref_date", "stock_id", "row_num",
    )
    stocks = stock.select("stock_id", "stock_name", "stock_code")
    stocked = items.where(F.col("inventory_item_type") == codes.STOCKED_ITEM).select(
        "inventory_item_id", "inventory_item_type", "unit_list", "parent_id"
    )
    rows = sold.join(stocks, "stock_id").join(stocked, "inventory_item_id")
    line_id = stable_id(F.lit("issue line"), F.col("ref_id"), F.col("order_detail_id"))
    zero = F.lit(0).cast(MONEY)
    empty = {name: null_of(SCHEMAS["outward_detail"][name]) for name in EMPTY_LINE_COLUMNS}
    return rows.withColumns(
        {
            "ref_detail_id": line_id,
            "unit_price": zero,
            "amount": zero,
            "created_date": run_at,
            "modified_date": run_at,
            **empty,
        }
    )


def line_rows(lines: DataFrame) -> DataFrame:
    return conform(lines, SCHEMAS["outward_detail"])


def with_totals(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Header rows with the sum of their lines; a header without lines keeps its total."""
    totals = lines.groupBy("ref_id").agg(F.sum("amount").cast(MONEY).alias("_total"))
    summed = rows.join(totals, "ref_id", "left").withColumn(
        "total_amount", F.coalesce("_total", "total_amount")
    )
    return conform(summed, SCHEMAS["outward"])
