"""Finished orders without vouchers, and the cash receipts they are missing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.functions.columns import (
    conform,
    join_spread,
    or_zero,
    stable_id,
    within,
    without,
)
from ledgerops.operators.numbering import (
    AS_WRITTEN,
    INTENDED,
    number_in_branch,
    number_rows,
    voucher_number,
    with_number_state,
)
from ledgerops.sources.schemas import SCHEMAS

Tables = Mapping[str, DataFrame]

SALE, COD, DEBT = 1, 2, 3
PAYMENT_ORDER = ["branch_id", "ref_date", "ref_no", "order_id", "payment_id", "receipt_ref_type"]
ORDER_COLUMNS = (
    "order_id", "ref_no", "ref_type", "ref_date", "order_date", "completed_date", "branch_id",
    "customer_id", "customer_code", "customer_name", "channel_id", "is_cod_paid",
    "receive_amount", "remain_amount", "debt_payment_amount", "cashier_name", "cashier_id",
    "employee_id", "employee_code", "employee_name",
)


def target_orders(t: Tables, batch: int | None = None) -> DataFrame:
    """Finished sales orders with a stocked line and no stock issue yet.

    `batch` keeps the oldest orders; the receipts and the stock issues of one
    run have to share one draw."""
    done = t["sa_order"].where(
        F.col("order_status").isin(*codes.ORDER_DONE) & (F.col("ref_type") == codes.SALES_ORDER)
    )
    issued = t["voucher_reference"].where(F.col("ref_type1") == codes.STOCK_ISSUE)
    stocked = t["sa_order_detail"].where(F.col("inventory_item_type") == codes.STOCKED_ITEM)
    open_orders = without(done, issued.select(F.col("ref_id2").alias("order_id")), ["order_id"])
    targets = within(open_orders, stocked, ["order_id"])
    if batch is None:
        return targets
    return targets.orderBy(F.col("ref_date").asc_nulls_first(), "order_id").limit(batch)


def customer_debt(closing: DataFrame) -> DataFrame:
    """One closing debt per customer and branch."""
    return closing.groupBy("account_object_id", "branch_id").agg(
        F.max("separate_debt_amount").alias("separate_debt_amount")
    )


def _blocked(links: DataFrame) -> DataFrame:
    """Per order: which kinds of receipt its existing links rule out."""
    kinds = {"_sale": codes.RECEIPT_LINKS, "_cod": codes.COD_LINKS, "_debt": codes.DEBT_LINKS}
    every = sorted({code for group in kinds.values() for code in group})
    return (
        links.where(F.col("ref_type1").isin(*every))
        .groupBy(F.col("ref_id2").alias("order_id"))
        .agg(*[F.max(F.col("ref_type1").isin(*group)).alias(k) for k, group in kinds.items()])
    )


def _free(flag: str) -> Column:
    return ~F.coalesce(F.col(flag), F.lit(False))


def _open_for_receipts(t: Tables, targets: DataFrame) -> DataFrame:
    """Orders that may get receipts, each with the one kind it is and what is owed.

    The kinds exclude each other, so every order has at most one. Only orders of
    kind 3 look up a debt; the others keep to themselves in that join, spread by
    their own id."""
    orders = (
        targets.select(*ORDER_COLUMNS)
        .where((F.col("receive_amount") > 0) | (F.col("remain_amount") > 0))
        .join(_blocked(t["voucher_reference"]), "order_id", "left")
    )
    store = F.col("channel_id") == codes.CHANNEL_STORE
    cod = (F.col("is_cod_paid") == 1) & ~store
    store_debt = store & (F.col("debt_payment_amount") > 0)
    received = F.col("receive_amount") > 0
    source = (
        F.when(received & ~cod & ~store_debt & _free("_sale"), SALE)
        .when(cod & (F.col("remain_amount") > 0) & _free("_cod"), COD)
        .when(received & store_debt & _free("_debt"), DEBT)
    )
    is_debt = F.col("source") == DEBT
    kinds = (
        orders.withColumn("source", source)
        .where(F.col("source").isNotNull())
        .drop("_sale", "_cod", "_debt")
        .withColumn("_debtor", F.when(is_debt, F.col("customer_id")))
        .withColumn("_apart", F.when(~is_debt, F.col("order_id")))
    )
    closing = customer_debt(t["led_account_object_closing"]).withColumnRenamed("account_object_id", "_debtor")
    joined = join_spread(kinds, closing, ["_debtor", "branch_id"], "left", apart="_apart")
    return joined.drop("_debtor", "_apart")


def _payments(payments: DataFrame) -> DataFrame:
    """Payment rows that count for a receipt, with `for_debt`: of kind 3 or of 1 and 2."""
    payment = F.col("payment_type")
    sale, debt = ~payment.isin(*codes.NOT_A_SALE_PAYMENT), payment.isin(*codes.DEBT_PAYMENT)
    return payments.where((sale | debt) & (F.col("amount") > 0)).select(
        "order_id", "payment_id", "payment_type", "amount", "bank_account_id", "account_number",
        debt.alias("for_debt"),
    )


def _first_payment(payments: DataFrame) -> DataFrame:
    """The lowest payment key of each order and use, as a map-side combinable minimum."""
    row = F.struct("payment_id", "payment_type", "amount", "bank_account_id", "account_number")
    firsts = payments.groupBy("order_id", "for_debt").agg(F.min(row).alias("p"))
    return firsts.select("order_id", "p.*", "for_debt")


def receipt_candidates(t: Tables, targets: DataFrame, mode: str = AS_WRITTEN) -> DataFrame:
    """One row per receipt to write, from three kinds of order; the kinds exclude
    each other for any payment row. `source` tells which kind it was.

    Orders are told apart once and meet the payments in one join. As written, kinds 2
    and 3 repeat the whole amount on every payment row; as intended they give it
    once, on the lowest payment key."""
    orders = _open_for_receipts(t, targets)
    payments = _payments(t["sa_order_payment"])
    source, payment = F.col("source"), F.col("payment_type")

    def paid(orders: DataFrame, payments: DataFrame) -> DataFrame:
        joined = join_spread(payments, orders, ["order_id"], "inner")
        return joined.where(F.col("for_debt") == (source == DEBT)).drop("for_debt")

    if mode == INTENDED:
        rows = paid(orders.where(source == SALE), payments).unionByName(
            paid(orders.where(source != SALE), _first_payment(payments))
        )
    else:
        rows = paid(orders, payments)
    in_cash = payment.isin(*codes.CASH_PAYMENT)
    ref_type = (
        F.when(source == DEBT, F.when(payment == codes.CASH_DEBT_PAYMENT, codes.CASH_DEBT).otherwise(codes.BANK_DEBT))
        .when((source == SALE) & (payment == codes.DEPOSIT_PAYMENT), codes.BANK_DEPOSIT)
        .when(in_cash, codes.CASH_SALE)
        .otherwise(codes.BANK_SALE)
    )

    def by_kind(sale: Column, cod: Column, debt: Column) -> Column:
        return F.when(source == SALE, sale).when(source == COD, cod).otherwise(debt)

    amount, remain = F.col("amount"), F.col("remain_amount")
    return rows.withColumns(
        {
            "receipt_ref_type": ref_type,
            "receipt_amount": by_kind(amount, remain, F.col("debt_payment_amount")),
            "receipt_is_cash_sale": F.when(source == DEBT, 0).otherwise(1),
            "receipt_remain_amount": by_kind(amount, remain, or_zero(F.col("separate_debt_amount"))),
        }
    ).drop("separate_debt_amount")


def number_receipts(candidates: DataFrame, mode: str = AS_WRITTEN) -> DataFrame:
    """Candidates with `row_num`: one sequence over all branches as written, one
    per branch as intended."""
    numbered = number_rows(candidates, PAYMENT_ORDER, "receipts")
    return number_in_branch(numbered) if mode == INTENDED else numbered


def receipt_headers(
    numbered: DataFrame, state: DataFrame, options: DataFrame, mode: str = AS_WRITTEN
) -> DataFrame:
    """All facts of each receipt; the written tables are projections of it."""
    kind, payment = F.col("receipt_ref_type"), F.col("payment_type")
    cashier = F.nullif(F.col("cashier_name"), F.lit(""))
    facts = with_number_state(numbered, state, options, codes.RECEIPT_CATEGORY)
    return facts.select(
        stable_id(
            F.lit("receipt"), F.col("order_id"), F.col("payment_id"), kind, F.col("row_num")
        ).alias("ref_id"),
        kind.alias("ref_type"),
        voucher_number(mode).alias("ref_no"),
        F.coalesce("completed_date", "ref_date", "order_date").alias("ref_date"),
        "branch_id",
        F.coalesce(cashier, F.col("employee_name")).alias("employee_name"),
        F.coalesce("cashier_id", "employee_id").alias("employee_id"),
        "employee_code",
        F.when(
            kind.isin(codes.CASH_DEBT, codes.BANK_DEBT),
            F.concat(F.lit(codes.DEBT_MEMO), "customer_name"),
        )
        .when(payment == codes.DEPOSIT_PAYMENT, F.concat(F.lit(codes.DEPOSIT_MEMO), "ref_no"))
        .otherwise(F.concat(F.lit(codes.SALE_MEMO), "ref_no"))
        .alias("description"),
        F.col("receipt_amount").alias("total_amount"),
        F.when(payment.isin(*codes.CASH_PAYMENT, codes.CASH_DEBT_PAYMENT), 1)
        .otherwise(2)
        .alias("cash_type"),
        F.col("receipt_is_cash_sale").alias("is_cash_sale"),
        "channel_id",
        F.col("bank_account_id").alias("to_bank_account_id"),
        F.col("account_number").alias("to_bank_account_number"),
        F.when(payment.isin(*codes.UNRECONCILED_PAYMENT), False)
        .otherwise(True)
        .alias("is_reconciled"),
        F.col("customer_id").alias("object_id"),
        F.col("customer_code").alias("object_code"),
        F.col("customer_name").alias("object_name"),
        F.when(F.col("customer_id").isNotNull(), 1).alias("object_type"),
        "receipt_remain_amount",
        "order_id",
        F.col("ref_no").alias("order_no"),
        F.col("ref_date").alias("order_date"),
        F.col("ref_type").alias("order_ref_type"),
        "category_ref_type_id", "prefix", "length_of_value", "use_branch_prefix",
        "branch_prefix", "suffix", "value", "row_num",
    )


def _signed(frame: DataFrame, run_at: Column) -> DataFrame:
    return frame.withColumns(
        {
            "created_date": run_at,
            "created_by": F.lit(codes.RECEIPT_AUTHOR),
            "modified_date": run_at,
            "modified_by": F.lit(None).cast("string"),
        }
    )


def receipt_rows(headers: DataFrame, run_at: Column) -> DataFrame:
    rows = headers.withColumns(
        {"is_auto_generate": F.lit(True), "approved_type": F.lit(codes.APPROVED)}
    )
    return conform(_signed(rows, run_at), SCHEMAS["ca_receipt"])


def receipt_lines(headers: DataFrame, run_at: Column) -> DataFrame:
    rows = headers.withColumns(
        {
            "ref_detail_id": stable_id(F.lit("receipt line"), F.col("ref_id")),
            "amount": F.col("total_amount"),
            "remain_amount": F.col("receipt_remain_amount"),
            "sort_order": F.lit(1),
            "budget_item_id": F.lit(codes.BUDGET_ID),
            "budget_item_code": F.lit(codes.BUDGET_CODE),
            "budget_item_name": F.lit(codes.BUDGET_NAME),
        }
    )
    return conform(_signed(rows, run_at), SCHEMAS["ca_receipt_detail"])
