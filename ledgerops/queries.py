"""Every operator as a query over the derived tables of a test-data folder."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.operators import (
    costing,
    inventory_checks,
    issues,
    numbering,
    receipts,
    receivable_checks,
    sync,
    usage,
)
from ledgerops.operators.numbering import AS_WRITTEN, INTENDED
from ledgerops.plans.generate import BATCH, at, generate_vouchers
from ledgerops.plans.synchronise import synchronise
from ledgerops.session import keep, tune
from ledgerops.sources.clustered import LEDGER, ClusteredTables
from ledgerops.sources.tables import DerivedTables

Tables = Mapping[str, DataFrame]
RUN_AT = datetime(2026, 1, 1)
CAP = 100

_tables: dict[tuple[str, str], DerivedTables] = {}
_clustered: dict[int, ClusteredTables] = {}
BUCKETS = 8  # of a small clustered ledger
CLUSTERED = (
    "inventory_item_id", "branch_id", "stock_id", "lot_no", "expired_date", "stock_location_id", "ref_date",
    "main_inward_quantity", "main_outward_quantity", "inward_amount", "outward_amount",
)


def derived_tables(spark: SparkSession, folder: str) -> DerivedTables:
    """One set of tables per application and folder, so that stored ones are built once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = DerivedTables(tune(spark), folder)
    return _tables[key]


def clustered(t: DerivedTables) -> ClusteredTables:
    """The tables with a clustered ledger of the columns that levels and costing read; it
    is written once."""
    if id(t) not in _clustered:
        _clustered[id(t)] = ClusteredTables(t, BUCKETS, CLUSTERED)
    return _clustered[id(t)]


def candidates(t: Tables, mode: str = AS_WRITTEN) -> DataFrame:
    """The targets are written first, as in the job."""
    needed = dict.fromkeys((*receipts.ORDER_COLUMNS, *issues.ORDER_COLUMNS))
    targets = keep(receipts.target_orders(t).select(*needed), "targets")
    return receipts.receipt_candidates(t, targets, mode)


def _source(kind: int, mode: str = AS_WRITTEN) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        return candidates(t, mode).where(F.col("source") == kind).select(*CANDIDATE)

    return query


CANDIDATE = (
    "source", "order_id", "payment_id", "payment_type", "receipt_ref_type", "receipt_amount",
    "receipt_is_cash_sale", "receipt_remain_amount", "bank_account_id", "account_number",
)


def receipt_headers(t: Tables, mode: str = AS_WRITTEN) -> DataFrame:
    numbered = receipts.number_receipts(candidates(t, mode), mode)
    return receipts.receipt_headers(numbered, t["refno_state"], t["dboption"])


def issue_headers(t: Tables, mode: str = AS_WRITTEN) -> DataFrame:
    numbered = issues.number_issues(receipts.target_orders(t), mode)
    return issues.issue_headers(numbered, t["refno_state"], t["dboption"])


COSTED = (
    "ref_id", "ref_detail_id", "order_detail_id", "inventory_item_id", "parent_id", "stock_id", "ref_date",
    "unit_id", "quantity", "unit_price", "amount",
)


def issue_lines(t: Tables, headers: DataFrame | None = None, columns: tuple[str, ...] = ("*",)) -> DataFrame:
    """Written once, since costing reads the lines for their issue times as well; of them
    only the `columns` that the caller uses."""
    headers = issue_headers(t) if headers is None else headers
    lines = issues.stored_issue_lines(headers, t, at(RUN_AT))
    return keep(lines.select(*columns), "issue_lines")


def on_hand(t: Tables, mode: str) -> DataFrame:
    """The points are written, not the lines: they are all that is read of these."""
    headers = issue_headers(t).select("order_id", "ref_id", "ref_date", "stock_id", "row_num")
    lines = issues.stored_issue_lines(headers, t, at(RUN_AT))
    points = keep(costing.issue_points(lines), "issue_points")
    return costing.stock_on_hand(t[LEDGER], points, mode)


def costed_lines(t: Tables, mode: str, headers: DataFrame | None = None) -> DataFrame:
    lines = issue_lines(t, headers, COSTED)
    held = costing.stock_on_hand(
        t["led_inventory_item_ledger"], costing.issue_points(lines), mode, priced_only=True
    )
    return costing.cost_lines(lines, held, t["unit_convert"], mode)


def _costed(mode: str) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        return costed_lines(t, mode).select(
            "ref_id", "ref_detail_id", "order_detail_id", "inventory_item_id", "stock_id",
            "quantity", "unit_price", "amount", "priced",
        )

    return query


def _numbers(t: Tables, mode: str) -> DataFrame:
    return receipts.number_receipts(candidates(t, mode), mode).select(
        "order_id", "payment_id", "receipt_ref_type", "branch_id", "row_num"
    )


def _issue_numbers(t: Tables, mode: str) -> DataFrame:
    return issues.number_issues(receipts.target_orders(t), mode).select(
        "order_id", "branch_id", "row_num"
    )


def _voucher_numbers(t: Tables) -> DataFrame:
    columns = ["branch_id", "category_ref_type_id", "order_id", "ref_id", "ref_no"]
    return receipt_headers(t).select(*columns).unionByName(issue_headers(t).select(*columns))


def _numbers_kept(t: Tables) -> DataFrame:
    """Numbers as intended: counted per branch, and whole where they outgrow their length."""
    columns = ["branch_id", "category_ref_type_id", "order_id", "row_num", "ref_no"]
    state, options = t["refno_state"], t["dboption"]
    numbered = receipts.number_receipts(candidates(t, INTENDED), INTENDED)
    receipt = receipts.receipt_headers(numbered, state, options, INTENDED)
    issue = issues.issue_headers(
        issues.number_issues(receipts.target_orders(t), INTENDED), state, options, INTENDED
    )
    return receipt.select(*columns).unionByName(issue.select(*columns))


def _too_long(t: Tables) -> DataFrame:
    both = [receipt_headers(t), issue_headers(t)]
    columns = ["branch_id", "category_ref_type_id", "length_of_value", "value", "row_num"]
    return numbering.numbers_too_long(both[0].select(*columns).unionByName(both[1].select(*columns)))


def _links(t: Tables) -> DataFrame:
    return numbering.order_links(receipt_headers(t), True, at(RUN_AT)).unionByName(
        numbering.order_links(issue_headers(t), False, at(RUN_AT))
    )


def _registry(t: Tables) -> DataFrame:
    return numbering.number_registry(receipt_headers(t), "ca_receipt", at(RUN_AT)).unionByName(
        numbering.number_registry(issue_headers(t), "outward", at(RUN_AT))
    )


def _state(mode: str, with_new: bool) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        registry = t["refno_management"]
        if with_new:
            registry = registry.unionByName(_registry(t))
        return numbering.advance_state(
            t["refno_state"], registry, (codes.RECEIPT_CATEGORY, codes.ISSUE_CATEGORY), mode
        )

    return query


def _issue_usage(t: Tables) -> DataFrame:
    headers = issue_headers(t)
    return usage.issue_usage(headers, issue_lines(t, headers))


def _added_usage(mode: str) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        counts = usage.receipt_usage(receipt_headers(t)).unionByName(_issue_usage(t))
        return usage.add_usage(t["object_reference"], counts, at(RUN_AT), mode)

    return query


def _totals(mode: str) -> Callable[[Tables], DataFrame]:
    def query(t: Tables) -> DataFrame:
        headers = issue_headers(t)
        rows = issues.issue_rows(headers, at(RUN_AT))
        return issues.with_totals(rows, costed_lines(t, mode, headers))

    return query


def _voucher_run(t: Tables) -> DataFrame:
    """Rows and money of every change set of one uncapped run."""
    changes = generate_vouchers(t, RUN_AT, None)
    money = {
        "ca_receipt": "total_amount",
        "ca_receipt_detail": "amount",
        "outward": "total_amount",
        "outward_detail": "amount",
        "object_reference": "used_count",
    }
    parts = None
    for name, frame in {**changes.added, **changes.replaced}.items():
        amount = F.sum(F.col(money[name])) if name in money else F.lit(None)
        part = frame.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows_written"),
            amount.cast("decimal(38,6)").alias("amount"),
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _sync_run(t: Tables) -> DataFrame:
    changes = synchronise(t, RUN_AT)
    parts = None
    for name, frame in {**changes.added, **changes.replaced}.items():
        part = frame.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_written")
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def _targets(t: Tables, batch: int | None = None) -> DataFrame:
    return receipts.target_orders(t, batch).select("order_id", "ref_no", "ref_date", "branch_id")


_INV = {name.lower(): check for name, check in inventory_checks.CHECKS.items()}

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "inv1_opening_not_in_ledger": _INV["inv1"],
    "inv2_inward_not_in_ledger": _INV["inv2"],
    "inv3_outward_not_in_ledger": _INV["inv3"],
    "inv4_transfer_out_not_in_ledger": _INV["inv4"],
    "inv5_transfer_in_not_in_ledger": _INV["inv5"],
    "inv6_transfer_either_not_in_ledger": _INV["inv6"],
    "inv7_ledger_vs_balance": _INV["inv7"],
    "inv8_ledger_vs_balance_lot": _INV["inv8"],
    "inv9_ledger_vs_balance_location": _INV["inv9"],
    "inv10_ledger_vs_closing": _INV["inv10"],
    "inv11_ledger_vs_closing_lot": _INV["inv11"],
    "inv13_order_not_in_ledger": _INV["inv13"],
    "inv14_ordered_vs_closing": _INV["inv14"],
    "inv7_ledger_vs_balance_clustered": lambda t: inventory_checks.ledger_vs_balance(clustered(t)),
    "inv_all_stock_report": inventory_checks.stock_report,
    "ar2_ledger_without_source": receivable_checks.ledger_without_source,
    "ar3_debt_over_allocated": receivable_checks.debt_over_allocated,
    "ar4_allocation_vs_ledger": receivable_checks.allocation_vs_ledger,
    "ar5_allocation_without_link": receivable_checks.allocation_without_link,
    "ar_cap_capped_findings": lambda t: receivable_checks.account_report(t, CAP),
    "ar_cap_cut_summary": lambda t: receivable_checks.cut_summary(
        {name: check(t) for name, check in receivable_checks.CHECKS.items()}, CAP
    ),
    "ar_all_account_report": receivable_checks.account_report,
    "vg1_target_orders": _targets,
    "vg2_oldest_batch": lambda t: _targets(t, BATCH),
    "vg3_sale_receipts": _source(receipts.SALE),
    "vg4_cod_receipts": _source(receipts.COD),
    "vg4_cod_receipts_intended": _source(receipts.COD, INTENDED),
    "vg5_debt_receipts": _source(receipts.DEBT),
    "vg5_debt_receipts_intended": _source(receipts.DEBT, INTENDED),
    "vg6_customer_debt": lambda t: receipts.customer_debt(t["led_account_object_closing"]),
    "vg7_receipt_candidates": lambda t: candidates(t).select(*CANDIDATE),
    "vg8_receipt_sequence": lambda t: _numbers(t, AS_WRITTEN),
    "vg8_receipt_sequence_intended": lambda t: _numbers(t, INTENDED),
    "vg8_issue_sequence": lambda t: _issue_numbers(t, AS_WRITTEN),
    "vg8_issue_sequence_intended": lambda t: _issue_numbers(t, INTENDED),
    "vg9_voucher_numbers": _voucher_numbers,
    "vg9_voucher_numbers_intended": _numbers_kept,
    "vg9_numbers_too_long": _too_long,
    "vg10_receipt_headers": lambda t: receipts.receipt_rows(receipt_headers(t), at(RUN_AT)),
    "vg11_receipt_lines": lambda t: receipts.receipt_lines(receipt_headers(t), at(RUN_AT)),
    "vg12_receipt_usage": lambda t: usage.receipt_usage(receipt_headers(t)),
    "vg13_order_links": _links,
    "vg14_number_registry": _registry,
    "vg15_number_state": _state(AS_WRITTEN, with_new=True),
    "vg15_number_state_before_run": _state(AS_WRITTEN, with_new=False),
    "vg15_number_state_before_run_intended": _state(INTENDED, with_new=False),
    "vg16_usage_counters": _added_usage(AS_WRITTEN),
    "vg16_usage_counters_intended": _added_usage(INTENDED),
    "vg17_issue_headers": lambda t: issues.issue_rows(issue_headers(t), at(RUN_AT)),
    "vg18_issue_lines": lambda t: issues.line_rows(issue_lines(t)),
    "vg19_stock_on_hand": lambda t: on_hand(t, AS_WRITTEN),
    "vg19_stock_on_hand_intended": lambda t: on_hand(t, INTENDED),
    "vg19_stock_on_hand_clustered": lambda t: on_hand(clustered(t), AS_WRITTEN),
    "vg19_stock_on_hand_clustered_intended": lambda t: on_hand(clustered(t), INTENDED),
    "vg20_costed_lines": _costed(AS_WRITTEN),
    "vg20_costed_lines_intended": _costed(INTENDED),
    "vg21_issue_totals": _totals(AS_WRITTEN),
    "vg21_issue_totals_intended": _totals(INTENDED),
    "vg22_issue_usage": _issue_usage,
    "vg23_orders_to_refresh": lambda t: usage.orders_to_refresh(
        t["voucher_reference"].unionByName(_links(t))
    ),
    "vg_orders_without_state": lambda t: numbering.orders_without_state(
        receipts.target_orders(t),
        t["refno_state"],
        (codes.RECEIPT_CATEGORY, codes.ISSUE_CATEGORY),
    ),
    "vg_unit_conflicts": lambda t: costing.unit_conflicts(t["unit_convert"]),
    "vg_whole_run": _voucher_run,
    "sy1_missing_orders": lambda t: sync.missing_orders(t, at(RUN_AT)),
    "sy2_channel_names": lambda t: t["sa_order"].select(
        "order_id", sync.channel_name(F.col("channel_id")).alias("channel_name")
    ),
    "sy3_missing_order_lines": lambda t: sync.missing_order_lines(t, at(RUN_AT)),
    "sy4_changed_orders": sync.changed_orders,
    "sy4_next_orders": lambda t: sync.next_orders(t, at(RUN_AT)),
    "sy5_issues_to_delete": lambda t: sync.issues_to_delete(t).select("ref_id", "ref_type"),
    "sy6_receipts_to_delete": lambda t: sync.receipts_to_delete(t).select("ref_id"),
    "sy7_links_to_delete": lambda t: sync.links_to_delete(t).select(
        "reference_id", "ref_id1", "ref_id2", "ref_type1"
    ),
    "sy_whole_run": _sync_run,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](derived_tables(spark, folder))
