"""The voucher job: receipts and stock issues for finished orders, as change sets."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.operators import costing, issues, numbering, receipts, usage
from ledgerops.operators.numbering import AS_WRITTEN
from ledgerops.session import keep

Tables = Mapping[str, DataFrame]
BATCH = 1000  # what the stored procedure takes at a time


def at(run_at: datetime) -> Column:
    """The run's one time stamp, the same in every row and on every rerun."""
    return F.lit(run_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


@dataclass(frozen=True)
class Edit:
    """A change to some rows of a table. From any rows of it `touched` picks those that
    change or go, and `rewritten` gives the next version; rows not touched pass through."""

    touched: Callable[[DataFrame], DataFrame]
    rewritten: Callable[[DataFrame], DataFrame]


class Figures:
    """Counts that are taken by the pass that writes a frame, without reading it again."""

    def __init__(self) -> None:
        self._watches: dict[str, Observation] = {}

    def watch(self, name: str) -> Observation:
        self._watches[name] = Observation()  # a name of its own, so that runs may meet in one plan
        return self._watches[name]

    def read(self) -> dict[str, int]:
        """The counts, once the run is written; until then this waits. A frame that
        turned out empty has none and counts nothing."""
        return {name: n for watch in self._watches.values() for name, n in watch.get.items()}


@dataclass(frozen=True)
class Changes:
    """What one run adds to tables, and the tables it replaces. A table in `replaced` may
    also have an edit that gives the same rows from the files concerned (with what is to
    be added to it in `inserted`), or rows that reading adds up with those stored."""

    added: dict[str, DataFrame]
    replaced: dict[str, DataFrame]
    edits: dict[str, Edit] = field(default_factory=dict)
    inserted: dict[str, DataFrame] = field(default_factory=dict)
    deltas: dict[str, DataFrame] = field(default_factory=dict)
    targets: DataFrame | None = None
    refresh: DataFrame | None = None
    left_over: DataFrame | None = None
    later: DataFrame | None = None
    figures: Figures = field(default_factory=Figures)


def generate_vouchers(
    t: Tables,
    run_at: datetime,
    batch: int | None = None,
    mode: str = AS_WRITTEN,
) -> Changes:
    """One run over all target orders, or over the oldest `batch` of them; `later` then
    has the number of those left for another run. `left_over` counts orders that get
    no receipts or no issue because their branch has no number state. `figures` counts,
    in the passes that write the run, numbers that outgrow their length, prices and
    amounts that their columns cannot hold, and units with several rates.

    The target orders, the numbered vouchers and the costed lines are written to
    the shared folder, since several outputs are made from each of them."""
    now = at(run_at)
    state, options = t["refno_state"], t["dboption"]
    needed = dict.fromkeys((*receipts.ORDER_COLUMNS, *issues.ORDER_COLUMNS))
    targets = keep(receipts.target_orders(t, batch).select(*needed), "targets")

    candidates = receipts.receipt_candidates(t, targets, mode)
    receipt = receipts.receipt_headers(
        receipts.number_receipts(candidates, mode), state, options, mode
    )
    issue = issues.issue_headers(issues.number_issues(targets, mode), state, options, mode)
    plain = keep(issues.stored_issue_lines(issue, t, now), "issue_lines")
    on_hand = costing.stock_on_hand(
        t["led_inventory_item_ledger"], costing.issue_points(plain), mode, priced_only=True
    )
    figures = Figures()
    costed = costing.cost_lines(plain, on_hand, t["unit_convert"], mode, figures.watch("rates"))
    lines = keep(
        costed.observe(
            figures.watch("lines"),
            F.count_if("priced").alias("priced_lines"),
            F.count_if("saturated").alias("saturated_lines"),
        ),
        "costed_lines",
    )

    def counted(vouchers: DataFrame, kind: str) -> DataFrame:
        """Numbers written, and those longer than their length, which as written are cut."""
        return vouchers.observe(
            figures.watch(kind),
            F.count(F.lit(1)).alias(f"{kind}_numbers"),
            F.count_if(numbering.is_too_long()).alias(f"{kind}_numbers_too_long"),
        )


    links = numbering.order_links(receipt, True, now).unionByName(
        numbering.order_links(issue, False, now)
    )
    registry = numbering.number_registry(receipt, "ca_receipt", now).unionByName(
        numbering.number_registry(issue, "outward", now)
    )
    categories = (codes.RECEIPT_CATEGORY, codes.ISSUE_CATEGORY)
    counts = usage.receipt_usage(receipt).unionByName(usage.issue_usage(issue, lines))
    return Changes(
        added={
            "ca_receipt": receipts.receipt_rows(counted(receipt, "receipt"), now),
            "ca_receipt_detail": receipts.receipt_lines(receipt, now),
            "outward": issues.with_totals(issues.issue_rows(counted(issue, "issue"), now), lines),
            "outward_detail": issues.line_rows(lines),
            "voucher_reference": links,
            "refno_management": registry,
        },
        replaced={
            "refno_state": numbering.advance_state(
                state, t["refno_management"].unionByName(registry), categories, mode
            ),
            "object_reference": usage.add_usage(t["object_reference"], counts, now, mode),
        },
        deltas={"object_reference": usage.usage_delta(t["object_reference"], counts, now, mode)},
        targets=targets,
        refresh=usage.orders_to_refresh(t["voucher_reference"].unionByName(links)),
        left_over=numbering.orders_without_state(targets, state, categories),
        later=None if batch is None else _later(t, targets),
        figures=figures,
    )


def _later(t: Tables, targets: DataFrame) -> DataFrame:
    """One row: how many target orders this run did not take."""
    taken = targets.agg((-F.count(F.lit(1))).alias("orders"))
    every = receipts.target_orders(t).agg(F.count(F.lit(1)).alias("orders"))
    return every.unionByName(taken).agg(F.sum("orders").alias("orders"))
