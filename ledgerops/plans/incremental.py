"""Sums and maxima kept for each part of a published table, so that a rerun reads new parts.

A part never changes once it is published, so what was made from it stays good. A run makes
the missing pieces, each from its part alone, and brings all pieces of the version together.
Parts that an edit or a compaction took out of the table are simply not asked for."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerops.functions import codes
from ledgerops.operators import inventory_checks, numbering, receipts
from ledgerops.plans.store import Part, Snapshot, Store

CATEGORIES = (codes.RECEIPT_CATEGORY, codes.ISSUE_CATEGORY)


@dataclass(frozen=True)
class Summary:
    """What is kept of a table. `make` sums rows up, `merge` sums up what `make` gave;
    `merge` over pieces of any division of the rows has to equal `make` over all."""

    name: str
    table: str
    make: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


LEVEL_TOTALS = Summary(
    "level_totals", "led_inventory_item_ledger", inventory_checks.level_totals, inventory_checks.merge_level_totals
)
HIGHEST_NUMBERS = Summary(
    "highest_numbers", "refno_management",
    lambda rows: numbering.highest_numbers(rows, CATEGORIES), numbering.merge_highest,
)
CUSTOMER_DEBT = Summary(
    "customer_debt", "led_account_object_closing", receipts.customer_debt, receipts.customer_debt
)


class Summaries:
    """Pieces of summaries, under the store's folder."""

    def __init__(self, store: Store):
        self.store, self.folder = store, f"{store.root}/summaries"

    def _piece(self, summary: Summary, part: Part) -> str:
        return f"{self.folder}/{summary.name}/{hashlib.sha256(part.path.encode()).hexdigest()}"

    def missing(self, snapshot: Snapshot, summary: Summary) -> list[Part]:
        """Parts that no piece was made from yet."""
        done = set(self.store.files.names(f"{self.folder}/{summary.name}"))
        return [part for part in snapshot.parts[summary.table] if self._piece(summary, part).rsplit("/", 1)[1] not in done]

    def read(self, snapshot: Snapshot, summary: Summary) -> DataFrame:
        """The summary of the table in this version; writes the pieces that are missing.
        A piece is put in place whole by a rename, so one that is there is complete, and of
        two runs that make the same piece one is kept."""
        for part in self.missing(snapshot, summary):
            staged = f"{self.store.root}/staged/{uuid.uuid4().hex}"
            summary.make(snapshot.rows(summary.table, [part])).write.parquet(staged)
            self.store.files.move_if_absent(staged, self._piece(summary, part))
        pieces = [self._piece(summary, part) for part in snapshot.parts[summary.table]]
        return summary.merge(self.store.spark.read.parquet(*pieces))


def level_findings(store: Store, snapshot: Snapshot, t: inventory_checks.Tables) -> DataFrame:
    """The stock levels' findings; of the ledger only parts not seen before are read."""
    totals = Summaries(store).read(snapshot, LEVEL_TOTALS)
    return inventory_checks.level_findings(t, totals)


def number_state(store: Store, snapshot: Snapshot, state: DataFrame, mode: str = numbering.AS_WRITTEN) -> DataFrame:
    """The next number state; of the registry only parts not seen before are read."""
    highest = Summaries(store).read(snapshot, HIGHEST_NUMBERS)
    return numbering.advance_state(state, None, CATEGORIES, mode, highest)
