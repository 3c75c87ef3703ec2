"""Where the jobs get their input tables: a mapping from name to DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerops.functions.columns import add_missing
from ledgerops.session import Dealt, keep, keep_in_place
from ledgerops.sources.derived import DERIVED, SOURCE_TABLES, depends_on, expression_of
from ledgerops.sources.schemas import SCHEMAS

# Definitions that group or unite large tables are written once; all others are read
# through to what they come from, so that a job pays only for the columns it uses.
WRITTEN = (
    "li", "opening_inventory_entry", "inward", "outward", "transfer_stock", "led_inventory_item_ledger",
    "led_inventory_item_balance", "led_inventory_item_balance_lot",
    "led_inventory_item_balance_stock_location", "led_inventory_item_closing",
    "led_inventory_item_closing_lot", "ledger_by_item",
)
LEDGER = "led_inventory_item_ledger"
# what the ledger's sums, which all group by item, read of it
SUMMED = (
    "inventory_item_ledger_id", "inventory_item_id", "branch_id", "stock_id", "lot_no", "expired_date",
    "stock_location_id", "ref_date", "main_inward_quantity", "main_outward_quantity", "inward_amount",
    "outward_amount",
)
HEADERS = ("inward", "outward", "transfer_stock")


LINES_PER_BUCKET = 250_000
LINES_PER_SLICE = 75_000_000  # of the ledger, that are dealt by item at once
# a header and its lines: equal ids are equal order keys, by which the lines are dealt
SAME_DOCUMENT, SAME_KEY = "x.ref_id=h.ref_id", "x._key=h._key"
# the same for an order, its lines and their ledger; where each has the order's key
SAME_ORDER, SAME_ORDER_KEY = "o.order_id=x.order_id", "o._key=x._key"
ORDER_KEYS = {"sa_order": "o_orderkey", "sa_order_detail": "l_orderkey", "led_order_item_ledger": "x._key"}


class ParquetTables(Mapping[str, DataFrame]):
    """One Parquet folder or file per table under `folder`, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str, names: tuple[str, ...], suffix: str = ""):
        self.spark, self.folder, self.names, self.suffix = spark, folder, names, suffix

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}{self.suffix}")
        return add_missing(wall_clock(frame), SCHEMAS.get(name, {}))

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


class DerivedTables(Mapping[str, DataFrame]):
    """The retail tables derived from the TPC-H-like files in `folder`.

    Those in WRITTEN are written once to the shared folder, so that a job reads them as
    it would read a user's stored table; the others are views. The definitions say what
    rows a table has; `li` and the ledger get theirs from lines dealt by order."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.source = ParquetTables(spark, folder.rstrip("/"), SOURCE_TABLES, ".parquet")
        self.frames: dict[str, DataFrame] = {}
        self.buckets: int | None = None  # that the lines are dealt to
        self.kept: dict[str, DataFrame] = {}  # headers with their order's key, the ledger by item

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.source.names:
            return self.source[name]
        if name not in DERIVED:
            raise KeyError(name)
        if name not in self.frames:
            self.frames[name] = add_missing(self._made(name), SCHEMAS.get(name, {}))
        return self.frames[name]

    def _made(self, name: str) -> DataFrame:
        if name == "li":
            return self._lines()
        if name == LEDGER:
            return keep(self._ledger(name), name)
        if name in HEADERS:
            return self._header(name).drop("_key")
        if name == "led_order_item_ledger":
            return self.by_order(name).drop("_key")
        frame = self._view(DERIVED[name], {other: self[other] for other in depends_on(name)})
        return keep(frame, name) if name in WRITTEN else frame

    def _view(self, text: str, inputs: Mapping[str, DataFrame]) -> DataFrame:
        return wall_clock(self.spark.sql(text, **inputs))

    def _dealt(self) -> DataFrame:
        """The stored lines dealt by order, so that an order's lines meet in one task."""
        lines = self.source["lineitem"]
        if self.buckets is None:
            self.buckets = max(1, math.ceil(lines.count() / LINES_PER_BUCKET))
        return lines.repartition(self.buckets, "l_orderkey")

    def _lines(self) -> DataFrame:
        dealt = self._dealt()
        lines = self._view(DERIVED["li"], {"lineitem": dealt})
        return keep(Dealt(lines, "l_orderkey", self.buckets), "li")

    def _ledger(self, name: str) -> DataFrame:
        """The ledger from headers and lines that both lie by their order's key: the lines,
        which come from all of `li` and for transfers twice, are not moved."""
        inputs = {}
        for other in depends_on(name):
            below = depends_on(other)[0]
            if below not in ("lineitem", "li"):
                inputs[other] = self[other]
                continue
            inputs[other] = self._header(other) if other in HEADERS else self._keyed(other, self[below])
        return self._view(DERIVED[name].replace(SAME_DOCUMENT, SAME_KEY), inputs)

    def _keyed(self, name: str, lines: DataFrame) -> DataFrame:
        """A table of documents or their lines with the order's key as `_key`."""
        text = DERIVED[name].replace("select", "select l_orderkey as _key,", 1)
        return self._view(text, {depends_on(name)[0]: lines})

    def _header(self, name: str) -> DataFrame:
        if name not in self.kept:
            headers = self._keyed(name, self._dealt())
            self.kept[name] = keep(Dealt(headers, "_key", self.buckets), name)
        return self.kept[name]

    def summed_together(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Sums of the ledger as views of one copy of it, which lies by item; those that are
        written already are read. By itself a sum is written from the ledger: that moves less."""
        made = {name: self._view(DERIVED[name], {LEDGER: self._ledger_by_item()}) for name in names if name not in self.frames}
        return {name: add_missing(made[name], SCHEMAS.get(name, {})) if name in made else self[name] for name in names}

    def _ledger_by_item(self) -> DataFrame:
        name = "ledger_by_item"
        if name not in self.kept:
            ledger = self[LEDGER].select(*SUMMED)
            rows = ledger.count()
            buckets, slices = (max(1, math.ceil(rows / most)) for most in (LINES_PER_BUCKET, LINES_PER_SLICE))
            dealt = ledger.repartition(buckets, "inventory_item_id")
            self.kept[name] = keep(Dealt(dealt, "inventory_item_id", buckets, slices), name)
        return self.kept[name]

    def by_order(self, name: str) -> DataFrame:
        """A table of orders, of their lines or of these lines' ledger, with the order's key
        as `_key`. Lines and ledger lie by it: an order goes to its lines, which stay."""
        text = DERIVED[name].replace("select", f"select {ORDER_KEYS[name]} as _key,", 1).replace(SAME_ORDER, SAME_ORDER_KEY)
        return self._view(text, {o: self.by_order(o) if o in ORDER_KEYS else self[o] for o in depends_on(name)})

    def through(self, name: str, keys: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """`through` for a view: the step is taken below it, on the rows that it reads first."""
        if name not in DERIVED or name in WRITTEN:
            return step(self[name])
        first, *others = depends_on(name)
        below = self[first].withColumns({key: F.expr(expression_of(name, key)) for key in keys})
        stepped = step(below)
        added = [column for column in stepped.columns if column not in below.columns]
        text = DERIVED[name].replace("select", f"select {''.join(f'{column}, ' for column in added)}", 1)
        frame = self.spark.sql(text, **{first: stepped}, **{other: self[other] for other in others})
        return add_missing(wall_clock(frame), SCHEMAS.get(name, {}))

    def __iter__(self) -> Iterator[str]:
        return iter(DERIVED)

    def __len__(self) -> int:
        return len(DERIVED)


def through(
    t: Mapping[str, DataFrame], name: str, keys: list[str], step: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A table after a step that drops rows, repeats them or adds columns, and that reads
    only the columns `keys` of it. Where the table is a view with many columns, the step
    moves the few that the view is made from; a stored table takes the step as it is."""
    return t.through(name, keys, step) if isinstance(t, DerivedTables) else step(t[name])


def by_order(t: Mapping[str, DataFrame], name: str) -> DataFrame:
    """A table with the column `_key`, equal where order ids are, for joins by order. Rows
    that lie by order in storage lie by `_key`; else it is the order id."""
    return t.by_order(name) if isinstance(t, DerivedTables) else t[name].withColumn("_key", F.col("order_id"))


def summed_together(t: Mapping[str, DataFrame], names: Iterable[str]) -> dict[str, DataFrame]:
    """Several tables that are sums of the ledger, for one job that reads all of them: as they
    are stored, or where they have to be made first, made together."""
    return t.summed_together(names) if isinstance(t, DerivedTables) else {name: t[name] for name in names}


def where_they_lie(t: Mapping[str, DataFrame], joined: DataFrame, name: str) -> DataFrame:
    """A join of tables from `by_order` by `_key` and more. Where they lie by `_key`, it is
    made there and what it leaves is written; else it is taken as it is."""
    return keep_in_place(joined, name) if isinstance(t, DerivedTables) else joined


def wall_clock(frame: DataFrame) -> DataFrame:
    """Times without a zone, which the jobs and their outputs use throughout."""
    zoned = {name for name, kind in frame.dtypes if kind == "timestamp"}
    if not zoned:
        return frame
    return frame.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if name in zoned else F.col(name)
            for name in frame.columns
        ]
    )
