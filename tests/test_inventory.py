"""Edge cases of the stock checks on literal rows."""

import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledgerops.functions import columns
from ledgerops.operators import inventory_checks as inv

AT = datetime(2024, 5, 1, 9)
HEAD = "ref_id string, ref_type int, ref_date timestamp_ntz, branch_id string"
LEDGER = (
    "inventory_item_ledger_id string, ref_id string, ref_detail_id string, ref_type int,"
    " ref_date timestamp_ntz, branch_id string, stock_id string, inventory_item_id string,"
    " lot_no string, expired_date date, main_inward_quantity decimal(21,6),"
    " main_outward_quantity decimal(21,6), inward_amount decimal(21,6),"
    " outward_amount decimal(21,6), stock_location_id string"
)


def ledger_row(ref, detail, kind, stock, lot=None, expiry=None, qin=1, qout=0, item="I1", place=None):
    def money(value):
        return None if value is None else Decimal(value)

    return (
        "G", ref, detail, kind, AT, "B1", stock, item, lot, expiry,
        money(qin), money(qout), money(qin), money(qout), place,
    )


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def test_a_missing_lot_equals_an_empty_one_and_no_expiry_equals_1900(spark):
    t = {
        "opening_inventory_entry": spark.createDataFrame(
            [
                ("A", 600, AT, "B1", "S1", "I1", None, None),
                ("B", 600, AT, "B1", "S1", "I1", "", date(1900, 1, 1)),
                ("C", 600, AT, "B1", "S1", "I1", "L", None),
                ("D", 600, AT, None, "S1", "I1", None, None),
            ],
            HEAD + ", stock_id string, inventory_item_id string, lot_no string, expired_date date",
        ),
        "led_inventory_item_ledger": ledger(
            spark,
            ledger_row("A", None, 600, "S1", "", date(1900, 1, 1)),
            ledger_row("B", None, 600, "S1"),
            ledger_row("C", None, 600, "S1"),
            ledger_row("D", None, 600, "S1"),
        ),
    }
    found = inv.opening_not_in_ledger(t).collect()
    assert sorted(r.ref_id for r in found) == ["C", "D"]


def transfers(spark, rows, posted):
    return {
        "transfer_stock": spark.createDataFrame(
            [(ref, kind, AT, "B1") for ref, kind in dict(rows).items()], HEAD
        ),
        "transfer_stock_detail": spark.createDataFrame(
            [(ref, "D" + ref, "I1", None, None, "S1", "S2") for ref in dict(rows)],
            "ref_id string, ref_detail_id string, inventory_item_id string, lot_no string,"
            " expired_date date, from_stock_id string, to_stock_id string",
        ),
        "led_inventory_item_ledger": ledger(spark, *posted),
    }


def test_transfer_sides_and_repeats(spark):
    rows = [("A", 2909), ("B", 2910), ("C", 2909), ("D", 2908), ("E", 2909), ("F", 2909)]
    posted = [
        # A: both sides; B: neither; C: only the in side, three times; D: no two-way type
        ledger_row("A", "DA", 2909, "S1", qin=0, qout=1), ledger_row("A", "DA", 2909, "S2"),
        *[ledger_row("C", "DC", 2909, "S2")] * 3,
        # E: only the out side; F: both, but without any positive quantity
        ledger_row("E", "DE", 2909, "S1", qin=0, qout=1),
        ledger_row("F", "DF", 2909, "S1", qin=None, qout=None),
        ledger_row("F", "DF", 2909, "S2", qin=0, qout=0),
    ]
    t = transfers(spark, rows, posted)
    either = Counter((r.ref_id, r.stock_id, r.note) for r in inv.transfer_either_not_in_ledger(t).collect())
    assert either == {
        ("B", "S1", inv.BOTH_SIDES_NOTE): 1,
        ("C", "S1", inv.OUT_SIDE_NOTE): 3,
        ("E", "S2", inv.IN_SIDE_NOTE): 1,
    }
    assert sorted(r.ref_id for r in inv.transfer_out_not_in_ledger(t).collect()) == list("BCDF")
    assert sorted(r.ref_id for r in inv.transfer_in_not_in_ledger(t).collect()) == list("BDEF")
    apart = [
        inv.transfer_out_not_in_ledger, inv.transfer_in_not_in_ledger,
        inv.transfer_either_not_in_ledger,
    ]
    united = Counter(tuple(r) for r in inv._transfer_findings(t).collect())
    assert united == Counter(tuple(r) for check in apart for r in check(t).collect())


@pytest.mark.parametrize("step", [1, 3, 10_000])
def test_repeat_rows(spark, monkeypatch, step):
    monkeypatch.setattr(columns, "REPEAT_STEP", step)
    frame = spark.createDataFrame([("a", 1), ("b", 7), ("c", 6)], "k string, n int")
    got = Counter(r.k for r in columns.repeat_rows(frame, frame["n"]).collect())
    assert got == {"a": 1, "b": 7, "c": 6}


CLOSING = (
    "inventory_item_closing_id string, inventory_item_id string, stock_id string,"
    " quantity decimal(38,6), amount decimal(38,6), order_quantity decimal(21,6)"
)


def test_closing_stock_absent_or_different(spark):
    t = {
        "led_inventory_item_ledger": ledger(
            spark,
            ledger_row("1", "1", 1, "S1", item="zero", qin=2),
            ledger_row("2", "2", 1, "S1", item="zero", qin=0, qout=2),
            ledger_row("3", "3", 1, "S1", item="some", qin=2),
            ledger_row("4", "4", 1, "S1", item="equal", qin=2),
            ledger_row("5", "5", 1, "S1", item="worth", qin=2),
            ledger_row("6", "6", 1, "S1", item="unknown", qin=None),
            ledger_row("7", "7", 1, None, item="equal", qin=2),
        ),
        "led_inventory_item_closing": spark.createDataFrame(
            [
                ("c", "equal", "S1", Decimal(2), Decimal(2), None),
                ("c", "worth", "S1", Decimal(2), Decimal(3), None),
                ("c", "unknown", "S1", None, None, None),
                ("c", "stored only", "S1", Decimal(9), Decimal(9), None),
            ],
            CLOSING,
        ),
    }
    found = {(r.inventory_item_id, r.stock_id): r for r in inv.ledger_vs_closing(t).collect()}
    assert set(found) == {("some", "S1"), ("worth", "S1"), ("equal", None)}
    assert found["some", "S1"].ledger_value == "SL lũy kế theo sổ NK=2.000000"
    assert found["some", "S1"].compare_value == "SL sổ tồn cuối=0.000000"


def test_daily_balance_ignores_sums_without_any_value(spark):
    t = {
        "led_inventory_item_ledger": ledger(
            spark,
            ledger_row("1", "1", 1, "S1", item="known", qin=None, qout=None),
            ledger_row("2", "2", 1, "S1", item="absent", qin=None, qout=None),
        ),
        "led_inventory_item_balance": spark.createDataFrame(
            [("b", "known", "B1", "S1", AT.date(), *[Decimal(5)] * 4)],
            "inventory_item_balance_id string, inventory_item_id string, branch_id string,"
            " stock_id string, ref_date date, inward_quantity decimal(38,6),"
            " inward_amount decimal(38,6), outward_quantity decimal(38,6),"
            " outward_amount decimal(38,6)",
        ),
    }
    found = inv.ledger_vs_balance(t).collect()
    assert [(r.inventory_item_id, r.ledger_value, r.branch_id) for r in found] == [
        ("absent", None, None)
    ]


def test_open_orders_exclude_both_bounds(spark):
    t = {
        "sa_order": spark.createDataFrame(
            [(f"O{s}", s, AT) for s in (5, 6, 49, 50)],
            "order_id string, order_status int, order_date timestamp_ntz",
        ),
        "sa_order_detail": spark.createDataFrame(
            [(f"O{s}", f"D{s}", "I1", 1) for s in (5, 6, 49, 50)] + [("O6", "service", "I2", 2)],
            "order_id string, order_detail_id string, inventory_item_id string,"
            " inventory_item_type int",
        ),
        "led_order_item_ledger": spark.createDataFrame(
            [("O49", "other")], "order_id string, order_detail_id string"
        ),
    }
    found = inv.order_not_in_ledger(t).collect()
    assert sorted(r.ref_detail_id for r in found) == ["D49", "D6"]


def test_number_text_is_plain_without_ansi(spark):
    frame = spark.createDataFrame([(Decimal(0),), (Decimal("0.0000001"),), (Decimal("12.5"),)], "n decimal(21,7)")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        got = [r[0] for r in frame.select(columns.number_text(frame.n)).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert got == ["0.000000", "0.000000", "12.500000"]


def test_checks_take_only_the_columns_they_name(spark):
    """A clashing column in the opening or detail tables changes nothing."""
    from ledgerops import queries

    tables = queries.derived_tables(spark, "/root/testdata/sf0.001")
    wide = {
        "opening_inventory_entry": ["ref_detail_id"],
        "inward_detail": ["branch_id", "ref_type", "ref_date"],
        "outward_detail": ["branch_id", "ref_type", "ref_date"],
    }
    other = {name: tables[name] for name in (*wide, "inward", "outward", "led_inventory_item_ledger")}
    for name, columns in wide.items():
        for column in columns:
            other[name] = other[name].withColumn(column, F.lit(None).cast("string"))
    for check in ("INV1", "INV2", "INV3"):
        want = inv.CHECKS[check](tables)
        assert inv.CHECKS[check](other).exceptAll(want).isEmpty()


def test_levels_together_equal_levels_apart(spark, small):
    """With lots, expiries and locations missing, equal keys twice and null measures."""
    apart = None
    for level in inv.LEVELS:
        found = inv.compare_level(small, level).select(*inv.FINDING)
        apart = found if apart is None else apart.unionByName(found)
    together = inv.level_findings(small)
    assert together.columns == apart.columns and not apart.isEmpty()
    assert together.exceptAll(apart).isEmpty() and apart.exceptAll(together).isEmpty()


@pytest.fixture(scope="module")
def small(spark):
    draw = random.Random(5)
    maybe = lambda *values: draw.choice([None, *values])
    day = lambda: datetime(2024, 1, draw.randint(1, 3), draw.randint(0, 23))
    expiry = lambda: maybe(date(1900, 1, 1), date(2025, 5, 5))
    number = lambda: maybe(Decimal(0), Decimal(1), Decimal("2.5"))
    keys = lambda: (maybe("I1", "I2", "I1"), maybe("B1", "B1"), draw.choice(["S1", "S2"]), maybe("", "L1"), expiry(), maybe("P1"))
    key = "inventory_item_id string, branch_id string, stock_id string, lot_no string, expired_date date, stock_location_id string, "
    daily = "inward_quantity {0}, inward_amount {0}, outward_quantity {0}, outward_amount {0}".format("decimal(21,6)")
    ledger = [(*keys(), day(), number(), number(), number(), number()) for _ in range(400)]
    t = {
        "led_inventory_item_ledger": spark.createDataFrame(
            ledger, key + "ref_date timestamp_ntz, " + daily.replace("inward_quantity", "main_inward_quantity", 1).replace("outward_quantity", "main_outward_quantity")
        )
    }
    for level in inv.LEVELS:
        if level.daily:
            rows = [(str(i), *keys(), day(), number(), number(), number(), number()) for i in range(60)]
            schema = f"{level.row_id} string, {key} ref_date timestamp_ntz, {daily}"
        else:
            rows = [(str(i), *keys(), number(), number()) for i in range(25)]
            schema = f"{level.row_id} string, {key} quantity decimal(21,6), amount decimal(21,6)"
        t[level.table] = spark.createDataFrame(rows, schema)
    return t
