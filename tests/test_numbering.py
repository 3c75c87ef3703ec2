"""Sequence numbers, voucher numbers and the number state on small tables."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerops.functions import codes
from ledgerops.operators import numbering, receipts
from ledgerops.sources.schemas import SCHEMAS
from ledgerops.functions.columns import add_missing

STATE = (
    "branch_id string, category_ref_type_id int, prefix string, length_of_value int, value bigint"
)


def states(spark, *rows):
    return add_missing(spark.createDataFrame(rows, STATE), SCHEMAS["refno_state"])


def options(spark, *rows):
    return spark.createDataFrame(
        [(*row,) for row in rows], "branch_id string, option_id string, option_value string"
    )


def test_number_rows_equals_sorting_with_a_hot_branch_and_null_keys(spark):
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        branch = "B0" if rng.random() < 0.6 else rng.choice(["B1", "B2", None])
        day = None if rng.random() < 0.05 else rng.choice(["2024-01-01", "2024-01-02"])
        rows.append((branch, day, f"O{i:05d}"))
    frame = spark.createDataFrame(rows, "branch_id string, ref_date string, order_id string")
    order = ["branch_id", "ref_date", "order_id"]
    # without coalescing, every one of the 8 ranges stays a partition of its own
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(frame.repartition(5), order, "test")
        got = {r.order_id: r.row_num for r in numbered.collect()}
        in_branch = {r.order_id: r.row_num for r in numbering.number_in_branch(numbered).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    def key(row):
        return tuple((v is not None, v or "") for v in row)
    ordered = sorted(rows, key=key)
    assert got == {row[2]: i + 1 for i, row in enumerate(ordered)}
    seen, expected = {}, {}
    for row in ordered:
        seen[row[0]] = seen.get(row[0], 0) + 1
        expected[row[2]] = seen[row[0]]
    assert in_branch == expected


def test_number_rows_of_nothing(spark):
    empty = spark.createDataFrame([], "branch_id string, order_id string")
    assert numbering.number_rows(empty, ["branch_id", "order_id"], "empty").count() == 0


@pytest.mark.parametrize(
    ("prefix", "length", "value", "row", "store", "expected"),
    [
        ("PT", 6, 10, 5, None, "PT000015"),
        ("PT", 6, 10, 5, "CH1", "CH1-PT000015"),
        (None, 3, None, 7, None, "007"),
        ("PT", 3, 1230, 4, None, "PT123"),
        ("PT", None, 1, 1, None, None),
    ],
)
def test_voucher_number(spark, prefix, length, value, row, store, expected):
    frame = spark.createDataFrame(
        [(prefix, length, value, row, store)],
        "prefix string, length_of_value int, value bigint, row_num bigint, _store string",
    )
    assert frame.select(numbering.voucher_number().alias("n")).first().n == expected


def vouchers(spark, prefix):
    return spark.createDataFrame(
        [("B1", 2091, prefix, 4, 7, "V1", 2900, "0008")],
        "branch_id string, category_ref_type_id int, prefix string, length_of_value int,"
        " value bigint, ref_id string, ref_type int, ref_no string",
    ).withColumns(
        {
            "use_branch_prefix": F.lit(None).cast("boolean"),
            "branch_prefix": F.lit(None).cast("string"),
            "suffix": F.lit(None).cast("string"),
        }
    )


def test_registry_state_key_with_a_null_prefix(spark):
    now = F.lit("2026-01-01").cast("timestamp_ntz")
    rows = vouchers(spark, None)
    issue = numbering.number_registry(rows, "outward", now).first()
    receipt = numbering.number_registry(rows, "ca_receipt", now).first()
    assert issue.state_key is None
    assert receipt.state_key == "B1|2091||4"
    assert issue.id == receipt.id == "B1|2091|0008"
    assert issue.value == 7
    assert (issue.created_by, issue.modified_by) == (None, codes.EDITOR)
    assert (receipt.created_by, receipt.modified_by) == ("script", None)


def test_highest_number_and_state_modes(spark):
    registry = spark.createDataFrame(
        [
            ("B1", 1010, "PT000012"), ("B1", 1010, "X0000000000000000000000000000099"),
            ("B1", 1010, "PTX"), ("B2", 1010, "PT9"), ("B2", 1010, "PT" + "9" * 25),
            ("B3", 1010, "none"), ("B1", 2091, "XK500"), ("B4", 1010, "000"), ("B5", 1010, None),
        ],
        "branch_id string, reftype_category int, refno string",
    )
    found = {
        (r.branch_id, r.reftype_category): r._highest
        for r in numbering.highest_numbers(registry, (1010, 2091)).collect()
    }
    assert found == {
        ("B1", 1010): Decimal(99),
        ("B2", 1010): Decimal(numbering.LARGEST_NUMBER),
        ("B1", 2091): Decimal(500),
        ("B4", 1010): Decimal(0),
    }
    state = states(
        spark, ("B1", 1010, "PT", 6, 3), ("B3", 1010, "PT", 6, 30), ("B1", 2091, "XK", 6, 4)
    )
    for mode, kept in (("as_written", None), ("intended", Decimal(30))):
        after = {
            (r.branch_id, r.category_ref_type_id): r.value
            for r in numbering.advance_state(state, registry, (1010,), mode).collect()
        }
        assert after == {("B1", 1010): Decimal(99), ("B3", 1010): kept, ("B1", 2091): Decimal(4)}


def test_a_branch_without_state_gets_no_voucher_and_is_counted(spark):
    targets = spark.createDataFrame(
        [("B1", "O1", 1), ("B9", "O2", 2), (None, "O3", 3)],
        "branch_id string, order_id string, row_num bigint",
    )
    state = states(spark, ("B1", codes.ISSUE_CATEGORY, "XK", 4, 0))
    store = options(spark, ("B1", "StoreRefNo", "CH"), ("B1", "Other", "no"))
    kept = numbering.with_number_state(targets, state, store, codes.ISSUE_CATEGORY)
    assert [(r.order_id, r._store) for r in kept.collect()] == [("O1", "CH")]
    both = (codes.RECEIPT_CATEGORY, codes.ISSUE_CATEGORY)
    left = numbering.orders_without_state(targets, state, both)
    issue = {(b, codes.ISSUE_CATEGORY, 1) for b in ("B9", None)}
    receipt = {(b, codes.RECEIPT_CATEGORY, 1) for b in ("B1", "B9", None)}
    assert {tuple(r) for r in left.collect()} == issue | receipt


def test_a_number_beyond_its_length(spark):
    rows = [("B1", 7, None, "PT", 2, n, 0) for n in (98, 99, 100, 101, 1009)]
    vouchers = spark.createDataFrame(
        rows,
        "branch_id string, category_ref_type_id int, _store string, prefix string,"
        " length_of_value int, value bigint, row_num int",
    )
    cut = [r[0] for r in vouchers.select(numbering.voucher_number()).collect()]
    assert cut == ["PT98", "PT99", "PT10", "PT10", "PT10"]
    whole = [r[0] for r in vouchers.select(numbering.voucher_number("intended")).collect()]
    assert whole == ["PT98", "PT99", "PT100", "PT101", "PT1009"]
    assert [tuple(r) for r in numbering.numbers_too_long(vouchers).collect()] == [("B1", 7, 3)]


def test_two_payments_of_one_kind_get_different_numbers_and_ids(spark):
    run = datetime(2026, 1, 1)
    base = {name: None for name in receipts.ORDER_COLUMNS}
    rows = [
        {**base, "order_id": "O1", "branch_id": "B1", "ref_no": "DH1", "payment_id": pay,
         "payment_type": 5, "receipt_ref_type": 1012, "ref_date": run}
        for pay in ("P1", "P2", "P2")
    ]
    schema = ", ".join(
        f"{name} {kind}"
        for name, kind in {
            **{n: "string" for n in receipts.ORDER_COLUMNS},
            "ref_type": "int", "ref_date": "timestamp_ntz", "order_date": "timestamp_ntz",
            "completed_date": "timestamp_ntz", "channel_id": "int", "payment_id": "string",
            "payment_type": "int", "receipt_ref_type": "int", "receipt_amount": "decimal(21,6)",
            "receipt_is_cash_sale": "int", "receipt_remain_amount": "decimal(21,6)",
            "bank_account_id": "string", "account_number": "string",
        }.items()
    )
    frame = spark.createDataFrame(rows, schema)
    numbered = receipts.number_receipts(frame)
    state = states(spark, ("B1", codes.RECEIPT_CATEGORY, "PT", 6, 0))
    made = receipts.receipt_headers(numbered, state, options(spark, ("B2", "x", "y"))).collect()
    assert sorted(r.ref_no for r in made) == ["PT000001", "PT000002", "PT000003"]
    assert len({r.ref_id for r in made}) == 3
    assert all(len(r.ref_id) == 36 and r.description == "Thu tiền bán hàng đơn hàng DH1" for r in made)
    assert all(r.object_type is None and r.cash_type == 1 and r.is_reconciled for r in made)
