"""Whole jobs: written tables, reruns, usage counters and synchronisation."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerops import queries
from ledgerops.functions import codes
from ledgerops.functions.columns import MissingColumns, add_missing
from ledgerops.operators import sync, usage
from ledgerops.plans.apply import PublishedTables, next_version, published, write_changes
from ledgerops.plans.generate import at, generate_vouchers
from ledgerops.plans.synchronise import synchronise
from ledgerops.sources.schemas import SCHEMAS

SMALL = "/root/testdata/sf0.001"
RUN_AT = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    return queries.derived_tables(spark, SMALL)


@pytest.fixture(scope="module")
def runs(tables):
    return {mode: generate_vouchers(tables, RUN_AT, None, mode) for mode in ("as_written", "intended")}


@pytest.fixture(scope="module")
def batch(tables):
    return generate_vouchers(tables, RUN_AT, 100)


@pytest.mark.parametrize("mode", ["as_written", "intended"])
def test_second_run_generates_nothing(spark, tables, runs, mode):
    first = runs[mode]
    after = dict(tables)
    for name in (*first.added, *first.replaced):
        # this test data has no table of receipt lines to begin with
        current = tables[name] if name in tables else None
        after[name] = first.added[name] if current is None else next_version(current, first, name)
    second = generate_vouchers(after, RUN_AT, None, mode)
    assert second.targets.count() == 0
    assert all(frame.isEmpty() for frame in second.added.values())


def test_a_batch_takes_the_oldest_orders_in_one_draw(spark, runs, batch):
    whole, capped = runs["as_written"], batch
    assert capped.added["outward"].count() == capped.targets.count() == 100
    drawn = {r.order_id for r in capped.targets.select("order_id").collect()}
    paid = {r.order_id for r in capped.added["ca_receipt_detail"].select("order_id").collect()}
    assert paid <= drawn
    oldest = sorted((r.ref_date, r.order_id) for r in whole.targets.collect())[:100]
    assert drawn == {order for _, order in oldest}


def test_vouchers_are_consistent(spark, runs):
    run = runs["intended"]
    registry = run.added["refno_management"]
    assert registry.groupBy("branch_id", "reftype_category", "refno").count().where("count > 1").isEmpty()
    for head, line, money in (("outward", "outward_detail", "amount"), ("ca_receipt", "ca_receipt_detail", "amount")):
        sums = run.added[line].groupBy("ref_id").agg(F.sum(money).alias("lines"))
        wrong = run.added[head].join(sums, "ref_id", "left").where(
            F.coalesce("lines", F.lit(0)) != F.col("total_amount")
        )
        assert wrong.isEmpty()
    links = run.added["voucher_reference"]
    vouchers = run.added["outward"].select("ref_id").union(run.added["ca_receipt"].select("ref_id"))
    assert links.count() == vouchers.distinct().count() == registry.select("refid").distinct().count()
    left = run.left_over.collect()
    assert {(r.branch_id, r.category_ref_type_id) for r in left} == {("B2", codes.RECEIPT_CATEGORY)}
    assert run.added["ca_receipt"].where("branch_id = 'B2'").isEmpty()
    assert not run.added["outward"].where("branch_id = 'B2'").isEmpty()


def test_rerun_of_the_same_input_gives_the_same_rows(spark, tables, batch):
    one, two = batch, generate_vouchers(tables, RUN_AT, 100)
    for name in one.added:
        assert one.added[name].exceptAll(two.added[name]).isEmpty()
        assert one.added[name].count() == two.added[name].count()


CHANGED = (
    "voucher_reference", "refno_state", "object_reference", "outward", "ca_receipt",
    "refno_management", "outward_detail",
)


@pytest.fixture(scope="module")
def before(tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("before")
    for name in CHANGED:
        tables[name].write.parquet(f"{folder}/{name}")
    return {name: [f"{folder}/{name}"] for name in CHANGED}


def test_written_tables_after_a_run(spark, tables, batch, before, tmp_path):
    paths = write_changes(spark, batch, before, str(tmp_path / "run"))
    assert published(spark, str(tmp_path / "run")) == paths
    assert paths["refno_state"] == [f"{tmp_path}/run/refno_state/whole"]
    assert paths["outward"] == [*before["outward"], f"{tmp_path}/run/outward/added"]
    after = PublishedTables(spark, paths)
    for name, frame in batch.added.items():
        old = tables[name].count() if name in tables else 0
        assert after[name].count() == old + frame.count()
    assert after["voucher_reference"].where("ref_type1 = 2900 and modified_by is not null").count() == 100
    held = PublishedTables(spark, before)
    assert all(held[name].count() == tables[name].count() for name in CHANGED)


def test_a_run_that_fails_midway_changes_nothing_and_can_be_done_again(spark, tables, batch, before, tmp_path):
    broken = batch.added["voucher_reference"].withColumn("ref_id1", F.raise_error(F.lit("lost")).cast("string"))
    failing = replace(batch, added=batch.added | {"voucher_reference": broken})
    with pytest.raises(Exception, match="lost"):
        write_changes(spark, failing, before, str(tmp_path / "first"))
    assert (tmp_path / "first" / "outward" / "added" / "_SUCCESS").exists()
    assert published(spark, str(tmp_path / "first")) is None
    held = PublishedTables(spark, before)
    again = generate_vouchers({**tables, **held}, RUN_AT, 100)
    after = PublishedTables(spark, write_changes(spark, again, before, str(tmp_path / "second")))
    for name in CHANGED:
        expected = next_version(held[name], batch, name).select(*after[name].columns)
        assert after[name].exceptAll(expected).isEmpty() and expected.exceptAll(after[name]).isEmpty()


USE = "primary_object_type int, primary_object_id string, reference_object_type int, used_count decimal(21,6)"


@pytest.mark.parametrize(("mode", "fresh"), [("as_written", 6), ("intended", 3)])
def test_usage_counts_known_and_new_keys(spark, mode, fresh):
    stored = add_missing(
        spark.createDataFrame([(115, "C1", 1012, Decimal(4)), (115, "C2", 1012, Decimal(1))], USE),
        SCHEMAS["object_reference"],
    )
    counts = spark.createDataFrame([(115, "C1", 1012, Decimal(2)), (2, "C1", 1012, Decimal(3))], USE)
    after = {
        (r.primary_object_type, r.primary_object_id): r
        for r in usage.add_usage(stored, counts, at(RUN_AT), mode).collect()
    }
    assert {key: r.used_count for key, r in after.items()} == {
        (115, "C1"): 6, (115, "C2"): 1, (2, "C1"): fresh,
    }
    assert after[115, "C2"].modified_date is None and after[115, "C1"].modified_date == RUN_AT
    assert after[2, "C1"].created_date == RUN_AT and len(after[2, "C1"].object_reference_id) == 36


def test_usage_counts_skip_nulls_and_keep_empty_text(spark):
    frame = spark.createDataFrame([("a", None), ("a", ""), (None, "")], "x string, y string")
    got = usage.usage_counts(frame, {1: "x", 2: "y"}, F.lit(9)).collect()
    assert {(r[0], r[1], r[2], int(r[3])) for r in got} == {(1, "a", 9, 2), (2, "", 9, 2)}


def order_tables(spark, stored):
    orders = spark.createDataFrame(
        [("O1", "N1", 80), ("O2", None, 80), ("O3", "N3", None), ("O4", "N4", 90)],
        "order_id string, ref_no string, order_status int",
    )
    text = ["stock_id", "stock_name"]
    source = {**dict.fromkeys(sync.UPDATED.values(), "string"), **dict.fromkeys(text, "string")}
    return {
        "sa_order": add_missing(orders, source),
        "general_order": spark.createDataFrame(
            stored, "order_id string, ref_no string, order_status int"
        ),
    }


def test_a_null_is_no_change(spark):
    t = order_tables(
        spark,
        [("O1", "OLD", 80), ("O2", "OLD", 80), ("O3", "N3", 5), ("O4", "N4", None), ("O9", "x", 1)],
    )
    assert [r.order_id for r in sync.changed_orders(t).collect()] == ["O1"]
    t["general_order"] = t["general_order"].where("order_id <> 'O9'").union(
        spark.createDataFrame([("O2", None, 10)], t["general_order"].schema)
    )
    changed = sync.changed_orders(t).collect()
    assert sorted((r.order_id, r.ref_no, r.order_status) for r in changed) == [
        ("O1", "N1", 80), ("O2", None, 80),
    ]


def test_a_stored_line_without_order_id_counts_as_missing(spark):
    t = order_tables(spark, [("O1", "N1", 80)])
    lines = spark.createDataFrame(
        [(o, d) for o, d in (("O1", "a"), ("O1", "b"), ("O1", "c"), ("O7", "d"), ("O1", "e"))],
        "order_id string, order_detail_id string",
    )
    t["sa_order_detail"] = add_missing(lines, {**dict.fromkeys(sync.line_columns(), "string"), "allocation_used_point": "decimal(21,6)"})
    t["general_order_detail"] = spark.createDataFrame(
        [("O1", "a"), (None, "b"), (None, "c"), (None, "c"), ("O1", "c"), (None, None)],
        "order_id string, order_detail_id string",
    )
    made = sync.missing_order_lines(t, at(RUN_AT))
    assert list(made.columns) == list(sync.GENERAL_ORDER_DETAIL)
    rows = made.collect()
    assert sorted(r.order_detail_id for r in rows) == ["b", "c", "c", "e"]
    assert {(r.stock_id, r.stock_name, r.allocation_used_point) for r in rows} == {
        ("00000000-0000-0000-0000-000000000000", "", 0)
    }


def test_synchronised_twice_changes_nothing_more(spark, tables):
    first = synchronise(tables, RUN_AT)
    after = dict(tables)
    for name in (*first.added, *first.replaced):
        after[name] = next_version(tables[name], first, name)
    assert sync.missing_orders(after, at(RUN_AT)).isEmpty()
    assert sync.missing_order_lines(after, at(RUN_AT)).isEmpty()
    assert sync.issues_to_delete(after).isEmpty() and sync.links_to_delete(after).isEmpty()
    left = sync.changed_orders(after)
    assert left.isEmpty()
    cancelled = tables["sa_order"].where("order_status = 90").select("order_id")
    assert (
        after["voucher_reference"]
        .join(cancelled, F.col("ref_id2") == F.col("order_id"), "left_semi")
        .isEmpty()
    )


def test_every_required_column_is_missed(spark, tables):
    """Each column by itself; an optional one may lack and is null then."""
    for name, columns in sync.contracts().items():
        for column in sorted(columns):
            with pytest.raises(MissingColumns, match=f"{name}: {column}$"):
                synchronise({**tables, name: tables[name].drop(column)}, RUN_AT)
    for column in sorted(sync.order_columns()):
        with pytest.raises(MissingColumns, match=f"sa_order: {column}$"):
            sync.missing_orders({**tables, "sa_order": tables["sa_order"].drop(column)}, at(RUN_AT))
    for column in sorted(sync.line_columns()):
        with pytest.raises(MissingColumns, match=f"sa_order_detail: {column}$"):
            sync.missing_order_lines({**tables, "sa_order_detail": tables["sa_order_detail"].drop(column)}, at(RUN_AT))
    fewer = {
        **tables,
        "sa_order": tables["sa_order"].drop(*sync.ORDER_OPTIONAL),
        "sa_order_detail": tables["sa_order_detail"].drop(*sync.LINE_OPTIONAL),
    }
    made = sync.missing_orders(fewer, at(RUN_AT))
    assert made.columns == list(sync.GENERAL_ORDER) and made.where("is_sign is not null or partner_object_id is not null").isEmpty()
    assert sync.missing_order_lines(fewer, at(RUN_AT)).where("is_drug is not null").isEmpty()
    assert made.count() == sync.missing_orders(tables, at(RUN_AT)).count()


def test_figures_are_counted_by_the_passes_that_write(spark, tables, tmp_path):
    """Numbers that outgrow their length, saturated amounts and units with several rates."""
    run = generate_vouchers(tables, RUN_AT, 300)
    base = {"outward": [], "ca_receipt": []}
    kept = {name: run.added[name] for name in base}
    write_changes(spark, replace(run, added=kept, replaced={}), {}, str(tmp_path / "run"))
    figures = run.figures.read()
    assert figures["rate_conflicts"] == tables["unit_convert"].groupBy("inventory_item_id", "unit_id").count().where("count > 1").count() > 0
    assert figures["issue_numbers"] == run.targets.count() == 300
    written = spark.read.parquet(str(tmp_path / "run/outward/added"))
    cut = written.where("branch_id = 'B1'").count()
    assert 0 < cut - 10 <= figures["issue_numbers_too_long"] <= cut
    assert figures["receipt_numbers"] == run.added["ca_receipt"].count() and figures["receipt_numbers_too_long"] > 0
    lines = run.added["outward_detail"]
    assert figures["saturated_lines"] == lines.where(f"unit_price >= {10**15 - 1} or amount >= {10**15 - 1}").count()
    assert 0 <= figures["priced_lines"] <= lines.count()
