"""Summaries kept by part, and two stores compared by bucket digests."""

from datetime import datetime

import pytest
from compare import plan
from pyspark.sql import functions as F

from ledgerops import queries
from ledgerops.operators import digests, inventory_checks, numbering, receipts, sync
from ledgerops.plans import incremental
from ledgerops.plans.generate import Changes, at
from ledgerops.plans.incremental import CUSTOMER_DEBT, HIGHEST_NUMBERS, LEVEL_TOTALS, Summaries
from ledgerops.plans.store import Store
from ledgerops.plans.synchronise import changes_by_digests

SMALL = "/root/testdata/sf0.001"
RUN_AT = datetime(2026, 1, 1)
SUMMED = {"led_inventory_item_ledger": LEVEL_TOTALS, "refno_management": HIGHEST_NUMBERS, "led_account_object_closing": CUSTOMER_DEBT}


@pytest.fixture(scope="module")
def tables(spark):
    return queries.derived_tables(spark, SMALL)


def same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def slice_of(frame, number):
    return frame.where(F.pmod(F.xxhash64(*[c for c, k in frame.dtypes if k == "string"][:3]), F.lit(4)) == number)


def test_three_appends_equal_a_full_run_and_read_new_parts_only(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    snapshot = store.create({name: slice_of(tables[name], 0) for name in SUMMED})
    for number in range(4):
        if number:
            snapshot = store.commit(snapshot, Changes({name: slice_of(tables[name], number) for name in SUMMED}, {}))
        kept = Summaries(store)
        for name, summary in SUMMED.items():
            new = kept.missing(snapshot, summary)
            assert [part.path for part in new] == [snapshot.parts[name][-1].path]  # one part, the last
            got = kept.read(snapshot, summary)
            same(got, summary.make(snapshot[name]))
            assert kept.missing(snapshot, summary) == []
            # what is read again are pieces, no part of the table
            assert not any(f"/data/{part.path.split('/data/')[1]}" in f for part in snapshot.parts[name] for f in got.inputFiles())
    all_tables = {**tables, **snapshot}
    same(incremental.level_findings(store, snapshot, all_tables), inventory_checks.level_findings(tables))
    for mode in (numbering.AS_WRITTEN, numbering.INTENDED):
        same(
            incremental.number_state(store, snapshot, tables["refno_state"], mode),
            numbering.advance_state(tables["refno_state"], tables["refno_management"], incremental.CATEGORIES, mode),
        )
    same(Summaries(store).read(snapshot, CUSTOMER_DEBT), receipts.customer_debt(tables["led_account_object_closing"]))


def test_stores_that_agree_shuffle_nothing(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    odd = spark.createDataFrame([(None, 1), (None, None), ("x", None), ("x", None)], "k string, v long")
    rows = rows.unionByName(odd)
    make = lambda frame: digests.digests(frame, "k", "v")
    assert digests.differing(make(rows), make(rows.orderBy(F.rand(1)))).isEmpty()
    for changed in (
        rows.where("k != '17' or k is null"), rows.union(odd.limit(1)), rows.withColumn("v", F.when(F.col("k") == "9", 100).otherwise(F.col("v"))),
        rows.withColumn("v", F.when(F.col("k") == "x", 0).otherwise(F.col("v"))),
    ):
        found = digests.differing(make(rows), make(changed))
        assert found.count() == 1
        near = digests.inside(rows, "k", found)
        assert 0 < near.count() < 20


def test_changes_by_digests_equal_the_plain_ones(spark, tables):
    want = {
        "missing_orders": sync.missing_orders(tables, at(RUN_AT)),
        "missing_order_lines": sync.missing_order_lines(tables, at(RUN_AT)),
        "changed_orders": sync.changed_orders(tables),
    }
    for name, frame in changes_by_digests(tables, RUN_AT).items():
        assert not frame.isEmpty()
        same(frame, want[name])


def test_only_differing_buckets_reach_the_join(spark, tables):
    stored = tables["sa_order"].select("order_id", "ref_no", "order_status")
    one = stored.withColumn("order_status", F.when(F.col("order_id") == stored.first().order_id, -1).otherwise(F.col("order_status")))
    t = {**tables, "general_order": one}
    found = changes_by_digests(t, RUN_AT)
    assert found["changed_orders"].count() == 1 and found["missing_orders"].isEmpty()
    text = plan(found["changed_orders"])
    assert text.count("LeftSemi") == 2  # both sides are narrowed before they meet
