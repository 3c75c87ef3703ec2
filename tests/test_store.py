"""Versions of tables: edits of files, conflicts, additions merged on reading, compaction."""

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerops import queries
from ledgerops.functions import codes
from ledgerops.functions.columns import add_missing, without
from ledgerops.operators import usage
from ledgerops.plans import store as plans
from ledgerops.plans.generate import Changes, Edit, at, generate_vouchers
from ledgerops.plans.store import Conflict, Store
from ledgerops.plans.synchronise import synchronise
from ledgerops.sources.schemas import SCHEMAS

SMALL = "/root/testdata/sf0.001"
RUN_AT = datetime(2026, 1, 1)
CHANGED = (
    "voucher_reference", "refno_state", "object_reference", "outward", "ca_receipt",
    "refno_management", "outward_detail", "general_order", "general_order_detail",
)


@pytest.fixture(scope="module")
def tables(spark):
    return queries.derived_tables(spark, SMALL)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def files_of(snapshot, name):
    return {f for part in snapshot.parts[name] for f in plans.files_under(snapshot.spark, part)}


def row_store(spark, folder, rows, files=10):
    """A table of `rows` rows, `files` files, each with a range of ids."""
    frame = spark.range(0, rows, 1, files).select(F.col("id"), F.concat(F.lit("v"), "id").alias("value"))
    store = Store(spark, str(folder))
    return store, store.create({"rows": frame})


def delete(keys):
    return Changes({}, {}, edits={"rows": Edit(
        lambda rows: rows.join(keys, "id", "left_semi"), lambda rows: without(rows, keys, ["id"]),
    )})


def test_a_delete_of_one_percent_rewrites_only_the_files_that_hold_it(spark, tmp_path):
    store, base = row_store(spark, tmp_path, 10_000)
    before = files_of(base, "rows")
    after = store.commit(base, delete(spark.range(4_000, 4_100)))
    kept = files_of(after, "rows")
    assert len(before) == 10 and len(before & kept) == 9
    assert {r.id for r in after["rows"].collect()} == set(range(10_000)) - set(range(4_000, 4_100))
    assert base["rows"].count() == 10_000  # the version before is as it was
    # from a version that lists single files, on, and a delete that finds nothing
    third = store.commit(after, delete(spark.range(0, 5)))
    assert len(files_of(third, "rows") & before) == 8 and third["rows"].count() == 9_895
    fourth = store.commit(third, delete(spark.range(4_000, 4_050)))
    assert fourth.parts == third.parts and store.latest().version == 3


def test_files_are_found_by_the_columns_that_tell(spark, tmp_path):
    store, base = row_store(spark, tmp_path / "with space%20and é", 100)
    after = store.commit(base, delete(spark.range(3)))
    assert after["rows"].count() == 97 and len(files_of(after, "rows") & files_of(base, "rows")) == 9
    touched = delete(spark.range(3)).edits["rows"].touched(base.rows("rows", file=True)).select("_file").distinct()
    scan = next(x for x in touched._jdf.queryExecution().toString().splitlines()[::-1] if "ReadSchema" in x and "value" not in x)
    assert "id:bigint" in scan


def test_a_run_from_an_old_version_fails_and_changes_nothing(spark, tmp_path):
    store, base = row_store(spark, tmp_path, 100)
    first = store.commit(base, delete(spark.range(10)))
    with pytest.raises(Conflict):
        store.commit(base, delete(spark.range(50, 60)))
    assert store.latest().version == 1 and store.latest()["rows"].count() == 90
    assert store.commit(first, delete(spark.range(50, 60)))["rows"].count() == 80
    assert store.version(0)["rows"].count() == 100


def test_two_runs_that_write_at_the_same_time(spark, tmp_path, monkeypatch):
    """Both pass the first look; the rename decides."""
    store, base = row_store(spark, tmp_path, 100)
    monkeypatch.setattr(Store, "_expect_next", lambda self, base: None)
    store.commit(base, delete(spark.range(10)))
    with pytest.raises(Conflict):
        store.commit(base, delete(spark.range(20)))
    assert store.latest()["rows"].count() == 90


def test_a_run_that_fails_midway_publishes_nothing(spark, tmp_path):
    store, base = row_store(spark, tmp_path, 100)
    broken = spark.range(5).withColumn("value", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        store.commit(base, replace(delete(spark.range(10)), added={"rows": broken}))
    assert store.latest().version == 0
    assert store.commit(base, delete(spark.range(10)))["rows"].count() == 90


def test_numbers_stay_unique_when_two_runs_start_from_one_version(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    base = store.create({name: tables[name] for name in CHANGED})
    see = lambda snapshot: {**tables, **snapshot}
    one = generate_vouchers(see(base), RUN_AT, 100, "intended")
    two = generate_vouchers(see(base), RUN_AT, 100, "intended")
    after = store.commit(base, one)
    with pytest.raises(Conflict):
        store.commit(base, two)
    again = generate_vouchers(see(after), RUN_AT, 100, "intended")
    last = store.commit(after, again)
    fresh = last["refno_management"].where("created_date = '2026-01-01'")
    numbers = fresh.groupBy("branch_id", "reftype_category", "refno")
    assert numbers.count().where("count > 1").isEmpty()
    made = last["voucher_reference"].where(f"ref_type1 = {codes.STOCK_ISSUE} and created_date = '2026-01-01'")
    assert made.select("ref_id2").distinct().count() == 200
    same(after["object_reference"], one.replaced["object_reference"])
    same(last["object_reference"], again.replaced["object_reference"])
    same(after["refno_state"], one.replaced["refno_state"])


def test_synchronisation_by_files_equals_whole_tables(spark, tables, tmp_path):
    store = Store(spark, str(tmp_path))
    base = store.create({name: tables[name] for name in CHANGED})
    changes = synchronise({**tables, **base}, RUN_AT)
    after = store.commit(base, changes)
    for name, frame in changes.replaced.items():
        same(after[name], frame)
    assert after["general_order_detail"].count() == base["general_order_detail"].count() + changes.added["general_order_detail"].count()


USE = "primary_object_type int, primary_object_id string, reference_object_type int, used_count decimal(21,6), created_date timestamp_ntz"


@pytest.mark.parametrize("mode", ["as_written", "intended"])
def test_usage_deltas_add_up_to_the_rewritten_table(spark, tmp_path, mode, monkeypatch):
    stored = add_missing(
        spark.createDataFrame([(115, "C1", 1012, Decimal(4), RUN_AT), (115, "", 1012, Decimal(1), None)], USE),
        SCHEMAS["object_reference"],
    ).withColumn("object_reference_id", F.concat(F.lit("id"), "primary_object_id"))
    store = Store(spark, str(tmp_path))
    base = store.create({"object_reference": stored.select(*SCHEMAS["object_reference"])})
    whole = base["object_reference"]
    for day in range(1, 7):
        now = at(datetime(2026, 1, day))
        counts = spark.createDataFrame(
            [(115, "C1", 1012, Decimal(day)), (2, f"N{day % 3}", 1012, Decimal(3)), (115, "", 7, Decimal(1))], USE.rsplit(",", 1)[0]
        )
        whole = usage.add_usage(whole, counts, now, mode)
        base = store.commit(base, Changes({}, {}, deltas={"object_reference": usage.usage_delta(base["object_reference"], counts, now, mode)}))
        same(base["object_reference"], whole)
    assert len(base.parts["object_reference"]) == 7
    small = store.compact(base)
    assert len(small.parts["object_reference"]) < plans.FAN
    same(small["object_reference"], whole)


def test_fifty_runs_leave_few_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "SMALLEST", 2_000)
    store, base = row_store(spark, tmp_path, 100, files=1)
    most = 0
    for run in range(50):
        added = spark.range(1000 * run, 1000 * run + 20, 1, 1).select("id", F.lit("new").alias("value"))
        base = store.commit(base, Changes({"rows": added}, {}))
        base = store.compact(base)
        most = max(most, len(base.parts["rows"]))
    assert most <= 3 * plans.FAN
    assert base["rows"].count() == 1_100
    assert base["rows"].where("value = 'new'").select("id").distinct().count() == 1_000
