"""Physical plans that have to hold at scale."""

import re
from datetime import datetime

import pytest
from compare import plan
from pyspark.sql import functions as F

from ledgerops import queries, session
from ledgerops.operators import costing, inventory_checks, issues, receipts, sync
from ledgerops.sources.derived import DERIVED, depends_on
from ledgerops.sources.tables import DerivedTables, through, wall_clock

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return queries.derived_tables(spark, SMALL)


def test_filters_and_columns_reach_the_scan(spark, tables):
    text = plan(inventory_checks.transfer_out_not_in_ledger(tables))
    assert "GreaterThan(main_outward_quantity,0.000000)" in text
    ledger_scan = next(
        line for line in text.splitlines()
        if "main_outward_quantity" in line and "ReadSchema" in line
    )
    assert "inward_amount" not in ledger_scan.split("ReadSchema")[1]


def test_missing_documents_are_anti_joins_against_distinct_keys(spark, tables):
    text = plan(inventory_checks.outward_not_in_ledger(tables))
    assert "LeftAnti" in text
    assert "partial" not in text.split("LeftAnti")[0]
    assert re.search(r"LeftAnti[\s\S]*HashAggregate", text)


def test_targets_are_drawn_without_a_full_sort(spark, tables):
    text = plan(receipts.target_orders(tables, 10).select("order_id"))
    assert "TakeOrderedAndProject" in text


def test_a_busy_item_is_spread_over_its_days(spark, tables):
    points = costing.issue_points(queries.issue_lines(tables))
    text = plan(costing.stock_on_hand(tables["led_inventory_item_ledger"], points, "intended"))
    windows = re.findall(r"Window \[.*\], \[(.*?)\], \[(.*?)\]", text)
    assert windows
    for groups, order in windows:
        # over an item's days, or within one day of it
        assert "_day" in groups or "_day" in order


def test_deletes_read_only_keys_of_the_links(spark, tables):
    text = plan(sync.kept_issues(tables))
    assert "LeftAnti" in text and "LeftSemi" in text


@pytest.fixture()
def settled_plans(spark):
    """Plans as they are run: no broadcast, and reuse decided beforehand."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.maxMetadataStringLength": "4000",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def scans(text, *columns):
    """Scans of a plan that read all of these columns."""
    found = [line for line in text.splitlines() if "FileScan" in line]
    return [line for line in found if all(f"{c}:" in line.split("ReadSchema")[1] for c in columns)]


def test_the_report_reads_the_ledger_three_times(spark, tables, settled_plans, monkeypatch):
    written = []

    def keep(frame, name):
        written.append(plan(frame))
        return inventory_checks_keep(frame, name)

    inventory_checks_keep = inventory_checks.keep
    monkeypatch.setattr(inventory_checks, "keep", keep)
    parts = [plan(part) for part in inventory_checks.report_parts(tables)]
    ledger = tables["led_inventory_item_ledger"].inputFiles()[0].split("/")[-3]
    reads = [line for text in written + parts for line in text.splitlines() if "FileScan" in line and ledger in line]
    assert len(reads) == 3


def test_five_levels_share_one_exchange_of_the_ledger(spark, tables, settled_plans):
    text = plan(inventory_checks.level_findings(tables))
    ledger = tables["led_inventory_item_ledger"].inputFiles()[0].split("/")[-3]
    lines = text.splitlines()
    scan = [i for i, line in enumerate(lines) if "FileScan" in line and ledger in line]
    assert len(scan) == 1
    # above the scan: summed on the map side, dealt once, summed, then dealt to the join
    above = [line for line in lines[: scan[0]] if re.search("Exchange|HashAggregate|SortMergeJoin", line)]
    names = [re.search("Exchange|HashAggregate|SortMergeJoin", line).group() for line in above]
    assert names[-3:] == ["HashAggregate", "Exchange", "HashAggregate"]
    assert names.count("SortMergeJoin") == 1 and names.count("Exchange") == 2


def test_receipts_read_payments_and_targets_once(spark, tables, settled_plans):
    text = plan(queries.candidates(tables))
    assert len(scans(text, "receive_amount")) == 1
    assert text.count("SortMergeJoin") <= 4


def _moved(text, node="Exchange"):
    """The lines of a plan that stand below some exchange, or below another node."""
    depth, moved = None, []
    for line in text.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if depth is not None and at > depth:
            moved.append(line)
        else:
            depth = at if node in line else None
    return moved


@pytest.fixture()
def whole_lists(spark):
    """Plans that name all columns."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    yield
    spark.conf.set("spark.sql.debug.maxToStringFields", before)


def test_missing_orders_move_before_they_are_wide(spark, tables, settled_plans, whole_lists):
    run_at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    for name, frame in (
        ("page_name", sync.missing_orders(tables, run_at)),
        ("page_name", sync.next_orders(tables, run_at)),
        ("unit_name", sync.missing_order_lines(tables, run_at)),
    ):
        text = plan(frame)
        assert name in text  # the view's wide columns are made,
        assert not [line for line in _moved(text) if f"AS {name}" in line]  # but not moved


def test_a_step_below_a_view_gives_the_rows_of_a_step_on_it(spark, tmp_path):
    day = datetime(2020, 1, 1)
    orders = [(1, 1, 5.0, day), (1, 1, 6.0, day), (2, 2, 7.0, day), (3, 9, 8.0, day), (None, 1, 9.0, day), (4, 1, None, None)]
    customers = [(1, "one"), (2, "two"), (2, "two again"), (None, "none")]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    t = DerivedTables(spark, str(tmp_path))
    marks = spark.createDataFrame([("O1", "a"), ("O2", "b"), ("O2", "c"), (None, "d")], "order_id string, mark string")

    def step(frame):
        return frame.join(marks, "order_id", "left")

    below, above = through(t, "sa_order", ["order_id"], step), step(t["sa_order"])
    assert sorted(below.columns) == sorted(above.columns)
    rows = [sorted(map(str, f.select(*sorted(above.columns)).collect())) for f in (below, above)]
    assert rows[0] == rows[1] and len(rows[0]) == 8


LEDGER = "led_inventory_item_ledger"


def test_lines_do_not_move_into_the_ledger(spark, settled_plans, whole_lists):
    t = DerivedTables(spark, SMALL)
    text = plan(t._ledger(LEDGER))
    assert text.count("SortMergeJoin") == 4
    assert "l_quantity" in text and not [line for line in _moved(text) if "l_quantity" in line]


def test_dealt_lines_give_the_ledger_of_its_definition(spark, tmp_path):
    day = datetime(2020, 1, 1)
    kinds = ["A", "R", "N", "A", None]
    lines = [
        (order, part, part, number, 2.0 + part, 3.0, kinds[(order + number) % 5], day)
        for order in range(12) for part in (2, 3, 6) for number in (1, 2)
    ]
    lines += lines[:9] + [(None, 2, 2, 1, 1.0, 1.0, "A", day), (1, None, 2, 1, 1.0, 1.0, "R", None), (2, 3, 3, 1, 9.0, 9.0, "R", day)]
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(2, 5.0), (3, 6.0)], "p_partkey long, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    t = DerivedTables(spark, str(tmp_path))
    plain = {"lineitem": t["lineitem"], "part": t["part"]}

    def defined(name):
        if name not in plain:
            plain[name] = wall_clock(spark.sql(DERIVED[name], **{other: defined(other) for other in depends_on(name)}))
        return plain[name]

    for name in ("li", LEDGER):
        found, wanted = t[name], defined(name)
        assert set(wanted.columns) <= set(found.columns)
        rows = [sorted(map(str, f.select(*wanted.columns).collect())) for f in (found, wanted)]
        assert rows[0] == rows[1] and rows[0]


def test_order_lines_and_their_ledger_stay_where_they_lie(spark, tables, settled_plans, whole_lists, monkeypatch):
    written, keep = {}, session._keep
    monkeypatch.setattr(session, "_keep", lambda frame, name: written.update({name: plan(frame)}) or keep(frame, name))
    before = spark.conf.get(session.ALL_KEYS)
    found = plan(inventory_checks.order_not_in_ledger(tables))
    assert spark.conf.get(session.ALL_KEYS) == before
    text = written["unposted_lines"]
    assert "LeftAnti" in text and "l_partkey" in text and "l_partkey" not in found
    for one in (text, plan(tables["led_order_item_ledger"])):
        assert "o_custkey" in "".join(_moved(one)) and "l_partkey" not in "".join(_moved(one))


def test_orders_by_key_give_the_lines_of_orders_by_id(spark, tmp_path):
    day = datetime(2020, 1, 1)
    lines = [(order, part, 2, number) for order in (0, 1, 8, 9, 17) for part in (1, 10, 150) for number in (1, 2)]
    lines += lines[:3] + [(None, 150, 2, 1), (8, None, 2, 1), (9, 150, None, 1), (9, 150, 2, None), (33, 150, 2, 1)]
    rows = {
        "lineitem": ([(*line, 1.0, 1.0, "A", day) for line in lines],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
            " l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(key, customer, 5.0, day) for key, customer in (
            (0, 1), (1, 2), (1, 2), (8, 3), (9, 2), (9, 1), (17, 9), (None, 1), (33, None))],
            "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "customer": ([(1, "one"), (2, "two"), (2, "again"), (3, "three"), (None, "none")], "c_custkey long, c_name string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = DerivedTables(spark, str(tmp_path))
    plain = {name: t[name] for name in rows}
    for name in ("li", "sa_order", "sa_order_detail", "led_order_item_ledger"):
        plain[name] = wall_clock(spark.sql(DERIVED[name], **{other: plain[other] for other in depends_on(name)}))

    def listed(frame):
        return sorted(map(str, frame.collect()))

    ledger = "led_order_item_ledger"
    assert t[ledger].columns == plain[ledger].columns and listed(t[ledger]) == listed(plain[ledger])
    by_key, by_id = (listed(inventory_checks.order_not_in_ledger(tables)) for tables in (t, plain))
    assert by_key == by_id and len(by_key) > 10


def test_order_lines_meet_their_issues_before_they_are_wide(spark, tables, settled_plans, whole_lists):
    run_at = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    headers = queries.issue_headers(tables)
    below = issues.stored_issue_lines(headers, tables, run_at)
    text = plan(below)
    assert "AS sku_code" in text
    assert not [line for line in _moved(text, "hashpartitioning(order_id") if "AS sku_code" in line]
    above = issues.issue_lines(headers, tables["sa_order_detail"], tables["stock"], tables["inventory_item"], run_at)
    assert below.columns == above.columns and below.count() == above.count() > 0
    assert below.exceptAll(above).isEmpty()
