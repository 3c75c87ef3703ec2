"""Keys under a collation: the splittable joins find the partners that the plain join finds."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerops import queries
from ledgerops.functions.columns import HASH_SETTING, join_spread, within, without
from ledgerops.operators import numbering

SMALL = "/root/testdata/sf0.001"
COLLATIONS = ["UTF8_LCASE", "UNICODE_CI_AI"]


@pytest.fixture(params=["true", "false"])
def hashes(spark, request):
    before = spark.conf.get(HASH_SETTING)
    spark.conf.set(HASH_SETTING, request.param)
    yield spark
    spark.conf.set(HASH_SETTING, before)


def keyed(spark, keys, collation, value):
    frame = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], f"k string, {value} int")
    return frame.withColumn("k", F.collate("k", collation))


def bag(frame, *columns):
    return Counter(tuple(row) for row in frame.select(*columns).collect())


@pytest.mark.parametrize("collation", COLLATIONS)
def test_joins_equal_the_plain_join(hashes, collation):
    spark = hashes
    left = keyed(spark, ["A", "b", "b", "C", None, "é", "z"], collation, "x")
    right = keyed(spark, ["a", "B", "c", "c", None, "E"], collation, "y")
    for how in ("inner", "left", "full_outer"):
        want = bag(left.join(right, "k", how), "x", "y")
        assert bag(join_spread(left, right, ["k"], how), "x", "y") == want
    for spread, plain in ((within, "left_semi"), (without, "left_anti")):
        want = bag(left.join(right, "k", plain), "x")
        assert bag(spread(left, right, ["k"], hot=True), "x") == want
    assert bag(left.join(right, "k", "left_semi"), "x").total() >= 4


@pytest.mark.parametrize("collation", COLLATIONS)
def test_no_voucher_is_lost_in_a_collated_branch(hashes, collation):
    branches = [("B", 1), ("b", 2), ("c", 3), (None, 4)]
    numbered = hashes.createDataFrame(branches, "branch_id string, row_num long")
    numbered = numbered.withColumn("branch_id", F.collate("branch_id", collation))
    got = {r.branch_id: r.row_num for r in numbering.number_in_branch(numbered).collect()}
    assert got == {"B": 1, "b": 2, "c": 1, None: 1}


def lower_and_upper(tables, collation, raised):
    """The tables with ids under a collation, those of `raised` in upper case."""

    def ids(name):
        frame = tables[name]
        columns = []
        for column, kind in frame.dtypes:
            if kind == "string" and (column.endswith("_id") or column in ("ref_id1", "ref_id2")):
                value = F.upper(column) if name in raised else F.lower(column)
                columns.append(F.collate(value, collation).alias(column))
            else:
                columns.append(F.col(column))
        return frame.select(*columns)

    class Collated(dict):
        def __missing__(self, name):
            self[name] = ids(name)
            return self[name]

    return Collated()


@pytest.mark.parametrize(
    ("query", "columns", "raised"),
    [
        ("ar5_allocation_without_link", ["check_name"], {"voucher_reference"}),
        ("vg7_receipt_candidates", ["source", "payment_type", "receipt_amount", "receipt_remain_amount"],
         {"sa_order_payment", "led_account_object_closing", "voucher_reference"}),
        ("sy6_receipts_to_delete", [], {"voucher_reference"}),
        ("sy7_links_to_delete", ["ref_type1"], {"sa_order"}),
    ],
)
def test_queries_find_partners_in_the_other_case(spark, query, columns, raised):
    tables = queries.derived_tables(spark, SMALL)
    run = queries.QUERIES[query]
    plain = run(tables)
    columns = [c for c in columns if c in plain.columns] or [F.lit(1)]
    got = bag(run(lower_and_upper(tables, "UTF8_LCASE", raised)), *columns)
    assert got == bag(plain, *columns) and got
