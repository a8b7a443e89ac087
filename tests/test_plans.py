"""Physical plan shape: what must hold at scale, checked on the small data.

* no registered query plans a Cartesian product or a nested-loop join;
* scans read only the needed columns and get the filters pushed down;
* big aggregations run partially before the shuffle;
* the top-20-per-product window is limited before its shuffle.
"""

import contextlib
import io

import pytest

import __spark_entry__ as E


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


QUERIES = E.queries()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_nested_loop(spark, sf_dir, key):
    p = plan(QUERIES[key](spark, sf_dir))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_scan_pushdown_and_pruning(spark, sf_dir):
    p = plan(QUERIES["scan_project"](spark, sf_dir))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in p
    p = plan(QUERIES["product_review_list"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_returnflag)" in p and "EqualTo(l_partkey" in p


def test_best_sellers_aggregates_before_shuffle(spark, sf_dir):
    p = plan(QUERIES["best_sellers"](spark, sf_dir))
    assert "TakeOrderedAndProject" in p
    assert p.count("HashAggregate") >= 6  # partial + final for items, reviews, inventory
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p
    # Only the top rows are joined to products / reviews / inventory, by broadcast.
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_top_n_per_product_limited_before_shuffle(spark, sf_dir):
    p = plan(QUERIES["product_reviews"](spark, sf_dir))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("key", ["as_of", "state_at_version", "sync_triggered", "upsert", "insert_if_absent", "restore_missing"])
def test_latest_change_per_key_is_limited_before_the_shuffle(spark, sf_dir, key):
    p = plan(QUERIES[key](spark, sf_dir))
    assert "WindowGroupLimit" in p and "SortAggregate" not in p


def test_change_feed_is_one_scan_of_orders(spark, sf_dir):
    assert plan(QUERIES["as_of"](spark, sf_dir)).count("ReadSchema:") == 1


def test_cart_fold_is_partial_aggregation(spark, sf_dir):
    p = plan(QUERIES["cart_state"](spark, sf_dir))
    assert "partial_max" in p
    assert "collect_list" not in p and "collect_set" not in p


def test_one_order_reads_its_own_lines_only(spark, sf_dir):
    p = plan(QUERIES["order_lines_one"](spark, sf_dir))
    assert "EqualTo(l_orderkey" in p


def test_dense_ids_window_only_over_partition_counts(spark, sf_dir):
    p = plan(QUERIES["next_ids"](spark, sf_dir))
    # The only window is over per-partition counts; the rows are joined to it by broadcast.
    assert "BroadcastHashJoin" in p
