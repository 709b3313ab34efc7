"""Properties of the plans that matter once the tables are large."""

import re

import pytest

import __spark_entry__ as contract
from flatloom.queries import QUERIES
from flatloom.operators.checks import orphan_keys
from flatloom.operators.dedup import new_keys
from flatloom.operators.numbering import positions_within
from flatloom.plans.incremental import Store, load_batch
from flatloom.plans.normalize import parse_once
from flatloom.queries.nested import documents
from flatloom.sources.star_schema import LINE_ORDER, ORDERS, nested_documents, table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Joins as they are planned when no side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# These run whole jobs and return counts of stored tables.
JOBS = {
    "load_tables", "reload_changes_nothing", "reported_entries", "run_records", "run_outcomes", "stream_equals_batch",
    "stream_new_keys", "stream_first_slice_wins", "same_name_files_both_load",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_cross_joins_and_no_python_workers(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert not re.search("Cartesian|NestedLoop|EvalPython|MapInPandas|FlatMapGroups", plan)


@pytest.mark.parametrize(
    "name",
    [n for n in sorted(QUERIES) if n.startswith(("dedup", "distinct", "fd_", "pk_", "hottest", "new_keys"))],
)
def test_collapsing_uses_no_window_and_combines_before_each_shuffle(spark, sf_dir, name):
    lines = plan_of(contract.queries()[name](spark, sf_dir)).splitlines()
    assert not any("Window" in line for line in lines)
    for above, below in zip(lines, lines[1:], strict=False):
        if "Exchange" in above and "Broadcast" not in above:
            assert "Aggregate" in below


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(contract.queries()["containing_playlists"](spark, sf_dir))
    assert "EqualTo(l_partkey,7)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_pages_are_numbered_without_reading_them(spark, sf_dir):
    plan = plan_of(contract.queries()["numeric_order_first_n"](spark, sf_dir))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan
    assert "TakeOrderedAndProject" in plan


def test_nested_columns_are_pruned(spark, sf_dir):
    parsed = parse_once(documents(spark, sf_dir), ORDERS)
    facts = plan_of(parsed.facts())
    assert "ReadSchema: struct<pid:bigint,tracks:array<struct<pos:int,track_key:bigint>>>" in facts
    parents = plan_of(parsed.parents())
    assert "ReadSchema: struct<pid:bigint,name:string," in parents
    assert "tracks" not in parents


def test_rank_limit_is_applied_before_the_shuffle(spark, sf_dir):
    plan = plan_of(contract.queries()["latest3_median"](spark, sf_dir))
    partial, exchange = plan.index("row_number(), 3, Partial"), plan.index("Exchange hashpartitioning")
    assert exchange < partial, "the plan is printed from the last step to the first"


def test_short_label_lists_are_broadcast(spark, sf_dir):
    plan = plan_of(contract.queries()["label_lookup"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_anti_joins_see_each_key_once_when_nothing_is_small(spark, sf_dir, no_broadcast):
    lines = table(spark, sf_dir, "lineitem")
    for df in (
        orphan_keys(lines, "l_partkey", table(spark, sf_dir, "part"), "p_partkey"),
        new_keys(lines, lines.filter("l_orderkey < 100"), "l_partkey"),
    ):
        plan = plan_of(df)
        join, left = plan.index("SortMergeJoin"), plan.index("HashAggregate")
        assert join < left, "the aggregate lies below the join"


def test_documents_are_built_in_one_shuffle_of_orders_and_lines(spark, sf_dir):
    plan = plan_of(nested_documents(spark, sf_dir))
    after_union = plan[: plan.index("Union")]
    assert after_union.count("Exchange") == 1


def test_medians_beyond_one_task(spark, sf_dir):
    from flatloom.operators.medians import median_by

    orders = table(spark, sf_dir, "orders")
    plan = plan_of(median_by(orders, "o_orderpriority", "o_totalprice"))
    assert "percentile" not in plan


def test_facts_are_not_shuffled_to_find_finished_batches(spark, sf_dir, tmp_path):
    store = Store(spark, str(tmp_path / "store"), ORDERS)
    store.create()
    load_batch(documents(spark, sf_dir), store, "b0")
    plan = plan_of(store.tables()["playlist_tracks"])
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_hot_rows_are_not_shuffled_by_their_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    plan = plan_of(positions_within(rows, "l_orderkey", LINE_ORDER))
    assert "_at" in plan and "Exchange hashpartitioning(l_orderkey" not in plan
    assert plan.count("SortMergeJoin") == 0 and "Window" not in plan
