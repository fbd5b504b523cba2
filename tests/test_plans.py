"""Plan-shape checks: the scale-relevant choices must survive refactors."""
from layerkit.plans import retail
from tests.conftest import SF_SMALL
from tests.plan_util import plan_text


def test_or_join_query_avoids_nested_loop(spark):
    plan = plan_text(retail.q01_or_join(spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_not_in_is_not_null_aware_broadcast_only(spark):
    plan = plan_text(retail.q03_lapsed_customers(spark, SF_SMALL))
    assert "NestedLoop" not in plan


def test_year_filter_reaches_scan(spark):
    plan = plan_text(retail.q04_count_by_name(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_column_pruning(spark):
    plan = plan_text(retail.q05_len_filter(spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_top_item_limits_groups_before_the_shuffle(spark):
    plan = plan_text(retail.q14_top_item_by_city(spark, SF_SMALL), "simple")
    # the limit runs on both sides of the exchange, and every table is read once
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("FileScan parquet") == 5
    assert "NestedLoop" not in plan


def test_pivot_with_values_has_no_extra_distinct_job(spark):
    plan = plan_text(retail.q18_pivot_years(spark, SF_SMALL))
    assert "pivotfirst" in plan.lower()


def test_order_total_aggregates_before_joining(spark):
    plan = plan_text(retail.q20_tvf_apply(spark, SF_SMALL), "simple")
    assert "partial_sum" in plan


def test_not_in_avoids_null_aware_join(spark):
    plan = plan_text(retail.q03_lapsed_customers(spark, SF_SMALL), "simple")
    assert "LeftAnti" in plan and "isnull" not in plan.split("LeftAnti")[1].split("\n")[0].lower()


def test_surrogate_key_has_no_window_over_rows(spark):
    from layerkit.operators import add_surrogate_key
    df = spark.range(1000).selectExpr("id % 7 AS g", "id")
    plan = plan_text(add_surrogate_key(df, ["g", "id"], "sk"), "simple")
    # the only window runs over one row per partition (the offsets), after an aggregate
    window_inputs = [ln for ln in plan.splitlines() if "Window [" in ln]
    assert len(window_inputs) == 1 and "__n" in window_inputs[0]


def test_one_pass_for_both_cte_aggregates(spark):
    plan = plan_text(retail.q09_bought_gt_sold(spark, SF_SMALL), "simple")
    assert plan.count("FileScan parquet") == 3  # lineitem, orders, part once each


def test_bronze_status_scan_prunes_partitions(spark):
    from layerkit.plans import medallion as med
    run = med.MedallionRun(spark, SF_SMALL).ingest()
    plan = plan_text(run.parsed_new(), "simple")
    assert "PartitionFilters: [isnotnull(Status" in plan and "(Status#" in plan and "= New)" in plan


def test_bucketed_tables_join_without_exchange(spark):
    from pyspark.sql import functions as F

    from layerkit.session import new_database
    from layerkit.sources import load, write_bucketed
    db = new_database(spark, "t_bucket")
    write_bucketed(load(spark, SF_SMALL, "orders"), f"{db}.orders", "o_orderkey", 8)
    write_bucketed(load(spark, SF_SMALL, "lineitem"), f"{db}.lineitem", "l_orderkey", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o, l = spark.table(f"{db}.orders"), spark.table(f"{db}.lineitem")
        j = l.join(o, l.l_orderkey == o.o_orderkey).groupBy("o_orderkey").agg(F.sum("l_quantity"))
        plan = plan_text(j, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        expected = load(spark, SF_SMALL, "lineitem").join(
            load(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).count()
        assert l.join(o, l.l_orderkey == o.o_orderkey).count() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_purchase_orders_are_parsed_once(spark):
    from layerkit.plans.purchase_orders import purchase_order_documents, shred_purchase_orders
    docs = purchase_order_documents(spark, SF_SMALL).checkpoint()
    plan = shred_purchase_orders(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parsejson") == 1 and "get_json_object" not in plan and "from_json" not in plan
