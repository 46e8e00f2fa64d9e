"""Plan shape: pushdown/pruning at the scan, no Python UDFs on relational
paths, windows only over reduced or partitioned inputs."""

import pytest

from tests.conftest import SF01
import __spark_entry__ as entry

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
ML_OR_PANDAS = {"kmeans_segments", "kmeans_sweep", "forest_scores", "forest_importances", "forest_metrics", "forest_nodes", "kmeans_fixed_fit",
                "ridge_forecast", "kpi_payload"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["customer_features", "monthly_trend", "segment_table", "risk_bands",
                                  "forecast_table", "kpi_flat", "campaigns", "cleaning_audit"])
def test_no_python_udf(spark, name):
    plan = _plan(entry.queries()[name](spark, SF01))
    assert not any(n in plan for n in PYTHON_NODES), plan


def test_scan_prunes_columns(spark):
    from tillroll.sources.tables import transactions
    from pyspark.sql import functions as F
    df = transactions(spark, SF01).groupBy("Country").agg(F.sum("Revenue"))
    plan = _plan(df)
    assert "ReadSchema: struct<Revenue:decimal(12,2),Country:string>" in plan


def test_date_filter_pushed_down(spark):
    from tillroll.sources.tables import transactions
    df = transactions(spark, SF01).filter("TransactionDate >= timestamp_ntz'2000-01-01'")
    assert "PushedFilters: [IsNotNull(TransactionDate), GreaterThanOrEqual(TransactionDate" in _plan(df)


def test_features_single_customer_shuffle_no_cross_join(spark):
    plan = _plan(entry.queries()["customer_features"](spark, SF01))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


AGGS = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")


def _children(node):
    name = node.nodeName()
    if "QueryStage" in name:
        return [node.plan()]
    if name == "AdaptiveSparkPlan":
        return [node.executedPlan()]
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _reduced_before_scan(node) -> bool:
    """Every path below ``node`` meets an aggregate before a file scan."""
    name = node.nodeName()
    if any(name.startswith(a) for a in AGGS):
        return True
    if "Scan" in name and "Exchange" not in name:
        return False
    kids = _children(node)
    return all(_reduced_before_scan(k) for k in kids) if kids else True


def _global_windows(node, out):
    if node.nodeName() == "Window" and node.partitionSpec().isEmpty():
        out.append(node)
    for k in _children(node):
        _global_windows(k, out)
    return out


@pytest.mark.parametrize("name", ["daily_sales_ma7", "analyst_daily_sales_ma7", "segment_labels",
                                  "segment_table", "roc_auc", "roc_curve", "describe_transactions",
                                  "forecast_summary", "decomposition", "kpi_flat"])
def test_unpartitioned_windows_only_over_reduced_inputs(spark, name):
    df = entry.queries()[name](spark, SF01)
    df.write.format("noop").mode("overwrite").save()
    root = df._jdf.queryExecution().executedPlan()
    for w in _global_windows(root, []):
        assert _reduced_before_scan(w), f"{name}: global window over unreduced rows"


def test_window_check_is_not_vacuous(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tillroll.sources.tables import transactions
    ma = entry.queries()["daily_sales_ma7"](spark, SF01)
    ma.write.format("noop").mode("overwrite").save()
    assert _global_windows(ma._jdf.queryExecution().executedPlan(), [])
    bad = transactions(spark, SF01).withColumn("r", F.row_number().over(Window.orderBy("TransactionDate")))
    bad.write.format("noop").mode("overwrite").save()
    found = _global_windows(bad._jdf.queryExecution().executedPlan(), [])
    assert found and not all(_reduced_before_scan(w) for w in found)


def _core_names():
    from tillroll.plans import registry
    registry.load_all()
    return sorted(registry.QUERIES)


@pytest.mark.parametrize("name", _core_names())
def test_no_keyless_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF01))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["segment_share", "segment_table", "segment_breakdown", "campaigns"])
def test_segment_plans_stay_small(spark, name):
    df = entry.queries()[name](spark, SF01)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") < 20


def test_grid_values_are_shuffled_once(spark):
    """The parameter grid runs in the series' row: no exchange above the arrays."""
    plan = _plan(entry.queries()["holt_winters_grid"](spark, SF01))
    above = plan.split("collect_list")[0]
    assert "Exchange" not in above


def test_aggregates_are_presented_in_order(spark):
    for name, key in (("monthly_trend", lambda r: r["YearMonth"]), ("category_performance", lambda r: -r["GrossRevenue"]),
                      ("country_payment", lambda r: -r["TotalRevenue"]), ("rfm_sql", lambda r: -r["MonetarySpend"]),
                      ("segment_breakdown", lambda r: -r["TotalSegmentRevenue"]),
                      ("analyst_monthly_trend", lambda r: r["YearMonth"])):
        keys = [key(r) for r in entry.queries()[name](spark, SF01).collect()]
        assert keys == sorted(keys), name


def test_sketched_counts_read_the_mart_alone(spark):
    """Months and years come from the stored days: no facts in the plan, a bounded number of sketches read."""
    from pyspark.sql import functions as F

    from tillroll.operators import sales
    from tillroll.session import materialize
    from tillroll.sources.tables import transactions
    mart = materialize(sales.daily_mart(transactions(spark, SF01)))
    plan = _plan(sales.merged_counts(mart, F.substring(F.col("Date").cast("string"), 1, 7)))
    assert "/tmp/" in plan and "transactions-" not in plan and "lineitem" not in plan and "TransactionID" not in plan


def test_sketched_quantiles_read_the_mart_alone(spark):
    """Quartiles of any range come from the stored days: no facts in the plan."""
    from pyspark.sql import functions as F

    from tillroll.operators import sales
    from tillroll.session import materialize
    from tillroll.sources.tables import transactions
    mart = materialize(sales.daily_quantile_mart(transactions(spark, SF01)))
    half = mart.where("Date BETWEEN DATE'1995-03-01' AND DATE'1995-09-30'")
    plan = _plan(sales.merged_quantiles(half, F.lit("half")))
    assert "/tmp/" in plan and "transactions-" not in plan and "lineitem" not in plan
    assert not any(n in plan for n in PYTHON_NODES)


def test_analyst_statements_build_what_they_read(spark, monkeypatch):
    """Row checks need no customer stage, and their grouping and window share one shuffle."""
    from tillroll.plans import analyst_sql as A
    assert A._read(A.STATEMENTS["missing_keys"]) == ["raw", "row_findings"]
    assert A._read(A.STATEMENTS["daily_sales_ma7"]) == ["fact", "book_orders", "book_days"]
    assert A._read(A.STATEMENTS["action_list"]) == ["segments", "risks"]
    monkeypatch.setitem(A.SOURCES, "segments", None)
    plan = _plan(entry.queries()["analyst_missing_keys"](spark, SF01))
    assert plan.count("Exchange hashpartitioning") == 1


def test_sketched_quantiles_count_the_facts_once(spark):
    """Years add up their months' counts; the plan reads stored counts, never a value of the facts again."""
    plan = _plan(entry.queries()["sketched_quantiles"](spark, SF01))
    assert "transactions-" not in plan and "UnitPrice" not in plan
