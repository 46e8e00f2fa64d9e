"""Bucketed tables join and aggregate by customer without a shuffle."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from tillroll.plans.q_cleaning import q_bucket_round_trip
from tillroll.sources.buckets import write_bucketed
from tillroll.sources.tables import customer_table, segment_table, transactions


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_no_exchange_for_joins_and_aggregates_by_customer(spark):
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = write_bucketed(transactions(spark, SF001), "CustomerID")
        customers = write_bucketed(customer_table(spark, SF001), "CustomerID")
        segments = write_bucketed(segment_table(spark, SF001), "CustomerID")
        features = facts.groupBy("CustomerID").agg(F.count("*").alias("n"), F.sum("Revenue"), F.max("TransactionDate"))
        for df in (customers.join(segments.select("CustomerID", "CustomerSegment"), "CustomerID"),
                   facts.join(customers.select("CustomerID", "Recency"), "CustomerID"), features,
                   features.join(segments, "CustomerID"), q_bucket_round_trip(spark, SF001)):
            assert _exchanges(df) == [] and df.count() > 0
        plain = transactions(spark, SF001).groupBy("CustomerID").agg(F.count("*").alias("n"))
        assert _exchanges(plain)
        assert sorted(map(tuple, features.select("CustomerID", "n").collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
