"""A customer holding a third of all rows: features still match the oracle."""

from pyspark.sql import functions as F

from tests.conftest import SF01
from tests.oracle_harness import compare, duck_connection
from tillroll.operators import features as feat
from tillroll.plans import sqlfrag as S
from tillroll.plans.q_customers import FEATURES_SQL
from tillroll.plans.registry import present
from tillroll.sources.tables import TX_COLUMNS, transactions_with_keys

HOT = "l_orderkey % 3 = 0"


def test_hot_customer_features_match_oracle(spark):
    tx = (transactions_with_keys(spark, SF01)
          .withColumn("CustomerID", F.when(F.expr(HOT), F.lit("1")).otherwise(F.col("CustomerID")))
          .select(*TX_COLUMNS))
    got = present(feat.customer_features(tx)).toPandas()
    hot_cte = S.TX_CTE.replace("CAST(o.o_custkey AS VARCHAR) AS CustomerID",
                               f"CASE WHEN l.{HOT} THEN '1' ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID")
    assert hot_cte != S.TX_CTE
    sql = FEATURES_SQL.replace(S.TX_CTE, hot_cte)
    want = duck_connection(SF01).sql(sql).df()
    assert compare(got, want) == []
    share = got.loc[got.CustomerID == "1", "Frequency"].iloc[0] / got.Frequency.sum()
    assert share > 0.3
