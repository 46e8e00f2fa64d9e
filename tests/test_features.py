"""Customer features on hand-written frames and random frames vs plain Python."""

import datetime as dt
import random
from collections import Counter
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from tillroll.operators import features as feat
from tillroll.sources.tables import TX_COLUMNS

SCHEMA = ("TransactionID string, CustomerID string, ProductID string, ProductCategory string, "
          "Quantity int, UnitPrice decimal(10,2), Revenue decimal(12,2), TransactionDate timestamp_ntz, "
          "Country string, PaymentMethod string")


def _tx(spark, rows):
    full = []
    for r in rows:
        d = dict(ProductID="p", Quantity=1, UnitPrice=Decimal("1.00"), Revenue=Decimal("1.00"),
                 Country="X", PaymentMethod="card", ProductCategory="a")
        d.update(r)
        full.append(tuple(d[c] for c in TX_COLUMNS))
    return spark.createDataFrame(full, SCHEMA)


def test_mode_ties_and_nulls(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [dict(TransactionID=str(i), CustomerID="c1", ProductCategory=c, TransactionDate=t)
            for i, c in enumerate(["b", "b", "a", "a", "c"])]
    rows += [dict(TransactionID="x1", CustomerID="c2", ProductCategory=None, TransactionDate=t),
             dict(TransactionID="x2", CustomerID="c2", ProductCategory=None, TransactionDate=t)]
    out = {r.CustomerID: r.PrimaryCategory for r in feat.customer_features(_tx(spark, rows)).collect()}
    assert out == {"c1": "a", "c2": None}


def test_single_order_gap_is_tenure(spark):
    rows = [dict(TransactionID="1", CustomerID="c1", TransactionDate=dt.datetime(2024, 1, 1)),
            dict(TransactionID="2", CustomerID="c2", TransactionDate=dt.datetime(2024, 1, 11))]
    r = {x.CustomerID: x for x in feat.customer_features(_tx(spark, rows)).collect()}
    assert r["c1"].Frequency == 1 and r["c1"].AvgDaysBetweenOrders == float(r["c1"].CustomerTenureDays)
    assert r["c2"].Recency == 1 and r["c1"].Recency == 11


def test_recency_two_definitions(spark):
    rows = [dict(TransactionID="1", CustomerID="c1", TransactionDate=dt.datetime(2024, 3, 5, 22, 0)),
            dict(TransactionID="2", CustomerID="c2", TransactionDate=dt.datetime(2024, 3, 1, 9, 0))]
    tx = _tx(spark, rows)
    pipeline = {r.CustomerID: r.Recency for r in feat.customer_features(tx).collect()}
    sql = {r.CustomerID: r.RecencyDays for r in feat.rfm_sql(tx).collect()}
    assert pipeline["c1"] == 1 and sql["c1"] == 0
    assert pipeline["c2"] == 5 and sql["c2"] == 4


def _expected(rows):
    snap = max(r["TransactionDate"] for r in rows) + dt.timedelta(days=1)
    out = {}
    for cid in {r["CustomerID"] for r in rows}:
        mine = [r for r in rows if r["CustomerID"] == cid]
        freq = len({r["TransactionID"] for r in mine})
        money = sum(r["Revenue"] for r in mine)
        rec = (snap - max(r["TransactionDate"] for r in mine)).days
        ten = (snap - min(r["TransactionDate"] for r in mine)).days
        cnt = Counter(r["ProductCategory"] for r in mine)
        best = max(cnt.values())
        gap = Decimal(ten - rec) / (freq - 1) if freq > 1 else Decimal(ten)
        out[cid] = dict(Frequency=freq, Monetary=float(money), Recency=rec, CustomerTenureDays=ten,
                        PrimaryCategory=min(k for k, v in cnt.items() if v == best),
                        AvgOrderValue=float((money / freq).quantize(Decimal("0.01"), ROUND_HALF_EVEN)),
                        AvgDaysBetweenOrders=float(gap.quantize(Decimal("0.1"), ROUND_HALF_EVEN)))
    return out


def test_random_frames_against_python(spark):
    rnd = random.Random(42)
    rows = []
    for c in range(200):
        for _ in range(rnd.randint(1, 12)):
            rows.append(dict(TransactionID=f"{c}-{rnd.randint(0, 5)}", CustomerID=f"c{c}",
                             ProductCategory=rnd.choice("abcd"),
                             Revenue=Decimal(rnd.randint(1, 99999)) / 100,
                             TransactionDate=dt.datetime(2024, 1, 1) + dt.timedelta(
                                 minutes=rnd.randint(0, 60 * 24 * 400))))
    got = {r.CustomerID: r for r in feat.customer_features(_tx(spark, rows)).collect()}
    exp = _expected(rows)
    assert set(got) == set(exp)
    for cid, e in exp.items():
        g = got[cid]
        for k, v in e.items():
            gv = float(g[k]) if k in ("Monetary", "AvgOrderValue") else g[k]
            assert gv == v, (cid, k, gv, v)


def test_session_time_zone_does_not_matter(spark):
    rows = [dict(TransactionID="1", CustomerID="c1", TransactionDate=dt.datetime(2024, 3, 9, 2, 30)),
            dict(TransactionID="2", CustomerID="c1", TransactionDate=dt.datetime(2024, 3, 10, 2, 15)),
            dict(TransactionID="3", CustomerID="c2", TransactionDate=dt.datetime(2024, 3, 11, 2, 20)),
            dict(TransactionID="4", CustomerID="c3", TransactionDate=dt.datetime(2024, 11, 2, 1, 30))]
    tx = _tx(spark, rows)
    before = sorted(feat.customer_features(tx).collect())
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        after = sorted(feat.customer_features(tx).collect())
        sql_after = sorted(feat.rfm_sql(tx).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after
    assert sorted(feat.rfm_sql(tx).collect()) == sql_after


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregates_neither_repeat_the_facts_nor_hold_maps(spark):
    """No row is repeated for a distinct count and no state falls back to sorting the facts."""
    tx = _tx(spark, [dict(TransactionID="1", CustomerID="c1", TransactionDate=dt.datetime(2024, 1, 1))])
    plan = _physical(feat.customer_aggregates(tx))
    assert "Expand" not in plan and "ObjectHashAggregate" not in plan
    assert "Exchange hashpartitioning(CustomerID" in plan


def test_aggregates_of_nulls_and_repeated_orders(spark):
    """Null customers, orders and values, and an order of two customers."""
    t = dt.datetime(2024, 1, 1)
    rows = [dict(TransactionID=o, CustomerID=c, ProductCategory=p, Revenue=m, TransactionDate=t)
            for o, c, p, m in [("1", None, "a", None), ("1", None, "b", None), (None, "c", None, Decimal("2.00")),
                               ("2", "c", "b", None), ("2", "d", "a", Decimal("1.50")), ("2", "d", "a", Decimal("1.50"))]]
    got = {r.CustomerID: (r.Frequency, r.Monetary, r.TotalProducts, r.UniqueCategories, r.PrimaryCategory, r.Country)
           for r in feat.customer_aggregates(_tx(spark, rows)).collect()}
    assert got == {None: (1, None, 2, 2, "a", "X"), "c": (1, Decimal("2.00"), 2, 1, "b", "X"),
                   "d": (1, Decimal("3.00"), 2, 1, "a", "X")}


def test_overview_counts_without_repeating_the_facts(spark):
    from tillroll.operators import sales
    t = dt.datetime(2024, 1, 1)
    rows = [dict(TransactionID=o, CustomerID=c, TransactionDate=t) for o, c in [("1", "a"), ("1", "b"), ("2", None), (None, "a")]]
    out = sales.overview(_tx(spark, rows))
    assert "Expand" not in _physical(out)
    assert out.first().asDict() == dict(TotalRevenue=Decimal("4.00"), TotalOrders=2, TotalCustomers=2, AverageOrderValue=1.0)
