"""Dirty fixture and cleaning chain."""

from pyspark.sql import functions as F

from tests.conftest import SF01
from tillroll.operators import cleaning
from tillroll.sources import tables


def test_fixture_predicates_fire_independently(spark):
    base = tables.transactions_with_keys(spark, SF01)
    counts = base.agg(*[F.count(F.when(F.expr(p), 1)).alias(n) for n, p in (
        ("dup", tables.DUP_PRED), ("null", tables.NULL_CUSTOMER_PRED),
        ("qty", tables.BAD_QUANTITY_PRED), ("price", tables.BAD_PRICE_PRED))]).first()
    assert (counts.dup, counts.null, counts.qty, counts.price) == (285, 207, 1178, 121)
    others = {"null": [tables.DUP_PRED, tables.BAD_QUANTITY_PRED, tables.BAD_PRICE_PRED],
              "qty": [tables.NULL_CUSTOMER_PRED, tables.BAD_PRICE_PRED],
              "price": [tables.NULL_CUSTOMER_PRED, tables.BAD_QUANTITY_PRED]}
    for name, pred in (("null", tables.NULL_CUSTOMER_PRED), ("qty", tables.BAD_QUANTITY_PRED),
                       ("price", tables.BAD_PRICE_PRED)):
        alone = base.filter(F.expr(pred))
        for o in others[name]:
            alone = alone.filter(~F.expr(o))
        assert alone.count() > 0, name


def test_audit_is_consistent_with_chain(spark):
    raw = tables.dirty_transactions(spark, SF01)
    a = cleaning.audit(raw).first()
    assert a.InitialRows == raw.count() == 60285
    assert a.DuplicatesRemoved == 285
    assert a.InitialRows - a.DuplicatesRemoved - a.MissingKeyRemoved - a.InvalidRemoved == a.FinalRows
    assert cleaning.clean(raw).count() == a.FinalRows


def test_csv_null_tokens(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("TransactionID,CustomerID,Quantity,UnitPrice\nT1,,1,2.5\nT2,NA,1,2.5\n"
                 "T3,null,1,2.5\nT4,C9,1,2.5\n")
    from tillroll.sources.csv_io import read_raw_csv
    df = read_raw_csv(spark, str(p), schema="TransactionID string, CustomerID string, "
                                            "Quantity int, UnitPrice double")
    assert [r.CustomerID for r in cleaning.drop_null_keys(df).collect()] == ["C9"]


def test_missing_input_raises(spark, tmp_path):
    import pytest
    from tillroll.sources.csv_io import read_raw_csv
    with pytest.raises(Exception):
        tables.transactions(spark, str(tmp_path / "absent"))
    with pytest.raises(Exception):
        read_raw_csv(spark, str(tmp_path / "absent.csv")).count()


def test_approx_distinct_close_to_exact(spark):
    from tillroll.operators import sales
    tx = tables.transactions(spark, SF01)
    exact = {r.YearMonth: r.TotalOrders for r in sales.monthly_trend(tx).collect()}
    approx = {r.YearMonth: r.TotalOrders for r in sales.monthly_trend(tx, approx_distinct=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - v) <= max(3, 0.05 * v) for k, v in exact.items())
