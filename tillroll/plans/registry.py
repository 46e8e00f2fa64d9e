"""Named queries: each is ``(spark, sf_dir) -> DataFrame`` plus, where the
operator is SQL-expressible, an independent DuckDB SQL oracle producing the
same columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def present(df: DataFrame) -> DataFrame:
    """Presentation edge: exact decimals to double, small ints to bigint,
    dates/timestamps to ISO text (the reference stores them as text)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, T.TimestampNTZType):
            c = F.substring(c.cast("string"), 1, 19)
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import every query module so that its registrations run."""
    from tillroll.plans import (  # noqa: F401
        q_customers, q_cleaning, q_sales, q_segments, q_churn, q_forecast, q_reports)
    if "analyst_monthly_trend" not in QUERIES:
        from tillroll.plans import analyst_sql
        analyst_sql.register_all()
