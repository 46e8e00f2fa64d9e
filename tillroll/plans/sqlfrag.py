"""SQL text fragments for the DuckDB oracle queries.

These are an independent statement of each operator's semantics in plain
SQL over the raw input tables; they share only the adapter mapping.
"""

from __future__ import annotations

TX_SELECT = """
  SELECT CAST(o.o_orderkey AS VARCHAR) AS TransactionID,
         CAST(o.o_custkey AS VARCHAR) AS CustomerID,
         CAST(l.l_partkey AS VARCHAR) AS ProductID,
         p.p_type AS ProductCategory,
         CAST(l.l_quantity AS INTEGER) AS Quantity,
         CAST(l.unit * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS UnitPrice,
         CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS Revenue,
         o.o_orderdate AS TransactionDate,
         n.n_name AS Country,
         o.o_orderpriority AS PaymentMethod,
         l.l_orderkey, l.l_partkey, l.l_suppkey
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS unit
        FROM lineitem) l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
"""

TX_CTE = f"transactions AS ({TX_SELECT})"

PURCHASES_CTE = """purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS TransactionID, CAST(user_id AS VARCHAR) AS CustomerID,
         ts AS TransactionDate, CAST(value AS DECIMAL(12,2)) AS Revenue
  FROM events WHERE event_type = 'purchase')"""

DIRTY_CTE = """dirty AS (
  SELECT TransactionID,
         CASE WHEN l_partkey % 333 = 0 THEN NULL ELSE CustomerID END AS CustomerID,
         ProductID, ProductCategory,
         CASE WHEN l_suppkey % 50 = 7 THEN -Quantity ELSE Quantity END AS Quantity,
         CASE WHEN l_partkey % 500 = 3 THEN -UnitPrice ELSE UnitPrice END AS UnitPrice,
         TransactionDate, Country, PaymentMethod
  FROM transactions
  UNION ALL
  SELECT TransactionID,
         CASE WHEN l_partkey % 333 = 0 THEN NULL ELSE CustomerID END,
         ProductID, ProductCategory,
         CASE WHEN l_suppkey % 50 = 7 THEN -Quantity ELSE Quantity END,
         CASE WHEN l_partkey % 500 = 3 THEN -UnitPrice ELSE UnitPrice END,
         TransactionDate, Country, PaymentMethod
  FROM transactions WHERE l_orderkey % 200 = 0)"""

DAY_US = "86400000000"


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS BIGINT)"


def div_half_up(num: str, den: str) -> str:
    """Exact round(num/den) half away from zero, for num >= 0, den > 0."""
    return f"((2 * ({num}) + ({den})) // (2 * ({den})))"


def div_half_even(num: str, den: str) -> str:
    """Exact round(num/den) half to even, for num >= 0, den > 0."""
    q = f"(({num}) // ({den}))"
    r2 = f"(2 * (({num}) - {q} * ({den})))"
    return (f"({q} + CASE WHEN {r2} > ({den}) THEN 1 "
            f"WHEN {r2} = ({den}) AND {q} % 2 = 1 THEN 1 ELSE 0 END)")


def money(cents_expr: str) -> str:
    return f"(CAST({cents_expr} AS DOUBLE) / 100.0)"


def elapsed_days(start: str, end: str) -> str:
    return f"((epoch_us({end}) - epoch_us({start})) // {DAY_US})"


def ts_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def date_text(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def mode_cte(name: str, source: str, key: str, col: str) -> str:
    """Deterministic mode per key: highest count, then lowest value."""
    return f"""{name} AS (
  SELECT {key}, {col} FROM (
    SELECT {key}, {col},
           row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {col}) AS rn
    FROM {source} WHERE {col} IS NOT NULL GROUP BY {key}, {col}) WHERE rn = 1)"""


def features_ctes() -> list[str]:
    """CTEs ending in ``features``: the pipeline customer table with exact
    decimal Monetary/AvgOrderValue and timestamp extremes."""
    return [
        TX_CTE,
        """agg AS (
  SELECT CustomerID, max(TransactionDate) AS last_ts, min(TransactionDate) AS first_ts,
         count(DISTINCT TransactionID) AS Frequency, sum(Revenue) AS Monetary,
         CAST(sum(Quantity) AS BIGINT) AS TotalProducts,
         count(DISTINCT ProductCategory) AS UniqueCategories
  FROM transactions GROUP BY CustomerID)""",
        "snap AS (SELECT max(TransactionDate) + INTERVAL 1 DAY AS s FROM transactions)",
        mode_cte("m_cat", "transactions", "CustomerID", "ProductCategory"),
        mode_cte("m_pay", "transactions", "CustomerID", "PaymentMethod"),
        mode_cte("m_cty", "transactions", "CustomerID", "Country"),
        f"""features AS (
  SELECT a.CustomerID, a.last_ts, a.first_ts, a.Frequency, a.Monetary, a.TotalProducts,
         a.UniqueCategories, mc.ProductCategory AS PrimaryCategory,
         mp.PaymentMethod AS PreferredPaymentMethod, mo.Country AS Country,
         {elapsed_days('a.last_ts', '(SELECT s FROM snap)')} AS Recency,
         {elapsed_days('a.first_ts', '(SELECT s FROM snap)')} AS CustomerTenureDays,
         CAST({div_half_even(cents('a.Monetary'), 'a.Frequency')} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2))
           AS AvgOrderValue
  FROM agg a
  LEFT JOIN m_cat mc ON mc.CustomerID = a.CustomerID
  LEFT JOIN m_pay mp ON mp.CustomerID = a.CustomerID
  LEFT JOIN m_cty mo ON mo.CustomerID = a.CustomerID)""",
    ]
