"""CSV edges (S1, S2, S4): explicit schemas, pandas-compatible null tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.cleaning import normalise_null_tokens

RAW_SCHEMA = ("TransactionID string, CustomerID string, ProductID string, ProductCategory string, "
              "Quantity int, UnitPrice double, TransactionDate string, Country string, PaymentMethod string")


def read_raw_csv(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass); text
    null tokens become null as pandas would read them.  A missing path
    raises the reader's AnalysisException."""
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return normalise_null_tokens(df, text_cols)


#: Typed raw columns and how their text is read; a text that can't be read
#: rejects its row.
TYPED = {"Quantity": "int", "UnitPrice": "double", "TransactionDate": "timestamp_ntz"}
#: What a typed row must fit into: the price's and the row revenue's decimals.
PRICE, REVENUE = "decimal(10,2)", "decimal(12,2)"
RECORD = "RawRecord"


def read_raw_text(spark: SparkSession, path: str, header: bool = True, multiline: bool = True) -> DataFrame:
    """The raw CSV as text, null tokens made null: what arrived, untouched.

    Fields may be quoted, with doubled quotes and line breaks inside.  A record
    with more or fewer fields than the header keeps its text in ``RawRecord``
    (null for sound records).  With ``multiline`` a file is one task's; a few
    very large files without line breaks in fields read in parallel without it.
    """
    names = [f.split()[0] for f in RAW_SCHEMA.split(", ")]
    df = (spark.read.schema(", ".join(f"{n} string" for n in [*names, RECORD])).option("header", header)
          .option("quote", '"').option("escape", '"').option("multiLine", multiline).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", RECORD).option("columnPruning", False).csv(path))
    return normalise_null_tokens(df, names)


def _reject_reason() -> F.Column:
    """The first fault of a row: its structure, a field that can't be read, or one beyond its range."""
    price = "try_cast(bround(try_cast(UnitPrice AS double), 2) AS {})"
    beyond = {"UnitPrice": f"UnitPrice IS NOT NULL AND {price.format(PRICE)} IS NULL",
              "Revenue": f"UnitPrice IS NOT NULL AND Quantity IS NOT NULL AND "
                         f"try_cast(try_cast(Quantity AS int) * {price.format(PRICE)} AS {REVENUE}) IS NULL"}
    out = F.lit(None).cast("string")
    for name, test in reversed(list(beyond.items())):
        out = F.when(F.expr(test), f"{name} out of range").otherwise(out)
    for name, kind in reversed(list(TYPED.items())):
        unreadable = F.col(name).isNotNull() & F.expr(f"try_cast({name} AS {kind})").isNull()
        out = F.when(unreadable, f"{name} is not a {kind}").otherwise(out)
    return F.when(F.col(RECORD).isNotNull(), "wrong number of fields").otherwise(out)


def accepted(raw_text: DataFrame) -> DataFrame:
    """C4: rows whose fields can all be read, typed; nulls stay nulls."""
    typed = {name: F.expr(f"try_cast({name} AS {kind})") for name, kind in TYPED.items()}
    return raw_text.where(_reject_reason().isNull()).withColumns(typed).drop(RECORD)


def rejected(raw_text: DataFrame) -> DataFrame:
    """C4: the other rows as they arrived, with their first fault."""
    return raw_text.withColumn("RejectReason", _reject_reason()).where("RejectReason IS NOT NULL")


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, overwrite; one file per partition; quotes inside fields are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
