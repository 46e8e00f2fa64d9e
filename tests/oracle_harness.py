"""Run registered Spark queries next to their DuckDB oracle SQL and compare
column names, row counts and exact (order-insensitive) values.

    python -m tests.oracle_harness [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb
import pandas as pd

from tillroll.sources.tables import TABLES


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> list[str]:
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return [f"columns differ: spark={sorted(spark_pdf.columns)} duck={sorted(duck_pdf.columns)}"]
    if len(spark_pdf) != len(duck_pdf):
        problems.append(f"row count spark={len(spark_pdf)} duck={len(duck_pdf)}")
    cols, a = _rows(spark_pdf)
    _, b = _rows(duck_pdf)
    bad = 0
    for ra, rb in zip(a, b):
        if ra != rb:
            bad += 1
            if bad <= 3:
                diff = {c: (x, y) for c, x, y in zip(cols, ra, rb) if x != y}
                problems.append(f"row mismatch: {diff}")
    if bad:
        problems.append(f"{bad} mismatching rows of {len(a)}")
    for c in cols:
        if spark_pdf[c].isna().any():  # pandas has no integer column with nulls: Spark's becomes a float one
            continue
        ks, kd = spark_pdf[c].dtype.kind, duck_pdf[c].dtype.kind
        if ks != kd and not (len(spark_pdf) == 0):
            problems.append(f"dtype {c}: spark={spark_pdf[c].dtype} duck={duck_pdf[c].dtype}")
    return problems


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from tillroll.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    con = duck_connection(args.sf)
    names = args.names or list(queries)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            sp = queries[name](spark, args.sf).toPandas()
        except Exception as exc:  # report and continue
            print(f"FAIL {name}: spark error {type(exc).__name__}: {str(exc)[:400]}")
            failed += 1
            continue
        t1 = time.time()
        if name not in oracle:
            print(f"ROWS {name}: {len(sp)} rows, no oracle ({t1 - t0:.1f}s)")
            continue
        try:
            dk = con.sql(oracle[name]).df()
        except Exception as exc:
            print(f"FAIL {name}: duckdb error {str(exc)[:400]}")
            failed += 1
            continue
        probs = compare(sp, dk)
        status = "OK  " if not probs else "FAIL"
        failed += bool(probs)
        print(f"{status} {name}: {len(sp)} rows ({t1 - t0:.1f}s)" + "".join("\n     " + p for p in probs))
    print(f"{len(names) - failed}/{len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
