"""Distributed running totals over an ordered key, and exact quantiles.

``running_totals`` is a two-level prefix sum: the rows (one per distinct
key) are range-partitioned with sampled boundaries (a key never spans two
partitions), a window per partition gives the running sums inside it, and
a window over the per-partition totals (one row per partition, broadcast)
gives each partition's offset.  The partitioned table is checkpointed so the
windowed side and the offsets side see the same partition ids.  No window
ever holds the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize


def running_totals(df: DataFrame, keys, sums: list[str], descending: bool = False,
                   prefix: str = "Cum") -> DataFrame:
    """Add ``{prefix}{c}`` = sum of ``c`` over all rows whose key tuple is at
    or before this row's in the given order (key tuples must be distinct)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(k).desc() if descending else F.col(k).asc() for k in keys]
    # no fixed count: adaptive execution may merge adjacent ranges, which keeps
    # partition ids in key order
    b = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    b = materialize(b.withColumns({f"_in{c}": F.sum(c).over(within) for c in sums}))
    totals = b.groupBy("_part").agg(*[F.sum(c).alias(f"_t{c}") for c in sums])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_t{c}").over(before), F.lit(0)).alias(f"_o{c}")
                                       for c in sums])
    out = b.join(F.broadcast(offsets), "_part")
    out = out.withColumns({f"{prefix}{c}": F.col(f"_in{c}") + F.col(f"_o{c}") for c in sums})
    return out.drop("_part", *[f"_in{c}" for c in sums], *[f"_o{c}" for c in sums])


def exact_quantiles(long_df: DataFrame, group: str = "column", value: str = "v",
                    probs=(0.25, 0.5, 0.75), count: str | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value`` per ``group`` (nulls
    ignored), one row per group with columns ``q0, q1, ...``.

    With n values sorted x_0..x_{n-1}, the p-quantile sits at position
    p(n-1) between ranks lo = floor and hi = ceil:
    x_lo + (x_hi - x_lo)(pos - lo).  Values are counted per distinct
    (group, value), one running count over (group, value) order locates the
    ranks (minus the rows of earlier groups), and only the rows holding a
    wanted rank are kept.  Every group is handled in the same pass.
    With ``count`` the rows are distinct values already, counted in that column.
    """
    counts = long_df.select(group, F.col(value).cast("double").alias("v"), *([F.col(count).alias("n")] if count else []))
    counts = counts.filter(F.col("v").isNotNull())
    if not count:
        counts = materialize(counts.groupBy(group, "v").agg(F.count(F.lit(1)).alias("n")))  # read three times below
    per_group = counts.groupBy(group).agg(F.sum("n").alias("_ng"))
    start = per_group.withColumn(
        "_start", F.coalesce(F.sum("_ng").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)),
                             F.lit(0)))
    run = (running_totals(counts, [group, "v"], ["n"])
           .join(F.broadcast(start), group)  # one row per group
           .withColumn("_cum", F.col("Cumn") - F.col("_start")))
    aggs, picks = [], []
    for i, p in enumerate(probs):
        pos = (F.col("_ng") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        inside = lambda r: (F.col("_cum") - F.col("n") <= r) & (r < F.col("_cum"))
        aggs += [F.max(F.when(inside(lo), F.col("v"))).alias(f"_lo{i}"),
                 F.max(F.when(inside(hi), F.col("v"))).alias(f"_hi{i}"),
                 F.first(pos - lo).alias(f"_f{i}")]
        picks.append(i)
    found = run.groupBy(group).agg(*aggs)
    return found.select(group, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
        for i in picks])
