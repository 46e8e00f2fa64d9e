"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import WORD, materialize, table

WEIGHTS = (3, 1, 2)
EPOCHS = 2
#: Hex digits of the shuffle hash that name a slice: 4,096 slices a source, so
#: a source's running total never needs the source in one task.
SLICE_DIGITS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: int) -> Column:
    """md5 of seed, id and text: rows without id, or of one id, fall apart by their texts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text, F.lit("")))))


def targets(sources: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in ascending code-point order, null last, weigh 3, 1, 2, and so
    on; together they share 150 % of all sizes.  No target passes EPOCHS times
    its source's size: in ascending order of size per weight, a source is
    capped exactly when the level that the sources from it on could share
    evenly lies above its cap, and that level is highest at the first source
    that isn't capped.  One row per source; the windows run over those rows.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (number % len(WEIGHTS) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * EPOCHS)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    all_rows = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(all_rows) * 1.5
    rows = rows.withColumn("level", (budget - before) / open_weight)
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.max("level").over(all_rows))
    return rows.select("source", "source_size", target.alias("target"))


def serve(docs: DataFrame, seed: int = 17, carry: list[str] | None = None) -> DataFrame:
    """(_row, source, size, source_size, target, start) for every row: where its
    first word stands in its source's shuffled order.  ``_row`` has the columns
    named by ``carry``, all of them by default.

    Rows of a source are ordered by an md5 of seed, ``doc_id`` and text.  Rows
    equal in id and text follow one another in any order; as each takes as
    many words, only their other columns could tell reruns apart.  Running
    totals are taken within slices of the hash, and slices are offset by the
    totals of those before.  A slice's name holds its source too: one key that
    is never null serves the running totals and the join with the offsets, so
    that the rows with their texts are shuffled and sorted once for both.
    """
    sized = docs.select(F.struct(*(carry or ["*"])).alias("_row"), F.col("source"), n_words(F.col("text")).alias("size"),
                        shuffle_key(F.col("doc_id"), F.col("text"), seed).alias("key"))
    of_source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    sized = sized.withColumn("slice", F.concat(F.substring("key", 1, SLICE_DIGITS), of_source))
    slices = materialize(sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "slices")
    shares = targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("source", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("offset"))
    slices = slices.alias("a").join(shares.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        F.col("slice").alias("_slice"), "offset", "source_size", "target")
    inside = Window.partitionBy("slice").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(slices, F.col("slice") == F.col("_slice"))
    return rows.select("_row", "source", "size", "source_size", "target", (F.col("offset") + F.col("before")).alias("start"))


def taken_words(epoch: int) -> Column:
    """Words of the row's copy in ``epoch`` that finish by virtual time 1.

    A source is served ``target`` words per unit of virtual time, so the word
    that ends its first n words has virtual finish time n / target.  Targets
    add up to the budget: all sources spend it exactly at time 1, and cutting
    the globally sorted stream at the budget is cutting it there.
    """
    left = F.floor("target") - F.col("source_size") * epoch - F.col("start")
    return F.least(F.greatest(left, F.lit(0)), F.col("size")).cast("long")


def stream(served: DataFrame) -> DataFrame:
    """The rows of ``serve`` as copies in ascending virtual finish time, with
    ``finish``, ``epoch`` and ``taken``.

    A copy's virtual finish time is its source's running words at its last
    taken word over the source's target.  The copies are range-partitioned and
    sorted by it, and end at time 1, where the budget is spent.
    """
    copies = F.array(*(F.struct(F.lit(e).alias("epoch"), taken_words(e).alias("taken")) for e in range(EPOCHS)))
    finish = (F.col("source_size") * F.col("epoch") + F.col("start") + F.col("taken")) / F.col("target")
    rows = served.select("*", F.inline(copies)).where("taken > 0").withColumn("finish", finish)
    order = ["finish", "source", "epoch"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _first_words(text: Column, n: Column) -> Column:
    words = F.split(F.regexp_replace(text, r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+")
    return F.concat_ws(" ", F.slice(words, F.lit(1), n.cast("int")))


def mix(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mixture: copies of ``docs`` rows in ascending virtual finish time.

    Each row keeps its columns and gets ``mix_finish`` (running words of its
    source at its last taken word, over the source's target), ``mix_epoch``
    (0 or 1) and ``mix_taken`` (words taken; less than its size only for the
    copy in service when the budget ends, at most one a source).  Columns of
    those names that ``docs`` already has are replaced.  The text of a copy
    that is cut holds its taken words, joined by single spaces.  Copies of
    which nothing is taken, and so texts without words, are left out.  A null
    source is a source of its own.  The output is range-partitioned and sorted by
    (mix_finish, source, epoch); an empty table gives an empty result.
    """
    rows = stream(serve(docs, seed))
    cut = F.when(F.col("taken") < F.col("size"), _first_words(F.col("_row.text"), F.col("taken"))).otherwise(F.col("_row.text"))
    names = [c for c in docs.columns if c not in ("mix_finish", "mix_epoch", "mix_taken")]
    return rows.select(*((cut if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in names), F.col("finish").alias("mix_finish"),
                       F.col("epoch").alias("mix_epoch"), F.col("taken").alias("mix_taken"))


def mixed_words(docs: DataFrame, carry: list[str], seed: int = 17) -> DataFrame:
    """``carry`` columns, size, source_size, target and taken for every row of
    ``docs``: the words that the mixture's copies of the row take in all.

    A row with words is known by its source and its place in the source's
    order; rows without words take part in no copy and take 0.
    """
    served = materialize(serve(docs, seed, carry), "served")
    taken = stream(served).groupBy(F.col("source").alias("_source"), F.col("start").alias("_start")).agg(
        F.sum("taken").alias("_taken"))
    met = served.where("size > 0").join(
        taken, F.col("source").eqNullSafe(F.col("_source")) & (F.col("start") == F.col("_start")), "left")
    rows = met.drop("_source", "_start").unionByName(served.where("size = 0").withColumn("_taken", F.lit(0).cast("long")))
    return rows.select("_row.*", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mixture takes."""
    return mixed_words(table(spark, sf_dir, "documents"), ["doc_id"])


OP9_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('17|' || COALESCE(CAST(doc_id AS VARCHAR), '') || '|' || md5(COALESCE(text, ''))) AS k
  FROM documents),
s AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CASE (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM d GROUP BY source),
l AS (
  SELECT source, source_size, w,
         ((SUM(source_size) OVER ()) * CAST(1.5 AS DOUBLE)
          - COALESCE(SUM(2 * source_size) OVER (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (SUM(w) OVER (ORDER BY (2 * source_size)::DOUBLE / w, source NULLS LAST
                         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM s),
t AS (SELECT source, source_size, LEAST((2 * source_size)::DOUBLE, w * MAX(level) OVER ()) AS target FROM l),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CAST(FLOOR(t.target) AS BIGINT)
         - CAST(COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS room
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       LEAST(GREATEST(room, 0), size) + LEAST(GREATEST(room - source_size, 0), size) AS taken
FROM r
"""
