"""Small inputs that every operator must take: nulls, empty and long texts, repeats, clashing columns."""

import random
from contextlib import contextmanager

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside; a column of such a name must not disturb them.
CLASHING = ("_row", "id", "key", "fp", "component", "size", "slice", "line", "lines", "h1", "text_key", "vertex",
            "score", "features", "item_id", "address", "group", "start", "target", "epoch", "taken", "pos")


def words(rng, n, vocabulary="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()):
    return " ".join(rng.choice(vocabulary) + str(rng.randrange(400)) for _ in range(n))


def odd_documents(seed=1):
    rng = random.Random(seed)
    base = words(rng, 60)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, base + " extra", "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, "   \n\t ", "de", "b", 6),
        (None, base, "en", "a", 1), (None, None, None, None, None), (7, "x", "en", "c", 1), (7, "x", "en", "c", 1),
        (8, words(rng, 30_000), "en", "a", 9), (9, "Aé中 \U0001f600 b", "fr", "c", 5),
        (50, words(rng, 40), "de", None, 1), (51, words(rng, 40), "de", "a", 1),
    ]
    return rows


def frame(spark, rows, clashing=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df


def empty(spark):
    return frame(spark, [])


@contextmanager
def everything_is_skewed(spark):
    """Small thresholds, under which adaptive execution splits each join that it can."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    """The physical plan after the rows have been computed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
