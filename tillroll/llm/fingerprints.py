"""Document fingerprints in DataFrame functions alone: SimHash by packed vote
counters, near neighbours through permuted block tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import hex16, materialize, table

BITS = 64
RADIUS = 3
#: Blocks of a fingerprint; a table fixes ``BLOCKS - RADIUS`` of them.
BLOCKS = 6
_PAIR = 0x0000000100000001  # two 32-bit vote counters in a long
MOST = 1 << 31  # weight that a counter holds


def terms(text: Column) -> Column:
    """Array of (a, b): each word of the lower-cased text with the word after it (null for the last)."""
    words = F.split(F.regexp_replace(F.lower(text), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""), r"[\x20\x09-\x0D]+")
    return F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.size(words)).alias("b"))


def simhash(rows: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """(keys, fp): the weighted SimHash of ``text_col`` per group of ``keys``.

    A term is a word with its follower; its weight is its number of characters,
    at most 64, so that longer, rarer words count for more.  Every term votes
    its weight for each bit of its hash; a bit is set when it gets over half
    of all weight.  Thirty-two sums hold the 64 counters, two to a long; a
    group whose weight reaches 2^31, where a counter could run into its
    neighbour, is an error, never a wrong fingerprint.  A text without words
    votes nothing and gets zero.
    """
    words = rows.select(*keys, F.inline(terms(F.col(text_col)))).toDF(*keys, "_a", "_b")
    weight = F.least(F.lit(64), F.length("_a") + F.coalesce(F.length("_b"), F.lit(0))).cast("long")
    votes = words.select(*keys, F.xxhash64("_a", "_b").alias("_h"), weight.alias("_w"))
    sums = [F.sum(F.shiftrightunsigned("_h", g).bitwiseAND(F.lit(_PAIR)) * F.col("_w")).alias(f"_v{g}")
            for g in range(BITS // 2)]
    counted = votes.groupBy(*keys).agg(F.sum("_w").alias("_n"), *sums)
    counted = counted.withColumn("_n", F.when(F.col("_n") < F.lit(MOST).cast("long"), F.col("_n")).otherwise(
        F.raise_error(F.lit("the words of one group weigh 2^31 or more"))))
    fp = F.lit(0).cast("long")
    for g in range(BITS // 2):
        low = F.col(f"_v{g}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(f"_v{g}", 32)
        for bit, n in ((g, low), (g + 32, high)):
            one = F.lit((1 << bit) - (1 << 64) if bit == 63 else 1 << bit).cast("long")
            fp = fp.bitwiseOR(F.when(n * 2 > F.col("_n"), one).otherwise(F.lit(0).cast("long")))
    return counted.select(*keys, fp.alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _tables() -> list[int]:
    """Masks of the permuted tables: each keeps ``BLOCKS - RADIUS`` whole blocks.
    Two fingerprints within the radius differ in at most RADIUS blocks, so one
    table at least sees them equal."""
    edges = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(BLOCKS)]
    masks = [sum(c) for c in combinations(blocks, BLOCKS - RADIUS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _bucketed(fps: DataFrame, name: str) -> DataFrame:
    masks = F.array(*(F.lit(m).cast("long") for m in _tables()))
    rows = fps.select(F.col("fp").alias(name), F.posexplode(masks).alias("t", "mask"))
    return rows.select("t", F.col(name).bitwiseAND(F.col("mask")).alias("bucket"), name)


def within_radius(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(query, found) for distinct fingerprints ``fp`` of either side at most
    RADIUS bits apart, each pair once: only the first table whose blocks
    agree reports it."""
    pairs = _bucketed(queries, "query").join(_bucketed(index, "found"), ["t", "bucket"])
    diff = F.col("query").bitwiseXOR(F.col("found"))
    first = F.array_position(F.array(*(diff.bitwiseAND(F.lit(m).cast("long")) == 0 for m in _tables())), True) - 1
    return pairs.where((F.bit_count(diff) <= RADIUS) & (first == F.col("t"))).select("query", "found")


def _document_key(id_col: str) -> Column:
    return F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("text")))


def _parts(digest: Column, name: str, n: int) -> list[Column]:
    """A hexadecimal digest as n longs of 16 digits each: name0, name1, ..."""
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long").alias(f"{name}{i}") for i in range(n)]


def ring(heads: DataFrame) -> DataFrame:
    """``heads`` (key, doc_id, ...) with ``next_key``: the key after it in
    ascending (doc_id, key), nulls last, and the first after the last.

    The heads are range-partitioned, numbered in place and stored; only the
    first head of each partition meets the others, one row per partition.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("key")]
    n = int(heads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = heads.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("pos", F.monotonically_increasing_id()), "ring")
    placed = placed.withColumn("part", F.shiftright("pos", 33))
    firsts = placed.groupBy("part").agg(F.min_by("key", "pos").alias("first_key"))
    by_part = Window.orderBy("part")  # one row per partition
    lowest = F.first("first_key").over(by_part)
    firsts = firsts.select("part", F.coalesce(F.lead("first_key").over(by_part), lowest).alias("after"))
    inside = F.lead("key").over(Window.partitionBy("part").orderBy("pos"))
    joined = placed.withColumn("inside", inside).join(firsts, "part")
    return joined.withColumn("next_key", F.coalesce("inside", "after")).drop("part", "pos", "inside", "after")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text.

    The edited text replaces the last floor(n_chars / 4) code points by the
    first as many (or all) of the next document in ascending ``doc_id``; the
    first follows the last.  A null text is empty.  Documents without an id
    come last in the order; documents that share an id follow each other by a
    digest of id and text; rows equal in id and text are one document listed
    again: its words vote once, and each row gets the same result.  A single
    document follows itself; an empty table gives no rows; a text may have up
    to 2^29 characters (see ``simhash``).
    Other columns are not read.  Returns one row per input row: doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and ``within_radius``: how many other rows have a fingerprint
    at most RADIUS bits away, searched for every doc_id divisible by 50 and
    null for the rest.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.select(_document_key("doc_id").alias("key"), "doc_id", "text")
    heads = texts.groupBy("key", "doc_id", F.length("text").alias("n_chars")).agg(F.count("*").alias("copies"))
    heads = materialize(ring(heads), "heads")
    texts = texts.groupBy("key").agg(F.first("text").alias("text"))  # one row a document, whatever its copies

    gives = heads.select(F.col("next_key").alias("key"), F.col("key").alias("to_key"),
                         F.floor(F.col("n_chars") / 4).cast("int").alias("taken"))
    sent = (texts.join(gives, "key").groupBy("to_key")
            .agg(F.first(F.expr("substring(text, 1, taken)")).alias("tail")))
    sent = sent.select(F.col("to_key").alias("key"), "tail")
    n = F.length("text")
    both = texts.join(sent, "key").select(
        "key", "text", F.concat(F.expr("substring(text, 1, length(text) - int(floor(length(text) / 4)))"),
                                F.col("tail")).alias("edited"))
    # the votes of a side are counted under longs: the parts of its key's and its edited text's digests
    sides = both.select(*_parts(F.col("key"), "k", 2), *_parts(F.sha2("edited", 256), "s", 4), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("text").alias("body")),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("body")))).alias("s"))
    keys = ["k0", "k1", "s0", "s1", "s2", "s3", "side"]
    prints = materialize(simhash(sides.select(*keys[:-1], "s.side", "s.body"), keys, "body"), "prints")
    whole = lambda *parts: F.concat(*(hex16(F.col(c)) for c in parts))
    prints = prints.select(whole("k0", "k1").alias("key"), whole("s0", "s1", "s2", "s3").alias("sha"), "side", "fp")
    own = prints.where("side = 0").select("key", "sha", F.col("fp").alias("own_fp"))
    edited = prints.where("side = 1").select("key", F.col("fp").alias("edited_fp"))
    after = own.select(F.col("key").alias("next_key"), F.col("own_fp").alias("next_fp"))
    rows = heads.join(own, "key").join(edited, "key").join(after, "next_key")

    index = rows.groupBy(F.col("own_fp").alias("fp")).agg(F.sum("copies").alias("rows"))
    asked = rows.where(F.col("doc_id") % 50 == 0).select(F.col("own_fp").alias("fp")).distinct()
    found = within_radius(asked, index.select("fp")).join(index.withColumnRenamed("fp", "found"), "found")
    found = found.groupBy("query").agg((F.sum("rows") - 1).alias("others"))
    rows = rows.join(found, rows["own_fp"] == found["query"], "left")
    others = F.when(F.col("doc_id") % 50 == 0, F.col("others"))
    return rows.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        hex16(F.col("own_fp")).alias("fingerprint"), hex16(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("own_fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("own_fp"), F.col("next_fp")).alias("near_next"), others.alias("within_radius"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy")).drop("_copy")


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
