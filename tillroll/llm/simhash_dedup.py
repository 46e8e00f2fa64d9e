"""SimHash near-duplicates found through a byte-position inverted index.

A 64-bit fingerprint is 8 positional bytes.  Two fingerprints within ``radius``
bits differ in at most ``radius`` bytes, so they share at least
``8 - radius`` positional bytes: the guaranteed minimum.  Posting lists are
keyed by several positions at once, chosen so that every pair that reaches the
minimum meets in at least one list; each met pair's shared bytes are tallied,
pairs below the minimum go, and the bit distance of the rest is verified.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import hex16, materialize, table
from tillroll.llm.components import connected_components

BYTES = 8
SEED = 42
#: A posting list of at most this many fingerprints is compared pair by pair;
#: a longer one goes through ``_star_edges``, which finds the same links
#: without pairs.  It changes cost, never the components.
LIST_PAIRS = 64
_LANES = np.uint64(0x0001000100010001)
_LANE_ROWS = 65_535


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of ``text`` as an unsigned 64-bit number.

    Words are runs of bytes other than ASCII white space after lower-casing
    A-Z; terms are ``shingle`` consecutive words joined by a space, repeats
    included, or the whole sequence when there are fewer words.  A bit is set
    when it is set in over half of the terms' XXH64.  No words: zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    terms = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), terms),
                         dtype=np.uint64, count=len(words) - shingle + 1)
    votes = np.zeros((16, 4), dtype=np.int64)  # 4 counters of 16 bits in each sum
    for start in range(0, len(hashes), _LANE_ROWS):
        part = hashes[start:start + _LANE_ROWS]
        for bit in range(16):
            total = int(((part >> np.uint64(bit)) & _LANES).sum(dtype=np.uint64))
            votes[bit] += [(total >> (16 * lane)) & 0xFFFF for lane in range(4)]
    out = 0
    for bit, lane in zip(*np.nonzero(2 * votes > len(hashes)), strict=True):
        out |= 1 << int(bit + 16 * lane)
    return out


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """(id, text_key, fp) for every row of ``docs``: a hash of the text, and
    the fingerprint's bits as a signed long."""
    def run(batches):
        for batch in batches:
            ids, keys, texts = batch.columns
            fps = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(fps.view(np.int64))],
                                             names=["id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"),
                       F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, text_key bigint, fp bigint")


def _byte(fp: Column, position: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(F.lit(255))


def position_sets(minimum: int) -> list[tuple[int, ...]]:
    """Sets of ``minimum - 1`` byte positions of which every choice of
    ``minimum`` positions contains at least one (greedy cover)."""
    size = max(1, minimum - 1)
    todo = set(combinations(range(BYTES), minimum))
    chosen = []
    while todo:
        best = max(combinations(range(BYTES), size), key=lambda s: sum(set(s) <= set(t) for t in todo))
        chosen.append(best)
        todo = {t for t in todo if not set(best) <= set(t)}
    return chosen


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _mask(positions: tuple[int, ...]) -> int:
    return _signed(sum(255 << (8 * p) for p in positions))


def _postings(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """One row per fingerprint and position set: the set's mask, the bytes it covers."""
    masks = F.array(*(F.lit(_mask(s)).cast("long") for s in sets))
    rows = fps.select("fp", F.explode(masks).alias("mask"))
    return rows.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("posting"), "fp")


def _tally(a: Column, b: Column) -> Column:
    """Positional bytes that two fingerprints share."""
    diff = a.bitwiseXOR(b)
    return sum(((_byte(diff, p) == 0).cast("int") for p in range(BYTES)), F.lit(0))


def _pair_edges(lists: DataFrame, radius: int) -> DataFrame:
    keys = [c for c in lists.columns if c not in ("fp", "n")]
    left = lists.select(*keys, F.col("fp").alias("src"))
    right = lists.select(*keys, F.col("fp").alias("dst"))
    pairs = left.join(right, keys).where("src < dst")
    kept = pairs.where(_tally(F.col("src"), F.col("dst")) >= BYTES - radius)
    return kept.where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius).select("src", "dst")


def _flips(positions: tuple[int, ...], most: int) -> list[tuple[int, int, int]]:
    """(mask, number of flips, flipped bits) over the bits that ``positions`` leave free."""
    free = [8 * p + b for p in range(BYTES) if p not in positions for b in range(8)]
    return [(_mask(positions), k, _signed(sum(1 << b for b in bits)))
            for k in range(most + 1) for bits in combinations(free, k)]


def _star_edges(lists: DataFrame, sets: list[tuple[int, ...]], radius: int) -> DataFrame:
    """Links of long posting lists without pairs, linear in the list.

    Two members within ``radius`` bits have a centre at most ``near`` flips
    from one and ``radius - near`` from the other.  Members at most ``near``
    flips from a centre are ``2 * near <= radius`` bits apart, so they all
    link to the least of them, and so do the members further out.  The flips
    depend on the radius alone, so their table is small for any corpus.
    """
    near = radius // 2
    flips = lists.sparkSession.createDataFrame(
        [f for s in sets for f in _flips(s, radius - near)], "mask bigint, k int, flip bigint")
    around = lists.select("mask", "fp").join(F.broadcast(flips), "mask").select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"), "k", "fp")
    leaders = materialize(around.where(F.col("k") <= near).groupBy("centre").agg(F.min("fp").alias("src")), "leaders")
    return (around.select("centre", F.col("fp").alias("dst")).join(leaders, "centre")
            .where("src <> dst").select("src", "dst").distinct())


def _with_counts(lists: DataFrame) -> DataFrame:
    """Postings of lists with two members or more, and the list's length ``n``.

    The lengths are stored first: a join with an aggregate on its own key
    can't be split where one list is very long.
    """
    counts = lists.groupBy("mask", "posting").agg(F.count("*").alias("n")).where("n > 1")
    return lists.join(materialize(counts, "list-lengths"), ["mask", "posting"])


def fingerprint_edges(fps: DataFrame, radius: int) -> DataFrame:
    """Edges (src, dst) between distinct ``fp`` whose connected components are
    those of all pairs at most ``radius`` bits apart."""
    if not 0 <= radius < BYTES:
        raise ValueError("the radius must leave at least one shared byte")
    if radius == 0:
        return fps.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).where(F.lit(False))
    minimum = BYTES - radius
    sets = position_sets(minimum)
    lists = _postings(fps, sets)
    lists = materialize(_with_counts(lists), "postings")
    edges = _pair_edges(lists.where(F.col("n") <= LIST_PAIRS), radius)
    # Long lists: pairs share `minimum` bytes, one more than the list's own.
    long_lists = lists.where(F.col("n") > LIST_PAIRS).select("fp").distinct()
    if not long_lists.isEmpty():
        full = list(combinations(range(BYTES), minimum))
        deeper = _postings(long_lists, full)
        deeper = materialize(_with_counts(deeper), "postings")
        edges = edges.unionByName(_pair_edges(deeper.where(F.col("n") <= LIST_PAIRS), radius))
        edges = edges.unionByName(_star_edges(deeper.where(F.col("n") > LIST_PAIRS), full, radius))
    return edges


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """(id, text_key, fp, component, component_id) for every row."""
    rows = materialize(with_fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = rows.groupBy("fp").agg(F.min("id").alias("low"))
    labels = connected_components(fingerprint_edges(fps.select("fp"), radius))
    joined = fps.join(labels, fps["fp"] == labels["vertex"], "left")
    joined = joined.select("fp", "low", F.coalesce("component", "fp").alias("component"))
    lows = materialize(joined.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
    return rows.join(joined.join(lows, "component").select("fp", "component", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """(id_col, fp, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits.  A null or wordless text has fingerprint zero
    and is linked like any other; rows with a null id keep their row and count
    in no minimum; repeated rows come back as often as they came; other
    columns are not read; an empty table gives an empty result.
    """
    found = _components(docs, id_col, text_col, shingle, radius)
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component, all columns unchanged.

    The row with the smallest id stays; rows without an id come last, and
    between rows of one id the text's hash decides.  Of fully repeated rows
    one stays.
    """
    found = _components(docs, id_col, text_col, shingle, radius)
    first = found.groupBy("component").agg(
        F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("text_key"))).alias("w"))
    keep = first.select(_row_key(F.col("w.id"), F.col("w.text_key")).alias("_key"))
    packed = docs.select(F.struct("*").alias("_row"), _row_key(F.col(id_col), F.xxhash64(text_col)).alias("_key"))
    kept = packed.join(keep, "_key", "left_semi").groupBy("_key").agg(F.first("_row").alias("_row"))
    return kept.select("_row.*")


def _row_key(row_id: Column, text_key: Column) -> Column:
    return F.concat_ws("|", F.coalesce(row_id.cast("string"), F.lit("")), F.hex(text_key))


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash, and the near-duplicate component it belongs to."""
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return out.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
