"""Line de-duplication by a deletion-neighbourhood join.

Two lines one edit apart become equal when the differing character is deleted
from both (a replacement) or from the longer one (an insertion).  Lines emit
the hashes of such variants as keys, equal keys meet, and the later line of a
pair whose edit distance is verified goes.  A line emits variants only where
a half of it is shared with another line: one edit leaves the other half of
both lines equal, so nothing is missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, table

#: Shorter lines count as repeated only when they are equal: a single edit
#: makes another line of them.
MIN_FUZZY_CHARS = 20
#: What a line emits: itself, itself without one character (to meet a line one
#: shorter), or both with the position (to meet a line of its length).
WHOLE, SHORTENED, REPLACED = 0, 1, 2
PREFIX, SUFFIX = 0, 1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(line: str) -> str:
    """What lines are compared by: lower case, white space collapsed."""
    return " ".join(line.lower().split())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def line_hash(line: str) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(line.encode("utf-8", "surrogatepass"))
    return _signed(whole >> 64), _signed(whole & (1 << 64) - 1)


def half_keys(line: str) -> list[int]:
    """Keys of both halves, cut as for a partner of equal length (the first
    two) and for one that is a character shorter (the last two)."""
    if len(line) < MIN_FUZZY_CHARS:
        return []
    out = []
    for n in (len(line), len(line) - 1):
        half = n // 2
        for side, part in ((PREFIX, line[:half]), (SUFFIX, line[len(line) - (n - half):])):
            out.append(_signed(xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass"), 2 * n + side)))
    return out


def deletion_hashes(line: str) -> tuple[int, np.ndarray]:
    """Hash of the line, and of the line without each of its characters."""
    points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(points)
    with np.errstate(over="ignore"):
        mixed = (points + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        powers = np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, _BASE, dtype=np.uint64))))
        before = np.concatenate(([np.uint64(0)], np.cumsum(mixed * powers[:n], dtype=np.uint64)))
        # Behind a deleted character every power is one lower.
        lowered = np.concatenate(([np.uint64(0)], np.cumsum(mixed[1:] * powers[:n - 1], dtype=np.uint64)))
        without = before[:n] + lowered[n - 1] - lowered[:n]
    return int(before[n]), without


def variant_keys(line: str, halves: set[int]) -> list[tuple[int, int]]:
    """(key, kind) of the line's variants, given which of its ``half_keys``
    (0 to 3) another line shares: deletions lie in the half that isn't."""
    n = len(line)
    whole, without = deletion_hashes(line)
    sized = lambda value, length: _signed(xxhash.xxh3_64_intdigest(value.to_bytes(8, "little"), length))
    out = set()
    if halves & {0, 1}:
        out.add((sized(whole, n), WHOLE))
        low = 0 if 1 in halves else n // 2
        high = n if 0 in halves else n // 2
        out |= {(sized(int(without[i]), (n << 32) + i + 1), REPLACED) for i in range(low, high)}
    if halves & {2, 3}:
        half = (n - 1) // 2
        low = 0 if 3 in halves else half
        high = n if 2 in halves else half + 1
        out |= {(sized(int(v), n - 1), SHORTENED) for v in np.unique(without[low:high])}
    return list(out)


def within_one_edit(a: str, b: str) -> bool:
    """Levenshtein distance of at most 1."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a[at + 1:] == (b[at + 1:] if len(a) == len(b) else b[at:])


def _id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def _place(prefix: str = "") -> Column:
    """A line's place in the corpus: documents by id, nulls last, then line number."""
    return F.struct(F.col(f"{prefix}id").isNull().alias("no_id"), F.col(f"{prefix}id").alias("id"),
                    F.col(f"{prefix}line").alias("line"))


def _line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, line, h1, h2, halves) for every line that isn't blank;
    ``text_key`` is a hash of the text, which tells rows of one id apart."""
    def run(batches):
        for batch in batches:
            ids, lines, h1, h2, halves = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                for number, raw in enumerate((text.as_py() or "").split("\n")):
                    if line := normal(raw):
                        a, b = line_hash(line)
                        ids.append(row)
                        lines.append(number)
                        h1.append(a)
                        h2.append(b)
                        halves.append(half_keys(line))
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(2).take(take), pa.array(lines, pa.int32()),
                 pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(halves, pa.list_(pa.int64()))],
                names=["id", "text_key", "line", "h1", "h2", "halves"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key")).mapInArrow(
        run, f"id {_id_type(docs, id_col)}, text_key bigint, line int, h1 bigint, h2 bigint, halves array<bigint>")


def _shared_halves(distinct: DataFrame) -> DataFrame:
    """(h1, h2, first, halves): distinct lines that share a half with another, and which."""
    keys = distinct.select("h1", "h2", "first", F.posexplode("halves").alias("half", "key"))
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return keys.join(twice, "key").groupBy("h1", "h2", "first").agg(F.collect_list("half").alias("halves"))


def _texts_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``wanted`` (h1, h2, first, halves) with the normalised line, read from
    the document it stands in first.  A document's wanted lines, at most its
    own lines, travel to the document; a document listed again is read once a
    task."""
    per_doc = wanted.groupBy(F.col("first.id").alias("id"), F.col("first.text_key").alias("text_key")).agg(
        F.collect_list(F.struct("h1", "h2", F.col("first.line").alias("line"), "halves")).alias("lines"))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("doc_key"))
    joined = rows.join(per_doc, F.col("doc").eqNullSafe(F.col("id")) & (F.col("doc_key") == F.col("text_key"))).select(
        "id", "text", "lines", "text_key")
    kind = _id_type(docs, id_col)

    def run(batches):
        seen = set()
        for batch in batches:
            out = {name: [] for name in ("row", "h1", "h2", "line", "halves", "text")}
            for row, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                if key in seen:
                    continue
                seen.add(key)
                lines = (batch.column(1)[row].as_py() or "").split("\n")
                for want in batch.column(2)[row].as_py():
                    text = normal(lines[want["line"]]) if want["line"] < len(lines) else ""
                    if line_hash(text) == (want["h1"], want["h2"]):  # a text of equal text_key may differ
                        for name, value in (("row", row), ("text", text), *want.items()):
                            out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["line"], pa.int32()),
                 pa.array(out["h1"], pa.int64()), pa.array(out["h2"], pa.int64()),
                 pa.array(out["halves"], pa.list_(pa.int32())), pa.array(out["text"], pa.string())],
                names=["id", "line", "h1", "h2", "halves", "text"])

    return joined.mapInArrow(run, f"id {kind}, line int, h1 bigint, h2 bigint, halves array<int>, text string")


def _claims(texts: DataFrame) -> DataFrame:
    """(h1, h2, text, w1, w2): lines with an earlier line of an equal variant.

    A key's group holds lines that differ in one character alone, so its size
    is bounded by the alphabet and the length, not by the corpus.  The
    earliest line of the group speaks for all: no pairs are formed.
    """
    def run(batches):
        for batch in batches:
            rows, keys, kinds = [], [], []
            halves = batch.column(4).to_pylist()
            for row, text in enumerate(batch.column(5).to_pylist()):
                for key, kind in variant_keys(text, set(halves[row])):
                    rows.append(row)
                    keys.append(key)
                    kinds.append(kind)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(take) for i in range(4)), pa.array(keys, pa.int64()), pa.array(kinds, pa.int8())],
                names=["id", "line", "h1", "h2", "key", "kind"])

    kind = _id_type(texts, "id")
    variants = texts.select("id", "line", "h1", "h2", "halves", "text").mapInArrow(
        run, f"id {kind}, line int, h1 bigint, h2 bigint, key bigint, kind tinyint")
    keyed = variants.select("key", "kind", "h1", "h2", F.struct(_place().alias("place"), "h1", "h2").alias("me"))
    group = Window.partitionBy("key")
    of_kind = lambda k: F.min(F.when(F.col("kind") == k, F.col("me"))).over(group)
    met = keyed.select("h1", "h2", "me", F.when(F.col("kind") == REPLACED, of_kind(REPLACED))
                       .when(F.col("kind") == SHORTENED, of_kind(WHOLE)).otherwise(of_kind(SHORTENED)).alias("other"))
    return met.where(F.col("other") < F.col("me")).select(
        "h1", "h2", F.col("other.h1").alias("w1"), F.col("other.h2").alias("w2")).distinct()


def near_lines(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2) of distinct lines that an earlier line is one edit away from."""
    texts = materialize(_texts_of(docs, _shared_halves(distinct), id_col, text_col), "lines")
    own = texts.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    of = own.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), F.col("text").alias("w_text"))
    claims = _claims(texts).join(own, ["h1", "h2"]).join(of, ["w1", "w2"])

    def verify(batches):
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield batch.select([0, 1]).filter(pa.array([within_one_edit(x, y) for x, y in zip(a, b, strict=True)]))

    return claims.select("h1", "h2", "text", "w_text").mapInArrow(verify, "h1 bigint, h2 bigint").distinct()


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, lines): for each document that has any, the numbers and
    hashes of the lines that go because an earlier line is equal or one edit
    away.  Rows that share id and text share one entry."""
    rows = materialize(_line_rows(docs, id_col, text_col), "line-rows")
    distinct = materialize(rows.groupBy("h1", "h2").agg(
        F.min(_place().withField("text_key", F.col("text_key"))).alias("first"), F.count("*").alias("n"), F.first("halves").alias("halves")), "distinct-lines")
    near = near_lines(docs, distinct, id_col, text_col).withColumn("near", F.lit(True))
    bad = distinct.select("h1", "h2", _place("first.").alias("first"), "n").join(near, ["h1", "h2"], "left").where("n > 1 OR near")
    gone = rows.select("id", "text_key", "line", "h1", "h2").join(bad, ["h1", "h2"]).where(
        F.coalesce("near", F.lit(False)) | (_place() > F.col("first")))
    return gone.groupBy("id", "text_key").agg(F.collect_set(F.struct("line", "h1", "h2")).alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, text, n_lines, n_kept) for every row of ``docs``: the text without repeated lines.

    Lines end at a line feed and are compared in lower case with white space
    collapsed.  A line goes when an earlier one (documents by id, nulls last,
    then line number; within the document too) is equal to it, or at
    Levenshtein distance 1 if it has MIN_FUZZY_CHARS characters or more.  The
    earlier line need not be one that stays.  Blank lines always stay and are
    not counted.  ``_row`` holds all columns as they were.  A null text stays
    null with no lines; rows that share id and text are one document listed
    again and keep the same lines; in rows that share an id only, a line goes
    where its number and its hash both say so.
    """
    gone = repeated_lines(docs, id_col, text_col)
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"),
                         F.xxhash64(text_col).alias("_key"))
    joined = packed.join(gone, F.col("_doc").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("text_key")), "left")
    cut = F.pandas_udf(_cut, "text string, n_lines int, n_kept int")
    return joined.select("_row", cut("_text", "lines").alias("c")).select("_row", "c.*")


def _cut(texts, lines):
    import pandas as pd
    out = []
    for text, gone in zip(texts, lines, strict=True):
        if text is None:
            out.append((None, 0, 0))
            continue
        parts = text.split("\n")
        full = [bool(part.strip()) for part in parts]
        drop = set()
        for at in gone if gone is not None else ():
            if at["line"] < len(parts) and line_hash(normal(parts[at["line"]])) == (at["h1"], at["h2"]):
                drop.add(at["line"])
        kept = "\n".join(part for i, part in enumerate(parts) if i not in drop)
        out.append((kept, sum(full), sum(full) - len(drop)))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_kept"])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("_row.doc_id", "n_lines", "n_kept", "text")
