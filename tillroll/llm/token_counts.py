"""Token counts through a digest cache: each distinct content is encoded once per tokenizer version."""

from __future__ import annotations

import hashlib
import os
from importlib.metadata import version

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import new_path, table

CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens bigint"
#: Texts are handed to the library in groups of about so many bytes.
GROUP_BYTES = 1 << 20


def tokenizer_digest(path: str) -> str:
    """SHA-256 over the tokenizer's file and its library's version."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    digest = hashlib.sha256(f"{library} {version(library)}\n".encode())
    with open(path, "rb") as file:
        for block in iter(lambda: file.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def _counter(path: str):
    """A function from texts to token counts."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _groups(texts: list[str]) -> list[list[str]]:
    groups, size = [[]], 0
    for text in texts:
        if size > GROUP_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(text)
        size += len(text)
    return groups


def content(text: Column) -> Column:
    """The normalised content: null becomes empty.  Nothing else may change,
    since tokenizers count white space and case as they stand."""
    return F.coalesce(text, F.lit(""))


def read_cache(spark: SparkSession, cache_path: str) -> DataFrame:
    """The stored counts; empty when nothing has been stored yet."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)


def _misses(texts: DataFrame, known: DataFrame) -> DataFrame:
    """One (digest, text) for each content that has no stored count.

    Repeats meet in a map-side minimum of row locations first, so a content
    held by a third of all rows leaves each task once.
    """
    absent = texts.join(known.select("content_digest"), "content_digest", "left_anti")
    return absent.groupBy("content_digest").agg(F.first("text").alias("text"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` rows as (_row, n_bytes, n_tokens), counts taken from the cache.

    Contents whose (content digest, tokenizer digest) is missing are encoded,
    once each, and appended to the Parquet table at ``cache_path``; the counts
    then come from that table.  A null text counts as empty.  Rows keep all
    their columns in ``_row``; repeated rows each get the count.  An empty
    table appends nothing and returns nothing.  Digests are SHA-256, so equal
    digests mean equal contents.
    """
    spark = docs.sparkSession
    version_digest = tokenizer_digest(tokenizer_path)
    text = content(F.col(text_col))
    digest = F.sha2(text.cast("binary"), 256)

    def encode(batches):
        count = _counter(tokenizer_path)
        for batch in batches:
            digests, texts = batch.columns
            numbers = [n for group in _groups(texts.to_pylist()) for n in count(group)]
            yield pa.RecordBatch.from_arrays(
                [digests, pa.array([version_digest] * len(numbers)), pa.array(numbers, pa.int64())],
                names=["content_digest", "tokenizer_digest", "n_tokens"])

    known = read_cache(spark, cache_path).where(F.col("tokenizer_digest") == version_digest)
    new = _misses(docs.select(digest.alias("content_digest"), text.alias("text")), known)
    new.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    # A task that was retried after its output was committed may repeat a row.
    stored = (read_cache(spark, cache_path).where(F.col("tokenizer_digest") == version_digest)
              .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))
    rows = docs.select(F.struct("*").alias("_row"), digest.alias("content_digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.join(stored, "content_digest").select("_row", "n_bytes", "n_tokens")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents, through a cache that starts empty."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("piece_bpe_32k.model")
    counted = count_tokens(docs.select("doc_id", "text"), path, new_path(spark, "token-cache"))
    return counted.select("_row.doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
