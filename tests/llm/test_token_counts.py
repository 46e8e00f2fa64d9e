from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import SF001
from tests.llm.helpers import empty, frame, odd_documents
from tillroll.llm import token_counts as T
from tillroll.llm.common import new_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def brute(path, text):
    if path == MODEL:
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    return len(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_library(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in T.op7_token_counts(spark, SF001).collect():
        n = len(model.encode(texts.pop(r["doc_id"]) or ""))
        assert r["n_tokens"] == n and r["over_limit"] == (n > 4096)
    assert not texts


@pytest.mark.parametrize("path", [MODEL, JSON])
def test_odd_rows(spark, path):
    rows = odd_documents() + [(60, "<s> a </s> <unk> <|endoftext|> <0x0A>", "en", "a", 1)]
    out = T.count_tokens(frame(spark, rows), path, new_path(spark, "test-cache"))
    got = Counter((r["_row"]["doc_id"], r["n_bytes"], r["n_tokens"]) for r in out.collect())
    assert got == Counter((r[0], len((r[1] or "").encode()), brute(path, r[1])) for r in rows)


def test_empty_table(spark):
    assert T.count_tokens(empty(spark), MODEL, new_path(spark, "test-cache")).count() == 0


def test_only_distinct_misses_are_encoded(spark):
    cache = new_path(spark, "test-cache")
    T.count_tokens(frame(spark, odd_documents()), MODEL, cache)
    first = T.read_cache(spark, cache).count()
    assert first == len({r[1] or "" for r in odd_documents()})
    rows = odd_documents() + [(70, "a new text", "en", "a", 1), (71, "a new text", "en", "a", 1)]
    T.count_tokens(frame(spark, rows), MODEL, cache)
    assert T.read_cache(spark, cache).count() == first + 1
    # A stored count is used as it stands; another tokenizer doesn't see it.
    forged = T.read_cache(spark, cache).where("false").union(spark.createDataFrame(
        [(__import__("hashlib").sha256(b"forged").hexdigest(), T.tokenizer_digest(MODEL), 77)], T.CACHE_SCHEMA))
    forged.write.mode("append").parquet(cache)
    forged_row = frame(spark, [(1, "forged", "en", "a", 1)])
    assert T.count_tokens(forged_row, MODEL, cache).first()["n_tokens"] == 77
    assert T.count_tokens(forged_row, JSON, cache).first()["n_tokens"] == brute(JSON, "forged")
