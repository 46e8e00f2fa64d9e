import random

import numpy as np
import pytest

from tests.conftest import SF01
from tests.llm.helpers import empty, frame, odd_documents
from tillroll.llm import language_id as I


def greedy(text, reference):
    """Phrases of ``text``: each the longest piece that stands in ``reference``, then the symbol that ends it begins the next."""
    count, phrase = 1, []
    joined = "".join(map(chr, reference))
    for s in text:
        if "".join(map(chr, [*phrase, s])) in joined:
            phrase.append(s)
        else:
            count += 1
            phrase = [s] if chr(s) in joined else []
    return count


def test_parse_equals_substring_search():
    rng = random.Random(1)
    reference = np.array([rng.randrange(1, 5) for _ in range(300)], dtype=np.uint8)
    texts = [np.array([rng.randrange(1, 7) for _ in range(n)], dtype=np.uint8) for n in (0, 1, 2, 50, 333, 1024, 2500)]
    got = I.phrases(texts, (I.automaton(reference, 7),))[:, 0]
    want = [sum(greedy(t[a:a + I.WINDOW_CHARS].tolist(), reference.tolist()) for a in range(0, len(t), I.WINDOW_CHARS))
            for t in texts]
    assert got.tolist() == want


def test_held_out_accuracy(spark):
    out = I.op8_language_id(spark, SF01).where("held_out")
    langs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = out.join(langs, "doc_id").collect()
    assert len(rows) > 250 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    rows = odd_documents() + [(80, "12 ... 34 !?", "en", "a", 1)]
    docs = frame(spark, rows)
    model = I.learn(docs)
    out = I.identify(docs, model).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)
    for r in out:
        if r["doc_id"] in (4, 5, 6, 80):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in model.languages
    same = {(r["lang_pred"], r["score"]) for r in out if r["doc_id"] in (1, 2)}
    assert len(same) == 1


def test_nothing_learned(spark):
    model = I.learn(empty(spark))
    assert model.languages == () and I.identify(empty(spark), model).count() == 0
    assert I.identify(frame(spark, odd_documents()[:2]), model).first()["lang_pred"] == "und"
    one = I.learn(frame(spark, [(1, "hello there my friend", "en", "a", 1)]))
    assert I.identify(frame(spark, [(2, "hello", None, "a", 1)]), one).first()[1:] == ("en", 1.0)


def test_too_many_languages_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(I, "MAX_LANGUAGES", 1)
    with pytest.raises(ValueError, match="languages"):
        I.learn(frame(spark, [(1, "abc", "en", "a", 1), (2, "abc", "de", "a", 1)]))



def _invented(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_whole_texts_are_sampled_and_headers_do_not_fill_references(spark):
    rng = random.Random(4)
    header = _invented(rng, "abcdefghijklmnop", 1_500)
    rows = [(i, header + " " + _invented(rng, letters, 300), lang, "a", 0)
            for i, (lang, letters) in enumerate([("de", "abcdefgh"), ("en", "ijklmnop")] * 40)]
    model = I.learn(frame(spark, rows))
    tests = [(i, _invented(rng, letters, 80), None, "a", 0) for i, letters in enumerate(["abcdefgh", "ijklmnop"] * 5)]
    got = {r["doc_id"]: r["lang_pred"] for r in I.identify(frame(spark, tests), model).collect()}
    assert got == {i: ("de", "en")[i % 2] for i in range(10)}


def test_languages_without_letters_in_their_heads_are_kept(spark):
    rng = random.Random(5)
    rows = [(i, "12 34 " * 2_000 + _invented(rng, "abcdefgh", 200), "aa", "a", 0) for i in range(30)]
    rows += [(100 + i, _invented(rng, "ijklmnop", 200), "bb", "a", 0) for i in range(30)] + [(200, "1 2 3", "cc", "a", 0)]
    model = I.learn(frame(spark, rows))
    assert model.languages == ("aa", "bb", "cc")
    tests = [(1, _invented(rng, "abcdefgh", 50), None, "a", 0), (2, _invented(rng, "ijklmnop", 50), None, "a", 0)]
    got = I.identify(frame(spark, tests), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "aa", 2: "bb"} and all(0.5 <= r["score"] <= 1 for r in got)


def test_languages_of_one_large_script_keep_their_letters(spark):
    """Two languages of 600 ideographs each that differ by code points equal modulo 16."""
    rng = random.Random(6)
    own = {"xa": [chr(0x4E00 + 32 * i) for i in range(600)], "xb": [chr(0x4E00 + 32 * i + 16) for i in range(600)]}
    rows = [(i, _invented(rng, own[lang], 150), lang, "a", 0) for i, lang in enumerate(["xa", "xb"] * 40)]
    model = I.learn(frame(spark, rows))
    assert len(set(model.symbols[[ord(c) for letters in own.values() for c in letters]])) == 1_200
    tests = [(i, _invented(rng, own[("xa", "xb")[i % 2]], 20), None, "a", 0) for i in range(40)]
    got = {r["doc_id"]: r["lang_pred"] for r in I.identify(frame(spark, tests), model).collect()}
    assert got == {i: ("xa", "xb")[i % 2] for i in range(40)}


def test_a_large_alphabet_parses_like_substring_search():
    rng = random.Random(7)
    reference = np.array([rng.randrange(1, 3_000) for _ in range(400)] * 2 + [rng.randrange(1, 40) for _ in range(400)])
    text = np.concatenate([reference[100:160], reference[50:70], reference[-30:], [3_500, 3_500], reference[390:450]])
    assert I.phrases([text], (I.automaton(reference, 4_000),))[0, 0] == greedy(text.tolist(), reference.tolist())


def test_a_hundred_languages_fit_a_worker():
    """Tables hold transitions, not states times symbols: under 2 MB a full reference, with 3,000 letters too."""
    rng = random.Random(8)
    for letters in (26, 3_000):
        reference = np.array([rng.randrange(2, letters + 2) for _ in range(I.REFERENCE_CHARS)])
        assert sum(a.nbytes for a in I.automaton(reference, 20_000)) < 2_000_000
