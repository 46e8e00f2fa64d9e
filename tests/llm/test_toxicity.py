import random
from itertools import product

import numpy as np

from tests.conftest import SF01
from tests.llm.helpers import empty, frame, odd_documents, words
from tillroll.llm import toxicity as T


def model(entries):
    return T.Model(*T.compile_lexicon(entries), np.zeros(T.N_FEATURES + 1))


def hits(m, text):
    codes = T.points(text)
    _, _, states = T.match_words(codes, m)
    return [(float(m.accepts[s]), bool(m.inexact[s])) for s in states]


def distance(a, b):
    """Edits between two words: insert, drop, replace, swap neighbours."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i, j in product(range(len(a)), range(len(b))):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
        if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_equals_edit_distance():
    rng = random.Random(1)
    entries = [T.Entry("abbab", False, 2.0), T.Entry("babaab", False, 3.0), T.Entry("aab", False, 1.0), T.Entry("cab", True, 4.0)]
    m = model(entries)
    for _ in range(3_000):
        word = "".join(rng.choice("abc" if rng.random() < 0.9 else "é7") for _ in range(rng.randrange(1, 9)))
        exact = [e.weight for e in entries if (word.startswith(e.text) if e.stem else word == e.text)]
        near = [e.weight for e in entries if not e.stem and len(e.text) >= T.FUZZY_LENGTH and distance(word, e.text) == 1]
        want = (max(exact), False) if exact else (max(near), True) if near else (0.0, False)
        assert hits(m, word) == [want], word


def test_words_are_found_anywhere():
    m = model([T.Entry("idiot", False, 2.0)])
    assert hits(m, "You IDIOT, idoit! id1ot idiots xidiotx idi") == [
        (0.0, False), (2.0, False), (2.0, True), (2.0, True), (2.0, True), (0.0, False), (0.0, False)]
    assert hits(m, "") == [] and hits(m, " ,.") == []


def test_quotation_is_told_from_abuse():
    m = model([T.Entry("idiot", False, 2.0)])
    plain, quote, curly = (T.features(t, m) for t in ("you are an idiot and all", 'she wrote "an idiot again" today',
                                                     "sie schrieb „so ein idiot“ heute"))
    assert plain[0] > 0 and plain[1] == 0 and plain[4] > 0 and plain[6] == 0
    for f in (quote, curly):
        assert f[0] == 0 and f[1] > 0 and f[4] == 0 and f[6] == 1
    after = T.features('"a b" idiot "c d"', m)
    assert after[0] > 0 and after[6] == 0


def test_learns_words_stems_and_misspellings(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1, 600):
        toxic = i % 5 == 0
        bad = rng.choice(["grumblefoot", "snark" + rng.choice(["ing", "ed", "o", "ish"])])
        rows.append((i, words(rng, 30) + (f" {bad} " if toxic else " ") + words(rng, 10), "en", "a", 0))
        labels.append((i, int(toxic)))
    labels = spark.createDataFrame(labels + [(1, 0), (None, 1), (2, None)], "doc_id bigint, toxic int")
    m = T.learn(frame(spark, rows), labels)
    test = [(1, "a grumblefoot here", 1), (2, "a grumblefot here", 1), (3, "such snarkery " + words(rng, 20), 1),
            (4, words(rng, 50), 0), (5, "", 0), (6, None, 0)]
    out = T.score_documents(frame(spark, [(i, t, "en", "a", 0) for i, t, _ in test]), m).collect()
    assert {r["doc_id"]: r["predicted"] for r in out} == {i: y for i, _, y in test}


def test_held_out_quality(spark):
    rows = T.op6_toxicity(spark, SF01).where("held_out").join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    assert auc > 0.8 and sum(s >= 0.5 for s in clean) < 0.05 * len(clean)


def test_odd_rows(spark):
    docs = frame(spark, odd_documents())
    no_labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    m = T.learn(docs, no_labels)
    out = T.score_documents(docs, m).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in odd_documents())
    assert all(0 <= r["score"] <= 1 for r in out)
    assert T.score_documents(empty(spark), m).count() == 0 and T.learn(empty(spark), no_labels) is not None


def test_every_word_of_a_large_lexicon_takes_edits(monkeypatch):
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 9))) for _ in range(260)})
    entries = [T.Entry(w, False, 1.0 + rng.random()) for w in terms] + [T.Entry("hagf", True, 9.0)]
    rng.shuffle(entries)
    for group in (T.FUZZY_GROUP, 100):
        monkeypatch.setattr(T, "FUZZY_GROUP", group)
        m = model(entries)
        assert all(hits(m, f"{w[:2]}9{w[2:]}")[0][0] > 0 for w in terms)
        for _ in range(300):
            word = list(rng.choice(terms))
            word[rng.randrange(len(word))] = rng.choice("abcdefgh9")
            word = "".join(word)
            exact = [e.weight for e in entries if (word.startswith(e.text) if e.stem else word == e.text)]
            near = [e.weight for e in entries if not e.stem and distance(word, e.text) == 1]
            assert hits(m, word) == [(max(exact), False) if exact else (max(near), True) if near else (0.0, False)]


def test_lexicon_holds_every_term_that_passes(spark):
    rows = [(f"w{i:04d}", False, 50, 0) for i in range(2_500)] + [("snarkling"[:n], True, 90, 0) for n in range(4, 10)]
    found = T.lexicon(spark.createDataFrame(rows, "term string, stem boolean, toxic bigint, clean bigint"), 100, 500)
    assert {e.text for e in found} == {f"w{i:04d}" for i in range(2_500)} | {"snar"}


def test_copies_of_a_text_count_once(spark):
    rng = random.Random(5)
    rows = [(i, "harmless pangolin story" if i <= 60 else words(rng, 30) + (" grumblefoot" if i % 5 == 0 else ""), "en", "a", 0)
            for i in range(1, 500)]
    labels = spark.createDataFrame([(i, int(i <= 60 or i % 5 == 0)) for i in range(1, 500)], "doc_id bigint, toxic int")
    m = T.learn(frame(spark, rows), labels)
    (pangolin, _), (near, edited) = hits(m, "pangolin brumblefoot")
    assert pangolin == 0 and near > 0 and edited
