"""Near words, forms and roots against comparisons of all pairs."""

import random
import zlib
from collections import Counter

from tests.conftest import SF001
from tests.llm.helpers import empty, frame, odd_documents
from tillroll.llm import spelling as sp


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(rows, min_length=6, min_count=5, ratio=5, divisor=199):
    """The contract in plain Python."""
    import re
    low = {c: c + 32 for c in range(65, 91)}
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    vocab = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in vocab if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in vocab}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best and vocab[best] >= ratio * vocab[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), vocab.get(form[w])) for w, n in vocab.items())


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary_texts(seed, words=120, alphabet="abcdeéÀ"):
    """Words with chains of variants and of counts, many anagrams among them."""
    rng = random.Random(seed)
    out = []
    for _ in range(words):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(6, 9)))
        n = rng.choice([5, 6, 30, 200])
        out += [w] * n
        for _ in range(3):
            i = rng.randrange(len(w))
            v = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:],
                            w[:i] + rng.choice(alphabet) + w[i + 1:]])
            out += [v] * rng.choice([1, 5, 7])
    rng.shuffle(out)
    return out


def test_trees_find_all_near_pairs(monkeypatch):
    monkeypatch.setattr(sp, "LEAF", 4)
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abcéÿ") for _ in range(7)) for _ in range(600)})
    shorter = sorted({w[1:] for w in words} | {w[:-1] for w in words[:100]})
    for asking in (words, shorter):
        found = {(asking[i], words[j]) for a, b in sp.near_pairs(asking, words) for i, j in zip(a, b)}
        total = sum(len(a) for a, _ in sp.near_pairs(asking, words))
        assert found == {(a, b) for a in asking for b in words if one_edit(a, b)} and total == len(found)


def test_cells_reach_all(monkeypatch, spark):
    """Small cells and a sample that misses words and whole lengths."""
    texts = vocabulary_texts(8)
    rows = [(i, " ".join(texts[i::40]), None, None, None) for i in range(40)]
    rows += [(90, "sixteenletters " * 9 + "sixteenlettes " * 5, None, None, None)]
    want = plain_groups([r[:2] for r in rows])
    docs = frame(spark, rows)
    for cell, sample in ((16, 100_000), (60, 60), (4096, 100_000)):
        monkeypatch.setattr(sp, "CELL", cell)
        monkeypatch.setattr(sp, "SAMPLE", sample)
        assert got(sp.spelling_groups(docs)) == want


def test_odd_rows(spark):
    assert got(sp.spelling_groups(empty(spark))) == []
    rows = odd_documents() + [(60, "ABCDEFÉ abcdefÉ abcdefé " * 6, None, None, None),
                              (None, "nothing " * 7, None, None, None), (61, "z" * 40_000 + " ", None, None, None)] * 5
    assert got(sp.spelling_groups(frame(spark, rows))) == plain_groups([r[:2] for r in rows])


def test_ties_and_chains(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaabb": 125, "aaabbb": 700, "zzzzzz": 5, "zzzzzy": 24}
    rows = [(None, " ".join([w] * n), None, None, None) for w, n in counts.items()]  # no ids: no edits
    out = {r["word"]: r for r in sp.spelling_groups(frame(spark, rows)).collect()}
    assert out["aaaaaa"]["form"] == "aaaaab" and out["aaaaaa"]["root"] == "aaabbb"
    assert out["zzzzzz"]["form"] is None and out["zzzzzz"]["n_near"] == 1 and out["zzzzzz"]["root"] == "zzzzzz"


def test_query_equals_plain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    assert got(sp.op13_spelling_variants(spark, SF001)) == plain_groups([tuple(r) for r in docs.collect()])


def test_letter_order():
    a, b = sp.letters(["abcabc", "abcabc"]), sp.letters(["abcabd", "abcbad"])
    assert sp.one_replaced(a, b).tolist() == [True, False]
    a, b = sp.letters(["aaaaaa", "abcabc", "abcabc"]), sp.letters(["aaaaaaa", "abcxabc", "abcxacb"])
    assert sp.one_inserted(a, b).tolist() == [True, True, False]
    assert sp.letter_counts(sp.letters(["aé"])).sum() == 2
