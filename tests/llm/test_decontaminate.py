import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tests.llm.helpers import empty, frame, odd_documents, words
from tillroll.llm import decontaminate as D


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string").withColumns(
        {c: F.lit("clash") for c in ("item", "answer", "overlap", "doc_id")})


def test_query_finds_all_shared_passages(spark):
    """Against shared five-word runs, counted for all pairs of document and item."""
    runs = {}
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = "".join(c if c.isalnum() else " " for c in r["text"].lower()).split()
        for k in range(len(w) - 4):
            runs.setdefault(tuple(w[k:k + 5]), set()).add((r["item_id"], len(w) - 4))
    want = set()
    for r in spark.read.parquet(f"{SF01}/documents.parquet").collect():
        w = "".join(c if c.isalnum() else " " for c in (r["text"] or "").lower()).split()
        count = {}
        for k in range(len(w) - 4):
            for item in runs.get(tuple(w[k:k + 5]), ()):
                count[item] = count.get(item, 0) + 1
        want |= {(r["doc_id"], i) for (i, n), c in count.items() if c >= 0.6 * n}
    got = {(r["doc_id"], r["item_id"]) for r in D.op1_decontaminate(spark, SF01).collect()}
    assert want and got == want


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([9, 18, 30, 47, 90])))) for i in range(30)]
    rows, want = [], set()
    for d in range(300):
        text = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(5, 400))]
        if d % 6 == 0:
            item, passage = rng.choice(items)
            piece = passage.split()
            kind = d // 6 % 3
            if kind == 1:   # a paraphrase: a sixth of the words replaced or dropped
                for k in sorted(rng.sample(range(len(piece)), len(piece) // 6), reverse=True):
                    piece[k:k + 1] = rng.choice([[], ["other"]])
            if kind == 2:
                piece = [w.upper() + "," for w in piece]
            at = rng.randrange(len(text))
            text[at:at] = piece
            want.add((d, item))
        rows.append((d, " ".join(text), "en", "a", 0))
    return items, rows, want


def test_planted_copies_and_paraphrases(spark, planted):
    items, rows, want = planted
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(frame(spark, rows), bench(spark, items)).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)
    copies = {(d, i) for d, i in want if d // 6 % 3 != 1}
    assert copies <= got


def test_passes_of_few_pieces_agree(spark, planted, monkeypatch):
    items, rows, _ = planted
    one = set(map(tuple, D.find_leaks(frame(spark, rows), bench(spark, items)).select("doc_id", "item_id", "kind").collect()))
    monkeypatch.setattr(D, "PIECES_PER_PASS", 15)
    assert one == set(map(tuple, D.find_leaks(frame(spark, rows), bench(spark, items)).select("doc_id", "item_id", "kind").collect()))


def test_removal_keeps_columns_and_clean_rows(spark, planted):
    items, rows, want = planted
    docs = frame(spark, rows + [(None, "a b c", None, None, None)])
    kept = D.remove_contaminated(docs, bench(spark, items))
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert ids >= {r[0] for r in rows} - {d for d, _ in want} and None in ids
    assert not ids & {d for d, _ in want if d // 6 % 3 != 1}


def test_odd_rows(spark):
    passage = words(random.Random(1), 60)
    items = bench(spark, [(1, passage), (1, passage), (2, None), (3, ""), (4, "!!"), (None, "x")])
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(frame(spark, odd_documents()), items).collect()}
    assert {(1, 1), (2, 1), (3, 1), (None, 1), (7, None)} == got
    assert D.find_leaks(empty(spark), items).count() == 0
    assert D.find_leaks(frame(spark, odd_documents()), bench(spark, [])).count() == 0


def test_answers_decide_paraphrases(spark):
    rng = random.Random(9)
    piece = [f"q{i}" for i in range(30)]
    half = [w if i % 3 else f"z{i}" for i, w in enumerate(piece)]
    filler = [(i, " ".join(f"w{rng.randrange(2000)}" for _ in range(200)), "en", "a", 0) for i in range(2, 80)]
    docs = frame(spark, [(1, " ".join(half), "en", "a", 0), *filler])
    for answer, found in (("q1 q2", 1), ("q0 q3", 0)):  # words that the paraphrase has, and hasn't
        items = spark.createDataFrame([(1, " ".join(piece), answer)], "item_id bigint, text string, answer string")
        out = D.find_leaks(docs, items, answer_col="answer").collect()
        assert len(out) == found and all(r["kind"] == "paraphrase" for r in out)


def test_common_weight():
    a, b = np.array([[1, 2, 3, 4, 0]], dtype=np.uint64), np.array([[2, 4, 3, 0]], dtype=np.uint64)
    assert D.common_weight(a, b, np.array([[1.0, 2.0, 1.5, 9.0]])).tolist() == [3.0]


def test_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(D, "_FAN_IN", 3)
    parts = spark.createDataFrame([(p, b, np.full(4, float(p + b), dtype=np.float32).tobytes()) for p in range(20) for b in range(2)],
                                  "part bigint, block int, data binary")
    assert D._sum_partials(parts).tolist() == [190.0] * 4 + [210.0] * 4


def test_removal_tells_rows_apart_by_id_and_text(spark, planted):
    items, rows, want = planted
    leak = next(r for r in rows if r[0] % 18 == 0 and r[0] in {d for d, _ in want})
    odd = [(None, leak[1], "en", "a", 0), (None, "a clean row without an id", "en", "a", 0),
           (leak[0], "a clean row that shares an id", "en", "a", 0)]
    kept = D.remove_contaminated(frame(spark, rows + odd), bench(spark, items))
    got = {(r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] in (None, leak[0])}
    assert got == {o[:2] for o in odd[1:]}


def test_items_of_few_words(spark):
    """One to six words inside full windows; a part of a sequence, or one over the end of a document, is none."""
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    items = [(n, " ".join(f"few{n}x{k}" for k in range(n))) for n in range(1, 7)] + [(7, "few1x0")]
    rows, want = [], set()
    for d in range(120):
        words_, n = text(rng.randrange(60, 300)), d % 6 + 1
        at = rng.randrange(len(words_))
        if d < 60:
            words_[at:at] = items[n - 1][1].split()
            want |= {(d, n)} | ({(d, 7)} if n == 1 else set())
        rows.append((d, " ".join(words_), "en", "a", 0))
    rows += [(500, " ".join(text(80) + ["few2x0"]), "en", "a", 0), (501, " ".join(["few2x1"] + text(80)), "en", "a", 0)]
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(frame(spark, rows), bench(spark, items)).collect()}
    assert want <= got
    assert not {g for g in got - want if g[0] not in (500, 501)}


def test_recall_against_all_windows_and_pieces(spark):
    """Loose paraphrases of the given items: what the candidate search keeps of all
    pairs of window and piece that the subsequence and answer checks accept."""
    rng = random.Random(11)
    given = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").select("item_id", "text").collect()]
    pool = [w for r in spark.read.parquet(f"{SF01}/documents.parquet").where("length(text) BETWEEN 300 AND 3000").limit(300).collect()
            for w in r["text"].split()]
    rows = []
    for d in range(200):
        text = [rng.choice(pool) for _ in range(rng.randrange(40, 300))]
        piece = rng.choice(given)[1].split()
        for k in sorted(rng.sample(range(len(piece)), int(len(piece) * rng.uniform(0.1, 0.5))), reverse=True):
            piece[k:k + 1] = rng.choice([[], [rng.choice(pool)], [rng.choice(pool), rng.choice(pool)]])
        at = rng.randrange(len(text))
        text[at:at] = piece
        rows.append((d, " ".join(text), "en", "a", 0))
    docs = frame(spark, rows)
    space = D.fit(docs)
    tokenizer = D.Tokenizer(D._alphabet())
    index = D.Index(D.pieces_of([(i, t, None) for i, t in given], space, tokenizer), space)
    words_ = tokenizer([r[1] for r in rows])
    limits = np.searchsorted(words_.docs, np.arange(len(rows) + 1))
    first, end, piece = [], [], []
    for span, chosen in index.groups:
        begins = np.flatnonzero(words_.at % (span * D.BLOCK // 2) == 0)
        first.append(np.repeat(begins, len(chosen)))
        end.append(np.repeat(np.minimum(begins + span * D.BLOCK, limits[words_.docs[begins] + 1]), len(chosen)))
        piece.append(np.tile(chosen, len(begins)))
    found = index.verify(words_, *map(np.concatenate, (first, end, piece)))
    want = {(d, index.pieces[p].item) for d, p, _, _ in found}
    got = {(r["doc_id"], r["item_id"]) for r in D._leaks(docs, bench(spark, given), space, "doc_id", "text").collect()}
    assert len(want) >= 100 and got <= want
    assert len(got) >= 0.98 * len(want)


def test_the_bag_bound_drops_no_verified_pair():
    """A paraphrase spread over the words around a window, half of it inside."""
    assert D.BAG < D.PARAPHRASE
    tokenizer = D.Tokenizer(D._alphabet())
    piece = [f"p{k}" for k in range(48)]
    spread = [w for k, p in enumerate(piece) if k % 2 for w in (p, f"x{k}", f"y{k}", f"z{k}")]  # half the piece in 96 words
    space = D.Space(np.ones(D.TERMS, dtype=np.float32), np.ones((D.TERMS, D.RANK), dtype=np.float32))
    index = D.Index(D.pieces_of([(1, " ".join(piece), "p1 p3")], space, tokenizer), space)
    words_ = tokenizer([" ".join(spread)])
    first, end, found = np.array([16]), np.array([80]), np.array([0])
    assert len(index.verify(words_, first, end, found)) == len(index._bag(words_, first, end, found, 64 + D.PIECE)[0]) == 1


def test_the_space_is_fitted_on_every_document(spark, monkeypatch):
    """One-word documents in large number: A'A is diagonal, each entry made of all documents of its term."""
    seen = []
    monkeypatch.setattr(D, "whitened_vectors", lambda y: seen.append(y) or np.zeros((D.TERMS, D.RANK)))
    docs = spark.range(0, 260_000, 1, 6).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 40).alias("text"))
    space = D.fit(docs, text_col="text")
    df = np.zeros(D.TERMS)
    for term in D.Tokenizer(D._alphabet())([f"w{i}" for i in range(40)]).terms:
        df[term] += 260_000 / 40
    assert seen[0] == pytest.approx((df * space.idf.astype(float) ** 2)[:, None] * D.directions(), rel=1e-4, abs=1e-2)


def test_products_of_passages_equal_a_dense_product():
    rng = np.random.default_rng(4)
    n, weighted = 300, rng.standard_normal((D.TERMS, 5)).astype(np.float32)
    passage = np.sort(rng.integers(0, n - 1, 9_000))  # the last one is empty
    term = np.where(rng.random(9_000) < 0.5, rng.integers(0, 20, 9_000), rng.integers(0, D.TERMS, 9_000))
    dense = np.zeros((n, D.TERMS))
    np.add.at(dense, (passage, term), 1)
    total = np.ones((D.TERMS, 5))
    D._add_products(total, term, passage, n, weighted)
    assert total == pytest.approx(1 + dense.T @ (dense @ weighted), rel=1e-4, abs=1e-2)
