import random
from collections import Counter

import pytest

from tests.conftest import SF001
from tests.llm.helpers import empty, frame, odd_documents, words
from tillroll.llm import line_dedup as L


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(rows, near=None):
    """Texts without repeated lines, from all pairs of distinct lines."""
    near = near or (lambda a, b: abs(len(a) - len(b)) < 2 and min(len(a), len(b)) >= L.MIN_FUZZY_CHARS
                    and levenshtein(a, b) <= 1)
    place = lambda i, k: (i is None, i or 0, k)
    first = {}
    for i, text in rows:
        for k, raw in enumerate((text or "").split("\n")):
            if line := L.normal(raw):
                first[line] = min(first.get(line, place(i, k)), place(i, k))
    lines = sorted(first, key=first.get)
    later = {b for n, b in enumerate(lines) if any(near(a, b) for a in lines[:n])}
    out = []
    for i, text in rows:
        if text is not None:
            text = "\n".join(raw for k, raw in enumerate(text.split("\n")) if not (line := L.normal(raw))
                             or (line not in later and place(i, k) <= first[line]))
        out.append((i, text))
    return Counter(out)


def result(docs):
    return Counter((r["_row"]["doc_id"], r["text"]) for r in L.dedup_lines(docs).collect())


def edit(rng, line):
    at = rng.randrange(len(line))
    return rng.choice([line[:at] + line[at + 1:], line[:at] + "é" + line[at:], line[:at] + "q" + line[at + 1:]])


def test_random_edits_against_all_pairs(spark):
    rng = random.Random(4)
    lines = [words(rng, rng.randrange(1, 8)) for _ in range(25)] + ["aaaaaaaaaaaaaaaaaaaaaaaaa", "ab" * 15]
    rows = []
    for i in range(60):
        picked = [rng.choice(lines) for _ in range(5)]
        for k in range(5):
            for _ in range(rng.choice([0, 0, 1, 2])):
                picked[k] = edit(rng, picked[k])
        rows.append((i, "\n".join(picked + rng.choice([[], ["", "  "]])), "en", "a", 0))
    assert result(frame(spark, rows)) == brute([r[:2] for r in rows])


def test_template_lines_meet_without_pairs(spark):
    rows = [(i, f"this is page number {i % 100:02d} of one hundred\nunique line of document {i * 7919:09d}", "en", "a", 0)
            for i in range(150)]
    assert result(frame(spark, rows)) == brute([r[:2] for r in rows])


def test_odd_rows(spark):
    rows = odd_documents() + [(20, "One line here that is long enough\r\nShort\nshort\nShorts", "en", "a", 0),
                              (21, "one  line HERE that is long enough!", "en", "a", 0)]
    assert result(frame(spark, rows)) == brute([r[:2] for r in rows])
    assert L.dedup_lines(empty(spark)).count() == 0


def test_rows_that_share_an_id_only(spark):
    rows = [(1, "first line of text number one\nsame line in all of the documents", "en", "a", 0),
            (3, "same line in all of the documents\nkept", "en", "a", 0), (3, "other text\nkept too", "en", "a", 0)]
    got = result(frame(spark, rows))
    assert got == Counter([(1, rows[0][1]), (3, "kept"), (3, "other text\nkept too")])


def test_query_equals_brute_force(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    fuzzy = lambda a, b: (abs(len(a) - len(b)) < 2 and min(len(a), len(b)) >= L.MIN_FUZZY_CHARS
                          and (a[:9] == b[:9] or a[-9:] == b[-9:]) and L.within_one_edit(a, b))
    got = Counter((r["doc_id"], r["text"]) for r in L.op4_line_dedup(spark, SF001).collect())
    assert got == brute(rows, fuzzy)


@pytest.mark.parametrize("seed", range(3))
def test_within_one_edit(seed):
    rng = random.Random(seed)
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(8)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(8)))
        assert L.within_one_edit(a, b) == (levenshtein(a, b) <= 1)


def test_very_long_line(spark):
    long = words(random.Random(1), 40_000)
    rows = [(1, long, "en", "a", 0), (2, long[:100_000] + "#" + long[100_000:], "en", "a", 0), (3, long + "##", "en", "a", 0)]
    assert result(frame(spark, rows)) == Counter([(1, long), (2, ""), (3, long + "##")])


def test_rows_of_one_id_do_not_share_an_array(spark):
    """As many lines at an entry as its own text has, however many rows have its id or repeat it."""
    rng = random.Random(8)
    common = "a line that stands in all of the documents"
    rows = [(None, f"{words(rng, 6)}\n{common}\n{common}!", "en", "a", 0) for _ in range(200)]
    rows += [(7, f"{words(rng, 6)}\n{common}", "en", "a", 0) for _ in range(100)] + [(9, f"x\n{common}", "en", "a", 0)] * 150
    docs = frame(spark, rows)
    entries = L.repeated_lines(docs).collect()
    assert max(len(r["lines"]) for r in entries) <= 3
    assert sum(r["id"] is None for r in entries) == 200 and sum(r["id"] == 9 for r in entries) == 1
    assert result(docs) == brute([r[:2] for r in rows])
