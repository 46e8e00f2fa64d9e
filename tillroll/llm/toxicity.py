"""Toxicity: a learned lexicon, misspellings through Levenshtein automata, and context windows."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import crc_mod, materialize, table

#: The bounded sample of labelled rows that the model is fitted on: the rows
#: of each class whose ids hash lowest.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4_000, 20_000
MIN_STEM, MAX_STEM = 4, 10
#: A term enters the lexicon when so rare a coincidence would explain its hold
#: on toxic documents (natural log), and so large a share of its documents,
#: with classes at their sizes in the sample, is toxic.
CHANCE, PRECISION = math.log(1e-6), 0.9
#: Misspellings are sought for every whole word of the lexicon (words have
#: FUZZY_LENGTH letters at least), for so many words by each automaton.
FUZZY_LENGTH, FUZZY_GROUP = 3, 512
#: Words to each side of a hit that its context score looks at.
WINDOW = 8
OPEN_QUOTES, CLOSE_QUOTES = "\"“„«‹", "\"”“»›"
N_FEATURES = 7
_MAX_COUNTED = 100_000


class Entry(NamedTuple):
    text: str
    stem: bool          # matches every word that begins with it
    weight: float


class Model(NamedTuple):
    symbols: np.ndarray     # symbol of each code point: 0 ends words, 1 is any other letter
    starts: np.ndarray      # first state of each automaton; they share the tables and the dead state, 1
    steps: np.ndarray       # next state * number of symbols, by state and symbol
    accepts: np.ndarray     # weight of the entry that a word ending in the state matches, else 0
    inexact: np.ndarray     # True where that match needs an edit
    coefficients: np.ndarray


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


# -- learning ---------------------------------------------------------------

def _terms(text: str) -> set[tuple[str, bool]]:
    """Whole words, and their beginnings of MIN_STEM to MAX_STEM letters as stems."""
    words = set("".join(c if c.isalnum() else " " for c in text.lower()).split())
    out = {(w, False) for w in words if FUZZY_LENGTH <= len(w) <= 32}
    return out | {(w[:n], True) for w in words for n in range(MIN_STEM, min(MAX_STEM, len(w)) + 1)}


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): documents of the sample that have the term."""
    def run(batches):
        counts: dict[tuple[str, bool], list[int]] = {}

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.bool_()),
                 pa.array([v[1] for v in counts.values()], pa.int64()),
                 pa.array([v[0] for v in counts.values()], pa.int64())], names=["term", "stem", "toxic", "clean"])

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
                for key in _terms(text.as_py() or ""):
                    counts.setdefault(key, [0, 0])[toxic.as_py()] += 1
                if len(counts) > _MAX_COUNTED:
                    yield rows()
                    counts = {}
        yield rows()

    parts = sample.select("text", "toxic").mapInArrow(run, "term string, stem boolean, toxic bigint, clean bigint")
    return parts.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(counts: DataFrame, n_toxic: int, n_clean: int) -> list[Entry]:
    """All terms that mark toxic documents beyond chance, strongest first.

    Chance is the likelihood ratio of the term's own toxic share to the
    sample's.  A stem whose shorter stem is in the lexicon adds nothing and
    goes; whole words stay, as misspellings are sought for them.
    """
    if not n_toxic or not n_clean:
        return []
    prior = n_toxic / (n_toxic + n_clean)
    n = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / n
    gain = F.col("toxic") * F.log(share / prior) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    found = counts.where("toxic > 2").where(share >= PRECISION).withColumn("gain", gain).where(F.col("gain") >= -CHANCE)
    rows = found.orderBy(F.desc("gain"), "term", "stem").collect()
    stems = {r["term"] for r in rows if r["stem"]}
    out = []
    for r in rows:
        covered = any(r["term"][:k] in stems for k in range(MIN_STEM, len(r["term"])))
        if not (r["stem"] and covered):
            weight = math.log((r["toxic"] + 0.5) / (n_toxic + 1)) - math.log((r["clean"] + 0.5) / (n_clean + 1))
            out.append(Entry(r["term"], r["stem"], max(weight, 0.1)))
    return out


# -- the automaton ------------------------------------------------------------

def compile_lexicon(entries: list[Entry]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, steps, accepts, inexact): the whole lexicon, as
    deterministic automata over one alphabet.

    The first holds every entry, and each allows edits in FUZZY_GROUP of the
    whole words, in the order of the words.
    """
    loose = sorted(e for e in entries if not e.stem and len(e.text) >= FUZZY_LENGTH)
    letters = sorted({letter for e in entries for letter in e.text})
    number = {letter: i + 2 for i, letter in enumerate(letters)}
    starts, steps, accepts, inexact, size = [], [], [], [], 0
    for a in range(0, max(len(loose), 1), FUZZY_GROUP):
        group = loose[a:a + FUZZY_GROUP]
        rows, weights, near = _automaton(group if a else entries, group, number)
        # Behind the first, an automaton's own dead state, 1, goes for the shared one.
        place = np.arange(len(weights)) + size - (1 if a else 0)
        place[:2] = size, 1
        keep = np.arange(len(weights)) != (1 if a else -1)
        starts.append(size)
        steps.append(place[rows[keep]] * (len(letters) + 2))
        accepts.append(weights[keep])
        inexact.append(near[keep])
        size += int(keep.sum())
    symbols = np.zeros(0x110000, dtype=np.uint8 if len(letters) < 254 else np.uint16)
    symbols[[p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and chr(p).isalnum()]] = 1
    for letter, symbol in number.items():
        symbols[ord(letter)] = symbol
    return (symbols, np.array(starts), np.concatenate(steps).astype(np.int32).ravel(), np.concatenate(accepts),
            np.concatenate(inexact))


def _automaton(entries: list[Entry], loose: list[Entry],
               number: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(steps, accepts, inexact): one deterministic automaton for the trie of
    ``entries`` run against Levenshtein automata, start state first, dead
    state second.

    A state is a set of (trie node, edits so far, letter awaited after a
    swap); an edit inserts, drops, replaces or swaps neighbouring letters, at
    most one in a word, and only on the way to an entry of ``loose``.  A stem
    accepts as soon as it is read.
    """
    children: list[dict[str, int]] = [{}]
    word_at: dict[int, float] = {}
    stem_at: dict[int, float] = {}
    fuzzy: set[int] = {0}
    for entry in entries:
        node = 0
        for letter in entry.text:
            if letter not in children[node]:
                children[node][letter] = len(children)
                children.append({})
            node = children[node][letter]
        held = stem_at if entry.stem else word_at
        held[node] = max(held.get(node, 0.0), entry.weight)
    fuzzy_words: set[int] = set()
    for entry in loose:
        node = 0
        for letter in entry.text:
            node = children[node][letter]
            fuzzy.add(node)
        fuzzy_words.add(node)
    n_symbols = len(number) + 2

    def closed(items: set) -> frozenset:
        """Adds the letters of the trie that a word may have dropped."""
        out = set(items)
        for node, edits, swap in items:
            if edits == 0 and swap is None and node in fuzzy:
                out |= {(child, 1, None) for child in children[node].values() if child in fuzzy}
        return frozenset(out)

    def after(state: frozenset, letter: str | None) -> frozenset:
        out = set()
        for node, edits, swap in state:
            if swap is not None:
                if letter == swap:
                    out.add((node, 1, None))
                continue
            child = children[node].get(letter)
            if child is not None and (edits == 0 or child in fuzzy):
                out.add((child, edits, None))
            if edits == 0 and node in fuzzy:
                out.add((node, 1, None))
                for first, child in children[node].items():
                    if child in fuzzy:
                        out.add((child, 1, None))
                        second = children[child].get(letter)
                        if second is not None and second in fuzzy and letter != first:
                            out.add((second, 1, first))
        return closed(out)

    def telling(state: frozenset) -> set[str]:
        """Letters after which the state isn't that of any other letter."""
        out = set()
        for node, edits, swap in state:
            if swap is not None:
                out.add(swap)
                continue
            out.update(children[node])
            if edits == 0 and node in fuzzy:
                for child in children[node].values():
                    out.update(children[child])
        return out

    def value(state: frozenset) -> tuple[float, bool]:
        exact = [word_at.get(node, 0.0) for node, edits, swap in state if edits == 0 and swap is None]
        near = [word_at[node] for node, edits, swap in state
                if edits == 1 and swap is None and node in fuzzy_words]
        if max(exact, default=0.0) > 0:
            return max(exact), False
        return max(near, default=0.0), bool(near)

    # States 0 and 1: no match any more; a stem has matched (its weight follows in accepts).
    dead, start = frozenset(), closed({(0, 0, None)})
    index: dict[object, int] = {dead: 0}
    accepts, inexact, steps = [0.0], [False], [[0] * n_symbols]

    def add(key: object, weight: float, near: bool) -> int:
        if key not in index:
            index[key] = len(accepts)
            accepts.append(weight)
            inexact.append(near)
            steps.append([index[key]] * n_symbols)  # a matched stem stays matched
        return index[key]

    def state_of(items: frozenset) -> int:
        stems = [stem_at[node] for node, edits, swap in items if edits == 0 and swap is None and node in stem_at]
        if stems:
            return add(("stem", max(stems)), max(stems), False)
        if items not in index:
            todo.append(items)
        return add(items, *value(items))

    todo: list[frozenset] = []
    first = state_of(start)
    while todo:
        items = todo.pop()
        row = steps[index[items]]
        row[1:] = [state_of(after(items, None))] * (n_symbols - 1)
        row[0] = 0
        for letter in telling(items):
            row[number[letter]] = state_of(after(items, letter))
    order = [first, 0, *(i for i in range(1, len(steps)) if i != first)]
    place = np.empty(len(steps), dtype=np.int64)
    place[order] = np.arange(len(steps))
    return place[np.array(steps)][order], np.array(accepts)[order], np.array(inexact)[order]


# -- scoring -------------------------------------------------------------------

def match_words(codes: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, states) of all words of a text, every word run through
    the automata side by side, letter by letter.  A word's state is that of
    its exact match in any automaton, or else of its strongest one."""
    n_symbols = len(model.steps) // len(model.accepts)
    symbols = model.symbols[codes].astype(np.int64)
    inside = symbols > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    best = None
    for start in model.starts:
        states = np.full(len(starts), start * n_symbols, dtype=np.int64)
        alive, at = np.arange(len(starts)), starts.copy()
        while len(alive):
            states[alive] = model.steps[states[alive] + symbols[at]]
            at = at + 1
            going = (at < ends[alive]) & (states[alive] != n_symbols)
            alive, at = alive[going], at[going]
        states //= n_symbols
        if best is None:
            best = states
        else:
            some = np.flatnonzero(model.accepts[states] > 0)
            new, old = states[some], best[some]
            stronger = (model.accepts[new] > model.accepts[old]) & (model.inexact[new] <= model.inexact[old])
            exact = model.inexact[old] & ~model.inexact[new]
            free = model.accepts[old] == 0
            best[some] = np.where(free | exact | stronger, new, old)
    return starts, ends, best


def quoted(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Whether each hit stands between quotation marks within WINDOW words."""
    opens = np.isin(codes, [ord(c) for c in OPEN_QUOTES])
    closes = np.isin(codes, [ord(c) for c in CLOSE_QUOTES])
    if not opens.any() or not closes.any():
        return np.zeros(len(hits), dtype=bool)
    total = lambda marks: np.concatenate(([0], np.cumsum(marks)))
    opened, closed, plain = total(opens), total(closes), total(codes == ord('"'))
    left = np.where(hits < WINDOW, 0, starts[np.maximum(hits - WINDOW, 0)])
    right = np.where(hits + WINDOW >= len(ends), len(codes), ends[np.minimum(hits + WINDOW, len(ends) - 1)])
    first, last = starts[hits], ends[hits]
    # A plain mark both opens and closes: a hit is inside it after an odd number.
    paired = opened[first] - opened[left] - (plain[first] - plain[left]) > 0
    inside = (plain[first] % 2 == 1) | paired
    return inside & (opened[first] > opened[left]) & (closed[right] > closed[last])


def features(text: str | None, model: Model) -> np.ndarray:
    """What a document's score is made of: summed weights of plain and of
    quoted hits, exact and misspelled; the strongest window's score, in which
    quoted hits count against; hits per 100 words; the quoted share."""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    codes = points(text)
    starts, ends, states = match_words(codes, model)
    hits = np.flatnonzero(model.accepts[states] > 0)
    if not len(hits):
        return out
    weight, near = model.accepts[states[hits]], model.inexact[states[hits]]
    in_quotes = quoted(codes, starts, ends, hits)
    for k, chosen in enumerate((~near & ~in_quotes, ~near & in_quotes, near & ~in_quotes, near & in_quotes)):
        out[k] = np.log1p(weight[chosen].sum())
    signed = np.concatenate(([0.0], np.cumsum(np.where(in_quotes, -weight, weight) * np.where(near, 0.5, 1.0))))
    low, high = np.searchsorted(hits, hits - WINDOW), np.searchsorted(hits, hits + WINDOW, side="right")
    out[4] = np.log1p(max(0.0, (signed[high] - signed[low]).max()))
    out[5] = np.log1p(100 * len(hits) / len(starts))
    out[6] = in_quotes.mean()
    return out


def _sample_features(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the bounded sample."""
    plain = tuple(model)

    def run(batches):
        held = Model(*plain)
        for batch in batches:
            found = [features(t.as_py(), held).tolist() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)],
                                             names=["features", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, "features array<double>, toxic int").collect()
    return (np.array([r["features"] for r in rows]).reshape(len(rows), N_FEATURES),
            np.array([r["toxic"] for r in rows], dtype=float))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients, the constant last, of a ridge-penalised logistic regression by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-3])
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from documents joined to labels (doc_id, toxic).

    Of each class the documents whose ids hash lowest are taken, SAMPLE_TOXIC
    and SAMPLE_CLEAN at most; of rows that share text and class one counts.
    What reaches the driver is their feature rows and the terms that pass, so
    the sample bounds both.  A document labelled more than once is toxic if
    any label says so; null labels and ids count for nothing.  Without both
    classes the lexicon is empty and every score is the share of toxic rows.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = None
    for toxic, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        part = marks.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # Broadcast: SAMPLE_TOXIC + SAMPLE_CLEAN ids at most.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "text", "toxic", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("row"))
    sample = materialize(sample, "toxicity-sample")
    # Hashes are grouped, so texts are not shuffled.
    firsts = sample.groupBy("text_key", "toxic").agg(F.min("row").alias("row"))
    sample = materialize(sample.join(firsts.select("row"), "row", "left_semi").select("text", "toxic"), "toxicity-texts")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    entries = lexicon(term_counts(sample), n_toxic, n_clean)
    model = Model(*compile_lexicon(entries), np.zeros(N_FEATURES + 1))
    x, y = _sample_features(sample, model)
    return model._replace(coefficients=_logistic(x, y))


def score_column(model: Model, text: Column) -> Column:
    """The score of every text, 0 to 1; null, empty and wordless texts get that of a text without hits."""
    plain = tuple(model)  # plain values, for workers without this package

    def run(texts: pa.Array) -> pa.Array:
        held = Model(*plain)
        logits = [float(features(t.as_py(), held) @ held.coefficients[:-1] + held.coefficients[-1]) for t in texts]
        return pa.array(1 / (1 + np.exp(-np.clip(logits, -30, 30))), pa.float64())

    return F.arrow_udf(run, "double")(text)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``, from its whole text alone.

    ``predicted`` is 1 for a score of at least 0.5.  Repeated rows come back
    as often as they came; other columns are not read.
    """
    scored = docs.select("doc_id", score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose score is 0.5 or more, all columns unchanged."""
    return docs.where(score_column(model, F.col("text")) < 0.5)


def train_rows(rows: DataFrame) -> DataFrame:
    """The rows that may be learned from: crc32 of doc_id modulo 5 is not 0."""
    return rows.where(crc_mod("doc_id", 5) != 0)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, train_rows(table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
