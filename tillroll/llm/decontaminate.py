"""Benchmark decontamination by latent semantic retrieval.

1. Passages of all documents become TF-IDF rows over hashed terms, document
   frequencies counted over all of them.
2. A randomised SVD of those rows, summed over the cluster, gives the latent
   space of the search index; it is fitted on the passages of all documents.
3. Benchmark pieces and all document windows meet in it: cosines select
   candidates.  Pieces of a few words, too little of a window for a cosine,
   are looked up as word sequences beside it.
4. A weighted longest common subsequence, and for paraphrases a check for the
   item's answer, decide.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, new_path, table
from tillroll.llm.simhash_dedup import _row_key

#: Hashed terms, singular vectors kept, and more random directions than those.
TERM_BITS = 13
TERMS = 1 << TERM_BITS
RANK, OVERSAMPLE = 192, 16
SEED = 20_201
#: Words of a passage in the fitted matrix, and of the blocks that windows are made of.
PASSAGE, BLOCK = 64, 16
#: Benchmark items are cut into pieces of at most PIECE words.  Pieces of up to
#: SHORT words are sought in windows of SPANS[0] blocks, longer ones in SPANS[1].
PIECE, SHORT, SPANS = 48, 20, (2, 4)
#: Cosine in the latent space from which a window is a candidate for a piece.
COSINE = 0.28
#: Pieces of up to FEW words are sought as exact word sequences too.
FEW = 6
#: Share of a piece's weight in the common subsequence: a copy from COPY on, a
#: paraphrase from PARAPHRASE on if ANSWER of the answer's words are there too.
COPY, PARAPHRASE, ANSWER = 0.75, 0.5, 0.6
#: Share of a piece's weight that the words around a window must hold to be
#: compared.  A subsequence can't weigh more than the words it is made of, so
#: the bound of a paraphrase (less what float32 sums may lose) drops no leak.
BAG = PARAPHRASE - 1e-3
#: Without an answer column an item's answer is its ANSWER_WORDS rarest words.
ANSWER_WORDS = 5
#: Pieces that one pass over the documents looks for; more take more passes.
PIECES_PER_PASS = 1_024
_CHARS = 100_000        # characters handled side by side
_ROWS = 512             # windows handled side by side
_FAN_IN = 64            # partial sums added by one task
_PASSAGES, _DENSE = 4_096, 512  # passages multiplied at once, and their commonest terms, which are a dense matrix
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_BASE = 0x9E3779B97F4A7C15


class Words(NamedTuple):
    hashes: np.ndarray      # 64-bit hash of each word
    terms: np.ndarray       # its hashed term
    docs: np.ndarray        # the text it stands in
    at: np.ndarray          # its number there


def _alphabet() -> np.ndarray:
    out = np.zeros(0x110000, dtype=bool)
    out[[p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and chr(p).isalnum()]] = True
    return out


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Tokenizer:
    """Hashes the words (runs of letters and digits, lower-cased) of many texts side by side."""

    def __init__(self, alphabet: np.ndarray):
        self.alphabet = alphabet
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            one = np.ones(1, dtype=np.uint64)
            self.powers = np.concatenate((one, np.cumprod(np.full(n, _BASE, dtype=np.uint64))))
            self.inverses = np.concatenate((one, np.cumprod(np.full(n, inverse, dtype=np.uint64))))

    def __call__(self, texts: list[str]) -> Words:
        joined = "\0".join(t.lower().replace("\0", " ") for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        n = len(points)
        self._grow(n + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum((points + np.uint64(1)) * _MIX[0] * self.powers[:n], out=sums[1:])
            edges = np.flatnonzero(np.diff(np.concatenate(([False], self.alphabet[points], [False])).astype(np.int8)))
            starts, ends = edges[::2], edges[1::2]
            hashes = _scramble((sums[ends] - sums[starts]) * self.inverses[starts])
        docs = np.searchsorted(np.flatnonzero(points == 0), starts)
        first = np.searchsorted(docs, np.arange(len(texts)))
        return Words(hashes, (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64), docs,
                     np.arange(len(starts)) - first[docs])


def _slices(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Consecutive ranges of about ``most`` in all, of one element at least."""
    out, start, total = [], 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most or i == len(sizes) - 1:
            out.append((start, i + 1))
            start, total = i + 1, 0
    return out


# -- the latent space -----------------------------------------------------------

def _passages(texts: list[str], tokenizer: Tokenizer):
    """(term, passage of each term, number of passages) of some texts at a time."""
    for a, b in _slices([len(t) for t in texts], _CHARS):
        words = tokenizer(texts[a:b])
        if len(words.at):
            passage = np.cumsum(words.at % PASSAGE == 0, dtype=np.int32) - 1
            yield words.terms, passage, int(passage[-1]) + 1


def passage_terms(docs: DataFrame, text_col: str) -> DataFrame:
    """(terms, lengths): the hashed terms of the passages of all documents, many
    passages a row, stored in two bytes a word for both passes of the fit."""
    alphabet = _alphabet()  # made once, sent to the tasks

    def run(batches):
        tokenizer = Tokenizer(alphabet)
        for batch in batches:
            for term, passage, n in _passages([t or "" for t in batch.column(0).to_pylist()], tokenizer):
                lengths = np.bincount(passage, minlength=n).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (term.astype(np.uint16), lengths)],
                                                 names=["terms", "lengths"])

    return materialize(docs.select(text_col).mapInArrow(run, "terms binary, lengths binary"), "passages")


def _stored(batches):
    """(terms, passage of each term, number of passages) of about _PASSAGES stored passages at a time."""
    def block():
        terms, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
        ends = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        for a in range(0, len(lengths), _PASSAGES):
            some = lengths[a:a + _PASSAGES]
            yield (terms[ends[a]:ends[a + len(some)]].astype(np.int64), np.repeat(np.arange(len(some)), some), len(some))

    held, n = [], 0
    for batch in batches:
        for stored, sizes in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            if n and n + len(sizes) > _PASSAGES:
                yield from block()
                held, n = [], 0
            held.append((np.frombuffer(stored, dtype=np.uint16), np.frombuffer(sizes, dtype=np.uint8)))
            n += len(sizes)
    if held:
        yield from block()


def document_frequencies(passages: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the ``passage_terms`` each hashed term stands, and how
    many passages there are.  TERMS + 1 sums reach the driver."""
    def run(batches):
        counts = np.zeros(TERMS + 1, dtype=np.int64)
        for term, passage, n in _stored(batches):
            cells = np.sort((passage * TERMS + term).astype(np.int32))
            cells = cells[np.concatenate(([True], cells[1:] != cells[:-1]))]
            counts[:TERMS] += np.bincount(cells % TERMS, minlength=TERMS)
            counts[TERMS] += n
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen], pa.int64())],
                                         names=["term", "n"])

    counted = passages.mapInArrow(run, "term int, n bigint")
    counts = np.zeros(TERMS + 1, dtype=np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return counts[:TERMS], int(counts[TERMS])


def directions() -> np.ndarray:
    """The random test matrix, the same in every task."""
    return np.random.default_rng(SEED).standard_normal((TERMS, RANK + OVERSAMPLE)).astype(np.float32)


def _sum_partials(parts: DataFrame) -> np.ndarray | None:
    """Sum of matrices cut in blocks, rows (part, block, data), _FAN_IN at a time."""
    def add(frame):
        total = np.sum([np.frombuffer(d, dtype=np.float32) for d in frame["data"]], axis=0)
        return frame.iloc[:1].assign(data=[total.tobytes()], part=frame["part"].iloc[0] // _FAN_IN)

    parts = materialize(parts, "partial-sums")
    last = parts.agg(F.max("part")).first()[0]
    if last is None:
        return None
    while last > 0:
        grouped = parts.groupBy("block", F.floor(F.col("part") / _FAN_IN).alias("to"))
        parts = materialize(grouped.applyInPandas(lambda f: add(f), parts.schema), "partial-sums")
        last //= _FAN_IN
    blocks = sorted(parts.collect(), key=lambda r: r["block"])
    return np.concatenate([np.frombuffer(r["data"], dtype=np.float32) for r in blocks]).astype(np.float64)


def _group_sums(table: np.ndarray, rows: np.ndarray, groups: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(groups that occur, the sum of ``table[rows]`` of each).

    The k-th rows of all groups that have one are added together, the largest
    group first, so that each addition is one of whole matrices."""
    size = np.bincount(groups, minlength=n)
    by_size = np.argsort(-size, kind="stable")
    sizes = size[by_size]
    place = np.empty(n, dtype=np.int64)
    place[by_size] = np.arange(n)
    ordered = rows[np.argsort(place[groups], kind="stable")]
    first, filled = np.cumsum(sizes) - sizes, int((sizes > 0).sum())
    out = np.zeros((filled, table.shape[1]), dtype=np.float32)
    for k in range(int(sizes[0])):
        m = int(np.searchsorted(-sizes, -k))  # groups with more than k rows
        out[:m] += table[ordered[first[:m] + k]]
    return by_size[:filled], out


def _add_products(total: np.ndarray, term: np.ndarray, passage: np.ndarray, n: int, weighted: np.ndarray) -> None:
    """Add B'(B ``weighted``) to ``total``, for the counts B of ``n`` passages by term.
    Their commonest terms are multiplied as a dense matrix, the rest word by word."""
    common = np.argpartition(-np.bincount(term, minlength=TERMS), _DENSE)[:_DENSE]
    place = np.full(TERMS, -1, dtype=np.int64)
    place[common] = np.arange(_DENSE)
    at = place[term]
    dense = np.zeros((n, _DENSE), dtype=np.float32)
    np.add.at(dense.reshape(-1), passage[at >= 0] * _DENSE + at[at >= 0], np.float32(1))
    products = dense @ weighted[common]
    term, passage = term[at < 0], passage[at < 0]
    if len(term):
        held, sums = _group_sums(weighted, term, passage, n)
        products[held] += sums
    total[common] += dense.T @ products
    if len(term):
        held, sums = _group_sums(products, passage, term, TERMS)
        total[held] += sums


def sketch(passages: DataFrame, idf: np.ndarray) -> np.ndarray:
    """A'(A G) for the TF-IDF matrix A of the ``passage_terms`` and the random matrix G.

    One pass: a task multiplies its passages with G and the products back with
    the passages, adding into one matrix of TERMS rows; tasks' matrices are
    summed in a tree, and the total of fixed size reaches the driver.
    """
    shared = passages.sparkSession.sparkContext.broadcast(idf.astype(np.float32))
    width, block_rows = RANK + OVERSAMPLE, 512

    def run(batches):
        weights = shared.value
        weighted = directions() * weights[:, None]
        total = np.zeros((TERMS, width))
        for term, passage, n in _stored(batches):
            _add_products(total, term, passage, n, weighted)
        total *= weights[:, None]
        if total.any():
            data = [total[a:a + block_rows].astype(np.float32).tobytes() for a in range(0, TERMS, block_rows)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(data)), pa.int32()), pa.array(data, pa.binary())],
                                             names=["block", "data"])

    parts = passages.mapInArrow(run, "block int, data binary")
    parts = parts.select(F.spark_partition_id().cast("long").alias("part"), "block", "data")
    total = _sum_partials(parts)
    return np.zeros((TERMS, width)) if total is None else total.reshape(TERMS, width)


def whitened_vectors(y: np.ndarray) -> np.ndarray:
    """The RANK leading right singular vectors of A, each over its singular value, from y = A'A G.

    Nystrom's method: A'A is about y (G'y)^+ y', whose eigenvectors follow
    from a factor of y, without another pass over the documents.  Dividing by
    the singular values keeps the few strongest directions, the languages and
    their commonest words, from filling every cosine.
    """
    g = directions().astype(np.float64)
    shifted = y + 1e-9 * max(1.0, float(np.linalg.norm(y))) * g
    core = g.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-12 * max(values.max(), 1e-300)
    factor = shifted @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, singular, _ = np.linalg.svd(factor, full_matrices=False)
    out = np.zeros((TERMS, RANK))
    out[:, :min(RANK, left.shape[1])] = (left / np.maximum(singular, 1e-6 * singular[0]))[:, :RANK]
    return out


class Space(NamedTuple):
    idf: np.ndarray         # weight of each hashed term
    project: np.ndarray     # idf * whitened singular vectors, by hashed term


def fit(docs: DataFrame, text_col: str = "text") -> Space:
    """The latent space of the passages of all ``docs``."""
    passages = passage_terms(docs, text_col)
    df, n = document_frequencies(passages)
    idf = np.log((n + 1) / (df + 1.0)) + 1e-3
    vectors = whitened_vectors(sketch(passages, idf))
    return Space(idf.astype(np.float32), (vectors * idf[:, None]).astype(np.float32))


# -- the search ------------------------------------------------------------------

class Piece(NamedTuple):
    item: object
    hashes: np.ndarray
    terms: np.ndarray
    answer: np.ndarray      # hashes of the words to look for in a paraphrase


def pieces_of(items: list[tuple], space: Space, tokenizer: Tokenizer) -> list[Piece]:
    """Pieces of items (id, text, answer or None), in even parts of at most PIECE words."""
    out = []
    for item, text, answer in items:
        words = tokenizer([text or ""])
        if not len(words.hashes):
            continue
        if answer:
            wanted = np.unique(tokenizer([answer]).hashes)
        else:
            rare = np.argsort(-space.idf[words.terms], kind="stable")[:ANSWER_WORDS]
            wanted = np.unique(words.hashes[rare])
        for part in np.array_split(np.arange(len(words.hashes)), -(-len(words.hashes) // PIECE)):
            inside = wanted if answer else wanted[np.isin(wanted, words.hashes[part])]
            out.append(Piece(item, words.hashes[part], words.terms[part], inside))
    return out


def common_weight(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the heaviest common subsequences of the rows of ``a`` and
    ``b``, element j of ``b`` weighing ``weight[:, j]``; zeros never match."""
    best = np.zeros((len(b), b.shape[1] + 1))
    for column in a.T:
        taken = best[:, :-1] + np.where((b == column[:, None]) & (b != 0), weight, 0)
        best[:, 1:] = np.maximum.accumulate(np.maximum(best[:, 1:], taken), axis=1)
    return best[:, -1]


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` successive words."""
    out = np.zeros(max(len(hashes) - n + 1, 0), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(_BASE) + hashes[k:k + len(out)]
    return out


class Index:
    """Pieces ready for the search: latent vectors, sequences of few words, and term weights for the bag check."""

    def __init__(self, pieces: list[Piece], space: Space):
        self.pieces, self.space = pieces, space
        self.total = np.array([space.idf[p.terms].sum() for p in pieces])
        self.bags = np.zeros((len(pieces), TERMS), dtype=np.float32)
        vectors = np.zeros((len(pieces), RANK), dtype=np.float32)
        for i, piece in enumerate(pieces):
            np.add.at(self.bags[i], piece.terms, space.idf[piece.terms])
            vectors[i] = space.project[piece.terms].sum(axis=0)
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        span = np.array([SPANS[len(p.terms) > SHORT] for p in pieces])
        self.groups = [(s, np.flatnonzero(span == s)) for s in SPANS]
        few = [(len(p.hashes), sequences(p.hashes, len(p.hashes))[0], i)
               for i, p in enumerate(pieces) if len(p.hashes) <= FEW]
        self.few = [(n, np.array(sorted(f[1:] for f in few if f[0] == n), dtype=np.uint64))
                    for n in sorted({f[0] for f in few})]

    def candidates(self, words: Words):
        """(first word, end, piece) arrays of the windows whose cosine and bag
        are high enough, and of the blocks in which a piece of few words begins."""
        out = [self._exact(words, n, few) for n, few in self.few]
        out += self._windows(words)
        return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, dtype=np.int64)] * 3

    @staticmethod
    def _exact(words: Words, n: int, few: np.ndarray):
        """Each block once for each piece of ``n`` words, rows (sequence, piece) of ``few``, that begins in it."""
        runs = sequences(words.hashes, n)
        low, high = (np.searchsorted(few[:, 0], runs, side=side) for side in ("left", "right"))
        at = np.flatnonzero((high > low) & (words.docs[:len(runs)] == words.docs[n - 1:]))
        count = high[at] - low[at]  # equal pieces of several items
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        piece = few[np.repeat(low[at], count) + nth, 1].astype(np.int64)
        first = np.repeat(at - words.at[at] % BLOCK, count)
        first, piece = np.unique(np.stack((first, piece)), axis=1)
        doc_end = np.searchsorted(words.docs, words.docs[first], side="right")
        return first, np.minimum(first + 2 * BLOCK, doc_end), piece

    def _windows(self, words: Words) -> list:
        starts = np.flatnonzero(words.at % BLOCK == 0)
        ends = np.append(starts[1:], len(words.at))
        blocks = self._blocks(words, starts, ends)
        doc = words.docs[starts]
        nothing = len(starts)  # the row of zeros behind the blocks
        out = []
        for span, chosen in self.groups:
            if not len(chosen):
                continue
            begins = np.flatnonzero(words.at[starts] % (span * BLOCK // 2) == 0)  # each overlaps half of the next
            wanted = np.ascontiguousarray(self.vectors[chosen].T)
            for a in range(0, len(begins), _ROWS):
                some = begins[a:a + _ROWS]
                window, last = blocks[some], some
                for k in range(1, span):
                    after = np.minimum(some + k, nothing - 1)
                    inside = (some + k < nothing) & (doc[after] == doc[some])
                    window += blocks[np.where(inside, after, nothing)]
                    last = np.where(inside, after, last)
                norm = np.sqrt(np.einsum("ij,ij->i", window, window))
                row, piece = np.nonzero((window @ wanted >= COSINE * norm[:, None]) & (norm > 0)[:, None])
                out.append(self._bag(words, starts[some[row]], ends[last[row]], chosen[piece], span * BLOCK + PIECE))
        return out

    def _blocks(self, words: Words, starts, ends) -> np.ndarray:
        """Latent vectors of the blocks, and a row of zeros behind them."""
        out = np.zeros((len(starts) + 1, RANK), dtype=np.float32)
        rows = np.vstack([self.space.project, np.zeros((1, RANK), dtype=np.float32)])
        at = starts[:, None] + np.arange(BLOCK)
        term = np.where(at < ends[:, None], words.terms[np.minimum(at, len(words.at) - 1)], TERMS)
        for a in range(0, len(starts), _ROWS):
            total = out[a:a + _ROWS][:len(term[a:a + _ROWS])]
            for column in term[a:a + _ROWS].T:
                total += rows[column]
        return out

    @staticmethod
    def _around(words: Words, first, end):
        """The windows and half a piece of words on either side, within their documents."""
        limits = np.flatnonzero(np.concatenate(([True], words.docs[1:] != words.docs[:-1], [True])))
        doc = np.searchsorted(limits, first, side="right")
        return np.maximum(first - PIECE // 2, limits[doc - 1]), np.minimum(end + PIECE // 2, limits[doc])

    def _bag(self, words: Words, first, end, piece, width):
        keep = np.zeros(len(first), dtype=bool)
        low, high = self._around(words, first, end)
        for a in range(0, len(first), 16_384):
            some = slice(a, a + 16_384)
            at = np.minimum(low[some, None] + np.arange(width), high[some, None] - 1)
            term = np.sort(words.terms[at].astype(np.uint16), axis=1)
            weight = self.bags[piece[some, None], term]
            weight[:, 1:][term[:, 1:] == term[:, :-1]] = 0
            keep[some] = weight.sum(axis=1) >= BAG * self.total[piece[some]]
        return first[keep], end[keep], piece[keep]

    def verify(self, words: Words, first, end, piece):
        """(document, piece, share, answer share) of the candidates that are leaks."""
        if not len(first):
            return []
        low, high = self._around(words, first, end)
        out = []
        for a in range(0, len(first), 4_096):
            some = range(a, min(a + 4_096, len(first)))
            text = np.zeros((len(some), max(high[i] - low[i] for i in some)), dtype=np.uint64)
            item = np.zeros((len(some), PIECE), dtype=np.uint64)
            weight = np.zeros((len(some), PIECE))
            for row, i in enumerate(some):
                p = self.pieces[piece[i]]
                text[row, :high[i] - low[i]] = words.hashes[low[i]:high[i]]
                item[row, :len(p.hashes)] = p.hashes
                weight[row, :len(p.hashes)] = self.space.idf[p.terms]
            share = common_weight(text, item, weight) / self.total[piece[a:a + 4_096]]
            for row, i in enumerate(some):
                answer = self.pieces[piece[i]].answer
                there = float(np.isin(answer, text[row]).mean()) if len(answer) else 1.0
                if share[row] >= COPY or (share[row] >= PARAPHRASE and there >= ANSWER):
                    out.append((int(words.docs[first[i]]), int(piece[i]), float(min(share[row], 1.0)), there))
        return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """(id_col, item_id, kind, overlap, answer_share): each document and item of
    which the document holds a piece, by the best window.

    ``kind`` is ``copy`` or ``paraphrase``; ``overlap`` is the share of the
    piece's weight (words weighted by rarity) in the longest common
    subsequence, ``answer_share`` the share of the answer's words around it.
    All documents are counted and searched, whole texts however long.
    PIECES_PER_PASS pieces make one pass over the documents, whose leaks are
    written before the next begins: the driver, a broadcast and a plan hold one
    pass's pieces, while the number of passes grows with the benchmark.  Null
    or wordless texts and items match nothing; null ids are carried along;
    repeated documents or items give one row for each distinct pair; an empty
    table gives no rows; other columns are not read.
    """
    space = fit(docs, text_col)
    return _leaks(docs, benchmark, space, id_col, text_col, item_col, item_text_col, answer_col)


def _leaks(docs: DataFrame, benchmark: DataFrame, space: Space, id_col: str, text_col: str, item_col: str = "item_id",
           item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``find_leaks`` in a latent space that is given."""
    answer = F.col(answer_col) if answer_col else F.lit(None)
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"),
                             answer.cast("string").alias("answer")).where("text IS NOT NULL").distinct()
    kinds = [f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}",
             f"item_id {benchmark.schema[item_col].dataType.simpleString()}", "overlap double", "answer_share double"]
    spark = docs.sparkSession
    found, path = spark.createDataFrame([], ", ".join(kinds)), new_path(spark, "passes")
    found.write.parquet(path)
    tokenizer, batch = Tokenizer(_alphabet()), []
    for row in items.toLocalIterator():
        batch += pieces_of([tuple(row)], space, tokenizer)
        while len(batch) >= PIECES_PER_PASS:
            _search(docs, Index(batch[:PIECES_PER_PASS], space), id_col, text_col, found.schema, path)
            batch = batch[PIECES_PER_PASS:]
    if batch:
        _search(docs, Index(batch, space), id_col, text_col, found.schema, path)
    found = spark.read.schema(found.schema).parquet(path)
    best = found.groupBy(id_col, "item_id").agg(F.max(F.struct("overlap", "answer_share")).alias("b"))
    kind = F.when(F.col("b.overlap") >= COPY, "copy").otherwise("paraphrase")
    return best.select(id_col, "item_id", kind.alias("kind"), "b.overlap", "b.answer_share")


def _search(docs: DataFrame, index: Index, id_col: str, text_col: str, schema, path: str) -> None:
    """One pass over the documents; its leaks are added to the table at ``path``."""
    plain = ([tuple(p) for p in index.pieces], tuple(index.space))
    shared = docs.sparkSession.sparkContext.broadcast(plain)  # plain values, for workers without this package
    from pyspark.sql.pandas.types import to_arrow_schema
    target, alphabet = to_arrow_schema(schema), _alphabet()

    def run(batches):
        pieces, space = shared.value
        held = Index([Piece(*p) for p in pieces], Space(*space))
        tokenizer = Tokenizer(alphabet)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _slices([len(t) for t in texts], _CHARS):
                words = tokenizer(texts[a:b])
                if len(words.at):
                    leaks = held.verify(words, *held.candidates(words))
                    rows = [(ids[a + doc], held.pieces[piece].item, share, there) for doc, piece, share, there in leaks]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[k] for r in rows], target.field(k).type) for k in range(4)], schema=target)

    docs.select(id_col, text_col).mapInArrow(run, schema).write.mode("append").parquet(path)
    shared.unpersist()


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        **columns) -> DataFrame:
    """``docs`` without the documents that hold a piece of a benchmark item; all
    columns unchanged.  Rows are told apart by id and text, so one without an
    id, or with that of a clean row, goes by its own text."""
    key = _row_key(F.col(id_col), F.xxhash64(text_col)).alias("_key")
    keyed = docs.select(key, F.col(text_col).alias("text"))
    leaks = materialize(_leaks(keyed, benchmark, fit(docs, text_col), "_key", "text", **columns)
                        .select("_key").distinct(), "leaks")
    return docs.select(F.struct("*").alias("_row"), key).join(leaks, "_key", "left_anti").select("_row.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a piece of a benchmark item, with the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
