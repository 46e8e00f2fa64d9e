"""Spelling variant grouping: k-d trees over letter counts, then letter order.

One inserted, deleted or replaced letter moves a word's letter counts by at
most two (L1).  More exactly, by length pair: a replacement raises one count by
one and lowers one by one; an insertion raises one count by one.  So the words
near w lie in a small box around w's counts, and a k-d tree over the counts is
searched with the boxes of its nodes: a node is entered only if the counts can
be reached with at most one raise and (equal lengths) one drop.  Words that
pass are compared letter by letter, all at once in numpy.

Counting runs in DataFrame functions; a word in a third of all texts is summed
before the shuffle.  The vocabulary is dealt to cells: for every length a k-d
tree, fitted on a bounded sample of the vocabulary (``SAMPLE`` words), has
leaves of about ``CELL`` words.  Each word lies in one cell of its length and
asks in all cells of its length and of the next length whose box it may reach,
a number that grows with the square of the tree's depth.  A cell's task builds
its own finer tree and gives, per word, the number of near words and the best
of them, never the pairs.  So no task holds more than a cell and those that ask
there; the driver holds the sample and its trees.

Letters are folded to 32 counts (a-z, six classes for the rest), which can only
let more words through to the comparison: nothing is lost.

Defined results: null texts hold no words; a null id takes no edit (its hash is
null); empty tables give no rows; repeated rows count as often as they occur;
texts and words may have any length; other columns are ignored whatever their
names; of near words with equal counts the first in code-point order is the form.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, table

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAMPLE = 100_000  # words of the vocabulary that fit the trees of cells, whatever its size
CELL = 4_096  # words of a cell
LEAF = 48  # words of a leaf of a cell's own tree
COUNTS = 32
PAIRS = 1 << 18  # word pairs compared at once


# ---- words ------------------------------------------------------------------

def planted(doc_id: Column, run: Column, divisor: int) -> Column:
    """``run``, or the run less one code point where the crc32 of ``doc_id:run`` says so."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % divisor == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, divisor: int = 199) -> DataFrame:
    """(word, n): the distinct words of enough code points and occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        F.translate("text", UPPER, LOWER), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    words = runs.where(F.length("run") >= min_length).select(
        planted(F.col("doc_id"), F.col("run"), divisor).alias("word"))
    return (words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


# ---- k-d trees over letter counts -------------------------------------------

def letters(words: list[str]) -> np.ndarray:
    """(n, L) code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """(n, 32) counts; letters beyond a-z share six classes."""
    n, length = codes.shape
    folded = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % 6).astype(np.int64)
    flat = np.bincount((np.arange(n)[:, None] * COUNTS + folded).ravel(), minlength=n * COUNTS)
    return flat.reshape(n, COUNTS).astype(np.int16 if length < 1 << 15 else np.int32)


class Tree:
    """Nodes as lists: dimension (-1 for a leaf), cut, children; a leaf has its number, rows and their tight box."""

    def __init__(self, points: np.ndarray, leaf: float):
        self.dim, self.cut, self.low_child, self.high_child = [], [], [], []
        self.number, self.rows, self.box = {}, {}, {}
        self._grow(points, np.arange(len(points)), leaf)

    @property
    def leaves(self) -> int:
        return len(self.number)

    def routing(self) -> "Tree":
        """Without rows and boxes: the cuts alone, good for points that the tree was not built from."""
        self.rows, self.box = {}, {}
        return self

    def _grow(self, points, rows, leaf) -> int:
        me = len(self.dim)
        for part in (self.dim, self.cut, self.low_child, self.high_child):
            part.append(-1)
        here = points[rows]
        low, high = here.min(axis=0), here.max(axis=0)
        if len(rows) <= leaf or (low == high).all():
            self.number[me], self.rows[me], self.box[me] = len(self.number), rows, (low, high)
            return me
        dim = int(np.argmax(here.var(axis=0)))
        column = here[:, dim]
        cut = int(np.median(column))
        if cut >= column.max():
            cut = int(column.max()) - 1  # the smaller side is never empty
        self.dim[me], self.cut[me] = dim, cut
        self.low_child[me] = self._grow(points, rows[column <= cut], leaf)
        self.high_child[me] = self._grow(points, rows[column > cut], leaf)
        return me

    def reach(self, points: np.ndarray, raises: int, drops: int):
        """Yield (leaf node, rows of ``points``) for all leaves whose box may hold
        counts that need at most so many raises and drops of single counts."""
        n = len(points)
        zero = np.zeros(n, dtype=np.int32)
        # a node's box by the cuts above it: bounds of the dimensions cut so far
        stack = [(0, np.arange(n), zero, zero, {})]
        while stack:
            node, rows, up, down, box = stack.pop()
            dim = self.dim[node]
            if dim < 0:
                if node in self.box:
                    low, high = self.box[node]
                    at = points[rows]
                    rows = rows[(np.maximum(low - at, 0).sum(axis=1) <= raises)
                                & (np.maximum(at - high, 0).sum(axis=1) <= drops)]
                yield node, rows
                continue
            x = points[rows, dim].astype(np.int32)
            low, high = box.get(dim, (None, None))
            cut = self.cut[node]
            fewer = down + np.maximum(x - cut, 0) - (0 if high is None else np.maximum(x - high, 0))
            keep = fewer <= drops
            if keep.any():
                stack.append((self.low_child[node], rows[keep], up[keep], fewer[keep], box | {dim: (low, cut)}))
            more = up + np.maximum(cut + 1 - x, 0) - (0 if low is None else np.maximum(low - x, 0))
            keep = more <= raises
            if keep.any():
                stack.append((self.high_child[node], rows[keep], more[keep], down[keep], box | {dim: (cut + 1, high)}))


# ---- letter order ------------------------------------------------------------

def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of equal length that differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rows where ``long`` less one letter is ``short``: equal heads and tails cover the short one."""
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= short.shape[1]


def near_pairs(asking: list[str], lying: list[str], tree: Tree | None = None):
    """Yield (i, j) arrays: ``asking[i]`` and ``lying[j]`` differ by one letter.

    Both lists hold distinct words, each list of one length; the asking words
    have the lying ones' length or one letter less.
    """
    a, b = letters(asking), letters(lying)
    inserted = b.shape[1] - a.shape[1]
    points, targets = letter_counts(a), letter_counts(b)
    tree = tree or Tree(targets, LEAF)
    drops = 1 - inserted
    test = one_inserted if inserted else one_replaced
    for leaf, rows in tree.reach(points, 1, drops):
        members = tree.rows[leaf]
        step = max(1, PAIRS // max(1, len(members)))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            moved = targets[members][None, :, :].astype(np.int32) - points[some][:, None, :]
            up = np.maximum(moved, 0).sum(axis=2)
            i, j = np.nonzero((up <= 1) & (up - moved.sum(axis=2) <= drops))
            i, j = some[i], members[j]
            same = test(a[i], b[j])
            yield i[same], j[same]


# ---- cells -------------------------------------------------------------------

def cell_trees(words: DataFrame) -> dict[int, Tree]:
    """A tree of cells for each length, from a bounded sample of the vocabulary."""
    n = words.count()
    share = min(1.0, SAMPLE / max(1, n))
    picked = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    by_length: dict[int, list[str]] = {}
    for row in words.where(picked).select("word").orderBy("word").collect():
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    return {length: Tree(letter_counts(letters(some)), CELL * share).routing() for length, some in by_length.items()}


def deal(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(length, cell, lies, word, n): each word once where it lies, and once in each other cell where it asks."""
    schema = "length int, cell int, lies boolean, word string, n bigint"
    out = pa.schema([("length", pa.int32()), ("cell", pa.int32()), ("lies", pa.bool_()),
                     ("word", pa.string()), ("n", pa.int64())])

    def cells(tree, points, raises, drops):
        if tree is None:  # no word of this length is in the sample: one cell
            yield 0, np.arange(len(points))
            return
        for leaf, rows in tree.reach(points, raises, drops):
            yield tree.number[leaf], rows

    def dealt(batches):
        for batch in batches:
            words = np.array(batch.column("word").to_pylist(), dtype=object)
            lengths, counts = np.array([len(w) for w in words]), batch.column("n").to_numpy()
            for length in np.unique(lengths).tolist():
                word, n = words[lengths == length], counts[lengths == length]
                points = letter_counts(letters(word.tolist()))
                asks = [(length, lies, cell, rows) for lies, (raises, drops) in ((True, (0, 0)), (False, (1, 1)))
                        for cell, rows in cells(trees.get(length), points, raises, drops)]
                asks += [(length + 1, False, cell, rows) for cell, rows in cells(trees.get(length + 1), points, 1, 0)]
                for size, lies, cell, rows in asks:
                    yield pa.RecordBatch.from_pydict(
                        {"length": np.full(len(rows), size, np.int32), "cell": np.full(len(rows), cell, np.int32),
                         "lies": np.full(len(rows), lies), "word": word[rows], "n": n[rows]}, out)

    return words.select("word", "n").mapInArrow(dealt, schema)


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _best(words, counts, keys, partners) -> pa.Table:
    """Per word of ``keys`` the number of its partners and the best one: most
    occurrences, then first in code-point order.  Both are places in ``words``."""
    order = np.empty(len(words), dtype=np.int64)
    order[sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))] = np.arange(len(words))
    at = np.lexsort((order[partners], keys))
    found, first, n_near = np.unique(keys[at], return_index=True, return_counts=True)
    best = partners[at][first]
    return pa.table([pa.array(words[found], pa.string()), pa.array(n_near, pa.int64()),
                     pa.array(words[best], pa.string()), pa.array(counts[best], pa.int64())], schema=_FOUND)


def _search(cell: pa.Table) -> pa.Table:
    """One cell: for every word met, how many near words are found here and the best of them."""
    words = np.array(cell.column("word").to_pylist(), dtype=object)
    counts = cell.column("n").to_numpy()
    lies = cell.column("lies").to_numpy(zero_copy_only=False)
    lengths = np.array([len(w) for w in words])
    here = np.flatnonzero(lies)
    found = [_FOUND.empty_table()]
    if len(here):
        lying = words[here].tolist()
        tree = Tree(letter_counts(letters(lying)), LEAF)
        for length in np.unique(lengths[~lies]).tolist():
            some = np.flatnonzero(~lies & (lengths == length))
            pairs = list(near_pairs(words[some].tolist(), lying, tree))
            if pairs:
                i, j = some[np.concatenate([p[0] for p in pairs])], here[np.concatenate([p[1] for p in pairs])]
                found.append(_best(words, counts, i, j))
                if length < len(lying[0]):  # equal lengths meet from both sides, others only here
                    found.append(_best(words, counts, j, i))
    return pa.concat_tables(found)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near, near_n) for every word that has a near word."""
    trees = cell_trees(words)
    cells = sum(t.leaves for t in trees.values())
    spark = words.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), cells // 2)
    partial = (deal(words, trees).repartition(tasks, "length", "cell").groupBy("length", "cell")
               .applyInArrow(_search, "word string, n_near bigint, near string, near_n bigint"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): follow (word, form) to the last, twice as far each round.

    Counts rise at least fivefold along a chain, so there are no circles and
    few rounds; each is a table in the shared folder.
    """
    found = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(found.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        found = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return found


def spelling_groups(docs: DataFrame, min_length: int = 6, min_count: int = 5, ratio: int = 5,
                    divisor: int = 199) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the vocabulary."""
    words = materialize(vocabulary(docs, min_length, min_count, divisor), "words")
    near = near_words(words)
    holds = F.col("near_n") >= ratio * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(holds, F.col("near")).alias("form"), F.when(holds, F.col("near_n")).alias("form_n")), "near")
    root = roots(known.where("form IS NOT NULL"))
    return known.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of the documents."""
    found = spelling_groups(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


_ALPHABET = f"translate(text, '{UPPER}', '{LOWER}')"
OP13_SQL = f"""WITH RECURSIVE crc_step AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) AS t(i)
  UNION ALL
  SELECT i, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM crc_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_step WHERE k = 8),
runs AS (
  SELECT doc_id, run, count(*) AS m
  FROM (SELECT doc_id, unnest(regexp_extract_all({_ALPHABET}, '{RUN}')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT run, m, hex(encode(doc_id || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, m, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), [CAST((instr('0123456789ABCDEF', h[2 * j - 1]) - 1) * 16
      + instr('0123456789ABCDEF', h[2 * j]) - 1 AS BIGINT) FOR j IN range(1, length(h) // 2 + 1)]),
    lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]))) AS crc
  FROM bytes, crc_table),
words AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, CAST(crc % length(run) AS INT))
                || substr(run, CAST(crc % length(run) AS INT) + 2) ELSE run END AS word, m FROM hashed),
vocab AS MATERIALIZED (
  SELECT word, CAST(sum(m) AS BIGINT) AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
longer AS (SELECT DISTINCT c.word AS word, c.n AS n, v.word AS near, v.n AS near_n
           FROM cut c JOIN vocab v ON v.word = c.rest),
pairs AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT * FROM longer
  UNION ALL SELECT near, near_n, word, n FROM longer),
best AS (
  SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS b FROM pairs GROUP BY word),
known AS MATERIALIZED (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -b.less >= 5 * n THEN b.near END AS form, CASE WHEN -b.less >= 5 * n THEN -b.less END AS form_n
  FROM vocab v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS further FROM known
  UNION ALL
  SELECT c.word, k.word, k.form FROM chain c JOIN known k ON k.word = c.further)
SELECT k.word, form, root, n, n_near, form_n
FROM known k JOIN (SELECT word, root FROM chain WHERE further IS NULL) USING (word)"""
