"""Language identification by cross-parsing entropy against suffix automata."""

from __future__ import annotations

import random
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import crc_mod, table

#: The bounded sample a language's automaton is made of: about so many letters
#: of a document, so many letters in all.
DOC_CHARS = 1_000
REFERENCE_CHARS = 24_000
#: A passage ends behind a word whose hash says so, once it has so many letters,
#: or at the second number: the same words make the same passages anywhere.
PASSAGE_CHARS = (60, 250)
#: Languages that a model may hold; more is an error, as each adds a table of
#: about 24 * 2 * REFERENCE_CHARS bytes to what every worker loads.
MAX_LANGUAGES = 100
_GAP, _UNKNOWN = 0, 1  # what is no letter; a letter that no reference holds
#: A document is parsed in windows of so many symbols, all of them; the parse
#: starts anew in each, which costs one phrase, the same for every language.
WINDOW_CHARS = 1_024
_ROWS = 4_096      # windows parsed side by side


class Table(NamedTuple):
    """Parsing table of one reference.

    A state is a number of its own to which a symbol is added: the cell there
    holds the state (upper half) and the state that follows (lower half) if
    the symbol goes on from it.  Otherwise a phrase has ended, and ``first``
    has the state behind the symbol as the next phrase's beginning.  State 0
    is the start.
    """
    cells: np.ndarray
    first: np.ndarray


class Model(NamedTuple):
    symbols: np.ndarray                 # symbol of each code point; _GAP for what is no letter
    languages: tuple[str, ...]
    tables: tuple[Table, ...]
    bits: tuple[float, ...]             # log2 of the reference's length: the price of a phrase


def _letters(text: str) -> str:
    return "".join(c if c.isalpha() else " " for c in text.lower())


def _symbol_map(samples: list[str]) -> np.ndarray:
    """Every letter of the samples has a symbol of its own; all other letters
    share _UNKNOWN, which no parse can match, whatever they are."""
    out = np.zeros(0x110000, dtype=np.int32)
    out[[p for p in range(0x110000) if not 0xD800 <= p < 0xE000 and chr(p).isalpha()]] = _UNKNOWN
    for i, c in enumerate(sorted({c for text in samples for c in text if c != " "})):
        out[ord(c)] = _UNKNOWN + 1 + i
    return out


def encode(text: str, symbols: np.ndarray) -> np.ndarray:
    """Symbols of the lower-cased text, with one gap for each run of other characters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = symbols[points]
    keep = out != _GAP
    keep[1:] |= out[:-1] != _GAP
    return out[keep]


def _suffix_automaton(sequence: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``sequence``, by state; state 0 is the start."""
    step, link, length = [{}], [-1], [0]
    last = 0
    for symbol in sequence.tolist():
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = new
            at = link[at]
        if at >= 0:
            old = step[at][symbol]
            if length[at] + 1 == length[old]:
                link[new] = old
            else:
                twin = len(step)
                step.append(dict(step[old]))
                length.append(length[at] + 1)
                link.append(link[old])
                while at >= 0 and step[at].get(symbol) == old:
                    step[at][symbol] = twin
                    at = link[at]
                link[old] = link[new] = twin
        last = new
    return step


def automaton(sequence: np.ndarray, n_symbols: int) -> Table:
    """The parsing table of ``sequence``, whose symbols lie below ``n_symbols``.

    A suffix automaton of n symbols has fewer than 2n states and 3n
    transitions, however large the alphabet, so only the transitions that
    exist get a cell: each state, those with most transitions first, takes a
    random free number at which none of its cells is taken.  Fewer than half
    of all cells are used in the end, so a few trials do.
    """
    step = _suffix_automaton(sequence)
    width = 1 << max(8, int(2 * sum(map(len, step)) + len(step[0])).bit_length())
    rng = random.Random(width)
    taken = bytearray(width + n_symbols)
    number, used = [0] * len(step), {0}
    for symbol in step[0]:
        taken[symbol] = 1
    for state in sorted(range(1, len(step)), key=lambda s: -len(step[s])):
        symbols = step[state]
        while True:
            at = rng.randrange(width)
            if at not in used and not any(taken[at + s] for s in symbols):
                break
        used.add(at)
        number[state] = at
        for s in symbols:
            taken[at + s] = 1
    cells = np.full(width + n_symbols, -1, dtype=np.int64)
    for state, symbols in enumerate(step):
        for symbol, after in symbols.items():
            cells[number[state] + symbol] = (number[state] << 32) | number[after]
    first = np.zeros(n_symbols, dtype=np.int64)
    for symbol, after in step[0].items():
        first[symbol] = number[after]
    return Table(cells, first)


def passages(text: str) -> list[str]:
    """The text's letters, lower-cased, in passages cut by their own words."""
    out, held, size = [], [], 0
    low, high = PASSAGE_CHARS
    for word in _letters(text).split():
        for piece in (word[i:i + high] for i in range(0, len(word), high)):
            held.append(piece)
            size += len(piece) + 1
            if size >= high or (size >= low and zlib.crc32(piece.encode("utf-8", "surrogatepass")) % 8 == 0):
                out.append(" ".join(held))
                held, size = [], 0
    return [*out, " ".join(held)] if held else out


def _chosen(text: str) -> list[tuple[int, str]]:
    """(number, passage) of distinct passages of the whole text, those that hash lowest, DOC_CHARS letters or all there are."""
    first: dict[str, int] = {}
    for i, passage in enumerate(passages(text)):
        first.setdefault(passage, i)
    out, size = [], 0
    for passage in sorted(first, key=lambda p: (xxhash.xxh3_64_intdigest(p.encode("utf-8", "surrogatepass")), p)):
        if size >= DOC_CHARS:
            break
        out.append((first[passage], passage))
        size += len(passage)
    return sorted(out)


def _until_full(rows: list[tuple]) -> list[tuple]:
    """The first of rows (rank, number, passage) that hold REFERENCE_CHARS letters, each passage once."""
    out, seen, size = [], set(), 0
    for row in sorted(rows):
        if size >= REFERENCE_CHARS:
            break
        if row[2] not in seen:
            seen.add(row[2])
            out.append(row)
            size += len(row[2])
    return out


def _sample(known: DataFrame) -> DataFrame:
    """(lang, rank, number, passage) from (lang, rank, text): for each language
    and task, passages of the documents that rank lowest.

    A document beyond those that fill a reference in its task is beyond those
    that fill it in all, so it is not read further.
    """
    def run(batches):
        held: dict[str, list[tuple]] = {}
        limit: dict[str, int] = {}  # documents that rank higher can't enter
        for batch in batches:
            langs, ranks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, (lang, rank) in enumerate(zip(langs, ranks, strict=True)):
                if lang in limit and rank > limit[lang]:
                    continue
                mine = held.setdefault(lang, [])
                mine += [(rank, number, passage) for number, passage in _chosen(batch.column(2)[row].as_py())]
                if sum(len(r[2]) for r in mine) >= 4 * REFERENCE_CHARS:
                    held[lang] = mine = _until_full(mine)
                    if sum(len(r[2]) for r in mine) >= REFERENCE_CHARS:
                        limit[lang] = mine[-1][0]
        rows = [(lang, *r) for lang, mine in held.items() for r in _until_full(mine)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int32(), pa.string()))],
            names=["lang", "rank", "number", "passage"])

    return known.select("lang", "rank", "text").mapInArrow(run, "lang string, rank bigint, number int, passage string")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the rows of ``docs`` with a language and a text.

    Each language's reference is made of the documents whose ids and texts
    hash lowest, as many as it takes: DOC_CHARS letters of each, passages that
    a hash chooses from the whole text, REFERENCE_CHARS in all.  A passage
    enters a reference once, so headers that documents share don't fill it.
    What reaches the driver is bounded by the number of languages.  A language
    of which no text has a letter stays in the model with an empty reference,
    in which every letter is a phrase.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    names = [r[0] for r in known.select(lang_col).distinct().orderBy(lang_col).limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    known = known.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("rank"),
                         F.col(text_col).alias("text"))
    once = _sample(known).groupBy("lang", "passage").agg(F.min(F.struct("rank", "number")).alias("at"))
    before = Window.partitionBy("lang").orderBy("at", "passage").rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum(F.length("passage")).over(before), F.lit(0)) >= REFERENCE_CHARS
    texts: dict[str, list[str]] = {name: [] for name in names}
    for row in once.withColumn("full", full).where("NOT full").orderBy("lang", "at", "passage").collect():
        texts[row["lang"]].append(row["passage"])
    references = {name: " ".join(parts)[:REFERENCE_CHARS] for name, parts in texts.items()}
    symbols = _symbol_map(list(references.values()))
    sequences = [encode(text, symbols) for text in references.values()]
    n_symbols = int(symbols.max()) + 1
    return Model(symbols, tuple(references), tuple(automaton(s, n_symbols) for s in sequences),
                 tuple(float(np.log2((len(s) or REFERENCE_CHARS) + 1)) for s in sequences))


def phrases(sequences: list[np.ndarray], tables: tuple[Table, ...]) -> np.ndarray:
    """Phrases of each sequence (rows) in each language's parse (columns)."""
    owner = [i for i, s in enumerate(sequences) for _ in range(0, len(s), WINDOW_CHARS)]
    windows = [s[a:a + WINDOW_CHARS] for s in sequences for a in range(0, len(s), WINDOW_CHARS)]
    order = sorted(range(len(windows)), key=lambda w: len(windows[w]))
    out = np.zeros((len(sequences), len(tables)), dtype=np.int64)
    for a in range(0, len(order), _ROWS):
        some = order[a:a + _ROWS]
        lengths = np.array([len(windows[w]) for w in some])
        block = np.zeros((lengths[-1], len(some)), dtype=np.int32)
        for row, w in enumerate(some):
            block[:len(windows[w]), row] = windows[w]
        begin = np.searchsorted(lengths, np.arange(lengths[-1]), side="right")  # rows from here on are longer
        rows = np.array([owner[w] for w in some])
        for k, (cells, first) in enumerate(tables):
            state = np.zeros(len(some), dtype=np.int64)
            count = np.ones(len(some), dtype=np.int32)  # the phrase that the window's end cuts off
            for symbols, b in zip(block, begin, strict=True):
                symbols, now = symbols[b:], state[b:]
                cell = cells[now + symbols]
                ended = (cell >> 32) != now
                count[b:] += ended
                state[b:] = np.where(ended, first[symbols], cell & 0xFFFFFFFF)
            np.add.at(out[:, k], rows, count)
    return out


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) for every row of ``docs``.

    A text's cost in a language is its number of phrases times log2 of the
    reference's length, per symbol: the fewest normalised phrases win, equal
    costs go to the language that sorts first.  ``score`` is the runner-up's
    share of the two lowest costs (1 with a single language).  A text that is
    null or has no letter is ``und`` with score 0, as is every text when no
    language was learned.  Whole texts are read; other columns are not.
    """
    plain = (model.symbols, model.languages, tuple(map(tuple, model.tables)), model.bits)
    shared = docs.sparkSession.sparkContext.broadcast(plain)  # plain values, for workers without this package

    def run(batches):
        held = Model(*shared.value)
        for batch in batches:
            langs, scores, todo, size = [], [], [], 0
            texts = batch.column(1)
            for i, text in enumerate(texts):
                todo.append(encode(text.as_py() or "", held.symbols))
                size += len(todo[-1])
                if size > 4_000_000 or i == len(texts) - 1:
                    for lang, score in _decide(todo, held):
                        langs.append(lang)
                        scores.append(score)
                    todo, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")


def _decide(sequences: list[np.ndarray], model: Model) -> list[tuple[str, float]]:
    lettered = [bool((s != _GAP).any()) for s in sequences]
    if not model.languages:
        return [("und", 0.0)] * len(sequences)
    cost = phrases(sequences, model.tables) * np.array(model.bits)
    best = np.argmin(cost, axis=1)  # the first of equals; languages are sorted
    low = np.sort(cost, axis=1)
    score = low[:, 1] / (low[:, 0] + low[:, 1] + 1e-300) if cost.shape[1] > 1 else np.ones(len(cost))
    return [(model.languages[b], float(s)) if some else ("und", 0.0)
            for b, s, some in zip(best, score, lettered, strict=True)]


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, learned from those whose crc32 mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = learn(docs.where(crc_mod("doc_id", 3) != 1))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
