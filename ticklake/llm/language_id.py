"""Language identification by cross-parsing entropy over suffix automata.

For every language a suffix automaton of labelled text is built. A text is parsed from
left to right into the longest phrases that occur in that text (a symbol found nowhere is
a phrase of its own). ``phrases * log2(size of the labelled text)`` estimates the bits the
text costs under the language; the cheapest language wins, and the score is its share
among all languages when a bit halves the odds.

Letters and the marks on them are lower-cased, runs of other characters count as one
break. Symbols are the bytes of UTF-8, so an automaton has at most 256 of them while every
letter of every script stays itself. The whole text is one parse: pieces of a batch's texts
walk all automata side by side in numpy, and a piece is walked again for as long as the
state that the piece before it ends in is not the one it began with. Nearly always that
is once, since parses that differ at first soon meet.

``learn`` counts the words of all labelled texts, each as a whole. The automaton of a language
reads its words from the most to the least frequent, as many as make ``MODEL_BYTES``; of the
words that are as frequent as the last ones, a share by hash. So every labelled row counts,
while the automata, built in tasks and broadcast in the form that is walked, stay at some megabytes
a language. A run of letters longer than ``WORD`` bytes, as scripts without spaces have, counts
as its pieces of that length, each half over the one before. ``fit`` learns from running text
instead: at most ``sample_docs`` documents per language, each as a whole, taken in hashed order
while they fit into ``sample_bytes``; documents longer than ``document_bytes`` are not among
them, and a language that has only such ones is learned from the shortest. No query uses it.

Defined results: null or letterless text is ``und`` with score 0, as is every text when
nothing was learned; ties go to the first language in alphabetical order; rows are
predicted one by one, so repeated rows get equal answers and an empty table none. The
prediction reads the text alone.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import crc32_of, staged

UNDETERMINED = "und"
PIECE = 1024
LANES = 4096
WIDE = 256  # symbols
BREAK, MARK, LETTER = 0, 1, 2  # kinds of characters
SPREAD = 1 << 40
MODEL_BYTES = 120_000  # of words in the automaton of a language
WORD = 32  # bytes
COUNTED = 500_000  # words that a task counts before it passes them on


@dataclass
class Model:
    """Automata of all languages as one table of edges.

    The edge of state ``s`` by symbol ``c`` lies in slot ``base[s] + c`` if ``owner`` there
    is ``s``; rows of states interleave. ``first`` has the state that a new phrase begins with.
    """

    languages: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    first: np.ndarray = field(default_factory=lambda: np.zeros((0, WIDE), np.int32))
    base: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    owner: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    target: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def learn(self, language: str, sequence: np.ndarray) -> None:
        self.add(language, len(sequence), *automaton(sequence))

    def add(
        self, language: str, size: int, symbol: np.ndarray, end: np.ndarray,
        base: np.ndarray, owner: np.ndarray, target: np.ndarray,
    ) -> None:
        """Put in an automaton, with the symbols and ends of the edges at its start."""
        root, slot = len(self.base), len(self.owner)
        first = np.full(WIDE, root, dtype=np.int32)
        first[symbol] = root + end
        self.languages.append(language)
        self.sizes.append(size)
        self.roots = np.append(self.roots, np.int32(root))
        self.first = np.vstack([self.first, first])
        self.base = np.append(self.base, base + np.int32(slot))
        self.owner = np.append(self.owner, np.where(owner < 0, -1, owner + root).astype(np.int32))
        self.target = np.append(self.target, target + np.int32(root))


@cache
def character_kinds() -> np.ndarray:
    """Kind of each code point."""
    of = {"L": LETTER, "M": MARK}
    return np.fromiter(
        (of.get(unicodedata.category(chr(point))[0], BREAK) for point in range(0x110000)), np.uint8, 0x110000
    )


def symbols(text: str) -> tuple[np.ndarray, bool]:
    """The text as bytes with runs of breaks collapsed to a space, and whether it has a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    kinds = character_kinds()[points]
    keep = kinds != BREAK
    lettered = bool((kinds == LETTER).any())
    inside = keep.copy()
    keep[1:] |= inside[:-1]
    keep[:1] = True
    shown = np.where(inside, points, ord(" "))[keep].astype("<u4")
    return np.frombuffer(shown.tobytes().decode("utf-32-le").encode(), dtype=np.uint8), lettered


def suffix_automaton(sequence: list[int]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """States and edges of the automaton that reads every substring of the sequence."""
    link, length, moves = [-1], [0], [{}]
    last = 0
    for symbol in sequence:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at != -1:
            target = moves[at][symbol]
            if length[target] == length[at] + 1:
                link[new] = target
            else:
                clone = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at != -1 and moves[at].get(symbol) == target:
                    moves[at][symbol] = clone
                    at = link[at]
                link[target] = link[new] = clone
        last = new
    edges = [(a, s, b) for a, out in enumerate(moves) for s, b in out.items()]
    columns = np.array(edges, dtype=np.int32).reshape(-1, 3)
    return len(moves), columns[:, 0].copy(), columns[:, 1].astype(np.uint8), columns[:, 2].copy()


def automaton(sequence: np.ndarray) -> tuple[np.ndarray, ...]:
    """Symbols and ends of the edges at the start; base of each state, owner and target of each slot."""
    states, start, symbol, end = suffix_automaton(sequence.tolist())
    return symbol[start == 0], end[start == 0], *interleaved(states, start, symbol, end)


def interleaved(
    states: int, start: np.ndarray, symbol: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges, ordered by their start, in slots: base of each state, owner and target of each slot.

    States of most edges are placed first, at the first base whose slots are free; those
    of one edge, the bulk, fill what is left.
    """
    counts = np.bincount(start, minlength=states)
    begins = np.concatenate([[0], np.cumsum(counts)])
    room = len(start) + 2 * WIDE
    free = np.ones(2 * room + 4 * PIECE, dtype=bool)
    free[:WIDE] = False  # a base is not negative
    base = np.zeros(states, dtype=np.int32)
    several = np.flatnonzero(counts > 1)
    low, size = 0, 0
    for state in several[np.argsort(-counts[several], kind="stable")].tolist():
        row = symbol[begins[state] : begins[state + 1]].astype(np.int64)
        if counts[state] != size:
            low, size = 0, counts[state]
        while True:
            if low + PIECE + WIDE > len(free):
                free = np.append(free, np.ones(len(free), dtype=bool))
            fits = free[low + row[0] : low + row[0] + PIECE].copy()
            for at in row[1:]:
                fits &= free[low + at : low + at + PIECE]
            found = int(fits.argmax())
            if fits[found]:
                break
            low += PIECE
        base[state] = low + found
        free[low + found + row] = False
    single = np.flatnonzero(counts == 1)
    free = np.append(free, np.ones(len(single), dtype=bool))
    base[single] = np.flatnonzero(free)[: len(single)] - symbol[begins[single]]
    slots = base[start] + symbol.astype(np.int32)
    last = max(int(base.max(initial=0)), int(slots.max(initial=0)))
    owner = np.full(last + WIDE, -1, dtype=np.int32)
    target = np.zeros(last + WIDE, dtype=np.int32)
    owner[slots] = start
    target[slots] = end
    return base, owner, target


def words_of(text: str) -> list[bytes]:
    """The words of a text, long ones in overlapping pieces."""
    found = symbols(text)[0].tobytes().split()
    if max(map(len, found), default=0) <= WORD:
        return found
    return [
        word[at : at + WORD] for word in found for at in range(0, max(len(word) - WORD // 2, 1), WORD // 2)
    ]


def word_counts(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang``, ``word`` and ``n`` of all texts that have a letter and a language."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()),
                     pa.array(words.values(), pa.int64())],
                    names=["lang", "word", "n"],
                )
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                seen.setdefault(lang, Counter()).update(words_of(text.as_py()))
                if sum(map(len, seen.values())) > COUNTED:
                    yield from emptied()
        yield from emptied()

    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return (
        rows.filter(r"lang IS NOT NULL AND text RLIKE '\\p{L}'")
        .mapInArrow(counted, "lang string, word binary, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", model_bytes: int = MODEL_BYTES) -> Model:
    """Learn from all labelled rows: per language its most frequent words by their counts."""
    counts = staged(word_counts(labelled, text_col, lang_col), "words")
    down = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    levels = (  # words of equal count come in or not as one, but for the last ones
        counts.groupBy("lang", "n").agg(F.sum(F.octet_length("word") + 1).alias("bytes"))
        .withColumn("above", F.sum("bytes").over(down) - F.col("bytes"))
        .filter(F.col("above") < model_bytes)
        .select("lang", "n", ((model_bytes - F.col("above")) / F.col("bytes")).alias("share"))
    )
    spread = F.pmod(F.xxhash64("word"), F.lit(SPREAD)) < F.col("share") * SPREAD
    kinds = "lang string, size long, symbol binary, end binary, base binary, owner binary, target binary"

    def build(words: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values(["n", "word"], ascending=[False, True])
        sequence = np.frombuffer(b" " + b" ".join(words["word"]) + b" ", dtype=np.uint8)
        parts = [part.tobytes() for part in automaton(sequence)]
        return pd.DataFrame([[words["lang"].iloc[0], len(sequence), *parts]], columns=[k.split()[0] for k in kinds.split(", ")])

    chosen = counts.join(levels, ["lang", "n"]).filter(spread).groupBy("lang").applyInPandas(build, kinds)
    model = Model()
    for row in sorted(chosen.collect(), key=lambda r: r["lang"]):
        symbol, *rest = row[2:]
        model.add(row["lang"], row["size"], np.frombuffer(symbol, np.uint8), *(np.frombuffer(part, np.int32) for part in rest))
    return model


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = 300,
    document_bytes: int = 20_000,
    sample_bytes: int = 120_000,
) -> Model:
    """Learn from a bounded sample: per language the documents of smallest hashed id.

    Documents per language are counted first, and only a share of the hashed ids that
    holds about twice the sample is read in full, so what is sorted does not grow.
    """
    spread = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(1)), F.lit(SPREAD))
    named = labelled.filter(F.col(lang_col).isNotNull())
    limits = [
        value for row in named.groupBy(F.col(lang_col).cast("string")).count().collect()
        for value in (F.lit(row[0]), F.lit(2 * sample_docs * SPREAD // row[1]))
    ]
    if not limits:
        return Model()
    long = F.col("bytes") > document_bytes
    order = Window.partitionBy("lang").orderBy(
        long, F.when(long, F.col("bytes")), F.xxhash64(F.col("id").cast("string")), "id", F.xxhash64("text"), "text"
    )
    rows = (
        named.filter(spread <= F.create_map(*limits)[F.col(lang_col).cast("string")])
        .select(
            F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
            F.col(text_col).cast("string").alias("text"),
        )
        .filter(r"text RLIKE '\\p{L}'")
        .withColumn("bytes", F.octet_length("text"))
        .withColumns({"place": F.row_number().over(order), "total": F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))})
        .filter((F.col("place") == 1) | ((F.col("place") <= sample_docs) & (F.col("total") <= sample_bytes) & ~long))
        .orderBy("lang", "place")
        .select("lang", "text")
        .collect()
    )
    texts: dict[str, list[str]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append(row["text"])
    model = Model()
    for language in sorted(texts):
        model.learn(language, np.concatenate([symbols(" " + text)[0] for text in texts[language]]))
    return model


def phrases(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Phrases of each symbol sequence under each language: (languages, texts)."""
    owner, pieces, follows = [], [], []
    for place, sequence in enumerate(texts):
        for at in range(0, len(sequence), PIECE):
            owner.append(place)
            pieces.append(sequence[at : at + PIECE])
            follows.append(at > 0)
    later = np.flatnonzero(follows)
    entry = np.repeat(model.roots[:, None], len(pieces), axis=1)
    end = entry.copy()
    begun = np.zeros(entry.shape, dtype=np.int32)
    todo = np.arange(len(pieces))
    lengths = np.array([len(piece) for piece in pieces], dtype=np.int64)
    while len(todo):
        todo = todo[np.argsort(-lengths[todo], kind="stable")]
        for at in range(0, len(todo), LANES):
            lanes = todo[at : at + LANES]
            begun[:, lanes], end[:, lanes] = _walk(model, [pieces[i] for i in lanes], entry[:, lanes])
        todo = later[(entry[:, later] != end[:, later - 1]).any(axis=0)]
        entry[:, todo] = end[:, todo - 1]
    total = np.zeros((len(texts), len(model.languages)), dtype=np.int64)
    np.add.at(total, np.array(owner, dtype=np.int64), begun.T)
    return total.T


def _walk(model: Model, pieces: list[np.ndarray], state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases begun in pieces, sorted from long to short, and the states at their ends."""
    lengths = np.array([len(p) for p in pieces])
    grid = np.zeros((len(pieces), lengths[0]), dtype=np.uint8)
    for lane, piece in enumerate(pieces):
        grid[lane, : len(piece)] = piece
    grid = np.ascontiguousarray(grid.T)
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    state = state.copy()
    begun = np.zeros(state.shape, dtype=np.int32)
    roots = model.roots[:, None]
    for step, count in enumerate(active):
        now, symbol = state[:, :count], grid[step, :count]
        slot = model.base.take(now) + symbol
        goes_on = model.owner.take(slot) == now
        begun[:, :count] += ~goes_on | (now == roots)
        state[:, :count] = np.where(goes_on, model.target.take(slot), model.first.take(symbol, axis=1))
    return begun, state


def predict(model: Model, texts: list[str | None]) -> pd.DataFrame:
    """Language and score of each text."""
    if not model.languages or not len(texts):
        return pd.DataFrame({"lang_pred": [UNDETERMINED] * len(texts), "score": [0.0] * len(texts)})
    read = [symbols(t or "") for t in texts]
    lettered = np.array([has for _, has in read], dtype=bool)
    bits = np.log2(np.maximum(np.array(model.sizes, dtype=float), 2))
    cost = phrases(model, [s for s, _ in read]) * bits[:, None]
    best = cost.argmin(axis=0)
    excess = np.minimum(cost - cost.min(axis=0), 1000.0)
    score = np.where(lettered, 1.0 / np.exp2(-excess).sum(axis=0), 0.0)
    names = np.array([*model.languages, UNDETERMINED], dtype=object)
    return pd.DataFrame({"lang_pred": names[np.where(lettered, best, len(model.languages))], "score": score})


def predictor(model: Broadcast, text: Column) -> Column:
    """Column ``struct<lang_pred string, score double>`` of a text column."""

    @F.pandas_udf("lang_pred string, score double")
    def language_of(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            yield predict(model.value, [t if isinstance(t, str) else None for t in texts])

    return language_of(text)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score``."""
    found = predictor(share(docs, model), F.col(text_col).cast("string"))
    return docs.select(F.col(id_col), found.alias("p")).select(id_col, "p.lang_pred", "p.score")


def share(docs: DataFrame, model: Model) -> Broadcast:
    return docs.sparkSession.sparkContext.broadcast(model)


def learnable(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """The rows a model may learn from: hashed id not in the held-out third."""
    return crc32_of(id_col) % 3 != 1
