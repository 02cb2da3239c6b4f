"""Benchmark decontamination by latent semantic retrieval and order checks.

The benchmark is taken in blocks of ``BLOCK_ITEMS`` items, so what the driver and the tasks
hold for it is bounded. For each block:

1. Documents are rewritten once as codes of the block's words (0: any other word) and
   written to the shared folder; document frequencies are counted over all of them.
2. A randomised SVD of the TF-IDF matrix of passages gives a latent space: every power
   step multiplies the matrix, spread over tasks, by a narrow block of vectors. Its rows
   are all items and a bounded sample of ``FIT_PASSAGES`` corpus passages (those of the
   documents with the smallest hashes); only the index is fitted on the sample.
3. Every document is cut into half-overlapping passages of 16, 32, 64, ... words; each is
   compared by cosine in the latent space with the items of its length.
4. Passages whose cosine is too low are candidates too where they can pass step 5: so many
   of an item's words must be there that one of its *anchors*, a few of its rarest words,
   must be. Every passage around an anchor is a candidate, so the cosine loses no match.
5. Around each candidate, the longest common subsequence of words with the item, and the
   share of the item's answer words that occur, decide. Answer words are those of the
   benchmark's answer column, or else the item's rarest third.

Words are runs of characters other than ASCII punctuation and white space, in lower case.
A document and an item match when the subsequence holds ``lcs`` of the item's words (all, if
the item has fewer than ``SHORT``), and at least ``answers`` of the answer words occur.

Defined results: null, empty or wordless texts and items match nothing; documents with
equal ids count as one document and the best match is returned; a null id is an id like
others; equal items match alike. Whole texts are read, in spans of ``SPAN`` words that
overlap by more than the longest passage. Extra columns are not read.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, plain_words, staged

BLOCK_ITEMS = 2_000
FIT_PASSAGES = 20_000
FIT_PARTS = 4
RANK, EXTRA, STEPS = 128, 8, 2
SMALLEST = 16
UNIT = 8  # passages begin and end at multiples of so many words
SPAN = 1 << 15
SHORT = 5

@dataclass
class Items:
    """A block of the benchmark: words as codes from 1."""

    ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    codes: dict[bytes, int]

    def scale(self, place: int) -> int:
        """Words in the passages that this item is compared with."""
        size = SMALLEST
        while size < len(self.words[place]):
            size *= 2
        return size


def read_items(rows: list, answer_col: str | None) -> Items:
    codes: dict[bytes, int] = {}
    coded = lambda text: np.array([codes.setdefault(w, len(codes) + 1) for w in plain_words(text)], dtype=np.int32)
    kept = [(r["item"], coded(r["text"]), coded(r["answer"] if answer_col else None)) for r in rows]
    kept = [k for k in kept if len(k[1])]
    return Items([k[0] for k in kept], [k[1] for k in kept], [k[2] for k in kept], codes)


class _Coder(dict):
    """Codes of words; any other word is 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _coded(docs: DataFrame, kind: str, items: Broadcast) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Coder(items.value.codes)
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                words = plain_words(text)
                row = np.fromiter(map(codes.__getitem__, words), dtype=np.int32, count=len(words))
                found.append(row.tobytes() if row.any() else None)
            out = pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "codes"])
            yield out.filter(pa.compute.is_valid(out.column("codes")))

    return docs.mapInArrow(code, f"id {kind}, codes binary")


def _document_counts(coded: DataFrame, terms: int) -> np.ndarray:
    """Documents that hold each term; one row per term and task is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 1, dtype=np.int64)
        for batch in batches:
            for row in batch.column("codes"):
                total[np.unique(np.frombuffer(row.as_buffer(), dtype=np.int32))] += 1
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "n"])

    counts = np.zeros(terms + 1, dtype=np.int64)
    for row in coded.select("codes").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        counts[row["term"]] = row["n"]
    return counts


def _halves(units: np.ndarray) -> np.ndarray:
    """Sums of neighbouring pairs; an odd last one stays alone."""
    pairs = units[::2].copy()
    pairs[: len(units) // 2] += units[1::2]
    return pairs


def _step(passages: list[np.ndarray], idf: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A'(A v) for the normalised TF-IDF rows A of passages given as term codes."""
    out = np.zeros_like(vectors)
    for codes in passages:
        terms, times = np.unique(codes[codes > 0], return_counts=True)
        row = times * idf[terms]
        if len(row):
            row = row / np.sqrt((row**2).sum())
            out[terms] += row[:, None] * (row @ vectors[terms])[None, :]
    return out


def _latent(coded: DataFrame, items: Items, idf: np.ndarray, documents: int) -> np.ndarray:
    """Term vectors (terms, rank) that fold a passage in: leading right singular vectors,
    each divided by its singular value, so that no frequent topic outweighs the others."""
    terms = len(idf)
    size = max(map(items.scale, range(len(items.ids))))
    share = min(1.0, 2 * FIT_PASSAGES / 4 / max(1, documents))
    sample = staged(
        coded.filter(F.pmod(F.xxhash64("codes"), F.lit(1 << 40)) <= int(share * (1 << 40)))
        .orderBy(F.xxhash64("codes"), F.length("codes")).limit(FIT_PASSAGES // 4)
        .repartition(FIT_PARTS), "fit",
    )

    def multiplied(vectors: np.ndarray) -> np.ndarray:
        shared = coded.sparkSession.sparkContext.broadcast(vectors)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros_like(shared.value)
            for batch in batches:
                for row in batch.column("codes"):
                    codes = np.frombuffer(row.as_buffer(), dtype=np.int32)
                    cut = [codes[i : i + size] for i in range(0, len(codes), size)]
                    picked = [cut[i] for i in sorted({0, len(cut) // 3, 2 * len(cut) // 3, len(cut) - 1})]
                    total += _step(picked, idf, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part"])

        parts = sample.select("codes").mapInArrow(run, "part binary").collect()
        shared.unpersist()
        out = _step(items.words, idf, vectors)
        for part in parts:
            out = out + np.frombuffer(part["part"], dtype=np.float32).reshape(vectors.shape)
        return out

    width = min(RANK + EXTRA, terms)
    vectors = np.random.default_rng(17).standard_normal((terms, width))
    for _ in range(STEPS):
        vectors, _ = np.linalg.qr(multiplied(vectors))
    product = multiplied(vectors)  # A'A Q; its projection is small and symmetric
    values, rotation = np.linalg.eigh(vectors.T @ product)
    leading = np.argsort(-values)[:RANK]
    leading = leading[values[leading] > 1e-9 * max(values.max(), 1e-300)]
    return vectors @ rotation[:, leading] / np.sqrt(values[leading])


def longest_common(item: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence, one machine word of bits at a time."""
    at: dict[int, int] = {}
    for place, word in enumerate(item):
        at[word] = at.get(word, 0) | 1 << place
    full = (1 << len(item)) - 1
    row = full
    for word in words:
        hit = row & at.get(word, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


@dataclass
class Searcher:
    """Items in the latent space, by the length of the passages they are compared with."""

    items: Items
    weights: np.ndarray  # (terms + 1, rank): latent vector of each code times its idf
    answers: list[np.ndarray]
    held: np.ndarray  # documents that hold each code
    cosine: float
    lcs: float
    share: float

    def __post_init__(self):
        self.by_scale: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        scales = np.array([self.items.scale(i) for i in range(len(self.items.ids))])
        for scale in sorted(set(scales.tolist())):
            places = np.flatnonzero(scales == scale)
            vectors = np.array([self.weights[self.items.words[i]].sum(axis=0) for i in places])
            self.by_scale[scale] = places, _unit(vectors).T.astype(np.float32)
        self.longest = int(scales.max())
        self.steps = scales // 2
        self.answer_sets = [frozenset(a.tolist()) for a in self.answers]
        pairs = [(code, item) for item in range(len(scales)) for code in self._anchors(item)]
        codes, self.anchored = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T
        # the items of which code c is an anchor: anchored[ends[c - 1] : ends[c]]
        self.ends = np.cumsum(np.bincount(codes, minlength=len(self.weights)))
        self.is_anchor = np.bincount(codes, minlength=len(self.weights)) > 0

    def _anchors(self, item: int) -> list[int]:
        """Codes of which each passage that passes the checks holds one: where k of n words
        must occur, any n - k + 1 of them. None if the checks ask for no word, or for more
        than there are."""
        answers, (words, times) = self.answers[item], np.unique(self.items.words[item], return_counts=True)
        answers = np.unique(answers)
        of_answers = next((k for k in range(len(answers) + 1) if k / len(answers) >= self.share), math.inf)
        of_item = self._least(len(self.items.words[item]))
        choices = [
            self._prefix(w, n, n.sum() - least + 1)
            for w, n, least in ((answers, np.ones_like(answers), of_answers), (words, times, of_item))
            if 0 < least
        ]
        if not choices or of_answers > len(answers) or of_item > times.sum():
            return []
        return min(choices, key=lambda c: self.held[c].sum()).tolist()

    def _prefix(self, words: np.ndarray, times: np.ndarray, wanted: float) -> np.ndarray:
        """The rarest words that make up so many together."""
        order = np.lexsort((words, self.held[words]))
        return words[order[: np.searchsorted(np.cumsum(times[order]), wanted) + 1]]

    def _least(self, size: int) -> int:
        """Words in common order that an item of so many words needs."""
        return size if size < SHORT else math.ceil(self.lcs * size)

    def matches(self, documents: list[np.ndarray]) -> Iterator[tuple[int, dict[int, tuple]]]:
        """Of each document with any: its place and the best match by item, which is cosine,
        share in common order, share of answers, and first word of the passage."""
        best: dict[int, dict[int, tuple]] = {}
        for group in self._groups(documents):
            self._search(documents, group, best)
        for place, codes in enumerate(documents):
            for item, first in self._around_anchors(codes):
                self._judge(best, place, item, None, codes, first, int(self.steps[item]))
        yield from sorted(best.items())

    def _groups(self, documents: list[np.ndarray]) -> Iterator[list[tuple[int, int]]]:
        """Spans (document, first word) of about SPAN words together."""
        group, held = [], 0
        for place, codes in enumerate(documents):
            for base in range(0, len(codes), SPAN):
                group.append((place, base))
                held += min(SPAN, len(codes) - base)
                if held >= SPAN:
                    yield group
                    group, held = [], 0
        if group:
            yield group

    def _search(self, documents: list[np.ndarray], group: list[tuple[int, int]], best: dict) -> None:
        # spans lie one behind the other, apart by the longest passage at least
        parts, places, at = [], [], 0
        for place, base in group:
            span = documents[place][base : base + SPAN + self.longest]
            parts.append((at, span))
            places.append(at)
            at += -(-len(span) // self.longest) * self.longest + self.longest
        codes = np.zeros(at, dtype=np.int32)
        for start, span in parts:
            codes[start : start + len(span)] = span
        units = np.vstack([self._units(codes[k : k + 4096]) for k in range(0, at, 4096)])
        step = UNIT
        while 2 * step <= self.longest:
            if 2 * step in self.by_scale:
                items, vectors = self.by_scale[2 * step]
                near = _unit(units[:-1] + units[1:]) @ vectors
                for window, column in zip(*(found.tolist() for found in np.nonzero(near >= self.cosine))):
                    start = window * step
                    which = bisect_right(places, start) - 1
                    place, base = group[which]
                    first = base + start - places[which]
                    self._judge(best, place, int(items[column]), float(near[window, column]), documents[place], first, step)
            units, step = _halves(units), 2 * step

    def _units(self, codes: np.ndarray) -> np.ndarray:
        """Sums of word vectors over each UNIT words."""
        held = np.flatnonzero(codes)
        starts = np.searchsorted(held, np.arange(0, len(codes), UNIT))
        some = np.diff(np.append(starts, len(held))) > 0
        units = np.zeros((len(starts), self.weights.shape[1]), dtype=np.float32)
        if len(held):
            units[some] = np.add.reduceat(self.weights[codes[held]], starts[some], axis=0)
        return units

    def _around_anchors(self, codes: np.ndarray) -> Iterator[tuple[int, int]]:
        """Items and first words of the passages that have an anchor in them or beside them."""
        at = np.flatnonzero(self.is_anchor[codes])
        if not len(at):
            return
        ends = self.ends[codes[at]]
        times = ends - self.ends[codes[at] - 1]
        behind = np.cumsum(times)
        items = self.anchored[np.arange(behind[-1]) + np.repeat(ends - behind, times)]
        steps = self.steps[items]
        windows = (np.repeat(at, times) // steps)[:, None] + np.arange(-2, 2)
        inside = (windows >= 0) & (windows * steps[:, None] < len(codes))
        first = (windows * steps[:, None])[inside]
        found = np.unique(np.repeat(items, inside.sum(axis=1)) * (len(codes) + 1) + first)
        yield from zip((found // (len(codes) + 1)).tolist(), (found % (len(codes) + 1)).tolist())

    def _cosine(self, item: int, passage: np.ndarray) -> float:
        sums = [self.weights[codes[codes > 0]].sum(axis=0) for codes in (self.items.words[item], passage)]
        one, other = _unit(np.array(sums))
        return float(one @ other)

    def _judge(self, best: dict, place: int, item: int, near: float | None, codes: np.ndarray, first: int, step: int) -> None:
        known = best.get(place, {}).get(item)
        if known and known[1] >= 1:
            return
        found = self._checked(item, codes[max(0, first - step) : first + 3 * step])
        if found and (not known or found > known[1:3]):
            if near is None:
                near = self._cosine(item, codes[first : first + 2 * step])
            best.setdefault(place, {})[item] = (near, *found, first)

    def _checked(self, item: int, around: np.ndarray) -> tuple[float, float] | None:
        wanted, words = self.answer_sets[item], around.tolist()
        answers = len(wanted.intersection(words)) / max(1, len(wanted))
        if answers < self.share:
            return None
        words_of_item = self.items.words[item].tolist()
        size = len(words_of_item)
        common = longest_common(words_of_item, words)
        return (common / size, answers) if common >= self._least(size) else None


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    return rows / np.where(length > 1e-9, length, 1)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    answer_col: str | None = None,
    cosine: float = 0.5,
    lcs: float = 0.6,
    answers: float = 0.6,
) -> DataFrame:
    """One row per document and item that match: ids, ``cosine``, ``lcs_share``,
    ``answer_share``, ``first_word`` (of the passage found). ``cosine`` is the least for a
    passage without regard to its words; a match that holds an anchor may have less."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = benchmark.select(
        F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"),
        (F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")).alias("answer"),
    ).orderBy("item", "text")
    kind, item_kind = dict(rows.dtypes)["id"], dict(wanted.dtypes)["item"]
    found = None
    listed = wanted.toLocalIterator()
    while block := list(itertools.islice(listed, BLOCK_ITEMS)):
        items = read_items(block, answer_col)
        if items.ids:
            part = _search(rows, kind, items, item_kind, (cosine, lcs, answers))
            found = part if found is None else found.unionByName(part)
    if found is None:
        schema = f"id {kind}, item {item_kind}, cosine double, lcs_share double, answer_share double, first_word long"
        found = docs.sparkSession.createDataFrame([], schema)
    best = found.groupBy("id", "item").agg(
        F.max(F.struct("lcs_share", "answer_share", "cosine", F.col("first_word"))).alias("m")
    )
    return best.select(
        F.col("id").alias(id_col), F.col("item").alias(item_col if item_col != id_col else f"{item_col}_item"),
        "m.cosine", "m.lcs_share", "m.answer_share", "m.first_word",
    )


def _search(rows: DataFrame, kind: str, items: Items, item_kind: str, limits: tuple) -> DataFrame:
    context = rows.sparkSession.sparkContext
    coded = staged(_coded(rows, kind, context.broadcast(items)), "coded")
    counts = _document_counts(coded, len(items.codes))
    documents = coded.count()
    idf = np.log((1 + documents) / (1 + counts)) + 0.01
    idf[0] = 0
    latent = _latent(coded, items, idf, documents)
    names = {code: word for word, code in items.codes.items()}
    rare = [
        a if len(a) else _rarest(w, idf, names) for w, a in zip(items.words, items.answers)
    ]
    weights = (latent * idf[:, None] ** 2).astype(np.float32)  # folded in, rare words first
    searcher = context.broadcast(Searcher(items, weights, rare, counts, *limits))
    names = ["id", "item", "cosine", "lcs_share", "answer_share", "first_word"]
    schema = f"id {kind}, item {item_kind}, cosine double, lcs_share double, answer_share double, first_word long"
    kinds = arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = searcher.value
        for batch in batches:
            codes = [np.frombuffer(row.as_buffer(), dtype=np.int32) for row in batch.column("codes")]
            out = [
                (place, using.items.ids[i], *m) for place, hits in using.matches(codes) for i, m in hits.items()
            ]
            ids = batch.column("id").take(pa.array([o[0] for o in out], pa.int64()))
            columns = [pa.array([o[k] for o in out], kinds.field(k).type) for k in range(1, len(names))]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

    return coded.mapInArrow(search, schema)


def _rarest(words: np.ndarray, idf: np.ndarray, names: dict[int, bytes]) -> np.ndarray:
    """The rarest third of the distinct words; of equally rare ones the words decide, so that
    other items of the block do not."""
    distinct = sorted(set(words.tolist()), key=lambda c: (-idf[c], names.get(c, b"")))
    return np.array(distinct[: max(1, -(-len(distinct) // 3))], dtype=words.dtype)
