"""Ranked lexical search by dense blocked multiplication.

Every item is scored against every document: a term's weight is the floor of
``1000 * ln((2N + 2) / (2 df + 1))``, its impact in a document
``(10**9 * tf) div (1000 * tf + 8 * m)`` with ``m = 25 + (75 * n * N) div L``, and a score
sums weight times impact over the item's terms, repeats included. All of that is whole
numbers after the weight, so equal scores are equal exactly.

The method. Items are taken in blocks of bounded size. Of every document the terms of the
block are counted once and staged, and a combining aggregation over them gives N, L and df.
Then each task multiplies tiles: the compact vocabulary of some items (items x terms, float64)
times the impacts of some documents (terms x documents, float64) by BLAS. A tile's columns are
split until no item's sum can reach 2**53, and tile products are added up as 64-bit integers, so
nothing is rounded. Of each tile the documents at or above the k-th score are kept, ties
included, so that the smallest ids win; each task hands on its k best per item, and a window
takes the k best of all. Memory depends on the block and the tile sizes, not on the corpus; a
further block of items (``block_terms`` distinct terms of items) means another pass over the
documents.

Defined results: null texts and texts without a term are no documents (they count neither in N
nor in L), and items without a term have no rows. Benchmark rows that repeat id and text count
once; rows that share an id are one item with the terms of all its texts. Documents that
share an id are ranked one by one. Equal scores go by ascending id, a null id first. Ids are
64-bit integers. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, staged, term_parts

BLOCK_TERMS = 500_000  # terms of items, counted per item, that one pass holds
ITEMS = 64  # items of a tile
TERMS = 2_048  # vocabulary of a tile
DOCS = 256  # documents of a tile
IMPACT = 1_000_000  # no impact reaches it
EXACT = 1 << 53

_CODED = "doc_id long, n long, codes binary, counts binary"
_FOUND = "item_id long, doc_id long, score long"
FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def rank(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The k best documents of each item: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    terms = staged(_terms_of(items, item_id, item_text), "item-terms")
    found = [_search(texts, terms.filter(here), k) for here in _blocks(terms, block_terms)]
    if not found:
        found = [docs.sparkSession.createDataFrame([], _FOUND)]
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return (
        reduce(DataFrame.union, found)
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )


def _terms_of(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """``item_id``, ``term``, ``times``, one row per item and term."""
    schema = arrow_schema("item_id long, term binary, times long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                seen: Counter = Counter()
                for words in term_parts(text):
                    seen.update(words)
                if seen:
                    columns = [[item] * len(seen), list(seen), list(seen.values())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                    )

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    return (
        rows.distinct().mapInArrow(counted, "item_id long, term binary, times long")
        .groupBy("item_id", "term").agg(F.sum("times").alias("times"))
    )


def _blocks(terms: DataFrame, block_terms: int) -> list:
    """Conditions that deal the items into blocks of about ``block_terms`` rows, at most twice
    that; an item of its own beyond that size is a block by itself."""
    sizes = terms.groupBy("item_id").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    count = -(-total // block_terms)
    while count:
        block = F.pmod(F.xxhash64(F.lit(7), "item_id"), F.lit(count))
        crowded = sizes.groupBy(block).agg(F.sum("size").alias("size"), F.count("*").alias("items"))
        if crowded.filter((F.col("size") > 2 * block_terms) & (F.col("items") > 1)).isEmpty():
            return [block == b for b in range(count)]
        count *= 2
    return []


def _search(texts: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """The best documents of a block of items, up to k per item and task."""
    spark = texts.sparkSession
    block = Block.of(terms.collect())  # at most twice block_terms rows
    coded = staged(_coded(texts, spark.sparkContext.broadcast(block.vocabulary)), "coded-documents")
    documents, length = coded.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    block.weigh(documents, _holders(coded, len(block.vocabulary)))
    shared = spark.sparkContext.broadcast((block.tiles(), documents, length))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, n_docs, n_terms = shared.value
        return Scorer(tiles, n_docs, n_terms, k).best(batches)

    return coded.mapInArrow(best, _FOUND)


def _coded(texts: DataFrame, vocabulary) -> DataFrame:
    """Documents that have a term: ``n`` terms, and codes and counts of those of the block."""
    schema = arrow_schema(_CODED)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of = vocabulary.value.get
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                n, seen = 0, Counter()
                for words in term_parts(text.as_py()):
                    n += len(words)
                    seen.update(filter(None, map(code_of, words)))
                if n:
                    rows[0].append(doc)
                    rows[1].append(n)
                    rows[2].append(np.fromiter(seen.keys(), "<i4", len(seen)).tobytes())
                    rows[3].append(np.fromiter(seen.values(), "<i4", len(seen)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

    return texts.mapInArrow(coded, _CODED)


def _holders(coded: DataFrame, vocabulary: int) -> np.ndarray:
    """Documents that hold each code; one row per code of the block comes to the driver."""
    schema = arrow_schema("code int, docs long")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs = np.zeros(vocabulary + 1, dtype=np.int64)
        for batch in batches:
            for codes in batch["codes"]:
                docs[np.frombuffer(codes.as_py(), "<i4")] += 1
        held = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(docs[held])], schema=schema)

    found = np.zeros(vocabulary + 1, dtype=np.int64)
    parts = coded.select("codes").mapInArrow(counted, "code int, docs long")
    for code, docs in parts.groupBy("code").agg(F.sum("docs")).collect():
        found[code] = docs
    return found


class Block:
    """Items with their terms as codes from 1, and later the terms' weights."""

    @classmethod
    def of(cls, rows: list) -> Block:
        block = cls()
        block.vocabulary = {t: c for c, t in enumerate(sorted({bytes(r["term"]) for r in rows}), 1)}
        block.items = sorted({r["item_id"] for r in rows}, key=lambda i: (i is not None, i or 0))
        place = {item: at for at, item in enumerate(block.items)}
        block.item = np.array([place[r["item_id"]] for r in rows], dtype=np.int64)
        block.code = np.array([block.vocabulary[bytes(r["term"])] for r in rows], dtype=np.int64)
        block.times = np.array([r["times"] for r in rows], dtype=np.int64)
        return block

    def weigh(self, documents: int, holders: np.ndarray) -> None:
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holders.tolist()]
        self.weight = np.array(weights, dtype=np.int64) * (holders > 0)

    def tiles(self) -> list[tuple[list, list[tuple]]]:
        """Per tile of items their ids and, for each of its vocabulary tiles, the codes and the
        weights as (row, column) and value; ``Scorer`` makes them dense one at a time."""
        worth = self.weight[self.code] * self.times
        order = np.lexsort([self.code, self.item])
        order = order[worth[order] > 0]
        item, code, worth = self.item[order], self.code[order], worth[order]
        found = []
        for start in range(0, len(self.items), ITEMS):
            low, high = np.searchsorted(item, [start, start + ITEMS])
            codes, column = np.unique(code[low:high], return_inverse=True)
            ids = self.items[start : start + ITEMS]
            parts = []
            for first in range(0, len(codes), TERMS):
                inside = (column >= first) & (column < first + TERMS)
                dense = np.zeros((len(ids), min(TERMS, len(codes) - first)), dtype=np.int64)
                dense[item[low:high][inside] - start, column[inside] - first] = worth[low:high][inside]
                for part, values in exact_parts(codes[first : first + TERMS], dense):
                    at = np.nonzero(values)
                    parts.append((part, at, values[at]))
            found.append((ids, parts))
        return found


def exact_parts(codes: np.ndarray, worth: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Columns split until no item's product with impacts can reach 2**53; a single column
    beyond that is split into smaller numbers that add up to it."""
    if int(worth.sum(axis=1).max(initial=0)) * IMPACT < EXACT:
        yield codes, worth
    elif len(codes) > 1:
        half = len(codes) // 2
        yield from exact_parts(codes[:half], worth[:, :half])
        yield from exact_parts(codes[half:], worth[:, half:])
    else:
        half = worth // 2
        yield from exact_parts(codes, half)
        yield from exact_parts(codes, worth - half)


class Scorer:
    """Multiplies document tiles with all tiles of a block and keeps the best of each item."""

    def __init__(self, tiles: list, documents: int, length: int, k: int):
        self.tiles, self.documents, self.length, self.k = tiles, documents, length, k
        # per item tile: item, score, whether the id is known, id, all of kept documents
        self.kept = [tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) for _ in tiles]
        self.least = [np.ones(len(ids), dtype=np.int64) for ids, _ in tiles]

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS):
                self.add(batch.slice(start, DOCS))
        for (ids, _), (item, score, known, doc) in zip(self.tiles, self.kept):
            columns = [
                pa.array([ids[i] for i in item.tolist()], pa.int64()),
                pa.array(doc, pa.int64(), mask=known == 0), pa.array(score, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=FOUND)

    def add(self, tile: pa.RecordBatch) -> None:
        doc_id = tile["doc_id"].to_pylist()
        known = np.array([d is not None for d in doc_id], dtype=np.int64)
        ids = np.array([d or 0 for d in doc_id], dtype=np.int64)
        codes = [np.frombuffer(c, "<i4") for c in tile["codes"].to_pylist()]
        column = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        code = np.concatenate(codes)
        tf = np.frombuffer(b"".join(tile["counts"].to_pylist()), "<i4").astype(np.int64)
        m = np.array([25 + 75 * n * self.documents // self.length for n in tile["n"].to_pylist()], dtype=np.int64)
        impact = (10**9 * tf) // (1000 * tf + 8 * m[column])
        order = np.argsort(code, kind="stable")
        code, column, impact = code[order], column[order], impact[order].astype(np.float64)
        present, begins = np.unique(code, return_index=True)
        begins = np.append(begins, len(code))
        for place, (items, parts) in enumerate(self.tiles):
            scores = np.zeros((len(items), len(codes)), dtype=np.int64)
            for part, (row, at), worth in parts:
                # compact: only terms that the tile of documents holds
                _, inside, here = np.intersect1d(part, present, assume_unique=True, return_indices=True)
                if not len(inside):
                    continue
                narrow = np.full(len(part), -1)
                narrow[inside] = np.arange(len(inside))
                used = narrow[at] >= 0
                left = np.zeros((len(items), len(inside)))
                left[row[used], narrow[at[used]]] = worth[used]
                right = np.zeros((len(inside), len(codes)))
                lengths = begins[here + 1] - begins[here]
                picked = np.repeat(begins[here] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
                right[np.repeat(np.arange(len(inside)), lengths), column[picked]] = impact[picked]
                scores += (left @ right).astype(np.int64)
            self.keep(place, scores, known, ids)

    def keep(self, place: int, scores: np.ndarray, known: np.ndarray, ids: np.ndarray) -> None:
        """Documents of a tile at or above the k-th score, then the k best with those before."""
        bar = self.least[place]
        if scores.shape[1] > self.k:
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, doc = np.nonzero(scores >= bar[:, None])
        if not len(item):
            return
        new = (item, scores[item, doc], known[doc], ids[doc])
        both = [np.concatenate(pair) for pair in zip(self.kept[place], new)]
        order = np.lexsort([both[3], both[2], -both[1], both[0]])
        both = [values[order] for values in both]
        starts = np.searchsorted(both[0], both[0])
        nth = np.arange(len(starts)) - starts
        full = nth == self.k - 1
        self.least[place][both[0][full]] = both[1][full]
        self.kept[place] = tuple(values[nth < self.k] for values in both)
