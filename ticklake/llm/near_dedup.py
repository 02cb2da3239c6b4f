"""Near-duplicate groups by one-permutation MinHash with star-shaped candidates.

1. Each text becomes the set of its distinct word shingles, as 64-bit hashes. Texts with
   equal sets form a class and are represented by their smallest id.
2. One permutation: the hash range is cut into bins, and the smallest hash of each bin is
   its value. Empty bins take the value of a bin drawn by a hash of (bin, attempt), the
   optimal densification, until a filled one is drawn. Bands of the bins give bucket keys.
3. In each bucket the smallest representative is the hub, and every other member makes one
   pair, with the hub. So a bucket of n texts makes n - 1 pairs.
4. Pairs are confirmed on the full shingle sets of whole texts; confirmed links give
   connected components.
5. A star can miss a link between two members that are unlike their hub. Members of all
   buckets around a hub that is not yet in one component with each of them go through an
   exact join on their rarest shingles (prefix filter), across components only, and its
   pairs are confirmed likewise. Every link that banding found as a shared bucket is thus
   decided on full sets, without all pairs of any bucket.

The rows per band are the most for which a pair exactly at the similarity shares a bucket
with a probability of at least ``1 - MISS``.

Defined results: null, empty and wordless texts have no shingles and stay alone; texts of
fewer words than a shingle have one shingle, the whole sequence; rows with a null id stay
alone, without a component; rows that repeat an id belong to one component. Only id and
text are read, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticklake.llm.common import staged
from ticklake.llm.components import smallest_reachable

BINS = 320
MISS = 1e-6
WORDS_KEPT = 200_000
_ODD, _EVEN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """64-bit hashes of words, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _ODD
    values = (values ^ (values >> np.uint64(29))) * _EVEN
    return values ^ (values >> np.uint64(32))


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    words = (text or "").encode("utf-8").lower().split()  # ASCII letters and white space
    if not words:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    length = min(size, len(words))
    mixed = np.full(len(words) - length + 1, length, dtype=np.uint64)
    for place in range(length):
        mixed = _mixed(mixed * _EVEN + each[place : len(words) - length + 1 + place])
    return np.unique(mixed)


def rows_per_band(similarity: int, bins: int = BINS) -> int:
    """The most rows for which a pair at the similarity is missed with at most MISS."""
    return max(
        (r for r in range(1, 65) if (1 - (similarity / 100) ** r) ** (bins // r) <= MISS), default=1
    )


class Sketcher:
    """Signatures of one permutation with optimal densification, and their band keys."""

    def __init__(self, bins: int, rows: int):
        self.bins, self.rows, self.bands = bins, rows, bins // rows
        self.edges = np.array([-(-(i << 64) // bins) for i in range(bins)], dtype=np.uint64)
        self.tries = self._draw(np.arange(bins, dtype=np.uint64), 0)
        self.band_seed = _mixed(np.arange(1, self.bands + 1, dtype=np.uint64))

    def _draw(self, bins: np.ndarray, first: int) -> np.ndarray:
        """The next 64 bins that each empty bin draws."""
        attempt = np.arange(first + 1, first + 65, dtype=np.uint64)
        return (_mixed(bins[:, None] * _ODD + _mixed(attempt)) % np.uint64(self.bins)).astype(np.int64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """Value of each bin, of a set that is not empty and sorted."""
        starts = np.searchsorted(hashes, self.edges)
        ends = np.append(starts[1:], len(hashes))
        filled = starts < ends
        values = hashes[np.minimum(starts, len(hashes) - 1)]
        empty, first = np.flatnonzero(~filled), 0
        while len(empty):
            drawn = self.tries[empty] if first == 0 else self._draw(empty.astype(np.uint64), first)
            hit = filled[drawn]
            found = hit.any(axis=1)
            values[empty[found]] = values[drawn[found, hit[found].argmax(axis=1)]]
            empty, first = empty[~found], first + 64
        return values

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        values = self.signature(hashes)[: self.bands * self.rows].reshape(self.bands, self.rows)
        key = self.band_seed
        for column in values.T:
            key = _mixed(key * _EVEN + column)
        return key.view(np.int64)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: int = 80,
    bins: int = BINS,
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``.

    Texts are linked when 100 * |intersection| >= similarity * |union| of their shingles.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["id"]
    sketches = staged(_sketched(rows, kind, words, bins, rows_per_band(similarity, bins)), "sketches")
    classes = staged(
        sketches.filter("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    stars = staged(_stars(classes, similarity), "stars")
    texts = rows.filter("id IS NOT NULL")
    links = staged(_confirmed(stars.filter("possible"), texts, kind, words, similarity), "confirmed")
    labels = smallest_reachable(links)
    rest = staged(_undecided(stars, labels), "undecided")
    if not rest.isEmpty():
        pairs = _rare_pairs(rest, texts, kind, words, similarity)
        more = staged(_confirmed(pairs, texts, kind, words, similarity), "confirmed")
        labels = smallest_reachable(links.union(more))
    placed = classes.join(labels, F.col("rep") == F.col("id"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component_id")
    )
    return sketches.drop("bands").join(placed, "digest", "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _sketched(rows: DataFrame, kind: str, words: int, bins: int, band_rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sketcher = WordHashes(), Sketcher(bins, band_rows)
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, words, hashes)
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(sketcher.keys(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "bands"],
            )

    return rows.mapInArrow(sketch, f"id {kind}, n_shingles long, digest binary, bands array<long>")


def _stars(classes: DataFrame, similarity: int) -> DataFrame:
    """Pairs of each bucket's hub ``a`` and its other members ``b``."""
    banded = classes.select("rep", "n", F.explode("bands").alias("key"))
    hubs = (
        banded.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("hub"), F.count("*").alias("size"))
        .filter("size > 1").select("key", F.col("hub.rep").alias("a"), F.col("hub.n").alias("an"))
    )
    return (
        banded.join(hubs, "key").filter("a <> rep")
        .select("a", F.col("rep").alias("b"), (
            100 * F.least("n", "an") >= similarity * F.greatest("n", "an")
        ).alias("possible")).distinct()
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, kind: str, words: int, similarity: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, last_set = None, None
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("one").to_pylist(), batch.column("other").to_pylist()):
                if last_set is None or one != last:
                    last, last_set = one, shingles(one, words, hashes)
                theirs = shingles(other, words, hashes)
                shared = len(np.intersect1d(last_set, theirs, assume_unique=True))
                union = len(last_set) + len(theirs) - shared
                keep.append(shared > 0 and 100 * shared >= similarity * union)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.select("a", "b")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("other")), "b")
        .join(texts.select(F.col("id").alias("a"), F.col("text").alias("one")), "a")
        .select("a", "b", "one", "other")
    )
    return joined.mapInArrow(confirm, f"a {kind}, b {kind}").distinct()


def _undecided(stars: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets around hubs that differ in component from a member."""
    component = lambda side: labels.select(F.col("id").alias(side), F.col("component").alias(f"{side}_in"))
    placed = (
        stars.select("a", "b").join(component("a"), "a", "left").join(component("b"), "b", "left")
        .select("a", "b", F.coalesce("a_in", "a").alias("a_in"), F.coalesce("b_in", "b").alias("b_in"))
    )
    open_hubs = placed.filter("a_in <> b_in").select("a").distinct()
    around = placed.join(open_hubs, "a", "left_semi")
    return (
        around.select(F.col("a").alias("id"), F.col("a_in").alias("component"))
        .union(around.select("b", "b_in")).distinct()
    )


def _rare_pairs(members: DataFrame, texts: DataFrame, kind: str, words: int, similarity: int) -> DataFrame:
    """Pairs across components that share one of their rarest shingles, as they must."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, words, hashes).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("component"), pa.array(sets, pa.list_(pa.int64()))],
                names=["id", "component", "found"],
            )

    found = members.join(texts, "id").select("id", "component", "text").mapInArrow(
        listed, f"id {kind}, component {kind}, found array<long>"
    )
    each = staged(found.select("id", "component", F.size("found").alias("n"), F.explode("found").alias("h")), "shingles")
    common = each.groupBy("h").agg(F.count("*").alias("texts")).filter("texts > 1")
    by_rarity = Window.partitionBy("id").orderBy("texts", "h")
    # a similar text shares at least ceil(similarity * n / 100) shingles, so one of the first
    # n - that + 1 in any common order; shingles of one text alone come first and match none
    first = (
        each.join(common, "h")
        .withColumn("place", F.row_number().over(by_rarity) + F.col("n") - F.count("*").over(Window.partitionBy("id")))
        .filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * similarity / 100) + 1)
    )
    # what follows the first shingle that a pair shares bounds its intersection; the pair is
    # made by that one at the latest, whichever shared shingle passes the bound
    one, other = first.alias("x"), first.alias("y")
    most = 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    return (
        one.join(other, "h").filter("x.component < y.component")
        .filter((100 + similarity) * most >= similarity * (F.col("x.n") + F.col("y.n")))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    )
