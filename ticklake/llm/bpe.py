"""Byte-level BPE with word ends: encode and decode by forced-boundary splitting.

A merge joins two neighbouring symbols only if some vocabulary token holds both, side by
side. Two neighbouring byte symbols that stand side by side inside no token therefore mark
a certain cut: no merge ever reaches across. Texts are cut there (and between the
pre-tokens, which merges never cross either); the fragments are encoded independently and
their ids concatenated. Fragments of one batch are merged together in numpy, the best
ranked and leftmost pair of every fragment at a time; long ones go through a heap.

The file is read as the tokenizers library writes it. Supported are the parts that the
vocabularies here use: NFC, white-space replacement and lower-casing; one splitting pattern
followed by byte symbols; BPE with a word-end suffix; added tokens matched in the raw text;
no decoder (tokens are joined by a space). Anything else is refused when loading.

Defined results: null and empty texts have no ids and decode to the empty text; added
tokens inside texts become their ids; every row is encoded by itself. Whole texts are
encoded, however long; a memo of at most ``MEMO`` words per generation spares repeated work
and never changes results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

MEMO = 120_000
PART = 1 << 20  # characters whose words are held at a time
LONG = 48  # symbols from which a fragment is merged with a heap
NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 itself, else from 256."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Memo(dict):
    """Words seen lately; when full, the older half is forgotten."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def fill(self, words: set[str], make: Callable[[list[str]], list]) -> None:
        """Make all of the words available."""
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()
        unknown = []
        for word in words.difference(self):
            known = self.older.get(word)
            if known is None:
                unknown.append(word)
            else:
                self[word] = known
        self.update(zip(unknown, make(unknown)))


class ForcedBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, normal, split = spec["model"], spec["normalizer"], spec["pre_tokenizer"]
        steps = [n["type"] for n in normal["normalizers"]]
        parts = [p["type"] for p in split["pretokenizers"]]
        if (
            model["type"] != "BPE" or not model["end_of_word_suffix"]
            or steps != ["NFC", "Replace", "Lowercase"] or parts != ["Split", "ByteLevel"]
            or any(spec[k] for k in ("decoder", "post_processor"))
            or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        ):
            raise ValueError(f"{path}: parts that forced-boundary splitting does not cover")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.pattern = regex.compile(split["pretokenizers"][0]["pattern"]["Regex"])
        self.space = regex.compile(normal["normalizers"][1]["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self._symbols(model["merges"])
        self.byte_of = {n: b for b, n in enumerate(byte_symbols())}
        self.library = Tokenizer.from_file(path)  # splits characters of the rarer scripts
        self.words, self.chunks = Memo(), Memo()

    def _symbols(self, merges: list) -> None:
        """Tables over symbol ids: bytes are 0-255, bytes that end a word 256-511."""
        names = byte_symbols()
        names += [n + self.end for n in names]
        self.ids = [self.vocab[n] for n in names]  # symbol -> vocabulary id
        number = {n: i for i, n in enumerate(names)}
        for left, right in merges:
            if left + right not in number:
                number[left + right] = len(names)
                names.append(left + right)
                self.ids.append(self.vocab[left + right])
        self.ids = np.array(self.ids, dtype=np.int64)
        self.inside = np.zeros((512, 512), dtype=bool)
        for token in self.vocab:
            ends = token.endswith(self.end) and token != self.end
            units = list(token[: -len(self.end)] if ends else token)
            if ends and units:
                units[-1] += self.end
            for a, b in zip(units, units[1:]):
                if a in number and b in number:
                    self.inside[number[a], number[b]] = True
        size = 1 << 18
        self.mask = size - 1
        self.keys = np.full(size, -1, dtype=np.int64)
        self.ranks = np.full(size, NONE, dtype=np.int32)
        self.made = np.zeros(size, dtype=np.int32)
        self.merge_of: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            a, b, c = number[left], number[right], number[left + right]
            if (a, b) in self.merge_of:
                continue
            self.merge_of[a, b] = rank, c
            key = a << 20 | b
            slot = self._slot(key)
            while self.keys[slot] != -1:
                slot = slot + 1 & self.mask
            self.keys[slot], self.ranks[slot], self.made[slot] = key, rank, c
        self.probes = self._longest_probe()

    def _slot(self, key):
        return (key * 0x9E3779B1 >> 15) & self.mask

    def _longest_probe(self) -> int:
        held = np.flatnonzero(self.keys != -1)
        return int(((held - self._slot(self.keys[held])) & self.mask).max()) + 1

    # merging

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each pair in the table of merges; another's place if it merges never."""
        slot = self._slot(keys)
        missed = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        for _ in range(self.probes):
            if not len(missed):
                break
            slot[missed] = slot[missed] + 1 & self.mask
            there = self.keys[slot[missed]]
            missed = missed[(there != keys[missed]) & (there != -1)]
        return slot

    def _merge_together(self, grid: np.ndarray) -> np.ndarray:
        """Merge the rows of a grid (ended by -1), one merge of each row in every round."""
        rows, width = len(grid), grid.shape[1] - 1
        slots = np.zeros((rows, width), dtype=np.int64)
        ranks = np.full((rows, width), NONE, dtype=np.int32)
        self._rank(grid, slots, ranks, np.s_[:])
        live = np.arange(rows)
        places = np.arange(width + 1)
        while len(live):
            at = ranks[live].argmin(axis=1)
            more = ranks[live, at] != NONE
            live, at = live[more], at[more]
            if not len(live):
                break
            new = self.made[slots[live, at]]
            source = np.minimum(places + (places > at[:, None]), width)
            merged = np.take_along_axis(grid[live], source, axis=1)
            merged[np.arange(len(live)), at] = new
            merged[:, width] = -1
            grid[live] = merged
            self._rank(grid, slots, ranks, live)
        return grid

    def _rank(self, grid, slots, ranks, rows) -> None:
        left, right = grid[rows, :-1], grid[rows, 1:]
        keys = np.maximum(left, 0) << 20 | np.maximum(right, 0)
        slot = self._find(keys.ravel()).reshape(left.shape)
        slots[rows] = slot
        known = (self.keys[slot] == keys) & (right >= 0)
        ranks[rows] = np.where(known, self.ranks[slot], NONE)

    def _merge_long(self, fragment: np.ndarray) -> np.ndarray:
        """Merge a long fragment with a heap of (rank, place)."""
        symbol = fragment.tolist()
        following = [*range(1, len(symbol)), -1]
        before = [-1, *range(len(symbol) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(place: int) -> None:
            after = following[place]
            merge = self.merge_of.get((symbol[place], symbol[after])) if after >= 0 else None
            if merge:
                heapq.heappush(heap, (merge[0], place, symbol[place], symbol[after]))

        for place in range(len(symbol)):
            offer(place)
        while heap:
            _, place, left, right = heapq.heappop(heap)
            after = following[place]
            if symbol[place] != left or after < 0 or symbol[after] != right:
                continue  # something here was merged before
            symbol[place] = self.merge_of[left, right][1]
            symbol[after] = -1
            following[place] = following[after]
            if following[place] >= 0:
                before[following[place]] = place
            if before[place] >= 0:
                offer(before[place])
            offer(place)
        return np.array([s for s in symbol if s >= 0], dtype=np.int64)

    # texts

    def cut(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all words one behind the other, where words begin, and where fragments
        begin: at words, and where no token may reach across."""
        data = [w.encode("utf-8") for w in words]
        ends = np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        symbols = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.int64)
        symbols[ends - 1] += 256
        begins = np.ones(len(symbols), dtype=bool)
        begins[1:] = ~self.inside[symbols[:-1], symbols[1:]]
        starts = np.concatenate([[0], ends[:-1]])
        begins[starts] = True
        return symbols, starts, np.flatnonzero(begins)

    def _encode_words(self, words: list[str]) -> list[tuple[str, str]]:
        """Ids and tokens of pre-tokens, each joined by a space."""
        if not words:
            return []
        symbols, starts, begins = self.cut(words)
        lengths = np.diff(np.append(begins, len(symbols)))
        done = np.full(len(symbols), -1, dtype=np.int64)  # each fragment's result at its begin
        order = np.flatnonzero(lengths <= LONG)
        order = order[np.argsort(lengths[order], kind="stable")]
        for at in range(0, len(order), 4096):
            group = order[at : at + 4096]
            size, first = lengths[group], begins[group]
            places = np.arange(size.max() + 1)
            inside = places < size[:, None]
            sources = np.minimum(first[:, None] + places, len(symbols) - 1)
            merged = self._merge_together(np.where(inside, symbols[sources], -1))
            done[sources[inside]] = merged[inside]
        for place in np.flatnonzero(lengths > LONG):
            first = begins[place]
            merged = self._merge_long(symbols[first : first + lengths[place]])
            done[first : first + len(merged)] = merged
        held = done >= 0
        ends = np.cumsum(np.add.reduceat(held, starts)).tolist()
        ids = self.ids[done[held]].tolist()
        out, at = [], 0
        for end in ends:
            mine = ids[at:end]
            out.append((" ".join(map(str, mine)), " ".join([self.tokens[i] for i in mine])))
            at = end
        return out

    def pre_tokens(self, text: str) -> list[str]:
        """Pieces of a text without added tokens, which merges never cross."""
        if _RARE.search(text):
            pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, p)).decode("utf-8") for p, _ in pieces]
        plain = self.space.sub(" ", unicodedata.normalize("NFC", text))
        return self.pattern.findall(plain.replace("Σ", "σ").lower())

    def _encode_chunks(self, chunks: list[str]) -> list[tuple[str, str]]:
        """Ids and tokens, joined by a space, of pieces between white space."""
        split = [self._words_or_added(c) for c in chunks]
        self.words.fill({w for ws in split for w in ws if w.__class__ is str}, self._encode_words)
        out = []
        for words in split:
            pairs = [
                self.words[w] if w.__class__ is str else (str(w), self.tokens[w]) for w in words
            ]
            if len(pairs) == 1:
                out.append(pairs[0])
            else:
                out.append((" ".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs])))
        return out

    def _words_or_added(self, chunk: str) -> list:
        """Pre-tokens of a chunk; an added token as its id."""
        if "<" not in chunk or not self.cut_added.search(chunk):
            return self.pre_tokens(chunk)
        out: list = []
        for place, part in enumerate(self.cut_added.split(chunk)):
            out += [self.added[part]] if place % 2 else self.pre_tokens(part)
        return out

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Per text its ids and its tokens, each joined by a space."""
        group: list[tuple[str, bool]] = []  # parts, and whether they end their text
        size, begun = 0, ([], [])
        for text in texts:
            parts = list(parts_of(text)) or [""]
            for place, part in enumerate(parts, 1):
                group.append((part, place == len(parts)))
                size += len(part)
                if size >= PART:
                    yield from self._encode_group(group, begun)
                    group, size = [], 0
        yield from self._encode_group(group, begun)

    def _encode_group(self, group: list[tuple[str, bool]], begun: tuple[list, list]) -> Iterator[tuple[str, str]]:
        split = [_SPACES.split(p) if _ODD.search(p) else p.split() for p, _ in group]
        self.chunks.fill(set().union(*split), self._encode_chunks)
        for chunks, (_, last) in zip(split, group):
            found = [p for p in map(self.chunks.__getitem__, chunks) if p[0]]
            if found:
                begun[0].append(" ".join([p[0] for p in found]))
                begun[1].append(" ".join([p[1] for p in found]))
            if last:
                yield " ".join(begun[0]), " ".join(begun[1])
                begun[0].clear()
                begun[1].clear()

    def encode_ids(self, text: str) -> list[int]:
        return [int(i) for i in next(self.encode([text]))[0].split()]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


# str.split() also cuts at the separators 0x1C to 0x1F, which the pattern's \s does not hold
_ODD = re.compile("[\x1c-\x1f]")
_SPACES = re.compile("[ \t\n\r\f\v]+")
# outside these ranges, the classes of characters differ between Unicode versions
_RARE = re.compile("[^\0-\u052f\u2000-\u206f\u3040-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about PART characters, cut before a space."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PART)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


@lru_cache(maxsize=1)
def encoder(path: str) -> ForcedBpe:
    """The encoder of a file; a worker keeps it between its tasks."""
    return ForcedBpe(path)


def digests(text: Column, path: str) -> Column:
    """``struct<n_tokens long, ids_sha256 string, decoded_sha256 string>`` of a text column."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for texts in series:
            rows = [
                (ids.count(" ") + bool(ids), hashlib.sha256(ids.encode()).hexdigest(),
                 hashlib.sha256(decoded.encode()).hexdigest())
                for ids, decoded in bpe.encode(["" if t is None else t for t in texts])
            ]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(F.coalesce(text.cast("string"), F.lit("")))


def encoded(text: Column, path: str) -> Column:
    """The ids of a text column, as ``array<int>``."""

    @F.pandas_udf("array<int>")
    def ids_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for texts in series:
            yield pd.Series([
                np.fromstring(ids, dtype=np.int32, sep=" ")
                for ids, _ in bpe.encode(["" if t is None else t for t in texts])
            ], dtype=object)

    return ids_of(F.coalesce(text.cast("string"), F.lit("")))


def decoded(ids: Column, path: str) -> Column:
    """The text of a column of ids; ids outside the vocabulary are left out, null is empty."""

    @F.pandas_udf("string")
    def text_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for rows in series:
            yield pd.Series(["" if r is None else bpe.decode([int(i) for i in r]) for r in rows], dtype=object)

    return text_of(ids)


def encode_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""
    return docs.select(F.col(id_col), digests(F.col(text_col), path).alias("d")).select(id_col, "d.*")
