"""Token-id files in patched frame-of-reference blocks.

Documents are range-partitioned by id, so that each file holds a run of ids in ascending
order; a task encodes its documents in that order and yields a file piece by piece. Spark's
text writer puts the pieces down as they are, each followed by a newline byte, which the
format counts as part of a piece. So files are committed as any Spark output is, on any
file system that Spark can write, and a task that is lost and run again leaves one file.

Pieces of a file, all numbers little-endian:

- block: ``PFOR``, uint32 bytes that follow up to the newline, uint32 ids in the block,
  uint32 minimum, uint8 width, uint32 exceptions, the packed low ``width`` bits of every
  ``id - minimum``, the places of the exceptions (uint32) and their high bits (uint32). The
  width is the one of all widths with the fewest bytes: the percentile of the values that it
  holds trades packed bits against exceptions.
- directory, the last piece: ``PDIR``, zlib data of the document index (id, whether it is
  null, ids in the document), zlib data of the places where blocks start in the file and of
  the first id of each block counted from the file's start; then the sizes and ``PEND``.

Any document is thus found with the directory and the blocks that hold it (``read_document``).

Defined results: null and empty texts give the end id alone; a null document id comes
first; rows that repeat an id follow each other in the order of their texts' hashes; an
empty table gives no documents. ``start`` counts the ids of all documents before, in that
order. Extra columns are not read.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ticklake.llm.common import scratch, staged

BLOCK = 16_384  # ids
MEMO = 200_000  # words remembered per generation
PART = 1 << 22  # characters whose words are looked up at a time

WHITE, LETTER, DIGIT, MARK, ODD = range(5)  # kinds of bytes
_KIND = np.full(256, ODD, dtype=np.uint8)
_KIND[33:127] = MARK
_KIND[[ord("'"), ord("<")]] = ODD  # endings such as 's, and tokens that are matched in raw text
_KIND[ord("0") : ord("9") + 1] = DIGIT
_KIND[ord("A") : ord("Z") + 1] = _KIND[ord("a") : ord("z") + 1] = LETTER
_KIND[[9, 10, 11, 12, 13, 32]] = WHITE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LATIN = np.ones(256, dtype=bool)  # whether the byte 0xC3 and this one are a letter
_LATIN[[0x97, 0xB7]] = False
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

# The steps before the model for which a text may be cut into runs of one kind
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_RULES = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _RUNS}, "behavior": "Removed", "invert": True}, _BYTES,
    ]},
)

_HEAD = struct.Struct("<4sIIIBI")
_TAIL = struct.Struct("<QIIIQ4s")


def packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after the other."""
    if width == 0:
        return b""
    if width > 16:
        bits = np.unpackbits(
            values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width
        )
        return np.packbits(bits.ravel(), bitorder="little").tobytes()
    # eight values are as many bytes as one has bits: two numbers of 64 bits, cut to that
    four = np.zeros((-(-len(values) // 8) * 8), dtype="<u8")
    four[: len(values)] = values & np.uint32((1 << width) - 1)
    for shift in (width, 2 * width):
        four = four[0::2] | four[1::2] << np.uint64(shift)
    eight = np.empty((len(four) // 2, 2), dtype="<u8")
    eight[:, 0], eight[:, 1] = four[0::2], four[1::2]
    if width < 16:
        eight[:, 0] |= four[1::2] << np.uint64(4 * width)
        eight[:, 1] >>= np.uint64(64 - 4 * width)
    return eight.view(np.uint8)[:, :width].tobytes()[: (len(values) * width + 7) // 8]


def unpacked(data: bytes, width: int, count: int) -> np.ndarray:
    if width == 0:
        return np.zeros(count, dtype=np.uint32)
    at = np.arange(count) * width  # each value lies in the eight bytes from the one it begins in
    around = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))[at >> 3]
    return (around >> (at & 7).astype(np.uint64)).astype(np.uint32) & np.uint32((1 << width) - 1)


def chosen_width(offsets: np.ndarray) -> int:
    """The width with the fewest bytes, exceptions counted at eight bytes each."""
    needed = np.frexp(offsets.astype(np.float64))[1]
    beyond = len(offsets) - np.cumsum(np.bincount(needed, minlength=33))
    return int(np.argmin(np.arange(33) * len(offsets) / 8 + 8 * beyond))


def block_of(ids: np.ndarray) -> bytes:
    """One block, without the newline that ends it."""
    ids = ids.astype(np.uint32)
    low = ids.min()
    offsets = ids - low
    width = chosen_width(offsets)
    high = offsets >> np.uint32(width) if width < 32 else np.zeros_like(offsets)
    places = np.flatnonzero(high).astype("<u4")
    body = packed(offsets, width) + places.tobytes() + high[places].astype("<u4").tobytes()
    return _HEAD.pack(b"PFOR", _HEAD.size - 8 + len(body), len(ids), int(low), width, len(places)) + body


def ids_of(data: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """Ids of the block at a place, and the place after its newline."""
    magic, size, count, low, width, exceptions = _HEAD.unpack_from(data, at)
    if magic != b"PFOR":
        raise ValueError(f"no block at {at}")
    body = at + _HEAD.size
    packed_size = (count * width + 7) // 8
    offsets = unpacked(data[body : body + packed_size], width, count)
    places = np.frombuffer(data, "<u4", exceptions, body + packed_size)
    high = np.frombuffer(data, "<u4", exceptions, body + packed_size + 4 * exceptions)
    if exceptions:
        offsets[places] |= high << np.uint32(width)
    return offsets + np.uint32(low), at + 8 + size + 1


def directory_of(ids: list, counts: list[int], block_starts: list[int], first_ids: list[int], place: int) -> bytes:
    """The last piece of a file, without its newline."""
    known = np.array([i is not None for i in ids], dtype=np.uint8)
    numbers = np.array([0 if i is None else i for i in ids], dtype="<i8")
    parts = [
        zlib.compress(known.tobytes() + numbers.tobytes(), 1),
        zlib.compress(np.array(counts, dtype="<u4").tobytes(), 1),
        zlib.compress(np.array([block_starts, first_ids], dtype="<u8").tobytes(), 1),
    ]
    return b"PDIR" + b"".join(parts) + _TAIL.pack(len(ids), *map(len, parts), place, b"PEND")


def directory(data: bytes) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ids in each, places of the blocks, first id of each block."""
    documents, a, b, c, place, magic = _TAIL.unpack_from(data, len(data) - 1 - _TAIL.size)
    if magic != b"PEND" or data[place : place + 4] != b"PDIR":
        raise ValueError("the file has no directory at its end")
    at = place + 4
    raw = zlib.decompress(data[at : at + a])
    known = np.frombuffer(raw, np.uint8, documents)
    numbers = np.frombuffer(raw, "<i8", documents, documents)
    ids = [int(n) if k else None for n, k in zip(numbers, known)]
    counts = np.frombuffer(zlib.decompress(data[at + a : at + a + b]), "<u4")
    starts, firsts = np.frombuffer(zlib.decompress(data[at + a + b : at + a + b + c]), "<u8").reshape(2, -1)
    return ids, counts, starts, firsts


def read_document(data: bytes, place: int) -> np.ndarray:
    """Ids of the document at a place in the file's order, from the blocks that hold it."""
    _, counts, starts, firsts = directory(data)
    first = int(counts[:place].sum())
    last = first + int(counts[place])
    block = int(np.searchsorted(firsts, first, side="right")) - 1
    base, out = int(firsts[block]), []
    while block < len(starts) and firsts[block] < last:
        out.append(ids_of(data, int(starts[block]))[0])
        block += 1
    return np.concatenate(out)[first - base : last - base]


def _joined(words: pa.Array) -> str:
    """Words without white space as one text, with a space between two."""
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    return pc.binary_join(listed, pa.scalar(" ", pa.large_string()))[0].as_py()


class Encoder:
    """Ids of texts by the tokenizers library, with a memo of the pieces it encodes apart.

    Words between ASCII white space are encoded apart: the splitting of the vocabularies used
    here never joins across white space, which is checked when loading. Where a vocabulary
    splits by ``_RULES``, words of ASCII and of Latin letters are cut further, in numpy, into
    the lower-case runs of letters, digits and runs of marks that the library encodes apart.
    Arrow numbers the pieces, so Python meets each distinct piece once in a group.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        probe = "One two, three!  It's\n4 five"
        apart = [i for w in probe.split() for i in self._whole(w)]
        self.splits = apart == self._whole(probe)
        spec = json.loads(self.library.to_str())
        odd = [ODD in _KIND[list(token["content"].encode())] for token in spec["added_tokens"]]
        self.simple = self.splits and _RULES == (spec["normalizer"], spec["pre_tokenizer"]) and all(odd)
        self.ends = np.array([
            (self.library.id_to_token(i) or "").endswith("</w>") for i in range(self.library.get_vocab_size())
        ])
        # the same model for lower-case words of letters alone, which need no other steps
        spec["normalizer"], spec["added_tokens"] = None, []
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, _BYTES]}
        self.plain = Tokenizer.from_str(json.dumps(spec)) if self.simple else self.library
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of distinct pieces."""
        if len(self.recent) > MEMO:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        new = [piece for piece in pieces if piece not in recent]
        if older:
            known = [piece for piece in new if piece in older]
            recent.update(zip(known, map(older.__getitem__, known)))
            new = [piece for piece in new if piece not in older]
        plain = _PLAIN.fullmatch if self.simple else lambda piece: None
        letters, apart = [], []
        for piece in new:
            (letters if plain(piece) else apart).append(piece)
        self._encode_plain(letters)
        for encoding, piece in zip(self.library.encode_batch_fast(apart, add_special_tokens=False), apart):
            recent[piece] = np.array(encoding.ids, dtype="<u4").tobytes()

    def _encode_plain(self, words: list[str]) -> None:
        """Words of plain letters, many in one text: each ends with its only word-end token."""
        for at in range(0, len(words), 50):
            group = words[at : at + 50]
            ids = np.array(self.plain.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = [0, *(4 * np.flatnonzero(self.ends[ids]) + 4).tolist()]
            if len(cuts) != len(group) + 1 or cuts[-1] != 4 * len(ids):
                raise ValueError("a word of letters has several word ends")
            data = ids.tobytes()
            self.recent.update(zip(group, [data[low:high] for low, high in zip(cuts, cuts[1:])]))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian uint32."""
        return next(self.encode_each([text]))

    def encode_each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; pieces are looked up for about PART characters at a time."""
        group: list[tuple[str, bool]] = []  # parts, and whether they end their text
        held, begun = 0, []
        for text in texts:
            if not self.splits:
                yield from self._encode_group(group, begun)
                group, held = [], 0
                yield np.array(self._whole(text), dtype="<u4").tobytes()
                continue
            at = 0
            while True:
                end = text.find(" ", at + PART)
                end = len(text) if end < 0 else end
                group.append((text[at:end], end == len(text)))
                held += end - at
                at = end
                if held >= PART:
                    yield from self._encode_group(group, begun)
                    group, held = [], 0
                if at == len(text):
                    break
        yield from self._encode_group(group, begun)

    def _pieces(self, parts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all parts in order, and the pieces before each part and before the end."""
        texts = pa.array(parts, pa.large_string())
        starts = np.frombuffer(texts.buffers()[1], np.int64, len(parts) + 1)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8, starts[-1])
        first = starts[:-1][starts[:-1] < len(raw)]
        kind = _KIND[raw]
        lower = _LOWER[raw]
        if self.simple:
            lead = np.flatnonzero(raw == 0xC3)  # first byte of U+00C0 to U+00FF, but for two all letters
            second = lead[_LATIN[raw[lead + 1]]] + 1
            kind[second] = kind[second - 1] = LETTER
            lower[second] |= 0x20  # the second bytes of small letters have this bit
            lower[second[raw[second] == 0x9F]] = 0x9F  # but for the sharp s
        else:
            kind[kind > WHITE] = ODD
        odd = np.flatnonzero(kind == ODD)
        if len(odd):  # whole words, as they are
            inside = kind > WHITE
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            begins[first] = inside[first]
            word = np.cumsum(begins, dtype=np.int32)
            whole = np.zeros(int(word[-1]) + 1, dtype=bool)
            whole[word[odd]] = True
            whole = whole[word] & inside
            kind[whole] = ODD
            np.copyto(lower, raw, where=whole)
        opens = kind == DIGIT
        opens[1:] |= kind[1:] != kind[:-1]
        opens[first] = True
        inside = kind > WHITE
        opens &= inside
        cuts = np.append(np.flatnonzero(opens[inside]), np.count_nonzero(inside))
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(lower[inside])]
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, buffers)
        return pieces, np.searchsorted(np.flatnonzero(opens), starts)

    def _encode_group(self, group: list[tuple[str, bool]], begun: list[bytes]) -> Iterator[bytes]:
        """Each distinct piece of the parts is looked up once; the rest is done on its number."""
        if not group:
            return
        pieces, before = self._pieces([part for part, _ in group])
        coded = pieces.dictionary_encode()
        distinct = _joined(coded.dictionary).split(" ") if len(coded.dictionary) else []
        self._learn(distinct)
        found = list(map(self.recent.__getitem__, distinct))
        data = np.frombuffer(b"".join(found), dtype="<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        number = coded.indices.to_numpy()
        size = sizes[number]
        ends = np.concatenate([[0], np.cumsum(size)])
        shift = (np.cumsum(sizes) - sizes)[number] - ends[:-1]
        ids = data[np.repeat(shift, size) + np.arange(ends[-1])]
        bounds = ends[before].tolist()
        for (_, last), low, high in zip(group, bounds, bounds[1:]):
            begun.append(ids[low:high].tobytes())
            if last:
                yield b"".join(begun)
                begun.clear()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a file; a worker keeps it between its tasks."""
    return Encoder(path)


def write(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode whole texts and write them to a new folder, in ascending order of ids."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    tie = F.xxhash64("text")
    spread = rows.repartitionByRange(F.col("id").asc_nulls_first(), tie)
    placed = spread.sortWithinPartitions(F.col("id").asc_nulls_first(), tie, "text")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The memo is text and bytes, which hold no cycles: looking for some would only
        # walk through all of it again and again.
        gc.disable()
        try:
            yield from encoded_pieces(batches)
        finally:
            gc.enable()

    def encoded_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_each = encoder(tokenizer).encode_each
        end = np.uint32(end_id).astype("<u4").tobytes()
        ids, counts, starts, firsts = [], [], [], []
        waiting, held, done, place = [], 0, 0, 0

        def cut(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, held, done, place
            if held < least or not held:
                return
            stream = np.frombuffer(b"".join(waiting), dtype="<u4")
            whole = len(stream) if least == 1 else len(stream) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                piece = block_of(stream[at : min(at + BLOCK, whole)])
                starts.append(place)
                firsts.append(done + at)
                place += len(piece) + 1
                yield as_batch(piece)
            done += whole
            waiting, held = [stream[whole:].tobytes()], len(stream) - whole

        def as_batch(piece: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([piece], pa.binary())], names=["piece"])

        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            for number, found in zip(batch.column("id").to_pylist(), encode_each(texts)):
                found += end
                ids.append(number)
                counts.append(len(found) // 4)
                waiting.append(found)
                held += counts[-1]
                yield from cut(8 * BLOCK)
        yield from cut(1)
        if ids:
            yield as_batch(directory_of(ids, counts, starts, firsts, place))

    written = placed.mapInArrow(pieces, "piece binary")
    written.select(F.col("piece").cast("string")).write.option("lineSep", "\n").text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files in a folder: ``file``, ``before`` (ids of the file
    before it), ``doc_id``, ``n_tokens``, ``ids_crc32``. Every block of every file is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = content.as_py()
                if not data:
                    continue
                ids, counts, starts, _ = directory(data)
                ends = np.cumsum(counts.astype(np.int64))
                sums = np.zeros(len(ids), dtype=np.int64)
                document, first, crc, left = 0, 0, 0, b""
                for start in starts:
                    stream = ids_of(data, int(start))[0].astype("<u4").tobytes()
                    at, size = 0, len(stream) // 4
                    while document < len(ids) and ends[document] <= first + size:
                        to = int(ends[document] - first) * 4
                        sums[document] = zlib.crc32(stream[at:to], crc)
                        at, crc, document = to, 0, document + 1
                    crc = zlib.crc32(stream[at:], crc)
                    first += size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(ids)), pa.array(ends - counts), pa.array(ids, pa.int64()),
                     pa.array(counts.astype(np.int64)), pa.array(sums)],
                    names=["file", "before", "doc_id", "n_tokens", "ids_crc32"],
                )

    return files.select("path", "content").mapInArrow(
        listed, "file string, before long, doc_id long, n_tokens long, ids_crc32 long"
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder with ``start``, the ids of all documents before.

    Sums run inside each file when it is read; a row for each file puts the files in order.
    """
    rows = staged(read(spark, folder), "documents-read")
    # Spark numbers the files of a range-partitioned write in the order of the ranges
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("held")).select(
        "file", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("earlier")
    )
    return rows.join(files, "file").select(
        "doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Documents as read back from files in the shared folder."""
    folder = scratch(docs.sparkSession, "token-files")
    write(docs, folder, tokenizer, end_id)
    return documents(docs.sparkSession, folder)
