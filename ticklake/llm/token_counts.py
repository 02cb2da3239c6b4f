"""Exact token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``WHOLE`` characters is encoded by the sentencepiece library as it is. A
longer one is encoded in overlapping chunks with offsets. Two neighbouring chunks are
spliced at a place in their overlap where both have a token boundary and which is proven
stable: the two characters around it stand side by side inside no piece of the model, so
no merge reaches across it, in the whole text as in either chunk. If an overlap has no such
place it is widened, in the end to the rest of the text. So memory depends on the chunks,
and the count is that of the whole text.

Defined results: null and empty texts have no bytes and no tokens; rows are counted one by
one; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = 40_000
CHUNK = 20_000
OVERLAP = 400
MARGIN = 40  # characters at both ends of an overlap where no splice is tried
TOGETHER = 1 << 20  # characters encoded in one call
SPACE = "▁"


class Counter:
    """Counts tokens as one sentencepiece model gives them."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, whole: int = WHOLE):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap, self.whole = chunk, overlap, whole
        self.inside: set[tuple[str, str]] = set()
        for number in range(self.model.get_piece_size()):
            if not (self.model.is_control(number) or self.model.is_unknown(number) or self.model.is_byte(number)):
                piece = self.model.id_to_piece(number)
                self.inside.update(zip(piece, piece[1:]))
        sample = "ﬁé² Ａ"  # a model that leaves these alone changes no letters
        self.literal = self.model.normalize(sample).strip(SPACE + " ").replace(SPACE, " ") == sample

    def stable(self, text: str, place: int) -> bool:
        """Whether no piece can hold both characters around a place of the text."""
        left, right = text[place - 1], text[place]
        if left.isspace() or (right.isspace() and right != " "):
            return False
        if not self.literal and not (left.isascii() and (right == " " or right.isascii())):
            return False
        return (left, SPACE if right == " " else right) not in self.inside

    def _begins(self, text: str) -> list[int]:
        """The character at which each token begins."""
        starts = (np.frombuffer(text.encode("utf-8"), dtype=np.uint8) & 0xC0) != 0x80
        before = np.concatenate([[0], np.cumsum(starts)]).tolist()  # characters before a byte
        return [before[p.begin] for p in self.model.encode(text, return_type="proto").pieces]

    def count_long(self, text: str) -> int:
        total, start, skipped = 0, 0, 0  # skipped: characters of this chunk counted before
        overlap, end = self.overlap, min(len(text), self.chunk)
        begins = self._begins(text[:end])
        while end < len(text):
            following = max(start + skipped, end - overlap)
            next_end = min(len(text), end + self.chunk)
            later = self._begins(text[following:next_end])
            place = self._common(text, start, begins, following, later, end)
            if place is not None:
                total += sum(skipped <= b < place - start for b in begins)
                start, skipped, end, begins, overlap = following, place - following, next_end, later, self.overlap
            elif following > start + skipped:
                overlap *= 2
            else:  # the overlap is all of the chunk: go on with a chunk twice as long
                end = min(len(text), end + max(self.chunk, end - start))
                begins = self._begins(text[start:end])
        return total + sum(b >= skipped for b in begins)

    def _common(self, text: str, start: int, begins: list, following: int, later: list, end: int) -> int | None:
        """The last stable place in an overlap where both encodings begin a token."""
        margin = min(MARGIN, self.overlap // 4)
        both = {start + b for b in begins} & {following + b for b in later}
        places = (p for p in sorted(both, reverse=True) if following + margin < p <= end - margin)
        return next((p for p in places if self.stable(text, p)), None)

    def count(self, texts: list[str]) -> list[int]:
        counts = [0] * len(texts)
        group: list[int] = []
        held = 0
        for place, text in enumerate(texts):
            if len(text) > self.whole:
                counts[place] = self.count_long(text)
                continue
            group.append(place)
            held += len(text)
            if held >= TOGETHER:
                self._together(texts, group, counts)
                group, held = [], 0
        self._together(texts, group, counts)
        return counts

    def _together(self, texts: list[str], group: list[int], counts: list[int]) -> None:
        for place, ids in zip(group, self.model.encode([texts[p] for p in group], num_threads=1)):
            counts[place] = len(ids)


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """The counter of a model; a worker keeps it between its tasks."""
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of a text column."""

    @F.pandas_udf("long")
    def tokens_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(counter(path).count(texts.tolist()), dtype="int64")

    return tokens_of(F.coalesce(text.cast("string"), F.lit("")))


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"), token_count(text, path).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
