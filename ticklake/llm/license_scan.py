"""Licence scans by a positional index of rare words.

Templates are phrases (their words stand consecutively) and notices (longer texts with
mandatory key phrases). The words of all templates are counted over the whole corpus once;
a template is entered in the index under its highest-IDF words only, with their positions:
one word for a phrase, ``ANCHORS`` words for a notice. A file that holds none of these words is
done after one set operation. Otherwise its highest-IDF licence words, which are the ones the
index lists, are looked up; every occurrence proposes a start, its own position less the
template's. A phrase is verified word by word at each proposed start, so all its places are
found. For a notice, proposals of different words that agree within the slack are
intersected; where at least half of its anchors agree, its key phrases are verified near their
relative positions, and the score is the share of the notice's IDF found in the span.

Words are runs of letters, digits and non-ASCII characters, only A-Z lower-cased. Of a text
only the licence words and their positions are kept, in pieces of bounded length, so a very
long text needs little memory beyond itself. Nothing is shuffled but one row per template word
and task.

Defined results: null and empty texts have no words; overlapping places all count; rows are
scanned one by one, repeated ids too; a template word that no file holds has the highest IDF,
and ties are broken by the word. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import arrow_schema, term_parts

ANCHORS = 8  # index entries of a notice
AGREE = 0.5  # share of a notice's anchors that must agree, and of its IDF that must be found
SLACK = 0.15  # words that a notice may be stretched or shifted, as a share of its length


@dataclass(frozen=True)
class Template:
    """A label and the text that stands for it. Without keys the text is a phrase; with keys it
    is a notice, and each key a phrase inside it. A base template is counted as such."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


#: Fixed phrases of the scan's contract.
BASE = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
)

#: Names and notices of common public licences.
KNOWN = (
    Template("agpl", "gnu affero general public license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("bsd", "bsd license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0"),
    Template("epl", "eclipse public license"),
    Template("isc", "isc license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "mit license"),
    Template("mpl-2.0", "mozilla public license"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee is hereby granted",),
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        ("except in compliance with the license", "apache org licenses license 2 0"),
    ),
    Template(
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation",
        ("gnu general public license", "free software foundation"),
    ),
    Template(
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software",
        ("free and unencumbered software", "public domain"),
    ),
)

_PLACES = "array<struct<label string, first long, words long, base boolean, score double>>"


def words_of(text: str | None) -> list[bytes]:
    return [word for part in term_parts(text) for word in part]


def scan(
    docs: DataFrame, templates: tuple[Template, ...] = BASE + KNOWN, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: id, ``n_words``, and ``places`` of templates, in order of their
    first word and then label: label, first word, length in words, base or not, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    index = spark.sparkContext.broadcast(Index(templates, *_frequencies(texts, templates)))
    out = texts.select("id").schema[0].dataType.simpleString()
    schema = arrow_schema(f"id {out}, n_words long, places {_PLACES}")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [index.value.places(text.as_py()) for text in batch["text"]]
            counts = pa.array([n for n, _ in found], pa.int64())
            places = pa.array([p for _, p in found], schema.field("places").type)
            yield pa.RecordBatch.from_arrays([batch["id"].cast(schema.field("id").type), counts, places], schema=schema)

    return texts.mapInArrow(scanned, f"id {out}, n_words long, places {_PLACES}").withColumnRenamed("id", id_col)


def _frequencies(texts: DataFrame, templates: tuple[Template, ...]) -> tuple[int, dict[bytes, int]]:
    """Documents, and how many hold each template word: one row per word comes to the driver."""
    words = sorted({w for t in templates for part in (t.text, *t.keys) for w in words_of(part)})
    wanted = frozenset(words)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys(words, 0)
        documents = 0
        for batch in batches:
            documents += batch.num_rows
            for text in batch["text"]:
                met: set[bytes] = set()
                for part in term_parts(text.as_py()):
                    met |= wanted.intersection(part)
                for word in met:
                    held[word] += 1
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([b"", *held], pa.binary()), "docs": pa.array([documents, *held.values()], pa.int64())}
        )

    totals = texts.select("text").mapInArrow(counted, "word binary, docs long").groupBy("word").agg(F.sum("docs"))
    found = {bytes(word): docs for word, docs in totals.collect()}
    return found.pop(b"", 0), {w: found.get(w, 0) for w in words}


class Index:
    """Postings of rare template words: (template, position) by word."""

    def __init__(self, templates: tuple[Template, ...], documents: int, frequency: dict[bytes, int]):
        self.templates = templates
        self.idf = {w: math.log((documents + 1) / (df + 1)) + 1e-9 for w, df in frequency.items()}
        self.vocabulary = frozenset(self.idf)
        self.words: list[list[bytes]] = []  # of phrases: templates first, then keys of notices
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.keys: list[list[int]] = []  # per template, the numbers of its key phrases
        self.anchors: list[int] = []
        self.length = [len(words_of(t.text)) for t in templates]
        for number, template in enumerate(templates):
            self._enter(number, words_of(template.text), ANCHORS if template.keys else 1)
        for template in templates:
            self.keys.append([])
            for key in template.keys:
                self.keys[-1].append(len(self.words))
                self._enter(len(self.words), words_of(key), 1)

    def _enter(self, number: int, words: list[bytes], count: int) -> None:
        if not words:
            raise ValueError("a template needs a word")
        rare = sorted(set(words), key=lambda w: (-self.idf[w], w))[:count]
        self.words.append(words)
        self.anchors.append(len(rare))
        for word in rare:
            self.postings.setdefault(word, []).extend((number, at) for at, w in enumerate(words) if w == word)

    def places(self, text: str | None) -> tuple[int, list[dict]]:
        """Words of a text, and the places of all templates."""
        n, anchored, at, words = 0, False, [], []
        for part in term_parts(text):
            if not self.vocabulary.isdisjoint(part):
                anchored = anchored or not self.postings.keys().isdisjoint(part)
                for place, word in enumerate(part, n):
                    if word in self.vocabulary:
                        at.append(place)
                        words.append(word)
            n += len(part)
        return n, self._matched(at, words) if anchored else []

    def _matched(self, at: list[int], words: list[bytes]) -> list[dict]:
        starts: dict[int, dict[int, set[bytes]]] = {}  # template, proposed start, its anchors
        for place, word in zip(at, words):
            for number, position in self.postings.get(word, ()):
                starts.setdefault(number, {}).setdefault(place - position, set()).add(word)
        word_at = dict(zip(at, words))
        phrases = {
            number: [s for s in sorted(proposed) if all(word_at.get(s + i) == w for i, w in enumerate(self.words[number]))]
            for number, proposed in starts.items()
            if number >= len(self.templates) or not self.templates[number].keys
        }
        found = []
        for number, template in enumerate(self.templates):
            if template.keys:
                found += self._notices(number, starts.get(number, {}), phrases, at, words)
            else:
                found += [self._place(number, start, self.length[number], 1.0) for start in phrases.get(number, ())]
        return sorted(found, key=lambda p: (p["first"], p["label"], p["words"]))

    def _place(self, number: int, first: int, length: int, score: float) -> dict:
        template = self.templates[number]
        return {"label": template.label, "first": first, "words": length, "base": template.base, "score": score}

    def _notices(self, number: int, proposed: dict, phrases: dict, at: list[int], words: list[bytes]) -> Iterator[dict]:
        """Places of a notice: runs of proposed starts no further apart than the slack."""
        slack = 2 + round(SLACK * self.length[number])
        run: list[int] = []
        for start in [*sorted(proposed), None]:
            if run and (start is None or start - run[0] > slack):
                agreed = set().union(*(proposed[s] for s in run))
                if len(agreed) >= AGREE * self.anchors[number]:
                    first, end = max(0, run[0]), run[-1] + self.length[number] + slack
                    if all(self._held(phrases.get(k, ()), first - slack, end) for k in self.keys[number]):
                        span = set(words[bisect_left(at, first - slack) : bisect_right(at, end)])
                        wanted = set(self.words[number])
                        score = sum(self.idf[w] for w in sorted(wanted & span)) / sum(self.idf[w] for w in sorted(wanted))
                        if score >= AGREE:
                            yield self._place(number, first, self.length[number], min(1.0, score))
                run = []
            if start is not None:
                run.append(start)

    @staticmethod
    def _held(starts: Sequence[int], low: int, high: int) -> bool:
        """Whether one of the sorted starts lies in a range."""
        return bisect_left(starts, low) < bisect_right(starts, high)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, first and last place, labels and score of each scanned document."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])

    def labels(places: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")

    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)).alias("score"),
    )
