"""Token-id files give back what was encoded, in order, from every block."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ticklake.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=300))
@settings(max_examples=150, deadline=None)
def test_block_round_trip(ids):
    values = np.array(ids, dtype=np.uint32)
    piece = b"xx" + token_files.block_of(values) + b"\n"
    back, after = token_files.ids_of(piece, 2)
    assert back.tolist() == ids and after == len(piece)


def test_outliers_are_exceptions():
    values = np.array([1000 + i % 8 for i in range(1000)] + [2**31], dtype=np.uint32)
    assert token_files.chosen_width(values - values.min()) == 3
    assert len(token_files.block_of(values)) < 450


def test_words_apart_equal_whole_texts():
    ours, library = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(4)
    pools = ["abc DE'", "The and,. ", "éÉàß ñ!!", "ab\x1cc \n", "x<|endoftext|> y", "日本 Σς"]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randrange(80))) for _ in range(1500)]
    texts += ["", "word " * 300_000, "x" * 3000, "don't STOP... it's", "<|endoftext|>", "é É!?"]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == want, repr(text[:200])


def expected(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for number, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((number, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture()
def rows():
    rng = random.Random(2)
    found = [(i * 3 % 101, " ".join(rng.choices(["the", "cat", "zebra", "42", "ñandú"], k=rng.randrange(900))))
             for i in range(101)]
    return [*found, (None, "no id"), (200, None), (201, ""), (202, "long text " * 60_000)]


def test_files(spark, rows, tmp_path):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, id string, start int")
    folder = f"file://{tmp_path}/ids"
    token_files.write(docs.repartition(5), folder, PATH)
    got = [tuple(r) for r in token_files.documents(spark, folder).orderBy("start").collect()]
    assert got == expected(rows)
    data = max((p.read_bytes() for p in tmp_path.glob("ids/part-*")), key=len)
    ids, counts, starts, _ = token_files.directory(data)
    assert len(starts) > 3
    texts, library = dict(rows), Tokenizer.from_file(PATH)
    for place, number in enumerate(ids):
        want = library.encode(texts[number] or "", add_special_tokens=False).ids + [1]
        if place % 7 == 0 or counts[place] > token_files.BLOCK:
            assert token_files.read_document(data, place).tolist() == want


def test_repeated_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    twice = spark.createDataFrame([(5, "a b"), (5, "a b"), (5, "c"), (1, None)], schema)
    got = sorted(tuple(r) for r in token_files.write_and_read(twice, PATH).collect())
    assert [g[:1] + g[2:3] for g in got] == [(1, 1), (5, 2), (5, 3), (5, 3)] or sorted(
        (g[0], g[2]) for g in got) == [(1, 1), (5, 2), (5, 3), (5, 3)]
    assert sorted(g[1] for g in got)[0] == 0
    assert token_files.write_and_read(twice.limit(0), PATH).collect() == []


def test_a_word_is_looked_up_once_in_a_group():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    ours, library = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    ours.recent = Counted()
    texts = ["the cat\x1cand  the\xa0dog, ", "", " \n", "the dog, the cat"] * 50
    got = [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode_each(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ours.recent.asked <= 10


def test_case_marks_and_digits_make_no_new_words():
    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            self.asked += 1
            return super().__getitem__(word)

    ours, library = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    ours.recent = Counted()
    words = [f"{form}{mark}" for word in ("theory", "été", "straße") for form in (word, word.upper(), word.title())
             for mark in ("", ",", "...", "?!", "-2024")]
    texts = [" ".join(words), "\n".join(reversed(words))]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode_each(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ours.recent.asked <= 12  # "STRASSE" is another word


def test_pieces_equal_whole_texts_in_groups(monkeypatch):
    ours, library = token_files.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(8)
    ascii_ = "".join(map(chr, range(128)))
    latin = "".join(map(chr, range(0xA0, 0x100)))
    pools = [ascii_, latin + "aZ ", ascii_ + latin, "aé́̀E ÅÅK", "don'tTHE's.'re ", "Œœİſ×÷µ a,",
             "日本a。 é１²", "0a1.-  \x85\xa0"]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randrange(60))) for _ in range(3000)]
    texts += ["a", "", "b", " ", "<|endoftext|>é<|STARTOFTEXT|>", "A<|startoftext|>B c", "it'sun 'S ''s x'LL"]
    texts += [f"a{chr(c)}B {chr(c)}{chr(c)}" for c in range(0x250)]
    rng.shuffle(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for part, memo in ((1 << 22, 200_000), (40, 30)):
        monkeypatch.setattr(token_files, "PART", part)
        monkeypatch.setattr(token_files, "MEMO", memo)
        for text, ids, right in zip(texts, ours.encode_each(texts), want):
            assert np.frombuffer(ids, "<u4").tolist() == right, repr(text)
    ours.simple = False
    assert [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode_each(texts)] == want


@pytest.mark.parametrize("width", [1, 3, 8, 13, 15, 16, 17, 31, 32])
def test_packed_bits(width):
    rng = random.Random(width)
    for count in (1, 7, 8, 9, 203):
        values = [rng.randrange(1 << width) for _ in range(count)]
        data = token_files.packed(np.array(values, dtype=np.uint32), width)
        whole = sum(value << (place * width) for place, value in enumerate(values))
        assert data == whole.to_bytes((count * width + 7) // 8, "little")
        assert token_files.unpacked(data, width, count).tolist() == values
