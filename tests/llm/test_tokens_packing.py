import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from cases import docs, empty, odd_rows
from tokenizers import Tokenizer

from stockcast.llm import packing, tokens

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
SCRAPS = ["a", "the", "He", "n't", "'s", "'", "1", "23", ".", "!!", " ", "  ", "\n", "\n\n", "\t", "　", "\xa0", "\x85", "\x1c",
          "é", "日本", "\U0001f600", "<|endoftext|>", "<s>", "</s>", "▁", "\x00", "\r\n", "​", "<0x0A>", "﻿", "ﬁ"]


def scraps(n):
    rng = random.Random(9)
    return ["".join(rng.choice(SCRAPS) for _ in range(rng.randrange(14))) for _ in range(n)]


def test_piece_lengths_of_scraps():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    lookup = tokens.PieceLengths(PIECES, {}, cache_size=20)
    for text in scraps(2_000):
        assert lookup.count(text) == len(library.encode(text)), repr(text)


def test_unit_ids_of_scraps(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_SIZE", 40)
    monkeypatch.setattr(packing, "CACHED_CHARS", 6)
    library, cache = Tokenizer.from_file(BYTES), packing.UnitCache(BYTES)
    texts = scraps(2_000)
    for at in range(0, len(texts), 50):
        for text, ids in zip(texts[at:at + 50], cache.encode(texts[at:at + 50])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_distinct_units_are_looked_up_once(monkeypatch):
    """However often a unit occurs, and whatever marks are behind its letters; texts beyond the bound agree."""
    library, cache, asked = Tokenizer.from_file(BYTES), packing.UnitCache(BYTES), []
    texts = ["one two, two. two\ntwo; é, é. " * 500 + "end", "", "two, one", " \ttwo,  one\n", *scraps(300)] * 2

    def spy(known, keys, size, encode, find=packing._Known.find):
        asked.append(list(keys))
        return find(known, keys, size, encode)

    monkeypatch.setattr(packing._Known, "find", spy)
    cache.encode(texts[:1])
    assert sorted(asked[0]) == ["\ntwo;", "end", "one", "two", "é"] and asked[1] == ["one"]
    for bound in (packing.BYTES_AT_ONCE, 20):
        monkeypatch.setattr(packing, "BYTES_AT_ONCE", bound)
        for text, ids in zip(texts, cache.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert all(len(set(keys)) == len(keys) for keys in asked)


def test_new_units_are_encoded_in_parts(monkeypatch):
    """The tokenizer gets few texts, or one text of few units, at a time."""
    monkeypatch.setattr(packing, "JOINED", 7)
    library, cache, sizes = Tokenizer.from_file(BYTES), packing.UnitCache(BYTES), []

    class Spy:
        def encode_batch_fast(self, texts, **options):
            sizes.append(max(len(texts), *(text.count(" ") for text in texts), 0))
            return library.encode_batch_fast(texts, **options)

    cache.tokenizer = Spy()
    texts = [" ".join(f"w{i}x{j}" for i in range(50)) + f" \t{j}" for j in range(30)]
    for text, ids in zip(texts, cache.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert 0 < max(sizes) <= 7


def test_marks_behind_every_letter():
    library, cache = Tokenizer.from_file(BYTES), packing.UnitCache(BYTES)
    letters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalnum()]
    texts = ["".join(f"{c}b, a{c}. " for c in letters[at:at + 100]) + "y" for at in range(0, len(letters), 100)]
    for text, ids in zip(texts, cache.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:9])


def test_portions():
    texts = ["", None, "é" * 5, "a" * 30, "", "b" * 9, "c", "d" * 10, None]
    for size in (1, 10, 1000):
        found = list(packing.portions(pa.array(texts), size))
        assert [i for low, high in found for i in range(low, high)] == list(range(len(texts)))
        assert all(sum(len((t or "").encode()) for t in texts[low:high - 1]) <= size for low, high in found)
    assert list(packing.portions(pa.array([], pa.string()), 10)) == []


@pytest.mark.parametrize("table", [0, 4, 5_000])
def test_token_counts(spark, table):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = odd_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(scraps(200))]
    got = tokens.count_tokens(docs(spark, rows).repartition(40), PIECES, table).collect()
    want = [(r[0] or -1, len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in rows]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)
    assert tokens.count_tokens(empty(spark), PIECES).count() == 0


def test_frequent_keys(spark):
    rows = [(i, "often often often now and then " + f"rare{i}", "en", "a", 0) for i in range(300)]
    df = docs(spark, rows).repartition(37)
    assert tokens.frequent_keys(df, 5)[0] == "often"
    assert set(tokens.frequent_keys(df, 50)) >= {"often", "now", "and", "then"}


def test_cuts():
    for n in [*range(1, 70), 2047, 2048, 2049, 5000]:
        found = packing.cuts(n, 16)
        assert [s for s, _ in found] == [sum(x for _, x in found[:i]) for i in range(len(found))]
        assert sum(x for _, x in found) == n and all(x & (x - 1) == 0 and x <= 16 for _, x in found)
        rest = [x for _, x in found if x < 16]
        assert rest == sorted(set(rest), reverse=True)


def test_packed_pieces_round_trip(spark):
    library = Tokenizer.from_file(BYTES)
    rows = odd_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(scraps(100))]
    got = packing.pack(docs(spark, rows), BYTES, max_length=64).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    assert {r.offset for r in got} == {0}
    lengths = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert lengths == sorted(lengths)
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for doc, text, *_ in rows:
        if sum(r[0] == doc for r in rows) == 1:
            own = sorted((r.start, r.ids) for r in got if r.doc_id == doc)
            assert sum((ids for _, ids in own), []) == library.encode(text or "", add_special_tokens=False).ids + [1]
    twice = [r for r in got if r.doc_id == 7]
    assert len(twice) == 2 * len({r.start for r in twice})
    assert packing.pack(empty(spark), BYTES).count() == 0
    with pytest.raises(ValueError):
        packing.pieces(empty(spark), BYTES, max_length=100)


def test_numbers_do_not_depend_on_partitioning(spark):
    df = docs(spark)
    a, b = (sorted((r.doc_id or -1, r.start, r.sequence_id) for r in packing.pack(d, BYTES, with_ids=False).collect())
            for d in (df, df.repartition(4)))
    assert a == b
