"""Token ids, token tables, token counts and packing against the tokenizer library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from prefspark.llm import packing, simple8b, token_counts, tokenization
from prefspark.storage import new_path

ODD = [
    None, "", " ", "a", "a  b", " a", "a ", "\n\n", "a\n\nb", "a \n b", "don't I'M you'LL '  's x''s",
    "<|endoftext|>x <|startoftext|>", "<|endoftext", "é ạ́", "a\tb\r\n c", "ÀÉß İ ſ K ΑΣ Σ", "日本 語　テスト",
    "x\x85y\x1cz", "½ ² ٣", "😀 👩‍👩‍👧", "a.b,c;d 1234 5 6", "word " * 3000, "x" * 5000,
]


@pytest.fixture(scope="module")
def word_path():
    return tokenization.tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_path():
    return tokenization.tokenizer_path("byte_bpe_50k.json")


def random_texts(count):
    rnd = random.Random(3)
    parts = ["a", "B", "'", "s", " ", "  ", "\n", "\t", ".", "é", "1", "́", "<|endoftext|>", "ll", "ß", "!", " ", "漢"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(count)]


def frame(spark, texts):
    rows = [(i, t, "extra", [i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, positions array<int>")


@pytest.mark.parametrize("n", [0, 1, 5, 127, 128, 129, 5000])
@pytest.mark.parametrize("high", [1, 9, 300, 50_000, 2**40, 2**60 - 1, 2**60, 2**64 - 1])
def test_words_round_trip(n, high):
    rng = np.random.default_rng(n)
    values = rng.integers(0, high, n, dtype=np.uint64, endpoint=True)
    values[: n // 3] //= np.uint64(max(1, high // 3))
    words, offsets = simple8b.pack(values)
    assert (simple8b.unpack(words, offsets, n) == values).all()
    for k in range(len(offsets)):
        end = offsets[k + 1] if k + 1 < len(offsets) else len(words)
        own = values[k * simple8b.BLOCK : (k + 1) * simple8b.BLOCK]
        alone = simple8b.unpack(words[offsets[k] : end], np.zeros(1, np.uint32), len(own))
        assert (alone == own).all()


def test_small_values_share_words():
    words, _ = simple8b.pack(np.ones(128, np.uint64))
    assert len(words) == 3
    words, _ = simple8b.pack(np.full(128, 2**60, np.uint64))
    assert len(words) == 256


def test_piecewise_ids_are_the_librarys(word_path):
    coder = tokenization.WordCoder(word_path, memory=50)
    library = tokenization.load_tokenizer(word_path)
    for text in ODD + random_texts(2000):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert coder.encode(text) == np.array(ids, "<u4").tobytes(), text


def test_counts_are_the_librarys(byte_path):
    counter = token_counts.TokenCounter(byte_path, memory=50)
    library = tokenization.load_tokenizer(byte_path)
    for text in ODD + random_texts(2000):
        assert counter.count(text) == len(library.encode(text or "", add_special_tokens=False).ids), text


def test_pre_tokens_agree_on_every_character(byte_path):
    counter = token_counts.TokenCounter(byte_path)
    library = tokenization.load_tokenizer(byte_path)
    characters = "".join(chr(c) + "x " for c in range(1, 0x3000)) + "".join(chr(c) + " " for c in range(0x1F300, 0x1F700))
    assert counter.count(characters) == len(library.encode(characters, add_special_tokens=False).ids)


def test_count_tokens(spark, byte_path):
    texts = [*ODD, "same", "same"]
    library = tokenization.load_tokenizer(byte_path)
    rows = token_counts.count_tokens(frame(spark, texts), byte_path, limit=100).orderBy("doc_id").collect()
    expected = [(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for t in texts]
    assert [(r.n_bytes, r.n_tokens) for r in rows] == expected
    assert [r.over_limit for r in rows] == [n > 100 for _, n in expected]
    assert token_counts.count_tokens(frame(spark, []), byte_path).count() == 0


def test_token_table(spark, word_path):
    texts = [*ODD, "same", "same"]
    docs = frame(spark, texts).withColumn("doc_id", F.expr("nullif(cast(100 - doc_id as long), 100)"))
    path = new_path(spark)
    simple8b.write_token_table(docs.repartition(3), path, word_path)
    coder = tokenization.WordCoder(word_path)
    ids = [coder.encode(t) + np.array([2], "<u4").tobytes() for t in texts]
    at, expected = 0, {}
    # A null id (text 0) comes first, then ids ascend.
    for i in [0, *range(len(texts) - 1, 0, -1)]:
        expected[None if i == 0 else 100 - i] = (at, len(ids[i]) // 4, zlib.crc32(ids[i]))
        at += len(ids[i]) // 4
    rows = simple8b.read_token_digests(spark, path).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected
    empty = new_path(spark)
    simple8b.write_token_table(frame(spark, []), empty, word_path)
    assert simple8b.read_token_digests(spark, empty).count() == 0


def test_documents_that_share_an_id_stay_whole(spark, word_path):
    docs = spark.createDataFrame([(5, "b b"), (5, "a"), (5, "a"), (1, "c")], "doc_id long, text string")
    path = new_path(spark)
    simple8b.write_token_table(docs, path, word_path)
    rows = sorted(simple8b.read_token_digests(spark, path).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(1, 0, 2), (5, 2, 2), (5, 4, 2), (5, 6, 3)]


@pytest.mark.parametrize("tokens", [1, 511, 512, 513, 2047, 2048, 2049, 5000, 8192])
def test_cuts(tokens):
    lengths = packing.cut_lengths(tokens)
    assert sum(lengths) == tokens and min(lengths) > 0 and max(lengths) <= 2048
    short = [x for x in lengths if x < 2048]
    assert not short or max(short) <= 512 and max(short) - min(short) <= 1


def test_differencing_balances():
    rnd = random.Random(1)
    lengths = [rnd.randint(1, 512) for _ in range(600)]
    windows = packing.balanced_windows(lengths)
    assert sorted(i for w in windows for i in w) == list(range(600))
    sums = [sum(lengths[i] for i in w) for w in windows]
    assert max(sums) <= 2048 and sum(sums) / len(sums) / 2048 > 0.96
    assert max(sums) - min(sums) < 100
    # Ties, a single item and none.
    assert len(packing.balanced_windows([1024] * 6)) == 3
    assert packing.balanced_windows([7]) == [[0]]
    assert packing.balanced_windows([]) == []


def test_window_count_rises():
    assert len(packing.balanced_windows([6, 6, 6], capacity=10)) == 3


def test_pack_documents(spark, word_path):
    texts = [*ODD, *["same words here"] * 50, "long " * 5000]
    packed = packing.pack_documents(frame(spark, texts), word_path).toPandas()
    coder = tokenization.WordCoder(word_path)
    for doc_id, own in packed.sort_values("start").groupby("doc_id"):
        ids = coder.encode(texts[doc_id]) + np.array([1], "<u4").tobytes()
        assert b"".join(own["ids"].map(bytes)) == ids
        assert (own["doc_tokens"] == len(ids) // 4).all()
        assert own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
    assert packed["doc_id"].nunique() == len(texts)
    for _, own in packed.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() <= 2048
    assert packing.pack_documents(frame(spark, []), word_path).count() == 0
