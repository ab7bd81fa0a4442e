"""Columns of texts: the ids of the library, each piece coded once, in bounded memory."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from prefspark.llm import common, packing, simple8b, tokenization
from prefspark.storage import new_path

ODD = [
    None, "", " ", "a", "a  b", " a", "a ", "\n\n", "a\n\nb", "a \n b", "don't I'M you'LL '  's x''s",
    "<|endoftext|>x <|startoftext|>", "<|endoftext", "é ạ́", "a\tb\r\n c", "ÀÉß İ ſ K ΑΣ Σ", "日本 語　テスト",
    "x\x85y\x1cz", "½ ² ٣", "😀 👩‍👩‍👧", "a.b,c;d 1234 5 6", "word " * 3000, "x" * 5000, "nul\x00 in",
]


@pytest.fixture(scope="module")
def word_path():
    return tokenization.tokenizer_path("word_bpe_49k.json")


def counting(coder):
    """Pieces that the coder works out from now on."""
    worked, own = [], coder._piece
    coder._piece = lambda piece: worked.append(piece) or own(piece)
    return worked


@pytest.mark.parametrize("column_memory", [0, 200, 1 << 20])
def test_columns_have_the_librarys_ids(word_path, column_memory):
    coder = tokenization.WordCoder(word_path, memory=50, column_memory=column_memory)
    library = tokenization.load_tokenizer(word_path)
    expected = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in ODD]
    column = pa.array(ODD, pa.string())
    assert list(coder.encode_column(column)) == expected
    assert list(coder.encode_column(column[5:])) == expected[5:]  # a slice of a column
    assert list(coder.encode_column(column.cast(pa.large_string())[::-1])) == expected[::-1]
    assert list(coder.encode_column(column[:0])) == []
    assert list(coder.encode_column(pa.array([None, "", None], pa.string()))) == [b""] * 3


def test_a_piece_of_a_column_is_coded_once(word_path):
    coder = tokenization.WordCoder(word_path, memory=3)  # too small to remember them as objects
    worked = counting(coder)
    texts = pa.array([" ".join(f"word{'abcdefghij'[i]}" for i in range(10))] * 50, pa.string())
    for _ in range(3):
        assert len(list(coder.encode_column(texts))) == 50
    assert len(worked) == 10


def test_memory_for_columns(word_path):
    coder = tokenization.WordCoder(word_path, column_memory=1 << 20)
    worked = counting(coder)
    for at in range(0, 60_000, 5_000):
        texts = pa.array([f"common w{i} x{i}" for i in range(at, at + 5_000)], pa.string())
        list(coder.encode_column(texts))
        assert coder._room() <= 1 << 20
    assert worked.count("common") == 1  # what columns hold again and again stays
    list(coder.encode_column(pa.array(["y" * (2 << 20)], pa.string())))
    assert coder._room() <= 1 << 20


def test_slices_by_size():
    texts = ["aaaa", None, "bbbb", "", "c" * 50, "dd", "ee", "ff"]
    batch = pa.record_batch({"i": list(range(8)), "text": texts})
    cut = [s.column(0).to_pylist() for s in common.sized_slices(iter([batch, batch[3:5], batch[:0]]), 1, size=8)]
    assert cut == [[0, 1, 2, 3], [4], [5, 6, 7], [3], [4]]
    none = pa.record_batch({"i": [1, 2], "text": pa.array([None, None], pa.string())})
    assert [s.num_rows for s in common.sized_slices(iter([none]), 1)] == [2]


@pytest.mark.parametrize("operator", ["op3_simple8b", "op4_packing"])
def test_operators_code_a_repeated_piece_once(spark, word_path, operator, monkeypatch, tmp_path):
    """Tasks run with a coder that can't remember pieces as objects and counts those it works out."""
    docs = spark.createDataFrame([(i, "one two three " * 20) for i in range(200)], "doc_id long, text string").coalesce(1)
    path = str(tmp_path / "worked")

    def coder(tokenizer):
        made = tokenization.WordCoder(tokenizer, memory=2)
        own = made._piece

        def logged(piece):
            with open(path, "a") as file:
                file.write(f"{piece}\n")
            return own(piece)

        made._piece = logged
        return made

    if operator == "op3_simple8b":
        monkeypatch.setattr(simple8b, "word_coder", coder)
        simple8b.write_token_table(docs, new_path(spark), word_path)
    else:
        monkeypatch.setattr(packing, "word_coder", coder)
        packing.cut_documents(docs, word_path)
    with open(path) as file:
        assert sorted(file.read().split()) == ["one", "three", "two"]
