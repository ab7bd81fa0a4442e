"""What a Python worker keeps between tasks stays small next to an executor's memory."""

from __future__ import annotations

import sys

from prefspark.llm import near_duplicates, tokenization


def kept(memory: dict) -> int:
    return sys.getsizeof(memory) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memory.items())


def test_word_hashes():
    near_duplicates._HASHES.clear()
    for at in range(0, 450_000, 50_000):
        near_duplicates.shingle_set(" ".join(f"word{i}" for i in range(at, at + 50_000)), 4)
    assert kept(near_duplicates._HASHES) < 35 << 20
    near_duplicates._HASHES.clear()


def test_coded_pieces():
    coder = tokenization.WordCoder(tokenization.tokenizer_path("word_bpe_49k.json"))
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters]
    text = " ".join(words)
    assert len(words) > 450_000 and coder.encode(text)
    assert kept(coder) + kept(coder._words) < 70 << 20
