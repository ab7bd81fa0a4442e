"""Spelling variants against a plain comparison of all word pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest

from prefspark.llm import spelling_variants
from prefspark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, word string, n long, other string, root string"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, l = (a, b) if len(a) < len(b) else (b, a)
    return any(l[:i] + l[i + 1 :] == s for i in range(len(l)))


def plain(rows, min_length=5, min_count=3):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    p = h % len(run)
                    run = run[:p] + run[p + 1 :]
            n[run] += 1
    vocab = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    form = {}
    out = {}
    for w, c in vocab.items():
        near_words = [o for o in vocab if near(w, o)]
        best = min(near_words, key=lambda o: (-vocab[o], o), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * c else None
        out[w] = (c, len(near_words))
    result = []
    for w, (c, k) in out.items():
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, c, k, vocab[form[w]] if form[w] else None))
    return sorted(result)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "w", 1, "o", "r") for i, t in rows], SCHEMA)
    got = spelling_variants.spelling_variants(df, **kw).collect()
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got)


def test_against_all_pairs(spark):
    rnd = random.Random(3)
    stems = ["Hello", "world", "ÄRGER", "straße", "colour", "theatre"]
    rows = []
    for i in range(400):
        words = []
        for _ in range(rnd.randint(0, 12)):
            w = list(rnd.choice(stems))
            if rnd.random() < 0.3:
                p = rnd.randrange(len(w))
                op = rnd.choice("drx")
                if op == "d":
                    del w[p]
                elif op == "r":
                    w[p] = rnd.choice("aeéz")
                else:
                    w.insert(p, rnd.choice("aeéz"))
            words.append("".join(w))
        rows.append((rnd.choice([i, i, None]), " ".join(words) + rnd.choice(["", " 12 x.", "\n"])))
    rows += [(5, None), (6, ""), (7, "12 34")] + rows[:30]
    want = plain(rows)
    assert any(f for _, f, *_ in want) and any(r != w for w, _, r, *_ in want)
    assert run(spark, rows) == want
    # Small blocks: many (target block, query block) tasks, same answer.
    assert run(spark, rows, target_block=3, query_block=2) == want


def test_blocks_meet_over_separate_partitions(spark):
    # Without merged partitions, a block's targets and queries meet only if their keys hash alike.
    rnd = random.Random(5)
    rows = [(None, " ".join("".join(rnd.choice("abc") for _ in range(rnd.randint(5, 6))) for _ in range(60))) for _ in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert run(spark, rows, target_block=40, query_block=30) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_chains_ties_and_long_runs(spark):
    # abcde (3) -> abcdx (6) -> abcxx? no: abcdy (12); ties of equal n go to the smaller word.
    rows = [(None, "abcde " * 3 + "abcdx " * 6 + "abcdy " * 12 + "zzzzz " * 3 + "zzzza " * 6 + "zzzzb " * 6)]
    got = {r[0]: r for r in run(spark, rows)}
    assert got["abcde"][1:3] == ("abcdx", "abcdy") or got["abcde"][1] == "abcdy"
    assert got["abcde"] == plain(rows)[[w for w, *_ in plain(rows)].index("abcde")]
    assert got["zzzzz"][1] == "zzzza" and got["zzzzz"][5] == 6
    long_run = "x" * 30000
    assert run(spark, [(None, f"{long_run} {long_run} {long_run}")]) == [(long_run, None, long_run, 3, 0, None)]


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "abc")]) == []


def test_query_shape(spark):
    df = QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")
    assert df.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    assert df.count() > 0


def test_every_edit_keeps_a_half_and_meets_few_blocks(spark, monkeypatch):
    # Edits at every place of even and odd words, repeated letters at the cut included.
    stems = ["abcdef", "abcdefg", "aaaaa", "aabbaa", "éàçèñ"]
    words = set(stems)
    for w in stems:
        for i in range(len(w) + 1):
            words |= {w[:i] + "a" + w[i:], w[:i] + w[i + 1 :], w[:i] + "z" + w[i + 1 :]}
    rows = [(None, " ".join(sorted(words))), (3, "É x" + "\U0001f600" + "abcdef ABCDEF×ÿÿÿÿÿ")] * 3
    for blocks in ({}, {"target_block": 2, "query_block": 2}):
        assert run(spark, rows, **blocks) == plain(rows)
    # A word's queries go to the blocks of its halves only: rows grow with the words, not with words times blocks.
    rnd = random.Random(9)
    vocab = spark.createDataFrame([("".join(rnd.choice("abcdefghij") for _ in range(8)), 3, 8) for _ in range(2000)], "word string, n long, size int").distinct()
    met = spark.sparkContext.accumulator(0)

    def searcher(data, queries):
        met.add(len(data) + len(queries))
        return pd.DataFrame(columns=["word", "other"])

    monkeypatch.setattr(spelling_variants, "_searcher", searcher)
    spelling_variants.near_pairs(vocab, target_block=100, query_block=100).count()
    assert 0 < met.value < 30 * 2000
