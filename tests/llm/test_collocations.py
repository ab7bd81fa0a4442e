"""Phrase collocations against a plain count of all phrases."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa

from prefspark import storage
from prefspark.llm import collocations

SCHEMA = "doc_id long, text string, lang string, words string, leaf string, f long"


def plain(rows, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for size in (1, 2, 3):
                for i in range(len(w) - size + 1):
                    f[(lang, " ".join(w[i : i + size]))] += 1
    cands = {(lang, p): a for (lang, p), a in f.items() if a >= min_count and p.count(" ") >= 1}
    out = []
    for (lang, p), a in cands.items():
        w = p.split(" ")
        cuts = [((a * a * 1000000) // (f[(lang, " ".join(w[:k]))] * f[(lang, " ".join(w[k:]))]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        l, r = f[(lang, " ".join(w[:k]))], f[(lang, " ".join(w[k:]))]
        covered = any(
            lang == lang2 and len(q.split(" ")) == 3 and 100 * b >= 50 * a and (q.split(" ")[:2] == w or q.split(" ")[1:] == w)
            for (lang2, q), b in cands.items()
        ) if len(w) == 2 else False
        if not covered:
            out.append((lang, p, a, l, r, n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(mine[:top])]
    return sorted(ranked)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, lang, "x", "y", 3) for i, (t, lang) in enumerate(rows)], SCHEMA)
    got = collocations.collocations(df, **kw).collect()
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got)


def test_against_plain_counts_at_any_budget(spark):
    rnd = random.Random(5)
    vocab = ["ab", "cd", "Ef", "gh", "ij", "kl", "mn", "ÄÖ", "op"]
    rows = []
    for i in range(300):
        words = [rnd.choice(vocab[: 3 + i % 6]) for _ in range(rnd.randint(0, 30))]
        text = " ".join(w + rnd.choice(["", "", "", ".", ",", "\n", "\t"]) for w in words)
        rows.append((text, rnd.choice(["en", "de", None])))
    rows += [(None, "en"), ("", None), ("  .. ;; ", "de")] + rows[:40]  # nulls, empties, repeated rows
    want = plain(rows, min_count=10, top=25)
    assert want
    assert run(spark, rows, min_count=10, top=25) == want
    # Tiny budgets grow prefixes to two and three words: partial nodes are summed over groups.
    assert run(spark, rows, min_count=10, top=25, leaf_budget=2) == want


def test_drop_rule_ties_and_long_texts(spark):
    # "x y z" 12 times: "x y" and "y z" lie inside it with 100 * 12 >= 50 * a, so they go.
    rows = [("x y z.", "en")] * 12 + [("x y.", "en")] * 20 + [("q r. r q.", "en")] * 10
    got = run(spark, rows)
    assert [r[2] for r in got] == sorted({r[2] for r in got}, key=lambda p: [g[2] for g in got].index(p))
    assert got == plain(rows)
    assert "y z" not in {r[2] for r in got} and "x y" in {r[2] for r in got}  # 100 * 12 < 50 * 32
    long_text = " ".join(["aa bb cc"] * 20000)
    assert run(spark, [(long_text, "en")]) == plain([(long_text, "en")])


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, None), ("", "en")]) == []


def test_leaves_are_sent_as_places_in_word_lists(spark):
    # Rows to the groups hold each word once and no leaf is stored: stored tables hold prefixes, nodes and counts only.
    rnd = random.Random(8)
    vocab = [f"longishword{i:04d}" for i in range(300)]
    rows = [(" ".join(rnd.choice(vocab) for _ in range(400)), rnd.choice(["en", "de"])) for _ in range(100)]
    with storage.recorded_tables() as paths:
        assert run(spark, rows, min_count=3, top=50) == plain(rows, min_count=3, top=50)
    stored = sum(f.stat().st_size for path in paths for f in Path(path.removeprefix("file:")).glob("*.parquet"))
    assert stored < 40000 * 20  # 40,000 positions, nearly all of them distinct leaves


def test_windows_flushes_and_odd_bytes(spark, monkeypatch):
    # Leaves across windows, steps and hand-overs within one text; other white space and UTF-8 belongs to words.
    rows = [("A b  c\tD;é\x0bÿ\U0001f600 x\x85y \x1fz " * 12, "en"), ("ab cd ef gh. " * 40 + "ab cd", None), ("ab", "de")]
    want = plain(rows)
    assert want and run(spark, rows) == want and run(spark, rows, leaf_budget=2) == want
    batch = pa.record_batch([[lang or "und" for _, lang in rows], [text.encode() for text, _ in rows]], names=["lang", "text"])

    def subtrees():
        emit = collocations._dealt(3, 1, set())
        table = pa.Table.from_batches(list(collocations._over_leaves(iter([batch]), 3, emit)))
        return table.num_rows, sorted(map(str, collocations._subtrees(3, 1)(table).to_pylist()))

    one = subtrees()
    for name, value in (("WINDOW", 7), ("STEP", 3), ("POSITIONS", 11), ("ROW_LEAVES", 2)):
        monkeypatch.setattr(collocations, name, value)
    many = subtrees()
    assert many[0] > 5 * one[0] and many[1] == one[1]


def test_making_rows_takes_little_memory():
    # Whatever a task has counted, the arrays made besides stay few: rows are made a part at a time.
    rnd = np.random.default_rng(4)
    leaves = collocations._Leaves(3)
    for at in range(0, 1_000_000, 50_000):
        leaves.add("en", [b"w%d" % x for x in rnd.integers(0, 30_000, 50_002)])
    tracemalloc.start()
    rows = sum(batch.num_rows for batch in collocations._dealt(3, 50, set())(leaves))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows >= 50 and peak < 130 * leaves.positions
