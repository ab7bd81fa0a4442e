from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions import tokens as T
from prefspark.operators import sft as S
from prefspark.operators import vocabulary as V
from prefspark.operators.pairs import encode_pair_batches


def ints(values):
    return F.lit(list(values)).cast("array<int>")


def test_split_tokens(one_row):
    assert one_row(T.split_tokens(F.lit(" a\t b\n\nc \x0b d"))) == (["a", "b", "c", "d"],)
    assert one_row(T.split_tokens(F.lit("  "))) == ([],)


@pytest.mark.parametrize("length", [1, 2, 5, 8, 100])
@pytest.mark.parametrize("prompt, response", [(0, 3), (3, 0), (4, 4), (20, 2), (2, 20), (20, 20)])
def test_sft_truncation(one_row, length, prompt, response):
    p, r = list(range(prompt)), list(range(100, 100 + response))
    kept_r = r[: max(1, length // 2)]
    kept_p = p[: length - len(kept_r)]
    cut = T.truncate_for_sft(ints(p), ints(r), length)
    assert one_row(*cut, *T.mask_prompt(*cut)) == (
        kept_p, kept_r, kept_p + kept_r, [-100] * len(kept_p) + kept_r
    )


def test_length_must_be_positive():
    with pytest.raises(ValueError):
        T.check_max_length(0)


def test_padding_and_mask(one_row):
    width = F.lit(5)
    assert one_row(
        T.pad_right(ints([1, 2]), width, 0), T.attention_mask(F.lit(2), width), T.pad_right(ints(range(5)), width, 9)
    ) == ([1, 2, 0, 0, 0], [1, 1, 0, 0, 0], [0, 1, 2, 3, 4])


def test_shift_and_supervised_count(one_row):
    labels = ints([-100, -100, 7, 8, -100])
    assert one_row(T.next_token_labels(labels), T.supervised_count(labels)) == ([-100, 7, 8, -100], 2)
    assert one_row(T.supervised_count(ints([]))) == (0,)
    assert one_row(T.supervised_count(ints([7]))) == (0,)


def test_pair_truncation_equals_step_by_step_trimming(spark):
    cases = [(a, b, n) for a in range(12) for b in range(12) for n in range(4, 16)]
    frame = spark.createDataFrame(cases, "a int, b int, n int")
    for n in range(4, 16):
        keep = T.pair_lengths(F.col("a"), F.col("b"), n)
        for a, b, got_a, got_b in frame.where(F.col("n") == n).select("a", "b", *keep).collect():
            want_a, want_b = a, b
            while want_a + want_b > n - 4:
                if want_a > want_b:
                    want_a -= 1
                else:
                    want_b -= 1
            assert (got_a, got_b) == (want_a, want_b), (a, b, n)


@pytest.mark.parametrize(
    "ids, prompt, new, expected",
    [
        ([1, 2, 9, 3], 5, 10, [1, 2, 9]),
        ([9, 1], 5, 10, [9]),
        ([1, 2, 3], 5, 10, [1, 2, 3]),
        ([1, 2, 3, 9], 5, 2, [1, 2]),
        ([1, 2, 9], 30, 10, []),
        ([1, 2, 9], 29, 10, [1]),
        ([1, 2, 9], 40, 10, []),
        ([], 5, 10, []),
        ([4, 8, 9], 5, 10, [4, 8]),
    ],
)
def test_stop_ids(one_row, ids, prompt, new, expected):
    cut = T.truncate_at_stop(ints(ids), F.lit(prompt), [9, 8], new, 30)
    assert one_row(cut) == (expected,)


def test_response_slice(one_row):
    assert one_row(T.response_slice(ints([10, 11, 12, 13]), F.lit(3))) == ([12, 13],)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(200, ""), (201, None), (202, "w0 " * 3000 + "[SEP] w1")]
    frame = spark.createDataFrame(rows, "id int, text string").repartition(4)
    return rows, frame


def brute_vocabulary(rows, size):
    counts = {}
    for _, text in rows:
        for word in (text or "").split():
            if word not in D.SPECIAL_TOKENS:
                counts[word] = counts.get(word, 0) + 1
    ranked = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:size]
    return {w: i for i, w in enumerate(list(D.SPECIAL_TOKENS) + [w for w, _ in ranked])}


@pytest.mark.parametrize("limit", [V.BROADCAST_BYTES, 0], ids=["broadcast", "shuffled"])
def test_vocabulary_round_trip(spark, corpus, limit):
    rows, frame = corpus
    ids = brute_vocabulary(rows, 25)
    vocabulary = V.build_vocabulary(frame, "text", 25)
    assert {r["token"]: r["id"] for r in vocabulary.collect()} == ids
    words = {i: w for w, i in ids.items()}
    coded = V.encode_tokens(frame, {"text": "ids"}, vocabulary, "id", limit)
    decoded = V.decode_tokens(coded, "ids", "back", vocabulary, "id", limit).collect()
    assert len(decoded) == len(rows)
    texts = dict(rows)
    for row in decoded:
        text = texts[row["id"]]
        if text is None:
            assert row["ids"] is None and row["back"] is None
            continue
        want = [ids.get(w, D.UNK_ID) for w in text.split()]
        assert row["ids"] == want
        assert row["back"] == " ".join(words[i] for i in want if i > D.UNK_ID)


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_batches_do_not_depend_on_partitioning(spark, partitions):
    rng = random.Random(1)
    examples = [
        (i * 3, f"prompt {i}", " ".join(rng.choices("abcdef", k=rng.randint(1, 30)))) for i in range(21)
    ]
    frame = spark.createDataFrame(examples, "pair_id int, prompt string, chosen string")
    vocabulary = V.build_vocabulary(frame, "chosen", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        encoded = S.encode_examples(frame.repartition(partitions), vocabulary, 24)
        rows = S.padded_batches(S.label_examples(encoded), 4).orderBy("pair_id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["batch_id"] for r in rows] == [i // 4 for i in range(21)]
    for batch in range(6):
        members = [r for r in rows if r["batch_id"] == batch]
        real = [sum(r["attention_mask"]) for r in members]
        assert {r["width"] for r in members} == {max(real)}
        for row, length in zip(members, real):
            width = row["width"]
            assert len(row["input_ids"]) == len(row["labels"]) == len(row["attention_mask"]) == width
            assert row["attention_mask"] == [1] * length + [0] * (width - length)
            assert row["input_ids"][length:] == [D.PAD_ID] * (width - length)
            assert row["labels"][length:] == [-100] * (width - length)
            kept = [x for x in row["labels"] if x != -100]
            assert row["input_ids"][length - len(kept) : length] == kept


def test_pair_batches(spark):
    rows = [(1, [10] * 2, [20] * 3), (2, [10] * 9, [20] * 9), (3, [], [20])]
    frame = spark.createDataFrame(rows, "pair_id int, prompt_ids array<int>, answer_ids array<int>")
    got = {r["pair_id"]: r for r in encode_pair_batches(frame, 12, 2).collect()}
    assert got[1]["input_ids"] == [1, 10, 10, 2, 2, 20, 20, 20, 2, 0, 0, 0]
    assert got[1]["attention_mask"] == [1] * 9 + [0] * 3
    assert got[2]["input_ids"] == [1] + [10] * 4 + [2, 2] + [20] * 4 + [2]
    assert (got[3]["batch_id"], got[3]["input_ids"]) == (1, [1, 2, 2, 20, 2])


def test_cross_entropy(spark):
    frame = spark.createDataFrame(
        [(0, -100, -9.0), (0, 5, -1.0), (0, 6, -3.0), (1, -100, -1.0)], "b int, label int, lp double"
    )
    got = {r["b"]: r for r in S.response_cross_entropy(frame, "b", "label", "lp").collect()}
    assert (got[0]["n_supervised"], got[0]["loss"]) == (2, 2.0)
    assert got[1]["n_supervised"] == 0 and got[1]["loss"] != got[1]["loss"]


def test_both_paths_agree_on_odd_rows(spark):
    """Null and repeated keys, ids with gaps and texts that start alike, looked up and joined."""
    rows = [(None, "a b"), (1, "a b"), (1, "c c"), (2, ""), (3, None)] + [(i, "[CLS] a zzz") for i in range(10, 60)]
    frame = spark.createDataFrame(rows, "k long, text string")
    words = V.build_vocabulary(spark.createDataFrame([("a b c d a",)], "text string"), "text").where("token <> 'c'")
    coded = [
        V.encode_tokens(frame, {"text": "ids"}, words, "k", broadcast_bytes=b).select("k", "text", "ids") for b in (0, 1 << 25)
    ]
    plain = lambda f: sorted(map(str, f.collect()))
    assert plain(coded[0]) == plain(coded[1]) and coded[0].count() == len(rows)
    ids = frame.select("k").withColumn("ids", F.array(F.lit(6), F.lit(7), F.lit(8), F.lit(9)))
    decoded = [V.decode_tokens(ids, "ids", "back", words, "k", broadcast_bytes=b) for b in (0, 1 << 25)]
    assert plain(decoded[0]) == plain(decoded[1]) and decoded[0].count() == len(rows)


def test_only_words_outside_the_head_are_joined(spark):
    """A dictionary of which only the head fits a task: same ids and texts, no copies of it per salt."""
    rows = [(i % 7 if i % 5 else None, " ".join(["a"] * 9 + [f"w{(i * j) % 23}" for j in range(i % 12)]), None if i % 4 == 0 else f"a b{i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "k long, text string, other string")
    words = V.build_vocabulary(frame, "text")
    names = {"text": "ids", "other": "more"}
    plain = lambda f: sorted(map(str, f.collect()))
    coded = [V.encode_tokens(frame, names, words, "k", broadcast_bytes=b) for b in (700, 0, 1 << 25)]
    assert plain(coded[0]) == plain(coded[2]) and plain(coded[1]) == plain(coded[2])
    decoded = [V.decode_tokens(coded[2], "ids", "back", words, "k", broadcast_bytes=b) for b in (700, 0, 1 << 25)]
    assert plain(decoded[0]) == plain(decoded[2]) and plain(decoded[1]) == plain(decoded[2])
    assert all("_salt" not in f._jdf.queryExecution().toString() for f in (coded[0], decoded[0]))


def test_batches_neither_lose_nor_double_rows(spark):
    labelled = spark.createDataFrame([(1, [5], [5]), (1, [6, 7], [6, 7]), (2, [8], [8]), (None, [9], [9])], "pair_id long, input_ids array<int>, labels array<int>")
    rows = S.padded_batches(labelled, 2).collect()
    assert sorted(r.ordinal for r in rows) == [1, 2, 3, 4]
    assert sorted(x for r in rows for x, m in zip(r.input_ids, r.attention_mask) if m) == [5, 6, 7, 8, 9]
