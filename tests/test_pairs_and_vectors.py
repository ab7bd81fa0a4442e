from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from prefspark.operators import pairs as P
from prefspark.operators.ranker import fit_pairwise_ranker, score_pairs
from prefspark.operators.scoring import batch_score, batch_verdicts
from prefspark.operators.vectors import masked_mean_pool, mean_fill_vectors


def test_pair_scores_and_losses(spark):
    rows = [(1, "chosen", 2.0), (1, "rejected", 0.5), (2, "chosen", 0.1), (2, "rejected", 0.4), (3, "chosen", 1.0)]
    scores = P.pair_scores(spark.createDataFrame(rows, "pair_id int, side string, score double"))
    losses = {r["pair_id"]: r["loss"] for r in P.margin_losses(scores.where("pair_id < 3")).collect()}
    assert losses == {1: 0.0, 2: pytest.approx(1.3)}
    assert scores.where("pair_id = 3").first()["rejected"] is None
    batch = P.margin_loss_by_batch(scores.where("pair_id < 3"), batch_size=4).collect()
    assert [(r["batch_id"], r["n_pairs"], r["loss"]) for r in batch] == [(0, 2, pytest.approx(0.65))]


def test_masked_mean_pool(spark):
    rows = [(1, [1.0, 2.0], True), (1, [3.0, 6.0], True), (1, [9.0, 9.0], False), (2, [5.0, 5.0], False)]
    frame = spark.createDataFrame(rows, "g int, v array<float>, m boolean").repartition(3)
    got = {r["g"]: (r["n_vectors"], r["pooled"]) for r in masked_mean_pool(frame, "g", "v", "m").collect()}
    assert got == {1: (2, [2.0, 4.0]), 2: (0, [0.0, 0.0])}


def test_mean_fill(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0]), (3, None)], "id int, v array<float>")
    got = {r["id"]: r["filled"] for r in mean_fill_vectors(frame, "v").collect()}
    assert got == {1: [1.0, 2.0], 2: [3.0, 6.0], 3: [2.0, 4.0]}


def test_scorer_loads_once_per_task_and_failures_are_null(spark):
    def make_scorer():
        loads = []

        def scorer(texts, factors):
            loads.append(1)
            if (texts == "bad").any():
                raise ValueError("refused")
            values = texts.str.len() * factors
            return [None if t == "odd" else v for t, v in zip(texts, values)]

        return scorer

    rows = [(1, "abc", 2), (2, "bad", 1), (3, "odd", 1), (4, "", 5)]
    frame = spark.createDataFrame(rows, "id int, text string, f int").coalesce(1)
    got = {r["id"]: r["score"] for r in batch_score(frame, make_scorer, ["id"], ["text", "f"]).collect()}
    assert got == {1: 6.0, 2: None, 3: None, 4: 0.0}
    empty = batch_score(frame.where("id < 0"), make_scorer, ["id"], ["text", "f"])
    assert empty.dtypes == [("id", "int"), ("score", "double")] and empty.count() == 0


def test_a_judge_as_a_callable(spark):
    def make_judge():
        def judge(prompts, first, second):
            if (first == "").any():
                raise ValueError("nothing to compare")
            return ["A" if len(a) > len(b) else "b" for a, b in zip(first, second)]

        return judge

    rows = [(1, "q", "long answer", "short"), (2, "q", "", "x"), (3, "q", "x", "longer")]
    frame = spark.createDataFrame(rows, "prompt_id int, prompt string, sft_answer string, ppo_answer string")
    got = {r["prompt_id"]: r["verdict_raw"] for r in batch_verdicts(frame.coalesce(1), make_judge).collect()}
    assert got == {1: "A", 2: None, 3: "b"}


def test_other_errors_of_a_scorer_surface(spark):
    def make_scorer():
        def scorer(texts):
            raise KeyError("bug")

        return scorer

    frame = spark.createDataFrame([(1, "a")], "id int, text string")
    with pytest.raises(Exception, match="bug"):
        batch_score(frame, make_scorer, ["id"], ["text"]).collect()


@pytest.fixture(scope="module")
def graded(spark):
    """Chosen answers carry good words, rejected ones bad words, both carry filler."""
    rng = random.Random(4)
    filler = [f"f{i}" for i in range(30)]

    def answer(words):
        picked = rng.choices(words, k=3) + rng.choices(filler, k=8)
        rng.shuffle(picked)
        return " ".join(picked)

    rows = [(i, answer(["good", "fine", "clear"]), answer(["bad", "wrong", "vague"])) for i in range(120)]
    return spark.createDataFrame(rows, "pair_id int, chosen string, rejected string").repartition(2)


def test_ranker_learns_the_order(spark, graded):
    ranker = fit_pairwise_ranker(graded, features=1 << 10, iterations=20)
    scored = score_pairs(ranker, graded).agg(F.avg((F.col("margin") > 0).cast("int")), F.avg("loss")).first()
    assert scored[0] == 1.0 and scored[1] < 0.2
    unseen = spark.createDataFrame([(1, "clear f1 f2", "vague f1 f2")], "pair_id int, chosen string, rejected string")
    row = score_pairs(ranker, unseen).first()
    assert row["margin"] > 0 and row["margin"] == pytest.approx(row["chosen_score"] - row["rejected_score"])


def test_weights_of_the_two_sides_are_opposite(graded):
    ranker = fit_pairwise_ranker(graded, features=1 << 8, iterations=60)
    weights = ranker.model.coefficients.toArray()
    assert weights[: 1 << 8] == pytest.approx(-weights[1 << 8 :], abs=1e-3)
    assert ranker.model.intercept == 0.0


def test_ranker_margin_must_be_positive(graded):
    with pytest.raises(ValueError):
        fit_pairwise_ranker(graded, margin=0)


def test_document_pairs_cut_large_groups(spark, tmp_path, monkeypatch):
    """A language that is most of the table is not numbered by one task, and pairs stay the same."""
    from catalog import fixtures as X

    docs = [(i, f"text {i}", "en" if i % 10 else "de", "src") for i in range(400)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 3 % 2) for i in range(400)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(X, "TEXT_ROWS_PER_BUCKET", 1_000_000)
    whole = X.document_pairs(spark, str(tmp_path))
    want = sorted(map(tuple, whole.collect()))
    monkeypatch.setattr(X, "TEXT_ROWS_PER_BUCKET", 50)
    cut = X.document_pairs(spark, str(tmp_path))
    assert sorted(map(tuple, cut.collect())) == want and want
    plan = lambda f: f._jdf.queryExecution().toString()
    assert "_bucket" in plan(cut) and "_bucket" not in plan(whole)
