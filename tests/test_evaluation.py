from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from prefspark.operators import evaluation as E
from prefspark.plans.jobs import policy_comparison, sft_batches
from prefspark.operators.vocabulary import build_vocabulary
from prefspark.sources import readers, writers

RAW = "prompt_id int, verdict_raw string, score_raw string, reward double"


def judged(spark, rows):
    return E.parse_judgements(spark.createDataFrame(rows, RAW))


def test_one_prompt(spark):
    row = E.evaluation_summary(judged(spark, [(1, "B", "4.0", 3.0)])).first()
    assert (row["ppo_wins"], row["ppo_win_rate"], row["n_errors"], row["mean_error"]) == (1, 1.0, 1, 1.0)


def test_win_rates(spark):
    def rate(rows):
        return E.evaluation_summary(judged(spark, rows)).first()["ppo_win_rate"]

    assert rate([(1, "A", None, None)] + [(i, "B", None, None) for i in range(3)]) == 0.75
    assert rate([(1, "tie", None, None)]) == 0.0
    published = [(i, "A" if i < 53 else "B", None, None) for i in range(599)]
    assert rate(published) == pytest.approx(0.91152, abs=5e-6)


def test_empty_evaluation(spark):
    row = E.evaluation_summary(judged(spark, [])).first()
    assert (row["sft_wins"], row["evaluated_preferences"], row["ppo_win_rate"]) == (0, 0, 0.0)


def test_skipped_counts_follow_the_order_of_checks(spark):
    rows = [
        (1, "tie", "bad", None),  # malformed verdict: the rating is not looked at
        (2, None, "4", 1.0),
        (3, "A", "bad", 1.0),  # a win, and a skipped score
        (4, "B", "4", None),
        (5, "B", "4", 1.5),
    ]
    row = E.evaluation_summary(judged(spark, rows)).first()
    assert (row["skipped_preferences"], row["skipped_scores"]) == (2, 2)
    assert (row["sft_wins"], row["ppo_wins"], row["n_errors"], row["mean_error"]) == (1, 2, 1, 2.5)


def answers(spark):
    first = spark.createDataFrame([(1, "q1", "a1"), (2, "q2", "a2"), (3, "q3", "a3")], "prompt_id int, prompt string, sft_answer string")
    second = spark.createDataFrame([(1, "b1"), (2, "b2")], "prompt_id int, ppo_answer string")
    return first, second


def test_comparison_from_tables(spark):
    first, second = answers(spark)
    verdicts = spark.createDataFrame([(1, " b ")], "prompt_id int, verdict_raw string")
    ratings = spark.createDataFrame([(1, "5"), (2, "1")], "prompt_id int, score_raw string")
    rewards = spark.createDataFrame([(1, 2.0)], "prompt_id int, reward double")
    row = policy_comparison(first, second, verdicts, ratings, rewards).first()
    assert (row["ppo_wins"], row["skipped_preferences"], row["skipped_scores"], row["mean_error"]) == (1, 1, 0, 3.0)


def test_request_texts(spark, tmp_path):
    first, second = answers(spark)
    requests = E.judge_requests(first.join(second, "prompt_id"))
    rows = {(r["prompt_id"], r["kind"]): r for r in requests.collect()}
    assert len(rows) == 4
    preference = rows[1, "preference"]
    assert preference["system"] == "You are an impartial response-quality evaluator."
    assert preference["user"] == (
        "Question:\nq1\n\nAnswer A:\na1\n\nAnswer B:\nb1\n\n"
        "Choose the better answer. Respond with exactly A or B."
    )
    assert rows[1, "rating"]["user"] == (
        "Question:\nq1\n\nAnswer:\nb1\n\nScore the answer from 1 to 5. Respond with only a number."
    )
    writers.write_judge_requests(requests, str(tmp_path / "requests"))
    assert spark.read.json(str(tmp_path / "requests")).count() == 4


def test_summary_sink_replaces_what_was_there(spark, tmp_path):
    path = str(tmp_path / "result")
    rows = [(i, "A" if i == 0 else "B", "3", 3.0 - i) for i in range(4)]
    writers.write_evaluation(judged(spark, [(9, "A", "1", 1.0)]), path)
    writers.write_evaluation(judged(spark, rows), path)
    (text,) = [r["value"] for r in spark.read.text(f"{path}/summary").collect()]
    assert '"ppo_win_rate":0.75' in text
    assert json.loads(text)["evaluated_preferences"] == 4
    errors = spark.read.json(f"{path}/errors").orderBy("sample").collect()
    assert [(r["sample"], r["abs_error"]) for r in errors] == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 3.0)]


def test_error_profile(spark):
    row = E.error_profile(judged(spark, [(i, "A", "3", 3.0 - i) for i in range(3)])).first()
    assert (row["n_errors"], row["mean_error"], row["min_error"], row["max_error"]) == (3, 1.0, 0.0, 2.0)


def test_prompt_readers(spark, tmp_path):
    sheet = spark.createDataFrame([(3, "c\nx"), (1, None), (2, 'b "q"')], "prompt_id int, Prompts string")
    sheet.write.parquet(str(tmp_path / "sheet"))
    sheet.write.csv(str(tmp_path / "sheet.csv"), header=True, escape='"')
    for name in ("sheet", "sheet.csv"):
        rows = readers.read_prompts(spark, str(tmp_path / name), multi_line=True).orderBy("prompt_id").collect()
        assert [tuple(r) for r in rows] == [(2, 'b "q"'), (3, "c\nx")]
        limited = readers.read_prompts(spark, str(tmp_path / name), limit=1, multi_line=True).collect()
        assert [r["prompt_id"] for r in limited] == [2]
    numbers = spark.createDataFrame([(1, 1.5), (2, float("nan")), (3, None)], "prompt_id int, Prompts double")
    assert [tuple(r) for r in readers.evaluation_prompts(numbers).collect()] == [(1, "1.5")]


def test_preference_reader_and_batch_sink(spark, tmp_path):
    rows = [(i, f"ask {i}", f"yes {'w ' * i}", "no", "unused") for i in range(10)]
    table = spark.createDataFrame(rows, "pair_id int, prompt string, chosen string, rejected string, extra string")
    table.write.parquet(str(tmp_path / "preferences"))
    read = readers.read_preferences(spark, str(tmp_path / "preferences"), "pair_id", 7)
    assert read.columns == ["pair_id", "prompt", "chosen", "rejected"]
    assert sorted(r["pair_id"] for r in read.collect()) == list(range(7))
    assert readers.read_preferences(spark, str(tmp_path / "preferences")).columns == read.columns[1:]
    with pytest.raises(ValueError):
        readers.read_preferences(spark, str(tmp_path / "preferences"), limit=3)

    vocabulary = build_vocabulary(table, "chosen", 50)
    writers.write_padded_batches(sft_batches(read, vocabulary), str(tmp_path / "batches"))
    written = spark.read.parquet(str(tmp_path / "batches"))
    assert written.count() == 7
    places = written.select("batch_id", F.input_file_name().alias("file")).distinct()
    assert sorted(r["batch_id"] for r in places.collect()) == [0, 1]


def test_doubled_reply_is_an_error(spark):
    answers = spark.createDataFrame([(1, "q", "a")], "prompt_id long, prompt string, sft_answer string")
    second = spark.createDataFrame([(1, "b")], "prompt_id long, ppo_answer string")
    verdicts = spark.createDataFrame([(1, "B"), (1, "B")], "prompt_id long, verdict_raw string")
    ratings = spark.createDataFrame([(1, "4")], "prompt_id long, score_raw string")
    rewards = spark.createDataFrame([(1, 3.0)], "prompt_id long, reward double")
    with pytest.raises(Exception, match="verdicts: prompt 1 has 2 rows"):
        E.paired_answers(answers, second, verdicts, ratings, rewards).collect()
    single = E.paired_answers(answers, second, verdicts.limit(1), ratings, rewards).collect()
    assert [(r.prompt_id, r.verdict_raw, r.score_raw, r.reward) for r in single] == [(1, "B", "4", 3.0)]
