"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as X
from prefspark import defaults as D
from prefspark.functions import logits as L
from prefspark.functions.judge import parse_rating, parse_verdict
from prefspark.functions.losses import linear_score as linear
from prefspark.functions.text import format_prompt, format_response, text_or_default
from prefspark.functions.text import strip_text as strip
from prefspark.functions.tokens import supervised_count, truncate_at_stop as cut_at_stop
from prefspark.operators import analyses as A
from prefspark.operators import conversations as C
from prefspark.operators import dedup as U
from prefspark.operators import evaluation as E
from prefspark.operators import ordinals as O
from prefspark.operators import pairs as P
from prefspark.operators import preferences as R
from prefspark.operators import ranker as K
from prefspark.operators import rollouts as T
from prefspark.operators import sft as S
from prefspark.operators import vectors as V
from prefspark.operators import vocabulary as W
from prefspark.operators.scoring import batch_score as score_batches
from prefspark.plans import jobs
from prefspark.sources.readers import evaluation_prompts as known_prompts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STOP_EVERY = 97
STOP_BELOW = 1000
LINEAR_WEIGHTS = [((i * 7) % 11 - 5) / 10 for i in range(64)]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def r6(value: Column | str) -> Column:
    """Six decimals, without a negative zero, so that summation order does not show."""
    rounded = F.round(value, 6)
    return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)


def joined(ids: str) -> Column:
    return F.array_join(F.col(ids).cast("array<string>"), ",")


# Preference rows and messages


@query
def preference_examples(spark, sf):
    return R.preference_examples(X.nested_preferences(spark, sf))


@query
def limit_examples(spark, sf):
    return R.first_rows(X.chat_pairs(spark, sf), "pair_id", 20)


@query
def evaluation_prompts(spark, sf):
    return known_prompts(X.prompt_sheet(spark, sf))


@query
def final_response(spark, sf):
    return C.final_responses(X.table(spark, sf, "conversations"))


@query
def invalid_responses(spark, sf):
    return R.invalid_preferences(X.nested_preferences(spark, sf)).select("pair_id", "reason")


@query
def response_fallback(spark, sf):
    answers = C.final_responses(X.table(spark, sf, "conversations"))
    emptied = F.when(F.expr("conv_id % 3 = 0"), F.lit("")).when(
        F.expr("conv_id % 3 = 1"), F.col("response")
    )
    return answers.select("conv_id", text_or_default(emptied, D.EMPTY_ANSWER).alias("response"))


@query
def strip_text(spark, sf):
    blank = "\t \u00a0\u3000\x1c"
    return X.table(spark, sf, "documents").select(
        "doc_id",
        strip(F.concat(F.lit(blank), F.col("text"), F.lit(blank[::-1] + "\n"))).alias("text"),
    )


@query
def format_prompts(spark, sf):
    pairs = X.chat_pairs(spark, sf)
    return pairs.select("pair_id", format_prompt(F.col("prompt")).alias("prompt_text"))


@query
def format_responses(spark, sf):
    pairs = X.chat_pairs(spark, sf)
    return pairs.select("pair_id", format_response(F.col("chosen")).alias("response_text"))


@query
def sft_examples(spark, sf):
    examples = R.preference_examples(X.nested_preferences(spark, sf))
    return S.format_examples(examples)


@query
def assemble_conversations(spark, sf):
    folded = C.assemble_conversations(X.table(spark, sf, "conversations"))
    line = F.transform(
        "messages", lambda m: F.concat(m["turn"].cast("string"), F.lit(":"), m["role"], F.lit(":"), m["content"])
    )
    return folded.select(
        "conv_id",
        "part",
        F.size("messages").cast("bigint").alias("n_turns"),
        F.array_join(line, "\n").alias("messages"),
    )


# Judge evaluation


def _judgements(spark, sf):
    return E.parse_judgements(X.judge_replies(spark, sf))


def _answers(spark, sf, every_document=False):
    """Both policies' answers; the second policy has none for a seventh of the prompts unless ``every_document``."""
    documents = X.table(spark, sf, "documents")
    sft = documents.select(
        F.col("doc_id").alias("prompt_id"), X.topic_prompt().alias("prompt"),
        F.col("text").alias("sft_answer"),
    )
    ppo = (documents if every_document else documents.where(F.expr("doc_id % 7 <> 0"))).select(
        F.col("doc_id").alias("prompt_id"), F.concat("text", F.lit(" "), "lang").alias("ppo_answer")
    )
    return sft, ppo


@query
def judge_requests(spark, sf):
    sft, ppo = _answers(spark, sf, every_document=True)
    return E.judge_requests(sft.join(ppo, "prompt_id"))


@query
def parse_verdicts(spark, sf):
    replies = X.judge_replies(spark, sf)
    return replies.select("prompt_id", parse_verdict(F.col("verdict_raw")).alias("verdict"))


@query
def parse_scores(spark, sf):
    replies = X.judge_replies(spark, sf)
    return replies.select("prompt_id", parse_rating(F.col("score_raw")).alias("judge_score"))


def _paired(spark, sf):
    sft, ppo = _answers(spark, sf)
    replies = X.judge_replies(spark, sf)
    return E.paired_answers(
        sft,
        ppo,
        replies.select("prompt_id", "verdict_raw"),
        replies.select("prompt_id", "score_raw"),
        replies.select("prompt_id", "reward"),
    )


@query
def paired_answers(spark, sf):
    return E.parse_judgements(_paired(spark, sf)).select(
        "prompt_id", "prompt", "sft_answer", "ppo_answer", "verdict", "judge_score", "reward"
    )


@query
def policy_comparison(spark, sf):
    summary = E.evaluation_summary(E.parse_judgements(_paired(spark, sf)))
    return summary.withColumn("ppo_win_rate", r6("ppo_win_rate")).withColumn(
        "mean_error", r6("mean_error")
    )


@query
def win_counts(spark, sf):
    return _judgements(spark, sf).agg(*E.win_counts())


@query
def skipped_counts(spark, sf):
    return _judgements(spark, sf).agg(*E.skipped_counts())


@query
def win_rate(spark, sf):
    counts = E.with_win_rate(_judgements(spark, sf).agg(*E.win_counts()))
    return counts.select("evaluated_preferences", r6("ppo_win_rate").alias("ppo_win_rate"))


@query
def reward_judge_errors(spark, sf):
    return E.rating_errors(_judgements(spark, sf)).withColumn("abs_error", r6("abs_error"))


@query
def error_list(spark, sf):
    return E.ordered_errors(_judgements(spark, sf)).withColumn("abs_error", r6("abs_error"))


@query
def error_profile(spark, sf):
    profile = E.error_profile(_judgements(spark, sf))
    return profile.select(
        "n_errors",
        *[r6(c).alias(c) for c in ("mean_error", "min_error", "max_error", "std_error")],
    )


@query
def evaluation_summary(spark, sf):
    summary = E.evaluation_summary(_judgements(spark, sf))
    return summary.withColumn("ppo_win_rate", r6("ppo_win_rate")).withColumn(
        "mean_error", r6("mean_error")
    )


# Rollouts


def _rewarded(spark, sf):
    tokens = T.drift_rewards(T.response_tokens(X.logged_rollouts(spark, sf)))
    return T.returns_and_advantages(tokens, X.terminal_rewards(spark, sf))


@query
def align_reference(spark, sf):
    tokens = X.logged_rollouts(spark, sf)
    reference = tokens.where("token_id % 10 <> 3").select("rollout_id", "pos", "ref_lp")
    aligned = T.align_reference(tokens.select("rollout_id", "pos", "old_lp"), reference)
    return aligned.select("rollout_id", "pos", r6("old_lp").alias("old_lp"), r6("ref_lp").alias("ref_lp"))


@query
def unmatched_tokens(spark, sf):
    tokens = X.logged_rollouts(spark, sf)
    reference = tokens.where("token_id % 10 <> 3").select("rollout_id", "pos", "ref_lp")
    return T.unmatched_tokens(tokens.select("rollout_id", "pos", "token_id"), reference)


@query
def response_tokens(spark, sf):
    return T.response_tokens(X.rollouts(spark, sf)).select("rollout_id", "pos", "token_id")


def _generated(spark, sf):
    late = X.rollouts(spark, sf).withColumn("prompt_length", F.expr("40 + rollout_id % 60"))
    return T.generated_counts(late)


@query
def nonempty_rollouts(spark, sf):
    return _generated(spark, sf).where("n_generated > 0")


@query
def skipped_rollouts(spark, sf):
    empty = F.col("n_generated") == 0
    return _generated(spark, sf).agg(
        F.count_if(~empty).alias("n_kept"), F.count_if(empty).alias("n_skipped")
    )


@query
def kl_token_rewards(spark, sf):
    tokens = T.drift_rewards(X.rollouts(spark, sf))
    return tokens.select("rollout_id", "pos", r6("token_reward").alias("token_reward"))


@query
def terminal_rewards(spark, sf):
    tokens = T.drift_rewards(X.logged_rollouts(spark, sf))
    rewarded = T.add_terminal_rewards(tokens, X.terminal_rewards(spark, sf))
    return rewarded.select("rollout_id", "pos", r6("token_reward").alias("token_reward"))


@query
def returns_to_go(spark, sf):
    tokens = T.returns_to_go(T.drift_rewards(X.logged_rollouts(spark, sf)))
    return tokens.select("rollout_id", "pos", r6("ret").alias("ret"))


@query
def normalized_advantages(spark, sf):
    return _rewarded(spark, sf).select(
        "rollout_id", "pos", r6("ret").alias("ret"), r6("advantage").alias("advantage")
    )


@query
def next_token_alignment(spark, sf):
    paired = T.next_tokens(X.rollouts(spark, sf))
    return paired.select("rollout_id", "pos", "token_id", "next_token_id", r6("val").alias("val"))


@query
def clipped_surrogate(spark, sf):
    tokens = T.surrogates(_rewarded(spark, sf))
    return tokens.select("rollout_id", "pos", r6("surrogate").alias("surrogate"))


@query
def policy_loss(spark, sf):
    losses = T.policy_losses(_rewarded(spark, sf))
    return losses.select("rollout_id", r6("policy_loss").alias("policy_loss"))


@query
def value_loss(spark, sf):
    losses = T.value_losses(_rewarded(spark, sf))
    return losses.select("rollout_id", r6("value_loss").alias("value_loss"))


@query
def rollout_metrics(spark, sf):
    metrics = jobs.rollout_losses(X.logged_rollouts(spark, sf), X.terminal_rewards(spark, sf))
    return metrics.select(
        "rollout_id",
        "n_tokens",
        "terminal_reward",
        *[r6(c).alias(c) for c in ("policy_loss", "value_loss", "loss")],
    )


@query
def sft_cross_entropy(spark, sf):
    tokens = X.rollouts(spark, sf).selectExpr(
        "rollout_id div 4 AS batch_id",
        "CASE WHEN pos < prompt_length THEN -100 ELSE token_id END AS label",
        "lp",
    )
    losses = S.response_cross_entropy(tokens, "batch_id", "label", "lp")
    return losses.withColumn("loss", r6("loss"))


# Batches and token sequences


@query
def batch_assign(spark, sf):
    documents = X.table(spark, sf, "documents").select("doc_id")
    return O.assign_batches(documents, ["doc_id"])


@query
def build_vocabulary(spark, sf):
    return X.vocabulary(spark, sf)


def _encoded_documents(spark, sf, vocabulary):
    documents = X.table(spark, sf, "documents").select("doc_id", "text")
    return W.encode_tokens(documents, {"text": "ids"}, vocabulary, "doc_id")


@query
def encode_tokens(spark, sf):
    coded = _encoded_documents(spark, sf, X.vocabulary(spark, sf))
    unknown = F.size(F.filter("ids", lambda i: i == D.UNK_ID))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        unknown.cast("bigint").alias("n_unknown"),
        joined("ids").alias("ids"),
    )


@query
def decode_tokens(spark, sf):
    vocabulary = X.vocabulary(spark, sf)
    coded = _encoded_documents(spark, sf, vocabulary).select(
        "doc_id", F.concat(F.array(F.lit(1)), "ids", F.array(F.lit(4), F.lit(2))).alias("ids")
    )
    return W.decode_tokens(coded, "ids", "text", vocabulary, "doc_id").select("doc_id", "text")


@query
def truncate_at_stop(spark, sf):
    coded = _encoded_documents(spark, sf, X.vocabulary(spark, sf))
    stops = list(range(STOP_EVERY, STOP_BELOW, STOP_EVERY))
    cut = coded.withColumn("prompt_length", F.expr("870 + doc_id % 160")).select(
        "doc_id", cut_at_stop(F.col("ids"), F.col("prompt_length"), stops).alias("ids")
    )
    return cut.select("doc_id", F.size("ids").cast("bigint").alias("n_kept"), joined("ids").alias("ids"))


def _encoded_examples(spark, sf):
    return S.encode_examples(X.sft_examples(spark, sf), X.vocabulary(spark, sf), 128)


@query
def sft_truncate(spark, sf):
    return _encoded_examples(spark, sf).select(
        "pair_id", joined("prompt_ids").alias("prompt_ids"), joined("response_ids").alias("response_ids")
    )


@query
def sft_label_mask(spark, sf):
    return S.label_examples(_encoded_examples(spark, sf)).select(
        "pair_id", joined("input_ids").alias("input_ids"), joined("labels").alias("labels")
    )


@query
def sft_padded_batches(spark, sf):
    batches = S.padded_batches(S.label_examples(_encoded_examples(spark, sf)))
    return batches.select(
        "batch_id",
        "pair_id",
        F.col("width").cast("bigint").alias("width"),
        *[joined(c).alias(c) for c in ("input_ids", "attention_mask", "labels")],
    )


@query
def supervised_token_counts(spark, sf):
    labelled = S.label_examples(_encoded_examples(spark, sf))
    return labelled.select(
        "pair_id", supervised_count(F.col("labels")).cast("bigint").alias("n_supervised")
    )


@query
def pair_truncate(spark, sf):
    coded = W.encode_tokens(
        X.chat_pairs(spark, sf).select("pair_id", "prompt", "chosen"),
        {"prompt": "prompt_ids", "chosen": "answer_ids"},
        X.vocabulary(spark, sf),
        "pair_id",
    )
    return P.encode_pair_batches(coded, max_length=48).select(
        "batch_id",
        "pair_id",
        *[F.col(c).cast("bigint").alias(c) for c in ("prompt_length", "answer_length", "width")],
        joined("input_ids").alias("input_ids"),
        joined("attention_mask").alias("attention_mask"),
    )


# Distributions and vectors


def _logits(spark, sf):
    return X.table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("logits")
    )


@query
def log_softmax(spark, sf):
    values = _logits(spark, sf).select(
        "vec_id", F.posexplode(L.log_softmax(F.col("logits"))).alias("idx", "x")
    )
    return values.select("vec_id", F.col("idx").cast("bigint").alias("idx"), r6("x").alias("log_prob"))


@query
def gather_target_logprob(spark, sf):
    return _logits(spark, sf).select(
        "vec_id", r6(L.target_log_prob(F.col("logits"), F.col("label"))).alias("log_prob")
    )


@query
def topk_with_ties(spark, sf):
    coarse = F.transform("logits", lambda x: F.floor(x * 16).cast("double"))
    kept = _logits(spark, sf).select(
        "vec_id", F.posexplode(L.top_k_logits(coarse, 10)).alias("idx", "logit")
    )
    return kept.where(F.col("logit").isNotNull()).select(
        "vec_id", F.col("idx").cast("bigint").alias("idx"), "logit"
    )


@query
def topk_softmax(spark, sf):
    values = _logits(spark, sf).select(
        "vec_id", F.posexplode(L.top_k_softmax(F.col("logits"))).alias("idx", "p")
    )
    return values.select("vec_id", F.col("idx").cast("bigint").alias("idx"), r6("p").alias("p"))


@query
def sample_per_group(spark, sf):
    drawn = L.sample_index(L.top_k_softmax(F.col("logits")), F.col("vec_id"))
    return _logits(spark, sf).select("vec_id", drawn.alias("idx"))


@query
def greedy_per_group(spark, sf):
    return _logits(spark, sf).select("vec_id", L.greedy_index(F.col("logits")).alias("idx"))


@query
def masked_mean_pool(spark, sf):
    vectors = X.table(spark, sf, "embeddings").withColumn("mask", F.expr("vec_id % 3 <> 0"))
    pooled = V.masked_mean_pool(vectors, "label", "embedding", "mask")
    return pooled.select("label", "n_vectors", F.posexplode("pooled").alias("idx", "x")).select(
        "label", "n_vectors", F.col("idx").cast("bigint").alias("idx"), r6("x").alias("pooled")
    )


@query
def mean_fill_vectors(spark, sf):
    vectors = X.table(spark, sf, "embeddings").select(
        "vec_id", F.when(F.expr("vec_id % 10 <> 0"), F.col("embedding")).alias("embedding")
    )
    filled = V.mean_fill_vectors(vectors, "embedding")
    return filled.select("vec_id", F.posexplode("filled").alias("idx", "x")).select(
        "vec_id", F.col("idx").cast("bigint").alias("idx"), r6("x").alias("x")
    )


@query
def linear_score(spark, sf):
    score = linear(F.col("embedding"), LINEAR_WEIGHTS, 0.25)
    return X.table(spark, sf, "embeddings").select("vec_id", r6(score).alias("score"))


# Pairs and learned scores


def _scored_pairs(spark, sf):
    """Long scores of both sides from the lengths of the answers."""
    pairs = X.chat_pairs(spark, sf)
    sides = F.array(
        *[
            F.struct(F.lit(s).alias("side"), (F.length(s) % 97 / F.lit(50.0)).alias("score"))
            for s in ("chosen", "rejected")
        ]
    )
    return pairs.select("pair_id", F.inline(sides))


@query
def pair_scores(spark, sf):
    return P.pair_scores(_scored_pairs(spark, sf))


@query
def margin_ranking_loss(spark, sf):
    losses = P.margin_losses(P.pair_scores(_scored_pairs(spark, sf)))
    return losses.select("pair_id", r6("loss").alias("loss"))


@query
def margin_loss_by_batch(spark, sf):
    losses = P.margin_loss_by_batch(P.pair_scores(_scored_pairs(spark, sf)))
    return losses.withColumn("loss", r6("loss"))


@query
def batch_score(spark, sf):
    def make_scorer():
        def scorer(prompts, answers):
            if prompts.str.contains("src1").any():
                raise ValueError("no score for this source")
            return answers.str.len() / (prompts.str.len() + answers.str.len())

        return scorer

    examples = X.sft_examples(spark, sf)
    scored = score_batches(examples, make_scorer, ["pair_id"], ["prompt", "chosen"])
    return scored.withColumn("score", r6("score"))


@query
def pairwise_ranker(spark, sf):
    pairs = X.document_pairs(spark, sf)
    ranker = K.fit_pairwise_ranker(pairs)
    return K.score_pairs(ranker, pairs).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg((F.col("margin") > 0).cast("double")).alias("accuracy"),
        F.avg("loss").alias("mean_loss"),
    )


@query
def ranker_scores(spark, sf):
    pairs = X.document_pairs(spark, sf)
    return K.score_pairs(K.fit_pairwise_ranker(pairs), pairs)


# Analyses named by the reference's documents


BOOTSTRAP_REPLICATES = 1000
BOOTSTRAP_SEED = 7


@query
def winrate_bootstrap(spark, sf):
    found = A.winrate_bootstrap(_judgements(spark, sf), BOOTSTRAP_REPLICATES, 0.95, BOOTSTRAP_SEED)
    return found.select(
        "evaluated_preferences", "ppo_wins", r6("ppo_win_rate").alias("ppo_win_rate"), "replicates", "empty_replicates",
        r6("ci_low").alias("ci_low"), r6("ci_high").alias("ci_high"), r6("std_error").alias("std_error"),
    )


def _ratings(spark, sf):
    """Three raters of the labelled documents: quality, safety, and the reward (2 or more keeps)."""
    labels = X.table(spark, sf, "labels")
    keep = lambda c: F.when(c, F.lit("keep")).when(~c, F.lit("drop"))
    quality = labels.select(F.col("doc_id").alias("item"), F.lit("quality").alias("rater"), keep(F.col("quality") == 1).alias("label"))
    safety = labels.select(F.col("doc_id").alias("item"), F.lit("safety").alias("rater"), keep(F.col("toxic") == 0).alias("label"))
    replies = X.judge_replies(spark, sf)
    reward = replies.select(F.col("prompt_id").alias("item"), F.lit("reward").alias("rater"), keep(F.col("reward") >= 2).alias("label"))
    return quality.unionByName(safety).unionByName(reward)


@query
def rater_agreement(spark, sf):
    found = A.rater_agreement(_ratings(spark, sf))
    return found.select(
        "rater_a", "rater_b", "n_items", "n_agree",
        *[r6(c).alias(c) for c in ("p_observed", "p_expected", "kappa")],
    )


@query
def rater_contingency(spark, sf):
    return A.rater_contingency(_ratings(spark, sf)).withColumn("n", F.col("n").cast("long"))


def held_out() -> Column:
    """The test side of the documents: a quarter, by the first hex digit of md5(doc_id); every row is on one side."""
    return F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 1).isin("0", "1", "2", "3")


@query
def prompt_dedup(spark, sf):
    documents = X.table(spark, sf, "documents")
    return U.prompt_dedup(documents.where(~held_out()), documents.where(held_out()), 5, 80)


@query
def response_diagnostics(spark, sf):
    found = A.response_diagnostics(X.table(spark, sf, "documents").select("doc_id", "text"), X.table(spark, sf, "labels"), 3)
    return found.select("doc_id", "n_words", "n_distinct", r6("distinct_share").alias("distinct_share"), "n_repeated",
                        r6("repeat_share").alias("repeat_share"), "toxic")


@query
def response_profile(spark, sf):
    """Per language: responses, mean words, mean shares, and the toxic share of labelled ones."""
    found = A.response_diagnostics(X.table(spark, sf, "documents").select("doc_id", "text"), X.table(spark, sf, "labels"), 3)
    langs = X.table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"))
    profile = found.join(langs, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_responses"), F.avg("n_words").alias("mean_words"),
        F.avg("distinct_share").alias("mean_distinct_share"), F.avg("repeat_share").alias("mean_repeat_share"),
        F.count("toxic").alias("n_labelled"), F.avg("toxic").alias("toxic_share"),
    )
    return profile.select("lang", "n_responses", *[r6(c).alias(c) for c in ("mean_words", "mean_distinct_share", "mean_repeat_share")],
                          "n_labelled", r6("toxic_share").alias("toxic_share"))


@query
def position_bias(spark, sf):
    forward = _judgements(spark, sf).select("prompt_id", "verdict")
    swapped = X.swapped_replies(spark, sf).select("prompt_id", parse_verdict(F.col("verdict_raw")).alias("verdict"))
    found = A.position_bias(forward, swapped)
    return found.select("n_prompts", "n_both", "n_consistent", r6("consistency").alias("consistency"),
                        r6("first_side_rate").alias("first_side_rate"), "missing_forward", "missing_swapped", "ambiguous")
