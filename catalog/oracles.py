"""The same results in plain SQL over the same tables, with positions and windows."""

from __future__ import annotations

from catalog.queries import STOP_BELOW, STOP_EVERY
from prefspark import defaults as D

_WORDS = r"'[ \t\n\x0B\f\r]+'"
_SPACES = " || ".join(f"chr({ord(c)})" for c in D.WHITESPACE)
_SPECIALS = ", ".join(f"'{t}'" for t in D.SPECIAL_TOKENS)


def _r6(value: str) -> str:
    return f"CASE WHEN round({value}, 6) = 0 THEN 0.0::DOUBLE ELSE round({value}, 6) END"


def _strip(text: str) -> str:
    return f"trim({text}, {_SPACES})"


def _list_text(items: str) -> str:
    return f"array_to_string({items}, ',')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, {_WORDS}), lambda t: t <> '')"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


# Chats

_CHAT_PAIRS = """
chat_pairs AS (
  SELECT conv_id AS pair_id,
         arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt,
         arg_max(text, turn) FILTER (WHERE role = 'assistant') AS chosen,
         arg_min(text, turn) FILTER (WHERE role = 'assistant') AS rejected
  FROM conversations GROUP BY conv_id
  HAVING count(*) FILTER (WHERE role = 'assistant') >= 2
)
"""
_USABLE = _CHAT_PAIRS + ", usable AS (SELECT * FROM chat_pairs WHERE pair_id % 7 IN (0, 1, 2))"

_FINAL = """
final AS (
  SELECT conv_id,
         coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant' AND text <> ''),
                  nullif(arg_max(text, turn), '')) AS response
  FROM conversations GROUP BY conv_id
)
"""


def _prompt_text(prompt: str) -> str:
    return f"'[CLS] [BOS] ' || {_strip(prompt)} || ' [SEP] [BOS]'"


def _response_text(response: str) -> str:
    return f"' [assistant]: ' || {response} || ' <|endoftext|> [SEP]'"


ORACLES: dict[str, str] = {
    "preference_examples": _with(_USABLE, select="SELECT pair_id, prompt, chosen, rejected FROM usable"),
    "limit_examples": _with(
        _CHAT_PAIRS,
        select="SELECT pair_id, prompt, chosen, rejected FROM chat_pairs ORDER BY pair_id LIMIT 20",
    ),
    "evaluation_prompts": """
SELECT conv_id AS prompt_id, arg_min(text, turn) AS prompt
FROM conversations WHERE role = 'user' AND conv_id % 10 <> 0 GROUP BY conv_id""",
    "final_response": _with(_FINAL, select="SELECT conv_id, response FROM final"),
    "invalid_responses": _with(
        _CHAT_PAIRS,
        select="""
SELECT pair_id, CASE WHEN pair_id % 7 IN (3, 4) THEN 'empty'
                     WHEN pair_id % 7 = 5 THEN 'no_content' ELSE 'null_prompt' END AS reason
FROM chat_pairs WHERE pair_id % 7 NOT IN (0, 1, 2)""",
    ),
    "response_fallback": _with(
        _FINAL,
        select=f"""
SELECT conv_id, CASE WHEN conv_id % 3 = 1 AND response <> '' THEN response
                     ELSE '{D.EMPTY_ANSWER}' END AS response
FROM final""",
    ),
    "strip_text": f"SELECT doc_id, {_strip('text')} AS text FROM documents",
    "format_prompts": _with(
        _CHAT_PAIRS, select=f"SELECT pair_id, {_prompt_text('prompt')} AS prompt_text FROM chat_pairs"
    ),
    "format_responses": _with(
        _CHAT_PAIRS,
        select=f"SELECT pair_id, {_response_text('chosen')} AS response_text FROM chat_pairs",
    ),
    "sft_examples": _with(
        _USABLE,
        select=f"""
SELECT pair_id, {_prompt_text('prompt')} AS prompt_text, {_response_text('chosen')} AS response_text
FROM usable""",
    ),
    "assemble_conversations": """
SELECT conv_id, turn // 1024 AS part, count(*) AS n_turns,
       string_agg(turn || ':' || role || ':' || text, chr(10) ORDER BY turn) AS messages
FROM conversations GROUP BY conv_id, turn // 1024""",
}

# Judge evaluation

_JUDGED = """
replies AS (
  SELECT doc_id AS prompt_id,
         ['A', ' b ', 'tie', NULL, 'B', 'a', 'B.', chr(9) || 'B' || chr(10)][doc_id % 8 + 1] AS verdict_raw,
         ['4', ' 3.5 ', 'nan', '5.5', 'four', '4d', NULL, '1', '5.0', '0.99', '2e0'][doc_id % 11 + 1] AS score_raw,
         CASE WHEN doc_id % 13 <> 0 THEN quality + 1.5::DOUBLE - toxic END AS reward
  FROM labels
), judged AS (
  SELECT prompt_id, reward,
         CASE WHEN upper(trim(verdict_raw, ' ' || chr(9) || chr(10))) IN ('A', 'B')
              THEN upper(trim(verdict_raw, ' ' || chr(9) || chr(10))) END AS verdict,
         CASE WHEN TRY_CAST(trim(score_raw) AS DOUBLE) BETWEEN 1 AND 5
              THEN TRY_CAST(trim(score_raw) AS DOUBLE) END AS judge_score
  FROM replies
)
"""
_ERRORS = _JUDGED + """, errors AS (
  SELECT prompt_id, judge_score, reward, abs(judge_score - reward) AS abs_error
  FROM judged WHERE verdict IS NOT NULL AND judge_score IS NOT NULL AND reward IS NOT NULL
)"""
_ANSWERS = """
answers AS (
  SELECT doc_id AS prompt_id, 'Write about ' || source || ' in ' || lang AS prompt,
         text AS sft_answer, text || ' ' || lang AS ppo_answer
  FROM documents WHERE doc_id % 7 <> 0
)
"""
_WINS = """
count(*) FILTER (WHERE verdict = 'A') AS sft_wins, count(*) FILTER (WHERE verdict = 'B') AS ppo_wins"""
_SKIPPED = """
count(*) FILTER (WHERE verdict IS NULL) AS skipped_preferences,
count(*) FILTER (WHERE verdict IS NOT NULL AND (judge_score IS NULL OR reward IS NULL)) AS skipped_scores"""
_RATE = """CASE WHEN count(verdict) = 0 THEN 0.0
ELSE count(*) FILTER (WHERE verdict = 'B')::DOUBLE / count(verdict) END"""
_ERROR = "CASE WHEN verdict IS NOT NULL THEN abs(judge_score - reward) END"
_SUMMARY = f"""
SELECT {_WINS}, {_SKIPPED}, count({_ERROR}) AS n_errors, {_r6(f'avg({_ERROR})')} AS mean_error,
       count(verdict) AS evaluated_preferences, {_r6(f'({_RATE})')} AS ppo_win_rate
FROM """

# Every document gets both requests; only the paired table lacks the second answer of a seventh.
_ALL_ANSWERS = _ANSWERS.replace(" WHERE doc_id % 7 <> 0", "")

ORACLES |= {
    "judge_requests": _with(
        _ALL_ANSWERS,
        select=f"""
SELECT prompt_id, 'preference' AS kind, '{D.PREFERENCE_SYSTEM}' AS system,
       concat('Question:', chr(10), prompt, chr(10), chr(10), 'Answer A:', chr(10), sft_answer,
              chr(10), chr(10), 'Answer B:', chr(10), ppo_answer, chr(10), chr(10),
              '{D.PREFERENCE_CLOSING}') AS user
FROM answers
UNION ALL
SELECT prompt_id, 'rating', '{D.RATING_SYSTEM}',
       concat('Question:', chr(10), prompt, chr(10), chr(10), 'Answer:', chr(10), ppo_answer,
              chr(10), chr(10), '{D.RATING_CLOSING}')
FROM answers""",
    ),
    "parse_verdicts": _with(_JUDGED, select="SELECT prompt_id, verdict FROM judged"),
    "parse_scores": _with(_JUDGED, select="SELECT prompt_id, judge_score FROM judged"),
    "paired_answers": _with(
        _ANSWERS,
        _JUDGED,
        select="""
SELECT prompt_id, prompt, sft_answer, ppo_answer, verdict, judge_score, reward
FROM answers LEFT JOIN judged USING (prompt_id)""",
    ),
    "policy_comparison": _with(
        _ANSWERS, _JUDGED, select=_SUMMARY + "answers LEFT JOIN judged USING (prompt_id)"
    ),
    "win_counts": _with(_JUDGED, select=f"SELECT {_WINS} FROM judged"),
    "skipped_counts": _with(_JUDGED, select=f"SELECT {_SKIPPED} FROM judged"),
    "win_rate": _with(
        _JUDGED,
        select=f"""
SELECT count(verdict) AS evaluated_preferences, {_r6(f'({_RATE})')} AS ppo_win_rate FROM judged""",
    ),
    "reward_judge_errors": _with(
        _ERRORS,
        select=f"SELECT prompt_id, judge_score, reward, {_r6('abs_error')} AS abs_error FROM errors",
    ),
    "error_list": _with(
        _ERRORS,
        select=f"""
SELECT row_number() OVER (ORDER BY prompt_id) - 1 AS sample, prompt_id, {_r6('abs_error')} AS abs_error
FROM errors""",
    ),
    "error_profile": _with(
        _ERRORS,
        select=f"""
SELECT count(*) AS n_errors, {_r6('avg(abs_error)')} AS mean_error, {_r6('min(abs_error)')} AS min_error,
       {_r6('max(abs_error)')} AS max_error, {_r6('stddev_pop(abs_error)')} AS std_error
FROM errors""",
    ),
    "evaluation_summary": _with(_JUDGED, select=_SUMMARY + "judged"),
}

# Rollouts

_ROLLOUTS = """
rollouts AS (
  SELECT user_id AS rollout_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         event_id % 1000 AS token_id,
         -(4 + event_id % 13) * 0.1::DOUBLE AS old_lp,
         -(4 + event_id % 13) * 0.1::DOUBLE + (event_id % 7 - 3) * 0.1::DOUBLE AS lp,
         -(4 + event_id % 13) * 0.1::DOUBLE - (event_id % 5 - 2) * 0.02::DOUBLE AS ref_lp,
         (event_id % 11 - 5) * 0.1::DOUBLE AS val,
         (event_id % 11 - 5) * 0.1::DOUBLE + (event_id % 3 - 1) * 0.05::DOUBLE AS new_val,
         1 + user_id % 8 AS prompt_length
  FROM events
)
"""
_DRIFT = f"-{D.KL_COEFFICIENT}::DOUBLE * (old_lp - ref_lp)"
_SCORED = _ROLLOUTS + f""", rewarded AS (
  SELECT *, (rollout_id % 9 - 4)::DOUBLE AS terminal_reward,
         {_DRIFT} + CASE WHEN lead(pos) OVER (PARTITION BY rollout_id ORDER BY pos) IS NULL
                         THEN rollout_id % 9 - 4 ELSE 0 END AS token_reward
  FROM rollouts WHERE pos >= prompt_length - 1
), returned AS (
  SELECT *, sum(token_reward) OVER (PARTITION BY rollout_id ORDER BY pos
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ret
  FROM rewarded
), scored AS (
  SELECT *, CASE WHEN count(*) OVER w > 1
                 THEN (ret - val - avg(ret - val) OVER w) / (stddev_pop(ret - val) OVER w + 1e-8)
                 ELSE ret - val END AS advantage
  FROM returned WINDOW w AS (PARTITION BY rollout_id)
), weighed AS (
  SELECT *, least(exp(lp - old_lp) * advantage,
                  greatest(least(exp(lp - old_lp), 1.2::DOUBLE), 0.8::DOUBLE) * advantage) AS surrogate
  FROM scored
)"""
_LATE = _ROLLOUTS + """, generated AS (
  SELECT rollout_id, count(*) AS n_tokens,
         count(*) FILTER (WHERE pos >= 40 + rollout_id % 60 - 1) AS n_generated
  FROM rollouts GROUP BY rollout_id
)"""
_POLICY = _r6("-avg(surrogate)")
_VALUE = _r6("avg((new_val - ret) * (new_val - ret))")

ORACLES |= {
    "align_reference": _with(
        _ROLLOUTS,
        select=f"""
SELECT rollout_id, pos, {_r6('old_lp')} AS old_lp, {_r6('ref_lp')} AS ref_lp
FROM rollouts WHERE token_id % 10 <> 3""",
    ),
    "unmatched_tokens": _with(
        _ROLLOUTS, select="SELECT rollout_id, pos, token_id FROM rollouts WHERE token_id % 10 = 3"
    ),
    "response_tokens": _with(
        _ROLLOUTS, select="SELECT rollout_id, pos, token_id FROM rollouts WHERE pos >= prompt_length - 1"
    ),
    "nonempty_rollouts": _with(_LATE, select="SELECT * FROM generated WHERE n_generated > 0"),
    "skipped_rollouts": _with(
        _LATE,
        select="""
SELECT count(*) FILTER (WHERE n_generated > 0) AS n_kept,
       count(*) FILTER (WHERE n_generated = 0) AS n_skipped
FROM generated""",
    ),
    "kl_token_rewards": _with(
        _ROLLOUTS, select=f"SELECT rollout_id, pos, {_r6(_DRIFT)} AS token_reward FROM rollouts"
    ),
    "terminal_rewards": _with(
        _ROLLOUTS,
        f"""ended AS (
  SELECT rollout_id, pos, {_DRIFT} + CASE WHEN pos = max(pos) OVER (PARTITION BY rollout_id)
         THEN rollout_id % 9 - 4 ELSE 0 END AS token_reward
  FROM rollouts)""",
        select=f"SELECT rollout_id, pos, {_r6('token_reward')} AS token_reward FROM ended",
    ),
    "returns_to_go": _with(
        _ROLLOUTS,
        f"""summed AS (
  SELECT rollout_id, pos, sum({_DRIFT}) OVER (PARTITION BY rollout_id ORDER BY pos
         ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ret
  FROM rollouts)""",
        select=f"SELECT rollout_id, pos, {_r6('ret')} AS ret FROM summed",
    ),
    "normalized_advantages": _with(
        _SCORED,
        select=f"SELECT rollout_id, pos, {_r6('ret')} AS ret, {_r6('advantage')} AS advantage FROM scored",
    ),
    "next_token_alignment": _with(
        _ROLLOUTS,
        """paired AS (
  SELECT *, lead(token_id) OVER (PARTITION BY rollout_id ORDER BY pos) AS next_token_id FROM rollouts)""",
        select=f"""
SELECT rollout_id, pos, token_id, next_token_id, {_r6('val')} AS val
FROM paired WHERE next_token_id IS NOT NULL""",
    ),
    "clipped_surrogate": _with(
        _SCORED, select=f"SELECT rollout_id, pos, {_r6('surrogate')} AS surrogate FROM weighed"
    ),
    "policy_loss": _with(
        _SCORED, select=f"SELECT rollout_id, {_POLICY} AS policy_loss FROM weighed GROUP BY rollout_id"
    ),
    "value_loss": _with(
        _SCORED, select=f"SELECT rollout_id, {_VALUE} AS value_loss FROM weighed GROUP BY rollout_id"
    ),
    "rollout_metrics": _with(
        _SCORED,
        select=f"""
SELECT rollout_id, count(*) AS n_tokens, max(terminal_reward) AS terminal_reward,
       {_POLICY} AS policy_loss, {_VALUE} AS value_loss,
       {_r6(f'(-avg(surrogate) + {D.VALUE_COEFFICIENT}::DOUBLE * avg((new_val - ret) * (new_val - ret)))')} AS loss
FROM weighed GROUP BY rollout_id""",
    ),
    "sft_cross_entropy": _with(
        _ROLLOUTS,
        select=f"""
SELECT rollout_id // 4 AS batch_id, count(*) AS n_supervised, {_r6('-avg(lp)')} AS loss
FROM rollouts WHERE pos >= prompt_length GROUP BY rollout_id // 4""",
    ),
}

# Batches and token sequences

_VOCABULARY = f"""
vocabulary AS (
  SELECT token, (5 + row_number() OVER (ORDER BY n DESC, token))::INTEGER AS id, n, FALSE AS special
  FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest({_words('text')}) AS token FROM documents)
    WHERE token NOT IN ({_SPECIALS}) GROUP BY token 
  )
  UNION ALL
  SELECT * FROM (VALUES {", ".join(f"('{t}', {i}::INTEGER, 0::BIGINT, TRUE)" for i, t in enumerate(D.SPECIAL_TOKENS))})
)
"""


def _coded(name: str, table: str, key: str, text: str) -> str:
    """CTE ``name(key, ids)``: the words of a text as a list of ids."""
    return f"""
{name} AS (
  SELECT s.{key}, coalesce(list(coalesce(v.id, {D.UNK_ID}) ORDER BY s.pos)
                           FILTER (WHERE s.token IS NOT NULL), []) AS ids
  FROM (SELECT {key}, unnest({_words(text)}) AS token,
               generate_subscripts({_words(text)}, 1) AS pos FROM {table}) s
  LEFT JOIN vocabulary v ON v.token = s.token GROUP BY s.{key}
)"""


_DOC_IDS = _VOCABULARY + "," + _coded("coded", "documents", "doc_id", "text")
_MAX = 128
_ENCODED = f"""{_VOCABULARY}, examples AS (
  SELECT doc_id AS pair_id, {_prompt_text("'Write about ' || source || ' in ' || lang")} AS prompt_text,
         {_response_text('text')} AS response_text
  FROM documents JOIN labels USING (doc_id) WHERE quality = 1
), {_coded('prompts', 'examples', 'pair_id', 'prompt_text')},
{_coded('responses', 'examples', 'pair_id', 'response_text')},
encoded AS (
  SELECT pair_id, p.ids[1:{_MAX} - least({_MAX // 2}, len(r.ids))] AS prompt_ids,
         r.ids[1:{_MAX // 2}] AS response_ids
  FROM prompts p JOIN responses r USING (pair_id)
), labelled AS (
  SELECT pair_id, prompt_ids || response_ids AS input_ids,
         list_transform(prompt_ids, lambda x: -100) || response_ids AS labels
  FROM encoded
)"""
_PAIRED = f"""{_VOCABULARY}, {_CHAT_PAIRS}, {_coded('prompts', 'chat_pairs', 'pair_id', 'prompt')},
{_coded('answers', 'chat_pairs', 'pair_id', 'chosen')},
cut AS (
  SELECT pair_id, least(len(p.ids), greatest(22, 44 - len(a.ids))) AS keep,
         p.ids AS prompt_ids, a.ids AS answer_ids
  FROM prompts p JOIN answers a USING (pair_id)
), pairs AS (
  SELECT pair_id, prompt_ids[1:keep] AS prompt_ids, answer_ids[1:44 - keep] AS answer_ids,
         (row_number() OVER (ORDER BY pair_id) - 1) // 4 AS batch_id
  FROM cut
), widths AS (
  SELECT *, len(prompt_ids) + len(answer_ids) + 4 AS length,
         max(len(prompt_ids) + len(answer_ids) + 4) OVER (PARTITION BY batch_id) AS width
  FROM pairs
)"""


def _padded(items: str, pad: int, width: str = "width") -> str:
    padding = f"list_transform(range({width} - len({items})), lambda x: {pad})"
    return _list_text(f"({items} || {padding})")


_MASK = _list_text(
    "list_transform(range(length), lambda x: 1) || list_transform(range(width - length), lambda x: 0)"
)

ORACLES |= {
    "batch_assign": """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS ordinal,
       (row_number() OVER (ORDER BY doc_id) - 1) // 4 AS batch_id
FROM documents""",
    "build_vocabulary": _with(_VOCABULARY, select="SELECT token, id, n, special FROM vocabulary"),
    "encode_tokens": _with(
        _DOC_IDS,
        select=f"""
SELECT doc_id, len(ids) AS n_tokens, len(list_filter(ids, lambda x: x = {D.UNK_ID})) AS n_unknown,
       {_list_text('ids')} AS ids
FROM coded""",
    ),
    "decode_tokens": _with(
        _VOCABULARY,
        f"""known AS (
  SELECT doc_id, string_agg(v.token, ' ' ORDER BY pos) AS text
  FROM (SELECT doc_id, unnest({_words('text')}) AS token,
               generate_subscripts({_words('text')}, 1) AS pos FROM documents) s
  JOIN vocabulary v ON v.token = s.token AND NOT v.special GROUP BY doc_id)""",
        select=f"""
SELECT d.doc_id, coalesce({_strip('k.text')}, '') AS text
FROM documents d LEFT JOIN known k ON k.doc_id = d.doc_id""",
    ),
    "truncate_at_stop": _with(
        _DOC_IDS,
        f"""stopped AS (
  SELECT doc_id, ids, greatest(0, least(128, 1024 - (870 + doc_id % 160))) AS room,
         list_position(list_transform(ids, lambda x: x % {STOP_EVERY} = 0 AND x > 0 AND x < {STOP_BELOW}), TRUE) AS hit
  FROM coded)""",
        f"""kept AS (
  SELECT doc_id, ids[1:CASE WHEN hit > 0 THEN least(hit, room) ELSE room END] AS ids FROM stopped)""",
        select=f"SELECT doc_id, len(ids) AS n_kept, {_list_text('ids')} AS ids FROM kept",
    ),
    "sft_truncate": _with(
        _ENCODED,
        select=f"""
SELECT pair_id, {_list_text('prompt_ids')} AS prompt_ids, {_list_text('response_ids')} AS response_ids
FROM encoded""",
    ),
    "sft_label_mask": _with(
        _ENCODED,
        select=f"""
SELECT pair_id, {_list_text('input_ids')} AS input_ids, {_list_text('labels')} AS labels FROM labelled""",
    ),
    "sft_padded_batches": _with(
        _ENCODED,
        """batched AS (
  SELECT *, (row_number() OVER (ORDER BY pair_id) - 1) // 4 AS batch_id, len(input_ids) AS length
  FROM labelled)""",
        "wide AS (SELECT *, max(length) OVER (PARTITION BY batch_id) AS width FROM batched)",
        select=f"""
SELECT batch_id, pair_id, width, {_padded('input_ids', D.PAD_ID)} AS input_ids,
       {_MASK} AS attention_mask, {_padded('labels', D.IGNORE_LABEL)} AS labels
FROM wide""",
    ),
    "supervised_token_counts": _with(
        _ENCODED,
        select="""
SELECT pair_id, len(list_filter(labels[2:], lambda x: x <> -100)) AS n_supervised FROM labelled""",
    ),
    "pair_truncate": _with(
        _PAIRED,
        select=f"""
SELECT batch_id, pair_id, len(prompt_ids) AS prompt_length, len(answer_ids) AS answer_length, width,
       {_padded("([1] || prompt_ids || [2, 2] || answer_ids || [2])", D.PAD_ID)} AS input_ids,
       {_MASK} AS attention_mask
FROM widths""",
    ),
}

# Distributions and vectors

_LOGITS = """
logits AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS idx,
         unnest(embedding)::DOUBLE AS x
  FROM embeddings
)
"""
_LOG_PROBS = _LOGITS + """, log_probs AS (
  SELECT vec_id, label, idx,
         x - max(x) OVER w - ln(sum(exp(x - top)) OVER w) AS log_prob
  FROM (SELECT *, max(x) OVER (PARTITION BY vec_id) AS top FROM logits)
  WINDOW w AS (PARTITION BY vec_id)
)"""
_PROBS = _LOGITS + f""", ranked AS (
  SELECT vec_id, idx, x / {D.TEMPERATURE}::DOUBLE AS z,
         rank() OVER (PARTITION BY vec_id ORDER BY x DESC) <= {D.TOP_K} AS kept
  FROM logits
), raised AS (
  SELECT vec_id, idx, CASE WHEN kept THEN exp(z - max(z) OVER (PARTITION BY vec_id)) ELSE 0.0 END AS e
  FROM ranked
), probs AS (
  SELECT vec_id, idx, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM raised
)"""
_UNIFORM = f"""(('0x' || substr(md5('{D.SEED}|' || vec_id || '|' || idx), 1, 8))::UBIGINT + 0.5) / 4294967296"""

ORACLES |= {
    "log_softmax": _with(
        _LOG_PROBS, select=f"SELECT vec_id, idx, {_r6('log_prob')} AS log_prob FROM log_probs"
    ),
    "gather_target_logprob": _with(
        _LOG_PROBS,
        select=f"SELECT vec_id, {_r6('log_prob')} AS log_prob FROM log_probs WHERE idx = label",
    ),
    "topk_with_ties": _with(
        _LOGITS,
        """ranked AS (
  SELECT vec_id, idx, floor(x * 16) AS logit,
         rank() OVER (PARTITION BY vec_id ORDER BY floor(x * 16) DESC) AS place
  FROM logits)""",
        select="SELECT vec_id, idx, logit FROM ranked WHERE place <= 10",
    ),
    "topk_softmax": _with(_PROBS, select=f"SELECT vec_id, idx, {_r6('p')} AS p FROM probs"),
    "sample_per_group": _with(
        _PROBS,
        select=f"""
SELECT vec_id, arg_max(idx, ln(p) - ln(-ln({_UNIFORM}))) AS idx FROM probs WHERE p > 0 GROUP BY vec_id""",
    ),
    "greedy_per_group": _with(
        _LOGITS, select="SELECT vec_id, arg_max(idx, (x, -idx)) AS idx FROM logits GROUP BY vec_id"
    ),
    "masked_mean_pool": _with(
        _LOGITS,
        select=f"""
SELECT label, count(*) FILTER (WHERE vec_id % 3 <> 0) AS n_vectors, idx,
       {_r6('sum(CASE WHEN vec_id % 3 <> 0 THEN x ELSE 0 END) / greatest(count(*) FILTER (WHERE vec_id % 3 <> 0), 1e-9)')} AS pooled
FROM logits GROUP BY label, idx""",
    ),
    "mean_fill_vectors": _with(
        _LOGITS,
        "means AS (SELECT idx, avg(x) AS mean FROM logits WHERE vec_id % 10 <> 0 GROUP BY idx)",
        select=f"""
SELECT vec_id, idx, {_r6('CASE WHEN vec_id % 10 <> 0 THEN x ELSE mean END')} AS x
FROM logits JOIN means USING (idx)""",
    ),
    "linear_score": _with(
        _LOGITS,
        select=f"""
SELECT vec_id, {_r6('(sum(x * (((idx * 7) % 11 - 5) / 10.0::DOUBLE)) + 0.25)')} AS score
FROM logits GROUP BY vec_id""",
    ),
}

# Pairs

_PAIR_SCORES = _CHAT_PAIRS + """, scores AS (
  SELECT pair_id, length(chosen) % 97 / 50.0::DOUBLE AS chosen,
         length(rejected) % 97 / 50.0::DOUBLE AS rejected
  FROM chat_pairs
), losses AS (
  SELECT pair_id, greatest(0.0, 1.0 - (chosen - rejected)) AS loss FROM scores
)"""

ORACLES |= {
    "pair_scores": _with(_PAIR_SCORES, select="SELECT pair_id, chosen, rejected FROM scores"),
    "margin_ranking_loss": _with(_PAIR_SCORES, select=f"SELECT pair_id, {_r6('loss')} AS loss FROM losses"),
    "margin_loss_by_batch": _with(
        _PAIR_SCORES,
        "batched AS (SELECT (row_number() OVER (ORDER BY pair_id) - 1) // 4 AS batch_id, loss FROM losses)",
        select=f"SELECT batch_id, count(*) AS n_pairs, {_r6('avg(loss)')} AS loss FROM batched GROUP BY batch_id",
    ),
    "batch_score": f"""
SELECT doc_id AS pair_id,
       CASE WHEN source NOT LIKE '%src1%' THEN
       {_r6("length(text) / (length(text) + length('Write about ' || source || ' in ' || lang))::DOUBLE")}
       END AS score
FROM documents JOIN labels USING (doc_id) WHERE quality = 1""",
}


# Analyses named by the reference's documents

_WEIGHT = "CASE WHEN u >= 0.36787944117144233 THEN 1 ELSE 0 END + CASE WHEN u >= 0.7357588823428847 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9196986029286058 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9810118431238463 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9963401531726563 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9994058151824183 THEN 1 ELSE 0 END + CASE WHEN u >= 0.999916758850712 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999897508033253 THEN 1 ELSE 0 END + CASE WHEN u >= 0.999998874797402 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999998885745216 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999899522336 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999991683892 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999364022 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999954802 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999997 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999999813 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999999989 THEN 1 ELSE 0 END + CASE WHEN u >= 0.9999999999999999 THEN 1 ELSE 0 END"

ORACLES |= {
    "winrate_bootstrap": _with(
        _JUDGED,
        """valid AS (
  SELECT coalesce(CAST(prompt_id AS VARCHAR), '') AS key, CAST(verdict = 'B' AS INT) AS win FROM judged WHERE verdict IN ('A', 'B')
), per_prompt AS (
  SELECT key, count(*) AS n, sum(win) AS wins FROM valid GROUP BY key
), drawn AS (
  SELECT key, n, wins, unnest(range(0, 1000)) AS r FROM per_prompt
), uniform AS (
  SELECT r, n, wins, CAST(('0x' || substr(md5('7:' || key || ':' || CAST(r AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS u
  FROM drawn
), sums AS (
  SELECT r, sum(w * n) AS n, sum(w * wins) AS wins FROM (SELECT r, n, wins, """ + _WEIGHT + """ AS w FROM uniform) GROUP BY r
), rates AS (
  SELECT CASE WHEN n > 0 THEN wins / n END AS rate FROM sums
), spread AS (
  SELECT 1000 - count(rate) AS empty_replicates, quantile_cont(rate, [0.025, 0.975]) AS ends, stddev_samp(rate) AS std_error FROM rates
), point AS (
  SELECT count(*) AS evaluated_preferences, CAST(coalesce(sum(win), 0) AS BIGINT) AS ppo_wins FROM valid
)""",
        select=f"""
SELECT evaluated_preferences, ppo_wins,
       {_r6('CASE WHEN evaluated_preferences > 0 THEN ppo_wins / evaluated_preferences END')} AS ppo_win_rate,
       CAST(1000 AS BIGINT) AS replicates, CAST(empty_replicates AS BIGINT) AS empty_replicates,
       {_r6('ends[1]')} AS ci_low, {_r6('ends[2]')} AS ci_high, {_r6('std_error')} AS std_error
FROM point, spread""",
    ),
}

_RATINGS = """
ratings AS (
  SELECT doc_id AS item, 'quality' AS rater, CASE WHEN quality = 1 THEN 'keep' WHEN quality IS NOT NULL THEN 'drop' END AS label FROM labels
  UNION ALL SELECT doc_id, 'safety', CASE WHEN toxic = 0 THEN 'keep' WHEN toxic IS NOT NULL THEN 'drop' END FROM labels
  UNION ALL SELECT doc_id, 'reward', CASE WHEN doc_id % 13 <> 0 THEN CASE WHEN quality + 1.5 - toxic >= 2 THEN 'keep' WHEN quality + 1.5 - toxic IS NOT NULL THEN 'drop' END END FROM labels
), once AS (
  SELECT item, rater, min(label) AS label FROM ratings WHERE item IS NOT NULL AND label IS NOT NULL
  GROUP BY item, rater HAVING min(label) = max(label)
), cells AS (
  SELECT a.rater AS rater_a, b.rater AS rater_b, a.label AS label_a, b.label AS label_b, count(*) AS n
  FROM once a JOIN once b ON a.item = b.item AND a.rater < b.rater GROUP BY ALL
)"""

ORACLES |= {
    "rater_contingency": _with(_RATINGS, select="SELECT rater_a, rater_b, label_a, label_b, CAST(n AS BIGINT) AS n FROM cells"),
    "rater_agreement": _with(
        _RATINGS,
        """totals AS (
  SELECT rater_a, rater_b, sum(n) AS n_items, sum(CASE WHEN label_a = label_b THEN n ELSE 0 END) AS n_agree FROM cells GROUP BY ALL
), chance AS (
  SELECT r.rater_a, r.rater_b, sum(row_n * col_n) AS expected
  FROM (SELECT rater_a, rater_b, label_a AS label, sum(n) AS row_n FROM cells GROUP BY ALL) r
  JOIN (SELECT rater_a, rater_b, label_b AS label, sum(n) AS col_n FROM cells GROUP BY ALL) c USING (rater_a, rater_b, label)
  GROUP BY ALL
), p AS (
  SELECT rater_a, rater_b, n_items, n_agree, n_agree / n_items AS p_o, coalesce(expected, 0) / (n_items * n_items) AS p_e
  FROM totals LEFT JOIN chance USING (rater_a, rater_b)
)""",
        select=f"""
SELECT rater_a, rater_b, CAST(n_items AS BIGINT) AS n_items, CAST(n_agree AS BIGINT) AS n_agree,
       {_r6('p_o')} AS p_observed, {_r6('p_e')} AS p_expected,
       {_r6('CASE WHEN p_e >= 1 THEN 1.0 ELSE (p_o - p_e) / (1 - p_e) END')} AS kappa
FROM p""",
    ),
}

_SIDES = """
docs AS (
  SELECT doc_id, lower(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS norm,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 1) IN ('0', '1', '2', '3') AS test
  FROM documents
), texts AS (
  SELECT norm, list_filter(string_split(norm, ' '), lambda w: w <> '') AS w FROM (SELECT DISTINCT norm FROM docs)
), sets AS (
  SELECT norm, list_distinct(list_transform(range(1, greatest(len(w) - 5 + 1, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS s
  FROM texts WHERE len(w) > 0
), tok AS (
  SELECT norm, len(s) AS n, unnest(s) AS token FROM sets
), train_texts AS (
  SELECT norm, count(*) AS copies, min(doc_id) AS least_id FROM docs WHERE NOT test GROUP BY norm
), pairs AS (
  SELECT a.norm AS train_norm, b.norm AS test_norm
  FROM tok a JOIN tok b USING (token)
  WHERE a.norm IN (SELECT norm FROM train_texts) AND b.norm IN (SELECT norm FROM docs WHERE test)
  GROUP BY a.norm, b.norm, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), near AS (
  SELECT test_norm AS norm, sum(copies) AS n_near, min(least_id) AS near_id FROM pairs JOIN train_texts ON train_texts.norm = pairs.train_norm GROUP BY test_norm
)"""

ORACLES |= {
    "prompt_dedup": _with(
        _SIDES,
        select="""
SELECT d.doc_id, CAST(coalesce(t.copies, 0) AS BIGINT) AS n_exact, CAST(coalesce(n.n_near, 0) AS BIGINT) AS n_near,
       least(t.least_id, n.near_id) AS first_train_id, coalesce(t.copies, 0) + coalesce(n.n_near, 0) > 0 AS contaminated
FROM docs d LEFT JOIN train_texts t USING (norm) LEFT JOIN near n USING (norm) WHERE d.test""",
    ),
}

_DIAGNOSED = """
w AS (
  SELECT doc_id, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
), g AS (
  SELECT doc_id, lang, w, CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' ')) ELSE [] END AS g FROM w
), tox AS (
  SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, len(w) AS n_words, len(list_distinct(w)) AS n_distinct, len(g) AS n_grams,
         len(g) - len(list_distinct(g)) AS n_repeated, toxic
  FROM g LEFT JOIN tox USING (doc_id)
)"""

ORACLES |= {
    "response_diagnostics": _with(
        _DIAGNOSED,
        select=f"""
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_distinct AS BIGINT) AS n_distinct,
       {_r6('CASE WHEN n_words > 0 THEN n_distinct / n_words END')} AS distinct_share, CAST(n_repeated AS BIGINT) AS n_repeated,
       {_r6('CASE WHEN n_grams > 0 THEN n_repeated / n_grams END')} AS repeat_share, CAST(toxic AS INTEGER) AS toxic
FROM d""",
    ),
    "response_profile": _with(
        _DIAGNOSED,
        select=f"""
SELECT lang, count(*) AS n_responses, {_r6('avg(n_words)')} AS mean_words,
       {_r6('avg(CASE WHEN n_words > 0 THEN n_distinct / n_words END)')} AS mean_distinct_share,
       {_r6('avg(CASE WHEN n_grams > 0 THEN n_repeated / n_grams END)')} AS mean_repeat_share,
       count(toxic) AS n_labelled, {_r6('avg(toxic)')} AS toxic_share
FROM d GROUP BY lang""",
    ),
    "position_bias": _with(
        _JUDGED,
        """swapped AS (
  SELECT doc_id AS prompt_id,
         CASE WHEN upper(trim(v, ' ' || chr(9) || chr(10))) IN ('A', 'B') THEN upper(trim(v, ' ' || chr(9) || chr(10))) END AS verdict
  FROM (SELECT doc_id, ['B', 'A', ' a ', NULL, 'A', 'b', 'x', 'A', 'B'][(doc_id * 3 + quality) % 9 + 1] AS v FROM labels)
), fo AS (
  SELECT prompt_id, min(verdict) AS f, count(DISTINCT verdict) > 1 AS af FROM judged WHERE verdict IN ('A', 'B') GROUP BY prompt_id
), so AS (
  SELECT prompt_id, min(verdict) AS s, count(DISTINCT verdict) > 1 AS as_ FROM swapped WHERE verdict IN ('A', 'B') GROUP BY prompt_id
), both_ AS (
  SELECT CASE WHEN NOT af THEN f END AS f, CASE WHEN NOT as_ THEN s END AS s, coalesce(af, false) OR coalesce(as_, false) AS amb
  FROM fo FULL JOIN so USING (prompt_id)
)""",
        select=f"""
SELECT count(*) FILTER (WHERE f IS NOT NULL OR s IS NOT NULL) AS n_prompts,
       count(*) FILTER (WHERE f IS NOT NULL AND s IS NOT NULL) AS n_both,
       count(*) FILTER (WHERE f <> s) AS n_consistent,
       {_r6('CASE WHEN count(*) FILTER (WHERE f IS NOT NULL AND s IS NOT NULL) > 0 THEN (count(*) FILTER (WHERE f <> s)) / (count(*) FILTER (WHERE f IS NOT NULL AND s IS NOT NULL)) END')} AS consistency,
       {_r6("CASE WHEN count(f) + count(s) > 0 THEN (count(*) FILTER (WHERE f = 'A') + count(*) FILTER (WHERE s = 'A')) / (count(f) + count(s)) END")} AS first_side_rate,
       count(*) FILTER (WHERE f IS NULL AND s IS NOT NULL) AS missing_forward,
       count(*) FILTER (WHERE s IS NULL AND f IS NOT NULL) AS missing_swapped,
       count(*) FILTER (WHERE amb) AS ambiguous
FROM both_""",
    ),
}
