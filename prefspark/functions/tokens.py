"""Token-sequence arithmetic on ``ARRAY<INT>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.binding import let


def split_tokens(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than ASCII whitespace."""
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda t: t != "")


def check_max_length(max_length: int, least: int = 1) -> None:
    if max_length < least:
        raise ValueError(f"max_length must be at least {least}")


def truncate_for_sft(
    prompt_ids: Column, response_ids: Column, max_length: int = D.MAX_LENGTH
) -> tuple[Column, Column]:
    """Heads of prompt and response that share ``max_length`` positions.

    The response is cut first, to half the budget, so that a long prompt cannot push it
    out; the prompt gets what is left.
    """
    check_max_length(max_length)
    response = F.slice(response_ids, 1, max(1, max_length // 2))
    prompt = F.slice(prompt_ids, F.lit(1), F.lit(max_length) - F.size(response))
    return prompt, response


def mask_prompt(prompt_ids: Column, response_ids: Column) -> tuple[Column, Column]:
    """Input ids, and labels that ignore the prompt."""
    ids = F.concat(prompt_ids, response_ids)
    labels = F.concat(F.array_repeat(F.lit(D.IGNORE_LABEL), F.size(prompt_ids)), response_ids)
    return ids, labels


def pad_right(ids: Column, width: Column, pad: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad), (width - F.size(ids)).cast("int")))


def attention_mask(length: Column, width: Column) -> Column:
    """1 for each real position, 0 for each padded one."""
    return F.concat(
        F.array_repeat(F.lit(1), length.cast("int")),
        F.array_repeat(F.lit(0), (width - length).cast("int")),
    )


def next_token_labels(labels: Column) -> Column:
    """Labels moved by one: position t is judged on the token at t + 1."""
    return F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))


def supervised_count(labels: Column) -> Column:
    """Number of positions that carry loss after the shift."""
    return F.size(F.filter(next_token_labels(labels), lambda x: x != D.IGNORE_LABEL))


def pair_lengths(
    prompt_length: Column, answer_length: Column, max_length: int = D.MAX_LENGTH
) -> tuple[Column, Column]:
    """Lengths after longest-first truncation of a pair with four special positions.

    Trimming one token at a time from the longer side (the answer on a tie) ends here:
    each side keeps half the room, and room one side leaves free goes to the other.
    """
    check_max_length(max_length, 4)
    room = max_length - 4
    prompt = F.least(prompt_length, F.greatest(F.lit((room + 1) // 2), F.lit(room) - answer_length))
    return prompt, F.least(answer_length, F.lit(room) - prompt)


def truncate_pair(
    prompt_ids: Column, answer_ids: Column, max_length: int = D.MAX_LENGTH
) -> tuple[Column, Column]:
    keep_prompt, keep_answer = pair_lengths(F.size(prompt_ids), F.size(answer_ids), max_length)
    return F.slice(prompt_ids, F.lit(1), keep_prompt), F.slice(answer_ids, F.lit(1), keep_answer)


def truncate_at_stop(
    ids: Column,
    prompt_length: Column,
    stop_ids: Sequence[int],
    max_new_tokens: int = D.MAX_NEW_TOKENS,
    context_limit: int = D.CONTEXT_LIMIT,
) -> Column:
    """Generated ids up to the first stop id (kept), the token limit and the context limit."""
    room = F.greatest(
        F.lit(0), F.least(F.lit(max_new_tokens), F.lit(context_limit) - prompt_length)
    ).cast("int")
    stops = F.lit([int(s) for s in stop_ids]).cast("array<int>")
    hit = F.array_position(F.transform(ids, lambda x: F.array_contains(stops, x)), True)
    return let(
        hit.cast("int"),
        lambda h: F.slice(ids, F.lit(1), F.when(h > 0, F.least(h, room)).otherwise(room)),
    )


def response_slice(values: Column, prompt_length: Column) -> Column:
    """Token statistics that belong to the response.

    Statistics start one position before the response, since each predicts the next token.
    """
    return F.slice(values, F.greatest(prompt_length, F.lit(1)).cast("int"), F.size(values))
