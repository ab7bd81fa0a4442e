"""Log-softmax, top-k, sampling and greedy choice on one ``ARRAY`` of logits per row.

A distribution is one row, so none of this shuffles and no group can grow beyond a row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.binding import let

_SPAN = float(2**32)


def check_sampling(temperature: float, top_k: int) -> None:
    if temperature <= 0:
        raise ValueError("temperature must be positive")
    if top_k < 1:
        raise ValueError("top_k must be at least 1 when sampling")


def _doubles(values: Column) -> Column:
    return values.cast("array<double>")


def _log_sum_exp(values: Column) -> Column:
    """Log of the sum of exponentials, with the maximum taken out so that none overflows."""
    return let(
        F.array_max(values),
        lambda top: top
        + F.ln(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))),
    )


def log_softmax(logits: Column) -> Column:
    return let(
        _doubles(logits),
        lambda xs: let(_log_sum_exp(xs), lambda norm: F.transform(xs, lambda x: x - norm)),
    )


def target_log_prob(logits: Column, target: Column) -> Column:
    """Log-probability of the element at zero-based ``target``; null outside the array."""
    return let(_doubles(logits), lambda xs: F.get(xs, target) - _log_sum_exp(xs))


def top_k_logits(logits: Column, k: int = D.TOP_K) -> Column:
    """Logits with null for everything below the k-th largest; ties with it stay."""
    if k < 1:
        raise ValueError("top_k must be at least 1 when sampling")
    return let(
        _doubles(logits),
        lambda xs: let(
            F.get(F.sort_array(xs, asc=False), F.least(F.lit(k), F.size(xs)) - 1),
            lambda bar: F.transform(xs, lambda x: F.when(x >= bar, x)),
        ),
    )


def top_k_softmax(
    logits: Column, temperature: float = D.TEMPERATURE, k: int = D.TOP_K
) -> Column:
    """Probabilities over the kept candidates, 0 for the others."""
    check_sampling(temperature, k)
    scaled = F.transform(_doubles(logits), lambda x: x / F.lit(float(temperature)))
    return let(
        top_k_logits(scaled, k),
        lambda xs: let(
            F.filter(xs, lambda x: x.isNotNull()),
            lambda kept: let(
                _log_sum_exp(kept),
                lambda norm: F.transform(xs, lambda x: F.coalesce(F.exp(x - norm), F.lit(0.0))),
            ),
        ),
    )


def hashed_uniform(seed: int, group: Column, index: Column) -> Column:
    """Number in (0, 1) that depends on nothing but seed, group and index.

    It is the same for every partitioning, task retry and engine with md5.
    """
    digest = F.md5(
        F.concat_ws("|", F.lit(str(seed)), group.cast("string"), index.cast("string")).cast(
            "binary"
        )
    )
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(_SPAN)


def sample_index(probabilities: Column, group: Column, seed: int = D.SEED) -> Column:
    """Zero-based index drawn with the given probabilities.

    Gumbel-max: log p plus independent Gumbel noise is largest at i with probability p_i.
    """
    return let(
        F.transform(
            probabilities,
            lambda p, i: F.when(
                p > 0, F.ln(p) - F.ln(-F.ln(hashed_uniform(seed, group, i)))
            ),
        ),
        lambda scores: F.array_position(scores, F.array_max(scores)) - 1,
    )


def greedy_index(logits: Column) -> Column:
    """Zero-based index of the largest logit, the lowest one on a tie."""
    return F.array_position(logits, F.array_max(logits)) - 1
