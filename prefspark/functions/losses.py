"""Per-row terms of the training objectives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark import defaults as D


def clipped_surrogate(
    log_prob: Column, old_log_prob: Column, advantage: Column, epsilon: float = D.CLIP_EPSILON
) -> Column:
    """Smaller of the plain and the clipped ratio times the advantage."""
    ratio = F.exp(log_prob - old_log_prob)
    clipped = F.least(F.greatest(ratio, F.lit(1.0 - epsilon)), F.lit(1.0 + epsilon))
    return F.least(ratio * advantage, clipped * advantage)


def drift_penalty(
    old_log_prob: Column, reference_log_prob: Column, beta: float = D.KL_COEFFICIENT
) -> Column:
    """Reward of one token for staying close to the frozen reference."""
    return F.lit(-beta) * (old_log_prob - reference_log_prob)


def margin_hinge(chosen: Column, rejected: Column, margin: float = D.MARGIN) -> Column:
    """Loss of a pair whose chosen score does not lead by ``margin``."""
    return F.greatest(F.lit(0.0), F.lit(float(margin)) - (chosen - rejected))


def linear_score(vector: Column, weights: Sequence[float], bias: float = 0.0) -> Column:
    """Dot product with fixed weights plus a bias; null if the lengths differ."""
    products = F.zip_with(
        vector.cast("array<double>"), F.lit([float(w) for w in weights]), lambda x, w: x * w
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x) + F.lit(float(bias))
