"""Fit a linear reward on preference pairs and score answers with it.

For a pair with features c (chosen) and r (rejected) the objective is the hinge loss of
``w.(c - r)``. It is fitted as a linear SVM on the concatenation [c; r] with label 1 and
[r; c] with label 0, without an intercept. Swapping the halves maps the training set to
itself, so the unique optimum of the regularised problem has opposite weights on the two
halves, and its margin on [c; r] is ``w.(c - r)``. Everything stays in Spark ML's
transformers: no token is shuffled and only sums of gradients reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.losses import margin_hinge
from prefspark.functions.tokens import split_tokens
from prefspark.storage import durable

FEATURES = 1 << 12


def _hash_words(df: DataFrame, text: str, name: str, features: int) -> DataFrame:
    """Add a sparse vector of hashed word presence."""
    tokens = df.withColumn("_tokens", split_tokens(F.col(text)))
    hashing = HashingTF(numFeatures=features, binary=True, inputCol="_tokens", outputCol=name)
    return hashing.transform(tokens).drop("_tokens")


def _side_by_side(df: DataFrame, left: str, right: str) -> DataFrame:
    """Add ``_features``: two vectors as one."""
    return VectorAssembler(inputCols=[left, right], outputCol="_features").transform(df)


@dataclass(frozen=True)
class PairwiseRanker:
    """Fitted weights; ``margin`` is the lead the training loss asked for."""

    model: LinearSVCModel
    features: int
    margin: float

    def score(self, df: DataFrame, text: str, name: str) -> DataFrame:
        """Add the reward of a text column: its words on one side, nothing on the other."""
        hashed = _hash_words(df, text, "_words", self.features)
        hashed = _hash_words(hashed.withColumn("_nothing", F.lit("")), "_nothing", "_blank", self.features)
        scored = self.model.transform(_side_by_side(hashed, "_words", "_blank"))
        reward = vector_to_array("_raw")[1] * F.lit(self.margin)
        return scored.withColumn(name, reward).drop(
            "_nothing", "_words", "_blank", "_features", "_raw", "prediction"
        )


def fit_pairwise_ranker(
    pairs: DataFrame,
    *,
    margin: float = D.MARGIN,
    features: int = FEATURES,
    regularisation: float = 0.01,
    iterations: int = 20,
) -> PairwiseRanker:
    """Fit on text columns ``chosen`` and ``rejected``.

    ``max(0, m - s)`` is ``m max(0, 1 - s/m)``: a margin m scales the weights of margin 1.
    """
    if margin <= 0:
        raise ValueError("margin must be positive")
    hashed = _hash_words(pairs.select("chosen", "rejected"), "chosen", "c", features)
    hashed = _hash_words(hashed, "rejected", "r", features)
    c, r = F.col("c"), F.col("r")
    orders = hashed.select(
        F.inline(
            F.array(
                F.struct(c.alias("a"), r.alias("b"), F.lit(1.0).alias("label")),
                F.struct(r.alias("a"), c.alias("b"), F.lit(0.0).alias("label")),
            )
        )
    )
    # The fit reads its input several times; words are hashed once.
    training = durable(_side_by_side(orders, "a", "b").select("_features", "label"))
    svm = LinearSVC(
        featuresCol="_features",
        labelCol="label",
        rawPredictionCol="_raw",
        fitIntercept=False,
        standardization=False,
        regParam=regularisation,
        maxIter=iterations,
    )
    return PairwiseRanker(svm.fit(training), features, float(margin))


def score_pairs(ranker: PairwiseRanker, pairs: DataFrame) -> DataFrame:
    """Rewards of both answers, their difference and the margin loss."""
    scored = ranker.score(pairs, "chosen", "chosen_score")
    scored = ranker.score(scored, "rejected", "rejected_score")
    lead = F.col("chosen_score") - F.col("rejected_score")
    return scored.select(
        "pair_id",
        "chosen_score",
        "rejected_score",
        lead.alias("margin"),
        margin_hinge(F.col("chosen_score"), F.col("rejected_score"), ranker.margin).alias("loss"),
    )
