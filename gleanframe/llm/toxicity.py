"""Toxicity by non-negative positive-unlabelled learning.

Positives are texts confirmed as toxic; all other texts are unlabelled, never negative. A
linear model in numpy is trained on the risk ``prior * R(positive as 1) + max(0, R(unlabelled
as 0) - prior * R(positive as 0))``: the prior takes out the toxic texts hidden among the
unlabelled ones, and where the second part falls below zero the step goes against it instead.
Several models are trained, each in a Spark task on a sample of its own, and averaged.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.base import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = 1 << 18
#: Bounds of a model's sample: confirmed texts and unlabelled texts.
MAX_POSITIVE = 1500
MAX_UNLABELLED = 3000
MODELS = 3
STEM = 5
#: A feature is used if this share of the positives has it, and by this log ratio more often than the unlabelled.
MIN_SHARE = 0.02
MIN_LOG_RATIO = 0.3
_LETTERS = re.compile(r"[^\W\d_]+").findall


def features(text: str | None) -> np.ndarray:
    """Hashed distinct words of the whole text and the first letters of its longer words; sorted."""
    seen = set(_LETTERS(text.lower())) if text else set()
    seen |= {w[:STEM] + "*" for w in seen if len(w) > STEM}
    return np.unique(np.array([zlib.crc32(w.encode()) % FEATURES for w in seen], np.int32))


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Features that enough positives have, and that they have far more often than unlabelled texts."""
    p, u = (np.bincount(np.concatenate(rows), minlength=FEATURES) for rows in (positive, unlabelled))
    ratio = np.log((p + 0.5) / (len(positive) + 1)) - np.log((u + 0.5) / (len(unlabelled) + 1))
    return (p >= max(3, MIN_SHARE * len(positive))) & (ratio > MIN_LOG_RATIO)


def border(p: np.ndarray, u: np.ndarray, prior: float) -> float:
    """The margin with the least non-negative risk of wrong labels; the middle of the widest best stretch."""
    edges = np.unique(np.concatenate([p, u]))
    missed = np.searchsorted(np.sort(p), edges, "right") / len(p)
    taken = 1 - np.searchsorted(np.sort(u), edges, "right") / len(u)
    risk = prior * missed + np.maximum(0, taken - prior * (1 - missed))
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    gaps = np.append(edges[1:], edges[-1] + 1) - edges
    at = best[np.argmax(gaps[best])]
    return float(edges[at] + gaps[at] / 2)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, seed: int, epochs: int = 25) -> np.ndarray:
    """Weights of the features, and last the bias. Without positives or unlabelled texts: the prior alone."""
    weights = np.zeros(FEATURES + 1)
    weights[-1] = np.log(prior / (1 - prior))
    if not positive or not unlabelled:
        return weights
    use = telling(positive, unlabelled)
    positive, unlabelled = ([x[use[x]] for x in side] for side in (positive, unlabelled))
    rng = np.random.default_rng(seed)
    step, squares = 0.05, np.full(FEATURES + 1, 1e-6)
    sizes = (max(1, 64 * len(positive) // (len(positive) + len(unlabelled))), 64)
    for _ in range(epochs):
        order_p, order_u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
        for at in range(0, len(unlabelled), sizes[1]):
            chosen_p = rng.choice(order_p, min(len(order_p), max(16, sizes[0])), replace=False)
            sides = []
            for texts, chosen in ((positive, chosen_p), (unlabelled, order_u[at : at + sizes[1]])):
                rows = [texts[i] for i in chosen]
                lengths = np.array([len(r) for r in rows])
                flat = np.concatenate(rows) if lengths.sum() else np.zeros(0, np.int32)
                owner = np.repeat(np.arange(len(rows)), lengths)
                margin = np.bincount(owner, weights[flat], len(rows)) + weights[-1]
                sides.append((flat, owner, 1 / (1 + np.exp(-np.clip(margin, -30, 30)))))
            (flat_p, owner_p, p), (flat_u, owner_u, u) = sides
            # log loss of label 0 is -log(1 - s), its slope s; of label 1 it is -log(s), its slope s - 1
            hidden = -np.log1p(-u + 1e-12).mean() + prior * np.log1p(-p + 1e-12).mean()
            if hidden < 0:
                slope_p, slope_u = prior * p / len(p), -u / len(u)
            else:
                slope_p, slope_u = prior * ((p - 1) - p) / len(p), u / len(u)
            gradient = np.bincount(flat_p, slope_p[owner_p], FEATURES + 1) + np.bincount(flat_u, slope_u[owner_u], FEATURES + 1)
            gradient[-1] += slope_p.sum() + slope_u.sum()
            touched = np.flatnonzero(gradient)
            squares[touched] += gradient[touched] ** 2
            weights[touched] -= step * gradient[touched] / np.sqrt(squares[touched])
    margins = [np.array([weights[x].sum() for x in side]) for side in (positive, unlabelled)]
    weights[-1] = -border(*margins, prior)
    return weights


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


class ToxicityModel:
    """Averaged weights; ``score`` is a column expression."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def score(self, text: Column) -> Column:
        """0 to 1; a null text scores as an empty one."""
        weights = self.weights.astype(np.float64)

        @F.arrow_udf("double")
        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                margins = np.array([weights[features(t.as_py())].sum() + weights[-1] for t in texts], float)
                yield pa.array(1 / (1 + np.exp(-np.clip(margins, -50, 50))))

        return run(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    models: int = MODELS,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Each of ``models`` learners takes at most ``max_positive`` confirmed texts and
    ``max_unlabelled`` others, chosen by a hash of the id, from ids outside fold 0. The prior
    is the toxic share among the labelled ids outside fold 0. Null ids are in no fold and
    train nothing; null labels count as unlabelled. An id labelled more than once is toxic if
    any of its labels is, and of an id in more than one row one text counts. Without positives
    every text scores the prior of 0.5 %.
    """
    known = labels.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.select(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(0.5, max(0.005, toxic / n if n else 0.0))
    positive = known.where("toxic = 1").select("doc_id", F.lit(1).alias("positive"))
    others = docs.where(fold(F.col("doc_id")) != 0).select("doc_id").distinct()
    picks = None
    for k in range(models):
        draw = F.xxhash64("doc_id", F.lit(k))
        own = positive.orderBy(draw).limit(max_positive)
        rest = others.orderBy(draw).limit(max_unlabelled).select("doc_id", F.lit(0).alias("positive"))
        both = own.unionByName(rest).withColumn("model", F.lit(k))
        picks = both if picks is None else picks.unionByName(both)
    # at most models * (max_positive + max_unlabelled) ids
    picks = stored(picks, "toxicity-sample")

    @F.arrow_udf("array<int>")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()).astype(np.int32) for t in texts], pa.list_(pa.int32()))

    texts = docs.select("doc_id", "text").join(F.broadcast(picks.select("doc_id").distinct()), "doc_id", "left_semi")
    # one text of an id, however many rows it stands in
    texts = texts.groupBy("doc_id").agg(F.max("text").alias("text"))
    sample = picks.join(texts.select("doc_id", hashed(F.col("text")).alias("x")), "doc_id")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "positive"])
        sides = [[np.asarray(x, np.int32) for x in rows.x[rows.positive == side]] for side in (1, 0)]
        weights = train(*sides, prior, int(rows.model.iloc[0]))
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()]})

    trained = sample.groupBy("model").applyInPandas(learn, "weights binary").collect()  # one row for each model
    if not trained or not toxic:
        return ToxicityModel(train([], [], prior, 0))
    return ToxicityModel(np.mean([np.frombuffer(row.weights, np.float32) for row in trained], axis=0))
