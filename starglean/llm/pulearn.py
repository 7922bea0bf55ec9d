"""Toxicity by non-negative positive-unlabelled learning.

Features are the distinct words of a text and their beginnings (stems carry
insults through their endings), hashed to ``FEATURES`` places.  A linear
classifier is trained with numpy on confirmed toxic texts and unlabelled texts
under the risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss; where the second term is negative, the step goes
against it, which keeps the classifier from fitting single positives.
The class prior is the toxic share of the labelled training rows.  Only features
whose rate differs between both samples by ``LEAST_Z`` standard errors take part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, map_batches, spread, words

FEATURES = 1 << 20
STEMS = (4, 5)
FOLDS = 5
#: Bounds of the training sample: confirmed toxic texts, unlabelled texts.
POSITIVES = 6_000
UNLABELLED = 16_000
STEPS = 500
LEAST_Z = 4.0
RATE = 0.05
DECAY = 3e-5
SEED = 8


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    prior: float


def features(text: Column) -> Column:
    def places(found: Column) -> Column:
        whole = F.transform(found, lambda w: F.xxhash64(w))
        stems = [F.transform(found, lambda w, n=n: F.xxhash64(F.lit(n), F.substring(w, 1, n))) for n in STEMS]
        return F.array_distinct(F.transform(F.concat(whole, *stems), lambda h: F.pmod(h, F.lit(FEATURES)).cast("int")))

    return let(F.array_distinct(words(text)), places)


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(rows: DataFrame, most: int, total: int) -> DataFrame:
    """About ``most`` of ``total`` rows by a hash of their id, never more."""
    if total > most:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) < int((1 << 30) * 0.95 * most / total))
    return rows.limit(most)


def pack(lists: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values side by side and the bounds of each list."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if not len(lists):
        return np.empty(0, np.int32), np.zeros(1, np.int64)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.to_numpy()[bounds[0] : bounds[-1]], bounds - bounds[0]


def margins(flat: np.ndarray, bounds: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[flat])])
    return total[bounds[1:]] - total[bounds[:-1]] + bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def fit(positive: pa.Array | None, unlabelled: pa.Array | None, prior: float) -> Model:
    """Non-negative PU training; without positives or unlabelled texts everything scores 0."""
    none = Model(np.zeros(FEATURES), -30.0, prior)
    if positive is None or not len(positive) or not len(unlabelled) or prior <= 0:
        return none
    p_flat, p_bounds = pack(positive)
    u_flat, u_bounds = pack(unlabelled)
    chosen = informative(p_flat, len(positive), u_flat, len(unlabelled))
    place = np.full(FEATURES, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)
    p_flat, p_bounds = renamed(p_flat, p_bounds, place)
    u_flat, u_bounds = renamed(u_flat, u_bounds, place)
    size = len(chosen)
    weights, bias = np.zeros(size), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    p_rows, u_rows = np.diff(p_bounds), np.diff(u_bounds)
    n_p, n_u = len(positive), len(unlabelled)
    for step in range(1, STEPS + 1):
        gp, gu = margins(p_flat, p_bounds, weights, bias), margins(u_flat, u_bounds, weights, bias)
        unlabelled_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if unlabelled_risk >= 0:
            dp = prior * (-sigmoid(-gp) - sigmoid(gp)) / n_p
            du = sigmoid(gu) / n_u
        else:
            dp = prior * sigmoid(gp) / n_p
            du = -sigmoid(gu) / n_u
        slope = np.bincount(p_flat, np.repeat(dp, p_rows), size) + np.bincount(u_flat, np.repeat(du, u_rows), size)
        slope = np.append(slope + DECAY * weights, dp.sum() + du.sum())
        mean += 0.1 * (slope - mean)
        square += 0.001 * (slope * slope - square)
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        bias -= float(move[-1])
    every = np.zeros(FEATURES)
    every[chosen] = weights
    return Model(every, bias, prior)


def informative(p_flat: np.ndarray, n_p: int, u_flat: np.ndarray, n_u: int) -> np.ndarray:
    """Features whose rates among positive and unlabelled texts clearly differ."""
    in_p, in_u = occurrences(p_flat), occurrences(u_flat)
    rate = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / n_p + 1 / n_u))
    return np.flatnonzero((np.abs(in_p / n_p - in_u / n_u) >= LEAST_Z * error) & (in_p + in_u > 2))


def occurrences(flat: np.ndarray) -> np.ndarray:
    """How often each feature is listed; in slices, since counting widens what it counts."""
    total = np.zeros(FEATURES, np.int64)
    for at in range(0, len(flat), FEATURES):
        total += np.bincount(flat[at : at + FEATURES], minlength=FEATURES)
    return total


def renamed(flat: np.ndarray, bounds: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with only the features that have a place."""
    new = place[flat]
    there = new >= 0
    kept = np.zeros(len(flat) + 1, np.int32 if len(flat) < 1 << 31 else np.int64)
    np.cumsum(there, out=kept[1:])
    return new[there], kept[bounds].astype(np.int64)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows outside the held-out fold, and from texts without their labels.

    ``labels`` rows with a null id or a null ``toxic`` say nothing; where rows
    of one id differ, it counts as toxic if one says so.
    """
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")))
    rows, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not rows:
        return fit(None, None, 0.0)
    texts = docs.select("doc_id", "text").filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    total = texts.count()
    positive = sample(known.filter("toxic = 1").select("doc_id"), POSITIVES, toxic)
    positive = texts.join(F.broadcast(positive), "doc_id").select(features(F.col("text")).alias("f")).limit(POSITIVES).toArrow().column("f")
    unlabelled = sample(texts, UNLABELLED, total).select(features(F.col("text")).alias("f")).toArrow().column("f")
    return fit(positive, unlabelled, toxic / rows)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; text alone decides.

    Null text counts as empty and gets the score of a text without words.
    Repeated rows and null ids are scored like all others; an id that is null
    is not held out.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float64), model.bias))

    def make():
        weights, bias = shared.value

        def work(batch: pa.RecordBatch):
            result = sigmoid(margins(*pack(batch.column(2)), weights, bias))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(result), pa.array((result >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

        return work

    prepared = spread(docs.select("doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), features(F.col("text")).alias("f"))
    return map_batches(prepared, make, "doc_id bigint, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic; all their columns stay."""
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    @F.arrow_udf("double")
    def toxicity(found: pa.Array) -> pa.Array:
        return pa.array(sigmoid(margins(*pack(found), *shared.value)))

    return docs.filter(toxicity(features(F.col("text"))) < 0.5)
