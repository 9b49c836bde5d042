"""Quality scores by positive-unlabelled learning: trusted positives against unlabelled web text.

No negative label is used. With positives P, unlabelled texts U, an estimated class prior and the logistic loss, the
unbiased risk of a linear machine is prior * R_P(+) + (R_U(-) - prior * R_P(-)). The bracket estimates the risk on
negatives and can only be negative by overfitting; then its gradient is followed upwards instead (the non-negative
correction). The fitted logistic function estimates the probability that a text is a positive.

The prior is estimated first: a machine that tells P from U is fitted on one half of the sample; on the other half, the
share of U above a threshold over the share of P above it bounds the prior from above. The least such ratio is found,
and its lower confidence bound taken: an estimate above the truth would end the learning of negatives early, one
slightly below it only lowers the scores of positives a little.

Features of a text are shares of hashed trigrams of character classes (letters and digits by kind, each ASCII sign by
itself) and a few shape features (repeated words, repeated lines, lengths). Neither ids, languages, sources nor
labels enter a score.

Bounds of the fit: `MAX_POSITIVES` labelled texts and `MAX_UNLABELLED` texts of the corpus, chosen by a hash of their ids.
They meet in one task as sparse features of at most `TRIGRAMS` + `SHAPES` numbers a text. Every text is scored.

Defined results: null texts are empty ones; rows that repeat an id are scored by their own text; an id with several
labels is positive only if all say so; labels without a text and null labels are ignored; without any positive label
to learn from, all scores are 0; an empty table gives an empty result; very long texts are worked on in slices;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.llm.common import id_and_text, stored, text_rows

MAX_POSITIVES, MAX_UNLABELLED = 4000, 8000
#: Number of hashed trigrams, and of shape features, the last one being constant.
TRIGRAMS, SHAPES = 1024, 8
ROUNDS, RATE, RIDGE = 400, 0.05, 1e-5
#: Bytes of a text that are hashed at a time.
SLICE = 1 << 22


def character_classes() -> np.ndarray:
    """Class of each byte: letters, capitals, digits, white space of three kinds, other bytes, each ASCII sign."""
    found = np.full(256, 6, np.uint64)
    found[:32], found[32], found[10] = 5, 3, 4
    signs = 7
    for code in range(33, 127):
        c = chr(code)
        if c.isalnum():
            found[code] = 2 if c.isdigit() else 1 if c.isupper() else 0
        else:
            found[code] = signs
            signs += 1
    return found


CLASSES = character_classes()


def features(text: str) -> np.ndarray:
    """Square roots of trigram shares, then shape features."""
    out = np.zeros(TRIGRAMS + SHAPES, np.float32)
    data = f" {text} ".encode()
    counts = np.zeros(TRIGRAMS, np.int64)
    base = np.uint64(int(CLASSES.max()) + 1)
    for at in range(0, len(data) - 2, SLICE):
        a = CLASSES[np.frombuffer(data[at : at + SLICE + 2], np.uint8)]
        code = ((a[:-2] * base + a[1:-1]) * base + a[2:]) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((code >> np.uint64(54)).astype(np.int64), minlength=TRIGRAMS)
    out[:TRIGRAMS] = np.sqrt(counts / max(1, len(data) - 2))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    again = sum(map(eq, words, words[1:]))
    shape = [
        (again / n) ** 0.5, 1 - len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)), float(again * 5 > n),
        np.log1p(n) / 10, np.log1p(len(lines)) / 10, min(len(text) / n, 30) / 10, 1.0,
    ]
    out[TRIGRAMS:] = shape
    return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class Descent:
    """Adam steps on one weight vector."""

    def __init__(self, size: int) -> None:
        self.weights = np.zeros(size)
        self.mean, self.square, self.steps = np.zeros(size), np.zeros(size), 0

    def step(self, gradient: np.ndarray) -> None:
        self.steps += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.99 * self.square + 0.01 * gradient**2
        mean, square = self.mean / (1 - 0.9**self.steps), self.square / (1 - 0.99**self.steps)
        self.weights -= RATE * mean / (np.sqrt(square) + 1e-8)


def forward(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Scores of a sample; products stay in its single precision."""
    return (x @ w.astype(x.dtype)).astype(np.float64)


def backward(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return (x.T @ slope.astype(x.dtype)).astype(np.float64) / len(x)


def non_negative_fit(pos: np.ndarray, unl: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk."""
    descent = Descent(pos.shape[1])
    for _ in range(ROUNDS):
        w = descent.weights
        score_p, score_u = forward(pos, w), forward(unl, w)
        # log(1 + e^x) is the loss of calling a text negative
        bracket = np.logaddexp(0, score_u).mean() - prior * np.logaddexp(0, score_p).mean()
        negative = backward(unl, logistic(score_u)) - prior * backward(pos, logistic(score_p))
        positive = prior * backward(pos, logistic(score_p) - 1)
        descent.step((positive + negative if bracket >= 0 else -negative) + RIDGE * w)
    return descent.weights


def plain_fit(pos: np.ndarray, unl: np.ndarray) -> np.ndarray:
    """Weights of a logistic machine that tells the two samples apart, each counting half."""
    descent = Descent(pos.shape[1])
    for _ in range(ROUNDS // 2):
        w = descent.weights
        gradient = backward(pos, logistic(forward(pos, w)) - 1) + backward(unl, logistic(forward(unl, w)))
        descent.step(gradient / 2 + RIDGE * w)
    return descent.weights


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled texts."""
    if len(pos) < 4 or len(unl) < 4:
        return 0.5
    w = plain_fit(pos[::2], unl[::2])
    score_p, score_u = np.sort(forward(pos[1::2], w)), forward(unl[1::2], w)
    best = (np.inf, 0.5)
    for share in np.arange(0.3, 1.0, 0.01):
        threshold = score_p[int((1 - share) * len(score_p))]
        above_p, above_u = (score_p >= threshold).mean(), (score_u >= threshold).mean()
        error = above_u * ((1 - above_p) / (above_p * len(score_p)) + (1 - above_u) / max(1.0, above_u * len(score_u))) ** 0.5
        best = min(best, ((above_u + error) / above_p, (above_u - 2 * error) / above_p))
    return float(min(max(best[1], 0.01), 0.99))


@dataclass
class Model:
    prior: float
    weights: np.ndarray


def sampled(rows: DataFrame, n: int) -> DataFrame:
    """About `n` rows by a hash of their ids, `n` at most; of one id with many rows, as many as fit."""
    total = rows.count()
    if total > n:
        mark = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
        rows = rows.filter(mark < int((1 << 30) * min(1.0, n / total)))
    return rows


def train(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """Fit on texts (doc_id, text) and labels (doc_id, label); None without positives.

    Positives come from `labels` alone, unlabelled texts from all of `docs`.
    """
    agreed = labels.filter("label is not null").groupBy("doc_id").agg(F.min("label").alias("least")).filter("least = 1")
    pos = sampled(docs.join(agreed.select("doc_id"), "doc_id", "left_semi"), max_positives)
    unl = sampled(docs, max_unlabelled)
    rows = pos.withColumn("kind", F.lit(1)).unionByName(unl.withColumn("kind", F.lit(0)))

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, kind in zip(*[c.to_pylist() for c in batch.columns]):
                x = features(text or "")
                at = np.flatnonzero(x).astype(np.uint16)
                out.append((kind, key, at.tobytes(), x[at].tobytes()))
            if out:
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["kind", "doc_id", "places", "vals"]
                )

    found = stored(rows.select("doc_id", "text", "kind").mapInArrow(extract, "kind int, doc_id bigint, places binary, vals binary"), "sample")

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples: dict[int, list[np.ndarray]] = {0: [], 1: []}
        most = {0: max_unlabelled, 1: max_positives}
        for batch in batches:
            for kind, _, places, vals in zip(*[c.to_pylist() for c in batch.columns]):
                if len(samples[kind]) < most[kind]:
                    x = np.zeros(TRIGRAMS + SHAPES, np.float32)
                    x[np.frombuffer(places, np.uint16)] = np.frombuffer(vals, np.float32)
                    samples[kind].append(x)
        if samples[1] and samples[0]:
            unl, pos = np.array(samples[0]), np.array(samples[1])
            prior = estimate_prior(pos, unl)
            weights = non_negative_fit(pos, unl, prior)
            yield pa.RecordBatch.from_arrays(
                [pa.array([prior]), pa.array([weights.tolist()], pa.list_(pa.float64()))], ["prior", "weights"]
            )

    # the sample is bounded: one task fits it, in an order that does not depend on its layout
    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "places", "vals", "kind")
    row = ordered.select("kind", "doc_id", "places", "vals").mapInArrow(fit, "prior double, weights array<double>").first()
    return None if row is None else Model(row.prior, np.array(row.weights))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def score(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """doc_id and score (0 to 1, higher: likelier a positive) of every row; `labels` has doc_id and the label column."""
    docs = id_and_text(df, id_col, text_col)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_col).alias("label"))
    model = train(docs, known.filter(~held_out()))
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"))
    weights = model.weights

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, scores = [], []
            for key, text in text_rows([batch]):
                keys.append(key)
                scores.append(float(logistic(np.array([features(text) @ weights]))[0]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.mapInArrow(judge, "doc_id bigint, score double")
