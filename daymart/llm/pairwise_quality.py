"""Quality scores learnt from preference pairs (Bradley-Terry).

A labelled good text is preferred to a labelled bad one.  The score of a text is linear in features of its
characters, words and lines; its weights minimise the logistic loss of score differences over pairs.  The score that
separates good from bad is a quantile of the scores: the one below which the share of bad labels lies.

Only the fit is sampled: ``rows_per_class`` labelled rows of each class, first in the order of a hash of the
id, and ``pairs`` pairs of them.  Scoring reads every text, in one pass without a shuffle.

Defined results: a NULL text scores as the empty one; a document with contradicting labels teaches nothing;
labels other than 0 and 1 are ignored; without both classes every score is 0.5; repeated rows score alike; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import extended

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SHAPE = 10
N_FEATURES = SHAPE + len(PUNCTUATION)


def features(text: str | None) -> np.ndarray:
    """Shares and rates of a whole text; none of them grows with its length but the logarithm of the length."""
    raw = (text or "").encode()
    out = np.zeros(N_FEATURES)
    if not raw:
        return out
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, capitals, small = max(len(words), 1), seen[65:91].sum(), seen[97:123].sum() + seen[128:].sum()
    pairs = max(n - 1, 1)
    out[:SHAPE] = (
        np.log1p(len(words)),
        capitals / max(capitals + small, 1),
        seen[48:58].sum() / len(raw),
        (capitals + small) / len(raw),
        min(len(raw) / n, 40.0) / 10.0,
        len(set(words)) / n,
        len(set(zip(words, words[1:]))) / pairs,
        sum(a == b for a, b in zip(words, words[1:])) / pairs,
        1 - len(set(lines)) / max(len(lines), 1),
        1.0,
    )
    out[SHAPE:] = np.sqrt(seen[list(PUNCTUATION)] / n)
    return out


@dataclass(frozen=True)
class Ranker:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.centre) / self.spread) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(rows) - self.threshold, -30, 30)))


def learn(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int = 40_000, ridge: float = 1e-2, rounds: int = 25) -> Ranker:
    """Newton steps on the mean logistic loss of score differences, with a ridge penalty."""
    rows = np.vstack([good, bad])
    blank = Ranker(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    if not len(good) or not len(bad):
        return blank
    centre, spread = rows.mean(0), rows.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    draw = np.random.default_rng(7)
    a = (good[draw.integers(0, len(good), pairs)] - bad[draw.integers(0, len(bad), pairs)]) / spread
    weights = np.zeros(N_FEATURES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(a @ weights, -30, 30)))  # probability of the wrong order
        slope = ridge * weights - a.T @ p / pairs
        curve = ridge * np.eye(N_FEATURES) + (a * (p * (1 - p))[:, None]).T @ a / pairs
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-6:
            break
    model = Ranker(centre, spread, weights, 0.0)
    scores = model.raw(rows)
    weight = np.repeat([(1 - bad_share) / len(good), bad_share / len(bad)], [len(good), len(bad)])
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(weight[order])
    at = min(int(np.searchsorted(below, bad_share, side="right")), len(rows) - 1)
    threshold = (scores[order[max(at - 1, 0)]] + scores[order[at]]) / 2
    return Ranker(centre, spread, weights, float(threshold))


def featurised(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    frame = docs.select(*keep, F.col(f"`{text}`").alias("_text"))
    schema = extended(frame.select(*keep).schema, "features array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(rows, pa.list_(pa.float64()))], [*keep, "features"]
            )

    return frame.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "label", rows_per_class: int = 4_000) -> Ranker:
    """``labels`` has ``id`` and ``label`` (0 or 1); at most ``2 * rows_per_class`` feature rows reach the driver."""
    known = (
        labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return learn(np.zeros((0, N_FEATURES)), np.zeros((0, N_FEATURES)), 0.5)
    order = [F.xxhash64("id"), F.col("id")]
    chosen = known.filter("label = 0").orderBy(*order).limit(rows_per_class).unionByName(
        known.filter("label = 1").orderBy(*order).limit(rows_per_class)
    ).select("id", "label")
    # Of the texts of a repeated id one, so that the bound on rows holds.
    texts = docs.select(F.col(id).alias("id"), F.col(f"`{text}`").alias("text")).join(chosen, "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted((r["id"], r["label"], list(r["features"])) for r in featurised(texts, "text", "id", "label").collect())
    side = {k: np.array([r[2] for r in rows if r[1] == k]).reshape(-1, N_FEATURES) for k in (0, 1)}
    return learn(side[1], side[0], counts[0] / (counts[0] + counts[1]))


def scored(docs: DataFrame, model: Ranker, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) of every row."""
    frame = docs.select(F.col(id), F.col(f"`{text}`").alias("_text"))
    schema = extended(frame.select(id).schema, "score double, predicted int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t) for t in batch.column("_text").to_pylist()]).reshape(-1, N_FEATURES)
            score = model.score(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [id, "score", "predicted"]
            )

    return frame.mapInArrow(run, schema)
