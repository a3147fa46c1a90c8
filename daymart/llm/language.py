"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the average of the embeddings of its byte 2-, 3- and 4-grams, hashed into a fixed number of buckets; a
linear layer and a softmax turn it into probabilities.  Plain stochastic gradient descent in numpy fits both on a
sample of different texts of every labelled language, chosen by a hash of the text: about ``rows_per_language`` of each, and fewer
where that would be more than ``rows_in_all``.  A fifth of the sample calibrates: a temperature for the probabilities and the lowest
score at which predictions are right with probability ``precision``; below it ``accepted`` is false.

Since averaging and the layer are linear, scoring needs one logit per bucket and language only.

Defined results: a NULL text or one without any letter is ``und`` with score 0, not accepted; texts without a label
teach nothing; without any labelled text everything is ``und``; repeated rows are predicted alike; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import extended

BUCKETS = 1 << 13
WIDTH = 16
BROADCAST_LANGUAGES = 100_000
_LETTERS = np.full(256, 32, np.uint32)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_MIX = np.uint32(2654435761)


def subwords(text: str) -> np.ndarray:
    """How often each bucket occurs, over the whole text; what is not a letter counts as a word's border."""
    raw = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)]
    counts = np.zeros(BUCKETS, np.int64)
    grams = raw
    for size in (2, 3, 4):
        if len(grams) < 2:
            break
        grams = grams[:-1] * np.uint32(257) + raw[size - 1 :]
        counts += np.bincount((grams * _MIX) >> np.uint32(19), minlength=BUCKETS)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Identifier:
    languages: list[str]
    logits: np.ndarray  # bucket x language
    bias: np.ndarray
    accept_from: float

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return "und", 0.0, False
        counts = subwords(text)
        z = counts @ self.logits / max(counts.sum(), 1) + self.bias
        p = np.exp(z - z.max())
        best = int(p.argmax())
        score = float(p[best] / p.sum())
        return self.languages[best], score, score >= self.accept_from


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[str], precision: float = 0.99, epochs: int = 12, rate: float = 0.5, batch: int = 32) -> Identifier:
    """``rows``: the buckets of each text and their shares."""
    languages = sorted(set(labels))
    if not languages:
        return Identifier([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    y = np.array([languages.index(x) for x in labels])
    draw = np.random.default_rng(11)
    order = draw.permutation(len(rows))
    check, train = order[: len(rows) // 5], order[len(rows) // 5 :]
    embed = draw.normal(0, 1 / WIDTH, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)

    def dense(which: np.ndarray) -> np.ndarray:
        x = np.zeros((len(which), BUCKETS), np.float32)
        for i, k in enumerate(which):
            x[i, rows[k][0]] = rows[k][1]
        return x

    for epoch in range(epochs):
        speed = rate * (1 - epoch / epochs)
        train = draw.permutation(train)
        for start in range(0, len(train), batch):
            which = train[start : start + batch]
            x = dense(which)
            hidden = x @ embed
            slope = _softmax(hidden @ layer + bias)
            slope[np.arange(len(which)), y[which]] -= 1
            back = slope @ layer.T
            layer -= speed * hidden.T @ slope
            bias -= speed * slope.mean(0)
            # Shares are about one in a thousand, so their gradients are scaled up to the size of the others.
            embed -= speed * 20 * (x.T @ back)
    table = embed @ layer
    shown = check if len(check) else train
    z = np.vstack([dense(shown[i : i + 256]) @ table + bias for i in range(0, len(shown), 256)])
    truth = y[shown]
    sharpness = min(
        np.geomspace(0.1, 5.0, 30), key=lambda s: -np.log(_softmax(z * s)[np.arange(len(truth)), truth] + 1e-12).mean()
    )
    p = _softmax(z * sharpness)
    best, right = p.max(1), p.argmax(1) == truth
    down = np.argsort(-best, kind="stable")
    good = np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= precision
    accept_from = float(best[down[np.flatnonzero(good)[-1]]]) if good.any() else 1.0
    return Identifier(languages, table * np.float32(sharpness), bias * np.float32(sharpness), accept_from)


def _sample_rows(frame: DataFrame) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [subwords(t) for t in batch.column("text").to_pylist()]
            where = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("label"),
                    pa.array([w.astype(np.uint16).tobytes() for w in where]),
                    pa.array([(c[w] / c.sum()).astype(np.float32).tobytes() for c, w in zip(counts, where)]),
                ],
                ["id", "label", "at", "share"],
            )

    found = frame.mapInArrow(run, extended(frame.select("id", "label").schema, "at binary, share binary")).collect()
    return sorted(found, key=lambda r: (str(r["id"]), r["label"], bytes(r["at"])))


def fit(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    rows_per_language: int = 1_000,
    rows_in_all: int = 200_000,
    precision: float = 0.99,
) -> Identifier:
    """Learn from the rows with a label and a letter; a text that repeats teaches a language once."""
    labelled = docs.select(F.col(f"`{text}`").alias("text"), F.col(label).alias("label")).filter(F.col("label").isNotNull())
    counts = labelled.groupBy("label").agg(F.count("*").alias("_n"))
    languages = counts.count()
    share = min(rows_per_language, rows_in_all / max(languages, 1))
    counts = F.broadcast(counts) if languages <= BROADCAST_LANGUAGES else counts  # a label and a number each
    known = labelled.filter(F.col("text").rlike("\\p{L}")).withColumn("id", F.xxhash64("text"))
    drawn = known.join(counts, "label").filter(F.pmod("id", F.lit(1_000_000)) < F.lit(1e6 * share) / F.col("_n"))
    rows = _sample_rows(drawn.drop("_n").dropDuplicates(["label", "id"]))
    return learn(
        [(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["share"], np.float32)) for r in rows],
        [r["label"] for r in rows],
        precision,
    )


def identified(docs: DataFrame, model: Identifier, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``lang_pred``, ``score`` and ``accepted`` of every row."""
    frame = docs.select(F.col(id), F.col(f"`{text}`").alias("_text"))
    schema = extended(frame.select(id).schema, "lang_pred string, score double, accepted boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                    pa.array([x[2] for x in found], pa.bool_()),
                ],
                [id, "lang_pred", "score", "accepted"],
            )

    return frame.mapInArrow(run, schema)
