"""Operator 10, quality by supervised subword embeddings.

A document is the mean of learned vectors of its hashed words, word pairs and byte n-grams; a
softmax over that mean gives the classes. Vectors and output weights are trained together by
stochastic gradient descent in numpy, on at most ``SAMPLE`` labelled rows outside the held-out
fold. Applying the model needs one number for each bucket, since the output is linear in the
mean: the product of a bucket's vector with the difference of the two output rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import held_out, per_partition, per_slice, texts
from tallyline.llm.toxicity import labelled

SAMPLE = 4_000
BITS = 16  # buckets of each kind of feature, as a power of two
KINDS = 4
DIM = 16
FOLDS, FOLD = 4, 2
THRESHOLD = 0.7

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (h * _MIX >> np.uint64(64 - BITS)).astype(np.int64) + (kind << BITS)


def buckets(text: str) -> np.ndarray:
    """Bucket numbers of all words, word pairs and byte 3-grams and 5-grams of a whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    b = raw.astype(np.uint64)
    out = []
    for kind, n in ((0, 3), (1, 5)):
        if len(b) >= n:
            h = b[: len(b) - n + 1].copy()
            for k in range(1, n):
                h |= b[k: len(b) - n + 1 + k] << np.uint64(8 * k)
            out.append(_bucket(h, kind))
    word = raw > 32
    at = np.flatnonzero(word)
    if len(at):
        begins = np.flatnonzero(word & np.concatenate([[True], ~word[:-1]]))
        starts = np.searchsorted(at, begins)
        place = at - np.repeat(begins, np.diff(np.append(starts, len(at))))
        h = np.add.reduceat(b[at] * _power(place), starts)
        out.append(_bucket(h, 2))
        if len(h) > 1:
            out.append(_bucket(h[:-1] * _BASE + h[1:], 3))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _power(k: np.ndarray) -> np.ndarray:
    """_BASE to the powers k, modulo 2**64."""
    table = np.full(int(k.max()) + 1, _BASE, np.uint64)
    table[0] = 1
    return np.multiply.accumulate(table)[k]


class Model:
    """``weights``: a number for each bucket; a text's log-odds are their mean plus ``bias``."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def score(self, text: str) -> float:
        f = buckets(text)
        z = self.bias + (float(self.weights[f].mean(dtype=np.float64)) if len(f) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 1.0, seed: int = 7) -> Model:
    """``rows``: distinct buckets, the share of the text each makes up, and the label."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (KINDS << BITS, DIM)).astype(np.float32)
    output, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, share, y = rows[k]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = output @ hidden + bias
            p = np.exp(z - z.max())
            g = -p / p.sum()
            g[y] += 1
            back = g @ output
            output += lr * g[:, None] * hidden
            bias += 0.1 * lr * g
            if len(ids):
                # Shares are small numbers; scaling by their count gives rare features a step of use.
                vectors[ids] += (lr * min(len(ids), 200)) * share[:, None] * back
    return Model(vectors @ (output[1] - output[0]), bias[1] - bias[0])


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Features are hashed in Spark; the driver receives at most ``sample`` rows of distinct buckets."""
    def count(rows: dict) -> dict:
        made = [np.unique(buckets(t), return_counts=True) for t in rows["text"]]
        return {"label": rows["label"], "ids": [i.astype(np.int32).tobytes() for i, _ in made],
                "share": [(n / max(1, n.sum())).astype(np.float32).tobytes() for _, n in made]}

    chosen = labelled(docs, labels, "quality", FOLDS, FOLD, sample)
    rows = per_slice(chosen, "label int, ids binary, share binary", count).toLocalIterator()
    return train(sorted(((np.frombuffer(r.ids, np.int32), np.frombuffer(r.share, np.float32), int(r.label == 1)) for r in rows),
                        key=lambda r: (r[0].tobytes(), r[2])))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score (0 to 1) and predicted (1 from 0.7).

    One row for each row of ``docs``, repeated ids included; null and empty texts have no features
    and get the model's bias alone. Without labels every score is a half. Columns other than doc_id and
    text are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, sample))

    def run(slices: Iterator[dict]) -> Iterator[dict]:
        for rows in slices:
            p = [model.value.score(t) for t in rows["text"]]
            yield {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "score": p, "predicted": [int(x >= THRESHOLD) for x in p]}

    key = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "text")
    return per_partition(rows, f"doc_id {key}, held_out boolean, score double, predicted int", run)
