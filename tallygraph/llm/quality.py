"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by what its bytes and words look like,
a gate tells how much each passage has to say about its document, and the document is scored on
the weighted sum of its passages. Only document labels are known; passage weights are learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.labelled import remainder, sample
from tallygraph.llm.text import SPACE, byte_prefix, joined, slices, span_hash, words
from tallygraph.session import table

PASSAGE_WORDS = 64
HIDDEN = 24
ROUNDS = 150
THRESHOLD = 0.3

# Kinds of bytes: upper, lower, digit, space, line feed, sentence mark, other mark, non-ASCII.
_KIND = np.full(256, 6, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 0, 1, 2, 7
_KIND[[32, 9, 11, 12, 13]] = 3
_KIND[10] = 4
_KIND[[ord(c) for c in ".,;:'\"-()?"]] = 5
KINDS = 8
FEATURES = KINDS * KINDS + 6


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Document and features of every passage of 64 words; a text without words is one passage."""
    data, bounds = joined(texts)
    start, end, doc = words(data, bounds, SPACE)
    n_docs = len(bounds) - 1
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    count = np.diff(first)
    parts = np.maximum(1, -(-count // PASSAGE_WORDS))
    base = np.cumsum(parts) - parts
    total = int(parts.sum())
    owner = np.repeat(np.arange(n_docs), parts)
    passage = base[doc] + (np.arange(len(doc)) - first[doc]) // PASSAGE_WORDS
    rows = np.zeros((total, FEATURES))
    if len(start):
        # Bytes belong to the passage of the last word that starts at or before them.
        begin = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        edge = np.append(start[begin], len(data))
        of_byte = np.repeat(passage[begin], np.diff(edge))
        own = data[edge[0] :]
        kind = _KIND[own]
        code = kind[:-1] * KINDS + kind[1:]
        pairs = np.bincount(of_byte[:-1] * KINDS * KINDS + code, minlength=total * KINDS * KINDS)
        pairs = pairs.reshape(total, -1).astype(np.float64)
        rows[:, : KINDS * KINDS] = np.sqrt(pairs / np.maximum(1.0, pairs.sum(axis=1, keepdims=True)))
        content = span_hash(byte_prefix(data), start, end)
        size = np.bincount(passage, minlength=total)
        length = (end - start).astype(np.float64)
        repeats = np.concatenate(([False], (content[1:] == content[:-1]) & (passage[1:] == passage[:-1])))
        order = np.lexsort((content, passage))
        fresh = np.concatenate(
            ([True], (content[order[1:]] != content[order[:-1]]) | (passage[order[1:]] != passage[order[:-1]]))
        )
        per_word = 1.0 / np.maximum(1, size)
        marks = np.concatenate(([0], np.cumsum(_KIND[data] == 6)))
        mean = np.bincount(passage, length, total) * per_word
        at = KINDS * KINDS
        rows[:, at] = np.bincount(passage, repeats, total) * per_word
        rows[:, at + 1] = np.bincount(passage[order], fresh, total) * per_word
        rows[:, at + 2] = mean / 10.0
        rows[:, at + 3] = np.sqrt(np.maximum(0.0, np.bincount(passage, length**2, total) * per_word - mean**2)) / 10.0
        rows[:, at + 4] = np.bincount(passage, (marks[end] - marks[start]) > 0, total) * per_word
        rows[:, at + 5] = size / PASSAGE_WORDS
    return owner, rows


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, begin, axis=0)


class Network:
    """Encoder, gated attention and scoring layer."""

    NAMES = ("encode", "encode_bias", "look", "gate", "attend", "score", "score_bias")

    def __init__(self, weights: dict[str, np.ndarray], mean: np.ndarray, spread: np.ndarray):
        self.weights, self.mean, self.spread = weights, mean, spread

    @classmethod
    def start(cls, features: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0.0, 1.0 / np.sqrt(shape[0]), shape)
        weights = {
            "encode": draw(features.shape[1], HIDDEN),
            "encode_bias": np.zeros(HIDDEN),
            "look": draw(HIDDEN, HIDDEN),
            "gate": draw(HIDDEN, HIDDEN),
            "attend": draw(HIDDEN, 1)[:, 0],
            "score": draw(HIDDEN, 1)[:, 0],
            "score_bias": np.zeros(1),
        }
        return cls(weights, features.mean(axis=0), features.std(axis=0) + 0.05)

    def forward(self, rows: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
        """All layers for documents whose passages start at ``begin``."""
        w = self.weights
        x = (rows - self.mean) / self.spread
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        look, gate = np.tanh(h @ w["look"]), 1.0 / (1.0 + np.exp(-np.clip(h @ w["gate"], -30, 30)))
        energy = (look * gate) @ w["attend"]
        counts = np.diff(np.append(begin, len(rows)))
        top = np.repeat(np.maximum.reduceat(energy, begin), counts)
        share = np.exp(energy - top)
        share /= np.repeat(_sums(share, begin), counts)
        bag = _sums(share[:, None] * h, begin)
        logit = bag @ w["score"] + w["score_bias"][0]
        score = 1.0 / (1.0 + np.exp(-np.clip(logit, -30, 30)))
        return {"x": x, "h": h, "look": look, "gate": gate, "share": share, "bag": bag, "score": score, "counts": counts}

    def gradients(self, rows: np.ndarray, begin: np.ndarray, labels: np.ndarray, cost: np.ndarray) -> dict:
        """Of the weighted cross-entropy, by the chain rule from the score back to the encoder."""
        w, f = self.weights, self.forward(rows, begin)
        error = cost * (f["score"] - labels)
        of_bag = np.repeat(error[:, None] * w["score"], f["counts"], axis=0)
        of_share = (of_bag * f["h"]).sum(axis=1)
        mean = np.repeat(_sums(f["share"] * of_share, begin), f["counts"])
        of_energy = f["share"] * (of_share - mean)
        of_look = of_energy[:, None] * w["attend"] * f["gate"] * (1 - f["look"] ** 2)
        of_gate = of_energy[:, None] * w["attend"] * f["look"] * f["gate"] * (1 - f["gate"])
        of_h = f["share"][:, None] * of_bag + of_look @ w["look"].T + of_gate @ w["gate"].T
        of_x = of_h * (1 - f["h"] ** 2)
        return {
            "encode": f["x"].T @ of_x,
            "encode_bias": of_x.sum(axis=0),
            "look": f["h"].T @ of_look,
            "gate": f["h"].T @ of_gate,
            "attend": (f["look"] * f["gate"]).T @ of_energy,
            "score": f["bag"].T @ error,
            "score_bias": np.array([error.sum()]),
        }

    def scores(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        owner, rows = passages(texts)
        return self.forward(rows, np.searchsorted(owner, np.arange(len(texts))))["score"]

    def attention(self, texts: pa.Array) -> list[np.ndarray]:
        """Weight of every passage of each text; the weights of a text add up to one."""
        owner, rows = passages(texts)
        begin = np.searchsorted(owner, np.arange(len(texts)))
        return np.split(self.forward(rows, begin)["share"], begin[1:])


def fit(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS) -> Network:
    """Train on labelled documents with Adam, a fixed start and both classes weighted as they come.

    Without labels of both classes every text scores the share of label 1 (a half without any).
    """
    labels = labels.astype(np.float64)
    owner, rows = passages(pa.array(texts, pa.string()))
    if not len(texts) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        net = Network.start(np.zeros((1, FEATURES)))
        net.weights["score"][:] = 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        net.weights["score_bias"][:] = np.log(share / (1 - share))
        return net
    begin = np.searchsorted(owner, np.arange(len(texts)))
    net = Network.start(rows)
    # Classes are sampled alike; equal cost for both makes 0.5 the border between them.
    cost = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    first = {n: np.zeros_like(w) for n, w in net.weights.items()}
    second = {n: np.zeros_like(w) for n, w in net.weights.items()}
    for step in range(1, rounds + 1):
        for n, g in net.gradients(rows, begin, labels, cost).items():
            if n in ("encode", "look", "gate"):
                g = g + 1e-4 * net.weights[n]
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.999 * second[n] + 0.001 * g * g
            rate = 0.02 * min(1.0, 2.0 * (rounds - step) / rounds)
            ahead = first[n] / (1 - 0.9**step)
            net.weights[n] = net.weights[n] - rate * ahead / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    return net


def score_quality(docs: DataFrame, net: Network, text: str = "text", column: str = "score") -> DataFrame:
    """Add the quality of every whole text, 0 to 1. A null or empty text is one passage without
    words and has a score of its own. A column named like the result is replaced; every row is
    judged alone, so copies and hot sources do not matter."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.drop(column)
    schema = rows.withColumn(column, F.lit(None).cast("double")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores = pa.array(shared.value.scores(batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Network from the labelled rows outside of the held-out fifth."""
    return fit(*sample(docs, labels, "quality", remainder(F.col("doc_id"), 5) != 0, per_class=1_500))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_quality(docs, train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERY = op10_quality
ORACLE = None
