"""Labelled texts for fitting a model, on the driver or in one task."""

from __future__ import annotations

import multiprocessing
import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")
SAMPLE_DOCS = 3_000  # labelled documents of each class a model is fitted on, at most
SAMPLE_CHARS = 8_000  # longer documents are scored like any other, but not fitted on


def remainder(key: Column, folds: int) -> Column:
    """crc32 of the key as text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def sample_rows(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    usable: Column,
    key: str = "doc_id",
    text: str = "text",
    per_class: int = SAMPLE_DOCS,
    max_chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """``key, text, _label`` of at most ``per_class`` documents a class, picked by hash of the key.

    ``usable`` is a condition on the labels table. Of several labels of a key the greatest counts;
    null labels and texts are left out. The chosen keys are bounded, so they may be broadcast.
    """
    chosen = None
    known = labels.where(usable).groupBy(key).agg(F.max(label).alias("_label")).where(F.col(key).isNotNull())
    for value in (0, 1):
        part = known.where(F.col("_label") == value).orderBy(F.xxhash64(key), key).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return (
        docs.select(key, text)
        .where(F.length(text) <= max_chars)
        .join(F.broadcast(chosen), key)
        .select(key, text, F.col("_label").cast("int").alias("_label"))
    )


def sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, **how) -> tuple[list[str], np.ndarray]:
    """Texts and 0/1 labels of :func:`sample_rows`, on the driver."""
    rows = sorted(sample_rows(docs, labels, label, usable, **how).collect(), key=lambda r: (r[0], r[1]))
    return [r[1] for r in rows], np.array([r[2] for r in rows], np.int64)


def _apart(call: Callable[[], bytes]) -> bytes:
    """Result of a call in a process of its own, whose memory goes with it, unlike a worker's."""
    forked = multiprocessing.get_context("fork")
    receiver, sender = forked.Pipe(duplex=False)
    child = forked.Process(target=lambda: sender.send_bytes(call()))
    child.start()
    sender.close()
    try:
        return receiver.recv_bytes()  # EOFError if the child fails, so that the task is tried again
    finally:
        child.join()


def fit_in_task(rows: DataFrame, fit: Callable[[list[str], np.ndarray], T]) -> T:
    """``fit(texts, labels)`` of sampled rows, in one task; only the plain values it returns come back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            found += zip(*(c.to_pylist() for c in batch.columns))
        found.sort()
        labels = np.array([r[2] for r in found], np.int64)
        model = _apart(lambda: pickle.dumps(fit([r[1] for r in found], labels)))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    fitted = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(fitted[0]) if fitted else fit([], np.zeros(0, np.int64))
