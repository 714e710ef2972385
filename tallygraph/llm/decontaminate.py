"""Benchmark passages in training texts, by an FM-index per shard of documents.

A shard is a bounded slice of a task's documents. Its index is the Burrows-Wheeler transform of
the shard's word sequence in a wavelet matrix; all benchmark windows are searched backward in it
together, one word per step, and the ranges found are located by walking to sampled suffix
positions. Words outside the benchmark's vocabulary cannot lie in an occurrence, and neither can
runs of known words shorter than the shortest window, so only longer runs enter an index. That
drops no occurrence and keeps the index near the size of what can match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.text import byte_prefix, joined, slices, span_hash, words
from tallygraph.session import table

WINDOW = 13
BLOCK_WORDS = 500_000  # benchmark words held at once, on the driver and in one broadcast
SHARD_BYTES = 1 << 21
SAMPLE = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[:0x30] = _SEPARATOR[0x3A:0x61] = _SEPARATOR[0x7B:0x80] = True


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and document of every word of the texts, A-Z lower-cased, and the number of texts."""
    data, bounds = joined(texts)
    data = _LOWER[data]
    start, end, doc = words(data, bounds, _SEPARATOR)
    return span_hash(byte_prefix(data), start, end), doc, len(bounds) - 1


class FMIndex:
    """Backward search over a sequence of symbols 2, 3, ... with 1 between its runs."""

    def __init__(self, sequence: np.ndarray):
        text = np.append(sequence, 0).astype(np.int64)
        suffixes = _suffix_array(text)
        last = text[suffixes - 1]
        self.size = len(text)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(last))))
        self.levels = []  # wavelet matrix: per bit the number of ones before each place, and of zeros
        for bit in range(int(last.max()).bit_length() - 1, -1, -1):
            ones = (last >> bit) & 1
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), len(ones) - int(ones.sum())))
            last = np.concatenate((last[ones == 0], last[ones == 1]))
        sampled = suffixes % SAMPLE == 0
        self.sampled = sampled
        self.samples = suffixes[sampled]
        self.sample_rank = np.concatenate(([0], np.cumsum(sampled)))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each place."""
        begin = np.zeros_like(place)
        for bit, ones, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return place - begin

    def _back(self, row: np.ndarray) -> np.ndarray:
        """Row of the suffix that starts one place earlier."""
        symbol, place, begin = np.zeros_like(row), row, np.zeros_like(row)
        for bit, ones, zeros in self.levels:
            one = ones[place + 1] > ones[place]
            symbol = symbol | (one.astype(np.int64) << bit)
            begin = np.where(one, zeros + ones[begin], begin - ones[begin])
            place = np.where(one, zeros + ones[place], place - ones[place])
        return self.before[symbol] + place - begin

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each pattern (one per line)."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size)
        live = np.arange(len(patterns))
        for symbol in patterns.T[::-1]:
            symbol = symbol[live]
            known = symbol < len(self.before) - 1
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.before[symbol] + self.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.rank(symbol, high[live])
            live = live[high[live] > low[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the sequence of each row's suffix."""
        found = np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            hit = self.sampled[rows]
            found[open_[hit]] = self.samples[self.sample_rank[rows[hit]]] + steps
            open_, rows = open_[~hit], self._back(rows[~hit])
            steps += 1
        return found


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by doubling the compared prefix; the last symbol is a unique zero."""
    rank, reach, size = text, 1, len(text)
    while True:
        key = rank * (size + int(rank.max()) + 2)
        key[: size - reach] += rank[reach:] + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(size, np.int64)
        rank[order] = fresh
        if fresh[-1] == size - 1:
            return order
        reach *= 2
        if reach >= size:
            return order


class Phrases:
    """A bounded block of benchmark items as search patterns."""

    def __init__(self, items: list[str], texts: list[str], window: int):
        hashes, doc, _ = hashed_words(pa.array(texts, pa.string()))
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 2
        first = np.searchsorted(doc, np.arange(len(texts) + 1))
        owners: dict[tuple, set[str]] = {}
        for i, item in enumerate(items):
            own = symbols[first[i] : first[i + 1]].tolist()
            for s in range(max(1, len(own) - window + 1) if own else 0):
                owners.setdefault(tuple(own[s : s + window]), set()).add(item)
        by_length: dict[int, list[tuple]] = {}
        for pattern in owners:
            by_length.setdefault(len(pattern), []).append(pattern)
        self.groups = [
            (np.array(patterns), [sorted(owners[p]) for p in patterns])
            for patterns in by_length.values()
        ]
        self.shortest = min(by_length, default=0)

    def hits(self, hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, list[set]]:
        """Which words lie in an occurrence, and the items that occur in each document."""
        change = np.zeros(len(hashes) + 1, np.int64)
        items: list[set] = [set() for _ in range(n_docs)]
        if not self.groups or not len(hashes):
            return change[:-1] > 0, items
        place = np.searchsorted(self.vocabulary, hashes)
        known = self.vocabulary[np.minimum(place, len(self.vocabulary) - 1)] == hashes
        new_run = np.concatenate(([True], ~known[:-1] | (doc[1:] != doc[:-1])))
        run = np.cumsum(new_run | ~known)
        length = np.bincount(run)
        use = known & (length[run] >= self.shortest)
        where = np.flatnonzero(use)
        if not len(where):
            return change[:-1] > 0, items
        gap = np.concatenate(([0], np.cumsum(np.diff(run[where]) > 0)))
        sequence = np.ones(len(where) + int(gap[-1]), np.int64)
        at = np.arange(len(where)) + gap
        sequence[at] = place[where] + 2
        origin = np.zeros(len(sequence), np.int64)
        origin[at] = where
        index = FMIndex(sequence)
        for patterns, owners in self.groups:
            low, high = index.search(patterns)
            count = high - low
            if not count.any():
                continue
            which = np.repeat(np.arange(len(patterns)), count)
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
            start = origin[index.locate(rows)]
            np.add.at(change, start, 1)
            np.add.at(change, start + patterns.shape[1], -1)
            for pair in np.unique(doc[start] * len(patterns) + which):
                items[pair // len(patterns)].update(owners[pair % len(patterns)])
        return np.cumsum(change[:-1]) > 0, items


def _blocks(spark: SparkSession, benchmark: DataFrame, item: str, text: str, window: int) -> list[Broadcast]:
    """The benchmark in blocks of at most BLOCK_WORDS words (or one item), each broadcast alone."""
    blocks, items, texts, held = [], [], [], 0
    for row in benchmark.select(F.col(item).cast("string"), text).dropna().toLocalIterator():
        size = len(row[1]) // 2 + 1  # no text has more words than half its characters
        if items and held + size > BLOCK_WORDS:
            blocks.append(spark.sparkContext.broadcast(Phrases(items, texts, window)))
            items, texts, held = [], [], 0
        items.append(row[0])
        texts.append(row[1])
        held += size
    if items:
        blocks.append(spark.sparkContext.broadcast(Phrases(items, texts, window)))
    return blocks


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Removal spans of every document: the words that lie in a window of a benchmark item.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is
    ``window`` consecutive words of an item, or all of a shorter one; an item without words, with
    a null text or a null id has none. Returns the columns of ``docs`` and ``n_words``, ``spans``
    (sorted, disjoint word ranges ``start``, ``end``) and ``items`` (ids as strings, sorted);
    columns of ``docs`` with these names are replaced. A null or empty text has no words.
    Repeated rows are judged each. No row is shuffled: a hot document or item adds to no key.

    The benchmark is the query set: it passes the driver in blocks of bounded size, and a task
    holds one block at a time beside its shard.
    """
    blocks = _blocks(docs.sparkSession, benchmark, item, item_text, window)
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    rows = docs.select(*kept)
    out = rows.withColumns(
        {
            "n_words": F.lit(None).cast("bigint"),
            "spans": F.lit(None).cast("array<struct<start:bigint,end:bigint>>"),
            "items": F.lit(None).cast("array<string>"),
        }
    ).schema
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SHARD_BYTES):
            hashes, doc, n_docs = hashed_words(batch.column(text))
            hit = np.zeros(len(hashes), bool)
            items: list[set] = [set() for _ in range(n_docs)]
            for block in blocks:
                more, found = block.value.hits(hashes, doc, n_docs)
                hit |= more
                items = [a | b for a, b in zip(items, found)]
            first = np.searchsorted(doc, np.arange(n_docs + 1))
            spans: list[list[dict]] = [[] for _ in range(n_docs)]
            begins = hit & ~np.concatenate(([False], hit[:-1] & (doc[1:] == doc[:-1])))
            ends = hit & ~np.concatenate((hit[1:] & (doc[1:] == doc[:-1]), [False]))
            for s, e in zip(np.flatnonzero(begins).tolist(), np.flatnonzero(ends).tolist()):
                d = int(doc[s])
                spans[d].append({"start": s - int(first[d]), "end": e + 1 - int(first[d])})
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.diff(first), pa.int64()),
                    pa.array(spans, span_type),
                    pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                ],
                names=[*kept, "n_words", "spans", "items"],
            )

    return rows.mapInArrow(search, out)


def contamination(found: DataFrame) -> DataFrame:
    """Counts of :func:`find_passages` and the verdict: at least a twentieth of the words is hit."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.withColumn("n_hit", hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    )


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(find_passages(docs, table(spark, folder, "benchmark")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERY = op5_decontaminate
ORACLE = None
