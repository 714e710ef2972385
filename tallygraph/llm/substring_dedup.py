"""Word passages that occur earlier, by seed and extend.

Seeds are winnowed anchors: of every 20 words some 6-word gram is the smallest by hash, the same
one in every copy. Anchors that occur once are dropped. Those that occur again are joined by
content, and each occurrence is extended to both sides, word by word as far as a window reaches;
windows that are equal to an earlier one at the same anchor make up the repeats, and windows that
follow each other one maximal repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.anchors import repeated_anchors
from tallygraph.llm.rows import addressed, identified, joined_by_row
from tallygraph.llm.text import (
    SPACE,
    byte_prefix,
    joined,
    mix,
    prefix_hash,
    slices,
    span_hash,
    winnow,
    words,
)
from tallygraph.session import table

WINDOW = 20
GRAM = 6


class _Words:
    """Words of a slice of texts, hashed."""

    def __init__(self, texts: pa.Array):
        self.data, bounds = joined(texts)
        self.start, self.end, self.doc = words(self.data, bounds, SPACE)
        self.first = np.searchsorted(self.doc, np.arange(len(bounds)))
        self.sums = prefix_hash(span_hash(byte_prefix(self.data), self.start, self.end))

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        return span_hash(self.sums, at, at + length)


def _anchors(window: int, gram: int):
    def find(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = _Words(texts)
        n = len(own.start)
        if n < window:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        grams = own.hashes(np.arange(n - gram + 1), gram)
        inside = own.doc[: n - window + 1] == own.doc[window - 1 :]
        at = np.flatnonzero(winnow(grams, window - gram + 1, inside))
        return grams[at], own.doc[at], at - own.first[own.doc[at]]

    return find


def _extended(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """Per repeated anchor the hashes of the windows around it that this anchor stands for.

    A window that repeats an earlier one of the same slice is marked at once and not sent on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            own = _Words(batch.column("_text"))
            places = batch.column("_places")
            of = pc.list_parent_indices(places).to_numpy()
            anchor = np.sort(own.first[of] + pc.list_flatten(places).to_numpy())
            doc = own.doc[anchor]
            low = np.maximum(anchor + gram - window, own.first[doc])
            high = np.minimum(anchor, own.first[doc + 1] - window)
            # Each window goes with one anchor, the smallest gram in it, so that equal ones meet.
            grams = own.hashes(np.arange(max(0, len(own.start) - gram + 1)), gram)
            size = np.maximum(high - low + 1, 0)
            at = np.repeat(np.arange(len(anchor)), size)
            start = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + low[at]
            value = grams[anchor]
            order = np.lexsort((value[at], start))
            order = order[np.concatenate(([True], start[order[1:]] != start[order[:-1]]))] if len(order) else order
            at, start = at[order], start[order]
            content = own.hashes(start, window)
            ids = [batch.column(c).to_numpy()[own.doc[start]] for c in ("_order", "_row")]
            place = start - own.first[own.doc[start]]
            order = np.lexsort((place, ids[1], ids[0], content, value[at]))
            anchors, content, place = value[at][order], content[order], place[order].astype(np.int32)
            order_, row = (i[order] for i in ids)
            same = np.concatenate(([False], (anchors[1:] == anchors[:-1]) & (content[1:] == content[:-1])))
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
            # The same window of a repeated row is no later window.
            later = (order_ != order_[first]) | (row != row[first]) | (place != place[first])
            # Marks go straight to their documents, packed; the others are compared elsewhere. The
            # anchor is part of the key: both hashes must agree for windows to count as equal.
            # In the order of the text, so that what a document's rows share compresses.
            # Copies of a repeated row speak once.
            again = np.concatenate(([False], same[1:] & (order_[1:] == order_[:-1]) & (row[1:] == row[:-1]) & (place[1:] == place[:-1])))
            later &= ~again
            kept = np.flatnonzero(~later & ~again)
            kept = kept[np.argsort(order[kept])]
            meet = (mix(anchors) ^ content)[kept].view(np.int64)
            own_row, own_place = row[later], place[later]
            by_row = np.lexsort((own_place, own_row))
            own_row, own_place = own_row[by_row], own_place[by_row]
            begin = np.flatnonzero(np.concatenate(([True], own_row[1:] != own_row[:-1]))) if len(own_row) else own_row
            packed = [part.tobytes() for part in np.split(own_place, begin[1:])] if len(own_row) else []
            n = len(packed)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(meet), pa.array(mix(own_row[begin].view(np.uint64)).view(np.int64))]),
                    pa.concat_arrays([pa.array(order_[kept]), pa.nulls(n, pa.int64())]),
                    pa.concat_arrays([pa.array(row[kept]), pa.array(own_row[begin])]),
                    pa.concat_arrays([pa.array(place[kept]), pa.nulls(n, pa.int32())]),
                    pa.concat_arrays([pa.nulls(len(meet), pa.binary()), pa.array(packed, pa.binary())]),
                ],
                names=["_window", "_order", "_row", "_place", "_marks"],
            )

    return texts.mapInArrow(run, "_window bigint, _order bigint, _row bigint, _place int, _marks binary")


def repeated_windows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``_row, _places, _marks``: starts of the windows of each document that occur earlier, partly
    as numbers and partly as packed 32-bit numbers."""
    rows = addressed(identified(docs, key, text), key, text)
    seeds = repeated_anchors(rows, _anchors(window, gram))
    texts = joined_by_row(docs.select(key, text), key, text, seeds, "inner")
    extended = _extended(addressed(texts, key, text, "_places"), window, gram)
    marked = F.col("_marks").isNotNull()
    id_ = F.struct("_order", "_row", "_place")
    first = F.min(F.when(~marked, id_)).over(Window.partitionBy("_window"))
    repeats = extended.withColumn("_first", first).where(marked | (F.col("_first") < id_))
    return repeats.groupBy("_row").agg(
        F.collect_set(F.when(~marked, F.col("_place"))).alias("_places"),
        F.collect_set("_marks").alias("_marks"),
    )


def dedup_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Documents without the words of passages that occur earlier.

    Words are runs of anything but ASCII space. A word goes when a window of ``window`` words over
    it also starts earlier: in a document of smaller key (null first), or further up in the same
    one. Windows are judged on the input. Returns the columns of ``docs`` with the text made of
    the kept words, one space between them, and ``n_words``, ``n_removed`` and ``spans`` (maximal
    repeats, as word ranges ``start``, ``end``); columns with these names are replaced. A null
    text has no words and stays null; a text without repeats keeps all its words. Rows that repeat
    key and text are one document given twice and get the same result; equal keys with different
    texts are ordered by a hash.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed", "spans")]
    docs = docs.select(*kept)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out = docs.withColumns(
        {
            "n_words": F.lit(None).cast("bigint"),
            "n_removed": F.lit(None).cast("bigint"),
            "spans": F.lit(None).cast("array<struct<start:bigint,end:bigint>>"),
        }
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = batch.column(text)
            own = _Words(texts)
            places = batch.column("_places")
            of = pc.list_parent_indices(places).to_numpy()
            at = [own.first[of] + pc.list_flatten(places).to_numpy()]
            for i, marks in enumerate(batch.column("_marks").to_pylist()):
                at += [own.first[i] + np.frombuffer(m, np.int32) for m in marks or ()]
            at = np.concatenate(at)
            change = np.bincount(at, minlength=len(own.start) + window + 1).astype(np.int64)
            change[window:] -= change[:-window].copy()
            gone = np.cumsum(change)[: len(own.start)] > 0
            spans = _runs(gone, own.doc, own.first, batch.num_rows)
            cleaned = _kept_words(own, ~gone, batch.num_rows)
            count = np.diff(own.first)
            removed = np.concatenate(([0], np.cumsum(gone)))[own.first]
            columns = {c: batch.column(c) for c in kept}
            columns[text] = pc.if_else(pc.is_null(texts), None, pa.array(cleaned, pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(count), pa.array(np.diff(removed)), pa.array(spans, span_type)],
                names=[*kept, "n_words", "n_removed", "spans"],
            )

    marks = repeated_windows(docs, key, text, window, gram)
    return joined_by_row(docs, key, text, marks, "left").mapInArrow(run, out)


def _runs(gone: np.ndarray, doc: np.ndarray, first: np.ndarray, n_docs: int) -> list[list[dict]]:
    """Maximal runs of removed words of each document."""
    spans: list[list[dict]] = [[] for _ in range(n_docs)]
    if gone.any():
        same = doc[1:] == doc[:-1]
        begin = np.flatnonzero(gone & ~np.concatenate(([False], gone[:-1] & same)))
        end = np.flatnonzero(gone & ~np.concatenate((gone[1:] & same, [False]))) + 1
        for s, e in zip(begin.tolist(), end.tolist()):
            base = int(first[doc[s]])
            spans[doc[s]].append({"start": s - base, "end": e - base})
    return spans


def _kept_words(own: _Words, keep: np.ndarray, n_docs: int) -> list[str]:
    """Kept words of each document with one space between them."""
    start, end, doc = own.start[keep], own.end[keep], own.doc[keep]
    size = end - start + 1
    place = np.cumsum(size) - size
    source = np.arange(int(size.sum())) - np.repeat(place - start, size)
    if len(source):
        source[place + size - 1] = 0
    normal = own.data[source] if len(source) else np.zeros(0, np.uint8)
    if len(source):
        normal[place + size - 1] = 32
    whole = normal.tobytes()
    edge = np.append(place, len(whole))[np.searchsorted(doc, np.arange(n_docs + 1))]
    return [whole[a : max(a, b - 1)].decode() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words removed from every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_passages(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


QUERY = op2_substring_dedup
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         unnest(range(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')))) AS place
  FROM documents WHERE text IS NOT NULL),
windows AS (
  SELECT doc_id, place, md5(string_agg(word, ' ') OVER twenty) AS content,
         count(*) OVER twenty AS n
  FROM words WINDOW twenty AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
firsts AS (SELECT content, min((doc_id, place)) AS id FROM windows WHERE n = 20 GROUP BY content),
repeats AS (
  SELECT doc_id, place FROM windows JOIN firsts USING (content) WHERE n = 20 AND (doc_id, place) <> firsts.id),
judged AS (
  SELECT w.doc_id, w.place, word,
         max(CASE WHEN r.place IS NULL THEN -100 ELSE r.place END) OVER (
           PARTITION BY w.doc_id ORDER BY w.place ROWS UNBOUNDED PRECEDING) > w.place - 20 AS removed
  FROM words w LEFT JOIN repeats r ON r.doc_id = w.doc_id AND r.place = w.place),
kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(word, ' ' ORDER BY place) FILTER (WHERE NOT removed) AS text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
