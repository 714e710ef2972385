"""Lines that repeat an earlier line up to one edit, by a deletion-neighbourhood join.

Two lines within one edit of each other share a variant: deleting the same place leaves the same
rest, or deleting one character of the longer leaves the shorter. Equal lines are one before
anything else. Two different lines within one edit also share their first or their second half
(of the shorter's length), so only lines that share a half with another line emit their variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.rows import addressed, identified, joined_by_row
from tallygraph.llm.text import joined, mix, powers, prefix_hash, slices, span_hash
from tallygraph.session import table
from tallygraph.storage import materialize

MIN_CHARS = 8


def _id():
    return F.struct("_order", "_row", "line")


def _lines(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Code points of all texts, and start, end, document and number of each line."""
    data, bounds = joined(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    begins = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
    feed = np.flatnonzero(points == 10)
    start = np.sort(np.concatenate((begins[:-1], feed + 1)), kind="stable")
    end = np.sort(np.concatenate((feed, begins[1:])), kind="stable")
    # A document's first line comes before the lines after its line feeds, also when it is empty.
    counts = np.searchsorted(feed, begins[1:]) - np.searchsorted(feed, begins[:-1]) + 1
    doc = np.repeat(np.arange(len(counts)), counts)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    return points, start, end, doc, number


def _halves(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Keys of both halves for the own length and for one less, as the longer of two lines."""
    keys = []
    for shorter in (0, 1):
        length = end - start - shorter
        half = length // 2
        salt = length.astype(np.uint64) * np.uint64(2)
        keys.append(mix(span_hash(sums, start, start + half) ^ mix(salt)))
        keys.append(mix(span_hash(sums, end - (length - half), end) ^ mix(salt + np.uint64(1))))
    return keys


def _found(docs: DataFrame, min_chars: int) -> DataFrame:
    """Hash and half keys of the earliest of equal lines in each slice; later ones are marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            points, start, end, doc, number = _lines(batch.column("_text"))
            use = np.flatnonzero(end - start >= min_chars)
            start, end, doc, number = start[use], end[use], doc[use], number[use]
            sums = prefix_hash(mix(points.astype(np.uint64) + np.uint64(1)))
            whole = span_hash(sums, start, end)
            order_, row = (batch.column(c).to_numpy()[doc] for c in ("_order", "_row"))
            order = np.lexsort((number, row, order_, whole))
            same = np.concatenate(([False], whole[order[1:]] == whole[order[:-1]]))
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
            # The same line of a repeated row is no later line.
            again = (number[order] == number[head]) & (row[order] == row[head]) & (order_[order] == order_[head])
            marked = np.zeros(len(order), bool)
            marked[order] = same & ~again
            skip = np.zeros(len(order), bool)
            skip[order] = same & again
            keep = ~skip
            columns = [whole, *_halves(sums, start, end)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(marked[keep])]
                + [pa.array(c[keep]) for c in (order_, row, number.astype(np.int32))]
                + [pa.array(c.view(np.int64)[keep]) for c in columns],
                names=["marked", "_order", "_row", "line", "whole", "k0", "k1", "k2", "k3"],
            )

    kind = "marked boolean, _order bigint, _row bigint, line int, whole bigint, "
    return docs.mapInArrow(run, kind + "k0 bigint, k1 bigint, k2 bigint, k3 bigint")


def _variants(docs: DataFrame) -> DataFrame:
    """The wanted lines (``_lines`` of each document): one row for each character left out.

    ``place`` -1 is the line itself, the only row that carries the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            points, start, end, doc, number = _lines(batch.column("_text"))
            wanted = batch.column("_lines")
            of = pc.list_parent_indices(wanted).to_numpy()
            first = np.searchsorted(doc, np.arange(batch.num_rows))
            line = np.unique(first[of] + pc.list_flatten(wanted).to_numpy())
            sums = prefix_hash(mix(points.astype(np.uint64) + np.uint64(1)))
            inverse = powers(len(sums))[1]
            ids = [batch.column("_order").to_numpy(), batch.column("_row").to_numpy()]
            for begin in range(0, len(line), 500):  # variants of some lines at a time
                own = line[begin : begin + 500]
                s, e = start[own], end[own]
                size = e - s
                at = np.repeat(np.arange(len(own)), size)
                place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                here = s[at] + place
                left = (sums[here] - sums[s[at]]) * inverse[s[at]]
                right = (sums[e[at]] - sums[here + 1]) * inverse[s[at] + 1]
                at = np.concatenate((np.arange(len(own)), at))
                values = np.concatenate((span_hash(sums, s, e), mix(left + right)))
                place = np.concatenate((np.full(len(own), -1), place))
                texts = [
                    points[a:b].tobytes().decode("utf-32-le") for a, b in zip(s.tolist(), e.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values.view(np.int64)),
                        pa.array(place.astype(np.int32)),
                        *[pa.array(i[doc[own]][at]) for i in ids],
                        pa.array(number[own][at].astype(np.int32)),
                        pa.array(texts + [None] * (len(at) - len(own)), pa.string()),
                    ],
                    names=["variant", "place", "_order", "_row", "line", "text"],
                )

    kind = "variant bigint, place int, _order bigint, _row bigint, line int, text string"
    return docs.mapInArrow(run, kind)


def repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = 1, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Marks ``_row, line`` of all lines for which an earlier line lies within ``max_edits``."""
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    rows = identified(docs, key, text)
    found = materialize(_found(addressed(rows, key, text), min_chars), "lines")
    # Marked rows are dealt out by document, so a very common line does not meet in one task.
    group = F.when(F.col("marked"), F.xxhash64("_row", "line")).otherwise(F.col("whole"))
    least = F.min(_id()).over(Window.partitionBy("_group"))
    found = found.withColumn("_group", group).withColumn("_first", (least == _id()) & ~F.col("marked"))
    found = materialize(found.drop("marked", "_group"), "distinct-lines")
    marks = found.where("NOT _first").select("_row", "line")
    if max_edits == 0:
        return marks

    halves = found.where("_first").select(
        "_row", "line", F.explode(F.array("k0", "k1", "k2", "k3")).alias("_half")
    )
    shared = F.count(F.lit(1)).over(Window.partitionBy("_half")) > 1
    near = halves.withColumn("_shared", shared).where("_shared").select("_row", "line").distinct()
    wanted = near.groupBy("_row").agg(F.collect_list("line").alias("_lines"))
    texts = addressed(joined_by_row(docs.select(key, text), key, text, wanted, "inner"), key, text, "_lines")
    variants = materialize(_variants(texts), "line-variants")

    itself = F.col("place") < 0
    same_variant = Window.partitionBy("variant")
    same_place = Window.partitionBy("variant", "place")
    met = variants.select(
        _id().alias("_id"),
        F.min(_id()).over(same_place).alias("_other"),  # one character replaced
        F.when(itself, F.min(F.when(~itself, _id())).over(same_variant))  # one put in
        .otherwise(F.min(F.when(itself, _id())).over(same_variant))  # one left out
        .alias("_longer"),
    )
    pairs = (
        met.select("_id", F.explode(F.array("_other", "_longer")).alias("_earlier"))
        .where("_earlier < _id")
        .distinct()
    )
    lines = variants.where(itself).select(_id().alias("_id"), "text").distinct()
    verified = (
        pairs.join(lines, "_id")
        .join(lines.select(F.col("_id").alias("_earlier"), F.col("text").alias("_earlier_text")), "_earlier")
        .where(F.levenshtein("text", "_earlier_text") <= max_edits)
    )
    return marks.unionByName(verified.select("_id._row", "_id.line").distinct())


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = 1, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Documents without the lines that repeat an earlier one.

    A line of at least ``min_chars`` characters goes when a line before it (smaller key, or same
    document and higher up; null keys come first) differs from it by at most ``max_edits``
    inserted, deleted or replaced characters. Lines are judged on the input, not on what is left.
    Shorter lines stay. Lines end at line feeds only. Returns the columns of ``docs`` with the text
    cleaned and ``n_lines``, ``n_removed`` (replaced if present). A null text has no lines and
    stays null; a text all of whose lines go becomes empty. Rows that repeat key and text are one
    document given twice and get the same result; equal keys with different texts are ordered by
    a hash.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    docs = docs.select(*kept)
    marks = repeated_lines(docs, key, text, max_edits, min_chars)
    marks = marks.groupBy("_row").agg(F.collect_list("line").alias("_removed"))
    out = docs.withColumns({c: F.lit(None).cast("bigint") for c in ("n_lines", "n_removed")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            cleaned, counts, removed = [], [], []
            for value, gone in zip(batch.column(text).to_pylist(), batch.column("_removed").to_pylist()):
                lines = [] if value is None else value.split("\n")
                gone = set(gone or ())
                counts.append(len(lines))
                removed.append(len(gone))
                cleaned.append(value if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
            columns = {c: batch.column(c) for c in kept}
            columns[text] = pa.array(cleaned, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns.values(), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())],
                names=[*kept, "n_lines", "n_removed"],
            )

    return joined_by_row(docs, key, text, marks, "left").mapInArrow(run, out)


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines removed from every document."""
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


QUERY = op7_line_dedup
ORACLE = r"""
WITH cut AS (
  SELECT doc_id, text, unnest(range(len(string_split(text, chr(10))))) AS line_no,
         unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
firsts AS (
  SELECT line, length(line) AS n, min((doc_id, line_no)) AS id FROM cut WHERE length(line) >= 8 GROUP BY line),
halves AS (
  SELECT line, n, id, unnest([n, n, n - 1, n - 1]) AS size, unnest([0, 1, 0, 1]) AS side FROM firsts),
keyed AS (
  SELECT line, n, id, md5(concat(size, '/', side, '/', CASE WHEN side = 0 THEN substr(line, 1, CAST(size // 2 AS BIGINT))
    ELSE substr(line, CAST(n - (size - size // 2) + 1 AS BIGINT)) END)) AS half
  FROM halves),
near AS (
  SELECT DISTINCT line, n, id FROM keyed WHERE half IN (SELECT half FROM keyed GROUP BY half HAVING count(DISTINCT line) > 1)),
variants AS (
  SELECT id, place, md5(substr(line, 1, CAST(place - 1 AS BIGINT)) || substr(line, CAST(place + 1 AS BIGINT))) AS v
  FROM (SELECT line, id, unnest(range(1, n + 1)) AS place FROM near)
  UNION ALL SELECT id, 0, md5(line) FROM near),
same_place AS (SELECT v, place, min(id) AS least FROM variants WHERE place > 0 GROUP BY ALL),
itself AS (SELECT v, id AS center FROM variants WHERE place = 0),
longer AS (SELECT v, min(id) AS least FROM variants WHERE place > 0 GROUP BY v),
gone AS (
  SELECT id FROM variants JOIN same_place USING (v, place) WHERE least < id
  UNION SELECT id FROM variants JOIN itself USING (v) WHERE place > 0 AND center < id
  UNION SELECT center FROM itself JOIN longer USING (v) WHERE least < center),
judged AS (
  SELECT doc_id, line_no, cut.line, firsts.line IS NOT NULL AND
         ((doc_id, line_no) <> firsts.id OR firsts.id IN (SELECT id FROM gone)) AS removed
  FROM cut LEFT JOIN firsts ON firsts.line = cut.line),
kept AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE removed) AS n_removed,
         string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT removed) AS text
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
"""
