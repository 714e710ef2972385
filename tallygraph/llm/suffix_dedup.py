"""Bytes of strings that occur more than once, by a distributed merge sort of sorted suffix runs.

Of the positions in a 400-byte string, the one whose following 96 bytes hash smallest is its
anchor, the same in every copy. Only suffixes at anchors that occur again are sorted. A task sorts
its suffixes into a run and front-codes it: each suffix is stored as the length it shares with the
one before it and the rest. Runs are cut into ranges of the suffix order, and the pieces of a
range are merged by a loser tree that compares from the known common prefix on only. The merged
order yields the common prefixes of neighbours; with the same for the text to the left of the
anchors, every 400-byte window over an anchor is known to be alone or not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.anchors import repeated_anchors
from tallygraph.llm.rows import addressed, identified, joined_by_row
from tallygraph.llm.text import byte_prefix, joined, mix, slices, span_hash, winnow
from tallygraph.session import table

WINDOW = 400
GRAM = 96
RUN_BYTES = 10 << 20  # text of the suffixes that a task sorts into one run


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which the first ``known`` bytes need no comparison."""
    size = min(len(a), len(b))
    x, y = a[known:size], b[known:size]
    if x == y:
        return size
    differ = int.from_bytes(x) ^ int.from_bytes(y)
    return size - (differ.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Shared prefix lengths with the string before, string lengths, and the rests on end."""
    shared, last = [], b""
    for s in strings:
        shared.append(common(last, s))
        last = s
    sizes = np.array([shared, [len(s) for s in strings]], np.uint16)
    return sizes, b"".join([s[n:] for s, n in zip(strings, shared)])


def decoded(sizes: np.ndarray, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for shared, size in sizes.T.tolist():
        last = last[:shared] + rest[at : at + size - shared]
        at += size - shared
        out.append(last)
    return out


class LoserTree:
    """Merge of sorted runs that carries the common prefixes with the last string given out.

    Of two candidates, both not smaller than the last output, the one that shares more with it is
    the smaller; only equal shares call for a comparison, and that starts after the share.
    """

    def __init__(self, runs: list[list[bytes]], shares: list[list[int]]):
        self.runs, self.shares = runs, shares
        self.width = 1 << max(0, (len(runs) - 1).bit_length())
        self.at = [0] * self.width
        self.share = [0] * self.width
        self.loser = [-1] * self.width

    def _head(self, run: int) -> bytes | None:
        if run < len(self.runs) and self.at[run] < len(self.runs[run]):
            return self.runs[run][self.at[run]]
        return None

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share becomes that with the winner."""
        x, y = self._head(a), self._head(b)
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        if self.share[a] != self.share[b]:
            return (a, b) if self.share[a] > self.share[b] else (b, a)
        n = common(x, y, self.share[a])
        if (x[n : n + 1], a) <= (y[n : n + 1], b):
            self.share[b] = n
            return a, b
        self.share[a] = n
        return b, a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """Run, place in the run, and prefix shared with the output before, in order."""
        if not self.runs:
            return
        level = list(range(self.width))
        node = self.width
        while len(level) > 1:
            node //= 2
            ahead = []
            for i in range(0, len(level), 2):
                winner, self.loser[node + i // 2] = self._play(level[i], level[i + 1])
                ahead.append(winner)
            level = ahead
        winner = level[0]
        while self._head(winner) is not None:
            yield winner, self.at[winner], self.share[winner]
            self.at[winner] += 1
            if self._head(winner) is not None:
                # Known from the front coding: what the next string of the run shares with this.
                self.share[winner] = self.shares[winner][self.at[winner]]
            node = (self.width + winner) // 2
            while node:
                winner, self.loser[node] = self._play(winner, self.loser[node])
                node //= 2


def _anchors(window: int, gram: int):
    def find(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, bounds = joined(texts)
        if len(data) < window:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.arange(len(data) - gram + 1)
        grams = span_hash(byte_prefix(data), at, at + gram)
        doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        inside = doc[: len(data) - window + 1] == doc[window - 1 :]
        at = np.flatnonzero(winnow(grams, window - gram + 1, inside))
        return grams[at], doc[at].astype(np.int64), at - bounds[doc[at]]

    return find


_RUNS = (
    "_bucket bigint, _row bigint, _spans binary, _size int, _anchors binary, _rows binary, _places binary, "
    "_twice binary, _right_sizes binary, _right binary, _left_sizes binary, _left binary"
)
_SCHEMA = pa.schema(
    [
        (n, {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t])
        for n, t in (part.split() for part in _RUNS.split(", "))
    ]
)


def _packed_spans(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Rows, and the union of the spans of each as packed 32-bit pairs."""
    order = np.lexsort((low, row))
    row, low, high = row[order], low[order].astype(np.int64), high[order].astype(np.int64)
    if not len(row):
        return row, []
    fresh = np.concatenate(([True], row[1:] != row[:-1]))
    shift = (np.cumsum(fresh) - 1) << 32  # a row's spans lie apart from those of all others
    reach = np.maximum.accumulate(high + shift)
    begin = np.flatnonzero(fresh | (low + shift > np.concatenate(([-1], reach[:-1]))))
    ends = np.append(begin[1:], len(row)) - 1
    pairs = np.stack((low[begin], reach[ends] - shift[ends]), axis=1).astype(np.int32)
    owner = row[begin]
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    return owner[first], [p.tobytes() for p in np.split(pairs, first[1:])]


def _sorted_runs(texts: DataFrame, window: int, gram: int, buckets: int) -> DataFrame:
    """Front-coded runs of the suffixes at repeated anchors, cut into ranges of the order.

    The order is that of the anchor's hash and then of the bytes after the anchor: suffixes that
    share the anchor's bytes are neighbours, and equal slices of the hash are even ranges. Equal
    suffixes with equal text to the left are one entry of a run, and as they are known to occur
    twice, their spans are given out at once.
    """

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        entries = sorted(held.items())
        known: list[tuple[int, int, int]] = []
        pieces: dict[int, list] = {}
        for (anchor, right, left), where in entries:
            if len(where) > 1:
                known += [(row, place - len(left), place + len(right)) for row, place in where]
            pieces.setdefault(anchor * buckets >> 64, []).append((anchor, right, left, where))
        if known:
            owner, packed = _packed_spans(*(np.array(c) for c in zip(*known)))
            columns = {"_bucket": owner % buckets, "_row": owner, "_spans": packed, "_size": np.zeros(len(owner), np.int32)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(owner), f.type) for f in _SCHEMA],
                schema=_SCHEMA,
            )
        for bucket, piece in pieces.items():
            anchors, rights, lefts, where = zip(*piece)
            right_sizes, right = front_coded(list(rights))
            left_sizes, left = front_coded(list(lefts))
            row = (
                bucket, 0, None, len(piece),
                np.array(anchors, np.uint64).tobytes(),
                np.array([w[0][0] for w in where], np.int64).tobytes(),
                np.array([w[0][1] for w in where], np.int32).tobytes(),
                np.array([len(w) > 1 for w in where], np.uint8).tobytes(),
                right_sizes.tobytes(), right, left_sizes.tobytes(), left,
            )
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SCHEMA)], schema=_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0
        for batch in slices(batches, "_text"):
            data, bounds = joined(batch.column("_text"))
            places = batch.column("_places")
            of = pc.list_parent_indices(places).to_numpy()
            at = bounds[of] + pc.list_flatten(places).to_numpy()
            # Anchors are the smallest hashes around them: mixed once more they are spread evenly.
            grams = mix(span_hash(byte_prefix(data), at, at + gram))
            rows = batch.column("_row").to_numpy()
            whole = data.tobytes()
            backward = whole[::-1]
            n = len(whole)
            low = np.maximum(bounds[of], at - (window - gram))
            high = np.minimum(bounds[of + 1], at + window)
            for g, r, b, i, s, e in zip(
                grams.tolist(), rows[of].tolist(), bounds[of].tolist(), at.tolist(), low.tolist(), high.tolist()
            ):
                if e - s < window:
                    continue
                entry = (g, whole[i:e], backward[n - i : n - s])
                where = held.get(entry)
                if where is None:
                    held[entry] = [(r, i - b)]
                    size += e - s
                else:
                    where.append((r, i - b))
                    size += 32
            if size > RUN_BYTES:
                yield from flush(held)
                held, size = {}, 0
        if held:
            yield from flush(held)

    return texts.mapInArrow(run, _RUNS)


def _left_shares(lefts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each left text (read backward) in sorted order, and prefixes shared in that order."""
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    rank = np.empty(len(lefts), np.int64)
    rank[order] = np.arange(len(lefts))
    ordered = [lefts[i] for i in order]
    shares = [0] + [common(a, b) for a, b in zip(ordered, ordered[1:])]
    return rank, np.array(shares)


def _windows_met(
    shares: np.ndarray, rights: np.ndarray, lefts: list[bytes], weight: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest reach to the left at which an entry's window is not alone (-1: none).

    Entries are in suffix order; ``shares`` holds the prefix shared with the entry before. For a
    reach d, entries share their window when they share d bytes to the left and window - d to the
    right. The windows between two met ones of an anchor overlap both, so the two tell all.
    """
    size = len(shares)
    least, most = np.full(size, -1), np.full(size, -1)
    # An entry that shares less than an anchor with both neighbours is alone in every window.
    near = np.maximum(shares, np.append(shares[1:], 0)) >= gram
    rank, left_shares = _left_shares(lefts)
    left_size = np.array([len(x) for x in lefts])
    for d in range(window - gram + 1):
        use = np.flatnonzero(near & (left_size >= d) & (rights >= window - d))
        if not len(use):
            continue
        right_class = np.cumsum(shares < window - d)[use]
        left_class = np.cumsum(left_shares < d)[rank[use]] if d else np.zeros(len(use), np.int64)
        key = right_class * (size + 1) + left_class
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        group = np.cumsum(new) - 1
        met = np.bincount(group, weights=weight[use][order])[group] > 1
        at = use[order[met]]
        most[at] = d
        least[at[least[at] < 0]] = d
    return least, most


def _merge(table_: pa.Table, window: int, gram: int) -> Iterator[tuple]:
    """Merge the runs of one range and give out the spans of its repeated strings."""
    entries, runs, shares, lefts = [], [], [], []
    for row in table_.to_pylist():
        n = row["_size"]
        sizes = np.frombuffer(row["_right_sizes"], np.uint16).reshape(2, n)
        left_sizes = np.frombuffer(row["_left_sizes"], np.uint16).reshape(2, n)
        anchors = np.frombuffer(row["_anchors"], np.uint64)
        # The anchor's hash leads the order: as a prefix of eight bytes it sorts the same way.
        lead = anchors.astype(">u8").tobytes()
        rights = decoded(sizes, row["_right"])
        runs.append([lead[8 * i : 8 * i + 8] + s for i, s in enumerate(rights)])
        same = np.concatenate(([False], anchors[1:] == anchors[:-1])).tolist()
        shares.append(
            [
                8 + n if known else common(lead[8 * i - 8 : 8 * i], lead[8 * i : 8 * i + 8]) if i else 0
                for i, (known, n) in enumerate(zip(same, sizes[0].tolist()))
            ]
        )
        lefts.append(decoded(left_sizes, row["_left"]))
        entries.append(
            (
                np.frombuffer(row["_rows"], np.int64),
                np.frombuffer(row["_places"], np.int32),
                np.frombuffer(row["_twice"], np.uint8),
            )
        )
    merged = list(LoserTree(runs, shares))
    share = np.array([max(0, s - 8) for _, _, s in merged])
    right = np.array([len(runs[r][i]) - 8 for r, i, _ in merged])
    left = [lefts[r][i] for r, i, _ in merged]
    twice = np.array([entries[r][2][i] for r, i, _ in merged], np.float64) + 1
    row = np.array([entries[r][0][i] for r, i, _ in merged])
    place = np.array([entries[r][1][i] for r, i, _ in merged])
    least, most = _windows_met(share, right, left, twice, window, gram)
    # Entries that met twice in a run were given out there.
    for i in np.flatnonzero((most >= 0) & (twice < 2)).tolist():
        yield int(row[i]), int(place[i] - most[i]), int(place[i] - least[i] + window)


def repeated_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """``_row, _spans``: byte ranges of each document covered by strings that occur again, packed."""
    rows = addressed(identified(docs, key, text), key, text)
    places = repeated_anchors(rows, _anchors(window, gram))
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = addressed(joined_by_row(docs.select(key, text), key, text, places, "inner"), key, text, "_places")
    runs = _sorted_runs(texts, window, gram, ranges)

    def merge(part: pa.Table) -> pa.Table:
        known = part.filter(pc.equal(part["_size"], 0)).select(["_row", "_spans"])
        found = list(_merge(part.filter(pc.greater(part["_size"], 0)), window, gram))
        owner, packed = _packed_spans(*(np.array(c, np.int64) for c in (zip(*found) if found else ([], [], []))))
        more = pa.table({"_row": pa.array(owner, pa.int64()), "_spans": pa.array(packed, pa.binary())})
        return pa.concat_tables([known, more])

    spans = runs.groupBy("_bucket").applyInArrow(merge, "_row bigint, _spans binary")
    return spans.groupBy("_row").agg(F.collect_set("_spans").alias("_spans"))


def dedup_bytes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """Documents without the bytes of strings that occur more than once.

    A byte of the UTF-8 text goes when a string of ``window`` bytes over it also starts anywhere
    else, in another document or in the same one; overlapping occurrences count, and strings are
    judged on the input. Returns the columns of ``docs`` with ``n_bytes``, ``spans`` (maximal
    removed runs as byte ranges ``start``, ``end``) and ``kept`` (binary: the other bytes on end,
    which may cut a character); columns with these names are replaced. A null or empty text has no
    bytes. Repeated rows are different places of their strings, so both lose what they share.
    """
    kept = [c for c in docs.columns if c not in ("n_bytes", "spans", "kept")]
    docs = docs.select(*kept)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    out = docs.withColumns(
        {
            "n_bytes": F.lit(None).cast("bigint"),
            "spans": F.lit(None).cast("array<struct<start:bigint,end:bigint>>"),
            "kept": F.lit(None).cast("binary"),
        }
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, bounds = joined(batch.column(text))
            whole = data.tobytes()
            spans, rests = [], []
            for i, marks in enumerate(batch.column("_spans").to_pylist()):
                own = whole[bounds[i] : bounds[i + 1]]
                merged: list[list[int]] = []
                pairs = [np.frombuffer(m, np.int32).reshape(-1, 2) for m in marks or ()]
                for low, high in sorted(map(tuple, np.concatenate(pairs).tolist())) if pairs else ():
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                edges = [0, *(x for m in merged for x in m), len(own)]
                rests.append(b"".join(own[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans.append([{"start": a, "end": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(np.diff(bounds)),
                    pa.array(spans, span_type),
                    pa.array(rests, pa.binary()),
                ],
                names=[*kept, "n_bytes", "spans", "kept"],
            )

    marks = repeated_bytes(docs, key, text, window, gram)
    return joined_by_row(docs, key, text, marks, "left").mapInArrow(run, out)


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes removed from every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return dedup_bytes(docs).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERY = op1_suffix_dedup
ORACLE = None
