"""SimHash fingerprints and their near-duplicate components by a binary trie self-join.

Two fingerprints that differ in at most ``d`` of 64 bits agree on one of ``d + 1`` blocks of bits,
so each distinct fingerprint goes to one trie per block value. Within a trie, pairs of nodes are
walked together from the root: the bits in which their paths differ are added up, and a pair is
left as soon as it exceeds ``d``. Only a spanning forest of the links of a trie is passed on, and a
pair of subtrees that already belong to one component is not walked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.graph.components import connected_components
from tallygraph.llm.text import SPACE, joined, slices, words
from tallygraph.session import table
from tallygraph.storage import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
TRIE_ROWS = 100_000  # fingerprints whose tries are walked at once, whole tries only
HOT_TRIE = 200_000  # a larger trie is dealt out once more, by the blocks of its remaining bits
PAIRS = 1 << 17  # node pairs expanded at once


def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """64-bit SimHash of every text."""
    data, bounds = joined(texts)
    data = _LOWER[data]
    start, end, doc = words(data, bounds, SPACE)
    n_docs = len(bounds) - 1
    prints = np.zeros(n_docs, np.uint64)
    if not len(start):
        return prints
    # All words with one space after each, whatever stood between them.
    size = end - start + 1
    place = np.cumsum(size) - size
    source = np.arange(int(size.sum())) - np.repeat(place - start, size)
    source[place + size - 1] = 0
    normal = data[source]
    normal[place + size - 1] = 32
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    count = np.diff(first)
    shingles = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
    from_ = np.cumsum(shingles) - shingles
    word = np.arange(int(shingles.sum())) - np.repeat(from_ - first[:-1], shingles)
    last = word + np.repeat(np.minimum(count, shingle), shingles) - 1
    whole, digest = normal.tobytes(), xxhash.xxh64_intdigest
    begin, stop = place[word].tolist(), (place[last] + size[last] - 1).tolist()
    hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(begin, stop)], np.uint64)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    full = np.flatnonzero(shingles)
    ones = np.add.reduceat(bits, from_[full], axis=0, dtype=np.int64)
    major = (2 * ones > shingles[full][:, None]).astype(np.uint8)
    prints[full] = np.packbits(major, axis=1, bitorder="little").view("<u8")[:, 0]
    return prints


def fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE, column: str = "fingerprint"
) -> DataFrame:
    """Add the SimHash of every whole text as a signed 64-bit number.

    Words are runs of anything but ASCII space, A-Z lower-cased; shingles count as often as they
    occur. Fewer words than ``shingle`` are one shingle, a text without words (or null) has
    fingerprint zero.
    """
    rows = docs.drop(column)
    schema = rows.withColumn(column, F.lit(None).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            prints = fingerprints_of(batch.column(text), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints)], names=[*batch.schema.names, column]
            )

    return rows.mapInArrow(run, schema)


def _blocks(max_bits: int, total: int = 64) -> list[tuple[int, int]]:
    """Lowest bit and width of ``max_bits + 1`` blocks that make up ``total`` bits."""
    edges = [total * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


class _Forest:
    """Components found so far among sorted fingerprints, as a label per place."""

    def __init__(self, size: int):
        self.label = np.arange(size)
        self.links: list[tuple[int, int]] = []
        self._mark()

    def _mark(self) -> None:
        change = np.append(np.flatnonzero(self.label[1:] != self.label[:-1]) + 1, len(self.label))
        self.run_end = change[np.searchsorted(change, np.arange(len(self.label)), "right")]

    def known(self, a0, a1, b0, b1) -> np.ndarray:
        """Which node pairs lie within one component altogether."""
        run, label = self.run_end, self.label
        return (run[a0] >= a1) & (run[b0] >= b1) & (label[a0] == label[b0])

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        fresh = self.label[a] != self.label[b]
        if not fresh.any():
            return
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        pairs = zip(a[fresh].tolist(), b[fresh].tolist(), self.label[a[fresh]].tolist(), self.label[b[fresh]].tolist())
        for i, j, x, y in pairs:
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((i, j))
        if parent:
            new = np.arange(len(self.label))
            for x in parent:
                new[x] = root(x)
            self.label = new[self.label]
            self._mark()


def trie_links(prints: np.ndarray, trie: np.ndarray, budget: int) -> np.ndarray:
    """Spanning links of the fingerprints that differ in at most ``budget`` bits within a trie.

    ``prints`` are sorted and distinct within each run of equal ``trie``. Returns index pairs.
    """
    size = len(prints)
    forest = _Forest(size)
    first = np.flatnonzero(np.concatenate(([True], trie[1:] != trie[:-1])))
    last = np.append(first[1:], size)
    ones_before: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in ones_before:
            counts = np.zeros(size + 1, np.int32)
            np.cumsum((prints >> np.uint64(bit)) & np.uint64(1), out=counts[1:])
            ones_before[bit] = counts
        return ones_before[bit]

    # Node pairs (a, b) as ranges of places, with the bits that differ so far; a = b for one node.
    more = last - first > 1
    stack = [(63, first[more], last[more], first[more], last[more], np.zeros(int(more.sum()), np.int64))]
    while stack:
        bit, a0, a1, b0, b1, differ = stack.pop()
        if len(a0) > PAIRS:
            stack.append((bit, a0[PAIRS:], a1[PAIRS:], b0[PAIRS:], b1[PAIRS:], differ[PAIRS:]))
            a0, a1, b0, b1, differ = (x[:PAIRS] for x in (a0, a1, b0, b1, differ))
        open_ = ~forest.known(a0, a1, b0, b1)
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        leaf = open_ & single & (a0 != b0)
        near = leaf.copy()
        near[leaf] = _popcount(prints[a0[leaf]] ^ prints[b0[leaf]]) <= budget
        forest.link(a0[near], b0[near])
        go = open_ & ~single
        if bit < 0 or not go.any():
            continue
        a0, a1, b0, b1, differ = (x[go] for x in (a0, a1, b0, b1, differ))
        count = ones(bit)
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        self_ = a0 == b0
        cross = [
            np.concatenate(x)
            for x in zip(
                (a0[~self_], am[~self_], b0[~self_], bm[~self_], differ[~self_]),
                (am[~self_], a1[~self_], bm[~self_], b1[~self_], differ[~self_]),
                (a0, am, bm, b1, differ + 1),
                (am[~self_], a1[~self_], b0[~self_], bm[~self_], differ[~self_] + 1),
            )
        ]
        keep = (cross[1] > cross[0]) & (cross[3] > cross[2]) & (cross[4] <= budget)
        if keep.any():
            stack.append((bit - 1, *(x[keep] for x in cross)))
        own0 = np.concatenate((a0[self_], am[self_]))
        own1 = np.concatenate((am[self_], a1[self_]))
        keep = own1 - own0 > 1
        if keep.any():
            zero = np.concatenate((differ[self_], differ[self_]))[keep]
            stack.append((bit - 1, own0[keep], own1[keep], own0[keep], own1[keep], zero))
    return np.array(forest.links, np.int64).reshape(-1, 2)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``src``, ``dst`` that connect all fingerprints ``id`` within ``max_bits`` of another.

    ``prints`` has distinct ids. Of the links inside one trie a spanning forest is returned: fewer
    rows than fingerprints, and the same components as all links.
    """
    rests = [F.struct(*x) for x in _block_keys(max_bits)]
    tries = prints.select("id", F.explode(F.array(*rests)).alias("_t")).select("id", "_t.*")
    hot = tries.groupBy("trie").count().where(F.col("count") > HOT_TRIE).select("trie", F.lit(True).alias("hot"))
    # In a hot trie the budget holds for the remaining bits alone: deal it out by their blocks.
    parts = [
        F.lit(j << 32).cast("bigint") + F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << width) - 1))
        for j, (low, width) in enumerate(_blocks(max_bits, 64 - 64 // (max_bits + 1)))
    ]
    part = F.when(F.col("hot"), F.array(*parts)).otherwise(F.array(F.lit(-1).cast("bigint")))
    dealt = tries.join(hot, "trie", "left").select("id", "trie", F.explode(part).alias("part"))
    dealt = dealt.repartition("trie", "part").sortWithinPartitions("trie", "part")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, group in _whole_groups(batches):
            order = np.lexsort((ids, group))
            ids, group = ids[order], group[order]
            links = trie_links(ids, group, max_bits)
            out = ids.view(np.int64)[links]
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["src", "dst"])

    return dealt.mapInArrow(walk, "src bigint, dst bigint")


def _block_keys(max_bits: int):
    """Per block: its number and value as one key, and the remaining bits closed up."""
    for block, (low, width) in enumerate(_blocks(max_bits)):
        bits = F.shiftrightunsigned("id", low).bitwiseAND(F.lit((1 << width) - 1))
        below = F.col("id").bitwiseAND(F.lit((1 << low) - 1).cast("bigint"))
        above = F.shiftrightunsigned("id", low + width) if low + width < 64 else F.lit(0).cast("bigint")
        rest = F.shiftleft(above, low).bitwiseOR(below) if low else above
        yield (F.lit(block << 32).cast("bigint") + bits).alias("trie"), rest.alias("rest")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a partition sorted by (trie, part), in runs of whole groups."""

    def flush(kept: list) -> tuple[np.ndarray, np.ndarray]:
        ids, trie, part = (np.concatenate(x) for x in zip(*kept))
        new = np.concatenate(([True], (trie[1:] != trie[:-1]) | (part[1:] != part[:-1])))
        return ids, np.cumsum(new)

    kept, held = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, trie, part = (batch.column(c).to_numpy(False) for c in ("id", "trie", "part"))
        ids = ids.astype(np.int64).view(np.uint64)
        if held >= TRIE_ROWS:
            # The group that is open goes on; everything before its first row is complete.
            new = np.flatnonzero((trie != kept[-1][1][-1]) | (part != kept[-1][2][-1]))
            if len(new):
                cut = int(new[0])
                kept.append((ids[:cut], trie[:cut], part[:cut]))
                yield flush(kept)
                kept, held = [], 0
                ids, trie, part = ids[cut:], trie[cut:], part[cut:]
        kept.append((ids, trie, part))
        held += len(ids)
    if kept:
        yield flush(kept)


def near_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Fingerprint and component of every document: ``key, fingerprint, component_id``.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits; a component
    is named by its smallest key (nulls are never smallest; a component of null keys only has
    none). Equal fingerprints are one row before anything is joined, so copies cost nothing; all
    documents without words share fingerprint zero. Every input row gives one row; columns named in
    ``carry`` stay beside the result.
    """
    prints = materialize(fingerprints(docs.select(key, text, *carry), text, shingle).drop(text), "fingerprints")
    distinct = prints.groupBy(F.col("fingerprint").alias("id")).agg(F.min(key).alias("_least"))
    distinct = materialize(distinct, "distinct-fingerprints")
    links = materialize(near_links(distinct.select("id"), max_bits), "fingerprint-links")
    labels = connected_components(links)
    named = distinct.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("_least").alias("component_id"))
    named = named.select("id", "component").join(least, "component").select(
        F.col("id").alias("fingerprint"), "component_id"
    )
    return prints.join(named, "fingerprint").select(key, "fingerprint", "component_id", *carry)


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = near_components(table(spark, folder, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id")


QUERY = op8_simhash
ORACLE = None
