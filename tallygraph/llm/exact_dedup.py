"""Documents that are equal up to white space, by an extendible-hash index on shared files.

Texts that a task sees more than once are folded into one entry, and the entries are written to
the shared folder. A directory over the leading bits of their hashes starts at the depth the
volume asks for and doubles wherever a bucket is overfull. A bucket is a range of hashes; each
owner task takes a range of buckets in hash order, chains the different texts of one hash and
compares their bytes. Owners see one entry per folded copy, never one row per document, and what
they find goes back to the entries by a key that no two entries share.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.text import slices
from tallygraph.session import table
from tallygraph.storage import checkpoint, materialize

BUCKET_BYTES = 8 << 20  # a bucket with more is split
MAX_DEPTH = 20  # of the directory, which so has at most 2^20 slots and may be broadcast
SPARE_DEPTH = 4  # bits by which the directory may outgrow the depth it starts with
FOLD_BYTES = 16 << 20  # texts a task folds at a time
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _rank(points: int, key, last: int) -> tuple:
    """The least rank stays: most code points, then smallest key (null last), then ``last``."""
    return -points, key is None, 0 if key is None else key, last


def _folded(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Entries ``text, keys, points, rows, best``: equal normalised texts of a task once."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(key, text).alias("row"))

    def entries(held: dict[bytes, tuple[list, list, list]], key_type: pa.DataType) -> pa.RecordBatch:
        lists = list(held.values())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.binary()),
                pa.array([x[0] for x in lists], pa.list_(key_type)),
                pa.array([x[1] for x in lists], pa.list_(pa.int64())),
                pa.array([x[2] for x in lists], pa.list_(pa.int64())),
                pa.array([min(map(_rank, x[1], x[0], range(len(x[0]))))[3] for x in lists], pa.int32()),
            ],
            names=["text", "keys", "points", "rows", "best"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple[list, list, list]] = {}
        size, key_type = 0, None
        for batch in slices(batches):
            key_type = batch.schema.field("key").type
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            for one, value, point, row in zip(
                batch.column("key").to_pylist(), raw, points, batch.column("row").to_pylist()
            ):
                plain = (value or b"").translate(None, WHITE_SPACE)
                if (known := held.get(plain)) is None:
                    held[plain] = known = ([], [], [])
                    size += len(plain)
                for own, item in zip(known, (one, point, row)):
                    own.append(item)
                size += 48
            if size > FOLD_BYTES:
                yield entries(held, key_type)
                held, size = {}, 0
        if held:
            yield entries(held, key_type)

    schema = f"text binary, keys array<{kind}>, points array<bigint>, rows array<bigint>, best int"
    found = rows.mapInArrow(run, schema)
    return found.select(
        F.monotonically_increasing_id().alias("entry"),
        F.xxhash64("text").alias("hash"),
        F.sha2("text", 256).alias("sha"),
        F.octet_length("text").alias("size"),
        "*",
    )


@dataclass(frozen=True)
class Directory:
    """``slots`` (slot, bucket, depth): the bucket that each value of the leading bits points to."""

    slots: DataFrame
    bits: int

    def slot(self):
        """The leading bits of ``hash``."""
        return F.shiftrightunsigned("hash", 64 - self.bits)


def directory(entries: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> Directory:
    """Directory of ``entries`` (hash, size) in which no bucket has more than ``bucket_bytes``.

    Buckets whose leading bits are used up, as with one long text, stay overfull; the chains of
    the owners serve them. Where 2^20 slots are too few for the volume, buckets grow with it.
    """
    total = entries.agg(F.sum("size")).first()[0] or 0
    bits = min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, total / bucket_bytes)))) + SPARE_DEPTH)
    limit = max(bucket_bytes, total >> (MAX_DEPTH - SPARE_DEPTH))
    start = max(0, bits - 2 * SPARE_DEPTH)
    slots = (
        entries.groupBy(F.shiftrightunsigned("hash", 64 - bits).alias("slot"))
        .agg(F.sum("size").alias("size"))
        .withColumn("depth", F.lit(start))
    )
    bucket = F.expr(f"shiftleft(shiftright(slot, {bits} - depth), {bits} - depth)")
    for depth in range(start, bits):
        slots = checkpoint(slots)
        held = F.sum("size").over(Window.partitionBy("depth", bucket))
        overfull = (F.col("depth") == depth) & (held > limit)
        slots = slots.withColumn("depth", F.col("depth") + F.when(overfull, 1).otherwise(0))
        slots = checkpoint(slots)
        if slots.where(F.col("depth") > depth).isEmpty():
            break
    return Directory(slots.select("slot", bucket.alias("bucket"), "depth"), bits)


@dataclass
class _Chain:
    """One text of a hash: its rows so far and the best of them."""

    text: bytes
    best: tuple
    count: int = 0
    entries: list[int] = field(default_factory=list)

    def add(self, rank: tuple, count: int) -> None:
        self.best = min(self.best, rank)
        self.count += count
        self.entries.append(rank[3])


def _met(index: DataFrame, kind: str) -> DataFrame:
    """``entry, group_size, keep_id, keep_entry`` of all entries that share a text with others."""

    def found(chains: list[_Chain]) -> list[tuple]:
        return [
            (entry, chain.count, None if chain.best[1] else chain.best[2], chain.best[3])
            for chain in chains
            if len(chain.entries) > 1
            for entry in chain.entries
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chains, out = None, [], []
        for batch in batches:
            key_type = batch.schema.field("key").type
            texts = batch.column("text")
            columns = ("hash", "entry", "points", "key", "count")
            for i, (hash_, entry, points, key, count) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in columns))
            ):
                if hash_ != last:
                    out += found(chains)
                    last, chains = hash_, []
                text = texts[i].as_py()
                rank = _rank(points, key, entry)
                for chain in chains:
                    if chain.text == text:
                        break
                else:
                    chain = _Chain(text, rank)
                    chains.append(chain)
                chain.add(rank, count)
            yield _verdicts(out, key_type)
            out = []
        if chains:
            yield _verdicts(found(chains), key_type)

    return index.mapInArrow(run, f"entry bigint, group_size bigint, keep_id {kind}, keep_entry bigint")


def _verdicts(rows: list[tuple], key_type: pa.DataType) -> pa.RecordBatch:
    entry, count, key, keep = zip(*rows) if rows else ((),) * 4
    types = (pa.int64(), pa.int64(), key_type, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(x, t) for x, t in zip((entry, count, key, keep), types)],
        names=["entry", "group_size", "keep_id", "keep_entry"],
    )


def _classified(docs: DataFrame, key: str, text: str, bucket_bytes: int) -> DataFrame:
    entries = materialize(_folded(docs, key, text), "exact-entries")
    found = directory(entries.select("hash", "size"), bucket_bytes)
    slots = materialize(found.slots, "exact-directory")
    owners = max(1, slots.select("bucket").distinct().count())
    index = entries.select(
        "hash",
        "entry",
        "text",
        F.expr("points[best]").alias("points"),
        F.expr("keys[best]").alias("key"),
        F.size("keys").cast("bigint").alias("count"),
        found.slot().alias("slot"),
    ).join(F.broadcast(slots.select("slot", "bucket")), "slot")
    # Owners take equal ranges of the directory; a bucket belongs to the owner of its first slot.
    owner = F.floor(F.col("bucket") * owners / (1 << found.bits)).cast("int")
    index = index.repartitionById(owners, owner).sortWithinPartitions("hash").drop("slot", "bucket")
    kind = docs.schema[key].dataType.simpleString()
    met = _met(index, kind)
    rows = entries.select("entry", "sha", "keys", "points", "rows", "best").join(met, "entry", "left")
    return rows.select(
        "*", F.expr("posexplode(arrays_zip(keys, rows)) AS (_at, _one)")
    ).select(
        F.col("_one.keys").alias(key),
        F.when(F.col("keep_entry").isNull(), F.expr("keys[best]")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.size("keys").cast("bigint")).alias("group_size"),
        ((F.col("_at") == F.col("best")) & (F.coalesce("keep_entry", "entry") == F.col("entry"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("_one.rows").alias("_row"),
    )


def exact_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal when they are identical once space, tab, line feed, vertical tab, form feed and
    carriage return are deleted; a null text is an empty one. Of equal texts the row with the most
    code points in its original text stays, then the one with the smallest key, a null key after
    all others. Of rows that agree in both, repeated rows included, exactly one stays. Other
    columns of ``docs`` are not read. A text of any length is one entry; an empty table has no rows.
    """
    return _classified(docs, key, text, bucket_bytes).drop("_row")


def dedup_exact(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_classes` keeps, with all their columns.

    Of repeated rows that differ in other columns only, any one stays.
    """
    kept = _classified(docs, key, text, bucket_bytes).where("kept").select(F.col("_row").alias("_kept"))
    whole = docs.select(F.xxhash64(key, text).alias("_row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    one = whole.join(kept, F.col("_row") == F.col("_kept"), "left_semi").groupBy("_row").agg(F.any_value("_doc").alias("_doc"))
    return one.select(*[F.col(f"_doc.`{c}`") for c in docs.columns])


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every document and whether it stays."""
    return exact_classes(table(spark, folder, "documents"))


QUERY = op13_exact_dedup
ORACLE = r"""
WITH plain AS (
  SELECT doc_id, coalesce(length(text), 0) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
ranked AS (
  SELECT doc_id, norm, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM plain WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""
