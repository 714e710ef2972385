"""CSV files whose quoted fields contain line breaks, rewritten with one record per line.

A file is read as pieces that any task can take, so one large file is many tasks. A line break
belongs to a field when the number of quotes before it, from the start of the file on, is odd.
The quotes of every piece are counted first and added up over the pieces of a file; each piece then
knows whether it starts inside a field and puts its records together without moving a line. Only
records that cross a border between pieces are joined afterwards.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.storage import materialize

_PARTS = "source STRING, piece BIGINT, place BIGINT, value STRING, part STRING"
_ROWS_PER_BATCH = 20_000


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and piece they start in, and their order within the piece."""
    return spark.read.text(path).select(
        F.regexp_replace(F.col("_metadata.file_path"), "%20", " ").alias("source"),
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _pieces(lines: DataFrame) -> DataFrame:
    """Whether a piece starts inside a field: one row per piece, that is per ``maxPartitionBytes``."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    counted = lines.groupBy("source", "piece").agg(F.sum(quotes).alias("quotes"))
    earlier = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    return counted.select("source", "piece", (before % 2 == 1).alias("inside"))


def _rows(out: list[tuple]) -> pa.RecordBatch:
    names = ("source", "piece", "place", "value", "part")
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    columns = zip(*out) if out else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie within a piece, and the ``begin``, ``middle`` and ``end`` of those that do not.

    Parts keep their line breaks, because it is not known yet whether their record ever ends.
    """
    out: list[tuple] = []
    held: list[str] = []
    at = first = None
    inside = entered = False

    def leave_piece() -> None:
        if held:
            out.append((*at, first, "\n".join(held), "middle" if entered else "begin"))
            held.clear()

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("source", "piece", "place", "value", "inside")]
        for source, piece, place, value, starts_inside in zip(*columns):
            if at != (source, piece):
                leave_piece()
                at, inside, entered = (source, piece), starts_inside, starts_inside
            if not held:
                first = place
            held.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                text = "\n".join(held) if entered else "".join(held)
                out.append((source, piece, first, text, "end" if entered else None))
                held.clear()
                entered = False
            if len(out) >= _ROWS_PER_BATCH:
                yield _rows(out)
                out.clear()
    leave_piece()
    yield _rows(out)


def repaired_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(source, piece, place, value)``: one record per row, without the line breaks of its fields.

    ``piece`` and ``place`` give the order of records within their file. Line breaks outside of
    quotes and empty lines stay, and so do all lines of a record with a field that is never closed.
    A compressed file is one piece.
    """
    lines = _lines(spark, path)
    pieces = materialize(_pieces(lines), "pieces")
    # A broadcast keeps the order of lines; any other join is put in order again within its tasks.
    ordered = lines.join(pieces, ["source", "piece"]).sortWithinPartitions("source", "piece", "place")
    found = materialize(ordered.mapInArrow(_assemble, _PARTS), "record-parts")
    whole = found.where("part IS NULL").drop("part")
    parts = found.where("part IS NOT NULL")
    # Parts are told to records by their places alone, at most two for a piece; no text moves here.
    upto = Window.partitionBy("source").orderBy("piece", "place").rowsBetween(Window.unboundedPreceding, 0)
    begin = F.when(F.col("part") == "begin", F.struct("piece", "place"))
    records = (
        parts.select("source", "piece", "place", "part")
        .withColumn("record", F.last(begin, ignorenulls=True).over(upto))
        .withColumn("ends", F.max(F.col("part") == "end").over(Window.partitionBy("source", "record")))
    )
    placed = parts.join(materialize(records.drop("part"), "records-of-parts"), ["source", "piece", "place"])
    # A record that ends is one value of the result, so its parts fit where it fits.
    joined = (
        placed.where("ends")
        .groupBy("source", "record")
        .agg(F.sort_array(F.collect_list(F.struct("piece", "place", "value"))).alias("parts"))
        .select("source", "record.*", F.replace(F.array_join("parts.value", ""), F.lit("\n"), F.lit("")).alias("value"))
    )
    line = F.posexplode(F.split("value", "\n")).alias("line", "value")
    left = placed.where("NOT ends").select("source", "piece", "place", line)
    left = left.select("source", "piece", (F.col("place") + F.col("line")).alias("place"), "value")
    return whole.unionByName(joined).unionByName(left)


def _records(spark: SparkSession, path: str, header: bool, sep: str) -> DataFrame:
    """``source`` and a struct ``record`` with a text field for each column."""
    lines = repaired_lines(spark, path).where("value <> ''")
    begins = lines.groupBy("source").agg(F.min(F.struct("piece", "place")).alias("begin"))
    begins = materialize(begins, "first-records").select("source", "begin.*")
    sample = lines.join(begins.orderBy("source").limit(1), ["source", "piece", "place"], "left_semi").first()
    columns = next(csv.reader([sample["value"]], delimiter=sep)) if sample else []
    if header:
        lines = lines.join(begins, ["source", "piece", "place"], "left_anti")
    else:
        columns = [f"_c{i}" for i in range(len(columns))]
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    parsed = F.from_csv("value", F.lit(schema), {"sep": sep, "escape": '"'}) if columns else F.struct()
    return lines.select("source", parsed.alias("record"))


def read_repaired(spark: SparkSession, path: str, header: bool = True, sep: str = ",") -> DataFrame:
    """Records of CSV files as text columns, line breaks inside fields removed.

    Empty lines are no records and empty fields are null, as in Spark's own reader. Columns are
    named by the first record of the first file, ``_c0``, ``_c1``, ... without a header.
    """
    return _records(spark, path, header, sep).select("record.*")


def repair(spark: SparkSession, path: str, target: str, header: bool = True, sep: str = ",") -> None:
    """Write the repaired records, partitioned by the input file they came from."""
    records = _records(spark, path, header, sep)
    name = F.regexp_extract("source", r"([^/]+)$", 1).alias("source")
    (
        records.select("record.*", name)
        .write.partitionBy("source")
        .options(header=header, sep=sep, escape='"', nullValue="", emptyValue="")
        .csv(target)
    )
