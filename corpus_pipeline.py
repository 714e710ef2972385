"""The training-data pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.byte_pairs import decode, encode, token_count
from tallygraph.llm.decontaminate import contamination, find_passages
from tallygraph.llm.line_dedup import dedup_lines
from tallygraph.llm.simhash import near_components
from tallygraph.llm.toxicity import THRESHOLD, score_toxicity, train
from tallygraph.session import table
from tallygraph.storage import materialize


def _aside(docs: DataFrame, *used: str) -> DataFrame:
    """Only the used columns beside all others in one, so that no name can clash."""
    others = [c for c in docs.columns if c not in used]
    kept = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.lit(0)
    return docs.select(*used, kept.alias("_others"))


def _restored(found: DataFrame, docs: DataFrame, *used: str) -> DataFrame:
    return found.select(*[F.col(c) if c in used else F.col(f"_others.`{c}`").alias(c) for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, calls toxic go."""
    model = train(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(_aside(docs, "text"), model)
    return _restored(scored.where(F.col("score") < THRESHOLD), docs, "text")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one up to one edit go; every document stays, some shorter."""
    used = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    cleaned = dedup_lines(_aside(docs, *used))
    if "n_chars" in used:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return _restored(cleaned, docs, *used)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id.

    Documents without an id are never dropped; of rows that share the smallest id all stay. Rows
    are told apart by id and text, so a row that shares only its id with a copy stays.
    """
    row = F.xxhash64("doc_id", "text")
    found = near_components(_aside(docs, "doc_id", "text").withColumn("_row", row), carry=("_row",))
    losers = found.where("doc_id != component_id").select("_row").distinct()
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), row.alias("_row"))
    return marked.join(losers, "_row", "left_anti").select("_doc.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a benchmark covers at least a twentieth go; all others stay whole."""
    found = contamination(find_passages(_aside(docs, "text"), table(spark, sf_dir, "benchmark")))
    return _restored(found.where("NOT contaminated"), docs, "text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the digest of the text they decode to.

    ``ids`` are packed as little-endian unsigned 32-bit integers; ``ids``, ``n_tokens`` and
    ``decoded_sha256`` are replaced if present.
    """
    named = [c for c in docs.columns if c not in ("ids", "n_tokens", "decoded_sha256")]
    encoded = decode(encode(_aside(docs.select(*[F.col(f"`{c}`") for c in named]), "text")), text="_decoded")
    columns = [F.col("text") if c == "text" else F.col(f"_others.`{c}`").alias(c) for c in named]
    return encoded.select(
        *columns, "ids", token_count().alias("n_tokens"), F.sha2("_decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

# Learned scores, edit distances and merges have no SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return run(spark, folder)
