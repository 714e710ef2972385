"""Registered queries against their SQL or brute force, and the pipeline stage by stage."""

import importlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tallygraph.llm.registry import load
from tests.llm import brute
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]


def test_entry_lists_all():
    assert {int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, db, name):
    assert compare(db, ORACLES[name], QUERIES[name](spark, FOLDER)) is None


def test_suffix_query(spark, texts):
    got = {r["doc_id"]: r for r in QUERIES["op1_suffix_dedup"](spark, FOLDER).collect()}
    for (i, raw), (spans, kept) in zip(texts, brute.repeated_bytes([t for _, t in texts], 400)):
        row = got[i]
        assert (row["n_spans"], row["n_removed"]) == (len(spans), sum(b - a for a, b in spans))
        assert (row["n_bytes"], row["kept_sha256"]) == (len(raw.encode()), brute.sha(kept))


def test_decontamination_query(spark, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute.contamination(texts, items)
    for r in QUERIES["op5_decontaminate"](spark, FOLDER).collect():
        n, spans, own = want[r["doc_id"]]
        hit = sum(b - a for a, b in spans)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(own))
        assert r["items_sha256"] == brute.sha(",".join(own))
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_simhash_query(spark, texts):
    prints = {i: brute.fingerprint(t) for i, t in texts}
    labels = brute.components(prints, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_simhash"](spark, FOLDER).collect()}
    assert got == {i: (f"{prints[i]:016x}", labels[i]) for i, _ in texts}


def test_pipeline(spark):
    """Each stage against brute force on its own input; columns stay until the last stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("spans", F.lit("clash"))
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, FOLDER).cache()
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "toxicity":
            toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
            dropped = [toxic[i] for i in before.keys() - after.keys() if i in toxic]
            assert sum(dropped) > 0.5 * sum(toxic.values()) and len(dropped) - sum(dropped) <= 2
            assert all(before[i] == t for i, t in after.items())
        elif name == "line_dedup":
            assert after == brute.deduped_lines(list(before.items()))
            assert docs.where("n_chars != length(text)").isEmpty()
        elif name == "near_duplicates":
            labels = brute.components({i: brute.fingerprint(t) for i, t in before.items()}, 4)
            assert after == {i: t for i, t in before.items() if labels[i] == i}
        elif name == "decontamination":
            found = brute.contamination(list(before.items()), items)
            bad = {i for i, (n, spans, _) in found.items() if spans and 20 * sum(b - a for a, b in spans) >= n}
            assert after == {i: t for i, t in before.items() if i not in bad}
        else:
            assert after == before and docs.columns == [*columns, "ids", "n_tokens", "decoded_sha256"]
            library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
            for r in docs.collect():
                ids = library.encode(r["text"] or "", add_special_tokens=False).ids
                assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
                assert r["decoded_sha256"] == brute.sha(library.decode(ids, skip_special_tokens=False))
            continue
        assert docs.columns == columns


def test_near_duplicates_tell_rows_of_one_id_apart(spark):
    first, other = (" ".join(f"{w}{i}" for i in range(60)) for w in ("word", "thing"))
    docs = spark.createDataFrame([(1, first, "a"), (2, first, "b"), (2, other, "c"), (None, first, "d")], "doc_id long, text string, _row string")
    kept = corpus_pipeline.near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(r["_row"] for r in kept.collect()) == ["a", "c", "d"]


def test_stages_take_empty_tables_and_any_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(3)
    clash = docs.withColumns({c: F.lit("own") for c in ("_row", "_others", "_order", "score", "_decoded", "a.b")})
    for given in (docs.limit(0), clash):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, given, FOLDER)
            assert found.columns[: len(given.columns)] == given.columns, name
            rows = found.collect()
            assert all(r["a.b"] == r["_row"] == "own" for r in rows) if given is clash else not rows, name


def test_rest_of_the_library_does_without(monkeypatch):
    import builtins

    real = builtins.__import__

    def missing(name, *args, **kwargs):
        if name in ("corpus_pipeline", "tallygraph.llm.registry"):
            raise ModuleNotFoundError(name, name=name)
        return real(name, *args, **kwargs)

    monkeypatch.setattr(builtins, "__import__", missing)
    entry = importlib.reload(__spark_entry__)
    assert entry.queries() and not [q for q in entry.queries() if q.startswith("op1")]
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
