"""Suffix, substring, line and SimHash deduplication against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygraph.llm import anchors, line_dedup, simhash, substring_dedup, suffix_dedup, text
from tallygraph.llm import rows as rows_of
from tests.llm import brute

RNG = random.Random(11)
WORDS = ["of", "the", "and", "été", "ungen", "ly", "ation", "x", "é", "漢字", "in", "er"]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "a", "en", "."]) for _ in range(n))


def corpus():
    """Copies, near copies, shared passages, one passage in a third of all documents, odd texts."""
    rng = random.Random(5)
    shared, common = prose(60, rng), prose(45, rng)
    docs = []
    for i in range(60):
        body = prose(rng.randrange(1, 90), rng)
        if i % 3 == 0:
            at = rng.randrange(len(body))
            body = body[:at] + " " + common + "\n" + body[at:]
        if i % 7 == 0:
            body += "\n" + shared[rng.randrange(20) :] + "\n" + prose(10, rng)
        docs.append((i, body))
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, docs[3][1][:-3] + "qqq"), (103, None), (104, "")]
    docs += [(105, " \n\t "), (106, "abc " * 300), (107, prose(4000, rng)), (None, docs[6][1])]
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(corpus(), "doc_id BIGINT, text STRING")
    # Names that the operators use themselves.
    return frame.withColumns({"n_words": F.lit("w"), "spans": F.lit(1), "kept": F.lit("k"), "n_lines": F.lit("l")})


def test_loser_tree_merges_runs():
    rng = random.Random(3)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(9))) for _ in range(n)) for n in (7, 0, 1, 30, 12)]
    shares = [[suffix_dedup.common(a, b) for a, b in zip([b"", *run], run)] for run in runs]
    merged = list(suffix_dedup.LoserTree(runs, shares))
    strings = [runs[r][i] for r, i, _ in merged]
    assert strings == sorted(s for run in runs for s in run)
    assert [n for _, _, n in merged] == [suffix_dedup.common(a, b) for a, b in zip([b"", *strings], strings)]


def test_front_coding_round_trip():
    strings = sorted(bytes([65 + i % 3]) * (i % 5) + b"tail" for i in range(20))
    assert suffix_dedup.decoded(*suffix_dedup.front_coded(strings)) == strings


def test_winnowing_takes_one_gram_of_every_window():
    grams = np.array([5, 3, 9, 1, 7, 7, 2, 8], np.uint64)
    chosen = text.winnow(grams, 3, np.ones(6, bool))
    for s in range(6):
        assert chosen[s + int(np.argmin(grams[s : s + 3]))]


@pytest.mark.parametrize("window,gram", [(40, 16), (25, 9), (400, 96)])
def test_bytes(docs, window, gram):
    found = suffix_dedup.dedup_bytes(docs, window=window, gram=gram)
    assert found.columns == ["doc_id", "text", "n_words", "n_lines", "n_bytes", "spans", "kept"]
    got = {r["doc_id"]: r for r in found.collect()}
    rows = corpus()
    for (i, raw), (spans, kept) in zip(rows, brute.repeated_bytes([t for _, t in rows], window)):
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == spans
        assert bytes(got[i]["kept"]) == kept
        assert got[i]["n_bytes"] == len((raw or "").encode())


def test_bytes_of_repeated_rows(spark):
    rows = [(1, "abcdefghij" * 5), (1, "abcdefghij" * 5), (2, prose(20)), (2, prose(30))]
    found = suffix_dedup.dedup_bytes(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), window=30, gram=10)
    assert [bytes(r["kept"]) for r in found.where("doc_id = 1").collect()] == [b"", b""]
    assert found.count() == 4


def test_repeated_rows_share_one_list_of_anchors(spark):
    text_ = prose(200)
    docs = spark.createDataFrame([(1, text_)] * 5 + [(2, text_ + " end")], "doc_id BIGINT, text STRING")
    rows = rows_of.addressed(rows_of.identified(docs, "doc_id", "text"), "doc_id", "text")
    for find in (suffix_dedup._anchors(40, 16), substring_dedup._anchors(20, 6)):
        lists = [r["_places"] for r in anchors.repeated_anchors(rows, find).collect()]
        assert len(lists) == 2 and all(len(x) == len(set(x)) > 5 for x in lists)
    marks = substring_dedup.repeated_windows(docs).collect()
    assert len(marks) == 1 and len(marks[0]["_places"]) + sum(len(m) // 4 for m in marks[0]["_marks"]) <= 200
    found = suffix_dedup.dedup_bytes(docs, window=40, gram=16)
    assert [bytes(r["kept"]) for r in found.where("doc_id = 1").collect()] == [b""] * 5


@pytest.mark.parametrize("window,gram", [(20, 6), (5, 2), (3, 3)])
def test_words(docs, window, gram):
    found = substring_dedup.dedup_passages(docs, window=window, gram=gram)
    got = {r["doc_id"]: r for r in found.collect()}
    for i, (kept, spans) in brute.repeated_words(corpus(), window).items():
        assert (got[i]["text"] or "") == " ".join(kept)
        assert [(s["start"], s["end"]) for s in got[i]["spans"]] == spans
        assert got[i]["n_words"] == len(kept) + sum(b - a for a, b in spans) == len(kept) + got[i]["n_removed"]
    assert got[103]["text"] is None


def test_words_of_repeated_rows(spark):
    passage = prose(40)
    rows = [(1, passage), (1, passage), (2, "first " + passage)]
    found = substring_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted((r["doc_id"], r["n_removed"]) for r in found.collect()) == [(1, 0), (1, 0), (2, 40)]


def lines_corpus():
    rng = random.Random(8)
    base = [prose(rng.randrange(2, 9), rng) for _ in range(40)]

    def changed(line):
        i, kind = rng.randrange(len(line)), rng.randrange(4)
        return [line[:i] + "é" + line[i + 1 :], line[:i] + line[i + 1 :], line[:i] + "q" + line[i:], line][kind]

    docs = [(i, "\n".join(changed(rng.choice(base)) for _ in range(rng.randrange(1, 7)))) for i in range(50)]
    docs += [(60, None), (61, ""), (62, "\n\n"), (63, "short\nshort"), (64, base[0] + "\n" + base[0] + "\n")]
    docs += [(65, "z" * 5000 + "\n" + "z" * 4999), (None, base[1] + "\n" + base[2][:-1])]
    return docs + [(70 + i, "the very common line of all\n" + prose(6, rng)) for i in range(30)]


@pytest.mark.parametrize("max_edits", [0, 1])
def test_lines(spark, max_edits):
    frame = spark.createDataFrame(lines_corpus(), "doc_id BIGINT, text STRING").withColumn("n_lines", F.lit("clash"))
    found = line_dedup.dedup_lines(frame, max_edits=max_edits)
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got == brute.deduped_lines(lines_corpus(), max_edits=max_edits)


def test_lines_of_repeated_rows(spark):
    rows = [(1, "one long line\nanother long line"), (1, "one long line\nanother long line"), (2, "one long lime")]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted((r["doc_id"], r["n_removed"], r["n_lines"]) for r in found.collect()) == [(1, 0, 2), (1, 0, 2), (2, 1, 1)]
    with pytest.raises(ValueError, match="max_edits"):
        line_dedup.dedup_lines(found, max_edits=2)


def test_trie_links_connect_what_links_connect():
    rng = random.Random(2)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 25)):
            prints.add(centre ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1))
    ids = np.array(sorted(prints), np.uint64)
    for budget in (0, 2, 4):
        links = simhash.trie_links(ids, np.zeros(len(ids), np.int64), budget)
        want = brute.components({i: int(v) for i, v in enumerate(ids)}, budget)
        parent = {i: i for i in range(len(ids))}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links.tolist():
            assert (int(ids[a]) ^ int(ids[b])).bit_count() <= budget
            x, y = root(a), root(b)
            assert x != y  # a forest
            parent[max(x, y)] = min(x, y)
        assert {i: root(i) for i in range(len(ids))} == want


@pytest.mark.parametrize("max_bits,hot", [(4, 200_000), (9, 3)])
def test_simhash(docs, max_bits, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT_TRIE", hot)
    rows = [(i, t) for i, t in corpus() if i is not None]
    found = simhash.near_components(docs.where("doc_id IS NOT NULL"), max_bits=max_bits).collect()
    prints = {i: brute.fingerprint(t) for i, t in rows}
    assert {r["doc_id"]: r["fingerprint"] % 2**64 for r in found} == prints
    assert {r["doc_id"]: r["component_id"] for r in found} == brute.components(prints, max_bits)


def test_simhash_of_null_keys_and_repeated_rows(spark):
    rows = [(None, "alone in its words here"), (None, None), (5, "x y z"), (5, "x y z"), (4, "")]
    found = simhash.near_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr)
    assert got == [(4, 4), (5, 5), (5, 5), (None, 4), (None, None)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert suffix_dedup.dedup_bytes(none).collect() == []
    assert substring_dedup.dedup_passages(none).collect() == []
    assert line_dedup.dedup_lines(none).collect() == []
    assert simhash.near_components(none).collect() == []
