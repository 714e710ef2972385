"""Exact dedup, spelling groups and token alignment against plain versions, on odd and large inputs."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygraph.llm import exact_dedup, spelling, token_alignment
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, entry bigint, keys string, size string, word string, block string"


def frame(spark, rows):
    """Rows of key and text beside columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "x", "y", "z", "b") for r in rows], SCHEMA)


# exact dedup ------------------------------------------------------------------------------------

ODD_TEXTS = [
    (1, "a b c"), (2, "abc"), (3, "a\tb\n c "), (4, " a b c"), (4, "abc"), (5, None), (6, ""), (7, " \n"),
    (None, "a\tb\n c "), (None, "only"), (8, "a bc"), (9, "é è"), (10, "éè"), (9, "é è"), (9, "é è"),
    (11, "x" * 300_000), (12, "x " * 300_000), (13, "\x0b\x0cabc"), (14, "A b c"),
]


def classes(rows):
    """(key, keep_id, group_size, sha): kept rows by class."""
    groups = {}
    for key, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((key, text or ""))
    out = []
    for plain, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(key, best[0], len(members), brute.sha(plain)) for key, _ in members]
    return out


@pytest.mark.parametrize("bucket_bytes", [1, 1000, 1 << 20])
def test_exact_classes(spark, bucket_bytes):
    got = exact_dedup.exact_classes(frame(spark, ODD_TEXTS).repartition(5), bucket_bytes=bucket_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = got.collect()
    assert sorted(((r[0], r[1], r[2], r[4]) for r in rows), key=repr) == sorted(classes(ODD_TEXTS), key=repr)
    kept = [(r["text_sha256"], r["doc_id"]) for r in rows if r["kept"]]
    assert sorted(kept, key=repr) == sorted({(sha, keep) for _, keep, _, sha in classes(ODD_TEXTS)}, key=repr)


def test_exact_dedup_keeps_all_columns(spark):
    docs = frame(spark, ODD_TEXTS).withColumn("_row", F.lit("mine"))
    got = exact_dedup.dedup_exact(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert {r["_row"] for r in rows} == {"mine"}
    assert len(rows) == len({sha for *_, sha in classes(ODD_TEXTS)})
    assert ("a\tb\n c ", 3) in {(r["text"], r["doc_id"]) for r in rows}


def test_exact_classes_of_many_copies(spark):
    """A third of all rows is one text; every partition folds it and the owner sees few entries."""
    docs = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same  text")).otherwise(F.concat(F.lit("t "), "id")).alias("text"),
    )
    got = exact_dedup.exact_classes(docs.repartition(7), bucket_bytes=2000)
    sizes = got.groupBy("group_size", "keep_id").count().where("group_size > 1").collect()
    assert [tuple(r) for r in sizes] == [(3000, 0, 3000)]
    assert got.where("kept").count() == 6001


def test_directory_splits_overfull_buckets(spark):
    hashes = [(i << 40, 10) for i in range(2000)] + [(-(i << 50), 10) for i in range(100)] + [(5 << 60, 500)] * 3
    entries = spark.createDataFrame(hashes, "hash bigint, size bigint")
    found = exact_dedup.directory(entries, 600)
    assert found.bits <= exact_dedup.MAX_DEPTH
    held = (
        entries.withColumn("slot", found.slot()).join(found.slots, "slot").groupBy("bucket", "depth")
        .agg(F.sum("size").alias("size"), F.countDistinct("slot").alias("slots")).collect()
    )
    assert sum(r["size"] for r in held) == sum(s for _, s in hashes)
    assert all(r["size"] <= 600 or r["slots"] == 1 for r in held)
    assert len({r["depth"] for r in held}) > 1  # only overfull buckets are split


def test_exact_classes_chain_colliding_hashes(spark):
    rows = [(1, b"one", 0, 1, 4), (1, b"two", 1, 2, 3), (1, b"one", 2, 3, 5), (1, b"two", 4, 5, 3), (2, b"two", 3, 4, 3)]
    index = spark.createDataFrame(
        [(h, entry, text, points, key, 1) for h, text, entry, key, points in rows],
        "hash bigint, entry bigint, text binary, points bigint, key bigint, count bigint",
    ).coalesce(1)
    got = sorted(tuple(r) for r in exact_dedup._met(index, "bigint").collect())
    assert got == [(0, 2, 3, 2), (1, 2, 2, 1), (2, 2, 3, 2), (4, 2, 2, 1)]


def test_exact_classes_of_no_rows(spark):
    assert exact_dedup.exact_classes(frame(spark, [])).isEmpty()
    assert exact_dedup.dedup_exact(frame(spark, [])).isEmpty()


# spelling ---------------------------------------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def spellings(counts):
    """Every word against every other."""
    forms, out = {}, {}
    for w, n in counts.items():
        others = sorted((-m, o) for o, m in counts.items() if near(w, o))
        form = others[0][1] if others and -others[0][0] >= 2 * n else None
        forms[w] = form
        out[w] = (w, form, n, len(others), counts[form] if form is not None else None)
    rows = []
    for w, form, n, n_near, form_n in out.values():
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def test_count_words_against_plain_counts(spark):
    docs = [(i, f"Grün grün GRÜN x{i}y ÀB×c don't straße w{i} {'word ' * (i % 5)}" * 3) for i in range(150)]
    docs += [(None, "null id word word"), (3, None), (4, ""), (5, "word " * 100_000)]
    want = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    got = spelling.count_words(frame(spark, docs).repartition(3), "doc_id", "text").collect()
    assert {r["word"]: r["n"] for r in got} == want


@pytest.mark.parametrize("crowded", [1, 64])
def test_spellings_against_all_pairs(spark, monkeypatch, crowded):
    """Also where every signature counts as crowded and is split."""
    monkeypatch.setattr(spelling, "CROWDED", crowded)
    counts = {}
    for i in range(60):
        word = f"{'abcdefgh'[i % 8]}{'aeiou'[i % 5]}tten{'xyzé'[i % 4]}"
        counts[word] = 3 + i * i % 50
        counts[word[:2] + word[3:]] = 3 + i % 4
        counts[word + "s"] = 100 + i
    counts |= {"": 4, "a": 9, "aa": 20, "aaaaaa": 3, "aaaaaaa": 6, "ab": 40, "w" * 3000: 5, "w" * 2999: 50, "tie1": 8, "tie2": 8}
    rows = [(w, n, "x", "y") for w, n in counts.items()] + [(None, 5, "x", "y")]
    words = spark.createDataFrame(rows, "word string, n bigint, form string, key string")
    got = sorted(tuple(r) for r in spelling.group_spellings(words).collect())
    assert got == spellings(counts)


def test_spellings_of_odd_tables(spark):
    words = spark.createDataFrame([("apple", 2), ("apple", 3), ("appel", None), ("aple", 1)], "word string, n bigint")
    assert sorted(map(tuple, spelling.group_spellings(words).collect())) == spellings({"apple": 5, "appel": 0, "aple": 1})
    assert spelling.group_spellings(words.limit(0)).isEmpty()


def test_near_words_share_a_signature():
    words = ["grammar", "gramar", "grammer", "gremmer", "aaaaaa", "aaaaa", "baaaaa", "éaaaaa", "", "x", "xy"]
    for a, b in combinations(words, 2):
        left_out = 2 if len(a) == len(b) else 1
        if near(a, b):
            assert any(x == y for x, y in zip(spelling.signatures(a, left_out), spelling.signatures(b, left_out))), (a, b)
    assert [len(spelling.signatures("word", k)) for k in (2, 1)] == [10, 3]


# token alignment --------------------------------------------------------------------------------

ALIGNED_TEXTS = [
    (1, "Hello  world, naïve 日本語 😀!\n\ttabs"), (2, None), (3, ""), (4, " "), (5, "▁x not given back"),
    (6, "<|endoftext|> <s> <0x41> </s> <unk>"), (7, "the the the"), (7, "the the the"), (None, "the cat"),
    (8, "word" * 30_000), (9, "x" * 20_000 + "é" * 5000), (10, "\r\n\x0b\x00\x85 "), (11, "don't  stop 12345 ÄÖ"),
]


def alignments(rows):
    """Every token against every other of its document."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    as_byte = token_alignment._byte_characters()
    docs, counts = [], Counter()
    for key, text in rows:
        ids = a_lib.encode(" " + text, add_special_tokens=False) if text else None
        a = list(zip(ids.ids, [bytes(as_byte[c] for c in t) for t in ids.tokens])) if text else []
        b = []
        for i in b_lib.encode(text) if text else []:
            piece = b_lib.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()))
        raw = (" " + (text or "")).encode()
        if any(b"".join(t for _, t in side) != raw for side in (a, b)):
            a, b = [], []
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        cuts = [0, *sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})]
        lists = [[",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in spans] for lo, hi in zip(cuts, cuts[1:])] if len(raw) < 2000 else None
        links = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e] if len(raw) < 2000 else None
        if links is not None:
            counts.update(links)
        docs.append((key, len(a), len(b), len(cuts) - 1, links, lists))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return docs, counts, best


def test_alignment_against_all_pairs(spark):
    rows = [r for r in ALIGNED_TEXTS if len(r[1] or "") < 1000]
    docs, counts, best = alignments(rows)
    want = [
        (
            key, n_a, n_b, n_groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
            brute.sha(";".join("|".join(g) for g in lists)) if n_a else "",
        )
        for key, n_a, n_b, n_groups, links, lists in docs
    ]
    for block_bytes in (1, 1 << 20):
        got = token_alignment.align_tokens(frame(spark, rows).repartition(3), block_bytes=block_bytes)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_alignment_of_long_texts(spark):
    docs, *_ = alignments(ALIGNED_TEXTS)
    got = token_alignment.align_tokens(frame(spark, ALIGNED_TEXTS)).collect()
    assert sorted(map(repr, ((r[0], *r[1:4]) for r in got))) == sorted(map(repr, (d[:4] for d in docs)))
    assert all(r["n_links"] == max(0, r["n_a"] + r["n_b"] - r["n_groups"]) for r in got)
    assert {r["doc_id"]: r["n_a"] for r in got}[5] == 0


def test_alignment_of_texts_without_tokens(spark):
    assert token_alignment.align_tokens(frame(spark, [])).isEmpty()
    got = token_alignment.align_tokens(frame(spark, [(1, None), (2, "")])).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_alignment_query_against_all_pairs(spark):
    """The links of the whole table, counted apart from Spark."""
    folder = "/root/testdata/sf0.001"
    both = token_alignment.Tokenizers(*token_alignment._vocabulary_files(None, None))
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    encoded = {}
    for key, text in rows:
        encoded[key] = (
            both._bytes.encode(" " + text, add_special_tokens=False).ids, both._pieces.encode(text)
        )
    links, counts, best = {}, Counter(), Counter()
    for key, (a, b) in encoded.items():
        # The token of each byte on both sides; every pair that meets at some byte is one link.
        marks = [[n for n, i in enumerate(side) for _ in range(sizes[i])] for side, sizes in ((a, both.a_size), (b, both.b_size))]
        links[key] = [(a[x], b[y]) for x, y in sorted(set(zip(*marks)))]
        counts.update(links[key])
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    for r in token_alignment.QUERY(spark, folder).collect():
        own = links[r["doc_id"]]
        assert r["n_links"] == len(own) and r["count_sum"] == sum(counts[x] for x in own)
        assert r["n_best"] == sum(counts[x] == best[x[1]] for x in own)


def test_chunks_encode_like_whole_texts(spark):
    """Over whole texts of the table, and over texts of odd white space and long words."""
    both = token_alignment.Tokenizers(*token_alignment._vocabulary_files(None, None))
    assert both._ranked is not None and both._cuts
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    odd = ["a\u0085b c \u3000d  \x1c \x1f e\u200b ", "x" * 5000 + " y", "½Ⅷ٣ 'll'LL ''s", "\n \n  a \t b\n\n", "a  ", "   "]
    for text in [r["text"] for r in docs] + [t for _, t in ALIGNED_TEXTS] + odd:
        if text:
            a, b = (sum(x, []) for x in both.encode(both.chunks(text)))
            assert a == both._bytes.encode(" " + text, add_special_tokens=False).ids
            assert b == both._pieces.encode(text)


def test_new_chunks_are_aligned_together(monkeypatch):
    """One alignment for all new chunks of a slice, with the groups and links that each has by itself."""
    both = token_alignment.Tokenizers(*token_alignment._vocabulary_files(None, None))
    calls, plain = [], token_alignment.align
    monkeypatch.setattr(token_alignment, "align", lambda *args: calls.append(1) or plain(*args))
    rng = random.Random(7)
    parts = ["tha", "inwh", "ouen", "\u00e9", "\u6f22", "T", "\U0001f600", "q", "1", "***", "'s", "\n", "x "]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 7))) for _ in range(40)) for _ in range(80)]
    got = list(both.aligned(texts))
    assert len(calls) == 1
    for text, (n_a, n_b, n_groups, groups, links) in zip(texts, got):
        a, b = both._bytes.encode(" " + text, add_special_tokens=False).ids, both._pieces.encode(text)
        sides = [[n for n, i in enumerate(side) for _ in range(size[i])] for side, size in ((a, both.a_size), (b, both.b_size))]
        if len(sides[0]) != len(sides[1]):
            assert (n_a, links) == (0, b"")
            continue
        met = sorted(set(zip(*sides)))
        assert np.frombuffer(links, "<i8").tolist() == [a[x] << 32 | b[y] for x, y in met]
        want, own = [], ([], [])
        for at, (x, y) in enumerate(met):
            for side, n in zip(own, (x, y)):
                side.extend([n] if n not in side else [])
            if at + 1 == len(met) or met[at + 1][0] > x and met[at + 1][1] > y:
                want.append("|".join(",".join(str(ids[n]) for n in side) for ids, side in zip((a, b), own)))
                own = ([], [])
        assert (n_a, n_b, n_groups, groups.decode()) == (len(a), len(b), len(want), ";".join(want))


def test_chunks_are_cut_after_words():
    both = token_alignment.Tokenizers(*token_alignment._vocabulary_files(None, None))
    rng = random.Random(8)
    pool = ["a", "bc", " ", " ", "\n", "\u3000", "\u0085", "\x1c", "\u200b", "\t"]
    for text in ["", " ", "a ", " a", "a  b", "a\n b"] + ["".join(rng.choices(pool, k=rng.randrange(9))) for _ in range(3000)]:
        assert both.chunks(text) == token_alignment._WORD_END.split(f" {text}")


def test_alignment_starts_its_memory_anew(spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "CACHED_CHUNKS", 3)
    both = token_alignment.Tokenizers(*token_alignment._vocabulary_files(None, None))
    texts = ["the cat sat", "a dog", "the cat", "the hat and the mat"]
    one_by_one = [next(both.aligned([t])) for t in texts]
    assert one_by_one == list(both.aligned(texts)) and len(both._known) <= 8
