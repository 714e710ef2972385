"""URL rules, search, decontamination, tokens and classifiers."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallygraph.llm import byte_pairs, decontaminate, metric_search, quality, toxicity, url_rules
from tests.llm import brute

LABELLED = "/root/testdata/sf0.01"


def test_url_rules(spark, rows):
    urls = [
        ("https://WWW.Example.com/en/a?q", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("http://x.example.com/en/", "x.example.com", "/en/", "example.com/en/", "block"),
        ("http://example.com/fr", "example.com", "/fr", "com/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("http://com", "com", "", None, "deny"),
        ("http://a.net/es/#x", "a.net", "/es/", "net/es/", "block"),
        ("http://a.net/ES/", "a.net", "/ES/", None, "deny"),
        ("http://net-x.org/es/", "net-x.org", "/es/", None, "deny"),
        ("http://example.com./en/", "example.com.", "/en/", None, "deny"),
        ("http://É.net?/es/", "É.net", "", None, "deny"),
        ("no scheme", "", "", None, "deny"),
        ("", "", "", None, "deny"),
        (None, "", "", None, "deny"),
    ]
    pages = spark.createDataFrame([(u[0], "clash", i) for i, u in enumerate(urls)], "url STRING, host STRING, n INT")
    pages = pages.unionByName(pages)
    rules = spark.createDataFrame(
        [*url_rules.RULES, ("com", "/", "block"), (None, "/", "block"), ("a/b", "/", "block"), ("COM", "/", "allow")],
        "host STRING, path STRING, verdict STRING",
    )
    found = url_rules.judge_urls(pages, rules, default="deny")
    want = sorted([(*u, i) for i, u in enumerate(urls)] * 2, key=repr)
    assert rows(found, "url", "host", "path", "rule", "verdict", "n") == want
    assert url_rules.judge_urls(pages, rules.limit(0)).where("verdict != 'allow'").isEmpty()
    assert url_rules.judge_urls(pages.limit(0), rules).isEmpty()


@pytest.mark.parametrize("seed,leaf", [(1, 4), (2, 160)])
def test_metric_search(spark, rows, monkeypatch, seed, leaf):
    monkeypatch.setattr(metric_search, "LEAF_ROWS", leaf)
    monkeypatch.setattr(metric_search, "BLOCK_ROWS", 60)
    rng = np.random.default_rng(seed)
    vectors = {i: rng.normal(size=6).round(3).tolist() for i in range(150)}
    vectors.update({i: vectors[7] for i in range(200, 260)})  # a very common vector
    vectors.update({300: [0.0] * 6, 301: [5.0] * 6})
    data = [*vectors.items(), (301, vectors[301]), (400, None), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (None, vectors[0])]
    data += [(402, [float("nan")] * 6), (403, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (404, [1.0, 2.0]), (405, []), (410, [])]
    frame = spark.createDataFrame(data, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("score", F.lit("clash"))
    whole = {i: np.floor(np.array(v) * 1024).astype(np.int64) for i, v in vectors.items()}
    want = []
    for q in (i for i in whole if i % 10 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:10]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    want.append((410, 1, 405, 0))  # the empty vectors find each other
    found = metric_search.top_k(frame.where("vec_id % 10 = 0"), frame)
    assert rows(found.where("query_id != 400"), "query_id", "rank", "vec_id", "score") == sorted(want, key=repr)
    assert metric_search.top_k(frame, frame.limit(0)).isEmpty()


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(4)
    sequence = rng.integers(2, 6, 400)
    sequence[[50, 51, 200]] = 1
    index = decontaminate.FMIndex(sequence)
    patterns = np.array([[a, b, c] for a in range(2, 7) for b in range(2, 6) for c in range(2, 6)])
    low, high = index.search(patterns)
    for pattern, a, b in zip(patterns, low, high):
        want = [i for i in range(398) if (sequence[i : i + 3] == pattern).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_decontamination(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)  # several blocks of items
    rng = random.Random(6)
    vocabulary = ["alpha", "Beta", "gamma", "naïve", "x1", "delta", "eps"]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, draw(rng.randrange(5, 60))) for i in range(25)]
    items += [(90, None), (91, "?!"), (None, "alpha beta"), (92, "unseen words only"), (3, items[4][1])]
    docs = [(i, draw(rng.randrange(0, 80)) + " " + rng.choice(items[:25])[1][rng.randrange(30) :]) for i in range(60)]
    docs += [(70, None), (71, ""), (72, items[0][1].upper()), (73, "-".join(items[1][1].split())), (74, draw(9000))]
    frame = spark.createDataFrame([*docs, docs[5]], "doc_id BIGINT, text STRING").withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    found = decontaminate.contamination(decontaminate.find_passages(frame, bench)).collect()
    want = brute.contamination(docs, items)
    assert len(found) == len(docs) + 1
    for r in found:
        n, spans, own = want[r["doc_id"]]
        hit = sum(b - a for a, b in spans)
        assert (r["n_words"], [tuple(s) for s in r["spans"]], sorted(r["items"])) == (n, spans, own)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
    none = decontaminate.find_passages(frame, bench.limit(0))
    assert none.where("size(spans) + size(items) > 0").isEmpty()
    assert decontaminate.find_passages(frame.limit(0), bench).isEmpty()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(9)
    pool = [chr(c) for c in range(0x20, 0x17F)] + list(" \n\t\r\x0b\x1c\x85 　 '") * 12
    pool += ["'s", "'re", "<|endoftext|>", "漢", "😀", "́", "٣", "Ⅷ", "²", "the", " of", "tion"] * 8
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(50))) for _ in range(1500)]
    return [*texts, "", "a" * 3000, " " * 500, "ab" * 900 + " x", "<|endoftext|><|endoftext|>", "x  ", " \n a"]


def test_tokens_equal_the_library(tokenizer):
    vocabulary = byte_pairs.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts()
    for text, packed in zip(texts, vocabulary.encode(texts)):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == want
        assert vocabulary.decode(packed) == tokenizer.decode(want, skip_special_tokens=False) == text


def test_tokens_without_room_for_caches(tokenizer, monkeypatch):
    monkeypatch.setattr(byte_pairs, "CACHED_WORDS", 10)
    monkeypatch.setattr(byte_pairs, "CACHED_PAIRS", 10)
    vocabulary = byte_pairs.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    for text in odd_texts()[:200]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(vocabulary.encode([text])[0], "<u4").tolist() == want


def test_short_words_are_not_taken_one_at_a_time(tokenizer, monkeypatch):
    """Proposals and merges of all new words of a slice run together; only long words go alone."""
    vocabulary = byte_pairs.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    alone = []
    for name in ("propose", "merge"):
        plain = getattr(vocabulary, name)
        monkeypatch.setattr(vocabulary, name, lambda word, plain=plain: alone.append(word) or plain(word))
    rng = random.Random(4)
    parts = ["tha", "inwh", "ouen", "\u00e9", "\u00f1a", "T", "\u00df", "q", "zx", "\u00d7", "\u00f7", "\u00aa"]
    ends = ["", "", ",", ".%%%", "'s", "'", "_x", "\\", "1", "*** "]
    texts = [
        " ".join("".join(rng.choices(parts, k=rng.randrange(1, 9))) + rng.choice(ends) for _ in range(30))
        for _ in range(60)
    ]
    for _ in range(2):  # the second time from memory
        for text, packed in zip(texts, vocabulary.encode(texts)):
            assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not alone
    text = " ".join(f"{'ab' * n}" for n in (30, 31, 32, 33, 34, 700))  # on both sides of 64 bytes
    assert np.frombuffer(vocabulary.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert {len(w) for w in alone} >= {67, 1401} and min(map(len, alone)) > byte_pairs.SHORT_WORD


def test_token_columns(spark):
    data = [(1, "Hello world"), (2, None), (3, ""), (1, "Hello world")]
    frame = spark.createDataFrame(data, "doc_id BIGINT, text STRING").withColumn("ids", F.lit("clash"))
    back = byte_pairs.decode(byte_pairs.encode(frame)).withColumn("n", byte_pairs.token_count())
    assert sorted((r["doc_id"], r["decoded"], r["n"]) for r in back.collect()) == [
        (1, "Hello world", 2), (1, "Hello world", 2), (2, "", 0), (3, "", 0)
    ]
    assert byte_pairs.encode(frame.limit(0)).isEmpty()


def plain_kernel(s, t, decay):
    def embed(x):
        out = {}
        for i in range(len(x)):
            for j in range(i + 1, len(x)):
                for k in range(j + 1, len(x)):
                    key = x[i], x[j], x[k]
                    out[key] = out.get(key, 0.0) + decay ** (k - i + 1)
        return out

    a, b = embed(s), embed(t)
    return sum(v * b.get(k, 0.0) for k, v in a.items())


def test_subsequence_kernel():
    rng = random.Random(1)
    pairs = [["".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in "st"] for _ in range(50)]
    left = toxicity._padded([a.encode() for a, _ in pairs], -1)
    right = toxicity._padded([b.encode() for _, b in pairs], -2)
    got = toxicity.subsequence_kernel(left, right, 0.5)
    assert np.allclose(got, [plain_kernel(a, b, 0.5) for a, b in pairs])
    close = toxicity.normalised_kernel([b"stupid", b"stuupid", b"stones"], [b"stupid"] * 3)
    assert close[0] == pytest.approx(1) and close[0] > close[1] > 0.7 > close[2]


def test_toxicity_learns_and_tolerates():
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choice(["the", "river", "and", "stones", "quietly", "went"]) for _ in range(12))
    bad = ["grublox", "snarfle"]
    texts = [plain() + ". " + (rng.choice(bad) + " " if i % 4 == 0 else "") + plain() for i in range(400)]
    labels = np.array([i % 4 == 0 for i in range(400)], np.int64)
    model = toxicity.fit(texts, labels)
    scores = model.scores(pa.array([*texts, "", None, "GRUBLOX!!", "you grubblox", "a snarfles"]))
    assert ((scores[:400] >= 0.7) == labels).all()
    assert scores[400] == scores[401] == scores.min()
    assert (scores[402:] > 0.5).all()


def test_toxicity_finds_gapped_insults():
    rng = random.Random(3)
    plain = lambda: " ".join(rng.choice(["the", "river", "and", "stones", "quietly", "went"]) for _ in range(12))
    bad = ["scum", "moron", "stupid", "pathetic"]
    texts = [plain() + ". " + (rng.choice(bad) + " " if i % 4 == 0 else "") + plain() for i in range(400)]
    model = toxicity.fit(texts, np.array([i % 4 == 0 for i in range(400)], np.int64))
    for word in bad:
        forms = [word[:2] + "." + word[2:], word[:1] + "*" + word[1:3] + "*" + word[3:], "-".join(word), " ".join(word)]
        forms += [word[:2] + "x" + word[2:], word[:1] + "x" + word[1:3] + "x" + word[3:], "super" + word]
        assert (model.scores(pa.array([plain() + " " + f + " " + plain() for f in forms])) >= 0.7).all()
    assert (model.scores(pa.array(["s t o n e s", "the st.on.es went", plain()])) < 0.7).all()


def test_classifiers_without_labels():
    for fit in (toxicity.fit, quality.fit):
        for texts, labels in (([], []), (["a b", "c"], [0, 0])):
            scores = fit(texts, np.array(labels, np.int64)).scores(pa.array(["x", None, ""], pa.string()))
            assert ((scores >= 0) & (scores <= 1)).all() and len(set(scores.tolist())) == 1


def test_attention_gradients():
    rng = np.random.default_rng(0)
    rows, begin = rng.normal(size=(9, 5)), np.array([0, 2, 3, 7])
    labels, cost = np.array([0.0, 1.0, 1.0, 0.0]), np.full(4, 0.25)
    net = quality.Network.start(rows)

    def loss():
        p = net.forward(rows, begin)["score"]
        return -(cost * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum()

    for name, gradient in net.gradients(rows, begin, labels, cost).items():
        weight = net.weights[name]
        at = tuple(0 for _ in weight.shape)
        weight[at] += 1e-6
        up = loss()
        weight[at] -= 2e-6
        down = loss()
        weight[at] += 1e-6
        assert (up - down) / 2e-6 == pytest.approx(gradient[at], abs=1e-6)


def test_quality_finds_the_bad_passage():
    rng = random.Random(3)
    good = lambda n: " ".join(rng.choice(["the", "river", "and", "stones,", "went."]) for _ in range(n))
    texts = [good(rng.randrange(1, 300)) + (" | | ##".join("AB CD EF".split() * 20) if i % 3 == 0 else "") for i in range(240)]
    labels = np.array([i % 3 != 0 for i in range(240)], np.int64)
    net = quality.fit(texts, labels)
    assert ((net.scores(pa.array(texts)) >= 0.5) == labels).mean() > 0.97
    for share in net.attention(pa.array([*texts[:5], "", None])):
        assert share.sum() == pytest.approx(1)


@pytest.mark.parametrize(
    "query,label,least", [(toxicity.op9_toxicity, "toxic", 0.9), (quality.op10_quality, "quality", 0.95)]
)
def test_held_out_accuracy(spark, query, label, least):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    found = query(spark, LABELLED)
    assert found.count() == spark.read.parquet(f"{LABELLED}/documents.parquet").count()
    held = found.where("held_out").join(labels, "doc_id").select((F.col("predicted") == F.col(label)).cast("int"))
    assert held.groupBy().avg().first()[0] > least
