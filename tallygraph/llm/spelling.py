"""Spelling variants of words, by PartEnum signatures of their letter multisets.

A word is the binary vector of its letters, the second "e" being another dimension than the first.
Words with one character replaced differ in two dimensions, words with one inserted or deleted in
one. The dimensions are dealt out to parts; whichever two parts (or one) hold the differences, all
others agree, so near words share the signature of some choice of parts left out. Words of one
signature are joined and verified in the join. Signatures that many words share are split by the
half of the word that one edit leaves whole, its beginning or its end, so no near pair is lost.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.text import slices
from tallygraph.session import table
from tallygraph.storage import materialize

MIN_CHARS = 5
MIN_COUNT = 3
PARTS = {2: 5, 1: 3}  # of the dimensions, by how many of the parts are left out in turn
CROWDED = 64  # words of one signature from which on it is split; changes the plan, not the rows
HELD_WORDS = 200_000  # different words a task counts at a time
TYPOS = 97
_SAME, _SHORTER, _LONGER = range(3)
_ROLES = ((_SAME, "two"), (_SHORTER, "one"), (_LONGER, "one"))
_RUN = re.compile("[a-zÀ-ÿ]+")


def count_words(docs: DataFrame, key: str, text: str, typos: int = TYPOS) -> DataFrame:
    """``word, n`` of all runs of letters, A-Z lower-cased, each task counting before the shuffle.

    A run whose crc32 together with the key is a multiple of ``typos`` loses one character, which
    makes up for the misspellings that invented texts lack. A null key reads as empty.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text"))

    def counted(counts: Counter) -> pa.RecordBatch:
        columns = [pa.array(counts, pa.string()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in slices(batches):
            raw = batch.column("text").cast(pa.binary()).to_pylist()
            for key, value in zip(batch.column("key").to_pylist(), raw):
                own = Counter(_RUN.findall((value or b"").lower().decode()))  # bytes: A-Z only
                start = zlib.crc32(f"{key}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % typos == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    counts[word] += n
            if len(counts) > HELD_WORDS:
                yield counted(counts)
                counts.clear()
        yield counted(counts)

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(word: str, left_out: int) -> list[int]:
    """One 64-bit signature for each choice of ``left_out`` parts.

    The occurrences of a letter are dimensions of their own; each part holds its letters in order.
    """
    count = PARTS[left_out]
    parts = [""] * count
    seen: Counter[str] = Counter()
    for letter in sorted(word):
        parts[(ord(letter) + 3 * seen[letter]) % count] += letter
        seen[letter] += 1
    return [
        xxhash.xxh3_64_intdigest("\0".join(map(parts.__getitem__, chosen)), seed=number) - (1 << 63)
        for number, chosen in enumerate(combinations(range(count), count - left_out))
    ]


def _signed(words: DataFrame) -> DataFrame:
    """Words beside their signatures for two differences and for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            both = [pa.array([signatures(w, k) for w in texts], pa.list_(pa.int64())) for k in (2, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("word"), *both], names=["word", "two", "one"])

    return words.select("word").mapInArrow(run, "word string, two array<bigint>, one array<bigint>")


def near_words(words: DataFrame) -> DataFrame:
    """``word, other`` for all pairs of ``words`` one edit apart, in both directions."""
    # A word meets words of its own length, and as the shorter or longer of two those of another.
    meets = F.array(
        *[F.struct(F.lit(r).cast("byte").alias("role"), F.col(s).alias("signatures")) for r, s in _ROLES]
    )
    size = F.length("word") - (F.col("role") == _LONGER).cast("int")  # of the shorter of two
    keyed = (
        _signed(words)
        .select("word", F.explode(meets).alias("as"))
        .select("word", "as.role", F.explode("as.signatures").alias("signature"))
        .select("word", "role", F.xxhash64("signature", size, F.col("role") == _SAME).alias("key"))
    )
    # All that follows reads the one exchange by key.
    held = F.count(F.lit(1)).over(Window.partitionBy("key"))
    keyed = keyed.withColumn("held", held).where("held > 1")
    half = F.floor(size / 2).cast("int")
    halves = F.array(
        F.xxhash64("key", F.lit("begins"), F.substring("word", F.lit(1), half)),
        F.xxhash64("key", F.lit("ends"), F.substring("word", F.length("word") - size + half + 1, size - half)),
    )

    def met(rows: DataFrame) -> DataFrame:
        a, b = rows.alias("a"), rows.alias("b").hint("merge")
        one_way = (F.col("a.role") == _SAME) & (F.col("a.word") < F.col("b.word"))
        one_way |= (F.col("a.role") == _SHORTER) & (F.col("b.role") == _LONGER)
        pairs = a.join(b, F.col("a.key") == F.col("b.key")).where(
            one_way & (F.levenshtein("a.word", "b.word", 1) == 1)
        )
        return pairs.select(F.col("a.word").alias("word"), F.col("b.word").alias("other"))

    calm = keyed.where(F.col("held") <= CROWDED).select("key", "word", "role")
    crowded = keyed.where(F.col("held") > CROWDED).select(F.explode(halves).alias("key"), "word", "role")
    pairs = materialize(met(calm).unionByName(met(crowded)).distinct(), "spelling-pairs")
    return pairs.unionByName(pairs.toDF("other", "word"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms, by doubling the steps of every word.

    Each form is at least twice as common as its word, so chains have at most log2 of the greatest
    count steps, and rounds the logarithm of that.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        roots = materialize(roots, "spelling-roots")
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(ahead, "root", "left_semi").isEmpty():
            return roots
        roots = roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))


def group_spellings(words: DataFrame, word: str = "word", n: str = "n") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of a table of words and counts.

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. The
    form of a word is its most common near word (ties: smallest in code-point order) if that is at
    least twice as common, else null; the root is where its forms end, the word itself without one.
    Repeated words add up, a null count is 0, null words are left out; an empty word is a word like
    others. Other columns are not read. Words of any length take part; an empty table has no rows.
    """
    words = words.where(F.col(word).isNotNull()).groupBy(F.col(word).alias("word"))
    words = materialize(words.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n")), "spelling-words")
    counts = words.toDF("other", "other_n")
    near = near_words(words).join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("least"), F.col("other").alias("form"))).alias("best"),
    )
    near = near.join(words, "word")
    form_n = -F.col("best.least")
    formed = form_n >= 2 * F.col("n")
    near = materialize(
        near.select(
            "word", "n_near", F.when(formed, F.col("best.form")).alias("form"), F.when(formed, form_n).alias("form_n")
        ),
        "spelling-forms",
    )
    roots = _roots(near.where("form IS NOT NULL"))
    return (
        words.join(near, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            "form_n",
        )
    )


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Spelling groups of the words of all documents."""
    words = count_words(table(spark, folder, "documents"), "doc_id", "text")
    return group_spellings(words.where((F.length("word") >= MIN_CHARS) & (F.col("n") >= MIN_COUNT)))


QUERY = op12_spelling
# DuckDB has no crc32: its table comes from the polynomial, and texts are folded over it bytewise.
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents WHERE text IS NOT NULL),
counted AS (SELECT doc_id, run, count(*) AS n, hex(encode(concat(doc_id, ':', run))) AS h FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(
    [CAST(4294967295 AS BIGINT)] || list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS crc
  FROM counted, crc_table),
typed AS (
  SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, CAST(crc % length(run) AS BIGINT)) || substr(run, CAST(crc % length(run) + 2 AS BIGINT))
         ELSE run END AS word, n FROM hashed),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (
  SELECT word, n, place, substr(word, 1, CAST(place - 1 AS BIGINT)) || substr(word, CAST(place + 1 AS BIGINT)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b USING (place, rest) WHERE a.word <> b.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest),
judged AS (
  SELECT word, n, count(*) AS n_near, min((-other_n, other)) AS best FROM near GROUP BY word, n),
formed AS (SELECT word, best[2] AS form, -best[1] AS form_n FROM judged WHERE -best[1] >= 2 * n),
steps AS (
  SELECT word, form AS root, 1 AS depth FROM formed
  UNION ALL SELECT s.word, f.form, depth + 1 FROM steps s JOIN formed f ON f.word = s.root),
roots AS (SELECT word, max_by(root, depth) AS root FROM steps GROUP BY word)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n, coalesce(j.n_near, 0) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM words w LEFT JOIN judged j USING (word) LEFT JOIN formed f USING (word) LEFT JOIN roots r USING (word)
"""
