"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and links inside them.

The ends of the tokens of both are sorted byte offsets: those in both cut the token lists into
groups, and each stretch between two neighbours of all of them is one link, of the tokens that
cover it. No token of either side spans the place between a word and a following space, so texts
are cut there and equal pieces are aligned once, all new ones of a slice as arrays. Links are
counted over the whole corpus. Documents travel as blocks: a block holds its different links once
and its documents' links as numbers of them, so a link that every document has is looked up once
for every block.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygraph.llm.text import slices
from tallygraph.session import table
from tallygraph.storage import materialize

BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"
SLICE_BYTES = 1 << 20  # text encoded at once
BLOCK_BYTES = 8 << 20  # text of a block; one longer document is one block
CACHED_CHUNKS = 200_000  # aligned pieces of text a Python worker remembers, and as many of before
_LOW = (1 << 32) - 1
JOINT_CHUNKS = 500  # of them that are encoded at once
Aligned = tuple[int, int, int, bytes, bytes]
_WORD_END = re.compile(r"(?<=\S)(?= )")
_ODD_SPACE = re.compile(r" (?<=\s )")  # a space behind white space
_LONG_WORD = re.compile(r"\S{1000}|\s{1000}")


def _byte_characters() -> dict[str, int]:
    """The characters that stand for the bytes 0..255 in a byte-level vocabulary."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, from the contents of their files, and the bytes of all their tokens.

    A vocabulary whose merges make its tokens in the order of their ids is a table of ranks, which
    tiktoken encodes by several times faster. Its time grows with the square of a word, so texts
    with very long words, and other vocabularies, go through the tokenizers library itself.
    """

    def __init__(self, byte_file: bytes, piece_file: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self._bytes = Tokenizer.from_buffer(byte_file)
        self._bytes.encode_special_tokens = True
        self._bytes.no_padding()
        self._bytes.no_truncation()
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        as_byte = _byte_characters()
        spec = json.loads(byte_file)
        special = {t["id"] for t in spec.get("added_tokens", [])}
        vocabulary = self._bytes.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if i in special else bytes(as_byte[c] for c in token)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [vocabulary["".join(m)] for m in merges]
        self._ranked = None
        if all(x < y for x, y in zip(made, made[1:])):
            ranks = {x: i for i, x in enumerate(self.a_bytes) if i not in special}
            self._ranked = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )
        sp = self._pieces
        self.b_bytes = [
            bytes([int(sp.id_to_piece(i)[3:-1], 16)])
            if sp.is_byte(i)
            else sp.id_to_piece(i).replace("▁", " ").encode()
            for i in range(sp.get_piece_size())
        ]
        self._cuts = not any("▁" in sp.id_to_piece(i).lstrip("▁") for i in range(sp.get_piece_size()))
        self.a_size, self.b_size = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.width = len(str(most)) + 1
        text = b"".join(str(i).encode().ljust(self.width, b"\0") for i in range(most))
        self.text = np.frombuffer(text, np.uint8).reshape(most, self.width)  # ids as decimal numbers
        self.digits = np.count_nonzero(self.text, axis=1)
        self._known: dict[str, Aligned | None] = {}
        self._older: dict[str, Aligned | None] = {}

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut after words; each piece starts with a space."""
        if not self._cuts:
            return [f" {text}"]
        if text[:1] == " " or _ODD_SPACE.search(text):
            return _WORD_END.split(f" {text}")
        return list(map(" ".__add__, text.split(" ")))

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both. B puts a space before what it is given, also where that is the whole chunk."""
        a = [
            self._bytes.encode(chunk, add_special_tokens=False).ids
            if self._ranked is None or _LONG_WORD.search(chunk)
            else self._ranked.encode_ordinary(chunk)
            for chunk in chunks
        ]
        space = self._pieces.piece_to_id("▁")
        return a, [ids or [space] for ids in self._pieces.encode([c[1:] for c in chunks], num_threads=1)]

    def _learn(self, chunks: list[str]) -> None:
        """Align chunks, many in one piece; nothing may follow one that ends with white space."""
        joint, alone = [], []
        for c in chunks:
            (alone if c[-1].isspace() else joint).append(c)
        pieces = [joint[i : i + JOINT_CHUNKS] for i in range(0, len(joint), JOINT_CHUNKS)]
        pieces += [[c] for c in alone]
        while pieces:
            failed, good = [], []
            for piece, a, b in zip(pieces, *self.encode(list(map("".join, pieces)))):
                raw = "".join(piece).encode()
                if all(
                    b"".join(map(tokens.__getitem__, ids)) == raw
                    for tokens, ids in ((self.a_bytes, a), (self.b_bytes, b))
                ):
                    good.append((piece, a, b))
                elif len(piece) > 1:
                    failed += [[c] for c in piece]
                else:
                    self._known[piece[0]] = None
            if good:
                piece, a, b = (list(chain.from_iterable(x)) for x in zip(*good))
                size = np.fromiter((len(c.encode()) for c in piece), np.int64, len(piece))
                found = align(np.array(a, np.int64), np.array(b, np.int64), self, np.cumsum(size))
                self._known.update(zip(piece, found))
            pieces = failed

    def aligned(self, texts: list[str]) -> Iterator[Aligned]:
        """Alignment of whole texts; none where either side does not give back the bytes of the text."""
        cut = [self.chunks(t) for t in texts]
        wanted = set().union(*cut)
        if len(self._known) + len(wanted) > CACHED_CHUNKS:
            self._known, self._older = {}, self._known
        new = wanted.difference(self._known)
        known = new.intersection(self._older)
        self._known.update(zip(known, map(self._older.__getitem__, known)))
        new = list(new.difference(known))
        self._learn(new)
        for text, chunks in zip(texts, cut):
            found = list(map(self._known.__getitem__, chunks))
            if not text or None in found:
                yield 0, 0, 0, b"", b""
            else:
                n_a, n_b, n_groups, parts, links = zip(*found)
                yield sum(n_a), sum(n_b), sum(n_groups), b";".join(parts), b"".join(links)


@lru_cache(maxsize=1)
def _loaded(byte_file: bytes, piece_file: bytes) -> Tokenizers:
    return Tokenizers(byte_file, piece_file)


def align(a: np.ndarray, b: np.ndarray, both: Tokenizers, stops: np.ndarray) -> Iterator[Aligned]:
    """Alignment of chunks on end, of which both sides hold all tokens; ``stops`` are where they end.

    Numbers of tokens and groups, the groups as text, and all links ``A id << 32 | B id``, packed.
    """
    a_ends, b_ends = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
    ends = np.union1d(a_ends, b_ends)
    a_at, b_at = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    links = (a[a_at] << 32 | b[b_at]).astype("<i8").tobytes()
    cut = (a_ends[a_at] == ends) & (b_ends[b_at] == ends)
    a_last, b_last = a_at[cut], b_at[cut]  # the last tokens of each group
    # The groups one after another: A ids, then B ids. Each id ends with a sign.
    a_group = np.searchsorted(a_last, np.arange(len(a)))
    b_group = np.searchsorted(b_last, np.arange(len(b)))
    a_place = np.arange(len(a)) + np.append(0, b_last + 1)[a_group]
    b_place = np.arange(len(b)) + a_last[b_group] + 1
    ids, sign = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[a_place], ids[b_place] = a, b
    sign[a_place[a_last]], sign[b_place[b_last]] = ord("|"), ord(";")
    wide, digits = both.text[ids], both.digits[ids]
    wide[np.arange(len(ids)), digits] = sign
    text = wide[wide > 0].tobytes()
    written = np.cumsum(digits + 1)

    def starts(stop: np.ndarray) -> np.ndarray:
        return np.append(0, stop[:-1])

    group = np.searchsorted(ends[cut], stops)
    a_stop, b_stop, link_stop = a_last[group] + 1, b_last[group] + 1, np.searchsorted(ends, stops) + 1
    text_stop, link_stop = written[b_place[b_stop - 1]], 8 * link_stop
    groups = np.diff(group + 1, prepend=0)
    texts = map(slice, starts(text_stop).tolist(), (text_stop - 1).tolist())
    spans = map(slice, starts(link_stop).tolist(), link_stop.tolist())
    numbers = (np.diff(x, prepend=0).tolist() for x in (a_stop, b_stop))
    return zip(*numbers, groups.tolist(), map(text.__getitem__, texts), map(links.__getitem__, spans))


def _packed(numbers: np.ndarray, sizes: np.ndarray) -> bytes:
    """Numbers sorted within each document, as compressed steps; the four bytes of a step apart."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    ordered = numbers[np.lexsort((numbers, doc))]
    steps = np.diff(ordered, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = ordered[first]
    return zstandard.compress(steps.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(packed: bytes, sizes: np.ndarray) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    sums = np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))
    before = np.concatenate(([0], sums))[np.cumsum(sizes) - sizes]
    return sums - np.repeat(before, sizes)


def _blocks(docs: DataFrame, key: str, text: str, files: tuple[bytes, bytes], block_bytes: int) -> DataFrame:
    """``docs`` (one struct each), ``pairs`` and ``totals`` (links, how often), ``links`` (packed)."""
    kind = docs.schema[key].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(files)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    fields = ("n_a", "n_b", "n_groups", "n_links")

    def block(keys: list, found: list[tuple], links: list[np.ndarray], key_type: pa.DataType) -> pa.RecordBatch:
        pairs, inverse, totals = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        order = np.argsort(-totals, kind="stable")  # the most common links get the smallest numbers
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        numbers = [pa.array([f[i] for f in found], pa.int64()) for i in range(4)]
        sizes = np.array([f[3] for f in found], np.int64)
        structs = pa.StructArray.from_arrays(
            [pa.array(keys, key_type), *numbers, pa.array([f[4] for f in found], pa.string())],
            names=["key", *fields, "sha"],
        )
        whole = [
            pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            for x in (structs, pa.array(pairs[order]), pa.array(totals[order]))
        ]
        packed = _packed(number[inverse], sizes)
        return pa.RecordBatch.from_arrays(
            [*whole, pa.array([packed], pa.binary())], names=["docs", "pairs", "totals", "links"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _loaded(*shared.value)
        keys, found, links, held, key_type = [], [], [], 0, None
        for batch in slices(batches, "text", SLICE_BYTES):
            key_type = batch.schema.field("key").type
            texts = [t or "" for t in batch.column("text").to_pylist()]
            size = sum(map(len, texts))
            if held and held + size > block_bytes:
                yield block(keys, found, links, key_type)
                keys, found, links, held = [], [], [], 0
            for n_a, n_b, n, groups, own in both.aligned(texts):
                found.append((n_a, n_b, n, len(own) // 8, sha256(groups).hexdigest() if n else ""))
                links.append(np.frombuffer(own, "<i8"))
            keys += batch.column("key").to_pylist()
            held += size
        if keys:
            yield block(keys, found, links, key_type)

    struct = f"struct<key:{kind},{','.join(f'{f}:bigint' for f in fields)},sha:string>"
    blocks = rows.mapInArrow(run, f"docs array<{struct}>, pairs array<bigint>, totals array<bigint>, links binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def _vocabulary_files(byte_vocabulary: str | None, piece_vocabulary: str | None) -> tuple[bytes, bytes]:
    found = []
    for path, name in ((byte_vocabulary, BYTE_VOCABULARY), (piece_vocabulary, PIECE_VOCABULARY)):
        with open(path or public_tokenizers.path(name), "rb") as file:
            found.append(file.read())
    return tuple(found)


def link_counts(blocks: DataFrame) -> DataFrame:
    """``pair, count, best``: how often a link occurs, and whether no link of its B id does more often."""
    counts = (
        blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("_x"))
        .groupBy(F.col("_x.pairs").alias("pair"))
        .agg(F.sum("_x.totals").alias("count"))
    )
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(_LOW))  # at most one row for every A id
    return counts.select("pair", "count", (F.col("count") == F.max("count").over(same_b)).alias("best"))


def align_tokens(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    byte_vocabulary: str | None = None,
    piece_vocabulary: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    A encodes a space and the text by a byte-level BPE file, B the text by a SentencePiece file,
    which puts the space before it; the paths are on the driver and the contents, whose sizes are
    fixed, are broadcast. Strings of special tokens in a text are plain text. Null and empty texts,
    and texts that the tokens of A or B do not give back byte for byte, have no tokens: zeros and
    an empty digest. Repeated rows count as often as they occur and each has its own result. Other
    columns are not read. A text of any length is encoded whole; an empty table has no rows.
    """
    files = _vocabulary_files(byte_vocabulary, piece_vocabulary)
    blocks = materialize(_blocks(docs, key, text, files, block_bytes), "aligned-blocks")
    counts = materialize(link_counts(blocks), "link-counts")
    looked_up = (
        blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
        .join(counts, "pair")
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "count", "best")).alias("found"))
    )
    kind = docs.schema[key].dataType.simpleString()
    names = (key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, found = (batch.column(c).slice(i, 1).flatten() for c in ("docs", "found"))
                own = docs.flatten()
                sizes = own[4].to_numpy()
                at, count, best = (c.to_numpy(zero_copy_only=False) for c in found.flatten())
                table_ = np.zeros((2, len(at)), np.int64)
                table_[0, at], table_[1, at] = best, count
                sums = []
                if len(at):
                    numbers = _unpacked(batch.column("links")[i].as_py(), sizes)
                    ends = np.cumsum(sizes)
                    for values in table_:
                        running = np.concatenate(([0], np.cumsum(values[numbers])))
                        sums.append(running[ends] - running[ends - sizes])
                else:
                    sums = [np.zeros(len(docs), np.int64)] * 2
                yield pa.RecordBatch.from_arrays([*own[:5], *map(pa.array, sums), own[5]], names=list(names))

    numbers = ", ".join(f"`{n}` bigint" for n in names[1:-1])
    return (
        blocks.select("block", "docs", "links")
        .join(looked_up, "block", "left")
        .mapInArrow(run, f"`{key}` {kind}, {numbers}, groups_sha256 string")
    )


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of both tokenizers for every document."""
    return align_tokens(table(spark, folder, "documents"))


QUERY = op11_token_alignment
ORACLE = None
