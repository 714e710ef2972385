"""Byte-pair encoding by speculation: propose tokens, check neighbours, repair what fails.

A token sequence is the encoding of a word exactly when every token encodes to itself and every
two neighbours do so together, so a cheap proposal (the longest token that fits, again and again)
can be checked without merging. All new words of a slice walk the tree of token beginnings together
and are checked by one look-up of their neighbour pairs; those with a failing pair are merged, one
step of every such word at a time.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from operator import add

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.text import slices
from tallygraph.session import table

VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 500_000  # words a Python worker remembers; beyond that it starts anew
CACHED_PAIRS = 1_000_000
SHORT_WORD = 64  # bytes up to which a word is proposed and merged together with others

# Fixed by the vocabulary format: how byte-level tokenizers cut a text into words.
_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
_BEFORE_WORD = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" \s| $")
# Pieces that need no full cut: letters, and signs other than the apostrophe behind them.
_SIGNS = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
_LATIN = re.compile(r"[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _printable_bytes() -> dict[str, int]:
    """The characters that stand for the bytes 0..255 in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Lookup:
    """Whole numbers from 0 on by whole numbers from 0 on, for arrays of keys; -1 where a key is missing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = (np.full(1 << bits, -1, np.int64) for _ in range(2))
        slot = self._slot(keys)
        while len(keys):  # of those that want a free slot the first gets it, all others go on
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.keys[slot] < 0
            self.keys[slot[first]], self.values[slot[first]] = keys[first], values[first]
            keys, values, slot = keys[~first], values[~first], (slot[~first] + 1) & self.last

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = self.values[slot]
        left = np.flatnonzero(held != keys)
        out[left] = -1
        left = left[held[left] >= 0]
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.last
            held, wanted = self.keys[slot], keys[left]
            hit = held == wanted
            out[left[hit]] = self.values[slot[hit]]
            more = ~hit & (held >= 0)
            left, slot = left[more], slot[more]
        return out


class Vocabulary:
    """A byte-level BPE vocabulary of the ``tokenizers`` JSON format. Its size is fixed by its file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        as_byte = _printable_bytes()
        self.ids = {
            bytes(as_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
        }
        pairs = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        by_text = spec["model"]["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # the token each merge makes, by rank
        for a, b in pairs:
            self.rank[by_text[a], by_text[b]] = len(self.made)
            self.made.append(by_text[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [b""] * self.size
        for token, i in self.ids.items():
            self.tokens[i] = token
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        # Every beginning of a token, and its id where it is a token itself.
        self.begins = {token[:n]: -1 for token in self.ids for n in range(1, len(token))}
        self.begins.update(self.ids)
        # The same for arrays: a beginning is a number, and so is each pair of neighbours.
        number = {b"": 0} | {begin: i for i, begin in enumerate(self.begins, 1)}
        step = np.array([number[x[:-1]] << 8 | x[-1] for x in self.begins], np.int64)
        self.steps = Lookup(step, np.arange(1, len(number)))
        self.begun = np.array([-1, *self.begins.values()], np.int64)
        self.byte_begin = self.steps(np.arange(256))
        self.byte_token = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int64)
        pairs = np.array(list(self.rank), np.int64).reshape(-1, 2)
        self.ranks = Lookup(pairs[:, 0] * (self.size + 1) + pairs[:, 1], np.array(list(self.rank.values()), np.int64))
        self.makes = np.array(self.made, np.int64)
        self._start()

    def _start(self) -> None:
        self._words = regex.compile(_WORDS)
        names = sorted(self.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        self._pairs = np.zeros(0, np.int64)  # checked neighbour pairs, sorted, and whether they hold
        self._holds = np.zeros(0, bool)
        self._ids: dict[str, bytes] = {}  # word -> its ids
        self._first: dict[str, bytes] = {}  # piece of text -> its ids
        self._spaced: dict[str, bytes] = {}  # the same with one space before it

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def propose(self, word: bytes) -> list[int]:
        """The longest token that fits, from left to right."""
        out, at, size = [], 0, len(word)
        begins = self.begins
        while at < size:
            token, end, next_ = -1, at + 1, at + 1
            while True:
                found = begins.get(word[at:end])
                if found is None:
                    break
                if found >= 0:
                    token, next_ = found, end
                if end == size:
                    break
                end += 1
            if token < 0:
                raise ValueError("the vocabulary lacks a byte")
            out.append(token)
            at = next_
        return out

    def _propose_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of at most ``SHORT_WORD`` bytes: all tokens on end, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        if len(data) and self.byte_token[data].min() < 0:
            raise ValueError("the vocabulary lacks a byte")
        stop = np.cumsum(size)
        first = stop - size
        out = np.full(len(data), -1, np.int64)  # at the first byte of a token: the token
        # Of each word still walked: the first byte of a token, the next byte, the beginning walked so
        # far, the longest token met and its end, and the end of the word.
        at = first.copy()
        byte = data[at]
        next_, begin, token, end = at + 1, self.byte_begin[byte], self.byte_token[byte], at + 1
        while len(at):
            step = self.steps(begin << 8 | data[np.minimum(next_, len(data) - 1)])
            step[next_ >= stop] = -1
            begin, next_ = step, next_ + 1
            longer = np.where(step >= 0, self.begun[step], -1)
            token, end = np.where(longer >= 0, longer, token), np.where(longer >= 0, next_, end)
            over = np.flatnonzero(step < 0)
            if len(over):
                out[at[over]] = token[over]
                at[over] = end[over]
                more = over[end[over] < stop[over]]
                byte = data[at[more]]
                next_[more] = end[more] = at[more] + 1
                begin[more], token[more] = self.byte_begin[byte], self.byte_token[byte]
                if len(more) < len(over):
                    left = at < stop
                    at, next_, begin, token, end, stop = (x[left] for x in (at, next_, begin, token, end, stop))
        return out[out >= 0], np.add.reduceat(out >= 0, first, dtype=np.int64)

    def _merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`merge` of words of at most ``SHORT_WORD`` bytes: all tokens on end, and how many each has.

        A round merges one pair of every word that has one. A pair's order is its rank and, of
        equal ones, its place in the word; the entry behind the last byte is nobody's neighbour.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        byte = np.frombuffer(b"".join(words), np.uint8)
        n, none, many = len(byte), len(self.made) * SHORT_WORD, self.size + 1
        token = np.append(self.byte_token[byte], self.size)
        place = np.append(np.arange(n) - np.repeat(first, size), 0)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[first + size - 1] = after[n] = n
        before[first] = n

        def order(left: np.ndarray) -> np.ndarray:
            rank = self.ranks(token[left] * many + token[after[left]])
            return np.where(rank >= 0, rank * SHORT_WORD + place[left], none)

        pair = np.append(order(np.arange(n)), none)
        while True:
            least = np.minimum.reduceat(pair[:n], first)
            open_ = np.flatnonzero(least < none)
            if not len(open_):
                break
            rank, at = np.divmod(least[open_], SHORT_WORD)
            left = first[open_] + at
            gone = after[left]
            token[left], token[gone] = self.makes[rank], -1
            after[left] = after[gone]
            before[after[left]] = left
            pair[gone] = none
            pair[left], pair[before[left]] = order(left), order(before[left])
            pair[n] = none
        return token[:n][token[:n] >= 0], np.add.reduceat(token[:n] >= 0, first, dtype=np.int64)

    def merge(self, word: bytes) -> list[int]:
        """Exact encoding: the merge of lowest rank first, the leftmost of equal ones."""
        token = [self.ids[word[i : i + 1]] for i in range(len(word))]
        rank, made, size = self.rank, self.made, len(token)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        queue = []
        for i in range(size - 1):
            found = rank.get((token[i], token[i + 1]))
            if found is not None:
                queue.append((found, i, token[i], token[i + 1]))
        heapq.heapify(queue)
        while queue:
            least, i, left, right = heapq.heappop(queue)
            j = after[i]
            if token[i] != left or j >= size or token[j] != right:
                continue
            token[i] = made[least]
            token[j] = -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
                found = rank.get((token[i], token[after[i]]))
                if found is not None:
                    heapq.heappush(queue, (found, i, token[i], token[after[i]]))
            if before[i] >= 0:
                found = rank.get((token[before[i]], token[i]))
                if found is not None:
                    heapq.heappush(queue, (found, before[i], token[before[i]], token[i]))
        return [t for t in token if t >= 0]

    def _check(self, codes: np.ndarray) -> np.ndarray:
        """Whether each neighbour pair (left * size + right; right = size: none) stays as it is."""
        if len(self._pairs) > CACHED_PAIRS:  # before looking up, so that all of this call's pairs stay
            self._pairs, self._holds = np.zeros(0, np.int64), np.zeros(0, bool)
        wanted = np.unique(codes)
        at = np.searchsorted(self._pairs, wanted)
        known = at < len(self._pairs)
        known[known] = self._pairs[at[known]] == wanted[known]
        fresh = wanted[~known]
        if len(fresh):
            tokens = [*self.tokens, b""]
            left, right = np.divmod(fresh, self.size + 1)
            flat, count = self._merged([tokens[x] + tokens[y] for x, y in zip(left.tolist(), right.tolist())])
            first = np.cumsum(count) - count
            alone = right == self.size
            holds = (count == 2 - alone) & (flat[first] == left)
            holds &= alone | (flat[first + count - 1] == right)
            pairs = np.concatenate((self._pairs, fresh))
            order = np.argsort(pairs, kind="stable")
            self._pairs = pairs[order]
            self._holds = np.concatenate((self._holds, holds))[order]
        return self._holds[np.searchsorted(self._pairs, codes)]

    def _learn(self, words: list[str]) -> None:
        """Encode words not seen before."""
        raw = [w.encode() for w in words]
        flat, count = self._by_length(raw, self._propose_short, self.propose)
        last = np.cumsum(count) - 1
        right = np.append(flat[1:], 0)
        right[last] = self.size
        pair = np.ones(len(flat), bool)
        pair[last[count > 1]] = False  # a pair already covers the last of several tokens
        holds = np.ones(len(flat), bool)
        holds[pair] = self._check(flat[pair] * (self.size + 1) + right[pair])
        good = np.logical_and.reduceat(holds, last - count + 1)
        ids = self._packed(flat, count)
        failed = np.flatnonzero(~good).tolist()
        if failed:
            for i, merged in zip(failed, self._packed(*self._merged([raw[i] for i in failed]))):
                ids[i] = merged
        self._ids.update(zip(words, ids))

    def _packed(self, flat: np.ndarray, count: np.ndarray) -> list[bytes]:
        buffer = flat.astype("<u4").tobytes()
        end = 4 * np.cumsum(count)
        return [buffer[start:stop] for start, stop in zip((end - 4 * count).tolist(), end.tolist())]

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self._by_length(words, self._merge_short, self.merge)

    def _by_length(self, words: list[bytes], short, long) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of words on end, and how many each has; long words are taken one at a time."""
        if max(map(len, words)) <= SHORT_WORD:
            return short(words)
        found: list = [None] * len(words)
        few = [i for i, w in enumerate(words) if len(w) <= SHORT_WORD]
        if few:
            flat, count = short([words[i] for i in few])
            for i, tokens in zip(few, np.split(flat, np.cumsum(count)[:-1])):
                found[i] = tokens
        found = [np.array(long(w), np.int64) if x is None else x for w, x in zip(words, found)]
        return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

    def _pieces(self, text: str) -> list[str]:
        """Cut where a space precedes a visible character; no word reaches over such a cut."""
        return text.split(" ") if not _ODD_SPACE.search(text) else _BEFORE_WORD.split(text)

    def _learn_pieces(self, first: list[str], spaced: list[str]) -> None:
        """Encode pieces not seen before, the latter with a space before them."""
        whole, signed, letters, signs, odd = [], [], [], [], []
        for x in spaced:
            plain = x.rstrip(_SIGNS)
            if not plain.isalpha() or not (plain.isascii() or _LATIN.fullmatch(plain)):
                odd.append(x)
            elif len(plain) == len(x):
                whole.append(x)
            else:
                signed.append(x)
                letters.append(" " + plain)
                signs.append(x[len(plain) :])
        alone = list(map(" ".__add__, whole))
        cut = [(self._first, x, self._words.findall(x)) for x in first]
        cut += [(self._spaced, x, self._words.findall(" " + x)) for x in odd]
        fresh = list({*alone, *letters, *signs, *chain.from_iterable(c[2] for c in cut)}.difference(self._ids))
        if fresh:
            self._learn(fresh)
        ids = self._ids.__getitem__
        self._spaced.update(zip(whole, map(ids, alone)))
        self._spaced.update(zip(signed, map(add, map(ids, letters), map(ids, signs))))
        for known, piece, found in cut:
            known[piece] = b"".join(map(ids, found))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self._ids) + len(self._first) + len(self._spaced) > CACHED_WORDS:
            self._ids, self._first, self._spaced = {}, {}, {}
        parts = []  # per text: first piece and other pieces of plain text, and ids of special tokens
        first, spaced = set(), set()
        for text in texts:
            cut = self._special.split(text) if self._special else [text]
            part = []
            for i, p in enumerate(cut):
                if i % 2:
                    part.append(np.array([self.special[p]], "<u4").tobytes())
                else:
                    head, *rest = self._pieces(p)
                    first.add(head)
                    spaced.update(rest)
                    part.append((head, rest))
            parts.append(part)
        self._learn_pieces(list(first.difference(self._first)), list(spaced.difference(self._spaced)))
        out = []
        for part in parts:
            ids = []
            for p in part:
                if isinstance(p, bytes):
                    ids.append(p)
                else:
                    ids.append(self._first[p[0]])
                    ids.extend(map(self._spaced.__getitem__, p[1]))
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that are no UTF-8 become the replacement character."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def _mapped(df: DataFrame, vocabulary: str, source: str, result: str, kind: str, convert) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    rows = df.drop(result)
    schema = rows.withColumn(result, F.lit(None).cast(kind)).schema
    arrow = pa.binary() if kind == "binary" else pa.string()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, source):
            done = pa.array(convert(shared.value, batch.column(source).to_pylist()), arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, done], names=[*batch.schema.names, result])

    return rows.mapInArrow(run, schema)


def encode(
    df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None
) -> DataFrame:
    """Add the token ids of every whole text, packed as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a byte-level BPE file on the driver (its fixed-size content is
    broadcast); added tokens in a text become their ids, nothing else is added. A null text is
    encoded like an empty one, to no ids. A column named ``ids`` is replaced. Rows stay where they
    are, so neither hot sources nor repeated rows matter.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return _mapped(df, path, text, ids, "binary", lambda v, texts: v.encode([t or "" for t in texts]))


def decode(
    df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None
) -> DataFrame:
    """Add the text of packed token ids, special tokens included; null ids give an empty text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return _mapped(df, path, ids, text, "string", lambda v, packed: [v.decode(p or b"") for p in packed])


def token_count(ids: str = "ids"):
    return F.floor(F.octet_length(F.col(ids)) / 4).cast("bigint")


def op6_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the ids of every document and of the text they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decode(encode(docs).drop("text")).select(
        "doc_id",
        token_count().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERY = op6_byte_pairs
ORACLE = None
