"""Toxicity by a support vector machine with a subsequence string kernel.

The kernel of two strings counts the subsequences of three characters they share, each weighted
down by the gaps it spans, so an insult with a character put in or left out stays close to itself.
Normalised and taken to the fourth power (which is a kernel again), it is compared with the
stretches of words about as long as a landmark. Words are read without what is no letter in them
and spelled-out words as one, and a landmark with up to two letters put in stays close. Landmarks
are word beginnings that tell toxic training documents from clean ones; the Nystroem map through
them makes the kernel machine a linear one. It is trained on sentences: all of clean documents, and
of each toxic document those with a landmark and the one that the machine so far calls worst. A
document scores as its worst sentence does.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygraph.llm.labelled import fit_in_task, remainder, sample_rows
from tallygraph.llm.text import SPACE, byte_prefix, joined, slices, span_hash, words
from tallygraph.session import table

LANDMARKS = 200
LEAST = 10  # landmarks, where too few texts are labelled for any to be sure
SHARE = 1 / 40  # of the toxic texts that hold a sure landmark, at least
RATIO = 30  # how much commoner in toxic than in clean texts a landmark must be
ROUNDS = 3  # in which the worst sentences are chosen anew
ALIKE = 100  # clean words taken as landmarks beside them
SHORTEST, LONGEST = 4, 12  # bytes of a landmark
DECAY = 0.5
EXTRA = 2  # bytes a stretch may be longer than the landmark
GAP = 0.985  # closeness kept for each byte put into a landmark that is there whole
CLOSE = 0.6  # a stretch further away counts as unrelated
POWER = 4
CACHED_WORDS = 200_000
THRESHOLD = 0.7

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(65, 91), *range(128, 256)]] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?\n"]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the accented Latin-1 capitals in lower case."""
    upper = (data >= 65) & (data <= 90)
    after = np.concatenate(([False], data[:-1] == 0xC3))
    accented = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    return np.where(upper | accented, data + 32, data).astype(np.uint8)


def subsequence_kernel(s: np.ndarray, t: np.ndarray, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted count of common subsequences of three characters, for each row of both.

    Rows are padded with -1 (``s``) and -2 (``t``), which match nothing. ``ending[j]`` holds
    the weight of the subsequences found so far that reach to column ``j`` of ``t``.
    """
    rows, width = t.shape
    level = np.ones((3, rows, width + 1))
    level[1:] = 0.0
    total = np.zeros(rows)
    for x in s.T:
        same = (t == x[:, None]).astype(float)
        total += (same * level[2][:, :-1]).sum(axis=1) * decay * decay
        for order in (2, 1):
            ending = np.zeros((rows, width + 1))
            for j in range(width):
                ending[:, j + 1] = decay * (ending[:, j] + decay * same[:, j] * level[order - 1][:, j])
            level[order] = decay * level[order] + ending
    return total


def _padded(strings: list[bytes], pad: int) -> np.ndarray:
    out = np.full((len(strings), max(map(len, strings), default=1)), pad, np.int16)
    for i, s in enumerate(strings):
        out[i, : len(s)] = np.frombuffer(s, np.uint8)
    return out


def normalised_kernel(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Kernel of each pair, 1 for equal strings."""
    if not left:
        return np.zeros(0)
    a, b = _padded(left, -1), _padded(right, -2)
    own = np.sqrt(
        subsequence_kernel(a, np.where(a < 0, -2, a)) * subsequence_kernel(np.where(b < 0, -1, b), b)
    )
    return subsequence_kernel(a, b) / np.maximum(own, 1e-12)


def put_in(text: bytes, mark: bytes) -> int | None:
    """Bytes put into the landmark at the beginning of the text, one after a byte at most."""
    at, count = 0, 0
    for i, x in enumerate(mark):
        if text[at : at + 1] != mark[i : i + 1]:
            at, count = at + 1, count + 1
            if not i or count > EXTRA or text[at : at + 1] != mark[i : i + 1]:
                return None
        at += 1
    return count


def _spelled(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, *more: np.ndarray):
    """Words that lie on end, runs of one-letter words of a document made one word."""
    if not len(start):
        return start, end, doc, *more
    size = end - start
    one = (size == 1) | ((size == 2) & (data[start] >= 0xC0))
    head = np.concatenate(([True], ~(one[1:] & one[:-1] & (doc[1:] == doc[:-1]))))
    head = np.flatnonzero(head)
    return start[head], end[np.append(head[1:], len(start)) - 1], doc[head], *(x[head] for x in more)


class Landmarks:
    """Similarity of words to a fixed list of short strings.

    ``inside`` tells which of them may also lie inside a word, the others only at its beginning.
    """

    def __init__(self, strings: list[bytes], inside: np.ndarray | None = None):
        self.strings = strings
        self.inside = np.ones(len(strings), bool) if inside is None else inside
        # Three characters with at most one left out on either side, and the landmarks they are in.
        owners: dict[int, set[tuple[int, int]]] = {}
        for n, s in enumerate(strings):
            for i in range(len(s)):
                for a, b in ((1, 2), (1, 3), (2, 3)):
                    if i + b < len(s):
                        owners.setdefault((s[i] << 16) | (s[i + a] << 8) | s[i + b], set()).add((n, i))
        self.codes = np.array(sorted(owners), np.int64)
        self.owners = [np.array(sorted(owners[c])) for c in self.codes.tolist()]  # landmark, place in it
        self._start()

    def _start(self) -> None:
        self._table = np.zeros(1 << 24, bool)
        self._table[self.codes] = True
        self._values: dict[tuple[bytes, int], float] = {}  # kernels of words seen by this worker

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._start()

    def _closest(self, pairs: list[tuple[bytes, int]]) -> np.ndarray:
        """Closeness of each landmark and the beginning of a stretch."""
        fresh = [p for p in set(pairs) if p not in self._values]
        left, right, owner = [], [], []
        for n, (text, mark) in enumerate(fresh):
            size = len(self.strings[mark])
            stretches = sorted({text[: size + e] for e in range(EXTRA + 1)})
            left += stretches
            right += [self.strings[mark]] * len(stretches)
            owner += [n] * len(stretches)
        values = np.zeros(len(fresh))
        for i in range(0, len(left), 20_000):
            np.maximum.at(values, owner[i : i + 20_000], normalised_kernel(left[i : i + 20_000], right[i : i + 20_000]))
        for n, (text, mark) in enumerate(fresh):
            count = put_in(text, self.strings[mark])
            if count is not None:
                values[n] = max(values[n], GAP**count)
        if len(self._values) + len(fresh) > CACHED_WORDS:
            self._values = {p: self._values[p] for p in set(pairs) if p in self._values}
        self._values.update(zip(fresh, values.tolist()))
        return np.array([self._values[p] for p in pairs])

    def similar(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """Word, landmark and kernel of all words with a stretch close to a landmark.

        Only words that share a trigram (with up to one gap) with a landmark are compared: without
        one the closest stretch is far below ``CLOSE``.
        """
        words_, hits = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        word_of = np.repeat(np.arange(len(start)), end - start)
        at = np.arange(len(word_of)) - np.repeat(np.cumsum(end - start) - (end - start), end - start)
        at = at + start[word_of] if len(start) else at
        stop = end[word_of] if len(end) else at
        places = [np.zeros(0, np.int64)]
        for a, b in ((1, 2), (1, 3), (2, 3), (2, 4)):
            fits = at + b < stop
            p = at[fits]
            code = (data[p].astype(np.int64) << 16) | (data[p + a].astype(np.int64) << 8) | data[p + b]
            known = self._table[code]
            words_.append(word_of[fits][known])
            places.append(p[known])
            hits.append(np.searchsorted(self.codes, code[known]))
        word, hit, place = np.concatenate(words_), np.concatenate(hits), np.concatenate(places)
        if not len(word):
            return word, word, np.zeros(0)
        size = np.array([len(o) for o in self.owners])[hit]
        owner = np.concatenate([self.owners[h] for h in hit.tolist()])
        pair = np.repeat(word, size) * len(self.strings) + owner[:, 0]
        # Where the landmark would begin for the trigram to lie at its place.
        begin = np.maximum(np.repeat(place, size) - owner[:, 1], start[np.repeat(word, size)])
        pairs, inverse, shared = np.unique(pair, return_inverse=True, return_counts=True)
        # Two changed characters leave at least this many of a landmark's trigrams of either kind.
        length = np.array([len(s) for s in self.strings])
        enough = (shared >= np.maximum(2, length - 3)[pairs % len(self.strings)])[inverse]
        enough &= self.inside[pair % len(self.strings)] | (begin == start[pair // len(self.strings)])
        pair, begin = np.unique(np.stack((pair, begin))[:, enough], axis=1)
        word, mark = pair // len(self.strings), pair % len(self.strings)
        whole = data.tobytes()
        stop = np.minimum(begin + length[mark] + EXTRA, end[word])
        spans = zip(begin.tolist(), stop.tolist(), mark.tolist())
        values = self._closest([(whole[a:b], m) for a, b, m in spans])
        # The closest stretch of a word counts.
        pairs, first = np.unique(pair, return_index=True)
        values = np.maximum.reduceat(values, first) if len(first) else values
        word, mark = pairs // len(self.strings), pairs % len(self.strings)
        close = values >= CLOSE
        return word[close], mark[close], values[close] ** POWER

    def words_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Documents, sentences and numbers of all words close to a landmark, the words, their kernels."""
        data, bounds = joined(texts)
        data = lowered(data)
        start, end, doc = words(data, bounds, SPACE)
        none = np.zeros(0, np.int64)
        none = none, none, none, [], np.zeros((0, len(self.strings)))
        if not len(start):
            return none
        # A sentence ends with its document, too.
        sentence = np.concatenate(([0], np.cumsum(_SENTENCE_END[data])))[start] + doc
        # Leave out what is no letter, within words as well.
        letter = _LETTER[data]
        before = np.concatenate(([0], np.cumsum(letter)))
        data = data[letter]
        start, end = before[start], before[end]
        use = end > start
        start, end, doc, sentence = _spelled(data, start[use], end[use], doc[use], sentence[use])
        if not len(start):
            return none
        content = span_hash(byte_prefix(data), start, end)
        _, chosen, inverse = np.unique(content, return_index=True, return_inverse=True)
        word, mark, value = self.similar(data, start[chosen], end[chosen])
        if not len(word):
            return none
        row_of = np.full(len(chosen), -1)
        hit = np.unique(word)
        row_of[hit] = np.arange(len(hit))
        rows = np.zeros((len(hit), len(self.strings)))
        rows[row_of[word], mark] = value
        where = np.flatnonzero(row_of[inverse] >= 0)
        whole = data.tobytes()
        spans = zip(start[chosen[hit]].tolist(), end[chosen[hit]].tolist())
        return doc[where], sentence[where], row_of[inverse[where]], [whole[a:b] for a, b in spans], rows


    def sentences(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Document and closest kernels of every sentence with a word close to a landmark."""
        doc, sentence, number, _, kernel = self.words_of(texts)
        if not len(doc):
            return doc, np.zeros((0, len(self.strings)))
        first = np.flatnonzero(np.concatenate(([True], sentence[1:] != sentence[:-1])))
        return doc[first], np.maximum.reduceat(kernel[number], first, axis=0)


def _beginnings(found: set[bytes]) -> set[bytes]:
    """Beginnings of whole characters."""
    return {
        w[:n]
        for w in found
        for n in range(SHORTEST, min(len(w), LONGEST) + 1)
        if n == len(w) or not 0x80 <= w[n] < 0xC0
    }


def _long_words(text: str) -> set[bytes]:
    data = lowered(np.frombuffer(text.encode(), np.uint8))
    start, end, _ = words(data, np.array([0, len(data)]), ~_LETTER)
    whole = data.tobytes()
    return {whole[a:b] for a, b in zip(start.tolist(), end.tolist()) if b - a >= SHORTEST}


def _evidence(bad: int, fine: int, n_toxic: int, n_clean: int) -> float:
    """G statistic of a string in ``bad`` toxic and ``fine`` clean texts."""
    n, held = n_toxic + n_clean, bad + fine
    cells = ((bad, n_toxic, held), (fine, n_clean, held), (n_toxic - bad, n_toxic, n - held), (n_clean - fine, n_clean, n - held))
    return 2 * sum(x * np.log(x * n / (row * column)) for x, row, column in cells if x)


def choose_landmarks(texts: list[str], labels: np.ndarray, limit: int = LANDMARKS) -> list[bytes]:
    """Word beginnings and words of toxic texts that hardly occur in clean ones, the surest first.

    A string must be ``RATIO`` times commoner in toxic texts than in clean ones. It is sure if that
    holds in either half of the texts and it is in ``SHARE`` of the toxic ones. Where fewer than
    ``LEAST`` are sure, those with the strongest evidence follow.
    """
    common: Counter = Counter()
    for i in np.flatnonzero(labels):
        common.update(_long_words(texts[i]))
    candidates = _beginnings({w for w, n in common.items() if n > 1})
    del common
    half = np.zeros(len(texts), np.int64)
    for label in (0, 1):  # toxic and clean texts are halved apart, so that no order empties a half
        half[np.flatnonzero(labels == label)[1::2]] = 1
    counts = [[Counter(), Counter()], [Counter(), Counter()]]  # by half and label
    for text, label, h in zip(texts, labels.tolist(), half.tolist()):
        counts[h][label].update(_beginnings(_long_words(text)) & candidates)
    sizes = [[max(1, int(((labels == label) & (half == h)).sum())) for label in (0, 1)] for h in (0, 1)]
    bad, fine = (counts[0][label] + counts[1][label] for label in (1, 0))
    n_clean, n_toxic = (sizes[0][label] + sizes[1][label] for label in (0, 1))

    def telling(s: bytes, h: int) -> bool:
        return counts[h][1][s] > 1 and counts[h][1][s] * sizes[h][0] > RATIO * counts[h][0][s] * sizes[h][1]

    good = {
        s: _evidence(n, fine[s], n_toxic, n_clean)
        for s, n in bad.items()
        if n > 1 and n * n_clean > RATIO * fine[s] * n_toxic
    }
    sure = {s: g for s, g in good.items() if bad[s] >= max(4, SHARE * n_toxic) and telling(s, 0) and telling(s, 1)}
    chosen: list[bytes] = []
    for pool, size in ((sure, limit), (good, LEAST)):
        pool = {s: g for s, g in pool.items() if not any(s.startswith(c) or c.startswith(s) for c in chosen)}
        while pool and len(chosen) < size:
            top = max(pool, key=lambda s: (pool[s], s))
            # Of strings nearly as frequent as the first, the longest says most.
            kin = [s for s in pool if (s.startswith(top) or top.startswith(s)) and bad[s] >= 0.9 * bad[top]]
            best = max(kin, key=lambda s: (len(s), pool[s], s))
            chosen.append(best)
            pool = {s: g for s, g in pool.items() if not s.startswith(best) and not best.startswith(s)}
    return chosen


class Model:
    """Landmarks, one weight for each, and how a margin becomes a probability."""

    def __init__(self, marks: Landmarks, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.marks, self.weights, self.bias, self.slope, self.shift = marks, weights, bias, slope, shift

    def state(self) -> tuple:
        """The model as plain values, for :meth:`of`."""
        return self.marks.strings, self.marks.inside, self.weights, self.bias, self.slope, self.shift

    @classmethod
    def of(cls, state: tuple) -> Model:
        return cls(Landmarks(*state[:2]), *state[2:])

    def scores(self, texts: pa.Array) -> np.ndarray:
        margin = np.full(len(texts), self.bias)
        if self.marks.strings:
            doc, kernel = self.marks.sentences(texts)
            np.maximum.at(margin, doc, kernel @ self.weights + self.bias)
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _svm(x: np.ndarray, signs: np.ndarray, cost: np.ndarray, rounds: int = 2000) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps; the last column is 1."""
    keep = np.ones(x.shape[1]) * 1e-4
    keep[-1] = 0.0
    spread = sum((x[i : i + 1000].T * cost[i : i + 1000]) @ x[i : i + 1000] for i in range(0, len(x), 1000))
    step = 1.0 / (2.0 * np.linalg.eigvalsh(spread)[-1] + keep.max())
    w = v = np.zeros(x.shape[1])
    for n in range(rounds):
        slackness = np.maximum(0.0, 1.0 - signs * (x @ v.astype(np.float32)))
        gradient = -2.0 * ((cost * signs * slackness).astype(np.float32) @ x) + keep * v
        fresh = v - step * gradient
        v, w = fresh + (n / (n + 3.0)) * (fresh - w), fresh
    return w[:-1], float(w[-1])


def _pieces(texts: list[str]) -> Iterator[tuple[int, pa.Array]]:
    """Slices of the training texts, and how many come before."""
    base = 0
    for piece in slices(iter([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])])):
        yield base, piece.column("text")
        base += piece.num_rows


def _alike(strings: list[bytes], clean: list[str]) -> tuple[list[bytes], np.ndarray]:
    """Clean words that resemble a landmark, and how many clean words hold each landmark inside."""
    marks = Landmarks(strings)
    seen: Counter = Counter()
    closest: dict[bytes, float] = {}
    held = np.zeros(len(strings), np.int64)
    for _, piece in _pieces(clean):
        _, _, number, names, kernel = marks.words_of(piece)
        counts = np.bincount(number, minlength=len(names)).tolist()
        for name, row, count in zip(names, kernel, counts):
            for m in np.flatnonzero(row >= 0.999).tolist():
                held[m] += 0 if name.startswith(strings[m]) else count
            if len(name) >= SHORTEST and not name.startswith(tuple(strings)):
                seen[name] += count
                closest[name] = float(row.max())
    found = sorted(seen, key=lambda w: (-seen[w] * closest[w], w))[:ALIKE]
    return [max(_beginnings({w}), key=len) for w in found if _beginnings({w})], held


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Train on labelled texts; their sentences are the instances.

    All sentences of clean texts are negative. Of a toxic text those that hold a landmark as it is
    are positive, and the one closest to a landmark, then the one the machine so far calls worst. Clean words that resemble
    an insult become landmarks as well, so that the machine can tell the two apart. Without both
    classes every text scores the share of toxic ones.
    """
    share = float(labels.mean()) if len(labels) else 0.0
    strings = choose_landmarks(texts, labels) if 0 < labels.sum() < len(labels) else []
    if not strings:
        prior = min(max(share, 1e-6), 1 - 1e-6)
        return Model(Landmarks([]), np.zeros(0), 0.0, 1.0, float(np.log(prior / (1 - prior))))
    insults = len(strings)
    alike, held = _alike(strings, [t for t, label in zip(texts, labels) if not label])
    strings = list(dict.fromkeys([*strings, *alike]))
    # Clean words are landmarks for words that begin as they do. What clean words hold inside says
    # something at the beginning of a word only.
    marks = Landmarks(strings, np.append(held < 2, np.zeros(len(strings) - insults, bool)))
    docs, rows = [np.zeros(0, np.int64)], [np.zeros((0, len(strings)), np.float32)]
    for base, piece in _pieces(texts):
        doc, kernel = marks.sentences(piece)
        docs.append(doc + base)
        rows.append(kernel.astype(np.float32))
    doc, kernel = np.concatenate(docs), np.concatenate(rows)
    # Nystroem: features = kernel to the landmarks times the inverse root of theirs.
    n = len(strings)
    between = np.array([normalised_kernel([s] * n, strings) for s in strings]) ** POWER
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    root = vectors @ np.diag(1.0 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    x = np.column_stack((kernel @ root.astype(np.float32), np.ones(len(kernel), np.float32)))
    clean = np.flatnonzero(labels[doc] == 0)
    toxic = np.flatnonzero(labels[doc] == 1)
    worst = kernel[:, :insults].max(axis=1).astype(np.float64)
    plain = toxic[worst[toxic] >= 0.999]  # they hold a landmark as it is
    del rows, kernel
    for _ in range(ROUNDS):
        # The worst sentence of each toxic text; the last row stands for all that resemble nothing.
        order = toxic[np.lexsort((-worst[toxic], doc[toxic]))]
        chosen = order[np.concatenate(([True], doc[order[1:]] != doc[order[:-1]]))] if len(order) else order
        chosen = np.union1d(chosen, plain)
        nothing = np.append(np.zeros(n), 1).astype(np.float32)
        instances = np.concatenate((x[chosen], x[clean], nothing[None]))
        signs = np.repeat([1.0, -1.0], [len(chosen), len(clean) + 1])
        cost = np.ones(len(signs))
        cost[-1] = (labels == 0).sum()
        weights, bias = _svm(instances, signs, cost / cost.sum())
        worst = x[:, :-1] @ weights.astype(np.float32) + bias
    margin = np.full(len(texts), bias)
    np.maximum.at(margin, doc, worst)
    return Model(marks, root @ weights, bias, *_probability(margin, labels))


def _probability(margin: np.ndarray, labels: np.ndarray, rounds: int = 2000) -> tuple[float, float]:
    """Logistic curve through the margins, so that scores are shares of the labelled texts."""
    weight = 1.0 / len(labels)
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margin + shift, -30, 30)))
        error = weight * (p - labels)
        slope = min(8.0, max(0.1, slope - 5.0 * float(error @ margin)))
        shift -= 5.0 * float(error.sum())
    return slope, shift


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """Add the toxicity of every whole text, 0 to 1; null and empty texts get the lowest score.

    A column named like the result is replaced. Rows stay where they are and are judged each, so
    copies and hot sources do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.drop(column)
    schema = rows.withColumn(column, F.lit(None).cast("double")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            scores = pa.array(shared.value.scores(batch.column(text)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])

    return rows.mapInArrow(run, schema)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows outside of the held-out third, fitted in one task.

    The sample is bounded (:mod:`tallygraph.llm.labelled`), so the task is, and the driver holds
    nothing but the model.
    """
    rows = sample_rows(docs, labels, "toxic", remainder(F.col("doc_id"), 3) != 1)
    return Model.of(fit_in_task(rows, lambda texts, labels: fit(texts, labels).state()))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERY = op9_toxicity
ORACLE = None
