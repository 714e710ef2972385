"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(value: str | bytes) -> str:
    return hashlib.sha256(value.encode() if isinstance(value, str) else value).hexdigest()


def repeated_bytes(texts: list[str | None], window: int) -> list[tuple[list[tuple[int, int]], bytes]]:
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for s in range(len(b) - window + 1):
            seen[b[s : s + window]] = seen.get(b[s : s + window], 0) + 1
    out = []
    for b in raw:
        gone = [False] * len(b)
        for s in range(len(b) - window + 1):
            if seen[b[s : s + window]] > 1:
                gone[s : s + window] = [True] * window
        out.append((runs(gone), bytes(c for c, g in zip(b, gone) if not g)))
    return out


def runs(flags: list[bool]) -> list[tuple[int, int]]:
    out, start = [], None
    for i, flag in enumerate([*flags, False]):
        if flag and start is None:
            start = i
        elif not flag and start is not None:
            out.append((start, i))
            start = None
    return out


def repeated_words(docs: list[tuple], window: int) -> dict:
    """docs: distinct (id, text), null ids first. Kept words and removed spans by id."""
    firsts: dict[tuple, tuple] = {}
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    words = {i: SPACED.findall(t or "") for i, t in ordered}
    out = {}
    for n, (i, _) in enumerate(ordered):
        for s in range(len(words[i]) - window + 1):
            firsts.setdefault(tuple(words[i][s : s + window]), (n, s))
    for n, (i, _) in enumerate(ordered):
        gone = [False] * len(words[i])
        for s in range(len(words[i]) - window + 1):
            if firsts[tuple(words[i][s : s + window])] != (n, s):
                gone[s : s + window] = [True] * window
        out[i] = ([w for w, g in zip(words[i], gone) if not g], runs(gone))
    return out


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> dict:
    patterns: dict[tuple, set[str]] = {}
    for i, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for s in range(max(1, len(w) - window + 1) if w and i is not None else 0):
            patterns.setdefault(tuple(w[s : s + window]), set()).add(str(i))
    out = {}
    for i, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for size in {len(p) for p in patterns}:
            for s in range(len(w) - size + 1):
                owners = patterns.get(tuple(w[s : s + size]))
                if owners:
                    found |= owners
                    hit[s : s + size] = [True] * size
        out[i] = (len(w), runs(hit), sorted(found))
    return out


def fingerprint(text: str | None, shingle: int = 4) -> int:
    w = SPACED.findall((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(" ".join(w[k : k + shingle]).encode(), 42)
        for k in range(max(1, len(w) - shingle + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: dict, max_bits: int) -> dict:
    """Smallest id reachable from each id."""
    parent = {i: i for i in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def edits(a: str, b: str) -> int:
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def deduped_lines(docs: list[tuple], min_chars: int = 8, max_edits: int = 1) -> dict:
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    seen: list[str] = []
    out = {}
    for i, text in ordered:
        if text is None:
            out[i] = None
            continue
        kept = []
        for line in text.split("\n"):
            if len(line) >= min_chars:
                if not any(abs(len(s) - len(line)) <= max_edits and edits(s, line) <= max_edits for s in seen):
                    kept.append(line)
                seen.append(line)
            else:
                kept.append(line)
        out[i] = "\n".join(kept)
    return out
