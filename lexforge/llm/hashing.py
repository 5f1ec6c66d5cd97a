"""Vectorised word and window hashing shared by the text operators.

A batch of texts is laid end to end as one array of code points; word limits come from a class table,
word hashes from a prefix sum of a polynomial over the whole array, window hashes from a second
polynomial over the word hashes. No Python loop runs per word. Hashes are 64 bits, fixed by the
constants below, and so equal in every process.

Null texts count as empty. A text of any length is worked in bounded chunks cut between words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE, _WIN = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_INV = pow(_BASE, -1, 1 << 64)
_SEP = "\U0010ffff"
CHUNK = 1 << 20


@lru_cache(1)
def _alnum() -> np.ndarray:
    t = np.zeros(0x110000, dtype=bool)
    t[[i for i in range(0x110000) if chr(i).isalnum()]] = True
    return t


@lru_cache(1)
def _nonblank() -> np.ndarray:
    t = np.ones(0x110000, dtype=bool)
    t[[ord(c) for c in " \t\n\r\v\f"] + [0x85, 0x2028, 0x2029, ord(_SEP)]] = False
    return t


_pow_cache: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    have = _pow_cache.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 4096)
        have = np.full(size, base, dtype=U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        _pow_cache[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Final avalanche (splitmix64)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _segment(s: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends (in code points) of the words of s, and the places of separators."""
    codes = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    inside = np.zeros(len(codes) + 2, dtype=np.int8)
    inside[1:-1] = table[codes]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    prefix = np.zeros(len(codes) + 1, dtype=U64)
    np.cumsum((codes.astype(U64) + U64(1)) * _powers(len(codes), _BASE), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _powers(len(codes) + 1, _INV)[starts]
    return mix(h), starts, ends, np.flatnonzero(codes == ord(_SEP))


def _pieces(s: str):
    """Cuts s behind a blank or separator about every CHUNK characters."""
    at, n = 0, len(s)
    while at < n:
        end = min(n, at + CHUNK)
        if end < n:
            cut = max(s.rfind(c, at, end) for c in (" ", "\n", _SEP))
            end = cut + 1 if cut > at else end
            if cut <= at:  # one piece without blanks: go on to the next blank, whole words only
                nxt = [p for c in (" ", "\n", _SEP) if (p := s.find(c, end)) >= 0]
                end = min(nxt) + 1 if nxt else n
        yield at, s[at:end]
        at = end


def hash_words(texts, kind: str = "word", spans: bool = False):
    """Word hashes of all texts end to end, and the offset of each text's first word.

    kind "word": maximal runs of letters or digits of the lower-cased text; kind "token": pieces between
    blanks, tabs and line breaks, letter case kept. With spans also each word's start and end in the
    joined (for words: lower-cased) string, and that string.
    """
    texts = [t.replace(_SEP, " ") if t else "" for t in texts]
    joined = _SEP.join(texts) + _SEP if texts else ""
    if kind == "word":
        joined = joined.lower()
    table = _alnum() if kind == "word" else _nonblank()
    hs, counts, ss, es, done = [], [0], [], [], 0
    for at, part in _pieces(joined):
        h, st, en, sep = _segment(part, table)
        counts.extend((np.searchsorted(st, sep) + done).tolist())
        done += len(h)
        hs.append(h)
        if spans:
            ss.append(st + at)
            es.append(en + at)
    h = np.concatenate(hs) if hs else np.zeros(0, dtype=U64)
    off = np.asarray(counts, dtype=np.int64)
    if not spans:
        return h, off
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, dtype=np.int64)
    return h, off, cat(ss), cat(es), joined


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; the last k - 1 places have none. Order matters."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    c = [U64(pow(_WIN, j + 1, 1 << 64)) for j in range(k)]
    if k <= 8:
        g = h[:n] * c[0]
        for j in range(1, k):
            g += h[j : n + j] * c[j]
        return mix(g)
    p = np.zeros(len(h) + 1, dtype=U64)
    np.cumsum(h * _powers(len(h), _WIN), out=p[1:])
    inv = pow(_WIN, -1, 1 << 64)
    return mix((p[k:] - p[:-k]) * _powers(len(h) + 1, inv)[:n] * c[0])


def window_limits(off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last window of each text, in the array windows() returns."""
    first, last = off[:-1], off[1:] - k + 1
    return first, np.maximum(last, first)


def batches(frames, column: str, chars: int = CHUNK):
    """Cuts pandas frames into slices of about `chars` characters of text, at least a row each."""
    for f in frames:
        if len(f) == 0:
            continue
        n = f[column].str.len().fillna(0).to_numpy(dtype=np.int64)
        group = np.cumsum(n) // chars
        for at, end in zip(*_runs(group)):
            yield f.iloc[at:end]


def _runs(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.diff(g)) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(g)]])
