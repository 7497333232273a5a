"""Vectorised text helpers used inside Spark tasks: words, word hashes, shingle
hashes and lines of many texts at once, as numpy arrays.

A batch of texts is joined into one byte array (UTF-8) with a line feed after
each text. Span hashes mix eight bytes at a time, all spans of a batch in one array
pass, and long spans have a cryptographic hash: no structure in the text (as that
of Thue-Morse words for polynomials modulo 2**64) makes two hashes equal.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
BATCH_BYTES = 1 << 20

# ASCII lower case, and the whitespace of the word definition [^\x20\x09-\x0D]+
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and every other ASCII byte that is no letter or digit.
NO_WORD = np.ones(256, dtype=bool)
NO_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (in place)."""
    x ^= x >> U64(30)
    x *= _MIX1
    x ^= x >> U64(27)
    x *= _MIX2
    x ^= x >> U64(31)
    return x


#: Spans of more bytes than this are hashed one by one.
_LONG = 256
_KEEP = np.array([0xFFFFFFFFFFFFFFFF >> 8 * (8 - n) if n else 0 for n in range(9)], U64)


@dataclass
class Words:
    """Words of several texts: byte positions into ``data`` (the original bytes),
    a hash per word, and ``first[i]:first[i + 1]`` as the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    text_start: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def join_texts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts (null as empty), each followed by a line feed, and the
    start of each text (one more entry than texts)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
    return data, np.concatenate([[0], np.cumsum(sizes)])


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every span data[start:end]; equal bytes give equal hashes."""
    size = end - start
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    h = mix(size.astype(U64) + U64(_BASE))
    todo = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left = start[todo], size[todo]
    while len(todo):
        block = eight[at] & _KEEP[np.minimum(left, 8)]
        h[todo] = mix((h[todo] ^ block) * U64(_BASE) + _MIX1)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = int.from_bytes(blake2b(data[start[k]:end[k]].tobytes(), digest_size=8).digest(), "little")
    return h


def words(texts: list, lower: bool = True, space: np.ndarray = _IS_SPACE) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` (or runs of bytes not in ``space``) of every
    text; hashes are of the words with A-Z lower-cased when ``lower``."""
    data, text_start = join_texts(texts)
    space = space[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    h = hash_spans(_LOWER[data] if lower else data, start, end)
    return Words(data, start, end, h, np.searchsorted(start, text_start), text_start)


def batches(sizes, limit: int = BATCH_BYTES):
    """Consecutive ranges (i, j) whose sizes add up to about ``limit`` (one larger
    entry makes a range of its own)."""
    i, total = 0, 0
    for j, s in enumerate(sizes):
        if j > i and total + s > limit:
            yield i, j
            i, total = j, 0
        total += s
    if i < len(sizes):
        yield i, len(sizes)


def text_sizes(texts: list) -> list[int]:
    return [len(t) if t else 0 for t in texts]


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive values (order matters)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = h[:m].copy()
    for k in range(1, n):
        out *= U64(_BASE)
        out += h[k:k + m]
    return mix(out)


def shingle_sets(w: Words, n: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles; a text with
    fewer words has its whole sequence as one; without words the set is empty."""
    out, all_windows = [], window_hashes(w.hash, n)
    for i, j in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if j - i >= n:
            s = np.sort(all_windows[i:j - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif j > i:
            out.append(window_hashes(w.hash[i:j], j - i) + U64(j - i))
        else:
            out.append(np.zeros(0, U64))
    return out
