"""Periodic runs of words: stretches that repeat with a period, found exactly.

A run is a stretch of consecutive words with smallest period q, at least ``least`` words
and two periods long, that no neighbouring word extends with period q.

* Periods below ``direct`` come from lag scans: where words q apart are equal.
* Longer ones come from minimizers, one scale for the periods [P, 2P) of each
  P = direct * 2**k. A block is P/4 words; of every window of P/2 block positions the
  ones of least block hash are selected. A run holds such a window twice, q apart, with
  the same minima, so two selected positions of equal hash at distance q seed it. Every
  such pair is extended in both directions word by word, so hashes only propose.
* A block that continues with a period of at most P/8 (known from smaller scales) is not
  selected, so equal blocks lie more than P/8 apart and a position has at most eight
  partners. A run whose first period has no other block is two stretches of one short
  period that meet out of phase: those seams give their candidates by residue.

All texts of a batch are one array of word numbers with a number of its own after each
text, the longest first, so a scale reads only the texts that can hold its periods. The
work of a text grows with its length times the logarithm of its length, whatever it holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ship_package
from .text_arrays import U64, batches, mix

LEAST_WORDS, DIRECT = 12, 48
_ODD = 0xD6E8FEB86659FD93
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_NONE = U64(0xFFFFFFFFFFFFFFFF)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, U64(base))
    p[:1] = 1
    return np.cumprod(p, dtype=U64)


def _lag_runs(x: np.ndarray, q: int, least: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the longest stretches with period q that are long enough."""
    same = np.flatnonzero(x[:-q] == x[q:])
    if not len(same):
        return
    cut = np.flatnonzero(np.diff(same) > 1)
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(same) - 1]])
    fine = same[last] - same[first] + 1 + q >= max(least, 2 * q)
    for a, b in zip(same[first[fine]].tolist(), same[last[fine]].tolist()):
        yield a, b + 1 + q


def _slide(v: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of every window of ``width`` values."""
    size = 1
    while 2 * size <= width:
        v = of(v[:-size], v[size:])
        size *= 2
    return of(v[:len(v) - (width - size)], v[width - size:]) if size < width else v


def _selected(h: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the least value of a window around them (without _NONE)."""
    if len(h) < width:
        return np.zeros(0, np.int64)
    least = np.concatenate([np.zeros(width - 1, U64), _slide(h, width, np.minimum), np.zeros(width - 1, U64)])
    return np.flatnonzero((_slide(least, width, np.maximum) == h) & (h != _NONE))


def _reach(x: np.ndarray, m: int, q: int) -> tuple[int, int]:
    """The stretch (a, b) around m in which x[i] == x[i + q]."""
    b, step = m, 64
    while b + q < len(x):
        n = min(step, len(x) - q - b)
        other = np.flatnonzero(x[b:b + n] != x[b + q:b + q + n])
        if len(other):
            b += int(other[0])
            break
        b, step = b + n, 2 * step
    a, step = m, 64
    while a > 0:
        n = min(step, a)
        other = np.flatnonzero(x[a - n:a] != x[a - n + q:a + q])
        if len(other):
            a += int(other[-1]) + 1 - n
            break
        a, step = a - n, 2 * step
    return a, b


def _pairs(at: np.ndarray, h: np.ndarray, low: int) -> set[tuple[int, int]]:
    """(q, m): positions m, m + q of equal hash, low <= q < 2 * low."""
    order = np.lexsort((at, h))
    at, h, out, j = at[order], h[order], set(), 1
    while j < len(at):
        gap = at[j:] - at[:-j]
        near = (h[j:] == h[:-j]) & (gap < 2 * low)
        if not near.any():
            break
        hit = np.flatnonzero(near & (gap >= low))
        out.update(zip(gap[hit].tolist(), at[hit].tolist()))
        j += 1
    return out


def _rotation(u: np.ndarray, v: np.ndarray) -> int | None:
    """r with v[t] == u[(t + r) % len(u)]."""
    whole, part, size, i = np.concatenate([u, u]).tobytes(), v.tobytes(), u.itemsize, -1
    while (i := whole.find(part, i + 1)) >= 0:
        if i % size == 0:
            return i // size
    return None


def _seams(x: np.ndarray, short: list, low: int) -> set[tuple[int, int]]:
    """(q, m), low <= q < 2 * low, where two stretches (period, start, end) of one period meet."""
    out = set()
    for (p, a, b), (p2, a2, b2) in zip(short, short[1:]):
        if p != p2 or a2 > b:
            continue
        r = _rotation(x[b - p:b], x[b:b + p])
        if r is not None:
            first = low + (-r - low) % p
            out.update((q, b - q) for q in range(first, min(2 * low, b - a + 1, b2 - a2 + 1), p))
    return out


def find_runs(x: np.ndarray, sizes: np.ndarray, least: int = LEAST_WORDS, direct: int = DIRECT) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run in ``x``: texts of ``sizes`` numbers, falling, each
    followed by a number found nowhere else. ``direct`` is 8 times a whole number, with
    direct / 4 >= least - 1."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, min(direct, len(x))):
        for run in _lag_runs(x, q, least):
            found.setdefault(run, q)  # a stretch has its smallest period first
    value = mix((x.astype(U64) + U64(1)) * U64(_ODD))
    total = np.concatenate([np.zeros(1, U64), np.cumsum(value * _powers(_ODD, len(x)), dtype=U64)])
    back, ends = _powers(_ODD_INVERSE, len(x)), np.cumsum(sizes + 1)
    low = direct
    while (sizes >= 2 * low).any():
        n = int(ends[(sizes >= 2 * low).sum() - 1])
        block = low // 4
        h = (total[block:n + 1] - total[:n + 1 - block]) * back[:n + 1 - block]
        short = sorted((q, a, b) for (a, b), q in found.items() if 2 * q <= block and b <= n and b - a > block)
        if short:
            mark = np.zeros(len(h) + 1, np.int64)
            np.add.at(mark, [a for _, a, _ in short], 1)
            np.add.at(mark, [b - block for _, _, b in short], -1)
            h[np.cumsum(mark[:-1]) > 0] = _NONE
        at = _selected(h, low // 2)
        seeds = _pairs(at, h[at], low) | _seams(x, [r for r in short if r[2] - r[1] >= low], low)
        done, last = 0, 0
        for q, m in sorted(seeds):
            if q == last and m < done or x[m] != x[m + q]:
                continue
            a, done = _reach(x, m, q)
            last = q
            if done - a >= q:
                found.setdefault((a, done + q), q)
        low *= 2
    return sorted((a, b, q) for (a, b), q in found.items())


def _numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Words as numbers, equal for equal words, with a new number after each text."""
    known: dict[bytes, int] = {}
    out = np.empty(sum(map(len, texts)) + len(texts), np.int32)
    i = 0
    for k, words in enumerate(texts):
        j = i + len(words)
        out[i:j] = [known.setdefault(w, len(known)) for w in words]
        out[j] = -1 - k
        i = j + 1
    return out


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Per text its runs (start, length, period), by start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    runs = find_runs(_numbered([texts[k] for k in order]), sizes)
    out: list[list] = [[] for _ in texts]
    for (a, b, q), k in zip(runs, (np.searchsorted(first, [a for a, _, _ in runs], "right") - 1).tolist()):
        out[order[k]].append((a - int(first[k]), b - a, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    mark = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        mark[start + q] += 1
        mark[start + length] -= 1
    gone = np.cumsum(mark[:-1]) > 0
    return [words[i] for i in np.flatnonzero(~gone).tolist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs`` (doc_id, text): the runs
    as an array of (start, length, period) by start, then period, in words
    ``[^\\x20\\x09-\\x0D]+`` numbered from 0, and the text's words without the repeated
    periods of any run, joined by one space.

    A null text is an empty one (no words, no runs, empty ``collapsed``); a null doc_id
    is kept. Rows are independent: repeated rows each give their row, an empty table
    gives none, other columns are not read. A text of any length is one unit of work."""
    ship_package(docs.sparkSession)
    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    out = to_arrow_schema(StructType.fromDDL(schema))
    run_list = out.field("runs").type

    def fn(stream):
        for batch in stream:
            ids, column = batch.column("doc_id"), batch.column("text")
            for i, j in batches(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in column.slice(i, j - i).to_pylist()]
                runs = runs_of(texts)
                flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
                at = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
                items = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_list.value_type))
                kept = [b" ".join(collapse(t, r)).decode("utf-8", "surrogatepass") for t, r in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array([len(t) for t in texts], pa.int64()),
                                                  pa.ListArray.from_arrays(at, items, type=run_list), pa.array(kept, pa.string())], schema=out)

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text").mapInArrow(fn, schema)
