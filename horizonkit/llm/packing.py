"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Only lengths matter to a plan, so it is made from the histogram of lengths (at most
``capacity`` counts, whatever the number of documents): for each length, longest
first, the single lengths, then pairs, then triples whose sum is exactly the gap are
looked up in the index of available lengths and used as often as their counts allow;
what finds no exact complement is packed by best fit, the longest available length
that fits each time. Each step uses up a length, so a plan has at most ``capacity``
patterns. Pieces then find their place from their rank among the pieces of equal
length: a distributed count, no group in one task."""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .tables import map_batches, parts, stored
from .tokens import encoder

CAPACITY, END_ID = 4096, 1


def pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY,
           digest: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of rows (doc_id, text): the token ids and
    ``end_id``, cut into pieces of ``capacity``. A null or empty text is the end id
    alone. ``ids`` is little-endian unsigned 32-bit; with ``digest`` its CRC-32
    (``ids_crc32``) stands in its place. Repeated rows are separate documents; a null
    doc_id stays null."""
    last = np.array([end_id], "<u4").tobytes()

    def fn(cols):
        out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32" if digest else "ids": []}
        held = 0
        for doc_id, ids in zip(cols["doc_id"], encoder(vocabulary).encode(cols["text"])):
            ids += last
            for k in range(0, len(ids), 4 * capacity):
                part = ids[k:k + 4 * capacity]
                for name, v in zip(out, (doc_id, k // (4 * capacity), k // 4, len(part) // 4,
                                         zlib.crc32(part) if digest else part)):
                    out[name].append(v)
                held += 8 if digest else len(part)
            if held > 8 << 20:
                yield out
                out, held = {n: [] for n in out}, 0
        yield out

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), fn,
                       "doc_id bigint, piece int, start bigint, length bigint, "
                       + ("ids_crc32 bigint" if digest else "ids binary"))


class _Available:
    """Counts by length, and the lookups of exact complements among them."""

    def __init__(self, counts: np.ndarray, even: bool = True):
        self.count, self.even = counts, even
        self.there = counts > 0

    def take(self, lengths: Iterable[int], times: int) -> None:
        for x in lengths:
            self.count[x] -= times
            self.there[x] = self.count[x] > 0

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often this combination can be taken."""
        return min(int(self.count[x]) // lengths.count(x) for x in set(lengths))

    def pair(self, total: int, top: int) -> tuple[int, int] | None:
        """Two available lengths (at most ``top``) with this sum, the most even or uneven ones."""
        low = max(1, total - top)
        half = total // 2
        if low > half:
            return None
        a = np.flatnonzero(self.there[low:half + 1] & self.there[total - half:total - low + 1][::-1]) + low
        if len(a) and 2 * a[-1] == total and self.count[a[-1]] < 2:
            a = a[:-1]
        if not len(a):
            return None
        least = int(a[-1] if self.even else a[0])
        return total - least, least

    def exact(self, gap: int, top: int, most: int) -> tuple[int, ...] | None:
        """Up to ``most`` (three) available lengths, none over ``top``, that add up to ``gap``."""
        if gap <= top and self.there[gap]:
            return (gap,)
        two = self.pair(gap, top) if most > 1 else None
        if two or most < 3:
            return two
        first = np.flatnonzero(self.there[-(-gap // 3):min(gap - 1, top + 1)]) - (gap // -3)
        for x in first.tolist()[::1 if self.even else -1]:
            rest = self.pair(gap - x, min(x, gap - x - 1))
            if rest and self.times((x, *rest)):
                return (x, *rest)
        return None


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, copies), ...) with the number of sequences of each: the
    best of the plans that take even or uneven sums first, in one pass over the
    lengths or in one each for singles, pairs and triples."""
    plans = (_plan(lengths, capacity, even, passes) for even in (True, False) for passes in ((3,), (1, 2, 3)))
    return min(plans, key=lambda p: sum(n for _, n in p))


def _plan(lengths: dict[int, int], capacity: int, even: bool, passes: tuple[int, ...]) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    counts = np.zeros(capacity + 2, np.int64)
    for x, n in lengths.items():
        counts[x] += n
    have, out = _Available(counts, even), []

    def add(parts_of: list[int], times: int) -> None:
        out.append((tuple((x, parts_of.count(x)) for x in dict.fromkeys(parts_of)), times))

    for x, most in [(x, most) for most in passes for x in range(capacity, 0, -1)]:
        while have.count[x]:
            have.take([x], 1)  # the piece whose gap is filled
            found = have.exact(capacity - x, x, most) if x < capacity else ()
            have.take([x], -1)
            if found is None:
                break
            n = have.times((x, *found))
            have.take([x, *found], n)
            add([x, *found], n)
    rest = _Available(have.count)
    for x in range(capacity, 0, -1):
        while rest.count[x]:
            took, room = [(x, 1)], capacity - x
            rest.take([x], 1)
            fit = x
            while room and fit:
                fit = min(fit, room)
                below = np.flatnonzero(rest.there[:fit + 1])
                fit = int(below[-1]) if len(below) else 0
                if fit:
                    k = min(room // fit, int(rest.count[fit]))
                    rest.take([fit], k)
                    took.append((fit, k))
                    room -= k * fit
                    fit -= 1
            merged: dict[int, int] = {}
            for y, k in took:
                merged[y] = merged.get(y, 0) + k
            more = min(int(rest.count[y]) // k for y, k in merged.items())
            for y, k in merged.items():
                rest.take([y], more * k)
            out.append((tuple(merged.items()), more + 1))
    return out


def _slots(patterns) -> dict[str, np.ndarray]:
    """Per (length, first rank): first sequence, copies a sequence and offset."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for x, copies in pattern:
            rows.append((x, rank.get(x, 0), sequence, copies, offset))
            rank[x] = rank.get(x, 0) + times * copies
            offset += x * copies
        sequence += times
    rows.sort()
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(("length", "rank", "sequence", "copies", "offset"))}


def pack(items: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``items`` (a bigint column ``length`` from 1 to ``capacity``, and any others)
    with ``sequence_id`` (from 0) and ``offset`` (gapless from 0) added; columns of
    these two names are replaced. Rows equal in ``order`` take places in any order.
    No rows give no rows."""
    keep = [c for c in items.columns if c not in ("sequence_id", "offset", "_part", "_rank")]
    part = F.pmod(F.xxhash64(*order), F.lit(parts(items)))
    within = Window.partitionBy("length", "_part").orderBy(*order)
    ranked = stored(items.select(*keep, part.alias("_part")).withColumn("_rank", F.row_number().over(within) - 1), "pack-ranked")
    counts = ranked.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(x is None or not 0 < x <= capacity for x in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    slots = _slots(plan(histogram, capacity))
    span = 1 << 44  # more pieces of one length than any table has
    first = slots["length"] * span + slots["rank"]
    rows = (ranked.join(counts.select("length", "_part", "_before"), ["length", "_part"])
            .select(*keep, (F.col("_before") + F.col("_rank")).alias("_rank")))

    def place(batches_in):
        for b in batches_in:
            length, rank = (np.asarray(b.column(n)) for n in ("length", "_rank"))
            k = np.searchsorted(first, length * span + rank, "right") - 1
            nth = rank - slots["rank"][k]
            sequence = slots["sequence"][k] + nth // slots["copies"][k]
            offset = slots["offset"][k] + nth % slots["copies"][k] * length
            yield pa.RecordBatch.from_arrays([b.column(n) for n in keep] + [pa.array(sequence), pa.array(offset)],
                                             names=[*keep, "sequence_id", "offset"])

    ship_package(items.sparkSession)
    schema = items.select(*keep).schema.add("sequence_id", "long").add("offset", "long")
    return rows.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of packed pieces that carry ``ids``: at most
    ``capacity`` pieces meet in a row."""
    placed = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return placed.select("sequence_id", F.aggregate("p", F.lit(0).cast("bigint"), lambda s, x: s + x["length"]).alias("length"),
                         F.aggregate("p", F.lit(b"").cast("binary"), lambda s, x: F.concat(s, x["ids"])).alias("ids"))
