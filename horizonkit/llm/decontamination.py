"""Benchmark decontamination by template canonicalisation.

Words (runs of letters and digits) of documents and benchmark items become template
tokens: numbers, names (capitalised inside a sentence) and units (after a number) turn
into typed placeholders, other words stand for themselves in lower case. Every window
of WINDOW template tokens of a document is joined by hash with those of the items.
Windows of one document and item on one diagonal (document position minus item
position) are one occurrence. It counts if it covers MIN_WINDOWS windows (or all of a
shorter item) and its slots are consistent: each value of the item stands for one value
in the document and the other way round, so a question with other numbers and names is
caught and a chance likeness is not.

Before the join, a bit table of fixed size (2**BITS bits, whatever the benchmark)
drops the document windows that no item can have; the join itself is exact."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_batches, stored
from .text_arrays import NO_WORD, U64, batches, mix, text_sizes, window_hashes, words

WINDOW, MIN_WORDS, MIN_WINDOWS, BITS = 8, 5, 3, 26
# fixed values: units recognised after a number
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
         "kilometer kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds "
         "ounce ounces ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
         "h hr hour hours day days week weeks month months year years percent dollar dollars euro euros cent cents "
         "mph kmh hz khz mhz ghz w kw v kv a k kb mb gb tb degree degrees").split()
_UNIT_HASHES = np.sort(words(UNITS, space=NO_WORD).hash)
_NUMBER, _NAME, _UNIT = (mix(np.array([k], U64))[0] for k in (101, 102, 103))
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1
_ENDS = np.zeros(256, np.int64)
_ENDS[[0x0A, 0x0D, *b".!?:;\""]] = 1


def template(texts: list):
    """(words, template hash of each word, whether it is a slot)."""
    w = words(texts, space=NO_WORD)
    if not len(w.start):
        return w, w.hash, np.zeros(0, bool)
    head = w.data[w.start]
    number = _DIGIT[head] > 0
    second = w.data[np.minimum(w.start + 1, len(w.data) - 1)]
    capital = ((head >= 65) & (head <= 90)) | ((head == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    ends = np.concatenate([[0], np.cumsum(_ENDS[w.data])])
    before = np.concatenate([[0], w.end])[:-1]
    opens = ends[w.start] - ends[before] > 0
    opens[w.first[:-1][np.diff(w.first) > 0]] = True
    name = capital & ~opens & ~number
    at = np.minimum(np.searchsorted(_UNIT_HASHES, w.hash), len(_UNIT_HASHES) - 1)
    after_number = np.concatenate([[False], number[:-1]])
    after_number[w.first[:-1][np.diff(w.first) > 0]] = False
    unit = (_UNIT_HASHES[at] == w.hash) & after_number & ~number
    t = w.hash.copy()
    t[name], t[unit], t[number] = _NAME, _UNIT, _NUMBER
    return w, t, name | unit | number


def _windows(texts: list, n: int):
    """(text, position in text, hash, first word) of each window of n tokens of which
    at least half are plain words, with the word arrays."""
    w, t, slot = template(texts)
    h = window_hashes(t, n)
    of = w.text_of_word()
    plain = np.concatenate([[0], np.cumsum(~slot)])
    at = np.flatnonzero((of[:len(h)] == of[n - 1:]) & (2 * (plain[n:] - plain[:-n]) >= n)) if len(h) else np.zeros(0, np.int64)
    return of[at], at - w.first[:-1][of[at]], h[at] + U64(n), at, w, slot


def _values(at: int, n: int, w, slot) -> list[int]:
    return w.hash[at:at + n][slot[at:at + n]].view(np.int64).tolist()


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_pos, n, hash, item_values, item_windows) of rows (item_id, text):
    windows of WINDOW tokens, or the whole of an item of MIN_WORDS to WINDOW - 1."""

    def fn(cols):
        for i, j in batches(text_sizes(cols["text"])):
            w, _, _ = template(cols["text"][i:j])
            sizes = np.diff(w.first)
            for n in range(MIN_WORDS, WINDOW + 1):
                own = np.flatnonzero(sizes == n if n < WINDOW else sizes >= n)
                if not len(own):
                    continue
                of, pos, h, at, w2, slot = _windows([cols["text"][i + k] for k in own.tolist()], n)
                each = np.bincount(of, minlength=len(own))
                yield {"item_id": [cols["item_id"][i + own[k]] for k in of.tolist()], "item_pos": pos, "n": np.full(len(pos), n),
                       "hash": h.view(np.int64), "item_values": [_values(a, n, w2, slot) for a in at.tolist()],
                       "item_windows": each[of]}

    return map_batches(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), fn,
                       "item_id bigint, item_pos int, n int, hash bigint, item_values array<bigint>, item_windows int")


def _bit_table(windows: DataFrame) -> np.ndarray:
    """Bits of the hashes present: at most 2**(BITS - 6) words, gathered by grouped OR."""
    place = F.expr(f"hash & {(1 << BITS) - 1}")
    rows = (windows.select(F.shiftright(place, 6).alias("w"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).collect())
    table = np.zeros(1 << (BITS - 6), np.int64)
    for r in rows:
        table[r.w] = r.b
    return table.view(U64)


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item found in it: (doc_id, item_id, kind,
    n_windows, item_windows, n_slots); kind is ``verbatim`` (equal slots, or none) or
    ``re-parameterised``. Numbers are of the occurrence with the most windows.

    Documents that contain no item have no row; null and empty texts contain none.
    Items of fewer than MIN_WORDS words, or with no window of mostly plain words, are
    never found. Repeated rows count once; rows that share a doc_id (or item_id) are
    one. A null doc_id or item_id is kept as an id. Empty tables give no rows."""
    spark = docs.sparkSession
    items = stored(item_windows(benchmark).distinct(), "benchmark-windows")
    lengths = sorted(r.n for r in items.select("n").distinct().collect())
    table = spark.sparkContext.broadcast(_bit_table(items))
    low, six = U64((1 << BITS) - 1), U64(6)

    def fn(cols):
        bits = table.value
        for i, j in batches(text_sizes(cols["text"])):
            out = {"doc_id": [], "pos": [], "hash": [], "doc_values": []}
            for n in lengths:
                of, pos, h, at, w, slot = _windows(cols["text"][i:j], n)
                place = h & low
                hit = np.flatnonzero((bits[(place >> six).astype(np.int64)] >> (place & U64(63))) & U64(1))
                out["doc_id"] += [cols["doc_id"][i + k] for k in of[hit].tolist()]
                out["pos"] += pos[hit].tolist()
                out["hash"] += h[hit].view(np.int64).tolist()
                out["doc_values"] += [_values(a, n, w, slot) for a in at[hit].tolist()]
            yield out

    found = map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), fn,
                        "doc_id bigint, pos int, hash bigint, doc_values array<bigint>")
    hits = found.join(items, "hash").withColumn("diagonal", F.col("pos") - F.col("item_pos"))
    pair = F.arrays_zip("item_values", "doc_values")
    one = (hits.groupBy("doc_id", "item_id", "n", "diagonal")
           .agg(F.countDistinct("item_pos").alias("n_windows"), F.first("item_windows").alias("item_windows"),
                F.array_distinct(F.flatten(F.collect_set(pair))).alias("slots")))
    of_item, of_doc = F.col("slots.item_values"), F.col("slots.doc_values")
    consistent = (F.size(F.array_distinct(of_item)) == F.size("slots")) & (F.size(F.array_distinct(of_doc)) == F.size("slots"))
    one = one.where(consistent & (F.col("n_windows") >= F.least(F.lit(MIN_WINDOWS), "item_windows")))
    same = F.forall("slots", lambda s: s["item_values"] == s["doc_values"])
    one = one.select("doc_id", "item_id", F.struct("n_windows", same.alias("same"), "item_windows",
                                                   F.size("slots").alias("n_slots")).alias("o"))
    return (one.groupBy("doc_id", "item_id").agg(F.max("o").alias("o"))
            .select("doc_id", "item_id", F.when(F.col("o.same"), "verbatim").otherwise("re-parameterised").alias("kind"),
                    "o.n_windows", "o.item_windows", "o.n_slots"))
