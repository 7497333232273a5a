"""MinHash near-duplicates from bottom-k sketches of one hash function.

Every text gets the set of its distinct five-word shingles (64-bit hashes) and
keeps its k smallest values: the sketch. Texts with equal sets form one class,
found by a 128-bit digest of the set. Between classes:

1. inverted lists: every run of RUN neighbouring values among the first INDEXED of
   a sketch is a key. Two sets with Jaccard similarity s share such a run unless no
   RUN neighbours in their merged order are all shared; for s = 0.85, RUN = 3 and
   INDEXED = 32 that has probability 1.4e-7, and less above (sets of up to INDEXED
   values always share one). Below 0.85, INDEXED_LOW = 48 are taken (4.4e-8 for s = 0.8),
   and of sets of up to five values every two neighbours too (four values of five may
   share no three). A passage that many texts share makes few such runs;
2. pairs whose sizes, or one parity bit for each of 256 groups of shingles (``marks``), differ
   by more than a link allows are left out in the join of the lists; this loses none. Then
   the union-sketch estimate of the similarity filters (five standard deviations
   below the threshold pass);
3. exact Jaccard on the whole sets, computed anew from the texts, confirms links.

``components.link_lists`` keeps dense groups from costing all their pairs. Long lists whose
members it leaves apart (texts with a passage in common, copies just too far from each
other) are not compared pair by pair: their members meet by their rarest shingles
(``by_rare_shingles``), which loses no link."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, link_lists
from .tables import map_batches, small, stored, tally
from .text_arrays import U64, batches, mix, shingle_sets, text_sizes, window_hashes, words

SHINGLE, SKETCH, INDEXED, INDEXED_LOW, RUN = 5, 64, 32, 48, 3
TALLY = 1 << 18  # groups of shingles by hash that are told apart by frequency
MARKS = 4  # columns of 64 bits that tell sets far apart
_SET_SCHEMA = ("doc_id bigint, n_shingles bigint, digest binary, sketch array<bigint>, keys array<bigint>, "
               + ", ".join(f"m{k} bigint" for k in range(MARKS)))


def _digest(s: np.ndarray) -> bytes:
    a, b = mix(s + U64(0x51ED27)), mix(s ^ U64(0xA5A5A5A5A5A5A5A5))
    return np.array([a.sum(dtype=U64), b.sum(dtype=U64)], U64).tobytes()


def marks(s: np.ndarray) -> np.ndarray:
    """64 * MARKS bits: whether an odd number of the hashes falls on each. Every bit in which
    two sets differ takes a hash that only one of them has."""
    n = np.bincount((s >> U64(20)).astype(np.int64) % (64 * MARKS), minlength=64 * MARKS)
    return np.packbits((n & 1).astype(bool)).view(np.int64)


def may_be_linked(percent: int) -> Callable[[str, str], Column]:
    """Whether sets of these sizes (n_shingles) and marks may be linked: then at most
    (100 - percent) / (100 + percent) of both sizes together are in one set only."""
    def may(x: str, y: str) -> Column:
        differ = sum((F.bit_count(F.col(f"{x}.m{k}").bitwiseXOR(F.col(f"{y}.m{k}"))) for k in range(MARKS)), F.lit(0))
        sizes = F.col(f"{x}.n_shingles") + F.col(f"{y}.n_shingles")
        apart = F.abs(F.col(f"{x}.n_shingles") - F.col(f"{y}.n_shingles"))
        return (100 + percent) * F.greatest(differ, apart) <= (100 - percent) * sizes
    return may


def _marked(sets: list) -> dict[str, np.ndarray]:
    m = np.array([marks(s) for s in sets], np.int64).reshape(-1, MARKS)
    return {f"m{k}": m[:, k] for k in range(MARKS)}


def _sets(texts: list, n: int):
    for i, j in batches(text_sizes(texts)):
        yield i, j, shingle_sets(words(texts[i:j]), n)


def _signed(s: np.ndarray) -> np.ndarray:
    """Unsigned hashes as signed values of the same order."""
    return (s ^ U64(1 << 63)).view(np.int64)


def _least(similarity: float) -> int:
    """Smallest set size that can be linked with a different set."""
    return math.ceil(similarity / (1 - similarity) - 1e-9)


def sketches(docs: DataFrame, shingle: int = SHINGLE, similarity: float = 0.85) -> DataFrame:
    """(doc_id, n_shingles, digest, sketch, keys and marks) of every row of (doc_id, text)."""
    least, low = _least(similarity), similarity < 0.85
    indexed = INDEXED_LOW if low else INDEXED

    def fn(cols):
        for i, j, sets in _sets(cols["text"], shingle):
            some = [s[:indexed + RUN - 1] if len(s) >= least else s[:0] for s in sets]
            yield {"doc_id": cols["doc_id"][i:j], "n_shingles": [len(s) for s in sets],
                   "digest": [_digest(s) if len(s) else None for s in sets],
                   "sketch": [_signed(s[:SKETCH]) if len(s) >= least else None for s in sets],
                   "keys": [np.concatenate([window_hashes(s, r) for r in ((RUN, 2) if low and len(s) <= 5 else (RUN,))]).view(np.int64)
                            for s in some]} | _marked(sets)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), fn, _SET_SCHEMA)


def estimated(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of documents whose union sketch allows the similarity."""
    two = (pairs.join(classes.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
           .join(classes.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b"))
    two = two.withColumn("u", F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)).withColumn(
        "both", F.size(F.array_intersect("u", F.array_intersect("sa", "sb"))))
    n = F.size("u")
    slack = 5 * math.sqrt(similarity * (1 - similarity))
    return two.where(F.col("both") >= similarity * n - slack * F.sqrt(n)).select("a", "b")


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Pairs whose whole sets have 100 * intersection >= percent * union."""
    pairs = stored(pairs, "near-candidates")
    texts = _texts_of(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")), docs, "near")
    two = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
           .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"))

    def check(cols):
        both = [t for p in zip(cols["ta"], cols["tb"]) for t in p]
        ok = []
        for i, j in batches([len(x or "") + len(y or "") for x, y in zip(cols["ta"], cols["tb"])]):
            sets = shingle_sets(words(both[2 * i:2 * j]), shingle)
            for k in range(j - i):
                x, y = sets[2 * k], sets[2 * k + 1]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if len(x) and 100 * shared >= percent * (len(x) + len(y) - shared):
                    ok.append(i + k)
        yield {"a": [cols["a"][k] for k in ok], "b": [cols["b"][k] for k in ok]}

    return map_batches(two, check, "a bigint, b bigint")


def _texts_of(ids: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """(doc_id, text) of the rows of ``docs`` with these ids (column doc_id)."""
    need = stored(ids.distinct(), f"{name}-needed")
    return stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(small(need), "doc_id"), f"{name}-texts")


def by_rare_shingles(placed: DataFrame, docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Pairs (a, b) of documents of different components, ``placed`` (id, component), with
    every pair that is a link among them.

    Shingles are put in one order, rarest first; any order would do, so frequencies are
    counted by groups of hashes. Two sets linked have 100 * shared >= percent * size of
    the larger, and (100 + percent) * shared >= percent * both sizes. So a first shared
    shingle stands early in both, earlier in the smaller set, and from it on both are
    still long enough. What many texts share comes last in the order and seldom is a key."""
    texts = _texts_of(placed.select(F.col("id").alias("doc_id")), docs, "near-rare")

    times = tally(texts, lambda cols: (np.concatenate(sets) for _, _, sets in _sets(cols["text"], shingle)), TALLY)

    def fn(cols):
        for i, _, sets in _sets(cols["text"], shingle):
            out = {"key": [], "id": [], "n_shingles": [], "place": []}
            for k, s in enumerate(sets):
                n = len(s)
                first = s[np.lexsort((s, times[s % U64(TALLY)]))[:n - -(-percent * n // 100) + 1]]
                out["key"].append(_signed(first))
                out["place"].append(np.arange(len(first)))
                out["id"].append(np.full(len(first), cols["doc_id"][i + k]))
                out["n_shingles"].append(np.full(len(first), n))
            keys = [len(p) for p in out["place"]]
            yield {c: np.concatenate(v) for c, v in out.items()} | {c: np.repeat(v, keys) for c, v in _marked(sets).items()}

    schema = "key bigint, id bigint, n_shingles int, place int, " + ", ".join(f"m{k} bigint" for k in range(MARKS))
    keyed = map_batches(texts, fn, schema).join(placed, "id")
    keyed = stored(keyed, "near-rare-keys")
    early = keyed.where(F.col("place") <= F.col("n_shingles") - F.ceil(2 * percent * F.col("n_shingles") / (100 + percent))).alias("y")
    left = F.least(F.col("x.n_shingles") - F.col("x.place"), F.col("y.n_shingles") - F.col("y.place"))
    met = keyed.alias("x").join(early, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
                                & (F.col("y.n_shingles") <= F.col("x.n_shingles")) & ((F.col("y.n_shingles") < F.col("x.n_shingles")) | (F.col("y.id") < F.col("x.id")))
                                & ((100 + percent) * left >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles")))
                                & may_be_linked(percent)("x", "y"))
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of (doc_id, text).

    Rows are linked if 100 * |intersection| >= percent * |union| of their shingle
    sets; component_id is the smallest doc_id reachable; kept marks it. A text with
    fewer than ``shingle`` words is one shingle; a null, empty or blank text has an
    empty set and is linked with nothing. Rows that share a doc_id are one node, so
    links of either hold for both. Rows with a null doc_id are never linked
    (component_id null, kept true). Other columns of ``docs`` are not read."""
    similarity = percent / 100
    own = ["n_shingles", *(f"m{k}" for k in range(MARKS))]
    rows = stored(sketches(docs, shingle, similarity), "near-sketches")
    named = rows.where("doc_id is not null and n_shingles > 0")
    classes = stored(named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"),
                                                 F.first("keys").alias("keys"), *[F.first(c).alias(c) for c in own]), "near-classes")
    members = classes.select(F.explode("keys").alias("key"), F.col("rep").alias("id"), *own)
    links = link_lists(members, lambda p: confirmed(estimated(p, classes, similarity), docs, percent, shingle), "near",
                       lambda open_: by_rare_shingles(open_.select("id", "component").distinct(), docs, percent, shingle),
                       may_be_linked(percent))
    placed = stored(named.select("doc_id", "digest").join(classes.select("digest", "rep"), "digest")
                    .select("doc_id", "rep").distinct(), "near-placed")
    twice = placed.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("m"), F.collect_set("rep").alias("all"))
    twice = twice.where("a <> m").select("a", F.explode("all").alias("b"))
    of = connected_components(links.union(twice))
    node = (placed.groupBy("doc_id").agg(F.min("rep").alias("rep")).join(of, F.col("rep") == of.id, "left")
            .select("doc_id", F.coalesce("component", "rep").alias("found")))
    return (rows.select("doc_id", "n_shingles").join(node, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
