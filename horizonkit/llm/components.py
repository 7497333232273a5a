"""Connected components over Spark DataFrames, and exact components of
near-duplicate lists without all pairs of a list."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import small, stored

#: Lists of up to this many members are compared pair by pair (so at most half
#: as many pairs per member); longer ones go through pivots first.
SMALL_LIST = 24
PIVOTS = 2
MAX_ROUNDS = 60


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) pairs to (id, component): the smallest id reachable, for every id in
    an edge with two different ends.

    Alternates "large star" (every larger neighbour of a node is hung on the
    node's smallest neighbour) and "small star" (every smaller neighbour is), until
    the edges stop changing: O(log n) rounds, each one grouped minimum and one join,
    each written out. No group is ever gathered in one task. Null ends and
    self-loops are ignored; repeated edges count once; no edges give no rows."""
    e = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .where("a <> b").distinct(), "cc")
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a <> b").distinct())
        e = stored(small, "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before = now
    raise RuntimeError("connected components did not converge")


def _any(x: str, y: str) -> Column:
    return F.lit(True)


def list_pairs(members: DataFrame, may: Callable[[str, str], Column] = _any, part: Column | None = None) -> DataFrame:
    """Pairs (a < b) of members (key, id, n) that share a list (of length n): all pairs of a short
    list; of a long one each of PIVOTS members with all others: those whose long lists
    have most members, as the text that others were copied from keeps all its keys. Rows made
    are at most SMALL_LIST / 2 per member, whatever the lengths. ``may``, ``part``: as for ``link_lists``."""
    part = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(PIVOTS)) if part is None else part
    short, own = members.where(F.col("n") <= SMALL_LIST).drop("n"), [c for c in members.columns if c not in ("key", "n")]
    pairs = _met(short, short, (F.col("x.id") < F.col("y.id")) & may("x", "y"))
    long = members.where(F.col("n") > SMALL_LIST)
    central = long.groupBy("id").agg(F.sum("n").alias("weight"))
    pivots = (long.join(central, "id").groupBy("key", part.alias("part"))
              .agg(F.max(F.struct("weight", F.xxhash64("id").alias("o"), *own)).alias("p"))
              .select("key", *[F.col(f"p.{c}").alias(c) for c in own]))
    starred = _met(long, pivots, (F.col("x.id") != F.col("y.id")) & may("x", "y"))
    return pairs.union(starred).distinct()


def _met(x: DataFrame, y: DataFrame, on: Column) -> DataFrame:
    """Pairs (a, b) of the ids of rows that share a key and meet the condition."""
    met = x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & on)
    return met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _open_pairs(still: DataFrame, may: Callable[[str, str], Column] = _any) -> DataFrame:
    """Pairs (a, b) of (key, id, component) that share a key in different components."""
    return _met(still, still, (F.col("x.component") < F.col("y.component")) & may("x", "y")).distinct()


def link_lists(members: DataFrame, verify: Callable[[DataFrame], DataFrame], name: str,
               narrower: Callable[[DataFrame], DataFrame] | None = None,
               may: Callable[[str, str], Column] = _any, known: DataFrame | None = None,
               part: Column | None = None) -> DataFrame:
    """Edges (a, b) with the components of all links among members of inverted lists.

    ``members``: (key, id), a pair is a candidate if it shares a key. ``verify``
    maps pairs (a, b) to those that are links. Every short list is compared pair by
    pair. In a long one, pivots are compared with all members; members that this
    joins to one component need no further pair, and every pair whose ends are still
    in two components is compared, none left out. So a dense group of n near-copies
    costs about n pairs, and the components are those of comparing everything.
    ``narrower`` may give fewer pairs of the open lists (key, id, component): all that
    can be links between two components. ``may`` is a condition that every link between
    members of two aliases holds, by more columns of ``members``; no other pair is made.
    ``known`` are links (a, b) found before: they join components too, and are among the
    edges. ``part`` (of few values that ``may`` lets meet) deals a long list out, with a pivot each."""
    own = [c for c in members.columns if c != "key"]
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(members.join(sizes, "key").select("key", *own, "n"), f"{name}-lists")
    links = stored(verify(list_pairs(members, may, part)), f"{name}-links")
    links = links if known is None else links.union(known.select("a", "b"))
    long = members.where(F.col("n") > SMALL_LIST).drop("n")
    if long.isEmpty():
        return links
    of = connected_components(links)
    node = small(of.select(F.col("id").alias("node"), "component"))
    placed = long.join(node, long.id == F.col("node"), "left").select("key", *own, F.coalesce("component", "id").alias("component"))
    ends = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    still = stored(placed.join(ends.select("key"), "key", "left_semi"), f"{name}-open")
    return of.select(F.col("id").alias("a"), F.col("component").alias("b")).union(
        stored(verify(narrower(still) if narrower else _open_pairs(still, may)), f"{name}-links"))
