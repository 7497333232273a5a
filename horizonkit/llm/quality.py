"""Quality classifier: document evidence with hierarchical empirical Bayes over sites.

Two conditions are learnt from labels, low quality and toxic. For each:

* document evidence is the log likelihood ratio of the binary features that are there
  (distinct words, and binned shares of capitals, signs, digits, repeated words and the
  like). How many labelled documents of each class have a feature is one grouped count
  over all of them, in which copies (equal labels and equal smallest five-word shingle)
  count once; features whose shares differ beyond doubt (G-test) and LEAST_RATIO-fold
  are the model, at most MAX_FEATURES. A slope fitted on the binned evidence of all
  labelled documents corrects for features that go together;
* site priors are shrunken in two steps, by grouped aggregation: a host's share of
  positives toward the global share, a path's toward its host's. How strongly is
  estimated from the variance between hosts (and paths), so sparse sites stay close
  to the level above;
* the posterior is the sum of both in log odds."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import map_batches, map_stream, small, stored
from .text_arrays import NO_WORD, U64, batches, mix, shingle_sets, text_sizes, words

#: Features are kept if the G statistic of their counts is at least this ...
LEAST_G = 30.0
#: ... and their shares in the two classes differ by this factor ...
LEAST_RATIO = 4.0
#: ... and no more than so many, those of highest G (bounds the model's size).
MAX_FEATURES = 200_000
CONDITIONS = ("low", "toxic")
_FLUSH = 3_000_000
_CLASS = {n: k for k, n in enumerate(("neither", "low_only", "toxic_only", "both"))}


def _table(*of: bytes | range) -> np.ndarray:
    t = np.zeros(256, np.int64)
    for o in of:
        t[list(o)] = 1
    return t


_UPPER, _DIGITS = _table(range(65, 91)), _table(range(48, 58))
_SIGNS = _table(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"()-"))


def _share(w, table: np.ndarray) -> np.ndarray:
    """Per text the share of its bytes that are in the table."""
    run = np.concatenate([[0], np.cumsum(table[w.data])])
    size = np.maximum(1, np.diff(w.text_start) - 1)
    return (run[w.text_start[1:]] - run[w.text_start[:-1]]) / size


def features(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every distinct feature of every text, sorted by both."""
    w = words(texts, space=NO_WORD)
    n, of = np.diff(w.first), w.text_of_word()
    order = np.lexsort((w.hash, of))
    t, h = of[order], w.hash[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])]) if len(t) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    t, h, times = t[at], h[at], np.diff(np.append(at, len(order)))
    distinct = np.bincount(t, minlength=len(texts))
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, t, times)
    letters = np.bincount(of, weights=(w.end - w.start), minlength=len(texts))
    some = np.maximum(1, n)
    bins = [np.log2(some).astype(int), (10 * distinct / some).astype(int), (20 * top / some).astype(int),
            (2 * letters / some).astype(int).clip(0, 60), *((20 * np.sqrt(_share(w, x))).astype(int) for x in (_UPPER, _SIGNS, _DIGITS))]
    shape = np.concatenate([mix((b + 1000 * (k + 1)).astype(U64)) for k, b in enumerate(bins)])
    t, h = np.concatenate([t, np.tile(np.arange(len(texts)), len(bins))]), np.concatenate([h, shape])
    order = np.lexsort((h, t))
    return t[order], h[order]


def _counts(labelled: DataFrame) -> DataFrame:
    """(feature, neither, low_only, toxic_only, both): labelled documents with the feature."""

    def fn(stream):
        held, size = [], 0

        def out():
            c, h = (np.concatenate(x) for x in zip(*held))
            f, at = np.unique(h, return_inverse=True)
            n = np.bincount(at * 4 + c, minlength=4 * len(f)).reshape(-1, 4)
            return {"feature": f.view(np.int64), **{name: n[:, k] for name, k in _CLASS.items()}}

        for cols in stream:
            for i, j in batches(text_sizes(cols["text"])):
                t, h = features(cols["text"][i:j])
                c = np.array([(low == 1) + 2 * (toxic == 1) for low, toxic in zip(cols["low"][i:j], cols["toxic"][i:j])])
                held.append((c[t], h))
                size += len(h)
                if size > _FLUSH:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    names = list(_CLASS)
    partial = map_stream(labelled.select("text", "low", "toxic"), fn, "feature bigint, " + ", ".join(f"{n} bigint" for n in names))
    return partial.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])


def _log(x: Column) -> Column:
    return F.when(x > 0, F.log(F.greatest(x, F.lit(1e-300)))).otherwise(0.0)


def _model(counts: DataFrame, have: int, lack: int, positive: tuple[str, str], negative: tuple[str, str]):
    """(features, ascending, and their log likelihood ratios) as arrays."""
    a, b = (F.col(x[0]) + F.col(x[1]) for x in (positive, negative))
    total = have + lack
    if not have or not lack:
        return np.zeros(0, U64), np.zeros(0)
    both = a + b
    g = sum((2 * o * (_log(o.cast("double")) - _log(both * n / total)) for o, n in ((a, have), (b, lack))), F.lit(0.0))
    g = g + sum((2 * (n - o) * (_log((n - o).cast("double")) - _log((total - both) * n / total)) for o, n in ((a, have), (b, lack))), F.lit(0.0))
    ratio = F.log((a + 0.5) / (have + 1.0)) - F.log((b + 0.5) / (lack + 1.0))
    rows = (counts.select("feature", ratio.alias("r"), g.alias("g"))
            .where((F.col("g") >= LEAST_G) & (F.abs("r") >= math.log(LEAST_RATIO)))
            .orderBy(F.desc("g"), "feature").limit(MAX_FEATURES).collect())
    f = np.array([r.feature for r in rows], np.int64).view(U64)
    order = np.argsort(f)
    return f[order], np.array([r.r for r in rows], float)[order]


def _once(labelled: DataFrame) -> DataFrame:
    """(rid, low, toxic): one labelled document of each group of copies."""

    def fn(cols):
        for i, j in batches(text_sizes(cols["text"])):
            sets = shingle_sets(words(cols["text"][i:j]))
            yield {"rid": cols["rid"][i:j], "low": cols["low"][i:j], "toxic": cols["toxic"][i:j],
                   "key": [int(x[:1].view(np.int64)[0]) if len(x) else None for x in sets]}

    keys = map_batches(labelled, fn, "rid bigint, low int, toxic int, key bigint")
    return keys.groupBy("key", "low", "toxic").agg(F.min("rid").alias("rid")).select("rid", "low", "toxic").distinct()


def _evidence(docs: DataFrame, models: dict) -> DataFrame:
    """(doc_id, host, path, low, toxic): document evidence of each row."""
    sent = docs.sparkSession.sparkContext.broadcast(models)  # at most MAX_FEATURES a condition

    def fn(cols):
        for i, j in batches(text_sizes(cols["text"])):
            t, h = features(cols["text"][i:j])
            out = {n: cols[n][i:j] for n in ("doc_id", "host", "path")}
            for name, (f, ratio) in sent.value.items():
                e = np.zeros(j - i)
                if len(f):
                    at = np.minimum(np.searchsorted(f, h), len(f) - 1)
                    hit = np.flatnonzero(f[at] == h)
                    e += np.bincount(t[hit], weights=ratio[at[hit]], minlength=j - i)
                out[name] = e
            yield out

    return map_batches(docs.select("doc_id", "host", "path", "text"), fn,
                       "doc_id bigint, host string, path string, low double, toxic double")


def _slope(known: DataFrame, name: str, prior: float) -> float:
    """Maximum likelihood slope of the evidence beside the prior, on its histogram."""
    rows = (known.where(F.col(f"is_{name}").isNotNull())
            .groupBy(F.round(F.greatest(F.lit(-200.0), F.least(F.lit(200.0), name)), 1).alias("e"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(f"is_{name}").alias("k")).collect())  # at most 4001 bins
    e, n, k = (np.array([r[x] for r in rows], float) for x in ("e", "n", "k"))
    low, high = 0.0, 4.0
    for _ in range(60):  # the score function falls with the slope
        a = (low + high) / 2
        p = 1 / (1 + np.exp(-np.clip(prior + a * e, -500, 500)))
        low, high = (a, high) if ((k - n * p) * e).sum() > 0 else (low, a)
    return low if len(rows) else 1.0


def _strength(units: DataFrame) -> float:
    """Prior weight (in labelled documents) from the variance between units (n, k, m),
    m being the share expected from the level above: moments of the beta-binomial."""
    share = F.col("k") / F.col("n")
    r = units.where("n > 0").agg(F.count(F.lit(1)).alias("units"), F.sum("n").alias("n"),
                                 F.sum(F.col("n") * F.col("n").cast("double")).alias("n2"),
                                 F.sum(F.col("n") * (share - F.col("m")) ** 2 / (F.col("m") * (1 - F.col("m")))).alias("s")).first()
    if not r.n or r.units < 2 or r.n - r.n2 / r.n - (r.units - 1) <= 0:
        return 1e4
    rho = (r.s - (r.units - 1)) / (r.n - r.n2 / r.n - (r.units - 1))
    rho = min(0.9, max(1e-4, rho))
    return (1 - rho) / rho


def site_priors(known: DataFrame, name: str, overall: float) -> tuple[DataFrame, DataFrame]:
    """(host, prior) and (host, path, prior) of a condition: posterior shares of
    positives, shrunken toward ``overall`` and toward the host."""
    y = F.col(f"is_{name}")
    paths = stored(known.where(y.isNotNull()).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("k")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("m", F.lit(overall))
    weight = _strength(hosts)
    hosts = stored(hosts.select("host", ((F.col("k") + weight * overall) / (F.col("n") + weight)).alias("prior")), "quality-hosts")
    within = paths.join(hosts.withColumnRenamed("prior", "m"), "host")
    weight = _strength(within)
    return hosts, within.select("host", "path", ((F.col("k") + weight * F.col("m")) / (F.col("n") + weight)).alias("prior"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", reject: float = 0.5) -> DataFrame:
    """(doc_id, low, toxic, low_evidence, toxic_evidence, kept) of every row of
    ``docs`` (doc_id, text, and the host and path columns): posterior probabilities of
    both conditions, log likelihood ratios of the text alone, and whether neither
    posterior is above ``reject``.

    ``labels`` (doc_id, quality, toxic): quality 0 is low; of several rows of a doc_id
    the worst counts; a null label leaves its condition unknown. Without labels of both
    classes a condition has no evidence, and its prior is its share (0.5 if unknown, so
    nothing is rejected). Null hosts or paths are a site of their own; a null doc_id
    has no label; a null text is empty. Every row gives one row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"))
    truth = stored(labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
                   .agg(F.max(1 - F.col("quality")).alias("is_low"), F.max("toxic").alias("is_toxic")), "quality-labels")
    side = small(truth)
    labelled = rows.join(side, "doc_id").select("text", F.xxhash64("doc_id", "text").alias("rid"),
                                                F.col("is_low").cast("int").alias("low"), F.col("is_toxic").cast("int").alias("toxic"))
    once = stored(_once(labelled), "quality-once")
    seen = once.groupBy("low", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    counted = labelled.join(small(once.select("rid")), "rid", "left_semi")
    counts = stored(_counts(counted).where("neither + low_only + toxic_only + both >= 5"), "quality-counts")
    number = {c: sum(r.n for r in seen if (r.low == 1) + 2 * (r.toxic == 1) == k) for c, k in _CLASS.items()}
    classes = {"low": (("low_only", "both"), ("neither", "toxic_only")), "toxic": (("toxic_only", "both"), ("neither", "low_only"))}
    models, overall = {}, {}
    for name, (yes, no) in classes.items():
        have, lack = (sum(number[c] for c in x) for x in (yes, no))
        models[name] = _model(counts, have, lack, yes, no)
        overall[name] = (have + 0.5) / (have + lack + 1)
    scored = stored(_evidence(rows, models), "quality-evidence")
    known = stored(scored.join(side, "doc_id"), "quality-known")
    out = scored
    for name in CONDITIONS:
        slope = _slope(known, name, math.log(overall[name] / (1 - overall[name])))
        hosts, paths = site_priors(known, name, overall[name])
        out = (out.join(hosts.withColumnRenamed("prior", "_host"), "host", "left")
               .join(paths.withColumnRenamed("prior", "_path"), ["host", "path"], "left"))
        prior = F.coalesce("_path", "_host", F.lit(overall[name]))
        odds = F.log(prior / (1 - prior)) + slope * F.col(name)
        out = (out.withColumn(f"_{name}", 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))))).drop("_host", "_path"))
    return out.select("doc_id", F.col("_low").alias("low"), F.col("_toxic").alias("toxic"), F.col("low").alias("low_evidence"),
                      F.col("toxic").alias("toxic_evidence"),
                      ((F.col("_low") <= reject) & (F.col("_toxic") <= reject)).alias("kept"))
