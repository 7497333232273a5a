"""Katz backoff language model: Good-Turing discounted unigram and bigram counts with
exactly normalised backoff weights, held in partitioned tables.

P(w | h) = d(c) c / c(h) for a bigram seen c times, else alpha(h) P(w); P(w) is the
discounted unigram share, and what the discounts leave over is the share of the class of
unseen words. alpha(h) spreads the mass that the context's discounts leave over exactly
the words not seen after h, so both levels sum to one over the training words and that
class. A text starts in a start context and closes with an end token.

The corpus is cut into chunks of tokens, kept as arrays (one row a chunk). Counting is
two exchanges of the chunks' distinct keys with hash partitions, words first, then
bigrams by context; each partition adds up, keeps its part of the model table, and
answers every chunk for its own keys. Contexts with more than an even partition's share
of all tokens are split over several by the following word, and their sums added up
afterwards. The chunk table is bucketed by chunk, so that only answers travel to it."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import map_stream, parts
from .text_arrays import U64, batches, mix, text_sizes, words

CHUNK_TOKENS = 800_000
MOST_DISCOUNTED = 5
FOLDS, HELD_OUT = 7, 2
UNSEEN, START, FIRST_ID = 0, 1, 2
_END = mix(np.array([0xE0D], U64))[0]


def held_out(doc_id) -> bool:
    """Whether a document is kept from training (null ids are not)."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def pack(x: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes."""
    x = np.ascontiguousarray(x, dtype=np.int64).view(np.uint8).reshape(-1, 8).T
    used = [k for k in range(8) if x[k].any()]
    width = used[-1] + 1 if used else 0
    return bytes([width]) + x.shape[1].to_bytes(8, "little") + zstandard.compress(np.ascontiguousarray(x[:width]).tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    width, n = b[0], int.from_bytes(b[1:9], "little")
    out = np.zeros((8, n), np.uint8)
    if width:
        out[:width] = np.frombuffer(zstandard.decompress(b[9:], max_output_size=max(1, width * n)), np.uint8).reshape(width, n)
    return np.ascontiguousarray(out.T).view(np.int64).reshape(-1)


def _steps(x: np.ndarray) -> np.ndarray:
    """Ascending values as differences (undone by a running sum)."""
    return np.diff(x, prepend=x.dtype.type(0))


def chunks(docs: DataFrame, tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row per chunk: documents, their token counts and the tokens as positions in
    the chunk's sorted distinct word hashes, with each word's training count."""

    def fn(stream):
        held, size, number = [], 0, 0

        def out():
            ids, hashes, n = [x for h in held for x in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            known, at = np.unique(hashes, return_inverse=True)
            out_of = np.array([held_out(i) for i in ids])
            train = np.bincount(at, weights=np.repeat(~out_of, n), minlength=len(known))
            return {"chunk": [TaskContext.get().partitionId() << 24 | number], "doc_id": [ids], "n": [pack(n)],
                    "held": [out_of], "tokens": [pack(at)], "hashes": [pack(_steps(known).view(np.int64))], "counts": [pack(train)]}

        for cols in stream:
            for i, j in batches(text_sizes(cols["text"])):
                w = words(cols["text"][i:j])
                n = np.diff(w.first) + 1
                h = np.full(int(n.sum()), _END, U64)
                h[np.arange(len(w.hash)) + w.text_of_word()] = w.hash
                held.append((cols["doc_id"][i:j], h, n))
                size += len(h)
                if size >= tokens:
                    yield out()
                    held, size, number = [], 0, number + 1
        if held:
            yield out()

    return map_stream(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), fn,
                      "chunk bigint, doc_id array<bigint>, n binary, held array<boolean>, tokens binary, hashes binary, counts binary")


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """Written as a table bucketed by ``chunk`` below the shared checkpoint folder."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    (df.write.bucketBy(parts(df), "chunk").sortBy("chunk").option("compression", "none")
     .option("path", scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def _kinds(df: DataFrame, name: str) -> dict[str, DataFrame]:
    """Written with one folder per ``kind``; a reader of one kind reads no other."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy("kind").parquet(path)
    schema = df.drop("kind").schema.add("kind", "string")
    read = df.sparkSession.read.schema(schema).parquet(path)
    return {k: read.where(F.col("kind") == k).drop("kind") for k in ("reply", "model", "stats")}


def _grouped(stream, key: str):
    """(key value, {column: list}) of each run of equal keys."""
    last, rows = None, {}
    for cols in stream:
        edges = [0, *(np.flatnonzero(np.diff(np.array(cols[key]))) + 1).tolist(), len(cols[key])]
        for i, j in zip(edges[:-1], edges[1:]):
            if cols[key][i] != last:
                if rows:
                    yield last, rows
                last, rows = cols[key][i], {n: [] for n in cols}
            for n in cols:
                rows[n] += cols[n][i:j]
    if rows:
        yield last, rows


_UNIGRAM = "kind string, bucket int, chunk bigint, a binary, b binary, c binary, of_count array<bigint>"


def _of_counts(c: np.ndarray) -> np.ndarray:
    """How many values are 1, 2, ... MOST_DISCOUNTED + 1, how many at all, and their sum."""
    n = np.bincount(np.minimum(c, MOST_DISCOUNTED + 2), minlength=MOST_DISCOUNTED + 3)[1:MOST_DISCOUNTED + 2]
    return np.concatenate([n, [(c > 0).sum(), c.sum()]]).astype(np.int64)


def unigrams(table: DataFrame, buckets: int) -> dict[str, DataFrame]:
    """Words counted over all chunks: ``reply`` (chunk, bucket, a: global ids, b: counts
    of the chunk's words), ``model`` (bucket, a: word hashes, b: ids, c: counts) and
    ``stats``. Ids go by falling count within a partition; a word that training lacks
    has id UNSEEN."""

    def ask(stream):
        for cols in stream:
            for chunk, hashes, counts in zip(cols["chunk"], cols["hashes"], cols["counts"]):
                h, n = np.cumsum(unpack(hashes).view(U64), dtype=U64), unpack(counts)
                edge = np.searchsorted(((h >> U64(32)) * U64(buckets)) >> U64(32), np.arange(buckets + 1, dtype=U64))
                some = np.flatnonzero(np.diff(edge)).tolist()
                yield {"bucket": some, "chunk": [chunk] * len(some),
                       "a": [pack(_steps(h[edge[b]:edge[b + 1]]).view(np.int64)) for b in some],
                       "b": [pack(n[edge[b]:edge[b + 1]]) for b in some]}

    def answer(stream):
        for bucket, rows in _grouped(stream, "bucket"):
            each = [np.cumsum(unpack(a).view(U64), dtype=U64) for a in rows["a"]]
            known, at = np.unique(np.concatenate(each), return_inverse=True)
            total = np.bincount(at, weights=np.concatenate([unpack(b) for b in rows["b"]])).astype(np.int64)
            rank = np.empty(len(known), np.int64)
            rank[np.argsort(-total, kind="stable")] = np.arange(len(known))
            ids = np.where(total > 0, rank * buckets + bucket + FIRST_ID, UNSEEN)
            cut = np.cumsum([0, *map(len, each)])
            n = len(each)
            yield {"kind": ["reply"] * n + ["model", "stats"], "bucket": [bucket] * (n + 2), "chunk": rows["chunk"] + [None, None],
                   "a": [pack(ids[at[i:j]]) for i, j in zip(cut[:-1], cut[1:])] + [pack(_steps(known[total > 0]).view(np.int64)), None],
                   "b": [pack(total[at[i:j]]) for i, j in zip(cut[:-1], cut[1:])] + [pack(ids[total > 0]), None],
                   "c": [None] * n + [pack(total[total > 0]), None], "of_count": [None] * (n + 1) + [_of_counts(total)]}

    asked = map_stream(table.select("chunk", "hashes", "counts"), ask, "bucket int, chunk bigint, a binary, b binary")
    return _kinds(map_stream(asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk"), answer, _UNIGRAM), "lm-unigrams")


def _totals(stats: DataFrame) -> np.ndarray:
    rows = stats.select(F.posexplode("of_count").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(MOST_DISCOUNTED + 3, np.int64)
    for r in rows:
        out[r.k] = r.n
    return out


def discounts(of_count: np.ndarray) -> np.ndarray:
    """Katz factors d[r] for counts r (1 beyond MOST_DISCOUNTED), from the numbers of
    keys seen 1, 2, ... times. Good-Turing with the highest cut-off k <= MOST_DISCOUNTED
    whose factors all lie between 0 and 1; a corpus too small for any takes a constant
    n1 / (n1 + 2 n2) (0.5 without n1) off each count up to MOST_DISCOUNTED."""
    n = np.concatenate([[0], of_count[:MOST_DISCOUNTED + 1]]).astype(float)
    d = np.ones(MOST_DISCOUNTED + 2)
    for k in range(MOST_DISCOUNTED, 1, -1):
        if n[1:k + 2].all():
            r, x = np.arange(1, k + 1), (k + 1) * n[k + 1] / n[1]
            f = ((r + 1) * n[2:k + 2] / (r * n[1:k + 1]) - x) / (1 - x) if x < 1 else np.zeros(k)
            if (f > 0).all() and (f < 1).all():
                d[1:k + 1] = f
                return d
    r = np.arange(1, MOST_DISCOUNTED + 1)
    d[1:MOST_DISCOUNTED + 1] = (r - (n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5)) / r
    return d


class Unigrams:
    """P(w) by training count; 0 stands for the class of unseen words."""

    def __init__(self, of_count: np.ndarray):
        self.d, self.types, self.tokens = discounts(of_count), int(of_count[-2]), int(of_count[-1])
        n = of_count[:MOST_DISCOUNTED]
        lost = float((n * np.arange(1, MOST_DISCOUNTED + 1) * (1 - self.d[1:MOST_DISCOUNTED + 1])).sum())
        self.all = self.tokens + (0 if lost else 1)  # nothing discounted: one more for the unseen
        self.unseen = (lost or 1) / self.all

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.d[np.minimum(c, MOST_DISCOUNTED + 1)] * c / self.all, self.unseen)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + self.types + 1))


class Pairs:
    """Distinct (context, word) of a chunk by partition, context and word."""

    def __init__(self, tokens, n, out_of, ids, counts, buckets: int, all_tokens: int):
        self.ids, self.counts, m = ids, counts, len(ids)
        word = np.where(ids[tokens] == UNSEEN, m, tokens)  # unseen words are one
        context = np.concatenate([[m + 1], word[:-1]])
        context[np.cumsum(n)[:-1]] = m + 1
        key, self.at = np.unique(context * (m + 2) + word, return_inverse=True)
        train = np.bincount(self.at, weights=np.repeat(~out_of, n), minlength=len(key)).astype(np.int64)
        g, c = np.concatenate([ids, [UNSEEN, START]]), np.concatenate([counts, [0, all_tokens]])
        h, w = key // (m + 2), key % (m + 2)
        shares = -(-c[h] * buckets // max(1, all_tokens))
        self.hot = shares > 1
        part = mix(g[w].astype(U64)) % np.maximum(shares, 1).astype(U64)
        bucket = (mix(g[h].astype(U64) + U64(1)) + part) % U64(buckets)
        asked = g[h] != UNSEEN
        order = np.lexsort((g[w], g[h], self.hot, bucket, ~asked))
        self.order, self.h, self.w, self.c, self.train = order, g[h][order], g[w][order], c[w][order], train[order]
        self.hot, self.bucket, self.asked = self.hot[order], bucket[order].astype(np.int64), int(asked.sum())
        new = (np.diff(self.bucket[:self.asked]) != 0) | (np.diff(self.hot[:self.asked]) != 0)
        self.edges = np.concatenate([[0], np.flatnonzero(new) + 1, [self.asked]]) if self.asked else np.zeros(1, np.int64)

    def groups(self):
        """(bucket, hot, slice) of each partition's part."""
        for i, j in zip(self.edges[:-1].tolist(), self.edges[1:].tolist()):
            yield int(self.bucket[i]), bool(self.hot[i]), slice(i, j)


def _of_chunk(cols, k: int):
    """Arrays of the k-th chunk: tokens, n, held out, ids, counts."""
    answers = sorted(cols["words"][k] or [], key=lambda r: r["bucket"])
    both = (np.concatenate([np.zeros(0, np.int64), *(unpack(r[x]) for r in answers)]) for x in "ab")
    return unpack(cols["tokens"][k]), unpack(cols["n"][k]), np.array(cols["held"][k], bool), *both


_SUMS = 3 + MOST_DISCOUNTED  # of a context: c(h), sum of P(w), sum of counts beyond, numbers of 1, 2, ...
_BIGRAM = "kind string, bucket int, chunk bigint, hot boolean, a binary, b binary, c binary, h array<bigint>, sums array<double>, of_count array<bigint>"


def bigrams(joined: DataFrame, first: Unigrams, buckets: int) -> dict[str, DataFrame]:
    """Bigrams counted over all chunks: ``reply`` (chunk, bucket, hot, a: counts of the
    asked pairs, sums by context), ``model`` (bucket, a: contexts, b: words, c: counts)
    and ``stats`` (with sums of the split contexts)."""

    def ask(stream):
        for cols in stream:
            for k, chunk in enumerate(cols["chunk"]):
                p = Pairs(*_of_chunk(cols, k), buckets, first.tokens)
                out = {n: [] for n in ("bucket", "hot", "chunk", "h", "w", "c", "n")}
                for bucket, hot, s in p.groups():
                    for n, v in zip(out, (bucket, hot, chunk, pack(_steps(p.h[s])), pack(p.w[s]), pack(p.c[s]), pack(p.train[s]))):
                        out[n].append(v)
                yield out

    def answer(stream):
        for bucket, rows in _grouped(stream, "bucket"):
            for hot in (False, True):
                own = [k for k, x in enumerate(rows["hot"]) if x == hot]
                if own:
                    yield _answer({n: [v[k] for k in own] for n, v in rows.items()}, bucket, hot, first)

    asked = map_stream(joined, ask, "bucket int, hot boolean, chunk bigint, h binary, w binary, c binary, n binary")
    dealt = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    return _kinds(map_stream(dealt, answer, _BIGRAM), "lm-bigrams")


def _answer(rows: dict, bucket: int, hot: bool, first: Unigrams) -> dict:
    each = [np.cumsum(unpack(x)) for x in rows["h"]]
    context, at = np.unique(np.concatenate(each), return_inverse=True)
    word, c, n = (np.concatenate([unpack(x) for x in rows[k]]) for k in "wcn")
    low = np.lexsort((word, at))
    new = np.concatenate([[True], (np.diff(at[low]) != 0) | (np.diff(word[low]) != 0)])
    pair = np.empty(len(low), np.int64)
    pair[low] = np.cumsum(new) - 1
    total = np.bincount(pair, weights=n).astype(np.int64)
    lead = low[new]  # one place of each distinct pair
    h_of, seen = at[lead], total > 0
    sums = np.zeros((len(context), _SUMS))
    sums[:, 0] = np.bincount(h_of, weights=total, minlength=len(context))
    sums[:, 1] = np.bincount(h_of, weights=seen * first.p(c[lead]), minlength=len(context))
    sums[:, 2] = np.bincount(h_of, weights=total * (total > MOST_DISCOUNTED), minlength=len(context))
    for r in range(1, MOST_DISCOUNTED + 1):
        sums[:, 2 + r] = np.bincount(h_of, weights=total == r, minlength=len(context))
    cut, m = np.cumsum([0, *map(len, each)]), len(each)
    back = []  # the sums of a chunk's contexts, in its order
    for i, j in zip(cut[:-1], cut[1:]):
        mine = at[i:j][np.concatenate([[True], np.diff(at[i:j]) != 0])]
        whole = np.delete(sums[mine], 1, axis=1).astype(np.int64).T.reshape(-1)
        back.append((b"", b"") if hot else (pack(whole), sums[mine, 1].tobytes()))
    return {"kind": ["reply"] * m + ["model", "stats"], "bucket": [bucket] * (m + 2), "chunk": rows["chunk"] + [None] * 2,
            "hot": [hot] * (m + 2), "a": [pack(total[pair[i:j]]) for i, j in zip(cut[:-1], cut[1:])] + [pack(_steps(context[h_of[seen]])), None],
            "b": [x for x, _ in back] + [pack(word[lead][seen]), None], "c": [x for _, x in back] + [pack(total[seen]), None],
            "h": [None] * (m + 1) + [context if hot else []], "sums": [None] * (m + 1) + [sums.reshape(-1) if hot else []],
            "of_count": [None] * (m + 1) + [_of_counts(total)]}


def context_weights(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, alpha) of contexts from their sums. A context none of whose counts
    is discounted counts one more, so that some mass is left."""
    r = np.arange(1, MOST_DISCOUNTED + 1)
    lost = (sums[:, 3:] * r * (1 - d[1:MOST_DISCOUNTED + 1])).sum(axis=1)
    all_of = sums[:, 0] + (lost <= 0)
    left = np.where(lost > 0, lost, 1.0) / np.maximum(all_of, 1)
    return np.maximum(all_of, 1), np.where(sums[:, 0] > 0, left / np.maximum(1 - sums[:, 1], 1e-300), 1.0)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row
    of (doc_id, text), the model learnt from the rows not held out.

    Tokens are the lower-cased (A-Z) words and one end; base_score is the add-one unigram
    log10 probability, score that of this model. A null or empty text is its end alone; a
    null doc_id is in training; repeated rows count each time. Without training rows
    every token is of the unseen class. No rows give no rows."""
    buckets = parts(docs)
    table = _bucketed(chunks(docs), "lm_chunks")
    uni = unigrams(table, buckets)
    first = Unigrams(_totals(uni["stats"]))
    answers = uni["reply"].groupBy("chunk").agg(F.collect_list(F.struct("bucket", "a", "b")).alias("words"))
    body = table.select("chunk", "doc_id", "n", "held", "tokens")
    joined = body.join(answers, "chunk", "left")
    bi = bigrams(joined.select("chunk", "n", "held", "tokens", "words"), first, buckets)
    d = discounts(_totals(bi["stats"]))
    split = bi["stats"].where("hot").select("h", "sums").collect()  # at most a few rows a partition
    merged: dict[int, np.ndarray] = {}
    for r in split:
        for h, s in zip(r.h, np.array(r.sums).reshape(-1, _SUMS)):
            merged[h] = merged.get(h, 0) + s
    hot_ids = np.array(sorted(merged), np.int64)
    hot_all, hot_alpha = context_weights(np.array([merged[h] for h in hot_ids.tolist()]).reshape(-1, _SUMS), d)

    def fn(stream):
        for cols in stream:
            for k in range(len(cols["chunk"])):
                tokens, n, out_of, ids, counts = _of_chunk(cols, k)
                p = Pairs(tokens, n, out_of, ids, counts, buckets, first.tokens)
                told = {(r["bucket"], r["hot"]): r for r in cols["pairs"][k] or []}
                logs = np.log10(first.p(p.c))  # contexts that training lacks
                for bucket, hot, s in p.groups():
                    r, h = told[bucket, hot], p.h[s]
                    total = unpack(r["a"])
                    new = np.concatenate([[True], np.diff(h) != 0])
                    if hot:
                        at = np.searchsorted(hot_ids, h)
                        all_of, alpha = hot_all[at], hot_alpha[at]
                    else:
                        whole = unpack(r["b"]).reshape(_SUMS - 1, -1).T.astype(float)
                        sums = np.insert(whole, 1, np.frombuffer(r["c"], float), axis=1)
                        all_of, alpha = (x[np.cumsum(new) - 1] for x in context_weights(sums, d))
                    seen = d[np.minimum(total, MOST_DISCOUNTED + 1)] * total / all_of
                    logs[s] = np.log10(np.where(total > 0, seen, alpha * first.p(p.c[s])))
                by_pair = np.empty(len(logs))
                by_pair[p.order] = logs
                of = np.repeat(np.arange(len(n)), n)
                c = counts[tokens]
                yield {"doc_id": cols["doc_id"][k], "held_out": out_of, "n_tokens": n,
                       "n_known": np.bincount(of, weights=c > 0).astype(np.int64), "train_tokens": np.full(len(n), first.tokens),
                       "base_score": np.bincount(of, weights=first.base(c)), "score": np.bincount(of, weights=by_pair[p.at])}

    told = bi["reply"].groupBy("chunk").agg(F.collect_list(F.struct("bucket", "hot", "a", "b", "c")).alias("pairs"))
    return map_stream(joined.join(told, "chunk", "left"), fn,
                      "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
