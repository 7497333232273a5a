"""Token ids in binary shard files with a minimal perfect hash index.

A shard file holds the raw ids of a range of documents (unsigned 16- or 32-bit,
ascending doc_id), then an index, then a fixed footer:

    ids | displacements i4[b] | slots (fingerprint u4, record u4)[m] | keys i8[n] |
    first ids u8[n + 1] | footer (magic, id size, records, distinct keys, null keys, b)

The index is a hash-and-displace minimal perfect hash of the m distinct keys: a key's
bucket gives a displacement, that gives one of exactly m slots, and the slot's stored
32-bit fingerprint tells a foreign key from the owner (the full key is then compared).
So any document is found with a constant number of reads. A manifest (one row a
shard) names the files and their key ranges; a task attempt writes a file of its own
and only committed attempts are in the manifest, so lost or repeated tasks do no harm."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .tables import map_batches, map_stream, parts, stored
from .text_arrays import U64, mix
from .tokens import encoder

END_ID = 2
_FOOTER = "<8sIQQQQ"
_FOOTER_BYTES = struct.calcsize(_FOOTER)
_MAGIC = b"TOKSHRD1"
_STEP = U64(0x9E3779B97F4A7C15)
_KEYS_PER_BUCKET = 4
_MANIFEST = ("shard int, path string, records bigint, ids bigint, null_keys bigint, "
             "low bigint, high bigint")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, as tasks open it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h >> U64(32)) % U64(max(1, buckets))


def _slot(h: np.ndarray, displacement, m: int) -> np.ndarray:
    return mix(h + np.atleast_1d(displacement) * _STEP) % U64(m)


def _hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(U64) + _STEP)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacements, slots) of distinct integer keys; slots hold (fingerprint,
    position of the key). A bucket of one key names its slot directly (-1 - slot)."""
    m = len(keys)
    buckets = -(-m // _KEYS_PER_BUCKET)
    h = _hash(keys)
    displacement, owner = np.zeros(buckets, np.int32), np.full(m, -1, np.int64)
    order = np.argsort(_bucket(h, buckets), kind="stable")
    edges = np.searchsorted(_bucket(h, buckets)[order], np.arange(buckets + 1, dtype=U64))
    sizes = np.diff(edges)
    for b in np.argsort(-sizes, kind="stable").tolist():
        own = order[edges[b]:edges[b + 1]]
        if len(own) <= 1:
            break
        first = 0
        while True:
            tries = np.arange(first, first + 64, dtype=U64)
            at = np.sort(_slot(h[own][None, :], tries[:, None], m), axis=1)
            good = (owner[at] < 0).all(axis=1) & (np.diff(at, axis=1) != 0).all(axis=1)
            if good.any():
                displacement[b] = first + int(good.argmax())
                owner[_slot(h[own], U64(displacement[b]), m)] = own
                break
            first += 64
    free = np.flatnonzero(owner < 0)
    single = np.flatnonzero(sizes == 1)
    displacement[single] = -1 - free
    owner[free] = order[edges[single]]
    slots = np.zeros(m, [("fingerprint", "<u4"), ("record", "<u4")])
    slots["fingerprint"], slots["record"] = (h[owner] & U64(0xFFFFFFFF)).astype(np.uint32), owner
    return displacement, slots


def find(keys: np.ndarray, displacement: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Position of each key among those indexed, or -1 where the fingerprint differs."""
    if not len(slots):
        return np.full(len(keys), -1, np.int64)
    h = _hash(keys)
    d = displacement[_bucket(h, len(displacement)).astype(np.int64)].astype(np.int64)
    at = np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0).astype(U64), len(slots)).astype(np.int64))
    hit = slots["fingerprint"][at] == (h & U64(0xFFFFFFFF)).astype(np.uint32)
    return np.where(hit, slots["record"][at].astype(np.int64), -1)


def write_shards(docs: DataFrame, vocabulary: str, end_id: int = END_ID, folder: str | None = None,
                 shards: int | None = None) -> DataFrame:
    """Encode every whole text (null: empty), append ``end_id`` and write the shards in
    ascending (doc_id, text) order, null ids first; returns the manifest. Repeated rows
    are separate records. An empty table makes no file."""
    folder = folder or scratch_path(docs.sparkSession, "token-shards")
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
            .repartitionByRange(shards or parts(docs), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
            .select("doc_id", "text"))
    last = np.array([end_id], "<u4").tobytes()

    def write(stream):
        out = None
        keys, sizes, nulls = [], [], 0
        for b in stream:
            if out is None:
                e, task = encoder(vocabulary), TaskContext.get()
                kind = "<u2" if max(e.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
                fs, at = filesystem(folder)
                fs.create_dir(at, recursive=True)
                name = f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
                out = fs.open_output_stream(f"{at}/{name}")
            ids_of = e.encode(b["text"])
            for key, ids in zip(b["doc_id"], ids_of):
                ids = np.frombuffer(ids + last, "<u4")
                out.write(ids.astype(kind).tobytes())
                nulls += key is None
                keys.append(key or 0)
                sizes.append(len(ids))
        if out is None:
            return
        known = np.array(keys, "<i8")
        first = np.concatenate([[0], np.cumsum(np.array(sizes, np.uint64))]).astype("<u8")
        new = np.flatnonzero(np.concatenate([[True], np.diff(known[nulls:]) != 0])) + nulls if nulls < len(known) else np.zeros(0, np.int64)
        displacement, slots = build_index(known[new])
        slots["record"] = new[slots["record"]]
        for a in (displacement.astype("<i4"), slots, known, first):
            out.write(a.tobytes())
        out.write(struct.pack(_FOOTER, _MAGIC, int(kind[2]), len(known), len(slots), nulls, len(displacement)))
        out.close()
        named = known[nulls:].tolist() or [None]
        yield {"shard": [task.partitionId()], "path": [f"{folder.rstrip('/')}/{name}"], "records": [len(known)],
               "ids": [int(first[-1])], "null_keys": [nulls], "low": [named[0]], "high": [named[-1]]}

    return stored(map_stream(rows, write, _MANIFEST), "token-manifest")


class Shard:
    """An open shard file; its index is read once, ids by keyed or sequential reads."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, n, m, self.nulls, b = struct.unpack(_FOOTER, self._at(size - _FOOTER_BYTES, _FOOTER_BYTES))
        if magic != _MAGIC:
            raise ValueError(f"{uri} is not a token shard")
        index = self._at(at := size - _FOOTER_BYTES - 8 * (n + 1) - 8 * n - 8 * m - 4 * b, size - _FOOTER_BYTES - at)
        self.displacement = np.frombuffer(index, "<i4", b)
        self.slots = np.frombuffer(index, [("fingerprint", "<u4"), ("record", "<u4")], m, 4 * b)
        self.keys = np.frombuffer(index, "<i8", n, 4 * b + 8 * m)
        self.first = np.frombuffer(index, "<u8", n + 1, 4 * b + 8 * m + 8 * n).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def ids(self, i: int) -> np.ndarray:
        """Ids of record i."""
        raw = self._at(self.width * int(self.first[i]), self.width * int(self.first[i + 1] - self.first[i]))
        return np.frombuffer(raw, f"<u{self.width}")

    def records(self, keys: list) -> Iterator[tuple[int | None, int]]:
        """(key, record) of every record of the keys (None: null keys)."""
        if None in keys:
            yield from ((None, i) for i in range(self.nulls))
        known = np.array([k for k in keys if k is not None], np.int64)
        for k, i in zip(known.tolist(), find(known, self.displacement, self.slots).tolist()):
            while 0 <= i < len(self.keys) and self.keys[i] == k:
                yield k, i
                i += 1


def lookup(keys: DataFrame, manifest: DataFrame, ids: bool = False) -> DataFrame:
    """(doc_id, shard, start, n_tokens, ids_crc32[, ids]) of every record whose doc_id
    is in ``keys`` (column doc_id; repeated keys count once, unknown ones give no row).
    ``start`` counts the ids of all documents before it. Reads go through the index."""
    shards = manifest.orderBy("shard").collect()  # one row a file
    start = np.concatenate([[0], np.cumsum([s.ids for s in shards], dtype=np.int64)]).tolist()
    named = [k for k, s in enumerate(shards) if s.low is not None]
    low, high = (np.array([getattr(shards[k], n) for k in named], np.int64) for n in ("low", "high"))
    with_null = [k for k, s in enumerate(shards) if s.null_keys]
    paths = [s.path for s in shards]
    number = [s.shard for s in shards]

    def route(cols):
        a, b = [], []
        known = np.array([k for k in cols["doc_id"] if k is not None], np.int64)
        lo, hi = np.searchsorted(high, known, "left"), np.searchsorted(low, known, "right")
        for k, i, j in zip(known.tolist(), lo.tolist(), hi.tolist()):
            for x in range(i, j):  # more than one only where rows of one key fill a shard
                a.append(k)
                b.append(named[x])
        if len(known) < len(cols["doc_id"]):
            a += [None] * len(with_null)
            b += with_null
        yield {"doc_id": a, "file": b}

    routed = map_batches(keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), route, "doc_id bigint, file int")
    routed = routed.repartition(max(1, len(shards)), "file").sortWithinPartitions("file")

    def read(cols):
        edge = np.flatnonzero(np.diff(np.array(cols["file"]))).tolist()
        for i, j in zip([0, *(e + 1 for e in edge)], [*(e + 1 for e in edge), len(cols["file"])]):
            k = cols["file"][i]
            s = Shard(paths[k])
            out = {"doc_id": [], "shard": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
            held = 0
            for key, r in s.records(cols["doc_id"][i:j]):
                raw = s.ids(r).astype("<u4").tobytes()
                for n, v in zip(out, (key, number[k], start[k] + int(s.first[r]), len(raw) // 4, zlib.crc32(raw), raw if ids else None)):
                    out[n].append(v)
                held += len(raw) if ids else 0
                if held > 8 << 20:
                    yield out
                    out, held = {n: [] for n in out}, 0
            yield out

    schema = "doc_id bigint, shard int, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    found = map_batches(routed, read, schema)
    return found if ids else found.drop("ids")
