"""Token ids of whole texts with the ``tokenizers`` library, encoding each distinct
piece of text once per worker.

Both public tokenizers cut a text into pieces by a pattern before merging bytes, and the
ids of a text are those of its pieces in order. Two levels of pieces are kept:

* spans: a word, for ``byte`` with the white space before it (its pattern always cuts
  between a visible character and white space; ``word`` drops white space). Spans of a
  batch are found, hashed (64 bits) and looked up as arrays;
* parts of a new span. Spans of common Latin characters are cut by the tokenizers' own
  patterns, others go whole through the library, as does every new part. ``word`` also
  lower-cases; the other steps of its normal form leave these characters alone.

New spans of ``byte`` with no white space but a space before them go through the library
many at a time instead, a line feed between them: its pattern cuts on both sides of that,
and no such span holds the line feed's id."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np

from .text_arrays import U64, batches, hash_spans, text_sizes, words

BATCH_CHARS = 1 << 19
#: Parts (about 200 bytes each), spans (20 bytes) and span ids kept per worker; a full
#: cache starts anew. Longer parts are not kept.
CACHE_PARTS, CACHE_SPANS, CACHE_IDS, PART_CHARS = 400_000, 2_000_000, 12_000_000, 40
JOINED = 100  # spans that go through the library as one text

# fixed values: the tokenizers' patterns, with the classes written out for _COMMON
_COMMON = re.compile("[\x00-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
_S, _N, _AT = r"\t-\r \x85\xa0", "0-9²³¹¼-¾", "'s|'t|'re|'ve|'m|'ll|'d"
_LOW, _L = "a-zªµºß-öø-\u017f", "a-zA-ZªµºÀ-ÖØ-öø-\u017f"
_WORD = re.compile(f"{_AT}|[{_LOW}]+|[{_N}]|[^{_S}{_N}{_LOW}]+")
_BYTE = re.compile(f"{_AT}| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_N}{_L}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_PLAIN = re.compile(r" ?\S+")
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")


class Encoder:
    """Ids of texts, each text's as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.word = self.tokenizer.normalizer is not None
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 and not self.word else None
        self._forget()

    def _forget(self) -> None:
        self.parts: dict[str, bytes] = {}
        self.hash, self.at, self.count, self.ids = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), 1_000)
                for e in self.tokenizer.encode_batch_fast(texts[i:i + 1_000], add_special_tokens=False)]

    def _cut(self, span: str) -> list[str]:
        if not _COMMON.fullmatch(span):
            return [span]
        return _WORD.findall(span.lower()) if self.word else _BYTE.findall(span)

    def _joined(self, spans: list[str]) -> list[bytes]:
        """Ids of spans of _PLAIN."""
        out = []
        for i in range(0, len(spans), JOINED):
            own = spans[i:i + JOINED]
            ids = np.array(self._library(["\n".join(own)])[0], "<u4")
            feeds = np.flatnonzero(ids == self.feed) * 4
            if len(feeds) != len(own) - 1:  # another pattern than the public one's
                out += [array("I", x).tobytes() for x in self._library(own)]
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(feeds + 4).tolist()], [*feeds.tolist(), len(raw)])]
        return out

    def _new(self, spans: list[str]) -> list[bytes]:
        """Ids of spans that are not kept yet (as bytes: the garbage collector does not visit them)."""
        if self.feed is None or len(spans) < JOINED:
            return self._cut_up(spans)
        plain = [_PLAIN.fullmatch(s) is not None for s in spans]
        joined = iter(self._joined([s for s, p in zip(spans, plain) if p]))
        others = iter(self._cut_up([s for s, p in zip(spans, plain) if not p]))
        return [next(joined if p else others) for p in plain]

    def _cut_up(self, spans: list[str]) -> list[bytes]:
        """Ids of spans, part by part."""
        cut = [self._cut(s) for s in spans]
        new = {p for c in cut for p in c}
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts = {}
        new = list(new - self.parts.keys())
        self.parts.update(zip(new, (array("I", x).tobytes() for x in self._library(new))))
        get = self.parts.__getitem__
        out = [get(c[0]) if len(c) == 1 else b"".join(map(get, c)) for c in cut]
        for p in new:
            if len(p) > PART_CHARS:
                del self.parts[p]
        return out

    def _keep(self, new: np.ndarray, ids: list[bytes]) -> None:
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        at = len(self.ids) + np.cumsum(n) - n
        place = np.searchsorted(self.hash, new)
        self.hash, self.at, self.count = (np.insert(a, place, b) for a, b in ((self.hash, new), (self.at, at), (self.count, n)))
        self.ids = np.concatenate([self.ids, flat])

    def _spans(self, texts: list):
        w = words(texts)
        if self.word:
            return w, w.start, w.end, w.first
        ends = w.text_start[1:] - 1  # a text's own end, and white space after its last word
        last = np.where(np.diff(w.first) > 0, np.append(w.end, 0)[w.first[1:] - 1], w.text_start[:-1])
        before = np.concatenate([[0], w.end])[:-1]
        heads = w.first[:-1][np.diff(w.first) > 0]
        before[heads] = w.text_start[:-1][np.diff(w.first) > 0]
        tail = np.flatnonzero(ends > last)
        start, end = np.insert(before, w.first[tail + 1], last[tail]), np.insert(w.end, w.first[tail + 1], ends[tail])
        return w, start, end, np.searchsorted(start, w.text_start)

    def _batch(self, texts: list) -> Iterator[bytes]:
        w, start, end, first = self._spans(texts)
        h = hash_spans(w.data, start, end)
        if len(self.hash) > CACHE_SPANS or len(self.ids) > CACHE_IDS:
            self._forget()
        own, lead, inverse = np.unique(h, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.hash, own), max(0, len(self.hash) - 1))
        new = np.flatnonzero(self.hash[place] != own) if len(self.hash) else np.arange(len(own))
        if len(new):
            raw = w.data.tobytes()
            spans = [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(start[lead[new]].tolist(), end[lead[new]].tolist())]
            self._keep(own[new], self._new(spans))
        place = np.searchsorted(self.hash, own)[inverse]
        n = self.count[place]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(self.at[place] - upto[:-1], n) + np.arange(upto[-1])]
        edge = upto[first].tolist()
        for a, b in zip(edge[:-1], edge[1:]):
            yield ids[a:b].tobytes()

    def encode(self, texts: list) -> Iterator[bytes]:
        """Id bytes of each text (null as empty)."""
        for i, j in batches(text_sizes(texts), BATCH_CHARS):
            some = [t or "" for t in texts[i:j]]
            if self.word:
                some = [t.lower() if _COMMON.fullmatch(t) else t for t in some]
                yield from self._batch(some)
                continue
            odd = {k for k, t in enumerate(some) if not t.isascii() and _ODD_SPACE.search(t)}
            usual = self._batch([t for k, t in enumerate(some) if k not in odd])
            for k, t in enumerate(some):
                yield np.array(self._library([t])[0], "<u4").tobytes() if k in odd else next(usual)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file (made once per process)."""
    if path not in _encoders:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]
