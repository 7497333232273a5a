"""Token shards: minimal perfect hash, exact round trip of the files, odd inputs."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from horizonkit.llm.token_files import Shard, build_index, find, lookup, write_shards
from horizonkit.llm.tokens import PART_CHARS, Encoder

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 5, 1000, 20_000])
def test_index_is_minimal_and_perfect(n):
    keys = np.array(random.Random(n).sample(range(-10**12, 10**12), n), np.int64)
    displacement, slots = build_index(keys)
    assert len(slots) == n and sorted(slots["record"].tolist()) == list(range(n))
    assert find(keys, displacement, slots).tolist() == list(range(n))
    foreign = find(np.arange(10**13, 10**13 + 2000), displacement, slots)
    assert (foreign >= 0).mean() < 0.01


def ids_of(text):
    e = Encoder(VOCABULARY)
    return next(e.encode([text])) + np.array([2], "<u4").tobytes()


def test_round_trip(spark, docs_of):
    r = random.Random(3)
    rows = [(i * 7 - 300, " ".join(r.choice(["alpha", "Béta", "漢字", "\n", "x"]) for _ in range(r.randrange(80)))) for i in range(300)]
    rows += [(10**15, None), (10**15 + 1, ""), (10**15 + 2, "long " * 20_000), (None, "no id"), (None, None), (5_000, "b"), (5_000, "a"), (5_000, "a")]
    docs = docs_of(rows)
    manifest = write_shards(docs.repartition(4), VOCABULARY, shards=6)
    got = lookup(docs, manifest, ids=True).collect()
    assert len(got) == len(rows)
    assert sorted((g.doc_id or -10**16, bytes(g.ids)) for g in got) == sorted((i or -10**16, ids_of(t)) for i, t in rows)
    at = 0
    for g in sorted(got, key=lambda g: g.start):
        assert g.start == at and g.n_tokens == len(g.ids) // 4 and g.ids_crc32 == zlib.crc32(g.ids)
        at += g.n_tokens
    order = [g.doc_id for g in sorted(got, key=lambda g: g.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert lookup(spark.createDataFrame([(4,), (11**13,)], "doc_id bigint"), manifest).collect() == []
    some = Shard(manifest.first()["path"])
    assert some.ids(0).dtype == np.uint16 and some.ids(0)[-1] == 2


def test_empty_table(docs_of):
    docs = docs_of([])
    manifest = write_shards(docs, VOCABULARY)
    assert manifest.collect() == [] and lookup(docs, manifest).collect() == []


def test_new_words_go_through_the_library_many_at_a_time():
    """One call's text holds many new words (each was a text of its own before), with the library's ids."""
    r = random.Random(6)
    e = Encoder(VOCABULARY)
    words = ["".join(r.choice("abcdeé漢1-'!<") for _ in range(r.randrange(1, 12))) for _ in range(3000)]
    texts = [" ".join(words[i:i + 30]) + r.choice(["", "\n", "\n\nx", "  y", "\t"]) for i in range(0, 3000, 30)]
    want = [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    given, library = [], e._library
    e._library = lambda some: given.extend(some) or library(some)
    assert list(e.encode(texts)) == want
    assert len(given) < 500
    e.feed = 0  # an id that the joined texts do not hold: every span by itself
    e._forget()
    assert list(e.encode(texts)) == want


def test_kept_parts_are_bytes_and_long_ones_go():
    """Kept ids are no lists of Python numbers; a long part is not kept, and costs no copy of those that are."""
    e = Encoder(VOCABULARY)
    texts = ["short words, some-thing " + "x" * (PART_CHARS + 9) + "!", "words " + "y" * 300, ""]
    kept = e.parts
    for _ in range(2):
        assert list(e.encode(texts)) == [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.parts is kept and kept
    assert all(isinstance(v, bytes) and len(p) <= PART_CHARS for p, v in kept.items())
