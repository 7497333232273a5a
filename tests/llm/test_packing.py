"""Packing: exact places, few sequences, odd inputs; the fast encoder against the library."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from horizonkit.llm.packing import pack, pieces, plan, sequences
from horizonkit.llm.tokens import Encoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name):
    r = random.Random(4)
    common = list("ab1A'.,!é ñßÀœ²—") + [" "] * 6 + ["\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "'s", " 'll", " <|endoftext|>"]
    odd = common + [" ", "　", "​", "́", "漢", "字", "\U0001f600", "İ", "ſ", "Σ", "ΑΣ "]
    texts = ["".join(r.choice(a) for _ in range(r.randrange(40))) for a in (common, odd) for _ in range(4000)]
    texts += ["", None, "x" * 5000, "ab " * 30_000, " \n\n  \n"]
    for n in (1024, 2048, 4096):  # Thue-Morse words: equal hashes in any polynomial modulo 2**64
        t = "".join("ab"[k.bit_count() % 2] for k in range(n))
        texts += [t, t.translate(str.maketrans("ab", "ba")), f"x {t} y"]
    e = Encoder(public_tokenizers.path(name))
    want = e.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    got = [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)]
    assert got == [w.ids for w in want]


def brute_bins(lengths, cap):
    """Best-fit decreasing, one piece at a time."""
    rooms = []
    for x in sorted(lengths, reverse=True):
        fits = [(room - x, i) for i, room in enumerate(rooms) if room >= x]
        if fits:
            rooms[min(fits)[1]] -= x
        else:
            rooms.append(cap - x)
    return len(rooms)


@pytest.mark.parametrize("seed,cap,n,top", [(1, 50, 400, 50), (2, 64, 900, 30), (3, 100, 40, 100), (4, 30, 5, 30), (5, 16, 300, 3)])
def test_plan_uses_each_piece_once_and_about_as_few_bins_as_best_fit(seed, cap, n, top):
    r = random.Random(seed)
    lengths = [r.randint(1, top) for _ in range(n)]
    counts = {x: lengths.count(x) for x in set(lengths)}
    patterns, used = plan(counts, cap), {}
    for pattern, times in patterns:
        assert 0 < sum(x * k for x, k in pattern) <= cap
        for x, k in pattern:
            used[x] = used.get(x, 0) + k * times
    assert used == counts
    assert sum(t for _, t in patterns) <= brute_bins(lengths, cap) + 1
    assert sum(t for _, t in patterns) >= -(-sum(lengths) // cap)


def test_exact_complements():
    assert plan({7: 1, 3: 1}, 10) == [(((7, 1), (3, 1)), 1)]
    assert plan({6: 2, 3: 2, 1: 2}, 10) == [(((6, 1), (3, 1), (1, 1)), 2)]
    assert plan({4: 1, 3: 1, 2: 1, 1: 1}, 10) == [(((4, 1), (3, 1), (2, 1), (1, 1)), 1)]
    assert plan({5: 4}, 10) == [(((5, 2),), 2)]
    assert plan({}, 10) == []


def test_places_are_gapless_and_ids_round_trip(spark, docs_of):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice(["tree", "Stone", "über", "x9"]) for _ in range(r.choice([0, 1, 5, 60, 300])))) for i in range(120)]
    rows += [(500, None), (501, "word " * 700), (None, "no id"), (7, rows[7][1]), (7, "another text of the same id")]
    p = pieces(docs_of(rows).repartition(3), VOCABULARY, capacity=128)
    out = [r.asDict() for r in pack(p, capacity=128).collect()]
    tokens = Encoder(VOCABULARY)
    whole = {}
    for i, t in rows:
        whole.setdefault(i, []).append(next(tokens.encode([t])) + np.array([1], "<u4").tobytes())
    by_doc, by_sequence = {}, {}
    for o in out:
        assert len(o["ids"]) == 4 * o["length"] and o["start"] == 128 * o["piece"]
        by_doc.setdefault(o["doc_id"], []).append(o)
        by_sequence.setdefault(o["sequence_id"], []).append(o)
    for i, texts in whole.items():
        if len(texts) == 1:
            assert b"".join(o["ids"] for o in sorted(by_doc[i], key=lambda o: o["piece"])) == texts[0]
        else:
            assert sorted(o["ids"] for o in by_doc[i]) == sorted(texts)
    for s in by_sequence.values():
        at = 0
        for o in sorted(s, key=lambda o: o["offset"]):
            assert o["offset"] == at
            at += o["length"]
        assert at <= 128
    total = sum(o["length"] for o in out)
    assert len(by_sequence) <= brute_bins([o["length"] for o in out], 128) + 1
    digest = pieces(docs_of(rows), VOCABULARY, capacity=128, digest=True).collect()
    assert sorted((d.length, d.ids_crc32) for d in digest) == sorted((o["length"], zlib.crc32(o["ids"])) for o in out)
    joined = {r.sequence_id: bytes(r.ids) for r in sequences(pack(p, capacity=128)).collect()}
    assert sum(map(len, joined.values())) == 4 * total


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert pack(pieces(docs_of([]), VOCABULARY)).collect() == []
    items = spark.createDataFrame([(1, 0, 3, "a"), (2, 0, 5, None)], "doc_id bigint, piece int, length bigint, sequence_id string")
    out = pack(items, capacity=8).collect()
    assert {(r.doc_id, r.sequence_id) for r in out} == {(1, 0), (2, 0)}
    with pytest.raises(ValueError):
        pack(items, capacity=4)
