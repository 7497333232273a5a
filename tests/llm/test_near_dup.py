"""Near-duplicates against brute force over all pairs, and the odd inputs."""
import random
import re

import numpy as np
import pytest

from horizonkit.llm.components import connected_components, link_lists
from horizonkit.llm import near_dup, tables
from horizonkit.llm.near_dup import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows, percent=85):
    sets, parent = [(i, shingles(t)) for i, t in rows], {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def corpus(seed=5):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    shared = " ".join(r.choice(vocab) for _ in range(30))
    rows = []
    for k in range(60):
        base = [r.choice(vocab) for _ in range(r.choice([3, 8, 40, 120, 300]))]
        if k % 3 == 0:
            base += shared.split()
        rows.append(" ".join(base))
        for _ in range(r.choice([0, 0, 1, 3])):
            near = list(base)
            for _ in range(r.choice([0, 1, 2, 5])):
                near[r.randrange(len(near))] = r.choice(vocab)
            rows.append("  \n".join(near).upper() if r.random() < .3 else " ".join(near))
    dense = [r.choice(vocab) for _ in range(200)]
    for _ in range(70):  # one dense group, longer than a short list
        near = list(dense)
        for _ in range(r.choice([1, 2, 3, 4])):
            near[r.randrange(len(near))] = r.choice(vocab)
        rows.append(" ".join(near))
    r.shuffle(rows)
    return [(3 * i + 1, t) for i, t in enumerate(rows)]


def test_equals_brute_force(docs_of):
    rows = corpus()
    got = {r.doc_id: r for r in near_duplicates(docs_of(rows).repartition(5)).collect()}
    want = brute(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in rows)
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_odd_rows(docs_of):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  TWO"), (6, long), (7, long + " end"),
            (None, "one two"), (8, "a b c d e f g"), (9, "other words in this text here"),
            (9, "a b c d e f g"), (6, long)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs_of(rows)).collect())
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
                          (6, 29_996, 6, True), (6, 29_996, 6, True), (7, 29_997, 6, False), (-1, 1, None, True),
                          (8, 3, 8, True), (9, 2, 8, False), (9, 3, 8, False)])


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_edges(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(400, 460)] + [(500, i) for i in range(501, 560)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    got = {row.id: row.component for row in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_structured_words_stay_apart(docs_of):
    """Texts of one Thue-Morse word and its complement share no shingle."""
    t = "".join("ab"[k.bit_count() % 2] for k in range(2048))
    rows = [(1, t), (2, t.translate(str.maketrans("ab", "ba"))), (3, t)]
    assert {r.doc_id: r.component_id for r in near_duplicates(docs_of(rows)).collect()} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("percent", [80, 85])
def test_copies_just_too_far_apart_are_not_paired(docs_of, monkeypatch, percent):
    """A large group whose texts have most shingles in common without being linked: few
    pairs reach the check (all were compared before), and every link is found."""
    r = random.Random(8)
    base = [f"b{i}" for i in range(170)]
    rows = []
    for i in range(160):
        w = list(base)
        for at in r.sample(range(0, 170, 6), 4 if i % 8 else 1):
            w[at] = f"r{r.randrange(10**9)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:60] + [f"x{r.randrange(10**9)}" for _ in range(40)])) for i in range(60)]
    rows += [(2000 + i, rows[160 + i][1] + " more") for i in range(0, 60, 9)]
    seen = []
    estimate = near_dup.estimated
    monkeypatch.setattr(near_dup, "estimated", lambda p, *a: (seen.append(p.count()), estimate(p, *a))[1])
    got = {x.doc_id: x.component_id for x in near_duplicates(docs_of(rows).repartition(3), percent).collect()}
    assert got == brute(rows, percent)
    assert len(seen) == 2 and seen[1] < 3000


@pytest.mark.parametrize("percent", [80, 85])
def test_marks_never_part_linked_sets(spark, percent):
    r = random.Random(4)
    rows = []
    for _ in range(400):
        own = np.unique(np.array([r.getrandbits(64) for _ in range(r.choice([1, 7, 60, 400, 3000]))], np.uint64))
        cut = own[int(len(own) * r.random() * 0.2):]
        more = np.unique(np.append(cut, np.array([r.getrandbits(64) for _ in range(int(len(own) * r.random() * 0.15))], np.uint64)))
        both = len(np.intersect1d(own, more))
        if 100 * both >= percent * (len(own) + len(more) - both):
            rows.append(tuple((len(s), *near_dup.marks(s).tolist()) for s in (own, more)))
    kind = "struct<n_shingles int, " + ", ".join(f"m{k} bigint" for k in range(near_dup.MARKS)) + ">"
    pairs = spark.createDataFrame(rows, f"x {kind}, y {kind}")
    assert len(rows) > 100 and pairs.where(~near_dup.may_be_linked(percent)("x", "y")).count() == 0


def test_far_pairs_of_long_lists_do_not_leave_the_join(docs_of, monkeypatch):
    """Texts with a long passage in common and too different for a link: few pairs reach the
    estimate (each pivot's pairs with all members of its lists did before)."""
    r = random.Random(3)
    shared = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(shared + [f"w{r.randrange(10**6)}" for _ in range(60)])) for i in range(200)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(20)]
    given, estimated = [], near_dup.estimated
    monkeypatch.setattr(near_dup, "estimated", lambda pairs, *x: given.append(pairs.count()) or estimated(pairs, *x))
    got = {x.doc_id: x.component_id for x in near_duplicates(docs_of(rows)).collect()}
    assert got == brute(rows)
    assert sum(given) <= 60


def test_tally_hands_on_few_rows(spark, monkeypatch):
    """Frequencies by groups of hashes: each task hands on TALLY_ROWS rows at most (it handed
    on one for each group in a batch before), and nothing is lost."""
    made, plain = [], tables.map_stream
    monkeypatch.setattr(tables, "map_stream", lambda df, fn, schema: made.append(plain(df, fn, schema)) or made[-1])
    frame = spark.range(0, 30_000, 1, 3).selectExpr("id * 7919 % 2003 AS h")
    groups = 64 * 128
    got = tables.tally(frame, lambda cols: (np.array(cols["h"][i::2], np.uint64) for i in range(2)), groups)
    assert got.tolist() == np.bincount([i * 7919 % 2003 for i in range(30_000)], minlength=groups).tolist()
    assert made[0].count() <= 3 * tables.TALLY_ROWS
    assert not tables.tally(frame.where("h < 0"), lambda cols: iter([np.array(cols["h"], np.uint64)]), groups).any()


def test_known_links_are_not_compared_again(spark):
    """Members of a long list that links found before join are no open pairs."""
    members = spark.createDataFrame([(1, i) for i in range(60)], "key bigint, id bigint")
    known = spark.createDataFrame([(i, i + 1) for i in range(59) if i != 29], "a bigint, b bigint")
    given = []

    def verify(pairs):
        given.append({tuple(r) for r in pairs.collect()})
        return pairs.where("a = 3 and b = 40")

    links = link_lists(members, verify, "test", known=known)
    assert {r.component for r in connected_components(links).collect()} == {0}
    assert len(given) == 2 and given[1] == {(a, b) for a in range(30) for b in range(30, 60)}
