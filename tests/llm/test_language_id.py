"""Language ID: held-out accuracy, fusion against its formula, parsing, odd inputs."""
import numpy as np
import pytest

from horizonkit.llm import language_id as L

SF = "/root/testdata/sf0.01"
SCHEMA = "kind string, id bigint, text string, html string, host string, url string, lang string, first string"


def test_parsing():
    assert L.visible('<p>a<script>var x="</p>";</script><!-- <b> -->b</p>').split() == ["a", "b"]
    assert L.declared('<!DOCTYPE html><html class=x lang="fr-CA">') == "fr" and L.declared("<html>") is None and L.declared(None) is None
    assert L.address("https://www.Blog.example.de/x/1") == ("blog.example.de", "de", "de")
    assert L.address("http://a.example.com/fr/25") == ("a.example.com", "com", "fr")
    assert L.address("http://a.example.com/25") == ("a.example.com", "com", None)
    assert L.address(None) == L.address("http://[bad") == ("", "", None)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.train(docs.where("doc_id % 2 = 0"))
    records = docs.where("doc_id % 2 = 1").selectExpr("'document' as kind", "doc_id as id", "text", "cast(null as string) as html",
                                                      "source as host", "cast(null as string) as url")
    got = L.identify(records, *model).join(docs.selectExpr("doc_id as id", "lang as truth"), "id").collect()
    assert sum(r.lang == r.truth for r in got) >= 0.97 * len(got) and len(got) == records.count()


def by_formula(records, languages, table):
    n = len(languages)
    said, host, first, logs = [], [], [], []
    for _, _, text, html, h, url in records:
        t = text if text is not None else L.visible(html)
        b = (t or "").lower().encode() + b"\n"
        own = np.zeros(n)
        for k in range(len(b) - 2):
            own += table[:, L._trigrams([b[k:k + 3].decode("latin-1")])[0][0]] if max(b[k:k + 3]) < 128 else 0
        where = L.address(url) if url is not None else (h or "", (h or "").rpartition(".")[2], None)
        evidence = np.zeros((2, n))
        for e, code, right in ((0, L.declared(html), L.DECLARED), (1, where[2], L.ADDRESS)):
            if code in languages:
                evidence[e] = [np.log(right if x == code else (1 - right) / (n - 1)) for x in languages]
        p = np.exp(own + evidence[0] - (own + evidence[0]).max())
        first.append(p / p.sum())
        logs.append(own + evidence.sum(axis=0))
        host.append(where[:2])
    overall = (sum(first) + 1) / (len(first) + n)
    out = []
    for i, (h, s) in enumerate(host):
        by = [sum((first[j] for j in range(len(first)) if j != i and same(j)), np.zeros(n))
              for same in (lambda j: host[j][1] == s, lambda j: host[j] == (h, s))]
        suffix = (by[0] + L.SITE_WEIGHT * overall) / (by[0].sum() + L.SITE_WEIGHT)
        prior = (by[1] + L.SITE_WEIGHT * suffix) / (by[1].sum() + L.SITE_WEIGHT)
        p = np.exp(logs[i] - logs[i].max()) * prior
        out.append(p.max() / p.sum())
    return out


def test_fusion_equals_formula_and_odd_rows(spark):
    labelled = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr"), (None, "fr"), ("x", None)], "text string, lang string")
    languages, table = L.train(labelled)
    assert languages == ["de", "en", "fr"]
    records = [("p", 1, None, '<html lang="de"><p>the</p>', None, "http://x.de/en/1"), ("p", 2, None, "<p>der hund</p>", None, "http://x.de/1"),
               ("p", 3, None, None, None, "http://x.de/2"), ("p", 3, None, None, None, "http://x.de/2"), ("d", None, "the dog", None, "src", None),
               (None, 5, "", None, None, None), ("d", 6, "le chat " * 20_000, None, "src", None), ("p", 7, None, '<html lang="xx">', None, "http://y.fr")]
    frame = spark.createDataFrame([(*r, "z", "z") for r in records], SCHEMA)
    got = L.identify(frame, languages, table).collect()
    assert len(got) == len(records)
    want = by_formula([r for r in records if r[1] != 6], languages, table)
    small = spark.createDataFrame([(*r, "z", "z") for r in records if r[1] != 6], SCHEMA)
    assert sorted(r.probability for r in L.identify(small, languages, table).collect()) == pytest.approx(sorted(want))
    by_id = {r.id: r for r in got}
    assert by_id[6].lang == "fr" and by_id[2].lang == "de" and by_id[3].text_lang is None and by_id[7].declared == "xx"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string, lang string")
    records = spark.createDataFrame([], SCHEMA)
    assert L.train(none)[0] == []
    assert L.identify(records, *L.train(none)).collect() == []
    assert L.identify(records, *L.train(spark.createDataFrame([("a b c", "en")], "text string, lang string"))).collect() == []


def test_declared_language_wherever_it_stands():
    for before in ("<!-- " + "x" * 30_000 + " -->", " " * 100_000, "<script>" + "a();" * 20_000 + "</script>"):
        assert L.declared(before + '<html class="a" lang="pt-BR"><body>') == "pt"
    assert L.declared("<html>" + "<html " * 3 + "lang=it>") == "it"
    assert L.declared("<html " * 50_000 + "><html>" * 50_000) is None  # linear
