"""Language identification by Bayesian fusion of text, markup, address and host.

* text: naive Bayes over hashed byte trigrams, learnt by one grouped count over all
  labelled documents (a trigram is worth a third, as three overlap each byte);
* markup and address: a declared language (<html lang>) and a language code in the
  address (country suffix or first path part) are right with a fixed reliability;
* host priors: the posteriors by text and markup are added up by host and by address
  suffix; a host's prior is its shares shrunken toward its suffix's, those toward the
  overall ones. A record's own share is taken out of its prior."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import BROADCAST_ROWS, map_batches, map_stream, stored
from .text_arrays import _LOWER, U64, batches, join_texts, mix, text_sizes

BINS = 1 << 15
#: More languages than this are refused (the model is languages x BINS numbers).
MAX_LANGUAGES = 256
DECLARED, ADDRESS, SITE_WEIGHT = 0.9, 0.8, 5.0
_FLUSH = 32 << 20
_DROP = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", re.I)


def visible(html: str | None) -> str:
    """Text of a page without markup, scripts and styles."""
    return _DROP.sub(" ", html or "")


def declared(html: str | None) -> str | None:
    """Primary language tag of <html lang>, lower-cased."""
    html, at = html or "", 0
    while tag := _HTML.search(html, at):
        end = html.find(">", tag.start())
        at = end if end >= 0 else len(html)
        if m := _LANG.match(html, tag.start(), at):
            return m.group(1).lower()
    return None


def address(url: str | None) -> tuple[str, str, str | None]:
    """(host, suffix, language code or None) of an address; empty parts if there are none."""
    try:
        u = urlsplit(url or "")
        host = (u.hostname or "").removeprefix("www.")
    except ValueError:
        return "", "", None
    suffix = host.rpartition(".")[2]
    first = u.path.strip("/").partition("/")[0].lower()
    return host, suffix, first if len(first) == 2 and first.isalpha() else (suffix if len(suffix) == 2 else None)


def _trigrams(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(bin of each byte trigram of the lower-cased texts, first trigram of each text)."""
    data, start = join_texts(texts)
    b = _LOWER[data].astype(U64)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros_like(start)
    code = mix(b[:-2] << U64(16) | b[1:-1] << U64(8) | b[2:])
    n = np.maximum(np.diff(start) - 2, 0)  # those that end within their text
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) + np.repeat(start[:-1] - first[:-1], n)
    return (code[at] % U64(BINS)).astype(np.int64), first


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log P(bin | language) / 3) from rows (text, lang)."""

    def fn(stream):
        counts: dict[str, np.ndarray] = {}
        for cols in stream:
            for i, j in batches(text_sizes(cols["text"])):
                t, start = _trigrams(cols["text"][i:j])
                lang = cols["lang"][i:j]
                code = {x: k for k, x in enumerate(dict.fromkeys(lang))}
                of = np.repeat([code[x] for x in lang], np.diff(start))
                n = np.bincount(of * BINS + t, minlength=len(code) * BINS).reshape(-1, BINS)
                for x, k in code.items():
                    counts[x] = counts.get(x, 0) + n[k]
        for x, n in counts.items():
            some = np.flatnonzero(n)
            yield {"lang": [x] * len(some), "bin": some, "n": n[some]}

    rows = labelled.where("lang is not null").select("text", "lang")
    counts = stored(map_stream(rows, fn, "lang string, bin int, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")), "language-counts")
    found = sorted(r.lang for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table, at = np.full((len(found), BINS), 0.5), {x: k for k, x in enumerate(found)}
    for r in counts.toLocalIterator():  # at most MAX_LANGUAGES x BINS rows
        table[at[r.lang], r.bin] += r.n
    return found, np.log(table / table.sum(axis=1, keepdims=True)) / 3 if found else table


def _normal(logs: np.ndarray) -> np.ndarray:
    e = np.exp(logs - logs.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _told(codes: list, languages: list[str], right: float) -> np.ndarray:
    """Log likelihood of each record's declared code by language (0 if none or unknown)."""
    at, n = {x: k for k, x in enumerate(languages)}, len(languages)
    out = np.zeros((len(codes), n))
    for i, c in enumerate(codes):
        if c in at and n > 1:
            out[i] = np.log((1 - right) / (n - 1))
            out[i, at[c]] = np.log(right)
    return out


def identify(records: DataFrame, languages: list[str], table: np.ndarray) -> DataFrame:
    """``records`` (kind, id, text, html, host, url; a row has text and host or html and
    url) to (kind, id, lang, probability, text_lang, declared, address_lang, host).

    Without text the other evidence decides; without any, the overall shares do. Null
    kinds and ids stay; repeated rows are separate records. A null host and url is the
    host ''. Ties go to the language first in the alphabet. Without a trained language,
    or without records, there are no rows."""
    if not languages:
        return records.sparkSession.createDataFrame([], _OUT)
    sent, n = records.sparkSession.sparkContext.broadcast(table), len(languages)

    def score(cols):
        texts = [t if t is not None or h is None else visible(h) for t, h in zip(cols["text"], cols["html"])]
        for i, j in batches(text_sizes(texts)):
            t, start = _trigrams(texts[i:j])
            logs = np.zeros((j - i, n))
            some = np.flatnonzero(np.diff(start))
            if len(some):
                for k in range(n):
                    logs[some, k] = np.add.reduceat(sent.value[k][t], start[some])
            said = [declared(h) for h in cols["html"][i:j]]
            where = [address(u) if u is not None else (h or "", (h or "").rpartition(".")[2], None) for h, u in zip(cols["host"][i:j], cols["url"][i:j])]
            first = _normal(logs + _told(said, languages, DECLARED))
            logs += _told(said, languages, DECLARED) + _told([w[2] for w in where], languages, ADDRESS)
            yield {"kind": cols["kind"][i:j], "id": cols["id"][i:j], "declared": said, "host": [w[0] for w in where],
                   "suffix": [w[1] for w in where], "address_lang": [w[2] for w in where],
                   "text_lang": [languages[k] if b > a else None for k, a, b in zip(logs.argmax(axis=1), start[:-1], start[1:])],
                   "first": list(first), "logs": list(logs)}

    scored = stored(map_batches(records.select("kind", "id", "text", "html", "host", "url"), score,
                                "kind string, id bigint, declared string, host string, suffix string, address_lang string, "
                                "text_lang string, first array<double>, logs array<double>"), "language-scored")
    each = [F.sum(F.col("first")[k]).alias(f"s{k}") for k in range(n)]
    hosts = stored(scored.groupBy("suffix", "host").agg(*each), "language-hosts")
    of_suffix = hosts.groupBy("suffix").agg(F.array(*[F.sum(f"s{k}") for k in range(n)]).alias("by_suffix"))
    total = hosts.agg(*[F.sum(f"s{k}") for k in range(n)]).first()
    overall = (np.array([x or 0.0 for x in total]) + 1) / (sum(x or 0.0 for x in total) + n)
    hosts = hosts.select("suffix", "host", F.array(*[f"s{k}" for k in range(n)]).alias("by_host")).join(of_suffix, "suffix")
    hosts = F.broadcast(hosts) if hosts.count() <= BROADCAST_ROWS // (n + 1) else hosts

    def fuse(cols):
        own, logs = (np.array(cols[x], float).reshape(-1, n) for x in ("first", "logs"))
        by_host, by_suffix = (np.maximum(np.array(cols[x], float).reshape(-1, n) - own, 0) for x in ("by_host", "by_suffix"))
        suffix = (by_suffix + SITE_WEIGHT * overall) / (by_suffix.sum(axis=1, keepdims=True) + SITE_WEIGHT)
        host = (by_host + SITE_WEIGHT * suffix) / (by_host.sum(axis=1, keepdims=True) + SITE_WEIGHT)
        p = _normal(logs + np.log(host))
        yield {**{x: cols[x] for x in ("kind", "id", "text_lang", "declared", "address_lang", "host")},
               "lang": [languages[k] for k in p.argmax(axis=1)], "probability": p.max(axis=1)}

    return map_batches(scored.join(hosts, ["suffix", "host"]), fuse, _OUT)


_OUT = "kind string, id bigint, lang string, probability double, text_lang string, declared string, address_lang string, host string"
