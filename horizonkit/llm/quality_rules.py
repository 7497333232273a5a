"""Quality rules by weak supervision, in DataFrame functions only.

Each rule reads exact counts of a text and votes: good, bad, or it abstains where its
measure says little. No rule decides alone: a document is good or bad (unseen), a rule
that votes does so rightly with a probability of its own for either case, and
expectation-maximisation finds these probabilities and the share of good documents from
all votes of the corpus. A document's verdict is its posterior probability of being good.

Documents of equal votes are alike to the model, so it is fitted on one counted row per
vote pattern (at most 3 ** rules, whatever the corpus), which is all that is shuffled; one
row of sums reaches the driver per round."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

SPACE = r"[ \x09-\x0D]+"
WINDOW = 8
#: Rounds of expectation-maximisation, and what it starts from: the share of good
#: documents, and how often a rule that votes calls a good and a bad document good.
ROUNDS, SHARE, GOOD_IF_GOOD, GOOD_IF_BAD = 20, 0.8, 0.98, 0.6
#: The start counts like so many documents beside the corpus.
STRENGTH = 20.0

#: Rule: (votes bad if, votes good if) on the columns of ``measures``; else it abstains.
#: A document that is too short for a rule has no measure to vote on.
RULES = {
    "length": ("n_words < 30", "n_words >= 50"),
    "mean_word": ("n_words > 0 and (word_chars < 3 * n_words or word_chars > 12 * n_words)", "word_chars >= 4 * n_words and word_chars <= 9 * n_words and n_words > 0"),
    "symbols": ("10 * n_symbols > n_words", "n_words > 0 and 100 * n_symbols <= n_words"),
    "capitals": ("n_letters >= 40 and 10 * n_capitals > 3 * n_letters", "n_letters >= 40 and 10 * n_capitals <= n_letters"),
    "letters": ("n_words >= 20 and 10 * n_letters < 7 * word_chars", "n_words >= 20 and 10 * n_letters >= 9 * word_chars"),
    "bare_signs": ("n_words >= 20 and 10 * n_bare > n_words", "n_words >= 20 and 50 * n_bare <= n_words"),
    "sentences": ("n_words >= 40 and 100 * n_stops < n_words", "n_words >= 40 and 50 * n_stops >= n_words and 4 * n_stops <= n_words"),
    "repeated_words": ("n_words >= 20 and 100 * n_repeat_words > 20 * n_words", "n_words >= 20 and 100 * n_repeat_words <= 5 * n_words"),
    "repeated_lines": ("n_lines >= 2 and 10 * n_dup_lines > 3 * n_lines", "n_lines >= 2 and n_dup_lines = 0"),
    "distinct_words": ("n_words >= 20 and n_words < 400 and 10 * n_distinct < 3 * n_words", "n_words >= 20 and n_words < 400 and 2 * n_distinct >= n_words"),
}


def _without(spans: str) -> Column:
    """Code points of the text that are in none of the spans of a pattern."""
    return F.length(F.regexp_replace("t", spans, ""))


def _repeat_words(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Add n_repeat_words: words in windows of WINDOW words that occur twice or more in the
    text. Window hashes only tell which texts cannot have one; the others compare words."""
    at = f"if(n_words >= {WINDOW}, sequence(1, n_words - {WINDOW - 1}), cast(array() as array<int>))"
    hashed = docs.withColumn("h", F.expr(f"transform({at}, i -> xxhash64(slice(words, i, {WINDOW})))"))
    some = hashed.withColumn("repeats", F.expr("size(array_distinct(h)) < size(h)"))
    windows = some.withColumn("s", F.expr(f"if(repeats, array_sort(transform({at}, i -> struct(array_join(slice(words, i, {WINDOW}), ' ') as w, i as i))), null)"))
    twice = windows.withColumn("d", F.expr("array_sort(transform(filter(s, (x, k) -> coalesce(get(s, k - 1).w = x.w, false) or coalesce(get(s, k + 1).w = x.w, false)), x -> x.i))"))
    covered = F.expr(f"aggregate(transform(d, (x, k) -> least({WINDOW}, coalesce(get(d, k + 1) - x, {WINDOW}))), 0L, (a, x) -> a + x)")
    return twice.select(*keep, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_letters, n_capitals,
    n_bare, n_stops, n_distinct, n_repeat_words) of every row's whole text (null: empty).
    Words are ``[^\\x20\\x09-\\x0D]+``; lengths are in code points. n_bare: words without a
    letter or digit; n_stops: words with a sentence end; n_lines: lines with a word, of
    which n_dup_lines equal an earlier one."""
    t = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    w = t.select("*", F.array_remove(F.split("t", SPACE), "").alias("words"), F.expr(r"filter(split(t, '\n'), x -> x rlike '[^ \\x09-\\x0D]')").alias("lines"))
    counts = {
        "n_words": F.size("words"),
        "word_chars": _without(SPACE),
        "n_symbols": _without("[^#*$%&|<>]+"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_letters": _without(r"\P{L}+"),
        "n_capitals": _without(r"\P{Lu}+"),
        "n_bare": F.regexp_count("t", F.lit(r"(?<![^ \x09-\x0D])[^ \x09-\x0D\p{L}\p{Nd}]+(?![^ \x09-\x0D])")),
        "n_stops": F.regexp_count("t", F.lit(r"[.!?][^ \x09-\x0D]*")),
        "n_distinct": F.size(F.array_distinct("words")),
    }
    counted = w.select("doc_id", "words", *[c.alias(n) for n, c in counts.items()])
    out = _repeat_words(counted, ["doc_id", *counts])
    return out.select("doc_id", *[F.col(n).cast("bigint").alias(n) for n in [*counts, "n_repeat_words"]])


def votes(measured: DataFrame) -> DataFrame:
    """Add ``votes``: one sign per rule, in order: + good, - bad, 0 abstains."""
    signs = [F.expr(f"case when {bad} then '-' when {good} then '+' else '0' end") for bad, good in RULES.values()]
    return measured.withColumn("votes", F.concat(*signs))


def _odds(vote: list[Column], of: Column) -> Column:
    """Log odds of good from the logs in the array ``of``: the prior's, then per rule those
    of a vote for good and of a vote for bad."""
    return sum((F.when(v == "+", F.get(of, F.lit(1 + 2 * r))).when(v == "-", F.get(of, F.lit(2 + 2 * r))).otherwise(0.0)
                for r, v in enumerate(vote)), F.get(of, F.lit(0)))


def _posterior(odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))))


def _logs(share: float, good: list[float], bad: list[float]) -> list[float]:
    return [math.log(share / (1 - share)), *(x for a, b in zip(good, bad) for x in (math.log(a / b), math.log((1 - a) / (1 - b))))]


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Logs (see ``_odds``) after ``rounds`` rounds over (votes, n). A rule without votes,
    and every rule of an empty table, keeps what it starts from."""
    n, vote = len(RULES), [F.substring("votes", r + 1, 1) for r in range(len(RULES))]
    share, good, bad = SHARE, [GOOD_IF_GOOD] * n, [GOOD_IF_BAD] * n
    for _ in range(rounds):
        p = patterns.select("n", *[v.alias(f"v{r}") for r, v in enumerate(vote)], _posterior(_odds(vote, F.lit(_logs(share, good, bad)))).alias("p"))
        yes, no = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))

        def total(c: Column, name: str) -> Column:
            return F.coalesce(F.sum(c), F.lit(0.0)).alias(name)

        sums = p.agg(total(yes, "yes"), total(no, "no"), *[
            total(F.when(test(F.col(f"v{r}")), c), f"{name}{r}")
            for r in range(n) for name, c, test in (("a", yes, lambda v: v == "+"), ("b", yes, lambda v: v != "0"),
                                                    ("c", no, lambda v: v == "+"), ("d", no, lambda v: v != "0"))]).first()
        share = (sums.yes + STRENGTH * SHARE) / (sums.yes + sums.no + STRENGTH)
        good = [(sums[f"a{r}"] + STRENGTH * GOOD_IF_GOOD) / (sums[f"b{r}"] + STRENGTH) for r in range(n)]
        bad = [(sums[f"c{r}"] + STRENGTH * GOOD_IF_BAD) / (sums[f"d{r}"] + STRENGTH) for r in range(n)]
    return _logs(share, good, bad)


def judge(docs: DataFrame, reject: float = 0.5) -> DataFrame:
    """The counts of ``measures``, ``votes``, the ``posterior`` probability of being good and
    ``good`` (posterior >= ``reject``) of every row of ``docs`` (doc_id, text).

    A null text is an empty one, a null doc_id is kept, repeated rows each count and each
    give a row; other columns are not read; an empty table gives none."""
    voted = stored(votes(measures(docs)), "rules-votes")
    patterns = stored(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions("votes"), "rules-patterns")
    logs = fit(patterns)
    p = _posterior(_odds([F.substring("votes", r + 1, 1) for r in range(len(RULES))], F.lit(logs)))
    return voted.withColumn("posterior", p).withColumn("good", F.col("posterior") >= reject)
