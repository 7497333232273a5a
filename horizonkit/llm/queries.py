"""Registered queries of the training-data operators: ``opN_<name>`` maps
(spark, sf_dir) to the operator's full result over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack, pieces
    return pack(pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), digest=True))


@query
def op10_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import lookup, write_shards
    docs = table(spark, sf_dir, "documents")
    manifest = write_shards(docs, vocabulary("byte_bpe_50k.json"))
    return lookup(docs, manifest).select("doc_id", "start", "n_tokens", "ids_crc32", "shard")


@query
def op9_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_dropped")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontamination import contaminations
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import score
    return score(table(spark, sf_dir, "documents"))


@query
def op5_vp_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vp_tree import nearest
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page and every document; documents have no address, their source is the host."""
    from .language_id import identify, train
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    none = F.lit(None).cast("string")
    records = pages.select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), none.alias("text"), "html", none.alias("host"), "url").union(
        docs.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text", none.alias("html"), F.col("source").alias("host"), none.alias("url")))
    found = identify(records, *train(docs))
    return found.select(F.expr("if(kind = 'document', id, null)").alias("doc_id"), F.expr("if(kind = 'page', id, null)").alias("page_id"),
                        "lang", "probability", "text_lang", "declared", "address_lang", "host")


def _spans_text(col: str):
    return F.array_join(F.transform(col, lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["length"].cast("string"))), ",")


@query
def op2_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import neighbour_pairs, preference_format
    out = preference_format(*neighbour_pairs(table(spark, sf_dir, "conversations")))
    return out.select("pair_id", "n_prompt_turns", "prompt", "chosen", "rejected",
                      _spans_text("chosen_spans").alias("chosen_spans"), _spans_text("rejected_spans").alias("rejected_spans"))


SQL["op2_preference_format"] = """
WITH c AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS even, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
half AS (SELECT pair_id, (max(turn) + 1) // 2 AS half FROM c WHERE even GROUP BY pair_id),
sides AS (
  SELECT pair_id, 'c' AS side, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c WHERE even
  UNION ALL SELECT pair_id, 'r', turn, coalesce(role, ''), coalesce(text, '') FROM c JOIN half USING (pair_id)
  WHERE (even AND turn < half) OR (NOT even AND turn >= half)),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS LAST, role, text) AS pos FROM sides),
pairs AS (SELECT pair_id, count(*) FILTER (side = 'c') AS nc FROM placed GROUP BY pair_id HAVING count(DISTINCT side) = 2),
first_diff AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.pos, b.pos)) AS pos
  FROM (SELECT * FROM placed WHERE side = 'c') a FULL JOIN (SELECT * FROM placed WHERE side = 'r') b
    ON a.pair_id = b.pair_id AND a.pos = b.pos
  WHERE a.pos IS NULL OR b.pos IS NULL OR a.role <> b.role OR a.text <> b.text GROUP BY 1),
prefix AS (SELECT pair_id, CAST(coalesce(f.pos - 1, nc) AS INTEGER) AS n FROM pairs LEFT JOIN first_diff f USING (pair_id)),
turns AS (
  SELECT p.pair_id, side, pos, role, text, n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown
  FROM placed p JOIN prefix USING (pair_id)),
at_turn AS (
  SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY pair_id, side ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + length(role) + 5 AS s FROM turns WHERE pos > n),
done AS (
  SELECT pair_id, side, string_agg(shown, '' ORDER BY pos) AS body,
         string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR) || '+' || CAST(length(text) AS VARCHAR), ',' ORDER BY pos) FILTER (role = 'assistant') AS spans
  FROM at_turn GROUP BY pair_id, side)
SELECT x.pair_id, x.n AS n_prompt_turns,
       coalesce((SELECT string_agg(shown, '' ORDER BY pos) FROM turns t WHERE t.pair_id = x.pair_id AND t.side = 'c' AND t.pos <= t.n), '') AS prompt,
       coalesce(c.body, '') AS chosen, coalesce(r.body, '') AS rejected, coalesce(c.spans, '') AS chosen_spans, coalesce(r.spans, '') AS rejected_spans
FROM prefix x LEFT JOIN done c ON c.pair_id = x.pair_id AND c.side = 'c' LEFT JOIN done r ON r.pair_id = x.pair_id AND r.side = 'r'
"""


def planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, chosen by hash, the words from some place on
    repeat with some period; the others as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("chosen"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("w", F.when(F.col("chosen"), F.array_remove(F.split("text", r"[ \x09-\x0D]+"), "")))
    rows = rows.withColumn("n", F.size("w").cast("bigint")).withColumn("chosen", F.col("chosen") & (F.coalesce("n", F.lit(0)) > 0))
    rows = rows.withColumn("a", F.when(F.col("chosen"), F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", F.when(F.col("chosen"), 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    words = F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), again), F.lit(1), F.col("n").cast("int"))
    return rows.select("doc_id", F.when(F.col("chosen"), F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic_runs import periodic_runs
    found = periodic_runs(planted_runs(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    out = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"),
                       F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.select("doc_id", "n_runs", (-F.col("b.start")).alias("start"), F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
                      F.floor(1000 * F.col("b.length") / -F.col("b.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import judge
    found = judge(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                        (~failed & F.col("good")).alias("kept"), "votes", (F.floor(F.col("posterior") * 1e6 + 0.618) / 1e6).alias("posterior"))


def _rules_sql() -> str:
    """The same counts and votes, and each round of expectation-maximisation as a step."""
    from . import quality_rules as q
    rules = range(len(q.RULES))
    signs = " || ".join(f"CASE WHEN {bad} THEN '-' WHEN {good} THEN '+' ELSE '0' END" for bad, good in q.RULES.values())
    odds = "ln(share / (1 - share)) + " + " + ".join(
        f"CASE substr(votes, {r + 1}, 1) WHEN '+' THEN ln(g{r} / b{r}) WHEN '-' THEN ln((1 - g{r}) / (1 - b{r})) ELSE 0 END" for r in rules)
    posterior = f"1 / (1 + exp(-greatest(-500.0, least(500.0, {odds}))))"
    steps = [f"e0 AS (SELECT CAST({q.SHARE} AS DOUBLE) AS share, " + ", ".join(f"CAST({q.GOOD_IF_GOOD} AS DOUBLE) AS g{r}, CAST({q.GOOD_IF_BAD} AS DOUBLE) AS b{r}" for r in rules) + ")"]

    def rate(weight: str, r: int, start: float, name: str) -> str:
        vote = f"substr(votes, {r + 1}, 1)"
        return (f"(coalesce(sum({weight}) FILTER ({vote} = '+'), 0) + {q.STRENGTH * start}::DOUBLE)"
                f" / (coalesce(sum({weight}) FILTER ({vote} <> '0'), 0) + {q.STRENGTH}::DOUBLE) AS {name}{r}")

    for k in range(q.ROUNDS):
        rates = ", ".join(rate("n * p", r, q.GOOD_IF_GOOD, "g") + ", " + rate("n * (1 - p)", r, q.GOOD_IF_BAD, "b") for r in rules)
        steps.append(f"e{k + 1} AS MATERIALIZED (SELECT (coalesce(sum(n * p), 0) + {q.STRENGTH * q.SHARE}::DOUBLE) / (coalesce(sum(n), 0) + {q.STRENGTH}::DOUBLE) AS share, "
                     f"{rates} FROM (SELECT votes, n, {posterior} AS p FROM patterns, e{k}))")
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, [x for x in regexp_split_to_array(t, '{q.SPACE}') if x <> ''] AS words,
             [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^ \x09-\x0D]')] AS lines FROM t),
windows AS (SELECT rid, i, array_to_string(words[i:i + {q.WINDOW - 1}], ' ') AS s
            FROM (SELECT rid, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS i FROM w WHERE len(words) >= {q.WINDOW})),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM windows) WHERE c > 1),
again AS (SELECT rid, sum(least({q.WINDOW}, coalesce(next - i, {q.WINDOW}))) AS n
          FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM twice) GROUP BY rid),
m AS (SELECT rid, doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{q.SPACE}', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        length(regexp_replace(t, '\P{{L}}+', '', 'g')) AS n_letters, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_capitals,
        len([x for x in words if NOT regexp_matches(x, '[\p{{L}}\p{{Nd}}]')]) AS n_bare,
        len([x for x in words if regexp_matches(x, '[.!?]')]) AS n_stops, len(list_distinct(words)) AS n_distinct,
        CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN again USING (rid)),
v AS MATERIALIZED (SELECT *, {signs} AS votes FROM m),
patterns AS MATERIALIZED (SELECT votes, count(*) AS n FROM v GROUP BY votes),
{", ".join(steps)},
judged AS (SELECT votes, {posterior} AS posterior FROM patterns, e{q.ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND posterior >= 0.5 AS kept, votes, floor(posterior * 1e6 + 0.618) / 1e6 AS posterior
FROM v JOIN judged USING (votes)
"""


SQL["op12_quality_rules"] = _rules_sql()


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import hard_negatives
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", shifted), F.col("vec_id") % 100 == 0)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
