"""The package's registered queries and their SQL; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeeper.llm import (
    decontam,
    grid_join,
    language_id,
    line_dedup,
    lm_scoring,
    near_dups,
    phrases,
    quality_rules,
    sentence_pieces,
    token_counts,
    token_files,
    url_rules,
    whitening,
)
from martkeeper.llm.common import work_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The rules that the query applies.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return sentence_pieces.round_trip(documents, tokenizer("piece_bpe_32k.model"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that hold an item, with the item's best window."""
    return decontam.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after a load, a second version for texts that aren't English, a clean-up and a removal.

    The load is sent twice, as a retry would; the second commit changes nothing.
    """
    import public_tokenizers

    documents = _table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    labels = _table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    english, many = "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"

    def changes(rows: DataFrame, version: str, op: str, ids: DataFrame | None = None) -> DataFrame:
        how = tokenizer(version), public_tokenizers.PATTERN
        if ids is None:
            counted = token_counts.token_counts(rows, *how)
        else:
            counted = token_counts.token_counts_of(rows, ids, *how)
        return counted.withColumn("version", F.lit(version)).withColumn("op", F.lit(op))

    ledger = token_counts.TokenLedger(spark, work_folder(spark, "token-ledger"))
    load = changes(documents, english, token_counts.INSERT)
    ledger.commit("load", load)
    ledger.commit("load", load)
    foreign = documents.filter("lang IS NULL OR lang <> 'en'")
    ledger.commit("many languages", changes(foreign, many, token_counts.INSERT))
    cleaned = documents.withColumn("text", F.regexp_replace(F.trim("text"), r"\s+", " "))
    poor = labels.filter("quality = 0").select("doc_id")
    ledger.commit("clean-up", changes(cleaned, english, token_counts.REVISE, poor))
    toxic = labels.filter("toxic = 1").select(
        "doc_id",
        F.explode(F.array(F.lit(english), F.lit(many))).alias("version"),
        F.lit(token_counts.DELETE).alias("op"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("source", "string"), ("lang", "string"), ("n_tokens", "bigint"))],
    )
    ledger.commit("toxic", toxic)
    return ledger.totals().withColumnsRenamed({"docs": "n_docs", "tokens": "n_tokens"})


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return token_files.token_files(spark, documents, tokenizer("word_bpe_49k.json")).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's lines that go, and a digest of the text that is left."""
    left = line_dedup.deduped(_table(spark, folder, "documents"), least=1)
    return left.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines_left"),
        F.size("removed_lines").cast("bigint").alias("n_removed"),
        "removed_lines",
        F.xxhash64("text").alias("text_hash"),
    )


def op6_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    return lm_scoring.score(documents, tokenizer("word_bpe_49k.json"))


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, folder, "pages"), URL_RULES)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, folder, "documents"))
    return judged.drop("content", "host", "removed_lines")


def op9_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.groups(_table(spark, folder, "documents"), width=4)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(_table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return grid_join.near_vectors(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_sentence_pieces": op1_sentence_pieces,
        "op2_decontamination": op2_decontamination,
        "op3_token_counts": op3_token_counts,
        "op4_token_files": op4_token_files,
        "op5_line_dedup": op5_line_dedup,
        "op6_lm_scores": op6_lm_scores,
        "op7_url_rules": op7_url_rules,
        "op8_quality_rules": op8_quality_rules,
        "op9_near_dups": op9_near_dups,
        "op10_language_id": op10_language_id,
        "op11_phrases": op11_phrases,
        "op12_whitening": op12_whitening,
        "op13_near_vectors": op13_near_vectors,
    }


_URLS = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule_host, rule_path, verdict) AS (VALUES {values})
SELECT q.page_id, q.host, q.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM q LEFT JOIN LATERAL (
  SELECT rule_host || rule_path AS rule, r.verdict FROM r
  WHERE (q.host = rule_host OR q.host LIKE '%.' || rule_host) AND starts_with(q.path, rule_path)
  ORDER BY length(rule_host) DESC, length(rule_path) DESC LIMIT 1) f ON true
""".format(values=", ".join(str(r) for r in URL_RULES))

_QUALITY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t
  FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (
  SELECT r, unnest(generate_series(1, len(ws) - 4)) AS i, ws FROM w WHERE len(ws) >= 5),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, list_slice(ws, i, i + 4)) AS n FROM g),
c AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat FROM h, (SELECT unnest(range(5)) AS k) WHERE n > 1
  GROUP BY r),
l AS (
  SELECT r, host, t, unnest(string_split(t, chr(10))) AS raw FROM d),
m AS (
  SELECT r, host, t, raw, len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) AS n,
    translate(array_to_string(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'), ' '),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line FROM l),
f AS (
  SELECT host, line, count(DISTINCT t) AS docs FROM m WHERE n > 0 GROUP BY ALL),
a AS (SELECT host, count(DISTINCT t) AS total FROM d GROUP BY host),
b AS (
  SELECT f.host, f.line FROM f JOIN a USING (host) WHERE docs > 20 AND docs * 100 > total * 5),
x AS (
  SELECT m.r, count(*) - count(DISTINCT raw) AS n_dup,
    coalesce(sum(m.n) FILTER (WHERE b.line IS NOT NULL), 0) AS gone
  FROM m LEFT JOIN b ON m.host = b.host AND m.line = b.line WHERE m.n > 0 GROUP BY m.r),
y AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words,
    len(ws) - coalesce(gone, 0) AS words_left
  FROM w LEFT JOIN x USING (r) LEFT JOIN c USING (r)),
z AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM y)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (words_left < 10 OR 100 * words_left < 30 * n_words) AS kept,
  words_left::BIGINT AS words_left
FROM z
"""


_PHRASES = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, ws, unnest(generate_series(1, len(ws) - k + 1)) AS i
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, list_slice(ws, i, i + k - 1) AS ph, count(*) AS a FROM g GROUP BY ALL),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, ph, a, unnest(range(1, len(ph))) AS k FROM f WHERE len(ph) > 1 AND a >= 30),
s AS (
  SELECT c.lang, c.ph, c.a, k, x.a AS l, y.a AS r,
    (2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a::HUGEINT))::BIGINT AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.ph = list_slice(c.ph, 1, k)
  JOIN f y ON y.lang = c.lang AND y.ph = list_slice(c.ph, k + 1, len(c.ph))),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
o AS (
  SELECT lang, list_slice(ph, i, i + m - 1) AS ph, max(a) AS a
  FROM (SELECT lang, ph, a, m, unnest(generate_series(1, len(ph) - m + 1)) AS i
    FROM f, (SELECT unnest([2, 3]) AS m) WHERE m < len(ph) AND a >= 30) GROUP BY ALL),
u AS (
  SELECT b.lang, array_to_string(b.ph, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM b LEFT JOIN o ON o.lang = b.lang AND o.ph = b.ph
  WHERE o.a IS NULL OR 100::HUGEINT * o.a < 80::HUGEINT * b.a)
SELECT u.lang, row_number() OVER (PARTITION BY u.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM u JOIN t ON t.lang = u.lang
QUALIFY row_number() OVER (PARTITION BY u.lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

_NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
k AS (
  SELECT r, vec_id, e FROM v WHERE e IS NOT NULL
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.r AS a, b.r AS b FROM k a JOIN k b
    ON a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(r, s) AS (SELECT r, r FROM v UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.s = l.a),
c AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.s GROUP BY reach.r),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id,
  v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.r = v.r LEFT JOIN n ON n.a = v.r
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_url_rules": _URLS,
        "op8_quality_rules": _QUALITY,
        "op11_phrases": _PHRASES,
        "op13_near_vectors": _NEAR_VECTORS,
    }
