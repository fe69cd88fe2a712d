"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keepwell.llm import (
    attribution, chat, decontaminate, divergence, flatfiles, html, jaccard, language, pieces, pii, quality, spelling, urls,
)
from keepwell.session import scratch


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op2_attribution(spark: SparkSession, folder: str) -> DataFrame:
    return attribution.attribute(table(spark, folder, "documents"))


def op3_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.links(table(spark, folder, "documents"))


def op4_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.pieces(table(spark, folder, "documents"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"  # reads like the marks themselves
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.digest(chat.examples(turns.union(extra)))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op8_html(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(table(spark, folder, "pages"))


def op9_flatfiles(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch(spark, "tokens")
    return flatfiles.read(spark, place, flatfiles.write(table(spark, folder, "documents"), place))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"))


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.groups(table(spark, folder, "documents"))


def op13_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return urls.judge(pages, urls.named_bad(pages)).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_attribution, op3_jaccard, op4_pieces, op5_chat, op6_decontaminate, op7_language, op8_html,
        op9_flatfiles, op10_quality, op11_divergence, op12_spelling, op13_urls,
    )
}

SQL: dict[str, str] = {
    # the sizes of the examples follow from the sizes of the escaped turns
    "op5_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), n AS (
  SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(14 + length(role) + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g'))
      + length(regexp_replace(role, '[^\\<#:]', '', 'g'))) OVER (w ROWS UNBOUNDED PRECEDING) AS size
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY r)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY r) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) FILTER (WHERE role = 'assistant' OR r = n) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
""",
    # a window starts where all its words follow one another; one row per document
    "op6_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS t
  FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS t
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, x.size, i, item_id FROM doc_windows x JOIN item_windows y ON x.t = y.t AND x.size = y.size
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(id, ',' ORDER BY id)) AS h
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hw.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(hi.n, 0) AS BIGINT) AS n_items, coalesce(hi.h, sha256('')) AS items_sha256, hw.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words hw ON hw.doc_id = d.doc_id LEFT JOIN hit_items hi ON hi.doc_id = d.doc_id
""",
    # every kept term of a language in every one of its groups, and every two groups of a language
    "op11_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
g AS (SELECT DISTINCT lang, source FROM d),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
c AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n, k.n AS n_lang, l.v, l.total
  FROM g JOIN kept k ON k.lang = g.lang JOIN l ON l.lang = g.lang
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term
), p AS (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (n_lang + 2)) // (total + 2 * v) AS q
  FROM c
), pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT x.lang, x.source, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN pair ON pair.lang = x.lang AND pair.source = x.source AND pair.item = y.source
), terms AS (
  SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM terms
)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM ranked QUALIFY part = 'pair' OR rank <= 10
""",
    "op13_urls": r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), r AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS address
  FROM u
), listed AS (
  SELECT DISTINCT address FROM r
  WHERE list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'casino', 'farm', 'pills', 'porn', 'spam', 'track', 'xxx'])
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL OR listed.address IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM r LEFT JOIN listed ON r.address = listed.address
""",
}
