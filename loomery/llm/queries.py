"""The p-queries of the llm operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread, table
from ..functions import urls
from . import abuse, bpe, capping, copies, garble, language, leaks, lookalike, residue


def _model(pages: DataFrame, hits: DataFrame) -> garble.Model:
    return garble.train(garble.fields(pages, hits).select("text"))


def _titles_snippets(pages: DataFrame, hits: DataFrame) -> DataFrame:
    return spread(
        pages.select(F.lit("page_audit").alias("src"), F.col("audit_id").alias("row_id"), F.col("detail_title").alias("text")).unionByName(
            hits.select(F.lit("candidate").alias("src"), F.col("ordinal").alias("row_id"), F.col("snippet").alias("text"))
        )
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, hits = table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")
    return lookalike.find(_titles_snippets(pages, hits), _model(pages, hits)).select("src", "row_id")


def p1_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title and snippet in plain form."""
    pages, hits = table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")
    return lookalike.normalize(_titles_snippets(pages, hits), ["src", "row_id"], F.col("text")).select("src", "row_id", "plain")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "page_audit")
    rows = pages.select("audit_id", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("detail_title", "first_chapter_title")))).alias("x"))
    return residue.find(spread(rows.select("audit_id", "x.field", "x.text"))).select("audit_id", "field")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capping.ranked(capping.audits(table(spark, sf_dir, "page_audit"))).where("rank > cap").select(F.col("row_id").alias("audit_id"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.find(copies.titles(table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")))


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per title and run with its number of copies."""
    rows = copies.titles(table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate"))
    return copies.counts(rows)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, hits = table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")
    return garble.find(garble.fields(pages, hits), _model(pages, hits)).select("src", "row_id", "field")


def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Garbled values with the chain that garbled them and, where it can be regained, the original."""
    pages, hits = table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")
    return garble.find(garble.fields(pages, hits), _model(pages, hits))


def _labelled(pages: DataFrame, hits: DataFrame) -> list[DataFrame]:
    return [
        pages.select(F.lit("page_audit").alias("src"), F.col("audit_id").alias("row_id"), F.col("detail_title").alias("text"), F.col("lang").alias("label"), capping.host(F.col("domain")).alias("host")),
        hits.select(F.lit("candidate").alias("src"), F.col("ordinal").alias("row_id"), F.col("snippet").alias("text"), F.col("lang").alias("label"), urls.domain_of(F.col("url")).alias("host")),
    ]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, hits = table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate")
    both = _labelled(pages, hits)
    rows = both[0].unionByName(both[1])
    no = language.no_cases(spark.sparkContext.broadcast(_model(pages, hits)))
    return language.label(spread(rows), language.train(both), language.host_priors(rows.select("host", "label")), no).select("src", "row_id", "lang")


def p7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language of every title and snippet with a confidence."""
    both = _labelled(table(spark, sf_dir, "page_audit"), table(spark, sf_dir, "candidate"))
    rows = both[0].unionByName(both[1])
    return language.label(spread(rows), language.train(both), language.host_priors(rows.select("host", "label")))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text")


def p8_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text decoded from its ids; null and empty texts come back empty."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return bpe.decode(bpe.encode(docs, "doc_id", "text"), "doc_id", "ids")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.find(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each leaked item with the number of documents that hold a passage of it."""
    found = leaks.find(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_item"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("windows").alias("most_windows"))


def p9_scrubbed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the leaked spans, and how many characters went."""
    return leaks.scrub(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), table(spark, sf_dir, "eval_item"))


def _scored(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    texts = spread(table(spark, sf_dir, "documents").select("doc_id", "text", *(keep or [])))
    return abuse.score(texts, table(spark, sf_dir, "doc_rating"), keep)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).where("passages > 0").select("doc_id")


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and number of significant passages of every document."""
    return _scored(spark, sf_dir)


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, those with a significant passage, their share and its 95 % interval."""
    return abuse.rates(_scored(spark, sf_dir, ["source"]))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_plain, p2_found, p3_found, p4_found, p4_counts, p6_found, p6_restored, p7_found, p7_languages, p8_ids, p8_text, p9_found, p9_items, p9_scrubbed, p10_found, p10_scores, p10_rates)
}

_CANON = r"""array_to_string(list_sort(list_filter(list_transform(
    string_split_regex(regexp_replace(lower(nfc_normalize(title)), '([\s\p{Z}])[\p{Pd}−]([\s\p{Z}])', '\1|\2', 'g'), '[|_/]'),
    lambda p: regexp_replace(p, '[^\p{L}\p{M}\p{N}]+', '', 'g')), lambda p: p <> '')), ' ')"""
_TITLES = rf"""WITH t AS (SELECT src, run_id, row_id, {_CANON} AS canon FROM (
    SELECT 'page_audit' AS src, run_id, audit_id AS row_id, detail_title AS title FROM page_audit
    UNION ALL SELECT 'candidate', run_id, ordinal, title FROM candidate) WHERE regexp_matches(title, '[\p{{L}}\p{{N}}]'))"""

_LEAKS = r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT item_id, lang ILIKE 'zh%' AS zh, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_item WHERE text IS NOT NULL),
 dw AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(list_slice(w, k, k + 11), ' '))) AS g FROM d), iw AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(list_slice(w, k, k + 11), ' '))) AS g FROM i WHERE NOT coalesce(zh, false)),
 dc AS (SELECT doc_id, unnest(list_transform(range(1, length(array_to_string(w, '')) - 22), lambda k: substr(array_to_string(w, ''), k, 24))) AS g FROM d), ic AS (SELECT item_id, unnest(list_transform(range(1, length(array_to_string(w, '')) - 22), lambda k: substr(array_to_string(w, ''), k, 24))) AS g FROM i WHERE zh),
 f AS (SELECT doc_id, item_id, g FROM dw JOIN iw USING (g) UNION SELECT doc_id, item_id, g FROM dc JOIN ic USING (g))"""

SQL = {
    "p8_text": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    "p9_found": _LEAKS + " SELECT DISTINCT doc_id, item_id FROM f",
    "p9_items": _LEAKS + ", n AS (SELECT doc_id, item_id, count(DISTINCT g) AS k FROM f GROUP BY ALL) SELECT item_id, count(*) AS documents, max(k) AS most_windows FROM n GROUP BY item_id",
    "p3_found": r"""
WITH a AS (SELECT audit_id, regexp_replace(regexp_replace(lower(regexp_replace(domain, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), '\.$', ''), '^www\.', '') AS host,
    (CASE status WHEN 'native_scroll_ok' THEN 1000 WHEN 'render_fallback_needed' THEN 500 ELSE 0 END) + 3 * coalesce(static_image_count, 0) + coalesce(chapter_count, 0) AS q FROM page_audit)
SELECT audit_id FROM (SELECT audit_id, host, row_number() OVER (PARTITION BY host ORDER BY q DESC, audit_id) AS r FROM a)
WHERE host IS NOT NULL AND r > greatest((SELECT count(*) FROM page_audit) // 100, 1)""",
    "p4_found": _TITLES + " SELECT src, first_id, row_id FROM (SELECT src, row_id, min(row_id) OVER (PARTITION BY src, run_id, canon) AS first_id FROM t WHERE canon <> '') WHERE row_id <> first_id",
    "p4_counts": _TITLES + " SELECT src, run_id, min(row_id) AS first_id, count(*) AS copies FROM t WHERE canon <> '' GROUP BY src, run_id, canon",
}
