"""Registered queries of the core operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import roundtrips
from ..runtime import spread, table
from . import core, nested


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.report_children(spread(table(spark, sf_dir, "rulebot_report").select("report_id", "body")))


def p5_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the reports with Dewey label, parent and own attributes."""
    return nested.shred(spread(table(spark, sf_dir, "rulebot_report").select("report_id", "body")), "report_id", "body", nested.REPORT)


def _table(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    rows = nested.shred(spread(table(spark, sf_dir, "rulebot_report").select("report_id", "body")), "report_id", "body", nested.REPORT, [path], attributes=False)
    return nested.table_of(rows, path).select("report_id", "label", "parent", "item")


def p5_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of generated audits."""
    return _table(spark, sf_dir, "generated[]")


def p5_generated_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of their evidence; ``parent`` is the label of the audit."""
    return _table(spark, sf_dir, "generated[].evidence")


def p5_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The child table of page_audit.evidence."""
    rows = nested.unfold(table(spark, sf_dir, "page_audit").select("audit_id", "evidence"), "audit_id", "evidence")
    return rows.select("audit_id", "label", "parent", "keyword", "engine", F.col("candidatetitle").alias("title"), F.col("candidatesnippet").alias("snippet"))


# JSON in DuckDB: a structure held in a string counts as what it holds (the test tables quote a few times at most), a lone value where a list belongs as a list
def _open(x: str, times: int = 2) -> str:
    for _ in range(times):
        x = f"(SELECT CASE WHEN json_type(o) = 'VARCHAR' AND json_valid(trim(o->>'$')) AND regexp_matches(o->>'$', '^\\s*[{{\\[\"]') THEN CAST(trim(o->>'$') AS JSON) ELSE o END FROM (SELECT {x} AS o))"
    return x


def _many(x: str) -> str:
    return f"(SELECT CASE WHEN w IS NULL OR json_type(w) = 'NULL' THEN [] WHEN json_type(w) = 'ARRAY' THEN CAST(w AS JSON[]) ELSE [w] END FROM (SELECT {_open(x)} AS w))"


def _text(x: str) -> str:
    return f"(SELECT coalesce(CASE WHEN json_type(y) = 'NULL' THEN '' WHEN json_type(y) = 'VARCHAR' THEN y->>'$' ELSE CAST(y AS VARCHAR) END, '') FROM (SELECT {x} AS y))"


def _each(rows: str, xs: str, keep: str = "report_id") -> str:
    """(keep, pos, x) of a list's elements."""
    return f"SELECT {keep}, i - 1 AS pos, {_open('xs[i]')} AS x FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM (SELECT {keep}, {_many(xs)} AS xs FROM {rows}))"


_HAS = "json_type(v) = 'OBJECT' AND (json_exists(v, '$.generated') OR json_exists(v, '$.excluded') OR json_exists(v, '$.stats'))"
_KIDS = "SELECT report_id, d + 1 AS d, unnest(CASE WHEN json_type(v) = 'OBJECT' THEN json_extract(v, '$.*') WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[*]') ELSE [] END) AS v"
_REPORTS = rf"""WITH b AS (SELECT report_id, regexp_replace(body, '^[\s\x{{FEFF}}]+|[\s\x{{FEFF}}]+$', '', 'g') AS t FROM rulebot_report WHERE body IS NOT NULL),
 l0 AS (SELECT report_id, 0 AS d, {_open('CAST(t AS JSON)')} AS v FROM b WHERE t <> '' AND json_valid(t)), l1 AS (SELECT report_id, d, {_open('k.v')} AS v FROM ({_KIDS} FROM l0) AS k), l2 AS (SELECT report_id, d, {_open('k.v')} AS v FROM ({_KIDS} FROM l1) AS k),
 r AS (SELECT report_id, arg_min(v, d) AS v FROM (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2) WHERE {_HAS} GROUP BY report_id),
 ok AS (SELECT * FROM (SELECT 'generated' AS section, * FROM ({_each('r', "v->'$.generated'")}) UNION ALL SELECT 'excluded', * FROM ({_each('r', "v->'$.excluded'")})) WHERE json_type(x) = 'OBJECT'),
 ev AS (SELECT * FROM (SELECT report_id, section, pos, {_open("x->'$.evidence'")} AS e FROM ok) WHERE json_type(e) = 'OBJECT' AND len(json_keys(e)) > 0)"""
_STATS = rf"""stats AS (SELECT * FROM (SELECT report_id, {_open("v->'$.stats'")} AS s FROM r) WHERE json_type(s) = 'OBJECT'),
 q AS ({_each('stats', "s->'$.queryStats'")}), sp AS ({_each('stats', _open("s->'$.seedDiscovery'") + "->'$.seedPageStats'")}), sm AS ({_each('stats', _open("s->'$.audit'") + "->'$.candidateSamples'")})"""


def _inner(rows: str, section: str, key: str) -> str:
    kids = _each(f"(SELECT report_id, pos AS up, x FROM {rows} WHERE json_type(x) = 'OBJECT')", f"x->'$.{key}'", "report_id, up")
    return f"SELECT report_id, '{section}', up, pos, {_text('x')} FROM ({kids}) WHERE x IS NOT NULL AND json_type(x) <> 'NULL'"


def _outer(rows: str, section: str, key: str) -> str:
    value = _text(f"x->'$.{key}'")
    return f"SELECT report_id, {section}, pos, -1, {value} FROM {rows} WHERE json_type(x) = 'OBJECT'"


_DETAIL, _KEYWORD = _text("x->'$.detail_url'"), _text("e->'$.keyword'")
QUERIES = {**core.QUERIES, **roundtrips.QUERIES, **{f.__name__: f for f in (p5_found, p5_nodes, p5_generated, p5_generated_evidence, p5_evidence)}}
SQL = {
    **core.SQL,
    **roundtrips.SQL,
    "p5_found": f"""{_REPORTS}, {_STATS}, f(report_id, section, pos, sub_pos, item) AS ({_outer('ok', 'section', 'detail_url')}
 UNION ALL SELECT report_id, section || '.evidence', pos, -1, {_KEYWORD} FROM ev
 UNION ALL {_inner("(SELECT * FROM ok WHERE section = 'generated')", 'generated.domainApplicabilityList', 'domainApplicabilityList')}
 UNION ALL {_outer('q', "'stats.queryStats'", 'query')} UNION ALL {_inner('q', 'stats.queryStats.engines', 'engines')}
 UNION ALL {_outer('sp', "'stats.seedDiscovery.seedPageStats'", 'seedUrl')} UNION ALL {_outer('sm', "'stats.audit.candidateSamples'", 'url')})
SELECT report_id, section, CAST(pos AS BIGINT) AS pos, CAST(sub_pos AS BIGINT) AS sub_pos, item FROM f""",
    "p5_generated": f"{_REPORTS} SELECT report_id, '0.' || pos AS label, '' AS parent, {_DETAIL} AS item FROM ok WHERE section = 'generated'",
    "p5_generated_evidence": f"{_REPORTS} SELECT report_id, '0.' || pos || '.0.0' AS label, '0.' || pos AS parent, {_KEYWORD} AS item FROM ev WHERE section = 'generated'",
    "p5_evidence": "SELECT audit_id, '0.0' AS label, '' AS parent, evidence.keyword AS keyword, evidence.engine AS engine, evidence.candidatetitle AS title, evidence.candidatesnippet AS snippet FROM page_audit WHERE evidence IS NOT NULL",
}
