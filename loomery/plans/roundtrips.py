"""What the sinks write, read back by the sources: one query for each kind of document."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..runtime import scratch, table
from ..sources import files, sinks

_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '')"


def sink_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog, partitioned by a column of its entries."""
    to = scratch(spark)
    rows = table(spark, sf_dir, "candidate").where("engine <> ''").select("engine", "ordinal", "title")
    sinks.tables(rows, to, ["engine"])
    return spark.read.schema(rows.schema).parquet(to).select("engine", "ordinal", "title")


def sink_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of runs, a JSON document each, with lists inside and null fields kept."""
    to = scratch(spark)
    c = table(spark, sf_dir, "candidate").groupBy("run_id").agg(F.count("*").alias("candidates"), F.sort_array(F.collect_set("engine")).alias("engines"), F.min_by("title", "ordinal").alias("first_title"))
    sinks.json_lines(c, to)
    return spark.read.schema("run_id bigint, candidates bigint, engines array<string>, first_title string").json(to).withColumn("engines", F.array_join("engines", ","))


def sink_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule index: the header as a document of its own, read as a JSON source, beside its rules."""
    to = scratch(spark)
    rules = table(spark, sf_dir, "url_template").where("template is not null")
    sinks.json_lines(sinks.index_document(rules, "v2", F.lit("2025-03-04 05:06:07").cast("timestamp")).coalesce(1), f"{to}/header")
    sinks.tables(rules, f"{to}/rules")
    header = files.json_documents(spark, f"{to}/header", "schema string, version string, rules bigint, absent string")
    return spark.read.parquet(f"{to}/rules").join(F.broadcast(header)).select("domain", "template", "schema", "version", "rules", "absent")  # one row of header


def sink_rule_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as lines of source code, read as lines and taken apart again."""
    to = scratch(spark)
    sinks.rule_source(table(spark, sf_dir, "url_template").select("domain", "template"), "RULES").write.text(to)
    rule = F.from_json(F.regexp_extract("value", r"^/\* RULES \*/ (.*),$", 1), "domain string, template string")
    return files.lines(spark, to).select(rule.alias("r")).select("r.*")


def sink_cleaned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log of hosts: what a second run knows already isn't written again."""
    to = scratch(spark)
    hosts = table(spark, sf_dir, "candidate").select("run_id", U.domain_of(F.col("url")).alias("host"))
    sinks.append_new(hosts.where("run_id % 2 = 0"), "host", to, None)
    sinks.append_new(hosts, "host", to, spark.read.parquet(to))
    return spark.read.parquet(to).groupBy("host").agg(F.count("*").alias("lines"))


def source_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration files on the driver and lists keyed by language: a missing or broken file gives the default."""
    with tempfile.TemporaryDirectory() as folder:  # read by the driver only
        there, broken = Path(folder, "a.json"), Path(folder, "b.json")
        there.write_text(json.dumps({"en": ["well", "kite"], "de": ["Brunnen"]}), encoding="utf-8")
        broken.write_text('{"en": [', encoding="utf-8")
        configs = [(name, files.json_config(str(path), {"en": ["default"]})) for name, path in (("there", there), ("broken", broken), ("missing", Path(folder, "c.json")))]
    out = [files.keyed_lists(spark, config).select(F.lit(name).alias("source"), "lang", "pos", "value") for name, config in configs]
    return out[0].unionByName(out[1]).unionByName(out[2])


QUERIES = {f.__name__: f for f in (sink_catalog, sink_report, sink_index, sink_rule_source, sink_cleaned_log, source_config)}
SQL = {
    "sink_catalog": "SELECT engine, ordinal, title FROM candidate WHERE engine <> ''",
    "sink_report": "SELECT run_id, count(*) AS candidates, coalesce(string_agg(DISTINCT engine, ',' ORDER BY engine), '') AS engines, arg_min_null(title, ordinal) AS first_title FROM candidate GROUP BY run_id",
    "sink_index": "SELECT domain, template, 'v2' AS schema, '2025.03.04.0506' AS version, (SELECT count(*) FROM url_template WHERE template IS NOT NULL) AS rules, CAST(NULL AS VARCHAR) AS absent FROM url_template WHERE template IS NOT NULL",
    "sink_rule_source": "SELECT domain, template FROM url_template",
    "sink_cleaned_log": f"SELECT DISTINCT {_HOST} AS host, 1 AS lines FROM candidate WHERE url IS NOT NULL",
    "source_config": "SELECT * FROM (VALUES ('there', 'en', 0, 'well'), ('there', 'en', 1, 'kite'), ('there', 'de', 0, 'Brunnen'), ('broken', 'en', 0, 'default'), ('missing', 'en', 0, 'default')) AS t(source, lang, pos, value)",
}
