"""File sources: JSON documents, line lists, language-keyed lists, saved search results and pages."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One row per JSON document; one that can't be parsed gives nulls (the reference's default)."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def json_config(path: str, default: object) -> object:
    """A small configuration file on the driver; missing or broken → default."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return default


def lines(spark: SparkSession, path: str, domains: bool = False) -> DataFrame:
    """(value): lines without blanks around, blank ones and comments; ``domains``: lower case, without ``www.``."""
    v = F.regexp_replace("value", r"^[\s\p{Z}﻿]+|[\s\p{Z}]+\z", "")
    rows = spark.read.text(path).select(v.alias("value")).where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))
    return rows.select(F.replace(F.lower("value"), F.lit("www."), F.lit("")).alias("value")) if domains else rows


def keyed_lists(spark: SparkSession, config: dict[str, list[str]]) -> DataFrame:
    """(lang, pos, value) of a configuration that maps a language to an ordered list."""
    rows = [(k, i, v) for k, vs in config.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "lang string, pos int, value string")


def search_results(spark: SparkSession, path: str) -> DataFrame:
    """Saved results of any search engine: engine, query, page, rank, url, title, snippet."""
    return spark.read.schema("engine string, query string, page int, rank int, url string, title string, snippet string").parquet(path)


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages (url, html); a page that isn't there stands for a failed fetch, so join it with ``left``."""
    return spark.read.schema("url string, html string").parquet(path)
