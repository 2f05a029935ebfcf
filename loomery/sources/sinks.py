"""Sinks. Spark's committer makes each write appear whole or not at all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tables(df: DataFrame, path: str, by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Parquet, partitioned by the given columns (catalogs: language and category)."""
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON document per row, nulls kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def append_new(df: DataFrame, key: str, path: str, existing: DataFrame | None) -> DataFrame:
    """Append the keys that the log doesn't have yet; gives back what was new."""
    fresh = df.select(key).where(F.col(key).isNotNull()).distinct()
    if existing is not None:
        fresh = fresh.join(existing.select(key), key, "left_anti")
    fresh.sortWithinPartitions(key).write.mode("append").parquet(path)
    return fresh


def index_document(rules: DataFrame, schema_version: str, stamp: Column) -> DataFrame:
    """Header row of a rule index beside its number of rules; the rules stay a table of their own."""
    return rules.agg(F.count("*").alias("rules")).select(F.lit(schema_version).alias("schema"), F.date_format(stamp, "yyyy.MM.dd.HHmm").alias("version"), F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), "rules")


def before_after(before: DataFrame, after: DataFrame, name: str) -> DataFrame:
    """Counters of a cleaning step: rows before, after and removed."""
    n = before.agg(F.count("*").alias("before")).join(after.agg(F.count("*").alias("after")))  # one row each
    return n.select(F.lit(name).alias("step"), "before", "after", (F.col("before") - F.col("after")).alias("removed"))


def rule_source(rules: DataFrame, name: str = "RULES") -> DataFrame:
    """Rules as lines of a source-code constant, one JSON object each (order them before writing)."""
    return rules.select(F.concat(F.lit(f"/* {name} */ "), F.to_json(F.struct("*")), F.lit(",")).alias("value"))
