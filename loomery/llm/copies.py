"""Records that differ only in formatting: one record per title with its number of copies.

A title is cut into parts, each part keeps its letters with their marks and its digits in lower case
(canonically composed), parts are sorted, and the result is hashed to 128 bits. Counts and first ids
are aggregated with map-side combining; a second hash of the spelling checks for collisions: it is part
of the key, so spellings that share a 128-bit hash stay apart (and are reported by ``collisions``).

Copies are found by joining the digests with the groups. Groups of more than a 1/``HEAVY`` part of the rows are fewer than
``HEAVY``, so they are broadcast and their rows stay where they are; no other group is large.

Defined results: titles without a letter or digit, null and empty ones are left out; redelivered rows are
copies; a group of any size is aggregated in partials, and its copies come out of the tasks that read them.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import checkpointed

#: Most groups that are broadcast (40 bytes each), and copies from which a group may be one.
HEAVY, LEAST = 20_000, 1000
_SPLIT = r"[|_/]|(?<=[\s\p{Z}])[\p{Pd}−](?=[\s\p{Z}])"


def canonical(c: Column) -> Column:
    """Sorted parts of letters, marks and digits, joined by a blank; '' if there is none."""
    parts = F.split(F.lower(c), _SPLIT)
    bare = F.transform(parts, lambda p: F.regexp_replace(p, r"[^\p{L}\p{M}\p{N}]+", ""))
    return F.array_join(F.array_sort(F.filter(bare, lambda p: p != "")), " ")


def composed(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Rows with ``text`` in canonical composition; rows without marks or compatibility ideographs pass by."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys, text).schema.fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(b.num_columns - 1)
            odd = pc.match_substring_regex(col, r"[\p{M}\x{1100}-\x{11FF}\x{2126}\x{212A}\x{212B}\x{F900}-\x{FAFF}]")
            if pc.any(odd).as_py():
                texts = col.to_pylist()
                col = pa.array([unicodedata.normalize("NFC", t) if o else t for t, o in zip(texts, odd.to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], col], names=b.schema.names)

    return df.select(*keys, text).mapInArrow(work, kinds)


def titles(pages: DataFrame, hits: DataFrame) -> DataFrame:
    """(src, run_id, row_id, canon) of every title with a letter or digit."""
    rows = pages.select(F.lit("page_audit").alias("src"), "run_id", F.col("audit_id").alias("row_id"), F.col("detail_title").alias("title")).unionByName(
        hits.select(F.lit("candidate").alias("src"), "run_id", F.col("ordinal").alias("row_id"), "title")
    )
    rows = rows.where(F.col("title").rlike(r"[\p{L}\p{N}]"))
    return composed(rows, ["src", "run_id", "row_id"], "title").select("src", "run_id", "row_id", canonical(F.col("title")).alias("canon")).where("canon <> ''")


def hashed(rows: DataFrame) -> DataFrame:
    """Adds ``h``, 128 bits over group and spelling, and ``check``, 64 bits of the same by another hash."""
    return rows.withColumn("h", _digest()).withColumn("check", F.xxhash64("src", "run_id", "canon"))


def _digest() -> Column:
    return F.unhex(F.md5(F.concat_ws("\u0001", "src", F.coalesce(F.col("run_id").cast("string"), F.lit("-")), "canon")))


def groups(digests: DataFrame) -> DataFrame:
    """(h, check, src, run_id, first_id, copies), one row per group of copies.

    Grouping by both hashes keeps spellings apart that collide in one; only numbers and digests are shuffled.
    """
    return digests.groupBy("h", "check").agg(F.min("src").alias("src"), F.min("run_id").alias("run_id"), F.min("row_id").alias("first_id"), F.count("*").alias("copies"))


def collisions(rows: DataFrame) -> DataFrame:
    """(h, spellings) of the 128-bit hashes that stand for more than one spelling."""
    return groups(hashed(rows)).groupBy("h").agg(F.count("*").alias("spellings")).where("spellings > 1")


def counts(rows: DataFrame) -> DataFrame:
    """(src, run_id, first_id, copies), one row per group of copies."""
    return groups(hashed(rows)).select("src", "run_id", "first_id", "copies")


def find(rows: DataFrame, heavy: int = HEAVY, least: int = LEAST) -> DataFrame:
    """(src, first_id, row_id): one row per copy beside the first of its group."""
    digests = checkpointed(hashed(rows).select("src", "run_id", "row_id", "h", "check"))  # titles are read and canonicalized once
    limit = max(least, digests.count() // heavy)
    several = groups(digests).where("copies > 1").select("h", "check", "first_id", "copies")
    big = several.where(F.col("copies") > limit).drop("copies")
    small = several.where(F.col("copies") <= limit).drop("copies")
    near = digests.join(F.broadcast(big), ["h", "check"])
    far = digests.join(F.broadcast(big.select("h", "check")), ["h", "check"], "left_anti").join(small, ["h", "check"])
    pick = lambda df: df.where("row_id <> first_id").select("src", "first_id", "row_id")
    return pick(near).unionByName(pick(far))
