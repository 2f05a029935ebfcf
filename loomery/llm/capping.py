"""Hold each contributor to a maximum share, keeping its best records.

Only contributors above the cap need ranks; as the cap is a share of all rows, they are fewer than 1/share
(a proven bound, so their names and cut points may be broadcast). Their rows are salted by ranges of
quality: cut points come from mergeable quantile sketches, a cut point's own value is split further by
ranges of the identifier. A rank inside its salt plus the sizes of the better salts is the exact rank
within the contributor, so no task ever sorts a whole contributor.

Defined results: a null contributor has no cap; ties in quality go to the smaller identifier; redelivered rows are
rows of their own; an empty table gives no row; null counts are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A contributor's salts: quantiles of quality, and of the identifier where one value of quality is frequent.
CUTS, TIE_CUTS = 64, 32
SHARE = 100


def host(c: Column) -> Column:
    """A host however it is written: letter case, blanks, leading ``www.``, final dot."""
    h = F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), r"\.$", "")
    return F.regexp_replace(h, r"^www\.", "")


def quality() -> Column:
    """The reference's score of an audit: 1000 / 500 / 0 by status, three per image, one per chapter."""
    status = F.when(F.col("status") == "native_scroll_ok", 1000).when(F.col("status") == "render_fallback_needed", 500).otherwise(0)
    return (status + 3 * F.coalesce("static_image_count", F.lit(0)) + F.coalesce("chapter_count", F.lit(0))).cast("bigint")


def ranked(rows: DataFrame, cap: Column | int | None = None) -> DataFrame:
    """rows(row_id, contributor, quality) → rows of contributors above the cap with their ``rank`` and the ``cap``.

    cap: largest number a contributor may keep; by default floor(all rows / 100), at least 1.
    """
    counts = rows.groupBy("contributor").agg(F.count("*").alias("n"))
    total = counts.agg(F.greatest(F.floor(F.sum("n") / SHARE), F.lit(1)).alias("cap")) if cap is None else counts.limit(1).select(F.lit(cap).cast("bigint").alias("cap"))
    heavy = counts.where(F.col("contributor").isNotNull()).join(F.broadcast(total)).where("n > cap")  # one row on one side
    points = [i / CUTS for i in range(1, CUTS)]
    ties = [i / TIE_CUTS for i in range(1, TIE_CUTS)]
    few = F.broadcast if cap is None else lambda df: df  # a cap given as a number doesn't bound the contributors above it
    busy = rows.join(few(heavy.select("contributor", "cap")), "contributor")
    edges = busy.groupBy("contributor").agg(
        F.array_distinct(F.percentile_approx("quality", points, F.lit(1000))).alias("cuts"), F.percentile_approx("row_id", ties, F.lit(1000)).alias("id_cuts")
    )
    salted = busy.join(few(edges), "contributor").select(
        "row_id", "contributor", "quality", "cap",
        (2 * F.size(F.filter("cuts", lambda x: x > F.col("quality"))) + F.array_contains("cuts", F.col("quality")).cast("int")).alias("salt"),
        F.when(F.array_contains("cuts", F.col("quality")), F.size(F.filter("id_cuts", lambda x: x <= F.col("row_id")))).otherwise(0).alias("tie"),
    )
    # salts in falling order of quality: between two cuts, then the lower cut's own value by ranges of the identifier
    sizes = salted.groupBy("contributor", "salt", "tie").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("contributor").orderBy("salt", "tie")) - F.col("n")).drop("n")
    inside = Window.partitionBy("contributor", "salt", "tie").orderBy(F.desc("quality"), "row_id")
    return (
        salted.withColumn("inside", F.row_number().over(inside))
        .join(few(before), ["contributor", "salt", "tie"])
        .select("row_id", "contributor", "quality", "cap", (F.col("inside") + F.col("before")).alias("rank"))
    )


def audits(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("audit_id").alias("row_id"), host(F.col("domain")).alias("contributor"), quality().alias("quality"))
