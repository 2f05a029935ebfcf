"""Order-aware relational operators. Every input carries its arrival order in a column."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import checkpointed


def first_wins(df: DataFrame, keys: list[str], order: str, drop_empty: bool = True) -> DataFrame:
    """First row by ``order`` of each key; rows with a null or empty key go.

    An aggregate with map-side combining rather than a window: a hot key costs no more than any other.
    """
    if drop_empty:
        for k in keys:
            df = df.where(F.col(k).isNotNull() & (F.col(k).cast("string") != ""))
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_w")).select(*keys, "_w.*").select(*df.columns)


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each group; Spark cuts each task's groups to k before the shuffle (WindowGroupLimit)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def arrival_cap(df: DataFrame, group: list[str], order: str, n: int) -> DataFrame:
    """At most n rows per group in order of arrival."""
    return top_k(df, group, [F.col(order)], n, "_rn").drop("_rn")


#: Bytes (of the files that are read) for each range of rows that one task sorts; most ranges.
RANGE_BYTES, MOST_RANGES = 16 << 20, 10_000


def ranged(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows with ``_b``, the number of their range in the given order; ranges grow in number with the data, rows of one key share one.

    The rows are written once (see ``checkpointed``), as ranges come from samples and must not change under a later stage.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    ranges = min(MOST_RANGES, max(8, sum(n for n in sizes if n < 1 << 60) // RANGE_BYTES + 1))  # rows without files have no known size
    return checkpointed(df.repartitionByRange(ranges, *order).withColumn("_b", F.spark_partition_id()))


def running(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over each row and those before it in a total order, without one task sorting all rows: the sum inside the row's range plus those of the ranges before."""
    cut = ranged(df, order)
    sums = cut.groupBy("_b").agg(F.sum(value).alias("_n"))
    before = sums.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # at most MOST_RANGES rows
    inside = F.sum(value).over(Window.partitionBy("_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn(name, inside).join(F.broadcast(before), "_b").withColumn(name, F.col(name) + F.col("_before")).drop("_b", "_before")


def numbered(df: DataFrame, order: str | list[Column], name: str = "rn") -> DataFrame:
    """1-based place of each row in a total order."""
    return running(df, [F.col(order)] if isinstance(order, str) else order, F.lit(1), name)


def global_cap(df: DataFrame, order: str, n: int) -> DataFrame:
    """First n rows by arrival (each task keeps n, then one merge)."""
    return df.orderBy(order).limit(n)


def ordered_union(frames: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """Union of branches in the order given, first of each key wins; result carries ``branch`` and ``order``."""
    all_rows = None
    for i, f in enumerate(frames):
        f = f.withColumn("branch", F.lit(i))
        all_rows = f if all_rows is None else all_rows.unionByName(f)
    ranked = all_rows.withColumn("_o", F.struct("branch", order))
    rest = [c for c in all_rows.columns if c not in keys]
    return ranked.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col("_o")).alias("_w")).select(*keys, "_w.*").select(*all_rows.columns)


def cascade_fill(df: DataFrame, query: str, prio: str, rank: str, key: str, limit: int, cap: Column | None = None) -> DataFrame:
    """Engines in order of priority fill up each query's result until ``limit`` different keys; ``cap`` limits an engine's part."""
    if cap is not None:
        df = df.withColumn("_r", F.row_number().over(Window.partitionBy(query, prio).orderBy(rank))).where(F.col("_r") <= cap).drop("_r")
    one = df.withColumn("_o", F.struct(prio, rank)).groupBy(query, key).agg(F.min("_o").alias("_o")).select(query, key, "_o.*")
    return top_k(one, [query], [F.col(prio), F.col(rank)], limit, "place")


def streak_cut(df: DataFrame, group: list[str], order: str, bad: Column, n: int) -> DataFrame:
    """Rows of each group up to and with the one that completes n bad rows in a row.

    Rows are numbered by group and order, so those of a group have consecutive places. Each bad row votes for its own place and
    the n - 1 after it; a place with n votes of its group completes a streak. No task holds a whole group.
    """
    rows = numbered(df.withColumn("_bad", F.coalesce(bad, F.lit(False))), [*map(F.col, group), F.col(order)], "_at")
    votes = rows.where("_bad").select(*group, F.explode(F.sequence(F.col("_at"), F.col("_at") + (n - 1))).alias("_at"))
    stops = votes.groupBy(*group, "_at").agg(F.count("*").alias("_n")).where(F.col("_n") == n).groupBy(*group).agg(F.min("_at").alias("_stop"))
    o, s = rows.alias("o"), stops.alias("s")
    same = [F.col(f"o.{g}").eqNullSafe(F.col(f"s.{g}")) for g in group]
    return o.join(s, same, "left").where(F.col("_stop").isNull() | (F.col("_at") <= F.col("_stop"))).select(*(F.col(f"o.{c}") for c in df.columns))


def round_robin(items: DataFrame, order: str, bins: DataFrame, room: str, bin_order: str) -> DataFrame:
    """Deal items in order to the bins in turn, skipping full ones; what finds no room is dropped.

    Closed form: the k-th slot of each bin with room for it, sorted by (k, bin), takes the item of the same place.
    bins is small (one row per category); slots are as many as the room of all bins.
    """
    slots = bins.where(F.col(room) > 0).select("*", F.explode(F.sequence(F.lit(0), F.col(room) - 1)).alias("_k"))
    return numbered(items, order).join(numbered(slots, [F.col("_k"), F.col(bin_order)]).drop("_k"), "rn").drop("rn")


def merge_keyed(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Full outer merge: the old value where there is one, else the new; keys of either side stay."""
    o, n = old.alias("o"), new.alias("n")
    return o.join(n, keys, "full_outer").select(*keys, *(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in columns))


def latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row by ``order`` of each key (upsert)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_w")).select(*keys, "_w.*").select(*df.columns)


def without_tokens(df: DataFrame, text: str, tokens: DataFrame, token: str, limit: int = 2000) -> DataFrame:
    """Rows in whose ``text`` no token stands (anti-join on 'contains')."""
    return _by_tokens(df, text, tokens, token, limit, keep=False)


def with_tokens(df: DataFrame, text: str, tokens: DataFrame, token: str, limit: int = 2000) -> DataFrame:
    """Rows in whose ``text`` some token stands (semi-join on 'contains')."""
    return _by_tokens(df, text, tokens, token, limit, keep=True)


def _by_tokens(df: DataFrame, text: str, tokens: DataFrame, token: str, limit: int, keep: bool) -> DataFrame:
    """Up to ``limit`` tokens (their number is checked) become one alternation; more are looked up by their first three letters
    (shorter ones as they are), so the join stays an equi-join. Rows without a text are neither with nor without, as in SQL."""
    few = [r[0] for r in tokens.select(token).where(F.length(token) > 0).distinct().limit(limit + 1).collect()]
    df = df.where(F.col(text).isNotNull())
    if len(few) <= limit:
        hit = F.col(text).rlike("|".join(map(re.escape, few))) if few else F.lit(False)
        return df.where(hit if keep else ~hit)
    t = tokens.select(F.col(token).alias("_t"), F.substring(token, 1, 3).alias("_g")).where(F.length("_t") > 0).distinct()
    sizes = sorted(r[0] for r in t.select(F.length("_g")).distinct().collect())  # at most 1, 2 and 3
    rows = df.withColumn("_id", F.monotonically_increasing_id())

    def pieces(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1))), lambda i: F.substring(F.col(text), i, F.lit(n)))

    grams = rows.select("_id", text, F.explode(F.array_distinct(F.concat(*map(pieces, sizes)))).alias("_g"))
    hit = grams.join(t, "_g").where(F.contains(F.col(text), F.col("_t"))).select("_id").distinct()
    return rows.join(hit, "_id", "left_semi" if keep else "left_anti").drop("_id")


def follow(starts: DataFrame, links: DataFrame, start: str, node: str, target: str, most: int) -> DataFrame:
    """(start, step, node): chains of links (node → target, one target each) from every starting node, of at most ``most`` nodes.

    starts(start, node); a chain ends before a node that it has passed. ``most`` is small (next pages of a chapter): one equi-join a step.
    """
    hop = links.select(node, F.col(target).alias("_to")).where(F.col("_to").isNotNull())
    now = starts.select(start, F.lit(0).alias("step"), node, F.array(node).alias("_seen"))
    out = now
    for step in range(1, most):
        now = now.join(hop, node).where(~F.array_contains("_seen", F.col("_to"))).select(start, F.lit(step).alias("step"), F.col("_to").alias(node), F.concat("_seen", F.array("_to")).alias("_seen"))
        out = out.unionByName(now)
    return out.drop("_seen")
