"""Multi-stage plans: each is one lazy DataFrame, built from the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import urls as U
from ..operators import relational as R


def discover_candidates(seeds: DataFrame, pages: DataFrame, links: DataFrame, *, per_domain: int, total: int) -> tuple[DataFrame, DataFrame]:
    """Seed pages → candidates and one statistics row per seed.

    seeds(seed_no, seed_url), pages(url), links(page_url, pos, url): a seed without a page is a failed fetch. Caps
    are per domain by arrival, then overall; repeated pages go to the first.
    """
    s = seeds.join(pages.select(F.col("url").alias("seed_url"), F.lit(True).alias("there")), "seed_url", "left")
    hits = s.where("there").join(links.withColumnRenamed("page_url", "seed_url"), "seed_url").select(
        F.struct("seed_no", "pos").alias("ordinal"), "seed_no", U.defragment(F.col("url")).alias("url"), U.domain_of(F.col("url")).alias("domain")
    )
    capped = R.arrival_cap(R.first_wins(hits, ["url"], "ordinal"), ["domain"], "ordinal", per_domain)
    chosen = R.global_cap(capped, "ordinal", total)
    count = lambda df, n: df.groupBy("seed_no").agg(F.count("*").alias(n))
    stats = s.join(count(hits, "candidates"), "seed_no", "left").join(count(chosen, "selected"), "seed_no", "left").select(
        "seed_no", "seed_url", F.when(F.col("there"), "ok").otherwise("fetch_failed").alias("status"), F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.when(F.col("there"), F.coalesce("selected", F.lit(0))).alias("selected"), F.when(F.col("there"), U.domain_of(F.col("seed_url"))).alias("target_domain"),
    )
    return chosen, stats


def validate_sites(sites: DataFrame, known: DataFrame, verdict: Column, kept: list[str], recheck: bool = False) -> DataFrame:
    """sites(domain, …) with their verdict; known ones are kept without a check unless ``recheck``."""
    flagged = sites.join(known.select("domain", F.lit(True).alias("known")), "domain", "left")
    skip = F.coalesce("known", F.lit(False)) & F.lit(not recheck)
    return flagged.select("domain", F.when(skip, "existing").otherwise(verdict).alias("verdict")).withColumn("keep", F.col("verdict").isin("existing", *kept))


def split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """What passes and what doesn't (null counts as not)."""
    mark = F.coalesce(ok, F.lit(False))
    return df.where(mark), df.where(~mark)


def expand_queries(keywords: DataFrame, domains: DataFrame, generic: list[str], variants: list[str], most_domains: int = 10) -> DataFrame:
    """keywords(pos, keyword) × variants, then × ``site:`` of the first domains(pos, domain); generic keywords first.

    Both sides are configuration lists; ordered distinct by (generic, keyword, variant).
    """
    first = F.when(P.contains_any(F.lower("keyword"), generic), 0).otherwise(1)
    k = keywords.select("keyword", first.alias("g"), F.col("pos").alias("kp"))
    plain = k.select("g", "kp", F.posexplode(F.array(*(F.replace(F.lit(v), F.lit("{keyword}"), F.col("keyword")) for v in variants))).alias("vp", "query"))
    few = domains.orderBy("pos").limit(most_domains).agg(F.sort_array(F.collect_list(F.struct("pos", "domain"))).alias("ds"))  # at most most_domains
    sites = k.join(F.broadcast(few)).select("g", "kp", F.posexplode(F.transform("ds", lambda d: F.concat("keyword", F.lit(" site:"), d["domain"]))).alias("vp", "query")).withColumn("vp", F.col("vp") + 1000)
    both = plain.unionByName(sites)
    return both.groupBy("query").agg(F.min(F.struct("g", "kp", "vp")).alias("place"))
