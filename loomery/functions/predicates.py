"""Predicates over vocabularies given as lists (small, bounded by configuration, inlined into the plan)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def alternation(words: list[str]) -> str:
    return "|".join(map(re.escape, words)) if words else r"(?!)"


def contains_any(c: Column, words: list[str]) -> Column:
    """Any word stands somewhere in ``c``: one compiled alternation, one pass."""
    return c.rlike(alternation(words))


def first_hit(c: Column, words: list[str]) -> Column:
    """The first word in list order that stands in ``c``, or null."""
    return F.get(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w)), F.lit(0)) if words else F.lit(None).cast("string")


def hits(c: Column, words: list[str]) -> Column:
    """How many different words stand in ``c``."""
    return F.size(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))).cast("bigint")


def cascade(*steps: tuple[Column, Column | str], otherwise: Column | str) -> Column:
    """Value of the first condition that holds."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = F.when(steps[0][0], lit(steps[0][1]))
    for cond, v in steps[1:]:
        out = out.when(cond, lit(v))
    return out.otherwise(lit(otherwise))


def content_url(url: Column, host: Column, *, exclude: str, excluded_hosts: list[str], blocked: list[str], wanted: list[str]) -> Column:
    """A page of content: http(s), no excluded pattern, host or token, and one of the wanted patterns."""
    return url.rlike("^https?://") & ~url.rlike(exclude) & ~host.isin(excluded_hosts) & ~contains_any(host, blocked) & url.rlike("|".join(f"(?:{w})" for w in wanted))


def seed_url(url: Column, host: Column, domain: Column, content: Column, *, exclude: str, excluded_hosts: list[str], blocked: list[str], work: str, path: str) -> Column:
    """Same guards as ``content_url``; then a public work, content, or a deep enough path of the same site."""
    guards = url.rlike("^https?://") & ~url.rlike(exclude) & ~host.isin(excluded_hosts) & ~contains_any(host, blocked)
    rest = F.regexp_replace(url, r"^https?://[^/]*", "")
    deep = (F.length(rest) - F.length(F.replace(rest, F.lit("/"), F.lit(""))) >= 2) & ~rest.rlike(r"(/|\.html?|\.php)$")
    same = (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))
    return guards & (url.rlike(work) | content | (same & (rest.rlike(path) | deep)))


def blocked_url(host: Column, path: Column, *, excluded_hosts: list[str], blocked: list[str], path_tokens: list[str]) -> Column:
    return host.isin(excluded_hosts) | contains_any(host, blocked) | contains_any(F.concat(host, path), path_tokens)


def valid_title(t: Column, *, placeholder: str, chapter_like: str, bare: list[str]) -> Column:
    """Two letters or more, no placeholder or template mark, CJK or three Latin letters, no chapter caption, no bare genre."""
    cjk = r"[\x{4E00}-\x{9FFF}]"
    return (
        (F.length(t) >= 2) & ~t.rlike(placeholder) & ~t.rlike(r"\{\{|\}\}|\$\{|<%|%>") & (t.rlike(cjk) | t.rlike("(?s)[A-Za-z].*[A-Za-z].*[A-Za-z]"))
        & (~t.rlike(chapter_like) | t.rlike(rf"{cjk}{{2,}}.*(?:{chapter_like})")) & ~F.lower(t).isin(bare) & ~t.rlike(rf"^{cjk}{{1,2}}$")
    )


def valid_keyword(k: Column, *, generic: list[str], noise_prefix: str) -> Column:
    return (F.length(k) >= 2) & ~F.lower(k).isin(generic) & ~k.rlike(noise_prefix) & ~k.rlike(r"^\d+\s") & ~k.rlike(r"^[\d\s\p{P}]+$") & ~k.rlike(r"[<>{}\[\]|\\^~`@#$%&*+=;:]")
