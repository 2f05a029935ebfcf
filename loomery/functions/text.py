"""Text functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .urls import unescape


def strip(c: Column) -> Column:
    """Without white space of any kind at either end (Spark's trim takes blanks only)."""
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+\z", "")


def safe_str(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def clean_text(html: Column) -> Column:
    """Text of a page: scripts, styles and tags leave a blank, entities are resolved, blanks collapse."""
    t = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " ")
    t = unescape(F.regexp_replace(t, r"(?s)<[^>]+>", " "))
    return F.trim(F.regexp_replace(t, r"[\s\xA0]+", " "))


def clean_title(c: Column, tag_suffix: str, noise: str, tag_words: list[str]) -> Column:
    """Tag suffix and noise go; then each tag word (in list order) at the end of a title at least two letters longer."""
    t = F.trim(F.regexp_replace(F.regexp_replace(c, tag_suffix, ""), noise, ""))
    for w in tag_words:
        cut = F.trim(F.substring(t, F.lit(1), F.length(t) - len(w)))
        t = F.when(F.endswith(t, F.lit(w)) & (F.length(t) > len(w) + 1), cut).otherwise(t)
    return t


def clean_catalog_title(c: Column, noise: str) -> Column:
    t = F.regexp_replace(unescape(c), noise, "")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[\r\n]+", " "), r"\s{2,}", " "))


def first_good(candidates: list[Column], bad: str, fallback: Column, size: int = 48) -> Column:
    """First candidate cut to ``size`` that isn't empty, isn't bad and has two letters, else the fallback."""
    cut = [strip(F.substring(c, 1, size)) for c in candidates]
    return F.coalesce(*(F.when((F.length(c) >= 2) & ~c.rlike(bad), c) for c in cut), fallback)


def safe_id(name: Column, seed: Column | None = None, suffix: str = "_auto_public") -> Column:
    """Lower-case identifier of letters and digits, cut to 40, with eight hex digits of the seed's SHA-1."""
    s = F.regexp_replace(F.replace(F.lower(name), F.lit("www."), F.lit("")), "[^a-z0-9]+", "_")
    s = F.btrim(s, F.lit("_"))
    s = F.substring(F.when(s == "", "generated").otherwise(s), 1, 40)
    if seed is not None:
        s = F.concat(s, F.lit("_"), F.substring(F.sha1(seed), 1, 8))
    return F.concat(s, F.lit(suffix))


def comic_id(title: Column) -> Column:
    return F.substring(F.sha2(title, 256), 1, 16)


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first element ``tag``."""
    return clean_text(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1))


def meta_content(html: Column, key: str, name: str) -> Column:
    """content of ``<meta key="name">``, in either order of the attributes."""
    a = F.regexp_extract(html, rf"""(?is)<meta[^>]*\b{key}=["']{name}["'][^>]*\bcontent=["']([^"']*)["']""", 1)
    b = F.regexp_extract(html, rf"""(?is)<meta[^>]*\bcontent=["']([^"']*)["'][^>]*\b{key}=["']{name}["']""", 1)
    return F.coalesce(F.nullif(a, F.lit("")), b)


def meta_title(html: Column) -> Column:
    """First that isn't empty of h1, og:title and title (cut to 120), else the first 80 characters of the text."""
    some = [tag_text(html, "h1"), F.trim(unescape(meta_content(html, "property", "og:title"))), tag_text(html, "title")]
    return F.coalesce(*(F.nullif(F.substring(c, 1, 120), F.lit("")) for c in some), F.substring(clean_text(html), 1, 80))


def head_of(html: Column, size: int = 80000) -> Column:
    return F.regexp_extract(F.lower(F.substring(html, 1, size)), r"(?s)<head[^>]*>(.*?)</head>", 1)


def first_of(*values: Column) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def short_name(title: Column) -> Column:
    return F.substring(strip(F.split_part(title, F.lit("-"), F.lit(1))), 1, 30)


def version(ts: Column) -> Column:
    return F.date_format(ts, "yyyy.MM.dd.HHmm")


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def layered(*layers: dict[str, str]) -> dict[str, str]:
    """Named patterns, later layers win (built in, common, language)."""
    out: dict[str, str] = {}
    for layer in layers:
        out |= layer
    return out
