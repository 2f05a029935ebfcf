"""Rows out of HTML by regular expressions in the JVM: links, chapters, images, covers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

ANCHOR = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
IMAGE_ATTRS = ("src", "data-src", "data-original", "data-lazy-src", "data-url", "data-srcset", "srcset")
IMAGE_URL = r"""(?i)["'(]((?:https?:)?//[^"'()\s<>]+?\.(?:jpe?g|png|webp|gif|avif)(?:\?[^"'()\s<>]*)?)["')]"""


def anchors(df: DataFrame, html: str, base: str, dots: bool = True) -> DataFrame:
    """One row per ``<a href>``: pos, canonical url and text, beside the columns of ``df``."""
    seen = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<!--.*?-->", " ")  # a parser sees no tags there
    both = F.arrays_zip(F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(2)).alias("body"))
    rows = df.select("*", F.posexplode(both).alias("pos", "_a"))
    return rows.withColumn("url", U.canonical_url(F.col("_a.href"), F.col(base), dots)).withColumn("text", T.clean_text(F.col("_a.body"))).drop("_a")


def outlinks(df: DataFrame, html: str, skip: list[str]) -> DataFrame:
    """Absolute href and src URLs, quotes optional, without those that hold a skip word."""
    pattern = r"""(?i)\b(?:href|src)\s*=\s*["']?(https?://[^\s"'<>]+)"""
    rows = df.select("*", F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(1))).alias("pos", "url"))
    return rows.where(~F.lower("url").rlike("|".join(map(re.escape, skip)))) if skip else rows


def chapters(df: DataFrame, key: str, html: str, base: str, *, chapter: str, noise: str, exclude: str, limit: int = 500, dots: bool = True) -> DataFrame:
    """Chapter links in page order: text or URL looks like one, not noise; the last path segment names one without text."""
    from .relational import first_wins, top_k

    rows = anchors(df.select(key, html, base), html, base, dots).drop(html)
    rows = rows.withColumn("url", U.defragment(F.col("url"))).where(~F.col("url").rlike(exclude) & (F.col("text").rlike(chapter) | F.col("url").rlike(chapter)))
    rows = rows.where(~(F.col("text").rlike(noise) & ~F.col("text").rlike(chapter)))
    rows = rows.withColumn("text", F.when(F.col("text") == "", F.regexp_extract("url", r"([^/]+)/?$", 1)).otherwise(F.col("text")))
    return top_k(first_wins(rows.select(key, "url", "pos", "text"), [key, "url"], "pos"), [key], [F.col("pos")], limit, "rank")


def image_urls(html: Column) -> Column:
    """All image addresses of a page in order: seven attributes of img and source, then quoted URLs; noscript text included."""
    found = [F.regexp_extract_all(html, F.lit(rf"""(?is)<(?:img|source)\b[^>]*?\b{a}\s*=\s*["']([^"']+)["']"""), F.lit(1)) for a in IMAGE_ATTRS]
    first = [F.flatten(F.transform(f, lambda s: F.transform(F.split(F.trim(s), r",\s+"), lambda p: F.split_part(F.trim(p), F.lit(" "), F.lit(1))))) for f in found]
    return F.array_distinct(F.concat(*first, F.regexp_extract_all(html, F.lit(IMAGE_URL), F.lit(1))))


def images(df: DataFrame, html: str, base: str, exclude: str, dots: bool = True) -> DataFrame:
    """One row per different image with an image extension, without excluded ones."""
    rows = df.select("*", F.posexplode(image_urls(F.col(html))).alias("pos", "_u"))
    rows = rows.withColumn("image", U.canonical_url(F.col("_u"), F.col(base), dots)).drop("_u")
    return rows.where(F.col("image").rlike(r"(?i)\.(jpe?g|png|webp|gif|avif)(\?|$)") & ~F.col("image").rlike(exclude))


def cover(html: Column, exclude: str) -> Column:
    """og:image or twitter:image, else the first image that looks like a cover, else the first not excluded."""
    og = T.first_of(T.meta_content(html, "property", "og:image"), T.meta_content(html, "name", "twitter:image"))
    imgs = F.regexp_extract_all(html, F.lit(r"(?is)(<img\b[^>]*>)"), F.lit(1))
    src = lambda t: F.regexp_extract(t, r"""(?is)\bsrc\s*=\s*["']([^"']+)["']""", 1)
    ok = F.filter(imgs, lambda t: (src(t) != "") & ~t.rlike(exclude))
    like = F.filter(ok, lambda t: t.rlike("(?i)cover|poster|thumb"))
    return T.first_of(og, src(F.try_element_at(like, F.lit(1))), src(F.try_element_at(ok, F.lit(1))))


def catalog_links(df: DataFrame, key: str, html: str, work: str) -> DataFrame:
    """Links to works with title and cover; a cover outside the anchor is looked for in the 500 characters before it.

    Needs match offsets, so it runs in Arrow batches: (key, pos, href, title, cover).
    """
    kind = df.schema[key].dataType.simpleString()
    anchor = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']([^>]*)>(.{0,500}?)</a>""", re.I | re.S)
    img = re.compile(r"""<img\b[^>]*?\b(?:data-src|data-original|src)\s*=\s*["']([^"']+)["']""", re.I | re.S)
    titled, tag, wanted = re.compile(r"""\btitle\s*=\s*["']([^"']*)["']""", re.I), re.compile(r"<[^>]+>"), re.compile(work)

    def work_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for k, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for pos, m in enumerate(anchor.finditer(page or "")):
                    if not wanted.search(m[1]):
                        continue
                    t = titled.search(m[2])
                    inside = img.search(m[3])
                    before = None if inside else next(reversed(list(img.finditer(page, max(0, m.start() - 500), m.start()))), None)
                    c = inside or before
                    for col, v in zip(out, (k, pos, m[1], (t[1] if t else tag.sub("", m[3])).strip(), c[1] if c else None)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), pa.array(out[1], pa.int64()), *(pa.array(c, pa.string()) for c in out[2:])], names=[key, "pos", "href", "title", "cover"])

    return df.select(key, html).mapInArrow(work_batches, f"{key} {kind}, pos bigint, href string, title string, cover string")


def link_titles(df: DataFrame, html: str, base: str, *, work: str, skip: list[str], noise: str, dots: bool = True) -> DataFrame:
    """Titles of links to works: 2 to 60 characters, no skip word in the URL, no noise; beside the columns of ``df``."""
    rows = anchors(df, html, base, dots).where(F.col("url").rlike(work) & F.length("text").between(2, 60) & ~F.col("text").rlike(noise))
    return rows.where(~F.lower("url").rlike("|".join(map(re.escape, skip)))) if skip else rows


def selected_titles(html: Column, tag: str, attribute: str, holds: str) -> Column:
    """Texts of the elements ``tag[attribute*='holds']`` (the only kind of selector that occurs), as an array."""
    found = F.regexp_extract_all(html, F.lit(rf"""(?is)<{tag}\b[^>]*?\b{attribute}\s*=\s*["'][^"']*{re.escape(holds)}[^"']*["'][^>]*>(.*?)</{tag}>"""), F.lit(1))
    return F.filter(F.transform(found, T.clean_text), lambda t: F.length(t).between(2, 60))


def first_filled(*arrays: Column) -> Column:
    """First array that isn't empty (a cascade of ways to read a page)."""
    out = F.when(F.size(arrays[0]) > 0, arrays[0])
    for a in arrays[1:]:
        out = out.when(F.size(a) > 0, a)
    return F.coalesce(out, F.array().cast("array<string>"))


def work_links(html: Column, work: str) -> Column:
    """How many links to works a page holds; three make a ranking page."""
    return F.regexp_count(html, F.lit(work)).cast("bigint")


#: Compiled patterns a task holds (cleared when full).
MOST_PATTERNS = 10_000


def by_rule(df: DataFrame, key: str, html: str, pattern: str, groups: str) -> DataFrame:
    """Interpret extraction rules that rows carry: each row's own pattern and list of groups, tried in order.

    (key, pos, value): value is the first group of the list that took part in the match.
    """
    kind = df.schema[key].dataType.simpleString()

    def work_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, re.Pattern | None] = {}
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for k, page, p, gs in zip(*(c.to_pylist() for c in b.columns)):
                if p not in compiled:
                    if len(compiled) >= MOST_PATTERNS:
                        compiled.clear()
                    try:
                        compiled[p] = re.compile(p, re.S | re.I) if p else None
                    except re.error:
                        compiled[p] = None
                rx = compiled[p]
                for pos, m in enumerate(rx.finditer(page or "") if rx else ()):
                    v = next((m[g] for g in gs or [] if g <= (rx.groups) and m[g]), None)
                    if v is not None:
                        out[0].append(k), out[1].append(pos), out[2].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], names=[key, "pos", "value"])

    return df.select(key, html, pattern, groups).mapInArrow(work_batches, f"{key} {kind}, pos bigint, value string")


RULES = "array<struct<stage:string,pattern:string,url:array<int>,title:array<int>>>"


def by_stages(df: DataFrame, key: str, html: str, rules: str) -> DataFrame:
    """Interpret whole rules that rows carry (an array of ``RULES``): search items, chapters, images and next pages of one page.

    (key, stage, pos, url, title): url and title are the first groups of their lists that took part in the match (null if none did); a
    match without url gives no row, a pattern that can't be compiled no match.
    """
    kind = df.schema[key].dataType.simpleString()

    def work_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled: dict[str, re.Pattern | None] = {}
        first = lambda m, gs: next((m[g] for g in gs or () if g <= m.re.groups and m[g]), None)
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for k, page, stages in zip(*(c.to_pylist() for c in b.columns)):
                for stage in stages or ():
                    p = stage["pattern"]
                    if p not in compiled:
                        if len(compiled) >= MOST_PATTERNS:
                            compiled.clear()
                        try:
                            compiled[p] = re.compile(p, re.S | re.I) if p else None
                        except re.error:
                            compiled[p] = None
                    for pos, m in enumerate(compiled[p].finditer(page or "") if compiled[p] else ()):
                        if (url := first(m, stage["url"])) is not None:
                            for col, v in zip(out, (k, stage["stage"], pos, url, first(m, stage["title"]))):
                                col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], b.schema.field(0).type), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(out[4], pa.string())], names=[key, "stage", "pos", "url", "title"])

    return df.select(key, html, F.col(rules).cast(RULES)).mapInArrow(work_batches, f"{key} {kind}, stage string, pos bigint, url string, title string")
