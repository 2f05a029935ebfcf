"""The reference's relational operators as queries over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import text as T
from ..functions import urls as U
from ..runtime import table
from . import html as H
from . import relational as R
from . import vocab as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(q, words)) + "]"


def _any(col: str, words: list[str]) -> str:
    return f"regexp_matches({col}, {q(P.alternation(words))})"


_AUTH = r"'^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)'"


def _dom(c: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({c}, {_AUTH}, 1)), '^www\.', '')"


def _norm(c: str) -> str:
    return rf"regexp_replace(split_part(replace(replace(lower(trim({c})), 'https://', ''), 'http://', ''), '/', 1), '^www\.', '')"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+\z', '', 'g')"


def _unescape(c: str) -> str:
    for a, b in U.ENTITIES:
        c = f"replace({c}, {q(a)}, {q(b)})"
    return c


# ---- URLs -------------------------------------------------------------------------------------------------------


@query(f"SELECT ordinal, {_dom('url')} AS domain, CASE WHEN contains({_dom('url')}, '.') THEN {_dom('url')} ELSE '' END AS dotted, split_part(url, '#', 1) AS page FROM candidate")
def url_domain_of(spark, d):
    u = F.col("url")
    return table(spark, d, "candidate").select("ordinal", U.domain_of(u).alias("domain"), U.extract_domain(u).alias("dotted"), U.defragment(u).alias("page"))


_WS = "(CASE WHEN contains(trim({0}), '://') THEN trim({0}) ELSE 'https://' || trim({0}) END)".format("detail_url")


@query(rf"""SELECT audit_id, {_norm('domain')} AS bare,
 replace(split_part(replace(replace(lower(trim(domain)), 'https://', ''), 'http://', ''), '/', 1), 'www.', '') AS bare_anywhere,
 trim(replace(lower(CASE WHEN regexp_extract({_WS}, {_AUTH}, 1) <> '' THEN regexp_extract({_WS}, {_AUTH}, 1) ELSE regexp_extract({_WS}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)', 2) END), 'www.', ''), '/') AS host,
 lower(regexp_extract({_WS}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)', 2)) AS path,
 regexp_extract(detail_url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) AS base FROM page_audit""")
def url_normalize_variants(spark, d):
    p = table(spark, d, "page_audit")
    return p.select("audit_id", U.normalize_domain(F.col("domain")).alias("bare"), U.normalize_domain(F.col("domain"), True).alias("bare_anywhere"), U.host_of(F.col("detail_url")).alias("host"), U.path_of(F.col("detail_url")).alias("path"), U.base_of(F.col("detail_url")).alias("base"))


def _reg(c: str) -> str:
    n = f"len(string_split({c}, '.'))"
    last = lambda k: f"array_to_string(list_slice(string_split({c}, '.'), greatest({n} - {k - 1}, 1), {n}), '.')"
    hosted = " OR ".join(f"ends_with({c}, '.{s}')" for s in V.HOSTING)
    return rf"CASE WHEN regexp_matches({c}, '^\d{{1,3}}(\.\d{{1,3}}){{3}}$') THEN {c} WHEN {n} <= 2 THEN {c} WHEN {hosted} THEN {last(3)} ELSE {last(2)} END"


@query(f"SELECT ordinal, {_reg(_dom('url'))} AS registered, split_part({_reg(_dom('url'))}, '.', 1) AS label FROM candidate")
def url_registered_domain(spark, d):
    h = U.domain_of(F.col("url"))
    return table(spark, d, "candidate").select("ordinal", U.registered_domain(h, V.HOSTING).alias("registered"), U.domain_label(h, V.HOSTING).alias("label"))


@query(f"SELECT audit_id, {_dom('detail_url')} = {_norm('domain')} OR ends_with({_dom('detail_url')}, '.' || {_norm('domain')}) AS same_site FROM page_audit")
def url_same_site(spark, d):
    return table(spark, d, "page_audit").select("audit_id", U.same_site(F.col("detail_url"), U.normalize_domain(F.col("domain"))).alias("same_site"))


@query(rf"""WITH h AS (SELECT audit_id, base_url, CASE audit_id % 4 WHEN 0 THEN regexp_replace(detail_url, '^https?://[^/]*', '') WHEN 1 THEN regexp_replace(detail_url, '^https?:', '') WHEN 2 THEN ' ' || replace(detail_url, '/', '\/') ELSE detail_url || '&amp;x=1' END AS href FROM page_audit),
 c AS (SELECT audit_id, base_url, replace({_unescape('trim(href)')}, '\/', '/') AS u FROM h)
SELECT audit_id, CASE WHEN u = '' THEN '' WHEN starts_with(u, '//') THEN coalesce(nullif(regexp_extract(base_url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1), ''), 'https') || ':' || u
 WHEN coalesce(base_url, '') <> '' AND starts_with(u, '/') THEN regexp_extract(base_url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || u ELSE u END AS url FROM c""")
def url_canonical(spark, d):
    p = table(spark, d, "page_audit").select("audit_id", "base_url", "detail_url")
    k = F.col("audit_id") % 4
    href = F.when(k == 0, F.regexp_replace("detail_url", "^https?://[^/]*", "")).when(k == 1, F.regexp_replace("detail_url", "^https?:", "")).when(k == 2, F.concat(F.lit(" "), F.replace("detail_url", F.lit("/"), F.lit("\\/")))).otherwise(F.concat("detail_url", F.lit("&amp;x=1")))
    return p.select("audit_id", U.canonical_url(href, F.col("base_url"), dots=False).alias("url"))


@query(rf"""WITH p AS (SELECT audit_id, regexp_extract(detail_url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) AS root, string_split(regexp_extract(detail_url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/') AS xs, {_unescape("regexp_extract(detail_url, '([^/]+)/?$', 1)")} AS seg, detail_url FROM page_audit)
SELECT audit_id, CASE WHEN detail_url = '' THEN '../' WHEN detail_url IS NULL THEN NULL ELSE root || '/' || array_to_string(list_concat(list_slice(dirs, 1, len(dirs) - 1), [seg]), '/') END AS url FROM (SELECT *, list_filter(list_slice(xs, 2, len(xs) - 1), lambda s: s <> '') AS dirs FROM p)""")
def url_join_dots(spark, d):
    p = table(spark, d, "page_audit")
    return p.select("audit_id", U.canonical_url(F.concat(F.lit("../"), F.regexp_extract("detail_url", r"([^/]+)/?$", 1)), F.col("detail_url")).alias("url"))


@query("SELECT domain, replace(replace(replace(template, '{keyword}', 'moon+well'), '{page}', '2'), '{domain}', domain) AS url, 'q=' || replace(url_encode('moon well'), '%20', '+') || '&d=' || replace(url_encode(domain), '%20', '+') AS query FROM url_template")
def url_templates(spark, d):
    t = table(spark, d, "url_template")
    return t.select("domain", U.fill(F.col("template"), keyword=F.lit("moon+well"), page=F.lit("2"), domain=F.col("domain")).alias("url"), U.query_string(q=F.lit("moon well"), d=F.col("domain")).alias("query"))


@query("SELECT ordinal, url AS target FROM candidate")
def url_unwrap(spark, d):
    wrapped = F.concat(F.lit("https://r.example/l/?kh=1&uddg="), F.url_encode("url"), F.lit("&x=2#f"))
    return table(spark, d, "candidate").select("ordinal", U.unwrap(wrapped, "uddg").alias("target"))


@query("SELECT ordinal, CASE WHEN starts_with(u, '//') THEN 'https:' || u WHEN starts_with(u, '/') THEN 'https://h.example' || u ELSE u END AS url FROM (SELECT ordinal, CASE ordinal % 3 WHEN 0 THEN regexp_replace(url, '^https?:', '') WHEN 1 THEN regexp_replace(url, '^https?://[^/]*', '') ELSE url END AS u FROM candidate)")
def url_absolutize(spark, d):
    k = F.col("ordinal") % 3
    u = F.when(k == 0, F.regexp_replace("url", "^https?:", "")).when(k == 1, F.regexp_replace("url", "^https?://[^/]*", "")).otherwise(F.col("url"))
    return table(spark, d, "candidate").select("ordinal", U.absolutize(u, F.lit("h.example")).alias("url"))


# ---- text -------------------------------------------------------------------------------------------------------


def _clean(c: str) -> str:
    t = rf"regexp_replace({c}, '(?is)<script\b.*?</script>|<style\b.*?</style>', ' ', 'g')"
    t = _unescape(rf"regexp_replace({t}, '(?s)<[^>]+>', ' ', 'g')")
    return rf"trim(regexp_replace({t}, '[\s\x{{A0}}\x{{0B}}]+', ' ', 'g'))"


@query(f"SELECT doc_id, {_clean('text')} AS clean FROM documents")
def text_clean(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


@query(rf"""WITH a AS (SELECT ordinal, trim(regexp_replace(regexp_replace(title, '(?s)\s*#.*\z', ''), {q(V.TITLE_NOISE)}, '')) AS t, title FROM candidate),
 c1 AS (SELECT ordinal, title, CASE WHEN ends_with(t, '{V.TAG_WORDS[0]}') AND length(t) > {len(V.TAG_WORDS[0]) + 1} THEN trim(substr(t, 1, length(t) - {len(V.TAG_WORDS[0])})) ELSE t END AS t FROM a),
 c2 AS (SELECT ordinal, title, CASE WHEN ends_with(t, '{V.TAG_WORDS[1]}') AND length(t) > {len(V.TAG_WORDS[1]) + 1} THEN trim(substr(t, 1, length(t) - {len(V.TAG_WORDS[1])})) ELSE t END AS t FROM c1),
 c3 AS (SELECT ordinal, title, CASE WHEN ends_with(t, '{V.TAG_WORDS[2]}') AND length(t) > {len(V.TAG_WORDS[2]) + 1} THEN trim(substr(t, 1, length(t) - {len(V.TAG_WORDS[2])})) ELSE t END AS t FROM c2)
SELECT ordinal, t AS clean, trim(regexp_replace(regexp_replace(regexp_replace({_unescape('title')}, {q(V.TITLE_NOISE)}, ''), '[\r\n]+', ' ', 'g'), '\s{{2,}}', ' ', 'g')) AS catalog FROM c3""")
def text_clean_title(spark, d):
    c = table(spark, d, "candidate")
    return c.select("ordinal", T.clean_title(F.col("title"), r"(?s)\s*#.*\z", V.TITLE_NOISE, V.TAG_WORDS).alias("clean"), T.clean_catalog_title(F.col("title"), V.TITLE_NOISE).alias("catalog"))


@query(rf"""WITH t AS (SELECT audit_id, {_strip('substr(detail_title, 1, 48)')} AS a, {_strip('substr(first_chapter_title, 1, 48)')} AS b, domain FROM page_audit)
SELECT audit_id, coalesce(CASE WHEN length(a) >= 2 AND NOT regexp_matches(a, {q(V.PLACEHOLDER)}) THEN a END, CASE WHEN length(b) >= 2 AND NOT regexp_matches(b, {q(V.PLACEHOLDER)}) THEN b END, domain) AS name,
 coalesce({_strip('detail_title')}, '') AS safe, substr({_strip("split_part(detail_title, '-', 1)")}, 1, 30) AS short, coalesce(nullif(detail_title, ''), nullif(first_chapter_title, ''), '') AS first FROM (SELECT t.*, p.detail_title, p.first_chapter_title FROM t JOIN page_audit p ON p.audit_id = t.audit_id)""")
def text_rule_title(spark, d):
    p = table(spark, d, "page_audit")
    t, c = F.col("detail_title"), F.col("first_chapter_title")
    return p.select("audit_id", T.first_good([t, c], V.PLACEHOLDER, F.col("domain")).alias("name"), T.safe_str(t).alias("safe"), T.short_name(t).alias("short"), T.first_of(t, c).alias("first"))


_SAFE = "substr(CASE WHEN trim(regexp_replace(replace(lower({0}), 'www.', ''), '[^a-z0-9]+', '_', 'g'), '_') = '' THEN 'generated' ELSE trim(regexp_replace(replace(lower({0}), 'www.', ''), '[^a-z0-9]+', '_', 'g'), '_') END, 1, 40)".format("domain")


@query(f"SELECT audit_id, {_SAFE} || '_' || substr(sha1(detail_url), 1, 8) || '_auto_public' AS id, substr(sha256(detail_title), 1, 16) AS work FROM page_audit")
def id_safe_and_hash(spark, d):
    return table(spark, d, "page_audit").select("audit_id", T.safe_id(F.col("domain"), F.col("detail_url")).alias("id"), T.comic_id(F.col("detail_title")).alias("work"))


# ---- predicates -------------------------------------------------------------------------------------------------


_GUARD = f"regexp_matches(url, '^https?://') AND NOT regexp_matches(url, {q(V.EXCLUDE_URL)}) AND NOT list_contains({_list(V.EXCLUDED_HOSTS)}, host) AND NOT {_any('host', V.BLOCKED)}"
_CONTENT = f"({_GUARD} AND regexp_matches(url, {q('|'.join(f'(?:{w})' for w in V.WANTED_URL))}))"


@query(f"SELECT ordinal, {_CONTENT} AS content FROM (SELECT *, {_dom('url')} AS host FROM candidate)")
def pred_content_url(spark, d):
    u = F.col("url")
    return table(spark, d, "candidate").select("ordinal", _content(u).alias("content"))


def _content(u: Column) -> Column:
    return P.content_url(u, U.domain_of(u), exclude=V.EXCLUDE_URL, excluded_hosts=V.EXCLUDED_HOSTS, blocked=V.BLOCKED, wanted=V.WANTED_URL)


@query(rf"""SELECT ordinal, {_GUARD} AND (regexp_matches(url, '/comic/') OR {_CONTENT} OR ((host = dom OR ends_with(host, '.' || dom)) AND (regexp_matches(rest, '/list') OR (length(rest) - length(replace(rest, '/', '')) >= 2 AND NOT regexp_matches(rest, '(/|\.html?|\.php)$'))))) AS seed
FROM (SELECT *, {_dom('url')} AS host, {_reg(_dom('url'))} AS dom, regexp_replace(url, '^https?://[^/]*', '') AS rest FROM candidate)""")
def pred_seed_url(spark, d):
    u = F.col("url")
    h = U.domain_of(u)
    seed = P.seed_url(u, h, U.registered_domain(h, V.HOSTING), _content(u), exclude=V.EXCLUDE_URL, excluded_hosts=V.EXCLUDED_HOSTS, blocked=V.BLOCKED, work="/comic/", path="/list")
    return table(spark, d, "candidate").select("ordinal", seed.alias("seed"))


@query(f"""SELECT ordinal, list_filter({_list(V.BLOCKED)}, lambda t: contains(host, t))[1] AS token, list_contains({_list(V.EXCLUDED_HOSTS)}, host) OR {_any('host', V.BLOCKED)} OR {_any("host || path", V.PATH_TOKENS)} AS blocked,
 CAST(len(list_filter({_list(V.SECONDARY)}, lambda t: contains(lower(coalesce(snippet, '')), t))) AS BIGINT) AS hits
FROM (SELECT *, {_dom('url')} AS host, lower(regexp_replace(url, '^https?://[^/]*', '')) AS path FROM candidate)""")
def pred_blocked(spark, d):
    h, path = U.domain_of(F.col("url")), F.lower(F.regexp_replace("url", "^https?://[^/]*", ""))
    return table(spark, d, "candidate").select(
        "ordinal", P.first_hit(h, V.BLOCKED).alias("token"), P.blocked_url(h, path, excluded_hosts=V.EXCLUDED_HOSTS, blocked=V.BLOCKED, path_tokens=V.PATH_TOKENS).alias("blocked"), P.hits(F.lower(F.coalesce("snippet", F.lit(""))), V.SECONDARY).alias("hits")
    )


_CJK = r"[\x{4E00}-\x{9FFF}]"


@query(rf"""SELECT audit_id, length(t) >= 2 AND NOT regexp_matches(t, {q(V.PLACEHOLDER)}) AND NOT regexp_matches(t, '\{{\{{|\}}\}}|\$\{{|<%|%>') AND (regexp_matches(t, '{_CJK}') OR regexp_matches(t, '(?s)[A-Za-z].*[A-Za-z].*[A-Za-z]'))
 AND (NOT regexp_matches(t, {q(V.CHAPTER)}) OR regexp_matches(t, '{_CJK}{{2,}}.*(?:{V.CHAPTER})')) AND NOT list_contains({_list(V.BARE)}, lower(t)) AND NOT regexp_matches(t, '^{_CJK}{{1,2}}$') AS valid FROM (SELECT audit_id, detail_title AS t FROM page_audit)""")
def pred_title_valid(spark, d):
    return table(spark, d, "page_audit").select("audit_id", P.valid_title(F.col("detail_title"), placeholder=V.PLACEHOLDER, chapter_like=V.CHAPTER, bare=V.BARE).alias("valid"))


@query(rf"""SELECT audit_id, length(k) >= 2 AND NOT list_contains({_list(V.GENERIC)}, lower(k)) AND NOT regexp_matches(k, {q(V.NOISE_PREFIX)}) AND NOT regexp_matches(k, '^\d+\s') AND NOT regexp_matches(k, '^[\d\s\p{{P}}]+$') AND NOT regexp_matches(k, '[<>{{}}\[\]|\\^~`@#$%&*+=;:]') AS valid FROM (SELECT audit_id, evidence.keyword AS k FROM page_audit)""")
def pred_keyword_valid(spark, d):
    return table(spark, d, "page_audit").select("audit_id", P.valid_keyword(F.col("evidence.keyword"), generic=V.GENERIC, noise_prefix=V.NOISE_PREFIX).alias("valid"))


# a site check: ordered cascade over the site's name and what its hits say
_SITE = f"""site AS (SELECT host, lower(string_agg(coalesce(title, ''), ' ' ORDER BY ordinal)) AS titles, lower(string_agg(coalesce(snippet, ''), ' ' ORDER BY ordinal)) AS body, count(*) AS n
 FROM (SELECT *, {_dom('url')} AS host FROM candidate) GROUP BY host),
 hit AS (SELECT *, list_filter({_list(V.BLOCKED)}, lambda t: contains(host, t))[1] AS token, list_filter({_list(V.ANTI)}, lambda t: contains(body, t))[1] AS anti_hit, list_filter({_list(V.TITLE_WORDS)}, lambda t: contains(titles, t))[1] AS bad_title,
 list_filter({_list(V.VALIDATE)}, lambda t: contains(titles, t))[1] AS word, len(list_filter({_list(V.SECONDARY)}, lambda t: contains(body, t))) AS many, list_filter({_list(V.VALIDATE)}, lambda t: contains(host, t))[1] AS label FROM site),
 checked AS (SELECT host, CASE WHEN ends_with(host, '.test') THEN 'tld' WHEN token IS NOT NULL THEN 'token' WHEN n < 2 THEN 'unreachable' WHEN anti_hit IS NOT NULL THEN 'anti' WHEN bad_title IS NOT NULL THEN 'title' WHEN word IS NOT NULL THEN 'validate' WHEN many >= 2 THEN 'secondary' WHEN label IS NOT NULL THEN 'label' ELSE 'no_indicators' END AS verdict,
 CASE WHEN ends_with(host, '.test') THEN 'test' WHEN token IS NOT NULL THEN token WHEN n < 2 THEN '' WHEN anti_hit IS NOT NULL THEN anti_hit WHEN bad_title IS NOT NULL THEN bad_title WHEN word IS NOT NULL THEN word WHEN many >= 2 THEN '' WHEN label IS NOT NULL THEN label ELSE '' END AS matched FROM hit)"""


def _sites(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "candidate").select("ordinal", U.domain_of(F.col("url")).alias("host"), F.lower(F.coalesce("title", F.lit(""))).alias("t"), F.lower(F.coalesce("snippet", F.lit(""))).alias("s"))
    # only which words stand anywhere in a site's texts matters, so flags are combined before the shuffle, not texts gathered
    some = lambda c, words, name: [F.bool_or(F.contains(c, F.lit(w))).alias(f"{name}{i}") for i, w in enumerate(words)]
    t, s = F.col("t"), F.col("s")
    g = c.groupBy("host").agg(F.count("*").alias("n"), *some(s, V.ANTI, "a"), *some(t, V.TITLE_WORDS, "b"), *some(t, V.VALIDATE, "v"), *some(s, V.SECONDARY, "z"))
    first = lambda words, name: F.coalesce(*(F.when(F.col(f"{name}{i}"), w) for i, w in enumerate(words)))
    many = sum((F.col(f"z{i}").cast("int") for i in range(len(V.SECONDARY))), F.lit(0))
    h = F.col("host")
    token, anti, bad, word, label = P.first_hit(h, V.BLOCKED), first(V.ANTI, "a"), first(V.TITLE_WORDS, "b"), first(V.VALIDATE, "v"), P.first_hit(h, V.VALIDATE)
    steps = [(F.endswith(h, F.lit(".test")), "tld", F.lit("test")), (token.isNotNull(), "token", token), (F.col("n") < 2, "unreachable", F.lit("")), (anti.isNotNull(), "anti", anti), (bad.isNotNull(), "title", bad), (word.isNotNull(), "validate", word), (many >= 2, "secondary", F.lit("")), (label.isNotNull(), "label", label)]
    return g.select("host", P.cascade(*((c, v) for c, v, _ in steps), otherwise="no_indicators").alias("verdict"), P.cascade(*((c, m) for c, _, m in steps), otherwise="").alias("matched"))


@query(f"WITH {_SITE} SELECT host, verdict, matched FROM checked")
def site_classify(spark, d):
    return _sites(spark, d)


_BUCKET = "CASE WHEN verdict IN ('validate', 'secondary', 'label') THEN 'kept' WHEN verdict = 'unreachable' THEN 'network_issue' WHEN verdict IN ('anti', 'title') THEN verdict ELSE 'no_indicators' END"


@query(f"WITH {_SITE} SELECT {_BUCKET} AS bucket, verdict, count(*) AS sites FROM checked GROUP BY ALL")
def site_reasons(spark, d):
    v = F.col("verdict")
    bucket = F.when(v.isin("validate", "secondary", "label"), "kept").when(v == "unreachable", "network_issue").when(v.isin("anti", "title"), v).otherwise("no_indicators")
    return _sites(spark, d).groupBy(bucket.alias("bucket"), "verdict").agg(F.count("*").alias("sites"))


@query(f"WITH {_SITE} SELECT matched, verdict, host FROM checked WHERE matched <> ''")
def site_keyword_domains(spark, d):
    return _sites(spark, d).where("matched <> ''").select("matched", "verdict", "host")


def _category_sql(c: str) -> str:
    steps = [f"WHEN {_any(c, kws)} THEN {q(name)}" for name, kws in V.CATEGORIES] + [f"WHEN {_any(c, kws)} THEN {q(cat)}" for _, kws, cat in V.TAGS if cat]
    return "CASE " + " ".join(steps) + " ELSE '' END"


def _category(t: Column) -> Column:
    low = F.lower(t)
    return P.cascade(*((P.contains_any(low, kws), name) for name, kws in V.CATEGORIES), *((P.contains_any(low, kws), cat) for _, kws, cat in V.TAGS if cat), otherwise="")


@query(f"SELECT audit_id, {_category_sql('lower(detail_title)')} AS category FROM page_audit")
def title_classify(spark, d):
    return table(spark, d, "page_audit").select("audit_id", _category(F.col("detail_title")).alias("category"))


_TEMPLATE = "CASE " + " ".join(f"WHEN contains(domain, {q(w)}) THEN {q(t)}" for w, t in V.PATTERNS) + f" ELSE {q(V.DEFAULT_TEMPLATE)} END"
_PATHS = "CASE " + " ".join(f"WHEN contains(domain, {q(w)}) THEN {q(','.join(p))}" for w, p in V.SEED_PATHS) + " ELSE '/' END"


@query(f"SELECT domain, replace({_TEMPLATE}, '{{domain}}', domain) AS template, {_PATHS} AS paths FROM url_template")
def pattern_template(spark, d):
    h = F.col("domain")
    t = P.cascade(*((F.contains(h, F.lit(w)), t) for w, t in V.PATTERNS), otherwise=V.DEFAULT_TEMPLATE)
    p = P.cascade(*((F.contains(h, F.lit(w)), F.array_join(F.array(*map(F.lit, ps)), ",")) for w, ps in V.SEED_PATHS), otherwise="/")
    return table(spark, d, "url_template").select("domain", U.fill(t, domain=h).alias("template"), p.alias("paths"))


# ---- HTML -------------------------------------------------------------------------------------------------------

_PAGE_SQL = """(SELECT audit_id, base_url, '<html><head><title>' || coalesce(detail_title, '') || '</title><meta property="og:image" content="' || coalesce(cover_url, '') || '"><style>a{}</style></head><body><h1>' || coalesce(detail_title, '')
 || '</h1><a href="' || coalesce(replace(first_chapter_url, base_url, ''), '') || '">' || coalesce(first_chapter_title, '') || '</a><a class="x" href="' || coalesce(detail_url, '') || '"><b>more</b></a><a href="/list">Free list</a><img class="cover" src="' || coalesce(cover_url, '') || '"><img data-src="' || coalesce(first_image_url, '') || '"></body></html>' AS html FROM page_audit)"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """One HTML page per audit, made of its fields (stands in for fetched pages)."""
    s = lambda c: F.coalesce(c, F.lit(""))
    f = F.col
    return table(spark, d, "page_audit").select(
        "audit_id", "base_url",
        F.concat(F.lit("<html><head><title>"), s(f("detail_title")), F.lit('</title><meta property="og:image" content="'), s(f("cover_url")), F.lit('"><style>a{}</style></head><body><h1>'), s(f("detail_title")), F.lit('</h1><a href="'),
                 s(F.replace(f("first_chapter_url"), f("base_url"), F.lit(""))), F.lit('">'), s(f("first_chapter_title")), F.lit('</a><a class="x" href="'), s(f("detail_url")), F.lit('"><b>more</b></a><a href="/list">Free list</a><img class="cover" src="'),
                 s(f("cover_url")), F.lit('"><img data-src="'), s(f("first_image_url")), F.lit('"></body></html>')).alias("html"),
    )


@query(f"""SELECT audit_id, coalesce(nullif(substr({_clean("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, 1, 120), ''), nullif(substr({_clean("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, 1, 120), ''), substr({_clean('html')}, 1, 80)) AS title,
 regexp_extract(html, '(?is)<meta[^>]*property="og:image"[^>]*content="([^"]*)"', 1) AS image FROM {_PAGE_SQL}""")
def html_title_meta(spark, d):
    h = F.col("html")
    return _pages(spark, d).select("audit_id", T.meta_title(h).alias("title"), T.meta_content(h, "property", "og:image").alias("image"))


_ANCHORS = f"""(SELECT audit_id, base_url, CAST(i - 1 AS BIGINT) AS pos, href[i] AS href, body[i] AS body FROM (SELECT *, unnest(range(1, len(href) + 1)) AS i FROM
 (SELECT audit_id, base_url, regexp_extract_all(html, {q(H.ANCHOR)}, 1) AS href, regexp_extract_all(html, {q(H.ANCHOR)}, 2) AS body FROM {_PAGE_SQL})))"""
_ABS = r"CASE WHEN u = '' THEN '' WHEN starts_with(u, '//') THEN 'https:' || u WHEN coalesce(base_url, '') <> '' AND starts_with(u, '/') THEN regexp_extract(base_url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || u ELSE u END"
_LINKS = f"(SELECT audit_id, base_url, pos, {_ABS} AS url, {_clean('body')} AS text FROM (SELECT *, replace({_unescape('trim(href)')}, '\\/', '/') AS u FROM {_ANCHORS}))"


@query(f"SELECT audit_id, pos, url, text FROM {_LINKS}")
def links_explode(spark, d):
    return H.anchors(_pages(spark, d), "html", "base_url", dots=False).select("audit_id", F.col("pos").cast("bigint").alias("pos"), "url", "text")


@query(f"""WITH l AS (SELECT audit_id, pos, split_part(url, '#', 1) AS url, text FROM {_LINKS}),
 k AS (SELECT * FROM l WHERE NOT regexp_matches(url, {q(V.EXCLUDE_URL)}) AND (regexp_matches(text, {q(V.CHAPTER)}) OR regexp_matches(url, {q(V.CHAPTER)})) AND NOT (regexp_matches(text, 'Free') AND NOT regexp_matches(text, {q(V.CHAPTER)})) AND url <> ''),
 o AS (SELECT *, row_number() OVER (PARTITION BY audit_id, url ORDER BY pos) AS rn FROM k)
SELECT audit_id, url, CASE WHEN text = '' THEN regexp_extract(url, '([^/]+)/?$', 1) ELSE text END AS text, row_number() OVER (PARTITION BY audit_id ORDER BY pos) AS rank FROM o WHERE rn = 1""")
def html_chapters(spark, d):
    c = H.chapters(_pages(spark, d), "audit_id", "html", "base_url", chapter=V.CHAPTER, noise="Free", exclude=V.EXCLUDE_URL, dots=False)
    return c.select("audit_id", "url", "text", F.col("rank").cast("bigint").alias("rank"))


@query("SELECT audit_id, image, row_number() OVER (PARTITION BY audit_id ORDER BY k) AS n FROM (SELECT audit_id, first_image_url AS image, 2 AS k FROM page_audit WHERE first_image_url IS DISTINCT FROM cover_url UNION ALL SELECT audit_id, cover_url, 1 FROM page_audit) WHERE image IS NOT NULL AND regexp_matches(image, '(?i)\\.(jpe?g|png|webp|gif|avif)(\\?|$)')")
def html_images(spark, d):
    rows = H.images(_pages(spark, d), "html", "base_url", r"(?i)logo|avatar", dots=False)
    return rows.select("audit_id", "image", F.row_number().over(Window.partitionBy("audit_id").orderBy("pos")).cast("bigint").alias("n"))


@query("SELECT audit_id, coalesce(nullif(cover_url, ''), nullif(first_image_url, ''), '') AS cover FROM page_audit")
def html_cover(spark, d):
    return _pages(spark, d).select("audit_id", H.cover(F.col("html"), r"(?i)logo|avatar").alias("cover"))


@query(f"""WITH l AS (SELECT audit_id, unnest(regexp_extract_all(html, '(?i)\\b(?:href|src)\\s*=\\s*["'']?(https?://[^\\s"''<>]+)', 1)) AS url FROM {_PAGE_SQL})
SELECT {_dom('url')} AS host, count(*) AS links, count(DISTINCT url) AS pages FROM l WHERE NOT {_any('lower(url)', V.SKIP_LINKS)} GROUP BY 1""")
def page_outlink_counts(spark, d):
    rows = H.outlinks(_pages(spark, d), "html", V.SKIP_LINKS)
    return rows.groupBy(U.domain_of(F.col("url")).alias("host")).agg(F.count("*").alias("links"), F.countDistinct("url").alias("pages"))


_CATALOG = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']([^>]*)>(.{0,500}?)</a>"""


@query(f"""WITH a AS (SELECT audit_id, regexp_extract_all(html, {q(_CATALOG)}, 1) AS href, regexp_extract_all(html, {q(_CATALOG)}, 3) AS body FROM {_PAGE_SQL}), l AS (SELECT *, unnest(range(1, len(href) + 1)) AS i FROM a)
SELECT audit_id, i - 1 AS pos, href[i] AS href, {_strip("regexp_replace(body[i], '<[^>]+>', '', 'g')")} AS title, CAST(NULL AS VARCHAR) AS cover FROM l WHERE regexp_matches(href[i], '/(?:comic|series|title|book|manga|manhua)/')""")
def html_catalog_links(spark, d):
    return H.catalog_links(_pages(spark, d), "audit_id", "html", r"/(?:comic|series|title|book|manga|manhua)/")


#: Kinds of rules: pattern, groups in order.
_RULES = [(r"""<a[^>]*href="([^"]*)"[^>]*>(?:<b>)?([^<]*)""", [2, 1]), (r"""<img[^>]*?(?:data-src|src)="([^"]*)\"""", [1]), (r"""<(h1|title)>([^<]*)</""", [2])]


def _ruled(kind: int) -> str:
    pattern, groups = _RULES[kind]
    found = ", ".join(f"regexp_extract_all(html, {q('(?is)' + pattern)}, {g}) AS g{g}" for g in groups)
    return f"SELECT audit_id, i - 1 AS pos, coalesce({', '.join(f'nullif(g{g}[i], {chr(39) * 2})' for g in groups)}) AS value FROM (SELECT *, unnest(range(1, len(g{groups[0]}) + 1)) AS i FROM (SELECT audit_id, {found} FROM {_PAGE_SQL} WHERE audit_id % 3 = {kind}))"


@query("SELECT * FROM (" + " UNION ALL ".join(map(_ruled, range(3))) + ") WHERE value IS NOT NULL")
def html_by_rule(spark, d):
    # each row's rule names the row, as rules of sites name their site, and is one of three kinds
    kind = F.col("audit_id") % 3
    pick = lambda values: F.when(kind == 0, values[0]).when(kind == 1, values[1]).otherwise(values[2])
    pattern = F.concat(F.lit("(?#rule "), F.col("audit_id").cast("string"), F.lit(")"), pick([F.lit(p) for p, _ in _RULES]))
    rows = _pages(spark, d).withColumn("pattern", pattern).withColumn("groups", pick([F.array(*map(F.lit, g)) for _, g in _RULES]))
    return H.by_rule(rows, "audit_id", "html", "pattern", "groups")


#: Stages of a site's rule: pattern, groups of the url and of the title.
_STAGES = {
    "search": (r"""<a[^>]*href="([^"]*/(?:comic|series|title|book|manga)/[^"]*)"[^>]*>(?:<b>)?([^<]*)""", [1], [2]), "detail": (r"""<a[^>]*href="([^"]*/chapter/[^"]*)"[^>]*>([^<]*)""", [1], [2]),
    "reader": (r"""<img[^>]*?(?:data-src="([^"]*)"|src="([^"]*)")""", [1, 2], []), "next": (r"""<a[^>]*href="([^"]*)"[^>]*>Free""", [1], []),
}


def _staged(stage: str) -> str:
    pattern, url, title = _STAGES[stage]
    found = ", ".join(f"regexp_extract_all(html, {q('(?is)' + pattern)}, {g}) AS g{g}" for g in [*url, *title])
    pick = lambda gs: f"coalesce({', '.join(f'nullif(g{g}[i], {chr(39) * 2})' for g in gs)})" if gs else "CAST(NULL AS VARCHAR)"
    return f"SELECT audit_id, '{stage}' AS stage, i - 1 AS pos, {pick(url)} AS url, {pick(title)} AS title FROM (SELECT *, unnest(range(1, len(g{url[0]}) + 1)) AS i FROM (SELECT audit_id, {found} FROM {_PAGE_SQL}))"


@query("SELECT * FROM (" + " UNION ALL ".join(map(_staged, _STAGES)) + ") WHERE url IS NOT NULL")
def html_rule_stages(spark, d):
    # each row carries the whole rule of its site, named after the row
    name = F.concat(F.lit("(?#rule "), F.col("audit_id").cast("string"), F.lit(")"))
    ints = lambda gs: F.array(*map(F.lit, gs)).cast("array<int>")
    rules = F.array(*(F.struct(F.lit(s).alias("stage"), F.concat(name, F.lit(p)).alias("pattern"), ints(u).alias("url"), ints(t).alias("title")) for s, (p, u, t) in _STAGES.items()))
    return H.by_stages(_pages(spark, d).withColumn("rules", rules), "audit_id", "html", "rules")


@query("SELECT run_id, CAST(n - 1 AS INTEGER) AS step, audit_id FROM (SELECT run_id, audit_id, row_number() OVER (PARTITION BY run_id ORDER BY audit_id) AS n FROM page_audit WHERE run_id IS NOT NULL) WHERE n <= 6")
def next_page_chain(spark, d):
    # a run's audits stand in for the pages of a chapter: each links to the next one
    p = table(spark, d, "page_audit").where("run_id is not null").select("run_id", "audit_id")
    at = R.numbered(p, [F.col("run_id"), F.col("audit_id")], "at")  # no task holds a whole run
    links = at.join(at.select("run_id", (F.col("at") - 1).alias("at"), F.col("audit_id").alias("next")), ["run_id", "at"]).select("audit_id", "next")
    return R.follow(p.groupBy("run_id").agg(F.min("audit_id").alias("audit_id")), links, "run_id", "audit_id", "next", 6)


# ---- expansion --------------------------------------------------------------------------------------------------


@query("""WITH kw AS (SELECT evidence.keyword AS keyword, min(audit_id) AS ord FROM page_audit WHERE evidence.keyword IS NOT NULL AND evidence.keyword <> '' GROUP BY 1),
 k AS (SELECT keyword, row_number() OVER (ORDER BY ord) AS kn FROM kw), s AS (SELECT domain, row_number() OVER (ORDER BY domain) AS dn FROM url_template WHERE template IS NOT NULL QUALIFY dn <= 10),
 v AS (SELECT kn, 0 AS dn, unnest([0, 1]) AS vn, keyword, NULL AS domain FROM k UNION ALL SELECT kn, dn, 2, keyword, domain FROM k, s)
SELECT CASE vn WHEN 0 THEN keyword WHEN 1 THEN keyword || ' online' ELSE keyword || ' site:' || domain END AS query, kn AS keyword_no FROM v""")
def queries_expand(spark, d):
    p = table(spark, d, "page_audit").select(F.col("evidence.keyword").alias("keyword"), "audit_id").where("keyword <> ''")
    k = R.numbered(p.groupBy("keyword").agg(F.min("audit_id").alias("ord")), "ord", "kn")
    # each keyword is searched in the first ten sites (the operator's own limit), so its rows are twelve
    s = table(spark, d, "url_template").where("template is not null").select("domain").orderBy("domain").limit(10).agg(F.collect_list("domain").alias("ds"))
    forms = F.concat(F.array(F.col("keyword"), F.concat("keyword", F.lit(" online"))), F.transform("ds", lambda x: F.concat(F.col("keyword"), F.lit(" site:"), x)))
    return k.join(F.broadcast(s)).select(F.explode(forms).alias("query"), F.col("kn").cast("bigint").alias("keyword_no"))


@query("""SELECT domain, CASE WHEN contains(template, '{page}') THEN replace(template, '{page}', CAST(p AS VARCHAR)) ELSE template END AS url, CAST(p AS BIGINT) AS page
FROM (SELECT domain, template, unnest(CASE WHEN contains(template, '{page}') THEN range(1, 6) ELSE [0] END) AS p FROM url_template WHERE template IS NOT NULL)""")
def ranking_expand(spark, d):
    t = table(spark, d, "url_template").where("template is not null")
    paged = F.contains("template", F.lit("{page}"))
    rows = t.select("domain", "template", F.explode(F.when(paged, F.sequence(F.lit(1), F.lit(5))).otherwise(F.array(F.lit(0)))).alias("p"))
    return rows.select("domain", F.when(paged, F.replace("template", F.lit("{page}"), F.col("p").cast("string"))).otherwise(F.col("template")).alias("url"), F.col("p").cast("bigint").alias("page"))


@query(f"""WITH r AS (SELECT lower(r_name) AS w, r_regionkey AS k FROM region), m AS (SELECT unnest({_list(V.MODIFIERS)}) AS m, unnest(range(1, {len(V.MODIFIERS) + 1})) AS mn),
 a AS (SELECT w AS term, 0 AS b, k, 0 AS mn FROM r UNION ALL SELECT w || ' ' || m, 1, k, mn FROM r, m UNION ALL SELECT lower(n_name), 2, n_nationkey, 0 FROM nation)
SELECT term, row_number() OVER (ORDER BY b, k, mn) AS place FROM (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY term ORDER BY b, k, mn) = 1)""")
def seed_terms(spark, d):
    r = table(spark, d, "region").select(F.lower("r_name").alias("w"), F.col("r_regionkey").alias("k"))
    base = r.select(F.col("w").alias("term"), F.lit(0).alias("b"), "k", F.lit(0).alias("mn"))
    mods = r.select("w", "k", F.posexplode(F.array(*map(F.lit, V.MODIFIERS))).alias("mn", "m")).select(F.concat_ws(" ", "w", "m").alias("term"), F.lit(1).alias("b"), "k", (F.col("mn") + 1).alias("mn"))
    nat = table(spark, d, "nation").select(F.lower("n_name").alias("term"), F.lit(2).alias("b"), F.col("n_nationkey").alias("k"), F.lit(0).alias("mn"))
    first = base.unionByName(mods).unionByName(nat).groupBy("term").agg(F.min(F.struct("b", "k", "mn")).alias("o"))
    return first.select("term", F.row_number().over(Window.orderBy("o")).cast("bigint").alias("place"))


# ---- windows and dedupe -----------------------------------------------------------------------------------------


@query("SELECT page, ordinal, engine, title FROM (SELECT *, split_part(url, '#', 1) AS page, row_number() OVER (PARTITION BY split_part(url, '#', 1) ORDER BY ordinal) AS rn FROM candidate WHERE url IS NOT NULL AND split_part(url, '#', 1) <> '') WHERE rn = 1")
def candidate_dedupe(spark, d):
    c = table(spark, d, "candidate").select(U.defragment(F.col("url")).alias("page"), "ordinal", "engine", "title")
    return R.first_wins(c, ["page"], "ordinal")


@query(f"SELECT ordinal, host FROM (SELECT ordinal, host, row_number() OVER (PARTITION BY host ORDER BY ordinal) AS rn FROM (SELECT ordinal, {_dom('url')} AS host FROM candidate)) WHERE rn <= 5")
def arrival_caps(spark, d):
    c = table(spark, d, "candidate").select("ordinal", U.domain_of(F.col("url")).alias("host"))
    return R.arrival_cap(c, ["host"], "ordinal", 5)


@query("SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 300")
def global_cap(spark, d):
    return R.global_cap(table(spark, d, "events").select("event_id", "user_id", "event_type"), "event_id", 300)


_PRIO = "list_position(" + _list(V.ENGINES) + ", engine)"


@query(f"""WITH c AS (SELECT run_id, {_PRIO} AS prio, ordinal, split_part(url, '#', 1) AS page FROM candidate WHERE {_PRIO} IS NOT NULL),
 capped AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY run_id, prio ORDER BY ordinal) <= 8),
 one AS (SELECT * FROM capped QUALIFY row_number() OVER (PARTITION BY run_id, page ORDER BY prio, ordinal) = 1)
SELECT run_id, page, CAST(prio AS BIGINT) AS prio, ordinal, place FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY prio, ordinal) AS place FROM one) WHERE place <= 12""")
def engine_merge_topup(spark, d):
    prio = F.nullif(F.array_position(F.array(*map(F.lit, V.ENGINES)), F.col("engine")), F.lit(0))
    c = table(spark, d, "candidate").select("run_id", prio.alias("prio"), "ordinal", U.defragment(F.col("url")).alias("page")).where("prio is not null")
    return R.cascade_fill(c, "run_id", "prio", "ordinal", "page", 12, F.lit(8)).select("run_id", "page", F.col("prio").cast("bigint").alias("prio"), "ordinal", F.col("place").cast("bigint").alias("place"))


@query("""SELECT ordinal, run_id, engine FROM (SELECT *, count(*) FILTER (engine = 'seekra') OVER (PARTITION BY run_id) AS n FROM candidate) WHERE engine = 'seekra' OR (engine = 'tidepool_html' AND n < 3)""")
def second_source_if_short(spark, d):
    c = table(spark, d, "candidate").select("ordinal", "run_id", "engine").where("engine in ('seekra', 'tidepool_html')")
    n = F.sum((F.col("engine") == "seekra").cast("int")).over(Window.partitionBy("run_id"))
    return c.withColumn("n", n).where("engine = 'seekra' or n < 3").drop("n")


@query("""WITH e AS (SELECT user_id, event_id, CAST(event_type IN ('error', 'click') AS INT) AS bad FROM events),
 i AS (SELECT *, sum(1 - bad) OVER (PARTITION BY user_id ORDER BY event_id) AS isle FROM e), r AS (SELECT *, sum(bad) OVER (PARTITION BY user_id, isle ORDER BY event_id) AS run FROM i),
 s AS (SELECT *, min(CASE WHEN run >= 3 THEN event_id END) OVER (PARTITION BY user_id) AS stop FROM r) SELECT user_id, event_id FROM s WHERE stop IS NULL OR event_id <= stop""")
def streak_cut(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    return R.streak_cut(e, ["user_id"], "event_id", F.col("event_type").isin("error", "click"), 3).select("user_id", "event_id")


_SCORE = "(CASE status WHEN 'native_scroll_ok' THEN 1000 WHEN 'render_fallback_needed' THEN 500 ELSE 0 END) + 3 * coalesce(static_image_count, 0) + coalesce(chapter_count, 0)"


@query(f"""WITH a AS (SELECT {_norm('domain')} AS host, detail_url, {_SCORE} AS score, audit_id, chapter_count, static_image_count FROM page_audit WHERE status <> 'excluded_login_or_pay' AND domain IS NOT NULL),
 u AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY host, detail_url ORDER BY score DESC, audit_id) = 1)
SELECT host, detail_url, CAST(score AS BIGINT) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY score DESC, audit_id) AS rank FROM u) WHERE rank <= 3""")
def best_per_domain(spark, d):
    status = F.when(F.col("status") == "native_scroll_ok", 1000).when(F.col("status") == "render_fallback_needed", 500).otherwise(0)
    score = (status + 3 * F.coalesce("static_image_count", F.lit(0)) + F.coalesce("chapter_count", F.lit(0))).cast("bigint")
    a = table(spark, d, "page_audit").where("status <> 'excluded_login_or_pay' and domain is not null").select(U.normalize_domain(F.col("domain")).alias("host"), "detail_url", score.alias("score"), "audit_id")
    one = a.groupBy("host", "detail_url").agg(F.min(F.struct(-F.col("score"), "audit_id")).alias("o")).select("host", "detail_url", (-F.col("o.col1")).alias("score"), "o.audit_id")
    return R.top_k(one, ["host"], [F.desc("score"), F.col("audit_id")], 3).select("host", "detail_url", "score", F.col("rank").cast("bigint").alias("rank"))


@query("""SELECT l_suppkey, l_orderkey, l_linenumber, rank FROM (SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank FROM lineitem) WHERE rank <= 5""")
def top_lines_per_supplier(spark, d):
    l = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_extendedprice")
    return R.top_k(l, ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 5).select("l_suppkey", "l_orderkey", "l_linenumber", F.col("rank").cast("bigint").alias("rank"))


# ---- aggregates -------------------------------------------------------------------------------------------------

_STATS = f"""g AS (SELECT {_norm('domain')} AS host, 1 AS gen, CAST(coalesce(contains(status, 'ok') OR contains(status, 'fallback'), false) AS INT) AS ok, 0 AS seed, 0 AS bad FROM page_audit WHERE status IS DISTINCT FROM 'excluded_login_or_pay' AND domain IS NOT NULL),
 x AS (SELECT {_norm('domain')} AS host, 0 AS gen, 0 AS ok, 0 AS seed, 0 AS bad FROM page_audit WHERE status = 'excluded_login_or_pay' AND domain IS NOT NULL),
 s AS (SELECT coalesce(nullif(targetdomain, ''), {_dom('seedurl')}) AS host, 0 AS gen, 0 AS ok, 1 AS seed, CAST(status = 'fetch_failed' AS INT) AS bad FROM seed_page_stat),
 st AS (SELECT host, CAST(sum(gen) AS BIGINT) AS generated, CAST(sum(ok) AS BIGINT) AS ok, CAST(sum(gen - ok) AS BIGINT) AS failed, CAST(sum(ex) AS BIGINT) AS excluded, CAST(sum(seed) AS BIGINT) AS seeds_total, CAST(sum(bad) AS BIGINT) AS seeds_failed
 FROM (SELECT *, 0 AS ex FROM g UNION ALL SELECT *, 1 FROM x UNION ALL SELECT *, 0 FROM s) GROUP BY host)"""


def _stats(spark: SparkSession, d: str) -> DataFrame:
    z = F.lit(0)
    p = table(spark, d, "page_audit").where("domain is not null")
    out = F.coalesce(F.col("status") == "excluded_login_or_pay", F.lit(False))
    ok = F.coalesce(F.contains("status", F.lit("ok")) | F.contains("status", F.lit("fallback")), F.lit(False))
    a = p.select(U.normalize_domain(F.col("domain")).alias("host"), (~out).cast("int").alias("g"), (~out & ok).cast("int").alias("k"), out.cast("int").alias("x"), z.alias("t"), z.alias("b"))
    s = table(spark, d, "seed_page_stat").select(F.coalesce(F.nullif("targetdomain", F.lit("")), U.domain_of(F.col("seedurl"))).alias("host"), z.alias("g"), z.alias("k"), z.alias("x"), F.lit(1).alias("t"), (F.col("status") == "fetch_failed").cast("int").alias("b"))
    sums = {"generated": "g", "ok": "k", "excluded": "x", "seeds_total": "t", "seeds_failed": "b"}
    g = a.unionByName(s).groupBy("host").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    return g.withColumn("failed", F.col("generated") - F.col("ok"))


@query(f"WITH {_STATS} SELECT * FROM st")
def domain_stats(spark, d):
    return _stats(spark, d)


_DEAD = "CASE WHEN generated = 0 AND seeds_total > 0 THEN CASE WHEN seeds_failed / seeds_total >= 0.5 THEN 'all_seeds_failed (' || seeds_failed || '/' || seeds_total || ')' END WHEN generated > 0 AND ok = 0 AND excluded = 0 THEN 'all_failed (' || generated || ')' WHEN generated = 0 AND excluded > 0 AND ok = 0 THEN 'all_excluded_login_pay (excluded:' || excluded || ')' END"


def _dead(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    text = lambda *p: F.concat(*(x if isinstance(x, Column) else F.lit(x) for x in p))
    reason = (
        F.when((c("generated") == 0) & (c("seeds_total") > 0), F.when(c("seeds_failed") / c("seeds_total") >= 0.5, text("all_seeds_failed (", c("seeds_failed").cast("string"), "/", c("seeds_total").cast("string"), ")")))
        .when((c("generated") > 0) & (c("ok") == 0) & (c("excluded") == 0), text("all_failed (", c("generated").cast("string"), ")"))
        .when((c("generated") == 0) & (c("excluded") > 0) & (c("ok") == 0), text("all_excluded_login_pay (excluded:", c("excluded").cast("string"), ")"))
    )
    measured = _stats(spark, d).withColumn("reason", reason)
    absent = table(spark, d, "url_template").select(F.col("domain").alias("host")).distinct().join(measured, "host", "left_anti").withColumn("reason", F.lit("not_in_report"))
    return measured.where("reason is not null").select("host", "reason").unionByName(absent.select("host", "reason"))


_DEAD_CTE = f"{_STATS}, dead AS (SELECT host, reason FROM (SELECT host, {_DEAD} AS reason FROM st) WHERE reason IS NOT NULL UNION ALL SELECT DISTINCT domain, 'not_in_report' FROM url_template WHERE domain NOT IN (SELECT host FROM st WHERE host IS NOT NULL))"


@query(f"WITH {_DEAD_CTE} SELECT host, reason FROM dead")
def dead_domains(spark, d):
    return _dead(spark, d)


@query(f"WITH {_DEAD_CTE}, m AS (SELECT split_part(reason, ' ', 1) AS reason, host FROM dead) SELECT reason, host, count(*) OVER (PARTITION BY reason) AS sites FROM m")
def removed_by_reason(spark, d):
    m = _dead(spark, d).select(F.split_part("reason", F.lit(" "), F.lit(1)).alias("reason"), "host")
    sizes = m.groupBy("reason").agg(F.count("*").alias("sites"))  # four reasons
    return m.join(F.broadcast(sizes), "reason").select("reason", "host", "sites")


@query(f"""WITH {_DEAD_CTE}, kept AS (SELECT domain AS host, 0 AS branch FROM url_template WHERE domain NOT IN (SELECT host FROM dead WHERE host IS NOT NULL)),
 fresh AS (SELECT DISTINCT {_dom('url')} AS host, 1 AS branch FROM candidate) SELECT host, branch FROM kept UNION ALL SELECT host, branch FROM fresh WHERE host <> '' AND host NOT IN (SELECT domain FROM url_template) AND NOT list_contains({_list(V.EXCLUDED_HOSTS)}, host)""")
def prune_and_add(spark, d):
    dead = _dead(spark, d).select("host")
    known = table(spark, d, "url_template").select(F.col("domain").alias("host"))
    kept = known.join(dead, "host", "left_anti").withColumn("branch", F.lit(0))
    fresh = table(spark, d, "candidate").select(U.domain_of(F.col("url")).alias("host")).where("host <> ''").distinct().join(known, "host", "left_anti").where(~F.col("host").isin(V.EXCLUDED_HOSTS)).withColumn("branch", F.lit(1))
    return kept.unionByName(fresh)


@query("""WITH c AS (SELECT title, engine AS site, min(ordinal) AS ord FROM candidate WHERE length(title) BETWEEN 2 AND 60 AND engine IS NOT NULL GROUP BY 1, 2),
 p AS (SELECT title, ord, row_number() OVER (PARTITION BY site ORDER BY ord) AS pos FROM c), site AS (SELECT title, 1 AS w, pos, ord FROM p WHERE pos <= 200),
 fb AS (SELECT detail_title AS title, 10 AS w, row_number() OVER (ORDER BY audit_id) AS pos, audit_id + 1000000000 AS ord FROM page_audit WHERE length(detail_title) BETWEEN 2 AND 60 QUALIFY pos <= 50)
SELECT title, weight, mean_pos FROM (SELECT title, CAST(sum(w) AS BIGINT) AS weight, avg(pos) AS mean_pos, min(ord) AS o FROM (SELECT * FROM site UNION ALL SELECT * FROM fb) GROUP BY title) ORDER BY weight DESC, mean_pos, o LIMIT 100""")
def rank_fusion(spark, d):
    c = table(spark, d, "candidate").where("length(title) between 2 and 60 and engine is not null").groupBy("title", "engine").agg(F.min("ordinal").alias("ord"))
    site = R.top_k(c, ["engine"], [F.col("ord")], 200, "pos").select("title", F.lit(1).alias("w"), "pos", "ord")
    f = table(spark, d, "page_audit").where("length(detail_title) between 2 and 60").select(F.col("detail_title").alias("title"), "audit_id").orderBy("audit_id").limit(50)
    fb = f.select("title", F.lit(10).alias("w"), F.row_number().over(Window.orderBy("audit_id")).alias("pos"), (F.col("audit_id") + 1000000000).alias("ord"))
    g = site.unionByName(fb).groupBy("title").agg(F.sum("w").alias("weight"), F.avg("pos").alias("mean_pos"), F.min("ord").alias("o"))
    return g.orderBy(F.desc("weight"), "mean_pos", "o").limit(100).select("title", "weight", "mean_pos")


@query("SELECT coalesce(nullif(engine, ''), 'unknown') AS engine, count(*) AS n FROM candidate GROUP BY 1")
def engine_counts(spark, d):
    return table(spark, d, "candidate").groupBy(F.coalesce(F.nullif("engine", F.lit("")), F.lit("unknown")).alias("engine")).agg(F.count("*").alias("n"))


@query("SELECT run_id, count(*) AS candidates, coalesce(string_agg(DISTINCT engine, ',' ORDER BY engine), '') AS engines FROM candidate GROUP BY run_id")
def query_stats(spark, d):
    return table(spark, d, "candidate").groupBy("run_id").agg(F.count("*").alias("candidates"), F.array_join(F.sort_array(F.collect_set("engine")), ",").alias("engines"))


@query(f"SELECT {_norm('domain')} AS host, count(*) AS audits, count(*) FILTER (needs_render_fallback) AS render, count(*) FILTER (requires_login_or_pay) AS closed, count(*) FILTER (status IS NULL OR status = '') AS unknown FROM page_audit GROUP BY 1")
def audit_counters(spark, d):
    p = table(spark, d, "page_audit")
    return p.groupBy(U.normalize_domain(F.col("domain")).alias("host")).agg(
        F.count("*").alias("audits"), F.count_if("needs_render_fallback").alias("render"), F.count_if("requires_login_or_pay").alias("closed"), F.count_if(F.col("status").isNull() | (F.col("status") == "")).alias("unknown")
    )


@query("SELECT greatest(80, 500 // greatest(count(DISTINCT targetdomain), 1)) AS per_domain, count(DISTINCT targetdomain) AS domains FROM seed_page_stat")
def seed_caps(spark, d):
    n = F.countDistinct("targetdomain")
    return table(spark, d, "seed_page_stat").agg(F.greatest(F.lit(80), F.floor(F.lit(500) / F.greatest(n, F.lit(1)))).cast("bigint").alias("per_domain"), n.alias("domains"))


@query("""WITH t AS (SELECT domain, template, regexp_replace(replace(coalesce(template, ''), domain, 'H'), '^https?', 'S') AS sig FROM url_template), g AS (SELECT sig, count(*) AS n, min(domain) AS lead FROM t GROUP BY sig)
SELECT sig AS signature, n, lead, sha1(sig) AS id FROM g""")
def rule_signature_groups(spark, d):
    # the members of a group are the rows of rule_applicability
    sig = F.regexp_replace(F.replace(F.coalesce("template", F.lit("")), F.col("domain"), F.lit("H")), "^https?", "S")
    return table(spark, d, "url_template").groupBy(sig.alias("signature")).agg(F.count("*").alias("n"), F.min("domain").alias("lead")).withColumn("id", F.sha1("signature"))


# ---- joins and set operations -----------------------------------------------------------------------------------


@query("SELECT p.audit_id, coalesce(t.template, 'https://' || p.host || '/search?keyword={keyword}') AS template, t.template IS NOT NULL AS known FROM (SELECT audit_id, " + _norm("domain") + " AS host FROM page_audit WHERE domain IS NOT NULL) p LEFT JOIN url_template t ON t.domain = p.host")
def template_lookup(spark, d):
    p = table(spark, d, "page_audit").where("domain is not null").select("audit_id", U.normalize_domain(F.col("domain")).alias("host"))
    t = table(spark, d, "url_template").withColumnRenamed("domain", "host")
    return p.join(t, "host", "left").select("audit_id", F.coalesce("template", F.concat(F.lit("https://"), "host", F.lit("/search?keyword={keyword}"))).alias("template"), F.col("template").isNotNull().alias("known"))


@query(f"SELECT c.ordinal, c.host FROM (SELECT ordinal, {_dom('url')} AS host FROM candidate) c WHERE NOT list_contains({_list(V.EXCLUDED_HOSTS)}, host) AND NOT EXISTS (SELECT 1 FROM page_audit a WHERE a.detail_url = (SELECT url FROM candidate x WHERE x.ordinal = c.ordinal))")
def history_anti_join(spark, d):
    c = table(spark, d, "candidate").select("ordinal", "url", U.domain_of(F.col("url")).alias("host")).where(~F.col("host").isin(V.EXCLUDED_HOSTS))
    seen = table(spark, d, "page_audit").select(F.col("detail_url").alias("url")).distinct()
    return c.join(seen, "url", "left_anti").select("ordinal", "host")


@query(f"""WITH n AS (SELECT {_norm('domain')} AS host, count(*) AS n FROM page_audit WHERE domain IS NOT NULL GROUP BY 1)
SELECT ordinal, c.host, coalesce(n, 0) AS audits FROM (SELECT ordinal, {_dom('url')} AS host FROM candidate) c LEFT JOIN n ON n.host = c.host WHERE coalesce(n, 0) < 20""")
def report_limit_join(spark, d):
    n = table(spark, d, "page_audit").where("domain is not null").groupBy(U.normalize_domain(F.col("domain")).alias("host")).agg(F.count("*").alias("n"))
    c = table(spark, d, "candidate").select("ordinal", U.domain_of(F.col("url")).alias("host"))
    return c.join(n, "host", "left").withColumn("audits", F.coalesce("n", F.lit(0)).cast("bigint")).where("audits < 20").select("ordinal", "host", "audits")


@query(f"SELECT domain FROM url_template WHERE NOT {_any('domain', V.BLOCKED + ['ink', 'draw'])}")
def token_anti_join(spark, d):
    tokens = spark.createDataFrame([(t,) for t in V.BLOCKED + ["ink", "draw"]], "token string")
    return R.without_tokens(table(spark, d, "url_template").select("domain"), "domain", tokens, "token")


@query("""WITH f AS (SELECT detail_url, min(audit_id) AS audit_id FROM page_audit WHERE detail_url IS NOT NULL GROUP BY 1) SELECT c.ordinal, f.audit_id AS first_audit, f.audit_id IS NULL AS missing FROM candidate c LEFT JOIN f ON f.detail_url = c.url""")
def page_lookup(spark, d):
    f = table(spark, d, "page_audit").where("detail_url is not null").groupBy(F.col("detail_url").alias("url")).agg(F.min("audit_id").alias("first_audit"))
    return table(spark, d, "candidate").select("ordinal", "url").join(f, "url", "left").select("ordinal", "first_audit", F.col("first_audit").isNull().alias("missing"))


_OWN = f"SELECT {_norm('domain')} AS domain, count(*) AS audits FROM page_audit WHERE domain IS NOT NULL GROUP BY 1"


@query(f"SELECT domain, coalesce(t.template, 'https://' || domain || '/derived') AS template, coalesce(audits, 0) AS audits FROM url_template t FULL JOIN ({_OWN}) o USING (domain)")
def site_config_merge(spark, d):
    o = table(spark, d, "page_audit").where("domain is not null").groupBy(U.normalize_domain(F.col("domain")).alias("domain")).agg(F.count("*").alias("audits"))
    m = table(spark, d, "url_template").join(o, "domain", "full_outer")
    return m.select("domain", F.coalesce("template", F.concat(F.lit("https://"), "domain", F.lit("/derived"))).alias("template"), F.coalesce("audits", F.lit(0)).cast("bigint").alias("audits"))


@query("SELECT host, CAST(max(a) AS BIGINT) AS in_audits, CAST(max(c) AS BIGINT) AS in_hits, CAST(max(t) AS BIGINT) AS in_templates FROM (SELECT " + _norm("domain") + " AS host, 1 AS a, 0 AS c, 0 AS t FROM page_audit WHERE domain IS NOT NULL UNION ALL SELECT " + _dom("url") + ", 0, 1, 0 FROM candidate UNION ALL SELECT domain, 0, 0, 1 FROM url_template) GROUP BY host")
def host_membership(spark, d):
    one = lambda df, k: df.select("host", *(F.lit(int(k == n)).alias(n) for n in "act"))
    rows = one(table(spark, d, "page_audit").where("domain is not null").select(U.normalize_domain(F.col("domain")).alias("host")), "a").unionByName(one(table(spark, d, "candidate").select(U.domain_of(F.col("url")).alias("host")), "c")).unionByName(one(table(spark, d, "url_template").select(F.col("domain").alias("host")), "t"))
    return rows.groupBy("host").agg(*(F.max(c).cast("bigint").alias(n) for c, n in (("a", "in_audits"), ("c", "in_hits"), ("t", "in_templates"))))


@query("SELECT domain FROM url_template EXCEPT SELECT targetdomain FROM seed_page_stat")
def host_difference(spark, d):
    return table(spark, d, "url_template").select("domain").subtract(table(spark, d, "seed_page_stat").select(F.col("targetdomain").alias("domain")))


@query("""SELECT word, CAST(branch AS BIGINT) AS branch, ord FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY branch, ord) AS rn FROM (SELECT title AS word, 0 AS branch, ordinal AS ord FROM candidate WHERE title IS NOT NULL UNION ALL SELECT detail_title, 1, audit_id FROM page_audit WHERE detail_title IS NOT NULL)) WHERE rn = 1""")
def ordered_union(spark, d):
    a = table(spark, d, "candidate").where("title is not null").select(F.col("title").alias("word"), F.col("ordinal").alias("ord"))
    b = table(spark, d, "page_audit").where("detail_title is not null").select(F.col("detail_title").alias("word"), F.col("audit_id").alias("ord"))
    return R.ordered_union([a, b], ["word"], "ord").select("word", F.col("branch").cast("bigint").alias("branch"), "ord")


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events")
def global_numbering(spark, d):
    return R.numbered(table(spark, d, "events").select("event_id"), "event_id").select("event_id", F.col("rn").cast("bigint").alias("rn"))


@query("""WITH e AS (SELECT event_type AS section, user_id % 7 AS lang, event_id, value FROM events), l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY section, lang ORDER BY event_id DESC) = 1),
 t AS (SELECT section, lang AS top_lang FROM l QUALIFY row_number() OVER (PARTITION BY section ORDER BY event_id DESC) = 1) SELECT section, lang, event_id, value, lang = top_lang AS on_top FROM l JOIN t USING (section)""")
def manifest_upsert(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("section"), (F.col("user_id") % 7).alias("lang"), "event_id", "value")
    cells = R.latest(e, ["section", "lang"], "event_id")
    top = F.max("event_id").over(Window.partitionBy("section"))
    return cells.withColumn("on_top", F.col("event_id") == top)


# ---- catalog and pipelines --------------------------------------------------------------------------------------

_REP = f"SELECT lower(detail_title) AS k, detail_title AS title, {_norm('domain')} AS host, audit_id AS ord FROM page_audit WHERE length(detail_title) >= 2 AND domain IS NOT NULL AND coalesce(status, '') <> 'excluded_login_or_pay'"


def _report_titles(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_audit").where("length(detail_title) >= 2 and domain is not null and coalesce(status, '') <> 'excluded_login_or_pay'")
    return p.select(F.lower("detail_title").alias("k"), F.col("detail_title").alias("title"), U.normalize_domain(F.col("domain")).alias("host"), F.col("audit_id").alias("ord"))


@query(f"""WITH r AS ({_REP}), u AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k, host ORDER BY ord) = 1),
 rep AS (SELECT k, arg_min(title, ord) AS title, count(*) AS sources, arg_min(host, ord) AS first_source, 'report' AS origin FROM u GROUP BY k),
 kw AS (SELECT lower(evidence.keyword) AS k, arg_min(evidence.keyword, audit_id) AS title, 0 AS sources, '' AS first_source, 'keyword' AS origin FROM page_audit WHERE evidence.keyword <> '' GROUP BY 1)
SELECT k, title, sources, first_source, origin FROM rep UNION ALL SELECT * FROM kw WHERE k NOT IN (SELECT k FROM rep)""")
def catalog_merge(spark, d):
    rep = _sources(spark, d).groupBy("k").agg(F.min_by("title", "ord").alias("title"), F.count("*").alias("sources"), F.min_by("host", "ord").alias("first_source")).withColumn("origin", F.lit("report"))
    kw = table(spark, d, "page_audit").select(F.col("evidence.keyword").alias("w"), "audit_id").where("w <> ''").groupBy(F.lower("w").alias("k")).agg(F.min_by("w", "audit_id").alias("title"))
    kw = kw.join(rep.select("k"), "k", "left_anti").select("k", "title", F.lit(0).cast("bigint").alias("sources"), F.lit("").alias("first_source"), F.lit("keyword").alias("origin"))
    return rep.unionByName(kw)


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return _report_titles(spark, d).groupBy("k", "host").agg(F.min(F.struct("ord", "title")).alias("o")).select("k", "host", "o.*")


@query(f"WITH r AS ({_REP}) SELECT k, host, min(ord) AS ord FROM r GROUP BY k, host")
def catalog_sources(spark, d):
    """The sources of each catalog entry, in rows."""
    return _sources(spark, d).select("k", "host", "ord")


_CATS = "[" + ", ".join(q(n) for n, _ in V.CATEGORIES) + "]"


@query(f"""WITH r AS ({_REP}), i AS (SELECT k, min(ord) AS ord, {_category_sql('k')} AS cat FROM r GROUP BY k), c AS (SELECT unnest({_CATS}) AS name, unnest(range(1, {len(V.CATEGORIES) + 1})) AS o),
 have AS (SELECT o, name, CAST(120 + 40 * o AS BIGINT) - least((SELECT count(*) FROM i WHERE cat = name), 100) AS room FROM c), slot AS (SELECT name, o, unnest(range(0, greatest(room, 0))) AS kk FROM have),
 s AS (SELECT name, row_number() OVER (ORDER BY kk, o) AS rn FROM slot), f AS (SELECT k, row_number() OVER (ORDER BY ord) AS rn FROM i WHERE cat = '') SELECT k, name AS category FROM f JOIN s USING (rn)""")
def catalog_round_robin(spark, d):
    i = _report_titles(spark, d).groupBy("k").agg(F.min("ord").alias("ord")).withColumn("cat", _category(F.col("k")))
    have = i.where("cat <> ''").groupBy("cat").agg(F.count("*").alias("n"))
    cats = spark.createDataFrame([(n, o) for o, (n, _) in enumerate(V.CATEGORIES, 1)], "name string, o int")
    bins = cats.join(have.withColumnRenamed("cat", "name"), "name", "left").select("name", "o", (F.lit(120) + 40 * F.col("o") - F.least(F.coalesce("n", F.lit(0)), F.lit(100))).cast("int").alias("room"))
    return R.round_robin(i.where("cat = ''").select("k", "ord"), "ord", bins, "room", "o").select("k", F.col("name").alias("category"))


@query(f"WITH r AS ({_REP}), i AS (SELECT k, {_category_sql('k')} AS cat FROM (SELECT DISTINCT k FROM r)) SELECT cat AS category, count(*) AS items, min(k) AS first_key FROM i GROUP BY 1")
def catalog_totals(spark, d):
    i = _report_titles(spark, d).select("k").distinct().withColumn("category", _category(F.col("k")))
    return i.groupBy("category").agg(F.count("*").alias("items"), F.min("k").alias("first_key"))


@query(f"""WITH r AS (SELECT audit_id, {_SAFE} || '_' || substr(sha1(detail_url), 1, 8) || '_auto_public' AS id, {_norm('domain')} AS host, detail_title AS name FROM page_audit WHERE domain IS NOT NULL AND detail_url IS NOT NULL AND length(detail_title) >= 2),
 capped AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY host ORDER BY audit_id) <= 10), one AS (SELECT * FROM capped QUALIFY row_number() OVER (PARTITION BY id ORDER BY audit_id) = 1)
SELECT id, host, name, coalesce(t.template, 'https://' || host || '/search?keyword={{keyword}}') AS search FROM one LEFT JOIN url_template t ON t.domain = one.host""")
def rule_index_build(spark, d):
    p = table(spark, d, "page_audit").where("domain is not null and detail_url is not null and length(detail_title) >= 2")
    r = p.select("audit_id", T.safe_id(F.col("domain"), F.col("detail_url")).alias("id"), U.normalize_domain(F.col("domain")).alias("host"), F.col("detail_title").alias("name"))
    one = R.first_wins(R.arrival_cap(r, ["host"], "audit_id", 10), ["id"], "audit_id")
    t = table(spark, d, "url_template").withColumnRenamed("domain", "host")
    return one.join(t, "host", "left").select("id", "host", "name", F.coalesce("template", F.concat(F.lit("https://"), "host", F.lit("/search?keyword={keyword}"))).alias("search"))


@query(f"""WITH {_SITE}, reg AS (SELECT DISTINCT {_reg('host')} AS domain FROM checked WHERE verdict IN ('validate', 'secondary', 'label')) SELECT domain, domain IN (SELECT domain FROM url_template) AS known FROM reg WHERE NOT list_contains({_list(V.EXCLUDED_HOSTS)}, domain)""")
def domain_discover(spark, d):
    kept = _sites(spark, d).where(F.col("verdict").isin("validate", "secondary", "label")).select(U.registered_domain(F.col("host"), V.HOSTING).alias("domain")).distinct().where(~F.col("domain").isin(V.EXCLUDED_HOSTS))
    known = table(spark, d, "url_template").select("domain", F.lit(True).alias("k"))
    return kept.join(known, "domain", "left").select("domain", F.coalesce("k", F.lit(False)).alias("known"))


@query(f"""WITH ex AS (SELECT unnest({_list(V.EXCLUDED_HOSTS + ['gone.example'])}) AS host), f AS (SELECT {_dom('detail_url')} AS host, count(*) AS n FROM page_audit GROUP BY 1) SELECT ex.host, coalesce(n, 0) > 0 AS reachable FROM ex LEFT JOIN f USING (host)""")
def recover_excluded(spark, d):
    ex = spark.createDataFrame([(h,) for h in V.EXCLUDED_HOSTS + ["gone.example"]], "host string")
    f = table(spark, d, "page_audit").select(U.domain_of(F.col("detail_url")).alias("host")).distinct().withColumn("r", F.lit(True))
    return ex.join(f, "host", "left").select("host", F.coalesce("r", F.lit(False)).alias("reachable"))


@query(f"""WITH s AS (SELECT run_id, seedurl, min(checked_at) AS t, max(coalesce(selectedcount, 0)) AS sel FROM seed_page_stat WHERE status <> 'fetch_failed' GROUP BY 1, 2),
 c AS (SELECT run_id, {_dom('url')} AS host, ordinal, split_part(url, '#', 1) AS page FROM candidate WHERE url IS NOT NULL),
 j AS (SELECT DISTINCT c.run_id, c.host, c.ordinal, c.page FROM c JOIN s ON s.run_id = c.run_id AND {_dom('s.seedurl')} = c.host),
 capped AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY run_id, host ORDER BY ordinal) <= 4) SELECT run_id, page, min(ordinal) AS ordinal FROM capped GROUP BY 1, 2""")
def seed_candidates(spark, d):
    s = table(spark, d, "seed_page_stat").where("status <> 'fetch_failed'").select("run_id", U.domain_of(F.col("seedurl")).alias("host")).distinct()
    c = table(spark, d, "candidate").where("url is not null").select("run_id", U.domain_of(F.col("url")).alias("host"), "ordinal", U.defragment(F.col("url")).alias("page"))
    return R.arrival_cap(c.join(s, ["run_id", "host"]), ["run_id", "host"], "ordinal", 4).groupBy("run_id", "page").agg(F.min("ordinal").alias("ordinal"))


@query("SELECT doc_type, lang IS NULL OR trim(lang) = '' AS unlabelled, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, CAST(max(n_chars) AS BIGINT) AS longest FROM documents GROUP BY ALL")
def document_profile(spark, d):
    return table(spark, d, "documents").groupBy("doc_type", (F.col("lang").isNull() | (F.trim("lang") == "")).alias("unlabelled")).agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"), F.max("n_chars").alias("longest"))


# ---- scraping cascades, seeds and cleaning steps ----------------------------------------------------------------

_WORK = r"/(?:comic|series|title|book|manga|manhua)/"


@query(f"SELECT audit_id, pos, url, text FROM {_LINKS} WHERE regexp_matches(url, {q(_WORK)}) AND length(text) BETWEEN 2 AND 60 AND NOT regexp_matches(text, '^Free') AND NOT {_any('lower(url)', V.SKIP_LINKS)}")
def html_link_titles(spark, d):
    rows = H.link_titles(_pages(spark, d), "html", "base_url", work=_WORK, skip=V.SKIP_LINKS, noise="^Free", dots=False)
    return rows.select("audit_id", F.col("pos").cast("bigint").alias("pos"), "url", "text")


@query(f"SELECT audit_id, CAST(len(regexp_extract_all(html, {q(_WORK)})) AS BIGINT) AS links, len(regexp_extract_all(html, {q(_WORK)})) >= 1 AS ranking FROM {_PAGE_SQL}")
def page_work_links(spark, d):
    n = H.work_links(F.col("html"), _WORK)
    return _pages(spark, d).select("audit_id", n.alias("links"), (n >= 1).alias("ranking"))


@query(f"""WITH a AS (SELECT audit_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["''][^"'']*/chapter/[^"'']*["''][^>]*>(.*?)</a>', 1), lambda t: {_clean('t')}), lambda t: length(t) BETWEEN 2 AND 60) AS x,
 list_filter(list_transform(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bclass\\s*=\\s*["''][^"'']*x[^"'']*["''][^>]*>(.*?)</a>', 1), lambda t: {_clean('t')}), lambda t: length(t) BETWEEN 2 AND 60) AS y FROM {_PAGE_SQL})
SELECT audit_id, unnest(CASE WHEN len(x) > 0 THEN x ELSE y END) AS title FROM a""")
def scrape_cascade(spark, d):
    h = F.col("html")
    return _pages(spark, d).select("audit_id", F.explode(H.first_filled(H.selected_titles(h, "a", "href", "/chapter/"), H.selected_titles(h, "a", "class", "x"))).alias("title"))


@query(f"""WITH t AS (SELECT domain, unnest(['/list', '/new', '/hot']) AS path FROM url_template), f AS (SELECT domain, path, unnest(['?page=2', '/2', '']) AS fmt FROM t),
 k AS (SELECT DISTINCT seedurl FROM seed_page_stat) SELECT domain, path, fmt AS format FROM f SEMI JOIN k ON k.seedurl = 'https://' || domain || path || fmt""")
def pagination_discover(spark, d):
    t = table(spark, d, "url_template").select("domain", F.explode(F.array(*map(F.lit, ["/list", "/new", "/hot"]))).alias("path"))
    f = t.select("*", F.explode(F.array(*map(F.lit, ["?page=2", "/2", ""]))).alias("format")).withColumn("seedurl", F.concat(F.lit("https://"), "domain", "path", "format"))
    return f.join(table(spark, d, "seed_page_stat").select("seedurl").distinct(), "seedurl", "left_semi").select("domain", "path", "format")


@query("""WITH a AS (SELECT seedurl AS url, 0 AS branch, min(run_id) AS o FROM seed_page_stat GROUP BY 1 UNION ALL SELECT 'https://' || domain, 1, row_number() OVER (ORDER BY domain) FROM url_template UNION ALL SELECT 'https://www.' || domain, 2, row_number() OVER (ORDER BY domain) FROM url_template)
SELECT url, branch, o FROM a QUALIFY row_number() OVER (PARTITION BY url ORDER BY branch, o) = 1""")
def seed_urls(spark, d):
    a = table(spark, d, "seed_page_stat").groupBy(F.col("seedurl").alias("url")).agg(F.min("run_id").alias("o"))
    t = R.numbered(table(spark, d, "url_template").select("domain"), "domain", "o")
    b = [t.select(F.concat(F.lit(p), "domain").alias("url"), F.col("o").cast("bigint").alias("o")) for p in ("https://", "https://www.")]
    return R.ordered_union([a, *b], ["url"], "o").select("url", "branch", "o")


@query(f"""WITH k AS (SELECT evidence.keyword AS keyword, min(audit_id) AS o FROM page_audit WHERE evidence.keyword <> '' GROUP BY 1)
SELECT keyword, row_number() OVER (ORDER BY CASE WHEN {_any("lower(keyword)", ['ba', '山'])} THEN 0 ELSE 1 END, o) AS place FROM k""")
def keywords_generic_first(spark, d):
    k = table(spark, d, "page_audit").select(F.col("evidence.keyword").alias("keyword"), "audit_id").where("keyword <> ''").groupBy("keyword").agg(F.min("audit_id").alias("o"))
    first = F.when(P.contains_any(F.lower("keyword"), ["ba", "山"]), 0).otherwise(1)
    return R.numbered(k.withColumn("g", first), [F.col("g"), F.col("o")], "place").select("keyword", F.col("place").cast("bigint").alias("place"))


@query(f"WITH r AS ({_REP}), i AS (SELECT k, min(ord) AS ord, {_category_sql('k')} AS category FROM r GROUP BY k) SELECT category, k, row_number() OVER (PARTITION BY category ORDER BY ord) AS place FROM i WHERE category <> '' QUALIFY place <= 25")
def category_cut(spark, d):
    i = _report_titles(spark, d).groupBy("k").agg(F.min("ord").alias("ord")).withColumn("category", _category(F.col("k"))).where("category <> ''")
    return R.top_k(i, ["category"], [F.col("ord")], 25, "place").select("category", "k", F.col("place").cast("bigint").alias("place"))


_VALID = f"(length(detail_title) >= 2 AND NOT regexp_matches(detail_title, {q(V.PLACEHOLDER)}))"


@query(f"""WITH m AS (SELECT CASE WHEN detail_title IS NULL THEN 'no title' WHEN NOT {_VALID} THEN 'bad title' WHEN detail_url IS NULL THEN 'no url' ELSE 'ok' END AS reason FROM page_audit)
SELECT reason, count(*) AS n, reason = 'ok' AS kept FROM m GROUP BY 1""")
def cleaning_counts(spark, d):
    t = F.col("detail_title")
    bad = ~((F.length(t) >= 2) & ~t.rlike(V.PLACEHOLDER))
    reason = P.cascade((t.isNull(), "no title"), (bad, "bad title"), (F.col("detail_url").isNull(), "no url"), otherwise="ok")
    return table(spark, d, "page_audit").groupBy(reason.alias("reason")).agg(F.count("*").alias("n")).withColumn("kept", F.col("reason") == "ok")


@query(f"""WITH r AS ({_REP}), c AS (SELECT lower(title) AS k, title, {_dom('url')} AS host, ordinal AS ord FROM candidate WHERE length(title) BETWEEN 2 AND 80), f AS (SELECT * FROM c WHERE k NOT IN (SELECT k FROM r)),
 u AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY k, host ORDER BY ord) = 1) SELECT k, arg_min(title, ord) AS title, count(*) AS sources, arg_min(host, ord) AS first_source FROM u GROUP BY k""")
def catalog_crawl_merge(spark, d):
    c = table(spark, d, "candidate").where("length(title) between 2 and 80").select(F.lower("title").alias("k"), "title", U.domain_of(F.col("url")).alias("host"), F.col("ordinal").alias("ord"))
    fresh = c.join(_report_titles(spark, d).select("k").distinct(), "k", "left_anti")
    one = fresh.groupBy("k", "host").agg(F.min(F.struct("ord", "title")).alias("o")).select("k", "host", "o.*")
    return one.groupBy("k").agg(F.min_by("title", "ord").alias("title"), F.count("*").alias("sources"), F.min_by("host", "ord").alias("first_source"))


@query(f"WITH {_SITE}, ok AS (SELECT DISTINCT {_reg('host')} AS dom FROM checked WHERE verdict IN ('validate', 'secondary', 'label')) SELECT domain FROM url_template WHERE ({_reg('domain')} IN (SELECT dom FROM ok) OR domain IN (SELECT dom FROM ok)) AND NOT list_contains({_list(V.EXCLUDED_HOSTS)}, domain)")
def revalidate_keep(spark, d):
    ok = _sites(spark, d).where(F.col("verdict").isin("validate", "secondary", "label")).select(U.registered_domain(F.col("host"), V.HOSTING).alias("dom")).distinct()
    t = table(spark, d, "url_template").select("domain").where(~F.col("domain").isin(V.EXCLUDED_HOSTS))
    keys = t.select("domain", F.explode(F.array_distinct(F.array(U.registered_domain(F.col("domain"), V.HOSTING), F.col("domain")))).alias("dom"))  # either key: an equi-join
    return keys.join(ok, "dom", "left_semi").select("domain").distinct()


@query(f"""WITH c AS (SELECT run_id, ordinal, {_dom('url')} AS host, lower(coalesce(title, '') || ' ' || coalesce(snippet, '')) AS t FROM candidate), r AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ordinal) <= 10),
 f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY host ORDER BY ordinal) = 1) SELECT host, ordinal FROM f WHERE host <> '' AND {_any('t', V.VALIDATE)}""")
def ranking_sites(spark, d):
    c = table(spark, d, "candidate").select("run_id", "ordinal", U.domain_of(F.col("url")).alias("host"), F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("snippet", F.lit("")))).alias("t"))
    return R.first_wins(R.arrival_cap(c, ["run_id"], "ordinal", 10), ["host"], "ordinal").where(P.contains_any(F.col("t"), V.VALIDATE)).select("host", "ordinal")


@query(f"""WITH t AS (SELECT domain, regexp_replace(replace(coalesce(template, ''), domain, 'H'), '^https?', 'S') AS sig FROM url_template), g AS (SELECT sig, count(*) AS n, min(domain) AS lead FROM t GROUP BY sig)
SELECT domain, lead, n AS applies_to FROM t JOIN g USING (sig)""")
def rule_applicability(spark, d):
    t = table(spark, d, "url_template").select("domain", F.regexp_replace(F.replace(F.coalesce("template", F.lit("")), F.col("domain"), F.lit("H")), "^https?", "S").alias("sig"))
    return t.join(t.groupBy("sig").agg(F.count("*").alias("applies_to"), F.min("domain").alias("lead")), "sig").select("domain", "lead", "applies_to")


@query("SELECT domain, coalesce(template, 'https://' || domain || '/search') AS template, template IS NULL AS filled, md5(coalesce(template, '')) AS stamp FROM url_template")
def defaults_fill(spark, d):
    t = table(spark, d, "url_template")
    return t.select("domain", F.coalesce("template", F.concat(F.lit("https://"), "domain", F.lit("/search"))).alias("template"), F.col("template").isNull().alias("filled"), F.md5(F.coalesce("template", F.lit(""))).alias("stamp"))


@query("SELECT audit_id, strftime(audited_at, '%Y.%m.%d.%H%M') AS version, strftime(audited_at, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM page_audit")
def stamps(spark, d):
    return table(spark, d, "page_audit").select("audit_id", T.version(F.col("audited_at")).alias("version"), T.iso(F.col("audited_at")).alias("iso"))


@query("SELECT host, n, CAST(sum(n) OVER (ORDER BY n DESC, host ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM (SELECT " + _norm("domain") + " AS host, count(*) AS n FROM page_audit WHERE domain IS NOT NULL GROUP BY 1)")
def contributor_running_share(spark, d):
    g = table(spark, d, "page_audit").where("domain is not null").groupBy(U.normalize_domain(F.col("domain")).alias("host")).agg(F.count("*").alias("n"))
    return R.running(g, [F.desc("n"), F.col("host")], F.col("n"), "running")


@query("""WITH r AS (SELECT * FROM candidate QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY ordinal) <= 8), k AS (SELECT * FROM r WHERE EXISTS (SELECT 1 FROM url_template t WHERE contains(r.url, t.domain)))
SELECT title, count(*) AS hits, min(ordinal) AS first_seen FROM k WHERE length(title) BETWEEN 2 AND 60 GROUP BY title""")
def search_then_scrape(spark, d):
    c = R.arrival_cap(table(spark, d, "candidate").select("run_id", "ordinal", "url", "title"), ["run_id"], "ordinal", 8)
    known = R.with_tokens(c, "url", table(spark, d, "url_template"), "domain")
    return known.where(F.length("title").between(2, 60)).groupBy("title").agg(F.count("*").alias("hits"), F.min("ordinal").alias("first_seen"))
