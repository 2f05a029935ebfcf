"""URL functions on columns. Hosts keep port and user info unless a function says otherwise."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def authority(url: Column) -> Column:
    return F.regexp_extract(url, _AUTHORITY, 1)


def domain_of(url: Column) -> Column:
    """Lower-case host without one leading ``www.``."""
    return F.regexp_replace(F.lower(authority(url)), r"^www\.", "")


def normalize_domain(d: Column, anywhere: bool = False) -> Column:
    """A bare domain from what people write: schemes go wherever they stand, then the path, then ``www.``
    (``anywhere``: each of them, else one leading)."""
    bare = F.split_part(F.replace(F.replace(F.lower(F.trim(d)), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit("")), F.lit("/"), F.lit(1))
    return F.replace(bare, F.lit("www."), F.lit("")) if anywhere else F.regexp_replace(bare, r"^www\.", "")


def extract_domain(url: Column) -> Column:
    """``domain_of``, or '' where there is no dot in it."""
    d = domain_of(url)
    return F.when(F.contains(d, F.lit(".")), d).otherwise("")


def _with_scheme(v: Column) -> Column:
    return F.when(F.contains(v, F.lit("://")), v).otherwise(F.concat(F.lit("https://"), v))


def host_of(v: Column) -> Column:
    """Host of a URL or bare host; every ``www.`` goes."""
    u = _with_scheme(F.trim(v))
    host = authority(u)
    path = F.regexp_extract(u, _AUTHORITY + r"([^?#]*)", 2)
    return F.btrim(F.replace(F.lower(F.when(host != "", host).otherwise(path)), F.lit("www."), F.lit("")), F.lit("/"))


def path_of(v: Column) -> Column:
    return F.lower(F.regexp_extract(_with_scheme(F.trim(v)), _AUTHORITY + r"([^?#]*)", 2))


def base_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def same_site(url: Column, domain: Column) -> Column:
    """The URL's host is the domain or lies under it."""
    h = domain_of(url)
    return (h == domain) | F.endswith(h, F.concat(F.lit("."), domain))


def registered_domain(d: Column, hosting: list[str]) -> Column:
    """Last two labels, three under a hosting suffix; an IPv4 address stays. No public-suffix list."""
    parts = F.split(d, r"\.")
    last = lambda k: F.array_join(F.slice(parts, F.greatest(F.size(parts) - k + 1, F.lit(1)), F.lit(k)), ".")
    hosted = F.exists(F.array(*map(F.lit, hosting)), lambda s: F.endswith(d, F.concat(F.lit("."), s))) if hosting else F.lit(False)
    return F.when(d.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), d).when(F.size(parts) <= 2, d).when(hosted, last(3)).otherwise(last(2))


def domain_label(d: Column, hosting: list[str]) -> Column:
    """Leftmost label of the registered domain."""
    return F.split_part(registered_domain(d, hosting), F.lit("."), F.lit(1))


def defragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def fill(template: Column, **values: Column) -> Column:
    """``{name}`` replaced by each value."""
    for name, v in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), v)
    return template


def query_string(**values: Column) -> Column:
    """k=v&k=v with URL encoding (a blank becomes +)."""
    return F.concat_ws("&", *(F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in values.items()))


#: Entities that HTML texts of sites hold; numbers are handled by ``unescape`` in Python.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&")]


def unescape(c: Column) -> Column:
    """The fixed entities, ``&amp;`` last."""
    for a, b in ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _resolved(path: Column, rooted: Column) -> Column:
    """A path from the root without dot segments; one that was merged with the base's loses empty segments inside, too."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/")
    last = F.element_at(parts, -1)
    inner = F.filter(F.slice(parts, 1, F.size(parts) - 1), lambda s: rooted | (s != ""))
    step = lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    kept = F.aggregate(F.concat(inner, F.array(last)), F.array().cast("array<string>"), step)
    return F.concat(F.lit("/"), F.array_join(F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))


def join(base: Column, url: Column) -> Column:
    """A relative URL under its base (RFC 3986), in the JVM; one with a scheme of its own stays."""
    root = base_of(base)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    own, rest = F.regexp_extract(url, r"^([^?#]*)", 1), F.regexp_extract(url, r"^[^?#]*(.*)", 1)
    merged = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(F.when(F.contains(path, F.lit("/")), F.regexp_extract(path, r"^(.*/)", 1)).otherwise("/"), own))
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    same = F.concat(root, path, F.when(F.startswith(rest, F.lit("?")), rest).otherwise(F.concat(query, rest)))
    return F.when(url == "", base).when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), url).when(own == "", same).otherwise(F.concat(root, _resolved(merged, F.startswith(own, F.lit("/"))), rest))


def canonical_url(url: Column, base: Column, dots: bool = True) -> Column:
    """Trim, unescape, ``\\/`` to ``/``; ``//x`` takes the base's scheme (https without one); a relative URL is joined.

    dots: join by RFC 3986 with dot segments. False: only root-relative URLs are joined.
    """
    u = F.replace(unescape(F.trim(url)), F.lit("\\/"), F.lit("/"))
    scheme = F.coalesce(F.nullif(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1), F.lit("")), F.lit("https"))
    based = F.coalesce(base, F.lit("")) != ""
    joined = join(base, u) if dots else F.concat(base_of(base), u)
    relative = F.startswith(u, F.lit("/")) | ~F.startswith(F.lower(u), F.lit("http"))
    return (
        F.when(u == "", "")
        .when(F.startswith(u, F.lit("//")), F.concat(scheme, F.lit(":"), u))
        .when(based & (F.startswith(u, F.lit("/")) if not dots else relative), joined)
        .otherwise(u)
    )


def absolutize(url: Column, domain: Column) -> Column:
    """``//x`` under https, ``/x`` under the domain."""
    return F.when(F.startswith(url, F.lit("//")), F.concat(F.lit("https:"), url)).when(F.startswith(url, F.lit("/")), F.concat(F.lit("https://"), domain, url)).otherwise(url)


def unwrap(url: Column, param: str) -> Column:
    """Target of a redirect URL that carries it in a query parameter, else the URL."""
    target = F.regexp_extract(url, rf"[?&]{param}=([^&#]*)", 1)
    return F.when(target != "", F.try_url_decode(target)).otherwise(url)
