"""Page extraction over a pages table.

A narrow, per-row map over ``(url, html)``: every step is a built-in Column
expression (regex extraction + higher-order array functions), so extraction
of 100 TB of pages is a scan with no shuffle.  Link de-duplication keeps the
first occurrence of each canonical URL inside the page's own link array
(sort by (url, position), keep group heads, restore position order), which
is O(n log n) per page and needs no cross-row work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lookup as L
from ..functions import urls as U

# Link-extractor default denied extensions (archives, images,
# audio, video, office documents, other binaries).
IGNORED_EXTENSIONS = [
    "7z", "7zip", "bz2", "rar", "tar", "tar.gz", "xz", "zip",
    "mng", "pct", "bmp", "gif", "jpg", "jpeg", "png", "pst", "psp", "tif", "tiff", "ai", "drw", "dxf", "eps", "ps", "svg", "cdr", "ico", "webp",
    "mp3", "wma", "ogg", "wav", "ra", "aac", "mid", "au", "aiff",
    "3gp", "asf", "asx", "avi", "mov", "mp4", "mpg", "qt", "rm", "swf", "wmv", "m4a", "m4v", "flv", "webm",
    "xls", "xlsx", "ppt", "pptx", "pps", "doc", "docx", "odt", "ods", "odg", "odp",
    "css", "pdf", "exe", "bin", "rss", "dmg", "iso", "apk", "jar", "sh", "rb", "js", "hta", "bat", "cpl", "msi", "msp", "py",
]

# Accepted content types, schemes a link may have, length caps.
ACCEPTED_CONTENT_TYPES = ("text/html", "application/xhtml+xml")
LINK_SCHEMES = ("http", "https", "file", "ftp")
ANCHOR_MAX = 200
TITLE_MAX = 500
NON_HTML_REASON = "NonHTML content-type"

# Attributes of a tag: quoted values may hold ">".  All loops are possessive, and
# what is left open runs to the end of the page, so a page is read once.
_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_END = r"""(?:>|["'].*+|\z)"""
_HIDDEN = (r"(?is)<!--.*?(?:-->|\z)|(<script(?=[\s/>])" + _ATTRS + _END + r").*?(?:</script(?=[\s/>])[^>]*+>?|\z)"
           r"|<style(?=[\s/>])" + _ATTRS + _END + r".*?(?:</style(?=[\s/>])[^>]*+>?|\z)|(</?[a-z]" + _ATTRS + _END + ")")
_TAG = r"(?is)</?[a-z]" + _ATTRS + _END
# an element's text: up to its end tag or the next link tag, other tags stepped over whole
_A_TEXT = r"(?:[^<]++|<(?!/?a[\s/>]|area[\s/>])(?:/?[a-z]" + _ATTRS + _END + r")?+)*+"
# every tag is stepped over whole; group 1 is the tag where it tells something, of a link with its text
_TELLING = (r"(?is)(?:(?=(<a(?=[\s/>])" + _ATTRS + _END + _A_TEXT + r"|<(?:area|base|link|script)(?=[\s/>])" + _ATTRS + _END + r"))|)"
            r"</?[a-z]" + _ATTRS + _END)
_HEAD = r"(?is)^<[a-z]++(" + _ATTRS + ")" + _END
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++[^\s>]*+)"""

html_unescape = L.html_unescape


def _attr(tag_attrs: Column, name: str) -> Column:
    """Value of an attribute as it is written, NULL without one; names inside other
    values don't count, and the first of several wins."""
    skip = r"(?:[\s/]++|(?!" + name + r"\s*+=)[^\s=>/\"']++(?:\s*+=\s*+" + _VALUE + r"?+)?+|[\"'=])*+"
    pattern = r"(?is)^" + skip + name + r"\s*+=\s*+(" + _VALUE + ")"

    def body(v):
        quoted = F.substring(v, 1, 1).isin('"', "'")
        return F.when(v != "", F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))

    return L.let(F.regexp_extract(tag_attrs, pattern, 1), body)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def visible_html(html) -> Column:
    """HTML without comments, styles and the content of scripts (they hold no links); other
    tags are stepped over whole, so nothing inside an attribute counts."""
    return F.regexp_replace(U._c(html), _HIDDEN, "$1$2")


def page_tags(vis) -> Column:
    """The telling tags of :func:`visible_html` in document order, in one pass:
    ``array<struct<name, value, rel, text>>``.  ``value`` is what the tag is read for (``href``
    of a, area and base, ``hreflang`` of link, ``type`` of script), ``text`` the markup inside
    a link; references in attributes are decoded."""
    telling = F.filter(F.regexp_extract_all(U._c(vis), F.lit(_TELLING), 1), lambda m: m != "")
    split = F.transform(telling, lambda m: F.struct(
        F.lower(F.regexp_extract(m, "(?i)^<([a-z]+)", 1)).alias("name"), F.regexp_extract(m, _HEAD, 1).alias("head"),
        F.regexp_replace(m, _HEAD, "").alias("text")))

    def read(t):
        value = F.when(t["name"] == "link", _attr(t["head"], "hreflang")).when(t["name"] == "script", _attr(t["head"], "type")) \
                 .otherwise(_attr(t["head"], "href"))
        both = F.transform(F.array(value, _attr(t["head"], "rel")), lambda v: html_unescape(v, attribute=True))
        return L.let(both, lambda v: F.struct(t["name"].alias("name"), v[0].alias("value"), v[1].alias("rel"), t["text"].alias("text")))

    return F.transform(split, read)


def _words(c: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")), " ")


def page_title(vis) -> Column:
    """PX-2: first <title> of :func:`visible_html`, entity-decoded, stripped, 500 chars, '' -> NULL."""
    t = F.regexp_extract(U._c(vis), r"(?is)<title(?=[\s/>])" + _ATTRS + _END + r"(.*?)(?:</title|\z)", 1)
    t = F.substring(_strip(html_unescape(t)), 1, TITLE_MAX)
    return F.nullif(t, F.lit(""))


def hreflang_count(tags) -> Column:
    """PX-3: <link> tags with rel token 'alternate' and an hreflang attribute."""
    return F.size(F.filter(U._c(tags), lambda t: (t["name"] == "link") & t["value"].isNotNull() & F.array_contains(_words(t["rel"]), "alternate")))


def has_json_ld(tags) -> Column:
    """PX-4: any <script type="application/ld+json">."""
    return F.exists(U._c(tags), lambda t: (t["name"] == "script") & (F.lower(F.trim(F.coalesce(t["value"], F.lit("")))) == "application/ld+json"))


def base_url(page_url, tags) -> Column:
    """Document base: the first <base href> resolved against the page URL, else the URL."""
    page_url = U._c(page_url)
    bases = F.filter(U._c(tags), lambda t: (t["name"] == "base") & t["value"].isNotNull())
    return L.let(F.get(bases, F.lit(0))["value"], lambda href: F.when(
        href.isNotNull() & (F.trim(href) != ""), U.resolve_url(page_url, _strip(href))).otherwise(page_url))


def _raw_links(tags: Column, base: Column) -> Column:
    """All <a>/<area> links with an href, in document order, as
    ``array<struct<pos, url, anchor, nofollow>>`` (url absolute, not yet
    canonical).  ``tags`` are :func:`page_tags`, ``base`` the base URL."""
    links = F.filter(tags, lambda t: t["name"].isin("a", "area") & t["value"].isNotNull())
    return L.let(U.base_parts(base), lambda p: F.transform(links, lambda t, i: F.struct(
        (i + 1).alias("pos"),
        L.let(F.trim(F.regexp_replace(t["value"], r"[\t\n\r\f]", "")), lambda r: U.resolve_with(p, r)).alias("url"),
        _strip(html_unescape(F.regexp_replace(t["text"], _TAG, ""))).alias("anchor"),
        F.array_contains(_words(F.regexp_replace(t["rel"], ",", " ")), "nofollow").alias("nofollow"))))


def _sorted_by_key(links: Column, key: str = "url") -> Column:
    return F.array_sort(F.transform(links, lambda x: F.struct(x[key].alias("k"), x["pos"].alias("p"), x.alias("v"))))


def _first_per_key(by_key: Column) -> Column:
    """Given links sorted by (key, pos), keep group heads in position order.
    ``by_key`` must be a materialised column (it is referenced twice)."""
    prev = F.concat(F.array(F.lit(None).cast("string")), F.transform(by_key, lambda x: x["k"]))
    heads = F.filter(F.zip_with(by_key, prev, lambda cur, pk: F.struct(cur.alias("c"), pk.alias("pk"))),
                     lambda z: z["c"].isNotNull() & (z["pk"].isNull() | (z["c"]["k"] != z["pk"])))
    by_pos = F.array_sort(F.transform(heads, lambda z: F.struct(z["c"]["p"].alias("p"), z["c"]["v"].alias("v"))))
    return F.transform(by_pos, lambda x: x["v"])


def with_outlinks(df: DataFrame, page_url: str, tags: str, out: str = "outlinks",
                  deny_extensions=IGNORED_EXTENSIONS, *, rules: U.SuffixRules | None, max_url_len: int = U.MAX_URL_LEN) -> DataFrame:
    """PX-1: add ``array<struct<url, domain, anchor>>`` of followable links:
    scheme allowed, extension not denied, canonicalised, first occurrence of
    each canonical URL, nofollow dropped, <= 2500 characters, anchor stripped
    and cut to 200 characters.  ``tags`` are :func:`page_tags`.  Staged projections
    keep every intermediate array computed once per row."""
    deny = F.array(*[F.lit(e) for e in deny_extensions])
    tmp = "__lk"
    staged = df.withColumn("__base", base_url(page_url, tags))
    staged = staged.withColumn(tmp, _raw_links(F.col(tags), F.col("__base"))).drop("__base")
    staged = staged.withColumn(tmp, F.transform(
        F.filter(F.col(tmp), lambda x: F.lower(U.url_part(x["url"], "scheme")).isin(*LINK_SCHEMES)
                 & ~F.array_contains(deny, U.url_extension(x["url"]))),
        lambda x: x.withField("url", U.canonicalize_url(x["url"]))))
    staged = staged.withColumn(tmp, _sorted_by_key(F.col(tmp)))
    staged = staged.withColumn(tmp, _first_per_key(F.col(tmp)))
    return staged.withColumn(out, F.transform(
        F.filter(F.col(tmp), lambda x: (~x["nofollow"]) & (F.length(x["url"]) <= max_url_len)),
        lambda x: F.struct(x["url"].alias("url"),
                           spider_domain(U.host_of(x["url"]), rules).alias("domain"),
                           F.substring(x["anchor"], 1, ANCHOR_MAX).alias("anchor")))).drop(tmp)


def spider_domain(host, rules: U.SuffixRules | None) -> Column:
    """Fetcher-side domain: eTLD+1, or the host when it has no known suffix."""
    return F.coalesce(U.registrable_domain(host, rules), U._c(host))


def is_html(content_type) -> Column:
    """PX-5: content-type gate."""
    ct = F.lower(F.coalesce(U._c(content_type), F.lit("")))
    return F.exists(F.array(*[F.lit(t) for t in ACCEPTED_CONTENT_TYPES]), lambda t: F.instr(ct, t) > 0)


def extract_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  content_type_col: str | None = None, fetched_at: Column | None = None,
                  keep: tuple[str, ...] = (), *, rules: U.SuffixRules | None,
                  deny_extensions=IGNORED_EXTENSIONS) -> DataFrame:
    """PX-1..PX-6: build crawl-result records from raw pages.

    Output columns follow the crawl record contract: url (canonical), domain,
    fetched_at, status (ok iff content non-empty), fail_reason, content,
    outlinks, title, hreflang_count, has_json_ld (+ ``keep`` columns).
    """
    html = F.col(html_col)
    gate = is_html(F.col(content_type_col)) if content_type_col else F.lit(True)
    staged = pages.select(
        *[F.col(k) for k in keep], F.col(url_col).alias("__page_url"), html.alias("__html"),
        gate.alias("__gate"))
    staged = staged.withColumn("__vis", F.when(F.col("__gate"), visible_html(F.col("__html"))))
    staged = staged.withColumn("__tags", page_tags("__vis"))
    staged = with_outlinks(staged, "__page_url", "__tags", "__outlinks", deny_extensions, rules=rules)
    staged = staged.withColumn("__url", U.canonicalize_url(F.col("__page_url")))
    url = F.col("__url")
    g = F.col("__gate")
    return staged.select(
        *[F.col(k) for k in keep],
        url.alias("url"),
        spider_domain(U.host_of(url), rules).alias("domain"),
        (fetched_at if fetched_at is not None else F.lit(None).cast("string")).alias("fetched_at"),
        F.when(g & (F.length(F.coalesce(F.col("__html"), F.lit(""))) > 0), F.lit("ok")).otherwise(F.lit("fail")).alias("status"),
        F.when(~g, F.lit(NON_HTML_REASON)).alias("fail_reason"),
        F.when(g, F.col("__html")).alias("content"),
        F.coalesce(F.col("__outlinks"),
                   F.array().cast("array<struct<url:string,domain:string,anchor:string>>")).alias("outlinks"),
        F.when(g, page_title("__vis")).alias("title"),
        F.when(g, hreflang_count("__tags")).otherwise(F.lit(0)).alias("hreflang_count"),
        F.when(g, has_json_ld("__tags")).otherwise(F.lit(False)).alias("has_json_ld"),
    )


def basic_features(records: DataFrame, *keep: str) -> DataFrame:
    """PX-7: content_length (characters), content_hash, num_links of ok records, and columns to ``keep``."""
    return (records.filter(F.col("status") == "ok")
            .select("url", "shard_id", "domain_id",
                    F.col("fetched_at").alias("fetched_at"),
                    F.length(F.coalesce(F.col("content"), F.lit(""))).alias("content_length"),
                    "content_hash",
                    F.size(F.coalesce(F.col("outlinks"), F.array())).alias("num_links"), *keep))
