"""URL, host, domain and shard Column functions.

Everything here is a plain Column expression built from Spark built-ins, so it
stays inside whole-stage codegen and needs no shuffle.  URLs are split with one
RFC-3986 style regular expression that follows Python's ``urlsplit`` rules
(scheme must start with a letter; netloc only after ``//``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import LookupTable, let

# Groups of the URL split regex are 1 scheme, 2 netloc, 3 path,
# 4 query, 5 fragment.
URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# URL length cap (characters) used by the pipeline.
MAX_URL_LEN = 2500


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_url(url) -> Column:
    """Strip leading C0/space characters and remove tab/CR/LF, as urlsplit does."""
    u = _c(url)
    return F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def url_part(url, part: str) -> Column:
    """One part of a URL: scheme | netloc | path | query | fragment ("" if absent)."""
    idx = {"scheme": 1, "netloc": 2, "path": 3, "query": 4, "fragment": 5}[part]
    return F.regexp_extract(clean_url(url), URL_RE, idx)


def has_netloc(url) -> Column:
    return clean_url(url).rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")


def _hostname_of_netloc(netloc: Column) -> Column:
    hostinfo = F.substring_index(netloc, "@", -1)
    return F.when(hostinfo.contains("["), F.regexp_extract(hostinfo, r"\[([^\]]*)", 1)) \
            .otherwise(F.substring_index(hostinfo, ":", 1))


def host_of(url) -> Column:
    """SC-1: lower-case hostname of a URL, "" when there is none (userinfo and
    port stripped, IPv6 brackets removed)."""
    def body(u):
        h = F.lower(_hostname_of_netloc(url_part(u, "netloc")))
        return F.when(u.isNull() | (u == ""), F.lit("")).otherwise(F.coalesce(h, F.lit("")))
    return let(url, body)


def host_extract_sql(url) -> Column:
    """SC-2: ``LOWER(SUBSTRING(url FROM '^https?://([^/:]+)'))``, NULL on no match."""
    return F.nullif(F.lower(F.regexp_extract(_c(url), r"^https?://([^/:]+)", 1)), F.lit(""))


def normalize_domain(d) -> Column:
    """SC-11: trim + lower, "" for NULL."""
    return F.lower(F.trim(F.coalesce(_c(d), F.lit(""))))


def domain_of(url) -> Column:
    """SC-11: normalised hostname of a URL."""
    return normalize_domain(host_of(url))


def tld_of(domain) -> Column:
    """SC-12: last dot-separated label."""
    return F.element_at(F.split(_c(domain), r"\."), -1)


def normalize_url(url) -> Column:
    """SC-10: http(s) only, lower scheme and host, port/userinfo/fragment dropped,
    empty path -> '/', query kept; "" when not normalisable."""
    raw = F.trim(F.coalesce(_c(url).cast("string"), F.lit("")))
    scheme = F.lower(url_part(raw, "scheme"))
    host = F.lower(_hostname_of_netloc(url_part(raw, "netloc")))
    path = url_part(raw, "path")
    query = url_part(raw, "query")
    out = F.concat(scheme, F.lit("://"), host,
                   F.when(path == "", F.lit("/")).otherwise(path),
                   F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    ok = (raw != "") & scheme.isin("http", "https") & has_netloc(raw) & (host != "")
    return F.when(ok, out).otherwise(F.lit(""))


def _path_no_params(url) -> Column:
    # urlparse (not urlsplit) removes ";params" of the last path segment
    return F.regexp_replace(url_part(url, "path"), r";[^/]*$", "")


def tokenize_url(url) -> Column:
    """SC-13: lower-cased ``[A-Za-z0-9]+`` tokens of netloc, path and query."""
    raw = F.concat_ws(" ", url_part(url, "netloc"), _path_no_params(url), url_part(url, "query"))
    return F.transform(F.regexp_extract_all(raw, F.lit(r"[A-Za-z0-9]+"), 0), lambda t: F.lower(t))


def path_depth(url) -> Column:
    """SC-14: number of non-empty path segments."""
    return F.size(F.filter(F.split(_path_no_params(url), "/"), lambda s: s != ""))


# Word lists of the URL bucket key.
ARTICLE_WORDS = ["article", "articles", "news", "story", "stories"]
SPORTS_WORDS = ["nba", "mlb", "nhl", "score", "scores", "match", "game", "team", "player"]
ENTITY_WORDS = ["person", "actor", "artist", "player", "team"]


def _any_token(tokens: Column, words: list[str]) -> Column:
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in words])).cast("int")


def bucket_key(url) -> Column:
    """SC-15: ``depth=d|query=q|num=n|article=a|sports=s|entity=e``."""
    u = _c(url)
    toks = tokenize_url(u)
    depth = F.least(path_depth(u), F.lit(6))
    has_q = u.contains("?").cast("int")
    has_num = F.exists(toks, lambda t: t.rlike("^[0-9]+$")).cast("int")
    return F.concat(
        F.lit("depth="), depth.cast("string"), F.lit("|query="), has_q.cast("string"),
        F.lit("|num="), has_num.cast("string"),
        F.lit("|article="), _any_token(toks, ARTICLE_WORDS).cast("string"),
        F.lit("|sports="), _any_token(toks, SPORTS_WORDS).cast("string"),
        F.lit("|entity="), _any_token(toks, ENTITY_WORDS).cast("string"),
    )


@dataclass(frozen=True)
class UrlParts:
    """Parts of a URL as columns of their own, so that each is cut out once however much is made of
    it (SC-11 and SC-13..SC-15 by plain string functions, with the values of the functions above)."""

    netloc: Column
    path: Column
    bare_path: Column   # without ;params of the last segment
    words: Column       # netloc, path and query, where the tokens are

    def domain(self) -> Column:
        odd = self.netloc.contains("@") | self.netloc.contains("[")
        return normalize_domain(F.when(odd, _hostname_of_netloc(self.netloc)).otherwise(F.substring_index(self.netloc, ":", 1)))

    def depth(self) -> Column:
        p = self.bare_path
        slashes = F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))
        return (F.when(p.contains("//"), F.regexp_count(p, F.lit("[^/]+"))).when(p == "", F.lit(0))
                .otherwise(slashes + 1 - p.startswith("/").cast("int") - p.endswith("/").cast("int")))

    def token_count(self) -> Column:
        return F.regexp_count(self.words, F.lit("[A-Za-z0-9]+"))

    def _has_token(self, pattern: str) -> Column:
        return self.words.rlike(rf"(?i)(?:^|[^A-Za-z0-9])(?:{pattern})(?:[^A-Za-z0-9]|\z)")

    def bucket(self, url) -> Column:
        any_word = self._has_token("|".join(sorted({*ARTICLE_WORDS, *SPORTS_WORDS, *ENTITY_WORDS})))
        has = lambda words: self._has_token("|".join(words)).cast("int").cast("string")
        words = F.when(any_word, F.concat(F.lit("|article="), has(ARTICLE_WORDS), F.lit("|sports="), has(SPORTS_WORDS), F.lit("|entity="), has(ENTITY_WORDS)))
        return F.concat(
            F.lit("depth="), F.least(self.depth(), F.lit(6)).cast("string"), F.lit("|query="), _c(url).contains("?").cast("int").cast("string"),
            F.lit("|num="), self._has_token("[0-9]+").cast("int").cast("string"), F.coalesce(words, F.lit("|article=0|sports=0|entity=0")))


def with_parts(df: DataFrame, url: str) -> tuple[DataFrame, UrlParts]:
    """``df`` with the parts of its URLs, one projection after the other; http(s) URLs, all but a
    few, are cut without the regular expression."""
    bare = F.ltrim(F.col(url), F.lit("".join(map(chr, range(33)))))   # as clean_url
    broken = bare.contains("\t") | bare.contains("\r") | bare.contains("\n")
    df = df.withColumn("__clean", F.when(broken, F.translate(bare, "\t\r\n", "")).otherwise(bare))
    clean = F.col("__clean")
    skip = F.when(clean.startswith("https://"), 8).when(clean.startswith("http://"), 7)
    df = df.select("*", F.substring_index("__clean", "#", 1).alias("__whole"), skip.alias("__skip"))
    df = df.select("*", F.substring_index("__whole", "?", 1).alias("__head"))
    part = lambda k: F.regexp_extract("__clean", URL_RE, k)
    from_ = lambda c, start: F.substring(F.col(c), start, F.length(c))
    netloc = F.when(F.col("__skip").isNull(), part(2)).otherwise(F.substring_index(from_("__head", F.col("__skip") + 1), "/", 1))
    df = df.withColumn("__netloc", netloc)
    df = df.select("*", F.when(F.col("__skip").isNull(), part(3)).otherwise(from_("__head", F.col("__skip") + F.length("__netloc") + 1)).alias("__path"),
                   from_("__whole", F.length("__head") + 2).alias("__query"))
    df = df.withColumn("__bare", F.when(F.col("__path").contains(";"), F.regexp_replace("__path", r";[^/]*$", "")).otherwise(F.col("__path")))
    df = df.withColumn("__words", F.concat_ws(" ", "__netloc", "__bare", "__query")).drop("__query", "__clean", "__whole", "__skip", "__head")
    return df, UrlParts(F.col("__netloc"), F.col("__path"), F.col("__bare"), F.col("__words"))


# --------------------------------------------------------------------------
# Registrable domain (eTLD+1) from public-suffix rules (SC-3)
# --------------------------------------------------------------------------

class SuffixRules:
    """Public-suffix rules as normal / wildcard / exception sets.

    The rules are a reference table that the caller gives whole (the public
    list has about 10k entries): there is no default, since a cut list merges
    unrelated sites into one key.  They travel inside the plan as one bucketed
    literal, so a lookup costs the same for 100 and for 10,000 rules, with no
    join and no shuffle.
    """

    NORMAL, WILDCARD, EXCEPTION = 1, 2, 4

    def __init__(self, normal: Iterable[str] = (), wildcard: Iterable[str] = (),
                 exception: Iterable[str] = ()):
        codes: dict[str, int] = {}
        for bit, items in ((self.NORMAL, normal), (self.WILDCARD, wildcard), (self.EXCEPTION, exception)):
            for s in items:
                s = s.strip().lower().strip(".")
                if s:
                    codes[s] = codes.get(s, 0) | bit
        if not codes:
            raise ValueError("the suffix rule table is empty")
        self.codes = codes
        self.table = LookupTable(codes, "int")

    @classmethod
    def from_lines(cls, lines: Iterable[str]) -> "SuffixRules":
        """Parse public-suffix-list text lines (``//`` comments, ``*.x``, ``!x``)."""
        normal, wild, exc = [], [], []
        for line in lines:
            line = line.strip().split()[0] if line.strip() else ""
            if not line or line.startswith("//"):
                continue
            if line.startswith("!"):
                exc.append(line[1:])
            elif line.startswith("*."):
                wild.append(line[2:])
            else:
                normal.append(line)
        return cls(normal, wild, exc)

    @classmethod
    def from_psl(cls, path: str) -> "SuffixRules":
        with open(path, encoding="utf-8") as fh:
            return cls.from_lines(fh)


def _need(rules: SuffixRules | None) -> SuffixRules:
    if rules is None:
        raise ValueError("pass the public-suffix rules (SuffixRules); there is no default list")
    return rules


def registrable_domain(host, rules: SuffixRules | None) -> Column:
    """SC-3: eTLD+1 of a lower-case host, NULL when the host has no known
    public suffix or is itself a public suffix."""
    rules = _need(rules)
    return let(host, lambda h: let(F.split(h, r"\."), lambda labels: _registrable(h, labels, rules)))


def _registrable(h: Column, labels: Column, rules: SuffixRules) -> Column:
    n = F.size(labels)
    idx = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    # rule bits of the suffix that starts at label i (1-based)
    bits = F.transform(idx, lambda i: F.coalesce(rules.table.get(F.array_join(F.slice(labels, i, n - i + 1), ".")), F.lit(0)))

    def found(codes: Column) -> Column:
        def has(i, bit):
            return F.coalesce(F.try_element_at(codes, i), F.lit(0)).bitwiseAND(bit) != 0

        starts = F.sequence(F.lit(1), F.size(codes))
        exc_start = F.array_min(F.filter(starts, lambda i: has(i, rules.EXCEPTION)))
        match_start = F.array_min(F.filter(starts, lambda i: has(i, rules.NORMAL) | has(i + 1, rules.WILDCARD)))
        return F.coalesce(exc_start + 1, match_start) - 1   # label before the public suffix

    return F.when(h.isNotNull() & (h != ""), let(let(bits, found), lambda reg: F.when(
        reg >= 1, F.array_join(F.slice(labels, reg, n - reg + 1), "."))))


def shard_key(host, split_hosts: Column | None = None, *, rules: SuffixRules | None) -> Column:
    """SC-4: whitelisted host -> itself; else eTLD+1; else the host;
    'unknown' for an empty host.  ``split_hosts`` is a boolean Column telling
    whether the host is on the split whitelist (see ``operators.routing``)."""
    def body(h):
        reg = F.coalesce(registrable_domain(h, rules), h)
        if split_hosts is not None:
            reg = F.when(F.coalesce(split_hosts, F.lit(False)), h).otherwise(reg)
        return F.when(h.isNull() | (h == ""), F.lit("unknown")).otherwise(reg)
    return let(host, body)


def md5_mod(key, n: int) -> Column:
    """``int(md5(key).hexdigest(), 16) % n`` exactly: Horner's rule over the
    eight 16-bit chunks of the 128-bit digest, reduced mod n at every step."""
    if not 0 < n < 2 ** 31:
        raise ValueError("n out of range")

    def horner(h):
        r = F.lit(0).cast("long")
        for i in range(8):
            chunk = F.conv(F.substring(h, i * 4 + 1, 4), 16, 10).cast("long")
            r = (r * F.lit(65536) + chunk) % F.lit(n)
        return r.cast("int")

    return let(F.md5(_c(key)), horner)


def shard_id(key, num_shards: int = 256, overrides: Mapping[str, int] | None = None) -> Column:
    """SC-5: override[key] if configured, else md5(key) mod n."""
    k = _c(key)
    base = md5_mod(k, num_shards)
    if overrides:
        m = F.create_map(*[x for kk, v in sorted(overrides.items()) for x in (F.lit(kk), F.lit(int(v)))])
        return F.coalesce(F.try_element_at(m, k), base).cast("int")
    return base


def ingestor_of(shard, shards_per_ingestor: int = 16) -> Column:
    """SC-6: ingestor owning a shard."""
    return F.floor(_c(shard) / F.lit(shards_per_ingestor)).cast("int")


def shard_in_range(shard, offerer_id: int, shards_per_offerer: int = 16) -> Column:
    """SC-6: the shard range ``[id*k, (id+1)*k)`` of one offerer."""
    lo = offerer_id * shards_per_offerer
    return (_c(shard) >= lo) & (_c(shard) < lo + shards_per_offerer)


def content_hash(status, content) -> Column:
    """SC-7: SHA-1 hex of the content, only for ok records."""
    return F.when((_c(status) == "ok") & _c(content).isNotNull(), F.sha1(_c(content)))


def anchor_hash(anchor) -> Column:
    """SC-8: md5 bytes of the anchor text (``md5_hex`` form: ``F.md5``)."""
    return F.unhex(F.md5(_c(anchor)))


# --------------------------------------------------------------------------
# Canonical URLs (SC-9) and link resolution
# --------------------------------------------------------------------------

# Characters kept as-is when re-quoting a path
# (RFC 3986 reserved + unreserved + '|' + '%', without '#').
PATH_SAFE = r"[A-Za-z0-9\-._~:/?\[\]@!$&'()*+,;=|%]"
# Characters kept as-is by form-encoding of query keys/values.
QUERY_SAFE = r"[A-Za-z0-9\-._~]"


def percent_encode(s, safe_class: str, space_plus: bool = False) -> Column:
    """Percent-encode every character outside ``safe_class`` as upper-case
    UTF-8 ``%XX`` (optionally space as '+')."""
    text = _c(s)
    chars = F.regexp_extract_all(text, F.lit("(?s)."), 0)

    def enc(ch):
        hexed = F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")
        if space_plus:
            hexed = F.when(ch == " ", F.lit("+")).otherwise(hexed)
        return F.when(ch.rlike("^" + safe_class + "$"), ch).otherwise(hexed)

    # most texts need nothing: only the others are taken apart
    return F.when(text.rlike("^" + safe_class + "*$"), text).otherwise(F.array_join(F.transform(chars, enc), ""))


def percent_decode(s, plus_space: bool = False) -> Column:
    """Decode ``%XX`` sequences as UTF-8; malformed input is returned as is."""
    c = _c(s)
    protected = c if plus_space else F.replace(c, F.lit("+"), F.lit("%2B"))
    protected = F.regexp_replace(protected, r"%(?![0-9A-Fa-f]{2})", "%25")
    coded = c.contains("%") | c.contains("+") if plus_space else c.contains("%")
    return F.when(coded, F.coalesce(F.try_url_decode(protected), c)).otherwise(c)


def _canonical_path(path: Column) -> Column:
    # keep %2F and %3F encoded, decode the rest, re-quote with the path-safe set
    kept = F.regexp_replace(path, r"%(2[Ff]|3[Ff])", "%25$1")
    decoded = percent_decode(kept)
    return percent_encode(decoded, PATH_SAFE)


def _canonical_query(query: Column) -> Column:
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    kv = F.transform(pairs, lambda p: F.struct(
        percent_decode(F.substring_index(p, "=", 1), plus_space=True).alias("k"),
        percent_decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1), plus_space=True).alias("v")))
    srt = F.array_sort(kv)
    enc = F.transform(srt, lambda e: F.concat(percent_encode(e["k"], QUERY_SAFE, True), F.lit("="),
                                              percent_encode(e["v"], QUERY_SAFE, True)))
    return F.array_join(enc, "&")


def canonicalize_url(url) -> Column:
    """SC-9: canonical form used for link identity: lower scheme and netloc,
    path percent-normalised ('/' when empty), query pairs decoded, sorted and
    re-encoded (blank values kept), fragment dropped."""
    return let(F.trim(_c(url)), _canonicalize)


def _canonicalize(u: Column) -> Column:
    scheme = F.lower(url_part(u, "scheme"))
    netloc = F.lower(url_part(u, "netloc"))
    rawpath = url_part(u, "path")
    params = F.regexp_extract(rawpath, r";([^/]*)$", 1)
    path = F.regexp_replace(rawpath, r";[^/]*$", "")
    cpath = _canonical_path(path)
    cpath = F.when(cpath == "", F.lit("/")).otherwise(cpath)
    q = _canonical_query(url_part(u, "query"))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(has_netloc(u), F.concat(F.lit("//"), netloc)).otherwise(F.lit("")),
        cpath,
        F.when(params != "", F.concat(F.lit(";"), params)).otherwise(F.lit("")),
        F.when(q != "", F.concat(F.lit("?"), q)).otherwise(F.lit("")),
    )


def resolve_url(base, ref) -> Column:
    """RFC 3986 reference resolution (``urljoin``) for the common forms:
    absolute (with scheme), network-path (``//h``), absolute-path (``/p``),
    query-only, fragment-only and relative paths (with dot-segment removal)."""
    return let(base_parts(base), lambda p: let(F.trim(_c(ref)), lambda r: resolve_with(p, r)))


def base_parts(base) -> Column:
    """What resolving needs of a base URL, to be worked out once per page."""
    b = _c(base)
    path = url_part(b, "path")
    folder = F.split(F.regexp_replace(path, r"[^/]*$", ""), "/")
    query = F.when(b.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), url_part(b, "query"))).otherwise(F.lit(""))
    return F.struct(url_part(b, "scheme").alias("scheme"), F.concat(url_part(b, "scheme"), F.lit("://"), url_part(b, "netloc")).alias("prefix"),
                    path.alias("path"), query.alias("query"), F.slice(folder, 1, F.greatest(F.size(folder) - 1, F.lit(1))).alias("folder"))


def resolve_with(p: Column, r: Column) -> Column:
    """:func:`resolve_url` of a trimmed reference against :func:`base_parts`."""
    r_has_scheme = r.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:")
    r_path = F.regexp_extract(r, r"^([^?#]*)", 1)
    # segments of the base folder and of the reference; empty ones between them are dropped
    joined = let(F.concat(p["folder"], F.split(r_path, "/")), lambda s: F.concat(
        F.slice(s, 1, 1), F.filter(F.slice(s, 2, F.greatest(F.size(s) - 2, F.lit(0))), lambda x: x != ""), F.slice(s, -1, 1)))
    r_tail = F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
    base_no_frag = F.concat(p["prefix"], p["path"], p["query"])
    return (F.when(r == "", base_no_frag)
            .when(r_has_scheme, r)
            .when(r.startswith("//"), F.concat(p["scheme"], F.lit(":"), r))
            .when(r.startswith("/"), F.concat(p["prefix"], _remove_dot_segments(F.split(r_path, "/")), r_tail))
            .when(r.startswith("?"), F.concat(p["prefix"], p["path"], r))
            .when(r.startswith("#"), F.concat(base_no_frag, r))
            .otherwise(F.concat(p["prefix"], _remove_dot_segments(joined), r_tail)))


def _remove_dot_segments(segments: Column) -> Column:
    """Path of the segments with ``.`` and ``..`` folded away: a stack, any number of them."""
    def fold(stack, s):
        return (F.when(s == "..", F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))))
                .when(s == ".", stack).otherwise(F.concat(stack, F.array(s))))

    def path(s):
        kept = F.aggregate(s, F.array().cast("array<string>"), fold)
        ends = F.element_at(s, -1).isin(".", "..")
        text = F.concat(F.array_join(kept, "/"), F.when(ends & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit("")))
        return let(text, lambda t: F.when(t.startswith("/"), t).otherwise(F.concat(F.lit("/"), t)))

    return let(segments, path)


def url_extension(url) -> Column:
    """Lower-case extension of the last path segment ('' if none)."""
    last = F.element_at(F.split(url_part(url, "path"), "/"), -1)
    return F.when(last.contains("."), F.lower(F.element_at(F.split(last, r"\."), -1))).otherwise(F.lit(""))
