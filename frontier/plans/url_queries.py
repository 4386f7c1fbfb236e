"""Queries for URL / host / shard functions (SC-1..SC-15) over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators.routing import with_shard_columns
from . import fixtures as FX
from . import sqlfrag as Q
from .registry import register, table


def pages_host_shard_counts(spark, sf_dir):
    """Flagship: pages -> host -> shard key -> shard id -> ingestor, with the
    page count per host (SC-1, SC-3..SC-6, AG-8).  One scan, one shuffle."""
    pages = table(spark, sf_dir, "pages").select("url")
    routed = with_shard_columns(pages, "url", rules=FX.SUFFIX_RULES)
    return (routed.groupBy("host", "shard_key", "shard_id", "ingestor_id")
            .agg(F.count(F.lit(1)).alias("n_pages")))


register("host_shard_counts", headline=True, oracle=f"""
WITH p AS (SELECT {Q.host('url')} AS host FROM pages),
k AS (SELECT host, {Q.shard_key('host')} AS shard_key FROM p)
SELECT host, shard_key, {Q.shard256('shard_key')} AS shard_id,
       CAST({Q.shard256('shard_key')} // 16 AS INTEGER) AS ingestor_id,
       CAST(count(*) AS BIGINT) AS n_pages
FROM k GROUP BY ALL
""")(pages_host_shard_counts)


@register("shard_page_counts", oracle=f"""
WITH k AS (SELECT {Q.shard_key(Q.host('url'))} AS shard_key FROM pages)
SELECT {Q.shard256('shard_key')} AS shard_id, CAST(count(DISTINCT shard_key) AS BIGINT) AS n_keys,
       CAST(count(*) AS BIGINT) AS n_pages
FROM k GROUP BY 1
""")
def shard_page_counts(spark, sf_dir):
    """Per-shard page and shard-key counts (SC-5 distribution, AG-10 shape)."""
    routed = with_shard_columns(table(spark, sf_dir, "pages").select("url"), "url", rules=FX.SUFFIX_RULES)
    return routed.groupBy("shard_id").agg(F.countDistinct("shard_key").alias("n_keys"),
                                          F.count(F.lit(1)).alias("n_pages"))


@register("url_host_sql", oracle="""
SELECT page_id, nullif(lower(regexp_extract(url, '^https?://([^/:]+)', 1)), '') AS host_sql FROM pages
""")
def url_host_sql(spark, sf_dir):
    """SC-2: the SQL host-extract expression."""
    return table(spark, sf_dir, "pages").select("page_id", U.host_extract_sql("url").alias("host_sql"))


@register("url_normalize", oracle=f"""
WITH p AS (SELECT page_id, url, {Q.host('url')} AS host,
  lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)) AS scheme,
  regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path,
  regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query FROM pages)
SELECT page_id,
  CASE WHEN scheme IN ('http','https') AND host <> '' THEN
    scheme || '://' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query <> '' THEN '?' || query ELSE '' END
  ELSE '' END AS norm_url,
  lower(trim(host)) AS domain,
  split_part(lower(trim(host)), '.', -1) AS tld
FROM p
""")
def url_normalize(spark, sf_dir):
    """SC-10..SC-12: normalised URL, domain and TLD."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", U.normalize_url("url").alias("norm_url"),
                    U.domain_of("url").alias("domain"), U.tld_of(U.domain_of("url")).alias("tld"))


@register("url_tokens", oracle="""
WITH p AS (SELECT page_id, url,
  regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1) AS netloc,
  regexp_replace(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', '') AS path,
  regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS query FROM pages),
t AS (SELECT page_id, url, path,
  list_transform(regexp_extract_all(concat_ws(' ', netloc, path, query), '[A-Za-z0-9]+'), lambda x: lower(x)) AS toks FROM p)
SELECT page_id, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS INTEGER) AS n_tokens,
  CAST(len(list_filter(string_split(path, '/'), lambda s: s <> '')) AS INTEGER) AS depth,
  'depth=' || least(len(list_filter(string_split(path, '/'), lambda s: s <> '')), 6)
  || '|query=' || CASE WHEN contains(url, '?') THEN 1 ELSE 0 END
  || '|num=' || CASE WHEN len(list_filter(toks, lambda x: regexp_full_match(x, '[0-9]+'))) > 0 THEN 1 ELSE 0 END
  || '|article=' || CASE WHEN len(list_intersect(toks, ['article','articles','news','story','stories'])) > 0 THEN 1 ELSE 0 END
  || '|sports=' || CASE WHEN len(list_intersect(toks, ['nba','mlb','nhl','score','scores','match','game','team','player'])) > 0 THEN 1 ELSE 0 END
  || '|entity=' || CASE WHEN len(list_intersect(toks, ['person','actor','artist','player','team'])) > 0 THEN 1 ELSE 0 END AS bucket
FROM t
""")
def url_tokens(spark, sf_dir):
    """SC-13..SC-15: URL tokens, path depth and bucket key."""
    p = table(spark, sf_dir, "pages")
    toks = U.tokenize_url("url")
    return p.select("page_id", F.array_join(toks, " ").alias("tokens"), F.size(toks).alias("n_tokens"),
                    U.path_depth("url").alias("depth"), U.bucket_key("url").alias("bucket"))
