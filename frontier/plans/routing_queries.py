"""Queries for routing (RJ-1..RJ-5, SC-7, PX-7) over extracted pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pages as PX
from ..operators import routing as RT
from ..session import cut_lineage
from . import fixtures as FX
from . import sqlfrag as Q
from .registry import ORACLES, register, table

_PAGE_URL = """lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1))
    || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([^?#]*)', 1)
    || CASE WHEN regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) <> '' THEN '?' || array_to_string(list_sort(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&')), '&') ELSE '' END"""


def _routed(spark, sf_dir):
    """Pages extracted once (a written stage, as crawl records are in their files), then routed."""
    recs = cut_lineage(PX.extract_pages(table(spark, sf_dir, "pages"), keep=("page_id",), rules=FX.SUFFIX_RULES))
    return RT.route_results(recs, FX.f5_domain_state(spark, sf_dir), ["page_id"], rules=FX.SUFFIX_RULES)


_KEYS = f"""
dom AS ({FX.F5_SQL}),
pg AS (SELECT page_id, {_PAGE_URL} AS purl, html FROM pages),
pl AS ({ORACLES['page_outlinks']}),
src AS (SELECT page_id, purl, {Q.shard_key(Q.host('purl'))} AS k FROM pg),
dst AS (SELECT page_id, link_url, anchor, link_pos, {Q.shard_key(Q.host('link_url'))} AS k FROM pl),
allk AS (SELECT k FROM src UNION SELECT k FROM dst),
newk AS (SELECT k, row_number() OVER (ORDER BY CAST(('0x' || right(md5(k), 2)) AS INTEGER), k) AS rn
         FROM allk WHERE k NOT IN (SELECT domain FROM dom)),
reg AS (SELECT domain AS k, domain_id, domain_score FROM dom
        UNION ALL SELECT k, CAST((SELECT max(domain_id) FROM dom) + rn AS BIGINT), 0.0 FROM newk)
"""


@register("route_results", oracle=f"""
WITH {_KEYS}
SELECT s.purl AS url, {Q.shard256('s.k')} AS shard_id, CAST({Q.shard256('s.k')} // 16 AS INTEGER) AS ingestor_id,
  r.domain_id, CASE WHEN length(coalesce(pg.html, '')) > 0 THEN sha1(pg.html) END AS content_hash,
  CAST((SELECT count(*) FROM pl WHERE pl.page_id = s.page_id) AS INTEGER) AS n_outlinks
FROM src s JOIN pg USING (page_id) JOIN reg r ON r.k = s.k
""")
def route_results(spark, sf_dir):
    """RJ-3 / RJ-1 / SC-7: routed crawl results (shard, ingestor, registry
    domain id, content hash, resolved outlinks)."""
    routed, _, _ = _routed(spark, sf_dir)
    return routed.select("url", "shard_id", "ingestor_id", "domain_id", "content_hash",
                         F.size("outlinks").alias("n_outlinks"))


@register("route_links", headline=True, oracle=f"""
WITH {_KEYS}
SELECT d.link_url AS url, s.purl AS discovered_from, {Q.shard256('d.k')} AS shard_id, r.domain_id,
  r.domain_score, rs.domain_score AS parent_page_score, CAST(s.k <> d.k AS INTEGER) AS inlink_count_external,
  d.anchor AS anchor_text
FROM dst d JOIN src s USING (page_id) JOIN reg r ON r.k = d.k JOIN reg rs ON rs.k = s.k
""")
def route_links(spark, sf_dir):
    """RJ-4: one ``new`` link record per outlink (target shard / domain /
    score, source-domain score as parent score, external flag)."""
    _, links, _ = _routed(spark, sf_dir)
    return links.select("url", "discovered_from", "shard_id", "domain_id", "domain_score", "parent_page_score",
                        "inlink_count_external", "anchor_text")


@register("domain_registry", oracle=f"""
WITH {_KEYS}
SELECT k AS domain, domain_id FROM reg
""")
def domain_registry(spark, sf_dir):
    """RJ-1: registry after get-or-create of every routed domain key."""
    _, _, reg = _routed(spark, sf_dir)
    return reg.select("domain", "domain_id")


@register("registry_reshard", oracle=f"""
WITH dom AS ({FX.F5_SQL})
SELECT domain, domain_id, CASE WHEN domain_id % 4 = 0 THEN CAST((shard_id + 1) % 256 AS INTEGER) ELSE shard_id END AS shard_id
FROM dom
""")
def registry_reshard(spark, sf_dir):
    """RJ-2: get-or-create where a conflict overwrites the stored shard."""
    dom = FX.f5_domain_state(spark, sf_dir)
    keys = dom.filter(F.col("domain_id") % 4 == 0).select("domain", ((F.col("shard_id") + 1) % 256).cast("int").alias("shard_id"))
    reg, _ = RT.resolve_domains(dom, keys, overwrite_shard=True)
    return reg.select("domain", "domain_id", "shard_id")


@register("content_features", oracle=f"""
WITH {_KEYS}
SELECT s.purl AS url, r.domain_id, CAST(length(pg.html) AS INTEGER) AS content_length, sha1(pg.html) AS content_hash,
  CAST((SELECT count(*) FROM pl WHERE pl.page_id = s.page_id) AS INTEGER) AS num_links
FROM src s JOIN pg USING (page_id) JOIN reg r ON r.k = s.k WHERE length(coalesce(pg.html, '')) > 0
""")
def content_features(spark, sf_dir):
    """PX-7: basic content features of ok routed results."""
    routed, _, _ = _routed(spark, sf_dir)
    return PX.basic_features(routed).select("url", "domain_id", "content_length", "content_hash", "num_links")
