"""Queries for the domain migration jobs (RK-3, RK-4, RK-5, RK-7, UM-14, AG-13).

Stand-in input F13: a registry of registrable domains and subdomains from ``customer``; URL
state, counters, features, history and daily stats from ``orders``, where a URL occurs under
several domains and shards, so that moved rows meet rows of their target."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as SC
from ..operators import migrate as MG
from ..operators import rekey as RK
from . import fixtures as FX
from .registry import register, table

OVERRIDES = {"s3.com": 7, "h40.s3.com": 9, "s25.com": 11, "unknown.com": 1}

_REG_SQL = """
SELECT CAST(c_custkey + 1 AS BIGINT) AS domain_id, CASE WHEN c_custkey < 20 THEN 's' || c_custkey || '.com'
    WHEN c_custkey % 50 = 49 THEN 'read more ' || c_custkey ELSE 'h' || c_custkey || '.s' || (c_custkey % 37) || '.com' END AS domain,
  CAST(c_custkey % 256 AS INTEGER) AS shard_id, c_acctbal / 10000 AS domain_score FROM customer
"""
_STATE_SQL = """
SELECT url, domain_id, shard_id, title, source, robots_bits, inlink_count_approx, num_fetch_ok_90d, anchor_text, o_orderkey, o_orderdate FROM (
  SELECT 'https://x.com/' || (o_orderkey % 1500) AS url, CAST(o_custkey + 1 AS BIGINT) AS domain_id, CAST(o_custkey % 256 AS INTEGER) AS shard_id,
    CASE WHEN o_orderkey % 3 > 0 THEN 't' || (o_orderkey % 11) END AS title, CAST(o_orderkey % 2 AS SMALLINT) AS source, CAST(o_orderkey % 3 AS SMALLINT) AS robots_bits,
    CAST(o_orderkey % 7 AS INTEGER) AS inlink_count_approx, CAST(o_orderkey % 13 AS INTEGER) AS num_fetch_ok_90d,
    CASE WHEN o_orderkey % 4 > 0 THEN 'a' || (o_orderkey % 5) END AS anchor_text, o_orderkey, o_orderdate,
    row_number() OVER (PARTITION BY o_orderkey % 1500, o_custkey % 256 ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1
"""
_COUNTER_SQL = """
SELECT url, DATE '2024-01-01' + CAST(o_orderkey % 2 AS INTEGER) + CAST(d AS INTEGER) AS event_date, CAST(o_orderkey % 5 AS INTEGER) AS num_fetch_ok,
  CAST(o_orderkey % 3 AS INTEGER) AS num_fetch_fail, (o_orderkey + d) % 2 = 0 AS accounted, shard_id FROM st, (SELECT unnest([0, 1]) AS d)
"""
_STATS_SQL = """
SELECT domain_id, DATE '2024-01-01' + CAST(domain_id % 2 AS INTEGER) AS event_date, shard_id, domain_id % 9 AS num_fetch_ok,
  'r' || (domain_id % 3) AS reason, domain_id AS n FROM reg
"""


def _registry(spark, sf_dir):
    k = F.col("c_custkey")
    text = k.cast("string")
    domain = (F.when(k < 20, F.concat(F.lit("s"), text, F.lit(".com"))).when(k % 50 == 49, F.concat(F.lit("read more "), text))
              .otherwise(F.concat(F.lit("h"), text, F.lit(".s"), (k % 37).cast("string"), F.lit(".com"))))
    rows = table(spark, sf_dir, "customer").select((k + 1).alias("domain_id"), domain.alias("domain"), (k % 256).alias("shard_id"),
                                                   (F.col("c_acctbal") / 10000).alias("domain_score"))
    return SC.conform(rows, SC.DOMAIN_STATE, SC.DOMAIN_STATE_DEFAULTS)


def _tables(spark, sf_dir):
    k, u = F.col("o_orderkey"), F.col("o_orderkey") % 1500
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), u.alias("u"))
    o = o.join(o.groupBy("u", (F.col("o_custkey") % 256).alias("shard_id")).agg(F.min("o_orderkey").alias("o_orderkey")), ["u", "o_orderkey"])
    rows = o.select(
        F.concat(F.lit("https://x.com/"), F.col("u").cast("string")).alias("url"), (F.col("o_custkey") + 1).alias("domain_id"), "shard_id",
        F.when(k % 3 > 0, F.concat(F.lit("t"), (k % 11).cast("string"))).alias("title"), (k % 2).alias("source"), (k % 3).alias("robots_bits"),
        (k % 7).alias("inlink_count_approx"), (k % 13).alias("num_fetch_ok_90d"),
        F.when(k % 4 > 0, F.concat(F.lit("a"), (k % 5).cast("string"))).alias("anchor_text"), "o_orderkey", "o_orderdate")
    counters = rows.crossJoin(spark.range(2).withColumnRenamed("id", "d")).select(   # two days of every URL
        "url", F.date_add(F.lit("2024-01-01").cast("date"), (k % 2 + F.col("d")).cast("int")).alias("event_date"), (k % 5).alias("num_fetch_ok"),
        (k % 3).alias("num_fetch_fail"), ((k + F.col("d")) % 2 == 0).alias("accounted"), "shard_id")
    features = rows.select("url", "domain_id", F.when(k % 6 > 0, F.col("o_orderdate")).alias("fetched_at"), (k % 1000).alias("content_length"), "shard_id")
    registry = _registry(spark, sf_dir)
    d = F.col("domain_id")
    stats = registry.select("domain_id", F.date_add(F.lit("2024-01-01").cast("date"), (d % 2).cast("int")).alias("event_date"), "shard_id",
                            (d % 9).alias("num_fetch_ok"), F.create_map(F.concat(F.lit("r"), (d % 3).cast("string")), d).alias("fail_reasons"))
    state = SC.conform(rows, SC.URL_STATE, SC.URL_STATE_DEFAULTS)
    zero = {c: 0 for c in MG.COUNTERS}
    return MG.Tables(state, SC.conform(counters, SC.URL_EVENT_COUNTER, SC.COUNTER_DEFAULTS), registry,
                     SC.conform(rows, SC.URL_HISTORY, SC.URL_STATE_DEFAULTS), SC.conform(features, SC.CONTENT_FEATURE),
                     SC.conform(stats, SC.DOMAIN_STATS_DAILY, zero))


def _whitelist(spark, sf_dir):
    return _registry(spark, sf_dir).where((F.col("domain_id") % 5 == 0) & F.col("domain").rlike("^h")).select(F.col("domain").alias("host"))


def _plan(spark, sf_dir, job):
    registry = _registry(spark, sf_dir)
    if job == "unsplit":
        return MG.plan_unsplit(registry, _whitelist(spark, sf_dir), overrides=OVERRIDES, rules=FX.SUFFIX_RULES)
    if job == "reshard":
        return MG.plan_reshard(registry, OVERRIDES)
    return MG.plan_merge(registry, overrides=OVERRIDES, domain_like="%.s1%.com", rules=FX.SUFFIX_RULES)


def _done(spark, sf_dir, job):
    return MG.migrate(_tables(spark, sf_dir), _plan(spark, sf_dir, job), merge_columns=job == "merge")


def _shard(k: str) -> str:
    cases = " ".join(f"WHEN '{d}' THEN {s}" for d, s in OVERRIDES.items())
    return f"CASE {k} {cases} ELSE CAST(('0x' || right(md5({k}), 2)) AS INTEGER) END"


def _into(sources: str, wanted: str) -> str:
    """New ids of the wanted targets that the registry lacks, and the moves of the sources."""
    return f"""
src AS ({sources}),
newk AS (SELECT k, row_number() OVER (ORDER BY CAST(('0x' || right(md5(k), 2)) AS INTEGER), k) AS rn
         FROM ({wanted}) WHERE k NOT IN (SELECT domain FROM reg)),
ids AS (SELECT domain AS k, domain_id FROM reg UNION ALL SELECT k, CAST((SELECT max(domain_id) FROM reg) + rn AS BIGINT) FROM newk),
mv AS (SELECT s.domain_id, s.domain, s.shard_id AS old_shard, i.domain_id AS new_domain_id, {_shard('s.target')} AS new_shard FROM src s JOIN ids i ON i.k = s.target)
"""


_BASE = f"reg AS ({_REG_SQL}), st AS ({_STATE_SQL}), ct AS ({_COUNTER_SQL}), ds AS ({_STATS_SQL})"
_PARENT = "regexp_extract({d}, '([^.]+\\.com)$', 1)"
_MOVES = {
    "unsplit": f"""{_BASE}, wl AS (SELECT domain AS host FROM reg WHERE domain_id % 5 = 0 AND starts_with(domain, 'h')),
par AS (SELECT DISTINCT {_PARENT.format(d='host')} AS k FROM wl),""" + _into(
        "SELECT r.*, par.k AS target FROM reg r JOIN par ON ends_with(r.domain, '.' || par.k) WHERE r.domain NOT IN (SELECT host FROM wl)", "SELECT k FROM par"),
    "reshard": f"""{_BASE}, mv AS (SELECT domain_id, domain, shard_id AS old_shard, domain_id AS new_domain_id, {_shard('domain')} AS new_shard FROM reg
  WHERE domain IN ({', '.join(f"'{d}'" for d in OVERRIDES)}) AND {_shard('domain')} <> shard_id)""",
    "merge": f"""{_BASE},""" + _into(
        f"""SELECT *, {_PARENT.format(d='domain')} AS target FROM reg WHERE domain LIKE '%.s1%.com' AND domain NOT LIKE '% %' AND {_PARENT.format(d='domain')} <> domain""",
        f"""SELECT DISTINCT {_PARENT.format(d='domain')} AS k FROM reg WHERE domain LIKE '%.s1%.com' AND domain NOT LIKE '% %' AND {_PARENT.format(d='domain')} <> domain"""),
}
_MOVED = """
stay AS (SELECT * FROM st WHERE NOT EXISTS (SELECT 1 FROM mv WHERE mv.domain_id = st.domain_id AND mv.old_shard = st.shard_id)),
go AS (SELECT st.* EXCLUDE (domain_id, shard_id), mv.new_domain_id AS domain_id, mv.new_shard AS shard_id, mv.domain AS rank
       FROM st JOIN mv ON mv.domain_id = st.domain_id AND mv.old_shard = st.shard_id)"""
# a URL that the target has keeps the target's row; else the first moved one
_TARGET_WINS = f"""{_MOVED},
fin AS (SELECT url, domain_id, shard_id, title, source, robots_bits, inlink_count_approx, num_fetch_ok_90d, anchor_text FROM stay
  UNION ALL SELECT url, domain_id, shard_id, title, source, robots_bits, inlink_count_approx, num_fetch_ok_90d, anchor_text FROM (
    SELECT *, row_number() OVER (PARTITION BY url, shard_id ORDER BY rank) AS rn FROM go) g
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM stay WHERE stay.url = g.url AND stay.shard_id = g.shard_id))"""
# column rules, in the order: the row that was there, then moved ones by domain
_MERGED = f"""{_MOVED},
alls AS (SELECT *, '' AS rank FROM stay UNION ALL BY NAME SELECT * FROM go),
fin AS (SELECT url, shard_id, first(domain_id ORDER BY rank) AS domain_id, first(title ORDER BY rank) FILTER (WHERE title IS NOT NULL) AS title,
  max(source) AS source, coalesce(last(robots_bits ORDER BY rank) FILTER (WHERE robots_bits <> 0), first(robots_bits ORDER BY rank)) AS robots_bits,
  CAST(sum(inlink_count_approx) AS INTEGER) AS inlink_count_approx, first(num_fetch_ok_90d ORDER BY rank) AS num_fetch_ok_90d,
  first(anchor_text ORDER BY rank) FILTER (WHERE anchor_text IS NOT NULL) AS anchor_text FROM alls GROUP BY url, shard_id)"""
_FIN = {"unsplit": _TARGET_WINS, "reshard": _TARGET_WINS, "merge": _MERGED}
_COUNTERS = """
foll AS (SELECT DISTINCT fin.url, mv.old_shard, fin.shard_id AS dst FROM fin JOIN mv ON mv.new_domain_id = fin.domain_id AND mv.new_shard = fin.shard_id WHERE mv.old_shard <> mv.new_shard),
cm AS (SELECT ct.url, event_date, num_fetch_ok, num_fetch_fail, accounted, coalesce(foll.dst, ct.shard_id) AS shard_id
       FROM ct LEFT JOIN foll ON foll.url = ct.url AND foll.old_shard = ct.shard_id)"""

for _job in ("unsplit", "reshard", "merge"):
    _name = {"unsplit": "unsplit", "reshard": "reshard", "merge": "merge_subdomains"}[_job]

    def _state(spark, sf_dir, job=_job):
        """RK-3 / RK-4 / RK-5: URL state after the job."""
        return _done(spark, sf_dir, job).state.select("url", "domain_id", "shard_id", "title", "source", "robots_bits", "inlink_count_approx",
                                                      "num_fetch_ok_90d", "anchor_text")

    register(f"{_name}_state", oracle=f"WITH {_MOVES[_job]}, {_FIN[_job]} SELECT * FROM fin")(_state)

    def _counters(spark, sf_dir, job=_job):
        """RK-3 / RK-4 / RK-5: counters follow their URLs and add up."""
        c = _done(spark, sf_dir, job).counters
        return c.select("url", F.col("event_date").cast("string").alias("event_date"), "num_fetch_ok", "num_fetch_fail", "accounted", "shard_id")

    register(f"{_name}_counters", oracle=f"""WITH {_MOVES[_job]}, {_FIN[_job]}, {_COUNTERS}
SELECT url, CAST(event_date AS VARCHAR) AS event_date, CAST(sum(num_fetch_ok) AS INTEGER) AS num_fetch_ok, CAST(sum(num_fetch_fail) AS INTEGER) AS num_fetch_fail,
  bool_or(accounted) AS accounted, shard_id FROM cm GROUP BY url, cm.event_date, shard_id""")(_counters)

    def _report(spark, sf_dir, job=_job):
        """RK-7 / AG-13: the dry run of the job."""
        return MG.report(_tables(spark, sf_dir), _plan(spark, sf_dir, job))

    register(f"{_name}_report", oracle=f"""WITH {_MOVES[_job]},
cur AS (SELECT st.*, mv.domain FROM st JOIN mv ON mv.domain_id = st.domain_id AND mv.old_shard = st.shard_id)
SELECT 'url_state' AS "table", domain, count(*) AS rows FROM cur GROUP BY domain
UNION ALL SELECT 'url_state_history', domain, count(*) FROM cur GROUP BY domain
UNION ALL SELECT 'content_feature', domain, count(*) FROM cur GROUP BY domain
UNION ALL SELECT 'url_event_counter', domain, count(*) FROM ct JOIN cur ON cur.url = ct.url AND cur.shard_id = ct.shard_id GROUP BY domain
UNION ALL SELECT 'domain_stats_daily', mv.domain, count(*) FROM ds JOIN mv USING (domain_id) GROUP BY mv.domain""")(_report)


@register("unsplit_registry", oracle=f"""WITH {_MOVES['unsplit']}
SELECT domain, domain_id, CASE WHEN domain IN (SELECT k FROM par) THEN {_shard('domain')} ELSE shard_id END AS shard_id FROM reg WHERE domain_id NOT IN (SELECT domain_id FROM mv)
UNION ALL SELECT k, (SELECT domain_id FROM ids WHERE ids.k = newk.k), {_shard('newk.k')} FROM newk""")
def unsplit_registry(spark, sf_dir):
    """RK-3: parents are created or re-sharded, moved subdomains leave."""
    return _done(spark, sf_dir, "unsplit").registry.select("domain", "domain_id", "shard_id")


@register("unsplit_history", oracle=f"""WITH {_MOVES['unsplit']}
SELECT url, coalesce(mv.new_domain_id, st.domain_id) AS domain_id, coalesce(mv.new_shard, st.shard_id) AS shard_id, title
FROM st LEFT JOIN mv ON mv.domain_id = st.domain_id AND mv.old_shard = st.shard_id""")
def unsplit_history(spark, sf_dir):
    """RK-3: history rows follow their domain, all of them."""
    return _done(spark, sf_dir, "unsplit").history.select("url", "domain_id", "shard_id", "title")


@register("reshard_registry", oracle=f"""WITH {_MOVES['reshard']}
SELECT domain, domain_id, coalesce((SELECT new_shard FROM mv WHERE mv.domain_id = reg.domain_id), shard_id) AS shard_id FROM reg""")
def reshard_registry(spark, sf_dir):
    """RK-4: the registry names the new shards."""
    return _done(spark, sf_dir, "reshard").registry.select("domain", "domain_id", "shard_id")


@register("merge_subdomains_registry", oracle=f"""WITH {_MOVES['merge']}
SELECT domain, domain_id, shard_id FROM reg WHERE domain_id NOT IN (SELECT domain_id FROM mv)
UNION ALL SELECT k, (SELECT domain_id FROM ids WHERE ids.k = newk.k), {_shard('newk.k')} FROM newk""")
def merge_subdomains_registry(spark, sf_dir):
    """RK-5: registrable domains are created, merged rows leave."""
    return _done(spark, sf_dir, "merge").registry.select("domain", "domain_id", "shard_id")


@register("merge_subdomains_features", oracle=f"""WITH {_MOVES['merge']},
ft AS (SELECT url, domain_id, shard_id, CASE WHEN o_orderkey % 6 > 0 THEN o_orderdate END AS fetched_at, CAST(o_orderkey % 1000 AS INTEGER) AS content_length FROM st),
al AS (SELECT ft.url, coalesce(mv.new_domain_id, ft.domain_id) AS domain_id, coalesce(mv.new_shard, ft.shard_id) AS shard_id, fetched_at, content_length, coalesce(mv.domain, '') AS rank
       FROM ft LEFT JOIN mv ON mv.domain_id = ft.domain_id AND mv.old_shard = ft.shard_id),
k AS (SELECT *, first_value(fetched_at) OVER (PARTITION BY url, shard_id ORDER BY rank) AS base,
        row_number() OVER (PARTITION BY url, shard_id ORDER BY rank) AS rn, row_number() OVER (PARTITION BY url, shard_id ORDER BY fetched_at DESC NULLS LAST, rank) AS rt FROM al)
SELECT url, domain_id, shard_id, CAST(fetched_at AS TIMESTAMP) AS fetched_at, content_length FROM k WHERE CASE WHEN base IS NULL THEN rn = 1 ELSE rt = 1 END""")
def merge_subdomains_features(spark, sf_dir):
    """RK-5: of content features that meet, the later fetch wins."""
    return _done(spark, sf_dir, "merge").features.select("url", "domain_id", "shard_id", "fetched_at", "content_length")


@register("merge_subdomains_stats", oracle=f"""WITH {_MOVES['merge']},
al AS (SELECT coalesce(mv.new_domain_id, ds.domain_id) AS domain_id, event_date, num_fetch_ok, reason, n, coalesce(mv.domain, '') AS rank FROM ds LEFT JOIN mv USING (domain_id)),
t AS (SELECT domain_id, event_date, sum(num_fetch_ok) AS ok FROM al GROUP BY ALL),
r AS (SELECT domain_id, event_date, reason, last(n ORDER BY rank) AS n FROM al GROUP BY ALL)
SELECT domain_id, CAST(event_date AS VARCHAR) AS event_date, CAST(ok AS BIGINT) AS num_fetch_ok, reason, n FROM t JOIN r USING (domain_id, event_date)""")
def merge_subdomains_stats(spark, sf_dir):
    """RK-5: daily stats add up; a reason that both sides have takes the last side's count."""
    d = _done(spark, sf_dir, "merge").domain_stats
    return d.select("domain_id", F.col("event_date").cast("string").alias("event_date"), "num_fetch_ok", F.explode("fail_reasons").alias("reason", "n"))


@register("unsplit_owned_rows", oracle=f"""WITH {_MOVES['unsplit']}, own AS (SELECT DISTINCT domain_id FROM mv)
SELECT 'url_state' AS "table", domain_id, count(*) AS rows FROM st SEMI JOIN own USING (domain_id) GROUP BY domain_id
UNION ALL SELECT 'domain_stats_daily', domain_id, count(*) FROM ds SEMI JOIN own USING (domain_id) GROUP BY domain_id
UNION ALL SELECT 'url_event_counter', own.domain_id, count(*) FROM own, ct
  WHERE EXISTS (SELECT 1 FROM st WHERE st.url = ct.url AND st.shard_id = ct.shard_id AND st.domain_id = own.domain_id) GROUP BY own.domain_id""")
def unsplit_owned_rows(spark, sf_dir):
    """RJ-13 / AG-13: rows of the domains that move, table by table; counters have no domain and
    count by their URL's state row."""
    t = _tables(spark, sf_dir)
    return RK.owned_rows({"url_state": t.state, "url_event_counter": t.counters, "domain_stats_daily": t.domain_stats}, t.state, _plan(spark, sf_dir, "unsplit").moves)
