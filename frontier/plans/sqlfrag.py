"""DuckDB SQL fragments shared by oracle queries (the oracle side of the
correctness check; the Spark side never uses these)."""

# Host of a URL as Python's urlsplit computes it (userinfo and
# port removed, lower case).
NETLOC = "regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)"
HOST = "lower(regexp_replace(regexp_replace(" + NETLOC + ", '^.*@', ''), ':.*$', ''))"
# eTLD+1 for plain one-label public suffixes (the driver data only has those).
REG = "nullif(regexp_extract({h}, '([^.]+\\.[^.]+)$', 1), '')"
SHARD_KEY = "CASE WHEN {h} = '' OR {h} IS NULL THEN 'unknown' ELSE coalesce(" + REG + ", {h}) END"
# md5(key) mod 256 = last byte of the digest
SHARD256 = "CAST(('0x' || right(md5({k}), 2)) AS INTEGER)"


def host(u: str) -> str:
    return HOST.format(u=u)


def shard_key(h: str) -> str:
    return SHARD_KEY.format(h=h)


def shard256(k: str) -> str:
    return SHARD256.format(k=k)
