"""Near-duplicate detection: universal hash minima, banding, exact confirmation on whole shingle sets, and connected components by alternating
large-star and small-star.

A document's set holds the hashes of its distinct ``size``-word shingles (words are runs
without space or 0x09-0x0D after lower-casing A-Z); a shorter text is one shingle, a text
without words has the empty set and is linked with nothing. Documents with equal sets form
a class at once, by the digest of the set, so that groups of exact copies cost one row; classes,
not ids, are compared and connected, and a component takes the smallest id of its classes.
Classes meet in bands of their signatures. A bucket never gives all its pairs:

1. every member is compared with the smallest and the largest id of its bucket, exactly;
2. components of these links are formed; most buckets then lie in one component;
3. where a bucket's smallest id has met classes of several components, these are compared
   in blocks of bounded size, each two blocks in one task: pairs of different components
   whose set sizes and exact distances to that id (a metric) allow a link are confirmed
   on their sets, and only links leave the task.

A pair inside one component needs no comparison: its link wouldn't change any component.
Step 3 costs time, and sets that are shuffled once for each block they meet, by the square
of the classes that met one class and aren't connected; no task holds more than two blocks.
The blocks of a pivot's largest component meet those of the other components only, and sets
that no other component of the pivot can be near to, by their distances to it, aren't shuffled.

Defined results: rows with a null id are returned with a null component and kept; rows
that repeat an id are judged by their own texts; null texts are empty; an empty table
gives an empty result. Columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frontier.session import cut_lineage

from . import kernels as K
from .removal import MAX_BROADCAST_IDS, without_ids

SHINGLE_WORDS = 5
#: A pair is linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A pair at the bound shares no band with probability (1 - 0.75**ROWS)**BANDS < 3e-7.
BANDS, ROWS = 40, 4
#: Exact similarities to a third set differ by no more between two linked sets.
MOST_APART = 1 - PERCENT / 100 + 1e-9
#: Classes in one block of step 3.
BLOCK_ROWS = 256

_coefficients = np.random.default_rng(20240229).integers(0, 1 << 63, size=(2, BANDS * ROWS), dtype=np.uint64)
_A, _B = _coefficients[0] * K.U64(2) + K.U64(1), _coefficients[1]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of consecutive texts."""
    words = K.find_words(data, offsets, K.NONSPACE, K.LOWER)
    hashes, _ = K.windows(words, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(hashes[a:b - size + 1]))
        elif b > a:
            one = K.Words(words.starts[a:b], words.ends[a:b], words.hashes[a:b], np.array([0, b - a]))
            out.append(K.windows(one, b - a)[0])
        else:
            out.append(np.zeros(0, K.U64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima of multiply-shift hashes over a set, in blocks."""
    low = np.full(len(_A), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at:at + 2048]
        low = np.minimum(low, ((part[None, :] * _A[:, None] + _B[:, None]) >> K.U64(32)).min(axis=1))
    return low.astype(np.uint32)


def _map_sets(df: DataFrame, columns: str, make) -> DataFrame:
    """``make(sets)`` gives the columns after the id, for the texts in the second column."""
    id_col, text_col = df.columns
    kind = df.schema[id_col].dataType.simpleString()
    names = [c.strip().split(" ")[0] for c in columns.split(",")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = K.text_bytes(batch.column(1))
        parts = [make(shingle_sets(data, offsets[lo:hi + 1])) for lo, hi in K.row_groups(offsets)]
        cols = [pa.concat_arrays([p[i] for p in parts]) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], names=[id_col, *names])

    return K.text_map(df, run, f"{id_col} {kind}, {columns}")


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signed(sets: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array([len(s) for s in sets], pa.int64()),
            pa.array([_digest(s) for s in sets], pa.binary()),
            pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())]


def _bands(classes: DataFrame, id_kind: str) -> DataFrame:
    """(bucket, id): one row for each band of every class."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(K.U64)
            bucket = np.arange(BANDS, dtype=K.U64)[None, :] + K.U64(1)
            for r in range(ROWS):
                bucket = K.mix(bucket * K.U64(K._BASE) + signs[:, :, r])
            at = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(bucket.ravel().view(np.int64)), batch.column(0).take(at)], names=["bucket", "id"])

    K.bounded_batches(classes.sparkSession)
    return classes.select("id", "sig").mapInArrow(run, f"bucket bigint, id {id_kind}")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int(np.count_nonzero(large[at] == small)) if len(large) else 0


def _confirm(pairs: DataFrame, sets: DataFrame, id_kind: str) -> DataFrame:
    """(a, b, both, together): exact intersection and union sizes of the sets of every pair."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            both, together = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), K.U64), np.frombuffer(y.as_buffer(), K.U64)
                both.append(_common(x, y))
                together.append(len(x) + len(y) - both[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(together, pa.int64())],
                                             names=["a", "b", "both", "together"])

    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("xs"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("ys"))
    rows = pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "xs", "ys")
    return rows.mapInArrow(run, f"a {id_kind}, b {id_kind}, both bigint, together bigint")


def _block_links(x: list[tuple], y: list[tuple] | None) -> list[tuple]:
    """Links between rows (id, component, j, shingles) of two blocks, or inside one, that
    join different components; of the links that would join the same two, one."""
    rows = x + (y or [])
    sizes = np.array([len(r[3]) for r in rows])
    near = np.array([np.nan if r[2] is None else r[2] for r in rows])
    parent = {r[1]: r[1] for r in rows}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    tokens = np.concatenate([r[3] for r in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    links = []
    for k in range(len(rows) if y is None else len(x)):
        others = np.arange(k + 1, len(rows)) if y is None else np.arange(len(x), len(rows))
        mine = find(rows[k][1])
        others = others[[find(rows[i][1]) != mine for i in others]] if len(others) else others
        if not len(others):
            continue
        low, high = np.minimum(sizes[others], sizes[k]), np.maximum(sizes[others], sizes[k])
        apart = np.abs(near[others] - near[k])
        others = others[(100 * low >= PERCENT * high) & ~(apart > MOST_APART)]
        if not len(others):
            continue
        begin, end = np.searchsorted(tokens, rows[k][3], "left"), np.searchsorted(tokens, rows[k][3], "right")
        count = end - begin
        place = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        both = np.bincount(owner[place], minlength=len(rows))[others]
        for i in others[100 * both >= PERCENT * (sizes[others] + sizes[k] - both)]:
            a, b = find(rows[k][1]), find(rows[i][1])
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((rows[k][0], rows[i][0]))
    return links


def _to_compare(met: DataFrame) -> DataFrame:
    """Of ``met`` (pivot, id, component, j) the rows that may have a link to another component of
    their pivot, with the largest component as ``main``, the number of its blocks, and that of
    all others. ``j`` is 1 less a metric's distance to the pivot, so rows of a link differ in it
    by no more than a link's distance; without ``j`` a row stays."""
    sizes = met.groupBy("pivot", "component").agg(F.count("*").alias("n"), F.min(F.coalesce("j", F.lit(0.0))).alias("low"), F.max(F.coalesce("j", F.lit(1.0))).alias("high"))
    tops = (sizes.groupBy("pivot").agg(F.max(F.struct("n", "component", "low", "high")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("components"))
            .where("components > 1 AND n > 2"))
    rest = F.col("component") != F.col("top.component")
    pivots = (sizes.withColumnRenamed("n", "__n").join(tops, "pivot").groupBy("pivot")
              .agg(F.first("top").alias("top"), F.first("n").alias("n"), F.first("components").alias("components"),
                   F.min(F.when(rest, F.col("low"))).alias("rest_low"), F.max(F.when(rest, F.col("high"))).alias("rest_high"))
              .select("pivot", "components", "rest_low", "rest_high", F.col("top.component").alias("main"), F.col("top.low").alias("main_low"), F.col("top.high").alias("main_high"),
                      F.ceil(F.col("top.n") / BLOCK_ROWS).alias("main_blocks"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK_ROWS).alias("blocks")))
    within = lambda side: F.col("j").between(F.col(f"{side}_low") - MOST_APART, F.col(f"{side}_high") + MOST_APART)
    near = F.when(F.col("component") == F.col("main"), within("rest")).otherwise((F.col("components") > 2) | within("main"))
    return met.join(pivots, "pivot").where(F.coalesce(near, F.lit(True))).select("pivot", "id", "component", "j", "main", "main_blocks", "blocks")


def _dealt(groups: DataFrame) -> DataFrame:
    """A row of ``groups`` for each block that it meets; ``lo`` and ``hi`` name the two blocks.
    Rows of ``main`` lie in the first blocks and meet the later ones, the others meet all."""
    main = F.col("component") == F.col("main")
    own = F.when(main, F.pmod(F.xxhash64("id"), F.col("main_blocks"))).otherwise(F.col("main_blocks") + F.pmod(F.xxhash64("id"), F.col("blocks")))
    others = F.sequence(F.when(main, F.col("main_blocks")).otherwise(F.lit(0).cast("bigint")), F.col("main_blocks") + F.col("blocks") - 1)
    return (groups.withColumn("block", own).withColumn("other", F.explode(others))
            .select("pivot", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "component", "j", "shingles"))


def _in_blocks(groups: DataFrame, id_kind: str) -> DataFrame:
    """Links (a, b) of ``groups`` (pivot, id, component, j, shingles, main, main_blocks, blocks): the members of a pivot are dealt into blocks by hash, and each two blocks that may
    hold different components meet in one task."""
    dealt = _dealt(groups)
    key = ["pivot", "lo", "hi"]

    def links(rows: list[tuple]) -> list[tuple]:
        lo, hi = rows[0][0][1:]
        parts = [[r[2:] for r in rows if r[1] == b] for b in ((lo,) if lo == hi else (lo, hi))]
        return _block_links(parts[0], None if lo == hi else parts[1]) if all(parts) else []

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            found = []
            for pivot, lo, hi, block, i, c, j, shingles in zip(*(batch.column(k) for k in range(8)), strict=True):
                at = (pivot.as_py(), lo.as_py(), hi.as_py())
                if held and held[0][0] != at:
                    found += links(held)
                    held = []
                held.append((at, block.as_py(), i.as_py(), c.as_py(), j.as_py(), np.frombuffer(shingles.as_buffer(), K.U64)))
            yield _pairs(found, batch.schema.field(4).type)
            last = batch.schema.field(4).type
        if held:
            yield _pairs(links(held), last)

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, f"a {id_kind}, b {id_kind}")


def _pairs(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], kind) for k in (0, 1)], names=["a", "b"])


def _release(df: DataFrame) -> None:
    """Files of shuffles and written tables that nothing refers to any more go when the driver's
    JVM has collected them; to be called after a small job, when the end of the last is known."""
    df.sparkSession._jvm.System.gc()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node that can be reached) for every node of
    the links ``a``, ``b``, by alternating large-star and small-star steps. Each step is two
    aggregations and joins over the links; nothing is gathered by node."""
    edges = cut_lineage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = lambda: edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = state()
    while True:
        _release(edges)
        both_ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both_ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both_ways.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small)
        now = state()
        if now == before:
            break
        before = now
    _release(edges)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_shingles``, ``component_id`` and ``kept``."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    base = cut_lineage(_map_sets(texts, "n bigint, key binary, sig binary", _signed))
    # a class is one set, with its smallest id; it has a number, since an id may hold several sets.
    # Numbers follow the ids: the first of a group of near copies tends to be what they were made from
    reps = base.where("n > 0 AND id IS NOT NULL").groupBy("key").agg(F.min("id").alias("doc"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = reps.repartitionByRange(parts, "doc", "key").sortWithinPartitions("doc", "key").withColumn("cid", F.monotonically_increasing_id())
    # a row of each id and set, dealt as the join needs it: signatures are shuffled once
    own = base.where("n > 0 AND id IS NOT NULL").select(F.col("id").alias("doc"), "key", "sig").dropDuplicates(["doc", "key"])
    classes = cut_lineage(own.join(numbered, ["doc", "key"]).select("key", "doc", F.col("cid").alias("id"), "sig"))

    # 1. buckets with two classes or more; every member against the smallest and the largest id
    bands = _bands(classes, "bigint")
    ends = bands.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    members = cut_lineage(bands.join(ends, "bucket"))
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("doc", F.struct("id", "key").alias("who"))
    if wanted.count() <= MAX_BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    _release(members)
    sets = cut_lineage(_map_sets(texts.join(wanted, texts["id"] == wanted["doc"]).select("who", "text"), "key binary, shingles binary", lambda found: [
        pa.array([_digest(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())]).where("who.key = key").select("who.id", "shingles"))
    pairs = (members.where("id <> lo").select(F.col("lo").alias("a"), F.col("id").alias("b"))
             .unionByName(members.where("id <> hi AND id <> lo").select(F.col("id").alias("a"), F.col("hi").alias("b"))).distinct())
    tested = cut_lineage(_confirm(pairs, sets, "bigint"))
    linked = f"100 * both >= {PERCENT} * together"
    links = tested.where(linked).select("a", "b")
    found = cut_lineage(connected_components(links))

    # 2. smallest ids of buckets that have met several components: compare those in blocks
    met = members.select(F.col("lo").alias("pivot"), "id").distinct()
    met = met.join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    share = tested.groupBy(F.col("a").alias("pivot"), F.col("b").alias("id")).agg(F.max(F.col("both") / F.col("together")).alias("j"))
    met = met.join(share, ["pivot", "id"], "left").withColumn("j", F.when(F.col("id") == F.col("pivot"), 1.0).otherwise(F.col("j")))
    more = _in_blocks(_to_compare(cut_lineage(met)).join(sets, "id").select("pivot", "id", "component", "j", "shingles", "main", "main_blocks", "blocks"), "bigint")

    found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = found.join(classes.select(F.col("id").alias("node"), "doc"), "node").groupBy("component").agg(F.min("doc").alias("component_id"))
    found = found.join(named, "component").select(F.col("node").alias("id"), "component_id")
    of_class = classes.select("id", "key", "doc").join(found, "id", "left").select("key", F.coalesce("component_id", "doc").alias("component_id"))
    rows = base.select("id", "n", "key").join(of_class, "key", "left")
    smallest = F.coalesce("component_id", "id")
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                       F.when(F.col("id").isNotNull(), smallest).alias("component_id"),
                       F.coalesce(F.col("id") == smallest, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id. All columns
    stay as they are; rows with a null id stay."""
    return without_ids(docs, near_duplicates(docs, id_col, text_col).where("NOT kept").select(id_col), id_col)


#: DuckDB SQL of the registered query: exact links by a join on shingles.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= 75 * (x.n + y.n - both_n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)
"""
