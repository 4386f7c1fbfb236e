"""Prefix trie of conversations by the Euler-tour technique.

1. Turns are numbered over a range-partitioned order of (conversation, turn), with carries from
   partition to partition, and a sum of hashes (two of 64 bits, modulo 2**64) names every prefix;
   a conversation may be any number of tasks.
2. Equal prefixes are grouped to nodes. A node is known by its smallest member and its depth, so
   nodes in that order lie beside their tour neighbours.
3. Every node has an enter and an exit arc. The successor of an arc is the enter arc of the first
   child or of the next sibling, or the own or the parent's exit arc.
4. List ranking: each task contracts the chains inside its range of arcs to one weighted arc; the
   contracted list is ranked the same way over fewer, larger ranges, until one range of bounded
   size holds it. If a round hardly shortens the list, pointer jumping ranks what is left.
5. Leaves and saved characters of a subtree are differences of prefix sums at the positions of
   its arcs; prefix sums run over blocks of positions.

Defined results: turns are ordered by turn (null first), then role and text; null role or text is
empty; repeated rows are turns of their own; rows with a null conversation id don't count. An
empty table has no node (the root needs a member). Extra columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from frontier.session import cut_lineage

from . import kernels as K

#: Conversations that share a donor of first turns, and the bound of shared turns (exclusive).
FAMILY, MAX_SHARED = 100, 6
#: Arcs that one task contracts, and positions in a block of prefix sums.
RANGE, BLOCK = 1 << 18, 1 << 16
#: A round of contraction that leaves more than this share is followed by pointer jumping.
LEAST_GAIN = 0.7
#: Bytes of a block of ids before they are hashed.
DIGEST_BLOCK = 1 << 16
#: Odd multipliers (fixed) of the two prefix sums.
_P = np.array([0x9E3779B97F4A7C15, 0xD1342543DE82EF95], K.U64)


def _power(p: np.uint64, k: np.ndarray) -> np.ndarray:
    """p**k modulo 2**64; negative k by the inverse."""
    out, base = np.ones(len(k), K.U64), np.where(k >= 0, p, K.U64(pow(int(p), -1, 1 << 64)))
    k = np.abs(k)
    while k.any():
        out = np.where(k & 1, out * base, out)
        base = base * base
        k = k >> 1
    return out


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _column(batch: pa.RecordBatch, k: int, kind=np.int64) -> np.ndarray:
    return batch.column(k).fill_null(0).to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _parts(df: DataFrame, rows: int, each: int) -> int:
    """Partitions for ``rows``: those of the session at least, or more to keep each in bounds."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, h0, h1, chars) of ``turns`` (conv, turn, role, text): the place of a turn in
    its conversation from 1 on, both prefix sums, and the text's code points."""
    rows = turns.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("row"))
    parts = _parts(rows, rows.count(), RANGE)
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "row"]
    dealt = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .select("conv", F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")).alias("key"),
                     F.char_length("text").cast("bigint").alias("chars"), F.spark_partition_id().alias("pid")))

    def run(batches):
        conv, pos, sums = None, 0, np.zeros(2, K.U64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            c = _column(batch, 0)
            key = np.array([int(k, 16) & 0xFFFFFFFFFFFFFFFF for k in batch.column(1).to_pylist()], K.U64)
            also = np.array([int(k[:16], 16) for k in batch.column(1).to_pylist()], K.U64)
            new = np.concatenate([[conv is None or c[0] != conv], c[1:] != c[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
            before = first < 0
            place = np.arange(n) - np.maximum(first, 0) + 1 + np.where(before, pos, 0)
            out = []
            for j, x in enumerate((key, also)):
                total = np.cumsum(K.mix(x) * _power(_P[j], place), dtype=K.U64)
                start = np.concatenate([np.zeros(1, K.U64), total])[np.maximum(first, 0)]
                out.append(total - start + np.where(before, sums[j], K.U64(0)))
            conv, pos, sums = c[-1], int(place[-1]), np.array([out[0][-1], out[1][-1]])
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(0), pa.array(place), _signed(out[0]), _signed(out[1]), batch.column(2)],
                                             names=["pid", "conv", "pos", "h0", "h1", "chars"])

    local = cut_lineage(dealt.mapInArrow(run, "pid int, conv bigint, pos bigint, h0 bigint, h1 bigint, chars bigint"))
    # a conversation that goes on in the next partition is the last of its partition
    last = F.max_by(F.struct("conv", "pos", "h0", "h1"), F.struct("conv", "pos")).alias("l")
    ends = local.groupBy("pid").agg(last).select("pid", "l.*")
    firsts = local.groupBy("pid").agg(F.min("conv").alias("conv")).select("pid", "conv", *[F.lit(0).cast("bigint").alias(c) for c in ("pos", "h0", "h1")])
    ahead = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    # 0 is what a partition without an end of the conversation adds; of a pair, only one isn't 0
    sums = (firsts.unionByName(ends).groupBy("pid", "conv").agg(*[F.sum(c).alias(c) for c in ("pos", "h0", "h1")])
            .withColumn("shift", F.coalesce(F.sum("pos").over(ahead), F.lit(0))))

    def moved(batches):
        for batch in batches:
            shift = _column(batch, 2)
            h = [_column(batch, k).view(K.U64) * _power(_P[k - 3], shift) for k in (3, 4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _signed(h[0]), _signed(h[1])], names=["pid", "conv", "shift", "h0", "h1"])

    def wrapped(column):
        low = F.expr(f"pmod(coalesce({column}, 0), 18446744073709551616BD)")
        return F.when(low >= F.expr("9223372036854775808BD"), low - F.expr("18446744073709551616BD")).otherwise(low).cast("bigint")

    carried = sums.select("pid", "conv", "shift", "h0", "h1").mapInArrow(moved, "pid int, conv bigint, shift bigint, h0 bigint, h1 bigint")
    carried = carried.select("pid", "conv", "shift", *[F.sum(F.col(c).cast("decimal(20,0)")).over(ahead).cast("decimal(38,0)").alias(f"c{k}") for k, c in enumerate(("h0", "h1"))])
    carried = carried.where("shift > 0").select("pid", "conv", "shift", wrapped("c0").alias("c0"), wrapped("c1").alias("c1"))

    def add(batches):
        for batch in batches:
            shift = _column(batch, 5)
            h = [_column(batch, 2 + j).view(K.U64) * _power(_P[j], shift) + _column(batch, 6 + j).view(K.U64) for j in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_column(batch, 1) + shift), _signed(h[0]), _signed(h[1]), batch.column(4)],
                                             names=["conv", "pos", "h0", "h1", "chars"])

    return local.join(F.broadcast(carried), ["pid", "conv"], "left").select(
        "conv", "pos", "h0", "h1", "chars", "shift", "c0", "c1").mapInArrow(add, "conv bigint, pos bigint, h0 bigint, h1 bigint, chars bigint")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv, depth, h0, h1, p0, p1, chars, last) of every rebuilt conversation: one row for
    each of its prefixes (p: that of the prefix before), the empty one at depth 0 included."""
    own = cut_lineage(numbered_turns(turns))
    bound = MAX_SHARED - 1
    shared = F.crc32(F.col("conv").cast("string").cast("binary")) % MAX_SHARED
    # at most ``bound`` turns of a conversation are ever shared or left out
    head = own.where(F.col("pos") <= bound).groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "h0", "h1", "chars"))).alias("head"))
    convs = (own.groupBy("conv").agg(F.max("pos").alias("size")).withColumn("h", shared).withColumn("donor", F.col("conv") - F.col("conv") % FAMILY))
    given = head.select(F.col("conv").alias("donor"), F.col("head").alias("given"))
    convs = (convs.join(given, "donor", "left").join(head, "conv", "left")
             .withColumn("given", F.expr("coalesce(slice(given, 1, cast(h AS int)), array())"))
             .withColumn("skip", F.when(F.col("h") > 0, F.element_at("head", F.least("h", F.size("head")).cast("int"))))
             .select("conv", "h", "size", "given", F.coalesce("skip.h0", F.lit(0)).alias("s0"), F.coalesce("skip.h1", F.lit(0)).alias("s1"))
             .withColumn("base", F.size("given").cast("bigint")).withColumn("total", F.col("base") + F.greatest(F.col("size") - F.col("h"), F.lit(0))))
    convs = cut_lineage(convs)
    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("h0"), F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("chars"))
    first = convs.select("conv", "total", F.posexplode(F.concat(F.array(zero), "given"))).select(
        "conv", F.col("pos").cast("bigint").alias("depth"), "col.h0", "col.h1", "col.chars", (F.col("pos") == F.col("total")).alias("last"))
    base = F.when(F.col("base") > 0, F.element_at("given", -1))
    info = convs.select("conv", "h", "base", "total", "s0", "s1", F.coalesce(base["h0"], F.lit(0)).alias("b0"), F.coalesce(base["h1"], F.lit(0)).alias("b1"))
    rest = own.join(info, "conv").where("pos > h")

    def shifted(batches):
        for batch in batches:
            c = {name: _column(batch, k) for k, name in enumerate(batch.schema.names)}
            shift = c["base"] - c["h"]
            out = []
            for j in range(2):
                h, s, b = (c[f"{x}{j}"].view(K.U64) for x in "hsb")
                out.append((h - s) * _power(_P[j], shift) + b)
            depth = c["pos"] + shift
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(depth), _signed(out[0]), _signed(out[1]), batch.column(4), pa.array(depth == c["total"])],
                                             names=["conv", "depth", "h0", "h1", "chars", "last"])

    rest = rest.select("conv", "pos", "h0", "h1", "chars", "h", "base", "total", "s0", "s1", "b0", "b1").mapInArrow(
        shifted, "conv bigint, depth bigint, h0 bigint, h1 bigint, chars bigint, last boolean")
    return first.unionByName(rest)


def digests(ends: DataFrame) -> DataFrame:
    """(h0, h1, sha) from ``ends`` (h0, h1, conv): the SHA-256 of the ascending ids of each
    group, comma-joined. Ranges of the sorted ids become blocks of text in many tasks; the one
    task that a group's hash needs gets blocks only, one after the other."""
    order = ["h0", "h1", "conv"]

    def joined(batches):
        at, ids, size = None, [], 0
        for batch in batches:
            for key in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if at is not None and (at[:2] != key[:2] or size >= DIGEST_BLOCK):
                    yield at, ids
                    at, ids, size = None, [], 0
                at = at or key
                ids.append(str(key[2]))
                size += len(ids[-1]) + 1
        if at is not None:
            yield at, ids

    def blocks(batches):
        rows = []
        for at, ids in joined(batches):
            rows.append((*at, ",".join(ids)))
            if len(rows) >= 256:
                yield batch_of(rows, ["h0", "h1", "conv", "ids"])
                rows = []
        yield batch_of(rows, ["h0", "h1", "conv", "ids"])

    def batch_of(rows, names):
        kinds = {"h0": pa.int64(), "h1": pa.int64(), "conv": pa.int64(), "ids": pa.string(), "sha": pa.string()}
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[n]) for k, n in enumerate(names)], names=names)

    def hashed(batches):
        at, state, rows = None, None, []
        for batch in batches:
            for h0, h1, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
                if at != (h0, h1):
                    if at is not None:
                        rows.append((*at, state.hexdigest()))
                    at, state = (h0, h1), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield batch_of(rows, ["h0", "h1", "sha"])
            rows = []
        if at is not None:
            yield batch_of([(*at, state.hexdigest())], ["h0", "h1", "sha"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    made = ends.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(blocks, "h0 bigint, h1 bigint, conv bigint, ids string")
    return made.repartition("h0", "h1").sortWithinPartitions(*order).mapInArrow(hashed, "h0 bigint, h1 bigint, sha string")


def nodes(prefixes: DataFrame) -> DataFrame:
    """(m, parent, conv, depth, parent_conv, n_convs, chars, h0, h1) of the distinct prefixes;
    ``m`` numbers them in the order of smallest member and depth, ``parent`` is that of the parent."""
    groups = prefixes.groupBy("depth", "h0", "h1").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.max("chars").alias("chars"))
    parts = int(prefixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "depth"]
    made = cut_lineage(groups.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("m", F.monotonically_increasing_id()))
    # the parent: the node of the smallest member's prefix before
    tops = made.groupBy("conv").agg((F.min("depth") - 1).alias("depth"))
    above = prefixes.select("conv", "depth", "h0", "h1").join(tops, order).select("conv", (F.col("depth") + 1).alias("depth"), "h0", "h1")
    owner = made.select("h0", "h1", (F.col("depth") + 1).alias("depth"), F.col("m").alias("parent"), F.col("conv").alias("parent_conv"))
    first = above.join(owner, ["h0", "h1", "depth"]).select("conv", "depth", "parent", "parent_conv")
    chained = made.select("conv", (F.col("depth") + 1).alias("depth"), F.col("m").alias("chain"))
    return (made.join(first, order, "left").join(chained, order, "left")
            .select("m", F.coalesce("chain", "parent").alias("parent"), "conv", "depth",
                    F.when(F.col("chain").isNotNull(), F.col("conv")).otherwise(F.col("parent_conv")).alias("parent_conv"), "n_convs", "chars", "h0", "h1"))


def arcs(tree: DataFrame) -> DataFrame:
    """(arc, next) of ``tree`` (m, parent, first child): enter arcs 2 m, exit arcs 2 m + 1; the
    exit arc of the root has no next."""
    # next sibling: inside a block of siblings by a window, from block to block by the blocks' smallest
    kids = tree.where("parent IS NOT NULL").select("m", "parent", F.shiftright("m", 16).alias("block"))
    inside = Window.partitionBy("parent", "block").orderBy("m")
    along = Window.partitionBy("parent").orderBy("block")
    starts = kids.groupBy("parent", "block").agg(F.min("m").alias("start")).select("parent", "block", F.lead("start").over(along).alias("following"))
    siblings = (kids.withColumn("sibling", F.lead("m").over(inside)).join(starts, ["parent", "block"])
                .select("m", F.coalesce("sibling", "following").alias("sibling")))
    return (tree.join(siblings, "m", "left")
            .select(F.explode(F.array(
                F.struct((F.col("m") * 2).alias("arc"), F.coalesce(F.col("child") * 2, F.col("m") * 2 + 1).alias("next")),
                F.struct((F.col("m") * 2 + 1).alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next")))).alias("a"))
            .select("a.arc", "a.next"))


def _contracted(batches):
    """Chains of the arcs of one range: (arc, head, offset, next, size) for every arc; the two
    last where the arc is the head: what follows the chain, and its length."""
    parts = [(b.column(0).to_numpy(), b.column(1).fill_null(-1).to_numpy(), b.column(2).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    arc, follow, size = (np.concatenate([p[k] for p in parts]) for k in range(3))
    by = np.argsort(arc, kind="stable")
    arc, follow, size = arc[by], follow[by], size[by]
    n = len(arc)
    at = np.minimum(np.searchsorted(arc, follow), n - 1)
    inside = (follow >= 0) & (arc[at] == follow)
    # pointers back: the predecessor in the range, or the arc itself
    back, weight = np.arange(n), np.zeros(n, np.int64)
    back[at[inside]], weight[at[inside]] = np.flatnonzero(inside), size[inside]
    while True:
        further = back[back]
        if (further == back).all():
            break
        weight, back = weight + weight[back], further
    ends = np.flatnonzero(~inside)
    total, after = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    total[back[ends]], after[back[ends]] = weight[ends] + size[ends], follow[ends]
    for lo in range(0, n, 1 << 16):
        s = slice(lo, lo + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(arc[s]), pa.array(arc[back[s]]), pa.array(weight[s]), pa.array(after[s], mask=after[s] < 0), pa.array(total[s])],
                                         names=["arc", "head", "offset", "next", "size"])


def _jumped(chain: DataFrame) -> DataFrame:
    """(arc, rank): arcs from the end of the list, by pointer jumping over (arc, next, size)."""
    state = chain.select("arc", "next", F.col("size").alias("rank"))
    while True:
        state = cut_lineage(state)
        if state.where("next IS NOT NULL").isEmpty():
            return state.select("arc", "rank")
        ahead = state.select(F.col("arc").alias("next"), F.col("next").alias("next2"), F.col("rank").alias("more"))
        state = state.join(ahead, "next", "left").select("arc", F.col("next2").alias("next"), (F.col("rank") + F.coalesce("more", F.lit(0))).alias("rank"))


def list_rank(chain: DataFrame, per_range: int | None = None, least_gain: float | None = None) -> DataFrame:
    """(arc, position) of a list ``chain`` (arc, next; one arc has no next), positions from 0."""
    per_range, least_gain = per_range or RANGE, LEAST_GAIN if least_gain is None else least_gain
    level, levels = cut_lineage(chain.withColumn("size", F.lit(1).cast("bigint"))), []
    total = left = level.count()
    parts = _parts(level, left, per_range)
    while True:
        rows = level.select("arc", "next", "size")
        dealt = rows.repartitionByRange(parts, "arc") if parts > 1 else rows.coalesce(1)
        found = cut_lineage(dealt.mapInArrow(_contracted, "arc bigint, head bigint, offset bigint, next bigint, size bigint"))
        levels.append(found.select("arc", "head", "offset"))
        heads = found.where("arc = head").select("arc", "next", "size")
        before, left = left, heads.count()
        if left <= 1:
            place = heads.select("arc", F.lit(0).cast("bigint").alias("position"))
            break
        if left > least_gain * before and left > per_range:
            rank = _jumped(heads)
            place = rank.select("arc", (F.lit(total) - F.col("rank")).alias("position"))
            break
        level, parts = heads, -(-left // per_range)
    for found in reversed(levels):
        tops = place.select(F.col("arc").alias("head"), "position")
        place = found.join(tops, "head").select("arc", (F.col("position") + F.col("offset")).alias("position"))
    return place


def prefix_sums(rows: DataFrame, values: list[str]) -> DataFrame:
    """``rows`` with every column of ``values`` replaced by its sum over all positions up to the row's."""
    blocked = cut_lineage(rows.withColumn("block", F.floor(F.col("position") / BLOCK)))
    along = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy("block").agg(*[F.sum(v).alias(f"__{v}") for v in values])
    offsets = sums.select("block", *[F.coalesce(F.sum(f"__{v}").over(along), F.lit(0)).alias(f"__{v}") for v in values])
    inside = Window.partitionBy("block").orderBy("position")
    others = [c for c in rows.columns if c not in values]
    return (blocked.select("block", *others, *[F.sum(v).over(inside).alias(v) for v in values]).join(F.broadcast(offsets), "block")
            .select(*others, *[(F.col(v) + F.col(f"__{v}")).alias(v) for v in values]))


def prefix_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                per_range: int | None = None) -> DataFrame:
    """Per node: ``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    K.bounded_batches(conversations.sparkSession)
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    prefixes = cut_lineage(rebuilt(turns))
    found = cut_lineage(nodes(prefixes))
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("m")).agg(F.count("*").alias("n_children"), F.min("m").alias("child"))
    tree = cut_lineage(found.join(children, "m", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
                       .withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")))
    places = list_rank(arcs(tree.select("m", "parent", "child")), per_range)
    worth = tree.select(F.col("m").alias("node"), "leaf", "saved")
    own = places.withColumn("node", F.shiftright("arc", 1)).withColumn("out", F.col("arc") % 2 == 1)
    weighted = own.join(worth, "node").select("node", "out", "position", *[F.when(F.col("out"), 0).otherwise(F.col(v)).alias(v) for v in ("leaf", "saved")])
    sums = prefix_sums(weighted, ["leaf", "saved"])
    # exit less enter, and the node's own value, which the sum at its enter arc has already
    signed = [F.sum(F.when(F.col("out"), F.col(v)).otherwise(-F.col(v))).alias(f"{v}_below") for v in ("leaf", "saved")]
    below = sums.groupBy(F.col("node").alias("m")).agg(*signed)
    ends = digests(prefixes.where("last").select("h0", "h1", "conv"))
    return (tree.join(below, "m").join(ends, ["h0", "h1"], "left")
            .select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children",
                    (F.col("leaf_below") + F.col("leaf")).alias("n_leaves"), (F.col("saved_below") + F.col("saved")).alias("saved_tokens"),
                    F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))


#: DuckDB SQL of the registered query, from the definition: prefixes as lists of turns.
SQL = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS own FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, conv_id - conv_id % 100 AS donor,
             (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                lambda c: list_prepend(ascii(c)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
                lambda a, x: CASE WHEN x < 0 THEN xor(a // 2, 3988292384 * (a % 2)) ELSE xor(a, x) END)) % 6 AS h FROM o),
r AS (SELECT h.conv_id, list_concat(coalesce(d.own, [])[1:h], h.own[h + 1:]) AS turns FROM h LEFT JOIN o d ON d.conv_id = h.donor),
p AS (SELECT conv_id, turns[1:d] AS pre, d, d = len(turns) AS ends FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (SELECT pre, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends) AS ended
      FROM p GROUP BY pre, d),
m AS (SELECT n.*, CASE WHEN depth > 0 THEN (n_convs - 1) * length(pre[depth].t) ELSE 0 END AS saved FROM n),
k AS (SELECT pre[1:depth - 1] AS pre, count(*) AS n_children FROM m WHERE depth > 0 GROUP BY 1),
s AS (SELECT a.pre, sum(b.saved) AS saved_tokens, count(*) FILTER (WHERE c.n_children IS NULL) AS n_leaves
      FROM (SELECT pre, saved, unnest(range(0, depth + 1)) AS up FROM m) b JOIN m a ON a.depth = b.up AND a.pre = b.pre[1:b.up]
      LEFT JOIN k c ON c.pre = b.pre GROUP BY a.pre)
SELECT m.conv_id, m.depth, q.conv_id AS parent_conv_id, m.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(m.ended, '')) AS ends_sha256
FROM m JOIN s ON s.pre = m.pre LEFT JOIN k ON k.pre = m.pre LEFT JOIN m q ON m.depth > 0 AND q.depth = m.depth - 1 AND q.pre = m.pre[1:m.depth - 1]
"""
