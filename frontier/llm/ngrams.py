"""Language-model scores by deleted interpolation of n-gram maximum-likelihood estimates.

A text is its words and one end token. The model mixes c(context, word) / c(context) of every
order, down to the unigram and the uniform 1 / (V + 1), with weights that depend on how often the
context was seen (buckets by powers of two, of the longest context that was seen at all). A part
of the training texts is deleted from the counts; expectation-maximisation on its events finds the
weights (its events are kept as counts by bucket and octaves of the estimates, with the mean
estimates of every cell, so what EM reads is bounded while all deleted texts count). Scores then
take the counts of all training texts.

Counts grow with the corpus and are never gathered. Texts are cut into blocks of a bounded number
of tokens. A block sends its distinct n-grams (hashes of 64 bits, sorted, as differences), with
its own training counts, to ranges of the hash space; a range adds up and answers every block in
its order; answers meet the block's texts again. A frequent n-gram is one entry a block, a very
long text is several blocks whose sums are added, and nothing is sent per token.

Defined results: a null or empty text is its end token alone; without training texts every
probability is 1; a null id is not held out; repeated rows are scored each and count each. Extra
columns don't matter. ``docs`` is read three times and its partitions must hold the same rows each
time, as those of a table do; blocks that differ are refused.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frontier.session import cut_lineage

from . import kernels as K

#: Order of the model, tokens of a block, and n-grams that a range of hashes may hold.
ORDER, BLOCK_TOKENS, RANGE_KEYS = 2, 1 << 19, 1 << 20
#: One in so many training texts is deleted from the counts, to learn the weights from.
DELETED_SHARE = 10
#: EM steps, and events that a bucket gets from the weights of all buckets.
EM_STEPS, PRIOR_EVENTS = 60, 4.0
#: Tokens that no word has (fixed).
_START, _END = K.U64(0x5851F42D4C957F2D), K.U64(0x14057B7EF767814F)
#: Octaves of an estimate in a cell, and of a context count in a bucket.
_OCTAVES, _LEVELS = 64, 64
#: Kinds of text: not learned from, counted, deleted from the counts.
UNSEEN, COUNTED, DELETED = 0, 1, 2


def packed(numbers: np.ndarray) -> bytes:
    """64-bit integers as compressed byte planes."""
    raw = numbers.astype(K.U64).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(K.U64).ravel()


class Block:
    """The tokens of pieces of texts, and their n-grams.

    ``pieces``: uid, kind, first (the text's begin is here), last (so is its end), text. A piece
    that isn't a text's first begins with the ``order - 1`` words before it."""

    def __init__(self, pieces: pa.Table, order: int):
        self.order, self.uid = order, pieces.column("uid")
        data, offsets = K.text_bytes(pieces.column("text"))
        words = K.find_words(data, offsets, K.NONSPACE, K.LOWER)
        n, first, last = np.diff(words.first), pieces.column("first").to_numpy(), pieces.column("last").to_numpy()
        lead = np.where(first, order - 1, 0)
        length = lead + n + last
        begin = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
        total = int(length.sum())
        self.tokens = np.full(total, _START, K.U64)
        self.tokens[np.repeat(begin + lead - words.first[:-1], n) + np.arange(len(words.hashes))] = words.hashes
        self.tokens[(begin + length - 1)[last]] = _END
        self.owner = np.repeat(np.arange(len(n), dtype=np.int32), length)
        self.within = np.arange(total) - begin[self.owner]
        self.start = first[self.owner] & (self.within < order - 1)
        self.event = self.within >= order - 1
        self.kind = pieces.column("kind").to_numpy()
        learned = self.event & (self.kind[self.owner] != UNSEEN)
        self.keys, self.own, self.place, self.at = [], [], [], []
        for k in range(1, order + 1):
            # an n-gram is asked for as an event, or as the context of a piece's first event
            at = np.flatnonzero(self.event if k == order else self.event | ((self.within == order - 2) & ~self.start))
            gram = self.tokens[at - k + 1]
            for j in range(k - 2, -1, -1):
                gram = K.mix(gram * K.U64(K._BASE) + self.tokens[at - j])
            keys, place = np.unique(gram, return_inverse=True)
            self.keys.append(keys)
            self.place.append(place)
            self.at.append(at)
            self.own.append(np.bincount(place[learned[at]], minlength=len(keys)))

    def estimates(self, counts: list[np.ndarray], n_texts: int, n_tokens: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Of every event: maximum-likelihood estimates by order, and the bucket of its context."""
        events, out, bucket = np.flatnonzero(self.event), [], None
        seen = np.zeros(len(self.tokens), np.int64)
        for k in range(1, self.order + 1):
            mine = np.zeros(len(self.tokens), np.int64)
            mine[self.at[k - 1]] = counts[k - 1][self.place[k - 1]].astype(np.int64)
            context = np.full(len(events), n_tokens) if k == 1 else np.where(self.start[events - 1], n_texts, seen[events - 1])
            out.append(np.where(context > 0, mine[events] / np.maximum(context, 1), 0.0))
            level = np.frexp(context.astype(float))[1]  # 0 for 0, else 1 + floor(log2)
            bucket = np.where(level > 0, (k - 1) * _LEVELS + level, 0 if bucket is None else bucket) if k > 1 else np.zeros(len(events), np.int64)
            seen = mine
        return out, bucket

    def unigrams(self, counts: list[np.ndarray]) -> np.ndarray:
        mine = np.zeros(len(self.tokens), np.int64)
        mine[self.at[0]] = counts[0][self.place[0]].astype(np.int64)
        return mine[self.event]


def _blocks(batches, order: int, block_tokens: int):
    """(number, pieces) from batches of uid, kind, id, text; deleted texts have blocks of their own."""
    names = ["uid", "id", "kind", "first", "last", "text"]
    held: dict[bool, list] = {False: [], True: []}
    size, made, kinds, seen = {False: 0, True: 0}, {False: 0, True: 0}, None, None

    def close(deleted):
        rows = held[deleted]
        number = (seen >> 33 << 33) + 2 * made[deleted] + deleted
        table = pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
        made[deleted], held[deleted], size[deleted] = made[deleted] + 1, [], 0
        return number, table

    for batch in batches:
        if not batch.num_rows:
            continue
        kinds = [pa.int64(), batch.column(2).type, pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
        data, offsets = K.text_bytes(batch.column(3))
        words = K.find_words(data, offsets, K.NONSPACE, K.LOWER)
        uids, kind, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
        seen = uids[0]
        for i in range(batch.num_rows):
            deleted = kind[i] == DELETED
            lo, hi = int(words.first[i]), int(words.first[i + 1])
            for at in range(lo, max(hi, lo + 1), block_tokens):
                to, first = min(hi, at + block_tokens), at == lo
                a, b = (words.starts[at if first else at - order + 1], words.ends[to - 1]) if to > at else (0, 0)
                held[deleted].append((uids[i], ids[i], kind[i], first, to == hi, bytes(data[a:b])))
                size[deleted] += to - at + order
                if size[deleted] >= block_tokens:
                    yield close(deleted)
    for deleted in (False, True):
        if held[deleted]:
            yield close(deleted)


def _requests(rows: DataFrame, order: int, block_tokens: int, bits: int) -> DataFrame:
    """(range, ord, block, keys, own) of every block."""
    def run(batches):
        for number, pieces in _blocks(batches, order, block_tokens):
            block = Block(pieces, order)
            for k, (keys, own) in enumerate(zip(block.keys, block.own, strict=True)):
                cut = np.searchsorted(keys >> K.U64(64 - bits), np.arange((1 << bits) + 1)) if bits else np.array([0, len(keys)])
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array(np.full(len(some), k + 1, np.int32)), pa.array(np.full(len(some), number)),
                     pa.array([packed(np.diff(keys[cut[r]:cut[r + 1]], prepend=K.U64(0))) for r in some], pa.binary()),
                     pa.array([packed(own[cut[r]:cut[r + 1]]) for r in some], pa.binary())], names=["range", "ord", "block", "keys", "own"])

    return rows.mapInArrow(run, "range int, ord int, block bigint, keys binary, own binary")


_ANSWERS = "block bigint, ord int, range int, n bigint, all binary, left binary, sums array<bigint>"


def _answers(requests: DataFrame, parts: int) -> DataFrame:
    """For every request the counts of its n-grams, and for deleted blocks also those without
    deleted texts; a row without a block has the sums of a range: tokens and words, both ways."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = ["block", "ord", "range", "n", "all", "left", "sums"]

    def answer(at, rows):
        keys = [np.cumsum(unpacked(r[1]), dtype=K.U64) for r in rows]
        own = np.concatenate([unpacked(r[2]).astype(np.int64) for r in rows])
        cut = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        deleted = np.repeat([r[0] & 1 for r in rows], np.diff(cut)).astype(bool)
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        every = np.bincount(place, own, len(distinct)).astype(np.int64)
        left = np.bincount(place, np.where(deleted, 0, own), len(distinct)).astype(np.int64)
        out = [(r[0], at[1], at[0], int(cut[i + 1] - cut[i]), packed(every[place[cut[i]:cut[i + 1]]]),
                packed(left[place[cut[i]:cut[i + 1]]]) if r[0] & 1 else None, None) for i, r in enumerate(rows)]
        if at[1] == 1:
            out.append((None, 1, at[0], 0, None, None, [int(x) for x in (every.sum(), (every > 0).sum(), left.sum(), (left > 0).sum())]))
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    def run(batches):
        at, rows = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                here = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if here != at and rows:
                    yield answer(at, rows)
                    rows = []
                at = here
                rows.append((batch.column(2)[i].as_py(), batch.column(3)[i].as_py(), batch.column(4)[i].as_py()))
        if rows:
            yield answer(at, rows)

    return requests.repartition(parts, "range").sortWithinPartitions("range", "ord", "block").mapInArrow(run, _ANSWERS)


def _met(rows: DataFrame, answers: DataFrame, order: int, block_tokens: int, parts: int, use: str, fn, schema: str) -> DataFrame:
    """``fn(block, pieces, counts)`` for every block of ``rows`` with its answers (column ``use``)."""
    def texts(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for number, pieces in _blocks(batches, order, block_tokens):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pieces.schema, options=options) as writer:
                writer.write_table(pieces)
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([0], pa.int32()), pa.array([-1], pa.int32()), pa.array([0]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                             names=["block", "ord", "range", "n", "data"])

    def run(batches):
        at, rows = None, []

        def block():
            if rows[0][0] != 0:
                raise RuntimeError("a block has answers but no texts: the partitions of docs have changed")
            pieces = pa.ipc.open_stream(rows[0][1]).read_all()
            b = Block(pieces, order)
            counts = [np.concatenate([np.zeros(0, K.U64), *(unpacked(r[1]) for r in rows if r[0] == k)]) for k in range(1, order + 1)]
            if [len(c) for c in counts] != [len(k) for k in b.keys]:
                raise RuntimeError("a block differs from the one that was counted: the partitions of docs have changed")
            return fn(b, pieces, counts)

        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py()
                if here != at and rows:
                    yield block()
                    rows = []
                at = here
                rows.append((batch.column(1)[i].as_py(), batch.column(4)[i].as_py()))
        if rows:
            yield block()

    cut = rows.mapInArrow(texts, "block bigint, ord int, range int, n bigint, data binary")
    both = cut.unionByName(answers.where("block IS NOT NULL").select("block", "ord", "range", "n", F.col(use).alias("data")))
    return both.repartition(parts, "block").sortWithinPartitions("block", "ord", "range").mapInArrow(run, schema)


@dataclass
class Weights:
    """Mixture weights (by bucket: uniform, unigram, ... ) and what the scores need beside."""

    order: int
    by_bucket: dict[int, np.ndarray]
    common: np.ndarray

    def of(self, buckets: np.ndarray) -> np.ndarray:
        known, place = np.unique(buckets, return_inverse=True)
        return np.stack([self.one(int(b)) for b in known])[place] if len(known) else np.zeros((0, self.order + 1))

    def one(self, bucket: int) -> np.ndarray:
        return self.by_bucket.get(bucket, _allowed(self.common, bucket))


def _allowed(weights: np.ndarray, bucket: int) -> np.ndarray:
    """``weights`` without those of orders whose context was never seen."""
    out = weights * (np.arange(len(weights)) <= 1 + bucket // _LEVELS)
    return out / out.sum()


def learn_weights(cells: list[tuple[int, float, list[float]]], order: int, words: int) -> Weights:
    """EM over ``cells`` (bucket, events, mean estimates by order), with ``words`` known words."""
    uniform = 1.0 / (words + 1)
    bucket = np.array([c[0] for c in cells], np.int64)
    n = np.array([c[1] for c in cells], float)
    p = np.array([[uniform, *c[2]] for c in cells], float).reshape(-1, order + 1)

    def em(n, p, start, prior):
        w = start
        for _ in range(EM_STEPS):
            post = w * p
            post = post / post.sum(axis=1, keepdims=True)
            w = (n @ post + PRIOR_EVENTS * prior) / (n.sum() + PRIOR_EVENTS)
        return w

    flat = np.full(order + 1, 1.0 / (order + 1))
    common = em(n, p, flat, flat) if len(cells) else flat
    by = {}
    for b in np.unique(bucket).tolist():
        here, prior = bucket == b, _allowed(common, b)
        by[b] = em(n[here], p[here], _allowed(flat, b), prior)
    return Weights(order, by, common)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn: Column | None = None, order: int = ORDER,
          block_tokens: int | None = None, range_keys: int | None = None) -> DataFrame:
    """Per row: ``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``; ``learn`` says of a row of ``docs`` whether it is learned from (all are by default)."""
    K.bounded_batches(docs.sparkSession)
    block_tokens, range_keys = block_tokens or BLOCK_TOKENS, range_keys or RANGE_KEYS
    id_kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    learned = F.coalesce(learn, F.lit(False)) if learn is not None else F.lit(True)
    deleted = F.pmod(F.xxhash64(F.col(id_col), F.lit("deleted")), F.lit(DELETED_SHARE)) == 0
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.when(~learned, UNSEEN).when(deleted, DELETED).otherwise(COUNTED).alias("kind"),
                       F.col(id_col).alias("id"), text.alias("text"))
    sizes = rows.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).collect()
    n_texts = {k: sum(r["n"] for r in sizes if r["kind"] == k) for k in (COUNTED, DELETED)}
    # words have about five bytes; a range holds about this many n-grams of an order
    bits = max(0, int(np.ceil(np.log2(max(1, sum(r["bytes"] or 0 for r in sizes) / 5 / range_keys)))))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << bits)
    answers = cut_lineage(_answers(_requests(rows, order, block_tokens, bits), parts))
    sums = answers.where("sums IS NOT NULL").agg(*[F.coalesce(F.sum(F.col("sums")[j]), F.lit(0)) for j in range(4)]).first()
    n_tokens, n_words, left_tokens, left_words = (int(x) for x in sums)

    # 1. weights from the deleted texts, by the counts without them
    def cells(block, pieces, counts):
        estimates, bucket = block.estimates(counts, n_texts[COUNTED], left_tokens)
        cell = bucket.copy()
        for r in estimates:
            cell = cell * _OCTAVES + np.where(r > 0, np.clip(_OCTAVES - 1 + np.frexp(r)[1], 1, _OCTAVES - 1), 0)
        known, place = np.unique(cell, return_inverse=True)
        return pa.RecordBatch.from_arrays([pa.array(known), pa.array(np.bincount(place, minlength=len(known)).astype(float)),
                                           pa.array(np.stack([np.bincount(place, r, len(known)) for r in estimates], axis=1).tolist(), pa.list_(pa.float64()))],
                                          names=["cell", "n", "r"])

    found = _met(rows.where(F.col("kind") == DELETED), answers.where("block % 2 = 1"), order, block_tokens, parts, "left", cells, "cell bigint, n double, r array<double>")
    found = found.groupBy("cell").agg(F.sum("n").alias("n"), *[F.sum(F.col("r")[k]).alias(f"r{k}") for k in range(order)]).collect()
    weights = learn_weights([(r["cell"] // _OCTAVES**order, r["n"], [r[f"r{k}"] / r["n"] for k in range(order)]) for r in sorted(found)], order, left_words)

    # 2. scores by all counts
    uniform, floor = 1.0 / (n_words + 1), n_tokens + 0.5 * (n_words + 1)

    def scored(block, pieces, counts):
        estimates, bucket = block.estimates(counts, n_texts[COUNTED] + n_texts[DELETED], n_tokens)
        w = weights.of(bucket) if n_tokens else np.tile(np.eye(order + 1)[0], (len(bucket), 1))
        p = w[:, 0] * uniform + sum(w[:, k + 1] * r for k, r in enumerate(estimates))
        c, owner, m = block.unigrams(counts), block.owner[block.event], pieces.num_rows
        add = lambda x: np.bincount(owner, x, m)
        return pa.RecordBatch.from_arrays(
            [pieces.column("uid").combine_chunks(), pieces.column("id").combine_chunks(), pa.array(np.bincount(owner, minlength=m)), pa.array(add(c > 0).astype(np.int64)),
             pa.array(add(np.log10((c + 0.5) / floor))), pa.array(add(np.log10(p)))], names=["uid", "id", "n", "known", "base", "score"])

    # (deleted texts have their own blocks in both passes, so that blocks are the same)
    scores = _met(rows, answers, order, block_tokens, parts, "all", scored, f"uid bigint, id {id_kind}, n bigint, known bigint, base double, score double")
    return scores.groupBy("uid").agg(F.first("id").alias(id_col), F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"),
                                     F.sum("base").alias("base_score"), F.sum("score").alias("score")).select(
        id_col, "n_tokens", "n_known", F.lit(n_tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
