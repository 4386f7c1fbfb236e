"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are maximal runs of ASCII letters and digits and non-ASCII characters after
lower-casing A-Z. Each benchmark item gives its windows of ``n`` consecutive words
(an item with fewer words, but not none, is one window). All windows become a sorted
hash set that is broadcast once its size is proven; every document is scanned with
rolling window hashes, a hit is verified on the words themselves, and the words of
verified windows are marked.

Defined results: a null or empty text has no words and no hits; null and empty items
have no window; repeated items all count by their ``item_id`` (a null id is left out of
the id list but its windows still hit); an empty benchmark gives zero hits everywhere.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .removal import without_ids

#: Largest benchmark text in one broadcast hash set (bytes; the arrays take about seven times
#: that in every worker). A larger benchmark is cut into sets of at most this size by hash, the
#: documents are scanned once for each, and the hits of a document are put together.
MAX_SET_BYTES = 16 << 20
_BITS = 20


@dataclass
class GramSet:
    """Windows of the items as arrays: per size the sorted hashes and the first word of each
    window; the words' places in the folded text, their item, and the items' ids."""

    hashes: dict[int, np.ndarray]
    at: dict[int, np.ndarray]
    bitmap: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    text: bytes
    ids: list[str | None]

    def items(self, size: int, window: int, words: list[bytes]) -> tuple[bool, set[str]]:
        """Whether some item has exactly these words (their hash is ``window``), and the ids."""
        known = self.hashes[size]
        lo, hi = np.searchsorted(known, K.U64(window), "left"), np.searchsorted(known, K.U64(window), "right")
        found, ids = False, set()
        for w in self.at[size][lo:hi].tolist():
            if all(self.text[a:b] == x for a, b, x in zip(self.starts[w:w + size].tolist(), self.ends[w:w + size].tolist(), words, strict=True)):
                found = True
                if self.ids[self.owner[w]] is not None:
                    ids.add(self.ids[self.owner[w]])
        return found, ids


def gram_set(items: list[tuple[object, str | None]], n: int) -> GramSet:
    data, offsets = K.text_bytes(pa.array([t for _, t in items], pa.string()))
    words = K.find_words(data, offsets, K.ALNUM, K.LOWER)
    counts, owner = np.diff(words.first), words.doc
    hashes, at = {}, {}
    bitmap = np.zeros(1 << _BITS, bool)
    for size in sorted({min(n, int(c)) for c in counts if c}):
        found, inside = K.windows(words, size)
        mine = counts[owner[:len(found)]]
        wanted = np.flatnonzero(inside & ((mine == size) if size < n else (mine >= n)))
        order = np.argsort(found[wanted], kind="stable")
        hashes[size], at[size] = found[wanted][order], wanted[order].astype(np.int32)
        bitmap[(hashes[size] >> K.U64(64 - _BITS)).astype(np.int64)] = True
    return GramSet(hashes, at, bitmap, words.starts, words.ends, owner, K.LOWER[data].tobytes(), [None if i is None else str(i) for i, _ in items])


def scan(data: np.ndarray, offsets: np.ndarray, grams: GramSet):
    """Words, their hit marks, and per text the set of item ids, for consecutive texts."""
    words = K.find_words(data, offsets, K.ALNUM, K.LOWER)
    hit = np.zeros(len(words.hashes) + 1, np.int32)
    items: dict[int, set[str]] = {}
    doc = words.doc
    for size, known in grams.hashes.items():
        hashes, inside = K.windows(words, size)
        maybe = np.flatnonzero(inside & grams.bitmap[(hashes >> K.U64(64 - _BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(known, hashes[maybe]), len(known) - 1)
        for i in maybe[known[at] == hashes[maybe]].tolist():
            spans = zip(words.starts[i:i + size], words.ends[i:i + size], strict=True)
            found, ids = grams.items(size, int(hashes[i]), [K.LOWER[data[a:b]].tobytes() for a, b in spans])
            if found:
                hit[i] += 1
                hit[i + size] -= 1
                items.setdefault(int(doc[i]), set()).update(ids)
    return words, np.cumsum(hit)[:-1] > 0, items


def _pieces(rows: DataFrame, n: int, most: int) -> DataFrame:
    """Items (``i``, ``t``) over ``most`` bytes in pieces of about that size, one row each under the
    same id. Neighbours share ``n - 1`` words, so every window lies whole in a piece and none is added."""
    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                data, offsets = K.text_bytes(one.column(1))
                words = K.find_words(data, offsets, K.ALNUM, K.LOWER) if offsets[1] - offsets[0] > most else None
                count = 0 if words is None else len(words.starts)
                if count <= n:
                    yield one
                    continue
                at = end = 0
                while end < count:
                    end = min(count, max(at + n, int(np.searchsorted(words.ends, words.starts[at] + most, "right"))))
                    text = data[words.starts[at]:words.ends[end - 1]].tobytes().decode()
                    yield pa.RecordBatch.from_arrays([one.column(0), pa.array([text], pa.string())], names=["i", "t"])
                    at = end - n + 1

    K.bounded_batches(rows.sparkSession)
    return rows.mapInArrow(cut, f"i {rows.schema['i'].dataType.simpleString()}, t string")


def _parts(benchmark: DataFrame, n: int, item_col: str, text_col: str):
    """The hash sets, one at a time: usually one; more where the benchmark is over the bound."""
    rows = benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = rows.agg(F.sum(F.octet_length("t")).alias("all"), F.max(F.octet_length("t")).alias("one")).first()
    total = size["all"] or 0
    if (size["one"] or 0) > MAX_SET_BYTES:
        rows = _pieces(rows, n, MAX_SET_BYTES // 4)
        total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = 1 if total <= MAX_SET_BYTES else -(-2 * total // MAX_SET_BYTES)   # half full on average
    for p in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == p)
        yield gram_set([(r.i, r.t) for r in part.collect()], n)


def _scanned(docs: DataFrame, grams: GramSet, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, ``key`` (hash of the text), n_words, ``hits`` (places of hit words), items, spans."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = K.text_bytes(batch.column(2))
        n_words, hits, items, spans = [], [], [], []
        for lo, hi in K.row_groups(offsets):
            part = offsets[lo:hi + 1]
            words, hit, found = scan(data, part, shared.value)
            n_words += np.diff(words.first).tolist()
            for d in range(hi - lo):
                places = np.flatnonzero(hit[words.first[d]:words.first[d + 1]])
                hits.append(places.astype(np.int32))
                items.append(sorted(found.get(d, ())))
                spans.append(_spans(data, words, hit, d, int(part[d])) if len(places) else [])
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
             pa.array(spans, span)], names=[id_col, "key", "n_words", "hits", "items", "spans"])

    return K.text_map(docs.select(id_col, F.xxhash64(text_col).alias("key"), text_col), run,
                      f"{id_col} {kind}, key bigint, n_words bigint, hits array<int>, items array<string>, spans array<struct<begin:bigint,end:bigint>>")


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_hit``, ``items`` (sorted ids as
    strings) and ``spans`` (hit runs as character ranges ``[begin, end)`` of the text, in
    order; of several sets they may overlap)."""
    return _found(docs, benchmark, n, id_col, text_col, item_col, item_text_col).drop("key")


def _found(docs: DataFrame, benchmark: DataFrame, n: int, id_col: str, text_col: str, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """:func:`contamination` with ``key``, the hash of the text."""
    scans = [_scanned(docs, grams, id_col, text_col) for grams in _parts(benchmark, n, item_col, item_text_col)]
    if len(scans) == 1:
        return scans[0].select(id_col, "key", "n_words", F.size("hits").cast("bigint").alias("n_hit"), "items", "spans")
    rows = scans[0]
    hits = scans[0].where("size(hits) > 0")
    for more in scans[1:]:
        hits = hits.unionByName(more.where("size(hits) > 0"))
    whole = hits.groupBy(F.col(id_col).alias("__i"), F.col("key").alias("__k")).agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("bigint").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"))
    base = rows.select(id_col, "key", "n_words")
    return base.join(whole, F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("key") == F.col("__k")), "left").select(
        id_col, "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<begin:bigint,end:bigint>>")).alias("spans"))


def _spans(data: np.ndarray, words: K.Words, hit: np.ndarray, d: int, base: int) -> list[dict[str, int]]:
    """Hit runs of one text as character offsets (bytes that continue a character don't count)."""
    a, b = int(words.first[d]), int(words.first[d + 1])
    edge = np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]]))
    out = []
    chars = lambda to: int(np.count_nonzero((data[base:to] & 0xC0) != 0x80))
    for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        out.append({"begin": chars(int(words.starts[a + i])), "end": chars(int(words.ends[a + j - 1]))})
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, action: str = "documents",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without benchmark text. ``action="documents"`` drops every document with a
    verified hit; ``"spans"`` cuts the hit runs out of the text and keeps the document.

    All columns of ``docs`` are returned as they are named there. A null id never matches
    the list of hits, so such a row is kept unchanged. Rows that share an id share a verdict, but
    each text is cut at its own spans."""
    if action not in ("documents", "spans"):
        raise ValueError("action is 'documents' or 'spans'")
    if action == "documents":
        return without_ids(docs, contamination(docs, benchmark, n, id_col, text_col).where("n_hit > 0").select(id_col), id_col)
    found = _found(docs, benchmark, n, id_col, text_col).where("n_hit > 0")
    cuts = found.groupBy(F.col(id_col).alias("__llm_id"), F.col("key").alias("__llm_key")).agg(F.first("spans").alias("__llm_spans"))
    joined = docs.join(cuts, (docs[id_col] == cuts["__llm_id"]) & (F.xxhash64(docs[text_col]) == cuts["__llm_key"]), "left")
    keep = F.aggregate(
        "__llm_spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.struct(F.concat(acc["out"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.greatest(s["begin"] - acc["at"], F.lit(0)).cast("int"))).alias("out"),
                                F.greatest(acc["at"], s["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    text = F.when(F.col("__llm_id").isNull(), F.col(text_col)).otherwise(keep)
    return joined.select(*[text.alias(c) if c == text_col else docs[c] for c in docs.columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the registered query."""
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def items_sha256(ids: list[object]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


#: DuckDB SQL of the registered query (windows as word lists, exact).
SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(10, len(w)) AS n FROM bw WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
          FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
sizes AS (SELECT DISTINCT n FROM grams),
win AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hits AS (SELECT DISTINCT win.doc_id, win.n, win.i, grams.item_id FROM win JOIN grams USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
