"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

The rows of a bounded labelled sample are the examples. Terms are the lower-cased words of their
texts and, as stems, the first 4 and 6 characters of longer words, known by hashes of 52 bits; the
terms of the examples are the axes of the vector space, and a query is the unit TF-IDF vector of
its terms among them (1 + log of the count, document frequencies over all documents). Examples lie
in blocks of like rows. Rare terms have lists of rows; frequent ones have their lists by block,
with the largest weight in every block. A block is summed up for a query only while its bound (the
largest sum of the rare terms in it, and the block maxima of the frequent ones) reaches the k-th
best similarity, so the neighbours are exact. They are returned as evidence.

Whole texts tell mostly what a text is about. So a second vote is taken from an index over the
terms that tell toxic examples apart (significantly more often there, by chi-square, and in toxic
rows for a good part of the time). Votes weigh by similarity, with a prior. A logistic fit makes
one probability of both, and of the first where a text has none of the telling terms; it learns
from the examples' own votes, in which an example is no neighbour of its own, and telling terms
are chosen, and neighbours taken, from the other folds.

Defined results: a text that shares no term with an example (null and empty ones too) gets the
toxic share of the examples without a term, or of all if there are none; ties between examples
go to the smaller id; repeated rows get equal scores; a sampled id with several texts is an
example by the one with the smallest hash; without toxic or without other labelled rows every
score is that share.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from frontier.session import cut_lineage

from . import kernels as K
from .labelled import one_text, sample
from .ngrams import packed, unpacked
from .removal import without_ids

#: Labelled rows in the sample, and distinct terms of all of them (both bound what is broadcast).
MAX_EXAMPLES, MAX_ENTRIES = 3000, 2_500_000
#: Least chi-square of a telling term (beyond what chance gives among millions of terms), and
#: least share of toxic rows among those that have it.
LEAST_CHI2 = 25.0
LEAST_SHARE = 0.3
STEMS, K_NEAREST, FOLDS = (4, 6), 15, 4
#: Weight of the prior beside the neighbours' similarities.
PRIOR_WEIGHT = 0.5
#: Rows of a block; share of the examples from which on a term is frequent; texts that are looked
#: up together, blocks that each tries first, and postings summed at once. They change the time,
#: not the results.
BLOCK_ROWS, FREQUENT, TOGETHER, TRIED_FIRST, POSTINGS = 64, 0.05, 64, 4, 1 << 18
_DOC_BITS, _CHUNK = 12, 1 << 14


def _spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hash of the bytes of short spans."""
    out = sizes.astype(K.U64)
    for j in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > j)
        out[live] = out[live] * K.U64(K._BASE) + data[starts[live] + j]
    return K.mix(out)


def bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of at most 4096 texts, in this order; terms are the hashes' high bits."""
    data, offsets = K.text_bytes(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")))
    words = K.find_words(data, offsets, K.ALNUM, K.SAME)
    doc, term = [words.doc], [words.hashes]
    begins = np.append(np.flatnonzero((data[:offsets[-1]] & 0xC0) != 0x80), offsets[-1])
    first = np.searchsorted(begins, words.starts)
    for n in STEMS:
        end = begins[np.minimum(first + n, len(begins) - 1)]
        longer = np.flatnonzero(end < words.ends)
        doc.append(doc[0][longer])
        term.append(_spans(data, words.starts[longer], end[longer] - words.starts[longer]) ^ K.mix(np.array([n], K.U64)))
    low = K.U64(64 - _DOC_BITS)
    key = np.sort((np.concatenate(doc).astype(K.U64) << low) | (np.concatenate(term) >> K.U64(_DOC_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    key = key[begin]
    return (key >> low).astype(np.int64), key & ((K.U64(1) << low) - K.U64(1)), np.diff(np.append(begin, int(sum(map(len, term)))))


def _groups(column: pa.Array):
    """Consecutive texts of a column."""
    _, offsets = K.text_bytes(column)
    for lo, hi in K.row_groups(offsets):
        for at in range(lo, hi, 1 << _DOC_BITS):
            yield column.slice(at, min(hi - at, 1 << _DOC_BITS))


class Terms:
    """Places of terms in a sorted array; it travels packed."""

    _BITS = 20

    def __init__(self, terms: np.ndarray):
        self.size, self.data = len(terms), packed(np.diff(terms, prepend=K.U64(0)))

    def __getstate__(self):
        return {"size": self.size, "data": self.data}

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        terms = np.cumsum(unpacked(self.data), dtype=K.U64)
        return terms, np.searchsorted(terms, np.arange((1 << self._BITS) + 1, dtype=K.U64) << K.U64(64 - _DOC_BITS - self._BITS)).astype(np.int32)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of every term, or -1."""
        have, first = self._table
        slot = (terms >> K.U64(64 - _DOC_BITS - self._BITS)).astype(np.int64)
        at, end = first[slot], first[slot + 1]
        out = np.full(len(terms), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            same = have[at[open_]] == terms[open_]
            out[open_[same]] = at[open_[same]]
            open_ = open_[~same]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return out


def _example_bags(rows: DataFrame) -> DataFrame:
    """(id, label, n, terms, counts) of the whole texts of ``rows`` (id, label, text), written."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        terms, counts, size = [], [], []
        for texts in _groups(batch.column(2)):
            doc, term, count = bags(texts)
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            size += np.diff(cut).tolist()
            terms += [packed(np.diff(term[a:b], prepend=K.U64(0))) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            counts += [packed(count[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                                          names=["id", "label", "n", "terms", "counts"])

    kind = rows.schema["id"].dataType.simpleString()
    return cut_lineage(K.text_map(rows, run, f"id {kind}, label int, n bigint, terms binary, counts binary"))


def telling(total: np.ndarray, toxic: np.ndarray, n_toxic: int, n_other: int) -> np.ndarray:
    """Sorted places of the telling terms, from the number of examples and of toxic examples that have each term."""
    a, b, n = toxic.astype(float), (total - toxic).astype(float), float(n_toxic + n_other)
    if not n_toxic or not n_other:
        return np.zeros(0, np.int64)
    det = a * (n_other - b) - b * (n_toxic - a)
    chi2 = det * det * n / (n_toxic * n_other * np.maximum(a + b, 0.5) * np.maximum(n - a - b, 0.5))
    return np.flatnonzero((a * n_other > b * n_toxic) & (a >= LEAST_SHARE * (a + b)) & (chi2 >= LEAST_CHI2))


def frequencies(docs: DataFrame, terms: Terms) -> tuple[np.ndarray, int]:
    """The number of documents with each term, and of all documents."""
    shared, n = docs.sparkSession.sparkContext.broadcast(terms), terms.size

    def count(batches):
        found = np.zeros(n + 1, np.int64)
        for batch in batches:
            for texts in _groups(batch.column(0)):
                place = shared.value.find(bags(texts)[1])
                found[:n] += np.bincount(place[place >= 0], minlength=n)
            found[n] += batch.num_rows
        if found[n]:
            starts = range(0, n + 1, _CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int32()), pa.array([packed(found[a:a + _CHUNK]) for a in starts], pa.binary())], names=["start", "n"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[start] = sums.get(start, 0) + unpacked(part).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array([packed(v) for v in sums.values()], pa.binary())], names=["start", "n"])

    K.bounded_batches(docs.sparkSession)
    parts = docs.select("text").mapInArrow(count, "start int, n binary").repartition("start").mapInArrow(add, "start int, n binary")
    out = np.zeros(n + 1, np.int64)
    for r in parts.collect():
        part = unpacked(bytes(r.n)).astype(np.int64)
        out[r.start:r.start + len(part)] = part
    return out[:n], int(out[n])


def _heaviest(cut: np.ndarray, place: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The term with the largest ``key`` of every row, or -1."""
    out = np.full(len(cut) - 1, -1, np.int64)
    some = np.flatnonzero(np.diff(cut))
    if len(some):
        at = np.flatnonzero(key == np.repeat(np.maximum.reduceat(key, cut[some]), np.diff(cut)[some]))
        out[some] = place[at[np.searchsorted(at, cut[some])]]
    return out


class Index:
    """Unit TF-IDF vectors of examples, by inverted lists in blocks of like rows."""

    def __init__(self, cut: np.ndarray, place: np.ndarray, count: np.ndarray, idf: np.ndarray, rank: np.ndarray):
        """Row ``i`` has the terms ``place[cut[i]:cut[i + 1]]``; ``rank`` settles ties."""
        n = len(cut) - 1
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(cut))
        weight = np.log(count, dtype=float)
        weight += 1
        weight *= idf[place]
        weight /= np.sqrt(np.bincount(row, weight * weight, n))[row]
        have = np.bincount(place, minlength=len(idf))
        frequent = np.flatnonzero(have > max(8, FREQUENT * n))
        self.line = np.full(len(idf), -1, np.int32)
        self.line[frequent] = np.arange(len(frequent))
        # like rows share a block: those with the same heaviest frequent term, and the same heaviest term
        common = self.line[place] >= 0
        heads = [_heaviest(cut, place, key) for key in (np.where(common, weight, 0), weight)]
        self.order = np.lexsort((rank, heads[1], heads[0]))
        self.at = np.empty(n, np.int32)
        self.at[self.order] = np.arange(n)
        self.rank, self.n, self.idf = rank[self.order], n, idf
        self.starts = np.arange(0, n, BLOCK_ROWS)
        self.lists = np.zeros((len(frequent), n))
        self.lists[self.line[place[common]], self.at[row[common]]] = weight[common]
        self.most = np.maximum.reduceat(self.lists, self.starts, axis=1) if n else np.zeros((len(frequent), 0))
        self.first = np.concatenate([[0], np.cumsum(np.where(self.line < 0, have, 0))])
        row, weight, place = self.at[row[~common]], weight[~common], place[~common]
        by = np.argsort(place, kind="stable")
        self.rows, self.weights = row[by], weight[by]

    def queries(self, doc: np.ndarray, at: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
        """Weights of the unit vectors of ``n`` texts."""
        w = (1 + np.log(count)) * self.idf[at]
        return w / np.sqrt(np.bincount(doc, w * w, n))[doc]

    def _rare(self, doc: np.ndarray, at: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
        """Sums over the lists of the rare terms, by text and row."""
        out = np.zeros(n * self.n)
        size = self.first[at + 1] - self.first[at]
        some = np.flatnonzero(size)
        doc, at, q, size = doc[some], at[some], q[some], size[some]
        ends, lo = np.cumsum(size), 0
        while lo < len(at):
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + POSTINGS, "right")))
            k, d = size[lo:hi], int(doc[lo])
            place = np.repeat(self.first[at[lo:hi]] - (ends[lo:hi] - k), k) + np.arange(before, int(ends[hi - 1]))
            to = (int(doc[hi - 1]) + 1 - d) * self.n
            out[d * self.n:d * self.n + to] += np.bincount(self.rows[place] + np.repeat((doc[lo:hi] - d) * self.n, k), np.repeat(q[lo:hi], k) * self.weights[place], to)
            lo = hi
        return out.reshape(n, self.n)

    def nearest(self, doc: np.ndarray, at: np.ndarray, q: np.ndarray, n: int, skip: np.ndarray | None = None, k: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """Rows and similarities of the ``k`` most similar examples with a shared term, for ``n``
        texts with terms ``at`` and weights ``q`` (sorted by ``doc``); ``skip``: a row that each leaves out."""
        k, out = k or K_NEAREST, []
        for lo in range(0, n, TOGETHER):
            hi = min(n, lo + TOGETHER)
            a, b = np.searchsorted(doc, (lo, hi))
            out += self._nearest(doc[a:b] - lo, at[a:b], q[a:b], hi - lo, None if skip is None else self.at[skip[lo:hi]], k)
        return out

    def _nearest(self, doc, at, q, n, skip, k):
        if not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * n
        line = self.line[at]
        frequent = line >= 0
        sims = self._rare(doc[~frequent], at[~frequent], q[~frequent], n)
        dense = np.zeros((n, len(self.lists)))
        dense[doc[frequent], line[frequent]] = q[frequent]
        bound = np.maximum.reduceat(sims, self.starts, axis=1) + dense @ self.most
        if skip is not None:
            sims[np.arange(n), skip] = -np.inf
        done = np.zeros(bound.shape, bool)

        def sum_up(todo):
            for b in np.flatnonzero(todo.any(axis=0)):
                some, rows = np.flatnonzero(todo[:, b]), slice(int(self.starts[b]), int(self.starts[b]) + BLOCK_ROWS)
                sims[some, rows] += dense[some] @ self.lists[:, rows]
            done[todo] = True

        if bound.shape[1] > TRIED_FIRST:
            todo = np.zeros(bound.shape, bool)
            todo[np.arange(n)[:, None], np.argpartition(-bound, TRIED_FIRST, axis=1)[:, :TRIED_FIRST]] = True
            sum_up(todo)
        # what is summed so far never exceeds a similarity, so its k-th largest is a bound below
        least = np.partition(sims, self.n - k, axis=1)[:, self.n - k] if self.n > k else np.zeros(n)
        sum_up(~done & (bound > 0) & (bound >= least[:, None] - 1e-12))
        sims[~np.repeat(done, np.diff(np.append(self.starts, self.n)), axis=1)] = -np.inf
        least = np.partition(sims, self.n - k, axis=1)[:, self.n - k] if self.n > k else np.zeros(n)
        text, row = np.nonzero((sims >= least[:, None] - 1e-12) & (sims > 0))
        cut = np.searchsorted(text, np.arange(n + 1))
        out = []
        for d in range(n):
            here = row[cut[d]:cut[d + 1]]
            s = sims[d, here]
            best = np.lexsort((self.rank[here], -np.round(s, 12)))[:k]
            out.append((self.order[here[best]], s[best]))
        return out


def _logit(p: np.ndarray | float) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Examples:
    """The examples: packed as they travel, with indexes that a process builds when it needs them."""

    def __init__(self, rows: list, terms: Terms, places: list[np.ndarray], counts: list[np.ndarray], df: np.ndarray, total: int):
        """``rows``: (id, label)."""
        empty = [y for (_, y), p in zip(rows, places, strict=True) if not len(p)]
        every = empty or [y for _, y in rows]
        self.empty_share = (sum(every) + 0.5) / (len(every) + 1.0)
        filled = [i for i, p in enumerate(places) if len(p)]
        self.ids, self.labels = [rows[i][0] for i in filled], np.array([rows[i][1] for i in filled], float)
        self.n = len(filled)
        self.prior = float(self.labels.mean()) if self.n else self.empty_share
        self.terms, self.total = terms, total
        self.data = {"size": np.array([len(places[i]) for i in filled], np.int64), "df": packed(df),
                     "place": packed(np.concatenate([np.zeros(0, np.int64), *(np.diff(places[i], prepend=0) for i in filled)])),
                     "count": packed(np.concatenate([np.zeros(0, np.int64), *(counts[i] for i in filled)]))}
        self.fit: np.ndarray | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("parts", "indexes", "whole", "told_by_fold", "idf")}

    @cached_property
    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.concatenate([[0], np.cumsum(self.data["size"])]).astype(np.int64)
        total = np.cumsum(unpacked(self.data["place"]).view(np.int64))
        total -= np.repeat(np.concatenate([[0], total])[cut[:-1]], np.diff(cut))
        return cut, total.astype(np.int32), unpacked(self.data["count"]).astype(np.int32)

    @cached_property
    def idf(self) -> np.ndarray:
        return np.log((1 + self.total) / (1 + unpacked(self.data["df"]).astype(float))) + 1

    @property
    def rank(self) -> np.ndarray:
        place = {x: k for k, x in enumerate(sorted(set(self.ids)))}
        return np.array([place[x] for x in self.ids], np.int64)

    @cached_property
    def whole(self) -> Index:
        return Index(*self.parts, self.idf, self.rank)

    def _telling(self, rows: np.ndarray) -> tuple[np.ndarray, Index]:
        """The number of every telling term (or -1), and the index over these, from some examples."""
        cut, place, count = self.parts
        row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(cut))
        mine, size = rows[row], len(self.idf)
        toxic = mine & (self.labels[row] == 1)
        n_toxic = int((rows & (self.labels == 1)).sum())
        told = telling(np.bincount(place[mine], minlength=size), np.bincount(place[toxic], minlength=size), n_toxic, int(rows.sum()) - n_toxic)
        number = np.full(size, -1, np.int64)
        number[told] = np.arange(len(told))
        used = np.flatnonzero(mine & (number[place] >= 0))
        return number, Index(np.searchsorted(row[used], np.arange(self.n + 1)), number[place[used]], count[used], self.idf[told], self.rank)

    @cached_property
    def indexes(self) -> tuple[Index, tuple[np.ndarray, Index]]:
        """By all terms and by the telling ones; the parts they are made of are let go."""
        made = Index(*self.parts, self.idf, self.rank), self._telling(np.ones(self.n, bool))
        del self.__dict__["parts"]
        return made

    @cached_property
    def told_by_fold(self) -> list[tuple[np.ndarray, Index]]:
        return [self._telling(self.fold != f) for f in range(FOLDS)]

    @property
    def fold(self) -> np.ndarray:
        return (K.mix(np.arange(self.n)) % K.U64(FOLDS)).astype(np.int64)

    def vote(self, places: np.ndarray, sims: np.ndarray) -> float:
        return float((sims @ self.labels[places] + PRIOR_WEIGHT * self.prior) / (sims.sum() + PRIOR_WEIGHT))

    def _told_votes(self, told: tuple[np.ndarray, Index], doc, at, count, n: int) -> list[float | None]:
        number, index = told
        some = number[at] >= 0
        doc, at, count = doc[some], number[at[some]], count[some]
        texts, doc = np.unique(doc, return_inverse=True)
        out: list[float | None] = [None] * n
        for d, (places, sims) in zip(texts, index.nearest(doc, at, index.queries(doc, at, count, len(texts)), len(texts)), strict=True):
            out[d] = self.vote(places, sims)
        return out

    def own_votes(self, rows: np.ndarray) -> tuple[list[float], list[float | None]]:
        """Both votes for some of the examples, none of which is its own neighbour."""
        cut, place, count = self.parts
        at = np.concatenate([np.zeros(0, np.int64), *(np.arange(cut[i], cut[i + 1]) for i in rows)]).astype(np.int64)
        doc = np.repeat(np.arange(len(rows)), cut[rows + 1] - cut[rows])
        found = self.whole.nearest(doc, place[at], self.whole.queries(doc, place[at], count[at], len(rows)), len(rows), skip=rows)
        told: list[float | None] = [None] * len(rows)
        fold = self.fold[rows]
        for f, index in enumerate(self.told_by_fold):
            mine = fold[doc] == f
            for d, v in enumerate(self._told_votes(index, doc[mine], place[at[mine]], count[at[mine]], len(rows))):
                told[d] = v if fold[d] == f else told[d]
        return [self.vote(*x) for x in found], told

    def features(self, own: float, told: float | None) -> list[float]:
        """One set of numbers where telling terms vote, and one where none is there."""
        x = float(_logit(own) - _logit(self.prior))
        return [1.0, 0.0, 0.0, 1.0, x] if told is None else [1.0, x, float(_logit(told)), 0.0, 0.0]

    def learn(self, votes: list[tuple[int, float, float | None]]) -> None:
        """Logistic fit of labels on the examples' own votes (row, whole, told)."""
        x = np.array([self.features(own, told) for _, own, told in votes])
        y, fit = self.labels[[i for i, _, _ in votes]], np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ fit, -30, 30)))
            ridge = 0.1 * np.array([0.0, 1, 1, 1, 1])
            hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
            fit += np.clip(np.linalg.solve(hessian, x.T @ (y - p) - ridge * fit), -2, 2)
        self.fit = fit

    def score(self, texts: pa.Array) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, and places and similarities of the neighbours, of every text."""
        n = len(texts)
        if not self.n:
            return [(self.empty_share, np.zeros(0, np.int64), np.zeros(0))] * n
        doc, term, count = bags(texts)
        at = self.terms.find(term)
        known = np.flatnonzero(at >= 0)
        doc, at, count = doc[known], at[known], count[known]
        whole, telling_ = self.indexes
        found = whole.nearest(doc, at, whole.queries(doc, at, count, n), n)
        told = self._told_votes(telling_, doc, at, count, n) if self.fit is not None else [None] * n
        out = []
        for (places, sims), t in zip(found, told, strict=True):
            if not len(places):
                p = self.empty_share
            elif self.fit is None:
                p = self.empty_share if self.prior in (0.0, 1.0) else self.vote(places, sims)
            else:
                p = float(1 / (1 + np.exp(-np.clip(np.dot(self.features(self.vote(places, sims), t), self.fit), -30, 30))))
            out.append((p, places, sims))
        return out


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          where: Column | None = None, max_examples: int = MAX_EXAMPLES, max_entries: int = MAX_ENTRIES) -> Examples:
    """Examples from the labelled rows for which ``where`` holds, in the order of their ids'
    hashes, as long as their distinct terms come to ``max_entries`` at most."""
    docs = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    K.bounded_batches(spark)
    rows = one_text(docs.withColumnRenamed("doc", "id"), cut_lineage(sample(labels, id_col, label_col, max_examples, where)))
    made = _example_bags(rows)
    sizes = sorted((r.h, r.n) for r in made.select(F.xxhash64("id").alias("h"), "n").collect())
    within = np.cumsum([n for _, n in sizes]) <= max_entries
    last = sizes[int(within.sum()) - 1][0] if within.any() else None
    found = sorted(((r.id, r.label, bytes(r.terms), bytes(r.counts)) for r in made.where(F.xxhash64("id") <= F.lit(last)).toLocalIterator()), key=lambda r: r[0]) if last is not None else []
    terms = [np.cumsum(unpacked(r[2]), dtype=K.U64) for r in found]
    known = np.unique(np.concatenate([np.zeros(0, K.U64), *terms]))
    places = [np.searchsorted(known, t) for t in terms]
    df, total = frequencies(docs, Terms(known))
    examples = Examples([r[:2] for r in found], Terms(known), places, [unpacked(r[3]).astype(np.int64) for r in found], df, total)
    n_toxic = int((examples.labels == 1).sum())
    if examples.n >= 20 and 0 < n_toxic < examples.n:
        shared = spark.sparkContext.broadcast(examples)

        def votes(batches):
            for batch in batches:
                at = batch.column(0).to_numpy()
                own, told = shared.value.own_votes(at)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.float64()), pa.array(told, pa.float64())], names=["i", "own", "told"])

        parts = max(1, min(spark.sparkContext.defaultParallelism, examples.n // 100))
        examples.learn(sorted(map(tuple, spark.range(0, examples.n, 1, parts).mapInArrow(votes, "i bigint, own double, told double").collect())))
    return examples


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          where: Column | None = None, max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """``id_col``, ``score`` (0 to 1) and ``evidence`` (nearest examples: id, similarity, label)
    of every row of ``docs``; examples come from the labelled rows for which ``where`` holds."""
    examples = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, id_col, text_col, label_col, where, max_examples))
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = pa.int64() if kind in ("bigint", "int") else pa.string()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ex = examples.value
        ids, scores, sizes, places, sims = pa.array(ex.ids, id_type), [], [0], [np.zeros(0, np.int64)], [np.zeros(0)]
        for texts in _groups(batch.column(1)):
            for s, at, sim in ex.score(texts):
                scores.append(s)
                sizes.append(len(at))
                places.append(at)
                sims.append(sim)
        at = np.concatenate(places)
        evidence = pa.StructArray.from_arrays([ids.take(pa.array(at)), pa.array(np.concatenate(sims)), pa.array(ex.labels[at].astype(np.int32))], names=["id", "similarity", "label"])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), evidence)],
                                          names=[id_col, "score", "evidence"])

    id_sql = "bigint" if id_type == pa.int64() else "string"
    return K.text_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, score double, evidence array<struct<id:{id_sql},similarity:double,label:int>>")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
               where: Column | None = None) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; rows with a null id stay."""
    bad = score(docs, labels, id_col, text_col, where=where).where(F.col("score") >= threshold)
    return without_ids(docs, bad.select(id_col), id_col)
