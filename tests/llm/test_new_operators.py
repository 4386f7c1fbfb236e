"""Prefix trie, language-model scores and whitening: against brute force on small rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from frontier.llm import ngrams, trie, whitening
from frontier.llm.labelled import held_out
from frontier.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# prefix trie

def rebuilt(rows):
    """Rebuilt conversations from (conv, turn, role, text), by the definition."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - int(math.fmod(c, 100))
        out[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    return out


def brute_trie(rows):
    members = defaultdict(list)
    whole = rebuilt(rows)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ended = ",".join(map(str, sorted(c for c in cs if len(whole[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), sum(len(q) == len(p) + 1 for q in below),
                    sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below) for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out)


def trie_rows(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, h0 string, depth int")
    return sorted(map(tuple, trie.prefix_trie(df.repartition(3), **options).collect()))


def odd_conversations():
    rows = []
    for c in range(230):
        for t in range(c % 7):
            rows.append((c, t, "user" if t % 2 else None, f"é{(c // 3 + t) % 4}" * (t + 1) if c % 5 else "same 😀"))
    rows += [(-7, None, "a", None), (-7, 1, None, "b"), (-107, 3, "a", "x"), (None, 0, "user", "lost"), (400, 2, "u", "tie"), (400, 2, "u", "a"), (400, None, "u", "n")]
    rows += [(300, 5, "user", "again")] * 40          # repeated rows are turns
    rows += [(500 + c, t, "u", f"t{t}") for c in range(100) for t in range(3)]  # copies
    rows += [(700, t, "u", f"long {t % 3}") for t in range(300)]
    return rows


def test_trie_matches_brute_force(spark):
    rows = odd_conversations()
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_over_many_small_ranges(spark, monkeypatch):
    rows = odd_conversations()[-700:]
    expected = brute_trie(rows)
    monkeypatch.setattr(trie, "RANGE", 64)
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "DIGEST_BLOCK", 8)
    assert trie_rows(spark, rows, per_range=64) == expected


def test_trie_of_nothing(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "u", "x")]) == []
    only = trie_rows(spark, [(7, 0, None, None)])
    assert only == brute_trie([(7, 0, None, None)])


@pytest.mark.parametrize("gain", [0.0, 1.1])
def test_list_rank_of_a_shuffled_list(spark, gain):
    """Without any order to gain from, by pointer jumping (0) and by contraction alone (1.1)."""
    order = np.random.default_rng(3).permutation(3000)
    rows = [(int(a), int(b)) for a, b in zip(order[:-1], order[1:], strict=True)] + [(int(order[-1]), None)]
    found = trie.list_rank(spark.createDataFrame(rows, "arc long, next long"), per_range=200 if gain < 1 else 1500, least_gain=gain)
    assert dict(map(tuple, found.collect())) == {int(a): i for i, a in enumerate(order)}


# language model

def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def brute_base(rows, learned):
    c = Counter(w for i, t in rows if learned(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    return n, [(i, len(words(t)), sum(c[w] > 0 for w in words(t)), sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t))) for i, t in rows]


def brute_model(rows, kinds, order):
    """Log-probabilities by dictionaries, with the library's EM on events of its own."""
    def counted(which):
        grams, ctx = Counter(), Counter()
        for (_, t), kind in zip(rows, kinds, strict=True):
            if kind in which:
                s = ["<s>"] * (order - 1) + words(t)
                for e in range(order - 1, len(s)):
                    for k in range(1, order + 1):
                        grams[tuple(s[e - k + 1:e + 1])] += 1
                        ctx[tuple(s[e - k + 1:e])] += 1
        return grams, ctx

    def estimates(t, grams, ctx):
        s = ["<s>"] * (order - 1) + words(t)
        for e in range(order - 1, len(s)):
            r, bucket = [], 0
            for k in range(1, order + 1):
                c = ctx[tuple(s[e - k + 1:e])]
                r.append(grams[tuple(s[e - k + 1:e + 1])] / c if c else 0.0)
                if k > 1 and c:
                    bucket = (k - 1) * 64 + c.bit_length()
            yield bucket, r

    left, every = counted({1}), counted({1, 2})
    size = lambda grams: sum(len(g) == 1 for g in grams)
    events = [(b, 1.0, r) for (_, t), kind in zip(rows, kinds, strict=True) if kind == 2 for b, r in estimates(t, *left)]
    weights = ngrams.learn_weights(events, order, size(left[0]))
    out = []
    for _, t in rows:
        total = 0.0
        for b, r in estimates(t, *every):
            w = weights.one(b)
            total += math.log10(w[0] / (size(every[0]) + 1) + sum(x * y for x, y in zip(w[1:], r, strict=True)))
        out.append(total)
    return out


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "a B c d e f"), (5, "a B c d e f"), (None, "null id a b"), (7, "é日 😀 ÀB x " * 50), (8, "w " * 3000), (9, "z" * 20000)]


@pytest.mark.parametrize(("order", "block"), [(2, 1 << 20), (2, 37), (3, 50), (1, 64)])
def test_scores_match_brute_force(spark, order, block):
    given = [(r["doc_id"] + 100, r["text"][:2000]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    rows = EDGE + given
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, block string, n int")
    learned = {r["doc_id"]: not r["h"] for r in df.select("doc_id", held_out("doc_id", 5, 1).alias("h")).collect()}
    deleted = {r["doc_id"]: r["d"] for r in df.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(10)) == 0).alias("d")).collect()}
    found = ngrams.score(df.coalesce(2), learn=~held_out("doc_id", 5, 1), order=order, block_tokens=block, range_keys=500).collect()
    n, base = brute_base(rows, learned.get)
    assert {r["train_tokens"] for r in found} == {n}
    key = lambda r: (r[0] is not None, r[0], r[1])
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in found), key=key)
    kinds = [(2 if deleted[i] else 1) if learned[i] else 0 for i, _ in rows]
    expected = sorted([(*b, s) for b, s in zip(base, brute_model(rows, kinds, order), strict=True)], key=key)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    np.testing.assert_allclose([g[3] for g in got], [e[3] for e in expected], rtol=1e-9)
    # cells hold mean estimates of an octave each, so weights differ a little
    np.testing.assert_allclose([g[4] for g in got], [e[4] for e in expected], rtol=0.02)


def test_model_is_a_distribution(spark):
    """Probabilities of all words and one unknown after any context sum to 1."""
    weights = ngrams.learn_weights([(0, 5.0, [0.1, 0.0]), (66, 9.0, [0.05, 0.4]), (66, 3.0, [0.0, 0.0])], 2, 20)
    for bucket in (0, 66, 70):
        w = weights.one(bucket)
        assert w.sum() == pytest.approx(1) and (w >= 0).all() and w[0] > 0
    assert weights.one(0)[2] == 0  # an unseen context has no estimate


def test_scores_of_nothing_and_of_untrained(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngrams.score(empty).collect() == []
    found = ngrams.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), learn=F.lit(False)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found) == [
        (1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]


def test_model_beats_the_base_on_held_out_documents(spark):
    """Held-out texts of the 0.01 table: the mixture finds them likelier than add-half unigrams."""
    rows = QUERIES["op12_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
    assert rows[2] > rows[1]


# whitening

def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, component string")


def brute_whiten(rows, k=32):
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for _, v in rows], np.int64)
    n, s = len(x), x.sum(axis=0)
    d = (n * x - s) / n
    e, q = np.linalg.eigh(d.T @ d / n)
    e, q = e[::-1], q[:, ::-1]
    k = min(k, int((e > len(e) * np.finfo(float).eps * e[0]).sum()))
    return n, ((n * x - s) ** 2).sum(axis=1), d @ q[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


@pytest.mark.parametrize(("n", "dims"), [(300, 64), (40, 7), (20, 64)])
def test_whitening_matches_dense_eigenvectors(spark, n, dims, monkeypatch):
    monkeypatch.setattr(whitening, "PACK", 16)
    rng = np.random.default_rng(n + dims)
    mixed = rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims)) * np.exp(-np.arange(dims) / 9)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)] + [(None, [1.0] * dims), (1000, [0.5] * dims), (1000, [0.5] * dims)]
    bad = [(900, None), (901, [1.0, None] + [0.0] * (dims - 2)), (902, [math.nan] * dims), (903, [math.inf] * dims), (904, [1.0] * (dims + 1)), (905, [])]
    found = whitening.whiten(vectors(spark, rows + bad).repartition(5)).collect()
    size, deviation, white, explained = brute_whiten(rows)
    k = white.shape[1]
    assert len(found) == len(rows) * k and {r["n"] for r in found} == {size} and {r["vec_id"] for r in found} == {i for i, _ in rows}
    assert {r["identity_error"] for r in found} == {found[0]["identity_error"]} and found[0]["identity_error"] < 1e-6
    by = {(r["vec_id"], r["component"]): r for r in found}
    got = np.array([[by[i, j + 1]["whitened"] for j in range(k)] for i, _ in rows])
    got *= np.sign((got * white).sum(axis=0))
    np.testing.assert_allclose(got, white, atol=2e-6)
    np.testing.assert_allclose([by[rows[0][0], j + 1]["explained"] for j in range(k)], explained, rtol=1e-9)
    assert [by[i, 1]["deviation"] for i, _ in rows] == deviation.tolist()


def test_whitening_without_spread(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.25, 0.5])])).collect() == []
    assert whitening.whiten(vectors(spark, [(i, [0.25, 0.5]) for i in range(9)])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, []), (2, [])])).collect() == []
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0]) for i in range(9)], "double")).collect()
    assert {r["component"] for r in line} == {1} and line[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize(("dims", "wanted", "space"), [(200, 32, None), (120, 10, 24), (30, 30, None)])
def test_leading_pairs_reach_double_precision(dims, wanted, space):
    rng = np.random.default_rng(dims)
    a = rng.standard_normal((dims, dims)) * np.exp(-np.arange(dims) / 15)
    v = a @ a.T
    values, axes = whitening.leading_pairs(lambda q: v @ q, dims, wanted, max_space=space)
    top = np.linalg.eigvalsh(v)[::-1][:wanted]
    np.testing.assert_allclose(values, top, atol=1e-12 * top[0])
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() <= whitening.TOLERANCE * top[0] * 4
    np.testing.assert_allclose(axes.T @ axes, np.eye(wanted), atol=1e-12)


def test_equal_eigenvalues(spark):
    v = np.diag([5.0, 5, 5, 5, 1, 1, 0, 0, 0, 0])
    values, axes = whitening.leading_pairs(lambda q: v @ q, 10, 8)
    np.testing.assert_allclose(values, [5, 5, 5, 5, 1, 1, 0, 0], atol=1e-13)
    np.testing.assert_allclose(axes.T @ axes, np.eye(8), atol=1e-12)
