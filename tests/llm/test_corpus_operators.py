"""Operators over the whole corpus, and the pipeline: against brute force."""

import importlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from frontier.llm import linededup, minhash, quality, rules, toxicity
from frontier.llm.grams import Texts
from frontier.llm.labelled import held_out, sample
from frontier.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def docs(spark, rows, **more):
    return spark.createDataFrame([(i, t, *more.values()) for i, t in rows], "doc_id long, text string" + "".join(f", {k} string" for k in more))


# near duplicates

def brute_groups(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is not None and rows[b][0] is not None and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        low[find(k)].append(i)
    return Counter((i, len(sets[k]), None if i is None else min(low[find(k)]), i is None or i == min(low[find(k)])) for k, (i, _) in enumerate(rows))


def mutated(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(8)
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a b c"), (None, "a b c"), (None, None)]
    for family in range(6):  # drifting copies: chains at the bound, and hubs that aren't the smallest id
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([12, 60, 200]))]
        for _ in range(25):
            rows.append((len(rows) * 7 % 1009 + 10, " ".join(mutated(rng, base, rng.choice([0, 0.01, 0.03, 0.05])))))
            if rng.random() < 0.5:
                base = mutated(rng, base, 0.02)
    rows.append((5000, rows[-1][1]))
    out = minhash.near_duplicates(docs(spark, rows, component="x", key="y", sig="z", n="q"))
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()) == brute_groups(rows)


def test_near_duplicates_over_a_hub_that_is_no_end(spark):
    """Many copies whose links only go through one middle document."""
    rng = random.Random(1)
    base = [f"w{k}" for k in range(400)]
    rows = [(500, " ".join(base))]
    for k in range(60):
        at = rng.sample(range(0, 396, 5), 7)
        rows.append((k if k % 2 else 900 + k, " ".join("x" + str(rng.random()) if i in at else w for i, w in enumerate(base))))
    out = minhash.near_duplicates(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out) == brute_groups(rows)


def test_near_duplicates_in_many_blocks(spark, monkeypatch):
    """Blocks of three rows: groups whose links are found between blocks only."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)
    test_near_duplicates_over_a_hub_that_is_no_end(spark)


def test_members_of_a_large_component_are_dealt_once(spark):
    """A pivot's large component doesn't meet itself, and only what can be near to a row of
    another component is dealt at all."""
    rows = [(0, k, 0, 0.8) for k in range(1000)] + [(0, 5000, 5000, 0.6)]   # one stranger: each meets it once
    rows += [(7, k, 7, 0.9) for k in range(7, 1000)] + [(7, 6000, 6000, 0.1)]   # one stranger too far from all
    rows += [(8, k, 8, 0.9) for k in range(8, 1000)]   # one component
    rows += [(9, k, k, None if k == 9 else 0.5) for k in range(9, 309)]   # 300 components
    met = spark.createDataFrame(rows, "pivot long, id long, component long, j double")
    left = minhash._to_compare(met)
    assert {r.pivot: r["count"] for r in left.groupBy("pivot").count().collect()} == {0: 1001, 9: 300}
    dealt = minhash._dealt(left.withColumn("shingles", F.lit(b""))).collect()
    assert sum(r.pivot == 0 for r in dealt) == 1000 + 5
    pairs = {}
    for r in dealt:
        pairs.setdefault((r.pivot, r.lo, r.hi), []).append(r.id)
    together = {(p, a, b) for (p, _, _), ids in pairs.items() for a in ids for b in ids if a < b}
    assert all((0, k, 5000) in together for k in range(1000)) and all((9, a, b) in together for a in range(9, 309) for b in range(a + 1, 309))


def test_near_duplicates_of_ids_with_several_texts(spark):
    """The smallest id holds two texts, each with a near copy of its own."""
    rng = random.Random(8)
    a, b = ([f"{x}{rng.randint(0, 9999)}" for _ in range(60)] for x in "ab")
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (3, "alone words of a third text here"), (4, near(b) + " x")]
    found = minhash.near_duplicates(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == [(1, 56, 1), (1, 56, 1), (1, 56, 1), (2, 56, 1), (3, 3, 3), (3, 56, 1), (4, 57, 1)]


def test_near_duplicate_removal_keeps_columns(spark):
    frame = docs(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, ""), (4, None), (None, "a b c d e f")], id="x", component_id="y")
    out = minhash.drop_near_duplicates(frame)
    assert out.columns == frame.columns and sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect()) == [(False, 1), (False, 3), (False, 4), (True, 0)]
    assert minhash.near_duplicates(frame.where("false")).count() == 0


def test_components_of_random_links(spark):
    rng = random.Random(6)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(70)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    out = minhash.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {k: find(k) for k in parent} and len(out) == len(parent)


def test_signature_is_the_minimum_over_the_set():
    shingles = np.unique(np.random.default_rng(3).integers(0, 1 << 63, 5000, dtype=np.uint64))
    a, b = minhash._A, minhash._B
    want = [min(((int(x) * int(p) + int(q)) % (1 << 64)) >> 32 for x in shingles[:50]) for p, q in zip(a[:5], b[:5], strict=True)]
    assert minhash.signature(shingles[:50])[:5].tolist() == want
    half = shingles[:2500]
    share = (minhash.signature(half) == minhash.signature(shingles)).mean()
    assert abs(share - 0.5) < 0.2


# repeated lines

def brute_lines(rows, min_words):
    """From the definition: every pair of equal runs, grown to its full length."""
    seqs = []
    for i, t in sorted({(i, t) for i, t in rows if i is not None and t is not None}, key=lambda r: r[0]):
        lines = t.split("\n")
        seqs.append((i, t, [(k, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for k, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]))
    gone = defaultdict(set)
    for a, (i, t, x) in enumerate(seqs):
        for b in range(a + 1):
            y = seqs[b][2]
            for p in range(len(x)):
                for q in range(p if a == b else len(y)):
                    n = words = 0
                    while p + n < len(x) and q + n < len(y) and x[p + n][1] == y[q + n][1]:
                        words += x[p + n][2]
                        n += 1
                    if words >= min_words:
                        gone[i, t].update(x[p + m][0] for m in range(n))
    out = []
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        left = [x for k, x in enumerate(lines) if k not in gone[i, t]]
        text = t if not gone[i, t] else "\n".join(left) if any(re.search(r"[^\x20\x09-\x0D]", x) for x in left) else ""
        out.append((i, len(lines), len(gone[i, t]), text))
    return Counter(out)


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(12)
    for min_words in (1, 6, 11):
        pool = ["", "  ", "a", "a b", "c d e", "f g h i", "x y z w v u t", "k " * 12, "é è", "l"]
        rows = [(1, None), (2, ""), (None, "a b\nc d e"), (None, "a b\nc d e"), (3, "\n\n"), (4, "a"), (5, "a")]
        rows += [(10 + k, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 25)))) for k in range(40)]
        rows += [(60, rows[-1][1]), (60, rows[-1][1])]
        out = linededup.report(docs(spark, rows, th="x", i="y", k="z", first="q"), min_words=min_words).collect()
        assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out) == brute_lines(rows, min_words)


def test_line_dedup_of_long_runs(spark):
    """A run of many short lines, one very long line, and a text that repeats itself."""
    run = "\n".join(f"l{k % 7} m{k % 3}" for k in range(90))
    rows = [(1, "head\n" + run), (2, run + "\ntail words here"), (3, "w " * 20000), (4, "p\n" + "w " * 20000), (5, "\n".join(["s t"] * 80))]
    out = linededup.report(docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in out) == brute_lines(rows, linededup.MIN_WORDS)
    found = linededup.repeated_runs(docs(spark, rows)).collect()
    assert sum(r.n_lines for r in found) == sum(r.n_removed for r in out)


def test_line_dedup_stage_keeps_columns(spark):
    line = " ".join(f"w{k}" for k in range(60))
    frame = docs(spark, [(1, line), (2, "own\n" + line), (3, line), (4, "")], n_chars="9", th="t", __llm="u")
    out = linededup.drop_repeated_runs(frame, size_col="n_chars")
    assert out.columns == frame.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, line, "9"), (2, "own", "3"), (4, "", "9")}
    assert linededup.report(frame.where("false")).count() == 0


def test_line_dedup_is_native(spark):
    plan = linededup.report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# learned scores

def test_grams_match_brute_force():
    texts = ["ab cde", None, "", "x\ty é日本", "  aa  "]
    t = Texts(texts)
    hashes, valid = t.grams(3)
    got = Counter(zip(t.owner(np.flatnonzero(valid)).tolist(), hashes[valid].tolist(), strict=True))
    per = defaultdict(set)
    for k, x in enumerate(texts):
        for w in (x or "").split():
            padded = f" {w} "
            for i in range(len(padded) - 2):
                per[k].add(padded[i:i + 3])
    assert {k: len({h for d, h in got if d == k}) for k in per} == {k: len(v) for k, v in per.items()}
    assert t.sums(valid).tolist() == [sum(len(w) for w in (x or "").split()) for x in texts]


def test_sample_is_bounded_and_deterministic(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 1)], "doc_id long, toxic int")
    assert {(r.id, r.label) for r in sample(labels, "doc_id", "toxic", 10).collect()} == {(1, 1), (3, 0), (4, 1)}
    assert sample(labels, "doc_id", "toxic", 2).collect() == sample(labels.orderBy("toxic"), "doc_id", "toxic", 2).collect()
    import zlib
    ids = spark.range(200).select(held_out("id", 3, 1).alias("h"), "id").collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in ids)


@pytest.mark.parametrize("block", [4, 64, 4096])
@pytest.mark.parametrize("skipped", [False, True])
def test_nearest_examples_are_exact(monkeypatch, block, skipped):
    """Rows in like groups, frequent and rare terms, copies and empty rows, against dense products."""
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", block)
    monkeypatch.setattr(toxicity, "POSTINGS", 50)
    rng = np.random.default_rng(block)
    n, size = 400, 300
    places = [np.sort(rng.choice(np.r_[(k % 3) * 6:(k % 3) * 6 + 6, 18:size], rng.integers(0, 12), replace=False)) for k in range(n)]
    counts = [rng.integers(1, 4, len(x)) for x in places]
    places[9], counts[9] = places[5], counts[5]
    idf, rank = rng.uniform(1, 5, size), rng.permutation(n)
    dense = np.zeros((n, size))
    for i, (x, c) in enumerate(zip(places, counts, strict=True)):
        dense[i, x] = (1 + np.log(c)) * idf[x]
    dense /= np.maximum(np.sqrt((dense**2).sum(axis=1, keepdims=True)), 1e-300)
    index = toxicity.Index(np.concatenate([[0], np.cumsum([len(x) for x in places])]), np.concatenate(places), np.concatenate(counts), idf, rank)
    asked = rng.permutation(n)[:150]
    at, doc = np.concatenate([places[i] for i in asked]), np.repeat(np.arange(len(asked)), [len(places[i]) for i in asked])
    q = index.queries(doc, at, np.concatenate([counts[i] for i in asked]), len(asked))
    for i, (found, sims) in zip(asked, index.nearest(doc, at, q, len(asked), skip=asked if skipped else None), strict=True):
        want = dense @ dense[i]
        if skipped:
            want[i] = 0
        order = [k for k in np.lexsort((rank, -np.round(want, 12))) if want[k] > 0][:toxicity.K_NEAREST]
        assert found.tolist() == order and np.allclose(sims, want[order])


def accuracy(frame, labels, column):
    rows = frame.join(labels, "doc_id").where("held_out").select("score", "predicted", column).toPandas()
    y, x = rows[column].to_numpy(), rows["score"].rank().to_numpy()
    p, n = (y == 1).sum(), (y == 0).sum()
    return (x[y == 1].sum() - p * (p + 1) / 2) / (p * n), (rows["predicted"] == y).mean()


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    auc, right = accuracy(QUERIES["op3_toxicity"](spark, d), spark.read.parquet(f"{d}/labels.parquet"), "toxic")
    assert auc > 0.96 and right > 0.97


def test_toxicity_neighbours_are_by_all_terms(spark):
    """Labelled rows with no word that tells toxic ones apart: neighbours come from whole texts."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(900)]
    texts = {k: " ".join(["the plain", *rng.choice(words, 12), f"only{k}"]) for k in range(300)}
    parts = {1000 + k: " ".join(texts[k].split()[1:9]) + " unheard" for k in range(0, 40)}
    frame = docs(spark, [*texts.items(), *parts.items()])
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in texts], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score(frame, labels).collect()}
    bag = {}
    for k, t in {**texts, **parts}.items():
        every = re.findall(r"[^\W_]+", t.lower())
        bag[k] = Counter([(0, w) for w in every] + [(n, w[:n]) for n in (4, 6) for w in every if len(w) > n])
    df = Counter(t for b in bag.values() for t in b)
    known = {t for k in texts for t in bag[k]}
    unit = {}
    for k, b in bag.items():
        w = {t: (1 + np.log(c)) * (np.log((1 + len(bag)) / (1 + df[t])) + 1) for t, c in b.items() if t in known}
        norm = np.sqrt(sum(x * x for x in w.values()))
        unit[k] = {t: x / norm for t, x in w.items()}
    for k in parts:
        sims = {e: sum(x * unit[e].get(t, 0) for t, x in unit[k].items()) for e in texts}
        want = sorted((e for e in sims if sims[e] > 0), key=lambda e: (-round(sims[e], 12), e))[:toxicity.K_NEAREST]
        assert found[k].evidence[0].id == k - 1000
        assert [e.id for e in found[k].evidence] == want
        assert np.allclose([e.similarity for e in found[k].evidence], [sims[e] for e in want], atol=1e-12)
        assert [e.label for e in found[k].evidence] == [int(e.id % 5 == 0) for e in found[k].evidence]
    assert min(found[k].score for k in parts if k % 5 == 0) > max(found[k].score for k in parts if k % 5)


def test_terms_are_words_and_stems():
    import pyarrow as pa
    texts = ["Élan élans ÉLANSSS été", None, "", "a_b 12345 1234", "日本語日本語日 x" * 3, "w " * 2000]
    doc, term, count = toxicity.bags(pa.array(texts))
    for i, t in enumerate(texts):
        every = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        want = Counter([(0, w) for w in every] + [(n, w[:n]) for n in (4, 6) for w in every if len(w) > n])
        assert sorted(count[doc == i].tolist()) == sorted(want.values())
    both = toxicity.bags(pa.array(["élans", "ÉLANSES"]))
    assert len(set(both[1][both[0] == 0]) & set(both[1][both[0] == 1])) == 1  # the stem of four characters


def test_examples_by_repeated_ids_and_bounds(spark):
    """A sampled id with many rows is one example; the bound on terms leaves out whole examples."""
    rows = [(1, f"copy of one text {k % 2}") for k in range(300)] + [(k, f"text number {k} of many") for k in range(2, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 60)], "doc_id long, toxic int")
    found = toxicity.learn(docs(spark, rows), labels)
    assert found.ids == list(range(1, 60)) and found.total == len(rows)
    few = toxicity.learn(docs(spark, rows), labels, max_entries=60)
    assert 0 < few.n < 12 and few.data["size"].sum() <= 60
    assert toxicity.learn(docs(spark, rows), labels, max_entries=0).n == 0


def test_telling_terms_are_chosen_without_the_voter(spark):
    """Labels at random: votes by telling terms mustn't find them."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 3)) for _ in range(150)]
    rows = [(k, " ".join(rng.choice(words, 30))) for k in range(300)]
    labels = spark.createDataFrame([(k, int(rng.random() < 0.3)) for k in range(300)], "doc_id long, toxic int")
    examples = toxicity.learn(docs(spark, rows), labels)
    own, told = examples.own_votes(np.arange(300))
    y = examples.labels == 1
    rank = np.argsort(np.argsort([o if t is None else o + t for o, t in zip(own, told, strict=True)]))
    auc = (rank[y].mean() - rank[~y].mean()) / 300 + 0.5
    assert 0.35 < auc < 0.65


def test_quality_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    auc, right = accuracy(QUERIES["op5_quality"](spark, d), spark.read.parquet(f"{d}/labels.parquet"), "quality")
    assert auc > 0.98 and right > 0.97


def test_scores_of_edge_rows(spark):
    bad, good = "you idiot moron fool now", "the plain words of a text"
    train = [(k, (bad if k % 4 == 0 else good) + f" n{k}") for k in range(400)]
    rows = [*train, (1000, None), (1001, ""), (1002, bad), (1002, bad), (None, bad), (1003, "x " * 50000)]
    frame = docs(spark, rows, score="s", evidence="e", terms="t", label="l", id="i")
    labels = spark.createDataFrame([(k, int(k % 4 == 0), int(k % 4 != 0)) for k in range(400)], "doc_id long, toxic int, quality int")
    out = toxicity.score(frame, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[1002].score > 0.7 and by[1000].score < 0.3 and by[1001].score == by[1000].score and by[None].score == by[1002].score
    assert all(e.label == 1 for e in by[1002].evidence) and by[1000].evidence == []
    assert toxicity.score(frame, labels.where("false")).count() == len(rows)
    assert toxicity.score(frame.where("false"), labels).count() == 0
    left = toxicity.drop_toxic(frame, labels)
    assert left.columns == frame.columns and left.where("doc_id = 1002").count() == 0 and left.where("doc_id IS NULL").count() == 1
    model = quality.fit(frame, labels)
    out = {r.doc_id: r.score for r in quality.score(frame, model).collect()}
    assert out[1002] < 0.3 < out[1] and out[1000] == out[1001] == pytest.approx(301 / 402)
    none = quality.fit(frame, labels.where("false"))
    assert {r.score for r in quality.score(frame, none).collect()} == {0.5}


def test_samples_of_ids_that_repeat(spark):
    """A sampled id may hold any number of rows; one text of it is learned from."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["good", "fine"] if k % 2 else ["bad", "poor"]) + str(rng.randrange(30)) for _ in range(60))) for k in range(40)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    often = once.unionByName(once.where("doc_id = 3").crossJoin(spark.range(50)).drop("id"))
    a, b = quality.fit(once, labels), quality.fit(often, labels)
    assert np.array_equal(a.weights, b.weights) and a.prior == b.prior
    assert rules.learn_rules(once, labels) == rules.learn_rules(often, labels)


def test_learned_scores_are_repeatable(spark):
    one, two = (QUERIES["op5_quality"](spark, SF).orderBy("doc_id").toPandas() for _ in range(2))
    pd.testing.assert_frame_equal(one, two)


# the pipeline

def test_pipeline_against_its_stages(spark):
    """Each stage on what the one before kept: brute force where there is one, else the operator's own verdict."""
    import corpus_pipeline as cp
    d, name_of = SF, [n for n, _ in cp.STAGES]
    assert name_of == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    frame = spark.read.parquet(f"{d}/documents.parquet")
    columns, rows = frame.columns, [(r.doc_id, r.text) for r in frame.collect()]
    kept = []
    for _, stage in cp.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, d).toPandas(), frame.schema)
        assert frame.columns == columns
        kept.append({r.doc_id: r.text for r in frame.collect()})
    marked = {r.doc_id for r in toxicity.score(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"), where=~held_out("id", 3, 1))
              .where("score >= 0.7").collect()}
    assert set(kept[0]) == {i for i, _ in rows} - marked
    want = {i: t for i, _, n, t in brute_lines(list(kept[0].items()), linededup.MIN_WORDS) if not (n and t == "")}
    assert kept[1] == want
    assert set(kept[2]) == {i for i, _, _, stays in brute_groups(list(want.items())) if stays}
    final = cp.STAGES[-1][1](spark, frame, d)
    assert {r.doc_id for r in final.collect()} == set(kept[3]) and set(kept[3]) <= set(kept[2])
    assert Counter(r.doc_id for r in cp.run(spark, d).collect()) == Counter(kept[3].keys())


def test_every_query_is_registered():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
