"""Trained heads: probabilities against their own coefficients, save and load, checks."""

import math
from collections import Counter

import pyarrow as pa
import pytest

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, SQLTransformer
from pyspark.sql import functions as F

from frontier.operators import grams as GR
from frontier.operators import head_tables as HT
from frontier.operators import heads as HD
from frontier.operators import score as SCR


def _rows(spark):
    urls = [(f"https://{'news' if k % 3 else 'shop'}.example.com/{'story' if k % 2 else 'item'}/{k}", float(k % 2), float(k % 3 == 0)) for k in range(120)]
    df = spark.createDataFrame(urls, "url string, a double, b double")
    return SCR.with_features(df)


def test_scores_are_the_largest_probability(spark, tmp_path):
    rows = _rows(spark)
    model = HD.fit(rows, {"url": "a", "refresh": "b"}, ngrams=(3,), dims=512, max_iter=15)
    scored = model.score(rows).select("url", "a", "b", "url_score").collect()
    ready = model._prepared(rows, "features")
    want = {}
    for name in ("url", "refresh"):
        scaler, assembler, lr = model.heads[name].stages
        for r in assembler.transform(scaler.transform(ready)).select("url", "__x").collect():
            z = float(r["__x"].dot(lr.coefficients)) + lr.intercept
            want[r.url] = max(want.get(r.url, 0.0), 1 / (1 + math.exp(-z)))
    assert all(abs(r.url_score - want[r.url]) < 1e-9 for r in scored)
    assert all((r.url_score > 0.5) == (r.a == 1 or r.b == 1) for r in scored)
    model.save(str(tmp_path / "m"))
    again = HD.TrainedHeads.load(spark, str(tmp_path / "m"))
    assert {r.url: r.url_score for r in again.score(rows).collect()} == {r.url: r.url_score for r in scored}


def test_head_tables_against_brute_force(spark):
    """An exported head: repeated, short and unknown URLs, numbers with scalers, a hot gram."""
    grams = {"htt": 1.5, "aaa": 2.0, "w.": 0.5, "zzz": 9.0}
    weights = {("url", "htt"): 0.7, ("url", "aaa"): -1.0, ("refresh", "aaa"): 2.5, ("refresh", "w."): 0.1}
    heads = {"url": (0.2, None), "refresh": (-1.0, ([1.0, 2.0], [2.0, 0.0], [0.3, -0.4]))}
    urls = [("http://aaaa.com/aaa", [3.0, 1.0]), ("w.w.", [0.0, 0.0]), ("HTTP://x", [1.0, 5.0]), ("q", [9.0, 9.0]), ("", [1.0, 2.0]), ("http://aaaa.com/aaa", [0.0, 7.0])]
    tables = HT.HeadTables(spark.createDataFrame(list(grams.items()), "gram string, idf double"),
                           spark.createDataFrame([(*k, w) for k, w in weights.items()], "head string, gram string, weight double"),
                           spark.createDataFrame([(h, i, *(n or (None, None, None))) for h, (i, n) in heads.items()],
                                                 "head string, intercept double, means array<double>, scales array<double>, number_weights array<double>"), (2, 3))
    found = tables.score(spark.createDataFrame(urls, "url string, features array<double>")).collect()
    want = []
    for u, x in urls:
        low = u.lower()
        tf = {g: sum(low[i:i + len(g)] == g for i in range(len(low))) for g in grams}
        norm = math.sqrt(sum((n * grams[g])**2 for g, n in tf.items()))
        best = 0.0
        for h, (z, numbers) in heads.items():
            z += sum(n * grams[g] * weights.get((h, g), 0) for g, n in tf.items()) / norm if norm else 0
            if numbers:
                z += sum((v - m) / (s or 1) * w for v, m, s, w in zip(x, *numbers))
            best = max(best, 1 / (1 + math.exp(-z)))
        want.append((u, tuple(x), best))
    assert [(r.url, tuple(r.features)) for r in sorted(found, key=lambda r: (r.url, r.features))] == [w[:2] for w in sorted(want)]
    assert all(abs(r.url_score - w[2]) < 1e-12 for r, w in zip(sorted(found, key=lambda r: (r.url, r.features)), sorted(want), strict=True))
    with pytest.raises(ValueError):
        HT.HeadTables(tables.grams, tables.weights, tables.heads.withColumn("head", F.lit("child"))).score(spark.createDataFrame(urls, "url string, features array<double>"))


def test_unusable_models_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        HD.TrainedHeads.load(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        HD.TrainedHeads(None, {})
    with pytest.raises(ValueError):
        HD.TrainedHeads(None, {"child_url": None})


def _odd_urls():
    urls = [f"https://s{k}.example.org/i/{k * 37}" for k in range(150)] + ["", "a", "ab", "ÄÖÜ/ÄÖÜ", "x😀y😀x😀y😀", "aaaaaaaa", "é" * 50, "AbAbAb"]
    return [(u, float(k % 2), float(k % 3 == 0) if k % 7 else None) for k, u in enumerate(urls)]


def _grams(url, sizes):
    low = url.lower()
    return [low[i:i + n] for n in sizes for i in range(len(low) - n + 1)]


def test_learning_counts_each_gram_once_a_url(spark):
    """Counts travel once a gram and task, not once a gram and URL; any alphabet, short URLs, null labels."""
    rows = _odd_urls() + [(None, 1.0, 0.0)]
    made = HT.learn_by_counts(spark.createDataFrame(rows, "url string, a double, b double").repartition(3), {"url": "a", "parent": "b"}, (2, 4), least=2)
    df, pos = Counter(), Counter()
    for u, a, b in rows:
        for g in set(_grams(u or "", (2, 4))):
            df[g] += 1
            pos["url", g] += a == 1
            pos["parent", g] += b == 1
    df = {g: n for g, n in df.items() if n >= 2}
    n, of = len(rows), {"url": sum(r[1] == 1 for r in rows), "parent": sum(r[2] == 1 for r in rows)}
    assert {r.gram: round(r.idf, 9) for r in made.grams.collect()} == {g: round(math.log((1 + n) / (1 + k)) + 1, 9) for g, k in df.items()}
    want = {(h, g): math.log((pos[h, g] + 1) / (of[h] + 2)) - math.log((k - pos[h, g] + 1) / (n - of[h] + 2)) for g, k in df.items() for h in of}
    found = {(r["head"], r.gram): r.weight for r in made.weights.collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - w) < 1e-9 for k, w in want.items())
    plan = made.grams._jdf.queryExecution().toString()
    assert "Generate explode" not in plan and "MapInArrow" in plan


def test_scores_are_the_same_broadcast_and_joined(spark, monkeypatch):
    """A broadcast vocabulary needs no row a gram and no shuffle of the URLs; a joined one gives the same."""
    rows = spark.createDataFrame(_odd_urls() + [(None, 1.0, 0.0), ("a", 0.0, 0.0)], "url string, a double, b double")
    tables = HT.learn_by_counts(rows, {"url": "a", "parent": "b"}, (3, 4), least=2)
    twice = HT.HeadTables(tables.grams.union(tables.grams.limit(20)).cache(), tables.weights, tables.heads, tables.sizes)
    scored = twice.score(rows.select("url", "a"))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan
    key = lambda r: (r[0] or "", r[1], r[2])
    near = sorted(scored.collect(), key=key)
    monkeypatch.setattr(HT, "MAX_BROADCAST_GRAMS", 0)
    joined = sorted(twice.score(rows.select("url", "a")).collect(), key=key)
    assert [r[:2] for r in near] == [r[:2] for r in joined] and len(near) == len(_odd_urls()) + 2
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(near, joined, strict=True))


def test_gram_tree_with_and_without_direct_tables(monkeypatch):
    texts = ["https://a.b/ccc", "", "ccc", "x😀y😀", "zz"]
    vocabulary = ["ccc", "http", "😀y😀", "c", "ttps", "q😀"]
    for direct in (GR.DIRECT, 0):
        monkeypatch.setattr(GR, "DIRECT", direct)
        row, gram, tf = GR.GramTree(vocabulary).counts(GR.Texts(pa.array(texts)), (1, 3, 4))
        found = {(texts[r], vocabulary[g]): t for r, g, t in zip(row.tolist(), gram.tolist(), tf.tolist())}
        want = Counter((t, g) for t in texts for g in _grams(t, (1, 3, 4)) if g in vocabulary)
        assert found == dict(want)


def test_fitting_reads_its_rows_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(url):
        calls.add(1)
        return url

    HD.fit(_rows(spark).withColumn("url", seen("url")), {"url": "a", "refresh": "b"}, ngrams=(3,), dims=64, max_iter=2)
    assert calls.value == 120


def test_counts_are_those_of_the_tokenizer_and_ngram_stages(spark):
    urls = spark.createDataFrame([(u,) for u in ("HTTP://Ex.org/a b", "", "ab", "x\ny\r\nz w", "ÄÖ😀ß😀/ÄÖ", "aaaa" * 9)], "url string")
    plain = Pipeline(stages=[RegexTokenizer(inputCol="url", outputCol="c", pattern=".", gaps=False, toLowercase=True), *[NGram(n=n, inputCol="c", outputCol=f"g{n}") for n in (3, 4)],
                             SQLTransformer(statement="SELECT *, concat(g3, g4) AS g FROM __THIS__"), HashingTF(inputCol="g", outputCol="tf", numFeatures=512)])
    want = {r.url: r.tf for r in plain.fit(urls).transform(urls).collect()}
    assert {r.url: r["__tf"] for r in PipelineModel(HD._counter((3, 4), 512)).transform(urls).collect()} == want


def test_hashes_are_those_of_hashing_tf(spark):
    """Every length of text, several bytes a character; a null URL has no grams."""
    grams = ["x" * k for k in range(10)] + ["h t t", "ß 😀 /", "é é é é", "日 本", "a b c d e", "\u0000 z"]
    tf = HashingTF(inputCol="g", outputCol="tf", numFeatures=1 << 14)
    assert [tf.indexOf(g) for g in grams] == [int(h) % (1 << 14) for h in GR.murmur3(grams)]
    rows = PipelineModel(HD._counter((3,), 64)).transform(spark.createDataFrame([(None,), ("abc",)], "url string"))
    assert [len(r["__tf"].indices) for r in rows.collect()] == [0, 1]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan
