"""Operators that work row by row: against brute force on hand-made and given rows."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter
from email.parser import Parser
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from frontier.llm import blocks, bpe, decontaminate, htmltext, kernels, rules, sharding, warc
from frontier.llm.queries import VOCABULARY

SF = "/root/testdata/sf0.001"
#: Extra columns with names that the operators use themselves.
CLASH = {"id": "x", "text_": "y", "n": 1, "slot": 7, "score": 0.5, "hash": "h", "__n": 3}


def docs(spark, texts, schema="doc_id long, text string", **more):
    rows = [(i, t, *more.values()) for i, t in texts]
    return spark.createDataFrame(rows, schema + "".join(f", {k} string" for k in more))


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f g h i j k l"), (5, "a b c d e f g h i j k l"), (None, "null id"),
        (7, "é日 😀 ÀB x" * 50), (8, "w " * 30000), (9, "z" * 200000)]


# words and windows

@given(st.lists(st.text(alphabet="aB é日\n\t.9 ", max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_match_the_pattern(texts):
    import pyarrow as pa
    data, offsets = kernels.text_bytes(pa.array(texts, pa.string()))
    for table, pattern in ((kernels.ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), (kernels.NONSPACE, r"[^\x20\x09-\x0D]+")):
        found = kernels.find_words(data, offsets, table, kernels.SAME)
        for i, t in enumerate(texts):
            spans = range(found.first[i], found.first[i + 1])
            assert [bytes(data[found.starts[k]:found.ends[k]]).decode() for k in spans] == re.findall(pattern, t)


def test_words_over_block_borders(monkeypatch):
    import pyarrow as pa
    text = " ".join("w" * (k % 97) for k in range(400))
    data, offsets = kernels.text_bytes(pa.array([text, "x" * 5000, text]))
    whole = kernels.find_words(data, offsets, kernels.NONSPACE, kernels.SAME)
    monkeypatch.setattr(kernels, "BLOCK", 64)
    parts = kernels.find_words(data, offsets, kernels.NONSPACE, kernels.SAME)
    for a, b in ((whole.starts, parts.starts), (whole.ends, parts.ends), (whole.hashes, parts.hashes), (whole.first, parts.first)):
        assert (a == b).all()


# decontamination

def brute_windows(text, items, n=10):
    fold = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    words, hit, ids = fold(text), set(), set()
    for item, t in items:
        w = fold(t)
        size = min(n, len(w))
        grams = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i:i + size]) in grams:
                hit.update(range(i, i + size))
                if item is not None:
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["ab", "Ab", "c", "é", "d1", "x-y"]) for _ in range(n))
    items = [(1, text(25)), (2, "ab c"), (2, "ab c"), (None, text(12)), (3, None), (4, "..."), (5, "é é é d1")]
    rows = [*EDGE, *[(100 + k, text(60) + " " + (items[k % 2][1])) for k in range(40)]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(docs(spark, rows), bench).collect()
    want = Counter((i, *brute_windows(t, items)[:2], tuple(brute_windows(t, items)[2])) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found) == want
    for r, t in ((r, dict((i, t) for i, t in rows if i is not None).get(r.doc_id)) for r in found if r.n_hit):
        cut = "".join(t[s.begin:s.end] + " " for s in r.spans)
        assert len(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", cut)) == r.n_hit


def test_decontamination_keeps_columns_and_clean_rows(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    frame = docs(spark, EDGE, items="q", spans="r")
    out = decontaminate.decontaminate(frame, bench)
    assert out.columns == frame.columns
    assert out.count() == len(EDGE) - 2 and out.where("doc_id = 5").count() == 0 and out.where("doc_id IS NULL").count() == 1
    spans = decontaminate.decontaminate(frame, bench, action="spans")
    assert spans.columns == frame.columns and {r.text for r in spans.where("doc_id = 5").collect()} == {" k l"}
    empty = bench.where("false")
    assert decontaminate.contamination(frame, empty).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(frame.where("false"), bench).count() == 0


def test_decontamination_in_several_sets(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_SET_BYTES", 60)
    rng = random.Random(5)
    items = [(k, " ".join(rng.choice("abc") for _ in range(12))) for k in range(9)]
    rows = [(k, " ".join(rng.choice("abc") for _ in range(400))) for k in range(20)]
    found = decontaminate.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), n=4).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found} == {
        (i, *brute_windows(t, items, 4)[:2], tuple(brute_windows(t, items, 4)[2])) for i, t in rows}


def test_decontamination_by_long_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MAX_SET_BYTES", 400)
    rng = random.Random(6)
    items = [(k, " ".join(rng.choice("abcdé") for _ in range(n))) for k, n in enumerate([900, 12, 3, 700, 1])] + [(7, "z" * 900), (8, "y" * 500 + " " + "é" * 300)]
    rows = [(k, " ".join(rng.choice("abcdé") for _ in range(300))) for k in range(12)]
    rows += [(50, "q " + items[0][1][401:489] + " q"), (51, "Z" * 900), (52, items[6][1]), (53, "y" * 500), (54, items[3][1])]
    found = decontaminate.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), n=4).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found} == {
        (i, *brute_windows(t, items, 4)[:2], tuple(brute_windows(t, items, 4)[2])) for i, t in rows}


# byte-level BPE

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def packed(text):
    return np.array(TOKENIZER.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@given(st.text(max_size=200) | st.text(alphabet="ab \n's1é日😀<|endoftext|>", max_size=300))
@settings(max_examples=150, deadline=None)
def test_bpe_matches_the_library(text):
    codec = bpe._codec(bpe.read_vocabulary(VOCABULARY), "test")
    assert b"".join(codec.encode(text)) == packed(text)
    assert "".join(codec.decode(codec.encode(text))) == text


@given(st.binary(max_size=60))
@settings(max_examples=60, deadline=None)
def test_decoder_handles_any_ids(data):
    codec = bpe._codec(bpe.read_vocabulary(VOCABULARY), "test")
    ids = [codec.model.byte_id[b] for b in data]
    assert "".join(codec.decode([np.array(ids, "<u4").tobytes()])) == data.decode("utf-8", "replace") == TOKENIZER.decode(ids, skip_special_tokens=False)


def test_lookahead_suffices_for_random_merge_lists():
    """Tokens that end before the lookahead never change with what follows, and the transducer
    gives the definition's result, for merge lists where long chains occur."""
    rng = random.Random(11)
    alphabet = bpe.byte_alphabet()
    for _ in range(120):
        vocab = {c: k for k, c in enumerate(alphabet.values())}
        merges, tokens = [], ["a", "b", "c"]
        for _ in range(rng.randint(1, 14)):
            u, v = rng.choice(tokens), rng.choice(tokens)
            if (u, v) not in merges and u + v not in vocab:
                merges.append((u, v))
                vocab[u + v] = len(vocab)
                tokens.append(u + v)
        model = bpe.BpeModel(vocab, merges)
        for _ in range(15):
            x, y = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 40))).encode() for _ in range(2))
            assert model.segment(x) == model.merge(x)
            short, whole, end = model.merge(x), model.merge(x + y), 0
            for k, t in enumerate(short):
                end += len(model.bytes[t])
                if end <= len(x) - model.lookahead:
                    assert whole[k] == t
            run = bpe.Transducer(model)
            run.room = model.lookahead + 8
            assert [*run.feed(x + y), *run.finish()] == whole


def test_bpe_rows(spark):
    rows = [*EDGE, (11, "<|endoftext|> x<|endoftext|>"), (12, "a" * 70000 + " b" * 40000)]
    out = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs(spark, rows, tokens="t"), VOCABULARY).collect()}
    assert out == {(i, len(packed(t or "")) // 4, hashlib.sha256(packed(t or "")).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}
    ids = bpe.encode(docs(spark, EDGE), VOCABULARY)
    assert Counter((r.doc_id, r.text) for r in bpe.decode(ids, VOCABULARY).collect()) == Counter((i, t or "") for i, t in EDGE)
    assert bpe.round_trip(docs(spark, []), VOCABULARY).count() == 0


# quality rules

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] >= 2 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_rule_statistics_match_brute_force(spark):
    rng = random.Random(2)
    rows = [*EDGE, *[(100 + k, "".join(rng.choice(["a ", "b ", "é ", "#x ", "\n", "a b c ", "\r\n", "<&>", " "]) for _ in range(rng.randint(0, 200)))) for k in range(60)]]
    out = rules.apply_rules(docs(spark, rows, kept="c", n_words="d"), []).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out)
    want = Counter()
    for i, t in rows:
        b = brute_counts(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        want[i, *b, failed, not failed] += 1
    assert got == want


def test_learned_list_is_pure_and_ordered(spark):
    rng = np.random.default_rng(4)
    n = 4000
    counts = {c: rng.integers(1, 100, n) for c in rules.COUNTS}
    x = rules.feature_arrays(counts)
    low = (x["symbols"] >= 3.0) | ((x["marks"] >= 2.0) & (x["upper"] >= 1.0))
    learned = rules.learn(x, low)
    assert len(learned) >= 2
    fired = np.zeros(n, bool)
    for rule in learned:
        on = np.ones(n, bool)
        for c in rule:
            on &= c.holds(x)
        fired |= on
    assert low[fired].mean() > 0.95 and fired[low].mean() > 0.8
    frame = spark.createDataFrame([tuple(int(counts[c][i]) for c in rules.COUNTS) for i in range(300)], rules.COUNTS)
    assert [r.k for r in frame.select(rules.expression(learned).alias("k")).collect()] == (~fired[:300]).tolist()
    assert rules.learn(x, np.zeros(n, bool)) == []


def test_rules_without_labels_keep_all(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert rules.learn_rules(docs(spark, EDGE), labels) == []


# pages

def test_blocks_of_broken_markup():
    page = ('<html><head><title>no</title><style>p{}</style></head><body><p title="a > b">One&amp;<b>two</b> x<br>three<p>four'
            "<script>if (a < b) '</p>'</script><!-- <p>gone --> five<ul><li>l1<li>l2</ul><textarea>raw</textarea>a < b &#233;\x0b\n y <a href=x")
    assert [b.text for b in blocks.read(page)] == ["One&two x", "three", "four", "five", "l1", "l2", "a < b é y"]


def test_blocks_stay_linear():
    import time
    for hostile in ("<script " * 30000, "<!--" * 50000, "<a title='" * 30000, "<div>x" * 20000, "<p><div>" * 20000 + "</span>" * 20000, "</p>" * 50000, "<" * 200000):
        begin = time.perf_counter()
        blocks.read(hostile)
        assert time.perf_counter() - begin < 5


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    return htmltext.fit(pages, max_train=60)


def test_main_text_of_held_out_pages(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in htmltext.extract(pages, labeller).collect()}
    want = {r.page_id: " ".join(b.text for b in blocks.read(r.html) if htmltext.weak_label(b)) for r in pages.collect()}
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_main_text_by_words_inside_blocks():
    """Held-out pages of plain elements: only words in the middle of a block tell what it is."""
    rng = np.random.default_rng(8)
    some = lambda kind, n: " ".join(f"{kind}{k}" for k in rng.integers(0, 25, n))
    block = lambda kind: f"{some('any', 4)} {some(kind, 8)} {some('any', 4)}."

    def page(named):
        main = ("<article>", "</article>", '<div class="cookie-notice">', "</div>") if named else ("<div>", "</div>") * 2
        parts, want = [], []
        for _ in range(int(rng.integers(4, 9))):
            story = bool(rng.random() < 0.5)
            text = block("story" if story else "cookie")
            parts.append(f"{main[0]}<p>{text}</p>{main[1]}" if story else f"{main[2]}<p>{text}</p>{main[3]}")
            want.append(story)
        return "<html><body>" + "".join(parts) + "</body></html>", want

    model = htmltext.train([page(True)[0] for _ in range(120)])
    held = [page(False) for _ in range(60)]
    got = htmltext.label(model, [blocks.read(h) for h, _ in held])
    right = [g == w for p, (_, want) in zip(got, held, strict=True) for g, w in zip(p.tolist(), want, strict=True)]
    assert np.mean(right) > 0.95


def test_main_text_of_altered_pages(spark, labeller):
    rng = np.random.default_rng(77)
    wrong = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(120).collect():
        changed = htmltext.altered(r.html, rng)
        if changed:
            parts = htmltext._without_marks(blocks.read(changed[0]))
            wrong += int((htmltext.label(labeller, [parts])[0] != np.array(changed[1])).sum())
            total += len(parts)
    assert wrong <= 0.02 * total


def test_labeller_gradients():
    rng = np.random.default_rng(0)
    model = htmltext.new_model(rng)
    pages = htmltext.Pages([[([1, 5], [1.0, 0.5]), ([7], [1.0]), ([1], [2.0])], [([5, 9], [1.0, 1.0])]])
    labels = np.array([[1, 0], [0, 0], [1, 0]], float)

    def loss():
        p = htmltext.predict(model, pages)
        return -np.where(pages.mask, labels * np.log(p) + (1 - labels) * np.log(1 - p), 0).sum() / pages.mask.sum()

    for p, g in zip(model.arrays(), htmltext._gradients(model, pages, labels), strict=True):
        for at in [np.unravel_index(k, p.shape) for k in np.argsort(-np.abs(g).ravel())[:3]]:
            old = p[at]
            p[at] = old + 1e-5
            up = loss()
            p[at] = old - 1e-5
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def test_pages_edge_rows(spark, labeller):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<script>x</script>"), (3, "u", "<script>x</script>"), (None, "u", "<article><p>a b c</p></article>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = htmltext.extract(pages, labeller).collect()
    assert len(out) == 5 and all(r.text == "" and r.n_chars == 0 for r in out if r.page_id is not None)
    assert htmltext.extract(pages.where("false"), labeller).count() == 0
    assert htmltext.fit(pages.where("false")) is None
    assert {r.text for r in htmltext.extract(pages, None).collect()} == {"", "a b c"}   # the weak labels decide


def test_labeller_learns_from_long_pages(spark):
    page = "<nav>{0}</nav><article>{1}</article><footer>foot</footer>"
    words = lambda k, n: " ".join(f"w{(k * 7 + i) % 11:04}" for i in range(n))
    rows = [(k, "u", page.format("".join(f"<a href=x>m{i}</a><br>" for i in range(12)), "".join(f"<p>{words(i + k, 90)}.</p>" for i in range(400)))) for k in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert all(len(r[2]) > htmltext.LONG for r in rows)
    model = htmltext.fit(pages)
    assert model is not None
    for r in htmltext.extract(pages, model).collect():
        assert r.text == " ".join(f"{words(i + r.page_id, 90)}." for i in range(400))


def test_paths_below_deep_nesting():
    deep = lambda outer, text: f"<{outer}>" + "<div>" * 300 + f"<p>{text}</p>" + "</div>" * 300 + f"</{outer.split()[0]}>"
    page = deep("article", "told") + deep('div class="comments"', "no") + "<article><section class=reply>" + deep("div", "no") + "</section><p>too</p></article>"
    found = blocks.read(page, htmltext.TELLING)
    assert [(b.text, htmltext.weak_label(b)) for b in found] == [("told", True), ("no", False), ("no", False), ("too", True)]
    assert max(len(b.path) for b in found) <= blocks.MAX_PATH + 2 * len(htmltext.TELLING)


def test_formulas_objects_and_xmp_are_text():
    page = ("<article><p>The law <math><mi>e</mi><mo>=</mo><mn>3</mn><annotation>tex</annotation></math> holds</p>"
            "<p>see <object data=x>the <b>figure</b></object></p><xmp>a <b> &amp; c</xmp><p>end</p></article>")
    found = blocks.read(page, htmltext.TELLING)
    assert [b.text for b in found] == ["The law e=3 holds", "see the figure", "a <b> &amp; c", "end"]
    assert all(htmltext.weak_label(b) for b in found)
    assert [b.text for b in blocks.read("<p>x<xmp>open <i>")] == ["x", "open <i>"]


# WARC

def response(body, http="Content-Type: text/html; charset=utf-8", uid="<urn:uuid:1>", digest=True):
    block = f"HTTP/1.1 200 OK\r\n{http}\r\n\r\n".encode() + body
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {uid}\r\nWARC-Target-URI: http://e.org/a/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            + (f"WARC-Payload-Digest: {sha1}\r\n" if digest else "") + f"Content-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"


def test_warc_derivatives(spark):
    page = "<title>A &amp; é</title><a href='/x?a=1&amp;b=2'>l</a><a href=\"y\">m</a><p>Hi<br>there</p><script>no</script>".encode()
    zipped = gzip.compress(page)
    chunked = b"4\r\n<p>a\r\n5\r\nb</p>\r\n0\r\n\r\n"
    rows = [response(page), response(page), response(zipped, "Content-Encoding: gzip", "<urn:uuid:2>"),
            response(chunked, "Transfer-Encoding: chunked", "<urn:uuid:3>"), response(b"\xff\xd8", "Content-Type: image/jpeg", "<urn:uuid:4>"),
            response("é".encode("latin-1"), "Content-Type: text/plain; charset=latin-1", "<urn:uuid:5>"), response(page, uid="<urn:uuid:6>").replace(b"Hi", b"Ho"),
            b"WARC/1.0\r\nWARC-Type: request\r\n\r\nGET /", b"junk", b"", None, response(b"", uid="<urn:uuid:7>")]
    frame = spark.createDataFrame([(bytearray(r) if r is not None else None, "x") for r in rows], "record binary, block string")
    out = warc.derivatives(frame).collect()
    by = {(r.refers_to, r.warc_type): r for r in out}
    assert Counter(r.warc_type for r in out) == {"metadata": 9, "conversion": 7}
    one = by["<urn:uuid:1>", "metadata"]
    assert "title: A & é\r\n" in one.block and "outlink: http://e.org/x?a=1&b=2\r\noutlink: http://e.org/a/y\r\n" in one.block
    assert "http-header-content-type: text/html; charset=utf-8\r\n" in one.block and "warc-header-warc-date: 2024-01-01T00:00:00Z\r\n" in one.block
    text = by["<urn:uuid:1>", "conversion"]
    assert text.block == "l m".replace(" ", "") + "\nHi\nthere" and text.target_uri == "http://e.org/a/" and text.digest_ok is True
    assert f"conversion: {text.record_id}\r\n" in one.block and text.payload_digest.startswith("sha1:")
    assert text.block_digest == "sha256:" + hashlib.sha256(text.block.encode()).hexdigest() and text.content_length == len(text.block.encode())
    assert by["<urn:uuid:2>", "conversion"].block == text.block and by["<urn:uuid:3>", "conversion"].block == "ab"
    assert ("<urn:uuid:4>", "conversion") not in by and by["<urn:uuid:5>", "conversion"].block == "é"
    assert by["<urn:uuid:6>", "metadata"].digest_ok is False and by["<urn:uuid:7>", "conversion"].block == ""
    assert sum("error: " in r.block for r in out) == 1
    assert warc.derivatives(frame.where("false")).count() == 0


def test_warc_codings():
    page, twice = "<p>first</p>".encode(), "<p>second</p>".encode()
    plain = zlib.compressobj(wbits=-15)
    cases = {
        "Content-Encoding: gzip": (gzip.compress(page) + gzip.compress(twice), "first\nsecond"),
        "Content-Encoding: x-gzip": (gzip.compress(page) + b"\0\0", "first"),
        "Content-Encoding: deflate, gzip": (gzip.compress(zlib.compress(page)), "first"),
        "Content-Encoding: deflate\r\nContent-Encoding: identity": (plain.compress(page) + plain.flush(), "first"),
        "Content-Encoding:  GZIP": (gzip.compress(page * 4000)[:-9], None),
        "Content-Encoding: br": (b"\x0b\x05\x80", None),
        "Content-Encoding: gzip, zstd": (gzip.compress(page), None),
        "Content-Encoding: Gzip": (b"no gzip", None),
        "Content-Type: text/css": (b"q::before { content: '<q' }", "q::before { content: '<q' }"),
    }
    for head, (body, text) in cases.items():
        made = warc.derive(response(body, head))
        assert [r["warc_type"] for r in made] == ["metadata"] + ["conversion"] * (text is not None), head
        assert ("error: " in made[0]["block"]) == (text is None)
        assert text is None or made[1]["block"] == text


class PlainReader(HTMLParser):
    """A second reader of pages: the standard library's, with what this package leaves out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.links, self.text, self.title = [], [], [], None

    def handle_starttag(self, tag, attrs):
        if tag in blocks.RAW:
            self.hidden.append(tag)
        elif tag == "a" and not self.hidden:
            self.links += [v for n, v in attrs if n == "href" and v is not None][:1]

    def handle_startendtag(self, tag, attrs):
        if tag not in blocks.RAW:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.hidden:
            del self.hidden[self.hidden.index(tag):]

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)
        elif self.hidden == ["title"] and self.title is None:
            self.title = data


def test_warc_derivatives_of_all_pages_by_a_second_reader(spark):
    """Every page of the table: header fields by the mail parser, links, title and text by html.parser."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sources = [r.record for r in warc.responses(pages).collect()]
    made = {(r.refers_to, r.warc_type): r for r in warc.derivatives(warc.responses(pages)).collect()}
    assert len(sources) == pages.count()
    for record in sources:
        head, _, block = bytes(record).partition(b"\r\n\r\n")
        named = Parser().parsestr(head.partition(b"\r\n")[2].decode())
        http, _, body = block[:int(named["Content-Length"])].partition(b"\r\n\r\n")
        reader = PlainReader()
        reader.feed(body.decode())
        reader.close()
        uid, url = named["WARC-Record-ID"], named["WARC-Target-URI"]
        meta, text = made[uid, "metadata"], made[uid, "conversion"]
        for r in (meta, text):
            assert (r.target_uri, r.warc_date, r.payload_digest, r.digest_ok) == (url, named["WARC-Date"], named["WARC-Payload-Digest"], True)
            assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
        told = Parser().parsestr(meta.block)
        assert told["conversion"] == text.record_id and told["status"] == http.split(b" ")[1].decode() and told["error"] is None
        for n, v in named.items():
            assert told[f"warc-header-{n.lower()}"] == v
        links = dict.fromkeys(urljoin(url, v.strip()) for v in reader.links)
        assert told.get_all("outlink", []) == [re.sub(r"\s+", "%20", v) for v in links if v.startswith(("http://", "https://"))]
        assert "".join(text.block.split()) == "".join("".join(reader.text).split())
        if reader.title is not None and reader.title.isascii():
            assert told["title"] == " ".join(reader.title.split())


def test_warc_files_read_back(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    derived = warc.derivatives(warc.responses(pages))
    rows = derived.collect()
    assert len(rows) == 2 * pages.count() and all(r.digest_ok for r in rows) and len({r.record_id for r in rows}) == len(rows)
    warc.write(derived, str(tmp_path / "out"))
    found = Counter()
    for file in (tmp_path / "out").glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            named = warc.fields(head.partition(b"\r\n")[2])
            size = int(warc.get(named, "Content-Length"))
            assert rest[size:size + 4] == b"\r\n\r\n"
            assert warc.digest_agrees(warc.get(named, "WARC-Block-Digest"), rest[:size])
            found[warc.get(named, "WARC-Type"), warc.get(named, "WARC-Refers-To")] += 1
            data = rest[size + 4:]
    assert found == Counter((r.warc_type, r.refers_to) for r in rows)


# sharding

def test_lookup_table_matches_the_turns():
    shards = ["c", "a", "b"]
    owner, size = sharding.lookup_table(shards, 101), 101
    order = {s: [(sharding._number(f"offset:{s}") + j * (1 + sharding._number(f"skip:{s}") % (size - 1))) % size for j in range(size)] for s in shards}
    want = {}
    while len(want) < size:
        for s in sorted(shards):
            free = [x for x in order[s] if x not in want]
            if free:
                want[free[0]] = s
    assert owner == [want[k] for k in range(size)]


def test_lookup_table_is_even_and_moves_little():
    shards = [f"s{k}" for k in range(20)]
    count = Counter(sharding.lookup_table(shards, 2003))
    assert max(count.values()) - min(count.values()) <= 1
    weighted = Counter(sharding.lookup_table({"a": 1, "b": 3}, 4001))
    assert abs(weighted["b"] - 3 * weighted["a"]) <= 4
    assert sharding.moved(shards, shards[:-1], 2003) < 0.05
    for bad in ((shards, 2002), ([], 2003), ({"a": 0}, 2003)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_placement_rows(spark):
    frame = docs(spark, EDGE, shard="old", slot="old")
    out = sharding.place(frame, ["a", "b"], size=103).collect()
    owner = sharding.lookup_table(["a", "b"], 103)
    assert len(out) == len(EDGE)
    for r in out:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 103 and r.shard == owner[r.slot]
    assert sharding.place(frame.where("false"), ["a"], size=103).count() == 0
    assert frame.select(F.lit(1)).count() == len(EDGE)


def test_spans_are_cut_from_their_own_text(spark):
    """An id with two texts: the one without benchmark text stays as it is."""
    item = "one two three four five six seven eight nine ten"
    rows = [(1, f"before {item} after"), (1, "this text has nothing of the benchmark at all"), (1, f"{item} first"), (2, None)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontaminate.decontaminate(docs(spark, rows), bench, action="spans")
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(
        [(1, "before  after"), (1, rows[1][1]), (1, " first"), (2, None)], key=str)


def test_clashing_names_have_no_case(spark):
    df = spark.createDataFrame([(1, "a", "b")], "doc_id long, Shard string, SLOT string")
    placed = sharding.place(df, ["x", "y"])
    assert placed.columns == ["doc_id", "slot", "shard"] and placed.first().shard in ("x", "y")
