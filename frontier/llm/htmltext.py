"""Main text of pages by a recurrent block labeller.

A page is its sequence of leaf blocks (:mod:`.blocks`). Every block is a bag of hashed
tokens: its path of tags with class, id and role words, all its words (distinct ones, averaged),
and the sizes that tell text from menus. A bidirectional LSTM in numpy reads the whole sequence in both directions
and gives every block the probability of being main text, so a block is judged with the
context of the document.

There are no labelled pages, so the labeller learns from a bounded sample of the pages
themselves with weak labels: blocks below an element that names itself the article are main
text, blocks below elements that name themselves menus, notices, forms, comments and so on
aren't. Every sampled page is also learned in altered forms: with furniture of many kinds
put in at several places, and with the name of the article's element changed or taken away,
so that the labeller doesn't lean on one kind of page; and with no names at all, so that words
tell what names don't.

Defined results: null and empty pages, and pages without text, have the empty text; blocks
are never cut or capped; repeated rows give equal rows. Of a page over ``LONG`` bytes, a few
runs of its blocks are learned, taken at even distances by the tasks; shorter sampled pages come
whole to the driver. Without a labeller (``None``) the weak labels decide.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .blocks import Block, Element, read
from .labelled import smallest

#: Pages that are learned from, their altered forms, the bytes beyond which a page is learned in
#: runs of blocks, the number of its runs and the blocks of one.
MAX_TRAIN, FORMS, LONG, RUNS, RUN = 240, 4, 1 << 17, 4, 48
PATH_DIM, WORD_DIM, SIZE_DIM, HIDDEN = 2048, 512, 64, 24
#: A sample of few examples is gone through more often, for at least ``LEAST_STEPS`` steps.
EPOCHS, LEAST_STEPS, BATCH, STEP_SIZE, SEED = 14, 100, 32, 0.01, 5
DIM = PATH_DIM + WORD_DIM + SIZE_DIM

#: Names by which elements tell what they hold.
MAIN_NAMES = {"article", "main", "content", "post", "entry", "story", "articlebody", "body-text", "text"}
OTHER_NAMES = {
    "nav", "navigation", "navbar", "menu", "header", "masthead", "footer", "sidebar", "aside", "complementary", "ad", "ads", "advert", "advertisement",
    "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "notice", "consent", "gdpr", "alert", "popup", "modal", "share",
    "sharing", "social", "related", "recommended", "comment", "comments", "reply", "replies", "respond", "discussion", "breadcrumb", "breadcrumbs",
    "pagination", "pager", "newsletter", "subscribe", "signup", "login", "search", "form", "widget", "toolbar", "hidden", "copyright", "legal",
    "disclaimer", "tags", "byline", "meta", "button", "dialog", "skip",
}
OTHER_TAGS = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head"}
TELLING = frozenset(MAIN_NAMES | OTHER_NAMES | OTHER_TAGS)


def weak_label(block: Block) -> bool:
    """Whether the element names of the path say main text: the innermost that says anything decides,
    and nothing inside furniture is main text."""
    main = False
    for e in block.path:
        if e.name in OTHER_TAGS or OTHER_NAMES.intersection(e.tokens):
            return False
        if e.name in ("article", "main") or MAIN_NAMES.intersection(e.tokens):
            main = True
    return main


def _bucket(text: str, dim: int) -> int:
    return zlib.crc32(text.encode()) % dim


_memo: dict[str, int] = {}


def _path_token(text: str) -> int:
    k = _memo.get(text)
    if k is None:
        k = _bucket(text, PATH_DIM)
        if len(_memo) < 1 << 16:
            _memo[text] = k
    return k


_steps: dict[tuple[int, str, tuple[str, ...]], list[int]] = {}


def _path_step(key: tuple[int, str, tuple[str, ...]]) -> list[int]:
    """The tokens of one element of a path; its place counts for the two innermost."""
    depth, name, tokens = key
    ids = [_path_token(f"in {name}"), *(_path_token(f"says {t}") for t in tokens)]
    if depth < 2:
        ids.append(_path_token(f"{depth} {name}"))
    if len(_steps) < 1 << 14 and len(tokens) < 32:
        _steps[key] = ids
    return ids


_words: dict[str, int] = {}


def _word_token(word: str) -> int:
    k = _words.get(word)
    if k is None:
        k = PATH_DIM + _bucket(word, WORD_DIM)
        if len(_words) < 1 << 16:
            _words[word] = k
    return k


def features(blocks: list[Block]) -> list[tuple[list[int], list[float]]]:
    """Per block the token numbers and their weights."""
    out = []
    before: tuple = ()
    path_ids: list[int] = []
    for b in blocks:
        if b.path is not before:
            path_ids = []
            for depth, e in enumerate(reversed(b.path)):
                key = (min(depth, 2), e.name, e.tokens)
                path_ids += _steps.get(key) or _path_step(key)
            before = b.path
        words = b.text.lower().split()
        distinct = dict.fromkeys(words)
        word_ids = list(map(_words.get, distinct))
        if None in word_ids:
            word_ids = [_word_token(w) if k is None else k for w, k in zip(distinct, word_ids, strict=True)]
        told = Counter(word_ids)
        n, n_distinct = len(words), len(distinct)
        sizes = [
            PATH_DIM + WORD_DIM + min(11, int(2 * math.log2(n + 1))),
            PATH_DIM + WORD_DIM + 16 + min(7, int(8 * b.link_chars / max(1, len(b.text)))),
            PATH_DIM + WORD_DIM + 24 + (b.text[-1:] in ".!?:;\"'"),
            PATH_DIM + WORD_DIM + 28 + min(7, sum(map(b.text.count, ",.;")) * 8 // max(1, n)),
        ]
        ids = path_ids + list(told) + sizes
        weights = [1.0] * len(path_ids) + [k / n_distinct for k in told.values()] + [0.5] * len(sizes)
        out.append((ids, weights))
    return out


@dataclass
class Layer:
    """One direction: input weights by token, recurrent weights, and bias; gates i, f, o, g."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray


@dataclass
class Model:
    ahead: Layer
    back: Layer
    out: np.ndarray
    bias: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.ahead.w, self.ahead.u, self.ahead.b, self.back.w, self.back.u, self.back.b, self.out, self.bias]


def new_model(rng: np.random.Generator) -> Model:
    def layer() -> Layer:
        b = np.zeros(4 * HIDDEN)
        b[HIDDEN:2 * HIDDEN] = 1.0  # remember at first
        return Layer(rng.normal(0, 0.05, (DIM, 4 * HIDDEN)), rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)), b)
    return Model(layer(), layer(), rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Pages:
    """Token bags of pages, padded to one length; places are (step, page)."""

    def __init__(self, pages: list[list[tuple[list[int], list[float]]]]):
        self.lengths = np.array([len(p) for p in pages])
        self.steps, self.n = int(self.lengths.max(initial=0)), len(pages)
        ids: list[int] = []
        weights: list[float] = []
        place, sizes = [], []
        for t in range(self.steps):
            for k, page in enumerate(pages):
                if t < len(page):
                    i, w = page[t]
                    place.append(t * self.n + k)
                    sizes.append(len(i))
                    ids += i
                    weights += w
        self.place = np.repeat(np.array(place, np.int64), sizes)
        self.ids, self.weights = np.array(ids, np.int64), np.array(weights, np.float64)
        self.mask = np.arange(self.steps)[:, None] < self.lengths[None, :]

    def inputs(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros((self.steps * self.n, w.shape[1]), w.dtype)
        if len(self.ids):
            begin = np.flatnonzero(np.concatenate([[True], self.place[1:] != self.place[:-1]]))
            out[self.place[begin]] = np.add.reduceat(w[self.ids] * self.weights[:, None].astype(w.dtype), begin)
        return out.reshape(self.steps, self.n, -1)


def _run(layer: Layer, pages: Pages, backward: bool, keep: bool):
    """Hidden states by step (and what the gradient needs). Padding leaves the state as it is."""
    x = pages.inputs(layer.w) + layer.b
    h, c = np.zeros((pages.n, HIDDEN), x.dtype), np.zeros((pages.n, HIDDEN), x.dtype)
    hs, saved = np.zeros((pages.steps, pages.n, HIDDEN), x.dtype), []
    H = HIDDEN
    for t in (range(pages.steps - 1, -1, -1) if backward else range(pages.steps)):
        z = x[t] + h @ layer.u
        gates = _sigmoid(z[:, :3 * H])
        g = np.tanh(z[:, 3 * H:])
        i, f, o = gates[:, :H], gates[:, H:2 * H], gates[:, 2 * H:]
        on = pages.mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep:
            saved.append((t, h, c, i, f, o, g, tanh_c))
        h, c = np.where(on, o * tanh_c, h), np.where(on, new_c, c)
        hs[t] = h
    return hs, saved


def predict(model: Model, pages: Pages) -> np.ndarray:
    """Probability of main text by (step, page)."""
    a, _ = _run(model.ahead, pages, False, False)
    b, _ = _run(model.back, pages, True, False)
    return _sigmoid(a @ model.out[:HIDDEN] + b @ model.out[HIDDEN:] + model.bias[0])


def _gradients(model: Model, pages: Pages, labels: np.ndarray) -> list[np.ndarray]:
    runs = [_run(model.ahead, pages, False, True), _run(model.back, pages, True, True)]
    both = np.concatenate([runs[0][0], runs[1][0]], axis=2)
    p = _sigmoid(both @ model.out + model.bias[0])
    d = np.where(pages.mask, p - labels, 0) / max(1, pages.mask.sum())
    grads: list[np.ndarray] = []
    for k, (layer, (_, saved)) in enumerate(zip((model.ahead, model.back), runs, strict=True)):
        dz_all = np.zeros((pages.steps, pages.n, 4 * HIDDEN))
        du = np.zeros_like(layer.u)
        dh, dc = np.zeros((pages.n, HIDDEN)), np.zeros((pages.n, HIDDEN))
        part = model.out[k * HIDDEN:(k + 1) * HIDDEN]
        for t, h, c, i, f, o, g, tanh_c in reversed(saved):
            on = pages.mask[t][:, None]
            dh = dh + d[t][:, None] * part
            dn = np.where(on, dh, 0)
            dcn = np.where(on, dc, 0) + dn * o * (1 - tanh_c**2)
            dz = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), dn * tanh_c * o * (1 - o), dcn * i * (1 - g**2)], axis=1)
            dz_all[t] = dz
            du += h.T @ dz
            dh = np.where(on, dz @ layer.u.T, dh)
            dc = np.where(on, dcn * f, dc)
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        dw = np.zeros_like(layer.w)
        np.add.at(dw, pages.ids, flat[pages.place] * pages.weights[:, None])
        grads += [dw, du, flat.sum(axis=0)]
    grads.append((both * d[:, :, None]).sum(axis=(0, 1)))
    grads.append(np.array([d.sum()]))
    return grads


#: Furniture that is put into learned pages: an opening tag, and how its text is wrapped.
FURNITURE = [
    ("<nav>", "ul"), ('<nav class="menu">', "a"), ("<header>", "p"), ('<div class="header">', "div"), ('<div id="masthead">', "a"), ("<footer>", "p"),
    ('<div class="footer">', "p"), ('<div id="footer-links">', "ul"), ("<aside>", "p"), ('<aside class="sidebar">', "ul"), ('<div class="sidebar">', "p"),
    ('<div id="sidebar">', "a"), ('<div class="ad">', "div"), ('<div class="ads banner">', "p"), ('<section class="promo">', "p"),
    ('<div class="sponsored advert">', "a"), ('<div class="cookie-notice">', "p"), ('<div id="cookie-banner" role="dialog">', "div"),
    ('<div class="notice consent">', "p"), ('<div class="alert notice">', "div"), ('<form action="/s">', "label"), ('<form class="newsletter subscribe">', "p"),
    ('<form class="search login">', "button"), ('<section id="comments">', "p"), ('<div class="comments">', "div"), ('<div class="comment reply">', "p"),
    ('<ol class="comment-list">', "li"), ('<section class="comments discussion">', "article"), ('<div class="share social">', "a"),
    ('<div class="related">', "ul"), ('<ul class="breadcrumb">', "li"), ('<div class="pagination">', "a"), ('<div class="widget">', "p"), ('<div hidden>', "p"),
    ('<div class="popup modal">', "p"), ('<div role="navigation">', "a"), ('<div role="banner">', "p"), ('<div role="contentinfo" class="copyright">', "p"),
    ('<ul class="menu">', "li"), ('<div class="menu">', "a"), ("<menu>", "li"), ('<div class="tags">', "a"),
]
#: Other names of the element that holds the article.
HOLDERS = ["<main>", '<div class="content">', '<div id="content">', '<div class="post">', '<div class="entry-content">', '<section class="story">',
           '<div class="article-body">', '<div role="main">', '<main><div>', "<article><div>", '<main class="main"><article>', "<div>"]


#: Elements and wraps that furniture of any name comes in, and what an article may hold beside paragraphs.
_BOXES = ["div", "section", "aside", "ul", "ol", "header", "footer"]
_WRAPS = ["p", "div", "a", "li", "ul", "label"]
_BODY = ["<ul><li>{}</li></ul>", "<ol><li>{}</li></ol>", "<blockquote><p>{}</p></blockquote>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<h3>{}</h3>", "<pre>{}</pre>",
         "<div>{}</div>", '<div class="row"><p>{}</p></div>', '<p class="lead">{}</p>', "<section><p>{}</p></section>", "<table><tr><td>{}</td></tr></table>",
         "<figure><figcaption>{}</figcaption></figure>", "<p><em>{}</em></p>", "<p><span>{}</span></p>", "<dl><dd>{}</dd></dl>"]


def _named(rng: np.random.Generator) -> tuple[str, str]:
    """Furniture that says what it is by one of the known names, alone or in a longer one."""
    names = sorted(OTHER_NAMES)
    name = names[int(rng.integers(0, len(names)))]
    form = ["{}", "site-{}", "{}-box", "page-{} x", "c-{}__inner"][int(rng.integers(0, 5))].format(name)
    return f'<{_BOXES[int(rng.integers(0, len(_BOXES)))]} {"class" if rng.random() < 0.6 else "id"}="{form}">', _WRAPS[int(rng.integers(0, len(_WRAPS)))]


def _rebuilt(inner: str, rng: np.random.Generator) -> str:
    """An article's markup with some paragraphs as other elements, and links in some."""
    def one(m: re.Match) -> str:
        roll = rng.random()
        if roll < 0.25:
            return _BODY[int(rng.integers(0, len(_BODY)))].format(m[1])
        if roll < 0.35:
            words = m[1].split(" ")
            at = int(rng.integers(0, len(words)))
            return "<p>" + " ".join([*words[:at], f'<a href="/r">{words[at]}</a>', *words[at + 1:]]) + "</p>"
        return m[0]
    return re.sub(r"<p>([^<]+)</p>", one, inner)


def _fill(kind: tuple[str, str], words: list[str], rng: np.random.Generator) -> str:
    """A piece of furniture with words of the page: a few short entries, or one to four texts."""
    opening, wrap = kind
    close = f"</{re.match(r'<(\w+)', opening)[1]}>"
    def some(a: int, b: int) -> str:
        n = int(rng.integers(a, b))
        at = int(rng.integers(0, max(1, len(words) - n)))
        return " ".join(words[at:at + n])
    if wrap in ("a", "li", "ul", "button", "label"):
        entries = [some(1, 5) for _ in range(int(rng.integers(1, 8)))]
        body = {"a": "".join(f'<a href="/x">{e}</a> ' for e in entries), "li": "".join(f"<li>{e}</li>" for e in entries),
                "ul": "<ul>" + "".join(f'<li><a href="/x">{e}</a></li>' for e in entries) + "</ul>",
                "button": "".join(f"<label>{e}</label><input><button>{e}</button>" for e in entries[:2]),
                "label": "".join(f"<p><label>{e}</label><input></p>" for e in entries)}[wrap]
    else:
        body = "".join(f"<{wrap}>{some(2, 60)}</{wrap}>" for _ in range(int(rng.integers(1, 5))))
    return opening + body + close


def altered(page: str, rng: np.random.Generator) -> tuple[str, list[bool]] | None:
    """A changed form of a page with the label of every block, or none if it has no article element."""
    begin = re.search(r"<article\b[^>]*>", page, re.I)
    end = page.lower().rfind("</article>")
    if begin is None or end < begin.end():
        return None
    inner, words = page[begin.end():end], re.sub(r"<[^>]*>", " ", page[begin.end():end]).split()
    if not words:
        return None
    pick = lambda n: [FURNITURE[int(k)] if k < len(FURNITURE) else _named(rng) for k in rng.integers(0, 2 * len(FURNITURE), n)]
    mark = "x" + "q" * 9  # stands for furniture until the labels are read
    piece = lambda kind: f'<div data-{mark}="">{_fill(kind, words, rng)}</div>'
    if rng.random() < 0.7:
        inner = _rebuilt(inner, rng)
    gaps = [m.start() for m in re.finditer(r"<p\b", inner)][1:]
    for at in sorted((int(rng.choice(gaps)) for _ in range(int(rng.integers(0, 3)))) if gaps else [], reverse=True):
        inner = inner[:at] + piece(pick(1)[0]) + inner[at:]
    if rng.random() < 0.6:
        inner += "".join(piece(k) for k in pick(int(rng.integers(1, 4))))
    holder = page[begin.start():begin.end()] if rng.random() < 0.4 else HOLDERS[int(rng.integers(0, len(HOLDERS)))]
    close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", holder)))
    head = page[:begin.start()] + "".join(piece(k) for k in pick(int(rng.integers(0, 4))))
    tail = "".join(piece(k) for k in pick(int(rng.integers(0, 4)))) + page[end + len("</article>"):]
    whole = f'{head}<div data-main{mark}="">{holder}{inner}{close}</div>{tail}'
    labels = []
    for b in read(whole, TELLING | {mark, "main" + mark}):
        tokens = {t for e in b.path for t in e.tokens}
        labels.append("main" + mark in tokens and mark not in tokens)
    return whole, labels


def _without_marks(blocks: list[Block]) -> list[Block]:
    """The helper elements of :func:`altered` leave the paths again."""
    for b in blocks:
        b.path = tuple(e for e in b.path if not any(t.endswith("q" * 9) for t in e.tokens))
    return blocks


def _neutral(blocks: list[Block]) -> list[Block]:
    """The blocks with paths that name nothing."""
    telling = OTHER_TAGS | {"article", "main"}
    return [Block(b.text, tuple(Element("div" if e.name in telling else e.name) for e in b.path), b.link_chars) for b in blocks]


def long_runs(page: str) -> list[tuple[list[tuple[list[int], list[float]]], list[bool]]]:
    """Examples (features and weak labels) of a long page: runs of blocks, with names and without."""
    blocks = read(page, TELLING)
    out = []
    for at in sorted({(len(blocks) - RUN) * k // (RUNS - 1) if len(blocks) > RUN else 0 for k in range(RUNS)}) if blocks else []:
        run = blocks[at:at + RUN]
        labels = [weak_label(b) for b in run]
        out += [(features(run), labels), (features(_neutral(run)), labels)]
    return out


def train(pages: list[str], more: list[tuple[list[tuple[list[int], list[float]]], list[bool]]] = ()) -> Model | None:
    """The labeller of whole pages and of ``more`` examples (:func:`long_runs`)."""
    rng = np.random.default_rng(SEED)
    rows: list[tuple[list[tuple[list[int], list[float]]], list[bool]]] = []
    for page in pages:
        blocks = read(page, TELLING)
        if blocks:
            labels = [weak_label(b) for b in blocks]
            rows += [(features(blocks), labels), (features(_neutral(blocks)), labels)]
        for _ in range(FORMS):
            changed = altered(page, rng)
            if changed is not None:
                rows.append((features(_without_marks(read(changed[0], TELLING))), changed[1]))
    rows += more
    if not rows:
        return None
    model = new_model(rng)
    params = model.arrays()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    per_epoch = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-LEAST_STEPS // per_epoch))
    total = epochs * per_epoch
    for _ in range(epochs):
        order = sorted(range(len(rows)), key=lambda i: (len(rows[i][0]), rng.random()))
        batches = [order[a:a + BATCH] for a in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            bags = []
            for i in batches[k]:
                words_off = rng.random() < 0.5  # words may not decide alone
                bags.append([_dropped(ids, ws, words_off, rng) for ids, ws in rows[i][0]])
            batch = Pages(bags)
            wanted = np.zeros((batch.steps, batch.n))
            for j, i in enumerate(batches[k]):
                wanted[:len(rows[i][1]), j] = rows[i][1]
            step += 1
            rate = STEP_SIZE * (1 - step / (total + 1))
            for p, g, m, v in zip(params, _gradients(model, batch, wanted), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    for layer in (model.ahead, model.back):
        layer.w, layer.u, layer.b = (x.astype(np.float32) for x in (layer.w, layer.u, layer.b))
    return model


def _dropped(ids: list[int], weights: list[float], words_off: bool, rng: np.random.Generator) -> tuple[list[int], list[float]]:
    keep = [not (words_off and PATH_DIM <= i < PATH_DIM + WORD_DIM) and rng.random() > 0.1 for i in ids]
    return [i for i, k in zip(ids, keep, strict=True) if k], [w for w, k in zip(weights, keep, strict=True) if k]


def label(model: Model | None, pages: list[list[Block]], group: int = 64) -> list[np.ndarray]:
    """Per page whether each block is main text; pages of like length run together. Without a
    model the weak labels decide."""
    if model is None:
        return [np.array([weak_label(b) for b in p], bool) for p in pages]
    out = [np.zeros(len(p), bool) for p in pages]
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        longest = len(pages[order[min(len(order), at + group) - 1]])
        size = max(1, min(group, 16384 // max(1, longest)))
        part = order[at:at + size]
        p = predict(model, Pages([features(pages[i]) for i in part]))
        for j, i in enumerate(part):
            out[i] = p[:len(pages[i]), j] >= 0.5
        at += size
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", max_train: int = MAX_TRAIN) -> Model | None:
    """The labeller of at most ``max_train`` different pages of any length (those with the smallest
    hash). What comes to the driver is bounded by ``LONG`` bytes or ``RUNS`` runs a page."""
    rows = pages.select(F.col(html_col).alias("h")).where(F.col("h").isNotNull())
    keys = smallest(rows.select(F.xxhash64("h").alias("k")).distinct(), "k", max_train)
    chosen = rows.withColumn("k", F.xxhash64("h")).join(F.broadcast(keys), "k").groupBy("k").agg(F.min("h").alias("h"))

    def examples(batches):
        for batch in batches:
            for k, h in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for i, (bags, labels) in enumerate(long_runs(h.as_py())):
                    yield pa.RecordBatch.from_pydict({"k": [k], "i": [i], "ids": [[a for a, _ in bags]], "weights": [[b for _, b in bags]], "labels": [labels]},
                                                     schema=_EXAMPLES)

    K.bounded_batches(pages.sparkSession)
    runs = chosen.where(F.octet_length("h") > LONG).select("k", "h").mapInArrow(
        examples, "k bigint, i int, ids array<array<int>>, weights array<array<double>>, labels array<boolean>")
    more = [(list(zip(r.ids, r.weights, strict=True)), r.labels) for r in runs.orderBy("k", "i").collect()]
    return train([r.h for r in chosen.where(F.octet_length("h") <= LONG).orderBy("k").collect()], more)


_EXAMPLES = pa.schema([("k", pa.int64()), ("i", pa.int32()), ("ids", pa.list_(pa.list_(pa.int32()))), ("weights", pa.list_(pa.list_(pa.float64()))),
                       ("labels", pa.list_(pa.bool_()))])


def extract(pages: DataFrame, model: Model | None, id_col: str = "page_id", html_col: str = "html", extra: tuple[str, ...] = ("url",)) -> DataFrame:
    """``id_col``, the ``extra`` columns, ``text`` and ``n_chars`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in (id_col, *extra))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                blocks = [read(h or "", TELLING) for h in part.column(0).to_pylist()]
                texts = [" ".join(b.text for b, good in zip(p, keep, strict=True) if good)
                         for p, keep in zip(blocks, label(shared.value, blocks), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(1 + i) for i in range(1 + len(extra))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[id_col, *extra, "text", "n_chars"])

    K.bounded_batches(pages.sparkSession)
    return pages.select(F.col(html_col).alias("__llm_html"), id_col, *extra).mapInArrow(run, f"{kinds}, text string, n_chars bigint")
