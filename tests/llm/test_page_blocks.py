"""Blocks of pages: what the reader and the labeller don't do again, with the same results."""

import re

from frontier.llm import blocks as B
from frontier.llm import htmltext as H


class _Never:
    def sub(self, *_):
        raise AssertionError("even text was rewritten")


def test_even_text_isnt_rewritten(monkeypatch):
    uneven = "<p> a  b\tc\nd\x0b e&nbsp;f </p><div>x &#32; y</div><p>\x0c z</p>"
    assert [b.text for b in B.read(uneven)] == ["a b c d e\xa0f", "x y", "z"]
    monkeypatch.setattr(B, "_BLANK", _Never())
    assert [b.text for b in B.read("<p>one two</p><ul><li>a b</li></ul>")] == ["one two", "a b"]


def test_attributes_of_links_alone_have_no_tokens():
    plain = lambda a: tuple(t for n, x, y, z in B._ATTRIBUTE.findall(a) if n.lower() in ("class", "id", "role", "itemprop") for t in re.findall("[a-z]+", (x or y or z).lower()))
    for a in (' href="/a?class=b"', " href='id=x' ", ' href="/a" class="nav-x"', ' HREF="/a" id=top', ' xhref="/a" role="main"', ' href="a"class="b"', ' href=class="b"'):
        assert B._tokens(a) == plain(a), a


def test_end_tags_lists_and_open_paragraphs():
    page = "<div><p>a<p>b<ul><li>c<li><b>d</b> e</ul></p></i>f</div><a href='/x'>g</a><h1>h</h2>i</h1>"
    assert [(b.text, [e.name for e in b.path], b.link_chars) for b in B.read(page)] == [
        ("a", ["div", "p"], 0), ("b", ["div", "p"], 0), ("c", ["div", "ul", "li"], 0), ("d e", ["div", "ul", "li", "b"], 0),
        ("f", ["div"], 0), ("g", ["a"], 1), ("h", ["h1"], 0), ("i", ["h1"], 0)]


def test_known_words_and_paths_are_looked_up_once(monkeypatch):
    blocks = B.read('<div class="post x"><p>Alpha beta ALPHA, gamma.</p><ul><li><a href="/">beta</a></li></ul></div>')
    first = H.features(blocks)
    for name in ("_word_token", "_path_token"):
        monkeypatch.setattr(H, name, lambda text: (_ for _ in ()).throw(AssertionError(text)))
    assert H.features(blocks) == first


def test_bags_by_step_then_page():
    pages = [[([1, 2], [1.0, 0.5]), ([3], [2.0])], [], [([4], [1.0]), ([], []), ([5, 6, 7], [1.0, 1.0, 1.0])]]
    bags = H.Pages(pages)
    assert bags.place.tolist() == [0, 0, 2, 3, 8, 8, 8] and bags.ids.tolist() == [1, 2, 4, 3, 5, 6, 7] and bags.weights.tolist() == [1.0, 0.5, 1.0, 2.0, 1.0, 1.0, 1.0]
