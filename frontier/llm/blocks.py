"""HTML text as a sequence of leaf blocks, each with its path of tags.

One pass over the markup with a small element stack; comments, scripts, styles and other
raw-text elements give no text. What a browser shows of formulas, objects and ``xmp`` is text
like any other. Every step moves forward, so broken markup stays linear."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

#: Fixed values of the HTML standard: elements without end tag, elements whose content is
#: raw text, and elements that stand inside a line.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "noembed", "noframes", "template", "svg", "select", "annotation", "annotation-xml"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "nobr", "object", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
    # formulas
    "annotation", "annotation-xml", "math", "merror", "mfrac", "mi", "mmultiscripts", "mn", "mo", "mover", "mpadded", "mphantom", "mprescripts", "mroot", "mrow", "ms", "mspace", "msqrt",
    "mstyle", "msub", "msubsup", "msup", "mtable", "mtd", "mtext", "mtr", "munder", "munderover", "semantics",
}
#: Elements that end an open paragraph, and elements that end an open element of their kind.
ENDS_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"ul", "ol", "dl", "table", "menu"}

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden|style|href|data-[a-z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: A link's address alone, without a character that could begin another value: it has no tokens.
_ONLY_LINK = re.compile(r"""\s+href=(?:"[^"]*"|'[^']*')\s*""")
_PART = re.compile(r"[a-z]+")
#: Innermost open elements that a block's path names one by one (deeper nesting stays linear).
MAX_PATH = 64
#: White space inside a block (HTML white space and the vertical tab); a no-break space is a character.
_BLANK = re.compile(r"[ \t-\r]+")
_NOT_SPACE = re.compile(r"[\t-\r]")


@dataclass(slots=True)
class Element:
    name: str
    tokens: tuple[str, ...] = ()


@dataclass(slots=True)
class Block:
    text: str
    path: tuple[Element, ...]
    link_chars: int = 0


@dataclass(slots=True)
class _Open:
    """The block that is being read."""

    parts: list[str] = field(default_factory=list)
    path: tuple[Element, ...] = ()
    link_chars: int = 0


def _tokens(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes and "hidden" not in attributes:
        return ()
    if _ONLY_LINK.fullmatch(attributes):
        return ()
    out = []
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "href":
            continue
        if name == "style":
            if "display:none" in value.replace(" ", ""):
                out.append("hidden")
        elif name in ("hidden", "aria-hidden"):
            if value != "false":
                out.append("hidden")
        elif name.startswith("data-"):
            out += _PART.findall(name[5:])
        else:
            out += _PART.findall(value)
    return tuple(out)


def read(text: str, telling: frozenset[str] = frozenset()) -> list[Block]:
    """The blocks of a page in order. Inline elements don't part a block, ``br`` does. A path
    holds the innermost elements; below deeper nesting it begins with the ``telling`` names and
    class, id and role words of all open elements, one element each."""
    stack: list[Element] = []
    opened: defaultdict[str, int] = defaultdict(int)
    told: defaultdict[str, int] = defaultdict(int)
    blocks: list[Block] = []
    block = _Open()

    def flush() -> None:
        nonlocal block
        if block.parts:
            whole = html.unescape("".join(block.parts))
            if "  " in whole or _NOT_SPACE.search(whole):
                whole = _BLANK.sub(" ", whole)
            whole = whole.strip(" ")
            if whole:
                blocks.append(Block(whole, block.path, block.link_chars))
            block = _Open()

    def add(part: str) -> None:
        if not block.parts:
            if not part.strip():
                return
            block.path = tuple(stack) if len(stack) <= MAX_PATH else (*outer(), *stack[-MAX_PATH:])
        block.parts.append(part)
        for e in stack[-3:]:
            if e.name == "a":
                block.link_chars += len(part)
                break

    def outer() -> list[Element]:
        return [*(Element(n) for n in sorted(telling) if opened[n] > 0), *(Element("", (t,)) for t in sorted(telling) if told[t] > 0)]

    def close(k: int) -> None:
        for e in stack[k:]:
            opened[e.name] -= 1
            for t in e.tokens:
                told[t] -= 1
        del stack[k:]

    def leave(names: set[str]) -> None:
        """Close the innermost open element of these names, within its list or table."""
        for n in names:
            if opened[n]:
                break
        else:
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].name in names:
                close(k)
                return
            if stack[k].name in _SCOPE:
                return

    at, n = 0, len(text)
    while at < n:
        begin = text.find("<", at)
        if begin < 0:
            add(text[at:])
            break
        if begin > at:
            add(text[at:begin])
        after = text[begin + 1:begin + 2]
        if after == "!" or after == "?":
            if text.startswith("<!--", begin):
                end = text.find("-->", begin + 4)
                at = n if end < 0 else end + 3
            else:
                end = text.find(">", begin)
                at = n if end < 0 else end + 1
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            add("<")
            at = begin + 1
            continue
        tag = _TAG.match(text, begin) or _LOOSE.match(text, begin)
        if tag is None:
            if after == "/":  # an end tag without a name
                end = text.find(">", begin)
                at = n if end < 0 else end + 1
                continue
            break  # the page ends inside a tag
        at = tag.end()
        end_tag, name, attributes = tag.groups()
        name = name.lower()
        if block.parts and name not in INLINE:
            flush()
        if end_tag:
            if opened[name]:
                k = len(stack) - 1
                while stack[k].name != name:
                    k -= 1
                close(k)
            continue
        if name == "xmp":   # shown as it is written
            end = re.compile(r"</xmp(?=[\s/>])", re.I).search(text, at)
            stack.append(Element(name, _tokens(attributes)))
            add(html.escape(text[at:n if end is None else end.start()], quote=False))
            flush()
            stack.pop()
            after_end = -1 if end is None else text.find(">", end.start())
            at = n if after_end < 0 else after_end + 1
            continue
        if name in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(text, at)
                after_end = -1 if end is None else text.find(">", end.start())
                at = n if after_end < 0 else after_end + 1
            continue
        if name in VOID:
            continue
        if opened["p"] and name in ENDS_P:
            leave({"p"})
        if name in ENDS_OWN:
            leave(ENDS_OWN[name])
        tokens = _tokens(attributes) if attributes else ()
        stack.append(Element(name, tokens))
        opened[name] += 1
        for t in tokens:
            told[t] += 1
    flush()
    return blocks
