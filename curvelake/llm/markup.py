"""A page as a stream of tokens and text blocks.

One pass over the whole html, in linear time. Elements close as browsers close them: an end tag closes everything that is
open inside its element, a block start closes an open paragraph, an item closes its sibling, and what is never closed ends
with its parent. A token is a start tag, an end tag or a whole run of text, each with the path of its open elements (names and
classes) hashed along the way, so equal words in different places of a page are different tokens.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from itertools import pairwise

import xxhash

#: Element names of the HTML standard, by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
ENDS_PARAGRAPH = BLOCK - set("body caption dd dt head html legend li optgroup option tbody td tfoot th thead tr summary".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "tbody": {"tbody", "thead", "tr", "td", "th"}, "tfoot": {"tbody", "thead", "tr", "td", "th"}}
#: Elements inside which a sibling must lie for it to be closed.
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"},
          "option": {"select", "datalist"}, "p": {"td", "th", "table", "caption", "button"}}
#: The end tag of an element that is no block does not end these.
INLINE_SCOPE = set("article main section div td th body".split())
#: Elements without main text, and words of a class, id or role that mark such elements.
ASIDE = set("aside audio button canvas datalist dialog embed footer form head header iframe input map menu nav noframes noscript object option script select style "
            "svg template textarea title video".split())
HINTS = set("ad ads advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
            "cookies disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
            "overlay pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup sponsor "
            "sponsored subscribe subscription toolbar topbar widget widgets".split())
#: The marks that count on an article element itself.
NO_ARTICLE = set("ad ads advert advertisement comment comments promo promoted related replies reply sponsored teaser widget".split())
#: Inside a main element a header is the head of the article, which holds its heading.
IN_MAIN = HINTS - {"header"}
#: Such a word before a hint says that the element stands beside what is named, or has it in it.
NOT_ITSELF = {"with", "has", "have", "no", "without", "show", "hide", "hides", "shows"}
#: How near an element is to the main text.
MAIN = {"main": 1, "article": 2}

#: Kinds of tokens.
TEXT, START, END = 0, 1, 2

TAG = re.compile(r"<(?:!--|(/?)([a-zA-Z][^\s<>/]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+)>|[!?/][^<>]*(?:>|(?=<)|$)|/?[a-zA-Z][^<>]*(?:>|(?=<)|$))")
ATTRIBUTE = re.compile(r"(?:^|[\s/])(class|id|role|hidden|aria-hidden|type)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
RAW_END = {name: re.compile("</" + name, re.I) for name in RAW}
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass(slots=True)
class Block:
    """Raw runs of text between block borders, and their template tokens; ``main`` is 2 in an article, 1 in a main element, else 0."""

    main: int
    parts: list[str] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)

    @property
    def text(self) -> str:
        """Character references decoded, white space as single spaces."""
        return " ".join("".join([entities.unescape(p) if "&" in p else p for p in self.parts]).split())


@dataclass(slots=True)
class Page:
    """Tokens in page order, and the blocks outside the elements that hold no main text."""

    tokens: list[int]
    blocks: list[Block]

    def kept(self, template: frozenset[int] | set[int] = frozenset()) -> list[str]:
        """Texts of the main blocks that are not all template.

        The main blocks are those in articles, if they hold half or more of what stands in main elements and articles; else
        those in either, and all blocks of a page without such elements.
        """
        texts = [(b, t) for b in self.blocks if (t := b.text)]
        size = {level: sum(len(t) for b, t in texts if b.main >= level) for level in (1, 2)}
        least = 0 if not size[1] else 2 if 2 * size[2] >= size[1] else 1
        return [t for b, t in texts if b.main >= least and not (template and all(k in template for k in b.tokens))]


def signed(data: str | bytes, seed: int = 0) -> int:
    value = xxhash.xxh64_intdigest(data, seed & (1 << 64) - 1)
    return value - (1 << 64) if value >> 63 else value


def kind(token: int, of: int) -> int:
    """The token with its kind in the lowest two bits."""
    return token & ~3 | of


def end_of(start: int) -> int:
    """The end tag's token of the element that a start tag's token opens."""
    return kind(signed("/", start), END)


def hinted(attributes: dict[str, str], hints: set[str]) -> bool:
    """Whether class, id or role name one of ``hints``."""
    for name in ("class", "id", "role"):
        for part in attributes.get(name, "").split():
            words = [w.lower() for w in WORD.findall(part)]
            if words and words[0] in hints or any(b in hints and a not in NOT_ITSELF for a, b in pairwise(words)):
                return True
    return False


def read(text: str | None) -> Page:
    """The page of one html text; null and empty texts have no token."""
    text = text or ""
    tokens: list[int] = []
    blocks: list[Block] = []
    current: Block | None = None
    #: Open elements: name, hash of the path, without main text, inside a main element.
    path: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]
    #: Where the open elements of a name stand in the path.
    places: dict[str, list[int]] = {}

    def push(name: str, mark: int, aside: bool, main: int) -> None:
        places.setdefault(name, []).append(len(path))
        path.append((name, mark, aside, main))

    def pop() -> None:
        places[path.pop()[0]].pop()

    def close(names: set[str], scope: set[str] | frozenset = frozenset()) -> None:
        """Close the nearest open element of these names, unless an element of ``scope`` stands before it."""
        nearest = max([places[n][-1] for n in names if places.get(n)], default=0)
        if nearest and nearest > max([places[n][-1] for n in scope if places.get(n)], default=0):
            while len(path) > nearest:
                pop()

    def run(piece: str) -> None:
        nonlocal current
        if not piece:
            return
        _, mark, aside, main = path[-1]
        words = piece.split()
        if words:
            token = kind(signed(" ".join(words), mark), TEXT)
            tokens.append(token)
        if aside:
            return
        if current is None:
            current = Block(main)
            blocks.append(current)
        current.parts.append(piece)
        if words:
            current.tokens.append(token)

    at, size = 0, len(text)
    while at < size:
        start = text.find("<", at)
        found = TAG.match(text, start) if start >= 0 else None
        while start >= 0 and found is None:  # a sign that opens no tag is text
            start = text.find("<", start + 1)
            found = TAG.match(text, start) if start >= 0 else None
        if found is None:
            run(text[at:])
            break
        run(text[at:start])
        if found[0] == "<!--":
            end = text.find("-->", start + 2)  # <!--> is a whole comment
            at = size if end < 0 else end + 3
            continue
        at = found.end()
        if found[2] is None:
            continue
        name, ends = found[2].lower(), bool(found[1])
        if name == "br":
            if current is not None and not path[-1][2]:
                current.parts.append(" ")
            continue
        if name in BLOCK:
            current = None
        if ends:
            if places.get(name):
                own = path[places[name][-1]][1]
                close({name}, frozenset() if name in BLOCK else INLINE_SCOPE)
                tokens.append(end_of(own))
            else:
                tokens.append(kind(signed("/" + name, path[-1][1]), END))
            continue
        if places.get("p") and name in ENDS_PARAGRAPH:
            close({"p"}, SCOPES["p"])
        if name in SIBLINGS:
            close(SIBLINGS[name], SCOPES[name])
        attributes: dict[str, str] = {}
        for key, *values in ATTRIBUTE.findall(found[3]) if found[3] else ():
            attributes.setdefault(key.lower(), "".join(values))
        _, mark, aside, main = path[-1]
        teaser = name == "article" and attributes and hinted(attributes, NO_ARTICLE)
        if name in MAIN and aside and not teaser:
            # A main element opens no part of a menu: what stood open before it was never closed.
            if not any(places.get(n) for n in ("aside", "footer", "dialog", "noscript", "template")):
                while path[-1][2]:
                    pop()
                _, mark, aside, main = path[-1]
        main = max(main, MAIN.get(name, 0))
        own = kind(signed(name + "." + attributes.get("class", ""), mark), START)
        tokens.append(own)
        if name in VOID:
            continue
        out = aside
        if not out and name not in ("html", "body", "main"):
            heads = name == "header" and main  # the head of an article holds its heading
            out = name in ASIDE and not heads
            if attributes and not out:
                hints = NO_ARTICLE if name == "article" else IN_MAIN if main else HINTS
                out = "hidden" in attributes or attributes.get("aria-hidden") == "true" or hinted(attributes, hints)
        push(name, own, out, main)
        if name in RAW:
            end = RAW_END[name].search(text, at)
            at = end.start() if end else size
    return Page(tokens, blocks)
