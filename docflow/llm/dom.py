"""Pages as trees of styled elements, small enough to be made anew wherever they are needed.

The reader takes broken markup as it comes: paragraphs, list items and cells end where
the next one starts, unknown end tags are passed over, and what is never closed ends with
its parent. Block elements are nodes; inline elements are part of their block's text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import xxhash

# Element and style names of the HTML vocabulary and of common templates.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of an article: scripts, styles, what forms hold, and embedded objects.
SILENT = frozenset(
    "applet audio button canvas datalist head iframe math meter noframes noscript object optgroup option output progress script select style svg "
    "template textarea title video".split()
)
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
NOISE_TAGS = frozenset("aside dialog fieldset footer form menu nav search".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation note search status toolbar".split())
NOISE_NAMES = frozenset(
    "ad ads adbox adslot adunit adsense advert adverts advertisement advertising advertisements sponsor sponsored sponsors promo promos promotion "
    "banner banners teaser outbrain taboola sidebar sidebars rail widget widgets menu menus nav navbar navigation navi breadcrumb breadcrumbs "
    "crumbs pagination pager toolbar footer foot colophon copyright legal disclaimer cookie cookies consent gdpr notice notices notification "
    "notifications alert popup modal overlay newsletter subscribe subscription signup login signin share sharing social related recommended "
    "recommendations comment comments commentlist disqus reply replies respond discussion search form skip tags".split()
)
#: Headers of the page; inside the article a header holds its title.
HEADER_NAMES = frozenset("header head masthead topbar hero logo branding".split())
#: What makes an article or main element no content.
NOT_CONTENT = frozenset("ad ads advert advertisement sponsored promo teaser related recommended comment comments reply widget".split())
#: Names that stay noise even around an article element: readers' and other articles.
FIRM_NAMES = frozenset(
    "comment comments commentlist disqus reply replies respond discussion related recommended recommendations teaser promo promos sponsored outbrain taboola".split()
)
#: A name after one of these says what a layout has or lacks, not what the element is.
LAYOUT_WORDS = frozenset("has no non with without hide hides".split())
CONTENT_NAMES = frozenset("article post entry story content main text body".split())

#: What a start tag ends, and what stops the search for it.
_ENDS = {
    **{t: ({"p"}, {"td", "th", "table", "li", "article", "section", "div", "body"}) for t in BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir", "table", "body"}),
    "dt": ({"dt", "dd", "p"}, {"dl", "table", "body"}),
    "dd": ({"dt", "dd", "p"}, {"dl", "table", "body"}),
    "td": ({"td", "th", "p"}, {"tr", "table", "body"}),
    "th": ({"td", "th", "p"}, {"tr", "table", "body"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot", "body"}),
    **{t: ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table", "body"}) for t in ("tbody", "thead", "tfoot")},
}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements deeper than this have no node of their own: their text counts as their ancestor's there.
DEEPEST = 12

NOISE, SOFT, ARTICLE, MAIN, NAMED, NEUTRAL = "noise", "noise unless an article stands inside", 1, 2, 3, 9


def style_of(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    """What makes two elements the same presentation: tag, class, id and role (digits aside)."""
    held = [(k, v) for k, v in attrs if k in ("class", "id", "role") and v]
    return tag + "".join(f" {k}={re.sub('[0-9]+', '0', ' '.join(v.split()))}" for k, v in held)


def kind_of(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> object:
    """What the style's name says: ``NOISE`` (or ``SOFT``, for names that layouts also give
    to what holds the article), a container of the article (by rank) or ``NEUTRAL``.
    ``inside``: within such a container."""
    held = {k: v or "" for k, v in attrs}
    role = held.get("role", "").strip().lower()
    words = [w.lower() for w in _WORDS.findall(f"{held.get('class', '')} {held.get('id', '')}")]
    names = {w for w, before in zip(words, ["", *words], strict=False) if before not in LAYOUT_WORDS}
    if tag in ("article", "main") or role in ("article", "main"):
        return NOISE if names & NOT_CONTENT else ARTICLE if "article" in (tag, role) else MAIN
    if tag in ("html", "body"):
        return NEUTRAL
    if (tag in NOISE_TAGS and tag != "form") or names & FIRM_NAMES:
        return NOISE
    if tag == "form" or role in NOISE_ROLES or names & NOISE_NAMES:
        return SOFT
    if not inside and (tag == "header" or names & HEADER_NAMES):
        return SOFT
    if held.get("itemprop", "").lower() == "articlebody":
        return MAIN
    if tag in ("div", "section", "td") and names & CONTENT_NAMES:
        return NAMED
    return NEUTRAL


class Page(HTMLParser):
    """A page's elements and its blocks of text.

    ``parent``, ``style``, ``children`` (element numbers; ``None`` for own text), ``noise``,
    ``rank`` (best container around or at it) and ``below`` (is it styled below its
    container) of element i; ``blocks``: ``(element, text)``, white space collapsed."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.style, self.children, self.noise, self.rank, self.named = [-1], ["body"], [[]], [False], [NEUTRAL], [False]
        self._kinds: list[object] = [NEUTRAL]
        self.blocks: list[tuple[int, str]] = []
        self._open: list[tuple[str, int]] = [("body", 0)]  # inline noise has the number of its block
        self._text: list[str] = []
        self._silent: list[str] = []
        self._inner = 0  # open blocks inside a silent element
        self._hushed = 0  # open inline elements that are noise
        self.feed(html)
        self.close()
        self._flush()
        if SOFT in self._kinds:
            self._relent()

    def _relent(self) -> None:
        """Soft noise around an article or main element that is itself no noise is a layout's
        wrapper: its text counts as any other's."""
        holds = [False] * len(self.parent)
        for i in range(len(holds) - 1, 0, -1):
            kind = self._kinds[i]
            if kind is not NOISE and (holds[i] or kind in (ARTICLE, MAIN)):
                holds[self.parent[i]] = True
        for i in range(1, len(holds)):
            up, kind = self.parent[i], self._kinds[i]
            own = kind is NOISE or (kind is SOFT and not holds[i])
            self.noise[i] = self.noise[up] or own
            self.rank[i] = self.rank[up] if kind in (NOISE, SOFT) else min(self.rank[up], kind)

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join("".join(self._text).split())
        self._text = []
        if text:
            at = self._open[-1][1]
            self.blocks.append((at, text))
            self.children[at].append(None)

    def _pop(self, to: int) -> None:
        """Closes open elements until ``to`` are left."""
        while len(self._open) > to:
            tag, _ = self._open[-1]
            if tag in BLOCKS:
                self._flush()
            else:
                self._hushed -= 1
            self._open.pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._silent == ["head"] and tag not in HEAD:
            self._silent = []  # a head that is never closed ends where the body starts
        if self._silent:
            if tag == self._silent[-1] and tag not in VOID:
                self._silent.append(tag)
            self._inner += tag in BLOCKS
            return
        if tag in ("br", "wbr", "img"):
            self._text.append(" " if tag == "br" else "")
        elif tag == "hr":
            self._flush()
        elif tag in VOID or tag in ("html", "body"):
            pass
        elif tag in SILENT:
            self._silent, self._inner = [tag], 0
        elif tag not in BLOCKS:
            if kind_of(tag, attrs, self.rank[self._open[-1][1]] != NEUTRAL) in (NOISE, SOFT):
                self._hushed += 1
                self._open.append((tag, self._open[-1][1]))
        else:
            self._block(tag, attrs)

    def _block(self, tag: str, attrs: list) -> None:
        ends, stops = _ENDS[tag]
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] in ends:
                self._pop(at)
            elif self._open[at][0] in stops:
                break
        self._flush()
        up = self._open[-1][1]
        kind = kind_of(tag, attrs, self.rank[up] != NEUTRAL)
        number = len(self.parent)
        self.children[up].append(number)
        self.parent.append(up)
        self.style.append(style_of(tag, attrs))
        self.children.append([])
        if self._hushed:
            kind = NOISE
        noise = kind in (NOISE, SOFT)
        self._kinds.append(kind)
        self.noise.append(self.noise[up] or noise)
        self.rank.append(self.rank[up] if noise else min(self.rank[up], kind))
        self.named.append(" " in self.style[-1] and kind == NEUTRAL)
        self._open.append((tag, number))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag not in ("svg", "math"):
            self.handle_starttag(tag, attrs)  # <div/> opens a div, as in browsers

    def handle_endtag(self, tag: str) -> None:
        if self._silent:
            if tag == self._silent[-1]:
                self._silent.pop()
                return
            if tag not in BLOCKS or self._inner:
                self._inner -= tag in BLOCKS
                return
            self._silent = []  # never closed: ends with the block around it
        if tag in ("html", "body") or tag in VOID:
            return
        if tag not in BLOCKS and not self._hushed:
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] == tag:
                self._pop(at)
                return
        if tag == "p":
            self._flush()

    def handle_data(self, data: str) -> None:
        if not self._silent and not self._hushed:
            self._text.append(data)

    def keys(self, site: int) -> tuple[list[int], list[tuple[int, int, int]], list[tuple[int, int, int]], list[int]]:
        """This page's part of its site's style tree: the node of every element; the
        nodes ``(node, style node above, level)`` with the texts' own; the style nodes
        ``(style node, node above, children)``; the node of every block's text.

        A node is a place in the sequence of its parent's children; runs of equal styles
        are one place."""
        node, level = [0] * len(self.parent), [0] * len(self.parent)
        node[0] = xxhash.xxh64_intdigest(b"body", seed=site)
        nodes, styles = [(node[0], 0, 0)], []
        places: list[list[int]] = [[] for _ in self.parent]  # of each element's own texts
        for i, children in enumerate(self.children):
            deep = level[i] >= DEEPEST
            names = ["#text" if c is None else self.style[c] for c in children]
            runs = ["#text"] if deep else [n for n, before in zip(names, [None, *names], strict=False) if n != before]
            here = xxhash.xxh64_intdigest("\n".join(runs), seed=node[i])
            styles.append((here, node[i], len(runs)))
            place, before = -1, None
            for c, name in zip(children, names, strict=True):
                place += name != before
                before = name
                if c is not None and deep:
                    node[c], level[c] = node[i], level[i]
                    continue
                at = xxhash.xxh64_intdigest("0 #text" if deep else f"{place} {name}", seed=here)
                nodes.append((at, here, level[i] + 1))
                if c is None:
                    places[i].append(at)
                else:
                    node[c], level[c] = at, level[i] + 1
        in_order = [iter(p) for p in places]
        return node, nodes, styles, [next(in_order[i]) for i, _ in self.blocks]

    def main_text(self, node: list[int] | None = None, low: frozenset | set = frozenset()) -> str:
        """The article: blocks of no noise, of the best container if there is one, outside
        the branches whose nodes are in ``low``. Inside a container only branches with a
        style of their own go by ``low``; a page doesn't lose its whole text by it."""
        kept = [(i, text) for i, text in self.blocks if not self.noise[i]]
        best = min((self.rank[i] for i, _ in kept), default=NEUTRAL)
        kept = [(i, text) for i, text in kept if self.rank[i] == best]
        if low and node:
            cut = [False] * len(self.parent)
            for i in range(1, len(cut)):
                judged = self.named[i] if best != NEUTRAL else True
                cut[i] = cut[self.parent[i]] or (judged and node[i] in low and self.rank[i] == best)
            kept = [(i, text) for i, text in kept if not cut[i]] or kept
        return "\n\n".join(text for _, text in kept)
