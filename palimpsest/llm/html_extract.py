"""HTML extraction (operator 9): a tree-structured graphical model over the DOM.

A page becomes a tree of block elements whose leaves are runs of text.  Every node is content or
not; its own features give a potential, and each parent-child pair gives one by the kind of child.
Sum-product messages pass upward and downward once, which is exact on a tree, and a leaf is taken
if its marginal is at least one half.  Potentials are fitted by gradient ascent of the likelihood
on labelled pages; ``labelled_pages`` makes those by rule, with each kind of surrounding text the
contract names, ``TRAIN_PAGES`` of them (a documented bound, the same at every size).

Text.  Tags inside a block are dropped, ``<br>`` is white space, white space becomes one space,
character references are decoded, blocks are joined by one line end.  What stands for a script
(``noscript``) is an element like others, so blocks in it can be the article's; a line of its own is a notice.

Markup is read by the HTML rules for tags and attributes, broken or not, in time linear in the page.

Defined results: null or text-free html gives the empty text; a quote without its other half is part
of an unquoted value; an unclosed script or style and a tag without its end take the rest of the
page, other unclosed elements nothing; repeated pages are extracted row by row; other
columns are never read; an empty table gives none.  The work is one Arrow pass without a shuffle.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm.common import bound_batches, sliced, table

TRAIN_PAGES, TRAIN_ROUNDS = 240, 45

#: Elements whose text is never the page's.
_RAW = frozenset("script style template textarea title iframe".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in _RAW}
#: A whole well-formed tag; no part of it gives anything back, so it is read once.
_TAG = re.compile(
    r"""<(/?+)([a-zA-Z][^\s/>]*+)((?:\s++[^\s"'<>/=]++(?:\s*+=\s*+(?:"[^"<>]*+"|'[^'<>]*+'|[^\s"'=<>`]++))?+)*+)\s*+(/?+)>"""
)
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: An attribute by the rules for broken markup: a quote without its other half belongs to an unquoted value.
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_REST = re.compile(r"[\s/]*+")
_NAMING = frozenset(["class", "id", "role", "itemprop"])
_NAME = re.compile(r"[a-z]+")

#: Elements that are nodes; all other elements are part of the text around them.
_BLOCKS = frozenset(
    "html body main article section div header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption address details summary center menu dialog hgroup caption legend label button select datalist optgroup option noscript".split()
)
#: An opening tag of the first kind closes open ones of the second kind, up to the third.
_CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["optgroup", "option"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
_P_STAYS = frozenset("label button select datalist optgroup option".split())

#: Words of class, id and role names, by what they speak for.
_LEXICON = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs toolbar pagination pager skip".split(),
    "frame": "header masthead banner footer copyright colophon foot topbar site contentinfo".split(),
    "side": "sidebar side aside related widget widgets complementary rail more recommended trending popular".split(),
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promoted promotion banner affiliate".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe overlay paywall disclaimer".split(),
    "comment": "comment comments reply replies respond discussion disqus reviews reader guestbook".split(),
    "form": "form search login signup share social sharing follow".split(),
    "content": "article content main post entry story body text articlebody blog page prose".split(),
}
_KIND = {w: k for k, words in _LEXICON.items() for w in words}
_KIND_AT = {k: f"name:{k}" for k in _LEXICON}
_TAG_FEATURE = {t: f"tag:{t}" for t in _BLOCKS}
#: Elements that are known to hold an article, unless they are named otherwise.
_HOLDER = frozenset(["tag:article", "tag:main", "name:content"])
_NOT_HOLDER = frozenset(_KIND_AT.values()) - _HOLDER


def naming(attributes: str) -> str:
    """The values of the attributes that name a kind of element, joined by spaces."""
    found = []
    for m in _ATTRIBUTE.finditer(attributes):
        if m[1].lower() in _NAMING:
            found.append((m[2] or m[3] or m[4] or "").lower())
    return " ".join(found)


def tokens(source: str) -> Iterator[tuple[str, str, str, bool]]:
    """(kind, text or name, attributes, ends itself) of a page's pieces; kinds are text, open and close.

    Comments, declarations and raw elements are passed over.  Each character is read a fixed number
    of times, however broken the markup is: what has no end is looked for once.
    """
    at, n = 0, len(source)
    unended: set[str] = set()  # raw elements that no later closing tag ends
    while at < n:
        here = source.find("<", at)
        if here < 0:
            yield "text", source[at:], "", False
            return
        m = _TAG.match(source, here)
        if m:
            closes, name, attributes, ends, to = m[1], m[2].lower(), m[3], bool(m[4]), m.end()
        else:
            mark = source[here + 1 : here + 2]
            if mark == "!" or mark == "?" or (mark == "/" and not _TAG_NAME.match(source, here + 2) and here + 2 < n):
                if here > at:
                    yield "text", source[at:here], "", False
                if source.startswith("<!--", here):
                    end = source.find("-->", here + 2)
                    at = n if end < 0 else end + 3
                else:
                    end = source.find(">", here)
                    at = n if end < 0 else end + 1
                continue
            closes = "/" if mark == "/" else ""
            m = _TAG_NAME.match(source, here + 1 + len(closes))
            if not m:
                yield "text", source[at : here + 1], "", False
                at = here + 1
                continue
            name, to = m[0].lower(), m.end()
            while (a := _ATTRIBUTE.match(source, to)) is not None:
                to = a.end()
            attributes = source[m.end() : to]
            to = _REST.match(source, to).end()
            ends = source[to - 1 : to] == "/"
            to += 1  # the ">", or beyond the page's end: then the tag has none and is dropped
        if here > at:
            yield "text", source[at:here], "", False
        at = to
        if to > n:
            return
        if closes:
            yield "close", name, "", False
            continue
        if name in _RAW and not ends and name not in unended:
            end = _RAW_END[name].search(source, to)
            if end:
                at = source.find(">", end.end())
                at = n if at < 0 else at + 1
                continue
            unended.add(name)
            if name in ("script", "style"):
                return
        yield "open", name, attributes, ends


class Page:
    """The tree of a page in page order: parent, features and (for leaves) text of every node."""

    __slots__ = ("parent", "features", "text", "inside")

    def __init__(self, source: str) -> None:
        self.parent, self.features, self.text, self.inside = [-1], [["tag:root"]], [None], [None]
        stack: list[tuple[str, int]] = [("root", 0)]
        places: dict[str, list[int]] = {t: [] for t in _BLOCKS}  # of open elements in the stack, so that none is searched for
        pieces: list[str] = []
        linked = 0  # characters inside links
        links = 0  # open <a>

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    self._leaf(stack[-1], text, linked)
                pieces.clear()
                linked = 0

        def cut(k: int) -> None:
            for tag, _ in stack[k:]:
                places[tag].pop()
            del stack[k:]

        for kind, tag, attributes, ends in tokens(source):
            if kind == "text":
                piece = entities.unescape(tag) if "&" in tag else tag
                pieces.append(piece)
                if links:
                    linked += len(piece)
                continue
            if tag not in _BLOCKS:
                if tag == "br":
                    pieces.append("\n")
                elif tag == "hr":
                    flush()
                elif tag == "a":
                    links = max(0, links - 1) if kind == "close" else links + 1
                continue
            flush()
            if kind == "close":
                if places[tag]:
                    cut(places[tag][-1])
                links = 0 if len(stack) == 1 else links
                continue
            if stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and tag not in _P_STAYS:
                cut(len(stack) - 1)
                links = 0
            if tag in _CLOSES:
                inner, outer = (max((places[t][-1] for t in names if places[t]), default=0) for names in _CLOSES[tag])
                if inner > outer:
                    cut(inner)
            own = [_TAG_FEATURE[tag]]
            if attributes:
                own += [_KIND_AT[_KIND[w]] for w in _NAME.findall(naming(attributes)) if w in _KIND]
            self.parent.append(stack[-1][1])
            self.features.append(own)
            self.text.append(None)
            self.inside.append(attributes)
            if not ends:
                places[tag].append(len(stack))
                stack.append((tag, len(self.parent) - 1))
        flush()
        # where an element is known to hold the article, nodes tell whether they lie outside of all such elements
        holds = [any(f in _HOLDER for f in fs) and not any(f in _NOT_HOLDER for f in fs) for fs in self.features]
        held = any(holds)
        for v, (p, fs, text) in enumerate(zip(self.parent, self.features, self.text)):
            if v and holds[p]:
                holds[v] = True
            if not holds[v]:
                fs.append(("outside" if held else "bare") + (":leaf" if text is not None else ""))

    def _leaf(self, holder: tuple[str, int], text: str, linked: int) -> None:
        n = len(text)
        own = ["leaf", "leaf:" + holder[0], "size:" + str(min(n.bit_length(), 7)), "links:" + str(min(4, 5 * linked // max(n, 1)))]
        if text[-1] in ".!?…:;\"'”’»)":
            own.append("ends")
        if "©" in text:
            own.append("marks")
        self.parent.append(holder[1])
        self.features.append(own)
        self.text.append(text)
        self.inside.append(None)


class TreeModel:
    """Weights of node features and of parent-child pairs: pair[kind][parent state][child state]."""

    def __init__(self) -> None:
        self.weight: dict[str, float] = {}
        self.pair = {k: [[0.5, -0.5], [-0.5, 0.5]] for k in ("leaf", "element")}

    def marginals(self, page: Page, pairs: bool = False):
        """P(content) of every node; with ``pairs`` also P(parent, child) of each edge as [p][c]."""
        n, parent, get = len(page.parent), page.parent, self.weight.get
        own = [sum([get(f, 0.0) for f in fs]) for fs in page.features]
        tables = {k: [[math.exp(x) for x in row] for row in t] for k, t in self.pair.items()}
        edge = [tables["leaf"] if t is not None else tables["element"] for t in page.text]
        below = own[:]  # own potential and the messages from all children, as log odds
        up = [0.0] * n
        for v in range(n - 1, 0, -1):
            (a, b), (c, d) = edge[v]
            e = math.exp(max(-30.0, min(30.0, below[v])))
            up[v] = math.log((c + d * e) / (a + b * e))
            below[parent[v]] += up[v]
        total, joint = below[:], []
        for v in range(1, n):
            p = parent[v]
            rest = total[p] - up[v]  # all that the parent knows but from this child
            (a, b), (c, d) = edge[v]
            e = math.exp(max(-30.0, min(30.0, rest)))
            total[v] = below[v] + math.log((b + d * e) / (a + c * e))
            if pairs:
                f = math.exp(max(-30.0, min(30.0, below[v])))
                z = a + b * f + c * e + d * e * f
                joint.append((v, ((a / z, b * f / z), (c * e / z, d * e * f / z))))
        probability = [1 / (1 + math.exp(-max(-30.0, min(30.0, x)))) for x in total]
        return (probability, joint) if pairs else probability

    def fit(self, pages: list[tuple[Page, list[int]]], rounds: int, rate: float = 0.6, decay: float = 0.002) -> None:
        """Gradient ascent: observed less expected counts of features and pairs, with weight decay."""
        size = sum(len(labels) for _, labels in pages)
        seen: dict[str, int] = {}
        for page, _ in pages:
            for fs in page.features:
                for f in fs:
                    seen[f] = seen.get(f, 0) + 1
        for _ in range(rounds):
            step: dict[str, float] = {}
            pair_step = {k: [[0.0, 0.0], [0.0, 0.0]] for k in self.pair}
            for page, labels in pages:
                p, joint = self.marginals(page, pairs=True)
                for fs, y, q in zip(page.features, labels, p):
                    for f in fs:
                        step[f] = step.get(f, 0.0) + y - q
                for v, j in joint:
                    t = pair_step["leaf" if page.text[v] is not None else "element"]
                    t[labels[page.parent[v]]][labels[v]] += 1
                    for a in (0, 1):
                        for b in (0, 1):
                            t[a][b] -= j[a][b]
            for f, g in step.items():
                self.weight[f] = (1 - decay) * self.weight.get(f, 0.0) + rate * 4 * g / (seen[f] + 10)
            for k, t in pair_step.items():
                for a in (0, 1):
                    for b in (0, 1):
                        self.pair[k][a][b] += rate * 8 * t[a][b] / size


def labelled_pages(n: int, seed: int = 5) -> list[tuple[Page, list[int]]]:
    """Pages made by rule with a label for every node: 1 for the article and what is in it but no surrounding text."""
    r = random.Random(seed)
    syllables = "an er in on re th ou st en ed ion ing ti qu el au sch ber ga do ra mi lo".split()

    def words(low: int, high: int, end: str = "") -> str:
        return " ".join("".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(low, high))).capitalize() + end

    def sentences(low: int, high: int) -> str:
        """Text of any style, so that the model learns to go by structure."""
        how = r.random()
        if how < 0.12:
            return " | ".join(words(1, 1) for _ in range(r.randint(2, 24)))
        if how < 0.2:
            return words(4, 40).upper().replace(" ", "!! ")
        if how < 0.28:
            return words(4, 40).replace(" ", r.choice(["### ", "$$$ ", "*** "]))
        if how < 0.34:
            return words(1, 30)
        return " ".join(words(3, 18, r.choice("....?!")) for _ in range(r.randint(low, high)))

    def name(kind: str) -> str:
        how = r.random()
        return "" if how < 0.25 else f' {r.choice(["class", "id"])}="{r.choice(_LEXICON[kind])}"'

    def links(k: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(k)) + "</ul>"

    apart_ = random.Random(seed + 1)  # for controls and the shape of the page
    own_ = random.Random(seed + 2)  # for links within articles, and what stands for a script

    def controls(often: float) -> str:
        """A list to choose from or a button, judged as what is around it."""
        if apart_.random() >= often:
            return ""
        word = lambda: "".join(apart_.choices(syllables, k=apart_.randint(1, 4)))
        if apart_.random() < 0.5:
            return f"<button>{word()} {word()}</button>"
        return "<select>" + "".join(f"<option>{word()}" for _ in range(apart_.randint(1, 6))) + "</select>"

    def more(low: int, high: int) -> str:
        return " ".join("".join(own_.choices(syllables, k=own_.randint(1, 4))) for _ in range(own_.randint(low, high))).capitalize()

    def linked(k: int) -> str:
        """A list of links that says something, as an article has it, at times with one in it."""
        tag = own_.choice(["ul", "ul", "ol"])
        inner = [f'<li><a href="/{i}">{more(1, 6)}</a>{linked(own_.randint(1, 2)) if own_.random() < 0.12 else ""}</li>' for i in range(k)]
        return f"<{tag}>{''.join(inner)}</{tag}>"

    mark = ' data-label="1"'

    def article() -> str:
        parts = [f"<h1>{words(2, 12)}{r.choice(['', '.', ''])}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.randint(0, 12)):
            how = r.random()
            if how < 0.55:
                parts.append(f"<p>{sentences(*r.choice([(1, 6), (1, 6), (10, 40)]))}</p>")
            elif how < 0.65:
                parts.append(f"<p><b>{sentences(1, 4)}<br>")
            elif how < 0.72:
                parts.append(f"<p>{words(1, 3)}.</p>")
            elif how < 0.77:
                parts.append(f"<h2>{words(1, 6)}</h2>")
            elif how < 0.82:
                parts.append("<ul>" + "".join(f"<li>{words(2, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif how < 0.86:
                parts.append(f"<blockquote><p>{sentences(1, 3)}</p></blockquote>")
            elif how < 0.9:
                parts.append(f'<p>{words(3, 9)} <a href="/x">{words(1, 3)}</a> {words(2, 8)}.</p>')
            elif how < 0.93:
                parts.append("<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 4)}</td></tr>" for _ in range(3)) + "</table>")
            elif how < 0.95:
                parts.append(f'<div data-label="0" class="{r.choice(_LEXICON[r.choice(["advert", "notice", "side"])])}">{sentences(1, 2)}</div>')
            elif how < 0.975:
                parts.append(f'<aside data-label="0"{name("side")}>{sentences(1, 2)}{links(2)}</aside>')
            else:
                parts.append(f'<form data-label="0"{name("form")}><p>{sentences(1, 1)}</p>{controls(0.6)}</form>')
        if r.random() < 0.3:
            inner = "".join(f'<div class="comment"><p>{sentences(1, 2)}</p></div>' for _ in range(r.randint(1, 4)))
            parts.append(f'<{r.choice(["section", "div"])} data-label="0" class="{r.choice(["comments", "comment", "replies", "discussion"])}"><h3>{words(1, 2)}</h3>{inner or sentences(1, 2)}</section>')
        # an article holds link lists, linked paragraphs and what stands for a script too
        bare_line, block = (lambda: f'<noscript data-label="0">{more(2, 9)}.</noscript>'), (lambda: f"<noscript><p>{more(3, 14)}.</p></noscript>")
        for often, made in ((0.3, lambda: linked(own_.randint(1, 8))), (0.25, lambda: f'<p><a href="/y">{more(2, 9)}</a></p>'), (0.12, block), (0.12, bare_line)):
            if own_.random() < often:
                parts.insert(own_.randint(0, len(parts)), made())
        body = "".join(parts) + controls(0.15)
        return r.choice([f"<article{mark}>{body}</article>", f"<article{mark}>{body}</article>", f"<main><article{mark}>{body}</article></main>", f'<div{mark} class="{r.choice(_LEXICON["content"])}">{body}</div>', f"<main{mark}>{body}</main>"])

    def around(kind: str) -> str:
        if kind == "menu":
            return f"<nav{name('menu')}>{links(r.randint(2, 8))}</nav>" if r.random() < 0.7 else f'<div class="{r.choice(_LEXICON["menu"])}">{links(r.randint(2, 8))}</div>'
        if kind == "frame":
            return f"<header{name('frame')}><h1>{words(1, 4)}</h1><p>{words(2, 8)}</p></header>"
        if kind == "foot":
            inner = r.choice([f"&copy; {words(1, 2)} &middot; {words(2, 14, '.')}", f"<p>{words(3, 12, '.')}</p>{links(3)}"])
            return f"<footer{name('frame')}>{inner}</footer>" if r.random() < 0.8 else f'<div class="footer">{inner}</div>'
        if kind == "side":
            return f"<aside{name('side')}><h3>{words(1, 3)}</h3>{links(3)}<p>{words(4, 15, '.')}</p></aside>" if r.random() < 0.6 else f'<div class="{r.choice(_LEXICON["side"])}"><p>{sentences(1, 3)}</p>{links(2)}</div>'
        if kind == "advert":
            return f'<div class="{r.choice(_LEXICON["advert"])}">{r.choice(["", "<p>"])}{sentences(1, 2)}</div>'
        if kind == "notice":
            return f'<div class="{r.choice(_LEXICON["notice"])}"><p>{sentences(1, 3)}</p></div>'
        if kind == "form":
            return f"<form{name('form')}><label>{words(1, 3)}</label><p>{words(2, 10, '.')}</p>{controls(0.6)}</form>"
        plain = r.random() < 0.4
        inner = "".join(f"<p>{sentences(1, 3)}</p>" if plain else f'<div class="{r.choice(["comment", "reply"])}"><p>{sentences(1, 3)}</p></div>' for _ in range(r.randint(1, 5)))
        tag = r.choice(["section", "div"])
        return f'<{tag} {r.choice(["class", "id"])}="{r.choice(["comments", "comment-list", "replies", "discussion"])}"><h{(h := r.randint(2, 4))}>{words(1, 3)}</h{h}>{inner}</{tag}>'

    out = []
    for _ in range(n):
        before = [k for k in ("menu", "frame", "notice", "advert") if r.random() < 0.6]
        after = [k for k in ("side", "comment", "form", "advert", "foot") if r.random() < 0.6]
        r.shuffle(before)
        main = article()
        bare = r.random() < 0.3  # the body itself holds the article's blocks
        if bare:
            main = re.sub(r"^(<main>)?<[^>]*>|</(article|main|div)>(</main>)?$", "", main)
        body = f"<body{mark}>" if bare else "<body>"
        apart = [re.sub(r"^<\w+", r'\g<0> data-label="0"', around(k)) for k in before], [re.sub(r"^<\w+", r'\g<0> data-label="0"', around(k)) for k in after]
        loose = bare and r.random() < 0.5  # not even a body
        if not bare and apart_.random() < 0.4:  # text beside the article that names nothing
            beside = f'<{(tag := apart_.choice(["div", "section", "p"]))} data-label="0">{sentences(1, 2)}</{tag}>'
            main = apart_.choice([main + beside, beside + main])
        if own_.random() < 0.12:  # what stands for a script, outside the article
            said = f'<noscript data-label="0">{own_.choice(["", "<p>", "<div>"])}{more(3, 12)}.</noscript>'
            main = own_.choice([said + main, main + said])
        if apart_.random() < 0.2:  # a page of a few paragraphs and no more
            begin, end = apart_.choice([("<p>", "</p>"), ("<p>", ""), ("<div>", "</div>"), ("", "<hr>")])
            main = "".join(f"{begin}{sentences(1, 3)}{end}" for _ in range(apart_.randint(1, 3)))
            bare, apart, body = True, ([], []), f"<body{mark}>"
            loose = apart_.random() < 0.5
        if own_.random() < 0.1:  # a page of one short text
            begin, end = own_.choice([("<p>", "</p>"), ("<div>", "</div>"), ("<div><p>", "</p></div>"), ("", "")])
            main, bare, apart, body, loose = f"{begin}{more(1, 12)}{own_.choice(['.', '.', ''])}{end}", True, ([], []), f"<body{mark}>", own_.random() < 0.6
        whole = "".join(apart[0]) + main + "".join(apart[1])
        for _ in range(apart_.choice([0, 0, 1, 2])):  # elements that hold all of the page and name nothing
            whole = f"<div>{whole}</div>"
        page = Page(whole if loose else "<html>" + body + whole + r.choice(["</body></html>", ""]))
        labels: list[int] = []
        for v, p in enumerate(page.parent):
            told = page.inside[v] or ""
            labels.append(1 if 'data-label="1"' in told else 0 if 'data-label="0"' in told else int(bare) if v == 0 else labels[p])
        out.append((page, labels))
    return out


@lru_cache(maxsize=1)
def trained_model() -> TreeModel:
    model = TreeModel()
    model.fit(labelled_pages(TRAIN_PAGES), TRAIN_ROUNDS)
    return model


def main_text(source: str | None, model: TreeModel) -> str:
    if not source:
        return ""
    page = Page(source)
    p = model.marginals(page)
    return "\n".join(t for t, q in zip(page.text, p) if t is not None and q >= 0.5)


def extract_main_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    bound_batches(pages.sparkSession, 1000)
    model = model or trained_model()  # a few hundred weights, sent with the tasks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            texts = [main_text(h, model) for h in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
