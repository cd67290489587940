"""Main text of web pages by inference on the tree of the page.

The page becomes a tree of elements. Each node is content or boilerplate;
node potentials score what the node itself shows (its tag, the words of its id
and class, how much text, sentences and links it holds, what it begins with), and
parent-child potentials say how likely a child shares its parent's label, for
children of the page itself, of other blocks, and for inline elements.
Sum-product messages run up the tree and down again and give every node its
marginal of being content. Weights and potentials are trained on labelled
pages: node features and pairs seen less those expected, by gradient ascent in
numpy. The labelled pages are made by rule from a small grammar of page layouts
below; no page of the input is used in training.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of the HTML standard: elements without content, with raw text, that end an open paragraph, of the head, of tables.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCK = CLOSES_P | frozenset("body html li dd dt td th tr tbody thead tfoot caption option legend summary".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
NEVER = frozenset("script style noscript template head title svg iframe object canvas audio video select option textarea button input datalist".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
IN_TABLE = frozenset("table caption tbody thead tfoot tr td th".split())
#: Start tags that end open elements, and the elements beyond which they do not reach.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
BARS = ("table", "td", "th", "caption", "object", "template")

SPACE = re.compile(r"\s+")
WORDY = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
COMMENT_END = re.compile(r"--!?>")
TAG_NAME = re.compile(r"[^\s/>]+")
SKIPPED = re.compile(r"[\s/]*")
ATTRIBUTE = re.compile(r"=?[^\s/>=]*")
BLANK = re.compile(r"\s*")
UNQUOTED = re.compile(r"[^\s>]*")


class Node:
    __slots__ = ("tag", "names", "parent", "kids", "chars", "links", "stops", "own", "lead", "deep", "headed", "told")

    def __init__(self, tag: str, names: str, parent: Node | None):
        self.tag, self.names, self.parent = tag, names, parent
        self.kids: list[Node | str] = []
        self.chars = self.links = self.stops = self.own = 0
        self.lead, self.deep, self.headed, self.told = "", 0, False, False


def tag_rest(source: str, at: int) -> tuple[int, str, bool]:
    """Behind a tag's name: (place after its ``>``, words of id, class, role and itemprop, whether it closes itself).

    Quotes are followed as the standard says, so an unclosed one reaches to the
    next quote; a tag that the page ends in is none, with place -1.
    """
    names: list[str] = []
    while True:
        skipped = SKIPPED.match(source, at)
        at = skipped.end()
        if at >= len(source):
            return -1, "", False
        if source[at] == ">":
            return at + 1, " ".join(names), skipped[0].endswith("/")
        name = ATTRIBUTE.match(source, at)
        at = BLANK.match(source, name.end()).end()
        if source[at : at + 1] != "=":
            continue
        at = BLANK.match(source, at + 1).end()
        quote = source[at : at + 1]
        if quote in ('"', "'"):
            end = source.find(quote, at + 1)
            if end < 0:
                return -1, "", False
            value, at = (at + 1, end), end + 1
        else:
            end = UNQUOTED.match(source, at).end()
            value, at = (at, end), end
        if name[0].lower() in ("id", "class", "role", "itemprop"):
            names.append(source[value[0] : value[1]])


def parse(source: str) -> Node:
    """A tree of the page, by the usual rules for tags that are left out or unclosed, in one pass.

    ``stack`` holds the open elements and ``where`` the places of each tag
    on it, so no rule has to walk up the tree. What stands outside of a body
    belongs to the root or the html element, which count as the page's body.
    """
    root = Node("#root", "", None)
    stack, where = [root], {}
    solid = [0]  # places of open elements that are no inline ones
    at, lower, n = 0, None, len(source)

    def last(tags) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def close(place: int) -> None:
        while len(stack) > place:
            where[stack.pop().tag].pop()
        while solid[-1] >= place:
            solid.pop()

    def add(tag: str, names: str = "") -> Node:
        node = Node(tag, names, stack[-1])
        stack[-1].kids.append(node)
        return node

    def text(piece: str) -> None:
        if stack[-1].tag == "head" and piece.strip():
            close(len(stack) - 1)
        stack[-1].kids.append(piece)

    while at < n:
        mark = source.find("<", at)
        if mark < 0:
            break
        kind = source[mark + 1 : mark + 2]
        closing = kind == "/"
        letter = source[mark + 2 : mark + 3] if closing else kind
        if not ("a" <= letter <= "z" or "A" <= letter <= "Z"):
            if closing and not letter or kind not in ("/", "!", "?") or not kind:
                text(html.unescape(source[at : mark + 1]))
                at = mark + 1
                continue
            if mark > at:
                text(html.unescape(source[at:mark]))
            if source.startswith("<!--", mark):
                if source.startswith((">", "->"), mark + 4):
                    at = source.index(">", mark + 4) + 1
                else:
                    end = COMMENT_END.search(source, mark + 4)
                    at = end.end() if end else n
            else:
                end = source.find(">", mark + 1)
                at = end + 1 if end >= 0 else n
            continue
        if mark > at:
            text(html.unescape(source[at:mark]))
        name = TAG_NAME.match(source, mark + 1 + closing)
        tag = name[0].lower()
        at, names, alone = tag_rest(source, name.end())
        if at < 0:
            return root
        if closing:
            places = where.get(tag)
            if tag in ("body", "html"):
                continue
            if places and places[-1] > (solid[-1] if tag not in BLOCK else last(("table",)) - 1 if tag in IN_TABLE else last(BARS)):
                close(places[-1])
            elif tag in ("p", "br"):
                add(tag)
            continue
        if tag in ("html", "body", "head") and where.get(tag):
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD or tag == "body" and where.get("head"):
            close(where["head"][-1])
        if tag in CLOSES_P:
            up = stack[solid[-1]].tag
            if up == "p" or up in HEADINGS and tag in HEADINGS:
                close(solid[-1])
        elif tag in ENDS:
            ended, bars = ENDS[tag]
            bar = last(bars)
            open_ones = [where[t][-1] for t in ended if where.get(t) and where[t][-1] > bar]
            if open_ones:
                close(min(open_ones))
        node = add(tag, names)
        if tag in RAW:
            if lower is None:
                lower = source.lower()
                lower = lower if len(lower) == n else re.sub("[A-Z]", lambda c: c[0].lower(), source)
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)").search(lower, at)
            node.kids.append(source[at : end.start() if end else n])
            close_at = source.find(">", end.start()) if end else -1
            at = close_at + 1 if close_at >= 0 else n
        elif tag not in VOID and (tag in BLOCK or not alone):
            where.setdefault(tag, []).append(len(stack))
            if tag in BLOCK:
                solid.append(len(stack))
            stack.append(node)
    if at < n:
        text(html.unescape(source[at:]))
    return root


# Features of a node. Words in names of menus, notices and the like, and of articles, and what such boxes begin with: fixed values.
AWAY = frozenset("nav navigation navbar menu menubar header head footer foot sidebar side aside ad ads advert adverts advertisement sponsor sponsored promo promotion banner comment comments reply replies disqus cookie cookies consent notice popup modal overlay newsletter subscribe signup share sharing social related recommended breadcrumb breadcrumbs pagination pager widget form login search toolbar masthead copyright legal alert site page box bar slot list links".split())
TELLING = AWAY - frozenset("site page box bar slot list links head side page".split())
TOWARDS = frozenset("article content main post entry story body text articlebody prose".split())
#: Whole lines that head such boxes, in English, German, French and Spanish; a sentence that goes on is none of them.
SAYS = re.compile(
    r"(?:(?:\d+ )?(?:comments?|replies|responses|reader comments)(?: \(?\d+\)?)?|leave a (?:comment|reply)|join the discussion|related(?: (?:articles?|posts?|stories|news|links|content|topics|reading))?|read (?:more|next|also)|"
    r"more (?:from|on|stories|articles|news)(?: \w+){0,2}|(?:share|tweet)(?: (?:this|on|via)(?: \w+){0,2})?|follow us(?: on \w+)?|subscribe(?: to (?:us|our \w+))?|sign (?:up|in)(?: (?:for|to) (?:our |the )?\w+)?|log in|newsletter|"
    r"advertisement|advertorial|sponsored(?: content| links)?|you (?:may|might) also like|recommended(?: for you)?|(?:most )?popular(?: \w+)?|trending(?: now)?|(?:we use |about )?cookies(?: policy| settings| notice)?|"
    r"(?:tags|categories|archives?|menu|navigation|search|contents)|what our readers (?:say|think)|"
    r"(?:\d+ )?(?:kommentare?|leserkommentare|antworten|commentaires?|réponses|comentarios?|respuestas)(?: \(?\d+\)?)?|kommentar schreiben|laisser un commentaire|deja un comentario|"
    r"anzeige|werbung|publicité|publicidad|teilen|partager|compartir|mehr zum thema|à lire aussi|lire aussi|te puede interesar|das könnte sie auch interessieren|sur le même sujet)[.!:…]?"
)
GROUPS = (
    "article main", "section", "div center", "nav menu", "header hgroup", "footer", "aside", "form fieldset dialog", "h1 h2 h3 h4 h5 h6", "p blockquote pre", "ul ol dl dir", "li dt dd",
    "table tbody thead tfoot tr td th caption", "figure figcaption details summary", "address", "a", "html body #root",
)
GROUP = {tag: k for k, tags in enumerate(GROUPS) for tag in tags.split()}
OTHER = len(GROUPS)
TOP = frozenset("html body #root".split())
FEATURES = OTHER + 1 + 18


def named(names: str) -> tuple[int, int, int]:
    """Whether all words of a node's names are those of boilerplate, the last one is, and some are those of articles."""
    words = [w.lower() for w in WORDY.findall(names)]
    away = [w in AWAY for w in words]
    telling = any(w in TELLING for w in words)
    every = bool(words) and all(away) and telling
    return int(every), int(not every and telling), int(not every and any(w in TOWARDS for w in words))


class Known(dict):
    """What ``named`` says of the names met so far; a few thousand at a time. (A cache of the standard library would not travel to executors.)"""

    def __missing__(self, names: str) -> tuple[int, int, int]:
        if len(self) >= 4096:
            self.clear()
        out = self[names] = named(names)
        return out


KNOWN = Known()


def features(nodes: list[Node]) -> np.ndarray:
    """A row for each node; the first column is constant, the next ones its tag's group."""
    x = np.zeros((len(nodes), FEATURES), np.float32)
    x[:, 0] = 1
    rows = []
    for n in nodes:
        chars, links = n.chars, n.links
        every, some, towards = KNOWN[n.names] if n.names else (0, 0, 0)
        share = links / chars if chars else 0.0
        group = GROUP.get(n.tag, OTHER)
        says = bool(n.lead) and SAYS.fullmatch(n.lead) is not None
        # a box that such a line heads right there, or that is all boilerplate by its names or element, tells what is inside of it, however deep
        n.headed = says and group != 8 and n.deep < 2 and chars > len(n.lead) + 1 or every == 1 or group in (3, 5)
        n.told = n.parent is not None and n.parent.tag not in TOP and (n.parent.told or n.parent.headed)
        rows.append(
            (
                group, every, some, towards, n.tag in NEVER, share, share if group in (10, 11) else 0.0, min(chars, 400) / 400, min(n.stops, 5) / 5, min(n.own, 200) / 200, chars == 0,
                n.own >= 40 and n.stops > 0 and 2 * links < chars, says and group != 8, says and group == 8, n.told, n.tag == "h1", n.lead[:1] == "\xa9",
                n.own / chars if chars else 0.0, n.own / chars if chars and group == 16 else 0.0,
            )
        )
    if rows:
        values = np.array(rows, np.float32)
        x[np.arange(len(rows)), np.minimum(values[:, 0].astype(int) + 1, OTHER)] = values[:, 0] < OTHER
        x[:, OTHER + 1 :] = values[:, 1:]
    return x


LEAD = 60


def ordered(root: Node) -> list[Node]:
    """All nodes, parents first; sums of text and links from the leaves up. No recursion: trees may be deep."""
    nodes = [root]
    for n in nodes:
        nodes.extend(k for k in n.kids if isinstance(k, Node))
    for n in reversed(nodes):
        if n.tag in NEVER:
            continue
        for k in n.kids:
            if isinstance(k, str):
                size = len(k.strip())
                if size:
                    n.chars += size
                    n.own += size
                    n.stops += k.count(".") + k.count(",")
                    if not n.lead:
                        n.lead = SPACE.sub(" ", k[: 4 * LEAD]).strip().lower() if size <= LEAD else " " * (LEAD + 1)
            else:
                n.chars += k.chars
                n.links += k.links
                n.stops += k.stops
                n.own += k.own if k.tag not in BLOCK else 0
                if not n.lead:
                    n.deep = k.deep + (k.tag in BLOCK)
                # the title of a page heads its article, whatever it says
                n.lead = n.lead or (" " * (LEAD + 1) if k.tag == "h1" and k.lead else k.lead)
        if n.tag == "a":
            n.links = n.chars
    return nodes


def edge_kinds(nodes: list[Node]) -> list[int]:
    """Of each node's edge to its parent: 0 below the page itself, 1 below another block, 2 an inline element."""
    return [2 if n.tag not in BLOCK else 0 if n.parent is None or n.parent.tag in TOP else 1 for n in nodes]


def normal(pair: np.ndarray) -> np.ndarray:
    """Log potentials as those of a child's label given its parent's, so that a child that shows nothing says nothing about its parent."""
    return pair - np.log(np.exp(pair).sum(axis=2, keepdims=True))


class Model:
    """Node weights, and for each kind of edge a log potential for (parent's label, child's label)."""

    def __init__(self):
        self.w = np.zeros(FEATURES)
        self.pair = normal(np.array([[[0.2, -0.2], [-0.2, 0.2]], [[1.0, -1.0], [-1.0, 1.0]], [[1.5, -1.5], [-1.5, 1.5]]]))

    def marginals(self, nodes: list[Node], x: np.ndarray) -> np.ndarray:
        """Each node's probability of being content: messages up, then down."""
        at = {id(n): i for i, n in enumerate(nodes)}
        parent = [at[id(n.parent)] if n.parent is not None else -1 for n in nodes]
        return np.array(sum_product(parent, (x @ self.w).tolist(), edge_kinds(nodes), np.exp(self.pair).reshape(-1, 4).tolist()))


def sum_product(parent: list[int], score: list[float], kind: list[int], potentials: list[list[float]]) -> list[float]:
    """Marginals of label 1 on a tree whose parents come before their children.

    ``score`` is a node's log odds; ``potentials[kind]`` are (p00, p01, p10,
    p11), p_ab that of parent a and child b. Messages are kept as odds, so deep or
    wide trees neither under- nor overflow.
    """
    from math import exp, log

    n = len(score)
    up, sent = list(score), [0.0] * n
    for i in range(n - 1, 0, -1):
        p00, p01, p10, p11 = potentials[kind[i]]
        o = exp(min(60.0, max(-60.0, up[i])))
        sent[i] = log((p10 + p11 * o) / (p00 + p01 * o))
        up[parent[i]] += sent[i]
    whole = list(up)
    for i in range(1, n):
        p00, p01, p10, p11 = potentials[kind[i]]
        o = exp(min(60.0, max(-60.0, whole[parent[i]] - sent[i])))
        whole[i] = up[i] + log((p01 + p11 * o) / (p00 + p10 * o))
    return [1 / (1 + exp(-min(60.0, max(-60.0, z)))) for z in whole]


def sum_product_by_level(levels: list[np.ndarray], parent: np.ndarray, score: np.ndarray, kind: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """The same marginals for many trees at once; ``levels`` are the nodes of each depth, the roots first."""
    up, sent = score.astype(float), np.zeros(len(score))
    for level in levels[:0:-1]:
        p00, p01, p10, p11 = potentials[kind[level]].T
        o = np.exp(np.clip(up[level], -60, 60))
        sent[level] = np.log((p10 + p11 * o) / (p00 + p01 * o))
        np.add.at(up, parent[level], sent[level])
    whole = up.copy()
    for level in levels[1:]:
        p00, p01, p10, p11 = potentials[kind[level]].T
        o = np.exp(np.clip(whole[parent[level]] - sent[level], -60, 60))
        whole[level] = up[level] + np.log((p01 + p11 * o) / (p00 + p10 * o))
    return 1 / (1 + np.exp(-np.clip(whole, -60, 60)))


# Layouts of the labelled pages.
def _prose(r: random.Random, n: int) -> str:
    syllables = ("ta", "re", "mi", "so", "len", "dor", "ka", "vi", "nu", "pel", "or", "an", "est", "qui")
    words = ["".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n)]
    for i in range(0, n, r.randint(5, 12)):
        words[i] = words[i].capitalize()
        if i:
            words[i - 1] += r.choice((".", ",", "."))
    return " ".join(words) + r.choice((".", ".", "?", ""))


MARK = "\x02"  # put before text that is content in a labelled page
#: Names that say nothing: as likely on content as on boilerplate, some with a word of boilerplate in them.
NEUTRAL = "wrapper container inner outer row col-md-8 col grid box-a block c12 x7k module part unit section-2 l-main js-hook share-price header-image-text list-item side-by-side form-factor search-history social-history page-body comment-free legal-history".split()
SAID = ("Kommentare", "Commentaires (4)", "Comentarios", "Anzeige", "Comments", "3 comments", "Related articles", "Read more", "Subscribe to us", "Share this", "Advertisement", "Sponsored", "You may also like", "Most popular", "Cookies", "Sign up for news", "Leave a reply", "Tags")


def labelled_page(r: random.Random, family: int = 0) -> str:
    """A page in which content text starts with ``MARK``; ``family`` 1 holds layouts that training does not see."""
    telling = sorted(TELLING)

    def p(lo: int = 1, hi: int = 60) -> str:
        return _prose(r, r.randint(lo, hi))

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{p(1, 3)}</a></li>' for i in range(n))

    def neutral() -> str:
        t = r.random()
        return "" if t < 0.5 else f' {r.choice(("class", "id"))}="{r.choice(NEUTRAL)}"'

    def away(kind: str, inside: bool = False) -> str:
        """A box of boilerplate, told by its element, its names, or what it begins with."""
        how = r.random()
        mark = r.choice(("div", "div", "section", "aside")) if kind == "div" else kind
        name = r.choice(telling) + r.choice(("", "", "-" + r.choice(sorted(AWAY)), "_" + r.choice(sorted(AWAY))))
        attrs = f' {r.choice(("class", "id"))}="{name}"' if how < 0.6 or kind == "div" and inside and how < 0.8 else neutral()
        said = r.choice(SAID) if "class" not in attrs and "id" not in attrs or how > 0.9 else ""
        told = f"<h{(k := r.randint(2, 4))}>{said}</h{k}>" if said and r.random() < 0.7 else f"<p>{said}</p>" if said else ""
        inner = r.choice((f"<ul>{links(r.randint(2, 8))}</ul>", p(2, 25), f"<p>{p(3, 30)}</p>", f"<p>{p(3, 20)}</p><p>{p(3, 60)}</p>", "".join(f"<a href='/{i}'>{p(1, 3)}</a> " for i in range(r.randint(1, 5))), f"<div><a href='/z'>{p(1, 4)}</a></div>", f"<form>{p(1, 4)}<input><button>{p(1, 1)}</button></form>", "".join(f"<div>{p(1, 2)}<p>{p(3, 40)}</p></div>" for _ in range(r.randint(1, 4)))))
        return f"<{mark}{attrs}>{told}{inner}</{mark}>"

    def block() -> str:
        t = r.random()
        if t < 0.50:
            return f"<p{neutral() if r.random() < 0.3 else ''}>{MARK}{p(1, 80)}</p>"
        if t < 0.56:
            return f"<p><b>{MARK}{p(1, 12)}<br>"
        if t < 0.64:
            return f"<h{(k := r.randint(2, 3))}>{MARK}{p(1, 8)}</h{k}>"
        if t < 0.69:
            return f"<{(k := r.choice(('ul', 'ol')))}>" + "".join(f"<li>{MARK}{p(3, 15)}</li>" for _ in range(r.randint(2, 5))) + f"</{k}>"
        if t < 0.72:
            return f"<blockquote><p>{MARK}{p(5, 40)}</p></blockquote>"
        if t < 0.76:
            return f"<table><tr><th>{MARK}{p(1, 2)}</th><th>{MARK}{p(1, 2)}</th></tr><tr><td>{MARK}{p(1, 4)}</td><td>{MARK}{p(1, 4)}</td></tr></table>"
        if t < 0.80:
            inline = "".join(f"<a href='/x'>{MARK}{p(1, 3)}</a> {MARK}{p(2, 9)} " for _ in range(r.randint(1, 3)))
            return f"<p>{MARK}{p(3, 20)} {inline}{r.choice(('</p>', '', '<script>x()</script>'))}"
        if t < 0.82:
            return f"<p><a href='/y'>{MARK}{p(1, 12)}</a></p>"
        if t < 0.83:
            return f'<p>{MARK}{p(3, 20)} <span class="{r.choice(telling)}">{p(1, 6)}</span> {MARK}{p(3, 20)}</p>'
        if t < 0.86:
            return "<dl>" + "".join(f"<dt>{MARK}{p(1, 3)}</dt><dd>{MARK}{p(3, 15)}</dd>" for _ in range(r.randint(1, 4))) + "</dl>"
        if t < 0.89:
            return f"<figure><img src=x><figcaption>{MARK}{p(1, 15)}</figcaption></figure>"
        if t < 0.94:
            return f"<div{neutral()}><p>{MARK}{p(3, 30)}</p><img src=x></div><script>y()</script>"
        if t < 0.96:
            return f"<div{neutral()}>{MARK}{p(8, 60)}</div>"
        return away("div", True)

    if family:
        # a page of nested boxes without telling elements: columns and cells, the head line in a box of its own
        body = f"<div><h1>{MARK}{p(1, 12)}</h1></div>" + "".join(f"<div{neutral()}>{block()}</div>" if r.random() < 0.4 else block() for _ in range(r.randint(3, 14)))
        bars = [away("div") for _ in range(r.randint(1, 4))]
        r.shuffle(bars)
        return f"<html><body><div{neutral()}><div{neutral()}>{bars[0]}</div><div{neutral()}>{body}</div>{''.join(bars[1:])}</div></body></html>"
    shell = r.choice(("article", "article", "article", "main", "div", "div", "section"))
    attrs = f' {r.choice(("class", "id"))}="{r.choice(sorted(TOWARDS))}"' if r.random() < 0.4 else neutral()
    body = f"<h1>{MARK}{p(1, 12)}</h1>" * (r.random() < 0.8) + "".join(block() for _ in range(r.randint(1, 14)))
    if r.random() < 0.15:
        longest = r.choice((2, 4, 12))
        body += "".join(f"<p>{MARK}{p(1, longest)}</p>" for _ in range(r.randint(10, 60)))
    before = "".join(away(r.choice(("nav", "header", "div", "div", "aside"))) for _ in range(r.randint(0, 3)))
    after = "".join(away(r.choice(("footer", "aside", "div", "div", "nav"))) for _ in range(r.randint(0, 3))) + r.choice(("", f"<footer>{p(2, 20)}</footer>", f"<footer>\xa9 {p(2, 20)}</footer>"))
    end = r.choice(("</body></html>", "</body></html>", ""))
    t = r.random()
    if t < 0.08:
        core = "".join(f"<div{neutral()}>{MARK}{p(10, 80)}</div>" for _ in range(r.randint(1, 4)))
    elif t < 0.14:
        core = f"{MARK}{p(1, 60)} <b>{MARK}{p(1, 4)}</b> {MARK}{p(1, 40)}"
        before, after = "", ""
    elif t < 0.26:
        core = body
    else:
        core = f"<{shell}{attrs}>{body}</{shell}>"
        core = f"<div{neutral()}>{core}</div>" if r.random() < 0.25 else core
    if r.random() < 0.3:
        before, after = f"<div{neutral()}>{before}", f"{after}</div>"
        if r.random() < 0.5:
            before, after = f"<div{neutral()}><div{neutral()}>{away('div')}</div>{before}", f"{after}</div>"
    if r.random() < 0.1:
        return before + core + after
    return f"<html><head><title>{p(1, 9)}</title><style>p{{}}</style><script>var a=1;</script></head><body>{before}{core}{after}{end}"


def example(page: str) -> tuple[list[Node], np.ndarray, np.ndarray]:
    """Nodes, features and labels of a labelled page.

    A node with text of its own is content if that is marked; another one if
    nearly all text below it is, but for the page itself; one without text
    takes after its parent.
    """
    nodes = ordered(parse(page))
    marked, other, mine, not_mine = {}, {}, {}, {}
    for n in reversed(nodes):
        own = [k for k in n.kids if isinstance(k, str) and k.strip()] if n.tag not in NEVER else []
        kids = [k for k in n.kids if isinstance(k, Node)]
        soft = [k for k in kids if k.tag not in BLOCK]
        mine[id(n)] = sum(len(k) for k in own if MARK in k) + sum(mine[id(k)] for k in soft)
        not_mine[id(n)] = sum(len(k) for k in own if MARK not in k) + sum(not_mine[id(k)] for k in soft)
        marked[id(n)] = sum(len(k) for k in own if MARK in k) + sum(marked[id(k)] for k in kids)
        other[id(n)] = sum(len(k) for k in own if MARK not in k) + sum(other[id(k)] for k in kids)
    y, at = np.zeros(len(nodes)), {id(n): i for i, n in enumerate(nodes)}
    for i, n in enumerate(nodes):
        k = id(n)
        if mine[k] + not_mine[k]:
            y[i] = mine[k] > not_mine[k]
        elif marked[k] + other[k]:
            y[i] = n.tag not in TOP and marked[k] > 4 * other[k]
        elif n.parent is not None and n.tag not in NEVER:
            y[i] = y[at[id(n.parent)]]
    return nodes, features(nodes), y


@lru_cache(maxsize=1)
def trained(pages: int = 400, rounds: int = 120, seed: int = 11) -> Model:
    """The model of the labelled pages, the same on every machine.

    The gradient of the trees' log-likelihood is what was seen less what the
    model expects: node features under the marginals, and pairs under the
    pair marginals that the messages give. Steps are scaled by running means
    of the gradient and its square (Adam).
    """
    r, model = random.Random(seed), Model()
    xs, ys, parents, depths, kinds, n = [], [], [], [], [], 0
    for _ in range(pages):
        nodes, x, y = example(labelled_page(r))
        at, depth = {id(node): n + i for i, node in enumerate(nodes)}, {}
        for node in nodes:
            depth[id(node)] = depth[id(node.parent)] + 1 if node.parent is not None else 0
        xs.append(x)
        ys.append(y)
        parents += [at[id(node.parent)] if node.parent is not None else -1 for node in nodes]
        depths += [depth[id(node)] for node in nodes]
        kinds += edge_kinds(nodes)
        n += len(nodes)
    x, y, parent, depth, kind = np.concatenate(xs), np.concatenate(ys), np.array(parents), np.array(depths), np.array(kinds)
    levels = [np.flatnonzero(depth == d) for d in range(depth.max() + 1)]
    below = np.flatnonzero(parent >= 0)
    above, kinds = parent[below], kind[below]
    seen = np.zeros_like(model.pair)
    np.add.at(seen, (kinds, y[above].astype(int), y[below].astype(int)), 1)
    moment = np.zeros((2, FEATURES + model.pair.size))
    for turn in range(rounds):
        m = sum_product_by_level(levels, parent, x @ model.w, kind, np.exp(model.pair).reshape(-1, 4))
        gw, gp = x.T @ (y - m) - 0.002 * model.w * pages, seen - 0.002 * model.pair * pages
        ma, mb = m[above], m[below]
        e = np.exp(model.pair[kinds]) * np.stack([1 - ma, ma], axis=1)[:, :, None] * np.stack([1 - mb, mb], axis=1)[:, None, :]
        np.add.at(gp, kinds, -e / e.sum(axis=(1, 2), keepdims=True))
        g = np.concatenate([gw, gp.ravel()]) / pages
        moment = np.array([0.9, 0.99])[:, None] * moment + np.array([0.1, 0.01])[:, None] * np.stack([g, g * g])
        step = 0.2 / (1 + turn / 60) * (moment[0] / (1 - 0.9 ** (turn + 1))) / (np.sqrt(moment[1] / (1 - 0.99 ** (turn + 1))) + 1e-6)
        model.w += step[:FEATURES]
        model.pair = normal(np.clip(model.pair + step[FEATURES:].reshape(model.pair.shape), -4, 0))
    return model


#: An inline element goes with the text around it, unless it is this unlikely to be content.
FOREIGN = 0.15


def extract(source: str | None, model: Model) -> str:
    """The main text of one page; empty for null, empty and text-free pages."""
    if not source:
        return ""
    nodes = ordered(parse(source))
    good = {id(n): g for n, g in zip(nodes, model.marginals(nodes, features(nodes)).tolist())}
    blocks: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = SPACE.sub(" ", "".join(line)).strip()
        if text:
            blocks.append(text)
        line.clear()

    stack: list[tuple[Node | str | None, bool]] = [(nodes[0], False)]
    while stack:
        item, inside = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            if inside:
                line.append(item)
        elif item.tag in NEVER:
            continue
        elif item.tag == "br" or item.tag in BLOCK or item.tag == "#root":
            end()
            stack.append((None, False))
            stack.extend((k, good[id(item)] >= 0.5) for k in reversed(item.kids))
        else:
            stack.extend((k, inside and good[id(item)] >= FOREIGN) for k in reversed(item.kids))
    end()
    return "\n".join(blocks)


def _extracting(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(t.as_py(), model) for t in b.column("html")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "main_text"])

    return run


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``pages(html, ...)`` -> the same rows and ``main_text``.

    Null and empty pages give an empty text, as do pages without text; pages of
    any length are read whole, in time that grows with their length. Other columns pass through, one
    called ``main_text`` is replaced; repeated rows stay; no rows give no rows.
    """
    pages = pages.drop("main_text")
    schema = T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())])
    return pages.mapInArrow(_extracting(model or trained()), schema)
