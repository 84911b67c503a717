"""Operator 2, main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is read into its leaf blocks: runs of text not interrupted by the start or end of a block
element, in page order, each with its open elements and their class, id and role words. Scripts, styles,
comments, head and the like, and elements that are hidden (attribute ``hidden``, ``display:none``), give no block. Every block has binary features (ancestor tags, parent, name
words, length, link share, punctuation, place); the field scores each block's label (main
text or not) by its features and by the label before it, also by whether both share a parent.

The weights are trained on labelled pages by the gradient of the likelihood (forward and backward
sums); the labels of a page are decoded by Viterbi. Training runs on the driver on a bounded sample (parameters ``max_pages``, ``max_blocks``
of a page, ``max_length`` of a page in characters, ``max_lines`` of a page that are written anew):
given pages carry their label in their markup (inside the article, but not in a box there whose tag or names say that it is something
else), and each is also written anew in other layouts (:func:`layouts`) with other tags and names, and with adverts, boxes, forms and
reader comments inside the article, so that the field learns the other features too. Extraction is a map over pages without a shuffle;
open elements are shared nodes, so its work is linear in a page's length however deeply it nests.

Defined results: null, empty or textless html gives the empty text; unclosed tags, stray ``<`` and
unfinished comments are read as browsers do; rows that repeat give equal texts; extra columns
pass through, clashing ones are replaced; with no page to train on, only layouts of made-up words train.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PAGES, MAX_BLOCKS, MAX_LENGTH, MAX_LINES = 200, 60, 100_000, 30
VARIANTS = 8
EPOCHS = 120

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body div p article section nav header footer aside main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot "
    "tr td th caption blockquote pre form fieldset figure figcaption hr address details summary dialog button select option "
    "center legend label textarea iframe".split())
#: elements whose content is not text of the page
HIDDEN = frozenset("head title script style noscript template svg math object iframe select option textarea".split())
RAW = frozenset("script style textarea title noscript iframe".split())
#: elements that can stand in a head; any other, or text, ends one that is open
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template".split())
#: an opening tag that ends open elements of these kinds
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",)}

_OPEN = re.compile(r"<([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>")
_CLOSE = re.compile(r"</([a-zA-Z][^\s/>]*)[^>]*>")
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_LABEL = re.compile(r"data-y=\"([01])\"")
_WORD = re.compile(r"[a-z]+")


_UNSEEN = re.compile(r"(?:^|\s)hidden(?=$|[\s=/])(?!\s*=\s*[\"']?until-found)|style\s*=\s*(?:\"[^\"]*|'[^']*|\S*)display\s*:\s*none", re.I)


_INLINE = frozenset("a b i em strong span small sup sub code u font mark time abbr cite q s img".split())


class Node:
    """An open element. ``new`` are the features that it adds to those of the elements around it."""

    __slots__ = ("above", "tag", "label", "new", "names", "unseen", "block", "outer", "real", "real_above", "score")

    def __init__(self, above, tag, label, new, names, unseen, serial):
        self.above, self.tag, self.new, self.names, self.unseen, self.score = above, tag, new, names, unseen, None
        self.label = label if label is not None or above is None else above.label
        inner, outer = (above.block, above.outer) if above is not None else (0, 0)
        self.block, self.outer = (serial, inner) if tag in BLOCKS else (inner, outer)
        real, real_above = (above.real, above.real_above) if above is not None else ("none", None)
        self.real, self.real_above = (real, real_above) if tag in _INLINE else (tag, real)

    def path(self) -> list["Node"]:
        """From the outermost element to this one."""
        out, at = [], self
        while at is not None:
            out.append(at)
            at = at.above
        return out[::-1]


class Block:
    __slots__ = ("node", "label", "text", "linked", "parent")

    def __init__(self, node, label, text, linked, parent):
        self.node, self.label, self.text, self.linked, self.parent = node, label, text, linked, parent


def blocks_of(page: str) -> list[Block]:
    """Leaf blocks with text. ``node``: the innermost open element; ``parent``: number of the
    innermost block element but one, that is of the block's container."""
    out: list[Block] = []
    stack: list[Node] = []
    opened: dict[str, int] = {}
    held: dict[str, int] = {}  # features of the open elements
    parts: list[str] = []
    linked = hidden = serial = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                node = stack[-1] if stack else None
                out.append(Block(node, node.label if node else None, text, min(1.0, linked / len(text)), node.outer if node else 0))
        linked = 0

    def pop(k: int) -> None:
        nonlocal hidden
        while len(stack) > k:
            node = stack.pop()
            opened[node.tag] -= 1
            hidden -= node.unseen
            for f in node.new:
                del held[f]

    def end_head() -> None:
        if stack and stack[-1].tag == "head":
            pop(len(stack) - 1)

    def close(tag: str) -> None:
        if opened.get(tag):
            k = len(stack) - 1
            while stack[k].tag != tag:
                k -= 1
            pop(k)

    at, last = 0, page.rfind(">")
    while at < len(page):
        lt = page.find("<", at)
        data = page[at:] if lt < 0 else page[at:lt]
        if data.strip(" \t\n\f\r"):
            end_head()
        if data and not hidden:
            data = entities.unescape(data) if "&" in data else data
            parts.append(data)
            if opened.get("a"):
                linked += len(data)
        if lt < 0:
            break
        nxt = page[lt + 1: lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = len(page) if end < 0 else end + 3
        elif nxt in ("!", "?"):
            end = page.find(">", lt)
            at = len(page) if end < 0 else end + 1
        elif nxt == "/" and lt < last and (m := _CLOSE.match(page, lt)):
            tag = m[1].lower()
            if tag in BLOCKS:
                flush()
            close(tag)
            at = m.end()
        elif nxt.isascii() and nxt.isalpha() and lt < last and (m := _OPEN.match(page, lt)):
            tag, attrs, at = m[1].lower(), m[2], m.end()
            if tag == "head" and any(t.tag != "html" for t in stack):
                continue
            if tag not in IN_HEAD:
                end_head()
            if tag in BLOCKS:
                flush()
                if opened.get("p"):
                    close("p")
            elif tag == "br":
                if not hidden:
                    parts.append(" ")
            for other in ENDS.get(tag, ()):
                # only within the innermost list or table
                k = len(stack) - 1
                while k >= 0 and stack[k].tag not in ("ul", "ol", "dl", "table", other):
                    k -= 1
                if k >= 0 and stack[k].tag == other:
                    pop(k)
            if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
                continue
            names: tuple[str, ...] = ()
            label, unseen = None, tag in HIDDEN
            if attrs and not attrs.isspace():
                if "=" in attrs:
                    found = [a or b or c for a, b, c in _NAMES.findall(attrs)]
                    names = tuple(dict.fromkeys(w for f in found for w in _WORD.findall(f.lower())))
                    label = m[1] if (m := _LABEL.search(attrs)) else None
                unseen = unseen or _UNSEEN.search(attrs) is not None
            serial += 1
            new = [f for f in ([] if tag in _INLINE else [f"in:{tag}"]) + [f"name:{w}" for w in names] if f not in held]
            held.update(dict.fromkeys(new, 1))
            stack.append(Node(stack[-1] if stack else None, tag, label, new, names, unseen, serial))
            opened[tag] = opened.get(tag, 0) + 1
            hidden += unseen
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                at = end.start() if end else len(page)
        else:
            end_head()
            if not hidden:
                parts.append("<")
            at = lt + 1
    flush()
    return out


def own_features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold of each block besides those of its open elements."""
    out = []
    n = len(blocks)
    for k, b in enumerate(blocks):
        words = b.text.count(" ") + 1
        f = ["bias", f"len:{min(7, words.bit_length())}", f"link:{round(b.linked * 4)}", f"end:{b.text[-1] if b.text[-1] in '.!?:;,' else 'o'}"]
        if b.linked > 0.5:
            f.append(f"linked-len:{min(5, words.bit_length())}")
        f.append(f"place:{min(3, k)}:{min(3, n - 1 - k)}")
        if "©" in b.text or "·" in b.text or "|" in b.text:
            f.append("sign")
        real, above = (b.node.real, b.node.real_above) if b.node else ("none", None)
        f.append(f"tag:{real}")
        if above is not None:
            f.append(f"parent:{above}>{real}")
        out.append(f)
    return out


def features_of(blocks: list[Block]) -> list[list[str]]:
    """All features of each block, with those of its open elements (long for deep pages: for training)."""
    return [f + ([x for node in b.node.path() for x in node.new] if b.node else []) for b, f in zip(blocks, own_features(blocks))]


def same_parent(blocks: list[Block]) -> list[int]:
    """Whether each block has the parent of the block before it."""
    return [int(k > 0 and blocks[k - 1].parent == b.parent) for k, b in enumerate(blocks)]


class Field:
    """Weights of features (for label 1 against 0) and of label changes [same parent][before][now]."""

    def __init__(self, weights: dict[str, float], change: np.ndarray):
        self.weights, self.change = weights, change

    def _around(self, node: Node | None) -> float:
        """Sum of the weights of the open elements' features, kept at every node on the way."""
        todo = []
        while node is not None and node.score is None:
            todo.append(node)
            node = node.above
        total = node.score if node is not None else 0.0
        for node in reversed(todo):
            total += sum(self.weights.get(x, 0.0) for x in node.new)
            node.score = total
        return total

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels of a page, by Viterbi."""
        get, c = self.weights.get, self.change.tolist()
        back, s0, s1 = [], 0.0, 0.0
        for k, (f, same, b) in enumerate(zip(own_features(blocks), same_parent(blocks), blocks)):
            e = sum(get(x, 0.0) for x in f) + self._around(b.node)
            if not k:
                s0, s1 = 0.0, e
                continue
            t = c[same]
            a0, b0, a1, b1 = s0 + t[0][0], s1 + t[1][0], s0 + t[0][1], s1 + t[1][1]
            back.append((int(b0 > a0), int(b1 > a1)))
            s0, s1 = max(a0, b0), max(a1, b1) + e
        if not blocks:
            return []
        y = [int(s1 > s0)]
        for step in reversed(back):
            y.append(step[y[-1]])
        return y[::-1]


def train_field(pages: list[list[Block]], epochs: int = EPOCHS, decay: float = 1e-3) -> Field:
    """Maximum likelihood by full gradients (Adam) over labelled pages, all pages at once."""
    pages = [p for p in pages if p]
    index: dict[str, int] = {}
    length = max(map(len, pages))
    cell, feat = [], []
    y = np.zeros((len(pages), length), np.int64)
    same, real = np.zeros_like(y), np.zeros((len(pages), length), bool)
    for i, p in enumerate(pages):
        real[i, : len(p)] = True
        same[i, : len(p)] = same_parent(p)
        for k, (b, f) in enumerate(zip(p, features_of(p))):
            y[i, k] = int(b.label == "1")
            ids = [index.setdefault(x, len(index)) for x in f]
            cell += [i * length + k] * len(ids)
            feat += ids
    cell, feat = np.array(cell), np.array(feat)
    w, c = np.zeros(len(index)), np.zeros((2, 2, 2))
    m = [np.zeros_like(w), np.zeros_like(c)]
    v = [np.zeros_like(w), np.zeros_like(c)]
    for step in range(1, epochs + 1):
        e = np.bincount(cell, w[feat], y.size).reshape(y.shape)
        score = np.stack([np.zeros_like(e), e], -1)
        ahead = np.zeros((len(pages), length, 2))
        behind = np.zeros_like(ahead)
        ahead[:, 0] = score[:, 0]
        for k in range(1, length):
            t = ahead[:, k - 1, :, None] + c[same[:, k]]
            ahead[:, k] = np.where(real[:, k, None], np.logaddexp(t[:, 0], t[:, 1]) + score[:, k], ahead[:, k - 1])
        for k in range(length - 2, -1, -1):
            t = c[same[:, k + 1]] + (score[:, k + 1] + behind[:, k + 1])[:, None, :]
            behind[:, k] = np.where(real[:, k + 1, None], np.logaddexp(t[:, :, 0], t[:, :, 1]), 0.0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        p1 = np.exp(ahead[..., 1] + behind[..., 1] - total[:, None]) * real
        grad_w = np.bincount(feat, (y * real - p1).ravel()[cell], len(w)) / len(pages) - decay * w
        grad_c = np.zeros_like(c)
        both = ahead[:, :-1, :, None] + c[same[:, 1:]] + (score[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        both = np.exp(np.where(real[:, 1:, None, None], both, -np.inf))
        for s in (0, 1):
            at = real[:, 1:] & (same[:, 1:] == s)
            grad_c[s] -= both[at].sum(0)
            np.add.at(grad_c[s], (y[:, :-1][at], y[:, 1:][at]), 1.0)
        grad_c = grad_c / len(pages) - decay * c
        for x, g, mm, vv in ((w, grad_w, m[0], v[0]), (c, grad_c, m[1], v[1])):
            mm += 0.1 * (g - mm)
            vv += 0.01 * (g * g - vv)
            x += 0.15 * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.99**step)) + 1e-8)
    return Field({x: float(w[k]) for x, k in index.items()}, c)


_MAIN = ("article", "main", "section", 'div class="content"', 'div class="post-body"', 'div id="article-text"', 'div class="entry"',
         'div class="story"', 'div role="main"')
_MENU = ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="navbar"', 'div role="navigation"', 'div class="breadcrumb"')
_SIDE = ("aside", 'div class="sidebar"', 'div class="related"', 'div id="side"', 'div class="widget"', 'section class="recommended"')
_AD = ('div class="ad"', 'div class="advert"', 'div class="promo"', 'div class="sponsored"', 'aside class="banner"', 'p class="ad"')
_NOTICE = ('div class="cookie"', 'div class="notice"', 'div id="consent"', 'div class="newsletter"', 'p class="notice"', 'div role="alert"')
_TOP = ("header", 'div class="header"', 'div id="masthead"', 'div class="topbar"')
_FOOT = ("footer", 'div class="footer"', 'div id="bottom"', 'div class="copyright"', 'p class="legal"')
_SHARE = ('div class="share"', 'ul class="social"', 'div class="tags"', 'div class="byline"', 'p class="meta"')
#: names of boxes inside an article that are no part of its text
_OTHER_WORDS = frozenset(
    "ad ads advert advertisement adverts banner promo sponsor sponsored related recommended sidebar widget share social tags cookie consent notice newsletter subscribe "
    "comment comments discussion replies reply respond menu nav navigation navbar breadcrumb breadcrumbs footer header masthead copyright legal pager pagination".split())
_TALK = ('section class="comments"', 'div id="comments"', 'div class="discussion"', 'ol class="comment-list"', 'div class="reader-comments"', 'div class="replies"')


def layouts(title: str, lines: list[str], prose: list[str], links: list[str], seed: int) -> str:
    """A labelled page in a random layout: ``lines`` are the main text, ``prose`` and ``links`` fill the rest."""
    r = random.Random(seed)
    esc = entities.escape

    def box(kind: str, inner: str, y: int) -> str:
        return f'<{kind} data-y="{y}">{inner}</{kind.split()[0]}>'

    def some(lo: int, hi: int) -> list[str]:
        return [r.choice(prose) for _ in range(r.randint(lo, hi))]

    def items(kind: str, lo: int = 3, hi: int = 9) -> str:
        names = [esc(r.choice(links)) for _ in range(r.randint(lo, hi))]
        plain = "".join(f'<li><a href="/{k}">{x}</a></li>' for k, x in enumerate(names))
        if kind.startswith("ul"):
            return plain
        return r.choice([f"<ul>{plain}</ul>", " ".join(f'<a href="/{k}">{x}</a>' for k, x in enumerate(names))])

    def boiler(kind: str) -> str:
        inner = "".join(r.choice(["{}", "<p>{}</p>", "<div>{}</div>"]).format(esc(x)) for x in some(1, 2))
        return box(kind, inner, 0)

    def form() -> str:
        return f'<form data-y="0"><label>{esc(r.choice(links))}</label><input name="q"><p>{esc(r.choice(prose))}</p><button>{esc(r.choice(links))}</button></form>'

    def talk() -> str:
        kind = r.choice(_TALK)
        one = "<li>{}</li>" if kind.startswith("ol") else r.choice(["<p>{}</p>", '<div class="comment"><p>{}</p></div>', "<article><p>{}</p></article>"])
        return box(kind, "<h3>" + esc(r.choice(links)) + "</h3>" + "".join(one.format(esc(x)) for x in some(1, 4)), 0)

    def cells(xs: list[str], kind: str) -> str:
        """Some of the main lines as a table, a list, a definition list or a figure."""
        text = [esc(x) for x in xs]
        short = [esc(" ".join(x.split()[: r.randint(1, 4)])) for x in xs]
        if kind == "table":
            head = "<tr>" + "".join(f"<th>{x}</th>" for x in short[:2]) + "</tr>" if r.random() < 0.5 else ""
            return "<table>" + head + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in zip(short, r.sample(short, len(short)))) + "</table>"
        if kind == "dl":
            return "<dl>" + "".join(f"<dt>{a}</dt><dd>{b}</dd>" for a, b in zip(short, text)) + "</dl>"
        if kind == "figure":
            return f'<figure><img src="x.png"><figcaption>{text[0]}</figcaption></figure>' + "".join(f"<p>{x}</p>" for x in text[1:])
        return f"<{kind}>" + "".join(f"<li>{x}</li>" for x in r.choice([text, short])) + f"</{kind}>"

    body, rest = [], list(lines)
    while rest:
        if r.random() < 0.2:
            k = r.randint(1, 4)
            body.append(cells(rest[:k], r.choice(["table", "ul", "ol", "dl", "figure"])))
            rest = rest[k:]
            continue
        x = rest.pop(0)
        shape = r.choice(["<p>{}</p>"] * 4 + ["<p><b>{}<br>", "<p>{}", "<h2>{}</h2>", "<h3>{}</h3>", "<blockquote>{}</blockquote>", "<blockquote><p>{}</p></blockquote>",
                                               "<pre>{}</pre>", "<li>{}</li>", "<div>{}</div>", "<div><p>{}</p></div>"])
        body.append(shape.format(esc(" ".join(x.split()[:6]) if shape.startswith("<h") else x, r.random() < 0.5)))
    talks = box(r.choice(_SHARE), items("ul") if r.random() < 0.5 else esc(r.choice(prose)), 0)
    for extra in (boiler(r.choice(_AD)), boiler(r.choice(_AD)), boiler("aside"), boiler(r.choice(_SIDE)), form(), boiler(r.choice(_NOTICE)), box(r.choice(_SIDE), items(""), 0),
                  box(r.choice(_MENU[:5]), items(""), 0), talks):
        if body and r.random() < 0.25:
            body.insert(r.randint(0, len(body)), extra)
    inner = (f"<h1>{esc(title)}</h1>" if r.random() < 0.8 else "") + "".join(body)
    if r.random() < 0.3:
        inner = f"<div>{inner}</div>"
    if r.random() < 0.45:
        inner += talk()
    if r.random() < 0.2:
        inner += boiler("footer")
    kind = r.choice(_MAIN)
    main = f'<{kind} data-y="1">{inner}</{kind.split()[0]}>'
    before = [box(m := r.choice(_MENU), items(m), 0)] if r.random() < 0.9 else []
    before += [x for x in (boiler(r.choice(_TOP)), boiler(r.choice(_NOTICE)), boiler(r.choice(_AD)), form(), box(r.choice(_SIDE), items(""), 0)) if r.random() < 0.4]
    r.shuffle(before)
    after = [x for x in (talk(), boiler(r.choice(_SIDE)), boiler(r.choice(_AD)), form(), boiler(r.choice(_NOTICE)), box(r.choice(_MENU[:5]), items(""), 0)) if r.random() < 0.4]
    r.shuffle(after)
    if r.random() < 0.9:
        after.append(box(r.choice(_FOOT), "&copy; " + esc(r.choice(links)) + " &middot; " + esc(r.choice(prose)), 0))
    wrap = r.choice(["{}", "<div>{}</div>", '<div class="wrapper">{}</div>', '<div id="page"><div class="row">{}</div></div>'])
    return f"<html><head><title>{esc(title)}</title></head><body>{wrap.format(''.join(before) + main + ''.join(after))}</body></html>"


def _marked(blocks: list[Block]) -> list[Block] | None:
    """Blocks labelled by their markup, of pages that have an article with text: inside the article, but in no box there whose tag
    or name says that it is something else."""
    outside = ("nav", "aside", "footer", "form", "header")
    for b in blocks:
        path = b.node.path() if b.node else []
        tags = [node.tag for node in path]
        inner = path[tags.index("article") + 1:] if "article" in tags else None
        b.label = "1" if inner is not None and not any(node.tag in outside or _OTHER_WORDS & set(node.names) for node in inner) else "0"
    return blocks if any(b.label == "1" for b in blocks) else None


def learn(pages: list[str], variants: int = VARIANTS, seed: int = 3, max_blocks: int = MAX_BLOCKS, max_lines: int = MAX_LINES) -> Field:
    """The field trained on ``pages`` and their layouts. Pages of more than ``max_blocks`` blocks do not train; at most ``max_lines`` lines
    of a page are written anew."""
    given = [g for g in (_marked(blocks_of(p)) for p in pages) if g and len(g) <= max_blocks]
    made_up = [f"{a} {b} {c} of the {a}{b}." for a in ("na", "re", "ton", "il") for b in ("sor", "mi", "ent") for c in ("ol", "ata", "ure")]
    prose = [b.text for g in given for b in g if len(b.text) > 20] or made_up
    links = [b.text for g in given for b in g if b.linked > 0.5] or ["na", "sor mi", "ure"]
    r = random.Random(seed)
    train = list(given)
    texts = [[b.text for b in g if b.label == "1"][:max_lines] for g in given] or [made_up[k: k + 5] for k in range(25)]
    for k, lines in enumerate(texts):
        for v in range(variants):
            page = layouts(lines[0][:60], lines[1:] or lines, [r.choice(prose) for _ in range(8)], [r.choice(links) for _ in range(8)], seed + 1000 * v + 7 * k)
            train.append(blocks_of(page))
    return train_field(train)


def main_text(page: str | None, field: Field) -> str:
    """Blocks labelled main text, joined by line feeds."""
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, y in zip(blocks, field.decode(blocks)) if y)


def train(pages: DataFrame, *, html: str = "html", page_id: str = "page_id", max_pages: int = MAX_PAGES, max_blocks: int = MAX_BLOCKS,
          max_length: int = MAX_LENGTH, max_lines: int = MAX_LINES) -> Field:
    """Fit on at most ``max_pages`` pages of less than ``max_length`` characters, chosen by a hash of their id; see :func:`learn`."""
    usable = pages.where(F.col(html).isNotNull() & F.col(page_id).isNotNull() & (F.length(html) < max_length))
    place = F.xxhash64(F.col(page_id))
    every = max(1, usable.count() // (4 * max_pages))  # a few times the bound, so that no task and not the driver gets more
    few = usable.where(F.pmod(place, F.lit(every)) == 0)
    rows = few.select(page_id, html).orderBy(place, page_id, F.xxhash64(html)).limit(max_pages).collect()
    return learn([r[html] for r in rows], max_blocks=max_blocks, max_lines=max_lines)


def extract(pages: DataFrame, field: Field, *, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (bigint)."""
    rows = pages.select(*[f"`{c}`" for c in pages.columns if c.lower() not in ("text", "n_chars")])

    def run(batches):
        for batch in batches:
            texts = [main_text(p.as_py(), field) for p in batch.column(html)]
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, "text", "n_chars"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
