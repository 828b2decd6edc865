"""Main text of web pages by minimum-cut labelling.

A page becomes a list of text blocks. A linear classifier of each block's markup and shape gives the costs of calling it
content or boilerplate, which are its capacities to the two terminals of a flow network. Smoothness edges tie blocks that
follow each other, the more so the nearer their elements are in the tree, and each block to the one before it under the
same parent element. The maximum flow's cut is the cheapest labelling.

Class names, roles and elements such as nav are strong evidence and outweigh a block's edges; where a page has none, what
a block's own shape says is often wrong (a one-word line of an article, a long line of legal text) and the edges decide.
A name is a hint only if all its parts are known, so that side-effects is none; one element's names for and against
content cancel out; and a hint or form around the page's heading and most of its prose says nothing of what is in it.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_MARK = re.compile(r"<!--|<[!?]|</?[a-zA-Z]")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_HINT = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:[\s=>/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*(?:display\s*:\s*none|visibility\s*:\s*hidden))""", re.I)
# Parts of names: of boilerplate, of it outside an article only, of what goes with these, and of content.
_BAD = re.compile(
    r"ads?|adv|advert\w*|adbox|adsby\w*|banner|sponsor\w*|promo\w*|nav\w*|menus?|breadcrumbs?|sidebars?|widgets?|footer|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|"
    r"newsletter|subscri\w+|signup|login|share|sharing|sharebar|social|related|recommended|comments?|commentlist|replies|disqus\w*|pagination|pager|toolbar|taglist|tags|copyright"
)
_OUTSIDE = re.compile(r"header|foot|side|masthead|topbar|search|skip|legal|contentinfo|complementary|discussion|respond|feedback|tag")
_WITH = re.compile(
    r"box|bar|wrap|wrapper|container|block|area|list|section|inner|outer|panel|items?|buttons?|btns?|links?|icons?|tools?|posts?|articles?|stories|news|contents?|form|unit|slot|header|title|head|"
    r"threads?|reader|user|site|page|global|top|bottom|left|right|inline|entry|main|primary|secondary|sub|js|this|media|message|body|author|reply|text|count|meta|more|to|us|info|bottom|fixed|sticky|\d+"
)
_GOOD = re.compile(r"article\w*|content|main|post|entry|story|body|text|blog|prose")
_INLINE = re.compile(r"ads?|advert\w*|adsby\w*|sponsored|promo")
_RIGHTS = re.compile(r"©|\(c\)|copyright\b", re.I)
# Elements whose text is no part of a page's prose, and those that break lines of text.
_RAW = {"script", "style", "title", "textarea", "noscript", "iframe", "xmp", "noembed", "noframes"}
_DROP = {"head", "template", "svg", "math", "object", "select", "button", "canvas", "audio", "video", "datalist", "dialog", "map"}
_AWAY = {"nav", "footer", "aside", "form", "menu", "fieldset"}
_RAW_END = {n: re.compile(rf"</{n}\b", re.I) for n in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "td", "tfoot", "th", "thead", "tr", "ul", "search",
} | _DROP
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "summary", "legend", "head"}
_SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
#: Capacities: between successive blocks; for nearness in the tree, falling with the square of the steps between them.
NEIGHBOUR, NEAR = 0.1, 1.2
#: What hints weigh: content, boilerplate by class or role, boilerplate by element.
GOOD, BAD, AWAY = 2.0, 7.0, 7.0
#: The share of a page's prose from which on a hint around its heading says nothing; a form's, and its least paragraphs.
MOST, FORM, PARAGRAPHS = 0.5, 0.9, 3


@functools.lru_cache(8192)
def _hints(names: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element's names speak for content, and whether for boilerplate; inside an article fewer do."""
    good = bad = False
    for name in names.split():
        parts = [p for p in re.split(r"[-_\s]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
        own = inside or any(p in ("article", "entry", "post", "story") for p in parts)
        told = [bool(_BAD.fullmatch(p) or (not own and _OUTSIDE.fullmatch(p))) for p in parts]
        if told == [True] and parts[0] in ("discussion", "legal", "respond", "feedback"):
            continue  # on their own these head sections of articles
        if any(told) and all(t or _WITH.fullmatch(p) for t, p in zip(told, parts, strict=True)):
            bad = True
        elif any(_GOOD.fullmatch(p) for p in parts):
            good = True
    return good and not bad, bad and not good


def _left_out(attributes: str) -> bool:
    """Whether an inline element is hidden, or an advert by its name."""
    if "=" not in attributes and "hidden" not in attributes:
        return False
    names = " ".join(x.strip("\"'") for x in _HINT.findall(attributes)).lower()
    return bool(_HIDDEN.search(attributes)) or any(_INLINE.fullmatch(n) for n in names.split())


class _Flag:
    """An element that speaks against its content: what it is, whether the page's heading is in it, how much prose."""

    __slots__ = ("kind", "up", "heading", "prose", "paragraphs")

    def __init__(self, kind: str, up: _Flag | None):
        self.kind, self.up, self.heading, self.prose, self.paragraphs = kind, up, False, 0, 0


def _tag_end(text: str, at: int) -> int:
    """Place after the > of the tag that begins at at; quoted > do not count where the quote is closed."""
    i, n = at, len(text)
    while i < n:
        c = text[i]
        if c == ">":
            return i + 1
        if c in "\"'" and text[i - 1] in "= \t\n":
            close = text.find(c, i + 1)
            if close < 0:
                break
            i = close
        i += 1
    close = text.find(">", at)
    return n if close < 0 else close + 1


class _Block:
    __slots__ = ("text", "links", "tags", "own", "parent", "depth", "apart", "good", "flag", "bad", "away")

    def __init__(self, text, links, tags, own, parent, depth, apart, good, flag):
        self.text, self.links, self.tags, self.good, self.flag, self.bad, self.away = text, links, tags, good, flag, False, False
        # Numbers of the block's element and of the one around it, its depth, and the tree steps from the block before.
        self.own, self.parent, self.depth, self.apart = own, parent, depth, apart


def blocks(page: str) -> list[_Block]:
    """Text blocks in page order, with what surrounds them."""
    out: list[_Block] = []
    # An open element: name, number, whether it or one around it is content by name or element, the nearest flag around it,
    # whether it is dropped, and whether it is in an article.
    stack: list[tuple] = [("", 0, False, None, False, False)]
    flags: list[_Flag] = []
    skipped, skips = "", 0  # an open inline element whose text is left out, and how often its name is open in it
    text: list[str] = []
    links = link = serial = 0
    open_: Counter = Counter()
    shared = 0  # elements that have been open ever since the block before

    def flush() -> None:
        nonlocal links, shared
        if text:
            # Character references can be white space too, so they come first.
            words = html.unescape("".join(text)).split()
            text.clear()
            top = stack[-1]
            if words and not top[4]:
                depth = len(stack)
                apart = (out[-1].depth - shared) + (depth - shared) if out else 0
                out.append(_Block(" ".join(words), links, [x[0] for x in stack[-4:]], top[1], stack[-2][1] if depth > 1 else 0, depth, apart, top[2], top[3]))
                shared = depth
        links = 0

    def close(names: set, stops: set) -> None:
        nonlocal shared
        if not any(open_[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                flush()
                open_.subtract(x[0] for x in stack[i:])
                del stack[i:]
                shared = min(shared, i)
                return
            if stack[i][0] in stops:
                return

    at, n = 0, len(page)
    while at < n:
        m = _MARK.search(page, at)
        stop = m.start() if m else n
        if stop > at and not skips:
            run = page[at:stop]
            text.append(run)
            if link:
                links += len(run)
        if not m:
            break
        if m[0] == "<!--":
            end = page.find("-->", stop + 4)
            at = n if end < 0 else end + 3
            continue
        at = _tag_end(page, stop)
        if m[0] in ("<!", "<?"):
            continue
        opening = m[0][1] != "/"
        name_match = _NAME.match(page, stop + (1 if opening else 2))
        name = name_match[0].lower()
        if name in ("br", "hr"):
            text.append(" ")
        if name == "a":
            link = int(opening)
        if opening and name in _RAW:
            end = _RAW_END[name].search(page, at)
            at = n if not end else _tag_end(page, end.start())
            continue
        if name not in _BLOCK or name in _VOID:
            if skips and name == skipped:
                skips += 1 if opening else -1
            elif opening and not skips and name not in _VOID and _left_out(page[name_match.end() : at]):
                skipped, skips = name, 1
            continue
        skips = 0  # an inline element ends with its block
        if not opening:
            close({name}, {""})
            link = 0
            continue
        flush()
        link = 0
        if name in _CLOSES_P:
            close({"p"}, {"div", "article", "section", "td", "li", "body", "blockquote", "main", "form"})
        if name in _SAME:
            close(*_SAME[name])
        attributes = page[name_match.end() : at]
        names = " ".join(x.strip("\"'") for x in _HINT.findall(attributes)) if "=" in attributes else ""
        up = stack[-1]
        serial += 1
        told_good, told_bad = _hints(names, up[5]) if names else (False, False)
        holder = name in ("article", "main")
        good = up[2] or holder or told_good
        flag = up[3]
        if told_bad and name not in ("body", "html", "article", "main"):
            flag = _Flag("name", flag)
            flags.append(flag)
        if name in _AWAY or (name == "header" and not up[2]):
            flag = _Flag("form" if name in ("form", "fieldset") else name, flag)
            flags.append(flag)
        if name == "h1" or (holder and not told_bad) or told_good:
            f = flag
            while f and not f.heading:
                f.heading, f = True, f.up
        stack.append((name, serial, good, flag, up[4] or name in _DROP or bool(_HIDDEN.search(attributes)), up[5] or name == "article" or "articlebody" in names.lower()))
        open_[name] += 1
    flush()
    _weigh(out, flags)
    return out


def _weigh(found: list[_Block], flags: list[_Flag]) -> None:
    """Say of each block if a flag around it stands: names and forms that hold the heading and most prose do not.

    flags are in the order of their opening, so those around one come before it.
    """
    prose = 0
    for b in found:
        if shape(b) >= 0:
            prose += len(b.text)
            if b.flag:
                b.flag.prose += len(b.text)
                b.flag.paragraphs += 1
    for f in reversed(flags):
        if f.up:
            f.up.prose += f.prose
            f.up.paragraphs += f.paragraphs
    stands: dict[_Flag, tuple[bool, bool]] = {}
    for f in flags:
        bad, away = stands[f.up] if f.up else (False, False)
        most = f.heading and f.prose >= MOST * prose or f.kind == "form" and f.paragraphs >= PARAGRAPHS and f.prose >= FORM * prose
        void = most and f.kind in ("name", "form")
        stands[f] = bad or (f.kind == "name" and not void), away or (f.kind != "name" and not void)
    for b in found:
        if b.flag:
            b.bad, b.away = stands[b.flag]


def shape(b: _Block) -> float:
    """Log-odds of content by a block's own text and markup: a fixed linear classifier."""
    n = len(b.text)
    last = b.tags[-1] if b.tags else ""
    s = -0.8 + 0.8 * min(math.log1p(n / 20), 4) - 3.0 * min(1.0, b.links / n) - 1.5 * bool(_RIGHTS.match(b.text))
    s += 0.6 * (last == "p") + 0.8 * (last in ("h1", "h2", "h3", "h4", "blockquote", "pre")) - 0.6 * (last == "li")
    return s + 0.4 * (b.text[-1] in ".!?\"'”»…:")


def score(b: _Block) -> float:
    """Log-odds of content by shape and hints."""
    return shape(b) + GOOD * (b.good and not (b.bad or b.away)) - BAD * b.bad - AWAY * b.away


def edges(found: list[_Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: successive blocks by their nearness in the tree, and the block before under the same parent."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            out.append((i - 1, i, NEIGHBOUR + NEAR * (2 / max(2, b.apart)) ** 2))
        if last.get(b.parent, i - 1) != i - 1:
            out.append((last[b.parent], i, NEAR))
        last[b.parent] = i
    return out


def minimum_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) that cost least: softplus terms at the terminals, a capacity where tied nodes differ.

    Flow through a node straight from one terminal to the other is the smaller of its two capacities, so what is left is
    its score: positive ones are supplies, negative ones demands. Dinic's phases move supplies to demands over the edges.
    """
    n = len(scores)
    rest = list(scores)
    to: list[list[int]] = [[] for _ in range(n)]
    head: list[int] = []
    cap: list[float] = []
    for a, b, w in edges:
        to[a].append(len(head))
        head.append(b)
        cap.append(w)
        to[b].append(len(head))
        head.append(a)
        cap.append(w)
    tiny = 1e-9
    while True:
        level = [0 if r > tiny else -1 for r in rest]
        queue = [i for i in range(n) if level[i] == 0]
        hit = False
        for u in queue:
            if rest[u] < -tiny:
                hit = True
                continue
            for e in to[u]:
                if cap[e] > tiny and level[head[e]] < 0:
                    level[head[e]] = level[u] + 1
                    queue.append(head[e])
        if not hit:
            return [x >= 0 for x in level]
        nxt = [0] * n
        for s in range(n):
            while rest[s] > tiny and level[s] == 0:
                path, u = [], s
                while not rest[u] < -tiny:
                    while nxt[u] < len(to[u]):
                        e = to[u][nxt[u]]
                        if cap[e] > tiny and level[head[e]] == level[u] + 1:
                            break
                        nxt[u] += 1
                    if nxt[u] < len(to[u]):
                        path.append(e)
                        u = head[e]
                    elif path:
                        e = path.pop()
                        u = head[e ^ 1]
                        nxt[u] += 1
                    else:
                        u = -1
                        break
                if u < 0:
                    break
                f = min([rest[s], -rest[u], *(cap[e] for e in path)])
                rest[s] -= f
                rest[u] += f
                for e in path:
                    cap[e] -= f
                    cap[e ^ 1] += f


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = minimum_cut([score(b) for b in found], edges(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


@F.pandas_udf(T.StructType().add("text", "string").add("n_chars", "long"))
def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        texts = [main_text(p) for p in pages]
        yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages, whatever its other columns.

    Null and empty html give an empty text, as pages without an article do. Null and repeated ids pass through. Very long
    pages are read whole, in time linear in their length; no rows give no rows.
    """
    out = pages.select("page_id", "url", _extract(F.col("html").cast("string")).alias("found"))
    return out.select("page_id", "url", F.col("found.text").alias("text"), F.col("found.n_chars").alias("n_chars"))
