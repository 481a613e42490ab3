"""Main-text extraction: gradient-boosted trees over DOM nodes, and hierarchical decoding.

A page becomes a tree of block elements (and of any element with a class, id or role) whose text
lies in runs between block boundaries.  Every node has features of its subtree's density, its
attribute tokens, its depth and its siblings.  Boosted trees give each node log-odds of
belonging to the article; decoding keeps the set of nodes with the greatest sum of log-odds
in which no kept node has a dropped ancestor.

The trees are fitted on a bounded sample, ``TRAIN_PAGES`` pages: their own sectioning elements are weak
labels, and each page's text is also laid out in other ways (with known labels), so that pages
that use plain ``div`` elements and class names are covered.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import quoted

TRAIN_PAGES = 300
LAYOUTS = 4                  # other layouts of each training page
NODES_PER_PAGE = 400         # of a training page

# Element names of HTML, in groups.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math object select".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rt rp s samp small span "
             "strike strong sub sup time tt u var wbr".split())
GROUPS = [set(g.split()) for g in (
    "article main", "section", "nav menu", "header", "footer", "aside", "form input button label fieldset option", "p", "h1 h2 h3 h4 h5 h6",
    "li ul ol dl dt dd", "table tbody thead tr td th caption", "div center", "span a b i em strong small", "blockquote pre figure figcaption",
    "html body", "#text")]
#: Tokens of class, id, role and itemprop, by what they usually name.
TOKENS = [set(g.split()) for g in (
    "article articlebody content post entry story main body text news prose page",
    "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager topbar links tabs",
    "header masthead banner logo branding",
    "footer copyright colophon legal imprint contentinfo",
    "sidebar aside widget rail complementary related recommended popular trending more",
    "ad ads adv advert advertisement adbox sponsor sponsored promo promotion promoted affiliate teaser",
    "cookie cookies consent gdpr notice alert popup modal overlay message warning notification disclaimer",
    "comment comments reply replies respond discussion disqus commentlist reader",
    "share social follow subscribe newsletter signup login search form tags meta byline toolbar skip")]
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_CLOSES_P = set("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                "hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead"}), "td": ({"td", "th"}, {"tr", "table"}),
             "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


@dataclass
class Tree:
    """Nodes in page order; node 0 is the root."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    tokens: list[list[int]] = field(default_factory=lambda: [[0] * len(TOKENS)])
    mark: list[int | None] = field(default_factory=lambda: [None])        # label given by the layout or the element
    tags_in: list[int] = field(default_factory=lambda: [0])               # inline tags
    runs: list[tuple[int, str, int]] = field(default_factory=list)         # node, text, characters in links


def _attributes(raw: str) -> tuple[list[int], int | None, bool]:
    found, mark, named = [0] * len(TOKENS), None, False
    if "=" in raw:
        for name, a, b, c in _ATTR.findall(raw):
            name = name.lower()
            if name in ("class", "id", "role", "itemprop"):
                named = True
                parts = set(_PART.findall(_CAMEL.sub(" ", a or b or c).lower()))
                for k, words in enumerate(TOKENS):
                    found[k] += len(parts & words)
            elif name == "data-y":
                mark = int(a or b or c)
            elif name == "hidden" or (name == "aria-hidden" and (a or b or c) == "true"):
                named = True
    return found, mark, named


def parse(page: str) -> Tree:
    """Tree of a page, well-formed or not: elements are closed as browsers do for paragraphs, list items and
    table cells; an end tag without its element is ignored; what the end leaves open is closed there."""
    t = Tree()
    stack: list[tuple[str, int]] = [("html", 0)]            # open elements; inline ones repeat their block's node
    text: list[str] = []
    links, in_link = 0, 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal links
        if text:
            run = " ".join("".join(text).split())
            if run:
                t.runs.append((stack[-1][1], run, links))
            text.clear()
            links = 0

    def add(piece: str) -> None:
        nonlocal links
        if piece:
            if "&" in piece:
                piece = entities.unescape(piece)
            text.append(piece)
            if in_link:
                links += len(piece.strip())

    def close(down_to: int) -> None:
        nonlocal in_link
        if any(stack[i][1] != stack[down_to - 1][1] for i in range(down_to, len(stack))):
            flush()
        in_link -= sum(1 for name, _ in stack[down_to:] if name == "a")
        del stack[down_to:]

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            if name in ("html", "body"):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    close(i)
                    break
                if stack[i][0] in ("td", "th", "table") and name not in ("table", "tr", "tbody", "thead"):
                    break
            continue
        if name == "br" or name == "hr":
            text.append(" ")
            if name == "hr":
                flush()
            continue
        if name in VOID or name in ("html", "body", "head"):
            if name == "body":
                t.tokens[0] = _attributes(m.group(3))[0]
            continue
        if name in RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            text.append(" ")
            continue
        if name in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    close(i)
                    break
                if stack[i][0] not in INLINE:
                    break
        if name in _SIBLINGS:
            same, scope = _SIBLINGS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in scope:
                    break
                if stack[i][0] in same:
                    close(i)
                    if name != "tr":
                        break
        found, mark, named = _attributes(m.group(3))
        inline = name in INLINE and not (named and any(found))
        t.tags_in[stack[-1][1]] += 1
        if inline:
            stack.append((name, stack[-1][1]))
        else:
            flush()
            t.tag.append(name)
            t.parent.append(stack[-1][1])
            t.tokens.append(found)
            t.mark.append(mark)
            t.tags_in.append(0)
            stack.append((name, len(t.tag) - 1))
        in_link += name == "a"
        if m.group(3).endswith("/") and name not in INLINE and len(stack) > 1 and name not in _CLOSES_P:
            close(len(stack) - 1)
    flush()
    # A run beside other nodes is decided for itself.
    has_child = set(t.parent)
    for i, (node, run, link) in enumerate(t.runs):
        if node in has_child or node == 0:
            t.tag.append("#text")
            t.parent.append(node)
            t.tokens.append([0] * len(TOKENS))
            t.mark.append(None)
            t.tags_in.append(0)
            t.runs[i] = (len(t.tag) - 1, run, link)
    return t


N_FEATURES = 2 * (len(GROUPS) + len(TOKENS)) + 22


def features(t: Tree) -> np.ndarray:
    """nodes x N_FEATURES."""
    n = len(t.tag)
    chars, links, words, stops, runs, tags = (np.zeros(n) for _ in range(6))
    first = np.full(n, np.inf)
    place = 0
    for node, run, link in t.runs:
        chars[node] += len(run)
        links[node] += min(link, len(run))
        words[node] += run.count(" ") + 1
        stops[node] += run.count(".") + run.count(",")
        runs[node] += 1
        first[node] = min(first[node], place)
        place += len(run)
    tags += np.array(t.tags_in)
    parent = t.parent
    depth, kids, paras = np.zeros(n), np.zeros(n), np.zeros(n)
    own = np.zeros((n, len(GROUPS) + len(TOKENS)))
    for i in range(n):
        for k, g in enumerate(GROUPS):
            if t.tag[i] in g:
                own[i, k] = 1
                break
        own[i, len(GROUPS):] = t.tokens[i]
    above = np.zeros_like(own)
    # Anonymous runs stand at the end of the list, after their parents; so parents come first.
    for i in range(1, n):
        p = parent[i]
        depth[i] = depth[p] + 1
        kids[p] += 1
        above[i] = np.maximum(above[p], own[p])
    sums = np.stack([chars, links, words, stops, runs, tags], 1)
    paras += own[:, 7]
    for i in range(n - 1, 0, -1):
        sums[parent[i]] += sums[i]
        paras[parent[i]] += paras[i]
        first[parent[i]] = min(first[parent[i]], first[i])
    c, li, w, st, ru, ta = sums.T
    size = np.maximum(c, 1)
    par = np.maximum(np.array(parent), 0)
    first = np.where(np.isfinite(first), first, place)
    before, after = np.zeros(n), np.zeros(n)
    order = np.lexsort((first, par))
    left = order[:-1][par[order[:-1]] == par[order[1:]]]
    right = order[1:][par[order[:-1]] == par[order[1:]]]
    before[right], after[left] = c[left], c[right]
    same = {}
    for i in range(1, n):
        key = (parent[i], t.tag[i])
        same[key] = same.get(key, 0) + 1
    twins = np.array([0, *(same[parent[i], t.tag[i]] for i in range(1, n))])
    log = np.log1p
    rest = np.stack([
        log(c), li / size, log(w), st / np.maximum(w, 1), c / np.maximum(ru, 1), log(ru), ta / size, log(paras), w / np.maximum(ru, 1),
        c / max(place, 1), first / max(place, 1), depth, log(kids), log(kids[par]), log(twins), twins / np.maximum(kids[par], 1),
        c / np.maximum(c[par], 1), log(before), log(after), li[par] / np.maximum(c[par], 1), c / np.maximum(w, 1), paras / np.maximum(ru, 1)], 1)
    return np.concatenate([own, above, rest], 1).astype(np.float32)


# --- boosted trees -----------------------------------------------------------------------------

@dataclass
class Boosted:
    """Sum of oblivious trees: each level of a tree asks one question of all its nodes."""

    start: float
    feature: np.ndarray      # trees x depth
    cut: np.ndarray          # trees x depth
    leaf: np.ndarray         # trees x 2^depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for k in range(len(f)):
                at = at * 2 + (x[:, f[k]] > c[k])
            out += leaf[at]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 5, rate: float = 0.2, bins: int = 24, l2: float = 2.0,
          share: float = 0.4, seed: int = 1) -> Boosted:
    """Second-order gradient boosting with logistic loss on histograms of ``bins`` quantiles; each tree is grown
    on a random ``share`` of the rows."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)     # x > cut[b] <=> bin > b
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    start = math.log(mean / (1 - mean))
    score = np.full(len(y), start)
    fs, cs, ls = [], [], []
    d = x.shape[1]
    rng = np.random.default_rng(seed)
    for _ in range(trees):
        some = rng.random(len(y)) < share if len(y) > 1000 else np.ones(len(y), bool)
        part, flat = binned[some], (binned[some] + np.arange(d) * bins).ravel()
        p = 1 / (1 + np.exp(-score[some]))
        g, h = y[some] - p, p * (1 - p)
        node = np.zeros(len(part), np.int64)
        f_row, c_row, b_row = [], [], []
        for level in range(depth):
            k = 1 << level
            code = flat + np.repeat(node, d) * (d * bins)
            gh = [np.bincount(code, np.repeat(v, d), k * d * bins).reshape(k, d, bins) for v in (g, h)]
            left_g, left_h = gh[0].cumsum(2), gh[1].cumsum(2)
            right_g, right_h = left_g[:, :, -1:] - left_g, left_h[:, :, -1:] - left_h
            gain = (left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2)).sum(0)
            for j, c in enumerate(cuts):
                gain[j, len(c):] = -1
            j, b = np.unravel_index(gain.argmax(), gain.shape)
            f_row.append(j)
            c_row.append(cuts[j][b] if len(cuts[j]) else np.inf)
            b_row.append(b)
            node = node * 2 + (part[:, j] > b)
        leaf = rate * np.bincount(node, g, 1 << depth) / (np.bincount(node, h, 1 << depth) + l2)
        at = np.zeros(len(y), np.int64)
        for j, b in zip(f_row, b_row):
            at = at * 2 + (binned[:, j] > b)
        score += leaf[at]
        fs.append(f_row)
        cs.append(c_row)
        ls.append(leaf)
    return Boosted(start, np.array(fs), np.array(cs, np.float32), np.array(ls))


# --- labels ------------------------------------------------------------------------------------

#: Elements whose own meaning labels a training page: the article, and what is none of it.
ARTICLE, OTHER = {"article", "main"}, {"nav", "header", "footer", "aside", "form", "button", "input"}


def labels(t: Tree) -> np.ndarray | None:
    """1 for nodes of the article and those around it, 0 for others; None if no mark or element tells."""
    n = len(t.tag)
    state: list[int | None] = [None] * n
    for i in range(n):
        up = state[t.parent[i]] if i else None
        if t.mark[i] is not None:
            state[i] = t.mark[i]
        elif t.tag[i] in OTHER and not (t.tag[i] == "header" and up == 1) or sum(t.tokens[i][1:]) and not t.tokens[i][0]:
            state[i] = 0
        elif t.tag[i] in ARTICLE and up != 0:
            state[i] = 1
        else:
            state[i] = up
    if 1 not in state:
        return None
    y = np.array([s == 1 for s in state])
    for i in range(n - 1, 0, -1):
        if y[i]:
            y[t.parent[i]] = True
    return y.astype(float)


def layouts(t: Tree, rng: random.Random, how_many: int) -> Iterator[str]:
    """The page's text laid out in other ways, labelled by attribute data-y."""
    y = labels(t)
    if y is None:
        return
    main = [r for node, r, _ in t.runs if y[node]]
    short = [r for node, r, _ in t.runs if not y[node]] or ["Home"]
    esc = entities.escape
    pick = rng.choice

    def link_list(tag: str) -> str:
        words = " ".join(short).split()
        items = [f'<a href="/x">{esc(" ".join(words[i:i + pick((1, 1, 2))]))}</a>' for i in (rng.randrange(len(words)) for _ in range(rng.randint(2, 9)))]
        return (f"<{tag}>" + "".join(f"<li>{i}</li>" for i in items) + f"</{tag}>") if rng.random() < 0.7 else " | ".join(items)

    def note() -> str:
        s = esc(pick(short))
        return pick((s, f"<p>{s}</p>", f"<p>{s}</p><p>{esc(pick(main) if main and rng.random() < 0.3 else pick(short))}</p>", link_list("ul")))

    def junk(inside: bool) -> str:
        kind = rng.randrange(9)
        def div(names: str, body: str, tags: str = "div div section") -> str:
            tag = pick(tags.split())
            attr = pick(("class", "class", "id"))
            name = pick(names.split())
            return f'<{tag} {attr}="{name}" data-y="0">{body}</{tag}>'
        form = f'<label>{esc(pick(short))}</label><input name="q"><button>{esc(pick(short).split()[0])}</button>'
        talk = "".join(f'<{x}>{esc(pick(main + short))}</{x}>' for x in [pick(("p", "div", "li"))] * rng.randint(1, 6))
        return (lambda: pick((f'<nav data-y="0">{link_list("ul")}</nav>', div("menu navbar breadcrumbs main-menu top-links pagination", link_list("ul"), "div ul"))),
                lambda: pick((f'<header data-y="0">{note()}</header>', div("header masthead site-header top-banner", note()))) if not inside else div("share-bar social", link_list("ul")),
                lambda: pick((f'<footer data-y="0">{note()}</footer>', div("footer site-footer copyright", note()))),
                lambda: pick((f'<aside data-y="0">{note()}</aside>', div("sidebar widget related-posts right-rail", note() + note(), "div aside"))),
                lambda: div("ad ads advertisement sponsored promo-box ad-slot", note(), "div div p span"),
                lambda: div("cookie-notice consent-banner alert popup notice", note(), "div div p"),
                lambda: pick((f'<form data-y="0">{form}</form>', div("newsletter signup search-box", form, "div form"))),
                lambda: div("comments comment-list reader-comments replies discussion", talk, "div section ol"),
                lambda: div("share social tags related", link_list("ul")))[kind]()

    for _ in range(how_many):
        parts = []
        for i, r in enumerate(main):
            s = esc(r)
            if i and rng.random() < 0.15:
                w = s.split(" ")
                k = rng.randrange(len(w))
                s = " ".join(w[:k] + [f'<a href="/y">{w[k]}</a>'] + w[k + 1:])
            few = [esc(w) for w in r.split(" ")[:rng.randint(2, 8)]]
            parts.append(f"<{pick(('h1', 'h1', 'h2'))}>{s}</h1>" if i == 0 else pick(
                (f"<p>{s}</p>",) * 10 + (
                    f"<p>{s}", f"<div>{s}</div>", f"<blockquote>{s}</blockquote>", f"<ul><li>{s}</li></ul>",
                    f"<h3>{' '.join(few)}</h3><p>{s}</p>", f"<p>{s}</p><pre>{' '.join(few)}</pre>",
                    f"<figure><img src=x><figcaption>{' '.join(few)}</figcaption></figure><p>{s}</p>",
                    f"<p>{s}</p><{(x := pick(('ul', 'ol')))}>" + "".join(f"<li>{w}</li>" for w in few) + f"</{x}>",
                    f"<p>{s}</p><table>" + "".join(f"<tr><td>{w}</td><td>{few[0]}</td></tr>" for w in few) + "</table>",
                    f"<table><tr><th>{few[0]}<th>{few[-1]}<tr><td>{few[0]}<td>{s}</table>")))
            if rng.random() < 0.06:
                parts.append(junk(True))
        body = "".join(parts)
        open_, close = pick((("<article data-y=1>", "</article>"), ("<main data-y=1>", "</main>"), ("<main><article data-y=1>", "</article></main>"),
                             ('<div class="content" data-y=1>', "</div>"), ('<div id="main"><div class="post" data-y=1>', "</div></div>"),
                             ('<div class="entry-content" data-y=1>', "</div>"), ('<section class="story" data-y=1>', "</section>"),
                             ('<div role="main" data-y=1>', "</div>"), ("<div data-y=1>", "</div>"), ('<div itemprop="articleBody" data-y=1>', "</div>"),
                             ('<div class="wrapper"><div class="page-body" data-y=1>', "</div></div>")))
        tail = junk(True) if rng.random() < 0.2 else ""
        yield ("<html><body>" + "".join(junk(False) for _ in range(rng.randint(1, 4))) + open_ + body + tail + close
               + "".join(junk(False) for _ in range(rng.randint(0, 4))) + pick(("</body></html>", "")))


# --- extraction --------------------------------------------------------------------------------

def decode(t: Tree, score: np.ndarray) -> np.ndarray:
    """Nodes to keep: the greatest sum of log-odds such that the parents of kept nodes are kept; the root always is."""
    n = len(t.tag)
    best = score.astype(float).copy()
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[t.parent[i]] += best[i]
    keep = np.zeros(n, bool)
    keep[0] = True
    for i in range(1, n):
        keep[i] = best[i] > 0 and keep[t.parent[i]]
    return keep


def main_text(t: Tree, score: np.ndarray) -> str:
    keep = decode(t, score)
    return "\n\n".join(run for node, run, _ in t.runs if keep[node])


def _training_nodes(page: str | None, key: int) -> tuple[np.ndarray, np.ndarray]:
    rng = random.Random(key)
    xs, ys = [], []
    first = parse(page or "")
    for t in [first, *(parse(p) for p in layouts(first, rng, LAYOUTS))]:
        y = labels(t)
        if y is None:
            continue
        x = features(t)
        if len(y) > NODES_PER_PAGE:
            some = np.random.default_rng(key & 0xFFFF).choice(len(y), NODES_PER_PAGE, replace=False)
            x, y = x[some], y[some]
        xs.append(x)
        ys.append(y)
    return (np.concatenate(xs), np.concatenate(ys)) if xs else (np.zeros((0, N_FEATURES), np.float32), np.zeros(0))


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", how_many: int = TRAIN_PAGES) -> Boosted | None:
    """Fit on the ``how_many`` pages with the least hash of their id (equal pages of an id count once); None if none of them has labels."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where("id is not null and html is not null")
    key = F.xxhash64(F.col("id").cast("string"), F.lit(11))
    narrow = rows.select("id", key.alias("o"), F.xxhash64("html").alias("h")).distinct()
    ids = narrow.orderBy("o", "id", "h").limit(how_many).select(F.col("id").alias("chosen"), "o", F.col("h").alias("chosen_h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_training_nodes(p.as_py(), o) for o, p in zip(b.column("o").to_pylist(), b.column("html"))]
            yield pa.RecordBatch.from_arrays([b.column("o"), pa.array([x.tobytes() for x, _ in found], pa.binary()),
                                              pa.array([y.astype(np.int8).tobytes() for _, y in found], pa.binary())], names=["o", "x", "y"])

    chosen = rows.join(F.broadcast(ids), (F.col("id") == F.col("chosen")) & (F.xxhash64("html") == F.col("chosen_h"))).select("o", "html")
    got = sorted(chosen.distinct().mapInArrow(run, "o long, x binary, y binary").collect(), key=lambda r: (r.o, bytes(r.x)))      # how_many rows
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got] or [np.zeros((0, N_FEATURES))])
    y = np.concatenate([np.frombuffer(r.y, np.int8) for r in got] or [np.zeros(0)]).astype(float)
    return boost(x, y) if len(y) and 0 < y.mean() < 1 else None


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", out: str = "text",
            model: Boosted | None = None) -> DataFrame:
    """All columns of ``pages`` and ``out``, the main text of the whole page, in place of a column of that name.

    Character references are decoded, white space in a block becomes one space, blocks are joined by two line
    feeds.  NULL and empty pages have an empty text, and so has every page if no page has an article to
    learn from.  Repeated rows are extracted each; an empty table gives an empty result."""
    model = model or train(pages, id_col, html_col)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    names = [c for c in pages.columns if c != out]
    # By place, whatever they are called: the page itself comes first.
    rows = pages.select(F.coalesce(F.col(html_col), F.lit("")).alias("page"), *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts: list[str] = []
            held: list[tuple[Tree, np.ndarray]] = []

            def settle() -> None:
                if held and shared.value is not None:
                    odds = shared.value.log_odds(np.concatenate([x for _, x in held]))
                    at = 0
                    for t, x in held:
                        texts.append(main_text(t, odds[at:at + len(x)]))
                        at += len(x)
                else:
                    texts.extend("" for _ in held)
                held.clear()
            for page in b.column(0):
                t = parse(page.as_py())
                held.append((t, features(t)))
                if len(held) >= 64:
                    settle()
            settle()
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string())], names=[*names, out])

    return rows.mapInArrow(run, StructType([*(f for f in pages.schema.fields if f.name != out), StructField(out, StringType())]))
