"""Main text of web pages by minimum-cut labelling.

A page is read into blocks: runs of text between the starts and ends of
block elements.  Each block gets two costs, one for being called content
and one for being called boilerplate, from a classifier of its text, its
markup and the subtree it lies in, plus the evidence of the elements around
it.  Neighbouring blocks, and the next blocks inside one container, are joined
by smoothness edges that weaken with their distance in the document tree and
with the contrast of their surroundings.  The costs are the terminal
capacities of a flow network; its minimum cut (maximum flow) is the labelling
with the least sum of costs and cut edges.

No element decides by itself.  An article weighs as much as the classifier may
claim; a name that may be page furniture or a subject (discussion, alert,
search, or any id inside an article) weighs less, so that prose under it
stays; only what can be nothing else (nav, footer, sidebar) outweighs both.
Pages without any such mark are labelled by the classifier and the edges.

The classifier is a logistic regression, fitted in numpy on blocks of at most
``TRAIN_PAGES`` pages whose elements say what they are (blocks within
article or main against those within nav, footer, aside and the like); its
features name none of these elements.

Pages are independent rows: Spark deals them out, and each is handled inside
its task, whatever its length.

Defined cases
* null or empty html, or a page without content: the empty string;
* broken markup: unclosed elements end with their parents, stray end tags
  are ignored, an unclosed comment, script, style, textarea or iframe reaches
  to the end; a quote opens a quoted value only after an equals sign;
* what is not shown where its element works (noscript, template, object,
  canvas, audio, video, select, datalist, descriptions in svg and math) goes
  if the element has its end tag, and is ordinary text if not; text within
  svg and math is text of the block around it;
* character references are decoded once; what is no reference stays;
* the classifier learns from one page of each page_id, by a hash of its html,
  however many rows have it, a null page_id included;
* null page_id or url pass through; repeated rows stay; empty input: empty
  output; other columns pass through, an existing text, n_chars or n_blocks
  is replaced.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require

TRAIN_PAGES = 400
#: Evidence of page furniture around a block: none, a doubtful name, a form, firm.
NONE, DOUBTFUL, FORM, FIRM = range(4)
AGAINST = (0.0, 2.5, 4.0, 5.0)
#: Weight of lying inside the page's article, and outside of it.
INSIDE, OUTSIDE = 3.0, 2.5
#: Most that the classifier alone may claim, and the weights of smoothness edges.
CLAIM, ADJACENT, SIBLING = 3.0, 1.0, 0.8
#: How fast an edge weakens with the difference of its blocks' evidence.
CONTRAST = 0.5

#: Element names of HTML by what they do here, and words that name page furniture.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea iframe".split())
HIDDEN = set("noscript template object canvas audio video select datalist".split())
#: Elements with their own kind of markup, and what they hold but do not show.
FOREIGN, FOREIGN_HIDDEN = {"svg", "math"}, set("title desc metadata annotation annotation-xml".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br nobr center button input".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
HOLDERS = set("ul ol dl table tbody thead tr div section article main aside nav header footer form body html td th".split())
CONTENT_TAGS = {"article", "main"}
FURNITURE_TAGS = set("nav footer aside form menu dialog head title button".split())
FURNITURE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer footnav gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination paywall popup promo promotion promoted recommended "
    "recommendations related reply replies respond responses share sharing shoutbox sidebar sidebars signup "
    "sitemap skip social sponsor sponsored subscribe subscription teaser teasers toolbar topbar widget widgets "
    "aside complementary contentinfo dialog alertdialog hidden".split())
DOUBTFUL_WORDS = set("alert discussion search".split())

COMMENT_WORDS = set("comment comments commentlist disqus reply replies respond responses".split())
NOT_ITSELF, PAGE_WORDS = set("has no with without".split()), set("site page top global main masthead".split())
PROSE_TAGS = set("p blockquote pre dd figcaption h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open svg or math.
BREAKS = PROSE_TAGS | HOLDERS | CONTENT_TAGS | set(CLOSES) | set("figure details address hr".split()) | (
    FURNITURE_TAGS - FOREIGN_HIDDEN)
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|"
    r"</?([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|))*+)>|</?[A-Za-z][^>]*+>?", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?", re.I)
WORDS = re.compile(r"[a-z0-9]+")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    linked: int      # characters inside links
    tag: str         # the innermost block element
    path: tuple      # identities of the open block elements, outermost first
    content: bool    # inside article or main
    furniture: int   # the strongest evidence of page furniture around it


def furniture_words(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """How firmly the attributes name page furniture; whether they name content.

    A name such as has-sidebar or no-comments says what a page has, not what
    the element is.  An article or main element is furniture only as part of
    reader comments.  Inside an article a word in the middle of a name, and any
    id (there the subject of a section), is doubtful."""
    bad, good = NONE, False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            bad = FIRM
        elif name == "style":
            bad = FIRM if HIDING.search(value) else bad
        elif name in ("class", "id", "role"):
            for one in value.split():
                parts = WORDS.findall(HUMP.sub(" ", one).lower())
                found = set(parts)
                if not parts or not NOT_ITSELF.isdisjoint(found):
                    continue
                known = COMMENT_WORDS if tag in CONTENT_TAGS else FURNITURE_WORDS
                header = tag not in CONTENT_TAGS and "header" in found and (len(found) == 1 or not PAGE_WORDS.isdisjoint(found))
                if header or not known.isdisjoint(found):
                    firm = not inside or (name != "id" and (header or not known.isdisjoint((parts[0], parts[-1]))))
                    bad = max(bad, FIRM if firm else DOUBTFUL)
                elif tag not in CONTENT_TAGS and not DOUBTFUL_WORDS.isdisjoint(found):
                    bad = max(bad, DOUBTFUL)
                good |= name == "role" and bool({"main", "article"} & found)
    return bad, good


def blocks(html: str) -> list[Block]:
    """The page's blocks that have text, in page order."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple] = []  # (tag, is block, content, evidence of furniture, identity)
    hidden: dict[int, tuple] = {}  # identity -> where the open hidden element began
    linked = links = identity = at = begin = foreign = 0
    path: tuple = ()

    def end_block():
        nonlocal linked, begin
        if len(parts) > begin:
            text = " ".join(unescape("".join(parts[begin:])).split())
            if text:
                holder = next((e for e in reversed(stack) if e[1]), ("", True, False, NONE, 0))
                out.append(Block(text, min(linked, len(text)), holder[0], path, holder[2], holder[3]))
            begin = len(parts)
        linked = 0

    def close_to(depth: int):
        nonlocal path, links, foreign
        if any(e[1] for e in stack[depth:]):
            end_block()
        for e in stack[depth:]:
            links -= e[0] == "a"
            foreign -= e[0] in FOREIGN
            hidden.pop(e[4], None)
            path = path[:-1] if e[1] else path
        del stack[depth:]

    def say(text: str):
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text.strip())

    while True:
        m = TOKEN.search(html, at)
        if not m:
            if at < len(html):
                say(html[at:])
            break
        if m.start() > at:
            say(html[at:m.start()])
        at, tag = m.end(), (m[1] or "").lower()
        if not tag:
            continue
        if html[m.start() + 1] == "/":
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None and not (tag in INLINE and any(e[1] for e in stack[depth + 1:])):
                start = hidden.get(stack[depth][4])
                close_to(depth)
                if start:  # it is closed: what it holds goes
                    blocks_then, parts_then, begin, linked = start
                    del out[blocks_then:], parts[parts_then:]
                    parts.append(" ")
            continue
        if tag in RAW:
            if not m[0].endswith("/>"):
                stop = re.compile(rf"</{re.escape(tag)}\s*+>?", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            parts.append(" ")
            continue
        if foreign and tag in BREAKS:
            close_to(next(i for i, e in enumerate(stack) if e[0] in FOREIGN))
        if tag not in VOID and (tag in HIDDEN or tag in FOREIGN or foreign):
            if tag in ("svg", "text") or tag in HIDDEN:
                parts.append(" ")
            if not m[0].endswith("/>"):
                identity += 1
                above = stack[-1] if stack else ("", True, False, NONE, 0)
                stack.append((tag, False, *above[2:4], identity))
                if tag in HIDDEN or (foreign and tag in FOREIGN_HIDDEN):
                    hidden[identity] = (len(out), len(parts), begin, linked)
                foreign += tag in FOREIGN
                links += tag == "a"
            continue
        is_block = tag not in INLINE
        if tag in VOID:
            if is_block and tag not in ("meta", "link", "base"):
                end_block()
            parts.append(" ")
            continue
        if is_block:
            for i in range(len(stack) - 1, -1, -1):  # what this start tag closes
                if stack[i][0] == "p" or stack[i][0] in CLOSES.get(tag, ()):
                    close_to(i)
                    break
                if stack[i][0] in HIDDEN or (stack[i][0] in HOLDERS and stack[i][0] not in CLOSES.get(tag, ())):
                    break
            end_block()
        elif tag == "a" and links:
            continue
        above = stack[-1] if stack else ("", True, False, NONE, 0)
        bad, good = furniture_words(tag, m[2], above[2]) if m[2] and not m[2].isspace() else (NONE, False)
        if tag in FURNITURE_TAGS or (tag == "header" and not above[2]):
            bad = max(bad, FORM if tag == "form" else FIRM)
        # a form or a doubtful name around the page's article is part of the page, not of the article
        under = NONE if above[3] != FIRM and tag in CONTENT_TAGS else above[3]
        if m[0].endswith("/>") and tag in ("p", "div", "span"):
            continue
        identity += 1
        stack.append((tag, is_block, above[2] or good or tag in CONTENT_TAGS,
                      max(under, bad if tag not in ("html", "body") else NONE), identity))
        links += tag == "a"
        if is_block:
            path += (identity,)
        elif bad and not above[3]:  # inline furniture is a block of its own
            parts_before = parts[begin:]
            begin = len(parts)
            stack[-1] = (tag, True, *stack[-1][2:])
            path += (identity,)
            if parts_before:
                text = " ".join(unescape("".join(parts_before)).split())
                if text:
                    holder = next((e for e in reversed(stack[:-1]) if e[1]), ("", True, False, NONE, 0))
                    out.append(Block(text, min(linked, len(text)), holder[0], path[:-1], holder[2], holder[3]))
                linked = 0
    end_block()
    return out


FEATURES = 12


def block_features(page: list[Block]) -> np.ndarray:
    """What the text, its own element and the text of the subtree around it
    say, without the names of the surroundings."""
    out = np.zeros((len(page), FEATURES), dtype=np.float32)
    size: dict[int, int] = {}  # characters outside links in every element
    for b in page:
        for e in b.path:
            size[e] = size.get(e, 0) + len(b.text) - b.linked
    # the element that most of the text shares, as deep as it goes
    whole, core = sum(len(b.text) - b.linked for b in page), 0
    for b in page:
        for e in b.path:
            core = max(core, e) if 2 * size[e] > whole else core
    for i, b in enumerate(page):
        n = len(b.text)
        holder = b.path[-2] if len(b.path) > 1 else 0
        words = b.text.count(" ") + 1
        out[i] = (
            1.0, b.linked / n, math.log1p(words) / 6, math.log1p(n / words) / 4, b.text[-1] in ".!?…\"”»)",
            min(1.0, sum(map(b.text.count, ",;:.!?")) / words), 0.4 * (b.tag in PROSE_TAGS),
            sum(map(str.isdigit, b.text)) / n, "©" in b.text or " | " in b.text or " · " in b.text,
            size.get(holder, whole) / max(1, whole), n / max(1, whole), core in b.path)
    return out


def weak_labels(page: list[Block]) -> np.ndarray:
    """1 content, 0 furniture, -1 where no element says so."""
    return np.array([0 if b.furniture >= FORM else 1 if b.content and not b.furniture else -1 for b in page], dtype=np.int64)


def fit(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.5, decay: float = 0.05) -> np.ndarray:
    """Logistic regression with both classes weighing the same."""
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= rate * (x.T @ ((p - y) * weight) * 4 + decay * w)
    return w


def minimum_cut(lean: np.ndarray, edges: dict[tuple[int, int], float]) -> np.ndarray:
    """Labels (True: content) with the least cost, where calling block i
    against its ``lean`` costs |lean| and an edge between different labels its
    weight.

    A block that leans more than all its edges weigh keeps its side in a
    minimum cut; it becomes a terminal and its edges lean its neighbours.
    What remains is solved by maximum flow with shortest augmenting paths."""
    n = len(lean)
    lean = lean.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        if w > 0 and a != b:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label = np.zeros(n, bool)
    fixed = np.zeros(n, bool)
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if fixed[i] or abs(lean[i]) < sum(near[i].values()):
            continue
        fixed[i], label[i] = True, lean[i] > 0
        for j, w in near[i].items():
            lean[j] += w if label[i] else -w
            del near[j][i]
            todo.append(j)
        near[i] = {}
    if fixed.all():
        return label
    # flow from source n (content) to sink n + 1
    cap = [dict(d) for d in near] + [{}, {}]
    for i in np.flatnonzero(~fixed):
        i = int(i)
        a, b = (n, i) if lean[i] > 0 else (i, n + 1)
        cap[a][b] = abs(lean[i])
        cap[b].setdefault(a, 0.0)
    while True:
        level = {n: 0}
        queue = deque([n])
        while queue:
            a = queue.popleft()
            for b, c in cap[a].items():
                if c > 1e-9 and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if n + 1 not in level:
            break
        left = {a: iter(list(cap[a])) for a in level}
        walk = [n]
        while walk:  # blocking flow, depth first without recursion
            a = walk[-1]
            if a == n + 1:
                least = min(cap[p][q] for p, q in zip(walk, walk[1:]))
                for p, q in zip(walk, walk[1:]):
                    cap[p][q] -= least
                    cap[q][p] = cap[q].get(p, 0.0) + least
                walk = [n]
                left = {p: iter(list(cap[p])) for p in level} if least <= 1e-9 else left
                left[n] = iter(list(cap[n]))
                continue
            step = next((b for b in left[a] if cap[a].get(b, 0) > 1e-9 and level.get(b) == level[a] + 1), None)
            if step is None:
                walk.pop()
                level.pop(a, None)
            else:
                walk.append(step)
                if step != n + 1:
                    left[step] = iter(list(cap[step]))
    for i in np.flatnonzero(~fixed):
        label[i] = int(i) in level
    return label


def network(page: list[Block], weights: np.ndarray) -> tuple[np.ndarray, dict[tuple[int, int], float]]:
    """(lean of each block towards content, edges between blocks)."""
    claim = np.clip(block_features(page) @ weights, -CLAIM, CLAIM)
    against = np.array(AGAINST)[[b.furniture for b in page]]
    inside = np.array([b.content and b.furniture < FORM for b in page])
    evidence = np.where(inside, INSIDE, 0.0) - against
    if inside.any():
        evidence = evidence - np.where(~inside & (against < AGAINST[FORM]), OUTSIDE, 0.0)
    edges: dict[tuple[int, int], float] = {}

    def join(a: int, b: int, w: float):
        edges[a, b] = edges.get((a, b), 0.0) + w * math.exp(-CONTRAST * abs(evidence[a] - evidence[b]))

    last: dict[int, int] = {}
    for i, b in enumerate(page):
        if i:
            a = page[i - 1]
            common = next((k for k, (x, y) in enumerate(zip(a.path, b.path)) if x != y), min(len(a.path), len(b.path)))
            apart = len(a.path) + len(b.path) - 2 * common
            join(i - 1, i, ADJACENT * math.exp(-max(0, apart - 2) / 2))
        holder = b.path[-2] if len(b.path) > 1 else 0
        if holder in last:
            join(last[holder], i, SIBLING)
        last[holder] = i
    return claim + evidence, edges


def content(page: list[Block], weights: np.ndarray) -> np.ndarray:
    """Which of the page's blocks are its main text."""
    return minimum_cut(*network(page, weights)) if page else np.zeros(0, bool)


def main_text(html: str | None, weights: np.ndarray) -> tuple[str, int]:
    """The main text, and the number of blocks that the page has."""
    page = blocks(html or "")
    keep = content(page, weights)
    return "\n".join(b.text for b, k in zip(page, keep) if k), len(page)


def train(pages: DataFrame, n: int = TRAIN_PAGES) -> np.ndarray:
    """Weights from the blocks of at most ``n`` pages, one of each page_id, picked by a hash."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [blocks(h.as_py() or "") for h in b.column("html")]
            # sums per page are enough for what is collected: at most 64 blocks of each kind, evenly chosen
            xs, ys = [], []
            for page in found:
                x, y = block_features(page), weak_labels(page)
                for kind in (0, 1):
                    at = np.flatnonzero(y == kind)
                    at = at[np.unique(np.linspace(0, len(at) - 1, 64).astype(int))] if len(at) else at
                    xs.append(x[at])
                    ys.append(y[at])
            x, y = np.concatenate(xs), np.concatenate(ys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float32())), pa.array(y, pa.int64())], ["x", "y"])

    picked = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(n).withColumnRenamed("page_id", "picked")
    of = pages.join(F.broadcast(picked), F.col("page_id").eqNullSafe(F.col("picked")), "left_semi")
    sample = of.groupBy("page_id").agg(F.min_by("html", F.xxhash64("html")).alias("html")).select("html")
    got = sample.mapInArrow(batches, "x array<float>, y long").toArrow()
    y = np.array(got["y"].to_pylist(), dtype=np.int64)
    x = np.array(got["x"].to_pylist(), dtype=np.float64).reshape(-1, FEATURES)
    order = np.lexsort([*x.T, y])
    return fit(x[order], y[order])


def extract(pages: DataFrame, weights: np.ndarray | None = None, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with text, n_chars and n_blocks."""
    require(pages, ["page_id", "html"])
    weights = train(pages) if weights is None else weights
    keep = [c for c in keep or pages.columns if c not in ("text", "n_chars", "n_blocks")]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            found = [main_text(h.as_py(), weights) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*map(b.column, keep), pa.array([t for t, _ in found], pa.string()),
                 pa.array([len(t) for t, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                [*keep, "text", "n_chars", "n_blocks"])

    schema = T.StructType([pages.schema[c] for c in keep] + [
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
        T.StructField("n_blocks", T.LongType())])
    return pages.select(*dict.fromkeys([*keep, "html"])).mapInArrow(batches, schema)
