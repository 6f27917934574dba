"""HTML extraction by wrapper induction.

1. The trees of containers of a host's pages are aligned, layout by layout, by simple tree matching: first
   in each task, then the tasks' trees with each other. The aligned nodes tell which text is constant over
   the distinct articles and which varies, and the innermost node that holds most of what varies is the
   layout's region of content.
2. Text blocks are named by their path of labels and their text, and counted over the distinct articles of
   the host, and of each layout: copies of an article, whatever their urls, navigation or adverts, are one.
   What has the same path and text on most articles is template, in all the host's pages.
3. A page is aligned with its layout's tree. Slots (blocks that are no template) in the node that matches
   the region are content; where an element named as article stands around or inside that node, its bounds
   are taken. Without a wrapper, slots inside a named article are, or else slots of prose. Parts that their
   element, class or id names as navigation, adverts, comments and the like never are.

Edge cases: a null, empty or text-less page gives the empty text and is no evidence; broken markup
(unclosed elements, a page that breaks off inside a tag) is read as far as it goes; a host with fewer
than three articles has no template, and a layout of fewer no region; repeated pages count once and are
extracted each; a null page_id is kept; an empty table gives no rows; a null url is a host of its own, the empty one; other columns are
left out. Articles of which a template would leave under a tenth are taken for versions of one.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_limits, sized, stage, table

#: A block is template if this share of the articles, and at least so many, have it.
SHARE, PAGES = 0.8, 3
#: Articles with less than this share of their characters outside the template count as one.
LEFT = 0.1
#: The region of content holds this share of the varying text of each node around it.
REGION = 0.7
#: Wrappers and articles that a task remembers before it lets go of them.
WRAPPERS, ARTICLES = 2_000, 100_000
SKIPPED = frozenset("script style noscript template svg head title iframe object canvas select option textarea button".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCKS = frozenset("html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption section article main header footer nav aside form fieldset blockquote pre figure figcaption address details summary hr dialog menu center".split())
#: Blocks of text, which differ between the articles of one layout.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption address details summary hr caption".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
OUT = frozenset("nav header footer aside form menu dialog".split())
#: Words of a class, id or role that name a part as no content.
OUT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav\w*|menus?|breadcrumbs?|header|masthead|footer|foot|sidebars?|aside|widgets?|cookies?|consent|gdpr|notices?|alerts?|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|comments?|commentlist|replies|reply|disqus|respond|pagination|pager|copyright|search\w*|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
IN_WORDS = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|main|post|entry|story|text|body)(?:$|[\s_-])", re.I)
#: Elements whose start closes an open one, up to the element that bounds the search.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


@dataclass
class Node:
    """A block element: its children and the pieces of its own text, in page order."""

    tag: str
    label: str
    out: bool = False
    inside: bool = False
    parts: list = field(default_factory=list)  # str, or Node; a str that is not yet unescaped
    links: int = 0
    shape: tuple = ()
    size: int = 1
    number: int = 0

    @property
    def children(self) -> list[Node]:
        return [x for x in self.parts if isinstance(x, Node)]

    def texts(self) -> list[str]:
        """Own text by runs between child blocks, white space folded."""
        out, run = [], []
        for x in [*self.parts, None]:
            if isinstance(x, str):
                run.append(x)
            elif run:
                if t := " ".join(html.unescape("".join(run)).split()):
                    out.append(t)
                run = []
        return out


def _marks(tag: str, attributes: str) -> tuple[str, bool, bool]:
    names, hidden = [], False
    for name, value in _NAMES.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            names.append(value)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    named = " ".join(names)
    inside = tag in ("article", "main") or bool(named and IN_WORDS.search(named))
    out = tag in OUT or hidden or bool(named and tag not in ("article", "main", "body", "html") and OUT_WORDS.search(named))
    return f"{tag}.{named}" if named else tag, out, inside


def parse(page: str | None) -> Node:
    """The tree of block elements; inline markup is part of its block's text."""
    root = Node("#", "#")
    stack, skip, at, page = [root], "", 0, page or ""
    depth = 0  # of skipped elements
    out_inline: list[str] = []
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if not skip and not out_inline and m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        close, tag, attributes, end = m.groups()
        if tag is None:
            if not skip and page.startswith("<![CDATA[", m.start()):
                stack[-1].parts.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if skip:
            if tag == skip:
                depth += -1 if close else 0 if tag in RAW else 1
                if depth == 0:
                    skip = ""
            continue
        if not end:  # the page breaks off inside this tag
            continue
        if not close and tag in SKIPPED:
            if tag in RAW and not attributes.endswith("/"):
                # raw text: markup in it does not count
                e = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = e.end() if e else len(page)
            elif not attributes.endswith("/") and tag not in VOID:
                skip, depth = tag, 1
            continue
        if tag == "br" or tag == "wbr":
            stack[-1].parts.append(" " if tag == "br" else "")
        elif tag not in BLOCKS:
            if tag not in VOID:
                if close:
                    if out_inline and out_inline[-1] == tag:
                        out_inline.pop()
                elif out_inline:
                    out_inline.append(tag)
                elif attributes and _marks(tag, attributes)[1]:
                    out_inline.append(tag)
                elif tag == "a":
                    stack[-1].links += 1
        elif close:
            out_inline.clear()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("article", "main", "body") and tag in ("p", "li", "div", "span"):
                    break
        else:
            out_inline.clear()
            if stack[-1].tag == "p":
                stack.pop()
            if tag in CLOSES:
                closed, bounds = CLOSES[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in bounds:
                        break
                    if stack[k].tag in closed:
                        del stack[k:]
                        break
            label, out, inside = _marks(tag, attributes)
            node = Node(tag, label, out, inside)
            stack[-1].parts.append(node)
            if tag not in VOID:
                stack.append(node)
    if not skip and not out_inline and at < len(page):
        rest = page[at:]
        # "<" of a tag that breaks off is no text
        stack[-1].parts.append(re.sub(r"<[/!?a-zA-Z][^>]*\Z", "", rest, flags=re.S))
    _finish(root)
    return root


def _walk(root: Node) -> Iterator[Node]:
    """All nodes, parents first, in page order, without recursion."""
    todo = [root]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(reversed(n.children))


_shapes: dict[tuple, tuple] = {}


def _finish(root: Node) -> None:
    """Numbers in page order; size and shape (equal for equal structures) of each subtree."""
    every = list(_walk(root))
    for k, n in enumerate(every):
        n.number = k
    for n in reversed(every):
        kids = n.children
        n.size = 1 + sum(k.size for k in kids)
        n.shape = hash((n.label, *(k.shape for k in kids)))


def align(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes of a largest top-down, order-keeping match (simple tree matching)."""
    if a.label != b.label:
        return []
    weights: dict[tuple[int, int], int] = {}

    def weight(x: Node, y: Node) -> int:
        """Size of the best match of two subtrees."""
        todo = [(x, y, False)]
        while todo:
            p, q, ready = todo.pop()
            if (p.number, q.number) in weights:
                continue
            if p.label != q.label:
                weights[p.number, q.number] = 0
            elif p.shape == q.shape:
                weights[p.number, q.number] = p.size
            elif ready:
                weights[p.number, q.number] = 1 + table_of(p.children, q.children)[0]
            else:
                todo.append((p, q, True))
                i, j, k = trimmed(p.children, q.children)
                pc, qc = p.children[i : len(p.children) - k], q.children[i : len(q.children) - k]
                todo += [(c, d, False) for c in pc for d in qc if c.label == d.label]
        return weights[x.number, y.number]

    def trimmed(x: list[Node], y: list[Node]) -> tuple[int, int, int]:
        """Equal structures at both ends match each other in some best match."""
        i, n = 0, min(len(x), len(y))
        while i < n and x[i].shape == y[i].shape:
            i += 1
        k = 0
        while k < n - i and x[-1 - k].shape == y[-1 - k].shape:
            k += 1
        return i, i, k

    def table_of(x: list[Node], y: list[Node]) -> tuple[int, list[tuple[Node, Node]]]:
        i, _, k = trimmed(x, y)
        pairs = [*zip(x[:i], y[:i]), *(zip(x[len(x) - k :], y[len(y) - k :]) if k else ())]
        total = sum(p.size for p, _ in pairs)
        x, y = x[i : len(x) - k], y[i : len(y) - k]
        if not x or not y:
            return total, pairs
        rows = [[0] * (len(y) + 1)]
        for p in x:
            above, row = rows[-1], [0]
            for c, q in enumerate(y):
                w = weights.get((p.number, q.number), 0) if p.label == q.label else 0
                row.append(max(above[c + 1], row[c], above[c] + w if w else 0))
            rows.append(row)
        r, c = len(x), len(y)
        while r and c:
            if rows[r][c] == rows[r - 1][c]:
                r -= 1
            elif rows[r][c] == rows[r][c - 1]:
                c -= 1
            else:
                r, c = r - 1, c - 1
                pairs.append((x[r], y[c]))
        return total + rows[-1][-1], pairs

    weight(a, b)
    out, todo = [], [(a, b)]
    while todo:
        p, q = todo.pop()
        out.append((p, q))
        if p.shape == q.shape:
            todo += zip(p.children, q.children)
        else:
            pc, qc = p.children, q.children
            i, _, k = trimmed(pc, qc)
            for c in pc[i : len(pc) - k]:
                for d in qc[i : len(qc) - k]:
                    if c.label == d.label:
                        weight(c, d)
            todo += table_of(pc, qc)[1]
    return out


def slots(root: Node, region: int | None = None) -> list[tuple[Node, str]]:
    """(node, text) of the runs of text that are content unless template, in page order.

    ``region`` is the number of the node in which they are looked for, if a wrapper tells.
    """
    chosen = _articles(root) if region is None else _bounds(root, region)
    lines: list[tuple[Node, str]] = []
    # (node, or a text run with its node; whether inside the article)
    todo: list[tuple[object, bool]] = [(root, not chosen)]
    while todo:
        x, inside = todo.pop()
        if isinstance(x, tuple):
            lines.append(x)
            continue
        if x.out:
            continue
        inside = inside or x.number in chosen
        words = "".join(p for p in x.parts if isinstance(p, str))
        own = inside and (chosen or not _linky(x, words))
        todo_here: list[tuple[object, bool]] = []
        run: list[str] = []
        for p in [*x.parts, None]:
            if isinstance(p, str):
                run.append(p)
                continue
            if run and own and (t := " ".join(html.unescape("".join(run)).split())):
                todo_here.append(((x, t), True))
            run = []
            if p is not None:
                todo_here.append((p, inside))
        todo += reversed(todo_here)
    return lines


def content(found: list[tuple[Node, str]], template: set[int]) -> str:
    """Texts of the content blocks in page order, a line each; ``template`` has numbers of nodes."""
    return "\n".join(t for n, t in found if n.number not in template)


def _hash(*parts: str | int) -> int:
    """64 bits, signed, the same in every process."""
    h = xxhash.xxh3_64("\0".join(map(str, parts)).encode("utf-8", "surrogatepass")).intdigest()
    return h - (1 << 64) if h >> 63 else h


def paths(root: Node) -> dict[int, int]:
    """Hash of the path of labels, without the numbers in them, from the root to each node."""
    out, todo = {}, [(root, 0)]
    while todo:
        n, above = todo.pop()
        out[n.number] = here = _hash(above, re.sub(r"\d+", "0", n.label))
        todo += [(c, here) for c in n.children]
    return out


def layout(root: Node) -> int:
    """Hash of the set of paths of containers: blocks other than prose, down to the article.

    Parts that are out don't count: adverts and the like come and go between pages of one layout.
    """
    chosen, path, found = _articles(root), paths(root), set()
    todo = [root]
    while todo:
        n = todo.pop()
        if n.out or n.tag in PROSE:
            continue
        found.add(path[n.number])
        if n.number not in chosen:
            todo += n.children
    return _hash(*sorted(found))


def keys(root: Node, found: list[tuple[Node, str]]) -> dict[int, int]:
    """Hash of path and text of each node with text."""
    texts: dict[int, list[str]] = {}
    for n, t in found:
        texts.setdefault(n.number, []).append(t)
    path = paths(root) if texts else {}
    return {k: _hash(path[k], *t) for k, t in texts.items()}


def _linky(node: Node, words: str) -> bool:
    return node.links > 0 and len(words.split()) < 8 * node.links


def _articles(root: Node) -> set[int]:
    """Numbers of the article elements (else main, else parts named as content) that aren't inside a part that is out."""
    found: dict[str, set[int]] = {"article": set(), "main": set(), "named": set()}
    todo = [root]
    while todo:
        n = todo.pop()
        if n.out:
            continue
        if n.inside and n.tag not in ("body", "html"):
            found[n.tag if n.tag in found else "named"].add(n.number)
        todo += n.children
    return found["article"] or found["main"] or found["named"]


def _bounds(root: Node, region: int) -> set[int]:
    """The region, or the named articles around it, or those inside it."""
    named, around, inside = _articles(root), set(), set()
    todo: list[tuple[Node, tuple[int, ...], bool]] = [(root, (), False)]
    while todo:
        n, above, within = todo.pop()
        if n.number == region:
            around, within = named & {*above, n.number}, True
        elif within and n.number in named:
            inside.add(n.number)
        todo += [(c, (*above, n.number), within) for c in n.children]
    return around or inside or {region}


# wrappers: trees of containers


@dataclass
class Held:
    """What the pages aligned at a container hold in it: pages, those with text of its own, characters, and
    the text (as a hash) that most of them seem to have, with their number."""

    pages: int = 0
    texts: int = 0
    chars: int = 0
    text: int = 0
    same: int = 0

    def add(self, o: Held) -> None:
        self.pages, self.texts, self.chars = self.pages + o.pages, self.texts + o.texts, self.chars + o.chars
        if o.text == self.text:
            self.same += o.same
        elif o.same > self.same:
            self.text, self.same = o.text, o.same

    def varying(self) -> int:
        """Characters, unless most pages have the same."""
        return 0 if self.texts >= PAGES and self.same >= SHARE * self.texts else self.chars


def containers(root: Node) -> tuple[Node, list[Held], list[int]]:
    """The tree of containers (blocks other than prose, that aren't out), what each holds, and its number in
    the page. Text of prose counts for the container around it; lists of links count for nothing."""
    top = Node(root.tag, root.label)
    words: dict[int, list[str]] = {id(top): []}
    kinds: dict[int, str] = {id(top): ""}
    number = {id(top): root.number}
    todo: list[tuple[Node, Node]] = [(root, top)]
    while todo:
        n, at = todo.pop()
        for c in n.children:
            if c.out:
                continue
            if c.tag in PROSE:
                kind = "l" if c.tag in ("ul", "ol", "li", "dl", "dt", "dd") else "p"
                kinds[id(at)] = max(kinds[id(at)], kind)
                todo.append((c, at))
            else:
                new = Node(c.tag, c.label)
                words[id(new)], kinds[id(new)], number[id(new)] = [], "", c.number
                at.parts.append(new)
                todo.append((c, new))
        text = "".join(p if isinstance(p, str) else " " for p in n.parts).strip()
        if text and not _linky(n, text):
            words[id(at)].append(" ".join(text.split()))
    every = list(_walk(top))
    for n in every:
        # containers of prose, of lists and of neither don't match each other
        n.label += f"|{kinds[id(n)]}"
    _finish(top)
    held = []
    for n in every:
        found = sorted(words[id(n)])
        size = sum(map(len, found))
        held.append(Held(1, int(size > 0), size, _hash(*found) if size else 0, int(size > 0)))
    return top, held, [number[id(n)] for n in every]


class Wrapper:
    """The tree of a layout and what its pages hold by its nodes."""

    def __init__(self, tree: Node, held: list[Held]):
        self.tree, self.held = tree, held

    def add(self, tree: Node, held: list[Held]) -> None:
        for a, b in align(self.tree, tree):
            self.held[a.number].add(held[b.number])

    def region(self) -> int | None:
        """Number of the node of the layout's content, if enough pages tell."""
        if self.held[0].pages < PAGES:
            return None
        mass = [h.varying() for h in self.held]
        below = dict(enumerate(mass))
        for n in reversed(list(_walk(self.tree))):
            below[n.number] += sum(below[c.number] for c in n.children)
        n = self.tree
        while n.children and below[n.number]:
            h = self.held[n.number]
            # text of its own on most pages, as a heading beside its article: these are the bounds
            if h.texts >= h.pages / 2 and mass[n.number]:
                break
            best = max(n.children, key=lambda c: below[c.number])
            if below[best.number] < REGION * below[n.number]:
                break
            n = best
        return n.number if below[n.number] and n.tag not in ("#", "html", "body") else None

    def to_json(self) -> str:
        depth, rows, todo = 0, [], [(self.tree, 0)]
        while todo:
            n, depth = todo.pop()
            h = self.held[n.number]
            rows.append([depth, n.tag, n.label, h.pages, h.texts, h.chars, h.text, h.same])
            todo += [(c, depth + 1) for c in reversed(n.children)]
        return json.dumps(rows, ensure_ascii=False, separators=(",", ":"))

    @classmethod
    def from_json(cls, text: str) -> Wrapper:
        held, path = [], []
        for depth, tag, label, *counts in json.loads(text):
            n = Node(tag, label)
            held.append(Held(*counts))
            del path[depth:]
            if path:
                path[-1].parts.append(n)
            path.append(n)
        _finish(path[0])
        return cls(path[0], held)


_NAMED = ["host", "layout", "article", "block", "size", "wrapper"]
_KINDS = (pa.string(), *[pa.int64()] * 4, pa.string())


def _induced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_blocks`` finds in each page, and the wrappers (host, layout, wrapper) of all pages of a task."""
    known: dict[tuple[str, int], tuple[Wrapper, set[int]]] = {}
    remembered = 0

    def rows(blocks: set[tuple]) -> pa.RecordBatch:
        every = [(*b, None) for b in blocks]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in every], t) for i, t in enumerate(_KINDS)], names=_NAMED)

    def wrappers_of() -> pa.RecordBatch:
        every = [(h, k, None, None, None, w.to_json()) for (h, k), (w, _) in known.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in every], t) for i, t in enumerate(_KINDS)], names=_NAMED)

    for batch in batches:
        blocks = set()
        for name, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            root = parse(page)
            if not (found := slots(root)):
                continue
            frame, article, key, size = layout(root), _hash(content(found, set())), keys(root, found), {}
            for n, t in found:
                size[key[n.number]] = size.get(key[n.number], 0) + len(t)
            blocks |= {(name, frame, article, k, v) for k, v in size.items()}
            if (name, frame) not in known:
                known[name, frame] = Wrapper(*containers(root)[:2]), {article}
            elif article not in known[name, frame][1]:
                wrapper, articles = known[name, frame]
                wrapper.add(*containers(root)[:2])
                articles.add(article)
            else:
                continue
            remembered += 1
        yield rows(blocks)
        if len(known) > WRAPPERS or remembered > ARTICLES:
            yield wrappers_of()
            known.clear()
            remembered = 0
    yield wrappers_of()


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """The wrappers of one layout as one."""
    texts = sorted(group["wrapper"], key=lambda t: (-len(t), t))
    out = Wrapper.from_json(texts[0])
    for t in texts[1:]:
        other = Wrapper.from_json(t)
        out.add(other.tree, other.held)
    return pd.DataFrame({"host": group["host"].iloc[:1], "layout": group["layout"].iloc[:1], "wrapper": [out.to_json()], "region": pd.array([out.region()], "Int32")})


def host(url) -> F.Column:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return F.lower(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1))


def _beside(rows: DataFrame, small: DataFrame, on: list[str], how: str, *wide: str) -> DataFrame:
    """A join with a broadcast if ``small`` is small, else a shuffled one that splits hot hosts."""
    held = sized(small, *wide)
    return rows.join(held if held is not None else small, on, how)


def _constant(blocks: DataFrame, by: list[str]) -> DataFrame:
    """(*by, block): blocks of enough of the articles; ``blocks`` has each (*by, article, block) once."""
    articles = stage(blocks.select(*by, "article").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("articles")).where(F.col("articles") >= PAGES), "articles")
    same = blocks.groupBy(*by, "block").agg(F.count(F.lit(1)).alias("same")).where(F.col("same") >= PAGES)
    return stage(_beside(same, articles, by, "inner", "host").where(F.col("same") >= SHARE * F.col("articles")).select(*by, "block"), "constant")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template, layouts): hashes of the template blocks of each host that has any, and its layouts
    with a region as (layout, wrapper, region)."""
    arrow_limits(pages.sparkSession)
    by = ["host", "layout"]
    induced = stage(pages.select("host", "html").mapInArrow(_induced, "host string, layout long, article long, block long, size long, wrapper string"), "induced")
    # a hot layout's wrappers, one or a few a task, meet in two steps
    schema = "host string, layout long, wrapper string, region int"
    some = induced.where("wrapper IS NOT NULL").select(*by, "wrapper", F.pmod(F.xxhash64("wrapper"), F.lit(64)).alias("part"))
    merged = some.groupBy(*by, "part").applyInPandas(_merged, schema).groupBy(*by).applyInPandas(_merged, schema)
    layouts = merged.where("region IS NOT NULL").groupBy("host").agg(F.collect_list(F.struct("layout", "wrapper", "region")).alias("layouts"))
    found = induced.where("wrapper IS NULL").drop("wrapper")
    # layout 0 is the whole host
    found = found.withColumn("layout", F.explode(F.array(F.lit(0).cast("long"), "layout")))
    blocks = stage(found.groupBy(*by, "article", "block").agg(F.max("size").alias("size")), "blocks")
    constant = _constant(blocks, by)
    if not constant.isEmpty():
        # versions of one article agree but for a few words, so they would make it template: count them once
        marked = _beside(blocks, constant.withColumn("_constant", F.lit(True)), [*by, "block"], "left", "host")
        left = F.sum(F.when(F.col("_constant"), 0).otherwise(F.col("size")))
        versions = stage(marked.groupBy(*by, "article").agg(left.alias("left"), F.sum("size").alias("size")).where(F.col("left") < LEFT * F.col("size")).select(*by, "article", F.lit(True).alias("_version")), "versions")
        if not versions.isEmpty():
            once = F.when(F.col("_version"), F.lit(0)).otherwise(F.col("article"))
            blocks = _beside(blocks, versions, [*by, "article"], "left", "host").select(*by, once.alias("article"), "block").distinct()
            constant = _constant(blocks, by)
    # as many entries a host as blocks that most of its articles share
    return stage(constant.groupBy("host").agg(F.collect_set("block").alias("template")).join(layouts, "host", "full"), "wrappers")


_trees: dict[str, Node] = {}


def located(root: Node, layouts: list[dict] | None) -> int | None:
    """Number of the page's node that its layout's tree aligns with the region."""
    if not layouts:
        return None
    own = layout(root)
    for x in layouts:
        if x["layout"] == own:
            if x["wrapper"] not in _trees:
                if len(_trees) > 500:
                    _trees.clear()
                _trees[x["wrapper"]] = Wrapper.from_json(x["wrapper"]).tree
            tree, _, numbers = containers(root)
            return next((numbers[b.number] for a, b in align(_trees[x["wrapper"]], tree) if a.number == x["region"]), None)
    return None


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, template, layouts in zip(*(batch.column(c).to_pylist() for c in ("html", "template", "layouts"))):
            root = parse(page)
            found = slots(root, located(root, layouts))
            wanted = set(template or ())
            texts.append(content(found, {k for k, v in keys(root, found).items() if v in wanted} if wanted else set()))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    p = pages.select(F.col("page_id").cast("long"), "url", "html", host(F.col("url")).alias("host"))
    found = _beside(p, wrappers(p).withColumn("_wide", F.to_json("layouts")), ["host"], "left", "host", "_wide").drop("_wide")
    return found.select("page_id", "url", "html", "template", "layouts").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
