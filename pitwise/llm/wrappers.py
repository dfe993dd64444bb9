"""HTML extraction by wrapper induction.

Pages are parsed to DOM trees. A host's pages are grouped by layout (which kinds of parts they have, in which
order). Every page is aligned with its layout's reference pages (up to REFERENCES, by hash) by simple tree matching: two
nodes match if their tags do, and children are matched in order so that the number of matched nodes is greatest. It
votes for the references' texts that it has at their place; Spark counts the votes per (host, layout, reference, node). Texts
with the votes of AGREE of the voters (LEAST at least) are constant, and the reference with the most constant texts gives
the layout's template. The other texts are its slots. A voter is
a longest text that may be content, so an article that many pages copy, edited or not, has one vote, and parts that
are never content make no pages alike. The wrapper is the tree of the constant texts. Every page is aligned with it, and
text that equals the template's at its place is dropped.

Content is what is left of the page's article: its <article> elements, else <main> and the like, else
the body without blocks that are mostly links. Elements that are never content (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments of readers) are left out, told
by tag, role, or a class or id that names such a part as a whole. An article's own class names don't count.

Scale: all pages vote, with a few narrow rows each that are combined before their exchange; a host of any size is
spread over all tasks. References and wrappers travel with the tasks if proven small; otherwise pages are joined with
them by host and layout, which Spark splits if skewed.

Cases: trees are at most DEPTH deep, what is nested deeper stands side by side, so no page overruns the
stack. Between nodes with more than MATCH_CELLS pairs of children, children are paired from both ends as long as
they are alike, and by position between.

Chosen style: Python in Arrow batches, because alignment is a recursion over trees; Spark counts.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import BROADCAST_BYTES, arrow_map, key_column, materialize

AGREE, LEAST = 0.6, 4  # share of a layout's voters that have a text at a node, and their number
REFERENCES = 2  # pages of a layout that all others are aligned with
MATCH_CELLS = 4_000_000  # of one alignment; beyond, after equal ends are paired, children are aligned by position
DEPTH = 256  # of a tree; deeper elements are put side by side, as browsers do at twice that
REFERENCE_BYTES = BROADCAST_BYTES // 4  # reference pages or wrappers that travel with the tasks

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby
    s samp small span strike strong sub sup time tt u var wbr""".split())
CLOSES = {  # an opening tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
ENDS_P = frozenset("""address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header
    hr main menu nav ol p pre section table ul""".split())
SCOPES = frozenset("ul ol dl table article section div main body nav aside footer header form blockquote".split())

# What is never content.
DROP_TAGS = frozenset("""head script style noscript template iframe svg object nav footer aside form button select textarea
    input menu dialog title""".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
DROP_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie
    cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription nav navbar navigation
    menu breadcrumb breadcrumbs sidebar aside footer masthead comment comments reply replies disqus respond related
    recommended share sharing social widget widgets pagination pager toolbar skip login signup""".split())
# Words that only say where or how a part stands: with one of the words above they name such a part too.
PLACE_WORDS = frozenset("""a area bar block bottom box bottombar button buttons col column container content end fixed form group
    heading holder inner item items left links list main outer panel primary right row secondary section slot small start sticky
    text title top unit wrap wrapper""".split())
ARTICLE_WORDS = frozenset("article post entry story content main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_WORDS = re.compile(r"[a-z]+")


class Node:
    """An element, or a text node (tag `#`, text set). `drop`: never content."""

    __slots__ = ("_only", "_plain", "children", "drop", "mark", "tag", "text")

    def __init__(self, tag: str, text: str = "", mark: str = "", drop: bool = False):
        self.tag, self.text, self.mark, self.drop, self.children, self._plain, self._only = tag, text, mark, drop, [], None, None

    @property
    def only(self) -> str | bool:
        """The text of an element that holds nothing but one text; False for others."""
        if self._only is None:
            c = self.children
            self._only = c[0].plain if len(c) == 1 and c[0].tag == "#" else False
        return self._only

    @property
    def plain(self) -> str:
        """The text with single spaces."""
        if self._plain is None:
            self._plain = _plain(self.text)
        return self._plain


def _never_content(name: str) -> bool:
    """Whether a class or id as a whole names a part that is never content (`ad-slot`, not `notice-period`)."""
    words = _WORDS.findall(name)
    return any(w in DROP_WORDS for w in words) and all(w in DROP_WORDS or w in PLACE_WORDS for w in words)


def _element(tag: str, attributes: str) -> Node:
    attrs = {}
    if attributes:
        for m in _ATTR.finditer(attributes):
            attrs.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split() if attrs else []
    named = [w for name in names for w in _WORDS.findall(name)]
    role = attrs.get("role", "").lower()
    # Class names tell nothing against an element that is an article by its tag or role.
    drop = tag in DROP_TAGS or tag not in ("html", "body", "main", "article") and role not in ("main", "article") and (
        role in DROP_ROLES or any(map(_never_content, names)) or "hidden" in attrs
        or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower())
    mark = ""
    if tag == "article" or tag == "main" or role in ("main", "article"):
        mark = "article" if tag == "article" or role == "article" else "main"
    elif attrs.get("itemprop", "").lower() == "articlebody":
        mark = "main"
    elif tag in ("div", "section", "td") and ARTICLE_WORDS.intersection(named):
        mark = "named"
    return Node(tag, mark=mark, drop=drop)


def parse(html: str) -> Node:
    """The DOM tree of a page; unclosed and misnested tags end where HTML would end them."""
    root = Node("#root")
    stack, at, raw = [root], 0, ""

    def text(piece: str) -> None:
        if piece and not piece.isspace():
            stack[-1].children.append(Node("#", entities.unescape(piece)))
        elif piece:
            stack[-1].children.append(Node("#", " "))

    def close(tags, scopes=SCOPES) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scopes:
                return

    while at < len(html):
        if raw:
            m = re.compile(rf"</{raw}[\s/>]", re.I).search(html, at)
            end = m.start() if m else len(html)
            stack[-1].children.append(Node("#", html[at:end]))
            at, raw = end, ""
            if not m:
                break
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at: m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "p" or tag in INLINE:
                close({tag}, SCOPES | {"td", "th", "li"} - {tag})
            else:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        break
            continue
        if tag in ENDS_P:
            close({"p"})
        if tag in CLOSES:
            for other in CLOSES[tag]:
                close({other}, frozenset(("ul", "ol", "dl", "table")))
        attributes = m[3] or m[6] or ""
        node = _element(tag, attributes)
        stack[-1].children.append(node)
        if tag in VOID or attributes.endswith("/") and tag not in ("div", "p", "span", "a"):
            continue
        if len(stack) < DEPTH:
            stack.append(node)
        elif tag in RAW:
            stack.append(node)  # its text is no markup, and ends with it
        if tag in RAW:
            raw = re.escape(tag)
    return root


# --- simple tree matching --------------------------------------------------------------
def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Aligned node pairs of two trees with the same root tag, in order, greatest in number; equal texts count twice."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def size(x: Node, y: Node) -> int:
        if x.tag != y.tag:
            return 0
        if x.tag == "#":
            return 2 if x.plain == y.plain else 1
        if not x.children or not y.children:
            return 1
        key = id(x), id(y)
        if key not in memo:
            xs, ys = x.children, y.children
            if len(xs) * len(ys) > MATCH_CELLS:
                memo[key] = 1 + sum(size(p, q) for p, q in _by_place(xs, ys)), None
            else:
                table = [[0] * (len(ys) + 1)]
                others = [(q.tag, q.only, q) for q in ys]
                for p in xs:
                    above, row, best = table[-1], [0], 0
                    tag, only = p.tag, p.only
                    for j, (q_tag, q_only, q) in enumerate(others):
                        if above[j + 1] > best:
                            best = above[j + 1]
                        if tag == q_tag:
                            if only is False or q_only is False:
                                s = above[j] + size(p, q)
                            else:  # an element around one text, as most are
                                s = above[j] + (3 if only == q_only else 2)
                            if s > best:
                                best = s
                        row.append(best)
                    table.append(row)
                memo[key] = 1 + table[-1][-1], table
        return memo[key][0]

    out, todo = [], [(a, b)] if a.tag == b.tag else []
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if not x.children or not y.children:
            continue
        size(x, y)
        table, xs, ys = memo[id(x), id(y)][1], x.children, y.children
        if table is None:
            todo += [(p, q) for p, q in _by_place(xs, ys) if p.tag == q.tag]
            continue
        i, j = len(xs), len(ys)
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                todo.append((xs[i], ys[j]))
    return out


def _by_place(xs: list[Node], ys: list[Node]) -> list[tuple[Node, Node]]:
    """Children paired from both ends as long as their tags and texts agree, those between by position."""
    def same(x: Node, y: Node) -> bool:
        return x.tag == y.tag and (x.tag != "#" or x.plain == y.plain)

    n, head, tail = min(len(xs), len(ys)), 0, 0
    while head < n and same(xs[head], ys[head]):
        head += 1
    while tail < n - head and same(xs[-1 - tail], ys[-1 - tail]):
        tail += 1
    middle = zip(xs[head: len(xs) - tail], ys[head: len(ys) - tail], strict=False)
    ends = zip(xs[len(xs) - tail:], ys[len(ys) - tail:], strict=True)
    return [*zip(xs[:head], ys[:head], strict=True), *middle, *ends]


def _plain(text: str) -> str:
    return " ".join(text.split())


def _texts(node: Node) -> list[Node]:
    """Text nodes that may be content, in page order."""
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.tag == "#":
            if not x.text.isspace():
                out.append(x)
        elif not x.drop:
            todo.extend(reversed(x.children))
    return out


def equal_texts(reference: Node, tree: Node) -> list[int]:
    """Numbers (in the order of `_texts`) of the reference's texts that the aligned page has too."""
    number = {id(x): i for i, x in enumerate(_texts(reference))}
    return [number[id(x)] for x, y in match(reference, tree) if x.tag == "#" and id(x) in number and x.plain == y.plain]


def candidate(html: str) -> Node:
    """The tree of a page as it votes: parts that are never content are there, but empty."""
    tree = parse(html)
    todo = [tree]
    while todo:
        x = todo.pop()
        if x.drop:
            x.children = []
        todo.extend(x.children)
    return tree


def voter(tree: Node) -> str:
    """What a page votes as: its longest text that may be content. Copies of an article, edited or not, are one voter."""
    return max((x.plain for x in _texts(tree)), key=len, default="")


def wrapper_of(reference: str, constant: list[int]) -> str:
    """The wrapper as JSON, a flat list of (parent, tag, text): the reference's constant texts and their ancestors."""
    tree = candidate(reference)
    kept = {id(x) for i, x in enumerate(_texts(tree)) if i in set(constant)}
    order, parents, todo = [], {}, [tree]
    while todo:  # parents before children
        x = todo.pop()
        order.append(x)
        for c in x.children:
            parents[id(c)] = x
        todo.extend(reversed(x.children))
    needed = set()
    for x in order:
        if id(x) in kept:
            while x is not None and id(x) not in needed:
                needed.add(id(x))
                x = parents.get(id(x))
    at: dict[int, int] = {}
    out = []
    for x in order:
        if id(x) in needed:
            at[id(x)] = len(out)
            up = parents.get(id(x))
            out.append([-1 if up is None else at[id(up)], x.tag, x.plain if x.tag == "#" else ""])
    return json.dumps(out, separators=(",", ":")) if out else ""


def induce(pages: list[str]) -> str:
    """The wrapper of pages of one layout, the first ones being the references; "" without a template. As Spark counts it."""
    trees = [candidate(p) for p in pages]
    voters = len({voter(t) for t in trees})
    best: list[int] = []
    page = ""
    for i, reference in enumerate(trees[:REFERENCES]):
        votes: dict[int, set[str]] = {}
        for tree in trees:
            for node in equal_texts(reference, tree):
                votes.setdefault(node, set()).add(voter(tree))
        constant = [n for n, v in votes.items() if len(v) >= LEAST and len(v) >= AGREE * voters]
        if len(constant) > len(best):
            best, page = constant, pages[i]
    return wrapper_of(page, best) if best else ""


def _tree(data: list) -> Node:
    nodes = []
    for up, tag, text in data:
        nodes.append(Node(tag, text))
        if up >= 0:
            nodes[up].children.append(nodes[-1])
    return nodes[0]


# --- content ---------------------------------------------------------------------------
def _roots(tree: Node) -> tuple[list[Node], bool]:
    """The content elements, and whether they were found (else the whole page)."""
    found: dict[str, list[Node]] = {"article": [], "main": [], "named": []}
    todo = [(tree, "")]
    while todo:
        x, inside = todo.pop()
        if x.drop:
            continue
        if x.mark and x.mark not in inside:
            found[x.mark].append(x)
            inside += f" {x.mark}"
        todo.extend((c, inside) for c in reversed(x.children) if c.tag != "#")
    for mark in ("article", "main", "named"):
        if found[mark]:
            return found[mark], True
    return [tree], False


def _blocks(root: Node, template: set[int], articles: bool) -> list[str]:
    """The text of the blocks under `root`, in page order, without template text and what is never content."""
    out: list[str] = []
    piece: list[str] = []
    linked = total = 0

    def flush() -> None:
        nonlocal linked, total
        text = _plain("".join(piece))
        if text and (articles or 2 * linked <= total):
            out.append(text)
        piece.clear()
        linked = total = 0

    todo: list = [(root, False, False)]
    while todo:
        x, in_link, end = todo.pop()
        if end:
            flush()
        elif x.tag == "#":
            if id(x) not in template:
                piece.append(x.text)
                total += len(x.text.strip())
                linked += len(x.text.strip()) * in_link
        elif x is not root and (x.drop or x.tag == "header" and not (articles and any(c.tag in ("h1", "h2") for c in x.children))):
            if x.tag not in INLINE:
                flush()
        elif x.tag == "br":
            piece.append(" ")
        else:
            if x.tag not in INLINE:
                flush()
                todo.append((x, in_link, True))
            todo.extend((c, in_link or x.tag == "a", False) for c in reversed(x.children))
    flush()
    return out


def extract(html: str | None, wrapper: Node | None = None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    tree = parse(html)
    template = set()
    if wrapper is not None:
        template = {id(y) for x, y in match(wrapper, tree) if x.tag == "#" and x.plain == y.plain}
    roots, articles = _roots(tree)
    return " ".join(block for root in roots for block in _blocks(root, template, articles))


# --- on Spark ------------------------------------------------------------------------
def host(url):
    """The host of a URL column, lower case, without user and port; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def layout(html: Column) -> Column:
    """Pages of one layout have the same kinds of parts in the same order: their first appearances, as text."""
    parts = F.regexp_extract_all(html, F.lit(r"(?i)<(nav|header|main|article|section|aside|footer|form|table)[\s>]"), 1)
    return F.lower(F.array_join(F.array_distinct(F.transform(parts, F.lower)), " "))


def _located(pages: DataFrame, url_col: str, html_col: str, *columns: Column) -> DataFrame:
    html = key_column(html_col)
    return pages.select(*columns, host(key_column(url_col)).alias("host"), F.coalesce(layout(html), F.lit("")).alias("layout"),
                        html.alias("html"))


def _carried(df: DataFrame, column: str) -> dict | None:
    """{(host, layout): column} if all of `df` is proven small enough to travel with the tasks."""
    size = df.agg(F.sum(F.octet_length(column) + F.octet_length("host") + F.octet_length("layout") + 64)).first()[0] or 0
    if size > REFERENCE_BYTES:
        return None
    rows = df.select("host", "layout", column).toArrow()
    keys = zip(rows.column("host").to_pylist(), rows.column("layout").to_pylist(), strict=True)
    return dict(zip(keys, rows.column(column).to_pylist(), strict=True))


def _with(src: DataFrame, df: DataFrame, column: str, known: dict | None) -> DataFrame:
    """`src` with the column of its host and layout; null where it travels with the tasks."""
    if known is not None:
        return src.withColumn(column, F.lit(None).cast("string"))
    return src.join(df, ["host", "layout"], "left")


def references(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, layout, reference): of every layout with LEAST or more different pages, up to REFERENCES by hash, as a JSON array."""
    src = _located(pages, url_col, html_col).where("html is not null").withColumn("html_hash", F.xxhash64("html"))
    least = (src.select("host", "layout", "html_hash").distinct().groupBy("host", "layout")
             .agg(F.count("*").alias("n"), F.array_distinct(F.array(*[
                 F.min_by("html_hash", F.xxhash64("html_hash", F.lit(i))) for i in range(REFERENCES)])).alias("all"))
             .where(F.col("n") >= LEAST).select("host", "layout", F.explode("all").alias("html_hash")))
    least = materialize(least, "wrapper-least")
    size = least.agg(F.sum(F.octet_length("host") + F.octet_length("layout") + 40)).first()[0] or 0
    picked = src.join(F.broadcast(least) if size <= REFERENCE_BYTES else least, ["host", "layout", "html_hash"])
    return materialize(picked.groupBy("host", "layout", "html_hash").agg(F.min("html").alias("html")).groupBy("host", "layout").agg(
        F.to_json(F.sort_array(F.collect_list("html"))).alias("reference")), "wrapper-references")


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, layout, wrapper) of every layout of a host that has a template, by the votes of all its pages."""
    reference = references(pages, url_col, html_col)
    known = _carried(reference, "reference")
    src = _with(_located(pages, url_col, html_col).where("html is not null"), reference, "reference", known)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[tuple, list[Node]] = {}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("host", "layout", "ref", "node", "voter")}
            for of, kind, html, own in zip(*(batch.column(c) for c in ("host", "layout", "html", "reference")), strict=True):
                key = of.as_py(), kind.as_py()
                own = own.as_py() if known is None else known.get(key)
                if own is None:
                    continue
                if key not in trees:
                    if len(trees) >= 256:
                        trees.clear()
                    trees[key] = [candidate(p) for p in json.loads(own)]
                tree = candidate(html.as_py())
                votes = [(-1, -1)]  # the page as a voter
                votes += [(i, node) for i, t in enumerate(trees[key]) for node in equal_texts(t, tree)]
                out["host"] += [key[0]] * len(votes)
                out["layout"] += [key[1]] * len(votes)
                out["ref"] += [v[0] for v in votes]
                out["node"] += [v[1] for v in votes]
                out["voter"] += [xxhash.xxh64_intdigest(voter(tree).encode("utf-8", "replace")) - (1 << 63)] * len(votes)
            if out["host"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["host"], pa.string()), pa.array(out["layout"], pa.string()), pa.array(out["ref"], pa.int32()),
                     pa.array(out["node"], pa.int32()), pa.array(out["voter"], pa.int64())], names=list(out))

    votes = src.mapInArrow(vote, "host string, layout string, ref int, node int, voter long").distinct()
    counted = materialize(votes.groupBy("host", "layout", "ref", "node").agg(F.count("*").alias("n")), "wrapper-votes")
    voters = counted.where("node = -1").select("host", "layout", F.col("n").alias("voters"))
    constant = (counted.where((F.col("node") >= 0) & (F.col("n") >= LEAST)).join(voters, ["host", "layout"])
                .where(F.col("n") >= AGREE * F.col("voters")).groupBy("host", "layout", "ref").agg(F.collect_list("node").alias("nodes"))
                .groupBy("host", "layout").agg(F.max(F.struct(F.size("nodes"), -F.col("ref"), "ref", "nodes")).alias("best")))

    def build(batch: pa.RecordBatch) -> dict:
        rows = zip(*(batch.column(c).to_pylist() for c in ("reference", "ref", "nodes")), strict=True)
        return {"host": batch.column("host"), "layout": batch.column("layout"),
                "wrapper": pa.array([wrapper_of(json.loads(pages)[i], nodes) for pages, i, nodes in rows], pa.string())}

    found = reference.join(constant, ["host", "layout"]).select("host", "layout", "reference", "best.ref", "best.nodes")
    return arrow_map(found, build, "host string, layout string, wrapper string").where("wrapper <> ''")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points).

    Null and empty html give an empty text. Pages without a host (null or relative url) are of one host.
    Layouts with fewer than LEAST different pages have no wrapper; their pages are extracted by
    element alone. Repeated rows stay repeated; an empty table gives no rows; other columns are not read.
    """
    learned = materialize(wrappers(pages, url_col, html_col), "wrappers")
    known = _carried(learned, "wrapper")
    src = _with(_located(pages, url_col, html_col, key_column(id_col).alias("page_id"), key_column(url_col).alias("url")),
                learned, "wrapper", known)

    def run(batch: pa.RecordBatch) -> dict:
        trees: dict[tuple, Node] = {}
        texts = []
        for of, kind, html, wrapper in zip(*(batch.column(c) for c in ("host", "layout", "html", "wrapper")), strict=True):
            key = of.as_py(), kind.as_py()
            own = wrapper.as_py() if known is None else known.get(key)
            if own and key not in trees:
                trees[key] = _tree(json.loads(own))
            texts.append(extract(html.as_py(), trees.get(key)))
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array(map(len, texts), pa.int64())}

    kind = src.schema["page_id"].dataType.simpleString()
    return arrow_map(src, run, f"page_id {kind}, url string, text string, n_chars long")
