"""Main text of web pages with the help of site style trees.

All pages of a host are laid over each other, equal pages once. A node of this tree is a
path of elements (tag and classes, with a number for repeated containers). The content of
a node are its features: each word of a short text, and longer texts as wholes. A feature
that stands on k of the host's m pages has the importance 1 - log k / log m: 1 on a single
page, 0 on all. A node's importance is composed from below as in a site style tree: of its
own features, of its children, and of the entropy of its presentation (the sequence of its
children; pages without the node are a value of their own), which counts the more the more
children there are. A branch is unimportant if it and everything below it are, compared
with the content of the host's whole pages.

Of an unimportant branch a page loses only what is the site's own there: the branch is cut
from a page if at least three quarters of its words on that page, in an article all of
them, belong to features that are unimportant themselves; in an article such features must
stand on most pages of the host. Elements that say by their tag or class that they are
menus, adverts, comments and the like are cut always. What is left of the article
(``article`` or ``main``; the body where a page has none) is the main text.

The features are counted by Spark from one row per page, node and feature; what is composed
per host is one row per node. The unimportant branches are broadcast if their size, which is
added up first, is within ``BROADCAST_BYTES``; else they meet the pages in a join on the host.

Defined cases: null or empty html has no text; a null url is a host of its own; a host
with fewer than ``MIN_PAGES`` different pages has no branches to cut; repeated rows are
returned once each; unclosed and misnested elements are closed as browsers do in common
cases; other columns are ignored whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.url_filters import host_and_path
from tracklane.session import settle

MIN_PAGES = 8
#: Importance below this share of the whole pages' own is the site's, not the page's. So many
#: of a block's words may differ from the site's outside articles.
LEAST_IMPORTANCE = 0.25
#: Weight that each child takes from its parent's presentation.
DAMPING = 0.9
BROADCAST_BYTES = 8 << 20
#: Texts of at most so many words are compared word by word.
SHORT_WORDS = 12
#: Features on fewer pages are never the site's: MIN_PAGES ** (1 - LEAST_IMPORTANCE), rounded down.
LEAST_REPEATS = 4

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript template svg math".split())
#: Of these, the ones that may be empty (``<svg/>``) and do not hide a page they are left open in.
FOREIGN = frozenset({"svg", "math"})
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: What a start tag closes: the nearest of these that is open, up to a container.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "h1": {"p"}, "h2": {"p"},
    "h3": {"p"}, "h4": {"p"}, "h5": {"p"}, "h6": {"p"}, "div": {"p"}, "ul": {"p"}, "ol": {"p"},
    "table": {"p"}, "section": {"p"}, "article": {"p"}, "blockquote": {"p"}, "pre": {"p"},
    "form": {"p"}, "nav": {"p"}, "footer": {"p"}, "header": {"p"}, "aside": {"p"}, "hr": {"p"},
}
CONTAINERS = frozenset(
    "html body div section article main aside nav header footer ul ol dl table form td th "
    "blockquote".split()
)
MAIN = frozenset({"article", "main"})
#: Elements and words in class, id or role of what is never part of an article.
OUTSIDE_TAGS = frozenset(
    "head nav footer aside form button select dialog menu script style textarea title iframe "
    "noscript template svg math object audio video canvas".split()
)
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead comment comments reply replies respond disqus share sharing social related "
    "recommended widget form search login signup copyright pagination toolbar complementary "
    "contentinfo".split()
)
#: Headers are outside, but an article's own is part of it.
HEADER_WORDS = frozenset({"header"})

_TAG = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")


class _Node:
    __slots__ = ("tag", "path", "outside", "main", "children", "last")

    def __init__(self, tag: str, path: str, outside: bool, main: bool):
        self.tag, self.path, self.outside, self.main = tag, path, outside, main
        self.children: dict[str, int] = {}
        self.last = ""


def walk(page: str) -> Iterator[tuple[str, list[_Node], str]]:
    """The page in order as ("open" | "close" | "break" | "text", open elements, text)."""
    stack = [_Node("", "", False, False)]
    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        if found is None:
            yield "text", stack, page[at:]
            return
        if found.start() > at:
            yield "text", stack, page[at : found.start()]
        at = found.end()
        tag = found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    while len(stack) > k:
                        yield "close", stack, ""
                        stack.pop()
                    break
                # an inline element is not closed across a container's border, and so on
                if stack[k].tag in CONTAINERS and tag not in CONTAINERS:
                    break
            if tag == "p":
                yield "break", stack, ""
            continue
        if tag in CLOSES:
            closes = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    while len(stack) > k:
                        yield "close", stack, ""
                        stack.pop()
                    break
                if stack[k].tag in CONTAINERS and stack[k].tag not in closes:
                    break
        if tag in VOID:
            if tag not in INLINE:
                yield "break", stack, ""
            continue
        if tag in RAW:
            if tag in FOREIGN and found[3].endswith("/"):
                continue
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            if end or tag not in FOREIGN:
                at = end.end() if end else size
            continue
        node = _element(tag, found[3], stack[-1])
        stack.append(node)
        yield "open", stack, ""


def _element(tag: str, attributes: str, parent: _Node) -> _Node:
    label, outside = tag, parent.outside or tag in OUTSIDE_TAGS
    if attributes and "=" in attributes:
        shown = _CLASS.search(attributes)
        if shown:
            names = (shown[1] or shown[2] or shown[3] or "").strip()
            label += "." + _DIGITS.sub("0", names).replace("/", ":")
        # of articles, only those inside another may be readers' comments
        if (tag not in MAIN or parent.main) and tag not in ("html", "body"):
            words = {
                word
                for m in _NAMES.finditer(attributes)
                for word in _SPLIT.split((m[1] or m[2] or m[3] or "").lower())
            }
            outside |= not words.isdisjoint(OUTSIDE_WORDS)
            outside |= not parent.main and not words.isdisjoint(HEADER_WORDS)
    if tag == "header" and not parent.main:
        outside = True
    parent.last = label
    if tag in CONTAINERS and tag not in ("td", "th"):
        number = parent.children[label] = parent.children.get(label, 0) + 1
        if number > 1:
            label += f"[{number}]"
    main = parent.main or (tag in MAIN and not outside)
    return _Node(tag, f"{parent.path}/{label}", outside, main)


def _squeezed(parts: list[str]) -> str:
    text = "".join(parts)
    if "&" in text:
        text = html.unescape(text)
    return " ".join(text.split())


def _features(path: str, text: str) -> Iterator[tuple[int, int]]:
    """(hash of path and feature, words) of a text directly below a node."""
    words = text.split()
    for feature in words if len(words) <= SHORT_WORDS else [" ".join(words)]:
        key = f"{path}\0{feature}".encode("utf-8", "surrogatepass")
        size = 1 if len(words) <= SHORT_WORDS else len(words)
        yield xxhash.xxh3_64_intdigest(key) - (1 << 63), size


def _leaf(stack: list[_Node]) -> _Node:
    """The element a text belongs to: the nearest that is not inline."""
    return next(node for node in reversed(stack) if node.tag not in INLINE)


def _branches_to_drop(page: str, cut: frozenset[str], site: frozenset[int]) -> set[int]:
    """Of the elements in order, those in ``cut`` whose words are the site's on this page."""
    drop: set[int] = set()
    # depth, number, words, words that are not the site's, in an article
    count, open_cuts, done = 0, [], []
    for kind, stack, text in walk(page):
        node = stack[-1]
        if kind == "open":
            count += 1
            if node.path in cut and node.tag not in MAIN:
                open_cuts.append([len(stack), count, 0, 0, node.main])
        elif kind == "text" and open_cuts and not node.outside and not text.isspace():
            for value, words in _features(_leaf(stack).path, text):
                for branch in open_cuts:
                    branch[2] += words
                    branch[3] += words if value not in site else 0
        elif kind == "close" and open_cuts and open_cuts[-1][0] == len(stack):
            done.append(open_cuts.pop())
    for _, number, words, own, main in done + open_cuts:
        if own <= (0 if main else LEAST_IMPORTANCE * words):
            drop.add(number)
    return drop


def main_text(page: str | None, cut: Iterable[str] = (), site: Iterable[int] = ()) -> str:
    """Blocks of the page's article without the branches whose paths are in ``cut`` and whose
    words are those of the features in ``site``."""
    page, cut = page or "", frozenset(cut)
    drop = _branches_to_drop(page, cut, frozenset(site)) if cut else ()
    inside: list[str] = []
    whole: list[str] = []
    held: list[str] = []
    held_main, has_main, dropped, count = False, False, 0, 0

    def flush() -> None:
        if held:
            block = _squeezed(held)
            if block:
                whole.append(block)
                if held_main:
                    inside.append(block)
            held.clear()

    for kind, stack, text in walk(page):
        node = stack[-1]
        if kind == "text":
            if not node.outside and not dropped:
                held.append(text)
                held_main = node.main
        elif kind == "break":
            flush()
        else:
            if node.tag not in INLINE:
                flush()
            if kind == "open":
                count += 1
                has_main |= node.main
                if dropped or count in drop:
                    dropped += 1
            elif dropped:
                dropped -= 1
    flush()
    return "\n".join(inside if has_main else whole)


def _measured(page: str | None) -> tuple[
    dict[str, tuple[int, int, int]], dict[str, int], dict[tuple[str, int, bool], int], int
]:
    """What a page adds to its site's tree, without what is outside: its containers as in
    style_nodes, path -> number of its other blocks, (path, feature, in an article) -> words,
    and the hash of the whole."""
    styles: dict[str, int] = {"": 0}
    numbers: dict[str, int] = {"": 1}
    counts: dict[str, int] = {"": 0}
    blocks: dict[str, int] = {}
    features: dict[tuple[str, int, bool], int] = {}
    whole, mask = 0, (1 << 64) - 1
    for kind, stack, text in walk(page or ""):
        node = stack[-1]
        if node.outside:
            continue
        if kind == "open":
            parent = stack[-2]
            label = xxhash.xxh3_64_intdigest(
                node.path[len(parent.path) + 1 :].encode("utf-8", "surrogatepass")
            )
            styles[parent.path] = (styles.get(parent.path, 0) * 1000003 + label) & mask
            counts[parent.path] = counts.get(parent.path, 0) + 1
            whole = (whole * 1000003 + label) & mask
            if node.tag in CONTAINERS:
                styles.setdefault(node.path, 0)
                counts.setdefault(node.path, 0)
                numbers[node.path] = numbers.get(node.path, 0) + 1
            elif node.tag not in INLINE:
                blocks[node.path] = blocks.get(node.path, 0) + 1
        elif kind == "close":
            whole = (whole * 1000003 + 1) & mask
        elif kind == "text" and not text.isspace():
            number = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
            whole = (whole * 1000003 + number) & mask
            leaf = _leaf(stack)
            for value, words in _features(leaf.path, text):
                key = (leaf.path, value, leaf.main)
                features[key] = features.get(key, 0) + words
    nodes = {path: (styles[path] - (1 << 63), n, counts[path]) for path, n in numbers.items()}
    return nodes, blocks, features, whole - (1 << 63)


def style_nodes(page: str | None) -> dict[str, tuple[int, int, int]]:
    """path -> (hash of the children's sequence, number of such nodes, number of children)
    for the containers that could be cut from the page; "" stands for the whole page."""
    return _measured(page)[0]


#: Kinds of rows about a page: a container's presentation, another block, a feature, and a
#: feature in an article.
STYLE, BLOCK, FEATURE, ARTICLE_FEATURE = range(4)
#: A page's share in a node's features is counted in parts of this.
PARTS = 1 << 20


def _page_rows(page: str | None) -> Iterator[tuple]:
    """path, kind, value, page (its hash), part, words, children."""
    nodes, blocks, features, whole = _measured(page)
    for path, (style, n, children) in nodes.items():
        yield path, STYLE, style, whole, n, 0, children
    for path, n in blocks.items():
        yield path, BLOCK, 0, whole, n, 0, 0
    totals: dict[str, int] = {}
    for (path, _, _), words in features.items():
        totals[path] = totals.get(path, 0) + words
    for (path, value, main), words in features.items():
        kind = ARTICLE_FEATURE if main else FEATURE
        yield path, kind, value, whole, PARTS * words // totals[path], words, 0


def site_trees(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """host, path, kind, value, k (pages with it), and sums over pages: k, k log k, part,
    part log k, words, words log k, children. Values on fewer than LEAST_REPEATS pages are
    added up as one null value for each node."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        names = ["host", "path", "kind", "value", "page", "part", "words", "children"]
        for batch in batches:
            out: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                out += [(host, *row) for row in _page_rows(page.as_py())]
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    found = pages.select(host_and_path(F.col(url_col))[0].alias("host"), F.col(html_col)).mapInArrow(
        rows,
        "host string, path string, kind int, value long, page long, part long, words long, "
        "children long",
    )
    k = F.col("k").cast("double")
    repeated = (F.col("k") >= LEAST_REPEATS) & (F.col("kind") >= FEATURE)
    return (
        found.distinct()  # equal pages count once
        .groupBy("host", "path", "kind", "value")
        .agg(F.count("*").alias("k"), *[F.sum(c).alias(c) for c in ("part", "words", "children")])
        .withColumn("k_log", k * F.log(k))
        .withColumn("part_log", F.col("part") * F.log(k))
        .withColumn("words_log", F.col("words") * F.log(k))
        .withColumn("value", F.when(repeated, F.col("value")))
        .groupBy("host", "path", "kind", "value")
        .agg(*[
            F.sum(c).alias(c)
            for c in ("k", "k_log", "part", "part_log", "words", "words_log", "children")
        ])
    )


def _compose(tree: pd.DataFrame) -> pd.DataFrame:
    """One host's nodes (host, path and sums) -> host, pages, least, path of what may be cut."""
    host, found = tree["host"].iloc[0], []
    nodes = {row.path: row for row in tree.itertuples(index=False)}
    m = int(nodes[""].k)
    words = tree["words"].sum()
    least = 0.0
    if m >= MIN_PAGES and words:
        log_m = math.log(m)
        least = LEAST_IMPORTANCE * (1 - tree["words_log"].sum() / words / log_m)
        below: dict[str, list[float]] = {}  # importances times numbers, numbers, the highest
        for path in sorted(nodes, key=lambda p: (-p.count("/"), p)):
            node = nodes[path]
            total, number, highest = below.pop(path, (0.0, 0.0, 0.0))
            if node.part:
                own = max(0.0, 1 - node.part_log / node.part / log_m)
                total, number = total + own * node.part / PARTS, number + node.part / PARTS
                highest = max(highest, own)
            importance = total / number if number else 0.0
            if node.children:
                lacking = m - node.k
                lost = lacking * math.log(lacking) if lacking > 0 else 0.0
                presentation = max(0.0, 1 - (node.k_log + lost) / m / log_m)
                damped = DAMPING ** (node.children / node.n)
                importance = (1 - damped) * presentation + damped * importance
            highest = max(highest, importance)
            if path and node.box and node.k >= MIN_PAGES and highest < least:
                found.append(path)
            above = path
            while above:
                above = above.rpartition("/")[0]
                if above in nodes:  # inline elements are not nodes
                    was = below.setdefault(above, [0.0, 0.0, 0.0])
                    was[0] += importance * node.n
                    was[1] += node.n
                    was[2] = max(was[2], highest)
                    break
    return pd.DataFrame(
        {"host": host, "pages": m, "least": least, "path": found},
        columns=["host", "pages", "least", "path"],
    ).astype({"host": object, "path": object})  # not Arrow's, which Spark does not take back


def site_cuts(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Per host with branches to cut: host, cut (their paths), site (features to cut there)."""
    trees = settle(site_trees(pages, url_col, html_col))

    def of(name: str, *kinds: int):
        return F.coalesce(F.sum(F.when(F.col("kind").isin(*kinds), F.col(name))), F.lit(0))

    features = (FEATURE, ARTICLE_FEATURE)
    paths = (
        trees.groupBy("host", "path")
        .agg(
            of("k", STYLE).alias("k"), of("k_log", STYLE).alias("k_log"),
            of("part", STYLE, BLOCK).alias("n"), of("children", STYLE).alias("children"),
            (F.min("kind") == STYLE).alias("box"),
            *[of(c, *features).alias(c) for c in ("part", "part_log", "words", "words_log")],
        )
        .groupBy("host")
        .applyInPandas(_compose, "host string, pages long, least double, path string")
    )
    cuts = settle(
        paths.groupBy("host", "pages", "least").agg(F.sort_array(F.collect_list("path")).alias("cut"))
    )
    importance = 1 - F.log(F.col("k").cast("double")) / F.log(F.col("pages").cast("double"))
    site = (
        trees.where((F.col("kind") >= FEATURE) & F.col("value").isNotNull())
        .select("host", "kind", "value", "k")
        .join(_broadcast_if_small(cuts.select("host", "pages", "least"), F.lit(24)), "host")
        .where(importance < F.col("least"))
        .where((F.col("kind") == FEATURE) | (2 * F.col("k") > F.col("pages")))
        .groupBy("host")
        .agg(F.sort_array(F.collect_set("value")).alias("site"))
    )
    return cuts.join(site, "host").select("host", "cut", "site")


def _broadcast_if_small(df: DataFrame, row_bytes: Column) -> DataFrame:
    """``df``, which is settled, to be broadcast if its rows and 64 bytes each are few enough."""
    size = df.agg(F.sum(row_bytes + F.length("host") + 64)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    cuts = _broadcast_if_small(
        settle(site_cuts(pages, url_col, html_col)),
        F.length(F.col("cut").cast("string")) + 8 * F.size("site"),
    )
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.col(html_col).alias("html"), host_and_path(F.col(url_col))[0].alias("host"),
    ).join(cuts, "host", "left").select("page_id", "url", "html", "cut", "site")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), cut.as_py() or (), site.as_py() or ())
                for page, cut, site in zip(*batch.columns[2:5], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
