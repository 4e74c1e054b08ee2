"""Main text of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slackline.functions.joins import lookup_join
from slackline.llm.common import stored

LEAST_PAGES = 4
SECTION_PAGES = 20
#: Skeletons that one task aligns.
BATCH = 500
#: Share of a group's pages that hold a template node, and of two skeletons' nodes that align.
NEARLY = 0.9
SAME_LAYOUT = 0.7

LANG = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]+)", re.IGNORECASE)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)|[^<]+|<",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
BLOCK_BUT_P = BLOCK - {"p"}
LISTS = {"ul", "ol", "dl", "table", "menu", "select"}
CELLS = {"td", "th"}
#: Elements that end when one of the same kind begins.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": CELLS, "th": CELLS, "option": {"option"}}
SKIP = set(
    "head script style template noscript iframe svg math canvas object nav footer aside form button "
    "select textarea dialog menu title xmp noembed noframes search audio video map".split()
)
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
LABELS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|cookies?|consent|gdpr"
    r"|notices?|alert|nav|navbar|navigation|menu|sidebar|side-bar|aside|footer|header|masthead|breadcrumbs?|share|sharing"
    r"|social|related|recommended|comments?|disqus|repl(?:y|ies)|responses|discussion|newsletter|subscribe|subscription|popup"
    r"|modal|overlay|pagination|pager|widget|login|signup|search|skip-link|toolbar|copyright)(?:$|[\s_-])",
    re.IGNORECASE,
)


#: Labels that cut a part of an article: whole class names or ids, not words within them.
PARTS = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promo(?:tion|s)?|banner|cookies?|consent|gdpr"
    r"|notices?|nav|navbar|navigation|menu|sidebar|side-bar|footer|masthead|breadcrumbs?|share|sharing|social|related"
    r"|recommended|comments?|disqus|repl(?:y|ies)|responses|discussion|newsletter|subscribe|subscription|popup|modal|overlay"
    r"|pagination|pager|widget|login|signup|search|skip-link|toolbar|copyright)"
    r"(?:[_-](?:section|list|area|form|thread|box|slot|container|unit|banner|wrapper|block|buttons?|bar|links?|icons?|media"
    r"|posts?|articles?|stories|items?|content|notice|signup|menu|nav|widget|panel|inline|top|bottom|left|right|side|0))*",
    re.IGNORECASE,
)
COMMENTS = re.compile(r"(?:comments?|repl(?:y|ies)|responses?|disqus)(?:[_-].*)?", re.IGNORECASE)
#: Signs of a path that are shown with a template node.
SHOWN = 16


class Paths:
    """The block paths of a page as a tree: a path is a number, known by its parent and last sign."""

    def __init__(self) -> None:
        self.parents, self.signs, self.hashes = [-1], ["#"], [_hash("#")]
        self.known: dict[tuple[int, str], int] = {}

    def step(self, parent: int, sign: str) -> int:
        at = self.known.get((parent, sign))
        if at is None:
            at = self.known[parent, sign] = len(self.signs)
            self.parents.append(parent)
            self.signs.append(sign)
            self.hashes.append(_hash(str(self.hashes[parent]), sign))
        return at

    def shown(self, path: int) -> str:
        """The last signs of a path."""
        signs: list[str] = []
        while path >= 0 and len(signs) < SHOWN:
            signs.append(self.signs[path])
            path = self.parents[path]
        return "/".join(reversed(signs))

    def shape(self, paths: list[int]) -> dict[str, list]:
        """The paths in the order of their first place, and what leads to them, numbered anew."""
        number: dict[int, int] = {-1: -1}
        parents: list[int] = []
        signs: list[str] = []
        for path in paths:
            new = []
            while path not in number:
                new.append(path)
                path = self.parents[path]
            for one in reversed(new):
                number[one] = len(signs)
                parents.append(number[self.parents[one]])
                signs.append(self.signs[one])
        return {"parents": parents, "signs": signs, "order": [number[p] for p in paths]}


class Node:
    __slots__ = ("tag", "label", "skip", "children", "parent", "path", "inside", "paths")

    def __init__(self, tag: str, label: str = "", skip: bool = False, parent: Node | None = None) -> None:
        self.tag, self.label, self.skip, self.parent = tag, label, skip, parent
        self.children: list = []
        if parent is None:
            self.paths, self.path, self.inside = Paths(), 0, False
        else:
            self.paths = parent.paths
            self.path = self.paths.step(parent.path, self.sign()) if tag in BLOCK else parent.path
            self.inside = parent.inside or parent.tag in ("article", "main")

    def sign(self) -> str:
        return f"{self.tag}.{self.label}" if self.label else self.tag


def parse(html: str) -> Node:
    """A tree of elements and decoded strings. Unclosed and cut-off pages give what is there."""
    root = here = Node("#")
    pos, size = 0, len(html)
    opened: Counter = Counter()
    while pos < size:
        m = TOKEN.match(html, pos)
        pos = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                here.children.append(unescape(m[0]))
            elif m[0].startswith("<![CDATA["):
                here.children.append(m[0][9:].removesuffix("]]>"))
            continue
        if not m[4]:
            break  # the page ends inside a tag
        tag = tag.lower()
        if m[1]:
            if opened[tag]:  # else it closes nothing
                here = _left(here, _close(here, tag), opened)
            continue
        if tag in BLOCK and tag != "html" and tag != "body" and opened["p"]:
            here = _left(here, _end_open(here, {"p"}, BLOCK_BUT_P), opened)
        if tag in ENDS:
            here = _left(here, _end_open(here, ENDS[tag], LISTS), opened)
        node = _element(tag, m[3], here)
        here.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(html, pos)
            body = html[pos : end.start() if end else size]
            if tag not in ("script", "style"):
                node.children.append(unescape(body))
            pos = end.end() if end else size
        elif tag not in VOID and not m[3].endswith("/"):
            here = node
            opened[tag] += 1
    return root


def _left(here: Node, there: Node, opened: Counter) -> Node:
    """``there``, an ancestor of ``here``, after the elements between them have ended."""
    while here is not there:
        opened[here.tag] -= 1
        here = here.parent
    return there


def _element(tag: str, attributes: str, parent: Node) -> Node:
    named: dict[str, str] = {}
    if attributes and not attributes.isspace():
        for a in ATTRIBUTE.finditer(attributes):
            named.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
    label = " ".join(x for x in (named.get("class", ""), named.get("id", "")) if x)
    label = " ".join(re.sub(r"\d+", "0", label).split())
    skip = (
        tag in SKIP
        or tag == "header" and not (parent.inside or parent.tag in ("article", "main"))
        or named.get("role", "").lower() in ROLES
        or "hidden" in re.sub(r"=\s*(?:\"[^\"]*\"|'[^']*'|\S+)", "", attributes).lower().split()
        or bool(label) and _telling(tag, label, parent)
    )
    return Node(tag, label, skip, parent)


def _telling(tag: str, label: str, parent: Node) -> bool:
    """Whether class or id tell of a part that is no content.

    Outside articles any word of them does. An article itself is only cut as a reader comment,
    and what is inside one only by a whole name: ``comments`` or ``related-posts``, but not
    ``article-header`` or ``related-work``.
    """
    if tag in ("html", "body", "main"):
        return False
    if tag == "article":
        return any(map(COMMENTS.fullmatch, label.split()))
    if parent.inside or parent.tag in ("article", "main"):
        return any(map(PARTS.fullmatch, label.split()))
    return LABELS.search(label) is not None


def _end_open(here: Node, tags: set[str], stop: set[str]) -> Node:
    node = here
    while node.parent is not None and node.tag not in stop - tags:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return here


def _close(here: Node, tag: str) -> Node:
    node = here
    while node.parent is not None:
        if node.tag == tag:
            return node.parent
        if tag not in BLOCK and tag not in CELLS and node.tag in BLOCK:
            return here  # an inline end tag closes nothing outside its block
        node = node.parent
    return here


def content_roots(root: Node) -> list[Node]:
    """The outermost articles outside skipped parts, else ``main``, else the whole page."""
    for wanted in ("article", "main"):
        found: list[Node] = []
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag == wanted:
                found.append(node)
            else:
                stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.skip)
        if found:
            return found
    return [root]


def blocks(root: Node, everything: bool = False) -> list[tuple[int, str]]:
    """(path, text) of every block with text below ``root``, in page order.

    Skipped parts are left out unless ``everything``; scripts and styles always are.
    """
    out: list[tuple[int, str]] = []
    held: list[str] = []
    where = root.path

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((where, text))

    stack: list = [root]
    while stack:
        item = stack.pop()
        if isinstance(item, int):  # the end of a block: what follows belongs to its parent
            flush()
            where = item
        elif isinstance(item, str):
            held.append(item)
        elif item.tag == "br" or item.tag in CELLS:
            held.append(" ")
            stack.extend(reversed(item.children))
        elif everything or not item.skip or item is root:
            if item.tag in BLOCK or item is root:
                flush()
                stack.append(where)
                where = item.path
            stack.extend(reversed(item.children))
    flush()
    return out


class Slot:
    """A run of equal siblings: their texts, and their children as one sequence of slots."""

    __slots__ = ("sign", "texts", "slots")

    def __init__(self, sign: str) -> None:
        self.sign, self.texts, self.slots = sign, set(), []


def skeleton(shape: dict[str, list]) -> Slot:
    """The tree of block paths (``Paths.shape``); neighbours of equal sign are one repeated slot."""
    top = Slot("")
    way: list[int] = []  # the paths from the top to the last slot, and their slots
    last: dict[int, Slot] = {-1: top}
    for path in shape["order"]:
        new, at = [], path
        while at not in last:
            new.append(at)
            at = shape["parents"][at]
        while way and way[-1] != at:
            del last[way.pop()]
        for one in reversed(new):
            here = last[shape["parents"][one]]
            here.slots.append(Slot(shape["signs"][one]))
            last[one] = here.slots[-1]
            way.append(one)
    return top


def match(a: Slot, b: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
    """Simple tree matching: the largest alignment of equal nodes that keeps order and depth.

    Pairs wait on a list until the pairs below them are done, so trees may be of any depth.
    """
    if a.sign != b.sign:
        return 0, []
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def inner(x: Slot, y: Slot) -> int:
        return tables[id(x), id(y)][-1][-1] + 1 if x.sign == y.sign else 0

    waiting = [(a, b, False)]
    while waiting:
        x, y, ready = waiting.pop()
        if not ready:
            waiting.append((x, y, True))
            waiting.extend((c, d, False) for c in x.slots for d in y.slots if c.sign == d.sign)
            continue
        score = [[0] * (len(y.slots) + 1) for _ in range(len(x.slots) + 1)]
        for i, c in enumerate(x.slots, 1):
            for j, d in enumerate(y.slots, 1):
                score[i][j] = max(score[i][j - 1], score[i - 1][j], score[i - 1][j - 1] + inner(c, d))
        tables[id(x), id(y)] = score
    aligned: list[tuple[Slot, Slot]] = []
    pairs = [(a, b)]
    while pairs:
        x, y = pairs.pop()
        aligned.append((x, y))
        score, i, j = tables[id(x), id(y)], len(x.slots), len(y.slots)
        while i and j:
            if score[i][j] == score[i - 1][j]:
                i -= 1
            elif score[i][j] == score[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((x.slots[i], y.slots[j]))
    return inner(a, b), aligned


def layouts(skeletons: list[tuple[int, int, dict]]) -> dict[int, int]:
    """The layout of each skeleton (id, pages, shape): the id of its representative.

    The commonest skeleton comes first; each next one joins the representative whose tree its own
    matches best, if at least ``SAME_LAYOUT`` of their nodes align, else it is a representative itself.
    """
    chosen: list[tuple[int, set[int], Slot, int]] = []
    out: dict[int, int] = {}
    for key, _, shape in sorted(skeletons, key=lambda s: (-s[1], s[0])):
        tree, own = skeleton(shape), _names(shape)
        nodes = _count(tree)
        best, at = 0.0, key
        for other, theirs, known, size in chosen:
            if 2 * len(own & theirs) < SAME_LAYOUT * min(len(own), len(theirs)):
                continue
            alike = 2 * match(tree, known)[0] / (nodes + size)
            if alike > best:
                best, at = alike, other
        if best < SAME_LAYOUT:
            at = key
            chosen.append((key, own, tree, nodes))
        out[key] = at
    return out


def _names(shape: dict[str, list]) -> set[int]:
    """A number per path that equal paths of all pages share."""
    found: list[int] = []
    for parent, sign in zip(shape["parents"], shape["signs"], strict=True):
        found.append(_hash(str(found[parent]) if parent >= 0 else "", sign))
    return {found[p] for p in shape["order"]}


def _count(slot: Slot) -> int:
    total, waiting = 0, [slot]
    while waiting:
        here = waiting.pop()
        total += 1
        waiting.extend(here.slots)
    return total


def extract(html: str) -> str:
    """The blocks of the content of one page, joined by line feeds."""
    return "\n".join(text for root in content_roots(parse(html)) for _, text in blocks(root))


def host(url: Column) -> Column:
    """Lower-case host; empty where there is none."""
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def section(url: Column) -> Column:
    """First folder of the path; empty where there is none."""
    found = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)/", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _hash(*parts: str) -> int:
    whole = "\x00".join(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(whole, digest_size=8).digest(), "little", signed=True)


PARSED = (
    "page_id {id}, url {url}, host string, section string, lang string, page long, skeleton long, paths string, "
    "blocks array<struct<node: long, content: boolean, path: string, text: string>>"
)


def parsed(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Every row of ``df`` parsed once: its blocks, those of the content first and in page order,
    the paths they stand at, and a number of the page that equal pages share."""
    rows = df.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host(F.col(url)).alias("host"),
        section(F.col(url)).alias("section"), F.col(html).alias("html"),
    )

    def read(html: object) -> tuple:
        if not isinstance(html, str) or not html:
            return "", None, None, None, []
        tree = parse(html)
        inside = [p for root in content_roots(tree) for p in blocks(root)]
        whole = blocks(tree, everything=True)
        held = set(inside)
        rest = [p for p in dict.fromkeys(whole) if p not in held]
        names, known = ("node", "content", "path", "text"), tree.paths
        nodes = {pair: _hash(str(known.hashes[pair[0]]), pair[1]) for pair in {*inside, *whole}}
        shown = {p: known.shown(p) for p, _ in nodes}
        out = [dict(zip(names, (nodes[p, t], c, shown[p], t), strict=True)) for pairs, c in ((inside, True), (rest, False)) for p, t in pairs]
        paths = json.dumps(known.shape(list(dict.fromkeys(p for p, _ in whole))))
        lang = LANG.search(html)
        page = _hash(*[str(nodes[pair]) for pair in [*inside, *whole]])
        return (lang[1].lower() if lang else ""), page, _hash(paths), paths, out

    def parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = pa.struct([("node", pa.int64()), ("content", pa.bool_()), ("path", pa.string()), ("text", pa.string())])
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(node)]
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                found = list(zip(*[read(h) for h in part.column("html").to_pylist()], strict=True))
                kept = [part.column(c) for c in ("page_id", "url", "host", "section")]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(f, k) for f, k in zip(found, kinds, strict=True)],
                    ["page_id", "url", "host", "section", "lang", "page", "skeleton", "paths", "blocks"],
                )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return rows.mapInArrow(parse_all, PARSED.format(id=kinds["page_id"], url=kinds["url"]))


def alike(shapes: DataFrame, batch: int = BATCH) -> DataFrame:
    """(host, skeleton, layout) of ``shapes`` (host, skeleton, n, paths), stored.

    The skeletons of a host are dealt by a hash into batches, each aligned in one task. Where a host
    has several batches, their representatives are dealt and aligned anew, until one batch holds
    them or a round has merged nothing.
    """
    rounds, before = [], None
    while True:
        sizes = shapes.groupBy("host").agg(F.count("*").alias("batches")).withColumn("batches", F.ceil(F.col("batches") / batch))
        largest, total = sizes.agg(F.max("batches")).first()[0] or 1, shapes.count()
        dealt = lookup_join(shapes, stored(sizes), ["host"]).withColumn(
            "batch", F.pmod(F.xxhash64("skeleton", F.lit(len(rounds))), F.col("batches"))
        )

        def align(pdf: pd.DataFrame) -> pd.DataFrame:
            found = layouts([(int(k), int(n), json.loads(p)) for k, n, p in zip(pdf["skeleton"], pdf["n"], pdf["paths"], strict=True)])
            return pd.DataFrame({"host": pdf["host"].iloc[0], "skeleton": list(found), "layout": list(found.values())})

        found = stored(dealt.groupBy("host", "batch").applyInPandas(align, "host string, skeleton long, layout long"))
        rounds.append(found)
        if largest == 1 or total == before:
            break
        before = total
        sums = lookup_join(shapes.select("host", "skeleton", "n"), found, ["host", "skeleton"]).groupBy("host", "layout").agg(F.sum("n").alias("n"))
        shapes = stored(sums.withColumnRenamed("layout", "skeleton").join(shapes.select("host", "skeleton", "paths"), ["host", "skeleton"]))
    whole = rounds[0]
    for later in rounds[1:]:
        onward = later.select("host", F.col("skeleton").alias("layout"), F.col("layout").alias("_onward"))
        whole = whole.join(onward, ["host", "layout"]).select("host", "skeleton", F.col("_onward").alias("layout"))
    return stored(whole) if len(rounds) > 1 else whole


def templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Template nodes of ``parsed`` pages, and the layout of each skeleton of a host.

    Every page counts, equal pages once. A node is template for a group of pages if it stands on
    at least ``NEARLY`` of them. The groups are the pages of a host, those of a layout
    and language, each from ``LEAST_PAGES`` on, and those of a layout and folder of the address from
    ``SECTION_PAGES`` on: a small folder may hold versions of one article. The nodes are rows of
    (host, layout, kind, key, node, page), where ``page`` is one that holds the node; tasks count
    their own pages before anything is shuffled.
    """
    group = ["host", "skeleton", "lang", "section"]
    distinct = stored(
        pages.where("host <> '' AND page IS NOT NULL")
        .select(*group, "page", "paths", F.array_distinct("blocks.node").alias("nodes"))
        .groupBy("host", "page")
        .agg(F.min(F.struct("skeleton", "lang", "section", "paths", "nodes")).alias("p"))
        .select("host", "page", "p.*")
    )
    shapes = distinct.groupBy("host", "skeleton").agg(F.count("*").alias("n"), F.min("paths").alias("paths"))
    shape = alike(stored(shapes))
    cells = stored(
        distinct.select(*group, "page", F.explode("nodes").alias("node"))
        .groupBy(*group, "node").agg(F.count("*").alias("n"), F.min("page").alias("page"))
    )
    sizes = lookup_join(distinct.groupBy(*group).agg(F.count("*").alias("n")), shape, ["host", "skeleton"], "inner", F.col("lang"))
    often = stored(
        cells.groupBy("host", "node").agg(F.sum("n").alias("all"), F.min("page").alias("one")).where(F.col("all") >= LEAST_PAGES)
    )
    some = lookup_join(cells, often, ["host", "node"], "inner", F.col("section"))
    some = stored(lookup_join(some, shape, ["host", "skeleton"], "inner", F.col("node")))
    levels = [
        ("host", F.lit(0).cast("long"), F.lit(""), LEAST_PAGES),
        ("lang", F.col("layout"), F.col("lang"), LEAST_PAGES),
        ("section", F.col("layout"), F.col("section"), SECTION_PAGES),
    ]
    found = None
    for kind, layout, key, least in levels:
        by = [F.col("host"), layout.alias("layout"), key.alias("key")]
        total = sizes.groupBy(*by).agg(F.sum("n").alias("total")).where(F.col("total") >= least)
        seen = some.groupBy(*by, "node").agg(F.sum("n").alias("n"), F.min("page").alias("page"))
        near = lookup_join(seen, total, ["host", "layout", "key"], "inner", F.col("node"))
        near = near.where(F.col("n") >= F.lit(NEARLY) * F.col("total"))
        rows = near.select("host", "layout", F.lit(kind).alias("kind"), "key", "node", "page")
        found = rows if found is None else found.unionByName(rows)
    return stored(found), shape


def wrappers(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, template): [path, text] of all template nodes of a host, read from pages that hold them."""
    pages = stored(parsed(df, url, url, html))
    nodes, _ = templates(pages)
    nodes = nodes.groupBy("host", "node").agg(F.min("page").alias("page"))
    blocks = pages.join(nodes.select("host", "page").distinct(), ["host", "page"], "left_semi")
    blocks = blocks.select("host", F.explode("blocks").alias("b")).select("host", "b.node", "b.path", "b.text").distinct()
    pair = F.array("path", "text")
    return (
        blocks.join(nodes, ["host", "node"], "left_semi").groupBy("host")
        .agg(F.to_json(F.sort_array(F.collect_set(pair))).alias("template"))
    )


def main_text(
    df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, text, n_chars): one row per row of ``df``.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments
    are skipped by element, role and label (``_telling``); nodes that stand on nearly all pages of the host, or of
    the page's layout in its language or folder, are template (``templates``); the varying rest of the
    article, else of ``main``, else of the page is the text. A null or empty page gives an empty
    text; pages of any length and depth are read whole; an empty table gives no row. A page without a host, or of a host with fewer than ``LEAST_PAGES`` different
    pages, has no template. Repeated rows give equal texts.
    """
    pages = stored(parsed(df, page_id, url, html))
    nodes, shape = templates(pages)
    sets = stored(nodes.groupBy("host", "layout", "kind", "key").agg(F.sort_array(F.collect_set("node")).alias("cut")))
    kept = F.transform(F.filter("blocks", lambda b: b["content"]), lambda b: F.struct(b["node"].alias("node"), b["text"].alias("text")))
    rows = pages.select("page_id", "url", "host", "section", "lang", "skeleton", kept.alias("blocks"))
    rows = lookup_join(rows, shape, ["host", "skeleton"], "left", F.col("url"))
    cuts = []
    for kind, key in (("host", None), ("lang", "lang"), ("section", "section")):
        part = sets.where(F.col("kind") == kind)
        on = ["host"] if key is None else ["host", "layout", key]
        columns = ["host"] if key is None else ["host", "layout", F.col("key").alias(key)]
        rows = lookup_join(rows, part.select(*columns, F.col("cut").alias(f"_{kind}")), on, "left", F.col("url"))
        cuts.append(F.coalesce(f"_{kind}", F.array().cast("array<long>")))
    left = F.filter("blocks", lambda b: ~F.exists(F.array(*cuts), lambda c: F.array_contains(c, b["node"])))
    text = F.coalesce(F.array_join(F.transform(left, lambda b: b["text"]), "\n"), F.lit(""))
    texts = rows.select("page_id", "url", text.alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
