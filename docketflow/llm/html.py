"""Operator 10, HTML extraction: consensus host paths.

Every page's containers are scored by the text of their blocks (link text counts against it, an
outer container gets less than the inner one, `article` and `main` count double). The best container's generalised tag-class
path is the page's vote; Spark counts votes by host, and every page is then re-extracted from the
elements at its host's winning path. A page without such an element uses its own best container.
Inside the container, menus, headers and footers of the site, sidebars, notices, adverts, forms,
scripts, styles and reader comments are left out, by element or by a class, id or role all of whose parts
say so; headings never are, and inside an article ids don't count. Where the host's path holds next to
nothing of a page, that page's own best container is used.

A path is named by a 64-bit hash of its element's label (tag and all class, id and role words, in
order, without digits) and its parent's path, so that a vote has one size at any depth. Elements are
kept as a tree of parent numbers and all sums run once over it: time and memory of a page are in
proportion to its length, whatever its markup. A `<` that no `>` follows is text.

Blocks keep page order and are joined by one line feed; character references are decoded, white
space in a block becomes one space, and a line break inside a block counts as white space.

Null pages and pages without text give the empty string. A null url has the empty host. Repeated
rows are extracted alike and vote each. Pages are read whole. An empty table gives an empty result.
Other columns are ignored. Winning paths are one small row a host: broadcast while measured small,
else joined by host and a salt, so that a host with a third of all pages is no single task.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.common import measured_small, sub_batches, written

_NAME = re.compile(r"[A-Za-z][A-Za-z0-9:-]*")
_STOP = re.compile(r"[>\"']")
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PARTS = re.compile(r"[^a-z]+")
_HUMPS = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Fixed values of HTML: elements without content, elements of raw text, elements that stay inside a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg select option noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
#: Elements and class words of what surrounds an article.
OUTSIDE = set("nav footer aside button dialog menu head".split())
WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs footer foot comment comments "
    "disqus reply replies respond notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended "
    "widget toolbar pagination pager skip copyright".split()
)
SITE = {"header", "masthead", "topbar"}
#: Words that say how something is laid out or which part of a page it is, and may stand beside a word of WORDS.
LAYOUT = set(
    "site page main top bottom left right post posts entry article content story global primary secondary mobile desktop block box list item items link links button buttons bar area section container wrapper "
    "wrap inner outer row col column panel group module region zone slot unit title text body thread count icon icons small large form js".split()
)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
HOLDS = {"article", "main"}
CONTAINERS = {"div", "article", "main", "section", "td", "body"}
#: Which open elements a start tag ends, if nearer than those that hold it.
ENDS = {x: frozenset(["p"]) for x in CLOSES_P} | {"li": frozenset(["p", "li"])} | {x: frozenset(["p", "dt", "dd"]) for x in ("dt", "dd")} | {x: frozenset(["p", "td", "th"]) for x in ("td", "th")} | {"tr": frozenset(["p", "td", "th", "tr"])}
SCOPE = frozenset("ul ol dl table div article section blockquote".split())
MOST, HALF = 0.8, 0.5  # of a page's own text, from which an element is no mere surrounding
DECAY = 0.7  # of a block's worth for each container further out
SLIGHT = 1.2
LEAST_SHARE = 0.1  # of the text in a page's own best container, below which the host's path holds no article there
SALTS = 64  # tasks that a host's pages may take where they are shuffled


class Block:
    """Text of one element up to the next border of a block."""

    __slots__ = ("element", "link", "out", "text")

    def __init__(self, element: int, out: bool):
        self.element, self.out, self.text, self.link = element, out, [], 0


class Tree:
    """Elements by number, each after its parent: parent, path hash, and what kind of holder it is."""

    def __init__(self):
        self.parent, self.path, self.kind = array("i", [-1]), array("q", [0]), array("b", [1])  # 2 article or main, 1 container, 0 other, -1 body, html

    def add(self, parent: int, name: str, words: list[str]) -> int:
        label = f"{self.path[parent]}>{name}.{'.'.join(words)}".encode()
        self.parent.append(parent)
        self.path.append(int.from_bytes(hashlib.blake2b(label, digest_size=8).digest(), "little", signed=True))
        self.kind.append(2 if name in HOLDS else -1 if name in ("body", "html") else 1 if name in CONTAINERS else 0)
        return len(self.parent) - 1

    def below(self, marked: set[int]) -> bytearray:
        """For every element whether it or one around it is marked."""
        out = bytearray(len(self.parent))
        for k, up in enumerate(self.parent):
            out[k] = k in marked or (up >= 0 and out[up])
        return out

    def summed(self, own: list[float]) -> list[float]:
        """Sums of `own` over each element and all within it."""
        for k in range(len(own) - 1, 0, -1):
            own[self.parent[k]] += own[k]
        return own


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """Start, end, lower-cased name, whether it is an end tag, and attributes of every tag; comments and the like have no
    name. The caller may send the place to go on from. A quote counts after `=` only; where quotes don't close before
    the page ends, tags end at the next `>` from there on."""
    at, last, quotes = 0, page.rfind(">"), True
    while True:
        i = page.find("<", at)
        if i < 0 or i > last:
            return
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            at = len(page) if end < 0 else end + 3
            yield i, at, "", False, ""
            continue
        closing = page.startswith("/", i + 1)
        m = _NAME.match(page, i + 1 + closing)
        if not m:
            if closing or page.startswith(("!", "?"), i + 1):
                at = page.find(">", i) + 1
                yield i, at, "", False, ""
            else:
                at = i + 1
            continue
        k = m.end()
        while quotes:
            stop = _STOP.search(page, k)
            if not stop:
                quotes = False
            elif stop[0] == ">":
                k = stop.end()
                break
            elif page[k : stop.start()].rstrip().endswith("="):
                k = page.find(stop[0], stop.end()) + 1
                if not k:
                    quotes = False
            else:
                k = stop.end()
        if not quotes:
            k = page.find(">", m.end()) + 1
        at = (yield i, k, m[0].lower(), closing, page[m.end() : k - 1]) or k


def parse(page: str | None) -> tuple[list[Block], Tree]:
    """Blocks in page order and the tree of elements."""
    page = page or ""
    blocks: list[Block] = []
    tree = Tree()
    soft: dict[int, bool] = {}  # elements left out by a word or as a form; whether a whole class is the word
    holds: set[int] = set()
    stack: list[tuple[str, bool, bool]] = [("", False, False)]  # open elements: name, left out, inside an article
    where: dict[str, list[int]] = {}  # places in the stack by name
    elements, places = [0], [0]  # open elements that are no inline ones, and their places in the stack
    block: Block | None = None
    links = at = 0

    def text(piece: str) -> None:
        nonlocal block
        if block is None:
            block = Block(elements[-1], stack[-1][1])
            blocks.append(block)
        block.text.append(piece)
        if links:
            block.link += len(piece)

    def close(depth: int) -> None:
        while len(stack) > depth:
            where[stack.pop()[0]].pop()
            if places[-1] >= len(stack):
                places.pop()
                elements.pop()

    def nearest(names: frozenset[str]) -> int:
        return max((where[x][-1] for x in names if where.get(x)), default=0)

    found = tags(page)
    tag = next(found, None)
    while tag:
        start, end, name, closing, attributes = tag
        if start > at:
            text(page[at:start])
        at, onward = end, None
        if not name:
            pass
        elif closing:
            if name == "a":
                links = max(0, links - 1)
            depth = nearest(frozenset((name,)))
            if depth and not (name in INLINE and places[-1] > depth):  # an inline end tag doesn't close blocks
                close(depth)
                if name not in INLINE:
                    block = None
            elif not depth and name not in INLINE:
                block = None
        elif name in RAW or name == "xmp":
            if not attributes.endswith("/"):
                over = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                if name == "xmp":
                    block = None
                    text(page[at : over.start() if over else len(page)].replace("&", "&amp;"))
                    block = None
                at = onward = over.end() if over else len(page)
        elif name in VOID:
            if name == "br":
                text(" ")
            if name == "hr":
                block = None
        elif name in INLINE:
            links += name == "a"
            where.setdefault(name, []).append(len(stack))
            stack.append((name, *stack[-1][1:]))
        else:
            if name in ENDS:
                depth = nearest(ENDS[name])
                if depth and depth > nearest(SCOPE):
                    close(depth)
            links = 0 if name == "p" else links
            marks = [(k.lower(), v.strip("\"'")) for k, v in _CLASS.findall(attributes)] if attributes else []
            words = {w for _, v in marks for w in _PARTS.split(v.lower()) if w}
            inside = stack[-1][2] or name in HOLDS
            out = stack[-1][1] or name in OUTSIDE or (not inside and name == "header")
            known = WORDS if inside else WORDS | SITE
            number = tree.add(elements[-1], name, sorted(words))
            if name == "form" or (marks and name not in ("body", "html", "main", "article") and name not in HEADINGS):
                # ids are made from titles: in an article they say what its parts are about
                said = [v for k, m_ in marks if not (inside and k == "id") for v in m_.split()]
                if name == "form" or any(surrounds(v, known) for v in said):
                    soft[number] = any(v.lower() in known for v in said)
            if name in HOLDS:
                holds.add(number)
            where.setdefault(name, []).append(len(stack))
            places.append(len(stack))
            elements.append(number)
            stack.append((name, out, inside))
            block = None
        try:
            tag = found.send(onward)
        except StopIteration:
            tag = None
    if at < len(page):
        text(page[at:])
    if soft:
        settle(blocks, tree, soft, holds)
    return blocks, tree


def surrounds(token: str, known: set[str]) -> bool:
    """Whether a whole class, id or role names surroundings: all of its parts do so or are words of layout (`share-price`
    and `notice-board` don't, `share-buttons` and `notice` do)."""
    parts = [w for w in _PARTS.split(_HUMPS.sub("-", token).lower()) if w]
    return any(w in known for w in parts) and all(w in known or w in LAYOUT for w in parts)


def settle(blocks: list[Block], tree: Tree, soft: dict[int, bool], holds: set[int]) -> None:
    """Leave out the blocks in surroundings known by a word, except in elements that wrap the article.

    Such an element holds all text of article and main elements, and that is half of the page's; or, if no whole class
    is the word (`has-sidebar`, a form), it holds most of the page's text. If nothing is left, words don't count.
    """
    live = [(b, max(0, sum(len(x.strip()) for x in b.text) - b.link)) for b in blocks if not b.out]
    mine = tree.below(holds)
    within, held_in = [0] * len(mine), [0] * len(mine)
    for b, n in live:
        within[b.element] += n
        held_in[b.element] += n * mine[b.element]
    within, held_in = tree.summed(within), tree.summed(held_in)
    page, held = within[0], held_in[0]
    gone = tree.below({e for e in soft if not (page and ((held >= HALF * page and held_in[e] == held) or (not soft[e] and within[e] >= MOST * page)))})
    if all(not n or gone[b.element] for b, n in live):
        return
    for b, _ in live:
        b.out = bool(gone[b.element])


def clean(block: Block) -> str:
    return " ".join(entities.unescape("".join(block.text)).split())


def best(blocks: list[Block], tree: Tree) -> tuple[int, float]:
    """Number and score of the container that holds most of the page's own text; -1 if there is none."""
    scores, total = [0.0] * len(tree.parent), [0.0] * len(tree.parent)
    for b in blocks:
        if b.out:
            continue
        n = sum(map(len, b.text))
        total[b.element] += n
        # the block's own element lends its worth to what holds it
        holder = b.element if b.element == 0 or abs(tree.kind[b.element]) else tree.parent[b.element]
        scores[holder] += max(0.0, n - 2.0 * b.link)
    for k in range(len(scores) - 1, 0, -1):
        scores[tree.parent[k]] += DECAY * scores[k]
        scores[k] *= 2 if tree.kind[k] == 2 else 1
    total = tree.summed(total)
    element = max(range(len(scores)), key=lambda k: (scores[k], -k))
    if not scores[element]:
        return -1, 0.0
    # a parent that adds little, such as a heading, is taken with it; the page's body is not
    while tree.kind[element] != 2 and (up := tree.parent[element]) > 0 and tree.kind[up] != -1 and total[up] <= SLIGHT * total[element]:
        element = up
    return element, scores[element] or total[element]


def extract(page: str | None, path: int | None) -> str:
    """The text of the blocks at a path, or of the page's own best container if that path holds none, or less than
    LEAST_SHARE of what the own container holds (a teaser where other pages of the host have their article)."""
    blocks, tree = parse(page)
    blocks = [b for b in blocks if not b.out]

    def at(path: int | None) -> tuple[bytearray, int]:
        marked = tree.below({k for k, p in enumerate(tree.path) if p == path} if path is not None else set())
        return marked, sum(len(x) for b in blocks if marked[b.element] for x in b.text)

    wanted, size = at(path)
    element = best(blocks, tree)[0]
    if not any(wanted[b.element] for b in blocks) or (element >= 0 and tree.path[element] != path):
        own, most = at(tree.path[element] if element >= 0 else None)
        if not size or size < LEAST_SHARE * most:
            wanted = own
    texts = (clean(b) for b in blocks if wanted[b.element])
    return "\n".join(t for t in texts if t)


def host(url: str = "url") -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def winners(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """host, path, votes: the path with most votes, then most text, then the least hash."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, "html", 4 << 20):
                path, worth = [], []
                for page in b.column(1).to_pylist():
                    blocks, tree = parse(page)
                    element, score = best(blocks, tree)
                    path.append(tree.path[element] if element > 0 else None)
                    worth.append(round(score))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(path, pa.int64()), pa.array(worth, pa.int64())], ["host", "path", "worth"])

    votes = pages.select(host(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(vote, "host string, path long, worth long")
    counted = votes.filter("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("worth").alias("worth"))
    order = W.partitionBy("host").orderBy(F.desc("votes"), F.desc("worth"), "path")
    return counted.withColumn("r", F.row_number().over(order)).filter("r = 1").select("host", "path", "votes")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text."""
    won = written(winners(pages, html_col, url_col).select("host", "path"), "html-paths")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(url_col).alias("host"), F.col(html_col).alias("html"))
    if measured_small(won):
        rows = rows.join(F.broadcast(won), "host", "left")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(won.withColumn("salt", salts), ["host", "salt"], "left")
    rows = rows.select("page_id", "url", "html", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, "html", 4 << 20):
                text = [extract(p, q) for p, q in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    out = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_html": op10_html}
