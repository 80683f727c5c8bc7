"""Main text of pages with a site style tree.

The DOMs of all pages of a host are merged by style path (tags with class and id, from the root; a
node holds the hash of its path, chained from its parent's). For every node of the merged tree two
entropies are taken over the host's distinct pages, each between 0 (all alike) and 1 (all different):
that of its presentation, the row of styles below it, and that of its content, the text below it; where a
path occurs more than once on a page, its nodes there count together. A node's importance is the larger of
its content's entropy and ``GAMMA`` times its presentation's; a branch of low importance is what the site
repeats, and is removed from each page. Only nodes seen on ``MIN_PAGES`` distinct pages are judged.

What varies from page to page, such as an advert, is not told from text by entropy, so names lower a
node's importance. A ``WEAK`` word as a class, id or role (``widget``, ``promotion``), or any noise word as a part of
one (``no-sidebar``), removes a branch unless the tree gives it an importance of ``HIGH`` and a great share
of the host's text (``MOST``; for weak words inside an article ``LEAST``). On hosts that the tree does not judge, the
same share of the page's own text keeps it. Elements that say without doubt what they are (``nav``, ``form``,
``class="ad"``, ``class="comments"``, ``role="navigation"``, hidden ones) have importance 0, an ``article`` or ``main`` has 1, and so have
plain paragraphs and headings within: passages that articles share are text. Where a page has an article,
what lies outside it is no text.

A block ends where a block element starts or ends; ``br`` is white space. Time and memory of a page are in
proportion to its length, however deep its elements nest, and whole pages of any length are read.
Pages whose html or url is null are treated as empty and as of the empty host; empty html gives the empty text. Repeated
rows each give a row, and count once in the tree. An empty table gives an empty one. Further columns pass
through, also one named ``host`` or ``low``; ``text`` and ``n_chars`` replace columns of that name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import ROWS, fresh, map_columns, table
from triagelake.session import materialise

MIN_PAGES = 8
LOW = 0.2
GAMMA = 0.9
#: Importance of a branch that stays though it has the name of something else.
HIGH = 0.8
#: Share of the text that such a branch needs, and that of weak words inside an article.
MOST = 0.5
LEAST = 0.25
#: Rows of nodes that a task holds at once.
NODES = 1 << 16

TAG = re.compile(r"""<(?:!--(?P<c>.*?)(?:--!?>|\Z)|(?P<d>[!?])[^>]*>|(?P<e>/?)(?P<n>[a-zA-Z][^\s/>]*)(?P<a>(?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>)""", re.S)
ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table"
    " tbody td tfoot th thead tr ul caption option".split())
#: An open element of the second kind ends when one of the first starts.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
#: Elements and words in a class, id or role that name what is no text.
NOISE_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe button select input textarea svg math object"
    " dialog menu canvas audio video datalist label search".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar"
    " navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr notice"
    " notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social"
    " comment comments reply replies respond discussion disqus related recommended recommendations pagination pager"
    " toolbar skip contentinfo complementary form dialog tracking paywall".split())
#: Those of them that elements with text are named by too.
WEAK = frozenset(
    "promo promotion banner header masthead aside widget notice notices alert popup modal overlay subscribe subscription search"
    " share sharing social related recommended recommendations form dialog toolbar tracking paywall discussion".split())
STRONG = NOISE_WORDS - WEAK
LANDMARKS = ("article", "main")
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tbody thead tr td th figure figcaption caption".split())
#: Elements that are noise by a whole name only.
NAMED_WHOLE = frozenset("html body main article header p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
WORDS = re.compile(r"[a-z]+")
MERSENNE, BASE, MASK = (1 << 61) - 1, 0x1F3D5B79A2C4E6F, (1 << 64) - 1
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An open element. ``bar`` is the share of the text that it needs because of its name, 0 without such a name;
    ``size`` and ``first`` are the page's length and number of texts where it starts."""

    __slots__ = ("tag", "style", "path", "noise", "outer", "main", "link", "bar", "row", "size", "first")

    def __init__(self, tag, style, parent, noise, outer, main, link, bar=0.0):
        self.tag, self.style = tag, style
        self.path = xxhash.xxh64_intdigest(style.encode(), parent.path) if parent else 0
        self.noise, self.outer, self.main, self.link, self.bar = noise, outer, main, link, bar
        self.row, self.size, self.first = 0, 0, 0


def element(tag: str, attrs: str, parent: Node) -> Node:
    """A node with its style, whether it, or one above it, says that it is no text, and the bar of its name."""
    noise, style, main, bar = tag in NOISE_TAGS, tag, tag in LANDMARKS, 0.0
    if attrs and not attrs.isspace() and attrs != "/":
        got = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in ATTR.finditer(attrs)}
        named = f"{got.get('class', '')} {got.get('id', '')} {got.get('role', '')}".lower()
        main = main or got.get("role") in LANDMARKS or "articlebody" in got.get("itemprop", "").lower()
        if not named.isspace():
            style = f"{tag}.{got.get('class', '').strip()}#{got.get('id', '').strip()}"
            if tag not in ("html", "body", "main"):
                names = named.split()
                noise = noise or not STRONG.isdisjoint(names)
                parts = () if main or tag in NAMED_WHOLE else WORDS.findall(named)
                if not WEAK.isdisjoint(names) or not WEAK.isdisjoint(parts):
                    bar = LEAST if parent.main else MOST
                if not STRONG.isdisjoint(parts):
                    bar = MOST
        noise = noise or "hidden" in got or got.get("aria-hidden") == "true" or bool(HIDDEN.search(got.get("style", "")))
    if tag == "header" and parent.main and not parent.noise:
        noise, bar = False, 0.0  # an article's own heading
    if main and not noise and not parent.main:  # the landmark starts: noise above it is remembered
        return Node(tag, style, parent, False, parent.noise, True, parent.link, bar)
    return Node(tag, style, parent, noise or parent.noise, parent.outer, parent.main, parent.link or tag == "a", bar)


class Page:
    """Blocks of text, or with ``tree`` what the site style tree counts: ``seen`` maps the path of each judged node
    to its presentation, its content, its length and its bar.

    ``low`` and ``high`` are the branches that the tree removes and those that it keeps against their
    name. A named branch in neither is measured by a first reading of the page.
    """

    def __init__(
        self, source: str | None, low: frozenset[int] = frozenset(), high: frozenset[int] = frozenset(), tree: bool = False
    ):
        self.low, self.high, self.tree = low, high, tree
        self.minor: list[bool] | None = None  # for the named elements in their order
        self._start(source or "")
        if self.named and not tree:
            self.minor = [n.size <= n.bar * self.size for n in self.named]
            if any(self.minor):
                self._start(source or "")

    def _start(self, source: str) -> None:
        self.blocks: list[tuple[str, bool, bool, bool]] = []  # text, in a landmark, under noise, all links
        self.parts, self.linked, self.size = [], True, 0
        self.named: list[Node] = []
        self.seen: dict[int, list] = {}
        self.sums, self.powers = [0], [1]  # of the texts' hashes: those of any stretch follow from two of them
        self.stack, self.places = [Node("", "", None, False, False, False, False)], {}
        self._read(source)

    def _end_block(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                node = self.stack[-1]
                self.blocks.append((text, node.main, node.outer, self.linked))
            self.parts, self.linked = [], True

    def _text(self, raw: str) -> None:
        node = self.stack[-1]
        if node.noise or not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        if self.tree:
            if words := " ".join(text.split()):
                self.size += len(words)
                self.sums.append((self.sums[-1] * BASE + xxhash.xxh64_intdigest(words.encode())) % MERSENNE)
                self.powers.append(self.powers[-1] * BASE % MERSENNE)
            return
        self.parts.append(text)
        self.size += len(text)
        if not node.link and not text.isspace():
            self.linked = False

    def _open(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS and self.places.get("p"):
            self._close("p")
        for old in CLOSES.get(tag, ()):
            if place := self.places.get(old):
                if all(place[-1] > (self.places.get(stop) or [0])[-1] for stop in STOPS.get(tag, ())):
                    self._close(old)
        node = element(tag, attrs, self.stack[-1])
        if node.path in self.low:
            node.noise = node.noise or not (node.main and tag in LANDMARKS and not node.bar)
        elif node.bar and not self.tree and node.path not in self.high:
            if self.minor and self.minor[len(self.named)]:
                node.noise = True
            self.named.append(node)
        if tag in BLOCKS:
            self._end_block()
        if self.tree:
            above = self.stack[-1]
            above.row = (above.row * BASE + xxhash.xxh64_intdigest(node.style.encode())) % MERSENNE
        node.size, node.first = self.size, len(self.sums) - 1
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.stack))
            self.stack.append(node)
        elif tag == "br":
            self._text(" ")

    def _pop(self) -> Node:
        node = self.stack.pop()
        if node.tag:
            self.places[node.tag].pop()
        node.size = self.size - node.size
        if self.tree and judged(node):
            length = len(self.sums) - 1 - node.first
            content = (self.sums[-1] - self.sums[node.first] * self.powers[length]) % MERSENNE
            got = self.seen.setdefault(node.path, [0, 0, 0, node.bar])
            got[0] = (got[0] * BASE + node.row + 1) % MERSENNE
            got[1] = (got[1] * BASE + content + 1) % MERSENNE
            got[2] += node.size
        return node

    def _close(self, tag: str) -> None:
        if not self.places.get(tag):
            return
        if tag in BLOCKS:
            self._end_block()
        while self._pop().tag != tag:
            pass

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            m = TAG.search(source, at)
            if m is None:
                break
            self._text(source[at : m.start()])
            at = m.end()
            if not m["n"]:
                continue
            tag = m["n"].lower()
            if m["e"]:
                self._close(tag)
                continue
            self._open(tag, m["a"])
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(source, at)
                at = end.start() if end else size
        if at < size:
            self._text(source[at:])
        self._end_block()
        while self.stack:
            self._pop()

    def text(self) -> str:
        """The blocks that stay: those of landmarks outside noise, else of any landmark, else all
        that are not links only."""
        for chosen in (lambda b: b[1] and not b[2], lambda b: b[1]):
            if kept := [b[0] for b in self.blocks if chosen(b)]:
                return "\n".join(kept)
        return "\n".join(b[0] for b in self.blocks if not b[3])


def judged(node: Node) -> bool:
    """Whether the site's tree decides on a node: not where an element says without doubt what it is."""
    if node.noise or node.tag in ("", "html", "body"):
        return False
    if node.bar:
        return True
    if node.tag in LANDMARKS:
        return False
    return not (node.main and node.style == node.tag and (node.tag in PLAIN or node.tag not in BLOCKS))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def path_of(*styles: str) -> int:
    """The path of nested styles, from the root, as ``style_tree`` gives it."""
    path = 0
    for style in styles:
        path = xxhash.xxh64_intdigest(style.encode(), path)
    return signed(path)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, importance, bar, share) of the merged trees' nodes; pages: host, html.

    Pages of a host with the same html count once. Counts are summed by value before the
    entropies, so that a host with a third of all pages is no single task's work.
    """
    names = ["host", "path", "kind", "value", "page", "bar", "size", "total"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                for host, source in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    digest = signed(xxhash.xxh64_intdigest((source or "").encode()))
                    page = Page(source, tree=True)
                    for path, (row, content, size, bar) in page.seen.items():
                        rows.append((host, signed(path), "style", row, digest, bar, 0, 0))
                        rows.append((host, signed(path), "text", content, digest, bar, size, page.size))
                        if len(rows) >= NODES:
                            yield batch_of(rows)
                            rows = []
        yield batch_of(rows)

    schema = "host string, path long, kind string, value long, page long, bar double, size long, total long"
    seen = pages.select("host", "html").mapInArrow(run, schema)
    times = seen.distinct().groupBy("host", "path", "kind", "value").agg(
        F.count("*").alias("n"), F.max("bar").alias("bar"), F.sum("size").alias("size"), F.sum("total").alias("total"))
    n = F.sum("n")
    entropy = (F.log2(n) - F.sum(F.col("n") * F.log2("n")) / n) / F.log2(n)
    by_kind = times.groupBy("host", "path", "kind").agg(
        n.alias("pages"), entropy.alias("entropy"), F.max("bar").alias("bar"), F.sum("size").alias("size"),
        F.sum("total").alias("total"))
    weighed = F.when(F.col("kind") == "style", F.lit(GAMMA)).otherwise(F.lit(1.0)) * F.col("entropy")
    share = F.coalesce(F.try_divide(F.sum("size"), F.sum("total")), F.lit(0.0))
    return (
        by_kind.where(F.col("pages") >= MIN_PAGES)
        .groupBy("host", "path")
        .agg(F.max(weighed).alias("importance"), F.max("bar").alias("bar"), share.alias("share"))
    )


def main_text(pages: DataFrame, low: float = LOW) -> DataFrame:
    """``pages`` (url, html, ...) with ``text`` and ``n_chars`` instead of ``html``."""
    host, cut, stay = fresh(pages, "host"), fresh(pages, "low"), fresh(pages, "high")

    site = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    with_host = pages.withColumn(host, site)
    tree = style_tree(with_host.select(F.col(host).alias("host"), "html"))
    named, kept = F.col("bar") > 0, (F.col("importance") >= HIGH) & (F.col("share") > F.col("bar"))
    removed = F.when(named, ~kept).otherwise(F.col("importance") < low)
    branches = tree.where(removed | named).groupBy("host").agg(
        F.collect_list(F.when(removed, F.col("path"))).alias(cut), F.collect_list(F.when(~removed, F.col("path"))).alias(stay))
    branches = materialise(branches.withColumnRenamed("host", host))  # small: its size decides the join

    def paths(values) -> frozenset[int]:
        return frozenset(v & MASK for v in values or ())

    def make():
        def work(sources, cuts, stays):
            texts = [Page(s, paths(c), paths(k)).text() for s, c, k in zip(sources, cuts, stays)]
            return texts, [len(t) for t in texts]

        return work

    return map_columns(with_host.join(branches, host, "left"), ["html", cut, stay], "text string, n_chars long", make,
                       drop=("html", host, cut, stay))


def op5_style_tree(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
