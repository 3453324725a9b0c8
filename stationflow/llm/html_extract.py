"""Main text of web pages by wrapper induction over pages of the same host.

Pages of a run are parsed to DOM trees, clustered by the shape of their upper levels, and
the block elements of each cluster are aligned with its first page by simple tree
matching. A block that holds the same on nearly all pages is template; blocks that vary are
slots. Text comes from the slots of the content region: the ``article`` or ``main``
elements, or the whole body where a page has none. Element names of HTML say what is never
content. Class names are a hint: what they call boilerplate is dropped where the name is
plain, or where the template confirms that the block belongs to the site and not to one
article; never where it wraps most of the page's text.

A run is at most ``RUN`` pages of one host. Hosts with many pages are dealt to buckets, so
no task gets a whole large host; each page is shuffled once and belongs to one run. Every
step takes time in proportion to the page, or to the product of two lists of blocks that
differ.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import packed, unpacked, with_columns
from .url_filter import host_of

RUN = 128
#: Hosts known to have more pages than a run, at most: they are broadcast.
LARGE_HOSTS = 1_000_000
#: Pages with different content that must agree before a block counts as template, and their
#: least share of the cluster's pages.
WITNESSES, NEARLY_ALL = 5, 0.8
#: Cells of an alignment that are held at once; longer lists are halved first.
CELLS = 1 << 20

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "tfoot thead title tr ul".split()
)
ENDS_P = BLOCK - frozenset("body head html caption legend option optgroup tbody tfoot thead tr li dd dt title summary".split())
ENDS_SAME = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
SCOPE = frozenset("ul ol dl table select article section div body html".split())
P_SCOPE = SCOPE - ENDS_P | frozenset(("table", "article", "section", "div", "ul", "ol", "dl"))
BOILERPLATE_TAGS = RAW | frozenset("head nav aside footer button select option input menu dialog svg canvas audio video".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Class names. Those of the first list say enough by themselves; the others need the template's word.
PLAIN_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar footer masthead cookie cookies consent gdpr popup comment comments commentlist disqus share newsletter "
    "pagination toolbar".split()
)
HINT_WORDS = PLAIN_WORDS | frozenset(
    "promotion banner aside notice notification alert modal overlay respond reply replies sharing social related recommended "
    "subscribe subscription signup login search widget pager skip".split()
)
FILLER_WORDS = frozenset("box container wrapper wrap area block section list item items bar top bottom left right inner outer post page site links main".split())

_TAG = re.compile(
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)"
    r"(?P<rest>(?:[\s/]++|[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+|=)*+)>"
)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|hidden|aria-hidden)(?![^\s=/>])\s*+(?:=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+))?+", re.I)
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_RAW_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}

_NAMES: dict[str, tuple[frozenset[str], str, int]] = {}


def _named(rest: str) -> tuple[frozenset[str], str, int]:
    """Name words, role and rank (0 no boilerplate, 1 a hint, 2 plain) that attributes give."""
    known = _NAMES.get(rest)
    if known is None:
        found = {m[1].lower(): (m[2] or "").strip("\"'").lower() for m in _ATTRIBUTE.finditer(rest)}
        role = found.get("role", "")
        tokens = [frozenset(_NAME.findall(token)) for token in f"{found.get('class', '')} {found.get('id', '')}".split()]
        rank = 0
        if any(parts & HINT_WORDS for parts in tokens) or role in BOILERPLATE_ROLES:
            plain = (parts for parts in tokens if parts & PLAIN_WORDS and parts <= PLAIN_WORDS | FILLER_WORDS)
            rank = 2 if any(plain) or role in BOILERPLATE_ROLES else 1
        if "hidden" in found or found.get("aria-hidden") == "true":
            rank = 2
        known = frozenset().union(*tokens), role, rank
        if len(_NAMES) > 100_000:
            _NAMES.clear()
        _NAMES[rest] = known
    return known


class Node:
    __slots__ = (
        "tag", "names", "role", "rank", "children", "first", "last", "length", "linked", "links", "value", "shape", "size",
        "twin", "wraps", "confirmed", "present", "values", "share", "usual",
    )

    def __init__(self, tag: str, rest: str = ""):
        self.tag = tag
        self.children: list[Node | str] = []
        self.names, self.role, self.rank = _named(rest) if rest and not rest.isspace() else (frozenset(), "", 0)
        if tag == "form":
            self.rank = 2
        self.twin: Node | None = None
        #: Wraps most of the page's text: names say nothing about it.
        self.wraps = self.confirmed = False
        #: Of a template node: pages that have it, contents with their counts, its share of their text.
        self.present, self.values, self.share = 0, None, 0.0
        #: The content it has on nearly all pages.
        self.usual: int | None = None

    @property
    def label(self) -> tuple[str, frozenset[str]]:
        return self.tag, self.names

    @property
    def boilerplate(self) -> bool:
        return self.tag in BOILERPLATE_TAGS or (not self.wraps and (self.rank == 2 or (self.rank == 1 and self.confirmed)))

    def elements(self) -> list[Node]:
        return [child for child in self.children if isinstance(child, Node)]

    def blocks(self) -> list[Node]:
        return [child for child in self.children if isinstance(child, Node) and child.tag in BLOCK and child.tag not in BOILERPLATE_TAGS]


def parse(html: str) -> Node:
    """A forgiving DOM: open elements end where HTML says they do, stray end tags are passed over.

    A tag that the page ends in is dropped, as browsers do.
    """
    root = Node("html")
    stack = [root]
    #: Where in the stack elements of a name are.
    places: dict[str, list[int]] = {"html": [0]}

    def top_of(tags) -> int:
        return max((at[-1] for tag in tags if (at := places.get(tag))), default=-1)

    def close(tags: tuple[str, ...], scope) -> None:
        found = top_of(tags)
        if found <= 0 or found < top_of(scope):
            return
        for node in stack[found:]:
            places[node.tag].pop()
        del stack[found:]

    at, size = 0, len(html)
    while True:
        start = html.find("<", at)
        token = None
        while start >= 0:
            mark = html[start + 1 : start + 2]
            if mark.isalpha() and mark.isascii() or mark == "/" and html[start + 2 : start + 3].isalpha() or mark in "!?" and mark:
                break
            start = html.find("<", start + 1)
        if start < 0:
            start = size
        if start > at:
            stack[-1].children.append(html[at:start])
        if start == size:
            break
        if mark in "!?":
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                at = size if end < 0 else end + 3
            else:
                end = html.find(">", start)
                at = size if end < 0 else end + 1
            continue
        token = _TAG.match(html, start)
        if token is None:
            break
        at = token.end()
        tag = token["tag"].lower()
        if token["end"]:
            if tag != "html":
                close((tag,), ())
            continue
        if tag == "html" and len(stack) > 1:
            continue
        if tag in ENDS_P:
            close(("p",), P_SCOPE)
        if tag in ENDS_SAME:
            close(ENDS_SAME[tag], SCOPE)
        rest = token["rest"]
        node = Node(tag, rest)
        stack[-1].children.append(node)
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.end() if end else size
        elif tag not in VOID and not (rest.endswith("/") and tag not in BLOCK):
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    return root


def measure(page: Node) -> list[Node]:
    """All elements, parents first, with what follows from what is below them.

    ``length`` and ``linked`` count text and text in links, ``links`` the links; ``value``
    stands for the content, ``shape`` and ``size`` for the tree of block elements.
    """
    order, stack = [], [page]
    while stack:
        node = stack.pop()
        node.first = len(order)
        order.append(node)
        stack += node.elements()[::-1]
    for node in reversed(order):
        node.last = node.first
        node.length = node.linked = node.links = 0
        parts: list = [node.tag]
        for child in node.children:
            if isinstance(child, str):
                text = _SPACE.sub(" ", child).strip()
                if text:
                    node.length += len(text)
                    parts.append(text)
            else:
                node.last = child.last
                node.length += child.length
                node.linked += child.linked
                node.links += child.links
                parts.append(child.value)
        if node.tag in BOILERPLATE_TAGS:
            node.length = node.linked = node.links = 0
        if node.tag == "a":
            node.linked, node.links = node.length, node.links + 1
        node.value = hash(tuple(parts))
        inner = node.blocks()
        node.size = 1 + sum(child.size for child in inner)
        node.shape = hash((node.tag, node.names, *[child.shape for child in inner]))
    return order


# --- wrapper induction -----------------------------------------------------------------


def layout(page: Node, depth: int = 4) -> frozenset[int]:
    """The kinds of blocks of the upper levels, each with the blocks around it, however often they are there."""
    out: set[int] = set()
    level = [(page, hash((page.tag, page.names)))]
    for _ in range(depth):
        below = {}
        for node, path in level:
            if node.tag not in ("article", "main"):
                for child in node.blocks():
                    below[id(child)] = child, hash((path, child.tag, child.names))
        level = list(below.values())
        out.update(path for _, path in level)
    return frozenset(out)


def clusters_of(pages: list[Node]) -> list[list[int]]:
    """Numbers of the pages by layout: each joins the first cluster with whose first page it shares most kinds."""
    kinds = [layout(page) for page in pages]
    out: list[list[int]] = []
    for n, mine in enumerate(kinds):
        for members in out:
            first = kinds[members[0]]
            if 2 * len(mine & first) >= len(mine | first):
                members.append(n)
                break
        else:
            out.append([n])
    return out


class Matching:
    """Weights of the simple tree matching between block trees: pairs in the best alignment of children, recursively.

    Trees of one shape match whole; a weight is worked out once for a pair of shapes, without recursion.
    """

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def _now(self, a: Node, b: Node) -> int | None:
        if a.tag != b.tag or a.names != b.names:
            return 0
        return a.size if a.shape == b.shape else self.known.get((a.shape, b.shape))

    def weight(self, a: Node, b: Node) -> int:
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            if self._now(x, y) is not None:
                stack.pop()
                continue
            left, right = _trimmed(x.blocks(), y.blocks())[1:3]
            kinds = {(u.shape, v.shape): (u, v) for u in _kinds(left) for v in _kinds(right)}
            missing = [pair for pair in kinds.values() if self._now(*pair) is None]
            if missing:
                stack += missing
                continue
            pairs = self.align(x.blocks(), y.blocks())
            self.known[x.shape, y.shape] = 1 + sum(self._now(u, v) for u, v in pairs)
            stack.pop()
        return self._now(a, b)

    def align(self, a: list[Node], b: list[Node]) -> list[tuple[Node, Node]]:
        """Pairs of children of two matched nodes, in order, of the greatest total weight."""
        front, left, right, back = _trimmed(a, b)
        if left and right:
            rows, columns = (np.array(_numbers(part)) for part in (left, right))
            first, second = _kinds(left), _kinds(right)
            weights = np.array([[self.weight(u, v) for v in second] for u in first], dtype=np.int64)
            front = front + [(left[i], right[j]) for i, j in _best_pairs(weights, rows, columns)]
        return front + back


def _kinds(nodes: list[Node]) -> list[Node]:
    """One node of each shape."""
    return list({node.shape: node for node in reversed(nodes)}.values())[::-1]


def _numbers(nodes: list[Node]) -> list[int]:
    order = {node.shape: n for n, node in enumerate(_kinds(nodes))}
    return [order[node.shape] for node in nodes]


def _trimmed(a: list[Node], b: list[Node]) -> tuple[list[tuple[Node, Node]], list[Node], list[Node], list[tuple[Node, Node]]]:
    """Pairs at both ends that have one shape (part of a best alignment), and what is between."""
    short, at = min(len(a), len(b)), 0
    while at < short and a[at].shape == b[at].shape:
        at += 1
    tail = 0
    while tail < short - at and a[-1 - tail].shape == b[-1 - tail].shape:
        tail += 1
    front = list(zip(a[:at], b[:at], strict=True))
    back = list(zip(a[len(a) - tail :], b[len(b) - tail :], strict=True))
    return front, a[at : len(a) - tail], b[at : len(b) - tail], back


def _totals(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Best total for all rows and the columns up to each."""
    total = np.zeros(len(columns) + 1, dtype=np.int64)
    gains = weights[:, columns]
    for row in rows.tolist():
        step = total[:-1] + gains[row]
        np.maximum(step, total[1:], out=step)
        np.maximum.accumulate(step, out=total[1:])
    return total


def _best_pairs(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Places of the pairs of a best alignment; long lists are halved, so memory stays linear."""
    out: list[tuple[int, int]] = []
    parts = [(0, len(rows), 0, len(columns))]
    while parts:
        top, bottom, low, high = parts.pop()
        n, m = bottom - top, high - low
        if not n or not m:
            continue
        if n == 1 or n * m <= CELLS:
            table = np.zeros((n + 1, m + 1), dtype=np.int64)
            gains = weights[:, columns[low:high]]
            for i, row in enumerate(rows[top:bottom].tolist()):
                step = np.maximum(table[i, 1:], table[i, :-1] + gains[row])
                np.maximum.accumulate(step, out=table[i + 1, 1:])
            i, j = n, m
            while i and j:
                if table[i, j] == table[i - 1, j]:
                    i -= 1
                elif table[i, j] == table[i, j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    out.append((top + i, low + j))
        else:
            middle = top + n // 2
            above = _totals(weights, rows[top:middle], columns[low:high])
            below = _totals(weights, rows[middle:bottom][::-1], columns[low:high][::-1])[::-1]
            cut = low + int((above + below).argmax())
            parts += [(top, middle, low, cut), (middle, bottom, cut, high)]
    return sorted(out)


def induce(pages: list[Node], orders: list[list[Node]]) -> None:
    """Align the pages of a cluster with the first; afterwards nodes know whether they are template."""
    template, matching = pages[0], Matching()
    for node in orders[0]:
        node.twin = node
    for page in pages[1:]:
        stack = [(template, page)] if template.label == page.label else []
        while stack:
            one, other = stack.pop()
            other.twin = one
            stack += matching.align(one.blocks(), other.blocks())
    # Copies of an article bear no witness against it.
    witnesses: dict[tuple[int, ...], int] = {}
    for n, page in enumerate(pages):
        witnesses.setdefault(tuple(region.value for region in regions(page)), n)
    for n in witnesses.values():
        whole = max(1, pages[n].length)
        for node in orders[n]:
            twin = node.twin
            if twin is not None:
                twin.values = Counter() if twin.values is None else twin.values
                twin.values[node.value] += 1
                twin.present += 1
                twin.share += node.length / whole
    least = max(WITNESSES, NEARLY_ALL * len(witnesses))
    for node in orders[0]:
        if node.values:
            value, seen = node.values.most_common(1)[0]
            node.usual = value if seen >= least else None
    for order in orders:
        for node in order:
            twin = node.twin
            if twin is not None and len(witnesses) >= WITNESSES:
                # A part of the site, and not the part that its text is in.
                node.confirmed = 2 * twin.present >= len(witnesses) and 4 * twin.share <= twin.present


def is_template(node: Node) -> bool:
    """A block with the same content on nearly all pages of its cluster."""
    return node.twin is not None and node.twin.usual is not None and node.twin.usual == node.value


# --- content ---------------------------------------------------------------------------


def find_wrappers(page: Node, order: list[Node]) -> None:
    """Set ``wraps`` of named elements that hold most of the page's text, or all of its content.

    One beside an ``article`` or ``main`` element, as a long list of comments, keeps its name.
    """
    own = lambda node: node.length - node.linked
    for node in order:
        node.wraps = 2 * own(node) > own(page)
    content = [n for n in order if n.tag in ("article", "main") and not (n.rank and not n.wraps) and own(n)]
    if content:
        marks = np.zeros(len(order) + 1, dtype=np.int64)
        around = np.zeros(len(order) + 1, dtype=np.int64)
        for node in content:
            marks[node.first] += 1
            around[node.first + 1] += 1
            around[node.last + 1] -= 1
        below, above = np.concatenate([[0], np.cumsum(marks)]), np.cumsum(around)
        for node in order:
            if node.wraps and node.rank:
                inside = below[node.last + 1] - below[node.first]
                if len(content) - inside - above[node.first] > 0:
                    node.wraps = False
    if not blocks(page) and own(page):
        # Only named elements hold text: the page is its descendants.
        for node in order:
            node.wraps = True


def regions(page: Node) -> list[Node]:
    """The outermost ``article`` and ``main`` elements outside boilerplate, or the page.

    The page too if they hold less than half of the text outside boilerplate.
    """
    found, stack, whole = [], [page], 0
    while stack:
        node = stack.pop()
        if node.boilerplate:
            continue
        if node.tag in ("article", "main") or node.role in ("main", "article"):
            found.append(node)
            continue
        if node.tag not in ("a", "header"):
            whole += sum(len(_SPACE.sub(" ", c).strip()) for c in node.children if isinstance(c, str))
            stack += node.elements()[::-1]
    held = sum(node.length - node.linked for node in found)
    with_text = [node for node in found if node.length]
    return with_text if with_text and held >= whole else [page]


def _menu(node: Node) -> bool:
    """A list that is links and little else."""
    listed = node.tag in ("ul", "ol", "dl", "div", "p", "header")
    return listed and node.links >= 3 and node.linked >= 0.8 * node.length


def blocks(page: Node) -> list[str]:
    """The content of a page, a text for each block, in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
        line.clear()
        if text:
            out.append(text)

    for region in regions(page):
        whole = region is page
        stack: list[Node | str | None] = [region]
        while stack:
            top = stack.pop()
            if top is None:
                flush()
            elif isinstance(top, str):
                line.append(top)
            elif top is not region and (top.boilerplate or (whole and (top.tag == "header" or _menu(top)))):
                if top.tag in BLOCK:
                    flush()
            elif top.tag in BLOCK:
                flush()
                if top is region or not is_template(top):
                    stack += [None, *top.children[::-1]]
            else:
                if top.tag in ("br", "td", "th"):
                    line.append(" ")
                stack += top.children[::-1]
        flush()
    return out


def extract_run(pages: list[str]) -> list[str]:
    """The main text of each page of a run."""
    trees = [parse(page) for page in pages]
    orders = [measure(tree) for tree in trees]
    for tree, order in zip(trees, orders, strict=True):
        find_wrappers(tree, order)
    # Empty pages and pages of another layout bear no witness.
    for members in clusters_of(trees):
        if len(members) >= WITNESSES:
            # The page with the most blocks has those that some pages lack.
            members.sort(key=lambda n: -trees[n].size)
            induce([trees[n] for n in members], [orders[n] for n in members])
    return ["\n".join(blocks(tree)) for tree in trees]


def whole_runs(batches: Iterator[pa.RecordBatch], run: int, keys: tuple[str, ...] = ("_host", "_bucket")) -> Iterator[pa.RecordBatch]:
    """Cut the stream only where a run ends: at a new host or bucket, or after ``run`` pages of one."""
    rest: pa.RecordBatch | None = None
    for batch in batches:
        if rest is not None and rest.num_rows:
            batch = pa.concat_batches([rest, batch])
        if not batch.num_rows:
            continue
        names = list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys], strict=True))
        start = next((i + 1 for i in range(len(names) - 2, -1, -1) if names[i] != names[-1]), 0)
        end = start + (len(names) - start) // run * run
        if end:
            yield batch.slice(0, end)
        rest = batch.slice(end)
    if rest is not None and rest.num_rows:
        yield rest


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", run: int = RUN) -> DataFrame:
    """Replace ``html`` by ``text`` (main text, blocks joined by a line break) and add ``n_chars``.

    Null html is an empty page with an empty text. Null urls, and those without ``://``,
    share the empty host. Repeated rows get the same text; rows alike in all columns may lie
    in one task. An empty table gives an empty one. All other columns are kept, whatever
    their names; input columns named ``text`` or ``n_chars`` are replaced.
    """
    kept = [name for name in pages.columns if name.lower() not in (html_col.lower(), "text", "n_chars")]
    marks = [F.col(f"`{name}`") for name, kind in pages.dtypes if name in (url_col, html_col) or kind == "bigint"]
    hosted = pages.select(
        packed(kept).alias("_kept"), F.col(html_col).alias("_html"), host_of(F.col(url_col)).alias("_host"), F.xxhash64(*marks).alias("_mark")
    )
    sizes = hosted.groupBy("_host").agg(F.count(F.lit(1)).alias("_size"))
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    # Hosts above the border cannot be more than LARGE_HOSTS.
    large = sizes.where(F.col("_size") > max(run, total // LARGE_HOSTS)).select("_host", F.ceil(F.col("_size") / run).alias("_buckets"))
    placed = (
        hosted.join(F.broadcast(large), "_host", "left")
        .withColumn("_bucket", F.pmod("_mark", F.coalesce("_buckets", F.lit(1))))
        .drop("_buckets")
        .repartition("_host", "_bucket")
        .sortWithinPartitions("_host", "_bucket", "_mark")
    )

    def make(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            keys = zip(batch["_host"].to_pylist(), batch["_bucket"].to_pylist(), strict=True)
            texts: list[str] = []
            source = iter(batch["_html"].to_pylist())
            for _, members in groupby(keys):
                count = sum(1 for _ in members)
                while count:
                    part = min(run, count)
                    texts += extract_run([next(source) or "" for _ in range(part)])
                    count -= part
            yield {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    added = StructType([StructField("text", StringType()), StructField("n_chars", LongType())])
    made = with_columns(placed, ["_host", "_bucket", "_html"], added, make, lambda batches: whole_runs(batches, run))
    return made.select(*unpacked(kept), "text", "n_chars")
