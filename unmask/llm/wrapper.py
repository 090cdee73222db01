"""Main text of web pages by wrapper induction.

For every host with three pages or more, a complete page of median length is the reference, and every other
page of the host is aligned with it by simple tree matching: two nodes match if their tag and classes
agree, their children are paired in order so that most nodes match, and equal text breaks ties. All
pages of the host together then say which reference nodes hold the same text nearly everywhere. Those
are the template and are left out wherever they appear; what varies is content. Pages whose longest block
equals the reference's are copies and do not testify.

Where eight pages testify, the lowest container with most of the varying text is the host's region of
content: there a node whose class or id is on the word lists stays if its text varies. Outside of it the
lists break the tie between content and navigation that varies too. Tags, roles and advert classes hold on
every page. Hosts with fewer pages, and pages that do not align, are read by articles and the lists.

Scale: pages are never gathered by host. A reference is a few bytes for each node; the references of all
hosts are broadcast if they are measured to be small and joined otherwise. Counts are added up in the
task before they are shuffled. The reference is of median length, and stubs are none, so a few odd pages
change no template; texts and digests of a node are taken once, however often it is compared.
"""

from __future__ import annotations

import functools
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from unmask.llm.common import url_host
from unmask.session import Scratch, durable

MIN_PAGES = 3
# Share of testifying pages with the same text that makes a node template, and how many must testify:
# outside an article, and inside one, where equal paragraphs may be quotations.
OUTSIDE = (0.8, 2)
INSIDE = (0.9, 8)
# Share of a host's varying text that a container must hold to be where its content is.
REGION = 0.6
BROADCAST_BYTES = 32 << 20
# Nodes below one another; text below that is kept, see ``parse``.
MAX_DEPTH = 200

# Opening tags of blocks, as far as they tell a stub from a page.
_OPENS = r"(?i)<(?:p|div|li|h[1-6]|td|th|dd|dt|pre|blockquote|section|article|main|nav|header|footer|aside|table|ul|ol|form)[\s/>]"

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
# An opening tag ends these open ones, up to the container that holds both.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp"}
_DROP_TAGS = _RAW | set(
    "head nav footer aside form button select input menu dialog object svg canvas audio video map".split()
)
_DROP_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Parts of class and id names. Adverts differ from page to page, so no alignment can tell them from content.
_ADVERT_WORDS = set("ad ads adv advert adverts advertisement advertising adsense sponsor sponsored".split())
_DROP_WORDS = set(
    "promo promotion banner nav navbar "
    "navigation menu menubar masthead topbar footer sidebar widget widgets cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login social share sharing breadcrumb breadcrumbs "
    "pagination pager related recommended recommendations toolbar copyright disclaimer".split()
)
_COMMENT_WORDS = set("comment comments commentlist disqus respond replies reply discussion".split())
_STATE = ("no-", "has-", "with-", "without-", "is-", "not-")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")


class Node:
    __slots__ = ("tag", "label", "kids", "kind", "text", "digest")

    def __init__(self, tag: str, label: str = "", kind: str = ""):
        self.tag, self.label, self.kind, self.kids = tag, label or tag, kind, []
        # Own text and its digest, filled in when first asked for.
        self.text: str | None = None
        self.digest = 0


@functools.lru_cache(maxsize=50_000)
def _described(tag: str, attributes: str) -> tuple[str, str]:
    """(label, kind): tag with classes, and what names it as no content.

    The kind is 'drop' by tag, role, hidden attribute or an advert's class, which always hold, or a class or
    id that is only a hint: 'named', or 'comment'. '' is none of these.
    """
    found = {k.lower(): (v or "").strip("\"'") for k, v in _NAMES.findall(attributes)}
    label = f"{tag}.{found['class']}" if "class" in found else tag
    if tag in _DROP_TAGS or "hidden" in found and tag not in ("html", "body"):
        return label, "drop"
    if found.get("role", "").lower() in _DROP_ROLES:
        return label, "drop"
    words = set()
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        if not name.lower().startswith(_STATE):
            words.update(w.lower() for w in _PARTS.findall(name))
    whole = tag in ("html", "body", "article", "main")
    if words & _COMMENT_WORDS and tag not in ("html", "body", "main"):
        return label, "comment"
    if words & _ADVERT_WORDS and not whole:
        return label, "drop"
    if not whole and (words & _DROP_WORDS or {"site", "header"} <= words or {"page", "header"} <= words):
        return label, "named"
    return label, ""


class _Deep(Node):
    """An element below MAX_DEPTH: open for its end tag, but what it holds goes to the node above."""

    def __init__(self, node: Node, above: Node):
        super().__init__(node.tag, node.label, above.kind)
        self.kids = above.kids


def parse(page: str) -> Node:
    """Tree of a page; forgiving, as browsers are.

    Elements nested deeper than MAX_DEPTH are no nodes of their own: their text stands in the node above them,
    in order, and their end tags end them. What is no content by its tag or names stays a node, so it can go.
    """
    root = Node("#root")
    stack, at, end = [root], 0, len(page)

    def shut(start: int) -> None:
        for n in stack[start:]:
            if isinstance(n, _Deep) and n.tag not in _INLINE:
                n.kids.append(" ")
        del stack[start:]

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        closing, opening, attributes = m[1], m[2] or m[4], m[3] or m[5]
        if closing:
            tag = closing.lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    shut(i)
                    break
            else:
                if tag == "br":
                    stack[-1].kids.append(" ")
        elif opening:
            tag = opening.lower()
            if tag in _CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        shut(i)
                        break
                    if stack[i].tag not in _INLINE:
                        break
            elif tag in _CLOSES:
                ends, holders = _CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in holders:
                        break
                    if stack[i].tag in ends:
                        shut(i)
                        if tag not in ("tr", "tbody"):
                            break
            if tag == "br":
                stack[-1].kids.append(" ")
                continue
            node, above = Node(tag, *_described(tag, attributes or "")), stack[-1]
            if len(stack) >= MAX_DEPTH and tag not in _VOID and tag not in _RAW and (above.kind or not node.kind):
                if tag not in _INLINE:
                    above.kids.append(" ")
                stack.append(_Deep(node, above))
                continue
            above.kids.append(node)
            if tag in _RAW and not (attributes or "").rstrip().endswith("/"):
                close = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else end
            elif tag not in _VOID:
                stack.append(node)
        elif m[0][:2] not in ("<!", "<?"):
            stack[-1].kids.append(entities.unescape(m[0]))
    return root


def own_text(node: Node) -> str:
    """Text directly inside a node or in its inline parts, white space made single. The tree is complete by then."""
    if node.text is not None:
        return node.text
    out = []

    def walk(n: Node) -> None:
        for k in n.kids:
            if isinstance(k, str):
                out.append(k)
            elif k.tag in _INLINE:
                walk(k)

    walk(node)
    node.text = " ".join("".join(out).split())
    node.digest = _digest(node.text)
    return node.text


def own_digest(node: Node) -> int:
    own_text(node)
    return node.digest


def _blocks(node: Node) -> list[Node]:
    return [k for k in node.kids if isinstance(k, Node) and k.tag not in _INLINE and k.tag not in _RAW]


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 11 if text else 0


def _longest(node: Node) -> int:
    best, todo = "", [node]
    while todo:
        n = todo.pop()
        text = own_text(n)
        best = max(best, text, key=lambda t: (len(t), t))
        todo += _blocks(n)
    return _digest(best)


def skeleton(page: str) -> str:
    """A reference page as JSON: [digest of its longest block, [label, digest of own text, children]]."""

    def of(n: Node) -> list:
        return [n.label, own_digest(n), [of(k) for k in _blocks(n)]]

    root = parse(page)
    return json.dumps([_longest(root), of(root)], separators=(",", ":"))


class Reference:
    """A skeleton with its nodes numbered in page order."""

    def __init__(self, text: str):
        self.longest, tree = json.loads(text)
        self.labels, self.digests, self.kids = [], [], []

        def add(node: list) -> int:
            number = len(self.labels)
            self.labels.append(node[0])
            self.digests.append(node[1])
            self.kids.append([])
            self.kids[number] = [add(k) for k in node[2]]
            return number

        add(tree)

    def align(self, root: Node) -> list[tuple[Node, int]]:
        """Pairs (page node, reference node) of a best match."""
        pairs: list[tuple[Node, int]] = []
        scores: dict[tuple[int, int], tuple] = {}
        labels, digests, kids = self.labels, self.digests, self.kids
        seen: dict[int, tuple[list[Node], int]] = {}

        def about(node: Node) -> tuple[list[Node], int]:
            if id(node) not in seen:
                seen[id(node)] = _blocks(node), own_digest(node)
            return seen[id(node)]

        def match(node: Node, ref: int) -> float:
            """Matched nodes below and at two nodes of one label, and a little for equal texts."""
            key = (id(node), ref)
            if key in scores:
                return scores[key][0]
            own, digest = about(node)
            theirs = [(j, b, labels[b], digests[b], kids[b]) for j, b in enumerate(kids[ref])]
            above = [0.0] * (len(theirs) + 1)
            table = [above]
            for a in own:
                label, (below, text) = a.label, about(a)
                row, last = [0.0], 0.0
                for j, b, other, same, more in theirs:
                    if above[j + 1] > last:
                        last = above[j + 1]
                    if label == other:
                        # Two nodes without a pair of children need no table.
                        both = above[j] + (match(a, b) if below and more else 1.5 if same and same == text else 1.0)
                        if both > last:
                            last = both
                    row.append(last)
                table.append(row)
                above = row
            same = digests[ref] and digests[ref] == digest
            scores[key] = (1.0 + 0.5 * bool(same) + above[-1], table, own)
            return scores[key][0]

        match(root, 0)
        todo = [(root, 0)]
        while todo:
            node, ref = todo.pop()
            pairs.append((node, ref))
            if (id(node), ref) not in scores:
                continue
            _, table, own = scores[id(node), ref]
            i, j = len(own), len(kids[ref])
            while i and j:
                if table[i][j] == table[i - 1][j]:
                    i -= 1
                elif table[i][j] == table[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((own[i], kids[ref][j]))
        return pairs


@functools.lru_cache(maxsize=256)
def reference(text: str) -> Reference:
    return Reference(text)


def evidence(page: str, ref: Reference) -> list[tuple[int, bool, bool, int]]:
    """(reference node, same text?, does text vary at or below it?, its varying characters) of the aligned nodes.

    The characters are those that no tag, role or class names and that are in no link. None from a copy.
    """
    root = parse(page)
    if _longest(root) == ref.longest:
        return []
    pairs = ref.align(root)
    number = {id(n): r for n, r in pairs}
    below: dict[int, tuple[bool, int]] = {}

    def weigh(node: Node) -> tuple[bool, int]:
        text, r = own_text(node), number.get(id(node))
        varies = bool(text) and not (r is not None and ref.digests[r] == own_digest(node))
        size = max(0, len(text) - _linked(node)) if varies else 0
        for k in _blocks(node):
            some, more = weigh(k)
            if k.kind != "drop" or _opens(k):
                varies |= some
            if not k.kind or _opens(k):
                size += more
        below[id(node)] = varies, size
        return varies, size

    weigh(root)
    return [(r, bool(ref.digests[r]) and ref.digests[r] == own_digest(n), *below[id(n)]) for n, r in pairs]


def _linked(node: Node) -> int:
    """Characters of a node's own text that are in links."""
    size, todo = 0, [(k, k.tag == "a") for k in node.kids if isinstance(k, Node) and k.tag in _INLINE]
    while todo:
        n, inside = todo.pop()
        for k in n.kids:
            if isinstance(k, str):
                size += len(k) if inside else 0
            elif k.tag in _INLINE:
                todo.append((k, inside or k.tag == "a"))
    return size


def _has(node: Node, tags: frozenset[str]) -> bool:
    todo = [node]
    while todo:
        n = todo.pop()
        for k in n.kids:
            if isinstance(k, Node):
                if k.tag in tags and k.kind != "comment":
                    return True
                todo.append(k)
    return False


def _opens(node: Node, tags: frozenset[str] = frozenset({"article", "main"})) -> bool:
    """Whether a node dropped by a role or name, and by no tag, holds an article all the same."""
    return node.kind in ("drop", "named") and node.tag not in _DROP_TAGS and _has(node, tags)


def _articles(root: Node, tags: frozenset[str]) -> list[Node]:
    """Uppermost nodes of the tags that are not inside something dropped."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        for k in reversed(n.kids):
            if isinstance(k, Node) and (not k.kind or _opens(k, tags)):
                if k.tag in tags:
                    out.append(k)
                else:
                    todo.append(k)
    return out


def _link_share(node: Node) -> float:
    """Share of a node's text that lies in links."""
    total = linked = 0
    todo = [(node, node.tag == "a")]
    while todo:
        n, inside = todo.pop()
        for k in n.kids:
            if isinstance(k, str):
                size = len("".join(k.split()))
                total += size
                linked += size if inside else 0
            elif not k.kind:
                todo.append((k, inside or k.tag == "a"))
    return linked / total if total else 0.0


class Told(NamedTuple):
    """What the testifying pages say of a reference node."""

    share: float  # of the pages, those with the reference's text
    aligned: int  # pages
    varies: int  # pages whose text varies at or below the node
    size: int  # varying characters below it, over all pages


@functools.lru_cache(maxsize=256)
def told_of(template: str) -> dict[int, Told]:
    return {e["node"]: Told(e["share"], e["aligned"], e["varies"], e["size"]) for e in json.loads(template)}


def region(ref: Reference, template: dict[int, Told]) -> int | None:
    """The lowest container that holds most of what varies on the host; none if too few pages testify."""
    whole = template.get(0)
    if whole is None or whole.aligned < INSIDE[1] or not whole.size:
        return None
    return max((r for r, t in template.items() if ref.kids[r] and t.size >= REGION * whole.size), default=None)


def extract(page: str, ref: Reference | None = None, template: dict[int, Told] | None = None) -> str:
    """Main text of a page. ``template``: what the host's pages say of the reference's nodes.

    If the template shows where the host's pages vary, the whole page is read: constant nodes go, and in that
    region a class or id that is a hint does not outweigh text that varies. Otherwise articles are read.
    """
    root = parse(page)
    number = {id(n): r for n, r in ref.align(root)} if ref and template else {}
    at = region(ref, template) if number else None
    area = next((id(k) for k in _all(root) if number.get(id(k)) == at), None) if at is not None else None
    tops = _articles(root, frozenset({"article"})) or _articles(root, frozenset({"main"}))
    teasers: set[int] = set()
    if len(tops) > 1:
        # Teasers for other pages are short and mostly links.
        real = [t for t in tops if _link_share(t) < 0.5]
        teasers = {id(t) for t in tops if t not in real} if real else teasers
        tops = real or tops
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            blocks.append(text)

    def constant(node: Node, inside: bool) -> bool:
        r = number.get(id(node))
        if r not in template:
            return False
        share, pages = INSIDE if inside else OUTSIDE
        told = template[r]
        return told.share >= share and told.aligned >= pages and ref.digests[r] == own_digest(node)

    def varying(node: Node) -> bool:
        """Whether the host's pages say that a named node is content; lists of links are none."""
        told = template.get(number.get(id(node), -1))
        return told is not None and told.aligned >= INSIDE[1] and 2 * told.varies >= told.aligned and _link_share(node) <= 0.6

    def taken(k: Node, within: bool, inside: bool) -> bool:
        if id(k) in teasers:
            return False
        if k.kind and not (not inside and _opens(k)) and not (within and k.kind != "drop" and varying(k)):
            return False
        return inside or not (k.tag == "header" or k.tag in ("ul", "ol") and _link_share(k) > 0.6)

    def walk(node: Node, within: bool, inside: bool) -> None:
        """``within``: in the region. ``inside``: there or in an article, unless the region is the whole body."""
        within = within or id(node) == area
        inside = inside or node.tag in ("article", "main") or id(node) == area and node.tag not in ("#root", "html", "body")
        quiet = bool(number) and constant(node, inside)
        for k in node.kids:
            if isinstance(k, str):
                if not quiet:
                    line.append(k)
            elif k.tag in _INLINE:
                if not quiet and not k.kind:
                    walk(k, within, inside)
            else:
                flush()
                if taken(k, within, inside):
                    walk(k, within, inside)
                flush()

    if area is not None:
        tops = []
    for top in tops or [root]:
        walk(top, False, bool(tops))
        flush()
    return " ".join(blocks)


def _all(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        yield (n := todo.pop())
        todo += _blocks(n)


def _attach(left: DataFrame, right: DataFrame, size: int, how: str) -> DataFrame:
    """Join on host; the right side is broadcast if it was measured to be small."""
    return left.join(F.broadcast(right) if size <= BROADCAST_BYTES else right, "host", how)


def _poor() -> Column:
    """0 for a page that ends in </html> and opens two blocks or more, 1 for another."""
    whole = F.lower(F.substring(F.rtrim("html"), -7, 7)) == "</html>"
    return F.when(whole & (F.regexp_count("html", F.lit(_OPENS)) >= 2), 0).otherwise(1)


def typical(rows: DataFrame) -> DataFrame:
    """(host, n, low): pages of every host, and (poor, size, ref_id) of its typical page.

    That is a page of the median length, to a tenth, among the host's pages that are not poor; among all
    only where no other is left. Lengths are counted in bands, a few hundred a host at any size.
    """
    size = F.length("html")
    bands = rows.filter("host <> ''").groupBy("host", _poor().alias("poor"), F.floor(8 * F.log2(size + 1)).alias("band"))
    bands = bands.agg(F.count("*").alias("n"), F.min(F.struct(size.alias("size"), F.col("page_id").alias("ref_id"))).alias("low"))
    kind = W.partitionBy("host", "poor")
    bands = bands.select(
        "host", "poor", "low", "n", F.sum("n").over(kind).alias("total"), F.sum("n").over(kind.orderBy("band")).alias("upto")
    )
    low = F.struct("poor", "low.size", "low.ref_id")
    return bands.groupBy("host").agg(F.sum("n").alias("n"), F.min(F.when(2 * F.col("upto") >= F.col("total"), low)).alias("low"))


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html; others are not read).

    Null html is an empty page, and a page without main text has an empty text. Pages without a host in
    their url, and hosts with fewer than ``min_pages`` pages, go by tags, roles and classes alone.
    Repeated rows are pages of their own; they are copies, so they add nothing to the template.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
        F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"),
    )
    with Scratch(pages.sparkSession, "wrappers") as scratch:
        hosts = scratch.table(typical(rows).filter(F.col("n") >= min_pages).select("host", "low.*"))
        many = hosts.count()
        first = _attach(rows, hosts, many * 100, "inner")
        first = first.filter(F.col("page_id").eqNullSafe(F.col("ref_id")) & (F.length("html") == F.col("size")) & (_poor() == F.col("poor")))

        def outline(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = pa.array([skeleton(p) for p in batch.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["host", "skeleton"])

        outlines = first.select("host", "html").mapInArrow(outline, "host string, skeleton string")
        outlines = scratch.table(outlines.groupBy("host").agg(F.min("skeleton").alias("skeleton")))
        size = outlines.agg(F.coalesce(F.sum(F.length("skeleton") + F.length("host") + 50), F.lit(0))).first()[0]

        counts = ["aligned", "equal", "varies", "size"]

        def testify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                aligned, equal, varies, size = Counter(), Counter(), Counter(), Counter()
                for host, page, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    for node, same, vary, chars in evidence(page, reference(text)):
                        aligned[host, node] += 1
                        equal[host, node] += same
                        varies[host, node] += vary
                        size[host, node] += chars
                keys = list(aligned)
                columns = [[h for h, _ in keys], [n for _, n in keys], *([c[k] for k in keys] for c in (aligned, equal, varies, size))]
                types = [pa.string(), pa.int32(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "node", *counts]
                )

        said = _attach(rows.select("host", "html"), outlines, size, "inner")
        said = said.mapInArrow(testify, "host string, node int, " + ", ".join(f"{c} long" for c in counts))
        said = said.groupBy("host", "node").agg(*(F.sum(c).alias(c) for c in counts))
        said = said.filter(F.col("aligned") >= min(OUTSIDE[1], INSIDE[1]))
        entry = F.struct("node", (F.col("equal") / F.col("aligned")).alias("share"), "aligned", "varies", "size")
        told = said.groupBy("host").agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("template"))
        wrappers = durable(outlines.join(told, "host"), "wrappers")
    size = wrappers.agg(F.coalesce(F.sum(F.length("skeleton") + F.length("template") + 50), F.lit(0))).first()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, text, template in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                out.append(extract(page, reference(text) if text else None, told_of(template) if template else None))
            texts, lengths = pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts, lengths], names=["page_id", "url", "text", "n_chars"])

    joined = _attach(rows, wrappers, size, "left").select("page_id", "url", "html", "skeleton", "template")
    return joined.mapInArrow(read, "page_id long, url string, text string, n_chars long")
