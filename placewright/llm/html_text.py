"""Main text of web pages by a site style tree.

Pages of a host are merged, copies of a page (the same blocks) once unless an ``article`` or ``main`` element tells their
content from the rest: a node of the tree is an element's place (the
tags and classes from the root, with the number among equals), and the tree counts how its content varies over all the
host's pages. A page without the node counts as a variant of its own, so that what a few pages share, as copies of an
article in different frames do, is not taken for the site's. With m pages a node has importance - sum p log_m p over
its variants: 0 for what every page repeats, 1 for what no two pages share. An inner node is worth its most important
content; its presentation (the sequence of its children) is counted but decides nothing, as a site shows its articles
alike. Branches of low importance are removed from every page, and so are elements that never hold content
(scripts, forms, menus ... by tag, or by a whole class, id or role; inside an article by fewer words, and never a
paragraph or heading). Nothing of this rules out html, body, main, article
or an element that holds one of them, nor a form that holds blocks: of it only the controls go. What stands in an ``article`` or ``main`` element is content and
only loses branches of the second kind: copies of one article on a host must not remove each other."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._io import BROADCAST_ROWS, saved, small
from ._words import slices

# Fixed values of HTML: elements by how they are written and shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
NEVER = frozenset("script style textarea title noscript template iframe noembed noframes xmp head nav footer aside form header button select option input label svg canvas object audio video map menu dialog".split())
#: words in a class, id or role that name what is not content
NOISE = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies disqus footer gdpr header masthead menu menubar nav navbar navigation newsletter notice pager pagination popup promo promoted related reply replies respond search share sharing sidebar skip social sponsor sponsored subscribe subscription toolbar widget widgets".split())
#: those that rule out a container inside an article; there, headings and paragraphs are ruled out by none
NOISE_INSIDE = NOISE - frozenset("banner complementary contentinfo footer header masthead notice pager related respond search skip".split())
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
#: an opening tag of these ends an open p
ENDS_P = BLOCK - {"html", "body"}
MAIN = frozenset(("article", "main"))
#: what nothing rules out, nor anything around it; blocks that a form is kept for
KEPT = MAIN | {"html", "body"}
WRAPPED = BLOCK - {"form", "fieldset"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?][^>]*>|<(?:/?[a-zA-Z!?])[^<>]*+\Z""", re.S)
#: the same behind the last ">", with as many groups
_CUT = re.compile(r"""<!--.*|<(?:/?[a-zA-Z!?])[^<>]*+\Z|(?!)()()()""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")

#: the root's node
ROOT = 0


class Page:
    """A page's blocks that no name rules out, as (text, node, in the main element), and the child sequences of its inner
    nodes outside main elements. A node is a hash of its element's place: of the parent's node and the step below it.

    Time and memory are in proportion to the page: open elements are found by tag and by kind, not by going through
    all of them, and a place is kept as its parent and one step."""

    __slots__ = ("found", "children", "steps")

    def __init__(self, source: str, structure: bool):
        self.found: list[tuple[str, int, bool]] = []
        self.children: dict[int, list[str]] = {}
        self.steps: dict[int, tuple[int, str]] = {}  # node: its parent, its step
        # open elements: (tag, node, the innermost form and other element that rule it out, in main, how many of each child)
        stack: list[tuple[str, int, tuple[int, int], bool, dict[str, int]]] = [("", ROOT, (0, 0), False, {})]
        opened: dict[str, list[int]] = {}  # where each tag is open
        block_at, main_at = [0], [0]  # where blocks and main elements are open
        held: list[tuple[str, tuple[int, int]]] = []
        blocks: list[tuple[list[tuple[str, tuple[int, int]]], int, bool]] = []
        children: list[tuple[int, str, tuple[int, int]]] = []
        outer: dict[int, int] = {}  # the next one of the same kind around it
        lifted = {0}  # elements that turned out to hold content, and all of their kind around them
        at, end = 0, len(source)
        raw = ""

        def lift(k: int) -> None:
            while k not in lifted:
                lifted.add(k)
                k = outer[k]

        def flush() -> None:
            if held:
                place = stack[block_at[-1]]
                blocks.append((held.copy(), place[1], place[3]))
                held.clear()

        def close(i: int) -> None:
            """End the open elements from the i-th on."""
            for x in stack[i:]:
                opened[x[0]].pop()
            del stack[i:]
            for places in (block_at, main_at):
                while places[-1] >= i:
                    places.pop()

        # Behind the last ">" only a cut-off tag or comment can stand.
        last = source.rfind(">") + 1
        for m in chain(_TAG.finditer(source, 0, last), _CUT.finditer(source, last)):
            if raw:  # inside a raw element only its own end counts
                if m[2] is None or not m[1] or m[2].lower() != raw:
                    continue
                raw = ""
                at = m.start()
            if m.start() < at:
                continue
            if m.start() > at and stack[-1][0] not in RAW:
                held.append((source[at : m.start()], stack[-1][2]))
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<!--") and (len(m[0]) < 7 or not m[0].endswith("-->")):
                    at = end  # a comment without an end
                    break
                continue
            tag = m[2].lower()
            if m[1]:
                i = opened[tag][-1] if opened.get(tag) else 0
                if i and (main_at[-1] <= i or tag in ("body", "html")):  # a stray end does not close the article
                    if tag in BLOCK:
                        flush()
                    close(i)
                continue
            if tag in BLOCK:
                flush()
                # omitted end tags, as the standard has them: an open p or one of the same kind ends, if no block is between
                if tag in ENDS_P and stack[block_at[-1]][0] == "p":
                    close(block_at[-1])
                if tag in ("li", "dd", "dt", "tr") and stack[block_at[-1]][0] == tag:
                    close(block_at[-1])
            elif tag in ("br", "td", "th", "img", "hr"):
                held.append((" ", (0, 0)))
            if tag in VOID:
                continue
            names = [x for a in _ATTRIBUTE.findall(m[3]) if a[0].lower() in ("class", "id", "role") for x in (a[1] or a[2] or a[3]).split()] if m[3] else []
            labels = [x.lower() for name in names for x in _SPLIT.split(name) if x]
            parent = stack[-1]
            form, other = ruled = parent[2]
            words = NOISE if not parent[3] else () if tag in TEXT else NOISE_INSIDE
            if tag in WRAPPED:
                lift(form)
            if tag in KEPT:
                lift(form)
                lift(other)
            elif any(x.lower() in words for x in names) or (tag in NEVER and tag != "form" and not (tag == "header" and parent[3])):
                ruled = form, m.start() + 1
                outer[ruled[1]] = other
            elif tag == "form":
                ruled = m.start() + 1, other
                outer[ruled[0]] = form
            step = f"{tag}.{'.'.join(labels)}" if labels else tag
            number = parent[4].get(step, 0) + 1
            parent[4][step] = number
            node, main = parent[1], parent[3] or tag in MAIN
            if tag in BLOCK:
                node = _key(str(parent[1]), f"{step}{number}")
                self.steps[node] = parent[1], f"{step}{number}"
                if structure and not parent[3]:
                    children.append((parent[1], step, parent[2]))
                block_at.append(len(stack))
            if tag in MAIN:
                main_at.append(len(stack))
            opened.setdefault(tag, []).append(len(stack))
            stack.append((tag, node, ruled, main, {}))
            if tag in RAW and m[3][-1:] != "/":
                raw = tag
        if at < end and not raw and stack[-1][0] not in RAW:
            held.append((source[at:], stack[-1][2]))
        flush()
        for pieces, node, main in blocks:
            text = " ".join(html.unescape("".join(x for x, ruled in pieces if lifted.issuperset(ruled))).split())
            if text:
                self.found.append((text, node, main))
        for node, step, ruled in children:
            if lifted.issuperset(ruled):
                self.children.setdefault(node, []).append(step)

    @property
    def blocks(self) -> list[tuple[str, str, bool]]:
        """(text, path from the root, in the main element), for reading."""
        out = []
        for text, node, main in self.found:
            path = []
            while node != ROOT:
                node, step = self.steps[node]
                path.append(step)
            out.append((text, "".join(f"/{x}" for x in reversed(path)), main))
        return out

    def low(self, noise: frozenset[int]) -> set[int]:
        """The nodes that are noise or stand below one that is."""
        known = {ROOT: ROOT in noise}
        for _, node, main in self.found:
            way = []
            while node not in known:
                way.append(node)
                node = self.steps[node][0]
            for x in reversed(way):
                known[x] = x in noise or known[self.steps[x][0]]
        return {x for x, low in known.items() if low}


def _key(*parts: str) -> int:
    return int.from_bytes(blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#:]*)", 1))


def style_tree(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, node, parent, variants, pages, entropy): the nodes outside main elements; entropy is that of their content
    (blocks) or presentation (inner nodes) over the host's different pages, to the base of their number; ``pages`` is the
    number of those with the node. Pages without any block are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", 8_000_000):
            hosts, keys, mains, lists = [], [], [], ([], [], [])
            for host, text in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                page = Page(text or "", True)
                if not page.found:
                    continue
                content: dict[int, list[str]] = {}
                for block, node, main in page.found:
                    if not main:
                        content.setdefault(node, []).append(block)
                nodes = {n: _key("content", *c) for n, c in content.items()} | {n: _key("children", *c) for n, c in page.children.items() if n not in content}
                hosts.append(host)
                mains.append(any(main for _, _, main in page.found))
                keys.append(_key(*[x for block, node, _ in page.found for x in (str(node), block)]))
                for own, values in zip(lists, (list(nodes), [page.steps[n][0] if n != ROOT else ROOT for n in nodes], list(nodes.values()))):
                    own.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(mains, pa.bool_()), *[pa.array(x, pa.list_(pa.int64())) for x in lists]], ["host", "page", "main", "nodes", "parents", "variants"])

    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(source).alias("html"))
    parsed = rows.mapInArrow(run, "host string, page long, main boolean, nodes array<long>, parents array<long>, variants array<long>")
    different = parsed.groupBy("host", "page").agg(F.count(F.lit(1)).alias("copies"), F.first(F.struct("main", "nodes", "parents", "variants")).alias("x"))
    different = saved(different.select("host", "page", "x.*", F.when(F.col("x.main"), F.col("copies")).otherwise(F.lit(1)).alias("n")), "style-pages")
    all_pages = different.groupBy("host").agg(F.sum("n").alias("all"))
    nodes = different.select("host", "n", F.explode(F.arrays_zip("nodes", "parents", "variants")).alias("x"))
    counts = nodes.groupBy("host", F.col("x.nodes").alias("node"), F.col("x.parents").alias("parent"), F.col("x.variants").alias("variant")).agg(F.sum("n").alias("n"))
    # - sum p log p = log m - (sum n log n) / m
    sums = counts.groupBy("host", "node", "parent").agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("variants"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("all") > 1, 1 - F.col("nlogn") / (F.col("all") * F.log("all"))).otherwise(1.0)
    return sums.join(all_pages, "host").select("host", "node", "parent", "variants", "pages", entropy.alias("entropy"))


def noise_nodes(tree: DataFrame, threshold: float = 0.2, min_pages: int = 2) -> DataFrame:
    """(host, node): content nodes that at least ``min_pages`` pages share and whose importance is at most ``threshold``.
    An inner node is worth what its most important content is, so that a branch goes when all its content does."""
    inner = tree.select("host", F.col("parent").alias("node")).distinct()
    leaves = tree.join(inner, ["host", "node"], "left_anti")
    return leaves.where((F.col("pages") >= min_pages) & (F.col("entropy") <= threshold)).select("host", "node")


def extract(pages: DataFrame, threshold: float = 0.2, min_pages: int = 2, url: str = "url", source: str = "html", page_id: str = "page_id", salts: int = 64, limit: int = BROADCAST_ROWS) -> DataFrame:
    """One row a row of ``pages``: page_id, url, text, n_chars.

    Character references are decoded, white space in a block becomes one space, blocks are joined by \\n in page order.
    A row a row, repeated rows too; no rows give no rows. Pages of any length and depth take time in proportion.
    Null or empty html gives an empty text; a null or unreadable url belongs to the host ''. Broken and truncated markup
    is read as far as it goes. A host with fewer than ``min_pages`` pages loses nothing by importance. The noise nodes
    go to all executors if they are at most ``limit``, else to the pages by (host, salt). Extra columns are ignored."""
    noise = saved(noise_nodes(saved(style_tree(pages, url, source), "style-tree"), threshold, min_pages), "noise-nodes")
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"), host_of(F.col(url)).alias("host"))
    table: dict[str, frozenset[int]] | None = None
    if small(noise, limit):
        table = {}
        for r in noise.groupBy("host").agg(F.collect_set("node").alias("nodes")).toArrow().to_pylist():
            table[r["host"]] = frozenset(r["nodes"])
        rows = rows.drop("host").withColumn("host", host_of(F.col("url")))
    else:
        lists = noise.groupBy(F.col("host").alias("_host")).agg(F.collect_set("node").alias("nodes")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("html"), F.lit(salts)).cast("int"))
        rows = dealt.join(lists, (F.col("host") == F.col("_host")) & (F.col("_deal") == F.col("_salt")), "left").select("page_id", "url", "html", "host", "nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "html", 8_000_000):
            nodes = [table.get(h, frozenset()) for h in b.column("host").to_pylist()] if table is not None else [frozenset(x or ()) for x in b.column("nodes").to_pylist()]
            out = []
            for source_, own in zip(b.column("html").to_pylist(), nodes):
                page = Page(source_ or "", False)
                low = page.low(own) if own else ()
                out.append("\n".join(text for text, node, main in page.found if main or node not in low))
            cols = [b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array(np.array([len(x) for x in out], np.int64))]
            yield pa.RecordBatch.from_arrays(cols, ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

