"""Main text of web pages by wrapper induction.

Pages of one host share a template. A page's DOM is reduced to its block elements,
with runs of like siblings folded into one; that skeleton is aligned by simple
tree matching (the largest common ordered tree) to its host's most frequent
skeleton. Nodes whose text is the same on all pages that fill them are template,
nodes whose text varies are slots. A page's text is what stands in its slots, less
what their marks say isn't the article: menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and comments. If a page marks its article or main
part, only that counts.

A host's pages only meet in counts (of skeletons, and of different texts per
node), so a host may hold any share of the pages.

Defined cases: null html is empty, an empty page has an empty text; a null or odd
url is a host of its own spelling; pages that differ in marked parts only count once
as evidence, and a node is template only on ``EVIDENCE`` different pages, and where
some other node of the host varies; broken markup is read as far as it goes, and text in
elements nested deeper than ``DEEPEST`` belongs to the deepest one kept, with the marks
of its own elements.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

EVIDENCE = 5
DEEPEST = 60

# Fixed values of HTML and of common page markup.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg select".split())
BLOCKS = set(
    "html head body article aside blockquote center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"html", "head", "body"}
CLOSED_BY_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
NOT_CONTENT = set("head nav header footer aside form menu dialog search button".split())
MARKS = set(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer "
    "header masthead menu modal nav navbar navigation newsletter notice popup promo promoted related share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = set("banner navigation contentinfo complementary search menu dialog alert form".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>])*?)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[a-z]+")


class Node:
    """A block element; ``main`` and ``boiler`` say what it and its ancestors are marked as.

    ``kept`` is the deepest element of the tree around one that is nested too deep for it.
    """

    __slots__ = ("label", "children", "boiler", "main", "place", "tag", "kept")

    def __init__(self, tag: str, label: str, boiler: bool, main: bool, kept: Node | None = None):
        self.tag, self.label, self.children, self.boiler, self.main, self.place, self.kept = tag, label, [], boiler, main, -1, kept

    @property
    def number(self) -> int:
        return (self.kept or self).place


def parse(text: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of a page's block elements and its blocks of text, in page order."""
    root = Node("", "", False, False)
    stack, blocks, run = [root], [], []
    opened: Counter[str] = Counter()

    def close_run() -> None:
        if run:
            words = " ".join("".join(run).split())
            if words:
                blocks.append((stack[-1], words))
            run.clear()

    def leave(i: int) -> None:
        for node in stack[i:]:
            opened[node.tag] -= 1
        del stack[i:]

    at, size = 0, len(text)
    while at < size:
        m = _TOKEN.search(text, at)
        if m is None:
            run.append(entities.unescape(text[at:]))
            break
        if m.start() > at:
            run.append(entities.unescape(text[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                close_run()
                if opened[tag]:
                    leave(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            continue
        if tag == "br" or tag == "hr":
            run.append(" ")
            continue
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
            at = end.end() if end else size
            continue
        if tag not in BLOCKS or tag in VOID:
            continue
        close_run()
        if tag in CLOSES_P and stack[-1].tag == "p":
            leave(-1)
        if stack[-1].tag in CLOSED_BY_LIKE.get(tag, ()):
            leave(-1)
        names = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(m[3])}
        words = set(_NAME.findall(names.get("class", "") + " " + names.get("id", "")))
        role = names.get("role", "")
        inside = stack[-1]
        boiler = inside.boiler or tag in NOT_CONTENT or role in ROLES or bool(words & MARKS)
        main = inside.main or tag in ("article", "main") or role in ("article", "main")
        if len(stack) >= DEEPEST:  # only open: its text goes to the deepest element of the tree
            node = Node(tag, "", boiler, main, inside.kept or inside)
        else:
            node = Node(tag, ".".join([tag, *sorted(words)]), boiler, main)
            inside.children.append(node)
        stack.append(node)
        opened[tag] += 1
    close_run()
    return root, blocks


def skeleton(root: Node) -> list:
    """[label, children] with runs of like siblings folded; numbers the page's nodes by it, in preorder."""
    count = 0

    def fold(label: str, nodes: list[Node]) -> list:
        nonlocal count
        for n in nodes:
            n.place = count
        count += 1
        runs: list[list[Node]] = []
        for child in (c for n in nodes for c in n.children):
            if runs and runs[-1][0].label == child.label:
                runs[-1].append(child)
            else:
                runs.append([child])
        return [label, [fold(r[0].label, r) for r in runs]]

    return fold("", [root])


def _numbered(tree: list, at: int = 0) -> tuple[list, int]:
    label, children = tree
    own, at, made = at, at + 1, []
    for c in children:
        sub, at = _numbered(c, at)
        made.append(sub)
    return [label, made, own], at


def align(page: list, reference: list) -> dict[int, int]:
    """Simple tree matching: the numbers of a skeleton's nodes to those of the reference they match."""
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(a: list, b: list) -> tuple[int, list]:
        if a[0] != b[0]:
            return 0, []
        key = (a[2], b[2])
        if key in memo:
            return memo[key]
        n, m = len(a[1]), len(b[1])
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(1, n + 1):
            for j in range(1, m + 1):
                here = match(a[1][i - 1], b[1][j - 1])[0]
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + here)
        pairs, i, j = [], n, m
        while i and j:
            here = match(a[1][i - 1], b[1][j - 1])[0]
            if here and best[i][j] == best[i - 1][j - 1] + here:
                pairs.append((a[1][i - 1], b[1][j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        memo[key] = (1 + best[n][m], pairs)
        return memo[key]

    a, b = _numbered(page)[0], _numbered(reference)[0]
    out: dict[int, int] = {}
    todo = [(a, b)] if match(a, b)[0] else []
    while todo:
        x, y = todo.pop()
        out[x[2]] = y[2]
        todo += match(x, y)[1]
    return out


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes, nodes, hashes = [], [], []
        for text in batch.column("html").to_pylist():
            root, blocks = parse(text or "")
            shapes.append(json.dumps(skeleton(root), separators=(",", ":")))
            texts: dict[int, list[str]] = {}
            for node, words in blocks:
                if not node.boiler:
                    texts.setdefault(node.number, []).append(words)
            nodes.append(list(texts))
            hashes.append([xxhash.xxh64_intdigest("\n".join(t)) - (1 << 63) for t in texts.values()])
        made = [pa.array(shapes, pa.string()), pa.array(nodes, pa.list_(pa.int32())), pa.array(hashes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column("host"), *made], ["host", "skeleton", "nodes", "hashes"])


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for page, reference in zip(batch.column("skeleton").to_pylist(), batch.column("reference").to_pylist()):
            found.append(list(align(json.loads(page), json.loads(reference)).items()))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("skeleton"), pa.array(found, pa.map_(pa.int32(), pa.int32()))], ["host", "skeleton", "match"])


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, reference, template): each host's reference skeleton and the numbers of its template nodes."""
    ship(pages.sparkSession)
    rows = pages.select(host_of(F.col("url")).alias("host"), "html")
    seen = rows.mapInArrow(_skeletons, "host string, skeleton string, nodes array<int>, hashes array<long>")
    seen = stored(seen.distinct(), "skeletons")
    shapes = seen.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("pages"))
    references = shapes.groupBy("host").agg(F.max_by("skeleton", F.struct("pages", "skeleton")).alias("reference"))
    matched = shapes.join(references, "host").select("host", "skeleton", "reference").mapInArrow(_aligned, "host string, skeleton string, match map<int,int>")
    slots = seen.join(matched, ["host", "skeleton"]).select("host", "match", F.explode(F.arrays_zip("nodes", "hashes")).alias("s"))
    slots = slots.select("host", F.col("match")[F.col("s.nodes")].alias("node"), F.col("s.hashes").alias("hash")).where("node IS NOT NULL")
    nodes = slots.groupBy("host", "node").agg(F.count(F.lit(1)).alias("pages"), (F.min("hash") == F.max("hash")).alias("constant"))
    varied = nodes.where("NOT constant").select("host").distinct()
    template = nodes.where((F.col("pages") >= EVIDENCE) & F.col("constant")).join(varied, "host")
    template = template.groupBy("host").agg(F.collect_set("node").alias("template"))
    return references.join(template, "host", "left").withColumn("template", F.coalesce("template", F.array().cast("array<int>")))


def main_text(page: str, reference: str | None, template: set[int], known: dict) -> str:
    """A page's text, given its host's wrapper; ``known`` keeps alignments of skeletons seen before."""
    root, blocks = parse(page)
    shape = skeleton(root)
    constant: set[int] = set()
    if template and reference:
        key = (json.dumps(shape, separators=(",", ":")), reference)
        match = known.get(key)
        if match is None:
            if len(known) > 10_000:
                known.clear()
            match = known[key] = align(shape, json.loads(reference))
        constant = {n for n, r in match.items() if r in template}
    kept = [(n, t) for n, t in blocks if not n.boiler and n.number not in constant]
    if any(n.main for n, _ in kept):
        kept = [(n, t) for n, t in kept if n.main]
    return " ".join(t for _, t in kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        names = ("html", "reference", "template")
        texts = [main_text(h or "", r, set(t or ()), known) for h, r, t in zip(*(batch.column(n).to_pylist() for n in names))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every row of ``pages``."""
    own = stored(wrappers(pages), "wrappers").withColumnRenamed("host", "_host")
    rows = pages.select("page_id", "url", "html").join(own, host_of(F.col("url")) == F.col("_host"), "left")
    return rows.select("page_id", "url", "html", "reference", "template").mapInArrow(_extract, "page_id long, url string, text string")
