"""HTML extraction by wrapper induction.

Pages of a host with equal layouts (the labels of the first levels of their trees) are aligned by simple tree matching: of
two nodes with equal labels, children are matched in order so that as many nodes as possible have partners.  Folding them
keeps what all have in common, and of their texts whether they are all alike: the template.  A page aligned with its
template has constant texts, and texts in varying slots: those of the template's own leaves, and those of elements that
have children the template doesn't know.

What a slot holds over all pages decides what it is.  From the root of the template, the way leads to the child with half
or more of the varying text outside links, as long as there is one that isn't a paragraph or another piece of running
text; where it ends is the content.  Constant texts go, and
within the content so do subtrees of mostly links.  A varying main heading before the content belongs to it.

Marks (elements, classes and roles, :mod:`tidewater.llm.dom`) don't choose the content of a page that has a template.
``marks`` says whether blocks marked as furniture within it, such as readers' comments and adverts, go as well.  Pages without
a template have nothing but marks to go by: what isn't marked stays, or only what is within article or main elements
if that is half of it or more.  A layout of a host needs ``LEAST`` different pages for a template, and pages that vary
in a tenth of their text or more, as copies of one page have nothing in common that is furniture.

Folding takes any order and any grouping, so that a host's pages are folded within salted parts first, and then the
parts; no task gets more than a part of a host, and a template is never larger than the smallest page of its layout.
Templates go to pages by part as well.  Trees have hashes in place of texts; the texts themselves are found again where a
page is read and are moved once, compressed, to meet what was decided of them.  Tables of more than ``CELLS`` pairs of children aren't made; such children are matched in order, from label to label.

Defined results for odd input: a null or empty html gives an empty text; a null or malformed URL is a host of its own;
equal pages of a host count as one page of the template and are all extracted; unclosed elements end with their parents;
other columns aren't read; an empty table has no rows.
"""

from __future__ import annotations

import marshal
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import dom, scratch
from tidewater.llm.text import only, whole

LEAST = 5
SALTS = 64
CELLS = 1 << 22
SMALL = 400
LEVELS = 3
VARYING = 0.1
HOST = re.compile(r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", re.I)

#: A tree: label, shape, number of nodes, text's hash (0: varies; -1: an element), leaf's number, children.
Tree = tuple[int, int, int, int, int, tuple]
_weights: dict[tuple[int, int], int] = {}


def made(label: int, text: int, leaf: int, kids: tuple) -> Tree:
    shape = hash((label, tuple([k[1] for k in kids])))
    return (label, shape, 1 + sum([k[2] for k in kids]), text, leaf, kids)


def tree(root: dom.Node, texts: list[str]) -> Tree:
    def of(node: dom.Node) -> Tree:
        kids = tuple([of(k) for k in node.kids])
        return made(dom.label_hash(node.label), dom.text_hash(texts[node.leaf]) if node.leaf >= 0 else -1, node.leaf, kids)

    return of(root)


def layout(t: Tree, levels: int = LEVELS) -> int:
    """The labels of the first levels; a run of siblings with one label is one."""
    if levels == 0:
        return t[0]
    own = [layout(k, levels - 1) for k in t[5] if k[4] < 0]
    return hash((t[0], tuple([x for i, x in enumerate(own) if not i or x != own[i - 1]]))) & (2**62 - 1)


def weight(a: Tree, b: Tree) -> int:
    """Nodes of the largest match of two trees; known by shape once computed."""
    if a[0] != b[0]:
        return 0
    if a[1] == b[1]:
        return a[2]
    key = (a[1], b[1])
    if key not in _weights:
        if len(_weights) > 200_000:
            _weights.clear()
        lo, hi = ends(a[5], b[5])
        own = sum([x[2] for x in a[5][:lo]]) + sum([x[2] for x in a[5][len(a[5]) - hi :]])
        x, y = a[5][lo : len(a[5]) - hi], b[5][lo : len(b[5]) - hi]
        if len(x) * len(y) > CELLS:
            own += sum([weight(p, q) for p, q in in_order(x, y)])
        elif x and y:
            own += int(table(x, y)[-1][-1])
        _weights[key] = 1 + own
    return _weights[key]


def ends(a: tuple, b: tuple) -> tuple[int, int]:
    """How many children are of equal shape at the beginning and at the end; a largest match pairs them."""
    n = min(len(a), len(b))
    lo = hi = 0
    while lo < n and a[lo][1] == b[lo][1]:
        lo += 1
    while hi < n - lo and a[-1 - hi][1] == b[-1 - hi][1]:
        hi += 1
    return lo, hi


def table(a: tuple, b: tuple) -> list | np.ndarray:
    """Nodes of the largest matches of all beginnings of two lists of children."""
    if len(a) * len(b) <= SMALL:
        rows = [[0] * (len(b) + 1)]
        for x in a:
            last, row, best = rows[-1], [0], 0
            for j, y in enumerate(b):
                best = max(best, last[j + 1], last[j] + (weight(x, y) if x[0] == y[0] else 0))
                row.append(best)
            rows.append(row)
        return rows
    number: dict[int, int] = {}
    kind = np.array([number.setdefault(y[1], len(number)) for y in b])
    first = {y[1]: y for y in reversed(b)}
    kinds = [first[s] for s in number]
    known: dict[int, np.ndarray] = {}
    rows = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    for i, x in enumerate(a):
        if x[1] not in known:
            known[x[1]] = np.array([weight(x, y) for y in kinds], np.int32)[kind]
        np.maximum.accumulate(np.maximum(rows[i, 1:], rows[i, :-1] + known[x[1]]), out=rows[i + 1, 1:])
    return rows


def in_order(a: tuple, b: tuple) -> list[tuple[Tree, Tree]]:
    """Children paired from label to label, by the shorter skip where labels differ."""
    where: tuple[dict, dict] = ({}, {})
    for own, kids in zip(where, (a, b), strict=True):
        for i, k in enumerate(kids):
            own.setdefault(k[0], []).append(i)

    def after(own: dict, label: int, i: int) -> int | None:
        at = own.get(label, ())
        j = bisect_left(at, i)
        return at[j] - i if j < len(at) else None

    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i][0] == b[j][0]:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
            continue
        down, right = after(where[0], b[j][0], i), after(where[1], a[i][0], j)
        if right is None or down is not None and down <= right:
            i, j = (i + 1, j + 1) if down is None else (i + down, j)
        else:
            j += right
    return out


def matched(a: tuple, b: tuple) -> list[tuple[Tree, Tree]]:
    """The pairs of children in a largest match; equal beginnings and ends are paired without a table."""
    lo, hi = ends(a, b)
    out = list(zip(a[:lo], b[:lo], strict=True))
    tail = list(zip(a[len(a) - hi :], b[len(b) - hi :], strict=True))
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    if len(a) * len(b) > CELLS:
        out += in_order(a, b)
    elif a and b:
        rows, i, j, mid = table(a, b), len(a), len(b), []
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                mid.append((a[i], b[j]))
        out += mid[::-1]
    return out + tail


def fold(a: Tree, b: Tree) -> Tree:
    """What two trees with equal labels have in common."""
    text = a[3] if a[3] == b[3] else 0
    return made(a[0], text, -1, tuple([fold(x, y) for x, y in matched(a[5], b[5])]))


CONSTANT = -1


def slots(template: Tree, page: Tree, n: int) -> list[int]:
    """For each of the page's ``n`` texts the template's node (in preorder) it is in, or CONSTANT."""
    out = [0] * n

    def under(t: Tree, at: int) -> None:
        if t[4] >= 0:
            out[t[4]] = at
        for k in t[5]:
            under(k, at)

    def walk(a: Tree, b: Tree, at: int) -> None:
        if b[4] >= 0:
            out[b[4]] = CONSTANT if a[3] == b[3] and a[3] > 0 else at
            return
        place, nodes = {}, at + 1
        for k in a[5]:
            place[id(k)] = nodes
            nodes += k[2]
        met = {id(y): x for x, y in matched(a[5], b[5])}
        for k in b[5]:
            if id(k) in met:
                walk(met[id(k)], k, place[id(met[id(k)])])
            else:
                under(k, at)

    walk(template, page, 0)
    return out


def contents(template: Tree, chars: dict[int, int], linked: dict[int, int], constant: int) -> list[int] | None:
    """The slots that are content, by what all pages have in them; None if the pages are copies of each other."""
    nodes: list[Tree] = []

    def number(t: Tree) -> None:
        nodes.append(t)
        for k in t[5]:
            number(k)

    number(template)
    n = len(nodes)
    size, plain = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    for s, c in chars.items():
        size[s + 1], plain[s + 1] = c, c - linked[s]
    if size.sum() < VARYING * (size.sum() + constant):
        return None
    size, plain = np.cumsum(size), np.cumsum(plain)
    of = lambda sums, at: int(sums[at + nodes[at][2]] - sums[at])

    def kids(at: int) -> list[int]:
        out, k = [], at + 1
        for t in nodes[at][5]:
            out.append(k)
            k += t[2]
        return out

    at, go = 0, True
    while go:
        go = False
        for k in kids(at):
            if not nodes[k][0] & dom.FLOW and 2 * of(plain, k) >= max(1, of(plain, at)):
                at, go = k, True
                break
    keep = np.zeros(n, bool)
    keep[at : at + nodes[at][2]] = True
    for k in range(at + 1, at + nodes[at][2]):
        if of(size, k) and 2 * of(plain, k) <= of(size, k):
            keep[k : k + nodes[k][2]] = False
    for k in range(at):
        if nodes[k][0] & dom.TITLE and 2 * of(plain, k) > of(size, k):
            keep[k : k + nodes[k][2]] = True
    return np.flatnonzero(keep).tolist()


def without_template(sizes: list[int], flags: list[int]) -> list[bool]:
    """Which texts stay by marks alone."""
    free = [not f & dom.MARKED for f in flags]
    inner = [x and bool(f & dom.INNER) for x, f in zip(free, flags, strict=True)]
    total, within = sum([n for n, x in zip(sizes, free, strict=True) if x]), sum([n for n, x in zip(sizes, inner, strict=True) if x])
    return inner if any(inner) and 2 * within >= total else free


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else f"?{url}"


PARSED = "key binary, host string, layout long, tree binary, sizes array<int>, flags array<int>"


def extract(pages: DataFrame, least: int = LEAST, salts: int = SALTS, marks: bool = True) -> DataFrame:
    """page_id, url, text and n_chars of every page, and whether a template chose its text (``by_template``)."""
    pages = only(pages, "page_id", "url", "html").select("page_id", "url", whole(F.col("html")).alias("html"))
    # Equal pages of a URL are one: what is found for a page is found by this.
    pages = pages.withColumn("key", F.unhex(F.md5(F.concat_ws("\x00", F.coalesce("url", F.lit("")), "html"))))
    page_kind = pages.schema["page_id"].dataType.simpleString()
    ints = pa.list_(pa.int32())

    def pieces(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out: list[tuple] = []
            for html in batch.column(2).to_pylist():
                root, texts, flags = dom.parse(html)
                t = tree(root, texts)
                out.append((layout(t), marshal.dumps(t), [len(x) for x in texts], flags))
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), ints, ints), strict=True)]
            hosts = pa.array([host_of(u) for u in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), hosts, *columns], ["key", "host", "layout", "tree", "sizes", "flags"])

    known = pages.select("key", "url", "html").mapInArrow(parsed, PARSED)
    known = scratch.written(known.withColumn("part", F.pmod(F.xxhash64("tree"), F.lit(salts)).cast("int")), "pages")
    # Pages that differ in nothing the tree shows are one page of their host.
    ready = known.select("host", "layout", "part", "tree", F.lit(1).cast("long").alias("n")).dropDuplicates(["host", "layout", "part", "tree"])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Folds runs of rows of one host, layout and part."""
        now, acc, n = None, None, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*now, marshal.dumps(acc), n), (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.int64()), strict=True)], ["host", "layout", "part", "tree", "n"])

        for batch in batches:
            for host, lay, p, raw, k in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                t = marshal.loads(raw)
                if now != (host, lay, p):
                    if now is not None:
                        yield out()
                    now, acc, n = (host, lay, p), t, k
                else:
                    acc, n = fold(acc, t), n + k
        if now is not None:
            yield out()

    kind, at = "host string, layout long, part int, tree binary, n long", ["host", "layout", "part"]
    parts = scratch.written(ready.repartition(*at).sortWithinPartitions(*at, "tree").mapInArrow(folded, kind), "parts")
    templates = parts.withColumn("part", F.lit(0)).repartition("host", "layout").sortWithinPartitions("host", "layout", "tree").mapInArrow(folded, kind)
    templates = scratch.written(templates.filter(F.col("n") >= least).select(F.col("host").alias("h"), F.col("layout").alias("l"), F.col("tree").alias("template")), "templates")

    def by_part(what: DataFrame) -> DataFrame:
        """Rows of layouts (h, l) for each part that has pages, so that no host's pages have to be in one place."""
        met = parts.select(*at).join(what, (F.col("host") == F.col("h")) & (F.col("layout") == F.col("l")))
        return met.drop("h", "l").withColumnsRenamed({"host": "h", "layout": "l", "part": "p"})

    at_part = (F.col("host") == F.col("h")) & (F.col("layout") == F.col("l")) & (F.col("part") == F.col("p"))

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots(marshal.loads(x), marshal.loads(t), n) for t, n, x in zip(*[batch.column(c).to_pylist() for c in ("tree", "n", "template")], strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("key", "host", "layout", "part", "sizes", "flags")], pa.array(found, ints)], ["key", "host", "layout", "part", "sizes", "flags", "slots"])

    met = known.join(by_part(templates), at_part).select("key", "host", "layout", "part", "sizes", "flags", "tree", F.size("sizes").alias("n"), "template")
    places = scratch.written(met.mapInArrow(aligned, "key binary, host string, layout long, part int, sizes array<int>, flags array<int>, slots array<int>"), "places")

    each = places.select("host", "layout", F.explode(F.arrays_zip("slots", "sizes", "flags")).alias("x"))
    sums = each.groupBy("host", "layout", F.col("x.slots").alias("slot")).agg(F.sum("x.sizes").alias("chars"), F.sum(F.when(F.col("x.flags").bitwiseAND(dom.LINKED) > 0, F.col("x.sizes")).otherwise(0)).alias("linked"))
    # No more rows than a template has nodes.
    held = sums.groupBy("host", "layout").agg(F.collect_list(F.struct("slot", "chars", "linked")).alias("held"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                constant = sum(x["chars"] for x in own if x["slot"] == CONSTANT)
                own = [x for x in own if x["slot"] != CONSTANT]
                out.append(contents(marshal.loads(raw), {x["slot"]: x["chars"] for x in own}, {x["slot"]: x["linked"] for x in own}, constant))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, ints)], ["h", "l", "content"])

    choice = templates.join(held, (F.col("h") == F.col("host")) & (F.col("l") == F.col("layout"))).select("h", "l", "template", "held")
    choice = scratch.written(choice.mapInArrow(chosen, "h string, l long, content array<int>").filter("content is not null"), "content-slots")
    kept = places.join(by_part(choice), at_part).select(F.col("key").alias("k"), F.transform("slots", lambda s: F.array_contains("content", s)).alias("stay"))
    kept = kept.dropDuplicates(["k"])

    def read_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in pieces(batches):
            found = [dom.parse(h)[1:] for h in batch.column(3).to_pylist()]
            packed = [pack.compress("\x00".join(t).encode("utf-8", "surrogatepass")) for t, _ in found]
            columns = [pa.array(packed, pa.binary()), pa.array([[len(x) for x in t] for t, _ in found], ints), pa.array([f for _, f in found], ints)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], ["page_id", "url", "key", "blocks", "sizes", "flags"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, sizes, flags, stay in zip(*[batch.column(c).to_pylist() for c in ("blocks", "sizes", "flags", "stay")], strict=True):
                own = unpack.decompress(packed).decode("utf-8", "surrogatepass").split("\x00") if sizes else []
                if stay is None:
                    stay = without_template(sizes, flags) if marks else [True] * len(own)
                elif marks:
                    stay = [x and not f & dom.MARKED for x, f in zip(stay, flags, strict=True)]
                out.append("\n\n".join([t for t, x in zip(own, stay, strict=True) if x]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64()), batch.column("stay").is_valid()], ["page_id", "url", "text", "n_chars", "by_template"])

    again = pages.select("page_id", "url", "key", "html").mapInArrow(read_again, f"page_id {page_kind}, url string, key binary, blocks binary, sizes array<int>, flags array<int>")
    both = again.join(kept, F.col("key") == F.col("k"), "left").select("page_id", "url", "blocks", "sizes", "flags", "stay")
    return both.mapInArrow(texts, f"page_id {page_kind}, url string, text string, n_chars long, by_template boolean")
