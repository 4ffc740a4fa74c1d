"""Main text of web pages by wrapper induction.

The pages of a host are dealt into groups of about `group` pages; of pages with
the same main text (the marked article, or else the largest varying text)
one is taken, as the others don't tell template from content. In each group
neighbouring pages' trees of block elements are aligned by simple tree
matching (the largest order-keeping matching of equally named nodes; runs of
equal leaves count as one repeated slot). A matched node whose text is the
same on both pages speaks for template, one whose text differs, or that has
no partner, for content. The votes are summed for each host and path; a path
that is nearly always constant is template unless it is the host's main slot
(the path with the most varying text), whose blocks always stay. Furniture has
no votes, and the blocks of a marked article always stay.

A page's text is its blocks that are not template, furniture by their
element, role or class name, or, if the page marks its article, outside of
it; blocks made up of links count as menus where the article is not marked.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import cut, sub_batches
from quartermaster.llm.near_dedup import groups
from quartermaster.llm.page_tree import Node, parse

CHUNK = 1 << 21
#: So many pages at most that a task remembers to leave out their copies (some 200 bytes each).
SEEN_PAGES = 100_000
#: A broadcast of at most this many template paths (some 100 bytes each, 20 MB); more are joined by shuffle.
BROADCAST_PATHS = 200_000


class Slot:
    """A node of the alignment: label, text hash, amount of text, children."""
    __slots__ = ("path", "hash", "mass", "children", "label")

    def __init__(self, path, label, hash_, mass, children):
        self.path, self.label, self.hash, self.mass, self.children = path, label, hash_, mass, children


def slots(node: Node) -> list:
    """The tree without furniture as nested lists [label, hash, mass, children];
    runs of equally named leaves are one slot."""
    children: list = []
    for c in node.children:
        if c.furniture:
            continue
        new = slots(c)
        if children and not new[3] and not children[-1][3] and children[-1][0] == new[0]:
            children[-1][1] = zlib.crc32(new[1].to_bytes(4, "little"), children[-1][1])
            children[-1][2] += new[2]
        else:
            children.append(new)
    text = "\n".join(node.texts)
    return [node.label, zlib.crc32(text.encode()), len(text), children]


def flatten(tree: list, depth: int = 0, out: list | None = None) -> list:
    out = [] if out is None else out
    out.append((depth, *tree[:3]))
    for c in tree[3]:
        flatten(c, depth + 1, out)
    return out


def unflatten(depth, label, hash_, mass) -> Slot:
    stack: list[Slot] = []
    for d, name, h, m in zip(depth, label, hash_, mass):
        del stack[d:]
        s = Slot(f"{stack[-1].path}/{name}" if stack else name, name, h, m, [])
        if stack:
            stack[-1].children.append(s)
        stack.append(s)
        if d == 0:
            root = s
    return root


def match(a: Slot, b: Slot, memo: dict) -> int:
    """Simple tree matching: the number of pairs in the largest matching."""
    if a.label != b.label:
        return 0
    if not a.children or not b.children:
        return 1
    key = (id(a), id(b))
    if key not in memo:
        before = [0] * (len(b.children) + 1)
        for x in a.children:
            row = [0]
            for j, y in enumerate(b.children):
                w = match(x, y, memo)
                row.append(max(before[j + 1], row[j], before[j] + w if w else 0))
            before = row
        memo[key] = before[-1] + 1
    return memo[key]


def vote(a: Slot, b: Slot, memo: dict, votes: dict):
    """Adds the votes of two matched nodes and, in matching order, of their children."""
    n, same, mass = votes.get(a.path, (0, 0, 0))
    if a.mass or b.mass:
        equal = a.hash == b.hash
        votes[a.path] = (n + 1, same + equal, mass + (0 if equal else a.mass + b.mass))
    table = [[0] * (len(b.children) + 1)]
    for x in a.children:
        row = [0]
        for j, y in enumerate(b.children):
            w = match(x, y, memo)
            row.append(max(table[-1][j + 1], row[j], table[-1][j] + w if w else 0))
        table.append(row)
    i, j = len(a.children), len(b.children)
    while i and j:
        x, y = a.children[i - 1], b.children[j - 1]
        w = match(x, y, memo)
        if w and table[i][j] == table[i - 1][j - 1] + w:
            vote(x, y, memo, votes)
            i, j = i - 1, j - 1
        elif table[i][j] == table[i - 1][j]:
            alone(x, votes)
            i -= 1
        else:
            alone(y, votes)
            j -= 1
    for x in a.children[:i] + b.children[:j]:
        alone(x, votes)


def alone(s: Slot, votes: dict):
    if s.mass:
        n, same, mass = votes.get(s.path, (0, 0, 0))
        votes[s.path] = (n + 1, same, mass + s.mass)
    for c in s.children:
        alone(c, votes)


def texts_by_path(s: Slot, out: dict) -> dict:
    """path: (hash, mass) of all text at the path."""
    if s.mass:
        h, mass = out.get(s.path, (0, 0))
        out[s.path] = (zlib.crc32(s.hash.to_bytes(4, "little"), h), mass + s.mass)
    for c in s.children:
        texts_by_path(c, out)
    return out


def unlike(trees: list[Slot], marked: list[int | None], least: float = 0.2) -> list[Slot]:
    """One tree of each main text. Where no article is marked, the main text is
    at the path with the most text of those that vary, or, if that has less
    than `least` of the largest path's text (as an advert beside copies of one
    article), at the largest path."""
    texts = [texts_by_path(t, {}) if m is None else {} for t, m in zip(trees, marked)]
    size, seen = Counter(), defaultdict(set)
    for t in texts:
        for path, (h, mass) in t.items():
            size[path] += mass
            seen[path].add(h)
    main = max(size, key=lambda p: (size[p], p), default=None)
    varying = max((p for p in size if len(seen[p]) > 1), key=lambda p: (size[p], p), default=main)
    if main is not None and size[varying] >= least * size[main]:
        main = varying
    one: dict = {}
    for tree, m, t in zip(trees, marked, texts):
        one.setdefault(("marked", m) if m is not None else t.get(main) or frozenset(t.items()), tree)
    return list(one.values())


def article_hash(blocks: list) -> int | None:
    """Hash of the marked article's text; None if none is marked."""
    texts = [text for n, text, _ in blocks if n.landmark and not n.furniture]
    return zlib.crc32("\n".join(texts).encode()) if texts else None


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


TREE = ["tree", "article", "depth", "label", "hash", "mass"]
TREE_TYPES = "tree bigint, article bigint, depth array<int>, label array<string>, hash array<bigint>, mass array<bigint>"


def shapes(pages: DataFrame, group: int) -> DataFrame:
    """host, part and the tree (`TREE`) of each different page of a host. A task
    leaves out copies of a page it has read, the other copies are combined
    before the shuffle; parts are counted over what is left."""
    def trees(batches):
        seen: set = set()
        for b in sub_batches(batches, "html", CHUNK):
            new = []
            for i, page in enumerate(zip(b.column("host").to_pylist(), b.column("page").to_pylist())):
                if page not in seen:
                    new.append(i)
                    if len(seen) < SEEN_PAGES:
                        seen.add(page)
            b = b.take(pa.array(new, pa.int64()))
            read = [parse(x or "") for x in b.column("html").to_pylist()]
            rows = [flatten(slots(root)) for root, _ in read]
            yield pa.RecordBatch.from_arrays(
                [b.column("host"), b.column("page"), pa.array([zlib.crc32(repr(r).encode()) for r in rows], pa.int64()),
                 pa.array([article_hash(blocks) for _, blocks in read], pa.int64()),
                 *[pa.array([[x[k] for x in r] for r in rows], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))]],
                ["host", "page", *TREE])

    dealt = pages.select("host", "html").withColumn("page", F.xxhash64("html"))
    shape = dealt.mapInArrow(trees, f"host string, page bigint, {TREE_TYPES}")
    shape = cut(shape.groupBy("host", "page").agg(F.first(F.struct(*TREE)).alias("t")))
    sizes = shape.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / group).alias("parts"))
    return shape.join(sizes, "host").select("host", F.pmod("page", "parts").alias("part"), "t.*")


def wrappers(pages: DataFrame, group: int) -> DataFrame:
    """host, path, pairs, same, mass over all aligned pairs of pages."""
    shape = shapes(pages, group).repartition("host", "part").sortWithinPartitions("host", "part", "tree")

    def align(batches):
        for g in groups(batches, ["host", "part"], 500):
            tree = g.column("tree").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], tree[1:] != tree[:-1])))  # copies of a page say nothing
            cols = [g.column(k).to_pylist() for k in ("depth", "label", "hash", "mass")]
            article = g.column("article").to_pylist()
            trees_ = unlike([unflatten(*(c[i] for c in cols)) for i in first.tolist()], [article[i] for i in first.tolist()])
            votes: dict = {}
            for a, b in zip(trees_, trees_[1:]):
                vote(a, b, memo := {}, votes)  # noqa: F841
            if votes:
                host = g.column("host")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([host] * len(votes)), pa.array(list(votes)),
                     *[pa.array([v[k] for v in votes.values()], pa.int64()) for k in range(3)]], ["host", "path", "pairs", "same", "mass"])

    votes = shape.mapInArrow(align, "host string, path string, pairs bigint, same bigint, mass bigint")
    return votes.groupBy("host", "path").agg(*[F.sum(c).alias(c) for c in ("pairs", "same", "mass")])


def template_paths(pages: DataFrame, group: int = 64, least_pairs: int = 3, constant: float = 0.9) -> DataFrame:
    """host, paths: the template paths of each host that has any."""
    votes = wrappers(pages, group)
    main = votes.groupBy("host").agg(F.max_by("path", F.struct("mass", "path")).alias("main"))
    return votes.join(main, "host").filter(
        (F.col("pairs") >= least_pairs) & (F.col("same") >= constant * F.col("pairs")) & (F.col("path") != F.col("main"))
    ).groupBy("host").agg(F.collect_list("path").alias("paths"))


def main_text(page: str, template: frozenset) -> str:
    root, blocks = parse(page)
    marked = any(n.landmark and not n.furniture for n, _, _ in blocks)
    out = []
    for node, text, linked in blocks:
        if node.furniture or marked and not node.landmark:
            continue
        if not marked and (node.path in template or 2 * linked > len(text)):
            continue
        out.append(text)
    return "\n".join(out)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """One row for each input row: `id_col`, url, text (empty if none), n_chars.

    Null and empty pages give the empty text; broken markup is read as
    browsers read it, as far as blocks go; pages without a url are one host;
    repeated rows get equal texts and count once for the wrapper; an empty
    table gives an empty result; other columns are not read, whatever their
    names. Options as in `template_paths`.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    known = cut(template_paths(rows, **options))
    few = known.agg(F.coalesce(F.sum(F.size("paths")), F.lit(0))).first()[0] <= BROADCAST_PATHS
    rows = rows.join(F.broadcast(known) if few else known, "host", "left").select("id", "url", "html", "paths")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for b in sub_batches(batches, "html", CHUNK):
            texts = [main_text(h or "", frozenset(p or ())) for h, p in zip(b.column("html").to_pylist(), b.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [id_col, "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, url string, text string, n_chars bigint")
