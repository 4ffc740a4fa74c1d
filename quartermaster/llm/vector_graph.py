"""Approximate nearest neighbours by inner product: a robust-pruned directed
graph for each shard of the vectors, searched with a beam.

Largest inner product is made nearest distance: vectors are scaled by the
shard's largest norm and get one more coordinate, sqrt(1 - |x|^2), that a
query has as 0; nearest then means largest inner product.

1. `distinct_nodes`: equal vectors are one node with its smallest ids (as many
   as an answer can need), so copies neither crowd a graph nor a result.
2. `vector_index` deals the nodes of like norm (`BANDS`) into shards of about
   `shard_rows` by hash, since the added coordinate sets vectors apart from
   queries the more their norms differ, and builds each shard's graph in one task: nodes are inserted in batches, a
   greedy search through the graph so far proposes neighbours, and relaxed
   distance pruning keeps a candidate only if no kept one is nearer to it by
   the factor `alpha`; edges run both ways and are pruned the same way. The
   index is a table: one row for each node with its neighbours' places.
3. `search_index` brings every shard together with every block of queries, in
   tasks of one shard and one block; a beam search finds each query's nearest
   nodes there, measured again in double precision. Answers are merged over
   the shards by a window that limits each task's rows before they travel.

A search costs queries x shards; `shard_rows` and `query_rows` say how much a
task holds (some 1.5 KB a node), so larger executors need fewer of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartermaster.llm.common import counted_side, cut, lists, whole_groups
from quartermaster.llm.quality import held
from quartermaster.llm.vectors import finite, whole_rows

BANDS = 8  # of norms to each doubling; the vectors of a band share shards
DEGREE, MOST_DEGREE = 32, 48  # edges kept by pruning; edges at which a node is pruned again
INSERTED, SEARCHED = 256, 128  # nodes inserted, queries searched together


def normed(x: np.ndarray) -> np.ndarray:
    """Rows scaled to a norm of at most 1, and the coordinate that fills the norm up to 1."""
    y = x / max(np.abs(x).max(initial=0.0), np.finfo(np.float64).tiny)
    y /= max(np.sqrt((y * y).sum(axis=1)).max(initial=0.0), 1.0)
    fill = np.sqrt(np.maximum(1 - (y * y).sum(axis=1), 0))
    return np.column_stack([y, fill]).astype(np.float32)


def distances(y: np.ndarray, q: np.ndarray) -> np.ndarray:
    diff = y - q
    return np.einsum("ij,ij->i", diff, diff)


def beam_search(y: np.ndarray, edges: np.ndarray, start: int, q: np.ndarray, beam: int, width: int = 4):
    """For each row of `q` the `beam` nearest nodes found, nearest first (-1
    where there are fewer), their distances, and the nodes expanded on the way.
    Each step expands the `width` nearest nodes not expanded yet."""
    n = len(q)
    ids, dist = np.full((n, beam), -1), np.full((n, beam), np.inf, np.float32)
    ids[:, 0], dist[:, 0] = start, distances(y[np.full(n, start)], q)
    todo = np.zeros((n, beam), bool)
    todo[:, 0] = True
    seen = np.zeros((n, len(y)), bool)
    seen[:, start] = True
    passed = []
    active = np.arange(n)
    while len(active):
        first = np.argsort(~todo[active], axis=1, kind="stable")[:, :width]
        take = np.take_along_axis(todo[active], first, 1)
        row, col = np.nonzero(take)
        row, col = active[row], first[row, col]
        todo[row, col] = False
        node = ids[row, col]
        passed.append(np.stack([row, node]))
        key = (row[:, None] * len(y) + edges[node])[edges[node] >= 0]
        key = np.unique(key)
        row, node = key // len(y), key % len(y)
        fresh = ~seen[row, node]
        row, node = row[fresh], node[fresh]
        seen[row, node] = True
        d = distances(y[node], q[row])
        near = d < dist[row, -1]
        row, node, d = row[near], node[near], d[near]
        if len(row):
            which, begin, count = np.unique(row, return_index=True, return_counts=True)
            place = beam + np.arange(len(row)) - np.repeat(begin, count)
            line = np.repeat(np.arange(len(which)), count)
            wide = beam + int(count.max())
            i2, d2, t2 = np.full((len(which), wide), -1), np.full((len(which), wide), np.inf, np.float32), np.zeros((len(which), wide), bool)
            i2[:, :beam], d2[:, :beam], t2[:, :beam] = ids[which], dist[which], todo[which]
            i2[line, place], d2[line, place], t2[line, place] = node, d, True
            by = np.argsort(d2, axis=1, kind="stable")[:, :beam]
            ids[which], dist[which], todo[which] = (np.take_along_axis(v, by, 1) for v in (i2, d2, t2))
        active = active[todo[active].any(axis=1)]
    return ids, dist, np.concatenate(passed, axis=1) if passed else np.zeros((2, 0), int)


def robust_prune(y: np.ndarray, cand: np.ndarray, dist: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each row up to `degree` of its candidates (-1: none), nearest first;
    a candidate goes when one already kept is nearer to it than the row's own
    node by the factor `alpha`."""
    by = np.lexsort((cand, dist), axis=1)
    cand, dist = np.take_along_axis(cand, by, 1), np.take_along_axis(dist, by, 1)
    alive = (cand >= 0) & np.isfinite(dist)
    alive[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    v = y[cand]
    size = np.einsum("bcd,bcd->bc", v, v)
    between = size[:, :, None] + size[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    kept, line = np.full((len(cand), degree), -1), np.arange(len(cand))
    for k in range(degree):
        pick = alive.argmax(axis=1)
        some = alive[line, pick]
        if not some.any():
            break
        kept[some, k] = cand[some, pick[some]]
        alive &= alpha * alpha * between[line, pick] > dist
        alive[line, pick] = False
    return kept


def padded(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """Values of each group (sorted) as a row, -1 after them."""
    count = np.bincount(group, minlength=groups)
    out = np.full((groups, int(count.max(initial=0))), -1)
    out[group, np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)] = values
    return out


def build_graph(y: np.ndarray, beam: int, alpha: float, seed: int = 1) -> tuple[np.ndarray, int]:
    """Edges (nodes x MOST_DEGREE, -1: none) and the node at which searches start."""
    n = len(y)
    edges, degree = np.full((n, MOST_DEGREE), -1), np.zeros(n, np.int64)
    start = int(distances(y, y.mean(axis=0)[None]).argmin())
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != start]
    at = 0
    while at < len(order):
        new = order[at:at + min(max(at, 1), INSERTED)]
        at += len(new)
        ids, dist, passed = beam_search(y, edges, start, y[new], beam)
        passed = passed[:, np.argsort(passed[0], kind="stable")]
        more = padded(passed[0], passed[1], len(new))
        line = np.broadcast_to(np.arange(len(new))[:, None], more.shape)
        far = np.where(more >= 0, distances(y[more.ravel()], y[new[line.ravel()]]).reshape(more.shape), np.inf)
        kept = robust_prune(y, np.hstack([ids, more]), np.hstack([dist, far]), DEGREE, alpha)
        edges[new, :DEGREE], degree[new] = kept, (kept >= 0).sum(axis=1)
        # the same edges the other way
        to, source = kept[kept >= 0], np.repeat(new, degree[new])
        by = np.argsort(to, kind="stable")
        to, source = to[by], source[by]
        node, begin, count = np.unique(to, return_index=True, return_counts=True)
        fits = degree[node] + count <= MOST_DEGREE
        each = np.repeat(fits, count)
        rank = np.arange(len(to)) - np.repeat(begin, count)
        edges[to[each], degree[to[each]] + rank[each]] = source[each]
        degree[node[fits]] += count[fits]
        full = node[~fits]
        if len(full):
            group = np.repeat(np.arange(len(full)), count[~fits])
            cand = np.hstack([edges[full], padded(group, source[~each], len(full))])
            own = np.repeat(full, cand.shape[1])
            dist = np.where(cand >= 0, distances(y[cand.ravel()], y[own]).reshape(cand.shape), np.inf)
            edges[full] = -1
            edges[full, :DEGREE] = kept = robust_prune(y, cand, dist, DEGREE, alpha)
            degree[full] = (kept >= 0).sum(axis=1)
    return edges, start


def distinct_nodes(rows: DataFrame, ids: int) -> DataFrame:
    """node, vector, ids: each distinct vector with its `ids` smallest ids, ascending."""
    best = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ids)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return cut(nodes.withColumn("node", F.monotonically_increasing_id()))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector of the rows that take part: an id, and a finite vector that isn't zero."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    return rows.filter(F.col("id").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0))


def with_band(nodes: DataFrame) -> DataFrame:
    """`nodes` with dims (length) and band (of the norm; norms around 1 share band 0)."""
    # scaled by the largest component, squares neither overflow nor vanish
    rows = held(nodes, top=F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double")))))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(x.cast("double") / F.col("top"), 2.0))
    band = F.floor(BANDS * (F.log2("top") + F.log2(squares) / 2) + 0.5).cast("bigint")
    return rows.select(F.size("vector").alias("dims"), band.alias("band"), "node", "ids", "vector")


def vector_index(nodes: DataFrame, shard_rows: int = 8192, beam: int = 64, alpha: float = 1.2) -> DataFrame:
    """The index: dims, shard, place, start (the shard's first place to look),
    node, ids, vector, edges (places in the shard). Vectors of different length
    or norm band are in different shards. `nodes` as `distinct_nodes` returns them."""
    banded = with_band(nodes)
    sizes = counted_side(banded.groupBy("dims", "band").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")))
    number = F.col("band") * (1 << 32) + F.pmod(F.xxhash64("node"), F.col("shards"))
    dealt = banded.join(sizes, ["dims", "band"]).select("dims", number.alias("shard"), "node", "ids", "vector")
    kind = nodes.schema["ids"].dataType.simpleString()
    vector = nodes.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for t in whole_groups(batches, ["dims", "shard"], 1):
            for g in groups(t):
                dims = g.column("dims")[0].as_py()
                edges, start = build_graph(normed(whole_rows(g.column("vector").chunk(0), dims)[1]), beam, alpha)
                out = g.append_column("place", pa.array(np.arange(g.num_rows, dtype=np.int32)))
                out = out.append_column("start", pa.array(np.full(g.num_rows, start, np.int32)))
                out = out.append_column("edges", lists(edges[edges >= 0].astype(np.int32), (edges >= 0).sum(axis=1), pa.int32()))
                yield from out.to_batches()

    return cut(dealt.repartition("dims", "shard").sortWithinPartitions("dims", "shard", "node").mapInArrow(
        run, f"dims int, shard bigint, node bigint, ids {kind}, vector {vector}, place int, start int, edges array<int>"))


def groups(t: pa.Table, keys: tuple = ("dims", "shard")) -> Iterator[pa.Table]:
    """The tables of each shard in a sorted table, each as one chunk."""
    t = t.combine_chunks()
    v = np.stack([t.column(k).to_numpy() for k in keys])
    edge = np.flatnonzero((v[:, 1:] != v[:, :-1]).any(axis=0)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), t.num_rows]):
        if b > a:
            yield t.slice(a, b - a).combine_chunks()


def answers(nodes: pa.Table, queries: pa.Table, k: int, beam: int) -> pa.Table | None:
    """node (the query's), score, id of the `k` best of one shard for each query."""
    dims = nodes.column("dims")[0].as_py()
    x = whole_rows(nodes.column("vector").chunk(0), dims)[1]
    q = whole_rows(queries.column("vector").chunk(0), dims)[1]
    y = normed(x)
    link = nodes.column("edges").chunk(0)
    count = np.diff(link.offsets.to_numpy())
    edges = padded(np.repeat(np.arange(len(count)), count), link.flatten().to_numpy(), len(count)) if len(count) else np.zeros((0, 0), int)
    start = nodes.column("start")[0].as_py()
    own, own_count = nodes.column("ids").chunk(0).flatten().to_numpy(), np.diff(nodes.column("ids").chunk(0).offsets.to_numpy())
    own_at = np.cumsum(own_count) - own_count
    unit = q / np.maximum(np.abs(q).max(axis=1, keepdims=True), np.finfo(np.float64).tiny)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    unit = np.column_stack([unit, np.zeros(len(q))]).astype(np.float32)
    out: list[tuple] = []
    for a in range(0, len(q), SEARCHED):
        found, _, _ = beam_search(y, edges, start, unit[a:a + SEARCHED], max(beam, 2 * k))
        row, col = np.nonzero(found >= 0)
        hit = found[row, col]
        score = np.einsum("ij,ij->i", x[hit], q[a + row])
        by = np.lexsort((own[own_at[hit]], -score, row))
        row, hit, score = row[by], hit[by], score[by]
        best = rank_in(row) < k  # no more nodes than ids are needed
        row, hit, score = row[best], hit[best], score[best]
        times = own_count[hit]
        ids = own[np.repeat(own_at[hit], times) + rank_in(np.repeat(np.arange(len(hit)), times))]
        row, score = np.repeat(row, times), np.repeat(score, times)
        by = np.lexsort((ids, -score, row))
        by = by[rank_in(row[by]) < k]
        out.append((a + row[by], score[by], ids[by]))
    row, score, ids = (np.concatenate(v) for v in zip(*out))
    return pa.table([queries.column("node").take(pa.array(row)), pa.array(score), pa.array(ids)], ["node", "score", "id"])


def rank_in(group: np.ndarray) -> np.ndarray:
    """Rank of each value within its run of equal values."""
    if not len(group):
        return np.zeros(0, np.int64)
    new = np.concatenate(([True], group[1:] != group[:-1]))
    return np.arange(len(group)) - np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))


def search_index(index: DataFrame, asked: DataFrame, k: int, beam: int = 96, query_rows: int = 2048) -> DataFrame:
    """node, hits (array of (score, id), best first): the `k` best of each
    vector in `asked` (node, vector) over all shards of `index`."""
    blocks = -(-asked.count() // query_rows)
    shards = index.select("dims", "shard").distinct()
    asked = asked.select("node", "vector", F.size("vector").alias("dims"), F.pmod(F.xxhash64(F.lit(7), "node"), F.lit(max(blocks, 1))).cast("int").alias("block"))
    asked = asked.join(shards, "dims")  # a query meets the shards of its length
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))))
    columns = ["dims", "shard", "block", "place", "start", "node", "ids", "vector", "edges"]
    both = held.select(*columns).unionByName(asked.select("dims", "shard", "block", "node", "vector"), allowMissingColumns=True)
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for t in whole_groups(batches, ["dims", "shard", "block"], 1):
            for g in groups(t, ("dims", "shard", "block")):
                query = g.column("place").is_null()
                nodes, queries = g.filter(pa.compute.invert(query)).combine_chunks(), g.filter(query).combine_chunks()
                if nodes.num_rows and queries.num_rows:
                    yield from answers(nodes, queries, k, beam).combine_chunks().to_batches()

    found = both.repartition("dims", "shard", "block").sortWithinPartitions("dims", "shard", "block", "place").mapInArrow(
        run, f"node bigint, score double, id {kind}")
    best = Window.partitionBy("node").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    hits = F.sort_array(F.collect_list(F.struct("rank", "score", "id")))
    return found.groupBy("node").agg(F.transform(hits, lambda h: F.struct(h["score"].alias("score"), h["id"].alias("id"))).alias("hits"))


def nearest_neighbours(df: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, **options) -> DataFrame:
    """query_id, rank (from 1), `id_col`, score: the `k` rows of `df` with the
    largest inner product found for each row that meets the condition
    `queries` on the column id. Options: shard_rows, beam (of the search),
    query_rows.

    Rows of the query's own id are no candidates; with fewer candidates all
    are returned; ties go to the smaller id. Rows equal in id and vector count
    once; rows of one id with different vectors are different candidates and
    queries. Rows whose id or vector is null, and empty vectors, zero vectors
    and those with a null or non-finite component, take no part. A query's
    candidates are the vectors of its own length. An empty table gives no
    rows; other columns aren't read, whatever their names.
    """
    rows = usable(df, id_col, vector_col)
    nodes = distinct_nodes(rows, k + 1)
    index = vector_index(nodes, options.pop("shard_rows", 8192))
    placed = rows.filter(queries).distinct().join(nodes.select("node", "vector"), "vector").select("id", "node")
    asked = cut(placed)
    wanted = nodes.select("node", "vector").join(asked.select("node").distinct(), "node", "left_semi")
    found = search_index(index, cut(wanted), k + 1, **options)
    best = asked.join(found, "node").select(F.col("id").alias("query_id"), F.slice(F.filter(
        "hits", lambda h: h["id"] != F.col("id")), 1, k).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score"))
