"""Vector codes and graph search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartermaster.llm.queries import QUERIES
from quartermaster.llm.vector_codes import compress_vectors, decoded, integers, nearest
from quartermaster.llm.vector_graph import beam_search, build_graph, nearest_neighbours, normed, robust_prune
from tests.llm import brute
from tests.llm.test_contracts import expected, rows


def vectors(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def test_codes(spark, tables, sf_dir):
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    # the odd table's floats as the column holds them
    for folder in (tables["folder"], sf_dir):
        assert rows(QUERIES["op11_vector_codes"](spark, folder), *names) == expected(brute.op11(vectors(spark, folder)))


def test_slices_find_the_nearest_entry_and_the_lower_of_equals():
    rng = np.random.default_rng(3)
    for width in (1, 3, 8):
        book = rng.integers(-6, 7, (40, width))
        x = rng.integers(-9, 10, (500, width))
        d = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        best, least = nearest(x, book)
        assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    assert integers(np.array([[1e300, -1e300, -0.0001, 0.0001]]), 4096).tolist() == [[1 << 29, -(1 << 29), -1, 0]]


def test_codes_with_few_vectors_and_other_sizes(spark):
    df = spark.createDataFrame([(5, [0.5, -0.25], "a"), (3, [0.25, 0.75], None)], "i long, v array<double>, code string")
    out, books = compress_vectors(df, "i", "v", keep=["code"], parts=2, entries=4, rounds=1, scale=8)
    assert books.tolist() == [[[2], [4]], [[6], [-2]]]
    got = sorted(out.collect(), key=str)
    assert [(r[0], r[1], bytes(r[2]), r[3]) for r in got] == [(3, None, b"\0\0", 0), (5, "a", b"\1\1", 0)]
    assert decoded(bytes(got[1][2]), books).tolist() == [4, -2]
    with pytest.raises(ValueError):
        compress_vectors(df, "i", "v", entries=65)


def exact_answers(spark, folder):
    return brute.op12(vectors(spark, folder))


def test_search_on_odd_rows(spark, tables):
    got = {}
    for r in QUERIES["op12_vector_search"](spark, tables["folder"]).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    want = exact_answers(spark, tables["folder"])
    assert set(got) == {q for (q, _), best in want.items() if best}
    for (q, _), best in want.items():
        mine = sorted(got.get(q, []))
        assert [x[0] for x in mine] == list(range(1, len(best) + 1))
        assert [x[2] for x in mine] == [i for _, i in best]
        assert np.allclose([x[1] for x in mine], [s for s, _ in best], rtol=1e-12)


def test_recall_on_shared_rows(spark, sf_dir):
    want = exact_answers(spark, sf_dir)
    for options in ({}, {"shard_rows": 60, "query_rows": 3}):
        got = {}
        found = nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0, **options)
        for r in found.collect():
            got.setdefault(r.query_id, {})[r.vec_id] = r.score
        hits = 0
        for (q, _), best in want.items():
            assert len(got[q]) == len(best) and q not in got[q]
            hits += len(set(got[q]) & {i for _, i in best})
            for s, i in best:
                assert i not in got[q] or abs(got[q][i] + s) < 1e-12
        assert hits >= 0.95 * sum(map(len, want.values()))


def test_graph_on_many_vectors():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24))
    x *= rng.uniform(1, 1.09, size=(3000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)  # norms of one band
    y = normed(x)
    edges, start = build_graph(y, 64, 1.2)
    assert ((edges >= 0).sum(axis=1) > 0).all()
    q = rng.normal(size=(100, 24))
    unit = np.column_stack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros(100)]).astype(np.float32)
    found, dist, _ = beam_search(y, edges, start, unit, 96)
    assert (np.diff(dist, axis=1) >= 0).all()
    truth = np.argsort(-q @ x.T, axis=1)[:, :20]
    assert np.mean([len(set(f.tolist()) & set(t.tolist())) / 20 for f, t in zip(found, truth)]) > 0.95


def test_pruning_keeps_the_nearest_of_each_direction():
    y = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1]], np.float32)
    cand = np.array([[1, 2, 3, 4, -1, 1]])
    dist = np.where(cand >= 0, (y[cand] ** 2).sum(axis=2), np.inf)
    assert robust_prune(y, cand, dist, 4, 1.2).tolist() == [[1, 3, -1, -1]]


def test_recall_with_norms_of_every_size(spark):
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(1500, 24)) * rng.exponential(size=(1500, 1)) ** 2 * 1e-3).astype(np.float32).astype(float)
    rows_ = [(i, v.tolist(), None) for i, v in enumerate(x)]
    df = spark.createDataFrame([r[:2] for r in rows_], "vec_id long, embedding array<float>")
    got = {}
    for r in nearest_neighbours(df, F.col("id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: {i for _, i in best} for (q, _), best in brute.op12(rows_).items()}
    assert sum(len(got[q] & best) for q, best in want.items()) >= 0.95 * 20 * len(want)
