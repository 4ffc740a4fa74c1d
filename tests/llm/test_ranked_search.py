"""Ranked search: signatures never miss, bounds never fall short, results equal brute force."""

import numpy as np
import pyarrow as pa

from quartermaster.llm import ranked_search as R
from quartermaster.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.test_contracts import expected, rows, small_docs

NAMES = ("item_id", "rank", "doc_id", "score")


def small_items(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]


def test_on_odd_and_shared_rows(spark, tables, sf_dir):
    got = rows(QUERIES["op13_ranked_search"](spark, tables["folder"]), *NAMES)
    assert got == expected(brute.op13(tables["documents"], tables["benchmark"]))
    assert rows(QUERIES["op13_ranked_search"](spark, sf_dir), *NAMES) == expected(brute.op13(small_docs(spark, sf_dir), small_items(spark, sf_dir)))


def test_items_in_blocks_and_texts_in_small_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(R, "ITEM_TERMS", 60)
    monkeypatch.setattr(R, "CELLS", 1 << 10)
    docs, items = (spark.read.parquet(f"{tables['folder']}/{t}.parquet") for t in ("documents", "benchmark"))
    assert rows(R.ranked_search(docs, items), *NAMES) == expected(brute.op13(tables["documents"], tables["benchmark"]))


def test_copies_beyond_the_number_of_results(spark):
    docs = [(i, "rare word here" if i % 3 else f"other word {i}") for i in range(200)] + [(300, "rare rare rare"), (1, "rare word here")]
    items = [(1, "Rare, rare HERE"), (2, "word"), (3, "nothing of it"), (None, "rare")]
    got = R.ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                          spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got, *NAMES) == expected(brute.op13(docs, items))


def test_bounds_hold_and_are_close():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(1, 400)) % 3000) for _ in range(300)]
    row, term, dictionary, n = R.terms_of(pa.array(texts))
    row, term, tf = R.counted(row, term, len(dictionary))
    bits = 1 << 14
    h, bitmap = R.hashes(dictionary), np.zeros((bits, len(texts)), bool)
    for level, least in enumerate(R.LEVELS):
        at = tf >= least
        for b in R.entry_bits(h[term[at]], level, bits).T:
            bitmap[b, row[at]] = True
    weight = rng.integers(1, 9000, len(dictionary))
    own = np.concatenate([rng.choice(len(dictionary), 30, replace=False) for _ in range(20)])
    items = R.Items(np.arange(20), np.arange(0, 601, 30), own, dictionary, weight, np.ones(20, np.int64))
    m = 10 + 90 * n * len(texts) // n.sum()
    exact = np.zeros((len(dictionary), len(texts)), np.int64)
    exact[term, row] = weight[term] * R.part(tf, m[row])
    bound, score = R.upper_bounds(items, h, m, np.packbits(bitmap, axis=1)), items.sums(exact)
    assert (bound >= score).all() and bound.sum() < 1.15 * score.sum()


def test_a_very_long_text(spark):
    docs = [(1, " ".join(f"t{i % 70000}" for i in range(400_000))), (2, "t1 t2"), (3, None)]
    items = [(1, "t1 t69999"), (2, "t2 missing")]
    got = R.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got, *NAMES) == expected(brute.op13(docs, items))
