"""Every registered query against its brute-force version: odd small tables
(nulls, empty and long texts, ties, repeated rows, clashing column names),
empty tables, and the smallest shared tables."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quartermaster.llm.html_extraction import main_text
from quartermaster.llm.near_dedup import near_duplicates
from quartermaster.llm.packing import pack_documents
from quartermaster.llm.queries import ORACLE_SQL, QUERIES, tokenizer_path
from quartermaster.llm.substring_dedup import remove_repeated_words
from quartermaster.llm.suffix_dedup import remove_repeated_bytes
from tests.llm import brute
from tests.oracle_compare import compare, duck


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def expected(values):
    return sorted(values, key=str)


def small_docs(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


BRUTE = {"op4_pii": (brute.op4_base, ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")),
         "op5_suffix_dedup": (brute.op5, ()),
         "op7_secret_scan": (brute.op7_base, ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")),
         "op9_substring_dedup": (brute.op9, ()),
         "op10_quality_rules": (brute.op10_base, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))}


@pytest.mark.parametrize("name", BRUTE)
def test_documents_queries_on_odd_rows(spark, tables, name):
    plain, columns = BRUTE[name]
    assert rows(QUERIES[name](spark, tables["folder"]), *columns) == expected(plain(tables["documents"]))


@pytest.mark.parametrize("name", BRUTE)
def test_documents_queries_on_shared_rows(spark, sf_dir, name):
    plain, columns = BRUTE[name]
    assert rows(QUERIES[name](spark, sf_dir), *columns) == expected(plain(small_docs(spark, sf_dir)))


def test_near_duplicates(spark, tables, sf_dir):
    for docs, folder in ((tables["documents"], tables["folder"]), (small_docs(spark, sf_dir), sf_dir)):
        with_id = [d for d in docs if d[0] is not None]
        want = brute.op8(with_id)
        got = QUERIES["op8_minhash_near_dedup"](spark, folder)
        assert rows(got.filter("doc_id IS NOT NULL")) == expected(want)
        assert {(r.component_id, r.kept) for r in got.filter("doc_id IS NULL").collect()} <= {(None, True)}


def test_near_duplicates_in_small_blocks(spark, tables):
    docs = spark.read.parquet(tables["folder"] + "/documents.parquet").filter("doc_id IS NOT NULL")
    want = brute.op8([d for d in tables["documents"] if d[0] is not None])
    assert rows(near_duplicates(docs, words=2, block=3)) == expected(want)


def test_repeats_in_hot_buckets(spark, tables):
    docs = spark.read.parquet(tables["folder"] + "/documents.parquet")
    words = remove_repeated_words(docs, bucket_limit=2).withColumn("kept", F.sha2("kept", 256))
    assert rows(words) == expected(brute.op9(tables["documents"]))
    found = remove_repeated_bytes(docs, bucket_limit=2).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    assert rows(found) == expected(brute.op5(tables["documents"]))


def test_repeats_in_hot_buckets_of_near_copies(spark):
    import random
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(160)]
    docs = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for limit in (2, 8, 4000):
        words = remove_repeated_words(df, bucket_limit=limit).withColumn("kept", F.sha2("kept", 256))
        assert rows(words) == expected(brute.op9(docs)), limit
        found = remove_repeated_bytes(df, bucket_limit=limit).select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
        assert rows(found) == expected(brute.op5(docs)), limit


def test_decontamination(spark, tables, sf_dir):
    assert rows(QUERIES["op2_decontamination"](spark, tables["folder"])) == expected(brute.op2(tables["documents"], tables["benchmark"]))


def test_chat_round_trip(spark, tables):
    want = []
    turns = tables["conversations"] + [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    for c in {r[0] for r in turns}:
        mine = sorted((r for r in turns if r[0] == c), key=lambda r: r[1])
        learnt = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        want.append((c, len(mine), brute.sha("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)), len(learnt), brute.sha(learnt)))
    got = QUERIES["op1_chat_formatting"](spark, tables["folder"])
    assert rows(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == expected(want)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, sf_dir, name):
    ok, message = compare(spark, QUERIES[name], ORACLE_SQL[name], sf_dir, duck(sf_dir))
    assert ok, message


def check_packing(got, docs, per_document):
    """Every document's tokens are in its pieces, every sequence is gapless and fits."""
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for d, t in docs:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k:k + 2048], "<u4")
            want.append((d, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == expected(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    return len(by), -(-sum(w[3] for w in want) // 2048)


def test_packing(spark, tables, sf_dir):
    check_packing(QUERIES["op6_packing"](spark, tables["folder"]).collect(), tables["documents"], 2048)
    docs = small_docs(spark, sf_dir)
    n, least = check_packing(QUERIES["op6_packing"](spark, sf_dir).collect(), docs, 2048)
    assert n <= least + 2
    many = pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(), per_task=20, fan_in=3)
    n, least = check_packing(many.collect(), docs, 2048)
    assert n <= 1.05 * least + 2


def test_packing_with_more_partitions_than_items(spark):
    docs = [(i, "word " * (3 * i)) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        check_packing(pack_documents(df, tokenizer_path(), per_task=1, fan_in=2).collect(), docs, 2048)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_special_strings_are_tokenised_like_the_library(spark):
    texts = ["It's the İstanbul ΣΑΣ é ́x don'T ½ ² x<|endoftext|>y <|startoftext|> z 1<|ENDOFTEXT|> <|EndOfText|>É ÉCOLE Ö1Ö", "ﬁ Å̊ 東京都 a​b ÀÉÞẞß× ÷÷ª"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_packing(pack_documents(df, tokenizer_path()).collect(), list(enumerate(texts)), 2048)


def test_pages(spark, tables, sf_dir):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in QUERIES["op3_html_extraction"](spark, tables["folder"]).collect()}
    assert got[1][1] == "A & B\nOne two three four\nFive" and got[1][2] == len(got[1][1])
    assert got[2] == (None, "", 0) and got[3][1] == "" and got[None][1] == "plain text" and got[4][1] == "ab"
    import html
    import re
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").join(
            QUERIES["op3_html_extraction"](spark, sf_dir).select("page_id", "text"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_empty_tables(spark, empty):
    for name, query in QUERIES.items():
        assert query(spark, empty).count() == (1 if name.startswith("op1_") else 0), name


def test_main_text_without_landmarks():
    page = ('<html><body><div id=top-menu><a href=x>Home</a></div><div class=content><h1>Title</h1><p>First <b>bold</b><p>Second'
            '<ul><li>one<li>two</ul><table><tr><td>a<td>b</table></div><div class="cookie-notice">We use cookies</div>'
            "<form><input>Search</form><!-- c --><section class=comments><p>nice</p></section></body></html>")
    assert main_text(page, frozenset()) == "Title\nFirst bold\nSecond\none\ntwo\na\nb"
    assert hashlib.sha256(main_text("", frozenset()).encode()).hexdigest() == brute.sha("")


def test_raw_elements_end_in_place_after_letters_that_grow_in_lower_case():
    page = "<article><p>" + "İ" * 40 + "</p><script>var a = 1;</SCRIPT><p>One</p><style>p {}</style><p>Two</p></article><p>out</p>"
    assert main_text(page, frozenset()) == "İ" * 40 + "\nOne\nTwo"


def test_personal_data_base_spans_on_random_and_long_texts():
    import random
    import re
    import time

    from quartermaster.llm.pii import BASE, spans_in
    rng = random.Random(8)
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"}
    for _ in range(3000):
        t = "".join(rng.choices("ab@.-+1 2903[", k=rng.randrange(40)))
        for kind, _, find, _ in BASE[:2]:
            assert list(find(t)) == [m.span() for m in re.finditer(plain[kind], t)], t
    for t in ("x" * 10**6 + "@ a@b.c", "1" * 10**6 + " 1.2 @", "a." * 300_000 + "@", "@a" * 300_000, "1." * 400_000, "+1" + "2 " * 300_000, "0" * 10**6 + ".0.0.1"):
        at = time.time()
        spans_in(t)
        assert time.time() - at < 8
    assert ("ip", 0, 10**6 + 6) in spans_in("0" * 10**6 + ".0.0.1")[0]
