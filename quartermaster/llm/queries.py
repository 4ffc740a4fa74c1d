"""Registered queries of the corpus operators: each applies one operator with
production parameters to its whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.chat import format_conversations, read_back
from quartermaster.llm.common import counted_side, cut, read
from quartermaster.llm.decontamination import find_contamination
from quartermaster.llm.html_extraction import extract_pages
from quartermaster.llm.near_dedup import near_duplicates
from quartermaster.llm.packing import pack_documents
from quartermaster.llm.pii import BASE as PRIVATE_KINDS
from quartermaster.llm.pii import find_personal_data
from quartermaster.llm.quality import quality_verdicts
from quartermaster.llm.ranked_search import ranked_search
from quartermaster.llm.secret_scan import KINDS as SECRET_KINDS
from quartermaster.llm.secret_scan import joined, scan_secrets
from quartermaster.llm.substring_dedup import remove_repeated_words
from quartermaster.llm.suffix_dedup import remove_repeated_bytes
from quartermaster.llm.vector_codes import books_digest, compress_vectors
from quartermaster.llm.vector_graph import nearest_neighbours


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def of_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


#: Conversation -1, whose texts are control strings.
CONTROL_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(turns.union(spark.createDataFrame(CONTROL_TURNS, turns.schema))))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = find_contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = find_personal_data(read(spark, sf_dir, "documents"))
    spans = F.array_join(F.filter(F.array(joined(F.col("base")), joined(F.col("added"))), lambda x: x != ""), ",")
    return r.select("doc_id", *[of_kind("base", k[0]) for k in PRIVATE_KINDS],
                    F.sha2(joined(F.col("base")), 256).alias("base_sha256"), spans.alias("spans"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeated_bytes(read(spark, sf_dir, "documents"), length=400, digest=True)
    return r.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                    F.col("kept").alias("kept_sha256"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = scan_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < len(SECRET_KINDS))
    return r.select("doc_id", *[of_kind("spans", k[0]) for k in SECRET_KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                    joined(F.col("spans")).alias("spans"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words=2, threshold=0.8)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = remove_repeated_words(read(spark, sf_dir, "documents"), window=35, digest=True)
    return r.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress_vectors(read(spark, sf_dir, "embeddings"), keep=["label"])
    codes = cut(codes)
    of_label = counted_side(codes.groupBy(F.col("label").alias("same")).agg(F.try_sum("error").alias("label_error")))
    return codes.join(of_label, codes["label"].eqNullSafe(of_label["same"])).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op12_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_decontamination, op3_html_extraction, op4_pii, op5_suffix_dedup, op6_packing, op7_secret_scan, op8_minhash_near_dedup,
    op9_substring_dedup, op10_quality_rules, op11_vector_codes, op12_vector_search, op13_ranked_search)}
_CONTROL = r"[<\[]\\*(\||/?s>|/?INST\])"
_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(role) + 5 + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op2_decontamination": f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, w[i:i + least(len(w), 10) - 1] AS win
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, i, n, w[i:i + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT len(win) AS n FROM win))),
hit AS (SELECT doc_id, i, n, item FROM place JOIN win USING (win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op9_substring_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)),
twice AS (SELECT h FROM win GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win JOIN twice USING (h))),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM docs LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
}

_FLOORED = "(CASE WHEN s % n < 0 THEN s // n - 1 ELSE s // n END)"


def _nearest(books: str) -> str:
    """SQL: entry and distance of every part of every vector."""
    return (f"SELECT v, p, arg_min(e, [d, e]) AS e, min(d) AS d FROM (SELECT v, p, e, list_sum(list_transform(range(1, len(x) + 1), "
            f"lambda i: (x[i] - y[i]) * (x[i] - y[i]))) AS d FROM parts JOIN {books} USING (p)) GROUP BY v, p")


def _rounds(n: int) -> str:
    """SQL: the codebooks after each round, an unused entry as it was."""
    return ",\n".join(
        f"near{r} AS MATERIALIZED ({_nearest(f'book{r - 1}')}),\n"
        f"mean{r} AS (SELECT p, e, list({_FLOORED} ORDER BY k) AS y FROM (SELECT p, e, k, CAST(sum(c) AS BIGINT) AS s, count(*) AS n FROM "
        f"(SELECT p, e, unnest(x) AS c, unnest(range(len(x))) AS k FROM near{r} JOIN parts USING (v, p)) GROUP BY p, e, k) GROUP BY p, e),\n"
        f"book{r} AS MATERIALIZED (SELECT p, e, coalesce(m.y, b.y) AS y FROM book{r - 1} b LEFT JOIN mean{r} m USING (p, e))"
        for r in range(1, n + 1))


ORACLE_SQL["op11_vector_codes"] = f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label, list_transform(embedding, lambda c: CAST(floor(4096 * CAST(c AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT v, p, q[p * len(q) // 8 + 1 : (p + 1) * len(q) // 8] AS x FROM vectors, (SELECT unnest(range(8)) AS p)),
book0 AS MATERIALIZED (SELECT p, v - 1 AS e, x AS y FROM parts WHERE v <= 16),
{_rounds(6)},
final AS MATERIALIZED ({_nearest('book6')}),
codes AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM final GROUP BY v),
books AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM vectors JOIN codes USING (v), books
"""
_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE_SQL["op13_ranked_search"] = f"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) AS n_all, CAST(sum(len(w)) AS BIGINT) AS l FROM docs WHERE len(w) > 0),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM docs) GROUP BY d, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_all + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals),
items AS (SELECT DISTINCT item_id, text, unnest({_TERMS}) AS term FROM benchmark),
scores AS (SELECT item_id, text, d, doc_id, CAST(sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(docs.w) * n_all) // l)))) AS BIGINT) AS score
           FROM items JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (d), totals GROUP BY item_id, text, d, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
