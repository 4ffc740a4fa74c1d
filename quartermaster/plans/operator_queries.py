"""Registered queries for the single operators that no job query covers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartermaster.functions.nulls import extract_or_null
from quartermaster.operators import columns as C
from quartermaster.operators import relational as R
from quartermaster.operators import reshape as S
from quartermaster.plans import publish as P
from quartermaster.plans.publish_queries import MAPPED_STEMS, _pairs, _position, _values_sql
from quartermaster.plans.table_queries import ORACLE_SQL, QUERIES, register, t
from quartermaster.sources import contract as K
from quartermaster.sources import io as IO
from quartermaster.streaming import lifecycle as L

__all__ = ["QUERIES", "ORACLE_SQL"]

TODAY = "1998-08-02"  # the day that stands for now in the test tables


@register("row_count", "SELECT count(*) AS rows FROM events")
def q_row_count(spark, sf_dir):
    return IO.row_count(t(spark, sf_dir, "events"))


@register("registered_table", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def q_registered_table(spark, sf_dir):
    IO.register_table(t(spark, sf_dir, "customer"), "qm_customers")
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM qm_customers GROUP BY 1")


@register("keep_flag", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def q_keep_flag(spark, sf_dir):
    c = t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", (F.col("c_acctbal") > 0).alias("in_credit"))
    return C.keep_flag(c, "in_credit").drop("in_credit")


@register("path_filter", "SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND lower(url) LIKE '%.html'")
def q_path_filter(spark, sf_dir):
    return C.path_filter(t(spark, sf_dir, "pages").select("page_id", "url"), "url", "https://", ".HTML")


@register("exclude_prefixes", "SELECT page_id, url FROM pages WHERE NOT starts_with(url, 'http://m.') AND NOT starts_with(url, 'https://m.')")
def q_exclude_prefixes(spark, sf_dir):
    return C.exclude_prefixes(t(spark, sf_dir, "pages").select("page_id", "url"), "url", ["http://m.", "https://m."])


@register("has_attribute", r"SELECT page_id, regexp_extract(url, 'page=([0-9]+)', 1) AS page FROM pages WHERE regexp_matches(url, 'page=([0-9]+)')")
def q_has_attribute(spark, sf_dir):
    p = t(spark, sf_dir, "pages").select("page_id", extract_or_null("url", r"page=([0-9]+)", 1).alias("page"))
    return p.filter(C.has_attribute("page"))


@register("numeric_recent", f"""
WITH f AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS name, o_orderdate FROM orders)
SELECT name FROM f WHERE regexp_matches(name, '^[0-9]+$') AND o_orderdate >= DATE '{TODAY}' - INTERVAL 3 MONTH
""")
def q_numeric_recent(spark, sf_dir):
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(""), F.col("o_orderkey").cast("string"))
    f = t(spark, sf_dir, "orders").select(name.alias("name"), "o_orderdate")
    return C.numeric_recent(f, "name", "o_orderdate", 3, F.lit(TODAY).cast("date")).select("name")


@register("constant_and_copied_columns", "SELECT n_nationkey, n_name, 'II' AS class, n_name AS place FROM nation")
def q_constant_and_copied_columns(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return K.tag(C.copy_columns(C.with_constants(n, {"class": "II"}), {"place": "n_name"}), "place", "COUNTRY")


@register("distinct_rows", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def q_distinct_rows(spark, sf_dir):
    return R.distinct_rows(t(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"])


@register("first_row", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 1")
def q_first_row(spark, sf_dir):
    return R.first_row(t(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), ["p_retailprice", "p_partkey"])


@register("head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 100")
def q_head(spark, sf_dir):
    return R.head(t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 100, ["o_totalprice", "o_orderkey"])


@register("order_by_index", "SELECT c_nationkey, c_custkey, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def q_order_by_index(spark, sf_dir):
    n = t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return R.order_by_index(t(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), n, "c_nationkey", "n_regionkey")


@register("order_by_list", """
SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS sort_key FROM orders
""")
def q_order_by_list(spark, sf_dir):
    o = R.order_by_list(t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["P", "O"])
    return o.select("o_orderkey", F.col("sort_key").cast("bigint").alias("sort_key"))


@register("melt_matching", """
SELECT l_orderkey, l_linenumber, 'l_discount' AS measure, l_discount AS rate FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem
""")
def q_melt_matching(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return S.melt_matching(li, "^l_(tax|discount)$", var="measure", val="rate")


_NAMES = ["POS.csv", "cosvi_embark.csv", "RD_IX_Requirement.csv", "AssessmentTable.csv", "RD_IX_Requirement_Trimmed.csv"]
_JOBS = ["force_flow", "aggregated_embark", "class_ix", "period_table", "no_match"]


@register("route_files", "SELECT o_orderkey, CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN '{j}'" for i, j in enumerate(_JOBS)) + " END AS job FROM orders")
def q_route_files(spark, sf_dir):
    name = F.element_at(F.array(*[F.lit(n) for n in _NAMES]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return L.route(t(spark, sf_dir, "orders").select("o_orderkey", name.alias("file_name"))).drop("file_name")


@register("latest_run", f"""
WITH f AS (SELECT o_custkey AS run_id, o_orderpriority AS name, o_orderdate FROM orders),
done AS (SELECT run_id FROM f WHERE o_orderdate >= DATE '{TODAY}' - INTERVAL 48 MONTH AND name IN ('1-URGENT', '2-HIGH')
         GROUP BY run_id HAVING count(DISTINCT name) = 2)
SELECT (SELECT max(run_id) FROM done) AS latest_complete_run, (SELECT max(run_id) + 1 FROM f) AS next_run_id
""")
def q_latest_run(spark, sf_dir):
    path = F.concat(F.lit("/runs/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderpriority"))
    files = t(spark, sf_dir, "orders").select(path.alias("path"), F.col("o_orderdate").alias("modificationTime"))
    return IO.latest_run(files, ["1-URGENT", "2-HIGH"], 48, F.lit(TODAY).cast("date"))


@register("skip_processed", """
SELECT event_id, user_id, event_type FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events d WHERE d.user_id = e.user_id AND d.event_type = e.event_type AND d.value > 150)
""")
def q_skip_processed(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    state = e.select("user_id", "event_type", F.when(F.col("value") > 150, F.col("ts")).alias("Dataset_Created"))
    return L.skip_processed(e, state, ["user_id", "event_type"]).select("event_id", "user_id", "event_type")


@register("complete_runs", """
SELECT user_id, count(DISTINCT event_type) AS n_items FROM events WHERE event_type IN (SELECT DISTINCT event_type FROM events WHERE value > 10)
GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events WHERE value > 10)
""")
def q_complete_runs(spark, sf_dir):
    e = t(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return L.completeness_batch(e, ["user_id"], "event_type", e.filter("value > 10"))


@register("subset_fields", f"""
WITH stems AS (SELECT * FROM (VALUES {_values_sql(MAPPED_STEMS)}) AS v(idx, stem)),
have AS (SELECT DISTINCT o_custkey AS run, replace(stem, '-', '_') AS s FROM orders JOIN stems ON dayofmonth(o_orderdate) % {len(MAPPED_STEMS)} + 1 = idx
         WHERE o_orderstatus = 'F')
SELECT o.o_orderkey, o.o_custkey AS assessment_id FROM orders o JOIN stems s ON dayofmonth(o.o_orderdate) % {len(MAPPED_STEMS)} + 1 = s.idx
WHERE EXISTS (SELECT 1 FROM have WHERE run = o.o_custkey AND have.s = replace(s.stem, '-', '_'))
""")
def q_subset_fields(spark, sf_dir):
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    have = _pairs(o.filter(F.col("o_orderstatus") == "F"), F.col("o_custkey"), _position("o_orderdate", MAPPED_STEMS), MAPPED_STEMS)
    stem = F.try_element_at(F.array(*[F.lit(s) for s in MAPPED_STEMS]), _position("o_orderdate", MAPPED_STEMS))
    fields = o.select("o_orderkey", F.col("o_custkey").alias("assessment_id"), stem.alias("stem"))
    fields = fields.withColumn("dataset_identifier", F.regexp_replace(P.dataset_id(F.col("stem"), F.col("assessment_id")), "-", "_"))
    return P.subset_fields(fields, P.dataset_identifiers(have)).select("o_orderkey", "assessment_id")


@register("refresh_audit", """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders)
SELECT 'first' AS refresh_id, 'REFRESHED' AS status, f AS source_rows, CAST(NULL AS BIGINT) AS target_rows FROM n
UNION ALL SELECT 'same', 'UNCHANGED', f, f FROM n UNION ALL SELECT 'grown', 'REFRESHED', n, f FROM n
""")
def q_refresh_audit(spark, sf_dir):
    base = L.state_base(spark, "qm-refresh")
    o = t(spark, sf_dir, "orders")
    closed = o.filter(F.col("o_orderstatus") == "F")
    for name, source in (("first", closed), ("same", closed), ("grown", o)):
        L.refresh_if_changed(source, base + "/target", base + "/audit", name)
    return spark.read.parquet(base + "/audit").drop("logged_at")
