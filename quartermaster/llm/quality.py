"""Quality rules with thresholds learned from the corpus, in SQL functions only.

Each document's measures feed KLL quantile sketches, one set for each
language and source; the sketches are merged for each language and for the
whole corpus. A group's fence for a measure is its median plus `spread`
times its interquartile range (at least the measure's least range, so that a
group without variation doesn't reject its first deviating document). Groups
with fewer than `least_docs` documents take the fence of their language, or
else of the corpus. The fences are joined back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.llm.common import WORD_SPACE, cut, text_key

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: measure: (expression, least interquartile range)
MEASURES = {
    "symbol_share": ("n_symbols / n_words", 0.05),
    "shout_share": ("n_shouts / n_words", 0.05),
    "upper_share": ("n_upper / word_chars", 0.05),
    "dup_line_share": ("n_dup_lines / n_lines", 0.10),
    "repeat_share": ("n_repeat_words / n_words", 0.08),
    "word_length": ("word_chars / n_words", 1.0),
}


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once for each row, however often later
    expressions use them (a generator of one row is not merged with what follows)."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def word_array(text: Column) -> Column:
    bare = F.btrim(text, F.lit(WORD_SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def measures(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    the further counts (all long) to rows that have `text` (not null)."""
    text = F.col("text")

    def count_of(chars: str) -> Column:
        return F.length(text) - F.length(F.translate(text, chars, ""))

    df = held(docs, words=word_array(text), lines=F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WORD_SPACE)) != ""))
    w = F.col("words")
    df = held(df.withColumns({
        "n_words": F.size("words"), "word_chars": F.length(F.translate(text, WORD_SPACE, "")), "n_symbols": count_of(SYMBOLS),
        "n_shouts": count_of("!"), "n_upper": F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", "")),
        "n_lines": F.size("lines"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines"))}).drop("lines", "text"),
        grams=F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.slice(w, 1, F.size(w) - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))).drop("words")
    g = F.col("grams")
    df = held(df, sorted=F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(
        F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("grams")
    s = F.col("sorted")
    same = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"])) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    df = held(df, at=F.sort_array(F.transform(same, lambda x: x["i"]))).drop("sorted")
    a = F.col("at")
    covered = F.aggregate(F.transform(a, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(a, i + 1) - p, F.lit(3)))), F.lit(0), lambda t, x: t + x)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0))).drop("at")
    return df.withColumns({c: F.col(c).cast("bigint") for c in (
        "n_words", "word_chars", "n_symbols", "n_shouts", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")})


def fences(rows: DataFrame, spread: float, least_docs: int, sketch_k: int) -> DataFrame:
    """lang, source and one upper fence for each measure (lower as well for word_length)."""
    names = list(MEASURES)
    groups = rows.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("docs"), *[F.kll_sketch_agg_double(n, F.lit(sketch_k)).alias(n) for n in names])
    groups = cut(groups)

    def merged(by):
        return groups.groupBy(*by).agg(F.sum("docs").alias("docs"), *[F.kll_merge_agg_double(n, F.lit(sketch_k)).alias(n) for n in names])

    def bounds(df, suffix):
        def q(n, p):
            return F.when(F.col("docs") > 0, F.kll_sketch_get_quantile_double(F.col(n), F.lit(p)))
        out = {}
        for n in names:
            reach = F.greatest(q(n, 0.75) - q(n, 0.25), F.lit(MEASURES[n][1])) * spread
            out[f"{n}_high{suffix}"] = q(n, 0.5) + reach
            if n == "word_length":
                out[f"{n}_low{suffix}"] = q(n, 0.5) - reach
        return df.withColumns(out).withColumnRenamed("docs", f"docs{suffix}").drop(*names)

    all_ = bounds(merged([]), "_all")
    lang = bounds(merged(["lang"]), "_lang").withColumnRenamed("lang", "lang_")
    own = bounds(groups, "")
    out = own.join(lang, own["lang"].eqNullSafe(lang["lang_"]), "left").drop("lang_")
    wanted = [f"{n}_high" for n in names] + ["word_length_low"]
    corpus = {c: all_.select(f"{c}_all").scalar() for c in wanted}
    return out.select("lang", "source", *[
        F.when(F.col("docs") >= least_docs, F.col(c)).when(F.col("docs_lang") >= least_docs, F.col(f"{c}_lang"))
        .otherwise(corpus[c]).alias(c) for c in wanted])


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", spread: float = 4.0, least_docs: int = 50, sketch_k: int = 400) -> DataFrame:
    """One row for each input row: `id_col`, row_key (hash of the text),
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    (fewer than 50 words, or over half of them in repeated 3-word windows),
    outside (names of the measures beyond their fence), kept.

    Null and empty texts have no words and fail the base rules; null
    languages and sources form groups of their own; repeated rows are judged
    alike; an empty table gives an empty result; other columns are not read,
    whatever their names. The sketches are approximate (about 1/`sketch_k`
    of the ranks), so a document right at a fence may fall on either side.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       text_key(text_col).alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = cut(measures(rows))
    rows = rows.withColumns({n: F.when(F.col("n_words") > 0, F.expr(e)) for n, (e, _) in MEASURES.items()})
    limits = fences(rows.filter("n_words > 0"), spread, least_docs, sketch_k)
    limits = cut(limits).select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), *limits.columns[2:])
    judged = rows.join(limits, rows["lang"].eqNullSafe(limits["lang_"]) & rows["source"].eqNullSafe(limits["source_"]), "left")
    outside = F.filter(F.array(*[
        F.when((F.col(n) > F.col(f"{n}_high")) | (F.col(n) < F.col("word_length_low") if n == "word_length" else F.lit(False)), F.lit(n))
        for n in MEASURES]), lambda x: x.isNotNull())
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(F.col("id").alias(id_col), "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), outside.alias("outside"), (~failed & (F.size(outside) == 0)).alias("kept"))
