"""Part-dimension jobs: decimal repair, catalog summary, missing dimensions,
imputation, the final dimension table and the name-based patch.

All of them are row-local expressions, key joins or per-key aggregates, so
they scale with the part catalog: nothing is collected, no group is gathered
whole into one task except the joined text lists of the catalog summary,
whose size is the output cell itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermaster.operators import columns as C
from quartermaster.operators import relational as R
from quartermaster.operators.columns import q

NOT_IN_CATALOG = "Not in FLIS"


# ---------------------------------------------------------------------------
# X12 decimal repair
# ---------------------------------------------------------------------------
def _placements(x: Column) -> Column:
    """Decimal placements of an integer written without its decimal point:
    for a value of n digits, x / 10^(n-1), x / 10^(n-2), ..., x / 10^0."""
    n = F.length(x.cast("bigint").cast("string"))
    return F.transform(F.sequence(F.lit(1), n), lambda i: x / F.pow(F.lit(10.0), n - i))


def repair_dimensions(df: DataFrame, length: str, width: str, height: str, cube: str,
                      tol: float = 1e-3, suffix: str = "_new") -> DataFrame:
    """Find where the decimal point belongs in length, width and height so
    that L*W*H / 12^3 matches the known cubic feet within ``tol``.

    Candidates are tried with length outermost, then width, then height,
    each from the fewest integer digits up; the first match wins and no
    match gives NULLs. Everything is a higher-order expression on the row
    (at most digits^3 candidates), so there is no shuffle and no Python.
    """
    ls, ws, hs = _placements(q(length)), _placements(q(width)), _placements(q(height))
    combos = F.flatten(F.transform(ls, lambda a: F.flatten(F.transform(
        ws, lambda b: F.transform(hs, lambda c: F.struct(a.alias("l"), b.alias("w"), c.alias("h")))))))
    hit = F.try_element_at(
        F.filter(combos, lambda s: F.abs(s["l"] * s["w"] * s["h"] / 1728 - q(cube)) < tol), F.lit(1))
    return df.withColumns({length + suffix: hit["l"], width + suffix: hit["w"],
                           height + suffix: hit["h"]})


# ---------------------------------------------------------------------------
# X13 catalog summary
# ---------------------------------------------------------------------------
def catalog_summary(catalog: DataFrame, niins, key: str = "niin",
                    distinct_cols: Sequence[str] = ("part_number", "cage_code"),
                    list_cols: Sequence[str] = (), sep: str = ", ") -> DataFrame:
    """One row per requested part: every catalog attribute joined into a
    sorted text list (``distinct_cols`` without repeats).

    ``niins`` is a key DataFrame (left-semi join, sized by AQE) or a literal
    list (an InSet filter pushed into the scan)."""
    kept = C.keep_in(catalog, key, niins)
    return R.list_agg(kept, key, list(distinct_cols) + list(list_cols), sep,
                      distinct=set(distinct_cols))


# ---------------------------------------------------------------------------
# X14 missing dimensions
# ---------------------------------------------------------------------------
def missing_dimensions(parts: DataFrame, catalog: DataFrame, part_key: str = "NIIN",
                       cat_key: str = "niin", weight: str = "dss_weight",
                       cube: str = "dss_cube") -> DataFrame:
    """Parts that need imputation: never found in the catalog (anti join) or
    found with a zero / missing weight or cube. One row per part key with
    the reason."""
    keys = parts.select(q(part_key).alias("__k")).distinct()
    cat = catalog.select(q(cat_key).alias("__k"), q(weight).alias("__w"), q(cube).alias("__c"))
    never = keys.join(cat.select("__k"), "__k", "left_anti").withColumn(
        "reason", F.lit("not_in_catalog"))
    zero = (cat.filter(C.missing_or_zero("__w", "__c")).join(keys, "__k", "left_semi")
            .select("__k").distinct().withColumn("reason", F.lit("zero_dimension")))
    return never.unionByName(zero).withColumnRenamed("__k", part_key)


# ---------------------------------------------------------------------------
# X15 imputation
# ---------------------------------------------------------------------------
def impute_dimensions(train: DataFrame, missing: DataFrame, targets: Sequence[str] = ("dss_weight", "dss_cube"),
                      text_col: str = "Nomenclature", cat_cols: Sequence[str] = ("FSC", "UI"),
                      num_col: str = "Unit_Price", group_col: str = "FSC", model: str = "forest",
                      mode: str = "reference", key: str = "NIIN", seed: int = 42,
                      max_iter: int = 20) -> DataFrame:
    """Predict weight and cube for parts without catalog dimensions.

    Targets are learnt in log1p space. ``model='forest'`` (default) or
    ``'gbt'`` fits one ``pyspark.ml`` feature pipeline (nomenclature tokens
    hashed, category columns indexed and one-hot encoded, price
    standardised) and one tree-ensemble regressor per target (random forest
    or gradient-boosted trees); ``model='mean'`` predicts the per-``group_col`` mean (overall
    mean for unseen groups), a baseline with a plain-SQL form. Predictions
    of 0 are replaced by the smallest positive prediction. ``mode='reference'``
    stores the log1p-space value as the measure (the source notebook's
    slip); ``'corrected'`` maps it back with expm1. Rows get ``Imputed='Yes'``.
    """
    if model == "mean":
        out = missing
        for tgt in targets:
            lt = F.log1p(q(tgt))
            g = train.groupBy(q(group_col)).agg(F.avg(lt).alias("__p"))
            overall = train.select(F.avg(lt)).scalar()
            pred = out.join(g, group_col, "left").withColumn("__p", F.coalesce("__p", overall))
            out = _store_prediction(pred, tgt, mode)
        return out.withColumn("Imputed", F.lit("Yes"))
    # Every estimator fit is a pass over its input. The inputs are
    # checkpointed once (to the shared checkpoint folder) so those passes,
    # and the tree passes below, read a materialised table instead of
    # re-running the joins that produced it.
    from quartermaster.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(train.sparkSession)
    train, missing = train.checkpoint(), missing.checkpoint()
    feats = _feature_pipeline(text_col, cat_cols, num_col).fit(train)
    labels = [F.log1p(q(t)).alias(f"__y{i}") for i, t in enumerate(targets)]
    train_x = feats.transform(train).select("__x", *labels).checkpoint()
    out = feats.transform(missing)
    for i, tgt in enumerate(targets):
        fitted = _regressor(model, f"__y{i}", max_iter, seed).fit(train_x.filter(F.col(f"__y{i}").isNotNull()))
        out = _store_prediction(fitted.transform(out), tgt, mode)
    return out.select(*[c for c in missing.columns if c not in targets], *targets) \
        .withColumn("Imputed", F.lit("Yes"))


def _regressor(model: str, label: str, max_iter: int, seed: int):
    """Tree ensemble on the assembled features. 'forest' grows all trees in
    the same passes over the data (one distributed pass per depth level);
    'gbt' boosts ``max_iter`` trees one after another."""
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    if model == "gbt":
        return GBTRegressor(featuresCol="__x", labelCol=label, predictionCol="__p", maxIter=max_iter,
                            maxDepth=4, seed=seed)
    if model == "forest":
        return RandomForestRegressor(featuresCol="__x", labelCol=label, predictionCol="__p",
                                     numTrees=max_iter, maxDepth=5, seed=seed)
    raise ValueError(f"unknown model {model!r}")


def _store_prediction(pred: DataFrame, tgt: str, mode: str) -> DataFrame:
    """Zero predictions -> smallest positive prediction; reference mode keeps
    the log1p-space value as the measure, corrected maps it back."""
    pos_min = pred.select(F.min(F.when(F.col("__p") > 0, F.col("__p")))).scalar()
    p = F.when(F.col("__p") == 0, pos_min).otherwise(F.col("__p"))
    return pred.withColumn(tgt, p if mode == "reference" else F.expm1(p)).drop("__p")


def _feature_pipeline(text_col, cat_cols, num_col, num_features: int = 1 << 8):
    """Nomenclature tokens hashed, category columns indexed and one-hot
    encoded, price standardised, all assembled into ``__x``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import (
        HashingTF, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler,
    )
    stages = [RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=r"[^A-Za-z0-9]+"),
              HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features)]
    idx = [f"__{c}_i" for c in cat_cols]
    stages += [StringIndexer(inputCol=c, outputCol=o, handleInvalid="keep") for c, o in zip(cat_cols, idx)]
    stages += [OneHotEncoder(inputCols=idx, outputCols=[o + "v" for o in idx], handleInvalid="keep"),
               VectorAssembler(inputCols=[num_col], outputCol="__num", handleInvalid="keep"),
               StandardScaler(inputCol="__num", outputCol="__nums", withMean=True, withStd=True),
               VectorAssembler(inputCols=["__tf", "__nums"] + [o + "v" for o in idx], outputCol="__x")]
    return Pipeline(stages=stages)


# ---------------------------------------------------------------------------
# X16 final dimension table
# ---------------------------------------------------------------------------
FINAL_COLUMNS = ["FSC", "NIIN", "Nomenclature", "part_number", "cage_code", "UI", "Unit_Price",
                 "dss_weight", "dss_cube", "unit_pack_weight", "unit_pack_cube"]


def _zero_or_null(c: Column) -> Column:
    return c.isNull() | (c == 0)


def final_dimension_table(parts: DataFrame, catalog: DataFrame, imputed: DataFrame,
                          part_key: str = "NIIN", cat_key: str = "niin", digits: int = 3) -> DataFrame:
    """Left-join chain parts -> catalog rows with a zero dimension ->
    whole catalog -> imputed values, with the source notebook's priority
    rules (applied in order, each using the already-updated columns):

    * part number / CAGE code fall back to 'Not in FLIS';
    * the first stage keeps a catalog 0 as a value; weight and cube are
      replaced by the imputed value only when 0 or missing;
    * a unit-pack measure that is 0 or missing takes the (imputed, else
      current) weight / cube;
    * numbers are rounded to ``digits`` places and duplicate rows removed.

    Catalog and imputed tables are unique per part key; each join is a
    key join that AQE broadcasts or shuffles by measured size.
    """
    meas = ["part_number", "cage_code", "dss_weight", "dss_cube", "unit_pack_weight", "unit_pack_cube"]
    zero = catalog.filter(_zero_or_null(q("dss_weight")) | _zero_or_null(q("dss_cube")))
    zsel = zero.select(q(cat_key).alias(part_key), *[q(m).alias(f"__z_{m}") for m in meas])
    csel = catalog.select(q(cat_key).alias(part_key), *[q(m).alias(f"__q_{m}") for m in meas])
    j = parts.join(zsel, part_key, "left").join(csel, part_key, "left")
    z, qq = (lambda m: F.col(f"__z_{m}")), (lambda m: F.col(f"__q_{m}"))
    j = j.withColumns({
        "part_number": F.coalesce(z("part_number"), qq("part_number"), F.lit(NOT_IN_CATALOG)),
        "cage_code": F.coalesce(z("cage_code"), qq("cage_code"), F.lit(NOT_IN_CATALOG)),
        "dss_weight": F.coalesce(z("dss_weight"), qq("dss_weight")),
        "dss_cube": F.coalesce(z("dss_cube"), qq("dss_cube"))})
    j = j.withColumns({
        "unit_pack_weight": F.when(_zero_or_null(z("unit_pack_weight")),
                                   F.coalesce(q("dss_weight"), qq("dss_weight")))
        .otherwise(z("unit_pack_weight")),
        "unit_pack_cube": F.when(_zero_or_null(z("unit_pack_cube")),
                                 F.coalesce(q("dss_cube"), qq("dss_cube")))
        .otherwise(z("unit_pack_cube"))})
    stage1 = j.select(*[q(c) for c in FINAL_COLUMNS]).distinct()
    imp = imputed.select(q(part_key), q("dss_weight").alias("__iw"), q("dss_cube").alias("__ic"),
                         q("Imputed"))
    k = stage1.join(imp, part_key, "left")
    k = k.withColumns({
        "dss_weight": F.when(_zero_or_null(q("dss_weight")), F.col("__iw")).otherwise(q("dss_weight")),
        "dss_cube": F.when(_zero_or_null(q("dss_cube")), F.col("__ic")).otherwise(q("dss_cube"))})
    k = k.withColumns({
        "unit_pack_weight": F.when(_zero_or_null(q("unit_pack_weight")),
                                   F.coalesce(F.col("__iw"), q("dss_weight")))
        .otherwise(q("unit_pack_weight")),
        "unit_pack_cube": F.when(_zero_or_null(q("unit_pack_cube")),
                                 F.coalesce(F.col("__ic"), q("dss_cube")))
        .otherwise(q("unit_pack_cube")),
        "Imputed": F.coalesce(q("Imputed"), F.lit("No"))}).drop("__iw", "__ic")
    nums = ["Unit_Price", "dss_weight", "dss_cube", "unit_pack_weight", "unit_pack_cube"]
    return k.withColumns({c: F.round(q(c), digits) for c in nums}).distinct()


# ---------------------------------------------------------------------------
# X17 patch from a name check
# ---------------------------------------------------------------------------
def patch_from_name_check(dims: DataFrame, name_check: DataFrame, key: str = "NOMENCLATURE",
                          weight: str = "DSS_WEIGHT", cube: str = "DSS_CUBE",
                          mode: str = "reference") -> DataFrame:
    """Replace a non-positive weight (and cube) by the value found for the
    same nomenclature. In reference mode the cube test looks at the already
    patched weight, so the cube changes only where the weight stayed <= 0;
    ``mode='corrected'`` tests the original weight for both."""
    nc = name_check.select(q(key), q(weight), q(cube))
    return R.patch(dims, nc, key, [weight, cube], sequential=(mode == "reference")).distinct()
