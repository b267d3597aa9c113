"""Distributed model builders on Spark ML.

* Logistic baseline: exact median fill + standardization for numerics, most
  frequent fill + one-hot (unknown level -> all zeros) for categoricals,
  class-balanced weights, at most 200 iterations.
* Boosted trees: Spark ``GBTClassifier`` on indexed categoricals (nominal
  metadata, so splits are categorical), median-filled numerics plus missing
  flags (Spark trees reject NaN), positive-class weight n_neg / n_pos.

Fill values are fitted on the training slice only (distributed exact median
and mode) and stored inside the saved pipeline as a ``SQLTransformer`` stage.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder, OneHotEncoderModel, SQLTransformer, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators.ordered import exact_quantiles, materialize, ordered_prefix
from riskspark.operators.profile import long_values
from riskspark.schema import CATEGORICAL_COLS, DEFAULT_PARAMS, INTERACTION_COLS, TARGET
from riskspark.session import scratch_path

WEIGHT = "_weight"


def class_weight_table(df: DataFrame, y: str = TARGET) -> DataFrame:
    """Per class: n, balanced weight n / (2 n_c), and scale_pos_weight n_neg / n_pos."""
    c = df.filter(F.col(y).isNotNull()).groupBy(F.col(y).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_t"), F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("_neg"),
                F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("_pos")).withColumn("_k", F.lit(0))
    j = c.withColumn("_k", F.lit(0)).join(F.broadcast(tot), "_k")   # at most two classes
    return j.select("label", "n", (F.col("_t") / (2 * F.col("n"))).alias("balanced_weight"),
                    (F.coalesce(F.col("_neg"), F.lit(0)) / F.greatest(F.coalesce(F.col("_pos"), F.lit(0)), F.lit(1)))
                    .alias("scale_pos_weight"))


def with_class_weight(df: DataFrame, y: str = TARGET, mode: str = "balanced") -> DataFrame:
    """Append ``_weight``: balanced n/(2 n_c), or n_neg/n_pos on positives only."""
    w = class_weight_table(df, y).collect()          # at most two rows
    if mode == "balanced":
        lut = {r["label"]: float(r["balanced_weight"]) for r in w}
        expr = F.when(F.col(y) == 1, F.lit(lut.get(1, 1.0))).otherwise(F.lit(lut.get(0, 1.0)))
    else:
        spw = float(w[0]["scale_pos_weight"]) if w else 1.0
        expr = F.when(F.col(y) == 1, F.lit(spw)).otherwise(F.lit(1.0))
    return df.withColumn(WEIGHT, expr)


#: Rows up to which all values of all columns are counted for their medians.
FEW_ROWS = 100_000
#: Rows of the sample that says around which values a median of more rows is looked for, and the share of
#: rows on both sides of it that are counted value by value (ten standard errors of a sampled median).
SAMPLE_ROWS, SIDE = 100_000, 0.016


def exact_medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact (interpolated) median per column.

    Beyond ``FEW_ROWS`` rows a sample says between which values the medians are looked for. One pass counts
    the values of all columns below, in and above that range, a second one counts single values in
    it. A column whose median is not in its range has all its values counted."""
    if not cols:
        return {}
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    out, rest = {}, cols
    n = wide.count()
    if n > FEW_ROWS:
        ranges = _median_ranges(wide, cols, n)
        x = {c: F.col(c) for c in ranges}
        sides = wide.agg(*[F.struct(F.count(c).alias("n"), F.count_if(x[c] < low).alias("below"), F.count_if(x[c] <= high).alias("upto"))
                           .alias(c) for c, (low, high) in ranges.items()]).first() if ranges else {}
        inner = {}  # column -> the two places of its median, counted from the smallest value of its range
        for c in ranges:
            places = [(sides[c]["n"] - 1) // 2, sides[c]["n"] // 2]
            if sides[c]["below"] <= places[0] and places[1] < sides[c]["upto"]:
                inner[c] = [p - sides[c]["below"] for p in places]
        near = long_values(wide.select(*[F.when(x[c].between(*ranges[c]), x[c]).alias(c) for c in inner]), list(inner)) if inner else None
        out = _values_at(near, inner)
        rest = [c for c in cols if c not in out]
    if rest:
        q = exact_quantiles(long_values(wide, rest), "value", [0.5], by=["column_name"], checkpoint=False).collect()
        out |= {r["column_name"]: float(r["quantile"]) for r in q}
    return {c: out.get(c, 0.0) for c in cols}


def _median_ranges(wide: DataFrame, cols: list[str], n: int) -> dict[str, tuple[float, float]]:
    """Values around the median of each column that has any, by a sample."""
    sides = [0.5 - SIDE, 0.5 + SIDE]
    found = wide.sample(min(1.0, SAMPLE_ROWS / n), seed=7).agg(*[F.percentile_approx(c, sides, 2_000).alias(c) for c in cols]).first()
    return {c: tuple(found[c]) for c in cols if found[c]}


def _values_at(values: DataFrame | None, places: dict[str, list[int]]) -> dict[str, float]:
    """Mean of the values at two places (from 0) of each column of (column_name, value): running counts of
    distinct values in the order of the values."""
    if values is None:
        return {}
    counts = values.filter("value is not null").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    # columns have unlike scales: buckets go by the value's part of its column's range
    counts = materialize(counts)
    span = counts.groupBy("column_name").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    counts = counts.join(F.broadcast(span), "column_name")   # one row per column
    part = F.when(F.col("_hi") > F.col("_lo"), (F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(F.lit(0.0))
    run = ordered_prefix(counts, "value", {"c": "c"}, by=["column_name"], checkpoint=False, bucket_key=part)
    wanted = F.create_map(*[F.lit(v) for c, p in places.items() for v in (c, F.array(*map(F.lit, p)))])[F.col("column_name")]
    hit = run.withColumn("_p", wanted).filter(F.exists("_p", lambda r: (F.col("cum_c") - F.col("c") <= r) & (r < F.col("cum_c"))))
    by_column: dict[str, list] = {}
    for r in hit.select("column_name", "value", "cum_c").collect():   # at most two rows a column
        by_column.setdefault(r["column_name"], []).append((r["cum_c"], r["value"]))
    out = {}
    for c, p in places.items():
        a, b = (next(v for cum, v in sorted(by_column[c]) if cum > place) for place in p)
        out[c] = b - (b - a) * 0.5   # as the quantiles interpolate
    return out


def most_frequent(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """Most frequent non-NULL level per column; ties go to the smallest value."""
    if not cols:
        return {}
    body = ", ".join(f"'{c}', `{c}`" for c in cols)
    lv = df.selectExpr(f"stack({len(cols)}, {body}) as (column_name, level)").filter(F.col("level").isNotNull())
    counts = lv.groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("level").asc())
    top = counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1).collect()
    return {r["column_name"]: r["level"] for r in top}


def _fill_stage(medians: dict[str, float], modes: dict[str, str], flags: list[str] = ()) -> SQLTransformer:
    sel = ["*"]
    for c in flags:
        sel.append(f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__missing`")
    for c, v in medians.items():
        sel.append(f"COALESCE(CAST(`{c}` AS DOUBLE), {float(v)!r}D) AS `{c}__f`")
    for c, v in modes.items():
        lit = v.replace("'", "''")
        sel.append(f"COALESCE(`{c}`, '{lit}') AS `{c}__f`")
    return SQLTransformer(statement=f"SELECT {', '.join(sel)} FROM __THIS__")


def split_features(columns: list[str]) -> tuple[list[str], list[str]]:
    feats = [c for c in columns if c not in (TARGET, "issue_year", "application_id", "loan_id", WEIGHT)]
    cats = [c for c in feats if c in CATEGORICAL_COLS]
    nums = [c for c in feats if c not in CATEGORICAL_COLS]
    return nums, cats


def fit_lr(train: DataFrame, features: list[str], y: str = TARGET, max_iter: int = 200,
           c_reg: float = 1.0) -> PipelineModel:
    """Logistic baseline with class-balanced weights.

    The L2 strength follows C = 1 on a weighted sum of losses:
    regParam = 1 / (C * sum of weights), standardization done by the
    pipeline itself. ``train`` is read in about ten passes: give stored rows.
    """
    nums, cats = split_features(features)
    # each pass reads the columns it needs: a copy in memory would take the room of what the iterations read
    data = (with_class_weight(train.filter(F.col(y).isNotNull()), y, "balanced")
            .select(*nums, *cats, WEIGHT, F.col(y).cast("double").alias("label")))
    med = exact_medians(data, nums)
    modes = most_frequent(data, cats)
    total_w = data.agg(F.sum(WEIGHT)).first()[0] or 1.0
    stages = [_fill_stage(med, modes)]
    if cats:
        stages.append(StringIndexer(inputCols=[f"{c}__f" for c in cats], outputCols=[f"{c}__i" for c in cats], handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=[f"{c}__i" for c in cats], outputCols=[f"{c}__oh" for c in cats],
                                    dropLast=True, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[f"{c}__f" for c in nums], outputCol="_num"))
    stages.append(StandardScaler(inputCol="_num", outputCol="_nums", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=["_nums"] + [f"{c}__oh" for c in cats], outputCol="features"))
    stages.append(LogisticRegression(featuresCol="features", labelCol="label", weightCol=WEIGHT,
                                     maxIter=max_iter, regParam=1.0 / (c_reg * total_w),
                                     elasticNetParam=0.0, standardization=False))
    # a model as read back has no training summary, which holds the session and can't be sent to tasks once that has observed a frame
    path = scratch_path(train.sparkSession, "model-lr")
    Pipeline(stages=stages).fit(data).write().overwrite().save(path)
    return PipelineModel.load(path)


GBT_PARAM_MAP = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "min_child_weight": "minInstancesPerNode",
    "gamma": "minInfoGain",
}


def gbt_params(params: dict) -> dict:
    """Boosting parameters in Spark's names (reg_lambda has no equivalent)."""
    out = {}
    for k, v in params.items():
        if k not in GBT_PARAM_MAP:
            continue
        sk = GBT_PARAM_MAP[k]
        if sk == "featureSubsetStrategy":
            v = "all" if float(v) >= 1.0 else repr(float(v))
        elif sk in ("maxIter", "maxDepth", "minInstancesPerNode"):
            v = int(v)
        else:
            v = float(v)
        out[sk] = v
    return out


def fit_gbt(train: DataFrame, features: list[str], y: str = TARGET, params: dict | None = None,
            seed: int = 42) -> PipelineModel:
    """Boosted trees with the positive class weighted n_neg / n_pos."""
    p = dict(DEFAULT_PARAMS)
    p.update(params or {})
    nums, cats = split_features(features)
    data = with_class_weight(train.filter(F.col(y).isNotNull()), y, "scale_pos").withColumn("label", F.col(y).cast("double"))
    data = data.persist()
    try:
        med = exact_medians(data, nums)
        nulls = data.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in nums]).first() if nums else {}
        nullable = [c for c in nums if nulls[c] > 0]          # one aggregate for all columns
        levels = data.agg(*[F.countDistinct(c).alias(c) for c in cats]).first() if cats else {}
        max_levels = max([levels[c] for c in cats] + [0]) + 2
        stages = [_fill_stage(med, {c: "__missing__" for c in cats}, nullable)]
        stages += [StringIndexer(inputCol=f"{c}__f", outputCol=f"{c}__i", handleInvalid="keep",
                                 stringOrderType="alphabetAsc") for c in cats]
        inputs = [f"{c}__f" for c in nums] + [f"{c}__missing" for c in nullable] + [f"{c}__i" for c in cats]
        stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
        stages.append(GBTClassifier(featuresCol="features", labelCol="label", weightCol=WEIGHT, seed=seed,
                                    maxBins=max(32, max_levels), **gbt_params(p)))
        return Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the assembled feature vector of a fitted pipeline (in order)."""
    va = [s for s in model.stages if isinstance(s, VectorAssembler)][-1]
    names = []
    for c in va.getInputCols():
        base = c.split("__")[0]
        names.append(base + ("_is_null" if c.endswith("__missing") else ""))
    return names


def feature_importance(model: PipelineModel, top_n: int | None = None):
    """Tree importance (Spark's normalized split gain) per feature, descending."""
    spark = __import__("pyspark").sql.SparkSession.getActiveSession()
    tree = model.stages[-1]
    imp = tree.featureImportances.toArray().tolist()
    rows = sorted(zip(feature_names(model), imp), key=lambda r: (-r[1], r[0]))
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.limit(top_n) if top_n else df


def coefficient_table(model: PipelineModel, top_n: int = 15) -> DataFrame:
    """Coefficients of a fitted logistic pipeline by absolute size (ties by
    name): rank, feature, coefficient, abs_coefficient, is_interaction, and
    top_share, the share of interactions among the first ``top_n``. A level is named
    ``column=level``, levels unseen in training ``column=(other)``. One row a coefficient."""
    levels = {c: labels for s in model.stages if isinstance(s, StringIndexerModel)
              for c, labels in zip(s.getOutputCols(), s.labelsArray)}
    names: list[str] = []
    nums, last = [s for s in model.stages if isinstance(s, VectorAssembler)][0], model.stages[-1]
    names += [c.split("__")[0] for c in nums.getInputCols()]
    for s in model.stages:
        if isinstance(s, OneHotEncoderModel):
            for source, size in zip(s.getInputCols(), s.categorySizes):
                known = [f"{source.split('__')[0]}={v}" for v in levels[source]]
                names += known + [f"{source.split('__')[0]}=(other)"] * (size - len(known))
    values = last.coefficients.toArray().tolist()
    if len(names) != len(values):
        raise ValueError(f"{len(values)} coefficients for {len(names)} features")
    ordered = sorted(zip(names, values), key=lambda r: (-abs(r[1]), r[0]))
    top = ordered[:top_n]
    share = sum(n in INTERACTION_COLS for n, _ in top) / max(len(top), 1)
    rows = [(i + 1, n, v, abs(v), n in INTERACTION_COLS, share) for i, (n, v) in enumerate(ordered)]
    return SparkSession.active().createDataFrame(
        rows, "rank int, feature string, coefficient double, abs_coefficient double, is_interaction boolean, top_share double")
