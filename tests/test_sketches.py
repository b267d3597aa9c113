from pyspark.sql import functions as F

from riskspark.operators import sketches as SK


def test_skewed_values_stay_within_the_bound(spark):
    # a third of all rows hold one value, the rest has a long tail; parts of very different size
    df = spark.range(120_000).select(
        (F.col("id") % 97 % 5).alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.exp(F.rand(3) * 12)).alias("v"),
        F.when(F.col("id") < 100, 0).otherwise(1).alias("part"))
    df = df.cache()
    probs = [0.001, 0.01, 0.1, 0.3, 0.5, 0.9, 0.99, 0.999]
    for k in (200, SK.DEFAULT_K):
        merged = SK.merge(SK.sketch(df, "v", ["g", "part"], k), ["g"], k)
        misses = [r.miss for r in SK.rank_misses(df, "v", SK.quantiles(merged, probs, ["g"]), ["g"]).collect()]
        assert len(misses) == 40 and max(misses) <= 2 * SK.rank_error(k)


def test_order_of_merging_and_ends(spark):
    df = spark.range(5_000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 10).alias("part"))
    parts = SK.sketch(df, "v", ["part"])
    twice = SK.merge(SK.merge(parts.withColumn("half", F.col("part") % 2), ["half"]))
    row = {r.q: r.quantile for r in SK.quantiles(twice, [0.0, 0.5, 1.0]).collect()}
    assert row[0.0] == 0.0 and row[1.0] == 4999.0 and abs(row[0.5] - 2500) <= 5_000 * 2 * SK.rank_error()
    assert twice.first()["n"] == 5_000


def test_nulls_nan_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), (None, 2.0), (None, 2.0)], "g string, v double")
    got = {r.g: (r.n, r.lowest, r.highest) for r in SK.sketch(df, "v", ["g"]).collect()}
    assert got == {"a": (1, 1.0, 1.0), None: (2, 2.0, 2.0)}
    assert SK.sketch(df.limit(0), "v").count() == SK.merge(SK.sketch(df.limit(0), "v")).count() == 0
