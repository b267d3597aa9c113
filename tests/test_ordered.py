"""Balance and edge cases of the ordered helpers."""

import pytest
from pyspark.sql import functions as F

from riskspark.operators.ordered import bucketize, ordered_prefix, range_cuts, row_rank


@pytest.mark.parametrize("k", [200, 1366, 2049])
def test_buckets_are_even(spark, k):
    df = spark.range(400_000).withColumn("x", F.rand(3))
    sizes = bucketize(df, "x", range_cuts(df, "x", k)).groupBy("_bucket").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 2 * 400_000 / k and sizes[1] == k


def test_string_ids_and_large_longs_rank_in_their_own_order(spark):
    ids = [f"app-{i:03d}" for i in range(50)]
    got = row_rank(spark.createDataFrame([(1.0, i) for i in reversed(ids)], "s double, id string"), "s", "id", n_buckets=7, checkpoint=False)
    assert [r["id"] for r in got.orderBy("rank").collect()] == ids
    big = [2**53 + i for i in range(20)]
    got = row_rank(spark.createDataFrame([(1.0, i) for i in reversed(big)], "s double, id long"), "s", "id", n_buckets=4, checkpoint=False)
    assert [r["id"] for r in got.orderBy("rank").collect()] == big


def test_null_keys_are_ranked(spark):
    rows = [(None if i % 5 == 0 else float(i), i) for i in range(30)]
    got = row_rank(spark.createDataFrame(rows, "s double, id long"), "s", "id", n_buckets=4, checkpoint=False).collect()
    assert sorted(r["rank"] for r in got) == list(range(30))
    pre = ordered_prefix(spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 1, 4.0)], "g string, k long, v double"), "k", {"v": "v"}, by=["g"], n_buckets=2, checkpoint=False)
    assert sorted(r["cum_v"] for r in pre.collect()) == [1.0, 3.0, 4.0]


def test_quantiles_of_large_groups_look_only_at_values_near_them(spark, monkeypatch):
    import numpy as np

    from riskspark.operators import ordered as O
    monkeypatch.setattr(O, "FEW_ROWS", 1_000)
    monkeypatch.setattr(O, "ACCURACY", 200)
    written = []
    keep = O.materialize
    monkeypatch.setattr(O, "materialize", lambda df: written.append(keep(df)) or written[-1])
    df = spark.range(60_000).selectExpr("case when id % 3 = 0 then 'a' when id % 60 = 1 then 'c' when id % 6 = 5 then null else 'b' end as g",
                                        "case when id % 3 = 0 then double((id * 7919) % 60000) else double(int((id * 31) % 50)) end as x")
    probs = [0.99, 0.0, 0.25, 0.5, 1.0]
    got = {(r["g"], r["qi"]): r["quantile"] for r in O.exact_quantiles(df, "x", probs, by=["g"], checkpoint=False).collect()}
    rows = df.collect()
    for g in "abc":
        want = np.quantile([r["x"] for r in rows if r["g"] == g], probs)
        assert [got[g, i] for i in range(5)] == list(want)
    assert len(got) == 15 and written[1].count() < 3_000  # of 20,000 distinct values in a
    one = O.exact_quantiles(df, "x", probs).orderBy("qi").collect()
    assert [r["quantile"] for r in one] == list(np.quantile([r["x"] for r in rows], probs))


def test_quantiles_beside_a_wrong_bracket_are_still_exact(spark, monkeypatch):
    from riskspark.operators import ordered as O
    monkeypatch.setattr(O, "FEW_ROWS", 100)
    brackets = O._brackets
    monkeypatch.setattr(O, "_brackets", lambda *a: brackets(*a).withColumns({"_l0": F.lit(3.0), "_h0": F.lit(4.0)}))
    df = spark.range(1_001).selectExpr("double(id) as x")
    assert O.quantile_list(df, "x", [0.5]) == [500.0]


def test_bins_step_by_step_are_those_of_the_expression(spark):
    from riskspark.operators.metrics import equal_width_bin, with_equal_width_bin
    df = spark.range(3_000).selectExpr("id / 100.0e0 - 1 as x", "case when id % 10 = 0 then 2.5e0 else 0.1e0 end as lo",
                                       "case when id % 10 = 0 then 2.5e0 else 27.3e0 end as hi")
    df = df.withColumn("x", F.least(F.greatest("x", "lo"), F.col("hi"))).cache()
    stepped = with_equal_width_bin(df, F.col("x"), "lo", "hi", 50).withColumn("want", equal_width_bin(F.col("x"), F.col("lo"), F.col("hi"), 50))
    assert stepped.filter(~F.col("bin").eqNullSafe(F.col("want"))).isEmpty() and stepped.columns == ["x", "lo", "hi", "bin", "want"]
    plan = with_equal_width_bin(df, F.col("x"), "lo", "hi", 50).groupBy("bin").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("floor(") == 1
