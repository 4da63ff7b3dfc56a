"""Profiling aggregates against pandas/numpy."""

import numpy as np
from pyspark.sql import functions as F

from candlewick.operators.profile import correlation_matrix, describe, mean_by_weekday, null_profile
from candlewick.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_describe_matches_pandas(spark):
    ev = table(spark, SF, "events")
    got = {r["column"]: r for r in describe(ev, ["value", "user_id"]).collect()}
    pdf = ev.select("value", "user_id").toPandas()
    for c in ("value", "user_id"):
        d = pdf[c].describe()
        r = got[c]
        assert r["count"] == d["count"]
        for k, pk in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"),
                      ("p75", "75%"), ("max", "max")):
            assert abs(r[k] - d[pk]) < 1e-9 * max(1, abs(d[pk])), (c, k)


def test_correlation_and_constant_column(spark):
    ev = table(spark, SF, "events").select("value", "user_id", F.lit(1.0).alias("const"))
    got = {(r["col_a"], r["col_b"]): r["r"] for r in correlation_matrix(ev, ["value", "user_id", "const"]).collect()}
    pdf = ev.toPandas()
    assert abs(got[("value", "user_id")] - np.corrcoef(pdf.value, pdf.user_id)[0, 1]) < 1e-12
    assert got[("value", "value")] == 1.0 or abs(got[("value", "value")] - 1) < 1e-12
    assert got[("const", "value")] is None                      # constant column: NULL, no error


def test_null_profile_and_weekday(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, None)], "a int, b double")
    got = {r["column"]: r["nulls"] for r in null_profile(df).collect()}
    assert got == {"a": 1, "b": 2}
    ts = spark.createDataFrame([("2024-01-01 10:00:00", 1.0), ("2024-01-07 10:00:00", None)], "t string, x double") \
              .withColumn("t", F.col("t").cast("timestamp"))
    r = mean_by_weekday(ts, "t", "x").collect()
    assert len(r) == 1 and r[0]["day_name"] == "Mon" and r[0]["day_of_week"] == 0   # NULL x dropped


def test_quantiles_on_hot_values_and_no_jobs_before_use(spark):
    from candlewick.operators.profile import exact_quantiles, quantile_row
    rng = np.random.default_rng(4)
    x = np.concatenate([np.zeros(900), rng.normal(0, 1e6, 700), rng.normal(0, 1e-6, 300), [-1e300, 1e300], rng.integers(-5, 5, 800)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.73, 0.999, 1.0]
    assert np.allclose(exact_quantiles(df, "v", probs), np.quantile(x, probs), rtol=1e-12, atol=0)
    assert exact_quantiles(df.where("v > 1e301"), "v", [0.5]) == [None]
    assert exact_quantiles(spark.createDataFrame([(3,)], "v int"), "v", [0.2]) == [3.0]
    broken = df.select(F.raise_error(F.lit("never run")).cast("double").alias("v"))
    assert quantile_row(broken, "v", [0.5]).columns == ["q"]                     # building the plan runs nothing
