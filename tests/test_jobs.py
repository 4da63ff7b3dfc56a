"""Mart refresh jobs over landing tables built from the driver tables."""

import os

from pyspark.sql import functions as F

from candlewick.plans import jobs
from candlewick.sources import derived
from candlewick.sources.sinks import append_landing, current_version, read_current
from candlewick.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_refresh_jobs(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    c = derived.candles(table(spark, SF, "orders"))
    append_landing(derived.candle_landing(c), land)
    # a re-poll lands every day again one day later: the marts must not double count
    append_landing(derived.candle_landing(c, ingested_at=F.col("date").cast("timestamp") + F.expr("INTERVAL 1 DAY")),
                   land)
    append_landing(derived.ticker_landing(table(spark, SF, "events")), land)
    stats, trend, base = (os.path.join(tmp_dir, n) for n in ("stats", "trend", "base"))
    assert jobs.refresh_market_stats(spark, land, stats, version=1) == "1"
    assert read_current(spark, stats).count() == 5
    as_of = "2002-01-01 00:00:00"
    jobs.refresh_trend_report(spark, land, trend, days=None, as_of=as_of, version=1)
    t = read_current(spark, trend)
    assert t.count() == 5 and t.where("trend_score between 0 and 100").count() == 5
    # the report over deduped landing rows equals the report over the candles themselves
    from candlewick.plans.marts import build_trend_report
    direct = {r["symbol"]: r["ma_60"] for r in build_trend_report(c).collect()}
    assert {r["symbol"]: float(r["ma_60"]) for r in t.collect()} == direct
    assert dict(t.dtypes)["ma_60"] == "decimal(20,4)" and dict(t.dtypes)["rsi_14"] == "decimal(10,2)"
    # a 60-day lookback far after the data finds nothing: the old version stays
    assert jobs.refresh_anomaly_baseline(spark, land, base, days=60, as_of="2030-01-01 00:00:00", version=1) is None
    assert current_version(spark, base) is None
    assert jobs.refresh_anomaly_baseline(spark, land, base, days=None, version=2) == "2"
    assert read_current(spark, base).count() == 5


def test_refresh_feature_mart(spark, tmp_dir):
    land, fng, mart = (os.path.join(tmp_dir, n) for n in ("landing", "fng", "fm"))
    c = derived.candles(table(spark, SF, "orders"))
    append_landing(derived.candle_landing(c), land, partition_by=("endpoint",))
    s = derived.sentiment(table(spark, SF, "lineitem"))
    s.select(F.to_json(F.struct(F.col("fng_value").cast("string").alias("value"),
                                F.col("fng_class").alias("value_classification"))).alias("payload"),
             F.col("fng_class").alias("value_classification"),
             F.col("date").cast("timestamp").alias("timestamp")).write.parquet(fng)
    assert jobs.refresh_feature_mart(spark, land, fng, mart, version=1) == "1"
    from candlewick.plans.marts import build_feature_mart
    direct = build_feature_mart(c, s).drop("updated_at")
    got = read_current(spark, mart).drop("updated_at")
    assert got.count() == direct.count() > 0
    assert got.select("symbol", "date", "fng_value").exceptAll(direct.select("symbol", "date", "fng_value")).isEmpty()


def test_stats_kept_up_from_landed_rows(spark, tmp_dir):
    from candlewick.sources.landing import LANDING_SCHEMA
    land, mart, ck = (os.path.join(tmp_dir, n) for n in ("landing", "mart", "ck"))
    schema = LANDING_SCHEMA + ", ingest_date DATE"
    polls = derived.ticker_landing(table(spark, SF, "events"))
    late = F.pmod(F.xxhash64("payload"), F.lit(3))
    def same():
        from candlewick.plans.marts import build_market_stats_24h
        from candlewick.sources.landing import read_landing
        want = build_market_stats_24h(read_landing(spark, land)).drop("created_at")
        got = read_current(spark, mart).drop("created_at")
        return sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))
    for n in (1, 2, 0, 2):                                              # every part has early and late polls; one lands twice
        append_landing(polls.where(late == n), land)
        jobs.stats_on_landing(spark, land, schema, mart, ck)
        assert same()
    version = current_version(spark, mart)
    jobs.stats_on_landing(spark, land, schema, mart, ck)                # nothing landed: nothing is read or written
    assert current_version(spark, mart) == version
    # a replayed batch gives the same mart, one without tickers changes nothing
    assert jobs.update_market_stats(polls.where(late == 1), mart, "batch-9") == "batch-9" and same()
    assert jobs.update_market_stats(polls.where("endpoint = 'none'").limit(0), mart + "-other", 1) is None


def test_day_by_day_runs_equal_one_run(spark, tmp_dir):
    """Late and re-polled days inside the tail; a symbol that starts late; runs without new days."""
    import datetime as dt
    import random
    rnd, day = random.Random(3), dt.date(2024, 1, 1)
    rows = []
    for s, first in (("A", 0), ("B", 0), ("LATE", 70)):
        for n in range(first, 100):
            p = 100 + 20 * rnd.random()
            rows.append((s, day + dt.timedelta(n), p, p + 1, p - 1, p + rnd.random(), float(rnd.randrange(1, 9)), dt.datetime(2024, 1, 1) + dt.timedelta(n)))
    late = [(s, d, o, h, l, c + 5, v, i + dt.timedelta(3)) for s, d, o, h, l, c, v, i in rows if d.day % 9 == 0]          # corrected closes, landing 3 days later
    schema = "symbol string, date date, open double, high double, low double, close double, volume double, ingested_at timestamp"
    every = spark.createDataFrame(rows + late, schema).cache()
    from candlewick.plans import marts
    trend, base = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "b")
    for n in (0, 40, 75, 90, 103):
        start = {0: -1, 40: 0, 75: 40, 90: 75, 103: 90}[n]
        new = every.where(F.datediff("ingested_at", F.lit("2024-01-01")).between(start + 1, n))
        jobs.update_trend_report(new, trend, n)
        jobs.update_anomaly_baseline(new, base, n)
    def told(df):
        return sorted(tuple(str(x) for x in r) for r in df.drop("created_at", "updated_at").collect())
    from candlewick.sources.sinks import conform
    assert told(read_current(spark, trend)) == told(conform(marts.build_trend_report(every), jobs.TREND_MART)) and len(told(read_current(spark, trend))) == 2
    assert told(read_current(spark, base)) == told(conform(marts.build_anomaly_baseline(every), jobs.BASELINE_MART))
    assert read_current(spark, trend + "/_tail").count() == 61 + 61 + 30


def test_feature_mart_grows_by_new_days(spark, tmp_dir):
    from candlewick.plans.marts import build_feature_mart
    from candlewick.sources.sinks import read_runs
    mart = os.path.join(tmp_dir, "features")
    c = derived.candles(table(spark, SF, "orders")).cache()
    s = derived.sentiment(table(spark, SF, "lineitem")).cache()
    edges = ["1900-01-01", "1992-02-01", "1992-04-01", "1996-01-01", "1996-01-02", "2100-01-01"]       # runs of a month, years, a day
    for n, (a, b) in enumerate(zip(edges, edges[1:])):
        part = c.where((F.col("date") >= F.lit(a).cast("date")) & (F.col("date") < F.lit(b).cast("date")))
        seen = c.where(F.col("date") < F.lit(a).cast("date")).limit(50)                                   # days polled again are not taken again
        jobs.update_feature_mart(part.unionByName(seen) if n else part, s, mart, f"run-{n}")
    want = build_feature_mart(c, s).drop("updated_at").toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    got = read_runs(spark, mart).drop("updated_at").toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    assert len(want) == len(got) > 500 and (want[["symbol", "date", "fng_value", "fng_class"]] == got[["symbol", "date", "fng_value", "fng_class"]]).all().all()
    for col in ("close", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower", "ma_7", "ma_30"):
        assert ((want[col] - got[col]).abs() < 1e-6).all(), col
    assert read_current(spark, mart + "/_tail").groupBy("symbol").count().agg(F.max("count")).first()[0] == 29
