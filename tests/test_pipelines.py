"""User-level pipelines not covered by a registered query as a whole."""

import json
import os

from candlewick.plans.ingest import ingest
from candlewick.plans.marts import build_trend_report, detect_ma_cross, explore_symbol
from candlewick.sources import derived
from candlewick.sources.landing import read_landing
from candlewick.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_explore_symbol(spark):
    t = derived.ticks(table(spark, SF, "events"))
    out = explore_symbol(t, "view")
    assert set(out) == {"describe", "nulls", "features", "by_hour", "by_weekday", "correlation"}
    assert out["describe"].count() == 2
    assert out["features"].count() == t.where("symbol = 'view'").count()
    assert out["by_weekday"].count() <= 7 and out["correlation"].count() == 13 * 13
    assert out["nulls"].where("column = 'price_ma20'").first()["nulls"] == 19     # warm-up rows


def test_ingest_from_dumped_responses(spark, tmp_dir):
    d = os.path.join(tmp_dir, "ticker")
    os.makedirs(d)
    for i in range(3):                                    # one response document per file
        with open(os.path.join(d, f"resp-{i}.json"), "w") as f:
            json.dump([{"market": f"KRW-C{i}", "timestamp": 1700000000000 + i},
                       {"market": f"BTC-C{i}", "timestamp": 1700000000000 + i}], f, indent=2)
    ingest(spark, {"/v1/ticker": d}, os.path.join(tmp_dir, "landing"))
    land = read_landing(spark, os.path.join(tmp_dir, "landing"), "/v1/ticker")
    assert land.count() == 3 and set(land.columns) >= {"payload", "endpoint", "ingested_at", "ingest_date"}


def test_trend_symbols_filter_and_alert(spark):
    c = derived.candles(table(spark, SF, "orders"))
    rep = build_trend_report(c, symbols=["2-HIGH", "5-LOW"], min_rows=60)
    assert {r["symbol"] for r in rep.collect()} == {"2-HIGH", "5-LOW"}
    alerts = detect_ma_cross(c, "symbol", "date", "close")
    for r in alerts.collect():
        assert r["kind"] in ("golden", "dead") and r["message"].startswith(r["symbol"])


def test_min_history(spark):
    from pyspark.sql import functions as F
    from candlewick.plans.marts import build_anomaly_baseline
    c = derived.candles(table(spark, SF, "orders"))
    tiny = c.where("symbol = '1-URGENT'").orderBy("date").limit(40).withColumn("symbol", F.lit("TINY"))
    both = c.unionByName(tiny)
    rep = {r["symbol"] for r in build_trend_report(both).collect()}
    assert "TINY" not in rep and len(rep) == 5                                # 40 < 60 rows
    base = {r["symbol"] for r in build_anomaly_baseline(both).collect()}
    assert "TINY" in base and len(base) == 6                                  # 40 >= 30 rows
