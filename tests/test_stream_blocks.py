"""The registered stream queries over several micro-batches, against their SQL twins (DuckDB)."""

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.plans import catalog
from tests.test_oracle import SF, norm

@pytest.fixture(scope="module", autouse=True)
def few_state_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("name", ["stream_alerts_every", "stream_alerts_blocks", "stream_alerts", "stream_recent", "stream_recent_capped", "stream_routed", "stream_snapshot", "stream_orderbook", "stream_rejected", "realtime_price"])
def test_stream_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    exp = norm(con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({E.oracle_sql()[name]})").fetchall())
    assert norm(df.select(*cols).collect()) == exp and exp


def test_many_micro_batches_and_a_cap_that_binds(spark):
    import json
    import os
    hot = catalog._hot(spark, SF, catalog.SMALL_CAP)
    batches = [f for f in os.listdir(hot.path("checkpoint", "symbols", "commits")) if f.isdigit()]
    assert len(batches) >= 10
    per = {r["symbol"]: r["count"] for r in hot.trades(spark).groupBy("symbol").count().collect()}
    assert max(per.values()) == catalog.SMALL_CAP < max(r["count"] for r in catalog._hot(spark, SF).trades(spark).groupBy("symbol").count().collect())
    offsets = json.loads(open(hot.path("checkpoint", "symbols", "offsets", batches[0])).read().splitlines()[-1])
    assert offsets["logOffset"] >= 0
