"""Small column helpers and projections."""

import datetime as dt
import json

from pyspark.sql import functions as F

from candlewick.functions.scalar import audit_columns, fill, keep_where, null_if, thousands, to_json_payload
from candlewick.functions.timestamps import iso_text, to_day
from candlewick.operators.contract import parse_messages, rename_canonical
from candlewick.operators.profile import row_count
from candlewick.sources.sinks import overwrite_mart, read_mart


def test_scalars(spark):
    df = spark.createDataFrame([(None, 0.0, -1.5, 1234567.891)], "a double, b double, c double, d double")
    r = df.select(fill("a", 50).alias("a"), null_if("b", 0.0).alias("b"),
                  keep_where(F.col("c") > 0, "c").alias("c"), thousands("d").alias("d")).first()
    assert r["a"] == 50 and r["b"] is None and r["c"] == 0.0 and r["d"] == "1,234,568"


def test_time_text_and_day(spark):
    r = spark.createDataFrame([(dt.datetime(2025, 10, 10, 10, 10, 10, 123000), "2025-10-09T08:28:29")],
                              "t timestamp, s string").select(iso_text("t").alias("iso"), to_day("s").alias("d")).first()
    assert r["iso"] == "2025-10-10T10:10:10.123Z" and str(r["d"]) == "2025-10-09"


def test_payload_audit_rename_and_mart(spark, tmp_dir):
    df = spark.createDataFrame([("KRW-BTC", 1.5)], "symbol string, price double")
    assert json.loads(to_json_payload(df).first()["payload"]) == {"symbol": "KRW-BTC", "price": 1.5}
    a = audit_columns(df, source="upbit", at=F.lit(None).cast("timestamp"))
    assert a.columns == ["symbol", "price", "source", "created_at"]
    msgs = spark.createDataFrame([(json.dumps({"type": "trade", "code": "KRW-BTC", "ask_bid": "BID"}),)], "value string")
    r = rename_canonical(parse_messages(msgs), "trade").first()
    assert r["symbol"] == "KRW-BTC" and r["side"] == "BID"
    mart = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))], "id int, ts_event timestamp")
    for _ in range(2):                                    # only the current version is read
        overwrite_mart(mart, tmp_dir + "/mart")
    assert [r["id"] for r in read_mart(spark, tmp_dir + "/mart").collect()] == [2, 1]
    assert row_count(df).first()["rows"] == 1


def test_timestamps_out_of_range_are_null(spark):
    """Digits that fit a long but not a timestamp must not end the job."""
    from candlewick.functions.timestamps import epoch_ms_to_ts_seconds, smart_timestamp
    df = spark.createDataFrame([("9223372036854775807",), ("253402300799999",), ("253402300800000",), ("99999999999999999999",), ("1700000000123",), (None,)], "x string")
    got = [r["t"] for r in df.select(F.unix_millis(smart_timestamp("x")).alias("t")).collect()]
    assert got == [None, 253402300799999, None, None, 1700000000123, None]
    ms = spark.createDataFrame([(-1,), (1999,), (None,)], "x long")
    assert [r["t"] for r in ms.select(F.unix_seconds(epoch_ms_to_ts_seconds("x")).alias("t")).collect()] == [-1, 1, None]
