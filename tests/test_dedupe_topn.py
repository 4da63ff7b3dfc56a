"""Dedupe, latest-per-key and exact top-n against brute force."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.operators.dedupe import (dedupe_latest, latest_per_key, latest_two, min_history, newest_n_per_key,
                                         unique_violations)
from candlewick.operators.series import number_rows
from candlewick.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_newest_n_matches_row_number(spark):
    ev = table(spark, SF, "events").repartition(9)
    w = W.partitionBy("event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    exp = {tuple(r) for r in ev.withColumn("r", F.row_number().over(w)).where("r <= 7")
           .select("event_type", "event_id", "r").collect()}
    got = {tuple(r) for r in newest_n_per_key(ev, "event_type", ["ts", "event_id"], 7, rank_name="r")
           .select("event_type", "event_id", "r").collect()}
    assert got == exp


def test_latest_per_key_and_two(spark):
    ev = table(spark, SF, "events")
    last = {r["event_type"]: r["event_id"] for r in latest_per_key(ev, "event_type", ["ts", "event_id"]).collect()}
    exp = {r["event_type"]: r["event_id"] for r in
           ev.withColumn("r", F.row_number().over(W.partitionBy("event_type").orderBy(F.col("ts").desc())))
           .where("r = 1").collect()}
    assert last == exp
    two = latest_two(ev, "event_type", ["ts", "event_id"])
    assert two.groupBy("event_type").count().where("count != 2").count() == 0


def test_dedupe_idempotent(spark):
    li = table(spark, SF, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    once = dedupe_latest(li, ["l_orderkey", "l_linenumber"], order)
    twice = dedupe_latest(once, ["l_orderkey", "l_linenumber"], order)
    assert once.count() == twice.count() == li.select("l_orderkey", "l_linenumber").distinct().count()
    assert unique_violations(once, ["l_orderkey", "l_linenumber"]).count() == 0
    assert unique_violations(li, ["l_orderkey", "l_linenumber"]).count() > 0


def test_min_history(spark):
    ev = table(spark, SF, "events")
    kept = min_history(ev, "user_id", 8)
    counts = ev.groupBy("user_id").count()
    assert kept.count() == counts.where("count >= 8").agg(F.sum("count")).first()[0]


def test_bucketed_numbering_equals_plain(spark):
    ev = table(spark, SF, "events")
    a = number_rows(ev, ["event_type"], ["ts", "event_id"]).select("event_id", "_rn")
    b = number_rows(ev, ["event_type"], ["ts", "event_id"], F.date_trunc("day", "ts")).select("event_id", "_rn")
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_newest_n_on_nan_and_null_and_its_plan(spark):
    """NaN is newest, NULL oldest, as in a plain ranked window; groups are limited on both sides of the exchange."""
    rows = [("a", x) for x in (1.0, float("nan"), None, 3.0, 2.0)] + [(None, 1.0), (None, None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = newest_n_per_key(df, "k", "v", 2).collect()
    assert sorted(repr(tuple(r)) for r in got) == sorted(["('a', nan)", "('a', 3.0)", "(None, 1.0)", "(None, None)"])
    plan = newest_n_per_key(table(spark, SF, "events"), "event_type", ["ts", "event_id"], 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Python" not in plan and "Arrow" not in plan
