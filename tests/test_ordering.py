"""Pages through an index of the order."""

import pytest

from candlewick.operators.ordering import order_by, page_index


def rows(spark):
    data = [(i, float(i % 7) if i % 5 else None, f"n{i}") for i in range(500)] + [(500 + i, 3.0, "tie") for i in range(300)]     # a hot value and NULLs
    return spark.createDataFrame(data, "id long, x double, name string").repartition(4)


@pytest.mark.parametrize("order", [("x", "id"), ("-x", "id"), ("-id",), ("name", "-id")])
def test_every_page_in_order(spark, order):
    df = rows(spark)
    want = [tuple(r) for r in order_by(df, *order).collect()]
    index = page_index(df, *order, ranges=9)
    assert index.total == len(want) == 800
    assert len({b[1] for b in index.blocks}) == len(index.blocks)
    for n in (1, 2, 9, 16, 17):
        assert [tuple(r) for r in index.page(n, 50).collect()] == want[(n - 1) * 50:n * 50]


def test_empty_frame(spark):
    index = page_index(rows(spark).where("id < 0"), "id")
    assert index.total == 0 and index.page(1).collect() == []


def test_a_page_reads_its_blocks_only(spark, tmp_dir):
    path = tmp_dir + "/t"
    spark.range(10_000).withColumnRenamed("id", "k").write.parquet(path)
    index = page_index(spark.read.parquet(path), "k", ranges=20)
    assert len(index.blocks) > 10
    plan = index.page(60, 100)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k" in plan and "LessThanOrEqual(k" in plan


def test_strict_casts_abort(spark):
    from candlewick.functions.json import json_fields
    bad = spark.createDataFrame([('{"n": "12x"}',)], "payload string")
    assert json_fields(bad, "payload", {"n": ("$.n", "int")}).first()["n"] is None
    with pytest.raises(Exception, match="(?i)cast|variant"):
        json_fields(bad, "payload", {"n": ("$.n", "int")}, strict=True).collect()
