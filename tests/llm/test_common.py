from pyspark.sql import types as T

from candlewick.llm.common import annotate


def test_outputs_with_taken_names_leave_the_columns_alone(spark):
    df = spark.createDataFrame([(1, "ab", "x"), (2, None, None)], "doc_id long, text string, Size string")
    out = annotate(df, "text", lambda: lambda raw: (len(raw or b""),), [("size", T.LongType())])
    assert out.columns == ["doc_id", "text", "Size", "_size"]
    assert sorted(map(tuple, out.collect())) == [(1, "ab", "x", 2), (2, None, None, 0)]
