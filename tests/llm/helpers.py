"""Small tables for the operator tests."""

import os
import tempfile

SF001 = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"

#: NULLs in any column, empty, blank and very long texts, ties, repeated rows, clashing extra columns.
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, "  \t\n ", "de", "a", 5), (4, "The same text of some few words here.", "en", "a", 37),
    (4, "The same text of some few words here.", "en", "a", 37), (5, "The same text of some few words here.", "en", "b", 37),
    (6, "word and other " * 20_000, "en", None, 300_000), (None, "Un texte sans identifiant, avec été.", "fr", "b", 36), (7, "?!", "fr", "c", 2), (8, "ÉTÉ \U0001F600 日本", "fr", "c", 9),
]


def odd_docs(spark):
    from pyspark.sql import functions as F
    return (spark.createDataFrame(ODD, DOC).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(7)).withColumn("n_hit", F.lit("y"))
            .withColumn("size", F.lit(None).cast("int")).withColumn("fp", F.lit(1)).withColumn("utf8", F.lit("z")))


def empty_docs(spark):
    return spark.createDataFrame([], DOC)


def write_tables(spark, **frames) -> str:
    d = tempfile.mkdtemp(prefix="cw-llm-")
    for name, df in frames.items():
        df.write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
