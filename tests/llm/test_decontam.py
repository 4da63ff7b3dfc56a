import hashlib
import re

from candlewick.llm import decontam, queries
from tests.llm.helpers import DOC, SF001, empty_docs, odd_docs

ITEM = "item_id long, text string"


def brute(docs, items):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = {}
    for i, t in items:
        w = word(t)
        for k in range(max(len(w) - 13, 0) + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + 13]), set()).add(i)
    sizes = {len(x) for x in wins}
    for d, t in docs:
        w, hit, found = word(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[k:k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in got if x is not None}
        yield (d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    for sf in (SF001, "/root/testdata/sf0.01"):
        docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
        items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        want = sorted(brute(docs, items), key=repr)
        assert result(queries.op9_decontamination(spark, sf)) == want
    assert any(x[2] for x in want)


FIXTURE = [(1, "Alpha beta GAMMA"), (2, "x alpha beta gamma y " * 3), (3, "alpha beta"), (4, None), (5, "a b c d e f g h i j k l m n o p"),
           (6, "b c d e f g h i j k l m n"), (7, "a b c d e f g h i j k l"), (8, "hi"), (9, "say hi, hi-hi; été 12"), (10, " ".join(["hi"] * 500 + ["z"] * 20_000)),
           (10, "hi"), (None, "hi")]
ITEMS = [(1, "alpha beta gamma"), (2, "a b c d e f g h i j k l m n o"), (3, "HI"), (30, "hi"), (4, None), (5, " .,"), (None, "été"), (2, "A B c d e f g h i j k l m n o"), (12, "12")]


def test_fixture_in_one_and_many_blocks(spark):
    docs, items = spark.createDataFrame(FIXTURE, "doc_id long, text string"), spark.createDataFrame(ITEMS, ITEM)
    want = sorted(brute(FIXTURE, ITEMS), key=repr)
    assert result(decontam.decontaminate(docs, items)) == want
    assert result(decontam.decontaminate(docs, items, block_windows=2)) == want


def test_odd_rows_and_empty_tables(spark):
    d = odd_docs(spark)
    items = spark.createDataFrame([(1, "word and other " * 10), (None, None)], ITEM)
    out = decontam.decontaminate(d, items).toPandas()
    assert len(out) == d.count() and out.contaminated.sum() == 1 and out[out.contaminated].doc_id.tolist() == [6]
    assert out.n_hit.max() == 60_000
    none = decontam.decontaminate(d, spark.createDataFrame([], ITEM)).toPandas()
    assert not none.contaminated.any() and len(none) == len(out)
    assert decontam.decontaminate(empty_docs(spark), items).count() == 0
    assert [c.split()[0] for c in DOC.split(", ")] == empty_docs(spark).columns


def test_many_blocks_beside_clashing_columns(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    for n in ("digest", "_digest", "words", "_hit", "_items", "_sha", "n_hit"):
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    own = ("w", "h", "i", "s", "c")
    one, many = (sorted(map(tuple, decontam.decontaminate(docs, items, block_windows=k, names=own).drop("text").collect())) for k in (10**6, 50))
    assert one == many and any(r[-1] for r in one)
