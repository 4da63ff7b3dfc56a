"""The pipeline, stage by stage, against the brute-force versions of its operators."""

import os
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from candlewick.llm import langid, mixing, queries, toxicity
from tests.llm import test_decontam, test_mixing, test_simhash
from tests.llm.helpers import DOC, SF001, empty_docs, odd_docs, write_tables

SF01 = "/root/testdata/sf0.01"
COLUMNS = [c.split()[0] for c in DOC.split(", ")]


@pytest.fixture(scope="module")
def staged(spark):
    docs, out = spark.read.parquet(f"{SF01}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.cut(stage(spark, docs, SF01), "test")
        out.append((name, before, docs))
    return out


def kept(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_columns(staged):
    assert [n for n, _, _ in staged] == ["language ID", "toxicity", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    for _, _, df in staged[:-1]:
        assert df.columns == COLUMNS


def test_language_and_toxicity(staged):
    _, docs, out = staged[0]
    judge = langid.LanguageClassifier(langid.fit_dictionaries(docs)).make()
    assert kept(out) == sorted(r.doc_id for r in docs.collect() if not judge((r.text or "").encode())[2])
    assert out.count() > 0.95 * docs.count()
    _, docs, out = staged[1]
    judge = toxicity.fit(docs, docs.sparkSession.read.parquet(f"{SF01}/labels.parquet")).make()
    assert kept(out) == sorted(r.doc_id for r in docs.collect() if not judge(r.text.encode())[3])
    assert out.count() < docs.count()


def test_dedup_and_decontamination(staged):
    _, docs, out = staged[2]
    rows = docs.collect()
    comp = test_simhash.brute_components([test_simhash.brute_fingerprint(r.text) for r in rows], [r.doc_id for r in rows])
    assert kept(out) == sorted(set(comp))
    before = {r.doc_id: r for r in rows}
    assert all(r == before[r.doc_id] for r in out.collect())
    _, docs, out = staged[3]
    items = [(r.item_id, r.text) for r in docs.sparkSession.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    bad = {x[0] for x in test_decontam.brute([(r.doc_id, r.text) for r in docs.collect()], items) if x[5]}
    assert bad and kept(out) == sorted(set(kept(docs)) - bad)


def test_mix(staged):
    _, docs, out = staged[4]
    size = {}
    for r in docs.collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
    want, mix = test_mixing.brute_targets(size), out.toPandas()
    assert set(mix.doc_id) <= set(kept(docs)) and (mix.taken > 0).all()
    for s, g in mix.groupby("source"):
        assert abs(g.taken.sum() - want[s]) <= max(2.0, 0.01 * want[s])


def test_run_equals_the_stages(spark, staged):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF01).collect())) == sorted(map(tuple, staged[-1][2].collect()))


def test_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([(4, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "Un texte sans identifiant")], "item_id long, text string")
    for docs in (odd_docs(spark), empty_docs(spark)):
        d = write_tables(spark, documents=docs, labels=labels, benchmark=items)
        out = corpus_pipeline.run(spark, d)
        assert set(out.columns) == {"doc_id", "source", "size", "source_size", "target", "taken"}
    assert out.count() == 0


def test_stages_pass_extra_columns_unchanged(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = ("n_hit", "contaminated", "digest", "_rn", "_kept_id", "grade", "lang_pred", "rejected", "row_number", "_hit")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    docs = docs.withColumn("tags", F.create_map(F.lit("id"), F.col("doc_id")))
    before = {r.doc_id: r for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF001)
        assert out.schema.names == docs.columns
        rows = out.collect()
        assert rows and all(r == before[r.doc_id] for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF01}/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, SF01).toPandas()[list(want.columns)]
    order = list(want.columns)
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and (a.astype(str) == b.astype(str)).all().all()


def test_entry_lists_the_queries_and_works_without_them(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = "import __spark_entry__ as e; print(*sorted(e.queries()))"
    env = os.environ | {"PYTHONPATH": root}
    here = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=root, env=env).stdout.split()
    assert {"pipeline", *queries.QUERIES} <= set(here)
    assert mixing.SHARE == 1.5
    for n in ("__spark_entry__.py",):
        (tmp_path / n).write_text(open(os.path.join(root, n)).read())
    (tmp_path / "candlewick").mkdir()
    for n in os.listdir(os.path.join(root, "candlewick")):
        if n != "llm":
            os.symlink(os.path.join(root, "candlewick", n), tmp_path / "candlewick" / n)
    there = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}).stdout.split()
    assert set(there) == set(here) - {"pipeline", *queries.QUERIES}
