import numpy as np

from candlewick.llm import queries, toxicity
from tests.llm.helpers import empty_docs, odd_docs

SF01 = "/root/testdata/sf0.01"
INSULTS = r"\b(idiot|pathetic|clown|scum|trash|worthless|loser|stupid|moron|disgusting)\b"


def test_planted_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().set_index("doc_id")
    out = queries.op1_toxicity(spark, SF01).toPandas().set_index("doc_id")
    bad = docs.text.str.lower().str.contains(INSULTS).reindex(out.index)
    assert len(out) == len(docs)
    assert out.toxic[bad].mean() > 0.9 and out.toxic[~bad].mean() < 0.02
    assert (out.expected_severity.between(0, toxicity.GRADES - 1)).all()
    assert out.expected_severity[bad].mean() > 1.0 + out.expected_severity[~bad].mean()
    assert ((out.grade >= 1) == out.toxic).all()


def test_cumulative_link_recovers_thresholds():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (6000, 4)).astype(float)
    s = x @ np.array([2.0, -1.0, 0.5, 0.0])
    theta = np.array([0.0, 1.0, 2.5])
    y = (s[:, None] + rng.logistic(size=(6000, 1)) > theta[None, :]).sum(axis=1)
    w, th = toxicity._solve(x, y, np.ones(6000), 4, l2=0.0)
    assert np.allclose(w, [2.0, -1.0, 0.5, 0.0], atol=0.2) and np.allclose(th, theta, atol=0.25)
    assert (np.diff(th) > 0).all()


def test_odd_rows_and_empty_tables(spark):
    d = odd_docs(spark)
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (6, 0, 0), (None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    out = toxicity.grade(d, toxicity.fit(d, labels, min_documents=1, min_evidence=0.1), names=("g", "e", "p", "t")).toPandas()
    assert len(out) == d.count() and out.e.notna().all() and list(out.columns) == d.columns + ["g", "e", "p", "t"]
    e = empty_docs(spark)
    none = toxicity.fit(e, labels.limit(0))
    assert none.words == () and toxicity.grade(e, none).count() == 0
    assert not toxicity.grade(d, none, names=("g", "e", "p", "t")).toPandas().t.any()
