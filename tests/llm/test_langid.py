import zlib

from candlewick.llm import langid, queries
from tests.llm.helpers import SF001, empty_docs, odd_docs


def test_held_out_accuracy_and_contract(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas().set_index("doc_id")
    out = queries.op6_langid(spark, SF001).toPandas().set_index("doc_id")
    assert len(out) == len(docs) and set(out.lang_pred) <= set(docs.lang.dropna()) | {"und"}
    assert all(out.held_out[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out.index)
    assert out.score.between(0, 1).all()
    test = out[out.held_out].join(docs.lang)
    assert (test.lang_pred == test.lang).mean() > 0.9


def test_odd_rows(spark):
    d = odd_docs(spark)
    model = langid.LanguageClassifier(langid.fit_dictionaries(d))
    assert set(model.dictionaries) == {"en", "fr"}            # de has no letter in any text
    out = langid.identify(d, model, names=("p", "s", "r")).toPandas()
    assert len(out) == d.count() and list(out.columns) == d.columns + ["p", "s", "r"]
    by = {(None if x != x else int(x)): (p, s, r) for x, p, s, r in zip(out.doc_id, out.p, out.s, out.r)}
    assert by[1] == by[2] == by[3] == by[7] == ("und", 0.0, True)
    assert by[6][0] == "en" and by[8][0] == "fr" and by[None][0] in ("en", "fr")   # a row without id is judged but teaches nothing
    assert langid.identify(d, model, names=("p", "s", "r")).columns == d.columns + ["p", "s", "r"]


def test_empty_table_and_no_language(spark):
    e = empty_docs(spark)
    model = langid.LanguageClassifier(langid.fit_dictionaries(e))
    assert model.dictionaries == {} and langid.identify(e, model).count() == 0
    assert model.make()(b"some text") == ("und", 0.0, True)


def test_narrow_margin_is_rejected():
    same = langid.normalise("the same words for both of the languages " * 20)
    judge = langid.LanguageClassifier({"aa": same, "bb": same}).make()
    assert judge(b"the same words for both") == ("aa", 0.0, True)
