import numpy as np

from candlewick.llm import masked_lm, queries
from tests.llm.helpers import SF001, empty_docs, odd_docs


def test_probabilities_sum_to_one_and_see_both_sides():
    flat = masked_lm.initial(3)
    w = masked_lm.unpack(flat)
    w["embed"][...] *= 20
    w["mem"][...] *= 20
    base = np.array([masked_lm.TOKENS] * 2 + [5, 9, 700, 40, 8] + [masked_lm.TOKENS] * 2, np.int32)
    total = 0.0
    for t in range(masked_lm.TOKENS):
        s = base.copy()
        s[4] = t
        total += np.exp(masked_lm.log_probabilities(w, s)[4])
    assert abs(total - 1) < 1e-3
    for side in (3, 5):
        s = base.copy()
        s[side] = 77
        assert masked_lm.log_probabilities(w, s)[4] != masked_lm.log_probabilities(w, base)[4]


def test_training_lowers_the_loss_and_gradient_is_right():
    rng = np.random.default_rng(0)
    stream = np.concatenate([[masked_lm.TOKENS] * 2, np.tile([3, 50, 7, 900], 2000), [masked_lm.TOKENS] * 2]).astype(np.int32)
    stream[2:-2][rng.random(8000) < 0.05] = 11
    flat = masked_lm.initial(1)
    before = masked_lm.log_probabilities(masked_lm.unpack(flat), stream).sum()
    squares = np.zeros_like(flat)
    for _ in range(12):
        assert masked_lm.train(flat, squares, stream) == 8000
    after = masked_lm.log_probabilities(masked_lm.unpack(flat), stream).sum()
    assert after > 0.4 * before and np.isfinite(flat).all()


def test_query_scores_language_above_noise(spark):
    out = queries.op5_masked_lm(spark, SF001).toPandas()
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert sorted(out.doc_id) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert (out.log_likelihood <= 0).all() and np.allclose(out.mean_log_likelihood * out.n_tokens, out.log_likelihood)
    model = masked_lm.fit(docs)
    rng = np.random.default_rng(5)
    texts = [r.text for r in docs.where("lang = 'en'").limit(60).collect()]
    shuffled = [" ".join(rng.permutation(t.split())) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts + shuffled)], "doc_id long, text string")
    s = masked_lm.score(df, model).toPandas().set_index("doc_id").log_likelihood
    assert (s[:60].values.mean()) > (s[60:].values.mean())


def test_odd_rows_and_empty_table(spark):
    d = odd_docs(spark)
    model = masked_lm.fit(d, rounds=1)
    out = masked_lm.score(d, model).toPandas()
    assert len(out) == d.count()
    none = out[out.doc_id.isin([1, 2, 3, 7])]
    assert (none.n_tokens == 0).all() and (none.log_likelihood == 0).all() and none.mean_log_likelihood.isna().all()
    assert out[out.doc_id == 6].n_tokens.tolist() == [60_000]
    e = empty_docs(spark)
    assert masked_lm.score(e, masked_lm.fit(e)).count() == 0


def test_words_outside_the_vocabulary_are_told_apart(spark, monkeypatch):
    common = " ".join(f"w{i}" for i in range(1000)) + " "
    docs = spark.createDataFrame([(i, common + "quaxing " * (i < 9) + f"zz{i}ing") for i in range(20)], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "w1 quaxing w2"), (1, "w1 zz3ing w2"), (2, "w1 nevering w2"), (2, "w1 nevering w2")], "doc_id long, text string")
    told = []
    for near in (0, 100_000):                            # joined, or sent to the tasks: the same scores
        monkeypatch.setattr(masked_lm, "NEAR", near)
        monkeypatch.setattr(masked_lm, "TOKENS", 1000 + masked_lm.ENDINGS)
        model = masked_lm.fit(docs, rounds=1)
        assert len(model.ids) == 1000 and sum(model.types) == 21 and bool(model.near) == bool(near)
        told.append([r.log_likelihood for r in masked_lm.score(asked, model).orderBy("doc_id").collect()])
    (often, once, never, again), other = told
    assert often > once > never == again and np.allclose(told[0], other)
    assert np.isclose(once - never, np.log(1.5 / 0.5))


def test_vocabulary_grows_with_the_corpus(spark):
    rows = [(f"w{i}".encode(), 40_000 - i) for i in range(5000)] + [(b"x", 1), (b"yz", 2)]
    model = masked_lm.vocabulary(spark.createDataFrame(rows, "w binary, n long"))
    assert len(model.ids) > 3 * masked_lm.TOKENS and model.size ** 2 >= len(model.ids) + masked_lm.ENDINGS
    assert model.ids[b"w0"] == 0 and max(model.ids.values()) == len(model.ids) - 1
    df = spark.createDataFrame([(b"x",), (b"yz",), (b"long word",), ("été".encode(),)], "w binary")
    assert [r.e for r in df.select(masked_lm.ending_of("w").alias("e")).collect()] == [masked_lm.ending(bytes(r.w)) for r in df.collect()]


def test_vocabulary_is_filled_where_counts_tie(spark):
    rows = [(f"w{i:04d}".encode(), 20) for i in range(2000)]
    model = masked_lm.vocabulary(spark.createDataFrame(rows, "w binary, n long"))
    assert list(model.ids) == [w for w, _ in rows[:masked_lm.TOKENS - masked_lm.ENDINGS]]
    assert sum(model.types) == 2000 - len(model.ids) and sum(model.tokens) == 20 * sum(model.types)
    assert set(model.near) | set(model.ids) == {w for w, _ in rows}


def test_words_are_encoded_as_one_by_one():
    ids, near = {b"a": 0, b"the": 1}, {b"often": -1.5, b"word": -2.0}
    k = masked_lm.CLASSES
    texts = [b"a the often rare", None, b"", b"word word x9 a", "été".encode()]
    stream, sizes, shares, far = masked_lm.Words(ids, near, k).encode(texts)
    out = [k * k] * masked_lm.SIDE
    for t in texts:
        words = masked_lm.alnum_words(t)
        out += [ids.get(w, k * k - masked_lm.ENDINGS + masked_lm.ending(w)) for w in words] + [k * k] * masked_lm.SIDE
    assert stream.tolist() == out and sizes.tolist() == [4, 0, 0, 4, 1]
    assert shares.tolist() == [-1.5, 0, 0, -4.0, 0] and far == [[b"rare"], [], [], [b"x9"], ["été".encode()]]
