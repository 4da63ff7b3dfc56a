import hashlib
from collections import Counter
from math import log2

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from candlewick.llm import fingerprints as fp
from candlewick.llm import queries
from tests.llm.helpers import SF001, empty_docs, odd_docs


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=fp.WINDOW, max_size=300), st.integers(1, 255))
def test_levels_are_entropies(data, cut):
    x = np.frombuffer(bytes(b % cut for b in data), np.uint8)
    got = fp.window_levels(x)
    for i in range(0, len(got), 7):
        h = -sum(c / fp.WINDOW * log2(c / fp.WINDOW) for c in Counter(x[i:i + fp.WINDOW].tolist()).values())
        assert abs(got[i] - h / log2(fp.WINDOW) * fp.LEVELS) <= 1.01


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, 500).astype(np.uint8), rng.integers(0, 256, 333).astype(np.uint8)
    assert (fp.window_hashes(np.concatenate([b, a]))[333:] == fp.window_hashes(a)).all()


def test_digests_do_not_depend_on_neighbours():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 107, n).astype(np.uint8)) for n in (0, 1, 63, 64, 65, 500, 40_000, 300_000)]
    rank = fp.rarity(rng.integers(0, 50, fp.LEVELS + 1))
    whole = fp.digests(texts, rank)
    assert whole == [fp.digests([t], rank)[0] for t in texts] == fp.digests(texts[::-1], rank)[::-1]
    assert whole[0] == b"" and all(whole[1:])


def likeness_by_bits(a, b):
    f = lambda v: [int.from_bytes(v[i:i + 128], "big") for i in range(0, len(v), 128)]

    def one_way(x, y):
        total = weight = 0.0
        for p in x:
            best = -9.0
            for q in y:
                e = p.bit_count() * q.bit_count() / 1024
                best = max(best, ((p & q).bit_count() - e) / max(min(p.bit_count(), q.bit_count()) - e, 1.0))
            total += best * p.bit_count()
            weight += p.bit_count()
        return total / weight
    x, y = sorted((f(a), f(b)), key=len)
    found = one_way(x, y) if len(x) < len(y) else (one_way(x, y) + one_way(y, x)) / 2
    return min(1.0, max(0.0, found))


@pytest.mark.parametrize("pieces", [None, 3])
def test_query_equals_the_plain_definition(spark, pieces, monkeypatch):
    if pieces:
        plain = fp.in_order
        monkeypatch.setattr(fp, "in_order", lambda *a: plain(*a, pieces=pieces))
    docs = sorted(((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()), reverse=True)
    out = {r.doc_id: r for r in queries.op8_fingerprints(spark, SF001).collect()}
    assert len(out) == len(docs)
    for (i, t), (_, nxt) in zip(docs, docs[1:] + docs[:1]):
        k = len(t) // 3
        edited = t[:len(t) - k] + nxt[:k]
        r = out[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    order = [i for i, _ in docs]
    for i, j in zip(order, order[1:] + order[:1]):
        a, b, c = (bytes.fromhex(x) for x in (out[i].fingerprint, out[i].edited_fingerprint, out[j].fingerprint))
        assert abs(out[i].near_next - (1.0 if a == c else likeness_by_bits(a, c))) < 1e-4
        assert abs(out[i].near_edited - (1.0 if a == b else likeness_by_bits(a, b))) < 1e-4
    same = {}
    for i, t in docs:
        same.setdefault(t, set()).add(out[i].fingerprint)
    assert all(len(s) == 1 for s in same.values())
    assert np.mean([r.near_edited for r in out.values()]) > 0.4 + np.mean([r.near_next for r in out.values()])


def test_odd_rows(spark):
    d = odd_docs(spark)
    out = fp.compare_in_order(d).collect()
    assert len(out) == d.count() and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.fingerprint for r in by[1] + by[2]] == ["", ""] and by[4][0].fingerprint == by[5][0].fingerprint != ""
    assert by[2][0].near_next == 1.0 and by[6][0].n_chars == 300_000        # an empty text is followed by a NULL one
    assert sorted(x for r in by[4] for x in [r.near_next])[-1] == 1.0
    assert by[8][0].near_next == 0.0 or by[8][0].near_next < 0.5


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=fp.SHORT, max_size=80), st.integers(1, 255))
def test_short_windows(data, cut):
    x = np.frombuffer(bytes(b % cut for b in data), np.uint8)
    got, h = fp.window_levels(x, fp.SHORT), fp.window_hashes(x, fp.SHORT)
    parts = [bytes(x[i:i + fp.SHORT]) for i in range(len(x) - fp.SHORT + 1)]
    for i, w in enumerate(parts):
        e = -sum(c / fp.SHORT * log2(c / fp.SHORT) for c in Counter(w).values())
        assert abs(got[i] - e / log2(fp.SHORT) * fp.LEVELS) <= 1.01
    assert len(set(h.tolist())) == len(set(parts))


def test_short_texts_keep_their_likeness(spark):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(3, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words, 120))[:n] for n in (20, 40, 63, 64, 65, 100, 191, 255, 256, 300, 511, 512, 600) for _ in range(12)]
    out = fp.compare_in_order(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for n in {len(t) for t in texts}:
        mine = [r for r in out if r.n_chars == n]
        assert np.mean([r.near_edited for r in mine]) > 0.4 and np.mean([r.near_next for r in mine]) < 0.15, n


def test_one_document_and_empty_table(spark):
    one = fp.compare_in_order(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fp.compare_in_order(empty_docs(spark)).count() == 0
