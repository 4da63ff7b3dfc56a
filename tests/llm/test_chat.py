import hashlib
import random

import pytest

from candlewick.llm import chat, queries
from tests.llm.helpers import SF001


def test_round_trip_of_control_strings():
    rnd = random.Random(2)
    pieces = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<", "[", "/s>", "s>", "INST]", "/INST]", "\n", "é", " ok "]
    for _ in range(3000):
        turns = [("".join(rnd.choices(pieces, k=rnd.randrange(4))) or "user", "".join(rnd.choices(pieces, k=rnd.randrange(9)))) for _ in range(rnd.randrange(4))]
        turns.append(("assistant", "".join(rnd.choices(pieces, k=5))))
        done = chat.render(turns)
        assert chat.read_back(done.text) == turns
        assert chat.under_mask(done.text, done.loss) == "".join(t for r, t in turns if r == "assistant")


def test_query_against_the_table(spark):
    out = {r.conv_id: r for r in queries.op2_chat(spark, SF001).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()] + queries.ADDED
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(c, []).append((r, x or ""))
    assert set(out) == set(by)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in by.items():
        said = "".join(x for r, x in turns if r == "assistant")
        assert (out[c].n_turns, out[c].turns_sha256, out[c].loss_chars, out[c].loss_sha256) == (
            len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(said), sha(said))
        assert out[c].formatted_chars == len(chat.render(turns).text)


MESSAGES = "tree string, node long, parent long, role string, text string, score double"


def brute_paths(rows, best):
    out = {}
    for tree in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == tree]
        at = {}
        for r in mine:
            at.setdefault(r[1], r)
        up = {id(r): at.get(r[2]) if r[2] is not None else None for r in mine}
        inner = {id(p) for p in up.values() if p is not None}
        found = []
        for r in mine:
            if id(r) in inner:
                continue
            path, x = [], r
            while x is not None and len(path) <= len(mine):
                path.append(x)
                x = up[id(x)]
            if x is None:
                found.append((-sum(p[5] or 0.0 for p in path) / len(path), [p[4] for p in reversed(path)]))
        out[tree] = [p for _, p in sorted(found, key=lambda f: f[0])][:best]
    return out


@pytest.mark.parametrize("best", [1, 3])
def test_reply_trees(spark, best):
    rnd = random.Random(best)
    rows = [("deep", i, i - 1 if i else None, "user" if i % 2 else "assistant", f"d{i}", 1.0) for i in range(70)]
    rows += [("wide", i, rnd.randrange(i) if i else None, "user", f"w{i}", float(rnd.random())) for i in range(60)]
    rows += [("odd", 1, 99, "user", "orphan", 5.0), ("odd", 2, 1, "assistant", None, None), ("odd", None, 1, None, "no id", 9.0), ("odd", 3, 3, "user", "own parent", 50.0),
             ("odd", 4, 5, "user", "cycle a", 50.0), ("odd", 5, 4, "user", "cycle b", 50.0), ("odd", 6, 5, "user", "under a cycle", 70.0), (None, 1, None, "user", "tree without id", 0.5)]
    got = {}
    df = chat.paths(spark.createDataFrame(rows, MESSAGES), score="score", best=best)
    for r in df.orderBy("tree", "rank", "depth").collect():
        got.setdefault(r.tree, {}).setdefault(r["rank"], []).append(r.text)
    want = brute_paths(rows, best)
    assert {t: [p[k] for k in sorted(p)] for t, p in got.items()} == want
    done = chat.conversations(df).collect()
    assert sorted(len(chat.read_back(r.formatted)) for r in done) == sorted(len(p) for ps in want.values() for p in ps)


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [("t", 1, None, "user", "root", 1.0)] + [("t", 10 + i, 1, "user", f"y{i}", 2.0) for i in range(6)]
    rows += [("t", 2, 1, "user", "first of an id", 0.0), ("t", 2, 1, "user", "second of an id", 0.0), ("t", 3, 2, "user", "reply", 9.0)]
    seen = set()
    for seed in range(4):
        mixed = rows[:]
        random.Random(seed).shuffle(mixed)
        df = chat.paths(spark.createDataFrame(mixed, MESSAGES).repartition(3), score="score", best=3)
        seen.add(tuple((r["rank"], r.depth, r.text) for r in df.orderBy("rank", "depth").collect()))
    assert len(seen) == 1 and [x[2] for x in next(iter(seen)) if x[0] == 2] == ["root", "y0"]


def test_only_chosen_branches_are_walked(spark, monkeypatch):
    """A trunk of 300 messages with 2,000 leaves at its end: tables hold rows of messages and of one path."""
    rows = [("t", i, i - 1 if i else None, "user", "m", 0.0) for i in range(300)] + [("t", 1000 + i, 299, "user", f"leaf {i}", float(i)) for i in range(2000)]
    sizes, plain = {}, chat.cut

    def counted(df, name):
        out = plain(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(chat, "cut", counted)
    got = chat.paths(spark.createDataFrame(rows, MESSAGES), score="score").collect()
    assert len(got) == 301 and max(sizes["walk"]) == 301 and sizes["ranked"] == [1]
    assert max(r.depth for r in got) == 300 and [r.text for r in got if r.depth == 300] == ["leaf 1999"] and abs(got[0].path_score - 1999 / 301) < 1e-9


def test_chain_of_odd_rows_and_empty_table(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 0, "user", "a", "x"), (1, None, None, None, "x"), (None, 3, "assistant", "b" * 200_000, "x"), (2, 1, "assistant", "", "x")]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, score string")
    done = {r.tree: r for r in chat.conversations(chat.paths(chat.chain(t, "conv_id", ["turn", "role", "text"]), tree="conv_id"), tree="conv_id").collect()}
    assert chat.read_back(done[1].formatted) == [("", ""), ("user", "a"), ("user", "a")]
    assert chat.read_back(done[None].formatted) == [("assistant", "b" * 200_000)] and done[2].loss == [(len("<s>[INST]assistant[/INST]"),) * 2]
    assert chat.conversations(chat.paths(chat.chain(t.limit(0), "conv_id", ["turn"]), tree="conv_id"), tree="conv_id").count() == 0
