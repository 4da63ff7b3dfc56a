"""Alignment against whole-text walks with the tokenizer libraries themselves."""

import os
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import alignment as A
from candlewick.llm.queries import op12_alignment
from tests.llm.helpers import DOC, ODD, SF001, empty_docs, odd_docs

WHERE = A.Tokenizers()
TEXTS = ["Hello  world, this is a test.", "x", " ", "\n\n a\tb  c   d", "café naïve Größe", "日本語のテキスト", "\U0001F600 emoji \U0001F468‍\U0001F469‍\U0001F467", "<|endoftext|> and </s><s> <unk> <0x41>",
         "▁already marked", "a" * 3000, "tail spaces   ", "ﬁ ligature ① ™", "\u0000 nul", "z̷̢ combining", "a b c", " " * 1500 + "b", "word " * 400, None, ""]


@pytest.fixture(scope="module")
def tools():
    t = Tokenizer.from_file(os.path.join(WHERE.folder, WHERE.byte_level))
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=os.path.join(WHERE.folder, WHERE.pieces)), A.aligner(WHERE)


def plain(tools, text):
    """(A ids, B ids, groups as text, links) by byte ranges of a whole text, or None."""
    t, sp, tool = tools
    if not text:
        return None
    a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    raw, ranges = (" " + text).encode(), []
    for side, ids in ((tool.a, a), (tool.b, b)):
        if b"".join(side.tokens[i] for i in ids) != raw:
            return None
        ends = np.cumsum([len(side.tokens[i]) for i in ids])
        ranges.append([(int(e) - len(side.tokens[i]), int(e), i) for e, i in zip(ends, ids)])
    links, j = [], 0
    for s, e, i in ranges[0]:
        while ranges[1][j][1] <= s:
            j += 1
        links += [(i, k) for x, y, k in ranges[1][j:j + e - s + 1] if x < e and y > s]
    groups, at = [], [0, 0]
    for end in sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]}):
        told = []
        for k, r in enumerate(ranges):
            start = at[k]
            while at[k] < len(r) and r[at[k]][1] <= end:
                at[k] += 1
            told.append(",".join(str(i) for _, _, i in r[start:at[k]]))
        groups.append("|".join(told))
    return a, b, ";".join(groups), links


def expected(tools, docs):
    per = [(i, plain(tools, t)) for i, t in docs]
    count = Counter(p for _, x in per if x for p in set(x[3]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for i, x in per:
        out.append((i, 0, 0, 0, 0, 0, 0, "") if x is None else
                   (i, len(x[0]), len(x[1]), x[2].count(";") + 1, len(x[3]), sum(count[p] == most[p[0]] for p in x[3]),
                    sum(count[p] for p in x[3]), sha256(x[2].encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


def test_query_equals_plain_walk(spark, tools):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    assert got(op12_alignment(spark, SF001)) == expected(tools, [tuple(r) for r in docs])


@pytest.mark.parametrize("links", [50, 4_000_000])
def test_odd_texts_in_any_blocks(spark, tools, links):
    docs = list(enumerate(TEXTS))
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in docs], DOC).repartition(3)
    assert got(A.document_links(df, block_links=links)) == expected(tools, docs)


def test_odd_rows_and_columns(spark, tools):
    docs = odd_docs(spark).withColumn("block", F.lit(1)).withColumn("pairs", F.lit("x")).withColumn("groups", F.lit(0))
    assert got(A.document_links(docs)) == expected(tools, [d[:2] for d in ODD])
    aligned = A.align(docs)
    assert aligned.columns == [*docs.columns, "_groups"]
    for r in aligned.collect():
        p = plain(tools, r["text"])
        told = ";".join(",".join(map(str, g["a"])) + "|" + ",".join(map(str, g["b"])) for g in r["_groups"])
        assert told == (p[2] if p else "") and (not p or r["_groups"][-1]["end"] == len(r["text"].encode()) + 1)
    assert A.document_links(empty_docs(spark)).collect() == []


def test_invalid_utf8_has_no_tokens(spark):
    df = spark.createDataFrame([(1,)], "doc_id long").withColumn("text", F.unhex(F.lit("61ff62")).cast("string"))
    assert got(A.document_links(df)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_memory_starts_anew_without_a_change(tools, monkeypatch):
    tool = A.Aligner(WHERE)
    raws = [t.encode() if t is not None else None for t in TEXTS]
    want = [(x[0], x[1], x[2].tolist()) for x in tool.links(tool.encode(raws))]
    monkeypatch.setattr(A, "MEMO_IDS", 0)
    assert [(x[0], x[1], x[2].tolist()) for r in raws for x in tool.links(tool.encode([r]))] == want


def test_byte_table():
    table = A.byte_of_char()
    assert sorted(table.values()) == list(range(256)) and table["Ġ"] == 32 and table["a"] == 97
