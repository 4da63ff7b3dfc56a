"""Cross-tokenizer alignment over whitespace-token anchors.

A text is fully encoded by two tokenizers, a byte-level BPE (A) over
" " + text and a sentence-piece model (B) over text, which puts the space in
front itself. Both sequences then cover the same bytes. Where a space-marked
token of A and one of B start at the same byte, all tokens before end there
in both: such verified shared ends cut a document into short windows of token
ids. Words recur, so the alignment of a window is remembered by its id tuples
and computed once in a task. Inside a window one walk over both sequences gives
the links (pairs of tokens whose byte ranges overlap) and the groups (between
bytes where tokens of both sides end).

Counting an id pair over the whole corpus needs no row for each document and
pair: the documents of a task are put together in blocks, each block tells its
pairs once, and the counts come back block by block. So a pair that every
document holds is one row of each block, and nothing is broadcast.

Defined results: NULL and empty texts, texts that are not valid UTF-8, and
texts whose token bytes on either side differ from " " + text have no tokens.
NULL and repeated ids keep their rows. Other columns are not read by
``document_links``; ``align`` passes them on.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, fresh_name, map_rows, text_bytes

#: Links of the documents that one block holds (a longer document is a block).
BLOCK_LINKS = 4_000_000
#: Ids of the windows that a task remembers; beyond it the memory starts anew.
MEMO_IDS = 3_000_000
#: Fixed value: how the byte-level BPE cuts a text into words before it merges bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words go to the library that reads the vocabulary file itself if a character
#: lies beyond Latin, Greek and Cyrillic (the two libraries for A could class newer letters
#: differently; in UTF-8 these are the first bytes from 0xD4 on) or if they hold
#: 1,000 blanks (the faster one's pattern search overflows on very long runs).
_OLD = bytes(range(0xD4))
#: Single spaces between other characters, and spaces beside other white space.
SINGLE, BESIDE = re.compile(r"(?<=\S) (?=\S)"), re.compile(r" \s|\s ")
#: Characters of the words that a task remembers; beyond it the memory starts anew.
MEMO_CHARS = 4_000_000
#: Blocks are numbered (task, number within the task).
TASK_SHIFT = 24


@dataclass(frozen=True)
class Tokenizers:
    """Where the two vocabularies lie (on every executor)."""
    folder: str = "/opt/tokenizers"
    byte_level: str = "byte_bpe_50k.json"
    pieces: str = "piece_bpe_32k.model"


def byte_of_char() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: visible
    Latin-1 characters stand for themselves, all other bytes, in order, for the characters from U+0100 on."""
    visible = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """Bytes of each token id: their length, and whether they start with a space."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.spaced = np.array([t.startswith(b" ") for t in tokens])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.first = np.cumsum(self.length) - self.length

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.length[ids])

    def covers(self, ids: np.ndarray, raw: bytes) -> bool:
        """Whether the tokens' bytes, put together, are ``raw``."""
        n = self.length[ids]
        return int(n.sum()) == len(raw) and bool((self.bytes[_ranges(self.first[ids], n)] == np.frombuffer(raw, np.uint8)).all())


class Pool:
    """Short arrays by number, kept end to end."""

    def __init__(self):
        self.ids, self.size, self.start = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, parts: list) -> None:
        flat = parts if parts and isinstance(parts[0], np.ndarray) else [np.fromiter(chain.from_iterable(parts), np.int64)]
        self.ids = np.concatenate([self.ids, *flat])
        self.size = np.concatenate([self.size, np.array([len(x) for x in parts], dtype=np.int64)])
        self.start = np.cumsum(self.size) - self.size

    def take(self, no: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arrays of these numbers end to end, and their sizes."""
        return self.ids[_ranges(self.start[no], self.size[no])], self.size[no]


class Aligner:
    """Both tokenizers, and the remembered windows of a task."""

    def __init__(self, where: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        path = os.path.join(where.folder, where.byte_level)
        self.a_model = Tokenizer.from_file(path)
        self.a_model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        to_byte = byte_of_char()
        tokens = [b""] * self.a_model.get_vocab_size(with_added_tokens=True)
        for word, i in told["model"]["vocab"].items():
            tokens[i] = bytes(to_byte[c] for c in word) if all(c in to_byte for c in word) else word.encode()
        added = {x["id"] for x in told["added_tokens"]}
        ranks = {t: i for i, t in enumerate(tokens) if t and i not in added}
        self.a_fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for x in told["added_tokens"]:
            tokens[x["id"]] = x["content"].encode()
        self.a = Side(tokens)
        sp = self.b_model = sentencepiece.SentencePieceProcessor(model_file=os.path.join(where.folder, where.pieces))
        self.b = Side([bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
                       for i in range(sp.get_piece_size())])
        self.a_words = np.array([[f"{i}{sign}" for i in range(len(self.a.tokens))] for sign in ",|"], dtype=object)
        self.b_words = np.array([[f"{i}{sign}" for i in range(len(self.b.tokens))] for sign in ",;"], dtype=object)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_byte(i)]
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)
        self.word_no, self.chars, self.a_ids, self.b_ids = {}, 0, Pool(), Pool()
        self.forget()

    def words(self, text: str) -> list[str]:
        """A text cut at single spaces between other characters. No token of
        either side crosses such a space from the left, so the words' tokens in order are the text's."""
        if not self.by_word:
            return [text]
        return SINGLE.split(text) if " " in (text[0], text[-1]) or BESIDE.search(text) else text.split(" ")

    def _learn(self, words: list[str]) -> None:
        """Encode words not met before, each once."""
        a = []
        for w in words:
            raw = w.encode()
            plain = not raw.translate(None, _OLD) and (len(raw) < 1000 or _blank(raw) < 1000)
            a.append(self.a_fast.encode_ordinary(" " + w) if plain else self.a_model.encode(" " + w, add_special_tokens=False).ids)
        for pool, ids in zip((self.a_ids, self.b_ids), (a, self.b_model.encode(words, num_threads=1))):
            pool.add(ids)
        self.word_no.update(zip(words, range(len(self.word_no), len(self.word_no) + len(words))))
        self.chars += sum(map(len, words))

    def encode(self, raws: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides for each text, None where it has no tokens."""
        texts, at = [], []
        for i, raw in enumerate(raws):
            if raw:
                try:
                    texts.append(self.words(raw.decode()))
                    at.append(i)
                except UnicodeDecodeError:
                    pass
        out: list = [None] * len(raws)
        if not texts:
            return out
        if self.chars > MEMO_CHARS:
            self.word_no, self.chars, self.a_ids, self.b_ids = {}, 0, Pool(), Pool()
        known = self.word_no
        self._learn(list(dict.fromkeys([w for ws in texts for w in ws if w not in known])))
        no = np.array([known[w] for ws in texts for w in ws])
        of = np.cumsum([0, *map(len, texts)])
        whole, ids = [b" " + raws[i] for i in at], []
        for pool in (self.a_ids, self.b_ids):
            got, size = pool.take(no)
            ids.append(np.split(got, np.concatenate([[0], np.cumsum(size)])[of[1:-1]]))
        fine = all(side.covers(np.concatenate(x), b"".join(whole)) for side, x in zip((self.a, self.b), ids))
        for i, x, y, raw in zip(at, *ids, whole):
            if fine or self.a.covers(x, raw) and self.b.covers(y, raw):
                out[i] = (x, y)
        return out

    def anchors(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cuts of both sequences at verified shared ends before space-marked
        tokens (the first tokens are marked, so a text's start is one), then
        the sequences' ends."""
        a_at, b_at = np.flatnonzero(self.a.spaced[a]), np.flatnonzero(self.b.spaced[b])
        a_start, b_start = (self.a.ends(a) - self.a.length[a])[a_at], (self.b.ends(b) - self.b.length[b])[b_at]
        at = np.minimum(np.searchsorted(b_start, a_start), len(b_start) - 1)
        same = b_start[at] == a_start
        return np.append(a_at[same], len(a)), np.append(b_at[at[same]], len(b))

    def walk(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One walk over two sequences of the same bytes. Every byte where a
        token of either side ends closes one link: its A and B positions, and whether both end there (a group's end)."""
        end_a, end_b = self.a.ends(a), self.b.ends(b)
        ends = np.union1d(end_a, end_b)
        i, j = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        return i, j, (end_a[i] == ends) & (end_b[j] == ends)

    def _tell(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, bt: np.ndarray) -> list[tuple[str, int, np.ndarray]]:
        """(groups as text, their number, links as ``a << 32 | b``) of the
        windows that start at ``at`` and ``bt`` of two sequences."""
        i, j, shared = self.walk(a, b)
        links = a[i] << 32 | b[j]
        # ids in the order of the text: by group, A before B; each with the sign that follows it
        ends_a, ends_b = i[shared], j[shared]
        group_a, group_b = np.searchsorted(ends_a, np.arange(len(a))), np.searchsorted(ends_b, np.arange(len(b)))
        last_a, last_b = np.zeros(len(a), int), np.zeros(len(b), int)
        last_a[ends_a], last_b[ends_b] = 1, 1
        words = np.concatenate([self.a_words[last_a, a], self.b_words[last_b, b]])
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([group_a, group_b])))
        words = words[order].tolist()
        first_link = np.append(np.searchsorted(i, at), len(links)).tolist()
        first_group = np.append(group_a[at], len(ends_a)).tolist()
        first_word = np.append(at + bt, len(words)).tolist()
        return [("".join(words[w0:w1]), g1 - g0, links[l0:l1]) for w0, w1, g0, g1, l0, l1 in
                zip(first_word, first_word[1:], first_group, first_group[1:], first_link, first_link[1:])]

    def links(self, encoded: list[tuple[np.ndarray, np.ndarray] | None]) -> list[tuple[str, int, np.ndarray]]:
        """For each document its groups as text, their number, and all its links."""
        have = [x for x in encoded if x]
        if not have:
            return [("", 0, np.empty(0, np.int64))] * len(encoded)
        if self.held > MEMO_IDS:
            self.forget()
        a, b = (np.concatenate([x[k] for x in have]) for k in (0, 1))
        at, bt = self.anchors(a, b)
        first, same, keys = _distinct(a, b, at, bt)
        numbers, new = [], []
        for w, key in zip(first.tolist(), keys):
            n = self.memo.get(key)
            if n is None:
                n = self.memo[key] = len(self.told) + len(new)
                new.append(w)
            numbers.append(n)
        if new:
            at0, n_a, bt0, n_b = at[new], np.diff(at)[new], bt[new], np.diff(bt)[new]
            found = self._tell(a[_ranges(at0, n_a)], b[_ranges(bt0, n_b)], np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b)
            self.told += [f[0] for f in found]
            self.n_groups = np.concatenate([self.n_groups, [f[1] for f in found]])
            self.pool.add([f[2] for f in found])
            self.held += int(n_a.sum() + n_b.sum())
        number = np.array(numbers)[same]
        told, groups = [self.told[n] for n in number.tolist()], self.n_groups[number]
        links, n_links = self.pool.take(number)
        cuts = np.searchsorted(at, np.cumsum([0, *(len(x[0]) for x in have)]))
        link_cuts, group_cuts = (np.concatenate([[0], np.cumsum(x)])[cuts].tolist() for x in (n_links, groups))
        out = iter([("".join(told[w0:w1])[:-1], g1 - g0, links[l0:l1]) for w0, w1, g0, g1, l0, l1 in
                    zip(cuts.tolist(), cuts[1:].tolist(), group_cuts, group_cuts[1:], link_cuts, link_cuts[1:])])
        return [next(out) if x else ("", 0, np.empty(0, np.int64)) for x in encoded]

    def forget(self) -> None:
        self.memo: dict[bytes | tuple, int] = {}
        self.told: list[str] = []                       # by number: a window's groups, ...
        self.n_groups = np.empty(0, np.int64)           # ... how many they are, ...
        self.pool = Pool()                              # ... and its links
        self.held = 0


#: Ids of a window up to which equal windows of a batch are found together; longer ones are looked up one by one.
SHORT_IDS = 12
_ODD = np.random.default_rng(12).integers(1, 2**63, SHORT_IDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _distinct(a: np.ndarray, b: np.ndarray, at: np.ndarray, bt: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """One window of each kind in a batch, for every window which of those it
    equals, and the id tuple of each kind (a short one packed: the number of A ids, the ids, then -1)."""
    n_a, n_b = np.diff(at), np.diff(bt)
    short = np.flatnonzero(n_a + n_b <= SHORT_IDS)
    n = n_a[short], n_b[short]
    rows = np.full((len(short), SHORT_IDS + 1), -1, dtype=np.int64)
    rows[:, 0] = n[0]
    for ids, start, size, col in ((a, at, n[0], np.ones(len(short), int)), (b, bt, n[1], 1 + n[0])):
        rows[np.repeat(np.arange(len(short)), size), _ranges(col, size)] = ids[_ranges(start[short], size)]
    digest = (rows.view(np.uint64) * _ODD).sum(axis=1, dtype=np.uint64)
    same, _ = pd.factorize(digest)                       # numbered as they come
    first = np.flatnonzero(np.diff(np.maximum.accumulate(same), prepend=-1))
    if not (rows == rows[first[same]]).all():           # a digest that two kinds share
        _, first, same = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    long = np.flatnonzero(n_a + n_b > SHORT_IDS)
    of = np.empty(len(n_a), np.int64)
    of[short], of[long] = same.reshape(-1), len(first) + np.arange(len(long))
    packed = rows[first].astype("<i4").view(f"V{4 * (SHORT_IDS + 1)}").reshape(-1).tolist()
    keys = packed + [(tuple(a[at[w]:at[w + 1]].tolist()), tuple(b[bt[w]:bt[w + 1]].tolist())) for w in long.tolist()]
    return np.concatenate([short[first], long]), of, keys


def _blank(raw: bytes) -> int:
    return len(raw) - len(raw.translate(None, b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f ")) + raw.count(b"\xc2\x85") + raw.count(b"\xc2\xa0")


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), then those of start[1], and so on."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


@lru_cache(maxsize=2)
def aligner(where: Tokenizers) -> Aligner:
    """One per Python worker: the vocabularies load once, not for every task."""
    return Aligner(where)


GROUPS = "array<struct<a:array<int>,b:array<int>,end:bigint>>"


def align(docs: DataFrame, text: str = "text", where: Tokenizers = Tokenizers(), name: str = "groups") -> DataFrame:
    """All rows and columns of ``docs`` plus the groups of each text: A ids, B
    ids and the byte of " " + text where the group ends; an empty list for a text without
    tokens. The column gets underscores in front if ``docs`` has that name. No shuffle."""
    raw, out = fresh_name(docs, "utf8"), fresh_name(docs, name)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T._parse_datatype_string(GROUPS))])
    arrow = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("end", pa.int64())]))

    def run(batches):
        tool = aligner(where)
        for batch in batches:
            rows = []
            for ids in tool.encode(batch.column(raw).to_pylist()):
                row, end = [], 0
                for group in tool.links([ids])[0][0].split(";") if ids else ():
                    x, y = ([int(i) for i in side.split(",")] for side in group.split("|"))
                    end += int(tool.a.length[x].sum())
                    row.append({"a": x, "b": y, "end": end})
                rows.append(row)
            keep = [i for i, n in enumerate(batch.schema.names) if n != raw]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(rows, arrow)],
                                             names=[*(batch.schema.names[i] for i in keep), out])

    return map_rows(docs.withColumn(raw, text_bytes(docs, text)), run, schema)


PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = {"block": "long", "doc_id": "array<long>", **{c: "array<long>" for c in PER_DOC}, "sha": "array<string>", "first": "array<long>",
          "pair_no": "binary", "times": "binary", "pairs": "array<long>", "docs": "array<long>"}


def _one_block(number: int, ids: list, counts: list, shas: list, links: list) -> pa.RecordBatch:
    """Documents as a sparse matrix over the block's pairs, and how many of them hold each pair."""
    of = np.repeat(np.arange(len(links)), [len(x) for x in links])
    no, pairs = pd.factorize(np.concatenate(links))
    order = np.argsort(pairs)
    no, pairs = np.argsort(order)[no], pairs[order]
    cells, times = np.unique(of * max(len(pairs), 1) + no, return_counts=True)
    doc, no = np.divmod(cells, max(len(pairs), 1))
    first = np.searchsorted(doc, np.arange(len(links) + 1))
    held = np.bincount(no, minlength=len(pairs))
    value = lambda x, t: pa.array([x], t)
    longs = pa.list_(pa.int64())
    cols = [value(number, pa.int64()), value(ids, longs), *(value([c[k] for c in counts], longs) for k in range(len(PER_DOC))),
            value(shas, pa.list_(pa.string())), value(first, longs), value(no.astype("<i4").tobytes(), pa.binary()),
            value(times.astype("<i4").tobytes(), pa.binary()), value(pairs, longs), value(held, longs)]
    return pa.RecordBatch.from_arrays(cols, names=list(_BLOCK))


def link_blocks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", where: Tokenizers = Tokenizers(),
                block_links: int = BLOCK_LINKS) -> DataFrame:
    """Documents aligned where they are read, one row for each block of them;
    written once, so that the numbers of the blocks stay."""
    def run(batches):
        from pyspark import TaskContext
        tool, number = aligner(where), TaskContext.get().partitionId() << TASK_SHIFT
        ids, counts, shas, links, size = [], [], [], [], 0
        for batch in batches:
            encoded = tool.encode(batch.column(1).to_pylist())
            for i, found, (told, n, link) in zip(batch.column(0).to_pylist(), encoded, tool.links(encoded)):
                ids.append(i)
                counts.append((len(found[0]), len(found[1]), n, len(link)) if found else (0, 0, 0, 0))
                shas.append(sha256(told.encode()).hexdigest() if found else "")
                links.append(link)
                size += len(link)
                if size >= block_links:
                    yield _one_block(number, ids, counts, shas, links)
                    number, ids, counts, shas, links, size = number + 1, [], [], [], [], 0
        if ids:
            yield _one_block(number, ids, counts, shas, links)

    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_bytes(docs, text).alias("raw"))
    return cut(map_rows(src, run, ", ".join(f"{n} {t}" for n, t in _BLOCK.items())), "links")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs, best) of every linked id pair: how many documents
    hold it, and whether no other pair of its A id has more. An A id's pairs are at most B's vocabulary."""
    pair = F.col("pair")
    told = blocks.select(F.explode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("docs").alias("n"))).alias("x"))
    counts = told.groupBy(F.col("x.pair").alias("pair")).agg(F.sum("x.n").alias("n_docs"))
    counts = counts.select(F.shiftright(pair, 32).alias("a_id"), pair.bitwiseAND(0xFFFFFFFF).alias("b_id"), "n_docs")
    return counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a_id")))


def document_links(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", where: Tokenizers = Tokenizers(),
                   block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per document: doc_id, tokens, groups and links (n_a, n_b,
    n_groups, n_links), n_best (links whose pair is the most frequent of its A
    id, ties included), count_sum (n_docs summed over links), groups_sha256."""
    blocks = link_blocks(docs, text, doc_id, where, block_links)
    counts = link_counts(blocks).select(F.shiftleft("a_id", 32).bitwiseOR(F.col("b_id")).alias("pair"), "n_docs", "best")
    asked = blocks.select(F.col("block").alias("asks"), F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select("asks", "pair", "n_docs", "best")
    names = ["doc_id", *PER_DOC, "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names)

    def told(block: pa.Table, answer: pa.Table) -> pa.Table:
        order = np.argsort(answer.column("pair").to_numpy())          # as the block's pairs, which are sorted
        n_docs = answer.column("n_docs").to_numpy()[order]
        best = answer.column("best").to_numpy()[order]
        row = block.slice(0, 1)
        no, times = (np.frombuffer(row.column(c)[0].as_py(), dtype="<i4").astype(np.int64) for c in ("pair_no", "times"))
        first = row.column("first")[0].values.to_numpy()
        def total(x):
            run = np.concatenate([[0], np.cumsum(x * times)])
            return run[first[1:]] - run[first[:-1]]
        sums = [total(best[no].astype(np.int64)), total(n_docs[no])] if len(order) else [np.zeros(len(first) - 1, np.int64)] * 2
        listed = lambda c: row.column(c)[0].values
        return pa.table([listed("doc_id"), *(listed(c) for c in PER_DOC), *(pa.array(s, pa.int64()) for s in sums), listed("sha")], names=names)

    left = blocks.drop("pairs", "docs").groupBy("block")
    return left.cogroup(answers.groupBy("asks")).applyInArrow(told, schema)
