"""Benchmark decontamination by a prefix-filtered set join.

Benchmark items are cut into windows of consecutive words. A window can only
occur in a document that holds all its shingles, so joining on one of them
(the necessary prefix of an exact containment) loses nothing; the rarest is
taken, by counts over all documents. Candidates pass positional and length
bounds and are verified word for word.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import alnum_words, annotate, cut, fresh_name, map_rows, text_bytes

WINDOW_WORDS = 13
SHINGLE_WORDS = 3

#: Windows that one broadcast index holds (some tens of MB). More windows are
#: taken in further blocks, each against all documents.
BLOCK_WINDOWS = 200_000


def windows(items: DataFrame, text: str = "text", item_id: str = "item_id", window_words: int = WINDOW_WORDS) -> DataFrame:
    """Distinct (window, item_id): windows of consecutive words, space-joined;
    an item of fewer words, but not none, is one window."""
    def run(batches):
        for b in batches:
            ids, out = [], []
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = alnum_words(raw)
                for k in range(max(len(w) - window_words, 0) + 1 if w else 0):
                    ids.append(i), out.append(b" ".join(w[k:k + window_words]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(ids, pa.string())], names=["window", "item_id"])
    src = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), text_bytes(items, text).alias("raw"))
    return map_rows(src, run, "window binary, item_id string").distinct()


def _shingles(window: bytes, k: int) -> list[bytes]:
    w = window.split(b" ")
    k = min(k, len(w))
    return [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)]


def _occurring(words: list[bytes], first: dict[bytes, list[int]], known) -> list[tuple[int, bytes]]:
    """(position, shingle) of the known shingles; ``first``: their first words, with the lengths to try."""
    out = []
    for i in [i for i, w in enumerate(words) if w in first]:
        for k in first[words[i]]:
            s = b" ".join(words[i:i + k])
            if s in known and i + k <= len(words):
                out.append((i, s))
    return out


def _first_words(shingles) -> dict[bytes, list[int]]:
    out: dict[bytes, set[int]] = defaultdict(set)
    for s in shingles:
        w = s.split(b" ")
        out[w[0]].add(len(w))
    return {k: sorted(v) for k, v in out.items()}


def _rarity(docs: DataFrame, text: str, block: list[Row]) -> dict[bytes, int]:
    """Occurrences of the block's shingles over all documents."""
    known = frozenset(s for r in block for s in _shingles(bytes(r["window"]), SHINGLE_WORDS))
    shared = docs.sparkSession.sparkContext.broadcast((known, _first_words(known)))

    def run(batches):
        known, first = shared.value
        for b in batches:
            n = Counter()
            for raw in b.column(0).to_pylist():
                n.update(s for _, s in _occurring(alnum_words(raw), first, known))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["s", "n"])
    rows = map_rows(docs.select(text_bytes(docs, text).alias("raw")), run, "s binary, n long").groupBy("s").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["s"]): r["n"] for r in rows}             # shingles of one block at most


def _index(block: list[Row], count: dict[bytes, int]) -> dict:
    """prefix shingle -> (offset, words) -> window -> items. Windows with a
    shingle that no document holds cannot occur and are left out."""
    out: dict = {}
    for r in block:
        window = bytes(r["window"])
        s = _shingles(window, SHINGLE_WORDS)
        if all(x in count for x in s):
            rare = min(s, key=lambda x: (count[x], x))
            out.setdefault(rare, {}).setdefault((s.index(rare), len(window.split(b" "))), {})[window] = tuple(r["items"])
    return out


def match(words: list[bytes], index: dict, first: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Verified occurrences as (start, end) word ranges, and their items."""
    ranges, items, n = [], set(), len(words)
    for i, s in _occurring(words, first, index):
        for (offset, size), held in index[s].items():
            a = i - offset
            if a < 0 or a + size > n:                        # positional and length bounds
                continue
            found = held.get(b" ".join(words[a:a + size]))
            if found is not None:
                ranges.append((a, a + size))
                items.update(x for x in found if x is not None)
    return ranges, items


def _hit_words(ranges) -> int:
    n = end = 0
    for a, b in sorted(ranges):
        n += max(0, b - max(a, end))
        end = max(end, b)
    return n


_RANGES = "array<struct<a:long,b:long>>"


def _verdict(n_words: int, ranges, items) -> tuple:
    hit = _hit_words(ranges)
    return (n_words, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0 and 20 * hit >= n_words)


_OUT = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType())]


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
                  block_windows: int = BLOCK_WINDOWS, names: tuple[str, ...] = tuple(n for n, _ in _OUT)) -> DataFrame:
    """``docs`` plus n_words, n_hit (words inside any occurrence of a window),
    n_items, items_sha256 (item ids as strings, sorted, comma-joined) and
    contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    Whole texts are read. NULL or wordless texts have no words and are clean;
    NULL or wordless items have no window. A NULL item id marks words but is
    not listed; rows that repeat an item id count as one item. Documents are
    judged row by row and other columns pass through (those named like an
    output of ``names`` are replaced). With several blocks of windows each block runs
    against all documents, and the hits of a text are joined by its digest.
    """
    outputs = [(n, t) for n, (_, t) in zip(names, _OUT, strict=True)]
    docs = docs.drop(*names)
    spark = docs.sparkSession
    table = cut(windows(items, item_text, item_id).groupBy("window").agg(F.collect_list("item_id").alias("items")), "windows")
    n_blocks = max(1, -(-table.count() // block_windows))
    part = F.pmod(F.xxhash64("window"), F.lit(n_blocks))
    hits = None
    for k in range(n_blocks):
        block = (table.where(part == k) if n_blocks > 1 else table).collect()     # about block_windows rows
        index = _index(block, _rarity(docs, text, block) if block else {})
        shared = spark.sparkContext.broadcast((index, _first_words(index)))
        if n_blocks == 1:
            def make(shared=shared):
                index, first = shared.value

                def judge(raw):
                    words = alnum_words(raw)
                    return _verdict(len(words), *match(words, index, first))
                return judge
            return annotate(docs, text, make, outputs)

        def run(batches, shared=shared):
            index, first = shared.value
            for b in batches:
                out = []
                for raw in b.column(0).to_pylist():
                    ranges, found = match(alnum_words(raw), index, first)
                    if ranges:
                        out.append({"digest": hashlib.sha256(raw).digest(), "ranges": [{"a": x, "b": y} for x, y in sorted(set(ranges))], "items": sorted(found)})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("digest", pa.binary()), ("ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string()))]))
        # Rows with one text have one result: one row per digest and block.
        found = cut(map_rows(docs.select(text_bytes(docs, text).alias("raw")), run, f"digest binary, ranges {_RANGES}, items array<string>")
                    .dropDuplicates(["digest"]), "hits")
        hits = found if hits is None else hits.unionByName(found)

    def merge(batches):
        for b in batches:
            out = [_verdict(0, [(x["a"], x["b"]) for x in r or ()], set(i or ())) for r, i in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.string())],
                                             names=["_digest", "_hit", "_items", "_sha"])
    per = hits.groupBy("digest").agg(F.flatten(F.collect_list("ranges")).alias("ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    per = map_rows(per, merge, "_digest binary, _hit long, _items long, _sha string")
    key, size = fresh_name(docs, "digest"), fresh_name(docs, "words")

    def facts():
        return lambda raw: (hashlib.sha256(raw or b"").digest(), len(alnum_words(raw)))
    base = annotate(docs, text, facts, [(key, T.BinaryType()), (size, T.LongType())])
    own = {c: fresh_name(base, c) for c in per.columns}
    per = per.withColumnsRenamed(own)
    empty, of = hashlib.sha256(b"").hexdigest(), lambda c: F.col(own[c])
    hit = F.coalesce(of("_hit"), F.lit(0)).cast("long")
    values = (F.col(size), hit, F.coalesce(of("_items"), F.lit(0)).cast("long"), F.coalesce(of("_sha"), F.lit(empty)), (hit > 0) & (20 * hit >= F.col(size)))
    return base.join(per, F.col(key) == of("_digest"), "left").select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(n) for v, n in zip(values, names)])
