"""SimHash near-duplicates: pigeonhole blocks, then Hamming distance.

A 64-bit fingerprint is cut into blocks. Fingerprints that differ in at most
``max_bits`` bits agree on all but ``max_bits`` blocks, so they share at least
one choice of the remaining ones: join on those, then verify the distance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_name, map_rows, plain_words, text_bytes
from .components import components

#: Rows of a block value that are compared in one piece; larger ones are cut
#: into chunks, and each pair of chunks is a piece of its own.
CHUNK = 512


def fingerprint(raw: bytes | None, shingle_words: int = 3) -> int:
    """SimHash of the word shingles (repeats included): a bit is 1 if it is set
    in over half of the shingles' XXH64 (seed 42). Fewer words than a shingle:
    the whole sequence is the shingle. No words: 0."""
    words = plain_words(raw)
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    k = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], 42) for a, b in zip(starts[:len(words) - k + 1].tolist(), (ends[k - 1:] - 1).tolist())]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp): one row per document, the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(x, shingle_words) for x in b.column(1).to_pylist()], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_bytes(docs, text).alias("raw"))
    return map_rows(src, run, "doc_id long, fp long")


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Signed 64-bit masks of every choice of ``blocks - max_bits`` blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(parts, blocks - max_bits)]


def _forest(group: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, representative) that connect, inside each group of a sorted
    batch, exactly what pairs within ``max_bits`` connect."""
    n, links = len(fp), []
    at = np.arange(n)
    for lag in range(1, n):
        at = at[at + lag < n]
        at = at[group[at] == group[at + lag]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= max_bits]
        links.append(np.stack([near, near + lag]))
    if not links:
        return fp[:0], fp[:0]
    a, b = np.concatenate(links, axis=1)
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            break
        label = low
    far = label != np.arange(n)
    return fp[far], fp[label[far]]


def _link_groups(max_bits: int):
    """Over rows sorted by (g, fp): the links of each group, streamed. Only the
    rows of the last open group are carried from batch to batch."""
    def run(batches):
        group, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(k: int):
            a, b = _forest(group[:k], fp[:k], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])
        for batch in batches:
            group = np.concatenate([group, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            k = int(np.searchsorted(group, group[-1])) if len(group) else 0
            if k > 20_000:
                yield out(k)
                group, fp = group[k:], fp[k:]
        if len(group):
            yield out(len(group))
    return run


def links(fps: DataFrame, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly those
    reachable over pairs within ``max_bits`` bits. ``fps``: one column, distinct.

    Every fingerprint goes to ``C(blocks, max_bits)`` block values. A value held
    by n of them is cut into ``ceil(n / CHUNK)`` chunks, and each pair of
    chunks is compared apart, so no task gets a hot value whole, and each
    piece returns a spanning forest, never all its pairs.
    """
    fp = F.col("fp")
    masks = block_masks(blocks, max_bits)
    keys = fps.select(fps.columns[0]).toDF("fp").select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("k"), fp.bitwiseAND(F.lit(m)).alias("v")) for i, m in enumerate(masks)])).alias("x")).select("fp", "x.k", "x.v")
    shared = keys.groupBy("k", "v").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    pieces = (keys.join(shared, ["k", "v"]).withColumn("c", chunks).withColumn("own", own)
              .select("k", "v", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other"))
              .select("fp", F.xxhash64("k", "v", F.least("own", "other"), F.greatest("own", "other")).alias("g")))
    # Two pieces with one hash only add comparisons: the distance is verified.
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.select("g", "fp").repartition(n, "g").sortWithinPartitions("g", "fp")
    fps.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return dealt.mapInArrow(_link_groups(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle_words: int = 3, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """(doc_id, fp, component_id): one row per document; component_id is the
    smallest doc_id reachable over links, itself included.

    Exact copies meet first: links run between distinct fingerprints, and a
    document finds its component through its fingerprint. Texts without words
    (NULL, empty, blank) have fingerprint 0 and link like any other. A NULL
    doc_id keeps its row and never names a component that has another id.
    Repeated rows stay repeated. Only id and text are read.
    """
    fps = cut(fingerprints(docs, text, doc_id, shingle_words), "simhash")
    per = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(per.select("fp"), max_bits, blocks))
    member = per.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = cut(member, "members")
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(lowest, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component,
    that with the smallest doc_id (NULLs last), of several the first as the rows were read.

    Ids need not be unique or present: the rows are written once with a number
    of their own, which the components and the final semi join run on, so
    only numbers, ids and fingerprints meet in joins beside that one. All columns, of any
    type and name, come out as they were."""
    row = fresh_name(docs, "row_number")
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    at, given = F.col(row), F.col(f"`{doc_id}`")
    near = near_duplicates(rows, text, row, **options).select(F.col("doc_id").alias("at"), "component_id")
    ids = rows.select(at.alias("at"), given.isNull().alias("absent"), given.alias("id"))
    first = near.join(ids, "at").groupBy("component_id").agg(F.min(F.struct("absent", "id", "at")).alias("x"))
    kept = first.select(F.col("x.at").alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
