"""Document fingerprints of improbable features.

Byte windows are ranked by how rare their entropy is over all documents; the
rarest of each neighbourhood becomes a feature. Features go, in text order,
into a chain of Bloom filters, and two chains are compared by their bit
overlap beyond chance. A short text holds few long windows, so it is read in short
ones; texts about the border have both, short ones in filters of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_bytes

#: Fixed values of the digest: bytes of a window, neighbours on either side, entropy levels, and per filter its bits, features and hashes.
WINDOW, NEIGHBOURS, LEVELS = 64, 32, 1000
FILTER_BITS, FILTER_FEATURES, HASHES = 1024, 80, 5

#: Fixed values for short texts: bytes of a window, neighbours, and the border in bytes: texts below
#: twice the border are read in short windows, texts from the border on in long ones.
SHORT, SHORT_NEIGHBOURS, BORDER = 8, 2, 256

#: Texts are digested together up to about so many bytes; a longer text alone.
CHUNK_BYTES = 262_144

_GAIN = np.round(np.arange(WINDOW + 1) * np.log2(np.maximum(np.arange(WINDOW + 1), 1)) * 65_536).astype(np.int64)

#: Window sizes with their neighbours and the text lengths they are for (from, below).
SIZES = ((SHORT, SHORT_NEIGHBOURS, SHORT, 2 * BORDER), (WINDOW, NEIGHBOURS, BORDER, None))
_BASE = 0x9E3779B97F4A7C15 | 1


def window_levels(x: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Entropy level (0 .. LEVELS) of each window of ``size`` bytes (``WINDOW`` at most).

    Sum of c log c over the byte counts c of a window, in whole numbers and
    carried from window to window: a byte that enters meets the equal bytes
    before it, one that leaves the equal bytes after it.
    """
    before, after = np.zeros(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for d in range(1, min(size, len(x))):
        same = (x[d:] == x[:-d]).view(np.uint8)
        before[d:] += same
        after[:-d] += same
    step = np.diff(_GAIN)
    s = step[before]
    s[size:] -= step[after[:-size]]
    s = np.cumsum(s)[size - 1:]
    return ((_GAIN[size] - s) * LEVELS // _GAIN[size]).astype(np.int64)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        size = max(n, CHUNK_BYTES + 8_192)
        for name, b in (("up", _BASE), ("down", inverse)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)                    # modulo 2**64
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(x: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """A 64-bit hash of each window's bytes, the same wherever it stands."""
    up, down = _powers(len(x) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:len(x)])])
    return _mix((sums[size:] - sums[:-size]) * down[:len(x) - size + 1])


def _joined(texts: list[bytes], least: int, below: int | None) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Texts from ``least`` to less than ``below`` bytes, joined up to CHUNK_BYTES: their numbers, the bytes, the ends."""
    own: list[int] = []
    total = 0
    for i, t in enumerate(texts):
        if len(t) < least or (below is not None and len(t) >= below):
            continue
        if own and total + len(t) > CHUNK_BYTES:
            yield own, np.frombuffer(b"".join(texts[k] for k in own), np.uint8), np.cumsum([len(texts[k]) for k in own])
            own, total = [], 0
        own.append(i)
        total += len(t)
    if own:
        yield own, np.frombuffer(b"".join(texts[k] for k in own), np.uint8), np.cumsum([len(texts[k]) for k in own])


def _inside(n: int, ends: np.ndarray, size: int) -> np.ndarray:
    """Which windows lie in one text."""
    ok = np.ones(n - size + 1, bool)
    for e in ends[:-1]:
        ok[max(0, e - size + 1):e] = False
    return ok


def level_counts(docs: DataFrame, text: str = "text") -> dict[int, np.ndarray]:
    """By window size: windows of each entropy level over all documents read in that size."""
    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(0).to_pylist()]
            for size, _, least, below in SIZES:
                n = np.zeros(LEVELS + 1, np.int64)
                for _, x, ends in _joined(texts, least, below):
                    n += np.bincount(window_levels(x, size)[_inside(len(x), ends, size)], minlength=LEVELS + 1)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), size), pa.int64()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], names=["size", "level", "n"])
    out = {size: np.zeros(LEVELS + 1, np.int64) for size, *_ in SIZES}
    told = map_rows(docs.select(text_bytes(docs, text).alias("raw")), run, "size long, level long, n long")
    for r in told.groupBy("size", "level").agg(F.sum("n").alias("n")).collect():
        out[r["size"]][r["level"]] = r["n"]                  # LEVELS + 1 rows a size at most
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of each level, the rarest highest (1 ..); ties by level."""
    order = np.lexsort((np.arange(len(counts)), -counts))
    rank = np.empty(len(counts), np.uint64)
    rank[order] = np.arange(1, len(counts) + 1, dtype=np.uint64)
    return rank


def _spread(p: np.ndarray, near: int) -> np.ndarray:
    """Largest value among ``near`` neighbours on either side."""
    width, size = 2 * near + 1, 1
    m = np.concatenate([np.zeros(near, p.dtype), p, np.zeros(near, p.dtype)])
    while 2 * size <= width:
        m = np.maximum(m[:-size], m[size:])
        size *= 2
    return np.maximum(m[:len(p)], m[width - size:width - size + len(p)])


def _filters(features: np.ndarray) -> bytes:
    """Bloom filters of distinct features in text order, a new one every FILTER_FEATURES."""
    n = -(-len(features) // FILTER_FEATURES)
    bits = np.zeros((n, FILTER_BITS), np.uint8)
    row = np.arange(len(features)) // FILTER_FEATURES
    for k in range(HASHES):
        bits[row, (features >> np.uint64(10 * k)).astype(np.int64) % FILTER_BITS] = 1
    return np.packbits(bits, axis=1).tobytes()


def digests(texts: list[bytes], rank: np.ndarray, short_rank: np.ndarray | None = None) -> list[bytes]:
    """The chained filters of each text, those of short windows first. A text below a
    short window is one feature; an empty one has no filter. ``rank`` and
    ``short_rank`` are the rarity of the levels of long and short windows (default: alike)."""
    ranks = {WINDOW: rank, SHORT: np.ones(LEVELS + 1, np.uint64) if short_rank is None else short_rank}
    out = [_filters(np.array([xxhash.xxh64_intdigest(t)], np.uint64)) if 0 < len(t) < SHORT else b"" for t in texts]
    for size, near, least, below in SIZES:
        for own, x, ends in _joined(texts, least, below):
            h = window_hashes(x, size)
            p = (ranks[size][window_levels(x, size)] << np.uint64(48)) | (h >> np.uint64(16))
            p[~_inside(len(x), ends, size)] = 0
            at = np.flatnonzero((p == _spread(p, near)) & (p > 0))
            cuts = np.searchsorted(at, ends - size, side="right")
            for i, a, b in zip(own, np.concatenate([[0], cuts[:-1]]), cuts):
                f = h[at[a:b]]
                _, first = np.unique(f, return_index=True)
                out[i] += _filters(f[np.sort(first)])
    return out


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: each filter of the shorter chain meets its best partner in the
    other; overlap beyond chance, over the most that could be beyond it,
    weighted by set bits. For chains of one length the mean of both
    directions. Two empty chains are alike, one is not."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8).reshape(-1, FILTER_BITS // 8), axis=1).astype(np.float32) for v in sorted((a, b), key=len))
    nx, ny = x.sum(axis=1), y.sum(axis=1)
    chance = nx[:, None] * ny[None, :] / FILTER_BITS
    score = (x @ y.T - chance) / np.maximum(np.minimum(nx[:, None], ny[None, :]) - chance, 1.0)
    found = (score.max(axis=1) * nx).sum() / nx.sum()
    if len(a) == len(b):
        found = (found + (score.max(axis=0) * ny).sum() / ny.sum()) / 2
    return float(np.clip(found, 0.0, 1.0))


def in_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", pieces: int | None = None) -> DataFrame:
    """(piece, guest, doc_id, raw), dealt and sorted so that each document is
    followed by the next one in descending doc_id; after the last comes the
    first. Each piece ends with a guest, the first document of the next piece.

    Pieces are ranges of doc_id between approximate quantiles; the text is
    shuffled once. Equal ids are ordered by text; NULL ids come last, in pieces
    by hash of the text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = pieces or 4 * n
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(text_bytes(docs, text), F.lit(b"")).alias("raw"))
    cuts = src.agg(F.percentile_approx("doc_id", [i / pieces for i in range(1, pieces)], 20 * pieces).alias("q")).first()["q"] if pieces > 1 else None
    cuts = sorted(set(cuts or ()))

    def place(batches):
        edges = np.array(cuts, np.int64)
        for b in batches:
            ids = b.column(0)
            known = np.asarray(ids.is_valid())
            p = len(edges) - np.searchsorted(edges, np.nan_to_num(ids.fill_null(0).to_numpy(zero_copy_only=False)), side="left")
            for i in np.flatnonzero(~known):
                p[i] = len(edges) + 1 + xxhash.xxh64_intdigest(b.column(1)[int(i)].as_py()) % 64
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int64)), pa.array(np.zeros(len(p), np.int32)), ids, b.column(1)], names=["piece", "guest", "doc_id", "raw"])
    placed = map_rows(src, place, "piece long, guest int, doc_id long, raw binary")
    edge = F.col("doc_id")
    # The first row of each piece: a few rows, found by ids alone and by the text only among equal ids.
    ids = map_rows(src.withColumn("raw", F.when(edge.isNull(), F.col("raw")).otherwise(F.lit(b""))), place, "piece long, guest int, doc_id long, raw binary")
    firsts = {r["piece"]: r["top"] for r in ids.groupBy("piece").agg(F.max("doc_id").alias("top")).collect()}     # a row per piece
    if not firsts:
        return placed
    order = sorted(firsts)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    guest = [F.col("_to").alias("piece"), F.lit(1).cast("int").alias("guest"), "doc_id", "raw"]
    small = F.broadcast(spark.createDataFrame([(p, firsts[p], before[p]) for p in order], "_p long, _top long, _to long"))
    guests = src.join(small, F.col("doc_id") == F.col("_top")).groupBy("_to", "doc_id").agg(F.min("raw").alias("raw")).select(*guest)
    if None in firsts.values():
        nulls = map_rows(src.where(edge.isNull()), place, "piece long, guest int, doc_id long, raw binary")
        nulls = nulls.join(small, F.col("piece") == F.col("_p")).groupBy("_to", "doc_id").agg(F.min("raw").alias("raw")).select(*guest)
        guests = guests.unionByName(nulls)
    return placed.unionByName(guests).repartition(n, "piece").sortWithinPartitions("piece", "guest", F.col("doc_id").desc_nulls_last(), "raw")


def compare_in_order(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next): one row per document.

    The edited text has its last floor(n_chars / 3) code points replaced by as
    many from the start of the next document in descending doc_id (all, if
    that has fewer). Fingerprints are hex; equal texts have equal ones. NULL
    text is empty; an only document is its own next. Repeated rows stay.
    Entropy statistics cover all documents. Only id and text are read.
    """
    ranks = [rarity(n) for n in map(level_counts(docs, text).get, (WINDOW, SHORT))]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(rows, ahead):
        """Rows (piece, guest, doc_id, raw) in order; ``ahead``: digest of the first, if known."""
        edited = []
        for (p, _, _, raw), (q, _, _, following) in zip(rows, rows[1:]):
            t = raw.decode("utf-8", "replace")
            k = len(t) // 3
            edited.append((t[:len(t) - k] + following.decode("utf-8", "replace")[:k]).encode("utf-8", "replace") if p == q else b"")
        own = ([ahead] if ahead is not None else []) + digests([r[3] for r in rows[ahead is not None:]], *ranks)
        changed = digests(edited, *ranks)
        out = [(r[2], len(r[3].decode("utf-8", "replace")), hashlib.sha256(e).hexdigest(), own[i].hex(), changed[i].hex(), likeness(own[i], changed[i]), likeness(own[i], own[i + 1]))
               for i, (r, e) in enumerate(zip(rows, edited)) if not r[1]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], names=names), own[-1]

    def run(batches):
        rows, size, ahead = [], 0, None
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                rows.append(r)
                size += len(r[3])
                if size > 2 * CHUNK_BYTES and len(rows) > 1:
                    out, ahead = finish(rows, ahead)
                    yield out
                    rows, size = rows[-1:], 0
        if len(rows) > 1:
            yield finish(rows, ahead)[0]
    return map_rows(in_order(docs, text, doc_id), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
