"""Language model scoring by masked pseudo-likelihood.

A bidirectional window network predicts each token from the tokens on both
sides of it; a document's score is the sum of the log-probabilities of its
tokens, each given all others in its window. The network's vocabulary grows
with the corpus; a word outside it is predicted as its ending's class, times
the word's share of all such words by the counts of the corpus.

The network is trained in numpy inside Spark tasks: each task takes one pass
over its documents from the shared weights, and the weights of all tasks are
averaged by their tokens. Every document is in exactly one round.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, cut, fresh_name, map_rows, text_bytes

#: Tokens on either side, width, and the least two-level softmax: CLASSES of MEMBERS tokens each.
#: A network of k classes has k members in each; k grows with the vocabulary.
SIDE, WIDTH, CLASSES, MEMBERS = 2, 16, 32, 32
TOKENS = CLASSES * MEMBERS

#: The last ids stand for words outside the vocabulary, by their ending.
ENDINGS = 64

#: What a word's share adds to each count; one more type of each ending stands for unseen words.
SMOOTH = 0.5

#: Words outside the vocabulary whose shares are sent to every task; those of all others are joined.
NEAR = 100_000

#: Different words that a counting task holds before it hands them on.
HELD_WORDS = 300_000

#: Tokens that one training step sees, and the slices in which tasks hand over their weights.
STEP_TOKENS, SLICES = 16_384, 16


def _shapes(k: int):
    return (("embed", (2 * SIDE, k * k + 1, WIDTH)), ("bias", (WIDTH,)), ("cls", (WIDTH, k)), ("cls_bias", (k,)),
            ("mem", (k, WIDTH, k)), ("mem_bias", (k, k)))


def _weights(k: int) -> int:
    return sum(math.prod(s) for _, s in _shapes(k))


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    k = round(math.sqrt(len(flat) / ((2 * SIDE + 1) * WIDTH + 1)))
    while _weights(k) > len(flat):
        k -= 1
    out, at = {}, 0
    for name, shape in _shapes(k):
        n = math.prod(shape)
        out[name] = flat[at:at + n].reshape(shape)
        at += n
    return out


def initial(seed: int = 42, k: int = CLASSES) -> np.ndarray:
    flat = np.zeros(_weights(k), np.float32)
    w, rng = unpack(flat), np.random.default_rng(seed)
    for name in ("embed", "cls", "mem"):
        w[name][...] = rng.normal(0, 0.1, w[name].shape)
    return flat


class Words:
    """Ids of words: those of the vocabulary, and of frequent words outside it
    the id of their ending with their log share, looked up once for each token."""

    def __init__(self, ids: dict[bytes, int], near: dict[bytes, float], k: int):
        self.pad, self.first_ending = k * k, k * k - ENDINGS
        self.number = dict(zip([*ids, *near], range(len(ids) + len(near))))
        self.id = np.array([*ids.values(), *(self.first_ending + ending(w) for w in near)], dtype=np.int32)
        self.share = np.array([0.0] * len(ids) + list(near.values()))

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
        """Ids of all texts with SIDE pads around each; of each text the number
        of tokens, the sum of its words' log shares, and its words that are neither in the vocabulary nor among the frequent ones."""
        get, numbers, sizes, far = self.number.get, [], [], []
        for t in texts:
            words = alnum_words(t)
            found = [get(w, -1) for w in words]
            sizes.append(len(words))
            numbers += found
            far.append([w for w, n in zip(words, found) if n < 0] if -1 in found else [])
        sizes, number = np.array(sizes, np.int64), np.array(numbers, np.int64)
        unknown = number < 0
        ids, share = (np.append(x, 0)[number] for x in (self.id, self.share))
        ids[unknown] = [self.first_ending + ending(w) for words in far for w in words]
        starts = np.cumsum(sizes + SIDE) - sizes
        stream = np.full(int(sizes.sum()) + SIDE * (len(sizes) + 1), self.pad, np.int32)
        stream[np.arange(len(ids)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)] = ids
        sums = np.concatenate([[0.0], np.cumsum(share)])
        ends = np.cumsum(sizes)
        return stream, sizes, sums[ends] - sums[ends - sizes], far


def encode(texts: list[bytes | None], ids: dict[bytes, int], k: int = CLASSES) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts with SIDE pads (id k * k) around each, and the number of tokens of each."""
    return Words(ids, {}, k).encode(texts)[:2]


def _context(stream: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.stack([stream.take(at + o) for o in (*range(-SIDE, 0), *range(1, SIDE + 1))])


def _softmax(z: np.ndarray) -> np.ndarray:
    z -= z.max(axis=-1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=-1, keepdims=True)
    return z


def _logits(w: dict, stream: np.ndarray, at: np.ndarray):
    """For the tokens at ``at``, sorted by class: contexts, hidden states, class and member logits, classes and where each begins."""
    ctx = _context(stream, at)
    h = w["bias"] + w["embed"][0].take(ctx[0], axis=0)
    for o in range(1, 2 * SIDE):
        h += w["embed"][o].take(ctx[o], axis=0)
    np.tanh(h, out=h)
    pc = h @ w["cls"] + w["cls_bias"]
    k = w["cls"].shape[1]
    c = stream[at] // k
    edges = np.searchsorted(c, np.arange(k + 1))
    pm = np.empty((len(at), k), np.float32)
    for k in np.flatnonzero(np.diff(edges)):
        s = slice(edges[k], edges[k + 1])
        np.matmul(h[s], w["mem"][k], out=pm[s])
        pm[s] += w["mem_bias"][k]
    return ctx, h, pc, pm, c, edges


def forward(w: dict, stream: np.ndarray, at: np.ndarray):
    """As ``_logits``, with class and member probabilities."""
    ctx, h, pc, pm, c, edges = _logits(w, stream, at)
    return ctx, h, _softmax(pc), _softmax(pm), c, edges


def _log_softmax_at(z: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Log-probability of entry k of each row; at least log(1e-12)."""
    z -= z.max(axis=1, keepdims=True)
    told = z[np.arange(len(z)), k]
    np.exp(z, out=z)
    return np.maximum(told - np.log(z.sum(axis=1)), np.float32(math.log(1e-12)))


def _steps(stream: np.ndarray, k: int):
    at = np.flatnonzero(stream != k * k)
    for i in range(0, len(at), STEP_TOKENS):
        part = at[i:i + STEP_TOKENS]
        yield part[_order(stream[part] // k, k)]


def _order(x: np.ndarray, most: int) -> np.ndarray:
    """A stable order; small numbers are sorted by their digits."""
    return np.argsort(x.astype(np.uint16) if most < 2 ** 16 else x, kind="stable")


def log_probabilities(w: dict, stream: np.ndarray) -> np.ndarray:
    """Of each position of the stream its token's log-probability given both sides (pads: 0)."""
    out, k = np.zeros(len(stream)), w["cls"].shape[1]
    for at in _steps(stream, k):
        _, _, pc, pm, c, _ = _logits(w, stream, at)
        out[at] = _log_softmax_at(pc, c).astype(float) + _log_softmax_at(pm, stream[at] % k)
    return out


def train(flat: np.ndarray, squares: np.ndarray, stream: np.ndarray, rate: float = 0.1) -> int:
    """One pass of Adagrad steps over the stream, in place; returns the tokens seen."""
    w, g2, seen = unpack(flat), unpack(squares), 0
    size = w["cls"].shape[1]

    def move(name, k, g):
        g2[name][k] += g * g
        w[name][k] -= rate * g / (np.sqrt(g2[name][k]) + 1e-6)
    for at in _steps(stream, size):
        ctx, h, pc, pm, c, edges = forward(w, stream, at)
        n, rows = len(at), np.arange(len(at))
        pc[rows, c] -= 1
        pm[rows, stream[at] % size] -= 1
        gh = pc @ w["cls"].T
        for k in np.flatnonzero(np.diff(edges)):
            s = slice(edges[k], edges[k + 1])
            gh[s] += pm[s] @ w["mem"][k].T
            move("mem", k, h[s].T @ pm[s] / n)
            move("mem_bias", k, pm[s].sum(axis=0) / n)
        move("cls", ..., h.T @ pc / n)
        move("cls_bias", ..., pc.sum(axis=0) / n)
        gh *= (1 - h * h) / n
        move("bias", ..., gh.sum(axis=0))
        for o in range(2 * SIDE):
            order = _order(ctx[o], size * size)
            ids = ctx[o].take(order)
            first = np.flatnonzero(np.diff(ids, prepend=-1))
            move("embed", (o, ids[first]), np.add.reduceat(gh.take(order, axis=0), first, axis=0))
        seen += n
    return seen


@dataclass(frozen=True)
class WindowModel:
    """The network, and of the words outside its vocabulary: tokens and types by
    ending, log shares of the most frequent, and the counts of the others."""
    ids: dict[bytes, int]
    flat: np.ndarray
    tokens: list[int]
    types: list[int]
    near: dict[bytes, float]
    far: DataFrame

    @property
    def size(self) -> int:
        return unpack(self.flat)["cls"].shape[1]


def ending(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % ENDINGS


def ending_of(word: str) -> Column:
    """``ending`` as a column expression."""
    return F.pmod(F.crc32(F.substring(word, F.greatest(F.length(word) - 1, F.lit(1)), F.lit(2))), F.lit(ENDINGS)).cast("int")


def log_share(n: int, tokens: int, types: int) -> float:
    """Of a word counted ``n`` times among the outside words of its ending (0: unseen)."""
    return math.log((n + SMOOTH) / (tokens + SMOOTH * (types + 1)))


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(w, n): every word of all documents and its count, added up in the tasks first."""
    def told(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())], names=["w", "n"])

    def run(batches):
        n = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                n.update(alnum_words(t))
            if len(n) > HELD_WORDS:
                yield told(n)
                n = Counter()
        yield told(n)
    counts = map_rows(docs.select(text_bytes(docs, text).alias("raw")), run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))
    return cut(counts, "words")


def _least_count(of_count: list[tuple[int, int]], room: int) -> tuple[int, int, int]:
    """(least, edge, left): the smallest count from which on at most ``room``
    words are counted, the next smaller count (0: none) and the room left; ``of_count``: (count, words) by falling count."""
    least = of_count[0][0] + 1 if of_count else 1
    for n, words in of_count:
        if words > room:
            return least, n, room
        room -= words
        least = n
    return least, 0, room


def vocabulary(counts: DataFrame) -> WindowModel:
    """Untrained model of a corpus of the given word counts. The vocabulary are
    the most frequent words, as many as about a third of the tokens' square root
    (960 words at least), of words with one count the first by their bytes; ids by falling count, then word."""
    spark = counts.sparkSession
    of_count = [(r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).collect()]   # n values need n * n / 2 tokens
    room = max(TOKENS - ENDINGS, math.isqrt(sum(n * words for n, words in of_count)) // 3)
    (least, edge, left), (low, _, _) = _least_count(of_count, room), _least_count(of_count, room + NEAR)
    top = sorted(((r["n"], bytes(r["w"])) for r in counts.where(F.col("n") >= low).toLocalIterator()), key=lambda x: (-x[0], x[1]))
    tied = [bytes(r["w"]) for r in counts.where(F.col("n") == edge).orderBy("w").limit(left).collect()] if edge and left else []
    ids = {w: i for i, w in enumerate([*(w for n, w in top if n >= least), *tied])}
    tokens, types = [0] * ENDINGS, [0] * ENDINGS
    for r in counts.where(F.col("n") < least).groupBy(ending_of("w").alias("e")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tokens[r["e"]], types[r["e"]] = r["n"], r["words"]
    for w in tied:
        tokens[ending(w)] -= edge
        types[ending(w)] -= 1
    near = {w: log_share(n, tokens[ending(w)], types[ending(w)]) for n, w in top if w not in ids}
    k = max(CLASSES, math.isqrt(len(ids) + ENDINGS - 1) + 1)
    return WindowModel(ids, initial(k=k), tokens, types, near, counts.where(F.col("n") < low))


def _average(spark, parts: DataFrame) -> np.ndarray | None:
    """Mean of the tasks' weights by tokens seen; slices meet in 16 buckets each
    before the driver adds up 16 x SLICES rows, however many tasks there were."""
    def run(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for bucket, part, n, raw in zip(*(c.to_pylist() for c in b.columns)):
                x = np.concatenate([np.frombuffer(raw, np.float32).astype(np.float64) * n, [n]])
                sums[bucket, part] = sums[bucket, part] + x if (bucket, part) in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([k[1] for k in sums], pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["part", "sum"])
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = map_rows(parts.repartition(n, "bucket", "part"), run, "part long, sum binary").collect()
    if not rows:
        return None
    total = {}
    for r in sorted(rows, key=lambda r: (r["part"], bytes(r["sum"]))):
        total[r["part"]] = total.get(r["part"], 0) + np.frombuffer(bytes(r["sum"]), np.float64)
    return np.concatenate([total[k][:-1] / total[k][-1] for k in sorted(total)]).astype(np.float32)


def fit(docs: DataFrame, text: str = "text", rounds: int = 3, seed: int = 42) -> WindowModel:
    """Vocabulary and network from all documents. Round r trains on the documents
    whose text hash falls to r, from the averaged weights of the round before."""
    spark = docs.sparkSession
    model = vocabulary(word_counts(docs, text))
    ids, k = model.ids, model.size
    flat = initial(seed, k)
    src = docs.select(text_bytes(docs, text).alias("raw")).where(F.col("raw").isNotNull())
    for r in range(rounds):
        shared = spark.sparkContext.broadcast((ids, model.near, flat))

        def run(batches, shared=shared):
            from pyspark import TaskContext
            ids, near, start = shared.value
            words = Words(ids, near, k)
            w, squares, seen, held = start.copy(), np.zeros_like(start), 0, []
            size = 0
            for b in batches:
                for t in b.column(0).to_pylist():
                    held.append(t)
                    size += len(t)
                    if size > 8 * STEP_TOKENS:
                        seen += train(w, squares, words.encode(held)[0])
                        held, size = [], 0
            seen += train(w, squares, words.encode(held)[0])
            if seen:
                pieces = np.array_split(w, SLICES)
                pid = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([pid % 16] * SLICES, pa.int64()), pa.array(range(SLICES), pa.int64()), pa.array([seen] * SLICES, pa.int64()), pa.array([p.tobytes() for p in pieces], pa.binary())],
                                                 names=["bucket", "part", "n", "raw"])
        mine = F.pmod(F.xxhash64(F.lit(seed), "raw"), F.lit(rounds)) == r
        parts = cut(map_rows(src.where(mine), run, "bucket long, part long, n long, raw binary"), "weights")
        new = _average(spark, parts)
        flat = flat if new is None else new
    return replace(model, flat=flat)


def score(docs: DataFrame, model: WindowModel, text: str = "text",
          names: tuple[str, str, str] = ("n_tokens", "log_likelihood", "mean_log_likelihood")) -> DataFrame:
    """``docs`` plus tokens, summed log-probability and its mean per token.

    Whole texts are scored. NULL, empty and wordless texts have 0 tokens, sum
    0.0 and mean NULL. Rows are scored one by one; other columns pass through, and
    an output whose name one of them has gets underscores in front.

    The shares of words beyond the most frequent are joined by word (each is
    rare, so no word is hot) and added up by the text's digest; copies of a
    text bring the same words and are averaged.
    """
    names = tuple(fresh_name(docs, n) for n in names)
    shared = docs.sparkSession.sparkContext.broadcast((model.ids, model.flat, model.near))
    k = model.size

    def run(batches):
        ids, flat, near = shared.value
        w, words = unpack(flat), Words(ids, near, k)
        for b in batches:
            stream, sizes, shares, far = words.encode(b.column("raw").to_pylist())
            sums = np.concatenate([[0.0], np.cumsum(log_probabilities(w, stream))])
            ends = np.cumsum(sizes + SIDE) + SIDE            # a text ends before the pads that follow it
            totals = sums[ends - SIDE] - sums[ends - SIDE - sizes] + shares
            yield pa.RecordBatch.from_arrays([b.column("text_key"), pa.array(sizes, pa.int64()), pa.array(totals, pa.float64()), pa.array(far, pa.list_(pa.binary()))], names=["text_key", "n", "ll", "far"])
    raw = text_bytes(docs, text)
    src = docs.select(F.unhex(F.md5(raw)).alias("text_key"), raw.alias("raw")).where(F.col("raw").isNotNull())
    told = cut(map_rows(src, run, "text_key binary, n long, ll double, far array<binary>"), "scored")
    words = told.select("text_key", F.size("far").alias("size"), F.explode("far").alias("w"))
    e = ending_of("w") + 1
    total = F.element_at(F.array(*[F.lit(float(n + SMOOTH * (m + 1))) for n, m in zip(model.tokens, model.types)]), e)
    share = F.log((F.coalesce("n", F.lit(0)) + SMOOTH) / total)
    rest = words.join(model.far, "w", "left").groupBy("text_key").agg((F.sum(share) * F.first("size") / F.count("*")).alias("rest"))
    texts = told.groupBy("text_key").agg(F.first("n").alias("n"), F.first("ll").alias("ll")).join(rest, "text_key", "left")
    key, c = fresh_name(docs, "text_key"), [fresh_name(docs, x) for x in ("_n", "_ll")]
    texts = texts.select(F.col("text_key").alias(key), F.col("n").alias(c[0]), (F.col("ll") + F.coalesce("rest", F.lit(0.0))).alias(c[1]))
    n, ll = F.coalesce(c[0], F.lit(0)), F.coalesce(c[1], F.lit(0.0))
    out = docs.withColumn(key, F.unhex(F.md5(raw))).join(texts, key, "left")
    return out.select(*[F.col(f"`{x}`") for x in docs.columns], n.alias(names[0]), ll.alias(names[1]), F.when(n > 0, ll / n).alias(names[2]))
