"""Reply trees as chat transcripts.

Messages point at their parents. Self-joins that double the reach of each
pointer enumerate the root-to-leaf paths, branches are ranked by score, and
each chosen path is formatted as one conversation with a loss mask over the
assistant's texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_rows

#: The control strings of the template.
START, MIDDLE, END = "<s>[INST]", "[/INST]", "</s>"
_CONTROL = r"(?=/?s>|/?INST\])"
_ESCAPE, _UNESCAPE = re.compile(r"([<\[])(\\*)" + _CONTROL), re.compile(r"([<\[])(\\*)\\" + _CONTROL)
_TURN = re.compile(re.escape(START) + r"(.*?)" + re.escape(MIDDLE) + r"(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    """No control string remains: each gets one backslash more after its first character."""
    return _ESCAPE.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


@dataclass(frozen=True)
class Formatted:
    text: str
    loss: list[tuple[int, int]]      # code point ranges of the trained texts


def render(turns: list[tuple[str | None, str | None]], trained: str = "assistant") -> Formatted:
    """Turns (role, text) as one string: start, role, middle, text, end for each.
    NULL roles and texts are empty. The loss mask covers the trained role's texts."""
    out, at, loss = [], 0, []
    for role, text in turns:
        head, body = START + escape(role or "") + MIDDLE, escape(text or "")
        if role == trained:
            loss.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return Formatted("".join(out), loss)


def read_back(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _TURN.findall(text)]


def under_mask(text: str, loss: list[tuple[int, int]]) -> str:
    return "".join(unescape(text[a:b]) for a, b in loss)


def chain(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Rows of plain conversations as chains: adds ``node`` (1, 2, ... in
    ``order``) and ``parent`` (the row before, NULL for the first)."""
    w = Window.partitionBy(tree).orderBy(*order)
    return rows.withColumn("node", F.row_number().over(w).cast("long")).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def _reach(step: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables (mid, anc, total): the ancestor 1, 2, 4, ... steps up, as far as any
    goes, with the scores summed from the message to just before it; and those with as
    many steps above them as there are links, which only messages on or below a cycle have."""
    out, links, up = [], step.count(), step
    while up.limit(1).count():
        if 2 ** len(out) > links:
            return out, up
        out.append(up)
        up = cut(up.alias("a").join(up.alias("b"), F.col("a.anc") == F.col("b.mid"))
                 .select("a.mid", "b.anc", (F.col("a.total") + F.col("b.total")).alias("total")), "reach")
    return out, None


def paths(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", score: str | None = None, best: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, score, depth, mid) and the message columns: one row for
    each message on each chosen root-to-leaf path; depth 0 is the root.

    Branches of a tree rank by the mean score of their messages (NULL: 0),
    then by the leaf's id and content; the ``best`` first are chosen (None: all). A parent that
    is NULL or that no message has makes a root. Messages with a NULL id
    cannot be replied to; of messages that share an id replies hang on one
    chosen by content, so the order of the rows does not matter. Trees may be NULL (a tree of
    its own). Messages on or below a cycle have no root and thus no path.

    Pointer doubling: log2(depth) self-joins on single message ids, whose pointers carry
    the sums of scores. Each leaf climbs to its root in as many joins and is ranked
    by the sum, one row a leaf; only the chosen leaves are walked, in as many joins again, and
    each of their paths gains its rows once. A message that very many
    leaves hang on is a frequent key of the climb, which AQE splits.
    """
    content = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in messages.columns])))
    m = messages.withColumn("mid", F.monotonically_increasing_id()).withColumn("_c", content)
    m = m.withColumn("_s", F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0))
    m = cut(m, "messages")
    key = F.coalesce(F.concat(F.lit("t"), F.col(tree).cast("string")), F.lit("n"))
    ids = m.select("mid", "_c", "_s", key.alias("t"), F.col(node).alias("n"), F.col(parent).alias("p"))
    first = ids.where(F.col("n").isNotNull()).groupBy("t", "n").agg(F.min(F.struct("_c", "mid"))["mid"].alias("anc")).select(F.col("t").alias("_t"), F.col("n").alias("_n"), "anc")
    step = cut(ids.join(first, (F.col("t") == F.col("_t")) & (F.col("p") == F.col("_n"))).select("mid", "anc", F.col("_s").alias("total")), "step")
    up, endless = _reach(step)
    leaf = ids.join(step.select(F.col("anc").alias("mid")).distinct(), "mid", "left_anti")
    if endless is not None:
        leaf = leaf.join(endless, "mid", "left_anti")
    climb = leaf.select("t", "n", "_c", F.col("mid").alias("leaf"), F.col("mid").alias("at"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("top"))
    for k in reversed(range(len(up))):
        over = up[k].select(F.col("mid").alias("at"), "anc", "total")
        climb = climb.join(over, "at", "left").select("t", "n", "_c", "leaf", F.coalesce("anc", "at").alias("at"), (F.col("sum") + F.coalesce("total", F.lit(0.0))).alias("sum"),
                                                      F.when(F.col("anc").isNull(), F.col("top")).otherwise(F.col("top") + 2 ** k).alias("top"))
    climb = climb.join(ids.select(F.col("mid").alias("at"), "_s"), "at")
    ranked = climb.select("t", "n", "_c", "leaf", "top", ((F.col("sum") + F.col("_s")) / (F.col("top") + 1)).alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("t").orderBy(F.col("score").desc(), F.col("n").asc_nulls_last(), "_c", "leaf")))
    if best is not None:
        ranked = ranked.where(F.col("rank") <= best)
    ranked = cut(ranked.select("leaf", "rank", "score", "top"), "ranked")
    walk = ranked.select("leaf", F.col("leaf").alias("mid"), F.lit(0).cast("long").alias("height"))
    for k in reversed(range(len(up))):
        more = walk.join(up[k], "mid").select("leaf", F.col("anc").alias("mid"), (F.col("height") + 2 ** k).alias("height"))
        walk = cut(walk.unionByName(more), "walk")
    chosen = walk.join(ranked, "leaf").select("leaf", "rank", F.col("score").alias("path_score"), (F.col("top") - F.col("height")).alias("depth"), "mid")
    return chosen.join(m.drop("_s", "_c"), "mid")


def conversations(chosen: DataFrame, tree: str = "tree", role: str = "role", text: str = "text") -> DataFrame:
    """One row per chosen path: (tree, leaf, rank, path_score, formatted, loss),
    the loss mask as code point ranges. A conversation is one value and so is
    put together in one task, path by path."""
    turns = F.sort_array(F.collect_list(F.struct("depth", F.col(role).alias("role"), F.col(text).alias("text"))))
    whole = chosen.groupBy("leaf", "rank", "path_score").agg(F.first(tree).alias("tree"), turns.alias("turns"))

    def run(batches):
        for b in batches:
            done = [render([(t["role"], t["text"]) for t in ts]) for ts in b.column(4).to_pylist()]
            loss = [[{"start": x, "end": y} for x, y in d.loss] for d in done]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([d.text for d in done], pa.string()), pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                names=[*b.schema.names[:4], "formatted", "loss"])
    kind = dict(chosen.dtypes)[tree]
    return map_rows(whole.select("tree", "leaf", "rank", "path_score", "turns"), run,
                    f"tree {kind}, leaf long, rank int, path_score double, formatted string, loss array<struct<start:long,end:long>>")
