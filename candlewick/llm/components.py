"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _mark(edges: DataFrame):
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each linked node but the roots; root is the smallest
    node of the component. ``links``: two columns of one orderable type.

    Large-star and small-star rounds: each node's neighbours are tied to the
    smallest of them. Minima are partial aggregates and the joins are plain
    equi-joins, so a hub with a third of all links is split, never gathered.
    """
    a, b = links.columns
    u, v, m = F.col("u"), F.col("v"), F.col("m")
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(u != v).distinct()
    e = cut(e, "links")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        # large star: each neighbour above u goes to the least of u and its neighbours
        both = e.unionByName(e.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        e = cut(both.join(low, "u").where(v > u).select(v.alias("u"), m.alias("v")).where(u != v).distinct(), "links")
        # small star: u and its lower neighbours go to the least of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(e.join(low, "u").select(F.explode(F.array(F.struct(v.alias("u"), m.alias("v")), F.struct(u.alias("u"), m.alias("v")))).alias("x"))
                .select("x.*").where(u != v).distinct(), "links")
        before, mark = mark, _mark(e)
        if mark == before:
            break
    else:
        raise RuntimeError(f"the components still change after {max_rounds} rounds")
    return e.select(u.alias("node"), v.alias("root"))
