"""Pairwise matches consolidated into groups: alternating large-star and small-star rewrites.

Edges point from the greater to the smaller node. A large star connects every greater neighbour of a
node to the least node around it; a small star does the same with its smaller neighbours and the
node itself. Both keep connectivity, and repeated they leave a forest of stars whose centres are the
least nodes of their components (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Each step is one aggregation (minimum per node, combined on the map side) and one join of the edges
with those minima. A node with a large share of all edges is found from the aggregation's counts,
and its edges are spread in the join over as many salts as they need. No group is ever gathered in one task. Each step is
written to the shared folder, so neither lineage nor lost executors matter.

Defined results: rows with a NULL end are no edges; a self-link gives its node a group of its own
unless other links join it; repeated and reversed edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starweave.operators.skew import SALT_ROWS, hot_salts, join_hot
from starweave.session import discard, materialise


def _minima(edges: DataFrame, least: Column, rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Per ``u`` the least node around it, and the salts of the hot nodes among them."""
    seen = Observation()
    stats = edges.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n"))
    stats = materialise(stats.observe(seen, F.max("n").alias("most")))
    return stats, hot_salts(stats, "u", "n", rows) if (seen.get["most"] or 0) > rows else None


def _star(around: DataFrame, moved: DataFrame, with_centre: bool, rows: int) -> tuple[DataFrame, dict]:
    """``around``: edges whose minima count; ``moved``: edges whose ``v`` is connected to the minimum."""
    minima, hot = _minima(around, F.least(F.min("v"), F.col("u")), rows)
    out = join_hot(moved, minima.select("u", "m"), "u", hot, salt_by="v").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if with_centre:
        out = out.unionByName(minima.select("u", F.col("m").alias("v")))
    seen = Observation()
    out = out.where(F.col("u") != F.col("v")).distinct()
    sign = F.xxhash64("u", "v").cast("decimal(38,0)")
    out = materialise(out.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(sign).alias("sign")))
    discard(minima)
    return out, seen.get


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 100, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(node, component): every node of an edge with the least node of its component."""
    pairs = edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    directed = materialise(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    nodes = directed.select(F.col("u").alias("node")).union(directed.select("v")).distinct()
    current, before = directed.where(F.col("u") != F.col("v")), None
    owned = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = _star(both, both.where(F.col("v") > F.col("u")), False, salt_rows)
        small, sign = _star(large, large, True, salt_rows)
        discard(large)
        if owned is not None:
            discard(owned)
        current = owned = small
        if sign == before:
            break
        before = sign
    else:
        raise RuntimeError(f"the components did not settle in {max_rounds} rounds")
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("centre")), "node", "left").select("node", F.coalesce("centre", "node").alias("component"))
