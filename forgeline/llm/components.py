"""Connected components of a distributed edge list (alternating large and small star).

Nodes are 64-bit numbers. Each round replaces every edge by edges to the least neighbour. The least neighbour of a node is an aggregation with
map-side combining; it comes back to the node's edges by a join, in which a root of a large component would bring all its edges into one task. So
nodes of more than `2 * edges / HOT_NODES` neighbours (there are at most `HOT_NODES` of them, as degrees sum up to twice the edges) get theirs
by broadcast and their edges are not shuffled; all other nodes are joined by shuffle. Each round is written to the shared folder and read back.
The distance to the root halves each round, so their number follows the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgeline.llm.common import materialized

HOT_NODES = 10_000
HOT_DEGREE = 1_000


def _with_least(edges: DataFrame, least: DataFrame, hot_from: int) -> DataFrame:
    """`edges` (u, v) with the least neighbour m of u; `least` has a row (n, m, degree) for each u."""
    hot = F.broadcast(least.where(f"degree > {hot_from}"))
    cold = edges.join(hot.select("n"), edges.u == hot.n, "left_anti").join(
        least.where(f"degree <= {hot_from}").hint("merge"), F.expr("u = n"))
    return edges.join(hot, F.expr("u = n")).select("u", "v", "m").union(cold.select("u", "v", "m"))


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("degree")).withColumnRenamed("u", "n")


def _large_star(edges: DataFrame, hot_from: int) -> DataFrame:
    """Every larger neighbour of a node goes to the node's least neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = _least(both).selectExpr("n", "least(n, m) as m", "degree")
    return _with_least(both.where("v > u"), least, hot_from).selectExpr("v as a", "m as b")


def _small_star(edges: DataFrame, hot_from: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the least of them."""
    down = edges.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u <> v")
    least = _least(down)
    linked = _with_least(down, least, hot_from).selectExpr("v as a", "m as b")
    return linked.union(least.selectExpr("n as a", "m as b")).where("a <> b").distinct()


def _edges_and_open(edges: DataFrame) -> tuple[int, int]:
    """The number of edges, and of nodes that keep them from being stars: a node with two parents, or with a parent and children."""
    ends = edges.selectExpr("a as n", "1 as up", "0 as down").union(edges.selectExpr("b", "0", "1"))
    nodes = ends.groupBy("n").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    row = nodes.selectExpr("coalesce(sum(ups), 0) as edges", "count_if(ups > 1 or (ups = 1 and down = 1)) as open").first()
    return row["edges"], row["open"]


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of `edges` (a, b of 64-bit numbers): root is the least node of its component."""
    now = materialized(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").where("a <> b").distinct(), name)
    while True:
        n, open_ = _edges_and_open(now)
        if not open_:
            # stars whose edges all go down: every node points straight at the least of its component
            return now.selectExpr("a as node", "b as root").union(now.selectExpr("b", "b").distinct())
        hot_from = max(HOT_DEGREE, -(-2 * n // HOT_NODES))
        now = materialized(_large_star(now, hot_from), name)
        # a star step gives an edge for each it took at most (and one for each node), so the bound holds for the second too
        now = materialized(_small_star(now, hot_from), name)
