"""Connected components by alternating star contraction (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.operators.joins import HOT_ROWS, join_counted
from muster.session import discard, materialize_counted

MAX_ROUNDS = 100


def _canonical(edges: DataFrame) -> DataFrame:
    """Undirected edges, each once, from the greater node ``a`` to the lesser node ``b``."""
    src, dst = edges.columns[:2]
    a, b = F.col(src), F.col(dst)
    return (
        edges.filter(a != b)
        .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .groupBy("a", "b")
        .agg(F.lit(True).alias("moved"))
    )


def _with_least(edges: DataFrame, least: DataFrame, end: str, hot_rows: int | None) -> DataFrame:
    """Edges with the least neighbour ``m`` of their ``end``; hot nodes apart if there may be any."""
    if hot_rows is None:
        return edges.join(least.drop("n"), end)
    return join_counted(edges, least, [end], "n", hot_rows)


def _large_star(edges: DataFrame, hot_rows: int | None) -> DataFrame:
    """Link every node's greater neighbours to the least node it knows."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = ends.groupBy(F.col("u").alias("b")).agg(
        F.min("v").alias("m"), F.count(F.lit(1)).alias("n")
    )
    m = F.least("b", "m")
    return _with_least(edges, least, "b", hot_rows).select(
        "a", m.alias("b"), (m != F.col("b")).alias("moved")
    )


def _small_star(edges: DataFrame, hot_rows: int | None) -> DataFrame:
    """Link every node, and its lesser neighbours, to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    other = F.col("b") != F.col("m")
    return (
        _with_least(edges, least, "a", hot_rows)
        .select(
            F.when(other, F.col("b")).otherwise(F.col("a")).alias("a"),
            F.col("m").alias("b"),
            (F.col("moved") | other).alias("moved"),
        )
        .groupBy("a", "b")
        .agg(F.bool_or("moved").alias("moved"))
    )


def _written(edges: DataFrame) -> tuple[DataFrame, int, int]:
    """The edges written once, and how many there are and have moved, counted as they are written."""
    counts = {"n": F.count(F.lit(1)), "moved": F.count_if("moved")}
    table, seen = materialize_counted(edges, "edges", counts)
    return table, seen["n"], seen["moved"]


def linked_components(
    edges: DataFrame, max_rounds: int = MAX_ROUNDS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``node, component`` of every node that has an edge; the component is its least node.

    Each round is one job that writes its edges to the shared folder, and the edges a round moved
    decide whether another one is needed.  A hub with very many neighbours is only ever aggregated
    with partial results and joined to one row without a shuffle.
    """
    current, size, _ = _written(_canonical(edges))
    if size == 0:
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    # No round has more edges than the first, so fewer edges than that leave no node hot.
    hot = hot_rows if size >= hot_rows else None
    for _ in range(max_rounds):
        following, _, moved = _written(_small_star(_large_star(current, hot), hot))
        discard(current)
        current = following
        if not moved:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                roots.distinct()
            )
    raise RuntimeError(f"components not settled after {max_rounds} rounds")


def connected_components(
    nodes: DataFrame, edges: DataFrame, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """``node, component`` of every node in the first column of ``nodes``; alone, it is its own."""
    node = nodes.columns[0]
    linked = linked_components(edges, max_rounds)
    return (
        nodes.select(F.col(node).alias("node"))
        .distinct()
        .join(linked, "node", "left")
        .select("node", F.coalesce("component", "node").alias("component"))
    )
