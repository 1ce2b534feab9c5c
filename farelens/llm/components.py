"""Connected components by contraction, as joins and aggregates over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from farelens.llm.tables import store


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``u, v``; the component is its
    smallest node.

    A round lets every node choose, among itself and its neighbours, the one with the
    smallest hash for that round, and merges into it.  At least the nodes that nobody chose
    vanish from the next graph, in expectation a fixed share, so rounds are logarithmic in
    the number of nodes and the edge tables shrink geometrically.  Edges with a null end and
    loops are ignored; repeated edges count once; no edges give no rows.

    A node's neighbours are only ever aggregated (with partial aggregation), and the joins
    have one row per node on one side, so a hub with a third of all edges is split by the
    engine like any skewed join.
    """
    def distinct(pairs: DataFrame) -> DataFrame:
        return store(pairs.where("u <> v").select(
            F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")

    graph = distinct(edges.select("u", "v"))
    chosen: list[DataFrame] = []
    while not graph.isEmpty():
        both = graph.unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(chosen))), F.col(c).alias("node"))
        choice = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
        choice = store(choice.select(
            "u", F.least("best", rank("u"))["node"].alias("into")), "choice")
        chosen.append(choice)
        ends = choice.select(F.col("u").alias("v"), F.col("into").alias("v_into"))
        half = graph.join(choice, "u").select("v", F.col("into").alias("u"))
        graph = distinct(half.join(ends, "v").select("u", F.col("v_into").alias("v")))
    if not chosen:
        return edges.select(F.col("u").alias("node"), F.col("u").alias("component")).limit(0)
    found = chosen.pop()
    for choice in reversed(chosen):
        later = found.select(F.col("u").alias("into"), F.col("into").alias("root"))
        found = choice.join(later, "into", "left").select(
            "u", F.coalesce("root", "into").alias("into"))
    found = store(found, "roots") if chosen else found
    smallest = found.groupBy("into").agg(F.min("u").alias("component"))
    return found.join(smallest, "into").select(F.col("u").alias("node"), "component")
