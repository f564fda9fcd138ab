"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (a, b); the component is one of its nodes.

    Each round every node takes the smallest node next to it, or itself, as its name; edges between
    nodes of one name go, the others are the next round's. A node keeps its name only if it is the
    smallest around, so the edges shrink by a factor each round and nothing but the remaining edges is
    read. Names are followed from the first round to the last at the end. A node with very many links
    is combined before each shuffle. Joins are by sorting: names are as many as nodes, and their packed files
    say too little of what a broadcast of them takes.
    """
    left = written(edges.select("a", "b").where("a <> b"), "edges")
    names = []
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        name = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("name")), "names")
        names.append(name)
        of_a, of_b = name.select("a", F.col("name").alias("x")), name.select(F.col("a").alias("b"), F.col("name").alias("y"))
        left = written(
            left.join(of_a.hint("merge"), "a").join(of_b.hint("merge"), "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges",
        )
    if not names:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = names[0].select(F.col("a").alias("node"), F.col("name").alias("component"))
    for name in names[1:]:
        out = out.join(name.select(F.col("a").alias("component"), F.col("name").alias("next")).hint("merge"), "component", "left").select(
            "node", F.coalesce("next", "component").alias("component")
        )
    return out
