"""Connected components of link tables, by rounds of joins over shrinking links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridspark.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of `links` (a, b: long).

    Each round hooks every node to the smallest of itself and its neighbours, follows one further
    hook, and moves the links there: a link (v, hook of v) keeps the two ends of that step joined.
    A round combines per node before it shuffles and stages its links in the shared folder. Nodes
    without links do not appear; null ends are ignored.
    """
    edges = staged(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    parents: DataFrame | None = None
    while parents is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("to"))
        onward = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
        roots = staged(hooks.join(onward, "to").select("node", F.col("further").alias("to")), "roots")
        step = roots.select(F.col("node").alias("to"), F.col("to").alias("further"))
        parents = roots if parents is None else parents.join(step, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
        a, b = (roots.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        edges = staged(edges.join(a, "a").join(b, "b").filter("to_a <> to_b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    return staged(parents.select("node", F.col("to").alias("component")), "components")
