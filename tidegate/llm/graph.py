"""Connected components of links between documents, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import kept_table


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node of the links (a, b).

    In each round every component hangs itself below its smallest neighbour, and the chains that
    arise are halved until they are flat. Tables are written after each round; only their
    emptiness is asked for by the driver. A node with many links costs one row for each input
    partition in the minima, and joins leave hot keys to adaptive execution.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    state = kept_table(
        both.groupBy("a").agg(F.min("b").alias("near")).select(
            F.col("a").alias("node"), F.least("a", "near").alias("component")
        ),
        "components",
    )
    state = _flat(state)
    while True:
        left = links.join(state.toDF("a", "ca"), "a").join(state.toDF("b", "cb"), "b")
        # links between components take the place of those between nodes: fewer in each round
        links = kept_table(
            left.where("ca <> cb")
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
            .distinct(),
            "open-links",
        )
        hung = kept_table(
            links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component")), "hung"
        )
        if hung.isEmpty():
            return state
        hung = _flat(hung).toDF("component", "into")
        state = kept_table(
            state.join(hung, "component", "left").select(
                "node", F.coalesce("into", "component").alias("component")
            ),
            "components",
        )


def _flat(parents: DataFrame) -> DataFrame:
    """Follows (node, component) chains to their ends; parents are smaller than their nodes."""
    while True:
        up = parents.toDF("component", "above")
        step = parents.join(up, "component", "left").select(
            "node", "component", F.coalesce("above", "component").alias("above")
        )
        step = kept_table(step, "chains")
        moved = not step.where("above <> component").isEmpty()
        parents = step.select("node", F.col("above").alias("component"))
        if not moved:
            return parents
