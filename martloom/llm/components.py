"""Connected components of a graph of long keys, on Spark alone.

Every round links each node to its smallest neighbour, follows the links to their roots by
doubling, and replaces the ends of each edge by their roots. Edges inside a tree vanish, so
the graph shrinks until no edge is left. Tables of a round are written to the shared folder:
that cuts lineage, and both sides of each join are read from files, so adaptive execution can
split a key that many edges share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.sources.staging import Staging


def _follow(store: Staging, links: DataFrame) -> DataFrame:
    """(node, root) where each node pointed at `root` before, doubled until nothing moves."""
    while True:
        parent = links.select(F.col("node").alias("at"), F.col("root").alias("next"))
        moved = links.join(parent, links["root"] == parent["at"], "left").select(
            "node",
            F.coalesce("next", "root").alias("root"),
            (F.coalesce("next", "root") != F.col("root")).alias("moved"),
        )
        moved = store.save("links", moved)
        links = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return links


def _renamed(table: DataFrame, column: str, links: DataFrame) -> DataFrame:
    """`column` replaced by its root; nodes without a link stay."""
    to = links.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    return table.join(to, table[column] == F.col("_node"), "left").select(
        *[
            F.coalesce("_root", column).alias(column) if c == column else F.col(c)
            for c in table.columns
        ]
    )


def components(store: Staging, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (u, v); root is the smallest node reached.

    Edges may repeat, point either way or join a node to itself; a null end is left out. No
    edges give no rows.
    """
    clean = edges.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges = store.save(
        "edges",
        clean.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
    )
    links: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = both.groupBy(F.col("u").alias("node")).agg(
            F.least(F.min("v"), F.first("u")).alias("root")
        )
        new = _follow(store, store.save("parents", parents))
        if links is None:
            links = new
        else:
            known = _renamed(links, "root", new)
            links = store.save("links", known.unionAll(new.join(links, "node", "left_anti")))
        left = _renamed(_renamed(edges, "u", new), "v", new).filter(F.col("u") != F.col("v"))
        edges = store.save(
            "edges",
            left.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
        )
    if links is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return links
