"""Connected components by alternating star contractions (Kiveris et al., 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.runs import fingerprint
from millrace.session import cut_lineage


def _links(df):
    return df.select("u", "v").filter(F.col("u") != F.col("v")).distinct()


def _large_star(edges):
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    upwards = both.filter(F.col("v") > F.col("u"))
    return _links(upwards.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges):
    """Smaller neighbours and the node itself are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _links(near.unionByName(lowest.select("u", F.col("m").alias("v"))))


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, component) for every node, the component being its smallest node.

    `nodes` has a column `node`, `edges` columns u and v. Each round is written
    out, so the plan stays short; the number of rounds grows with the logarithm
    of the graph's diameter. All minima are aggregates, combined map-side, so a
    node with very many neighbours is not gathered anywhere.
    """
    current = cut_lineage(_links(edges.select("u", "v")), "edges")
    mark = fingerprint(current).first()
    settled = False
    while not settled:  # every round that changes something brings nodes closer to their smallest one
        following = cut_lineage(_small_star(_large_star(current)), "edges")
        next_mark = fingerprint(following).first()
        # equal digests are cheap to see; that nothing changed is then made sure of row by row
        settled = mark == next_mark and following.join(current, ["u", "v"], "left_anti").isEmpty()
        current, mark = following, next_mark
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
