"""Connected components of an edge table by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import frozen


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    ).select("col.u", "col.v")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node with the smallest node of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = near.filter("v > u").join(least, "u")
    return linked.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its neighbours below it with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a != b")
    return linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its smallest node.

    Loops and edges with a null end are ignored, repeated edges count once, no edges give no rows. A round
    sums the minimum of a neighbourhood partly before the shuffle and joins it back, so that a node with a
    large share of the edges is a skewed join that Spark splits, not a group in one task. The number of rounds
    grows with the logarithm of the size; every round's edges go to the shared folder.
    """
    links = frozen(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).isNotNull() & F.col(b).isNotNull())
        .toDF("a", "b", "known")
        .filter("known and a != b")
        .select("a", "b")
        .distinct()
    )
    mark = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            break
        mark = tuple(now)
        links = frozen(_small_star(_large_star(links)))
    # At rest every edge leads from a node to the smallest of its component.
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
