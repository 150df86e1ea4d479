"""Connected components as DataFrame joins, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samewise.llm.common import remove, stored


#: Shares into which a node's edges are dealt where they meet its minimum.
SALTS = 8


def _met(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (u, v) with the minimum m of u; a hub's edges are spread over SALTS join keys, which adaptive execution can split further."""
    salted = least.select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(salted, ["u", "salt"]).drop("salt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node that it reaches) of every node of an edge.

    Nodes are any one orderable type; edges with a null end and loops join
    nothing (a loop's node is its own component). Each step is a grouped minimum
    with partial aggregation and one salted equi-join; no neighbour list is ever built. A step's result is
    written to the shared folder, so that a lost executor costs no earlier step.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    pairs, path = stored(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    alone = pairs.where(F.col("u") == F.col("v"))
    links, first, held = pairs.where(F.col("u") != F.col("v")), path, []
    before = None
    while not links.isEmpty():
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _met(both, least).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        # small star: u and its smaller neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _met(large, low).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        links, path = stored(small.where(F.col("u") != F.col("v")).distinct(), "stars")
        held.append(path)
        now = links.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
        remove(spark, held[:-1])
        held = held[-1:]
    roots = links.select("v").distinct()
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
    loops = alone.select(F.col("u").alias("node"), F.col("u").alias("component")).join(found.select("node"), "node", "left_anti")
    out, kept = stored(found.unionByName(loops), "components")
    remove(spark, [first, *held])
    return out
