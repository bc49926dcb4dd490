"""Connected components of an edge table by repeated contraction.

Every round gives each node the least priority found within two hops (priorities are a
hash of the node, different in every round, so that long paths shrink by a constant
factor) and replaces both ends of every edge by it; edges inside one node vanish. A
star of any size contracts in one round. All steps are joins and partial aggregations
over the edge table; nothing comes to the driver but the count of the edges left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

MAX_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (bigint columns a, b); component is
    the smallest id reachable. Loops and repeated edges do no harm, null ends are left
    out; no edges give no rows."""
    spark = edges.sparkSession
    live = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    names = None
    for turn in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("r"), c.alias("v"))
        near = both.groupBy("a").agg(F.least(F.min(rank(F.col("b"))), rank(F.col("a"))).alias("near"))
        far = both.join(near.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("near")["v"].alias("to"))
        far = materialize(far, "contraction")
        names = far.select(F.col("a").alias("id"), F.col("to").alias("component")) if names is None else materialize(
            names.join(far.withColumnRenamed("a", "component"), "component", "left")
            .select("id", F.coalesce("to", "component").alias("component")), "names")
        live = (live.join(far.withColumnRenamed("to", "x"), "a").join(far.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
                .filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        live = materialize(live, "edges")
    else:
        raise RuntimeError("components did not converge")
    if names is None:
        return spark.createDataFrame([], "id bigint, component bigint")
    least = names.groupBy("component").agg(F.min("id").alias("least"))
    return names.join(least, "component").select("id", F.col("least").alias("component"))
