"""Connected components of a link table, as rounds of joins on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetry.operators.skew import store_and_release


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of ``links`` (``u``, ``v`` long, not null).

    ``component`` is the smallest node reachable. Alternates two steps until the
    links form stars: each node hangs its larger neighbours below its smallest
    one, then its smaller neighbours. Links never multiply, every round is two
    joins and ends in a table in the shared folder, so a lost executor costs one
    round; a hub's rows are minima with map-side combining and a join that
    adaptive execution may split. Repeated links and self links are allowed; no
    links give no rows.
    """
    edges = store_and_release(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.where("v > u").join(smallest, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u <> v").distinct()
        )
        edges = store_and_release(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).groupBy("node").agg(
        F.min("component").alias("component"))
