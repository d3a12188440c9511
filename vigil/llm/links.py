"""Connected components of a link table, by alternating star contraction.

Links (a, b) of long ids are rewritten until every id points straight at the
smallest id that it can reach: a large-star round points each larger neighbour
at the least neighbour, a small-star round each smaller one. The table stays
linear in the links, every round is two grouped aggregates with partial
aggregation, and rounds grow with the logarithm of the longest path. A round's
links are written to the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import written


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Point every larger (or every smaller or equal) neighbour of an id at the
    id's least neighbour, itself included."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    near = both.join(least, "a")
    if larger:
        # who is larger than a points at a's least
        out = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        # a and its smaller neighbours point at the least
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(id, component): for each id of ``links`` (columns a, b; null ends are
    left out) the smallest id reachable. Links to itself and repeated links
    change nothing; no links give an empty table."""
    links = written(links.where("a is not null and b is not null and a <> b")
                    .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        state = (state["n"], state["s"])
        if state == before or not state[0]:
            break
        before = state
        links = written(_star(_star(links, True), False), name)
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())
