"""Connected components of links between documents, contracted round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldloom.llm.shared import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has a link.

    Each round every node points at the neighbour (or itself) that comes first in hash order,
    and the links are redrawn between the nodes pointed at. In that order a chain of pointers
    is short whatever the ids are, so the nodes that still have links shrink by a constant
    factor a round. Rounds are joins and minima with partial aggregation: a node with very many
    links is never gathered in one task, and nothing but a count reaches the driver.
    """
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    place = None  # node, where it points by now
    while not edges.isEmpty():
        nearest = edges.groupBy("u").agg(F.min(rank("v")).alias("near"))
        points = cut(nearest.select("u", F.least(rank("u"), F.col("near"))["id"].alias("p")))
        if place is None:
            place = points.select(F.col("u").alias("node"), F.col("p").alias("at"))
        else:
            place = place.join(points, place["at"] == points["u"], "left").select("node", F.coalesce("p", "at").alias("at"))
        place = cut(place)
        to_u, to_v = points.select("u", F.col("p").alias("pu")), points.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = cut(edges.join(to_u, "u").join(to_v, "v").select(F.col("pu").alias("u"), F.col("pv").alias("v")).where("u <> v").distinct())
    if place is None:
        return links.select(F.col(a).alias("node"), F.col(a).alias("component")).limit(0)
    smallest = place.groupBy("at").agg(F.min("node").alias("component"))
    return place.join(smallest, "at").select("node", "component")
