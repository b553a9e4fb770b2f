"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of ``links`` (u, v).

    Large and small stars in turn: every id hands its smallest neighbour to the others, until each
    component is one star around its smallest id.  An id with very many neighbours is one hot join key with
    one row on the other side, which Spark splits; no neighbourhood is ever collected.
    Links with a null end are none.
    """
    pairs = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last = stored(pairs, "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
        last = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = stored(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(least).distinct(), "small-star")
