"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import stored


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id on a link; ``links`` has a and b.

    Each round points every id to its smallest neighbour if that is smaller, follows the pointers to
    their ends by doubling, and goes on with the links between different ends. An end is smaller than
    all its neighbours, so at least half of the linked ids go in each round. Tables between
    rounds lie in the shared folder.
    """
    rounds = []
    links = stored(links.filter("a <> b").select("a", "b"), "links")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        smallest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
        ends = stored(smallest.select("id", F.least("id", "near").alias("end")), "ends")
        while True:
            ahead = ends.select(F.col("id").alias("of"), F.col("end").alias("next"))
            further = stored(ends.join(ahead, F.col("end") == F.col("of")).select("id", F.col("end").alias("was"), F.col("next").alias("end")), "ends")
            ends = further.select("id", "end")
            if further.filter("was <> end").isEmpty():
                break
        rounds.append(ends)
        a = ends.select(F.col("id").alias("a"), F.col("end").alias("end_a"))
        b = ends.select(F.col("id").alias("b"), F.col("end").alias("end_b"))
        between = links.join(a, "a").join(b, "b").filter("end_a <> end_b")
        pairs = between.select(F.least("end_a", "end_b").alias("a"), F.greatest("end_a", "end_b").alias("b")).distinct()
        links = stored(pairs, "links")
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    found = rounds[0]
    for ends in rounds[1:]:
        later = ends.select(F.col("id").alias("end"), F.col("end").alias("last"))
        found = found.join(later, "end", "left").select("id", F.coalesce("last", "end").alias("end"))
    return found.select("id", F.col("end").alias("component"))
