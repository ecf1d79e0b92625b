"""Connected components by contraction, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.sources.scratch import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for all ids of `links` (columns a, b); component is the smallest id.

    Each round every id takes as parent the neighbour, or itself, that comes first
    in a hashed order, and links move on to the parents.  The hashed order makes
    long chains shrink by a constant factor per round.  Parents are then looked up
    from the last round back.  Ids may be of any type that sorts; self links and
    null ids are ignored.  Every table is written, so a lost executor costs its
    tasks only.
    """
    links = materialize(
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    rounds: list[DataFrame] = []
    while not links.isEmpty():
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = F.min(F.struct(F.xxhash64("b").alias("hash"), F.col("b").alias("id")))
        own = F.struct(F.xxhash64("a").alias("hash"), F.col("a").alias("id"))
        parents = materialize(
            ends.groupBy("a").agg(lowest.alias("low")).select(
                F.col("a").alias("id"), F.least(F.col("low"), own)["id"].alias("parent")
            ),
            "parents",
        )
        rounds.append(parents)
        of_a = parents.select(F.col("id").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("id").alias("b"), F.col("parent").alias("pb"))
        links = materialize(
            links.join(of_a, "a")
            .join(of_b, "b")
            .where(F.col("pa") != F.col("pb"))
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(),
            "links",
        )
    if not rounds:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = rounds[-1].withColumnRenamed("parent", "root")
    for parents in reversed(rounds[:-1]):
        above = roots.select(F.col("id").alias("parent"), "root")
        roots = materialize(
            parents.join(above, "parent", "left").select("id", F.coalesce("root", "parent").alias("root")), "roots"
        )
    lowest = materialize(roots.groupBy("root").agg(F.min("id").alias("component")), "lowest")
    return roots.join(lowest, "root").select("id", "component")
