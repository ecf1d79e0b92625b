"""Recursive join of a sorted sequence with itself, over blocks of consecutive rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.sources.scratch import materialize

FAN_BITS = 3  # children of a node: 8
Of = Callable[[str], Column]


def block_rows(n: int, least: int, most: int, blocks: int = 32) -> int:
    """Rows of a block: about `blocks` blocks until one would grow over `most` rows."""
    return max(least, min(most, -(-n // blocks)))


def number_blocks(blocks: DataFrame) -> DataFrame:
    """Adds `block`, increasing along the sequence, to a written table with `part` and `seq`."""
    per_part = (blocks.agg(F.max("seq")).first()[0] or 0) + 1
    return blocks.withColumn("block", F.col("part") * F.lit(per_part) + F.col("seq"))


def close_blocks(
    blocks: DataFrame,
    merge: Mapping[str, Callable[[str], Column]],
    near: Callable[[Of, Of], Column],
) -> DataFrame:
    """Pairs (a, b), a <= b, of blocks that may hold rows close to each other; written.

    Intervals of 8 blocks form a node, 8 nodes the next one, and so on up to one
    root.  `merge` says how a node's summary columns come from its children's;
    `near` must be true unless the summaries prove two nodes distant.  From the
    root down, pairs of nodes are replaced by the pairs of their children that
    are near: equi-joins on the parent, with at most 64 rows for a pair.
    """
    top = blocks.agg(F.max("block")).first()[0]
    nodes = blocks.select(F.col("block").alias("node"), *merge)
    levels = [nodes]
    while top is not None and top > 0:
        top >>= FAN_BITS
        nodes = materialize(
            nodes.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(*(f(c).alias(c) for c, f in merge.items())),
            "nodes",
        )
        levels.append(nodes)
    root = levels[-1].select(F.col("node").alias("a"), F.col("node").alias("b"))
    pairs = root
    for level in reversed(levels[:-1]):
        sides = []
        for side in ("a", "b"):
            columns = [F.col(c).alias(f"{side}_{c}") for c in ("node", *merge)]
            sides.append(level.select(F.shiftright("node", FAN_BITS).alias(side), *columns))
        pairs = (
            pairs.join(sides[0], "a")
            .join(sides[1], "b")
            .where(F.col("a_node") <= F.col("b_node"))
            .where(near(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}")))
            .select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
        )
        pairs = materialize(pairs, "block_pairs")
    return pairs


def with_blocks(pairs: DataFrame, blocks: DataFrame, columns: list[str]) -> DataFrame:
    """Each pair with the given columns of both blocks, as a_... and b_..."""
    for side in ("a", "b"):
        own = blocks.select(F.col("block").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))
        pairs = pairs.join(own, side)
    return pairs
