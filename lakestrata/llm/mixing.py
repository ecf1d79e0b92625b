"""Mix sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import fresh, uniform

# A larger mean is drawn as the sum of several draws, so that no table of thresholds grows.
MEAN_PER_DRAW = 64.0


def thresholds(mean: float) -> list[float]:
    """P(count <= k) for k = 0, 1, ... until nothing is left that 52 bits can tell from 1."""
    out, below, k = [], 0.0, 0
    while below < 1 - 2.0**-53 and k < mean + 40 + 12 * math.sqrt(mean):
        below += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        out.append(below)
        k += 1
    return out


def poisson_count(mean: float, key: Column, seed: int) -> Column:
    """Inverse of the Poisson distribution at a uniform number fixed by seed and key."""
    if mean <= 0:
        return F.lit(0)
    draws = math.ceil(mean / MEAN_PER_DRAW)
    steps = F.array(*(F.lit(c) for c in thresholds(mean / draws)))

    def draw(j) -> Column:
        u = uniform(seed, "count", key, j)
        return F.size(F.filter(steps, lambda c: c <= u))

    if draws == 1:
        return draw(0)
    each = F.transform(F.sequence(F.lit(0), F.lit(draws - 1)), draw)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b)


def repetition_rates(
    docs: DataFrame,
    weights: Mapping[str, float],
    other: float,
    source_col: str,
    text_col: str,
    epochs: float,
) -> dict[str | None, float]:
    """Mean copies of a document per named source; None stands for all other sources.

    A source's size is its characters, one at least for a document.  Weights are
    shared out among the groups that have rows.  One row per named source comes
    to the driver.
    """
    if any(w < 0 for w in [*weights.values(), other]):
        raise ValueError("weights must not be negative")
    named = F.when(F.col(source_col).isin(*weights), F.col(source_col)) if weights else F.lit(None).cast("string")
    size = F.greatest(F.coalesce(F.length(text_col), F.lit(0)), F.lit(1))
    rows = docs.groupBy(named.alias("name")).agg(F.sum(size).alias("size")).collect()
    sizes = {r["name"]: r["size"] for r in rows}
    held = {name: weights.get(name, other) if name is not None else other for name in sizes}
    total, share = sum(sizes.values()), sum(held.values())
    return {n: epochs * total * held[n] / share / sizes[n] if share else 0.0 for n in sizes}


def poisson_mix(
    docs: DataFrame,
    weights: Mapping[str, float],
    *,
    other: float,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    epochs: float = 1.0,
    seed: int = 17,
) -> DataFrame:
    """Replicate documents so that each source's characters approach its target weight.

    A document of a source with mean rate r appears Poisson(r) times; the count
    comes from a hash of seed and id, so a rerun, or a lost executor, changes
    nothing.  Copies then go to partitions by a random key and are sorted by it:
    the files in order are a random permutation.

    Result: all columns of `docs`, then `rate` double, `copy` int (from 0) and
    `shuffle_key` long; a name that `docs` already has gets a trailing underscore.

    Defined cases: sources that `weights` does not name, null included, share the
    weight `other` as one group.  Null and empty texts count as one character.
    Rows with equal ids get equal counts; a null id is an id like any other.
    Weights of sources without rows are spread over the rest; an empty table, or
    weights that are all zero, give no rows.
    """
    rates = repetition_rates(docs, weights, other, source_col, text_col, epochs)
    names = {n: fresh(docs.columns, n) for n in ("rate", "copy", "shuffle_key")}
    key, source = F.col(id_col), F.col(source_col)
    rest = rates.get(None, 0.0)
    rate, count = F.lit(rest), poisson_count(rest, key, seed)
    for name, mean in rates.items():
        if name is not None:
            rate = F.when(source == name, F.lit(mean)).otherwise(rate)
            count = F.when(source == name, poisson_count(mean, key, seed)).otherwise(count)
    n = fresh(docs.columns, "count")
    copies = (
        docs.withColumns({names["rate"]: rate, n: count})
        .where(F.col(n) > 0)
        .withColumn(names["copy"], F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
        .drop(n)
    )
    order = F.floor(uniform(seed, "order", key, F.col(names["copy"])) * float(1 << 52)).cast("bigint")
    shuffled = copies.withColumn(names["shuffle_key"], order)
    return shuffled.repartition(F.col(names["shuffle_key"])).sortWithinPartitions(names["shuffle_key"])
