"""What each of a few filters removes, in every order of applying them, by counting paths in the subset lattice.

A state is the set of filters applied so far, an edge applies one more.  All that an order does at a step
depends on the edge alone, so the documents are counted once per set of filters they fail, the edges are read
off those counts, and every order is a path over the edges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window, functions as F

MOST_FILTERS = 7  # 5040 orders


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Per set of filters (a bit mask): in how many orders it is reached, and in how many it can be left to the end."""
    states, bits = 1 << n, [1 << i for i in range(n)]
    forward, backward = [0] * states, [0] * states
    forward[0] = backward[-1] = 1
    for s in range(1, states):
        forward[s] = sum(forward[s ^ b] for b in bits if s & b)
    for s in reversed(range(states - 1)):
        backward[s] = sum(backward[s | b] for b in bits if not s & b)
    return forward, backward


def _edges(n: int) -> Column:
    forward, backward = path_counts(n)
    rows = [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]
    return F.array(*(F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(p).alias("paths")) for s, f, p in rows))


def failure_classes(
    docs: DataFrame,
    conditions: Mapping[str, Column | None],
    *,
    id_col: str,
    text_col: str,
    part: Column,
    flags: DataFrame | None,
) -> DataFrame:
    """Documents counted by `part` and `mask` (bit i: fails the i-th condition), with those of each flag.

    Rows shrink to (id, digest, part, mask) where they are read, equal ones are counted before the shuffle,
    and rows without an id, which meet no flag, are spread by their digest.
    """
    marks = [c for c in flags.columns if c != id_col] if flags is not None else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bits = [
        F.when(F.coalesce(c, F.lit(False)), 1 << i).otherwise(0) for i, c in enumerate(conditions.values()) if c is not None
    ]
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.coalesce(part.cast("string"), F.lit("")).alias("part"),
        sum(bits, F.lit(0)).alias("mask"),
    )
    rows = rows.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    if flags is not None:
        marked = flags.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id_")).agg(
            *(F.max(F.coalesce(F.col(f"`{m}`"), F.lit(False))).alias(f"mark{i}") for i, m in enumerate(marks))
        )
        spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 16)) + 1).otherwise(0)
        rows = rows.withColumn("spread", spread.cast("int")).join(
            marked.withColumn("spread_", F.lit(0)), [F.col("id") == F.col("id_"), F.col("spread") == F.col("spread_")], "left"
        )
    marked_by = [F.coalesce(F.col(f"mark{i}"), F.lit(False)).alias(f"mark{i}") for i in range(len(marks))]
    rows = rows.select("id", "digest", "part", "mask", "n", *marked_by)
    names = [f"mark{i}" for i in range(len(marks))]
    copy_bits = [1 << i for i, c in enumerate(conditions.values()) if c is None]
    if copy_bits:
        # The row of a class with the smallest id is told from its later copies by counts alone.
        classes = rows.groupBy("digest", "part", "mask", *names).agg(
            F.sum("n").alias("n"),
            F.min("id").alias("first"),
            F.min_by("n", "id").alias("n_first"),
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("n_no_id"),
        )
        classes = classes.withColumn("least", F.min("first").over(Window.partitionBy("digest")))
        leading = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0) + F.col("n_no_id")
        split = F.array(
            F.struct(F.col("mask"), leading.alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(sum(copy_bits))).alias("mask"), (F.col("n") - leading).alias("n")),
        )
        rows = classes.select("part", *names, F.explode(split).alias("cell")).select("part", *names, "cell.mask", "cell.n")
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *(F.sum(F.when(F.col(f"mark{i}"), F.col("n")).otherwise(0)).alias(f"{m}_n") for i, m in enumerate(marks)),
    )


def lattice_edges(classes: DataFrame, n: int, marks: Sequence[str]) -> DataFrame:
    """Per part and edge: documents alive before it, removed by it, those of each mark, and what its filter does overall.

    `fails`: all that fail the filter, read at the edge from the empty set; `unique_fails`: those failing no other,
    read at the edge into the full set; `shapley`: removals of all its edges, weighted by the orders through each.
    """
    met = F.col("mask").bitwiseAND(F.col("edge.state")) == 0
    hit = met & (F.expr("shiftright(mask, edge.filter) & 1") == 1)
    removed = classes.withColumn("edge", F.explode(_edges(n))).groupBy(
        "part", F.col("edge.state").alias("state"), F.col("edge.filter").alias("filter"), F.col("edge.paths").alias("paths")
    )
    edges = removed.agg(
        F.sum(F.when(met, F.col("n")).otherwise(0)).alias("alive"),
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("removed"),
        *(F.sum(F.when(hit, F.col(f"{m}_n")).otherwise(0)).alias(f"{m}_lost") for m in marks),
    )
    last = F.col("state") == F.lit((1 << n) - 1) - F.expr("shiftleft(1, filter)")
    alike = Window.partitionBy("part", "filter")  # 16 edges of five filters
    return edges.select(
        "*",
        F.sum(F.when(F.col("state") == 0, F.col("removed"))).over(alike).alias("fails"),
        F.sum(F.when(last, F.col("removed"))).over(alike).alias("unique_fails"),
        F.sum(F.col("paths") * F.col("removed")).over(alike).alias("shapley"),
    )


def audit_orders(
    docs: DataFrame,
    conditions: Mapping[str, Column | None],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    part: Column | None = None,
    flags: DataFrame | None = None,
) -> DataFrame:
    """One row per part, order of the filters and step.

    `conditions` maps names to conditions of failure over `docs`; None stands for "its text is also the text of a
    smaller id", anywhere in the table.  `flags` holds `id_col` and boolean columns; several rows of an id count as
    their disjunction, an id without a row as unflagged.  Result: part, filter_order (names in order), step (from 1),
    kept, removed, redundant (failing this step's filter but removed earlier), unique_fails (failing no other
    filter), `<flag>_lost` (removed here), shapley (removals of this step's filter summed over all orders).

    A condition that is null does not fail.  A null text equals the empty one, a null part is the empty string.
    Copies are told by SHA-256 and id: rows that share an id are no copies of each other, and a row without an id
    is neither a copy nor an original.  Every row counts, repeated ones too.  Parts without rows, and so an empty
    table, give none.  Only the columns named are read, so others cannot clash.  The result has 600 rows a part
    for five filters; more than seven are refused.
    """
    names = list(conditions)
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters, not {len(names)}")
    if flags is not None and id_col not in flags.columns:
        raise ValueError(f"flags need the column {id_col}")
    marks = [c for c in flags.columns if c != id_col] if flags is not None else []
    classes = failure_classes(
        docs, conditions, id_col=id_col, text_col=text_col, part=F.lit("") if part is None else part, flags=flags
    )
    steps, between = [], "" if all(len(x) == 1 for x in names) else ","
    for order in permutations(range(len(names))):
        label, state = between.join(names[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((label, step, state, f))
            state |= 1 << f
    ddl = "filter_order string, step int, state int, filter int"
    paths = docs.sparkSession.createDataFrame(steps, ddl)
    return lattice_edges(classes, len(names), marks).join(paths, ["state", "filter"]).select(
        "part",
        "filter_order",
        "step",
        (F.col("alive") - F.col("removed")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *(f"{m}_lost" for m in marks),
        "shapley",
    )
