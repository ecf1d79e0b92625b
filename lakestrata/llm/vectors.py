"""Embedding near-duplicates by epsilon grid order."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.block_join import block_rows, close_blocks, number_blocks, with_blocks
from lakestrata.llm.components import connected_components
from lakestrata.sources.scratch import materialize

LEADING = 8  # principal dimensions that make the grid
SAMPLE_VALUES = 2_000_000  # numbers in the sample that the axes are fitted on
LEAST_BLOCK, BLOCK_VALUES = 128, 1 << 18  # rows, and numbers, in a block
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading axes of the most frequent vector length, from a bounded sample by hash.

    Any orthonormal axes give right results; vectors of other lengths use their
    first coordinates.
    """
    sizes = classes.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return {}
    d = sizes[0]["d"]
    rows = (
        classes.where(F.size("vector") == d)
        .orderBy(F.xxhash64("vector"), "vector")
        .limit(max(1, min(SAMPLE_VALUES // d, 20_000)))
        .select("vector")
    ).toArrow()
    sample = unit_rows(np.array(rows.column(0).to_pylist(), np.float64))
    lead = min(LEADING, d)
    if d > 4096:  # a covariance of this size is not worth it
        return {d: np.eye(d, lead)}
    values, axes = np.linalg.eigh(np.cov(sample.T, ddof=0).reshape(d, d))
    return {d: axes[:, np.argsort(-values)[:lead]]}


def projected(vectors: list, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Unit vectors on the leading axes, as rows of LEADING numbers; missing dimensions are 0."""
    out = np.zeros((len(vectors), LEADING))
    by_size: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        by_size.setdefault(len(v), []).append(i)
    for d, members in by_size.items():
        rows = unit_rows(np.array([vectors[i] for i in members], np.float64))
        found = rows @ axes[d] if d in axes else rows[:, :LEADING]
        out[members, : found.shape[1]] = found
    return out


def grid_blocks(classes: DataFrame, eps: float, parts: int) -> DataFrame:
    """Classes in epsilon grid order, cut into blocks with bounds of length, label and grid coordinates.

    The order is by vector length, label, then the grid cells of width eps on
    the leading axes.  A block holds vectors of one length only.
    """
    axes = principal_axes(classes)
    names = [f"x{i}" for i in range(LEADING)]
    kind = classes.schema["vector"].dataType.elementType.simpleString()
    label = classes.schema["label"].dataType.simpleString()
    dtype = np.float32 if kind == "float" else np.float64

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                piece = batch.slice(i, 2048)
                spots = projected(piece.column("vector").to_pylist(), axes)
                arrays = [*piece.columns, *(pa.array(spots[:, k]) for k in range(LEADING))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*piece.schema.names, *names])

    placed = classes.select("label", "vector", "class", "copies").mapInArrow(
        place,
        f"label {label}, vector array<{kind}>, class long, copies long, "
        + ", ".join(f"{x} double" for x in names),
    )
    cells = [F.floor(F.col(x) / eps) for x in names]
    order = [F.size("vector").alias("d"), "label", *(c.alias(f"c{i}") for i, c in enumerate(cells))]
    keys = ["d", "label", *(f"c{i}" for i in range(LEADING))]
    rows = placed.select("*", *(o for o in order if not isinstance(o, str)))
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys, "vector")
    n = block_rows(classes.count(), LEAST_BLOCK, BLOCK_VALUES)

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, []

        def block() -> pa.RecordBatch:
            nonlocal seq, held
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = np.array(table.column("vector").to_pylist(), dtype)
            lists = {c: table.column(c).to_pylist() for c in ("label", "class", "copies")}
            spots = np.stack([table.column(x).to_numpy() for x in names])
            made = {"part": [part], "seq": [seq], "d": [vectors.shape[1]], "vectors": [vectors.tobytes()]}
            made |= {c: [v] for c, v in lists.items()}
            made |= {"first": [lists["label"][0]], "last": [lists["label"][-1]]}
            for x, row in zip(names, spots):
                made |= {f"{x}_low": [float(row.min())], f"{x}_high": [float(row.max())]}
            seq, held = seq + 1, []
            return pa.RecordBatch.from_pydict(made, schema=arrow)

        own = ["label", "vector", "class", "copies", *names]
        arrow, sizes, count = None, None, 0
        for batch in batches:
            if arrow is None:
                of = {f.name: f.type for f in batch.schema}
                arrow = pa.schema(
                    [("part", pa.int64()), ("seq", pa.int64()), ("d", pa.int64()), ("vectors", pa.binary())]
                    + [("label", pa.list_(of["label"])), ("class", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64()))]
                    + [("first", of["label"]), ("last", of["label"])]
                    + [(f"{x}_{end}", pa.float64()) for x in names for end in ("low", "high")]
                )
            ds, at = batch.column("d").to_pylist(), 0
            while at < batch.num_rows:
                if sizes not in (None, ds[at]) or count >= max(1, min(n, BLOCK_VALUES // ds[at])):
                    yield block()
                    count = 0
                sizes = ds[at]
                room = max(1, min(n, BLOCK_VALUES // sizes)) - count
                stop = at
                while stop < batch.num_rows and stop - at < room and ds[stop] == sizes:
                    stop += 1
                held.append(batch.slice(at, stop - at).select(own))
                count, at = count + stop - at, stop
        if held:
            yield block()

    schema = (
        f"part long, seq long, d long, vectors binary, label array<{label}>, class array<long>, copies array<long>, "
        f"first {label}, last {label}, " + ", ".join(f"{x}_low double, {x}_high double" for x in names)
    )
    return number_blocks(materialize(rows.mapInArrow(pack, schema), "grid_blocks"))


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows have cosine >= least; values next to the border are computed again one by one."""
    ua, ub = unit_rows(a), unit_rows(b)
    cosine = ua @ ub.T
    found = cosine >= least
    for i, j in np.argwhere(np.abs(cosine - least) < SLACK):
        x, y = a[i].astype(np.float64), b[j].astype(np.float64)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        found[i, j] = math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= least
    return found


def local_roots(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest number that each row (0, 1, ...) and column (going on) of a link matrix reaches."""
    n, m = links.shape
    rows, cols = np.arange(n), np.arange(n, n + m)
    while True:
        up = np.minimum(cols, np.where(links, rows[:, None], n + m).min(axis=0))
        left = np.minimum(rows, np.where(links, up[None, :], n + m).min(axis=1))
        if (up == cols).all() and (left == rows).all():
            return rows, cols
        rows, cols = left, up


def vector_classes(
    vectors: DataFrame,
    *,
    least: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, n_links long, component_id): vectors linked by cosine >= `least` among equal labels.

    Equal vectors of a label are one class with a count of copies, so copies are
    never paired.  Classes are sorted in epsilon grid order, where eps is the
    distance of unit vectors at that cosine; blocks of the order join recursively,
    and pairs of blocks whose bounds lie further apart are skipped.  A pair of
    blocks passes on counts and spanning links, not pairs.

    Defined cases: null, zero and non-finite vectors and null labels link with
    nothing, nor do vectors of different length; 0 links and the own id are
    returned for them.  Repeated rows are copies and link with each other.  A null
    id counts as a vector but never is a component's id.  An empty table gives no
    rows; other columns are not read.
    """
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    fit = usable(F.col("vector")) & F.col("label").isNotNull()
    plain = F.transform("vector", lambda x: x + F.lit(0).cast(vectors.schema[vector_col].dataType.elementType))
    fitting = rows.where(fit).withColumn("vector", plain)  # -0.0 becomes 0.0
    classes = materialize(
        fitting.groupBy("label", "vector")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + SLACK
    held = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("d")).first()
    # A sort task holds about as many numbers as a block may.
    parts = max(1, held["n"] // block_rows(held["n"], LEAST_BLOCK, max(LEAST_BLOCK, BLOCK_VALUES // held["d"])))
    blocks = grid_blocks(classes, eps, parts)
    names = [f"x{i}" for i in range(LEADING)]
    lows = ["d_low", "first", *(f"{x}_low" for x in names)]
    highs = ["d_high", "last", *(f"{x}_high" for x in names)]
    blocks = blocks.withColumns({"d_low": F.col("d"), "d_high": F.col("d")})
    merge = {c: F.min for c in lows} | {c: F.max for c in highs}

    def near(a, b) -> Column:
        square = F.lit(0.0)
        for x in names:
            gap = F.greatest(a(f"{x}_low") - b(f"{x}_high"), b(f"{x}_low") - a(f"{x}_high"), F.lit(0.0))
            square = square + gap * gap
        meet = [a(lo) <= b(hi) for lo, hi in (("d_low", "d_high"), ("first", "last"))]
        meet += [b(lo) <= a(hi) for lo, hi in (("d_low", "d_high"), ("first", "last"))]
        return meet[0] & meet[1] & meet[2] & meet[3] & (square <= F.lit(eps * eps + SLACK))

    pairs = close_blocks(blocks, merge, near)
    dtype = np.float32 if classes.schema["vector"].dataType.elementType.simpleString() == "float" else np.float64

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["a_d"] != row["b_d"]:
                    continue
                a, b = (np.frombuffer(row[f"{s}_vectors"], dtype).reshape(-1, row["a_d"]) for s in ("a", "b"))
                code = {v: k for k, v in enumerate(dict.fromkeys(row["a_label"] + row["b_label"]))}
                la, lb = (np.array([code[v] for v in row[f"{s}_label"]]) for s in ("a", "b"))
                links = linked(a, b, least) & (la[:, None] == lb[None, :])
                same = row["a"] == row["b"]
                if same:
                    np.fill_diagonal(links, False)
                    links |= links.T
                if not links.any():
                    continue
                ids = [np.array(row[f"{s}_class"]) for s in ("a", "b")]
                weight = [links @ np.array(row["b_copies"]), links.T @ np.array(row["a_copies"])]
                if same:  # a row and its column are one vector
                    np.fill_diagonal(links, True)
                roots_a, roots_b = local_roots(links)
                every = np.concatenate(ids)
                sides = [(ids[0], weight[0], every[roots_a])]
                if not same:
                    sides.append((ids[1], weight[1], every[roots_b]))
                for node, count, root in sides:
                    hit = count > 0
                    yield pa.RecordBatch.from_pydict(
                        {"node": pa.array(node[hit]), "links": pa.array(count[hit]), "root": pa.array(root[hit])}
                    )

    columns = ["d", "vectors", "label", "class", "copies"]
    hits = materialize(with_blocks(pairs, blocks, columns).mapInArrow(run, "node long, links long, root long"), "hits")
    counts = hits.groupBy("node").agg(F.sum("links").alias("links"))
    found = connected_components(hits.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = materialize(
        classes.select("class", "low", "copies")
        .join(counts.withColumnRenamed("node", "class"), "class", "left")
        .join(found.withColumnRenamed("id", "class"), "class", "left")
        .select(
            "class",
            "low",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("root"),
        ),
        "nodes",
    )
    lowest = materialize(nodes.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    answers = nodes.join(lowest, "root").select("class", "n_links", "component_id")
    of_class = materialize(
        classes.select("class", "label", "vector").join(answers, "class").drop("class"), "of_class"
    )
    told = fitting.join(of_class, ["label", "vector"]).select("id", "n_links", "component_id")
    rest = rows.where(~fit | F.col("label").isNull()).select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    return told.unionByName(rest)
