"""SimHash near-duplicates through a hierarchical index in Gray order."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakestrata.llm.block_join import block_rows, close_blocks, number_blocks, with_blocks
from lakestrata.llm.common import slices, text_rows
from lakestrata.llm.components import connected_components
from lakestrata.sources.scratch import materialize

SEED = 42
FAN = 16  # entries under an index node inside a block
LEAST_BLOCK, MOST_BLOCK = 1024, 1 << 18
PAIRS_AT_ONCE = 2048  # node pairs opened at a time, each into FAN * FAN


def fingerprint(text: str | None, shingle: int) -> int:
    """Bits set in over half the hashes of the text's word shingles, A-Z in lower case."""
    words = [] if text is None else text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist())
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i : i + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long) of whole texts; zero without words."""
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("fingerprint", LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [fingerprint(t, shingle) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.int64())], names=schema.names)

    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)


def gray_rank(bits: Column) -> Column:
    """Position of the bit pattern in Gray order, made to sort as a signed number."""
    for step in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, step))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


class GrayIndex:
    """Index of fingerprints in Gray order: a node holds the bits that all entries below it share."""

    def __init__(self, bits: np.ndarray):
        self.all_set, self.any_set = [bits], [bits]
        while len(self.all_set[-1]) > FAN:
            for rows, join in ((self.all_set, np.bitwise_and), (self.any_set, np.bitwise_or)):
                starts = np.arange(0, len(rows[-1]), FAN)
                rows.append(join.reduceat(rows[-1], starts))

    def size(self, level: int) -> int:
        return len(self.all_set[min(level, len(self.all_set) - 1)])

    def shared(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pattern, and mask of the bits that are shared."""
        low = self.all_set[level][nodes]
        return low, ~(low ^ self.any_set[level][nodes])


def close_entries(a: GrayIndex, b: GrayIndex, same: bool, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of entries with at most `most` differing bits (of one index: i < j).

    A pair of nodes carries the differences counted so far and the mask of bits
    they were counted on; going down adds the newly shared bits only, and a pair
    whose differences exceed `most` drops out with all that lies below.
    """
    depth = max(len(a.all_set), len(b.all_set)) - 1
    ia, ib = (np.arange(len(x.all_set[-1])) for x in (a, b))
    ia, ib = np.repeat(ia, len(ib)), np.tile(ib, len(ia))
    stack = [(depth, ia, ib, np.zeros(len(ia), np.uint8), np.zeros(len(ia), np.uint64))]
    while stack:
        level, ia, ib, held, seen = stack.pop()
        if same and level:
            keep = ia <= ib
            ia, ib, held, seen = ia[keep], ib[keep], held[keep], seen[keep]
        pattern_a, mask_a = a.shared(min(level, len(a.all_set) - 1), ia)
        pattern_b, mask_b = b.shared(min(level, len(b.all_set) - 1), ib)
        both = mask_a & mask_b
        held = held + np.bitwise_count((pattern_a ^ pattern_b) & both & ~seen)
        keep = held <= most
        ia, ib, held, both = ia[keep], ib[keep], held[keep], both[keep]
        for i in range(0, len(ia), PAIRS_AT_ONCE):
            part = slice(i, i + PAIRS_AT_ONCE)
            if level <= 1:
                yield from close_leaves(a, b, level, ia[part], ib[part], same, most)
                continue
            below_a, below_b = below(a, level, ia[part]), below(b, level, ib[part])
            shape = (len(below_a), below_a.shape[1], below_b.shape[1])
            na = np.broadcast_to(below_a[:, :, None], shape).ravel()
            nb = np.broadcast_to(below_b[:, None, :], shape).ravel()
            wide = shape[1] * shape[2]
            more, mask = np.repeat(held[part], wide), np.repeat(both[part], wide)
            ok = (na < a.size(level - 1)) & (nb < b.size(level - 1))
            if not ok.all():
                na, nb, more, mask = na[ok], nb[ok], more[ok], mask[ok]
            stack.append((level - 1, na, nb, more, mask))


def below(index: GrayIndex, level: int, nodes: np.ndarray) -> np.ndarray:
    """Entries of the next lower level under the nodes; a lower tree waits at its top."""
    if level >= len(index.all_set):
        return nodes[:, None]
    return nodes[:, None] * FAN + np.arange(FAN)


def close_leaves(
    a: GrayIndex, b: GrayIndex, level: int, ia: np.ndarray, ib: np.ndarray, same: bool, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole distances of the entries under pairs of lowest nodes."""
    ra, rb = (below(x, level, i) if level else i[:, None] for x, i in ((a, ia), (b, ib)))
    ea, eb = (x.all_set[0][np.minimum(r, x.size(0) - 1)] for x, r in ((a, ra), (b, rb)))
    k, i, j = np.nonzero(np.bitwise_count(ea[:, :, None] ^ eb[:, None, :]) <= most)
    i, j = ra[k, i], rb[k, j]
    keep = (i < a.size(0)) & (j < b.size(0))
    if same:
        keep &= i < j
    if keep.any():
        yield i[keep], j[keep]


class Forest:
    """Union-find that reports which links joined two groups."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def gray_blocks(bits: DataFrame, rows: int, parts: int) -> DataFrame:
    """Fingerprints by Gray rank, `rows` to a block: part, seq, entries (binary), all_set, any_set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, np.empty(0, np.int64)

        def block(values: np.ndarray) -> pa.RecordBatch:
            low, high = np.bitwise_and.reduce(values), np.bitwise_or.reduce(values)
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int64()),
                    "seq": pa.array([seq], pa.int64()),
                    "entries": pa.array([values.astype("<i8").tobytes()], pa.binary()),
                    "all_set": pa.array([int(low)], pa.int64()),
                    "any_set": pa.array([int(high)], pa.int64()),
                }
            )

        for batch in batches:
            held = np.concatenate([held, batch.column(0).to_numpy(zero_copy_only=False)])
            while len(held) >= 2 * rows:
                yield block(held[:rows])
                held, seq = held[rows:], seq + 1
        if len(held):
            yield block(held)

    rank = gray_rank(F.col("fingerprint"))
    sorted_bits = bits.select("fingerprint", rank.alias("rank")).repartitionByRange(parts, "rank")
    return sorted_bits.sortWithinPartitions("rank").select("fingerprint").mapInArrow(
        run, "part long, seq long, entries binary, all_set long, any_set long"
    )


def gray_links(bits: DataFrame, most: int) -> DataFrame:
    """Links (a, b) that connect all fingerprints of `bits` (distinct, written) within `most` differing bits.

    Blocks of the Gray order join recursively; two blocks are searched by their
    indexes.  Of the pairs found in a pair of blocks only those that join two
    groups are passed on, so no group of near copies is listed pair by pair.
    """
    n = bits.count()
    rows = block_rows(n, LEAST_BLOCK, MOST_BLOCK)
    blocks = number_blocks(materialize(gray_blocks(bits, rows, max(1, n // rows)), "gray_blocks"))
    merge = {
        "all_set": lambda c: F.bit_and(c),
        "any_set": lambda c: F.bit_or(c),
    }

    def near(a, b) -> Column:
        differ = a("all_set").bitwiseXOR(b("all_set"))
        loose = F.bitwise_not(
            a("all_set").bitwiseXOR(a("any_set")).bitwiseOR(b("all_set").bitwiseXOR(b("any_set")))
        )
        return F.bit_count(differ.bitwiseAND(loose)) <= most

    pairs = close_blocks(blocks, merge, near)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a"] == row["b"]
                left, right = (np.frombuffer(row[f"{s}_entries"], "<u8") for s in ("a", "b"))
                index = GrayIndex(left)
                other, forest, kept = index if same else GrayIndex(right), Forest(), []
                for i, j in close_entries(index, other, same, most):
                    offset = 0 if same else len(left)
                    joins = [forest.join(x, y + offset) for x, y in zip(i.tolist(), j.tolist())]
                    kept.append((left[i[joins]], right[j[joins]]))
                if kept:
                    ends = [pa.array(np.concatenate(x).view("<i8")) for x in zip(*kept)]
                    yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return with_blocks(pairs, blocks, ["entries"]).mapInArrow(run, "a long, b long")


def simhash_classes(
    docs: DataFrame, *, shingle: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint long, component_id): documents linked by fingerprints within `most` bits.

    Documents with equal fingerprints are one class; only classes are compared.
    `component_id` is the smallest id that links reach, the own one included.

    Defined cases: null and empty texts have fingerprint zero and link like any
    other; a null id never is a component's id, and where no member has an id the
    component's is null; repeated rows are repeated; an empty table gives no rows.
    Other columns are not read.
    """
    marked = materialize(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "fingerprints")
    classes = materialize(marked.groupBy("fingerprint").agg(F.min("id").alias("low")), "classes")
    found = connected_components(gray_links(classes.select("fingerprint"), most))
    placed = classes.join(found.withColumnRenamed("id", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "low", F.coalesce("component", "fingerprint").alias("root")
    )
    placed = materialize(placed, "placed")
    lowest = materialize(placed.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    of_class = materialize(placed.join(lowest, "root").select("fingerprint", "component_id"), "of_class")
    return marked.join(of_class, "fingerprint").select("id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, *, shingle: int = 4, most: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the rows of the document with its smallest id.

    Rows with equal ids are one document.  Rows without id stay if some of them
    are linked to no document with an id.
    """
    classes = simhash_classes(docs, shingle=shingle, most=most, id_col=id_col, text_col=text_col)
    kept = classes.where(F.col("id").eqNullSafe(F.col("component_id"))).select(F.col("id").alias("kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("kept_id")), "left_semi")
