"""Ranked lexical search by bags: equal documents, as the items see them, are scored once.

A document is cut down to the words that some item has.  What is left of it, the vector of their counts and the
length norm m, decides its score for every item, so documents are grouped by it; a group is scored once and its
members are listed by ascending id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.llm.common import slices, text_rows
from lakestrata.sources.scratch import materialize

BLOCK_BYTES = 48 << 20  # words and postings of the items that are searched for in one pass
ENTRY_BYTES = 96  # of a posting with its word, in a worker, besides the word's own bytes
CELLS = 1 << 21  # scores, and postings, a worker holds at a time
EXACT = 1 << 53  # sums below are exact in doubles

# Terms are runs of letters, digits and characters beyond ASCII; only A-Z change to lower case.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_FOLD).split()


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows, terms, counts = [], [], []
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
            held: dict[bytes, int] = {}
            for t in terms_of(text):
                held[t] = held.get(t, 0) + 1
            rows += [row] * len(held)
            terms += held
            counts += held.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64())], ["row", "term", "q"]
        )


@dataclass(frozen=True)
class Postings:
    """Items of one pass: `rows[i]` is an item, word t is held by items[starts[t]:starts[t + 1]], q times."""

    terms: dict[bytes, int]
    rows: np.ndarray
    starts: np.ndarray
    items: np.ndarray
    q: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Postings:
        terms = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        at = np.array([terms[bytes(r["term"])] for r in rows], np.int64)
        item, q = np.array([r["row"] for r in rows], np.int64), np.array([r["q"] for r in rows], np.int64)
        order = np.lexsort((item, at))
        named, number = np.unique(item, return_inverse=True)
        starts = np.searchsorted(at[order], np.arange(len(terms) + 1))
        return cls(terms, named, starts, number[order], q[order])


def _bags(postings):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = postings.value.terms.get
        for batch in slices(batches, "text"):
            lengths, bags, keys = [], [], []
            for text in batch.column("text").to_pylist():
                terms = terms_of(text)
                lengths.append(len(terms))
                at = [t for t in map(known, terms) if t is not None]
                bag = b""
                if at:
                    bag = np.stack(np.unique(np.array(at, np.int64), return_counts=True), axis=1).astype("<u4").tobytes()
                bags.append(bag)
                keys.append(xxhash.xxh3_128_digest(bag))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lengths, pa.int64()), pa.array(keys, pa.binary()), pa.array(bags, pa.binary())],
                ["id", "n", "key", "bag"],
            )

    return run


def _frequencies(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in slices(batches, "bag"):
            joined = b"".join(batch.column("bag").to_pylist())
            total += np.bincount(np.frombuffer(joined, "<u4")[::2], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "df"])

    return run


def length_norm(n: Column, documents: int, terms: int) -> Column:
    """m = 100 - 75 + (75 n N) div L; the product may pass 64 bits, the quotient does not."""
    product = (75 * n).cast("decimal(20,0)") * F.lit(documents).cast("decimal(18,0)")
    return F.lit(25) + F.floor(product / F.lit(max(terms, 1)).cast("decimal(20,0)")).cast("bigint")


def _id_order(value) -> tuple:
    return (1,) if value is None else (0, value)


class Best:
    """The k best classes of each item: highest score first, then smallest first id, no id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((0, items), np.int64)
        self.number = np.zeros((0, items), np.int64)
        self.held: list[tuple] = []  # (first, key, m)

    def add(self, scores: np.ndarray, classes: list[tuple]) -> None:
        n = len(self.held)
        self.held += classes
        number = np.broadcast_to(np.arange(n, n + len(classes))[:, None], scores.shape)
        score = np.concatenate([self.score, scores])
        number = np.concatenate([self.number, number])
        place = np.empty(len(self.held), np.int64)
        place[sorted(range(len(self.held)), key=lambda i: _id_order(self.held[i][0]))] = np.arange(len(self.held))
        order = np.lexsort((place[number], -score), axis=0)[: self.k]
        self.score, number = np.take_along_axis(score, order, 0), np.take_along_axis(number, order, 0)
        used, renumbered = np.unique(number, return_inverse=True)
        self.held, self.number = [self.held[i] for i in used], renumbered.reshape(number.shape)


def _scored(postings, weights: np.ndarray, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = postings.value
        n_items, degree = len(p.rows), np.diff(p.starts)
        highest = np.bincount(p.items, p.q * weights[np.repeat(np.arange(len(degree)), degree)] * 1e6, n_items)
        exact = not len(highest) or highest.max() < EXACT
        best = Best(n_items, k)

        def score(rows: list[tuple], parts: list[np.ndarray]) -> None:
            of = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
            pairs = np.concatenate(parts).astype(np.int64)
            term, tf, m = pairs[:, 0], pairs[:, 1], np.array([r[2] for r in rows], np.int64)[of]
            value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            many = degree[term]
            ends = np.cumsum(many)
            at = np.arange(ends[-1]) - np.repeat(ends - many, many) + np.repeat(p.starts[term], many)
            cell = np.repeat(of, many) * n_items + p.items[at]
            gain = np.repeat(value, many) * p.q[at]
            if exact:
                sums = np.bincount(cell, gain, len(rows) * n_items).astype(np.int64)
            else:
                sums = np.zeros(len(rows) * n_items, np.int64)
                np.add.at(sums, cell, gain)
            best.add(sums.reshape(len(rows), n_items), rows)

        rows, parts, work, id_type = [], [], 0, None
        for batch in slices(batches, "bag"):
            id_type = batch.schema.field("first").type
            for row in batch.to_pylist():
                pairs = np.frombuffer(row["bag"], "<u4").reshape(-1, 2)
                rows.append((row["first"], row["key"], row["m"]))
                parts.append(pairs)
                work += n_items + int(degree[pairs[:, 0]].sum())
                if work > CELLS:
                    score(rows, parts)
                    rows, parts, work = [], [], 0
        if rows:
            score(rows, parts)
        if id_type is None:
            return
        rank, item = np.nonzero(best.score > 0)
        found = [best.held[i] for i in best.number[rank, item]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p.rows[item], pa.int64()),
                pa.array(best.score[rank, item], pa.int64()),
                pa.array([f[0] for f in found], id_type),
                pa.array([f[1] for f in found], pa.binary()),
                pa.array([f[2] for f in found], pa.int64()),
            ],
            ["row", "score", "first", "key", "m"],
        )

    return run


def _search_pass(docs: DataFrame, postings: Postings, k: int) -> DataFrame:
    """For the items of one pass: row (of the item), score and id of its k best documents."""
    shared = docs.sparkSession.sparkContext.broadcast(postings)
    id_type = docs.schema["id"].dataType.simpleString()
    bags = materialize(docs.mapInArrow(_bags(shared), f"id {id_type}, n long, key binary, bag binary"), "bags")
    total = bags.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    counted = bags.select("bag").mapInArrow(_frequencies(len(postings.terms)), "term long, df long")
    df = np.zeros(len(postings.terms), np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    norm = length_norm(F.col("n"), total["n"], total["terms"]).alias("m")
    held = bags.where(F.length("bag") > 0).select("id", "key", "bag", norm)
    # Grouping compares the bags themselves, not only their hashes.
    classes = materialize(held.groupBy("key", "m", "bag").agg(F.min("id").alias("first")), "bag_classes")
    scored = classes.mapInArrow(_scored(shared, weights, k), f"row long, score long, first {id_type}, key binary, m long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("first"), "key", "m")
    best = scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
    best = materialize(best, "best_classes")

    # The k first members of each class that some item lists; a document belongs to it if its bag is the same.
    named = best.select(F.col("key").alias("key_"), F.col("m").alias("m_"), F.col("first").alias("first_")).distinct()
    same_name = (F.col("key") == F.col("key_")) & (F.col("m") == F.col("m_")) & F.col("first").eqNullSafe(F.col("first_"))
    listed = classes.join(named, same_name, "left_semi").withColumnsRenamed({"key": "key_", "m": "m_", "bag": "bag_"})
    same_bag = (F.col("key") == F.col("key_")) & (F.col("m") == F.col("m_")) & (F.col("bag") == F.col("bag_"))
    by_id = Window.partitionBy("key_", "m_", "first_").orderBy(F.asc_nulls_last("id"))
    members = (
        held.join(listed.withColumnRenamed("first", "first_"), same_bag)
        .select("id", "key_", "m_", "first_")
        .withColumn("number", F.row_number().over(by_id))
        .where(F.col("number") <= k)
    )
    return best.join(members, same_name).select("row", "score", "id")


def search_ranked(
    items: DataFrame,
    docs: DataFrame,
    *,
    most: int = 10,
    item_id: str = "item_id",
    item_text: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The `most` best documents of each item: item_id, rank (from 1), doc_id, score.

    Weights are integers: w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 25 + (75 n N) div L, and a word adds
    w * ((10^9 tf) div (1000 tf + 8 m)) for each time the item has it.  Only scores above 0 are listed; equal ones
    go by ascending id, documents without an id last.

    Items are searched for in passes over the documents, so that words and postings of a pass take about
    `block_bytes` (or those of one item, if it alone has more) whatever the number of items; that is all a worker
    holds of them.  Every document counts in N, L, df and in the search.

    Null or empty texts and texts without a word match nothing; as an item they have no rows.  Every row of `items`
    is an item of its own, with its id, also where ids repeat or are null; every row of `docs` is a document, also
    where ids repeat.  Long texts are read whole, some megabytes at a time.  Empty tables give no rows.  Only the
    columns named are read, so others cannot clash.
    """
    asked = text_rows(items, item_id, item_text).withColumn("row", F.monotonically_increasing_id())
    asked = materialize(asked, "numbered_items")
    terms = asked.select("row", "text").mapInArrow(_item_terms, "row long, term binary, q long")
    terms = materialize(terms, "item_terms")
    size = terms.agg(F.coalesce(F.sum(F.length("term") + F.lit(ENTRY_BYTES)), F.lit(0)).alias("size")).first()["size"]
    passes = max(1, -(-size // block_bytes))
    rows = text_rows(docs, id_col, text_col)
    in_pass = F.pmod(F.xxhash64("row"), F.lit(passes))
    found = None
    for i in range(passes):
        chosen = terms.where(in_pass == i).collect()  # about block_bytes
        if chosen:
            part = materialize(_search_pass(rows, Postings.of(chosen), most), "hits")
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.limit(0).select(F.lit(0).cast("long").alias("row"), F.lit(0).cast("long").alias("score"), "id")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    ids = asked.select(F.col("row").alias("row_"), F.col("id").alias("item_id"))
    return ranked.join(ids, F.col("row") == F.col("row_")).select("item_id", "rank", F.col("id").alias("doc_id"), "score")
