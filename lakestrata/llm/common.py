"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SLICE_BYTES = 8 << 20


def fresh(taken: Iterable[str], name: str) -> str:
    """`name`, with underscores appended until no column of `taken` is called so."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names, so that other columns can neither clash nor be read."""
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009 to U+000D; none for null."""
    return [] if text is None else text.encode().split()


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that `column` holds about `most` bytes at a time; one row at least."""
    for batch in batches:
        begin, held = 0, 0
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + (size or 0) > most:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += size or 0
        if begin < batch.num_rows:
            yield batch.slice(begin)


def uniform(*parts: Column | str | int) -> Column:
    """A number in (0, 1) with 52 bits, fixed by the parts; the same in any engine with MD5."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    key = F.concat_ws("|", *(F.coalesce(t, F.lit("")) for t in texts))
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("bigint")
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, the value being computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def running_starts(sizes: Column) -> Column:
    """For each element of an array of numbers the sum of those before it.

    Appending to an array copies it, so the sums are made over stretches of about the cube root of the length,
    first of the stretches' totals and then within each: close to linear work for any length that a row can have.
    """
    no_numbers = F.array().cast("array<bigint>")

    def starts(numbers: Column, begin: Column) -> Column:
        first = F.struct(begin.cast("bigint").alias("at"), no_numbers.alias("starts"))
        return F.aggregate(
            numbers,
            first,
            lambda done, x: F.struct((done["at"] + x).alias("at"), F.concat(done["starts"], F.array(done["at"])).alias("starts")),
            lambda done: done["starts"],
        )

    def cut(numbers: Column) -> Column:
        length = F.greatest(F.lit(32), F.ceil(F.cbrt(F.size(numbers)))).cast("int")
        last = F.greatest(F.ceil(F.size(numbers) / length).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(numbers, k * length + 1, length))

    def joined(stretches: Column) -> Column:
        totals = F.transform(stretches, lambda s: F.aggregate(s, F.lit(0).cast("bigint"), lambda a, x: a + x))
        return F.flatten(F.zip_with(stretches, starts(totals, F.lit(0)), starts))

    return bound(sizes.cast("array<bigint>"), lambda numbers: bound(cut(numbers), joined))


BROADCAST_ROWS = 200_000  # ids; some megabytes


def only_ids(rows: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """`rows` less some that no id of `ids` (distinct) names, to spare a later join on the id a part of its shuffle.

    Few ids are broadcast, their number being counted first; of more ids all rows go on.
    """
    if ids.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return rows
    wanted = F.broadcast(ids.select(F.col(ids.columns[0]).alias("only_id")))
    return rows.join(wanted, F.col(id_col).eqNullSafe(F.col("only_id")), "left_semi")


LARGE_ROWS = {
    # Shuffle files of a job that has written its table go at once, not when the driver forgets the plan.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A worker and the memory beside the heap hold so many rows at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "32",
}


@contextmanager
def large_rows(spark: SparkSession) -> Iterator[None]:
    """Settings for jobs whose rows hold whole arrays; for tables that are written inside."""
    before = {key: spark.conf.get(key, None) for key in LARGE_ROWS}
    for key, value in LARGE_ROWS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
