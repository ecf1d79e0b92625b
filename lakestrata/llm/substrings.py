"""Substring dedup: FM-indexes over shards of passages, and intervals matched in smaller documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakestrata.llm.common import fresh, only_ids, slices, text_rows
from lakestrata.llm.fm_index import FmIndex
from lakestrata.llm.hashing import BASE, SECOND_BASE, Powers
from lakestrata.sources.scratch import materialize

SHARD_WORDS = 400_000  # an index is closed at the first anchor beyond
LEAST_HOT = 500
MOST_PIECES = 25_000  # different passages around one anchor that one index may take
# What a passage is known by: its anchor and a hash of its words.
PIECE = ["anchor", "h1"]


def anchor_words(window: int) -> int:
    """Length of the word groups that serve as anchors."""
    return max(1, window * 3 // 10)


class WordStream:
    """Words of some texts end to end, with their hashes and the bounds of their texts."""

    def __init__(self, texts: list[str | None], letters: Powers):
        words = [(t or "").encode().split() for t in texts]
        self.count = np.array([len(w) for w in words], np.int64)
        self.stop = np.cumsum(self.count)
        self.begin = self.stop - self.count
        buffer = b" ".join(b" ".join(w) for w in words if w)
        if not buffer:
            self.hashes = np.empty(0, np.uint64)
            return
        values = np.frombuffer(buffer, np.uint8)
        space = np.flatnonzero(values == 32)
        start, stop = np.append(0, space + 1), np.append(space, len(values))
        sums = letters.sums(values.astype(np.uint64) + np.uint64(1))
        self.hashes = letters.ranges(sums, start, stop)


def running(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each run of `width` values."""
    held, have = values, 1
    while have * 2 <= width:
        held, have = pick(held[:-have], held[have:]), have * 2
    rest = width - have
    return pick(held[: len(held) - rest], held[rest:]) if rest else held


def anchors(stream: WordStream, window: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """Anchors of a stream: texts, hashes, and the passages (first word, words) of the windows they own.

    An anchor is a group of words whose hash is the smallest of a window's
    groups; the window is its own.  Equal windows have owners with equal hashes.
    The windows of an anchor follow one another, as only a smaller hash ends them.
    """
    k = anchor_words(window)
    width = window - k + 1
    n = len(stream.hashes)
    none = np.empty(0, np.int64)
    if n < window:
        return none, np.empty(0, np.uint64), none, none
    at = np.arange(n - k + 1)
    groups = powers.ranges(powers.sums(stream.hashes), at, at + k)
    least = running(groups, width, np.minimum)  # for each place where a window might begin
    owner = np.repeat(np.arange(len(stream.count)), stream.count)
    inside = stream.stop[owner[: len(least)]] >= np.arange(len(least)) + window
    # A group is an anchor if the largest minimum among its windows within the text is its own hash.
    zero = np.zeros(width - 1, np.uint64)
    shown = np.concatenate([zero, np.where(inside, least, np.uint64(0)), zero])
    place = np.flatnonzero((running(shown, width, np.maximum) == groups) & (groups > 0))
    found = groups[place]
    first, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for back in range(width):  # windows that begin `back` words before the anchor
        own = shown[place + width - 1 - back] == found
        first[own] = place[own] - back
        count += own
    return owner[place], found, first, count + window - 1


def anchor_rows(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(anchor, h1, id, at, n): every anchor with the passage of its windows: hash, first word, number of words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, powers = Powers(BASE), Powers(SECOND_BASE)
        for part in slices(batches, "text", 2 << 20):
            stream = WordStream(part.column("text").to_pylist(), letters)
            owner, found, start, n = anchors(stream, window, powers)
            hashes = passage_hashes(stream, powers, start, start + n)
            own = [found.view(np.int64), hashes, None, start - stream.begin[owner], n]
            columns = [part.column("id").take(pa.array(owner)) if x is None else pa.array(x) for x in own]
            yield pa.RecordBatch.from_arrays(columns, names=[*PIECE, "id", "at", "n"])

    rows = text_rows(docs, id_col, text_col).where(F.col("id").isNotNull())
    rows = rows.withColumn("id", F.col("id").cast("bigint"))
    return rows.mapInArrow(run, "anchor long, h1 long, id long, at long, n long")


def passage_hashes(stream: WordStream, powers: Powers, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of word ranges that also tell their length."""
    if not len(start):
        return np.empty(0, np.int64)
    return (powers.ranges(powers.sums(stream.hashes), start, stop) + (stop - start).astype(np.uint64)).view(np.int64)


def fetch(docs: DataFrame, places: DataFrame, id_col: str, text_col: str, window: int = 0) -> DataFrame:
    """The words of passages (anchor, h1, id, at, n) from their texts, column `words`.

    With a window, in their place the windows of the passages: offset, and hashes w1, w2.
    Few ids are sent to the texts; where rows have equal ids the hash tells which text is meant.
    """
    asked = F.collect_list(F.struct(*PIECE, "at", "n"))
    wanted = materialize(places.groupBy("id").agg(asked.alias("wanted")), "wanted")
    texts = text_rows(docs, id_col, text_col).where(F.col("text").isNotNull())
    rows = only_ids(texts, wanted.select("id"), "id").join(wanted, "id").select("text", "wanted")
    schema = "anchor long, h1 long, " + ("offset long, w1 long, w2 long" if window else "words string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, one, two = Powers(BASE), Powers(SECOND_BASE), Powers(BASE)
        for part in slices(batches, "text", 1 << 20):
            asked = part.column("wanted")
            counts = asked.value_lengths().to_numpy(zero_copy_only=False)
            columns = {c: asked.flatten().field(c).to_numpy(zero_copy_only=False) for c in [*PIECE, "at", "n"]}
            texts, row = [], 0
            for text, count in zip(part.column("text").to_pylist(), counts.tolist()):
                words = text.encode().split()
                for a, n in zip(columns["at"][row : row + count].tolist(), columns["n"][row : row + count].tolist()):
                    texts.append(b" ".join(words[a : a + n]).decode())
                row += count
            stream = WordStream(texts, letters)
            here = stream.count > 0
            start, stop = stream.begin[here], stream.stop[here]
            same = passage_hashes(stream, one, start, stop) == columns["h1"][here]
            kept, start, stop = np.flatnonzero(here)[same], start[same], stop[same]
            piece = [columns[c][kept] for c in PIECE]
            if window:
                count = stop - start - window + 1
                offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                begin = np.repeat(start, count) + offset
                hashes = [passage_hashes(stream, p, begin, begin + window) for p in (two, one)]
                made, names = [*(np.repeat(c, count) for c in piece), offset, *hashes], [*PIECE, "offset", "w1", "w2"]
            else:
                made, names = [*piece, pa.array([texts[i] for i in kept.tolist()], pa.string())], [*PIECE, "words"]
            yield pa.RecordBatch.from_arrays([pa.array(m) for m in made], names=names)

    return rows.mapInArrow(run, schema)


def indexed(passages: DataFrame, window: int) -> DataFrame:
    """(anchor, h1, start, stop, low): for the windows of each passage the smallest document with that window.

    `passages`: anchor, h1, low (smallest document that holds it), words.  Passages are
    dealt to shards by anchor; every shard builds an FM-index of its passages and
    streams them through it.  Windows count from the passage's first word; a row stands
    for a run of windows, from start to stop - 1, with equal `low`.
    """
    names = [*PIECE, "start", "stop", "low"]
    parts = max(1, passages.count() * window // SHARD_WORDS)
    sorted_rows = passages.repartitionByRange(parts, "anchor").sortWithinPartitions("anchor")

    def shard(held: list[tuple]) -> pa.RecordBatch:
        number: dict[str, int] = {}
        words = [
            np.array([number.setdefault(w, len(number) + 1) for w in row[3].split(" ")], np.int64) for row in held
        ]
        index = FmIndex(words, np.array([row[2] for row in held], np.int64), window)
        out = []
        for row, (_, low) in zip(held, index.stream(words)):
            edges = (np.flatnonzero(low[1:] != low[:-1]) + 1).tolist()
            for a, b in zip([0, *edges], [*edges, len(low)]):
                if low[a] != index.NOWHERE:
                    out.append((*row[:2], a, b, int(low[a])))
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*PIECE, "low", "words"))):
                if size >= SHARD_WORDS and row[0] != last:
                    yield shard(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + row[3].count(" ") + 1, row[0]
        if held:
            yield shard(held)

    return sorted_rows.select(*PIECE, "low", "words").mapInArrow(
        run, "anchor long, h1 long, start long, stop long, low long"
    )


def searched(docs: DataFrame, pieces: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """`indexed` for pieces (anchor, h1, h2, first), whose words are fetched where they occur first."""
    places = pieces.select(*PIECE, "first.id", "first.at", "first.n")
    words = fetch(docs, places, id_col, text_col).groupBy(*PIECE).agg(F.min("words").alias("words"))
    low = pieces.select(*PIECE, F.col("first.id").alias("low"))
    return indexed(materialize(words.join(low, PIECE), "passages"), window)


def hot_windows(docs: DataFrame, pieces: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """As `searched`, for pieces of hot anchors: only single windows that two documents hold are indexed.

    Each window's hash is the anchor it is dealt by, so that no shard takes all that
    surrounds one passage.
    """
    places = pieces.select(*PIECE, "first.id", "first.at", "first.n")
    ends = pieces.select(*PIECE, "first", "last")
    hashed = materialize(
        fetch(docs, places, id_col, text_col, window).distinct().join(ends, PIECE), "hot_windows"
    )
    place = F.struct(
        F.col("first.id").alias("id"), (F.col("first.at") + F.col("offset")).alias("at"), F.lit(window).cast("bigint").alias("n")
    )
    shared = hashed.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max("last").alias("last"))
    single = shared.where(F.col("first.id") < F.col("last")).select(
        F.col("w1").alias("anchor"), F.col("w2").alias("h1"), "first"
    )
    found = searched(docs, materialize(single, "hot_singles"), window, id_col, text_col)
    lows = materialize(found.select(F.col("anchor").alias("w1"), F.col("h1").alias("w2"), "low"), "hot_lows")
    told = materialize(hashed.join(lows, ["w1", "w2"]).select(*PIECE, "offset", "low"), "hot_told")
    # A passage has at most as many windows as a window has words; those with equal `low` become runs.
    place_in_run = F.row_number().over(Window.partitionBy(*PIECE, "low").orderBy("offset"))
    runs = told.withColumn("run", F.col("offset") - place_in_run).groupBy(*PIECE, "low", "run")
    return runs.agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("stop")).select(
        *PIECE, "start", "stop", "low"
    )


def repeated_windows(
    docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, start, stop): word intervals covered by windows that also start in a document with a smaller id.

    1. Anchors of all texts; an anchor that lies in one document only owns no repeated
       window, and goes.
    2. The passage of an anchor holds the windows it owns.  Equal passages of an anchor
       become one, with its smallest and largest document.
    3. Shards of passages, by anchor, are indexed and searched: `indexed`.  The passages of
       a hot anchor, more than twice a task's share or than one index may take, go window
       by window: `hot_windows`.
    4. An occurrence loses the windows whose smallest document is smaller than its own.
    """
    spark = docs.sparkSession
    rows = materialize(anchor_rows(docs, window, id_col, text_col), "anchors")
    ends = rows.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    in_many = materialize(ends.where(F.col("a") < F.col("b")).select("anchor"), "in_many")
    active = materialize(rows.join(in_many, "anchor"), "active")
    first = F.min(F.struct("id", "at", "n")).alias("first")
    pieces = materialize(active.groupBy(*PIECE).agg(first, F.max("id").alias("last")), "pieces")
    share = 2 * pieces.count() // int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = min(MOST_PIECES, max(LEAST_HOT, share))
    counts = pieces.groupBy("anchor").count()
    hot = materialize(counts.where(F.col("count") > most).select("anchor"), "hot")
    if hot.isEmpty():
        found = searched(docs, pieces, window, id_col, text_col)
    else:
        cold = searched(docs, pieces.join(hot, "anchor", "left_anti"), window, id_col, text_col)
        own = pieces.join(hot, "anchor", "left_semi")
        found = cold.unionByName(hot_windows(docs, own, window, id_col, text_col))
    found = materialize(found, "found")
    covered = active.join(found, PIECE).where(F.col("low") < F.col("id"))
    start, stop = F.col("at") + F.col("start"), F.col("at") + F.col("stop") + (window - 1)
    return covered.select("id", start.alias("start"), stop.alias("stop"))


def dedup_substrings(
    docs: DataFrame, *, window: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of `docs` with the kept words, joined by one space, as text, then n_words and n_removed (long).

    Words are runs of characters other than space and U+0009 to U+000D.  A word goes
    if a window of `window` consecutive words covers it whose words also start in a
    document with a smaller id.  Windows are judged on the input.

    Defined cases: ids are integers; rows without id lose nothing and make others lose
    nothing.  Rows with equal ids are no smaller than each other, but lose the same
    places.  A null text stays null and has no words.  Texts shorter than the window stay.
    An empty table gives no rows.  Names that `docs` has already get a trailing underscore.
    """
    spans = repeated_windows(docs, window=window, id_col=id_col, text_col=text_col)
    columns = docs.columns
    held, key = fresh(columns, "removed_spans"), fresh(columns, "removed_id")
    n_words = fresh(columns, "n_words")
    n_removed = fresh([*columns, n_words], "n_removed")
    by_id = materialize(
        spans.groupBy(F.col("id").alias(key)).agg(F.collect_list(F.struct("start", "stop")).alias(held)), "spans"
    )
    joined = docs.join(by_id, F.col(id_col) == F.col(key), "left").drop(key)
    schema = StructType([*docs.schema.fields, StructField(n_words, LongType()), StructField(n_removed, LongType())])
    at = columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col, 4 << 20):
            texts, counts, removed, row = [], [], [], 0
            spans = part.column(held)
            sizes = spans.value_lengths().fill_null(0).to_pylist()
            start, stop = (spans.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("start", "stop"))
            for text, size in zip(part.column(text_col).to_pylist(), sizes):
                words = [] if text is None else text.encode().split()
                stay = words
                if size:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, np.minimum(start[row : row + size], len(words)), 1)
                    np.add.at(edge, np.minimum(stop[row : row + size], len(words)), -1)
                    stay = list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))
                    row += size
                texts.append(None if text is None else b" ".join(stay).decode())
                counts.append(len(words))
                removed.append(len(words) - len(stay))
            arrays = [part.column(c) for c in columns]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts), pa.array(removed)], names=schema.names)

    return joined.mapInArrow(run, schema)
