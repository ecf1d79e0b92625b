"""Interpolated modified Kneser-Ney language model, counted in Spark and kept as sorted arrays of hashes.

Texts become blocks of tokens.  A block sends the hashes of its different n-grams, sorted and with its own counts, to
shards that are ranges of hashes, so no frequent word or history meets in one place.  A shard adds the counts up, keeps
them as a part of the model, and answers each block in the order of its hashes.  Every n-gram is credited to its shorter
ones by one block alone, the first that holds it; that gives continuation counts and the sums of histories level by
level, from the longest n-grams down.  Scoring sends the hashes of all blocks to the stored arrays, which the workers
map into memory, and brings the counts back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lakestrata.llm.common import large_rows, slices
from lakestrata.llm.hash_arrays import MappedArrays, cuts, give_back, pack, row_stream, unpack
from lakestrata.llm.hashing import mixed
from lakestrata.sources.scratch import materialize

BLOCK_TOKENS = 1_200_000  # of a block: some 100 MB in a worker
SHARD_TOKENS = 2_500_000  # tokens a shard stands for, so at most as many hashes while it is added up
PIECE_KEYS = 500_000  # of a stored row of the model
SLICE = 1 << 17  # tokens worked on at a time

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
BEGIN, END = xxhash.xxh3_64_intdigest(b"\r"), xxhash.xxh3_64_intdigest(b"\n")  # no word holds these
_STEP = np.uint64(0x9E3779B97F4A7C15)

# Level -1 marks the block itself; answers and model rows have the length of their n-grams.
ROWS = "block long, level int, shard int, data array<binary>"


def _tokenised(most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, learn, lengths, parts, held, known = [], [], [], [], 0, {}

        def block() -> pa.RecordBatch:
            local = np.concatenate(parts)
            order = np.argsort(-np.bincount(local, minlength=len(known)), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))  # frequent words get small numbers
            words = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))[order]
            data = [pack(np.array(learn)), pack(np.array(lengths)), pack(words), pack(place[local])]
            columns = [pa.array([x], t) for x, t in ((number, pa.int64()), (ids, pa.list_(id_type)), (held, pa.int64()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([data], pa.list_(pa.binary()))], ["block", "ids", "tokens", "data"])

        for batch in slices(batches, "text"):
            id_type = batch.schema.field("id").type
            columns = (batch.column(c).to_pylist() for c in ("id", "text", "learn"))
            for id_, text, learns in zip(*columns):
                words = [] if text is None else text.encode().translate(_LOWER).split()
                ids.append(id_)
                learn.append(int(learns))
                lengths.append(len(words) + 1)
                parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
                parts.append(np.array([known.setdefault(b"\n", len(known))]))
                held += len(words) + 1
                if held >= most:
                    yield block()
                    number += 1
                    ids, learn, lengths, parts, held, known = [], [], [], [], 0, {}
                    give_back()
        if ids:
            yield block()
        parts, known = [], {}
        give_back()

    return run


def token_blocks(
    docs: DataFrame, learn: Column, *, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Written blocks of documents: their ids, whether the model learns from each, and their tokens."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(learn.cast("boolean"), F.lit(False)).alias("learn"),
    )
    ddl = f"block long, ids array<{rows.schema['id'].dataType.simpleString()}>, tokens long, data array<binary>"
    return materialize(rows.mapInArrow(_tokenised(block_tokens), ddl), "token_blocks")


class Grams:
    """The different n-grams of a block's documents, per length, and where its tokens have them."""

    def __init__(self, data: Sequence[bytes], *, learning: bool):
        self.learn, self.lengths, words, local = (unpack(d) for d in data)
        self.lengths = self.lengths.astype(np.int64)
        if learning:
            chosen = np.repeat(self.learn > 0, self.lengths)
            local, self.lengths = local[chosen], self.lengths[self.learn > 0]
        self.hashes = words[local.astype(np.int32)]
        starts = np.cumsum(self.lengths) - self.lengths
        self.first = np.zeros(len(self.hashes), bool)
        self.first[starts] = True
        self.position = np.arange(len(self.hashes), dtype=np.int32) - np.repeat(starts.astype(np.int32), self.lengths)
        self.levels: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def level(self, n: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Sorted keys of the n-grams; the index of the one that ends at each token; that of n marks of a beginning."""
        if n not in self.levels:
            size = len(self.hashes)
            key, opening = np.zeros(size + 1, np.uint64), np.zeros(1, np.uint64)
            for a in range(0, size, SLICE):
                b = min(a + SLICE, size)
                for back in reversed(range(n)):
                    at = np.arange(a - back, b - back)
                    word = np.where(self.position[a:b] >= back, self.hashes[at], np.uint64(BEGIN))
                    key[a:b] = mixed(key[a:b] * _STEP + word)
            for _ in range(n):
                opening = mixed(opening * _STEP + np.uint64(BEGIN))
            key[size] = opening[0]
            keys, index = np.unique(key, return_inverse=True)
            index = index.astype(np.int32)
            self.levels[n] = keys, index[:-1], int(index[-1])
        return self.levels[n]

    def histories(self, n: int) -> np.ndarray:
        """Index among the n-grams of the n tokens before each token."""
        _, index, opening = self.level(n)
        before = np.empty(len(index), np.int32)
        before[1:] = index[:-1]
        before[self.first] = opening
        return before


def _batch(block: int, level: int, shard: int, data: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([block], pa.int64()), pa.array([level], pa.int32()), pa.array([shard], pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([data], pa.list_(pa.binary()))], ["block", "level", "shard", "data"])


def _credits(grams: Grams, level: int, order: int, answers: list[list[bytes]]) -> list[np.ndarray]:
    """A block's part of the counts at one level: by occurrences at the longest, by owned longer n-grams below."""
    keys, index, _ = grams.level(level)
    size = len(keys)
    if level == order:
        return [np.bincount(index, minlength=size)]
    _, longer, _ = grams.level(level + 1)
    count, owned = (np.concatenate([unpack(a[i]) for a in answers]).astype(np.int64) for i in range(2))
    at = np.full(len(count), -1)
    at[longer] = np.arange(len(longer))  # a token where each longer n-gram ends
    credited = np.flatnonzero((owned > 0) & (count > 0) & (at >= 0))
    at, count = at[credited], count[credited]
    before = grams.histories(level)[at]
    sums = [np.bincount(index[at], minlength=size), np.bincount(before, count, size)]
    sums += [np.bincount(before[np.minimum(count, 3) == k], minlength=size) for k in (1, 2, 3)]
    return sums + ([np.bincount(index, minlength=size)] if level == 1 else [])


def _of_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, dict[int, list[list[bytes]]]]]:
    """Each block with its answers by level, in the order of the shards; rows come sorted."""
    for _, rows in groupby(row_stream(batches), key=lambda r: r["block"]):
        block, answers = next(rows), {}
        for r in rows:
            answers.setdefault(r["level"], []).append(r["data"])
        yield block, answers


def _send_counts(level: int, order: int, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, answers in _of_blocks(batches):
            grams = Grams(block["data"], learning=True)
            if not len(grams.hashes):
                continue
            sums = _credits(grams, level, order, answers.get(level + 1, []))
            keys = grams.level(level)[0]
            ends = cuts(keys, shards)
            for shard in range(shards):
                a, b = ends[shard], ends[shard + 1]
                yield _batch(block["block"], level, shard, [pack(keys[a:b], ascending=True), *(pack(s[a:b]) for s in sums)])
            del grams, sums, keys, block, answers
            give_back()

    return run


def _add_up(level: int, *, answer: bool):
    """Model rows (block -1), a row of counts of counts (block -2), and answers to the blocks: count, owned."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in groupby(row_stream(batches), key=lambda r: r["shard"]):
            blocks, keys, sums = [], [], []
            for r in rows:
                blocks.append(r["block"])
                keys.append(unpack(r["data"][0], ascending=True))
                sums.append([unpack(d) for d in r["data"][1:]])
            held, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = [np.bincount(at, np.concatenate(c).astype(float), len(held)).astype(np.int64) for c in zip(*sums)]
            owner = np.empty(len(held), np.int64)
            ends = np.cumsum([len(k) for k in keys])
            for i in reversed(range(len(blocks))):
                owner[at[ends[i] - len(keys[i]) : ends[i]]] = blocks[i]  # rows come by block: the smallest stays
            some = np.flatnonzero(reduce(np.logical_or, (t > 0 for t in total)))
            for a in range(0, len(some), PIECE_KEYS):
                piece = some[a : a + PIECE_KEYS]
                yield _batch(-1, level, shard, [pack(held[piece], ascending=True), *(pack(t[piece]) for t in total)])
            count = total[0]
            of_count = [int((count == k).sum()) for k in (1, 2, 3, 4)] + [int((count > 2).sum()), int(count.sum())]
            raw = total[-1] if level == 1 else np.zeros(0, np.int64)
            yield _batch(-2, level, shard, [pack(np.array([*of_count, int((raw > 0).sum()), int(raw.sum())]))])
            if answer:
                for block, a, b in zip(blocks, ends - [len(k) for k in keys], ends):
                    yield _batch(block, level, shard, [pack(count[at[a:b]]), pack(owner[at[a:b]] == block)])
            del keys, sums, held, at, total, count, owner, raw
            give_back()

    return run


def _with_answers(blocks: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Rows of `blocks`, each followed by its answers, in one task."""
    rows = blocks.select("block", F.lit(-1).alias("level"), F.lit(-1).alias("shard"), "data", "ids")
    if answers is None:
        return rows
    none = F.lit(None).cast(blocks.schema["ids"].dataType).alias("ids")
    return rows.unionByName(answers.select("block", "level", "shard", "data", none)).repartition("block").sortWithinPartitions(
        "block", "level", "shard"
    )


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float, float]:
    """What is taken from a count of 0, 1, 2, and 3 or more, by the counts of counts; fixed values where they give none."""
    usual = (0.0, 0.5, 1.0, 1.5)
    if min(ones, twos, threes, fours) == 0:
        return usual
    y = ones / (ones + 2 * twos)
    found = (0.0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return found if all(0 <= d <= k for k, d in enumerate(found)) else usual


@dataclass(frozen=True)
class NgramModel:
    """`rows`: per length and range of hashes the sorted hashes and their counts; the rest are a few sums."""

    rows: DataFrame
    order: int
    shards: int
    discounts: tuple[tuple[float, float, float, float], ...]  # per length, from 1
    singles: tuple[int, int, int, int]  # words with a count of 1, 2, 3 or more at length 1, and the sum of counts
    words: int  # different tokens learned from
    tokens: int  # all tokens learned from


def train_model(blocks: DataFrame, *, order: int = 2, shard_tokens: int = SHARD_TOKENS) -> NgramModel:
    """Model of the documents that `token_blocks` marks as learned from; all n-grams count, none are cut off."""
    if order < 1:
        raise ValueError("an n-gram has one word at least")
    held = blocks.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-held // shard_tokens))
    levels, sums, answers = [], {}, None
    for level in range(order, 0, -1):
        sent = _with_answers(blocks, answers).mapInArrow(_send_counts(level, order, shards), ROWS)
        added = sent.repartition("shard").sortWithinPartitions("shard", "block").mapInArrow(_add_up(level, answer=level > 1), ROWS)
        added = materialize(added, f"grams_{level}")
        levels.append(added.where(F.col("block") == -1))
        answers = added.where(F.col("block") >= 0)
        sums[level] = np.zeros(8, np.int64)
        for r in added.where(F.col("block") == -2).select("data").toLocalIterator():  # eight numbers a shard
            sums[level] += unpack(bytes(r["data"][0])).astype(np.int64)
    ones = sums[1]
    return NgramModel(
        reduce(DataFrame.unionByName, levels),
        order,
        shards,
        tuple(discounts(*map(int, sums[n][:4])) for n in range(1, order + 1)),
        (int(ones[0]), int(ones[1]), int(ones[4]), int(ones[5])),
        int(ones[6]),
        int(ones[7]),
    )


def _ask(order: int, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in row_stream(batches):
            grams = Grams(block["data"], learning=False)
            for level in range(1, order + 1):
                keys = grams.level(level)[0]
                ends = cuts(keys, shards)
                for shard in range(shards):
                    asked = keys[ends[shard] : ends[shard + 1]]
                    yield _batch(block["block"], level, shard, [pack(asked, ascending=True)])
            del grams, keys, asked, block
            give_back()

    return run


def _look_up(order: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (level, shard), rows in groupby(row_stream(batches), key=lambda r: (r["level"], r["shard"])):
            arrays = MappedArrays(2 if level == order else 7 if level == 1 else 6)
            for r in rows:
                if r["block"] == -1:
                    keys, *counts = r["data"]
                    arrays.append(unpack(keys, ascending=True), *map(unpack, counts))
                else:
                    found = arrays.look_up(unpack(r["data"][0], ascending=True))
                    yield _batch(r["block"], level, shard, [pack(f) for f in found])
            arrays.close()
            give_back()

    return run


def _score(model: NgramModel, id_type: pa.DataType):
    order, taken, singles, words, tokens = model.order, model.discounts, model.singles, model.words, model.tokens

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, answers in _of_blocks(batches):
            grams = Grams(block["data"], learning=False)

            def column(level: int, i: int) -> np.ndarray:
                return np.concatenate([unpack(a[i]) for a in answers[level]]).astype(np.int64)

            def take(values: np.ndarray, at: np.ndarray, a: int) -> np.ndarray:
                return values[at[a : a + SLICE]]

            n = len(grams.lengths)
            doc = np.repeat(np.arange(n, dtype=np.int32), grams.lengths)
            held = {level: [column(level, i) for i in range(len(answers[level][0]))] for level in range(1, order + 1)}
            answers.clear()
            ends = {level: grams.level(level)[1] for level in range(1, order + 1)}
            befores = {level: grams.histories(level - 1) for level in range(2, order + 1)}
            n_known, base_score, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for a in range(0, len(doc), SLICE):
                seen, of = take(held[1][-1], ends[1], a), doc[a : a + SLICE]
                p = np.full(len(of), 1 / (words + 1))
                for level in range(1, order + 1):
                    count, less = take(held[level][0], ends[level], a), np.array(taken[level - 1])
                    if level == 1:
                        total = np.full(len(of), singles[3])
                        held_back = np.full(len(of), float(np.dot(less[1:], singles[:3])))
                    else:
                        _, histories, *kinds = held[level - 1][:5]
                        total = take(histories, befores[level], a)
                        held_back = sum(less[k] * take(kinds[k - 1], befores[level], a) for k in (1, 2, 3))
                    known = total > 0
                    own = np.maximum(count - less[np.minimum(count, 3)], 0)
                    p[known] = (own[known] + held_back[known] * p[known]) / total[known]
                n_known += np.bincount(of[seen > 0], minlength=n)
                base_score += np.bincount(of, np.log10((seen + 0.5) / (tokens + 0.5 * (words + 1))), n)
                score += np.bincount(of, np.log10(p), n)
            result = [
                pa.array(block["ids"], id_type),
                pa.array(grams.learn > 0),
                pa.array(grams.lengths, pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base_score),
                pa.array(score),
            ]
            yield pa.RecordBatch.from_arrays(result, ["id", "learned", "n_tokens", "n_known", "base_score", "score"])
            del grams, block, held, ends, befores, doc, result
            give_back()

    return run


def score_blocks(blocks: DataFrame, model: NgramModel) -> DataFrame:
    """A row per document of the blocks: id, learned, n_tokens, n_known, base_score, score."""
    asked = blocks.select("block", F.lit(0).alias("level"), F.lit(0).alias("shard"), "data").mapInArrow(
        _ask(model.order, model.shards), ROWS
    )
    both = asked.unionByName(model.rows).repartition("level", "shard").sortWithinPartitions("level", "shard", "block")
    answers = materialize(both.mapInArrow(_look_up(model.order), ROWS), "answers")
    ids = blocks.schema["ids"].dataType.elementType
    ddl = f"id {ids.simpleString()}, learned boolean, n_tokens long, n_known long, base_score double, score double"
    return _with_answers(blocks, answers).mapInArrow(_score(model, to_arrow_type(ids)), ddl)


def score_texts(
    docs: DataFrame,
    learn: Column,
    *,
    order: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Learn from the rows for which `learn` is true, score all: id, learned, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Tokens are the words, A-Z in lower case, then one end.  `score` is the log10 probability of all tokens of a text
    by the n-grams of up to `order` tokens, `perplexity` its inverse per token; `base_score` is that of single tokens,
    0.5 added to every count.  A history reaches back to marks of the beginning.  Words never learned share what the
    discounts leave for one more word.

    A null or empty text has the end alone.  A null `learn` counts as false.  Every row counts as a document, repeated
    ones and those without an id too.  Where nothing is learned, every token has probability 1.  A long text is one
    block, and costs the memory of its tokens.  An empty table gives no rows; other columns are not read.
    """
    with large_rows(docs.sparkSession):
        blocks = token_blocks(docs, learn, id_col=id_col, text_col=text_col, block_tokens=block_tokens)
        model = train_model(blocks, order=order, shard_tokens=shard_tokens)
        scored = materialize(score_blocks(blocks, model), "scores")
    return scored.select(
        "id",
        "learned",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
