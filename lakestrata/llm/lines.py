"""Fuzzy line dedup: SimHash of normalised lines, pigeonhole blocks, edit similarity."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.block_join import block_rows, close_blocks, number_blocks, with_blocks
from lakestrata.llm.common import fresh, only_ids, slices, text_rows
from lakestrata.llm.components import connected_components
from lakestrata.llm.hashing import BASE, SECOND_BASE, Powers
from lakestrata.sources.scratch import materialize

LEAST_WORDS = 5  # shorter lines stay as they are
MOST_BITS = 3
MOST_END_BITS = 16  # that may differ where the first or the last words of two lines are the same
LEAST_SIMILARITY = 0.8
TABLE_SHIFT = 56  # a bucket's number: table above, bits below
MOST_RANGES = 8
# Costs of a row in a table and of one comparison in a bucket, in the same unit.
ROW_COST, PAIR_COST = 1000.0, 1.0
HASH_BYTES = 1 << 18  # of text hashed at a time: the arrays then fit the processor's caches
LOOK_EVERY = 64  # columns of an edit table after which it may be given up
LONG_RUN = 48  # entries of a bucket from which all are compared at once
PAIRS_AT_ONCE = 1 << 20
TESTS_AT_ONCE = 1024  # of one line, after which the others are looked at again
CODES_HELD = 20_000  # lines
SHORT_TEXT = 40  # characters; below, an edit distance costs no more than a bound for it
PLACE_BITS, GRAM_BITS = 20, 43
LEAST_BLOCK, MOST_BLOCK, MOST_BLOCK_BYTES = 4096, 1 << 16, 4 << 20
LOST_GROUP = re.compile(rb"\x01..", re.DOTALL)  # of three characters, and the two places that it shares characters with
NORMAL = bytes.maketrans(
    (string.digits + string.punctuation + "\t\v\f\r").encode(), b"0" * 10 + b" " * (len(string.punctuation) + 4)
)


@dataclass(frozen=True)
class Tables:
    """Pigeonhole tables: bit ranges of a fingerprint, and the groups of ranges that must agree.

    At most `most` of `len(ranges)` ranges can differ, so the others agree in full,
    and some table has exactly these.
    """

    ranges: tuple[tuple[int, int], ...]
    groups: tuple[tuple[int, ...], ...]

    @staticmethod
    def of(n_ranges: int, most: int) -> Tables:
        cuts = [64 * i // n_ranges for i in range(n_ranges + 1)]
        ranges = tuple((a, b - a) for a, b in zip(cuts, cuts[1:]))
        return Tables(ranges, tuple(combinations(range(n_ranges), n_ranges - most)))

    @staticmethod
    def choose(n: int, most: int) -> Tables:
        """The cheapest tables for n fingerprints: more ranges make more rows, but smaller buckets."""

        def cost(tables: Tables) -> float:
            bits = min(sum(tables.ranges[r][1] for r in g) for g in tables.groups)
            return len(tables.groups) * (ROW_COST + PAIR_COST * n / 2 ** (bits + 1))

        return min((Tables.of(k, most) for k in range(most + 1, max(MOST_RANGES, most + 1) + 1)), key=cost)

    def buckets(self, bits: Column) -> Column:
        """The bucket of a fingerprint in each table."""
        keys = []
        for t, group in enumerate(self.groups):
            key = F.lit(0).cast("bigint")
            for r in group:
                start, width = self.ranges[r]
                part = F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
                key = F.shiftleft(key, width).bitwiseOR(part)
            keys.append(key.bitwiseOR(F.lit(t << TABLE_SHIFT).cast("bigint")))
        return F.array(*keys)

    def end_buckets(self, head: Column, tail: Column) -> Column:
        """Buckets of the fingerprints of a line's two ends, in two tables after the others."""
        mask = F.lit((1 << TABLE_SHIFT) - 1).cast("bigint")
        ends = [c.bitwiseAND(mask) for c in (head, tail)]
        tables = [F.lit(len(self.groups) + k << TABLE_SHIFT).cast("bigint") for k in range(2)]
        return F.array(*(c.bitwiseOR(t) for c, t in zip(ends, tables)))

    def first(self, differ: np.ndarray) -> np.ndarray:
        """The first table in which two fingerprints with these differing bits meet."""
        same = [(differ >> np.uint64(s)) & np.uint64((1 << w) - 1) == 0 for s, w in self.ranges]
        out = np.full(len(differ), len(self.groups))
        for t in reversed(range(len(self.groups))):
            out[np.logical_and.reduce([same[r] for r in self.groups[t]])] = t
        return out


@dataclass(frozen=True)
class Rule:
    """Which fingerprints of one bucket are close: `most` bits in a table of ranges, `most_end` in one of line ends."""

    tables: Tables
    most: int
    most_end: int

    def limits(self, table: np.ndarray) -> np.ndarray:
        return np.where(table < len(self.tables.groups), self.most, self.most_end)

    def least(self, table: np.ndarray) -> np.ndarray:
        """Equal fingerprints are close in the first table of ranges and in those of line ends."""
        return ((table > 0) & (table < len(self.tables.groups))).astype(np.int64)

    def new(self, differ: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Of differing bits within the limit: does no earlier table of ranges hold the pair?"""
        few = np.bitwise_count(differ) <= self.most
        out = ~few
        out[few] = self.tables.first(differ[few]) == table[few]
        return out


def normalised(text: str | None) -> bytes:
    """Lower case, digits as 0, ASCII punctuation and white space other than line feeds as space."""
    return (text or "").lower().encode().translate(NORMAL)


def normal_lines(text: str | None) -> list[list[bytes]]:
    """Words of each normalised line."""
    return [line.split() for line in normalised(text).split(b"\n")]


class LineHasher:
    """Word hashes, line keys and SimHashes of many texts at once, by sums of powers."""

    def __init__(self):
        self.letters, self.one, self.two = Powers(BASE), Powers(BASE), Powers(SECOND_BASE)

    def words(self, raw: list[bytes]) -> tuple[np.ndarray, ...]:
        """Hashes of the words of normalised texts; per line with a word: number among all lines, first word, words."""
        values = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        feed = values == 10
        edge = np.flatnonzero(np.diff(feed | (values == 32), prepend=True))  # beginnings and ends of words in turn
        start, stop = edge[::2], edge[1::2]
        hashes = self.letters.ranges(self.letters.sums(np.add(values, 1, dtype=np.uint64)), start, stop)
        last = np.searchsorted(start, np.flatnonzero(feed))  # words up to the end of each line
        words = np.diff(last, prepend=0)
        line = np.flatnonzero(words)
        return hashes, line, (last - words)[line], words[line]

    def keys(self, hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> np.ndarray:
        last = first + words
        key = [p.ranges(p.sums(hashes), first, last) for p in (self.one, self.two)] if len(first) else [hashes, hashes]
        key[1] = key[1] + words.astype(np.uint64)
        return np.stack(key, axis=1)

    def line_keys(self, lines: Sequence[str]) -> list[bytes]:
        """The keys alone, of normalised lines with words."""
        hashes, _, first, words = self.words([line.encode() for line in lines])
        return [k.tobytes() for k in self.keys(hashes, first, words)]

    def read(self, texts: Sequence[str | None]) -> dict[str, np.ndarray]:
        """Per line with a word: owner (text), line (from 0), words, key (two numbers), bits, head and tail bits."""
        raw = [normalised(t) for t in texts]
        hashes, line, first, words = self.words(raw)
        # Lines of a text: one more than its line feeds.
        lines = np.array([r.count(b"\n") + 1 for r in raw], np.int64)
        begin = np.cumsum(lines) - lines
        owner = np.searchsorted(begin, line, side="right") - 1
        bits, head, tail = end_bits(hashes, first, words)
        return {
            "owner": owner, "line": line - begin[owner], "words": words,
            "key": self.keys(hashes, first, words), "bits": bits, "head": head, "tail": tail,
        }

    def key_of(self, words: list[bytes]) -> bytes:
        """Key of one line of words."""
        return self.read([b" ".join(words).decode()])["key"].tobytes()


def end_words(words: np.ndarray) -> np.ndarray:
    """Words of an end of a line: 1, 2, 3, 4, 6, 8, 12, ..., at most half of the words.

    In steps, so that a word more or less in a line seldom changes the length of its ends.
    """
    half = np.maximum(words // 2, 1)
    step = 1 << np.maximum(np.frexp(half.astype(np.float64))[1] - 2, 0)
    return half // step * step


def bit_counts(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many hashes of each run have each bit; the runs follow one another.

    Eight lanes count eight bits each in the bytes of one number, over runs of up to 255.
    """
    held = np.flatnonzero(count)
    first, pieces = (np.cumsum(count) - count)[held], -(-count[held] // 255)
    row = np.repeat(np.arange(len(held)), pieces)
    before = np.cumsum(pieces) - pieces
    begin = first[row] + 255 * (np.arange(len(row)) - np.repeat(before, pieces))
    sums = np.empty((len(row), 8), np.uint64)
    for lane in range(8):
        sums[:, lane] = np.add.reduceat((hashes >> np.uint64(lane)) & np.uint64(0x0101010101010101), begin)
    found = sums.view(np.uint8).reshape(-1, 8, 8).transpose(0, 2, 1).reshape(-1, 64).astype(np.int32)
    if len(row) > len(held):
        found = np.add.reduceat(found, before, axis=0)
    if len(held) == len(count):
        return found
    out = np.zeros((len(count), 64), np.int32)
    out[held] = found
    return out


def end_bits(hashes: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits set in over half of the hashes of each line, of its first words and of its last words, as signed numbers."""
    if not len(first):
        return (np.empty(0, np.int64),) * 3
    ends = end_words(words)
    runs = np.stack([ends, np.where(words > 1, words - 2 * ends, 0), np.where(words > 1, ends, 0)], axis=1)
    counts = bit_counts(hashes, runs.ravel()).reshape(-1, 3, 64)

    def majority(found: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.packbits(2 * found > of[:, None], axis=1, bitorder="little").view("<i8").ravel()

    bits = majority(counts.sum(axis=1), words)
    return bits, majority(counts[:, 0], ends), np.where(words > 1, majority(counts[:, 2], ends), bits)


def shared_start(a: Sequence, b: Sequence) -> int:
    """Length of the longest common beginning, by comparisons of halves."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def without_shared_ends(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    begin = shared_start(a, b)
    a, b = a[begin:], b[begin:]
    end = shared_start(a[::-1], b[::-1])
    return a[: len(a) - end], b[: len(b) - end]


def edit_distance(a: Sequence, b: Sequence, most: float = float("inf")) -> int:
    """Levenshtein distance of texts or lists, a column of the table at a time in the bits of one integer.

    Where all ways through a column are longer than `most`, the shortest of them is returned.
    """
    a, b = without_shared_ends(a, b)
    if not a or not b:
        return len(a) + len(b)
    places: dict = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    rise, fall = full, 0
    for j, c in enumerate(b):
        if j % LOOK_EVERY == 0 and j and most < len(a) + len(b):
            least = least_through(rise, fall, j, len(a), len(b))
            if least > most:
                return least
        equal = places.get(c, 0)
        level = (((equal & rise) + rise) ^ rise) | equal | fall
        more = ((fall | ~(level | rise)) << 1 | 1) & full
        rise, fall = ((level & rise) << 1 | ~(level | more)) & full, more & level
    return len(b) + rise.bit_count() - fall.bit_count()


def least_through(rise: int, fall: int, column: int, m: int, n: int) -> int:
    """Smallest distance that a way through this column can still have."""
    up, down = (
        np.unpackbits(np.frombuffer(x.to_bytes(m // 8 + 1, "little"), np.uint8), bitorder="little")[:m].astype(np.int64)
        for x in (rise, fall)
    )
    held = column + np.concatenate([[0], np.cumsum(up - down)])
    return int((held + np.abs((m - np.arange(m + 1)) - (n - column))).min())


def most_edits(a: str, b: str, least: float) -> float:
    return (1 - least) * max(len(a), len(b), 1) + 1e-9


def surely_similar(a: str, b: str, least: float) -> bool:
    """Whether edits of whole words prove that two texts are similar; quicker than a table of characters."""
    most = most_edits(a, b, least)
    if abs(len(a) - len(b)) > most:
        return False
    wa, wb = without_shared_ends(a.split(" "), b.split(" "))
    if len(wa) == len(wb) and sum(max(len(x), len(y)) for x, y in zip(wa, wb) if x != y) <= most:
        return True  # words replaced one by one are no fewer edits
    # A word that is added, left out or replaced costs its characters and a space at most; so many of the longest may.
    costs = np.cumsum(sorted((len(w) + 1 for w in (*wa, *wb)), reverse=True))
    words = int(np.searchsorted(costs, most, side="right"))
    return abs(len(wa) - len(wb)) <= words and edit_distance(wa, wb, words) <= words


def similar(a: str, b: str, least: float) -> bool:
    """1 - edit distance / longer length >= least."""
    most = most_edits(a, b, least)
    if abs(len(a) - len(b)) > most:
        return False
    return surely_similar(a, b, least) or edit_distance(a, b, most) <= most


class Labels:
    """Which entries are connected: the smaller of two groups takes the label of the larger one."""

    def __init__(self, n: int):
        self.of = np.arange(n)
        self.members: dict[int, list[np.ndarray]] = {}

    def join(self, x: int, y: int) -> None:
        a, b = int(self.of[x]), int(self.of[y])
        one, two = self.members.pop(a, [np.array([a])]), self.members.pop(b, [np.array([b])])
        if sum(map(len, one)) < sum(map(len, two)):
            a, one, two = b, two, one
        moved = np.concatenate(two)
        self.of[moved] = a
        self.members[a] = [*one, moved] if len(one) < 32 else [np.concatenate([*one, moved])]


class Pairs:
    """Which of one text and many others can be within `least` of similarity, by their groups of three characters.

    A group that no edit touches stands in the other text as well, moved by so many places as characters were added or
    left out before it; these and the ones that restore the length after it are no more than all edits.  Groups without
    a common character that are not found there take an edit each.
    """

    def __init__(self, texts: Sequence[str], least: float):
        self.texts, self.least, self.codes = texts, least, {}

    def code(self, x: int) -> np.ndarray:
        """Hashes of the groups; two with one hash count as equal, which rules out less."""
        if x not in self.codes:
            if len(self.codes) >= CODES_HELD:
                self.codes.clear()
            letters = np.frombuffer(self.texts[x].encode("utf-32-le"), "<u4").astype(np.uint64)
            groups = (letters[:-2] << np.uint64(42) | letters[1:-1] << np.uint64(21) | letters[2:]) * np.uint64(BASE)
            self.codes[x] = (groups >> np.uint64(64 - GRAM_BITS) << np.uint64(PLACE_BITS)).view(np.int64)
        return self.codes[x]

    def possible(self, x: int, others: np.ndarray) -> np.ndarray:
        size = len(self.texts[x])
        if not SHORT_TEXT <= size < 1 << PLACE_BITS - 2:
            return others
        sizes = np.array([len(self.texts[y]) for y in others.tolist()])
        most = ((1 - self.least) * np.maximum(sizes, size) + 1e-9).astype(np.int64)
        fits = np.abs(sizes - size) <= most
        others, sizes, most = others[fits], sizes[fits], most[fits]
        if not len(others) or sizes.min() < 3 or sizes.max() >= 1 << PLACE_BITS - 1:
            return others
        own = np.sort(self.code(x) + np.arange(size - 2))
        codes = np.concatenate([self.code(y) for y in others.tolist()])
        begin = np.cumsum(sizes - 2) - (sizes - 2)
        place = np.arange(len(codes)) - np.repeat(begin, sizes - 2)
        back, ahead = (np.repeat((most + d) // 2, sizes - 2) for d in (sizes - size, size - sizes))
        at = np.searchsorted(own, codes + np.maximum(place - back, 0))
        lost = (at == len(own)) | (own[np.minimum(at, len(own) - 1)] > codes + place + ahead)
        fits = np.add.reduceat(lost, begin, dtype=np.int64) <= 3 * most
        flags, stop = lost.tobytes(), begin + sizes - 2
        for k in np.flatnonzero(fits).tolist():
            # The last group may lack its two places.
            fits[k] = len(LOST_GROUP.findall(flags[begin[k] : stop[k]] + b"\0\0")) <= most[k]
        return others[fits]


def line_rows(docs: DataFrame, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """(id, line, key, bits, head, tail) of every line with enough words; lines are numbered from 0."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, line long, key binary, bits long, head long, tail long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = LineHasher()
        for part in slices(batches, "text", HASH_BYTES):
            found = hasher.read(part.column("text").to_pylist())
            keep = np.flatnonzero(found["words"] >= least_words)
            keys = np.ascontiguousarray(found["key"][keep])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id").take(pa.array(found["owner"][keep])),
                    pa.array(found["line"][keep]),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(keep), [None, pa.py_buffer(keys.tobytes())]).cast(
                        pa.binary()
                    ),
                    *(pa.array(found[c][keep]) for c in ("bits", "head", "tail")),
                ],
                names=["id", "line", "key", "bits", "head", "tail"],
            )

    return text_rows(docs, id_col, text_col).mapInArrow(run, schema)


Work = Callable[[dict], Iterator[pa.RecordBatch]]


def bucket_blocks(rows: DataFrame, n: int, extra: list[str], work: Work, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows (bucket, bits, extra ...) sorted by bucket, in blocks: what `work` makes of each, and what goes on.

    As the rows are sorted, only the first and the last bucket of a block can have rows in others.  Their rows go
    on as: low, high, buckets, entries, extra lists.  With extra columns `work` gets the other rows here, so that no
    hot bucket is left to the task that sorted it; without, all of them, equal rows as one, which `twice` says.
    """
    size = block_rows(n, LEAST_BLOCK, MOST_BLOCK, 64)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in extra}
    lists = {c: pa.list_(pa.binary() if k == "binary" else pa.string()) for c, k in kinds.items()}
    numbers = {c: pa.int64() for c in ("part", "seq", "low", "high")}
    ends = {**numbers, "buckets": pa.binary(), "entries": pa.binary(), **lists}
    made = {f.split()[0]: pa.int64() if f.split()[1] == "long" else pa.binary() for f in schema.split(", ")}
    names = [*ends, *made]

    def whole(held: dict[str, pa.Array], n: int) -> pa.RecordBatch:
        kind = {**ends, **made}
        return pa.RecordBatch.from_arrays([held[c] if c in held else pa.nulls(n, kind[c]) for c in names], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            heavy = sum(batch.column(c).nbytes for c in extra) // max(1, batch.num_rows)
            step = max(1, min(size, MOST_BLOCK_BYTES // max(1, heavy)))
            for i in range(0, batch.num_rows, step):
                piece = batch.slice(i, step)
                buckets, bits = (piece.column(c).to_numpy() for c in ("bucket", "bits"))
                low, high = buckets[0], buckets[-1]
                twice = None
                if extra:
                    inner = slice(*np.searchsorted(buckets, [low + 1, max(high, low + 1)]).tolist())
                else:
                    first = np.flatnonzero((np.diff(buckets, prepend=~low) != 0) | (np.diff(bits, prepend=bits[0]) != 0))
                    twice = np.diff(first, append=len(bits)) > 1
                    buckets, bits = buckets[first], bits[first]
                    inner = slice(0, len(buckets))
                row = {"a": 0, "b": 0, "twice": twice}
                for c, v in (("buckets", buckets), ("entries", bits)):
                    row[f"a_{c}"] = row[f"b_{c}"] = v[inner].astype("<i8").tobytes()
                for c in extra:
                    row[f"a_{c}"] = piece.column(c).slice(inner.start, inner.stop - inner.start).to_pylist()
                for out in work(row) if inner.start < inner.stop else ():
                    yield whole(dict(zip(out.schema.names, out.columns)), out.num_rows)
                at = np.flatnonzero((buckets == low) | (buckets == high))
                held = {c: pa.array([int(x)], pa.int64()) for c, x in zip(numbers, (part, seq, low, high))}
                held["buckets"] = pa.array([buckets[at].astype("<i8").tobytes()], pa.binary())
                held["entries"] = pa.array([bits[at].astype("<i8").tobytes()], pa.binary())
                for c in extra:
                    held[c] = pa.array([piece.column(c).take(pa.array(at)).to_pylist()], lists[c])
                yield whole(held, 1)
                seq += 1

    columns = "part long, seq long, low long, high long, buckets binary, entries binary"
    columns += "".join(f", {c} array<{k}>" for c, k in kinds.items())
    order = ["bucket", "bits", *extra[:1]]
    tasks = n // size if extra else max(min(64, n // size), n // (4 * MOST_BLOCK))
    spread = rows.select("bucket", "bits", *extra).repartitionByRange(max(1, tasks), *order)
    found = spread.sortWithinPartitions(*order).mapInArrow(run, f"{columns}, {schema}")
    found = materialize(found, "line_blocks")
    # Few rows in many files: dealt out anew, they are read by few tasks.
    blocks = materialize(found.where(F.col("part").isNotNull()).select(*ends).repartition("part"), "block_ends")
    return found.where(F.col("part").isNull()).select(*made), number_blocks(blocks)


def with_partners(row: dict, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Which entries of blocks a and b have one within the limits in the other block in their bucket."""
    same = row["a"] == row["b"]
    ka, kb = (np.frombuffer(row[f"{s}_buckets"], "<i8") for s in ("a", "b"))
    va, vb = (np.frombuffer(row[f"{s}_entries"], "<u8") for s in ("a", "b"))
    in_a = np.zeros(len(ka), bool)
    in_b = in_a if same else np.zeros(len(kb), bool)
    limit, least = rule.limits(ka >> TABLE_SHIFT), rule.least(ka >> TABLE_SHIFT)

    def compare(own: slice, other: slice) -> None:
        step = max(1, PAIRS_AT_ONCE // max(1, other.stop - other.start))
        for k in range(own.start, own.stop, step):
            stop = min(k + step, own.stop)
            differ = np.bitwise_count(va[k:stop, None] ^ vb[None, other])
            near = (differ <= limit[k]) & (differ >= least[k])
            if same:  # not itself
                near[np.arange(stop - k), np.arange(k, stop) - other.start] = False
            in_a[k:stop] |= near.any(axis=1)
            in_b[other] |= near.any(axis=0)

    if not same:
        for bucket in np.intersect1d(ka, kb).tolist():
            compare(*(slice(*np.searchsorted(k, [bucket, bucket + 1]).tolist()) for k in (ka, kb)))
        return in_a, in_b
    edges = np.flatnonzero(np.diff(ka)) + 1
    starts, stops = np.append(0, edges), np.append(edges, len(ka))
    long = stops - starts >= LONG_RUN
    for start, stop in zip(starts[long].tolist(), stops[long].tolist()):
        compare(slice(start, stop), slice(start, stop))
    short = np.repeat(~long, stops - starts)
    for step in range(1, LONG_RUN):
        near = short[step:] & (ka[step:] == ka[:-step])
        if not near.any():
            break
        near &= np.bitwise_count(va[step:] ^ va[:-step]) <= limit[step:]
        in_a[step:] |= near
        in_a[:-step] |= near
    in_a |= row["twice"] & (least == 0)
    return in_a, in_b


def close_and_apart(row: dict, rule: Rule, labels: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """An entry, and those of its bucket within the limit that do not have its label when it is their turn.

    Entries of b are counted on from those of a; each pair comes in its first table of ranges, if in one.  An entry costs a comparison of
    labels with the rest of its bucket, so a large group that is connected early costs little more than that.
    """
    same = row["a"] == row["b"]
    ka, kb = (np.frombuffer(row[f"{s}_buckets"], "<i8") for s in ("a", "b"))
    v = np.frombuffer(row["a_entries"], "<u8")
    if not same:
        v = np.concatenate([v, np.frombuffer(row["b_entries"], "<u8")])

    def near(x: int, start: int, stop: int, bucket: int) -> np.ndarray:
        others = np.flatnonzero(labels[start:stop] != labels[x]) + start
        differ = v[others] ^ v[x]
        table = bucket >> TABLE_SHIFT
        close = np.bitwise_count(differ) <= rule.limits(table)
        others, differ = others[close], differ[close]
        return others[rule.new(differ, np.full(len(others), table))] if len(others) else others

    def short_runs(short: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The same for all runs of a block that are short, their pairs compared at once."""
        table, one, two = ka >> TABLE_SHIFT, [], []
        limit, i = rule.limits(table), np.flatnonzero(short[:-1])
        for step in range(1, LONG_RUN):
            i = i[i + step < len(ka)]
            i = i[ka[i] == ka[i + step]]  # sorted: a run that ended stays ended
            differ = v[i] ^ v[i + step]
            close = np.bitwise_count(differ) <= limit[i]
            at = i[close][rule.new(differ[close], table[i[close]])]
            one.append(at)
            two.append(at + step)
        one, two = np.concatenate(one), np.concatenate(two)
        order = np.lexsort((two, one))
        one, two = one[order], two[order]
        edges = np.flatnonzero(np.diff(one, prepend=-1))
        for begin, end in zip(edges.tolist(), [*edges[1:].tolist(), len(one)]):
            x, others = int(one[begin]), two[begin:end]
            others = others[labels[others] != labels[x]]
            if len(others):
                yield x, others

    buckets = np.unique(ka) if same else np.intersect1d(ka, kb)
    if same:
        starts = np.searchsorted(ka, buckets)
        sizes = np.diff(starts, append=len(ka))
        yield from short_runs(np.repeat(sizes < LONG_RUN, sizes))
        buckets = buckets[sizes >= LONG_RUN]
    for bucket in buckets.tolist():
        start, stop = np.searchsorted(ka, [bucket, bucket + 1]).tolist()
        low, high = (start, stop) if same else (np.searchsorted(kb, [bucket, bucket + 1]) + len(ka)).tolist()
        for x in range(start, stop):
            others = near(x, max(low, x + 1) if same else low, high, bucket)
            if len(others):
                yield x, others


def join_buckets(rows: DataFrame, n: int, extra: list[str], work: Work, schema: str) -> DataFrame:
    """Runs `work` on every block and on every pair of blocks that share a bucket; hot buckets span many blocks.

    `n`: number of rows.  A block is worked on where it was sorted, with what `bucket_blocks` leaves out coming after as
    pairs.  `schema`: numbers (long) and binary columns.
    """
    own, blocks = bucket_blocks(rows, n, extra, work, schema)
    merge = {"low": F.min, "high": F.max}

    def near(a, b) -> Column:
        return (a("low") <= b("high")) & (b("low") <= a("high"))

    pairs = close_blocks(blocks, merge, near)
    if not extra:
        pairs = pairs.where(F.col("a") != F.col("b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(batch.slice(i, 1).to_pylist()[0])

    across = with_blocks(pairs, blocks, ["buckets", "entries", *extra]).mapInArrow(run, schema)
    return own.unionByName(across)


def partnered(lines: DataFrame, rule: Rule) -> DataFrame:
    """(bucket, bits) of fingerprints that have another line within the limit there."""
    buckets = F.concat(rule.tables.buckets(F.col("bits")), rule.tables.end_buckets(F.col("head"), F.col("tail")))
    rows = lines.select("bits", F.explode(buckets).alias("bucket"))
    n = lines.count() * (len(rule.tables.groups) + 2)

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        for side, held in zip("a" if row["a"] == row["b"] else "ab", with_partners(row, rule)):
            at = np.flatnonzero(held)
            columns = [np.frombuffer(row[f"{side}_{c}"], "<i8")[at] for c in ("buckets", "entries")]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "bits"])

    return join_buckets(rows, n, [], work, "bucket long, bits long").distinct()


def line_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, text) normalised, for rows (key, id, line) that name one place of each line."""
    places = wanted.groupBy("id").agg(F.collect_set("line").alias("lines"))
    rows = only_ids(text_rows(docs, id_col, text_col), places.select("id"), "id").join(
        places.withColumnRenamed("id", "place").hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("place"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = LineHasher()
        for part in slices(batches, "text", 1 << 20):
            texts: list[str] = []
            for text, lines in zip(part.column("text").to_pylist(), part.column("lines").to_pylist()):
                raw = normalised(text).split(b"\n")
                chosen = [b" ".join(raw[k].split()).decode() for k in sorted(lines) if k < len(raw)]
                texts += [c for c in chosen if c]
            arrays = [pa.array(hasher.line_keys(texts), pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "text"])

    found = rows.select("text", "lines").mapInArrow(run, "key binary, text string")
    return found.groupBy("key").agg(F.min("text").alias("text"))  # repeated ids give a line twice


def similar_links(candidates: DataFrame, rule: Rule, least: float) -> DataFrame:
    """Links (a, b) of line keys that connect all pairs of `candidates` that pass both tests.

    `candidates`: bucket, bits, key, text.  Pairs that are connected already need no test.
    """

    def work(row: dict) -> Iterator[pa.RecordBatch]:
        same = row["a"] == row["b"]
        texts, keys = (row[f"a_{c}"] if same else row[f"a_{c}"] + row[f"b_{c}"] for c in ("text", "key"))
        labels, pairs, kept = Labels(len(keys)), Pairs(texts, least), []
        for x, others in close_and_apart(row, rule, labels.of):
            y, step = int(others[0]), 1
            if surely_similar(texts[x], texts[y], least):
                labels.join(x, y)
                kept.append((keys[x], keys[y]))
                others = others[labels.of[others] != labels.of[x]]
            while len(others):
                for y in pairs.possible(x, others[:step]).tolist():
                    if labels.of[x] != labels.of[y] and similar(texts[x], texts[y], least):
                        labels.join(x, y)
                        kept.append((keys[x], keys[y]))
                others = others[step:]
                others = others[labels.of[others] != labels.of[x]]
                step = min(4 * step, TESTS_AT_ONCE)
        if kept:
            ends = [pa.array(k, pa.binary()) for k in zip(*kept)]
            yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return join_buckets(candidates, candidates.count(), ["key", "text"], work, "a binary, b binary")


def removed_places(
    docs: DataFrame, least_words: int, most: int, most_end: int, least: float, id_col: str, text_col: str
) -> DataFrame:
    """(id, line) of every line that is not the kept one of its group."""
    rows = materialize(line_rows(docs, least_words, id_col, text_col), "line_rows")
    prints = [F.min(c).alias(c) for c in ("bits", "head", "tail")]
    lines = materialize(rows.groupBy("key").agg(F.min(F.struct("id", "line")).alias("place"), *prints), "lines")
    rule = Rule(Tables.choose(lines.count(), most), most, most_end)
    active = materialize(partnered(lines, rule), "partnered")
    by_ranges = F.shiftright("bucket", TABLE_SHIFT) < len(rule.tables.groups)
    own = by_ranges | F.array_contains(rule.tables.end_buckets(F.col("head"), F.col("tail")), F.col("bucket"))
    joined = active.hint("merge").join(lines, "bits").where(own)
    near = materialize(joined.select("bucket", "bits", "key", "place.id", "place.line"), "near")
    wanted = materialize(near.select("key", "id", "line").distinct(), "wanted")
    texts = line_texts(docs, wanted, id_col, text_col)
    candidates = materialize(near.select("bucket", "bits", "key").join(texts, "key"), "candidates")
    groups = connected_components(similar_links(candidates, rule, least))
    members = materialize(wanted.join(groups.withColumnRenamed("id", "key"), "key"), "members")
    first = members.groupBy("component").agg(F.min(F.struct("id", "line", "key")).alias("first"))
    lost = members.join(first.select(F.col("first.key").alias("key")), "key", "left_anti")
    # A place stays if it is the first one of more lines than lost ones; rows with equal ids can have several lines in one.
    places = (
        rows.select("id", "line", F.lit(0).alias("n"))
        .unionAll(lines.select("place.id", "place.line", F.lit(1)))
        .unionAll(lost.select("id", "line", F.lit(-1)))
    )
    return places.groupBy("id", "line").agg(F.sum("n").alias("n")).where(F.col("n") == 0).select("id", "line")


def dedup_lines(
    docs: DataFrame,
    *,
    least_words: int = LEAST_WORDS,
    most_bits: int = MOST_BITS,
    most_end_bits: int = MOST_END_BITS,
    least_similarity: float = LEAST_SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of `docs` with the text less its repeated lines, then n_lines and n_removed (long).

    Lines (split at line feeds) are normalised: lower case, digits as 0, ASCII
    punctuation and runs of white space as one space.  Two lines are linked if they
    are equal, or if their edit similarity reaches `least_similarity` and the
    SimHashes of their words differ in at most `most_bits` bits, or in at most
    `most_end_bits` where the SimHashes of their first or of their last words are
    the same (`end_words` of them, half a line at most).  Of each connected
    group the occurrence with the smallest (id, line number) stays; the others go
    with their line feed.  Lines of fewer than `least_words` words stay.  Equal
    lines are joined by a 128-bit hash, ends by 56 bits of theirs.  The search is
    exact for these limits.

    Defined cases: a null text stays null and has no lines; a text may become empty,
    its row stays.  Rows with equal ids are one document: a line number that goes in
    one of them goes in all, and equal rows stay or go together.  A null id sorts
    first.  An empty table gives no rows.  Names that `docs` has already get a
    trailing underscore.
    """
    if not 0 <= most_bits < MOST_RANGES:
        raise ValueError(f"most_bits must be from 0 to {MOST_RANGES - 1}")
    removed = removed_places(docs, least_words, most_bits, most_end_bits, least_similarity, id_col, text_col)
    columns = docs.columns
    n_lines = fresh(columns, "n_lines")
    n_removed = fresh([*columns, n_lines], "n_removed")
    held, key = fresh(columns, "removed_lines"), fresh(columns, "removed_id")
    by_id = materialize(
        removed.groupBy(F.col("id").alias(key)).agg(F.collect_set("line").alias(held)), "removed_lines"
    )
    # A row for each id with the numbers of its lines is hashed; texts need no sort then.
    joined = docs.join(by_id.hint("shuffle_hash"), F.col(id_col).eqNullSafe(F.col(key)), "left").drop(key)
    text, stay = F.col(text_col), fresh([*columns, n_lines, n_removed, held], "staying_lines")
    every = fresh([*columns, n_lines, n_removed, held, stay], "every_line")
    kept = F.filter(every, lambda _, i: ~F.array_contains(held, i.cast("bigint")))
    counted = joined.withColumn(every, F.split(text, "\n", -1)).withColumns(
        {
            n_lines: F.when(text.isNull(), 0).otherwise(F.size(every)).cast("bigint"),
            stay: F.when(F.col(held).isNotNull(), kept),
        }
    )
    gone = F.when(F.col(stay).isNull(), 0).otherwise(F.col(n_lines) - F.size(stay)).cast("bigint")
    return (
        counted.withColumn(n_removed, gone)
        .withColumn(text_col, F.when(F.col(stay).isNull(), text).otherwise(F.array_join(stay, "\n")))
        .select(*(F.col(f"`{c}`") for c in columns), n_lines, n_removed)
    )
