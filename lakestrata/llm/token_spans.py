"""Token counts of sections: encode a document once, then join token spans to section spans."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakestrata.llm.bpe import read_ranks
from lakestrata.llm.common import fresh, slices

Section = tuple[str, int, int]  # name, start and end in code points
RULES = ("first", "most")


def line_sections(text: str) -> list[Section]:
    """Lines with their line feed, named by number from 0."""
    out, at = [], 0
    for i, line in enumerate(text.split("\n")):
        stop = min(at + len(line) + 1, len(text))
        if stop > at or not i:
            out.append((str(i), at, stop))
        at = stop
    return out


def byte_offsets(text: str, raw: bytes) -> np.ndarray | None:
    """Byte offset of each code point and of the end; None if they are equal."""
    if len(raw) == len(text):
        return None
    heads = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(heads, len(raw))


def clipped(sections: Sequence[Section], size: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Order of the sections by start, and disjoint bounds: the earlier section keeps what two claim."""
    order = sorted(range(len(sections)), key=lambda i: (sections[i][1], i))
    start, stop, at = [], [], 0
    for i in order:
        a = min(max(sections[i][1], at), size)
        b = min(max(sections[i][2], a), size)
        start.append(a)
        stop.append(b)
        at = max(at, b)
    return order, np.array(start, np.int64), np.array(stop, np.int64)


def attribute(
    sizes: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, float]:
    """Interval join of tokens (by byte sizes) with disjoint sections (byte bounds).

    Per section: tokens given to it, those of them that cross a border, and the sum
    of shares; then tokens that meet no section, and the share outside.
    """
    n = len(start)
    count, crossing, share = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    end = np.cumsum(sizes)
    begin = end - sizes
    full = np.flatnonzero(stop > start)  # empty sections hold nothing
    if not len(full):
        return count, crossing, share, len(sizes), float(len(sizes))
    a, b = start[full], stop[full]
    first = np.searchsorted(b, begin, side="right")
    last = np.searchsorted(a, end, side="left") - 1
    inside = (first == last) & (a[np.minimum(first, len(a) - 1)] <= begin) & (b[np.maximum(last, 0)] >= end)
    whole = np.bincount(first[inside], minlength=len(a))
    count[full] += whole
    share[full] += whole
    outside = int((first > last).sum())
    outside_share = float(outside)
    for t in np.flatnonzero(~inside & (first <= last)):
        over = np.arange(first[t], last[t] + 1)
        held = np.minimum(b[over], end[t]) - np.maximum(a[over], begin[t])
        owner = full[over[0 if rule == "first" else int(np.argmax(held))]]
        count[owner] += 1
        crossing[owner] += 1
        share[full[over]] += held / sizes[t]
        outside_share += 1 - held.sum() / sizes[t]
    return count, crossing, share, outside, outside_share


def share_ranks(docs: DataFrame, ranks_path: str) -> Broadcast:
    """Ranks of a `base64 rank` file on all executors; bounded by the vocabulary."""
    ranks = {token: rank for rank, token in enumerate(read_ranks(ranks_path))}
    return docs.sparkSession.sparkContext.broadcast(ranks)


def section_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    sections: str | Callable[[str], list[Section]] = line_sections,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = "most",
) -> DataFrame:
    """Rows (id, section, start, end, n_tokens, n_crossing, token_share): tokens per section.

    `sections` is a function of the text, or the name of an array column of
    structs (name string, start, end) in code points.  The whole text is encoded
    once.  A token that crosses a border goes to the section that holds most of its
    bytes, the earlier one at a tie (`rule="most"`), or to the first section it
    meets (`rule="first"`); `n_crossing` counts such tokens, `token_share` divides
    them by bytes, since a token may hold a part of a character.

    Defined cases: what two sections claim belongs to the one that starts earlier;
    bounds beyond the text are cut, null bounds or a null section are left out.
    A row without section name holds the tokens outside all sections, if there are any
    (start and end are null).  A null text is an empty one.  Repeated rows are counted
    each; an empty table gives no rows.  Other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ranks = share_ranks(docs, ranks_path)
    given = isinstance(sections, str)
    read = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *([F.col(sections).alias("sections")] if given else []),
    )
    name = fresh(["section", "start", "end", "n_tokens", "n_crossing", "token_share"], id_col)
    schema = StructType(
        [
            StructField(name, docs.schema[id_col].dataType),
            StructField("section", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("n_tokens", LongType()),
            StructField("n_crossing", LongType()),
            StructField("token_share", DoubleType()),
        ]
    )

    def listed(row) -> list[Section]:
        found = [tuple(s.values()) if isinstance(s, dict) else s for s in row or () if s is not None]
        return [(s[0], int(s[1]), int(s[2])) for s in found if s[1] is not None and s[2] is not None]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        sizes = np.zeros(max(ranks.value.values()) + 1, np.int64)
        for token, rank in ranks.value.items():
            sizes[rank] = len(token)
        for part in slices(batches, "text", 4 << 20):
            texts = part.column("text").to_pylist()
            held = part.column("sections").to_pylist() if given else [None] * len(texts)
            owner, columns = [], {c: [] for c in schema.names[1:]}
            for i, (text, own) in enumerate(zip(texts, held)):
                spans = listed(own) if given else sections(text)
                raw = text.encode()
                order, start, stop = clipped(spans, len(text))
                at = byte_offsets(text, raw)
                bounds = (start, stop) if at is None else (at[start], at[stop])
                tokens = sizes[encoding.encode_ordinary(text)]
                count, crossing, share, outside, rest = attribute(tokens, *bounds, rule)
                columns["section"] += [spans[k][0] for k in order]
                columns["start"] += start.tolist()
                columns["end"] += stop.tolist()
                columns["n_tokens"] += count.tolist()
                columns["n_crossing"] += crossing.tolist()
                columns["token_share"] += share.tolist()
                extra = outside > 0 or rest > 1e-9
                if extra:
                    for c, v in zip(columns, (None, None, None, outside, 0, rest)):
                        columns[c].append(v)
                owner += [i] * (len(order) + extra)
            ids = part.column("id").take(pa.array(owner, pa.int64()))
            values = [pa.array(columns[f.name], ARROW[type(f.dataType)]) for f in schema.fields[1:]]
            yield pa.RecordBatch.from_arrays([ids, *values], names=schema.names)

    return read.mapInArrow(run, schema)


ARROW = {StringType: pa.string(), LongType: pa.int64(), DoubleType: pa.float64()}


def with_sections(docs: DataFrame, sections: DataFrame, *, id_col: str = "doc_id", to: str = "sections") -> DataFrame:
    """`docs` with the rows of a section table (id, section, start, end) as an array column.

    The sections of one document meet in its row.
    """
    spans = F.struct(F.col("section").cast("string").alias("section"), F.col("start"), F.col("end"))
    rows = sections.groupBy(F.col(id_col)).agg(F.collect_list(spans).alias(to))
    return docs.join(rows, id_col, "left")
