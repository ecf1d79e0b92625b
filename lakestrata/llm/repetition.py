"""Quality rules on repetition, from a suffix array of each document's words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from lakestrata.llm.common import fresh, slices
from lakestrata.llm.suffixes import repeat_lengths

# Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the base rule, then of the suffix-array rule.

    A text fails the second one if maximal repeats of `least_repeat` words or more
    cover over `most_covered` of its characters, or if one repeat is longer than
    `longest_repeat` words and than `longest_share` of the text.  By default the
    longest repeat is limited in words alone: two copies of a tenth of a text are
    more than the base rule lets through, so a share would decide nothing.
    """

    least_words: int = 10
    window: int = 5
    most_repeat_percent: int = 20
    least_repeat: int = 10
    most_covered: float = 0.10  # clearly below the share that the base rule allows
    longest_repeat: int = 50
    longest_share: float = 0.0


STATS = (
    ("n_words", LongType()),
    ("word_chars", LongType()),
    ("n_symbols", LongType()),
    ("n_dup_lines", LongType()),
    ("n_repeat_words", LongType()),
    ("base_failed", BooleanType()),
    ("kept", BooleanType()),
    ("covered", DoubleType()),
    ("longest_repeat", LongType()),
)


def spans_union(lengths: np.ndarray, least: int) -> np.ndarray:
    """Which positions the spans [i, i + lengths[i]) of at least `least` words cover."""
    begin = np.flatnonzero(lengths >= least)
    edge = np.zeros(len(lengths) + 1, np.int64)
    edge[begin] += 1
    np.subtract.at(edge, begin + lengths[begin], 1)
    return np.cumsum(edge[:-1]) > 0


def measure(texts: Sequence[str | None], rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The columns of STATS for some texts; one suffix array serves all of them."""
    number: dict[bytes, int] = {}
    ids, sizes, n_words, chars, symbols, dup_lines = [], [], [], [], [], []
    for text in texts:
        raw = (text or "").encode()
        words = raw.split()
        ids.extend([number.setdefault(w, len(number)) for w in words])
        sizes.extend(map(len, words))
        n_words.append(len(words))
        chars.append(len(text or "") - len(raw) + len(raw.translate(None, SPACES)))
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        dup_lines.append(len(lines) - len(set(lines)))
    n, count = len(texts), np.array(n_words, np.int64)
    doc = np.repeat(np.arange(n), count)
    end = np.repeat(np.cumsum(count), count)
    least = min(rules.window, rules.least_repeat)
    repeat = repeat_lengths(np.array(ids, np.int64), doc, end, least)
    in_window = np.bincount(doc[spans_union(repeat, rules.window)], minlength=n)
    size = np.array(sizes, np.float64)
    total = np.bincount(doc, weights=size, minlength=n)
    long_cover = spans_union(repeat, rules.least_repeat)
    covered = np.bincount(doc[long_cover], weights=size[long_cover], minlength=n) / np.maximum(total, 1)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, repeat)
    failed = (count < rules.least_words) | (100 * in_window > rules.most_repeat_percent * count)
    repetitive = (covered > rules.most_covered) | (
        (longest > rules.longest_repeat) & (longest > rules.longest_share * count)
    )
    return {
        "n_words": count,
        "word_chars": np.array(chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(dup_lines, np.int64),
        "n_repeat_words": in_window.astype(np.int64),
        "base_failed": failed,
        "kept": ~failed & ~repetitive,
        "covered": covered,
        "longest_repeat": longest,
    }


def repetition_stats(
    docs: DataFrame,
    rules: RepetitionRules = RepetitionRules(),
    *,
    text_col: str = "text",
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """The `carry` columns of `docs` (all if None), then the columns of STATS.

    Words are runs of characters other than space and U+0009 to U+000D.  Nothing
    is shuffled: a document's suffix array is built where its text is, for some
    megabytes of texts at a time.  `covered` is the fraction of the characters of
    words (in bytes) that lie in maximal repeats; `longest_repeat` is 0 below the
    window length.

    Defined cases: a null text has no words and fails the base rule; repeated rows
    are measured each; an empty table gives no rows.  A statistic whose name the
    carried columns already have gets a trailing underscore.
    """
    carried = list(docs.columns if carry is None else carry)
    names = {}
    for name, _ in STATS:
        names[name] = fresh([*carried, *names.values()], name)
    schema = StructType(
        [docs.schema[c] for c in carried] + [StructField(names[n], kind) for n, kind in STATS]
    )
    held = fresh(carried, "measured_text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, held, 4 << 20):
            stats = measure(part.column(held).to_pylist(), rules)
            arrays = [part.column(c) for c in carried] + [pa.array(stats[n]) for n, _ in STATS]
            yield pa.RecordBatch.from_arrays(arrays, names=[*carried, *names.values()])

    source = docs.select(*(F.col(f"`{c}`") for c in carried), F.col(text_col).cast("string").alias(held))
    return source.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, rules: RepetitionRules = RepetitionRules(), *, text_col: str = "text") -> DataFrame:
    """Rows of `docs` that both rules accept, with the columns of `docs` only."""
    verdict = fresh(docs.columns, "kept")
    return repetition_stats(docs, rules, text_col=text_col).where(F.col(verdict)).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
