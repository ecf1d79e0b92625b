"""Secret scans: trigram postings pick the documents, DataFrame expressions verify them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as rc, _parser as rp

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import bound, fresh, running_starts
from lakestrata.sources.scratch import materialize

MOST_STRINGS = 64
Clauses = list[frozenset[str]]  # any of these sets of trigrams, all of one set


@dataclass(frozen=True)
class Rule:
    """A regex of the common subset of Java, RE2 and Python, and what a match must hold.

    `group` names the part whose length in characters must reach `least`; a
    shorter match is dropped, but still consumes its text.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base kinds, in the order in which ties are listed.
KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE_RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
# Public token formats beyond the base kinds.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hosting", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("cloud", "AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
ALL_RULES = BASE_RULES + MORE_RULES


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def either(clauses: Clauses) -> Clauses:
    """Without clauses that ask for more than another one does."""
    kept: Clauses = []
    for c in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(k <= c for k in kept):
            kept.append(c)
    return kept


def both(a: Clauses, b: Clauses) -> Clauses:
    product = either([x | y for x in a for y in b])
    return product if len(product) <= MOST_STRINGS else min(a, b, key=len)


def fold(code: int) -> str:
    """ASCII letters in lower case, as the index holds them."""
    c = chr(code)
    return c.lower() if "A" <= c <= "Z" else c


def trigram_query(pattern: str) -> Clauses:
    """Trigrams (ASCII lower case) that every match of the regex contains.

    Alternatives are clauses, of which one must hold in full; `[frozenset()]`
    means that nothing is mandatory and the rule has to scan all texts.
    """

    def close(strings: set[str] | None, query: Clauses) -> Clauses:
        return query if strings is None else both(query, either([trigrams(s) for s in strings]))

    def walk(items) -> tuple[set[str] | None, Clauses]:
        """All strings the items can be (None: not listed), and a query that they imply."""
        strings, query, listed = {""}, [frozenset()], True
        for op, arg in items:
            choice, implied = one(op, arg)
            if choice is not None and len(strings) * len(choice) <= MOST_STRINGS:
                strings = {s + c for s in strings for c in choice}
                continue
            query = both(close(strings, query), close(choice, implied))
            strings, listed = {""}, False
        return (strings, [frozenset()]) if listed else (None, close(strings, query))

    def one(op, arg) -> tuple[set[str] | None, Clauses]:
        free: Clauses = [frozenset()]
        if op is rc.LITERAL:
            return {fold(arg)}, free
        if op is rc.IN and all(o in (rc.LITERAL, rc.RANGE) for o, _ in arg):
            codes = {x for o, a in arg for x in ([a] if o is rc.LITERAL else range(a[0], min(a[1], a[0] + 9) + 1))}
            small = {fold(c) for c in codes}
            wide = any(o is rc.RANGE and a[1] - a[0] > 8 for o, a in arg)
            return (None, free) if wide or len(small) > 6 else (small, free)
        if op is rc.SUBPATTERN:
            return walk(arg[3])
        if op is rc.BRANCH:
            found = [walk(x) for x in arg[1]]
            if all(s is not None for s, _ in found):
                return set().union(*(s for s, _ in found)), free
            return None, either([c for s, q in found for c in close(s, q)])
        if op is rc.MAX_REPEAT:
            least, most, inner = arg
            strings, query = walk(inner)
            if (least, most) == (1, 1):
                return strings, query
            if (least, most) == (0, 1) and strings is not None:
                return strings | {""}, free
            return (None, close(strings, query)) if least else (None, free)
        return None, free  # anything else implies nothing

    strings, query = walk(rp.parse(pattern, flags=re.ASCII))
    return close(strings, query)


def posting_rows(docs: DataFrame, wanted: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """The inverted index: one row (trigram, id) per document that holds the trigram.

    It holds the trigrams that some rule asks for; no lookup can want another one.
    """
    low = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)))
    return low.select(F.explode(held).alias("trigram"), "id")


def candidate_rows(postings: DataFrame, queries: dict[str, Clauses]) -> DataFrame:
    """Intersect the postings: id and the kinds whose query holds.

    A document has at most as many postings as the rules have trigrams.
    """
    held = postings.groupBy("id").agg(F.collect_set("trigram").alias("held"))

    def holds(clauses: Clauses) -> Column:
        found = F.lit(False)
        for clause in clauses:
            want = F.array(*(F.lit(t) for t in sorted(clause)))
            found = found | (F.size(F.array_except(want, "held")) == 0)
        return found

    kinds = F.array_compact(F.array(*(F.when(holds(q), F.lit(k)) for k, q in queries.items())))
    return held.select("id", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(rule: Rule, text: Column, order: int) -> Column:
    """Spans of the rule in `text`: the gaps between matches and the matches give the offsets."""
    pattern = F.lit(rule.pattern)
    match = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    part = match if rule.group == 0 else F.transform(
        F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length
    )
    gap = F.transform(F.split(text, rule.pattern, -1), F.length)  # one more than there are matches

    def placed(found: Column) -> Column:
        sizes = F.zip_with(F.slice(found["gap"], 1, F.size(found["match"])), found["match"], lambda g, m: g + m)
        rows = F.arrays_zip(
            running_starts(sizes).alias("at"),
            F.slice(found["gap"], 1, F.size(found["match"])).alias("gap"),
            found["match"].alias("match"),
            found["part"].alias("part"),
        )
        long_enough = F.filter(rows, lambda r: r["part"] >= rule.least)

        def span(r: Column) -> Column:
            start = (r["at"] + r["gap"]).cast("int")
            return F.struct(
                start.alias("start"), F.lit(order).alias("order"), (start + r["match"]).alias("end"), F.lit(rule.kind).alias("kind")
            )

        return F.transform(long_enough, span)

    return bound(F.struct(gap.alias("gap"), match.alias("match"), part.alias("part")), placed)


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")


def find_secrets(
    docs: DataFrame,
    rules: Sequence[Rule] = ALL_RULES,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All columns of `docs` and `secrets`: array of (start, order, end, kind), sorted.

    Offsets are code points, ends exclusive; matches of a kind are leftmost and do
    not overlap.  Each rule's regex gives a Boolean trigram query.  A document is
    verified for a rule if its postings satisfy the query; a rule without
    mandatory trigrams verifies all documents.

    Defined cases: a null text counts as empty; a null id is an id like any other;
    rows with equal ids share candidates and are verified on their own text; an
    empty table gives no rows.  If `docs` has a column `secrets`, the new one gets
    a trailing underscore.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if frozenset() not in q}
    name, text = fresh(docs.columns, "secrets"), F.coalesce(F.col(text_col), F.lit(""))
    kinds = fresh(docs.columns, "kinds")
    if indexed:
        wanted = sorted(set().union(*(c for q in indexed.values() for c in q)))
        postings = materialize(posting_rows(docs, wanted, id_col, text_col), "postings")
        found = candidate_rows(postings, indexed).select(F.col("id").alias(fresh(docs.columns, "id")), F.col("kinds").alias(kinds))
        key = found.columns[0]
        rows = docs.join(found, F.col(id_col).eqNullSafe(F.col(key)), "left").drop(key)
    else:
        rows = docs.withColumn(kinds, F.lit(None).cast("array<string>"))
    parts = []
    for order, rule in enumerate(rules):
        spans = spans_of(rule, text, order)
        # A cheap test first: few texts hold a match, and building spans costs several passes.
        least = f"{rule.pattern[:-1]}{{{rule.least},}}" if re.fullmatch(r"\[[^\]]+\]\+", rule.pattern) else rule.pattern
        holds = text.rlike(least)
        if rule.kind in indexed:
            holds = F.coalesce(F.array_contains(kinds, rule.kind), F.lit(False)) & holds
        parts.append(F.when(holds, spans).otherwise(no_spans()))
    return rows.withColumn(name, F.array_sort(F.concat(*parts))).drop(kinds)


def listed(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
