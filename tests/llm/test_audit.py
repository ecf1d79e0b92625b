"""Filter audit against applying the filters one after another, in every order."""

from __future__ import annotations

import math
import random
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.filter_audit import audit_orders, path_counts


def conditions():
    return {"S": F.length(F.coalesce("text", F.lit(""))) < 4, "V": F.col("text").rlike("[aeiou]"), "C": None}


DDL = "doc_id long, text string, lang string, mask int, id string"


def brute(rows, flagged):
    """rows: (id, text, part); flagged: ids."""
    rows = [(i, t or "", p or "") for i, t, p in rows]

    def fails(x, row):
        i, t, *_ = row
        if x == "S":
            return len(t) < 4
        if x == "V":
            return any(c in t for c in "aeiou")
        return i is not None and any(j is not None and j < i and u == t for j, u, *_ in rows)

    out = []
    for part in {r[2] for r in rows}:
        removed_in = dict.fromkeys("SVC", 0)
        found = []
        for order in permutations("SVC"):
            alive = [r for r in rows if r[2] == part]
            every = list(alive)
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if fails(x, r)]
                alive = [r for r in alive if not fails(x, r)]
                removed_in[x] += len(gone)
                redundant = sum(fails(x, r) for r in every) - len(gone)
                unique = sum(fails(x, r) and not any(fails(y, r) for y in "SVC" if y != x) for r in every)
                lost = sum(r[0] in flagged for r in gone)
                found.append(((part, "".join(order), step, len(alive), len(gone), redundant, unique, lost), x))
        out += [(*row, removed_in[x]) for row, x in found]
    return sorted(out)


def frame_of(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, p, 5, "x") for i, t, p in rows], DDL).repartition(partitions)


def audited(spark, rows, flagged):
    docs = frame_of(spark, rows)
    flags = spark.createDataFrame([(i, True) for i in flagged] + [(i, False) for i in flagged] + [(None, True), (1, None)],
                                  "doc_id long, good boolean")
    out = audit_orders(docs, conditions(), part=F.col("lang"), flags=flags)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "shapley"]
    return sorted(tuple(r) for r in out.collect())


def test_audit_against_brute_force(spark):
    dice = random.Random(3)
    texts = ["", None, "a", "xyz", "xyzw", "hello", "rhythm", "zz zz", "é" * 4, "q" * 200_000]
    rows = [(dice.choice([*range(60), None]), dice.choice(texts), dice.choice(["en", "fr", None, ""])) for _ in range(150)]
    rows += rows[:5]  # repeated rows
    flagged = {i for i in range(0, 60, 3)}
    assert audited(spark, rows, flagged) == brute(rows, flagged)


def test_audit_of_one_hot_text(spark):
    rows = [(i, "same text", f"p{i % 3}") for i in range(400)]
    got = audited(spark, rows, {0, 7})
    assert got == brute(rows, {0, 7})
    assert sum(r[4] for r in got if r[1] == "CSV" and r[2] == 1) == 399


def test_audit_edges(spark):
    assert audit_orders(frame_of(spark, []), conditions()).count() == 0
    null_fails_nothing = audit_orders(frame_of(spark, [(1, None, None)]), {"S": F.length("text") < 4})
    assert [tuple(r) for r in null_fails_nothing.collect()] == [("", "S", 1, 1, 0, 0, 0, 0)]
    long_names = audit_orders(frame_of(spark, [(1, "a", "x")]), {"short": F.length("text") < 4, "copy": None})
    assert {r["filter_order"] for r in long_names.collect()} == {"short,copy", "copy,short"}
    with pytest.raises(ValueError):
        audit_orders(frame_of(spark, []), {})
    with pytest.raises(ValueError):
        audit_orders(frame_of(spark, []), {str(i): F.lit(True) for i in range(8)})


def test_path_counts():
    forward, backward = path_counts(5)
    assert all(forward[s] == math.factorial(s.bit_count()) for s in range(32))
    assert all(backward[s] == math.factorial(5 - s.bit_count()) for s in range(32))
    assert sum(forward[s] * backward[s | 4] for s in range(32) if not s & 4) == 120
