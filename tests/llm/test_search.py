"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from lakestrata.llm.ranked_search import Best, search_ranked, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_by_re(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, most):
    held = [(i, terms_by_re(t)) for i, t in docs]
    held = [(i, ts) for i, ts in held if ts]
    n, total = len(held), sum(len(ts) for _, ts in held)
    df = {}
    for _, ts in held:
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, ts in held:
            m = 100 - 75 + (75 * len(ts) * n) // total
            score = 0
            for t in terms_by_re(text):
                if tf := ts.count(t):
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:most], 1)]
    return out


def searched(spark, items, docs, **more):
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, row string")
    got = search_ranked(asked, rows.repartition(5), **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return [tuple(r) for r in got.collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_search_against_brute_force(spark, block):
    dice = random.Random(block)
    words = ["Apple", "apple", "ÉTÉ", "été", "x1", "x-1", "rare", "the", "THE", "of", "日本", "q_q", "zz"]
    words += [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(dice.choices(words, k=dice.randint(0, 30)))) for i in range(200)]
    docs += [(500 - i, "The apple, of: rare") for i in range(60)]  # one large group, ids descending
    docs += [(1000, None), (1001, ""), (1002, " ./-"), (None, "the apple of rare"), (None, "rare rare"), (7, docs[7][1])]
    docs += [(1003, "apple " * 20_000)]
    items = [(i, " ".join(dice.choices(words, k=dice.randint(1, 8)))) for i in range(12)]
    items += [(20, None), (21, "?!"), (22, "absent"), (None, "rare of"), (3, "the the apple"), (3, "the the apple")]
    got = searched(spark, items, docs, most=7, block_bytes=block)
    assert order(got) == order(brute(items, docs, 7))


def test_search_edges(spark):
    assert searched(spark, [(1, "a")], []) == []
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "b")], [(1, "a")]) == []
    # A word of every document weighs nothing: floor(1000 ln(4 / 3)) > 0 for one, 0 for many.
    assert searched(spark, [(1, "a")], [(i, "a") for i in range(900)]) == []
    assert searched(spark, [(1, "a a")], [(5, "A"), (4, "a")], most=1)[0][:3] == (1, 1, 4)


def test_terms():
    for text in ("", "Ab-cD_é9", "ÀÉ x\x00y\x7fz", "日本 語'S", " \t\n", "😀a"):
        assert [t.decode() for t in terms_of(text)] == terms_by_re(text)
    assert terms_of(None) == []


def test_best_keeps_the_smallest_ids_in_any_order():
    rows = [(i, b"", 1) for i in (9, 3, None, 7, 1, 5)]
    best = Best(1, 3)
    for i in range(0, 6, 2):
        best.add(np.array([[4], [4]]), rows[i : i + 2])
    assert [best.held[i][0] for i in best.number[:, 0]] == [1, 3, 5]
