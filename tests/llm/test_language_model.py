"""Language model against counting with dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm.hash_arrays import MappedArrays, cuts, pack, unpack
from lakestrata.llm.kneser_ney import discounts, score_blocks, score_texts, token_blocks, train_model
from lakestrata.llm.queries import CHECKS

FOLDER = "/root/testdata/sf0.001"


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


class Brute:
    """Counts of all lengths as a text book has them."""

    def __init__(self, texts, order):
        self.order, self.raw = order, Counter()
        self.counts = [None, *(Counter() for _ in range(order))]
        longest = set()
        for text in texts:
            tokens = tokens_of(text)
            self.raw.update(tokens)
            padded = ["\r"] * (order - 1) + tokens
            for i in range(len(tokens)):
                gram = tuple(padded[i : i + order])
                self.counts[order][gram] += 1
                longest.add(gram)
        for n in range(order - 1, 0, -1):
            for gram in self.counts[n + 1]:
                self.counts[n][gram[1:]] += 1
        self.less = [None]
        for n in range(1, order + 1):
            of = Counter(self.counts[n].values())
            self.less.append(discounts(of[1], of[2], of[3], of[4]))
        self.total, self.kinds = defaultdict(int), defaultdict(lambda: [0, 0, 0, 0])
        for n in range(1, order + 1):
            for gram, c in self.counts[n].items():
                self.total[n, gram[:-1]] += c
                self.kinds[n, gram[:-1]][min(c, 3)] += 1

    def p(self, n, gram):
        if n == 0:
            return 1 / (len(self.raw) + 1)
        below, history = self.p(n - 1, gram[1:]), gram[:-1]
        if not (total := self.total.get((n, history))):
            return below
        less, c = self.less[n], self.counts[n].get(gram, 0)
        held_back = sum(less[k] * self.kinds[n, history][k] for k in (1, 2, 3))
        return max(c - less[min(c, 3)], 0) / total + held_back / total * below

    def scores(self, text):
        tokens = tokens_of(text)
        padded = ["\r"] * (self.order - 1) + tokens
        n, v = sum(self.raw.values()), len(self.raw)
        base = sum(math.log10((self.raw[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        score = sum(math.log10(self.p(self.order, tuple(padded[i : i + self.order]))) for i in range(len(tokens)))
        return len(tokens), sum(self.raw[t] > 0 for t in tokens), n, base, score


def agree(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:-2] == w[:-2], (g, w)
        assert g[-2:] == pytest.approx(w[-2:], rel=1e-9, abs=1e-9), (g, w)


COLUMNS = ("id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def by_id(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2:]))


@pytest.mark.parametrize(("order", "block", "shard"), [(1, 50, 100), (2, 40, 64), (3, 60, 200), (3, 1 << 20, 1 << 20), (4, 100, 150)])
def test_model_against_brute_force(spark, order, block, shard):
    dice = random.Random(order * block)
    words = ["the"] * 12 + ["The", "of", "ÉTÉ", "été", "x.", "\x1cx"] + [f"w{i}" for i in range(30)]
    texts = [" \t\n"[i % 3].join(dice.choices(words, k=dice.randint(0, 25))) for i in range(120)]
    texts += ["the " * 300, "the cat sat on the mat and so on"] + ["a copy of the same text"] * 20 + [None, "", "  ", "never seen"]
    rows = [(i, t, i % 5 != 1, "x", 3) for i, t in enumerate(texts)]
    rows += [(None, "no id", True, "x", 3), (None, "no id at all", False, "x", 3), (7, "id again", True, "x", 3), (8, "null mark", None, "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean, block string, data int").repartition(4)
    model = Brute([t for _, t, learn, *_ in rows if learn], order)
    want = by_id((i, bool(learn), *model.scores(t)) for i, t, learn, *_ in rows)
    out = score_texts(docs, F.col("learn"), order=order, block_tokens=block, shard_tokens=shard)
    agree(by_id(out.select(*COLUMNS).collect()), want)


def test_probabilities_sum_to_one(spark):
    """Over all words learned, the end and one unknown word, after any history."""
    texts = ["a b c a b", "b c c", "a a a b", "c"]
    asked = [f"{h} {w}".strip() for h in ("", "a", "b", "zz") for w in ("a", "b", "c", "unknown", "")]
    docs = spark.createDataFrame([(i, t, i < len(texts)) for i, t in enumerate(texts + asked)], "doc_id long, text string, learn boolean")
    model = train_model(token_blocks(docs, F.col("learn")), order=2)
    brute = Brute(texts, 2)
    assert (model.words, model.tokens) == (4, 17)
    for history in ("\r", "a", "b", "zz"):
        assert sum(brute.p(2, (history, w)) for w in ("a", "b", "c", "\n", "unknown")) == pytest.approx(1)
    scored = score_blocks(token_blocks(docs, F.col("learn")), model).collect()
    assert {r["id"]: r["score"] for r in scored} == pytest.approx({i: brute.scores(t)[-1] for i, t in enumerate(texts + asked)})


def test_model_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert score_texts(empty, F.lit(True)).collect() == []
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    nothing = score_texts(docs, F.lit(False)).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in nothing} == {(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)}
    by_name = spark.createDataFrame([("x", "a b")], "name string, body string")
    assert score_texts(by_name, F.lit(True), id_col="name", text_col="body").first()["id"] == "x"
    with pytest.raises(ValueError):
        train_model(token_blocks(docs, F.lit(True)), order=0)


def test_query_op11(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    model = Brute([t for i, t in docs if not held[i]], 2)
    want = by_id((i, held[i], *model.scores(t)) for i, t in docs)
    got = CHECKS["op11_kneser_ney"].run(spark, FOLDER)
    agree(by_id(got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()), want)
    rest = [r for r in got.collect() if r["held_out"]]
    assert sum(r["score"] for r in rest) > 0.95 * sum(r["base_score"] for r in rest)  # a better model of unseen texts


def test_hash_arrays():
    dice = np.random.default_rng(1)
    values = dice.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    assert (unpack(pack(values)) == values).all()
    keys = np.unique(values)
    assert (unpack(pack(keys, ascending=True), ascending=True) == keys).all()
    assert len(unpack(pack(keys[:0]))) == len(unpack(pack(keys[:0], ascending=True), ascending=True)) == 0
    ends = cuts(keys, 7)
    assert ends[0] == 0 and ends[-1] == len(keys) and len(ends) == 8
    assert all((keys[a:b] >> np.uint64(40) < (i + 1) * (1 << 24) // 7 + 1).all() for i, (a, b) in enumerate(zip(ends, ends[1:])))
    mapped = MappedArrays(2)
    for a in range(0, len(keys), 999):
        mapped.append(keys[a : a + 999], keys[a : a + 999] % np.uint64(97))
    asked = np.unique(np.append(keys[::3], dice.integers(0, 1 << 63, 500).astype(np.uint64)))
    assert (mapped.look_up(asked)[0] == np.where(np.isin(asked, keys), asked % np.uint64(97), 0)).all()
    mapped.close()
    assert (MappedArrays(2).look_up(asked)[0] == 0).all()


def test_discounts():
    assert discounts(0, 5, 5, 5) == (0.0, 0.5, 1.0, 1.5)
    d = discounts(100, 40, 20, 12)
    y = 100 / 180
    assert d == pytest.approx((0, 1 - 2 * y * 0.4, 2 - 3 * y * 0.5, 3 - 4 * y * 0.6))
