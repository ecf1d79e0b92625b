"""Operators over links: components, block join, vectors, lines, SimHash, substrings, pipeline."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakestrata.llm import lines as fuzzy
from lakestrata.llm import simhash, substrings
from lakestrata.llm.block_join import block_rows, close_blocks
from lakestrata.llm.common import fresh, only_ids
from lakestrata.llm.components import connected_components
from lakestrata.llm.fm_index import FmIndex
from lakestrata.llm.mixing import poisson_mix
from lakestrata.llm.queries import CHECKS
from lakestrata.llm.queries_native import MIX_OTHER, MIX_SEED, MIX_WEIGHTS
from lakestrata.llm.repetition import RepetitionRules, measure
from lakestrata.llm.vectors import vector_classes
from lakestrata.sources.folders import entries
from lakestrata.sources.scratch import shared_dir

SF = "/root/testdata/sf0.001"


def groups(n, links):
    """Smallest reachable number of 0 .. n-1."""
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(50, i) for i in range(60, 95)]
    links = [*chain, *star, *((rng.randrange(40), rng.randrange(40)) for _ in range(25)), (7, 7)]
    got = connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()
    want = groups(161, links)
    members = {x for a, b in links if a != b for x in (a, b)}
    assert {r["id"]: r["component"] for r in got} == {m: want[m] for m in members}


def test_components_of_nothing_and_of_other_types(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    texts = spark.createDataFrame([(b"b", b"a"), (b"b", b"c")], "a binary, b binary")
    assert {bytes(r["component"]) for r in connected_components(texts).collect()} == {b"a"}


def test_close_blocks_finds_all_near_pairs(spark):
    rng = random.Random(5)
    spans = sorted((rng.randint(0, 400), rng.randint(1, 30)) for _ in range(75))
    rows = [(i, a, a + n) for i, (a, n) in enumerate(spans)]
    blocks = spark.createDataFrame(rows, "block long, low long, high long")

    def near(a, b):
        return (a("low") <= b("high")) & (b("low") <= a("high"))

    got = close_blocks(blocks, {"low": F.min, "high": F.max}, near).collect()
    want = {(i, j) for i, a, b in rows for j, c, d in rows if i <= j and a <= d and c <= b}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert close_blocks(blocks.limit(0), {"low": F.min, "high": F.max}, near).count() == 0
    assert block_rows(10, 4, 8) == 4 and block_rows(10**6, 4, 8) == 8


def test_helpers(spark):
    assert fresh(["A", "a_"], "a") == "a__"
    rows = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    assert only_ids(rows, rows.where("id = 2 or id is null"), "id").count() == 2


def check_vectors(got, rows, least=0.93):
    """rows: (id, vector, label)"""
    fit = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    unit = [np.array(v, float) / np.linalg.norm(v) for _, v, _ in fit]
    links = [
        (i, j) for i in range(len(fit)) for j in range(i)
        if fit[i][2] == fit[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least
    ]
    low = groups(len(fit), links)
    want = []
    for i, r in enumerate(fit):
        ids = [fit[k][0] for k in range(len(fit)) if low[k] == low[i] and fit[k][0] is not None]
        want.append((r[0], sum(i in link for link in links), min(ids, default=None)))
    want += [(r[0], 0, r[0]) for r in rows if all(r is not f for f in fit)]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr("lakestrata.llm.vectors.LEAST_BLOCK", 8)
    rng = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        for _ in range(20):
            centre = rng.normal(size=6)
            rows += [[centre + rng.normal(size=6) * 0.15, label] for _ in range(int(rng.integers(1, 5)))]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(rows)]
    scaled = [2.0 * x for x in rows[0][1]]
    odd = [
        (900, None, 1), (901, [], 1), (902, [0.0] * 6, 1), (903, [float("nan")] + [1.0] * 5, 1), (904, [None] + [1.0] * 5, 1),
        (905, [float("inf")] * 6, 1), (906, rows[0][1], None), (907, [1.0, 0.0], 1), (908, [1.0, 0.0], 1), (909, scaled, 1),
        (910, rows[0][1], 1), (910, rows[0][1], 1), (None, rows[0][1], 1), (911, [1.0, -0.0], 2), (912, [1.0, 0.0], 2), (913, [3.0], 2),
    ]
    ddl = "vec_id long, embedding array<float>, label int, copies string"
    frame = spark.createDataFrame([(*r, "own") for r in [*rows, *odd]], ddl).repartition(3)
    check_vectors([tuple(r) for r in vector_classes(frame).collect()], [*rows, *odd])
    assert vector_classes(frame.limit(0)).count() == 0


def test_query_op1(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = CHECKS["op1_grid_order_join"].run(spark, SF).collect()
    check_vectors([tuple(r)[:3] for r in got], rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), seed=42) for i in range(max(1, len(words) - shingle + 1))
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(got, rows, most=4):
    prints = [brute_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= most]
    low = groups(len(rows), links)
    lowest = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            lowest[low[i]] = min(lowest.get(low[i], id_), id_)
    want = [(rows[i][0], f"{prints[i]:016x}", lowest.get(low[i])) for i in range(len(rows))]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_op7(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_simhash([tuple(r) for r in CHECKS["op7_simhash_gray"].run(spark, SF).collect()], rows)


def test_simhash_edges_and_keep_one(docs, spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAST_BLOCK", 4)
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 50)) for _ in range(120)) for _ in range(25)]
    near = [t.replace("a1", "z9", 1) + " end" for t in base[:12]]
    texts = [*base, *near, "", "\t\n", "one two", "ONE two", "É x", "é x", "w " * 50_000]
    rows = docs(*enumerate(texts), (90, None), (3, base[3]), (None, base[4]), (None, "alone here now and then"))
    rows = rows.withColumn("fingerprint", F.lit(0)).withColumn("id", F.lit("own"))
    plain = [(r["doc_id"], r["text"]) for r in rows.collect()]
    out = simhash.simhash_classes(rows).collect()
    check_simhash([(r["id"], f"{r['fingerprint'] & (1 << 64) - 1:016x}", r["component_id"]) for r in out], plain)
    kept = simhash.keep_one(rows)
    lows = {r["component_id"] for r in out}
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == lows
    assert simhash.simhash_classes(rows.limit(0)).count() == 0 and simhash.keep_one(rows.limit(0)).count() == 0


def test_gray_index_finds_all_close_pairs():
    rng = np.random.default_rng(8)
    bits = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (4, 300)).astype(np.uint64)
    bits = np.unique(np.concatenate([bits, bits ^ flips[0] ^ flips[1], bits[:50] ^ flips[2, :50], np.arange(40, dtype=np.uint64)]))
    rank = bits.copy()
    for step in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(step)
    bits = bits[np.argsort(rank)]
    far = np.bitwise_count(bits[:, None] ^ bits[None, :])
    for most in (0, 3, 5):
        for cut in (1, 17, 400):
            a, b, found = bits[:cut], bits[cut:], set()
            for left, right, same, at in ((a, a, True, (0, 0)), (a, b, False, (0, cut)), (b, b, True, (cut, cut))):
                x = simhash.GrayIndex(left)
                for i, j in simhash.close_entries(x, x if same else simhash.GrayIndex(right), same, most):
                    found |= set(zip((i + at[0]).tolist(), (j + at[1]).tolist()))
            assert found == {(i, j) for i, j in np.argwhere(far <= most).tolist() if i < j}


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_edit_distance():
    rng = random.Random(9)
    for _ in range(400):
        a, b = ("".join(rng.choice("abé") for _ in range(rng.randint(0, 40))) for _ in range(2))
        b = a[:7] + b[:5] + a[9:] if rng.random() < 0.5 else b
        assert fuzzy.edit_distance(a, b) == table_distance(a, b)
    assert fuzzy.similar("abcde", "abcdx", 0.8) and not fuzzy.similar("abcde", "abxyx", 0.8) and fuzzy.similar("", "", 0.8)


def test_edits_of_words_prove_only_what_holds():
    rng, sure = random.Random(19), 0
    for _ in range(1500):
        a = [rng.choice(["a", "bb", "cé", "dddd", "eeeeeeee"]) for _ in range(rng.randint(0, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(b) + 1)
            b[k : k + rng.randint(0, 1)] = rng.choice([[], ["x"], ["bb", "zzz"]])
        a, b = " ".join(a), " ".join(b)
        within = table_distance(a, b) <= 0.2 * max(len(a), len(b), 1) + 1e-9
        assert fuzzy.similar(a, b, 0.8) == within and (within or not fuzzy.surely_similar(a, b, 0.8))
        sure += fuzzy.surely_similar(a, b, 0.8)
    assert sure > 200


def word_hash(word):
    """The bits of a line of one word are the word's hash."""
    if word not in WORD_HASHES:
        WORD_HASHES[word] = int(fuzzy.LineHasher().read([word])["bits"][0]) & (1 << 64) - 1
    return WORD_HASHES[word]


WORD_HASHES = {}


def brute_bits(words):
    hashes = [word_hash(w) for w in words]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_ends(words):
    """Fingerprints of the first and last words: the largest of 1, 2, 3, 4, 6, 8, 12 ... that is half of them at most."""
    sizes = sorted({s * 2**k for s in (2, 3) for k in range(20)} | {1})
    n = max(s for s in sizes if s <= max(1, len(words) // 2))
    return [brute_bits(w) & (1 << 56) - 1 for w in (words[:n], words[-n:])]


def close_lines(a, b, most=3, most_end=16):
    """Of (bits, ends): within the limit, or within the other one with the same beginning or end."""
    bits = (a[0] ^ b[0]).bit_count()
    return bits <= most or bits <= most_end and any(x == y for x, y in zip(a[1], b[1]))


def brute_lines(rows, least=0.8, words=5):
    places, bits = {}, {}
    for id_, text in rows:
        for k, own in enumerate(fuzzy.normal_lines(text) if text is not None else []):
            if len(own) >= words:
                line = b" ".join(own).decode()
                places.setdefault(line, []).append((id_ is not None, id_ or 0, k))
                if line not in bits:
                    bits[line] = brute_bits(line.split(" ")), brute_ends(line.split(" "))
    names = sorted(places)
    links = [
        (i, j) for i in range(len(names)) for j in range(i)
        if close_lines(bits[names[i]], bits[names[j]]) and fuzzy.similar(names[i], names[j], least)
    ]
    low = groups(len(names), links)
    best = {}
    for i, n in enumerate(names):
        best[low[i]] = min(best.get(low[i], (2, 0, 0)), min(places[n]))
    kept = set(best.values())
    out = []
    for id_, text in rows:
        stay = None
        if text is not None:
            pairs = zip(text.split("\n"), fuzzy.normal_lines(text))
            stay = "\n".join(x for k, (x, own) in enumerate(pairs) if len(own) < words or (id_ is not None, id_ or 0, k) in kept)
        out.append((id_, stay))
    return out, len(links)


def test_lines_against_brute_force(docs, spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "LEAST_BLOCK", 16)
    monkeypatch.setattr(fuzzy, "LONG_RUN", 3)
    monkeypatch.setattr(fuzzy.Tables, "choose", staticmethod(lambda n, most: fuzzy.Tables.of(5, most)))
    rng = random.Random(10)
    vocabulary = ["w" + hashlib.md5(str(i).encode()).hexdigest()[:5] for i in range(200)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(25)]
    variants = [b.replace(b.split()[k], "changed", 1) for b in base for k in range(3)]
    pool = [*base, *variants, base[0].upper() + "!", base[1].replace(" ", ", "), "short line", "", "same words here and there 12", "same words here and there 99"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(60)]
    texts += [base[2], base[2], "", "x " * 100_000, "é è ê ë ē\né è ê ë ē"]
    rows = docs(*enumerate(texts), (90, None), (2, texts[2]), (None, base[5])).withColumn("n_lines", F.lit("own"))
    plain = [(r["doc_id"], r["text"]) for r in rows.collect()]
    want, n = brute_lines(plain)
    out = fuzzy.dedup_lines(rows)
    assert out.columns == ["doc_id", "text", "source", "n_lines", "n_lines_", "n_removed"] and n > 20
    got = out.collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == sorted((str(i), str(t)) for i, t in want)
    before = {(str(i), len((t or "").split("\n")) if t is not None else 0) for i, t in plain}
    assert {(str(r["doc_id"]), r["n_lines_"]) for r in got} == before
    assert all(r["n_removed"] <= r["n_lines_"] for r in got)
    assert fuzzy.dedup_lines(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fuzzy.dedup_lines(rows, most_bits=8)


def test_bound_by_pairs_of_characters_never_rules_out_a_similar_text():
    rng = random.Random(14)
    texts = []
    for _ in range(40):
        base = [rng.choice("abcdeé ") for _ in range(rng.randint(30, 120))]
        for _ in range(5):
            edited = list(base)
            for _ in range(rng.randint(0, len(base) // 4)):
                k = rng.randrange(len(edited))
                edited[k : k + 1] = rng.choice([[], ["x"], [edited[k], "y"]])
            texts.append("".join(edited))
    texts += ["", "a"]
    pairs, kept = fuzzy.Pairs(texts, 0.8), 0
    for x in range(len(texts)):
        others = np.array([y for y in range(len(texts)) if y != x])
        found = set(pairs.possible(x, others).tolist())
        kept += len(found)
        assert found >= {y for y in others.tolist() if fuzzy.similar(texts[x], texts[y], 0.8)}
    assert kept < len(texts) ** 2 / 2


def test_bound_rules_out_other_texts_of_the_same_syllables():
    rng = random.Random(21)
    parts = ["th", "he", "in", "er", "on", "an", "re", "nd", "at", "en", "ti", "es", "or", "ing", "tion", "ed", "ha", "wh", "the", "ly"]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(100)) for _ in range(40)]
    pairs = fuzzy.Pairs(texts, 0.8)
    kept = sum(len(pairs.possible(x, np.arange(x + 1, 40))) for x in range(39))
    assert kept < 0.1 * 780 and not any(fuzzy.similar(texts[0], t, 0.8) for t in texts[1:])


def test_lines_of_rows_with_one_id_keep_their_places(docs):
    """Two lines stand in one place: one is a copy that may go, the other is not."""
    near, own = "one two three four five six seven eight nine ten", "quite another line that is nowhere else at all"
    rows = docs((0, near + " x"), (1, near + " y"), (1, own), (2, f"{own}\n{near} z"), (3, near + " y"))
    out = [(r["doc_id"], r["text"]) for r in fuzzy.dedup_lines(rows).collect()]
    want = brute_lines([(r["doc_id"], r["text"]) for r in rows.collect()])[0]
    assert sorted(out) == sorted(want) and (1, near + " y") in out and (3, "") in out


def test_labels_follow_the_joins():
    rng, labels = random.Random(15), fuzzy.Labels(200)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    for x, y in links:
        if labels.of[x] != labels.of[y]:
            labels.join(x, y)
    low = groups(200, links)
    assert len({(a, int(b)) for a, b in zip(low, labels.of)}) == len(set(low)) == len(set(labels.of.tolist()))


def test_large_groups_of_lines_cost_little(docs, spark):
    """A template with thousands of names, and one set of words in many orders, which no edit links."""
    rng = random.Random(16)
    words = [hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(60)]
    template = [" ".join(words) + f" {hashlib.md5(bytes(str(i), 'ascii')).hexdigest()[:8]}" for i in range(6000)]
    orders = [" ".join(rng.sample(words[:40], 40)) for _ in range(300)]
    rows = docs(*((i, "\n".join(template[i * 20 : i * 20 + 20])) for i in range(300)), (1000, "\n".join(orders)), partitions=4)
    started = time.time()
    out = fuzzy.dedup_lines(rows).where("n_removed > 0 or doc_id = 1000").agg(F.sum("n_removed")).first()[0]
    assert out >= 5900 and time.time() - started < 60
    assert fuzzy.dedup_lines(rows.where("doc_id = 1000")).first()["n_removed"] == 0


def test_line_hasher_counts_lines_and_words():
    texts = ["x " * 70_000 + "y", "", "\n\na\tb", None, "A, b\nq 7"]
    found = fuzzy.LineHasher().read(texts)
    places = list(zip(found["owner"].tolist(), found["line"].tolist(), found["words"].tolist()))
    assert places == [(0, 0, 70_001), (2, 2, 2), (4, 0, 2), (4, 1, 2)]
    assert (found["key"][1] == found["key"][2]).all() and found["bits"][1] == found["bits"][2]
    assert len({tuple(k) for k in found["key"].tolist()}) == 3


@pytest.mark.parametrize("n", [1, 10**7, 10**10, 10**13])
def test_some_table_holds_every_close_pair(n):
    rng, tables = random.Random(13), fuzzy.Tables.choose(n, 3)
    assert sum(w for _, w in tables.ranges) == 64
    for _ in range(200):
        differ = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert tables.first(np.array([differ], np.uint64))[0] < len(tables.groups)


def test_line_hasher_ends():
    rng = random.Random(17)
    lines = [[rng.choice(["ab", "c", "dé", "f0", "ghi"]) for _ in range(n)] for n in [*range(1, 40), 300, 521, 1100]]
    found = fuzzy.LineHasher().read(["\n".join(" ".join(w) for w in lines)])
    for k, w in enumerate(lines):
        assert int(found["bits"][k]) & (1 << 64) - 1 == brute_bits(w)
        assert [int(found[c][k]) & (1 << 56) - 1 for c in ("head", "tail")] == brute_ends(w)


@pytest.mark.parametrize(("low", "high"), [(5, 15), (15, 30), (30, 60), (60, 201)])
def test_recall_of_lines_with_a_changed_word(docs, spark, low, high):
    """Against edit similarity alone: a line of the table, and the same with a word replaced, similarity 0.8 or more."""
    rng = random.Random(18)
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("text").collect()
    lines = {" ".join(w.decode() for w in own): own for r in rows for own in fuzzy.normal_lines(r["text"])}
    vocabulary = sorted({w for own in lines.values() for w in own})
    pairs = []
    for line, own in sorted(lines.items()):
        k, new = rng.randrange(max(1, len(own))), rng.choice(vocabulary)
        changed = b" ".join([*own[:k], new, *own[k + 1 :]]).decode()
        if low <= len(own) < high and changed not in lines and fuzzy.similar(line, changed, 0.8):
            pairs.append((line, changed))
    pairs = rng.sample(pairs, min(200, len(pairs)))
    both = docs(*((2 * i + k, p[k]) for i, p in enumerate(pairs) for k in range(2)))
    found = fuzzy.dedup_lines(both).where("doc_id % 2 = 1 and n_removed = 1").count()
    assert len(pairs) >= 30 and found >= 0.9 * len(pairs), (found, len(pairs))


def test_query_op3(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute_lines(rows)[0]}
    got = {r["doc_id"]: r["kept_sha256"] for r in CHECKS["op3_fuzzy_lines"].run(spark, SF).collect()}
    assert got == want


def test_fm_index_against_brute_force():
    rng = random.Random(11)
    for _ in range(80):
        window, letters = rng.choice([1, 2, 3, 5]), rng.choice([2, 3, 6])
        held = [np.array([rng.randint(1, letters) for _ in range(rng.randint(0, 14))], np.int64) for _ in range(rng.randint(1, 7))]
        owner = np.array([rng.randint(0, 9) for _ in held])
        index = FmIndex(held, owner, window)
        queries = [np.array([rng.randint(1, letters + 1) for _ in range(rng.randint(0, 20))], np.int64) for _ in range(4)]

        def found(words):
            return [int(d) for s, d in zip(held, owner) for i in range(len(s) - len(words) + 1) if s[i : i + len(words)].tolist() == words]

        for query, (length, lowest) in zip([*queries, *held], index.stream([*queries, *held])):
            q = query.tolist()
            for i in range(len(q)):
                n = 0
                while i + n < len(q) and found(q[i : i + n + 1]):
                    n += 1
                inside = found(q[i : i + window]) if i + window <= len(q) else []
                assert length[i] == n and lowest[i] == min(inside, default=FmIndex.NOWHERE)


def brute_substrings(rows, window):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (_, text) in zip(words, rows):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        stay = b" ".join(x for k, x in enumerate(w) if k not in gone).decode()
        out.append((i, None if text is None else stay, len(w), len(gone)))
    return out


@pytest.mark.parametrize(("window", "hot"), [(50, 2000), (7, 2000), (7, 2), (1, 2000)])
def test_substrings_against_brute_force(docs, monkeypatch, window, hot):
    monkeypatch.setattr(substrings, "MOST_PIECES", hot)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    rng = random.Random(12)

    def some(n):
        return " ".join(f"v{rng.randrange(5000)}" for _ in range(n))

    shared, other = some(70), some(55)
    texts = [some(rng.randint(0, 90)) for _ in range(20)]
    texts += [f"{some(rng.randint(0, 60))} {shared}\t{some(rng.randint(0, 60))}" for _ in range(15)]
    texts += [f"{other} {shared[: len(shared) // 2]}", shared, shared, other + " " + other, "", " \n", "be " * 300, "be " * 200 + some(9)]
    texts += [some(20_000) + " " + shared, "É" + other, shared.upper()]
    rows = docs(*((i * 3, t) for i, t in enumerate(texts)), (2000, None), (63, texts[21]), (None, shared), (5, shared[2:]))
    rows = rows.withColumn("n_words", F.lit("own"))
    plain = [(r["doc_id"], r["text"]) for r in rows.collect()]
    out = substrings.dedup_substrings(rows, window=window)
    assert out.columns == ["doc_id", "text", "source", "n_words", "n_words_", "n_removed"]
    got = [(r["doc_id"], r["text"], r["n_words_"], r["n_removed"]) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_substrings(plain, window)))


def test_query_op10_and_an_empty_table(spark, docs):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, gone in brute_substrings(rows, 50)}
    got = {r["doc_id"]: tuple(r)[1:] for r in CHECKS["op10_fm_substring"].run(spark, SF).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 0
    assert substrings.dedup_substrings(docs().limit(0)).count() == 0


def test_query_op10_with_a_null_text(spark, docs, tmp_path):
    shared = " ".join(f"s{i}" for i in range(60))
    docs((1, shared), (2, None), (3, f"own {shared}"), (4, "")).write.parquet(f"{tmp_path}/documents.parquet")
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in (shared, "own", "")}
    got = {r["doc_id"]: tuple(r)[1:] for r in CHECKS["op10_fm_substring"].run(spark, str(tmp_path)).collect()}
    assert got == {1: (60, 0, digest[shared]), 2: (0, 0, digest[""]), 3: (61, 60, digest["own"]), 4: (0, 0, digest[""])}


def test_pipeline_against_its_stages(spark):
    """Every stage by brute force on what the one before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = measure([t for _, t in rows], RepetitionRules())["kept"]
    rows = [r for r, k in zip(rows, kept) if k]
    rows = brute_lines(rows)[0]
    prints = [brute_fingerprint(t) for _, t in rows]
    low = groups(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    lowest = {}
    for i, (id_, _) in enumerate(rows):
        lowest[low[i]] = min(lowest.get(low[i], id_), id_)
    rows = [r for i, r in enumerate(rows) if r[0] == lowest[low[i]]]
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} <= {i for i, _ in rows}
    text = dict(rows)
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in out)
    stay = spark.createDataFrame(rows, "doc_id long, text string").join(docs.select("doc_id", "source"), "doc_id")
    mixed = poisson_mix(stay, MIX_WEIGHTS, other=MIX_OTHER, seed=MIX_SEED)
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in out)
    docs_columns = set(docs.columns)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert set(stage(spark, docs.limit(5), SF).columns) == docs_columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_the_pipeline_leaves_one_table(spark):
    """Tables of its stages go as it runs; what stays is the one that the last stage reads."""
    before = {e.name for e in entries(spark, f"{shared_dir(spark)}/lakestrata")}
    rows = corpus_pipeline.run(spark, SF)
    after = {e.name for e in entries(spark, f"{shared_dir(spark)}/lakestrata")} - before
    assert [name.split("-")[0] for name in after] == ["mixing_to_weights"]
    assert rows.count() > 0
