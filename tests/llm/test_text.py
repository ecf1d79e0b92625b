"""Operators inside documents: token spans, repetition, BPE."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lakestrata.llm import bpe
from lakestrata.llm.queries import CHECKS
from lakestrata.llm.queries_text import PATTERN, RANKS
from lakestrata.llm.repetition import STATS, RepetitionRules, keep_clean, measure, repetition_stats
from lakestrata.llm.suffixes import repeat_lengths
from lakestrata.llm.token_spans import line_sections, section_tokens, with_sections

SF = "/root/testdata/sf0.001"
ALPHABET = [*"ab  \n\t'slté漢😀12.!-AZ", " the", "ing", "\xa0", " "]
HARD = ["", " ", "\n\n", "a" * 5000, " " * 3000, "%=" * 400, "\x00" * 200, "don't  we'll\t\t x", "漢字" * 50, "é" * 20]


@pytest.fixture(scope="module")
def tokens():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def vocabulary(tokens):
    return bpe.build_vocabulary(tokens)


@pytest.fixture(scope="module")
def reference(tokens):
    ranks = {t: i for i, t in enumerate(tokens)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_text(rng, most):
    return "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, most)))


def test_encoding_equals_tiktoken(vocabulary, reference):
    rng, tokenizer = random.Random(1), bpe.Tokenizer(vocabulary, PATTERN)
    texts = [some_text(rng, 300) for _ in range(400)] + HARD
    got = tokenizer.encode_all(texts)
    assert got == [reference.encode_ordinary(t) for t in texts] == [tokenizer.encode(t) for t in texts]
    assert [tokenizer.decode(ids).decode() for ids in got] == texts
    assert tokenizer.encode(None) == []


def test_prefix_tokens_are_those_of_each_prefix(vocabulary, reference):
    encoder = bpe.PrefixEncoder(vocabulary)
    piece = b" unbelievablytheing"
    last = encoder.last_tokens(piece)
    for n in range(1, len(piece) + 1):
        assert encoder.walk_back(last[:n])[-1] == last[n - 1]
    assert encoder.last_tokens(piece, last[:7]) == last
    assert encoder.walk_back(last) == reference._encode_single_piece(piece)


def test_edits_follow_a_new_encoding(vocabulary, reference):
    rng, tokenizer = random.Random(2), bpe.Tokenizer(vocabulary, PATTERN)
    for _ in range(60):
        text = bpe.EditableText(tokenizer, some_text(rng, 60))
        for _ in range(5):
            start = rng.randint(0, len(text.text))
            text.replace(start, rng.randint(start, min(len(text.text), start + 8)), some_text(rng, 6))
            assert text.ids() == reference.encode_ordinary(text.text)
        text.append(some_text(rng, 9))
        assert text.ids() == reference.encode_ordinary(text.text)


def test_encode_and_decode_frames(spark, docs, reference):
    vocabulary = bpe.share_vocabulary(spark, RANKS)
    rows = docs(*enumerate(HARD), (50, None), (1, HARD[1])).withColumn("token_ids", F.lit("own"))
    out = bpe.encode_texts(rows, vocabulary, PATTERN, decoded_col="decoded")
    assert out.columns == ["doc_id", "text", "source", "token_ids", "token_ids_", "decoded"]
    back = bpe.decode_ids(out, vocabulary, ids_col="token_ids_", bytes_col="again")
    got = back.collect()
    assert len(got) == len(HARD) + 2
    for r in got:
        assert r["token_ids_"] == reference.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == bytes(r["again"]).decode() == (r["text"] or "")
    assert bpe.encode_texts(rows.limit(0), vocabulary, PATTERN).count() == 0


def test_vocabulary_is_checked():
    byte = [bytes([b]) for b in range(256)]
    with pytest.raises(ValueError):
        bpe.build_vocabulary(byte[:-1])
    with pytest.raises(ValueError):
        bpe.build_vocabulary([*byte, b"abc"])


def test_query_op8(spark, reference):
    for r in CHECKS["op8_byte_bpe"].run(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect():
        ids = reference.encode_ordinary(r["text"])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def brute_base(text):
    """The base columns of the contract, word by word."""
    words = (text or "").encode().split()
    spots = {}
    for i in range(len(words) - 4):
        spots.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {k for at in spots.values() if len(at) > 1 for i in at for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return (
        len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(repeated), failed,
    )


def test_repeat_lengths_against_brute_force():
    import numpy as np

    rng = random.Random(3)
    for _ in range(200):
        parts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 20))] for _ in range(3)]
        flat = np.array([w for p in parts for w in p], np.int64)
        size = np.array([len(p) for p in parts])
        got = repeat_lengths(flat, np.repeat(np.arange(3), size), np.repeat(np.cumsum(size), size), 2).tolist()
        want = []
        for p in parts:
            for i in range(len(p)):
                best = 0
                for j in range(len(p)):
                    n = 0
                    while i != j and max(i, j) + n < len(p) and p[i + n] == p[j + n]:
                        n += 1
                    best = max(best, n)
                want.append(best if best >= 2 else 0)
        assert got == want


def brute_repeats(text, least=10, window=5):
    """Share of the words' bytes in windows of `least` words found twice, and the longest run of words found twice."""
    words = (text or "").encode().split()

    def twice(n):
        found = {}
        for i in range(len(words) - n + 1):
            found.setdefault(tuple(words[i : i + n]), []).append(i)
        return [i for at in found.values() if len(at) > 1 for i in at]

    held = {i + k for i in twice(least) for k in range(least)}
    low, high = 0, len(words)  # runs shorter than one found twice are found twice as well
    while low < high:
        n = (low + high + 1) // 2
        low, high = (n, high) if twice(n) else (low, n - 1)
    return sum(len(words[i]) for i in held) / max(1, sum(map(len, words))), low if low >= window else 0


def test_query_op5_against_windows_found_twice(spark):
    """The verdict of every text of the table, by other means than suffixes."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    verdicts = set()
    for r in CHECKS["op5_suffix_repetition"].run(spark, SF).collect():
        covered, longest = brute_repeats(texts[r["doc_id"]])
        assert r["covered"] == pytest.approx(covered) and r["longest_repeat"] == longest
        assert r["kept"] == (not r["base_failed"] and covered <= 0.10 and longest <= 50)
        verdicts.add((r["base_failed"], r["kept"]))
    assert len(verdicts) > 1


def test_query_op5_and_the_base_rule(spark):
    rows = CHECKS["op5_suffix_repetition"].run(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    for r in rows.collect():
        base = brute_base(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base
        assert not (r["kept"] and r["base_failed"])


def test_repetition_edges(docs, spark):
    clean = " ".join(f"w{i}" for i in range(300))
    passage = " ".join(f"p{i}" for i in range(60))
    texts = ["", "one two", clean, "be " * 400, f"{clean}\n{passage}\n{passage}", f"{passage} {clean} {clean[:700]}", "é é " * 12, "x" * 200_000]
    rows = docs(*enumerate(texts), (90, None), (2, clean)).withColumn("kept", F.lit("own"))
    out = repetition_stats(rows, carry=["doc_id", "kept"])
    assert out.columns == ["doc_id", "kept", *(n if n != "kept" else "kept_" for n, _ in STATS)]
    got = {r["doc_id"]: r for r in out.collect()}
    for i, text in enumerate([*texts]):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_base(text)
    assert got[2]["kept_"] and not got[3]["kept_"] and got[90]["base_failed"]
    assert got[4]["longest_repeat"] == 60 and got[3]["longest_repeat"] == 399 and got[3]["covered"] == 1.0
    kept = keep_clean(rows)
    assert kept.columns == rows.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept_"]}
    assert kept.where("doc_id = 2").count() == 2 and keep_clean(rows.limit(0)).count() == 0


def test_the_longest_repeat_alone_can_fail_a_text():
    rules = RepetitionRules(most_repeat_percent=100, most_covered=1.0, longest_repeat=20, longest_share=0.05)
    text = " ".join([*(f"a{i}" for i in range(30)), *(f"b{i}" for i in range(100)), *(f"a{i}" for i in range(30))])
    assert not measure([text], rules)["kept"][0] and measure([text.replace("a5", "c5", 1)], rules)["longest_repeat"][0] < 30


def test_the_second_rule_rejects_what_the_base_accepts():
    def words(name, n):
        return [f"{name}{i}" for i in range(n)]

    def around(passages, rest):
        step = len(rest) // (2 * len(passages))
        return " ".join(w for k, p in enumerate(passages * 2) for w in p + rest[k * step : (k + 1) * step])

    texts = {
        "a tenth twice": around([words("p", 390)], words("a", 3220)),
        "a passage in a long text": around([words("p", 60)], words("a", 99_880)),
        "many short repeats": around([words(f"p{k}x", 15) for k in range(5)], words("a", 850)),
        "few short repeats": around([words(f"p{k}x", 15) for k in range(2)], words("a", 940)),
        "a short repeat in a long text": around([words("p", 50)], words("a", 99_900)),
        "clean": " ".join(words("a", 100_000)),
    }
    found = measure(list(texts.values()), RepetitionRules())
    assert found["n_words"].tolist() == [4000, 100_000, 1000, 1000, 100_000, 100_000]
    assert found["longest_repeat"].tolist() == [390, 60, 15, 15, 50, 0]
    assert not found["base_failed"].any()
    assert found["kept"].tolist() == [False, False, False, True, True, True]


def brute_tokens(reference, text, sections, rule):
    """Tokens and shares per section, byte by byte."""
    owner, at = [], 0
    for ch_at, ch in enumerate(text):
        claims = [k for k, (_, a, b) in sorted(enumerate(sections), key=lambda x: (x[1][1], x[0])) if a <= ch_at < b]
        owner += [claims[0] if claims else None] * len(ch.encode())
    count, share, crossing = {}, {}, {}
    for token in reference.encode_ordinary(text):
        size = len(reference.decode_single_token_bytes(token))
        held = owner[at : at + size]
        at += size
        for k in held:
            share[k] = share.get(k, 0) + 1 / size
        inside = [k for k in held if k is not None]
        order = list(dict.fromkeys(inside))
        to = None if not order else order[0] if rule == "first" else max(order, key=lambda k: (inside.count(k), -order.index(k)))
        count[to] = count.get(to, 0) + 1
        crossing[to] = crossing.get(to, 0) + (to is not None and len(set(held)) > 1)
    return count, share, crossing


@pytest.mark.parametrize("rule", ["most", "first"])
def test_section_tokens_against_brute_force(spark, docs, reference, rule):
    rng = random.Random(4)
    texts = [some_text(rng, 60) for _ in range(40)] + ["", "漢字 the", "hello world " * 2000]
    sections, flat = {}, []
    for i, t in enumerate(texts):
        cuts = sorted(rng.randint(0, len(t) + 2) for _ in range(6))
        sections[i] = [("a", cuts[0], cuts[2]), ("b", cuts[1], cuts[3]), ("c", cuts[4], cuts[4]), ("d", cuts[4], cuts[5])]
        flat += [(i, *s) for s in sections[i]]
    table = spark.createDataFrame([*flat, (0, "null", None, 3)], "doc_id long, section string, start long, end long")
    rows = with_sections(docs(*enumerate(texts), (90, None)), table)
    out = section_tokens(rows, RANKS, PATTERN, "sections", rule=rule)
    got = {(r["doc_id"], r["section"]): r for r in out.collect()}
    for i, t in enumerate(texts):
        count, share, crossing = brute_tokens(reference, t, sections[i], rule)
        names = {k: s[0] for k, s in enumerate(sections[i])} | {None: None}
        for k, name in names.items():
            r = got.get((i, name))
            assert (r["n_tokens"] if r else 0) == count.get(k, 0)
            assert (r["token_share"] if r else 0) == pytest.approx(share.get(k, 0))
            assert name is None or r["n_crossing"] == crossing.get(k, 0)
    assert (90, "a") not in got


def test_query_op2_line_by_line(spark, reference):
    """Every row of the query against attribution byte by byte."""
    got = {}
    for r in CHECKS["op2_token_spans"].run(spark, SF).collect():
        got.setdefault(r["doc_id"], {})[r["section"]] = r
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    for i, text in texts:
        sections, at = [], 0
        for k, line in enumerate(text.split("\n")):
            sections.append((str(k), at, min(at + len(line) + 1, len(text))))
            at += len(line) + 1
        count, share, crossing = brute_tokens(reference, text, sections, "most")
        assert set(got[i]) == {name for name, _, _ in sections}
        for k, (name, start, end) in enumerate(sections):
            r = got[i][name]
            assert (r["start"], r["end"], r["n_tokens"], r["n_crossing"]) == (start, end, count.get(k, 0), crossing.get(k, 0))
            assert r["token_share"] == pytest.approx(share.get(k, 0))


def test_line_sections_and_query_op2(spark, docs, reference):
    assert line_sections("a\n\nb") == [("0", 0, 2), ("1", 2, 3), ("2", 3, 4)] and line_sections("") == [("0", 0, 0)]
    rows = CHECKS["op2_token_spans"].run(spark, SF).groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.sum("token_share").alias("s"))
    for r in rows.join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect():
        assert r["n"] == len(reference.encode_ordinary(r["text"])) == pytest.approx(r["s"])
    with pytest.raises(ValueError):
        section_tokens(docs((1, "x")), RANKS, PATTERN, rule="half")
    assert section_tokens(docs().limit(0), RANKS, PATTERN).count() == 0
