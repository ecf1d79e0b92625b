"""Operators that SQL expresses: rows against SQL on the small tables, and the defined cases."""

from __future__ import annotations

import hashlib
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lakestrata.llm.common import running_starts
from lakestrata.llm.mixing import MEAN_PER_DRAW, poisson_mix, thresholds
from lakestrata.llm.preference import format_pairs
from lakestrata.llm.queries import CHECKS
from lakestrata.llm.secret_scan import ALL_RULES, BASE_RULES, Rule, find_secrets, listed, trigram_query
from verify import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, c in CHECKS.items() if c.sql is not None])
def test_query_agrees_with_sql(spark, name):
    check = CHECKS[name]
    assert difference(connect(FOLDER), SimpleNamespace(sql=check.sql), check.run(spark, FOLDER)) is None


def test_mix_keeps_columns_and_order(docs):
    rows = docs(*((i, f"text {i}", "a" if i % 3 else "b") for i in range(300)), (None, None, None), (7, "", "b"))
    rows = rows.withColumn("copy", F.lit("own")).withColumn("rate", F.lit(0))
    mixed = poisson_mix(rows, {"a": 0.5}, other=0.5, epochs=2.0)
    assert mixed.columns == ["doc_id", "text", "source", "copy", "rate", "rate_", "copy_", "shuffle_key"]
    got = mixed.collect()
    assert sorted(map(str, got)) == sorted(map(str, poisson_mix(rows.repartition(7), {"a": 0.5}, other=0.5, epochs=2.0).collect()))
    assert len({r["shuffle_key"] for r in got}) > len(got) * 0.98  # equal ids have equal keys
    chars = sum(max(1, len(r["text"] or "")) for r in got if r["source"] == "a")
    assert 0.4 < chars / sum(max(1, len(r["text"] or "")) for r in got) < 0.6


def test_mix_edges(docs, spark):
    assert poisson_mix(docs().limit(0), {"a": 1.0}, other=0.0).count() == 0
    rows = docs((1, "x", "a"), (2, "y", "b"))
    assert poisson_mix(rows, {"a": 0.0}, other=0.0).count() == 0
    assert {r["source"] for r in poisson_mix(rows, {"a": 1.0, "gone": 5.0}, other=0.0, epochs=20.0).collect()} == {"a"}
    many = poisson_mix(rows, {"a": 1.0}, other=1.0, epochs=3 * MEAN_PER_DRAW).count()
    assert abs(many - 2 * 3 * MEAN_PER_DRAW) < 100
    with pytest.raises(ValueError):
        poisson_mix(rows, {"a": -1.0}, other=0.0)


def test_thresholds_are_a_distribution():
    for mean in (0.01, 1.0, 64.0):
        steps = thresholds(mean)
        assert all(a <= b for a, b in zip(steps, steps[1:])) and abs(steps[-1] - 1) < 1e-9
        assert abs(sum(1 - s for s in steps) - mean) < 1e-6


def test_preference_prefix_masks_and_edges(spark):
    ddl = "pair_id long, turn long, role string, text string, prompt string"
    chosen = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "one", "x"), (1, 2, "user", "é", "x"), (1, 3, "assistant", "yes", "x"),
        (2, 0, "user", "same", "x"), (3, 0, None, None, "x"), (None, 0, "user", "lost", "x"),
    ]
    rejected = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "one", "x"), (1, 5, "assistant", "no", "x"),
        (2, 0, "user", "same", "x"), (4, 0, "assistant", "only", "x"),
    ]
    out = format_pairs(spark.createDataFrame(chosen, ddl), spark.createDataFrame(rejected, ddl))
    got = {r["pair_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 3, 4}
    one = got[1]
    assert one["prompt"] == "<|user|>\nhi<|end|>\n<|assistant|>\none<|end|>\n" and one["n_prompt_turns"] == 2
    assert one["chosen"] == "<|user|>\né<|end|>\n<|assistant|>\nyes<|end|>\n"
    for text, mask in ((one["chosen"], one["chosen_mask"]), (one["rejected"], one["rejected_mask"])):
        (start, end), = [tuple(map(int, m.split("-"))) for m in mask.split(",")]
        assert text[start:end] in ("yes<|end|>\n", "no<|end|>\n")
    assert (got[2]["chosen"], got[2]["rejected"], got[2]["n_prompt_turns"]) == ("", "", 1)
    assert got[3]["chosen"] == "<||>\n<|end|>\n" and got[4]["rejected_mask"] == "14-26"
    empty = spark.createDataFrame([], ddl)
    assert format_pairs(empty, empty).count() == 0


def spans_by_re(text: str, rules=ALL_RULES) -> str:
    found = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text, re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), order, m.end(), rule.kind))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def test_secrets_against_re(docs):
    texts = [
        "password = 'abcdef'", "PassWd:\"a1b2c3\" token=token=abc secret: abcde", "secret=token: abcdefghi", "AKIA" + "A" * 16,
        "AKIAAKIA" + "B" * 11, "AKIAAKIA" + "B" * 12, "é" * 5 + "0123456789abcdef01234567" + "g" + "0" * 23, "api_key=x" * 3,
        "apikey : zzzzzz-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36, "", "  ", "eyJab.eyJcd.ef xoxb-1234567890-a",
        "😀token:abcdef" + "deadbeef" * 3, "AIza" + "x" * 35, "0" * 100_000 + " password=" + "x" * 100_000,
    ]
    rows = docs(*enumerate(texts), (99, None), (3, texts[3]), (None, "token=123456"))
    rows = rows.withColumn("secrets", F.lit(1)).withColumn("kinds", F.lit(2)).withColumn("id", F.lit(3))
    out = find_secrets(rows)
    assert out.columns == ["doc_id", "text", "source", "secrets", "kinds", "id", "secrets_"]
    got = sorted((str(r[0]), r[1]) for r in out.select("doc_id", listed(F.col("secrets_"))).collect())
    want = [(str(i), spans_by_re(t)) for i, t in enumerate(texts)]
    assert got == sorted([*want, ("99", ""), want[3], ("None", "assign:0:12")])
    assert find_secrets(rows.limit(0)).count() == 0
    assert find_secrets(docs((1, "0" * 24)), BASE_RULES[2:]).count() == 1  # nothing to index


def test_trigram_queries():
    assert trigram_query("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert trigram_query("[0-9a-f]+") == [frozenset()]
    assert trigram_query("ab?c") == [frozenset()] and trigram_query("(abc)?d") == [frozenset()]
    assert sorted(map(sorted, trigram_query("abc|xyz1"))) == [["abc"], ["xyz", "yz1"]]
    assert trigram_query("(?:abc)+") == [frozenset({"abc"})]
    assert trigram_query("abc.def") == [frozenset({"abc", "def"})]
    for rule in (*ALL_RULES, Rule("x", "a[bc]d(ef|gh)?")):
        for text in ("password=abcdef", "API_KEY: 'zzzzzz'", "AKIA" + "Z" * 16, "abd", "acdgh"):
            if re.search(rule.pattern, text, re.ASCII):
                assert any(all(t in text.lower() for t in clause) for clause in trigram_query(rule.pattern))


def test_running_starts(spark):
    for n in (0, 1, 31, 32, 33, 100, 40_000):
        sizes = [(i * 7919) % 13 for i in range(n)]
        row = spark.createDataFrame([(sizes,)], "s array<int>").select(running_starts(F.col("s")).alias("at")).first()
        assert row["at"] == [sum(sizes[:i]) for i in range(n)] if n < 1000 else row["at"][-1] == sum(sizes[:-1])


def test_thousands_of_secrets_in_one_text(docs):
    """A checksum list: far over what work that is quadratic in the matches would end."""
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(40_000))
    got = find_secrets(docs((1, text))).first()["secrets"]
    assert [(s["start"], s["end"]) for s in got] == [(33 * i, 33 * i + 32) for i in range(40_000)]


def test_a_conversation_of_thousands_of_turns(spark):
    n, ddl = 30_000, "pair_id long, turn long, role string, text string"
    rows = [(1, i, "assistant" if i % 2 else "user", str(i % 10)) for i in range(n)]
    other = [(p, t, r, x + "!") for p, t, r, x in rows]
    got = format_pairs(spark.createDataFrame(rows, ddl), spark.createDataFrame(other, ddl)).first()
    spans = [tuple(map(int, s.split("-"))) for s in got["rejected_mask"].split(",")]
    assert len(spans) == n // 2
    assert {got["rejected"][a:b] for a, b in spans[-10:]} == {f"{i}!<|end|>\n" for i in (1, 3, 5, 7, 9)}
