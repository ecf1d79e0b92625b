"""Edge rows of the operators."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakestrata.functions.expressions import hms, local_date, mean_of_present, mean_with_total
from lakestrata.operators.analytics import profile, share_by, top_k
from lakestrata.operators.changes import (
    changed_rows,
    digest,
    has_changed,
    new_or_changed,
    not_in,
    row_hashes,
    schema_diff,
    upsert,
)
from lakestrata.operators.chunks import assign_chunks, chunk
from lakestrata.operators.columns import (
    align_columns,
    drop_columns,
    epoch_to_timestamp,
    fill_label,
    incremental_filter,
    sort_columns,
)
from lakestrata.operators.dedup import has_duplicates, latest_by
from lakestrata.operators.enrich import decode, fan_out, lookup, with_parent
from lakestrata.operators import match
from lakestrata.operators.edits import near_in_blocks
from lakestrata.operators.match import best_match, nearest_names, parse_records, pick_best, similar_names
from lakestrata.operators.membership import membership
from plans import plan


# --- membership --------------------------------------------------------------


@pytest.fixture
def games(frame):
    return frame(
        "id long, members array<long>",
        (1, None),
        (2, []),
        (3, [10]),
        (4, [10, 20]),
        (5, [10, 10]),
        (6, [99]),
        (7, [None]),
    )


@pytest.fixture
def genres(frame):
    return frame("id long, name string", (10, "Indie"), (20, "Puzzle"))


def test_membership_drops_empty_arrays_and_keeps_null_ones(games, genres, rows):
    got = membership(games, ["id"], "members", "m", genres, {"name": "g"}, {"g": "(none)"})
    games_seen = [(r[0], r[1], r[2]) for r in rows(got, "id", "m", "g")]
    assert games_seen == [
        (1, None, "(none)"),
        (3, 10, "Indie"),
        (4, 10, "Indie"),
        (4, 20, "Puzzle"),
        (5, 10, "Indie"),
        (5, 10, "Indie"),
        (6, 99, "(none)"),
        (7, None, "(none)"),
    ]


def test_membership_can_keep_empty_arrays(games, genres, rows):
    got = membership(games, ["id"], "members", "m", genres, {"name": "g"}, empty="keep")
    assert (2, None, None) in rows(got, "id", "m", "g")
    assert got.count() == 9


def test_membership_row_count_is_sizes_plus_nulls(games, genres):
    got = membership(games, ["id"], "members", "m", genres, {"name": "g"})
    expected = games.agg(F.sum(F.expr("if(members is null, 1, size(members))"))).first()[0]
    assert got.count() == expected


# --- decode and lookup -------------------------------------------------------


def test_decode_compares_padded_codes_as_numbers(frame, rows):
    facts = frame("id long, country long", (1, 4), (2, 8), (3, None), (4, 0))
    enum = frame("name string, value string", ("Afghanistan", "004"), ("Nowhere", "zz"))
    got = rows(decode(facts, "country", enum), "id", "country")
    assert got == [(1, "Afghanistan"), (2, None), (3, None), (4, None)]


def test_decode_into_keeps_the_code(frame, rows):
    facts = frame("id long, country long", (1, 4))
    enum = frame("name string, value string", ("Afghanistan", "004"))
    assert rows(decode(facts, "country", enum, into="name")) == [(1, 4, "Afghanistan")]


def test_decode_without_enum_table(frame):
    facts = frame("id long, country long", (1, 4))
    assert decode(facts, "country", None, optional=True) is facts
    with pytest.raises(ValueError):
        decode(facts, "country", None)


def test_decode_text_codes_as_text(frame, rows):
    facts = frame("id long, code string", (1, "a"), (2, "b"))
    enum = frame("name string, value string", ("A", "a"))
    assert rows(decode(facts, "code", enum), "id", "code") == [(1, "A"), (2, None)]


def test_lookup_takes_the_id_of_the_dimension(frame, rows):
    facts = frame("id long, platform long", (1, 7), (2, 8))
    dim = frame("id long, name string", (7, "PC"))
    got = lookup(facts, "platform", dim, {"id": "platform_id", "name": "platform_name"})
    assert got.columns == ["id", "platform_id", "platform_name"]
    assert rows(got) == [(1, 7, "PC"), (2, None, None)]


def test_parent_defaults_to_the_company_itself(frame, rows):
    companies = frame(
        "id long, name string, parent long", (1, "a", None), (2, "b", 1), (3, "c", 99)
    )
    got = with_parent(companies, "id", "parent", "name")
    assert rows(got, "id", "parent", "parent_name") == [(1, 1, "a"), (2, 1, "a"), (3, 99, "c")]


def test_fan_out_is_a_left_join(frame, rows):
    left = frame("k long, a string", (0, "zero"), (1, "one"), (2, "two"), (None, "null"))
    right = frame("k long, b long", (0, 5), (1, 10), (1, 11), (3, 30), (None, 40))
    got = fan_out(left, "k", right, {"b": "b"}, other_key="k")
    assert rows(got, "k", "a", "b") == rows(
        left.join(right.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "left"),
        "k",
        "a",
        "b",
    )
    assert got.count() == 5


# --- columns -----------------------------------------------------------------


def test_drop_ignores_unknown_names_and_sort_orders(frame):
    df = frame("b long, a long, c long", (1, 2, 3))
    assert sort_columns(drop_columns(df, ["c", "nope"])).columns == ["a", "b"]


def test_align_adds_typed_nulls(frame):
    df = frame("a long", (1,))
    other = frame("a long, b array<string>", (1, ["x"]))
    assert align_columns(df, other.schema).schema["b"].dataType == other.schema["b"].dataType


def test_epoch_to_timestamp(frame):
    df = epoch_to_timestamp(frame("at long", (0,), (None,)), ["at"])
    got = {str(r[0]) for r in df.select(F.col("at").cast("string")).collect()}
    assert got == {"1970-01-01 00:00:00", "None"}


def test_fill_label_on_a_number_column(frame, rows):
    assert rows(fill_label(frame("g long", (7,), (None,)), {"g": "(none)"})) == [
        ("(none)",),
        ("7",),
    ]


def test_incremental_filter_is_strict(frame, rows):
    df = frame("at long", (1,), (2,), (3,))
    assert rows(incremental_filter(df, "at", 2)) == [(3,)]
    assert incremental_filter(df, "at", None).count() == 3


# --- latest and upsert -------------------------------------------------------


def test_latest_puts_null_dates_last_and_breaks_ties(frame, rows):
    df = frame(
        "id long, at long, v string",
        (1, 5, "old"),
        (1, 9, "new"),
        (2, 5, "a"),
        (2, 5, "b"),
        (3, None, "x"),
        (3, 1, "y"),
        (4, None, "only"),
    )
    assert rows(latest_by(df, "id", "at", ["v"]), "id", "v") == [
        (1, "new"),
        (2, "b"),
        (3, "y"),
        (4, "only"),
    ]
    assert rows(latest_by(df, "id", None, ["v"]), "id", "v")[0] == (1, "old")
    with pytest.raises(ValueError):
        latest_by(df, "id", "at", [])


def test_has_duplicates(frame):
    assert has_duplicates(frame("k long", (1,), (1,), (None,)), "k").first().asDict() == {
        "n_rows": 3,
        "n_keys": 2,
        "has_duplicates": True,
    }
    assert not has_duplicates(frame("k long"), "k").first()["has_duplicates"]


@pytest.fixture
def base(frame):
    return frame("id long, a string, b long", (1, "x", 10), (2, "y", 20))


def test_upsert_updates_and_inserts(base, frame, rows):
    updates = frame("id long, a string, b long", (2, "z", 21), (3, "w", 30))
    got = upsert(base, updates, "id")
    assert rows(got, "id", "a", "b") == [(1, "x", 10), (2, "z", 21), (3, "w", 30)]
    assert rows(upsert(got, updates, "id")) == rows(got)


def test_upsert_keeps_values_of_missing_columns(base, frame, rows):
    updates = frame("id long, a string", (2, None), (3, "w"))
    assert rows(upsert(base, updates, "id"), "id", "a", "b") == [
        (1, "x", 10),
        (2, None, 20),
        (3, "w", None),
    ]
    overwritten = upsert(base, updates, "id", overwrite_missing=True)
    assert (2, None, None) in rows(overwritten, "id", "a", "b")


def test_upsert_adds_new_columns_and_takes_empty_batches(base, frame, rows):
    updates = frame("id long, a string, b long, c long", (3, "w", 1, 5))
    assert upsert(base, updates, "id").columns == ["id", "a", "b", "c"]
    assert rows(upsert(base, updates.limit(0), "id"), "id", "a", "b") == rows(base)
    assert upsert(None, updates, "id") is updates


# --- change detection --------------------------------------------------------


def test_changed_rows_counts_copies(frame, rows):
    current = frame("a long, b long", (1, 1), (1, 1), (2, 2))
    previous = frame("b long, a long", (1, 1))
    assert rows(changed_rows(current, previous)) == [(1, 1), (2, 2)]
    assert changed_rows(current, current).count() == 0


WIDE = "a long, b string, c double, d array<long>, e struct<x:long,y:string>, f timestamp"


def wide_rows(dice, n):
    """Many nulls and few values, so that rows repeat and nulls change places."""
    pick = lambda *values: dice.choice([None, *values])
    moment = datetime(2024, 1, 1, 0, 0, 0, 1)
    return [
        (
            pick(1, 2), pick("x", "", "null"), pick(0.5, -1.0), pick([], [1, None], [None, 1], [1]),
            pick((1, None), (None, "1"), (None, None)), pick(moment, moment.replace(microsecond=2)),
        )
        for _ in range(n)
    ]


def test_only_rows_held_fewer_times_are_compared_by_value(spark, monkeypatch):
    from lakestrata.operators import changes

    written, write = {}, changes.materialize
    monkeypatch.setattr(changes, "materialize", lambda df, label: written.setdefault(label, write(df, label)))
    held = spark.range(40).select(*(F.col("id").alias(c) for c in "abcd"))
    now = held.withColumn("d", F.when(F.col("a") >= 10, F.col("d"))).unionByName(held.where("a = 20"))
    got = Counter((r["a"], r["d"]) for r in changed_rows(now, held).collect())
    assert got == Counter({**{(i, None): 1 for i in range(10)}, (20, 20): 1})
    assert (written["changed-hashes"].count(), written["changed-partly"].count()) == (11, 1)


def test_changed_rows_of_wide_tables_equal_except_all(frame):
    dice = random.Random(5)
    old = wide_rows(dice, 1500)
    new = old[:1400] + wide_rows(dice, 60) + old[:20]
    current, previous = frame(WIDE, *new).repartition(3), frame(WIDE, *old).repartition(5)
    got = Counter(map(str, changed_rows(current, previous.select("f", "e", "d", "c", "b", "a")).collect()))
    assert got == Counter(map(str, current.exceptAll(previous).collect())) and got
    assert changed_rows(current, current.repartition(7)).isEmpty()


def test_row_hashes_tell_nulls_apart(frame):
    rows = set(wide_rows_hashable(4000))
    df = frame(WIDE, *(tuple(list(v) if k == 3 and v is not None else v for k, v in enumerate(r)) for r in rows))
    for h in (*row_hashes(df.schema), row_hashes(df.schema, F.hash)[1]):
        assert df.select(h).distinct().count() == len(rows)


def wide_rows_hashable(n):
    return [tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in wide_rows(random.Random(6), n)]


def test_digest_does_not_depend_on_order(frame):
    rows = wide_rows(random.Random(7), 300)
    df = frame(WIDE, *rows)
    same = frame(WIDE, *reversed(rows)).repartition(7).select("c", "b", "f", "a", "e", "d")
    assert digest(df) == digest(same)
    assert digest(df) != digest(df.unionByName(df.limit(1)))
    assert digest(df) != digest(df.withColumn("a", F.coalesce("a", F.lit(3))))
    assert str(digest(df.limit(0))) == "0:0:0"
    assert digest(frame("a string, b string", ("x", None))) != digest(frame("a string, b string", (None, "x")))


def test_new_or_changed_leaves_held_out(frame, rows):
    current = frame("id long, n string", (1, "a"), (2, "b"), (3, "c"))
    previous = frame("id long, n string", (1, "a"), (2, "old"))
    assert rows(new_or_changed(current, previous, frame("id long", (3,)), "id")) == [(2, "b")]


def test_not_in_keeps_null_keys(frame, rows):
    left = frame("id long", (1,), (None,))
    assert rows(not_in(left, frame("id long", (1,), (None,)), "id")) == [(None,)]


def test_has_changed(frame):
    old = frame("a long, b string", (1, "x"), (1, "x"), (2, None))
    assert not has_changed(old, old.select("b", "a"))
    assert has_changed(old, old.where("a = 1"))
    more = old.union(frame("a long, b string", (3, "y")))
    assert has_changed(old, more)
    assert not has_changed(old, more, symmetric=False)
    assert has_changed(old, old.withColumn("c", F.lit(1)))
    assert has_changed(old, old.withColumn("a", F.col("a").cast("string")))


def test_schema_diff_ignores_order(frame):
    a, b = frame("x long, y string").schema, frame("y string, x long").schema
    assert schema_diff(a, b).same
    diff = schema_diff(a, frame("x int, z string").schema)
    assert (diff.only_left, diff.only_right, diff.retyped) == (("y",), ("z",), ("x",))


# --- shares, lists, chunks ---------------------------------------------------


def test_share_counts_memberships(games, genres, rows):
    got = rows(share_by(games, "members", genres, explode=True))
    assert got == [("Indie", 4, 44.44), ("Puzzle", 1, 11.11), ("Undefined", 1, 11.11), ("Undefined", 3, 33.33)]


def test_share_unknown_only_for_null_keys(frame, rows):
    facts = frame("id long, c long", (1, 1), (2, 9), (3, None))
    dim = frame("id long, name string", (1, "one"))
    assert rows(share_by(facts, "c", dim, unknown_only_for_null_key=True)) == [
        (None, 1, 33.33),
        ("Undefined", 1, 33.33),
        ("one", 1, 33.33),
    ]


def test_top_k_puts_nulls_last(frame):
    df = frame("id long, r double", (1, None), (2, 5.0), (3, 9.0), (4, 5.0))
    assert [r["id"] for r in top_k(df, "r", 3, ["id"]).collect()] == [3, 2, 4]


def test_profile(frame):
    got = {r["column"]: r for r in profile(frame("a long, t string, b double", (1, "x", 2.0), (3, "y", None))).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["n"], got["a"]["mean"], got["a"]["max"], got["b"]["n"]) == (2, 2.0, 3.0, 1)


@pytest.mark.parametrize("n", [0, 1, 150, 151, 1000])
def test_chunks(spark, n):
    df = assign_chunks(spark.range(n).orderBy(F.rand(1)), ["id"], 150)
    got = {r["id"]: (r["row_num"], r["chunk_num"]) for r in df.collect()}
    assert got == {i: (i + 1, i // 150) for i in range(n)}
    assert chunk(df, 0).count() == min(n, 150)


# --- expressions -------------------------------------------------------------


def test_blends(frame, rows):
    df = frame("a double, b double", (4.0, 2.0), (4.0, None), (None, 2.0), (None, None))
    a, b = F.col("a"), F.col("b")
    got = rows(df.select("a", "b", mean_of_present(a, b).alias("u"), mean_with_total(a, b).alias("t")))
    assert got == [
        (None, None, None, None),
        (None, 2.0, 2.0, None),
        (4.0, None, 4.0, 4.0),
        (4.0, 2.0, 3.0, 3.0),
    ]


def test_local_date_is_three_hours_behind(spark, frame):
    df = frame("e long", (1704070800,), (1704078000,))  # 01:00 and 03:00 UTC
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = [r[0] for r in df.select(local_date(F.col("e"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2023-12-31", "2024-01-01"]


def test_hms(frame):
    got = [r[0] for r in frame("s long", (0,), (3661,), (360000,)).select(hms(F.col("s"))).collect()]
    assert got == ["00:00:00", "01:01:01", "100:00:00"]


# --- matching ----------------------------------------------------------------


def test_pick_best_rules(frame, rows):
    hits = frame(
        "id long, year int, cand_id long, cand_year int, similarity double",
        (1, 2000, 11, 2000, 0.8),  # at the threshold: rejected
        (2, 2000, 21, 1990, 0.95),  # single best: the year does not matter
        (2, 2000, 22, 2000, 0.9),
        (3, 2000, 31, 1999, 0.9),  # tie: the year decides
        (3, 2000, 32, 2000, 0.9),
        (4, 2000, 41, 1998, 0.9),  # tie without the year: none
        (4, 2000, 42, 1999, 0.9),
        (5, None, 51, None, 0.9),  # tie and no year: none
        (5, None, 52, None, 0.9),
        (6, 2000, 62, 2000, 0.9),  # tie with the year twice: smallest id
        (6, 2000, 61, 2000, 0.9),
    )
    assert rows(pick_best(hits), "id", "cand_id") == [(2, 21), (3, 32), (6, 61)]


def test_pick_best_of_copies_nulls_and_nan(frame, rows):
    nan = float("nan")
    hits = frame(
        "id long, year int, cand_id long, cand_year int, similarity double",
        *[(1, 2000, 11, 2000, 0.9)] * 2,  # two copies are two hits: the year decides
        *[(2, 2000, 21, 1999, 0.9)] * 2,
        (3, 2000, None, 2000, 0.95),  # the single best one has no id: none
        (3, 2000, 31, 2000, 0.9),
        (4, 2000, None, 2000, 0.9),  # of several, the smallest id there is
        (4, 2000, 41, 2000, 0.9),
        (5, 2000, 51, 1999, nan),  # greater than any number
        (5, 2000, 52, 2000, 1.0),
        *[(6, 2000, c, 2000, nan) for c in (62, 61)],
        (None, 2000, 71, 1999, 0.9),
        (8, 2000, 81, 2000, None),
    )
    for df in (hits, hits.repartition(5), hits.coalesce(1)):
        assert rows(pick_best(df), "id", "cand_id") == [(None, 71), (1, 11), (4, 41), (5, 51), (6, 61)]


def test_pick_best_holds_one_id_at_a_time(spark):
    ids = spark.range(1000).select("id", F.lit(2000).alias("year"))
    found = spark.range(1000).select("id", F.col("id").alias("cand_id"), F.lit(2000).alias("cand_year"), F.lit(0.9).alias("similarity"))
    text = plan(pick_best(ids.join(found.hint("merge"), "id")))
    # After the sorts of the join nothing is sorted, hashed or shuffled again.
    assert "HashAggregate" not in text and "SortAggregate" in text
    assert text.count("Sort [") == 2 and text.count("Exchange hashpartitioning") == 2


NAMES = """Halo|Halo 2|Halo 3|Portal|Portal 2|The Witcher|The Witcher 2|The Witcher 3|Witcher
Dark Souls|Dark Souls II|Dark Souls III|Demon's Souls|Final Fantasy VII|Final Fantasy VIII
Final Fantasy XIII|Final Fantasy XIII-2|Celeste|Céleste|Celestee|a|b|ab|abc|abcd|abcde|abcdef
aaaaaaaaaa|aaaaaaaaaaa|aaaaaaaaab|mississippi|missisippi|misisipi|Limbo|Limba|Inside|Insider
The Legend of Zelda: A Link to the Past|The Legend of Zelda: Link to the Past
Legend of Zelda: A Link to the Past|The Legend of Zelda: A Link Between Worlds""".replace("\n", "|").split("|")


def _edit_distance(a: str, b: str) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line, above = [i], line
        for j, y in enumerate(b, 1):
            line.append(min(above[j] + 1, line[-1] + 1, above[j - 1] + (x != y)))
    return line[-1]


@pytest.mark.parametrize("threshold", [0.8, 0.9])
def test_similar_names_finds_every_pair(frame, threshold):
    left = frame("name string", *((n,) for n in NAMES + ["Halo", "misissippi", "Zelda", None]))
    right = frame("name string", *((n + s,) for n in NAMES for s in ("", "x", " 2")), (None,))
    got = {(r["lname"], r["rname"]) for r in similar_names(left, right, threshold).collect()}
    rights = {n + s for n in NAMES for s in ("", "x", " 2")}
    lefts = {n for n in NAMES + ["Halo", "misissippi", "Zelda"]}
    pairs = {
        (a, b)
        for a in lefts
        for b in rights
        if (max(len(a), len(b)) - _edit_distance(a, b)) * 10 > threshold * 10 * max(len(a), len(b)) + 1e-9
    }
    # A name found as it is needs no search: nothing is nearer.
    assert got == {(a, b) for a, b in pairs if a not in rights or a == b}


def test_best_match_equals_picking_from_all_pairs(frame, rows):
    left = frame(
        "id long, name string, year int",
        *((i, n + ("x" if i % 3 else ""), 2000 + i % 4) for i, n in enumerate(NAMES * 2)),
    )
    right = frame(
        "cand_id long, name string, year int",
        *((i, n + s, 2000 + i % 3) for i, (n, s) in enumerate((n, s) for n in NAMES for s in ("", "y", "z"))),
    )
    pairs = left.crossJoin(right.toDF("cand_id", "cand", "cand_year")).select(
        "id",
        "year",
        "cand_id",
        "cand_year",
        (1 - F.levenshtein("name", "cand") / F.greatest(F.length("name"), F.length("cand"))).alias("similarity"),
    )
    assert rows(best_match(left, right), "id", "cand_id") == rows(pick_best(pairs), "id", "cand_id")


@pytest.mark.parametrize("threshold", [0.05, 0.35, 0.5, 0.6, 0.75, 0.8])
def test_similar_names_is_exact_for_every_threshold(frame, threshold):
    dice = random.Random(threshold)

    def words(n):
        return ["".join(dice.choices("abcé", k=dice.randint(0, 9))) for _ in range(n)]

    lefts, rights = words(90) + ["long name of a game"], words(90) + ["", "long name", "ong name of game", "l"]
    got = {(r["lname"], r["rname"]) for r in similar_names(frame("name string", *((n,) for n in lefts)), frame("name string", *((n,) for n in rights)), threshold).collect()}
    far = {(a, b) for a in lefts for b in rights if a not in rights and (max(len(a), len(b)) - _edit_distance(a, b)) > threshold * max(len(a), len(b)) + 1e-9}
    assert got == far | {(a, a) for a in lefts if a in rights}


@pytest.mark.parametrize("threshold", [0.4, 0.8])
def test_tiers_and_one_search_agree(frame, rows, monkeypatch, threshold):
    dice = random.Random(9)
    lefts = ["".join(dice.choices("abc", k=dice.randint(1, 8))) for _ in range(120)]
    rights = ["".join(dice.choices("abc", k=dice.randint(1, 8))) for _ in range(120)]
    sides = [frame("name string", *((n,) for n in names)) for names in (lefts, rights)]
    monkeypatch.setattr(match, "FEW_NAMES", 0)
    in_tiers = rows(nearest_names(*sides, threshold))
    monkeypatch.setattr(match, "FEW_NAMES", 10**9)
    assert in_tiers == rows(nearest_names(*sides, threshold)) and in_tiers


@pytest.mark.parametrize("threshold", [0.35, 0.6, 0.8, 0.85, 0.9])
def test_numbered_names_are_exact(frame, threshold):
    dice = random.Random(threshold)
    name = lambda: dice.choice(["Game #", "Gamé ", "Hall of "]) + "".join(dice.choices("0123", k=dice.randint(1, 9))) + dice.choice(["", "b", " II"])
    lefts, rights = [name() for _ in range(150)], [name() for _ in range(150)]
    sides = [frame("name string", *((n,) for n in names)) for names in (lefts, rights)]
    got = [(r["lname"], r["rname"], round(r["similarity"], 9)) for r in similar_names(*sides, threshold).collect()]
    longer = {(a, b): max(len(a), len(b)) for a in lefts for b in rights if a not in rights}
    alike = {(a, b, round(1 - _edit_distance(a, b) / n, 9)) for (a, b), n in longer.items() if (n - _edit_distance(a, b)) > threshold * n + 1e-9}
    assert sorted(got) == sorted(alike | {(a, a, 1.0) for a in lefts if a in rights})


def _written(monkeypatch) -> list[int]:
    """Rows of every intermediate table that matching writes from now on."""
    counts, write = [], match.materialize

    def counted(df, label):
        held = write(df, label)
        counts.append(held.count())
        return held

    monkeypatch.setattr(match, "materialize", counted)
    return counts


def test_numbered_names_without_partner_make_few_candidates(frame, monkeypatch):
    """Pieces of each name at a low threshold were thousands of rows a name."""
    written = _written(monkeypatch)
    left = frame("name string", *((f"BUILDING{i:06}",) for i in range(400)))
    right = frame("name string", *((f"Customer#{i:09}BUILDING",) for i in range(400)))
    assert nearest_names(left, right, 0.35).isEmpty()
    assert max(written) <= 1000


def test_pairs_of_patterns_meet_without_pieces_of_each_name(frame, monkeypatch):
    written = _written(monkeypatch)
    left = frame("name string", *((f"Cust#{i:06}PERU",) for i in range(300)))
    right = frame("name string", *((f"Customer#{i:09}PERU",) for i in range(300)))
    pairs = similar_names(left, right, 0.6)
    assert pairs.where("substring(lname, 6, 6) = substring(rname, 13, 6)").count() == 300
    assert max(written) <= 1000


def _alike(lefts, rights, threshold):
    pairs = {(a, b, max(len(a), len(b)), _edit_distance(a, b)) for a in set(lefts) - set(rights) for b in set(rights)}
    return sorted((a, b, round(1 - d / n, 9)) for a, b, n, d in pairs if n - d > threshold * n + 1e-9)


def _found(frame, lefts, rights, threshold):
    pairs = similar_names(*(frame("name string", *((n,) for n in names)) for names in (lefts, rights)), threshold)
    return sorted((r["lname"], r["rname"], round(r["similarity"], 9)) for r in pairs.collect())


def test_many_names_of_few_patterns_are_not_measured_pair_by_pair(frame, monkeypatch):
    """Each pair took an edit distance of its own, which did not finish for 15 000 names."""
    monkeypatch.setattr(match, "_measured", None)
    lefts = [f"Cust#{i:06}NATION_{i % 10}" for i in range(0, 2000, 49)]
    rights = [f"Customer#{i:09}NATION_{i % 25}" for i in range(300)]
    got = _found(frame, lefts, rights, 0.6)
    assert got == _alike(lefts, rights, 0.6) and 0 < len(got) < len(lefts) * len(rights)


def test_blocks_of_names_and_few_names_together_are_exact(frame, monkeypatch):
    for name, size in (("LEFTS_PER_BLOCK", 7), ("RIGHTS_PER_BLOCK", 40), ("TESTS_PER_TASK", 500), ("MANY_LEFTS", 10), ("MANY_RIGHTS", 50)):
        monkeypatch.setattr(match, name, size)
    dice = random.Random(4)
    words = lambda n: ["".join(dice.choices("abé中 ", k=dice.randint(1, 12))) for _ in range(n)]
    lefts = [f"Hall é{i:03}" for i in range(0, 400, 13)] + words(20)
    rights = [f"Hall é{i:04}" for i in range(0, 800, 7)] + words(60) + ["Hall é013", "H"]
    got = _found(frame, lefts, rights, 0.5)
    assert [x for x in got if x[2] < 1] == _alike(lefts, rights, 0.5)
    assert {x[:2] for x in got if x[2] == 1} == {(a, a) for a in lefts if a in rights}


@pytest.mark.parametrize("longest", [8, 9, 17, 33, 64, 65, 130, 280])
def test_a_block_of_names_has_the_edit_distances(longest):
    dice = random.Random(longest)
    lefts, rights = ({"x" * dice.randint(0, longest // 2) + "".join(dice.choices("abé中", k=dice.randint(1, longest // 2))) for _ in range(14)} for _ in "lr")
    lefts |= {"y" * 300, "xa"}
    rights |= {"y" * 20, "xa"}

    def rows(names, side):
        names = sorted(names, key=str.encode)
        columns = [[7] * len(names), *([0] * len(names) for _ in "lr"), [side] * len(names), names, pa.array([len(n) // 2 for n in names], pa.int32())]
        batch = pa.record_batch(columns, names=["pair", "l", "r", "side", "name", "edits"])
        return [batch.slice(0, 4), batch.slice(4)]

    got = [tuple(r.values()) for b in near_in_blocks(iter(rows(rights, 0) + rows(lefts, 1))) for r in b.to_pylist()]
    apart = [(a, b, _edit_distance(a, b)) for a in lefts for b in rights]
    assert sorted(got) == sorted(x for x in apart if 0 < x[2] <= max(len(x[0]) // 2, len(x[1]) // 2))


def test_names_one_edit_apart_need_no_bigrams(frame, rows, monkeypatch):
    """Numbered names share all their bigrams, so these brought nearly all pairs together."""
    monkeypatch.setattr(match, "_gram_pairs", None)
    monkeypatch.setattr(match, "_bigrams", None)
    names = [f"Customer#{i:09}" for i in range(500)]
    sides = [frame("name string", *((n + end,) for n in names)) for end in ("", "x")]
    assert rows(nearest_names(*sides), "lname", "rname") == [(n, n + "x") for n in names]


def test_null_keys_of_a_lookup_do_not_gather_in_one_task(spark, frame):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in off}
    for key, value in off.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(400).select("id", F.when(F.col("id") % 4 == 0, F.col("id") % 8).alias("part"))
        found = lookup(facts, "part", frame("id long, name string", (0, "a"), (None, "b")), {"name": "name"}, keep_key=True)
        got = found.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert {r["name"] for r in got if r["part"] == 0} == {"a"} and {r["name"] for r in got if r["part"] != 0} == {None}
    nulls = [r["task"] for r in got if r["part"] is None]
    assert len(got) == 400 and len(nulls) == 300 and len(set(nulls)) > 1


def test_similar_names_refuses_impossible_thresholds(frame):
    for threshold in (0, 1, 1.5):
        with pytest.raises(ValueError):
            similar_names(frame("name string"), frame("name string"), threshold)


def test_parse_records_keeps_bad_rows_apart(frame, rows):
    from lakestrata.functions.schemas import COUNT, TEXT, schema

    df = frame("id long, j string", (1, '{"a": 1, "b": "x"}'), (2, "{nope"), (3, '{"a": 2}'), (4, None))
    good, bad = parse_records(df, "j", schema(a=COUNT, b=TEXT))
    assert rows(good, "id", "a", "b") == [(1, 1, "x"), (3, 2, None)]
    assert rows(bad, "id") == [(2,), (4,)]


def test_rows_without_a_match_spread_over_tasks(spark, frame):
    """No adaptive splitting: the salts alone deal them out."""
    facts = spark.range(2000).select("id", F.lit(None).cast("long").alias("k"))
    facts = facts.unionByName(frame("id long, k long", (5000, 1), (5001, 2)))
    others = frame("ok long, v string", (1, "a"), (1, "b"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(held, ("false", "-1", "8")):
            spark.conf.set(key, value)
        out = fan_out(facts, "k", others, {"v": "v"}, other_key="ok")
        parts = out.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 6 and sum(r["count"] for r in parts) == 2000
        assert sorted((r["id"], r["v"] or "") for r in out.where("id >= 5000").collect()) == [(5000, "a"), (5000, "b"), (5001, "")]
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
