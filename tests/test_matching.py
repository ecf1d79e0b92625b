"""Completion times from the first look-up to the raw table."""

from __future__ import annotations

import time

import pytest

from lakestrata.plans.control import read_control
from lakestrata.plans.ingest import apply_batches
from lakestrata.plans.lake import TIMES, Lake
from lakestrata.plans.matching import GAMES, HELD, LANDED, find_matches, land_matches, plan_worklist
from lakestrata.sources.snapshot import write_snapshot

GAME = "id long, name string, first_release_date long"
CANDIDATE = "game_id long, game_name string, release_world int, comp_main long"
Y2000, Y2001 = 946684800, 978307200


@pytest.fixture
def candidates(frame):
    return frame(
        CANDIDATE,
        (501, "Halo", 2001, 10),
        (502, "Halo", 2000, 20),
        (503, "Portal", 2007, 30),
        (504, "Unrelated", 2000, 40),
    )


def test_first_and_later_runs(spark, frame, rows, candidates, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write_snapshot(frame(GAME, (1, "Halo", Y2000), (2, "Zzz", Y2000)), lake.path(GAMES))
    first = plan_worklist(lake)
    assert (first.load_type, first.games_version) == ("Initial", 0)
    assert rows(first.rows) == [(1, "Halo", 2000, "name"), (2, "Zzz", 2000, "name")]

    assert land_matches(lake, candidates) > 0
    assert apply_batches(lake, TIMES, "games", order="extracted_datetime") == 1
    assert rows(lake.read(HELD), "id", "game_id", "comp_main") == [(1, 502, 20)]

    # A new game appears, a changed one becomes findable, a held one is refreshed by id.
    write_snapshot(
        frame(GAME, (1, "Halo (old)", Y2001), (2, "Portals", Y2001), (3, "Zzz", None)), lake.path(GAMES)
    )
    later = plan_worklist(lake)
    assert (later.load_type, later.games_version) == ("Incremental", 1)
    assert rows(later.rows, "id", "search", "game_id", "name") == [
        (1, "id", 502, None),
        (2, "name", None, "Portals"),
        (3, "name", None, "Zzz"),
    ]
    assert rows(find_matches(later.rows, candidates), "id", "game_id") == [(1, 502), (2, 503)]
    time.sleep(1)
    assert land_matches(lake, candidates) > 0
    assert apply_batches(lake, TIMES, "games", order="extracted_datetime", same_day=True) == 2
    versions = read_control(spark, lake.control_path(LANDED))
    assert rows(versions, "Load_type", "IGDB_Game_Version") == [("Incremental", 1), ("Initial", 0)]
