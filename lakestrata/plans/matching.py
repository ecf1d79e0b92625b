"""Completion times: which games to look up, and the best candidate for each.

The candidates come as a table, not from a site: own id, name, release year
and whatever else is known about them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators.match import THRESHOLD, best_match, refresh_worklist
from lakestrata.plans.control import MATCHED_LANDING_RUN, Run, control_or_empty
from lakestrata.plans.ingest import land
from lakestrata.plans.lake import CATALOGUE, LANDING, RAW, TIMES, Lake, TableId
from lakestrata.sources.snapshot import snapshot_history

# Records per landed file; columns of a candidate.
RECORDS_PER_FILE = 5_000
CANDIDATE_ID, CANDIDATE_NAME, CANDIDATE_YEAR = "game_id", "game_name", "release_world"

GAMES = TableId(RAW, "games", CATALOGUE)
HELD = TableId(RAW, "games", TIMES)
LANDED = TableId(LANDING, "games", TIMES)


@dataclass(frozen=True)
class Worklist:
    """Games to look up: `search` is 'id' (with the candidate's id) or 'name'."""

    load_type: str
    games_version: int
    rows: DataFrame


def _searchable(games: DataFrame) -> DataFrame:
    released = F.year(F.timestamp_seconds("first_release_date"))
    return games.select("id", "name", released.alias("release_year"))


def plan_worklist(lake: Lake) -> Worklist:
    """All games at first; later the held ones by id and new or changed ones by name.

    What changed is the difference between the current version of the games
    and the one the last run saw.
    """
    version = snapshot_history(lake.spark, lake.path(GAMES)).first()["version"]
    current = _searchable(lake.read(GAMES, version=version))
    log = control_or_empty(lake.spark, lake.control_path(LANDED), MATCHED_LANDING_RUN)
    last = log.orderBy(F.desc("Exec_time")).first()
    held = lake.read(HELD, required=False)
    if last is None or held is None:
        return Worklist("Initial", version, current.withColumn("search", F.lit("name")))
    previous = _searchable(lake.read(GAMES, version=last["IGDB_Game_Version"]))
    known = held.select("id", CANDIDATE_ID)
    return Worklist("Incremental", version, refresh_worklist(current, previous, known, "id"))


def find_matches(
    worklist: DataFrame, candidates: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Candidate records of the work-list, with the game's `id`."""
    by_name = best_match(
        worklist.where("search = 'name'").select(
            "id", "name", F.col("release_year").alias("year")
        ),
        candidates.select(
            F.col(CANDIDATE_ID).alias("cand_id"),
            F.col(CANDIDATE_NAME).alias("name"),
            F.col(CANDIDATE_YEAR).alias("year"),
        ),
        threshold,
    ).select("id", F.col("cand_id").alias(CANDIDATE_ID))
    found = by_name
    if CANDIDATE_ID in worklist.columns:
        found = found.unionByName(worklist.where("search = 'id'").select("id", CANDIDATE_ID))
    return found.join(candidates, CANDIDATE_ID)


def land_matches(
    lake: Lake,
    candidates: DataFrame,
    *,
    threshold: float = THRESHOLD,
    records_per_file: int = RECORDS_PER_FILE,
) -> int:
    """Look up the work-list and land the records found; returns the number of files."""
    run = Run()
    todo = plan_worklist(lake)
    records = find_matches(todo.rows, candidates, threshold).withColumn(
        "extracted_datetime", F.lit(int(run.started))
    )
    return land(
        lake,
        LANDED,
        records,
        todo.load_type,
        run,
        records_per_file=records_per_file,
        log=MATCHED_LANDING_RUN,
        IGDB_Game_Version=todo.games_version,
    )
