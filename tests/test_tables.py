"""Context tables and marts, built end to end on a small hand-written lake."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from lakestrata.plans import analyses
from lakestrata.plans.context import CONTEXT_TABLES
from lakestrata.plans.control import RAW_RUN, Run, append_run
from lakestrata.plans.ingest import import_enums
from lakestrata.plans.lake import CATALOGUE, COMMON_ENUMS, CONTEXT, RAW, TIMES, TRUST, Lake, TableId
from lakestrata.plans.marts import MARTS, games
from lakestrata.plans.runner import build_all
from lakestrata.sources.snapshot import write_snapshot

GAME_ARRAYS = (
    "platforms", "genres", "game_modes", "themes", "keywords", "franchises", "age_ratings",
    "language_supports", "player_perspectives", "game_engines", "bundles", "dlcs", "expanded_games",
    "expansions", "forks", "ports", "remakes", "remasters", "similar_games", "standalone_expansions",
)

ENUMS = {
    "igdb_enum_games_category": "name;value\nmain_game;0\ndlc_addon;1\n",
    "igdb_enum_games_status": "name;value\nreleased;0\n",
    "igdb_enum_platforms_category": "name;value\nconsole;1\noperating_system;4\ncomputer;6\n",
    "igdb_enum_age_ratings_category": "name;value\nESRB;1\n",
    "igdb_enum_age_ratings_rating": "name;value\nT;10\n",
    "igdb_enum_websites_category": "name;value\nofficial;1\n",
    "igdb_enum_external_games_category": "name;value\nsteam;1\n",
    "igdb_enum_release_date_category": "name;value\nYYYY;2\n",
    "igdb_enum_release_date_region": "name;value\neurope;1\nworldwide;8\n",
    "igdb_enum_age_rating_content_description_category": "name;value\nblood;3\n",
}
COUNTRIES = {
    "aux_enum_iso_country_code_countryname": "name;value\nAfghanistan;004\nBrazil;076\n",
    "aux_enum_iso_country_code_countryalpha3": "name;value\nAFG;004\nBRA;076\n",
}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    for api, files in (("igdb_enums", ENUMS), (COMMON_ENUMS, COUNTRIES)):
        folder = tmp_path_factory.mktemp(api)
        for name, text in files.items():
            (folder / f"{name}.csv").write_text(text)
        import_enums(lake, str(folder), api)

    def raw(name, ddl, *rows, api=CATALOGUE):
        table = TableId(RAW, name, api)
        written = write_snapshot(spark.createDataFrame(list(rows), ddl), lake.path(table))
        run = Run(started=time.time() - 3600)
        append_run(
            spark,
            lake.control_path(table),
            RAW_RUN,
            run.record(Loaded_date="2024-01-01", Read_Rows=written.rows, Table_Rows=written.rows),
        )

    named = "id long, name string, checksum string, slug string, url string, created_at long, updated_at long"

    def names(*pairs):
        return [(i, n, "c", "s", "u", 0, 0) for i, n in pairs]

    for table in ("game_modes", "themes", "collections", "game_engines", "player_perspectives"):
        raw(table, named, *names((1, f"{table}-1")))
    raw("genres", named, *names((32, "Indie"), (5, "Shooter")))
    raw("keywords", named, *names((1, "k")))
    raw("franchises", named, *names((1, "f")))
    raw("multiplayer_modes", "id long, checksum string, lancoop boolean", (1, "c", True))
    raw(
        "companies",
        "id long, name string, country long, parent long, checksum string, slug string, url string, created_at long, updated_at long",
        (1, "Big", 4, None, "c", "s", "u", 0, 0),
        (2, "Small", 76, 1, "c", "s", "u", 0, 0),
        (3, "Lost", 999, None, "c", "s", "u", 0, 0),
    )
    raw(
        "involved_companies",
        "id long, game long, company long, developer boolean, porting boolean, publisher boolean, supporting boolean, checksum string, created_at long, updated_at long",
        (1, 100, 2, True, False, False, False, "c", 0, 0),
        (2, 100, 1, False, False, True, False, "c", 0, 0),
        (3, 101, 77, True, False, False, False, "c", 0, 0),
        (4, 102, 3, True, False, False, False, "c", 0, 0),
    )
    raw(
        "covers",
        "id long, url string, height int, width int, image_id string, checksum string, animated boolean, alpha_channel boolean",
        (9, "//x/t_thumb/a.jpg", 1, 1, "i", "c", False, False),
    )
    arrays = ", ".join(f"{a} array<long>" for a in GAME_ARRAYS)
    scalars = (
        "id long, name string, category long, status long, first_release_date long, created_at long, "
        "updated_at long, cover long, rating double, aggregated_rating double, total_rating double, "
        "rating_count long, aggregated_rating_count long, total_rating_count long, follows long, hypes long, "
        "collection long, franchise long, parent_game long, version_parent long, version_title string, "
        "checksum string, slug string, videos array<long>, alternative_names array<long>, artworks array<long>, "
        "screenshots array<long>, tags array<long>"
    )

    def game(id_, name, category, status, released, rating, total, updated=0, cover=None, **members):
        return (
            id_, name, category, status, released, 0, updated, cover, rating, None, total, 1, 1, 1, 2, 3,
            None, None, None, None, None, "c", "s", [1], [1], [1], [1], [1],
            *(members.get(a) for a in GAME_ARRAYS),
        )

    raw(
        "games",
        f"{scalars}, {arrays}",
        game(100, "Alpha", 0, 0, 1704067200, 80.0, 70.0, 50, 9, genres=[32, 5], platforms=[6, 7],
             language_supports=[1], age_ratings=[1, 2]),
        game(101, "Beta", 1, 5, None, None, None, 70, genres=[32], platforms=None, franchises=[1]),
        game(102, "Gamma", None, None, 0, 60.0, 50.0, 60, genres=[], platforms=[8, 99]),
        game(103, "Delta", 0, 0, 0, None, 40.0, 10, genres=None, platforms=[]),
    )
    raw("platform_families", "id long, name string", (1, "PlayStation"))
    raw(
        "platforms",
        "id long, name string, category long, generation long, platform_family long, checksum string, slug string, "
        "url string, summary string, versions array<long>, websites array<long>, created_at long, updated_at long",
        (6, "PC", 6, None, None, "c", "s", "u", "x", [1], [1], 0, 0),
        (7, "PS1", 1, 5, 1, "c", "s", "u", "x", [1], [1], 0, 0),
        (8, "Android", 4, None, None, "c", "s", "u", "x", [1], [1], 0, 0),
        (9, "Odd", 42, None, None, "c", "s", "u", "x", [1], [1], 0, 0),
    )
    raw("languages", "id long, name string, locale string", (1, "Portuguese", "pt-BR"))
    raw("language_support_types", "id long, name string", (1, "Audio"))
    raw(
        "language_supports",
        "id long, game long, language long, language_support_type long, checksum string, created_at long, updated_at long",
        (1, 100, 1, 1, "c", 0, 0),
    )
    raw("age_ratings", "id long, category long, rating long, checksum string", (1, 1, 10, "c"), (2, 1, 99, "c"))
    raw("age_rating_content_descriptions", "id long, category long, checksum string", (1, 3, "c"))
    raw("regions", "id long, name string", (1, "Europe"))
    raw(
        "game_localizations",
        "id long, game long, region long, checksum string, created_at long, updated_at long",
        (1, 100, 1, "c", 0, 0),
        (2, 100, 5, "c", 0, 0),
    )
    raw("release_date_statuses", "id long, name string", (6, "Full Release"))
    raw(
        "release_dates",
        "id long, game long, platform long, region long, category long, status long, date long, y long, checksum string, created_at long, updated_at long",
        (1, 100, 7, 1, 2, 6, 1704067200, 2025, "c", 0, 0),
        (2, 100, 7, 8, 2, None, 1735689600, 2024, "c", 0, 0),
        (3, 100, 55, 8, 2, None, 1, 1970, "c", 0, 0),
    )
    raw("websites", "id long, category long, url string, checksum string", (1, 1, "w", "c"), (2, 9, "w", "c"))
    raw(
        "external_games",
        "id long, category long, checksum string, created_at long, updated_at long",
        (1, 1, "c", 0, 0),
        (2, None, "c", 0, 0),
        (3, 50, "c", 0, 0),
    )
    raw(
        "games",
        "id long, game_id long, game_name string, game_alias string, game_type string, comp_main long, comp_main_count long, "
        "comp_plus long, comp_plus_count long, comp_100 long, comp_100_count long, comp_all long, comp_all_count long, "
        "count_comp long, review_score long, profile_dev string, profile_platform string, profile_steam long, "
        "release_world long, extracted_datetime long, game_image string, comp_lvl_sp long",
        (100, 5001, "Alpha", "", "game", 36000, 2, 40000, 1, 50000, 1, 42000, 4, 9, 90, "Dev", "PC", 1, 2024, 0, "i", 1),
        (5001, 100, "Other", "", "game", 1, 1, 1, 1, 1, 1, 1, 1, 1, 10, "Dev", "PC", 1, 2024, 0, "i", 1),
        api=TIMES,
    )
    results = build_all(lake, list(CONTEXT_TABLES.values()))
    assert all(r.built for r in results)
    assert all(r.built for r in build_all(lake, list(MARTS.values())))
    return lake


@pytest.fixture
def table(lake):
    def read(layer, name, api=None):
        return lake.read(TableId(layer, name, api))

    return read


def context(table, name, api=CATALOGUE):
    return table(CONTEXT, name, api)


def test_all_tables_are_there():
    assert len(CONTEXT_TABLES) == 22
    assert list(MARTS)[-2:] == ["games", "indie_games"]
    assert len(MARTS) == 12


def test_nothing_is_due_after_a_build(lake):
    specs = [*CONTEXT_TABLES.values(), *MARTS.values()]
    assert not any(r.built for r in build_all(lake, specs))


def test_jobs_take_the_same_tables(lake, spark):
    from lakestrata.jobs import main

    done = main(["context", "--root", lake.root, "--api", CATALOGUE, "--tables", "genres", "games"], spark)
    assert [(r.table, r.built) for r in done] == [("context/igdb/genres", False), ("context/igdb/games", False)]
    done = main(["trust", "--root", lake.root, "--tables", "indie_games", "games"], spark)
    assert [r.table for r in done] == ["trust/games", "trust/indie_games"]
    assert main(["raw", "--root", lake.root, "--tables", "genres"], spark) == [None]
    with pytest.raises(SystemExit):
        main(["trust", "--root", lake.root, "--tables", "nope"], spark)


def test_standard_rule(table):
    df = context(table, "genres")
    assert df.columns == ["created_at", "id", "name", "updated_at"]
    assert df.schema["created_at"].dataType.typeName() == "timestamp"


def test_companies(table, rows):
    got = rows(context(table, "companies"), "id", "country_code", "country_name", "country_alpha3")
    assert got == [(1, 4, "Afghanistan", "AFG"), (2, 76, "Brazil", "BRA"), (3, 999, None, None)]


def test_covers_and_games(table, rows):
    assert rows(context(table, "covers")) == [(9, "//x/t_cover_big/a.jpg")]
    assert rows(context(table, "games"), "id", "category", "status") == [
        (100, "main_game", "released"),
        (101, "dlc_addon", None),
        (102, None, None),
        (103, "main_game", "released"),
    ]
    assert "tags" not in context(table, "games").columns


def test_platforms(table, rows):
    got = rows(context(table, "platforms"), "id", "category", "platform_family")
    assert got == [
        (6, "computer", None),
        (7, "console", "PlayStation"),
        (8, "operating_system", None),
        (9, None, None),
    ]


def test_lookups(table, rows):
    assert rows(context(table, "language_supports"), "language", "language_support_type", "locale") == [
        ("Portuguese", "Audio", "pt-BR")
    ]
    assert rows(context(table, "game_localizations"), "id", "region") == [(1, "Europe"), (2, None)]
    assert rows(context(table, "age_rating_content_descriptions"), "category") == [("blood",)]
    assert rows(
        context(table, "release_dates"), "id", "region", "category", "status", "platform_id", "platform_name"
    ) == [
        (1, "europe", "YYYY", "Full Release", 7, "PS1"),
        (2, "worldwide", "YYYY", None, 7, "PS1"),
        (3, "worldwide", "YYYY", None, None, None),
    ]


def test_times_are_renamed(table):
    columns = context(table, "games", TIMES).columns
    assert {"comp_time_100", "developer", "steam_id", "release_year", "name"} <= set(columns)
    assert not {"comp_100", "game_image", "comp_lvl_sp"} & set(columns)


def test_platform_mart(table, rows):
    mart = table(TRUST, "games_by_platform")
    assert mart.columns == sorted(mart.columns)
    got = rows(
        mart, "game_id", "platform_id", "platform_name", "platform_family", "platform_generation", "release_year"
    )
    none = "(Não Definida)"
    assert got == [
        (100, 6, "PC", "Computer", none, None),
        (100, 7, "PS1", "PlayStation", "5", 2024),
        (101, None, none, none, none, None),
        (102, 8, "Android", "Mobile", none, None),
        (102, 99, none, none, none, None),
    ]
    first = mart.where("game_id = 100 and platform_id = 7").first()
    assert (first["release_date"].year, first["platform_category"]) == (2024, "console")


def test_member_marts(table, rows):
    assert rows(table(TRUST, "games_by_genre"), "game_id", "genre_id", "genre_name") == [
        (100, 32, "Indie"),
        (100, 5, "Shooter"),
        (101, 32, "Indie"),
        (103, None, "(Não Definido)"),
    ]
    assert rows(table(TRUST, "games_age_ratings"), "game_id", "age_rating_id", "age_rating_category", "age_rating")[:2] == [
        (100, 1, "ESRB", "T"),
        (100, 2, "ESRB", "(Não Definida)"),
    ]
    assert (101, "f", None) in rows(table(TRUST, "games_by_franchise"), "game_id", "franchise_name", "release_year")
    assert (100, "(Sem franquia)", 2024) in rows(
        table(TRUST, "games_by_franchise"), "game_id", "franchise_name", "release_year"
    )
    assert (100, "Portuguese", "Audio", "pt-BR") in rows(
        table(TRUST, "language_supports_by_game"), "game_id", "language", "language_support_type", "locale"
    )
    assert {r[0] for r in rows(table(TRUST, "games_by_keyword"), "keyword_name")} == {"(Sem palavra-chave)"}


def test_company_mart(table, rows):
    got = rows(
        table(TRUST, "involved_companies_by_game"),
        "id", "company_name", "company_country", "parent_company_id", "parent_company_name", "game_name",
    )
    assert got == [
        (1, "Small", "Brazil", 1, "Big", "Alpha"),
        (2, "Big", "Afghanistan", 1, "Big", "Alpha"),
        (3, None, None, None, None, "Beta"),
        (4, "Lost", "(Não Definido)", 3, "Lost", "Gamma"),
    ]


def test_games_mart(table, rows):
    mart = table(TRUST, "games")
    got = rows(mart, "id", "cover_url", "rating_hltb_users", "average_rating_users", "average_rating_total")
    assert got == [
        (100, "//x/t_cover_big/a.jpg", 90, 85.0, 80.0),
        (101, None, None, None, None),
        (102, None, None, 60.0, 50.0),
        (103, None, None, None, 40.0),
    ]
    assert len(mart.columns) == 44
    assert "game_id" not in mart.columns


def test_games_mart_can_join_on_another_key(table, rows):
    built = games(
        context(table, "games"), context(table, "games", TIMES), context(table, "covers"), times_key="game_id"
    )
    assert rows(built.where("id = 100"), "rating_hltb_users") == [(10,)]


def test_indie_mart(table, rows):
    mart = table(TRUST, "indie_games")
    assert len(mart.columns) == 34
    got = rows(mart, "game_id", "platform_id", "company_id", "game_status", "game_completion_time_100")
    assert got == [
        (100, 6, 1, "released", 50000),
        (100, 6, 2, "released", 50000),
        (100, 7, 1, "released", 50000),
        (100, 7, 2, "released", 50000),
        (101, None, 77, "(Não Definido)", None),
    ]


def test_reports(lake, table, rows):
    by_genre = analyses.games_by(context(table, "games"), "genres", context(table, "genres"))
    assert rows(by_genre) == [("Indie", 2, 40.0), ("Shooter", 1, 20.0), ("Undefined", 2, 40.0)]
    raw_platforms = table(RAW, "platforms", CATALOGUE)
    codes = lake.enum("igdb_enums", "platforms", "category")
    assert (None, 1, 25.0) in rows(analyses.platforms_by_category(raw_platforms, codes))
    listings = analyses.listings_by_category(
        table(RAW, "external_games", CATALOGUE), lake.enum("igdb_enums", "external_games", "category")
    )
    assert rows(listings) == [("Unknown", 1, 33.33), ("Unknown", 1, 33.33), ("steam", 1, 33.33)]
    recent = analyses.recently_updated(context(table, "games")).collect()
    assert [r["name"] for r in recent] == ["Beta", "Gamma", "Alpha", "Delta"]
    rated = analyses.best_rated(context(table, "games")).collect()
    assert [r["id"] for r in rated] == [100, 102, 101, 103]
    profiled = analyses.numeric_profile(context(table, "games"))
    assert profiled.where(F.col("column") == "rating").first()["n"] == 2
