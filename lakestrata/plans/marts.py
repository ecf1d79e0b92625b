"""Trust marts: denormalised tables over the context layer.

The functions take and give DataFrames; `MARTS` says which tables feed them
and in which order the rows are stored.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.expressions import mean_of_present, mean_with_total, platform_family
from lakestrata.operators.analytics import earliest
from lakestrata.operators.columns import fill_label, sort_columns
from lakestrata.operators.enrich import fan_out, lookup, with_parent
from lakestrata.operators.membership import membership
from lakestrata.plans.lake import CATALOGUE, CONTEXT, TIMES, TRUST, TableId
from lakestrata.plans.runner import TableSpec

# Labels for members that are not there.
UNDEFINED_F = "(Não Definida)"
UNDEFINED_M = "(Não Definido)"
NO_FRANCHISE = "(Sem franquia)"
NO_KEYWORD = "(Sem palavra-chave)"

# Source column -> mart column.
GAME = {"id": "game_id", "name": "game_name", "category": "game_category"}


def _as(columns: Mapping[str, str]) -> list[Column]:
    return [F.col(source).alias(name) for source, name in columns.items()]


@dataclass(frozen=True)
class MemberRule:
    """A mart that lists the members of one array column of the games."""

    array: str
    id_name: str
    dim: str
    take: Mapping[str, str]
    defaults: Mapping[str, str]
    with_year: bool = False

    def __call__(self, games: DataFrame, dim: DataFrame) -> DataFrame:
        keep = _as(GAME)
        if self.with_year:
            keep.append(F.year("first_release_date").alias("release_year"))
        return membership(games, keep, self.array, self.id_name, dim, self.take, self.defaults)


def _named_members(array: str, prefix: str, dim: str, label: str, **options) -> MemberRule:
    """Members with one label, `<prefix>_id` and `<prefix>_name`."""
    name = f"{prefix}_name"
    return MemberRule(array, f"{prefix}_id", dim, {"name": name}, {name: label}, **options)


# The marts that are one membership each.
MEMBER_RULES: dict[str, MemberRule] = {
    "games_age_ratings": MemberRule(
        "age_ratings",
        "age_rating_id",
        "age_ratings",
        {"category": "age_rating_category", "rating": "age_rating"},
        {"age_rating": UNDEFINED_F},
    ),
    "game_modes_by_game": _named_members("game_modes", "game_mode", "game_modes", UNDEFINED_M),
    "games_by_franchise": _named_members(
        "franchises", "franchise", "franchises", NO_FRANCHISE, with_year=True
    ),
    "games_by_genre": _named_members("genres", "genre", "genres", UNDEFINED_M),
    "games_by_keyword": _named_members("keywords", "keyword", "keywords", NO_KEYWORD),
    "games_by_themes": _named_members("themes", "theme", "themes", UNDEFINED_M),
    "language_supports_by_game": MemberRule(
        "language_supports",
        "language_id",
        "language_supports",
        {
            "language": "language",
            "language_support_type": "language_support_type",
            "locale": "locale",
        },
        {"language": UNDEFINED_M},
    ),
    "player_perspectives_by_game": _named_members(
        "player_perspectives", "player_perspective", "player_perspectives", UNDEFINED_M
    ),
}


def games_by_platform(
    games: DataFrame, platforms: DataFrame, release_dates: DataFrame
) -> DataFrame:
    """Platforms per game with the first release there and a family for every platform."""
    members = membership(
        games,
        _as(GAME),
        "platforms",
        "platform_id",
        platforms,
        {
            "name": "platform_name",
            "generation": "platform_generation",
            "platform_family": "platform_family",
            "category": "platform_category",
        },
    )
    first = earliest(
        release_dates.withColumnRenamed("game", "game_id"),
        ["game_id", "platform_id"],
        {"release_date": "date", "release_year": "y"},
    )
    family = platform_family(
        F.col("platform_family"), F.col("platform_category"), F.col("platform_name")
    )
    dated = members.join(first, ["game_id", "platform_id"], "left")
    return fill_label(
        dated.withColumn("platform_family", family),
        dict.fromkeys(
            ("platform_name", "platform_category", "platform_family", "platform_generation"),
            UNDEFINED_F,
        ),
    )


def involved_companies_by_game(
    involved: DataFrame, companies: DataFrame, games: DataFrame
) -> DataFrame:
    """Companies per game with country, parent and role.

    Country labels are set before the join to the facts: a fact whose company
    is unknown keeps null company columns.
    """
    named = fill_label(
        with_parent(companies, "id", "parent", "name", parent_name="parent_company_name"),
        dict.fromkeys(("country_name", "country_alpha3"), UNDEFINED_M),
    )
    facts = involved.select(
        "id",
        F.col("game").alias("game_id"),
        F.col("company").alias("company_id"),
        "developer",
        "porting",
        "publisher",
        "supporting",
    )
    with_company = lookup(
        facts,
        "company_id",
        named,
        {
            "name": "company_name",
            "country_name": "company_country",
            "country_alpha3": "company_country_alpha3",
            "parent": "parent_company_id",
            "parent_company_name": "parent_company_name",
        },
        keep_key=True,
    )
    return lookup(
        with_company,
        "game_id",
        games,
        {
            "name": "game_name",
            "version_title": "game_version_title",
            "category": "game_category",
            "first_release_date": "game_first_release_date",
        },
        keep_key=True,
    )


# Columns of the games mart and the names some of them get.
GAME_COLUMNS = (
    "bundles",
    "category",
    "collection",
    "dlcs",
    "expanded_games",
    "expansions",
    "first_release_date",
    "follows",
    "forks",
    "franchise",
    "game_engines",
    "id",
    "name",
    "parent_game",
    "ports",
    "remakes",
    "remasters",
    "similar_games",
    "standalone_expansions",
    "status",
    "version_parent",
    "version_title",
)
GAME_RENAMES = {
    "aggregated_rating": "rating_igdb_external_critics",
    "aggregated_rating_count": "rating_igdb_external_critics_count",
    "cover": "cover_id",
    "hypes": "follows_before_release",
    "rating": "rating_igdb_users",
    "rating_count": "rating_igdb_users_count",
    "total_rating": "rating_igdb_total",
    "total_rating_count": "rating_igdb_total_count",
}
# Completion-time columns the games mart leaves out.
TIMES_LEFT_OUT = frozenset(
    {
        "extracted_datetime",
        "game_alias",
        "game_id",
        "game_type",
        "id",
        "name",
        "platform",
        "release_year",
        "steam_id",
    }
)


def games(
    catalogue: DataFrame, times: DataFrame, covers: DataFrame, *, times_key: str = "id"
) -> DataFrame:
    """Games with cover, completion times and blended ratings.

    `times_key` is the column of the completion times that holds the game's id.
    """
    base = catalogue.select(*GAME_COLUMNS, *_as(GAME_RENAMES))
    covered = lookup(base, "cover_id", covers, {"url": "cover_url"}, keep_key=True)
    take = {c: c for c in times.columns if c not in TIMES_LEFT_OUT}
    take["review_score"] = "rating_hltb_users"
    timed = lookup(covered, "id", times, take, dim_key=times_key, keep_key=True)
    users, other = F.col("rating_igdb_users"), F.col("rating_hltb_users")
    return timed.withColumns(
        {
            "average_rating_users": mean_of_present(users, other),
            "average_rating_total": mean_with_total(F.col("rating_igdb_total"), other),
        }
    )


# Columns the indie mart takes from the other marts.
INDIE_GENRE = "Indie"
INDIE_PLATFORM = {
    "platform_id": "platform_id",
    "platform_name": "platform_name",
    "platform_generation": "platform_generation",
    "platform_family": "platform_family",
    "platform_category": "platform_category",
    "release_date": "platform_release_date",
    "release_year": "platform_release_year",
}
INDIE_COMPANY = {
    "company_id": "company_id",
    "company_name": "company_name",
    "company_country": "company_country",
    "company_country_alpha3": "company_country_alpha3",
    "parent_company_id": "parent_company_id",
    "parent_company_name": "parent_company_name",
    "developer": "developer",
    "porting": "porting",
    "publisher": "publisher",
    "supporting": "supporting",
}
INDIE_GAME = {
    "first_release_date": "game_first_release_date",
    "follows": "game_followers",
    "follows_before_release": "game_followers_before_release",
    "rating_igdb_external_critics": "rating_igdb_external_critics",
    "rating_igdb_total": "rating_igdb_total",
    "rating_igdb_users": "rating_igdb_users",
    "rating_hltb_users": "rating_hltb_users",
    "average_rating_users": "average_rating_users",
    "average_rating_total": "average_rating_total",
    "comp_time_100": "game_completion_time_100",
    "comp_time_all_styles": "game_completion_time_all_styles",
    "comp_time_main_story": "game_completion_time_main_story",
    "comp_time_main_plus_sides": "game_completion_time_main_plus_sides",
    "status": "game_status",
}


def indie_games(
    by_genre: DataFrame, games: DataFrame, by_platform: DataFrame, companies: DataFrame
) -> DataFrame:
    """Indie games x platforms x companies.

    The one-row-per-game columns join first, so the fan-out comes last.
    """
    indie = by_genre.where(F.col("genre_name") == INDIE_GENRE).drop("genre_id", "genre_name")
    described = fill_label(
        lookup(indie, "game_id", games, INDIE_GAME, keep_key=True), {"game_status": UNDEFINED_M}
    )
    on_platforms = fan_out(described, "game_id", by_platform, INDIE_PLATFORM, other_key="game_id")
    return fan_out(on_platforms, "game_id", companies, INDIE_COMPANY, other_key="game_id")


def _context(name: str, api: str = CATALOGUE) -> TableId:
    return TableId(CONTEXT, name, api)


def _mart(
    name: str,
    build: Callable[..., DataFrame],
    sources: tuple[TableId, ...],
    sort_by: tuple[str, ...] = (),
) -> TableSpec:
    return TableSpec(
        target=TableId(TRUST, name),
        sources=sources,
        transform=lambda lake: sort_columns(build(*(lake.read(s) for s in sources))),
        sort_by=sort_by,
    )


def _member_mart(name: str) -> TableSpec:
    rule = MEMBER_RULES[name]
    return _mart(name, rule, (_context("games"), _context(rule.dim)), ("game_id", rule.id_name))


# In build order: the last two read what comes before them.
MARTS: dict[str, TableSpec] = {
    spec.target.name: spec
    for spec in (
        _mart(
            "games_by_platform",
            games_by_platform,
            (_context("games"), _context("platforms"), _context("release_dates")),
            ("game_id", "platform_id"),
        ),
        *(_member_mart(name) for name in MEMBER_RULES),
        _mart(
            "involved_companies_by_game",
            involved_companies_by_game,
            (_context("involved_companies"), _context("companies"), _context("games")),
        ),
        _mart(
            "games",
            games,
            (_context("games"), _context("games", TIMES), _context("covers")),
            ("id",),
        ),
        _mart(
            "indie_games",
            indie_games,
            (
                TableId(TRUST, "games_by_genre"),
                TableId(TRUST, "games"),
                TableId(TRUST, "games_by_platform"),
                TableId(TRUST, "involved_companies_by_game"),
            ),
            ("game_id", "platform_id", "company_id"),
        ),
    )
}
