"""Context tables: raw records cleaned, typed and decoded.

Every table is a rule: columns to drop, epoch columns to convert, then steps.
Columns end up in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators.columns import drop_columns, epoch_to_timestamp, rename, sort_columns
from lakestrata.operators.enrich import decode, lookup
from lakestrata.plans.lake import (
    CATALOGUE,
    CATALOGUE_ENUMS,
    COMMON_ENUMS,
    CONTEXT,
    RAW,
    TIMES,
    Lake,
    TableId,
)
from lakestrata.plans.runner import TableSpec

@dataclass(frozen=True)
class Step:
    """A change of the records, and the tables it reads for that."""

    change: Callable[[DataFrame, Lake], DataFrame]
    reads: tuple[TableId, ...] = ()


def decoded(
    column: str,
    entity: str,
    enum: str | None = None,
    *,
    api: str = CATALOGUE_ENUMS,
    into: str | None = None,
) -> Step:
    """Decode `column` with the enum list (entity, enum); the enum defaults to the column."""
    name = enum or column
    return Step(
        lambda df, lake: decode(df, column, lake.enum(api, entity, name), into=into),
        (TableId(RAW, f"{entity}/{name}", api),),
    )


def looked_up(key: str, table: str, take: Mapping[str, str]) -> Step:
    """Swap the id in `key` for columns of a raw table; nothing happens without that table."""
    source = TableId(RAW, table, CATALOGUE)

    def change(df: DataFrame, lake: Lake) -> DataFrame:
        dim = lake.read(source, required=False)
        return df if dim is None else lookup(df, key, dim, take)

    return Step(change, (source,))


def replaced(column: str, old: str, new: str) -> Step:
    return Step(lambda df, lake: df.withColumn(column, F.regexp_replace(column, old, new)))


def renamed(mapping: Mapping[str, str]) -> Step:
    return Step(lambda df, lake: rename(df, mapping))


@dataclass(frozen=True)
class Rule:
    drop: tuple[str, ...] = ()
    epochs: tuple[str, ...] = ()
    steps: tuple[Step, ...] = ()

    def apply(self, df: DataFrame, lake: Lake) -> DataFrame:
        df = epoch_to_timestamp(drop_columns(df, self.drop), self.epochs)
        for step in self.steps:
            df = step.change(df, lake)
        return sort_columns(df)


# Columns to drop, epoch columns, enum lists and renames per table.
_STAMPS = ("created_at", "updated_at")
_NAMED = Rule(drop=("checksum", "slug", "url"), epochs=_STAMPS)

CATALOGUE_RULES: dict[str, Rule] = {
    **dict.fromkeys(
        (
            "game_modes",
            "genres",
            "themes",
            "franchises",
            "collections",
            "game_engines",
            "player_perspectives",
            "keywords",
        ),
        _NAMED,
    ),
    "multiplayer_modes": Rule(drop=("checksum",)),
    "involved_companies": Rule(drop=("checksum",), epochs=_STAMPS),
    "companies": Rule(
        drop=("checksum", "slug", "url"),
        epochs=_STAMPS,
        steps=(
            decoded("country", "iso_country_code", "countryname", api=COMMON_ENUMS, into="country_name"),
            decoded("country", "iso_country_code", "countryalpha3", api=COMMON_ENUMS, into="country_alpha3"),
            renamed({"country": "country_code"}),
        ),
    ),
    "covers": Rule(
        drop=("alpha_channel", "animated", "checksum", "height", "image_id", "width"),
        steps=(replaced("url", "t_thumb", "t_cover_big"),),
    ),
    "games": Rule(
        drop=("checksum", "slug", "videos", "alternative_names", "artworks", "screenshots", "tags"),
        epochs=("created_at", "first_release_date", "updated_at"),
        steps=(decoded("category", "games"), decoded("status", "games")),
    ),
    "platforms": Rule(
        drop=("checksum", "slug", "url", "summary", "versions", "websites"),
        epochs=_STAMPS,
        steps=(
            decoded("category", "platforms"),
            looked_up("platform_family", "platform_families", {"name": "platform_family"}),
        ),
    ),
    "language_supports": Rule(
        drop=("checksum",),
        epochs=_STAMPS,
        steps=(
            looked_up("language", "languages", {"name": "language", "locale": "locale"}),
            looked_up(
                "language_support_type", "language_support_types", {"name": "language_support_type"}
            ),
        ),
    ),
    "age_ratings": Rule(
        drop=("checksum",),
        steps=(decoded("category", "age_ratings"), decoded("rating", "age_ratings")),
    ),
    "game_localizations": Rule(
        drop=("checksum",),
        epochs=_STAMPS,
        steps=(looked_up("region", "regions", {"name": "region"}),),
    ),
    "release_dates": Rule(
        drop=("checksum",),
        epochs=(*_STAMPS, "date"),
        steps=(
            decoded("category", "release_date"),
            decoded("region", "release_date"),
            looked_up("status", "release_date_statuses", {"name": "status"}),
            looked_up("platform", "platforms", {"id": "platform_id", "name": "platform_name"}),
        ),
    ),
    "websites": Rule(drop=("checksum",), steps=(decoded("category", "websites"),)),
    "external_games": Rule(
        drop=("checksum",), epochs=_STAMPS, steps=(decoded("category", "external_games"),)
    ),
    "age_rating_content_descriptions": Rule(
        drop=("checksum",), steps=(decoded("category", "age_rating_content_description"),)
    ),
}

TIMES_RULES: dict[str, Rule] = {
    "games": Rule(
        drop=(
            "game_image",
            "invested_co",
            "invested_co_count",
            "invested_mp",
            "invested_mp_count",
            "comp_lvl_co",
            "comp_lvl_combine",
            "comp_lvl_mp",
            "comp_lvl_sp",
            "comp_lvl_spd",
            "game_name_date",
            "profile_popular",
        ),
        epochs=("extracted_datetime",),
        steps=(
            renamed(
                {
                    "comp_100": "comp_time_100",
                    "comp_100_count": "comp_time_100_count",
                    "comp_all": "comp_time_all_styles",
                    "comp_all_count": "comp_time_all_styles_count",
                    "comp_main": "comp_time_main_story",
                    "comp_main_count": "comp_time_main_story_count",
                    "comp_plus": "comp_time_main_plus_sides",
                    "comp_plus_count": "comp_time_main_plus_sides_count",
                    "count_comp": "count_completed",
                    "game_name": "name",
                    "profile_dev": "developer",
                    "profile_platform": "platform",
                    "profile_steam": "steam_id",
                    "release_world": "release_year",
                }
            ),
        ),
    ),
}


def _spec(api: str, name: str, rule: Rule) -> TableSpec:
    raw = TableId(RAW, name, api)
    return TableSpec(
        target=TableId(CONTEXT, name, api),
        sources=(raw, *dict.fromkeys(t for step in rule.steps for t in step.reads)),
        transform=lambda lake: rule.apply(lake.read(raw), lake),
    )


CONTEXT_TABLES: dict[str, TableSpec] = {
    spec.target.folder: spec
    for api, rules in ((CATALOGUE, CATALOGUE_RULES), (TIMES, TIMES_RULES))
    for spec in (_spec(api, name, rule) for name, rule in rules.items())
}
