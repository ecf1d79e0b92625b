"""The context and trust rules themselves, on the test tables in the shape they expect."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.operators.columns import sort_columns
from lakestrata.plans.context import CATALOGUE_RULES, TIMES_RULES
from lakestrata.plans.lake import CATALOGUE_ENUMS, COMMON_ENUMS, TableId
from lakestrata.plans.marts import (
    GAME_COLUMNS,
    INDIE_COMPANY,
    INDIE_GAME,
    INDIE_PLATFORM,
    MEMBER_RULES,
    games,
    games_by_platform,
    indie_games,
    involved_companies_by_game,
)
from workload.base import Source, check
from workload.joins import country_codes
from workload.members import LINE_PARTS_SQL, ORDER_CUSTOMERS_SQL, line_parts, order_customers


def col(source: str, name: str) -> Column:
    return F.expr(source).alias(name)


@dataclass
class Tables:
    """Raw tables and enum lists held as DataFrames, where a lake would read them."""

    raw: dict[str, DataFrame] = field(default_factory=dict)
    enums: dict[tuple[str, str, str], DataFrame] = field(default_factory=dict)

    def read(self, table: TableId, *, version: int | None = None, required: bool = True):
        return self.raw.get(table.name)

    def enum(self, api: str, entity: str, column: str) -> DataFrame | None:
        return self.enums.get((api, entity, column))


# --- memberships -----------------------------------------------------------


def _unfolded(fact: str, columns: str) -> str:
    return f"""fact AS ({fact}),
    unfolded AS (
        SELECT {columns}, unnest(members) AS member FROM fact
        UNION ALL
        SELECT {columns}, NULL FROM fact WHERE members IS NULL)"""


def _order_games(t: Source, array: str) -> DataFrame:
    return order_customers(t).select(
        col("o_orderkey", "id"),
        col("'order'", "name"),
        col("'main'", "category"),
        col("o_orderdate", "first_release_date"),
        F.col("members").alias(array),
    )


def _line_games(t: Source, array: str) -> DataFrame:
    return line_parts(t).select(
        col("l_orderkey", "id"),
        col("cast(l_linenumber as string)", "name"),
        col("'line'", "category"),
        col("l_shipdate", "first_release_date"),
        F.col("members").alias(array),
    )


def _line_mart(name: str, label: str) -> None:
    rule = MEMBER_RULES[name]
    (name_col,) = rule.take.values()

    @check(
        f"mart_{name}",
        f"""WITH {_unfolded(LINE_PARTS_SQL, 'l_orderkey, l_linenumber')}
            SELECT l_orderkey AS game_id, l_linenumber::VARCHAR AS game_name,
                   'line' AS game_category, member AS {rule.id_name},
                   coalesce(p_name, '{label}') AS {name_col}
            FROM unfolded LEFT JOIN part ON member = p_partkey""",
    )
    def query(t: Source) -> DataFrame:
        dim = t.part.select(col("p_partkey", "id"), col("p_name", "name"))
        return rule(_line_games(t, rule.array), dim)


def _order_mart(name: str, label: str, with_year: bool = False) -> None:
    rule = MEMBER_RULES[name]
    (name_col,) = rule.take.values()
    year = "CAST(year(o_orderdate) AS INTEGER) AS release_year," if with_year else ""

    @check(
        f"mart_{name}",
        f"""WITH {_unfolded(ORDER_CUSTOMERS_SQL, 'o_orderkey, o_orderdate')}
            SELECT o_orderkey AS game_id, 'order' AS game_name, 'main' AS game_category, {year}
                   member AS {rule.id_name}, coalesce(c_name, '{label}') AS {name_col}
            FROM unfolded LEFT JOIN customer ON member = c_custkey""",
    )
    def query(t: Source) -> DataFrame:
        dim = t.customer.select(col("c_custkey", "id"), col("c_name", "name"))
        return rule(_order_games(t, rule.array), dim)


_line_mart("game_modes_by_game", "(Não Definido)")
_line_mart("games_by_keyword", "(Sem palavra-chave)")
_line_mart("player_perspectives_by_game", "(Não Definido)")
_order_mart("games_by_genre", "(Não Definido)")
_order_mart("games_by_themes", "(Não Definido)")
_order_mart("games_by_franchise", "(Sem franquia)", with_year=True)


@check(
    "mart_games_age_ratings",
    f"""WITH {_unfolded(ORDER_CUSTOMERS_SQL, 'o_orderkey')}
        SELECT o_orderkey AS game_id, 'order' AS game_name, 'main' AS game_category,
               member AS age_rating_id, c_mktsegment AS age_rating_category,
               coalesce(CASE WHEN c_acctbal > 1000 THEN c_name END, '(Não Definida)') AS age_rating
        FROM unfolded LEFT JOIN customer ON member = c_custkey""",
)
def mart_age_ratings(t: Source) -> DataFrame:
    rule = MEMBER_RULES["games_age_ratings"]
    ratings = t.customer.select(
        col("c_custkey", "id"),
        col("c_mktsegment", "category"),
        col("case when c_acctbal > 1000 then c_name end", "rating"),
    )
    return rule(_order_games(t, rule.array), ratings)


@check(
    "mart_language_supports_by_game",
    f"""WITH {_unfolded(LINE_PARTS_SQL, 'l_orderkey, l_linenumber')}
        SELECT l_orderkey AS game_id, l_linenumber::VARCHAR AS game_name, 'line' AS game_category,
               member AS language_id, coalesce(p_name, '(Não Definido)') AS language,
               p_type AS language_support_type, p_brand AS locale
        FROM unfolded LEFT JOIN part ON member = p_partkey""",
)
def mart_language_supports(t: Source) -> DataFrame:
    rule = MEMBER_RULES["language_supports_by_game"]
    supports = t.part.select(
        col("p_partkey", "id"),
        col("p_name", "language"),
        col("p_type", "language_support_type"),
        col("p_brand", "locale"),
    )
    return rule(_line_games(t, rule.array), supports)


_PLATFORM_CATEGORY = """CASE p_type WHEN 'ECONOMY' THEN 'arcade' WHEN 'SMALL' THEN 'console'
    WHEN 'STANDARD' THEN 'operating_system' WHEN 'PROMO' THEN 'platform'
    WHEN 'MEDIUM' THEN 'portable_console' END"""


@check(
    "mart_games_by_platform",
    f"""WITH {_unfolded(LINE_PARTS_SQL, 'l_orderkey, l_linenumber')},
        platforms AS (
            SELECT p_partkey, p_name, CASE WHEN p_size < 25 THEN p_size END AS generation,
                   CASE WHEN p_size > 40 THEN p_brand END AS family, {_PLATFORM_CATEGORY} AS category
            FROM part),
        firsts AS (
            SELECT l_orderkey, l_partkey, min(l_shipdate) AS release_date,
                   min(CAST(year(l_shipdate) AS BIGINT)) AS release_year
            FROM lineitem WHERE l_returnflag <> 'A' GROUP BY 1, 2)
        SELECT u.l_orderkey AS game_id, l_linenumber::VARCHAR AS game_name, 'line' AS game_category,
               member AS platform_id, coalesce(p_name, '(Não Definida)') AS platform_name,
               coalesce(generation::VARCHAR, '(Não Definida)') AS platform_generation,
               coalesce(family, CASE category WHEN 'arcade' THEN 'Arcade'
                   WHEN 'console' THEN 'Other Consoles' WHEN 'platform' THEN 'Cloud Gaming'
                   WHEN 'portable_console' THEN 'Portable Console'
                   WHEN 'operating_system' THEN 'Computer' END, '(Não Definida)') AS platform_family,
               coalesce(category, '(Não Definida)') AS platform_category,
               release_date, release_year
        FROM unfolded u LEFT JOIN platforms ON member = p_partkey
        LEFT JOIN firsts f ON u.l_orderkey = f.l_orderkey AND member = f.l_partkey""",
)
def mart_platforms(t: Source) -> DataFrame:
    platforms = t.part.select(
        col("p_partkey", "id"),
        col("p_name", "name"),
        col("case when p_size < 25 then p_size end", "generation"),
        col("case when p_size > 40 then p_brand end", "platform_family"),
        col(_PLATFORM_CATEGORY, "category"),
    )
    release_dates = t.lineitem.where("l_returnflag <> 'A'").select(
        col("l_orderkey", "game"),
        col("l_partkey", "platform_id"),
        col("l_shipdate", "date"),
        col("cast(year(l_shipdate) as bigint)", "y"),
    )
    return games_by_platform(_line_games(t, "platforms"), platforms, release_dates)


# --- the other marts -------------------------------------------------------


@check(
    "mart_involved_companies_by_game",
    """WITH companies AS (
           SELECT s_suppkey, s_name, nullif(s_suppkey // 10, 0) AS parent, n_name
           FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1)
             ON s_nationkey = n_nationkey),
       named AS (
           SELECT c.s_suppkey, c.s_name, coalesce(c.n_name, '(Não Definido)') AS country,
                  coalesce(upper(c.n_name), '(Não Definido)') AS alpha,
                  coalesce(c.parent, c.s_suppkey) AS parent,
                  coalesce(p.s_name, c.s_name) AS parent_name
           FROM companies c LEFT JOIN companies p ON c.parent = p.s_suppkey),
       facts AS (
           SELECT l_linenumber, l_orderkey,
                  CASE WHEN l_returnflag = 'R' THEN l_suppkey * 2 ELSE l_suppkey END AS company,
                  l_linestatus = 'O' AS flag
           FROM lineitem)
       SELECT l_linenumber AS id, l_orderkey AS game_id, company AS company_id,
              s_name AS company_name, country AS company_country, alpha AS company_country_alpha3,
              parent AS parent_company_id, parent_name AS parent_company_name,
              flag AS developer, NOT flag AS porting, flag AS publisher, NOT flag AS supporting,
              o_orderpriority AS game_name, o_orderstatus AS game_category,
              NULL::VARCHAR AS game_version_title, o_orderdate AS game_first_release_date
       FROM facts LEFT JOIN named ON company = s_suppkey
       LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW') ON l_orderkey = o_orderkey""",
)
def mart_companies(t: Source) -> DataFrame:
    countries = t.nation.where("n_regionkey <> 1").withColumnRenamed("n_nationkey", "s_nationkey")
    companies = t.supplier.join(countries, "s_nationkey", "left").select(
        col("s_suppkey", "id"),
        col("s_name", "name"),
        col("nullif(s_suppkey div 10, 0)", "parent"),
        col("n_name", "country_name"),
        col("upper(n_name)", "country_alpha3"),
    )
    involved = t.lineitem.select(
        col("l_linenumber", "id"),
        col("l_orderkey", "game"),
        col("case when l_returnflag = 'R' then l_suppkey * 2 else l_suppkey end", "company"),
        col("l_linestatus = 'O'", "developer"),
        col("l_linestatus <> 'O'", "porting"),
        col("l_linestatus = 'O'", "publisher"),
        col("l_linestatus <> 'O'", "supporting"),
    )
    orders = t.orders.where("o_orderpriority <> '5-LOW'").select(
        col("o_orderkey", "id"),
        col("o_orderpriority", "name"),
        col("cast(null as string)", "version_title"),
        col("o_orderstatus", "category"),
        col("o_orderdate", "first_release_date"),
    )
    return involved_companies_by_game(involved, companies, orders)


# Every other column of the mart gets a number of its own, so that none can stand in for another.
_GAME_SHAPE = {
    **{c: f"doc_id + {1000 * (i + 1)}" for i, c in enumerate(GAME_COLUMNS)},
    "id": "doc_id",
    "name": "lang",
    "category": "source",
    "cover": "doc_id * 2",
    "rating": "case when lang = 'en' then n_chars / 100.0D end",
    "aggregated_rating": "n_chars / 10.0D",
    "total_rating": "case when lang <> 'de' then n_chars / 50.0D end",
    "rating_count": "n_chars",
    "aggregated_rating_count": "n_chars + 1",
    "total_rating_count": "n_chars + 2",
    "hypes": "n_chars + 3",
    "follows": "n_chars + 4",
}
_TIME_COLUMNS = (
    "comp_time_100",
    "comp_time_100_count",
    "comp_time_all_styles",
    "comp_time_all_styles_count",
    "comp_time_main_story",
    "comp_time_main_story_count",
    "comp_time_main_plus_sides",
    "comp_time_main_plus_sides_count",
)


def _documents_as_games(t: Source) -> DataFrame:
    return t.documents.select(*(col(e, c) for c, e in _GAME_SHAPE.items()))


_PLAIN_GAME_SQL = ", ".join(
    f"d.{_GAME_SHAPE[c]} AS {c}" for c in GAME_COLUMNS if _GAME_SHAPE[c].startswith("doc_id + ")
)
_TIMES_SQL = ", ".join(f"toxic + {i} AS {c}" for i, c in enumerate(_TIME_COLUMNS))


@check(
    "mart_games",
    f"""SELECT d.doc_id AS id, lang AS name, source AS category, d.doc_id * 2 AS cover_id,
              {_PLAIN_GAME_SQL}, {_TIMES_SQL},
              url AS cover_url, n_chars AS rating_igdb_users_count,
              n_chars + 1 AS rating_igdb_external_critics_count,
              n_chars + 2 AS rating_igdb_total_count,
              n_chars + 3 AS follows_before_release, n_chars + 4 AS follows,
              n_chars / 10.0::DOUBLE AS rating_igdb_external_critics,
              CASE WHEN lang = 'en' THEN n_chars / 100.0::DOUBLE END AS rating_igdb_users,
              CASE WHEN lang <> 'de' THEN n_chars / 50.0::DOUBLE END AS rating_igdb_total,
              CAST(quality AS DOUBLE) AS rating_hltb_users,
              (coalesce(CASE WHEN lang = 'en' THEN n_chars / 100.0::DOUBLE END, quality)
               + coalesce(quality, CASE WHEN lang = 'en' THEN n_chars / 100.0::DOUBLE END)) / 2
                  AS average_rating_users,
              (CASE WHEN lang <> 'de' THEN n_chars / 50.0::DOUBLE END
               + coalesce(quality, CASE WHEN lang <> 'de' THEN n_chars / 50.0::DOUBLE END)) / 2
                  AS average_rating_total
       FROM documents d LEFT JOIN pages ON d.doc_id * 2 = page_id
       LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def mart_games(t: Source) -> DataFrame:
    times = t.labels.select(
        col("doc_id", "id"),
        col("doc_id + 7", "game_id"),
        col("'x'", "platform"),
        col("cast(quality as double)", "review_score"),
        *(col(f"toxic + {i}", c) for i, c in enumerate(_TIME_COLUMNS)),
    )
    covers = t.pages.select(col("page_id", "id"), "url")
    return sort_columns(games(_documents_as_games(t), times, covers))


# Columns of the games, platforms and companies that the indie mart takes over, with values of their own.
_INDIE_NUMBERS = {
    c: f"o_totalprice + {i + 1}"
    for i, c in enumerate(c for c in INDIE_GAME if c not in ("first_release_date", "rating_igdb_total", "status"))
}
_INDIE_PLATFORM_TEXTS = {
    c: f"concat(l_returnflag, '{c}')" for c in INDIE_PLATFORM if c not in ("platform_id", "release_date")
}
_INDIE_COMPANY_TEXTS = {
    c: f"concat(o_orderstatus, '{c}')" for c in INDIE_COMPANY if c not in ("company_id", "company_name")
}


@check(
    "mart_indie_games",
    f"""WITH companies AS (
           SELECT o_orderkey, o_orderstatus, unnest([o_custkey, o_custkey * 2]) AS company FROM orders
           WHERE o_orderstatus <> 'P')
       SELECT o.o_orderkey AS game_id, 'order' AS game_name, 'main' AS game_category,
              l_partkey AS platform_id, l_shipdate AS platform_release_date,
              {", ".join(f"CASE WHEN l_orderkey IS NOT NULL THEN {e} END AS {INDIE_PLATFORM[c]}" for c, e in _INDIE_PLATFORM_TEXTS.items())},
              company AS company_id, c_name AS company_name,
              {", ".join(f"CASE WHEN c.o_orderkey IS NOT NULL THEN concat(c.o_orderstatus, '{c}') END AS {INDIE_COMPANY[c]}" for c in _INDIE_COMPANY_TEXTS)},
              o.o_totalprice AS rating_igdb_total, o.o_orderdate AS game_first_release_date,
              {", ".join(f"o.{e} AS {INDIE_GAME[c]}" for c, e in _INDIE_NUMBERS.items())},
              coalesce(CASE WHEN o.o_orderstatus <> 'F' THEN o.o_orderstatus END, '(Não Definido)')
                  AS game_status
       FROM orders o LEFT JOIN lineitem ON o.o_orderkey = l_orderkey
       LEFT JOIN companies c ON o.o_orderkey = c.o_orderkey
       LEFT JOIN customer ON company = c_custkey
       WHERE o.o_orderpriority = '1-URGENT'""",
)
def mart_indie(t: Source) -> DataFrame:
    by_genre = t.orders.select(
        col("o_orderkey", "game_id"),
        col("'order'", "game_name"),
        col("'main'", "game_category"),
        col("1", "genre_id"),
        col("case when o_orderpriority = '1-URGENT' then 'Indie' else 'Other' end", "genre_name"),
    )
    described = t.orders.select(
        col("o_orderkey", "id"),
        col("o_orderdate", "first_release_date"),
        col("o_totalprice", "rating_igdb_total"),
        col("case when o_orderstatus <> 'F' then o_orderstatus end", "status"),
        *(col(e, c) for c, e in _INDIE_NUMBERS.items()),
    )
    platforms = t.lineitem.select(
        col("l_orderkey", "game_id"),
        col("l_partkey", "platform_id"),
        col("l_shipdate", "release_date"),
        *(col(e, c) for c, e in _INDIE_PLATFORM_TEXTS.items()),
    )
    takers = t.orders.where("o_orderstatus <> 'P'").select(
        col("o_orderkey", "game_id"),
        F.explode(F.array("o_custkey", F.col("o_custkey") * 2)).alias("company_id"),
        *(col(e, c) for c, e in _INDIE_COMPANY_TEXTS.items()),
    )
    names = t.customer.select(col("c_custkey", "company_id"), col("c_name", "company_name"))
    return indie_games(by_genre, described, platforms, takers.join(names, "company_id", "left"))


# --- context rules ---------------------------------------------------------

_STAMPS_SQL = "date_trunc('second', o_orderdate) AS created_at, date_trunc('second', o_orderdate) AS updated_at"


def _stamped(t: Source, **columns: str) -> DataFrame:
    """Orders as raw records: id, stamps in epoch seconds, noise columns, `columns`."""
    epoch = "unix_timestamp(cast(o_orderdate as timestamp))"
    return t.orders.select(
        col("o_orderkey", "id"),
        col(epoch, "created_at"),
        col(epoch, "updated_at"),
        col("md5(o_orderpriority)", "checksum"),
        col("'s'", "slug"),
        *(col(e, c) for c, e in columns.items()),
    )


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the other engine has them."""
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def _codes(t: Source, regions: str) -> DataFrame:
    kept = t.nation.where(regions).select(F.col("n_name").alias("name"))
    return country_codes(t).join(kept, "name", "left_semi")


def _names(t: Source) -> DataFrame:
    return t.nation.select(col("cast(n_nationkey as bigint)", "id"), col("n_name", "name"))


@check(
    "ctx_standard",
    f"SELECT o_orderkey AS id, o_orderpriority AS name, {_STAMPS_SQL} FROM orders",
)
def ctx_standard(t: Source) -> DataFrame:
    raw = _stamped(t, name="o_orderpriority", url="'u'")
    return _plain_times(CATALOGUE_RULES["genres"].apply(raw, Tables()))


@check(
    "ctx_companies",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, o_custkey % 30 AS country_code,
               n.n_name AS country_name, m.n_name AS country_alpha3
        FROM orders LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n
          ON o_custkey % 30 = n.n_nationkey
        LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) m
          ON o_custkey % 30 = m.n_nationkey""",
)
def ctx_companies(t: Source) -> DataFrame:
    tables = Tables(
        enums={
            (COMMON_ENUMS, "iso_country_code", "countryname"): _codes(t, "n_regionkey <> 0"),
            (COMMON_ENUMS, "iso_country_code", "countryalpha3"): _codes(t, "n_regionkey <> 1"),
        }
    )
    raw = _stamped(t, country="o_custkey % 30", url="'u'")
    return _plain_times(CATALOGUE_RULES["companies"].apply(raw, tables))


@check(
    "ctx_covers",
    """SELECT page_id AS id, regexp_replace('//t_thumb/' || url || '/t_thumb', 't_thumb',
                                            't_cover_big', 'g') AS url
       FROM pages""",
)
def ctx_covers(t: Source) -> DataFrame:
    raw = t.pages.select(
        col("page_id", "id"),
        col("concat('//t_thumb/', url, '/t_thumb')", "url"),
        col("1", "height"),
        col("1", "width"),
        col("true", "animated"),
    )
    return CATALOGUE_RULES["covers"].apply(raw, Tables())


@check(
    "ctx_games",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, date_trunc('second', o_orderdate) AS first_release_date,
               n.n_name AS category, m.n_name AS status
        FROM orders LEFT JOIN nation n ON o_custkey % 30 = n.n_nationkey
        LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 1) m ON o_custkey % 25 = m.n_nationkey""",
)
def ctx_games(t: Source) -> DataFrame:
    tables = Tables(
        enums={
            (CATALOGUE_ENUMS, "games", "category"): country_codes(t),
            (CATALOGUE_ENUMS, "games", "status"): _codes(t, "n_regionkey <> 1"),
        }
    )
    raw = _stamped(
        t,
        category="o_custkey % 30",
        status="o_custkey % 25",
        first_release_date="unix_timestamp(cast(o_orderdate as timestamp))",
        tags="array(1)",
    )
    return _plain_times(CATALOGUE_RULES["games"].apply(raw, tables))


@check(
    "ctx_platforms",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, n.n_name AS category, m.n_name AS platform_family
        FROM orders LEFT JOIN nation n ON o_custkey % 30 = n.n_nationkey
        LEFT JOIN nation m ON nullif(o_custkey % 28, 2) = m.n_nationkey""",
)
def ctx_platforms(t: Source) -> DataFrame:
    tables = Tables(
        raw={"platform_families": _names(t)},
        enums={(CATALOGUE_ENUMS, "platforms", "category"): country_codes(t)},
    )
    raw = _stamped(
        t, category="o_custkey % 30", platform_family="nullif(o_custkey % 28, 2)", summary="'x'"
    )
    return _plain_times(CATALOGUE_RULES["platforms"].apply(raw, tables))


@check(
    "ctx_language_supports",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, o_custkey AS game, n.n_name AS language,
               lower(n.n_name) AS locale, m.n_name AS language_support_type
        FROM orders LEFT JOIN nation n ON o_custkey % 30 = n.n_nationkey
        LEFT JOIN nation m ON o_custkey % 28 = m.n_nationkey""",
)
def ctx_language_supports(t: Source) -> DataFrame:
    tables = Tables(
        raw={
            "languages": _names(t).withColumn("locale", F.lower("name")),
            "language_support_types": _names(t),
        }
    )
    raw = _stamped(
        t, game="o_custkey", language="o_custkey % 30", language_support_type="o_custkey % 28"
    ).drop("slug")
    return _plain_times(CATALOGUE_RULES["language_supports"].apply(raw, tables))


@check(
    "ctx_age_ratings",
    """SELECT c_custkey AS id, n.n_name AS category, m.n_name AS rating
       FROM customer LEFT JOIN nation n ON c_nationkey = n.n_nationkey
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) m ON c_nationkey = m.n_nationkey""",
)
def ctx_age_ratings(t: Source) -> DataFrame:
    tables = Tables(
        enums={
            (CATALOGUE_ENUMS, "age_ratings", "category"): country_codes(t),
            (CATALOGUE_ENUMS, "age_ratings", "rating"): _codes(t, "n_regionkey <> 3"),
        }
    )
    raw = t.customer.select(
        col("c_custkey", "id"),
        col("c_nationkey", "category"),
        col("c_nationkey", "rating"),
        col("'x'", "checksum"),
    )
    return CATALOGUE_RULES["age_ratings"].apply(raw, tables)


@check(
    "ctx_game_localizations",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, n_name AS region
        FROM orders LEFT JOIN nation ON o_custkey % 30 = n_nationkey""",
)
def ctx_game_localizations(t: Source) -> DataFrame:
    tables = Tables(raw={"regions": _names(t)})
    raw = _stamped(t, region="o_custkey % 30").drop("slug")
    return _plain_times(CATALOGUE_RULES["game_localizations"].apply(raw, tables))


@check(
    "ctx_release_dates",
    f"""SELECT o_orderkey AS id, {_STAMPS_SQL}, date_trunc('second', o_orderdate) AS date,
               n.n_name AS category, m.n_name AS region, s.n_name AS status,
               c_custkey AS platform_id, c_name AS platform_name
        FROM orders LEFT JOIN nation n ON o_custkey % 30 = n.n_nationkey
        LEFT JOIN nation m ON o_custkey % 27 = m.n_nationkey
        LEFT JOIN nation s ON o_custkey % 26 = s.n_nationkey
        LEFT JOIN customer ON o_custkey * 2 = c_custkey""",
)
def ctx_release_dates(t: Source) -> DataFrame:
    tables = Tables(
        raw={
            "release_date_statuses": _names(t),
            "platforms": t.customer.select(col("c_custkey", "id"), col("c_name", "name")),
        },
        enums={
            (CATALOGUE_ENUMS, "release_date", "category"): country_codes(t),
            (CATALOGUE_ENUMS, "release_date", "region"): country_codes(t),
        },
    )
    raw = _stamped(
        t,
        category="o_custkey % 30",
        region="o_custkey % 27",
        status="o_custkey % 26",
        platform="o_custkey * 2",
        date="unix_timestamp(cast(o_orderdate as timestamp))",
    ).drop("slug")
    return _plain_times(CATALOGUE_RULES["release_dates"].apply(raw, tables))


@check(
    "ctx_websites",
    """SELECT page_id AS id, url, n_name AS category
       FROM pages LEFT JOIN nation ON page_id % 30 = n_nationkey""",
)
def ctx_websites(t: Source) -> DataFrame:
    tables = Tables(enums={(CATALOGUE_ENUMS, "websites", "category"): country_codes(t)})
    raw = t.pages.select(
        col("page_id", "id"), "url", col("page_id % 30", "category"), col("'x'", "checksum")
    )
    return CATALOGUE_RULES["websites"].apply(raw, tables)


@check(
    "ctx_times",
    """SELECT doc_id AS id, doc_id + 1 AS game_id, lang AS name, n_chars AS comp_time_100,
              n_chars + 1 AS comp_time_all_styles, n_chars + 2 AS comp_time_main_story,
              n_chars + 3 AS comp_time_main_plus_sides, source AS developer, 'pc' AS platform,
              n_chars + 4 AS steam_id, 2001 AS release_year, n_chars + 5 AS count_completed,
              TIMESTAMP '2024-01-01' AS extracted_datetime
       FROM documents""",
)
def ctx_times(t: Source) -> DataFrame:
    raw = t.documents.select(
        col("doc_id", "id"),
        col("doc_id + 1", "game_id"),
        col("lang", "game_name"),
        col("n_chars", "comp_100"),
        col("n_chars + 1", "comp_all"),
        col("n_chars + 2", "comp_main"),
        col("n_chars + 3", "comp_plus"),
        col("source", "profile_dev"),
        col("'pc'", "profile_platform"),
        col("n_chars + 4", "profile_steam"),
        col("2001", "release_world"),
        col("n_chars + 5", "count_comp"),
        col("1704067200L", "extracted_datetime"),
        col("'i'", "game_image"),
        col("1", "comp_lvl_sp"),
    )
    return _plain_times(TIMES_RULES["games"].apply(raw, Tables()))


@check(
    "ctx_involved_companies",
    f"""SELECT o_orderkey AS id, o_custkey AS company, o_orderstatus = 'O' AS developer, 's' AS slug, {_STAMPS_SQL}
        FROM orders""",
)
def ctx_involved_companies(t: Source) -> DataFrame:
    raw = _stamped(t, company="o_custkey", developer="o_orderstatus = 'O'")
    return _plain_times(CATALOGUE_RULES["involved_companies"].apply(raw, Tables()))


@check(
    "ctx_multiplayer_modes",
    "SELECT o_orderkey AS id, o_orderstatus = 'F' AS lancoop, o_custkey AS game FROM orders",
)
def ctx_multiplayer_modes(t: Source) -> DataFrame:
    raw = t.orders.select(
        col("o_orderkey", "id"), col("o_orderstatus = 'F'", "lancoop"), col("o_custkey", "game"), col("'x'", "checksum")
    )
    return CATALOGUE_RULES["multiplayer_modes"].apply(raw, Tables())


@check(
    "ctx_external_games",
    f"""SELECT o_orderkey AS id, n_name AS category, 's' AS slug, {_STAMPS_SQL}
        FROM orders LEFT JOIN nation ON o_custkey % 30 = n_nationkey""",
)
def ctx_external_games(t: Source) -> DataFrame:
    tables = Tables(enums={(CATALOGUE_ENUMS, "external_games", "category"): country_codes(t)})
    return _plain_times(CATALOGUE_RULES["external_games"].apply(_stamped(t, category="o_custkey % 30"), tables))


@check(
    "ctx_content_descriptions",
    """SELECT page_id AS id, url AS description, n_name AS category
       FROM pages LEFT JOIN nation ON page_id % 30 = n_nationkey""",
)
def ctx_content_descriptions(t: Source) -> DataFrame:
    enum = (CATALOGUE_ENUMS, "age_rating_content_description", "category")
    raw = t.pages.select(
        col("page_id", "id"), col("url", "description"), col("page_id % 30", "category"), col("'x'", "checksum")
    )
    return CATALOGUE_RULES["age_rating_content_descriptions"].apply(raw, Tables(enums={enum: country_codes(t)}))
