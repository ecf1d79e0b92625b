"""Column expressions the tables are built from; all run inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Platform family by category, for platforms without a family.
FAMILY_BY_CATEGORY = {
    "arcade": "Arcade",
    "console": "Other Consoles",
    "portable_console": "Portable Console",
    "platform": "Cloud Gaming",
    "computer": "Computer",
}
# Operating systems that count as mobile; the others are computers.
MOBILE_SYSTEMS = (
    "iOS",
    "Android",
    "BlackBerry OS",
    "Windows Mobile",
    "Palm OS",
    "Windows Phone",
)


def platform_family(family: Column, category: Column, name: Column) -> Column:
    """The family, or the one its category implies; null for an unknown category."""
    implied = F.when(
        category == "operating_system",
        F.when(name.isin(*MOBILE_SYSTEMS), "Mobile").otherwise("Computer"),
    )
    for code, label in FAMILY_BY_CATEGORY.items():
        implied = implied.when(category == code, label)
    return F.coalesce(family, implied)


def mean_of_present(a: Column, b: Column) -> Column:
    """Mean of two scores, or the one that is there."""
    return (F.coalesce(a, b) + F.coalesce(b, a)) / 2


def mean_with_total(total: Column, other: Column) -> Column:
    """Mean of a total and another score; the total alone if the other is null."""
    return (total + F.coalesce(other, total)) / 2


def local_date(epoch: Column, offset_hours: int = -3) -> Column:
    """`yyyy-MM-dd` of an epoch second in a fixed offset, whatever the session zone."""
    days = F.floor((epoch + F.lit(offset_hours * 3600)) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def hms(seconds: Column) -> Column:
    """`hh:mm:ss` of a duration in seconds."""
    whole = F.floor(seconds).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d", F.floor(whole / 3600), F.floor(whole / 60) % 60, whole % 60
    )


def percent(part: str, whole: str) -> Column:
    """100 * part / whole rounded half up to two digits, in integer arithmetic."""
    return F.expr(f"({part} * 20000 + {whole}) div ({whole} * 2)").cast("double") / 100


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def variant_field(column: Column | str, kind: str, path: str = "$") -> Column:
    """What a variant holds at a path, as `kind`; null where it is missing or is something else."""
    return F.try_variant_get(column, path, kind)


def variant_kind(column: Column | str) -> Column:
    """What a variant holds: 'object', 'array', 'text', 'number', 'flag', or null for a null."""
    told = F.schema_of_variant(column)
    return (
        F.when(told.startswith("OBJECT"), "object")
        .when(told.startswith("ARRAY"), "array")
        .when(told == "STRING", "text")
        .when(told == "BOOLEAN", "flag")
        .when(told != "VOID", "number")
    )
