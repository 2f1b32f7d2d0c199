"""Column names of sheet headers, and months spelled in file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import column, strip

# The order matters, and blanks are stripped before any of them.
BASIC_REPLACEMENTS = [(" ", "_")]
FULL_REPLACEMENTS = [
    (" ", "_"),
    ("*", ""),
    ("&", "and"),
    ("-", "_"),
    ("’", ""),
    ("'", ""),
    (".", "_"),
]
# Month spellings accepted in strict file names.
MONTH_SPELLINGS = {
    "jan": 1, "feb": 2, "mar": 3, "april": 4, "apr": 4, "may": 5, "jun": 6, "june": 6,
    "july": 7, "jul": 7, "aug": 8, "sep": 9, "sept": 9, "oct": 10, "nov": 11, "dec": 12,
}
# Lenient names spell a month in full or in short.
LENIENT_SPELLINGS = {
    **MONTH_SPELLINGS,
    "january": 1, "february": 2, "march": 3, "august": 8, "september": 9,
    "october": 10, "november": 11, "december": 12,
}
STRICT_NAME = r"-([^-]*)-([^-]*)\.[a-z]+$"
LENIENT_NAME = r"medicaid-(\w+)-(\d{4})\.[a-z]+"


def _replacements(level: str) -> list[tuple[str, str]]:
    return {"full": FULL_REPLACEMENTS, "basic": BASIC_REPLACEMENTS}[level]


def normalise_name(name: str, level: str = "full") -> str:
    return reduce(lambda s, pair: s.replace(*pair), _replacements(level), name.strip().lower())


def normalise_columns(df: DataFrame, level: str = "full") -> DataFrame:
    """Rename all columns; touches metadata only."""
    return df.toDF(*[normalise_name(name, level) for name in df.columns])


def normalised(name: Column, level: str = "full") -> Column:
    """`normalise_name` for header cells that are still data."""
    return reduce(
        lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])),
        _replacements(level),
        F.lower(strip(name)),
    )


def repaired_header(cells: Column) -> Column:
    """Header cells with a blank one named by position and a repeated one numbered."""

    def repair(cell: Column, i: Column) -> Column:
        earlier = F.size(F.filter(F.slice(cells, F.lit(1), i), lambda other: other == cell))
        blank = F.concat(F.lit("Unnamed: "), i.cast("string"))
        numbered = F.concat(cell, F.lit("."), earlier.cast("string"))
        unnamed = F.coalesce(cell, F.lit("")) == ""
        return F.when(unnamed, blank).when(earlier > 0, numbered).otherwise(cell)

    return F.transform(cells, repair)


def month_from_name(name: Column | str, on_unknown: str = "raise") -> Column:
    """First day of the month that ends a file name.

    `raise`: the last two dash-separated parts are month and year, and a spelling outside
    the fixed list fails the job. `skip`: names without a `medicaid-<month>-<year>` part
    give NULL, to be filtered and reported; a month spelled in full is accepted too.
    """
    name = column(name)
    if on_unknown == "raise":
        text, pattern, spellings = F.lower(name), STRICT_NAME, MONTH_SPELLINGS
    elif on_unknown == "skip":
        text, pattern, spellings = name, LENIENT_NAME, LENIENT_SPELLINGS
    else:
        raise ValueError(f"on_unknown must be 'raise' or 'skip', not {on_unknown!r}")
    months = F.create_map(*[F.lit(x) for pair in spellings.items() for x in pair])
    month = F.try_element_at(months, F.lower(F.regexp_extract(text, pattern, 1)))
    year = F.regexp_extract(text, pattern, 2)
    first_day = F.concat(year, F.lit("-"), month.cast("string"), F.lit("-01"))
    unknown = F.raise_error(F.concat(F.lit("no month in file name: "), name)).cast("date")
    found = F.coalesce(first_day.try_cast("date"), unknown)
    return found if on_unknown == "raise" else F.when(text.rlike(pattern), found)
