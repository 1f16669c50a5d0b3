"""Text and number cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mean "missing", in any letter case.
NULL_WORDS = ("", "nan", "none", "null")
UNKNOWN_WORDS = ("unknown", "n/a")
# List states by name.
STATUS_CODES = {"watching": 1, "completed": 2, "on hold": 3, "dropped": 4, "plan to watch": 6}

#: White space of every script, with the four separator control signs.
SPACE = r"[\s\x1c-\x1f\x{85}\p{Z}]"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INTEGER = r"^\+?\d+$|^-0+$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, which is worked out once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def keep_text(clean: Column, unknown_is_null: bool = False) -> Column:
    """Commas for semicolons in a collapsed text; missing words become null.

    ``unknown_is_null`` also takes "unknown" and "n/a" as missing.
    """
    words = NULL_WORDS + (UNKNOWN_WORDS if unknown_is_null else ())
    return F.when(~F.lower(clean).isin(*words), F.translate(clean, ";", ","))


def catalogue_text(text: Column, unknown_is_null: bool = False) -> Column:
    """:func:`keep_text` of the collapsed text."""
    return keep_text(collapse(text), unknown_is_null)


def prompt_text(text: Column) -> Column:
    """Collapsed text; null becomes the empty text."""
    return F.coalesce(collapse(text), F.lit(""))


def imported_text(text: Column) -> Column:
    """Stripped text; empty and "nan" become null."""
    clean = strip(text)
    return F.when(~F.lower(clean).isin("", "nan"), clean)


def number(value: Column) -> Column:
    """A plain decimal number as double, anything else null."""
    return F.regexp_extract(strip(value.cast("string")), _NUMBER, 0).try_cast("double")


def keep_score(parsed: Column) -> Column:
    """A number from 0 to 10, else null."""
    return F.when(parsed.between(0.0, 10.0), parsed)


def score(value: Column) -> Column:
    """A score from 0 to 10, else null."""
    return keep_score(number(value))


def keep_whole(parsed: Column) -> Column:
    """A number cut to a whole one, null if below zero or too large."""
    return F.when(parsed > -1, parsed.try_cast("bigint"))


def nonnegative_int(value: Column) -> Column:
    """A number cut to a whole one, null if below zero or no number."""
    return keep_whole(number(value))


def strict_nonnegative_int(value: Column) -> Column:
    """As above, but a text must be a whole number ('20.8' is null)."""
    return F.nullif(F.regexp_extract(strip(value.cast("string")), _INTEGER, 0), F.lit("")).try_cast("bigint")


def int_or(value: Column, default: int) -> Column:
    """A number cut to a whole one, or the default."""
    return F.coalesce(number(value).try_cast("bigint"), F.lit(default).cast("bigint"))


def status_code(value: Column, default: int | Column) -> Column:
    """Code of a list state given as name or number; unknown names and negatives give the default."""
    default = F.lit(default) if isinstance(default, int) else default
    name = F.translate(F.lower(strip(value.cast("string"))), "-_", "  ")
    by_name = F.lit(None).cast("int")
    for word, code in reversed(STATUS_CODES.items()):
        by_name = F.when(name == word, code).otherwise(by_name)
    by_number = number(value).try_cast("int")
    return F.coalesce(by_name, F.when(by_number >= 0, by_number), default.cast("int"))


def format_value(value: Column, kind: str = "string") -> Column:
    """Text of a value: 'Unknown' for null, doubles with up to six decimals and no trailing zeros."""
    if kind == "double":
        fixed = F.format_string("%.6f", F.coalesce(value, F.lit(0.0)))
        text = F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", "")
        return F.when(value.isNull(), "Unknown").otherwise(text)
    return F.coalesce(value.cast("string"), F.lit("Unknown"))


def labelled_text(parts: Iterable[tuple[str, Column]]) -> Column:
    """'Label: value; Label: value.' over texts that are never null."""
    return F.concat(F.concat_ws("; ", *[F.concat(F.lit(f"{label}: "), value) for label, value in parts]), F.lit("."))


def split_list(value: Column) -> Column:
    """Names of a comma or semicolon list: trimmed, none empty, each once in order, letter case kept."""
    parts = F.transform(F.split(F.translate(F.coalesce(value, F.lit("")), ";", ","), ","), strip)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def genre_set(value: Column) -> Column:
    """Lower-case genres of a comma list, each once; null gives the empty set."""
    parts = F.transform(F.split(F.coalesce(value, F.lit("")), ","), lambda x: F.lower(strip(x)))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def join_phrases(items: Column) -> Column:
    """'', 'a', 'a and b' or 'a, b, and c'."""
    return let(
        items,
        lambda x: F.when(F.size(x) <= 2, F.array_join(x, " and ")).otherwise(
            F.concat(F.array_join(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))), ", "), F.lit(", and "), F.try_element_at(x, F.lit(-1)))
        ),
    )


def leading_themes(genres: Column, most: int = 3) -> Column:
    """The first genres of a list, joined by commas."""
    return F.array_join(F.slice(split_list(genres), 1, most), ", ")


def join_names(values: Column) -> Column:
    """', '-joined distinct ``name`` fields of an array of structs, null if there are none."""
    names = F.array_distinct(F.filter(F.transform(values, lambda x: strip(F.coalesce(x["name"].cast("string"), F.lit("")))), lambda x: x != ""))
    return F.when(F.size(names) > 0, F.array_join(names, ", "))


def preferred_title(english: Column, name: Column) -> Column:
    """English title, else name, else 'Unknown'."""
    return F.coalesce(F.nullif(english, F.lit("")), F.nullif(name, F.lit("")), F.lit("Unknown"))


def year_text(year: Column, premiered: Column) -> Column:
    """The year, else the premiere, else nothing."""
    return F.coalesce(year.cast("string"), premiered, F.lit(""))


def join_url(base: str | Column, path: str | Column) -> Column:
    """Base and path with one slash between them."""
    base, path = (F.lit(x) if isinstance(x, str) else x for x in (base, path))
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(path, "^/+", ""))


def any_null(columns: Sequence[Column]) -> Column:
    """1 if any of the columns is null, else 0."""
    found = F.lit(False)
    for column in columns:
        found = found | column.isNull()
    return found.cast("int")
