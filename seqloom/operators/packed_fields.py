"""Several names packed in one text field -> one row per name with its place.

The field is split at quote characters: odd pieces are literals, even pieces
hold separators. An array fold puts the pieces together again with every sign
that belongs to a name replaced by a stand-in, so that one split then gives the
names. Everything is a JVM expression; there is no shuffle and no Python.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators between names, and words that stand for "no value".
SIGNS = ",;|/&、・·，；｜／＆"
WORDS = ("and",)
NO_VALUE = ("", "unknown", "none", "n/a", "nan", "-", "none listed")

#: Signs that can belong to a name, and their stand-ins from the private use area.
_KEPT = SIGNS + "\"'“”\\[]{}"
_STAND_IN = "".join(chr(0xE000 + i) for i in range(len(_KEPT)))
_GLUE = ""  # goes into a word such as "and" that belongs to a name
_MARK = ""  # every quote character, once those inside of names are put aside

_SPLIT = rf"\s*[{re.escape(SIGNS)}]\s*(?:(?:{'|'.join(WORDS)})\s+)?|\s+(?:{'|'.join(WORDS)})\s+"


def _hide(text: Column) -> Column:
    """Put aside everything in a literal that would look like a separator."""
    return F.regexp_replace(F.translate(text, _KEPT, _STAND_IN), rf"(?i)\b({'|'.join(w[0] for w in WORDS)})(?={'|'.join(w[1:] for w in WORDS)}\b)", f"$1{_GLUE}")


def _name_pattern(name: str) -> tuple[str, str]:
    """Regular expression and replacement that put aside the signs of one name; letter case is kept."""
    pattern, replacement, group = "", "", 0
    for piece in re.findall(rf"[{re.escape(_KEPT)}]|\b(?:{'|'.join(WORDS)})\b|(?:(?!\b(?:{'|'.join(WORDS)})\b)[^{re.escape(_KEPT)}])+", name):
        if piece in _KEPT:
            stand_in = _STAND_IN[_KEPT.index(piece)]
            pattern += f"[{re.escape(piece)}{stand_in}]"
            replacement += stand_in
        elif piece in WORDS:
            pattern += f"({re.escape(piece[0])})({re.escape(piece[1:])})"
            replacement += f"${group + 1}{_GLUE}${group + 2}"
            group += 2
        else:
            pattern += f"({re.escape(piece)})"
            replacement += f"${group + 1}"
            group += 1
    return rf"(?iu)(?<![\p{{L}}\p{{N}}]){pattern}(?![\p{{L}}\p{{N}}])", replacement


def split_packed(value: Column, names: Iterable[str] = ()) -> Column:
    """Array of the names packed in ``value``, in order.

    ``names``: full names in which a separator belongs to the name; the longest
    that fits wins. Null, blank and "no value" texts give an empty array, empty
    items take no place, repeated names stay.
    """
    ends = re.escape(SIGNS)
    text = F.trim(F.regexp_replace(value, r"^\s+|\s+$", ""))
    nothing = text.isNull() | F.lower(text).isin(*NO_VALUE)
    # escape marks: the sign behind one belongs to the name
    for sign in _KEPT:
        text = F.replace(text, F.lit("\\" + sign), F.lit(_STAND_IN[_KEPT.index(sign)]))
    special = [n for n in set(names) if any(c in _KEPT for c in n) or re.search(rf"\b(?:{'|'.join(WORDS)})\b", n)]
    for name in sorted(special, key=lambda n: (-len(n), n)):
        pattern, replacement = _name_pattern(name)
        text = F.regexp_replace(text, pattern, replacement)
    text = F.regexp_replace(text, r"^\s*(?:\[(.*)\]|\{(.*)\})\s*$", "$1$2")
    text = F.translate(text, "\"“”", _MARK * 3)
    # single quotes enclose only where an item begins or ends
    text = F.regexp_replace(text, rf"(?<=^\s{{0,9}}|[{ends}]\s{{0,9}})'(?=[^']*'\s*(?:$|[{ends}]))([^']*)'", f"{_MARK}$1{_MARK}")

    def join(pieces: Column) -> Column:
        last = F.size(pieces) - 1

        def fold(done: Column, i: Column) -> Column:
            piece = F.element_at(pieces, i + 1)
            literal = (i % 2 == 1) & (i < last)
            doubled = (i % 2 == 0) & (i > 0) & (i < last) & (piece == "")
            return F.concat(done, F.when(literal, _hide(piece)).when(doubled, F.lit(_STAND_IN[_KEPT.index('"')])).otherwise(piece))

        return F.aggregate(F.sequence(F.lit(0), last), F.lit(""), fold)

    # the lambda binds the pieces, so that the text is worked on once
    joined = F.element_at(F.transform(F.array(F.split(text, _MARK)), join), 1)
    items = F.transform(F.split(joined, f"(?i){_SPLIT}"), lambda x: F.regexp_replace(F.translate(F.replace(x, F.lit(_GLUE), F.lit("")), _STAND_IN, _KEPT), r"^\s+|\s+$", ""))
    # a word separator at the very start or end has no blank on one side
    items = F.filter(items, lambda x: (x != "") & ~F.lower(x).isin(*WORDS))
    return F.when(nothing, F.array().cast("array<string>")).otherwise(items)


def known_names(names: DataFrame, most: int = 100_000) -> dict[str, list[str]]:
    """Full names by field from a table (field_name, full_name) of at most ``most`` rows.

    The names become part of the expression, so the table must be small; a larger
    one is refused rather than cut.
    """
    rows = names.select("field_name", "full_name").where("field_name is not null and full_name is not null").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} names; they are built into the plan")
    found: dict[str, list[str]] = {}
    for row in rows:
        found.setdefault(row[0], []).append(row[1])
    return found


def explode_packed(df: DataFrame, key: str, fields: Iterable[str], names: Mapping[str, Iterable[str]] | None = None) -> DataFrame:
    """Rows (key, field, pos, item): one for each name of each packed field.

    Other columns of ``df`` are not read, so clashing names do no harm. A null key
    stays null; a null field gives no rows; repeated input rows give repeated rows.
    """
    names = names or {}
    packed = F.array(*[F.struct(F.lit(f).alias("field"), split_packed(F.col(f).cast("string"), names.get(f, ())).alias("items")) for f in fields])
    return (
        df.select(F.col(key).alias(key), *[F.col(f) for f in fields])
        .select(key, F.explode(packed).alias("p"))
        .select(key, "p.field", F.posexplode("p.items").alias("pos", "item"))
        .select(key, "field", F.col("pos").cast("long").alias("pos"), "item")
    )
