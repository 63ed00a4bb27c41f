"""Text cleaning."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every white-space character, so that trimming needs no regular expression.
_SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_ANY_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in _SPACES) + "]+"
#: Parts the entries of the table of plain forms; it is no character, so no entry holds it.
_PARTING = "\uffff"


def _plain_forms() -> str:
    """For each code point below U+FFFF its compatibility decomposition in lower case, without combining marks."""

    def plain(code: int) -> str:
        if 0xD800 <= code < 0xE000:  # halves of a surrogate pair never stand alone
            return ""
        parts = unicodedata.normalize("NFKD", chr(code).lower())
        return "".join(p for p in parts if not unicodedata.combining(p))

    return _PARTING.join(map(plain, range(0xFFFF)))


_PLAIN = _plain_forms()


def clean_text(c: Column) -> Column:
    """Trim every kind of white space at both ends; null stays null."""
    return F.btrim(c.cast("string"), F.lit(_SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(clean_text(c), F.lit(""))


def has_text(c: Column) -> Column:
    return c.isNotNull() & (clean_text(c) != "")


def plain_form(c: Column) -> Column:
    """Compatibility decomposition (NFKD) without combining marks, by native expressions.

    Ligatures, fractions, full-width and circled forms become the characters
    they stand for.  Text in ASCII is left as it is; in other text each
    character is looked up by its code point in a constant array.  Characters
    beyond the Basic Multilingual Plane stay.
    """
    table = F.split(F.lit(_PLAIN), _PARTING)
    letters = F.transform(F.split(c, ""), lambda x: F.when(F.ascii(x) < 0xFFFF, F.get(table, F.ascii(x))).otherwise(x))
    return F.when(F.octet_length(c) == F.char_length(c), c).otherwise(F.array_join(letters, ""))


def match_key(c: Column) -> Column:
    """Lower-case, accent-free, single-spaced form used to match place names."""
    bare = plain_form(F.lower(clean_text(c)))
    return F.btrim(F.regexp_replace(bare, _ANY_SPACE, " "))


def before(c: Column, delimiter: str) -> Column:
    """Text before the first delimiter, or all of it when there is none."""
    return F.when(F.contains(c, F.lit(delimiter)), F.substring_index(c, delimiter, 1)).otherwise(c)


def part(c: Column, delimiter: str, index: int) -> Column:
    """The ``index``-th piece of a split, null when there are fewer pieces."""
    return F.get(F.split(c, f"\\Q{delimiter}\\E"), F.lit(index))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def zero_padded(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")
