"""Text to number and back; bad input becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.text import before, clean_text

# The cast to double also takes words such as Infinity and suffixes such as 1d; numbers here have neither.
_LETTERS = "[a-df-zA-DF-Z]"


def _exact(c: Column) -> Column:
    return c.try_cast("decimal(38,10)")


def _plain_digits(c: Column) -> Column:
    """The short way for text that is just a whole number."""
    return c.cast("string").try_cast("bigint").cast("string")


def _en_us(c: Column) -> Column:
    """Comma as thousands mark."""
    return F.replace(clean_text(c), F.lit(","), F.lit(""))


def to_int64(c: Column) -> Column:
    """``1,234`` -> 1234; a fraction rounds half to even.  Plain digits take the short way."""
    return F.coalesce(c.cast("string").try_cast("bigint"), F.bround(_exact(_en_us(c)), 0).try_cast("bigint"))


def to_decimal(c: Column, scale: int = 2) -> Column:
    return _exact(_en_us(c)).try_cast(f"decimal(18,{scale})")


def product_code(c: Column) -> Column:
    """Product code as a number; whatever follows a point is cut."""
    return to_int64(before(clean_text(c), "."))


def product_code_text(c: Column) -> Column:
    """Product code as stable text: whole numbers lose ``.0``, the rest is kept."""
    text = F.regexp_replace(clean_text(c), r"\.0$", "")
    number = _exact(text)
    whole = number == F.floor(number)
    slow = F.when(whole, number.try_cast("decimal(38,0)").cast("string")).otherwise(text)
    return F.coalesce(_plain_digits(c), _plain_digits(text), slow)


def comma_decimal(c: Column) -> Column:
    """Comma as decimal mark: ``1,5`` -> 1.5."""
    text = clean_text(F.replace(c.cast("string"), F.lit(","), F.lit(".")))
    return F.when(~text.rlike(_LETTERS), text).try_cast("double")


def id_text(c: Column) -> Column:
    """Whole-number id as text; anything fractional or unreadable is null."""
    number = _exact(clean_text(c))
    whole = number == F.floor(number)
    return F.coalesce(_plain_digits(c), F.when(whole, number.try_cast("decimal(38,0)").cast("string")))


def half_up(c: Column, digits: int = 4) -> Column:
    return F.round(c.cast("decimal(38,10)"), digits).cast(f"decimal(18,{digits})")


def safe_divide(a: Column, b: Column) -> Column:
    """Null when the divisor is zero or null."""
    return F.try_divide(a, b)


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def growth(current: Column, prior: Column) -> Column:
    """Difference where a blank counts as zero, unless both are blank."""
    zero = F.lit(0)
    return F.when(current.isNull() & prior.isNull(), F.lit(None)).otherwise(
        F.coalesce(current, zero) - F.coalesce(prior, zero)
    )
