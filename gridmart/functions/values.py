"""Text to value, and the production type code list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.schemas import PRODUCTION_TYPES, UNKNOWN_TYPE

# Spellings a cast reads although they are no decimal numbers: 1d, 2f, 0x1p3.
_NOT_DECIMAL = r"[dDxX]|[0-9.][fF]"
_GROUPING = r"(?<=[0-9])_(?=[0-9])"


def present(text: Column) -> Column:
    """True unless the text is missing or empty."""
    return text.isNotNull() & (text != "")


def to_int(text: Column, strict: bool = True) -> Column:
    """Whole number; other text raises, or gives null if not ``strict``."""
    value = _ungrouped(text).try_cast("int")
    return or_raise(value, text, "not a valid int: ") if strict else value


def to_double(text: Column, strict: bool = True) -> Column:
    """Decimal number, by the same rule; ``nan`` reads as a missing measure."""
    value = _decimal(text)
    number = or_raise(value, text, "not a valid double: ") if strict else value
    return F.when(~F.isnan(number), number)


def is_number(text: Column) -> Column:
    """Whether ``to_double`` can read the text."""
    return _decimal(text).isNotNull()


def _ungrouped(text: Column) -> Column:
    """The text without underscores between digits."""
    bare = F.regexp_replace(text, _GROUPING, "")
    return F.when(text.contains("_"), bare).otherwise(text)


def _decimal(text: Column) -> Column:
    return F.when(~text.rlike(_NOT_DECIMAL), _ungrouped(text).try_cast("double"))


def or_raise(value: Column, text: Column, message: str) -> Column:
    """``value``, but raise if there is a text and no value came of it."""
    error = F.raise_error(F.concat(F.lit(message), text))
    return F.coalesce(value, F.when(text.isNotNull(), error))


def production_type(code: Column) -> Column:
    """Name of a production type code; unmapped and missing codes are Unknown."""
    entries = [F.lit(text) for pair in PRODUCTION_TYPES.items() for text in pair]
    return F.coalesce(F.element_at(F.create_map(*entries), code), F.lit(UNKNOWN_TYPE))
