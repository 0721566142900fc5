"""Casting text by a type name taken from column metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata.functions._cols import as_col
from strata.functions.dates import parse_date_ladder, parse_zoned_timestamp


# Type names of the integral types, and the text an integral
# try_cast can accept (optional control/space padding, a sign, ASCII digits).
INTEGRAL_TYPES = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")
INTEGRAL_TEXT = r"^[\x00-\x20\x7f-\x9f]*[+-]?[0-9]+[\x00-\x20\x7f-\x9f]*$"
# The words a boolean cast accepts (any case, padded or not).
BOOLEAN_TEXT = r"(?i)^[\x00-\x20\x7f-\x9f]*(t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7f-\x9f]*$"


def try_cast_by_type(c, type_name: str | DataType, text_input: bool = True) -> Column:
    """``try_cast``: NULL instead of an error for text that does not fit.

    A failed try_cast costs an exception inside Spark. For text input the
    cast is therefore skipped where it cannot succeed: integral types need
    :data:`INTEGRAL_TEXT`, booleans :data:`BOOLEAN_TEXT`, decimals at least
    one digit. Every text the cast accepts passes these tests, so results are
    unchanged.
    """
    c = as_col(c)
    if not text_input or not isinstance(type_name, str):
        return c.try_cast(type_name)
    kind = type_name.strip().lower()
    if kind in INTEGRAL_TYPES:
        return F.when(c.rlike(INTEGRAL_TEXT), c.try_cast(type_name))
    if kind in ("boolean", "bool"):
        return F.when(c.rlike(BOOLEAN_TEXT), c.try_cast(type_name))
    if kind.startswith(("decimal", "numeric", "dec(")):
        return F.when(c.rlike("[0-9]"), c.try_cast(type_name))
    return c.try_cast(type_name)


def cast_by_type_name(c, type_name: str, text_input: bool = True) -> Column:
    """The three metadata cast rules for text: ``date`` -> date ladder;
    ``timestamp`` / ``timestamp_ntz`` -> zoned timestamp parse; anything else
    -> try_cast. Input that is typed already is only cast."""
    kind = type_name.strip().lower()
    if not text_input:      # already typed: the text rules do not apply
        return as_col(c).try_cast(type_name.strip())
    if kind == "date":
        return parse_date_ladder(c)
    if kind in ("timestamp", "timestamp_ntz"):
        return parse_zoned_timestamp(c, ntz=(kind == "timestamp_ntz"))
    return try_cast_by_type(c, type_name.strip(), text_input)


def cast_to(c, data_type: DataType | str, on_error: str = "fail") -> Column:
    """Typed cast to a schema field: ``fail`` raises on bad input under ANSI,
    ``null`` gives NULL."""
    if on_error == "null":
        return as_col(c).try_cast(data_type)
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    return as_col(c).cast(data_type)
