"""Date and timestamp parsing rules used when casting text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions._cols import as_col

# Date formats tried in this order, first match wins; then the
# ISO form with any time part cut at "T".
DATE_FORMATS = ("M/d/yyyy", "MM-dd-yyyy", "yyyy-MM-dd")
TIME_PART = "T.*"
ISO_DATE = "yyyy-MM-dd"

# Zoned timestamp text, with an optional "[Zone/Name]" suffix
# that is removed before parsing.
ZONED_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSXXX"
ZONE_NAME_SUFFIX = r"\[.*?\]"


def _has(c: Column, ch: str) -> Column:
    return F.instr(c, ch) > 0


def parse_date_ladder(c) -> Column:
    """Text to DATE by the format ladder; NULL when no format matches.

    A failed ``try_to_date`` is costly (the parser fails by exception), and
    most values fail one or more formats before one fits. Each attempt is
    therefore guarded by a cheap test that every text the format can parse
    passes, so results equal the unguarded ladder:

    * ``M/d/yyyy`` needs a ``/``;
    * ``MM-dd-yyyy`` has a fixed two-digit month, so ``-`` is the third char;
    * ``yyyy-MM-dd`` needs a ``-`` and has no letter ``T``;
    * the cut at ``T`` changes the text only when it holds a ``T``; without
      one the fourth attempt would repeat the third.
    """
    c = as_col(c)
    guards = [_has(c, "/"), F.substring(c, 3, 1) == "-",
              _has(c, "-") & ~_has(F.upper(c), "T")]
    tries = [F.when(g, F.try_to_date(c, fmt)) for g, fmt in zip(guards, DATE_FORMATS)]
    tries.append(F.when(_has(c, "T"),
                        F.try_to_date(F.regexp_replace(c, TIME_PART, ""), ISO_DATE)))
    return F.coalesce(*tries)


def parse_zoned_timestamp(c, ntz: bool = False) -> Column:
    """Text like ``2024-03-04T10:00:00.00-05:00[America/New_York]`` to a
    TIMESTAMP (the instant); NULL instead of an error on bad text. With
    ``ntz`` the result is that instant's UTC wall time as TIMESTAMP_NTZ,
    whatever the session time zone."""
    c = as_col(c)
    # the format holds the literals T and :, so text without them cannot parse
    parsed = F.when(_has(c, "T") & _has(c, ":"), F.try_to_timestamp(
        F.regexp_replace(c, ZONE_NAME_SUFFIX, ""), F.lit(ZONED_TIMESTAMP_FORMAT)))
    if not ntz:
        return parsed
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), parsed.cast("timestamp_ntz"))
