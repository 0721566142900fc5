"""Column-level functions (all built-in Spark expressions, no UDFs)."""

from strata.functions.casts import cast_by_type_name, cast_to, try_cast_by_type
from strata.functions.dates import parse_date_ladder, parse_zoned_timestamp
from strata.functions.headers import normalize_headers, normalize_name

__all__ = [
    "cast_by_type_name", "cast_to", "try_cast_by_type", "parse_date_ladder",
    "parse_zoned_timestamp", "normalize_headers", "normalize_name",
]
