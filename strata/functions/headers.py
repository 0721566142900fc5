"""Header normalisation for landing files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Fixed value: every run of characters outside this class becomes one "_".
_NOT_ALNUM = re.compile(r"[^a-zA-Z0-9]+")


def normalize_name(name: str) -> str:
    """``Order Key ($)`` -> ``ORDER_KEY``: runs of non-alphanumerics become
    ``_``, outer ``_`` are stripped, the result is upper case."""
    return _NOT_ALNUM.sub("_", name).strip("_").upper()


def normalize_headers(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalize_name` in one positional step.

    Two headers that normalise to the same name would make the frame
    ambiguous later; that is reported here with both original names.
    """
    new_names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, new_names):
        if not new:
            raise ValueError(f"header {old!r} normalises to an empty name")
        if new in seen:
            raise ValueError(
                f"headers {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*new_names)
