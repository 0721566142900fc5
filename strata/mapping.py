"""Column metadata for one object, fetched in a single bounded collect.

The mapping table has one row per column (``SOURCE_NAME, OBJECT_NAME,
SOURCE_COLUMN_NAME, TARGET_COLUMN_NAME, COLUMN_DATATYPE, VALUES``). Its size is
the number of mapped columns, so collecting one object's rows is bounded by
the schema width, never by data volume.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import COLUMN_MAPPING


@dataclass(frozen=True)
class ColumnMapping:
    object_name: str
    renames: dict[str, str] = field(default_factory=dict)      # source -> target
    defaults: dict[str, str] = field(default_factory=dict)     # target -> default text
    types: dict[str, str] = field(default_factory=dict)        # target -> type name

    @property
    def target_columns(self) -> list[str]:
        return sorted(set(self.renames.values()) | set(self.types))

    @classmethod
    def from_frame(cls, mapping: DataFrame, object_name: str,
                   source_name: str | None = None) -> "ColumnMapping":
        cond = F.col("OBJECT_NAME") == F.lit(object_name)
        if source_name is not None:
            cond = cond & (F.lower(F.col("SOURCE_NAME")) == F.lower(F.lit(source_name)))
        rows = (mapping.filter(cond)
                .select("SOURCE_COLUMN_NAME", "TARGET_COLUMN_NAME", "COLUMN_DATATYPE", "VALUES")
                .distinct().collect())
        if not rows:
            raise ValueError(f"no column mapping found for {object_name}")
        for name in ("SOURCE_COLUMN_NAME", "TARGET_COLUMN_NAME"):
            seen = [r[name].lower() for r in rows if r[name] is not None]
            twice = sorted({c for c in seen if seen.count(c) > 1})
            if twice:
                raise ValueError(f"{object_name}: {name} mapped more than once: {twice}; "
                                 "name the source system if several have this object")
        renames, defaults, types = {}, {}, {}
        for r in rows:
            if r["SOURCE_COLUMN_NAME"] is not None and r["TARGET_COLUMN_NAME"] is not None:
                renames[r["SOURCE_COLUMN_NAME"]] = r["TARGET_COLUMN_NAME"]
            if r["TARGET_COLUMN_NAME"] is None:
                continue
            if r["VALUES"] is not None:
                defaults[r["TARGET_COLUMN_NAME"]] = r["VALUES"]
            if r["COLUMN_DATATYPE"] is not None:
                types[r["TARGET_COLUMN_NAME"]] = r["COLUMN_DATATYPE"]
        return cls(object_name, renames, defaults, types)


def mapping_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """A mapping table from literal rows (fixtures and examples)."""
    return spark.createDataFrame(rows, COLUMN_MAPPING)
