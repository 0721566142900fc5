"""Type inference for text columns as one mergeable aggregate.

For every column a single pass counts how many values fit each type; this evidence
adds up over files and deliveries, so a folder is never read again to learn its
types, and a later delivery can only widen them. The narrowest type that all values
fit is taken: int, bigint, decimal or double; date or timestamp; boolean; string.
A column without values is string.

Values must be written plainly: no surrounding space, no sign but a leading one, ISO
dates (``yyyy-MM-dd``) and timestamps (``yyyy-MM-dd HH:mm:ss`` or with ``T``, up to
six fraction digits). Decimals keep every digit: the widest integral part and the
longest fraction seen; beyond 38 digits, or with an exponent, the type is double.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from strata.operators._util import q, resolve

_INTEGER = r"^[+-]?[0-9]{1,19}$"
_DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
_DOUBLE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
#: Counts of a column, and the digits its decimals need; the former add up, the latter take the most.
SUMS = ("n_values", "n_int", "n_bigint", "n_decimal", "n_double", "n_date", "n_timestamp",
        "n_boolean")
MOSTS = ("int_digits", "fraction_digits")


def _tests(c: Column) -> dict[str, Column]:
    """What is counted, or taken the most of, for one text column.

    Casts run only on texts of the right shape: a failed cast costs an exception.
    """
    whole = F.when(c.rlike(_INTEGER), c)
    plain = F.when(c.rlike(_DECIMAL), F.regexp_replace(c, "^[+-]", ""))
    digits = F.length(F.regexp_replace(F.regexp_replace(plain, r"\..*$", ""), "^0+", ""))
    fraction = F.length(F.regexp_replace(plain, r"^[0-9]*\.?", ""))
    day = F.when(c.rlike(_DATE), c)
    moment = F.when(c.rlike(_TIMESTAMP), c)
    return {
        "n_values": F.count(c),
        "n_int": F.count(whole.try_cast("int")),
        "n_bigint": F.count(whole.try_cast("bigint")),
        "n_decimal": F.count(plain),
        "n_double": F.count_if(c.rlike(_DOUBLE)),
        "n_date": F.count(day.try_cast("date")),
        "n_timestamp": F.count(F.coalesce(moment, day).try_cast("timestamp_ntz")),
        "n_boolean": F.count_if(F.lower(c).isin("true", "false")),
        "int_digits": F.coalesce(F.max(digits), F.lit(0)),
        "fraction_digits": F.coalesce(F.max(fraction), F.lit(0)),
    }


def type_evidence(df: DataFrame, columns=None) -> DataFrame:
    """(column_name, the counts, the digits): a row per text column, from one pass over ``df``."""
    names = resolve(df, columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not names:
        raise ValueError("no text columns")
    none = df.sparkSession.createDataFrame(
        [(n, *[0] * len(SUMS + MOSTS)) for n in names],
        "column_name string, " + ", ".join(f"{k} bigint" for k in SUMS + MOSTS))
    # a row per partition, so that what is brought together is as long as there are columns
    parts = df.groupBy(F.spark_partition_id().alias("__part")).agg(
        *[F.struct(*[x.cast("bigint").alias(k) for k, x in _tests(q(n)).items()]).alias(f"__c{i}")
          for i, n in enumerate(names)])
    each = parts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("column_name"),
                 *[F.col(f"__c{i}")[k].alias(k) for k in SUMS + MOSTS])
        for i, n in enumerate(names)])))
    return _together(each.unionByName(none), F.col("column_name"))


def _together(evidence: DataFrame, name: Column) -> DataFrame:
    return evidence.groupBy(name.alias("column_name")).agg(
        *[F.sum(k).alias(k) for k in SUMS], *[F.max(k).alias(k) for k in MOSTS])


def merge_evidence(*parts: DataFrame) -> DataFrame:
    """The evidence of several files or deliveries together, by column name in any case."""
    return _together(reduce(DataFrame.unionByName, parts), F.upper("column_name"))


def narrowest() -> Column:
    """The name of the narrowest type that all values of a column fit, from its evidence."""
    def all_fit(k):
        return F.col(k) == F.col("n_values")
    precision = F.greatest(F.col("int_digits") + F.col("fraction_digits"), F.lit(1))
    exact = F.concat(F.lit("decimal("), precision.cast("string"), F.lit(","),
                     F.col("fraction_digits").cast("string"), F.lit(")"))
    return (F.when(F.col("n_values") == 0, "string")
            .when(all_fit("n_int"), "int")
            .when(all_fit("n_bigint"), "bigint")
            .when(all_fit("n_decimal") & (precision <= 38), exact)
            .when(all_fit("n_double"), "double")
            .when(all_fit("n_date"), "date")
            .when(all_fit("n_timestamp"), "timestamp_ntz")
            .when(all_fit("n_boolean"), "boolean")
            .otherwise("string"))


_TYPES: dict[str, DataType] = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(),
                               "date": DateType(), "timestamp_ntz": TimestampNTZType(),
                               "boolean": BooleanType(), "string": StringType()}


def inferred_schema(evidence: DataFrame) -> StructType:
    """The schema that the evidence supports: one row per column reaches the driver."""
    fields = []
    for r in evidence.select("column_name", narrowest().alias("t")).collect():
        kind = _TYPES.get(r["t"])
        if kind is None:
            kind = DecimalType(*map(int, r["t"][len("decimal("):-1].split(",")))
        fields.append(StructField(r["column_name"], kind))
    return StructType(fields)


def cast_to_evidence(df: DataFrame, evidence: DataFrame) -> DataFrame:
    """``df`` with every column that the evidence knows cast to its type; others as they are."""
    kinds = {f.name.upper(): f.dataType for f in inferred_schema(evidence).fields}
    return df.select([q(c).cast(kinds[c.upper()]).alias(c) if c.upper() in kinds else q(c)
                      for c in df.columns])
