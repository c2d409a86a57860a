"""Files whose schemas differ, read as one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


class TypeConflict(ValueError):
    """Two types of one column that no wider type holds without loss."""


def wider(a: T.DataType, b: T.DataType, column: str) -> T.DataType:
    """The smallest type that holds the values of both: whole numbers, decimals with room for
    the digits of both, float and double, date and timestamp. A column without values has no say."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in WHOLE and b in WHOLE:
        return max(a, b, key=WHOLE.index)
    parts = [_decimal(x) for x in (a, b)]
    if all(parts):
        scale = max(s for _, s in parts)
        digits = max(p - s for p, s in parts) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    kinds = {type(a), type(b)}
    if kinds == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    small = {T.ByteType, T.ShortType, T.IntegerType}  # a double holds all of their values
    if T.DoubleType in kinds and kinds & small:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    raise TypeConflict(f"column {column}: {a.simpleString()} and {b.simpleString()}")


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    if isinstance(t, T.DecimalType):
        return t.precision, t.scale
    return (DIGITS[t.simpleString()], 0) if t in WHOLE else None


def joined(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns in the order they first come, each as wide as its widest."""
    def both(a: T.StructType, b: T.StructType) -> T.StructType:
        other = {f.name: f.dataType for f in b}
        fields = [T.StructField(f.name, wider(f.dataType, other.get(f.name, f.dataType), f.name)) for f in a]
        known = {f.name for f in a}
        return T.StructType([*fields, *[T.StructField(f.name, f.dataType) for f in b if f.name not in known]])

    return reduce(both, schemas)


def groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], T.StructType]]:
    """``paths`` in groups whose footers agree, and each group's schema.

    Footers are read in parallel by Spark. A group with a conflict is halved, so with few
    conflicting folders there are few jobs; a folder in conflict with itself is cut into files.
    """
    try:
        return [(list(paths), spark.read.option("mergeSchema", "true").parquet(*paths).schema)]
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    if len(paths) == 1:
        files = spark.read.format("binaryFile").load(paths[0]).drop("content").select("path")
        paths = [r.path for r in files.orderBy("path").collect()]  # names of the files of one folder
        if len(paths) == 1:
            raise TypeConflict(f"{paths[0]} cannot be read")
    half = len(paths) // 2
    return groups(spark, paths[:half]) + groups(spark, paths[half:])


def read_reconciled(
    spark: SparkSession, paths: Sequence[str], expected: T.StructType | None = None,
) -> DataFrame:
    """Landed files as one frame: columns by name, missing ones NULL, new ones kept, types widened.

    With ``expected`` its columns come first and keep their types; a file whose type does not fit
    into one of them without loss is refused by the name of the column.
    """
    found = groups(spark, paths)
    whole = joined([*([expected] if expected is not None else []), *[schema for _, schema in found]])
    for f in expected or []:
        if whole[f.name].dataType != f.dataType:
            raise TypeConflict(
                f"column {f.name}: {whole[f.name].dataType.simpleString()} does not fit into "
                f"{f.dataType.simpleString()}")

    def fitted(part: list[str], schema: T.StructType) -> DataFrame:
        has = set(schema.fieldNames())
        return spark.read.schema(schema).parquet(*part).select(*[
            (F.col(f"`{f.name}`") if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in whole])

    return reduce(DataFrame.unionByName, [fitted(*g) for g in found])
