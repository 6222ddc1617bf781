"""Datasets whose files have come in several generations of one schema.

The schemas of all parts (months, dates, ...) are recorded next to the dataset,
and merge to the one it is read with: columns are added and types widened, both
by Spark's Parquet reader at the scan, so older files are never rewritten. A part
that does not merge is refused before any of it is loaded.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weirflow.commits import CommitLog

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
# Decimal digits that hold every integer of a type, as it is stored in Parquet.
_DIGITS = {T.ByteType(): 10, T.ShortType(): 10, T.IntegerType(): 10, T.LongType(): 20}
_LONGEST_DECIMAL = 38


class IncompatibleSchema(ValueError):
    """Two types that no lossless type holds both of."""


def widen(one: T.DataType, other: T.DataType, name: str = "") -> T.DataType:
    """The narrowest type that holds both without loss and that Parquet files of
    either can be read as. Nested fields are merged one by one."""
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merge_schemas(one, other, prefix=name and f"{name}.")
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(widen(one.elementType, other.elementType, f"{name}[]"))
    if isinstance(one, T.MapType) and isinstance(other, T.MapType):
        return T.MapType(
            widen(one.keyType, other.keyType, f"{name}.key"), widen(one.valueType, other.valueType, f"{name}.value")
        )
    if one == other:
        return one
    for left, right in ((one, other), (other, one)):
        wider = _wider(left, right)
        if wider is not None:
            return wider
    raise IncompatibleSchema(f"{name}: {one.simpleString()} and {other.simpleString()} have no common type")


def _wider(left: T.DataType, right: T.DataType) -> T.DataType | None:
    """The common type, for one order of the two."""
    if left in _INTEGERS and right in _INTEGERS:
        return max(left, right, key=_INTEGERS.index)
    if left in _INTEGERS[:3] and right in (T.FloatType(), T.DoubleType()):
        return T.DoubleType()
    if (left, right) == (T.FloatType(), T.DoubleType()):
        return right
    if (left, right) == (T.DateType(), T.TimestampNTZType()):
        return right
    if left in _DIGITS and isinstance(right, T.DecimalType):
        left = T.DecimalType(_DIGITS[left], 0)
    if isinstance(left, T.DecimalType) and isinstance(right, T.DecimalType):
        scale = max(left.scale, right.scale)
        digits = scale + max(left.precision - left.scale, right.precision - right.scale)
        return T.DecimalType(digits, scale) if digits <= _LONGEST_DECIMAL else None
    return None


def merge_schemas(one: T.StructType, other: T.StructType, prefix: str = "") -> T.StructType:
    """All columns of both, in the order of their first appearance. Names that
    differ in case only are the same column, as for the reader; the first one stays."""
    merged = {f.name.lower(): f for f in one.fields}
    for field in other.fields:
        known = merged.get(field.name.lower())
        if known is None:
            merged[field.name.lower()] = field
        else:
            wide = widen(known.dataType, field.dataType, prefix + known.name)
            merged[field.name.lower()] = T.StructField(known.name, wide)
    return T.StructType([T.StructField(f.name, f.dataType) for f in merged.values()])


class SchemaRecord:
    """Which part of a dataset came with which schema."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._log = CommitLog(spark, path.rstrip("/"))

    def _state(self) -> dict:
        version = self._log.last()
        if not version:
            return {"schema": T.StructType().jsonValue(), "generations": [], "parts": {}}
        return self._log.read(version)

    def parts(self) -> dict[str, T.StructType]:
        """The schema of each part as it came last."""
        state = self._state()
        schemas = [T.StructType.fromJson(g) for g in state["generations"]]
        return {part: schemas[i] for part, i in state["parts"].items()}

    def schema(self) -> T.StructType:
        """What all parts merge to. It never gets narrower, also when a part is
        replaced: files that were written with it stay readable."""
        schema = T.StructType.fromJson(self._state()["schema"])
        if not schema.fields:
            raise ValueError("nothing has been recorded yet")
        return schema

    def add(self, parts: Mapping[str, T.StructType]) -> T.StructType:
        """Record parts that are about to be loaded; returns the merged schema.
        Raises ``IncompatibleSchema``, and then records nothing."""
        before = self._state()
        recorded = T.StructType.fromJson(before["schema"])
        merged = reduce(merge_schemas, [parts[name] for name in sorted(parts)], recorded)
        both = {**self.parts(), **parts}
        # Few generations, many parts.
        generations = sorted({schema.json() for schema in both.values()})
        state = {
            "schema": merged.jsonValue(),
            "generations": [json.loads(g) for g in generations],
            "parts": {name: generations.index(schema.json()) for name, schema in sorted(both.items())},
        }
        if state != before:
            self._log.commit(self._log.last() + 1, state)
        return merged


def read_evolved(spark: SparkSession, path: str, schema: T.StructType, *derived: T.StructField) -> DataFrame:
    """A dataset of several generations in one scan, with the merged schema.
    ``derived`` names partition columns and columns the load has added."""
    return spark.read.schema(T.StructType([*schema.fields, *derived])).parquet(path)
