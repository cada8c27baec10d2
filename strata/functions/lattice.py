"""The type lattice: the narrowest type that holds the values of two types.

Whole numbers widen by size and into decimals and doubles that hold them exactly,
decimals by digits on both sides of the point, structs field by field (matched by
name, order of first appearance), arrays and maps by their elements. Types with
nothing else in common meet in text, where every value has a form. ``void`` (only
NULLs seen) gives way to any type. The operation is commutative up to the order of
struct fields, associative and idempotent, so partial results merge in any order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql.types import (ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, MapType, NullType, ShortType, StringType,
                               StructField, StructType)

# Whole-number types with their digits, in order of size.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
#: Digits that a floating type holds exactly.
_EXACT_DIGITS = {FloatType: 7, DoubleType: 15}
_MOST_DIGITS = 38


def _digits(t: DataType) -> tuple[int, int] | None:
    """(digits before the point, after it) of whole numbers and decimals."""
    if isinstance(t, DecimalType):
        return t.precision - t.scale, t.scale
    return (_WHOLE[type(t)], 0) if type(t) in _WHOLE else None


def _numbers(a: DataType, b: DataType) -> DataType | None:
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return a if _WHOLE[type(a)] >= _WHOLE[type(b)] else b
    if type(a) in _EXACT_DIGITS and type(b) in _EXACT_DIGITS:
        return DoubleType()
    da, db = _digits(a), _digits(b)
    if da and db:
        before, after = max(da[0], db[0]), max(da[1], db[1])
        return DecimalType(before + after, after) if before + after <= _MOST_DIGITS else None
    floating, digits = (a, db) if type(a) in _EXACT_DIGITS else (b, da)
    if type(floating) in _EXACT_DIGITS and digits and digits[1] == 0:
        # inferred JSON numbers: whole ones and others make doubles, as Spark's inference does
        return DoubleType()
    return None


def widest(a: DataType, b: DataType) -> DataType:
    """The least type of the lattice above both."""
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widest(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(widest(a.keyType, b.keyType), widest(a.valueType, b.valueType),
                       a.valueContainsNull or b.valueContainsNull)
    return _numbers(a, b) or StringType()


def merge_schemas(*schemas: StructType) -> StructType:
    """Union of the fields of all schemas, each with its widest type."""
    def two(a: StructType, b: StructType) -> StructType:
        types = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            types[f.name] = widest(types[f.name], f.dataType) if f.name in types else f.dataType
        return StructType([StructField(n, t) for n, t in types.items()])

    return reduce(two, schemas, StructType([]))


def without_void(t: DataType) -> DataType:
    """Types a reader can bind: keys that only ever were NULL become text."""
    if isinstance(t, NullType):
        return StringType()
    if isinstance(t, StructType):
        return StructType([StructField(f.name, without_void(f.dataType)) for f in t.fields])
    if isinstance(t, ArrayType):
        return ArrayType(without_void(t.elementType), t.containsNull)
    if isinstance(t, MapType):
        return MapType(t.keyType, without_void(t.valueType), t.valueContainsNull)
    return t


def keeps_values(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` stays the same value (or its text) in ``new``."""
    if old == new or isinstance(old, NullType):
        return True
    if isinstance(new, StringType):
        return not isinstance(old, (StructType, ArrayType, MapType))
    if type(old) in _WHOLE and type(new) in _EXACT_DIGITS:
        return _WHOLE[type(old)] <= _EXACT_DIGITS[type(new)]
    if isinstance(old, (StructType, ArrayType, MapType)) or isinstance(old, DecimalType) and (
            type(new) in _EXACT_DIGITS):
        return False
    return _numbers(old, new) == new
