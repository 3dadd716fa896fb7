"""Column expressions over VARIANT records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    LongType,
    NullType,
    StringType,
    StructType,
    VariantType,
    _parse_datatype_string,
)

Keys = tuple[str, ...]

VOID = "void"
VARIANT = "variant"
EXACT_INTEGER = "decimal(38,0)"
OBJECT = "map<string,variant>"
LIST = "array<variant>"
ANY_OBJECT = "struct<>"  # none of its values is copied


def _step(key: str) -> str | None:
    if "'" not in key:
        return f"['{key}']"
    if '"' not in key:
        return f'["{key}"]'
    return None  # no path syntax can name a key holding both quotes


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def pick(v: Column, keys: Sequence[str], as_type: str = "variant", strict: bool = True) -> Column:
    """Value at ``keys`` as ``as_type``; NULL when the key is absent.

    ``strict`` fails on a value of another type; otherwise that gives NULL.
    """
    if not keys and as_type == "variant":
        return v
    path = "$"
    for key in keys:
        step = _step(key)
        if step is None:
            v = F.element_at(F.try_variant_get(v, path, OBJECT), F.lit(key))
            path = "$"
        else:
            path += step
    get = F.variant_get if strict else F.try_variant_get
    return get(v, path, as_type)


def as_object(v: Column, keys: Sequence[str] = ()) -> Column:
    return pick(v, keys, OBJECT, strict=False)


def as_list(v: Column, keys: Sequence[str] = ()) -> Column:
    return pick(v, keys, LIST, strict=False)


def is_object(v: Column, keys: Sequence[str] = ()) -> Column:
    return pick(v, keys, ANY_OBJECT, strict=False).isNotNull()


def is_list(v: Column, keys: Sequence[str] = ()) -> Column:
    return as_list(v, keys).isNotNull()


def is_present(v: Column, keys: Sequence[str]) -> Column:
    """True for an existing key, also when its value is an explicit null."""
    return pick(v, keys).isNotNull()


def is_explicit_null(v: Column, keys: Sequence[str] = ()) -> Column:
    return F.coalesce(F.is_variant_null(pick(v, keys)), F.lit(False))


def is_empty_object(v: Column, keys: Sequence[str] = ()) -> Column:
    return F.coalesce(F.size(as_object(v, keys)) == 0, F.lit(False))


def is_wrapper(v: Column, keys: Sequence[str] = ()) -> Column:
    """True for an object whose one and only key is ``value``."""
    obj = as_object(v, keys)
    return F.coalesce((F.size(obj) == 1) & F.map_contains_key(obj, "value"), F.lit(False))


def parse_schema(text: str) -> DataType:
    """Spark type for the text that ``schema_of_variant[_agg]`` returns."""
    parts = text.split("`")  # odd parts are quoted names
    parts[::2] = [part.replace("OBJECT<", "STRUCT<") for part in parts[::2]]
    return _parse_datatype_string("`".join(parts))


def leaf_type(found: DataType) -> str:
    """Column type for a value whose merged VARIANT type is ``found``.

    Fractions become double, integers stay exact, nested or mixed values
    are kept whole as text.
    """
    if isinstance(found, NullType):
        return VOID
    if isinstance(found, DecimalType):
        # A whole number beyond bigint has 19 digits or more; a shorter one of
        # scale 0 was written with a fraction part, such as 23.0.
        return EXACT_INTEGER if found.scale == 0 and found.precision >= 19 else "double"
    if isinstance(found, (DoubleType, FloatType)):
        return "double"
    if isinstance(found, (StructType, ArrayType, VariantType, StringType)):
        return "string"
    if isinstance(found, (LongType, BooleanType)):
        return found.simpleString()
    return found.simpleString()  # dates, timestamps and binary in binary-built VARIANTs


INTEGERS = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, EXACT_INTEGER: 4}
FRACTIONS = {"float", "double"}


def _plain_number(kind: str) -> str:
    if not kind.startswith("decimal("):
        return kind
    return EXACT_INTEGER if kind.endswith(",0)") else "double"


def widest(types: Sequence[str]) -> str:
    """Smallest type every one of ``types`` fits in; text when nothing else does."""
    kinds = set(types) - {VOID}
    if not kinds:
        return VOID
    if len(kinds) == 1:
        return kinds.pop()
    kinds = {_plain_number(kind) for kind in kinds}
    if kinds <= set(INTEGERS):
        return max(kinds, key=INTEGERS.__getitem__)
    if kinds <= set(INTEGERS) | FRACTIONS:
        return "double"
    return "string"
