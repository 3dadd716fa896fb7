"""Tables whose columns change between runs.

New columns are added, vanished ones stay and are NULL from then on, a renamed
one leaves both, and one that changes type takes the narrowest type that holds
old and new values (text when nothing else does).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions.variant import widest


def common_types(*tables: DataFrame) -> dict[str, str]:
    found: dict[str, list[str]] = {}
    for table in tables:
        for column in table.schema.fields:
            found.setdefault(column.name, []).append(column.dataType.simpleString())
    return {name: widest(types) for name, types in found.items()}


FRACTIONS = ("double", "float")
PLAIN = "decimal(38,18)"
USUAL = (0.1, 9_999_999.0)


def as_text(value: Column, type_: str) -> Column:
    """Text of a value, the same whether its column is text from the start or becomes it later.

    Fractions are written out in digits where these say the number exactly, as their JSON text does; others, too large or
    too small for that, keep their exponent.
    """
    if type_ not in FRACTIONS:
        return value.cast("string")
    digits = F.try_cast(value, PLAIN) if hasattr(F, "try_cast") else value.try_cast(PLAIN)
    plain = F.regexp_replace(F.regexp_replace(digits.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    text = F.when(plain.cast("double") == value, plain).otherwise(value.cast("string"))
    if type_ != "double":
        return text
    # most numbers are of a size whose text has no exponent and no more decimals than fit: it only ends in zeros to leave out
    usual = F.abs(value).between(*USUAL)
    short = F.rtrim(F.rtrim(value.cast("string"), F.lit("0")), F.lit("."))
    return F.when(usual, short).otherwise(text)


def widened(column: Column, from_type: str, to_type: str) -> Column:
    return as_text(column, from_type) if to_type == "string" else column.cast(to_type)


def align(*tables: DataFrame) -> list[DataFrame]:
    """The tables with the same columns and types; what one lacks is NULL."""
    types = common_types(*tables)
    return [
        table.select(
            *[
                (
                    widened(F.col(f"`{name}`"), table.schema[name].dataType.simpleString(), type_)
                    if name in table.columns
                    else F.lit(None).cast(type_)
                ).alias(name)
                for name, type_ in types.items()
            ]
        )
        for table in tables
    ]


def union_drift(*tables: DataFrame) -> DataFrame:
    """All rows of all tables under the widened union of their columns."""
    return reduce(DataFrame.unionByName, align(*tables))


def renamed(*names: str) -> Column:
    """Value of a column that was renamed: newest name first."""
    return F.coalesce(*[F.col(name) for name in names])


def added_columns(old: DataFrame | None, new: DataFrame) -> list[str]:
    return [c for c in new.columns if old is None or c not in old.columns]


def changed_columns(old: DataFrame, new: DataFrame) -> list[str]:
    """Columns of both whose type is another one."""
    return [c for c in old.columns if c in new.columns and old.schema[c].dataType != new.schema[c].dataType]
