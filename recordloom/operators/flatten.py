"""Nested VARIANT records to flat, typed rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.functions import variant as V
from recordloom.functions.naming import labels
from recordloom.operators.access import Access, Wants, Whole
from recordloom.operators.catalogue import (
    WRAPPED,
    WRAPPER_KEY,
    Catalogue,
    Merged,
    Reading,
    discover,
    reachable,
    stage_records,
)


@dataclass(frozen=True)
class Default:
    """Value of a column for records that do not have it."""

    column: str
    type: str


@dataclass(frozen=True)
class FlatColumn:
    """One column of a table and everything needed to read it."""

    label: str
    type: str
    name: str
    readings: list[Reading]
    default: Default | None = None

    @property
    def chooses(self) -> bool:
        """Some record decides between several values, so presence matters."""
        return len(self.readings) + (self.default is not None) > 1

    def want(self, wants: Wants) -> None:
        for reading in self.readings:
            wants.whole.update(reading.above.looks_at(reading.path))
            if self.chooses or (not reading.settled and reading.type != V.VOID):
                wants.whole.add(reading.path)
            elif reading.type != V.VOID:
                wants.leaves[reading.value_path] = self.type

    def expression(self, record: Access, dialect: str) -> Column:
        result = F.col(self.default.column).cast(self.type) if self.default else None
        for reading in self.readings:  # the last one that a record has wins
            value = _value(record, reading, self.type)
            if result is None:
                result = value
            else:
                result = F.when(_has(record, reading, dialect), value).otherwise(result)
        result = F.lit(None).cast(self.type) if result is None else result
        return result.alias(self.label)


def flat_columns(
    catalogue: Catalogue,
    snake: bool = False,
    defaults: dict[str, Default] | None = None,
    fixed: list[str] | None = None,
    known: dict[str, str] | None = None,
) -> list[FlatColumn]:
    """The columns of ``catalogue``.

    ``defaults`` fill a column only in records lacking it; an explicit null is
    a value. ``fixed`` names the exact columns wanted, present or not. ``known`` are the
    labels names got before.
    """
    readings = catalogue.columns()
    defaults = defaults or {}
    names = fixed if fixed is not None else [*readings, *(d for d in defaults if d not in readings)]
    columns = []
    for name, label in labels(names, snake, known).items():
        found, default = readings.get(name, []), defaults.get(name)
        type_ = V.widest([r.type for r in found] + ([default.type] if default else []))
        columns.append(FlatColumn(label, "string" if type_ == V.VOID else type_, name, found, default))
    return columns


def flatten(
    records: DataFrame,
    v: str = "v",
    dialect: str = WRAPPED,
    snake: bool = False,
    keeps=None,
    fixed: list[str] | None = None,
    carry: list[str] | None = None,
    merged: Merged | None = None,
) -> DataFrame:
    """Catalogue the records, then select their columns (and those in ``carry``)."""
    record = Whole(F.col(v))
    known = {"seed": merged.schema, "nulls": merged.nulls} if merged else {}
    catalogue = discover(lambda wants: (records, record), dialect, keeps=keeps, **known)
    columns = flat_columns(catalogue, snake, fixed=fixed)
    return records.select(*(carry or []), *[c.expression(record, dialect) for c in columns])


def flatten_once(records: DataFrame, label: str, **options) -> DataFrame:
    """Flatten records that are costly to produce: they are staged, so made only once."""
    staged, merged = stage_records(records, label)
    return flatten(staged, merged=merged, **options)


def _value(record: Access, reading: Reading, target: str) -> Column:
    if reading.type == V.VOID:
        return F.lit(None).cast(target)
    if reading.settled:
        value = record.leaf(reading.value_path, target)
    else:
        v, keys = record.variant(reading.path)
        value = F.lit(None).cast(target)
        if reading.scalar:
            nested = V.is_object(v, keys) | V.is_list(v, keys)
            value = F.when(~nested, V.pick(v, keys, target, strict=False))
        if reading.wrapper:
            wrapped = V.pick(v, (*keys, WRAPPER_KEY), target, strict=False)
            value = F.when(V.is_wrapper(v, keys), wrapped).otherwise(value)
    if reading.guards():
        value = F.when(reachable(record, reading.path, reading.above), value)
    return value


def _has(record: Access, reading: Reading, dialect: str) -> Column:
    """True in records that have the column, be it with a null."""
    v, keys = record.variant(reading.path)
    present = V.is_present(v, keys)
    if not reading.settled:
        own = V.is_empty_object(v, keys)
        if dialect == WRAPPED:
            own = own | V.is_wrapper(v, keys)
        nested = V.is_object(v, keys) & ~own
        present = present & ~nested & ~V.is_list(v, keys)
    if reading.guards():
        present = present & reachable(record, reading.path, reading.above)
    return present
