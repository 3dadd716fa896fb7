"""How a column expression gets at the paths of a record.

A record is either ``Whole``, one VARIANT, or ``Typed``: read as a struct that
holds just the wanted paths, most of them with their final type. Reading a list
as an array of such structs lets Spark take the columns from shredded Parquet
and never build the elements as VARIANTs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column

from recordloom.functions import variant as V
from recordloom.functions.variant import Keys


class Whole:
    def __init__(self, v: Column):
        self.v = v

    def leaf(self, path: Keys, as_type: str) -> Column:
        return V.pick(self.v, path, as_type)

    def variant(self, path: Keys) -> tuple[Column, Keys]:
        """A VARIANT and the keys that lead from it to ``path``."""
        return self.v, path

    def exists(self) -> Column:
        """True where there is a record at all."""
        return ~V.is_explicit_null(self.v)


@dataclass
class Wants:
    """Paths to read with a type, and paths whose value is needed as it is."""

    leaves: dict[Keys, str] = field(default_factory=dict)
    whole: set[Keys] = field(default_factory=set)

    def covering(self, path: Keys) -> Keys | None:
        """The shortest path taken whole that leads to ``path``."""
        starts = (path[:n] for n in range(1, len(path) + 1))
        return next((start for start in starts if start in self.whole), None)

    def tree(self) -> dict:
        tree: dict = {}
        taken = {p: V.VARIANT for p in self.whole if self.covering(p) == p}
        taken.update({p: t for p, t in self.leaves.items() if self.covering(p) is None})
        for path, type_ in taken.items():
            level = tree
            for key in path[:-1]:
                level = level.setdefault(key, {})
            level[path[-1]] = type_
        return tree


class Typed:
    def __init__(self, row: Column, wants: Wants):
        self.row = row
        self.wants = wants

    def leaf(self, path: Keys, as_type: str) -> Column:
        if self.wants.covering(path):
            return V.pick(*self.variant(path), as_type)
        return self._field(path)

    def variant(self, path: Keys) -> tuple[Column, Keys]:
        start = self.wants.covering(path)
        return self._field(start), path[len(start) :]

    def exists(self) -> Column:
        return self.row.isNotNull()

    def _field(self, path: Keys) -> Column:
        column = self.row
        for key in path:
            column = column.getField(key)
        return column


Access = Whole | Typed


def struct_type(tree: dict) -> str | None:
    """DDL of a struct; None if two of its names differ by case only."""
    if len({name.lower() for name in tree}) < len(tree):
        return None
    parts = []
    for name, inner in tree.items():
        type_ = struct_type(inner) if isinstance(inner, dict) else inner
        if type_ is None:
            return None
        parts.append(f"{V.quoted(name)}:{type_}")
    return f"struct<{','.join(parts)}>"
