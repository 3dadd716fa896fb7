"""Declared entities: which collection is read into which tables.

An ``Entity`` names its parent table and collection, the lists that become child
tables, and what its request asks for (inline objects, custom fields, or an
explicit field list). Adding an entity is adding one declaration.
"""

from __future__ import annotations

from dataclasses import dataclass

from recordloom.functions.variant import Keys

KEY = ("id",)


@dataclass(frozen=True)
class Collection:
    """A list inside each record; ``id_as`` is what its own children call its id."""

    key: str
    table: str
    children: tuple[Collection, ...] = ()
    id_as: str = "operation_id"

    def tables(self) -> list[str]:
        return [self.table, *(t for c in self.children for t in c.tables())]

    def paths(self, above: str = "") -> list[str]:
        own = f"{above}{self.key}"
        return [own, *(p for c in self.children for p in c.paths(f"{own}/"))]


@dataclass(frozen=True)
class Entity:
    table: str
    collection: str
    children: tuple[Collection, ...] = ()
    inline: tuple[str, ...] = ()
    custom: tuple[str, ...] = ()
    scalars: tuple[str, ...] = ()
    relations: tuple[tuple[str, tuple[str, ...]], ...] = ()

    def tables(self) -> list[str]:
        """Parent, then each child followed by its own children."""
        return [self.table, *(t for c in self.children for t in c.tables())]

    def requested_lists(self) -> list[str]:
        return [*self.inline, *(p for c in self.children for p in c.paths())]

    def requested_columns(self) -> list[str] | None:
        """Exact columns of an entity with an explicit field list."""
        if not self.scalars:
            return None
        return [*self.scalars, *(f"{key}_{name}" for key, names in self.relations for name in names)]

    def keeps(self, path: Keys, is_object: bool) -> bool:
        """True for paths the entity's request returns."""
        if self.scalars:
            return self._in_field_list(path, is_object)
        if path[0] == "custom":
            return self._in_custom(path, is_object)
        return not is_object or any(_starts(tuple(i.split("/")), path) for i in self.inline)

    def _in_field_list(self, path: Keys, is_object: bool) -> bool:
        if path[0] in self.scalars:
            return True
        names = dict(self.relations).get(path[0])
        if names is None:
            return False
        return is_object if len(path) == 1 else path[1] in names

    def _in_custom(self, path: Keys, is_object: bool) -> bool:
        listed = [("custom", *name.split(".")) for name in self.custom]
        if is_object:
            return any(_starts(p, path) or _starts(path, p) for p in listed)
        return any(_starts(path, p) for p in listed)


def _starts(path: Keys, beginning: Keys) -> bool:
    return path[: len(beginning)] == beginning


@dataclass(frozen=True)
class Family:
    """Entities of one source: how they are paged and how records are written.

    ``filtered``: pages hold just what the requests ask for, as the service filters them. Where full records were
    landed, set it to False and runs leave out what an entity's request would not return.
    """

    name: str
    dialect: str
    paging: str
    entities: tuple[Entity, ...]
    page_size: int = 100  # records of a full page
    filtered: bool = True

    def entity(self, table: str) -> Entity:
        return next(e for e in self.entities if e.table == table)

    def declared_tables(self) -> list[tuple[str, str, str, str]]:
        """``family, table, parent table, key`` in declaration order."""
        return [
            (self.name, table, entity.table, ",".join(KEY))
            for entity in self.entities
            for table in entity.tables()
        ]
