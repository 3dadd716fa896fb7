"""Parent, child and grandchild tables from one set of nested records.

``Records`` carry the VARIANT ``v``, the place of the record in its source
(``PLACE``, whose order is the emission order) and the raw ids of the records
around it. Every step is narrow: lists are exploded in place and no row moves
between tasks. Lists are read as arrays of just the wanted fields; only where
the records are too irregular for that, as arrays of VARIANTs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StructType, VariantType

from recordloom.functions import variant as V
from recordloom.functions.variant import Keys
from recordloom.operators.access import Access, Typed, Wants, Whole, struct_type
from recordloom.operators.catalogue import (
    WRAPPED,
    Catalogue,
    Keeps,
    Merged,
    discover,
    is_key,
    merged_schema,
)
from recordloom.operators.flatten import Default, FlatColumn, flat_columns
from recordloom.sources.entities import Collection, Entity

PLACE = ("_run", "_page", "_pos", "_child", "_grandchild")
RAW_ID = ("id",)


@dataclass(frozen=True)
class Tally:
    """Records met for one table: all, and those with a key."""

    total: int
    keyed: int

    @property
    def quarantined(self) -> int:
        return self.total - self.keyed


@dataclass(frozen=True)
class Hop:
    """One step from a record into a list, passing its id on as ``id_column``."""

    key: str
    id_column: str
    id_type: str

    @property
    def carried(self) -> str:
        return f"_{self.id_column}"


@dataclass
class Records:
    """Nested records of one table, before flattening."""

    table: str
    top: DataFrame  # place and v of the top records
    tally: Tally
    catalogue: Catalogue
    hops: tuple[Hop, ...] = ()
    typed: bool = False  # the lists on the way can be read as typed arrays

    def read(self, wants: Wants | None = None) -> tuple[DataFrame, Access]:
        """The records with the wanted paths; with none given, as they are."""
        if not self.hops:
            return self.top, Whole(F.col("v"))
        element = struct_type(wants.tree()) if wants and self.typed and wants.tree() else None
        types = None if element is None else _list_types(self.hops, element)
        if types is None:
            return _explode(self.top, self.hops, None), Whole(F.col("v"))
        return _explode(self.top, self.hops, types), Typed(F.col("v"), wants)

    def columns(
        self, snake: bool = False, fixed: list[str] | None = None, known: dict[str, str] | None = None
    ) -> list[FlatColumn]:
        """Columns of the flat rows; names met before keep the labels in ``known``."""
        defaults = {hop.id_column: Default(hop.carried, hop.id_type) for hop in self.hops}
        return flat_columns(self.catalogue, snake, defaults, fixed, known)

    def rows(
        self, snake: bool = False, fixed: list[str] | None = None, columns: list[FlatColumn] | None = None
    ) -> DataFrame:
        """Flat rows, with ``_at`` to tell which of two rows came later."""
        columns = self.columns(snake, fixed) if columns is None else columns
        wants = Wants()
        for column in columns:
            column.want(wants)
        frame, record = self.read(wants)
        flat = [column.expression(record, self.catalogue.dialect) for column in columns]
        return frame.filter(self.catalogue.is_record(record)).select(F.struct(*PLACE).alias("_at"), *flat)

    def keys(self) -> DataFrame:
        """Just the key column of the rows."""
        return self.rows(fixed=list(RAW_ID)).select(*RAW_ID)

    def quarantine(self) -> DataFrame:
        """Records without a key, and those that are not objects at all."""
        frame, record = self.read()
        keyed = is_key(V.pick(F.col("v"), RAW_ID), self.catalogue.dialect)
        return _raw(frame.filter(~(self.catalogue.is_record(record) & keyed)))

    def wrong_lists(self, collection: Collection) -> DataFrame | None:
        """Records whose collection is something else than a list; None if no record is."""
        if _only_lists(self.catalogue, collection.key):
            return None
        frame, _ = self.read()
        keys = (collection.key,)
        v = F.col("v")
        return _raw(frame.filter(V.is_present(v, keys) & ~V.is_explicit_null(v, keys) & ~V.is_list(v, keys)))


def _raw(frame: DataFrame) -> DataFrame:
    return frame.select(F.to_json(F.struct(*PLACE)).alias("at"), F.to_json("v").alias("record"))


def _only_lists(catalogue: Catalogue, key: str) -> bool:
    return not any(r.path[0] == key and r.type != V.VOID for r in catalogue.readings)


def _list_types(hops: tuple[Hop, ...], element: str) -> list[str] | None:
    """Array type of the list at each hop, outermost first."""
    types = [f"array<{element}>"]
    for outer, inner in zip(reversed(hops[:-1]), reversed(hops[1:])):
        level = struct_type({"id": inner.id_type, inner.key: types[0]})
        if level is None:
            return None
        types.insert(0, f"array<{level}>")
    return types


def _explode(top: DataFrame, hops: tuple[Hop, ...], types: list[str] | None) -> DataFrame:
    """Elements of the innermost list, each with its place and the ids around it.

    Missing, null and empty lists give none. Taking id and list out before each
    explode lets the scan read these two paths only.
    """
    frame, carried = top, []
    for depth, hop in enumerate(hops):
        v = F.col("v")
        if types is None:
            id_, items = V.pick(v, RAW_ID, hop.id_type), V.as_list(v, (hop.key,))
        elif depth == 0:
            id_, items = V.pick(v, RAW_ID, hop.id_type), V.pick(v, (hop.key,), types[0])
        else:
            id_, items = v.getField("id"), v.getField(hop.key)
        lists = frame.select(*PLACE, *carried, id_.alias(hop.carried), items.alias("_items"))
        carried.append(hop.carried)
        level = PLACE[3 + depth]
        exploded = lists.select(*PLACE, *carried, F.posexplode("_items").alias("_index", "v"))
        frame = exploded.withColumn(level, F.col("_index").cast("bigint")).drop("_index")
    return frame


def positioned(records: DataFrame, run: int = 0) -> DataFrame:
    """``page, pos, v`` records with their full place; children count from there.

    Records of several landings are ordered by ``run_id`` first; else all are of ``run``.
    """
    landing = F.col("run_id") if "run_id" in records.columns else F.lit(run)
    known = {"_run": landing, "_page": F.col("page"), "_pos": F.col("pos")}
    levels = [known.get(level, F.lit(0)).cast("bigint").alias(level) for level in PLACE]
    return records.select(*levels, "v")


# --- counts and merged schema ---------------------------------------------------------


@dataclass
class Survey:
    """Merged schema of all records of an entity and counts of all its tables."""

    merged: Merged
    tallies: dict[str, Tally]
    null_lists: dict[str, dict[Keys, bool]]  # per table: is a declared list null in some record


@dataclass
class IdTree:
    """What counting a list reads of its elements: ids, and the lists further in."""

    id_type: str | None
    lists: dict[str, IdTree]

    def type(self) -> str | None:
        tree = {} if self.id_type is None else {"id": self.id_type}
        for key, inner in self.lists.items():
            tree[key] = inner.type()
        if not tree or None in tree.values():
            return None
        element = struct_type(tree)
        return None if element is None else f"array<{element}>"


def survey(
    records: DataFrame, entity: Entity, dialect: str = WRAPPED, merged: Merged | None = None
) -> Survey:
    """Counts of all tables in one pass, after one for the merged schema if not known yet.

    Counting reads no more than ids and list lengths where the schema shows
    nothing but lists of objects.
    """
    v = F.col("v")
    merged = merged or merged_schema(records, v)
    id_found = _field_type(merged.schema, "id")
    plain = not isinstance(id_found, (StructType, ArrayType, VariantType))
    if isinstance(merged.schema, StructType) and plain:
        keyed = V.pick(v, RAW_ID, "string").isNotNull()
    else:
        keyed = is_key(V.pick(v, RAW_ID), dialect)
    plans: dict[str, Column] = {}
    for collection in entity.children:
        found = _field_type(merged.schema, collection.key)
        if not _never_list(found):
            tree = _id_tree(found, collection)
            if tree is not None and tree.type() is None:
                tree = None
            _count_list(collection, tree, dialect, plans)
    parts = ("total", "keyed", "gaps")
    sums = [F.sum(F.col(f"`{table}`")[part]).alias(f"{table} {part}") for table in plans for part in parts]
    flags = records.select(keyed.alias(" keyed"), *[plan.alias(table) for table, plan in plans.items()])
    top = [F.count("*").alias(" total"), F.count_if(F.col("` keyed`")).alias(" keyed")]
    counts = flags.agg(*top, *sums).first().asDict()
    tallies = {table: Tally(0, 0) for table in entity.tables()}
    tallies[entity.table] = Tally(counts[" total"], counts[" keyed"])
    for table in plans:
        tallies[table] = Tally(counts[f"{table} total"] or 0, counts[f"{table} keyed"] or 0)
    gaps = [table for table in plans if counts[f"{table} gaps"]]
    return Survey(merged, tallies, _null_lists(records, entity, gaps))


def _field_type(found: DataType | None, key: str) -> DataType | None:
    if isinstance(found, StructType) and key in found.fieldNames():
        return found[found.fieldNames().index(key)].dataType
    return None


def _never_list(found: DataType | None) -> bool:
    return found is None or not isinstance(found, (ArrayType, VariantType))


def _id_tree(found: DataType | None, collection: Collection) -> IdTree | None:
    """None if there may be something else than lists of objects."""
    if not isinstance(found, ArrayType) or not isinstance(found.elementType, StructType):
        return None
    id_found = _field_type(found.elementType, "id")
    plain = not isinstance(id_found, (StructType, ArrayType, VariantType))
    tree = IdTree(None if id_found is None else "string" if plain else V.VARIANT, {})
    for nested in collection.children:
        inner_found = _field_type(found.elementType, nested.key)
        if not _never_list(inner_found):
            inner = _id_tree(inner_found, nested)
            if inner is None:
                return None
            tree.lists[nested.key] = inner
    return tree


def _count_list(
    collection: Collection,
    tree: IdTree | None,
    dialect: str,
    plans: dict[str, Column],
    outer: Column | None = None,
) -> None:
    """Per top record: elements of the list, those with a key, and lists not there.

    Without a ``tree`` the elements are read as VARIANTs.
    """
    key, plain = (collection.key,), tree is not None and tree.id_type == "string"
    if outer is None:
        v = F.col("v")
        whole = V.as_list(v, key) if tree is None else V.pick(v, key, tree.type())
        lists = F.array(whole)
    elif tree is None:
        lists = F.transform(outer, lambda e: V.as_list(e, key))
        whole = F.flatten(lists)  # NULL where a list is not there
    else:
        lists = outer.getField(collection.key)
        whole = F.flatten(lists)

    def keyed(items: Column) -> Column:
        if tree is None or tree.id_type == V.VARIANT:  # ids are taken out first: the test looks at each several times
            ids = F.transform(items, lambda e: V.pick(e, RAW_ID) if tree is None else e.getField("id"))
            return F.filter(ids, lambda id_: is_key(id_, dialect))
        return F.filter(items, lambda e: F.lit(False) if tree.id_type is None else e.getField("id").isNotNull())

    def add(sums: Column, items: Column) -> Column:
        more = {
            "total": F.coalesce(F.size(items), F.lit(0)),
            "keyed": F.coalesce(F.size(keyed(items)), F.lit(0)),
            "gaps": items.isNull().cast("int"),
        }
        return F.struct(*[(sums[part] + n).cast("bigint").alias(part) for part, n in more.items()])

    zero = F.struct(*[F.lit(0).cast("bigint").alias(part) for part in ("total", "keyed", "gaps")])
    counted = F.aggregate(lists, zero, add)
    if plain:
        # functions over elements are interpreted; sizes say it all where no list and no id is missing, which a search tells:
        # it gives NULL instead of false where it met a NULL
        complete = F.coalesce(~F.array_contains(whole.getField("id"), F.lit("")), F.lit(False))
        size = F.size(whole).cast("bigint")
        known = F.struct(size.alias("total"), size.alias("keyed"), F.lit(0).cast("bigint").alias("gaps"))
        counted = F.when(complete, known).otherwise(counted)
    plans[collection.table] = counted
    elements = F.coalesce(whole, F.flatten(F.filter(lists, lambda items: items.isNotNull())))
    for nested in collection.children:
        if tree is None or nested.key in tree.lists:
            inner = None if tree is None else tree.lists[nested.key]
            _count_list(nested, inner, dialect, plans, elements)


def _null_lists(records: DataFrame, entity: Entity, gaps: list[str]) -> dict[str, dict[Keys, bool]]:
    """Of the lists some record does not have: which of them are explicit nulls."""
    wanted = []

    def visit(collections: tuple[Collection, ...], owner: str, outer: Column | None) -> None:
        for collection in collections:
            key = (collection.key,)
            if collection.table in gaps:
                null = (
                    V.is_explicit_null(F.col("v"), key)
                    if outer is None
                    else F.exists(outer, lambda e: V.is_explicit_null(e, key))
                )
                wanted.append(F.bool_or(null).alias(collection.table))
            items = V.as_list(F.col("v"), key) if outer is None else _inner(outer, key)
            visit(collection.children, collection.table, items)

    visit(entity.children, entity.table, None)
    nulls = records.agg(*wanted).first().asDict() if wanted else {}
    result = {entity.table: {(c.key,): bool(nulls.get(c.table)) for c in entity.children}}
    pending = list(entity.children)
    while pending:
        collection = pending.pop()
        result[collection.table] = {(c.key,): bool(nulls.get(c.table)) for c in collection.children}
        pending.extend(collection.children)
    return result


def _inner(outer: Column, key: Keys) -> Column:
    lists = F.transform(outer, lambda e: V.as_list(e, key))
    return F.flatten(F.filter(lists, lambda items: items.isNotNull()))


# --- tables ---------------------------------------------------------------------------


def normalise(
    records: DataFrame,
    entity: Entity,
    dialect: str = WRAPPED,
    keeps: Keeps | None = None,
    merged: Merged | None = None,
) -> Iterator[Records]:
    """The tables of ``entity``: the parent first, then its collections."""
    known = survey(records, entity, dialect, merged)
    parents = Records(entity.table, records, known.tallies[entity.table], Catalogue(dialect))
    parents.catalogue = discover(
        parents.read,
        dialect,
        known.merged.schema,
        keeps,
        known.merged.nulls,
        known.null_lists[entity.table],
    )
    yield parents
    for collection in entity.children:
        yield from _children(parents, collection, known, "parent_id")


def _children(outer: Records, collection: Collection, known: Survey, id_column: str) -> Iterator[Records]:
    inner = list_records(outer, collection, known, id_column)
    yield inner
    for nested in collection.children:
        yield from _children(inner, nested, known, collection.id_as)


def list_records(outer: Records, collection: Collection, known: Survey, id_column: str) -> Records:
    """Records of one list, and their columns."""
    dialect = outer.catalogue.dialect
    tally = known.tallies[collection.table]
    element = outer.catalogue.lists.get((collection.key,))
    hops = (*outer.hops, Hop(collection.key, id_column, raw_id_type(outer.catalogue)))
    regular = (outer.typed or not outer.hops) and not outer.catalogue.others
    typed = regular and isinstance(element, StructType) and _only_lists(outer.catalogue, collection.key)
    inner = Records(collection.table, outer.top, tally, Catalogue(dialect), hops, typed)
    if element is None or isinstance(element, NullType):
        inner.catalogue.nulls = tally.quarantined > 0
    elif isinstance(element, (StructType, VariantType)):
        nulls = tally.quarantined > 0
        lists = known.null_lists[collection.table]
        inner.catalogue = discover(inner.read, dialect, element, nulls=nulls, null_lists=lists)
    else:
        inner.catalogue.others = True
    return inner


def raw_id_type(catalogue: Catalogue) -> str:
    """Type ids are passed on with: their own if they are plain scalars, else text."""
    found = [r for r in catalogue.readings if r.path == RAW_ID and r.scalar and not r.wrapper]
    return found[0].type if len(found) == 1 and found[0].type != V.VOID else "string"
