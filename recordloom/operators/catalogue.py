"""Column catalogue of a set of nested records.

Which columns a table has depends on every record: one field may be a scalar
in one record, a ``{"value": x}`` wrapper in the next and a larger object in a
third. The catalogue is found with aggregates only, so a pass over any amount
of data ends in one small row:

1. ``schema_of_variant_agg`` merges the schemas of all records, nested lists
   included, which also gives the starting schema of every child table;
2. paths the merged schema leaves open (may the object also be null or empty?
   is it a wrapper in some record? does it mix scalars and objects?) are
   settled together by one more aggregate that reads just those paths. Objects
   found inside an open path go into a further round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, VariantType

from recordloom.functions import variant as V
from recordloom.functions.variant import Keys
from recordloom.operators.access import Access, Wants
from recordloom.session import settings, stage

WRAPPED = "wrapped"  # {"value": x} stands for x, and _links is metadata
PLAIN = "plain"  # every key is data

# Lists of nested records are collected in key order: a group at a time, and one sort serves all levels.
HASHED_LISTS = "spark.sql.execution.useObjectHashAggregateExec"
SHREDDING = "spark.sql.variant.writeShredding.enabled"
# Dictionaries take half the time of writing shredded records, whose many narrow columns are mostly ids and amounts.
NO_DICTIONARY = {"parquet.enable.dictionary": "false"}

METADATA_KEY = "_links"
WRAPPER_KEY = "value"


@dataclass(frozen=True)
class Above:
    """What lies on the way to a path and differs from record to record.

    ``wrappers`` lists objects that are a mere wrapper in some records; the path
    counts in the others. ``mixed`` is the outermost place that is no object in
    some records.
    """

    wrappers: tuple[Keys, ...] = ()
    mixed: Keys | None = None

    def looks_at(self, path: Keys) -> list[Keys]:
        """Places whose value must be at hand as it is to read ``path``."""
        return [*leading_through(path, self.wrappers), *([self.mixed] if self.mixed else [])]


@dataclass(frozen=True)
class Reading:
    """One place in a record a column can be read from.

    ``settled`` means every record with this path has a value for the column
    there; otherwise some records hold a list or an object with columns of its
    own.
    """

    path: Keys
    type: str
    scalar: bool = True
    wrapper: bool = False
    settled: bool = True
    above: Above = Above()

    @property
    def name(self) -> str:
        return "_".join(self.path)

    @property
    def value_path(self) -> Keys:
        return (*self.path, WRAPPER_KEY) if self.wrapper else self.path

    def guards(self) -> list[Keys]:
        """Objects that must not be a wrapper in the record."""
        return leading_through(self.path, self.above.wrappers)


@dataclass
class Catalogue:
    dialect: str
    readings: list[Reading] = field(default_factory=list)
    lists: dict[Keys, DataType] = field(default_factory=dict)
    nulls: bool = True  # a record may be null
    others: bool = False  # a record may be a list or scalar

    def columns(self) -> dict[str, list[Reading]]:
        """Readings by column name; of several, the deepest path comes last."""
        named: dict[str, list[Reading]] = {}
        for reading in sorted(self.readings, key=lambda r: (len(r.path), r.path)):
            named.setdefault(reading.name, []).append(reading)
        return dict(sorted(named.items()))

    def is_record(self, record: Access) -> Column:
        """True for records that can be flattened.

        Tests no more than needed: looking at the whole record would keep Spark
        from reading single paths of it.
        """
        if self.others:
            return V.is_object(*record.variant(()))
        return record.exists() if self.nulls else F.lit(True)

    def collisions(self) -> dict[str, list[Keys]]:
        """Columns more than one path writes to."""
        return {n: [r.path for r in rs] for n, rs in self.columns().items() if len(rs) > 1}


@dataclass(frozen=True)
class _Open:
    """A path the merged schema does not settle."""

    path: Keys
    found: DataType
    above: Above

    @property
    def mixed(self) -> bool:
        return isinstance(self.found, VariantType)


Keeps = Callable[[Keys, bool], bool]


Reach = Callable[[Wants], tuple[DataFrame, Access]]  # records, read for the given paths


def discover(
    reach: Reach,
    dialect: str = WRAPPED,
    seed: DataType | None = None,
    keeps: Keeps | None = None,
    nulls: bool = True,
    null_lists: dict[Keys, bool] | None = None,
) -> Catalogue:
    """Catalogue of the records ``reach`` gives.

    ``keeps(path, is_object)`` restricts the catalogue to wanted paths. What an
    earlier pass already found may be given: the merged schema as ``seed``,
    whether there are ``nulls`` among the records, and which lists are null
    somewhere.
    """
    walker = _Walker(dialect, keeps or (lambda path, is_object: True), null_lists or {})
    if seed is None:
        records, whole = reach(Wants())
        merged = merged_schema(records, whole.v)
        seed, nulls = merged.schema, merged.nulls
    walker.catalogue.nulls = nulls
    if isinstance(seed, VariantType):  # objects among other things
        walker.catalogue.others = True
        records, whole = reach(Wants())
        seed = merged_schema(records, F.when(V.is_object(whole.v), whole.v)).schema
    if isinstance(seed, StructType):
        walker.enter(seed, (), Above())
    while walker.open:
        walker.settle(reach)
    return walker.catalogue


def is_key(key: Column, dialect: str = WRAPPED) -> Column:
    """True for a raw ``id`` value that gives a column value other than NULL."""
    plain = ~V.is_explicit_null(key) & ~V.is_object(key) & ~V.is_list(key)
    if dialect == WRAPPED:
        inner = V.pick(key, (WRAPPER_KEY,))
        plain = plain | (V.is_wrapper(key) & ~V.is_explicit_null(inner))
    return F.coalesce(key.isNotNull() & plain, F.lit(False))


@dataclass(frozen=True)
class Merged:
    """Merged type of a set of records, and whether any of them is null.

    A null merges with any type, so the type alone does not tell.
    """

    schema: DataType
    nulls: bool


def _merge(record: Column) -> list[Column]:
    return [
        F.schema_of_variant_agg(record).alias("schema"),
        F.bool_or(F.is_variant_null(record)).alias("nulls"),
    ]


def merged_schema(records: DataFrame, record: Column) -> Merged:
    found = records.agg(*_merge(record)).first()
    return Merged(V.parse_schema(found.schema), bool(found.nulls))


def stage_records(records: DataFrame, label: str, shredded: bool = True) -> tuple[DataFrame, Merged]:
    """Stage records and merge their schemas on the way, without reading them again.

    Shredding pays where several passes read typed paths. Records that are read once, or whole because their lists hold
    all sorts of things, cost less when they are not ``shredded``.

    Observed values may cover a row twice when a lost task runs again. Merging is
    idempotent, so the result stays exact; a count would not.
    """
    seen = Observation()
    planned = {HASHED_LISTS: "false"} if shredded else {HASHED_LISTS: "false", SHREDDING: "false"}
    with settings(records.sparkSession, planned):
        staged = stage(records.observe(seen, *_merge(F.col("v"))), label, **NO_DICTIONARY)
    found = seen.get
    return staged, Merged(V.parse_schema(found["schema"]), bool(found["nulls"]))


class _Walker:
    def __init__(self, dialect: str, keeps: Keeps, null_lists: dict[Keys, bool]):
        self.catalogue = Catalogue(dialect)
        self.wraps = dialect == WRAPPED
        self.keeps = keeps
        self.null_lists = null_lists
        self.open: list[_Open] = []

    def enter(self, found: StructType, path: Keys, above: Above) -> None:
        for child in found.fields:
            if self.wraps and child.name == METADATA_KEY:
                continue
            self.visit(child.dataType, (*path, child.name), above)

    def visit(self, found: DataType, path: Keys, above: Above) -> None:
        if isinstance(found, ArrayType):
            self.catalogue.lists[path] = found.elementType
            if path not in self.null_lists:
                self._leave_open(path, found, above)
            elif self.null_lists[path]:
                self._add(path, V.VOID, above, settled=False)
        elif isinstance(found, VariantType):
            self._leave_open(path, found, above)
        elif isinstance(found, StructType):
            names = found.fieldNames()
            if not names:
                self._add(path, V.VOID, above)
            elif self.wraps and names == [WRAPPER_KEY]:
                self._add(path, V.leaf_type(found[0].dataType), above, wrapper=True)
            elif self.keeps(path, True):
                self._leave_open(path, found, above)
                if not self._may_wrap(found):
                    self.enter(found, path, above)
        else:
            self._add(path, V.leaf_type(found), above)

    def settle(self, reach: Reach) -> None:
        """Answer all open questions of this round in one aggregate."""
        batch, self.open = self.open, []
        wants = Wants(whole={p for o in batch for p in (o.path, *o.above.looks_at(o.path))})
        records, record = reach(wants)
        wanted = [e.alias(f"{i}.{k}") for i, o in enumerate(batch) for k, e in self._questions(o, record)]
        answers = records.agg(*wanted).first().asDict()
        for i, item in enumerate(batch):
            self._resolve(item, lambda question, i=i: answers.get(f"{i}.{question}"))

    def _leave_open(self, path: Keys, found: DataType, above: Above) -> None:
        self.open.append(_Open(path, found, above))

    def _add(self, path, type_, above, wrapper=False, scalar=None, settled=True) -> None:
        if self.keeps(path, False):
            scalar = not wrapper if scalar is None else scalar
            self.catalogue.readings.append(Reading(path, type_, scalar, wrapper, settled, above))

    def _may_wrap(self, found: DataType) -> bool:
        return self.wraps and WRAPPER_KEY in found.fieldNames()

    def _questions(self, item: _Open, record: Access) -> Iterator[tuple[str, Column]]:
        v, keys = record.variant(item.path)
        reached = reachable(record, item.path, item.above)
        null = V.is_explicit_null(v, keys)
        empty = V.is_empty_object(v, keys)
        yield "blank", F.bool_or(reached & (null | empty))
        if isinstance(item.found, ArrayType):
            return
        if not item.mixed and not self._may_wrap(item.found):
            return
        here = V.pick(v, keys)
        obj = V.is_object(v, keys)
        wrapper = V.is_wrapper(v, keys) if self.wraps else F.lit(False)
        inner = V.pick(v, (*keys, WRAPPER_KEY))
        nested = reached & obj & ~wrapper & ~empty
        yield "wrapper", F.bool_or(reached & wrapper)
        yield "wrapper_type", F.schema_of_variant_agg(F.when(reached & wrapper, inner))
        yield "nested", F.bool_or(nested)
        yield "nested_type", F.schema_of_variant_agg(F.when(nested, here))
        if item.mixed:
            listed = V.is_list(v, keys)
            scalar = reached & here.isNotNull() & ~obj & ~listed & ~null
            yield "scalar", F.bool_or(scalar)
            yield "scalar_type", F.schema_of_variant_agg(F.when(scalar, here))
            yield "list", F.bool_or(reached & listed)
            yield "list_type", F.schema_of_variant_agg(F.when(reached & listed, here))

    def _resolve(self, item: _Open, answer: Callable[[str], object]) -> None:
        types = []
        for kind in ("scalar", "wrapper"):
            if answer(kind):
                types.append(V.leaf_type(V.parse_schema(answer(f"{kind}_type"))))
        if answer("blank") or types:
            self._add(
                item.path,
                V.widest(types),
                item.above,
                wrapper=bool(answer("wrapper")),
                scalar=bool(answer("scalar")),
                settled=False,
            )
        if answer("list"):
            self.catalogue.lists[item.path] = V.parse_schema(answer("list_type")).elementType
        if answer("nested") and self.keeps(item.path, True):
            nested = V.parse_schema(answer("nested_type"))
            wrappers = item.above.wrappers
            if self._may_wrap(nested):
                wrappers = (*wrappers, item.path)
            mixed = item.above.mixed or (item.path if item.mixed else None)
            self.enter(nested, item.path, Above(wrappers, mixed))


def leading_through(path: Keys, wrappers: tuple[Keys, ...]) -> list[Keys]:
    """The objects that ``path`` leaves by the wrapper key."""
    return [outer for outer in wrappers if path[len(outer)] == WRAPPER_KEY]


def reachable(record: Access, path: Keys, above: Above) -> Column:
    """True unless the path leads through an object that is a wrapper here."""
    result = F.lit(True)
    for outer in leading_through(path, above.wrappers):
        result = result & ~V.is_wrapper(*record.variant(outer))
    return result
