"""Normalised tables as Parquet versions, published through a commit log.

A table's rows are spread over buckets by a hash of their key. Each bucket is a base file set and, beside it, the deltas of the runs
since: a run writes no more than the rows that are new or differ, and readers take the newest row of a key. Once the deltas
of a bucket come to a stated share of its base, the run that finds it so writes the bucket anew as one base. Buckets are
split one at a time, by one more bit of the hash, as the table grows past a stated size per bucket.

The commit log names, for every table, the folders each bucket consists of. Readers take versions from the log only: all
tables of an entity change at once, a run that dies leaves no trace readers can see, and no file is changed in place.
Rows set aside, pages not read and pages that wait for others are versions too, named by the same log entry. Folders that
no kept run names are removed by ``sweep``. Tables are kept by family and name. One run at a time may write to a store.

Every row carries the number of the landing it came with, and a hash of its values. A row of an older landing than the stored
one changes nothing, whenever it arrives; rows that say what is stored already are counted and not written again.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordloom.functions.variant import widest
from recordloom.operators.drift import added_columns, as_text, changed_columns, union_drift, widened
from recordloom.operators.upsert import latest, with_key
from recordloom.session import shuffle_partitions, stage
from recordloom.sources.entities import KEY

BUCKETS = 16  # of a new table
BUCKET_BYTES = 1 << 30  # a bucket is split beyond this on average
COMPACT_SHARE = 0.25  # deltas over base, in rows, from which a bucket is written anew
MOST_DELTAS = 8  # and the number of deltas
FILES_PER_TASK = 64  # buckets a task may write small pieces of
BUCKET = "_bucket"
ID = KEY[0]

LANDING, HASH, SYNCED = "_run", "_hash", "_synced_at"
HIDDEN = (LANDING, HASH)

COMMIT_FIELDS = pa.schema(
    [
        ("run", pa.int64()),
        ("position", pa.int32()),
        ("family", pa.string()),
        ("entity", pa.string()),
        ("table_name", pa.string()),
        ("status", pa.string()),
        ("version", pa.string()),
        ("upserts", pa.int64()),
        ("row_count", pa.int64()),
        ("added", pa.int64()),
        ("changed", pa.int64()),
        ("same", pa.int64()),
        ("stale", pa.int64()),
        ("quarantined", pa.int64()),
        ("quarantine", pa.string()),
        ("schema_changes", pa.int32()),
        ("collisions", pa.int32()),
        ("unread_pages", pa.int64()),
        ("unread_from", pa.string()),
        ("unread", pa.string()),
        ("landings", pa.string()),
        ("error", pa.string()),
    ]
)
COMMIT_SCHEMA = (
    "run bigint, position int, family string, entity string, table_name string, status string, version string, "
    "upserts bigint, row_count bigint, added bigint, changed bigint, same bigint, stale bigint, quarantined bigint, "
    "quarantine string, schema_changes int, collisions int, unread_pages bigint, unread_from string, unread string, "
    "landings string, error string, at timestamp"
)

BASE, DELTA, TOUCH = "base", "delta", "touch"
COMPACTED = "compacted"


@dataclass(frozen=True)
class Piece:
    """Part of a bucket: its base, the rows a run added or changed, or keys a run found unchanged in a later landing."""

    kind: str
    folder: str
    rows: int
    size: int


@dataclass
class Version:
    """What each bucket of a table consists of, oldest piece first; logged as JSON."""

    buckets: int
    parts: dict[int, tuple[Piece, ...]] = field(default_factory=dict)
    row_count: int = 0
    landing: int = 0  # the latest landing a row came with
    labels: dict[str, str] = field(default_factory=dict)  # column of each source name met so far
    schemas: dict[str, str] = field(default_factory=dict)  # of each folder

    @property
    def size(self) -> int:
        return sum(piece.size for pieces in self.parts.values() for piece in pieces)

    def only(self, buckets: Iterable[int]) -> Version:
        wanted = set(buckets)
        return replace(self, parts={b: pieces for b, pieces in self.parts.items() if b in wanted})

    def beside(self, folders: set[str]) -> Version:
        """What is not in these folders."""
        parts = {b: tuple(p for p in pieces if p.folder not in folders) for b, pieces in self.parts.items()}
        return replace(self, parts=parts)

    def folders(self) -> set[str]:
        return {piece.folder for pieces in self.parts.values() for piece in pieces}

    def to_json(self) -> str:
        parts = {b: [[p.kind, p.folder, p.rows, p.size] for p in pieces] for b, pieces in self.parts.items()}
        used = self.folders()
        schemas = {folder: schema for folder, schema in self.schemas.items() if folder in used}
        return json.dumps({**vars(self), "parts": parts, "schemas": schemas})

    @staticmethod
    def from_json(text: str) -> Version:
        found = json.loads(text)
        parts = {int(b): tuple(Piece(*piece) for piece in pieces) for b, pieces in found["parts"].items()}
        return Version(**{**found, "parts": parts})


def parent(bucket: int, buckets: int) -> int:
    """The bucket that held a bucket's keys when there were only so many."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_bytes = bucket_bytes
        self._log = f"{self.root}/_commits"
        self._lock = threading.Lock()

    # ---- the log ----

    def commits(self) -> DataFrame:
        if not self._exists(self._log):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(self._log)

    def commit(self, entries: list[dict]) -> None:
        """Append the entries as one file, which makes them visible together."""
        frame = self.spark.createDataFrame(pa.Table.from_pylist(entries, COMMIT_FIELDS))
        frame = frame.withColumn("at", F.current_timestamp())
        with self._lock:
            frame.coalesce(1).write.mode("append").parquet(self._log)

    def next_run(self) -> int:
        return (self.commits().agg(F.max("run")).first()[0] or 0) + 1

    def newest(self, run: int | None = None) -> DataFrame:
        """``family, table_name, version, row_count`` of every table, as of a run if one is given."""
        published = self.commits().filter("version is not null")
        published = published if run is None else published.filter(F.col("run") <= run)
        last = F.max_by(F.struct("version", "row_count"), F.struct("run", "at"))
        return published.groupBy("family", "table_name").agg(last.alias("last")).select("family", "table_name", "last.*")

    def versions(self, run: int | None = None) -> dict[tuple[str, str], Version]:
        """Version of each table by family and name (one entry per declared table), the current one or that of a run."""
        return {(row.family, row.table_name): Version.from_json(row.version) for row in self.newest(run).collect()}

    def inventory(self) -> DataFrame:
        """``table_schema, table_name, row_count, last_synced, last_changed`` of all tables, from the log alone.

        A table is synced when a run brings rows for it, and changed when any of them was new or differed.
        """
        brought = self.commits().filter("status = 'committed'").groupBy("family", "table_name")
        synced = F.max(F.when(F.col("upserts") > 0, F.col("at"))).alias("last_synced")
        changed = F.max(F.when(F.col("added") + F.col("changed") > 0, F.col("at"))).alias("last_changed")
        found = self.newest().join(brought.agg(synced, changed), ["family", "table_name"])
        return found.select(F.col("family").alias("table_schema"), "table_name", "row_count", "last_synced", "last_changed")

    # ---- reading ----

    def table(self, name: str, family: str | None = None, run: int | None = None) -> DataFrame | None:
        """A table as it stands, or as a kept run left it; ``family`` is needed where several have one of that name."""
        found = {key: v for key, v in self.versions(run).items() if key[1] == name and family in (None, key[0])}
        if len(found) > 1:
            raise ValueError(f"{name} is a table of {sorted(f for f, _ in found)}")
        return self.read(next(iter(found.values()), None))

    def read(self, version: Version | None) -> DataFrame | None:
        """The rows of a version: of each key the newest."""
        rows = None if version is None else self._rows(version)
        return None if rows is None else rows.drop(*HIDDEN)

    def _pieces(self, version: Version, kinds: tuple[str, ...], buckets: Iterable[int] | None = None) -> DataFrame | None:
        """All pieces of these kinds, folders aligned, with ``_piece`` telling their order."""
        chosen = version.parts if buckets is None else set(buckets)
        folders: dict[str, list[int]] = {}
        for bucket, pieces in version.parts.items():
            if bucket in chosen:
                for piece in pieces:
                    if piece.kind in kinds:
                        folders.setdefault(piece.folder, []).append(bucket)
        frames = []
        for folder, held in folders.items():
            schema = StructType.fromJson(json.loads(version.schemas[folder]))
            paths = [f"{self.root}/{folder}/{BUCKET}={bucket}" for bucket in sorted(held)]
            # folder names begin with the run that wrote them, so their order is that of the runs
            order = F.lit(folder.rsplit("/version=", 1)[1])
            frames.append(self.spark.read.schema(schema).parquet(*paths).withColumn("_piece", order))
        return union_drift(*frames) if frames else None

    def _rows(self, version: Version) -> DataFrame | None:
        """Rows with their hidden columns.

        Only deltas are compared with each other, and bases looked up in them by key; a bucket without deltas is read as it is.
        """
        mixed = {b for b, pieces in version.parts.items() if any(p.kind == DELTA for p in pieces)}
        plain = self._pieces(version, (BASE,), version.parts.keys() - mixed)
        base, delta = self._pieces(version, (BASE,), mixed), self._pieces(version, (DELTA,), mixed)
        found = [] if plain is None else [plain.drop("_piece")]
        if delta is not None:
            newest = latest(delta, list(KEY), ["_piece"]).drop("_piece")
            found.append(newest)
            if base is not None:
                found.append(without_keys(base.drop("_piece"), delta.select(ID)))
        return union_drift(*found) if found else None

    def _settled(self, version: Version) -> DataFrame | None:
        """The rows, each with the latest landing it was found in, also where that brought nothing new."""
        rows, touched = self._rows(version), self._pieces(version, (TOUCH,))
        if rows is None or touched is None:
            return rows
        type_ = widest([frame.schema[ID].dataType.simpleString() for frame in (rows, touched)])
        later = touched.groupBy(keyed(touched, type_).alias("_key")).agg(F.max(LANDING).alias("_later"))
        both = rows.withColumn("_key", keyed(rows, type_)).join(later, "_key", "left")
        return both.withColumn(LANDING, F.greatest(LANDING, "_later")).select(rows.columns)

    # ---- writing ----

    def bucket_of(self, key: Column, key_type: str, buckets: int) -> Column:
        """As many low bits of the hash as name a bucket. It depends on the key's text, so that a key may change its type."""
        low = buckets.bit_length() - 1
        hashed = F.xxhash64(as_text(key, key_type))
        wide = hashed.bitwiseAND(F.lit((2 << low) - 1))
        return F.when(wide < buckets, wide).otherwise(hashed.bitwiseAND(F.lit((1 << low) - 1))).cast("int")

    def write(
        self,
        family: str,
        name: str,
        rows: DataFrame,
        run: int,
        current: Version | None,
        row_keys: DataFrame | None = None,
        numbered: bool = False,
        labels: dict[str, str] | None = None,
    ) -> dict:
        """Write the next version of one table; it shows once committed.

        ``numbered`` rows tell in ``_at`` which landing they came with; others, and those of landing 0, come as late as
        the latest one known. Only rows that are new or differ are written, and only buckets they fall into are read.
        """
        before = current or Version(self.buckets)
        landing = F.lit(before.landing).cast("bigint")
        if numbered:
            own = F.col("_at")["_run"]
            landing = F.when(own > 0, own).otherwise(landing)
        data = [c for c in rows.columns if c != "_at"]
        hashed = row_hash({c: rows.schema[c].dataType.simpleString() for c in data if c != ID})
        fresh = latest(with_key(rows, list(KEY)), list(KEY), ["_at"])
        fresh = fresh.select(*data, landing.alias(LANDING), hashed.alias(HASH), F.current_timestamp().alias(SYNCED))
        place = Place(f"{family}/{name}", run)
        counts = {"added": 0, "changed": 0, "same": 0, "stale": 0}
        if before.parts:
            version, counts = self._merge(before, fresh, rows.select(*KEY) if row_keys is None else row_keys, place)
        else:
            version = self._append(before, fresh, place, BASE)
            counts["added"] = version.row_count = sum(p.rows for pieces in version.parts.values() for p in pieces)
        changed = 0
        if version.folders() - before.folders():
            if numbered:
                written = version.beside(before.folders())
                latest_ = self._pieces(written, (BASE, DELTA, TOUCH)).agg(F.max(LANDING)).first()[0]
                version.landing = max(before.landing, latest_ or 0)
            version = self._grow(version, place)
            changed = self._schema_changes(before, version)
        version.labels = {**before.labels, **(labels or {})}
        return {"row_count": version.row_count, "schema_changes": changed, "version": version.to_json(), **counts}

    def _merge(self, before: Version, fresh: DataFrame, keys: DataFrame, place: Place) -> tuple[Version, dict]:
        """Compare the fresh rows with what is stored, and write what that comes to."""
        key_type = fresh.schema[ID].dataType.simpleString()
        at = self.bucket_of(F.col(ID), key_type, before.buckets)
        asked = stage(with_key(keys, list(KEY)).select(ID, at.alias(BUCKET)).distinct(), "keys")
        touched = {row[0] for row in asked.select(BUCKET).distinct().collect()}  # no more than buckets
        known = self._settled(before.only(touched))
        known = fresh.limit(0) if known is None else known
        type_ = widest([key_type, known.schema[ID].dataType.simpleString()])
        asked = asked.select(keyed(asked, type_).alias("_key"))
        old = known.select(
            keyed(known, type_).alias("_key"),
            F.coalesce(LANDING, F.lit(0)).alias("_old_run"),
            F.col(HASH).alias("_old_hash"),
            F.col(SYNCED).alias("_old_synced"),
        ).join(asked, "_key", "left_semi")
        kind = (
            F.when(F.col("_old_run").isNull(), "added")
            .when(F.col(LANDING) < F.col("_old_run"), "stale")
            .when(F.col(HASH) == F.col("_old_hash"), "same")
            .otherwise("changed")
        )
        judged = fresh.withColumn("_key", keyed(fresh, type_)).join(old, "_key", "left")
        judged = stage(judged.withColumns({"_kind": kind, BUCKET: at}).drop("_old_hash"), "judged")
        later = F.count_if((F.col("_kind") == "same") & (F.col(LANDING) > F.col("_old_run")))
        tallies = judged.groupBy(BUCKET, "_kind").agg(F.count("*").alias("n"), later.alias("later")).collect()
        counts = {k: sum(t.n for t in tallies if t["_kind"] == k) for k in ("added", "changed", "same", "stale")}
        new: dict[int, int] = {}
        for tally in tallies:
            if tally["_kind"] in ("added", "changed"):
                new[tally[BUCKET]] = new.get(tally[BUCKET], 0) + tally.n
        anew = {b for b, n in new.items() if self._worn(before.parts.get(b, ()), n)}
        wanted = F.col("_kind").isin("added", "changed")
        columns = [c for c in judged.columns if c not in ("_key", "_kind", "_old_run", "_old_synced", BUCKET)]
        version = replace(before, parts=dict(before.parts), schemas=dict(before.schemas))
        if new.keys() - anew:
            delta = judged.filter(wanted & ~F.col(BUCKET).isin(*anew) if anew else wanted)
            version = self._append(version, delta.select(columns), place, DELTA)
        touch = judged.filter((F.col("_kind") == "same") & (F.col(LANDING) > F.col("_old_run")))
        if any(t.later and t[BUCKET] not in anew for t in tallies):
            touch = touch.filter(~F.col(BUCKET).isin(*anew)) if anew else touch
            version = self._append(version, touch.select(ID, LANDING), place, TOUCH)
        if anew:
            rewritten = self._anew(before.only(anew), judged.filter(F.col(BUCKET).isin(*anew)), columns, type_)
            version = self._append(self._without(version, anew), rewritten, place, BASE)
        version.row_count = before.row_count + counts["added"]
        return version, counts

    def _worn(self, pieces: tuple[Piece, ...], more: int) -> bool:
        """Whether a bucket that gets so many more rows is to be written anew."""
        base = sum(p.rows for p in pieces if p.kind == BASE)
        deltas = [p.rows for p in pieces if p.kind == DELTA]
        return sum(deltas) + more > COMPACT_SHARE * base or len(deltas) >= MOST_DELTAS

    def _anew(self, stored: Version, judged: DataFrame, columns: list[str], type_: str) -> DataFrame:
        """Stored rows with the judged ones put in: rows not brought, or brought stale, stay; unchanged ones keep their time."""
        synced = F.when(F.col("_kind") == "same", F.col("_old_synced")).otherwise(F.col(SYNCED)).alias(SYNCED)
        fresh = judged.filter("_kind <> 'stale'")
        put = fresh.select(*[synced if c == SYNCED else F.col(f"`{c}`") for c in columns])
        rows = self._settled(stored)
        if rows is None:
            return put
        # in a full refresh hardly any key stays, and Spark sees how small the list is
        brought = fresh.select("_key")
        staying = stage(rows.select(keyed(rows, type_).alias("_key")).join(brought, "_key", "left_anti"), "staying")
        kept = rows.withColumn("_key", keyed(rows, type_)).join(staying, "_key", "left_semi").drop("_key")
        return union_drift(kept, put)

    def _append(self, version: Version, rows: DataFrame, place: Place, kind: str) -> Version:
        """Write rows as one more piece of the buckets they fall into."""
        folder = place.folder()
        at = self.bucket_of(F.col(ID), rows.schema[ID].dataType.simpleString(), version.buckets)
        placed = rows.withColumn(BUCKET, at)
        path = f"{self.root}/{folder}"
        if kind == BASE or version.buckets <= FILES_PER_TASK:
            spread = placed.hint("rebalance", BUCKET)
        else:  # few rows a bucket: by size alone one task would open the files of all buckets
            least = -(-version.buckets // FILES_PER_TASK)
            spread = placed.repartition(min(version.buckets, max(least, shuffle_partitions(rows))), BUCKET)
        spread.write.partitionBy(BUCKET).parquet(path)
        schema = StructType([f for f in placed.schema.fields if f.name != BUCKET])
        written = self.spark.read.schema(placed.schema).parquet(path)
        once = F.when(F.col("_metadata.row_index") == 0, F.col("_metadata.file_size"))  # a file's size with its first row
        sizes = written.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum(once).alias("size")).collect()
        parts = dict(version.parts)
        for row in sizes:
            parts[row[BUCKET]] = (*parts.get(row[BUCKET], ()), Piece(kind, folder, row.n, row.size))
        return replace(version, parts=parts, schemas={**version.schemas, folder: schema.json()})

    def _without(self, version: Version, buckets: Iterable[int]) -> Version:
        gone = set(buckets)
        return replace(version, parts={b: pieces for b, pieces in version.parts.items() if b not in gone})

    def _grow(self, version: Version, place: Place) -> Version:
        """Split buckets one after the other until they hold no more than they should on average."""
        buckets = max(version.buckets, -(-version.size // self.bucket_bytes))
        if buckets == version.buckets:
            return version
        split = {parent(b, version.buckets) for b in range(version.buckets, buckets)}
        return self._rebuilt(version, split, buckets, place)

    def _rebuilt(self, version: Version, buckets: Iterable[int], count: int, place: Place) -> Version:
        """These buckets as bases of their own, among ``count`` buckets."""
        old = version.only(buckets)
        rows = self._settled(old)
        grown = replace(self._without(version, old.parts), buckets=count)
        return grown if rows is None else self._append(grown, rows, place, BASE)

    def _schema_changes(self, before: Version, after: Version) -> int:
        """Columns added or changed in type; a table made is one change."""
        if not before.parts:
            return 1
        old = union_drift(*[self._nothing(before, folder) for folder in sorted(before.folders())]).drop(*HIDDEN)
        fresh = sorted(after.folders() - before.folders())
        new = union_drift(old, *[self._nothing(after, folder).drop(*HIDDEN) for folder in fresh])
        return len(added_columns(old, new)) + len(changed_columns(old, new))

    def _nothing(self, version: Version, folder: str) -> DataFrame:
        return self.spark.createDataFrame([], StructType.fromJson(json.loads(version.schemas[folder])))

    def keep(self, current: Version | None) -> dict:
        """Entry of a table a run has no rows for."""
        version = None if current is None else current.to_json()
        return {"row_count": 0 if current is None else current.row_count, "schema_changes": 0, "version": version}

    def compact(self, name: str, family: str) -> None:
        """Write every bucket that has deltas anew as one base; a run of its own, which changes no row."""
        version = self.versions()[family, name]
        worn = {b for b, pieces in version.parts.items() if any(p.kind != BASE for p in pieces)}
        run = self.next_run()
        done = self._rebuilt(version, worn, version.buckets, Place(f"{family}/{name}", run)) if worn else version
        entry = {"run": run, "position": 0, "family": family, "entity": name, "table_name": name, "status": COMPACTED}
        self.commit([{**entry, "row_count": done.row_count, "version": done.to_json()}])

    # ---- versions beside the tables ----

    def put(self, kind: str, family: str, name: str, rows: DataFrame, run: int) -> str:
        """Write rows as a version of their own; they show once the returned folder is committed."""
        folder = f"_{kind}/{family}/{name}/version={run:08d}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def get(self, folder: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def quarantine(self, family: str, name: str, rows: DataFrame, run: int) -> str:
        """Set aside raw records no table can take."""
        named = rows.select(F.lit(family).alias("family"), F.lit(name).alias("table"), F.lit(run).alias("run"), "*")
        return self.put("quarantine", family, name, named, run)

    def quarantined(self) -> DataFrame | None:
        """All rows set aside by committed runs."""
        logged = self.commits().filter("quarantine is not null").select("quarantine").collect()
        folders = [folder for row in logged for folder in json.loads(row.quarantine)]
        return self.spark.read.parquet(*[f"{self.root}/{folder}" for folder in folders]) if folders else None

    def unread(self) -> DataFrame | None:
        """``run, family, entity, run_id, page, reason`` of every landed page that committed runs did not read."""
        logged = self.commits().filter("unread is not null").select("run", "family", "entity", "unread").collect()
        found = [
            self.get(row.unread, "run_id bigint, page bigint, reason string").select(
                F.lit(row.run).alias("run"), F.lit(row.family).alias("family"), F.lit(row.entity).alias("entity"),
                "run_id", "page", "reason",
            )
            for row in logged
        ]
        return reduce(DataFrame.unionByName, found) if found else None

    def landings(self, family: str, entity: str) -> dict[str, str]:
        """Folders of the pages that wait and of how far each landing was read, as the newest run left them."""
        own = self.commits().filter((F.col("family") == family) & (F.col("entity") == entity))
        row = own.filter("landings is not null").agg(F.max_by("landings", "run").alias("landings")).first()
        return json.loads(row.landings) if row.landings else {}

    # ---- removal of old versions ----

    def named(self, since: int) -> set[str]:
        """Folders that a run from ``since`` on names, and all that readers of any time need: rows set aside, pages unread."""
        kept: set[str] = set()
        log = self.commits().select("run", "family", "entity", "table_name", "version", "quarantine", "unread", "landings")
        newest = W.partitionBy("family", "table_name").orderBy(F.desc("run"))
        state = W.partitionBy("family", "entity").orderBy(F.desc("run"))
        # what stood when the first kept run was done, be it of a run long before
        early = log.filter(F.col("run") <= since)
        begun = early.filter("version is not null").withColumn("_n", F.row_number().over(newest)).filter("_n = 1")
        waiting = early.filter("landings is not null").withColumn("_n", F.row_number().over(state)).filter("_n = 1")
        late = log.filter(F.col("run") > since)
        for row in late.select("version").union(begun.select("version")).filter("version is not null").distinct().collect():
            kept |= Version.from_json(row.version).folders()
        for row in late.select("landings").union(waiting.select("landings")).filter("landings is not null").collect():
            kept |= set(json.loads(row.landings).values())
        for row in log.filter("quarantine is not null").select("quarantine").collect():
            kept |= set(json.loads(row.quarantine))
        return kept | {row.unread for row in log.filter("unread is not null").select("unread").collect()}

    def sweep(self, keep_runs: int = 1) -> list[str]:
        """Remove version folders that none of the last ``keep_runs`` runs refers to; returns them.

        Marks by the log and sweeps what lies beside it. A folder untouched for many runs stays as long as a kept run names it.
        Folders of a run that is under way, or died before its first commit, are left alone. Earlier runs can no longer be read.
        """
        last = self.next_run() - 1
        kept = self.named(max(1, last - keep_runs + 1))
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        swept = []
        for top in sorted({folder.split("/version=")[0] for folder in kept} | self._tops()):
            if not self._exists(f"{self.root}/{top}"):
                continue
            path = F.regexp_extract("path", r"/(version=(\d+)-[0-9a-f]+)/", 1)
            found = files.load(f"{self.root}/{top}").select(path.alias("name")).distinct().filter("name <> ''")
            for row in found.collect():  # one row per version of one table
                folder, run = f"{top}/{row.name}", int(row.name[8:].split("-")[0])
                if run <= last and folder not in kept:
                    swept.append(folder)
        for folder in swept:
            self._delete(f"{self.root}/{folder}")
        return swept

    def _tops(self) -> set[str]:
        """Where versions may lie: every table and entity the log knows."""
        known = self.commits().select("family", "entity", "table_name").distinct().collect()
        tables = {f"{row.family}/{row.table_name}" for row in known}
        beside = {f"_{kind}/{row.family}/{name}" for row in known for kind in BESIDE for name in (row.entity, row.table_name)}
        return tables | beside

    def _exists(self, path: str) -> bool:
        where, files = self._file(path)
        return files.exists(where)

    def _delete(self, path: str) -> None:
        where, files = self._file(path)
        files.delete(where, True)

    def _file(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())


BESIDE = ("quarantine", "unread", "pending", "progress")


@dataclass(frozen=True)
class Place:
    """Where a run puts the versions of a table."""

    table: str
    run: int

    def folder(self) -> str:
        return f"{self.table}/version={self.run:08d}-{uuid.uuid4().hex[:8]}"


def keyed(rows: DataFrame, type_: str) -> Column:
    """The key as the type it is compared in."""
    return widened(F.col(ID), rows.schema[ID].dataType.simpleString(), type_)


def without_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not in a list, which may have another type."""
    type_ = widest([frame.schema[ID].dataType.simpleString() for frame in (rows, keys)])
    listed = keys.select(keyed(keys, type_).alias("_key")).distinct()
    return rows.withColumn("_key", keyed(rows, type_)).join(listed, "_key", "left_anti").drop("_key")


def row_hash(types: dict[str, str]) -> Column:
    """Hash of a row's values by column name: the same with more empty columns, in any order, and when a type is widened."""
    result = F.lit(0).cast("bigint")
    for name, type_ in sorted(types.items()):
        # the column is asked for NULL, not its text, which would then be made twice
        value = F.col(f"`{name}`")
        hashed = F.xxhash64(F.lit(name), as_text(value, type_))
        result = result.bitwiseXOR(F.when(value.isNotNull(), hashed).otherwise(F.lit(0)))
    return result
