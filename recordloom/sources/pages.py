"""Landed pages: reading them back into records, and cutting records into pages.

A page is the body of one response. Pages are landed either one file per page
(``<number>.json``, read whole) or packed, as a Parquet table of ``page, body``
rows; the second form avoids one file per hundred records at scale. Pages are
decoded in parallel, and the point where a page-by-page reader would have
stopped is found from the page sizes alone. Several landings of one collection
lie in folders ``run_id=<n>``; each is a scan of its own, and later ones come later.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.functions import variant as V
from recordloom.operators.catalogue import Merged, stage_records
from recordloom.session import shuffle_partitions, stage

PAGE_SIZE = 100  # fixed value: records per full page, unless a family says otherwise
PACKED_SCHEMA = "page bigint, body string, run_id bigint"
NOTHING = ("", "0", "0.0", "false", '""', "{}", "[]")  # cursor values that end a scan


def read_page_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``page, body`` of page files; None where the collection was never landed."""
    return _existing(lambda: whole_pages(spark.read.text(path, wholetext=True)))


def whole_pages(files: DataFrame) -> DataFrame:
    """``page, body`` of files read whole, numbered by their names."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1).cast("bigint")
    return files.select(number.alias("page"), F.col("value").alias("body"), run_id(files))


def run_id(pages: DataFrame) -> Column:
    """The landing a page belongs to, 0 where there is just one."""
    known = F.col("run_id") if "run_id" in pages.columns else F.lit(None)
    return F.coalesce(known.cast("bigint"), F.lit(0).cast("bigint")).alias("run_id")


def read_packed_pages(spark: SparkSession, path: str) -> DataFrame | None:
    return _existing(lambda: spark.read.schema(PACKED_SCHEMA).parquet(path))


def _existing(read) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# Text longer than this is not parsed as one VARIANT, which can hold 128 MiB, but record by record. FAILFAST, as small pages are
# parsed: text that is no JSON ends the run instead of reading as an empty page.
BIG_BODY = 32 << 20
STRICT = {"mode": "FAILFAST"}


def _parsed() -> tuple[Column, Column]:
    """The body as a VARIANT, NULL where it is too big for that, and the body where it is."""
    big = F.length("body") > BIG_BODY
    return F.parse_json(F.when(~big, F.col("body"))), F.when(big, F.col("body"))


def decode_offset(pages: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """``run_id, page, items, last``: the body is a list or ``{"value": [...]}``.

    Any other body is an empty page, but for a big one whose ``value`` is neither a list nor null: that is an error. A page short of
    the full size is the last.
    """
    small, big = _parsed()
    body = pages.select(run_id(pages), "page", small.alias("v"), big.alias("big"))
    v, opening = F.col("v"), F.regexp_extract("big", r"^\s*(.)", 1)
    listed = F.from_json(F.when(opening == "[", F.col("big")), "array<variant>", STRICT)
    wrapped = F.from_json(F.when(opening == "{", F.col("big")), "value array<variant>", STRICT)["value"]
    items = F.coalesce(V.as_list(v), V.as_list(v, ("value",)), listed, wrapped)
    return body.select("run_id", "page", items.alias("items")).withColumn("last", F.size("items") < page_size)


def decode_cursor(pages: DataFrame, collection: str, root: str = "organization") -> DataFrame:
    """``run_id, page, items, last``: nodes and cursor under ``root.collection``.

    Missing or null levels read as no nodes. No cursor means the last page.
    """
    small, big = _parsed()
    body = pages.select(run_id(pages), "page", small.alias("v"), big.alias("big"))
    v, schema = F.col("v"), f"`{root}` struct<`{collection}`: struct<nodes: array<variant>, nextPage: variant>>"
    inner = F.from_json("big", schema, STRICT)[root][collection]
    cursor = F.coalesce(V.pick(v, (root, collection, "nextPage")), inner["nextPage"])
    items = F.coalesce(V.as_list(v, (root, collection, "nodes")), inner["nodes"])
    ends = cursor.isNull() | F.is_variant_null(cursor) | F.to_json(cursor).isin(*NOTHING)
    return body.select("run_id", "page", items.alias("items"), ends.alias("last"))


@dataclass(frozen=True)
class Unread:
    """Landed pages a scan does not reach: how many, the first as ``run_id:page``, and ``run_id, page, reason`` of all."""

    pages: int = 0
    first: str | None = None
    rows: DataFrame | None = None


NO_FIRST, AFTER_END, AFTER_GAP, READ_BEFORE = "no first page", "after the end", "after a gap", "read before"


def scan(decoded: DataFrame) -> DataFrame:
    """``run_id, page, pos, v`` of every record a page-by-page reader reaches.

    Reading a landing stops after the first page marked last or empty, and before the first page that was not landed.
    """
    records = decoded.select("run_id", "page", F.posexplode("items").alias("pos", "v"))
    ends = F.coalesce(F.col("last") | (F.size("items") <= 0), F.lit(True))
    stops = _stops(decoded.select("run_id", "page", ends.alias("last")))
    return records.join(stops.select("run_id", "stop"), "run_id").filter("page <= stop").drop("stop")


@dataclass(frozen=True)
class Staged:
    """Decoded pages with their records, staged: the text is parsed once."""

    rows: DataFrame  # run_id, page, last, pos, v; a page without records is one row without pos and v
    merged: Merged  # merged schema of all records, reached or not

    @property
    def heads(self) -> DataFrame:
        """``run_id, page, last`` of every page; one without records is always the last."""
        first = self.rows.filter("pos is null or pos = 0")
        return first.select("run_id", "page", F.coalesce(F.col("last") | F.col("pos").isNull(), F.lit(True)).alias("last"))

    @property
    def records(self) -> DataFrame:
        return self.rows.filter("pos is not null").drop("last")


def stage_pages(decoded: DataFrame) -> Staged:
    exploded = decoded.select("run_id", "page", "last", F.posexplode_outer("items").alias("pos", "v"))
    return Staged(*stage_records(exploded, "records"))


def scan_staged(decoded: DataFrame) -> tuple[DataFrame, Merged | None, Unread]:
    """The records of ``scan``, staged first, with their merged schema and the pages left unread.

    The text is parsed once, and the stop points read few narrow columns. The
    schema is unknown (None) if it saw pages past one.
    """
    pages = stage_pages(decoded)
    heads = pages.heads
    stops = stage(_stops(heads), "stops")  # a row per landing
    if stops.filter("stop is null or stop < highest").isEmpty():
        return pages.records, pages.merged, Unread()
    reached = pages.records.join(stops.select("run_id", "stop"), "run_id").filter("page <= stop").drop("stop")
    return reached, None, unread_pages(heads, stops)


def unread_pages(heads: DataFrame, stops: DataFrame) -> Unread:
    """The pages no scan reaches: an anti join of the landed pages with what ``stops`` says was reached."""
    past = F.col("stop").isNull() | (F.col("page") > F.col("stop"))
    why = F.when(F.col("stop").isNull(), NO_FIRST).when(F.col("ended"), AFTER_END).otherwise(AFTER_GAP)
    beyond = heads.select("run_id", "page").join(stops, "run_id").filter(past)
    rows = stage(beyond.select("run_id", "page", why.alias("reason")).distinct(), "unread")
    found = rows.agg(F.count("*").alias("n"), F.min(F.struct("run_id", "page")).alias("first")).first()
    return Unread(found.n, f"{found.first.run_id}:{found.first.page}", rows) if found.n else Unread()


def _stops(heads: DataFrame, begun: DataFrame | None = None) -> DataFrame:
    """Per landing: the last page reached, NULL when there is none, whether the scan ended there, and the highest page.

    A page ends the scan if it is marked last or no page follows it. Whether one
    follows is found by letting every page vouch for the one before, which
    groups by page number and so spreads evenly. A scan starts at page 0, or at ``next`` where ``begun`` has the landing.
    """
    own = heads.select("run_id", "page", F.col("last"), F.lit(False).alias("followed"))
    page = (F.col("page") - 1).alias("page")
    before = heads.select("run_id", page, F.lit(None).alias("last"), F.lit(True).alias("followed"))
    both = own.unionByName(before).groupBy("run_id", "page")
    known = both.agg(F.max("last").alias("last"), F.max("followed").alias("followed"))
    real = known.filter(F.col("last").isNotNull())
    if begun is None:
        real = real.withColumn("next", F.lit(0).cast("bigint"))
    else:
        real = real.join(begun.select("run_id", "next"), "run_id", "left").fillna(0, ["next"])
    end = F.min(F.when(F.col("last") | ~F.col("followed"), F.struct("page", F.col("last").alias("ended"))))
    stops = real.groupBy("run_id").agg(
        F.min("page").alias("lowest"), F.max("next").alias("next"), end.alias("end"), F.max("page").alias("highest")
    )
    starts = F.col("lowest") == F.col("next")
    stop = F.when(starts, F.col("end")["page"]).alias("stop")
    ended = F.coalesce(starts & F.col("end")["ended"], F.lit(False)).alias("ended")
    return stops.select("run_id", "next", stop, ended, "highest")


@dataclass(frozen=True)
class Continued:
    """What a trigger makes of landings that arrive piece by piece."""

    records: DataFrame
    merged: Merged | None
    unread: Unread
    pending: DataFrame  # run_id, page, body of pages that wait for one before them
    progress: DataFrame  # run_id, next, ended of every landing met so far


def continue_scan(pages: DataFrame, progress: DataFrame | None, decode_pages) -> Continued:
    """Go on reading landings where the triggers before left off.

    ``pages`` are ``run_id, page, body`` of new pages and of those that were waiting. Every landing is read on from its ``next``
    page up to the first that is missing; pages past that wait, for a later trigger may bring it. Past a landing's end, and
    before ``next``, pages are unread for good. A page that waits twice counts once. What is read over all triggers is
    what one scan of the whole landing reads.
    """
    pages = stage(pages.select("run_id", "page", "body"), "pages")
    once = pages.groupBy("run_id", "page").agg(F.max("body").alias("body"))
    staged = stage_pages(decode_pages(once))
    heads = staged.heads
    if progress is None:
        progress = pages.sparkSession.createDataFrame([], "run_id bigint, next bigint, ended boolean")
    begun = progress.withColumnsRenamed({"next": "begins", "ended": "done"})
    known = heads.join(begun, "run_id", "left").fillna({"begins": 0, "done": False})
    late = known.filter("done or page < begins")
    fresh = stage(known.filter("not done and page >= begins").select("run_id", "page", "last"), "heads")
    stops = stage(_stops(fresh, progress), "stops")
    reached = fresh.join(stops, "run_id").filter("page <= stop")
    read = staged.records.join(reached.select("run_id", "page"), ["run_id", "page"], "left_semi")
    beyond = fresh.join(stops, "run_id").filter("stop is null or page > stop")
    waiting = beyond.filter("not ended").select("run_id", "page")
    why = F.when(F.col("page") >= F.col("begins"), AFTER_END).otherwise(READ_BEFORE)
    skipped = late.select("run_id", "page", why.alias("reason")).unionByName(
        beyond.filter("ended").select("run_id", "page", F.lit(AFTER_END).alias("reason"))
    )
    skipped = stage(skipped, "unread")
    found = skipped.agg(F.count("*").alias("n"), F.min(F.struct("run_id", "page")).alias("first")).first()
    unread = Unread(found.n, f"{found.first.run_id}:{found.first.page}", skipped) if found.n else Unread()
    everything = not found.n and waiting.isEmpty()
    pending = once.join(waiting, ["run_id", "page"], "left_semi")
    moved = stops.select("run_id", F.coalesce(F.col("stop") + 1, F.col("next")).alias("next"), "ended")
    kept = progress.join(moved, "run_id", "left_anti").select("run_id", "next", "ended")
    return Continued(read, staged.merged if everything else None, unread, pending, kept.unionByName(moved))


def decode(
    pages: DataFrame, paging: str, collection: str | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    return decode_cursor(pages, collection) if paging == "cursor" else decode_offset(pages, page_size)


def numbered(records: DataFrame, order: list[str], page_size: int = PAGE_SIZE) -> DataFrame:
    """Add ``page, pos``: consecutive pages of ``page_size`` in the given order.

    ``order`` must be unique. A global row number would pull all rows through
    one task. Here each range of the sorted data numbers its own rows, and only
    the row counts, one per range, are summed up in one place.
    """
    ranges = records.repartitionByRange(shuffle_partitions(records), *order).sortWithinPartitions(*order)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = stage(ranges.select("*", F.spark_partition_id().alias("_range"), within.alias("_within")), "ranges")
    counts = kept.groupBy("_range").agg(F.count("*").alias("_rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    # one row per shuffle partition, so its size is bounded by that setting
    placed = kept.join(F.broadcast(starts), "_range").withColumn("_row", F.col("_start") + F.col("_within"))
    page = F.floor(F.col("_row") / page_size).cast("bigint")
    pos = (F.col("_row") % page_size).cast("int")
    return placed.select(*records.columns, page.alias("page"), pos.alias("pos"))


def page_lists(paged: DataFrame, record: str) -> DataFrame:
    """``page, list``: the JSON list of each page's records; a page is one bounded group."""
    items = F.array_sort(F.collect_list(F.struct("pos", record)))
    text = F.concat(F.lit("["), F.array_join(F.transform(items, lambda i: i[record]), ","), F.lit("]"))
    return paged.groupBy("page").agg(text.alias("list"))


def envelope(items: Column) -> Column:
    return F.concat(F.lit('{"value":'), items, F.lit("}"))


def cursor_body(items: Column, collection: str, next_page: Column, root: str = "organization") -> Column:
    """Body of a cursor page; ``next_page`` is NULL on the last one."""
    cursor = F.coalesce(F.concat(F.lit('"'), next_page.cast("string"), F.lit('"')), F.lit("null"))
    head = F.lit(f'{{"{root}":{{"{collection}":{{"nodes":')
    return F.concat(head, items, F.lit(',"nextPage":'), cursor, F.lit("}}}"))


def write_packed_pages(pages: DataFrame, path: str) -> None:
    pages.select(F.col("page").cast("bigint"), "body").write.parquet(path)


def head(records: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` records in page order.

    Pages are looked at from the first on, so that records of later ones are not even parsed: the page numbers
    alone say which pages hold the first ``n``.
    """
    places = records.select("page", "pos").orderBy("page", "pos").limit(n)
    return records.join(F.broadcast(places), ["page", "pos"], "left_semi").orderBy("page", "pos").limit(n)
