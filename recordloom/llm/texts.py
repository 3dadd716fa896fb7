"""What the text operators share: reading tables, staging, Python task settings."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import recordloom
from recordloom.session import configure, stage

__all__ = ["WORD", "batches", "prepare", "read", "ship", "stage", "text_of", "word_count"]

# a word is a run of anything but these six ASCII blanks
WORD = r"[^\x20\x09-\x0D]+"

# One Arrow batch of very long texts must fit in a worker beside its caches.
PYTHON_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


SHIPPED = "spark.recordloom.shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it wherever they run."""
    application = spark.sparkContext.applicationId
    if spark.conf.get(SHIPPED, "") == application:
        return
    root = Path(recordloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="recordloom-")) / "recordloom_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    spark.conf.set(SHIPPED, application)


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on and the code its tasks run; safe to call repeatedly."""
    configure(spark)
    ship(spark)
    for key, value in PYTHON_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("bigint")


def batches(
    rows: DataFrame, columns: dict[str, str], run: Callable[[pa.RecordBatch], dict], schema: str
) -> DataFrame:
    """``run`` over Arrow batches of the named columns, which get fixed names first.

    ``columns`` gives each input name inside the function its column of ``rows``;
    other columns never leave the scan, so their names cannot clash. The function
    returns one array or list per column of ``schema``, where ``{id}`` stands for the type of the ids.
    """
    chosen = rows.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                yield pa.RecordBatch.from_pydict(run(part))

    known = {"id": chosen.schema["doc_id"].dataType.simpleString()} if "doc_id" in columns else {}
    return chosen.mapInArrow(task, schema.format(**known))

