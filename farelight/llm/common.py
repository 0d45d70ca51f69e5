"""What the operators of this package share: reading, batches, words, folds and digests."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024


def bound_batches(spark: SparkSession) -> None:
    """Send at most ``BATCH_ROWS`` rows to Python at a time, unless the session says otherwise.

    Texts differ in length by many powers of ten, so Spark's 10,000 rows a batch are no
    bound on memory that a small executor can live with.
    """
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of a folder; Spark alone opens it."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc32_of(column: str) -> Column:
    """crc32 of a value written as text; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; no text has none."""
    return [] if text is None else text.encode().split()


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def map_rows(
    df: DataFrame,
    schema: str | T.StructType,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    after: Callable[[], None] | None = None,
) -> DataFrame:
    """``mapInArrow`` for a function from batch to batch; ``after`` is called at the end of a task.

    Spark keeps a worker for the tasks and stages that follow, so what Arrow has freed is given
    back then, too.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                if batch.num_rows and (out := work(batch)) is not None:
                    yield out
        finally:
            if after is not None:
                after()
            pa.default_memory_pool().release_unused()

    bound_batches(df.sparkSession)
    return df.mapInArrow(each, schema)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, wherever the session was started.

    Spark sends the zip from the driver; nothing is shared through local folders.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="farelight-package-")) / "farelight.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)
