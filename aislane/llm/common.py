"""What the operators of this package share: tables, staging, hashing and words."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aislane.session import configure, scratch_path

# Rows per Arrow batch. A batch of long documents stays some tens of MB.
ARROW_ROWS = 512

# A-Z to a-z on UTF-8 bytes; other bytes stay.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

# A-Z to a-z, every other ASCII byte but a-z and 0-9 to a space.
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
    for b in range(256)
)


def ready(spark: SparkSession) -> SparkSession:
    """The session with the options that the operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's option to delete a query's shuffle files when the query ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffles of writes in this block leave the executors' disks once the table stands; nothing reads them again."""
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def staged(frame: DataFrame, name: str, free: bool = False, **options: str) -> DataFrame:
    """``frame`` written to the shared folder and read again, which cuts its lineage; ``free`` as in ``freed_shuffles``."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    with freed_shuffles(spark) if free else nullcontext():
        frame.write.options(**options).parquet(path)
    return spark.read.parquet(path)


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A key of id and text; with the text's length it tells rows apart also where ids are null or repeat."""
    return F.xxhash64(F.col(id_column).cast("long"), F.coalesce(F.col(text_column).cast("string"), F.lit("")))


def text_length(column: str = "text") -> Column:
    return F.length(F.coalesce(F.col(column).cast("string"), F.lit("")))


def fold_remainder(id_column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


# Bytes of a column that are worked on at once.
PIECE_BYTES = 8 << 20


def by_bytes(batch: pa.RecordBatch, column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows with at most ``most`` bytes in the column, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, "right"))
        stop = max(begin + 1, stop)
        yield batch.slice(begin, stop - begin)
        begin = stop


def gathered(batches: Iterable[pa.RecordBatch], column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in their order, in batches of at most ``most`` bytes in all, or one row of ``by_bytes``."""
    held, size = [], 0
    for batch in batches:
        for some in by_bytes(batch, column, most):
            if held and size + some.nbytes > most:
                yield pa.concat_batches(held)
                held, size = [], 0
            held.append(some)
            size += some.nbytes
    if held:
        yield pa.concat_batches(held)


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker: later tasks find what earlier ones worked out."""
    return sys.modules.setdefault("_aislane_worker_store", types.ModuleType("_aislane_worker_store")).__dict__
