"""Helpers the operators share: safe column selection, ragged numpy arrays, files in the shared folder."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import session
from orderflow.session import fresh_path, shared_dir

BATCH_ROWS = 1000  # rows of texts or words that a task hands to Python at once
LARGE_GROUP = 1 << 20  # bytes of a group after which memory is given back; for smaller ones it would take longer than their work
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Whatever runs meanwhile sends at most ``BATCH_ROWS`` rows to Python at once, or fewer if the session says so."""
    before = spark.conf.get(_BATCH_SETTING)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """As ``session.stage``, in short batches: a batch is held by the executor and by its Python worker."""
    with short_batches(df.sparkSession):
        return session.stage(df, label)


def give_back() -> None:
    """Return freed memory to the system: workers outlive their tasks, and idle ones would keep what they once used."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def released(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` over the batches of a task, whose memory goes back to the system at its end."""

    @wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def released_groups(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``work`` on the groups of a task; after a large one its memory goes back to the system."""

    @wraps(work)
    def run(table: pa.Table) -> pa.Table:
        out = work(table)
        if table.nbytes > LARGE_GROUP:
            give_back()
        return out

    return run


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def documents(df: DataFrame, *extra: str) -> DataFrame:
    """Only ``doc_id``, ``text`` (null as empty) and the named columns, so that no other name can clash."""
    return df.select(df["doc_id"].cast("long").alias("doc_id"), text_of(df).alias("text"), *[df[c].alias(c) for c in extra])


def hash_sample(df: DataFrame, size: int, *columns: str) -> DataFrame:
    """At most ``size`` rows, those of the smallest hashes; hardly more than these leave their tasks."""
    n = df.count()
    code = F.xxhash64(*columns)
    if n > 2 * size:
        df = df.filter(code <= int((2.0 * (1.2 * size / n) - 1.0) * 2**63))
    return df.orderBy(code, *columns).limit(size)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))


def ragged_take(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a ragged array one after another, and their lengths."""
    starts, lengths = offsets[rows], offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(lengths)
    index = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64)
    index += np.repeat(starts - (ends - lengths), lengths)
    return values[index], lengths


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each row of a ragged array; empty rows give 0."""
    total = offsets_of(values)
    return total[offsets[1:]] - total[offsets[:-1]]


def list_offsets(lists: pa.ListArray) -> np.ndarray:
    """Offsets of a list array counted from its own first value."""
    raw = np.asarray(lists.offsets, dtype=np.int64)
    return raw - raw[0]


def string_buffers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the offsets of its values."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def put_file(spark: SparkSession, label: str, data: bytes) -> str:
    """Store ``data`` as a file of the shared folder, through the file system Spark itself uses."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{fresh_path(spark, 'files')}/{label}-{uuid.uuid4().hex}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    for at in range(0, len(data), 1 << 20):
        out.write(bytearray(data[at : at + (1 << 20)]))
    out.close()
    return path.toString()


def ship_file(spark: SparkSession, label: str, data: bytes) -> str:
    """Give ``data`` to every executor, present or to come; returns the name for ``SparkFiles.get``."""
    uri = put_file(spark, label, data)
    spark.sparkContext.addFile(uri)
    return uri.rsplit("/", 1)[1]


def shared_uri(spark: SparkSession, label: str) -> str:
    """A fresh folder of the shared space as a URI that pyarrow can open inside tasks."""
    path = fresh_path(spark, label)
    return path if "://" in path else "file://" + path.removeprefix("file:")


__all__ = [
    "documents", "give_back", "hash_sample", "list_offsets", "offsets_of", "put_file", "ragged_take", "released", "released_groups", "row_sums", "shared_dir", "shared_uri",
    "ship_file", "short_batches", "stage", "string_buffers", "text_of",
]
