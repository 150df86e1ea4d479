"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.shipping import ship

#: While set, Spark deletes an execution's shuffle files as soon as it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir``; the path may be one that only Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset, as in
    local tests, a temporary folder is made and set; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    base = tempfile.mkdtemp(prefix="samewise-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/samewise/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, settings: dict[str, str] | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder (under these settings of the session) and read it back: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = new_path(spark, label)
    held = {name: spark.conf.get(name) for name in settings or {}}
    try:
        for name, value in (settings or {}).items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in held.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path), path


def stored_alone(df: DataFrame, label: str, **settings: str) -> tuple[DataFrame, str]:
    """:func:`stored`, and the shuffle files behind it go at once: for steps whose shuffles would otherwise lie on the disk together."""
    return stored(df, label, {_CLEANUP: "true", **settings})


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete written tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case and all else as it is; ``lower`` does the same to a text that is all ASCII, but faster."""
    return F.when(F.octet_length(column) == F.length(column), F.lower(column)).otherwise(F.translate(column, ASCII_UPPER, ASCII_LOWER))


def prepared(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Ship this package, and let no more than ``rows`` rows or about ``size`` bytes pass to a Python worker at once: whole texts may be long."""
    ship(spark)
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        held = spark.conf.get(name).removesuffix("b")
        if not (held.isdigit() and 0 < int(held) <= most):
            spark.conf.set(name, most)


def give_back() -> None:
    """Return what this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mapped(frame: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``frame`` through an Arrow function; workers outlive their tasks, so each gives its memory back at the end of one."""
    prepared(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return frame.mapInArrow(run, schema)


def runs_of(texts: list[str], most_chars: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most_chars`` characters, at least one text each."""
    begin, held = 0, 0
    for at, text in enumerate(texts):
        if held and held + len(text) > most_chars:
            yield begin, at
            begin, held = at, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)
