"""Helpers of several operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklane.session import scratch_path

#: ASCII white space, as the size and shingle rules of this subpackage define it.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows go to a Python worker by so many bytes at once, as the session setting of this name says.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither recompute it nor need its executors."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python by BATCH_BYTES, unless the session has a size of its own: 10,000 rows at once,
    Spark's default, hold as much memory in the executor and in its Python workers as their texts are long."""
    if spark.conf.get(BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(BATCH_SETTING)


def crc32(key: Column) -> Column:
    """crc32 of the key as text; null for a null key."""
    return F.crc32(key.cast("string").cast("binary"))


def fold(key: Column, folds: int) -> Column:
    """Which fold a row is in: crc32 of the key as text, modulo ``folds``."""
    return F.pmod(crc32(key), F.lit(folds))
