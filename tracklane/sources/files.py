"""Plain files: discovery, content hashes, text lines, Parquet layers and catalog tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane.operators import versions
from tracklane.sources.storage import label_files, open_bytes, relative_name

_FILES = "path string, source_file string, size bigint"


def read_lines(spark: SparkSession, path: str, label: str = "name") -> DataFrame:
    """``lines(source_file, block, pos, line)`` of text files in a folder and its subfolders; blocks are byte splits.

    Sources are called by file ``name``, which must not repeat, or by ``path`` below the folder.
    """
    scan = spark.read.option("recursiveFileLookup", "true").text(path)
    root = _inner(path)
    label_files([relative_name(_inner(unquote(f)), root) for f in scan.inputFiles()], label)
    named = F.col("_metadata.file_name")
    if label == "path":
        # A blank is %20 in a file's address, a plus is itself.
        address = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        below = F.substring(address, F.locate(root + "/", address) + len(root) + 1, F.length(address))
        named = F.when(F.contains(address, F.lit(root + "/")), below).otherwise(named)
    return scan.select(
        named.alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        # Increases along a split, which is all the order a block needs.
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def _inner(path: str) -> str:
    """A path without scheme and authority, and without a slash at its end."""
    rest = path.split("://", 1)[-1] if "://" in path else path.removeprefix("file:")
    return ("/" + rest.split("/", 1)[-1] if "://" in path and not rest.startswith("/") else rest).rstrip("/")


def discover_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``files(path, source_file, size)`` in a folder, in name order; none if the folder is missing."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .schema("path string, modificationTime timestamp, length bigint, content binary")
    )
    try:
        found = listing.load(folder)
    except Exception as error:  # noqa: BLE001 - only a missing folder means "no files"
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], _FILES)
    return found.select(
        "path", F.substring_index("path", "/", -1).alias("source_file"), F.col("length").alias("size")
    ).orderBy("source_file")


def hash_files(files: DataFrame) -> DataFrame:
    """Add ``file_hash``, the SHA-256 of each file, read in chunks where the file lives."""

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["file_hash"] = [_sha256(path) for path in batch["path"]]
            yield batch

    schema = T.StructType(files.schema.fields + [T.StructField("file_hash", T.StringType())])
    return files.repartition(F.col("path")).mapInPandas(digest, schema)


def _sha256(path: str) -> str:
    total = hashlib.sha256()
    with open_bytes(path) as stream:
        while chunk := stream.read(1 << 20):
            total.update(chunk)
    return total.hexdigest()


def read_layer(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored layer under its declared schema, columns in contract order; of a versioned one the newest state."""
    if versions.store_of(spark, path):
        return versions.read(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def register_sources(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Make DataFrames readable by name; dots in a source name become underscores."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name.replace(".", "_"))


def read_source(spark: SparkSession, name: str) -> DataFrame:
    """A source by name: a registered view, else a catalog table."""
    view = name.replace(".", "_")
    return spark.table(view if spark.catalog.tableExists(view) else name)


def dataset_metrics(df: DataFrame, keys: list[str], frame_count: str | None = None) -> DataFrame:
    """Row count, distinct sources, distinct keys and frame total, reading only the columns needed."""
    total = F.sum(frame_count) if frame_count else F.sum(F.lit(0).cast("bigint"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), total.alias("frames"))
    per_source = per_key.groupBy("source_file").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("grain"), F.sum("frames").alias("frames")
    )
    return per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("source_file").alias("source_count"),
        F.coalesce(F.sum("grain"), F.lit(0)).alias("distinct_grain"),
        F.coalesce(F.sum("frames"), F.lit(0)).alias("sum_frame_count"),
    )
