"""Versioned datasets: rows are written beside the ones in use, and one rename lets every reader see them at once.

A store is a folder with numbered manifests. A manifest lists, for every dataset of the store, its sources and the version
folder that holds each; the highest number is the state. A commit writes the next manifest aside and renames it to its
number, so several datasets change together, a reader sees all of a change or nothing of it, and of two writers that began
from the same state one fails. Sources of a batch leave with their old rows even if they have none now.

    <dataset>/_store                          names the store and the dataset in it
    <dataset>/version=<v>/                    rows of all sources of a version; earlier ones have a folder for each source
    <store>/_datasets/<dataset>               names the dataset's folder
    <store>/_manifests/<number>/              dataset, source_file, version, sources

Manifests are tables that Spark writes and joins; the driver lists manifest numbers and version folders only.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "dataset string, source_file string, version string, sources bigint"
_POINTER = "_store"
#: Manifests that stay readable after a commit, for readers that have begun.
KEPT = 3
_IDENTIFIER = re.compile(r"^[A-Za-z0-9_]+$")


class StaleState(RuntimeError):
    """Another writer has committed since this one began."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.delete(at, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(at)] if fs.exists(at) else []


def _note(spark: SparkSession, path: str) -> dict | None:
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _write_note(spark: SparkSession, path: str, note: dict) -> None:
    fs, at = _fs(spark, path)
    stream = fs.create(at, True)
    stream.write(bytearray(json.dumps(note).encode()))
    stream.close()


def store_of(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(store, dataset) of a dataset's folder; none if the folder is no versioned dataset."""
    note = _note(spark, f"{path.rstrip('/')}/{_POINTER}")
    return (note["store"], note["dataset"]) if note else None


def register(spark: SparkSession, path: str, store: str, dataset: str) -> tuple[str, str]:
    """(store, dataset) of a dataset's folder, as it was first registered. A name that another folder has gets a suffix."""
    path, store = path.rstrip("/"), store.rstrip("/")
    if found := store_of(spark, path):
        return found
    if not _IDENTIFIER.match(dataset):
        raise ValueError(f"dataset name may hold only letters, digits and _: {dataset!r}")
    if (_note(spark, f"{store}/_datasets/{dataset}") or {"path": path})["path"] != path:
        dataset = f"{dataset}_{zlib.crc32(path.encode()):08x}"
    _write_note(spark, f"{store}/_datasets/{dataset}", {"path": path})
    _write_note(spark, f"{path}/{_POINTER}", {"store": store, "dataset": dataset})
    return store, dataset


def state(spark: SparkSession, store: str) -> int:
    """Number of the newest manifest; 0 before the first commit."""
    return max((int(n) for n in _names(spark, f"{store}/_manifests") if n.isdigit()), default=0)


def manifest(spark: SparkSession, store: str, number: int) -> DataFrame:
    if not number:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{store}/_manifests/{number:010d}")


def version_folder(spark: SparkSession, path: str, run_id: str) -> tuple[str, str]:
    """(version, folder) for a run's rows of a registered dataset. Nobody reads it before a commit; a run that is repeated
    before its commit uses it again."""
    if not _IDENTIFIER.match(run_id):
        raise ValueError(f"run id may hold only letters, digits and _: {run_id!r}")
    store, _ = store_of(spark, path)
    version = f"{state(spark, store) + 1:010d}_{run_id}"
    return version, f"{path.rstrip('/')}/version={version}"


def sources_in(spark: SparkSession, folder: str) -> DataFrame:
    """The sources that have rows in a folder written by source."""
    try:
        return spark.read.schema("source_file string").parquet(folder).select("source_file").distinct()
    except Exception as error:  # noqa: BLE001 - nothing was written
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "source_file string")


def commit(spark: SparkSession, store: str, base: int, changes: dict[str, tuple[str, str]], read: DataFrame | None = None, snapshot: bool = False) -> int:
    """Make the version folders of ``changes`` (dataset → version, folder) the state that follows ``base``.

    They replace the sources they hold and those in ``read``, or with ``snapshot`` all sources of their datasets.
    """
    if state(spark, store) != base:
        raise StaleState(f"{store} has changed since state {base}")
    before = manifest(spark, store, base)
    rest = before.where(~F.col("dataset").isin(list(changes)))
    for dataset, (version, folder) in changes.items():
        own = sources_in(spark, folder)
        if not snapshot:
            gone = own if read is None else own.unionByName(read.select("source_file")).distinct()
            rest = rest.unionByName(before.where(F.col("dataset") == dataset).join(gone, "source_file", "left_anti").select(*before.columns))
        sources = F.lit(own.count()).cast("bigint")
        rest = rest.unionByName(own.select(F.lit(dataset).alias("dataset"), "source_file", F.lit(version).alias("version"), sources.alias("sources")))
    aside = f"{store}/_manifests/_next_{next(iter(changes.values()))[0]}"
    rest.write.mode("overwrite").parquet(aside)
    _rename(spark, aside, f"{store}/_manifests/{base + 1:010d}", base)
    tidy(spark, store)
    return base + 1


def _rename(spark: SparkSession, aside: str, final: str, base: int) -> None:
    """One rename that fails if the target is there, as another writer's commit would be."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(final)
    context = hadoop.FileContext.getFileContext(_fs(spark, aside)[0].getUri(), spark._jsc.hadoopConfiguration())
    if _exists(spark, final):
        raise StaleState(f"state {base + 1} was committed by another writer")
    try:
        context.rename(hadoop.Path(aside), at, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error):
            raise StaleState(f"state {base + 1} was committed by another writer") from None
        raise


def tidy(spark: SparkSession, store: str, kept: int = KEPT) -> None:
    """Remove all but the newest manifests, and the version folders that only removed ones name."""
    numbers = sorted(int(n) for n in _names(spark, f"{store}/_manifests") if n.isdigit())
    old, live = numbers[:-kept], numbers[-kept:]
    if not old:
        return

    def named(which: Iterable[int]) -> set[tuple[str, str]]:
        paths = [f"{store}/_manifests/{n:010d}" for n in which]
        found = spark.read.schema(_MANIFEST).parquet(*paths).select("dataset", "version").distinct()
        return {(r["dataset"], r["version"]) for r in found.collect()}  # as many as version folders

    for dataset, version in named(old) - named(live):
        delete(spark, f"{_note(spark, f'{store}/_datasets/{dataset}')['path']}/version={version}")
    for number in old:
        delete(spark, f"{store}/_manifests/{number:010d}")


def read(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """The rows of a versioned dataset in its newest state, or in an earlier one that is still kept."""
    store, dataset = store_of(spark, path)
    listed = manifest(spark, store, state(spark, store) if number is None else number).where(F.col("dataset") == dataset)
    # One row a version: those all of whose sources are in use need no look at single sources.
    versions = listed.groupBy("version").agg(F.count(F.lit(1)).alias("used"), F.max("sources").alias("sources")).collect()
    if not versions:
        return spark.createDataFrame([], schema)
    stored = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    # Only the folders in use are listed; those with folders for their sources are a table of their own.
    layouts: dict[bool, list[str]] = {}
    for v in versions:
        folder = f"{path.rstrip('/')}/version={v['version']}"
        layouts.setdefault(any(name.startswith("source_file=") for name in _names(spark, folder)), []).append(folder)
    scans = [spark.read.schema(stored).option("basePath", path).parquet(*folders) for folders in layouts.values()]
    rows = reduce(DataFrame.unionByName, scans)
    if any(v["used"] < v["sources"] for v in versions):
        rows = rows.join(listed.select("version", "source_file"), ["version", "source_file"], "left_semi")
    return rows.select(*schema.fieldNames())
