"""Physical lines to logical records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklane.functions.lines import is_record_start
from tracklane.session import scratch_path

# A JVM text value holds no more; a record beyond it stops the job with an error.
LARGEST_TEXT = 2**31 - 1
# Parts of files whose offsets every task may hold.
PARTS_HELD = 200_000


def assemble_records(lines: DataFrame, skip_header: bool = True) -> DataFrame:
    """Rebuild records from ``lines(source_file, block, pos, line)`` of any origin.

    ``block`` orders the parts of a file (0 is the first) and ``pos`` the lines inside a part. Leading
    lines of a part belong to the last earlier part in which a record starts. A light pass finds that
    owner for every part, one row each; then the text is spread once by (file, owner) and each owner
    numbers and joins its records on its own, so one huge file is as parallel as many small ones.
    """
    bare = F.ltrim("line", F.lit("\ufeff"))
    first_part = F.col("block") == 0
    kept = lines.select("source_file", "block", "pos", "line").filter(first_part | (F.col("line") != ""))

    # One row per part: where its first record starts and which earlier part owns the lines before.
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        kept.groupBy("source_file", "block")
        .agg(
            F.min("pos").alias("first_pos"),
            F.min(F.when(is_record_start(bare), F.col("pos"))).alias("first_start"),
            F.sum(F.length("line").cast("bigint") + 1).alias("chars"),
        )
        .withColumn(
            "owner", F.last(F.when(F.col("first_start").isNotNull(), F.col("block")), ignorenulls=True).over(earlier)
        )
        # Only parts in which nothing starts can make a record longer than two parts.
        .withColumn(
            "tail_chars",
            F.sum(F.when(F.col("first_start").isNull(), F.col("chars"))).over(Window.partitionBy("source_file", "owner")),
        )
    )
    leading = F.col("first_start").isNull() | (F.col("pos") < F.col("first_start"))
    # Lines before the first start of a file form one record that is always rejected: one line per part
    # is enough to know it exists.
    no_text = leading & ~first_part & F.col("owner").isNull()
    too_long = F.format_string(
        "%s: the record that begins in part %s is longer than %s characters",
        "source_file", F.col("owner").cast("string"), F.lit(LARGEST_TEXT),
    )
    beyond = leading & F.col("owner").isNotNull() & (F.col("tail_chars") > LARGEST_TEXT)
    line = F.when(beyond, F.raise_error(too_long)).otherwise(F.col("line"))
    owned = (
        kept.join(parts, ["source_file", "block"])
        .withColumn("no_text", F.coalesce(no_text, F.lit(False)))
        .filter(~F.col("no_text") | (F.col("pos") == F.col("first_pos")))
        .select(
            "source_file",
            F.when(leading, F.coalesce("owner", F.lit(0))).otherwise(F.col("block")).alias("owner"),
            "block",
            "pos",
            F.when(F.col("no_text"), F.lit(" ")).otherwise(line).alias("line"),
            "no_text",
        )
    )

    in_order = Window.partitionBy("source_file", "owner").orderBy("block", "pos")
    header = first_part & (F.col("place") == 1) if skip_header else F.lit(False)
    marked = first_part & (F.col("place") == (2 if skip_header else 1))
    numbered = (
        owned.withColumn("place", F.row_number().over(in_order))
        .withColumn("line", F.when(marked, bare).otherwise(F.col("line")))
        .withColumn("start", F.when(~header & is_record_start(F.col("line")), 1).otherwise(0))
        .withColumn("seq", F.sum("start").over(in_order))
        .filter(~header & (F.col("line") != ""))
    )
    # The grouping refines the window's distribution, so the text is not moved again.
    records = numbered.groupBy("source_file", "owner", "seq").agg(
        F.max("no_text").alias("no_text"),
        F.sort_array(F.collect_list(F.struct("block", "pos", "line"))).alias("rows"),
    )
    return records.select(
        "source_file",
        F.col("owner").alias("block"),
        F.col("seq").cast("bigint").alias("seq"),
        F.when((F.col("seq") > 0) & ~F.col("no_text"), F.array_join("rows.line", "\n")).alias("text"),
    )


def range_keys(records: DataFrame) -> list[str]:
    """What tells the files of records apart: the source, and the path where a source may have several files."""
    return ["source_file", *(["path"] if "path" in records.columns else [])]


def with_offsets(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``offset``, the records of a file before each of its parts, from one row a part with ``n`` records."""
    earlier = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def number_records(records: DataFrame) -> DataFrame:
    """Add ``record_no``, the 1-based place of a record in its file, rejected ones included.

    Parts of files are counted first, one row each. As long as these are few enough for every task to hold (a part is up to
    128 MB of text, so PARTS_HELD of them are some 25 TB), the text is not moved to be numbered.
    """
    keys = range_keys(records)
    path = scratch_path(records.sparkSession, "parts")
    counted = records.groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"))
    counted.write.parquet(path)
    parts = records.sparkSession.read.schema(counted.schema).parquet(path)
    offsets = with_offsets(parts, keys).drop("n")
    if parts.count() <= PARTS_HELD:
        offsets = F.broadcast(offsets)
    return (
        records.join(offsets, [*keys, "block"])
        .withColumn("record_no", F.col("offset") + F.col("seq") - F.col("first_seq") + 1)
        .drop("offset", "first_seq")
    )


def limit_records(records: DataFrame, per_file: int) -> DataFrame:
    """The first ``per_file`` records of each file; 0 keeps all."""
    if per_file <= 0:
        return records
    return number_records(records).filter(F.col("record_no") <= per_file).drop("record_no")
