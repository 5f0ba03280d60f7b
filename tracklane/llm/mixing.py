"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with the copy count target / source size. The whole part of it is certain; the fraction is a
probability. Two fractional documents trade mass in proportion to one over their size until one is integral, which
leaves the source's expected words and every document's own expectation unchanged. Trading runs inside blocks of
documents (block = hash of the document, so a hot source is many blocks) and leaves one fractional document per block;
the residuals of up to FAN blocks trade at the next level of a tree, until one is left per source and is drawn. So a
source's taken words miss its target by less than the size of one document, as a rule a small one.

Edge cases: null text has size 0, is never taken and moves no mass; sources sort by code point with null last (null is a
source of its own); a source whose documents are all empty has target 0; an empty table gives an empty result. Rows that
repeat are separate documents. The draws depend only on keys and sizes, so reruns agree. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm.common import WORD, stored
from tracklane.llm.hashing import mix

BLOCK_ROWS, FAN = 4096, 256
#: A probability this close to 0 or 1 is taken as integral.
EPS = 1e-9


def text_size(text: Column) -> Column:
    """Number of words (runs of anything but ASCII white space); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Per source: source_size, docs and target. Weights repeat over the sources in order; what a cap cuts off is shared anew.

    Sorted by cap per weight, the capped sources are a prefix: source i is capped if an equal level for it and all later
    ones would lie above its own cap. One row per source goes through the two windows.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("weight", given).withColumn("most", cap * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    by = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - before) / F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing))
    # Behind the first source that is free the levels fall: they count free sources as capped.
    shared = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    levels = ranked.withColumn("level", level).withColumn("shared", shared)
    return levels.select("source", "source_size", "docs", F.when(F.col("ratio") >= F.col("shared"), F.col("shared") * F.col("weight")).otherwise(F.col("most")).alias("target"))


def _trade(p: np.ndarray, size: np.ndarray, seed: int) -> int | None:
    """Round ``p`` in place, keeping sum(p * size) and each expectation; returns the place still fractional, if any."""
    rng = np.random.Generator(np.random.PCG64(seed))
    holder = None
    for k in range(len(p)):
        if p[k] <= EPS or p[k] >= 1 - EPS:
            p[k] = round(p[k])
            continue
        if holder is None:
            holder = k
            continue
        i, j = holder, k
        # Words that can go from j to i, and from i to j, before one of the two is integral.
        up, down = min((1 - p[i]) * size[i], p[j] * size[j]), min(p[i] * size[i], (1 - p[j]) * size[j])
        moved = up if rng.random() * (up + down) < down else -down
        p[i] += moved / size[i]
        p[j] -= moved / size[j]
        left = [x for x in (i, j) if EPS < p[x] < 1 - EPS]
        for x in (i, j):
            if x not in left:
                p[x] = round(p[x])
        holder = left[0] if left else None
    return holder


def _round_block(level: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # Large documents first: they are settled against the many smaller ones, and the one left over is small.
        rows = rows.sort_values(["size", "tie", "p"], ascending=[False, True, True], ignore_index=True)
        p, size = rows["p"].to_numpy(copy=True), rows["size"].to_numpy(np.float64)
        seed = int(mix(np.array([int(rows["group_seed"].iloc[0]) & (2**64 - 1)], np.uint64) + np.uint64(level))[0])
        open_at = _trade(p, size, seed)
        rows["open"] = False
        if open_at is not None:
            if last:
                p[open_at] = float(np.random.Generator(np.random.PCG64(seed ^ 1)).random() < p[open_at])
            else:
                rows.loc[open_at, "open"] = True
        rows["p"] = p
        return rows.drop(columns="group_seed")

    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (words) of every document."""
    spark = docs.sparkSession
    sized = stored(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), text_size(F.col(f"`{text_col}`")).alias("size"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash")), "sizes")
    targets = source_targets(sized, weights, cap)
    rows = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select("doc_id", "d.source", "size", "source_size", "docs", "target", "text_hash")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    tie = F.xxhash64(F.lit("mix"), "doc_id", "text_hash")
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_ROWS), F.lit(1))
    rows = rows.withColumn("base", F.floor(expected)).withColumn("p", F.when(F.col("size") > 0, expected - F.col("base")).otherwise(0.0))
    rows = stored(rows.withColumn("tie", tie).withColumn("blocks", blocks).withColumn("block", F.pmod("tie", "blocks")), "copies")
    columns = "doc_id, source, size, tie, blocks, block, p, base, source_size, target"
    schema = "doc_id string, source string, size long, tie long, blocks long, block long, p double, base long, source_size long, target double, open boolean"
    top = rows.agg(F.max("blocks")).first()[0] or 1
    settled, level = [], 0
    # Ids travel as text: pandas would make a column of whole numbers with a null inexact.
    current = rows.withColumn("doc_id", F.col("doc_id").cast("string")).select(*columns.split(", "))
    while True:
        last = top == 1
        seeded = current.withColumn("group_seed", F.xxhash64(F.lit("block"), F.lit(level), "source", "block"))
        rounded = seeded.groupBy("source", "block").applyInPandas(_round_block(level, last), schema)
        if last:
            settled.append(rounded)
            break
        rounded = stored(rounded, f"round{level}")
        settled.append(rounded.where("NOT open"))
        # A residual per block goes on to the next level of the tree.
        current = rounded.where("open").withColumn("blocks", F.ceil(F.col("blocks") / FAN)).withColumn("block", F.floor(F.col("block") / FAN)).drop("open")
        top, level = -(-top // FAN), level + 1
    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    copies = (F.col("base") + F.round("p").cast("long")).alias("copies")
    return done.select(F.col("doc_id").cast(sized.schema["doc_id"].dataType), "source", "size", "source_size", "target", copies).withColumn("taken", F.col("copies") * F.col("size"))
