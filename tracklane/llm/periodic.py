"""Periodic runs of words: stretches that repeat with some period at least twice, of LEAST words or more.

Words that equal the word one period on are a match; a run of period q is a stretch of matches, q words longer.

1. Tiles. Periods are taken by octave [P, 2P); the short ones up to 7 are one octave. Every run of an octave holds a
   boundary, as these lie P apart and its matches are no fewer than q >= P. A boundary is worth a look if the words just
   behind or before it come again one period on, which sliding hashes tell for all boundaries and periods at once. Such
   boundaries go into tiles: up to SPAN boundaries and the words they reach, which overlap with the next tile.
2. Solving. Tiles are dealt out over all tasks, those of one long text, too. For a boundary, two Z-functions (the words
   from it on; the words before it, backwards) say for every period of the octave how far the matches go on
   both sides, up to the reach of the tile, 2P.
3. Stitching. The fragments are shuffled by document and period and joined where they overlap or touch; boundaries lie
   nearer than fragments reach, so a run of any length comes out whole. Of equal stretches the smallest period stays.

Hashes only choose boundaries; words are compared one by one, as numbers given per text. Edge cases: null, empty and
short texts have no run; texts of any length are read whole, and the work is n log n in their words, not n squared; rows
that repeat are separate; null ids stay null; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm.common import stored
from tracklane.llm.hashing import mix

LEAST = 12
#: The octave of the short periods: boundaries are as far apart as their runs have matches at least.
SHORT_PERIODS, SHORT_STEP, SHORT_REACH = range(1, 8), 6, 16
SPAN = 8
_FACTOR = np.uint64(0xD1342543DE82EF95)
_FLUSH = 4_000_000


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def _octave(scale: int) -> tuple[range, int, int]:
    """Periods, distance of boundaries and reach of an octave; scale 0 is the one of the short periods."""
    return (range(scale, 2 * scale), scale, 2 * scale) if scale else (SHORT_PERIODS, SHORT_STEP, SHORT_REACH)


def _needed(period: int) -> int:
    """Matches of the shortest run."""
    return max(period, LEAST - period)


def _recurring(grams: np.ndarray, scale: int) -> np.ndarray:
    """Numbers of the blocks of ``scale`` whose first gram comes again in the next block."""
    if len(grams) <= scale:
        return np.zeros(0, int)
    again = grams[scale:] == np.repeat(grams[::scale], scale)[: len(grams) - scale]
    return np.unique(np.flatnonzero(again) // scale)


def boundaries(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(scale, places of the boundaries that may lie in a run) of every octave."""
    grams = mix(codes.astype(np.uint64))
    if len(codes) < LEAST:
        return
    grams = grams[:-1] * _FACTOR + grams[1:]
    # Six matches around a boundary: two of them follow it or two precede it.
    near = [np.zeros(0, int)]
    for q in SHORT_PERIODS:
        for at in (0, SHORT_STEP - 2):
            here, there = grams[at::SHORT_STEP], grams[at + q :: SHORT_STEP]
            same = np.flatnonzero(here[: len(there)] == there) * SHORT_STEP
            near.append(same if at == 0 else same + SHORT_STEP)
    yield 0, np.unique(np.concatenate(near))
    size, scale = 2, 8
    while 2 * scale <= len(codes):
        # Grams of half the scale: half of the matches, which are ``scale`` at least, lie on one side.
        while size < scale // 2:
            grams = grams[:-size] * (_FACTOR + np.uint64(2 * size)) + grams[size:]
            size *= 2
        behind = _recurring(grams, scale)
        before = _recurring(grams[size:], scale) + 1
        yield scale, np.union1d(behind, before) * scale
        scale *= 2


def tiles(codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(scale, first word, boundaries relative to it, codes) of every tile of a text."""
    for scale, places in boundaries(codes):
        periods, step, reach = _octave(scale)
        places = places[places < len(codes)]
        group = places // (step * SPAN)
        for part in np.split(places, np.flatnonzero(np.diff(group)) + 1) if len(places) else []:
            low, high = max(0, part[0] - reach), min(len(codes), part[-1] + periods[-1] + 1 + reach)
            yield scale, low, part - low, codes[low:high]


def z_function(s: list[int], upto: int) -> list[int]:
    """For every place below ``upto``, how many items from there on equal the first ones."""
    z, left, right, n = [0] * min(upto, len(s)), 0, 0, len(s)
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_boundary(codes: list[int], at: int, periods: range, reach: int) -> Iterator[tuple[int, int, int]]:
    """(period, first match, end of the matches) around one boundary, as far as the reach, where a run may be."""
    ends = at + periods[-1] + 1
    ahead = z_function(codes[at : ends + reach], periods[-1] + 1)
    back = codes[max(0, at - reach) : at][::-1]
    # Backwards from the last period's place on; a number that no word has keeps the halves apart.
    mirrored = back + [-1] + codes[max(0, at - reach) : ends][::-1]
    missing = max(0, ends - len(codes))
    behind = z_function(mirrored, len(back) + 1 + periods[-1] - periods[0] + 2)
    for q in periods:
        if at + q > len(codes):
            return
        after = min(ahead[q], reach) if q < len(ahead) else 0
        before = min(behind[len(back) + 1 + periods[-1] + 1 - q - missing], reach)
        if after and after + before >= _needed(q):
            yield q, at - before, at + after


def solve_tile(scale: int, low: int, places: np.ndarray, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, first match, end) of the tile, fragments of neighbouring boundaries joined."""
    periods, _, reach = _octave(scale)
    words, done, going = codes.tolist(), [], {}
    for at in places.tolist():
        for q, first, end in solve_boundary(words, at, periods, reach):
            held = going.get(q)
            if held is not None and first <= held[1]:
                going[q] = (min(held[0], first), max(held[1], end))
            else:
                if held is not None:
                    done.append((q, *held))
                going[q] = (first, end)
    done += [(q, *held) for q, held in going.items()]
    return [(q, first + low, end + low) for q, first, end in done]


_SCAN = "row long, doc_id string, n long, whole string, words string, scale int, low long, places binary, codes binary"


def scan_texts(docs: DataFrame) -> DataFrame:
    """A row per text (its words only if it has tiles, the hash of all its words if not) and a row per tile.

    Rows are numbered where they are read. Stored, so numbers and tiles are never made twice.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        out, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = split_words(text)
                known: dict[bytes, int] = {}
                codes = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
                found = [(number, None, None, None, None, scale, low, part.astype(np.int32).tobytes(), own.tobytes()) for scale, low, part, own in tiles(codes)]
                joined = b" ".join(words)
                whole = None if found else hashlib.sha256(joined).hexdigest()
                out.append((number, doc_id, len(words), whole, joined.decode("utf-8", "surrogatepass") if found else None, None, None, None, None))
                out += found
                held += 4 * sum(len(f[-1]) for f in found) + 200
                number += 1
                if held > _FLUSH:
                    yield _table(out)
                    out, held = [], 0
        yield _table(out)

    # Ids travel as text: pandas would make a column of whole numbers with a null inexact.
    return stored(docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(scan, _SCAN), "tiles")


def _table(rows: list[tuple]) -> pd.DataFrame:
    table = pd.DataFrame(rows, columns=[c.split()[0] for c in _SCAN.split(", ")])
    return table.astype({"n": "Int64", "scale": "Int32", "low": "Int64"})


def solve_tiles(scanned: DataFrame) -> DataFrame:
    """row, period, first and end of every fragment of matches."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, scale, low, places, codes in zip(*(batch[c] for c in ("row", "scale", "low", "places", "codes")), strict=True):
                rows += [(row, *f) for f in solve_tile(int(scale), int(low), np.frombuffer(places, np.int32), np.frombuffer(codes, np.int32))]
            yield pd.DataFrame(rows, columns=["row", "period", "first", "end"], dtype="int64")

    parts = int(scanned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = scanned.where("scale IS NOT NULL").select("row", "scale", "low", "places", "codes")
    return found.repartition(parts, "row", "scale", "low").mapInPandas(solve, "row long, period long, first long, end long")


def stitch(fragments: DataFrame) -> DataFrame:
    """row, start, length and period of every run."""
    in_order = W.partitionBy("row", "period").orderBy("first", "end")
    reached = F.max("end").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    cut = fragments.withColumn("fresh", F.when(F.col("first") <= reached, 0).otherwise(1))
    pieces = cut.withColumn("piece", F.sum("fresh").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    whole = pieces.groupBy("row", "period", "piece").agg(F.min("first").alias("start"), F.max("end").alias("end"))
    sized = whole.withColumn("length", F.col("end") - F.col("start") + F.col("period")).where(F.col("length") >= F.greatest(F.lit(LEAST), 2 * F.col("period")))
    # A period's multiples give the same stretch.
    return sized.groupBy("row", "start", "length").agg(F.min("period").alias("period"))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The scanned texts, and row, start, length and period (in words) of every run in them."""
    scanned = scan_texts(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    return scanned.where("scale IS NULL"), stitch(solve_tiles(scanned))


_OUT = "doc_id string, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's number of runs, its longest run, hashes of all runs and of the words left, and these words.

    A run keeps its first period; what follows is dropped. ``collapsed`` is null where nothing is dropped.
    """
    texts, runs = find_runs(docs, id_col, text_col)
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    busy = texts.where("words IS NOT NULL").join(listed, "row", "left").select("doc_id", "words", "runs")

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch["doc_id"], batch["words"], batch["runs"], strict=True):
                words, own = np.array(split_words(text), object), [] if found is None else [(r["start"], r["length"], r["period"]) for r in found]
                keep = np.ones(len(words), bool)
                for start, length, period in own:
                    keep[start + period : start + length] = False
                left = b" ".join(words[keep])
                shown = "".join(f"{s},{n},{p}\n" for s, n, p in own)
                longest = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
                milli = 1000 * longest[1] // longest[2] if own else None
                rows.append((doc_id, len(own), *longest, milli, hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "surrogatepass") if own else None))
            table = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
            yield table.astype({c: "Int64" for c in ("n_runs", "start", "length", "period", "exponent_milli")})

    none = F.lit(None).cast("long")
    quiet = texts.where("words IS NULL").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), none.alias("start"), none.alias("length"), none.alias("period"), none.alias("exponent_milli"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"), F.col("whole").alias("collapsed_sha256"), F.lit(None).cast("string").alias("collapsed"),
    )
    return busy.mapInPandas(collapse, _OUT).unionByName(quiet).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
