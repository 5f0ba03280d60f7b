"""Removal of passages that occur earlier in the corpus, by suffix trees that are partitioned by prefixes.

A suffix is a document read from one of its words on; two suffixes share a passage as far as they agree. Nodes of a
suffix tree that are WIDTH words deep or deeper are the repeated passages, their leaves the places.

1. Prefixes. One pass counts how many suffixes begin with a word, and for words too frequent for one group, how many with
   two, four and eight words. A suffix belongs to its shortest prefix that is no longer too frequent, so suffixes
   that share WIDTH words always meet, and a group of prefixes fits into memory. Only prefixes with more than their share of
   a batch are reported, so at most REPORT rows a slice and batch leave it.
2. Suffixes. Within a batch of documents, suffixes that agree on WIDTH words keep the first one, the others are repeats
   already: a passage that a third of all documents hold is sent once a batch. What is sent of a suffix is its edge
   labels for the words 0-3 and 4-19, the document and the place, packed column by column.
3. Subtrees. A slice sorts its suffixes by labels; agreement of neighbours gives the inner nodes. A node as deep as WIDTH
   keeps its first leaf by (id, place), all other leaves are repeats.
4. Spans. Repeats return to their document as ranges of words, and one join with the (compressed) texts removes them.

An edge label is 16 bits for the first four words, beside the bits of the slice, and 48 bits for the words behind: a passage
passes for another one of some million that begin alike with a chance of 10^-8. Edge cases: a null text has no words; documents shorter than WIDTH are kept; texts of any
length are read whole, in pieces; a null id comes before all others; rows that share an id follow each other by a hash
of their text, and equal rows are one, so they keep the same words; an empty table gives an empty result. Extra
columns are not read. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklane.llm.hashing import mix

#: Words of a window, and of the first edge.
WIDTH, EDGE = 20, 4
#: Lengths of prefixes that are counted; beyond the last one a prefix is WIDTH words.
PREFIXES = (1, 2, 4, 8)
#: A prefix is too frequent for one group if it has more than 1/SHARE of a slice's suffixes.
SHARE, REPORT = 4, 8
BATCH_WORDS, SLICE_WORDS = 3_000_000, 3_000_000
#: Bytes of text that are cut into words at once.
PIECE = 1 << 23
_STEP = np.uint64(0xD1342543DE82EF95)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def word_hashes(text: str | None) -> Iterator[np.ndarray]:
    """Hashes of the words of a text, a piece of it at a time."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        yield np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        at = end


def _spelled(codes: np.ndarray, first: int, last: int) -> np.ndarray:
    """Hash of the words ``first`` to ``last`` behind every place; places too near the end hold no meaning."""
    out = np.full(len(codes), np.uint64(last - first + 1))
    for k in range(first, last + 1):
        out *= _STEP
        out[: len(codes) - k] += codes[k:]
    return mix(out)


class Batch:
    """Words of many documents in a row. ``doc`` and ``place`` say where a word stands; a long text may be in pieces."""

    def __init__(self, parts: list[tuple[int, int, np.ndarray]]):
        sizes = [len(c) for _, _, c in parts]
        self.codes = np.concatenate([c for _, _, c in parts]) if parts else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.array([d for d, _, _ in parts], np.int64), sizes)
        starts = np.cumsum([0, *sizes[:-1]]) if parts else []
        self.place = np.arange(len(self.codes)) - np.repeat(np.array([s - at for s, (_, at, _) in zip(starts, parts, strict=True)], np.int64), sizes)
        ends = np.repeat(np.cumsum(sizes), sizes)
        #: Where a suffix of WIDTH words begins.
        self.suffix = np.flatnonzero(np.arange(len(self.codes)) + WIDTH <= ends)

    def prefixes(self, length: int) -> np.ndarray:
        return _spelled(self.codes, 0, length - 1)[self.suffix]


def batches(rows: Iterator[pd.DataFrame]) -> Iterator[tuple[Batch, list[tuple[int, int]]]]:
    """Batches of about BATCH_WORDS words, with (rank, uid) of their documents. Pieces of a text overlap by WIDTH - 1 words."""
    parts, docs, held = [], [], 0
    for frame in rows:
        for rank, uid, text in zip(frame["rank"].tolist(), frame["uid"].tolist(), frame["text"], strict=True):
            at, last, inside = 0, np.zeros(0, np.uint64), False
            for codes in word_hashes(text):
                if not inside:
                    docs.append((rank, uid))
                    inside = True
                codes = np.concatenate([last, codes])
                parts.append((len(docs) - 1, at - len(last), codes))
                held += len(codes)
                at += len(codes) - len(last)
                last = codes[max(0, len(codes) - WIDTH + 1) :]
                if held >= BATCH_WORDS:
                    yield Batch(parts), docs
                    parts, docs, held, inside = [], [], 0, False
    if parts:
        yield Batch(parts), docs


def numbered(rank: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """The number of every document in the order of (rank, uid); rows of one document share it."""
    order = np.lexsort((uid, rank))
    fresh = (np.diff(rank[order], prepend=rank[order[:1]]) != 0) | (np.diff(uid[order], prepend=uid[order[:1]]) != 0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh)
    return number


def count_prefixes(texts: DataFrame, slices: int) -> tuple[dict[int, np.ndarray], int]:
    """The too frequent prefixes of every length, sorted, and how many suffixes there are."""

    def count(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, _ in batches(rows):
            left = batch.suffix
            total = len(left)
            yield pd.DataFrame({"length": [0], "prefix": [0], "met": [total]})
            for length in PREFIXES:
                spelled = _spelled(batch.codes, 0, length - 1)[left]
                prefix, where, met = np.unique(spelled, return_inverse=True, return_counts=True)
                often = met * (REPORT * slices) > total
                yield pd.DataFrame({"length": length, "prefix": prefix[often].view(np.int64), "met": met[often]})
                # What is rare here stays so when it is longer.
                left = left[often[where]]

    counts = texts.mapInPandas(count, "length int, prefix long, met long").groupBy("length", "prefix").agg(F.sum("met").alias("met"))
    found = counts.toPandas()  # REPORT * slices rows a length at most, and one
    total = int(found.loc[found["length"] == 0, "met"].sum())
    # A batch leaves out less than 1/REPORT of a slice, and so do all together.
    limit = total * (1 / SHARE - 1 / REPORT) / slices
    often = found[(found["length"] > 0) & (found["met"] > limit)]
    return {n: np.sort(often.loc[often["length"] == n, "prefix"].to_numpy(np.int64).view(np.uint64)) for n in PREFIXES}, total


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def group_of(batch: Batch, heavy: dict[int, np.ndarray]) -> np.ndarray:
    """The prefix every suffix is grouped by: its shortest one that is not too frequent."""
    group = batch.prefixes(WIDTH)
    settled = np.zeros(len(group), bool)
    for length in PREFIXES:
        prefix = batch.prefixes(length)
        here = ~settled & ~_among(prefix, heavy[length])
        group[here] = prefix[here]
        settled |= here
    return group


def labels_of(batch: Batch) -> np.ndarray:
    """The edge labels of every suffix: 16 bits for its words 0 to 3, 48 for 4 to 19."""
    label = lambda first, last, bits: _spelled(batch.codes, first, last)[batch.suffix] >> np.uint64(64 - bits)
    return label(0, EDGE - 1, 16) << np.uint64(48) | label(EDGE, WIDTH - 1, 48)


def agreement(labels: np.ndarray) -> np.ndarray:
    """Words on which neighbouring suffixes of a sorted slice agree at least: the depth of the node that joins them."""
    apart = labels[1:] ^ labels[:-1]
    return np.where(apart == 0, WIDTH, np.where(apart >> np.uint64(48) == 0, EDGE, 0))


def deep_nodes(labels: np.ndarray) -> np.ndarray:
    """Number of the node WIDTH words deep under which each leaf of a sorted slice lies."""
    return np.concatenate([[0], np.cumsum(agreement(labels) < WIDTH)]) if len(labels) else np.zeros(0, int)


def pack(columns: dict[str, np.ndarray]) -> bytes:
    """Columns of whole numbers, byte by byte of all values, so that equal high bytes take no room."""
    press, out = zstandard.ZstdCompressor(level=1), []
    for name, values in columns.items():
        planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
        packed = press.compress(planes.tobytes())
        out.append(f"{name} {len(packed)}\n".encode() + packed)
    return b"".join(out)


def unpack(data: bytes) -> dict[str, np.ndarray]:
    columns, at = {}, 0
    while at < len(data):
        line = data.index(b"\n", at)
        name, size = data[at:line].split()
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[line + 1 : line + 1 + int(size)]), np.uint8)
        columns[name.decode()] = np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()
        at = line + 1 + int(size)
    return columns


def send_suffixes(texts: DataFrame, heavy: dict[int, np.ndarray], slices: int) -> DataFrame:
    """slice and packed suffixes of a batch: sorted labels as steps, document and place; and the repeats found in the batch."""

    def send(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, docs in batches(rows):
            labels, doc, place = labels_of(batch), batch.doc[batch.suffix], batch.place[batch.suffix]
            part = (mix(group_of(batch, heavy)) % np.uint64(slices)).astype(np.int64)
            rank, uid = (np.array(c, np.int64) for c in zip(*docs, strict=True))
            # By slice and label, and what is alike by document and place.
            number = numbered(rank, uid)[doc]
            order = np.lexsort((place, number, labels, part))
            part, labels, doc, place = part[order], labels[order], doc[order], place[order]
            fresh, late = leaves(part, labels, number[order], place)
            for k, own, again in zip(range(slices), _cut(part[fresh], slices), _cut(part[late], slices), strict=True):
                lead, rest = fresh[own], late[again]
                if len(lead) + len(rest):
                    used, where = np.unique(np.concatenate([doc[lead], doc[rest]]), return_inverse=True)
                    blob = pack({
                        "rank": rank[used], "uid": uid[used], "label": np.diff(labels[lead], prepend=np.uint64(0)).view(np.int64),
                        "doc": where[: len(lead)], "place": place[lead], "late_doc": where[len(lead) :], "late": place[rest],
                    })
                    yield pd.DataFrame({"slice": [k], "blob": [blob]})

    return texts.mapInPandas(send, "slice int, blob binary")


def leaves(part: np.ndarray, node: np.ndarray, number: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted suffixes: the first of every node, and those that repeat it. The first one's twins in equal rows are neither."""
    if not len(node):
        return np.zeros(0, int), np.zeros(0, int)
    head = np.concatenate([[True], (node[1:] != node[:-1]) | (part[1:] != part[:-1])])
    first = np.flatnonzero(head)
    lead = first[np.cumsum(head) - 1]
    return first, np.flatnonzero((number != number[lead]) | (place != place[lead]))


def _cut(part: np.ndarray, slices: int) -> Iterator[slice]:
    edges = np.searchsorted(part, np.arange(slices + 1))
    return (slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True))


def grow_subtree(blobs: list[bytes], targets: int) -> Iterator[tuple[int, bytes]]:
    """(target, packed repeats) of a slice: leaves below the deep nodes but for the first one of each."""
    parts = [unpack(b) for b in blobs]
    column = lambda name, own=None: np.concatenate([p[name] if own is None else p[own][p[name]] for p in parts])
    labels = np.concatenate([np.cumsum(p["label"].view(np.uint64)) for p in parts])
    starts = np.cumsum([0, *(len(p["rank"]) for p in parts)])
    number = numbered(np.concatenate([p["rank"] for p in parts]), np.concatenate([p["uid"] for p in parts]))
    number = np.concatenate([number[a : a + len(p["rank"])][p["doc"]] for a, p in zip(starts, parts)])
    uid, place = column("doc", "uid"), column("place")
    order = np.lexsort((place, number, labels))
    labels, number, uid, place = labels[order], number[order], uid[order], place[order]
    _, late = leaves(np.zeros(len(labels), int), deep_nodes(labels), number, place)
    uid = np.concatenate([uid[late], column("late_doc", "uid")])
    place = np.concatenate([place[late], column("late")])
    target = uid.view(np.uint64) % np.uint64(targets)
    order = np.lexsort((place, uid, target))
    uid, place, target = uid[order], place[order], target[order]
    for k, own in zip(range(targets), _cut(target, targets), strict=True):
        if own.stop > own.start:
            docs, where = np.unique(uid[own], return_inverse=True)
            yield k, pack({"uid": docs, "doc": where, "place": place[own]})


def spans_of(places: np.ndarray) -> np.ndarray:
    """First word and end of the stretches that windows at sorted places cover."""
    start = np.concatenate([[True], places[1:] > places[:-1] + WIDTH])
    last = np.concatenate([start[1:], [True]])
    return np.stack([places[start], places[last] + WIDTH], axis=1)


def repeated_spans(texts: DataFrame) -> DataFrame:
    """uid of every document with repeats, and the stretches of words they cover, as pairs of numbers."""
    conf = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy, total = count_prefixes(texts, conf)
    # A slice fits into the memory of a task.
    slices = max(conf, -(-total // SLICE_WORDS))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(grow_subtree(list(rows["blob"]), slices)), columns=["target", "blob"])

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b) for b in rows["blob"]]
        uid, place = np.concatenate([p["uid"][p["doc"]] for p in parts]), np.concatenate([p["place"] for p in parts])
        order = np.lexsort((place, uid))
        uid, place = uid[order], place[order]
        edges = np.flatnonzero(np.concatenate([[True], uid[1:] != uid[:-1], [True]]))
        found = [(uid[a], spans_of(place[a:b]).astype("<i8").tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pd.DataFrame(found, columns=["uid", "spans"])

    repeats = send_suffixes(texts, heavy, slices).groupBy("slice").applyInPandas(grow, "target int, blob binary")
    return repeats.groupBy("target").applyInPandas(gather, "uid long, spans binary")


_OUT = "doc_id string, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept string"


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, a hash of the words left, the removed spans and the words left, one blank between.

    ``with_text=False`` leaves the last column null.
    """
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"ids are whole numbers; {id_col} is {kind.simpleString()}")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # Rows with one id and text are alike in every respect, so they share a number.
    rows = rows.withColumn("rank", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))).withColumn("uid", F.xxhash64("rank", "text"))
    spans = repeated_spans(rows.select("rank", "uid", "text"))

    def press(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor()
        for batch in batches:
            batch["text"] = [packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield batch

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, covered in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                words = np.array(zstandard.ZstdDecompressor().decompress(text).split(), object)
                keep, own = np.ones(len(words), bool), []
                if covered is not None:
                    for start, end in np.frombuffer(covered, "<i8").reshape(-1, 2).tolist():
                        keep[start:end] = False
                        own.append({"start": start, "end": end})
                left = b" ".join(words[keep])
                kept = left.decode("utf-8", "surrogatepass") if with_text else None
                out.append((doc_id, len(words), int(len(words) - keep.sum()), hashlib.sha256(left).hexdigest(), own, kept))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"])

    # Ids travel as text: pandas would make a column of whole numbers with a null inexact.
    packed = rows.select(F.col("doc_id").cast("string"), "uid", "text").mapInPandas(press, "doc_id string, uid long, text binary")
    joined = packed.join(spans, "uid", "left").select("doc_id", "text", "spans")
    return joined.mapInPandas(remove, _OUT).withColumn("doc_id", F.col("doc_id").cast(kind))
