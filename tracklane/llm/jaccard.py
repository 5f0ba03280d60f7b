"""N-gram Jaccard join: all documents whose sets of five-word shingles overlap by 0.8 or more, as connected components.

1. Sets. Every text becomes its set of shingle hashes; equal sets are one set from here on (``sid``).
2. Similar sets first. Sets that share one of their KEYS smallest hashes are compared with the first set that has it, one
   comparison a set and hash. What links is one component from here on, and most near copies are found that way.
3. Index. A set's shingles are ordered by how common they are, rare ones first. Two sets that link share at least LEAST of
   the first ones (all but what 0.8 requires, plus LEAST), so only those enter inverted lists.
4. Skipping. Lists are sorted by set size. Lists whose sets are one component are skipped. Other lists of up to SHORT sets
   are put together by their members, as a passage puts the same sets into list after list: pairs come from every
   group of lists once, with the number of its lists. A pair goes on if its sizes allow a link and it met as often as the
   overlap that 0.8 requires forces its first shingles to meet; of these, and of the pairs of step 2, only those are
   compared word for word whose sketches (shingles counted in BINS bins) differ by no more than a link allows. Longer lists are put together by their first member
   and cut into blocks; blocks whose sizes are too far apart are skipped, the sketches of others compared inside one task. Of these, each set's
   nearest one is compared first, and the rest once what linked is one component.
5. Set relations. A set highly similar to another inherits its answers: sets known to be linked are one component, and no
   pair inside a component is compared again.

How common a shingle is only decides the order, so a rough count is enough: the sets of each 32-bit code are counted over
the whole input, from packed codes. Hashes have 64 bits; a false match between two shingles of a corpus is less likely than a disk error.

Edge cases: null text, or text without words, has an empty set and links with nothing; texts with fewer words are one
shingle; texts of any length are read whole; rows that repeat link; a null id takes part, and the component's id is the
smallest id that is not null; an empty table gives an empty result. Extra columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklane.llm.common import small_batches, stored
from tracklane.llm.hashing import set_id, shingle_set

WIDTH, LEAST, PERCENT = 5, 3, 80
SHORT, BLOCK, KEYS = 48, 512, 4
#: Numbers in the sketch of a set: how many of its shingles fall into each of so many bins, 255 at most.
BINS = 128
#: Bits of the filter that tells which texts are fetched, and of one piece of it.
FILTER_BITS, PIECE_BITS = 1 << 26, 1 << 15
#: Codes are packed after STRETCH shingles, in PARTS parts of their range; those of COMMON sets are common, and the HEAVY most
#: frequent ones go last in the order.
STRETCH, PARTS, COMMON, HEAVY = 4_000_000, 4096, 8, 400_000
#: Rows a task remembers so as not to send repeated ones again.
REMEMBER = 200_000
#: Labels known early (16 bytes each) go to every task up to this many; beyond, they are told apart when pairs are made.
MOST_LABELS = 2_000_000
KEY = ["id_hash", "text_hash"]


def _linked(common: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
    return 100 * common >= PERCENT * (a + b - common)


def _needed(n: int) -> int:
    """The least overlap of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


def _sketch(shingles: np.ndarray) -> bytes:
    return np.minimum(np.bincount((shingles % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def set_table(rows: DataFrame) -> DataFrame:
    """doc_id, id_hash, text_hash, n, sid (null if empty), smallest hashes and sketch of every row, and further rows with part and
    codes: the short codes of a task's shingles in one part of their range, packed."""
    kind = rows.schema["doc_id"].dataType
    columns = ["doc_id", *KEY, "n", "sid", "keys", "sketch", "part", "codes"]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n_seen, done = [], 0, set()
        for batch in batches:
            sets = []
            for text in batch["text"]:
                found = shingle_set(text, WIDTH)
                sid = set_id(found) if len(found) else None
                sets.append((len(found), sid, found[:KEYS].view(np.int64).copy(), _sketch(found)))
                if sid is None or sid in done:
                    continue
                if len(done) >= REMEMBER:
                    done.clear()
                done.add(sid)
                seen.append(_code(found))
                n_seen += len(found)
                if n_seen >= STRETCH:
                    yield _packed_codes(seen).reindex(columns=columns)
                    seen, n_seen = [], 0
            out = batch.drop(columns="text").astype({"doc_id": object})
            out["n"] = [n for n, *_ in sets]
            out["sid"] = pd.array([s for _, s, _, _ in sets], dtype="Int64")
            out["keys"] = [k for _, _, k, _ in sets]
            out["sketch"] = [k for *_, k in sets]
            out["part"], out["codes"] = pd.array([None] * len(out), dtype="Int32"), None
            yield out
        if seen:
            yield _packed_codes(seen).reindex(columns=columns)

    # Ids travel as text: pandas would make a column of whole numbers with a null inexact.
    built = rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(_nulls_kept(build), "doc_id string, id_hash long, text_hash long, n long, sid long, keys array<long>, sketch binary, part int, codes binary")
    return stored(built.withColumn("doc_id", F.col("doc_id").cast(kind)), "sets")


def _nulls_kept(build):
    """Rows of either kind lack the other's columns: they are null, not NaN."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in build(batches):
            whole = out.astype({**dict.fromkeys([*KEY, "n", "sid"], "Int64"), "part": "Int32"} | dict.fromkeys(["doc_id", "keys", "sketch", "codes"], object))
            yield whole.assign(**{c: whole[c].where(whole[c].notna(), None) for c in ("doc_id", "keys", "sketch", "codes")})

    return run


def _code(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(32)).astype(np.uint32)


def _packed_codes(seen: list[np.ndarray]) -> pd.DataFrame:
    """part and codes: the sorted codes of a stretch, one row a part, as compressed differences (about two bytes a code)."""
    codes = np.concatenate(seen)
    seen.clear()
    codes.sort()
    bounds = np.searchsorted(codes, np.arange(PARTS + 1, dtype=np.uint64) * np.uint64((1 << 32) // PARTS))
    press, rows = zstandard.ZstdCompressor(level=1), []
    for part in np.flatnonzero(np.diff(bounds)).tolist():
        own = np.diff(codes[bounds[part] : bounds[part + 1]], prepend=np.uint32(0))
        rows.append((part, press.compress(own.view(np.uint8).reshape(-1, 4).T.tobytes())))
    return pd.DataFrame(rows, columns=["part", "codes"])


def _common_codes(rows: pd.DataFrame) -> pd.DataFrame:
    """code and met of one part's codes that come COMMON times or more."""
    press = zstandard.ZstdDecompressor()
    steps = [np.frombuffer(press.decompress(c), np.uint8).reshape(4, -1).T.copy().view(np.uint32)[:, 0] for c in rows["codes"]]
    code, met = np.unique(np.concatenate([np.cumsum(s, dtype=np.uint32) for s in steps]), return_counts=True)
    return pd.DataFrame({"code": code[met >= COMMON].astype(np.int64), "met": met[met >= COMMON]})


def common_codes(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The HEAVY most frequent codes, ascending, and how many sets have each (copies of a set in other tasks count again)."""
    counted = table.where("part IS NOT NULL").select("part", "codes").groupBy("part").applyInPandas(_common_codes, "code long, met long")
    common = counted.orderBy(F.desc("met"), "code").limit(HEAVY).toPandas()
    order = np.argsort(common["code"].to_numpy(np.int64))
    return common["code"].to_numpy(np.int64)[order].astype(np.uint32), common["met"].to_numpy(np.int64)[order]


def first_pairs(reps: DataFrame) -> DataFrame:
    """Pairs (a, b): every set and the first one that shares one of its smallest hashes, if their sizes allow a link."""
    keyed = reps.select("sid", "n", F.explode("keys").alias("key"))
    leads = keyed.groupBy("key").agg(F.min("sid").alias("lead"), F.max("sid").alias("last")).where("lead <> last").drop("last")
    sizes = reps.select(F.col("sid").alias("lead"), F.col("n").alias("lead_n"))
    pairs = keyed.join(leads, "key").where("sid <> lead").select("sid", "n", "lead").distinct().join(sizes, "lead")
    fits = 100 * F.least("n", "lead_n") >= PERCENT * F.greatest("n", "lead_n")
    return pairs.where(fits).select(F.least("sid", "lead").alias("a"), F.greatest("sid", "lead").alias("b")).distinct()


def _first_ones(n: int | np.ndarray) -> int | np.ndarray:
    """How many of a set's shingles are indexed."""
    return n - _needed(n) + np.minimum(LEAST, _needed(n))


def inverted_entries(texts: DataFrame, heavy: tuple[np.ndarray, np.ndarray], labels: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """token, n, sid and label: the first shingles of every set, rare ones first."""
    sent = texts.sparkSession.sparkContext.broadcast((heavy, labels))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        (codes, met), (linked, label) = sent.value
        done: set[int] = set()
        for batch in batches:
            out: list[tuple[np.ndarray, int, int, int]] = []
            held = 0
            for text in batch["text"]:
                found = shingle_set(text, WIDTH)
                n = len(found)
                if not n or (sid := set_id(found)) in done:
                    continue
                if len(done) >= REMEMBER:
                    done.clear()
                done.add(sid)
                length = int(_first_ones(n))
                if len(codes):
                    code = _code(found)
                    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                    rank = np.where(codes[at] == code, met[at], 0)
                    found = found[np.argsort(rank, kind="stable")]
                at = np.searchsorted(linked, sid)
                known = at < len(linked) and linked[at] == sid
                out.append((found[:length], n, sid, int(label[at]) if known else sid))
                held += length
                if held >= 100_000:
                    yield _entries(out)
                    out, held = [], 0
            yield _entries(out)

    return texts.select("text").mapInPandas(index, "token long, n long, sid long, label long")


def _entries(found: list[tuple[np.ndarray, int, int, int]]) -> pd.DataFrame:
    sizes = [len(f) for f, *_ in found]
    token = np.concatenate([f for f, *_ in found]).view(np.int64) if found else np.zeros(0, np.int64)
    column = lambda k: np.repeat(np.array([f[k] for f in found], np.int64), sizes)
    return pd.DataFrame({"token": token, "n": column(1), "sid": column(2), "label": column(3)})


_LISTS = "members_hash long, members binary, times long, a long, lead long, n long"
_LIST_COLUMNS = [c.split()[0] for c in _LISTS.split(", ")]


def _short_lists(n: np.ndarray, sid: np.ndarray, label: np.ndarray, start: np.ndarray, size: np.ndarray) -> pd.DataFrame:
    """The short lists that hold sets of more than one component, lists of the same sets put together: hash, members and number."""
    if not len(start):
        return pd.DataFrame(columns=_LIST_COLUMNS)
    member = np.repeat(np.arange(len(start)), size)
    at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    first = label[start][member]
    mixed = np.bincount(member, label[at] != first, len(start)) > 0
    found: dict[bytes, int] = {}
    for begin, many in zip(start[mixed].tolist(), size[mixed].tolist(), strict=True):
        own = slice(begin, begin + many)
        key = np.concatenate([sid[own], n[own], label[own]]).tobytes()
        found[key] = found.get(key, 0) + 1
    rows = pd.DataFrame({"members_hash": [xxhash.xxh3_64_intdigest(k) - (1 << 63) for k in found], "members": list(found), "times": list(found.values())})
    return rows.reindex(columns=_LIST_COLUMNS)


def list_pairs(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different components that met in short lists as often as a link requires."""
    groups = lists.where("members IS NOT NULL").groupBy("members_hash", "members").agg(F.sum("times").alias("times"))

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for members, times in zip(batch["members"], batch["times"].tolist(), strict=True):
                sid, n, label = np.frombuffer(members, np.int64).reshape(3, -1)
                i, j = np.triu_indices(len(sid), 1)  # sorted by size: i is the smaller
                fits = (label[i] != label[j]) & (100 * n[i] >= PERCENT * n[j])
                i, j = i[fits], j[fits]
                overlap = -(-PERCENT * (n[i] + n[j]) // (100 + PERCENT))
                need = overlap - np.maximum(n[i] - _first_ones(n[i]), n[j] - _first_ones(n[j]))
                out.append(np.stack([np.minimum(sid[i], sid[j]), np.maximum(sid[i], sid[j]), need, np.full(len(i), times)], axis=1))
                held += len(i)
                if held >= 100_000:
                    yield pd.DataFrame(np.concatenate(out), columns=["a", "b", "need", "times"])
                    out, held = [], 0
            if out:
                yield pd.DataFrame(np.concatenate(out), columns=["a", "b", "need", "times"])

    pairs = groups.select("members", "times").mapInPandas(expand, "a long, b long, need long, times long")
    met = pairs.groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need"))
    return met.where("times >= need").select("a", "b")


def scan_lists(entries: DataFrame) -> DataFrame:
    """Walk the sorted lists once. Rows of groups of short lists (members_hash, members, times), and of members of long lists
    (a = sid, lead = the list's first sid, n)."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame({"token": [], "n": [], "sid": [], "label": []}, dtype="int64")
        # A long list is passed on as it streams by: its token and its first member.
        open_token, lead = None, 0
        for batch in _and_end(batches):
            rows = kept if batch is None else pd.concat([kept, batch], ignore_index=True)
            token, n, sid, label = (rows[c].to_numpy(np.int64) for c in kept.columns)
            if len(token):
                fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])])
                token, n, sid, label = token[fresh], n[fresh], sid[fresh], label[fresh]
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
            size = np.diff(np.concatenate([start, [len(token)]])).astype(int) if len(start) else np.zeros(0, int)
            last = len(start) if batch is None else len(start) - 1
            members = []
            going = np.zeros(len(start), bool) if open_token is None else token[start] == open_token
            for k in np.flatnonzero((size > SHORT) | going):
                own = slice(start[k], start[k] + size[k])
                # The first kept row of a list that goes on repeats its last member, to tell copies across batches.
                skip = 1 if going[k] else 0
                first = lead if going[k] else sid[start[k]]
                members.append(pd.DataFrame({"a": sid[own][skip:], "lead": first, "n": n[own][skip:]}))
                if k == last:
                    open_token, lead = token[start[k]], first
            short = (size >= 2) & (size <= SHORT) & (np.arange(len(size)) < last) & ~going
            yield _short_lists(n, sid, label, start[short], size[short])
            for part in members:
                yield part.reindex(columns=_LIST_COLUMNS)
            if batch is None:
                return
            if len(start):
                tail = slice(start[-1], None)
                if open_token is not None and token[start[-1]] == open_token:
                    tail = slice(len(token) - 1, None)
                elif open_token is not None:
                    open_token = None
                kept = pd.DataFrame({"token": token[tail], "n": n[tail], "sid": sid[tail], "label": label[tail]})

    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = entries.repartition(parts, "token").sortWithinPartitions("token", "n", "sid")
    return stored(laid.mapInPandas(_typed(walk), _LISTS), "lists")


def _typed(walk):
    """Columns that are empty in one batch and not in another keep their types."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in walk(batches):
            whole = out.astype({c: "Int64" for c in _LIST_COLUMNS if c != "members"})
            yield whole.assign(members=whole["members"].astype(object).where(whole["members"].notna(), None))

    return run


def _and_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def packed_texts(rows: DataFrame) -> DataFrame:
    """KEY and the whole text, compressed, of every row with a text; of rows that repeat, one a task as a rule."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press, done = zstandard.ZstdCompressor(), set()
        for batch in batches:
            fresh = ~batch.duplicated(KEY) & [k not in done for k in zip(batch[KEY[0]], batch[KEY[1]], strict=True)]
            batch = batch[fresh].reset_index(drop=True)
            if len(done) >= REMEMBER:
                done.clear()
            done.update(zip(batch[KEY[0]], batch[KEY[1]], strict=True))
            batch["text"] = [press.compress(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield batch

    return rows.select(*KEY, "text").where("text IS NOT NULL").mapInPandas(pack, "id_hash long, text_hash long, text binary")


def _unpacked(text: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(text).decode("utf-8", "surrogatepass")


def likely_rows(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose columns are among those of ``keys``, and few others. A filter of FILTER_BITS bits (8 MB, however many are
    asked for) keeps most other rows from moving; a join settles the rest."""
    code = F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))
    spots = keys.select(F.floor(code / PIECE_BITS).alias("piece"), (code % PIECE_BITS).alias("spot"))
    pieces = spots.groupBy("piece").agg(F.bitmap_construct_agg("spot").alias("bits"))
    marked = rows.withColumn("piece", F.floor(code / PIECE_BITS)).withColumn("spot", code % PIECE_BITS)
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("spot") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(byte, CAST(spot % 8 AS INT)) & 1") == 1
    return marked.join(F.broadcast(pieces), "piece").withColumn("byte", byte).where(hit).select(*rows.columns)


def likely_sketches(reps: DataFrame, asked: DataFrame) -> DataFrame:
    """sid, n and sketch of the sets asked for, and few others."""
    return stored(likely_rows(reps.select("sid", "n", "sketch"), asked, ["sid"]), "sketches")


def needed_texts(asked: DataFrame, reps: DataFrame, rows: DataFrame) -> DataFrame:
    """sid and packed text of the sets asked for."""
    keys = stored(asked.distinct().join(reps.select("sid", *KEY), "sid"), "asked")
    chosen = likely_rows(rows.where("text IS NOT NULL").select(*KEY, "text"), keys, KEY)
    return stored(packed_texts(chosen).join(keys, KEY).select("sid", "text"), "texts")


def near_enough(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches leave room for a link: sets differ in as many shingles as their bins do, at least."""
    pairs = stored(pairs, "met")
    reps = likely_sketches(reps, pairs.select(F.explode(F.array("a", "b")).alias("sid")))
    side = lambda name: reps.select(F.col("sid").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("a_sketch", "b_sketch"))
                total = (batch["a_n"] + batch["b_n"]).to_numpy()
                apart = total + 2 * (-PERCENT * total // (100 + PERCENT))
                yield batch.loc[np.abs(x - y).sum(1) <= apart, ["a", "b"]]

    return both.mapInPandas(compare, "a long, b long")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are not in one component."""
    side = lambda name: labels.select(F.col("sid").alias(name), F.col("label").alias(f"{name}_label"))
    told = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return told.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")


def check_pairs(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that link; every pair is compared on the whole sets."""
    text = lambda side: texts.select(F.col("sid").alias(side), F.col("text").alias(f"{side}_text"))
    both = pairs.join(text("b"), "b").join(text("a"), "a").select("a", "b", "a_text", "b_text")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, mine = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch["a"], batch["a_text"], batch["b_text"], strict=True):
                if a != held:
                    held, mine = a, shingle_set(_unpacked(x), WIDTH)
                other = shingle_set(_unpacked(y), WIDTH)
                common = len(mine) + len(other) - len(np.union1d(mine, other))
                keep.append(bool(_linked(common, len(mine), len(other))))
            yield batch.loc[keep, ["a", "b"]]

    return both.mapInPandas(compare, "a long, b long")


def _compare_cell(rows: pd.DataFrame, nearest: bool) -> pd.DataFrame:
    """Pairs of sets of one or two blocks of a family, of different components, whose sizes and sketches leave room for a link;
    with ``nearest``, for each set only the one with the least share of shingles that its sketch tells apart."""
    rows = rows.drop_duplicates("sid").sort_values(["n", "sid"], ignore_index=True)
    sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(-1, BINS).astype(np.int16)
    n, sid, label = (rows[c].to_numpy(np.int64) for c in ("n", "sid", "label"))
    a, b = [np.zeros(0, int)], [np.zeros(0, int)]
    least, at = np.full(len(n), np.inf), np.arange(len(n))
    for i in range(len(n)):
        reach = int(np.searchsorted(n, 100 * n[i] // PERCENT, "right"))
        other = np.flatnonzero(label[i + 1 : reach] != label[i]) + i + 1
        total = n[i] + n[other]
        differ = np.abs(sketch[other] - sketch[i]).sum(1)
        fits = differ <= total + 2 * (-PERCENT * total // (100 + PERCENT))
        other, share = other[fits], differ[fits] / total[fits]
        if not len(other):
            continue
        if not nearest:
            a.append(np.full(len(other), i))
            b.append(other)
            continue
        best = int(np.argmin(share))
        if share[best] < least[i]:
            least[i], at[i] = share[best], other[best]
        closer = share < least[other]
        least[other[closer]], at[other[closer]] = share[closer], i
    if nearest:
        a.append(np.flatnonzero(at != np.arange(len(n))))
        b.append(at[a[-1]])
    x, y = sid[np.concatenate(a)], sid[np.concatenate(b)]
    return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}, dtype="int64").drop_duplicates()


def mixed_families(members: DataFrame, labels: DataFrame) -> DataFrame:
    """lead, sid and n of long lists, put together by their first member, that hold sets of more than one component.

    Lists with one first member hold much the same sets, so they are one family: whoever shares a list shares a family.
    """
    family = members.select("lead", F.col("a").alias("sid"), "n").distinct()
    return stored(_with_labels(family, labels).drop("label", "total"), "families")


def _with_labels(family: DataFrame, labels: DataFrame) -> DataFrame:
    """Families whose sets are not all in one component, with label and size of the family."""
    known = family.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    total = known.groupBy("lead").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("total"))
    return known.join(total.where("low <> high").select("lead", "total"), "lead")


def block_pairs(members: DataFrame, labels: DataFrame, reps: DataFrame, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) inside families that may link sets of different components; with ``nearest``, one a set and cell. Only
    sketches move, no texts.

    Families of more than BLOCK sets are cut by size, and by hash where a size class is still too large.
    """
    sized = F.when(F.col("total") <= BLOCK, 0).otherwise(F.floor(F.log("n") / F.log(F.lit(1.1))))
    classed = stored(_with_labels(members, labels).withColumn("class", sized).drop("total"), "family")
    parts = classed.groupBy("lead", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    placed = classed.join(parts, ["lead", "class"]).withColumn("part", F.pmod(F.xxhash64("sid"), "parts")).withColumn("block", F.struct("class", "part"))
    blocks = placed.groupBy("lead", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    other = blocks.select("lead", F.col("block").alias("other"), F.col("least").alias("other_least"), F.col("most").alias("other_most"))
    # Blocks whose sizes are out of reach of each other are skipped.
    near = (100 * F.col("most") >= PERCENT * F.col("other_least")) & (100 * F.col("other_most") >= PERCENT * F.col("least"))
    cells = blocks.join(other, "lead").where((F.col("other") >= F.col("block")) & near)
    cells = cells.select("lead", F.col("block").alias("low"), F.col("other").alias("high"), F.explode(F.array_distinct(F.array("block", "other"))).alias("block"))
    laid = placed.join(reps.select("sid", "sketch"), "sid").join(cells, ["lead", "block"])
    return laid.select("lead", "low", "high", "sid", "n", "label", "sketch").groupBy("lead", "low", "high").applyInPandas(lambda cell: _compare_cell(cell, nearest), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """sid and label, the smallest sid reachable, of every set that has a link. Alternates large-star and small-star."""
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("sid"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("sid"), F.col("v").alias("label")).distinct())


def join_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    with small_batches(docs.sparkSession):
        return _join_similar(docs, id_col, text_col)


def _join_similar(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("id_hash", F.xxhash64("doc_id")).withColumn("text_hash", F.xxhash64("text"))
    table = set_table(rows.select("doc_id", *KEY, "text"))
    sketched = table.where("part IS NULL").drop("part", "codes")
    sets = sketched.drop("sketch")
    # One row stands for all rows of a set.
    known = sketched.where("sid IS NOT NULL").groupBy("sid").agg(F.min(F.struct(*KEY)).alias("key"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    reps = stored(known.select("sid", "n", "keys", "sketch", *[F.col(f"key.{k}").alias(k) for k in KEY]), "reps")
    sides = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("sid"))
    near = stored(near_enough(first_pairs(reps), reps), "near")
    links = stored(check_pairs(near, needed_texts(sides(near), reps, rows)), "links")
    labels = components(links)
    few = labels.orderBy("sid").toPandas() if labels.count() <= MOST_LABELS else pd.DataFrame({"sid": [], "label": []})
    early = (few["sid"].to_numpy(np.int64), few["label"].to_numpy(np.int64))
    lists = scan_lists(inverted_entries(rows, common_codes(table), early))
    pairs, members = stored(near_enough(apart(list_pairs(lists), labels), reps), "pairs"), mixed_families(lists.where("lead IS NOT NULL"), labels)
    links = stored(links.unionByName(check_pairs(pairs, needed_texts(sides(pairs), reps, rows))), "links")
    # Of families, first every set's nearest one: most of what links is one component then, and makes no more pairs.
    tried, many = None, reps if members.isEmpty() else likely_sketches(reps, members)
    for nearest in () if many is reps else (True, False):
        more = block_pairs(members, components(links), many, nearest)
        more = tried = stored(more if tried is None else more.join(tried, ["a", "b"], "left_anti"), "blocks")
        links = stored(links.unionByName(check_pairs(more, needed_texts(sides(more), reps, rows))), "links")
    labels = components(links)
    first = sets.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("first"))
    placed = first.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    smallest = placed.groupBy("label").agg(F.min("first").alias("component_id"))
    answer = placed.join(smallest, "label").select("sid", "component_id")
    return sets.join(answer, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
