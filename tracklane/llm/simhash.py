"""SimHash fingerprints of 128 bits, and all pairs of fingerprints within a Hamming radius.

Terms are pairs of neighbouring words (a single word where there is only one), weighted by how often they occur times a
weight that grows with their length. Each term's 128 hash bits vote with its weight for 1 or -1, and a bit of the
fingerprint is 1 where the votes are above zero. Sixteen-bit counters, four to a long, add up the votes of a block of
BLOCK terms; blocks of a text are added up per bit. Everything is a column expression or an aggregate.

Search: the bits are cut into BLOCKS blocks. Fingerprints within radius r agree on at least BLOCKS - r blocks, so for every
choice of that many blocks a table is keyed by their bits, and pairs meet in some table. Equal fingerprints meet once.

Edge cases: null text is empty; a text without words has no votes and the fingerprint 0; equal texts have equal
fingerprints; rows that repeat are returned each, and count as one document in the order; an empty table gives an empty
result; extra columns are neither read nor returned.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm.common import stored

BITS, RADIUS = 128, 4
#: Terms whose votes fit into sixteen-bit counters: BLOCK times the largest weight stays below 2^15.
BLOCK, MOST = 2048, 15
#: First bit of each block of one 64-bit half, and where the last ends.
CUTS = (0, 21, 42, 64)
_LANES = 0x0001000100010001


def fingerprints(texts: DataFrame, keys: list[str], carry: tuple[str, ...] = (), text: str = "text") -> DataFrame:
    """``keys``, which name a row, the long columns ``carry``, and the two halves ``hi`` and ``lo`` of the fingerprint.

    If ``texts`` lies partitioned by some of the keys, no row is moved; else one row of counters per block of terms is.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")
    split = texts.select(*keys, *carry, words.alias("w")).select(*keys, *carry, F.when(F.size("w") > 0, F.col("w")).otherwise(F.array(F.lit(""))).alias("w"))
    terms = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b"))
    exploded = (
        split.select(*keys, *carry, (F.size("w") == 1).alias("lone"), terms.alias("terms"))
        .select(*keys, *carry, "lone", F.posexplode("terms").alias("pos", "term"))
        .select(*keys, *carry, "lone", "pos", F.col("term.a").alias("a"), F.col("term.b").alias("b"))
        .where(F.col("b").isNotNull() | F.col("lone"))
    )
    length = F.char_length("a") + F.coalesce(F.char_length("b"), F.lit(0))
    weight = F.when(length == 0, 0).otherwise(F.least(F.lit(MOST), F.greatest(F.lit(1), length - 3))).cast("long")
    hashed = exploded.select(*keys, *carry, F.expr(f"pos div {BLOCK}").alias("block"), weight.alias("v"), F.xxhash64(F.lit(1), "a", "b").alias("h1"), F.xxhash64(F.lit(2), "a", "b").alias("h0"))
    lanes = [F.sum(F.col("v") * F.shiftrightunsigned(F.col(h), i).bitwiseAND(F.lit(_LANES))).alias(f"{h}_{i}") for h in ("h1", "h0") for i in range(16)]
    kept = [F.max(c).alias(c) for c in carry]
    blocks = hashed.groupBy(*keys, "block").agg(F.sum("v").alias("v"), *lanes, *kept)
    # Counter j of long i counts bit 16 * j + i.
    counted = lambda h, b: F.sum(F.shiftrightunsigned(F.col(f"{h}_{b % 16}"), 16 * (b // 16)).bitwiseAND(F.lit(0xFFFF)))
    summed = blocks.groupBy(*keys).agg(F.sum("v").alias("v"), *[counted(h, b).alias(f"{h}b{b}") for h in ("h1", "h0") for b in range(64)], *kept)

    def half(h: str) -> Column:
        bits = [F.when(2 * F.col(f"{h}b{b}") > F.col("v"), F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for b in range(64)]
        while len(bits) > 1:
            bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
        return bits[0]

    return summed.select(*keys, *carry, half("h1").alias("hi"), half("h0").alias("lo"))


def as_text(hi: Column, lo: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    return F.bit_count(hi.bitwiseXOR(other_hi)) + F.bit_count(lo.bitwiseXOR(other_lo))


def likeness(hi: Column, lo: Column, other_hi: Column, other_lo: Column) -> Column:
    """Share of equal bits."""
    return 1 - distance(hi, lo, other_hi, other_lo) / F.lit(float(BITS))


def _block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """Every fingerprint under every permuted key: table number and the bits of the chosen blocks."""
    size = [(h, a, b - a) for h in ("hi", "lo") for a, b in zip(CUTS, CUTS[1:], strict=False)]
    if radius >= len(size):
        raise ValueError(f"radius must be below {len(size)}")
    block = [F.shiftrightunsigned(F.col(h), a).bitwiseAND(F.lit((1 << n) - 1).cast("long")) for h, a, n in size]
    tables = [F.struct(F.lit(t).alias("table"), F.xxhash64(*[block[i] for i in chosen]).alias("key")) for t, chosen in enumerate(combinations(range(len(size)), len(size) - radius))]
    return prints.select("*", F.explode(F.array(*tables)).alias("slot")).select("*", "slot.table", "slot.key").drop("slot")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All (query, print) fingerprints at most ``radius`` bits apart: hi, lo, near_hi, near_lo, bits. Exact.

    Both sides are reduced to distinct fingerprints first, so copies never multiply; join the result back by fingerprint.
    """
    left = _block_tables(queries.select("hi", "lo").distinct(), radius)
    right = _block_tables(prints.select(F.col("hi"), F.col("lo")).distinct(), radius).select(F.col("hi").alias("near_hi"), F.col("lo").alias("near_lo"), "table", "key")
    apart = distance(F.col("hi"), F.col("lo"), F.col("near_hi"), F.col("near_lo"))
    return left.join(right, ["table", "key"]).where(apart <= radius).select("hi", "lo", "near_hi", "near_lo", apart.alias("bits")).distinct()


#: Names a document: never null, so it joins and groups without special cases. Rows equal in id and text share it.
KEY = ["id_hash", "text_hash"]


def next_documents(docs: DataFrame) -> DataFrame:
    """For each document: the next one by descending doc_id, the first after the last; equal ids go by text hash.

    Ids are range-partitioned and each range is looked at alone; the first row of every range, one per task, links them.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("text_hash").asc()]
    names = docs.groupBy("doc_id", *KEY).agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    ranged = stored(names.repartitionByRange(parts, *order).select("*", F.spark_partition_id().alias("part")), "order")
    row = F.struct(*KEY)
    inside = ranged.withColumn("place", F.row_number().over(W.partitionBy("part").orderBy(*order))).withColumn("next", F.lead(row).over(W.partitionBy("part").orderBy(*order)))
    heads = inside.where("place = 1").select("part", row.alias("head"))
    everything = W.orderBy("part").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = heads.select("part", F.coalesce(F.lead("head").over(W.orderBy("part")), F.first("head").over(everything)).alias("head"))
    chosen = F.coalesce("next", "head")
    return inside.join(after, "part").select("doc_id", *KEY, "n_chars", "copies", *[chosen[k].alias(f"next_{k}") for k in KEY])


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, id_hash, text_hash, copies, n_chars, text, edited and the next document's key, of each distinct (doc_id, text).

    ``edited`` has the last half of the text replaced by the first as many code points of the next document. Every text
    moves once, keyed by its document; the half a document lends moves once more.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("id_hash", F.xxhash64("doc_id")).withColumn("text_hash", F.xxhash64("text"))
    links = stored(next_documents(rows.select("doc_id", *KEY, F.char_length("text").cast("long").alias("n_chars"))), "next")
    # The same columns for both uses below, so that Spark moves the texts once and reads them twice.
    whole = rows.groupBy(*KEY).agg(F.first("text").alias("text"))
    # What each document lends, and to whom; every document lends to exactly one.
    lent = links.select(*[F.col(f"next_{k}").alias(k) for k in KEY], *[F.col(k).alias(f"to_{k}") for k in KEY], F.expr("cast(n_chars div 2 as int)").alias("wanted"))
    pieces = whole.join(lent, KEY).select(*[F.col(f"to_{k}").alias(k) for k in KEY], F.left("text", F.col("wanted")).alias("piece"))
    near = links.select("doc_id", *KEY, "n_chars", "copies", *[f"next_{k}" for k in KEY])
    both = whole.join(near, KEY).join(pieces, KEY)
    edited = F.concat(F.left("text", F.expr("cast(n_chars - n_chars div 2 as int)")), "piece")
    return both.select("doc_id", *KEY, "copies", "n_chars", "text", edited.alias("edited"), *[f"next_{k}" for k in KEY])


def compare_edits(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprints of every text and its edited text, how alike they are, and how alike the next document is."""
    # The digest travels as four longs beside the counters, which keeps the aggregate a hash aggregate.
    digest = F.sha2(F.col("edited").cast("binary"), 256)
    words = [F.conv(F.substring("digest", 16 * i + 1, 16), 16, -10).cast("long").alias(f"digest{i}") for i in range(4)]
    carry = ("doc_id", "copies", "n_chars", *[f"next_{k}" for k in KEY], *[f"digest{i}" for i in range(4)])
    side = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("text")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"))))
    pairs = edited_texts(docs).withColumn("digest", digest)
    sides = pairs.select(*KEY, *[c for c in carry if not c.startswith("digest")], *words, side.alias("s")).select(*KEY, *carry, "s.side", "s.text")
    prints = stored(fingerprints(sides, [*KEY, "side"], carry), "prints")
    own = prints.where("side = 0")
    edited = prints.where("side = 1").select(*KEY, F.col("hi").alias("e_hi"), F.col("lo").alias("e_lo"))
    after = own.select(*[F.col(k).alias(f"next_{k}") for k in KEY], F.col("hi").alias("n_hi"), F.col("lo").alias("n_lo"))
    # The stated queries of the search: documents whose id is divisible by 50, against all fingerprints.
    asked = F.coalesce(F.col("doc_id") % 50 == 0, F.lit(False))
    found = within_radius(own.where(asked), own, radius).groupBy("hi", "lo").agg((F.count(F.lit(1)) - 1).alias("near"))
    out = own.join(edited, KEY).join(after, [f"next_{k}" for k in KEY]).join(found, ["hi", "lo"], "left")
    hi, lo = F.col("hi"), F.col("lo")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(
        "doc_id",
        "n_chars",
        F.lower(F.concat(*[F.lpad(F.hex(f"digest{i}"), 16, "0") for i in range(4)])).alias("edited_sha256"),
        as_text(hi, lo).alias("fingerprint"),
        as_text(F.col("e_hi"), F.col("e_lo")).alias("edited_fingerprint"),
        likeness(hi, lo, F.col("e_hi"), F.col("e_lo")).alias("near_edited"),
        likeness(hi, lo, F.col("n_hi"), F.col("n_lo")).alias("near_next"),
        F.when(asked, F.col("near")).alias("n_within_radius"),
    )
