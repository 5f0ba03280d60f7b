"""Benchmark decontamination by templates: finds benchmark items in documents, also with other numbers, names and units.

Texts become templates: numbers, units after numbers and names (capitalised words inside a
sentence) are replaced by typed slots, the rest is lower-cased and stripped of outer signs. Runs of WIDTH template words are hashed and joined with those of the
benchmark. The slots of joined runs are then checked: along one alignment of a document with an item, a value of the item
must always stand for the same value in the document; runs that hold a value with two counterparts count only where they
repeat the item's words. An item is in a document if at least COVER of the item's runs are
found in consistent alignments. An item whose templates might miss a word-for-word copy, because it is short or made of
numbers and names, is looked for by runs of its very words as well. Column expressions, joins and aggregates only.

Edge cases: null and empty texts hold nothing; an item of fewer than WIDTH words is looked for as one run; one of fewer
than SHORTEST words is found where a document holds its very words, with other values nowhere; a run of a template
needs half of its words to be literal; an item's first word is read as a word and, if capitalised, as a name; rows that repeat (same id and
text) are one document and are reported once; ties do not arise; an empty documents or benchmark table gives an empty
result, and decontaminate() then returns its input. Null ids are reported as null. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.common import stored

WIDTH, SHORTEST, COVER = 8, 4, 0.3
#: Benchmark runs up to this many (about 100 bytes each) go to every task; beyond, both sides are shuffled.
MOST_BROADCAST = 300_000
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
# Unit names, and number words.
UNITS = "km|cm|mm|m|kg|g|mg|l|ml|s|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|foot|inch(?:es)?|meters?|metres?|kilometers?|kilometres?|grams?|kilograms?|pounds?|ounces?|liters?|litres?|dollars?|euros?|cents?|percent|degrees?"
NUMBERS = "two|three|four|five|six|seven|eight|nine|ten|eleven|twelve|twenty|thirty|forty|fifty|hundred|thousand|million|billion"
KEY = ["doc_id", "text_hash"]
TEMPLATE, WORDS = "template", "words"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def template(words: Column) -> Column:
    """The template word of every raw word, in an array of the same length."""
    line = F.lower(F.regexp_replace(F.array_join(words, " "), r"(?<=[\p{Ll}\p{N},;)] )[\"'(]?\p{Lu}[\p{L}’'-]*", NAME))
    for pattern, slot in (
        (r"[-+$€£]?\p{N}+(?:[.,:/]\p{N}+)*%?", NUMBER),
        (rf"{NUMBER}(?:{UNITS})(?=\p{{Punct}}*(?: |$))", f"{NUMBER}{UNIT}"),
        (rf"{NUMBER} (?:{UNITS})(?=\p{{Punct}}*(?: |$))", f"{NUMBER} {UNIT}"),
        (rf"\b(?:{NUMBERS})\b", NUMBER),
        (r"\p{Punct}+(?= |$)|(?<= |^)\p{Punct}+", ""),
    ):
        line = F.regexp_replace(line, pattern, slot)
    return F.when(F.size(words) > 0, F.split(line, " ")).otherwise(F.array().cast("array<string>"))


def very_words(words: Column) -> Column:
    """Lower-cased words without outer signs; a word of signs is itself."""
    return F.transform(words, lambda w: F.coalesce(F.nullif(_tidy(w), F.lit("")), w))


def _tidy(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^\p{Punct}+|\p{Punct}+$", "")


def _runs(shaped: DataFrame, keys: list[str], width: int, kind: str) -> DataFrame:
    """keys, pos, code, literal and raw of every run of ``width`` words of the array ``t``."""
    shifted = F.arrays_zip(*[(F.col("t") if k == 0 else F.slice("t", k + 1, F.size("t"))).alias(f"w{k}") for k in range(width)])
    runs = shaped.select(*keys, "raw", F.posexplode(shifted).alias("pos", "run")).where(F.col(f"run.w{width - 1}").isNotNull())
    words = [F.col(f"run.w{k}") for k in range(width)]
    literal = sum((F.when((w == "") | w.rlike(f"[{NUMBER}{UNIT}{NAME}]"), 0).otherwise(1) for w in words), F.lit(0))
    mark = [] if kind == TEMPLATE else [F.lit(kind)]
    return runs.select(*keys, "raw", "pos", F.xxhash64(*mark, F.lit(width), *words).alias("code"), literal.alias("literal"))


def template_runs(texts: DataFrame, keys: list[str], width: int, text: str = "text") -> DataFrame:
    """keys, pos, code, literal and raw (all words of the text) of every run of ``width`` template words."""
    split = texts.select(*keys, raw_words(F.col(text)).alias("raw")).where(F.size("raw") >= width)
    return _runs(split.select(*keys, "raw", template(F.col("raw")).alias("t")), keys, width, TEMPLATE)


def word_runs(texts: DataFrame, keys: list[str], width: int, text: str = "text") -> DataFrame:
    """The same of the very words."""
    split = texts.select(*keys, raw_words(F.col(text)).alias("raw")).where(F.size("raw") >= width)
    return _runs(split.select(*keys, "raw", very_words(F.col("raw")).alias("t")), keys, width, WORDS)


def _own_runs(sized: DataFrame, kind: str) -> DataFrame:
    """item_id, kind, width, code, item_pos and item_words of every run of the items, each item's runs of its own width.

    The width is a column, so the plan has one branch for all widths; codes are those of ``_runs``, as xxhash64 takes the
    words of an array one after the other, like columns. Of templates, a run that begins with a capitalised first word of
    an item is there with it as a name, too.
    """
    shaped = sized.select("item_id", "raw", "width", (template if kind == TEMPLATE else very_words)(F.col("raw")).alias("t"))
    places = F.sequence(F.lit(0), F.size("t") - F.col("width"))
    runs = F.transform(places, lambda p: F.struct(p.alias("pos"), F.slice("t", p + 1, F.col("width")).alias("run")))
    if kind == TEMPLATE:
        named = F.struct(F.lit(0).alias("pos"), F.concat(F.array(F.lit(NAME)), F.slice("t", 2, F.col("width") - 1)).alias("run"))
        capitalised = F.get("raw", F.lit(0)).rlike(r"^[\"'(]?\p{Lu}")
        runs = F.concat(runs, F.filter(F.array(named), lambda _: capitalised))
    exploded = shaped.select("item_id", "raw", "width", F.explode(runs).alias("r")).select("item_id", "raw", "width", "r.pos", "r.run")
    if kind == TEMPLATE:
        literal = F.filter("run", lambda w: (w != "") & ~w.rlike(f"[{NUMBER}{UNIT}{NAME}]"))
        exploded = exploded.where(F.size(literal) * 2 >= F.col("width"))
    mark = [] if kind == TEMPLATE else [F.lit(kind)]
    words = F.slice("raw", F.col("pos") + 1, F.col("width")).alias("item_words")
    return exploded.select("item_id", F.lit(kind).alias("kind"), "width", F.xxhash64(*mark, "width", "run").alias("code"), F.col("pos").alias("item_pos"), words)


def _item_runs(items: DataFrame, cover: float) -> DataFrame:
    """Runs of the benchmark: kind, width, code, item, its place and raw words, and how many runs of the kind the item has."""
    split = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct().select("item_id", raw_words(F.col("text")).alias("raw"))
    sized = split.withColumn("width", F.least(F.size("raw"), F.lit(WIDTH)))
    shapes = stored(_own_runs(sized.where(F.col("width") >= SHORTEST), TEMPLATE), "shapes")
    # The first word is read by what stands before it; all other runs of a copy have the item's own templates.
    sure = F.countDistinct(F.when(F.col("item_pos") > 0, F.col("item_pos"))) >= cover * F.countDistinct("item_pos")
    safe = shapes.groupBy("item_id").agg((sure & (F.countDistinct("item_pos") > 1)).alias("sure")).where("sure").select(F.col("item_id").alias("safe_id"))
    weak = sized.where("width > 0").join(safe, F.col("item_id").eqNullSafe(F.col("safe_id")), "left_anti")
    found = stored(shapes.unionByName(_own_runs(weak, WORDS)), "runs")
    total = found.groupBy(F.col("item_id").alias("of_id"), F.col("kind").alias("of_kind")).agg(F.countDistinct("item_pos").alias("item_runs"))
    return found.join(total, F.col("item_id").eqNullSafe(F.col("of_id")) & (F.col("kind") == F.col("of_kind"))).drop("of_id", "of_kind")


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", cover: float = COVER) -> DataFrame:
    """doc_id, text_hash, item_id, found_runs, item_runs and coverage of every item found in a document."""
    runs = stored(_item_runs(items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")), cover), "items")
    count = runs.count()
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    # A code tells kind and width, so one table of all runs goes to every task, once, whatever the number of kinds.
    known = runs.drop("width")
    matched = None
    for kind, width in [tuple(r) for r in runs.select("kind", "width").distinct().orderBy("kind", "width").collect()] or [(TEMPLATE, WIDTH)]:
        # Literal enough is what the item's run is, so the document's equal run is, too.
        mine = (template_runs if kind == TEMPLATE else word_runs)(texts, KEY, width).select(*KEY, "raw", "pos", "code")
        words = F.slice("raw", F.col("pos") + 1, F.lit(width)).alias("doc_words")
        columns = [*KEY, "item_id", "kind", "pos", "item_pos", "item_runs", "item_words"]
        if count <= MOST_BROADCAST:
            both = mine.join(F.broadcast(known), "code").select(*columns, words)
        else:
            both = mine.select(*KEY, "pos", "code", words).join(runs.where((F.col("width") == width) & (F.col("kind") == kind)).drop("width"), "code").select(*columns, "doc_words")
        matched = both if matched is None else matched.unionByName(both)
    matched = stored(matched.withColumn("shift", F.col("pos") - F.col("item_pos")), "matched")
    along = [*KEY, "item_id", "shift"]
    # What the item's words stand for along an alignment; words equal on both sides, or literal on both, agree anyway. A value
    # with two counterparts discards the runs that hold it, except those that repeat the item's words.
    slots = matched.select(*along, F.explode(F.arrays_zip(F.col("item_words").alias("i"), F.col("doc_words").alias("d"))).alias("s")).select(*along, _tidy(F.col("s.i")).alias("value"), _tidy(F.col("s.d")).alias("stands_for"))
    broken = slots.distinct().groupBy(*along, "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy(*[F.col(c).alias(f"b_{c}") for c in along]).agg(F.collect_set("value").alias("broken"))
    same = [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in along]
    values, stand_for = F.transform("item_words", _tidy), F.transform("doc_words", _tidy)
    sound = F.col("broken").isNull() | (values == stand_for) | ~F.arrays_overlap(values, "broken")
    kept = matched.join(broken, same[0] & same[1] & same[2] & same[3], "left").where(sound)
    found = kept.groupBy(*KEY, "item_id", "kind").agg(F.countDistinct("item_pos").alias("found_runs"), F.max("item_runs").alias("item_runs"))
    # The kind of run that shows most of the item.
    shown = found.withColumn("coverage", F.col("found_runs") / F.col("item_runs")).groupBy(*KEY, "item_id").agg(F.max(F.struct("coverage", "found_runs", "item_runs")).alias("best"))
    return shown.select(*KEY, "item_id", F.col("best.found_runs").alias("found_runs"), F.col("best.item_runs").alias("item_runs"), F.col("best.coverage").alias("coverage")).where(F.col("coverage") >= cover)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    leaked = stored(find_leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("_leaked_id"), F.col("text_hash").alias("_leaked_hash")).distinct(), "leaked")
    here = docs[f"`{id_col}`"].eqNullSafe(F.col("_leaked_id")) & (F.xxhash64(docs[f"`{text_col}`"]) == F.col("_leaked_hash"))
    return docs.join(leaked, here, "left_anti")
