"""Token counts from distinct pre-tokens.

A tokenizer first cuts a text into pre-tokens and then each pre-token, on its own, into pieces. So pieces are counted once
per distinct pre-token of the corpus, joined to the frequencies of the pre-tokens of each document, and summed; no list
of token ids exists anywhere. The most frequent pre-tokens (HEAD, a fixed number of short strings) are summed where the
document is read; only the others travel, one row per document and distinct pre-token.

Edge cases: null and empty texts have 0 bytes and 0 tokens; special token strings inside a text count one token each, as
the library does by default; texts of any length are counted whole; repeated rows are counted each; an empty table
gives an empty result. Extra columns are neither read nor returned.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from tokenizers import Tokenizer

from tracklane.llm.common import stored

#: So many pre-tokens of at most HEAD_CHARS characters are held by every task: below 20 MB.
HEAD, HEAD_CHARS = 200_000, 24
#: A task's counts are passed on when it has seen so many distinct pre-tokens.
FLUSH = 200_000

_SIMPLE = range(0x250)
_ODD_SPACE = "\x1c\x1d\x1e\x1f\x85\xa0"
_L = "".join(re.escape(chr(c)) for c in _SIMPLE if unicodedata.category(chr(c))[0] == "L")
_N = "".join(re.escape(chr(c)) for c in _SIMPLE if unicodedata.category(chr(c))[0] == "N")
#: The pre-token rule of the vocabulary file (a fixed value), for characters below U+0250.
_FAST = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
_NOT_SIMPLE = re.compile(rf"[{_ODD_SPACE}İɐ-\U0010ffff]")
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class PreTokens:
    """Cuts texts as the tokenizer of a vocabulary file does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        # The quick expression stands for one known rule; files with another one go through the library.
        self.fast = '"Lowercase"' in (spec := self.tokenizer.to_str()) and _RULE in spec.replace("\\\\", "\\")

    def _cut(self, text: str) -> list[str]:
        # Some letters below U+0250 have their small form above.
        if self.fast and not _NOT_SIMPLE.search(low := text.lower()):
            return _FAST.findall(low)
        tidy = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return [tidy[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(tidy)]

    def count(self, text: str) -> tuple[Counter, int]:
        """Frequencies of the pre-tokens, and the number of special tokens."""
        if self.special is None or not self.special.search(text):
            return Counter(self._cut(text)), 0
        parts = self.special.split(text)
        found: Counter = Counter()
        for part in parts:
            found.update(self._cut(part))
        return found, len(parts) - 1

    def pieces(self, pretokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(pretokens, add_special_tokens=False)]


@lru_cache(maxsize=2)
def pretokens_of(path: str) -> PreTokens:
    return PreTokens(path)


def vocabulary(texts: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Every distinct pre-token of the corpus with its frequency and its number of pieces."""

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut, total = pretokens_of(path), Counter()
        out = lambda: pd.DataFrame({"pretoken": pd.Series(list(total), dtype=object), "n": list(total.values())})
        for batch in batches:
            for text in batch["text"]:
                if text:
                    total.update(cut.count(text)[0])
                    if len(total) >= FLUSH:
                        yield out()
                        total.clear()
        yield out()

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = batch["pretoken"].tolist()
            yield pd.DataFrame({"pretoken": pd.Series(words, dtype=object), "n": batch["n"], "pieces": pretokens_of(path).pieces(words)})

    counted = texts.select(F.col(f"`{text_col}`").alias("text")).mapInPandas(seen, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
    return stored(counted.mapInPandas(cut_up, "pretoken string, n long, pieces long"), "vocabulary")


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    spark = docs.sparkSession
    words = vocabulary(docs, path, text_col)
    head = words.where(F.char_length("pretoken") <= HEAD_CHARS).orderBy(F.desc("n"), "pretoken").limit(HEAD).select("pretoken", "pieces")
    known = spark.sparkContext.broadcast({w: p for w, p in head.toLocalIterator()})

    # Numbered rows are read once: whatever a document's result needs leaves its task together, as a second numbering may differ.
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("doc_id"), F.octet_length(F.col(f"`{text_col}`")).cast("long").alias("n_bytes"), F.col(f"`{text_col}`").alias("text"))
    ids = texts.schema["doc_id"].dataType
    schema = StructType([StructField("row", LongType()), StructField("doc_id", ids), StructField("n_bytes", LongType()), StructField("pretoken", StringType()), StructField("n", LongType())])

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, short = pretokens_of(path), known.value

        def rare(rows: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
            row, word, n = zip(*rows, strict=True)
            empty = [pa.nulls(len(rows), like.schema.field(c).type) for c in ("doc_id", "n_bytes")]
            return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), *empty, pa.array(word, pa.string()), pa.array(n, pa.int64())], names=schema.names)

        for batch in batches:
            rows, base = [], []
            for row, text in zip(batch["row"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found, extra = cut.count(text or "")
                for w, n in found.items():
                    if (pieces := short.get(w)) is None:
                        rows.append((row, w, n))
                    else:
                        extra += n * pieces
                base.append(extra)
                if len(rows) >= 50_000:
                    yield rare(rows, batch)
                    rows = []
            if rows:
                yield rare(rows, batch)
            yield pa.RecordBatch.from_arrays([batch["row"], batch["doc_id"], batch["n_bytes"], pa.nulls(len(base), pa.string()), pa.array(base, pa.int64())], names=schema.names)

    counts = stored(texts.mapInArrow(frequencies, schema), "frequencies")
    rest = counts.where("pretoken IS NOT NULL").join(words, "pretoken").groupBy("row").agg(F.sum(counts["n"] * F.col("pieces")).alias("more"))
    base = counts.where("pretoken IS NULL").select("row", "doc_id", F.coalesce("n_bytes", F.lit(0).cast("long")).alias("n_bytes"), F.col("n").alias("base"))
    total = base.join(rest, "row", "left").withColumn("n_tokens", F.col("base") + F.coalesce("more", F.lit(0)))
    return total.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
