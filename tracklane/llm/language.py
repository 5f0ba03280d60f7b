"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text is the mean embedding of the hashed character 1- to 4-grams of its words; a linear softmax gives one probability
per learned language. Embeddings and weights are trained by stochastic gradient descent in numpy on snippets cut from a
sample of labelled texts (MODEL_ROWS rows, a documented bound). Part of the sample is held back: on it a temperature is
fitted, so that a probability means what it says, and the rejection level is set, below which only REJECT of the known
snippets lie.

Edge cases: a text that is null or without letters is ``und`` with score 0 and is rejected; texts of any length are read
whole; without any labelled row every text is ``und``. Only the text of a document is an input of a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.hashing import mix

UNKNOWN = "und"
MODEL_ROWS, SNIPPET_WORDS = 3000, (1, 2, 4, 10, 40, 120)
BUCKETS, DIM, GRAMS = 1 << 16, 16, 4
EPOCHS, BATCH, RATE, REJECT = 5, 32, 0.2, 0.001
#: Characters looked at together; a longer text is cut between words.
PIECE = 1 << 18

_LETTER = np.array([chr(c).isalpha() for c in range(0x110000)])
_BETWEEN = re.compile(r"\W")


def _codes(text: str) -> np.ndarray:
    """Lower-case letters; every run of anything else is one 0, also at both ends."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = _LETTER[raw]
    kept = np.where(letter, raw, 0)
    return kept[letter | np.concatenate([[True], letter[:-1]])]


def subwords(codes: np.ndarray) -> np.ndarray:
    """Buckets of the 1- to GRAMS-grams inside words, word edges included."""
    edge, found = codes == 0, []
    code, inner = np.zeros(len(codes), np.uint64), np.zeros(len(codes), bool)
    for n in range(1, min(GRAMS, len(codes)) + 1):
        size = len(codes) - n + 1
        code = code[:size] * np.uint64(0x100000001B3) + codes[n - 1 :].astype(np.uint64) + np.uint64(n)
        # An edge may begin or end a gram, not stand inside it or alone.
        inner = inner[:size] | edge[n - 2 : n - 2 + size] if n > 2 else np.zeros(size, bool)
        found.append(code[~edge] if n == 1 else code[~inner])
    return (mix(np.concatenate(found)) % np.uint64(BUCKETS)).astype(np.int64) if found else np.zeros(0, np.int64)


def _pieces(text: str) -> Iterator[np.ndarray]:
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield subwords(_codes(text[at:end]))
        at = end


@dataclass
class LanguageModel:
    languages: list[str]
    #: Embeddings times softmax weights: what one subword adds to the evidence for each language.
    evidence: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, text: str) -> np.ndarray | None:
        total, n = np.zeros(len(self.languages)), 0
        for found in _pieces(text):
            if len(found):
                total += self.evidence[found].sum(0, dtype=np.float64)
                n += len(found)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, rejected."""
        logits = self.logits(text) if text and self.languages else None
        if logits is None:
            return UNKNOWN, 0.0, True
        p = _softmax(logits[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.reject_below)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _train(features: list[np.ndarray], target: np.ndarray, languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7)
    table = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, languages), np.float32), np.zeros(languages, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for chosen in np.array_split(rng.permutation(len(features)), max(1, len(features) // BATCH)):
            own = [features[i] for i in chosen]
            sizes = np.array([len(f) for f in own])
            flat = np.concatenate(own)
            mean = np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]])) / sizes[:, None]
            error = _softmax(mean @ weights + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            back = (error @ weights.T) / sizes[:, None]
            weights -= rate * (mean.T @ error)
            bias -= rate * error.sum(0)
            np.subtract.at(table, flat, np.repeat(rate * back, sizes, 0).astype(np.float32))
    return table, weights, bias


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", rows: int = MODEL_ROWS) -> LanguageModel:
    """Train on about ``rows`` labelled rows, spread evenly over the languages (the ``rows`` commonest, if there are more); rows
    without text or label are left out."""
    known = labelled.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(rows).collect()}
    languages = sorted(totals)
    share = -(-rows // max(1, len(languages)))
    parts = 1 << 30
    # A row a language: which part of it is taken.
    taken = [(lang, parts if n <= share else int(share / n * parts)) for lang, n in totals.items()]
    taken = known.sparkSession.createDataFrame(taken, "lang string, taken long")
    chosen = known.join(F.broadcast(taken), "lang").where(F.pmod(F.xxhash64(F.lit("sample"), "key", "text"), F.lit(parts)) < F.col("taken"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, lang in zip(batch["key"], batch["text"], batch["lang"], strict=True):
                words = text.split()
                rng = np.random.default_rng([len(words), len(text)])
                for n in SNIPPET_WORDS:
                    if words:
                        at = int(rng.integers(0, max(1, len(words) - n + 1)))
                        snippet = " ".join(words[at : at + n])
                        # Texts without blanks are one word: some of its characters.
                        at = int(rng.integers(0, max(1, len(snippet) - 40 * n + 1)))
                        out.append((snippet[at : at + 40 * n], lang, n))
            yield pd.DataFrame(out, columns=["text", "lang", "words"]).astype({"text": object, "lang": object})

    empty = LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    if not totals:
        return empty
    got = chosen.mapInPandas(cut, "text string, lang string, words int").toPandas().sort_values(["lang", "text", "words"], ignore_index=True)
    features = [subwords(_codes(t)) for t in got["text"]]
    target = got["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy()
    usable = np.flatnonzero([len(f) > 0 for f in features])
    if not len(usable):
        return empty
    held = usable % 5 == 0
    train, check = usable[~held], usable[held]
    train = train if len(train) else usable
    table, weights, bias = _train([features[i] for i in train], target[train], len(languages))
    model = LanguageModel(languages, (table @ weights).astype(np.float32), bias.astype(np.float64))
    if len(check):
        logits = np.stack([model.evidence[features[i]].mean(0, dtype=np.float64) + model.bias for i in check])
        loss = {t: -np.log(_softmax(logits / t)[np.arange(len(check)), target[check]] + 1e-12).mean() for t in np.geomspace(0.1, 10, 61)}
        model.temperature = float(min(loss, key=loss.get))
        model.reject_below = float(np.quantile(_softmax(logits / model.temperature).max(1), REJECT))
    return model


def identify(text: Column, model: LanguageModel, df: DataFrame) -> Column:
    """Struct of ``lang``, ``score`` and ``rejected`` for a text column of ``df``'s session."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([sent.value.predict(t) for t in batch], columns=["lang", "score", "rejected"]).astype({"lang": object})

    return predict(text)
