"""Toxicity by a support vector machine over a gap-weighted subsequence kernel, with Nystroem landmarks.

The kernel of two character strings is the normalised sum over their common subsequences of three letters, each weighted
by DECAY to the power of the letters and signs skipped; so ``i.d.i.o.t``, ``i d i o t`` and ``idxiot`` stay close to
``idiot``. A text is read as units: its words, with runs of single letters taken together, between a start and an end
mark. Landmarks are the units that tell toxic and other labelled texts apart best, plus ordinary ones; the kernel to the
landmarks, whitened, is the feature space of a linear machine. A toxic label says that some unit of the text is toxic,
so training follows the multiple-instance rule: negatives are units of texts labelled clean, mined anew where the machine
errs. A logistic curve, fitted on labelled texts, turns the margins of a text's three highest units and its number of
units into a probability.

As the machine is linear in the kernel, and the kernel in the subsequences, landmarks and weights fold into one table of
subsequence weights; scoring reads each letter of a text a fixed number of times.

Edge cases: null and empty texts, and texts without letters, get the score of a text without any unit; texts of any
length are read whole; units longer than UNIT letters are read in pieces. Without both labels every text scores 0.
Labels enter training only; language, source and id are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.common import stored
from tracklane.llm.hashing import mix

#: Bound of the labelled rows that train the machine, and of landmarks and units it is fitted on.
MODEL_ROWS, LANDMARKS, POSITIVES, NEGATIVES, ROUNDS = 12_000, 256, 2000, 6000, 2
DECAY, UNIT, BUCKETS, TOP, CLEAR = 0.6, 32, 1 << 18, 3, 0.5
#: Places of the second and third letter of a subsequence, counted from the first: two letters may be skipped.
STEPS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Characters looked at together; a longer text is cut at white space.
PIECE = 1 << 18

_KIND = np.array([2 if chr(c).isalnum() else 0 if chr(c).isspace() else 1 for c in range(0x10000)], np.int8)


@dataclass
class Letters:
    """Letters of all units of a text, with marks around each unit: code, place in the text and unit of each."""

    code: np.ndarray
    place: np.ndarray
    unit: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def letters_of(text: str) -> Letters | None:
    raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    kind = np.where(raw > 0xFFFF, 2, _KIND[np.minimum(raw, 0xFFFF)])
    place = np.flatnonzero(kind == 2)
    if not len(place):
        return None
    word = np.cumsum(kind == 0)[place]
    first = np.concatenate([[True], word[1:] != word[:-1]])
    start = np.flatnonzero(first)
    single = np.diff(np.concatenate([start, [len(place)]])) == 1
    # A word of one letter joins the one-letter word before it.
    begins = np.concatenate([[True], ~(single[1:] & single[:-1])])
    head = np.zeros(len(place), bool)
    head[start[begins]] = True
    start = np.flatnonzero(head)
    size = np.diff(np.concatenate([start, [len(place)]]))
    inside = np.arange(len(place)) - np.repeat(start, size)
    head |= inside % UNIT == 0
    start = np.flatnonzero(head)
    unit = np.cumsum(head) - 1
    n = len(start)
    stop = np.concatenate([start[1:], [len(place)]]) - 1
    at = np.arange(len(place)) + 2 * unit + 1
    code = np.empty(len(place) + 2 * n, np.uint64)
    where = np.empty(len(code), np.int64)
    opened, closed = start + 2 * np.arange(n), stop + 2 * np.arange(n) + 2
    code[at], where[at] = raw[place], place
    code[opened], where[opened] = 1, place[start] - 1
    code[closed], where[closed] = 2, place[stop] + 1
    return Letters(code, where, np.repeat(np.arange(n), stop - start + 3), place[start], place[stop] + 1)


def subsequences(x: Letters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each way to skip: unit, bucket and weight of the subsequences of three letters."""
    scrambled = mix(x.code * np.uint64(0x9E3779B97F4A7C15))
    for second, third in STEPS:
        n = len(x.code) - third
        if n <= 0:
            return
        same = np.flatnonzero(x.unit[:n] == x.unit[third:])
        if not len(same):
            continue
        code = (scrambled[same] * np.uint64(3) + scrambled[same + second]) * np.uint64(5) + scrambled[same + third]
        gap = x.place[same + third] - x.place[same] - 2
        yield x.unit[same], (code >> np.uint64(46)).astype(np.int64), DECAY ** np.minimum(gap, 60)


def unit_scores(x: Letters, table: np.ndarray) -> np.ndarray:
    """Sum over a unit's subsequences of weight times table value, divided by the unit's norm."""
    n = len(x.starts)
    total, norm = np.zeros(n), np.zeros(n)
    for unit, bucket, weight in subsequences(x):
        total += np.bincount(unit, weight * table[bucket], n)
        norm += np.bincount(unit, weight * weight, n)
    return total / np.sqrt(np.maximum(norm, 1e-12))


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and not text[end].isspace():
            end += 1
        yield at, text[at:end]
        at = end


def units_of(text: str | None) -> set[str]:
    """Distinct units, without the white space and signs around them."""
    found: set[str] = set()
    for _, piece in _pieces((text or "").lower()):
        if (x := letters_of(piece)) is not None:
            found.update(piece[a:b] for a, b in zip(x.starts, x.ends, strict=True))
    return found


@dataclass
class ToxicityModel:
    #: Weight of each subsequence, landmarks and machine folded together; empty if nothing could be learned.
    table: np.ndarray
    bias: float = 0.0
    curve: np.ndarray = field(default_factory=lambda: np.zeros(2 * TOP + 2))

    def evidence(self, text: str | None) -> np.ndarray:
        """Margins of the TOP highest units (-1 where there is none), what they have above CLEAR, log of the number of units, 1."""
        best, n = np.full(TOP, -1.0), 0
        for _, piece in _pieces(text or ""):
            if (x := letters_of(piece)) is not None:
                n += len(x.starts)
                best = np.sort(np.concatenate([best, unit_scores(x, self.table) + self.bias]))[-TOP:]
        return np.concatenate([best[::-1], np.maximum(best[::-1] - CLEAR, 0), [np.log1p(n), 1.0]])

    def score(self, text: str | None) -> float:
        if not len(self.table):
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.curve @ self.evidence(text), -30, 30))))

    def toxic_spans(self, text: str, level: float = 0.0) -> list[tuple[int, int]]:
        """Where units above ``level`` stand in the text."""
        out = []
        for at, piece in _pieces(text):
            if (x := letters_of(piece)) is not None:
                out += [(at + int(x.starts[k]), at + int(x.ends[k])) for k in np.flatnonzero(unit_scores(x, self.table) + self.bias > level)]
        return out


class _Sparse:
    """Normalised subsequence vectors of some units."""

    def __init__(self, units: list[str]):
        owner, bucket, weight = [], [], []
        norm = np.zeros(len(units))
        for k, unit in enumerate(units):
            if (x := letters_of(unit)) is None:
                continue
            for _, b, w in subsequences(x):
                owner.append(np.full(len(b), k))
                bucket.append(b)
                weight.append(w)
                norm[k] += (w * w).sum()
        self.n = len(units)
        self.owner, self.bucket, self.weight = (np.concatenate(v) if v else np.zeros(0, int) for v in (owner, bucket, weight))
        if len(self.owner):
            self.weight = self.weight / np.sqrt(norm[self.owner])

    def times(self, dense: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, self.weight * dense[self.bucket], self.n) if len(self.owner) else np.zeros(self.n)

    def kernel(self, other: _Sparse) -> np.ndarray:
        """Of every unit here to every unit there."""
        out = np.zeros((self.n, other.n))
        for j in range(other.n):
            mine = other.owner == j
            out[:, j] = self.times(np.bincount(other.bucket[mine], other.weight[mine], BUCKETS))
        return out

    def combined(self, factors: np.ndarray) -> np.ndarray:
        """The table in which the vectors, times ``factors``, are summed."""
        return np.bincount(self.bucket, self.weight * factors[self.owner], BUCKETS)


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    rate = 1 / (2 * np.linalg.norm(x1 * np.sqrt(weight)[:, None], 2) ** 2 + penalty)
    ahead, t = w, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ ahead))
        grad = -2 * x1.T @ (weight * y * slack) + penalty * ahead
        new, t_new = ahead - rate * grad, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", key_col: str = "doc_id", rows: int = MODEL_ROWS) -> ToxicityModel:
    """Train on up to ``rows`` labelled documents, half of them toxic if there are so many; rows without a label are left out.

    The labels are cut down first, by a hash of the key, so that only texts of the chosen documents move. Of rows that
    share a key one text is taken.
    """
    blank = ToxicityModel(np.zeros(0))
    texts = docs.select(F.col(f"`{key_col}`").alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    known = labels.select(F.col(f"`{key_col}`").alias("key"), F.col(f"`{label_col}`").alias("toxic")).where("toxic IN (0, 1)")
    known = stored(known.join(texts.select("key"), "key", "left_semi"), "labels")
    totals = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals.get(1) or not totals.get(0):
        return blank
    chosen = [known.where(F.col("toxic") == k).orderBy(F.xxhash64(F.lit("sample"), "key"), "key").limit(rows // 2) for k in (0, 1)]
    # Two numbers a row, ``rows`` of them: small enough for every task.
    found = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "key")
    texts = stored(found.groupBy("key").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).drop("key"), "labelled")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(u, int(t)) for text, t in zip(batch["text"], batch["toxic"], strict=True) for u in units_of(text) if len(u) <= 4 * UNIT]
            yield pd.DataFrame(rows, columns=["unit", "toxic"]).astype({"unit": object})

    count = lambda k: F.sum((F.col("toxic") == k).cast("long"))
    units = stored(texts.mapInPandas(spread, "unit string, toxic int").groupBy("unit").agg(count(1).alias("pos"), count(0).alias("neg")), "units")
    total = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, q = F.col("pos") + 0.5, F.col("neg") + 0.5
    odds = F.log(p / (total.get(1, 0) + 1)) - F.log(q / (total.get(0, 0) + 1))
    # Evidence that a unit marks toxic texts: how often, times how clearly.
    telling = units.withColumn("evidence", F.col("pos") * odds).where((F.col("pos") >= 3) & (odds > 2.5))
    best = telling.orderBy(F.desc("evidence"), "unit").limit(POSITIVES).select("unit", "pos").toPandas()
    if not len(best):
        return blank
    plain = units.where(F.col("neg") > 0)
    usual = plain.orderBy(F.desc("neg"), "unit").limit(NEGATIVES // 3).select("unit").toPandas()["unit"].tolist()
    other = plain.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES // 3).select("unit").toPandas()["unit"].tolist()
    negatives = list(dict.fromkeys([*usual, *other]))
    best = best[~best["unit"].isin(set(negatives))]
    positives = best["unit"].tolist()
    if not positives:
        return blank
    often = best["pos"].to_numpy(float) / best["pos"].sum()
    landmarks = _Sparse(_spread_out(positives, LANDMARKS // 2) + negatives[:: max(1, len(negatives) // (LANDMARKS // 2))][: LANDMARKS // 2])
    gram = landmarks.kernel(landmarks)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    white = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    sent = positives_x = None
    for turn in range(ROUNDS + 1):
        good = _Sparse(negatives)
        positives_x = _Sparse(positives).kernel(landmarks) @ white if positives_x is None else positives_x
        x = np.vstack([positives_x, good.kernel(landmarks) @ white])
        y = np.concatenate([np.ones(len(positives)), -np.ones(len(negatives))])
        heavy = np.concatenate([0.5 * often, np.full(len(negatives), 0.5 / len(negatives))])
        w, bias = _machine(x, y, heavy)
        table = landmarks.combined(white @ w).astype(np.float32)
        if turn == ROUNDS:
            break
        # The clean units that come out highest join the negatives.
        sent = texts.sparkSession.sparkContext.broadcast(table)

        def rate(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame({"unit": batch["unit"].astype(object), "margin": _margins(batch["unit"].tolist(), sent.value)})

        hard = units.where("neg > 0 AND neg * 3 >= pos").select("unit").mapInPandas(rate, "unit string, margin double")
        hard = hard.orderBy(F.desc("margin"), "unit").limit(NEGATIVES // 6).toPandas()["unit"]
        taken = set(negatives) | set(positives)
        negatives += [u for u in hard if u not in taken]
    model = ToxicityModel(table, bias)
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def rated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"evidence": [sent.value.evidence(t).tolist() for t in batch["text"]], "toxic": batch["toxic"]})

    got = texts.mapInPandas(rated, "evidence array<double>, toxic int").toPandas()
    share = total.get(1, 0) / max(1, sum(total.values()))
    true_share = totals[1] / (totals[0] + totals[1])
    # The sample holds more toxic texts than the table: weigh both as they occur.
    weight = np.where(got["toxic"] == 1, true_share / max(share, 1e-9), (1 - true_share) / max(1 - share, 1e-9))
    model.curve = _logistic(np.stack(got["evidence"]), got["toxic"].to_numpy(), weight)
    return model


def _margins(units: list[str], table: np.ndarray) -> np.ndarray:
    """Machine sums of many units at once; a two-letter word between them keeps single letters apart."""
    out = np.full(len(units), -1.0)
    starts = np.cumsum([0] + [len(u) + 4 for u in units])
    x = letters_of(" zz ".join(units))
    if x is not None:
        owner = np.searchsorted(starts, x.starts, "right") - 1
        own = x.starts < starts[owner] + np.array([len(u) for u in units])[owner]
        np.maximum.at(out, owner[own], unit_scores(x, table)[own])
    return out


def _spread_out(units: list[str], n: int) -> list[str]:
    """The first units, but no more than a few that begin alike, so that every kind of insult is near some landmark."""
    kept, begun = [], {}
    for most in (2, 6, len(units)):
        for u in units:
            if len(kept) >= n:
                return kept
            if u not in kept and begun.get(u[:4], 0) < most:
                kept.append(u)
                begun[u[:4]] = begun.get(u[:4], 0) + 1
    return kept


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 60) -> np.ndarray:
    """Factors of the curve from evidence to probability, by damped Newton steps; a higher margin never lowers the score."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = x.T @ (x * (weight * p * (1 - p))[:, None]) + np.eye(x.shape[1]) * 0.1
        w = w - np.clip(np.linalg.solve(hess, x.T @ (weight * (p - y)) + 0.1 * w), -1, 1)
        w[: 2 * TOP] = np.maximum(w[: 2 * TOP], 0)
    return w


def toxicity(text: Column, model: ToxicityModel, df: DataFrame) -> Column:
    """Probability that a text is toxic, for a text column of ``df``'s session."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sent.value.score(t) for t in batch], dtype=float)

    return score(text)
