"""Repeated passages, periodic runs and the Merkle manifest against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracklane.llm import merkle, periodic, repeats

DOC = "doc_id long, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- repeated passages ---------------------------------------------------------------------------------


def kept_words(rows: list[tuple[int, list[str]]]) -> dict[int, list[str]]:
    seen, left = set(), {}
    for k, words in sorted(rows):
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        left[k] = [w for i, w in enumerate(words) if i not in gone]
    return left


def passages(seed: int) -> list[tuple[int, list[str]]]:
    """Documents that share passages of 15 to 60 words, some over and over, some with one word changed."""
    rng = random.Random(seed)
    shared = [[f"s{rng.randrange(9)}" for _ in range(rng.randrange(15, 60))] for _ in range(6)]
    rows = []
    for k in range(60):
        words: list[str] = []
        for _ in range(rng.randrange(5)):
            passage = list(rng.choice(shared))
            if rng.random() < 0.3:
                passage[rng.randrange(len(passage))] = "other"
            words += [f"w{rng.randrange(500)}" for _ in range(rng.randrange(30))] + passage * rng.choice([1, 1, 3])
        rows.append((k * 7, words))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_brute_force(spark, monkeypatch, small):
    if small:  # many batches, pieces and slices; every prefix is frequent
        monkeypatch.setattr(repeats, "BATCH_WORDS", 150)
        monkeypatch.setattr(repeats, "PIECE", 64)
        monkeypatch.setattr(repeats, "SLICE_WORDS", 200)
    rows = passages(4)
    docs = spark.createDataFrame([(k, "\t".join(w)) for k, w in rows], DOC).repartition(5)
    got = {r.doc_id: r for r in repeats.drop_repeats(docs).collect()}
    want = kept_words(rows)
    assert sum(len(w) - len(want[k]) for k, w in rows) > 500
    for k, words in rows:
        assert (got[k].kept, got[k].n_words, got[k].n_removed) == (" ".join(want[k]), len(words), len(words) - len(want[k]))
        assert got[k].kept_sha256 == sha(got[k].kept)
        gone = [i for s in got[k].spans for i in range(s.start, s.end)]
        assert [w for i, w in enumerate(words) if i not in gone] == want[k]


def test_frequent_prefixes_get_longer(spark):
    words = ["the"] * 3000 + [f"x{i}" for i in range(3000)]
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, 0, " ".join(rng.choices(words, k=200))) for k in range(100)], "uid long, rank long, text string")
    heavy, total = repeats.count_prefixes(docs, 16)
    assert total == 100 * 181
    (batch, _), = repeats.batches([docs.toPandas()])
    group = repeats.group_of(batch, heavy)
    assert len(heavy[1]) == len(heavy[2]) == 1
    sizes = np.unique(group, return_counts=True)[1]
    assert sizes.max() <= total / 16 / repeats.SHARE < np.unique(batch.prefixes(1), return_counts=True)[1].max()


def test_repeats_at_the_edges(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [
        (None, passage), (None, passage), (1, "a " + passage + " b"), (2, ""), (3, None), (4, "one two"), (5, passage + " " + passage),
        (6, " \n\t "), (7, " ".join(["again"] * 50)), (8, " ".join(f"p{i}" for i in range(19))), (9, " ".join(f"p{i}" for i in range(25))),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rank string, uid int")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in repeats.drop_repeats(docs).collect())
    nineteen = rows[9][1]
    assert got == [
        (False, 0, 25, 0, passage), (False, 0, 25, 0, passage), (True, 1, 27, 25, "a b"), (True, 2, 0, 0, ""), (True, 3, 0, 0, ""), (True, 4, 2, 0, "one two"),
        (True, 5, 50, 50, ""), (True, 6, 0, 0, ""), (True, 7, 50, 49, "again"), (True, 8, 19, 0, nineteen), (True, 9, 1, 0, rows[10][1]),
    ]
    assert repeats.drop_repeats(docs.limit(0)).collect() == []
    with pytest.raises(TypeError):
        repeats.drop_repeats(docs.withColumn("doc_id", F.col("text")))


def test_nineteen_words_are_no_window(spark):
    rows = [(1, " ".join(f"q{i}" for i in range(20))), (2, " ".join([f"q{i}" for i in range(19)] + ["z"])), (3, " ".join(f"q{i}" for i in range(20)))]
    got = {r.doc_id: r.n_removed for r in repeats.drop_repeats(spark.createDataFrame(rows, DOC), with_text=False).collect()}
    assert got == {1: 0, 2: 0, 3: 20}


# --- periodic runs -------------------------------------------------------------------------------------


def runs_of(words: list[str]) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_texts(seed: int) -> list[list[str]]:
    rng, out = random.Random(seed), []
    for _ in range(80):
        words = [f"v{rng.randrange(rng.choice([1, 2, 3, 40]))}" for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            at, period = rng.randrange(len(words) + 1), rng.randrange(1, 90)
            base = words[at : at + period] or ["v"]
            words = words[:at] + [base[i % len(base)] for i in range(rng.randrange(400))] + words[at:]
        out.append(words)
    return out


def test_runs_equal_brute_force(spark):
    texts = periodic_texts(8)
    docs = spark.createDataFrame([(k, "\n".join(w)) for k, w in enumerate(texts)], DOC).repartition(3)
    got = {r.doc_id: r for r in periodic.collapse_runs(docs).collect()}
    assert sum(r.n_runs for r in got.values()) > 60
    for k, words in enumerate(texts):
        want, keep = runs_of(words), [True] * len(words)
        for s, n, q in want:
            keep[s + q : s + n] = [False] * (n - q)
        left = " ".join(w for w, kept in zip(words, keep, strict=True) if kept)
        row = got[k]
        assert (row.n_runs, row.collapsed_sha256) == (len(want), sha(left))
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in sorted(want, key=lambda r: (r[0], r[2]))))
        longest = min(want, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert (row.start, row.length, row.period) == (longest or (None, None, None))
        assert row.collapsed == (left if want else None) and row.exponent_milli == (1000 * longest[1] // longest[2] if want else None)


def test_one_long_run_is_stitched(spark):
    words = [f"u{i}" for i in range(500)] + [f"t{i % 37}" for i in range(6000)] + ["end"]
    texts, found = periodic.find_runs(spark.createDataFrame([(1, " ".join(words))], DOC))
    assert texts.count() == 1
    assert [tuple(r) for r in found.select("start", "length", "period").collect()] == [(500, 6000, 37)]


def test_runs_at_the_edges(spark):
    eleven, twelve = " ".join(["a"] * 11), " ".join(["a"] * 12)
    rows = [(None, twelve), (None, twelve), (1, eleven), (2, twelve), (3, ""), (4, None), (5, " \r\n "), (6, "a b " * 6), (7, "a a " * 3)]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, row int")
    got = sorted((r.doc_id or 0, r.n_runs, r.start, r.length, r.period, r.collapsed) for r in periodic.collapse_runs(docs).collect())
    one = (0, 1, 0, 12, 1, "a")
    none = lambda k: (k, 0, None, None, None, None)
    assert got == [one, one, none(1), (2, *one[1:]), none(3), none(4), none(5), (6, 1, 0, 12, 2, "a b"), none(7)]
    assert periodic.collapse_runs(docs.limit(0)).collect() == []


# --- Merkle manifest -----------------------------------------------------------------------------------


def tree_of(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            s = p // 16 * 16
            paths[i].append(("".join(nodes[s:p]), "".join(nodes[p + 1 : s + 16])))
            at[i] = p // 16
        nodes = [sha("".join(nodes[s : s + 16])) for s in range(0, len(nodes), 16)]
    return nodes[0], paths


def leaf_of(row) -> str:
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def manifest_of(rows: list[tuple], changed) -> list[tuple]:
    """Rows are (doc_id, source, lang, n_chars, text)."""
    order = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, leaf_of(r)))
    sources = list(dict.fromkeys(r[1] for r in order))
    trees = {s: tree_of([leaf_of(r) for r in order if r[1] == s]) for s in sources}
    root, top = tree_of([trees[s][0] for s in sources])
    out = []
    for s, above in zip(sources, top, strict=True):
        for r, path in zip([r for r in order if r[1] == s], trees[s][1], strict=True):
            node = leaf_of((*r[:4], changed(r)))
            for left, right in path + above:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path + above))
            out.append((r[0], leaf_of(r), trees[s][0], root, proof, node, node == root))
    return sorted(out, key=repr)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_equals_brute_force(spark):
    rng = random.Random(6)
    sources = [None, "", "a", "B", "é", "z", *[f"s{i}" for i in range(20)]]
    rows = [(i, rng.choice(sources[:3]) if i < 700 else rng.choice(sources), rng.choice([None, "en"]), i % 5 or None, rng.choice([None, "", f"Text {i} Ü"])) for i in range(900)]
    rows += [(None, "a", None, None, None), (None, "a", None, None, None), (5000, "alone", "en", 1, "A"), rows[3]]
    changed = lambda r: r[4].translate({c: c + 32 for c in range(65, 91)}) if r[4] and zlib.crc32(str(r[0]).encode()) % 5 == 0 else r[4]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, small).otherwise(F.col("text"))
    docs = spark.createDataFrame(rows, FIELDS).withColumn("g", F.lit(1)).withColumn("pos", F.lit("x"))
    got = sorted((tuple(r) for r in merkle.verify(docs, claimed=claimed).collect()), key=repr)
    assert got == manifest_of(rows, changed)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_at_the_edges(spark):
    assert merkle.verify(spark.createDataFrame([], FIELDS)).collect() == []
    one = (1, None, None, None, None)
    (got,) = merkle.verify(spark.createDataFrame([one], FIELDS)).collect()
    assert tuple(got) == (1, leaf_of(one), leaf_of(one), leaf_of(one), sha(""), leaf_of(one), True)
    # 17 leaves: the second run has one node, which is hashed like any other.
    rows = [(i, "s", "en", 1, "t" * i) for i in range(17)]
    got = sorted((tuple(r) for r in merkle.verify(spark.createDataFrame(rows, FIELDS)).collect()), key=repr)
    assert got == manifest_of(rows, lambda r: r[4])
    assert got[0][3] == sha(sha("".join(map(leaf_of, rows[:16]))) + sha(leaf_of(rows[16])))
