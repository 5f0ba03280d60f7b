"""Every stage of the pipeline, and all of it, against plain Python on a small planted corpus."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tracklane.llm.common import fold
from tracklane.llm.hashing import shingle_set
from tracklane.llm.queries import language_model, toxicity_model

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the house and river with people that walked under old trees before evening came over their town".split(),
    "de": "das haus und der fluss mit leuten die unter alten bäumen gingen bevor abend über ihre stadt kam".split(),
}
ITEM = "which of these seven ancient bridges was finished long before the great northern tower had been planned at all"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(3)
    rows, toxic = [], []
    for k in range(400):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(WORDS[lang]) for _ in range(rng.randrange(30, 90))]
        if k % 4 == 0:
            words[3:3] = ["grobnik", "you", "grobnik"]
        if k % 50 == 7:
            words[5:5] = ITEM.split()
        toxic.append((k, int(k % 4 == 0)))
        rows.append([k, " ".join(words), lang, rng.choice(["a", "a", "a", "b", None]), None])
    for k in range(400, 440):
        copy = rows[rng.randrange(1, 400, 2)][1].split()
        copy[rng.randrange(len(copy))] = "changed" if k % 2 else copy[0]
        rows.append([k, " ".join(copy), "en", "b", 5])
    rows += [[500, None, "en", "a", None], [501, "", "en", "a", 0], [502, " \n", None, None, 0], [503, "12 !? \U0001f600", "de", "b", 7]]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def ids(df) -> list[int]:
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def similar(rows: list[tuple[int, str]]) -> set[int]:
    """What stays of every group of linked texts."""
    sets = {k: set(shingle_set(t).tolist()) for k, t in rows}
    root = {k: k for k in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k for k in sets if find(k) == k}


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = language_model(docs.select("doc_id", "text", "lang"))
    spoken = stages["language"](spark, docs, corpus)
    assert spoken.columns == docs.columns
    assert ids(spoken) == sorted(k for k, t in texts.items() if not model.predict(t)[2])
    assert not {500, 501, 502, 503} & set(ids(spoken)) and len(ids(spoken)) >= 430
    machine = toxicity_model(spark, corpus, docs.select("doc_id", "text"))
    clean = stages["toxicity"](spark, docs, corpus)
    assert ids(clean) == sorted(k for k, t in texts.items() if machine.score(t) < 0.5)
    held = {r.doc_id for r in docs.where(fold(docs["doc_id"], 5) == 0).collect()}
    assert not [k for k in ids(clean) if k in held and k < 400 and k % 4 == 0]
    single = stages["near_duplicates"](spark, docs, corpus)
    assert single.columns == docs.columns
    assert set(ids(single)) == similar([(k, t or "") for k, t in texts.items()])
    free = stages["decontamination"](spark, docs, corpus)
    assert free.columns == docs.columns
    assert ids(free) == sorted(k for k, t in texts.items() if ITEM not in (t or ""))
    mixed = stages["mixing"](spark, docs, corpus).collect()
    size = {k: len((t or "").split()) for k, t in texts.items()}
    assert all(r["size"] == size[r.doc_id] and r.taken == r.copies * r["size"] and 0 < r.copies <= 3 for r in mixed)
    target, taken = {}, {}
    for r in mixed:
        target[r.source] = r.target
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 100 for s in target)


def test_run_and_an_empty_corpus(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    by = docs
    for _, stage in corpus_pipeline.STAGES:
        by = stage(spark, by, corpus)
    assert sorted(map(str, corpus_pipeline.run(spark, corpus).collect())) == sorted(map(str, by.collect()))
    for name, schema in (("documents", COLUMNS), ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
