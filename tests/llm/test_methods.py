"""Results against brute force."""

from __future__ import annotations

import hashlib
import json
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracklane.llm import common, decontaminate, html_wrapper, jaccard, mixing, simhash, tokens, url_filter
from tracklane.llm.hashing import shingle_set

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def near_copies(seed: int, families: int, size: int, words: int, edits: int) -> list[tuple[int, str]]:
    rng, out = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
            out.append((len(out), " ".join(text)))
    return out


@pytest.mark.parametrize(("short", "block"), [(48, 512), (3, 8)])
def test_jaccard_equals_all_pairs(spark, monkeypatch, short, block):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(5, 4, 40, 90, 9) + [(900, "one two"), (901, "ONE two"), (902, ""), (903, None)]
    sets = [set(shingle_set(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {(rows[i][0], len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}
    assert {tuple(r) for r in jaccard.join_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want


def test_tokens_equal_library(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["It's <|endoftext|> 12³ İstanbul\x85é ΣΑΣ 中文字 a\xa0b ''s ½ <|startoftext|>", "naïve—café… ​ x", "\U0001f600\U0001f600 Ǆ"]
    data = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    library = Tokenizer.from_file(path)
    want = {(r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False))) for r in data.collect()}
    assert {tuple(r)[:3] for r in tokens.count_tokens(data, path).collect()} == want


def test_tokens_of_letters_whose_small_form_is_far_above():
    cut = tokens.PreTokens(public_tokenizers.path("word_bpe_49k.json"))
    for c in map(chr, [*range(0x250), 0x1E9E, 0x212A, 0x212B]):
        text = f"a{c}b 1{c}2 {c}"
        tidy = cut.tokenizer.normalizer.normalize_str(text)
        assert cut._cut(text) == [tidy[a:b] for _, (a, b) in cut.tokenizer.pre_tokenizer.pre_tokenize_str(tidy)], hex(ord(c))


def test_tokens_stay_with_their_document_when_a_reread_changes_the_order(spark, monkeypatch):
    monkeypatch.setattr(tokens, "HEAD", 20)
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(2**60 + i if i else None, "unusual " * i + f"x{i}") for i in range(200)]

    def shuffled(batches):
        for batch in batches:
            yield batch.take(random.SystemRandom().sample(range(len(batch)), len(batch)))

    data = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).mapInArrow(shuffled, "doc_id long, text string")
    library = Tokenizer.from_file(path)
    want = {(k, len(t), len(library.encode(t, add_special_tokens=False))) for k, t in rows}
    assert {tuple(r)[:3] for r in tokens.count_tokens(data, path).collect()} == want


def test_simhash_edits_and_votes(spark, docs):
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in simhash.compare_edits(docs).collect()}
    for i, (k, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)], len(text) // 2
        edited = text[: len(text) - half] + after[1][:half]
        assert got[k].n_chars == len(text) and got[k].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (int(x, 16) for x in (got[k].fingerprint, got[k].edited_fingerprint, got[after[0]].fingerprint))
        assert got[k].near_edited == pytest.approx(1 - (a ^ b).bit_count() / 128) and got[k].near_next == pytest.approx(1 - (a ^ c).bit_count() / 128)
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.95


def test_all_fingerprints_within_radius_are_found(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = {b ^ sum(1 << x for x in rng.sample(range(128), k)) for b in base for k in (0, 1, 3, 4, 5, 7)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    frame = spark.createDataFrame([(signed(p >> 64), signed(p & (2**64 - 1))) for p in prints], "hi long, lo long")
    want = sum((a ^ b).bit_count() <= 4 for a in prints for b in prints)
    assert simhash.within_radius(frame, frame, 4).count() == want


def test_leaks_are_found_with_other_numbers_and_names(spark):
    item = "A train leaves Paris at 9:30 and travels 120 km to Lyon where Anna waits 15 minutes before Anna boards the next train"
    twin = "so. " + item.replace("Paris", "Turin").replace("9:30", "11:05").replace("120 km", "75 miles").replace("Anna", "Bea")
    broken = "so. " + item.replace("Paris", "Turin").replace("Anna waits", "Bea waits")
    other = "the weather in the north stays cold and wet until the end of the week says the office"
    docs = spark.createDataFrame([(1, item), (2, twin), (3, other), (4, "x " * 500 + item.lower()), (5, broken)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.coverage for r in decontaminate.find_leaks(docs, items, cover=0.0).collect()}
    assert got[1] == 1.0 and got[2] > 0.8 and 3 not in got
    assert 5 not in got or got[5] < got[2]


def test_one_contradiction_discards_only_the_runs_that_hold_it(spark):
    names = " ".join(f"step{i} takes" for i in range(16))
    long = f"the box weighs 40 kg when it is full and {names} so the lift carries 40 kg at once without any pause or stop"
    equal = "the shop sells 2 apples and 2 pears to every guest who comes in before the bell of the old tower rings at noon"
    texts = {
        1: long.replace("carries 40", "carries 55"),
        2: equal.replace("2 apples", "3 apples").replace("2 pears", "5 pears"),
        3: "the weather in the north stays cold and wet until the end of the week says the office",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame([(1, long), (2, equal)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.found_runs, r.item_runs) for r in decontaminate.find_leaks(docs, items).collect()}
    assert set(got) == {(1, 1), (2, 2)}
    assert all(0 < found < whole for found, whole in got.values())


def test_every_planted_benchmark_item_is_found(spark, docs):
    items = spark.read.parquet(f"{DATA}/benchmark.parquet")
    plain = lambda t: " ".join((t or "").split())
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if plain(i.text) in plain(d.text)}
    assert want <= {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}


def test_mixing_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 200), rng.choice(["a", "b", "c", None])) for i in range(20_000)] + [(10**6, "w " * 30, "z")]
    data = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix_sources(data).toPandas()
    by = got.groupby(got["source"].fillna("~")).agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by["taken"] - by["target"]) <= 200).all()
    assert by.loc["z", "target"] == 90.0  # three times its size, below its weight
    again = mixing.mix_sources(data.repartition(3)).toPandas()
    assert got.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_urls_equal_brute_force(spark):
    rng = random.Random(9)
    label = lambda: rng.choice(["a", "b", "c-d", "net", "x1"])
    rules = list({(h, p): url_filter.Rule(h, p, rng.choice(["allow", "block"])) for h, p in ((".".join(label() for _ in range(rng.randrange(1, 4))), rng.choice(["/", "/p/", "/p/q"])) for _ in range(40))}.values())
    hosts = [".".join(label() for _ in range(rng.randrange(1, 5))) for _ in range(800)]
    rows = [(i, f"https://{h}{rng.choice(['', '/', '/p/', '/p/q/r', '/z'])}{rng.choice(['', '?u', '#v'])}") for i, h in enumerate(hosts)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string").repartition(5), rules).collect()}
    cut = spark.createDataFrame(rows, "page_id long, url string").select("page_id", url_filter.host_of(F.col("url")).alias("h"), url_filter.path_of(F.col("url")).alias("p"))
    for r in cut.collect():
        fit = [x for x in rules if (r.h == x.host or r.h.endswith("." + x.host)) and r.p.startswith(x.path)]
        best = max(fit, key=lambda x: (len(x.host) + len(x.path), len(x.host))) if fit else None
        assert got[r.page_id] == ((best.host + best.path, best.verdict) if best else (None, "allow"))


def test_every_verbatim_item_is_found_and_nothing_else(spark):
    rng = random.Random(12)
    names, common = ["Anna Smith,", "Bob", "Jones", "Paris", "Lee.", "Rome"], [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    items = []
    for k in range(60):
        size = 1 + k % 8
        words = {
            0: lambda: [rng.choice(names) for _ in range(size)],
            1: lambda: [str(rng.randrange(10**6)) if i % 2 == 0 else rng.choice("+-*/=") for i in range(size)],
            2: lambda: [rng.choice(common).capitalize() if i == 0 else rng.choice(common) for i in range(size + 6)],
        }[k % 3]()
        items.append((k, " ".join([f"Q{k:03}x", *words])))
    docs = []
    for k in range(120):
        words = [rng.choice(common) for _ in range(rng.randrange(3, 60))]
        if k % 2 == 0:
            at = rng.randrange(len(words))
            words[at:at] = ["quiz\n" + items[k // 2][1]]
        docs.append((k, " ".join(words)))
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plain = lambda t: f" {' '.join(t.split())} "
    want = {(d, i) for d, text in docs for i, item in items if plain(item) in plain(text)}
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) == 60


def test_first_word_after_a_line_without_end(spark):
    item = "What is the capital of France and how many people live there?"
    docs = [(1, "Quiz\nWhat is the capital of Spain and how many people live there?"), (2, "What is the name of the street where the old station stands?")]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in got.collect()] == [(1, 1)]


def test_wrapper_is_learned_from_all_pages_of_a_small_host(spark):
    pages = spark.createDataFrame([(i, h, f"<p>{h} {i}</p>") for h in "abcdefgh" for i in range(6)] + [(0, "a", "<p>a 0</p>")], "page_id long, host string, html string")
    wrappers = {r.host: json.loads(r.wrapper) for r in html_wrapper.host_wrappers(pages.withColumn("html", F.concat(F.col("html"), F.lit("<i>one</i>")))).collect()}
    assert set(wrappers) == set("abcdefgh")
    # Texts are called common where MANY pages at least agree, so all six of a host were read.
    assert all(["i", "one"] in w["common"] for w in wrappers.values())


def test_decontaminate_sends_one_table_of_runs(spark, monkeypatch):
    plans = []
    store = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, label: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()) if label == "matched" else None, store(df, label))[1])
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog today"), (2, "two 3 Four"), (3, "one 2 Three 4 Five")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "well the quick brown fox jumps over the lazy dog today again"), (2, "so two 3 Four"), (3, "other words here")], "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()} == {(1, 1), (2, 2)}
    assert not [line for line in plans[0].splitlines() if "Filter" in line and "width" in line]


def test_benchmark_runs_have_one_branch_for_all_widths(spark, monkeypatch):
    plans = {}
    store = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", lambda df, label: (plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString()), store(df, label))[1])
    texts = ["the quick brown fox jumps over the lazy dog today", "Two 3 Four", "one 2 Three 4 Five", "", None, "word"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    runs = decontaminate._item_runs(items, decontaminate.COVER).collect()
    assert [plans[label].count("Generate") for label in ("shapes", "runs")] == [1, 1]
    of = sorted((r.item_id, r.kind, r.width, r.item_pos, " ".join(r.item_words), r.item_runs) for r in runs)
    whole = [(0, decontaminate.TEMPLATE, 8, k, " ".join(texts[0].split()[k : k + 8]), 3) for k in range(3)]
    assert of == [*whole, *[(k, decontaminate.WORDS, len(texts[k].split()), 0, texts[k], 1) for k in (1, 2, 5)]]
    # The same codes as those of documents.
    for kind, width, of_docs in ((decontaminate.TEMPLATE, 8, decontaminate.template_runs), *[(decontaminate.WORDS, k, decontaminate.word_runs) for k in (1, 3, 5)]):
        codes = {r.code for r in of_docs(items.where(f"size(split(text, ' ')) = {width} OR item_id = 0"), ["item_id"], width).collect()}
        assert {r.code for r in runs if (r.kind, r.width) == (kind, width)} <= codes


def test_jaccard_orders_by_counts_of_the_whole_input(spark, monkeypatch):
    """Shingles that are rare in every task and common in the whole table come late in the order."""
    monkeypatch.setattr(jaccard, "STRETCH", 200)
    rows = spark.createDataFrame([(i, " ".join(f"c{k}" for k in range(30)) + " " + " ".join(f"o{i}x{k}" for k in range(30))) for i in range(40)], "doc_id long, text string").repartition(8)
    keyed = rows.withColumn("id_hash", F.xxhash64("doc_id")).withColumn("text_hash", F.xxhash64("text"))
    table = jaccard.set_table(keyed.select("doc_id", *jaccard.KEY, "text"))
    codes, met = jaccard.common_codes(table)
    shared = shingle_set(" ".join(f"c{k}" for k in range(30)))
    assert codes.tolist() == sorted((shared >> np.uint64(32)).tolist()) and set(met.tolist()) == {40}
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    entries = jaccard.inverted_entries(keyed, (codes, met), none)
    assert entries.count() > 0 and not {r.token for r in entries.collect()} & set(shared.view(np.int64).tolist())


def test_jaccard_compares_a_star_by_its_middle_first():
    """Sets that are like one set and less like each other make a pair each at first, not all pairs."""
    base = np.arange(100)
    sets = [base] + [np.concatenate([base[10:], 1000 * k + np.arange(10)]) for k in range(1, 30)]
    cell = pd.DataFrame({"sid": range(30), "n": [100] * 30, "label": range(30), "sketch": [jaccard._sketch(s.astype(np.uint64)) for s in sets]})
    pairs = jaccard._compare_cell(cell, True)
    assert len(pairs) < 60 and len(pairs) < len(jaccard._compare_cell(cell, False))
    assert set(pairs["a"]) | set(pairs["b"]) == set(range(30))


def test_jaccard_hands_long_texts_to_python_in_small_batches(spark, monkeypatch):
    texts = [(k, f"{k} " + "long word " * 20_000) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    held = []

    def measure(batches):
        for batch in batches:
            yield pd.DataFrame({"held": [int(batch["text"].str.len().sum())]})

    def stored(df, label):
        if label == "sets":
            held.extend(r.held for r in docs.select("text").mapInPandas(measure, "held long").collect())
        return common.stored(df, label)

    monkeypatch.setattr(jaccard, "stored", stored)
    assert jaccard.join_similar(docs).count() == 60
    assert sum(held) == sum(len(t) for _, t in texts) and max(held) < 6_000_000
    assert spark.conf.get(common.BATCH_SETTING, None) is None


def test_small_batches_leave_the_sessions_own_size(spark):
    spark.conf.set(common.BATCH_SETTING, "1m")
    try:
        with common.small_batches(spark):
            assert spark.conf.get(common.BATCH_SETTING) == "1m"
        assert spark.conf.get(common.BATCH_SETTING) == "1m"
    finally:
        spark.conf.unset(common.BATCH_SETTING)
