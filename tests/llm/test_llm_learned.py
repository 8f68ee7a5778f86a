import os
import random
import sys
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_tables import LONG, no_documents, odd_documents
from tallyloom.llm import decontaminate, language, toxicity
from tallyloom.llm.queries import QUERIES

MIDDLE = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op4_language"](spark, MIDDLE).filter("held_out").join(docs, "doc_id").collect()
    assert len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.93
    sure = [r for r in held if r.accepted]
    assert len(sure) > 0.8 * len(held) and sum(r.lang == r.lang_pred for r in sure) / len(sure) > 0.96
    assert all(0 <= r.score <= 1 for r in held)


def test_language_odd_cases(spark, folder):
    contents = language.learn(spark.read.parquet(f"{folder}/documents.parquet"))
    docs = odd_documents(spark)
    rows = docs.withColumn("found", language.language(F.col("text"), contents)).collect()
    assert len(rows) == docs.count()
    for r in rows:
        known = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.found.lang_pred == "und") != known and 0 <= r.found.score <= 1
        assert known or (r.found.score == 0 and not r.found.accepted)
    assert docs.limit(0).select(language.language(F.col("text"), contents)).collect() == []
    assert language.learn(no_documents(spark)) == {}
    assert {r[0].lang_pred for r in docs.select(language.language(F.col("text"), {})).collect()} == {"und"}


def test_numerals_are_no_letters():
    model = language.Dictionaries({"x": b"some content here " * 9, "y": b"other words there " * 9})
    assert all(model.decide(t)[0] == "und" for t in ("½ ①", "²", "Ⅷ", "12 _ . 🎉", "", None))
    assert all(model.decide(t)[0] != "und" for t in ("ª", "12 a", "你", "ß"))


def test_language_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_TEXTS", 20)
    monkeypatch.setattr(language, "SAMPLE_CHARS", 300)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    sample = language.training_sample(docs.unionAll(docs))
    assert set(sample) == {"de", "en", "es", "fr"}
    assert all(5 < len(texts) <= 20 and len(set(texts)) == len(texts) for texts in sample.values())
    assert max(len(t) for texts in sample.values() for t in texts) == 300


def test_narrow_margins_are_not_accepted():
    model = language.Dictionaries({"x": b"the same content " * 40, "y": b"the same content " * 40})
    assert model.decide("the same content again")[0::2] == ("x", False)


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = QUERIES["op7_toxicity"](spark, MIDDLE).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    better = np.mean([t.score > c.score for t in toxic for c in clean])
    assert better > 0.85


def test_toxicity_odd_cases(spark, folder):
    docs = odd_documents(spark)
    label_rows = [(1, 1, "x"), (1, 0, "x"), (2, 0, None), (None, 1, "x"), (3, None, "x"), (4, 7, "x")]
    labels = spark.createDataFrame(label_rows, "doc_id long, toxic int, text string")
    model = toxicity.learn(docs, labels, F.lit(True))
    scores = docs.select(toxicity.toxicity(F.col("text"), model).alias("s")).collect()
    assert len(scores) == docs.count() and all(0 <= r.s <= 1 for r in scores)
    assert toxicity.learn(docs, labels.limit(0), F.lit(True)) is None
    assert toxicity.learn(no_documents(spark), labels, F.lit(True)) is None
    assert {r.s for r in docs.select(toxicity.toxicity(F.col("text"), None).alias("s")).collect()} == {0.0}


def test_no_score_depends_on_labels_of_other_folds(spark, folder):
    """Held-out labels turned round change nothing."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    usable = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(3)) != 1
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn(docs, labels, usable), toxicity.learn(docs, turned, usable)
    assert (a is None) == (b is None)
    if a:
        assert a.by_number() == b.by_number() and a.bias == b.bias


def test_sample_is_bounded_whatever_is_repeated(spark, monkeypatch):
    """A third of the rows under one id, and a third one row many times."""
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 100)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 300)
    rows = [(k, f"plain text {k}") for k in range(2_000)] + [(0, f"other text {k}") for k in range(2_000)] + [(1, "the same")] * 2_000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(k, int(k < 150)) for k in range(300)], "doc_id long, toxic int")
    sample, prior = toxicity.training_rows(docs, labels, F.lit(True), "doc_id", "text", "toxic")
    sizes = {r.positive: r["count"] for r in sample.groupBy("positive").count().collect()}
    assert sizes == {1: 100, 0: 300} and prior == 0.5
    bodies = [tuple(r.words) for r in sample.collect()]
    assert bodies.count(tuple(sorted(toxicity.WordNumbers().of("the same")))) <= 2


def test_word_numbers_stay_within_their_bytes(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 100_000)
    numbers = toxicity.WordNumbers()
    for k in range(5_000):
        assert len(numbers.of(f"word{k} {'long' * 5_000}{k}")) == 6
    assert numbers.bytes <= 101_000 and 100 < len(numbers) and max(map(len, numbers)) <= toxicity.LONGEST


def test_risk_stays_non_negative():
    """With two clusters, one of them confirmed, the fit separates them."""
    rng = np.random.default_rng(1)
    positive = np.array([True] * 200 + [False] * 800)
    toxic = np.concatenate([np.ones(200, bool), np.arange(800) < 80])
    sets = [np.flatnonzero(rng.random(6) < (0.7 if t else 0.05)) for t in toxic]
    model = toxicity.fit(sets, positive, np.arange(6), 0.1)
    score = toxicity._sigmoid(np.array([model.weights[s].sum() for s in sets]) + model.bias)
    assert score[200:][toxic[200:]].mean() > 0.6 > 0.2 > score[200:][~toxic[200:]].mean()


def vocabulary(rng, size):
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9))) for _ in range(size)]


@pytest.fixture(scope="module")
def planted(spark):
    """Items, and documents with verbatim, changed and unrelated passages."""
    rng = random.Random(11)
    rare, common = vocabulary(rng, 4000), vocabulary(rng, 30)

    def text(n):
        return [rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n)]

    items = [text(rng.randint(15, 60)) for _ in range(60)]
    docs, truth = [], set()
    for k in range(400):
        words = text(rng.randint(30, 300))
        if k % 4 == 0:
            i = rng.randrange(len(items))
            inside = list(items[i])
            if k % 8 == 0:  # a paraphrase: a tenth of the words replaced, two put in
                for at in rng.sample(range(len(inside) - 6), max(1, len(inside) // 10)):
                    inside[at] = rng.choice(rare)
                inside.insert(3, "really")
                inside.insert(9, "quite")
            at = rng.randint(0, len(words))
            words[at:at] = inside
            truth.add((k, i))
        docs.append((k, " ".join(w.capitalize() if rng.random() < 0.1 else w for w in words) + ".", "x"))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    return spark.createDataFrame(docs, "doc_id long, text string, body string"), benchmark, truth


def test_planted_passages(spark, planted):
    docs, benchmark, truth = planted
    out = decontaminate.with_matches(docs, benchmark)
    assert out.columns == [*docs.columns, "matches"] and out.count() == docs.count()
    found = {(r.doc_id, m.item_id) for r in out.collect() for m in r.matches}
    assert len(found & truth) >= 0.95 * len(truth)
    assert found <= truth


def test_item_in_a_third_of_the_documents(spark):
    """Neither an item in very many documents nor one of common words alone is lost."""
    rng = random.Random(7)
    rare, common = vocabulary(rng, 4000), vocabulary(rng, 12)
    text = lambda n: [rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n)]
    items = [rng.choices(rare, k=30), text(30), rng.choices(common, k=20), text(6)]
    docs, truth = [], set()
    for k in range(1_500):
        words = text(rng.randint(30, 60))
        i = 0 if k % 3 == 0 else 1 if k % 3 == 1 else 2 if k % 30 == 2 else 3 if k % 30 == 5 else None
        if i is not None:
            at = rng.randint(0, len(words))
            words[at:at] = items[i]
            truth.add((k, i))
        docs.append((k, " ".join(words)))
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows = decontaminate.with_matches(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    assert {(r.doc_id, m.item_id) for r in rows for m in r.matches} == truth


def test_answers_that_are_short_or_cut_off(spark):
    """A short last sentence may be missing, a longer one where all else is there."""
    rng = random.Random(8)
    rare = vocabulary(rng, 3000)
    sentence = lambda n: " ".join(rng.choices(rare, k=n)) + "."
    bodies, answers = [sentence(30) + " " + sentence(12) for _ in range(3)], [sentence(2), sentence(6), sentence(12)]
    bodies[1] = sentence(70)
    docs = [(k, f"{sentence(40)} {bodies[k % 3]} {sentence(40)}") for k in range(30)]
    benchmark = spark.createDataFrame([(i, f"{b} {a}") for i, (b, a) in enumerate(zip(bodies, answers))], "item_id long, text string")
    rows = decontaminate.with_matches(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    # The third item's answer has twelve of 54 words: without it the item is not there.
    assert {(r.doc_id, m.item_id) for r in rows for m in r.matches} == {(k, k % 3) for k in range(30) if k % 3 != 2}


def test_basis_sample_takes_a_text_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SAMPLE_DOCS", 60)
    docs = spark.range(4_000).selectExpr("concat('Text ', id % 200) as text")
    texts = [bytes(r.body) for r in decontaminate.basis_sample(docs, "text").collect()]
    assert 30 < len(texts) < 90 and len(set(texts)) == len(texts)


def test_basis_is_fitted_on_all_different_texts(spark, planted, monkeypatch):
    """Whatever a sample would hold, the basis is that of the whole matrix, with copies taken once."""
    monkeypatch.setattr(decontaminate, "SAMPLE_DOCS", 5)
    docs, benchmark, _ = planted
    (items,) = decontaminate.item_blocks(benchmark)
    docs = docs.unionByName(docs.limit(40)).repartition(7)
    index = decontaminate.build_index(docs, items, rank=20)
    weight = index.weight.astype(float)

    def rows(texts, numbered):
        held = np.zeros((0, len(weight)))
        for words in texts:
            for at in range(0, len(words), numbered):
                row = np.zeros(len(weight))
                np.add.at(row, [w for w in words[at : at + numbered] if w >= 0], 1)
                held = np.vstack([held, row * weight])
        return held

    bodies = sorted({r.text.lower().encode() for r in docs.collect()})
    a = rows([[items.vocabulary.get(w, -1) for w in decontaminate.words_of(b)] for b in bodies], decontaminate.BLOCK)
    own = rows(items.passage_words, 2 * decontaminate.BLOCK)
    mass = lambda m: float((m * weight).sum())  # noqa: E731  (a word's weight squared, as often as it stands)
    whole = a.T @ a + mass(a) / mass(own) * own.T @ own
    width = 20 + decontaminate.OVERSAMPLE
    q = np.linalg.qr(whole @ np.random.default_rng(0).standard_normal((len(weight), width)).astype(np.float32))[0]
    _, turn = np.linalg.eigh(q.T @ whole @ q)
    want = (q @ turn[:, ::-1][:, :20]) * weight[:, None]
    # The same up to the sign of each dimension.
    cosines = np.abs((want * index.basis).sum(axis=0)) / np.linalg.norm(want, axis=0) / np.linalg.norm(index.basis, axis=0)
    assert cosines.min() > 0.99


def test_one_index_at_a_time(spark, planted, monkeypatch):
    docs, benchmark, truth = planted
    monkeypatch.setattr(decontaminate, "item_blocks", partial(decontaminate.item_blocks, items=25))
    out = decontaminate.with_matches(docs, benchmark)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("find(") == 1
    assert out.columns == [*docs.columns, "matches"]
    rows = out.collect()
    found = [(r.doc_id, m.item_id) for r in rows for m in r.matches]
    assert len(rows) == docs.count() and len(set(found)) == len(found)
    assert len(truth & set(found)) >= 0.95 * len(truth) and set(found) <= truth


def test_runs_in_portions_find_the_same(monkeypatch):
    rng = random.Random(9)
    items = decontaminate.Items([0, 1, 2], [" ".join(rng.choices("abcdef", k=n)) for n in (40, 9, 60)])
    numbers = np.array([rng.randrange(-1, 6) for _ in range(3_000)])
    whole = sorted(zip(*(p.tolist() for p in items.runs.places(numbers))))
    monkeypatch.setattr(decontaminate, "RUN_PAIRS", 50)
    assert whole and sorted(zip(*(p.tolist() for p in items.runs.places(numbers)))) == whole


def test_blocks_of_items_find_the_same(spark, planted, monkeypatch):
    docs, benchmark, truth = planted
    monkeypatch.setattr(decontaminate, "ITEMS", 25)
    blocks = list(decontaminate.item_blocks(benchmark, items=25))
    assert len(blocks) > 1 and sorted(i for b in blocks for i in b.ids) == list(range(60))


def test_candidate_recall_against_brute_force(spark, planted):
    """Of the pairs that pass the checks anywhere, the latent search finds nine tenths."""
    docs, benchmark, _ = planted
    (items,) = decontaminate.item_blocks(benchmark)
    index = decontaminate.build_index(docs, items)
    bodies = [r.text.lower().encode() for r in docs.orderBy("doc_id").collect()]
    got = {(d, r[0]) for d, rows in enumerate(decontaminate.contained_items(bodies, index)) for r in rows}
    want = set()
    for d, body in enumerate(bodies):
        numbers = np.array([items.vocabulary.get(w, -1) for w in decontaminate.words_of(body)])
        for i, words in enumerate(items.words):
            for at in range(0, len(numbers), decontaminate.BLOCK):
                near = numbers[max(0, at - len(words)) : at + 2 * decontaminate.BLOCK + len(words)]
                share = decontaminate.common_subsequence(items.masks[i], len(words), near[near >= 0]) / len(words)
                if share >= decontaminate.LCS_SHARE:
                    want.add((d, i))
    assert len(want) > 80 and len(got & want) >= 0.9 * len(want)


def test_common_subsequence_against_table():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 14))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 20))]
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontaminate.common_subsequence(decontaminate.positions(a), len(a), np.array(b, int)) == table[-1][-1]


def test_benchmark_passages_of_the_table(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    items = spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()
    plain = lambda t: " ".join(t.lower().split())
    truth = {(d.doc_id, i.item_id) for d in docs for i in items if plain(i.text) in plain(d.text)}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](spark, MIDDLE).collect()}
    assert truth and found == truth


def test_decontaminate_odd_cases(spark, planted):
    _, benchmark, _ = planted
    odd = odd_documents(spark)
    more = benchmark.unionAll(spark.createDataFrame([(None, "no number but some words here"), (1, None), (2, ""), (3, "too few")], benchmark.schema))
    out = decontaminate.with_matches(odd.withColumn("matches", F.lit(1)), more)
    assert out.count() == odd.count() and all(r.matches == [] for r in out.collect())
    held = decontaminate.with_matches(odd, spark.createDataFrame([(5, " ".join(LONG.split()[:30]))], "item_id long, text string"))
    assert [(r.doc_id, len(r.matches)) for r in held.collect() if r.matches] == [(6, 1)]
    assert {tuple(r.matches) for r in decontaminate.with_matches(odd, benchmark.limit(0)).collect()} == {()}
    assert decontaminate.with_matches(no_documents(spark), benchmark).collect() == []
