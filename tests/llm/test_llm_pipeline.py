import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline as cp
from llm_tables import no_documents, odd_documents
from tallyloom.llm import decontaminate, simhash

MIDDLE = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_clean_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    kept = cp.without_toxic(spark, docs, MIDDLE).checkpoint()
    assert kept.columns == cp.COLUMNS
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    toxic = labels.filter("toxic = 1")
    assert kept.join(toxic, "doc_id").count() < 0.2 * toxic.count()
    clean = labels.filter("toxic = 0")
    assert kept.join(clean, "doc_id").count() > 0.98 * clean.count()

    lines = cp.without_boilerplate(spark, kept, MIDDLE).checkpoint()
    assert lines.count() == kept.count() and lines.columns == cp.COLUMNS
    assert lines.filter("n_chars != coalesce(char_length(text), 0)").count() == 0
    assert lines.agg(F.sum("n_chars")).first()[0] < kept.agg(F.sum(F.char_length("text"))).first()[0]

    single = cp.without_near_duplicates(spark, lines, MIDDLE).checkpoint()
    groups = simhash.near_duplicates(lines)
    assert single.count() == groups.select("component_id").distinct().count()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups.collect()}

    free = cp.without_benchmark(spark, single, MIDDLE).checkpoint()
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in single.collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert holds and {r.doc_id for r in free.collect()} == {r.doc_id for r in single.collect()} - holds

    rows = cp.packed(spark, free, MIDDLE).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in free.collect()}


def test_copies_of_a_clean_document_keep_its_text(spark, folder):
    """A third of the rows are copies of one document; the lines of every page still go."""
    clean = "\n".join(f"A clean line number {k} with words of its own." for k in range(6))
    rows = []
    for k in range(300):
        own = clean + "  \n\n" * (k % 2) if k % 3 == 0 else f"Page {k} tells of thing {k * 7}.\nAnd of {k * 13}, which no other has."
        rows.append((k, f"Home | About\n{own}", "en", f"h{k // 3 % 2}", len(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lines = cp.without_boilerplate(spark, docs, folder).checkpoint()
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert len(texts) == 300 and not any("Home | About" in t for t in texts.values())
    assert all(t.strip() == rows[k][1].removeprefix("Home | About\n").strip() for k, t in texts.items())
    kept = [r.text.strip() for r in cp.without_near_duplicates(spark, lines, folder).collect()]
    assert kept.count(clean) == 1 and "" not in kept


def test_one_id_with_different_texts_keeps_each(spark, folder):
    a, b = "one text about harbours and boats at sea", "something else entirely on mountain railways today"
    rows = [(1, b, "en", "x", 0), (1, a, "en", "x", 0), (1, a, "en", "x", 0), (2, a, "en", "x", 0), (3, b, "en", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    kept = cp.without_near_duplicates(spark, docs, folder)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (1, b)]


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_stage_takes_odd_and_empty_tables(spark, folder, name, stage):
    out = stage(spark, odd_documents(spark), folder)
    assert name == "packing" or out.columns == cp.COLUMNS
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert ids >= {1, None, 6, 7, 9} or name == "near_duplicates"
    if name == "near_duplicates":
        assert sorted((r.doc_id is None, r.doc_id) for r in rows) == [(False, 1), (False, 3), (False, 6), (False, 7), (False, 9), (True, None)]
    assert stage(spark, no_documents(spark), folder).collect() == []


def test_run_is_its_stages(spark, folder):
    out = cp.run(spark, folder)
    assert out.count() > 100 and out.columns[:2] == ["doc_id", "start"]


def test_decontamination_takes_no_sample(spark, tmp_path, monkeypatch):
    """The stage fits its basis on all documents it is given."""

    def sampled(*_):
        raise AssertionError("a sample")

    monkeypatch.setattr(decontaminate, "basis_sample", sampled)
    item = " ".join(f"rare{k} word{k % 7}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(k, " ".join(f"some{(k * j) % 89} text" for j in range(30)) + (f" {item}" if k % 5 == 0 else ""), "en", "a", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = cp.without_benchmark(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(60) if k % 5]
