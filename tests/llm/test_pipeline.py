"""The queries with SQL, and the pipeline against stages of plain Python."""

import os

import public_tokenizers
import pytest
from compare import difference
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import queries as corpus

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@tables
@pytest.mark.parametrize("name", sorted(corpus.SQL))
def test_query(spark, name):
    assert difference(corpus.QUERIES[name](spark, SF), SF, corpus.SQL[name]) == ""


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in corpus.QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "PII", "best-fit packing"]


@tables
def test_stages_against_plain_rules(spark):
    from test_texts import components_expected, lines_expected

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = corpus_pipeline.settle(steps["quality rules"](spark, docs, SF), "t").orderBy("doc_id")
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    clean = [r.doc_id for r in docs.collect() if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 50]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)

    lined = corpus_pipeline.settle(steps["line dedup"](spark, good, SF), "t")
    want = {i: t for i, t, _, _ in lines_expected([(r.doc_id, r.text) for r in good.collect()])}
    assert {r.doc_id: r.text for r in lined.collect()} == want
    assert lined.where("n_chars <> char_length(text)").isEmpty()

    single = corpus_pipeline.settle(steps["n-gram Jaccard join"](spark, lined, SF), "t")
    classes = components_expected([(r.doc_id, r.text) for r in lined.collect()], 5, 80)
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in classes})

    clear = corpus_pipeline.settle(steps["PII"](spark, single, SF), "t")
    assert clear.columns == docs.columns and clear.count() == single.count()
    assert clear.where(F.col("text").rlike(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]")).isEmpty()

    packed = steps["best-fit packing"](spark, clear, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in clear.collect()}


def test_near_copies_keep_texts_of_one_id(spark):
    """A row without words does not push out a text of its id; texts that differ in case and blanks alone are one."""
    texts = [" ".join(f"{name}{k}" for k in range(40)) for name in "abc"]
    rows = [(1, None), (1, texts[0]), (1, texts[1]), (1, "  " + texts[1].upper()), (2, texts[0] + " x"), (3, None), (3, " "), (4, texts[2]), (5, texts[2]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in dict(corpus_pipeline.STAGES)["n-gram Jaccard join"](spark, docs, SF).collect()]
    assert len(got) == 5 and {(i, (t or "").strip().lower()) for i, t in got} == {(1, texts[0]), (1, texts[1]), (3, ""), (4, texts[2]), (None, texts[2])}


def test_stages_on_odd_documents(spark):
    shape = "doc_id long, text string, lang string, source string, n_chars long, key int, label string"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, 1, "x"), (1, "", "en", "s", 0, 1, "x"), (2, "w " * 3000, "en", "s", 6000, 1, "x")]
    rows += [(i, " ".join(f"word{i}x{k}" for k in range(60)), "en", "s", 1, 1, "x") for i in range(3, 9)]
    for docs in (spark.createDataFrame(rows, shape), spark.createDataFrame([], shape)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.settle(stage(spark, docs, SF), "odd")
            assert name == "best-fit packing" or docs.columns == columns
    assert os.path.exists(public_tokenizers.path("byte_bpe_50k.json"))
