"""Nulls, empty and long texts, repeated rows, clashing columns and empty tables, for each operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chainlake.llm import language, mixing, near_copies, perplexity, secret_scan, simhash, sketches, templates, token_files, warc, winnowing
from chainlake.llm.queries import tokenizer_path

CLASH = ("id", "row", "words", "start", "size", "bucket", "n", "token", "host", "page", "rate", "probability", "root", "path", "count")
DOCS = [
    (1, "Some words of a plain text that is here twice.", "en", "a"), (1, "Some words of a plain text that is here twice.", "en", "a"),
    (2, None, "en", "a"), (3, "", None, None), (4, "Some words of a plain text that is here twice.", "de", "b"), (None, "no id", "en", "a"),
    (None, None, None, None), (5, "word " * 60_000, "en", "a"), (6, " \n\t ", "fr", "b"), (7, "!!! 123 ***", "en", "c"), (1, "another text of id one", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string")
    return df.withColumns({"n_chars": F.length("text").cast("long"), **{c: F.lit("x") for c in CLASH}})


@pytest.fixture(scope="module")
def others(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 1, 0), (99, 0, None)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    bench = spark.createDataFrame([(1, "words of a"), (None, None), (2, ""), (None, "plain")], "item_id long, text string").withColumn("doc_id", F.lit(1))
    return labels, bench


def operators(labels, bench):
    return {
        "simhash": simhash.near_duplicates,
        "near copies": near_copies.near_copies,
        "winnowing": lambda d: winnowing.contamination(d, bench)[0],
        "sketches": sketches.edited_pairs,
        "mixing": lambda d: mixing.mixture(d)[0],
        "perplexity": lambda d: perplexity.scored(d, labels),
        "secrets": secret_scan.secrets,
        "language": lambda d: language.predict(d, language.train(d)),
        "tokens": lambda d: token_files.read_tokens(token_files.write_tokens(d, tokenizer_path()), with_tokens=False),
    }


@pytest.mark.parametrize("name", ["simhash", "near copies", "winnowing", "sketches", "mixing", "perplexity", "secrets", "language", "tokens"])
def test_one_row_for_each_row_of_odd_documents(docs, others, name):
    run = operators(*others)[name]
    found = run(docs)
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in found.select("doc_id").collect())
    assert ids == sorted((d[0] is not None, d[0] or 0) for d in DOCS)
    assert run(docs.where("false")).count() == 0


def test_pages_with_nulls_and_repeats(spark):
    rows = [(1, "http://h.x/", "<p>a"), (1, "http://h.x/", "<p>a"), (2, None, None), (None, "no url", ""), (3, "http://h.x/2", "<b>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in CLASH if c != "page"})
    assert sorted(r["text"] for r in templates.extracted(df).collect()) == ["", "", "a", "a", "deep"]
    assert templates.extracted(df.where("false")).count() == 0
    made = warc.derive(warc.read_warc(warc.write_warc(warc.responses(df))))
    assert made.count() == 10
    assert warc.derive(warc.read_warc(warc.write_warc(warc.responses(df.where("false"))))).count() == 0


def test_stages_keep_columns_and_take_odd_documents(spark, docs, others, tmp_path):
    labels, bench = others
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        if name != "token files":
            assert found.columns == docs.columns
        assert found.count() <= len(DOCS) and stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert {None, 1, 2, 5, 7} == kept
    clean = {r["doc_id"] for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()}
    assert clean == {None, 2, 3, 5, 6, 7}
