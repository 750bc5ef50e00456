"""Every stage of the pipeline against brute force on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from redress.llm import language
from redress.sources.scratch import settle
from tests.llm import brute
from tests.llm.conftest import SMALL


@pytest.fixture(scope="module")
def tables(spark):
    """The documents and the table after each stage."""
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], SMALL), "stage"))
    return out


def rows(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


def test_stages_keep_the_columns(tables):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "MinHash near-dedup", "benchmark decontamination",
        "SentencePiece encoding",
    ]
    for table in tables[:-1]:
        assert table.columns == corpus_pipeline.COLUMNS


def test_language_stage(tables):
    before, after = tables[:2]
    model = language.fit_languages(before)
    want = {}
    for doc, text in rows(before, "doc_id", "text"):
        lang, score = model.predict(text)
        if lang != "und" and score >= corpus_pipeline.LEAST_SCORE:
            want[doc] = lang
    assert dict(rows(after, "doc_id", "lang")) == want


def test_line_stage(tables):
    before, after = tables[1:3]
    want = [
        (doc, text, len(text))
        for doc, n, dropped, text in brute.line_dedup(rows(before, "doc_id", "text"), keep_first=True)
        if dropped < n or not dropped
    ]
    assert Counter(rows(after, "doc_id", "text", "n_chars")) == Counter(want)


def test_copies_with_blank_lines_leave_the_first(spark):
    texts = ["a b\n\nc d", "\n e f\n \t\n"]
    docs = [(100 * k + i, text, "en", "s", len(text)) for k, text in enumerate(texts) for i in range(12)]
    docs += [(500, "\n\n", "en", "s", 2), (501, "a b\n\nown line", "en", "s", 13)]
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    left = dict(rows(corpus_pipeline.line_dedup(spark, table, SMALL), "doc_id", "text"))
    assert left == {0: texts[0], 100: texts[1], 500: "\n\n", 501: "\nown line"}


def test_duplicate_stage(tables):
    before, after = tables[2:4]
    want = {d for d, _, _, kept in brute.near_classes(rows(before, "doc_id", "text"), 5) if kept}
    assert {d for (d,) in rows(after, "doc_id")} == want


def test_decontamination_stage(spark, tables):
    before, after = tables[3:5]
    items = rows(spark.read.parquet(f"{SMALL}/benchmark.parquet"), "item_id", "text")
    texts = rows(before, "doc_id", "text")
    held = {d for d, _, _ in brute.leaks(texts, items)}
    assert held
    assert {d for (d,) in rows(after, "doc_id")} == {d for d, _ in texts} - held


def test_encoding_stage(tables):
    import sentencepiece

    from redress.llm.pieces import vocabulary_file

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_file())
    assert tables[5].count() == tables[4].count()
    for text, ids, n, same in rows(tables[5], "text", "token_ids", "n_tokens", "round_trip"):
        assert ids == library.encode(text, add_eos=True) and n == len(ids) and same


def test_run_gives_the_last_table(spark, tables):
    got = corpus_pipeline.run(spark, SMALL)
    assert Counter(rows(got, "doc_id", "n_tokens")) == Counter(rows(tables[-1], "doc_id", "n_tokens"))


def test_stages_survive_odd_and_empty_tables(spark, odd, nothing):
    for docs in (odd, nothing):
        table = docs.select("doc_id", "text", "lang", F.col("id").alias("source"), F.lit(1).cast("long").alias("n_chars"))
        for _, stage in corpus_pipeline.STAGES:
            table = settle(stage(spark, table, SMALL), "stage")
        assert (table.count() > 0) == (docs is odd)
