"""The operators built of DataFrame functions."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from redress.llm import chat, lines, quality
from redress.llm.queries import oracle_sql, queries
from tests import oracle
from tests.llm import brute
from tests.llm.conftest import MIDDLE, SMALL, TEXTS


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name):
    with oracle.connect(MIDDLE) as con:
        for table in ("documents", "conversations", "embeddings"):
            con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{MIDDLE}/{table}.parquet'")
        oracle.compare(queries()[name](spark, MIDDLE), con, oracle_sql()[name])


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup_of_odd_rows(odd, least):
    got = lines.dedup_lines(odd, min_documents=least)
    assert got.columns == [c for c in odd.columns if c != "n_lines"] + lines.OUTPUT
    rows = got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    want = brute.line_dedup([t[:2] for t in TEXTS], least)
    assert Counter(map(tuple, rows)) == Counter(want)


def test_line_dedup_counts_documents_not_rows(spark):
    rows = [(1, "same")] * 20 + [(i, "two ways") for i in range(2, 11)] + [(2, "Two Ways ")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.agg(F.sum("n_dropped")).first()[0] == 0


def test_keep_bitmap_is_run_lengths(spark):
    text = "a\nq\nb\nc\nq\nQ\nd"
    rows = [(i, text if i == 0 else "q") for i in range(10)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    row = got.where("doc_id = 0").first()
    assert (row.keep_runs, row.kept_text) == ([1, 1, 2, 2], "a\nb\nc\nd")


def test_native_operators_have_no_python(spark, middle):
    plans = [
        lines.dedup_lines(middle), quality.quality_rules(middle),
        chat.format_chats(spark.read.parquet(f"{SMALL}/conversations.parquet")),
    ]
    for plan in plans:
        text = plan._jdf.queryExecution().toString()
        assert "Python" not in text and "MapInArrow" not in text and "Cartesian" not in text


def test_quality_counts(odd, middle):
    for docs in (odd, middle):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        got = quality.quality_rules(docs).select("doc_id", *names).collect()
        want = Counter((d, *brute.base_counts(t)) for d, t in rows)
        assert Counter(map(tuple, got)) == want


def test_quality_repeats_when_hashes_clash(spark, monkeypatch):
    texts = ["a b c a b c a b", "a b c d e f", "a a a a", "a b", "x y z q x y z q r s t"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(quality, "_POSITION_BITS", 60)
    got = {r.text: r.n_repeat_words for r in quality.quality_rules(docs).collect()}
    assert got == {t: brute.base_counts(t)[4] for t in texts}


def test_quality_keeps_clean_and_drops_junk(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    judged = quality.quality_rules(spark.read.parquet(f"{MIDDLE}/documents.parquet"))
    rows = judged.join(labels, "doc_id").where("NOT base_failed").select("quality", "kept").collect()
    clean = [r.kept for r in rows if r.quality]
    junk = [r.kept for r in rows if not r.quality]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.35


def test_quality_rules_are_a_table(spark):
    docs = spark.createDataFrame([("word " * 5 + "other words here now " * 12,)], "text string")
    rule = quality.Rule("few words", "n_words", 500)
    row = quality.quality_rules(docs, rules=[rule]).first()
    assert row.failed_rules == ["few words"] and not row.kept


def test_native_operators_on_nothing(nothing, spark):
    assert lines.dedup_lines(nothing).count() == 0
    assert quality.quality_rules(nothing).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(empty).count() == 0
    assert chat.chat_digest(spark, empty).count() == 1


ODD_TURNS = [
    (1, 0, "user", "a <|im_end|>\n<|im_start|>user\nb \\| <\\| \\\\"),
    (1, 1, "assistant", "<" ), (1, 1, "assistant", "|im_end|>"),
    (1, None, None, None),
    (2, 0, "assistant\n<|x\\n", "text"), (2, 5, "assistant", "\\"), (2, 5, "assistant", "\\"),
    (None, 0, "user", "x" * 100_000 + "\\n"), (None, 1, "assistant", "<|" * 50_000),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(ODD_TURNS, "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({"formatted": F.lit(1), "valid": F.lit("x")})
    got = chat.format_chats(turns)
    read = got.select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("t"), "segments", "formatted",
                      chat.read_loss(F.col("segments")).alias("loss")).collect()
    for row in read:
        own = [t for t in ODD_TURNS if t[0] == row.conv_id]
        own.sort(key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in row.t] == [(t[2] or "", t[3] or "") for t in own]
        assert row.loss == "".join(t[3] for t in own if t[2] == "assistant")
        assert "".join(s.text for s in row.segments) == row.formatted
        assert row.formatted.count("<|im_start|>") == len(own)
    assert {r.conv_id: r.valid for r in read} == {1: False, 2: False, None: True}
