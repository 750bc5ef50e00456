"""Language ID, quality classifier and language model."""

import itertools
import math
import pathlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from redress.llm import language, pitman_yor, weak_quality
from redress.llm.common import bucket
from redress.sources.scratch import CLEANUP, new_folder
from tests.llm import brute
from tests.llm.conftest import MIDDLE, TEXTS

# -- language ID --------------------------------------------------------------------

PIECES = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab"]


def segmentations(word, pieces):
    """Every way to cut a marked word into pieces, an unknown character being one."""
    marked = "▁" + word

    def cut(rest):
        if not rest:
            yield []
        for n in range(1, len(rest) + 1):
            head = rest[:n]
            if head in pieces or n == 1:
                for tail in cut(rest[n:]):
                    yield [pieces.index(head) if head in pieces else len(pieces), *tail]

    return list(cut(marked))


@pytest.mark.parametrize("word", ["a", "ab", "abab", "bqa", "qq", "aabbab"])
def test_forward_sums_all_segmentations(word):
    rng = np.random.default_rng(7)
    p = rng.random((2, len(PIECES) + 1))
    own = language.Segments(PIECES)
    cuts = segmentations(word, PIECES)
    chances = [[math.prod(q[i] for i in c) for c in cuts] for q in p]
    got = own.scores(word, [tuple(x) for x in p.T])
    assert got == pytest.approx([math.log(sum(c)) for c in chances])
    want = Counter()
    for cut, chance in zip(cuts, chances[0], strict=True):
        for i in cut:
            want[i] += chance / sum(chances[0])
    assert own.expected(word, list(p[0])) == pytest.approx(dict(want))


def test_batches_sum_all_segmentations():
    """Nearly all words are scored and counted many at a time."""
    words = ["a", "ab", "abab", "bqa", "qq", "aabbab", "b", "abaabaq", "ab"]
    rng = np.random.default_rng(9)
    p = rng.random((3, len(PIECES) + 1))
    own = language.Segments(PIECES)
    want, uses = [], np.zeros((3, len(PIECES) + 1))
    counts = np.array([1.0, 4, 2, 3, 1, 5, 7, 2, 1])
    for word, n in zip(words, counts, strict=True):
        cuts = segmentations(word, PIECES)
        chances = [[math.prod(q[i] for i in c) for c in cuts] for q in p]
        want.append([math.log(sum(c)) for c in chances])
        for k in range(3):
            for cut, chance in zip(cuts, chances[k], strict=True):
                for i in cut:
                    uses[k, i] += n * chance / sum(chances[k])
    got = np.array(own.scores_of(words, np.ascontiguousarray(p.T)))
    assert got == pytest.approx(np.array(want))
    for k in range(3):
        assert own.uses_of(words, counts, p[k]) == pytest.approx(uses[k])


def test_words_are_solved_once_in_small_tables(monkeypatch):
    """Tables stay small whatever a batch holds, and remembered words are not solved again."""
    rng = np.random.default_rng(11)
    p = rng.random((2, len(PIECES) + 1))
    texts = [" ".join(f"{'ab' * (1 + i // 500 % 5)}{j}" for j in range(i, i + 1500)) for i in range(0, 9000, 500)]
    texts += ["ab" * 40 + " a", None, "12"]
    model = language.LanguageModel(["de", "en"], PIECES, p)
    alone = [language.LanguageModel(["de", "en"], PIECES, p).predict(t) for t in texts]
    solved, forward = [], language.Segments.forward
    count = staticmethod(lambda arcs, p: solved.append(len(arcs.sizes)) or forward(arcs, p))
    monkeypatch.setattr(language.Segments, "forward", count)
    assert model.predict_all(texts) == alone and model.predict_all(texts) == alone
    words = {w for t in texts[:-1] for w in language.words_of(t)}
    assert max(solved) <= 4096 < sum(solved) == len(words) - 1
    # What a task remembers is bounded.
    monkeypatch.setattr(language, "REMEMBERED", 10)
    assert [model.predict_all([t])[0] for t in texts] == alone
    assert len(model._rows) <= 1500


def test_very_long_words_stay_in_range():
    own = language.Segments(PIECES)
    p = [1e-3] * (len(PIECES) + 1)
    (score,) = own.scores("ab" * 5000, [(x,) for x in p])
    assert -1e6 < score < -1e4
    uses = own.expected("ab" * 5000, p)
    assert all(math.isfinite(x) for x in uses.values())
    short = own.scores("ab" * 20, [(x,) for x in p])[0]
    assert score == pytest.approx(short * 250, rel=0.02)


def test_languages_of_held_out_documents(middle):
    got = language.language_table(middle).join(middle.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == middle.count()
    for r in got:
        assert r.held_out == brute.held(r.doc_id, 5) and 0 <= r.score <= 1
    long = [r for r in got if r.held_out and len(r.text.split()) >= 20]
    assert sum(r.lang_pred == r.lang for r in long) / len(long) > 0.98


def test_language_of_odd_rows(odd, nothing, spark):
    model = language.fit_languages(odd)
    got = language.identify(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.lang_pred in {"und", "en", "de", "fr", "es"}
    assert language.identify(nothing, model).count() == 0
    unlearnt = language.identify(odd, language.fit_languages(nothing))
    assert {r.lang_pred for r in unlearnt.collect()} == {"und"}
    table = language.language_table(odd.select("doc_id", "text", "lang"))
    assert table.count() == len(TEXTS)


def test_rare_language_is_learnt(spark):
    common = [(i, f"the house number {i} is in the street", "en") for i in range(3000)]
    rare = [(10_000 + i, f"zwölf häuser stehen hier {i}", "de") for i in range(3)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, lang string")
    model = language.fit_languages(docs, fit_rows=20)
    assert model.languages == ["de", "en"]
    assert model.predict("zwölf häuser stehen hier")[0] == "de"
    # Copies of one text are drawn row by row.
    same = docs.withColumn("text", F.lit("the house"))
    words = []
    real = language.settle
    language.settle = lambda df, name: words.append(real(df, name)) or words[-1]
    try:
        language.fit_languages(same, fit_rows=300, rounds=0)
    finally:
        language.settle = real
    n = words[-1].where("lang = 'en' AND word = 'the'").first().n
    assert 200 < n < 400


# -- quality classifier -------------------------------------------------------------


def test_estimation_finds_accuracies():
    rng = np.random.default_rng(3)
    truth = rng.random(40_000) < 0.7
    right = [0.9, 0.8, 0.7, 0.6]
    votes = np.stack([
        np.where(rng.random(len(truth)) < 0.2, 0, np.where(rng.random(len(truth)) < a, 1, -1) * (2 * truth - 1))
        for a in right
    ], axis=1)
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, found = weak_quality.estimate(patterns, counts.astype(float))
    assert found == pytest.approx(right, abs=0.05)
    # As good as with the true accuracies and prior.
    weights = np.log(np.array(right) / (1 - np.array(right)))
    best = patterns @ weights + np.log(0.7 / 0.3) > 0
    hits = ((posterior[inverse.ravel()] > 0.5) == truth).mean()
    assert hits > (best[inverse.ravel()] == truth).mean() - 0.005


def test_classifier_finds_junk_and_insults(spark, middle):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = weak_quality.quality_table(middle).join(labels, "doc_id").join(
        middle.select("doc_id", "lang"), "doc_id"
    ).collect()
    good = [r for r in rows if r.quality and not r.toxic]
    assert sum(r.kept for r in good) / len(good) > 0.97
    # Labelled texts of other languages hold no insult at all, in any list.
    toxic = [r for r in rows if r.toxic and r.lang == "en"]
    assert sum(r.toxic_score >= 0.5 for r in toxic) / len(toxic) > 0.9
    junk = [r for r in rows if not r.quality]
    assert sum(not r.kept for r in junk) / len(junk) > 0.8


def test_toxic_texts_of_all_languages(spark):
    """Marks come from the labels of half of the documents, the other half is tested."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = weak_quality.quality_table(docs, labels.where("doc_id % 2 = 0")).join(
        labels.where("doc_id % 2 = 1"), "doc_id"
    ).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("de", "en", "es", "fr"):
        toxic = [r.toxic_score >= 0.5 for r in rows if r.toxic and r.lang == lang]
        clean = [r.toxic_score >= 0.5 for r in rows if not r.toxic and r.lang == lang]
        assert sum(clean) / len(clean) < 0.01, lang
        # Of Spanish there are 17 labelled toxic documents on either side.
        assert lang == "es" or sum(toxic) / len(toxic) > 0.8, lang
    good = [r.kept for r in rows if r.quality and not r.toxic]
    junk = [r.kept for r in rows if not r.quality]
    assert sum(good) / len(good) > 0.97 and sum(junk) / len(junk) < 0.3


def test_marks_are_words_of_toxic_texts_only(spark):
    rows = [(f"a plain text of {i} words", 0) for i in range(300)] + [
        ("some nastiest words", 1), ("words nastiness", 1), ("the nastier text", 1), (None, 1),
        ("unlabelled nasties", None), ("", 0),
    ]
    got = weak_quality.toxic_marks(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(got) == {"nasti*"} and set(got.values()) <= {0, 1}
    assert weak_quality.toxic_marks(spark.createDataFrame([], "text string, toxic int")) == {}
    assert weak_quality.toxic_marks(spark.createDataFrame(rows[:300], "text string, toxic int")) == {}


def test_features_stored_on_the_way_give_the_same_scores(spark):
    """Copies, NULL ids and columns named like a result too; no text is described twice."""
    texts = ["the cat sat on the mat and it was fine", "$$ ## !! ||", None, "", "YOU IDIOT !! YOU IDIOT"]
    rows = [(i if i % 7 else None, f"{texts[i % 5]} {i % 11}" if texts[i % 5] else texts[i % 5], i)
            for i in range(60)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept int").repartition(3, "kept")
    expected = weak_quality.classify(docs, weak_quality.fit_scorer(docs)).drop("text")
    got = weak_quality.fit_and_classify(docs)
    assert got.columns == expected.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert "MapInArrow" in (plan := got._jdf.queryExecution().executedPlan().toString())
    assert "text" not in plan.split("ReadSchema")[-1]
    nothing = weak_quality.fit_and_classify(docs.where("kept < 0"))
    assert nothing.columns == expected.columns and not nothing.count()


def test_classifier_on_odd_rows(odd, nothing):
    scorer = weak_quality.fit_scorer(odd)
    got = weak_quality.classify(odd, scorer)
    assert got.columns == [c for c in odd.columns if c != "kept"] + weak_quality.OUTPUT
    rows = got.collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.quality_score <= 1 for r in rows)
    assert weak_quality.classify(nothing, weak_quality.fit_scorer(nothing)).count() == 0


def test_drawn_rows_are_bounded_whatever_repeats(spark, monkeypatch):
    """Rows of NULL text and copies of one text are drawn like others."""
    text = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "a copy of one text")
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), text.otherwise(F.concat(F.lit("text "), "id")).alias("text")
    )
    drawn = []
    real = weak_quality.settle

    def settle(df, name):
        out = real(df, name)
        if name == "drawn":
            drawn.append((out.count(), out.where(F.size("features") < 12).count()))
        return out

    monkeypatch.setattr(weak_quality, "settle", settle)
    weak_quality.fit_scorer(docs, fit_rows=300, rounds=1)
    ((n, null),) = drawn
    assert 220 < n < 380 and 50 < null < 150


# -- language model -----------------------------------------------------------------


def test_seating_follows_the_restaurant():
    """Average number of tables as when every customer sits down alone."""
    rng = np.random.default_rng(1)
    weight, discount, n = 3.0, 0.5, 300
    alone = []
    for _ in range(400):
        tables = 1
        for seated in range(1, n):
            tables += rng.random() < weight / (weight + seated - discount * tables)
        alone.append(tables)
    seeds = rng.integers(0, 2**63, 400).astype(np.uint64)
    grouped = pitman_yor.seat(np.full(400, float(n)), np.full(400, weight), discount, seeds)
    assert grouped.mean() == pytest.approx(np.mean(alone), rel=0.05)
    exact = pitman_yor.seat(np.array([0.0, 1.0, 2.0]), np.ones(3), 0.5, seeds[:3])
    assert exact[0] == 0 and exact[1] == 1 and exact[2] in (1, 2)


def test_codes_hold_context_and_byte():
    codes, starts = pitman_yor.word_codes([b"ab", b"", b"c"])
    e, b = pitman_yor.EDGE, pitman_yor.BASE

    def code(x, y, z, dish):
        return ((x * b + y) * b + z) * b + dish

    assert starts.tolist() == [0, 3, 4]
    assert codes.tolist() == [
        code(e, e, e, 97), code(e, e, 97, 98), code(e, 97, 98, e), code(e, e, e, e),
        code(e, e, e, 99), code(e, e, 99, e),
    ]


def test_spelling_is_a_distribution():
    import pandas as pd

    words = [w.encode() for w in "the then there her here eh three tree".split()]
    codes, _ = pitman_yor.word_codes(words)
    cells = []
    for k in range(pitman_yor.ORDER + 1):
        keys = Counter(
            (int(c // pitman_yor.BASE % pitman_yor.BASE**k), int(c % pitman_yor.BASE)) for c in codes
        )
        cells.append(pd.DataFrame([(*x, float(n)) for x, n in keys.items()], columns=["context", "dish", "n"]))
    orders = pitman_yor.fit_spelling(cells, 1)
    for context in {int(c // pitman_yor.BASE) for c in codes} | {123, 0}:
        every = np.arange(pitman_yor.DISHES) + context * pitman_yor.BASE
        assert pitman_yor.spell_codes(every, orders).sum() == pytest.approx(1.0)
    for order, below in itertools.pairwise(orders):
        assert order.tables.sum() <= order.customers.sum() <= below.customers.sum()


def local_spelling(words):
    """Log10 probabilities of words as their bytes, by all restaurants of the training words."""
    import pandas as pd

    known = sorted(w for w, c in words if c)
    codes, _ = pitman_yor.word_codes([w.encode() for w in known])
    cells, base = [], pitman_yor.BASE
    for k in range(pitman_yor.ORDER + 1):
        keys = Counter((int(c // base % base**k), int(c % base)) for c in codes)
        cells.append(pd.DataFrame([(*x, float(n)) for x, n in keys.items()], columns=["context", "dish", "n"]))
    orders = pitman_yor.fit_spelling(cells, 1)
    out = {}
    for word, _ in words:
        own, _ = pitman_yor.word_codes([word.encode()])
        out[word] = float(np.log10(pitman_yor.spell_codes(own, orders)).sum())
    return out


@pytest.mark.parametrize("sent", [400_000, 50, 1])
def test_every_context_has_a_restaurant(spark, monkeypatch, sent):
    """A context seen once among 100,000 bytes counts, and codes that are joined count as sent ones do."""
    monkeypatch.setattr(pitman_yor, "CODES", sent, raising=False)
    rows = [(f"{'abcd'[i % 4]}{i:06d}", 1 + i % 3) for i in range(15_000)]
    rows += [("qzxj", 1), ("qzxjqzxj", 0), ("zq", 0), ("a000000b", 0), ("é", 0), ("", 5), ("qz" * 40, 0)]
    words = spark.createDataFrame(rows, "word string, c long").repartition(3)
    totals = pitman_yor.Totals(sum(c for _, c in rows), sum(c > 0 for _, c in rows))
    got = pitman_yor.word_scores(spark, words, totals, 1, 0).collect()
    assert sorted(r.word for r in got) == sorted(w for w, _ in rows)
    # Words that are not known get their spelling, all times the same share.
    want = local_spelling(rows)
    shares = [r.spelled - want[r.word] for r in got if not r.c]
    assert len(shares) == 5 and shares == pytest.approx([shares[0]] * 5)
    # Of the 13 bytes of an unknown word that repeats a rare one most are foreseen.
    assert want["qzxjqzxj"] > -13


def score_all(docs):
    return pitman_yor.score_table(docs).collect()


def expected_base(rows, tolerance_rows):
    train = Counter()
    for doc, text in rows:
        if not brute.held(doc, 10):
            train.update([*brute.words(text), ""])
    total, distinct = sum(train.values()), len(train)
    out = []
    for doc, text in rows:
        tokens = [*brute.words(text), ""]
        base = sum(math.log10((train[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        out.append((doc, brute.held(doc, 10), len(tokens), sum(train[w] > 0 for w in tokens), total, base))
    return out


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2], round(r[5], 6)))


def test_base_scores(odd, middle):
    for docs in (odd, middle):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        got = by_row([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in score_all(docs)])
        want = by_row(expected_base(rows, len(rows)))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert [r[5] for r in got] == pytest.approx([r[5] for r in want])


def test_frequent_words_and_joined_words_score_alike(middle, monkeypatch):
    def rows():
        return sorted((r.doc_id, round(r.base_score, 6), round(r.score, 6), r.n_known) for r in score_all(middle))

    sent = rows()
    monkeypatch.setattr(pitman_yor, "FREQUENT", 20)
    assert rows() == sent


def test_model_beats_unigrams_on_held_out_texts(middle):
    rows = [r for r in score_all(middle) if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
    assert all(r.perplexity >= 1 and r.spelled_score <= r.score for r in rows)


def test_word_probabilities_add_up_to_one(spark, middle):
    train = middle.withColumn("train", bucket("doc_id", 10) != 0)
    words = pitman_yor.count_words(train)
    total, distinct = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    scores = pitman_yor.word_scores(spark, words, pitman_yor.Totals(total, distinct))
    p = F.pow(F.lit(10.0), "score")
    known = scores.where("c > 0").agg(F.sum(p)).first()[0]
    (unknown,) = {round(r[0], 12) for r in scores.where("c = 0").select(p).collect()}
    assert known + unknown == pytest.approx(1.0) and 0.02 < unknown < 0.3
    # Spelled out, unknown words share that mass.
    spelled = scores.where("c = 0").agg(F.sum(F.pow(F.lit(10.0), "spelled"))).first()[0]
    assert 0 < spelled < unknown


def pair_docs(spark):
    """Training texts in which words come in one order, and held-out ones in two orders."""
    held = [i for i in range(500) if brute.held(i, 10)]
    learnt = [i for i in range(500) if not brute.held(i, 10)][:200]
    rows = [(i, f"alpha beta gamma delta w{i % 7}") for i in learnt]
    rows += [(held[0], "alpha beta gamma delta w1"), (held[1], "delta w1 gamma alpha beta"),
             (held[2], "alpha beta nowhere delta w1")]
    return held, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_word_order_counts(spark):
    held, docs = pair_docs(spark)
    got = {r.doc_id: r for r in score_all(docs)}
    straight, shuffled, unknown = (got[i] for i in held[:3])
    assert straight.base_score == pytest.approx(shuffled.base_score)
    assert straight.score > shuffled.score + 2
    assert unknown.n_known == unknown.n_tokens - 1 and unknown.spelled_score < unknown.score


def test_pair_probabilities_add_up_to_one(spark, middle):
    train = middle.where(bucket("doc_id", 10) != 0)
    words = pitman_yor.count_words(middle.withColumn("train", bucket("doc_id", 10) != 0))
    total, distinct = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    pairs = pitman_yor.count_pairs(train)
    want = Counter()
    for (text,) in train.select("text").collect():
        tokens = ["", *brute.words(text), ""]
        want.update(itertools.pairwise(tokens))
    assert sorted(r.n for r in pairs.collect()) == sorted(want.values())
    model = pitman_yor.fit_pairs(spark, words, pairs, pitman_yor.Totals(total, distinct))
    every = model.words.collect()
    word = {r.w: 10**r.score for r in every if r.c > 0}
    unknown = next(10**r.score for r in every if not r.c)
    for context in ("the", "", "und"):
        key = pitman_yor.key_of(context.encode())
        own = {r.w: 10**r.score for r in model.scores.where(F.col("u") == key).collect()}
        (c,) = model.contexts.where(F.col("u") == key).collect()
        passed = c.weight / (1 + c.c)
        rest = unknown + sum(p for w, p in word.items() if w not in own)
        assert own and sum(own.values()) + passed * rest == pytest.approx(1.0)


def test_pair_seatings_are_averaged(spark):
    """What pairs keep is that of two seatings: halves of tables occur, and contexts have their sums."""
    draw = random.Random(7)
    names = [f"w{int(20 * draw.random() ** 2)}" for _ in range(6000)]
    docs = spark.createDataFrame([(True, " ".join(names[i : i + 30])) for i in range(0, 6000, 30)],
                                 "train boolean, text string").repartition(3)
    words, pairs = pitman_yor.count_words(docs), pitman_yor.count_pairs(docs)
    total, distinct = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    model = pitman_yor.fit_pairs(spark, words, pairs, pitman_yor.Totals(total, distinct))
    counts = [r.n for r in pairs.collect()]
    d = pitman_yor.discount(counts.count(1), counts.count(2))
    word = {r.w: 10**r.score for r in model.words.collect()}
    context = {r.u: r for r in model.contexts.collect()}
    tables, sums = [], Counter()
    for r in model.scores.collect():
        kept = 10**r.score * (1 + context[r.u].c) - context[r.u].weight * word[r.w]
        tables.append((r.n - kept) / d)
        assert 1 - 1e-6 < tables[-1] < r.n + 1e-6
        sums[r.u] += tables[-1]
    assert [2 * t for t in tables] == pytest.approx([round(2 * t) for t in tables], abs=1e-6)
    assert any(abs(t - round(t)) > 0.4 for t in tables)
    assert {u: r.weight for u, r in context.items()} == pytest.approx({u: 1 + d * t for u, t in sums.items()})


def test_little_is_left_on_disk(spark, monkeypatch):
    """Stored tables but the sums are deleted, and texts score alike in any number of turns."""
    held, docs = pair_docs(spark)
    docs = docs.unionByName(docs.where(f"doc_id = {held[1]}")).unionByName(
        spark.createDataFrame([(None, "alpha beta"), (held[3], None)], docs.schema)
    )
    found = []
    for turns in (1, 4, 7):
        monkeypatch.setattr(pitman_yor, "TURNS", turns, raising=False)
        folder = pathlib.Path(new_folder(spark, "any").removeprefix("file:")).parent
        before = set(folder.iterdir())
        rows = pitman_yor.score_table(docs)
        assert [x.name.split("-")[0] for x in set(folder.iterdir()) - before] == ["text"]
        found.append(sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.score, 6)) for r in rows.collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == docs.count()
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_scores_of_nothing(nothing, spark):
    assert pitman_yor.score_table(nothing).count() == 0
    # Every document held out: nothing to learn from.
    ids = [i for i in range(200) if brute.held(i, 10)][:3]
    docs = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")
    rows = score_all(docs)
    assert [r.train_tokens for r in rows] == [0, 0, 0] and all(math.isfinite(r.score) for r in rows)
