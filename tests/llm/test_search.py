"""Near-duplicates and decontamination against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from redress.llm import decontaminate, near_duplicates
from redress.llm.components import components
from redress.llm.near_duplicates import super_minhash
from tests.llm import brute
from tests.llm.conftest import MIDDLE, SMALL, TEXTS


def table(df):
    return Counter(map(tuple, df.collect()))


def test_near_duplicates_equal_brute_force(middle):
    rows = [tuple(r) for r in middle.select("doc_id", "text").collect()]
    assert table(near_duplicates.near_duplicate_table(middle)) == Counter(brute.near_classes(rows, 2))


def test_near_duplicates_of_odd_rows(odd, nothing):
    got = near_duplicates.near_duplicates(odd, shingle_words=2)
    assert got.columns == [c for c in odd.columns if c not in near_duplicates.OUTPUT] + near_duplicates.OUTPUT
    rows = got.collect()
    assert len(rows) == len(TEXTS)
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    want = {d: (n, c, k) for d, n, c, k in brute.near_classes([t[:2] for t in TEXTS if t[0]], 2)}
    lone = found.pop(None)
    assert found == want and lone[1:] == (None, True)
    assert near_duplicates.near_duplicates(nothing).count() == 0
    kept = near_duplicates.drop_near_duplicates(odd, shingle_words=2)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, x in want.items() if x[2]} | {None}


def test_one_id_ties_its_texts(spark):
    a, b = "one two three four five six", "red green blue black white pink"
    rows = [(5, a), (5, b), (9, a), (3, b), (4, "")]
    got = near_duplicates.near_duplicate_table(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(5, 3), (9, 3), (3, 3), (4, 4)}


@pytest.mark.parametrize("block", [256, 8])
def test_large_group_of_near_copies_loses_no_link(spark, monkeypatch, block):
    """Members of a bucket whose hub they don't match still meet the others."""
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(words)
        for k in rnd.sample(range(60), rnd.choice([1, 2, 3, 4])):
            own[k] = f"x{i}y{k}"
        rows.append((1000 - i, " ".join(own)))
    rows += [(2000 + i, " ".join(f"z{rnd.randint(0, 400)}" for _ in range(50))) for i in range(50)]
    got = near_duplicates.near_duplicate_table(spark.createDataFrame(rows, "doc_id long, text string"))
    assert table(got) == Counter(brute.near_classes(rows, 2))


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.9):
        estimates = []
        for _ in range(20):
            u = rng.integers(0, 2**63, 400).astype(np.uint64)
            n = int(400 * share)
            half = n + (400 - n) // 2
            a, b = np.unique(u[:half]), np.unique(np.concatenate([u[:n], u[half:]]))
            signatures = super_minhash([a, b])
            estimates.append((signatures[0] == signatures[1]).mean())
        assert abs(np.mean(estimates) - share) < 0.02


def test_super_minhash_is_by_set_alone():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 3, 900, 40, 2)]
    together = super_minhash(sets)
    for s, row in zip(sets, together, strict=True):
        assert (super_minhash([s[::-1]])[0] == row).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 400)]
    edges += [(rnd.randint(2000, 2400), rnd.randint(2000, 2400)) for _ in range(150)]
    rnd.shuffle(edges)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    links = spark.createDataFrame(edges, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1] or find(x) != x or x in got}


def test_leaks_equal_brute_force(spark, small):
    for folder in (SMALL, MIDDLE):
        docs = small if folder == SMALL else spark.read.parquet(f"{folder}/documents.parquet").where("n_chars < 3000")
        benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leak_table(docs, benchmark).collect()}
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
        want = {(d, i): s for d, i, s in brute.leaks(rows, items)}
        assert got == pytest.approx(want)


ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "Short item"), (3, None), (4, " "),
         (5, "x x x x x x x x"), (1, "a second text of item one with several words in it"), (None, "nobody knows this one at all")]
HOLDERS = [
    (1, "before ONE two three\nfour five six seven eight nine ten after"),
    (2, "one two three four five six seven eight nine"), (3, "a short ITEM here"), (4, None), (5, ""),
    (6, "x " * 100), (7, "one two three four five six seven eight nine eleven " * 2),
    (None, "and nobody knows this one at all really"),
    (8, "a second text of item one with several words in it"), (8, "a second text of item one with several words in it"),
]


def test_leaks_of_odd_rows(spark, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(HOLDERS, "doc_id long, text string").repartition(2)
    got = table(decontaminate.find_leaks(docs, items).select("doc_id", "item_id"))
    want = Counter((d, i) for d, i, _ in brute.leaks(HOLDERS, ITEMS))
    assert got == want and got[(8, 1)] == 2
    assert decontaminate.find_leaks(docs, items.limit(0)).count() == 0
    assert decontaminate.find_leaks(nothing, items).count() == 0
    clean = decontaminate.drop_leaks(docs.withColumn("similarity", docs.doc_id), items)
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == sorted(
        d for d, _ in HOLDERS if (d is not None) and d not in {x for x, _ in want}
    )


def test_part_of_an_item_at_the_end_of_a_text(spark):
    """The ten-word item less its last or first word: alone, at the end, at the beginning."""
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    nine = "one two three four five six seven eight nine"
    rows = [
        (1, nine), (2, "two three four five six seven eight nine ten"), (3, "it said so: " + nine),
        (4, "two three four five six seven eight nine ten and so on"), (5, nine[: -len(" nine")]),
        (6, "before " + nine + " after"),
    ]
    got = decontaminate.leak_table(spark.createDataFrame(rows, "doc_id long, text string"), items)
    assert {r.doc_id: round(r.similarity, 3) for r in got.collect()} == dict.fromkeys((1, 2, 3, 4), 0.833)
    assert {d for d, _, _ in brute.leaks(rows, ITEMS[:1])} == {1, 2, 3, 4}


def test_items_in_blocks(spark, monkeypatch, small):
    benchmark = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = table(decontaminate.leak_table(small, benchmark))
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    assert table(decontaminate.leak_table(small, benchmark)) == whole
