"""The trie of conversations against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from redress.llm import prefix_trie
from redress.llm.prefix_trie import conversation_paths, share_openings, trie_table

COLUMNS = "conv_id long, turn long, role string, text string, depth string, path string, chars int"


def sequences(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - int(math.fmod(c, 100))  # as SQL has it
        out[c] = tuple(own.get(head, [])[:h] + turns[h:])
    return out


def nodes_of(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if paths[c] == p).encode()).hexdigest())
        for p, m in members.items()
    )


def table(df):
    return Counter(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1) for r in rows], COLUMNS).repartition(3)


ODD = [
    (None, 0, "user", "belongs to nothing"),
    (0, 1, "user", "hello"), (0, None, "system", None), (0, 2, None, "Ünïcode 🎉"),
    (0, 2, None, "Ünïcode 🎉"), (1, 0, "user", ""), (2, 5, "user", "x" * 100_000),
    (3, 0, "a", "b:c"), (4, 0, "a:b", "c"), (-7, 1, "user", "below zero"), (250, 0, "user", "no head"),
    *[(5, k, "user", f"turn {k % 3}") for k in range(400)],
    *[(6, k, "user", f"turn {k % 3}") for k in range(399)],
]


def test_trie_of_odd_rows(spark):
    want = nodes_of(rebuilt(sequences(ODD)))
    assert table(trie_table(frame(spark, ODD))) == want
    assert table(trie_table(frame(spark, ODD[:1]))) == Counter()
    assert trie_table(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk", [2, 1024])
def test_groups_of_copies_span_shards(spark, chunk):
    """Copies, shared beginnings and a node that is the end of some and the middle of others."""
    rows = []
    for c in range(600):
        kind = c % 3
        length = 3 if kind == 0 else c % 7
        rows += [(c, k, "user", "same" if kind < 2 else f"{k} {c % 11}") for k in range(length)]
    for paths, got in (
        (sequences(rows), conversation_paths(frame(spark, rows))),
        (rebuilt(sequences(rows)), share_openings(conversation_paths(frame(spark, rows)))),
    ):
        whole = {c: tuple(turns) for c, turns in paths.items()}
        assert table(prefix_trie.prefix_trie(got, chunk)) == nodes_of(whole)


def test_turnless_conversations_are_members_of_the_root(spark):
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    got = table(trie_table(frame(spark, [(short, 0, "user", "goes")])))
    digest = hashlib.sha256(str(short).encode()).hexdigest()
    assert got == Counter([(short, 0, None, 1, 0, 1, 0, digest)])


@pytest.mark.parametrize("a, b, n", [
    (b"", b"", 0), (b"a" * 16, b"", 0), (b"a" * 32, b"a" * 16, 1), (b"a" * 32, b"a" * 16 + b"b" * 16, 1),
    (b"a" * 48 + b"b" * 64, b"a" * 48 + b"c" * 80, 3), (b"a" * 16, b"a" * 15 + b"b", 0),
])
def test_shared_turns(a, b, n):
    assert prefix_trie._shared_turns(a, b) == n == prefix_trie._shared_turns(b, a)
