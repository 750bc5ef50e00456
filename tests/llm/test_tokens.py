"""Token counts and pieces against the tokenizer libraries."""

import random

import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from redress.llm import counts, pieces
from tests.llm import brute
from tests.llm.conftest import TEXTS


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.vocabulary_file())


def generated(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab te▁\n é日th🎉<s>\\xin\t") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_encoder_equals_library(library):
    own = pieces.Encoder(open(pieces.vocabulary_file(), "rb").read())
    for text in [*generated(1500), "ab" * 2000, "é" * 9, " " * 40 + "a" + " " * 33, "\x00"]:
        n, ids, decoded, differing = own.encode(text)
        want = library.encode(text, add_eos=True)
        assert ([int(i) for i in ids.split()], n, decoded, differing) == (want, len(want), library.decode(want), 0)


def test_long_and_short_agenda_agree(monkeypatch):
    own = pieces.MergeVocabulary(open(pieces.vocabulary_file(), "rb").read())
    chunks = [c for t in generated(500, 2) for c in own.chunks(t)]
    short = [own.merge(c) for c in chunks]
    monkeypatch.setattr(pieces, "SHORT", 0)
    assert [own.merge(c) for c in chunks] == short


def test_decoding_of_any_ids(library):
    own = pieces.MergeVocabulary(open(pieces.vocabulary_file(), "rb").read())
    rnd = random.Random(3)
    for _ in range(500):
        ids = [rnd.choice([1, 2, rnd.randint(3, 258), rnd.randint(3, 258), rnd.randint(259, 31999)]) for _ in range(8)]
        assert own.decode(ids) == library.decode(ids)


def test_encode_table(odd, middle, nothing, library):
    got = pieces.encode_pieces(odd)
    assert got.columns == [c for c in odd.columns if c != "n_tokens"] + pieces.OUTPUT
    rows = got.collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert row.token_ids == library.encode(row.text or "", add_eos=True)
        assert row.decoded == library.decode(row.token_ids) and row.n_differing == 0
    texts = {r.doc_id: r.text for r in middle.collect()}
    for row in pieces.pieces_digest(middle).collect():
        ids = library.encode(texts[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == brute.sha(" ".join(map(str, ids)))
        assert row.decoded_sha256 == brute.sha(library.decode(ids))
    assert pieces.encode_pieces(nothing).count() == 0


def unigram_library(vocabulary):
    full = [("<unk>", 0.0), *vocabulary, *((f"<0x{b:02X}>", 0.0) for b in range(256))]
    tokenizer = Tokenizer(models.Unigram(full, 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=False)
    return tokenizer


def test_counts_equal_library(odd, small, nothing):
    tokenizer = unigram_library(counts.unigram_pieces())

    def want(text):
        return len(tokenizer.encode(text).tokens) if text else 0

    for docs in (odd, small):
        for row in counts.count_tokens(docs).collect():
            if "<0x" not in (row.text or ""):
                assert row.n_tokens == want(row.text), row.text
    own = counts.UnigramCounter(counts.unigram_pieces())
    for text in generated(1000):
        assert own.count(text) == want(text), text
    assert counts.count_tokens(nothing).count() == 0


def test_counts_break_ties_like_library():
    vocabulary = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁", -1.0)]
    tokenizer, own = unigram_library(vocabulary), counts.UnigramCounter(vocabulary)
    rnd = random.Random(4)
    for _ in range(2000):
        text = "".join(rnd.choice("ab c") for _ in range(1 + rnd.randint(0, 12)))
        assert own.count(text) == len(tokenizer.encode(text).tokens), text
