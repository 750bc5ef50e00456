"""Language identification by unigram pieces, summed over all segmentations."""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from redress.llm.common import MASK, bucket, map_batches, mix, slices, without
from redress.llm.counts import unigram_pieces
from redress.llm.pieces import SPACE
from redress.sources.scratch import settle

UNDETERMINED = "und"
#: Documents of each language that a model is fitted on, about, drawn by a hash of id and text.
FIT_ROWS = 10_000
DRAWS = 1_000_000_000
ROUNDS = 3
#: Added to the expected count of every piece and of the unknown character.
SMOOTHING = 0.1


def pieces_of(path: str | None = None) -> list[str]:
    """The public vocabulary the probabilities are over: its pieces, in lower case."""
    return sorted({piece.lower() for piece, _ in unigram_pieces(path) if piece.strip(SPACE)})


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


#: Words up to this length are solved many at a time; their probabilities stay in range.
SHORT = 32
#: Words that are solved together: their tables stay in a processor's cache.
TOGETHER = 4_096
#: Words and characters that a task remembers the scores of, some more by one batch.
REMEMBERED, CHARACTERS = 150_000, 3_000_000
_SIEVE = np.uint64((1 << 20) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Arcs(NamedTuple):
    """Pieces within words: arrays of word, start and piece per (end, length), by end."""

    sizes: np.ndarray
    steps: list[tuple[int, int, np.ndarray, np.ndarray]]


class Segments:
    """Places of vocabulary pieces within a word; a character alone is always possible.

    Words up to ``SHORT`` are looked up together: the hashes of all substrings of one
    length are updated from those one shorter, sieved by 20 bits, and found in the
    sorted hashes of the pieces of that length.
    """

    def __init__(self, pieces: list[str]):
        self.index = {piece: i for i, piece in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.unknown = len(pieces)
        by_length: dict[int, list[tuple[int, int]]] = {}
        for piece, i in self.index.items():
            h = 0
            for c in piece:
                h = (h * int(_FACTOR) + ord(c) + 1) & MASK
            by_length.setdefault(len(piece), []).append((h, i))
        self.tables = {}
        for length, found in by_length.items():
            found.sort()
            hashes = np.array([h for h, _ in found], np.uint64)
            sieve = np.zeros(int(_SIEVE) + 1, bool)
            sieve[(mix(hashes) & _SIEVE).astype(np.int64)] = True
            self.tables[length] = hashes, np.array([i for _, i in found]), sieve

    def batch(self, words: list[str]) -> Arcs:
        """Arcs of words of ``SHORT`` characters at most, their mark in front not counted."""
        flat = np.frombuffer((SPACE + SPACE.join(words)).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = flat.astype(np.uint64) + np.uint64(1)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        first = np.cumsum(sizes) - sizes
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(codes)) - first[word]
        left = sizes[word] - place
        h = np.zeros(len(codes), np.uint64)
        rows = np.arange(len(codes))
        steps: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for length in range(1, min(self.longest, SHORT + 1) + 1):
            rows = rows[left[rows] >= length]
            if not len(rows):
                break
            h[rows] = h[rows] * _FACTOR + codes[rows + length - 1]
            piece = np.full(len(rows), -1)
            if length in self.tables:
                hashes, ids, sieve = self.tables[length]
                own = h[rows]
                at = np.flatnonzero(sieve[(mix(own) & _SIEVE).astype(np.int64)])
                found = np.minimum(np.searchsorted(hashes, own[at]), len(hashes) - 1)
                same = hashes[found] == own[at]
                piece[at[same]] = ids[found[same]]
            if length == 1:
                piece[piece < 0] = self.unknown
            hit = np.flatnonzero(piece >= 0)
            ends = place[rows[hit]] + length
            order = np.argsort(ends.astype(np.int8), kind="stable")
            hit, ends = hit[order], ends[order]
            for part in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(ends)) + 1):
                if len(part):
                    own = hit[part]
                    steps.append((int(ends[part[0]]), length, word[rows[own]], piece[own]))
        steps.sort(key=lambda step: step[0])
        return Arcs(sizes, steps)

    @staticmethod
    def forward(arcs: Arcs, p: np.ndarray) -> np.ndarray:
        """Weight of all segmentations up to each position: positions x words x columns of ``p``."""
        alpha = np.zeros((int(arcs.sizes.max(initial=0)) + 1, len(arcs.sizes), p.shape[1]))
        alpha[0] = 1.0
        for end, length, word, piece in arcs.steps:
            # A word has one piece at most of this length that ends here.
            alpha[end][word] += alpha[end - length].take(word, axis=0) * p.take(piece, axis=0)
        return alpha

    def scores_of(self, words: list[str], p: np.ndarray) -> np.ndarray:
        """Log probabilities of words, a row per word and a column of ``p`` per language."""
        out = np.empty((len(words), p.shape[1]))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        by_length = np.argsort(lengths, kind="stable")
        short = int(np.searchsorted(lengths[by_length], SHORT, side="right"))
        for start in range(0, short, TOGETHER):
            own = by_length[start : min(short, start + TOGETHER)]
            arcs = self.batch([words[i] for i in own])
            alpha = self.forward(arcs, p)
            out[own] = np.log(alpha[arcs.sizes, np.arange(len(own))])
        if short < len(words):
            table = [tuple(row) for row in p.tolist()]
            for i in by_length[short:]:
                out[i] = self.scores(words[i], table)
        return out

    def uses_of(self, words: list[str], counts: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Expected uses of each piece over all segmentations of counted words."""
        uses = np.zeros(self.unknown + 1)
        short = np.array([len(w) <= SHORT for w in words], bool)
        if short.any():
            own = [w for w, s in zip(words, short, strict=True) if s]
            times = counts[short]
            arcs = self.batch(own)
            alpha = self.forward(arcs, p[:, None])[:, :, 0].T
            beta = np.zeros(alpha.shape)
            rows = np.arange(len(own))
            beta[rows, arcs.sizes] = times / alpha[rows, arcs.sizes]
            for end, length, word, piece in reversed(arcs.steps):
                share = beta[word, end] * p[piece]
                beta[word, end - length] += share
                uses += np.bincount(piece, share * alpha[word, end - length], len(uses))
        table = p.tolist()
        for word, n, s in zip(words, counts.tolist(), short, strict=True):
            if not s:
                for piece, share in self.expected(word, table).items():
                    uses[piece] += n * share
        return uses

    def arcs(self, word: str) -> list[list[tuple[int, int]]]:
        """For each end within the word: (start, piece) of every piece ending there."""
        index, longest, unknown = self.index, self.longest, self.unknown
        marked = SPACE + word
        out: list[list[tuple[int, int]]] = [[]]
        for end in range(1, len(marked) + 1):
            here = []
            for start in range(max(0, end - longest), end):
                found = index.get(marked[start:end])
                if found is not None:
                    here.append((start, found))
            if not here or here[-1][0] != end - 1:
                here.append((end - 1, unknown))
            out.append(here)
        return out

    def expected(self, word: str, p: list[float]) -> dict[int, float]:
        """Expected number of uses of each piece over all segmentations of a word.

        ``forward`` and ``backward`` are scaled position by position, so that words
        of any length stay in range.
        """
        arcs = self.arcs(word)
        size = len(arcs) - 1
        forward, logs = [1.0] + [0.0] * size, [0.0] * (size + 1)
        for end in range(1, size + 1):
            # Values are relative to exp(logs of the position before).
            total, base = 0.0, logs[end - 1]
            for start, piece in arcs[end]:
                total += forward[start] * p[piece] * math.exp(logs[start] - base)
            forward[end], logs[end] = 1.0, base + math.log(total)
        backward = [0.0] * (size + 1)
        backward[size] = 1.0
        # backward[i]: weight of the rest from i, relative to exp(logs[size] - logs[i]).
        uses: dict[int, float] = {}
        for end in range(size, 0, -1):
            weight = backward[end]
            if weight:
                for start, piece in arcs[end]:
                    share = weight * p[piece] * math.exp(logs[start] - logs[end])
                    backward[start] += share
                    uses[piece] = uses.get(piece, 0.0) + share
        return uses

    def scores(self, word: str, p: list[tuple[float, ...]]) -> tuple[float, ...]:
        """Log probability of a word in each language: the sum over its segmentations."""
        arcs = self.arcs(word)
        languages = range(len(p[0]))
        out = []
        for language in languages:
            values, offset = [1.0], 0.0
            for here in arcs[1:]:
                total = 0.0
                for start, piece in here:
                    total += values[start] * p[piece][language]
                if total < 1e-200:
                    # Only the last few positions are used again.
                    low = max(0, len(values) - self.longest)
                    values[low:] = [v * 1e150 for v in values[low:]]
                    total, offset = total * 1e150, offset - 150 * math.log(10)
                values.append(total)
            out.append(math.log(values[-1]) + offset if values[-1] else -1e9)
        return tuple(out)


class LanguageModel:
    """Languages and, per piece, the probability in each of them."""

    def __init__(self, languages: list[str], pieces: list[str], probability: np.ndarray):
        self.languages, self.pieces, self.probability = languages, pieces, probability
        self._segments: Segments | None = None
        self._forget()

    def _forget(self) -> None:
        """Numbers of the words seen, in the order of the rows of their scores."""
        self._rows: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self._scores = np.zeros((0, len(self.languages)))
        self._characters = 0

    def __getstate__(self):
        return self.languages, self.pieces, self.probability

    def __setstate__(self, state):
        self.__init__(*state)

    def _score_new(self) -> None:
        """Log probabilities of the words that got a number and have none yet."""
        if self._segments is None:
            self._segments = Segments(self.pieces)
        new = [*itertools.islice(reversed(self._rows), len(self._rows) - len(self._scores))][::-1]
        if new:
            found = self._segments.scores_of(new, np.ascontiguousarray(self.probability.T))
            self._scores = np.concatenate([self._scores, found])
            self._characters += sum(map(len, new))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text, and its share of all languages' likelihood.

        The shares are of the likelihood to the power 1 / sqrt(words), so that long texts
        keep graded scores.
        """
        if len(self._rows) > REMEMBERED or self._characters > CHARACTERS:
            self._forget()
        at, sizes = [], []
        for text in texts:
            known = text and self.languages and any(map(str.isalpha, text))
            words = words_of(text) if known else []
            at.append(np.fromiter(map(self._rows.__getitem__, words), np.int64, len(words)))
            sizes.append(len(words))
        out = [(UNDETERMINED, 0.0)] * len(texts)
        if not any(sizes):
            return out
        self._score_new()
        rows = [i for i, n in enumerate(sizes) if n]
        lengths = np.array([sizes[i] for i in rows])
        totals = np.add.reduceat(self._scores.take(np.concatenate(at), axis=0), np.cumsum(lengths) - lengths)
        best = totals.argmax(axis=1)
        gaps = (totals - totals.max(axis=1, keepdims=True)) / np.sqrt(lengths)[:, None]
        shares = 1 / np.exp(gaps).sum(axis=1)
        for i, language, share in zip(rows, best.tolist(), shares.tolist(), strict=True):
            out[i] = (self.languages[language], share)
        return out


def fit_languages(
    labelled: DataFrame,
    pieces: list[str] | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    fit_rows: int = FIT_ROWS,
    rounds: int = ROUNDS,
    id_col: str = "doc_id",
) -> LanguageModel:
    """Piece probabilities of each language by expectation-maximisation.

    The languages and their rows are counted over all rows where text and language
    are given. Of each language about ``fit_rows`` rows are read, all if there are no
    more, drawn by a hash of id (where there is one) and text. Words are counted per language in the
    tasks; each round sums the expected uses of the pieces over all
    segmentations of the counted words. What comes to the driver is one number per
    language and piece of the fixed vocabulary.
    """
    pieces = pieces or pieces_of()
    drawn_by = [c for c in (id_col, text_col) if c in labelled.columns]
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(*drawn_by), F.lit(DRAWS)).alias("draw"),
    )
    share = F.ceil(F.lit(float(DRAWS)) * fit_rows / F.count("*")).alias("share")
    shares = settle(rows.groupBy("lang").agg(share), "language-shares")
    drawn = rows.join(F.broadcast(shares), "lang").where("draw < share").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                counts.update((lang, w) for w in words_of(text))
            if len(counts) > 500_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    schema = "lang string, word string, n long"
    words = settle(
        drawn.transform(map_batches, count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-words",
    )
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    size = len(pieces) + 1
    p = np.full((len(languages), size), 1.0 / size)
    number = {lang: i for i, lang in enumerate(languages)}
    sent = words.sparkSession.sparkContext.broadcast(pieces)
    for _ in range(rounds if languages else 0):
        expected = words.transform(map_batches, _expectation(sent, number, p), "cell long, uses double")
        sums = expected.groupBy("cell").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(len(languages) * size, SMOOTHING)
        uses[sums["cell"].to_numpy()] += sums["uses"].to_numpy()
        uses = uses.reshape(len(languages), size)
        p = uses / uses.sum(axis=1, keepdims=True)
    return LanguageModel(languages, pieces, p)


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.string()),
            pa.array([counts[k] for k in keys], pa.int64()),
        ],
        names=["lang", "word", "n"],
    )


def _expectation(sent, number: dict[str, int], p: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(sent.value)
        size = segments.unknown + 1
        uses = np.zeros(len(number) * size)
        for part in slices(batches, 5_000):
            langs, words = (part.column(k).to_pylist() for k in range(2))
            counts = part.column(2).to_numpy().astype(float)
            for lang in sorted(set(langs)):
                own = np.array([x == lang for x in langs])
                mine = [w for w, x in zip(words, own, strict=True) if x]
                first = number[lang] * size
                uses[first : first + size] += segments.uses_of(mine, counts[own], p[number[lang]])
        cells = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(uses[cells], pa.float64())],
            names=["cell", "uses"],
        )

    return run


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    NULL texts and texts without a letter, and every text if the model knows no
    language, give ``und`` and 0. Equal likelihoods go to the language first in
    the alphabet. Rows stay as they are; columns named like a result are replaced.
    """
    docs = without(docs, ["lang_pred", "score"])
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What a task remembers goes with it; the broadcast model stays as it came.
        own = LanguageModel(*sent.value.__getstate__())
        for part in slices(batches, 512):
            found = own.predict_all(part.column(at).to_pylist())
            added = [
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *added], names=[*part.schema.names, "lang_pred", "score"]
            )

    schema = T.StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return docs.transform(map_batches, run, schema)


def language_table(docs: DataFrame) -> DataFrame:
    """Predictions for all documents of a model that has not seen every fifth of them."""
    held_out = bucket("doc_id", 5) == 0
    model = fit_languages(docs.where(~held_out).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return identify(rows, model).drop("text")
