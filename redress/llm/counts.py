"""Token counts of a unigram vocabulary by a Viterbi search that keeps no path."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from redress.llm.common import Memo, map_batches, slices, without
from redress.llm.pieces import SPACE, vocabulary_file

#: How much less than the worst piece an unknown character scores; a fixed value
#: of unigram tokenizers.
UNKNOWN_PENALTY = 10.0


def unigram_pieces(path: str | None = None) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file, control and byte pieces left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path or vocabulary_file())
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


class UnigramCounter:
    """Number of tokens of the best segmentation.

    Ties are those of the tokenizers library: of equal scores the piece that
    begins first wins; a text that begins with no space gets one; a character without a piece scores below the worst piece
    by ``UNKNOWN_PENALTY``, and unknown neighbours form one token, which falls
    back to its bytes.
    """

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        # No piece holds a space that follows another character: the text falls
        # into parts before each run of spaces that are solved on their own.
        crossing = any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        self.part = re.compile("(?s).+" if crossing else f"(?s){SPACE}*[^{SPACE}]+|{SPACE}+")
        self.memo = Memo(self.count_part, entries=250_000)

    def count(self, text: str) -> int:
        if not text:
            return 0
        memo, spaced = self.memo, text.replace(" ", SPACE)
        front = "" if spaced[0] == SPACE else SPACE
        return sum([memo[p] for p in self.part.findall(front + spaced)])

    def count_part(self, part: str) -> int:
        size = len(part)
        best, tokens = [float("-inf")] * (size + 1), [0] * (size + 1)
        unknown_end = [False] * (size + 1)
        best[0] = 0.0
        done = 0

        def settle(upto: int) -> None:
            """Positions that no single-character piece ends at take an unknown one."""
            nonlocal done
            while done < upto:
                done += 1
                if not single[done]:
                    score = best[done - 1] + self.unknown
                    if score > best[done]:
                        spent = len(part[done - 1].encode("utf-8", "surrogatepass"))
                        best[done], tokens[done] = score, tokens[done - 1] + spent
                        unknown_end[done] = True

        single = [False] * (size + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
        for last, (length, score) in self.automaton.iter(part):
            matches[last + 1].append((length, score))
            if length == 1:
                single[last + 1] = True
        for end in range(1, size + 1):
            # The longest match begins first and wins a tie.
            for length, score in sorted(matches[end], reverse=True):
                total = best[end - length] + score
                if total > best[end]:
                    best[end], tokens[end] = total, tokens[end - length] + 1
                    unknown_end[end] = False
            settle(end)
        return tokens[size]


_counters: dict[str, UnigramCounter] = {}


def _counter(pieces: list[tuple[str, float]]) -> UnigramCounter:
    key = hashlib.sha256(repr(pieces).encode()).hexdigest()
    if key not in _counters:
        _counters[key] = UnigramCounter(pieces)
    return _counters[key]


def count_tokens(
    docs: DataFrame,
    pieces: list[tuple[str, float]] | None = None,
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_tokens``, the tokens of each whole text.

    NULL and empty texts have none. Rows stay as they are, repeated ones
    included; a column named ``n_tokens`` is replaced. No shuffle takes place.
    """
    pieces = pieces or unigram_pieces()
    docs = without(docs, ["n_tokens"])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(pieces)
        for part in slices(batches):
            counts = pa.array([counter.count(t.as_py() or "") for t in part.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*part.columns, counts], names=[*part.schema.names, "n_tokens"]
            )

    schema = T.StructType([*docs.schema.fields]).add("n_tokens", T.LongType())
    return docs.transform(map_batches, run, schema)


def token_count_table(docs: DataFrame) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text")).drop("text")
