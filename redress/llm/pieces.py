"""SentencePiece encoding and decoding for merge-type vocabularies."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from redress.llm.common import Memo, map_batches, slices, without

SPACE = "▁"
_UNKNOWN, _CONTROL, _BYTE = 2, 3, 6
#: Up to so many symbols the agenda is a plain list, or a row of costs beside others.
SHORT = 24
#: Chunks that are merged side by side.
TOGETHER = 4096
NO_PAIR = float("inf")


def vocabulary_file() -> str:
    """The public merge-type vocabulary that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class MergeVocabulary:
    """Pieces and scores of a merge-type model, with its own encoder and decoder.

    The file's bytes travel to the tasks, so no task opens the path.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("not a merge-type vocabulary with byte fallback")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not (
            spec.add_dummy_prefix and spec.escape_whitespaces
        ):
            raise ValueError("only the identity normaliser with a space in front is supported")
        self.library = SentencePieceProcessor(model_proto=model)
        self.end = self.library.eos_id()
        self.pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        if set(kinds) - {1, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        #: piece: (minus its score, id)
        self.known = {
            p.piece: (-p.score, i) for i, p in enumerate(proto.pieces) if p.type == 1
        }
        self.byte_ids = {
            int(self.pieces[i][3:5], 16): i for i, kind in enumerate(kinds) if kind == _BYTE
        }
        self.costs = {piece: cost for piece, (cost, _) in self.known.items()}
        self.ids = {piece: i for piece, (_, i) in self.known.items()}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.silent = {i for i, kind in enumerate(kinds) if kind == _CONTROL}
        self.pairs, self.merged, self.code_ids = self._pair_table()
        self.merge_costs = np.full(len(self.pieces) + 1, NO_PAIR)
        for cost, i in self.known.values():
            self.merge_costs[i] = cost
        self.marked = self.silent | set(self.byte_of)
        # Where no piece can cross, a text falls into chunks that are merged on
        # their own: before a run of spaces, and around a line break.
        crossing = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.known)
        self.chunk = re.compile(
            "(?s).+" if crossing else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n"
        )

    def _pair_table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of ids that form a piece, sorted, what they form, and the id of each code point."""
        size, found = len(self.pieces), {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    found[left * size + right] = i
        keys = np.array(sorted(found), np.int64)
        codes = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                codes[ord(piece)] = i
        # A character that only stands within pieces has no id: left to the merge by text.
        return keys, np.array([found[k] for k in keys.tolist()], np.int64), codes

    def _formed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that pairs of ids form; the number of pieces where there is none."""
        wanted = left * len(self.pieces) + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        hit = (self.pairs[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(hit, self.merged[at], len(self.pieces))

    def merge_all(self, chunks: list[str]) -> list[list[int]]:
        """Ids of many chunks; those of like length are merged side by side."""
        out: list[list[int] | None] = [None] * len(chunks)
        order = sorted(range(len(chunks)), key=lambda i: len(chunks[i]))
        for start in range(0, len(order), TOGETHER):
            part = [i for i in order[start : start + TOGETHER] if len(chunks[i]) <= SHORT]
            if part:
                for i, ids in zip(part, self._merge_rows([chunks[i] for i in part]), strict=True):
                    out[i] = ids
        return [self.merge(c) if ids is None else ids for c, ids in zip(chunks, out, strict=True)]

    def _merge_rows(self, chunks: list[str]) -> list[list[int] | None]:
        """One row per chunk: in each round every row merges its best pair, the first of equals.

        Chunks with a character that is no piece are left out (None).
        """
        lengths = np.array(list(map(len, chunks)))
        rows, width = len(chunks), int(lengths.max()) + 1
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = np.full((rows, width), -1, np.int64)
        symbols[np.arange(width) < lengths[:, None]] = self.code_ids[codes]
        whole = (symbols >= 0).sum(axis=1) == lengths
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        formed = np.full((rows, width), len(self.pieces), np.int64)
        formed[:, :-1] = self._formed(symbols[:, :-1], symbols[:, 1:])
        costs = self.merge_costs[formed]
        going = np.flatnonzero(whole)
        while len(going):
            at = costs[going].argmin(axis=1)
            more = costs[going, at] < NO_PAIR
            going, at = going[more], at[more]
            gone = after[going, at]
            symbols[going, at] = formed[going, at]
            symbols[going, gone], costs[going, gone] = -1, NO_PAIR
            follower = after[going, at] = after[going, gone]
            before[going, follower] = at
            for left, right in ((at, follower), (before[going, at], at)):
                inside = left >= 0
                row, left, right = going[inside], left[inside], right[inside]
                formed[row, left] = self._formed(symbols[row, left], symbols[row, right])
                costs[row, left] = self.merge_costs[formed[row, left]]
        stays = symbols >= 0
        ids, ends = symbols[stays].tolist(), np.cumsum(stays.sum(axis=1)).tolist()
        cut = zip([0, *ends], ends, whole.tolist(), strict=False)
        return [ids[a:b] if known else None for a, b, known in cut]

    def chunks(self, text: str) -> list[str]:
        """The normalised text in independent chunks; an empty text has none."""
        return self.chunk.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def merge(self, chunk: str) -> list[int]:
        """Ids of a chunk: adjacent pairs are merged by score, then from the left.

        The agenda is a heap of pairs that form a piece. A pair whose parts have
        been merged meanwhile is stale and skipped.
        """
        if len(chunk) <= SHORT:
            return self._ids(self._merge_short(chunk))
        known = self.known
        symbols: list[str] = list(chunk)
        size = len(symbols)
        before = list(range(-1, size - 1))
        after = [*range(1, size), -1]
        agenda: list[tuple[float, int, int, str]] = []
        for i in range(size - 1):
            found = known.get(pair := symbols[i] + symbols[i + 1])
            if found:
                agenda.append((found[0], i, i + 1, pair))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, pair = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or symbols[left] + symbols[right] != pair:
                continue
            symbols[left], symbols[right] = pair, ""
            follower = after[left] = after[right]
            if follower >= 0:
                before[follower] = left
                if found := known.get(longer := pair + symbols[follower]):
                    heapq.heappush(agenda, (found[0], left, follower, longer))
            leader = before[left]
            if leader >= 0 and (found := known.get(longer := symbols[leader] + pair)):
                heapq.heappush(agenda, (found[0], leader, left, longer))
        return self._ids(symbols)

    def _merge_short(self, chunk: str) -> list[str]:
        """The same with the agenda as a list in order of place, for few symbols."""
        cost = self.costs.get
        symbols = list(chunk)
        agenda = list(map(cost, map(add, symbols, symbols[1:]), repeat(NO_PAIR)))
        while agenda and (best := min(agenda)) != NO_PAIR:
            at = agenda.index(best)
            pair = symbols[at] + symbols.pop(at + 1)
            symbols[at] = pair
            del agenda[at]
            if at < len(agenda):
                agenda[at] = cost(pair + symbols[at + 1], NO_PAIR)
            if at:
                agenda[at - 1] = cost(symbols[at - 1] + pair, NO_PAIR)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        ids = list(map(self.ids.get, symbols))
        if None not in ids:
            return ids
        out: list[int] = []
        for symbol, found in zip(symbols, ids, strict=True):
            if found is not None:
                out.append(found)
            elif symbol:
                out.extend(self.byte_ids[b] for b in symbol.encode())
        return out

    def by_library(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk from the library, which puts a space in front of every text.

        A chunk without that space follows a line break, whose two pieces are left out.
        """
        texts = [c[1:] if c[0] == SPACE else "\n" + c for c in chunks]
        encoded = self.library.encode([t.replace(SPACE, " ") for t in texts], num_threads=1)
        return [
            (ids or [self.known[SPACE][1]]) if c[0] == SPACE else ids[2:]
            for c, ids in zip(chunks, encoded, strict=True)
        ]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space that encoding put in front is taken off again."""
        first = next((self.pieces[i] for i in ids if i not in self.silent), "")
        text = self.decode_part(ids)
        return self.strip_front(text) if first.startswith(SPACE) else text

    @staticmethod
    def strip_front(text: str) -> str:
        return text[1:] if text[:1] == " " else text

    def decode_part(self, ids: list[int]) -> str:
        """Decoded text of ids, the space in front included."""
        if self.marked.isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids]).replace(SPACE, " ")
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(decode_bytes(bytes(pending)))
                pending.clear()
            if i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        if pending:
            out.append(decode_bytes(bytes(pending)))
        return "".join(out)


def decode_bytes(raw: bytes) -> str:
    """UTF-8 text of byte pieces; each byte that is none becomes U+FFFD."""
    out, start = [], 0
    while start < len(raw):
        for size in (1, 2, 3, 4):
            try:
                out.append(raw[start : start + size].decode())
                start += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            start += 1
    return "".join(out)


class Encoder:
    """Remembers per chunk: number of ids, ids as text, decoded text, differs from the library."""

    def __init__(self, model: bytes):
        self.vocabulary = MergeVocabulary(model)
        self.memo = Memo(self._chunk, entries=200_000)

    def _chunk(self, chunk: str) -> tuple[int, str, str, bool]:
        return self._learn([chunk])[chunk]

    def _learn(self, chunks: list[str]) -> dict[str, tuple[int, str, str, bool]]:
        """Entries of chunks, each merged here and checked against the library."""
        own, out = self.vocabulary, {}
        merged = own.merge_all(chunks)
        for chunk, ids, theirs in zip(chunks, merged, own.by_library(chunks), strict=True):
            out[chunk] = len(ids), " ".join(map(str, ids)), own.decode_part(ids), ids != theirs
        return out

    def _entries(self, chunks: Iterable[str]) -> dict[str, tuple[int, str, str, bool]]:
        """Entries of distinct chunks; those not remembered are learnt together."""
        memo, out, new = self.memo, {}, []
        for chunk in chunks:
            if (entry := memo.get(chunk)) is None:
                if (entry := memo.old.get(chunk)) is None:
                    new.append(chunk)
                    continue
                memo.put(chunk, entry)
            out[chunk] = entry
        if new:
            learnt = self._learn(new)
            for chunk, entry in learnt.items():
                memo.put(chunk, entry)
            out.update(learnt)
        return out

    def encode(self, text: str) -> tuple[int, str, str, int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[tuple[int, str, str, int]]:
        """Per text: number of ids, ids joined by spaces, decoded text, chunks that differ."""
        own, end = self.vocabulary, str(self.vocabulary.end)
        cut = list(map(own.chunks, texts))
        entries = self._entries(set(chain.from_iterable(cut)))
        out = []
        for chunks in cut:
            if not chunks:
                out.append((1, end, "", 0))
                continue
            parts = map(entries.__getitem__, chunks)
            counts, ids, decoded, differing = zip(*parts, strict=True)
            whole = own.strip_front("".join(decoded))
            out.append((sum(counts) + 1, f"{' '.join(ids)} {end}", whole, sum(differing)))
        return out


def _together(texts: list[str], most: int = 1 << 20) -> Iterator[list[str]]:
    """Neighbouring texts of so many code points together; a longer one alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > most:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


_encoders: dict[str, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """One encoder per model and Python worker, so that its memory outlives a task."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


OUTPUT = ["n_tokens", "token_ids", "decoded", "n_differing"]


def encode_pieces(
    docs: DataFrame,
    model_path: str | None = None,
    text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """``docs`` with its ids (end id included), the text they decode to, and a check.

    Adds ``n_tokens``, ``token_ids`` (array), ``decoded`` and ``n_differing``, the
    number of chunks for which the library gives other ids (0 if all is well);
    with ``digests``, ``ids_sha256`` and ``decoded_sha256`` in place of ids and text.
    Chunks, the units that no piece can cross, are encoded once per worker by the
    merge agenda, each checked against the library (the new ones of some texts in one
    call), and remembered by two generations of bounded size.

    NULL text: as an empty one, the end id only. Rows stay as they are, repeated
    ones and those of an empty table included; a column named like a result is
    replaced. No shuffle takes place.
    """
    with open(model_path or vocabulary_file(), "rb") as file:
        model = file.read()
    added = ["n_tokens", "ids_sha256", "decoded_sha256", "n_differing"] if digests else OUTPUT
    docs = without(docs, added)
    kinds = {
        "n_tokens": T.LongType(),
        "n_differing": T.LongType(),
        "token_ids": T.ArrayType(T.IntegerType()),
    }
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for part in slices(batches):
            whole = [t.as_py() or "" for t in part.column(at)]
            texts = [t for some in _together(whole) for t in own.encode_all(some)]
            if digests:
                middle = [
                    pa.array([_sha(t[k]) for t in texts], pa.string()) for k in (1, 2)
                ]
            else:
                middle = [
                    pa.array([[int(i) for i in t[1].split()] for t in texts], pa.list_(pa.int32())),
                    pa.array([t[2] for t in texts], pa.string()),
                ]
            counts = [pa.array([t[k] for t in texts], pa.int64()) for k in (0, 3)]
            columns = [*part.columns, counts[0], *middle, counts[1]]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, *added])

    schema = T.StructType([*docs.schema.fields])
    for name in added:
        schema = schema.add(name, kinds.get(name, T.StringType()))
    return docs.transform(map_batches, run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def pieces_digest(docs: DataFrame) -> DataFrame:
    return encode_pieces(docs.select("doc_id", "text"), digests=True).drop("text")
