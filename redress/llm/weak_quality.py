"""Quality classifier from weak labels.

Overlapping heuristics vote on each text. Expectation-maximisation estimates how
accurate each of them is from the votes of all documents alone, and the posterior
labels train a linear scorer over hashed words and shapes. The same is done for two
targets, quality and toxicity.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from operator import eq, mul
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from redress.llm.common import Memo, map_batches, slices, without
from redress.llm.quality import STOP_WORDS
from redress.sources.scratch import settle

BUCKETS = 1 << 16
#: Documents that the scorer is trained on, about, drawn by a hash of text and row
#: number, so that copies are drawn one by one; the accuracies are estimated from all
#: documents.
FIT_ROWS = 20_000
DRAWS = 1_000_000_000
#: A bucket gets a weight if so many of the drawn documents have it.
SUPPORT = 20
#: Rounds of training, and steps that each task takes on its rows before the weights
#: of all tasks are averaged. There are TASKS of them, or more so that each has about
#: TASK_ROWS rows.
ROUNDS, STEPS, TASKS, TASK_ROWS = 5, 30, 4, 5_000
#: Insults; a parameter like the other word lists.
INSULTS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting "
    "clown dumb imbecile jerk fool filth vermin garbage freak creep coward liar".split()
)
#: Labelled documents, about, that marks of toxic texts are taken from; a mark is a word,
#: or the beginning of one, that so many of the toxic ones hold, and that is so many times
#: as frequent among them as among the others.
LABEL_ROWS = 20_000
MARK_SUPPORT, MARK_LIFT, BEGINNINGS = 3, 30, (5, 6, 7)
_STOPS = frozenset(STOP_WORDS)
_SYMBOL = re.compile(r"[#*$%&|<>{}\\=_~^]")
_RUN = re.compile(r"[^\w\s]{2,}| \| ")
_FIELD = (1 << 32) - 1
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„…"


class Shape(NamedTuple):
    """What the heuristics look at."""

    words: int
    symbols: float
    plain: float
    runs: float
    capitals: float
    stops: float
    top: float
    distinct: float
    echoes: float
    shouts: float
    insults: int
    insult_share: float
    marks: int
    other_marks: int
    all_marks: int


def shape_of(
    text: str, words: list[str], counts: Counter, known: list[tuple], blind: bool
) -> Shape:
    """``known`` has for each different word its bucket and two packed numbers.

    Without any mark to look for (``blind``) the number of marks is -1.
    """
    n = max(1, len(words))
    _, packed, marked = zip(*known, strict=True) if known else ((),) * 3
    times = list(counts.values())
    # Letters, capitals, stop words and insults are added up side by side.
    total = sum(map(mul, packed, times))
    letters, capitals, stops, insults = ((total >> k) & _FIELD for k in (0, 32, 64, 96))
    marks = sum(marked)
    return Shape(
        len(words),
        len(_SYMBOL.findall(text)) / n,
        letters / max(1, sum(map(len, words))),
        len(_RUN.findall(text)) / n,
        capitals / n,
        stops / n,
        max(times, default=0) / n,
        len(times) / n,
        sum(map(eq, words, words[1:])) / n,
        text.count("!") / n,
        insults,
        insults / max(1, letters),
        -1 if blind else marks & _FIELD,
        -1 if blind else marks >> 32,
        (marks & _FIELD) + (marks >> 32),
    )


Labeller = Callable[[Shape], int]
#: Votes 1 (has the quality), -1 (has not) or 0 (says nothing), by target.
LABELLERS: dict[str, dict[str, Labeller]] = {
    "quality": {
        "symbols": lambda s: -1 if s.symbols > 0.1 else 0,
        "marks around words": lambda s: -1 if s.plain < 0.85 else (1 if s.plain > 0.93 else 0),
        "runs of marks": lambda s: -1 if s.runs > 0.1 else 0,
        "capitals": lambda s: -1 if s.capitals > 0.3 else 0,
        "shouting": lambda s: -1 if s.shouts > 0.2 else 0,
        "stop words": lambda s: 1 if s.stops > 0.12 else (-1 if s.stops < 0.03 else 0),
        "one word": lambda s: -1 if s.top > 0.3 and s.words >= 10 else 0,
        "repeated words": lambda s: -1 if s.echoes > 0.2 else 0,
        "few different words": lambda s: -1 if s.distinct < 0.2 and s.words < 1000 else 0,
    },
    "toxic": {
        # Two halves of the marks, which know nothing of each other, and the list.
        "marks": lambda s: (s.marks > 0) - (s.marks == 0),
        "other marks": lambda s: (s.other_marks > 0) - (s.other_marks == 0),
        "several marks": lambda s: int(s.all_marks > 1),
        # Where there are no marks to look for, a text without an insult counts as clean.
        "insults": lambda s: 1 if s.insults else -(s.marks < 0),
        "several insults": lambda s: int(s.insults > 1),
        "dense insults": lambda s: 1 if s.insult_share > 0.002 else -(s.marks < 0 and not s.insults),
    },
}
_LEVELS = {
    "symbols": (0.02, 0.1, 0.3),
    "plain": (0.7, 0.85, 0.93),
    "runs": (0.02, 0.1),
    "distinct": (0.1, 0.2),
    "echoes": (0.05, 0.2),
    "capitals": (0.1, 0.3),
    "shouts": (0.05, 0.2),
    "stops": (0.03, 0.12),
    "top": (0.15, 0.3),
    "insults": (0, 1),
    "all_marks": (0, 1, 3),
}


def _bucket(feature: str) -> int:
    return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def marks_in(bare: str) -> list[str]:
    """A word and its beginnings."""
    return [bare, *(bare[:size] + "*" for size in BEGINNINGS if len(bare) > size)]


def _word(marks: dict[str, int]):
    # Most words begin like no mark.
    starts = {m[:3] for m in marks}

    def of(word: str) -> tuple[int, int, int]:
        """Bucket of a word without marks around it; its letters, whether it is in capitals,
        a stop word, an insult; whether it is a mark of a toxic text, and of which half."""
        bare = word.strip(_EDGES).lower()
        packed = len(bare)
        if word.isupper() and len(word) > 1:
            packed |= 1 << 32
        if bare in _STOPS:
            packed |= 1 << 64
        if bare in INSULTS:
            packed |= 1 << 96
        half = None
        if bare[:3] in starts:
            half = next((marks[m] for m in marks_in(bare) if m in marks), None)
        return _bucket(bare), packed, 0 if half is None else 1 << 32 * half

    return of


_known_words: dict[frozenset, Memo] = {}


def _words(marks: dict[str, int]) -> Memo:
    """What is known of words, one memory per Python worker, so that it outlives a task."""
    key = frozenset(marks.items())
    if key not in _known_words:
        _known_words.clear()
        _known_words[key] = Memo(_word(marks), entries=150_000)
    return _known_words[key]


class Features:
    """Votes and hashed features of a text: its words, and the levels of its shape."""

    def __init__(self, marks: dict[str, int]):
        self.word, self.blind = _words(marks), not marks
        #: Of each level: the place in a shape, the limits, and the bucket between them.
        self.levels = [
            (Shape._fields.index(name), limits,
             [_bucket(f"{name} {k} /") for k in range(len(limits) + 1)])
            for name, limits in _LEVELS.items()
        ]

    def shape(self, text: str | None) -> tuple[Shape, list[tuple]]:
        """The shape of a text, and what is known of its different words."""
        text = text or ""
        words = text.split()
        counts = Counter(words)
        known = list(map(self.word.__getitem__, counts))
        return shape_of(text, words, counts, known, self.blind), known

    def hashed(self, shape: Shape, known: list[tuple]) -> list[int]:
        found = {k[0] for k in known}
        found.update(
            buckets[bisect_left(limits, shape[at])] for at, limits, buckets in self.levels
        )
        return list(found)


def toxic_marks(labelled: DataFrame, n: int = LABEL_ROWS) -> dict[str, int]:
    """Marks of toxic texts from (``text``, ``toxic``): 0 or 1 for the half they are in.

    About ``n`` rows, drawn by the hash of the text, are looked at; the driver gets one
    row per mark. A row without a label or text says nothing.
    """
    known = labelled.where("text IS NOT NULL AND toxic IS NOT NULL").select("text", "toxic")
    share = min(1.0, n / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("text"), F.lit(DRAWS)) < int(DRAWS * share))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for part in slices(batches):
            for text, toxic in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                own = {w.strip(_EDGES).lower() for w in text.as_py().split()}
                for mark in {"", *(m for w in own for m in marks_in(w))}:
                    counts.setdefault(mark, [0, 0])[bool(toxic)] += 1
        columns = [list(counts), [c[1] for c in counts.values()], [c[0] for c in counts.values()]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)],
            names=["mark", "toxic", "clean"],
        )

    # The empty mark is in every text, so its counts are those of the texts.
    counts = settle(
        drawn.transform(map_batches, count, "mark string, toxic long, clean long")
        .groupBy("mark").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")),
        "marks",
    )
    every = counts.where("mark = ''").first()
    if every is None or not every.toxic or not every.clean:
        return {}
    lift = (F.col("toxic") / every.toxic) / ((F.col("clean") + 0.5) / every.clean)
    chosen = counts.where((F.col("toxic") >= MARK_SUPPORT) & (lift >= MARK_LIFT)).select("mark")
    return {r.mark: xxhash.xxh3_64_intdigest(r.mark) % 2 for r in chosen.collect()}


def votes_of(shape: Shape) -> str:
    """One character per labeller, targets after each other."""
    return "".join(
        "-0+"[vote(shape) + 1] for labellers in LABELLERS.values() for vote in labellers.values()
    )


def estimate(
    votes: np.ndarray, counts: np.ndarray, rounds: int = 200
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the target per vote pattern, and each labeller's accuracy.

    ``votes`` has a row per pattern and a column per labeller, in -1, 0, 1. Given the
    target, a labeller that votes is right with its accuracy, whatever the others say;
    one that does not vote says nothing. Accuracies start alike and stay above chance,
    the share of the target starts at a half, and both are estimated by
    expectation-maximisation.
    """
    weights = counts / counts.sum()
    accuracy, prior = np.full(votes.shape[1], 0.75), 0.5
    voted = (votes != 0) * weights[:, None]
    posterior = np.full(len(votes), 0.5)
    for _ in range(rounds):
        logit = np.log(prior / (1 - prior)) + votes @ np.log(accuracy / (1 - accuracy))
        posterior = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
        agrees = np.where(votes > 0, posterior[:, None], 1 - posterior[:, None])
        found = (voted * agrees).sum(axis=0) / np.maximum(voted.sum(axis=0), 1e-12)
        accuracy = np.clip(np.where(voted.sum(axis=0) > 0, found, 0.75), 0.55, 0.99)
        prior = float(np.clip((weights * posterior).sum(), 0.02, 0.98))
    return posterior, accuracy


class Scorer(NamedTuple):
    """Weights per target and bucket, and biases; what the labellers' accuracies are."""

    weights: np.ndarray
    bias: np.ndarray
    accuracies: dict[str, dict[str, float]]
    marks: dict[str, int]


def _votes(fit_share: int, marks: Broadcast):
    """text, draw -> counts of vote patterns, and the features of the drawn rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, patterns = Features(marks.value), Counter()
        for part in slices(batches):
            rows = []
            for text, draw in zip(part.column(0), part.column(1).to_pylist(), strict=True):
                shape, known = features.shape(text.as_py())
                votes = votes_of(shape)
                patterns[votes] += 1
                if draw < fit_share:
                    rows.append((votes, features.hashed(shape, known)))
            if rows:
                yield _vote_batch([r[0] for r in rows], [0] * len(rows), [r[1] for r in rows])
        yield _vote_batch(list(patterns), list(patterns.values()), [None] * len(patterns))

    return run


def _vote_batch(votes: list, counts: list, features: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(votes, pa.string()),
            pa.array(counts, pa.int64()),
            pa.array(features, pa.list_(pa.int32())),
        ],
        names=["votes", "n", "features"],
    )


def fit_scorer(
    docs: DataFrame,
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    rounds: int = ROUNDS,
    labelled: DataFrame | None = None,
) -> Scorer:
    """Accuracies from the votes of all rows, weights from about ``fit_rows`` of them.

    ``labelled`` (``text``, ``toxic``) gives marks of toxic texts in any language, see
    ``toxic_marks``; without it only the list of insults speaks of toxicity.

    The driver holds one number per vote pattern and per bucket. In each round of
    training the tasks start from the same weights, take some steps on their drawn
    rows, and the weights are averaged.
    """
    n = docs.count()
    targets = list(LABELLERS)
    empty = Scorer(np.zeros((len(targets), BUCKETS), np.float32), np.zeros(len(targets)), {}, {})
    if not n:
        return empty
    marks = toxic_marks(labelled) if labelled is not None else {}
    sent_marks = docs.sparkSession.sparkContext.broadcast(marks)
    share, draw, tasks = _drawing(n, fit_rows, text_col)
    stored = settle(
        docs.select(F.col(text_col).alias("text"), draw.alias("draw")).transform(
            map_batches,
            _votes(share, sent_marks), "votes string, n long, features array<int>"
        ),
        "votes",
    )
    patterns = stored.where("features IS NULL").groupBy("votes").agg(F.sum("n").alias("n"))
    drawn = stored.where("features IS NOT NULL").select("votes", "features")
    return _fit(patterns, drawn, n, tasks, rounds, marks)


def _drawing(n: int, fit_rows: int, text_col: str):
    """Below which draw a row is drawn, the draw of a row, and the tasks that train."""
    return (
        min(DRAWS, max(1, round(DRAWS * fit_rows / n))),
        F.pmod(F.xxhash64(text_col, F.monotonically_increasing_id()), F.lit(DRAWS)),
        max(TASKS, -(-min(n, fit_rows) // TASK_ROWS)),
    )


def _fit(
    patterns: DataFrame, drawn: DataFrame, n: int, tasks: int, rounds: int, marks: dict[str, int]
) -> Scorer:
    """The scorer of ``n`` documents, from the number of each vote pattern (``votes``, ``n``)
    and the votes and features of the drawn rows."""
    spark, targets = drawn.sparkSession, list(LABELLERS)
    patterns = patterns.collect()
    table = np.array([["-0+".index(c) - 1 for c in r.votes] for r in patterns])
    counts = np.array([float(r.n) for r in patterns])
    labels, accuracies, first = [], {}, 0
    for target, labellers in LABELLERS.items():
        posterior, right = estimate(table[:, first : first + len(labellers)], counts)
        labels.append(posterior)
        accuracies[target] = dict(zip(labellers, right.tolist(), strict=True))
        first += len(labellers)
    label = {r.votes: tuple(p[i] for p in labels) for i, r in enumerate(patterns)}
    drawn = settle(drawn.repartition(tasks), "drawn")
    supported = np.zeros(BUCKETS, np.float32)
    for r in (
        drawn.select(F.explode("features").alias("f"))
        .groupBy("f")
        .count()
        .where(F.col("count") >= min(SUPPORT, max(1, n // 50)))
        .toArrow()["f"]
        .to_pylist()
    ):
        supported[r] = 1
    weights, bias = np.zeros((len(targets), BUCKETS), np.float32), np.zeros(len(targets))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((label, supported, weights, bias))
        trained = drawn.transform(
            map_batches, _train(sent), "n long, weights binary, bias array<double>"
        ).collect()
        total = sum(r.n for r in trained) or 1
        weights = sum(
            np.frombuffer(r.weights, np.float32).reshape(weights.shape) * np.float32(r.n / total)
            for r in trained
        )
        bias = sum(np.array(r.bias) * (r.n / total) for r in trained)
        sent.destroy()
    return Scorer(weights, bias, accuracies, marks)


def _train(sent):
    """Some steps of logistic regression on the rows of a task, by Adagrad."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, supported, weights, bias = sent.value
        weights, bias = weights.copy(), bias.copy()
        rows, votes = [], []
        for batch in batches:
            votes.extend(batch.column(0).to_pylist())
            rows.extend(x.values.to_numpy() for x in batch.column(1))
        if rows:
            sizes = np.array([len(r) for r in rows])
            flat, starts = np.concatenate(rows), np.cumsum(sizes) - sizes
            for target in range(len(bias)):
                wanted = np.array([label[v][target] for v in votes])
                # So that buckets of few rows move slowly.
                squares, bias_square = np.full(BUCKETS, 1e-2), 1e-2
                for _ in range(STEPS):
                    score = np.add.reduceat(weights[target][flat], starts) + bias[target]
                    error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - wanted) / len(rows)
                    slope = np.bincount(flat, np.repeat(error, sizes), BUCKETS)
                    slope = (slope + 1e-5 * weights[target]) * supported
                    squares += slope**2
                    bias_square += error.sum() ** 2
                    weights[target] -= (0.5 * slope / np.sqrt(squares)).astype(np.float32)
                    bias[target] -= 0.5 * error.sum() / np.sqrt(bias_square)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([len(rows)], pa.int64()),
                pa.array([weights.astype(np.float32).tobytes()], pa.binary()),
                pa.array([bias.tolist()], pa.list_(pa.float64())),
            ],
            names=["n", "weights", "bias"],
        )

    return run


OUTPUT = ["quality_score", "toxic_score", "kept"]


def classify(docs: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality_score``, ``toxic_score`` (0 to 1) and ``kept``.

    A document is kept if it is likelier of quality than not, and not likelier toxic.
    A NULL or empty text is scored by the shape of no words. Rows stay as they are;
    columns named like a result are replaced. No shuffle takes place.
    """
    docs = without(docs, OUTPUT)
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, _, marks = sent.value
        features = Features(marks)
        for part in slices(batches):
            found = [features.hashed(*features.shape(t.as_py())) for t in part.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *_scores(found, weights, bias)],
                names=[*part.schema.names, *OUTPUT],
            )

    return docs.transform(map_batches, run, _scored(docs.schema.fields))


def _scored(fields: list[T.StructField]) -> T.StructType:
    schema = T.StructType([*fields])
    return schema.add(OUTPUT[0], "double").add(OUTPUT[1], "double").add(OUTPUT[2], "boolean")


def _scores(found: list, weights: np.ndarray, bias: np.ndarray) -> list[pa.Array]:
    """The columns of ``OUTPUT`` for rows of these features."""
    scores = np.zeros((len(found), len(bias)))
    for i, own in enumerate(found):
        scores[i] = weights[:, own].sum(axis=1) + bias
    scores = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    kept = (scores[:, 0] >= 0.5) & (scores[:, 1] < 0.5)
    return [pa.array(scores[:, 0]), pa.array(scores[:, 1]), pa.array(kept)]


def fit_and_classify(
    docs: DataFrame,
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    rounds: int = ROUNDS,
    labelled: DataFrame | None = None,
) -> DataFrame:
    """``classify(docs, fit_scorer(docs))`` without the texts, each of which is read once.

    Votes and features of every document are stored between the two; the features take
    some two bytes per different word.
    """
    n = docs.count()
    if not n:
        return classify(docs, fit_scorer(docs, text_col, fit_rows, rounds), text_col).drop(text_col)
    spark = docs.sparkSession
    marks = toxic_marks(labelled) if labelled is not None else {}
    share, draw, tasks = _drawing(n, fit_rows, text_col)
    others = without(docs, OUTPUT).drop(text_col)
    stored = settle(
        docs.select(F.col(text_col).alias("_text"), (draw < share).alias("_drawn"), *others.columns)
        .transform(
            map_batches, _describe(spark.sparkContext.broadcast(marks)),
            T.StructType([
                T.StructField("_votes", T.StringType()), T.StructField("_drawn", T.BooleanType()),
                T.StructField("_features", T.ArrayType(T.IntegerType())), *others.schema.fields,
            ]),
        ),
        "features",
    )
    patterns = stored.groupBy(F.col("_votes").alias("votes")).agg(F.count("*").alias("n"))
    drawn = stored.where("_drawn").select(
        F.col("_votes").alias("votes"), F.col("_features").alias("features")
    )
    scorer = _fit(patterns, drawn, n, tasks, rounds, marks)
    sent = spark.sparkContext.broadcast((scorer.weights, scorer.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        for part in slices(batches):
            found = [x.values.to_numpy() for x in part.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], *_scores(found, weights, bias)],
                names=[*part.schema.names[1:], *OUTPUT],
            )

    return stored.select("_features", *others.columns).transform(
        map_batches, run, _scored(others.schema.fields)
    )


def _describe(marks: Broadcast):
    """text, drawn, others -> votes, drawn, features, others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(marks.value)
        for part in slices(batches):
            votes, found = [], []
            for text in part.column(0):
                shape, known = features.shape(text.as_py())
                votes.append(votes_of(shape))
                found.append(features.hashed(shape, known))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(votes, pa.string()), part.column(1),
                    pa.array(found, pa.list_(pa.int32())), *part.columns[2:],
                ],
                names=["_votes", "_drawn", "_features", *part.schema.names[2:]],
            )

    return run


def quality_table(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Scores and decisions; ``labels`` (``doc_id``, ``toxic``) give the marks."""
    rows, labelled = docs.select("doc_id", "text"), None
    if labels is not None:
        known = labels.where("toxic IS NOT NULL").select("doc_id", "toxic")
        # Drawn before the join, so that few ids are sent to the documents.
        share = min(1.0, LABEL_ROWS / max(1, known.count()))
        drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(DRAWS)) < int(DRAWS * share))
        labelled = rows.join(F.broadcast(drawn.dropDuplicates()), "doc_id").select("text", "toxic")
    return fit_and_classify(rows, labelled=labelled)
