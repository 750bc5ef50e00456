"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redress.llm.common import SPACES, let, without


class Rule(NamedTuple):
    """A document fails if ``metric`` (of ``METRICS``) is outside its bounds."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: Common words of the languages of the corpus; a parameter like the rules.
STOP_WORDS = (
    "the be to of and that have with a in is it for as on was by this from "
    "der die das und ist mit zu den von im nicht ein eine für auf sich "
    "le la les de du des et est un une dans que qui par pour sur pas au en "
    "el los las del y que es por para con se su al no una como"
).split()

RULES = (
    Rule("word length", "mean_word_chars", 2, 14),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop words", "stop_word_ratio", 0.03, None),
    Rule("repeated lines", "dup_line_ratio", None, 0.3),
    Rule("long lines only", "words_per_line", 1, None),
)

OUTPUT = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "failed_rules", "kept",
]
_POSITION_BITS = 24
_POSITION = (1 << _POSITION_BITS) - 1


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[ \\t-\\r]+", -1)
    )


def repeated_window_words(tokens: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that the text has twice or more.

    Each window is one number, its hash above its position. Sorted, equal windows
    are neighbours. Neighbours of equal hash are compared word by word; if any
    differ (or the text has 2^24 words), the windows themselves are sorted, so the
    count is exact.
    """
    starts = F.sequence(F.lit(0), F.size(tokens) - size)

    def window(at):
        return [F.get(tokens, at + k) for k in range(size)]

    def covered(positions: Column) -> Column:
        steps = F.transform(
            positions, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(positions, i + 1) - p, F.lit(size)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def repeated(sorted_windows: Column, same) -> Column:
        return F.filter(
            sorted_windows,
            lambda x, i: F.coalesce(
                same(x, F.get(sorted_windows, i - 1)) | same(x, F.get(sorted_windows, i + 1)),
                same(x, F.get(sorted_windows, i - 1)),
                same(x, F.get(sorted_windows, i + 1)),
                F.lit(False),
            ),
        )

    packed = F.sort_array(
        F.transform(
            starts,
            lambda i: F.shiftleft(F.xxhash64(*window(i)), _POSITION_BITS).bitwiseOR(i.cast("long")),
        )
    )

    def same_hash(x, y):
        return F.shiftright(x, _POSITION_BITS) == F.shiftright(y, _POSITION_BITS)

    def position(x):
        return x.bitwiseAND(F.lit(_POSITION)).cast("int")

    def differ(x, y):
        pairs = zip(window(position(x)), window(position(y)), strict=True)
        unequal = F.lit(False)
        for a, b in pairs:
            unequal |= a != b
        return unequal

    def exact() -> Column:
        named = [f"w{k}" for k in range(size)]
        structs = F.sort_array(
            F.transform(
                starts,
                lambda i: F.struct(*[w.alias(n) for w, n in zip(window(i), named, strict=True)], i.alias("p")),
            )
        )

        def same(x, y):
            equal = F.lit(True)
            for n in named:
                equal &= x[n] == y[n]
            return equal

        return let(
            structs,
            lambda s: let(
                F.sort_array(F.transform(repeated(s, same), lambda x: x["p"])), covered
            ),
        )

    def by_hash(found: Column) -> Column:
        clash = F.filter(
            found,
            lambda x, i: F.coalesce(
                same_hash(x, F.get(found, i - 1)) & differ(x, F.get(found, i - 1)), F.lit(False)
            ),
        )
        positions = F.sort_array(F.transform(found, position))
        return (
            F.when(F.size(found) == 0, F.lit(0).cast("long"))
            .when(F.size(clash) == 0, let(positions, covered))
            .otherwise(exact())
        )

    fast = let(packed, lambda s: let(repeated(s, same_hash), by_hash))
    return (
        F.when(F.size(tokens) < size, F.lit(0).cast("long"))
        .when(F.size(tokens) > _POSITION, exact())
        .otherwise(fast)
    )


def quality_rules(
    docs: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    stop_words: Sequence[str] = tuple(STOP_WORDS),
) -> DataFrame:
    """``docs`` with its counts, the names of the rules it fails, and ``kept``.

    ``base_failed`` holds for under 50 words or if more than half of the words
    lie in three-word windows that the text repeats. ``kept`` is false if it
    holds or if any rule of the table fails. Everything is one projection over
    the text: no shuffle and no function of Python.

    NULL and empty texts have no word and fail. Equal rows get equal results;
    each row counts for itself. A column named like a result is replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    both_cases = sorted({w for s in stop_words for w in (s, s[:1].upper() + s[1:])})
    docs = without(docs, OUTPUT)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    counted = docs.withColumns({"_text": text, "_words": words(text), "_lines": lines})
    joined = F.array_join("_words", "")
    counts = counted.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": (
            F.octet_length("_text")
            - F.octet_length(F.regexp_replace("_text", "[#*$%&|<>]+", ""))
        ).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": let(F.col("_words"), repeated_window_words),
        "_stops": F.size(F.filter("_words", lambda w: w.isin(both_cases))),
        "_n_lines": F.size("_lines"),
    })
    n = F.greatest(F.col("n_words"), F.lit(1))
    metrics = {
        "n_words": F.col("n_words"),
        "mean_word_chars": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "stop_word_ratio": F.col("_stops") / n,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        "words_per_line": F.col("n_words") / F.greatest(F.col("_n_lines"), F.lit(1)),
    }

    def fails(rule: Rule) -> Column:
        value, out = metrics[rule.metric], F.lit(False)
        if rule.least is not None:
            out |= value < rule.least
        if rule.most is not None:
            out |= value > rule.most
        return out

    failed = F.filter(
        F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules], F.lit(None).cast("string")),
        lambda x: x.isNotNull(),
    )
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counts.withColumns({"base_failed": base, "failed_rules": failed})
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .select(*docs.columns, *OUTPUT)
    )


def quality_digest(docs: DataFrame) -> DataFrame:
    return quality_rules(docs.select("doc_id", "text")).drop("text", "failed_rules")
