"""Quality rules: a threshold table compiled into Spark expressions, no user functions.

``measures`` turns a text column into named numbers, ``RULES`` bounds ratios of them, and
``assess`` compiles both into two stacked projections. Null and empty texts have no words and
fail. Repeated rows are judged alike; other columns are ignored by ``assess`` and kept by
``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rekindle.llm.common import WORD

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it on with as was at by be this a an are from "
    "der die und das ist von nicht mit im zu auf den ein eine des als "
    "le la les de et un une est que pour dans sur avec du au il ne pas "
    "el en y los las por con del se su al no lo"
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a side that is None is not checked."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.numerator)
        scale = F.col(self.denominator) if self.denominator else F.lit(1)
        fits = F.lit(True)
        if self.low is not None:
            fits = fits & (value >= self.low * scale)
        if self.high is not None:
            fits = fits & (value <= self.high * scale)
        return fits


#: What makes a text unusable whatever its kind.
BASE_RULES = (
    Rule("enough_words", "n_words", low=50),
    Rule("few_repeats", "n_repeat_words", "n_words", high=0.5),
)
#: The method's own bounds.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=2.0, high=12.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.03),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.6),
)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Each window becomes one number: the upper bits of its hash, then its position. Sorted, equal
    windows stand side by side; neighbours count as equal only if their words are.
    """
    bits = F.ceil(F.log2(F.size(words) + F.lit(2))).cast("int")
    low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - F.lit(1).cast("long")

    def positions(mask: Column) -> Column:
        def pack(word: Column, i: Column) -> Column:
            hashed = F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2))
            return hashed.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))

        def at(value: Column) -> Column:
            return value.bitwiseAND(mask).cast("int")

        def chosen(windows: Column) -> Column:
            def with_next(x: Column, j: Column) -> Column:
                y = F.get(windows, j + 1)
                # equal upper bits leave a difference of positions only
                return F.coalesce(
                    (x.bitwiseXOR(y) <= mask)
                    & (x.bitwiseXOR(y) >= 0)
                    & (F.get(words, at(x)) == F.get(words, at(y)))
                    & (F.get(words, at(x) + 1) == F.get(words, at(y) + 1))
                    & (F.get(words, at(x) + 2) == F.get(words, at(y) + 2)),
                    F.lit(False),
                )

            twice = F.filter(
                F.transform(
                    windows,
                    lambda x, j: F.when(with_next(x, j), F.array(x, F.get(windows, j + 1))),
                ),
                lambda x: x.isNotNull(),
            )
            return F.sort_array(
                F.array_distinct(F.transform(F.flatten(twice), lambda x: x.bitwiseAND(mask)))
            )

        packed = F.transform(words, pack)
        return _let(F.sort_array(F.slice(packed, F.lit(1), F.size(words) - 2)), chosen)

    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        _let(low, positions),
        F.struct(F.lit(-3).cast("long").alias("last"), zero.alias("total")),
        lambda acc, x: F.struct(
            x.alias("last"),
            (acc["total"] + F.least(F.lit(3).cast("long"), x - acc["last"])).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    return F.when(F.size(words) > 3, covered).otherwise(zero)


def _stop_words(text: Column) -> Column:
    """Stop words, in any case, standing alone or before a punctuation mark."""
    pattern = (
        r"(?<![^\x20\x09-\x0D])(?i:"
        + "|".join(sorted(set(STOP_WORDS.split())))
        + r")(?![^\x20\x09-\x0D.,;:!?])"
    )
    return F.regexp_count(text, F.lit(pattern))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that rules refer to.

    The counts come out of a generator of one row, through which no filter is pushed: a filter on
    a count would otherwise compute it a second time.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)

    def long(value: Column, name: str) -> Column:
        return value.cast("long").alias(name)

    counts = F.struct(
        _let(
            words, lambda w: F.struct(long(F.size(w), "n"), long(_repeat_words(w), "repeat"))
        ).alias("w"),
        _let(
            lines,
            lambda x: F.struct(
                long(F.size(x), "n"), long(F.size(x) - F.size(F.array_distinct(x)), "dup")
            ),
        ).alias("l"),
        long(F.length(F.translate(text, SPACES, "")), "word_chars"),
        long(F.length(text) - F.length(F.translate(text, SYMBOLS, "")), "n_symbols"),
        long(_stop_words(text), "n_stop_words"),
    )
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*kept, F.inline(F.array(counts))).select(
        *kept,
        F.col("w.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_stop_words",
        F.col("l.n").alias("n_lines"),
        F.col("l.dup").alias("n_dup_lines"),
        F.col("w.repeat").alias("n_repeat_words"),
    )


def _all(rules: tuple[Rule, ...]) -> Column:
    fits = F.lit(True)
    for rule in rules:
        fits = fits & rule.holds()
    return fits


def assess(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Counts and verdicts per document, with the names of the broken rules."""
    broken = F.filter(
        F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in (*BASE_RULES, *rules)]),
        lambda x: x.isNotNull(),
    )
    slim = docs.select(F.col(id_col), F.col(text_col).alias("__text"))
    return measures(slim, "__text").select(
        id_col,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~_all(BASE_RULES)).alias("base_failed"),
        (_all(BASE_RULES) & _all(rules)).alias("kept"),
        "n_stop_words",
        "n_lines",
        broken.alias("broken"),
    )


def keep_good(
    docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The documents that keep every rule, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return (
        measures(docs.select(row, F.col(text_col).alias("__text")), "__text")
        .filter(_all(BASE_RULES) & _all(rules))
        .select("__row.*")
    )
