"""Toxicity by a weighted finite-state grammar over clauses.

Tokens become symbols: insult, threat, target, negation, reported speech, other. A clause (cut at
sentence marks and line breaks) runs through five small transducers that are composed by running
them side by side: the insult and threat transducers emit the weight of a hit, the target
transducer marks a hit next to a person, the negation transducer marks one behind a negation
within three tokens, the report transducer marks a clause that reports or quotes. What they emit
together is one of a few patterns; a pattern's own weight is added to the weight of its word. The
clauses of a text are combined as independent evidence (noisy or).

All weights are learned from labelled rows: words, and beginnings of words for inflected or
compound forms, as smoothed log odds of documents that hold them; patterns likewise, drawn to a
prior that discounts negated and reported hits and raises aimed ones. At most
``MAX_LABELLED`` labelled rows, spread by a hash of the id, and at most ``MAX_TERMS`` terms are
kept, so the grammar has a bounded size and is sent to every task. Threat, target, negation and
report words are fixed lists that name no word as toxic by themselves.

Null and empty texts score the bias alone. Labels that are null are not used; of repeated labels
of an id the highest counts. Without usable labels, every text gets the prior score of no hit.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from rekindle.llm.common import written

THRESHOLD = 0.7
MAX_LABELLED = 60_000
MAX_TERMS = 20_000
#: Toxic training texts that must hold a term: at least so many, and this share of them.
LEAST = 3
LEAST_SHARE = 0.02
#: Lengths of word beginnings that are terms.
STEMS = (4, 5, 6, 7)
NEAR = 3
#: Score of a clause that has no hit.
PRIOR = 0.02

# Closed word classes of English, German, French and Spanish.
TARGETS = frozenset(
    "you your yours he him his she her they them their this that these those people "
    "du dich dir dein ihr euch euer er ihn sie ihnen diese "
    "tu te toi ton vous votre il elle lui ils elles leur ces "
    "tu usted ustedes vosotros el ella ellos ellas su sus estos".split()
)
NEGATIONS = frozenset(
    "not no never nobody neither nor isn't aren't wasn't don't doesn't cannot "
    "nicht kein keine keinen nie niemals pas jamais aucun aucune nunca ningún ninguna jamás".split()
)
REPORTS = frozenset(
    "said says say wrote writes quoted quotes quote called claimed claims reported "
    "sagte sagt schrieb schreibt zitiert nannte behauptet "
    "dit disait écrit écrivait cite appelait dijo dice escribió escribe cita llamó".split()
)
THREATS = frozenset(
    "kill murder hurt destroy beat shoot stab burn die töten umbringen schlagen sterben "
    "tuer frapper mourir brûler matar golpear morir quemar".split()
)

_CLAUSE = re.compile(r"[.!?;:\n]+")
_TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
PATTERNS = ("plain", "aimed", "negated", "reported", "negated reported")
#: Prior log odds of a pattern beside its word's own, worth this many documents.
PATTERN_PRIOR = {"plain": 0.0, "aimed": 0.5, "negated": -1.5, "reported": -1.5, "negated reported": -2.0}
PATTERN_WEIGHT = 20.0


def terms(token: str) -> list[str]:
    """The token and its beginnings, the latter marked by an asterisk."""
    return [token, *(token[:n] + "*" for n in STEMS if len(token) > n)]


@dataclass
class Grammar:
    """Weights of terms (log odds) and of patterns."""

    weights: dict[str, float] = field(default_factory=dict)
    patterns: dict[str, float] = field(default_factory=lambda: dict(PATTERN_PRIOR))

    def word(self, token: str) -> float:
        """Weight of the longest known form of the token, 0 if none is."""
        found = self.weights.get(token)
        if found is not None:
            return found
        for n in reversed(STEMS):
            if len(token) > n and (found := self.weights.get(token[:n] + "*")) is not None:
                return found
        return 0.0

    def clause(self, tokens: list[str], known: dict[str, float]) -> list[tuple[str, float]]:
        """Pattern and word weight of every hit."""
        hits = [(k, known[t]) for k, t in enumerate(tokens) if known[t] > 0]
        if not hits:
            return []
        reported = not REPORTS.isdisjoint(tokens)
        aimed = [k for k, t in enumerate(tokens) if t in TARGETS]
        threat = [k for k, t in enumerate(tokens) if t in THREATS]
        out = []
        for at, weight in hits:
            negated = not NEGATIONS.isdisjoint(tokens[max(0, at - NEAR) : at])
            near = any(abs(k - at) <= NEAR for k in aimed)
            if any(k != at and abs(k - at) <= NEAR for k in threat):
                weight += 0.5
            pattern = (
                "negated reported" if negated and reported
                else "negated" if negated
                else "reported" if reported
                else "aimed" if near
                else "plain"
            )
            out.append((pattern, weight))
        return out

    def matches(self, text: str | None) -> list[list[tuple[str, float]]]:
        """Hits of each clause that has any."""
        text = (text or "").lower()
        known = {t: self.word(t) for t in set(_TOKEN.findall(text))}
        if not any(w > 0 for w in known.values()):
            return []
        found = (self.clause(_TOKEN.findall(c), known) for c in _CLAUSE.split(text))
        return [hits for hits in found if hits]

    def score(self, text: str | None) -> float:
        clean = math.log1p(-PRIOR)
        for hits in self.matches(text):
            best = max(weight + self.patterns[pattern] for pattern, weight in hits)
            odds = best + math.log(PRIOR / (1 - PRIOR))
            clean -= math.log1p(math.exp(min(odds, 30.0)))
        return min(1.0, max(0.0, -math.expm1(clean)))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """Text and label of the training rows: at most about ``limit``, chosen by a hash of the id."""
    fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    usable = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & (fold != 1))
        .groupBy(id_col)
        .agg(F.max("toxic").alias("label"))
    )
    n = usable.count()
    share = min(1.0, limit / n) if n else 1.0
    part = F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity")), F.lit(1_000_000))
    few = usable.filter(part < int(share * 1_000_000)).select(F.col(id_col).alias("__id"), "label")
    # bounded by ``limit``, whatever the number of labels
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(few), F.col("id") == F.col("__id")
    )


@pandas_udf(LongType())
def _likeness(texts: pd.Series) -> pd.Series:
    """Smallest hash of two neighbouring words: mostly equal for near copies of a text.

    Near copies would otherwise count the rare words of one text as many times.
    """

    def least(text: str | None) -> int:
        words = (text or "").lower().encode("utf-8", "surrogatepass").split()
        pairs = zip(words, words[1:] or words, strict=False)
        return min((crc32(a + b" " + b) for a, b in pairs), default=-1)

    return texts.map(least)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = MAX_LABELLED,
) -> Grammar:
    """The grammar learned from labelled rows outside the held-out fold."""
    rows = _labelled(docs, labels, id_col, text_col, limit).withColumn("like", _likeness("text"))
    # of texts that look alike the smallest id counts, whatever the order of rows
    first = F.min_by("text", F.struct("id", F.xxhash64("text")))
    rows = written(rows.groupBy("like", "label").agg(first.alias("text")).select("text", "label"), "toxicity-training")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        positive, negative, totals = Counter(), Counter(), Counter()

        def out() -> pd.DataFrame:
            names = [*positive.keys() | negative.keys(), ""]
            frame = pd.DataFrame({"term": names})
            frame["toxic"] = [positive[t] for t in names[:-1]] + [totals[1]]
            frame["clean"] = [negative[t] for t in names[:-1]] + [totals[0]]
            return frame

        for part in parts:
            for text, label in zip(part["text"], part["label"], strict=True):
                tokens = set(_TOKEN.findall((text or "").lower()))
                (positive if label else negative).update({f for t in tokens for f in terms(t)})
                totals[1 if label else 0] += 1
            if len(positive) + len(negative) > 300_000:
                yield out()
                positive, negative, totals = Counter(), Counter(), Counter()
        yield out()

    counts = (
        rows.mapInPandas(count, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter((F.col("toxic") >= LEAST) | (F.col("term") == ""))
    )
    counts = written(counts, "toxicity-terms")
    total = counts.filter(F.col("term") == "").first()
    if not total or not total["toxic"] or not total["clean"]:
        return Grammar()
    ratio = ((F.col("toxic") + 0.5) / (total["toxic"] + 1.0)) / (
        (F.col("clean") + 0.5) / (total["clean"] + 1.0)
    )
    best = (
        counts.filter(F.col("term") != "")
        .withColumn("weight", F.log(ratio))
        .filter(F.col("weight") >= math.log(50.0))
        .orderBy(F.desc("toxic"), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    grammar = Grammar({r["term"]: r["weight"] for r in best})
    if not grammar.weights:
        return grammar
    shared = rows.sparkSession.sparkContext.broadcast((grammar.weights, grammar.patterns))

    def patterns(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        own = Grammar(*shared.value)
        for part in parts:
            for text, label in zip(part["text"], part["label"], strict=True):
                for name in {p for hits in own.matches(text) for p, _ in hits}:
                    seen[name, 1 if label else 0] += 1
        keys = list(seen)
        yield pd.DataFrame(
            {"pattern": [k[0] for k in keys], "label": [k[1] for k in keys], "n": [seen[k] for k in keys]}
        )

    found = Counter()
    for r in (
        rows.mapInPandas(patterns, "pattern string, label int, n long")
        .groupBy("pattern", "label")
        .agg(F.sum("n").alias("n"))
        .collect()  # two rows per pattern
    ):
        found[r["pattern"], r["label"]] = r["n"]
    base = math.log((total["toxic"] + 1.0) / (total["clean"] + 1.0))
    usual = math.log((found["plain", 1] + 1.0) / (found["plain", 0] + 1.0)) - base
    for name, prior in PATTERN_PRIOR.items():
        n = found[name, 1] + found[name, 0]
        own = math.log((found[name, 1] + 1.0) / (found[name, 0] + 1.0)) - base - usual
        share = n / (n + PATTERN_WEIGHT)
        # a pattern seen only in few documents keeps its prior
        grammar.patterns[name] = (1 - share) * prior + share * max(-6.0, min(1.0, own))
    return grammar


def score_column(spark, grammar: Grammar, text: Column) -> Column:
    shared = spark.sparkContext.broadcast((grammar.weights, grammar.patterns))

    @pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Grammar(*shared.value)
        for texts in parts:
            yield pd.Series([own.score(t) for t in texts], dtype="float64")

    return scores(text)


def assess(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` of every document."""
    grammar = fit(docs, labels, id_col, text_col)
    held = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1
    return docs.select(
        F.col(id_col),
        F.coalesce(held, F.lit(False)).alias("held_out"),
        score_column(docs.sparkSession, grammar, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents below the threshold, with all their columns."""
    grammar = fit(docs, labels, id_col, text_col)
    score = score_column(docs.sparkSession, grammar, F.col(text_col))
    return docs.filter(score < THRESHOLD)
