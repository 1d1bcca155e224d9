"""Toxicity by a weighted finite-state pattern grammar.

Four small transducers read the words of a clause. The first writes, for each word, its class:
an insult or a threat with a weight, a target (a person addressed or named), a negation, a word
of reported speech, or none. The others each keep one thing in mind while they read: whether a
negation, a target or reported speech stands shortly before. They are composed into one machine,
whose output for a matched word is its class and the contexts that hold there, so "you are an
idiot" and "he never called anyone an idiot" are different outputs. A clause's score for each
output is the sum of its matched words' weights; clauses without a match score nothing.

Function words are fixed. What counts as an insult, and how far a context raises or lowers a
score, is learned from labels: words, and beginnings of words, that stand in toxic documents
far more often than in others, and a logistic model over the clause scores. Both are fitted on a
bounded sample; language, source and id are never looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm.common import held_out, labelled_sample

SAMPLE_ROWS = 20_000
# Most words and beginnings of words that a lexicon holds.
LEXICON_ENTRIES = 4_000
PREFIXES = (4, 5, 6, 7)

# Function words of the grammar in English, German, French and Spanish.
NEGATIONS = """not no never neither nor without isn't aren't wasn't don't doesn't
nicht kein keine keinen niemals ohne pas jamais aucun sans nunca jamás sin tampoco""".split()
REPORTS = """said says say called calls claimed wrote quoted reported alleged
sagte sagt nannte behauptete schrieb dit disait appelé écrit prétend
dijo dice llamó escribió afirmó""".split()
TARGETS = """you your you're he she they him her them his their people everyone
du dich dir euch sie er ihr tu toi vous ton votre il elle ils tú usted ustedes él ella ellos""".split()
THREATS = """kill hurt murder destroy stab shoot beat strangle
töten umbringen schlagen vernichten tuer frapper détruire matar golpear destruir""".split()

OTHER, TARGET, NEGATION, REPORT, THREAT, INSULT = range(6)
# Words within which a context holds.
REACH = {TARGET: 5, NEGATION: 3, REPORT: 8}

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer over word classes: after[state][class] and, for the class it
    reads, out[state] — whether its context holds."""

    after: tuple[tuple[int, ...], ...]
    out: tuple[int, ...]


def context(word_class: int, reach: int) -> Transducer:
    """Holds for `reach` words after a word of the class. State n: n more words to go."""
    after = tuple(
        tuple(reach if c == word_class else max(n - 1, 0) for c in range(INSULT + 1))
        for n in range(reach + 1)
    )
    return Transducer(after, tuple(int(n > 0) for n in range(reach + 1)))


def compose(parts: list[Transducer]) -> tuple[np.ndarray, np.ndarray]:
    """One machine that runs all parts at once: after[state, class], and out[state], the parts'
    outputs as bits."""
    sizes = [len(p.after) for p in parts]
    states = list(product(*map(range, sizes)))
    number = {s: i for i, s in enumerate(states)}
    after = np.array(
        [
            [number[tuple(p.after[q][c] for p, q in zip(parts, s, strict=True))] for c in range(INSULT + 1)]
            for s in states
        ]
    )
    out = np.array([sum(p.out[q] << i for i, (p, q) in enumerate(zip(parts, s, strict=True))) for s in states])
    return after, out


CONTEXTS = (TARGET, NEGATION, REPORT)
AFTER, OUT = compose([context(c, REACH[c]) for c in CONTEXTS])
_AFTER, _OUT = AFTER.tolist(), OUT.tolist()
# Scores of a document: per kind of match and context, then of its strongest clause, and the
# share of matched words.
OUTPUTS = 2 * (1 << len(CONTEXTS))
FEATURES = OUTPUTS + 3


@dataclass
class Grammar:
    """Weights of words (whole or beginnings, longest first) and of the final model."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    coefficients: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    constant: float = -3.0

    def word(self, token: str) -> tuple[int, float]:
        """Class and weight of a lower-case word."""
        if token in self.words:
            return INSULT, self.words[token]
        for kind, known in _FUNCTION.items():
            if token in known:
                return kind, 1.0
        for size in reversed(PREFIXES):
            if len(token) > size and token[:size] in self.prefixes:
                return INSULT, self.prefixes[token[:size]]
        return OTHER, 0.0


_FUNCTION = {
    NEGATION: frozenset(NEGATIONS),
    REPORT: frozenset(REPORTS),
    TARGET: frozenset(TARGETS),
    THREAT: frozenset(THREATS),
}
_CLAUSE_END = (-1, 0.0)


class Reader:
    """Reads texts with a grammar; remembers the classes of words it has met."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar
        self.classes = _Classes(grammar)
        self.coefficients = np.array(grammar.coefficients)

    def features(self, text: str | None) -> np.ndarray:
        """Scores of the matched clauses of a text; zeros if none matches or there is no text."""
        found = np.zeros(FEATURES)
        tokens = _TOKEN.findall(text.lower()) if text else []
        read = list(map(self.classes.__getitem__, tokens))
        if not any(c >= THREAT for c, _ in read):
            return found
        state, clause, strongest, matches = 0, 0.0, 0.0, 0
        for c, weight in read:
            if c < 0:
                strongest, clause, state = max(strongest, clause), 0.0, 0
                continue
            if c >= THREAT:
                found[2 * _OUT[state] + (c == INSULT)] += weight
                clause += weight
                matches += 1
            state = _AFTER[state][c]
        found[:OUTPUTS] = np.log1p(found[:OUTPUTS])
        found[OUTPUTS:] = max(strongest, clause), np.log1p(matches), 100 * matches / len(read)
        return found

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ self.coefficients + self.grammar.constant)))


class _Classes(dict):
    """Classes of words, worked out once; emptied when it is full."""

    def __init__(self, grammar: Grammar) -> None:
        self.grammar = grammar

    def __missing__(self, token: str) -> tuple[int, float]:
        found = _CLAUSE_END if token[0] in ".!?;:\n" else self.grammar.word(token)
        if len(self) >= 300_000:
            self.clear()
        if len(token) <= 40:
            self[token] = found
        return found


def _document_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, whole, toxic) once per document, for its words and their beginnings."""
    for batch in batches:
        terms: list[str] = []
        whole: list[bool] = []
        toxic: list[int] = []
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            words = {t for t in _TOKEN.findall(text.lower()) if t[0].isalpha()} if text else set()
            starts = {w[:n] for w in words for n in PREFIXES if len(w) > n}
            terms += [*words, *starts]
            whole += [True] * len(words) + [False] * len(starts)
            toxic += [label] * (len(words) + len(starts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array(whole, pa.bool_()), pa.array(toxic, pa.int64())],
            ["term", "whole", "toxic"],
        )


def _lexicon(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and beginnings whose odds of a toxic document are high beyond chance. The weight is
    the lower bound of the log odds ratio, one standard error below."""
    terms = sample.select("text", "label").mapInArrow(
        _document_terms, "term string, whole boolean, toxic bigint"
    )
    sums = [F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("all")]
    total = sample.select("label").agg(*sums).first()
    positives, negatives = total["toxic"] or 0, total["all"] - (total["toxic"] or 0)
    if not positives or not negatives:
        return {}, {}
    counts = terms.groupBy("term", "whole").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    a, b = F.col("a") + 0.5, F.col("n") - F.col("a") + 0.5
    c, d = positives - F.col("a") + 0.5, negatives - (F.col("n") - F.col("a")) + 0.5
    odds = F.log(a * d / (b * c))
    weight = odds - F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    rows = (
        counts.filter(F.col("a") >= 2)
        .withColumn("weight", weight)
        .filter((F.col("weight") > 1.5) & (F.col("a") > F.col("n") * 0.6))
        .orderBy(F.desc("weight"), "term", "whole")
        .limit(LEXICON_ENTRIES)
        .collect()
    )
    words = {r["term"]: r["weight"] for r in rows if r["whole"]}
    return words, {r["term"]: r["weight"] for r in rows if not r["whole"]}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, steps: int = 40) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _feature_rows(shared):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = [reader.features(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "label", "features"],
            )

    return of_batches


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Grammar:
    """A grammar learned from `labels.toxic`, from at most `sample_rows` labelled rows outside
    the held-out fold; without labels of both kinds, one that matches threats only and rates
    everything low.

    The words are learned on one half of the sample and the model on the other: a word that
    only its own documents made look toxic does not count there.
    """
    sample = labelled_sample(documents, labels, "toxic", sample_rows)
    half = F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string")).cast("binary")) % 2
    words, prefixes = _lexicon(sample.filter(half == 0))
    grammar = Grammar(words, prefixes)
    shared = documents.sparkSession.sparkContext.broadcast(grammar)
    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = (
        sample.filter(half == 1)
        .select("doc_id", "label", "text")
        .mapInArrow(_feature_rows(shared), f"doc_id {kind}, label int, features array<double>")
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["features"]))
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) == 2:
        coefficients, grammar.constant = _logistic(np.array([r["features"] for r in rows]), y)
        grammar.coefficients = coefficients.tolist()
    grammar.words, grammar.prefixes = _merged((words, prefixes), _lexicon(sample))
    return grammar


def _merged(*found: tuple[dict[str, float], dict[str, float]]) -> tuple[dict[str, float], dict[str, float]]:
    """The lexicon of the whole sample, on the scale of the half that the model was fitted to."""
    half, whole = found
    both = [(half[0][w], whole[0][w]) for w in half[0].keys() & whole[0].keys()]
    scale = float(np.median([a / b for a, b in both])) if both else 1.0
    return {w: x * scale for w, x in whole[0].items()}, {w: x * scale for w, x in whole[1].items()}


def scored(documents: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_matches) of every row, repeated rows too. A null
    or empty text gets the score of a text without a match; a null id is not held out."""
    shared = documents.sparkSession.sparkContext.broadcast(grammar)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            found = [reader.features(t) for t in batch.column("text").to_pylist()]
            found = np.array(found).reshape(-1, FEATURES)
            matches = np.rint(np.expm1(found[:, OUTPUTS + 1])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(reader.scores(found)), pa.array(matches)],
                ["doc_id", "score", "n_matches"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", "text").mapInArrow(
        of_batches, f"doc_id {kind}, score double, n_matches bigint"
    )
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_matches",
    )


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels, then score every document."""
    return scored(documents, fit(documents, labels))
