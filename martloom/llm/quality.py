"""Quality rules: text statistics and decision lists learned from labels.

The statistics are plain column expressions over one row: nothing is exploded or shuffled, so
a document of any size is measured where it is read. A decision list is an ordered list of
rules, each a conjunction of thresholds on ratios of the statistics; the first rule that holds
rejects the document. Rules are grown and pruned by sequential covering on a bounded sample of
labelled rows, and applied as one conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm.common import ASCII_SPACE, labelled_sample, split_words

WINDOW = 5
# Most labelled rows that a fit looks at.
SAMPLE_ROWS = 20_000


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def with_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and
    n_capitals (all long) appended; a column of the same name is replaced.

    Null text counts as empty: all zero. Words are `[^\\x20\\x09-\\x0D]+`; n_repeat_words counts
    the words that lie in a window of five words found twice or more in the text.
    """
    names = [n for n in documents.columns if n not in STATISTICS]
    value = F.coalesce(F.col(text), F.lit(""))
    one = documents.select(*names, value.alias("_text"), split_words(F.col(text)).alias("_words"))
    words = F.col("_words")
    size = F.size(words)
    window = F.transform(
        F.slice(words, 1, F.greatest(size - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)]),
    )
    with_line = F.filter(
        F.split(F.col("_text"), "\n"), lambda line: line.rlike(f"[^{ASCII_SPACE}]")
    )
    two = one.select(*names, "_text", "_words", window.alias("_windows"), with_line.alias("_lines"))
    windows = F.col("_windows")
    # most texts repeat no window: only the others are sorted
    ordered = F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    three = two.select(
        *names,
        size.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _count(F.col("_text"), r"[#*$%&|<>]").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _count(F.col("_text"), r"\p{Lu}").alias("n_capitals"),
        ordered.alias("_ordered"),
    )
    ordered = F.col("_ordered")
    twice = F.filter(
        ordered,
        lambda e, k: (e["h"] == F.get(ordered, k - 1)["h"]) | (e["h"] == F.get(ordered, k + 1)["h"]),
    )
    starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
    four = three.select(*names, *[s for s in STATISTICS if s != "n_repeat_words"], starts.alias("_starts"))
    starts = F.col("_starts")
    # a window covers five words, or as many as lie before the next one
    covered = F.transform(
        starts,
        lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))),
    )
    repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    measured = [repeat.alias(s) if s == "n_repeat_words" else F.col(s) for s in STATISTICS]
    # out of a generator, so that no later filter is pushed below the statistics: the optimizer
    # would compute the windows of a text once for each of its words
    row = F.struct(*[F.col(f"`{n}`") for n in names], *measured)
    return four.select(F.inline(F.array(row)))


STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals",
)


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them repeated."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def ratios() -> dict[str, Column]:
    """What rules may test; each is defined for a text without words, too."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "duplicate_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "capital_share": F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    """A ratio above a threshold, or not above it."""

    ratio: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = ratios()[self.ratio]
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class ListSettings:
    """Bounds of a fit. A rule is kept if, on rows it was not grown on, at least `precision`
    of what it rejects is labelled bad (counting one error more than was seen)."""

    sample_rows: int = SAMPLE_ROWS
    thresholds: int = 48
    conditions: int = 3
    rules: int = 12
    least_rows: int = 4
    precision: float = 0.9


def _holds(values: np.ndarray, names: list[str], rule: Rule) -> np.ndarray:
    held = np.ones(len(values), bool)
    for c in rule:
        column = values[:, names.index(c.ratio)]
        held &= column > c.threshold if c.above else column <= c.threshold
    return held


def _cuts(column: np.ndarray, count: int) -> np.ndarray:
    """Midpoints between neighbouring quantiles."""
    levels = np.unique(np.quantile(column, np.linspace(0, 1, count)))
    return (levels[1:] + levels[:-1]) / 2


def _grow(values: np.ndarray, bad: np.ndarray, names: list[str], settings: ListSettings) -> Rule:
    """Add the condition with the highest information gain until no good row is left."""
    rule: list[Condition] = []
    inside = np.ones(len(values), bool)
    while len(rule) < settings.conditions and (~bad[inside]).any():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, best_gain = None, 1e-9
        for number, name in enumerate(names):
            column = values[inside, number]
            for cut in _cuts(column, settings.thresholds):
                over = column > cut
                for above in (True, False):
                    held = over if above else ~over
                    p1 = (bad[inside] & held).sum()
                    if not p1:
                        continue
                    n1 = held.sum() - p1
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p0 / (p0 + n0)))
                    if gain > best_gain:
                        best, best_gain = Condition(name, above, float(cut)), gain
        if best is None:
            break
        rule.append(best)
        inside &= _holds(values, names, (best,))
    return tuple(rule)


def learn(values: np.ndarray, bad: np.ndarray, names: list[str], settings: ListSettings) -> list[Rule]:
    """Rules in order. Two of three rows grow a rule, the third prunes it: of its beginnings,
    the one that best separates bad from good is taken, the shorter of equal ones."""
    rules: list[Rule] = []
    third = np.arange(len(values)) % 3 == 2
    left = np.ones(len(values), bool)
    while len(rules) < settings.rules:
        grow, prune = left & ~third, left & third
        if bad[grow].sum() < settings.least_rows:
            break
        rule = _grow(values[grow], bad[grow], names, settings)
        scored = []
        for length in range(1, len(rule) + 1):
            held = prune & _holds(values, names, rule[:length])
            p, n = (held & bad).sum(), (held & ~bad).sum()
            scored.append(((p - n) / (p + n) if p + n else -1.0, -length, p, n))
        if not scored:
            break
        _, length, p, n = max(scored)
        if p + n == 0 or p < settings.precision * (p + n + 1):
            break
        rule = rule[:-length]
        rules.append(rule)
        left &= ~_holds(values, names, rule)
    return rules


def fit(documents: DataFrame, labels: DataFrame, settings: ListSettings = ListSettings()) -> list[Rule]:
    """A decision list from `labels.quality` (0: bad), for documents that the fixed rules pass.

    At most `sample_rows` labelled rows, outside the held-out fold, come to the driver as a few
    numbers each. No labels give an empty list, which rejects nothing.
    """
    sample = labelled_sample(documents, labels, "quality", settings.sample_rows)
    names = list(ratios())
    collected = (
        with_statistics(sample)
        .select("doc_id", "label", base_failed().alias("failed"), *[c.alias(f"_{n}") for n, c in ratios().items()])
        .collect()
    )
    rows = sorted((r for r in collected if not r["failed"]), key=tuple)
    if not rows:
        return []
    values = np.array([[r[f"_{n}"] for n in names] for r in rows], float)
    return learn(values, np.array([r["label"] == 0 for r in rows]), names, settings)


def verdict(rules: list[Rule]) -> Column:
    """Number, from 1, of the first rule that rejects; 0 if none does."""
    chosen = F.lit(0)
    for number in range(len(rules), 0, -1):
        held = F.lit(True)
        for condition in rules[number - 1]:
            held = held & condition.column()
        chosen = F.when(held, number).otherwise(chosen)
    return chosen


def judged(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """`documents` with their statistics, base_failed, rule (number of the rejecting one, or 0)
    and kept. Rows are not merged: repeated ones are judged alike."""
    measured = with_statistics(documents)
    names = [n for n in measured.columns if n not in ("base_failed", "rule", "kept")]
    found = measured.select(*names, base_failed().alias("base_failed"), verdict(rules).alias("rule"))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the fixed rules and the learned list keep, columns unchanged."""
    rules = fit(documents, labels)
    row = F.struct(*[documents[c] for c in documents.columns])
    found = judged(documents.select(row.alias("_row"), "text"), rules)
    return found.filter("kept").select("_row.*")
