"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Patterns find assignments, access keys and hex digits. The tests look at every other long token
of a text. From its characters an encoding is inferred (hex, base32, base64, URL-safe base64);
its digits in that alphabet are then tested for uniformity (chi-squared), for the number of runs
above and below the middle, and for serial correlation. The three p-values are combined: the
score of a token is how strongly randomness is rejected.

A low score alone is no proof, and the more tokens a corpus has, the more low scores there are
by chance. Ordinary long words, letters of one case alone, show how often: of the words of the
same length class, the share with a score as low is the p-value of a token. A corpus may have few
such words or none, so a fixed reference stands beside them and weighs as much as 1/share of them:
the odds that a word made up from the frequencies of letters scores as low, at the lower end of the
class, where scores are lowest. Such odds are far smaller than what plain draws can show; they come
from draws that lean towards even letters, each counted by how likely a made-up word it is.

Paths, names of several words and other tokens whose characters keep to one kind for long, or that
have letters of one case only where an encoding has both, are no hypotheses: they are told by
their build, not by their score. The
Benjamini-Hochberg rule, applied to each length class over the whole corpus, sets the score up to
which tokens are reported so that the expected share of false ones stays below a bound. Only
counts per length class and score, a few thousand numbers at any size, come to the driver.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martloom.llm.common import staging, text_key

# The patterns. Letters of the first group may be of either case.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
RANDOM_KINDS = ("random_hex", "random_base32", "random_base64", "random_base64url")
_ORDER = {k: i for i, k in enumerate(BASE_KINDS + RANDOM_KINDS)}

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Lower ends of the length classes.
LENGTHS = (20, 22, 24, 26, 28, 30, 32, 36, 40, 44, 48, 56, 64, 80, 96)
# Mean stretch of characters of one kind (small letters, also after a capital; capitals; digits;
# marks) from which a token counts as built of words; random ones have 2.1 on average.
STRETCH = 3
BINS = 9
# Score steps per decade of the combined p-value, and the highest score kept apart.
STEPS, HIGHEST = 10, 300
FALSE_SHARE = 0.01
# Letters in 1000 of ordinary text, rounded from English, German, French and
# Spanish; how many words of each length class are made up from them, and the seed.
LETTERS = {
    "e": 151, "a": 87, "n": 77, "s": 73, "i": 74, "r": 66, "t": 67, "o": 61, "l": 47, "d": 45, "u": 46, "c": 34,
    "m": 28, "h": 32, "p": 23, "g": 19, "b": 16, "f": 14, "v": 13, "w": 11, "y": 9, "q": 6, "k": 7, "z": 6, "j": 4, "x": 3,
}
MADE_UP, MADE_UP_SEED = 600, 42
# How far draws of made-up words lean to even letters: as many words for each.
LEANINGS = (0.0, 0.25, 0.5, 0.75, 1.0)

_HEX = "0123456789abcdef"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ALPHABETS = {
    "random_hex": _HEX,
    "random_base32": _BASE32,
    "random_base64": _ALNUM + "+/",
    "random_base64url": _ALNUM + "-_",
}
_PLACES = {kind: {c: i for i, c in enumerate(letters)} for kind, letters in ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' matches that are long enough."""
    found = [
        (m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6
    ]
    found += [
        (m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20
    ]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[1]]))


def _kind_of(c: str) -> str:
    return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-"


def _one_case(word: str) -> bool:
    return word[1:].islower() or word.isupper()


def built(body: str) -> bool:
    """Whether a token in the base64 alphabets looks put together from words: letters of one case
    at most, or long stretches of one kind of character. About 1 random token in 20 of 20
    characters has such stretches, 1 in 40 of 40 characters: those are not found. Names put together
    from many short pieces and digits are not told by this and can be reported."""
    kinds = [_kind_of(c) for c in body]
    pairs = zip(kinds, kinds[1:], strict=False)
    stretches = 1 + sum(x != y and (x, y) != ("A", "a") for x, y in pairs)
    return not {"a", "A"} <= set(kinds) or len(body) >= STRETCH * stretches


def inferred(token: str) -> str | None:
    """The narrowest encoding whose alphabet holds the token, padding aside; None for words:
    letters that are all small, all capital, or small after one capital; and for tokens `built`
    of words."""
    body = token.rstrip("=")
    if body.isalpha() and _one_case(body):
        return None
    low = body.lower() if body.isupper() or not any(c.isupper() for c in body) else body
    for kind in RANDOM_KINDS:
        places = _PLACES[kind]
        if all(c in places for c in (low if kind == "random_hex" else body)):
            return None if kind in ("random_base64", "random_base64url") and built(body) else kind
    return None


def _two_sided(z: float) -> float:
    return max(math.erfc(abs(z) / math.sqrt(2)), 1e-15)


def uniformity(digits: list[int], size: int) -> float:
    """p-value of a chi-squared test over nine bins of the alphabet; eight degrees of freedom
    have a closed form."""
    expected, seen = [0.0] * BINS, [0] * BINS
    for d in range(size):
        expected[d * BINS // size] += len(digits) / size
    for d in digits:
        seen[d * BINS // size] += 1
    half = sum((s - e) ** 2 / e for s, e in zip(seen, expected, strict=True)) / 2
    return max(math.exp(-half) * (1 + half + half**2 / 2 + half**3 / 6), 1e-15)


def runs(digits: list[int], size: int) -> float:
    """p-value of the number of runs above and below the middle of the alphabet."""
    high = [2 * d >= size for d in digits]
    n, a = len(high), sum(high)
    b = n - a
    if not a or not b:
        return 1e-15
    count = 1 + sum(x != y for x, y in zip(high, high[1:], strict=False))
    mean = 2 * a * b / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((count - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial(digits: list[int]) -> float:
    """p-value of the correlation of each digit with the next."""
    n = len(digits)
    mean = sum(digits) / n
    spread = sum((d - mean) ** 2 for d in digits)
    if not spread:
        return 1e-15
    r = sum((x - mean) * (y - mean) for x, y in zip(digits, digits[1:], strict=False)) / spread
    return _two_sided(r * math.sqrt(n))


def score(token: str, kind: str) -> int:
    """How strongly the three tests reject randomness: steps of a tenth of a decade of their
    combined p-value (Fisher's method; six degrees of freedom)."""
    places = _PLACES[kind]
    text = token.rstrip("=")
    text = text.lower() if kind == "random_hex" else text
    digits = [places[c] for c in text if c in places]
    if len(digits) < 2:
        return HIGHEST
    size = len(places)
    x = -sum(map(math.log, (uniformity(digits, size), runs(digits, size), serial(digits))))
    decades = (x - math.log(1 + x + x * x / 2)) / math.log(10)
    return min(int(STEPS * max(decades, 0.0)), HIGHEST)


def length_class(size: int) -> int:
    return max((n for n in LENGTHS if n <= size), default=LENGTHS[0])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its base spans, and (kind, start, end, score) of other long tokens; those of
    plain words have no kind, only their length class (in start) and score."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    token = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.int32())])
    for batch in batches:
        bases, tokens = [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans = base_spans(text)
            bases.append([{"kind": k, "start": a, "end": b} for a, k, b in spans])
            found = []
            for m in TOKEN.finditer(text):
                a, b = m.span()
                if any(a < end and start < b for start, _, end in spans):
                    continue
                kind = inferred(m.group())
                rated = score(m.group(), kind or "random_base64")
                if kind:
                    found.append({"kind": kind, "start": a, "end": b, "score": rated})
                elif m.group().isalpha() and _one_case(m.group()):
                    found.append({"kind": None, "start": a, "end": b, "score": rated})
            tokens.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(bases, pa.list_(span)), pa.array(tokens, pa.list_(token))],
            ["doc_id", "text_key", "base", "tokens"],
        )


@lru_cache
def reference(size: int) -> tuple[float, ...]:
    """Odds that a made-up word of `size` letters scores at most each step, two standard errors
    added. Words are drawn from a mixture of the letters' frequencies and ever more even ones, and
    weighed by their odds under the frequencies over those under the mixture: at most as much as
    there are leanings, so that no single word decides."""
    draw = random.Random(MADE_UP_SEED)
    total = sum(LETTERS.values())
    letters, plain = list(LETTERS), [n / total for n in LETTERS.values()]
    logs = []
    for lean in LEANINGS:
        powers = [p ** (1 - lean) for p in plain]
        logs.append({c: math.log(p / sum(powers)) for c, p in zip(letters, powers, strict=True)})
    weights: list[list[float]] = [[] for _ in range(HIGHEST + 1)]
    for log in logs:
        odds = [math.exp(log[c]) for c in letters]
        for _ in range(MADE_UP):
            word = draw.choices(letters, odds, k=size)
            own = [sum(map(q.__getitem__, word)) for q in logs]
            mixed = sum(math.exp(x - own[0]) for x in own) / len(logs)
            weights[score("".join(word), "random_base64")].append(1 / mixed)
    drawn = MADE_UP * len(logs)
    shares, low, squares = [], 0.0, 0.0
    for step in weights:
        low += sum(step)
        squares += sum(w * w for w in step)
        shares.append(min((low + 2 * math.sqrt(squares)) / drawn, 1.0))
    return tuple(shares)


def thresholds(counts: list[tuple[int, bool, int, int]], share: float = FALSE_SHARE) -> dict[int, int]:
    """Highest reported score of each length class, -1 for none, from (length class, is word,
    score, count)."""
    words: dict[int, dict[int, int]] = {}
    tokens: dict[int, dict[int, int]] = {}
    for size, is_word, rated, count in counts:
        kept = (words if is_word else tokens).setdefault(size, {})
        kept[rated] = kept.get(rated, 0) + count
    found = {}
    weight = 1 / share
    for size, rated in tokens.items():
        null, made_up = words.get(size, {}), reference(size)
        total, nulls = sum(rated.values()), sum(null.values())
        seen = low = 0
        found[size] = -1
        for step in range(HIGHEST + 1):
            seen += rated.get(step, 0)
            low += null.get(step, 0)
            p = (low + weight * made_up[step]) / (nulls + weight)
            if rated.get(step) and p <= share * seen / total:
                found[size] = step
    return found


def _level(size: Column) -> Column:
    """`length_class` as a column."""
    level = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        level = F.when(size >= low, low).otherwise(level)
    return level


def scan(documents: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """(doc_id, text_key, base, spans) of every row, repeated rows too: arrays of (kind, start,
    end) in code points, end exclusive, by start and then kind. `base` are the patterns' matches,
    `spans` also the tokens that the tests report. Null text counts as empty."""
    store = staging(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind: string, start: int, end: int>>"
    tokens = "array<struct<kind: string, start: int, end: int, score: int>>"
    rows = documents.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    read = store.save(
        "read", rows.mapInArrow(_read, f"doc_id {kind}, text_key bigint, base {span}, tokens {tokens}")
    )
    token = read.select(F.explode("tokens").alias("t")).select("t.*")
    level = _level(F.col("end") - F.col("start"))
    counts = (
        token.groupBy(level.alias("size"), F.col("kind").isNull().alias("word"), "score")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    limits = thresholds([(r["size"], r["word"], r["score"], r["n"]) for r in counts], share)

    known = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]) if limits else None

    def reported(t):
        if known is None:
            return F.lit(False)
        limit = F.element_at(known, _level(t["end"] - t["start"]))
        return t["kind"].isNotNull() & F.coalesce(t["score"] <= limit, F.lit(False))

    def plain(t):
        return F.struct(t["kind"].alias("kind"), t["start"].alias("start"), t["end"].alias("end"))

    more = F.transform(F.filter("tokens", reported), plain)
    order = F.create_map(*[F.lit(x) for pair in _ORDER.items() for x in pair])

    def sortable(t):
        return F.struct(t["start"], order[t["kind"]].alias("o"), t["kind"].alias("kind"), t["end"].alias("end"))

    both = F.transform(F.array_sort(F.transform(F.concat("base", more), sortable)), plain)
    return read.select("doc_id", "text_key", "base", both.alias("spans"))
