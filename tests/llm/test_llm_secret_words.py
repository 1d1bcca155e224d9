"""Random tokens in tables with few or no long words."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
from test_llm_operators import DOCS

from martloom.llm import secret_scan


def test_one_random_token_is_found_with_few_or_no_long_words(spark):
    secret = "kX9vQz2LmT7pWc4RbY8nHs3JdF6gUa1EoKtZ5iVq"
    for words in (0, 1, 98, 150):
        docs = [(0, f"the key {secret} end"), (1, "some-lower-case/path/of-a-page/in-the-docs x")]
        docs += [(i, "internationalization") for i in range(2, 2 + words)]
        docs += [(1000 + i, "donaudampfschifffahrtsgesellschaft") for i in range(words)]
        found = secret_scan.scan(spark.createDataFrame(docs, DOCS)).collect()
        spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in found}
        assert {i: s for i, s in spans.items() if s} == {0: [(8, 48)]}, words


def word(rng, size):
    return "".join(rng.choices(list(secret_scan.LETTERS), list(secret_scan.LETTERS.values()), k=size))


def test_random_tokens_among_many_others(spark):
    """Ten random tokens of 40 characters among 10,000 paths, names of several words and words."""
    rng = random.Random(5)
    letters = secret_scan.ALPHABETS["random_base64"]
    secrets = {i: "".join(rng.choice(letters) for _ in range(40)) for i in range(10)}
    docs = [(i, f"a {s} b") for i, s in secrets.items()]
    for i in range(10_000):
        parts = [word(rng, rng.randint(3, 8)) for _ in range(16)]
        other = ("/".join(parts), "".join(p.capitalize() for p in parts), "".join(parts))[i % 3]
        docs.append((100 + i, f"a {other[:40]} b"))
    found = secret_scan.scan(spark.createDataFrame(docs, DOCS)).filter("size(spans) > 0").collect()
    reported = {r["doc_id"] for r in found}
    assert len(reported & secrets.keys()) >= 9 and len(reported - secrets.keys()) <= 1


def test_reference_is_what_plain_draws_show():
    rng = random.Random(6)
    for size in (20, 32):
        rated = sorted(secret_scan.score(word(rng, size), "random_base64") for _ in range(4000))
        odds = secret_scan.reference(size)
        assert all(a <= b for a, b in zip(odds, odds[1:], strict=False))
        for share in (0.02, 0.1, 0.5):
            step = rated[int(share * len(rated))]
            seen = sum(x <= step for x in rated) / len(rated)
            assert 0.7 * seen < odds[step] < 1.4 * seen + 0.01


def test_tests_of_randomness_against_slow_versions():
    rng = random.Random(7)
    for _ in range(50):
        size = rng.choice((16, 32, 64))
        digits = [rng.randrange(size) for _ in range(rng.randint(20, 90))]
        bins = np.bincount([d * 9 // size for d in digits], minlength=9)
        expected = np.bincount(np.arange(size) * 9 // size, minlength=9) * len(digits) / size
        chi = float(((bins - expected) ** 2 / expected).sum())
        at = np.linspace(chi, chi + 400, 400_001)
        density = at**3 * np.exp(-at / 2) / (2**4 * math.factorial(3))
        assert abs(np.trapezoid(density, at) - secret_scan.uniformity(digits, size)) < 1e-6
        x = np.array(digits, float) - np.mean(digits)
        r = (x[1:] * x[:-1]).sum() / (x * x).sum()
        assert abs(math.erfc(abs(r) * math.sqrt(len(x) / 2)) - secret_scan.serial(digits)) < 1e-9
        high = [2 * d >= size for d in digits]
        a, n = sum(high), len(high)
        count = len(list(itertools.groupby(high)))
        mean = 2 * a * (n - a) / n + 1
        spread = math.sqrt((mean - 1) * (mean - 2) / (n - 1))
        assert abs(math.erfc(abs(count - mean) / spread / math.sqrt(2)) - secret_scan.runs(digits, size)) < 1e-9
