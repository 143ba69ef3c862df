"""The quality and language classifiers against plain versions of their formulas."""

import math
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from fernhill.llm import language_svm, quality_qda

TEXTS = ["Hello World, this is it. It is 12 of 3!\nA line | a line\nA line | a line\n", "", "one", "  \n\n ", "a a a a a a a a b", "# Title #\n42 !!! 99\n# Title #\n",
         "The quick brown fox jumps over the lazy dog and the quick brown fox jumps over it", "x" * 300, "A.B.C. 1+1=2 <tag> {json: [1, 2]}"]


def plain_statistics(text):
    """Eleven of the statistics, for ASCII texts, by their names."""
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n")
    if lines and lines[-1] == "":
        lines = lines[:-1]
    shingles = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    solid = sum(not re.match(r"[\x20\x09-\x0D]", c) for c in text)
    letters = sum(c.isalpha() for c in text)
    share = lambda part, whole: math.log((part + 0.5) / (max(whole - part, 0) + 0.5))
    most = lambda items: max(Counter(items).values(), default=0)
    return {0: math.log1p(len(text)), 1: math.log1p(len(words)), 2: math.log1p(solid / max(1, len(words))), 5: share(sum(c.isupper() for c in text), letters),
            6: share(sum(c.isdigit() for c in text), solid), 9: share(0, solid), 10: share(len(text) - solid, len(text)), 11: share(letters, solid),
            12: share(len(set(words)), len(words)), 13: share(most(words), len(words)), 14: share(len(set(shingles)), len(shingles))}


def test_statistics_against_plain_ones(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r.x for r in quality_qda.document_statistics(docs).collect()}
    for n, text in enumerate(TEXTS):
        for at, value in plain_statistics(text).items():
            assert got[n][at] == pytest.approx(value, abs=1e-9), (n, at)


def test_fit_and_score_against_the_formulas(spark):
    """Means, covariances, shrinkage, prior and log-density difference by definition."""
    rng = np.random.default_rng(5)
    width, params = quality_qda.N_STATISTICS, quality_qda.QualityParams()
    x = {k: rng.normal(size=(60 + 30 * k, width)) * (1 + k) + k for k in (0, 1)}
    rows = [(v.tolist(), k) for k in (0, 1) for v in x[k]]
    model = quality_qda.fit(spark.createDataFrame(rows, "x array<double>, label int").repartition(3), params)
    n = {k: len(x[k]) for k in x}
    cov = {k: np.cov(x[k].T, bias=True) for k in x}
    pooled = np.diag((cov[0] * n[0] + cov[1] * n[1]).diagonal() / (n[0] + n[1])) + params.ridge * np.eye(width)
    logs = {}
    tests = rng.normal(size=(7, width))
    for k in x:
        own = (1 - params.shrinkage) * cov[k] + params.shrinkage * pooled
        d = tests - x[k].mean(axis=0)
        logs[k] = np.array([-0.5 * v @ np.linalg.inv(own) @ v - 0.5 * np.linalg.slogdet(own)[1] + math.log(n[k] / (n[0] + n[1])) for v in d])
    want = 1 / (1 + np.exp(-(logs[1] - logs[0]) / params.temperature))
    assert np.allclose(model.score(tests), want, rtol=1e-8, atol=1e-12)


def test_svm_is_the_minimum_of_its_objective():
    """Squared hinge loss, classes weighing alike: no direction improves it, and plain gradient descent ends in it."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(40, 3)) + 1, rng.normal(size=(15, 3)) - 1]).astype(np.float32)
    y = np.r_[np.ones(40), -np.ones(15)]
    penalty, full = 0.05, np.c_[x, np.ones(55)].astype(float)
    weight = np.where(y > 0, 0.5 / 40, 0.5 / 15)

    def objective(w):
        return 0.5 * penalty * w @ w + 0.5 * (weight * np.maximum(0, 1 - y * (full @ w)) ** 2).sum()

    w = language_svm.train_svm(x, y, penalty)
    for _ in range(200):
        assert objective(w) <= objective(w + rng.normal(size=4) * 1e-3) + 1e-12
    v = np.zeros(4)
    for _ in range(20000):
        margin = np.maximum(0, 1 - y * (full @ v))
        v -= 0.05 * (penalty * v - full.T @ (weight * y * margin))
    assert np.allclose(w, v, atol=1e-4)


def test_prediction_goes_by_family_and_then_by_pairs():
    rng = np.random.default_rng(8)
    languages = ("de", "en", "es", "fr")
    families = sorted({language_svm.family_of(x) for x in languages})
    names = [*combinations(families, 2), *(p for p in combinations(languages, 2) if language_svm.family_of(p[0]) == language_svm.family_of(p[1]))]
    machines = {p: rng.normal(size=6) for p in names}
    model = language_svm.LanguageModel(languages, machines)
    x = rng.normal(size=(50, 5))

    def chances(v, own):
        total = dict.fromkeys(own, 0.0)
        for a, b in combinations(own, 2):
            w = machines[a, b]
            p = 1 / (1 + math.exp(-model.sharpness * (float(v @ w[:-1]) + w[-1])))
            total[a] += p
            total[b] += 1 - p
        return {k: t / max(1, len(own) - 1) if len(own) > 1 else 1.0 for k, t in total.items()}

    got, score = model.predict(x)
    for n, v in enumerate(x):
        by_family = chances(v, families)
        family = max(families, key=lambda f: by_family[f])
        members = [m for m in languages if language_svm.family_of(m) == family]
        inside = chances(v, members)
        best = max(members, key=lambda m: inside[m])
        assert got[n] == best and score[n] == pytest.approx(by_family[family] * inside[best])
