"""Spelling variants, centroid clusters and the interpolated language model against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fernhill.llm import centroids, interpolated_lm, spelling
from fernhill.llm.common import held_out
from tests.llm.conftest import odd_rows

RUN = re.compile("[A-Za-zÀ-ÿ]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ spelling variants


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def words_of(rows, shortest=5, least=3):
    n = Counter()
    for i, text in rows:
        for w in RUN.findall(text or ""):
            w = w.translate(UPPER)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def forms_of(words):
    near = defaultdict(list)
    for a, b in combinations(sorted(words), 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 2 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        f = form.get(w)
        out.append((w, f, root, words[w], len(near[w]), words.get(f)))
    return sorted(out)


def spelled(df, **params):
    got = spelling.spelling_groups(df, spelling.SpellingParams(**params))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in got.collect())


def variant_rows(seed=2):
    """Words of few letters, so that signatures are crowded, with anagrams, chains and accents."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcé"), rng.integers(5, 8))) for _ in range(400)] + ["spelling", "speling", "spellingg", "spelling's", "SPELLING", "Éclair", "éclair"]
    chain = [(500 + d, " ".join(["chainword"] * 9 + ["chainwor"] * 3 + ["chainwo"])) for d in range(9)]
    return [(d if d % 7 else None, " ".join(str(w) for w in rng.choice(words, 150) if w)) for d in range(120)] + chain


@pytest.mark.parametrize("params", [{}, {"split_above": 3}, {"outer": 2, "inner": 3}, {"outer": 3, "inner": 1}])
def test_spelling_groups(spark, params):
    rows = variant_rows()
    got = spelled(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **params)
    want = forms_of(words_of(rows))
    assert got == want and len(got) > 300
    # some chains have several steps
    form = {r[0]: r[1] for r in want}
    assert any(form.get(f) for f in form.values())


def test_spelling_odd_rows(spark, odd, none, monkeypatch):
    rows = [(r[0], r[1]) for r in odd_rows()]
    assert spelled(odd) == forms_of(words_of(rows))
    assert spelled(none) == []
    gap = re.compile("[^a-zÀ-ÿ]")
    monkeypatch.setattr(spelling, "PART", 7)
    for text in ("", "abc def", "abcdefghijklmnopqrstu", "  ab cdefghij k lmnopqrstuvwxyz  "):
        parts = list(spelling._parts(text, gap))
        assert "".join(parts) == text and [w for p in parts for w in RUN.findall(p)] == RUN.findall(text)


def test_partenum_signatures_lose_no_pair():
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgß"), rng.integers(1, 9))) for _ in range(300)]
    vector = [{(c, k) for c in set(w) for k in range(w.count(c))} for w in words]
    for outer, inner in ((1, 4), (1, 6), (2, 4), (3, 1)):
        found = spelling.signatures(words, outer, inner)
        for a, b in combinations(range(len(words)), 2):
            if len(vector[a] ^ vector[b]) <= 2:
                assert (found[a] == found[b]).any()
    # different vectors far apart rarely agree
    assert not (spelling.signatures(["abcdefgh", "ijklmnop"])[0] == spelling.signatures(["abcdefgh", "ijklmnop"])[1]).any()


def test_halves_meet_for_every_near_pair(spark):
    words = sorted({w for r in variant_rows(3)[:30] for w in r[1].split()})
    df = spark.createDataFrame([(w,) for w in words], "word string").select("word", F.explode(spelling._halves(F.col("word"))).alias("h"))
    keys = defaultdict(set)
    for r in df.collect():
        keys[r.word].add(tuple(r.h))
    for a, b in combinations(words, 2):
        if one_edit(a, b):
            assert keys[a] & keys[b], (a, b)


# ------------------------------------------------------------------ centroid clusters


def clustered(vectors, k, rounds, width, scale):
    usable = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in usable if i is not None)[:k]
    cents = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in usable:
            own[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(own[n]) for x in zip(*own[n])] if own[n] else c for n, c in enumerate(cents)]
    told = [(i, *nearest(v)) for i, v in usable]
    total = Counter()
    for _, d, n in told:
        total[n] += d
    return sorted(((i, n, d, total[n], sum(total.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()) for i, d, n in told), key=str)


def odd_vectors(width=6):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=width) + 3 * (i % 5)).tolist()) for i in range(600)]
    rows += [(600, None), (601, [1.0, None] * (width // 2)), (602, [float("nan")] * width), (603, [float("inf")] * width), (604, []), (605, [0.5]), (None, [0.1] * width)]
    rows += [(700 + i, [0.25] * width) for i in range(40)] + [(7, rows[7][1]), (7, [9.5] * width), (8, [1e6] * width), (9, [-1e6] * width)]
    return rows


@pytest.mark.parametrize("k,pivots", [(16, 8), (16, 1), (5, 5), (700, 8)])
def test_clusters(spark, k, pivots):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, cluster string, v int").repartition(5)
    got = centroids.cluster_report(df, centroids.ClusterParams(clusters=k, width=6, pivots=pivots))
    assert sorted((tuple(r) for r in got.collect()), key=str) == clustered(rows, k, 3, 6, 64)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_of_nothing_and_of_one_point(spark):
    df = spark.createDataFrame([(1, [0.5] * 6)] * 30, "vec_id long, embedding array<float>")
    got = centroids.cluster_report(df, centroids.ClusterParams(width=6)).collect()
    assert len(got) == 30 and {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)}
    for empty in (df.where("vec_id > 1"), df.where("vec_id = 1").withColumn("vec_id", F.lit(None).cast("long"))):
        got = centroids.cluster_report(empty, centroids.ClusterParams(width=6))
        assert got.count() == 0 and got.columns[0] == "vec_id"


def test_simplex_bounds_hold_and_filter():
    rng = np.random.default_rng(9)
    groups = rng.normal(size=(16, 64)) * 3
    vectors = np.floor(64 * (groups[rng.integers(0, 16, 3000)] + rng.normal(size=(3000, 64)))).astype(np.int64)
    cents = np.floor(64 * groups).astype(np.int64)
    simplex = centroids.Simplex(cents, 8)
    assert len(simplex.pivots) == 8
    a, c = simplex.apexes(vectors), simplex.apexes(cents)
    exact = ((vectors[:, None, :] - cents[None]) ** 2).sum(axis=2)
    lower = ((a[:, None] - c[None]) ** 2).sum(axis=2)
    assert np.all(lower <= exact * (1 + 1e-9)) and np.all(lower + 4 * a[:, -1:] * c[:, -1] >= exact * (1 - 1e-9))
    # a pivot's own distance is exact from both sides
    at = [int(np.flatnonzero((cents == p).all(axis=1))[0]) for p in simplex.pivots]
    assert np.allclose(lower[:, at], exact[:, at])
    assert centroids.candidates(a, c).mean() < 0.5
    best, distance = centroids.nearest(vectors, a, cents, c)
    assert np.array_equal(best, exact.argmin(axis=1)) and np.array_equal(distance, exact.min(axis=1))


# ------------------------------------------------------------------ language model


def tokens_of(text):
    return [*WORD.findall((text or "").translate(UPPER)), None]


def plain_model(rows, kinds, weights):
    """Counts of the documents that are not only scored, and log10 probabilities by the formula."""
    one, two = Counter(), Counter()
    for (_, text), kind in zip(rows, kinds):
        if kind != interpolated_lm.SCORED:
            t = tokens_of(text)
            one.update(t)
            two.update(zip([None, *t], t))
    n, v = sum(one.values()), len(one)

    def p(before, token):
        c = one[before]
        a = weights.pair[c.bit_length()]
        return (a * two[before, token] / c if c else 0) + (1 - a) * ((weights.word * one[token] / n if n else weights.word) + (1 - weights.word) / (v + 1))

    return one, n, v, p


def kinds_of(spark, rows, params):
    df = spark.createDataFrame([(n, r[0]) for n, r in enumerate(rows)], "n long, doc_id long")
    deleted = F.pmod(F.xxhash64("doc_id"), F.lit(params.deleted)) == 0
    kind = F.when(held_out(F.col("doc_id"), 7, 2), 2).when(deleted, 1).otherwise(0)
    return [r.k for r in df.orderBy("n").select(kind.alias("k")).collect()]


def learned(rows, kinds, params):
    """Expectation-maximisation over the held-out events one by one."""
    one, two = Counter(), Counter()
    for (_, text), kind in zip(rows, kinds):
        if kind == interpolated_lm.COUNTED:
            t = tokens_of(text)
            one.update(t)
            two.update(zip([None, *t], t))
    v = len({t for (_, text), kind in zip(rows, kinds) if kind != interpolated_lm.SCORED for t in tokens_of(text)})
    n = sum(one.values())
    events = [e for (_, text), kind in zip(rows, kinds) if kind == interpolated_lm.DELETED for e in zip([None, *tokens_of(text)], tokens_of(text))]
    weights = interpolated_lm.Weights()
    for _ in range(params.most_steps):
        sums = defaultdict(lambda: [0, 0.0, 0.0, 0.0])
        for before, token in events:
            c = one[before]
            a = weights.pair[c.bit_length()]
            of_pair = a * two[before, token] / c if c else 0.0
            of_word, rest = (1 - a) * weights.word * one[token] / max(n, 1), (1 - a) * (1 - weights.word) / (v + 1)
            total = of_pair + of_word + rest
            for k, x in enumerate((1, of_pair / total, of_word / total, (of_word + rest) / total)):
                sums[c.bit_length()][k] += x
        if not sums:
            return weights
        weights, last = interpolated_lm._better(weights, [(b, *s) for b, s in sums.items()]), weights
        if max(abs(x - y) for x, y in zip((*weights.pair, weights.word), (*last.pair, last.word))) < params.tolerance:
            break
    return weights


SMALL = interpolated_lm.InterpolationParams(deleted=4, block_bytes=3000, bucket_bytes=2000, part_bytes=200)


@pytest.mark.parametrize("params", [interpolated_lm.InterpolationParams(deleted=4), SMALL])
def test_scores(spark, odd, params):
    rows = [(r[0], r[1]) for r in odd_rows()]
    kinds = kinds_of(spark, rows, params)
    assert set(kinds) == {0, 1, 2}
    weights = learned(rows, kinds, params)
    one, n, v, p = plain_model(rows, kinds, weights)
    want = []
    for i, text in rows:
        t = tokens_of(text)
        want.append((str(i), len(t), sum(one[w] > 0 for w in t), n, sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t),
                     sum(math.log10(p(b, w)) for b, w in zip([None, *t], t))))
    got = interpolated_lm.text_scores(odd, ~held_out(F.col("doc_id"), 7, 2), params)
    got = [(str(r[0]), *r[1:]) for r in got.collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:4] == w[:4]
        assert g[4:] == pytest.approx(w[4:], rel=1e-4), g  # weights are rounded to six places after each step


def test_probabilities_sum_to_one_after_every_context(spark, odd):
    rows = [(r[0], r[1]) for r in odd_rows() if r[1] is None or len(r[1]) < 3000]
    kinds = kinds_of(spark, rows, SMALL)
    weights = learned(rows, kinds, SMALL)
    one, n, v, p = plain_model(rows, kinds, weights)
    for before in [None, "unseen words", *list(one)[:20]]:
        assert sum(p(before, w) for w in one) + p(before, "unknown") == pytest.approx(1)
    # the formula over arrays says the same
    for before, word, pair in ((None, "alphabeta", 1), ("unseen", "one", 0)):
        got = interpolated_lm.pair_probability(np.array([float(pair)]), np.array([float(one[before])]), np.array([float(one[word])]), v, n, weights)
        a = weights.pair[one[before].bit_length()]
        assert got[0] == pytest.approx((a * pair / one[before] if one[before] else 0) + (1 - a) * (weights.word * one[word] / n + (1 - weights.word) / (v + 1)))


def test_long_texts_are_cut_without_loss():
    for text in (b"", b" ", b"one", b"ab cd  ef\tgh " * 40, b"x" * 500, b" " * 300 + b"late word", b"a " * 100 + b" " * 200):
        parts = list(interpolated_lm._parts(text, 50))
        pairs, before = [], None
        for data, lead, end in parts:
            words = data.split()
            if lead:
                assert words[0] == before
                words = words[1:]
            for w in [*words, *([None] if end else [])]:
                pairs.append((before, w))
                before = w
        t = [*text.split(), None]
        assert pairs == list(zip([None, *t], t)) and [e for _, _, e in parts] == [False] * (len(parts) - 1) + [True]


def test_scores_without_training_and_of_nothing(spark, odd, none):
    got = interpolated_lm.text_scores(odd, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)} and len(got) == len(odd_rows())
    assert interpolated_lm.text_scores(none, F.lit(True)).count() == 0


def test_context_helps_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = held_out(F.col("doc_id"), 7, 2)
    r = interpolated_lm.text_scores(docs, ~out).where(out).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b
