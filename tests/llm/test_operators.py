"""Each operator against brute force on odd rows, and on an empty table."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fernhill.llm import anchor_dedup, exact_dedup, jump_shards, language_svm, order_minhash, packing, quality_qda, source_mix, topk_nra, toxicity_kn
from fernhill.llm.queries import tokenizer_path

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_exact_dedup(odd, none):
    groups = defaultdict(list)
    for i, t in odd.select("doc_id", "text").collect():
        groups[hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest()].append((-len(t or ""), i is None, i or 0, i))
    want = []
    for h, members in groups.items():
        members.sort(key=lambda m: m[:3])
        want += [(m[3], members[0][3], len(members), n == 0, h) for n, m in enumerate(members)]
    got = exact_dedup.find_copies(odd)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert Counter(r[0] for r in kept.select("doc_id").collect()) == Counter(w[0] for w in want if w[3])
    assert exact_dedup.find_copies(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def test_exact_dedup_is_right_with_a_full_filter(odd):
    """A filter that is too small passes more rows on and changes nothing."""
    digests = odd.select(exact_dedup.text_digest(F.col("text")).alias("digest"))
    bits = exact_dedup.repeated_filter(digests, 1)
    split = exact_dedup.split_by_filter(digests, bits, 1, "maybe").collect()
    many = Counter(r.digest for r in split)
    assert all(r.maybe for r in split if many[r.digest] > 1)


def test_jump_hash_matches_the_published_loop():
    def one(key, buckets):
        b, j = -1, 0
        while j < buckets:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return b

    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 2000)
    for n in (1, 2, 16, 17, 1000):
        assert jump_shards.jump_hash(keys, n).tolist() == [one(int(k) % (1 << 64), n) for k in keys]


def test_sharding(odd, none):
    got = jump_shards.shard_documents(odd, 4).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd.select("doc_id", "text").collect())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert len({(r.doc_id, r.shard) for r in got}) == len({r.doc_id for r in got})
    assert jump_shards.shard_documents(none, 4).count() == 0


def test_seats_go_to_the_highest_quotients(spark):
    targets = {"a": 700.0, "b": 310.0, "c": 310.0, "d": 3.0}
    df = spark.createDataFrame([(k, 10 ** 6, v) for k, v in targets.items()], "skey string, source_size long, target double")
    got = {(r.skey, r.shard): r.quota for r in source_mix.shard_quotas(df, 1323, 10, 5).collect()}
    seats = sorted(((-t / (2 * k - 1), s) for s, t in targets.items() for k in range(1, 200)))[:132]
    for shard in range(5):
        own = Counter(s for _, s in seats[132 * shard // 5:132 * (shard + 1) // 5])
        assert {s: got[s, shard] for s in targets} == {s: own.get(s, 0) for s in targets}


def test_mix(odd, none):
    got = source_mix.mix_amounts(odd)
    total = sum(r["size"] for r in got.collect())
    sources = {}
    for r in got.collect():
        assert 0 <= r.taken <= 3 * r["size"] and r["size"] <= r.source_size
    by = {r.source: r for r in odd.groupBy("source").agg(F.sum(source_mix.count_words(F.col("text"))).alias("n")).collect()}
    assert sum(r.n for r in by.values()) == total
    # the rows of the mix hold exactly the words that the amounts take, source by source
    mixed = source_mix.mix_rows(odd)
    assert mixed.columns == odd.columns
    words = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(source_mix.count_words(F.col("text"))).alias("n")).collect()}
    keyed = source_mix.plan_mix(odd).groupBy("skey").agg(F.first("target").alias("t"), F.first("ends").alias("ends")).collect()
    for r in keyed:
        source = None if r.skey == "1" else r.skey[1:]
        assert abs(words.get(source, 0) - r.t) <= 4 and words.get(source, 0) == r.ends[-1] and sorted(r.ends) == list(r.ends)
        sources[source] = r.t
    assert abs(sum(sources.values()) - total) < 1e-6 * max(1, total)
    assert sum(words.values()) == sum(r.taken for r in got.collect())
    assert rows_of(got, "doc_id", "taken") == rows_of(source_mix.mix_amounts(odd), "doc_id", "taken")
    assert source_mix.mix_amounts(none).count() == 0 and source_mix.mix_rows(none).count() == 0


def test_mix_rows_hold_the_quotas_of_each_shard(odd):
    """Word by word against the plan: every shard has its quotas, each document what the amounts say."""
    shards = source_mix.mix_rows(odd, shard_col="_shard")
    n = source_mix.count_words(F.col("text"))
    got = {(r.source, r._shard): r.n for r in shards.groupBy("source", "_shard").agg(F.sum(n).alias("n")).collect()}
    for r in source_mix.plan_mix(odd).groupBy("skey").agg(F.first("ends").alias("ends")).collect():
        source = None if r.skey == "1" else r.skey[1:]
        for k, (lo, hi) in enumerate(zip([0, *r.ends], r.ends)):
            assert got.get((source, k), 0) == hi - lo
    want, texts = Counter(), defaultdict(Counter)
    for r in source_mix.mix_amounts(odd).collect():
        want[r.doc_id] += r.taken
    for r in odd.select("doc_id", "text").collect():
        texts[r.doc_id].update(WORD.findall(r.text or ""))
    have = Counter()
    for r in shards.select("doc_id", "text").collect():
        words = Counter(WORD.findall(r.text))
        have[r.doc_id] += words.total()
        assert words.keys() <= texts[r.doc_id].keys()
    assert {k: v for k, v in have.items() if v} == {k: v for k, v in want.items() if v}


@pytest.mark.parametrize("broadcast_runs", [50_000, 0])
def test_repeated_rows_take_their_turns(spark, broadcast_runs):
    """Rows that share source, id and size: equal and different texts, joined with and without a broadcast."""
    rows = [(1, "a b c d e f", "s")] * 5 + [(1, "g h i j k l", "s")] * 3 + [(2, "m n o", "s"), (3, "p q r s t u v w", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    params = source_mix.MixParams(broadcast_runs=broadcast_runs, shards=3, block_words=2)
    amounts = source_mix.mix_amounts(docs, params).collect()
    mixed = source_mix.mix_rows(docs, params).collect()
    assert len(amounts) == len(rows)
    assert sum(r.taken for r in amounts) == sum(len(r.text.split()) for r in mixed)
    for i in (1, 2, 3):
        assert sum(r.taken for r in amounts if r.doc_id == i) == sum(len(r.text.split()) for r in mixed if r.doc_id == i)


@pytest.mark.parametrize("big", [200_000, 5_000_000])
def test_small_sources_come_near_their_targets_beside_any_other(spark, big):
    """What a small source gives does not depend on the size of the table."""
    text = lambda n: F.array_join(F.array_repeat(F.lit("w"), n), " ")
    docs = spark.range(100).select(F.col("id").alias("doc_id"), text(big // 100).alias("text"), F.lit("a").alias("source"))
    for source, sizes in (("b", [100, 150, 50]), ("c", [350, 350]), ("d", [7]), ("e", [1, 0])):
        for k, n in enumerate(sizes):
            docs = docs.union(spark.range(1).select(F.lit(1000 + k), text(n), F.lit(source)))
    got = source_mix.mix_amounts(docs).groupBy("target", "source_size").agg(F.sum("taken").alias("n")).collect()
    told = {r.source_size: (r.target, r.n) for r in got}
    assert {k: v for k, v in told.items() if k != big} == {300: (900, 900), 700: (2100, 2100), 7: (21, 20), 1: (3, 3)}
    assert abs(told[big][1] - told[big][0]) <= 4


@pytest.mark.parametrize("round_mb", [32, 0])
def test_top_k(spark, round_mb):
    rng = np.random.default_rng(3)
    vectors = [(i, rng.normal(size=6).tolist()) for i in range(400)] + [
        (400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, []), (405, [0.5]), (None, [0.1] * 6), (100, [9.0] * 6)]
    vectors += [(500 + i, [0.25] * 6) for i in range(30)]
    df = spark.createDataFrame([(*v, 7, "x", 0.5) for v in vectors], "vec_id long, embedding array<double>, row int, score string, rank double").repartition(5)
    got = [tuple(r) for r in topk_nra.top_k(df, F.col("vec_id") % 100 == 0, 10, block_rows=64, query_rows=2, part_rows=16, round_mb=round_mb).collect()]
    usable = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for a, (i, q) in enumerate(usable):
        if i is not None and i % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0, j) for b, (j, v) in enumerate(usable) if a != b)[:10]
            want += [(i, n + 1, s[3], -s[0]) for n, s in enumerate(scored)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert topk_nra.top_k(df.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_lists_are_read_until_no_outsider_qualifies():
    """Products are formed for entries that were read and rows that were resolved, and reading stops early where it can."""
    rng = np.random.default_rng(12)
    clusters = rng.integers(-400, 400, (20, 16))
    data = (clusters[rng.integers(0, 20, 2000)] + rng.integers(-30, 30, (2000, 16))).T.copy()
    lists, n = topk_nra.SortedLists(np.arange(2000), data), data.size
    for q in range(0, 2000, 100):
        query, before = data[:, q], (lists.read, lists.resolved)
        exact = data.T @ query
        want = np.sort(np.delete(exact, q))[-10:]
        places, scores = lists.search(query, q, 10, None)
        assert np.array_equal(scores, exact[places]) and np.array_equal(np.sort(scores)[-10:], want)
        assert q not in places and set(np.flatnonzero(exact > want[0])) - {q} <= set(places.tolist())
        assert lists.read - before[0] + 16 * (lists.resolved - before[1]) < n       # fewer products than a scan forms
    assert lists.read < 0.6 * 20 * n and lists.resolved < 0.05 * 20 * 2000
    # a floor that nothing here can reach ends the reading at the first entries
    before = lists.read
    assert len(lists.search(data[:, 0], 0, 10, 10 ** 9)[0]) == 0 and lists.read - before <= n // 64


def test_lists_are_read_once_for_all_queries(monkeypatch):
    """Searching evenly spread vectors costs about what forming all products one by one does, and is exact for odd queries too."""
    rng = np.random.default_rng(21)
    data = np.floor(1024 * rng.normal(0, 0.125, (64, 3000))).astype(np.int64)
    data[:, 2990:] = data[:, 2980:2990]                                             # ties
    queries = data[:, ::10].T.copy()
    queries[:4] = 0
    queries[1, 5], queries[2, 7], queries[3] = 3, -2, 1
    own = np.r_[-1, -1, -1, -1, np.arange(40, 3000, 10)]
    rounds, tables = [], topk_nra.SortedLists._tables
    monkeypatch.setattr(topk_nra.SortedLists, "_tables", lambda self, upto: rounds.append(upto) or tables(self, upto))
    lists, began = topk_nra.SortedLists(np.arange(3000), data), time.thread_time()
    found = lists.search_all(queries, own, 10, np.full(300, -np.inf))
    took, began = time.thread_time() - began, time.thread_time()
    exact = np.array([(data * q[:, None]).sum(axis=0) for q in queries])
    assert took < 8 * (time.thread_time() - began)                                  # one query at a time: 28 times
    assert rounds == sorted(set(rounds)) and len(rounds) <= len(topk_nra.DEPTHS)
    for q, (places, scores) in enumerate(found):
        others = np.delete(np.arange(3000), own[q]) if own[q] >= 0 else np.arange(3000)
        kth = np.sort(exact[q, others])[-10]
        assert np.array_equal(scores, exact[q, places]) and own[q] not in places
        assert set(others[exact[q, others] >= kth]) <= set(places.tolist())
    floors = np.sort(exact, axis=1)[:, -5].astype(float)
    for q, (places, _) in enumerate(lists.search_all(queries, own, 10, floors)):    # a floor that stands: all that reach it
        assert set(np.flatnonzero(exact[q] >= floors[q])) - {own[q]} <= set(places.tolist())


def test_top_k_of_empty_and_very_wide_vectors(spark, monkeypatch):
    empty = spark.createDataFrame([(i, []) for i in (0, 1, 2)], "vec_id long, embedding array<double>")
    got = topk_nra.top_k(empty, F.col("vec_id") == 0, 2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 0), (0, 2, 2, 0)]
    monkeypatch.setattr(topk_nra, "PART_VALUES", 300)
    rng = np.random.default_rng(5)
    data = rng.normal(size=(90, 100))
    rows, whole = np.arange(90), np.floor(1024 * data).astype(np.int64)
    block = pa.RecordBatch.from_pylist([{"block": 0, "rows": rows.tobytes(), "ids": rows.tobytes(), "valid": b"\1" * 90, "data": whole.tobytes(), "width": 100}])
    known = type("Known", (), {"value": (rows[:7], rows[:7], whole[:7])})
    got = next(iter(topk_nra._search_in(known, 4, 2048)([block]))).to_pydict()
    exact = whole[:7] @ whole.T
    exact[np.arange(7), np.arange(7)] = -10 ** 12
    assert np.array_equal(np.array(got["row"]).reshape(7, 4), np.argsort(-exact, axis=1)[:, :4])


@pytest.mark.parametrize("window", [35, 6])
def test_substring_dedup(odd, none, window):
    texts = odd.select("doc_id", "text").collect()
    words = [WORD.findall(t or "") for _, t in texts]
    seen = Counter(tuple(w[s:s + window]) for w in words for s in range(len(w) - window + 1))
    want = []
    for (i, _), w in zip(texts, words):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    got = anchor_dedup.drop_repeats(odd, window)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text") == sorted(want, key=str)
    assert all(sum(s["end"] - s["first"] for s in r.spans) == r.n_removed for r in got.collect())
    assert anchor_dedup.drop_repeats(none, window).count() == 0


def test_near_classes(odd, none):
    got = {r.doc_id: r for r in order_minhash.near_classes(odd).collect() if r.doc_id is not None}
    assert {got[i].class_id for i in (1, 2, 3, 4)} == {1} and got[1].class_size == 5
    assert got[8].class_id == got[9].class_id == 8
    assert all(got[i].class_size == 1 for i in [5, 6, 7, 10, 11, 12, 13, 14, *range(100, 140)])
    kept = order_minhash.drop_near(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert not {2, 3, 4, 9} & set(ids) and ids[1] == ids[8] == 1 and ids[None] == 2 and all(ids[i] == 1 for i in (5, 6, 7, 10, 11))
    assert order_minhash.near_classes(none).count() == 0 and order_minhash.drop_near(none).count() == 0


def test_near_copies_against_all_pairs(spark):
    """Every planted copy with few edits joins its text's class; others stay alone."""
    from tests.llm.conftest import prose

    rng = np.random.default_rng(5)
    rows, want = [], {}
    for g in range(60):
        base = prose(1000 + g, 150).split()
        for c in range(1 + g % 4):
            text = list(base)
            for _ in range(min(c, 2)):
                text[int(rng.integers(len(text)))] = f"edit{g}x{c}"
            rows.append((len(rows), " ".join(text)))
            want[len(rows) - 1] = len(rows) - 1 - c
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == want


def test_near_copies_inside_a_large_family(spark):
    """Members share 85 % of their shingles with the family and are not similar; planted pairs among them are."""
    rng = np.random.default_rng(11)
    base = [f"w{rng.integers(10 ** 9)}" for _ in range(400)]
    rows, want = [], {}

    def add(words, of):
        rows.append((len(rows), " ".join(words)))
        want[len(rows) - 1] = of

    for g in range(2000):
        # one run of 15 % of the text is the member's own, at the same place in all
        at = 170
        text = base[:at] + [f"o{g}x{k}" for k in range(60)] + base[at + 60:]
        add(text, len(rows))
        if g % 20 == 0:
            of, own = len(rows) - 1, list(text)
            # its copy changes 32 to 40 of these words, so 0.80 to 0.84 stay alike, little more than in any two members
            much = 32 + g // 20 % 9
            start = at + 60 - much
            own[start:start + much] = [f"c{g}x{k}" for k in range(much)]
            add(own, of)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    shingles = lambda t: np.unique([hash(tuple(t[i:i + 5])) for i in range(len(t) - 4)])
    like = lambda x, y: len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    sets = [shingles(t.split()) for _, t in rows]
    planted = [(a, b) for b, a in want.items() if a != b]
    assert all(0.8 <= like(sets[a], sets[b]) < 0.87 for a, b in planted)
    got = {r.doc_id: r.class_id for r in order_minhash.near_classes(docs).collect()}
    assert [p for p in planted if got[p[0]] != got[p[1]]] == []
    # texts of one class are linked by pairs at the threshold
    groups = defaultdict(list)
    for i, c in got.items():
        groups[c].append(i)
    for own in groups.values():
        assert all(any(like(sets[i], sets[j]) >= 0.8 for j in own if j != i) for i in own) or len(own) == 1


def test_alignment_is_the_ordered_overlap():
    a = np.arange(2, 202, 2, dtype=np.uint32)
    b = a.copy()
    b[[10, 50]] = [9001, 9003]
    assert order_minhash.alignment(a, b, 0.8) == 98 / 102
    assert order_minhash.alignment(a, a[::-1].copy(), 0.8) < 0.8
    moved = np.r_[a[50:], a[:50]]
    assert order_minhash.alignment(a, moved, 0.8) < 0.8


def test_repeated_line_removed_near_the_start():
    """Later repeats are not shifted by one that is gone, whatever their share of the text."""
    import pyarrow as pa

    from fernhill.llm import textvec

    line = [f"line{k}" for k in range(20)]
    text = [w for n in range(100) for w in [*line, *(f"u{n}x{k}" for k in range(8))]]
    _, _, words, counts = next(textvec.word_slices(pa.array([" ".join(text), " ".join(text[20:]), " ".join(text[::-1])])))
    *_, n, _, _, plain = order_minhash.labelled_shingles(words, counts)
    whole, cut, back = np.split(plain, np.cumsum(n)[:2])
    assert order_minhash.alignment(whole >> 1, cut >> 1, 0.8) > 0.98
    assert order_minhash.similar(whole, cut, 0.8) and not order_minhash.similar(whole, back, 0.8)


def test_common_subsequence_against_the_table():
    rng = np.random.default_rng(4)
    for letters in (2, 5, 40, 1000):
        a, b = rng.integers(0, letters, 150), rng.integers(0, letters, 130)
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for k, y in enumerate(b):
                row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
        assert order_minhash.common_subsequence(a, b) == row[-1]


def test_packing(odd, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    tokenizer.encode_special_tokens = True
    got = packing.pack_documents(odd, tokenizer_path(), 64, with_ids=True).collect()
    want = Counter()
    for i, t in odd.select("doc_id", "text").collect():
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % 64 + 1
        for n, (s, e) in enumerate(zip([0, *range(first, len(ids), 64)], [*range(first, len(ids) + 1, 64)])):
            want[i, n, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in got)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= 1.02 * sum(r.length for r in got) / 64 + 1
    assert packing.pack_documents(none, tokenizer_path()).count() == 0


def test_sum_of_squares_rule():
    """The chosen bin is the one with the smallest sum of squares among those with room."""
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 20, 200)
    bins = packing.place_by_squares(lengths, 20)
    gaps: dict[int, int] = {}
    for at in np.argsort(-lengths, kind="stable"):
        s, b = int(lengths[at]), int(bins[at])

        def squares(moved):
            trial = {**gaps, moved: gaps.get(moved, 20) - s}
            return sum(n * n for n in Counter(g for g in trial.values() if g).values())

        room = [k for k, g in gaps.items() if g >= s]
        assert (b in room) if room else (b not in gaps)
        if room:
            assert squares(b) == min(map(squares, room))
        gaps[b] = gaps.get(b, 20) - s


def test_ids_are_those_of_the_tokenizer_file():
    from tokenizers import Tokenizer

    tokenizer, encoder = Tokenizer.from_file(tokenizer_path()), packing.TextEncoder(tokenizer_path())
    texts = ["a  b\n\n c\t\xa0 d", " lead", "trail  \n", "　wide   space", "don't  stop <|endoftext|> 12345  é\r\nß", "", "\x1c\x1f odd \x85x",
             "x" * 20000, " " * 5000 + "a", "ab" * 3000 + "\n" * 300]
    assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in texts] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_get_their_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["<|endoftext|>", "one <|endoftext|> two<|endoftext|><|endoftext|>\n three", "plain  text", "", "<|endoftext", "a <|other|> b"]
    assert 50256 in tokenizer.encode(texts[1], add_special_tokens=False).ids
    got = packing.token_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), tokenizer_path(), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {n: tokenizer.encode(t, add_special_tokens=False).ids + [0] for n, t in enumerate(texts)}


def test_quality(odd, none, odd_labels):
    got = quality_qda.quality_scores(odd, odd_labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    kept = quality_qda.keep_good(odd, odd_labels)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in got if r.score >= 0.3)
    assert {r.score for r in quality_qda.quality_scores(odd, odd_labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality_qda.quality_scores(odd, odd_labels.limit(0)).collect()} == {0.5}
    assert quality_qda.quality_scores(none, odd_labels).count() == 0


def test_quality_density_is_the_normal_one():
    rng = np.random.default_rng(0)
    n = quality_qda.N_STATISTICS
    a = rng.normal(size=(n, n))
    cov = a @ a.T + np.eye(n)
    f = np.linalg.cholesky(cov)
    model = quality_qda.Discriminant(0.5, np.zeros((2, n)), np.array([np.linalg.inv(f), np.eye(n)]), np.array([np.log(np.diag(f)).sum(), 0.0]))
    x = rng.normal(size=(5, n))
    odds = -0.5 * (x * x).sum(1) + 0.5 * np.einsum("ij,jk,ik->i", x, np.linalg.inv(cov), x) + 0.5 * np.linalg.slogdet(cov)[1]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-odds)))


def test_toxicity(odd, none, odd_labels):
    got = toxicity_kn.toxicity_scores(odd, odd_labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity_kn.toxicity_scores(none, odd_labels).count() == 0
    assert {r.score for r in toxicity_kn.toxicity_scores(odd, odd_labels.limit(0)).collect()} == {0.5}


def _symbols_of(text):
    """Lower-case letters and single spaces, as the operator's alphabet has them for ASCII texts."""
    return re.sub(r"[^a-z]+", " ", text.lower()).lstrip(" ")


def _direct_evidence(training, texts, params):
    """The statistic by its definition, symbol by symbol."""
    order, d, share = toxicity_kn.ORDER, params.discount, params.toxic_share
    counts = [Counter(), Counter()]
    grams_of = lambda t: [(" " * order + t)[k + 1:k + 1 + order] for k in range(len(t))]
    for t, y in training:
        counts[y].update(grams_of(_symbols_of(t)))
    every = set(counts[0]) | set(counts[1])
    four, two = Counter(g[-4:] for g in every), Counter()
    two.update(f[-2:] for f in four)

    def share_of(table, key, below):
        own = [k for k in table if k[:-1] == key[:-1]]
        total = sum(table[k] for k in own)
        return (table[key] - d) / total + d * len(own) / total * below

    def ratio(g):
        seen = [[k for k in c if k[:-1] == g[:-1]] for c in counts]
        totals = [sum(c[k] for k in own) for c, own in zip(counts, seen)]
        freed = [d * len(own) / total if total else 1.0 for own, total in zip(seen, totals)]
        if g in every:
            back = share_of(four, g[-4:], share_of(two, g[-2:], 1 / toxicity_kn.SYMBOLS))
            p = [((c[g] - d) / total if c[g] else 0.0) + f * back for c, total, f in zip(counts, totals, freed)]
            return math.log(p[1]) - math.log(p[0])
        return math.log(freed[1]) - math.log(freed[0])

    out = []
    for t in texts:
        t = _symbols_of(t)
        units = re.findall(r"[a-z]{1,8}(?![a-z]) ?|[a-z]{8}", t)
        assert "".join(units) == t
        at, llr = 0, 0.0
        for u in units:
            s = sum(ratio((" " * order + t)[k + 1:k + 1 + order]) for k in range(at, at + len(u)))
            llr += math.log1p(share * math.expm1(min(s, 30)))
            at += len(u)
        out.append((llr, len(units)))
    return out


@pytest.mark.parametrize("bounds", [{}, {"broadcast_grams": 20}, {"broadcast_grams": 0, "broadcast_contexts": 3}])
def test_toxic_evidence_against_a_direct_one(spark, bounds):
    """Whole texts, symbol by symbol; the same whether the model is broadcast or joined."""
    params = toxicity_kn.ToxicityParams(**bounds)
    training = [("foo bar foo, the riverbank", 0), ("foo baz bad badword", 1), ("bar bar bax abcdefghkindlyput", 0), ("bad bad foo abcdefghtoxicword", 1), ("", 0), ("x", 1)]
    texts = ["foo bad", "abcdefghtoxicword here", "abcdefghkindlyput here", "", "zzz", "bad the river badword!", "a" * 40, "  lead 12 trail  ", "bad"]
    counts = toxicity_kn.gram_counts(spark.createDataFrame([(t, y, False) for t, y in training], "text string, label int, fold boolean"))
    docs = spark.createDataFrame([(n % 8, t) for n, t in enumerate(texts)], "key long, text string").repartition(3)
    got = sorted((r.key, r.llr, r["size"]) for r in toxicity_kn.evidence(docs, counts, params).collect())
    want = sorted((n % 8, *e) for n, e in enumerate(_direct_evidence(training, texts, params)))
    assert [(k, n) for k, _, n in got] == [(k, n) for k, _, n in want]
    assert np.allclose([e for _, e, _ in got], [e for _, e, _ in want], rtol=1e-9, atol=1e-12)
    by = {k: e for k, e, _ in got}
    assert by[1] > 0 > by[2]     # the first eight letters are the same


def test_toxic_counts_by_class_and_fold(spark):
    rows = [("ab ab", 0, False), ("ab", 1, True), ("ab", 0, True)]
    got = {r.gram: tuple(r)[1:] for r in toxicity_kn.gram_counts(spark.createDataFrame(rows, "text string, label int, fold boolean")).collect()}
    code = lambda g: int.from_bytes(g[::-1].encode(), "little")
    assert got[code("     a")] == (2, 1, 1, 1) and got[code("    ab")] == (2, 1, 1, 1) and got[code("  ab a")] == (1, 0, 0, 0)


def test_language(odd, none):
    model = language_svm.train(odd, F.lit(True))
    got = {r.doc_id: r for r in language_svm.predict_languages(odd, model).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (5, 6, 7, 13))
    assert all(r.lang_pred in ("en", "de", "fr", "es", "und") and 0 <= r.score <= 1 for r in got.values())
    one = language_svm.train(odd.where("lang = 'en'"), F.lit(True))
    assert {r.lang_pred for r in language_svm.predict_languages(odd.where("doc_id >= 100"), one).collect()} == {"en"}
    nothing = language_svm.train(none, F.lit(True))
    assert {r.lang_pred for r in language_svm.predict_languages(odd, nothing).collect()} == {"und"}
    assert language_svm.predict_languages(none, model).count() == 0


def test_long_texts_hash_like_short_ones():
    import pyarrow as pa

    from fernhill.llm import textvec

    text = " ".join(f"w{i * 7919 % 1000}" for i in range(20000))
    old = textvec.SLICE
    try:
        whole = np.concatenate([w for _, _, w, _ in textvec.word_slices(pa.array([text, "", "a b"]))])
        textvec.SLICE = 1000
        cut = np.concatenate([w for _, _, w, _ in textvec.word_slices(pa.array([text, "", "a b"]))])
    finally:
        textvec.SLICE = old
    assert whole.tolist() == cut.tolist() and len(whole) == 20002


def test_banded_alignment_decides_as_the_whole_table():
    rng = np.random.default_rng(6)

    def table(x, y):
        row = [0] * (len(y) + 1)
        for v in x:
            last, row = row, [0]
            for k, w in enumerate(y):
                row.append(last[k] + 1 if v == w else max(last[k + 1], row[k]))
        return row[-1]

    reached = 0
    for n in range(300):
        a = rng.integers(0, 30 if n % 2 else 10 ** 6, 90).astype(np.uint32)
        b = list(a)
        for _ in range(int(rng.integers(0, 12))):
            k = int(rng.integers(len(b)))
            b[k:k + int(rng.integers(0, 3))] = rng.integers(0, 40, int(rng.integers(0, 3))).tolist()
        if n % 3 == 0:     # a moved passage, inside the band or beyond it
            k, m = int(rng.integers(40)), int(rng.integers(1, 25))
            b = b[:k] + b[k + m:] + b[k:k + m] if n % 2 else b[k:k + m] + b[:k] + b[k + m:]
        b = np.array(b, np.uint32)
        want = table(a.tolist(), b.tolist())
        want /= len(a) + len(b) - want
        for t in (0.8, 0.6):
            got = order_minhash.alignment(a, b, t)
            assert (got >= t) == (want >= t - 1e-12) and (got < t or abs(got - want) < 1e-12)
            reached += want >= t
    assert 100 < reached < 550


def test_bitmaps_bound_what_texts_can_share():
    import pyarrow as pa

    from fernhill.llm import textvec

    rng = np.random.default_rng(7)
    base = [f"w{k}" for k in rng.integers(0, 500, 400)]
    texts = ["", "one", "one one one one one one one"]
    for n in range(40):
        t = list(base)
        for k in rng.integers(0, 400, 3 * n):
            t[k] = f"x{rng.integers(10 ** 6)}"
        texts.append(" ".join(t))
    _, _, words, counts = next(textvec.word_slices(pa.array(texts)))
    shingles, n, *_ = order_minhash.labelled_shingles(words, counts)
    n_distinct, bits = order_minhash.bitmaps(shingles, n)
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    assert n_distinct.tolist() == [len(s) for s in sets]
    differ = [[sum(int(x ^ y).bit_count() for x, y in zip(a.view("u8"), b.view("u8"))) for b in bits] for a in bits]
    close = []
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert differ[i][j] <= len(a ^ b)
            close += [differ[i][j] > 0.7 * len(a ^ b)] if 0 < len(a ^ b) <= 100 else []
    assert len(close) >= 10 and np.mean(close) > 0.95      # and the bound is near where texts are
