"""The corpus pipeline, stage by stage, against a plain Python version."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from fernhill.llm import quality_qda, source_mix
from fernhill.llm.queries import QUALITY_THRESHOLD, tokenizer_path, training_labels
from tests.llm.conftest import SCHEMA, odd_rows, prose

SPACE, WORD = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[^\x20\x09-\x0D]+")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Odd rows, and families of near copies with one to forty words changed."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    rng = np.random.default_rng(4)
    rows = odd_rows()
    for g in range(12):
        base = prose(500 + g, 120).split()
        for c in range(4):
            text = list(base)
            for k in rng.choice(120, (0, 1, 3, 14)[c], replace=False):
                text[k] = f"changed{c}"
            rows.append((1000 + 10 * g + c, " ".join(text), "en", f"s{g % 3}", None, *(["q"] * 14)))
    junk = [(2000 + n, " ".join(f"$${rng.integers(10 ** 6)} !!! ##{k % 7}" for k in range(40 + n)), "en", "b", None, *(["q"] * 14)) for n in range(40)]
    rows += junk
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(r[0] < 2000), 0) for r in rows if r[0] is not None and r[0] >= 100]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def written(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for k, y in enumerate(b):
            row.append(last[k] + 1 if x == y else max(last[k + 1], row[k]))
    return row[-1]


def alike(a, b, threshold=0.8):
    for x, y in ((a, b), (list(dict.fromkeys(a)), list(dict.fromkeys(b)))):
        if min(len(x), len(y)) < threshold * max(len(x), len(y)):
            return False
        same = sum((Counter(x) & Counter(y)).values())
        if same < threshold * (len(x) + len(y) - same):
            return False
        m = len(x) if x == y else subsequence(x, y)
        if m < threshold * (len(x) + len(y) - m):
            return False
    return True


def shingles(text):
    w = WORD.findall(text or "")
    return [tuple(w[k:k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def near_kept(rows):
    """Of each class of linked texts the row with the smallest id, null last."""
    own = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if own[i] and own[j] and alike(own[i], own[j]):
                root[find(i)] = find(j)
    classes = {}
    for i, r in enumerate(rows):
        if own[i]:
            classes.setdefault(find(i), []).append(r)
    kept = [min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()]
    return Counter(kept) + Counter(r for i, r in enumerate(rows) if not own[i])


def test_stages_against_plain_python(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    # rejected documents go, all others stay as they are
    scores = Counter()
    for r in quality_qda.quality_scores(docs, training_labels(spark, folder)).collect():
        scores[r.doc_id] += r.score >= QUALITY_THRESHOLD
    good = written(spark, STAGES["quality"](spark, docs, folder), f"{tmp_path}/quality")
    assert good.columns == docs.columns
    assert Counter(r.doc_id for r in good.collect()) == +scores and 0 < good.count() < docs.count()
    assert not rows_of(good) - rows_of(docs)

    # of equal texts the one with the most code points, then the smallest id
    exact = written(spark, STAGES["exact"](spark, good, folder), f"{tmp_path}/exact")
    groups = {}
    for r in good.collect():
        groups.setdefault(SPACE.sub("", r.text or ""), []).append(tuple(r))
    best = {k: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for k, g in groups.items()}
    assert rows_of(exact) == Counter(best.values())

    near = written(spark, STAGES["near"](spark, exact, folder), f"{tmp_path}/near")
    want = near_kept([tuple(r) for r in exact.collect()])
    assert rows_of(near) == want and sum(want.values()) < exact.count()

    # every text is a document or consecutive words of one, and sources give their quotas
    mixed = written(spark, STAGES["mix"](spark, near, folder), f"{tmp_path}/mix")
    assert mixed.columns == docs.columns
    texts = {r.doc_id: r.text for r in near.collect()}
    given = Counter()
    for r in mixed.collect():
        given["1" if r.source is None else "0" + r.source] += len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or f" {r.text} " in " " + " ".join(WORD.findall(texts[r.doc_id])) + " "
    ends = {r.skey: r.ends[-1] for r in source_mix.plan_mix(near).select("skey", "ends").distinct().collect()}
    assert given == Counter({k: v for k, v in ends.items() if v})

    # the last stage's rows, from the texts by the tokenizer
    got = corpus_pipeline.run(spark, folder).collect()
    assert pieces_of(got) == token_pieces(mixed.collect())
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def pieces_of(rows):
    return Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def token_pieces(rows):
    from tokenizers import Tokenizer

    tokenizer, out = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in rows:
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for n, (s, e) in enumerate(zip(cuts, cuts[1:])):
            out[r.doc_id, n, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())] += 1
    return out


def test_empty_tables(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
