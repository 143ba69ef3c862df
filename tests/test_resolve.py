"""Title resolution (C20–C22, M4–M6) against a brute-force, one-title-at-a-time
implementation of the same rules on small random catalogues."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fernhill.functions.titles import ITEM_ITEMSET_PATTERN, ITEMSET_ONLY_PATTERN, YEAR_PATTERN
from fernhill.operators.resolve import record_matches, resolve_titles, titles_to_match

NO = "No Results"
M2, M3, YR = (re.compile(p) for p in (ITEM_ITEMSET_PATTERN, ITEMSET_ONLY_PATTERN, YEAR_PATTERN))
THIS_YEAR = 2026


def parse(title):
    t = title.replace("_", " ")
    year = itemset = item = rest = None
    m = YR.search(t)
    if m:
        y = int(m.group(1)[1:-1])
        if 1900 <= y <= THIS_YEAR:
            year = y
            t = YR.sub("", t)
    m = M2.search(t)
    if m:
        t = M2.sub("", t)
        itemset, item = int(m.group(1)), int(m.group(2))
        if m.group(3) and len(m.group(3)) > 1:
            rest = m.group(3)[1:].strip() or None
    else:
        m = M3.search(t)
        if m:
            t = M3.sub("", t)
            itemset = int(m.group(1))
    return t.strip(), year, itemset, item, rest


def brute(titles, cands):
    by_q = {}
    for c in sorted(cands, key=lambda c: c["position"]):
        by_q.setdefault(c["query"].strip().lower(), []).append(c)

    def pick(lst, year, tv):
        if not lst:
            return None
        kinds = ("series", "episode") if tv else ("movie", "series")
        for c in lst:
            if year and c["year"] != year:
                continue
            if c["kind"] in kinds and (c["votes"] > 200 or (c["kind"] == "movie" and c["votes"] > 50)):
                return c
        return lst[0]

    def search(q, year, tv):
        got = pick(by_q.get(q.strip().lower(), []), year, tv)
        if got is None and (":" in q or "-" in q):
            return search(": ".join(x.strip() for x in re.split(":|-", q)[:-1]), year, True)
        return got

    def ids(c, s, e):
        if c is None:
            return NO, NO
        if s and e and c["kind"] == "series":
            eps = [x["id"] for x in cands if x["parent_id"] == c["id"] and x["itemset_no"] == s and x["item_no"] == e]
            return (min(eps) if eps else None), c["id"]
        if c["kind"] == "series":
            return None, c["id"]
        if c["kind"] == "episode":
            return c["id"], c["parent_id"]
        return c["id"], None

    def tt(v):
        return None if not v else (v if v == NO else "tt" + v)

    out = {}
    for title in titles:
        t, year, s, e, rest = parse(title)
        if rest:
            a, b = ids(search(f"{t.strip()} {rest.strip()}", year, True), s, e)
            if a == NO:
                a, b = ids(search(t, year, True), s, e)
        else:
            a, b = ids(search(t, year, bool(s and e)), s, e)
        out[title] = (tt(a), tt(b))
    return out


WORDS = ["red plate", "blue ring", "old rod"]
title_st = st.builds(
    lambda w, x, form, n, y: [w, f"{w} S0{n}E1{n}", f"{w} S0{n}E1{n} - {x}", f"{w}: {x} - blue",
                              f"{w} ({y})", f"{w} itemset {n}", f"{w.replace(' ', '_')}_S{n}_E{n}_Part",
                              f"{w} - {x}: {w} ({y})"][form],
    st.sampled_from(WORDS), st.sampled_from(WORDS), st.integers(0, 7), st.integers(1, 3),
    st.sampled_from([1999, 2001, 1890]))
cand_st = st.builds(
    lambda q, pos, kind, year, votes, parent, s, e: dict(
        query=q, position=pos, id=f"i{pos}", kind=kind, year=year, votes=votes,
        parent_id=parent if kind == "episode" else None, itemset_no=s if kind == "episode" else None,
        item_no=e if kind == "episode" else None),
    st.sampled_from(WORDS + ["red plate: blue ring", "Blue Ring - old rod", "red plate - old rod"]),
    st.integers(0, 10_000), st.sampled_from(["series", "episode", "movie"]), st.sampled_from([1999, 2001, 2010]),
    st.sampled_from([10, 60, 150, 250]), st.sampled_from(["i1", "i2", "i3"]), st.integers(1, 3), st.integers(11, 13))

CAND_SCHEMA = ("query string, position long, id string, kind string, year int, votes int, parent_id string, "
               "itemset_no int, item_no int")


@settings(max_examples=12, deadline=None)
@given(st.lists(title_st, min_size=1, max_size=12), st.lists(cand_st, max_size=25, unique_by=lambda c: c["position"]))
def test_resolution_matches_brute_force(spark, titles, cands):
    cols = ["query", "position", "id", "kind", "year", "votes", "parent_id", "itemset_no", "item_no"]
    cdf = spark.createDataFrame([tuple(c[k] for k in cols) for c in cands], CAND_SCHEMA)
    tdf = spark.createDataFrame([(t,) for t in titles], "title string")
    got = {r.title: (r.title_id, r.itemset_id) for r in resolve_titles(tdf, cdf).collect()}
    assert got == brute(set(titles), cands)


def test_null_title_gives_null_ids(spark):
    cdf = spark.createDataFrame([("x", 1, "1", "movie", 2000, 300, None, None, None)], CAND_SCHEMA)
    tdf = spark.createDataFrame([(None,), ("x",), ("nothing",)], "title string")
    got = {r.title: (r.title_id, r.itemset_id) for r in resolve_titles(tdf, cdf).collect()}
    assert got == {None: (None, None), "x": ("tt1", None), "nothing": (NO, NO)}


def test_worklist_and_upsert(spark):
    tmap = spark.createDataFrame([(" Foo ", None, None), ("BAR", None, None), ("baz", "tt1", None), ("  ", None, None),
                                  (None, None, None)], "title string, title_id string, itemset_id string")
    matches = spark.createDataFrame([("bar", "tt9", None, True, None), ("qux", None, None, False, None)],
                                    "title string, title_id string, itemset_id string, has_match boolean, "
                                    "match_ts timestamp")
    work = titles_to_match(tmap, matches)
    assert sorted(r.title for r in work.collect()) == ["foo"]
    with_null = matches.union(spark.createDataFrame([(None, None, None, True, None)], matches.schema))
    assert titles_to_match(tmap, with_null).count() == 0
    found = spark.createDataFrame([("Foo", "tt5", None), ("qux", NO, NO)], "title string, title_id string, itemset_id string")
    merged = {r.title: (r.title_id, r.has_match) for r in record_matches(matches, found).collect()}
    assert merged == {"bar": ("tt9", True), "qux": (NO, True), "foo": ("tt5", True)}
    assert record_matches(matches, found).where(F.col("match_ts").isNull()).count() == 1


def test_record_matches_refuses_conflicting_ids(spark):
    import pytest
    from pyspark.errors import PySparkException

    matches = spark.createDataFrame([], "title string, title_id string, itemset_id string, has_match boolean, "
                                        "match_ts timestamp")
    same = spark.createDataFrame([("Foo", "tt1", None), (" foo ", "tt1", None)], "title string, title_id string, itemset_id string")
    assert [r.title_id for r in record_matches(matches, same).collect()] == ["tt1"]
    clash = spark.createDataFrame([("Foo", "tt1", None), ("foo", "tt2", None)], "title string, title_id string, itemset_id string")
    with pytest.raises(PySparkException):
        record_matches(matches, clash).collect()
