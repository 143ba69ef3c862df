"""Exact top-k by inner product with no-random-access aggregation (Fagin's NRA).

Vectors are turned to integers. A part of the rows keeps one list per component: the rows' places, sorted by
value. For a query, all lists are read side by side, each from the end at which the query's product is largest.
What has been read bounds every row: a component that was met counts with its
product, one that was not with the last product read from its list. Reading goes on, deeper by rounds, until no row that
was never met and all but a few of those met can reach the k-th best score known; these few are resolved to exact scores.
Where many are left, those that lead are resolved first, and their k-th score is a floor. Rows whose
upper bound equals that score stay in, so ties are exact. The k-th score found in earlier parts is
the floor for the next ones, where reading so stops sooner, at once if no row there can reach it.

Lists are read once for all queries of a task, not once for each: a round puts the entries that it reads from either
end into two tables, where an entry that was not read stands as the last one that was, and one matrix product
of the queries' positive and negative components with these tables gives the bounds of all rows. No bound is taken
for a query as long as rows that were never met may qualify. A product over the tables costs as much as two scans,
so the method saves no multiplications where vectors are spread evenly; the work stays queries times rows.

Row blocks are written once and stay where they are; queries come to them, in rounds of a bounded
number that is broadcast. A task keeps the k best per query over all its rows, so
nothing is joined row by row and nothing grows with the square of a group.

Defined cases: vectors that are null, or hold null or non-finite components take no part; a
missing component of a shorter vector is 0; an empty vector scores 0; a null id is never a query, and comes
last among ties; rows that repeat an id are rows of their own, and a query leaves out only its own row; other
columns, whatever their names, are ignored. Sums of products must stay below 2^53, as they do for
up to 8,192 components below 2^20. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

SCALE = 1024
#: Shares of each list that have been read after each round.
DEPTHS = (1 / 64, 1 / 16, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1)
#: Queries whose bounds are taken at a time.
QUERIES = 256
#: Values of a part at most: very wide vectors make shorter lists.
PART_VALUES = 1 << 20


def _packed(rows: DataFrame, block_rows: int, name: str) -> DataFrame:
    """Blocks: block, ids, valid (id is not null), data (int64 matrix), width."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        count = 0

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            ids, vectors = table["id"], table["v"].combine_chunks()
            lengths = np.diff(vectors.offsets.to_numpy())
            width = int(lengths.max(initial=0))
            flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py():]
            data = np.zeros((len(lengths), width), np.int64)
            data[np.arange(width) < lengths[:, None]] = np.floor(flat[:lengths.sum()] * SCALE).astype(np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([table["row"][0].as_py()]), pa.array([table["row"].to_numpy().astype("<i8").tobytes()]),
                pa.array([ids.fill_null(0).to_numpy().astype("<i8").tobytes()]), pa.array([np.asarray(ids.is_valid()).astype("u1").tobytes()]),
                pa.array([data.astype("<i8").tobytes()]), pa.array([width], pa.int32())], names=["block", "rows", "ids", "valid", "data", "width"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, block_rows - count)
                waiting.append(part)
                at, count = at + part.num_rows, count + part.num_rows
                if count == block_rows:
                    yield block(waiting)
                    waiting, count = [], 0
        if count:
            yield block(waiting)

    return settle(rows.mapInArrow(pack, "block bigint, rows binary, ids binary, valid binary, data binary, width int"), name)


def _top(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, null last, then first row."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((rows[some], ids[some], -scores[some]))][:k]


class SortedLists:
    """Some rows with one list per component; ``data`` has a component per line."""

    def __init__(self, rows: np.ndarray, data: np.ndarray):
        self.rows, self.data, self.by_row = rows, data, np.ascontiguousarray(data.T)
        self.places = np.argsort(data, axis=1, kind="stable").astype(np.int32)
        #: Entries read and rows resolved by all searches so far.
        self.read, self.resolved = 0, 0

    def _tables(self, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """What ``upto`` entries of every list tell, read from the high and from the low end: a line per end and list,
        where an entry that was not read stands as the last one that was; and these last ones."""
        n, lines = len(self.rows), np.arange(len(self.data))
        tables, last = [], []
        for places in (self.places[:, n - upto:][:, ::-1], self.places[:, :upto]):
            last.append(self.data[lines, places[:, -1]].astype(float))
            tables.append(np.repeat(last[-1][:, None], n, axis=1))
            np.put_along_axis(tables[-1], places, np.take_along_axis(self.data, places, axis=1), axis=1)
        return np.concatenate(tables), np.concatenate(last)

    def search(self, query: np.ndarray, own_row: int, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all rows that can be among the k best; ``floor`` is a
        score that k other rows are known to reach."""
        return self.search_all(query[None, :], np.array([own_row]), k, np.array([-np.inf if floor is None else floor], float))[0]

    def search_all(self, queries: np.ndarray, own_rows: np.ndarray, k: int, floors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search`` for queries that are a line each; a floor that is not known is -inf."""
        n, none, floors = len(self.rows), np.zeros(0, np.int64), floors.copy()
        found = [(none, none)] * len(queries)
        reading, done, few = np.arange(len(queries)), 0, max(4 * k, n // 16)
        for depth in DEPTHS:
            if done == n or not len(reading):
                break
            before, done = done, max(done + 1, int(n * depth))
            known, last = self._tables(done)
            going_on = np.zeros(len(queries), bool)
            for at in range(0, len(reading), QUERIES):
                some = reading[at:at + QUERIES]
                self.read += int(np.count_nonzero(queries[some])) * (done - before)
                # a positive component reads its list from the high end, a negative one from the low end
                weights = np.concatenate([np.maximum(queries[some], 0), np.minimum(queries[some], 0)], axis=1).astype(float)
                outside = weights @ last             # the most that a row which was never met can score
                going_on[some] = (outside >= floors[some]) & (floors[some] > -np.inf) & (done < n)
                bounded = ~going_on[some]
                some, outside, upper = some[bounded], outside[bounded], weights[bounded] @ known
                live = (upper >= floors[some, None]) & (self.rows != own_rows[some, None])
                for i, most, bounds, can in zip(some, outside, upper, live):
                    places = np.flatnonzero(can)
                    if done == n:                    # the bounds are the scores
                        found[i] = places, bounds[places].astype(np.int64)
                        continue
                    if len(places) > few:
                        # the rows that lead are resolved first: their k-th score is a floor
                        lead = places[np.argpartition(bounds[places], -2 * k)[-2 * k:]]
                        floors[i] = max(floors[i], np.partition(self._resolve(queries[i], lead), k)[k])
                        places = places[bounds[places] >= floors[i]]
                    going_on[i] = most >= floors[i] or len(places) > few
                    if not going_on[i]:
                        found[i] = places, self._resolve(queries[i], places)
            reading = np.flatnonzero(going_on)
        return found

    def _resolve(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        self.resolved += len(places)
        return self.by_row[places] @ query


def _search_in(queries, k: int, part_rows: int):
    """The k best of a task's rows for each of the broadcast queries (rows, ids, matrix)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_rows, q_ids, q_data = queries.value
        none = np.zeros(0, np.int64)
        best = [(none, none, none, none > 0)] * len(q_rows)     # scores, rows, ids, whether the id is there
        floors = np.full(len(q_rows), -np.inf)
        for batch in batches:
            for block in batch.to_pylist():
                rows, ids, valid = np.frombuffer(block["rows"], "<i8"), np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["valid"], "u1") > 0
                ids = np.where(valid, ids, np.iinfo(np.int64).max)
                width = max(block["width"], q_data.shape[1])
                data, wanted = np.zeros((width, len(rows)), np.int64), np.zeros((len(q_rows), width), np.int64)
                data[:block["width"]] = np.frombuffer(block["data"], "<i8").reshape(len(rows), block["width"]).T
                wanted[:, :q_data.shape[1]] = q_data
                step = max(1, min(part_rows, PART_VALUES // max(width, 1)))
                for at in range(0, len(rows), step):
                    span = slice(at, at + step)
                    part = SortedLists(rows[span], np.ascontiguousarray(data[:, span]))
                    for n, (places, new) in enumerate(part.search_all(wanted, q_rows, k, floors)):
                        enough = new >= floors[n]
                        if not enough.any():
                            continue
                        places, new = places[enough] + at, new[enough]
                        scores, own, own_ids, own_valid = (np.concatenate(x) for x in zip(best[n], (new, rows[places], ids[places], valid[places])))
                        top = _top(scores, own_ids, own, k)
                        best[n] = (scores[top], own[top], own_ids[top], own_valid[top])
                        if len(top) == k:
                            floors[n] = scores[top[-1]]
        counts = [len(b[0]) for b in best]
        if sum(counts):
            scores, own, own_ids, own_valid = (np.concatenate([b[c] for b in best]) for c in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q_rows, counts)), pa.array(np.repeat(q_ids, counts)), pa.array(own), pa.array(own_ids, mask=~own_valid), pa.array(scores)],
                names=["query_row", "query_id", "row", "vec_id", "score"])

    return search


def _rounds(queries: DataFrame, round_mb: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The query blocks in groups of about ``round_mb``: (rows, ids, matrix)."""
    sizes = [(r["block"], r["size"]) for r in queries.select("block", F.length("data").alias("size")).orderBy("block").collect()]   # two numbers per 512 queries
    while sizes:
        taken, size = [], 0
        while sizes and (not taken or size + sizes[0][1] <= round_mb << 20):
            block, own = sizes.pop(0)
            taken.append(block)
            size += own
        got = queries.where(F.col("block").isin(taken)).toArrow().to_pylist()
        width = max(b["width"] for b in got)
        parts = [np.frombuffer(b["data"], "<i8").reshape(-1, b["width"]) if b["width"] else np.zeros((len(b["rows"]) // 8, 0), np.int64) for b in got]
        yield (np.concatenate([np.frombuffer(b["rows"], "<i8") for b in got]), np.concatenate([np.frombuffer(b["ids"], "<i8") for b in got]),
               np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]))


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = 16384, query_rows: int = 512, part_rows: int = 2048, round_mb: int = 32) -> DataFrame:
    """For each row for which the column ``is_query`` holds: query_id, rank, vec_id, score of its k best others."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = settle(vectors.where(F.col(vector_col).isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), v.alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query")), "nra-rows")
    blocks = _packed(rows.drop("is_query"), block_rows, "nra-blocks")
    queries = _packed(rows.where("is_query").drop("is_query"), query_rows, "nra-queries")
    schema = "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint"
    found = vectors.sparkSession.createDataFrame([], schema)
    for own in _rounds(queries, round_mb):
        known = vectors.sparkSession.sparkContext.broadcast(own)
        found = found.union(settle(blocks.mapInArrow(_search_in(known, k, part_rows), schema), "nra-found"))
        known.unpersist()
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
