"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is counted in equal blocks of a few words, whose size does not depend on the tables, so
small sources have blocks too. Blocks go to the sources one after the other, each to the highest quotient
target / (2 k - 1); since that sequence only grows with the number of blocks, its
consecutive parts are the integer quotas of consecutive output shards. Documents of a
source lie in a seeded order, one after the other, and the stream of their words is run through in a circle from a
seeded place on: the first shard takes the blocks of its quota, the next one goes on from
there. So a source gives exactly the words of its quotas, each document is taken equally often
but for the beginning and end of the last round, and only documents where a shard, a round or the mix ends are cut.

Everything is DataFrame functions. A stream position needs a running sum per source;
it is taken inside cells of the seeded order (about the square root of the number of
documents per source) and then over cells, so a hot source is spread over many tasks.
Repeated rows are counted before the shuffle. Sources are ranked in one window: their number, not that of
documents, must fit a task.

Defined cases: null text has no words; a null source is a source of its own and comes
last; a source without words has target 0; documents without words take 0 words; a null or repeated id is a document like any
other; texts of any length are handled as a whole, other columns are kept as they are.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating, and the most often a document is taken.
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3


@dataclass(frozen=True)
class MixParams:
    seed: int = 17
    shards: int = 8
    #: Words per block.
    block_words: int = 4
    #: Sources, ids and sizes that several rows share are broadcast up to so many.
    broadcast_runs: int = 50_000


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Sorts by code point with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def _id_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def source_targets(sources: DataFrame) -> DataFrame:
    """Add weight and target to one row per source (skey, source_size).

    Targets share all words by weight and stop at three times the source's size; the
    excess goes to the others by weight. Taken in the order in which sources reach
    their stop, a source stops exactly if it would stop at the level that the ones
    before it leave to all the rest.
    """
    order = Window.orderBy("skey")
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1))
    capped = weighed.withColumn("cap", F.col("source_size") * MOST_REPEATS)
    by_stop = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    before, everything = by_stop.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    levels = capped.select(
        "*", ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
              / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"))
    level = F.max("level").over(everything)
    return levels.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).drop("level", "cap")


def shard_quotas(targets: DataFrame, total: int, block: int, shards: int) -> DataFrame:
    """Blocks of each source in each output shard: skey, shard, quota.

    With n sources and c blocks to give, the seats above T / (c - n/2) are surely among
    the c highest quotients and those below T / (c + n/2) surely not; only the seats
    between the two, about 2 n, are put in order.
    """
    blocks = int(total / block + 0.5)
    ends = [(k, blocks * (k + 1) // shards) for k in range(shards)]
    live = targets.where("target > 0").withColumn("_n", F.count("*").over(Window.partitionBy()))
    at = live.withColumn("end", F.explode(F.array(*(F.struct(F.lit(k).alias("shard"), F.lit(c).cast("long").alias("c")) for k, c in ends))))
    seat = lambda sign: F.floor(F.col("target") * (F.col("end.c") + sign * (F.col("_n") / 2)) / F.lit(float(total)) + 0.5).cast("long")
    bounds = at.select("skey", "target", "source_size", F.col("end.shard").alias("shard"), F.col("end.c").alias("c"),
                       F.greatest(seat(-1) - 1, F.lit(0)).alias("low"), (seat(1) + 1).alias("high"))
    shard = Window.partitionBy("shard")
    open_seats = bounds.withColumn("left", F.col("c") - F.sum("low").over(shard)).select(
        "*", F.explode(F.sequence(F.col("low") + 1, F.greatest(F.col("high"), F.col("low") + 1))).alias("k"))
    ranked = open_seats.withColumn(
        "place", F.row_number().over(shard.orderBy((F.col("target") / (F.col("k") * 2 - 1)).desc(), "skey", "k")))
    given = ranked.groupBy("skey", "shard").agg(
        (F.first("low") + F.sum((F.col("place") <= F.col("left")).cast("long"))).alias("upto"),
        F.first("source_size").alias("source_size"))
    # no source gives more than all its blocks three times
    upto = F.least(F.col("upto"), F.ceil(F.col("source_size") / block) * MOST_REPEATS)
    so_far = given.select("skey", "shard", upto.cast("long").alias("upto"))
    by_source = Window.partitionBy("skey").orderBy("shard")
    return so_far.select("skey", "shard", (F.col("upto") - F.coalesce(F.lag("upto").over(by_source), F.lit(0))).alias("quota"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _word(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def _quotas(sources: DataFrame, total: int, params: MixParams) -> DataFrame:
    """skey, source_size, target, ends: after each shard, the words that the source has given."""
    targets = source_targets(sources)
    quotas = shard_quotas(targets, max(total, 1), params.block_words, params.shards)
    by_shard = quotas.groupBy("skey").agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "quota"))), lambda q: q["quota"]).alias("quotas"))
    upto = F.transform(F.sequence(F.lit(1), F.lit(params.shards)), lambda k: F.least(
        F.aggregate(F.slice("quotas", F.lit(1), k), F.lit(0).cast("long"), lambda a, q: a + q) * params.block_words, F.col("source_size") * MOST_REPEATS))
    none = F.array_repeat(F.lit(0).cast("long"), params.shards)
    return targets.join(by_shard, "skey", "left").select("skey", "source_size", "target", F.when(F.col("quotas").isNull(), none).otherwise(upto).alias("ends"))


def plan_mix(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per distinct (source, doc_id, size): skey, did, doc_id, size, copies, at (first word's
    place in the source's circle), source_size, target, ends. Reruns agree: all follows from values and the seed."""
    sized = docs.select(_source_key(F.col(source_col)).alias("skey"), F.col(id_col).alias("doc_id"), count_words(F.col(text_col)).alias("size"))
    runs = settle(
        sized.groupBy("skey", "doc_id", "size").agg(F.count("*").alias("copies"))
        .withColumn("did", _id_key(F.col("doc_id"))).withColumn("h", _word(F.lit(str(params.seed)), F.col("did"))), "mix-runs")
    sources = settle(runs.groupBy("skey").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), "mix-sources")
    total, n_runs = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], runs.count()
    # the circle begins at a block's beginning
    blocks = F.greatest(F.ceil(F.col("source_size") / params.block_words), F.lit(1))
    seeded = F.conv(F.substring(_word(F.lit(str(params.seed)), F.lit("start"), F.col("skey")), 1, 13), 16, 10).cast("long")
    per_source = settle(_quotas(sources, total, params).withColumn("start", seeded % blocks * params.block_words), "mix-plan")
    digits = 0
    while 16 ** digits < n_runs ** 0.5:
        digits += 1
    runs = runs.withColumn("cell", F.substring("h", 1, digits))
    cells = runs.groupBy("skey", "cell").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    earlier = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = settle(cells.withColumn("cell_at", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
                   .join(per_source, "skey"), "mix-cells")
    inside = Window.partitionBy("skey", "cell").orderBy("h", "did", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("run_at", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0)))
    at = F.col("cell_at") + F.col("run_at") - F.col("start")
    circle = F.greatest("source_size", F.lit(1))
    return placed.join(cells, ["skey", "cell"]).withColumn("at", F.pmod(at, circle)).drop("cell", "h", "cell_at", "run_at", "start")


def mix_quotas(docs: DataFrame, params: MixParams = MixParams(), text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The integer quotas: skey, shard, quota (blocks)."""
    sources = settle(docs.select(_source_key(F.col(source_col)).alias("skey"), count_words(F.col(text_col)).alias("size"))
                     .groupBy("skey").agg(F.sum("size").alias("source_size")), "mix-sources")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    return shard_quotas(source_targets(sources), max(total, 1), params.block_words, params.shards)


def _taken(begin: Column, size: Column) -> Column:
    """Words taken of a document that begins at ``begin`` of the circle."""
    circle, given = F.greatest("source_size", F.lit(1)), F.element_at("ends", -1)
    before = lambda x: _div(given, circle) * x + F.least(x, given % circle)
    end = begin + size
    return F.when(end <= circle, before(end) - before(begin)).otherwise(before(circle) - before(begin) + before(end - circle))


def _begin() -> Column:
    """Where the nth of rows with equal source, id and size begins."""
    return F.pmod(F.col("at") + F.col("nth") * F.col("size"), F.greatest("source_size", F.lit(1)))


def mix_amounts(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    runs = plan_mix(docs, params, id_col, text_col, source_col)
    each = runs.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return each.select("doc_id", "size", "source_size", "target", _taken(_begin(), F.col("size")).alias("taken"))


def _pieces(begin: Column, size: Column, shards: int) -> Column:
    """What is taken of a document, in the order of shards: array of (shard, words from, to)."""
    circle, ends = F.col("source_size"), F.col("ends")
    rounds = F.sequence(F.lit(0).cast("long"), _div(F.element_at("ends", -1), F.greatest(circle, F.lit(1))))
    whole = F.least(size, circle - begin)
    # (place in the circle, first word, last word): the second is the part beyond the circle's end
    parts = F.array(F.struct(begin.alias("at"), F.lit(0).cast("long").alias("lo"), whole.alias("hi")),
                    F.struct(F.lit(0).cast("long").alias("at"), whole.alias("lo"), size.alias("hi")))

    def of_shard(k: Column, j: Column, p: Column) -> Column:
        low = F.when(k == 0, F.lit(0).cast("long")).otherwise(F.element_at(ends, F.greatest(k, F.lit(1))))
        shift = p["lo"] - (p["at"] + j * circle)   # from the source's words to the document's
        return F.struct(k.alias("shard"), F.greatest(p["lo"], low + shift).alias("lo"), F.least(p["hi"], F.element_at(ends, k + 1) + shift).alias("hi"))

    all_pieces = F.flatten(F.flatten(F.transform(rounds, lambda j: F.transform(parts, lambda p: F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: of_shard(k, j, p))))))
    return F.filter(all_pieces, lambda x: x["lo"] < x["hi"])


def mix_rows(docs: DataFrame, params: MixParams = MixParams(), id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", shard_col: str | None = None) -> DataFrame:
    """The mix itself, with the columns of ``docs`` (and, if asked for, the output shard): each
    document as it is whenever a shard takes all of it, and where it is cut the words that
    the shard takes, joined by single spaces. Other columns are kept as they are."""
    names = docs.columns
    runs = settle(plan_mix(docs, params, id_col, text_col, source_col).drop("doc_id", "target"), "mix-places")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), _source_key(F.col(source_col)).alias("skey"),
                         _id_key(F.col(id_col)).alias("did"), count_words(F.col(text_col)).alias("size")).where("size > 0")
    keys = ["skey", "did", "size"]
    alone = packed.join(runs.where("copies = 1"), keys).withColumn("nth", F.lit(0).cast("long"))
    # rows that share source, id and size: equal ones are counted first, then all take their turns
    several = runs.where("copies > 1")
    if several.count() <= params.broadcast_runs:
        several = F.broadcast(several)   # so the texts are not shuffled a second time
    turns = Window.partitionBy(*keys).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    rows = packed.join(several, keys)
    shared = rows.groupBy(*(c for c in rows.columns if c != "copies")).agg(F.count("*").alias("copies"))
    shared = shared.withColumn("first", F.coalesce(F.sum("copies").over(turns), F.lit(0)))
    shared = shared.withColumn("nth", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1))).drop("first")
    each = alone.unionByName(shared.select(*alone.columns)).where(F.element_at("ends", -1) > 0)
    taken = each.select("row", "size", F.explode(_pieces(_begin(), F.col("size"), params.shards)).alias("piece"))
    text = F.col(f"row.`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    cut = F.array_join(F.slice(words, (F.col("piece.lo") + 1).cast("int"), (F.col("piece.hi") - F.col("piece.lo")).cast("int")), " ")
    new_text = F.when(F.col("piece.hi") - F.col("piece.lo") == F.col("size"), text).otherwise(cut)
    shard = [F.col("piece.shard").cast("int").alias(shard_col)] if shard_col is not None else []
    return taken.select(*(new_text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in names), *shard)
