"""Exact de-duplication by two-pass Bloom filtering.

Pass one marks, for each text digest, three bits of one 32,768-bit block of a
blocked Bloom filter and counts how often each bit is marked. Bits marked at least
twice form the filter of *possibly repeated* digests. Pass two probes it: digests
that miss are unique and pass straight through; only possible repeats shuffle.

Everything is DataFrame functions. The filter is broadcast; its size is a power of
two between 128 KiB and ``max_filter_mb``, so the broadcast is bounded. Beyond that bound
more unique rows pass the filter and shuffle; the result is the same.

Defined cases: null text counts as empty and empty texts are equal; a null doc_id
sorts after all others; rows that repeat the same id and an equal text of the same
length tie, and one of them stays. Columns other than the named ones are ignored by
``find_copies`` and kept by ``drop_copies``. Texts of any length are compared by their digests. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, free_name, settle

BLOCK_BITS = 32768
BITS_PER_ROW = 24
MARKS = 3
SALTS = 64


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text without white space."""
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), SPACES, "").cast("binary"), 256)


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks))


def _marks(digest: Column) -> Column:
    """Three bit positions inside the block, from other parts of the digest."""
    return F.array_distinct(F.array(*(
        F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(BLOCK_BITS)).cast("int") for k in range(1, MARKS + 1))))


def filter_blocks(n_rows: int, max_filter_mb: int) -> int:
    """Blocks of the filter: 24 bits a row, rounded up to a power of two, bounded."""
    blocks = 32
    while blocks * BLOCK_BITS < n_rows * BITS_PER_ROW and blocks * 2 * BLOCK_BITS <= max_filter_mb * 8 << 20:
        blocks *= 2
    return blocks


def bit_blocks(digests: DataFrame, blocks: int, least: int = 1) -> DataFrame:
    """Bit map per block (column ``bits``) of the positions that at least ``least`` rows mark."""
    marked = digests.select(_block(F.col("digest"), blocks).alias("block"), F.explode(_marks(F.col("digest"))).alias("bit"))
    often = marked.groupBy("block", "bit").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return often.groupBy("block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))


def repeated_filter(digests: DataFrame, blocks: int) -> DataFrame:
    """The filter of possibly repeated digests: positions that at least two rows mark."""
    return bit_blocks(digests, blocks, least=2)


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) != 0


def split_by_filter(rows: DataFrame, bits: DataFrame, blocks: int, flag: str) -> DataFrame:
    """Add the boolean ``flag``: all marks of ``digest`` are set, so it may be repeated."""
    block, marks, own = (free_name([*rows.columns, flag], x) for x in ("block", "marks", "bits"))
    probed = (
        rows.withColumn(block, _block(F.col("digest"), blocks)).withColumn(marks, _marks(F.col("digest")))
        .join(F.broadcast(bits.select(F.col("block").alias(block), F.col("bits").alias(own))), block, "left"))
    # own is null where no bit of the block is marked twice
    return probed.withColumn(
        flag, F.coalesce(F.forall(F.col(marks), lambda p: _bit_is_set(F.col(own), p)), F.lit(False))
    ).drop(block, marks, own)


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chars, maybe_repeated.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    digests = settle(docs.select(
        F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars")), "exact-digests")
    blocks = filter_blocks(digests.count(), max_filter_mb)
    split = split_by_filter(digests, repeated_filter(digests, blocks), blocks, "maybe")
    once = split.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("digest").alias("text_sha256"), "n_chars", F.lit(False).alias("maybe_repeated"))
    return once.unionByName(_resolve(settle(split.where("maybe"), "exact-maybe")))


def _order(prefix: str = "") -> Column:
    """The smallest of these stays: most characters, then smallest id, null last."""
    return F.struct(-F.col(f"{prefix}n_chars"), F.col(f"{prefix}doc_id").isNull(), F.col(f"{prefix}doc_id"))


def _resolve(maybe: DataFrame) -> DataFrame:
    """Groups of the possibly repeated rows. Repeated rows are counted before the
    shuffle, and a group is dealt over up to 64 salts, so no task takes a hot group."""
    members = (
        maybe.groupBy("digest", "doc_id", "n_chars").agg(F.count("*").alias("rows"))
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_chars"), F.lit(SALTS))))
    members = settle(members, "exact-members")
    parts = members.groupBy("digest", "salt").agg(F.sum("rows").alias("n"), F.min(_order()).alias("best"))
    groups = parts.groupBy("digest").agg(
        F.sum("n").alias("group_size"), F.min("best").alias("best"), F.collect_set("salt").alias("salts"))
    spread = settle(groups.select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best").alias("best"),
                                  F.explode("salts").alias("salt")), "exact-groups")
    joined = members.join(spread, ["digest", "salt"])
    copies = joined.select("*", F.posexplode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("nth", "_n"))
    return copies.select(
        "doc_id", "keep_id", "group_size", ((F.col("nth") == 0) & (_order() == F.col("best"))).alias("kept"),
        F.col("digest").alias("text_sha256"), "n_chars", F.lit(True).alias("maybe_repeated"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_mb: int = 32) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are.

    Rows whose digest misses the filter are never shuffled. Of a group's rows with
    the same length and id, which only differ in other columns or in white space, the smallest row stays.
    """
    decided = find_copies(docs, id_col, text_col, max_filter_mb)
    keepers = settle(decided.where("kept AND maybe_repeated").select(
        F.col("text_sha256").alias("digest"), F.col("doc_id").alias("k_id"), F.col("n_chars").alias("k_chars")), "exact-keepers")
    names = docs.columns
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), text_digest(F.col(text_col)).alias("digest"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_chars"), F.col(id_col).alias("doc_id"))
    blocks = filter_blocks(decided.count(), max_filter_mb)
    bits = settle(repeated_filter(decided.select(F.col("text_sha256").alias("digest")), blocks), "exact-filter")
    split = split_by_filter(packed, bits, blocks, "maybe")
    once = split.where(~F.col("maybe")).select("row.*")
    hit = split.where("maybe").join(keepers, "digest").where(
        F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("n_chars") == F.col("k_chars")))
    return once.unionByName(hit.groupBy("digest").agg(F.min("row").alias("row")).select("row.*"))
