"""Exact duplicates by progressive refinement: length, then hash of a prefix, then hash of the whole text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import BROADCAST_BYTES, ROW, small
from tillstar.session import write_shared

WHITE = r"[\x20\x09-\x0D]+"
PREFIX = 256  # characters whose hash is compared before whole texts are
FILTER_BITS = 1 << 26  # of the filter of surviving groups, 8 MB whatever the number of groups
GROUP_BYTES = 128  # a row of a group in a broadcast table


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def _bit(level: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(level), F.lit(bits)) + 1  # bitmap functions count from 1


def filter_of(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A bitmap of at most ``bits`` bits over the hashes of a column, as rows (``__bucket``, ``__bits``).

    A value that is in the column has its bit set; another one has it with the
    probability that the bitmap is filled.
    """
    bit = _bit(F.col(key), bits)
    return keys.groupBy(F.bitmap_bucket_number(bit).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("__bits")
    )


def passes(rows: DataFrame, key: str, bitmap: DataFrame, bits: int, name: str) -> DataFrame:
    """Add whether a row's key has its bit set; the bitmap, bounded by ``bits``, is broadcast."""
    at = F.bitmap_bit_position(_bit(F.col(key), bits))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("shiftright(__byte, __in_byte) & 1") == 1
    return (
        rows.withColumn("__of", F.bitmap_bucket_number(_bit(F.col(key), bits)))
        .join(F.broadcast(bitmap), F.col("__of") == F.col("__bucket"), "left")
        .withColumns({"__byte": byte, "__in_byte": at.bitwiseAND(7).cast("int")})
        .withColumn(name, F.coalesce(is_set, F.lit(False)))
        .drop("__of", "__bucket", "__bits", "__byte", "__in_byte")
    )


def group_equal(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    prefix: int = PREFIX,
    filter_bits: int = FILTER_BITS,
    all_digests: bool = False,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, settled_by, text_length and digest.

    Texts are equal if they are identical with every run of white space as one
    space.  The refinement:

    1. rows are counted per (length, hash of the first ``prefix`` characters),
       with map-side counts, in one scan that moves no text; a length that
       occurs once settles its row (``settled_by`` = ``length``);
    2. of the other lengths, a prefix hash that occurs once settles its row
       (``prefix``);
    3. only rows of groups left over are hashed whole (SHA-256 as ``digest``)
       and grouped by it (``full``).

    Which rows are left over is told by a bitmap of fixed size, so no table
    that grows with the groups is broadcast and no text is shuffled.  A row that
    the bitmap lets through by chance is hashed for nothing and stays alone.
    ``all_digests`` fills ``digest`` for settled rows too.  A group of any size
    is one row per task before it is shuffled, and its members meet its result
    in a join that adaptive execution splits, or in a broadcast if all groups
    fit ``BROADCAST_BYTES``.

    Of equal texts the row with the smallest ``doc_id`` stays, NULL ids last;
    of rows that repeat that id one stays.  NULL, empty and blank texts: NULL
    equals the empty text, and a text of white space alone equals one space.
    An empty table gives no rows; other columns of ``docs`` are not looked at.
    """
    level = F.struct(
        F.length("__norm").cast("long").alias("length"), F.xxhash64(F.left("__norm", F.lit(prefix))).alias("prefix")
    )
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), normalised(F.col(f"`{text}`")).alias("__norm")).select(
        "doc_id", "__norm", level.alias("__level")
    )

    levels = write_shared(rows.groupBy("__level").agg(F.count("*").alias("n")), "dup-levels")
    lengths = levels.groupBy(F.col("__level.length").alias("length")).agg(F.sum("n").alias("n")).filter("n > 1")
    shared = lengths.select(F.col("length").alias("__shared"))
    left_over = (
        levels.filter("n > 1")
        .join(F.broadcast(shared) if small(shared, 16) else shared, F.col("__level.length") == F.col("__shared"), "left_semi")
        .select("__level")
    )
    survivors = write_shared(filter_of(left_over, "__level", filter_bits), "dup-survivors")
    many = write_shared(filter_of(lengths.select("length"), "length", filter_bits), "dup-lengths")

    full = F.unhex(F.sha2("__norm", 256))
    marked = passes(rows, "__level", survivors, filter_bits, "__left_over")
    marked = passes(marked.withColumn("__length", F.col("__level.length")), "__length", many, filter_bits, "__many")
    settled_by = F.when(F.col("__left_over"), "full").when(F.col("__many"), "prefix").otherwise("length")
    narrow = write_shared(
        marked.select(
            "doc_id",
            F.col("__length").alias("text_length"),
            settled_by.alias("settled_by"),
            (full if all_digests else F.when(F.col("__left_over"), full)).alias("digest"),
        ).withColumn(ROW, F.monotonically_increasing_id()),
        "dup-rows",
    )

    open_rows = narrow.filter("settled_by = 'full'")
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", F.col(ROW).alias("row"))).alias("first")
    groups = write_shared(
        open_rows.groupBy(F.col("digest").alias("__digest")).agg(first, F.count("*").alias("n")).filter("n > 1"), "dup-groups"
    )
    found = open_rows.join(
        F.broadcast(groups) if small(groups, GROUP_BYTES, BROADCAST_BYTES) else groups,
        F.col("digest") == F.col("__digest"),
        "left",
    )
    alone = F.col("n").isNull()
    told = found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(ROW) == F.col("first.row"))).alias("kept"),
        "settled_by",
        "text_length",
        "digest",
    )
    settled = narrow.filter("settled_by <> 'full'").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "settled_by",
        "text_length",
        "digest",
    )
    return settled.unionByName(told)
