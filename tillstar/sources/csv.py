"""Headered CSV files read against declared schemas, without losing a value silently."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.sizes import fits
from tillstar.session import side_by_side, write_shared
from tillstar.sources.schemas import SCHEMAS

# Text column that tells what could not be read of a record; NULL in good ones.
BAD_RECORD = "_bad_record"


def _whole_number(kind: str) -> Callable[[Column], Column]:
    """Whole numbers, also as exports of nullable columns write them (``12.0``)."""
    return lambda text: F.coalesce(text.try_cast(kind), F.regexp_replace(text, r"^([+-]?\d+)\.0*$", "$1").try_cast(kind))


def _boolean(text: Column) -> Column:
    word = F.lower(text)
    return F.when(word == "true", True).when(word == "false", False)


PARSERS: dict[str, Callable[[Column], Column]] = {
    "bigint": _whole_number("bigint"),
    "int": _whole_number("int"),
    "boolean": _boolean,
}


def _parsed(name: str, kind: T.DataType) -> Column:
    """A column's value; NULL where its text says nothing or something else."""
    text = F.trim(F.col(f"`{name}`"))
    parse = PARSERS.get(kind.simpleString(), lambda c: c.try_cast(kind))
    return F.when(text != "", parse(text))


QUOTE = '"'
RANGE_BYTES = 512  # of a byte range in the table of ranges


def _lines(spark: SparkSession, path: str, skip_corrupt: bool) -> DataFrame:
    """Every line, its file, the byte range it was read from, and a number that grows within the range."""
    lines = spark.read.options(lineSep="\n", ignoreCorruptFiles=skip_corrupt).text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_line"),
        (quotes % 2).alias("_odd"),
        "value",
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """Per byte range: whether it begins and ends inside a field, and in which range the record open at its begin began.

    Quotes are counted where the lines are read; prefix sums run over the
    ranges of one file, a row each.
    """
    counted = lines.groupBy("_file", "_range").agg(F.sum("_odd").alias("_odds"))
    whole, earlier = Window.partitionBy("_file"), Window.partitionBy("_file").orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_odds").over(earlier), F.lit(0))
    states = counted.select(
        "_file",
        "_range",
        "_odds",
        (before % 2 == 1).alias("_inside"),
        ((before + F.col("_odds")) % 2 == 1).alias("_ends_inside"),
        (F.min("_range").over(whole) == F.col("_range")).alias("_is_first"),
        (F.sum("_odds").over(whole) % 2 == 1).alias("_unpaired"),
    )
    # A range that is inside one field from begin to end opens no record of its own.
    opens = F.when(F.col("_ends_inside") & (~F.col("_inside") | (F.col("_odds") > 0)), F.col("_range"))
    return states.withColumn("_opened_in", F.last(opens, ignorenulls=True).over(earlier)).drop("_odds")


def whole_records(spark: SparkSession, path: str, skip_corrupt: bool = False) -> DataFrame:
    """The records of CSV files whose quoted fields may hold line breaks: (``_file``, ``_is_header``, ``record``).

    Spark reads the files in byte ranges, as lines.  A line break ends a record
    where the quotes before it in the file are even in number (a quote in a
    quoted field is doubled).  Quotes are counted per range first, which moves
    no text, and prefix sums tell the state at each range's begin.  Then the
    lines of a range meet in one task, a running count cuts them, and a record
    of several ranges is put together by the range it began in.

    A file whose quotes do not pair is an error: it has quotes inside unquoted
    fields, and only a reader of whole files can tell what they mean.
    """
    lines = _lines(spark, path, skip_corrupt)
    ranges = write_shared(_ranges(lines), "csv-ranges")
    unpaired = ranges.filter("_unpaired").select("_file").first()
    if unpaired:
        raise ValueError(f"the quotes of {unpaired[0]} do not pair; read it whole, by one task")

    told = ranges.withColumnsRenamed({"_file": "_of_file", "_range": "_of_range"})
    same = (F.col("_file") == F.col("_of_file")) & (F.col("_range") == F.col("_of_range"))
    dealt = lines.repartition("_file", "_range").join(F.broadcast(told) if fits(told, RANGE_BYTES) else told, same)
    whole = Window.partitionBy("_file", "_range")
    through = whole.orderBy("_line")
    so_far = F.sum("_odd").over(through) + F.col("_inside").cast("int")
    begins, ends = (so_far - F.col("_odd")) % 2 == 0, so_far % 2 == 0
    cut = dealt.select(
        "*", begins.alias("_begins"), ends.alias("_ends"), F.row_number().over(through).alias("_place")
    ).withColumn("_began", F.last(F.when(F.col("_begins"), F.col("_line")), ignorenulls=True).over(through))
    # The record that a range leaves open goes by the range alone, so that its lines elsewhere can name it.
    left_open = F.col("_ends_inside") & (F.max("_began").over(whole) == F.col("_began"))
    named = (
        F.when(F.col("_began").isNull(), F.struct(F.col("_opened_in").alias("range"), F.lit(-1).cast("long").alias("line")))
        .when(left_open, F.struct(F.col("_range").alias("range"), F.lit(-1).cast("long").alias("line")))
        .otherwise(F.struct(F.col("_range").alias("range"), F.col("_began").alias("line")))
    )
    pieces = cut.select(
        "_file",
        "_range",
        "_line",
        "value",
        named.alias("_record"),
        (F.col("_begins") & F.col("_ends")).alias("_single"),
        (F.col("_is_first") & (F.col("_place") == 1)).alias("_is_header"),
    )
    single = pieces.filter("_single").select("_file", "_is_header", F.col("value").alias("record"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("_range", "_line", "value"))), lambda x: x["value"])
    several = (
        pieces.filter("NOT _single")
        .groupBy("_file", "_record")
        .agg(F.max("_is_header").alias("_is_header"), F.array_join(in_order, "\n").alias("record"))
        .drop("_record")
    )
    return single.unionByName(several).withColumn("record", F.regexp_replace("record", "\r$", ""))


def _plain_path(path: str) -> str:
    """A file's path from a listing or an error, which escape it: unescaped, with one slash behind the scheme."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path))


def broken_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder that cannot be read to their end.

    All files are read as text, which stops at the first broken one and names
    it; the others are read again, so it takes one reading more than there are
    broken files.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "_metadata.file_path")
    # The driver lists the files to read them anyway.
    left = {_plain_path(row.file_path): row.path for row in listed.collect()}
    broken = []
    while left:
        try:
            spark.read.text(list(left.values())).agg(F.count(F.lit(1))).collect()
            break
        except Exception as error:
            named = re.search(r"\[FAILED_READ_FILE\.\w+\] Encountered error while reading file (.+?)\.\s+SQLSTATE", str(error))
            found = named and next((f for f in left if f == _plain_path(named[1])), None)
            if not found:
                raise
            broken.append(left.pop(found))
    return sorted(broken)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Every file at ``path`` with ``bytes``, ``lines`` that can be read of it, and ``state``.

    ``state`` is ``read``, ``in part`` (it breaks off; what stands before that is
    read) or ``left out``: what reading with ``skip_corrupt`` makes of the file.
    Files are listed without reading them, and lines are counted per file.
    """
    name = F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):/+", "$1:/")
    listed = spark.read.format("binaryFile").load(path).select(name.alias("file"), F.col("_metadata.file_size").alias("bytes"))
    lines = spark.read.option("ignoreCorruptFiles", True).text(path).groupBy(name.alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    broken = spark.createDataFrame([(f,) for f in broken_files(spark, path)], "_broken string")
    plain = F.expr("url_decode(replace(file, '+', '%2B'))")
    state = F.when(F.col("_broken").isNull(), "read").when(F.coalesce("_n", F.lit(0)) > 0, "in part").otherwise("left out")
    return (
        listed.join(lines, F.col("file") == F.col("_of"), "left")
        .join(broken, plain == F.col("_broken"), "left")
        .select("file", "bytes", F.coalesce("_n", F.lit(0)).alias("lines"), state.alias("state"))
    )


def _split_by_quotes(spark: SparkSession, path: str, header: list[str], skip_corrupt: bool) -> DataFrame:
    """The fields of :func:`whole_records` as text, with ``_bad_record``; every file's header is checked."""
    fields = T.StructType([T.StructField(n, T.StringType()) for n in header])
    with_bad = T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())])
    ddl = lambda kind: ", ".join(f"`{f.name.replace('`', '``')}` string" for f in kind)
    options = {"escape": QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    records = whole_records(spark, path, skip_corrupt)
    names = F.from_csv("record", ddl(fields), {"escape": QUOTE})
    as_given = F.array(*(names[n] for n in header)).eqNullSafe(F.array(*map(F.lit, header)))
    other = F.raise_error(F.concat(F.lit("another header in "), F.col("_file"), F.lit(": "), F.col("record")))
    is_data = F.when(~F.col("_is_header"), F.col("record") != "").when(as_given, False).otherwise(other.cast("boolean"))
    return records.filter(is_data).select(F.from_csv("record", ddl(with_bad), options).alias("_row")).select("_row.*")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    multi_line: bool = True,
    skip_corrupt: bool = False,
    keep_bad: bool = False,
    by_quotes: bool = False,
) -> DataFrame:
    """Read one headered CSV file, or a folder of them, by column name.

    Columns may stand in any order, the same in all files of a folder: every
    file's header is checked, and one that differs is an error.  Columns not in
    ``schema`` come along as text.  ``multi_line`` allows line breaks inside
    quoted fields, which keeps Spark from splitting a file: turn it off for
    files that have none, or turn ``by_quotes`` on, which cuts files with line
    breaks at the ends of their records (:func:`whole_records`), so that many
    tasks read one.  ``skip_corrupt`` leaves out files that cannot be read.

    A value that is no such number, date or boolean, and a record with too many
    or too few fields, make a bad record.  Reading one is an error; with
    ``keep_bad`` it stays, with NULL for the value, and ``_bad_record`` holds the
    values in question or the whole record.  ``12.0`` is a whole number.
    """
    plain = {"header": True, "escape": '"', "ignoreCorruptFiles": skip_corrupt}
    try:
        header = spark.read.options(**plain).csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from error
        raise
    declared = {f.name: f.dataType for f in T.StructType.fromDDL(schema)}
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")

    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*header, BAD_RECORD]])
    options = plain | {
        "multiLine": multi_line,
        "enforceSchema": False,
        "columnNameOfCorruptRecord": BAD_RECORD,
    }
    if by_quotes:
        raw = _split_by_quotes(spark, path, header, skip_corrupt)
    else:
        raw = spark.read.schema(texts).options(**options).csv(path)

    typed = {n: kind for n, kind in declared.items() if not isinstance(kind, T.StringType)}
    # Values are computed once, beside their texts; only a record with a bad one has its texts written out.
    valued = raw.select("*", *(_parsed(n, kind).alias(f"_value of {n}") for n, kind in typed.items()))
    bad = [(F.trim(F.col(f"`{n}`")) != "") & F.col(f"`_value of {n}`").isNull() for n in typed]
    unread = [F.when(test, F.concat(F.lit(f"{n}="), F.col(f"`{n}`"))) for n, test in zip(typed, bad)]
    told = F.when(reduce(or_, bad), F.concat_ws("; ", *unread)) if typed else F.lit(None).cast("string")
    columns = [
        *(F.col(f"`_value of {n}`").alias(n) if n in typed else F.col(f"`{n}`") for n in header),
        F.coalesce(F.col(BAD_RECORD), told).alias(BAD_RECORD),
    ]
    if keep_bad:
        return valued.select(*columns)
    # The test reads what is computed here: pushed below a plain projection it would compute all values again.
    rows = valued.select(F.inline(F.array(F.struct(*columns))))
    bad = F.raise_error(F.concat(F.lit(f"bad record in {path}: "), F.col(BAD_RECORD))).cast("boolean")
    return rows.filter(F.when(F.col(BAD_RECORD).isNull(), True).otherwise(bad)).drop(BAD_RECORD)


def extract_all(spark: SparkSession, folder: str, **options: bool) -> dict[str, DataFrame]:
    """The twelve source tables, each from ``<folder>/<table>.csv``, a file or a folder of files."""
    folder = folder.rstrip("/")
    return side_by_side(
        lambda name: read_csv(spark, f"{folder}/{name}.csv", SCHEMAS[name], **options), SCHEMAS
    )
