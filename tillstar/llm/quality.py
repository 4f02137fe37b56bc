"""Quality rules: text statistics and robust multivariate outliers per language and source."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import BROADCAST_BYTES, ROW, numbered
from tillstar.session import write_shared

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50

# The smallest standard deviation of each transformed statistic that counts as
# spread; a narrower group is taken as this wide, a wider one as it is.  In the
# order of vector().
FLOORS = [0.25, 0.05, 0.02, 0.07, 0.08]
D = len(FLOORS)
LOWER = [(i, j) for i in range(D) for j in range(i + 1)]

HELD = 0.75  # share of a group's rows that the estimate is made of
CONSISTENCY = 1.41  # of that covariance for normal rows: 0.75 / P(chi2(7) <= chi2(5) quantile of 0.75)
STEPS = 4  # concentration steps
OUTLIER = 5.99  # Mahalanobis distance from which a document is rejected: root of chi2(5)'s quantile of 0.999999
LEAST_ROWS = 50  # of a group with an estimate of its own
BINS = 32  # of distances, per factor of e
ROW_BYTES = 500  # of a group's estimate as broadcast


def vector() -> list[Column]:
    """The transformed statistics: size, word length, symbols, repeated lines, repeated words."""
    words = F.greatest("n_words", F.lit(1))
    return [
        F.log1p("n_words"),
        F.log(F.col("word_chars") / words + 1),
        F.log1p(F.col("n_symbols") / words),
        F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        F.col("n_repeat_words") / words,
    ]


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of whole texts."""
    found = docs.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    found = found.withColumn("__w", F.regexp_extract_all("__t", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    found = found.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    w = F.col("__w")
    windows = F.when(
        F.size(w) >= 3,
        F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1))),
    ).otherwise(F.array().cast("array<bigint>"))
    found = found.withColumn("__3", windows)
    ordered = F.when(
        F.size(F.array_distinct("__3")) < F.size("__3"),
        F.sort_array(F.transform("__3", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    found = found.withColumn("__o", ordered)
    o = F.col("__o")
    same = lambda k: F.get(o, k)["h"].eqNullSafe(F.get(o, k + 1)["h"])
    places = F.when(F.size(o) > 0, F.sequence(F.lit(0), F.size(o) - 1)).otherwise(F.array().cast("array<int>"))
    repeated = F.filter(places, lambda k: same(k) | ((k > 0) & same(F.greatest(k - 1, F.lit(0)))))
    found = found.withColumn("__r", F.sort_array(F.transform(repeated, lambda k: F.get(o, k)["i"])))
    r = F.col("__r")
    # Each start covers up to the next one, three words at most; the last one three.
    covered = F.aggregate(
        F.transform(r, lambda i, k: F.least(F.coalesce(F.get(r, k + 1), i + 3) - i, F.lit(3))), F.lit(0), lambda a, b: a + b
    )
    return found.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.translate("__t", SPACE, "")).cast("long"),
            "n_symbols": (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": covered.cast("long"),
        }
    ).drop("__t", "__w", "__lines", "__3", "__o", "__r")


def grouped_rows(rows: DataFrame) -> DataFrame:
    """Adds the group whose estimate judges a row (language and source, or where these have too few
    rows the language, or else all rows) and ``member``, the groups whose estimates it is part of.

    A language's group holds all its rows, those of large sources too, and the last one all rows;
    groups that judge no row are left out.  The counts are of one row per language and source,
    joined back to the rows.
    """
    counts = rows.filter("NOT base_failed").groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    levels = counts.withColumns({"n_lang": F.sum("n").over(by_lang), "least": F.min("n").over(by_lang)})
    levels = write_shared(levels, "levels")
    all_rows = levels.filter(F.col("n_lang") < LEAST_ROWS).limit(1).count() > 0
    large, large_lang = F.col("n") >= LEAST_ROWS, F.col("n_lang") >= LEAST_ROWS
    own, of_lang = F.concat(F.lit("2"), F.to_json(F.struct("lang", "source"))), F.concat(F.lit("1"), F.to_json(F.struct("lang")))
    group = F.when(large, own).when(large_lang, of_lang).otherwise(F.lit("0"))
    member = F.array_compact(
        F.array(F.when(large, own), F.when(large_lang & (F.col("least") < LEAST_ROWS), of_lang), F.lit("0" if all_rows else None))
    )
    levels = levels.select(F.struct("lang", "source").alias("own"), group.alias("group"), member.alias("member"))
    return join_groups(rows.withColumn("own", F.struct("lang", "source")), write_shared(levels, "groups"), "own").drop("own")


def join_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Rows with their group's row; broadcast where the groups are measured to be few.

    Otherwise both sides are shuffled, and adaptive execution splits the rows of a large group.
    """
    few = groups.count() * ROW_BYTES <= BROADCAST_BYTES
    return rows.join(F.broadcast(groups) if few else groups, key, "left")


def moments() -> list[Column]:
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(D)]
    return [F.count("*").alias("n"), *sums, *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in LOWER)]


def estimate(sums: DataFrame, factor: float) -> DataFrame:
    """Centre m and inverse Cholesky factor k of each group's covariance, from its sums."""
    made = sums.select("group", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(D)], *[
        (F.greatest((F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") / F.col("n")) * factor, F.lit(FLOORS[i] ** 2))
         if i == j else
         (F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") / F.col("n")) * factor).alias(f"c{i}{j}")
        for i, j in LOWER
    ])
    return inverse_factor(made)


def inverse_factor(made: DataFrame) -> DataFrame:
    """From columns c (covariance) the inverse of its Cholesky factor, in columns k; one step a column."""
    total = lambda terms: reduce(add, terms, F.lit(0.0))
    for i, j in LOWER:
        rest = F.col(f"c{i}{j}") - total(F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j))
        value = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
        made = made.withColumn(f"l{i}{j}", value)
    for j in range(D):
        made = made.withColumn(f"k{j}{j}", 1 / F.col(f"l{j}{j}"))
        for i in range(j + 1, D):
            value = total(F.col(f"l{i}{k}") * F.col(f"k{k}{j}") for k in range(j, i))
            made = made.withColumn(f"k{i}{j}", -value / F.col(f"l{i}{i}"))
    return made.select("group", *[f"m{i}" for i in range(D)], *[f"k{i}{j}" for i, j in LOWER])


def squared_distance() -> Column:
    parts = []
    for i in range(D):
        z = reduce(add, [F.col(f"k{i}{j}") * (F.col(f"x{j}") - F.col(f"m{j}")) for j in range(i + 1)])
        parts.append(z * z)
    return reduce(add, parts)


def first_estimate(rows: DataFrame) -> DataFrame:
    """Centre and spread of each statistic alone: median and quartiles, counted on a grid.

    The grid's step is a quarter of the smallest spread, so a group has few cells
    however many rows it has.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(f"x{i}") / (f / 4)).alias("cell")) for i, f in enumerate(FLOORS)])
    ).alias("at")
    counted = rows.select("group", cells).groupBy("group", "at.i", "at.cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy("group", "i").orderBy("cell")
    shares = counted.select(
        "group", "i", "cell", F.sum("n").over(order).alias("up_to"), F.sum("n").over(Window.partitionBy("group", "i")).alias("all")
    )
    at = lambda share: F.min(F.when(F.col("up_to") >= F.col("all") * share, F.col("cell")))
    quartiles = shares.groupBy("group", "i").agg(at(0.25).alias("low"), at(0.5).alias("middle"), at(0.75).alias("high"))
    one = lambda i, value: F.max(F.when(F.col("i") == i, value))
    made = quartiles.groupBy("group").agg(
        *[one(i, (F.col("middle") + 0.5) * (f / 4)).alias(f"m{i}") for i, f in enumerate(FLOORS)],
        *[one(i, F.greatest(F.pow((F.col("high") - F.col("low")) * (f / 4) / 1.349, F.lit(2.0)), F.lit(f * f))).alias(f"c{i}{i}") for i, f in enumerate(FLOORS)],
    )
    made = made.withColumns({f"c{i}{j}": F.lit(0.0) for i, j in LOWER if i != j})
    return inverse_factor(made)


def concentrate(rows: DataFrame, known: DataFrame) -> DataFrame:
    """A concentration step: the estimate of the rows nearest to the known one.

    Distances are counted in bins, with the sums of each bin's rows, in one pass
    that combines on the map side.  The nearest bins up to the held share make
    the next estimate, so no group's rows are ever gathered or sorted.
    """
    bin_of = F.floor(F.log(squared_distance() + 1e-6) * BINS).cast("int")
    cells = join_groups(rows, known, "group").groupBy("group", bin_of.alias("bin")).agg(*moments())
    before = F.sum("n").over(Window.partitionBy("group").orderBy("bin")) - F.col("n")
    everything = F.sum("n").over(Window.partitionBy("group"))
    near = cells.withColumns({"before": before, "everything": everything}).filter(F.col("before") < F.col("everything") * HELD)
    names = ["n", *[f"s{i}" for i in range(D)], *[f"p{i}{j}" for i, j in LOWER]]
    return estimate(near.groupBy("group").agg(*[F.sum(x).alias(x) for x in names]), CONSISTENCY)


def judge(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    outlier: float = OUTLIER,
) -> DataFrame:
    """One row per document: its number, id, statistics, base_failed, distance and kept.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    three-word windows.  Other documents are judged by the Mahalanobis distance
    of their transformed statistics from the minimum-covariance-determinant
    estimate of their language and source (from the documents that pass the base
    rules); ``kept`` is false from ``outlier`` on.  The estimate starts from
    medians and quartiles and takes ``STEPS`` concentration steps on the nearest
    three quarters; a spread under its floor counts as the floor, so constant
    statistics do no harm.

    Groups with under ``LEAST_ROWS`` rows use the estimate of all rows of their
    language, or if these are too few as well that of all rows.  A NULL language or source is a group like any
    other.  NULL, empty and wordless texts fail the base rules.  Repeated rows
    are judged one by one, an empty table gives no rows.
    """
    named = docs.select(
        F.col(doc_id).alias("__id"), F.col(text).alias("__text"), F.col(lang).alias("lang"), F.col(source).alias("source")
    )
    rows = with_statistics(named, "__text").drop("__text")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEAT_PERCENT)
    rows = rows.withColumn("base_failed", failed)
    vectors = {f"x{i}": value.cast("double") for i, value in enumerate(vector())}
    rows = numbered(rows, *rows.columns).withColumns(vectors)
    rows = write_shared(rows, "statistics")
    rows = grouped_rows(rows)
    passed = rows.filter("NOT base_failed").select(F.explode("member").alias("group"), *vectors)
    known = write_shared(first_estimate(passed), "estimate")
    for _ in range(STEPS):
        known = write_shared(concentrate(passed, known), "estimate")
    judged = join_groups(rows, known, "group").withColumn("distance", F.sqrt(squared_distance()))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) < outlier)
    return judged.select(
        ROW, F.col("__id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", F.when(~F.col("base_failed"), F.col("distance")).alias("distance"), kept.alias("kept"),
    )
