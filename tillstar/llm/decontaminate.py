"""Benchmark decontamination by a positional inverted index of the training texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import ROW, lower_ascii, numbered
from tillstar.session import write_shared

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13  # words of a benchmark window
TERM_BYTES = 120  # of a benchmark term as broadcast
WINDOW_BYTES = 200  # of a window's number and its rarest term as broadcast
END = ""  # term of the posting that stands behind a document's last word


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), 0), F.array().cast("array<string>"))


def item_windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Rows (item, window, place, term): distinct windows of each item, one row per word.

    Equal windows of several items share a window number, the hash of their words.
    """
    found = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("words"))
    found = found.filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    windows = found.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, size))).alias("words"))
    return windows.distinct().withColumn("window", F.sha2(F.array_join("words", " "), 256))


def postings_of(docs: DataFrame, terms: DataFrame, few: bool, doc_id: str, text: str) -> DataFrame:
    """The index: rows (row, id, term, position), sorted by term within each part of the documents.

    Only terms of the benchmark are held.  Every document also has an end
    posting at the position behind its last word, so its length is in the index
    and documents without any benchmark term are too.
    """
    named = numbered(
        docs.select(F.col(doc_id).alias("__id"), words(F.col(text)).alias("__words")), "__id", "__words"
    )
    spread = named.select(ROW, "__id", F.posexplode(F.array_append("__words", F.lit(END))).alias("position", "word"))
    held = spread.join(F.broadcast(terms) if few else terms, "word").drop("word")
    return write_shared(held.sortWithinPartitions("term", ROW, "position"), "postings")


def intersect(candidates: DataFrame, postings: DataFrame, asked: DataFrame) -> DataFrame:
    """Candidates (row, start, window) that have the asked term (window, place, term) in its place."""
    needed = candidates.join(asked, "window").select(
        ROW, "start", "window", "term", (F.col("start") + F.col("place")).alias("position")
    )
    return needed.join(postings.select(ROW, "term", "position"), [ROW, "term", "position"], "left_semi").select(
        ROW, "start", "window"
    )


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_broadcast: int = 64 * 1024 * 1024,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Postings, exact window occurrences (row, start, window, length) and items of windows (window, item).

    The terms of each window are ranked by their number of postings.  The
    rarest term's list gives the candidate starts, the second rarest cuts them,
    and what is left must be in the lists of all other terms.
    """
    windows = write_shared(item_windows(benchmark, item_id, item_text, size), "windows")
    distinct = windows.groupBy("window").agg(F.first("words").alias("words"))
    vocabulary = distinct.select(F.explode("words").alias("word")).distinct()
    ends = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(0).cast("long").alias("term"))
    terms = write_shared(vocabulary.select("word", F.xxhash64("word").alias("term")).unionByName(ends), "terms")
    few = terms.count() * TERM_BYTES <= most_broadcast
    postings = postings_of(docs, terms, few, doc_id, text)

    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    places = distinct.select("window", F.size("words").alias("length"), F.posexplode("words").alias("place", "word"))
    places = places.join(terms, "word").join(counts, "term")  # a window with a term that nobody has is gone below
    ranked = places.withColumn(
        "rank", F.row_number().over(Window.partitionBy("window").orderBy("n", "term", "place"))
    )
    ranked = ranked.withColumn("found", F.count("*").over(Window.partitionBy("window"))).filter("found = length")
    ranked = write_shared(ranked.select("window", "length", "place", "term", "rank"), "ranked")

    first = ranked.filter("rank = 1").select("window", "place", "term")
    if first.count() * WINDOW_BYTES <= most_broadcast:  # else both sides are shuffled by term
        first = F.broadcast(first)
    starts = postings.select(ROW, "term", "position").join(first, "term")
    starts = starts.select(ROW, "window", (F.col("position") - F.col("place")).alias("start")).filter("start >= 0")
    cut = ranked.filter("rank = 2").select("window", "place", "term")
    single = ranked.groupBy("window").agg(F.max("length").alias("length"))
    longer = starts.join(single.filter("length > 1"), "window", "left_semi")
    alone = starts.join(single.filter("length = 1"), "window", "left_semi")
    left = write_shared(intersect(longer, postings, cut), "candidates")
    rest = ranked.filter("rank > 2").select("window", "place", "term")
    asked = left.join(rest, "window").select(
        ROW, "start", "window", "term", (F.col("start") + F.col("place")).alias("position")
    )
    wanted = asked.select(ROW, "term", "position").distinct()
    held = wanted.join(postings.select(ROW, "term", "position"), [ROW, "term", "position"], "left_semi")
    met = asked.join(held, [ROW, "term", "position"]).groupBy(ROW, "start", "window").agg(F.count("*").alias("met"))
    whole = (
        left.join(single, "window")
        .join(met, [ROW, "start", "window"], "left")
        .filter(F.coalesce("met", F.lit(0)) == F.col("length") - 2)
        .select(ROW, "start", "window", "length")
    )
    found = whole.unionByName(alone.join(single, "window").select(ROW, "start", "window", "length"))
    return postings, write_shared(found, "occurrences"), windows.select("window", "item")


def hit_words(found: DataFrame) -> DataFrame:
    """Per document the number of words inside any occurrence (overlaps counted once)."""
    longest = found.groupBy(ROW, "start").agg(F.max("length").alias("length"))
    before = Window.partitionBy(ROW).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = longest.select(ROW, F.greatest(end - F.greatest("start", reached), F.lit(0)).alias("fresh"))
    return fresh.groupBy(ROW).agg(F.sum("fresh").alias("n_hit"))


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, percent: int = 5, **columns: str
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``size`` consecutive words of an item; an item of fewer words,
    but not none, is one window.  A document word inside any occurrence is hit,
    and a document is contaminated when it has a hit and ``percent`` % of its
    words or more are hit.  NULL and wordless texts have no words and no hits.
    Rows with equal or NULL ids are judged one by one, repeated items count once
    by id, empty tables give no rows or no hits, other columns are ignored.
    """
    postings, found, items = occurrences(docs, benchmark, size, **columns)
    lengths = postings.filter("term = 0").select(ROW, "__id", F.col("position").cast("long").alias("n_words"))
    named = found.select(ROW, "window").distinct().join(items, "window").select(ROW, "item").distinct()
    listed = named.groupBy(ROW).agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = lengths.join(hit_words(found), ROW, "left").join(listed, ROW, "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed_items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("__id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size(listed_items).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed_items, ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 100 >= F.col("n_words") * percent)).alias("contaminated"),
    )


def near_matches(docs: DataFrame, phrases: DataFrame, slop: int = 5, **columns: str) -> DataFrame:
    """Proximity: rows (doc_id, item_id) where all words of a phrase lie within its length plus ``slop`` words.

    ``phrases`` has item_id and text; a phrase's words count once.  Rows of
    ``phrases`` with equal or NULL ids are phrases of their own.  The rarest
    term's positions are the anchors; every other term must have a position
    within the span on either side, and the nearest ones must fit one span.
    """
    names = {"doc_id": "doc_id", "text": "text", "item_id": "item_id", "item_text": "text"} | columns
    asked = phrases.select(F.col(names["item_id"]).alias("item"), F.array_distinct(words(F.col(names["item_text"]))).alias("words"))
    asked = asked.filter(F.size("words") > 0).withColumn("span", F.size("words") + slop)
    asked = write_shared(asked.withColumn("phrase", F.monotonically_increasing_id()), "phrases")
    places = asked.select("phrase", "item", "span", F.size("words").alias("length"), F.explode("words").alias("word"))
    terms = places.select("word").distinct().select("word", F.xxhash64("word").alias("term"))
    few = terms.count() * TERM_BYTES <= 64 * 1024 * 1024
    postings = postings_of(docs, terms, few, names["doc_id"], names["text"])
    counts = postings.groupBy("term").agg(F.count("*").alias("n"))
    places = places.withColumn("term", F.xxhash64("word")).join(counts, "term")
    ranked = places.withColumn("rank", F.row_number().over(Window.partitionBy("phrase").orderBy("n", "term")))
    anchors = postings.join(ranked.filter("rank = 1").select("phrase", "item", "span", "length", "term"), "term").select(
        ROW, "__id", "phrase", "item", "span", "length", F.col("position").alias("anchor")
    )
    # A window that holds all terms starts at most span - 1 before the anchor: try each start.
    starts = anchors.select("*", F.explode(F.sequence(F.col("anchor") - F.col("span") + 1, F.col("anchor"))).alias("start"))
    needed = starts.join(ranked.select("phrase", "term"), "phrase")
    cells = needed.select("*", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("span") - 1)).alias("position"))
    met = cells.join(postings.select(ROW, "term", "position"), [ROW, "term", "position"])
    full = met.groupBy(ROW, "__id", "phrase", "item", "start", "length").agg(F.countDistinct("term").alias("met"))
    return (
        full.filter("met = length").select(ROW, "__id", "item").distinct()
        .select(F.col("__id").alias("doc_id"), F.col("item").alias("item_id"))
    )
