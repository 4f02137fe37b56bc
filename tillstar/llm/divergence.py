"""How the word use of sources differs, within a language: between every two sources, and word by word.

Counts per (term, source) are sparse, and most of what two sources differ by is
the same for all terms that neither has.  So the sum over all terms is taken as
if no source had any, then corrected per (source, count), then per pair of
counts that one term has in two sources.  The last corrections come from a
frequent-pattern tree over the terms' rows of (source, count).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import small
from tillstar.session import write_shared

LEAST_DOCUMENTS = 10  # of a language, that hold a term which is kept
SCALE_STEPS, STEP = 3, 1000  # shares are counted in 1000 ** 3 parts
TOP_TERMS = 10
HELD_TERMS = 400_000  # counts that a counting task holds before it hands them on; some 100 MB
MATRIX_CELLS = 2_000_000  # of a tree built at once
GROUP_BYTES = 160  # a group in a broadcast table

# A term's bytes: letters, and whatever is not ASCII; A to Z become small.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


# Inside a task ------------------------------------------------------------------


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), added up within the task as far as its store holds."""

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in counts.items():
            terms, with_term = list(n), docs[lang, source]
            columns = [
                pa.repeat(lang, len(terms)),
                pa.repeat(source, len(terms)),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n.values(), pa.int64()),
                pa.array(map(with_term.__getitem__, terms), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        counts.clear()
        docs.clear()

    counts, docs, held = defaultdict(Counter), defaultdict(Counter), 0
    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts):
            terms = text.translate(TERM_BYTES).split()
            if terms:
                own = counts[lang, source]
                held -= len(own)
                own.update(terms)
                docs[lang, source].update(set(terms))
                held += len(own)
                if held > HELD_TERMS:
                    yield from handed_on()
                    held = 0
    yield from handed_on()


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """Frequent-pattern tree over sorted rows of (source, p) items, each row with a multiplicity.

    A node is a prefix that rows share.  Row by row in a matrix, ``fresh`` marks
    where a row leaves the path of the row before, so nodes are the fresh cells;
    a node's ancestors stand left of it in the same row.
    """

    def __init__(self, items: np.ndarray, multiplicity: np.ndarray):
        there = items >= 0
        same = np.zeros_like(there)
        same[1:] = np.logical_and.accumulate(items[1:] == items[:-1], axis=1)
        self.fresh, self.there, self.multiplicity = there & ~same, there, multiplicity

    def nodes(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows in which the nodes of a depth begin, and how often each node's path occurs."""
        rows = np.flatnonzero(self.fresh[:, depth])
        if not len(rows):
            return rows, rows
        return rows, np.add.reduceat(self.multiplicity * self.there[:, depth], rows)


def pair_corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (lang, a, b), a before b, the corrections of terms that both sources have.

    Rows are sorted by (lang, items).  Each node meets each of its ancestors
    once, whatever its multiplicity.  Corrections are whole numbers whose sum
    stays far under 2 ** 53, so adding them up as floats is exact.
    """
    sums: dict[tuple[str, str, str], int] = defaultdict(int)

    def handed_on() -> pa.RecordBatch:
        keys = list(zip(*sums)) or [[], [], []]
        columns = [pa.array(k, pa.string()) for k in keys] + [pa.array(sums.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "value"])

    def add(lang: str, names: list[str], lengths: np.ndarray, source, p, p0, multiplicity) -> None:
        width = int(lengths.max())
        row = np.repeat(np.arange(len(lengths)), lengths)
        column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        shape = (len(lengths), width)
        at = [np.zeros(shape, np.int64) for _ in range(3)]
        items = np.full(shape, -1, np.int64)
        for matrix, values in zip([*at, items], (source, p, p0, source << 31 | p)):
            matrix[row, column] = values
        sources, held, absent = at
        tree = Tree(items, multiplicity)
        for depth in range(1, width):
            rows, times = tree.nodes(depth)
            if not len(rows):
                continue
            one, one0 = held[rows, depth, None], absent[rows, depth, None]
            two, two0 = held[rows, :depth], absent[rows, :depth]
            change = apart(one, two) - apart(one, two0) - apart(one0, two) + apart(one0, two0)
            change *= times[:, None]
            keys = sources[rows, :depth] * len(names) + sources[rows, depth, None]
            found, place = np.unique(keys.ravel(), return_inverse=True)
            for key, value in zip(found.tolist(), np.bincount(place, change.ravel()).tolist()):
                sums[lang, names[key // len(names)], names[key % len(names)]] += int(value)

    for batch in batches:
        langs, lists = batch["lang"].to_numpy(zero_copy_only=False), batch["items"]
        flat = lists.flatten()
        coded = flat.field("source").dictionary_encode()
        names = coded.dictionary.to_pylist()
        source = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        p, p0 = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("p", "p0"))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        times = batch["times"].to_numpy(zero_copy_only=False)
        stops = np.cumsum(lengths)
        starts = stops - lengths
        block = max(1, MATRIX_CELLS // max(1, int(lengths.max(initial=1))))
        cuts = {0, len(langs), *range(0, len(langs), block), *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist()}
        cuts = sorted(cuts)
        for low, high in zip(cuts, cuts[1:]):
            part = slice(starts[low], stops[high - 1])
            add(langs[low], names, lengths[low:high], source[part], p[part], p0[part], times[low:high])
        if len(sums) > HELD_TERMS:
            yield handed_on()
            sums.clear()
    yield handed_on()


# Over the tables ------------------------------------------------------------------


def share(count: Column, total: Column) -> Column:
    """1 + floor(10 ** 9 * count / total) for count <= total < 9 * 10 ** 15, in whole numbers."""
    scaled, rest = F.lit(0).cast("long"), count
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        scaled = scaled * STEP + F.call_function("div", rest, total)
        rest = rest % total
    return scaled + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def joined(rows: DataFrame, groups: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(F.broadcast(groups) if small(groups, GROUP_BYTES) else groups, on)


def kept_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term, source, n, total) of the terms that are in ``least`` documents of their language."""
    counted = docs.select("lang", "source", "text").mapInArrow(count_terms, COUNTS)
    counts = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term's rows are its sources, already added up.
    term = Window.partitionBy("lang", "term")
    sums = {"total": F.sum("n").over(term), "__docs": F.sum("docs").over(term)}
    return counts.withColumns(sums).filter(F.col("__docs") >= least).select("lang", "term", "source", "n", "total")


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    With p = 1 + floor(10 ** 9 * (count + 2) / (N + 2 * V)) of a kept term in a
    source (V kept terms of the language, N of their occurrences in the source)
    and f = floor((p - q) ** 2 / (p + q)): part ``pair`` gives every other source
    of the language with f summed over all kept terms, part ``term`` the ``top``
    terms that a source has more often than its language.

    A counting task adds up what it meets; counts are then added per (lang,
    term, source), so a common term is spread over its sources, and a term's row
    has an entry a source.  Equal rows become one with a multiplicity, rows are
    dealt out by ranges of (lang, items), and each task builds the tree of its
    range: rows with a common beginning meet in one task, and only sums leave it.

    NULL lang, source and text count as empty; a source without any term has
    shares of its own (all alike) and pairs, but no terms; a language without a
    kept term has pairs of value 0.  Rows that repeat count as documents of
    their own.  Ties rank by item.  An empty table gives no rows.
    """
    rows = docs.select(
        *(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for c, name in ((lang, "lang"), (source, "source"), (text, "text")))
    )
    counts = write_shared(kept_counts(rows, least), "divergence-counts")

    per_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("in_source"))
    per_lang = counts.groupBy("lang", "term").agg(F.first("total").alias("n")).groupBy("lang")
    per_lang = per_lang.agg(F.sum("n").alias("in_lang"), F.count("*").alias("terms"))
    held = rows.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    groups = write_shared(
        held.fillna(0, ["in_source", "in_lang", "terms"])
        .withColumn("of_source", F.col("in_source") + 2 * F.col("terms"))
        .withColumn("p0", F.when(F.col("terms") > 0, share(F.lit(2).cast("long"), F.col("of_source"))).otherwise(0)),
        "divergence-groups",
    )
    of_lang = F.col("in_lang") + 2 * F.col("terms")
    shares = joined(counts, groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        share(F.col("n") + 2, F.col("of_source")).alias("p"),
        "p0",
        share(F.col("total") + 2, of_lang).alias("q"),
    )
    shares = write_shared(shares, "divergence-shares")

    told = pair_rows(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value").unionByName(
        shares.filter("p > q").select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
        )
    )
    place = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    pairs = told.filter("part = 'pair'").withColumn("rank", place)
    # Its own filter lets Spark keep only the best of a source in each task before they are shuffled.
    terms = told.filter("part = 'term'").withColumn("rank", place).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)


def pair_rows(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways round."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("other0"))
    together = F.col("source") != F.col("item")
    none = divergence(F.col("p0"), F.col("other0"))

    def with_others(rows: DataFrame) -> DataFrame:
        return joined(rows, other, ["lang"]).filter(together)

    base = with_others(groups.select("lang", "source", "p0", "terms")).select(
        "lang", "source", "item", F.when(F.col("terms") > 0, F.col("terms") * none).otherwise(0).alias("value")
    )
    # Terms that one of the two has: once per (source, share), however many terms have it.
    alike = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("times"))
    singles = with_others(alike).select(
        "lang", "source", "item", (F.col("times") * (divergence(F.col("p"), F.col("other0")) - none)).alias("value")
    )
    # Terms that both have, from the tree.
    item = F.struct("source", "p", "p0")
    term_rows = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(item)).alias("items"))
    distinct = term_rows.filter(F.size("items") > 1).groupBy("lang", "items").agg(F.count("*").alias("times"))
    sorted_rows = distinct.repartitionByRange("lang", "items").sortWithinPartitions("lang", "items")
    both = sorted_rows.mapInArrow(pair_corrections, "lang string, a string, b string, value long")
    both = both.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    turned = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    one_way = singles.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).unionByName(
        both.toDF("lang", "source", "item", "value")
    )
    parts = base.unionByName(one_way).unionByName(turned(one_way))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
