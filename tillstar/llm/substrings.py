"""Substring deduplication by hashed runs of consecutive sentences."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import settled
from tillstar.session import write_shared

RUN = 3  # sentences of a run, at least
LEAST_WORDS = 16  # words of a run, at least
LONG_SENTENCE = 90  # characters; a longer sentence is cut into pieces
KNOWN_RUNS = 100_000  # places that a task remembers, some 30 MB
MARK = 0xFFFFFFFF
CUT_ONE_IN = 6  # behind one in so many of its words, chosen by the word's own checksum

# A piece of text up to and with the end of a sentence or line and the white space behind it.
SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=\s|$)|[.!?]+|\n|$)\s*")

# Runs of GRAM words, the least hash of every GRAM_WINDOW neighbouring ones: any
# GRAM + GRAM_WINDOW - 1 = 50 shared words hold one, and they cover without gaps.
GRAM, GRAM_WINDOW = 26, 25
FACTOR = 0x9E3779B97F4A7C15


# Which characters up to U+3000 are white space; none beyond is.
SPACES = np.array([chr(code).isspace() for code in range(0x3002)])


def word_starts(text: str) -> np.ndarray:
    """Places where words start."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = SPACES[np.minimum(codes, len(SPACES) - 1)]
    return np.flatnonzero(~space & np.concatenate(([True], space[:-1])))


def lower_words(text: str) -> tuple[bytes, list[bytes]]:
    """The words in lower case, in UTF-8: joined by single spaces, and one by one."""
    joined = " ".join(text.lower().split()).encode("utf-8", "surrogatepass")
    return joined, joined.split(b" ") if joined else []


def checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def sentence_starts(text: str, at: np.ndarray | None = None, sums: np.ndarray | None = None) -> list[int]:
    """Places where sentences (or pieces of long ones) start; the last entry is the text's length.

    A sentence ends behind ``.``, ``!`` or ``?`` followed by white space, or at
    a line's end; the white space behind it belongs to it.  A long sentence is
    cut behind words that their own checksum picks, so the pieces of a repeated
    passage are the same wherever the sentences around it begin.  ``at`` and
    ``sums`` are the starts and checksums of the text's words, if they are known.
    """
    if at is None:
        at, sums = word_starts(text), checksums(lower_words(text)[1])
    ends = [found.end() for found in SENTENCE.finditer(text)]
    # A mark with no white space behind it is inside a word, as in 1.5.
    ends = [end for end in ends if end and (end == len(text) or text[end - 1] not in ".!?")]
    borders = np.unique(np.array([0, *ends], np.int64))
    sentence = borders.searchsorted(at, "right") - 1
    # A cut is where the next word of a long sentence starts.
    cut = (sums[:-1] % CUT_ONE_IN == 0) & (sentence[1:] == sentence[:-1])
    cut &= (np.diff(borders, append=0) > LONG_SENTENCE)[sentence[1:]]
    return np.sort(np.concatenate((borders, at[1:][cut]))).tolist()


def gram_places(sums: np.ndarray) -> list[int]:
    """Places of the runs of ``GRAM`` words that have the least hash (the last of equal ones) in a window.

    Words are given by their checksums.
    """
    count = len(sums) - GRAM + 1
    if count < GRAM_WINDOW:
        return []
    own = (sums.astype(np.uint64) + np.uint64(1)) * np.uint64(FACTOR)
    own ^= own >> np.uint64(29)
    value = run_sums(own)
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    least = value  # of 2, 4, 8 and 16 neighbours, then of GRAM_WINDOW
    for step in (1, 2, 4, 8, GRAM_WINDOW - 16):
        least = np.minimum(least[:-step], least[step:])
    # Elsewhere a window has the least hash of the window before it, at the same place.
    fresh = value[GRAM_WINDOW - 1 :] == least
    fresh[0] = True
    fresh[1:] |= least[1:] != least[:-1]
    at = np.flatnonzero(fresh)
    windows = np.lib.stride_tricks.sliding_window_view(value, GRAM_WINDOW)[at, ::-1]
    return (at + GRAM_WINDOW - 1 - windows.argmin(1)).tolist()


def run_sums(own: np.ndarray) -> np.ndarray:
    """Each ``GRAM`` (16 + 8 + 2) neighbouring values, read as digits of a number to the base ``FACTOR``, modulo 2^64."""
    power = [np.uint64(pow(FACTOR, k, 1 << 64)) for k in range(11)]
    two = own[:-1] * power[1] + own[1:]
    four = two[:-2] * power[2] + two[2:]
    eight = four[:-4] * power[4] + four[4:]
    sixteen = eight[:-8] * power[8] + eight[8:]
    count = len(own) - GRAM + 1
    return sixteen[:count] * power[10] + eight[16 : 16 + count] * power[2] + two[24 : 24 + count]


def removed_stretches(text: str, starts: list[int], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans joined where they touch, without pieces of sentences at their ends.

    A piece of ``GRAM`` words or more goes too, and so does all of a stretch that
    holds no whole sentence: what is left of 51 repeated words is no such passage.
    """
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], b)
        else:
            joined.append([a, b])
    out, words = [], None
    for a, b in joined:
        low, high = starts[bisect_left(starts, a)], starts[bisect_right(starts, b) - 1]
        if (low, high) != (a, b):
            words = [*word_starts(text).tolist(), len(text)] if words is None else words
            place = lambda x: bisect_left(words, x)
            low = low if place(low) - place(a) < GRAM else a
            high = high if place(b) - place(high) < GRAM else b
        out.append((low, high) if low < high else (a, b))
    return out


def _digest(words: bytes) -> bytes:
    return hashlib.blake2b(words, digest_size=8).digest()


def runs_of(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of start and end, and hash of each run in a text.

    The run from a sentence is the shortest one of ``RUN`` sentences and
    ``LEAST_WORDS`` words or more; near the end of a text there may be none.
    Others are ``GRAM`` words from wherever :func:`gram_places` says.  Case and
    white space do not count.
    """
    empty = np.empty(0, np.int32)
    if not text:
        return empty, empty, np.empty(0, np.int64)
    (joined, words), at = lower_words(text), word_starts(text)
    sums = checksums(words)
    starts = np.array(sentence_starts(text, at, sums))
    of_piece = at.searchsorted(starts)  # each piece's first word; white space alone is no piece
    full = np.flatnonzero(np.diff(of_piece))
    from_word = np.append(of_piece[full], len(words))
    # The piece behind each run; near the end of the text there is none.
    behind = np.maximum(np.arange(RUN, len(full) + RUN), from_word.searchsorted(from_word[:-1] + LEAST_WORDS))
    behind = behind[: behind.searchsorted(len(full), "right")]
    places = gram_places(sums)
    first = np.concatenate((from_word[: len(behind)], places)).astype(np.int64)
    last = np.concatenate((from_word[behind], np.add(places, GRAM))).astype(np.int64)
    ends = np.concatenate((starts[full[behind - 1] + 1], np.append(at, len(text))[last[len(behind) :]]))
    firsts = np.concatenate((starts[full[: len(behind)]], at[first[len(behind) :]]))
    # Words lie in ``joined`` from here, a space behind each.
    byte = np.concatenate(([0], np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1, [len(joined) + 1]))
    low, high = byte[first].tolist(), (byte[last] - 1).tolist()
    hashes = [_digest(joined[a:b]) for a, b in zip(low[: len(behind)], high)]
    hashes += [_digest(b"\0" + joined[a:b]) for a, b in zip(low[len(behind) :], high[len(behind) :])]
    return firsts.astype(np.int32), ends.astype(np.int32), np.frombuffer(b"".join(hashes), np.int64)


def run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every run of the texts; ``later`` marks those that an earlier place of this task also holds.

    Of equal runs met in a task only the first place may be the first of all, so
    a run in very many texts leaves few rows to compare.  The places known are
    bounded: beyond ``KNOWN_RUNS`` they are given out as they are.
    """
    known: dict[int, tuple[int, int, int]] = {}

    def frame(rows: list[tuple], later: bool) -> pd.DataFrame:
        values = np.fromiter(chain.from_iterable(rows), np.int64, 4 * len(rows)).reshape(-1, 4)
        out = pd.DataFrame(values, columns=["run", "key", "at", "end"])
        out["later"] = later
        return out

    def first_ones() -> pd.DataFrame:
        rows = [(run, *place) for run, place in known.items()]
        known.clear()
        return frame(rows, False)

    for batch in batches:
        for begin in range(0, len(batch), 500):  # runs of a few texts at a time
            some, later = batch.iloc[begin : begin + 500], []
            for key, mark, text in zip(some["__key"].tolist(), some["__mark"].tolist(), some["__text"]):
                firsts, ends, runs = runs_of(text)
                at = (firsts.astype(np.int64) << 32) | mark
                for first, end, run in zip(at.tolist(), ends.tolist(), runs.tolist()):
                    place = (key, first, end)
                    other = known.get(run)
                    if other is None or place == other:
                        known[run] = place
                    elif place < other:
                        known[run] = place
                        later.append((run, *other))
                    else:
                        later.append((run, *place))
            if later:
                yield frame(later, True)
            if len(known) > KNOWN_RUNS:
                yield first_ones()
    yield first_ones()


OFFSETS = "array<struct<start:int,end:int>>"
RUNS = "run long, key long, at long, end int, later boolean"


def document_key(doc_id: Column) -> Column:
    """The id; for rows without one, a number behind any usual id, from the text's hash."""
    unnamed = F.shiftrightunsigned("__hash", 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(doc_id.cast("long"), unnamed)


def cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts without their covered stretches, and the removed offsets."""
    for batch in batches:
        texts, removed, sentences = [], [], []
        for text, spans in zip(batch["__text"], batch["spans"]):
            if text is None or spans is None or not len(spans):
                texts.append(text), removed.append([]), sentences.append(0)
                continue
            starts = sentence_starts(text)
            cuts = removed_stretches(text, starts, [(span["first"], span["end"]) for span in spans])
            at = [0, *(x for cut in cuts for x in cut), len(text)]
            texts.append("".join(text[a:b] for a, b in zip(at[::2], at[1::2])).rstrip())
            removed.append([{"start": a, "end": b} for a, b in cuts])
            gone = {i for a, b in cuts for i in range(bisect_right(starts, a) - 1, bisect_left(starts, b))}
            sentences.append(len(gone))
        out = batch.drop(columns=["__text", "spans"])
        out["__cut"], out["removed"], out["n_removed_sentences"] = texts, removed, sentences
        yield out


def repeated_runs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (key, mark, spans): the runs of each text that are not the first of their kind.

    Of equal runs the one in the smallest doc_id (rows without one come last),
    then at the earliest place, is the first.  Runs that a task has met before
    are settled there, as long as it remembers them; the others are shuffled once,
    by run, and a common run is one row per ``KNOWN_RUNS`` places by then.
    """
    named = keyed(docs, doc_id, text).select("__key", "__mark", "__text")
    runs = write_shared(named.mapInPandas(run_batches, RUNS), "runs")
    order = Window.partitionBy("run").orderBy("key", "at")
    # Rows alike in id and text may come from two tasks: they are one place.
    place = F.dense_rank().over(order)
    far = runs.filter("NOT later").select("run", "key", "at", "end").withColumn("place", place).filter("place > 1")
    later = runs.filter("later").select("key", "at", "end").unionByName(far.select("key", "at", "end"))
    mark, first = F.col("at").bitwiseAND(F.lit(MARK)), F.shiftright("at", 32).cast("int")
    spans = F.collect_set(F.struct(first.alias("first"), "end")).alias("spans")
    return later.groupBy("key", mark.alias("mark")).agg(spans)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Adds __key and __mark (32 bits of the text's hash), which name a document, and __text."""
    rows = docs.withColumn("__text", F.col(text)).withColumn("__hash", F.xxhash64("__text"))
    rows = rows.withColumn("__key", document_key(F.col(doc_id)))
    return rows.withColumn("__mark", F.col("__hash").bitwiseAND(F.lit(MARK))).drop("__hash")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages removed from all but their first place.

    All columns stay; ``text`` is cut, ``removed`` (array of start and end offsets
    in characters of the old text) and ``n_removed_sentences`` are added, replacing
    columns of these names.  A passage is a run of three or more consecutive
    sentences with 16 or more words; sentences covered by any run that occurred
    before (by doc_id, then place; rows without an id come last) go, also within one text.
    Of any 50 words in a row that occurred before, wherever sentences begin, at least 26 are
    found, and the whole sentences in them go, or the words themselves where there is none.  Long
    sentences are cut into pieces, so texts without full stops have runs too.  A text of which nothing is left is empty, NULL stays NULL, texts too
    short for a run stay as they are, and an empty table gives no rows.

    Rows equal in doc_id and text are one document, and all of them are cut alike.
    """
    spans = settled(docs.sparkSession, lambda: repeated_runs(docs, doc_id, text), "spans")
    others = [c for c in docs.columns if c not in ("removed", "n_removed_sentences")]
    kept = F.struct(*[F.col(f"`{c}`") for c in others if c != text]).alias("__kept")
    rows = keyed(docs.select(kept, F.col(doc_id).alias("__id"), F.col(text).alias("__t")), "__id", "__t")
    same = (F.col("__key") == F.col("key")) & (F.col("__mark") == F.col("mark"))
    joined = rows.join(spans, same, "left").select("__kept", "__text", "spans")
    schema = joined.select(
        "__kept", F.col("__text").alias("__cut"), F.expr(f"cast(NULL AS {OFFSETS})").alias("removed"),
        F.lit(0).alias("n_removed_sentences"),
    ).schema
    out = joined.mapInPandas(cut_batches, schema)
    columns = [F.col("__cut").alias(c) if c == text else F.col(f"__kept.`{c}`") for c in others]
    return out.select(*columns, "removed", "n_removed_sentences")
