"""Token files compressed by Re-Pair grammars, one grammar a shard."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstar.llm.encode import WordEncoder, encoder
from tillstar.session import new_path

SHARD_TOKENS = 2_000_000
ROUNDS = 8
PAIRS_A_ROUND = 2048
LEAST_COUNT = 16  # occurrences for which a rule is worth its place
BUCKET_BITS = 20
BLOCK = 1 << 16
SYMBOLS = 65_536  # symbols are stored in 16 bits; ids and rules share them

SHARD = (
    "part int, shard int, n_tokens long, doc_ids array<long>, tokens array<int>, symbols array<int>, "
    "first_rule int, rules binary, lengths binary, sequence binary"
)


def frequent_pairs(sequence: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places where a chosen pair starts, which one it is, and the chosen pairs' keys (left and right symbol).

    Pairs are counted in hash buckets; a chosen bucket stands for one of its pairs,
    which in a full bucket is nearly always the frequent one.  ``bucket`` is room
    for a number per pair; blocks of the sequence stay in the processor's cache.
    """
    bucket = bucket[: len(sequence) - 1]
    blocks = [slice(at, min(at + BLOCK, len(bucket))) for at in range(0, len(bucket), BLOCK)]
    for block in blocks:
        key = sequence[block] << np.uint32(16)
        key |= sequence[block.start + 1 : block.stop + 1]
        key *= np.uint32(0x9E3779B1)
        key >>= np.uint32(32 - BUCKET_BITS)
        bucket[block] = key
    counts = np.bincount(bucket, minlength=1 << BUCKET_BITS)
    chosen = np.flatnonzero(counts >= LEAST_COUNT)
    if len(chosen) > most:
        chosen = chosen[np.argpartition(counts[chosen], -most)[-most:]]
    wanted, rank = np.zeros(1 << BUCKET_BITS, bool), np.zeros(1 << BUCKET_BITS, np.int16)
    wanted[chosen], rank[chosen] = True, np.arange(len(chosen))
    pairs = np.zeros(len(chosen), np.uint32)
    held = np.concatenate([np.flatnonzero(wanted[bucket[block]]) + block.start for block in blocks])
    kind = rank[bucket[held]]
    key = (sequence[held] << np.uint32(16)) | sequence[held + 1]
    pairs[kind] = key
    same = np.flatnonzero(pairs[kind] == key)
    return held[same], kind[same], pairs


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over one shard.

    ``ends`` marks the last id of each document; no rule crosses it.  In each
    round the most frequent pairs become new symbols, all at once; where
    occurrences overlap, every second one of a run is replaced.  Returns the
    remaining symbols, their end marks, the rules (left, right) and the number of
    ids that each rule stands for.  Symbols from ``base`` on are rules.
    """
    sequence, rules, lengths = ids.astype(np.uint32), [], []
    size, bucket = np.ones(base, np.int64), np.empty(len(ids), np.int64)
    for _ in range(ROUNDS):
        room = min(PAIRS_A_ROUND, SYMBOLS - base - len(lengths))
        if room <= 0 or len(sequence) < 2:
            break
        starts, kind, pairs = frequent_pairs(sequence, bucket, room)
        inside = np.flatnonzero(~ends[starts])
        starts, kind = starts[inside], kind[inside]
        if len(starts):
            fresh = np.diff(starts, prepend=-2) != 1
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(starts)), 0))
            second = np.flatnonzero((np.arange(len(starts)) - run) & 1 == 0)
            starts, kind = starts[second], kind[second]
        used = np.bincount(kind, minlength=len(pairs))
        worth = np.flatnonzero(used >= LEAST_COUNT)
        if not len(worth):
            break
        number = np.full(len(pairs), -1, np.int64)
        number[worth] = base + len(lengths) + np.arange(len(worth))
        symbol = number[kind]
        keep = np.flatnonzero(symbol >= 0)
        starts, symbol = starts[keep], symbol[keep]
        made = np.stack([pairs[worth] >> np.uint32(16), pairs[worth] & np.uint32(0xFFFF)], 1)
        made_size = size[made[:, 0]] + size[made[:, 1]]
        rules.append(made)
        lengths += made_size.tolist()
        size = np.append(size, made_size)
        sequence[starts] = symbol
        ends[starts] = ends[starts + 1]
        left = np.ones(len(sequence), bool)
        left[starts + 1] = False
        left = np.flatnonzero(left)
        sequence, ends = sequence[left], ends[left]
    made = np.concatenate(rules) if rules else np.empty((0, 2), np.uint32)
    return sequence, ends, made, np.array(lengths, np.int64)


def expand(sequence: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for: every rule is expanded once, then copied to its places."""
    made: list[bytes] = []
    one = lambda symbol: made[symbol - base] if symbol >= base else symbol.to_bytes(2, "little")
    for left, right in rules.tolist():  # a rule's parts come before it
        made.append(one(left) + one(right))
    table = np.concatenate([np.arange(base, dtype=np.uint16), np.frombuffer(b"".join(made), "<u2")])
    size = np.concatenate([np.ones(base, np.int64), np.array([len(x) // 2 for x in made], np.int64)])
    begin = np.cumsum(size) - size
    lengths = size[sequence]
    stops = np.cumsum(lengths)
    shift = np.repeat(begin[sequence] - (stops - lengths), lengths)
    return table[shift + np.arange(len(shift))]


def decode_range(shard: dict, doc: int, start: int, length: int) -> np.ndarray:
    """Ids start to start + length of one document of a shard, expanding only the symbols that cover them."""
    base = shard["first_rule"]
    rules = np.frombuffer(shard["rules"], "<u2").reshape(-1, 2)
    sizes = np.frombuffer(shard["lengths"], "<u4").astype(np.int64)
    first = int(sum(shard["symbols"][:doc]))
    own = np.frombuffer(shard["sequence"], "<u2")[first : first + shard["symbols"][doc]].astype(np.int64)
    width = np.where(own >= base, sizes[np.maximum(own - base, 0)] if len(sizes) else 1, 1)
    stops = np.cumsum(width)
    low, high = np.searchsorted(stops, start, "right"), np.searchsorted(stops, start + length, "left") + 1
    before = int(stops[low - 1]) if low else 0
    ids = expand(own[low:high], rules, base)
    return ids[start - before : start - before + length]


def shard_row(part: int, number: int, doc_ids: list, encoded: list[bytes], base: int) -> tuple:
    ids = np.frombuffer(b"".join(encoded), "<u2")
    tokens = np.array([len(x) // 2 for x in encoded], np.int64)
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(tokens) - 1] = True
    sequence, ends, rules, lengths = compress(ids, ends, base)
    symbols = np.diff(np.flatnonzero(ends), prepend=-1)
    return (
        part, number, len(ids), doc_ids, tokens.tolist(), symbols.tolist(), base,
        rules.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), sequence.astype("<u2").tobytes(),
    )


def shard_batches(path: str, end_id: int):
    """A function for mapInPandas: sorted texts in, compressed shards out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(WordEncoder, path)
        base = encode.tokenizer.get_vocab_size()
        part, number, end = TaskContext.get().partitionId(), 0, end_id.to_bytes(2, "little")
        names = [x.split()[0] for x in SHARD.split(", ")]
        doc_ids, encoded, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["__id"].astype(object), batch["__text"]):
                encoded.append((encode(text) if text else b"") + end)
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                held += len(encoded[-1]) // 2
                if held >= SHARD_TOKENS:
                    yield pd.DataFrame([shard_row(part, number, doc_ids, encoded, base)], columns=names)
                    doc_ids, encoded, held, number = [], [], 0, number + 1
        if encoded:
            yield pd.DataFrame([shard_row(part, number, doc_ids, encoded, base)], columns=names)

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, in ascending order of doc_id, as compressed shards under ``path``.

    Documents are range-partitioned by id (then by text hash, so that rows of one
    id spread too), encoded and compressed shard by shard in the same pass.  Each
    document's ids are followed by ``end_id``.  A NULL text is empty, NULL ids
    come first, rows of one id are ordered by text hash, an empty table gives
    files without shards.  A shard holds whole documents: about ``SHARD_TOKENS``
    ids, or one longer document.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text"))
    rows = rows.repartitionByRange("__id", "__hash").sortWithinPartitions("__id", "__hash")
    rows.select("__id", "__text").mapInPandas(shard_batches(tokenizer, end_id), SHARD).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The stored shards, each with ``start``: the number of ids in all shards before it."""
    shards = spark.read.parquet(path)
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_tokens")
    inner = sizes.withColumn("inner", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).drop("n_tokens")
    # One row per written partition.
    totals = sorted((r["part"], r["n"]) for r in sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    outer = F.broadcast(spark.createDataFrame(starts, "part int, outer long"))
    places = inner.join(outer, "part").select("part", "shard", (F.col("inner") + F.col("outer")).alias("start"))
    return shards.join(places, ["part", "shard"])


def document_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document's place, length and checksum, from the expanded ids."""
    for batch in batches:
        for shard in batch.to_dict("records"):
            rules = np.frombuffer(shard["rules"], "<u2").reshape(-1, 2)
            ids = expand(np.frombuffer(shard["sequence"], "<u2"), rules, shard["first_rule"]).astype("<u4")
            tokens = np.asarray(shard["tokens"], np.int64)
            if len(ids) != tokens.sum():
                raise ValueError(f"shard {shard['part']}/{shard['shard']} expands to {len(ids)} of {tokens.sum()} ids")
            stops = np.cumsum(tokens)
            starts = stops - tokens
            out = pd.DataFrame({"doc_id": pd.array([None if x is None or x != x else int(x) for x in shard["doc_ids"]], dtype="Int64")})
            out["start"], out["n_tokens"] = starts + shard["start"], tokens
            out["ids_crc32"] = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, stops)]
            yield out


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32; all ids are decoded."""
    return read_shards(spark, path).mapInPandas(document_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files into the shared folder and return their :func:`token_index`."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, doc_id, text)
    return token_index(docs.sparkSession, path)
