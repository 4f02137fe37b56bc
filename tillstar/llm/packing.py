"""Packing by lexical retrieval: each seed document's window is filled with its nearest unused neighbours."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.encode import ByteEncoder, encoder

WINDOW = 2048
SHARD_TOKENS = 2_000_000
DENSE = 8  # a term in more than one of so many documents has a weight for each, others a list
FIRST = 32  # neighbours that are put in order before so many times as many
K1, B = 1.2, 0.75

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Index:
    """BM25 inverted index of one shard's documents; token ids are the terms."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        count = len(sizes)
        owner = np.repeat(np.arange(count, dtype=np.int64), sizes)
        cells, tf = np.unique((ids.astype(np.int64) << 32) | owner, return_counts=True)
        del owner
        term, self.doc = (cells >> 32).astype(np.int32), (cells & 0xFFFFFFFF).astype(np.int32)
        first = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(np.append(first, len(term)))
        idf = np.log1p((count - df + 0.5) / (df + 0.5)).astype(np.float32)
        number = np.repeat(np.arange(len(first), dtype=np.int32), df)
        self.low, self.held, self.count = first, df, count
        norm = K1 * (1 - B + B * sizes / max(sizes.mean(), 1))
        self.weight = (idf[number] * (tf * (K1 + 1) / (tf + norm[self.doc]))).astype(np.float32)
        # The weights of a frequent term stand in a row, fewer than DENSE times the postings in all.
        self.dense_row = np.cumsum(df * DENSE > count, dtype=np.int32) - 1
        frequent = (df * DENSE > count)[number]
        self.dense = np.zeros((self.dense_row[-1] + 1, count), np.float32)
        self.dense[self.dense_row[number[frequent]], self.doc[frequent]] = self.weight[frequent]
        # Each document's terms, listed ones before frequent ones; a term that nobody else has finds nothing.
        shared = df[number] > 1
        self.terms = number[shared][np.argsort(2 * self.doc[shared] + frequent[shared], kind="stable")]
        held = np.bincount(self.doc[shared], minlength=count)
        self.term_stop = held.cumsum()
        self.term_start = self.term_stop - held
        self.listed_stop = self.term_start + np.bincount(self.doc[shared & ~frequent], minlength=count)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document for the seed's terms, all of them."""
        start, middle, stop = self.term_start[seed], self.listed_stop[seed], self.term_stop[seed]
        score = self.dense[self.dense_row[self.terms[middle:stop]]].sum(axis=0)
        if start == middle:
            return score
        low, held = self.low[self.terms[start:middle]], self.held[self.terms[start:middle]]
        ends = held.cumsum()
        places = np.arange(ends[-1]) + (low - ends + held).repeat(held)
        return score + np.bincount(self.doc[places], self.weight[places], minlength=self.count)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused documents that share a term with the seed, the best first (ties by place)."""
        score, ordered = self.scores(seed) * unused, FIRST
        while score.any():
            least = np.partition(score, -ordered)[-ordered] if ordered < self.count else 0
            best = np.flatnonzero((score >= least) & (score > 0))
            yield from best[np.argsort(-score[best], kind="stable")].tolist()
            score[best] = 0
            ordered *= FIRST


class Packer:
    """Fills sequences one after another; pieces of finished sequences are rows."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next_id = window, first_id
        self.rows, self.open, self.filled = [], [], 0

    def add(self, doc: tuple, start: int, length: int) -> None:
        """``doc`` is (the caller's key, ids as bytes)."""
        self.open.append((doc, start, length))
        self.filled += length
        if self.filled == self.window:
            self.close(self.open)
            self.open, self.filled = [], 0

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for (key, ids), start, length in pieces:
            part = np.frombuffer(ids, "<u2")[start : start + length].astype("<u4").tobytes()
            self.rows.append((key, start, length, zlib.crc32(part), len(ids) // 2, self.next_id, offset))
            offset += length
        self.next_id += 1

    def finish(self) -> None:
        """The last, unfilled window becomes sequences whose lengths are powers of two."""
        left, self.open = self.open, []
        while self.filled:
            size = 1 << (self.filled.bit_length() - 1)
            pieces, room = [], size
            while room:
                doc, start, length = left.pop(0)
                take = min(length, room)
                pieces.append((doc, start, take))
                room -= take
                if take < length:
                    left.insert(0, (doc, start + take, length - take))
            self.close(pieces)
            self.filled -= size


def pack_shard(packer: Packer, keys: list, encoded: list[bytes]) -> None:
    """Put a shard's documents into windows.

    The seed is the document that was cut by the last window, or else the first
    unused one; its neighbours follow, best first, until the window is full, and
    the one that does not fit is cut and seeds the next window.  A seed without
    unused neighbours is followed by the next unused document.
    """
    sizes = np.array([len(x) // 2 for x in encoded], np.int64)
    index = Index(np.frombuffer(b"".join(encoded), "<u2"), sizes)
    unused, done, first = np.ones(len(keys), bool), np.zeros(len(keys), np.int64), 0
    seed = None
    while True:
        if seed is None:
            while first < len(keys) and not unused[first]:
                first += 1
            if first == len(keys):
                return
            seed = first
        waiting, seed = [seed], None
        unused[waiting[0]] = False
        found = None
        while waiting:
            doc = waiting.pop()
            take = min(packer.window - packer.filled, sizes[doc] - done[doc])
            packer.add((keys[doc], encoded[doc]), int(done[doc]), int(take))
            done[doc] += take
            if done[doc] < sizes[doc]:
                seed = doc  # cut: the next window's seed
                break
            if not packer.filled:
                break
            if found is None:
                found = index.neighbours(doc, unused)
            nearest = next((x for x in found if unused[x]), None)
            if nearest is not None:
                unused[nearest] = False
                waiting.append(nearest)


def pack_batches(path: str, end_id: int, window: int):
    """A function for mapInPandas: documents in, pieces out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(ByteEncoder, path), end_id.to_bytes(2, "little")
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        keys, encoded, held = [], [], 0

        def rows() -> pd.DataFrame:
            out = pd.DataFrame(packer.rows, columns=["doc_id", *[x.split()[0] for x in PIECES.split(", ")]])
            out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
            packer.rows = []
            return out

        for batch in batches:
            for key, text in zip(batch["doc_id"].astype(object), batch["__text"]):
                encoded.append((encode(text) if text else b"") + end)
                keys.append(None if pd.isna(key) else int(key))
                held += len(encoded[-1]) // 2
                if held >= SHARD_TOKENS:
                    pack_shard(packer, keys, encoded)
                    keys, encoded, held = [], [], 0
                    yield rows()
        if encoded:
            pack_shard(packer, keys, encoded)
        packer.finish()
        yield rows()

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document's ids (and ``end_id`` behind them) are encoded once and lie in
    exactly one piece each.  Documents are taken as they lie in the input's
    partitions, in shards of about ``SHARD_TOKENS`` ids (or one longer document),
    with a BM25 index each; nothing is shuffled, and a task holds one shard.
    Windows are full but for the last one of a partition, which is divided into
    sequences with lengths that are powers of two, so nothing is padded.

    NULL and empty texts are their end id alone.  Rows with equal or NULL ids are
    packed one by one, an empty table gives no rows, other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("__text"))
    return rows.mapInPandas(pack_batches(tokenizer, end_id, window), f"doc_id long, {PIECES}")
