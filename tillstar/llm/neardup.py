"""Near duplicates: banded MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ROW, numbered
from tillstar.llm.components import connected
from tillstar.session import write_shared

WORDS = 5  # per shingle
PERCENT = 75  # least similarity of a link, in percent
BANDS, ROWS = 30, 4  # a pair at 0.75 shares no band with probability 1.1e-5
BATCH = 12  # hash values compared before each posterior check
MISS = 1e-4  # a pair is pruned when its posterior of being a link is below this
BLOCK = 4096  # signatures of a bucket compared in one task
BLOCK_SHINGLES = 1_000_000  # shingles of a block in one verifying task
CACHE_WORDS = 300_000  # word hashes kept per task

SKETCH = "__id long, __hash long, n_shingles long, digest binary, signature binary, bands array<long>"


def word_shingles(text: str | None, cache: dict[bytes, bytes], words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; fewer words make one shingle, none make none."""
    found = text.encode("utf-8").lower().split() if text else []  # ASCII letters and white space only
    if not found:
        return np.empty(0, np.uint64)
    if len(cache) > CACHE_WORDS:
        cache.clear()
    for word in set(found).difference(cache):
        cache[word] = hashlib.blake2b(word, digest_size=8).digest()
    h = np.frombuffer(b"".join(map(cache.__getitem__, found)), np.uint64)
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):  # order matters: multiply and rotate between words
        mixed = (mixed ^ h[i : len(h) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return (
        draw.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32),
        draw.integers(0, 2**32, count, dtype=np.uint64).astype(np.uint32) | np.uint32(1),
    )


def minhash(shingles: np.ndarray, masks: np.ndarray, factors: np.ndarray) -> np.ndarray:
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(masks), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(short), 256):
        values = short[start : start + 256, None] ^ masks
        values *= factors
        np.minimum(least, values.min(0), out=least)
    return least


def sketch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    masks, factors = permutations(BANDS * ROWS)
    cache: dict[bytes, bytes] = {}
    for batch in batches:
        counts, digests, signatures, bands = [], [], [], []
        for text in batch["__text"]:
            shingles = word_shingles(text, cache)
            counts.append(len(shingles))
            if not len(shingles):
                digests.append(None), signatures.append(None), bands.append(None)
                continue
            digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            signature = minhash(shingles, masks, factors)
            signatures.append(signature.tobytes())
            rows = signature.reshape(BANDS, ROWS).astype(np.uint64)
            key = np.arange(BANDS, dtype=np.uint64)
            for i in range(ROWS):
                key = (key ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(31)
            bands.append(key.view(np.int64))
        out = batch[["__row", "__id", "__hash"]].copy()
        out["n_shingles"], out["digest"], out["signature"], out["bands"] = counts, digests, signatures, bands
        yield out


def least_matches(hashes: int, batch: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """For each number of compared values, the fewest matches with which a pair may still be a link.

    With a uniform prior the similarity's posterior after m matches of n is
    Beta(m + 1, n - m + 1); its upper tail at the threshold is a binomial sum.
    """
    threshold, rules = percent / 100, []
    for n in range(batch, hashes + 1, batch):
        logs = [
            lgamma(n + 2) - lgamma(k + 1) - lgamma(n + 2 - k) + k * np.log(threshold) + (n + 1 - k) * np.log1p(-threshold)
            for k in range(n + 2)
        ]
        tail = np.cumsum(np.exp(logs))  # P(Beta > t) after m matches = P(Binomial(n + 1, t) <= m)
        rules.append((n, int(np.argmax(tail[: n + 1] >= miss))))
    return rules


def compare(one: np.ndarray, others: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """Places of the signatures in ``others`` that stay possible links of ``one``, batch by batch."""
    alive = np.arange(len(others))
    matches = np.zeros(len(others), np.int32)
    start = 0
    for end, least in rules:
        matches += (others[alive, start:end] == one[start:end]).sum(1, dtype=np.int32)
        keep = matches >= least
        alive, matches, start = alive[keep], matches[keep], end
        if not len(alive):
            break
    return alive


def spanning_links(count: int, related: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links from each component's first member to its others, for members 0 to count - 1.

    ``related(one, others)`` gives the places in ``others`` that are linked to
    ``one``.  Each member is compared once, with those not yet reached, so alike
    members cost one pass and no more than count - 1 links come out.
    """
    left, links = np.arange(count), []
    while len(left):
        root, left = left[0], left[1:]
        waiting = [root]
        while waiting and len(left):
            place = related(waiting.pop(), left)
            if len(place):
                reached = left[place]
                links += [(root, x) for x in reached]
                waiting += list(reached)
                left = np.delete(left, place)
    return links


def groups_of(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows sorted by ``key`` as frames of whole groups, with the groups' bounds in them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        keys = batch[key].to_numpy()
        changes = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        if held and (held[-1][key].iloc[-1].to_numpy() != keys[0]).any():
            yield from _whole(held, key)
            held = []
        if len(changes):
            yield from _whole([*held, batch.iloc[: changes[-1]]], key)
            held = [batch.iloc[changes[-1] :]]
        else:
            held.append(batch)
    if held:
        yield from _whole(held, key)


def _whole(parts: list[pd.DataFrame], key: list[str]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
    keys = rows[key].to_numpy()
    yield rows, np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(rows)]])


def per_group(rows: DataFrame, key: list[str], links: Callable) -> DataFrame:
    """Links (a, b) that ``links`` finds in the groups of ``rows``.

    The groups are met as sorted runs in a stream, so very many small ones cost
    no call or table each; a task holds a batch and one group.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, bounds in groups_of(batches, key):
            found = links(frame, bounds)
            yield pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

    return rows.repartition(*key).sortWithinPartitions(*key, "row").mapInPandas(run, "a long, b long")


def bucket_links(rows: pd.DataFrame, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Possible links within buckets (or two blocks of a large one)."""
    signatures = np.frombuffer(b"".join(rows["signature"]), np.uint32).reshape(len(rows), -1)
    rules = least_matches(signatures.shape[1], BATCH, PERCENT, MISS)
    ids, sizes = rows["row"].to_numpy(), np.diff(bounds)
    # Buckets of two, nearly all there are, are compared together.
    first = bounds[:-1][sizes == 2]
    alive, matches, start = first, np.zeros(len(first), np.int64), 0
    for end, least in rules:
        matches += (signatures[alive, start:end] == signatures[alive + 1, start:end]).sum(1)
        keep = matches >= least
        alive, matches, start = alive[keep], matches[keep], end
    links = list(zip(ids[alive], ids[alive + 1]))
    for low, size in zip(bounds[:-1][sizes > 2], sizes[sizes > 2]):
        own, names = signatures[low : low + size], ids[low : low + size]
        found = spanning_links(size, lambda one, others: compare(own[one], own[others], rules))
        links += [(names[a], names[b]) for a, b in found]
    return links


def verify_links(rows: pd.DataFrame, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Links with the exact similarity within groups of possible duplicates (or two blocks of one)."""
    cache: dict[bytes, bytes] = {}
    ids, texts = rows["row"].to_numpy(), rows["text"].to_numpy()
    links = []
    for low, high in zip(bounds, bounds[1:]):
        sets = [word_shingles(text, cache) for text in texts[low:high]]
        links += [(ids[low + a], ids[low + b]) for a, b in exact_links(sets)]
    return links


def exact_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning set of the links between shingle sets, by place."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    values, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(inverse, kind="stable")
    posting_owner = owners[order]
    posting_start = np.searchsorted(inverse[order], np.arange(len(values) + 1))

    def related(one: int, others: np.ndarray) -> np.ndarray:
        own = inverse[starts[one] : starts[one + 1]]
        lengths = posting_start[own + 1] - posting_start[own]
        offsets = np.repeat(posting_start[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        common = np.bincount(posting_owner[offsets + np.arange(lengths.sum())], minlength=len(sizes))[others]
        union = sizes[one] + sizes[others] - common
        return np.flatnonzero(100 * common >= PERCENT * union)

    return spanning_links(len(sizes), related)


def in_blocks(members: DataFrame, blocks: str = "blocks") -> DataFrame:
    """Members of each group, repeated so that every two blocks of it meet in a task.

    ``blocks`` is the number of blocks of the row's group.  A group of one block
    is one task's; of n blocks, each member is in n - 1 (or n) pairs of blocks.
    """
    own = F.pmod(F.xxhash64("row", F.lit(7)), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col(blocks) - 1).cast("int")))
    spread = members.withColumn("__own", own).withColumn("__other", other)
    spread = spread.filter((F.col("__own") != F.col("__other")) | (F.col(blocks) == 1))
    pair = {"__low": F.least("__own", "__other"), "__high": F.greatest("__own", "__other")}
    return spread.withColumns(pair).drop("__own", "__other", blocks)


def named_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("__id"), F.xxhash64(text).alias("__hash"), F.col(text).alias("__text")
    )


def sketch(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Row number, id, size, set digest, signature and band keys of every document, stored."""
    rows = numbered(named_texts(docs, doc_id, text), "__id", "__hash", "__text")
    return write_shared(rows.mapInPandas(sketch_batches, f"{ROW} long, {SKETCH}"), "sketches")


def group_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash (xxhash64 of the text).

    Documents are linked when their sets of five-word shingles (64-bit hashes)
    have a Jaccard similarity of 0.75 or more; components are those of the links.

    1. Equal sets are represented by one row.
    2. Representatives that share a band of their signatures form buckets.  In a
       bucket, signatures are compared in batches and a pair is dropped once its
       posterior of being a link falls under ``MISS``; of the others a spanning
       set is kept.  Buckets are cut into blocks, of which every two meet.
    3. Representatives so connected, with their whole texts, are compared exactly,
       again in blocks, and a spanning set of true links is kept.
    4. Components of the true links.

    NULL or wordless texts have no shingles and are linked with nothing.  The
    component's id is its smallest doc_id (NULL ids aside); ``kept`` marks one
    row of each component, that with the smallest doc_id, and of rows with the
    same id the first.  An empty table gives no rows; other columns are ignored.
    """
    sketches = sketch(docs, doc_id, text)
    full = sketches.filter("n_shingles > 0")
    copies = full.groupBy("digest", "n_shingles").agg(F.min(ROW).alias("representative"))
    firsts = write_shared(copies.select(F.col("representative").alias("row")), "representatives")

    # Both sides of the wide joins are shuffled whatever their size, so that disk grows with the input alone.
    kept = full.join(firsts.hint("merge"), full[ROW] == firsts["row"], "left_semi")
    keys = kept.select(F.col(ROW).alias("row"), F.explode("bands").alias("band"))
    buckets = keys.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1")
    members = write_shared(keys.join(buckets.hint("merge"), "band"), "buckets")
    members = members.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    signatures = full.select(F.col(ROW).alias("row"), "signature")
    spread = in_blocks(members.drop("members").join(signatures.hint("merge"), "row"))
    possible = connected(per_group(spread, ["band", "__low", "__high"], bucket_links))

    sizes = full.select(F.col(ROW).alias("row"), "n_shingles", "__id", "__hash")
    grouped = possible.select(F.col("node").alias("row"), "root").join(sizes, "row")
    totals = grouped.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    grouped = write_shared(grouped.join(totals, "root").select("row", "root", "blocks", "__id", "__hash"), "possible")
    # The texts are found again by id and hash; rows alike in both have the same text.
    texts = named_texts(docs, doc_id, text).withColumnsRenamed({"__id": "own_id", "__hash": "own_hash", "__text": "text"})
    same = F.col("own_id").eqNullSafe(F.col("__id")) & (F.col("own_hash") == F.col("__hash"))
    found = texts.join(grouped.hint("merge"), same).select("row", "root", "blocks", "text").dropDuplicates(["row"])
    spread = in_blocks(found)
    exact = per_group(spread, ["root", "__low", "__high"], verify_links)

    roots = connected(exact).withColumnRenamed("node", "representative")
    equal = copies.join(roots, "representative", "left").select(
        "digest", "n_shingles", F.coalesce("root", "representative").alias("root")
    )
    placed = full.select(ROW, "__id", "__hash", "digest", "n_shingles").join(equal, ["digest", "n_shingles"]).drop("digest")
    single = sketches.filter("n_shingles = 0").select("n_shingles", ROW, "__id", "__hash", F.col(ROW).alias("root"))
    placed = placed.unionByName(single)
    order = F.struct(F.col("__id").isNull().alias("unnamed"), F.col("__id").alias("id"), F.col(ROW).alias("row"))
    chosen = placed.groupBy("root").agg(F.min(order).alias("chosen"))
    return placed.join(chosen, "root").select(
        F.col("__id").alias("doc_id"),
        "n_shingles",
        F.col("chosen.id").alias("component_id"),
        (F.col("chosen.row") == F.col(ROW)).alias("kept"),
        F.col("__hash").alias("text_hash"),
    )
