"""Toxic spans tagged by a linear-chain conditional random field."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)

# Bounds of the labelled sample that the model is fitted on.
MOST_TOXIC = 1500
MOST_CLEAN = 4500
MOST_CHARS = 20_000  # of a document that is learnt from; longer ones are only scored

MARKER_G2 = 20.0  # log-likelihood ratio from which a feature marks tokens of toxic documents as toxic
MARKER_RATIO = 5.0
USED_G2 = 3.84  # of a feature that the model may weigh
SEQUENCE = 128  # tokens of a strip; the fit takes each as a chain, scores hand the state on from strip to strip
EPOCHS, RATE, SHRINK = 80, 0.2, 1e-4
CACHE_WORDS = 300_000  # words whose scores a task keeps


def features(word: str) -> list[str]:
    """The lower-cased word itself and its beginnings."""
    word = word.lower()
    return ["=" + word, *(word[:k] for k in PREFIXES if len(word) >= k)]


@dataclass
class Model:
    """Weights of features for the toxic label, chain weights, and the document calibration."""

    weights: dict[str, float]
    bias: float
    chain: np.ndarray  # log weight of going from label (row) to label (column)
    document: np.ndarray  # weights of document_features()

    def word_score(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def marginals(
    emission: np.ndarray,
    lengths: np.ndarray,
    chain: np.ndarray,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: P(toxic) per token, log normaliser per chain, expected transitions.

    ``emission`` (chains x steps) is the score of the toxic label, that of the other is 0.
    ``before`` (2 x chains) are the weights of the labels of the token before, 0 where there is
    none; ``after`` the weights of what follows, by the label of the last token.
    """
    n, steps = emission.shape
    inside = np.arange(steps) < lengths[:, None]
    e = np.exp(np.clip(np.where(inside, emission, 0.0), -30, 30))
    t = np.exp(chain)
    forward = np.empty((steps, 2, n))
    log_z = np.zeros(n)
    for k in range(steps):
        if k == 0:
            a0, a1 = np.ones(n), e[:, 0]
            if before is not None:
                p0, p1 = before
                begins = p0 + p1 == 0
                a0 = np.where(begins, a0, p0 * t[0, 0] + p1 * t[1, 0])
                a1 = np.where(begins, a1, (p0 * t[0, 1] + p1 * t[1, 1]) * e[:, 0])
        else:
            p0, p1 = forward[k - 1]
            a0, a1 = p0 * t[0, 0] + p1 * t[1, 0], (p0 * t[0, 1] + p1 * t[1, 1]) * e[:, k]
        scale = np.where(inside[:, k], a0 + a1, 1.0)
        log_z += np.log(scale)
        forward[k, 0], forward[k, 1] = a0 / scale, a1 / scale
        if k:
            out = ~inside[:, k]
            forward[k][:, out] = forward[k - 1][:, out]
    toxic = np.zeros((n, steps))
    b0, b1 = (np.ones(n), np.ones(n)) if after is None else after
    moves = np.zeros((2, 2))
    for k in range(steps - 1, -1, -1):
        f0, f1 = forward[k]
        total = f0 * b0 + f1 * b1
        toxic[:, k] = np.where(inside[:, k], f1 * b1 / total, 0.0)
        if k:
            here = inside[:, k]
            g0, g1 = b0, b1 * e[:, k]
            p0, p1 = forward[k - 1]
            pairs = np.stack([p0 * t[0, 0] * g0, p0 * t[0, 1] * g1, p1 * t[1, 0] * g0, p1 * t[1, 1] * g1])
            moves += (pairs / pairs.sum(0) * here).sum(1).reshape(2, 2)
            c0, c1 = t[0, 0] * g0 + t[0, 1] * g1, t[1, 0] * g0 + t[1, 1] * g1
            norm = np.where(here, c0 + c1, 1.0)
            b0, b1 = np.where(here, c0 / norm, b0), np.where(here, c1 / norm, b1)
    return toxic, log_z, moves


def transfers(emission: np.ndarray, lengths: np.ndarray, chain: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Per strip the weights of all ways from the label before it to that of its last token: 2 x 2 x strips.

    A strip that ``begins`` a text has the same weights whatever comes before.
    """
    n, steps = emission.shape
    e = np.exp(np.clip(emission, -30, 30))
    t = np.exp(chain)
    ways = np.zeros((2, 2, n))
    ways[0, 0] = ways[1, 1] = 1.0
    for k in range(steps):
        to0 = ways[:, 0] * t[0, 0] + ways[:, 1] * t[1, 0]
        to1 = (ways[:, 0] * t[0, 1] + ways[:, 1] * t[1, 1]) * e[:, k]
        if k == 0:
            to0, to1 = np.where(begins, 1.0, to0), np.where(begins, e[:, 0], to1)
        scale = (to0 + to1).sum(0)
        here = k < lengths
        ways[:, 0], ways[:, 1] = np.where(here, to0 / scale, ways[:, 0]), np.where(here, to1 / scale, ways[:, 1])
    return ways


def document_marginals(values: np.ndarray, sizes: list[int], chain: np.ndarray) -> np.ndarray:
    """P(toxic) of every token of consecutive documents, each one chain however long.

    All strips are gone through side by side.  A first pass gives the weights of
    the ways through each; multiplied along a document they give the state at
    both ends of every strip, from which the marginals are those of the whole chain.
    """
    padded, lengths, place = in_chains(values, sizes)
    if not len(place):
        return np.empty(0)
    strips = -(-np.array(sizes) // SEQUENCE)
    first = np.cumsum(strips) - strips
    nth = np.arange(len(lengths)) - np.repeat(first, strips)  # of its document
    before, after = np.zeros((2, len(lengths))), np.ones((2, len(lengths)))
    if nth.any():
        ways = transfers(padded, lengths, chain, nth == 0)
        state = before.copy()
        order = np.argsort(nth, kind="stable")
        groups = np.split(order, np.flatnonzero(np.diff(nth[order])) + 1)
        state[0, groups[0]] = 1.0
        for k, now in enumerate(groups):
            if k:
                before[:, now] = state[:, now] = state[:, now - 1]
            out = (state[:, None, now] * ways[:, :, now]).sum(0)
            state[:, now] = out / out.sum(0)
        for now in reversed(groups[1:]):
            back = (ways[:, :, now] * after[None, :, now]).sum(1)
            after[:, now - 1] = back / back.sum(0)
    return marginals(padded, lengths, chain, before, after)[0].ravel()[place]


def in_chains(values: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of consecutive documents as padded strips of at most SEQUENCE tokens.

    Returns the padded matrix, the strips' lengths, and each value's flat place in the matrix.
    """
    lengths = [
        np.diff(np.append(np.arange(0, size, SEQUENCE), size)) if size else np.empty(0, np.int64) for size in sizes
    ]
    lengths = np.concatenate(lengths).astype(np.int64) if lengths else np.empty(0, np.int64)
    if not len(lengths):
        return np.zeros((0, 1)), lengths, np.empty(0, np.int64)
    steps = int(lengths.max())
    starts = np.cumsum(lengths) - lengths
    place = np.repeat(np.arange(len(lengths)) * steps - starts, lengths) + np.arange(lengths.sum())
    padded = np.zeros(len(lengths) * steps, values.dtype)
    padded[place] = values
    return padded.reshape(len(lengths), steps), lengths, place


def ratio_g2(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log-likelihood ratio of a feature's document counts against independence (positive cells only)."""
    every = n_toxic + n_clean
    total, out = toxic + clean, 0.0
    for seen, size in ((toxic, n_toxic), (clean, n_clean)):
        if seen:
            out += seen * np.log(seen * every / (total * size))
        if size - seen:
            out += (size - seen) * np.log((size - seen) * every / max((every - total) * size, 1))
    return 2 * out


def _gather(values: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the given rows of a ragged table, and each one's place among ``rows``."""
    lengths = first[rows + 1] - first[rows]
    stops = np.cumsum(lengths)
    place = np.repeat(np.arange(len(rows)), lengths)
    return values[np.repeat(first[rows] - (stops - lengths), lengths) + np.arange(len(place))], place


def document_features(toxic: np.ndarray) -> list[float]:
    """What a document's marginals say: a constant, expected toxic tokens, their density, the surest token."""
    expected, most = (float(toxic.sum()), float(toxic.max())) if len(toxic) else (0.0, 0.0)
    sure = np.log((most + 1e-4) / (1 - most + 1e-4))
    return [1.0, np.log(expected + 1e-3), np.log((expected + 1e-3) / (len(toxic) + 10)), sure]


def calibrate(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(rows.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (rows.shape[1] - 1)) * 1.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        gradient = rows.T @ (p - labels) + ridge @ w
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str], labels: list[int]) -> Model | None:
    """Train on whole documents with a toxic label each; None if only one label is there.

    1. Features that are far more frequent among toxic documents label the
       tokens: in a toxic document a token with such a feature is toxic, all
       others are not.
    2. The chain's weights are fitted to these tokens by gradient ascent.
    3. Documents are calibrated on their marginals.
    """
    labels = np.array(labels, float)
    n_toxic, n_clean = int(labels.sum()), int((1 - labels).sum())
    if not n_toxic or not n_clean:
        return None
    # Texts become numbers of words, and words numbers of features, so each string is held once.
    words: dict[str, int] = {}
    docs = [
        np.fromiter((words.setdefault(w.lower(), len(words)) for w in WORD.findall(text)), np.int32) for text in texts
    ]
    names: dict[str, int] = {}
    own = [np.array([names.setdefault(f, len(names)) for f in features(w)], np.int32) for w in words]
    first = np.cumsum([0, *map(len, own)])
    own = np.concatenate([*own, np.empty(0, np.int32)])
    counts = np.zeros((2, len(names)), np.int64)
    for doc, label in zip(docs, labels):
        counts[int(label), np.unique(_gather(own, first, np.unique(doc))[0])] += 1
    marker, used, kept = np.zeros(len(names), bool), np.full(len(names), -1, np.int64), []
    for feature, number in names.items():
        clean, toxic = (int(n) for n in counts[:, number])
        if not toxic:
            continue
        g2 = ratio_g2(toxic, clean, n_toxic, n_clean)
        if g2 >= MARKER_G2 and (toxic + 0.5) * n_clean >= MARKER_RATIO * (clean + 0.5) * n_toxic:
            marker[number] = True
        if g2 >= USED_G2:
            used[number] = len(kept)
            kept.append(feature)
    sizes = [len(doc) for doc in docs]
    at = sum(sizes)
    if not at:
        return None
    marked = np.zeros(len(words), bool)
    np.logical_or.at(marked, np.repeat(np.arange(len(words)), np.diff(first)), marker[own])
    targets = [marked[doc] & (label == 1) for doc, label in zip(docs, labels)]
    found, where = _gather(own, first, np.concatenate(docs))
    which = used[found]
    where, which = where[which >= 0], which[which >= 0]
    del docs, words, names, own, found
    truth, lengths, place = in_chains(np.concatenate(targets).astype(float), sizes)
    steps = truth.shape[1]
    inside = np.arange(steps) < lengths[:, None]
    both = truth[:, 1:].astype(int) + 2 * truth[:, :-1].astype(int)
    seen_moves = np.bincount(both[inside[:, 1:]], minlength=4).reshape(2, 2).astype(float)
    flat_truth = truth.ravel()[place]
    theta = np.zeros(len(kept) + 1)
    theta[-1] = -3.0
    chain = np.zeros((2, 2))
    squares, chain_squares = np.full(len(theta), 1e-8), np.full((2, 2), 1e-8)
    for _ in range(EPOCHS):
        emission = theta[-1] + np.bincount(where, theta[which], minlength=at)
        padded = np.zeros(truth.size)
        padded[place] = emission
        toxic, _, moves = marginals(padded.reshape(truth.shape), lengths, chain)
        error = flat_truth - toxic.ravel()[place]
        gradient = np.append(np.bincount(which, error[where], minlength=len(kept)), error.sum())
        gradient[:-1] -= SHRINK * at * theta[:-1] * 0.01
        chain_gradient = seen_moves - moves
        squares += gradient**2
        chain_squares += chain_gradient**2
        theta += RATE * 5 * gradient / np.sqrt(squares)
        chain += RATE * chain_gradient / np.sqrt(chain_squares)
    rows, end = [], np.cumsum(sizes)
    found = document_marginals(emission, sizes, chain)
    for size, stop in zip(sizes, end):
        rows.append(document_features(found[stop - size : stop]))
    weights = {f: float(theta[i]) for i, f in enumerate(kept) if abs(theta[i]) > 0.01}
    return Model(weights, float(theta[-1]), chain, calibrate(np.array(rows), labels))


def score_batches(model: Model):
    """A function for mapInPandas that scores whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, float] = {}
        for batch in batches:
            scores, spans = [], []
            for at in range(0, len(batch), 200):
                texts = batch["__text"].iloc[at : at + 200].tolist()
                sizes, emissions = [], []
                for text in texts:
                    words = WORD.findall(text) if text else []
                    if len(cache) > CACHE_WORDS:
                        cache.clear()
                    for word in set(words).difference(cache):
                        cache[word] = model.word_score(word)
                    sizes.append(len(words))
                    emissions.append(np.fromiter(map(cache.__getitem__, words), np.float64, len(words)))
                toxic = document_marginals(np.concatenate(emissions), sizes, model.chain)
                stops = np.cumsum(sizes)
                for text, size, stop in zip(texts, sizes, stops):
                    own = toxic[stop - size : stop]
                    scores.append(1 / (1 + np.exp(-np.clip(np.dot(document_features(own), model.document), -30, 30))))
                    spans.append(toxic_spans(text, own))
            out = batch.drop(columns="__text")
            out["score"], out["spans"] = scores, spans
            yield out

    return run


def toxic_spans(text: str | None, toxic: np.ndarray) -> list[dict[str, int]]:
    """Character offsets of runs of tokens that are toxic more likely than not."""
    if not len(toxic) or toxic.max() < 0.5:
        return []
    spans, last = [], -2
    for k, found in enumerate(WORD.finditer(text)):
        if toxic[k] >= 0.5:
            if last == k - 1:
                spans[-1]["end"] = found.end()
            else:
                spans.append({"start": found.start(), "end": found.end()})
            last = k
    return spans


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from the fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[list[str], list[int]]:
    """Texts and labels of a bounded sample of labelled documents, the same for the same rows.

    Of each label the documents with the smallest hashes of their ids are taken.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg((F.avg("toxic") >= 0.5).alias("toxic"))
    order = [F.xxhash64("__id"), "__id"]
    taken = known.filter("toxic").orderBy(*order).limit(MOST_TOXIC).unionByName(
        known.filter("NOT toxic").orderBy(*order).limit(MOST_CLEAN)
    )
    texts = docs.select(F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("text")).filter(
        F.length("text") <= MOST_CHARS
    )
    # At most MOST_TOXIC + MOST_CLEAN rows of two small columns are broadcast.
    rows = texts.join(F.broadcast(taken), "__id").select("__id", "text", "toxic").dropDuplicates(["__id"]).collect()
    rows.sort(key=lambda row: row["__id"])
    return [row["text"] for row in rows], [int(row["toxic"]) for row in rows]


def score_documents(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans.

    ``labels`` has doc_id and toxic (0 or 1).  Labels of ids whose crc32 leaves 1
    when divided by 3 are never used; of repeated labels the mean counts, NULL
    ones are ignored.  Only the text is an input of a score.  ``spans`` are the
    offending character offsets (end exclusive).

    NULL, empty and wordless texts get the score of a document without toxic
    tokens.  Without labels of both kinds every score is 0.  A NULL id is not
    held out.  Repeated rows are scored one by one, an empty table gives no rows.
    """
    model = fit(*sample(docs, labels, doc_id, text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("__text"))
    none = F.expr("cast(array() AS array<struct<start:int,end:int>>)")
    scored = rows.drop("__text").withColumn("score", F.lit(0.0)).withColumn("spans", none)
    if model is not None:
        scored = rows.mapInPandas(score_batches(model), scored.schema)
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"), "spans")
