"""The methods inside the operators, against enumeration or exact round trips."""

from __future__ import annotations

import math
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstar.llm import grammar, licenses, neardup, packing, substrings, toxicity
from tillstar.llm.components import connected


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(1)
    emission, lengths, chain = draw.normal(size=(3, 5)), np.array([5, 3, 1]), draw.normal(size=(2, 2))
    toxic, log_z, moves = toxicity.marginals(emission, lengths, chain)
    expected_moves = np.zeros((2, 2))
    for i, n in enumerate(lengths):
        weights = {}
        for labels in product((0, 1), repeat=int(n)):
            score = sum(emission[i, k] for k in range(n) if labels[k])
            weights[labels] = np.exp(score + sum(chain[a, b] for a, b in zip(labels, labels[1:])))
        z = sum(weights.values())
        for k in range(n):
            assert toxic[i, k] == pytest.approx(sum(w for x, w in weights.items() if x[k]) / z)
        assert np.log(z) == pytest.approx(log_z[i])
        for labels, w in weights.items():
            for a, b in zip(labels, labels[1:]):
                expected_moves[a, b] += w / z
    assert moves == pytest.approx(expected_moves)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=200), min_size=1, max_size=8))
def test_grammar_round_trip(docs):
    base = 6
    encoded = [np.array([*d, 1], "<u2").tobytes() for d in docs]
    names = [x.split()[0] for x in grammar.SHARD.split(", ")]
    shard = dict(zip(names, grammar.shard_row(0, 0, list(range(len(docs))), encoded, base)))
    rules = np.frombuffer(shard["rules"], "<u2").reshape(-1, 2)
    whole = grammar.expand(np.frombuffer(shard["sequence"], "<u2"), rules, base)
    assert whole.tolist() == [x for d in docs for x in [*d, 1]]
    for k, d in enumerate(docs):
        own = [*d, 1]
        for start, length in ((0, len(own)), (len(own) // 2, 3), (len(own) - 1, 1)):
            assert grammar.decode_range(shard, k, start, length).tolist() == own[start : start + length]


def test_grammar_compresses():
    ids = np.tile(np.arange(10, dtype=np.uint32), 1000)
    ends = np.zeros(len(ids), bool)
    ends[-1] = True
    sequence, _, rules, lengths = grammar.compress(ids, ends, 10)
    assert len(sequence) < len(ids) / 20 and lengths.max() >= 10
    assert (grammar.expand(sequence, rules, 10) == ids).all()


def test_posterior_bounds():
    rules = neardup.least_matches(120, 12, 75, 1e-4)
    assert [n for n, _ in rules] == list(range(12, 121, 12))
    assert all(a <= b for (_, a), (_, b) in zip(rules, rules[1:]))
    draw = np.random.default_rng(3)
    found = draw.random((20_000, 120)) < 0.75  # pairs at the threshold
    alive = np.ones(len(found), bool)
    for n, least in rules:
        alive &= found[:, :n].sum(1) >= least
    assert alive.mean() > 0.99
    dropped = (draw.random((20_000, 120)) < 0.4).sum(1) >= rules[-1][1]
    assert dropped.mean() < 0.001


def test_spanning_links_reach_whole_components():
    near = lambda one, others: np.flatnonzero(np.abs(others - one) == 1)
    assert {b for _, b in neardup.spanning_links(50, near)} == set(range(1, 50))
    assert neardup.spanning_links(5, lambda one, others: np.empty(0, int)) == []


def test_exact_links_are_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    at, below = np.arange(75, dtype=np.uint64), np.arange(74, dtype=np.uint64)
    assert neardup.exact_links([a, at]) == [(0, 1)] and neardup.exact_links([a, below]) == []


def test_components(spark):
    draw = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(5000, 5001 + i) for i in range(100)] + [(None, 3), (7, 7)]
    from brute import Groups

    nodes = sorted({x for a, b in links if None not in (a, b) and a != b for x in (a, b)})
    place = {x: i for i, x in enumerate(nodes)}
    groups = Groups(len(nodes))
    for a, b in links:
        if None not in (a, b) and a != b:
            groups.join(place[a], place[b])
    least = {}
    for x in nodes:
        least.setdefault(groups.find(place[x]), x)
    frame = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in connected(frame).collect()} == {x: least[groups.find(place[x])] for x in nodes}
    assert connected(frame.limit(0)).collect() == []


def test_runs_do_not_depend_on_what_stands_before():
    passage = " ".join(f"The thing {i} was seen, as they say, near the river by many people." for i in range(8))
    alone = set(substrings.runs_of(passage)[2])
    after = set(substrings.runs_of("No stop before this " + passage + " And behind.")[2])
    assert len(alone) >= 6 and len(alone & after) == len(alone) - 1  # the first sentence has grown


def test_sentence_starts():
    text = "One. Two 1.5 is!  Three?\nFour"
    starts = substrings.sentence_starts(text)
    assert [text[a:b] for a, b in zip(starts, starts[1:])] == ["One. ", "Two 1.5 is!  ", "Three?\n", "Four"]


def test_neighbours_are_the_most_alike():
    texts = [[1, 2, 3, 4], [9, 8, 7], [1, 2, 3, 5], [4, 11, 12], [9, 20]]
    sizes = np.array([len(t) for t in texts])
    index = packing.Index(np.array([x for t in texts for x in t], np.uint16), sizes)
    unused = np.ones(5, bool)
    unused[[0, 1]] = False
    assert list(index.neighbours(0, unused)) == [2, 3]
    assert list(index.neighbours(1, unused)) == [4]


def bm25(docs, seed):
    """Every document's score for the seed's terms, counted term by term."""
    mean, found = sum(map(len, docs)) / len(docs), []
    df = Counter(t for d in docs for t in set(d))
    for d in docs:
        tf, norm = Counter(d), 1.2 * (0.25 + 0.75 * len(d) / mean)
        shared = [t for t in set(docs[seed]) & set(d) if df[t] > 1]
        found.append(sum(math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + norm) for t in shared))
    return found


def random_docs(count):
    """Documents of many terms, rare and frequent ones; most share far more than 24 with others."""
    draw = np.random.default_rng(11)
    sizes = draw.integers(1, 300, count)
    return [np.minimum(draw.pareto(0.6, size) * 3, 60000).astype(np.uint16).tolist() for size in sizes]


def test_neighbours_are_scored_by_all_terms():
    docs = random_docs(300)
    index = packing.Index(np.array([x for d in docs for x in d], np.uint16), np.array([len(d) for d in docs]))
    for seed in range(0, 300, 7):
        unused = np.arange(300) % 5 != seed % 5
        score = np.array(bm25(docs, seed))
        assert np.allclose(index.scores(seed), score, rtol=1e-5, atol=1e-5)
        found = list(index.neighbours(seed, unused))
        assert sorted(found) == [d for d in range(300) if unused[d] and score[d] > 0]
        assert (np.diff(score[found]) <= 1e-4).all()


def test_a_neighbour_may_share_frequent_terms_only():
    """One that shares all but a seed's 30 rarest terms goes before one that shares a few of these."""
    rare, plain = list(range(100, 130)), list(range(200, 280))
    seed, like, unlike = rare + plain, plain, rare[:2] + list(range(300, 380))
    others = [[x, 400 + i, 500 + i] for i, x in enumerate(plain)] + [[x] for x in rare]
    docs = [seed, unlike, like, *others]
    packer = packing.Packer(len(seed) + len(like), 0)
    packing.pack_shard(packer, list(range(len(docs))), [np.array(d, "<u2").tobytes() for d in docs])
    assert [row[0] for row in packer.rows if row[5] == 0] == [0, 2]


def test_license_classifier_on_noisy_notices():
    plain = [f"the quick brown fox number {i} jumps over lazy dogs and runs away" for i in range(300)]
    model = licenses.fit(plain)
    draw = np.random.default_rng(99)
    right = total = 0
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            words = licenses.WORD.findall(text.lower())
            if len(words) < 5:
                continue
            for _ in range(10):
                told = licenses.judge(model, licenses.noisy(words, ["fox", "lazy", "runs"], draw, True))
                right += bool(told) and told[0] in (family, licenses.UNKNOWN)
                total += 1
    assert right / total > 0.9
    assert all(licenses.judge(model, licenses.WORD.findall(x)) is None for x in plain)


def test_marginals_of_long_texts_are_those_of_one_chain():
    draw = np.random.default_rng(5)
    sizes = [0, 5, 127, 128, 129, 1000, 3, 0, 777]
    values, chain = draw.normal(-1, 3, sum(sizes)), draw.normal(0, 1.5, (2, 2))
    whole, at = [np.empty(0)], 0
    for size in sizes:
        if size:
            whole.append(toxicity.marginals(values[None, at : at + size], np.array([size]), chain)[0][0])
        at += size
    found = toxicity.document_marginals(values, sizes, chain)
    assert np.allclose(found, np.concatenate(whole), atol=1e-12)
    assert not len(toxicity.document_marginals(np.empty(0), [0, 0], chain))
