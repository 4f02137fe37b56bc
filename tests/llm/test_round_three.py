"""Exact duplicates, the manifest and the divergence audit against plain Python, edge cases included."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tillstar.llm import divergence, exactdup, manifest

LONG = "Ab cé\n" * 60_000
ROWS = [
    (5, "same  text\n", "en", "a"), (3, "same text ", "en", "b"), (3, "same text ", "en", "b"), (4, "Same text ", "en", None),
    (6, None, None, "a"), (7, "", "en", "a"), (8, " \t\n", "en", "a"), (9, " ", "de", "a"), (None, LONG, "en", "a"),
    (2, LONG.replace("\n", " \r\n"), "en", "a"), (None, "no id", "en", "a"), (None, "no id", "en", "a"),
    (11, "x" * 300 + "y", "en", "a"), (12, "x" * 300 + "z", "en", "a"), (13, "same text ", "en", "a"),
]


def squeezed(text):
    out = []
    for c in text or "":
        c = " " if c in " \t\n\x0b\x0c\r" else c
        if not (c == " " and out[-1:] == [" "]):
            out.append(c)
    return "".join(out)


def least_id(ids):
    return min(ids, key=lambda i: (i is None, i or 0))


def check_groups(rows, told):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[squeezed(text)].append(doc_id)
    want = Counter((i, least_id(ids), len(ids)) for ids in groups.values() for i in ids)
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in told) == want
    kept = [r for r in told if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("bits", [1 << 16, 1 << 26])
def test_equal_texts(frame, bits):
    told = exactdup.group_equal(frame(ROWS), filter_bits=bits).collect()
    check_groups(ROWS, told)
    by_id = {r.doc_id: r for r in told}
    assert by_id[11].settled_by == by_id[12].settled_by == "full"  # only the whole text tells them apart
    assert by_id[4].settled_by == "prefix" and by_id[4].digest is None
    for r in exactdup.group_equal(frame([(1, "one"), (2, "three")]), all_digests=True).collect():
        assert r.settled_by == "length" and bytes(r.digest) == hashlib.sha256({1: b"one", 2: b"three"}[r.doc_id]).digest()
    assert exactdup.group_equal(frame([])).collect() == []


def test_one_group_of_a_third(spark, frame):
    draw = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"w{draw.randrange(400)} {draw.choice([' ', ''])}x", "en", "a") for i in range(1500)]
    check_groups(rows, exactdup.group_equal(frame(rows)).collect())


def test_the_filter_lets_every_member_pass(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    for bits in (64, 1 << 17):
        bitmap = exactdup.filter_of(keys, "k", bits)
        rows = exactdup.passes(spark.range(3000).withColumnRenamed("id", "k"), "k", bitmap, bits, "hit").collect()
        assert all(r.hit for r in rows if r.k % 3 == 0)
        if bits > 64:
            assert sum(r.hit for r in rows) < 1050


# The manifest -------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute_manifest(rows, names):
    """Counter of (order, leaf, subroot, root, siblings of all levels)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, digest(*(field(r[n]) for n in names)), r["doc_id"]))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for *_, leaf, _ in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = Counter()
    for k, s in enumerate(order):
        for i, (*_, leaf, doc_id) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            siblings = []
            for levels, at in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    siblings.append("".join(x for j, x in enumerate(level) if j // 16 == at // 16 and j != at))
                    at //= 16
            out[doc_id, leaf, trees[s][-1][0], top[-1][0], tuple(siblings)] += 1
    return out


NAMES = ("doc_id", "source", "lang", "text")


@pytest.mark.parametrize("chunk_levels", [1, 3])
def test_manifest_and_proofs(spark, frame, monkeypatch, chunk_levels):
    monkeypatch.setattr(manifest, "LOCAL_LEVELS", chunk_levels)
    monkeypatch.setattr(manifest, "CHUNK", 16**chunk_levels)
    rows = ROWS + [(100 + i, f"T{i}", "en", "big") for i in range(600)] + [(800 + i, "", None, f"s{i}") for i in range(20)]
    docs = frame(rows)
    told = manifest.prove_documents(
        docs, NAMES, changed=lambda held: (held["doc_id"] % 2 == 0, {"text": F.lower(held["text"])})
    )
    told = told.withColumns({
        "same": manifest.folded(F.col("leaf"), F.col("places"), F.col("siblings")) == F.col("root"),
        "other": manifest.folded(F.col("changed_leaf"), F.col("places"), F.col("siblings")) == F.col("root"),
    }).collect()
    given = [dict(zip(("doc_id", "text", "lang", "source"), r)) for r in rows]
    assert Counter((r.order, r.leaf, r.subroot, r.root, tuple(r.siblings)) for r in told) == brute_manifest(given, NAMES)
    texts = {r["doc_id"]: r["text"] for r in given}
    for r in told:
        assert r.same
        if r.order is not None and r.order % 2 == 0:
            lower = texts[r.order] and texts[r.order].lower()
            assert r.other == (lower == texts[r.order])
        else:
            assert r.changed_leaf is None


def test_manifest_of_few_rows(frame):
    assert manifest.prove_documents(frame([]), NAMES).collect() == []
    (only,) = manifest.prove_documents(frame([(1, None, None, None)]), NAMES).collect()
    assert only.leaf == only.subroot == only.root == digest("1:1---") and only.places == [] and only.siblings == []


def test_missing_runs_are_the_least(spark):
    wanted = manifest.missing(F.lit(35).cast("long"), 3, F.lit(6))
    (row,) = spark.range(1).select(wanted.alias("x")).collect()
    assert [(r.level, r.run, r.at) for r in row.x] == [(3, 2, 3), (4, 0, 2), (5, 0, 0)]
    assert spark.range(1).select(manifest.missing(F.lit(0), 3, F.lit(3)).alias("x")).first().x is None


# The divergence audit -----------------------------------------------------------


def terms_of(text):
    word, out = "", []
    for c in (text or "") + " ":
        if c.isascii() and not c.isalpha():
            out += [word] * bool(word)
            word = ""
        else:
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
    return out


def brute_audit(rows, least=10, top=10):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        counts[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = set()
    for lang, names in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = Counter({t: sum(counts[lang, s][t] for s in names) for t in kept})

        def shares(count):
            n = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // n for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in names}, shares(total)
        for s in names:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in names - {s}]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)}
    return out


def test_audit_against_plain_python(frame, monkeypatch):
    draw = random.Random(11)
    words = ["the", "THE", "of", "été", "Été", "a1b", "\U0001f600", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else draw.choice(["b", "c", None, "", "d"])
        text = " ".join(draw.choice(words) for _ in range(draw.randrange(40)))
        rows.append((i % 300, text, draw.choice(["en", "de", None]), source))
    rows += [(900, None, "en", "silent"), (901, "", "xx", "p"), (902, "lone words", "xx", "q"), (903, LONG, "en", "b")]
    wanted = brute_audit(rows)
    told = lambda: {tuple(r) for r in divergence.audit(frame(rows)).select("lang", "source", "part", "item", "value", "rank").collect()}
    assert told() == wanted
    # With the least stores tasks hand their sums on at every turn, and trees are built of few rows.
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    monkeypatch.setattr(divergence, "MATRIX_CELLS", 10)
    assert told() == wanted
    assert divergence.audit(frame([])).collect() == []


def test_tree_nodes_and_multiplicities():
    rows = np.array([[1, 2, -1], [1, 2, 3], [1, 4, -1], [2, 4, 5]])
    tree_ = divergence.Tree(rows, np.array([10, 1, 2, 7]))
    found = [tuple(map(list, tree_.nodes(d))) for d in range(3)]
    assert found == [([0, 3], [13, 7]), ([0, 2, 3], [11, 2, 7]), ([1, 3], [1, 7])]


def test_corrections_of_pairs_that_repeat():
    items = [[("a", 5, 1), ("b", 9, 2)], [("a", 5, 1), ("b", 9, 2), ("c", 4, 3)]]
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
    lists = pa.array([[dict(zip(("source", "p", "p0"), x)) for x in row] for row in items], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), lists, pa.array([3, 1])], ["lang", "items", "times"])
    (out,) = divergence.pair_corrections(iter([batch]))
    f = lambda p, q: (p - q) ** 2 // (p + q)
    change = lambda p, p0, q, q0: f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)
    told = {(r["a"], r["b"]): r["value"] for r in out.to_pylist()}
    assert told == {("a", "b"): 4 * change(5, 1, 9, 2), ("a", "c"): change(5, 1, 4, 3), ("b", "c"): change(9, 2, 4, 3)}
