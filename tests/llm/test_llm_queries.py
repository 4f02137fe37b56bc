"""The registered queries over the smallest tables, against DuckDB or plain Python."""

from __future__ import annotations

import sys
from collections import defaultdict
from pathlib import Path

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from oracle import spark_rows, sql_rows
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parents[2]))

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from tillstar.llm import oracles, queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    columns, expected = sql_rows(oracles.oracle_sql()[name], sf_dir)
    names, rows = spark_rows(queries.queries()[name](spark, sf_dir))
    assert (names, rows) == (columns, expected)


def test_all_are_registered():
    found = __spark_entry__.queries()
    numbers = sorted(int(name[2:].split("_")[0]) for name in found if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in found


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op2_toxicity(spark, sf).select("doc_id", "held_out", "score", "predicted", "spans").collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held) / len(held)
    caught = [r.predicted for r in held if labels[r.doc_id]]
    assert right > 0.97 and sum(caught) / len(caught) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    # Several doubtful tokens may make a document toxic together, with no sure one among them.
    predicted = [bool(r.spans) for r in rows if r.predicted]
    assert sum(predicted) / len(predicted) > 0.99


def test_packing_covers_every_id_once(spark, sf_dir, texts):
    pieces = queries.op3_packing(spark, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert set(own) == {doc_id for doc_id, _ in texts}
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(own[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == brute.zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at & (at - 1) == 0


def test_substrings_leave_no_long_passage_twice(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op4_substrings(spark, sf_dir).collect()}
    passages = defaultdict(set)
    for doc_id, row in rows.items():
        words = row.text.lower().split()
        for i in range(len(words) - 50):
            passages[" ".join(words[i : i + 51])].add(doc_id)
    assert not [p for p, found in passages.items() if len(found) > 1]
    for doc_id, text in texts:
        left, at = "", 0
        for cut in rows[doc_id].removed:
            left, at = left + text[at : cut.start], cut.end
        left += text[at:]
        assert rows[doc_id].text == (left.rstrip() if rows[doc_id].removed else left)


def test_near_duplicates(spark, sf_dir, texts):
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op7_neardup(spark, sf_dir).collect()}
    assert found == brute.near_duplicates(texts)


def test_quality(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in queries.op8_quality(spark, sf_dir).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for doc_id, text in texts:
        r = rows[doc_id]
        n, chars, symbols, lines, repeats = brute.statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 50 or 100 * repeats > 50 * n)
        if not r.base_failed and doc_id in labels:
            assert r.kept == bool(labels[doc_id])


def test_tokens(spark, sf_dir, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = brute.token_index(texts, lambda text: tokenizer.encode(text, add_special_tokens=False).ids)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op9_tokens(spark, sf_dir).collect()}
    assert found == expected


def test_licenses(spark, sf_dir, texts):
    told = {
        "Licensed under CC BY-NC 4.0": "cc-by-nc", "GNU General Public License, version 3": "gpl-3.0",
        "Apache License, Version 2.0": "apache-2.0", "Released under the MIT License": "mit",
    }
    found = {r.doc_id: r for r in queries.op10_licenses(spark, sf_dir).collect()}
    for doc_id, text in texts:
        stated = {family for notice, family in told.items() if notice in text}
        row = found[doc_id]
        if stated:
            assert row.license in stated
        for x in row.found:
            assert any(notice.split()[-1] in text[x.start : x.end] for notice in told) or "rights" in text[x.start : x.end]


def test_pipeline_equals_plain_stages(spark, sf_dir, texts):
    """Each stage's decisions against plain Python, on what the stage before kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.write_shared(stage(spark, docs, sf_dir), "test-stage")
        results.append(docs)
    kept, single, cut, clean, packed = results
    for df in results[:-1]:
        assert df.columns == names
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    kept, single, cut, clean = map(rows, (kept, single, cut, clean))
    judged = {r.doc_id for r in queries.op8_quality(spark, sf_dir).filter("kept").collect()}
    assert set(kept) == judged
    firsts = {doc_id for doc_id, (_, _, first) in brute.near_duplicates(sorted(kept.items())).items() if first}
    assert set(single) == firsts and all(single[x] == kept[x] for x in single)
    assert set(cut) == set(single) and all(len(cut[x]) <= len(single[x]) for x in cut)
    # The contamination rule, in SQL over the texts that the stage got.
    with duckdb.connect() as connection:
        connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        connection.executemany("INSERT INTO documents VALUES (?, ?)", list(cut.items()))
        connection.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
        told = connection.execute(f"SELECT doc_id, contaminated FROM ({oracles.DECONTAMINATION})").fetchall()
    assert clean == {doc_id: cut[doc_id] for doc_id, bad in told if not bad}
    assert {r.doc_id for r in packed.collect()} == set(clean)


def test_package_is_left_out_where_it_is_missing(tmp_path):
    import shutil
    import subprocess

    root = Path(__file__).parents[2]
    ignored = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(root / "tillstar", tmp_path / "tillstar", ignore=ignored)
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'whole_run' in e.queries() and 'pipeline' not in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
