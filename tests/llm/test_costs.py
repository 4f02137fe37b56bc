"""Work per word stays out of Python's own loops, with the results of the plain forms."""

from __future__ import annotations

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillstar.llm import substrings
from tillstar.llm.encode import ByteEncoder, WordEncoder


def events(work) -> int:
    """How many functions ``work`` calls from Python code."""
    seen = 0

    def count(frame, event, arg):
        nonlocal seen
        seen += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        work()
    finally:
        sys.setprofile(None)
    return seen


def sentences(words: int, seed: int) -> str:
    draw = random.Random(seed)
    made = [draw.choice(["River", "stone", "blue", "éa", "on", "1.5", "x\x1cy", "İ"]) + draw.choice(["", "", " ", ".", "\n"]) for _ in range(words)]
    return " ".join(made)


def plain_runs(text: str) -> list[tuple[int, int, bytes]]:
    """The runs of a text, one word and one sentence at a time."""
    words, at = text.lower().split(), substrings.word_starts(text).tolist()
    starts = substrings.sentence_starts(text)
    first_word = [sum(x < start for x in at) for start in starts]
    full = [i for i in range(len(starts) - 1) if first_word[i + 1] > first_word[i]]
    digest = lambda some, mark="": hashlib.blake2b((mark + " ".join(some)).encode(), digest_size=8).digest()
    out = []
    for k, i in enumerate(full):
        for last in full[k + substrings.RUN - 1 :]:
            low, high = first_word[i], first_word[last + 1]
            if high - low >= substrings.LEAST_WORDS:
                out.append((starts[i], starts[last + 1], digest(words[low:high])))
                break
    places = substrings.gram_places(substrings.checksums([word.encode() for word in words]))
    for k in places:
        out.append((at[k], [*at, len(text)][k + substrings.GRAM], digest(words[k : k + substrings.GRAM], "\0")))
    return out


def test_runs_equal_those_of_the_plain_form():
    for seed, words in enumerate([1, 15, 16, 17, 49, 50, 51, 90, 400]):
        text = sentences(words, seed)
        firsts, ends, runs = substrings.runs_of(text)
        assert list(zip(firsts.tolist(), ends.tolist(), [x.tobytes() for x in runs])) == plain_runs(text)


def test_gram_places_are_the_last_least_ones_of_every_window():
    draw = np.random.default_rng(3)
    for kinds in (1, 2, 1 << 32):  # few kinds of words: many equal hashes
        sums = draw.integers(0, kinds, 300).astype(np.uint32)
        own = (sums.astype(np.uint64) + np.uint64(1)) * np.uint64(substrings.FACTOR)
        own ^= own >> np.uint64(29)
        values = []
        for k in range(len(own) - substrings.GRAM + 1):
            value = 0
            for x in own[k : k + substrings.GRAM].tolist():
                value = (value * substrings.FACTOR + x) % (1 << 64)
            value ^= value >> 32
            value = value * 0xBF58476D1CE4E5B9 % (1 << 64)
            values.append(value ^ (value >> 29))
        width = substrings.GRAM_WINDOW
        least = {min(range(k, k + width), key=lambda i: (values[i], -i)) for k in range(len(values) - width + 1)}
        assert substrings.gram_places(sums) == sorted(least)


def test_runs_take_few_calls_a_word():
    text = sentences(8000, 1)
    assert events(lambda: substrings.runs_of(text)) < 2.5 * 8000


@pytest.mark.parametrize("kind, name", [(WordEncoder, "word_bpe_49k.json"), (ByteEncoder, "byte_bpe_50k.json")])
def test_stretches_of_words_not_met_before_take_no_room(kind, name):
    encode, space = kind(public_tokenizers.path(name)), "" if kind is WordEncoder else " "
    first = encode("on zorbling, flammet.")
    assert set(encode.pieces) == {"on", f"{space}zorbling", f"{space}flammet", ",", "."}
    assert encode("on zorbling, flammet.") == first  # met again: kept as they stand
    assert {f"{space}zorbling,", f"{space}flammet."} <= set(encode.pieces)


@pytest.mark.parametrize("kind, name", [(WordEncoder, "word_bpe_49k.json"), (ByteEncoder, "byte_bpe_50k.json")])
def test_ids_of_odd_stretches_are_those_of_the_plain_call(kind, name, monkeypatch):
    path = public_tokenizers.path(name)
    encode, whole = kind(path), Tokenizer.from_file(path)
    monkeypatch.setattr("tillstar.llm.encode.KEPT_PIECES", 50)  # generations change all the time
    texts = ["\x01<|ENDOFTEXT|> A", "<|ENDOFTEXT|>", "a\x01", "A, b. C5 5c é, É. ñ' it's we'll x'", "e\u0301. \u0130, ß."]
    draw = random.Random(5)
    texts += ["".join(draw.choice("aAbéÉß ,.'s12\n-\u0130\u0301\x01 ") for _ in range(draw.randint(0, 40))) for _ in range(2000)]
    for text in texts * 2:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u2")
        assert encode(text) == ids.tobytes(), text
