"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


class Groups:
    def __init__(self, count):
        self.parent = list(range(count))

    def find(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        self.parent[self.find(a)] = self.find(b)


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_duplicates(rows):
    """{doc_id: (n_shingles, component_id, kept)} for (doc_id, text) rows with different ids."""
    sets = [shingles(text) for _, text in rows]
    groups = Groups(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                groups.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        root = groups.find(i)
        least[root] = min(least.get(root, doc_id), doc_id)
    return {
        doc_id: (len(sets[i]), least[groups.find(i)], least[groups.find(i)] == doc_id) for i, (doc_id, _) in enumerate(rows)
    }


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words, seen, repeated = SPACED.findall(text), set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            repeated += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    covered = {j for found in places.values() if len(found) > 1 for i in found for j in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered)


def token_index(rows, encode):
    """{doc_id: (start, n_tokens, ids_crc32)} in ascending id order."""
    out, at = {}, 0
    for doc_id, text in sorted(rows):
        ids = np.array([*encode(text or ""), 1], "<u4")
        out[doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    return out
