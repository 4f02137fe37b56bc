"""Token ids of whole texts, with the ids of words kept between texts."""

from __future__ import annotations

import os
import re
import struct
import sys
from collections.abc import Callable
from types import ModuleType

KEPT_PIECES = 600_000  # newest stretches of text whose ids a worker process keeps, besides as many older ones; some 170 MB
_STORE = "_tillstar_llm_piece_ids"

# Stretches of ASCII and Latin-1 letters: their words are found here, as the
# tokenizers' own patterns find them, and only the merges are left to the tokenizer.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(r" ?[!-~À-ÖØ-öø-ÿ]+\Z")
WORD_END_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^0-9{LETTERS}]+")
BYTE_LEVEL_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^ 0-9{LETTERS}]+")

# White space other than single spaces and line ends.
ODD_SPACE = re.compile(r"[^\S \n]|\0")
ODD_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\0"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others, in order, for the characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTES = byte_characters()


# The two bytes of each id.
IDS = [i.to_bytes(2, "little") for i in range(1 << 16)]


class Pieces(dict):
    """Ids by stretch of text or word, as little-endian 16-bit integers; a missing one is encoded.

    When full, it becomes the older generation, from which what is met again
    comes back, so that frequent stretches stay however many rare ones pass.
    ``encode`` returns the ids and whether they are to be kept.
    """

    def __init__(self, encode: Callable[[str], tuple[bytes, bool]]):
        self.encode, self.older = encode, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids, keep = self.encode(piece)
            if not keep:
                return ids
        if len(self) >= KEPT_PIECES:
            self.older = self.copy()
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """A tokenizer for one process; its store outlives the task."""

    words: re.Pattern
    lower = False

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self.encode_piece)
        self.tokenized = 0  # words so far that were not kept

    def holds_added(self, text: str) -> bool:
        """Whether an added token's string stands in the text: the tokenizer cuts there first."""
        return any(map(text.__contains__, self.added))

    def encode_whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}H", *ids)

    def encode_piece(self, piece: str) -> tuple[bytes, bool]:
        ascii_only = piece.isascii()
        letters = piece[1:] if piece[:1] == " " else piece
        if ascii_only and letters.isalpha():
            words = [piece]
        elif ascii_only and letters[:-1].isalpha() and "!" <= letters[-1] <= "~":
            words = [piece[:-1], piece[-1]]  # a word and a mark or digit
        elif not PLAIN.match(piece):
            return self.encode_whole(piece), True
        else:
            words = [piece] if letters.isalpha() else self.words.findall(piece)
        if self.lower:
            words = [word.lower() for word in words]
        if len(words) > 1:  # each is kept apart; the stretch only if its words had been met before
            before = self.tokenized
            return b"".join(map(self.pieces.__getitem__, words)), self.tokenized == before
        (word,) = words
        self.tokenized += 1
        if ascii_only:
            standing = word.replace(" ", BYTES[32])
        else:
            standing = "".join(map(BYTES.__getitem__, word.encode()))
        return b"".join([IDS[token.id] for token in self.model.tokenize(standing)]), True


class WordEncoder(Encoder):
    """For the tokenizer that lower-cases and drops white space: every stretch between spaces stands alone."""

    words, lower = WORD_END_WORDS, True

    def __call__(self, text: str) -> bytes:
        if self.holds_added(text):
            return self.encode_whole(text)
        pieces = text.replace("\n", " ").split(" ")
        return b"".join(map(self.pieces.__getitem__, pieces))


class ByteEncoder(Encoder):
    """For the byte-level tokenizer that joins a single space to the word behind it.

    Such a text can be cut before every space and around every line end, if all
    its white space is single and inside; other texts are encoded as they are.
    """

    words = BYTE_LEVEL_WORDS

    def __call__(self, text: str) -> bytes:
        if loose(text) or self.holds_added(text):
            return self.encode_whole(text)
        pieces = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return b"".join(map(self.pieces.__getitem__, pieces))


def loose(text: str) -> bool:
    """Whether some white space could share ids with what stands beside it."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[:1] in " \n" or text[-1:] in " \n":
        return True
    return any(map(text.__contains__, ODD_ASCII)) if text.isascii() else bool(ODD_SPACE.search(text))


def encoder(kind: type[Encoder], path: str) -> Encoder:
    """This process's encoder of a kind and vocabulary."""
    store, name = sys.modules.setdefault(_STORE, ModuleType(_STORE)), f"{kind.__name__} {path}"
    if name not in store.__dict__:
        store.__dict__[name] = kind(path)
    return store.__dict__[name]
