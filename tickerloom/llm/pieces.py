"""Texts cut at safe boundaries and encoded with a memory of pieces.

A byte-level tokenizer splits a text by ``PATTERN`` before it merges. No match
of the pattern crosses a place before a space that stands alone between two
characters that are not white space, so the text may be cut there and the parts
encoded separately. Most parts are words seen before.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterable, Iterator

import public_tokenizers

SAFE = re.compile(r"(?<=\S)(?= \S)")
# A space beside other white space; str.split(" ") would cut at unsafe places.
UNSAFE = re.compile(r" \s|\s ")
SEGMENT_CHARS = 1 << 18
MEMO_ENTRIES = 600_000
MEMO_CHARS = 48


def segments(text: str, limit: int = SEGMENT_CHARS) -> Iterator[str]:
    """The text in parts of about ``limit`` characters, cut at safe places only."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE.search(text, start + limit)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    if start == 0 or start < len(text):
        yield text[start:]


def keys(text: str) -> list:
    """A text's safe pieces as keys: the first as a 1-tuple, the others without their space."""
    if UNSAFE.search(text) or text[:1] == " " or text[-1:] == " ":
        first, *rest = SAFE.split(text)
        return [(first,), *[piece[1:] for piece in rest]]
    words = text.split(" ")
    words[0] = (words[0],)
    return words


def piece(key) -> str:
    return key[0] if isinstance(key, tuple) else " " + key


class PieceMemo:
    """Encoded pieces, remembered up to ``MEMO_ENTRIES``; then forgotten all at once."""

    def __init__(self, encode_many: Callable[[list[str]], list]):
        self.encode_many = encode_many
        self.known: dict = {}
        self.long: list = []

    def learn(self, wanted: list) -> None:
        """Make the values of all ``wanted`` keys known, in batches balanced by size."""
        if len(self.known) > MEMO_ENTRIES:
            self.known.clear()
        new = set(wanted).difference(self.known)
        self.long = [key for key in new if len(piece(key)) > MEMO_CHARS]
        for batch in grouped(new, lambda key: len(piece(key)) + 16):
            self.known.update(zip(batch, self.encode_many([piece(key) for key in batch])))

    def apply(self, texts: list[str], join: Callable, join_parts: Callable) -> list:
        """For each text ``join`` of its pieces' values, in batches of about equal size.

        A long text goes through in several parts, whose results are joined by
        ``join_parts``; so memory is bounded by a part, not by a text.
        """
        results: list[list] = [[] for _ in texts]
        parts = ((i, part) for i, text in enumerate(texts) for part in segments(text))
        for batch in grouped(parts, lambda item: len(item[1])):
            keyed = [(i, keys(part)) for i, part in batch]
            self.learn([key for _, some in keyed for key in some])
            get = self.known.__getitem__
            for i, some in keyed:
                results[i].append(join(map(get, some)))
            for key in self.long:
                self.known.pop(key, None)
        return [some[0] if len(some) == 1 else join_parts(some) for some in results]


def grouped(items: Iterable, size: Callable, limit: int = 1 << 20) -> Iterator[list]:
    """Items in lists of about equal total size; a larger item is a list alone."""
    batch, total = [], 0
    for item in items:
        if batch and total + size(item) > limit:
            yield batch
            batch, total = [], 0
        batch.append(item)
        total += size(item)
    if batch:
        yield batch


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def load_tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def vocabulary(name: str) -> str:
    """The place of a vocabulary file: a path as it is, or a name of the public set."""
    return name if os.path.isabs(name) else public_tokenizers.path(name)
