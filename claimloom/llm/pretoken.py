"""Cutting texts into chunks that a byte-level tokenizer encodes on their own.

The split pattern takes at most one leading space into a token and never
crosses from a visible character to white space. So in a text whose white
space is single spaces and single line ends, with none at either end, every
such space and line end starts a chunk that can be encoded by itself. Any other
text is cut by the pattern itself. Chunks repeat a lot, so their ids are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import regex
from public_tokenizers import PATTERN

PIECES = regex.compile(PATTERN)
#: Characters of a text that are cut at once.
SEGMENT_CHARS = 1 << 20
#: Chunks, and characters of them, of a generation that a worker remembers.
REMEMBERED, REMEMBERED_CHARS = 250_000, 8_000_000
#: A longer chunk is encoded by itself.
LONG = 4096
MARK = "\0"


def segments(text: str) -> Iterator[str]:
    """The text in parts of about ``SEGMENT_CHARS``, cut before a single space between visible characters."""
    start, size = 0, len(text)
    while size - start > 2 * SEGMENT_CHARS:
        cut = text.find(" ", start + SEGMENT_CHARS)
        while 0 < cut < size - 1 and (text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if not 0 < cut < size - 1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def chunks(text: str) -> list[str]:
    """Chunks of a segment, in order; joined they are the segment."""
    if MARK not in text and " ".join(text.split()) == text.replace("\n", " "):
        marked = text.replace(" ", "\0 ")
        if "\n" in marked:
            marked = marked.replace("\n", "\0\n\0")
        return marked.split(MARK)
    return PIECES.findall(text)


class Remembering(dict):
    """Ids (little-endian 32-bit) of chunks, in two generations.

    Once the young generation is full the old one is dropped and takes its
    place; a chunk that is used moves back to the young one. Unknown chunks are
    encoded together, ahead of their use: those that start with a space form a
    text of their own, others are set apart by line ends, which are a piece of
    their own between visible characters.
    """

    def __init__(self, encode_run: Callable[[list[str]], list[bytes]], encode_alone: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.old: dict[str, bytes] = {}
        self.encode_run, self.encode_alone, self.chars = encode_run, encode_alone, 0

    def __missing__(self, chunk: str) -> bytes:
        found = self[chunk] = self.old[chunk]
        return found

    def ids(self, text: str) -> bytes:
        out = []
        for segment in segments(text):
            parts = chunks(segment)
            self.learn(set(parts))
            out.append(b"".join(map(self.__getitem__, parts)))
            self.forget()
        return b"".join(out)

    def learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self and p not in self.old]
        self.chars += sum(map(len, new))
        led = [p for p in new if p[0] == " " and 1 < len(p) <= LONG and not p[1].isspace()]
        bare = [p for p in new if len(p) <= LONG and not p[0].isspace()]
        if led:
            self.update(zip(led, self.encode_run(led)))
        if bare:
            apart = ["\n"] * (2 * len(bare))
            apart[::2] = bare
            self.update(zip(bare, self.encode_run(apart)[::2]))
        if len(led) + len(bare) < len(new):
            # blanks, long chunks, and separators U+001C..U+001F, which isspace() takes for blanks and the pattern does not
            self.update([(p, self.encode_alone(p)) for p in new if p not in self])

    def forget(self) -> None:
        if len(self) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.old = dict(self)
            self.clear()
            self[""], self.chars = b"", 0

    def all_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; chunks that are new to any of them are encoded in one go."""
        cut = [chunks(t) if len(t) <= SEGMENT_CHARS else None for t in texts]
        self.learn(set().union(*(c for c in cut if c is not None)))
        known = [None if c is None else b"".join(map(self.__getitem__, c)) for c in cut]
        self.forget()
        return [self.ids(t) if k is None else k for t, k in zip(texts, known)]


def cut_ids(ids: np.ndarray, token_ends: np.ndarray, part_ends: np.ndarray) -> list[bytes]:
    """The bytes of the ids of each part, given where tokens and parts end in the text they share."""
    last = np.searchsorted(token_ends, part_ends, side="right") - 1
    if not np.array_equal(token_ends[last], part_ends):
        raise ValueError("a token crosses the end of a chunk")
    raw, ends = ids.astype("<u4").tobytes(), (4 * (last + 1)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]
