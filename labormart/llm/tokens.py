"""Byte-level BPE encoding with a memo of white-space separated chunks.

The vocabulary splits a text before merging, and no piece reaches across the
start of a chunk (a run of non-space characters with the one space before it).
So the ids of a text are the ids of its chunks in a row, and each chunk is
encoded once per task. Texts outside the plain form below go to the tokenizer
whole; both ways give the tokenizer's own ids.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
from tokenizers import Tokenizer

#: Chunks kept per task.
MEMO_ENTRIES = 600_000

#: Plain texts: characters whose class every Unicode version agrees on, single
#: spaces and line ends only, none next to another and none at either end.
_PLAIN = re.compile(r"[\n\x20-\x7e¡-¬®-ſ]*")


def is_plain(text: str) -> bool:
    return (
        bool(text)
        and text[0] not in " \n"
        and text[-1] not in " \n"
        and not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or "<|" in text)
        and _PLAIN.fullmatch(text) is not None
    )


class _Memo(dict):
    def __init__(self, make, prefix: str) -> None:
        super().__init__()
        self.make, self.prefix = make, prefix

    def __missing__(self, chunk: str):
        value = self.make(self.prefix + chunk)
        if len(self) < MEMO_ENTRIES:
            self[chunk] = value
        return value


class Encoder:
    """Ids, and character spans if asked for, of whole texts."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        # a run of letters, with the space before it, is one piece: the model takes it as it is,
        # written in the vocabulary's one character for each byte
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        plain = [chr(c) for c in range(0x20, 0x180) if _PLAIN.fullmatch(chr(c))]
        self.spelled = {ord(c): split(c)[0][0] for c in plain if c == " " or c.isalpha()}
        self.marks = {c: self._whole(c) for c in ".,;:!?"}
        self.spaced = _Memo(self._ids, " ")
        self.first = _Memo(self._ids, "")
        self.line_end = self._whole("\n")
        self.spaced_ends = _Memo(self._ends, " ")
        self.first_ends = _Memo(self._ends, "")

    def _ids(self, text: str) -> bytes:
        """Ids of a chunk; letters with at most one mark after them need no splitting."""
        if text[-1] in self.marks and text[:-1].strip(" ").isalpha():
            return self._letters(text[:-1]) + self.marks[text[-1]]
        return self._letters(text) if text.lstrip(" ").isalpha() else self._whole(text)

    def _letters(self, text: str) -> bytes:
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text.translate(self.spelled))]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _ends(self, text: str) -> tuple[bytes, bytes, int]:
        """Spans of a chunk's tokens; ASCII letters have one byte for each character, a space's sign two."""
        if text.isascii() and text.lstrip(" ").isalpha():
            found = [t.offsets for t in self.tokenizer.model.tokenize(text.translate(self.spelled))]
            less = text[0] == " "
            return array("i", [max(a - less, 0) for a, _ in found]).tobytes(), array("i", [b - less for _, b in found]).tobytes(), len(found)
        if text[-1] in self.marks and text[:-1].isascii() and text[:-1].lstrip(" ").isalpha():
            starts, stops, n = self._ends(text[:-1])
            return starts + array("i", [len(text) - 1]).tobytes(), stops + array("i", [len(text)]).tobytes(), n + 1
        spans = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int32).reshape(-1, 2)
        return spans[:, 0].tobytes(), spans[:, 1].tobytes(), len(spans)

    def ids(self, text: str) -> bytes:
        """The ids as packed little-endian unsigned 32-bit numbers."""
        if not is_plain(text):
            return self._whole(text)
        out: list[bytes] = []
        spaced, first = self.spaced, self.first
        for line in text.split("\n"):
            chunks = line.split(" ")
            out.append(first[chunks[0]])
            out += [spaced[c] for c in chunks[1:]]
            out.append(self.line_end)
        out.pop()
        return b"".join(out)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and one-past-last character of every token."""
        if not is_plain(text):
            spans = np.array(self.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
            return spans[:, 0], spans[:, 1]
        found: list[tuple[bytes, bytes, int]] = []
        sizes: list[int] = []
        end = self.first_ends["\n"]
        for line in text.split("\n"):
            chunks = line.split(" ")
            found.append(self.first_ends[chunks[0]])
            found += [self.spaced_ends[c] for c in chunks[1:]]
            found.append(end)
            sizes.append(len(chunks[0]))
            sizes += [len(c) + 1 for c in chunks[1:]]
            sizes.append(1)
        found.pop()
        sizes.pop()
        counts = [f[2] for f in found]
        at = np.repeat(np.cumsum([0, *sizes[:-1]]), counts)
        starts = np.frombuffer(b"".join([f[0] for f in found]), np.int32) + at
        stops = np.frombuffer(b"".join([f[1] for f in found]), np.int32) + at
        return starts, stops


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
