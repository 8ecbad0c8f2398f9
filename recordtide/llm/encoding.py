"""Token ids and token counts of whole texts by a tokenizer file, with the pieces between spaces remembered.

A space between two characters that are not white space always begins a new piece for a byte-level pre-tokenizer (its
pattern takes one such space at the head of a piece, and nowhere else), and so a text may be cut before it and its parts
encoded alone. Parts recur, so each worker encodes a part once and looks it up from then on. Special strings hold no space, so
no cut divides one.

``Encoder`` divides texts by the pattern of the pre-tokenizer at once, as there are fewer pieces than parts (a word with and without
its comma, two words around a line break), and asks the tokenizer's model for unknown pieces only. That is done for files with
this very pre-tokenizer and for texts of Latin letters, whose classes are fixed; other texts go by parts, of which those of
Latin letters are divided likewise, and all else goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

from recordtide.llm.words import held

#: Parts that a Python worker remembers; those it meets later are encoded anew each time. Some 60 MB.
REMEMBERED = 300_000
#: Characters beyond which a part is not worth remembering.
LONG = 64

#: White space other than the space itself.
_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) != " "]
_AT_SPACE = re.compile(r"(?<=\S) (?=\S)")


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _uneven(text: str) -> bool:
    """Whether a space meets other white space or an end of the text, told by plain searches."""
    if text[:1] == " " or text[-1:] == " " or "  " in text or "\0" in text:
        return True
    return any(c in text and (c + " " in text or " " + c in text) for c in _OTHER_SPACE)


def cut_at_spaces(text: str) -> list[str]:
    """Parts that begin with the space before them, cut only between characters that are not white space."""
    if not _uneven(text):  # each space stands alone
        return text.replace(" ", "\0 ").split("\0")
    cuts = [m.start() for m in _AT_SPACE.finditer(text)]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]


class Parts(dict):
    """Part of a text to what it encodes to, worked out for many unknown parts in one call."""

    def __init__(self, path: str, value):
        self.tokenizer, self.value = load_tokenizer(path), value

    def look_up(self, texts: list[list[str]]) -> list[list]:
        found = [list(map(self.get, parts)) for parts in texts]
        gaps = [(values, parts) for values, parts in zip(found, texts) if None in values]
        unknown = list({part for values, parts in gaps for part, value in zip(parts, values) if value is None})
        if unknown:
            encoded = self.tokenizer.encode_batch_fast(unknown, add_special_tokens=False)
            fresh = {part: self.value(e) for part, e in zip(unknown, encoded)}
            for values, parts in gaps:
                for i, value in enumerate(values):
                    if value is None:
                        values[i] = fresh[parts[i]]
            if len(self) < REMEMBERED:
                self.update((part, v) for part, v in fresh.items() if len(part) <= LONG)
        return found


def _counted(path: str) -> Parts:
    return Parts(path, len)


def counted_parts(path: str) -> Parts:
    """Token counts of parts, kept by this Python worker beyond a task."""
    return held(_counted, path)


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which outlives a task."""
    return held(Encoder, path)


_LETTER, _DIGIT = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LATIN = re.compile("[\\t\\n\\r -~\u00a1-\u024f]*")
#: The pattern of the byte-level pre-tokenizer, for the characters of ``_LATIN``.
_PIECE = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+")
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def _byte_characters() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for a byte: visible ones stay, the others follow from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (byte for byte in range(256) if byte not in visible)
    return {byte: chr(256 + k) for k, byte in enumerate(hidden)}


def _as_bytes(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


class _Pieces(dict):
    """Piece of a part to its ids as bytes, by the tokenizer's model alone."""

    def __init__(self, model):
        self.model, self.characters = model, _byte_characters()
        self.space = self.characters[0x20]

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece[-1] > " ":  # nothing hidden but a space at its head
            written = piece.replace(" ", self.space)
        else:
            written = piece.encode().decode("latin-1").translate(self.characters)
        value = _as_bytes([token.id for token in self.model.tokenize(written)])
        if len(self) < 2 * REMEMBERED and len(piece) <= LONG:  # parts of Latin letters take no room beside them
            self[piece] = value
        return value


class _PartIds(dict):
    """Part of a text to its ids as bytes."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        said = json.loads(self.tokenizer.to_str())
        before, model = said["pre_tokenizer"] or {}, said["model"]
        plain = not said["normalizer"] and model["type"] == "BPE" and not model["dropout"]
        self.divided = plain and _BYTE_LEVEL.items() <= before.items()
        self.special = [token["content"] for token in said["added_tokens"]]
        self.piece = _Pieces(self.tokenizer.model).__getitem__

    def by_pieces(self, text: str) -> bytes | None:
        """The ids of a text by its pieces, or None if the pattern does not hold for it."""
        if self.divided and _LATIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.piece, _PIECE.findall(text)))
        return None

    def __missing__(self, part: str) -> bytes:
        value = self.by_pieces(part)
        if value is None:
            value = _as_bytes(self.tokenizer.encode(part, add_special_tokens=False).ids)
        if len(self) < REMEMBERED and len(part) <= LONG:
            self[part] = value
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        self.parts = _PartIds(path)

    def _of(self, text: str) -> bytes:
        found = self.parts.by_pieces(text)
        return b"".join(map(self.parts.__getitem__, cut_at_spaces(text))) if found is None else found

    def ids(self, texts: list[str | None]) -> list[bytes]:
        return [self._of(text) if text else b"" for text in texts]


def grouped(rows: Iterable[tuple], text_at: int, characters: int = 500_000) -> Iterator[list[tuple]]:
    """Rows in groups of about so many characters of text."""
    group, held = [], 0
    for row in rows:
        group.append(row)
        held += len(row[text_at] or "")
        if held >= characters:
            yield group
            group, held = [], 0
    if group:
        yield group
