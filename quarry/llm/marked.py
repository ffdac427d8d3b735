"""Marked words: the chunks of a text that a SentencePiece model segments independently.

The model writes a space as a marker and puts one before the text. If no piece has a marker
after another character, no merge reaches across the point before a run of markers, so each
run of markers with the word behind it is segmented on its own. :func:`check_model` proves the
conditions on the vocabulary before anything relies on them.
"""

from __future__ import annotations

import re

import sentencepiece

from quarry.llm.common import Remembered

MARK = "▁"
CHUNK = re.compile(" +[^ ]*")
#: Distinct chunks that a worker remembers, in each of two generations.
CACHE_ENTRIES = 250_000
#: Longer chunks are segmented but not kept.
CACHE_CHARS = 64


def load(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(sp: sentencepiece.SentencePieceProcessor) -> None:
    """Raise unless chunks are independent: no piece with an inner marker, markers kept as they
    are, one put before the text, and a lone marker is one piece."""
    for i in range(sp.get_piece_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} crosses a white-space marker")
    one = sp.piece_to_id(MARK)
    if one == sp.unk_id() or sp.encode("") != [] or sp.encode("a ")[-1] != one \
            or sp.encode("  a") != sp.encode(MARK + MARK + "a"):
        raise ValueError("this model does not keep white space as markers")


def chunks(text: str) -> list[str]:
    """The text's chunks as keys: a word behind one marker is the bare word; any other chunk is
    written with its leading spaces."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c if c[1:2] in ("", " ") else c[1:] for c in CHUNK.findall(" " + text)]


class ChunkTable:
    """Segments every distinct chunk once and keeps what ``value(ids)`` makes of it; ``known`` are
    values that need no segmentation."""

    def __init__(self, path: str, value, known: dict | None = None):
        self.sp, self.value, self.known = load(path), value, known or {}
        self.one = self.sp.piece_to_id(MARK)
        self.table = Remembered(self._segment, CACHE_ENTRIES)

    def values(self, keys: list[list[str]]):
        """A function from chunk to value that knows all of ``keys``."""
        asked = set().union(*keys).difference(self.known)
        long = [k for k in asked if len(k) > CACHE_CHARS]
        table = self.table.know(asked.difference(long))
        if long or self.known:
            table = {**dict(zip(long, self._segment(long))), **{k: table[k] for k in asked.difference(long)}, **self.known}
        return table.__getitem__

    def _segment(self, keys: list[str]):
        texts = [k[1:] if k[0] == " " else k for k in keys]
        coded = self.sp.encode(texts, num_threads=1) if texts else []
        return [self.value([self.one] if k == " " else ids) for k, ids in zip(keys, coded)]
