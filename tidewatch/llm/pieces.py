"""SentencePiece encoding and decoding through tables of distinct marked words."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare

MARK = "▁"
#: A run of marks with what follows it up to the next mark. No piece holds a mark after another character.
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
#: Distinct chunks that a task keeps between texts; the table starts anew beyond it.
TABLE_SIZE = 1 << 17
_LONG = 256


def check_model(model: bytes) -> None:
    """Refuse a model under which cutting a text before its blanks could change the pieces."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    rules = proto.normalizer_spec
    crossing = any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
    if MARK not in {p.piece for p in proto.pieces} or crossing or not plain or proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == 4 for p in proto.pieces):
        raise ValueError("the model's pieces can cross blanks, or it rewrites the text")


class ChunkTable:
    """Ids and decoded text of marked words, each segmented once. A marked word is known by what follows its first mark."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.known: dict[str, bytes] = {}
        #: Words that are not decoded to themselves.
        self.changed: dict[str, str] = {}
        self.begin, self.end = (self._packed([i]) for i in (self.library.bos_id(), self.library.eos_id()))
        self.anchor = self.library.piece_to_id("a")
        self.mark = self.library.piece_to_id(MARK)
        kinds = (self.library.is_unknown, self.library.is_control, self.library.is_unused, self.library.is_byte)
        self.unlike_text = frozenset(i for i in range(self.library.get_piece_size()) if any(kind(i) for kind in kinds))

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _segment(self, word: str) -> bytes:
        # The library puts one mark in front itself, but not before nothing.
        text = word.replace(MARK, " ")
        ids = self.library.encode(text) if word else [self.mark]
        # Pieces that are parts of the text put together are the text.
        if not self.unlike_text.isdisjoint(ids) and (decoded := self.library.decode([self.anchor, *ids])[2:]) != text:
            self.changed[word] = decoded
        self.known[word] = packed = self._packed(ids)
        return packed

    def __call__(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian 32-bit numbers with begin and end, text decoded from them)."""
        if not text:
            return self.begin + self.end, ""
        if len(self.known) >= TABLE_SIZE:
            self.known.clear()
            self.changed.clear()
        words = text.split(" ")
        if "" in words or MARK in text:
            words = [chunk[1:] for chunk in _CHUNK.findall(MARK + text.replace(" ", MARK))]
        known = self.known
        parts = list(map(known.get, words))
        new = [w for w, part in zip(words, parts) if part is None] if None in parts else []
        if new:
            parts = [part or known.get(w) or self._segment(w) for w, part in zip(words, parts)]
        # Decoding drops the mark that encoding put in front.
        if self.changed.keys().isdisjoint(words):
            decoded = text.replace(MARK, " ")
        else:
            decoded = " ".join([self.changed.get(w) if w in self.changed else w.replace(MARK, " ") for w in words])
        for w in new:
            if len(w) >= _LONG:
                known.pop(w, None)
                self.changed.pop(w, None)
        return b"".join([self.begin, *parts, self.end]), decoded


def encode_pieces(documents: DataFrame, model: bytes, text: str = "text") -> Column:
    """struct(ids binary, decoded string) of every text; ids are packed little-endian 32-bit numbers.

    The ids equal the library's for the whole text with begin and end ids, the
    decoded text its decode() of them. Null counts as empty; repeated rows have
    equal results; a text is encoded whole, and a task holds the words of one
    text. Each task keeps a bounded table of the distinct marked words it met
    and segments a word once while it is there.
    """
    check_model(model)
    prepare(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("ids binary, decoded string")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = ChunkTable(held.value)
        for batch in texts:
            pairs = [table(t or "") for t in batch]
            yield pd.DataFrame({"ids": [p[0] for p in pairs], "decoded": [p[1] for p in pairs]})

    return encode(F.col(text))


def unpack_ids(ids: Column) -> Column:
    """Packed ids as an array of ints."""

    @F.pandas_udf("array<int>")
    def unpack(packed: pd.Series) -> pd.Series:
        return packed.map(lambda b: None if b is None else np.frombuffer(b, "<u4").astype(np.int32))

    return unpack(ids)
