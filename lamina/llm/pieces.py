"""Shared parts of the byte-pair piece model: its tables and the cut into chunks.

The model file is that of the sentencepiece library (BPE, byte fallback, identity
normalizer, dummy prefix). No piece holds the space mark after another character, so
a text is encoded chunk by chunk, a chunk being a run of marks with what follows it.
"""

from __future__ import annotations

import functools
import re

import numpy as np

from lamina.llm import flat

MARK = "▁"
DEFAULT_MODEL = "piece_bpe_32k.model"
NONE = np.int32(np.iinfo(np.int32).max)


def default_path(name: str = DEFAULT_MODEL) -> str:
    """Where the public vocabulary files lie; looked up on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """Tables of a piece model.

    ``ids``: text of a normal piece to its id; ``rank``: by id, 0 for the pair to merge
    first (equal scores share a rank); ``byte_ids``: by byte.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)])
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.special = special
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.unknown_id = sp.unk_id()
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.byte_of = {int(i): b for b, i in enumerate(self.byte_ids)}
        scores = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int32)
        self.longest = max(map(len, self.ids))
        if any(MARK in p.lstrip(MARK) or (p[:2] == MARK * 2 and p.strip(MARK)) for p in self.ids):
            raise ValueError("a piece holds the space mark after another character: texts can't be cut into chunks")
        self._pairs()

    def _pairs(self) -> None:
        """A hash table of all pairs of pieces that join to a piece, and of the
        character pairs found inside pieces."""
        keys, joined, inner = [], [], set()
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a * len(self.pieces) + b)
                    joined.append(i)
                inner.add(ord(p[k - 1]) << 21 | ord(p[k]))
        self.inner = np.array(sorted(inner), np.int64)
        keys, joined = np.array(keys, np.int64), np.array(joined, np.int32)
        self.bits = max(12, int(np.ceil(np.log2(8 * len(keys)))))
        self.slot_key = np.full(1 << self.bits, -1, np.int64)
        self.slot_id = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.slot_key[slot] < 0
            put, first = np.unique(slot[free], return_index=True)
            who = left[free][first]
            self.slot_key[put], self.slot_id[put] = keys[who], joined[who]
            done = np.isin(left, who)
            left, slot = left[~done], slot[~done]
            slot = np.where(self.slot_key[slot] >= 0, (slot + 1) & ((1 << self.bits) - 1), slot)
        chars = [(ord(p), i) for p, i in self.ids.items() if len(p) == 1]
        self.char_id = np.full(0x110000, -1, np.int32)
        self.char_id[[c for c, _ in chars]] = [i for _, i in chars]
        text = [b"" if s and i not in self.byte_of else bytes([self.byte_of[i]]) if s else p.replace(MARK, " ").encode() for i, (p, s) in enumerate(zip(self.pieces, self.special, strict=True))]
        self.piece_text = text
        self.text_len = np.array([len(t) for t in text])
        self.decimal = [b"%d," % i for i in range(len(text))]
        self.decimal_len = np.array([len(t) for t in self.decimal])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of the piece that each pair joins to, or -1. Negative ids never join."""
        out = np.full(len(a), -1, np.int32)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        keys = a[todo].astype(np.int64) * len(self.pieces) + b[todo]
        slot = self._slot(keys)
        while len(todo):
            found = self.slot_key[slot]
            hit = found == keys
            out[todo[hit]] = self.slot_id[slot[hit]]
            on = ~hit & (found >= 0)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out


@functools.lru_cache(2)
def model(path: str) -> PieceModel:
    return PieceModel(path)


_CUT = re.compile("(?<! ) ")


def chunks(text: str) -> list[str]:
    """The chunks of a text with its dummy prefix, each without the space (or mark,
    which is written as a space is) that it begins with."""
    if not text:
        return []
    text = " " + text.replace(MARK, " ")
    return (_CUT.split(text) if "  " in text else text.split(" "))[1:]
