"""A SentencePiece vocabulary as numpy tables, and texts cut where no piece reaches across.

Texts are handled with a blank before them, as the model asks for, and blanks stand
for the piece mark U+2581, which the model does not tell apart from a blank.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from ridelake.llm.common import codepoints, span_hashes

MARK = "▁"


class Table:
    """A fixed map of numbers (0 or more) to numbers, looked up by arrays: -1 for unknown keys."""

    def __init__(self, pairs: dict[int, int]):
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        self.shift = np.uint64(64 - max(10, int(4 * len(pairs)).bit_length()))
        slots = 1 << int(64 - self.shift)
        self.keys, self.values = np.full(slots + 64, -2, np.int64), np.full(slots + 64, -1, np.int32)
        self.probes = 1
        for key, slot in zip(keys.tolist(), self._slot(keys).tolist(), strict=True):
            step = 0
            while self.keys[slot + step] != -2:
                step += 1
            self.keys[slot + step], self.values[slot + step] = key, pairs[key]
            self.probes = max(self.probes, step + 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __getitem__(self, key: np.ndarray) -> np.ndarray:
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.values[slot], np.int32(-1))
        left = np.flatnonzero((found != key) & (found != -2))
        for step in range(1, self.probes):
            if not len(left):
                break
            found = self.keys[slot[left] + step]
            hit = found == key[left]
            out[left[hit]] = self.values[slot[left[hit]] + step]
            left = left[~hit & (found != -2)]
        return out


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        ids = range(self.size)
        self.bytes_at = np.zeros(256, np.int64)
        self.text: dict[int, str] = {}
        for i in ids:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_at[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = piece.replace(MARK, " ")
        self.id_of = {p: i for i, p in self.text.items()}
        #: Smaller is merged earlier; pieces of one score share a rank.
        scores = np.array([model.get_score(i) for i in ids])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        single = sorted((ord(p), i) for p, i in self.id_of.items() if len(p) == 1)
        self.points = np.array([p for p, _ in single], np.int32)
        self.point_ids = np.array([i for _, i in single], np.int32)
        self.ascii = np.full(128, -1, np.int32)
        self.ascii[self.points[self.points < 128]] = self.point_ids[self.points < 128]
        pairs = [
            (self.id_of[p[:k]] * self.size + self.id_of[p[k:]], i)
            for p, i in self.id_of.items()
            for k in range(1, len(p))
            if p[:k] in self.id_of and p[k:] in self.id_of
        ]
        self.pair_dict = dict(pairs)
        self.pairs = Table(self.pair_dict)
        inner = {c for p in self.id_of if len(p) > 1 for c in p}
        #: ASCII bytes that no piece of two or more characters holds.
        self.alone = np.array([b < 128 and chr(b) not in inner for b in range(256)])
        assert all(" " not in p.lstrip(" ") for p in self.id_of), "a piece holds an inner blank"

    def symbols(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the characters (-1: not in the vocabulary), where each begins, its bytes."""
        point, at = codepoints(data)
        ids = self.ascii[np.minimum(point, 127)]
        wide = np.flatnonzero(point > 127)
        place = np.minimum(np.searchsorted(self.points, point[wide]), len(self.points) - 1)
        ids[wide] = np.where(self.points[place] == point[wide], self.point_ids[place], -1)
        return ids, at, np.diff(np.append(at, len(data)))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that pairs make, -1 where they make none."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -1
        return self.pairs[key]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def with_blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that are not empty, each with a blank before it, and the new offsets."""
    some = offsets[1:] > offsets[:-1]
    before = np.concatenate(([0], np.cumsum(some)))
    out = np.full(len(data) + int(before[-1]), 0x20, np.uint8)
    row = np.repeat(np.arange(len(some)), np.diff(offsets))
    out[np.arange(len(data)) + before[row + 1]] = data
    return out, offsets + before


def spans(words: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start: at the first blank of a run, around bytes that stand alone."""
    blank = data == 0x20
    begin = np.zeros(len(data), bool)
    begin[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    begin[1:] |= blank[1:] & ~blank[:-1]
    alone = words.alone[data]
    begin |= alone
    begin[1:] |= alone[:-1]
    return np.flatnonzero(begin)


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of chosen spans put together, and their offsets."""
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths)
    return data[at], offsets


class Distinct:
    """The pre-tokens of a chunk of texts and the distinct ones among them.

    row_offsets: each text's pre-tokens; kind: each pre-token's place among the
    distinct ones; data, offsets: bytes of the distinct ones.
    """

    def __init__(self, words: Vocabulary, data: np.ndarray, offsets: np.ndarray):
        self.text, self.text_offsets = data, offsets = with_blank(data, offsets)
        starts = spans(words, data, offsets)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        hashes = span_hashes(data, starts, ends)
        self.hashes, first, self.kind = np.unique(hashes, return_index=True, return_inverse=True)
        self.row_offsets = np.searchsorted(starts, offsets)
        self.data, self.offsets = gathered(data, starts[first], (ends - starts)[first])
