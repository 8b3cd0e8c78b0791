"""SentencePiece encoding by forward filtering and backward sampling; lossless decoding.

The segmentations of a pre-token are the paths of a lattice: a node for each place
between characters, an arc for each piece of the vocabulary; a character outside the
vocabulary is one arc that stands for its byte pieces. A path has a probability in
proportion to the product of its arcs' weights, weight = (2 + rank) ** -theta by the
piece's rank in the vocabulary (a Zipf law; byte pieces weigh as the last rank).

Lattices are built once for each distinct pre-token of a chunk: arcs by walking all
start places down a trie at once, forward sums level by level. Backward sampling
steps all occurrences at once from their ends; the random number of a step depends
only on the seed, the row's key and the place in the text, so a row gets the same
segmentation on any cluster, in any order.

Blanks are the piece mark, a blank goes before each text; the character U+2581 itself
is written with byte pieces, so decoding gives back every text exactly.

Null text counts as empty: no pieces, decoded to the empty text. A null key counts as
a key of its own. Rows of one key and text get one segmentation; repeated rows are
encoded each; an empty table gives an empty result. Very long texts are encoded whole, one
at a time. Only the columns that are named are read, so that further columns, of whatever
name, do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import codepoints, mixed, pieces_of, ready
from ridelake.llm.pieces import Distinct, Table, Vocabulary, vocabulary


class Lattice:
    """The trie of a vocabulary, weights of its pieces, and what they decode to."""

    def __init__(self, words: Vocabulary, theta: float):
        self.words = words
        order = sorted(words.text, key=lambda i: (words.rank[i], i))
        place = np.full(words.size, len(order), np.float64)
        place[order] = np.arange(len(order))
        self.weight = -theta * np.log(2 + place)
        chars = sorted({c for p in words.id_of for c in p})
        self.chars = np.array([ord(c) for c in chars], np.int32)
        number = {c: k for k, c in enumerate(chars)}
        edges: dict[int, int] = {}
        ends = [-1]
        for piece, i in words.id_of.items():
            node = 0
            for c in piece:
                key = node * len(chars) + number[c]
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(-1)
                node = edges[key]
            ends[node] = i
        self.ends = np.array(ends, np.int32)
        self.edges = Table(edges)
        table = [b""] * words.size
        for i, piece in words.text.items():
            table[i] = piece.encode()
        for byte, i in enumerate(words.bytes_at):
            table[i] = bytes([byte])
        self.sizes = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(table), np.uint8)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * len(self.chars) + char
        key[char < 0] = -1
        return self.edges[key]

    def arcs(self, char: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of all pieces; limit: where the pre-token of a place ends.

        char: numbers of characters, -1 outside the vocabulary.
        """
        found = []
        start = np.arange(len(char))
        node, at = np.zeros(len(char), np.int32), start
        while len(start):
            node = self.step(node, char[at])
            at = at + 1
            live = node >= 0
            start, node, at = start[live], node[live], at[live]
            piece = self.ends[node]
            some = piece >= 0
            found.append((start[some], at[some], piece[some]))
            live = at < limit[start]
            start, node, at = start[live], node[live], at[live]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (none, none, none)


#: Bytes of texts whose lattices are held together; their arcs take some hundred times as much.
BYTES = 1 << 19


@lru_cache(maxsize=2)
def lattice(path: str, theta: float) -> Lattice:
    return Lattice(vocabulary(path), theta)


class Paths:
    """Lattices of the distinct pre-tokens of a chunk, filtered forward.

    Nodes are numbered through: pre-token k has its first node at first[k] and one
    more node than characters. The arcs are ordered by the node they end in.
    """

    def __init__(self, model: Lattice, data: np.ndarray, offsets: np.ndarray):
        point, at = codepoints(data)
        size = np.diff(np.append(at, len(data)))
        bounds = np.searchsorted(at, offsets)
        lengths = np.diff(bounds)
        place = np.minimum(np.searchsorted(model.chars, point), len(model.chars) - 1)
        char = np.where(model.chars[place] == point, place, -1)
        own = np.repeat(np.arange(len(lengths)), lengths)
        start, end, piece = model.arcs(char, bounds[1:][own])
        # A character that no piece begins with alone: its bytes.
        known = np.zeros(len(char), bool)
        known[start[end == start + 1]] = True
        odd = np.flatnonzero(~known)
        start, end = np.concatenate((start, odd)), np.concatenate((end, odd + 1))
        piece = np.concatenate((piece, np.full(len(odd), -1)))
        weight = np.where(piece >= 0, model.weight[piece], 0.0)
        weight[len(weight) - len(odd) :] = size[odd] * model.weight.min()
        self.first, self.lengths = bounds[:-1] + np.arange(len(lengths)), lengths
        shift = own[start]
        to = end + shift
        order = np.argsort(to, kind="stable")
        start, shift, to, weight = start[order], shift[order], to[order], weight[order]
        self.piece = piece[order].astype(np.int32)
        self.from_ = (start + shift).astype(np.int32)
        self.byte_at, self.byte_size = at[start].astype(np.int32), size[start].astype(np.int32)
        level = to - self.first[shift]
        longest = int(lengths.max(initial=0))
        by_level = np.argsort(level.astype(np.uint16 if longest < 1 << 16 else np.int64), kind="stable")
        total = np.full(len(char) + len(lengths), -np.inf)
        total[self.first] = 0
        value = np.empty(len(start))
        cuts = np.concatenate(([0], np.cumsum(np.bincount(level, minlength=longest + 1))))[1:]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            arc = by_level[low:high]
            own_value = total[self.from_[arc]] + weight[arc]
            nodes = to[arc]
            heads = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
            peak = np.maximum.reduceat(own_value, heads)
            scaled = np.exp(own_value - np.repeat(peak, np.diff(np.append(heads, high - low))))
            total[nodes[heads]] = peak + np.log(np.add.reduceat(scaled, heads))
            value[arc] = own_value
        chance = np.exp(value - total[to])
        # Cumulated within a node; its last arc takes what rounding leaves.
        summed = np.cumsum(chance)
        heads = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else to
        run = np.diff(np.append(heads, len(to)))
        self.cumulated = summed - np.repeat((summed - chance)[heads], run)
        self.cumulated[heads + run - 1] = 2.0
        self.head = np.zeros(len(total), np.int32)
        self.head[to[heads]] = heads

    def sampled(self, node: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """An arc into each node, by a number from [0, 1)."""
        arc = self.head[node]
        left = np.flatnonzero(self.cumulated[arc] <= chance)
        while len(left):
            arc[left] += 1
            left = left[self.cumulated[arc[left]] <= chance[left]]
        return arc


def uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Numbers from [0, 1) by row key and place."""
    bits = mixed(key + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return np.minimum((bits >> np.uint64(11)).astype(np.float64) / (1 << 53), 1 - 1e-9)


def encoded(model: Lattice, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets of each text's ids) of a chunk of texts; keys: seeded 64-bit numbers."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(rows + 1, np.int64)
    found = Distinct(model.words, data, offsets)
    paths = Paths(model, found.data, found.offsets)
    kind = found.kind
    length = paths.lengths[kind]
    before = np.cumsum(length) - length  # characters before each pre-token
    row = np.repeat(np.arange(rows), np.diff(found.row_offsets))
    # Pre-tokens of texts only; texts that are not empty have some.
    text_start = before[np.minimum(found.row_offsets[:-1], len(before) - 1)]
    place = before - text_start[row]
    own_keys = keys[row]
    first = paths.first[kind]
    # The arc that ends after each character of the chunk, -1 where none does.
    chosen = np.full(int(length.sum()) + 1, -1, np.int32)
    node = first + length
    live = np.arange(len(kind))
    while len(live):
        inner = node - first[live]
        arc = paths.sampled(node, uniform(own_keys[live], place[live] + inner))
        chosen[before[live] + inner] = arc
        node = paths.from_[arc]
        more = node > first[live]
        live, node = live[more], node[more]
    ends = np.flatnonzero(chosen >= 0)
    arc = chosen[ends]
    piece = paths.piece[arc]
    many = np.where(piece >= 0, 1, paths.byte_size[arc])
    at = np.concatenate(([0], np.cumsum(many)))
    ids = np.repeat(piece, many)
    odd = np.flatnonzero(ids < 0)
    if len(odd):
        own = np.repeat(np.arange(len(arc)), many)[odd]
        ids[odd] = model.words.bytes_at[found.data[paths.byte_at[arc[own]] + odd - at[own]]]
    borders = np.append(before, length.sum())[found.row_offsets]
    return ids.astype(np.int32), at[np.searchsorted(ends, borders, "right")]


def decoded(model: Lattice, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that ids stand for, without the blank before them."""
    size = model.sizes[ids]
    offsets = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - model.starts[ids], size)
    flat = model.flat[place]
    borders = offsets[at]
    some = np.flatnonzero(borders[1:] > borders[:-1])
    keep = np.ones(len(flat), bool)
    keep[borders[some]] = False
    removed = np.concatenate(([0], np.cumsum(borders[1:] > borders[:-1])))
    return flat[keep], borders - removed


def row_keys(key: Column, seed: int) -> Column:
    return F.xxhash64(F.coalesce(key.cast("string"), F.lit("null")), F.lit(seed))


def blocks(batch: pa.RecordBatch, model: Lattice) -> Iterator[tuple]:
    """(first row, end row, bytes, offsets, ids, id offsets) of chunks of a batch."""
    keys = batch.column("row_key").to_numpy().astype(np.uint64)
    for low, high, data, offsets in pieces_of(batch.column("text"), BYTES):
        yield low, high, data, offsets, *encoded(model, data, offsets, keys[low:high])


def encode(docs: DataFrame, path: str, key: str = "doc_id", seed: int = 0, theta: float = 1.0) -> DataFrame:
    """(key, ids): one sampled segmentation for each text."""
    ready(docs.sparkSession)
    source = docs.select(F.col(key), F.col("text").cast("string").alias("text"), row_keys(F.col(key), seed).alias("row_key"))

    def run(batches):
        model = lattice(path, theta)
        for batch in batches:
            for low, high, _, _, ids, at in blocks(batch, model):
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), lists], names=[key, "ids"])

    return source.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode(encoded_: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, text) from (key, ids)."""
    ready(encoded_.sparkSession)

    def run(batches):
        model = lattice(path, 1.0)
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy()
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))).astype(np.int64)
            data, offsets = decoded(model, ids, at)
            texts = pa.Array.from_buffers(
                pa.large_string(),
                len(lists),
                [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())],
            )
            yield pa.RecordBatch.from_arrays([batch.column(key), texts.cast(pa.string())], names=[key, "text"])

    return encoded_.select(key, "ids").mapInArrow(run, f"`{key}` {encoded_.schema[key].dataType.simpleString()}, text string")


def encoded_documents(docs: DataFrame, path: str, seed: int = 0, theta: float = 1.0) -> DataFrame:
    """(doc_id, lang, source, n_pieces, ids, lossless): documents as sampled piece ids.

    lossless: whether the ids, decoded again, gave the text back.
    """
    ready(docs.sparkSession)
    source = docs.select(
        "doc_id", "lang", "source", F.col("text").cast("string").alias("text"), row_keys(F.col("doc_id"), seed).alias("row_key")
    )

    def run(batches):
        model = lattice(path, theta)
        for batch in batches:
            for low, high, data, offsets, ids, at in blocks(batch, model):
                flat, borders = decoded(model, ids, at)
                same = np.diff(borders) == np.diff(offsets)
                if len(flat) == len(data):
                    wrong = np.flatnonzero(flat != data)
                    same[np.searchsorted(offsets, wrong, "right") - 1] = False
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in range(3)),
                        pa.array(np.diff(at)),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids)),
                        pa.array(same),
                    ],
                    names=["doc_id", "lang", "source", "n_pieces", "ids", "lossless"],
                )

    kept = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", "lang", "source"))
    return source.mapInArrow(run, f"{kept}, n_pieces long, ids array<int>, lossless boolean")


DIGEST = "n_pieces long, ids_sha256 string, decoded_sha256 string, lossless boolean"


def digests(docs: DataFrame, path: str, key: str = "doc_id", seed: int = 0, theta: float = 1.0) -> DataFrame:
    """Per text: number of pieces, digest of the ids (as little-endian 32-bit numbers) and of
    the decoded bytes, and whether those are the text."""
    ready(docs.sparkSession)
    source = docs.select(F.col(key), F.col("text").cast("string").alias("text"), row_keys(F.col(key), seed).alias("row_key"))

    def run(batches):
        model = lattice(path, theta)
        for batch in batches:
            for low, high, data, offsets, ids, at in blocks(batch, model):
                flat, borders = decoded(model, ids, at)
                ids, flat, data = ids.astype("<i4").tobytes(), flat.tobytes(), data.tobytes()
                spans = [(4 * a, 4 * b) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                texts = [flat[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
                same = [t == data[a:b] for t, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(np.diff(at)),
                        pa.array([hashlib.sha256(ids[a:b]).hexdigest() for a, b in spans]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
                        pa.array(same),
                    ],
                    names=[key, "n_pieces", "ids_sha256", "decoded_sha256", "lossless"],
                )

    return source.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, {DIGEST}")


def op2_sentencepiece(docs: DataFrame, path: str) -> DataFrame:
    return digests(docs, path)
