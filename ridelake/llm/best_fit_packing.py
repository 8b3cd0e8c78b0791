"""Best-fit-decreasing packing of token pieces into sequences of fixed size.

1. Texts become ids, each text followed by the end mark; what is longer than `size` is
   cut into pieces of `size`, the last of which may be shorter.
2. Pieces are packed longest first, each into the tightest open bin that holds it; a
   segment tree over the remaining capacities finds that bin in logarithmic time.
   Pieces of one length are interchangeable, so the plan is made for the number of
   pieces of each length: bins of one capacity stand together as a range of sequence
   numbers, and a step of the plan fills a whole range with one length. What comes out
   is what packing piece by piece gives, from at most `size` numbers and a count each,
   however many documents there are.
3. Pieces are sorted by (length, id, piece) over all tasks. A piece's rank among those
   of its length says which step of the plan places it, in which sequence, and where.
   Equal lengths are dealt by id, so that a frequent length has many tasks. The
   sequence of a piece depends on the rows alone, not on their files or partitions.

A text is cut where the tokeniser cuts in any case (blanks 9 to 13 and 32, a letter beside
a sign), and the library is asked once for each distinct part, told apart by 64 bits.

Null text counts as empty: one piece of the end mark. Very long texts are read whole and
give many pieces. Repeated rows are packed each for itself, equal pieces of one id in
any order. An empty table packs nothing. Only `doc_id` (of any type that can be sorted)
and `text` are read, so that further columns, of whatever name, do no harm.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import SEPARATOR, pieces_of, ready, span_hashes, stored
from ridelake.llm.pieces import gathered

SIZE = 4096
#: The mark behind each text.
END = 1
#: Distinct parts whose ids a Python worker keeps; that saves time only.
KNOWN = 1 << 20


#: Kinds of bytes: blanks part texts; a border of letters (1) and signs (2) does so too.
#: The signs of contractions and of special strings (' and |) are neither.
KIND = np.full(256, 3, np.uint8)
KIND[SEPARATOR] = 0
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalpha() and chr(b) not in "'|"]] = 2


def parts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the parts that texts may be cut into without changing their ids.

    Blanks separate parts. No rule of the tokeniser reaches over a border of a letter
    and a sign, both of ASCII; letters of U+00C0 to U+00FF count as such.
    """
    kind = KIND[data]
    wide = np.flatnonzero(data[:-1] == 0xC3)
    # All but the signs of multiplication and division.
    wide = wide[(data[wide + 1] != 0x97) & (data[wide + 1] != 0xB7)]
    kind[wide] = kind[wide + 1] = 1
    inside = kind != 0
    fresh = np.ones(len(data) + 1, bool)
    # Different neighbours: with a blank, or a letter beside a sign.
    fresh[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] + kind[:-1] <= 3)
    fresh[1:-1] &= (kind[1:] != 3) & (kind[:-1] != 3) | ~inside[1:] | ~inside[:-1]
    fresh[offsets] = True
    return np.flatnonzero(fresh[:-1] & inside), np.flatnonzero(fresh[1:] & inside) + 1


class PartIds:
    """Ids of texts by the library, which is asked once for each distinct part of a text."""

    def __init__(self, path: str, known: int = KNOWN):
        # One thread for a task; without it the library warns about forked processes.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model, self.known = Tokenizer.from_file(path), known
        self.forget()

    def forget(self) -> None:
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.offsets = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, hashes: np.ndarray, texts: list[str], at: np.ndarray) -> None:
        """Add parts; at: their places among the known hashes."""
        made = [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, made), np.int64, len(made))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.place = np.insert(self.place, at, len(self.offsets) - 1 + np.arange(len(hashes)))
        ids = np.fromiter(chain.from_iterable(made), np.uint32, int(lengths.sum()))
        self.flat = np.concatenate((self.flat, ids))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(lengths)))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids) of the texts that `offsets` delimits in `data`."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        starts, ends = parts(data, offsets)
        hashes, first, kind = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > self.known:
            self.forget()
        at = np.searchsorted(self.hashes, hashes)
        old = np.zeros(len(hashes), bool)
        if len(self.hashes):
            old = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes
        new = np.flatnonzero(~old)
        if len(new):
            own, borders = gathered(data, starts[first[new]], (ends - starts)[first[new]])
            texts = pa.LargeStringArray.from_buffers(len(new), pa.py_buffer(borders), pa.py_buffer(own))
            self.learn(hashes[new], texts.to_pylist(), at[new])
        place = self.place[np.searchsorted(self.hashes, hashes)][kind]
        ids, borders = gathered(self.flat, self.offsets[place], self.offsets[place + 1] - self.offsets[place])
        return ids, borders[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=1)
def encoder(path: str) -> PartIds:
    """One for a Python worker, which runs many tasks; what it knows changes no ids."""
    return PartIds(path)


def pieces(docs: DataFrame, path: str, size: int = SIZE, digest: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every text; ids as little-endian 32-bit numbers.

    With `digest` the crc32 of those bytes is in `ids_crc32` instead. `task` and
    `number` tell equal rows apart.
    """
    ready(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    name, kind = ("ids_crc32", "long") if digest else ("ids", "binary")

    def run(batches):
        task, number, encode = TaskContext.get().partitionId(), 0, encoder(path)
        for batch in batches:
            for low, high, data, offsets in pieces_of(batch.column("text")):
                ids, at = encode(data, offsets)
                rows = high - low
                # The end mark behind each text.
                flat = np.full(len(ids) + rows, END, "<u4")
                flat[np.arange(len(ids)) + np.repeat(np.arange(rows), np.diff(at))] = ids
                total = np.diff(at) + 1
                many = -(-total // size)
                row = np.repeat(np.arange(rows), many)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * size
                length = np.minimum(total[row] - start, size)
                begin = (at[:-1] + np.arange(rows))[row] + start
                body = memoryview(flat.tobytes())
                cuts = zip((4 * begin).tolist(), (4 * (begin + length)).tolist(), strict=True)
                if digest:
                    found = pa.array([zlib.crc32(body[a:b]) for a, b in cuts], pa.int64())
                else:
                    found = pa.array([body[a:b].tobytes() for a, b in cuts], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, rows).take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        found,
                        pa.array(np.full(len(row), task), pa.int64()),
                        pa.array(number + np.arange(len(row)), pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", name, "task", "number"],
                )
                number += len(row)

    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {key}, piece int, start long, length long, {name} {kind}, task long, number long"
    )


class Capacities:
    """A segment tree over the capacities 0 to `size`: which of them open bins have.

    `bins[c]` holds ranges (first sequence, number) of bins with capacity c.
    """

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.bins: dict[int, list[tuple[int, int]]] = {}

    def _mark(self, capacity: int, some: bool) -> None:
        node = self.leaves + capacity
        self.some[node] = some
        while node > 1:
            node >>= 1
            self.some[node] = self.some[2 * node] | self.some[2 * node + 1]

    def open(self, capacity: int, first: int, number: int) -> None:
        if number and capacity:
            here = self.bins.setdefault(capacity, [])
            here.append((first, number))
            if len(here) == 1:
                self._mark(capacity, True)

    def take(self, capacity: int) -> tuple[int, int]:
        here = self.bins[capacity]
        found = here.pop()
        if not here:
            self._mark(capacity, False)
        return found

    def tightest(self, need: int) -> int:
        """The smallest capacity of an open bin that is `need` at least, or -1."""
        node = self.leaves + need
        if not self.some[node]:
            # Up to the first right sibling that has bins, then down to its first leaf.
            while node > 1 and (node & 1 or not self.some[node + 1]):
                node >>= 1
            if node <= 1:
                return -1
            node += 1
            while node < self.leaves:
                node = 2 * node if self.some[2 * node] else 2 * node + 1
        return node - self.leaves


#: A step of the plan: the pieces of `length` from rank `rank` on go, `each` to a
#: sequence, to the sequences from `first` on, behind the `offset` tokens there.
STEP = np.dtype([(c, np.int64) for c in ("length", "rank", "first", "each", "offset")])


def best_fit(counts: dict[int, int], size: int = SIZE) -> tuple[np.ndarray, int]:
    """(steps by length and rank, number of sequences) for so many pieces of each length."""
    free, steps, made = Capacities(size), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = free.tightest(length)
            if capacity < 0:
                # New bins: as many as the rest of this length fills, the last one perhaps in part.
                capacity, each = size, size // length
                first, number = made, -(-left // each)
                made += number
            else:
                each = capacity // length
                first, number = free.take(capacity)
            full = min(number, left // each)
            if full:
                steps.append((length, rank, first, each, size - capacity))
                free.open(capacity - each * length, first, full)
                left, rank = left - full * each, rank + full * each
            if full < number and left:
                # Fewer than `each` are left: they share one bin.
                steps.append((length, rank, first + full, left, size - capacity))
                free.open(capacity - left * length, first + full, 1)
                left, full = 0, full + 1
            free.open(capacity, first + full, number - full)
    plan = np.array(steps, STEP)
    return plan[np.lexsort((plan["rank"], plan["length"]))], made


def placed(plan: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with these lengths and ranks."""
    wide = np.int64(plan["rank"].max() + 1 if len(plan) else 1)
    wide = max(wide, np.int64(rank.max() + 1 if len(rank) else 1))
    step = plan[np.searchsorted(plan["length"] * wide + plan["rank"], length * wide + rank, "right") - 1]
    along = rank - step["rank"]
    return step["first"] + along // step["each"], step["offset"] + along % step["each"] * length


def ranked(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """`pieces` with `part`, a range of the order by `keys`, and `place` among its length there."""
    source = pieces.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches):
        part, last, seen = TaskContext.get().partitionId(), -1, 0
        for batch in batches:
            length = batch.column("length").to_numpy()
            if not len(length):
                continue
            begin = np.flatnonzero(np.concatenate(([True], length[1:] != length[:-1])))
            place = np.arange(len(length)) - np.repeat(begin, np.diff(np.append(begin, len(length))))
            if length[0] == last:
                place[: begin[1] if len(begin) > 1 else len(length)] += seen
            last, seen = length[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(length), part), pa.int64()), pa.array(place, pa.int64())],
                names=[*batch.schema.names, "part", "place"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(run, f"{kinds}, part long, place long")


def packed(found: DataFrame, size: int = SIZE, keys: tuple[str, ...] = ("doc_id", "piece", "task", "number")) -> DataFrame:
    """Pieces (with their `length`, 1 to `size`) with `sequence_id` and `offset`.

    `keys` order the pieces of a length; those that agree in all of them are taken
    to be interchangeable.
    """
    ready(found.sparkSession)
    found = stored(found)
    # At most `size` rows come to the driver.
    counts = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, _ = best_fit(counts, size)
    # Written, so that the ranges of the order stay what they are.
    inside = stored(ranked(found, ["length", *keys]))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A length spans neighbouring ranges: rows as many as lengths and ranges together.
    base = (
        inside.groupBy("part", "length")
        .agg(F.count("*").alias("n"))
        .select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    source = inside.join(base, ["part", "length"]).drop("part")
    names = [c for c in found.columns if c not in ("task", "number")]

    def run(batches):
        for batch in batches:
            rank = batch.column("base").to_numpy() + batch.column("place").to_numpy()
            sequence, offset = placed(plan, batch.column("length").to_numpy(), rank)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name in names)
    return source.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(found: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences of packed pieces that carry their ids.

    A group is one sequence, of `size` tokens at most.
    """
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda done, p: F.concat(done, p["ids"]))
    return found.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def op11_best_fit_packing(docs: DataFrame, path: str) -> DataFrame:
    return packed(pieces(docs, path, digest=True))
