"""Token ids in training order: fixed-stride binary shards, read sequentially and resumably.

1. Texts are tokenised and packed: the ids of a task's texts, each followed by the end
   mark, are cut into sequences of `length` ids; the last one of a task is padded.
   Sequences are written once, with a codec that sees many of them together.
2. A sequence's index is its number within its task plus the number of sequences of
   the tasks before. A keyed Feistel network permutes the indices: walking its cycle
   until the value is below the number of sequences makes it a permutation of exactly
   those. The value is the sequence's global slot.
3. Shard k holds the slots from k * per_shard on. The sequences are dealt to tasks by
   ranges of shards and each task writes its shards, record after record of
   2 * length bytes (little-endian 16-bit ids). A shard is written beside its place
   and renamed, and its bytes depend on the written sequences and the key alone, so a
   repeated task does no harm. The manifest, a table with a row per shard, is small.

A reader finds slot s at byte (s % per_shard) * 2 * length of shard s // per_shard, so
it resumes anywhere. The folder must be one that `pyarrow.fs` and all machines reach.

Null text counts as empty and gives an end mark alone. Repeated rows are repeated;
an empty table gives no shards. Very long texts are cut into sequences, whole. Only the id
(a number) and text columns are read. Which texts share a sequence depends on how the table
is split into tasks.
"""

from __future__ import annotations

import os
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import mixed, pieces_of, ready, stored
from ridelake.llm.pieces import MARK, Distinct, gathered, vocabulary
from ridelake.llm.token_counts import merge
from ridelake.sources.scratch import shared_folder

LENGTH, PER_SHARD = 4096, 1024
END, PAD = 2, 0
#: Distinct pre-tokens whose ids a task keeps; that saves time only.
KNOWN = 1 << 20


class Encoder:
    """Ids of texts; keeps the ids of pre-tokens it has met."""

    def __init__(self, path: str, known: int = KNOWN):
        self.words, self.known = vocabulary(path), known
        self.forget()

    def forget(self) -> None:
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.offsets = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def learn(self, hashes: np.ndarray, data: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> None:
        """Add pre-tokens; at: their places among the known hashes."""
        symbols, begin, size = self.words.symbols(data)
        lengths = np.diff(np.searchsorted(begin, offsets))
        ids, sequence, place = merge(self.words, symbols, lengths)
        many = np.where(ids < 0, size[place], 1)
        first = np.cumsum(many) - many
        flat = np.repeat(ids, many)
        odd = np.flatnonzero(flat < 0)
        own = np.repeat(np.arange(len(ids)), many)[odd]
        flat[odd] = self.words.bytes_at[data[begin[place[own]] + odd - first[own]]]
        count = np.bincount(sequence, many, minlength=len(lengths)).astype(np.int64)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.place = np.insert(self.place, at, len(self.offsets) - 1 + np.arange(len(hashes)))
        self.flat = np.concatenate((self.flat, flat.astype(np.uint16)))
        self.offsets = np.concatenate((self.offsets, self.offsets[-1] + np.cumsum(count)))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids)."""
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        found = Distinct(self.words, data, offsets)
        if len(self.hashes) > self.known:
            self.forget()
        at = np.searchsorted(self.hashes, found.hashes)
        old = np.zeros(len(found.hashes), bool)
        if len(self.hashes):
            old = self.hashes[np.minimum(at, len(self.hashes) - 1)] == found.hashes
        new = np.flatnonzero(~old)
        if len(new):
            own, borders = gathered(found.data, found.offsets[:-1][new], np.diff(found.offsets)[new])
            self.learn(found.hashes[new], own, borders, at[new])
        place = self.place[np.searchsorted(self.hashes, found.hashes)][found.kind]
        ids, borders = gathered(self.flat, self.offsets[place], self.offsets[place + 1] - self.offsets[place])
        return ids, borders[found.row_offsets]


class Packer:
    """Cuts a stream of texts' ids into sequences; remembers which ids touch each."""

    def __init__(self, length: int):
        self.length, self.number = length, 0
        self.ids: list[np.ndarray] = []
        self.owners: deque[tuple[int | None, int]] = deque()
        self.held = 0

    def add(self, doc_ids: list[int | None], ids: np.ndarray, at: np.ndarray) -> list[dict]:
        # The end mark behind each text.
        out = np.full(len(ids) + len(doc_ids), END, np.uint16)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(doc_ids)), np.diff(at))] = ids
        self.owners.extend(zip(doc_ids, (np.diff(at) + 1).tolist(), strict=True))
        self.ids.append(out)
        self.held += len(out)
        if self.held < self.length:
            return []
        flat = np.concatenate(self.ids)
        full = len(flat) // self.length
        made = [self.record(flat[k * self.length : (k + 1) * self.length]) for k in range(full)]
        self.ids, self.held = [flat[full * self.length :]], len(flat) - full * self.length
        return made

    def record(self, ids: np.ndarray) -> dict:
        left, owners = len(ids), []
        while left:
            doc_id, size = self.owners[0]
            owners.append(doc_id)
            if size > left:
                self.owners[0] = (doc_id, size - left)
                break
            left -= size
            self.owners.popleft()
        body = np.full(self.length, PAD, "<u2")
        body[: len(ids)] = ids
        self.number += 1
        return {
            "number": self.number - 1,
            "n_tokens": len(ids),
            "doc_ids": owners,
            "tokens": body.tobytes(),
        }

    def rest(self) -> list[dict]:
        return [self.record(np.concatenate(self.ids))] if self.held else []


SEQUENCE = "task long, number long, n_tokens int, doc_ids array<long>, tokens binary"
ARROW = pa.schema(
    [
        ("task", pa.int64()),
        ("number", pa.int64()),
        ("n_tokens", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
    ]
)


def sequences(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Packed sequences, numbered within their task."""
    ready(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))

    def run(batches):
        task = TaskContext.get().partitionId()
        encode, pack = Encoder(path), Packer(length)

        def batch_of(made: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"task": task, **m} for m in made], schema=ARROW)

        for batch in batches:
            texts = batch.column("text")
            if pc.any(pc.match_substring(texts, MARK)).as_py():
                texts = pc.replace_substring(texts, MARK, " ")
            for low, high, data, offsets in pieces_of(texts):
                made = pack.add(batch.column("doc_id").slice(low, high - low).to_pylist(), *encode(data, offsets))
                if made:
                    yield batch_of(made)
        if made := pack.rest():
            yield batch_of(made)

    return source.mapInArrow(run, SEQUENCE)


class Permutation:
    """A keyed permutation of the numbers below `size`."""

    def __init__(self, size: int, key: int, rounds: int = 6):
        self.size = size
        self.half = np.uint64(max(1, (max(size - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = mixed(np.arange(rounds, dtype=np.uint64) + mixed(np.array([key & (1 << 64) - 1], np.uint64)))

    def _network(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (mixed(left + k) & self.mask), left
            else:
                left, right = right, left ^ (mixed(right + k) & self.mask)
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        x = self._network(np.asarray(x, np.uint64), keys, back)
        far = np.flatnonzero(x >= self.size)
        while len(far):
            x[far] = self._network(x[far], keys, back)
            far = far[x[far] >= self.size]
        return x.astype(np.int64)

    def slot(self, index: np.ndarray) -> np.ndarray:
        return self._walk(index, self.keys, False)

    def index(self, slot: np.ndarray) -> np.ndarray:
        return self._walk(slot, self.keys[::-1], True)


MANIFEST = "shard long, path string, first_slot long, records long, n_tokens array<int>, doc_ids array<array<long>>"
MANIFEST_ARROW = pa.schema(
    [
        ("shard", pa.int64()),
        ("path", pa.string()),
        ("first_slot", pa.int64()),
        ("records", pa.int64()),
        ("n_tokens", pa.list_(pa.int32())),
        ("doc_ids", pa.list_(pa.list_(pa.int64()))),
    ]
)


class Shard:
    """One shard being written: beside its place first, then renamed."""

    def __init__(self, folder: str, shard: int, per_shard: int):
        self.files, self.place = fs.FileSystem.from_uri(f"{folder}/shard-{shard:08d}.bin")
        self.draft = f"{self.place}.{os.getpid()}-{TaskContext.get().taskAttemptId()}"
        self.files.create_dir(os.path.dirname(self.place), recursive=True)
        self.stream = self.files.open_output_stream(self.draft)
        self.row = {
            "shard": shard,
            "path": f"{folder}/shard-{shard:08d}.bin",
            "first_slot": shard * per_shard,
            "records": 0,
            "n_tokens": [],
            "doc_ids": [],
        }

    def add(self, n_tokens: int, doc_ids: list, body: bytes) -> None:
        self.stream.write(body)
        self.row["records"] += 1
        self.row["n_tokens"].append(n_tokens)
        self.row["doc_ids"].append(doc_ids)

    def close(self) -> dict:
        self.stream.close()
        self.files.move(self.draft, self.place)
        return self.row


def as_uri(folder: str) -> str:
    return folder if "://" in folder else f"file://{folder.removeprefix('file:')}"


def write_shards(docs: DataFrame, path: str, key: int = 1, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Writes the shards into a new shared folder; returns the manifest, itself written."""
    spark = ready(docs.sparkSession)
    folder = as_uri(shared_folder(spark))
    made = stored(sequences(docs, path, length), compression="zstd")
    # One row for each task that wrote sequences.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = made.groupBy("task").agg(F.count("*").alias("n"))
    tasks = tasks.select("task", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    total = tasks.agg(F.sum("n")).first()[0] or 0
    stride = 2 * length

    def place(batches):
        order, codec = Permutation(total, key), pa.Codec("zstd", compression_level=3)
        for batch in batches:
            index = pc.add(batch.column("base"), batch.column("number")).to_numpy()
            slot = order.slot(index)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(slot // per_shard),
                    pa.array(slot),
                    batch.column("n_tokens"),
                    batch.column("doc_ids"),
                    pa.array([codec.compress(t.as_buffer(), asbytes=True) for t in batch.column("tokens")], pa.binary()),
                ],
                names=["shard", "slot", "n_tokens", "doc_ids", "tokens"],
            )

    def write(batches):
        shard = None
        for batch in batches:
            done = []
            number, size, owners, bodies = (batch.column(c) for c in ("shard", "n_tokens", "doc_ids", "tokens"))
            for k in range(batch.num_rows):
                if shard is None or shard.row["shard"] != number[k].as_py():
                    if shard is not None:
                        done.append(shard.close())
                    shard = Shard(folder, number[k].as_py(), per_shard)
                body = pa.decompress(bodies[k].as_buffer(), stride, "zstd", asbytes=True)
                shard.add(size[k].as_py(), owners[k].as_py(), body)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=MANIFEST_ARROW)
        if shard is not None:
            yield pa.RecordBatch.from_pylist([shard.close()], schema=MANIFEST_ARROW)

    placed = made.join(F.broadcast(tasks.select("task", "base")), "task").mapInArrow(
        place, "shard long, slot long, n_tokens int, doc_ids array<long>, tokens binary"
    )
    dealt = placed.repartitionByRange("shard").sortWithinPartitions("slot")
    return stored(dealt.mapInArrow(write, MANIFEST))


READ = "slot long, shard long, n_tokens int, doc_ids array<long>"


def read_shards(manifest: DataFrame, first_slot: int = 0, length: int = LENGTH, digest: bool = False) -> DataFrame:
    """The sequences from `first_slot` on, read from the shards, in order within a shard.

    Their ids are in `tokens`, as bytes; with `digest` their crc32 is in `tokens_crc32` instead.
    """
    ready(manifest.sparkSession)
    stride = 2 * length
    wanted = manifest.where(F.col("first_slot") + F.col("records") > first_slot)
    name, kind = ("tokens_crc32", pa.int64()) if digest else ("tokens", pa.binary())

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                skip = max(0, first_slot - row["first_slot"])
                files, place = fs.FileSystem.from_uri(row["path"])
                with files.open_input_file(place) as stream:
                    stream.seek(skip * stride)
                    bodies = (stream.read(stride) for _ in range(skip, row["records"]))
                    read = [zlib.crc32(b) for b in bodies] if digest else list(bodies)
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(row["first_slot"] + np.arange(skip, row["records"]), pa.int64()),
                        "shard": pa.array([row["shard"]] * len(read), pa.int64()),
                        "n_tokens": pa.array(row["n_tokens"][skip:], pa.int32()),
                        "doc_ids": pa.array(row["doc_ids"][skip:], pa.list_(pa.int64())),
                        name: pa.array(read, kind),
                    }
                )

    return wanted.mapInArrow(run, f"{READ}, {name} {'long' if digest else 'binary'}")


def op10_token_output(docs: DataFrame, path: str) -> DataFrame:
    return read_shards(write_shards(docs, path), digest=True)
