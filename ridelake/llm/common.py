"""What the operators share: tables, folders, and words of texts as numpy arrays.

Texts are handled in Arrow batches. A batch is cut into chunks of whole texts of
about `CHUNK` bytes, so that the arrays of a task stay small; a text longer than
that is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.sources.scratch import shared_folder

CHUNK = 1 << 21
REPO = str(Path(__file__).resolve().parents[2])

# Word separators: blank and the control characters 9 to 13.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: Arrow batches hold at most this much, whatever the length of the texts.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it; bound batches."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    here = spark.sparkContext.environment.get("PYTHONPATH", "")
    if REPO not in here.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{REPO}:{here}" if here else REPO
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """`df` written to the shared folder and read again: lineage ends here."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves `rest` when divided by `parts`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == rest


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most `size` bytes, or of one longer row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(rows, max(high, low + 1))
        yield low, high
        low = high


def pieces_of(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each chunk of a string column."""
    data, offsets = text_bytes(column)
    for low, high in chunks(offsets, size):
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]


def by_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `mask` over the rows that `offsets` delimits."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=8)
def byte_codes(lower: bool = False) -> np.ndarray:
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return codes[LOWER] if lower else codes


@lru_cache(maxsize=2)
def _powers(size: int) -> np.ndarray:
    base = np.full(size, 0x5851F42D4C957F2D, np.uint64)
    base[0] = 1
    return np.multiply.accumulate(base)


def powers(size: int) -> np.ndarray:
    return _powers(1 << max(12, int(size).bit_length()))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of data[start:end] for spans in order that do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    # Positions of all bytes in spans, and each byte's place in its span.
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    value = byte_codes(lower)[data[place + np.repeat(starts, lengths)]]
    value *= powers(int(lengths.max()))[place]
    total = np.zeros(len(starts), np.uint64)
    some = lengths > 0
    total[some] = np.add.reduceat(value, first[some])
    return mixed(total + lengths.astype(np.uint64))


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a chunk of texts.

    starts, ends: bytes of each word; row: its text; offsets: each text's words.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.rows = data, len(offsets) - 1
        self.inside = inside = ~SEPARATOR[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        cuts = offsets[:-1][offsets[:-1] < offsets[1:]]
        begin[cuts] = inside[cuts]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        end[last] = inside[last]
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.offsets = np.searchsorted(self.starts, offsets).astype(np.int64)
        self.counts = np.diff(self.offsets)
        self.row = np.repeat(np.arange(self.rows, dtype=np.int64), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)

    def full(self, size: int) -> np.ndarray:
        """Whether `size` words from each word on lie in its text."""
        at = np.arange(len(self.row), dtype=np.int64)
        return at + size <= self.offsets[1:][self.row]


#: Odd multipliers of the words of an n-gram, by place.
PLACES = mixed(np.arange(11, 27, dtype=np.uint64)) | np.uint64(1)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` successive words; the last size - 1 entries mean nothing."""
    total = hashes * PLACES[0]
    for k in range(1, size):
        total[: max(0, len(hashes) - k)] += hashes[k:] * PLACES[k]
    return mixed(total + np.uint64(size))


def in_rows(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Values made different from row to row, so that equality holds within a row."""
    return mixed(values + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def codepoints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte at which each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    size = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
    point = np.where(size == 1, lead, lead & (0x7F >> size))
    for k in range(1, 4):
        more = size > k
        point[more] = (point[more] << 6) | (data[np.minimum(at[more] + k, len(data) - 1)] & 0x3F)
    return point, at
