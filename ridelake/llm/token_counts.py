"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a chunk lie behind each other in one array of symbols,
with an array that says which pre-token a symbol belongs to. In each round all
sequences take their pair of lowest rank at once: neighbours that make a piece get
its rank, a minimum by sequence picks the pair, and one compression removes the
right halves. A sequence applies every occurrence of its pair in the round, from
left to right, unless one of the merges makes a pair that would come before the
occurrences left (then it applies the first alone), so that the order is exactly
one merge at a time by rank, then by place. Long sequences of that sort (a run of
100,000 blanks, whose pieces share one rank) are merged with a heap instead, as one
merge a round would take as many rounds as blanks. What survives is counted; characters
outside the vocabulary count their bytes.

Counts of pre-tokens that earlier chunks of a task have met are kept, up to
`KNOWN` of them; that saves time only.

Null text counts as empty: 0 bytes, 0 tokens. Repeated rows are counted each; an
empty table gives an empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import pieces_of, ready, text_bytes
from ridelake.llm.pieces import MARK, Distinct, Vocabulary, gathered, vocabulary

KNOWN = 1 << 20
#: Longer sequences whose merges hang on each other are merged with a heap.
LONG = 256
NEVER = np.iinfo(np.int32).max


def first_of_runs(mask: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """Every other entry of each run of True, beginning with its first."""
    at = np.flatnonzero(mask)
    if not len(at):
        return mask
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (sequence[at[1:]] != sequence[at[:-1]])
    start = np.maximum.accumulate(np.where(new, at, -1))
    out = np.zeros_like(mask)
    out[at[(at - start) % 2 == 0]] = True
    return out


def one_by_one(words: Vocabulary, symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """(symbols, places) of one sequence merged with a heap of pairs by rank and place."""
    pieces, size = symbols.tolist(), words.size
    after, before = list(range(1, len(pieces) + 1)), list(range(-1, len(pieces) - 1))
    made_by = words.pair_dict
    heap: list[tuple[int, int, int, int]] = []

    def offer(left: int, right: int) -> None:
        made = made_by.get(pieces[left] * size + pieces[right], -1) if min(pieces[left], pieces[right]) >= 0 else -1
        if made >= 0:
            heapq.heappush(heap, (int(words.rank[made]), left, right, made))

    sizes = [1] * len(pieces)
    for k in range(len(pieces) - 1):
        offer(k, k + 1)
    while heap:
        _, left, right, made = heapq.heappop(heap)
        if not sizes[left] or after[left] != right or made_by.get(pieces[left] * size + pieces[right]) != made:
            continue
        pieces[left], sizes[right] = made, 0
        after[left] = after[right]
        if after[left] < len(pieces):
            before[after[left]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    kept = [k for k in range(len(pieces)) if sizes[k]]
    return [pieces[k] for k in kept], kept


def merge(words: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, sequence of each, place of each among the symbols given) after all merges.

    symbols: sequences behind each other, -1 for a character that cannot merge.
    """
    sequence = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    place = np.arange(len(symbols))
    done: list[tuple[np.ndarray, ...]] = [(symbols[:0], sequence[:0], place[:0])]
    made = pairs_of(words, symbols, sequence)
    while len(symbols):
        rank = np.where(made >= 0, words.rank[made], NEVER)
        border = sequence[1:] != sequence[:-1]
        begin = np.flatnonzero(np.append(True, border))
        number = np.concatenate(([0], np.cumsum(border)))
        least = np.minimum.reduceat(rank, begin)[number]
        live = least != NEVER
        if not live.all():
            done.append((symbols[~live], sequence[~live], place[~live]))
            symbols, sequence, place, made, rank, least = (
                x[live] for x in (symbols, sequence, place, made, rank, least)
            )
            if not len(symbols):
                break
            number = np.concatenate(([0], np.cumsum(sequence[1:] != sequence[:-1])))
        # Of pairs that overlap, the left one.
        left = first_of_runs(rank == least, sequence)
        at = np.flatnonzero(left)
        gone = np.append(False, left[:-1])
        new_symbols = np.where(left, made, symbols)[~gone]
        new_sequence = sequence[~gone]
        new_made = pairs_of(words, new_symbols, new_sequence)
        several = at[np.bincount(number[at], minlength=number[-1] + 1)[number[at]] > 1]
        if len(several):
            # Would a pair made on the way come before, or beside, the occurrences left?
            alone = np.zeros(number[-1] + 1, bool)
            fresh = left[~gone]
            beside = np.append(fresh[:-1] | fresh[1:], False) & (new_made >= 0)
            early = beside & (words.rank[new_made] <= least[~gone])
            alone[number[~gone][early]] = True
            # The same for a neighbour that another occurrence takes in this round.
            for other in (2, -1):
                there = several + other
                ok = (there >= 0) & (there < len(symbols))
                ok[ok] = number[there[ok]] == number[several[ok]]
                a, b = several[ok], there[ok]
                pair = words.merged(made[a], symbols[b]) if other > 0 else words.merged(symbols[b], made[a])
                bad = (pair >= 0) & (words.rank[pair] <= least[a])
                alone[number[a[bad]]] = True
            alone &= np.bincount(number[several], minlength=len(alone)) > 0
            if alone.any():
                length = np.bincount(number)
                for k in np.flatnonzero(alone & (length > LONG)):
                    # Merges that hang on each other in a long sequence: one at a time.
                    own = np.flatnonzero(number == k)
                    pieces, kept = one_by_one(words, symbols[own])
                    done.append((np.array(pieces, np.int32), sequence[own][kept], place[own][kept]))
                _, first = np.unique(number[at], return_index=True)
                only = np.zeros_like(left)
                only[at[first]] = True
                left &= ~alone[number] | only
                gone = np.append(False, left[:-1]) | (alone & (length > LONG))[number]
                new_symbols = np.where(left, made, symbols)[~gone]
                new_sequence = sequence[~gone]
                new_made = pairs_of(words, new_symbols, new_sequence)
        symbols, sequence, place, made = new_symbols, new_sequence, place[~gone], new_made
    symbols, sequence, place = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(place)
    return symbols[order], sequence[order], place[order]


def pairs_of(words: Vocabulary, symbols: np.ndarray, sequence: np.ndarray) -> np.ndarray:
    """What each symbol makes with the next one of its sequence, -1 for nothing."""
    if not len(symbols):
        return symbols
    made = words.merged(symbols[:-1], symbols[1:])
    made[sequence[:-1] != sequence[1:]] = -1
    return np.append(made, np.int32(-1))


def counts(words: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each of the texts (pre-tokens) that `offsets` delimits."""
    ids, at, size = words.symbols(data)
    lengths = np.diff(np.searchsorted(at, offsets))
    symbols, sequence, place = merge(words, ids, lengths)
    tokens = np.where(symbols < 0, size[place], 1)
    return np.bincount(sequence, tokens, minlength=len(lengths)).astype(np.int64)


class Counter:
    """Counts tokens of texts; keeps what it knows of pre-tokens between chunks."""

    def __init__(self, path: str, known: int = KNOWN):
        self.words, self.known = vocabulary(path), known
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        found = Distinct(self.words, data, offsets)
        tokens = np.zeros(len(found.hashes), np.int64)
        place = np.searchsorted(self.hashes, found.hashes)
        old = np.zeros(len(tokens), bool)
        if len(self.hashes):
            old = self.hashes[np.minimum(place, len(self.hashes) - 1)] == found.hashes
            tokens[old] = self.counts[place[old]]
        new = np.flatnonzero(~old)
        if len(new):
            lengths = np.diff(found.offsets)[new]
            flat, at = gathered(found.data, found.offsets[:-1][new], lengths)
            tokens[new] = counts(self.words, flat, at)
            if len(self.hashes) + len(new) > self.known:
                self.hashes, self.counts = self.hashes[:0], self.counts[:0]
                place = np.zeros(len(tokens), np.int64)
            self.hashes = np.insert(self.hashes, place[new], found.hashes[new])
            self.counts = np.insert(self.counts, place[new], tokens[new])
        total = np.concatenate(([0], np.cumsum(tokens[found.kind])))
        return total[found.row_offsets[1:]] - total[found.row_offsets[:-1]]


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every text."""
    ready(docs.sparkSession)
    kind = docs.schema[id_column].dataType
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches):
        count = Counter(path)
        for batch in batches:
            texts = batch.column("text")
            plain = texts
            if pc.any(pc.match_substring(texts, MARK)).as_py():
                plain = pc.replace_substring(texts, MARK, " ")
            size = np.diff(text_bytes(texts)[1])
            for low, high, data, offsets in pieces_of(plain):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(size[low:high].astype(np.int64)),
                        pa.array(count(data, offsets)),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return source.mapInArrow(run, f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long")


def op7_token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    return token_counts(docs, path).withColumn("over_limit", F.col("n_tokens") > limit)
