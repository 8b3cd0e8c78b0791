"""Benchmark decontamination: texts that hold a benchmark item, some edits apart.

Texts and items are lower-cased and their blanks folded to one. A text holds an item if
the smallest edit distance of the item to any substring of the text is at most
`Limits.most` of the item's length. An item shorter than `Limits.shortest` code points
after folding has one edit, below `Limits.whole` none, and must then stand in the text as
whole words (where a script puts blanks between words). A pair is found in three steps:

1. CGK random walks map edit distance to Hamming distance: step j puts out the byte under
   the walk's pointer and moves the pointer on or not by a random bit of (j, byte), so that
   walks over two strings fall into step again after an edit. A walk of `STEPS` steps starts
   at every byte, whatever the script and its blanks; overlapping windows share their
   walks, and all of them are made in one sweep from the last step to the first, as
   the rest of a walk is a walk that began later. Bit sampling: a table hashes some
   of the steps (`TABLES`). The embedding of an item-sized window is the row of its
   walks, and each byte of it is a repetition: a window is a candidate if `need` of
   them agree with walks of the item. Items below `SEVERAL` bytes, with few walks, have three
   tables. Unedited items agree everywhere; measured recall of edited ones: README.
   Items below `Limits.shortest`, too short for walks, are found by runs of bytes of which
   one edit leaves so many that none is missed.
2. A lower bound: the item is cut into blocks of 64 characters, whose smallest distances
   to the place add up to no more than the item's (bit-parallel, over all places of a
   chunk at once). No pair that is near enough is lost here.
3. The exact distance at the places left (bit-parallel, on whole strings).

Empty and null items are held by no text. Null and empty texts hold nothing; very long
ones are read whole. Repeated items and texts are reported each; empty tables give an empty
result. Only ids and texts are read, and `without_items` returns rows as they are, so that
further columns, of whatever name, do no harm. Items are sent to the tasks in blocks of about
`BLOCK` bytes, one reading of the texts each; equal rows are sent once, with their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import CHUNK, Words, pieces_of, ready
from ridelake.llm.pieces import gathered

MOST, SHORTEST, WHOLE, BLOCK = 0.2, 40, 20, 4 << 20
#: Steps of a walk. Its tables: a seed of the moves, and the steps sampled, with gaps where edits
#: may lie. Seeds differ in how walks take deleted blanks; these were chosen by measured recall.
STEPS = 12
TABLES = [(1, (0, 1, 2, 3, 6, 8, 9, 10, 11)), (3, (0, 1, 3, 6, 7, 8, 9, 10, 11)), (2, (0, 1, 2, 3, 6, 8, 9, 10, 11))]
#: Bytes of an item below which all tables are used; bytes of a longer one for each walk that must agree.
SEVERAL, EACH = 72, 18
#: Bytes that are walked together; their arrays stay in a near cache.
SWEEP = 1 << 15
FILTER_BITS = 22
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: Characters of a block of an item, kinds of characters that the lower bound tells apart.
BITS, KINDS = 64, 64
#: Bytes of items for which texts are read in chunks of `CHUNK`; with more, chunks are smaller.
LIGHT = 1 << 17


@dataclass(frozen=True)
class Limits:
    """Edits per character; characters below which one edit, and none, is accepted."""

    most: float = MOST
    shortest: int = SHORTEST
    whole: int = WHOLE

    def allowed(self, length: int) -> int:
        """Edits up to which an item of so many characters is held."""
        if length < self.whole:
            return 0
        return int(self.most * length) if length >= self.shortest else 1


def randomness() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(moves by table, step and byte; codes by step and byte; factor), the same everywhere.

    Of two successive steps each byte moves the pointer in one, which one is random:
    no byte holds a walk up for long.
    """
    first = np.array([np.random.default_rng(seed).integers(0, 2, (STEPS // 2, 256)) for seed, _ in TABLES]).astype(bool)
    moves = np.stack((first, ~first), axis=2).reshape(len(TABLES), STEPS, 256)
    codes = np.random.default_rng(20240229).integers(0, 1 << 32, (STEPS, 256), dtype=np.uint64)
    return moves, codes.astype(np.uint32), np.uint32(0x9E3779B1)


MOVES, CODES, FACTOR = randomness()


def walks(data: np.ndarray, table: int) -> np.ndarray:
    """The hash of the sampled steps of the walk from each byte; blanks follow the last one."""
    moves, sampled = MOVES[table], TABLES[table][1]
    out = np.empty(len(data), np.uint64)
    padded = np.concatenate((data, np.full(STEPS, 0x20, np.uint8)))
    for low in range(0, len(data), SWEEP):
        byte = padded[low : low + SWEEP + STEPS].astype(np.intp)
        # later[k]: the rest of the walk, from the step at hand on, that stands at byte k.
        later, now = np.zeros(len(byte) + 1, np.uint32), np.zeros(len(byte) + 1, np.uint32)
        on, code = np.empty(len(byte), bool), np.empty(len(byte), np.uint32)
        for step in range(STEPS - 1, -1, -1):
            np.copyto(now[:-1], later[:-1])
            np.take(moves[step], byte, out=on, mode="clip")
            np.copyto(now[:-1], later[1:], where=on)
            if step in sampled:
                now *= FACTOR
                now[:-1] += np.take(CODES[step], byte, out=code, mode="clip")
            later, now = now, later
        high = min(len(data), low + SWEEP)
        out[low:high] = later[: high - low]
    return out


def runs(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number, the first lowest."""
    wide = np.concatenate((data, np.zeros(7, np.uint8))).astype(np.uint64)
    for k in (1, 2, 4):
        wide = wide[:-k] | (wide[k:] << np.uint64(8 * k))
    return wide


def low_bytes(many: int) -> np.uint64:
    return np.uint64((1 << (8 * many)) - 1)


def folded(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words with one blank behind each, and where each begins."""
    size = words.ends - words.starts
    out, at = gathered(np.append(data, np.uint8(0x20)), words.starts, size + 1)
    out[at[1:] - 1] = 0x20
    return out, at


def distance(pattern: str, text: str, most: int) -> tuple[int, int]:
    """(smallest edit distance of `pattern` to a substring of `text`, where that ends).

    Bit-parallel dynamic programming over the columns of the edit matrix, whose bits
    are the rises and falls from row to row. The first best end is given.
    """
    found = text.find(pattern)
    if found >= 0:
        return 0, found + len(pattern)
    size = len(pattern)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for k, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << k)
    rise, fall, score = full, 0, size
    best, end = size, 0
    for k, c in enumerate(text):
        same = where.get(c, 0)
        flat = same | fall
        across = ((((same & rise) + rise) ^ rise) | same) & full
        up = fall | (~(across | rise) & full)
        down = rise & across
        if up & top:
            score += 1
        if down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        rise = (down | ~(flat | up)) & full
        fall = up & flat
        if score < best:
            best, end = score, k + 1
    return best, end


class Keys:
    """Which items have a key: that of a walk, or `-kind` bytes for a negative kind."""

    def __init__(self, kind: int, key: np.ndarray, item: np.ndarray):
        order = np.lexsort((item, key))
        self.kind, self.item = kind, item[order]
        self.keys, first = np.unique(key[order], return_index=True)
        self.first = np.append(first, len(key))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.slot(self.keys)] = True

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * SPREAD) >> np.uint64(64 - FILTER_BITS)).view(np.int64)

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte of the text, item) of all keys that begin at a byte and are an item's."""
        key = keys(data, self.kind)
        near = np.flatnonzero(self.filter[self.slot(key)])
        at = np.minimum(np.searchsorted(self.keys, key[near]), len(self.keys) - 1)
        same = self.keys[at] == key[near]
        near, at = near[same], at[same]
        low = self.first[at]
        many = self.first[at + 1] - low
        entry = np.arange(many.sum()) + np.repeat(low - np.cumsum(many) + many, many)
        return np.repeat(near, many), self.item[entry]


def keys(data: np.ndarray, kind: int) -> np.ndarray:
    """The key that begins at each byte: of the walk of a table, or `-kind` bytes."""
    return runs(data) & low_bytes(-kind) if kind < 0 else walks(data, kind)


def in_word(c: str) -> bool:
    """Whether a character is part of a word in a script with blanks between words."""
    return c.isalnum() and (c < "\u0e00" or "\uac00" <= c < "\ud7a4")


def whole(pattern: str, text: str) -> int:
    """Where the first `pattern` ends in `text` that is not cut out of a longer word, or -1."""
    at = text.find(pattern)
    while at >= 0:
        end = at + len(pattern)
        before = at > 0 and in_word(text[at - 1]) and in_word(pattern[0])
        behind = end < len(text) and in_word(text[end]) and in_word(pattern[-1])
        if not before and not behind:
            return end
        at = text.find(pattern, at + 1)
    return -1


@dataclass
class Index:
    """Walks, runs and blocks of characters of a block of items."""

    ids: list
    texts: list[str] = field(default_factory=list)
    #: How many rows each item stands for.
    copies: list[int] = field(default_factory=list)
    #: By item: shared keys needed, edits allowed, characters of a place that may hold it.
    need: np.ndarray | list[int] = field(default_factory=list)
    most: np.ndarray | list[int] = field(default_factory=list)
    limits: Limits = Limits()

    @classmethod
    def of(
        cls, ids: list, texts: list[str | None], copies: list[int] | None = None, limits: Limits = Limits()
    ) -> Index:
        out = cls([], limits=limits)
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        out.bytes = 0
        for item_id, text, many in zip(ids, texts, copies or [1] * len(ids), strict=True):
            lowered = pc.utf8_lower(pa.array([text or ""]))
            for _, _, data, offsets in pieces_of(lowered):
                flat = folded(data, Words(data, offsets))[0][:-1]
                plain = flat.tobytes().decode()
                if not plain:
                    continue
                if len(plain) >= limits.shortest:
                    need = max(2, len(flat) // EACH)
                    kinds = range(len(TABLES) if len(flat) < SEVERAL else 1)
                elif len(plain) >= limits.whole:
                    # One edit of twenty characters leaves ten in a row, so three runs of eight.
                    need, kinds = 2, [-max(1, min(8, limits.whole // 2 - 2))]
                else:
                    need, kinds = 1, [-min(8, len(flat))]
                for kind in kinds:
                    # Without edits the first run is enough.
                    places = 1 if need == 1 else len(flat)
                    if kind < 0 < need - 1:
                        places = len(flat) + kind + 1
                    own = np.unique(keys(flat, kind)[:places])
                    found.setdefault(kind, []).append((own, np.full(len(own), len(out.ids))))
                out.ids.append(item_id)
                out.texts.append(plain)
                out.copies.append(many)
                out.need.append(need)
                out.most.append(limits.allowed(len(plain)))
                out.bytes += len(flat)
        out.keys = [Keys(kind, *(np.concatenate(x) for x in zip(*own, strict=True))) for kind, own in sorted(found.items())]
        out.need, out.most = np.array(out.need, np.int64), np.array(out.most, np.int64)
        out.span = np.array([len(t) for t in out.texts], np.int64) + out.most
        out.cut()
        return out

    def cut(self) -> None:
        """Blocks of the items: for each kind of character, the bits of its places."""
        blocks = [t[k : k + BITS] for t in self.texts for k in range(0, len(t), BITS)]
        self.block_at = np.cumsum([0] + [-(-len(t) // BITS) for t in self.texts])
        self.block_size = np.array([len(b) for b in blocks], np.int64)
        self.places = np.zeros((len(blocks), KINDS), np.uint64)
        for k, block in enumerate(blocks):
            for bit, c in enumerate(block):
                self.places[k, ord(c) % KINDS] |= np.uint64(1 << bit)
        self.places = self.places.ravel()

    def chunk(self) -> int:
        """Bytes of texts to look at together: keys shared with many items take memory."""
        return max(CHUNK >> 6, CHUNK * LIGHT // max(LIGHT, self.bytes))

    def least(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances of items to any substring of kinds[low:high]."""
        many = self.block_at[item + 1] - self.block_at[item]
        place = np.repeat(np.arange(len(item)), many)
        block = np.arange(many.sum()) + np.repeat(self.block_at[item] - np.cumsum(many) + many, many)
        order = np.argsort(low[place] - high[place], kind="stable")
        place, block = place[order], block[order]
        size = (high - low)[place]
        best = self.block_size[block]
        score, own, at = best.copy(), block * KINDS, low[place]
        top = (best - 1).astype(np.uint64)
        rise, fall = np.full(len(place), ~np.uint64(0)), np.zeros(len(place), np.uint64)
        one = np.uint64(1)
        # Lanes of shorter places are last, and leave first.
        active = len(place) - np.searchsorted(size[::-1], np.arange(size[0] if len(size) else 0), "right")
        for step, left in enumerate(active.tolist()):
            if left < len(rise):
                rise, fall, score, own, at, top = (x[:left] for x in (rise, fall, score, own, at, top))
            same = self.places[own + kinds[at + step]]
            flat = same | fall
            across = same & rise
            across += rise
            across ^= rise
            across |= same
            up = fall | ~(across | rise)
            down = rise & across
            score += ((up >> top) & one).view(np.int64)
            score -= ((down >> top) & one).view(np.int64)
            np.minimum(best[:left], score, out=best[:left])
            up <<= one
            down <<= one
            rise = down | ~(flat | up)
            fall = up & flat
        return np.bincount(place, best, len(item)).astype(np.int64)

    def candidates(self, flat: np.ndarray, number: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, first and end character) of places that share enough keys, in order.

        number: the character of each byte; begins: the first character of each text.
        """
        byte, item = (np.concatenate(x) for x in zip(*(own.shared(flat) for own in self.keys), strict=True))
        if len(self.keys) > 1:
            # Two tables may agree at one byte; places are in order for each alone.
            order = np.argsort(byte, kind="stable")
            byte, item = byte[order], item[order]
        order = np.argsort(item.astype(np.uint16) if len(self.ids) <= 1 << 16 else item, kind="stable")
        item, at = item[order], number[byte[order]].astype(np.int64)
        last = np.arange(len(item)) + self.need[item] - 1
        some = np.flatnonzero(last < len(item))
        last = last[some]
        close = (item[last] == item[some]) & (at[last] - at[some] <= self.span[item[some]])
        some, last = some[close], last[close]
        text = np.searchsorted(begins, at[some], "right") - 1
        inside = at[last] < begins[text + 1]
        text, item, at = text[inside], item[some][inside], at[some][inside]
        span = self.span[item]
        part = at // span
        new = np.ones(len(at), bool)
        new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (part[1:] != part[:-1])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(at))[: len(first)] - 1
        text, item, span = text[first], item[first], span[first]
        # The last character of a text in `flat` is the blank behind it.
        return text, item, np.maximum(begins[text], at[first] - span), np.minimum(begins[text + 1] - 1, at[end] + span + 1)

    def held(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, words) of lower-cased texts, best place of each item."""
        words = Words(data, offsets)
        if not len(self.ids) or not len(words.row):
            return
        flat, at = folded(data, words)
        lead = (flat & 0xC0) != 0x80
        number = np.cumsum(lead, dtype=np.int32) - 1
        # The byte of each character, the character at which each text begins.
        byte = np.append(np.flatnonzero(lead), len(flat))
        begins = np.append(number, len(byte) - 1)[at[words.offsets]].astype(np.int64)
        text, item, low, high = self.candidates(flat, number, begins)
        # The low bits of a character are those of its last byte.
        kinds = flat[byte[1:] - 1] % np.uint8(KINDS)
        near = np.flatnonzero(self.least(item, low, high, kinds) <= self.most[item])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for held, which, a, b in zip(*(x[near].tolist() for x in (text, item, low, high)), strict=True):
            old = best.get((held, which))
            if old is not None and old[0] == 0:
                continue
            pattern, most = self.texts[which], int(self.most[which])
            window = flat[byte[a] : byte[b]].tobytes().decode()
            if len(pattern) < self.limits.whole:
                end = whole(pattern, window)
                away = 0 if end >= 0 else most + 1
            else:
                away, end = distance(pattern, window, most)
            if away <= most and (old is None or away < old[0]):
                # The best start: the same from the end, with both strings turned round.
                _, back = distance(pattern[::-1], window[:end][::-1], most)
                inside = window[end - back : end]
                # The word of the first character that is no blank.
                first = byte[a + end - back + len(inside) - len(inside.lstrip())]
                place = int(np.searchsorted(at, first, "right")) - 1 - int(words.offsets[held])
                best[held, which] = (away, place, inside.strip().count(" ") + 1)
        for (held, which), (away, place, many) in sorted(best.items()):
            yield held, which, away, place, many


def indexes(benchmark: DataFrame, id_column: str, text: str, limits: Limits = Limits()) -> Iterator[Index]:
    """The distinct items in blocks, each of which is small enough to send to all tasks."""
    rows = benchmark.select(F.col(id_column).alias("item_id"), F.col(text).cast("string").alias("text"))
    items = rows.where(F.octet_length("text") > 0).groupBy("item_id", "text").agg(F.count("*").alias("many"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = -(-total // BLOCK)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("text", "item_id"), F.lit(max(1, count))))
    for block in range(count):
        rows = dealt.where(F.col("block") == block).orderBy("item_id", "text").collect()
        yield Index.of([r["item_id"] for r in rows], [r["text"] for r in rows], [r["many"] for r in rows], limits)


def matches(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "item_id", text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """(doc_id, item_id, edit_distance, similarity, first_word, n_words): items that texts hold."""
    spark = ready(docs.sparkSession)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema[id_column].dataType.simpleString()}, "
        "edit_distance int, similarity double, first_word long, n_words long"
    )

    def finder(sent):
        def run(batches):
            index = sent.value
            for batch in batches:
                rows, found = [], []
                for low, _, data, offsets in pieces_of(pc.utf8_lower(batch.column("text")), index.chunk()):
                    for text, *rest in index.held(data, offsets):
                        rows.append(low + text)
                        found.append(rest)
                if rows:
                    which, away, first, many = (list(x) for x in zip(*found, strict=True))
                    like = [1 - a / len(index.texts[w]) for a, w in zip(away, which, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(rows)),
                            pa.array([index.ids[w] for w in which]),
                            pa.array(away, pa.int32()),
                            pa.array(like, pa.float64()),
                            pa.array(first, pa.int64()),
                            pa.array(many, pa.int64()),
                            pa.array([index.copies[w] for w in which], pa.int64()),
                        ],
                        names=["doc_id", "item_id", "edit_distance", "similarity", "first_word", "n_words", "copies"],
                    )

        return run

    out = None
    for index in indexes(benchmark, id_column, text, limits):
        part = source.mapInArrow(finder(spark.sparkContext.broadcast(index)), f"{schema}, copies long")
        part = part.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], schema)


def without_items(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "item_id", text: str = "text", limits: Limits = Limits()
) -> DataFrame:
    """The rows of `docs` whose text holds no item, all columns."""
    spark = ready(docs.sparkSession)

    def cleaner(sent):
        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                lowered = pc.utf8_lower(batch.column("text"))
                for low, _, data, offsets in pieces_of(lowered, sent.value.chunk()):
                    for held in sent.value.held(data, offsets):
                        keep[low + held[0]] = False
                yield batch.filter(pa.array(keep))

        return run

    for index in indexes(benchmark, id_column, text, limits):
        docs = docs.mapInArrow(cleaner(spark.sparkContext.broadcast(index)), docs.schema)
    return docs


def op4_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return matches(docs, benchmark)
