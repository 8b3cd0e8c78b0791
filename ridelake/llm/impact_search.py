"""Ranked lexical search: item tiles times document impact tiles, exactly, by dense BLAS products.

Terms are the maximal runs of ASCII letters and digits and of anything beyond ASCII, only
A-Z lower-cased. A term of a document has the impact (10^9 tf) div (1000 tf + 8 m); an
item's weight for it is its occurrences in the item times w. A score is the sum of their
products.

1. Items are taken in passes of at most `PASS` bytes of text (an item longer than that
   is a pass of its own). A pass's vocabulary is numbered, and each document becomes
   its length and the numbers and counts of the vocabulary terms in it, which is written.
   Frequencies of terms and documents are counted over all of these.
2. Each task takes its documents in tiles. The terms that occur in a tile and stand in a
   block of items are numbered anew, closely, and cut into vocabulary tiles of `WIDTH`;
   weights and impacts of a tile are dense float64 matrices, and one BLAS product gives
   all partial sums. No weight in a tile is above `CAP` and no impact reaches 10^6, so
   that every partial sum stays below 2^53 and is exact in whatever order BLAS adds;
   a larger weight is split into several summands. Tiles are added as 64-bit integers.
3. A task keeps each item's `top` best documents. Of a tile it takes all that reach the
   worst of them, ties included, and drops by (score, doc_id) only. The best of all
   tasks are ranked by a window, which cuts off before its shuffle.

Null and empty texts, and texts without a term, are no documents and no items. Very long
texts are read whole. Rows of `documents` are documents each, also with one id; ids may
have any type that can be sorted, null comes last. Rows of `benchmark` that agree in id
and text are one item; those that agree in the id only are ranked each from 1. An empty
table gives an empty result. Only ids and texts are read, so that further columns, of
whatever name, do no harm. Terms are told apart by 64 bits of hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import by_row, pieces_of, ready, span_hashes, stored, text_bytes

TOP = 10
#: Bytes of item texts in a pass; items in a block of a pass.
PASS, BLOCK = 4 << 20, 256
#: Documents and terms of a tile.
TILE, WIDTH = 512, 1024
#: No impact reaches this.
IMPACT = 1_000_000
#: WIDTH * CAP * IMPACT < 2^53.
CAP = (1 << 53) // IMPACT // WIDTH - 1

INSIDE = np.zeros(256, bool)
INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of the terms, in order; row of each; number of each row)."""
    inside = INSIDE[data]
    border = np.ones(len(data) + 1, bool)
    border[1:-1] = inside[1:] != inside[:-1]
    border[offsets] = True
    begin = border[:-1] & inside
    starts, ends = np.flatnonzero(begin), np.flatnonzero(border[1:] & inside) + 1
    number = by_row(begin, offsets)
    row = np.repeat(np.arange(len(number)), number)
    return span_hashes(data, starts, ends, lower=True), row, number


def counted(values: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, value, count) of the distinct pairs, by row, then value; values below `size`."""
    both, count = np.unique(row * size + values, return_counts=True)
    return both // size, both % size, count


@dataclass
class Items:
    """A pass: its items, and how often each has each term of the vocabulary."""

    ids: pa.Array
    vocabulary: np.ndarray
    item: np.ndarray
    term: np.ndarray
    count: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    documents: int = 0
    length: int = 0

    @staticmethod
    def of(ids: pa.Array, texts: pa.Array) -> Items:
        hashes, row, _ = terms(*text_bytes(texts))
        vocabulary, term = np.unique(hashes, return_inverse=True)
        return Items(ids, vocabulary, *counted(term, row, max(1, len(vocabulary))))

    def weighed(self, documents: int, length: int, found: dict[int, int]) -> Items:
        """With w of each term, of all documents' number and length and the terms' frequencies."""
        frequency = [found.get(k, 0) for k in range(len(self.vocabulary))]
        w = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency]
        weights = np.array(w, np.int64)
        return Items(self.ids, self.vocabulary, self.item, self.term, self.count, weights, documents, length)


def document_terms(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term; terms: numbers in the vocabulary."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    vocabulary = items.vocabulary

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces_of(batch.column("text")):
                hashes, row, number = terms(data, offsets)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
                hit = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else at[:0]
                row, term, count = counted(at[hit], row[hit], max(1, len(vocabulary)))
                some = number > 0
                borders = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=high - low)[some])))
                borders = pa.array(borders, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low).filter(pa.array(some)),
                        pa.array(number[some], pa.int64()),
                        pa.ListArray.from_arrays(borders, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(borders, pa.array(count, pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, counts array<long>")


def statistics(rows: DataFrame, size: int) -> tuple[int, int, dict[int, int]]:
    """(documents, their terms, documents by vocabulary term): counted by task, then added.

    As many rows as the vocabulary has come to the driver, and two more.
    """

    def run(batches):
        documents = length = 0
        found = np.zeros(size, np.int64)
        for batch in batches:
            documents += batch.num_rows
            length += int(batch.column("n").to_numpy().sum())
            found += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, [-1, -2])), pa.array(np.append(found[some], [documents, length]))],
            names=["term", "n"],
        )

    made = rows.select("n", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    total = {r["term"]: r["n"] for r in made.collect()}
    return total.pop(-1, 0), total.pop(-2, 0), total


def summands(weights: np.ndarray) -> list[np.ndarray]:
    """Parts of at most `CAP` whose sum is `weights`, as float64."""
    out = []
    while True:
        part = np.minimum(weights, CAP)
        out.append(part.astype(np.float64))
        weights = weights - part
        if not weights.any():
            return out


class Best:
    """Each item's best documents so far, ties by document id."""

    def __init__(self, items: int, top: int):
        self.top, self.table, self.worst = top, None, np.ones(items, np.int64)

    def add(self, scores: np.ndarray, ids: pa.Array, first: int) -> None:
        """Scores of the items from `first` on (lines) for the documents `ids`."""
        worst = self.worst[first : first + len(scores)]
        if scores.shape[1] > self.top:
            tenth = np.partition(scores, -self.top, axis=1)[:, -self.top]
            worst = np.maximum(worst, tenth)
        item, at = np.nonzero(scores >= worst[:, None])
        if not len(item):
            return
        new = pa.table({"item": item + first, "score": scores[item, at], "doc_id": ids.take(pa.array(at))})
        both = new if self.table is None else pa.concat_tables([self.table, new])
        both = both.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item = both["item"].to_numpy()
        begin = np.searchsorted(item, item)
        place = np.arange(len(item)) - begin
        kept = np.flatnonzero(place < self.top)
        self.table = both.take(pa.array(kept))
        full = np.flatnonzero(place == self.top - 1)
        self.worst[item[full]] = both["score"].to_numpy()[full]


def lengths_share(n: np.ndarray, items: Items) -> np.ndarray:
    """m of documents with n terms."""
    if len(n) and 75 * int(n.max()) * items.documents >= 1 << 63:
        return np.array([25 + 75 * k * items.documents // items.length for k in n.tolist()], np.int64)
    return 25 + 75 * n * items.documents // max(1, items.length)


def scored(rows: DataFrame, items: Items, top: int = TOP) -> DataFrame:
    """(item, item_id, doc_id, score): each task's best documents of each item."""
    number = len(items.ids)
    key = rows.schema["doc_id"].dataType.simpleString()

    def blocks():
        """Per block of items: first item, number, and its weights as (item, term, weight)."""
        for first in range(0, number, BLOCK):
            a, b = np.searchsorted(items.item, [first, first + BLOCK])
            yield first, min(BLOCK, number - first), items.item[a:b] - first, items.term[a:b], items.count[a:b]

    def tile(n, borders, term, count, ids, best):
        row = np.repeat(np.arange(len(n)), np.diff(borders))
        m = lengths_share(n, items)
        impact = (1_000_000_000 * count) // (1000 * count + 8 * m[row])
        present = np.zeros(len(items.vocabulary), bool)
        present[term] = True
        for first, many, item, wanted, times in blocks():
            shared = np.zeros(len(present), bool)
            shared[wanted] = True
            shared &= present
            close = np.cumsum(shared) - 1
            size = int(shared.sum())
            mine, theirs = shared[wanted], shared[term]
            weights = np.zeros((many, size), np.int64)
            weights[item[mine], close[wanted[mine]]] = times[mine] * items.weights[wanted[mine]]
            impacts = np.zeros((size, len(n)))
            impacts[close[term[theirs]], row[theirs]] = impact[theirs]
            scores = np.zeros((many, len(n)), np.int64)
            for low in range(0, size, WIDTH):
                for part in summands(weights[:, low : low + WIDTH]):
                    scores += (part @ impacts[low : low + WIDTH]).astype(np.int64)
            best.add(scores, ids, first)

    def run(batches):
        best = Best(number, top)
        for batch in batches:
            n, ids = batch.column("n").to_numpy(), batch.column("doc_id")
            lists = batch.column("terms")
            at = lists.offsets.to_numpy().astype(np.int64)
            at = at - at[0]
            term, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            for low in range(0, len(n), TILE):
                high = min(len(n), low + TILE)
                a, b = at[low], at[high]
                tile(n[low:high], at[low : high + 1] - a, term[a:b], count[a:b], ids.slice(low, high - low), best)
        if best.table is not None:
            for part in best.table.combine_chunks().to_batches():
                yield pa.RecordBatch.from_arrays(
                    [part.column("item"), items.ids.take(part.column("item")), part.column("doc_id"), part.column("score")],
                    names=["item", "item_id", "doc_id", "score"],
                )

    item_key = {"string": "string", "int32": "int", "int64": "long"}[str(items.ids.type)]
    return rows.mapInArrow(run, f"item long, item_id {item_key}, doc_id {key}, score long")


def passes(benchmark: DataFrame, size: int = PASS) -> list[DataFrame]:
    """Distinct (item_id, text) rows, dealt to passes of about `size` bytes by a hash."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    key = "string" if kind not in ("int", "bigint") else kind
    rows = benchmark.select(F.col("item_id").cast(key), F.col("text").cast("string").alias("text"))
    rows = stored(rows.where(F.length("text") > 0).distinct())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    number = -(-total // size)
    if number <= 1:
        return [rows] if number else []
    return [rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k) for k in range(number)]


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, size: int = PASS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0."""
    spark = ready(docs.sparkSession)
    found = None
    for chosen in passes(benchmark, size):
        # One pass of items is on the driver at a time.
        table = chosen.toArrow()
        items = Items.of(table["item_id"].combine_chunks(), table["text"].combine_chunks())
        rows = stored(document_terms(docs, items))
        items = items.weighed(*statistics(rows, len(items.vocabulary)))
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = scored(rows, items, top).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        best = best.select("item_id", "rank", "doc_id", "score")
        found = best if found is None else stored(found).unionByName(best)
    if found is None:
        item, key = (t.schema[c].dataType.simpleString() for t, c in ((benchmark, "item_id"), (docs, "doc_id")))
        return spark.createDataFrame([], f"item_id {item}, rank int, doc_id {key}, score long")
    return found


def op12_ranked_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(docs, benchmark)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0),
i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms
      FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
q AS (SELECT item, item_id, term, count(*) AS q FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
tf AS (SELECT nr, doc_id, n, term, count(*) AS tf
       FROM (SELECT nr, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
       WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
p AS (SELECT nr, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)) AS impact
      FROM tf, s),
r AS (SELECT item, item_id, nr, doc_id, sum(q * w * impact)::BIGINT AS score
      FROM q JOIN w USING (term) JOIN p USING (term) GROUP BY ALL),
t AS (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
      FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM t WHERE rank <= 10
"""
