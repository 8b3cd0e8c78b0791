"""N-gram Jaccard join: texts whose sets of word shingles are alike, by prefix trees.

A text's set holds its distinct shingles of `WORDS` lower-cased words (with fewer
words, the whole sequence as one), as 64-bit hashes. Two texts link when
100 * intersection >= 75 * union. The result is exact up to hash collisions: no
candidate is dropped, sampled or capped.

1. Equal sets are one: texts are grouped by a 128-bit fingerprint of the set, and the
   smallest doc_id stands for the group.
2. Global order: by document frequency over all texts, then by hash. Tasks sort the
   tokens of a block of texts into ranges of hashes and send each range as one binary
   row; a range counts its tokens and sends back, per block, how many tokens of each
   text are met in no other text, and the tokens met in several with the class of
   their frequency (its logarithm). Tokens of one text come first in the order, so a
   text with more of them than its prefix is long can link with none, and leaves here
   (about nine in ten do); for the rest only the shared tokens matter any more.
3. Prefix filter: linked sets share one of the first n - ceil(0.75 n) + 1 tokens. Texts
   are first grouped by the first shared token of the prefix and by a min-hash alone,
   which joins most copies of one text. Of all prefix tokens, only those whose texts are
   in several components yet are looked at again. Texts that such tokens connect make a
   group, to which each set is sent once or a few times. Where tokens connect more than
   `WIDE` * `GROUP` texts, each distinct list of texts of a token is a group instead;
   there histograms of the sets (an upper bound of the overlap) are sent first, and sets
   only of the texts that the bound leaves with a partner.
4. Within a group, sets are stored in a prefix tree in the global order. A traversal
   with one set carries the overlap from the root, shares it between all sets below,
   and leaves a subtree when the tokens left on either side cannot reach the overlap
   that its smallest set needs. Only sets outside the largest component of the group
   are traversed with, as pairs within a component need no comparison.
5. Components of the links found are those of all links.

A group of more than `GROUP` texts is dealt to tasks as pairs of blocks, so that no
task holds more than two blocks, and no group is collected anywhere.

Null and empty texts, and texts without words, have empty sets and link with nothing.
Repeated rows get the same component; a null doc_id stands for a group only if all its
ids are null. An empty table gives an empty result. Very long texts are read whole: a set
has as many tokens as the text. Only the id (a number) and the text are read;
`one_of_each` carries the other columns inside the row, so that their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ridelake.llm.common import Words, grams, mixed, pieces_of, ready, stored
from ridelake.llm.components import components

WORDS = 5
#: Tokens of a block of texts, bytes of a range of tokens, texts of a group in one task.
BLOCK, RANGE, GROUP = 1 << 20, 8 << 20, 1024
#: Groups of connected texts up to this many blocks are compared as one.
WIDE = 8
#: A token is sent as this many low bytes of its hash; its range tells the high bits.
SENT_BYTES = 6
#: Cells of a histogram of a set; a cell that is full counts as without limit.
CELLS, FULL = 256, (1 << 16) - 1
#: A token after counting: class of its frequency in the top bits, then its hash.
CLASS_BITS = 6


def needed(n: int) -> int:
    """Least overlap that a set of n tokens has with any set it links with: 0.75 n."""
    return -(-3 * n // 4)


def text_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all texts, ascending within a text; offsets of the texts)."""
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    full = words.full(WORDS)
    token, row = [grams(hashes, WORDS)[full]], [words.row[full]]
    for size in range(1, WORDS):
        short = np.flatnonzero(words.counts == size)
        if len(short):
            token.append(grams(hashes, size)[words.offsets[short]])
            row.append(short)
    token, row = np.concatenate(token), np.concatenate(row)
    order = np.argsort(token)
    order = order[np.argsort(row[order].astype(np.uint16 if words.rows < 1 << 16 else np.int64), kind="stable")]
    token, row = token[order], row[order]
    keep = np.ones(len(token), bool)
    keep[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return token[keep], np.searchsorted(row[keep], np.arange(words.rows + 1))


def fingerprints(token: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each text's tokens."""
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(token ^ np.uint64(salt)))))
        out.append(mixed(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def members(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, f1, f2) of every text."""
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces_of(batch.column("text")):
                token, at = text_sets(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(np.diff(at)), *map(pa.array, fingerprints(token, at))],
                    names=["doc_id", "n_shingles", "f1", "f2"],
                )

    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, f1 long, f2 long")


def packed(*arrays: np.ndarray, width: int = 8) -> bytes:
    """Small counts first, compressed, then the low bytes of the rest."""
    head = pa.compress(np.stack(arrays[:-1]).astype("<u4").tobytes(), "zstd", asbytes=True)
    sizes = np.array([len(arrays) - 1, len(arrays[0]), len(head)], "<u8").tobytes()
    numbers = arrays[-1].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return sizes + head + np.ascontiguousarray(numbers).tobytes()


def unpacked(payload: pa.Scalar, width: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(rows of counts, numbers of `width` bytes)."""
    buffer = payload.as_buffer()
    many, size, head = np.frombuffer(buffer, "<u8", 3).tolist()
    counts = np.frombuffer(pa.decompress(buffer.slice(24, head), 4 * many * size, "zstd"), "<u4").reshape(many, size)
    low = np.frombuffer(buffer, np.uint8)[24 + head :].reshape(-1, width)
    numbers = np.zeros((len(low), 8), np.uint8)
    numbers[:, :width] = low
    return counts.astype(np.int64), numbers.view("<u8").ravel()


SENT = "bin long, block long, directory boolean, payload binary"
SENT_NAMES = ["bin", "block", "directory", "payload"]


def dealt_tokens(docs: DataFrame, bins: int) -> DataFrame:
    """The tokens of all texts by range of hashes; a row per block of texts and range.

    A directory row of each block has the fingerprints of its texts; texts of a block
    with equal sets are sent once.
    """
    source = docs.select(F.col("text").cast("string").alias("text"))

    def rows_of(block: int, token: np.ndarray, count: np.ndarray) -> pa.RecordBatch | None:
        f1, f2 = fingerprints(token, np.concatenate(([0], np.cumsum(count))))
        _, first = np.unique(np.stack([f1, f2]), axis=1, return_index=True)
        once = np.zeros(len(count), bool)
        once[first] = True
        once &= count > 0
        if not once.any():
            return None
        token, f1, f2, count = token[np.repeat(once, count)], f1[once], f2[once], count[once]
        own = ((token >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
        order = np.argsort(own.astype(np.uint16 if bins < 1 << 16 else np.int64), kind="stable")
        cuts = np.searchsorted(own[order], np.arange(bins + 1))
        text = np.repeat(np.arange(len(count)), count)[order]
        token = token[order]
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        payload = [
            packed(np.bincount(text[cuts[k] : cuts[k + 1]], minlength=len(count)), token[cuts[k] : cuts[k + 1]], width=SENT_BYTES)
            for k in some
        ]
        payload.append(packed(np.zeros(2 * len(count)), np.concatenate((f1, f2)).view(np.uint64)))
        size = len(payload)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(some, bins + block % bins)),
                pa.array(np.full(size, block)),
                pa.array(np.arange(size) == size - 1),
                pa.array(payload, pa.binary()),
            ],
            names=SENT_NAMES,
        )

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        tokens, counts, held = [], [], 0
        for batch in batches:
            for _, _, data, offsets in pieces_of(batch.column("text")):
                token, at = text_sets(data, offsets)
                tokens.append(token)
                counts.append(np.diff(at))
                held += len(token)
                if held >= BLOCK:
                    made = rows_of(block, np.concatenate(tokens), np.concatenate(counts))
                    if made is not None:
                        yield made
                    block, tokens, counts, held = block + 1, [], [], 0
        if held and (made := rows_of(block, np.concatenate(tokens), np.concatenate(counts))) is not None:
            yield made

    return source.mapInArrow(run, SENT)


def counted(table: pa.Table) -> pa.Table:
    """Of one range of tokens: what goes back to each block."""
    directory = table["directory"].to_numpy()
    out = [table.filter(pa.array(directory)).select(["block", "directory", "payload"])]
    rows = table.filter(pa.array(~directory))
    if rows.num_rows:
        parts = [unpacked(p, SENT_BYTES) for p in rows["payload"]]
        token = np.concatenate([p[1] for p in parts])
        _, inverse, count = np.unique(token, return_inverse=True, return_counts=True)
        count = count[inverse]
        token = mixed(token + np.uint64((int(table["bin"][0].as_py()) << 8 * SENT_BYTES) & (1 << 64) - 1))
        key = (np.log2(np.maximum(count, 1)).astype(np.uint64) << np.uint64(64 - CLASS_BITS)) | (token >> np.uint64(CLASS_BITS))
        shared = count > 1
        payload, low = [], 0
        for counts, own in parts:
            high = low + len(own)
            text = np.repeat(np.arange(counts.shape[1]), counts[0])
            many = np.bincount(text[shared[low:high]], minlength=counts.shape[1])
            payload.append(packed(counts[0], many, key[low:high][shared[low:high]]))
            low = high
        out.append(
            pa.table({"block": rows["block"], "directory": rows["directory"], "payload": pa.array(payload, pa.binary())})
        )
    return pa.concat_tables(out)


NODE = pa.schema([("f1", pa.int64()), ("f2", pa.int64()), ("n", pa.int64()), ("prefix", pa.int64()), ("tokens", pa.binary())])


def reassembled(table: pa.Table) -> pa.Table:
    """Of one block: the texts that can link, with their shared tokens in global order.

    prefix: how many of those belong to the prefix.
    """
    directory = table["directory"].to_numpy()
    _, prints = unpacked(table.filter(pa.array(directory))["payload"][0])
    f1, f2 = prints.view(np.int64).reshape(2, -1)
    size, met = np.zeros(len(f1), np.int64), np.zeros(len(f1), np.int64)
    keys, texts = [], []
    for payload in table.filter(pa.array(~directory))["payload"]:
        counts, key = unpacked(payload)
        size += counts[0]
        met += counts[1]
        keys.append(key)
        texts.append(np.repeat(np.arange(len(f1)), counts[1]))
    key, text = np.concatenate(keys), np.concatenate(texts)
    order = np.argsort(key)
    order = order[np.argsort(text[order], kind="stable")]
    key, at = key[order], np.concatenate(([0], np.cumsum(met)))
    prefix = size + (-3 * size // 4) + 1 - (size - met)
    kept = np.flatnonzero((prefix > 0) & (met > 0))
    tokens = [key[at[k] : at[k + 1]].astype("<u8").tobytes() for k in kept]
    return pa.table([pa.array(f1[kept]), pa.array(f2[kept]), pa.array(size[kept]), pa.array(prefix[kept]), pa.array(tokens, pa.binary())], schema=NODE)


@dataclass
class Node:
    """A run of tokens that the sets below share."""

    run: np.ndarray
    smallest: int  # size of the smallest set below
    rest: int  # most shared tokens of a set below this run
    sets: list[int] = field(default_factory=list)  # that end here
    below: list[Node] = field(default_factory=list)


def prefix_tree(sets: list[np.ndarray], sizes: list[int]) -> Node:
    """A radix tree of sets, given as ascending arrays."""
    order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u8").tobytes())
    common = [0]
    for a, b in zip(order[:-1], order[1:], strict=True):
        size = min(len(sets[a]), len(sets[b]))
        apart = np.flatnonzero(sets[a][:size] != sets[b][:size])
        common.append(int(apart[0]) if len(apart) else size)
    shared = np.array(common)
    root = Node(np.zeros(0, np.uint64), 0, 0)
    todo = [(root, 0, len(order), 0)]
    while todo:
        above, low, high, depth = todo.pop()
        first = sets[order[low]]
        end = int(shared[low + 1 : high].min()) if high - low > 1 else len(first)
        node = Node(
            first[depth:end],
            min(sizes[k] for k in order[low:high]),
            max(len(sets[k]) for k in order[low:high]) - end,
            [k for k in order[low:high] if len(sets[k]) == end],
        )
        above.below.append(node)
        start = low + len(node.sets)  # sets that end here sort first
        cuts = [start, *(start + 1 + np.flatnonzero(shared[start + 1 : high] == end)).tolist(), high] if start < high else []
        todo += [(node, a, b, end) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return root


def traversed(root: Node, own: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(set, overlap) of the sets that can link with a set `own` of `size` tokens in all."""
    found = []
    todo = [(node, 0) for node in root.below]
    while todo:
        node, overlap = todo.pop()
        left = len(own)
        if len(node.run):
            place = np.searchsorted(own, node.run)
            inside = place < len(own)
            overlap += int((own[place[inside]] == node.run[inside]).sum())
            left = len(own) - int(np.searchsorted(own, node.run[-1], "right"))
        if 7 * (overlap + min(left, node.rest)) < 3 * (size + node.smallest):
            continue
        found += [(k, overlap) for k in node.sets]
        todo += [(n, overlap) for n in node.below]
    return found


def links_in(sets: list[np.ndarray], sizes: list[int], label: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is linked within a group, beyond `label` (components known)."""
    label = np.unique(label, return_inverse=True)[1]
    found: list[tuple[int, int]] = []

    def join(a: int, b: int) -> None:
        if label[a] != label[b]:
            found.append((a, b))
            label[label == label[b]] = label[a]

    if len(sets) == 2:
        if label[0] != label[1]:
            overlap = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            if 7 * overlap >= 3 * (sizes[0] + sizes[1]):
                join(0, 1)
        return found
    waiting = np.ones(len(sets), bool)
    root = None
    while True:
        open_ = np.flatnonzero(waiting)
        if not len(open_):
            break
        most = np.bincount(label[open_]).argmax()
        outside = open_[label[open_] != most]
        if not len(outside):
            break
        root = root or prefix_tree(sets, sizes)
        k = int(outside[0])
        waiting[k] = False
        for other, overlap in traversed(root, sets[k], sizes[k]):
            if other != k and 7 * overlap >= 3 * (sizes[k] + sizes[other]):
                join(k, other)
    return found


def in_blocks(groups: DataFrame, tokens: Column | None = None) -> DataFrame:
    """(key, low, high, id, component): groups of two or more as pairs of blocks of texts.

    A block holds about `GROUP` texts; with `tokens`, the size of a text's set, also no more
    tokens than so many texts of `GROUP` tokens, so that long texts come in small blocks.
    """
    weight = F.lit(0) if tokens is None else F.sum(tokens)
    sizes = groups.groupBy("key").agg(F.count("*").alias("size"), weight.alias("weight")).where(F.col("size") > 1)
    blocks = F.ceil(F.greatest(F.col("size") / GROUP, F.col("weight") / (GROUP * GROUP)))
    cut = groups.join(sizes, "key").withColumn("blocks", F.least(blocks, F.col("size")))
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    paired = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return paired.select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "id", "component"
    )


def group_links(groups: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b): links between the texts of each group; groups: (key, id, component)."""

    def run(table: pa.Table) -> pa.Table:
        ids, sizes = table["id"].to_numpy(), table["n"].to_pylist()
        order = np.argsort(ids, kind="stable").tolist()
        # The tokens stay where they arrived.
        sets = [np.frombuffer(table["tokens"][k].as_buffer(), "<u8") for k in order]
        found = links_in(sets, [sizes[k] for k in order], table["component"].to_numpy()[order])
        pairs = np.array([(ids[order[a]], ids[order[b]]) for a, b in found], np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    sized = groups.join(nodes.select("id", "n"), "id")
    full = in_blocks(sized, F.col("n")).join(nodes.select("id", "n", "tokens"), "id")
    return full.groupBy("key", "low", "high").applyInArrow(run, "a long, b long")


def possible(cells: np.ndarray, n: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Texts that may link with a text of another component: no link passes the bound.

    cells: histograms of the shared tokens; the overlap of two sets is at most the sum
    of the smaller cells.
    """
    cells = cells.astype(np.int64)
    cells[cells == FULL] = 1 << 40
    out = np.zeros(len(n), bool)
    for k in range(len(n)):
        other = np.flatnonzero((label != label[k]) & (7 * np.minimum(n, n[k]) >= 3 * (n + n[k])))
        if len(other):
            most = np.minimum(cells[other], cells[k]).sum(axis=1)
            near = other[7 * most >= 3 * (n[other] + n[k])]
            out[near] = True
            out[k] |= len(near) > 0
    return out


def possible_groups(groups: DataFrame, histograms: DataFrame) -> DataFrame:
    """Of the rows of `groups`, those whose text the bound leaves with a partner."""

    def run(table: pa.Table) -> pa.Table:
        cells = np.stack([np.frombuffer(c.as_buffer(), "<u2") for c in table["cells"]])
        keep = possible(cells, table["n"].to_numpy(), table["component"].to_numpy())
        return table.select(["key", "id", "component"]).filter(pa.array(keep))

    full = in_blocks(groups).join(histograms, "id")
    left = full.groupBy("key", "low", "high").applyInArrow(run, "key long, id long, component long")
    return left.distinct()


def histograms(nodes: DataFrame) -> DataFrame:
    """(id, n, cells): how many shared tokens of each text fall into each cell."""

    def run(batches):
        for batch in batches:
            cells = []
            for payload in batch.column("tokens"):
                token = np.frombuffer(payload.as_buffer(), "<u8")
                count = np.bincount((token % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
                cells.append(np.minimum(count, FULL).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), pa.array(cells, pa.binary())], names=["id", "n", "cells"]
            )

    return nodes.select("id", "n", "tokens").mapInArrow(run, "id long, n long, cells binary")


def prefix_postings(nodes: DataFrame) -> DataFrame:
    """(token, id, place): the shared tokens of each text's prefix.

    Place -1 has a min-hash of all its shared tokens in place of a token.
    """

    def run(batches):
        for batch in batches:
            tokens, many = [np.zeros(0, np.int64)], []
            for payload, size in zip(batch.column("tokens"), batch.column("prefix").to_pylist(), strict=True):
                own = np.frombuffer(payload.as_buffer(), "<u8")
                tokens += [mixed(own ^ np.uint64(0xA4093822299F31D0)).min(keepdims=True).view(np.int64), own[:size].view("<i8")]
                many.append(1 + min(size, len(own)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).astype(np.int64)),
                    pa.array(np.repeat(batch.column("id").to_numpy(), many)),
                    pa.array(np.concatenate([np.zeros(0, np.int64), *(np.arange(-1, size - 1) for size in many)])),
                ],
                names=["token", "id", "place"],
            )

    return nodes.select("id", "prefix", "tokens").mapInArrow(run, "token long, id long, place long")


def open_groups(rest: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, id, component): groups that hold each pair of texts to compare.

    rest: (token, id, component, hub) of the tokens whose texts are in several
    components; hub is one of a token's texts.
    """
    connected = components(rest.select(F.col("hub").alias("a"), F.col("id").alias("b")))
    sizes = connected.groupBy("component").agg(F.count("*").alias("size"))
    sized = stored(connected.join(sizes, "component").select("id", F.col("component").alias("key"), "size"))
    labels = rest.select("id", "component").distinct()
    small = sized.where(F.col("size") <= WIDE * GROUP).join(labels, "id").select("key", "id", "component")
    large = rest.join(sized.where(F.col("size") > WIDE * GROUP).select("id"), "id")
    # One token for each distinct list of texts.
    lists = (
        large.groupBy("token")
        .agg(
            F.count("*").alias("size"),
            F.bit_xor(F.xxhash64("id")).alias("x"),
            F.bit_xor(F.xxhash64("id", F.lit("again"))).alias("y"),
        )
        .groupBy("size", "x", "y")
        .agg(F.min("token").alias("token"))
        .select("token")
    )
    listed = large.join(lists, "token").select(F.col("token").alias("key"), "id", "component")
    return small.unionAll(stored(possible_groups(listed, histograms(nodes))))


def linked(docs: DataFrame, every: DataFrame, stands: DataFrame) -> DataFrame:
    """(id, component) of the sets that link with others.

    every: the sets of `docs`; stands: (f1, f2, id), the node of each set that takes part.
    """
    total = every.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    bins = max(1, -(-8 * total // RANGE))
    sent = dealt_tokens(docs, bins).groupBy("bin").applyInArrow(counted, "block long, directory boolean, payload binary")
    able = sent.groupBy("block").applyInArrow(reassembled, "f1 long, f2 long, n long, prefix long, tokens binary")
    once = able.groupBy("f1", "f2").agg(*(F.first(c).alias(c) for c in ("n", "prefix", "tokens")))
    nodes = stored(once.join(stands.where(F.col("id").isNotNull()), ["f1", "f2"]).select("id", "n", "prefix", "tokens"))
    postings = stored(prefix_postings(nodes))
    # Texts by their first prefix token, and by their min-hash; none is connected yet.
    first = postings.where(F.col("place") <= 0).select(F.col("token").alias("key"), "id", F.col("id").alias("component"))
    links = stored(group_links(first, nodes))
    known = components(links)
    labelled = (
        postings.where(F.col("place") >= 0)
        .join(known, "id", "left")
        .select("token", "id", F.coalesce("component", "id").alias("component"))
    )
    several = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"), F.min("id").alias("hub"))
        .where(F.col("least") != F.col("most"))
    )
    rest = stored(labelled.join(several.select("token", "hub"), "token"))
    more = stored(group_links(open_groups(rest, nodes), nodes))
    return components(links.unionAll(more))


def similar_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    ready(docs.sparkSession)
    every = stored(members(docs))
    # The smallest id of equal sets; a set without tokens equals no other.
    stands = stored(
        every.where(F.col("n_shingles") > 0).groupBy("f1", "f2").agg(F.min(F.col("doc_id").cast("long")).alias("id"))
    )
    joined = linked(docs, every, stands)
    stand = every.join(stands, ["f1", "f2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("id", F.col("doc_id").cast("long")).alias("id")
    )
    return stand.join(joined, "id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id")
    )


def with_sets(docs: DataFrame) -> DataFrame:
    """(row, text, n, f1, f2): each row of `docs`, its text, and the size and fingerprint of its set."""

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in pieces_of(batch.column("text")):
                token, at = text_sets(data, offsets)
                own = [np.diff(at), *fingerprints(token, at)]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, own)], names=["row", "text", "n", "f1", "f2"])

    # The row's own columns stay inside, whatever their names are.
    inside = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    source = docs.select(inside, F.col("text").cast("string").alias("text"))
    schema = StructType([*source.schema.fields, *(StructField(name, LongType()) for name in ("n", "f1", "f2"))])
    return source.mapInArrow(run, schema)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of `docs` for each component of texts, all columns, whatever their names.

    Rows are told apart by their texts, whatever their ids: of a component the row with
    the smallest id stays (without an id only if none has one), of several texts with
    that id the one with the smallest fingerprint, of several rows with the same set the
    first by text. Texts without words are in no component; of those with the same id and
    text one stays, and all without an id. Very long texts are read whole.
    """
    ready(docs.sparkSession)
    every = stored(members(docs))
    # A node for each set, as ids need not tell sets apart.
    sets = every.where(F.col("n_shingles") > 0).groupBy("f1", "f2").agg(F.min(F.col("doc_id").cast("long")).alias("first_id"))
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()))
    joined = linked(docs, every, sets.select("f1", "f2", "id"))
    stays = (
        sets.join(joined, "id", "left")
        .groupBy(F.coalesce("component", "id").alias("component"))
        .agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "f1", "f2")).alias("row"))
        .select(
            "row.f1",
            "row.f2",
            F.coalesce("row.first_id", F.lit(0)).alias("id"),
            F.col("row.first_id").isNotNull().alias("named"),
            F.lit("").alias("own"),
            F.lit(True).alias("stays"),
        )
    )
    by = ["f1", "f2", "id", "named", "own"]
    doc_id = F.col("row")["doc_id"]
    wordless = (
        F.when(doc_id.isNull(), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
        .when(F.col("text").isNull(), F.lit("null"))
        .otherwise(F.concat(F.lit("text "), F.col("text")))
    )
    # Rows with the same id and set are combined before the shuffle.
    rows = (
        with_sets(docs)
        .withColumn("id", F.coalesce(doc_id.cast("long"), F.lit(0)))
        .withColumn("named", doc_id.isNotNull())
        .withColumn("own", F.when(F.col("n") > 0, F.lit("")).otherwise(wordless))
        .groupBy(*by)
        .agg(F.min_by("row", F.coalesce("text", F.lit(""))).alias("row"), F.max("n").alias("n"))
    )
    kept = rows.join(stays, by, "left").where((F.col("n") == 0) | F.col("stays"))
    return kept.select("row.*")


def op3_ngram_jaccard(docs: DataFrame) -> DataFrame:
    return similar_components(docs)
