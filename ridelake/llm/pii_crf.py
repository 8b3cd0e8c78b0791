"""Personal data by patterns, and by a skip-chain conditional random field around them.

The patterns find the base spans. The field labels tokens (words) as e-mail, address,
card, phone or other. Its nodes are the words that hold a digit or `@`; every other
word is `other` for sure, so that neighbours of a node enter as potentials and leaving
them out of the graph changes nothing. Neighbouring nodes share a transition
potential. Distant nodes of a document share a skip potential when they repeat each
other or are similar: same letters and digits, same last seven digits, or same name
before `@`; the occurrences of one key are linked in a row, so links grow with the
tokens. Loopy belief propagation over all documents of a chunk at once (damped,
`ROUNDS` rounds) gives each node's label probabilities. A node outside base spans with
an entity label of probability `SURE` or more becomes a span, together with
neighbours of its label; the base spans stay as they are.

Training is piecewise, on at most `SAMPLE` documents (the documented bound) with the
base spans as labels: a multinomial logistic model of hashed token features gives the
node potentials, smoothed pointwise mutual information of neighbouring and of linked
labels the edge potentials.

Offsets are code points, ends exclusive. Null text counts as empty: no spans. Repeated
rows are treated each; an empty table gives an empty result. Very long texts are
searched whole. Only the id and the text are read, and `mask` replaces the text alone, so
that further columns, of whatever name, do no harm.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, pieces_of, ready
from ridelake.llm.supervised import fitted

KINDS = ("email", "ip", "card", "phone")
OTHER, LABELS = 0, 5
SAMPLE, FEATURES, SLOTS = 16384, 1 << 13, 10
ROUNDS, DAMPING, SURE = 12, 0.5, 0.9

# Fixed patterns. A local part runs up to an `@`, so each `@` is looked at once.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part, `@` and a domain, in one pass over the `@`s."""
    done, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > done and LOCAL.fullmatch(text[low - 1]):
            low -= 1
        domain = DOMAIN.match(text, at + 1)
        if low < at and domain:
            yield low, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def ip_ok(text: str) -> bool:
    parts = (p.lstrip("0") for p in text.split("."))
    return all(len(p) < 4 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by start, then kind."""
    found = [("email", a, b) for a, b in emails(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if ip_ok(m[0])]
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def shape(token: str) -> str:
    """Letters as a, digits as 9, runs as one, the rest as it is; long shapes cut at 24."""
    out = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", token))
    return out if len(out) <= 24 else "long"


def features(token: str, before: str, after: str) -> list[int]:
    """Hashed features of a token between its neighbours, `SLOTS` of them."""
    digits = digits_of(token)
    bare = token.rstrip(".,;:!?\"'")
    parts = bare.strip("()[]\"'").split(".")
    named = (
        "bias",
        f"shape {shape(bare)}",
        f"digits {min(len(digits), 20)} of {min(len(token), 24) // 4}",
        f"at {bare.count('@')} {min(bare.count('.'), 4)}",
        f"luhn {12 <= len(digits) <= 19 and luhn(digits)}",
        f"address {len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"first {token[0] if not token[0].isalnum() else 'a'} {bare[-1] if bare and not bare[-1].isalnum() else 'a'}",
        f"before {before.lower() if not re.search('[0-9@]', before) else shape(before)}",
        f"after {shape(after) if re.search('[0-9@]', after) else 'word'}",
        f"hyphens {min(token.count('-'), 3)} {'(' in token}",
    )
    return [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=4).digest(), "little") % FEATURES for n in named]


def similarity_keys(token: str) -> list[str]:
    plain, digits = re.sub(r"[\W_]+", "", token.lower()), digits_of(token)
    out = [f"same {plain}"] if len(plain) >= 4 else []
    if len(digits) >= 7:
        out.append(f"tail {digits[-7:]}")
    if "@" in token and len(name := token.lower().split("@")[0]) >= 4:
        out.append(f"name {name}")
    return out


@dataclass
class Graph:
    """Nodes of one document: spans, features, base labels; edges to the next node and beyond."""

    text: str
    base: list[Span]
    spans: list[tuple[int, int]] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)
    chained: list[bool] = field(default_factory=list)  # to the node before
    skips: list[tuple[int, int]] = field(default_factory=list)

    def add(self, span: tuple[int, int], before: str, after: str, chained: bool, last: dict[str, int]) -> None:
        token = self.text[span[0] : span[1]]
        number = len(self.spans)
        label = OTHER
        for kind, low, high in self.base:
            if low < span[1] and span[0] < high:
                label = 1 + KINDS.index(kind)
                break
        self.spans.append(span)
        self.features.append(features(token, before, after))
        self.labels.append(label)
        self.chained.append(chained)
        linked = set()
        for key in similarity_keys(token):
            old = last.get(key)
            if old is not None and not (chained and old == number - 1) and old not in linked:
                self.skips.append((old, number))
                linked.add(old)
            last[key] = number


def graphs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, Graph]]:
    """(text, graph) of the texts that hold a digit or `@`."""
    hot = ((data >= 48) & (data <= 57)) | (data == 64)
    if not hot.any():
        return
    words = Words(data, offsets)
    sums = np.concatenate(([0], np.cumsum(hot, dtype=np.int64)))
    nodes = np.flatnonzero(sums[words.ends] > sums[words.starts])
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    rows = words.row[nodes]
    cuts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(nodes)).tolist(), strict=True):
        row = int(rows[a])
        low, high = int(words.offsets[row]), int(words.offsets[row + 1])
        text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
        base = int(points[offsets[row]])

        def place(k: int) -> tuple[int, int]:
            return int(points[words.starts[k]]) - base, int(points[words.ends[k]]) - base

        def word(k: int) -> str:
            return text[slice(*place(k))] if low <= k < high else ""

        graph, last, previous = Graph(text, base_spans(text)), {}, -2
        # Spans by start, so that a node looks only at those that may reach it.
        every, graph.base, k0 = graph.base, [], 0
        for k in nodes[a:b].tolist():
            span = place(k)
            while k0 < len(every) and every[k0][1] < span[1]:
                graph.base.append(every[k0])
                k0 += 1
            graph.base = [s for s in graph.base if s[2] > span[0]]
            graph.add(span, word(k - 1), word(k + 1), previous == k - 1, last)
            previous = k
        graph.base = every
        yield row, graph


@dataclass
class Model:
    weights: np.ndarray  # features x labels
    chain: np.ndarray  # label before x label
    skip: np.ndarray

    def marginals(self, found: list[Graph]) -> np.ndarray:
        """Label probabilities of all nodes of some documents, by loopy message passing."""
        nodes = np.array([f for g in found for f in g.features], np.int64).reshape(-1, SLOTS)
        chained = np.array([c for g in found for c in g.chained], bool)
        score = self.weights[nodes].sum(axis=1)
        number = np.arange(len(nodes))
        # A neighbour that is no node is `other`.
        score[~chained] += self.chain[OTHER]
        score[~np.append(chained[1:], False)] += self.chain[:, OTHER]
        base = np.cumsum([0] + [len(g.spans) for g in found])
        far = np.array([(a + o, b + o) for g, o in zip(found, base, strict=False) for a, b in g.skips], np.int64).reshape(-1, 2)
        near = np.stack([number[chained] - 1, number[chained]], axis=1)
        edges = np.concatenate((near, far))
        if not len(edges):
            return softmax(score)
        # Evidence of base spans: those nodes are known.
        potential = np.concatenate((np.tile(self.chain, (len(near), 1, 1)), np.tile(self.skip, (len(far), 1, 1))))
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        potential = np.concatenate((potential, potential.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
        message = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            belief = score.copy()
            np.add.at(belief, target, message)
            cavity = (belief[source] - message[back])[:, :, None] + potential
            peak = cavity.max(axis=1)
            new = peak + np.log(np.exp(cavity - peak[:, None]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            message = DAMPING * message + (1 - DAMPING) * new
        belief = score.copy()
        np.add.at(belief, target, message)
        return softmax(belief)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def known(model: Model, found: list[Graph]) -> np.ndarray:
    """Marginals given that nodes in base spans have their labels."""
    held = Model(model.weights, model.chain, model.skip)
    if not found:
        return np.zeros((0, LABELS))
    labels = np.array([label for g in found for label in g.labels])
    # A feature of its own for each label pins a node down.
    pins = np.vstack([held.weights, 30 * np.eye(LABELS)])
    pinned = [Graph(g.text, g.base, g.spans, [f if y == OTHER else [FEATURES + y] * SLOTS for f, y in zip(g.features, g.labels, strict=True)], g.labels, g.chained, g.skips) for g in found]
    held.weights = pins
    out = held.marginals(pinned)
    out[labels != OTHER] = np.eye(LABELS)[labels[labels != OTHER]]
    return out


def added_spans(graph: Graph, chance: np.ndarray) -> list[Span]:
    """Spans of nodes outside base spans that the field is sure of."""
    out: list[Span] = []
    best = chance.argmax(axis=1)
    sure = (chance.max(axis=1) >= SURE) & (best != OTHER) & (np.array(graph.labels) == OTHER)
    for k, (low, high) in enumerate(graph.spans):
        if not sure[k]:
            continue
        token = graph.text[low:high]
        low += len(token) - len(token.lstrip(".,;:!?\"'[]{}<>|#$%&*="))
        high -= len(token) - len(token.rstrip(".,;:!?\"'[]{}<>|#$%&*="))
        if low >= high:
            continue
        kind = KINDS[best[k] - 1]
        if out and graph.chained[k] and sure[k - 1] and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], high)
        else:
            out.append((kind, low, high))
    return out


def mutual(pairs: np.ndarray, limit: float = 4.0) -> np.ndarray:
    """Smoothed pointwise mutual information of label pairs (counts)."""
    share = (pairs + 0.5) / (pairs + 0.5).sum()
    out = np.log(share) - np.log(share.sum(axis=1, keepdims=True)) - np.log(share.sum(axis=0, keepdims=True))
    return np.clip(out, -limit, limit)


def train(rows: pa.Table, rounds: int = 300, rate: float = 0.5) -> Model:
    """From rows (key, labels, features, chained, skips) of documents, packed as int32."""
    rows = rows.sort_by([("key", "ascending"), ("features", "ascending")])

    def column(name: str) -> list[np.ndarray]:
        return [np.frombuffer(v.as_buffer(), np.int32) for v in rows[name]]

    label_lists, chains, skips = column("labels"), column("chained"), column("skips")
    labels = np.concatenate(label_lists)
    nodes = np.concatenate(column("features")).reshape(-1, SLOTS)
    chain_pairs, skip_pairs = np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    for own, chained, far in zip(label_lists, chains, skips, strict=True):
        on = chained == 1
        before = np.where(on, np.append(OTHER, own[:-1]), OTHER)
        np.add.at(chain_pairs, (before, own), 1)
        ends = ~np.append(on[1:], False)
        np.add.at(chain_pairs, (own[ends], OTHER), 1)
        pairs = far.reshape(-1, 2)
        a, b = own[pairs[:, 0]], own[pairs[:, 1]]
        np.add.at(skip_pairs, (a, b), 1)
        np.add.at(skip_pairs, (b, a), 1)
    weights = np.zeros((FEATURES, LABELS))
    total = np.full((FEATURES, LABELS), 1e-6)
    truth = np.eye(LABELS)[labels]
    for _ in range(rounds):
        slope = (softmax(weights[nodes].sum(axis=1)) - truth) / max(1, len(labels))
        gradient = 1e-5 * weights
        for k in range(SLOTS):
            np.add.at(gradient, nodes[:, k], slope)
        total += gradient * gradient
        weights -= rate * gradient / np.sqrt(total)
    # Agreement of linked labels is what the links are for, also before any is seen.
    return Model(weights, mutual(chain_pairs), mutual(skip_pairs + 2 * np.eye(LABELS)))


def untrained() -> Model:
    weights = np.zeros((FEATURES, LABELS))
    weights[:, OTHER] = 1
    return Model(weights, np.zeros((LABELS, LABELS)), mutual(2 * np.eye(LABELS)))


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    ready(docs.sparkSession)
    chosen = (
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("chosen_id"), F.xxhash64("doc_id").alias("key"))
        .distinct()
        .orderBy("key", "chosen_id")
        .limit(sample)
    )
    # At most `sample` rows of two numbers.
    matched = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    # One text of each id, combined before the shuffle, so that the bound holds for rows.
    first = F.min(F.struct(F.xxhash64("text"), "text")).alias("row")
    texts = matched.groupBy("chosen_id", "key").agg(first).select("key", "row.text")

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"key": [], "labels": [], "features": [], "chained": [], "skips": []}
            for low, _, data, offsets in pieces_of(batch.column("text")):
                for row, graph in graphs(data, offsets):
                    out["key"].append(batch.column("key")[low + row].as_py())
                    for name in ("labels", "features", "chained", "skips"):
                        out[name].append(np.array(getattr(graph, name), np.int32).tobytes())
            yield pa.RecordBatch.from_pydict(
                {k: pa.array(v, pa.int64() if k == "key" else pa.binary()) for k, v in out.items()}
            )

    packed = texts.select("key", "text").mapInArrow(run, "key long, labels binary, features binary, chained binary, skips binary")
    return fitted(packed, train) or untrained()


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{low}:{high}" for kind, low, high in in_order(spans))


def found_in(column: pa.Array, model: Model) -> Iterator[tuple[int, Graph, list[Span]]]:
    """(row, graph, added spans) of the texts of a column that hold a digit or `@`."""
    for low, _, data, offsets in pieces_of(column):
        rows, every = [], []
        for row, graph in graphs(data, offsets):
            rows.append(low + row)
            every.append(graph)
        if not every:
            continue
        chance = known(model, every)
        base = np.cumsum([0] + [len(g.spans) for g in every])
        for row, graph, a, b in zip(rows, every, base[:-1], base[1:], strict=True):
            yield row, graph, added_spans(graph, chance[a:b])


OUT = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Counts of the base spans by kind, their digest, all spans, and how many were added."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for batch in batches:
            size = batch.num_rows
            counts = np.zeros((len(KINDS), size), np.int64)
            digest, spans, added = [nothing] * size, [""] * size, np.zeros(size, np.int64)
            for row, graph, extra in found_in(batch.column("text"), sent.value):
                for kind, _, _ in graph.base:
                    counts[KINDS.index(kind), row] += 1
                digest[row] = hashlib.sha256(joined(graph.base).encode()).hexdigest()
                spans[row], added[row] = joined(graph.base + extra), len(extra)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in counts), pa.array(digest), pa.array(spans), pa.array(added)],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
            )

    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {OUT}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap by the first's."""
    out, done = [], 0
    for kind, low, high in in_order(spans):
        if low >= done:
            out += [text[done:low], f"[{kind}]"]
            done = high
        elif high > done:
            done = high
    return "".join(out) + text[done:]


def mask(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with personal data in `text` replaced; all columns stay."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            changed = {row: masked(graph.text, graph.base + extra) for row, graph, extra in found_in(texts, sent.value) if graph.base or extra}
            if changed:
                rows = np.arange(batch.num_rows)
                flags = np.isin(rows, list(changed))
                new = pa.array([changed[r] for r in sorted(changed)], texts.type)
                # Take changed rows from `new`, the rest as they are.
                source = np.where(flags, batch.num_rows + np.cumsum(flags) - 1, rows)
                texts = pa.concat_arrays([texts, new]).take(pa.array(source))
            yield batch.set_column(at, batch.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)


def op6_pii(docs: DataFrame) -> DataFrame:
    return find(docs, fit(docs))
