"""Toxicity: a convolutional text classifier over hashed word embeddings.

Lower-cased words without the punctuation around them are hashed into buckets; a
bucket met in fewer than `SEEN` training texts shares the vector of unknown words.
Filters of widths 1, 2 and 3 slide over the words of the whole text, each filter's
largest activation counts, and a linear layer turns them into a margin. Everything is trained in
numpy by Adagrad on the logistic loss; embeddings start from the bucket's smoothed
class log-odds in one dimension and small random numbers in the others. A quarter of
the training texts is held back: on it the margin becomes a probability (Platt), and
a threshold is calibrated for each language (the largest F1; languages with few
toxic texts there take the threshold of all). Language is no input of the score.

It is fitted on all labelled texts, whole. Up to `SHARD` of them (or `SHARD_WORDS` words)
are one shard, trained in one task. More are dealt by a hash of their id over shards of
about that size, which are trained side by side: they start each round from one model,
and its numbers and Adagrad's sums become the mean over the shards that moved them (by
ranges of buckets, in the order of the shards, so that the sums are always the same). Counts of buckets, calibration
and thresholds are over all shards. The driver holds one model, of at most 2^22 vectors, and a
score for each held-back text. All texts are scored, whole. Null text counts as empty: the score of padding alone.
Without labels of both classes the score is the smoothed share of label 1. Repeated
rows are scored each; an empty table gives an empty result. Only the columns named are
read, and `without_toxic` returns rows as they are, so that further columns, of
whatever name, do no harm.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import Words, held_out, pieces_of, ready, span_hashes
from ridelake.llm.supervised import fitted, labelled_sample, platt, sigmoid
from ridelake.sources.scratch import remove_folder, shared_folder

#: Texts and words that one task trains on.
SHARD, SHARD_WORDS = 16384, 1 << 24
#: Ranges of buckets that the shards' models are put together by.
RANGES = 32
ROUNDS, SEED = 6, 11
BITS = 22
SEEN = 3
DIMENSIONS, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
#: Of all ASCII punctuation, removed around a word.
PUNCTUATION = np.isin(np.arange(256), np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8))


def buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each word, offsets of each text's words)."""
    words = Words(data, offsets)
    starts, ends = words.starts.copy(), words.ends.copy()
    while (bare := (starts < ends) & PUNCTUATION[data[np.minimum(starts, len(data) - 1)]]).any():
        starts[bare] += 1
    while (bare := (starts < ends) & PUNCTUATION[data[ends - 1]]).any():
        ends[bare] -= 1
    return (span_hashes(data, starts, ends, lower=True) >> np.uint64(64 - BITS)).astype(np.int32), words.offsets


def padded(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with one pad (0) before and two behind: (ids, first window, windows) by text.

    One more pad ends the array.
    """
    rows = len(at) - 1
    out = np.zeros(len(ids) + 3 * rows + 1, ids.dtype)
    shift = 3 * np.repeat(np.arange(rows), np.diff(at)) + 1
    out[np.arange(len(ids)) + shift] = ids
    return out, at[:-1] + 3 * np.arange(rows), np.diff(at) + 1


@dataclass
class Model:
    """known: buckets with a vector of their own; row 0 of vectors is padding, row 1 unknown words."""

    known: np.ndarray
    vectors: np.ndarray
    filters: dict[int, np.ndarray]
    biases: np.ndarray
    output: np.ndarray
    offset: float
    slope: float = 1.0
    intercept: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def rows(self, bucket: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_row_of"):
            self._row_of = np.ones(1 << BITS, np.int32)
            self._row_of[self.known] = np.arange(2, len(self.known) + 2, dtype=np.int32)
            # A filter's answer to each word at each of its places.
            self._answers = {w: [(self.vectors @ f[j]).astype(np.float32) for j in range(w)] for w, f in self.filters.items()}
        return self._row_of[bucket]

    def rest(self) -> None:
        """Drop what `rows` has made: a worker keeps a model that was sent to it beyond its task."""
        self.__dict__.pop("_row_of", None)
        self.__dict__.pop("_answers", None)

    def pooled(self, ids: np.ndarray, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """The largest answer of each filter in each text."""
        count = len(ids) - 2
        limits = np.stack([first, first + windows], axis=1).ravel()
        parts = []
        for width in WIDTHS:
            answers = self._answers[width]
            total = answers[0][ids[:count]]
            for j in range(1, width):
                total += answers[j][ids[j : count + j]]
            # Every other stretch: windows that begin in the pads behind a text do not count.
            parts.append(np.maximum.reduceat(total, limits, axis=0)[::2])
        return np.concatenate(parts, axis=1)

    def margins(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        ids, first, windows = padded(self.rows(bucket), at)
        return np.maximum(self.pooled(ids, first, windows) + self.biases, 0) @ self.output + self.offset

    def scores(self, bucket: np.ndarray, at: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margins(bucket, at) + self.intercept)


def constant(share: float) -> Model:
    empty = {w: np.zeros((w, DIMENSIONS, FILTERS), np.float32) for w in WIDTHS}
    size = FILTERS * len(WIDTHS)
    return Model(
        np.zeros(0, np.int64), np.zeros((2, DIMENSIONS), np.float32), empty, np.zeros(size), np.zeros(size), 0.0,
        0.0, float(np.log(share / (1 - share))),
    )


def counts(texts: list[np.ndarray], positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts of each class every bucket is met: (toxic, clean)."""
    toxic, clean = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for text, label in zip(texts, positive, strict=True):
        (toxic if label else clean)[np.unique(text)] += 1
    return toxic, clean


def started(toxic: np.ndarray, clean: np.ndarray, base: float, rng: np.random.Generator) -> Model:
    """A model before training: vectors from smoothed log-odds, a few random numbers."""
    known = np.flatnonzero(toxic + clean >= SEEN)
    a, b = toxic[known], clean[known]
    # Shrunk to no evidence for rare buckets.
    share = (a + 4 * base) / (a + b + 4)
    odds = np.log(share / (1 - share)) - np.log(base / (1 - base))
    vectors = rng.normal(0, 0.05, (len(known) + 2, DIMENSIONS)).astype(np.float32)
    vectors[:2] = 0
    vectors[2:, 0] = np.clip(odds, -3, 6) / 3
    filters = {}
    for width in WIDTHS:
        filters[width] = rng.normal(0, 0.1, (width, DIMENSIONS, FILTERS)).astype(np.float32)
        filters[width][:, 0, : FILTERS // 2] += 0.5
    size = FILTERS * len(WIDTHS)
    return Model(known, vectors, filters, np.zeros(size), rng.normal(0.2, 0.1, size), -1.0)


@dataclass
class Sums:
    """Adagrad's sums of squared gradients: of the vectors, and of the other parameters by name."""

    seen: np.ndarray
    others: dict[str, np.ndarray]


def sums_of(model: Model) -> Sums:
    sizes = {"output": model.output.shape, "offset": (1,), "biases": model.biases.shape}
    sizes |= {f"filter{w}": f.shape for w, f in model.filters.items()}
    return Sums(np.full(model.vectors.shape, 1e-2, np.float32), {n: np.full(s, 1e-2) for n, s in sizes.items()})


def descend(
    model: Model, sums: Sums, texts: list[np.ndarray], positive: np.ndarray, share: float, rng: np.random.Generator,
    rounds: int = ROUNDS, batch: int = 64, rate: float = 0.05,
) -> None:
    """Adagrad on the logistic loss; a text's gradient flows through its largest windows.

    `share`: of toxic texts among all that are trained on; both classes weigh alike.
    """

    def step(name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        total = sums.others[name]
        total += gradient * gradient
        value -= (rate * gradient / np.sqrt(total)).astype(value.dtype)

    seen = sums.seen
    offset = np.array([model.offset])
    model.rows(np.zeros(0, np.int64))
    remapped = [model.rows(t) for t in texts]
    weight = np.where(positive, 0.5 / share, 0.5 / (1 - share))
    for _ in range(rounds):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            own = order[low : low + batch]
            at = np.concatenate(([0], np.cumsum([len(remapped[k]) for k in own])))
            flat = np.concatenate([remapped[k] for k in own]) if at[-1] else np.zeros(0, np.int32)
            ids, first, windows = padded(flat, at)
            found = model.vectors[ids]
            count = len(ids) - 2
            best, peak = [], []
            for width in WIDTHS:
                total = found[:count] @ model.filters[width][0]
                for j in range(1, width):
                    total += found[j : count + j] @ model.filters[width][j]
                where = np.array([first[k] + total[first[k] : first[k] + windows[k]].argmax(axis=0) for k in range(len(own))])
                best.append(where)
                peak.append(np.take_along_axis(total, where, axis=0))
            hidden = np.concatenate(peak, axis=1) + model.biases
            active = hidden > 0
            margin = np.maximum(hidden, 0) @ model.output + offset[0]
            slope = (sigmoid(margin) - positive[own]) * weight[own] / len(own)
            back = slope[:, None] * model.output * active
            step("output", model.output, np.maximum(hidden, 0).T @ slope + 1e-5 * model.output)
            step("offset", offset, np.array([slope.sum()]))
            touched, pull = [], []
            for number, width in enumerate(WIDTHS):
                own_back = back[:, number * FILTERS : (number + 1) * FILTERS]
                gradient = np.zeros_like(model.filters[width])
                for j in range(width):
                    word = ids[best[number] + j]
                    gradient[j] = np.einsum("bf,bfd->df", own_back, model.vectors[word])
                    touched.append(word.ravel())
                    pull.append((own_back[:, :, None] * model.filters[width][j].T[None]).reshape(-1, DIMENSIONS))
                step(f"filter{width}", model.filters[width], gradient)
            step("biases", model.biases, back.sum(axis=0))
            word, place = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(word), DIMENSIONS), np.float32)
            np.add.at(total, place, np.concatenate(pull).astype(np.float32))
            total[word == 0] = 0
            seen[word] += total * total
            model.vectors[word] -= rate * total / np.sqrt(seen[word])
    model.offset = float(offset[0])
    model.rest()


def best_threshold(score: np.ndarray, positive: np.ndarray) -> float:
    """Halfway between the scores that part the texts with the largest F1."""
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(positive[order])
    f1 = 2 * hits / (np.arange(1, len(score) + 1) + positive.sum())
    last = np.append(score[order][1:] != score[order][:-1], True)
    k = int(np.argmax(np.where(last, f1, -1)))
    after = score[order][k + 1] if k + 1 < len(score) else 0.0
    return float((score[order][k] + after) / 2)


def examples(rows: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(words, whether toxic, language, whether held back) of rows (key, label, lang, words as bytes of int32)."""
    rows = rows.sort_by([("key", "ascending"), ("words", "ascending")])
    texts = [np.frombuffer(v.as_buffer(), np.int32) for v in rows["words"]]
    positive = rows["label"].to_numpy() == 1
    return texts, positive, np.array(rows["lang"].to_pylist()), np.arange(len(texts)) % 4 == 0


def parted(values: list, mask: np.ndarray) -> list:
    return [v for v, m in zip(values, mask, strict=True) if m]


def one_class(kept: int, kept_toxic: int, held: int, held_toxic: int) -> bool:
    """Whether the texts trained on, or those held back, lack a class."""
    return not (kept_toxic and held_toxic) or kept_toxic == kept or held_toxic == held


def held_margins(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    found = [model.margins(t, np.array([0, len(t)])) for t in texts]
    return np.concatenate(found) if found else np.zeros(0)


def calibrate(model: Model, margin: np.ndarray, positive: np.ndarray, lang: np.ndarray, few: int = 10) -> None:
    """Probability and thresholds from the texts held back."""
    model.slope, model.intercept = platt(margin, positive)
    score = sigmoid(model.slope * margin + model.intercept)
    model.threshold = best_threshold(score, positive)
    for name in sorted(set(lang)):
        here = lang == name
        if positive[here].sum() >= few and (~positive[here]).sum() >= few:
            model.thresholds[name] = best_threshold(score[here], positive[here])


def train(rows: pa.Table) -> Model:
    """The model from the rows of one shard, which are all."""
    texts, positive, lang, held = examples(rows)
    keep = ~held
    if one_class(keep.sum(), positive[keep].sum(), held.sum(), positive[held].sum()):
        return constant((positive.sum() + 1) / (len(texts) + 2))
    own = parted(texts, keep)
    rng = np.random.default_rng(SEED)
    base = positive[keep].mean()
    model = started(*counts(own, positive[keep]), base, rng)
    descend(model, sums_of(model), own, positive[keep], base, rng)
    calibrate(model, held_margins(model, parted(texts, held)), positive[held], lang[held])
    model.rest()
    return model


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of each shard in a task; the rows of a shard follow each other."""
    rows, own = [], None
    for batch in batches:
        number = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            if low < high:
                if rows and number[low] != own:
                    yield own, pa.Table.from_batches(rows)
                    rows = []
                own = int(number[low])
                rows.append(batch.slice(low, high - low))
    if rows:
        yield own, pa.Table.from_batches(rows)
    rows.clear()
    pa.default_memory_pool().release_unused()


#: A shard's numbers for some buckets or vectors: `at` are int32, `numbers` as many rows of `kind`.
PART = "range int, shard int, kind string, at binary, numbers binary"
WHOLE = RANGES


def parts_of(shard: int, at: np.ndarray, numbers: np.ndarray, whole: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of `PART`, by range of `at`; `whole` is a range of its own."""
    ranges = [(k, at[at % RANGES == k], numbers[at % RANGES == k]) for k in range(RANGES)]
    for k, own, value in [*ranges, (WHOLE, np.zeros(1, np.int32), whole[None])]:
        if len(own):
            data = [[k], [shard], [value.dtype.str], [own.astype(np.int32).tobytes()], [value.tobytes()]]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(data, kinds, strict=True)], names=PART.split()[::2])


def together(parts: DataFrame, mean: bool) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{range: (at, sums or means over the shards that have a number there)}, added in the order of shards."""

    def run(batches):
        own, total, times = None, None, None

        def out():
            at = np.flatnonzero(times)
            value = (total[at] / times[at, None] if mean else total[at]).astype(kind)
            place = (at * RANGES + own if own != WHOLE else at).astype(np.int32)
            data = [[own], [0], [kind], [place.tobytes()], [value.tobytes()]]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(data, kinds, strict=True)], names=PART.split()[::2])

        for batch in batches:
            for row in range(batch.num_rows):
                number, kind_now = batch.column(0)[row].as_py(), batch.column(2)[row].as_py()
                at = np.frombuffer(batch.column(3)[row].as_buffer(), np.int32)
                value = np.frombuffer(batch.column(4)[row].as_buffer(), kind_now).reshape(len(at), -1)
                if number != own:
                    if own is not None:
                        yield out()
                    own, size = number, 1 if number == WHOLE else (1 << BITS) // RANGES + 1
                    total, times = np.zeros((size, value.shape[1])), np.zeros(size, np.int32)
                kind = kind_now
                place = at if own == WHOLE else at // RANGES
                total[place] += value
                times[place] += 1
        if own is not None:
            yield out()

    dealt = parts.repartition(RANGES, "range").sortWithinPartitions("range", "shard")
    found = {}
    for r in dealt.mapInArrow(run, PART).collect():
        at = np.frombuffer(r["at"], np.int32)
        found[r["range"]] = at, np.frombuffer(r["numbers"], r["kind"]).reshape(len(at), -1)
    return found


def flat(model: Model, sums: Sums) -> np.ndarray:
    """The parameters beside the vectors and their sums, in one row."""
    values = {"output": model.output, "offset": np.array([model.offset]), "biases": model.biases}
    values |= {f"filter{w}": f for w, f in model.filters.items()}
    return np.concatenate([x.ravel().astype(np.float64) for n in sums.others for x in (values[n], sums.others[n])])


def take(model: Model, sums: Sums, row: np.ndarray) -> None:
    """The reverse of `flat`."""
    values, low = {}, 0
    for name, old in sums.others.items():
        values[name], sums.others[name] = (row[low + k * old.size :][: old.size].reshape(old.shape).copy() for k in (0, 1))
        low += 2 * old.size
    model.output, model.biases, model.offset = values["output"], values["biases"], float(values["offset"][0])
    model.filters = {w: values[f"filter{w}"].astype(np.float32) for w in model.filters}


def train_shards(rows: DataFrame) -> Model:
    """The model from rows (shard, key, label, lang, words) of several shards; each task reads whole shards."""
    spark = rows.sparkSession

    def count(batches):
        for shard, table in shards(batches):
            texts, positive, _, held = examples(table)
            toxic, clean = counts(parted(texts, ~held), positive[~held])
            at = np.flatnonzero(toxic + clean)
            total = np.array([(~held).sum(), positive[~held].sum(), held.sum(), positive[held].sum()])
            yield from parts_of(shard, at, np.stack([toxic[at], clean[at]], axis=1), total)

    found = together(rows.mapInArrow(count, PART), mean=False)
    kept, kept_toxic, held_back, held_toxic = (int(n) for n in found.pop(WHOLE)[1][0])
    if one_class(kept, kept_toxic, held_back, held_toxic):
        return constant((kept_toxic + held_toxic + 1) / (kept + held_back + 2))
    both = np.zeros((1 << BITS, 2), np.int32)
    for at, value in found.values():
        both[at] = value
    share = kept_toxic / kept
    model = started(both[:, 0], both[:, 1], share, np.random.default_rng(SEED))
    del both, found
    sums = sums_of(model)

    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model, sums))

        def descended(batches, sent=sent, turn=turn):
            for shard, table in shards(batches):
                texts, positive, _, held = examples(table)
                if held.all():
                    continue
                own, own_sums = copy.deepcopy(sent.value)
                rng = np.random.default_rng([SEED, turn, shard])
                descend(own, own_sums, parted(texts, ~held), positive[~held], share, rng, 1)
                moved = np.flatnonzero((own_sums.seen != sent.value[1].seen).any(axis=1))
                yield from parts_of(shard, moved, np.concatenate([own.vectors[moved], own_sums.seen[moved]], axis=1), flat(own, own_sums))

        found = together(rows.mapInArrow(descended, PART), mean=True)
        sent.destroy()
        take(model, sums, found.pop(WHOLE)[1][0])
        for at, value in found.values():
            model.vectors[at], sums.seen[at] = value[:, :DIMENSIONS], value[:, DIMENSIONS:]

    sent = spark.sparkContext.broadcast(model)

    def judged(batches):
        for _, table in shards(batches):
            texts, positive, lang, held = examples(table)
            margin = held_margins(sent.value, parted(texts, held))
            data = [pa.array(margin), pa.array(positive[held]), pa.array(lang[held].tolist(), pa.string())]
            yield pa.RecordBatch.from_arrays(data, names=["margin", "toxic", "lang"])
        sent.value.rest()

    held = rows.mapInArrow(judged, "margin double, toxic boolean, lang string").toArrow()
    sent.destroy()
    margin, positive = held["margin"].to_numpy(), held["toxic"].to_numpy()
    lang = np.array(held["lang"].to_pylist())
    order = np.lexsort((lang, positive, margin))
    calibrate(model, margin[order], positive[order], lang[order])
    return model


def word_rows(sample: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for low, high, bucket, at in blocks(batch.column("text")):
                packed = [bucket[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                size = high - low
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(low, size) for c in ("key", "label", "lang")] + [pa.array(packed, pa.binary())],
                    names=["key", "label", "lang", "words"],
                )

    return sample.mapInArrow(run, "key long, label int, lang string, words binary")


def blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for low, high, data, offsets in pieces_of(column):
        yield low, high, *buckets(data, offsets)


def fit(docs: DataFrame, labels: DataFrame, label: str, excluded: Column, shard: int = SHARD) -> Model:
    spark, folder = ready(docs.sparkSession), shared_folder(docs.sparkSession)
    try:
        word_rows(labelled_sample(docs, labels, label, excluded)).write.parquet(f"{folder}/words", compression="zstd")
        words = spark.read.parquet(f"{folder}/words")
        size = words.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.octet_length("words")).alias("bytes")).first()
        parts = max(1, -(-size["texts"] // shard), -(-(size["bytes"] or 0) // (4 * SHARD_WORDS)))
        if parts == 1:
            return fitted(words, train) or constant(0.5)
        dealt = words.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
        dealt = dealt.repartitionById(parts, "shard").sortWithinPartitions("shard", "key", "words")
        # One row group to a shard, so that one task reads it whole, however files are split.
        dealt.write.option("parquet.block.size", 1 << 30).parquet(f"{folder}/shards", compression="zstd")
        return train_shards(spark.read.parquet(f"{folder}/shards"))
    finally:
        remove_folder(spark, folder)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with toxicity: a score between 0 and 1. Other columns pass through."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)
    schema = docs.schema.fieldNames()
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        for batch in batches:
            found = [sent.value.scores(bucket, at) for _, _, bucket, at in blocks(batch.column("text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*schema, "toxicity"])
        sent.value.rest()

    return docs.mapInArrow(run, f"{out}, toxicity double")


def threshold_of(model: Model, lang: Column) -> Column:
    """The calibrated threshold of a document's language."""
    out = F.lit(model.threshold)
    for name, value in model.thresholds.items():
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` below their language's threshold, all columns."""
    sent = ready(docs.sparkSession).sparkContext.broadcast(model)
    names = docs.columns

    def run(batches):
        for batch in batches:
            found = [sent.value.scores(bucket, at) for _, _, bucket, at in blocks(batch.column(names.index("text")))]
            scores = np.concatenate(found) if found else np.zeros(0)
            own = batch.column(names.index("lang")).to_pylist() if "lang" in names else [None] * len(scores)
            limits = np.array([sent.value.thresholds.get(name, sent.value.threshold) for name in own])
            yield batch.filter(pa.array(scores < limits))
        sent.value.rest()

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, "toxic", held_out(F.col("doc_id"), 3, 1))
    source = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    # Only numbers and the language leave the task.
    scored = score(source, model).drop("text")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
        (F.col("toxicity") >= threshold_of(model, F.col("lang"))).alias("rejected"),
    )
